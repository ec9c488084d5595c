"""A corpus pipeline of the training-data operators: quality classifier,
language identification, n-gram Jaccard join, secret scans, best-fit packing.

Each stage works on all that its predecessor kept. The first three drop
documents, the fourth replaces secrets in the texts, the last returns token
pieces and their places in sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import jaccard, langid, packing, quality, secrets
from vigil.llm.shared import checkpoint


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps (probability >= 0.5)."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.classify(docs, labels, carry=tuple(c for c in docs.columns if c != "doc_id")).where(
        "keep").select(*docs.columns)


#: code points of a stretch of one language, on average, in a text that mixes languages
STRETCH = 40


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without letters go, and those of
    which no language labels half the letters, unless their languages come in
    stretches of ``STRETCH`` code points on average (a text of several
    languages, not noise). A null ``lang`` is filled with the label. Where no
    row says its language, nothing is learned and all texts with letters
    stay."""
    model = langid.learn_from(docs)
    if not model.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    others = [c for c in docs.columns if c != "doc_id"]
    names = {c: f"_c{i}" for i, c in enumerate(others)}
    found = langid.identify(docs, model, keep_text=names["text"],
                            carry=tuple(F.col(c).alias(n) for c, n in names.items() if c != "text"))
    covered = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])
    found = found.where((F.col("lang_pred") != "und") & (
        (F.col("score") >= 0.5) | (covered >= STRETCH * F.size("spans"))))
    filled = F.coalesce(F.col(names["lang"]), F.col("lang_pred"))
    return found.select("doc_id", *((filled if c == "lang" else F.col(n)).alias(c) for c, n in names.items())).select(
        *docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones stays: the row with the
    smallest doc_id (five-word shingles, similarity 0.8). Rows are told apart
    by doc_id and text, so repeated and null keys are decided row by row;
    equal rows are one."""
    return jaccard.drop_copies(docs, k=5, num=80, den=100)


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    return secrets.redact_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 1024."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(packing.pieces(docs, path, 1024, 2), 1024)


STAGES = [
    ("quality classifier", keep_quality),
    ("language id", keep_language),
    ("n-gram jaccard join", drop_near_copies),
    ("secret scans", remove_secrets),
    ("best-fit packing", pack_sequences),
]

#: language labels, the classifier and packings are not expressible in SQL;
#: tests/llm compares every stage with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each is cut off from the next through
    the checkpoint folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES):
            docs = checkpoint(docs)
    return docs
