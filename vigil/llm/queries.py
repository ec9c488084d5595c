"""The registered queries of this subpackage: each applies one operator, with
its production parameters, to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .oracles import MERKLE, PLANTED_LINKS, SPELLING

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def oracle(sql: str):
    def deco(f):
        ORACLE[f.__name__] = sql
        return f
    return deco


def byte_bpe() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .tokens import count_tokens

    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), byte_bpe(), limit=512)


@query
def op9_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lexicon import encode_decode

    return encode_decode(spark.read.parquet(f"{sf_dir}/documents.parquet"), byte_bpe())


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack, pieces

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(pieces(docs, byte_bpe(), 1024, 2), 1024)


@query
def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import digest, find_secrets

    return digest(find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet")))


@query
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprints import compare_next

    return compare_next(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import held_out, identify, learn_from

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = identify(docs, learn_from(docs), carry=(held_out().alias("held_out"),))
    return out.select("doc_id", "held_out", "lang_pred", "score")


@query
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import classify

    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import join_components

    return join_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@query
def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .ann import search

    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


@query
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .extract import extract

    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@oracle(MERKLE)
@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .merkle import manifest

    return manifest(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@oracle(SPELLING)
@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .spelling import variants

    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@query
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bytebpe import encode_decode

    return encode_decode(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                         public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@oracle(PLANTED_LINKS)
@query
def secret_links_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak parts planted behind every document, an identifier and a secret
    1 to 400 code points apart: linked up to 200, on either side."""
    from pyspark.sql import functions as F

    from .secrets import find_secrets

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id IS NOT NULL")
    gap = F.expr("CAST(1 + doc_id * 37 % 400 AS INT)")
    name = F.lpad(F.col("doc_id").cast("string"), 12, "0")
    parts = (F.concat(F.lit("XK"), name), F.concat(F.lit("fQ/"), name, F.lit("+wJalrXUtnFEMIbPxRfiCYKEY"), name))
    first = F.col("doc_id") % 2 == 0
    text = F.concat(F.coalesce("text", F.lit("")), F.repeat(F.lit(". "), F.lit(150)), F.when(first, parts[0]).otherwise(parts[1]),
                    F.repeat(F.lit("~"), gap), F.when(first, parts[1]).otherwise(parts[0]))
    planted = docs.select("doc_id", text.alias("text"), (F.length(F.coalesce("text", F.lit(""))) + 300).cast("long").alias("behind"))
    found = find_secrets(planted)
    return found.join(planted.select("doc_id", "behind"), "doc_id").select(
        "doc_id", F.size(F.filter("linked", lambda s: s["start"] >= F.col("behind"))).cast("long").alias("n_linked"))
