"""Spark session and shared-folder helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, app: str = "vigil",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session or build one with the settings this engine
    expects (AQE on, UTC session zone, UI off)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The context's checkpoint folder. When the context has none yet, use
    ``spark.checkpoint.dir`` as the cluster names it; only when that is
    unset too (local tests) take a fresh scratch folder. Set once: every
    ``setCheckpointDir`` call makes a new sub-folder."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local[") and sc.master != "local":  # local-cluster has executors of its own
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="vigil-ckpt-")
    sc.setCheckpointDir(base)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives the
    loss of executors, unlike a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def deal(df: DataFrame) -> DataFrame:
    """``df`` dealt to ``vigil.spread.partitions`` partitions, for one pass of
    costly work over it, if the caller sets that option; else as it is."""
    n = df.sparkSession.conf.get("vigil.spread.partitions", None)
    return df.repartition(int(n)) if n else df


def spread(df: DataFrame, persisted: list | None = None, keep: bool = False) -> DataFrame:
    """``df`` dealt to ``vigil.spread.partitions`` partitions and kept for the
    passes that follow, if the caller sets that option (one unsplittable file
    on many cores); else ``df`` as it is, kept too with ``keep`` (rows that
    cost more to read again than to keep, as those of text files)."""
    from pyspark import StorageLevel

    out = deal(df)
    if out is df and not keep:
        return df
    out = out.persist(StorageLevel.DISK_ONLY)  # a data copy: keep it off the heap
    if persisted is not None:
        persisted.append(out)
    return out


CACHED_AQE = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def _set_default(spark: SparkSession, name: str, default: str, value: str) -> None:
    """Set an option that still has Spark's default; an explicit setting by
    the user is left alone."""
    try:
        explicit = spark.sparkContext.getConf().contains(name) or name in spark.conf.getAll
    except Exception:  # noqa: BLE001 - connect sessions have no getAll
        explicit = False
    if not explicit and spark.conf.get(name, default) == default:
        spark.conf.set(name, value)


def allow_cached_coalescing(spark: SparkSession) -> None:
    """Let AQE coalesce the partitions of cached plans (the engine caches
    its small per-snapshot tables; without this each keeps
    ``spark.sql.shuffle.partitions`` tiny tasks). Performance only."""
    _set_default(spark, CACHED_AQE, "false", "true")


def compilable_methods(spark: SparkSession) -> None:
    """Let Spark fuse a stage into one method only up to the size that the JVM
    compiles (8000 bytes of bytecode); a larger one, as dozens of column
    expressions give, would be interpreted for every row. Performance only."""
    _set_default(spark, METHOD_LIMIT, "65535", "8000")
