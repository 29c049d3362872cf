"""Session helpers: UTC clock, ANSI casts, AQE and a shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on.  The time zone matters for
# correctness (event times are UTC and DATE(ts) must be the UTC day);
# the rest are scale settings that Catalyst/AQE read at planning time.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Parquet files are written with dynamic partition overwrite per call;
    # keep the session default static so a missing option fails loudly.
    "spark.sql.sources.partitionOverwriteMode": "static",
    # HotSpot never compiles a method beyond 8000 bytes of bytecode, and its optimizing compiler gives
    # up on ones well below that ("out of nodes": 7491 bytes, the parsing of silver).  A stage whose
    # fused method would be larger runs operator by operator, in methods that are optimized.
    "spark.sql.codegen.hugeMethodLimit": "4000",
    # A row of these jobs takes ten times the CPU of a plain one, so parts of the default 64 MB
    # would be few long tasks with large sorts; the last ones leave cores idle.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    # Where every part of the smaller side is small, a join hashes it instead of sorting both sides.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "32m",
    # A written intermediate needs its shuffles no more; without this they stay on disk until the driver's
    # heap is collected, beside those of every later step.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Intermediates are written once and read once or twice: disk counts, not the speed of the codec.
    "spark.sql.parquet.compression.codec": "zstd",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in spark.checkpoint.dir.

    Only on a local master, where driver and executors are one process, a
    scratch folder is made if the setting is absent.  A cluster without the
    setting is an error: a folder on one machine would lose data.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="demandlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    try:
        sc = spark.sparkContext
    except Exception:  # no SparkContext on this client: the conf is used
        return configured
    current = sc.getCheckpointDir()
    if not current:
        sc.setCheckpointDir(configured)
        return configured
    return current


def materialize(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write df once as Parquet to a folder of its own below the shared checkpoint folder and read it back.

    Used where one intermediate feeds several branches: each branch reads only
    its columns and row groups of the written files instead of recomputing the
    lineage, and a lost executor does not send the job back to the raw tables.
    compression names the files' codec where Spark's default is not meant.
    """
    path = scratch_path(df.sparkSession, f"table-{uuid.uuid4().hex}")
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared checkpoint folder for materialized tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), name)


def build(master: str | None = None, app: str = "demandlake",
          shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session.  On a cluster pass master=None."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (builder.config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               # checkpoint files of dropped DataFrames are removed by the cleaner
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
