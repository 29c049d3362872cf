"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandlake.session import checkpoint_dir

#: Characters that separate words in every contract of this subpackage.
ASCII_SPACE = r"[\x20\x09-\x0D]"
#: Stands for a null doc_id where a join needs a key that is never null.
NULL_ID = -(2**63)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df once below the shared checkpoint folder and read it back.

    Cuts the lineage: later jobs read the files, also after an executor is
    lost.  Every call takes a folder of its own, so reruns never collide.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """True where crc32(doc_id as text) mod 5 is 0; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def training_labels(spark: SparkSession, sf_dir: str, label: str, max_rows: int) -> DataFrame:
    """(doc_id, label) of labelled rows outside the held-out fold, about max_rows at most.

    The sample is a threshold on a hash of doc_id, so it is the same on every
    run; all rows are taken where there are fewer than max_rows.  Labels other
    than 0 and 1 and null ids are left out; a doc_id labelled more than once
    takes its largest label.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max(label).cast("int").alias("label")))
    total = rows.count()
    share = min(1.0, max_rows / max(total, 1))
    buckets = 1 << 20
    return rows.where(F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(buckets)) < int(round(share * buckets)))


def row_keys(docs: DataFrame) -> DataFrame:
    """Add _id_key and _text_key, never null, that name a row up to equal (doc_id, text)."""
    return (docs.withColumn("_id_key", F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)))
            .withColumn("_text_key", F.xxhash64(F.coalesce(F.col("text"), F.lit("")))))


def keep_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of docs that kept(_id_key, _text_key) names, one of each repeated row.

    One exchange of docs: the rank that takes one of each repeated row starts
    before the shuffle, and the semi join reuses its partitioning.  The row
    travels as one struct, so its column names clash with nothing.
    """
    keys = ["_id_key", "_text_key"]
    rows = row_keys(docs.select(F.col("doc_id"), F.col("text"), F.struct(*docs.columns).alias("_row"))).select(*keys, "_row")
    one = (rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.length("_row.text"))))
           .where("_rank = 1"))
    return one.join(kept.select(*keys).distinct(), keys, "left_semi").select("_row.*")


def running_offsets(counts: DataFrame, group: list[str], shard: str, value: str, name: str) -> DataFrame:
    """counts with column name: the sum of value over the group's earlier shards.

    counts holds one row per (group, shard), never one per document.
    """
    w = Window.partitionBy(*group).orderBy(shard).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(name, F.coalesce(F.sum(value).over(w), F.lit(0)).cast("long"))
