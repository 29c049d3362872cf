"""Exact deduplication with a heavy-hitter split.

A Misra-Gries frequent-items sketch finds the digests that may hold more than
one row in HEAVY_SHARE.  They are counted exactly, and the verified winners
(fewer than HEAVY_SHARE of them, by counting) are broadcast: their rows are
settled where they are read, without a shuffle.  All other digests go through
one ordinary shuffle of slim rows.  DataFrame and SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandlake.llm.common import ASCII_SPACE, keep_rows, row_keys, written

#: A digest is heavy if it holds more than one row in so many.
HEAVY_SHARE = 512
#: Counters per sketch.  Its counts are off by at most 3.5 / 2**14 of the rows,
#: well below 1 / HEAVY_SHARE, so no heavy digest is missed.
SKETCH_ITEMS = 12_000
#: Sketches of map tasks are merged in so many groups before the last merge.
MERGE_GROUPS = 64


def digests(docs: DataFrame) -> DataFrame:
    """Slim rows: doc_id, row keys, digest of the text without white space, code points of the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return row_keys(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), "_id_key", "_text_key",
        F.unhex(F.sha2(F.regexp_replace(text, f"{ASCII_SPACE}+", ""), 256)).alias("digest"),
        F.length(text).cast("long").alias("n_code_points"))


def frequent_keys(slim: DataFrame) -> DataFrame:
    """Column key: the first 64 bits of every digest that may be heavy (and of some that are not)."""
    key = F.conv(F.hex(F.substring("digest", 1, 8)), 16, -10).cast("long")
    sketches = (slim.select(key.alias("key"), F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("part"))
                .groupBy("part").agg(F.expr(f"approx_top_k_accumulate(key, {SKETCH_ITEMS})").alias("sketch")))
    # Grouped by a key that is always 0: a merge without one starts from an untyped sketch where a task has no rows.
    return (sketches.groupBy(F.pmod("part", F.lit(1)).alias("all")).agg(F.expr(f"approx_top_k_combine(sketch, {SKETCH_ITEMS})").alias("sketch"))
            .select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {2 * HEAVY_SHARE})")).alias("top"))
            .select(F.col("top.item").alias("key")).distinct())


def _best() -> F.Column:
    """Orders rows of a group: most code points first, then smallest doc_id (null last), then text key."""
    return F.struct((-F.col("n_code_points")).alias("neg"), F.col("doc_id").isNull().alias("no_id"),
                    F.col("_id_key").alias("id"), F.col("_text_key").alias("text"))


def groups(docs: DataFrame) -> DataFrame:
    """One row per document of docs: doc_id, row keys, digest, keep_id, group_size, kept.

    Null text counts as empty; a null doc_id loses every tie; among rows with
    the same doc_id and code points the smaller text key wins.  Rows that are
    repeated in full are all marked kept if their group's winner is that row;
    dedup() leaves one of them.  An empty table gives no rows.
    """
    slim = written(digests(docs), "digests")
    total = slim.count()
    key = F.conv(F.hex(F.substring("digest", 1, 8)), 16, -10).cast("long")
    candidates = F.broadcast(frequent_keys(slim))  # 2 * HEAVY_SHARE rows at most
    winners = written(
        slim.withColumn("key", key).join(candidates, "key", "left_semi")
        .groupBy("digest").agg(F.count("*").alias("group_size"), F.min(_best()).alias("best"))
        .where(F.col("group_size") * HEAVY_SHARE > total), "heavy")
    heavy = F.broadcast(winners)  # fewer than HEAVY_SHARE rows: each holds over 1 / HEAVY_SHARE of all
    settled = slim.join(heavy, "digest")
    w = Window.partitionBy("digest")
    rest = (slim.join(heavy.select("digest"), "digest", "left_anti")
            .withColumn("best", F.first(_best()).over(w.orderBy(F.desc("n_code_points"), F.col("doc_id").isNull(), "_id_key", "_text_key")))
            .withColumn("group_size", F.count("*").over(w)))
    columns = [
        "doc_id", "_id_key", "_text_key", "digest",
        F.when(~F.col("best.no_id"), F.col("best.id")).alias("keep_id"), "group_size",
        ((F.col("best.id") == F.col("_id_key")) & (F.col("best.text") == F.col("_text_key"))).alias("kept")]
    return settled.select(*columns).unionByName(rest.select(*columns))


def dedup(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay: one of each group of equal texts, all columns as they were."""
    return keep_rows(docs, groups(docs).where("kept"))
