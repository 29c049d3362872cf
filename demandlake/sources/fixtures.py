"""Adapters that turn the driver's parquet tables into raw retail events.

The reference's source CSV is not shipped, so test inputs are derived
from the given tables by fixed mapping rules (see FIXTURES.md):

* A1: a multi-month store from lineitem x orders x part (one load month per
  ship month), with injected re-deliveries (duplicates) and bad rows.
* A2: one clickstream month from events x part (flagship query).
* A4: scoring requests from part.

Everything is a DataFrame expression: one scan per table, one join per
dimension, the duplicate copies made by a generator instead of re-reading.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# Fixed values of the A2 clickstream month.
A2_LOAD_MONTH = "2024-01"
A2_SNAPSHOT = "2024-02-01"
# Fixed value: hour of day at which a month's file is ingested.
INGEST_HOUR = 5


def _category_code(p_size: Column, p_type: Column, p_name: Column) -> Column:
    """'' for size%10=0, one level for size%10=1, else type.word1.word2."""
    t = F.lower(p_type)
    return (
        F.when(p_size % 10 == 0, F.lit(""))
        .when(p_size % 10 == 1, t)
        .otherwise(F.concat_ws(".", t, F.split_part(p_name, F.lit(" "), F.lit(1)),
                               F.split_part(p_name, F.lit(" "), F.lit(2))))
    )


def _ingest_ts(load_month: Column) -> Column:
    """First day of the month after load_month (a first day) at the ingest hour."""
    return F.add_months(load_month, 1).cast("timestamp") + F.expr(f"INTERVAL {INGEST_HOUR} HOUR")


def _lineage(load_month: Column) -> list[Column]:
    """_source_uri, _ingested_at, _load_id, _load_month for a month date."""
    ym = F.concat(F.lpad(F.year(load_month).cast("string"), 4, "0"), F.lit("-"), F.lpad(F.month(load_month).cast("string"), 2, "0"))
    ingested = _ingest_ts(load_month)
    return [
        F.concat(F.lit("lake/raw/events/month="), ym, F.lit("/events_"), ym, F.lit(".csv")).alias("_source_uri"),
        ingested.alias("_ingested_at"),
        F.concat(F.lit("manual_"), ym).alias("_load_id"),
        load_month.alias("_load_month"),
    ]


def a1_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x orders x part with the columns the mapping uses; what depends on the part alone is made before the join."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_tax", "l_shipdate")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    pt = read_table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_size").cast("string").alias("category_id_raw"),
        _category_code(F.col("p_size"), F.col("p_type"), F.col("p_name")).alias("category_code_raw"),
        F.when(F.col("p_size") % 7 == 0, F.lit(""))
         .otherwise(F.concat(F.lit("  "), F.col("p_brand"))).alias("brand_raw"))
    # joins stay with the planner (AQE keeps its skew-join handling)
    return (li.join(od, li.l_orderkey == od.o_orderkey)
              .join(pt, li.l_partkey == pt.p_partkey))


def a1_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows of fixture A1 (all load months, duplicates included)."""
    b = a1_base(spark, sf_dir)
    q = F.col("l_quantity") % 10
    secs = (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 977) % 86400
    event_time = F.timestamp_micros(F.unix_micros(F.col("l_shipdate").cast("timestamp")) + F.col("secs") * 1_000_000)
    load_month = F.trunc(F.to_date("l_shipdate"), "MM")
    base = b.select(
        "*",
        secs.alias("secs"),
    ).select(
        F.concat(F.date_format(event_time, "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")).alias("event_time_raw"),
        F.when(q < 5, "view").when(q < 7, " Cart ").when(q < 9, "PURCHASE")
         .otherwise("remove_from_cart").alias("event_type_raw"),
        F.when(F.col("l_suppkey") % 50 == 0, F.lit("n/a"))
         .otherwise(F.col("l_partkey").cast("string")).alias("product_id_raw"),
        "category_id_raw", "category_code_raw", "brand_raw",
        F.when((F.col("l_linenumber") == 1) & (F.col("l_tax") == 0.0), F.lit(""))
         .when((F.col("l_linenumber") == 1) & (F.col("l_tax") == 0.01), F.lit("-1.00"))
         .otherwise(F.col("l_extendedprice").cast("decimal(18,2)").cast("string")).alias("price_raw"),
        F.col("o_custkey").cast("string").alias("user_id_raw"),
        F.when((F.col("l_suppkey") % 25 == 3) & (F.col("l_linenumber") == 7), F.lit("  "))
         .otherwise(F.concat(F.lit("s"), F.col("l_orderkey").cast("string"))).alias("user_session_raw"),
        load_month.alias("m"),
        # copy 0 is the original; 1 = older stale re-delivery, 2 = same-time re-delivery
        F.explode(F.when(F.col("l_suppkey") % 25 == 1, F.array(F.lit(0), F.lit(1)))
                   .when(F.col("l_suppkey") % 25 == 2, F.array(F.lit(0), F.lit(2)))
                   .otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    lineage = _lineage(F.col("m"))
    return base.select(
        "event_time_raw", "event_type_raw", "product_id_raw", "category_id_raw",
        "category_code_raw",
        F.when(F.col("copy") == 1, F.lit("stale")).otherwise(F.col("brand_raw")).alias("brand_raw"),
        F.when(F.col("copy") == 1, F.lit("0.01")).when(F.col("copy") == 2, F.lit("0.50"))
         .otherwise(F.col("price_raw")).alias("price_raw"),
        "user_id_raw", "user_session_raw",
        lineage[0],
        F.when(F.col("copy") == 1, _ingest_ts(F.col("m")) - F.expr("INTERVAL 1 HOUR"))
         .otherwise(_ingest_ts(F.col("m"))).alias("_ingested_at"),
        lineage[2],
        lineage[3],
    )


def a2_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows of fixture A2: one clickstream month (2024-01)."""
    ev = read_table(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value", "props")
    pt = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    k = F.get_json_object("props", "$.k")
    ev = ev.withColumn("k", k)
    j = ev.join(pt, ev.k.cast("bigint") == pt.p_partkey, "left")
    m = F.to_date(F.lit(A2_LOAD_MONTH + "-01"))
    lineage = _lineage(F.col("m"))
    return j.withColumn("m", m).select(
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(" UTC")).alias("event_time_raw"),
        F.when(F.col("event_type") == "click", F.lit("cart")).otherwise(F.col("event_type")).alias("event_type_raw"),
        F.col("k").alias("product_id_raw"),
        F.col("p_size").cast("string").alias("category_id_raw"),
        _category_code(F.col("p_size"), F.col("p_type"), F.col("p_name")).alias("category_code_raw"),
        F.when(F.col("p_size") % 7 == 0, F.lit("")).otherwise(F.col("p_brand")).alias("brand_raw"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("price_raw"),
        F.col("user_id").cast("string").alias("user_id_raw"),
        F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("-"),
                 F.date_format("ts", "yyyyMMdd")).alias("user_session_raw"),
        *lineage,
    )


def a4_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring requests from part: some ids non-numeric, some unknown."""
    pt = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    key = F.col("p_partkey")
    return pt.select(
        F.when(key % 10 == 0, F.concat(F.lit("sku-"), key.cast("string")))
         .when(key % 7 == 0, (key + 1000000).cast("string"))
         .otherwise(key.cast("string")).alias("product_id"),
        F.col("p_brand").alias("brand"),
        F.lower("p_type").alias("category"),
        F.col("p_retailprice").cast("double").alias("price"),
        F.col("p_size").cast("int").alias("prev_month_sales"),
    )
