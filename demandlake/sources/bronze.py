"""Raw CSV files -> bronze lake table (partitioned by _load_month)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..schemas import BRONZE, MANIFEST, RAW_COLUMNS, RAW_CSV
from .lake import drop_path, rebalance


def read_events_csv(spark: SparkSession, uri: str, strict: bool = True) -> DataFrame:
    """Month CSV: 9 positional STRING columns, one header row skipped.

    strict=True rejects short/long rows (the warehouse rejects jagged rows);
    strict=False pads them with NULLs.
    """
    return (spark.read.schema(RAW_CSV)
            .option("header", True)
            .option("enforceSchema", True)
            .option("mode", "FAILFAST" if strict else "PERMISSIVE")
            .csv(uri))


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def load_id_for(load_month: str, run_id: str | None = None) -> str:
    """manual_<month> for hand runs, composer-style <run>_<month> for scheduled ones."""
    return f"composer_{run_id}_{load_month}" if run_id else f"manual_{load_month}"


def to_bronze(raw: DataFrame, source_uri, load_id, load_month, ingested_at=None) -> DataFrame:
    """Rename to *_raw, keep text as STRING, add the lineage columns."""
    lm = load_month if isinstance(load_month, Column) else X.parse_month(F.lit(load_month))
    ing = _lit(ingested_at) if ingested_at is not None else F.current_timestamp()
    return raw.select(
        *[F.col(c).cast("string").alias(f"{c}_raw") for c in RAW_COLUMNS],
        _lit(source_uri).alias("_source_uri"),
        ing.cast("timestamp").alias("_ingested_at"),
        _lit(load_id).alias("_load_id"),
        lm.alias("_load_month"),
    )


def replace_bronze_month(bronze_month: DataFrame, path: str, load_month: str) -> None:
    """DELETE the month's partition, then INSERT the new rows (idempotent).

    Dynamic partition overwrite replaces only partitions present in the
    new rows; an empty file would leave the old partition in place, so an
    empty month deletes its partition directory explicitly.
    """
    spark = bronze_month.sparkSession
    rows = bronze_month.where(F.col("_load_month") == X.parse_month(F.lit(load_month)))
    if rows.isEmpty():
        drop_path(spark, f"{path.rstrip('/')}/_load_month={load_month}-01")
        return
    (rebalance(rows, "_load_month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_load_month").parquet(path))


def replace_bronze_months(rows: DataFrame, path: str) -> None:
    """Reload every month present in rows (dynamic partition overwrite)."""
    (rebalance(rows, "_load_month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_load_month").parquet(path))


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BRONZE).parquet(path)


def read_manifest(spark: SparkSession, uri: str) -> DataFrame:
    return spark.read.schema(MANIFEST).option("multiLine", True).json(uri)


def split_raw_by_month(raw: DataFrame, out_path: str, first_full_month: str | None = None) -> None:
    """One CSV folder per calendar month (month=YYYY-MM), incomplete head skipped."""
    m = F.substring("event_time", 1, 7)
    df = raw.withColumn("month", m)
    if first_full_month:
        df = df.where(F.col("month") >= F.lit(first_full_month))
    rebalance(df, "month").write.mode("overwrite").partitionBy("month").option("header", True).csv(out_path)
