"""Data-quality assertions: each returns the violating rows (pass = 0 rows)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as X
from .silver import bronze_month_scan


def _key_missing() -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in
                                       ["event_id", "user_id", "product_id", "user_session", "event_ts"]])


def _type_invalid() -> Column:
    # NOT IN keeps three-valued logic: a NULL type is not flagged.
    return ~F.col("event_type").isin(*X.VALID_EVENT_TYPES)


def assert_events_primary_keys(fct: DataFrame) -> DataFrame:
    return fct.where(_key_missing()).select("event_id")


def assert_load_month_in_bronze(bronze: DataFrame, load_month: str) -> DataFrame:
    counted = bronze_month_scan(bronze, load_month).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.where(F.col("row_count") == 0).select(
        F.concat(F.lit("No bronze rows for load_month="), F.lit(load_month)).alias("error"))


def assert_snapshot_date_after_events(fct: DataFrame, snapshot_date) -> DataFrame:
    m = fct.agg(F.max("event_date").alias("max_event_date"))
    return m.where(F.col("max_event_date") >= F.to_date(F.lit(str(snapshot_date))))


def assert_valid_event_types(fct: DataFrame) -> DataFrame:
    return fct.where(_type_invalid()).select("event_type")


def assertions(bronze: DataFrame, fct: DataFrame, load_month: str, snapshot_date) -> dict[str, DataFrame]:
    return {
        "assert_events_primary_keys": assert_events_primary_keys(fct),
        "assert_load_month_in_bronze": assert_load_month_in_bronze(bronze, load_month),
        "assert_snapshot_date_after_events": assert_snapshot_date_after_events(fct, snapshot_date),
        "assert_valid_event_types": assert_valid_event_types(fct),
    }


def assertion_summary(bronze: DataFrame, events: DataFrame, load_month: str, snapshot_date,
                      dated: DataFrame | None = None) -> DataFrame:
    """One row per assertion: name and violation count.

    One aggregate over the events checks keys, types and the latest date, one
    over the loaded month counts its rows.  dated holds the events whose dates
    are checked where the keys and types are checked on others (rows before
    the validity filter).
    """
    late = F.coalesce(F.max("event_date") >= F.to_date(F.lit(str(snapshot_date))), F.lit(False)).cast("long")
    counts = {"assert_events_primary_keys": F.count_if(_key_missing()), "assert_valid_event_types": F.count_if(_type_invalid())}
    dates = {"assert_snapshot_date_after_events": late}
    loaded = {"assert_load_month_in_bronze": (F.count(F.lit(1)) == 0).cast("long")}
    parts = [(events, counts | dates)] if dated is None else [(events, counts), (dated, dates)]
    parts.append((bronze_month_scan(bronze, load_month), loaded))

    def rows(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
        one = df.agg(*[c.alias(name) for name, c in checks.items()])
        return one.select(F.inline(F.array(*[F.struct(F.lit(name).alias("assertion"), F.col(name).alias("violations"))
                                             for name in checks])))
    return reduce(DataFrame.unionByName, [rows(*part) for part in parts])


class AssertionFailed(RuntimeError):
    pass


def run_assertions(bronze: DataFrame, fct: DataFrame, load_month: str, snapshot_date) -> dict[str, int]:
    """Evaluate all assertions (four counts) and fail on any."""
    summary = {r["assertion"]: int(r["violations"])
               for r in assertion_summary(bronze, fct, load_month, snapshot_date).collect()}
    failed = {k: v for k, v in summary.items() if v}
    if failed:
        raise AssertionFailed(f"assertions failed: {failed}")
    return summary
