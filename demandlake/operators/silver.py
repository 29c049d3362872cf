"""Silver layer: typed, validated, deduplicated events; sessions; calendar."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..functions.aggregates import countif, first_by
from ..schemas import CALENDAR_COLUMNS, FCT_EVENTS_COLUMNS

NATURAL_KEY = ["event_ts", "event_type", "product_id", "user_id", "user_session"]
LINEAGE = ["_source_uri", "_ingested_at", "_load_id", "_load_month"]


def bronze_month_scan(bronze: DataFrame, load_month: str) -> DataFrame:
    """Bronze pruned to one _load_month (a partition filter on the lake)."""
    return bronze.where(F.col("_load_month") == X.parse_month(F.lit(load_month)))


def parse_events(bronze: DataFrame, strict: bool = True) -> DataFrame:
    """Raw strings -> typed event columns (before validity filtering)."""
    ts = X.parse_event_ts("event_time_raw", strict=strict)
    return bronze.select(
        ts.alias("event_ts"),
        F.to_date(ts).alias("event_date"),
        F.lower(X.trim_ws("event_type_raw")).alias("event_type"),
        X.safe_bigint("product_id_raw").alias("product_id"),
        X.safe_bigint("category_id_raw").alias("category_id"),
        X.clean_text("category_code_raw").alias("category_code"),
        X.clean_lower("brand_raw").alias("brand"),
        X.safe_numeric("price_raw").alias("price"),
        X.safe_bigint("user_id_raw").alias("user_id"),
        X.clean_text("user_session_raw").alias("user_session"),
        *LINEAGE,
    )


def validity(df: DataFrame):
    """The silver validity predicate."""
    return (
        F.col("event_ts").isNotNull()
        & F.col("event_type").isin(*X.VALID_EVENT_TYPES)
        & F.col("product_id").isNotNull()
        & F.col("user_id").isNotNull()
        & F.col("user_session").isNotNull()
        & (F.col("price").isNull() | (F.col("price") >= 0))
    )


def valid_events(parsed: DataFrame) -> DataFrame:
    return parsed.where(validity(parsed))


# Ordering of re-delivered copies of one event, newest first; every column
# descends with NULLs last, which is exactly the order of max() over a
# struct (NULL fields compare lowest).  The trailing columns only make the
# choice deterministic when _ingested_at ties.
DEDUP_ORDER = ["_ingested_at", "price", "brand", "category_code", "category_id", "_load_id",
               "_source_uri", "_load_month", "event_date"]


def dedup_events(valid: DataFrame) -> DataFrame:
    """One row per natural key: the newest _ingested_at wins.

    Runs after the validity filter (WHERE precedes QUALIFY), so an older
    valid copy wins over a newer invalid one.  Expressed as max(struct) per
    key rather than a rank window: the aggregate combines copies on the map
    side before the shuffle, so even a single event re-delivered into a
    third of all rows never lands in one task.
    """
    return _newest(valid, F.lit(True))


def dedup_valid_events(parsed: DataFrame) -> DataFrame:
    """dedup_events(valid_events(parsed)), with the predicate inside the aggregate.

    A filter would move below the parsing and compute the parsed columns a
    second time there; here each column is parsed once per row.
    """
    return _newest(parsed, validity(parsed))


def _newest(df: DataFrame, counts: Column) -> DataFrame:
    """The newest row that counts of each natural key; keys without one are left out.

    The struct is made before the aggregate, which then compares and copies
    it as a whole instead of building it from its fields for every row.
    """
    rows = df.select(*NATURAL_KEY, F.when(counts, F.struct(*[F.col(c) for c in DEDUP_ORDER])).alias("_row"))
    agg = rows.groupBy(*NATURAL_KEY).agg(F.max("_row").alias("_best")).where(F.col("_best").isNotNull())
    return agg.select(*[F.col(c) if c in NATURAL_KEY else F.col(f"_best.{c}").alias(c)
                        for c in df.columns])


def with_identity_and_levels(df: DataFrame) -> DataFrame:
    return df.select(
        X.event_identity(*[F.col(c) for c in NATURAL_KEY]).alias("event_id"),
        "event_ts", "event_date", "event_type", "product_id", "category_id", "category_code",
        X.category_level("category_code", 0).alias("category_l1"),
        X.category_level("category_code", 1).alias("category_l2"),
        X.category_level("category_code", 2).alias("category_l3"),
        "brand", "price", "user_id", "user_session", *LINEAGE,
    )


def fct_events(bronze: DataFrame, load_month: str | None = None, strict: bool = True,
               with_loaded_at: bool = True) -> DataFrame:
    """silver.fct_events from bronze (one month, or all months at once).

    All months at once equals the union of the single-month runs because the
    natural key contains event_ts and a month's events never leave it.
    """
    src = bronze_month_scan(bronze, load_month) if load_month else bronze
    out = with_identity_and_levels(dedup_valid_events(parse_events(src, strict)))
    if with_loaded_at:
        out = out.withColumn("_loaded_at", F.current_timestamp())
        return out.select(*FCT_EVENTS_COLUMNS)
    return out


def ordered_shards(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """df, written once, with `_shard`: its rows in ranges of (keys, order).

    A key with many rows spans several shards, so no shard grows with a key.
    """
    from ..session import materialize
    return materialize(df.repartitionByRange(*keys, *order).withColumn("_shard", F.spark_partition_id()))


def session_event_rank(fct: DataFrame) -> DataFrame:
    """ROW_NUMBER() per (user_session, user_id) ordered by (event_ts, event_id).

    All columns of fct are written on the way: give it only those that are needed.
    Rows are ranked inside ranges of the whole order; a session that spans
    several ranges adds the rows of its earlier ones, from a table with one row
    per session and range.  So one huge session is not sorted in a single task.
    """
    keys, order = ["user_session", "user_id"], ["event_ts", "event_id"]
    placed = ordered_shards(fct, keys, order)
    earlier = Window.partitionBy(*keys).orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(*keys, "_shard").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(*[F.col(c).alias(f"_{c}") for c in keys], F.col("_shard").alias("_in"),
                           F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")).where("_before > 0")
    inside = F.row_number().over(Window.partitionBy(*keys, "_shard").orderBy(*order))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys] + [F.col("_shard") == F.col("_in")]
    return placed.withColumn("_inside", inside).join(before, same, "left").select(
        *fct.columns, (F.col("_inside") + F.coalesce("_before", F.lit(0))).cast("int").alias("event_rank_in_session"))


FIRST_FIELDS = ["event_type", "product_id", "category_l1", "category_l2", "category_l3", "brand", "price"]


def sessions(fct: DataFrame) -> DataFrame:
    """silver.sessions: one row per (user_session, user_id).

    The first event's attributes come from a min_by aggregate over
    (event_ts, event_id) instead of a rank window: it aggregates partially
    on the map side, so one huge session is not sorted in a single task.
    """
    first = first_by(F.struct(*FIRST_FIELDS), "event_ts", "event_id")
    agg = fct.groupBy("user_session", "user_id").agg(
        F.min("event_ts").alias("session_start_ts"),
        first.alias("_first"),
        F.count(F.lit(1)).alias("event_count"),
        countif(F.col("event_type") == "view").alias("view_count"),
        countif(F.col("event_type") == "cart").alias("cart_count"),
        countif(F.col("event_type") == "purchase").alias("purchase_count"),
    )
    return agg.select(
        "user_session", "user_id", "session_start_ts",
        F.to_date("session_start_ts").alias("session_start_date"),
        *[F.col(f"_first.{c}").alias(f"first_{c}") for c in FIRST_FIELDS],
        "event_count", "view_count", "cart_count", "purchase_count",
    )


def calendar_from_bounds(bounds: DataFrame) -> DataFrame:
    """Date spine min-7 .. max+7 with its attributes (no rows for NULL bounds)."""
    spine = bounds.select(F.explode(F.sequence(F.date_sub("lo", 7), F.date_add("hi", 7))).alias("calendar_date"))
    d = F.col("calendar_date")
    return spine.select(
        d,
        F.month(d).alias("month"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofweek(d).alias("day_of_week"),
        X.is_weekend(d).alias("is_weekend"),
        X.days_to_month_end(d).alias("days_to_end_of_month"),
    )


def calendar_dates(fct: DataFrame) -> DataFrame:
    """silver.calendar_dates: one global min/max aggregate, then a spine.

    The spine has one row per day between the first and the last event, so
    its size is bounded by the date range, not by the event volume.
    """
    bounds = fct.agg(F.min("event_date").alias("lo"), F.max("event_date").alias("hi"))
    return calendar_from_bounds(bounds)


def dim_calendar(calendar: DataFrame) -> DataFrame:
    return calendar.select(*CALENDAR_COLUMNS)




def session_start(sess: DataFrame, calendar: DataFrame) -> DataFrame:
    """gold.session_start: sessions + hour and weekend flag of the start day.

    The calendar has one row per day of the data's date range, and a single
    wrong date can stretch that, so Spark measures it and picks the join.
    """
    cal = calendar.select("calendar_date", "is_weekend")
    j = sess.join(cal, F.to_date(sess.session_start_ts) == cal.calendar_date, "left")
    return j.select(
        "user_session", "user_id", "session_start_ts", "session_start_date",
        "first_event_type", "first_product_id", "first_category_l1", "first_category_l2",
        "first_category_l3", "first_brand", "first_price",
        F.hour("session_start_ts").alias("hour_of_day"),
        "is_weekend",
    )
