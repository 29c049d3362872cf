"""Pipeline drivers: run parameters, one monthly run, backfills."""

from __future__ import annotations

import re
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators import gold

#: mart -> (one snapshot, the state that it takes from its history, key columns)
MARTS = {
    "product_features_monthly": (gold.product_features_monthly, "product_attributes", ["product_id"]),
    "user_features_monthly": (gold.user_features_monthly, "last_purchases", ["user_id"]),
    "user_product_interactions_monthly": (gold.user_product_interactions_monthly, "last_views", ["user_id", "product_id"]),
}
BACKFILLS = {
    "product_features_monthly": gold.product_features_backfill,
    "user_features_monthly": gold.user_features_backfill,
    "user_product_interactions_monthly": gold.user_product_interactions_backfill,
}

MONTH_PATTERN = re.compile(r"^\d{4}-\d{2}$")


def object_path(load_month: Column | str) -> Column:
    m = F.lit(load_month) if isinstance(load_month, str) else load_month
    return F.concat(F.lit("events/month="), m, F.lit("/events_"), m, F.lit(".csv"))


def run_params(months: DataFrame, col: str = "load_month") -> DataFrame:
    """load_month -> snapshot_date (first day of the next month) and object path."""
    m = F.col(col)
    return months.select(
        m.alias("load_month"),
        F.date_format(F.add_months(X.parse_month(m), 1), "yyyy-MM-dd").alias("snapshot_date"),
        object_path(m).alias("gcs_object"),
    )


def compute_run_params(load_month: str) -> dict:
    """Driver-side twin of run_params for one month (validates the pattern)."""
    if not MONTH_PATTERN.match(load_month or ""):
        raise ValueError(f"load_month must look like YYYY-MM, got {load_month!r}")
    first = date.fromisoformat(f"{load_month}-01")  # raises ValueError for a month that is none
    snapshot = (first + timedelta(days=31)).replace(day=1)
    folder = f"month={load_month}"
    return {"load_month": load_month, "snapshot_date": snapshot.isoformat(),
            "gcs_object": "/".join(("events", folder, f"events_{load_month}.csv"))}


def run_month(spark, lake_root: str, load_month: str, raw_uri: str, run_id: str | None = None,
              strict: bool = True) -> dict:
    """One monthly run: CSV -> bronze (reload) -> silver upsert -> gold -> assertions.

    Every step reads and writes lake tables, so a lost executor only redoes
    its task and a failed run can be repeated (bronze reload and MERGE-style
    upserts are idempotent).  The marts read one month of silver and the state
    carried from the month before; later snapshots of an older month are left
    to reload_month.
    """
    from ..operators import quality
    from ..sources import lake as L
    from . import state

    params = compute_run_params(load_month)
    snap = params["snapshot_date"]
    p = table_paths(lake_root)
    bronze, fct, _ = load_events(spark, lake_root, p, load_month, raw_uri, run_id, strict)
    rebuild_unpartitioned(spark, p, fct)
    for name, (_, _, keys) in MARTS.items():
        L.snapshot_upsert(month_mart(spark, lake_root, name, fct, snap), p[name], ["snapshot_date", *keys], snap)
    state.advance(spark, lake_root, fct, snap)
    summary = quality.run_assertions(bronze, fct, load_month, snap)
    return {"params": params, "paths": p, "assertions": summary}


def table_paths(lake_root: str) -> dict[str, str]:
    """Folders of the tables that a run writes."""
    from ..sources import lake as L
    tables = {"bronze": ["raw_events"], "silver": ["fct_events", "calendar_dates", "sessions"],
              "gold": ["dim_calendar", "session_start", *MARTS]}
    return {name: L.table_path(lake_root, ns, name) for ns, names in tables.items() for name in names}


def month_mart(spark, lake_root: str, name: str, fct: DataFrame, snapshot_date) -> DataFrame:
    """One mart's rows of one snapshot: its month of events, and the state that is carried in the lake."""
    from . import state
    mart, carried, _ = MARTS[name]
    return mart(fct, snapshot_date, carried=state.before(spark, lake_root, carried, fct, state.window_start(snapshot_date)))


def load_events(spark, lake_root: str, p: dict, load_month: str, raw_uri: str, run_id: str | None = None,
                strict: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """CSV -> bronze (reload) -> silver upsert; returns bronze, silver and the rows of silver that changed.

    Carried states that a changed event makes wrong are dropped before silver is written.
    """
    from ..operators import silver
    from ..session import materialize
    from ..sources import bronze as B
    from ..sources import lake as L
    from . import state

    raw = B.read_events_csv(spark, raw_uri, strict=strict)
    month_rows = B.to_bronze(raw, raw_uri, B.load_id_for(load_month, run_id), load_month)
    B.replace_bronze_month(materialize(month_rows), p["raw_events"], load_month)
    L.publish(spark, "bronze.raw_events")
    bronze = B.read_bronze(spark, p["raw_events"])

    new_events = materialize(silver.fct_events(bronze, load_month=load_month, strict=strict))
    changed = materialize(silver_changes(spark, new_events, p["fct_events"]))
    first = changed.agg(F.min("event_date")).first()[0]
    if first is not None:
        state.drop_after(spark, lake_root, first)
    # event_id hashes event_ts, so a key cannot change its date
    L.upsert(new_events, p["fct_events"], ["event_id"], "event_date", key_fixes_partition=True,
             cluster_cols=["event_type", "product_id", "user_id"])
    return bronze, spark.read.parquet(p["fct_events"]), changed


def silver_changes(spark, new_events: DataFrame, path: str) -> DataFrame:
    """Signed row differences that an upsert of new_events makes in silver: +1 for a row that comes, -1 for one that goes.

    The time of loading is no difference.  Only the days that new_events hold
    are read from silver.
    """
    from ..sources import lake as L
    columns = [c for c in new_events.columns if c != "_loaded_at"]
    new = new_events.select(*columns)
    if not L.path_exists(spark, path):
        return new.withColumn("sign", F.lit(1))
    L.recover(spark, path)
    lo, hi = new.agg(F.min("event_date"), F.max("event_date")).first()
    if lo is None:
        return new.withColumn("sign", F.lit(1))
    stored = spark.read.schema(new_events.schema).parquet(path).where(F.col("event_date").between(F.lit(lo), F.lit(hi))).select(*columns)
    old = stored.join(new.select("event_id"), "event_id", "left_semi")
    return new.exceptAll(old).withColumn("sign", F.lit(1)).unionByName(old.exceptAll(new).withColumn("sign", F.lit(-1)))


def rebuild_unpartitioned(spark, p: dict, fct: DataFrame) -> None:
    """The calendar, the sessions and what follows from both: tables without snapshots, rebuilt whole."""
    from ..operators import silver
    from ..sources import lake as L
    cal = silver.calendar_dates(fct)
    L.materialize_table(cal, p["calendar_dates"], ["calendar_date"])
    cal = spark.read.parquet(p["calendar_dates"])
    L.materialize_table(silver.dim_calendar(cal), p["dim_calendar"], ["calendar_date"])
    L.materialize_table(silver.sessions(fct), p["sessions"], ["user_id", "session_start_date"])
    sess = spark.read.parquet(p["sessions"])
    L.materialize_table(silver.session_start(sess, cal), p["session_start"], ["user_id", "session_start_date"])


def reload_month(spark, lake_root: str, load_month: str, raw_uri: str, run_id: str | None = None, strict: bool = True) -> dict:
    """Load a month's corrected file again and carry the change into every snapshot it reaches.

    The changed rows of silver name the products, users and pairs whose rows
    may differ; those are recomputed for all snapshots from the first changed
    day on, from their own events only, and compared with what is stored.  Only
    snapshots with a differing row are written; the files of others stay as
    they are.  Snapshots that are not stored are not made.  Returns the
    rewritten snapshot dates by mart.
    """
    from ..session import materialize
    from ..sources import lake as L

    p = table_paths(lake_root)
    _, fct, changed = load_events(spark, lake_root, p, load_month, raw_uri, run_id, strict)
    first = changed.agg(F.min("event_date")).first()[0]
    written: dict[str, list[str]] = {name: [] for name in MARTS}
    if first is None:
        return written
    rebuild_unpartitioned(spark, p, fct)
    for name, (_, _, keys) in MARTS.items():
        if not L.path_exists(spark, p[name]):
            continue
        L.recover(spark, p[name])
        stored = spark.read.parquet(p[name])
        dates = [r[0] for r in stored.where(F.col("snapshot_date") > F.lit(first)).select("snapshot_date").distinct().collect()]
        if not dates:
            continue
        events = fct.join(changed.select(*keys).distinct(), keys, "left_semi")
        fresh = BACKFILLS[name](events, dates)
        differing = materialize(fresh.exceptAll(stored.select(*fresh.columns)))
        hit = sorted(r[0] for r in differing.select("snapshot_date").distinct().collect())
        if hit:
            L.upsert(differing, p[name], ["snapshot_date", *keys], "snapshot_date", target_filter=F.col("snapshot_date").isin(hit),
                     key_fixes_partition=True, cluster_cols=keys)
        written[name] = [str(d) for d in hit]
    return written


def backfill(spark, lake_root: str, manifest: list[dict], raw_root: str | None = None, **kw) -> list[dict]:
    """Serialized monthly runs in manifest order (one active run at a time)."""
    out = []
    for item in sorted(manifest, key=lambda r: r["load_month"]):
        uri = item.get("uri") or item.get("gcs_uri")
        if raw_root:
            uri = f"{raw_root.rstrip('/')}/month={item['load_month']}"
        out.append(run_month(spark, lake_root, item["load_month"], uri, **kw))
    return out


def backfill_one_job(spark, lake_root: str, snapshot_dates=None, out_root: str | None = None) -> dict:
    """All gold snapshots from the stored silver in one job per mart.

    The one-job marts (one grouped pass + running window per key) replace
    N serialized runs; each mart is written with dynamic partition overwrite
    on snapshot_date, so only the recomputed snapshots are replaced.
    Without snapshot_dates every month present in silver is produced.
    """
    from ..sources import lake as L

    fct = spark.read.parquet(L.table_path(lake_root, "silver", "fct_events"))
    root = out_root or lake_root
    paths = {}
    for name, mart in BACKFILLS.items():
        df = mart(fct, snapshot_dates)
        path = L.table_path(root, "gold", name)
        (L.rebalance(df, "snapshot_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("snapshot_date").parquet(path))
        paths[name] = path
    return paths
