"""Physical-plan properties that matter at scale."""

import tempfile

import pytest

from demandlake.operators import gold, metrics as M, silver
from demandlake.operators import hurdle as H


def plan(df) -> str:
    """The executed plan (after AQE, the final plan only)."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def lake_fct(spark, sf_dir):
    from demandlake.queries import a1_fct
    path = tempfile.mkdtemp(prefix="plans-") + "/fct"
    a1_fct(spark, sf_dir).write.partitionBy("event_date").parquet(path)
    return spark.read.parquet(path)


def test_dedup_combines_copies_before_the_shuffle(spark, sf_dir):
    from demandlake.queries import a1_bronze
    p = plan(silver.dedup_events(silver.valid_events(silver.parse_events(a1_bronze(spark, sf_dir)))))
    assert "partial_max" in p and "Window" not in p


def test_sessions_first_event_is_a_partial_aggregate(lake_fct):
    p = plan(silver.sessions(lake_fct))
    assert "partial_min_by" in p and "Window" not in p


def scans(df) -> list[str]:
    return [line for line in plan(df).split("\n") if "FileScan" in line]


@pytest.mark.parametrize("mart, state", [
    (gold.product_features_monthly, gold.product_attributes), (gold.user_features_monthly, gold.last_purchases),
    (gold.user_product_interactions_monthly, gold.last_views)])
def test_gold_marts_read_one_month_and_a_thin_history(spark, lake_fct, mart, state):
    df = mart(lake_fct, "1998-01-01")
    window, old = [], []
    for line in scans(df):
        assert "PartitionFilters: [isnotnull(event_date" in line
        (window if ">= 1997-12-01" in line else old).append(line)
    assert len(old) == 1 and window and "< 1997-12-01" in old[0]
    if state is not gold.product_attributes:
        assert "EqualTo(event_type" in old[0] and "price" not in old[0].split("ReadSchema")[-1]
    # with the state carried along, no scan goes behind the window, and the rows are the same
    before = state(gold.older(lake_fct, "1998-01-01")).persist()
    carried = mart(lake_fct, "1998-01-01", carried=before)
    assert carried.exceptAll(df).count() == 0 and df.exceptAll(carried).count() == 0
    before.unpersist()


def test_favourites_use_partial_aggregation(lake_fct):
    w = lake_fct.where(gold.in_window("1998-01-01"))
    p = plan(gold.favorite_category(w))
    assert "partial_min_by" in p and "Window" not in p


def test_ranking_metrics_never_window_the_rows_unpartitioned(spark):
    df = spark.range(0, 20000).selectExpr("cast(id % 3 = 0 as int) as label", "(id % 997) / 997.0 as p")
    r = M.ranking_metrics(df, "label", "p")
    r.collect()
    p = plan(r)
    # running sums are partitioned by the range partition id; the only
    # window without a partition key runs over one row per range partition
    assert "Window [sum(pos" in p and "windowspecdefinition(_pid" in p
    assert r.first()["auc_roc"] is not None


def test_blend_search_is_one_pass_without_joins(spark):
    df = spark.range(0, 1000).selectExpr("cast(id % 5 as double) as target_next_period",
                                         "cast(id % 3 as double) as pred_hard",
                                         "cast(id % 4 as double) as pred_baseline",
                                         "cast(id % 2 as double) as pred_soft")
    for out in (H.blend_search(df), H.model_comparison(df)):
        out.collect()
        p = plan(out)
        assert "Join" not in p and "Expand" not in p
        assert p.count("Exchange SinglePartition") <= 1


def test_a_session_with_a_third_of_the_rows_is_spread_over_tasks(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    rows = spark.range(0, 60_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 5000).cast("string"))).alias("user_session"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 7).alias("user_id"),
        F.timestamp_seconds(F.pmod(F.hash("id"), F.lit(1000))).alias("event_ts"), F.sha2(F.col("id").cast("string"), 256).alias("event_id"))
    per_shard = silver.ordered_shards(rows, ["user_session", "user_id"], ["event_ts", "event_id"]).groupBy("_shard").agg(
        F.count("*").alias("n"), F.count_if(F.col("user_session") == "hot").alias("hot")).collect()
    # shards are even, and as the hot session is more than one holds, it spans several
    assert len(per_shard) >= 4 and max(r.n for r in per_shard) < 1.5 * 60_000 / len(per_shard)
    assert sum(r.hot > 0 for r in per_shard) >= 2 and max(r.hot for r in per_shard) < 20_000
    got = silver.session_event_rank(rows)
    plain = rows.withColumn("event_rank_in_session", F.row_number().over(
        Window.partitionBy("user_session", "user_id").orderBy("event_ts", "event_id")))
    assert got.schema["event_rank_in_session"].dataType == plain.schema["event_rank_in_session"].dataType
    assert got.exceptAll(plain).count() == 0 and got.count() == 60_000


def test_stages_too_large_to_be_compiled_are_not_fused(spark, sf_dir):
    from demandlake import session as S
    S.configure(spark)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000  # what HotSpot compiles


def test_texts_of_a_part_are_made_before_the_join(spark, sf_dir):
    from demandlake.queries import a1_bronze
    p = plan(a1_bronze(spark, sf_dir))
    assert "stringsplitsql" in p and p.index("stringsplitsql") > p.rindex("Join")


def test_event_times_are_formatted_once_a_row(spark, sf_dir):
    from demandlake.queries import a1_fct
    assert plan(a1_fct(spark, sf_dir)).count("date_format(") == 1  # a filter below the parsing would do it again


def test_trim_strips_all_white_space_and_nothing_else(spark):
    from demandlake.functions import scalars as X
    texts = ["", " ", "a", " a", "a ", "a b", "　a ", "\x85", "é", " é ", "\x7f", " \x7f", "!~", "~\xa0", "a\x1f", "\x01a "]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    got = [(r["t"], r["c"]) for r in df.select("t", X.trim_ws("t").alias("c")).collect()]
    assert got == [(t, t.strip(X.WHITESPACE)) for t in texts] + [(None, None)]


def test_merged_tables_are_written_with_the_codec_of_events(spark, tmp_lake):
    import glob

    from demandlake import session as S
    from demandlake.sources import lake as L
    path, kind = f"{tmp_lake}/t", "k long, p int, v string"
    first = S.materialize(spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (3, 2, "c")], kind))
    second = S.materialize(spark.createDataFrame([(2, 1, "B"), (4, 3, "d")], kind))
    L.upsert(first, path, ["k"], "p", written=True)
    L.upsert(second, path, ["k"], "p", written=True)
    assert sorted(map(tuple, spark.read.parquet(path).select("k", "p", "v").collect())) == [(1, 1, "a"), (2, 1, "B"), (3, 2, "c"), (4, 3, "d")]
    files = glob.glob(f"{path}/p=*/*.parquet")
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_backfill_counts_buyers_apart_from_the_other_aggregates(spark, sf_dir):
    from demandlake.operators import gold
    from demandlake.queries import a1_fct
    lines = [x for x in plan(gold.product_features_backfill(a1_fct(spark, sf_dir))).splitlines() if "max_by(" in x]
    assert lines and not any("user_id" in x.split("functions=")[0] for x in lines)


def test_cached_frames_have_parts_of_bounded_rows(spark, monkeypatch):
    from pyspark.sql import functions as F

    from demandlake.plans import models as MD
    monkeypatch.setattr(MD, "CACHED_ROWS", 10)
    df = spark.range(0, 95, 1, 1).select(F.col("id").alias("product_id"), F.lit(1).alias("snapshot_date"))
    assert MD.spread(df).rdd.getNumPartitions() == 10 and MD.spread(df).count() == 95
    assert MD.spread(df.limit(5)).count() == 5


def test_slopes_of_a_logistic_model_are_summed_before_they_are_listed(spark):
    import numpy as np

    from demandlake.plans import models as MD
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] + rng.normal(size=400) > 0).astype(float)
    rows = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], "a double, b double, c double, label double")
    model = MD.logistic_pipeline({"params": {"C": 1.0, "max_iter": 2}}, ["a", "b", "c"], 400).fit(rows)
    found = MD.logistic_gradient(model, rows, 400, 1.0)
    text = plan(found)
    assert text.index("Generate") < text.lower().index("aggregate")
    z, w = x / x.std(axis=0, ddof=1), model.stages[-1].coefficients.toArray()
    d = 1 / (1 + np.exp(-(z @ w + model.stages[-1].intercept))) - y
    want = {**{f"coefficient_{i}": (d @ z[:, i]) / 400 + w[i] / 400 for i in range(3)}, "intercept": d.mean()}
    got = dict(map(tuple, found.collect()))
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_rows_are_compared_whole_by_the_deduplication(spark, sf_dir):
    from demandlake.queries import a1_fct
    lines = [x for x in plan(a1_fct(spark, sf_dir)).splitlines() if "partial_max(" in x]
    assert lines and not any("struct(" in x for x in lines)  # a struct in the aggregate is built and copied by field for every row


def test_joins_of_small_parts_hash_them_instead_of_sorting_both_sides(spark, sf_dir):
    from demandlake import session as S
    from demandlake.queries import a1_bronze
    S.configure(spark)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = a1_bronze(spark, sf_dir)
        rows = len(df.collect())
        p = plan(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "ShuffledHashJoin" in p and "SortMergeJoin" not in p and rows == a1_bronze(spark, sf_dir).count()


def test_product_snapshots_write_only_the_event_columns_that_they_read(spark, monkeypatch):
    from demandlake import queries as Q
    from demandlake.operators import features as FE
    from demandlake.schemas import FCT_EVENTS_COLUMNS
    texts = ["category_code", "category_l1", "category_l2", "category_l3", "brand", "user_session", "_source_uri", "_load_id"]
    events = spark.range(12).selectExpr(
        "concat('e', id) AS event_id", "timestamp'2020-10-05' + make_interval(0, id % 3) AS event_ts", "to_date(event_ts) AS event_date",
        "element_at(array('view', 'purchase', 'cart'), int(id % 3 + 1)) AS event_type", "id % 2 AS product_id", "id AS category_id",
        "cast(id AS decimal(38,9)) AS price", "id % 4 AS user_id", "event_ts AS _ingested_at", "event_date AS _load_month",
        *[f"concat('{t}', id) AS {t}" for t in texts])
    assert {*events.columns, "_loaded_at"} == {*FCT_EVENTS_COLUMNS, "_loaded_at"}
    written, real = [], Q.S.materialize
    monkeypatch.setattr(Q.S, "materialize", lambda df, *a: written.append(df.columns) or real(df, *a))
    monkeypatch.setattr(Q, "a1_fct", lambda *a, **k: events)
    got = Q.a1_training(spark, "").collect()
    assert written == [gold.PRODUCT_EVENT_COLUMNS]
    whole = FE.training_set(gold.product_features_backfill(events), silver.calendar_dates(events)).collect()
    assert len(got) == 4 and sorted(got) == sorted(whole)


def test_stages_too_large_for_the_optimizing_compiler_run_unfused(spark):
    from demandlake import session as S
    S.configure(spark)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) < 7491  # the fused parsing of silver, which C2 gave up on


def test_written_intermediates_leave_no_shuffle_files(spark):
    import time

    from pyspark.sql import functions as F

    from demandlake import session as S
    S.configure(spark)

    def shuffles():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}

    before = shuffles()
    table = S.materialize(spark.range(50_000).groupBy((F.col("id") % 1000).alias("k")).agg(F.count("*").alias("n")))
    until = time.time() + 10  # removed in the background
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before
    assert table.count() == 1000 and all(f.endswith(".zstd.parquet") for f in table.inputFiles())


def test_product_backfill_joins_nothing(spark):
    import datetime
    events = spark.createDataFrame(
        [("1", "purchase", 1, 7), ("2", "purchase", 1, 7), ("3", "purchase", 1, 8), ("4", "view", 2, 9), ("5", "purchase", 1, None), ("6", "purchase", None, 4)],
        "event_id string, event_type string, product_id long, user_id long").selectExpr(
        "*", "timestamp'2020-01-05' AS event_ts", "if(event_id = '3', null, date'2020-01-05') AS event_date", "'a' AS category_l1", "'b' AS category_l2",
        "'c' AS category_l3", "'x' AS brand", "cast(1 AS decimal(38,9)) AS price")
    got = gold.product_features_backfill(events)
    rows = sorted(((r.product_id, r.snapshot_date, r.product_purchase_count_last_month, r.product_unique_buyers_last_month) for r in got.collect()), key=str)
    day = datetime.date(2020, 2, 1)
    assert rows == sorted([(1, day, 3, 1), (1, None, 1, 1), (2, day, 0, 0), (None, day, 1, 1)], key=str)
    p = plan(got)
    assert "Join" not in p and p.count("hashpartitioning(product_id") <= 3  # buyers, product-months, products


@pytest.fixture()
def written(spark, monkeypatch):
    """The columns of what queries write on the way."""
    from demandlake import session as S
    seen, real = [], S.materialize
    monkeypatch.setattr(S, "materialize", lambda df, *a: seen.append(df.columns) or real(df, *a))
    return seen


def test_session_ranks_write_only_what_they_need(spark, sf_dir, written):
    from demandlake.queries import QUERIES
    QUERIES["session_event_rank"](spark, sf_dir)
    assert [sorted(c) for c in written] == [["_shard", "event_id", "event_ts", "user_id", "user_session"]]


def test_snapshot_of_one_month_reads_events_that_are_written_once(spark, sf_dir, written):
    from demandlake.queries import QUERIES
    p = plan(QUERIES["product_features_monthly_a1"](spark, sf_dir))
    assert written == [gold.PRODUCT_EVENT_COLUMNS] and "lineitem" not in p


def test_user_snapshots_write_only_the_event_columns_that_they_read(spark, sf_dir, written):
    from demandlake.queries import QUERIES
    QUERIES["user_features_backfill"](spark, sf_dir)
    assert written == [gold.USER_EVENT_COLUMNS]


@pytest.mark.parametrize("name", ["training_frame_from_lake", "snapshot_upsert"])
def test_stored_product_snapshots_are_made_from_product_events(spark, sf_dir, written, name):
    from demandlake.queries import QUERIES
    QUERIES[name](spark, sf_dir)
    assert written[0] == gold.PRODUCT_EVENT_COLUMNS and "user_session" not in sum(written, [])


def test_identities_order_as_bytes_as_they_do_as_text(spark):
    from pyspark.sql import functions as F
    ids = spark.range(2000).select(F.sha2(F.col("id").cast("string"), 256).alias("t")).withColumn("b", F.unhex("t"))
    assert [r.t for r in ids.orderBy("t").collect()] == [r.t for r in ids.orderBy("b").collect()]
