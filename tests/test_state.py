"""State carried from month to month, reloads that reach later snapshots, and merges that are interrupted."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from demandlake.operators import gold
from demandlake.plans import monthly as P
from demandlake.plans import state as ST
from demandlake.schemas import RAW_COLUMNS
from demandlake.sources import fixtures as FX
from demandlake.sources import lake as L

MONTHS = ["1998-01", "1998-02", "1998-03"]


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def lake(spark, sf_dir):
    """Three months; the first one lacks the events of some users, and is loaded again by a test."""
    import tempfile
    root = tempfile.mkdtemp(prefix="demandlake-state-")
    rows = FX.a1_bronze(spark, sf_dir).select(*[F.col(f"{c}_raw").alias(c) for c in RAW_COLUMNS],
                                              F.date_format("_load_month", "yyyy-MM").alias("month")).where(F.col("month").isin(*MONTHS))
    whole = rows.where("month = '1998-01'")
    some = F.pmod(F.hash("user_id"), F.lit(40)) == 0
    rows.where((F.col("month") != MONTHS[0]) | ~some).write.partitionBy("month").option("header", True).csv(os.path.join(root, "raw"))
    whole.drop("month").write.option("header", True).csv(os.path.join(root, "corrected"))
    assert whole.where(some).count() > 0
    results = P.backfill(spark, os.path.join(root, "lake"), [{"load_month": m} for m in MONTHS], raw_root=os.path.join(root, "raw"))
    return {"root": root, "lake": os.path.join(root, "lake"), "paths": results[-1]["paths"]}


def test_states_equal_their_whole_history(spark, lake):
    fct = spark.read.parquet(lake["paths"]["fct_events"])
    for name, (state, _) in ST.STATES.items():
        assert ST._dates(spark, lake["lake"], name) == ["1998-01-01", "1998-02-01", "1998-03-01", "1998-04-01"]
        for d in ("1998-02-01", "1998-04-01"):
            assert same(ST.before(spark, lake["lake"], name, fct, d), state(fct.where(F.col("event_date") < F.to_date(F.lit(d)))))


def test_a_month_reads_one_month_of_silver(spark, lake):
    fct = spark.read.parquet(lake["paths"]["fct_events"])
    for name, (mart, _, _) in P.MARTS.items():
        df = P.month_mart(spark, lake["lake"], name, fct, "1998-04-01")
        scans = [line for line in df._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in line]
        silver = [s for s in scans if "fct_events" in s]
        assert silver and all(">= 1998-03-01" in s and "< 1998-04-01" in s for s in silver)
        assert len(scans) == len(silver) + 1
        assert {f.split("as_of=")[1][:10] for f in df.inputFiles() if "as_of=" in f} == {"1998-03-01"}
        assert same(df, mart(fct, "1998-04-01"))
        assert same(df, spark.read.parquet(lake["paths"][name]).where("snapshot_date = '1998-04-01'"))


def test_joins_do_not_shuffle_the_bucketed_state(spark, lake):
    fct = spark.read.parquet(lake["paths"]["fct_events"])
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, (mart, carried, keys) in P.MARTS.items():
            path = ST._path(lake["lake"], carried, "1998-03-01")
            spark.sql(f"DROP TABLE IF EXISTS {L._bucketed_name(path)}")  # another session finds it by its layout
            df = P.month_mart(spark, lake["lake"], name, fct, "1998-04-01")
            lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
            at = next(i for i, line in enumerate(lines) if "FileScan" in line and "Bucketed: true" in line)
            depth = [len(line) - len(line.lstrip(" :+-*")) for line in lines]
            above, level = [], depth[at]
            for i in range(at - 1, -1, -1):  # from the scan up to its join
                if depth[i] < level:
                    level = depth[i]
                    above.append(lines[i])
                    if "Join" in lines[i]:
                        break
            assert "SortMergeJoin" in above[-1] and not any("Exchange" in line for line in above), above
            state, _ = ST.STATES[carried]
            later = state(fct.where("event_date >= '1998-03-01'"))
            assert same(ST.folded(carried, ST._read(spark, lake["lake"], carried, "1998-03-01"), later), state(fct))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_missing_states_are_made_from_earlier_ones(spark, lake):
    fct = spark.read.parquet(lake["paths"]["fct_events"])
    L.drop_path(spark, ST._path(lake["lake"], "last_views", "1998-03-01"))
    L.drop_path(spark, f"{ST._path(lake['lake'], 'last_views', '1998-02-01')}/{L.LAYOUT}")  # an unfinished one does not count
    made = ST.before(spark, lake["lake"], "last_views", fct, "1998-03-01")
    assert same(made, gold.last_views(fct.where("event_date < '1998-03-01'")))
    assert "1998-02-01" not in ST._dates(spark, lake["lake"], "last_views")


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_reload_of_an_early_month_equals_a_full_backfill(spark, lake, tmp_lake):
    before = {name: files(lake["paths"][name]) for name in P.MARTS}
    written = P.reload_month(spark, lake["lake"], MONTHS[0], os.path.join(lake["root"], "corrected"))
    whole = P.backfill_one_job(spark, lake["lake"], ["1998-02-01", "1998-03-01", "1998-04-01"], out_root=tmp_lake)
    untouched = 0
    for name in P.MARTS:
        assert same(spark.read.parquet(lake["paths"][name]), spark.read.parquet(whole[name]))
        assert written[name][0] == "1998-02-01"
        now = files(lake["paths"][name])
        for f, when in before[name].items():
            if not any(f"snapshot_date={d}" in f for d in written[name]):
                assert now[f] == when
                untouched += 1
    assert any(len(d) > 1 for d in written.values())  # later snapshots were reached
    assert ST._dates(spark, lake["lake"], "last_purchases") == ["1998-01-01"]
    # nothing changes when the same file comes again
    assert P.reload_month(spark, lake["lake"], MONTHS[0], os.path.join(lake["root"], "corrected")) == {n: [] for n in P.MARTS}


def test_untouched_snapshots_keep_their_files(spark, lake, tmp_lake):
    """One user's only event in the last month changes one snapshot; the earlier ones stay as files."""
    paths = lake["paths"]
    before = files(paths["user_features_monthly"])
    raw = FX.a1_bronze(spark, "/root/testdata/sf0.01").where("_load_month = DATE'1998-03-01'")
    rows = raw.select(*[F.col(f"{c}_raw").alias(c) for c in RAW_COLUMNS])
    one = rows.limit(1).withColumn("event_time", F.lit("1998-03-09 10:00:00 UTC")).withColumn("user_id", F.lit("999999999"))
    path = os.path.join(tmp_lake, "late")
    rows.unionByName(one).write.option("header", True).csv(path)
    written = P.reload_month(spark, lake["lake"], MONTHS[2], path)
    assert written["user_features_monthly"] == ["1998-04-01"]
    now = files(paths["user_features_monthly"])
    kept = {f: t for f, t in before.items() if "snapshot_date=1998-04-01" not in f}
    assert kept and all(now.get(f) == t for f, t in kept.items())


KIND = "k int, v string, d string"


def rows(spark, path):
    return sorted(((r.k, r.v, r.d) for r in spark.read.schema(KIND).parquet(path).collect()), key=str)


@pytest.mark.parametrize("step", ["_write_partitions", "drop_path"])
def test_an_interrupted_merge_is_finished(spark, tmp_lake, monkeypatch, step):
    path = os.path.join(tmp_lake, "t")
    L.upsert(spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "p=q/r"), (5, "e", None)], KIND), path, ["k"], "d")
    real, calls = getattr(L, step), []

    def failing(*args):
        calls.append(args)
        if step == "drop_path" and not str(args[1]).endswith(("d=x", "r")):
            return real(*args)
        raise OSError("lost")

    monkeypatch.setattr(L, step, failing)
    with pytest.raises(OSError, match="lost"):
        L.upsert(spark.createDataFrame([(1, "A", "y"), (3, "C", "y")], KIND), path, ["k"], "d")
    monkeypatch.undo()
    assert calls
    want = [(1, "A", "y"), (2, "b", "y"), (3, "C", "y"), (5, "e", None)]
    L.upsert(spark.createDataFrame([(4, "n", "z")], KIND), path, ["k"], "d")
    assert rows(spark, path) == sorted([*want, (4, "n", "z")], key=str)
    assert not L.recover(spark, path)


def test_a_merge_that_never_began_is_forgotten(spark, tmp_lake, monkeypatch):
    path = os.path.join(tmp_lake, "t")
    L.upsert(spark.createDataFrame([(1, "a", "x")], KIND), path, ["k"], "d")
    os.makedirs(os.path.join(path, L.JOURNAL))
    open(os.path.join(path, L.JOURNAL, "entry.json.draft"), "w").close()
    assert not L.recover(spark, path) and rows(spark, path) == [(1, "a", "x")]
    assert not os.path.exists(os.path.join(path, L.JOURNAL))


def test_a_merge_writes_its_rows_once_and_shuffles_them_only_if_they_stay(spark, tmp_lake, monkeypatch):
    path = os.path.join(tmp_lake, "t")
    L.upsert(spark.createDataFrame([(1, "a", "x"), (None, "n", "x"), (2, "b", "y"), (6, "f", "w")], KIND), path, ["k"], "d")
    untouched = sorted(os.listdir(os.path.join(path, "d=w")))
    calls, real = [], L._write_clustered
    monkeypatch.setattr(L, "_write_clustered", lambda df, at, *a: calls.append(at) or real(df, at, *a))
    merged = L.upsert(spark.createDataFrame([(1, "A", "x"), (3, "c", "z")], KIND), path, ["k"], "d")
    assert calls == [f"{path}/{L.JOURNAL}/merged"]  # and put in place by renaming
    assert rows(spark, path) == sorted([(1, "A", "x"), (None, "n", "x"), (2, "b", "y"), (3, "c", "z"), (6, "f", "w")], key=str)
    assert sorted(map(tuple, merged.collect()), key=str) == sorted([(1, "A", "x"), (None, "n", "x"), (3, "c", "z")], key=str)
    assert sorted(os.listdir(os.path.join(path, "d=w"))) == untouched and not os.path.exists(os.path.join(path, L.JOURNAL))


def test_a_merge_is_finished_from_any_of_its_renames(spark, tmp_lake, monkeypatch):
    path = os.path.join(tmp_lake, "t")
    L.upsert(spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], KIND), path, ["k"], "d")
    real, calls = L.drop_path, []

    def failing(spark, at):
        calls.append(at)
        if at.endswith("d=y"):
            real(spark, at)
            raise OSError("lost")  # the old partition is gone, the new one not yet in place
        return real(spark, at)

    monkeypatch.setattr(L, "drop_path", failing)
    with pytest.raises(OSError, match="lost"):
        L.upsert(spark.createDataFrame([(1, "A", "x"), (2, "B", "y")], KIND), path, ["k"], "d")
    monkeypatch.undo()
    assert L.recover(spark, path) and rows(spark, path) == [(1, "A", "x"), (2, "B", "y")]
    assert not L.recover(spark, path)


def test_partitions_of_a_column_with_an_underscore_are_merged(spark, tmp_lake):
    path, kind = os.path.join(tmp_lake, "t"), "k int, _m date"
    days = [datetime.date(2020, m, 1) for m in (1, 2, 3)]
    L.upsert(spark.createDataFrame([(1, days[0]), (2, days[1])], kind), path, ["k"], "_m")
    L.upsert(spark.createDataFrame([(2, days[1]), (3, days[2]), (4, days[0])], kind), path, ["k"], "_m")
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, days[0]), (2, days[1]), (3, days[2]), (4, days[0])]
    assert sorted(os.listdir(path))[-3:] == [f"_m={d}" for d in days]
