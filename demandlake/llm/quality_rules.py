"""Quality rules with robust multivariate outliers.

Base counts of every text fail it by fixed rules.  The texts that pass are
judged by a minimum-covariance-determinant (MCD) estimate for their language
and source: the mean and covariance of the COVER share of rows whose
covariance has the least determinant.  A text whose transformed statistics
have a large Mahalanobis distance from the estimate is rejected.

The search for the least determinant starts from three deterministic estimates
side by side and takes concentration steps: measure all rows, keep the closest
COVER share of each group, estimate again, until the determinant falls no
more; the start that ends lowest wins.  Every step is two aggregates over all
rows; statistics and distances are whole numbers on a fixed grid, so sums are
exact and the closest share is found from counts by distance, without a sort.

Languages and all texts are estimated as well.  A group's estimate is pooled
with its language's, and that with all texts', as if the wider one were
PRIOR_ROWS further rows; so groups of any size are judged by one rule.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandlake.llm.common import keep_rows, row_keys, written

#: Share of a group's rows that the estimate covers.
COVER = 0.75
#: The covered rows lie too close together; for normal rows of five statistics the factor
#: COVER / P(chi2 of 7 <= the COVER quantile of chi2 of 5, 6.63) makes up for it.
CONSISTENCY = 0.75 / 0.532
#: The least fall of the determinant's log that is worth another step.
LEAST_FALL = 1e-6
#: Steps of a statistic's grid in one unit, and of a log distance.
GRID, LOG_GRID = 1024, 64
#: Rows that the wider estimate counts for.
PRIOR_ROWS = 50
#: Estimates of so many groups (some 400 bytes each) are broadcast; more are joined by group and salt.
BROADCAST_GROUPS = 20_000
#: Added standard deviation of each statistic, so that constant ones do not make every other value an outlier: for
#: symbols, lines and repeats what one symbol, one line and one repeated window change in a text of 200 words.
FLOOR = (0.25, 0.10, 0.405, 0.049, 0.262)
#: Squared distance beyond which a text is rejected: the 0.999 quantile of chi2 of 5, as there are five statistics.
LIMIT = 20.515

STATISTICS = ["log_words", "log_word_chars", "log_symbols", "log_dup_lines", "log_repeats"]


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, row keys, lang, source and the five base counts of every whole text; null text has no words."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        import numpy as np

        symbols = re.compile(rb"[^#*$%&|<>]+")

        def repeated(words: list[bytes]) -> int:
            """Words in 3-word windows that are found twice or more."""
            if len(words) < 4:
                return 0
            number: dict[bytes, int] = {}
            ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
            size = len(number)
            # Exact: below 2**21 different words, three of them fit into one number.
            if size < 1 << 21:
                windows = (ids[:-2] * size + ids[1:-1]) * size + ids[2:]
            else:
                pairs = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)[1]
                windows = pairs[:-1] * size + ids[2:]
            _, back, times = np.unique(windows, return_inverse=True, return_counts=True)
            twice = times[back] > 1
            if not twice.any():
                return 0
            inside = np.zeros(len(ids), bool)
            for k in range(3):
                inside[k: k + len(twice)] |= twice
            return int(inside.sum())

        def count(text: str) -> tuple[int, int, int, int, int]:
            raw = text.encode()
            words = raw.split()  # bytes.split() cuts at the six ASCII spaces only
            # Code points in words: all of the text without its ASCII spaces.
            spaces = sum(map(text.count, " \t\n\x0b\x0c\r"))
            lines = [line for line in raw.split(b"\n") if line.split()]
            return (len(words), len(text) - spaces, len(symbols.sub(b"", raw)), len(lines) - len(set(lines)), repeated(words))

        for b in batches:
            k = b.num_columns - 1
            found = [count(t or "") for t in b.column(k).to_pylist()]
            columns = list(zip(*found)) if found else [()] * 5
            yield pa.RecordBatch.from_arrays([b.column(j) for j in range(k)] + [pa.array(c, pa.int64()) for c in columns],
                                             [*b.schema.names[:k], "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"])

    slim = row_keys(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), "_id_key", "_text_key", F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(scan, "doc_id long, _id_key long, _text_key long, lang string, source string, n_words long, "
                                 "word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long")


def base_failed() -> Column:
    """The fixed rules."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def transformed() -> list[Column]:
    """STATISTICS on the grid, as longs: logs of counts, and of counts relative to words."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return [F.round(GRID * F.log(x.cast("double"))).cast("long").alias(name) for name, x in zip(STATISTICS, (
        n, F.greatest(F.col("word_chars"), F.lit(1)) / n, 1 + 100 * F.col("n_symbols") / n,
        1 + 10 * F.col("n_dup_lines") / n, 1 + 10 * F.col("n_repeat_words") / n))]


_K = range(len(STATISTICS))
_MEANS = [f"m{i}" for i in _K]
_COVARIANCES = [f"c{i}{j}" for i in _K for j in range(i + 1)]


def _attached(rows: DataFrame, table: DataFrame, groups: int, key: str = "_group") -> DataFrame:
    """rows joined to table by key, without moving all rows of a group to one task.

    Up to BROADCAST_GROUPS groups the table is broadcast and rows stay where
    they are; beyond, each group is spread over as many tasks as there are
    shuffle partitions.
    """
    if groups <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(table), key, "left").drop("_salt")
    salts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = table.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return rows.withColumn("_salt", F.pmod(F.col("_salt"), F.lit(salts))).join(spread, [key, "_salt"], "left").drop("_salt")


def _sums(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, h (number of rows), means and covariances in the statistics' units, from exact sums."""
    x = [F.col(s).cast("decimal(20,0)") for s in STATISTICS]
    sums = rows.groupBy(*keys).agg(
        F.count("*").alias("h"), *[F.sum(x[i]).alias(f"s{i}") for i in _K],
        *[F.sum(x[i] * x[j]).alias(f"q{i}{j}") for i in _K for j in range(i + 1)])
    mean = [F.col(f"s{i}").cast("double") / F.col("h") / GRID for i in _K]
    return sums.select(*keys, "h", *[mean[i].alias(f"m{i}") for i in _K], *[
        (F.col(f"q{i}{j}").cast("double") / F.col("h") / GRID ** 2 - mean[i] * mean[j]).alias(f"c{i}{j}")
        for i in _K for j in range(i + 1)])


def _matrices(t, scale: float, names: list[str] = _COVARIANCES):
    """The covariances of a frame's rows as matrices."""
    import numpy as np

    cov = np.zeros((len(t), len(STATISTICS), len(STATISTICS)))
    for name in names:
        i, j = int(name[-2]), int(name[-1])
        cov[:, i, j] = cov[:, j, i] = t[name].to_numpy(float) * scale
    return cov


def _with_inverse(estimates: DataFrame, scale: float, keys: list[str]) -> DataFrame:
    """estimates with w, the inverse of scale * covariance and floors, and its log determinant."""
    kinds = {f.name: f.dataType.simpleString() for f in estimates.schema.fields}

    def invert(batches):
        import numpy as np

        for t in batches:
            # The floor is added to the diagonal: a constant statistic then has exactly its floor.
            cov = _matrices(t, scale) + np.diag(np.square(FLOOR))
            out = t[[*keys, *_MEANS, *_COVARIANCES]].copy()
            out["w"] = list((np.linalg.inv(cov) if len(t) else cov).reshape(len(t), -1))
            out["logdet"] = np.linalg.slogdet(cov)[1] if len(t) else []
            yield out

    return estimates.mapInPandas(invert, ", ".join(f"{c} {kinds[c]}" for c in keys) + ", " + ", ".join(
        f"{c} double" for c in [*_MEANS, *_COVARIANCES]) + ", w array<double>, logdet double")


def _distance() -> Column:
    """Squared Mahalanobis distance from the joined estimate."""
    k = len(STATISTICS)
    d = [F.col(s) / GRID - F.col(f"m{i}") for i, s in enumerate(STATISTICS)]
    total = F.lit(0.0)
    for i in range(k):
        for j in range(k):
            total = total + d[i] * d[j] * F.col("w")[i * k + j]
    return F.greatest(total, F.lit(0.0))


def _bin(distance: Column) -> Column:
    """Number of the log distance on its grid."""
    return F.round(LOG_GRID * F.log(distance + 1e-6)).cast("int")


def _starts(rows: DataFrame, groups: int) -> DataFrame:
    """_group, start and an estimate of each of three kinds.

    0: medians and squared median deviations.  1: mean and covariance of all
    rows.  2: medians, and the covariance of the directions from them in units
    of the median deviations, scaled back.
    """
    # Medians come from a mergeable sketch with a rank error of a ten-thousandth.
    medians = written(rows.groupBy("_group").agg(*[F.percentile_approx(s, 0.5, 10_000).alias(f"a{i}") for i, s in enumerate(STATISTICS)]), "medians")
    away = _attached(rows, medians, groups).select("_group", *[F.abs(F.col(s) - F.col(f"a{i}")).alias(s) for i, s in enumerate(STATISTICS)])
    spreads = away.groupBy("_group").agg(*[F.percentile_approx(s, 0.5, 10_000).alias(f"b{i}") for i, s in enumerate(STATISTICS)])
    centre = written(medians.join(spreads, "_group"), "centres")
    mean = [(F.col(f"a{i}") / GRID).alias(f"m{i}") for i in _K]
    spread = [1.4826 * F.col(f"b{i}") / GRID for i in _K]
    plain = centre.select("_group", F.lit(0).alias("start"), *mean, *[
        (F.pow(spread[i], F.lit(2)) if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i in _K for j in range(i + 1)])
    classic = _sums(rows, ["_group"]).select("_group", F.lit(1).alias("start"), *_MEANS, *_COVARIANCES)
    # Directions are rounded to the grid, so that their sums are exact, too.
    unit = [(F.col(s) - F.col(f"a{i}")) / F.greatest(1.4826 * F.col(f"b{i}"), F.lit(FLOOR[i] * GRID)) for i, s in enumerate(STATISTICS)]
    length = F.sqrt(sum((u * u for u in unit), F.lit(0.0)))
    signs = _attached(rows, centre, groups).select("_group", *[
        F.round(GRID * F.when(length > 0, u / length).otherwise(0.0)).cast("long").alias(s) for u, s in zip(unit, STATISTICS)])
    signs = _sums(signs, ["_group"]).select("_group", *[F.col(c).alias(f"_{c}") for c in _COVARIANCES])
    scale = [F.greatest(spread[i], F.lit(FLOOR[i])) for i in _K]
    spatial = centre.join(signs, "_group").select("_group", F.lit(2).alias("start"), *mean, *[
        (len(STATISTICS) * F.col(f"_c{i}{j}") * scale[i] * scale[j]).alias(f"c{i}{j}") for i in _K for j in range(i + 1)])
    return plain.unionByName(classic).unionByName(spatial)


def mcd(rows: DataFrame) -> DataFrame:
    """_group, n, start, m0.., c00.., logdet of each group of rows(_group, _salt, STATISTICS).

    Rows are measured where they are; what is shuffled is one row of sums for
    each task, group and start, and one for each distance.  A start stops when
    its determinant falls no more; of equal determinants the first start wins.
    c00.. is the covariance of the covered rows, not yet made consistent.
    """
    sizes = written(rows.groupBy("_group").agg(F.count("*").alias("n")), "sizes")
    groups = sizes.count()
    keys = ["_group", "start"]
    best = None
    live = written(_with_inverse(_starts(rows, groups), 1.0, keys), "mcd-0")
    step = 0
    while not live.isEmpty():
        step += 1
        estimates = live.groupBy("_group").agg(F.collect_list(F.struct("start", *_MEANS, "w")).alias("_now"))
        each = _attached(rows, estimates, groups).select("_group", *STATISTICS, F.explode("_now").alias("_now"))
        measured = each.select("_group", *STATISTICS, "_now.*").withColumn("bin", _bin(_distance())).drop(*_MEANS, "w")
        at = measured.groupBy(*keys, "bin").agg(F.count("*").alias("rows"))
        # The nearest distance with COVER of the rows up to it: a group has at most some thousand distances.
        up_to = F.sum("rows").over(Window.partitionBy(*keys).orderBy("bin"))
        limit = written(at.join(sizes, "_group").withColumn("up_to", up_to).where(F.col("up_to") >= COVER * F.col("n"))
                        .groupBy(*keys).agg(F.min("bin").alias("limit")), f"limits-{step}")
        limits = limit.groupBy("_group").agg(F.map_from_entries(F.collect_list(F.struct("start", "limit"))).alias("_limits"))
        both = estimates.join(limits, "_group")
        near = (_attached(rows, both, groups).select("_group", *STATISTICS, "_limits", F.explode("_now").alias("_now"))
                .select("_group", *STATISTICS, "_limits", "_now.*").where(_bin(_distance()) <= F.col("_limits")[F.col("start")]))
        new = _with_inverse(_sums(near, keys), CONSISTENCY, keys)
        if best is None:
            best = written(new.withColumn("fell", F.lit(True)), f"mcd-{step}")
        else:
            # A start whose determinant fell takes the new estimate, any other keeps its own and is done.
            names = [c for c in new.columns if c not in keys]
            later = new.select(*keys, F.struct(*names).alias("_new"))
            fell = F.coalesce(F.col("_new.logdet") < F.col("logdet") - LEAST_FALL, F.lit(False))
            best = written(best.join(later, keys, "left").select(
                *keys, *[F.when(fell, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in names], fell.alias("fell")), f"mcd-{step}")
        live = best.where("fell").drop("fell")
    if best is None:
        best = live
    least = best.groupBy("_group").agg(F.min_by(F.struct("start", *_MEANS, *_COVARIANCES, "logdet"), F.struct("logdet", "start")).alias("_best"))
    return sizes.join(least, "_group").select("_group", "n", "_best.*")


def _pooled(fitted: DataFrame, sizes: DataFrame) -> DataFrame:
    """_g3, m0.., w: each group's estimate pooled with its language's, and that with all texts'.

    The wider estimate counts for PRIOR_ROWS rows: means and covariances are
    those of both sets of rows together, so a group that differs from its
    language widens the estimate towards itself.
    """
    def level(key: str, name: str) -> DataFrame:
        return fitted.select(F.col("_group").alias(key), F.col("n").alias(f"n{name}"), *[F.col(c).alias(f"{c[0]}{name}_{c[1:]}") for c in [*_MEANS, *_COVARIANCES]])

    whole = sizes.join(level("_g3", "z"), "_g3").join(level("_g2", "y"), "_g2").withColumn("_g1", F.lit("1:")).join(level("_g1", "x"), "_g1")

    def pool(batches):
        import numpy as np

        for t in batches:
            mean = cov = None
            for name in "xyz":  # from all texts to the group
                own = t[[f"m{name}_{i}" for i in _K]].to_numpy(float)
                of = _matrices(t, CONSISTENCY, [f"c{name}_{i}{j}" for i in _K for j in range(i + 1)])
                if mean is None:
                    mean, cov = own, of
                    continue
                share = (t[f"n{name}"] / (t[f"n{name}"] + PRIOR_ROWS)).to_numpy(float)[:, None]
                apart = own - mean
                cov = share[:, :, None] * of + (1 - share)[:, :, None] * cov + (share * (1 - share))[:, :, None] * apart[:, :, None] * apart[:, None, :]
                mean = share * own + (1 - share) * mean
            cov = cov + np.diag(np.square(FLOOR))
            out = t[["_g3"]].copy()
            for i in _K:
                out[f"m{i}"] = mean[:, i]
            out["w"] = list((np.linalg.inv(cov) if len(t) else cov).reshape(len(t), -1))
            yield out

    return whole.mapInPandas(pool, "_g3 string, " + ", ".join(f"{c} double" for c in _MEANS) + ", w array<double>")


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, row keys, base counts, base_failed, distance, outlier and kept of every row of docs.

    The estimates are made from texts that pass the base rules.  Null lang and
    null source are groups of their own.  Rows that fail the base rules have no
    distance.  Null and empty texts fail; repeated rows get the same verdict;
    an empty table gives no rows.
    """
    lang = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("null"))
    source = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))
    counted = written(
        base_counts(docs).withColumn("base_failed", base_failed()).withColumn("_salt", F.monotonically_increasing_id())
        .withColumns({"_g3": F.concat(F.lit("3:"), lang, F.lit("\x1f"), source), "_g2": F.concat(F.lit("2:"), lang)}), "base-counts")
    values = counted.select("*", *transformed())
    passed = values.where("not base_failed")
    # A row counts in its own group, in its language and in the whole.
    rows = written(passed.select(F.explode(F.array("_g3", "_g2", F.lit("1:"))).alias("_group"), "_salt", *STATISTICS), "mcd-rows")
    fitted = written(mcd(rows), "mcd")
    sizes = written(passed.select("_g3", "_g2").distinct(), "groups")
    pooled = written(_pooled(fitted, sizes), "pooled")
    return (_attached(values, pooled, sizes.count(), "_g3")
            .withColumn("distance", F.when(~F.col("base_failed"), _distance()))
            .withColumn("outlier", F.coalesce(F.col("distance") > LIMIT, F.lit(False)))
            .withColumn("kept", ~F.col("base_failed") & ~F.col("outlier")))


def kept(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, whole; one of each repeated row."""
    return keep_rows(docs, judged(docs).where("kept"))
