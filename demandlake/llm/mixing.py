"""Mixing sources to target weights by temperature.

A source's token share p becomes the weight p**a, normalised.  The exponent a
is bisected between 0 (all sources alike) and 1 (their shares) to the smallest
value at which the weights' entropy is at most the target and no source is
repeated more often than the limit.  The weights then become token budgets,
the smallest ones with which every source is read at least once, so no
document is lost.  A budget is filled by block permutations: each pass over a
source takes its documents in another hashed order, and the running token
count says in which block of the schedule a document stands, so every block
holds the sources in their weights.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandlake.llm.common import ASCII_SPACE, row_keys, running_offsets, written

#: The weights' entropy as a share of the entropy of equal weights; 1 leaves only the limit.
TARGET_ENTROPY = 1.0
#: No source is read more often than this.
MAX_EPOCHS = 2.0
#: Tokens in a block of the schedule.
BLOCK_TOKENS = 1_000_000
#: Bisection steps that one pass over the source table settles, and passes.
STEPS, PASSES = 5, 8
#: Documents of one source and pass that are numbered together.
SHARD_ROWS = 2_000


def tokens(text: Column) -> Column:
    """White-space words of a text, at least one so that empty texts are scheduled as well."""
    return F.greatest(F.regexp_count(F.coalesce(text, F.lit("")), F.lit(ASCII_SPACE.replace("[", "[^") + "+")), F.lit(1)).cast("long")


def source_table(rows: DataFrame) -> DataFrame:
    """_source, n_rows, tokens and share p of rows(_source, tokens)."""
    sums = rows.groupBy("_source").agg(F.count("*").alias("n_rows"), F.sum("tokens").alias("tokens"))
    total = sums.agg(F.sum("tokens")).first()[0] or 1
    return sums.withColumn("p", F.col("tokens") / F.lit(float(total)))


def exponent(sources: DataFrame, target_entropy: float = TARGET_ENTROPY, max_epochs: float = MAX_EPOCHS) -> float:
    """The smallest exponent in [0, 1] that meets both bounds; 1 where none below does.

    With a the entropy falls and so does the largest repetition, which is
    max p**(a-1) / min p**(a-1): both bounds hold from some point on.  One
    aggregate tries all exponents that the next STEPS bisection steps could
    ask for, so the source table never leaves Spark.
    """
    n = sources.count()
    if n < 2:
        return 1.0
    from math import log

    low, high = 0.0, 1.0
    cells = 1 << STEPS
    logs = sources.select(F.log("p").alias("l"))
    for _ in range(PASSES):
        tries = [low + (high - low) * k / cells for k in range(cells)]
        row = logs.agg(F.min("l").alias("least"), F.max("l").alias("most"), *[
            f for k, a in enumerate(tries) for f in (F.sum(F.exp(F.col("l") * a)).alias(f"z{k}"),
                                                     F.sum(F.exp(F.col("l") * a) * F.col("l")).alias(f"s{k}"))]).first()

        def meets(k: int) -> bool:
            a, z = tries[k], row[f"z{k}"]
            entropy = log(z) - a * row[f"s{k}"] / z
            repeats = (1 - a) * (row["most"] - row["least"])
            return entropy <= target_entropy * log(n) + 1e-12 and repeats <= log(max_epochs) + 1e-12

        if meets(0):
            return low
        below, above = 0, cells  # bisection over the tried exponents; high is known to do, or is the last resort
        while above - below > 1:
            middle = (below + above) // 2
            below, above = (below, middle) if meets(middle) else (middle, above)
        low, high = tries[below], (high if above == cells else tries[above])
    return high


def budgets(sources: DataFrame, a: float) -> DataFrame:
    """sources with weight and budget: tokens to draw, at least the source's own.

    The total is the largest tokens / weight, so the budgets have the target
    weights and the source with the largest share is read exactly once.
    """
    sums = sources.agg(F.sum(F.pow("p", F.lit(a))).alias("z"), F.max(F.col("tokens") / F.pow("p", F.lit(a))).alias("t")).first()
    z, total = (sums["z"] or 1.0), (sums["t"] or 0.0) * (sums["z"] or 1.0)
    weight = F.pow("p", F.lit(a)) / z
    return (sources.withColumn("weight", weight)
            .withColumn("budget", F.greatest(F.round(weight * total).cast("long"), F.col("tokens"))))


def _named(docs: DataFrame) -> DataFrame:
    """docs with row keys and _source, a name of the source that is never null."""
    return row_keys(docs).withColumn("_source", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null")))


def _key(epoch: Column) -> Column:
    return F.xxhash64("_id_key", "_text_key", "_source", epoch)


def _shard(key: Column) -> Column:
    return F.pmod(F.shiftrightunsigned(key, 32), F.ceil(F.col("n_rows") / SHARD_ROWS)).cast("int")


def schedule(docs: DataFrame, target_entropy: float = TARGET_ENTROPY, max_epochs: float = MAX_EPOCHS,
             block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per draw: doc_id, source, tokens, epoch, position, block, weight, exponent (and internal keys).

    position is the tokens that the source's draws hold before this one.  The
    last pass over a source ends with the document that meets the budget.
    Null text counts as empty, null sources are one source, repeated rows are
    drawn once each, and an empty table gives no rows.
    """
    rows = written(_named(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), "_id_key", "_text_key", "_source",
        F.col("source").cast("string").alias("source"), tokens(F.col("text")).alias("tokens")), "mix-rows")
    sources = written(source_table(rows), "mix-sources")
    a = exponent(sources, target_entropy, max_epochs)
    plan = budgets(sources, a).withColumnRenamed("tokens", "all_tokens").drop("p")
    epochs = F.sequence(F.lit(0), F.ceil(F.col("budget") / F.col("all_tokens")).cast("int") - 1)
    # The source table may be large: Spark measures it and picks the join.
    draws = written(rows.join(plan, "_source").withColumn("epoch", F.explode(epochs))
                    .withColumn("key", _key(F.col("epoch"))).withColumn("shard", _shard(F.col("key"))), "mix-draws")
    by = ["_source", "epoch", "shard"]
    before = running_offsets(draws.groupBy(*by).agg(F.sum("tokens").alias("n")), by[:2], "shard", "n", "before").drop("n")
    inside = Window.partitionBy(*by).orderBy("key", "_id_key", "_text_key").rowsBetween(Window.unboundedPreceding, -1)
    position = F.col("epoch") * F.col("all_tokens") + F.col("before") + F.col("inside")
    return (draws.withColumn("inside", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).join(before, by)
            .withColumn("position", position.cast("long")).where("position < budget")
            .withColumn("block", F.floor(F.col("position") / (F.col("weight") * block_tokens)).cast("long"))
            .withColumn("exponent", F.lit(a))
            .select("doc_id", "source", "tokens", "epoch", "position", "block", "weight", "exponent",
                    "_source", "shard", "key", "n_rows"))


def mixed(docs: DataFrame, target_entropy: float = TARGET_ENTROPY, max_epochs: float = MAX_EPOCHS,
          block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """docs as the schedule draws them: every row at least once, rows of raised sources as often as drawn.

    A pass takes its documents in the order of (shard, key), so the last one
    is cut at one such pair for each source: docs are joined to the table of
    sources only and their texts are not shuffled.  Rows that are equal in
    doc_id, text and source stand on the same side of the cut.
    """
    draws = schedule(docs, target_entropy, max_epochs, block_tokens)
    ends = written(draws.groupBy("_source").agg(
        F.max(F.struct("epoch", "shard", "key")).alias("end"), F.first("n_rows").alias("n_rows")), "mix-ends")
    key = _key(F.col("end.epoch"))
    last = F.struct(_shard(F.col("_last")).alias("shard"), F.col("_last").alias("key")) <= F.struct(
        F.col("end.shard").alias("shard"), F.col("end.key").alias("key"))
    times = F.col("end.epoch") + F.when(last, 1).otherwise(0)
    rows = _named(docs.select("doc_id", "text", "source", F.struct(*docs.columns).alias("_row")))
    return (rows.join(ends, "_source").withColumn("_last", key)
            .withColumn("_time", F.explode(F.sequence(F.lit(0), times))).where("_time > 0").select("_row.*"))
