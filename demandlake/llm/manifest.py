"""Merkle manifest of a dataset with retained hash states.

Each row of the dataset is a leaf; the leaves of a source in order of doc_id,
and the sources in order of name, form trees in which FANOUT neighbours hash to
their parent.  A parent keeps a copy of its running SHA-256 state before each
child slot.  To fold a changed child upwards, the state before its slot is
resumed with the new digest and the siblings to its right; the siblings to its
left are never hashed again.

Rows travel in runs of RUN consecutive leaves, which is three levels of the
tree, so no task holds more of a source than that; the tops of the runs are
the leaves of the next round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandlake.llm.common import written

FANOUT = 16
LEVELS = 3
RUN = FANOUT**LEVELS
_STEP = "array<struct<slot: int, digests: array<string>>>"


def field(value: Column) -> Column:
    """`-` for null, else the UTF-8 byte count, `:` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column) -> Column:
    """The digest of a row of documents whose text is given."""
    parts = [F.col("doc_id").cast("long"), F.col("source"), F.col("lang"), F.col("n_chars").cast("long"), text]
    return F.sha2(F.concat(*map(field, parts)), 256)


def lowered(text: Column) -> Column:
    """text with A-Z in lower case and nothing else changed."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


class Parent:
    """A node over a run of child digests, with the hash state before each child."""

    __slots__ = ("digests", "states", "digest")

    def __init__(self, digests: list[str]):
        state = hashlib.sha256()
        self.digests, self.states = digests, []
        for child in digests:
            self.states.append(state.copy())
            state.update(child.encode())
        self.digest = state.hexdigest()

    def fold(self, slot: int, digest: str) -> str:
        """This node's digest with another child in slot."""
        state = self.states[slot].copy()
        state.update("".join([digest, *self.digests[slot + 1:]]).encode())
        return state.hexdigest()

    def siblings(self, slot: int) -> str:
        """The other children's digests, left to right."""
        return "".join(self.digests[:slot] + self.digests[slot + 1:])


def grow(digests: list[str], alone: bool) -> list[list[Parent]]:
    """The levels above one run of nodes, lowest first.

    A run that is all of its tree grows until one node is left; one of many
    grows by LEVELS levels, also where it is short.
    """
    levels: list[list[Parent]] = []
    while (alone and len(digests) > 1) or (not alone and len(levels) < LEVELS):
        levels.append([Parent(digests[i:i + FANOUT]) for i in range(0, len(digests), FANOUT)])
        digests = [p.digest for p in levels[-1]]
    return levels


def steps(levels: list[list[Parent]], at: int) -> list[tuple[Parent, int]]:
    """The parents above node `at` of a run and its slots in them, lowest first."""
    found = []
    for parents in levels:
        found.append((parents[at // FANOUT], at % FANOUT))
        at //= FANOUT
    return found


def _tops(key: str):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("position")
        digests = rows["digest"].tolist()
        levels = grow(digests, rows["n"].iat[0] <= RUN)
        return pd.DataFrame({key: [rows[key].iat[0]], "position": [rows["run"].iat[0]], "n": [-(-rows["n"].iat[0] // RUN)],
                             "digest": [levels[-1][0].digest if levels else digests[0]]})
    return run


def _paths(key: str):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("position")
        levels = grow(rows["digest"].tolist(), rows["n"].iat[0] <= RUN)
        path = [[{"slot": slot, "digests": parent.digests} for parent, slot in steps(levels, i)] for i in range(len(rows))]
        return pd.DataFrame({key: rows[key], "position": rows["position"], "path": path})
    return run


def _runs(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("run", F.floor(F.col("position") / RUN).cast("long"))


def tops(nodes: DataFrame, key: str = "tree") -> DataFrame:
    """(key, position, n, digest): the node above each run of nodes(key, position, n, digest).

    n is the number of nodes of the same tree on the same level.
    """
    kind = nodes.schema[key].dataType.simpleString()
    return written(_runs(nodes).groupBy(key, "run").applyInPandas(_tops(key), f"{key} {kind}, position long, n long, digest string"), "tops")


def climbed(nodes: DataFrame, key: str = "tree") -> tuple[DataFrame, DataFrame]:
    """(key, digest) of the roots, and (key, position, path) of each node up to its root.

    A path lists, lowest level first, the slot of the node's ancestor and all
    digests of its run.  One round per three levels; each round has a 4096th
    of the rows of the round before.
    """
    kind = nodes.schema[key].dataType.simpleString()
    path = _runs(nodes).groupBy(key, "run").applyInPandas(_paths(key), f"{key} {kind}, position long, path {_STEP}")
    up = tops(nodes, key)
    if up.where("n > 1").isEmpty():
        return up.select(key, "digest"), path
    done = up.where("n = 1").select(key, "digest")
    roots, above = climbed(up.where("n > 1"), key)
    above = above.select(F.col(key).alias("_key"), F.col("position").alias("_run"), F.col("path").alias("_above"))
    path = (_runs(path).join(above, F.col("_key").eqNullSafe(F.col(key)) & (F.col("_run") == F.col("run")), "left")
            .select(key, "position", F.concat("path", F.coalesce("_above", F.array().cast(_STEP))).alias("path")))
    return done.unionByName(roots), path


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, source, leaf, changed (null where the row isn't tampered with), position and n in its source.

    Rows are dealt to ranges of (source, doc_id, leaf), so a source with many
    rows is spread over many; rows that are equal in all of these take their
    places by their order in the input.  A row's place is its place inside its
    range, less that of the source's first row there, plus the source's rows in
    earlier ranges.
    """
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    tampered = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 5 == 0
    rows = written(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), leaf(text).alias("leaf"),
        F.when(tampered, leaf(lowered(text))).alias("changed"), F.monotonically_increasing_id().alias("_nth")), "leaves")
    order = ["source", "doc_id", "leaf", "_nth"]
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = written(rows.repartitionByRange(spread, *order).sortWithinPartitions(*order).drop("_nth")
                     .withColumn("_at", F.monotonically_increasing_id()), "placed")
    placed = placed.withColumn("_range", F.shiftright("_at", 33))
    # One row per range and source.
    counts = placed.groupBy("_range", "source").agg(F.count("*").alias("rows"), F.min("_at").alias("first"))
    each = Window.partitionBy("source")
    counts = counts.select(
        F.col("_range").alias("_r"), F.col("source").alias("_s"), "first", F.sum("rows").over(each).alias("n"),
        F.coalesce(F.sum("rows").over(each.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return written(placed.join(counts, (F.col("_range") == F.col("_r")) & F.col("source").eqNullSafe(F.col("_s")))
                   .select("doc_id", "source", "leaf", "changed", (F.col("_at") - F.col("first") + F.col("before")).alias("position"),
                           F.col("n").cast("long").alias("n")), "positions")


def _folded(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> Iterator[pd.DataFrame]:
    rows = rows.sort_values("position")
    levels = grow(rows["leaf"].tolist(), rows["n"].iat[0] <= RUN)
    upper = [(Parent(list(step["digests"])), int(step["slot"])) for step in above["path"].iat[0]]
    upper_siblings = "".join(p.siblings(slot) for p, slot in upper)
    subroot, root = above["subroot"].iat[0], above["root"].iat[0]
    out = []
    for i, (own, changed) in enumerate(zip(rows["leaf"], rows["changed"])):
        path, digest = steps(levels, i), changed or own
        proof = hashlib.sha256("".join([*(p.siblings(slot) for p, slot in path), upper_siblings]).encode()).hexdigest()
        for parent, slot in path:
            digest = parent.fold(slot, digest)
        for parent, slot in upper:
            digest = parent.fold(slot, digest)
        out.append((proof, digest, digest == root))
    yield (rows[["doc_id", "leaf"]].reset_index(drop=True).assign(subroot=subroot, root=root)
           .join(pd.DataFrame(out, columns=["proof_sha256", "folded_root", "verified"])))


def audit(docs: DataFrame) -> DataFrame:
    """Every row of docs with its leaf, subroot, root, proof and the root folded from a tampered copy.

    Null fields count as `-`, a null source is a source of its own and comes
    first, as null ids do in a source; repeated ids follow each other by leaf,
    repeated rows take places of their own.  Other columns are not read.  An
    empty table gives no row.  Which rows are tampered with, and how, is fixed:
    where 5 divides the crc32 of doc_id, A-Z of the text become lower case.
    """
    rows = leaves(docs)
    first = tops(rows.select("source", "position", "n", F.col("leaf").alias("digest")), "source")
    many = first.where("n > 1")
    subroots, within = first.where("n = 1").select("source", "digest"), None
    if not many.isEmpty():
        more, within = climbed(many, "source")
        subroots = subroots.unionByName(more)
    sources = _numbered(written(subroots, "subroots"))
    roots, over = climbed(sources.select(F.lit(0).alias("tree"), "position", "n", "digest"))
    root = roots.first()  # one row, none if docs is empty
    by_source = sources.join(over, "position").select(
        F.col("source").alias("_s"), F.col("digest").alias("subroot"), F.lit(root and root["digest"]).alias("root"), F.col("path").alias("_over"))
    runs = first.select("source", F.col("position").alias("run"))
    if within is None:
        runs = runs.withColumn("path", F.array().cast(_STEP))
    else:
        within = within.select(F.col("source").alias("_w"), "position", "path")
        runs = (runs.join(within, F.col("source").eqNullSafe(F.col("_w")) & (F.col("run") == F.col("position")), "left")
                .select("source", "run", F.coalesce("path", F.array().cast(_STEP)).alias("path")))
    above = written(runs.join(by_source, F.col("source").eqNullSafe(F.col("_s")))
                    .select("source", "run", "subroot", "root", F.concat("path", "_over").alias("path")), "above")
    return (_runs(rows).groupBy("source", "run").cogroup(above.groupBy("source", "run"))
            .applyInPandas(lambda key, left, right: pd.concat(_folded(key, left, right)),
                           "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"))


def _numbered(subroots: DataFrame) -> DataFrame:
    """source, digest, position by source (null first) and n: ranges as in leaves()."""
    spread = int(subroots.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = written(subroots.repartitionByRange(spread, "source").sortWithinPartitions("source")
                     .withColumn("_at", F.monotonically_increasing_id()), "sources").withColumn("_range", F.shiftright("_at", 33))
    # One row per range.
    counts = placed.groupBy("_range").agg(F.count("*").alias("rows"), F.min("_at").alias("first"))
    whole = Window.orderBy("_range")
    counts = counts.select("_range", "first", F.sum("rows").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("n"),
                           F.coalesce(F.sum("rows").over(whole.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return written(placed.join(F.broadcast(counts), "_range").select(
        "source", "digest", (F.col("_at") - F.col("first") + F.col("before")).alias("position"), F.col("n").cast("long").alias("n")), "numbered")
