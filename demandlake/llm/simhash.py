"""SimHash near-deduplication by a binary trie self-join.

Fingerprints are paths of a binary trie.  The join walks pairs of nodes from
the top, adds up the bits in which the two paths differ and drops a pair as
soon as they are more than the error budget.

To deal the walk out, four tries are built, each over the fingerprints rotated
by another 16 bits.  Two fingerprints that differ in at most 3 bits agree in
one of the four 16-bit blocks, so in one of the tries they lie below the same
node at depth 16.  These nodes are the tasks.  A node with very many
fingerprints is walked further down before it is dealt out: a task is then a
pair of nodes, and only pairs within the budget get one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlake.llm.common import keep_rows, row_keys, written

MAX_DISTANCE = 3
SHINGLE_WORDS = 3
SEED = 42
BLOCK_BITS = 16
#: A node with more fingerprints than this is dealt out as pairs of nodes further down.
NODE_LIMIT = 250_000
#: At most so many levels further down.
EXTRA_BITS = 12
#: A fingerprint that holds more than one row in so many is joined by broadcast.
HEAVY_SHARE = 512


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, row keys and fingerprint (the 64 bits as a long) of every whole text.

    Null text counts as empty; texts without a word have fingerprint zero.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from xxhash import xxh64_digest

        block = 1 << 17  # shingles whose bits are spread out at a time

        def fingerprint(text: str) -> int:
            # bytes.lower() and bytes.split() know exactly A-Z and the six ASCII spaces.
            found = text.encode().lower().split()
            if not found:
                return 0
            joined = b" ".join(found)
            ends = np.cumsum([len(w) + 1 for w in found]) - 1
            starts = np.concatenate(([0], ends[:-1] + 1))
            n = max(len(found) - words + 1, 1)
            spans = zip(starts[:n].tolist(), ends[min(words, len(found)) - 1:].tolist())
            counts = np.zeros(64, np.int64)
            digests = [xxh64_digest(joined[a:b], SEED) for a, b in spans]
            for at in range(0, n, block):
                bits = np.unpackbits(np.frombuffer(b"".join(digests[at:at + block]), np.uint8))
                # Sums of 255 zeros and ones fit into a byte: eight bytes are added at once.
                lanes = bits.view(np.uint64).reshape(-1, 8)
                sums = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)
                counts += sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
            return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big", signed=True)

        for b in batches:
            found = [fingerprint(t or "") for t in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(found, pa.int64())],
                                             ["doc_id", "_id_key", "_text_key", "fp"])

    slim = row_keys(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "_id_key", "_text_key",
                                 F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(scan, "doc_id long, _id_key long, _text_key long, fp long")


def trie_pairs(values, groups, low, budget: int, block: int = 1 << 20):
    """Walk node pairs; yields index arrays (i, j) of values within the budget.

    values: fingerprints as uint64, sorted inside each group.  groups: a list
    of (from, to, from, to, errors) of the node pairs to start with; equal
    ranges are a node with itself.  low: the bit to look at first, from above.
    Pairs are handled in blocks, depth first, so that memory stays bounded.
    """
    import numpy as np

    one = np.uint64(1)
    stack = [(np.asarray(groups, np.int64).reshape(-1, 5), low)]
    while stack:
        pairs, bit = stack.pop()
        if len(pairs) > block:
            stack += [(pairs[block:], bit), (pairs[:block], bit)]
            continue
        a, b, c, d, errors = pairs.T
        work = (b - a) * (d - c)
        # Few leaves below both nodes, or all bits seen: compare them at once.
        done = (work <= 16) | (bit < 0)
        if done.any():
            yield from _compare(values, pairs[done], work[done], budget, block)
        pairs = pairs[~done]
        if not len(pairs):
            continue
        a, b, c, d, errors = pairs.T
        # Inside a node all higher bits are equal, so its values are sorted by this bit.
        nodes, back = np.unique(np.concatenate((a * (len(values) + 1) + b, c * (len(values) + 1) + d)), return_inverse=True)
        middle = _split(values, nodes // (len(values) + 1), nodes % (len(values) + 1), np.uint64(bit), one)[back]
        m, n = middle[: len(a)], middle[len(a):]
        same = a == c
        children = [np.stack(x, 1) for x in (
            (a, m, c, n, errors), (m, b, n, d, errors), (a, m, n, d, errors + 1),
            (m[~same], b[~same], c[~same], n[~same], errors[~same] + 1))]
        left = np.concatenate(children)
        left = left[(left[:, 0] < left[:, 1]) & (left[:, 2] < left[:, 3]) & (left[:, 4] <= budget)]
        alone = (left[:, 0] == left[:, 2]) & (left[:, 1] - left[:, 0] == 1)
        if len(left := left[~alone]):
            stack.append((left, bit - 1))


def _split(values, start, end, bit, one):
    """For each node, where its values with this bit set begin: binary search in all nodes at once."""
    import numpy as np

    low, high = start.copy(), end.copy()
    while (open_ := low < high).any():
        at = (low + high) // 2
        set_ = np.zeros(len(at), bool)
        set_[open_] = (values[at[open_]] >> bit) & one == one
        high = np.where(open_ & set_, at, high)
        low = np.where(open_ & ~set_, at + 1, low)
    return low


def _compare(values, pairs, work, budget: int, block: int):
    """All leaves of each node pair against each other, block by block."""
    import numpy as np

    ends = np.cumsum(work)
    first = 0
    while first < len(pairs):
        done = ends[first - 1] if first else 0
        last = max(int(np.searchsorted(ends, done + 4 * block, "right")), first + 1)
        part, size = pairs[first:last], work[first:last]
        which = np.repeat(np.arange(len(part)), size)
        inside = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
        width = (part[:, 3] - part[:, 2])[which]
        i, j = part[which, 0] + inside // width, part[which, 2] + inside % width
        near = np.bitwise_count(values[i] ^ values[j]) <= budget
        near &= i != j
        yield i[near], j[near]
        first = last


def _roots(n: int, found):
    """The smallest index of each component of n values, from blocks of pairs (i, j)."""
    import numpy as np

    root = np.arange(n)
    for i, j in found:
        while len(i):
            a, b = root[i], root[j]
            open_ = a != b
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (deeper := root[root] != root).any():
                root = np.where(deeper, root[root], root)
    return root


def links(distinct: DataFrame, budget: int = MAX_DISTANCE, node_limit: int = NODE_LIMIT) -> DataFrame:
    """Links (a, b) between distinct fingerprints that keep every component whole.

    Of the pairs a task finds, it returns a spanning star of each of their
    components: at most one row for each fingerprint that the task holds.
    """
    if budget >= 64 // BLOCK_BITS:
        raise ValueError("four blocks allow at most three differing bits")
    rotated = distinct.select(
        F.explode(F.array(*[F.struct(F.lit(k).alias("trie"), (F.expr(f"shiftleft(fp, {k * BLOCK_BITS})").bitwiseOR(
            F.expr(f"shiftrightunsigned(fp, {64 - k * BLOCK_BITS})")) if k else F.col("fp")).alias("value"))
            for k in range(64 // BLOCK_BITS)])).alias("r")).select("r.trie", "r.value").withColumn(
        "node", F.shiftrightunsigned("value", 64 - BLOCK_BITS))
    # At most 4 * 2**16 rows, whatever the input; the broadcast side is smaller still.
    large = (rotated.groupBy("trie", "node").agg(F.count("*").alias("n")).where(F.col("n") > node_limit)
             .select("trie", "node", F.least(F.ceil(F.log2(F.col("n") / node_limit)) + 1, F.lit(EXTRA_BITS)).cast("int").alias("extra")))
    masks = ", ".join(str(m) for m in range(1 << EXTRA_BITS) if m.bit_count() <= budget)
    dealt = rotated.join(F.broadcast(large), ["trie", "node"], "left")
    plain = dealt.where("extra is null").selectExpr("trie", "node", "0 as x", "0 as y", "0 as side", "value")
    # Below a large node, the next bits name the child; it meets each child within the budget once.
    split = (dealt.where("extra is not null")
             .withColumn("child", F.expr(f"cast(shiftrightunsigned(shiftleft(value, {BLOCK_BITS}), 64 - extra) as int)"))
             .withColumn("mask", F.expr(f"explode(filter(array({masks}), m -> m < shiftleft(1, extra)))"))
             .withColumn("other", F.col("child").bitwiseXOR(F.col("mask")))
             .selectExpr("trie", "node", "least(child, other) as x", "greatest(child, other) as y",
                         "if(child > other, 1, 0) as side", "value"))
    tasks = plain.unionByName(split).repartition("trie", "node", "x", "y")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        held = [[np.asarray(b.column(k)) for k in range(6)] for b in batches if b.num_rows]
        if not held:
            return
        trie, node, x, y, side, value = (np.concatenate(c) for c in zip(*held))
        value = value.astype(np.int64).view(np.uint64)
        order = np.lexsort((value, side, y, x, node, trie))
        trie, node, x, y, side, value = (c[order] for c in (trie, node, x, y, side, value))
        new = np.zeros(len(value), bool)
        for c in (trie, node, x, y):
            new[1:] |= c[1:] != c[:-1]
        new[0] = True
        start = []
        edge = np.append(np.flatnonzero(new), len(value)).tolist()
        for at, to in zip(edge[:-1], edge[1:]):
            cut = at + int(np.searchsorted(side[at:to], 1)) if x[at] != y[at] else at
            if cut == at and to - at > 1 and x[at] == y[at]:
                start.append((at, to, at, to, 0))
            elif at < cut < to:
                start.append((at, cut, cut, to, 0))
        if not start:
            return
        # Errors are counted from the first bit below the block, also for node pairs further down.
        found = trie_pairs(value, start, 63 - BLOCK_BITS, budget)
        root = _roots(len(value), found)
        linked = np.flatnonzero(root != np.arange(len(value)))
        turn = (trie * BLOCK_BITS).astype(np.uint64)

        def back(v, r):
            return np.where(r == 0, v, (v >> r) | (v << ((np.uint64(64) - r) % np.uint64(64))))

        a, b = back(value[linked], turn[linked]).view(np.int64), back(value[root[linked]], turn[linked]).view(np.int64)
        for k in range(0, len(a), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(a[k:k + 100_000]), pa.array(b[k:k + 100_000])], ["a", "b"])

    return tasks.mapInArrow(join, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of edges(a, b) reaches.

    Alternates large-star and small-star steps; every step is written out, and
    the loop ends when a round leaves the edges as they were.
    """
    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = state(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = written(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b").where("a <> b").distinct())
        now = written(small, "small-star")
        mark, seen = state(now), mark
        if seen == mark:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def groups(docs: DataFrame, words: int = SHINGLE_WORDS, budget: int = MAX_DISTANCE) -> DataFrame:
    """doc_id, row keys, fp and component_id of every row of docs.

    component_id is the smallest doc_id that links reach, null ids aside: it
    is null where the whole component has no id.  Repeated rows get the same
    component.  An empty table gives no rows.
    """
    rows = written(fingerprints(docs, words), "fingerprints")
    total = rows.count()
    distinct = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "distinct")
    stars = components(links(distinct.select("fp"), budget))
    rooted = (distinct.join(stars, distinct.fp == stars.node, "left")
              .select("fp", "least", "n", F.coalesce("root", "fp").alias("root")))
    whole = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "n", "component_id")
    whole = written(whole, "components")
    heavy = F.broadcast(whole.where(F.col("n") * HEAVY_SHARE > total).drop("n"))  # fewer than HEAVY_SHARE rows
    light = whole.where(F.col("n") * HEAVY_SHARE <= total).drop("n")
    columns = ["doc_id", "_id_key", "_text_key", "fp", "component_id"]
    return (rows.join(heavy, "fp").select(*columns)
            .unionByName(rows.join(heavy.select("fp"), "fp", "left_anti").join(light, "fp").select(*columns)))


def dedup(docs: DataFrame, words: int = SHINGLE_WORDS, budget: int = MAX_DISTANCE) -> DataFrame:
    """The rows of docs that stay: the one with the smallest doc_id of each component.

    Rows with a null doc_id can't be named by a component; they stay.
    """
    found = groups(docs, words, budget)
    return keep_rows(docs, found.where("doc_id is null or doc_id = component_id"))
