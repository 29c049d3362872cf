"""Quality classifier: a generalised additive model with pairwise interactions.

Every text becomes a vector of plain statistics, each cut into at most
MAX_BINS bins at quantiles of the learning rows.  Cyclic boosting goes round
the features: a shallow tree on one feature's bins takes a small step against
the log loss, and all trees of a feature add up to one lookup table.  Then the
same is done for the pairs of features whose quadrants explain most of what is
left.  A score is a sum of bin values, taken for whole batches at once.

The statistics of all texts are made once, by Spark, and written; learning
takes a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlake.llm.common import held_out, training_labels, written

#: At most about so many labelled rows are used to learn from.
MAX_LABELS = 40_000
MAX_BINS = 32
ROUNDS, RATE, LEAVES = 150, 0.15, 4
PAIRS, PAIR_ROUNDS, PAIR_BINS = 8, 60, 8
#: Prior rows in each leaf, which keep values of rare bins small.
PRIOR = 5.0
#: Characters of texts that are handled at a time.
BLOCK_CHARS = 1 << 20

FEATURES = ["log_words", "word_length", "letter_share", "upper_share", "digit_share", "space_share", "stop_share",
            "symbol_share", "other_share", "distinct_share", "top_word_share", "follows_itself", "trigram_share",
            "upper_word_share", "bare_word_share", "marked_word_share", "log_lines", "line_repeat_share", "longest_word"]

# Characters counted as stops and as symbols.
STOPS = ".,;:!?'\"()-"
SYMBOLS = "#*$%&|<>=_~^@{}[]\\/+`"


def statistics():
    """A function from a list of texts to an array of FEATURES, a row each."""
    from collections import Counter
    from math import log1p

    import numpy as np

    kinds = np.full(1 << 16, 6, np.uint8)  # 0 letter, 1 upper case, 2 digit, 3 space, 4 stop, 5 symbol, 6 other
    for code in range(1 << 16):
        c = chr(code)
        if c.isalpha():
            kinds[code] = 1 if c.isupper() else 0
        elif c.isdecimal():
            kinds[code] = 2
        elif c.isspace():
            kinds[code] = 3
    kinds[[ord(c) for c in STOPS]] = 4
    kinds[[ord(c) for c in SYMBOLS]] = 5

    def words_of(text: str) -> list[float]:
        words = text.split()
        n = len(words)
        lines = [line for line in text.split("\n") if line.strip()]
        repeated = 1 - len(set(lines)) / len(lines) if lines else 0.0
        if not n:
            return [0.0, 0.0, 1.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, log1p(len(lines)), repeated, 0.0]
        seen = Counter(words)
        letters = sum(map(str.isalpha, words))
        return [log1p(n), sum(map(len, words)) / n, len(seen) / n, max(seen.values()) / n,
                sum(map(str.__eq__, words, words[1:])) / n, len(set(zip(words, words[1:], words[2:]))) / max(n - 2, 1),
                sum(map(str.isupper, words)) / n, letters / n, 1 - sum(map(str.isalnum, (w[-1] for w in words))) / n,
                log1p(len(lines)), repeated, log1p(max(map(len, words)))]

    def block(texts: list[str]):
        lengths = np.array([len(t) for t in texts])
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        kind = np.where(codes > 0xFFFF, np.uint8(6), kinds[codes & 0xFFFF])
        text = np.repeat(np.arange(len(texts)), lengths)
        shares = np.bincount(text * 7 + kind, minlength=7 * len(texts)).reshape(-1, 7) / np.maximum(lengths, 1)[:, None]
        w = np.array([words_of(t) for t in texts])
        return np.column_stack([w[:, :2], shares, w[:, 2:]]).astype(np.float32)

    def run(texts: list[str | None]):
        out, held, size = [], [], 0
        for t in texts:
            held.append(t or "")
            size += len(held[-1])
            if size > BLOCK_CHARS:
                out.append(block(held))
                held, size = [], 0
        return np.concatenate(out + ([block(held)] if held else [])) if texts else np.zeros((0, len(FEATURES)), np.float32)

    return run


def vectors(docs: DataFrame) -> DataFrame:
    """doc_id and x, the FEATURES of the whole text; null text counts as empty."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stats = statistics()
        for b in batches:
            x = stats(b.column(1).to_pylist())
            values = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([b.column(0), values], ["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        scan, "doc_id long, x array<float>")


def binned(x, cuts):
    """Bin numbers of values, a column for each feature; a bin holds values up to and with its cut."""
    import numpy as np

    return np.column_stack([np.searchsorted(c, x[:, k], "left") for k, c in enumerate(cuts)])


def _tree(gradient, weight, leaves: int):
    """A step for each bin: a tree on a line of bins, its leaves split where the loss falls most."""
    import numpy as np

    parts = [(0, len(gradient))]
    g, h = np.r_[0, np.cumsum(gradient)], np.r_[0, np.cumsum(weight)]

    def gain(a, b):
        return (g[b] - g[a]) ** 2 / (h[b] - h[a] + PRIOR)

    while len(parts) < leaves:
        best = (1e-9, 0, 0)
        for k, (a, b) in enumerate(parts):
            if b - a > 1:
                m = np.arange(a + 1, b)
                won = gain(a, m) + gain(m, b) - gain(a, b)
                at = int(won.argmax())
                best = max(best, (float(won[at]), k, int(m[at])))
        if not best[2]:
            break
        a, b = parts[best[1]]
        parts[best[1]: best[1] + 1] = [(a, best[2]), (best[2], b)]
    step = np.zeros(len(gradient))
    for a, b in parts:
        step[a:b] = (g[b] - g[a]) / (h[b] - h[a] + PRIOR)
    return step


def _quadrants(gradient, weight):
    """(gain, step) of the best cut of a grid into four quadrants."""
    import numpy as np

    g = np.pad(gradient.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    h = np.pad(weight.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    best = (0.0, 1, 1)
    total = g[-1, -1] ** 2 / (h[-1, -1] + PRIOR)
    for i in range(1, g.shape[0] - 1):
        for j in range(1, g.shape[1] - 1):
            won = sum(a ** 2 / (b + PRIOR) for a, b in (
                (g[i, j], h[i, j]), (g[-1, j] - g[i, j], h[-1, j] - h[i, j]), (g[i, -1] - g[i, j], h[i, -1] - h[i, j]),
                (g[-1, -1] - g[i, -1] - g[-1, j] + g[i, j], h[-1, -1] - h[i, -1] - h[-1, j] + h[i, j]))) - total
            best = max(best, (float(won), i, j))
    won, i, j = best
    step = np.zeros(gradient.shape)
    for rows in (slice(0, i), slice(i, None)):
        for columns in (slice(0, j), slice(j, None)):
            step[rows, columns] = gradient[rows, columns].sum() / (weight[rows, columns].sum() + PRIOR)
    return won, step


def boost(x, y) -> dict:
    """The model of feature rows x and labels y: cuts, lookup tables, pairs with their tables, bias."""
    import numpy as np

    cuts = []
    for k in range(x.shape[1]):
        values = np.unique(x[:, k])
        if len(values) > MAX_BINS:
            values = np.unique(np.quantile(x[:, k], np.linspace(0, 1, MAX_BINS + 1)[1:], method="lower"))
        cuts.append(values[:-1].astype(np.float32))
    bins = binned(x, cuts)
    sizes = [len(c) + 1 for c in cuts]
    tables = [np.zeros(n) for n in sizes]
    share = min(max(float(y.mean()), 1e-4), 1 - 1e-4)
    bias = float(np.log(share / (1 - share)))
    line = np.full(len(y), bias)

    def slopes():
        p = 1 / (1 + np.exp(-line))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for k, n in enumerate(sizes):
            if n > 1:
                g, h = slopes()
                b = bins[:, k]
                step = RATE * _tree(np.bincount(b, g, n), np.bincount(b, h, n), LEAVES)
                tables[k] += step
                line += step[b]
    # Coarse bins for pairs: neighbouring bins joined so that each holds about as many rows.
    coarse = []
    for k, n in enumerate(sizes):
        before = np.r_[0, np.cumsum(np.bincount(bins[:, k], minlength=n))[:-1]]
        coarse.append(np.unique((before * PAIR_BINS // max(len(y), 1)).astype(int), return_inverse=True)[1])
    small = [c[bins[:, k]] for k, c in enumerate(coarse)]
    size = [int(c.max()) + 1 for c in coarse]

    def grid(i, j, v):
        return np.bincount(small[i] * size[j] + small[j], v, size[i] * size[j]).reshape(size[i], size[j])

    g, h = slopes()
    ranked = sorted(((_quadrants(grid(i, j, g), grid(i, j, h))[0], i, j) for i in range(len(size)) for j in range(i)
                     if size[i] > 1 and size[j] > 1), reverse=True)[:PAIRS]
    pairs = [(i, j, np.zeros((size[i], size[j]))) for _, i, j in ranked]
    for _ in range(PAIR_ROUNDS):
        for i, j, table in pairs:
            g, h = slopes()
            step = RATE * _quadrants(grid(i, j, g), grid(i, j, h))[1]
            table += step
            line += step[small[i], small[j]]
    # A pair's table is stored by fine bins, so that a score takes one lookup.
    return {"cuts": cuts, "tables": tables, "bias": bias,
            "pairs": [(i, j, table[np.ix_(coarse[i], coarse[j])]) for i, j, table in pairs]}


def fit(spark: SparkSession, rows: DataFrame, sf_dir: str, max_labels: int = MAX_LABELS) -> dict | None:
    """The model learned from vectors(docs) and the labels that are not held out; None without both labels."""
    import numpy as np

    labels = training_labels(spark, sf_dir, "quality", max_labels)
    # At most about max_labels rows of a few hundred bytes come to the driver.
    table = rows.join(F.broadcast(labels), "doc_id").orderBy("doc_id").select("x", "label").toPandas()
    if table["label"].nunique() < 2:
        return None
    return boost(np.array(table["x"].tolist(), np.float32), table["label"].to_numpy(float))


def score(rows: DataFrame, model: dict | None) -> DataFrame:
    """doc_id and score of rows(doc_id, x); 0.5 everywhere if nothing was learned."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for b in batches:
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            line = np.zeros(len(x))
            if model:
                bins = binned(x, model["cuts"])
                line += model["bias"]
                for k, table in enumerate(model["tables"]):
                    line += table[bins[:, k]]
                for i, j, table in model["pairs"]:
                    line += table[bins[:, i], bins[:, j]]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(1 / (1 + np.exp(-line)))], ["doc_id", "score"])

    return rows.mapInArrow(scan, "doc_id long, score double")


def query(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= 0.3) of every row of docs.

    Null and empty texts have the statistics of an empty text and a score like
    any other; repeated rows get equal scores; an empty table gives no rows.
    """
    rows = written(vectors(docs), "quality-vectors")
    return score(rows, fit(spark, rows, sf_dir)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
