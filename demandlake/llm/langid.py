"""Language identification by interpolated Kneser-Ney character models.

Each language has a character model of order ORDER, counted over all learning
rows.  The lower orders use continuation counts (before how many different
characters an n-gram stands), each order interpolates with the next lower one
by absolute discounting, and below the lowest all characters are alike.

A model is stored as sorted arrays of whole n-grams with a row of log
probabilities by language, and is read by binary search.  Where the arrays
would be too large for a task, only the most frequent n-grams are held as
arrays and the others are joined to the written tables.  The language with
the lowest cross-entropy per character wins.  Its score is the posterior among
the languages, lowered where the cross-entropy is unusual for the winner; what
is usual is calibrated on all learning rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlake.llm.common import held_out, written

ORDER = 4
DISCOUNT = 0.75
#: Arrays of a model that tasks hold have at most so many bytes; n-grams beyond are joined, with the same results.
MODEL_BYTES = 64_000_000
#: The likelihood counts with this power, as neighbouring characters depend on each other.
TEMPER = 0.5
#: A winner with a lower score is marked as rejected.
REJECT_BELOW = 0.5
#: Texts are joined to blocks of about so many characters for array work.
BLOCK_CHARS = 1 << 19


def folder():
    """A function from a list of texts to (character ids, text number of each character, has a letter).

    Letters are lower-cased, marks stay, each run of anything else is a space,
    and ORDER - 1 spaces stand before a text.  A character's id has 16 bits:
    the low ones of its code point.
    """
    import unicodedata

    import numpy as np

    fold = np.full(1 << 16, 32, np.uint64)
    letter = np.zeros(1 << 16, bool)
    for c in range(1 << 16):
        kind = unicodedata.category(chr(c))[0]
        if kind in "LM":
            low = chr(c).lower()
            fold[c], letter[c] = ord(low) if len(low) == 1 else c, kind == "L"
    lead, tail = "\n" * (ORDER - 1), "\n"

    def run(texts: list[str]):
        lengths = np.array([len(t) + ORDER for t in texts])
        codes = np.frombuffer("".join([lead + t + tail for t in texts]).encode("utf-32-le"), np.uint32)
        text = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
        low = codes & 0xFFFF
        ids, is_letter = fold[low], letter[low]
        for at in np.flatnonzero(codes > 0xFFFF).tolist():  # characters beyond the first plane are rare
            is_letter[at] = chr(codes[at]).isalpha()
            ids[at] = low[at] if is_letter[at] else 32
        starts = np.cumsum(lengths) - lengths
        keep = ids != 32
        keep[1:] |= ids[:-1] != 32
        for k in range(ORDER - 1):
            keep[starts + k] = True
        has = np.zeros(len(texts), bool)
        has[text[is_letter]] = True
        return ids[keep], text[keep], has

    return run


def windows(ids, text):
    """(packed ORDER-grams inside one text, their text numbers); the last character has the lowest bits."""
    import numpy as np

    n = len(ids) - ORDER + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    packed = ids[:n].copy()
    for k in range(1, ORDER):
        packed <<= np.uint64(16)
        packed |= ids[k: k + n]
    inside = text[:n] == text[ORDER - 1:]
    return packed[inside], text[:n][inside]


def counts(rows: DataFrame) -> DataFrame:
    """(lang, gram, n): all ORDER-grams of rows(lang, text), packed, with their number of occurrences."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        fold = folder()
        held: dict[str, list[str]] = {}
        size: dict[str, int] = {}
        sums: dict[str, tuple] = {}

        def add(lang: str) -> None:
            """Count the held texts of a language and merge them into its sums."""
            size.pop(lang)
            found, n = np.unique(windows(*fold(held.pop(lang))[:2])[0], return_counts=True)
            if lang in sums:
                found, back = np.unique(np.concatenate((sums[lang][0], found)), return_inverse=True)
                n = np.bincount(back, np.concatenate((sums[lang][1], n)), len(found)).astype(np.int64)
            sums[lang] = found, n

        def table(lang: str) -> pa.RecordBatch:
            found, n = sums.pop(lang)
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(n), pa.string()), pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))],
                ["lang", "gram", "n"])

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held.setdefault(lang, []).append(text)
                size[lang] = size.get(lang, 0) + len(text)
                full = sum(size.values()) > 4 * BLOCK_CHARS  # many languages, few characters each
                for k in list(held) if full else [lang] if size[lang] > BLOCK_CHARS else []:
                    add(k)
                if lang not in held:
                    if sum(len(found) for found, _ in sums.values()) > 2 * BLOCK_CHARS:
                        for k in list(sums):
                            yield table(k)
        for lang in list(held):
            add(lang)
        for lang in list(sums):
            yield table(lang)

    return rows.select("lang", "text").mapInArrow(scan, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def probabilities(grams: DataFrame, langs: list[str]) -> list[tuple[DataFrame, DataFrame]]:
    """For each order from 1 on: (gram, p: one probability a language) and (history, w: back-off weights).

    Every n-gram that any language has gets a probability in all of them, so
    one search in the stored arrays serves all languages.  DataFrame joins on
    the table of n-grams only.
    """
    span = range(len(langs))
    tables = [written(grams.groupBy("gram").agg(*[F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).alias(f"c{k}")
                                                  for k, lang in enumerate(langs)]), "grams")]
    for n in range(ORDER - 1, 0, -1):  # continuation counts: how many n+1-grams end with it
        tables.insert(0, written(tables[0].groupBy(F.col("gram").bitwiseAND(F.lit((1 << 16 * n) - 1)).alias("gram")).agg(
            *[F.count_if(F.col(f"c{k}") > 0).alias(f"c{k}") for k in span]), f"grams-{n}"))
    characters = tables[0].count() + 1
    found = []
    for n, table in enumerate(tables, 1):
        # A constant key is no group: for single characters the history is empty.
        history = F.shiftrightunsigned("gram", 16) if n > 1 else F.col("gram") * 0
        keyed = table.withColumn("history", history)
        sums = keyed.groupBy("history").agg(*[f for k in span for f in (
            F.sum(f"c{k}").alias(f"s{k}"), F.count_if(F.col(f"c{k}") > 0).alias(f"t{k}"))])
        weight = F.array(*[F.when(F.col(f"s{k}") > 0, DISCOUNT * F.col(f"t{k}") / F.col(f"s{k}")).otherwise(1.0) for k in span])
        sums = sums.withColumn("w", weight)
        own = F.array(*[F.when(F.col(f"s{k}") > 0, F.greatest(F.col(f"c{k}") - DISCOUNT, F.lit(0.0)) / F.col(f"s{k}")).otherwise(0.0)
                        for k in span])
        rows = keyed.join(sums, "history").withColumn("own", own)
        if n > 1:
            lower = found[-1][0].select(F.col("gram").alias("suffix"), F.col("p").alias("lower"))
            rows = rows.withColumn("suffix", F.col("gram").bitwiseAND(F.lit((1 << 16 * (n - 1)) - 1))).join(lower, "suffix")
        else:
            rows = rows.withColumn("lower", F.array(*[F.lit(1.0 / characters)] * len(langs)))
        p = F.array(*[F.col("own")[k] + F.col("w")[k] * F.col("lower")[k] for k in span])
        found.append((written(rows.select("gram", p.alias("p")), f"p{n}"), sums.select(F.col("history").alias("gram"), F.col("w").alias("p"))))
    return found


def stored(tables: list[DataFrame], langs: list[str]) -> list[tuple]:
    """(sorted n-grams, log values by language) of each of tables(gram, p)."""
    import numpy as np

    found = []
    for t in tables:
        rows = t.select("gram", *[F.log(F.col("p")[k]).cast("float").alias(f"p{k}") for k in range(len(langs))]).toArrow()
        key = rows.column(0).to_numpy().view(np.uint64)
        order = np.argsort(key)
        found.append((key[order], np.column_stack([rows.column(k + 1).to_numpy() for k in range(len(langs))])[order]))
    return found


def frequent(grams: DataFrame, most: int) -> DataFrame:
    """gram of at most `most` n-grams of grams(gram, n) that occur oftenest; all with a count in one bin or none."""
    bins = F.floor(8 * F.log2("n")).cast("int")
    counted = grams.groupBy("gram").agg(F.sum("n").alias("n")).withColumn("bin", bins)
    least, total = None, 0
    for r in sorted(counted.groupBy("bin").count().collect(), reverse=True):  # at most 8 * 63 rows
        total += r["count"]
        if total > most:
            break
        least = r["bin"]
    return counted.where(F.col("bin") >= least if least is not None else F.lit(False)).select("gram")


def held(orders: list[tuple[DataFrame, DataFrame]], grams: DataFrame, langs: list[str]) -> dict:
    """What tasks hold of a model: all arrays if they fit into MODEL_BYTES, else the most frequent n-grams and the tables."""
    orders = [(p, written(w, f"w{n}")) for n, (p, w) in enumerate(orders, 1)]
    size = 8 + 4 * len(langs)
    if sum(t.count() for order in orders for t in order) * size <= MODEL_BYTES:
        arrays = stored([p for p, _ in orders] + [w for _, w in orders], langs)
        return {"grams": arrays[:ORDER], "weights": arrays[ORDER:]}
    head = orders[-1][0].join(frequent(grams, MODEL_BYTES // size), "gram", "left_semi")
    return {"head": stored([head], langs)[0], "tables": orders}


def fit(docs: DataFrame) -> dict:
    """The stored models of docs' languages, and what cross-entropy is usual in each.

    Learns from text and non-null lang of rows that are not held out.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select(
        "doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    grams = written(counts(rows), "counts")
    langs = sorted(r[0] for r in grams.select("lang").distinct().collect())  # the label set
    if not langs:
        return {"langs": []}
    model = {"langs": langs, "usual": {}} | held(probabilities(grams, langs), grams, langs)
    usual = (identify(rows, model, ["lang"]).where("lang = lang_pred").groupBy("lang")
             .agg(F.avg("entropy").alias("mean"), F.stddev_pop("entropy").alias("spread")).collect())
    model["usual"] = {r["lang"]: (float(r["mean"]), max(float(r["spread"]), 0.02)) for r in usual}
    return model


def scorer(model: dict):
    """A function from texts to [(lang_pred, score, entropy)]."""
    import numpy as np

    langs, fold = model["langs"], folder()

    def find(table, keys):
        if not len(table[0]):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
        return at, table[0][at] == keys

    def log_p(grams, n: int):
        """Log probabilities of the last character of packed n-grams, a row each."""
        at, seen = find(model["grams"][n - 1], grams)
        out = model["grams"][n - 1][1][at]
        if not seen.all():
            rest = grams[~seen]
            if n > 1:
                low = log_p(rest & np.uint64((1 << 16 * (n - 1)) - 1), n - 1)
                key, known = find(model["weights"][n - 1], rest >> np.uint64(16))
                out[~seen] = low + np.where(known[:, None], model["weights"][n - 1][1][key], 0)
            else:
                out[~seen] = model["weights"][0][1][0] - np.log(len(model["grams"][0][0]) + 1)
        return out

    def summed(texts: list[str]):
        """Sums of log probabilities, number of n-grams, has a letter, and (text, n-grams) that the arrays don't hold."""
        ids, text, has = fold(texts)
        grams, text = windows(ids, text)
        sums, missing = np.zeros((len(texts), len(langs))), []
        for at in range(0, len(grams), BLOCK_CHARS):
            g, t = grams[at: at + BLOCK_CHARS], text[at: at + BLOCK_CHARS]
            if "grams" in model:
                part = log_p(g, ORDER)
            else:
                where, seen = find(model["head"], g)
                missing.append((t[~seen], g[~seen]))
                part, t = model["head"][1][where[seen]], t[seen]
            for k in range(len(langs)):
                sums[:, k] += np.bincount(t, part[:, k], len(texts))
        return sums, np.bincount(text, minlength=len(texts)), has, missing

    def verdicts(sums, n, has):
        n = np.maximum(n, 1)
        entropy = -sums / n[:, None]
        best = entropy.argmin(axis=1)
        row = np.arange(len(sums))
        odds = np.exp(TEMPER * (sums - sums[row, best][:, None]))
        score = 1 / odds.sum(axis=1)
        mean, spread = np.array([model["usual"].get(lang, (0.0, np.inf)) for lang in langs]).T
        z = (entropy[row, best] - mean[best]) / (spread[best] * np.sqrt(1 + 100 / n))
        score *= np.exp(-np.maximum(z - 4, 0) / 4)  # falls beyond four spreads
        return [(langs[b], float(s), float(e)) if h else ("und", 0.0, None)
                for b, s, e, h in zip(best, score, entropy[row, best], has)]

    def run(texts: list[str | None]):
        if not langs:
            return [("und", 0.0, None)] * len(texts)
        return [v for part in blocks(texts) for v in verdicts(*summed(part)[:3])]

    run.summed, run.verdicts = summed, verdicts
    return run


def blocks(texts: list[str | None]) -> Iterator[list[str]]:
    """texts in parts of about BLOCK_CHARS characters; null counts as empty."""
    held, size = [], 0
    for t in texts:
        held.append(t or "")
        size += len(held[-1])
        if size > BLOCK_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def backed_off(grams: DataFrame, orders: list[tuple[DataFrame, DataFrame]], langs: list[str]) -> DataFrame:
    """(gram, p: log probabilities by language) of ORDER-grams that need not be in the tables."""
    characters = orders[0][0].count() + 1
    rows = grams.select("gram").distinct()
    for n, (p, w) in enumerate(orders, 1):
        suffix = F.col("gram") if n == ORDER else F.col("gram").bitwiseAND(F.lit((1 << 16 * n) - 1))
        history = F.shiftrightunsigned(suffix, 16) if n > 1 else F.lit(0).cast("long")
        p, w = p.select(F.col("gram").alias("_p"), F.col("p").alias(f"p{n}")), w.select(F.col("gram").alias("_w"), F.col("p").alias(f"w{n}"))
        # Tables with a key of one character have at most 2**16 rows.
        p, w = F.broadcast(p) if n == 1 else p, F.broadcast(w) if n <= 2 else w
        rows = rows.join(p, suffix == F.col("_p"), "left").drop("_p").join(w, history == F.col("_w"), "left").drop("_w")
    value = []
    for k in range(len(langs)):
        x = -F.log(F.lit(float(characters)))
        for n in range(1, ORDER + 1):
            x = F.coalesce(F.log(F.col(f"p{n}")[k]), F.coalesce(F.log(F.col(f"w{n}")[k]), F.lit(0.0)) + x)
        value.append(x)
    return rows.select("gram", F.array(*value).alias("p"))


def _joined(docs: DataFrame, model: dict, columns: list[str], schema: str) -> DataFrame:
    """identify() with a model whose tables are joined."""
    langs, tables = model["langs"], model["tables"]
    part = {k: v for k, v in model.items() if k != "tables"}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        score = scorer(part)
        for b in batches:
            k, at = b.num_columns - 1, 0
            for texts in blocks(b.column(k).to_pylist()):
                sums, n, has, missing = score.summed(texts)
                grams, times = [np.zeros(0, np.int64)] * len(texts), [np.zeros(0, np.int64)] * len(texts)
                t = np.concatenate([x for x, _ in missing] or [np.zeros(0, np.int32)])
                g = np.concatenate([x for _, x in missing] or [np.zeros(0, np.uint64)])
                cuts = np.searchsorted(t, np.arange(len(texts) + 1))
                for j in range(len(texts)):
                    found, m = np.unique(g[cuts[j]: cuts[j + 1]], return_counts=True)
                    grams[j], times[j] = found.view(np.int64), m.astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(j).slice(at, len(texts)) for j in range(k)] + [
                        pa.array(list(sums), pa.list_(pa.float64())), pa.array(n.astype(np.int64)), pa.array(has),
                        pa.array(grams, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int64()))],
                    [*b.schema.names[:k], "_sums", "_n", "_has", "_grams", "_times"])
                at += len(texts)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        score = scorer(part)
        for b in batches:
            k = b.num_columns - 3
            sums = np.array(b.column(k).to_pylist(), float).reshape(-1, len(langs))
            yield _verdict_batch(b, k, score.verdicts(sums, b.column(k + 1).to_numpy(), b.column(k + 2).to_pylist()))

    rows = written(docs.select(*columns, F.col("text").cast("string").alias("_text")).mapInArrow(
        count, f"{schema}, _sums array<double>, _n long, _has boolean, _grams array<long>, _times array<long>")
        .withColumn("_row", F.monotonically_increasing_id()), "lang-rows")
    each = rows.select("_row", F.explode(F.arrays_zip("_grams", "_times")).alias("g")).select(
        "_row", F.col("g._grams").alias("gram"), F.col("g._times").alias("times"))
    more = each.join(backed_off(each, tables, langs), "gram").groupBy("_row").agg(
        F.array(*[F.sum(F.col("times") * F.col("p")[k]) for k in range(len(langs))]).alias("_more"))
    sums = F.when(F.col("_more").isNull(), F.col("_sums")).otherwise(F.zip_with("_sums", "_more", lambda a, b: a + b))
    return rows.drop("_grams", "_times").join(more, "_row", "left").select(*columns, sums.alias("_sums"), "_n", "_has").mapInArrow(
        judge, f"{schema}, lang_pred string, score double, entropy double, rejected boolean")


def _verdict_batch(b: pa.RecordBatch, k: int, found: list[tuple]) -> pa.RecordBatch:
    """The first k columns of b with lang_pred, score, entropy, rejected."""
    lang, value, entropy = zip(*found) if found else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [b.column(j) for j in range(k)] + [pa.array(lang, pa.string()), pa.array(value, pa.float64()), pa.array(entropy, pa.float64()),
                                           pa.array([v < REJECT_BELOW for v in value], pa.bool_())],
        [*b.schema.names[:k], "lang_pred", "score", "entropy", "rejected"])


def identify(docs: DataFrame, model: dict, columns: list[str]) -> DataFrame:
    """columns of docs with lang_pred, score, entropy (nats a character) and rejected.

    A null text and one without a letter are `und` with score 0 and are
    rejected; the same holds for all rows if no language was learned.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema)

    if "tables" in model:
        return _joined(docs, model, columns, schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(model)
        for b in batches:
            k = b.num_columns - 1
            yield _verdict_batch(b, k, score(b.column(k).to_pylist()))

    return docs.select(*columns, F.col("text").cast("string").alias("_text")).mapInArrow(
        scan, f"{schema}, lang_pred string, score double, entropy double, rejected boolean")


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every row of docs."""
    found = identify(docs.withColumn("doc_id", F.col("doc_id").cast("long")), fit(docs), ["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
