"""Toxicity by a weighted finite-state pattern grammar.

A text is read word by word.

1. The lexical transducer turns a word into a symbol: insult, threat, target,
   negation, reported speech or other, and says whether a clause ends there.
   Insults and threats carry weights; insult arcs are words and word
   beginnings, the seed words are fixed, further arcs are learned from labelled
   rows.
2. The negation and the reported-speech transducer say in which voice a word
   stands: direct, negated, reported or both.  The insult and the threat
   transducer accept one head each.  The target transducer links a head to a
   target before or after it in the clause, at a weight that decays with every
   word between.  All five are composed once, into one machine over symbols.
3. A path of the composed machine through a clause takes one head, in its
   voice, with or without one target; its weight is the product of its arcs'.
   The clause's score in each class (head, voice, target) is that of its best
   path, found in one pass from left to right.

A document's features sum its clauses' scores by class, and count matched
clauses, also in relation to the text's length, so clauses are
scored, not isolated words.  A logistic model over the features, also learned
from labelled rows, gives the score; it starts from fixed weights and leaves
them only as far as the labels carry it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlake.llm.common import held_out, row_keys, training_labels

#: At most about so many labelled rows are used to learn from.
MAX_LABELS = 40_000
#: Lengths of the word beginnings that may become arcs.
PREFIXES = (4, 5, 6, 7)
#: A learned arc needs this likelihood-ratio statistic, this share of toxic rows among its
#: rows, and this share of all toxic rows, so the labelled rows bound the number of arcs.
MIN_G2, MIN_SHARE, MIN_SUPPORT = 30.0, 0.6, 0.005

# Seed words of the transducers.
INSULTS = """idiot moron stupid loser scum trash worthless pathetic disgusting clown
idiota dummkopf abschaum versager imbécile crétin ordure imbécil estúpido basura""".split()
THREATS = """kill hurt destroy murder strangle shoot stab burn
töten umbringen tuer frapper matar golpear""".split()
TARGETS = """you your yours yourself yourselves u ur they them their theirs themselves
he him his himself she her hers herself
du dich dir dein deine ihr euch euer eure er ihn ihm ihnen sie
tu te toi ton vous votre vos il ils elle elles lui leur eux tú usted ustedes ti vosotros os él ella ellos ellas""".split()
NEGATIONS = """not no never nobody isn't aren't wasn't don't doesn't didn't
nicht kein keine niemals ne pas jamais nunca jamás""".split()
REPORTS = """said says say told tells called calls claimed wrote quoted quote according
sagte sagt schrieb laut dit disait selon dijo dice según""".split()

# Symbols of the lexical transducer; lower case: a clause ends after the word.
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, BREAK = b"OITGNRB"
CLAUSE_END = ".!?;:…"
QUOTES = "\"'“”„«»"

#: Weight of a seed insult and of a threat, and what each word between a head and its target leaves of it.
SEED_WEIGHT, THREAT_WEIGHT, DECAY = 3.0, 3.0, 0.85
#: Words over which a negation, and a word of reported speech, reaches.
NEGATION_REACH, REPORT_REACH = 3, 7

VOICES = ("direct", "negated", "reported", "both")
#: (head, voice, whether a target is linked): the classes of paths.
CLASSES = [(head, voice, target) for head in ("insult", "threat") for voice in VOICES for target in (False, True)]
FEATURES = [*CLASSES, "clauses", "largest", "density"]
#: The model's weights before any label: intercept, then FEATURES.
_FIXED = {("insult", "direct", False): 1.0, ("insult", "direct", True): 1.0, ("threat", "direct", False): 0.2, ("threat", "direct", True): 2.0,
          "clauses": 0.5, "largest": 0.5, "density": 0.5}
PRIOR = [-3.0] + [_FIXED.get(f, 0.05) for f in FEATURES]

# ---- the transducers of the voice, as tables (state, symbol) -> state; state 0 is closed


def reaching(opener: int, through: bytes, reach: int) -> dict[tuple[int, int], int]:
    """Open after the opener, for reach words, as long as only symbols of through follow."""
    table = {}
    for state in range(reach + 1):
        for symbol in b"OITGNR":
            ahead = state + 1 if 0 < state < reach and symbol in through else 0
            table[state, symbol] = 1 if symbol == opener else ahead
    return table


def compose(first: dict[tuple[int, int], int], second: dict[tuple[int, int], int]) -> tuple[list[tuple[int, int]], list[dict[int, int]]]:
    """The pairs of states that both machines reach together, and the arcs between them by symbol."""
    states, arcs, number = [(0, 0)], [], {(0, 0): 0}
    for a, b in states:  # grows while it is walked
        row = {}
        for symbol in b"OITGNR":
            to = first[a, symbol], second[b, symbol]
            if to not in number:
                number[to] = len(states)
                states.append(to)
            row[symbol] = number[to]
        arcs.append(row)
    return states, arcs


_STATES, _ARCS = compose(reaching(NEGATION, b"OG", NEGATION_REACH), reaching(REPORT, b"OGN", REPORT_REACH))
_VOICE = [(neg > 0) + 2 * (rep > 0) for neg, rep in _STATES]


def best_paths(symbols: bytes, weights: list[float], quoted: list[bool]) -> dict[tuple[str, str, bool], float]:
    """The weight of the best path of each class that a clause has a path of.

    symbols are upper case; weights and quoted hold one entry per symbol, and
    only those of insults and threats count.  A quoted head is reported.  One
    pass: `near` is the best weight of a target before the next word, `waiting`
    the best weights of heads that may still find one.
    """
    best: dict[tuple[str, str, bool], float] = {}
    waiting: dict[tuple[str, str], float] = {}
    state, near = 0, 0.0
    for symbol, weight, quote in zip(symbols, weights, quoted):
        if symbol in b"IT":
            head = "insult" if symbol == INSULT else "threat", VOICES[_VOICE[state] | 2 * quote]
            best[*head, False] = max(best.get((*head, False), 0.0), weight)
            if near:
                best[*head, True] = max(best.get((*head, True), 0.0), weight * near)
        near *= DECAY
        if symbol == TARGET:
            for head, w in waiting.items():
                best[*head, True] = max(best.get((*head, True), 0.0), w)
            near = 1.0
        waiting = {head: w * DECAY for head, w in waiting.items()}
        if symbol in b"IT":
            waiting[head] = max(waiting.get(head, 0.0), weight)
        state = _ARCS[state][symbol]
    return best


def _trim(part: str) -> str:
    """A part of a text without the punctuation around it."""
    a, b = 0, len(part)
    while a < b and not part[a].isalnum():
        a += 1
    while b > a and not part[b - 1].isalnum():
        b -= 1
    return part[a:b]


def lexer(arcs: dict[str, float], cache_items: int = 1_000_000) -> Callable[[str], tuple[bytes, list[str]]]:
    """The lexical transducer: text to (a symbol for each part, parts)."""
    fixed = {w: s for words, s in ((THREATS, THREAT), (TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT))
             for w in words}

    class Symbols(dict):
        def __missing__(self, part: str) -> int:
            if len(self) >= cache_items:
                self.clear()
            word = _trim(part)
            symbol = INSULT if arc_of(word, arcs) else fixed.get(word, OTHER)
            if part == "\x00":
                symbol = BREAK
            tail = part[part.rfind(word) + len(word):] if word else part
            self[part] = out = symbol | 32 if any(c in CLAUSE_END for c in tail) or symbol == BREAK else symbol
            return out

    symbols = Symbols()

    def read(text: str) -> tuple[bytes, list[str]]:
        parts = text.lower().replace("\n", " \x00 ").split()
        return bytes(map(symbols.__getitem__, parts)), parts

    return read


def arc_of(word: str, arcs: dict[str, float]) -> str | None:
    """The arc that a word takes: the word itself (marked =) or its longest listed beginning."""
    if "=" + word in arcs:
        return "=" + word
    for n in reversed(PREFIXES):
        if len(word) > n and word[:n] in arcs:
            return word[:n]
    return None


_CLAUSE = re.compile(rb"[A-Z]*[a-z]|[A-Z]+")
_HEAD = re.compile(rb"[IT]", re.I)


class Clauses(list):
    """best_paths of each clause of a text that has a head, and the number of words of the whole text."""

    words = 0


def clauses(text: str, read, arcs: dict[str, float]) -> Clauses:
    """The clauses of a whole text that have a head."""
    symbols, parts = read(text)
    found = Clauses()
    found.words = len(parts)
    if not _HEAD.search(symbols):
        return found
    for clause in _CLAUSE.finditer(symbols):
        line = clause.group().upper().replace(b"B", b"O")
        if not _HEAD.search(line):
            continue
        own = parts[clause.start():clause.end()]
        weights = [arcs[arc_of(_trim(p), arcs)] if s == INSULT else THREAT_WEIGHT if s == THREAT else 0.0 for s, p in zip(line, own)]
        found.append(best_paths(line, weights, [p[0] in QUOTES and p[-1] in QUOTES for p in own]))
    return found


def features(found: Clauses) -> list[float]:
    """FEATURES of the clauses of one text; density is clauses with a head in a hundred words (line ends count as words)."""
    from math import log1p

    sums = dict.fromkeys(CLASSES, 0.0)
    for paths in found:
        for c, weight in paths.items():
            sums[c] += weight
    # The weight of the best direct path that is an insult or finds its target.
    largest = max((w for paths in found for (head, voice, target), w in paths.items() if voice == "direct" and (target or head == "insult")), default=0.0)
    return [log1p(sums[c]) for c in CLASSES] + [log1p(len(found)), largest, log1p(100 * len(found) / max(found.words, 1))]


def _text_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, label, fold) of the labelled documents; labels are a bounded sample, so they are broadcast."""
    return (docs.select("doc_id", "text").join(F.broadcast(labels), "doc_id")
            .select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), "label",
                    (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5).cast("int").alias("fold")))


def learn_arcs(rows: DataFrame) -> dict[str, float]:
    """Insult arcs from labelled texts: seeds, and words and beginnings that toxic rows hold far more often.

    An arc's weight is its log odds against the labels' odds.  Words are
    counted once a document, and copies of a text count once; a beginning
    counts the words that it begins.
    """
    rows = rows.groupBy(F.sha2("text", 256)).agg(F.first("text").alias("text"), F.max("label").alias("label"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        toxic, clean = Counter(), Counter()

        def table() -> pa.RecordBatch:
            words = list(toxic | clean)
            out = pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array([toxic[w] for w in words], pa.int64()),
                 pa.array([clean[w] for w in words], pa.int64())], ["word", "toxic", "clean"])
            toxic.clear()
            clean.clear()
            return out

        for b in batches:
            for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = {_trim(p) for p in set(text.lower().split())}
                (toxic if label else clean).update(w for w in words if w)
                if len(toxic) + len(clean) > 300_000:
                    yield table()
        yield table()

    words = rows.select("text", "label").mapInArrow(count, "word string, toxic long, clean long")
    arc = F.explode(F.concat(
        F.array(F.concat(F.lit("="), F.col("word"))),
        *[F.when(F.length("word") > n, F.array(F.substring("word", 1, n))).otherwise(F.array().cast("array<string>"))
          for n in PREFIXES]))
    t, c = F.col("toxic"), F.col("clean")
    sums = rows.agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")).first()
    n_toxic, n_clean = sums["toxic"] or 0, sums["clean"] or 0
    seeds = {f"={w}": SEED_WEIGHT for w in INSULTS}
    if not n_toxic or not n_clean:
        return seeds
    p = n_toxic / (n_toxic + n_clean)

    def part(x, share):
        return F.when(x > 0, x * F.log(x / ((t + c) * share))).otherwise(0.0)

    learned = (words.select(arc.alias("arc"), "toxic", "clean").groupBy("arc").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
               .where((t >= MIN_SUPPORT * n_toxic) & (t > MIN_SHARE * (t + c)) & (2 * (part(t, p) + part(c, 1 - p)) > MIN_G2))
               .withColumn("weight", F.log((t + 0.5) / (c + 0.5) * ((1 - p) / p))).select("arc", "weight"))
    # MAX_LABELS texts and MIN_SUPPORT bound these: 1 / MIN_SUPPORT times the arcs of an average toxic text.
    arcs = {r["arc"]: float(r["weight"]) for r in learned.collect()}
    return seeds | {a: w for a, w in arcs.items() if w > 0}


def _feature_rows(docs: DataFrame, arcs: dict[str, float], columns: list[str], schema: str) -> DataFrame:
    """columns of docs (text last, replaced by its features)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = lexer(arcs)
        for b in batches:
            found = [features(clauses(t or "", read, arcs)) for t in b.column(len(columns) - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(k) for k in range(len(columns) - 1)] + [pa.array(found, pa.list_(pa.float64()))],
                [*columns[:-1], "features"])

    return docs.select(*columns).mapInArrow(scan, schema)


def fit(spark: SparkSession, docs: DataFrame, sf_dir: str, max_labels: int = MAX_LABELS) -> dict:
    """The grammar's arcs and the weights of the score, from labelled rows that are not held out.

    Arcs come from three of the four learning folds; the score's weights from
    the fourth, so that they don't trust arcs that only fit their own rows.
    The weights stay near PRIOR where labels are few, and are PRIOR without
    labels of both kinds.
    """
    import numpy as np

    rows = _text_rows(docs, training_labels(spark, sf_dir, "toxic", max_labels))
    arcs = learn_arcs(rows.where("fold <> 1"))
    table = _feature_rows(rows.where("fold = 1"), arcs, ["label", "text"], "label int, features array<double>").toPandas()
    prior = np.array(PRIOR)
    weights = prior.copy()
    if table["label"].nunique() == 2:
        x = np.column_stack([np.ones(len(table)), np.array(table["features"].tolist())])
        y = table["label"].to_numpy(float)
        # Accelerated projected gradient: evidence of an insult never lowers a score.
        step = 1 / (0.25 * np.linalg.eigvalsh(x.T @ x)[-1] + 1)
        ahead, pace = weights.copy(), 1.0
        for _ in range(4000):
            gradient = x.T @ (1 / (1 + np.exp(-x @ ahead)) - y) + (ahead - prior)
            new = ahead - step * gradient
            new[1:] = np.maximum(new[1:], 0)
            faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
            ahead, weights, pace = new + (pace - 1) / faster * (new - weights), new, faster
    return {"arcs": arcs, "weights": weights.tolist()}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, row keys, features, score and predicted of every row of docs.

    Null text counts as empty; a text without a match has the model's lowest
    score.  A null doc_id stays null.  An empty table gives no rows.
    """
    keyed = row_keys(docs).withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("text", F.col("text").cast("string"))
    rows = _feature_rows(keyed, model["arcs"], ["doc_id", "_id_key", "_text_key", "text"],
                         "doc_id long, _id_key long, _text_key long, features array<double>")
    bias, *weights = model["weights"]
    line = F.lit(bias)
    for k, w in enumerate(weights):
        line = line + F.col("features")[k] * w
    return (rows.withColumn("score", 1 / (1 + F.exp(-line)))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def query(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs."""
    return score(docs, fit(spark, docs, sf_dir)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of docs that the grammar does not call toxic, whole and with all their columns.

    The score is computed beside the row, so nothing is shuffled and repeated
    rows stay repeated.
    """
    model = fit(spark, docs, sf_dir)
    arcs, (bias, *weights) = model["arcs"], model["weights"]

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = lexer(arcs)
        for b in batches:
            line = [bias + sum(f * w for f, w in zip(features(clauses(t or "", read, arcs)), weights))
                    for t in b.column(b.schema.get_field_index("text")).to_pylist()]
            yield b.filter(pa.array([x < 0 for x in line], pa.bool_()))  # a score below 0.5

    return docs.mapInArrow(keep, docs.schema)
