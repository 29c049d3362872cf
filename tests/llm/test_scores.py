"""Toxicity, quality and language scores: mechanisms on small inputs, accuracy on held-out rows."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

toxicity = pytest.importorskip("demandlake.llm.toxicity")
from demandlake.llm import langid, quality_gam, quality_rules, queries  # noqa: E402
from demandlake.llm.common import documents, training_labels  # noqa: E402

from . import brute  # noqa: E402

ARCS = {"=idiot": 3.0, "lowei": 4.0}


def paths(text):
    return toxicity.clauses(text, toxicity.lexer(ARCS), ARCS)


def enumerated(symbols, weights, quoted):
    """Every path of a clause: each head, alone and with each target, its voice read word by word."""
    best = {}
    for h, symbol in enumerate(symbols):
        if symbol not in "IT":
            continue
        negated = reported = False
        for k in range(h):
            between = symbols[k + 1:h]
            negated |= symbols[k] == "N" and len(between) < 3 and set(between) <= set("OG")
            reported |= symbols[k] == "R" and len(between) < 7 and set(between) <= set("OGN")
        reported |= quoted[h]
        voice = {(0, 0): "direct", (1, 0): "negated", (0, 1): "reported", (1, 1): "both"}[int(negated), int(reported)]
        head = ("insult" if symbol == "I" else "threat", voice)
        ways = [(False, weights[h])] + [(True, weights[h] * 0.85 ** (abs(g - h) - 1)) for g, s in enumerate(symbols) if s == "G"]
        for target, w in ways:
            best[*head, target] = max(best.get((*head, target), 0.0), w)
    return best


def test_best_paths_agree_with_all_paths():
    rnd = random.Random(12)
    for _ in range(4000):
        symbols = "".join(rnd.choices("OITGNR", (6, 1, 1, 2, 1, 1), k=rnd.randint(1, 14)))
        weights = [rnd.choice([0.5, 1.0, 3.0]) for _ in symbols]
        quoted = [rnd.random() < 0.1 for _ in symbols]
        got = toxicity.best_paths(symbols.encode(), weights, quoted)
        want = enumerated(symbols, weights, quoted)
        assert got.keys() == want.keys() and all(abs(got[c] - want[c]) < 1e-9 for c in want), symbols


def test_composition_is_the_product_of_both_machines():
    negation, report = toxicity.reaching(ord("N"), b"OG", 3), toxicity.reaching(ord("R"), b"OGN", 7)
    states, arcs = toxicity.compose(negation, report)
    rnd = random.Random(1)
    for _ in range(300):
        a = b = at = 0
        for symbol in rnd.choices(b"OITGNR", k=30):
            a, b, at = negation[a, symbol], report[b, symbol], arcs[at][symbol]
            assert states[at] == (a, b)
    assert len(states) == len(set(states)) <= 4 * 8


@pytest.mark.parametrize("text, want", [
    ("An idiot. Fine.", [{("insult", "direct", False): 3.0}]),
    ("you are an IDIOT, friend", [{("insult", "direct", False): 3.0, ("insult", "direct", True): 3 * 0.85 ** 2}]),
    ("idiot that you are", [{("insult", "direct", False): 3.0, ("insult", "direct", True): 3 * 0.85}]),
    ("you said. An idiot", [{("insult", "direct", False): 3.0}]),
    ("it is not an idiot", [{("insult", "negated", False): 3.0}]),
    ("it was not there. idiot", [{("insult", "direct", False): 3.0}]),
    ("who said it is an idiot", [{("insult", "reported", False): 3.0}]),
    ("who said it is not an idiot", [{("insult", "both", False): 3.0}]),
    ('the word "idiot" here', [{("insult", "reported", False): 3.0}]),
    ("ein loweischaft und", [{("insult", "direct", False): 4.0}]),
    ("lowei alone and idiotic", []),
    ("I will kill you", [{("threat", "direct", False): 3.0, ("threat", "direct", True): 3.0}]),
    ("I will kill every single last one of you", [{("threat", "direct", False): 3.0, ("threat", "direct", True): 3 * 0.85 ** 5}]),
    ("I will not kill you", [{("threat", "negated", False): 3.0, ("threat", "negated", True): 3.0}]),
    ("kill the process. you", [{("threat", "direct", False): 3.0}]),
    ("an idiot\nand an idiot", [{("insult", "direct", False): 3.0}] * 2),
    ("", []), ("\n\n . ", []),
])
def test_clauses_by_class(text, want):
    found = paths(text)
    assert len(found) == len(want)
    for got, expect in zip(found, want):
        assert got == pytest.approx(expect)
    assert len(toxicity.features(found)) == len(toxicity.FEATURES) == len(toxicity.PRIOR) - 1 and any(toxicity.features(found)) == bool(want)


def test_few_labels_leave_the_fixed_weights(spark, tmp_path):
    rows = [(0, "you are an idiot", 1), (1, "fine words", 0), (2, "he is not an idiot", 0), (3, "I will kill you", 1), (4, "kill the process", 0),
            (5, None, 0), (6, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    docs.select("doc_id", "toxic").write.parquet(str(tmp_path / "labels.parquet"))
    found = {r.doc_id: r.score for r in toxicity.query(spark, docs, str(tmp_path)).collect()}
    assert min(found[0], found[3]) > 0.5 > max(found[k] for k in (1, 2, 4, 5, 6))
    assert toxicity.clean(spark, docs, str(tmp_path)).count() == 5


def test_threats_without_a_target_are_learned(spark, tmp_path):
    rnd = random.Random(3)
    rows = []
    for k in range(700):
        words = ["".join(rnd.choices("bdfglmn", k=5)) for _ in range(20)]
        toxic = int(rnd.random() < 0.3)
        if toxic:  # every threat word is too rare to become an arc
            words.insert(5, f"{rnd.choice(toxicity.THREATS)}")
        rows.append((k, " ".join(words), toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    docs.select("doc_id", "toxic").write.parquet(str(tmp_path / "labels.parquet"))
    fitted = toxicity.fit(spark, docs, str(tmp_path))
    assert fitted["weights"][1 + toxicity.FEATURES.index(("threat", "direct", False))] > 1
    assert all(w >= 0 for w in fitted["weights"][1:])


def test_long_text_is_read_whole():
    assert paths("fine words here. " * 30_000 + "idiot") == [{("insult", "direct", False): 3.0}]


@pytest.fixture(scope="module")
def labelled(spark, tmp_path_factory):
    """Two languages; toxic rows hold words with an invented beginning, low quality rows hold symbols."""
    rnd = random.Random(8)
    path = tmp_path_factory.mktemp("labelled")
    words = {"xx": ["ban", "dor", "mila", "rotu", "sefa"], "yy": ["zwö", "krü", "plä", "strö", "tsch"]}
    rows, labels = [], []
    for k in range(1500):
        lang = rnd.choice(["xx", "yy"])
        text = ["".join(rnd.choices(words[lang], k=rnd.randint(1, 3))) for _ in range(rnd.randint(5, 80))]
        toxic, good = int(rnd.random() < 0.2), int(rnd.random() < 0.8)
        if toxic:
            text.insert(rnd.randrange(len(text)), "grumf" + "".join(rnd.choices(words[lang], k=2)))
        if not good:
            text = [w + rnd.choice(["###", "$$$"]) for w in text]
        rows.append((k, " ".join(text), None if k % 50 == 0 else lang, "s", 1, 0.5))
        labels.append((k, good, toxic))
    rows += [(2000, None, "xx", None, 1, 0.5), (2001, "", "yy", "s", 1, 0.5), (2002, "12 !!", None, "s", 1, 0.5), (None, "bandor", "xx", "s", 1, 0.5),
             (2003, "bandor mila " * 60_000, "xx", "s", 1, 0.5), (2004, "again mila", "xx", "s", 1, 0.5), (2004, "again mila", "xx", "s", 1, 0.5)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, label int, score double").write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame(labels + [(None, 1, 1), (3, 1, None), (2001, None, None)], "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    return str(path), labels


@pytest.mark.parametrize("query, column", [("op3_toxicity", "toxic"), ("op8_quality_gam", "quality")])
def test_held_out_rows_are_scored_right(spark, labelled, query, column):
    path, labels = labelled
    rows = queries.QUERIES[query](spark, path).collect()
    assert len(rows) == 1507 and all(0 <= r.score <= 1 for r in rows)
    assert {r.held_out for r in rows if r.doc_id is None} == {True}
    truth = {k: (tox if column == "toxic" else good) for k, good, tox in labels}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert len(held) > 200
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    limit = 0.5 if column == "toxic" else 0.3
    assert all(r.predicted == int(r.score >= limit) for r in rows)
    assert len({r.score for r in rows if r.doc_id == 2004}) == 1


def test_labels_of_held_out_rows_are_never_read(spark, labelled):
    path, _ = labelled
    import zlib
    ids = [r.doc_id for r in training_labels(spark, path, "toxic", 10**6).collect()]
    assert ids and all(zlib.crc32(str(k).encode()) % 5 for k in ids)
    few = training_labels(spark, path, "toxic", 300).count()
    assert 200 < few < 400


def test_toxic_documents_go_and_the_rest_is_untouched(spark, labelled):
    path, labels = labelled
    docs = documents(spark, path)
    kept = toxicity.clean(spark, docs, path)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    toxic = {k for k, _, t in labels if t}
    assert len(toxic & ids) <= 0.03 * len(toxic) and len({k for k, _, t in labels if not t} - ids) <= 5
    assert {2000, 2001, 2002, 2003, 2004, None} <= ids
    assert toxicity.clean(spark, docs.where("false"), path).collect() == []
    assert toxicity.score(docs.where("false"), {"arcs": ARCS, "weights": [0.0] * 7}).collect() == []


def test_no_labels_at_all(spark, labelled, tmp_path):
    path, _ = labelled
    documents(spark, path).limit(20).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{path}/labels.parquet").where("false").write.parquet(str(tmp_path / "labels.parquet"))
    assert all(r.score < 0.5 for r in queries.op3_toxicity(spark, str(tmp_path)).collect())
    assert {r.score for r in queries.op8_quality_gam(spark, str(tmp_path)).collect()} == {0.5}


def test_gam_learns_a_pairwise_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 4)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.5)).astype(float)
    model = quality_gam.boost(x, y)
    assert (2, 0) in [p[:2] for p in model["pairs"]]
    bins = quality_gam.binned(x, model["cuts"])
    line = model["bias"] + sum(t[bins[:, k]] for k, t in enumerate(model["tables"])) + sum(t[bins[:, i], bins[:, j]] for i, j, t in model["pairs"])
    assert np.mean((line > 0) == (y > 0)) > 0.95
    flat = quality_gam.boost(np.ones((50, 4), np.float32), np.r_[np.zeros(25), np.ones(25)])
    assert flat["bias"] == 0 and all(not t.any() for t in flat["tables"])


def test_language_accuracy_and_edges(spark, labelled):
    path, _ = labelled
    rows = queries.op9_langid(spark, path).collect()
    truth = {r.doc_id: r.lang for r in documents(spark, path).collect()}
    assert len(rows) == 1507
    held = [r for r in rows if r.held_out and truth[r.doc_id] and r.doc_id is not None and r.doc_id < 1500]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) == 1.0
    assert {(r.lang_pred, r.score, r.rejected) for r in rows if r.doc_id in (2000, 2001, 2002)} == {("und", 0.0, True)}
    assert {r.lang_pred for r in rows if r.doc_id in (None, 2003, 2004)} == {"xx"}
    assert langid.query(spark, documents(spark, path).where("false")).collect() == []
    nothing = langid.query(spark, documents(spark, path).withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in nothing} == {"und"}


def test_kneser_ney_matches_brute_force(spark):
    texts = {"xx": ["abab abba", "baab  bb"], "yy": ["acca ca", "cab"]}
    rows = spark.createDataFrame([(t, lang) for lang, ts in texts.items() for t in ts], "text string, lang string")
    found = langid.probabilities(langid.counts(rows), ["xx", "yy"])
    n, d = langid.ORDER, langid.DISCOUNT

    def counts(lang):
        c = {n: Counter()}
        for t in texts[lang]:
            s = " " * (n - 1) + " ".join(t.split()) + " "
            c[n].update(s[i:i + n] for i in range(len(s) - n + 1))
        for k in range(n - 1, 0, -1):
            c[k] = Counter(g[1:] for g in c[k + 1])
        return c

    all_counts = {lang: counts(lang) for lang in texts}
    alphabet = len({g for c in all_counts.values() for g in c[1]}) + 1

    def p(lang, gram):
        if not gram:
            return 1 / alphabet
        c = all_counts[lang][len(gram)]
        total = sum(v for g, v in c.items() if g[:-1] == gram[:-1])
        kinds = sum(g[:-1] == gram[:-1] for g in c)
        low = p(lang, gram[1:])
        return max(c[gram] - d, 0) / total + d * kinds / total * low if total else low

    for k, (table, _) in enumerate(found, 1):
        for r in table.collect():
            gram = "".join(chr((r.gram % 2**64) >> 16 * (k - 1 - i) & 0xFFFF) for i in range(k))
            for lang, got in zip(["xx", "yy"], r.p):
                assert math.isclose(got, p(lang, gram), rel_tol=1e-9), (gram, lang)


@pytest.mark.parametrize("model_bytes", [langid.MODEL_BYTES, 20_000, 0])
def test_language_scores_match_brute_force(spark, monkeypatch, model_bytes):
    """More n-grams than a short hash can tell apart: none is taken for another, in arrays and in joined tables."""
    monkeypatch.setattr(langid, "MODEL_BYTES", model_bytes)
    rnd = random.Random(4)
    letters = [chr(0x4E00 + k) for k in range(2500)]
    texts = {lang: ["".join(rnd.choices(part, k=300)) for _ in range(60)] for lang, part in (("xx", letters[:1500]), ("yy", letters[1000:]))}
    n, d = langid.ORDER, langid.DISCOUNT
    model = {}
    for lang, ts in texts.items():
        c = {n: Counter(s[i:i + n] for t in ts for s in ["\n" * (n - 1) + t + "\n"] for i in range(len(s) - n + 1))}
        for k in range(n - 1, 0, -1):
            c[k] = Counter(g[1:] for g in c[k + 1])
        model[lang] = c, {k: Counter() for k in c}, {k: Counter(g[:-1] for g in c[k]) for k in c}
        for k in c:
            for g, v in c[k].items():
                model[lang][1][k][g[:-1]] += v
    alphabet = len({g for c, *_ in model.values() for g in c[1]}) + 1

    def p(lang, gram):
        if not gram:
            return 1 / alphabet
        c, total, kinds = (part[len(gram)] for part in model[lang])
        low = p(lang, gram[1:])
        h = gram[:-1]
        return max(c[gram] - d, 0) / total[h] + d * kinds[h] / total[h] * low if total[h] else low

    learn = [k for k in range(1000) if zlib.crc32(str(k).encode()) % 5][:120]
    held = [k for k in range(1000) if not zlib.crc32(str(k).encode()) % 5][:30]
    asked = {k: "".join(rnd.choices(letters, k=rnd.randint(1, 300))) for k in held}
    rows = [(k, t, lang) for k, (t, lang) in zip(learn, [(t, lang) for lang, ts in texts.items() for t in ts])] + [(k, t, None) for k, t in asked.items()]
    docs = spark.createDataFrame(rows + rows[-1:], "doc_id long, text string, lang string")
    fitted = langid.fit(docs)
    assert ("tables" in fitted) == (model_bytes < langid.ORDER * 10**5)
    found = langid.identify(docs.where("lang is null"), fitted, ["doc_id"]).collect()
    assert len(found) == len(asked) + 1
    for r in found:
        s = "\n" * (n - 1) + asked[r.doc_id] + "\n"
        grams = [s[i:i + n] for i in range(len(s) - n + 1)]
        want = {lang: -sum(math.log(p(lang, g)) for g in grams) / len(grams) for lang in texts}
        assert r.lang_pred == min(want, key=want.get)
        assert math.isclose(r.entropy, min(want.values()), rel_tol=1e-5)


def test_base_counts_match_brute_force(spark):
    rnd = random.Random(6)
    parts = ["a", "b", "Ü", "#", "<x>", "\n", "\n\n", " ", "\t", "a b", "\x1f", " ", "c\x0bd", "日本|", "line one\nline one\n"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 60))) for _ in range(500)] + [None, "", "w " * 50_000]
    rows = quality_rules.base_counts(spark.createDataFrame(
        [(k, t, "en", "s", 1) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_words int")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.base_counts(texts[r.doc_id])


def mcd_by_numpy(grid):
    """(mean, covariance, log determinant) of the best of the three starts on arrays."""
    q, k = quality_rules, len(quality_rules.STATISTICS)
    x, floor = grid / q.GRID, np.diag(np.square(q.FLOOR))
    low = np.sort(grid, axis=0)[(len(grid) - 1) // 2]
    away = 1.4826 * np.sort(np.abs(grid - low), axis=0)[(len(grid) - 1) // 2]
    unit = (grid - low) / np.maximum(away, np.array(q.FLOOR) * q.GRID)
    length = np.linalg.norm(unit, axis=1, keepdims=True)
    signs = np.round(q.GRID * np.divide(unit, length, out=np.zeros_like(unit), where=length > 0)) / q.GRID
    scale = np.maximum(away / q.GRID, q.FLOOR)
    starts = [(low / q.GRID, np.diag((away / q.GRID) ** 2)), (x.mean(axis=0), np.cov(x.T, bias=True)),
              (low / q.GRID, k * np.cov(signs.T, bias=True) * np.outer(scale, scale))]
    ends = []
    for mean, cov in starts:
        factor, before = 1.0, None
        while True:
            w = np.linalg.inv(factor * cov + floor)
            bins = np.round(q.LOG_GRID * np.log(np.maximum(np.einsum("ni,ij,nj->n", x - mean, w, x - mean), 0) + 1e-6))
            near = x[bins <= np.sort(bins)[math.ceil(q.COVER * len(x)) - 1]]
            new, factor = (near.mean(axis=0), np.cov(near.T, bias=True)), q.CONSISTENCY
            logdet = np.linalg.slogdet(factor * new[1] + floor)[1]
            if before is not None and logdet >= before - q.LEAST_FALL:
                break
            (mean, cov), before = new, logdet
        ends.append((mean, cov, before))
    return min(ends, key=lambda e: e[2]), [e[2] for e in ends]


def test_mcd_matches_numpy(spark, monkeypatch):
    """The distributed estimate against the same starts and steps on arrays; also where estimates are joined by salt."""
    rng = np.random.default_rng(5)
    k = len(quality_rules.STATISTICS)
    mix = rng.normal(size=(k, k))
    two = np.vstack([rng.normal(size=(500, k)) * 0.5, rng.normal(size=(460, k)) @ mix + 6])  # two clusters: starts end apart
    groups = {"a": np.vstack([rng.normal(size=(900, k)) @ mix + 3, rng.normal(size=(150, k)) * 0.2 + 40]), "b": two,
              "c": rng.normal(size=(7, k)), "d": np.ones((3, k)), "e": rng.normal(size=(1, k))}
    rows = {g: np.round(quality_rules.GRID * x).astype(int) for g, x in groups.items()}
    table = spark.createDataFrame([(g, i, *map(int, r)) for g, x in rows.items() for i, r in enumerate(x)],
                                  f"_group string, _salt long, {', '.join(s + ' long' for s in quality_rules.STATISTICS)}")
    spread = []
    for limit in (quality_rules.BROADCAST_GROUPS, 2):
        monkeypatch.setattr(quality_rules, "BROADCAST_GROUPS", limit)
        found = {r._group: r for r in quality_rules.mcd(table).collect()}
        assert {g: r.n for g, r in found.items()} == {g: len(x) for g, x in rows.items()}
        for g, grid in rows.items():
            (mean, cov, logdet), ends = mcd_by_numpy(grid)
            spread.append(max(ends) - min(ends))
            assert found[g].logdet == pytest.approx(logdet, abs=0.02), g
            assert np.allclose([found[g][f"m{i}"] for i in range(k)], mean, atol=0.02), g
            assert np.allclose([found[g][f"c{i}{j}"] for i in range(k) for j in range(i + 1)],
                               [cov[i, j] for i in range(k) for j in range(i + 1)], rtol=0.05, atol=0.02 * np.abs(cov).max() + 1e-9), g
    assert max(spread) > 0.5  # one start alone would have ended elsewhere


def test_estimates_change_smoothly_with_rows_and_rows_stay_where_they_are(spark):
    """199 and 200 rows of a source are judged nearly alike, and few rows of another kind are not driven out by many."""
    rnd = random.Random(3)

    def text(size):
        return " ".join("".join(rnd.choices("abcdefgh", k=size)) + ("#" if rnd.random() < 0.02 else "") for _ in range(rnd.randint(80, 120)))

    big = [text(5) for _ in range(900)]
    small = [text(11) for _ in range(200)]
    distances = {}
    for n in (5, 199, 200):
        docs = spark.createDataFrame([(i, t, "en", "big") for i, t in enumerate(big)] + [(10_000 + i, t, "en", "small") for i, t in enumerate(small[:n])],
                                     "doc_id long, text string, lang string, source string")
        found = {r.doc_id: r for r in quality_rules.judged(docs).collect()}
        assert sum(not r.kept for r in found.values()) <= 0.02 * len(found)
        distances[n] = [found[10_000 + i].distance for i in range(5)]
    assert np.allclose(distances[199], distances[200], rtol=0.25, atol=0.2)


def test_no_exchange_moves_rows_by_group(spark):
    rows = spark.range(2000).select(F.concat(F.lit("g"), (F.col("id") % 2).cast("string")).alias("_group"), F.col("id").alias("_salt"),
                                    *[(F.hash("id", F.lit(i)) % 900).cast("long").alias(s) for i, s in enumerate(quality_rules.STATISTICS)])
    joined = quality_rules._attached(rows, rows.groupBy("_group").agg(F.count("*").alias("n")), 2)
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    salted = quality_rules._attached(rows, rows.groupBy("_group").agg(F.count("*").alias("n")), quality_rules.BROADCAST_GROUPS + 1)
    assert salted.count() == 2000 and "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()


def test_quality_rules_reject_outliers_only(spark):
    rnd = random.Random(7)
    rows = []
    for k in range(700):
        words = ["".join(rnd.choices("abcdefgh", k=rnd.randint(2, 9))) for _ in range(rnd.randint(60, 300))]
        if k % 20 == 0:
            words = [w + "###" for w in words]
        rows.append((k, " ".join(words), "en" if k % 3 else None, f"s{k % 2}", 1))
    rows += [(800, None, "en", "s0", 1), (801, "", "en", None, 1), (802, "same words " * 100, "en", "s0", 1), (803, "short", None, None, 1),
             (None, rows[1][1] + " z", "en", "s1", 1), rows[2], rows[2]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, distance int")
    found = quality_rules.judged(docs).collect()
    assert len(found) == len(rows)
    verdict = defaultdict(set)
    for r in found:
        verdict[r.doc_id].add((r.base_failed, r.kept))
    assert all(verdict[k] == {(False, k % 20 != 0)} for k in range(700))
    assert all(verdict[k] == {(True, False)} for k in (800, 801, 802, 803))
    kept = quality_rules.kept(docs)
    assert kept.columns == docs.columns and kept.count() == 700 - 35 + 1
    assert quality_rules.judged(docs.where("false")).collect() == []


def test_repeated_halves_and_duplicate_lines_are_outliers(spark):
    rnd = random.Random(10)

    def words(n):
        return ["".join(rnd.choices("abcdefghij", k=rnd.randint(3, 8))) for _ in range(n)]

    rows = [(k, "\n".join(" ".join(words(10)) for _ in range(20))) for k in range(400)]
    line = " ".join(words(10))
    rows.append((1000, "\n".join([line] * 10 + [" ".join(words(10)) for _ in range(10)])))  # half the words are one line
    rows.append((1001, "\n".join([" ".join(words(2))] * 30 + [" ".join(words(10)) for _ in range(14)])))
    rows.append((1002, " ".join(words(100) + words(20) * 5)))
    short = [" ".join(words(10)) for _ in range(4)]
    rows.append((1003, "\n".join(short * 2 + [" ".join(words(12)) for _ in range(12)])))  # each of four lines twice
    docs = spark.createDataFrame([(k, t, "en", "s") for k, t in rows], "doc_id long, text string, lang string, source string")
    found = {r.doc_id: r for r in quality_rules.judged(docs).collect()}
    assert not any(found[k].base_failed for k in (1000, 1001, 1002, 1003))
    assert [k for k, r in sorted(found.items()) if not r.kept] == [1000, 1001, 1002, 1003]


def test_every_learning_row_calibrates_the_language_scores(spark, monkeypatch):
    docs = spark.range(27_000).select(F.col("id").alias("doc_id"), F.lit("xx").alias("lang"), F.concat(F.lit("word "), F.col("id")).alias("text"))
    seen, identify = [], langid.identify

    def watched(rows, model, columns):
        seen.append(rows.count())
        return identify(rows, model, columns)

    monkeypatch.setattr(langid, "identify", watched)
    langid.fit(docs)
    assert seen == [sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(27_000))]
