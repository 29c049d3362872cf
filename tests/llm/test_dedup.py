"""Exact and near duplicates against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from . import brute

exact_dedup = pytest.importorskip("demandlake.llm.exact_dedup")
from demandlake.llm import queries, simhash  # noqa: E402

ROWS = ([(k, "the same  text", k) for k in range(40)] + [(41, "the  same text ", 1), (42, "thesametext", 2), (None, "the same    text", 3),
        (50, None, 4), (51, "", 5), (52, " \t\n", 6), (53, "only one", 7), (53, "only one", 7), (54, "zwei drei", 8), (55, "zweidrei", 9),
        (56, "tie a", 1), (57, "tie a", 1), (None, "no id", 1), (None, "no id", 1)])


@pytest.fixture(scope="module")
def docs(spark):
    """Extra columns take names that the operators use themselves."""
    return spark.createDataFrame([(a, b, "en", "s", c, c, c, c) for a, b, c in ROWS],
                                 "doc_id long, text string, lang string, source string, n_chars int, _id_key int, digest int, fp int")


def test_exact_groups_match_brute_force(docs):
    want = brute.exact([r[:2] for r in ROWS])
    expect = sorted((str(ROWS[k][0]), str(v[0]), v[1], brute.sha(brute.normalised(ROWS[k][1]))) for k, v in want.items())
    got = exact_dedup.groups(docs).select("doc_id", "keep_id", "group_size", F.lower(F.hex("digest")), "kept").collect()
    assert sorted((str(r[0]), str(r[1]), r[2], r[3]) for r in got) == expect
    assert all(r["kept"] == (r[0] == r[1]) for r in got if r[0] is not None)


def test_exact_dedup_keeps_one_whole_row_of_each_group(docs):
    kept = exact_dedup.dedup(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert len(rows) == len({brute.normalised(r[1]) for r in ROWS})
    assert {brute.normalised(r.text) for r in rows} == {brute.normalised(r[1]) for r in ROWS}
    assert next(r for r in rows if brute.normalised(r.text) == "thesametext").doc_id is None  # most code points


def test_heavy_digests_are_found(spark):
    slim = spark.range(20_000).select(F.unhex(F.sha2(F.when(F.col("id") % 3 == 0, "x").otherwise(F.col("id").cast("string")), 256)).alias("digest"))
    keys = {r.key for r in exact_dedup.frequent_keys(slim.repartition(7)).collect()}
    want = int.from_bytes(bytes.fromhex(brute.sha("x"))[:8], "big", signed=True)
    assert want in keys and len(keys) <= 2 * exact_dedup.HEAVY_SHARE


@pytest.mark.parametrize("operator", [exact_dedup.groups, exact_dedup.dedup, simhash.groups, simhash.dedup])
def test_empty_table(docs, operator):
    assert operator(docs.where("false")).collect() == []


def test_trie_pairs_match_brute_force():
    rng = np.random.default_rng(1)
    values = set()
    for base in rng.integers(0, 2**63, 30).tolist():
        for _ in range(25):
            x = base
            for bit in rng.integers(0, 64, rng.integers(0, 4)).tolist():
                x ^= 1 << bit
            values.add(x)
    values = np.array(sorted(values), np.uint64)
    found = set()
    for i, j in simhash.trie_pairs(values, [(0, len(values), 0, len(values), 0)], 63, 3, block=500):
        found |= {(min(p), max(p)) for p in zip(i.tolist(), j.tolist())}
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 3
    assert found == {(i, j) for i, j in zip(*np.nonzero(near)) if i < j}


@pytest.mark.parametrize("node_limit", [simhash.NODE_LIMIT, 20, 2])
def test_links_keep_components_whole_at_any_node_limit(spark, node_limit):
    rnd = random.Random(3)
    prints = set()
    for _ in range(12):
        x = rnd.getrandbits(64)
        for _ in range(14):  # chains of steps: components are wider than three bits
            prints.add(x)
            for _ in range(rnd.randint(1, 4)):
                x ^= 1 << rnd.randrange(64)
    prints = sorted(prints)
    want = brute.components(prints)
    table = spark.createDataFrame([(p - 2**64 if p >= 2**63 else p,) for p in prints], "fp long")
    stars = {r.node % 2**64: r.root % 2**64 for r in simhash.components(simhash.links(table, 3, node_limit)).collect()}
    got = {}
    for p in prints:
        got.setdefault(stars.get(p, p), set()).add(p)
    expect = {}
    for p, r in zip(prints, want):
        expect.setdefault(r, set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expect.values()))


def test_simhash_query_matches_brute_force(spark, tmp_path):
    rnd = random.Random(4)
    vocabulary = [f"Wort{k}É" for k in range(300)]
    rows = []
    for k in range(30):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(1, 300))]
        for _ in range(3):
            rows.append((len(rows), rnd.choice([" ", "\n", "\t "]).join(words)))
            words = list(words)
            words[rnd.randrange(len(words))] = "neu"
    rows += [(900, None), (901, ""), (902, "two words"), (902, "two words"), (None, "two words"), (903, "w " * 40_000)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
    prints = [brute.fingerprint(t) for _, t in rows]
    root = brute.components(prints)
    least = {}
    for (doc, _), r in zip(rows, root):
        if doc is not None:
            least[r] = min(least.get(r, doc), doc)
    expect = sorted((str(doc), f"{p:016x}", str(least.get(r))) for (doc, _), p, r in zip(rows, prints, root))
    got = queries.op4_simhash_neardup(spark, str(tmp_path)).collect()
    assert sorted((str(r[0]), r[1], str(r[2])) for r in got) == expect
    kept = simhash.dedup(spark.read.parquet(path)).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(set(least.values()))
    assert sum(r.doc_id is None for r in kept) == 1
