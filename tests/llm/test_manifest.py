"""Merkle manifest against a brute force that hashes whole runs; its SQL is compared in test_queries."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from demandlake.llm import manifest

KIND = "doc_id long, text string, lang string, source string, n_chars long"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, text):
    return H(*map(field, (r[0], r[3], r[2], r[4], text)))


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([H(*found[-1][i:i + 16]) for i in range(0, len(found[-1]), 16)])
    return found


def climb(found, at, digest, proof):
    """Hash the whole run of every level again."""
    for level in found[:-1]:
        lo = at // 16 * 16
        run = level[lo:lo + 16]
        proof += run[:at - lo] + run[at - lo + 1:]
        digest = H(*run[:at - lo], digest, *run[at - lo + 1:])
        at //= 16
    return digest, proof


def brute(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[3]].append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[s] = levels([leaf(r, r[1]) for r in by[s]])
    over = levels([trees[s][-1][0] for s in names])
    out = []
    for i, s in enumerate(names):
        for k, r in enumerate(by[s]):
            text = r[1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            digest, proof = climb(trees[s], k, leaf(r, text), [])
            digest, proof = climb(over, i, digest, proof)
            out.append((r[0], leaf(r, r[1]), trees[s][-1][0], over[-1][0], H(*proof), digest, digest == over[-1][0]))
    return Counter(out)


def audit(spark, rows, more=lambda df: df):
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return Counter(tuple(r[c] for c in columns) for r in manifest.audit(more(spark.createDataFrame(rows, KIND))).collect())


LONG = "É Word " * 150_000
CASES = {
    "one row": [(1, "Text", "en", "a", 4)],
    "one row that is tampered with": [(35, "Text", "en", "a", 4)],
    "null fields": [(None, None, None, None, None), (None, "T", None, None, 1), (3, "", None, "", 0), (4, "X", "en", None, None)],
    "repeated rows and ids": [(7, "Same", "en", "a", 4)] * 40 + [(7, f"O{i % 3}", "en", "a", 2) for i in range(40)],
    "a run and one": [(i, f"T{i}", "en", "a", 2) for i in range(17)] + [(i, f"T{i}", "en", "b", 2) for i in range(16)],
    "hot source over several runs": [(i, f"Text {i}", "en", "hot", i % 9) for i in range(8200)]
    + [(i, "A", "de", f"s{i % 20}", 1) for i in range(100)],
    "many sources": [(i, f"T{i}", "en", f"ß{i % 300}", 2) for i in range(900)],
    "a very long text": [(35, LONG, "en", "a", len(LONG)), (36, LONG, "en", "a", len(LONG))],
}


@pytest.mark.parametrize("case", CASES)
def test_audit_matches_brute_force(spark, case):
    assert audit(spark, CASES[case]) == brute(CASES[case])


def test_more_sources_than_a_run(spark):
    rows = [(i, "T", "en", f"s{i}", 1) for i in range(manifest.RUN + 5)]
    assert audit(spark, rows) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], KIND)
    assert manifest.audit(empty).count() == 0
    rows = CASES["null fields"] + CASES["a run and one"]
    names = ("leaf", "changed", "position", "n", "run", "root", "path", "digest", "_at", "_nth", "_range", "first", "before", "rows")
    assert audit(spark, rows, lambda df: df.select("*", *(F.lit(1).alias(c) for c in names))) == brute(rows)


def test_fold_resumes_the_state_before_the_slot():
    digests = [H(str(i)) for i in range(16)]
    parent = manifest.Parent(digests)
    assert parent.digest == H(*digests)
    for slot in range(16):
        assert parent.states[slot].hexdigest() == H(*digests[:slot])
        assert parent.fold(slot, H("x")) == H(*digests[:slot], H("x"), *digests[slot + 1:])
        assert parent.siblings(slot) == "".join(digests[:slot] + digests[slot + 1:])
    assert parent.digest == H(*digests)  # folding leaves the retained states alone


def test_no_task_holds_more_than_a_run(spark):
    rows = [(i, f"T{i}", "en", "hot", 1) for i in range(3 * manifest.RUN)]
    placed = manifest.leaves(spark.createDataFrame(rows, KIND))
    assert sorted(r.position for r in placed.collect()) == list(range(len(rows)))
    runs = placed.groupBy("source", F.floor(F.col("position") / manifest.RUN)).count()
    assert [r["count"] for r in runs.collect()] == [manifest.RUN] * 3
