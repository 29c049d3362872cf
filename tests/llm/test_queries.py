"""Registered queries against their SQL; the pipeline against brute force."""

import os
import sys
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from . import brute

queries = pytest.importorskip("demandlake.llm.queries")
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline  # noqa: E402
from demandlake.llm import toxicity  # noqa: E402
from demandlake.llm.common import documents, written  # noqa: E402


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_its_sql(spark, sf_dir, name):
    got = queries.QUERIES[name](spark, sf_dir).toPandas()
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    want = con.execute(queries.ORACLE_SQL[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert Counter(map(tuple, got[columns].astype(str).values)) == Counter(map(tuple, want[columns].astype(str).values))


def test_every_operator_is_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))


def test_pipeline_matches_brute_force(spark):
    """Every stage on what its predecessor kept, then the packed pieces."""
    from tokenizers import Tokenizer

    from demandlake.llm.packing import tokenizer_path

    sf_dir = "/root/testdata/sf0.001"
    docs = documents(spark, sf_dir)
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    model = toxicity.fit(spark, docs, sf_dir)
    read = toxicity.lexer(model["arcs"])

    def toxic(text):
        found = toxicity.features(toxicity.clauses(text, read, model["arcs"]))
        return model["weights"][0] + np.dot(model["weights"][1:], found) >= 0

    stages, out = dict(corpus_pipeline.STAGES), docs
    want = [r for r in rows if not toxic(r[1])]
    for name in ("toxicity", "exact_dedup", "simhash_neardup", "mixing"):
        out = written(stages[name](spark, out, sf_dir), "test")
        assert out.columns == docs.columns
        if name == "exact_dedup":
            groups = brute.exact([r[:2] for r in want])
            want = [want[k] for k in sorted({g[2] for g in groups.values()})]
        elif name == "simhash_neardup":
            root = brute.components([brute.fingerprint(r[1]) for r in want])
            least = {}
            for r, g in zip(want, root):
                least[g] = min(least.get(g, r[0]), r[0])
            want = [r for r in want if r[0] in set(least.values())]
        elif name == "mixing":
            text = {r[0]: r for r in want}
            want = [text[d] for draws in brute.schedule(want).values() for _, _, d in draws]
        assert Counter((r.doc_id, r.text, r.source) for r in out.collect()) == Counter(want), name
    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    expect = defaultdict(int)
    for doc, t, _ in want:
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4")
        at, rest = 0, len(ids)
        while rest:
            size = min(2048, 1 << rest.bit_length() - 1)
            expect[doc, at, size, zlib.crc32(ids[at:at + size].tobytes())] += 1
            at, rest = at + size, rest - size
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in pieces) == expect
