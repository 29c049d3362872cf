"""Packing and mixing against brute force."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from . import brute

packing = pytest.importorskip("demandlake.llm.packing")
from demandlake.llm import mixing  # noqa: E402

TEXTS = ["", None, "a", "Hello  world\n\n it's  fine", "  lead", "tail  ", "²³ Ⅷ x² ٣ 日本", "a\x1cb \x85 c​", "<|endoftext|> x <|endoftext|>",
         "word, word. word!! don't 12 345", "x" * 9000, "é ü " * 3000, "\n" * 50 + " y", "😀 ok", "\t\ttab\r\nline"]


def test_encoder_equals_the_tokenizer():
    from random import Random

    from tokenizers import Tokenizer

    tokenizer, encode, rnd = Tokenizer.from_file(packing.tokenizer_path()), packing.encoder(packing.tokenizer_path(), 50), Random(2)
    parts = ["a", "B", " ", "  ", "\n", "'s", "é", "1", "²", "_", "-", "日本", "\x1c", " ", "don't", "😀", "\r\n", " x", "<|endoftext|>", "́"]
    for text in [t or "" for t in TEXTS] + ["".join(rnd.choices(parts, k=rnd.randint(0, 14))) for _ in range(3000)]:
        assert encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text[:40]


def test_encoder_is_made_once_per_process():
    """Reading the tokenizer costs half a second, too much for every task of a worker."""
    encode = packing.encoder(packing.tokenizer_path())
    assert packing.encoder(packing.tokenizer_path()) is encode
    assert encode("word  word\n") == packing.encoder(packing.tokenizer_path(), 50)("word  word\n")


def test_lengths_are_powers_of_two():
    for n in (1, 2, 3, 2047, 2048, 2049, 9999):
        found = packing.lengths(n, 2048)
        assert sum(found) == n and all(x & (x - 1) == 0 and x <= 2048 for x in found) and found == sorted(found, reverse=True)
        assert max(Counter(x for x in found if x < 2048).values(), default=1) == 1


def test_packed_round_trip(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    docs = spark.createDataFrame([(k, t, 1, 2) for k, t in enumerate(TEXTS)], "doc_id long, text string, start int, ids int")
    ids = {k: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for k, t in enumerate(TEXTS)}
    got = packing.packed(docs).collect()
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
    assert set(by_doc) == set(ids)
    for k, rows in by_doc.items():
        rows.sort(key=lambda r: r.start)
        at = 0
        for r in rows:
            part = np.array(ids[k][r.start:r.start + r.length], "<u4").tobytes()
            assert (r.start, r.doc_tokens, r.ids_crc32, r.offset) == (at, len(ids[k]), zlib.crc32(part), 0)
            assert 1 << r.bucket == r.length
            at += r.length
        assert at == len(ids[k])
    assert len({r.sequence_id for r in got}) == len(got)
    whole = {(r.doc_id, r.start): r.ids for r in packing.pieces(docs).collect()}
    assert all(zlib.crc32(whole[r.doc_id, r.start]) == r.ids_crc32 for r in got)


def test_packing_edges(spark):
    docs = spark.createDataFrame([(None, "no id"), (5, "twice"), (5, "twice")], "doc_id long, text string")
    got = packing.packed(docs).collect()
    assert len({r.sequence_id for r in got}) == len(got) and sum(r.doc_id == 5 and r.start == 0 for r in got) == 2
    assert packing.packed(docs.where("false")).collect() == []
    with pytest.raises(ValueError):
        packing.pieces(docs, 1000)


SOURCES = [("a", 60), ("b", 12), ("c", 5), (None, 9)]


@pytest.fixture(scope="module")
def mix_rows():
    rows, k = [], 0
    for source, n in SOURCES:
        for i in range(n):
            rows.append((k, " ".join(["w"] * ((i * 7) % 23)) if i else None, source))
            k += 1
    return rows


@pytest.mark.parametrize("shard_rows", [mixing.SHARD_ROWS, 7])
def test_schedule_matches_brute_force(spark, mix_rows, shard_rows, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_ROWS", shard_rows)
    docs = spark.createDataFrame([(*r, 1, 2) for r in mix_rows], "doc_id long, text string, source string, epoch int, key int")
    got = defaultdict(list)
    for r in mixing.schedule(docs).collect():
        got[r.source].append((r.epoch, r.position, r.doc_id))
    want = brute.schedule(mix_rows, 2.0, shard_rows)
    assert {s: sorted(x) for s, x in got.items()} == {s: sorted(x) for s, x in want.items()}
    drawn = Counter(r.doc_id for r in mixing.mixed(docs).collect())
    assert drawn == Counter(d for x in want.values() for _, _, d in x)
    assert set(drawn) == {r[0] for r in mix_rows} and max(drawn.values()) == 2
    assert mixing.mixed(docs).columns == docs.columns


def test_exponent_meets_its_targets(spark):
    from math import log

    shares = [0.7, 0.2, 0.06, 0.04]
    table = spark.createDataFrame([(p,) for p in shares], "p double")

    def entropy(a):
        w = [p ** a / sum(q ** a for q in shares) for p in shares]
        return -sum(x * log(x) for x in w) / log(len(w))

    a = mixing.exponent(table, 0.9, 1e9)
    assert abs(entropy(a) - 0.9) < 1e-9
    assert abs((0.7 / 0.04) ** (1 - mixing.exponent(table, 1.0, 3.0)) - 3) < 1e-9
    assert mixing.exponent(table, 1.0, 1e9) == 0 and mixing.exponent(table, 1.0, 1.0) == 1
    assert mixing.exponent(table.limit(1)) == 1


def test_blocks_hold_the_weights(spark):
    docs = spark.range(6000).selectExpr("id as doc_id", "repeat('w ', 10) as text", "if(id % 10 < 7, 'a', if(id % 10 < 9, 'b', 'c')) as source")
    rows = mixing.schedule(docs, block_tokens=5000).groupBy("block", "source").sum("tokens").collect()
    last = max(r["block"] for r in rows)
    weights = {r.source: r.weight for r in mixing.schedule(docs).select("source", "weight").distinct().collect()}
    for r in rows:
        if r["block"] < last:
            assert abs(r["sum(tokens)"] - 5000 * weights[r.source]) <= 20
    assert mixing.schedule(docs.where("false")).collect() == [] and mixing.mixed(docs.where("false")).collect() == []
