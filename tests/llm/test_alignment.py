"""Tokenizer alignment against a brute force over tokens and bytes of whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandlake.llm import alignment
from demandlake.llm.packing import tokenizer_path


@pytest.fixture(scope="module")
def encoders():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    byte = {chr(256 + hidden.index(b)) if b in hidden else chr(b): b for b in range(256)}
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))

    def encode(text):
        """(ids, bytes) of both tokenizers."""
        ids = a.encode(" " + text, add_special_tokens=False).ids
        first = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in ids]
        second = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            second.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        return first, second
    return encode


def brute(texts, encode):
    """n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each text, and links and documents of each pair."""
    rows, links, docs = [], Counter(), defaultdict(set)
    for k, text in enumerate(texts):
        a, b = encode(text) if text else ([], [])
        raw = (" " + (text or "")).encode()
        if not text or b"".join(t for _, t in a) != raw or b"".join(t for _, t in b) != raw:
            rows.append(([], (0, 0, 0, 0), ""))
            continue
        spans = []
        for tokens in (a, b):
            at, mine = 0, []
            for i, t in tokens:
                mine.append((i, at, at + len(t)))
                at += len(t)
            spans.append(mine)
        found, j = [], 0
        for i, lo, hi in spans[0]:
            while spans[1][j][2] <= lo:
                j += 1
            m = j
            while m < len(spans[1]) and spans[1][m][1] < hi:
                found.append((i, spans[1][m][0]))
                m += 1
        ends = sorted({x[2] for x in spans[0]} & {x[2] for x in spans[1]})
        groups, at = [], [0, 0]
        for e in ends:
            sides = []
            for side in (0, 1):
                ids = []
                while at[side] < len(spans[side]) and spans[side][at[side]][2] <= e:
                    ids.append(str(spans[side][at[side]][0]))
                    at[side] += 1
                sides.append(",".join(ids))
            groups.append("|".join(sides))
        for p in found:
            links[p] += 1
            docs[p].add(k)
        rows.append((found, (len(a), len(b), len(groups), len(found)), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = Counter()
    for (_, b), n in links.items():
        most[b] = max(most[b], n)
    out = [(*n, sum(links[p] == most[p[1]] for p in found), sum(links[p] for p in found), sha) for found, n, sha in rows]
    return out, {p: (len(docs[p]), n, n == most[p[1]]) for p, n in links.items()}


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
ODD = [None, "", " ", "a", " a", "a ", "a  b", "a   b c ", "\n", "a \n b", "a\n b", "x\t y", "  x", "a b c", "tab\tend ", "é è ñ ß 漢字 😀 😀x",
       "é c", "<|endoftext|> plain <s> </s> <unk> <0x41>", "▁a b", "a ▁ b", "a\x1c b \x1f c", "\x00 z", "ﬁ Ａ", "''s 'll don't",
       "1234 56.78", "same same same", "x" * 5000, "wide　gap   line", "end▁", "�?"]


def compare(spark, encode, texts, more=lambda df: df):
    docs = more(spark.createDataFrame([(i if i % 7 else None, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    want, pairs = brute(texts, encode)
    got = alignment.aligned(docs).collect()
    assert Counter((r.doc_id, *(r[c] for c in COLUMNS)) for r in got) == Counter((i if i % 7 else None, *w) for i, w in enumerate(want))
    scored = alignment.scores(alignment.postings(docs)).collect()
    assert {(r.a_id, r.b_id): (r.docs, r.links, r.best) for r in scored} == pairs


def test_odd_texts_repeats_and_clashing_columns(spark, encoders):
    names = ("nth", "pair", "part", "bits", "count", "best", "n_a", "links", "docs", "_nth")
    compare(spark, encoders, ODD + ODD[:9] + ["same same", "same"] * 5, lambda df: df.select("*", *(F.lit("x").alias(c) for c in names)))


def test_random_spaces_and_letters(spark, encoders):
    rng = random.Random(5)
    compare(spark, encoders, ["".join(rng.choice(" \n\tabé1., ▁ ") if rng.random() < 0.6 else rng.choice(["the", " of", "ing "]) for _ in range(40))
                              for _ in range(300)])


def test_given_documents(spark, encoders):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    compare(spark, encoders, texts)


def test_hot_pairs_and_long_texts(spark, encoders):
    """A pair in every document is stored as bits, one with many links in a document on many planes."""
    texts = ["the cat"] * 3000 + ["the " * 300_000 + "end", "cat " * 70_001]
    compare(spark, encoders, texts)


def test_cache_and_buffers_may_be_small(spark, encoders, monkeypatch):
    for name in ("_MERGE_AT", "_WRITE_AT", "_WORDS_HELD", "_TEXT_AT"):
        monkeypatch.setattr(alignment, name, 20)
    aligner = alignment.Aligner(tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    assert aligner.by_word
    assert aligner.align(["▁"]) == [None]
    texts = [r.text[:300] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    compare(spark, encoders, texts)


def test_bitmaps_round_trip():
    rng = np.random.default_rng(3)
    block = alignment._Block()
    want = {}
    for pair, n in ((5, 1), (7, 40), (9, 6000), (2**45 + 1, 16384)):
        docs = rng.choice(1 << alignment.BLOCK_BITS, n, replace=False)
        links = rng.integers(1, 2**20 if n < 50 else 5, n)
        half = n // 2
        for part in (slice(0, half), slice(half, n)):
            block.add(np.full(len(docs[part]), pair), docs[part].astype(np.int64), links[part].astype(np.int64))
        want[pair] = dict(zip(docs.tolist(), links.tolist()))
    rows = block.rows(3).to_pylist()
    assert [r["pair"] for r in rows] == sorted(want) and block.rows(3) is None
    for r in rows:
        got = Counter()
        for e in alignment.unpack(r["bits"]).tolist():
            got[e & (1 << alignment.BLOCK_BITS) - 1] += 1 << (e >> alignment.BLOCK_BITS)
        assert got == want[r["pair"]]
        assert (r["docs"], r["links"]) == (len(got), sum(got.values()))
    assert len(rows[3]["bits"]) < 3 * 2 * alignment._WORDS + 64  # three planes of bits, not a word for each document


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.aligned(docs).count() == 0 and alignment.scores(alignment.postings(docs)).count() == 0
