"""Packing by power-of-two decomposition.

A document's tokens are cut into pieces whose lengths are powers of two:
whole sequences of max_tokens first, then the binary digits of the rest, large
to small.  Pieces of equal length share a bucket, every piece is a sequence of
its own, and batches take whole sequences of one bucket.  No sequence crosses
documents and none is padded.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandlake.llm.common import running_offsets, written

END_ID = 1
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """The place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=1)
def encoder(path: str, cache_items: int = 0):
    """A function from a text to its ids as little-endian unsigned 32-bit bytes.

    path is a byte-level BPE file whose ids are in the order of its merges.
    Texts are cut into words and merged from the file's vocabulary, whole: a
    cache of words costs more than it saves where most words are rare.  Texts
    with control characters that Python alone takes for white space, or with a
    special token's string, take the tokenizer.  Made once per process, so the
    later tasks of a Python worker take the same one.  cache_items is ignored.
    """
    from array import array

    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    specials = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    byte = {chr(256 + hidden.index(b)) if b in hidden else chr(b): b for b in range(256)}
    ranks = {bytes(byte[c] for c in word): rank for word, rank in tokenizer.get_vocab(with_added_tokens=True).items()
             if word not in specials}
    # Fixed value: the cut that byte-level tokenizers of this kind make.
    words = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    merge = tiktoken.Encoding("ranks", pat_str=words, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    tokenized = ["\x1c", "\x1d", "\x1e", "\x1f", *specials]

    def encode(text: str) -> bytes:
        if any(map(text.__contains__, tokenized)):
            return array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return array("I", merge(text)).tobytes()

    return encode


def lengths(n: int, max_tokens: int) -> list[int]:
    """max_tokens as often as it fits into n, then the powers of two that sum to the rest."""
    rest = n % max_tokens
    return [max_tokens] * (n // max_tokens) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def pieces(docs: DataFrame, max_tokens: int = 2048, tokenizer: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, ids (little-endian unsigned 32-bit).

    Null text counts as empty, and an empty text is the end id alone, so every
    row of docs gives a piece; repeated rows are packed once each.  max_tokens
    must be a power of two.
    """
    if max_tokens < 1 or max_tokens & (max_tokens - 1):
        raise ValueError("max_tokens must be a power of two")
    path = tokenizer or tokenizer_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        end = END_ID.to_bytes(4, "little")
        names = ["doc_id", "start", "length", "doc_tokens", "ids"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

        for b in batches:
            rows, held = [], 0
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = encode(text or "") + end
                start, n = 0, len(ids) // 4
                for length in lengths(n, max_tokens):
                    rows.append((doc_id, start, length, n, ids[4 * start: 4 * (start + length)]))
                    start += length
                held += len(ids)
                if held > 1 << 24:  # bounds a batch of long documents
                    yield batch(rows)
                    rows, held = [], 0
            if rows:
                yield batch(rows)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        cut, "doc_id long, start long, length long, doc_tokens long, ids binary")


def assign(cut: DataFrame, batch_tokens: int = 1 << 19) -> DataFrame:
    """Add sequence_id, offset, bucket and batch_id to pieces.

    Pieces of one length form a bucket.  Inside it they are dealt by a hash of
    their document to shards, and numbered through: sequences of a bucket have
    consecutive ranks, and a batch takes batch_tokens / length of them.
    sequence_id is rank * 64 + log2(length), so it is unique.
    """
    spark = cut.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = written(
        cut.withColumn("bucket", F.log2("length").cast("int"))
        .withColumn("shard", F.pmod(F.xxhash64("doc_id", "start"), F.lit(shards)).cast("int")), "pieces")
    # One row per bucket and shard: about a dozen times the shuffle partitions.
    before = F.broadcast(running_offsets(keyed.groupBy("bucket", "shard").agg(F.count("*").alias("n")),
                                         ["bucket"], "shard", "n", "before").drop("n"))
    by = [c for c in ("doc_id", "start", "ids_crc32") if c in cut.columns]
    rank = F.row_number().over(Window.partitionBy("bucket", "shard").orderBy(*by)) - 1
    return (keyed.withColumn("_rank", rank).join(before, ["bucket", "shard"])
            .withColumn("_rank", F.col("_rank") + F.col("before"))
            .withColumn("sequence_id", F.col("_rank") * 64 + F.col("bucket"))
            .withColumn("offset", F.lit(0).cast("long"))
            .withColumn("batch_id", F.floor(F.col("_rank") * F.col("length") / batch_tokens).cast("long"))
            .drop("_rank", "before", "shard"))


def packed(docs: DataFrame, max_tokens: int = 2048) -> DataFrame:
    """Pieces with their sequences; the ids are replaced by their crc32, so that no shuffle carries tokens."""
    slim = pieces(docs, max_tokens).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return assign(slim).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
                               "bucket", "batch_id")
