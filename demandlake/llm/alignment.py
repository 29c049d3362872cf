"""Alignment of two tokenizers by inverted pair bitmaps.

Every text is encoded by a byte-level tokenizer (A) and a piece tokenizer (B).
A token of A and one of B are linked where their byte ranges overlap.  For each
pair of ids the documents that link it are kept as a compressed bitmap, with
one more bitmap (a plane) for each binary digit of the number of links:
popcounts of the OR of all planes count documents, popcounts times the planes'
weights count links.  The pairs' counts then travel back along the bitmaps,
the postings, and are summed for each document.

A bitmap is stored by blocks of 2 ** BLOCK_BITS neighbouring rows of the
input, one row of the postings table for each pair and block.  Blocks share no
document, so the popcounts of a pair's blocks add up.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlake.llm.common import written
from demandlake.llm.packing import tokenizer_path

BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_TOKENIZER = "piece_bpe_32k.model"

BLOCK_BITS = 14
_LOW = (1 << BLOCK_BITS) - 1
#: From this many documents on, a plane of a block is stored as plain bits, below it as a list of entries.
_DENSE = (1 << BLOCK_BITS) // 16
_WORDS = (1 << BLOCK_BITS) // 16
#: Entries of the planes below this take 16 bits, others 32.
_SHORT_PLANES = 3
#: Characters of text that are cut into words at once.
_TEXT_AT = 1 << 18
#: Links of words in documents that a task holds before it merges them into the block's bitmaps.
_MERGE_AT = 1 << 20
#: Bitmap entries that a task holds before it writes what it has of a block.
_WRITE_AT = 1 << 23
#: Words whose alignment a task remembers.
_WORDS_HELD = 1 << 19


class Aligner:
    """Token ids, byte ends and links of texts under both tokenizers.

    Both tokenizers start a token at a space between visible characters, so a
    text falls into words there whose alignments are independent, and equal
    words are aligned once.  New words are encoded many at a time, as one text,
    and cut apart again.  Texts where that does not hold take the tokenizers whole.
    """

    def __init__(self, byte_path: str, piece_path: str):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(byte_path)
        specials = {t.content for t in whole.get_added_tokens_decoder().values()}
        visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = [b for b in range(256) if b not in visible]
        byte = {chr(256 + hidden.index(b)) if b in hidden else chr(b): b for b in range(256)}
        vocab = {w: i for w, i in whole.get_vocab(with_added_tokens=True).items() if w not in specials}
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for word, i in vocab.items():
            self.a_bytes[i] = bytes(byte[c] for c in word)
        # Fixed value: the cut that byte-level tokenizers of this kind make.
        cut = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        self.a_encode = tiktoken.Encoding("a", pat_str=cut, mergeable_ranks={b: i for i, b in enumerate(self.a_bytes)},
                                          special_tokens={}).encode_ordinary
        pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.b_encode = pieces.encode
        self.b_bytes = [bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in ((i, pieces.id_to_piece(i)) for i in range(pieces.get_piece_size()))]
        self.a_sizes = np.array([len(b) for b in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(b) for b in self.b_bytes], np.int64)
        # Each id as text, followed by what can follow it in a list of groups.
        self.a_text = np.array([[f"{i}{end}" for i in range(len(self.a_bytes))] for end in ",|"], object)
        self.b_text = np.array([[f"{i}{end}" for i in range(len(self.b_bytes))] for end in ",;"], object)
        # No piece goes on over a space; a model where one does is not cut into words.
        self.by_word = not any(re.search("[^▁]▁", pieces.id_to_piece(i)) for i in range(len(self.b_bytes)))

    odd = re.compile(r" (?:\s|\Z)").search
    _split = re.compile(r"(?<=[^ ]) (?=\S)").split

    def words(self, text: str) -> list[str]:
        """text cut at the spaces that start a word; each word had one space before it."""
        if not self.by_word:
            return [text]
        if not self.odd(" " + text):
            return text.split(" ")
        first, *rest = self._split(" " + text)
        return [first[1:], *rest]

    def align(self, words: list[str]) -> list[tuple | None]:
        """(n_a, n_b, n_groups, groups, pairs) of each word, None where a tokenizer's bytes differ from its text.

        groups ends every group with a semicolon; pairs holds a << 32 | b for
        each link.
        """
        plain = [w for w in words if w and not w[0].isspace() and not w[-1].isspace()] if self.by_word else []
        found: dict[str, tuple | None] = {}
        chunk, held = [], 0
        for w in plain:
            chunk.append(w)
            held += len(w)
            if held > 1 << 16:
                found.update(zip(chunk, self._together(chunk)))
                chunk, held = [], 0
        if chunk:
            found.update(zip(chunk, self._together(chunk)))
        return [found[w] if w in found else self._together([w])[0] for w in words]

    def _together(self, words: list[str]) -> list[tuple | None]:
        text = " " + " ".join(words)
        raw = text.encode()
        a, b = np.array(self.a_encode(text), np.int64), np.array(self.b_encode(text[1:]), np.int64)
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        ends = np.cumsum([len(w) if w.isascii() else len(w.encode()) for w in words]) + np.arange(1, len(words) + 1)
        same = (b"".join(map(self.a_bytes.__getitem__, a.tolist())) == raw and b"".join(map(self.b_bytes.__getitem__, b.tolist())) == raw)
        common = np.intersect1d(a_ends, b_ends, assume_unique=True) if same else ends[:0]
        if not same or not np.isin(ends, common, assume_unique=True).all():
            return [None] if len(words) == 1 else [self._together([w])[0] for w in words]
        pieces = np.union1d(a_ends, b_ends)  # each piece of text between two ends is one link
        pairs = a[np.searchsorted(a_ends, pieces)] << 32 | b[np.searchsorted(b_ends, pieces)]
        # A's tokens of a group come before B's; the last of each is followed by | or ;.
        a_group, b_group = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
        a_last, b_last = np.isin(a_ends, common, assume_unique=True), np.isin(b_ends, common, assume_unique=True)
        out = np.empty(len(a) + len(b), object)
        out[np.arange(len(a)) + np.searchsorted(b_group, a_group)] = self.a_text[a_last.astype(int), a]
        out[np.arange(len(b)) + np.searchsorted(a_group, b_group, "right")] = self.b_text[b_last.astype(int), b]
        at = [np.searchsorted(x, ends, "right") for x in (a_ends, b_ends, common, pieces)]
        out, tokens = out.tolist(), (at[0] + at[1]).tolist()
        found, t, last = [], 0, (0, 0, 0, 0)
        for stop, now in zip(tokens, zip(*(x.tolist() for x in at))):
            found.append((now[0] - last[0], now[1] - last[1], now[2] - last[2], "".join(out[t:stop]), pairs[last[3]:now[3]]))
            t, last = stop, now
        return found


class _Block:
    """The bitmaps of one block of documents in a task: sorted (pair, entry) with entry = plane << BLOCK_BITS | document."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, pairs: np.ndarray, docs: np.ndarray, links: np.ndarray) -> None:
        """Set the planes of (pair, document) to the binary digits of its number of links."""
        pair, entry = [pairs[:0]], [np.zeros(0, np.uint32)]
        plane = 0
        while len(links):
            on = (links & 1).astype(bool)
            pair.append(pairs[on])
            entry.append((docs[on] | plane << BLOCK_BITS).astype(np.uint32))
            links = links >> 1
            left = links > 0
            pairs, docs, links = pairs[left], docs[left], links[left]
            plane += 1
        self.parts.append((np.concatenate(pair), np.concatenate(entry)))
        self.size += len(self.parts[-1][0])

    def rows(self, part: int) -> pa.RecordBatch | None:
        """One row per pair with its bitmap, number of documents and number of links; empties the block."""
        if not self.size:
            return None
        pair, entry = (np.concatenate([p[i] for p in self.parts]) for i in (0, 1))
        self.parts, self.size = [], 0
        order = np.lexsort((entry, pair))
        pair, entry = pair[order], entry[order]
        starts = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
        keys, bits, docs, links = pack(pair, entry, starts)
        n = len(keys)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys), pa.array(np.full(n, part)), pa.array(docs), pa.array(links), bits], ["pair", "part", "docs", "links", "bits"])


def pack(pair: np.ndarray, entry: np.ndarray, starts: np.ndarray):
    """pairs, bitmaps as bytes, popcounts of the OR of the planes, and weighted popcounts.

    A bitmap is a row of 16-bit words: a zero and its entries, or, where it has
    planes of plain bits or long entries, a one and what _special() writes.
    """
    ends = np.r_[starts[1:], len(entry)]
    links = np.add.reduceat(np.int64(1) << (entry >> BLOCK_BITS).astype(np.int64), starts)
    # Documents in the OR of the planes: distinct documents of each pair.
    doc = (entry & _LOW).astype(np.int64)
    group = np.repeat(np.arange(len(starts)), ends - starts)
    several = np.flatnonzero(np.bitwise_or.reduceat(entry >> BLOCK_BITS, starts))
    docs = ends - starts
    for g in several.tolist():
        docs[g] = len(np.unique(doc[starts[g]:ends[g]]))
    words = np.zeros(len(entry) + len(starts), "<u2")
    words[np.arange(len(entry)) + group + 1] = entry  # long entries are cut here and written below
    offsets = np.r_[starts + np.arange(len(starts)), len(words)]
    special = np.flatnonzero((ends - starts >= _DENSE) | (np.maximum.reduceat(entry, starts) >> BLOCK_BITS >= _SHORT_PLANES)).tolist()
    if not special:
        pieces = [words]
    else:
        pieces, at, shift = [], 0, np.zeros(len(offsets), np.int64)
        for g in special:
            own = _special(entry[starts[g]:ends[g]])
            pieces += [words[at:offsets[g]], own]
            at = offsets[g + 1]
            shift[g + 1] = len(own) - (offsets[g + 1] - offsets[g])
        pieces.append(words[at:])
        offsets = offsets + np.cumsum(shift)
    data = np.concatenate(pieces)
    bits = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer((offsets * 2).astype("<i4").tobytes()), pa.py_buffer(data.tobytes())])
    return pair[starts], bits, docs.astype(np.int64), links


def _special(entry: np.ndarray) -> np.ndarray:
    """A one, the number of planes of plain bits, each as its number and bits, the number of long entries (two words), these, and the rest."""
    plane, planes, long, rest = entry >> BLOCK_BITS, [], [], []
    for k in np.unique(plane).tolist():
        own = entry[plane == k]
        if len(own) >= _DENSE:
            flags = np.zeros(1 << BLOCK_BITS, np.uint8)
            flags[own & _LOW] = 1
            planes += [np.array([k], "<u2"), np.packbits(flags, bitorder="little").view("<u2")]
        elif k >= _SHORT_PLANES:
            long.append(own)
        else:
            rest.append(own.astype("<u2"))
    long = np.concatenate(long).astype("<u4") if long else np.zeros(0, "<u4")
    return np.concatenate([np.array([1, len(planes) // 2], "<u2"), *planes, np.array([len(long)], "<u4").view("<u2"), long.view("<u2"), *rest])


def unpack(bits: bytes) -> np.ndarray:
    """The entries of one bitmap."""
    words = np.frombuffer(bits, "<u2")
    if not words[0]:
        return words[1:].astype(np.uint32)
    at, out = 2, []
    for _ in range(int(words[1])):
        flags = np.unpackbits(words[at + 1: at + 1 + _WORDS].view(np.uint8), bitorder="little")
        out.append(np.flatnonzero(flags).astype(np.uint32) | np.uint32(int(words[at]) << BLOCK_BITS))
        at += 1 + _WORDS
    n = int(words[at]) | int(words[at + 1]) << 16
    return np.concatenate([*out, np.frombuffer(words[at + 2:at + 2 + 2 * n].tobytes(), "<u4"), words[at + 2 + 2 * n:].astype(np.uint32)])


_DOC = "nth long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_POSTING = "pair long, part long, docs long, links long, bits binary"
_PART_BITS = 20


_DOC_KINDS = [pa.int64()] * 6 + [pa.string()]
_POSTING_KINDS = [pa.int64()] * 4 + [pa.binary()]
_NAMES = [c.split()[0] for c in f"{_DOC}, {_POSTING}".split(", ")]


def _postings(batches: Iterator[pa.RecordBatch], byte_path: str, piece_path: str) -> Iterator[pa.RecordBatch]:
    """The rows of postings() of one task."""
    aligner = Aligner(byte_path, piece_path)
    number: dict[str, int] = {}  # word -> its place in the lists below
    counts: list[tuple[int, int, int, int]] = []
    groups: list[str] = []
    pairs: list[np.ndarray] = []
    table = np.zeros((0, 4), np.int64)
    block, current, parts = _Block(), None, 0
    pending: list[tuple[int, int, str | None, np.ndarray]] = []
    waiting = 0

    def learn(words: Iterable[str]) -> None:
        """Align the words that are new; those that can't be aligned stay unknown."""
        new = [w for w in dict.fromkeys(words) if w not in number]
        for w, found in zip(new, aligner.align(new)):
            if found is not None:
                number[w] = len(counts)
                counts.append((*found[:3], len(found[4])))
                groups.append(found[3])
                pairs.append(found[4])

    def settle() -> Iterator[pa.RecordBatch]:
        """Rows of the pending documents; their links join the block's bitmaps."""
        nonlocal table, waiting
        if not pending:
            return
        sizes = np.array([len(p[3]) for p in pending])
        words = np.concatenate([p[3] for p in pending]) if sizes.sum() else np.zeros(0, np.int64)
        if len(counts) > len(table):
            table = np.concatenate([table, np.array(counts[len(table):], np.int64)])
        doc = np.repeat(np.arange(len(pending)), sizes)
        sums = [np.bincount(doc, table[words, i], len(pending)).astype(np.int64) for i in range(4)]
        columns = [[p[0] for p in pending], [p[1] for p in pending], *sums, [p[2] for p in pending]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, _DOC_KINDS)] + [pa.nulls(len(pending), k) for k in _POSTING_KINDS], _NAMES)
        if len(words):
            word, times = np.unique(doc << 32 | words, return_counts=True)
            low = np.array([p[0] & _LOW for p in pending], np.int64)[word >> 32]
            word &= 0xFFFFFFFF
            used, word = np.unique(word, return_inverse=True)
            lengths = table[used, 3]
            flat = np.concatenate([pairs[i] for i in used.tolist()])
            first = np.cumsum(lengths) - lengths
            n = lengths[word]
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[word], n)
            key, times, low = flat[at], np.repeat(times, n), np.repeat(low, n)
            ids, key = np.unique(key, return_inverse=True)
            both, back = np.unique(key << BLOCK_BITS | low, return_inverse=True)
            block.add(ids[both >> BLOCK_BITS], both & _LOW, np.bincount(back, times).astype(np.int64))
        pending.clear()
        waiting = 0

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal parts
        rows = None if current is None else block.rows(current << _PART_BITS | parts)
        if rows is not None:
            parts += 1
            yield pa.RecordBatch.from_arrays([pa.nulls(rows.num_rows, k) for k in _DOC_KINDS] + rows.columns, _NAMES)

    def some(batch: pa.RecordBatch) -> Iterator[list[tuple[int, int, str | None]]]:
        """The rows of a batch, about _TEXT_AT characters at a time."""
        rows, held = [], 0
        for nth, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            rows.append((nth, doc_id, text.as_py()))
            held += len(rows[-1][2] or "")
            if held > _TEXT_AT:
                yield rows
                rows, held = [], 0
        yield rows

    for batch in batches:
        for rows in some(batch):
            if len(number) > _WORDS_HELD:
                yield from settle()
                for held in (number, counts, groups, pairs):
                    held.clear()
                table = table[:0]
            cut = [aligner.words(text) if text else [] for _, _, text in rows]
            learn(itertools.chain.from_iterable(cut))
            for (nth, doc_id, text), words in zip(rows, cut):
                if nth >> BLOCK_BITS != current:
                    yield from settle()
                    yield from flush()
                    current, parts = nth >> BLOCK_BITS, 0
                mine = list(map(number.get, words))
                if None in mine:  # a word can't be aligned: the text as a whole decides
                    learn([text])
                    mine = [number[text]] if text in number else []
                joined = "".join(map(groups.__getitem__, mine))[:-1]
                pending.append((nth, doc_id, hashlib.sha256(joined.encode()).hexdigest() if mine else "", np.array(mine, np.int64)))
                waiting += len(mine) + 1
                if waiting > _MERGE_AT:
                    yield from settle()
                    if block.size > _WRITE_AT:
                        yield from flush()
    yield from settle()
    yield from flush()


def postings(docs: DataFrame, byte_path: str | None = None, piece_path: str | None = None) -> DataFrame:
    """Written rows of two kinds: documents (pair is null), and pairs of one block with their bitmaps (doc_id columns are null).

    nth names a row of docs; nth >> BLOCK_BITS is its block.  A block whose
    bitmaps outgrow a task's memory is written in several parts, which share no
    document; part holds the block's number and the part's.
    """
    byte_path, piece_path = byte_path or tokenizer_path(BYTE_TOKENIZER), piece_path or tokenizer_path(PIECE_TOKENIZER)
    slim = docs.select(F.monotonically_increasing_id().alias("nth"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(slim.mapInArrow(lambda batches: _postings(batches, byte_path, piece_path), f"{_DOC}, {_POSTING}"), "postings")


def scores(found: DataFrame) -> DataFrame:
    """pair, a_id, b_id, docs, links, best: popcounts over all blocks, and whether links is the most of its b_id.

    The most of each b_id is one row per id of tokenizer B, so it is broadcast.
    """
    counts = written(found.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("docs").alias("docs"), F.sum("links").alias("links"))
                     .withColumn("b_id", F.col("pair").bitwiseAND(0xFFFFFFFF)), "pairs")
    most = counts.groupBy("b_id").agg(F.max("links").alias("most"))
    return counts.join(F.broadcast(most), "b_id").select(
        "pair", F.shiftright("pair", 32).alias("a_id"), "b_id", "docs", "links", (F.col("links") == F.col("most")).alias("best"))


def aligned(docs: DataFrame, byte_path: str | None = None, piece_path: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of docs.

    A null or empty text, and one whose tokens' bytes differ from a space and
    the text, has zeros and an empty groups_sha256.  Null and repeated ids and
    repeated rows stay and count as documents of their own.  Other columns are
    not read; an empty table gives no row.
    """
    found = postings(docs, byte_path, piece_path)
    pairs = found.where("pair IS NOT NULL")
    scored = scores(found).select(F.col("pair").alias("_pair"), F.col("links").alias("count"), "best")
    # The scores come to the bitmaps, which are shuffled once, by part: at most 2 ** BLOCK_BITS documents each.
    back = pairs.select(F.col("pair").alias("_pair"), F.col("part").alias("_part")).join(scored, "_pair").groupBy("_part")
    returned = pairs.select("part", "pair", "bits").groupBy("part").cogroup(back).applyInArrow(_returned, "_nth long, n_best long, count_sum long")
    sums = returned.groupBy("_nth").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    rows = found.where("pair IS NULL").drop("pair", "part", "docs", "links", "bits")
    return (rows.join(sums, F.col("nth") == F.col("_nth"), "left")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0).cast("long")).alias("n_best"),
                    F.coalesce("count_sum", F.lit(0).cast("long")).alias("count_sum"), "groups_sha256"))


def _returned(bitmaps: pa.Table, scored: pa.Table) -> pa.Table:
    """The sums of one part's documents, from its pairs' bitmaps and scores."""
    sums = np.zeros((2, 1 << BLOCK_BITS), np.int64)
    block = bitmaps.column("part")[0].as_py() >> _PART_BITS
    place = np.argsort(pairs := scored.column("_pair").to_numpy())
    count, best = scored.column("count").to_numpy()[place], scored.column("best").to_numpy()[place]
    pairs = pairs[place]
    for b in bitmaps.to_batches():
        at = np.searchsorted(pairs, b.column("pair").to_numpy())
        bits = b.column("bits")
        offsets = np.frombuffer(bits.buffers()[1], "<i4")[bits.offset:][:b.num_rows + 1] // 2
        data = np.frombuffer(bits.buffers()[2], "<u2", int(offsets[-1]))
        sparse = data[offsets[:-1]] == 0
        sizes = np.where(sparse, np.diff(offsets) - 1, 0)
        row = np.repeat(np.arange(b.num_rows), sizes)
        entry = data[np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(offsets[:-1] + 1, sizes)].astype(np.uint32)
        special = np.flatnonzero(~sparse).tolist()
        if special:
            more = [unpack(data[offsets[i]:offsets[i + 1]].tobytes()) for i in special]
            row, entry = np.concatenate([row, np.repeat(special, [len(m) for m in more])]), np.concatenate([entry, *more])
        links = np.int64(1) << (entry >> BLOCK_BITS).astype(np.int64)
        low, at = (entry & _LOW).astype(np.int64), at[row]
        np.add.at(sums[0], low, links * best[at])
        np.add.at(sums[1], low, links * count[at])
    low = np.flatnonzero(sums[1])
    return pa.table({"_nth": (block << BLOCK_BITS) + low, "n_best": sums[0][low], "count_sum": sums[1][low]})
