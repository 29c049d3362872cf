"""Plain Python versions of the corpus operators, for small inputs."""

import hashlib
import math
import re
import struct
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NULL_ID = -(2**63)


def normalised(text):
    return re.sub(r"[\x20\x09-\x0D]+", "", text or "")


def exact(rows):
    """{index: (keep_id, group_size, winner's index)} of rows [(doc_id, text)]."""
    groups = {}
    for k, (_, text) in enumerate(rows):
        groups.setdefault(normalised(text), []).append(k)
    out = {}
    for members in groups.values():
        best = min(members, key=lambda k: (-len(rows[k][1] or ""), rows[k][0] is None, rows[k][0] or 0,
                                           spark_hash(rows[k][1] or "")))
        for k in members:
            out[k] = (rows[best][0], len(members), best)
    return out


def spark_hash(*values, seed=42):
    """Spark's xxhash64 of longs, ints (as int tuples) and strings, signed."""
    h = seed
    for v in values:
        data = v.encode() if isinstance(v, str) else struct.pack("<i", v[0]) if isinstance(v, tuple) else struct.pack("<q", v)
        h = xxhash.xxh64_intdigest(data, h)
    return h - 2**64 if h >= 2**63 else h


def fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, distance=3):
    """The smallest index that each fingerprint reaches, all pairs compared."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def _digits(m):
    return re.sub("[^0-9]", "", m)


BASE_PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(_digits(m)) <= 19 and luhn(_digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(_digits(m)) <= 15),
]


def pii_base(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p, ok in BASE_PII for m in re.finditer(p, text or "") if ok(m.group())]


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = list(zip(words, words[1:], words[2:]))
    times = Counter(windows)
    inside = {k for i, w in enumerate(windows) if times[w] > 1 for k in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


def schedule(rows, max_epochs=2.0, shard_rows=20_000):
    """{source: [(epoch, position, doc_id)]} of rows [(doc_id, text, source)], by the same hashes."""
    tokens = [max(len(WORD.findall(t or "")), 1) for _, t, _ in rows]
    total = Counter()
    for (_, _, s), n in zip(rows, tokens):
        total[s] += n
    share = {s: n / sum(total.values()) for s, n in total.items()}
    low, high = 0.0, 1.0
    if (max(share.values()) / min(share.values())) <= max_epochs:
        high = 0.0
    for _ in range(60 if high else 0):
        middle = (low + high) / 2
        if (max(share.values()) / min(share.values())) ** (1 - middle) <= max_epochs:
            high = middle
        else:
            low = middle
    weight = {s: p ** high for s, p in share.items()}
    whole = max(total[s] / weight[s] for s in total)
    out = {}
    for s in total:
        budget = max(round(whole * weight[s]), total[s])
        mine = [k for k, r in enumerate(rows) if r[2] == s]
        shards = math.ceil(len(mine) / shard_rows)
        position, draws = 0, []
        for epoch in range(math.ceil(budget / total[s])):
            def key(k):
                doc, text, source = rows[k]
                h = spark_hash(NULL_ID if doc is None else doc, spark_hash(text or ""), "null" if source is None else "=" + source, (epoch,))
                return ((h % 2**64 >> 32) % shards, h)
            for k in sorted(mine, key=key):
                if position < budget:
                    draws.append((epoch, position, rows[k][0]))
                position += tokens[k]
        out[s] = draws
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
