"""Personal data: patterns propose spans, checksums confirm them, context words adjust their score.

DataFrame functions only.  A pattern is applied twice, once for its matches
and once to split the text at them; the lengths of both give the matches'
places in code points.  Patterns are written so that a match is found in one
pass (possessive repeats, and no start inside a run that was tried before),
which keeps very long words and digit runs cheap.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlake.llm.common import row_keys

#: Spans with a lower score are proposals only.
ACCEPT = 0.5
#: Characters before and after a match that are searched for context words.
NEAR = 40
#: How much a context word adds.
CONTEXT = 0.3
#: Matches whose lengths are summed together.
SUMS = 256

# Context words by kind.
WORDS = {
    "email": "mail|contact|kontakt|correo|courriel",
    "ip": "ip|host|server|address|adresse|login",
    "card": "card|karte|carte|tarjeta|visa|master|amex|payment|credit|kredit",
    "phone": "phone|call|mobile|tel|fax|telefon|handy|appel|llama",
    "iban": "iban|account|konto|compte|cuenta|bank|sepa",
    "ssn": "ssn|social security|social-security|tax id|taxpayer",
    "short_card": "card|karte|carte|tarjeta|amex|diners|payment|credit|kredit",
}


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """True if every second digit from the right, doubled and cast out by nines, sums to a multiple of 10."""
    def add(total: Column, i: Column) -> Column:
        d = F.ascii(F.substring(F.reverse(digits), i, F.lit(1))) - 48
        twice = d * 2
        return total + F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)
    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))), F.lit(0), add) % 10 == 0


def _mod97(m: Column) -> Column:
    """True if the international account number's check digits are right."""
    plain = F.regexp_replace(m, " ", "")
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))

    def add(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, rest * 100 + code - 55).otherwise(rest * 10 + code - 48) % 97
    return F.aggregate(F.split(turned, "(?!^)(?!$)"), F.lit(0), add) == 1


def _ip_parts(m: Column) -> Column:
    return F.forall(F.split(m, r"\."), lambda p: F.regexp_like(p, F.lit("^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})$")))


class Kind(NamedTuple):
    """A kind of span: its pattern, a cheap test that a text may hold one, a check of matches, and its score."""

    name: str
    pattern: str
    guard: Callable[[Column], Column]
    check: Callable[[Column], Column]
    score: float


BASE = [
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda t: F.contains(t, F.lit("@")), lambda m: F.lit(True), 0.9),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
         lambda t: F.regexp_like(t, F.lit(r"[0-9]\.[0-9]")), _ip_parts, 0.6),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++",
         lambda t: F.regexp_like(t, F.lit(r"[0-9][\x20-]?[0-9]")),
         lambda m: F.length(_digits(m)).between(16, 19) & _luhn(_digits(m)), 0.8),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]",
         lambda t: F.contains(t, F.lit("+")), lambda m: F.length(_digits(m)).between(8, 15), 0.6),
]
ADDED = [
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
         lambda t: F.regexp_like(t, F.lit("[A-Z]{2}[0-9]{2}")), _mod97, 0.8),
    Kind("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
         lambda t: F.regexp_like(t, F.lit("[0-9]-[0-9]{2}-[0-9]")), lambda m: F.lit(True), 0.3),
    Kind("short_card", r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
         lambda t: F.regexp_like(t, F.lit(r"[0-9][\x20-]?[0-9]")),
         lambda m: F.length(_digits(m)).between(13, 15) & _luhn(_digits(m)), 0.3),
]


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value worked out once, also where use asks for it again and again."""
    return F.transform(F.array(value), use)[0]


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda a, x: a + x)


def _matches(text: Column, kind: Kind) -> Column:
    """All matches of a kind: array of (kind, start, end, text, score), failing ones left out."""
    pattern = F.lit(kind.pattern)

    def place(z: Column) -> Column:
        # The last and the first NEAR characters of a match with the gap before and after it.
        return _let(F.struct(z["g"].alias("g"), z["m"].alias("m"),
                             F.transform(z["m"], lambda x, i: F.right(F.concat(z["g"][i], x), F.lit(NEAR))).alias("l"),
                             F.transform(z["m"], lambda x, i: F.left(F.concat(x, z["g"][i + 1]), F.lit(NEAR))).alias("r")), placed)

    def placed(z: Column) -> Column:
        lengths = F.transform(z["m"], lambda x, i: F.length(x) + F.length(z["g"][i]))
        return _let(lengths, lambda n: _let(
            F.transform(F.sequence(F.lit(0), F.floor(F.size(n) / SUMS).cast("int")), lambda b: _total(F.slice(n, b * SUMS + 1, SUMS))),
            lambda blocks: _let(F.transform(blocks, lambda x, b: _total(F.slice(blocks, F.lit(1), b))), lambda before: F.filter(
                F.transform(z["m"], lambda x, i: span(z, n, before, x, i)), lambda s: s["ok"]))))

    def span(z: Column, n: Column, before: Column, x: Column, i: Column) -> Column:
        block = F.floor(i / SUMS).cast("int")
        start = before[block] + _total(F.slice(n, block * SUMS + 1, i % SUMS)) + F.length(z["g"][i])
        # A match has two characters at least, so that so many neighbours fill the window.
        most = NEAR // 2
        first = F.greatest(i - most, F.lit(0))
        before_it = F.right(F.concat(F.array_join(F.slice(z["l"], first + 1, i - first), ""), z["g"][i]), F.lit(NEAR))
        after_it = F.left(F.concat(z["g"][i + 1], F.array_join(F.slice(z["r"], i + 2, F.lit(most)), "")), F.lit(NEAR))
        near = F.lower(F.concat_ws(" ", before_it, after_it))
        # Only confirmed matches need their context.
        said = kind.check(x) & F.regexp_like(near, F.lit(rf"(?<![a-z])(?:{WORDS[kind.name]})"))
        return F.struct(F.lit(kind.name).alias("kind"), start.cast("long").alias("start"), (start + F.length(x)).cast("long").alias("end"),
                        x.alias("text"), F.least(F.lit(1.0), kind.score + F.when(said, CONTEXT).otherwise(0.0)).alias("score"),
                        kind.check(x).alias("ok"))

    found = _let(F.struct(F.split(text, kind.pattern, -1).alias("g"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("m")), place)
    nothing = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,text:string,score:double,ok:boolean>>")
    return F.when(kind.guard(text), found).otherwise(nothing)


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, row keys, base and added: arrays of (kind, start, end, text, score, ok) of every row of docs.

    base holds the confirmed spans of BASE in order of kind and start, added
    those of ADDED whose score reaches ACCEPT and that overlap no base span.
    Null text counts as empty and has no spans; repeated rows get equal ones.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = (row_keys(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "_id_key", "_text_key", text.alias("text"))
             .select("doc_id", "_id_key", "_text_key", *[_matches(F.col("text"), k).alias(k.name) for k in BASE + ADDED]))
    base = found.withColumn("base", F.concat(*[k.name for k in BASE]))
    clear = [F.filter(F.col(k.name), lambda s: (s["score"] >= ACCEPT) & ~F.exists(
        F.col("base"), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))) for k in ADDED]
    return base.withColumn("added", F.concat(*clear)).select(
        "doc_id", "_id_key", "_text_key", *[F.size(k.name).cast("long").alias(f"n_{k.name}") for k in BASE], "base", "added")


def as_text(found: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
