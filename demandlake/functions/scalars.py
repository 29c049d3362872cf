"""Scalar column expressions of the silver/gold/feature layers.

All are built-in Spark expressions (whole-stage codegen, no Python UDF).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters treated as white space by the text cleaners
# (those with the Unicode property White_Space).
WHITESPACE = " \t\n\r\x0b\x0c\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
# The event types kept in silver.
VALID_EVENT_TYPES = ("view", "cart", "purchase")
# Weights of the interaction score (view, cart, purchase).
INTERACTION_WEIGHTS = {"view": 1, "cart": 3, "purchase": 5}
# Fixed value: decay rate of the recency score, per day.
RECENCY_DECAY = 0.05
# Fixed value: NUMERIC precision of the warehouse.
NUMERIC_TYPE = "decimal(38,9)"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def trim_ws(col) -> Column:
    """TRIM that strips all Unicode white space, not only spaces.

    A text that begins and ends with a visible ASCII character, once plain
    spaces are gone, has nothing more to strip; only the others are searched
    for the many characters of white space.
    """
    text = F.trim(_c(col).cast("string"))
    last = F.substring(text, -1, 1)
    visible = (text >= "!") & (text < "\x7f") & (last >= "!") & (last < "\x7f")
    return F.when(visible, text).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def clean_text(col) -> Column:
    """NULLIF(TRIM(x), '')."""
    return F.nullif(trim_ws(col), F.lit(""))


def clean_lower(col) -> Column:
    """NULLIF(LOWER(TRIM(x)), '')."""
    return F.nullif(F.lower(trim_ws(col)), F.lit(""))


# Fixed value: hexadecimal integers as INT64 casts take them; more than 16 digits are too large.
HEX_INTEGER = r"^\s*([+-]?)0[xX]0*([0-9a-fA-F]{1,16})\s*$"


def safe_bigint(col) -> Column:
    """SAFE_CAST(x AS INT64): integer text, decimal or hexadecimal (0x1f); anything else is NULL."""
    text = _c(col).cast("string")
    sign = F.when(F.regexp_extract(text, HEX_INTEGER, 1) == "-", "-").otherwise("")
    number = F.concat(sign, F.conv(F.regexp_extract(text, HEX_INTEGER, 2), 16, 10)).try_cast("bigint")
    # Hexadecimal text is looked for only where the plain cast found nothing.
    return F.coalesce(_c(col).try_cast("bigint"), F.when(text.rlike(HEX_INTEGER), number))


def safe_numeric(col) -> Column:
    """SAFE_CAST(x AS NUMERIC) -> decimal(38,9), NULL on bad text."""
    return _c(col).try_cast(NUMERIC_TYPE)


def safe_double(col) -> Column:
    return _c(col).try_cast("double")


def to_numeric_or_zero(col) -> Column:
    """pandas to_numeric(errors='coerce').fillna(0.0): NULL and NaN become 0."""
    d = _c(col).try_cast("double")
    return F.coalesce(F.nanvl(d, F.lit(0.0)), F.lit(0.0))


def parse_event_ts(col, strict: bool = True) -> Column:
    """TIMESTAMP(REPLACE(s, ' UTC', '')).

    strict=True keeps the reference behaviour: malformed text fails the job
    (ANSI cast).  strict=False maps malformed text to NULL.
    """
    text = F.replace(_c(col), F.lit(" UTC"), F.lit(""))
    return text.cast("timestamp") if strict else text.try_cast("timestamp")


def parse_month(col) -> Column:
    """PARSE_DATE('%Y-%m', s)."""
    return F.to_date(_c(col), "yyyy-MM")


def format_month(col) -> Column:
    """FORMAT_DATE('%Y-%m', d)."""
    return F.date_format(_c(col), "yyyy-MM")


def category_level(code, n: int) -> Column:
    """SPLIT(code, '.')[SAFE_OFFSET(n)]: NULL when the level is missing."""
    return F.get(F.split(_c(code), r"\."), n)


def event_identity(ts, event_type, product_id, user_id, user_session) -> Column:
    """hex(sha256(micros|type|product|user|session)), lower-case.

    CONCAT semantics: any NULL part gives a NULL id (as in the warehouse).
    """
    sep = F.lit("|")
    return F.sha2(
        F.concat(
            F.unix_micros(_c(ts)).cast("string"), sep,
            _c(event_type), sep,
            _c(product_id).cast("string"), sep,
            _c(user_id).cast("string"), sep,
            _c(user_session),
        ),
        256,
    )


def is_weekend(d) -> Column:
    return F.dayofweek(_c(d)).isin(1, 7)


def days_to_month_end(d) -> Column:
    return F.datediff(F.last_day(_c(d)), _c(d))


def days_between(later, earlier) -> Column:
    """DATE_DIFF(later, DATE(earlier), DAY)."""
    return F.datediff(_c(later), F.to_date(_c(earlier)))


def recency_score(days) -> Column:
    """EXP(-0.05 * days); NULL when days is NULL."""
    return F.exp(F.lit(-RECENCY_DECAY) * _c(days))


def safe_ratio(num, den) -> Column:
    """SAFE_DIVIDE(num, NULLIF(den, 0)) as double."""
    return F.try_divide(_c(num).cast("double"), F.nullif(_c(den), F.lit(0)).cast("double"))


def uniform_from_key(key, seed: int) -> Column:
    """A deterministic U[0,1) draw per key: the first 32 bits of sha256.

    Same value on every retry of a task, so scoring stays idempotent.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), _c(key).cast("string")), 256)
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
