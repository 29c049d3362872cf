"""Aggregate expressions.  All are partial-aggregation friendly
(map-side combine before the shuffle), so hot keys do not pile up in
one task."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import NUMERIC_TYPE


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def countif(cond: Column) -> Column:
    """COUNTIF(cond) -> bigint (NULL conditions are not counted)."""
    return F.count_if(cond)


def exact_avg(col) -> Column:
    """AVG over a NUMERIC: exact decimal sum divided by the count, as double.

    Exact sums make the result independent of partitioning and merge order.
    """
    x = _c(col)
    return F.sum(x.cast(NUMERIC_TYPE)).cast("double") / F.count(x)


def latest_non_null(value, *order) -> Column:
    """ARRAY_AGG(x IGNORE NULLS ORDER BY order DESC LIMIT 1)[SAFE_OFFSET(0)].

    max_by skips rows whose ordering is NULL, so nulling the ordering where
    the value is NULL keeps only non-null values; ties are broken by the
    remaining ordering columns.
    """
    v = _c(value)
    key = F.struct(*[_c(o) for o in order]) if len(order) > 1 else _c(order[0])
    return F.max_by(v, F.when(v.isNotNull(), key))


def latest_when(value, cond: Column, *order) -> Column:
    """Latest value among rows where cond holds."""
    key = F.struct(*[_c(o) for o in order]) if len(order) > 1 else _c(order[0])
    return F.max_by(_c(value), F.when(cond, key))


def first_by(value, *order) -> Column:
    """The value of the first row by order (NULL payloads kept)."""
    key = F.struct(*[_c(o) for o in order]) if len(order) > 1 else _c(order[0])
    return F.min_by(_c(value), key)
