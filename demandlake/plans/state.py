"""What a monthly run carries from the months before it, kept in the lake.

Each mart needs one thing from its history: a product's newest attributes, a
user's last purchase, a pair's last view.  The table ``state/<name>`` holds it
by date: partition ``as_of=D`` covers all events before D.  A run reads the
partition of its window's first day and folds its month into the next one, so
no run reads events behind its window.  A partition is bucketed by the state's
keys: neither the mart's join nor that of the fold shuffles it.  Partitions that a
change in older events makes wrong are dropped before the events are written.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gold
from ..sources import lake as L

#: name -> (state of events, key columns)
STATES = {
    "product_attributes": (gold.product_attributes, ["product_id"]),
    "last_purchases": (gold.last_purchases, ["user_id"]),
    "last_views": (gold.last_views, ["user_id", "product_id"]),
}


def _folder(root: str, name: str) -> str:
    return L.table_path(root, "state", name)


def _path(root: str, name: str, as_of) -> str:
    return f"{_folder(root, name)}/as_of={as_of}"


def _dates(spark: SparkSession, root: str, name: str) -> list[str]:
    """Dates of the finished partitions, ascending: one per month at most."""
    found = [f.removeprefix("as_of=") for f in L.list_folders(spark, _folder(root, name)) if f.startswith("as_of=")]
    return sorted(d for d in found if L.path_exists(spark, f"{_path(root, name, d)}/{L.LAYOUT}"))


def folded(name: str, old: DataFrame, new: DataFrame) -> DataFrame:
    """The state of two stretches of events of which new is the later one."""
    _, keys = STATES[name]
    values = [c for c in old.columns if c not in keys]
    later = new.select(*keys, *[F.col(c).alias(f"_new{c}") for c in values])
    return old.join(later, keys, "full").select(*keys, *[F.coalesce(f"_new{c}", c).alias(c) for c in values])


def _read(spark: SparkSession, root: str, name: str, as_of) -> DataFrame:
    return L.read_bucketed(spark, _path(root, name, as_of))


def before(spark: SparkSession, root: str, name: str, fct: DataFrame, as_of) -> DataFrame:
    """The state of all events before as_of.

    Where the partition is missing it is made from the newest earlier one and
    the events since then, or from all older events if there is none.
    """
    as_of = str(as_of)
    dates = _dates(spark, root, name)
    if as_of not in dates:
        state, _ = STATES[name]
        events = fct.where(F.col("event_date") < F.to_date(F.lit(as_of)))
        earlier = [d for d in dates if d < as_of]
        if earlier:
            made = folded(name, _read(spark, root, name, earlier[-1]), state(events.where(F.col("event_date") >= F.to_date(F.lit(earlier[-1])))))
        else:
            made = state(events)
        L.write_bucketed(made, _path(root, name, as_of), STATES[name][1])
    return _read(spark, root, name, as_of)


def advance(spark: SparkSession, root: str, fct: DataFrame, snapshot_date) -> None:
    """Fold the month before snapshot_date into the next partition of every state."""
    for name, (state, keys) in STATES.items():
        first = window_start(snapshot_date)
        month = state(fct.where(gold.in_window(snapshot_date)))
        L.write_bucketed(folded(name, before(spark, root, name, fct, first), month), _path(root, name, snapshot_date), keys)


def window_start(snapshot_date) -> str:
    """First day of the month before snapshot_date, which is a first day itself."""
    d = date.fromisoformat(str(snapshot_date))
    return str(date(d.year - (d.month == 1), (d.month - 2) % 12 + 1, 1))


def drop_after(spark: SparkSession, root: str, changed_from) -> list[str]:
    """Drop the partitions that hold changed_from or a later date; returns their folders."""
    gone = []
    for name in STATES:
        for d in [f.removeprefix("as_of=") for f in L.list_folders(spark, _folder(root, name)) if f.startswith("as_of=")]:
            if d > str(changed_from):
                L.drop_path(spark, _path(root, name, d))
                gone.append(f"{name}/as_of={d}")
    return gone
