"""Keep-first / latest-per-key and strict-uniqueness operators.

``keep_first`` and ``latest_per_key`` are aggregates (``min_by`` / ``max_by``
over a struct), not ``row_number`` windows: an aggregate combines map-side, so a
key that holds a third of all rows is reduced inside every input task before
the shuffle instead of landing whole in one task. ``keep_first_late`` is for wide
rows of which few repeat a key: only the keys are grouped, and rows whose key
is their own never move.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in names]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
               keep: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the row with the smallest ``order`` tuple.

    ``order`` is the ingest order (``pandas.drop_duplicates(keep='first')``
    on a file means "first in file order"; here it must be explicit). Rows
    tied on the whole ``order`` tuple must agree on ``keep`` columns for the
    result to be deterministic.
    """
    keep = [c for c in (keep or df.columns) if c not in keys]
    payload = F.struct(*[F.col(c) for c in keep])
    ordering = F.struct(*_cols(order))
    picked = df.groupBy(*keys).agg(F.min_by(payload, ordering).alias("_first"))
    return picked.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in keep])


def _mark(keys: Sequence[str]) -> Column:
    """A number that equal keys (NULLs are keys) share."""
    return F.shiftright(F.xxhash64(*keys), 32).cast("int")


def repeated_marks(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Marks of the keys of more than one row, and of the few that share a hash with
    another, written and read back, so that their real size decides how they are
    joined."""
    from sitegauge.session import freeze
    again = df.groupBy(F.xxhash64(*keys).alias("_h")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return freeze(again.select(F.shiftright("_h", 32).cast("int").alias("_mark")), "repeated-keys")


def keep_first_late(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                    keep: Sequence[str] | None = None) -> DataFrame:
    """:func:`keep_first` in two phases (A9), for wide rows.

    First a hash aggregate counts the rows of each key; it reads keys only, moves
    their hashes, and leaves the marks of those that repeat. Then the rows are read
    with the marks beside them: a row without one is alone and passes as it is,
    without a shuffle when the marks are few (broadcast by their written size: four
    bytes a repeated key) and with one when they are many; the others go through
    :func:`first_of_few`, which compares the keys themselves, so a row that only
    shares a mark stays too. Neither phase sorts all rows.
    """
    keep = [c for c in (keep or df.columns) if c not in keys]
    again = repeated_marks(df, keys)
    names = [f"_order_{i}" for i in range(len(order))]
    rows = df.select(*keys, *keep, *[c.alias(n) for c, n in zip(_cols(order), names)], _mark(keys).alias("_mark"))
    alone = rows.join(again, "_mark", "left_anti").select(*keys, *keep)
    return alone.unionByName(first_of_few(rows.join(again, "_mark", "left_semi"), keys, names).select(*keys, *keep))


def first_of_few(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each key by a window that keeps one row per key and input
    task before the shuffle (a group limit), so a hot key's rows don't meet."""
    from pyspark.sql import Window
    w = Window.partitionBy(*keys).orderBy(*[F.col(o).asc_nulls_first() for o in order])
    return rows.withColumn("_place", F.row_number().over(w)).where("_place = 1").drop("_place")


def latest_per_key(df: DataFrame, key: str, order: str | Column,
                   keep: Sequence[str]) -> DataFrame:
    """Row with the greatest ``order`` per ``key`` (A10: sort key asc, order
    desc, keep first)."""
    order_col = F.col(order) if isinstance(order, str) else order
    payload = F.struct(order_col.alias("_order"), *[F.col(c) for c in keep])
    picked = df.groupBy(key).agg(F.max_by(payload, order_col).alias("_last"))
    cols = [F.col(key)]
    if isinstance(order, str):
        cols.append(F.col("_last._order").alias(order))
    cols += [F.col(f"_last.{c}").alias(c) for c in keep]
    return picked.select(*cols)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (C5); empty when ``keys`` is unique."""
    return df.groupBy(*keys).count().where(F.col("count") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail fast if ``keys`` repeat (the reference's strict pivot raises).

    Runs one aggregate job; use on inputs whose uniqueness is not already
    guaranteed by construction.
    """
    dup = duplicate_keys(df, keys).limit(1).collect()
    if dup:
        raise ValueError(f"duplicate key {dict(dup[0].asDict())} for {list(keys)}")
    return df
