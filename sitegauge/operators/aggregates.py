"""Grouped aggregates with pandas-compatible NULL rules.

* pandas sums an all-missing group to 0, Spark to NULL (trap T3): sums are
  coalesced *inside* the aggregate, so a group that does not exist stays
  missing while an existing all-NULL group becomes 0.
* pandas ``groupby`` drops NULL keys, Spark keeps a NULL group (trap T4).
* Money is summed as DECIMAL so totals do not depend on the order in which
  tasks combine partial sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def zero_sum(c: str | Column) -> Column:
    """Sum where an existing group of only NULLs gives 0 (A1, A2)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.sum(col), F.lit(0))


def money_sum(c: str | Column) -> Column:
    """Exact sum of money amounts, returned as double."""
    col = F.col(c) if isinstance(c, str) else c
    return zero_sum(col.cast(MONEY)).cast("double")


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return df.where(cond)


def mean_by(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """``groupby(keys).mean()``: NULL-key groups dropped, NULL values skipped (A4).

    Measures are listed explicitly; old pandas silently skipped text columns
    (trap T10).
    """
    return drop_null_keys(df, keys).groupBy(*keys).agg(
        *[F.avg(m).alias(m) for m in measures])


def latest_month(df: DataFrame, date_col: str, by: Sequence[str] = ()) -> DataFrame:
    """Latest (year, month) with at least one row (A5): max year, then the max
    month in that year, which is the month of the max date."""
    last = F.max(F.col(date_col))
    return df.groupBy(*by).agg(
        F.year(last).cast("long").alias("max_year"),
        F.month(last).cast("long").alias("max_month"))


def contingency(df: DataFrame, row: str, column: str, values: Sequence,
                null_label: str | None = None, strict: bool = False) -> DataFrame:
    """Two-way count table (A6) with an explicit column-value list.

    ``DataFrame.crosstab`` collects the distinct pairs to the driver; a pivot
    with known values stays distributed. ``null_label`` keeps NULLs as a
    category, like ``crosstab(a.astype(str), ...)``; without it they aren't
    counted. Rows with a value outside the list aren't counted either, or, if
    ``strict``, fail the job; :func:`open_contingency` takes the values from the data.
    """
    r, c = F.col(row), F.col(column)
    if null_label is not None:
        r = F.coalesce(r.cast("string"), F.lit(null_label))
        c = F.coalesce(c.cast("string"), F.lit(null_label))
        values = [str(v) for v in values] + [null_label]
    listed = F.coalesce(c.isin(list(values)), F.lit(True))
    counted = (df.select(r.alias(row), F.when(listed, c).alias(column), (~listed).alias("_other"))
               .groupBy(row).agg(*[F.count_if(F.col(column) == F.lit(v)).cast("long").alias(f"n_{v}") for v in values],
                                 F.max(F.when(F.col("_other"), F.lit(True))).alias("_other")))
    out = [row, *[f"`n_{v}`" for v in values]]
    if not strict:
        return counted.select(*out)
    message = F.lit(f"{column} value outside the list of the contingency table")
    checked = counted.where(F.when(F.col("_other"), F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    return checked.select(*out)


#: Column values that an open table gives a column of their own, at most.
MOST_COLUMNS = 1000
MISSING, OTHER = "missing", "other"


def open_contingency(df: DataFrame, row: str, column: str, most: int = MOST_COLUMNS) -> DataFrame:
    """Two-way count table of whatever values there are (A6 with ``dropna=False``).

    One small read finds the ``most`` commonest values (ties by value), each a column
    ``n_<value>``; the values beyond are counted in ``other`` and NULLs in
    ``missing``, so every row is counted in one cell and ``total`` is the sum of
    its row's cells. A NULL row value is a row.
    """
    text = F.col(column).cast("string")
    found = (df.where(F.col(column).isNotNull()).groupBy(text.alias("v")).agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("n"), "v").limit(most).collect())
    values = sorted(r["v"] for r in found)
    # one group and a map of counts; the width is bounded by ``most``
    slot = F.when(text.isNull(), F.lit(MISSING)).when(text.isin(values), F.concat(F.lit("="), text)).otherwise(F.lit(OTHER))
    cells = (df.select(F.col(row), slot.alias("_slot")).groupBy(row, "_slot").agg(F.count(F.lit(1)).alias("_n"))
             .groupBy(row).agg(F.map_from_entries(F.collect_list(F.struct("_slot", "_n"))).alias("_cells"), F.sum("_n").alias("total")))

    def cell(key):
        return F.coalesce(F.try_element_at("_cells", F.lit(key)), F.lit(0)).cast("long")

    return cells.select(row, *[cell(f"={v}").alias(f"n_{v}") for v in values], cell(OTHER).alias(OTHER),
                        cell(MISSING).alias(MISSING), F.col("total").cast("long").alias("total"))


def non_null_counts(df: DataFrame, key: str) -> DataFrame:
    """``groupby(key).count()``: non-NULL count of every other column."""
    return df.groupBy(key).agg(
        *[F.count(c).cast("long").alias(c) for c in df.columns if c != key])


def distinct_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct (a, b) pairs."""
    return df.select(a, b).distinct()
