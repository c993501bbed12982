"""Scalar column functions (all native Spark expressions, no Python UDFs).

Covers money-text cleaning, IEEE-style ratios, NaN handling, Python-style
title case, string splitting and fixed-position slicing.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour.
# Characters removed from money text before parsing it as a number.
MONEY_SIGNS = "$,"
# Text that stands for a missing price: the price log is re-read with the
# default missing-value markers of a pandas CSV read.
MISSING_PRICE_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                        "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
                        "n/a", "nan", "null")

_INF = float("inf")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_money(c: str | Column) -> Column:
    """Strip every ``$`` and ``,`` from money text."""
    return F.translate(_col(c), MONEY_SIGNS, "")


def parse_money(c: str | Column, null_tokens: Iterable[str] = MISSING_PRICE_TOKENS) -> Column:
    """Money text -> double; missing tokens and unparsable text -> NULL.

    ``try_cast`` keeps ANSI mode from failing the whole job on dirty text; a
    NaN that still gets through (any spelling not in the list) becomes NULL,
    never NaN (trap T1). The cast stands once in the expression: a failed cast
    is dear, and a shared one would be evaluated before the missing tokens are
    taken out.
    """
    raw = F.trim(_col(c))
    tokens = list(null_tokens)
    parsed = F.nanvl(clean_money(raw).try_cast("double"), F.lit(None).cast("double"))
    if not tokens:
        return parsed
    return F.when(raw.isin(tokens), F.lit(None).cast("double")).otherwise(parsed)


def nan_to_null(c: str | Column) -> Column:
    """NaN -> NULL. Spark orders NaN above every number, so one NaN would pass
    every ``>=`` threshold; it must never reach a comparison (trap T1)."""
    col = _col(c)
    return F.when(F.isnan(col), F.lit(None).cast("double")).otherwise(col)


def ieee_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` with the float semantics of the reference (trap T2).

    x/0 is +inf or -inf by the sign of x, 0/0 and anything with a NULL operand
    is NULL (not NaN). The explicit ``den == 0`` guards keep a NULL base from
    falling through to +inf.
    """
    n, d = _col(num).cast("double"), _col(den).cast("double")
    return (
        F.when(d != 0, F.try_divide(n, d))
        .when((d == 0) & (n > 0), F.lit(_INF))
        .when((d == 0) & (n < 0), F.lit(-_INF))
        .otherwise(F.lit(None).cast("double"))
    )


def growth(cur: str | Column, prev: str | Column) -> Column:
    """``cur / prev - 1`` evaluated in double, unrounded (K1, trap T15)."""
    return ieee_ratio(cur, prev) - F.lit(1.0)


def title_case(c: str | Column) -> Column:
    """Python ``str.title()``: a new word starts after any non-letter.

    ``initcap`` only starts words after whitespace (``o'neil`` would stay
    ``O'neil``), so the text is cut into runs of letters and non-letters and
    each run is capitalised on its own (X7, trap T8).
    """
    runs = F.regexp_extract_all(F.lower(_col(c)), F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.array_join(F.transform(runs, lambda r: F.initcap(r)), "")


def normalise_label(c: str | Column) -> Column:
    """Title case then trim: the one spelling used for region text."""
    return F.trim(title_case(c))


def key_text(df, c: str) -> Column:
    """A key column as text. A numeric key (spreadsheets store ids as
    doubles) goes through bigint first, so ``101.0`` never appears and joins
    on text keys still match (D18, P14); NULL stays NULL."""
    from pyspark.sql import types as T
    col = F.col(f"`{c}`")
    if isinstance(df.schema[c].dataType, T.NumericType):
        col = col.cast("bigint")
    return col.cast("string")


def split_part(c: str | Column, sep: str, n: int) -> Column:
    """1-based part ``n`` of ``c`` split on ``sep``; NULL-safe."""
    return F.split_part(_col(c), F.lit(sep), F.lit(n))


def last_chars(c: str | Column, n: int) -> Column:
    """Last ``n`` characters; shorter strings come back whole."""
    return F.right(_col(c), F.lit(n))


def text_year(c: str | Column) -> Column:
    """Characters 1-4 of ``yyyy-MM-dd...`` text as an int."""
    return F.substring(_col(c), 1, 4).try_cast("int")


def text_month(c: str | Column) -> Column:
    """Characters 6-7 of ``yyyy-MM-dd...`` text as an int."""
    return F.substring(_col(c), 6, 2).try_cast("int")


def us_date_text(c: str | Column) -> Column:
    """Date -> ``MM/dd/yyyy`` text."""
    return F.date_format(_col(c), "MM/dd/yyyy")


def flag_label(c: str | Column, on: str = "member", off: str = "non_member") -> Column:
    """1 -> ``on``, anything else -> ``off``."""
    return F.when(_col(c) == 1, F.lit(on)).otherwise(F.lit(off))
