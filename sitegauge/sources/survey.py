"""Survey files in two yearly layouts.

The reference reads one spreadsheet per wave year and picks the column layout
from the year of the first wave id. Here the layout is recognised from the
columns a file carries (the two layouts differ exactly in them), which needs
no data pass; every file is normalised to the canonical schema and the files
are combined with one ``unionByName``. Files matching neither layout are not
silently appended (D7): :func:`normalise_files` raises, or returns them apart
when ``quarantine`` is requested.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegauge.functions.columns import key_text
from sitegauge.sources.schemas import QUESTIONS

# The two survey layouts. The older one names the shop question
# Q15 and the service question Q19; both are renamed to the current names.
LAYOUT_RENAMES = {
    "legacy": {"Q15": "Q14", "Q19": "Q18"},
    "current": {},
}
# Layout by wave year, used only when a file's columns fit both layouts.
LAYOUT_BY_YEAR = {"2017": "legacy", "2018": "current"}
LOCATION_ALIASES = {"LOCATIONCODE": "LOCATION#"}
RESPONSE_SUFFIX = "_RESPONSE"
BASE_COLUMNS = ("LOCATION#", "WAVID", "TERRITORY MANAGER", "SALES MANAGER")
SCORE_COLUMN = "SESCORE"


def canonical_names(df: DataFrame) -> DataFrame:
    """Upper-case every name, unify the location column, strip ``_RESPONSE``
    (P4, P5, P6)."""
    names = []
    for c in df.columns:
        u = c.upper()
        u = LOCATION_ALIASES.get(u, u)
        names.append(u.replace(RESPONSE_SUFFIX, ""))
    return df.toDF(*names)


def layout_columns(layout: str) -> set[str]:
    inverse = {new: old for old, new in LAYOUT_RENAMES[layout].items()}
    return set(BASE_COLUMNS) | {SCORE_COLUMN} | {inverse.get(q, q) for q in QUESTIONS}


def detect_layout(df: DataFrame) -> str | None:
    """Layout of a canonically named file: by its columns; when a file
    carries the columns of both layouts, by the year of its earliest wave id
    (the reference's rule, one small aggregate)."""
    cols = set(df.columns)
    fits = [name for name in LAYOUT_RENAMES if layout_columns(name) <= cols]
    if len(fits) <= 1:
        return fits[0] if fits else None
    year = df.agg(F.min(F.substring(F.col("WAVID").cast("string"), 1, 4))).first()[0]
    return LAYOUT_BY_YEAR.get(year)


def normalise(df: DataFrame, layout: str) -> DataFrame:
    """Project one file to the canonical survey schema."""
    inverse = {new: old for old, new in LAYOUT_RENAMES[layout].items()}
    return df.select(
        key_text(df, "LOCATION#").alias("site_id"),
        key_text(df, "WAVID").alias("wave_id"),
        F.col("`TERRITORY MANAGER`").cast("string").alias("territory_manager"),
        F.col("`SALES MANAGER`").cast("string").alias("sales_manager"),
        *[F.col(inverse.get(q, q)).cast("string").alias(q.lower()) for q in QUESTIONS],
        F.col(SCORE_COLUMN).cast("double").alias("experience_score"))


def normalise_files(files: Sequence[DataFrame], quarantine: bool = False):
    """Normalise and union survey files (U1). Returns the union, or
    ``(union, rejected_files)`` when ``quarantine`` is true."""
    good, bad = [], []
    for f in files:
        f = canonical_names(f)
        layout = detect_layout(f)
        if layout is None:
            if not quarantine:
                raise ValueError(f"survey file matches no known layout: {f.columns}")
            bad.append(f)
            continue
        good.append(normalise(f, layout))
    if not good:
        raise ValueError("no survey file in a known layout")
    out = good[0]
    for g in good[1:]:
        out = out.unionByName(g, allowMissingColumns=True)
    return (out, bad) if quarantine else out
