"""Scorecard inputs from files (S6 re-aimed, S7, S11, P3).

The reference reads spreadsheets and a CRM; here every role is a CSV (with a
header) or Parquet file with an explicit schema. Source-system column names
are accepted and renamed to ours, so an export can be used as it is. Survey
files keep their own layouts: they are read as text and normalised by
:func:`sitegauge.sources.survey.normalise_files`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitegauge.functions.columns import key_text
from sitegauge.sources.standins import World

# Column names of the source exports and our names for them.
SOURCE_NAMES = {
    "roster": {"OPCO": "region", "CO/DO": "district", "LOCATION NO": "site_id"},
    "hierarchy": {"Location_Number__c": "site_id", "Sold_To_Name__c": "owner_name",
                  "Sold_To_Number__c": "owner_number", "Street__c": "address", "City__c": "city"},
    "volume": {"Location_Number": "site_id", "Date": "ts"},
    "loyalty": {"Location_Number": "site_id", "Date": "ts", "Loyalty": "loyalty_volume"},
    "assignment": {"TERRITORY MANAGER": "territory_manager", "OPCO/Region": "region"},
}

SCHEMAS = {
    "roster": (("site_id", "string"), ("region", "string"), ("district", "string")),
    "hierarchy": (("site_id", "string"), ("owner_name", "string"), ("owner_number", "string"),
                  ("address", "string"), ("city", "string")),
    "volume": (("site_id", "string"), ("ts", "timestamp_ntz"), ("volume", "decimal(28,8)"),
               ("premium_volume", "decimal(28,8)")),
    "loyalty": (("site_id", "string"), ("ts", "timestamp_ntz"),
                ("loyalty_volume", "decimal(28,8)")),
    "assignment": (("territory_manager", "string"), ("region", "string")),
}


def read_any(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet by extension or folder of ``.parquet`` files, else CSV with a
    header (quoted fields, ``""`` escapes)."""
    if path.rstrip("/").endswith(".parquet"):
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_role(spark: SparkSession, role: str, path: str) -> DataFrame:
    """One input role: read (text for CSV), rename source names, cast to the
    declared types. Unparsable values become NULL (``try_cast``), they never
    fail the run or turn a column into text."""
    raw = read_any(spark, path)
    renames = {c: SOURCE_NAMES[role].get(c, c) for c in raw.columns}
    raw = raw.withColumnsRenamed({k: v for k, v in renames.items() if k != v})
    missing = [c for c, _ in SCHEMAS[role] if c not in raw.columns]
    if missing:
        raise ValueError(f"{role} input {path} lacks columns {missing}")
    return raw.select(*[_typed(raw, c, t).alias(c) for c, t in SCHEMAS[role]])


def _typed(df: DataFrame, c: str, t: str):
    """Cast to the declared type; a numeric source column declared as text
    (ids from spreadsheets) goes through bigint, so ``101.0`` never appears
    (D18)."""
    if t == "string" and isinstance(df.schema[c].dataType, T.NumericType):
        return key_text(df, c)
    return F.col(f"`{c}`").try_cast(t)


def world_from_files(spark: SparkSession, run_date: dt.date, roster: str, hierarchy: str,
                     surveys: Sequence[str], volume: str, loyalty: str, assignment: str,
                     name: str = "files") -> World:
    """A complete set of scorecard inputs from files. Loyalty records get the
    nested parent key the loyalty source carries (J12)."""
    loy = read_role(spark, "loyalty", loyalty)
    loyalty_records = loy.select(
        F.struct(F.col("site_id").alias("location_number")).alias("location_master"),
        "ts", "loyalty_volume")
    survey_files = [read_any(spark, p) for p in surveys]
    return World(name, run_date, read_role(spark, "roster", roster),
                 read_role(spark, "hierarchy", hierarchy), read_role(spark, "volume", volume),
                 loyalty_records, survey_files, read_role(spark, "assignment", assignment))
