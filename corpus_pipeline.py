"""The training-data pipeline: five stages over ``documents``.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``. It reads all that the
stage before it kept (as Parquet), and its decisions take effect; all but the
last return the columns of ``documents``. Rows with null ids, null or empty
texts pass every stage or leave it by the same rules as other rows:

1. quality: rows whose quality score is under 0.5 go; a null or empty text is
   scored by the model's bias.
2. language: rows whose text is null, has no letter or is far from all
   languages go.
3. near_duplicates: of documents linked by five-word shingles with a
   similarity of 0.8 or more, that with the smallest id stays.
4. decontamination: documents that hold a benchmark item go.
5. tokens: every remaining document with its token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sitegauge.llm import decontam, jaccard, langid, quality, sentencepiece
from sitegauge.llm.tables import freeze, read


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. It learns from the
    labelled documents of the table, not only from those in ``docs``."""
    model = quality.train_quality(docs, read(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised from their text."""
    model = langid.train_langid(docs)
    return langid.keep_known(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate group."""
    return jaccard.one_per_group(docs, k=5, limit=jaccard.Threshold(80, 100))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the columns that training samples by."""
    return sentencepiece.encode(docs).select("doc_id", "n_tokens", "ids", "round_trip")


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("tokens", token_stage),
]

#: Trained models and token ids have no SQL form; tests hold the stages
#: against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = freeze(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
