"""Language identification by nearest centroids.

A text becomes its counts of byte 1-, 2- and 3-grams over folded letters
(other ASCII characters end a word), hashed into ``DIMS`` places, weighted
(1 + ln count) * idf and scaled to length one. Every language has a few
centroids, found by spherical k-means over a sample of its rows; the best
cosine names the language. A text is rejected when its cosine is under
``slack`` times that of the centroid's own outlying rows (the 1 % furthest);
a text of fewer than ``MIN_PLACES`` different n-grams is too short to be.

Document frequencies are counted over all rows that may be learned from; the
sample for the centroids has a documented expected size per language
(``per_lang``).

Defined results: a null text or one without a letter is ``und`` with score 0
and rejected. A null language is not learned from. If nothing can be learned,
every text is ``und``. Equal cosines go to the language that sorts first.
Repeated rows are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegauge.llm.tables import freeze, read
from sitegauge.llm.textvec import slices

BITS = 13
DIMS = 1 << BITS
MIN_PLACES = 64
#: Languages whose counts are made part of a filter.
MOST_LANGS = 1000


def _fold() -> np.ndarray:
    t = np.full(256, 0x20, dtype=np.uint8)
    t[0x61:0x7B] = np.arange(0x61, 0x7B)
    t[0x41:0x5B] = np.arange(0x61, 0x7B)
    t[0x80:] = np.arange(0x80, 0x100)
    return t


_FOLD = _fold()
_ODD = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


def counts(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, counts) of every text's n-grams, in row order."""
    for first, last, data, offsets in slices(column):
        c = np.take(_FOLD, data)
        # upper-case letters of the two-byte Latin-1 range
        wide = np.flatnonzero((c[1:] >= 0x80) & (c[1:] <= 0x9E) & (c[:-1] == 0xC3)) + 1
        c[wide] += 0x20
        keep = np.ones(len(c), dtype=bool)
        keep[1:] = (c[1:] != 0x20) | (c[:-1] != 0x20)
        at = np.concatenate([[0], np.cumsum(keep)])[offsets]
        c = c[keep].astype(np.uint32)
        one = c * _ODD[0]
        two = one[:-1] * np.uint32(31) + c[1:] * _ODD[1]
        three = two[:-1] * np.uint32(31) + c[2:] * _ODD[2]
        grams = [(_spread(g)) for g in (one, two, three)]
        for row in range(last - first):
            a, b = int(at[row]), int(at[row + 1])
            if b == a:
                yield np.zeros(0, np.int64), np.zeros(0, np.int64)
                continue
            tf = np.bincount(np.concatenate([g[a:max(a, b - i)] for i, g in enumerate(grams)]), minlength=DIMS)
            places = np.flatnonzero(tf)
            yield places, tf[places]


def _spread(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return ((h ^ (h >> np.uint32(12))) >> np.uint32(32 - BITS)).astype(np.int16)


def _vector(places: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = (1 + np.log(tf)) * idf[places]
    size = np.sqrt(v @ v)
    return (v / size if size else v).astype(np.float32)


@dataclass
class Model:
    """idf per place; per centroid its language, vector and least cosine."""

    idf: np.ndarray
    langs: list
    centroids: np.ndarray
    least: np.ndarray


def _kmeans(rows: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from farthest-first seeds; (centroids, members)."""
    mean = rows.mean(axis=0)
    seeds = [int(np.argmax(rows @ mean))]
    near = rows @ rows[seeds[0]]
    while len(seeds) < min(k, len(rows)):
        seeds.append(int(np.argsort(near, kind="stable")[len(rows) // 20]))
        near = np.maximum(near, rows @ rows[seeds[-1]])
    centroids = rows[seeds]
    for _ in range(rounds):
        own = np.argmax(rows @ centroids.T, axis=1)
        sums = np.stack([rows[own == j].sum(axis=0) if (own == j).any() else centroids[j] for j in range(len(centroids))])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centroids, np.argmax(rows @ centroids.T, axis=1)


def train_langid(docs: DataFrame, fold=None, clusters: int = 4, per_lang: int = 1500,
                 least_share: float = 0.05, slack: float = 0.2) -> Model:
    """Learn idf and centroids from rows (doc_id, text, lang) that ``fold`` allows.

    Clusters with less than ``least_share`` of a language's sampled rows are
    left out, so that a few wrongly marked rows make no centroid.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang")).where("lang is not null and text is not null")
    if fold is not None:
        rows = rows.where(fold)

    def frequencies(batches):
        df, n = np.zeros(DIMS + 1, dtype=np.int64), 0
        for batch in batches:
            for places, _ in counts(batch.column(0)):
                df[places] += 1
                n += 1
        df[DIMS] = n
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"place": at.astype(np.int32), "df": df[at]})

    seen = (rows.select("text").mapInArrow(frequencies, "place int, df long")
            .groupBy("place").agg(F.sum("df").alias("df")).toPandas())
    df = np.zeros(DIMS + 1)
    df[seen["place"].to_numpy()] = seen["df"].to_numpy()
    idf = np.log((1 + df[DIMS]) / (1 + df[:DIMS])) + 0.1

    # One count per language: as part of the filter, so that no text moves before it
    # is sampled. Where there are too many languages for that, the counts are joined.
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    few = {r["lang"]: r["n"] for r in sizes.limit(MOST_LANGS + 1).collect()}
    if len(few) > MOST_LANGS:
        rows = rows.join(sizes, "lang")
    else:
        known = F.create_map(*[F.lit(x) for pair in few.items() for x in pair]) if few else F.lit(None).cast("map<string,long>")
        rows = rows.withColumn("n", F.try_element_at(known, F.col("lang")))
    sample = (rows.where(F.expr(f"pmod(xxhash64(doc_id, text), 1048576L) * n < {per_lang} * 1048576L"))
              .select("lang", "text"))
    shared = docs.sparkSession.sparkContext.broadcast(idf)

    def vectors(batches):
        for batch in batches:
            lang, places, vals = [], [], []
            for i, (p, tf) in enumerate(counts(batch.column(1))):
                if len(p):
                    lang.append(batch.column(0)[i].as_py())
                    places.append(p.astype(np.int16).tobytes())
                    vals.append(_vector(p, tf, shared.value).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array(places, pa.binary()), pa.array(vals, pa.binary())],
                ["lang", "places", "vals"])

    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["places", "vals"])
        x = np.zeros((len(pdf), DIMS), dtype=np.float32)
        for i, (p, v) in enumerate(zip(pdf["places"], pdf["vals"])):
            x[i, np.frombuffer(p, dtype=np.int16)] = np.frombuffer(v, dtype=np.float32)
        centroids, own = _kmeans(x, clusters)
        out = []
        for j, c in enumerate(centroids):
            members = x[own == j] @ c
            if len(members) and (len(members) >= least_share * len(x) or len(centroids) == 1):
                out.append((pdf["lang"].iloc[0], j, c.astype(np.float32).tobytes(),
                            slack * float(np.quantile(members, 0.01))))
        return pd.DataFrame(out, columns=["lang", "cluster", "centroid", "least"])

    found = freeze(sample.mapInArrow(vectors, "lang string, places binary, vals binary")
                   .groupBy("lang").applyInPandas(cluster, "lang string, cluster int, centroid binary, least double"),
                   "centroids").orderBy("lang", "cluster").toPandas()
    centroids = [np.frombuffer(c, dtype=np.float32) for c in found["centroid"]]
    return Model(idf, list(found["lang"]), np.stack(centroids, axis=1) if centroids else np.zeros((DIMS, 0)),
                 found["least"].to_numpy(dtype=float))


def _judge(column: pa.Array, letters, model: Model):
    """(language, cosine, rejected) of every row of a batch."""
    lang, score, gone = [], [], []
    for (places, tf), has in zip(counts(column), letters):
        if not has or not len(places) or not model.langs:
            lang.append("und"), score.append(0.0), gone.append(True)
            continue
        cos = _vector(places, tf, model.idf) @ model.centroids[places]
        best = int(np.argmax(cos))
        lang.append(model.langs[best])
        score.append(min(max(float(cos[best]), 0.0), 1.0))
        gone.append(bool(len(places) >= MIN_PLACES and cos[best] < model.least[best]))
    return lang, score, gone


def predict_langid(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, lang_pred, score, rejected) of every row, from its text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            lang, score, gone = _judge(batch.column(1), batch.column(2).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(gone, pa.bool_())],
                ["id", "lang_pred", "score", "rejected"])

    kind = dict(docs.dtypes)[id_col]
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .select("id", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
            .mapInArrow(run, f"id {kind}, lang_pred string, score double, rejected boolean")
            .withColumnRenamed("id", id_col))


def keep_known(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose language is not rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    width, place, names = len(docs.columns), docs.columns.index(text_col), docs.columns

    def run(batches):
        for batch in batches:
            _, _, gone = _judge(batch.column(place).cast(pa.string()), batch.column(width).to_pylist(), shared.value)
            kept = batch.filter(pa.array([not g for g in gone], pa.bool_()))
            yield pa.RecordBatch.from_arrays(kept.columns[:width], names)

    letters = F.coalesce(F.col(text_col).cast("string").rlike(r"\p{L}"), F.lit(False))
    return docs.select("*", letters.alias("_letters")).mapInArrow(run, docs.schema)


HELD_OUT = "coalesce(crc32(cast(doc_id as string)) % 4 = 2, false)"


def op5_langid_centroids(spark, sf_dir: str) -> DataFrame:
    """Every document's predicted language, learned outside the held-out quarter."""
    docs = read(spark, sf_dir, "documents")
    model = train_langid(docs, fold=f"doc_id is not null and not {HELD_OUT}")
    return (predict_langid(docs, model)
            .select("doc_id", F.expr(HELD_OUT).alias("held_out"), "lang_pred", "score", "rejected"))
