"""Quality classifier: hashed word n-grams, logistic regression, FTRL.

Features of a text: its tokens (runs of letters, of digits or of punctuation,
case kept) and pairs of neighbouring tokens, hashed into ``DIMS`` places, and
the share of pairs whose two tokens are equal as one of eight places, so that
repetition of any word shows. A value is 1 + ln(count) (the share's place
weighs as much as all others together), and the vector has length one. The
model is trained with follow-the-regularised-leader (proximal, L1 and L2)
updates over a stream of examples in hash order, and scores a text by a sparse
dot product.

Training reads a sample of labelled rows of a documented expected size
(``max_rows``), chosen by a hash of the id, as a stream with bounded memory.
Scoring covers all rows.

Defined results: a null or empty text has no features and is scored by the
bias. Labels that are null or not 0/1 are not learned from, nor are ids whose
labels contradict each other; without any labels every score is 0.5. A null id
is never held out (its checksum is null) and never learned from. Of several
documents with a learned id one is used, that with the smallest text hash.
Repeated rows are scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegauge.llm.tables import freeze, read
from sitegauge.llm.textvec import ngrams, slices, tokens

BITS = 18
DIMS = 1 << BITS


@dataclass(frozen=True)
class Ftrl:
    """Learning rate (alpha, beta), L1 and L2 strength, and about how many updates
    to make (3 to 30 passes over the sample)."""

    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.0005
    l2: float = 0.0005
    updates: int = 36_000

    def epochs(self, rows: int) -> int:
        return max(3, min(30, self.updates // max(1, rows)))


def _classes() -> np.ndarray:
    t = np.full(256, 3, dtype=np.uint8)
    t[:33] = 0
    t[0x30:0x3A] = 2
    t[0x41:0x5B] = 1
    t[0x61:0x7B] = 1
    t[0x80:] = 1
    return t


_CLASSES, _SAME = _classes(), np.arange(256, dtype=np.uint8)


def features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, values) of every text, in row order."""
    for first, last, data, offsets in slices(column):
        hashes, _, firsts = tokens(data, offsets, _CLASSES, _SAME)
        pairs = ngrams(hashes, 2)
        again = np.concatenate([[0], np.cumsum(hashes[1:] == hashes[:-1])]) if len(hashes) else np.zeros(1, np.int64)
        one = (hashes >> np.uint64(64 - BITS)).astype(np.int32)
        two = (pairs >> np.uint64(64 - BITS)).astype(np.int32)
        for row in range(last - first):
            a, b = int(firsts[row]), int(firsts[row + 1])
            grams = np.sort(np.concatenate([one[a:b], two[a:max(a, b - 1)]]))
            if not len(grams):
                yield grams, np.zeros(0, np.float32)
                continue
            at = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
            values = 1 + np.log(np.diff(at, append=len(grams)))
            share = (again[max(a, b - 1)] - again[a]) / (b - a)
            values = np.append(values, np.sqrt((values * values).sum()))
            yield (np.append(grams[at], np.int32(DIMS - 1 - min(7, int(share * 16)))),
                   (values / (values[-1] * np.sqrt(2))).astype(np.float32))


def _train(params: Ftrl):
    """Follow the regularised leader over the rows of one ordered partition."""
    def run(batches):
        z, n = np.zeros(DIMS + 1), np.zeros(DIMS + 1)
        for batch in batches:
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            for i, label in enumerate(labels):
                places = np.frombuffer(batch.column("places")[i].as_py(), dtype=np.int32)
                values = np.frombuffer(batch.column("vals")[i].as_py(), dtype=np.float32)
                places, values = np.append(places, DIMS), np.append(values.astype(float), 1.0)
                if len(places) > 1 and places[-2] in places[:-2]:  # a hashed place may be the share's
                    places, back = np.unique(places, return_inverse=True)
                    values = np.bincount(back, weights=values)
                zi, ni = z[places], n[places]
                w = weights(zi, ni, params)
                p = 1 / (1 + np.exp(-np.clip(w @ values, -35, 35)))
                g = (p - label) * values
                step = (np.sqrt(ni + g * g) - np.sqrt(ni)) / params.alpha
                z[places] = zi + g - step * w
                n[places] = ni + g * g
        w = weights(z, n, params)
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_pydict({"place": at.astype(np.int32), "weight": w[at]})
    return run


def weights(z: np.ndarray, n: np.ndarray, params: Ftrl) -> np.ndarray:
    """The closed form of the regularised leader's weights."""
    kept = np.sign(z) * np.maximum(np.abs(z) - params.l1, 0)
    return -kept / ((params.beta + np.sqrt(n)) / params.alpha + params.l2)


def sample_ids(labelled: DataFrame, max_rows: int) -> tuple[DataFrame, int]:
    """(doc_id, label) of at most about ``max_rows`` of the labelled ids, by hash,
    and about how many they are."""
    labelled = freeze(labelled, "labelled")
    total = labelled.count()
    share = 1 << 20 if total <= max_rows else (max_rows << 20) // total
    return labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share), min(total, max_rows)


def train_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", fold=None,
                  max_rows: int = 12_000, params: Ftrl = Ftrl()) -> np.ndarray:
    """Weights (``DIMS`` places and the bias last) learned from labelled rows.

    ``fold``: condition over ``doc_id`` of the rows that may be learned from.
    About ``max_rows`` of them are used at most.
    """
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    usable = usable.where("doc_id is not null and label in (0, 1)")
    if fold is not None:
        usable = usable.where(fold)
    usable = (usable.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("top"))
              .where("label = top").select("doc_id", "label"))
    ids, size = sample_ids(usable, max_rows)

    def extract(batches):
        for batch in batches:
            got = list(features(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), batch.column("h"),
                 pa.array([p.tobytes() for p, _ in got], pa.binary()),
                 pa.array([v.tobytes() for _, v in got], pa.binary())], ["doc_id", "label", "h", "places", "vals"])

    # The sample's ids have a bounded number, so the texts need no shuffle.
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .join(F.broadcast(ids), "doc_id")
            .select("doc_id", "label", F.xxhash64("text").alias("h"), "text")
            .mapInArrow(extract, "doc_id long, label int, h long, places binary, vals binary")
            .groupBy("doc_id", "label").agg(F.min_by(F.struct("places", "vals"), "h").alias("x")))
    ordered = (rows.select("doc_id", "label", "x.places", "x.vals",
                           F.explode(F.sequence(F.lit(1), F.lit(params.epochs(size)))).alias("epoch"))
               .repartition(1).sortWithinPartitions("epoch", F.xxhash64("doc_id"), "doc_id"))
    model = freeze(ordered.mapInArrow(_train(params), "place int, weight double"), "weights").toPandas()
    out = np.zeros(DIMS + 1)
    out[model["place"].to_numpy()] = model["weight"].to_numpy()
    return out


def score_quality(docs: DataFrame, model: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score) of every row; score is the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model.astype(np.float32))

    def run(batches):
        w = shared.value
        for batch in batches:
            dots = np.array([float(w[p] @ v) for p, v in features(batch.column(1))])
            score = 1 / (1 + np.exp(-np.clip(dots + float(w[DIMS]), -35, 35)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["id", "score"])

    kind = dict(docs.dtypes)[id_col]
    scored = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return scored.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, model: np.ndarray, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is at least ``least``."""
    shared = docs.sparkSession.sparkContext.broadcast(model.astype(np.float32))
    names, place = docs.columns, docs.columns.index(text_col)

    def run(batches):
        w = shared.value
        bar = np.log(least / (1 - least))
        for batch in batches:
            dots = np.array([float(w[p] @ v) for p, v in features(batch.column(place).cast(pa.string()))])
            yield batch.filter(pa.array(dots + float(w[DIMS]) >= bar)).rename_columns(names)

    return docs.mapInArrow(run, docs.schema)


HELD_OUT = "coalesce(crc32(cast(doc_id as string)) % 3 = 1, false)"


def op7_quality_ftrl(spark, sf_dir: str) -> DataFrame:
    """Every document's quality score, learned from labels outside the held-out third."""
    docs = read(spark, sf_dir, "documents")
    model = train_quality(docs, read(spark, sf_dir, "labels"), fold=f"not {HELD_OUT}")
    return (score_quality(docs, model)
            .select("doc_id", F.expr(HELD_OUT).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))
