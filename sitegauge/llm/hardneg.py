"""Hard-negative mining by Four-Russians scoring.

Vectors become integers (``floor(scale * x)``); a row's score for an anchor is
their integer inner product. The dimensions are taken in groups of eight. A
candidate is stored as the bits of its numbers (two's complement): for every
bit place and group, one byte. For every anchor and group a table holds the
sums of all 256 subsets of the anchor's eight numbers. A candidate's byte looks
its subset's sum up; the sums of a bit place are added over the groups, and the
places are shifted together, the sign's place subtracting. Scores are exact.

Anchors and candidates are dealt into blocks by row number, not by label, so no
label makes a large task. Every (anchor block, candidate block) cell is a unit
of work: its anchors come first and are held (``ANCHORS`` of them on average), the
candidates stream past them, and only the best rows of each anchor leave it.
Two passes: the first finds every anchor's positives, the second, knowing their
scores, the negatives within each positive's bounds.

Defined results: rows with a null label, a null vector, or a null or non-finite
component take no part; an empty vector's scores are 0. Only vectors of equal
length are compared. A null id is no anchor and comes last among ties. Repeated
rows are rows of their own: each is ranked, and each that is an anchor has rows
in the result, its copies among its positives. Scaled components must lie in
+-2**31 and scores in +-2**62; an input beyond that fails with a message. An empty
table gives an empty result; extra columns aren't read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitegauge.llm.tables import forget, freeze, read

#: Anchors and candidates of a block, on average.
ANCHORS, CANDIDATES = 8192, 65536
#: Anchors and candidates that are scored at once.
TILE, CHUNK = 256, 2048
#: A null id's place among ties: behind all others.
LAST = np.iinfo(np.int64).max


def planes(values: np.ndarray, places: int) -> np.ndarray:
    """Bytes (rows, places, groups) of the numbers' bits, lowest place first."""
    rows, dim = values.shape
    padded = np.zeros((rows, -(-dim // 8) * 8), dtype=np.int64)
    padded[:, :dim] = values
    bits = (padded[:, None, :] >> np.arange(places)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")


def tables(anchors: np.ndarray) -> np.ndarray:
    """Subset sums (groups, 256, anchors) of each eight of the anchors' numbers."""
    rows, dim = anchors.shape
    groups = -(-dim // 8)
    padded = np.zeros((rows, groups * 8), dtype=np.int64)
    padded[:, :dim] = anchors
    eights = padded.reshape(rows, groups, 8).transpose(1, 2, 0)
    out = np.zeros((groups, 256, rows), dtype=np.int64)
    for bit in range(8):        # subsets with this number as their highest
        out[:, 1 << bit:2 << bit] = out[:, :1 << bit] + eights[:, bit, None]
    # the smallest numbers that hold a sum over all groups
    most = int(np.abs(padded).sum(axis=1).max(initial=0))
    for small in (np.int16, np.int32):
        if most <= np.iinfo(small).max:
            return out.astype(small)
    return out


def scores(bytes_: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Inner products (candidates, anchors) by lookups, adds and shifts."""
    rows, places, groups = bytes_.shape
    # the narrowest numbers that hold a whole sum times 2 ** places
    wide = np.int32 if int(np.abs(sums.astype(np.int64)).max(axis=1).sum(axis=0).max(initial=0)) << places < 1 << 31 else np.int64
    total = np.zeros((rows, sums.shape[2]), dtype=wide)
    part, looked = (np.empty((rows, sums.shape[2]), dtype=sums.dtype) for _ in range(2))
    for place in reversed(range(places)):
        part[:] = 0
        for g in range(groups):
            np.take(sums[g], bytes_[:, place, g], axis=0, out=looked, mode="clip")
            part += looked
        if place == places - 1:
            total -= part
        else:
            total <<= 1
            total += part
    return total


def _best(keys: list[np.ndarray], score: np.ndarray, tie: np.ndarray, most: int) -> np.ndarray:
    """Positions of the first ``most`` rows of every key: higher scores first, then smaller ties."""
    order = np.lexsort((tie, -score, *keys[::-1]))
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - first < most]


class _Cell:
    """One cell's anchors and the best rows so far. ``bounds``: for each anchor its
    positives' scores (a ragged list), or None in the first pass."""

    def __init__(self, anchors: dict, bounds, most: int, percent: int):
        self.a, self.bounds, self.most, self.percent = anchors, bounds, most, percent
        self.sums: dict = {}
        self.found: list = []
        self.held = 0
        slots = 1 if bounds is None else int(np.diff(bounds[0]).max(initial=0))
        #: the least score that may still be among the best of (anchor, slot)
        self.floor = np.full((len(anchors["row"]), slots), -LAST)

    def pick(self, s, anchor_rows, c, some) -> None:
        """Rows of the scores ``s`` that may be among the best."""
        a = self.a
        other = a["label"][anchor_rows][None, :] != c["label"][some][:, None]
        if self.bounds is None:
            at, who = np.nonzero(~other & (s >= self.floor[anchor_rows, 0]) & (a["row"][anchor_rows][None, :] != c["row"][some][:, None]))
            score = s[at, who]
            got = [(anchor_rows[who], np.zeros(len(at), np.int64), some[at], score)]
        else:
            got = []
            starts, values = self.bounds
            sizes = starts[anchor_rows + 1] - starts[anchor_rows]
            for k in range(sizes.max(initial=0)):
                has = np.flatnonzero(sizes > k)
                top = values[starts[anchor_rows[has]] + k]
                part = s[:, has]
                low = np.maximum(-(-self.percent * top // 100), self.floor[anchor_rows[has], k])
                at, who = np.nonzero(other[:, has] & (part <= top) & (part >= low))
                got.append((anchor_rows[has[who]], np.full(len(at), k), some[at], part[at, who]))
        for who, k, at, score in got:
            if len(who):
                score = score.astype(np.int64)
                ids = c["tie"][at]
                keep = _best([who, k], score, ids, self.most)
                self.found.append((who[keep], k[keep], c["id"][at[keep]], c["null"][at[keep]], c["row"][at[keep]], score[keep], ids[keep]))
                self.held += len(keep)

    def see(self, c: dict, bytes_: np.ndarray, dim: int) -> None:
        """Score a batch of candidates of one length against the cell's anchors."""
        mine = np.flatnonzero(self.a["dim"] == dim)
        if self.bounds is None:
            mine = mine[np.isin(self.a["label"][mine], c["label"])]
        mine = mine[np.argsort(self.a["label"][mine], kind="stable")]
        for t in range(0, len(mine), TILE):
            tile = mine[t:t + TILE]
            some = np.arange(len(c["row"]))
            if self.bounds is None:
                some = some[np.isin(c["label"], self.a["label"][tile])]
            key = (dim, tile.tobytes())
            if key not in self.sums:
                if len(self.sums) * TILE > 2 * ANCHORS:
                    self.sums.clear()
                self.sums[key] = tables(np.array([self.a["nums"][i] for i in tile], dtype=np.int64).reshape(len(tile), dim))
            for x in range(0, len(some), CHUNK):
                part = some[x:x + CHUNK]
                self.pick(scores(bytes_[part], self.sums[key]), tile, c, part)
        if self.held > 100_000:
            self.best()

    def best(self):
        """Merge what was found down to the best rows of each key."""
        if not self.found:
            return None
        parts = [np.concatenate(x) for x in zip(*self.found)]
        keep = _best([parts[0], parts[1]], parts[5], parts[6], self.most)
        parts = [p[keep] for p in parts]
        self.found, self.held = [tuple(parts)], 0
        full = np.flatnonzero((parts[0][self.most - 1:] == parts[0][:len(keep) - self.most + 1])
                              & (parts[1][self.most - 1:] == parts[1][:len(keep) - self.most + 1])) + self.most - 1
        self.floor[parts[0][full], parts[1][full]] = parts[5][full]
        return parts


def _pass(anchors: DataFrame, candidates: DataFrame, n_anchor: int, n_cand: int, most: int, percent: int,
          bounded: bool) -> DataFrame:
    """(anchor, slot, id, row, score): the best candidates of every anchor, cell by cell.

    ``anchors``: row, label, nums, tops; ``candidates``: row, id, label, dim, bytes.
    Sides are copied once for each block of the other, and meet sorted.
    """
    n_a, n_c = F.lit(n_anchor), F.lit(n_cand)
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    nothing = lambda kind: F.lit(None).cast(kind)
    left = anchors.select(
        F.pmod(F.xxhash64("row"), n_a).cast("int").alias("i"), every(n_c).alias("j"), F.lit(0).alias("side"), "row",
        nothing("long").alias("id"), "label", F.size("nums").alias("dim"), nothing("binary").alias("bytes"), "nums", "tops")
    right = candidates.select(
        every(n_a).alias("i"), F.pmod(F.xxhash64("row"), n_c).cast("int").alias("j"), F.lit(1).alias("side"), "row", "id",
        "label", "dim", "bytes", nothing("array<int>").alias("nums"), nothing("array<long>").alias("tops"))

    def meet(batches):
        cell, name, held = None, None, []

        def finish():
            parts = cell and cell.best()
            if parts:
                who, k, ids, null, row, score, _ = parts
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.a["row"][who]), pa.array(k.astype(np.int32)), pa.array(ids, mask=null), pa.array(row),
                     pa.array(score)], ["anchor", "slot", "id", "row", "score"])

        def opened():
            """The cell of the anchors read so far."""
            some = {c: np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in held]) for c in ("row", "label", "dim")}
            some["nums"] = [x for b in held for x in b.column("nums").to_pylist()]
            tops = [x or [] for b in held for x in b.column("tops").to_pylist()] if bounded else None
            bounds = tops if tops is None else (np.concatenate([[0], np.cumsum([len(x) for x in tops])]).astype(np.int64),
                                                np.array([y for x in tops for y in x], dtype=np.int64))
            return _Cell(some, bounds, most, percent)

        for batch in batches:
            i, j, side = (batch.column(c).to_numpy() for c in ("i", "j", "side"))
            cuts = np.flatnonzero((np.diff(i) != 0) | (np.diff(j) != 0) | (np.diff(side) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if name != (i[a], j[a]):
                    yield from finish()
                    cell, name, held = None, (i[a], j[a]), []
                part = batch.slice(a, b - a)
                if side[a] == 0:
                    held.append(part)
                    continue
                if not held:
                    continue        # no anchors in this cell
                cell = cell or opened()
                dims = part.column("dim").to_numpy()
                for dim in np.unique(dims).tolist():
                    rows = part.filter(pa.array(dims == dim))
                    c = {x: rows.column(x).to_numpy(zero_copy_only=False) for x in ("row", "label")}
                    null = rows.column("id").is_null().to_numpy(zero_copy_only=False)
                    ids = rows.column("id").fill_null(0).to_numpy(zero_copy_only=False)
                    c |= {"id": ids, "null": null, "tie": np.where(null, LAST, ids)}
                    raw = b"".join(rows.column("bytes").to_pylist())
                    groups = -(-dim // 8)
                    cell.see(c, np.frombuffer(raw, np.uint8).reshape(len(ids), len(raw) // max(1, groups * len(ids)), groups), dim)
        yield from finish()

    return (left.unionByName(right).repartition("i", "j").sortWithinPartitions("i", "j", "side", "label")
            .mapInArrow(meet, "anchor long, slot int, id long, row long, score long"))


def mine(vectors: DataFrame, anchors=None, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
         scale: int = 256, positives: int = 5, negatives: int = 5, percent: int = 80) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` is a condition on the input's columns (all rows if None). A
    positive is one of an anchor's first ``positives`` rows of its label; its
    negatives are the first ``negatives`` rows of other labels that score at
    least ``percent`` % of it and at most as much as it.
    """
    spark = vectors.sparkSession
    vec = F.col(vec_col).cast("array<double>")
    fine = F.col(label_col).isNotNull() & vec.isNotNull() & F.forall(
        vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    scaled = F.transform(vec, lambda x: F.floor(x * float(scale)))
    number = F.transform(scaled, lambda v: F.when(F.abs(v) < 1 << 31, v.cast("int")).otherwise(
        F.raise_error(F.lit("a scaled component is beyond 2**31")).cast("int")))
    kind = dict(vectors.dtypes)[label_col]
    # labels are compared only: their 64-bit hash stands for those that are no integers
    label = F.col(label_col).cast("long") if kind in ("tinyint", "smallint", "int", "bigint") else F.xxhash64(label_col)
    rows = freeze(vectors.where(fine).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), label.alias("label"),
        number.alias("nums"), F.coalesce((F.lit(True) if anchors is None else anchors) & F.col(id_col).isNotNull(), F.lit(False)).alias("anchor")),
        "vectors")
    size = F.aggregate("nums", F.lit(0).cast("long"), lambda s, v: F.greatest(s, F.abs(v.cast("long"))))
    n, n_anchor, dim, most = rows.agg(F.count("*"), F.count_if("anchor"), F.max(F.size("nums")), F.max(size)).first()
    if n_anchor and dim * most * most >= 1 << 62:
        raise ValueError("scores are beyond 2**62")
    places = int(most or 0).bit_length() + 1

    def index(batches):
        for batch in batches:
            nums, out = batch.column(3), [None] * batch.num_rows
            dims = np.diff(nums.offsets.to_numpy())
            flat = nums.flatten().to_numpy()
            starts = np.cumsum(dims) - dims
            for d in np.unique(dims).tolist():
                some = np.flatnonzero(dims == d)
                bits = planes(flat[starts[some][:, None] + np.arange(d)].reshape(len(some), d), places)
                for at, one in zip(some.tolist(), bits):
                    out[at] = one.tobytes()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(dims.astype(np.int32)), pa.array(out, pa.binary())], ["row", "id", "label", "dim", "bytes"])

    packed = freeze(rows.select("row", "id", "label", "nums")
                    .mapInArrow(index, "row long, id long, label long, dim int, bytes binary"), "planes")
    some = rows.where("anchor").select("row", "id", "label", "nums")
    n_a = max(1, -(-n_anchor // ANCHORS))
    # at least a cell for every core, in blocks of a thousand or more: this only deals the work
    n_c = max(1, -(-n // CANDIDATES), min(n // 1024, spark.sparkContext.defaultParallelism))
    first = lambda key: Window.partitionBy(*key).orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")

    def ranked(found: DataFrame, key, k: int) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(first(key))).where(F.col("rank") <= k)

    near = freeze(ranked(_pass(some.withColumn("tops", F.lit(None).cast("array<long>")), packed, n_a, n_c, positives, percent, False),
                         ["anchor"], positives).select("anchor", F.col("rank").alias("slot"), "id", "score"), "positives")
    tops = near.groupBy("anchor").agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "score"))), lambda x: x["score"]).alias("tops"))
    bounded = some.join(tops, some["row"] == tops["anchor"]).select("row", "id", "label", "nums", "tops")
    # slots of the second pass count from 0, ranks from 1
    far = freeze(ranked(_pass(bounded, packed, n_a, n_c, negatives, percent, True), ["anchor", "slot"], negatives)
                 .select("anchor", (F.col("slot") + 1).alias("slot"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")),
                 "negatives")
    forget(packed)
    return (far.join(near, ["anchor", "slot"])
            .join(some.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
            .select("anchor_id", F.col("id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), "negative_id",
                    F.col("score").alias("positive_score"), "negative_score"))


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Anchors are the embeddings whose id 100 divides; every seventh label is moved on by one first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(read(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 100 == 0)
