"""Embedding near-duplicates by iterative quantisation.

Vectors of equal label are linked when their cosine, in double precision, is
at least ``least``.

* Equal vectors of a label become one class with a number of copies.
* A bounded, documented sample (``max_values`` numbers) gives mean, principal
  axes and, by iterative quantisation, a rotation whose signs are balanced
  bits, as many as the vectors have numbers (64 at most).
* The bits are cut into ``tables`` substrings; every class is indexed in every
  table. No link is lost: linked vectors are at most ``d`` apart with
  ``d * d = 2 - 2 * least``, a rotation adds nothing to that, so in the table
  where their projections are nearest they are at most ``d / sqrt(tables)``
  apart, and their middle is within half of that of both. A class therefore
  stands in each bucket that its projection reaches within this half: its own
  substring, and those with bits flipped whose numbers' squares add up to no
  more. Both vectors stand in their middle's bucket.
* The sample also tells how many tables and bits cost least. They, like the
  sample, decide the cost only; the links are the same whatever they are.
* Rows of one bucket (label, table, substring) meet in blocks of at most about
  ``BLOCK`` x ``BLOCK`` rows, so a large bucket becomes many tasks' work. In a
  block the original vectors decide. A pair counts in the bucket of its middle in
  the table where it is nearest, so once; a block gives one row per vector
  (its links and the smallest member of its local component, over all links
  counted there), never pairs.

Defined results: a null label, a null or empty vector, a null or non-finite number or
length zero links with nothing. Vectors of different lengths never link. Ids
must be below 2**62; a null id takes part, its component is the smallest id it
is linked with, null if there is none, and then it is kept. Repeated rows are
copies. An empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegauge.llm.components import connected_components
from sitegauge.llm.tables import NULL_IDS, freeze, read

BLOCK = 1024
#: Cost of a class in one more bucket (its row with the vector moves), in comparisons.
TABLE_COST = 1000
#: Numbers of tables that are weighed, and rows and buckets that weigh them.
TABLES, WEIGHED, REACHED = (1, 2, 3, 4, 5, 6, 8), 8192, 1 << 22
#: Bits of a substring at most: a vector in the midst of all stands in every bucket.
BITS = 16
#: Added to squared distances, far above what rounding takes off them.
SLACK = 1e-9
#: Pairs whose bucket is told at once.
TOLD = 1 << 16


def itq(sample: np.ndarray, seed: int, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection) whose signs are balanced codes of unit vectors."""
    mean = sample.mean(axis=0)
    centred = sample - mean
    bits = min(64, sample.shape[1])
    _, _, axes = np.linalg.svd(centred.T @ centred)
    v = centred @ axes[:bits].T
    rotation = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, bits)))[0]
    for _ in range(rounds):
        codes = np.where(v @ rotation >= 0, 1.0, -1.0)
        u, _, wt = np.linalg.svd(codes.T @ v)
        rotation = wt.T @ u.T
    return mean, axes[:bits].T @ rotation


def radius(least: float, tables: int) -> float:
    """Square of the distance within which a class stands in a table's buckets."""
    return max(0.0, 2 - 2 * least) / 4 / tables + SLACK


def reach(numbers: np.ndarray, square: float):
    """(row, bucket) of every bucket that a row's numbers reach, bit by bit: one pair of
    arrays for the first number, the first two, and so on."""
    row = np.arange(len(numbers))
    key, left = np.zeros(len(numbers), dtype=np.int64), np.full(len(numbers), square)
    for i in range(numbers.shape[1]):
        x = numbers[row, i]
        cost = x * x
        also = np.flatnonzero(cost <= left)
        sign = x >= 0
        key = np.concatenate([key | sign.astype(np.int64) << i, key[also] | (~sign[also]).astype(np.int64) << i])
        left = np.concatenate([left, left[also] - cost[also]])
        row = np.concatenate([row, row[also]])
        yield row, key


def plan(sample: np.ndarray, labels: np.ndarray, classes_per_label: float, least: float) -> tuple[int, int, tuple]:
    """(substring bits, tables, map) of the least cost. A class costs ``TABLE_COST``
    a bucket and 1 for each class that it meets there. The first table speaks for all."""
    mean, project = itq(sample, seed=0)
    width = project.shape[1]
    some = np.random.default_rng(7).permutation(len(sample))[:WEIGHED]
    numbers = (sample[some] - mean) @ project
    _, group = np.unique(labels[some], return_inverse=True)
    sizes = np.bincount(group).astype(float)
    within = (sizes * (sizes - 1)).sum()
    best = (math.inf, 1, 1)
    for tables in (t for t in TABLES if t <= width):
        for bits, (row, key) in enumerate(reach(numbers[:, :min(BITS, width // tables)], radius(least, tables)), start=1):
            buckets = len(row) / len(some)
            if tables * TABLE_COST * buckets >= best[0] or len(row) > REACHED:
                break
            _, sizes = np.unique(group[row] << bits | key, return_counts=True)
            meets = classes_per_label * ((sizes * (sizes - 1.0)).sum() / within if within else 0.0)
            cost = tables * (TABLE_COST * buckets + max(meets, classes_per_label * buckets ** 2 / 2 ** bits))
            best = min(best, (cost, bits, tables))
    return best[1], best[2], (mean, project[:, :best[1] * best[2]])


def _numbers(unit: np.ndarray, mean: np.ndarray, project: np.ndarray) -> np.ndarray:
    """Projections whose digits don't depend on the other rows, so that every block
    tells the same of a pair."""
    out = np.zeros((len(unit), project.shape[1]))
    for i, ways in enumerate(project):
        out += (unit[:, i] - mean[i])[:, None] * ways
    return out


def _counted(u: np.ndarray, v: np.ndarray, bits: int, table: int, key: int) -> np.ndarray:
    """Whether each pair of projections is nearest in ``table`` and has its middle in ``key``."""
    mine = slice(table * bits, (table + 1) * bits)
    here = np.flatnonzero((((u[:, mine] + v[:, mine]) >= 0) @ (1 << np.arange(bits, dtype=np.int64))) == key)
    apart = np.zeros((len(here), u.shape[1] // bits))
    for t in range(apart.shape[1]):
        for i in range(t * bits, (t + 1) * bits):
            apart[:, t] += (u[here, i] - v[here, i]) ** 2
    out = np.zeros(len(u), dtype=bool)
    out[here] = apart.argmin(axis=1) == table
    return out


def _unit(batch_column: pa.Array, dim: int) -> np.ndarray:
    flat = batch_column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def _roots(a: np.ndarray, b: np.ndarray, nodes: int) -> np.ndarray:
    """The smallest node of each node's component under the edges ``a``-``b``."""
    root = np.arange(nodes)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (root[root] != root).any():
            root = root[root]
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root


def _block_links(left, right, table: int, least: float, bits: int = 0, key: int = 0, maps=None):
    """Of a block: weighted links counted here for each left row, and over all of
    them the smallest id of the local component of each left and each right row."""
    ids_l, x_l = left[:2]
    ids_r, x_r, _, copies_r = right
    a, b = np.nonzero((x_l @ x_r.T >= least) & (ids_l[:, None] != ids_r[None, :]))
    if bits and len(a):
        of_l, at_l = np.unique(a, return_inverse=True)
        of_r, at_r = np.unique(b, return_inverse=True)
        u, v = _numbers(x_l[of_l], *maps), _numbers(x_r[of_r], *maps)
        here = np.concatenate([_counted(u[at_l[s:s + TOLD]], v[at_r[s:s + TOLD]], bits, table, key) for s in range(0, len(a), TOLD)])
        a, b = a[here], b[here]
    counted = np.bincount(a, weights=copies_r[b], minlength=len(ids_l)).astype(np.int64)
    ids, node = np.unique(np.concatenate([ids_l, ids_r]), return_inverse=True)
    node_l, node_r = node[:len(ids_l)], node[len(ids_l):]
    root = _roots(node_l[a], node_r[b], len(ids))
    return counted, ids[root[node_l]], ids[root[node_r]]


def links(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
          least: float = 0.98, max_values: int = 2_000_000) -> DataFrame:
    """(id_col, n_links, component_id, kept) of every row."""
    spark = vectors.sparkSession
    vec = F.col(vec_col).cast("array<float>")
    ok = (F.col("label").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)
          & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
          & F.exists("vec", lambda x: x != 0))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), vec.alias("vec"))
    rows = rows.withColumn("ok", F.coalesce(ok, F.lit(False)))
    rows = freeze(rows.withColumn("vh", F.sha2(F.concat_ws(",", F.transform("vec", lambda x: (x + F.lit(0.0)).cast("string"))), 256)), "vectors")
    classes = freeze(rows.where("ok").groupBy("label", "vh").agg(
        F.coalesce(F.min("id"), F.expr(f"{NULL_IDS}L | (xxhash64(label, vh) & {NULL_IDS - 1}L)")).alias("rep"),
        F.count("*").alias("copies"), F.first("vec").alias("vec"))
        .withColumn("dim", F.size("vec")), "classes")

    edges, counts = None, None
    dims = [r["dim"] for r in classes.groupBy("dim").count().orderBy("dim").collect()]
    found = []
    for dim in dims:
        part = classes.where(F.col("dim") == dim)
        # classes that a vector shares its label with, on average over the vectors,
        # so a label that holds most of them decides and many small ones do not
        n, squares = (part.groupBy("label").agg(F.count("*").cast("double").alias("c"))
                      .agg(F.sum("c"), F.sum(F.col("c") * F.col("c"))).first())
        share = min(1.0, max_values / dim / n)
        sample = (part.where(F.pmod(F.xxhash64("vh"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
                  .select("vec", F.xxhash64("label").alias("label")).orderBy("vh").toPandas())
        unit = np.array(sample["vec"].tolist(), dtype=np.float64)
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        bits, tables, maps = plan(unit, sample["label"].to_numpy(), squares / n, least)
        found.append(freeze(_search(part, dim, bits, tables, spark.sparkContext.broadcast(maps), least), "links"))
    if found:
        every = found[0]
        for more in found[1:]:
            every = every.unionByName(more)
        counts = every.groupBy("rep").agg(F.sum("n").alias("n"))
        edges = every.where("low <> rep").select(F.col("rep").alias("a"), F.col("low").alias("b"))
        comps = connected_components(edges)
        labels = (classes.select("label", "vh", "rep", "copies").join(counts, "rep", "left")
                  .join(comps.select(F.col("node").alias("rep"), "component"), "rep", "left")
                  .select("label", "vh", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                          F.coalesce("component", "rep").alias("c")))
        judged = (rows.where("ok").select("id", "label", "vh").join(labels, ["label", "vh"])
                  .select("id", "n_links", F.when(F.col("c") < NULL_IDS, F.col("c")).alias("component_id")))
    else:
        judged = rows.where("ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    alone = rows.where("not ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return judged.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))


def _search(classes: DataFrame, dim: int, bits: int, tables: int, maps, least: float) -> DataFrame:
    """(rep, n, low) rows: links counted per class and block, smallest rep of its component there."""
    kind = dict(classes.dtypes)["label"]

    def index(batches):
        mean, project = maps.value
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                numbers = (_unit(some.column(2), dim) - mean) @ project
                for t in range(tables):
                    for row, key in reach(numbers[:, t * bits:(t + 1) * bits], radius(least, tables)):
                        pass
                    row = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [some.column(0).take(row), pa.array(np.full(len(key), t, dtype=np.int32)), pa.array(key), some.column(1).take(row)],
                        ["label", "tab", "key", "rep"])

    spread = freeze(classes.select("label", "rep", "vec").mapInArrow(index, f"label {kind}, tab int, key long, rep long"), "index")
    sizes = (spread.groupBy("label", "tab", "key").agg(F.count("*").alias("m")).where("m > 1")
             .withColumn("parts", F.ceil(F.col("m") / BLOCK).cast("int")))
    placed = (spread.join(sizes, ["label", "tab", "key"])
              .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
              .join(classes.select("rep", "vec", "copies"), "rep"))
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    both = (placed.select("*", every.alias("other"))
            .select("label", "tab", "key", F.explode(F.array(
                F.struct(F.col("own").alias("i"), F.col("other").alias("j"), F.lit(0).alias("side")),
                F.struct(F.col("other").alias("i"), F.col("own").alias("j"), F.lit(1).alias("side")))).alias("p"),
                "rep", "vec", "copies"))
    # one row serves both sides of its own block
    both = (both.select("label", "tab", "key", "p.i", "p.j", "p.side", "rep", "vec", "copies")
            .where("not (i = j and side = 1)"))

    def meet(batches):
        held, name = [], None
        for batch in batches:
            unit = _unit(batch.column("vec"), dim)
            names = list(zip(*(batch.column(c).to_pylist() for c in ("label", "tab", "key", "i", "j"))))
            side, rep, copies = (batch.column(c).to_numpy() for c in ("side", "rep", "copies"))
            cuts = [0, *[x for x in range(1, len(names)) if names[x] != names[x - 1]], len(names)]
            for a, b in zip(cuts, cuts[1:]):
                if names[a] != name and held:
                    yield from _meet_block(held, name, least, bits, maps.value)
                    held = []
                name = names[a]
                held.append((side[a:b], rep[a:b], unit[a:b], copies[a:b]))
        if held:
            yield from _meet_block(held, name, least, bits, maps.value)

    return (both.repartition("label", "tab", "key", "i", "j")
            .sortWithinPartitions("label", "tab", "key", "i", "j")
            .mapInArrow(meet, "rep long, n long, low long"))


def _meet_block(held, name, least: float, bits: int, maps):
    side, rep, unit, copies = (np.concatenate(x) for x in zip(*held))
    pick = lambda m: (rep[m], unit[m], None, copies[m])
    left = pick(side == 0)
    right = left if name[3] == name[4] else pick(side == 1)
    if len(left[0]) and len(right[0]):
        n, low, low_r = _block_links(left, right, name[1], least, bits, name[2], maps)
        ids, some = left[0], n > 0
        if right is not left:
            # the mirrored block counts the right rows' links; their edges are needed once
            ids, n, low = np.append(ids, right[0]), np.append(n, np.zeros_like(right[0])), np.append(low, low_r)
            some = (n > 0) | (low < ids)
        if some.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[some]), pa.array(n[some]), pa.array(low[some])], ["rep", "n", "low"])


def op9_itq_near_dups(spark, sf_dir: str) -> DataFrame:
    """All embeddings, cosine 0.98, within equal labels."""
    return links(read(spark, sf_dir, "embeddings"))
