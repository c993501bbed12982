"""N-gram Jaccard join with rare-first prefix filtering.

Two texts link when ``share * |A and B| >= ...``: exactly,
``den * |A & B| >= num * |A | B|`` over their sets of ``k``-word shingles.

Steps, all on Spark:

1. One pass hashes every text's shingles and collapses texts with equal sets
   into classes (128-bit digest of the sorted set). Copies are never expanded.
   The same pass counts shingles per hash bucket over the whole corpus.
2. A second pass sorts each class's shingles rare-first by those counts and
   keeps the prefix. Any fixed total order gives the same links; rare-first
   keeps the posting lists short. A pair that reaches the threshold shares a
   shingle of the longer set's prefix and of the shorter set's (smaller) index
   prefix.
3. Posting lists with two classes or more remain. Each class is first verified
   against one hub: among the classes heading its lists, the one it shares most
   prefix shingles with. Links found so give first components, which
   unite large groups of near copies with one comparison per copy.
4. What remains is the join of posting lists across components: pairs whose
   classes already are in one component add nothing to it. Length and
   positional filters are part of the join condition, the suffix filter
   (the sets' parities per hash range bound their difference) follows; every
   surviving pair is verified once on its whole sets.
5. Components of all links found.

The order table has a fixed number of buckets (``ORDER_BUCKETS``), so it may be
broadcast at any size of input. Sets of candidate classes are fetched with a
fixed-size Bloom filter and then an exact join.

Defined results: a null or empty text, or one without words, has the empty
set, links with nothing and is its own component. Repeated rows are copies. A
null id takes part like any row; its component is the smallest id that it is
linked with, null if there is none. Ids must be below 2**62. Other columns of
the input are not touched; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitegauge.llm.components import connected_components
from sitegauge.llm.tables import NULL_IDS, bitmap, forget, freeze, in_bitmap
from sitegauge.llm.textvec import shingle_sets

#: Buckets (a power of two) of the corpus-wide shingle counts that order shingles,
#: and how many of them travel as one row.
ORDER_BITS = 20
ORDER_BUCKETS = 1 << ORDER_BITS
BLOCK = 4096
#: Bits of the suffix filter.
PARITY = 1024


@dataclass(frozen=True)
class Threshold:
    """Link when ``den * intersection >= num * union``."""

    num: int
    den: int

    def overlap(self, total):
        """Smallest intersection that links two sets of ``total`` shingles together."""
        return -((-self.num * total) // (self.num + self.den))

    def probe(self, n: int) -> int:
        """Prefix length of a set as the longer one of a pair."""
        return n - -((-self.num * n) // self.den) + 1

    def index(self, n: int) -> int:
        """Prefix length of a set as the shorter one (or equally long)."""
        return n - int(self.overlap(2 * n)) + 1


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


FIRST = ["id", "sig", "word", "n", "block", "counts"]


def _bucket(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - ORDER_BITS)).astype(np.int64)


def _first_pass(docs: DataFrame, k: int) -> DataFrame:
    """Per row (id, sig, word, n); per task (block, counts): the task's shingle
    counts, ``BLOCK`` buckets in a row."""
    def run(batches):
        counts = np.zeros(ORDER_BUCKETS, dtype=np.uint32)
        held, size = [], 0

        def tally():
            np.add(counts, np.bincount(np.concatenate(held), minlength=ORDER_BUCKETS).astype(np.uint32), out=counts)

        for batch in batches:
            sigs, ns = [], []
            for _, s in shingle_sets(batch.column(1), k):
                sigs.append(_digest(s) if len(s) else None)
                ns.append(len(s))
                if len(s):
                    held.append(_bucket(s))
                    size += len(s)
                if size > 1 << 20:
                    tally()
                    held, size = [], 0
            rows = len(ns)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(sigs, pa.binary()),
                 batch.column(2).cast(pa.int64()), pa.array(ns, pa.int32()),
                 pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], FIRST)
        if held:
            tally()
        blocks = [i for i in range(ORDER_BUCKETS // BLOCK) if counts[i * BLOCK:(i + 1) * BLOCK].any()]
        rows = len(blocks)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.binary()), pa.nulls(rows, pa.int64()),
             pa.nulls(rows, pa.int32()), pa.array(blocks, pa.int32()),
             pa.array([counts[i * BLOCK:(i + 1) * BLOCK].tobytes() for i in blocks], pa.binary())], FIRST)
    return docs.mapInArrow(run, "id long, sig binary, word long, n int, block int, counts binary")


def _order(first: DataFrame) -> np.ndarray:
    """Rank of each bucket, rarest first, by its count over all tasks."""
    def run(batches):
        sums: dict = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                got = np.frombuffer(counts, dtype=np.uint32).astype(np.int64)
                sums[block] = sums[block] + got if block in sums else got
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
            ["block", "counts"])

    parts = (first.where("block is not null").select("block", "counts").repartition("block")
             .mapInArrow(run, "block int, counts binary").toPandas())
    total = np.zeros(ORDER_BUCKETS, dtype=np.int64)
    for block, counts in zip(parts["block"], parts["counts"]):
        total[block * BLOCK:(block + 1) * BLOCK] += np.frombuffer(counts, dtype=np.int64)
    rank = np.empty(ORDER_BUCKETS, dtype=np.uint32)
    rank[np.argsort(total, kind="stable")] = np.arange(ORDER_BUCKETS, dtype=np.uint32)
    return rank


def _prefix_pass(docs: DataFrame, k: int, limit: Threshold, order) -> DataFrame:
    """Per task and class: rare-first prefix, and the parity of the shingles per hash range."""
    def run(batches):
        rank, seen = order.value, set()
        for batch in batches:
            sigs, ns, prefixes, parities = [], [], [], []
            for _, s in shingle_sets(batch.column(0), k):
                if not len(s):
                    continue
                sig = _digest(s)
                if sig in seen:
                    continue
                if len(seen) < 200_000:
                    seen.add(sig)
                n = len(s)
                key = rank[_bucket(s)].astype(np.uint64) << np.uint64(40) | (s & np.uint64((1 << 40) - 1))
                m = limit.probe(n)
                best = np.argpartition(key, m - 1)[:m] if m < n else np.arange(n)
                best = best[np.lexsort((s[best], key[best]))]
                sigs.append(sig)
                ns.append(n)
                prefixes.append(s[best].view(np.int64))
                odd = np.bincount((s & np.uint64(PARITY - 1)).astype(np.int64), minlength=PARITY) & 1
                parities.append(np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64))
            if sigs:
                ends = np.cumsum([0, *map(len, prefixes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sigs, pa.binary()), pa.array(ns, pa.int32()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(prefixes))),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(sigs) + 1, dtype=np.int32) * (PARITY // 64)),
                                              pa.array(np.concatenate(parities)))],
                    ["sig", "n", "prefix", "parity"])
    return docs.mapInArrow(run, "sig binary, n int, prefix array<long>, parity array<long>")


def _postings(prefixes: DataFrame, thin) -> DataFrame:
    """(rep, n, pos, gram) of the prefix shingles that ``thin`` lets through."""
    def run(batches):
        for batch in batches:
            lists = batch.column(2)
            grams = lists.flatten().to_numpy()
            sizes = np.diff(lists.offsets.to_numpy())
            keep = in_bitmap(thin.value, grams)
            pos = np.arange(len(grams)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            row = pa.array(np.repeat(np.arange(len(sizes)), sizes)[keep])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), batch.column(1).take(row),
                 pa.array(pos[keep].astype(np.int32)), pa.array(grams[keep])], ["rep", "n", "pos", "gram"])
    return prefixes.mapInArrow(run, "rep long, n int, pos int, gram long")


def _set_pass(docs: DataFrame, k: int, wanted) -> DataFrame:
    """Whole shingle sets of the texts whose hash ``wanted`` (a bitmap) lets through."""
    def run(batches):
        table, seen = wanted.value, set()
        for batch in batches:
            sigs, sets = [], []
            maybe = np.flatnonzero(in_bitmap(table, batch.column(1).to_numpy()))
            for _, s in shingle_sets(batch.column(0).take(pa.array(maybe)), k):
                if not len(s):
                    continue
                sig = _digest(s)
                if sig in seen:
                    continue
                if len(seen) < 200_000:
                    seen.add(sig)
                sigs.append(sig)
                sets.append(s.view(np.int64))
                if sum(map(len, sets[-50:])) > 1 << 20 or len(sets) >= 2000:
                    yield _sets_batch(sigs, sets)
                    sigs, sets = [], []
            if sigs:
                yield _sets_batch(sigs, sets)
    return docs.mapInArrow(run, "sig binary, shingles array<long>")


def _sets_batch(sigs, sets):
    ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(sigs, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets)))],
        ["sig", "shingles"])


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                    limit: Threshold = Threshold(80, 100)) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, classes, links) of the join.

    rows: id, sig, word (hash of the text), n for every input row (sig null for an empty set); classes:
    sig, rep (smallest id, or a stand-in from ``NULL_IDS`` on where it is null or
    another class's too), low (smallest id), n, copies;
    links: a, b (reps), the verified pairs that, with the copies, connect every
    component.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")
                         ).withColumn("word", F.xxhash64("text"))
    first = freeze(_first_pass(source, k), "shingles")
    rows = first.where("block is null").select("id", "sig", "word", "n")
    rank = _order(first)
    classes = freeze(
        rows.where("sig is not null").groupBy("sig").agg(
            F.coalesce(F.min("id"), F.expr(f"{NULL_IDS}L | (xxhash64(sig) & {NULL_IDS - 1}L)")).alias("rep"),
            F.min("id").alias("low"), F.min("word").alias("word"), F.first("n").alias("n"), F.count("*").alias("copies")), "classes")
    # Different texts under one id: only one of their classes goes by that id.
    again = freeze(classes.groupBy("rep").agg(F.min("sig").alias("first"), F.count("*").alias("m")).where("m > 1")
                   .select("rep", "first"), "repeated-reps")
    if not again.isEmpty():
        same = classes
        classes = freeze(same.join(again, "rep", "left").withColumn("rep", F.expr(
            f"if(first is null or sig = first, rep, {NULL_IDS}L | (xxhash64(sig) & {NULL_IDS - 1}L))")).drop("first"), "classes")
        forget(same)
    forget(again)

    # One row per class: prefix in the global order and parities. Broadcasts go when
    # the table that needed them is written, so they don't add up.
    order = spark.sparkContext.broadcast(rank)
    prefixes = freeze(
        _prefix_pass(source.select("text"), k, limit, order)
        .groupBy("sig").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"),
                            F.first("parity").alias("parity"))
        .join(classes.select("sig", "rep"), "sig"), "prefixes")
    order.destroy()
    # Shared shingles: counted alone first; a Bloom filter of them then thins the
    # posting lists before they move, and the exact join decides.
    shared = freeze(prefixes.select(F.explode("prefix").alias("gram")).groupBy("gram").count()
                    .where("count > 1").select("gram"), "shared")
    thin = spark.sparkContext.broadcast(bitmap(shared, "gram"))
    postings = freeze(_postings(prefixes.select("rep", "n", "prefix"), thin).join(shared, "gram", "left_semi"), "postings")
    thin.destroy()
    heads = (postings.groupBy("gram")
             .agg(F.min(F.struct(F.expr("1D * pos / n").alias("place"), "n", "rep")).alias("h"))
             .select("gram", F.col("h.rep").alias("hub"), F.col("h.n").alias("hub_n")))
    lists = freeze(postings.join(heads, "gram"), "lists")
    forget(shared, postings)

    fits = lambda x, y: F.expr(f"{limit.den}L * least({x}, {y}) >= {limit.num}L * greatest({x}, {y})")
    tally = (lists.where("rep <> hub").where(fits("n", "hub_n")).groupBy("rep", "hub").agg(F.count("*").alias("c")))
    stars = (tally.groupBy("rep").agg(F.max(F.struct("c", "hub")).alias("t"))
             .select(F.col("rep").alias("a"), F.col("t.hub").alias("b")))
    near = _verify(stars, source, classes, prefixes, k, limit)
    groups = connected_components(near)

    # Across components: minor rows (not in the list head's component) against all.
    comp = groups.select(F.col("node").alias("rep"), F.col("component").alias("comp"))
    hub_comp = groups.select(F.col("node").alias("hub"), F.col("component").alias("hc"))
    tagged = (lists.join(comp, "rep", "left").join(hub_comp, "hub", "left")
              .select("gram", "rep", "n", "pos", F.coalesce("comp", "rep").alias("comp"),
                      F.coalesce("hc", "hub").alias("hc")))
    tagged = freeze(tagged, "tagged")
    minor = tagged.where("comp <> hc").select("gram", F.col("rep").alias("a"), F.col("n").alias("an"),
                                              F.col("pos").alias("ap"), F.col("comp").alias("ac"))
    mixed = minor.select("gram").distinct()
    other = tagged.join(mixed, "gram", "left_semi").select(
        "gram", F.col("rep").alias("b"), F.col("n").alias("bn"), F.col("pos").alias("bp"), F.col("comp").alias("bc"))
    need = f"cast(ceil({limit.num}L * (an + bn) / {limit.num + limit.den}D - 1e-9) as int)"
    cross = (minor.join(other, "gram").where(
        (F.col("ac") != F.col("bc")) & fits("an", "bn")
        # positional filter: this shingle, what precedes it in both, what may follow
        & F.expr(f"least(ap, bp) + least(an - ap, bn - bp) >= {need}")
        # the shorter side matches inside its index prefix
        & F.expr(f"if(an <= bn, ap <= an - ceil({2 * limit.num}L * an / {limit.num + limit.den}D - 1e-9), "
                 f"bp <= bn - ceil({2 * limit.num}L * bn / {limit.num + limit.den}D - 1e-9))"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    far = _verify(cross, source, classes, prefixes, k, limit)
    links = freeze(near.unionByName(far), "links")
    forget(prefixes, lists, tagged, near, far)
    return rows, classes, links


def _verify(pairs: DataFrame, source: DataFrame, classes: DataFrame, prefixes: DataFrame, k: int,
            limit: Threshold) -> DataFrame:
    """The pairs (a, b) of reps that reach the threshold on their whole sets."""
    spark = source.sparkSession
    hist = prefixes.select("rep", "n", "parity")
    need = f"ceil({limit.num}L * (an + bn) / {limit.num + limit.den}D - 1e-9)"
    pairs = freeze(
        pairs.join(hist.select(F.col("rep").alias("a"), F.col("n").alias("an"), F.col("parity").alias("ar")), "a")
        .join(hist.select(F.col("rep").alias("b"), F.col("n").alias("bn"), F.col("parity").alias("br")), "b")
        .where(F.expr("aggregate(zip_with(ar, br, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x) <= an + bn - 2 * " + need))
        .select("a", "b", "an", "bn"), "pairs")
    ends = pairs.select(F.col("a").alias("rep")).unionAll(pairs.select(F.col("b").alias("rep"))).distinct()
    wanted = classes.join(ends, "rep", "left_semi").select("sig", "word", "rep")
    wanted = freeze(wanted, "wanted")
    table = spark.sparkContext.broadcast(bitmap(wanted, "word"))
    sets = freeze(
        _set_pass(source.select("text", "word"), k, table)
        .groupBy("sig").agg(F.first("shingles").alias("shingles"))
        .join(wanted.select("sig", "rep"), "sig").select("rep", "shingles"), "sets")
    table.destroy()
    found = freeze(
        pairs.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa")), "a")
        .join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb")), "b")
        .where(F.expr(f"{limit.num + limit.den}L * size(array_intersect(sa, sb)) >= {limit.num}L * (an + bn)"))
        .select("a", "b"), "found")
    forget(pairs, wanted, sets)
    return found


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                 limit: Threshold = Threshold(80, 100)) -> DataFrame:
    """(id_col, n_shingles, component_id) for every input row; see the module."""
    rows, classes, links = jaccard_classes(docs, id_col, text_col, k, limit)
    labels = _components(classes, links)
    return (rows.join(labels.select("sig", "lowest"), "sig", "left")
            .select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("sig").isNull(), F.col("id")).otherwise(F.col("lowest")).alias("component_id")))


def _components(classes: DataFrame, links: DataFrame) -> DataFrame:
    """(sig, component, lowest): each class's component and the smallest id in it (null if it has none)."""
    comps = connected_components(links).select(F.col("node").alias("rep"), "component")
    linked = classes.select("rep", "low").join(comps, "rep").groupBy("component").agg(F.min("low").alias("lowest"))
    return (classes.select("sig", "rep", "low").join(comps, "rep", "left").join(linked, "component", "left")
            .select("sig", F.coalesce("component", "rep").alias("component"),
                    F.when(F.col("component").isNull(), F.col("low")).otherwise(F.col("lowest")).alias("lowest")))


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                  limit: Threshold = Threshold(80, 100)) -> DataFrame:
    """The rows of ``docs``, all columns, with one row of each group of linked
    texts kept: one with the smallest id (a null id only where no row of the
    group has one). Ids may repeat or be null: rows are told apart by id and text,
    and texts that aren't linked both stay, whatever their ids. Documents without
    words form no group and stay."""
    rows, classes, links = jaccard_classes(docs, id_col, text_col, k, limit)
    best = (rows.where("sig is not null").join(_components(classes, links), "sig")
            .groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "word")).alias("best"))
            .select("best.id", "best.word", F.lit(True).alias("one")))
    free = rows.where("sig is null").select("id", "word").distinct().withColumn("one", F.lit(False))
    word, place, keys, own = _fresh(docs.columns, 4)
    stay = best.unionByName(free).select(F.struct(F.col("id"), F.col("word"), F.col("one")).alias(keys))
    marked = docs.withColumn(word, F.xxhash64(F.col(text_col).cast("string")))
    found = (marked.join(stay, F.col(id_col).cast("long").eqNullSafe(F.col(f"{keys}.id")) & (F.col(word) == F.col(f"{keys}.word")))
             .withColumn(own, F.when(F.col(f"{keys}.one"), F.lit(-1)).otherwise(F.monotonically_increasing_id())))
    # of repeated rows of the kept one, one stays; a task passes on one row of each.
    # Rows without words are each their own.
    first = Window.partitionBy(f"{keys}.id", word, own).orderBy(F.xxhash64(*[F.col(c) for c in docs.columns]))
    return found.withColumn(place, F.row_number().over(first)).where(F.col(place) == 1).select(*docs.columns)


def _fresh(taken, n: int) -> list[str]:
    """``n`` column names that the input doesn't have."""
    names = (f"_near_{i}" for i in range(len(taken) + n))
    return [x for x in names if x not in taken][:n]


def op4_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    """4-word shingles, 85 of 100, over all documents."""
    from sitegauge.llm.tables import read
    return jaccard_join(read(spark, sf_dir, "documents"), k=4, limit=Threshold(85, 100))
