"""Jaccard metric-space join.

One minus the Jaccard similarity is a metric, and so is the number of shingles in which two sets differ; sets
that reach the similarity are near in both. The join divides the space until only near documents are left together.

1. *Shells.* The first pivot is the empty set: a set's difference from it is its size. Shells of sizes are the
   regions; by the triangle inequality a pair can cross from one shell to the next only within a window below the
   border, and the documents of that window are replicated into the shell before.
2. *Cells of restricted metrics.* In a shell, sets that reach the similarity differ in at most ``delta`` shingles. The
   shingles are dealt by hash into ``delta + 3`` classes; each class gives a metric of its own (the difference within the
   class). At least three of these distances are 0, so the pair meets in the cell of one and the same class content.
   Documents with three or more empty classes also enter the cells of these, so no pair depends on an empty one.
   (Pivots chosen among the documents cannot make the first cut: nearly all documents are at distance 1 from nearly
   all others, so every window would hold every document. README has the figures.)
3. *Pivots.* Every document of a shared cell is compared with the least document of its cells, its Voronoi pivot. Those that
   link with one pivot are connected; pairs within one component need no further look.
4. *Hubs.* In the cells that still have several components, every document is compared with up to :data:`HUBS` others there
   that sizes and parity sketches allow; cells with common documents choose the same ones, so it is no more in all cells
   together. That grows with the documents, not with their square, and joins most of a
   large group of near copies, whose pairs the next steps would meet one by one; up to :data:`HUB_ROUNDS` times.
   Of these links, each document keeps one, and its hubs are linked once for all documents that they share.
5. *Recursion.* A cell where more than :data:`LEAF` squared pairs are left, of a document outside the largest component and any
   other, gets a pivot of its own and is divided by the exact distance from it into rings twice as wide as the
   allowed distance; the triangle inequality says which documents of the next ring's border are replicated. A ring is
   divided further if it is much smaller than its cell, up to :data:`ROUNDS` times; where the distances from a pivot are
   all alike, another one would not tell more.
6. *Leaves.* In the cells that are left, the documents outside the largest component are paired with those of other
   components, and compared if their sizes and their parity sketches (a lower bound of the difference; folded ones
   first, a lower bound of that) allow the similarity. A cell that could not be divided is a leaf of any size, so the
   result is exact for every input.

Links are confirmed on the full sets of 64-bit shingle hashes. Equal sets are one node, so copies are never paired.

Defined cases: null and empty texts and texts without words have no shingles, link with nothing and are their own
component; texts with fewer words than a shingle are one shingle; very long texts are taken whole; rows that repeat an id are
judged one by one, the component's name is the least id of its rows (null ids are larger than any id; without an id among
its rows it is null); an empty table gives no rows. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.llm.common import connected_components, fan_out, packed, salt_of, salted_least, small_batches, stored, table
from panelcast.llm.near_dedup import Shingles, parity_sketch

SHINGLE, SIMILARITY = 3, 90
SHELL = 125                          # a shell's largest size, per cent of its least
SPARE = 3                            # classes beyond the differences that a pair may have
HUBS, HUB_ROUNDS = 8, 3              # rows of a cell that others there are compared with, and of all cells one row; rounds at most
LEAF = 256                           # a cell with no more than LEAF * LEAF open pairs is not divided further
ROUNDS = 3
SMALLER = 0.6                        # a ring is divided if it has at most this share of its cell's rows
SKETCH_WORDS = 32                    # as parity_sketch makes them
PAIR_ROWS = 8                        # narrow rows that a pair with its sets weighs
FOLDS = 4                            # words that a sketch is folded into


# ---- cells ------------------------------------------------------------------------------------

class Shells:
    """Sizes to shells, as far as they are asked for."""

    def __init__(self, similarity: int) -> None:
        self.similarity, self.tops = similarity, [1]

    def of(self, size: int) -> list[tuple[int, int]]:
        """``(shell, classes)`` of a set's own shell and, in the window, of the shell below."""
        t = self.similarity
        while self.tops[-1] < size:
            low = self.tops[-1] + 1
            self.tops.append(max(low, low * max(SHELL, -(-10000 // t)) // 100))
        shell = bisect_left(self.tops, size)
        found = [shell]
        if shell and t * size <= 100 * self.tops[shell - 1]:
            found.append(shell - 1)
        deltas = ((s, self.tops[s] * (100 - t) // t) for s in found)
        return [(s, delta + SPARE) for s, delta in deltas if delta]      # without a difference, only equal sets link


def _mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def cells_of(shingles: np.ndarray, shells: Shells) -> np.ndarray:
    """The cells (64-bit names) that a set of shingle hashes enters."""
    out = []
    mixed = _mix(shingles ^ np.uint64(0xA0761D6478BD642F))
    for shell, classes in shells.of(len(shingles)):
        of = (_mix(shingles + np.uint64(shell * 0x9E3779B97F4A7C15 % (1 << 64))) % np.uint64(classes)).astype(np.int64)
        order = np.argsort(of, kind="stable")
        there = of[order]
        starts = np.flatnonzero(np.append(True, there[1:] != there[:-1]))
        content, held = np.add.reduceat(mixed[order], starts), there[starts]
        if classes - len(held) >= SPARE:
            empty = np.setdiff1d(np.arange(classes), held, assume_unique=True)
            content, held = np.append(content, np.zeros(len(empty), np.uint64)), np.append(held, empty)
        out.append(_mix(content ^ _mix(held.astype(np.uint64) + np.uint64(shell << 32))))
    return np.concatenate(out).view(np.int64) if out else np.empty(0, np.int64)


def signatures(docs: DataFrame, shingle: int, similarity: int, text: str, key: str) -> DataFrame:
    """``row`` (a number of its own), ``id, place`` (hash of the text), ``n, node`` (digest of the set), ``cells``."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, shells = Shingles(shingle), Shells(similarity)
        for batch in batches:
            sizes, nodes, cells = [], [], []
            for t in batch.column(2):
                found = shingles.of(t.as_py())
                sizes.append(len(found))
                nodes.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                cells.append(cells_of(found, shells))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()),
                 pa.ListArray.from_arrays(np.cumsum([0, *map(len, cells)]).astype(np.int32),
                                          np.concatenate([np.empty(0, np.int64), *cells]))],
                ["id", "place", "n", "node", "cells"])

    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    rows = rows.select("id", F.xxhash64("text").alias("place"), "text")
    schema = T.StructType([rows.schema["id"]]).add("place", "long").add("n", "long").add("node", "binary")
    found = rows.mapInArrow(run, schema.add("cells", T.ArrayType(T.LongType())))
    return stored(found.withColumn("row", F.monotonically_increasing_id()), "metric-signatures")


def distinct_sets(signed: DataFrame) -> DataFrame:
    """One row for each set: ``nid`` (its number), ``node, n, id`` (the least), ``place`` (of a text with that id), ``cells``."""
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "place"))
    nodes = (signed.where("n > 0").groupBy("node")
             .agg(first.alias("first"), F.first("n").alias("n"), F.first("cells").alias("cells")))
    nodes = nodes.select(F.monotonically_increasing_id().alias("nid"), "node", "n", "first.id", "first.place", "cells")
    return stored(nodes, "metric-nodes")


def shared_cells(nodes: DataFrame) -> DataFrame:
    """``cell, nid, n`` of the cells with more than one node, and ``pivot``, the least one there."""
    rows = nodes.select("nid", "n", F.explode("cells").alias("cell"))
    crowded = (rows.groupBy("cell").agg(F.count(F.lit(1)).alias("size"), F.min("nid").alias("pivot"))
               .where("size > 1").drop("size"))
    return stored(rows.join(crowded, "cell").select("cell", "nid", "n", "pivot"), "metric-cells")


# ---- comparison -------------------------------------------------------------------------------

def sets_of(docs: DataFrame, wanted: DataFrame, shingle: int, text: str, key: str) -> DataFrame:
    """Stored ``nid, shingles, sketch`` of the wanted nodes (``nid, node, id, place``)."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").alias("doc"), F.col(f"`{text}`").alias("text"))
    rows = rows.withColumn("at", F.xxhash64("text"))
    rows = rows.join(wanted, (rows["at"] == wanted["place"]) & rows["doc"].eqNullSafe(wanted["id"])).select("nid", "node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(shingle)
        for batch in batches:
            found = [shingles.of(t.as_py()) for t in batch.column(2)]
            sets = [s.tobytes() for s in found]
            right = [hashlib.blake2b(s, digest_size=16).digest() == n for s, n in zip(sets, batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.binary()),
                 pa.array([parity_sketch(s) for s in found], pa.list_(pa.int64()))],
                ["nid", "shingles", "sketch"]).filter(pa.array(right, pa.bool_()))

    found = rows.mapInArrow(run, "nid long, shingles binary, sketch array<long>").dropDuplicates(["nid"])
    return stored(found, "metric-sets")


def compared(pairs: DataFrame, sets: DataFrame, rows: int) -> DataFrame:
    """``a, b, common, total`` (sizes of intersection and union) of distinct pairs of nodes; ``rows`` says how much there is
    to do, about."""
    small_batches(pairs.sparkSession)
    joined = (packed(pairs.select("a", "b"), rows).distinct()
              .join(sets.select(F.col("nid").alias("a"), F.col("shingles").alias("sa")), "a")
              .join(sets.select(F.col("nid").alias("b"), F.col("shingles").alias("sb")), "b").select("a", "b", "sa", "sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common, total = [], []
            for sa, sb in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (sa, sb))
                common.append(len(np.intersect1d(x, y, assume_unique=True)))
                total.append(len(x) + len(y) - common[-1])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(common, pa.int64()),
                                              pa.array(total, pa.int64())], ["a", "b", "common", "total"])

    return stored(packed(joined, rows).mapInArrow(run, "a long, b long, common long, total long"), "metric-pairs")


def _linked(similarity: int) -> Column:
    return F.col("common") * 100 >= F.col("total") * similarity


def _sizes_allow(similarity: int) -> Column:
    return F.least("na", "nb") * 100 >= F.greatest("na", "nb") * similarity


def _sketches_allow(similarity: int) -> Column:
    """The sketches differ in no more bits than the sets in shingles, at most (1 - s) / (1 + s) of their sizes' sum. Folds
    differ in no more bits than the sketches, and settle most pairs by themselves."""
    allowed = (F.col("na") + F.col("nb")) * (100 - similarity)

    def differ(name: str, words: int) -> Column:
        return sum((F.bit_count(F.col(f"{name}_a")[i].bitwiseXOR(F.col(f"{name}_b")[i])) for i in range(words)), F.lit(0))

    return ((differ("fold", FOLDS) * (100 + similarity) <= allowed)
            & (differ("sketch", SKETCH_WORDS) * (100 + similarity) <= allowed))


def folded(sketch: Column) -> Column:
    """FOLDS words, each the exclusive or of every FOLDS-th of the sketch: equal bits cancel, so no difference is added."""
    return F.array(*(reduce(Column.bitwiseXOR, [sketch[i] for i in range(f, SKETCH_WORDS, FOLDS)]) for f in range(FOLDS)))


# ---- recursion --------------------------------------------------------------------------------

def unresolved(cells: DataFrame, roots: DataFrame) -> DataFrame:
    """``cell, nid, n, root`` and what else there is, of the cells with several components, with the cell's number of rows
    (``size``), its ``largest`` component, and the number of rows outside it (``few``)."""
    rows = cells.join(roots.withColumnRenamed("node", "nid"), "nid", "left")
    rows = rows.withColumn("root", F.coalesce("root", "nid"))
    sizes = rows.groupBy("cell", "root").agg(F.count(F.lit(1)).alias("size"))
    several = (sizes.groupBy("cell").agg(F.sum("size").alias("size"), F.max(F.struct("size", "root")).alias("top"),
                                         F.count(F.lit(1)).alias("roots")).where("roots > 1")
               .select("cell", "size", F.col("top.root").alias("largest"), (F.col("size") - F.col("top.size")).alias("few")))
    return rows.join(several, "cell")


def hub_pairs(rows: DataFrame, sets: DataFrame, similarity: int, level: int) -> DataFrame:
    """Pairs of a cell's rows and its hubs, rows chosen by hash, that are in different components and may reach the similarity.
    The hash is the same in all cells, so cells with common rows have common hubs; a row in many cells keeps the
    first :data:`HUBS` of all that it meets there."""
    least = F.struct(F.xxhash64("nid", F.lit(level)).alias("by"), "nid")
    places = Window.partitionBy("cell").orderBy(least)
    hubs = rows.select("cell", "nid").withColumn("at", F.row_number().over(places)).where(F.col("at") <= HUBS).select("cell", "nid")
    rows = rows.select("cell", "nid", "n", "root")
    pairs = _paired(hubs.join(rows, ["cell", "nid"]), rows, sets, F.col("a") != F.col("b"), similarity)
    first = Window.partitionBy("b").orderBy(F.xxhash64("a", F.lit(level)), "a")
    return pairs.withColumn("at", F.dense_rank().over(first)).where(F.col("at") <= HUBS).select("a", "b")


def contracted(links: DataFrame) -> DataFrame:
    """Links with the same components: of every ``b`` the one with its least ``a``, and each pair of such an ``a`` and another of
    the same ``b`` once. Rows share their hubs, so there are about as many as rows."""
    of = links.groupBy("b").agg(F.min("a").alias("a"), F.collect_set("a").alias("others"))
    between = of.select("a", F.explode("others").alias("b")).where("a != b").distinct()
    return of.select("a", "b").unionByName(between)


def _paired(left: DataFrame, right: DataFrame, sets: DataFrame, which: Column, similarity: int) -> DataFrame:
    """``a, b`` of one cell: which of the left and right rows (``cell, nid, n, root``) may reach the similarity."""
    sketches = sets.select("nid", "sketch", folded(F.col("sketch")).alias("fold"))
    sides = (rows.join(sketches, "nid").select("cell", F.col("nid").alias(s), *(F.col(c).alias(f"{c}{u}{s}") for c, u in (
        ("n", ""), ("root", "_"), ("sketch", "_"), ("fold", "_"))), *(c for c in ("largest",) if c in rows.columns and s == "b"))
        for s, rows in (("a", left), ("b", right)))
    a, b = sides
    return a.join(b, "cell").where(which & F.expr("root_a != root_b") & _sizes_allow(similarity)
                                   & _sketches_allow(similarity)).select("a", "b")


def rings(rows: DataFrame, distances: DataFrame, similarity: int, level: int) -> DataFrame:
    """The rows of each cell dealt into rings around its pivot: ``cell, nid, n, parent`` (the divided cell's size). A ring is twice as wide as the allowed
    distance; what lies above it by no more than that distance is in it, too."""
    far = 100 - similarity
    near = distances.select(F.col("a").alias("pivot"), F.col("b").alias("nid"), "common", "total")
    rows = rows.join(near, ["pivot", "nid"], "left")
    own = F.col("nid") == F.col("pivot")
    apart = F.when(own, 0).otherwise(100 * (F.col("total") - F.col("common")))
    total = F.when(own, 1).otherwise(F.col("total"))
    ring = F.floor(apart / (2 * far * total)).cast("long")
    # The quotient is a double: the exact comparison settles a place on the border.
    ring = F.when(apart < ring * 2 * far * total, ring - 1).when(apart >= (ring + 1) * 2 * far * total, ring + 1).otherwise(ring)
    rows = rows.select("cell", "nid", "n", "size", apart.alias("apart"), total.alias("total"), ring.alias("ring"))
    border = (F.col("ring") > 0) & (F.col("apart") <= far * F.col("total") * (2 * F.col("ring") + 1))
    homes = F.when(border, F.array("ring", F.col("ring") - 1)).otherwise(F.array("ring"))
    rows = rows.select("cell", "nid", "n", "size", F.explode(homes).alias("ring"))
    return rows.select(F.xxhash64("cell", F.lit(level), "ring").alias("cell"), "nid", "n", F.col("size").alias("parent"))


def leaf_pairs(rows: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Pairs of different components in one cell that may reach the similarity, one of them outside the largest."""
    every = rows.select("cell", "nid", "n", "root", "largest")
    return _paired(every.where("root != largest").drop("largest"), every, sets, F.expr("root_b = largest OR a < b"), similarity)


def components(docs: DataFrame, nodes: DataFrame, shingle: int, similarity: int, text: str, key: str) -> DataFrame:
    """``node, root`` (numbers) of all nodes with a link."""
    cells = shared_cells(nodes)
    wanted = cells.select("nid").distinct().join(nodes.select("nid", "node", "id", "place"), "nid")
    sets = sets_of(docs, wanted, shingle, text, key)
    sizes = nodes.select(F.col("nid").alias("pivot"), F.col("n").alias("np"))
    first = (cells.where("nid != pivot").groupBy("nid", "n").agg(F.min("pivot").alias("pivot")).join(sizes, "pivot")
             .select(F.col("pivot").alias("a"), F.col("nid").alias("b"), F.col("np").alias("na"), F.col("n").alias("nb")))
    n_cells = cells.count()
    wide = PAIR_ROWS * n_cells                           # pairs carry sets, so they weigh more than narrow rows
    links = compared(first.where(_sizes_allow(similarity)), sets, wide).where(_linked(similarity)).select("a", "b")
    roots = links.select(F.col("b").alias("node"), F.col("a").alias("root"))     # one pivot each: a part of the components
    rows = stored(packed(unresolved(cells.select("cell", "nid", "n"), roots), n_cells), "metric-unresolved")
    for level in range(HUB_ROUNDS):
        crowded = rows.where(F.col("few") * F.col("size") > LEAF * HUBS)         # others are leaves as they are
        if crowded.isEmpty():
            break
        linked = compared(hub_pairs(crowded, sets, similarity, level), sets, wide).where(_linked(similarity)).select("a", "b")
        if linked.isEmpty():
            break
        roots = stored(connected_components(links.unionByName(contracted(linked))), "metric-roots")
        links = roots.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))   # stand in for the links
        rows = stored(packed(unresolved(rows.select("cell", "nid", "n"), roots), n_cells), "metric-unresolved")
    rows, leaves = rows.withColumn("parent", F.lit(None).cast("long")), None
    for level in range(ROUNDS):
        divide = ((F.col("few") * F.col("size") > LEAF * LEAF)
                  & (F.col("parent").isNull() | (F.col("size") <= SMALLER * F.col("parent"))))
        large, rest = rows.where(divide).drop("parent"), rows.where(~divide).select("cell", "nid", "n")
        leaves = rest if leaves is None else leaves.unionByName(rest)
        if large.isEmpty():
            break
        pivots = (large.groupBy("cell").agg(F.min(F.struct(F.xxhash64("nid", F.lit(level)), "nid")).alias("by"))
                  .select("cell", F.col("by.nid").alias("pivot")))
        large = stored(packed(large.join(pivots, "cell"), n_cells), "metric-large")
        distances = compared(large.where("nid != pivot").select(F.col("pivot").alias("a"), F.col("nid").alias("b")), sets, wide)
        linked = distances.where(_linked(similarity)).select("a", "b")
        links = links.unionByName(linked)
        # A linked row takes the root of its pivot: rows of one root are connected, which is all that the next step asks.
        up = linked.join(roots.withColumnRenamed("node", "a"), "a", "left").select(F.col("b").alias("node"), F.coalesce("root", "a").alias("root"))
        roots = stored(roots.unionByName(up).groupBy("node").agg(F.min("root").alias("root")), "metric-roots")
        rows = stored(packed(unresolved(rings(large, distances, similarity, level), roots), 2 * n_cells), "metric-unresolved")
    else:
        leaves = leaves.unionByName(rows.select("cell", "nid", "n"))
    more = compared(leaf_pairs(unresolved(leaves, roots), sets, similarity), sets, wide)
    links = links.unionByName(more.where(_linked(similarity)).select("a", "b"))
    return stored(connected_components(links), "metric-roots")


def jaccard_join(docs: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY, text: str = "text",
                 key: str = "doc_id") -> DataFrame:
    """``key, n_shingles, component_id`` of every row."""
    salts = fan_out(docs.sparkSession)
    signed = signatures(docs, shingle, similarity, text, key).withColumn("salt", salt_of(salts, F.col("row")))
    nodes = distinct_sets(signed)
    roots = components(docs, nodes, shingle, similarity, text, key)
    names = nodes.select(F.col("nid").alias("node"), "id", F.col("node").alias("set"))
    named = roots.join(names, "node")
    least = named.groupBy("root").agg(F.min("id").alias("component"))
    of_set = named.join(least, "root").select(F.col("set").alias("node"), "component", F.lit(True).alias("joined"))
    spread = salted_least(signed.where("n > 0"), ["node"], "id").join(of_set, "node", "left")
    spread = spread.select("node", "salt", F.when(F.col("joined"), F.col("component")).otherwise(F.col("least")).alias("component"))
    out = signed.select("id", "n", "node", "salt").join(spread, ["node", "salt"], "left")
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest([array_to_string(list_slice(w, i, i + least(3, len(w)) - 1), ' ')
                                      FOR i IN range(1, greatest(len(w) - 2, 1) + 1)]) AS g FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 90 * (nx.n + ny.n - c)),
both_ways AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, b.y FROM reach JOIN both_ways b ON reach.y = b.x),
c AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM c LEFT JOIN n USING (doc_id)
"""
