"""MinHash near-dedup with an LSH forest.

Documents are sets of distinct word shingles. Equal sets are one *node* (found by a digest of the
whole set, salted). Every node has :data:`TREES` signatures of min-hashes; a tree sorts the nodes by
signature, and nodes with a common prefix of at least :data:`DEPTH` values form a *region*.

After each step the pairs are confirmed on the full sets and joined into components.

1. *Longest-common-prefix neighbours.* In the first :data:`DEEP_TREES` trees signatures go on to
   :data:`MAX_DEPTH` values. A node is paired with the least node of the deepest region in which it
   is not itself the least: a crowded region is walked at greater depth, a thin one at less, and
   each tree gives at most one pair a node.
2. *Hubs.* In every region of every tree the nodes outside its largest component are paired with one
   node of it.
3. *Completion.* Where a region still holds more than one component, its nodes outside the largest
   one are paired with the nodes of other components, once in the first region that they share.
   A pair passes if the parity sketches of its sets differ in no more bits than two sets of
   that similarity can have unshared shingles. Every differing bit stands for at least one such
   shingle, so the test never loses a link. Nothing is sampled or capped, copies inside a component
   are never expanded, and no link between components in a common region is left out.

A pair of similarity 0.8 shares no region of 20 trees with probability (1 - 0.8^4)^20 = 3e-5, one of
0.9 with 1e-9; a component is lost only if all links that hold it together are.

Defined cases: null and empty texts and texts without words have no shingles and are components of
their own; texts with fewer words than a shingle are one shingle; rows that repeat an id are judged one by
one; null ids are larger than any id. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.llm.common import (connected_components, fan_out, packed, salt_of, salted_least, small_batches,
                                  space_words, stored, table)

SHINGLE, SIMILARITY = 5, 80          # words of a shingle; per cent of the union
TREES, DEPTH = 20, 4
DEEP_TREES, MAX_DEPTH = 3, 8
SKETCH_WORDS = 32                    # 64-bit words of a parity sketch
NODE_ROWS = 8                        # narrow rows that a node with its signatures, or a pair with its sets, weighs
MEMO_ENTRIES = 200_000
CHUNK = 1 << 20                      # shingles hashed at a time


# ---- shingle sets -----------------------------------------------------------------------------

class Shingles:
    """Texts to sorted distinct 64-bit shingle hashes."""

    def __init__(self, size: int) -> None:
        self.size, self.memo = size, {}

    def _hash(self, word: bytes) -> int:
        known = self.memo.get(word)
        if known is None:
            if len(self.memo) >= MEMO_ENTRIES:
                self.memo.clear()
            known = self.memo[word] = xxhash.xxh64_intdigest(word)
        return known

    def of(self, text: str | None) -> np.ndarray:
        words = space_words(text)
        if not words:
            return np.empty(0, np.uint64)
        h = np.fromiter(map(self._hash, words), np.uint64, len(words))
        size = min(self.size, len(h))
        n = len(h) - size + 1
        out = np.full(n, size, np.uint64)
        for i in range(size):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n])
        return np.unique(out)


def _mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _coefficients(n: int) -> np.ndarray:
    """Odd multipliers and offsets of the hash family, from its size alone."""
    return _mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)).reshape(n, 2)


def depths() -> list[int]:
    return [MAX_DEPTH if t < DEEP_TREES else DEPTH for t in range(TREES)]


def min_hashes(sets: list[np.ndarray], n: int) -> np.ndarray:
    """``n`` min-hashes (rows) of every set (columns); no set may be empty."""
    out = np.empty((n, len(sets)), np.uint64)
    coefficients = _coefficients(n)
    first = 0
    while first < len(sets):
        last, total = first, 0
        while last < len(sets) and (last == first or total + len(sets[last]) <= CHUNK):
            total += len(sets[last])
            last += 1
        values = np.concatenate(sets[first:last])
        starts = np.cumsum([0] + [len(s) for s in sets[first:last - 1]])
        for i, (a, b) in enumerate(coefficients):
            out[i, first:last] = np.minimum.reduceat((values * (a | np.uint64(1)) + b) >> np.uint64(32), starts)
        first = last
    return out


def prefixes(hashes: np.ndarray) -> list[list[np.ndarray]]:
    """For each tree, the hashed prefixes of depth DEPTH, DEPTH+1, ..."""
    out, at = [], 0
    for tree, depth in enumerate(depths()):
        key, levels = np.full(hashes.shape[1], tree + 1, np.uint64), []
        for d in range(depth):
            key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + hashes[at + d])
            if d + 1 >= DEPTH:
                levels.append(key.view(np.int64))
        out.append(levels)
        at += depth
    return out


def parity_sketch(shingles: np.ndarray) -> np.ndarray:
    """SKETCH_WORDS longs; each bit is the parity of the number of shingles that fall on it."""
    bits = np.bincount((_mix(shingles) % np.uint64(64 * SKETCH_WORDS)).astype(np.int64), minlength=64 * SKETCH_WORDS)
    return np.packbits((bits & 1).astype(np.uint8)).view(np.int64)


def signatures(docs: DataFrame, shingle: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``id, n, node`` (digest of the set), ``trees`` array<array<long>>; nulls without shingles."""
    small_batches(docs.sparkSession)
    total = sum(depths())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(shingle)
        for batch in batches:
            sets = [shingles.of(t.as_py()) for t in batch.column(1)]
            full = [i for i, s in enumerate(sets) if len(s)]
            nodes: list[bytes | None] = [None] * len(sets)
            trees: list[list | None] = [None] * len(sets)
            if full:
                levels = prefixes(min_hashes([sets[i] for i in full], total))
                for j, i in enumerate(full):
                    nodes[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                    trees[i] = [[int(level[j]) for level in tree] for tree in levels]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.binary()),
                 pa.array(trees, pa.list_(pa.list_(pa.int64())))], ["id", "n", "node", "trees"])

    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, T.StructType([rows.schema["id"]]).add("n", "long").add("node", "binary")
                           .add("trees", T.ArrayType(T.ArrayType(T.LongType()))))


# ---- candidates -------------------------------------------------------------------------------

def deep_neighbours(nodes: DataFrame) -> DataFrame:
    """Pairs of step 1: ``a, b`` (nodes), ``na, nb``."""
    rows = (nodes.select("node", "n", F.posexplode(F.slice("trees", 1, DEEP_TREES)).alias("tree", "levels")))
    levels = [f"p{d}" for d in range(DEPTH, MAX_DEPTH + 1)]
    rows = rows.select("node", "n", *[F.col("levels")[i].alias(p) for i, p in enumerate(levels)])
    me = F.struct("node", "n")
    partner = F.lit(None).cast(T.StructType([T.StructField("node", T.BinaryType()), T.StructField("n", T.LongType())]))
    for i, p in enumerate(levels):
        rows = rows.withColumn(f"least_{p}", F.min(me).over(Window.partitionBy(*levels[:i + 1])))
        least = F.col(f"least_{p}")
        partner = F.when(least["node"] != F.col("node"), least).otherwise(partner)
    rows = rows.select("node", "n", partner.alias("other")).where("other IS NOT NULL")
    return rows.select(F.col("other.node").alias("a"), F.col("node").alias("b"),
                       F.col("other.n").alias("na"), F.col("n").alias("nb"))


def regions(nodes: DataFrame) -> DataFrame:
    """``region, node, n`` of every tree's regions with more than one node."""
    rows = nodes.select("node", "n", F.explode(F.transform("trees", lambda t: t[0])).alias("region"))
    crowded = rows.groupBy("region").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("region")
    return rows.join(crowded, "region")


def _ranked(region_rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows of the regions with several components: ``region, node, n, root, largest``. A node without a
    confirmed link is its own component."""
    rows = region_rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = rows.groupBy("region", "root").agg(F.count(F.lit(1)).alias("size"))
    largest = (sizes.groupBy("region").agg(F.max(F.struct("size", "root")).alias("top"), F.count(F.lit(1)).alias("roots"))
               .where("roots > 1").select("region", F.col("top.root").alias("largest")))
    return rows.join(largest, "region")


def hub_pairs(region_rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs of step 2."""
    rows = _ranked(region_rows, roots)
    hub = (rows.where("root = largest").groupBy("region")
           .agg(F.min(F.struct(F.xxhash64("node", "region").alias("by"), "node", "n")).alias("hub")))
    return (rows.where("root != largest").join(hub, "region")
            .select(F.col("hub.node").alias("a"), F.col("node").alias("b"), F.col("hub.n").alias("na"), F.col("n").alias("nb")))


def completing_pairs(region_rows: DataFrame, roots: DataFrame, nodes: DataFrame, sets: DataFrame,
                     similarity: int) -> DataFrame:
    """Pairs of step 3."""
    rows = (_ranked(region_rows, roots).join(sets.select("node", "sketch"), "node")
            .join(nodes.select("node", F.transform("trees", lambda t: t[0]).alias("regions")), "node"))
    few = rows.where("root != largest").select("region", F.col("node").alias("a"), F.col("n").alias("na"),
                                               F.col("root").alias("root_a"), F.col("sketch").alias("sketch_a"),
                                               F.col("regions").alias("regions_a"))
    every = rows.select("region", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("root").alias("root_b"),
                        F.col("sketch").alias("sketch_b"), F.col("regions").alias("regions_b"),
                        (F.col("root") == F.col("largest")).alias("top"))
    return (few.join(every, "region")
            .where(F.expr("root_a != root_b AND (top OR a < b)") & _sizes_allow(similarity) & _sketches_allow(similarity)
                   & (F.array_intersect("regions_a", "regions_b")[0] == F.col("region")))
            .select("a", "b", "na", "nb"))


def _sketches_allow(similarity: int) -> Column:
    """Sets of the similarity differ in at most (1 - s) / (1 + s) of the sum of their sizes."""
    differ = sum((F.bit_count(F.col("sketch_a")[i].bitwiseXOR(F.col("sketch_b")[i])) for i in range(SKETCH_WORDS)), F.lit(0))
    return differ * (100 + similarity) <= (F.col("na") + F.col("nb")) * (100 - similarity)


def _sizes_allow(similarity: int) -> Column:
    return F.least("na", "nb") * 100 >= F.greatest("na", "nb") * similarity


# ---- confirmation -----------------------------------------------------------------------------

def shingle_sets(docs: DataFrame, wanted: DataFrame, shingle: int, text: str, key: str) -> DataFrame:
    """``node, shingles binary, sketch array<long>`` of the wanted nodes (``id, node``: a document that
    has the set)."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").alias("doc"), F.col(f"`{text}`").alias("text"))
    rows = rows.join(wanted, rows.doc.eqNullSafe(wanted.id)).select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(shingle)
        for batch in batches:
            found = [shingles.of(t.as_py()) for t in batch.column(1)]
            sets = [s.tobytes() for s in found]
            right = [hashlib.blake2b(s, digest_size=16).digest() == n for s, n in zip(sets, batch.column(0).to_pylist())]
            sketches = pa.array([parity_sketch(s) for s in found], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary()), sketches],
                                             ["node", "shingles", "sketch"]).filter(pa.array(right, pa.bool_()))

    return rows.mapInArrow(run, "node binary, shingles binary, sketch array<bigint>").dropDuplicates(["node"])


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: int, rows: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity; ``rows`` says how much there is to do, about."""
    small_batches(pairs.sparkSession)
    possible = packed(pairs.where(_sizes_allow(similarity)).select("a", "b"), rows).distinct()
    joined = (possible.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
              .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b").select("a", "b", "sa", "sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for sa, sb in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (sa, sb))
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * common >= similarity * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return packed(joined, rows).mapInArrow(run, "a binary, b binary")


# ---- jobs -------------------------------------------------------------------------------------

def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY,
                    text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, n_shingles, component_id, kept`` of every row (kept: the component's least id)."""
    spark = docs.sparkSession
    signed = stored(signatures(docs, shingle, text, key), "signatures")
    salts = fan_out(spark)
    full = signed.where("n > 0").withColumn("salt", salt_of(salts, F.col("id")))
    by_set = salted_least(full, ["node"], "id")
    nodes = full.groupBy("node").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("trees").alias("trees"))
    nodes = stored(packed(nodes, NODE_ROWS * signed.count()), "nodes")
    n_nodes = nodes.count()
    wide = NODE_ROWS * n_nodes

    region_rows = stored(packed(regions(nodes), TREES * n_nodes), "regions")
    wanted = region_rows.select("node").distinct().join(nodes.select("node", "id"), "node")
    sets = stored(packed(shingle_sets(docs, wanted, shingle, text, key), wide), "sets")
    links = stored(confirmed(deep_neighbours(nodes), sets, similarity, wide), "links")
    roots = stored(connected_components(links), "roots")
    for step in (2, 3):
        pairs = (hub_pairs(region_rows, roots) if step == 2
                 else completing_pairs(region_rows, roots, nodes, sets, similarity))
        more = stored(confirmed(pairs, sets, similarity, wide), "links")
        if not more.isEmpty():
            # Components stand in for the links found so far.
            links = roots.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more)
            roots = stored(connected_components(links), "roots")

    least = (roots.join(nodes.select("node", "id"), "node").groupBy("root").agg(F.min("id").alias("component")))
    of_node = roots.join(least, "root").select("node", "component")
    looked_up = by_set.join(of_node, "node", "left").select("node", "salt", F.coalesce("component", "least").alias("component"))
    out = signed.withColumn("salt", salt_of(salts, F.col("id"))).select("id", "n", "node", "salt")
    out = out.join(looked_up, ["node", "salt"], "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      component.eqNullSafe(F.col("id")).alias("kept"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (
  SELECT doc_id, unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS g FROM d WHERE len(w) > 1
  UNION ALL SELECT doc_id, w[1] FROM d WHERE len(w) = 1)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
both_ways AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, b.y FROM reach JOIN both_ways b ON reach.y = b.x),
c AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, component_id = doc_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""
