"""Line dedup by a segment-partition edit join.

Lines (trimmed; blank ones are never duplicates) are first made distinct by digest. Two distinct
lines are *near* if both have at least :data:`MIN_CHARS` characters and at most ``edits`` insertions,
deletions and substitutions lie between them.

* A line of n characters is cut into ``edits + 1`` even segments: one of them must survive ``edits``
  changes in any near line. Segments are indexed under (n, segment number, content).
* A line looks up, for each length n - edits .. n, the substrings that can be that segment of a near
  line: position and length differences bound where they start (multi-match-aware selection).
* A 64-bit table of character counts travels with the keys; a pair whose counts differ by more than
  ``2 * edits`` cannot be near and is dropped inside the join, before it becomes a row.
* The remaining pairs are confirmed with bit-parallel edit distance in a band of ``edits`` diagonals,
  after their common ends are trimmed.

A line is *kept* where it first occurs (least document, then line number), unless it is near a
distinct line that first occurs earlier. All links between distinct lines are counted.

Defined cases: null and empty texts have no lines; rows equal in id and text are one document; ties
in the first place cannot occur but for such rows; null ids come after all others. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os.path
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.llm.common import small_batches, stored, table

EDITS = 2
MIN_CHARS = 20
FILTER_BITS = 1 << 26         # bits of the filter that workers get: 8 MB
COUNTED_LINES = 256             # lines whose characters are counted at a time


def segments(n: int, edits: int) -> list[tuple[int, int]]:
    """(start, length) of the even segments of a line of ``n`` characters."""
    parts = edits + 1
    base, longer = divmod(n, parts)
    out, at = [], 0
    for i in range(parts):
        size = base + (i >= parts - longer)
        out.append((at, size))
        at += size
    return out


def probes(n: int, edits: int) -> Iterator[tuple[int, int, int, int]]:
    """(indexed length, segment number, start, size) of the substrings a line of ``n`` looks up."""
    for length in range(n - edits, n + 1):
        delta = n - length
        for i, (start, size) in enumerate(segments(length, edits)):
            # Selected from the left: i edits before it at most; from the right: edits - i after it.
            low = max(0, start - i, start + delta - (edits - i))
            high = min(n - size, start + i, start + delta + (edits - i))
            for at in range(low, high + 1):
                yield length, i, at, size


def bounded_distance(a: str, b: str, most: int) -> int | None:
    """Edit distance if it is at most ``most``, by bit-parallel states in a band of diagonals.

    Bit k of ``states[d]`` says that the first ``j - most + k`` characters of ``a`` become the first
    ``j`` of ``b`` with at most ``d`` edits. A step to ``j + 1`` slides the band, so a match or a
    substitution keeps its bit, an insertion comes from the bit above and a deletion from the one below.
    """
    if abs(len(a) - len(b)) > most:
        return None
    head = len(os.path.commonprefix((a, b)))
    a, b = a[head:], b[head:]
    tail = len(os.path.commonprefix((a[::-1], b[::-1])))
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    width = 2 * most + 1
    band = (1 << width) - 1
    states = [((1 << (d + 1)) - 1) << most for d in range(most + 1)]
    for j, ch in enumerate(b):
        match = 0
        for k in range(width):
            row = j - most + k
            if 0 <= row < len(a) and a[row] == ch:
                match |= 1 << k
        # Rows that exist after this step: 0 .. len(a).
        low = max(0, most - j - 1)
        high = min(width, len(a) - j + most)
        valid = ((1 << max(high, 0)) - 1) >> low << low & band
        stepped, below_old, below_new = [], 0, 0
        for state in states:
            new = (state & match | below_old | below_old >> 1 | below_new << 1) & valid
            stepped.append(new)
            below_old, below_new = state, new
        states = stepped
        if not states[-1]:
            return None
    last = 1 << (len(a) - len(b) + most)
    return next((d for d, state in enumerate(states) if state & last), None)


def char_counts(lines: list[str]) -> list[int]:
    """Per line sixteen character counts mod 16, in nibbles; one edit changes at most two of them by one."""
    out: list[int] = []
    for start in range(0, len(lines), COUNTED_LINES):
        some = lines[start:start + COUNTED_LINES]
        codes = np.frombuffer("".join(some).encode("utf-32-le"), np.uint32)
        bins = ((codes * np.uint32(2654435761)) >> np.uint32(28)).astype(np.int64)
        bins += np.repeat(np.arange(len(some)) * 16, [len(line) for line in some])
        counts = (np.bincount(bins, minlength=16 * len(some)).reshape(-1, 16) & 15).astype(np.uint64)
        out += (counts << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(axis=1, dtype=np.uint64).view(np.int64).tolist()
    return out


def lines_of(text: str | None) -> list[str]:
    """Trimmed lines, blank ones as empty strings."""
    return [line.strip() for line in text.split("\n")] if text else []


def _digest(line: str) -> bytes:
    return hashlib.blake2b(line.encode(), digest_size=16).digest()


def _id(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def occurrences(docs: DataFrame, text: str, key: str) -> DataFrame:
    """``digest, doc, version, no`` of every line that is not blank (version: hash of the text)."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").alias("doc"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = rows.withColumn("version", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, digests, numbers = [], [], []
            for i, t in enumerate(batch.column(1)):
                for no, line in enumerate(lines_of(t.as_py())):
                    if line:
                        owner.append(i)
                        digests.append(_digest(line))
                        numbers.append(no)
            take = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), batch.column(0).take(take), batch.column(2).take(take),
                 pa.array(numbers, pa.int32())], ["digest", "doc", "version", "no"])

    schema = T.StructType([T.StructField("digest", T.BinaryType()), rows.schema["doc"],
                           T.StructField("version", T.LongType()), T.StructField("no", T.IntegerType())])
    return rows.mapInArrow(run, schema)


def line_keys(docs: DataFrame, edits: int, min_chars: int, text: str) -> DataFrame:
    """``digest, id, counts, keys array<long>``: a row per distinct line. The first ``edits + 1`` keys
    are those of its segments, the others those it looks up: in one column, so that both sides of the
    candidate join read the same columns and share one shuffle and one pass over the texts."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, plans = xxhash.xxh3_64_intdigest, {}
        for batch in batches:
            distinct = list({line for t in batch.column(0) for line in lines_of(t.as_py()) if len(line) >= min_chars})
            keys, digests = [], []
            for line in distinct:
                n = len(line)
                if n not in plans:
                    # Keys are seeded with the indexed length and the segment number.
                    plans[n] = ([(n << 8 | i, a, a + s) for i, (a, s) in enumerate(segments(n, edits))]
                                + [(m << 8 | i, a, a + s) for m, i, a, s in probes(n, edits)])
                keys.append([_signed(hashed(line[a:b].encode(), seed)) for seed, a, b in plans[n]])
                digests.append(_digest(line))
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), pa.array(map(_id, digests), pa.int64()),
                 pa.array(char_counts(distinct), pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                ["digest", "id", "counts", "keys"])

    lines = rows.mapInArrow(run, "digest binary, id long, counts long, keys array<long>")
    return lines.dropDuplicates(["digest"])


def candidate_pairs(lines: DataFrame, edits: int) -> DataFrame:
    """``a, b`` (line ids, a < b) of the lines that share a key and whose counts allow a link."""
    indexed = lines.select("id", "counts", F.explode(F.slice("keys", 1, edits + 1)).alias("key"))
    looked_up = F.slice("keys", F.lit(edits + 2), F.size("keys"))
    probing = lines.select(F.col("id").alias("b"), F.col("counts").alias("with"), F.explode(looked_up).alias("key"))
    difference = F.lit(0)
    for i in range(16):
        d = F.shiftright(F.col("counts"), 4 * i).bitwiseAND(15) - F.shiftright(F.col("with"), 4 * i).bitwiseAND(15)
        difference = difference + F.least(F.abs(d), 16 - F.abs(d))
    near = (indexed.join(probing, "key").where((F.col("id") != F.col("b")) & (difference <= 2 * edits)))
    return near.select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")).distinct()


def line_texts(docs: DataFrame, ids: DataFrame, min_chars: int, text: str) -> DataFrame:
    """``id, digest, line`` of the wanted lines. A bitmap of fixed size, whatever the number of ids, keeps most other
    lines in the workers; the join decides."""
    small_batches(docs.sparkSession)
    place = F.pmod(F.col("id"), F.lit(FILTER_BITS)) + 1       # Spark's bitmaps count from 1
    filled = ids.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in filled.toLocalIterator():                     # FILTER_BITS bits at most, in blocks
        part = np.frombuffer(bytes(row.bits), np.uint8)
        bits[(row.bucket - 1) * len(part):row.bucket * len(part)] = part
    few = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {}
            for t in batch.column(0):
                for line in lines_of(t.as_py()):
                    if len(line) >= min_chars and line not in rows:
                        digest = _digest(line)
                        at = _id(digest) % FILTER_BITS
                        if few.value[at >> 3] >> (at & 7) & 1:
                            rows[line] = (_id(digest), digest)
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in rows.values()], pa.int64()), pa.array([d for _, d in rows.values()], pa.binary()),
                 pa.array(list(rows), pa.string())], ["id", "digest", "line"])

    lines = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "id long, digest binary, line string")
    return lines.join(ids, "id").dropDuplicates(["digest"])


def near_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, text: str = "text") -> DataFrame:
    """``a, b, distance``: digests of all near pairs of distinct lines."""
    pairs = stored(candidate_pairs(line_keys(docs, edits, max(min_chars, edits + 1), text), edits), "line-pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = stored(line_texts(docs, ids, min_chars, text), "line-texts")
    joined = (pairs.join(texts.select(F.col("id").alias("a"), F.col("digest").alias("da"), F.col("line").alias("la")), "a")
              .join(texts.select(F.col("id").alias("b"), F.col("digest").alias("db"), F.col("line").alias("lb")), "b")
              .select("da", "db", "la", "lb"))
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [bounded_distance(x.as_py(), y.as_py(), edits) for x, y in zip(batch.column(2), batch.column(3))]
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.int32())],
                                             ["a", "b", "distance"])
            yield out.filter(pa.array([d is not None and d > 0 for d in found], pa.bool_()))

    return joined.mapInArrow(run, "a binary, b binary, distance int")


def marked_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, text: str = "text",
                 key: str = "doc_id") -> DataFrame:
    """``doc, version, no, copy, near, links, refers`` of every line that is not blank: whether it is a later
    copy, whether its text is near an earlier line's, how many distinct lines it is near, and the document of the first
    copy or of the first line that it is near, for the lines that are either."""
    places = occurrences(docs, text, key)
    place = F.struct(F.col("doc").isNull().alias("unnamed"), "doc", "version", "no")
    firsts = places.groupBy("digest").agg(F.min(place).alias("first"))
    links = stored(near_lines(docs, edits, min_chars, text), "line-links")
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    at = firsts.join(both.select(F.col("a").alias("digest")).distinct(), "digest", "left_semi")
    at = stored(at, "line-firsts")
    ends = (both.join(at.select(F.col("digest").alias("a"), F.col("first").alias("first_a")), "a")
            .join(at.select(F.col("digest").alias("b"), F.col("first").alias("first_b")), "b")
            .groupBy(F.col("a").alias("digest"))
            .agg(F.max(F.col("first_b") < F.col("first_a")).alias("near"), F.count(F.lit(1)).alias("links"),
                 F.min("first_b").alias("nearest")))
    marks = firsts.join(ends, "digest", "left")
    return (places.join(marks, "digest")
            .select("doc", "version", "no", (place != F.col("first")).alias("copy"),
                    F.coalesce("near", F.lit(False)).alias("near"), F.coalesce("links", F.lit(0)).alias("links"),
                    F.when(place != F.col("first"), F.col("first.doc")).when(F.col("near"), F.col("nearest.doc")).alias("refers")))


def line_report(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, text: str = "text",
                key: str = "doc_id") -> DataFrame:
    """Per document: ``doc_id, n_lines, n_kept, n_copies, n_near, n_links`` (lines that are not blank), and ``refers_to``, the
    ids of the documents that hold the lines which its copies and near lines repeat."""
    per_doc = (marked_lines(docs, edits, min_chars, text, key).groupBy("doc", "version")
               .agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(~F.col("copy") & ~F.col("near")).alias("n_kept"),
                    F.count_if("copy").alias("n_copies"), F.count_if(F.col("near") & ~F.col("copy")).alias("n_near"),
                    F.sum("links").alias("n_links"), F.array_sort(F.collect_set("refers")).alias("refers_to")))
    every = docs.select(F.col(f"`{key}`").alias("doc"), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("version")).distinct()
    joined = every.join(per_doc.withColumnsRenamed({"doc": "d", "version": "v"}),
                        F.col("doc").eqNullSafe(F.col("d")) & (F.col("version") == F.col("v")), "left")
    none = F.array().cast(joined.schema["refers_to"].dataType)
    return joined.select(F.col("doc").alias(key), *[F.coalesce(c, F.lit(0)).alias(c) for c in
                                                    ("n_lines", "n_kept", "n_copies", "n_near", "n_links")],
                         F.coalesce("refers_to", none).alias("refers_to"))


def line_dedup(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, text: str = "text",
               key: str = "doc_id") -> DataFrame:
    """``docs`` with only the kept lines (and the blank ones) in the text."""
    dropped = (marked_lines(docs, edits, min_chars, text, key).where("copy OR near")
               .groupBy("doc", "version").agg(F.collect_set("no").alias("dropped")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{key}`").alias("d"),
                       F.col(f"`{text}`").alias("t"), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("v"))
    rows = rows.join(dropped, F.col("d").eqNullSafe(F.col("doc")) & (F.col("v") == F.col("version")), "left")
    kept = F.array_join(F.filter(F.split("t", "\n"), lambda _, i: ~F.coalesce(F.array_contains("dropped", i), F.lit(False))), "\n")
    return rows.select("row", kept.alias("t")).select(
        *[F.col("t").alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns])


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))
