"""Substring dedup by content-defined chunks of a gear rolling hash.

A passage of ``min_words`` words is repeated if another document holds the same words in a row.

1. *Chunks*: a gear hash rolls over the words, eight at a time. A place is a cut if its hash is the least in some run
   of :func:`reach` places around it, so whether it is one depends on the words near it alone: an insertion moves the
   cuts behind it, but changes none. A chunk goes from a cut to the next, with the eight words that made the next one.
2. *Dedup by digest*: chunks that one document only holds are dropped, with map-side combining. Two documents that share
   ``min_words`` words share two cuts and so a whole chunk in them (the runs at either end of the passage have no place
   in common); nothing is missed.
3. Every window of ``min_words`` words around a chunk that is left gets a 96-bit digest of its words. Windows
   with one digest are brought together: each learns the least other document that holds it.
4. The windows of a document are laid over each other, which gives the exact maximal repeated
   stretches. Words in a window that a smaller document holds are marked for removal, the other words in
   windows are kept: every removed word stays in a smaller document.

The windows are compared with all others, not with one chosen place. The digests stand for the words: in 2e9
windows the chance of one false passage is about 1 in 4e10.

Defined cases: null and empty texts have no windows; rows without an id are left out, as nothing could name them; rows that
repeat an id and a text are one version of a document, and rows that repeat the id with another text are another version:
its own spans carry its ``version`` (a number from 0), and passages that only versions of one id share are not repeated
*across* documents; very long texts are taken whole; without repeated passages, or without rows, the result is empty. Other
columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from panelcast.llm.common import small_batches, stored, table

MIN_WORDS = 50
_ODD = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)    # multipliers of the two digest lanes
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def gram_hashes(h: np.ndarray, n: int, odd: int = _ODD[0]) -> np.ndarray:
    """Polynomial hash of every ``n`` consecutive values, mod 2^64, by doubling the span."""
    out, held, span, power = None, 0, 1, odd
    while True:
        if n & span:
            if out is None:
                out = h
            else:
                out = out[:len(out) - span] * np.uint64(power) + h[held:held + len(out) - span] if len(out) > span else out[:0]
            held += span
        if 2 * span > n:
            return out
        h = h[:-span] * np.uint64(power) + h[span:] if len(h) > span else h[:0]
        span, power = 2 * span, power * power & (1 << 64) - 1


def _slide(fold: np.ufunc, values: np.ndarray, n: int) -> np.ndarray:
    """``fold`` of every ``n`` consecutive values."""
    span = 1
    while 2 * span <= n:
        values = fold(values[:-span], values[span:])
        span *= 2
    return fold(values[:len(values) - (n - span)], values[n - span:]) if n > span else values


GEAR_WORDS = 8                       # words in the rolling hash: each one shifts the others by a byte


def reach(min_words: int) -> int:
    """Places of which the least is a cut: two runs of them fit side by side into a passage's places."""
    return max(1, (min_words - gear(min_words) + 1) // 2)


def gear(min_words: int) -> int:
    return min(GEAR_WORDS, max(1, min_words // 2))


def cuts(h: np.ndarray, min_words: int) -> np.ndarray:
    """Places whose gear hash (of the words from there on) is the least of some run of :func:`reach` places."""
    size, run = gear(min_words), reach(min_words)
    n = len(h) - size + 1
    g = np.zeros(n, np.uint64)
    for k in range(size):
        g = (g << np.uint64(8)) + h[k:k + n]
    g = (g ^ g >> np.uint64(29)) * np.uint64(_ODD[1])
    g ^= g >> np.uint64(32)
    least = _slide(np.minimum, g, run)
    padded = np.zeros(n + run - 1, np.uint64)
    padded[run - 1:run - 1 + len(least)] = least
    return np.flatnonzero(_slide(np.maximum, padded, run) == g)


def chunks(words: list[bytes], min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(digests, first words, ends) of a text's chunks; texts shorter than a passage have none."""
    none = np.empty(0, np.int64)
    if len(words) < min_words:
        return none.view(np.uint64), none, none
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    at = cuts(h, min_words)
    # A passage of one word is a chunk by itself.
    first, end = (at[:-1], at[1:] + gear(min_words)) if min_words > 1 else (at, at + 1)
    # Sums of h[i] * odd^i; a difference of two, divided by odd^first, depends on the chunk's words alone.
    odd = _ODD[0]
    one = np.ones(1, np.uint64)
    power, back = (np.cumprod(np.concatenate([one, np.full(len(h), x, np.uint64)]), dtype=np.uint64)
                   for x in (odd, pow(odd, -1, 1 << 64)))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * power[:-1], dtype=np.uint64)])
    digest = (total[end] - total[first]) * back[first] + (end - first).astype(np.uint64)
    return (digest ^ digest >> np.uint64(29)) * np.uint64(_ODD[1]), first, end


def words_of(text: str | None) -> list[bytes]:
    return text.encode().split() if text else []


def _versions(docs: DataFrame, text: str, key: str) -> DataFrame:
    """``doc, version, text`` of the rows that have an id. Versions number the different texts of one id from 0; where every id
    has one text, which one narrow job finds out, that is all there is to it."""
    rows = docs.select(F.col(f"`{key}`").alias("doc"), F.col(f"`{text}`").alias("text")).where("doc IS NOT NULL")
    hashed = rows.select("doc", F.xxhash64("text").alias("hash"), "text")
    several = (hashed.select("doc", "hash").groupBy("doc").agg(F.min("hash").alias("low"), F.max("hash").alias("high"))
               .where("low != high").select("doc"))
    several = stored(several, "several-versions")
    if several.isEmpty():
        return hashed.select("doc", F.lit(0).cast("long").alias("version"), "text")
    one = hashed.select("doc", "hash").distinct().join(several, "doc")
    numbers = one.withColumn("version", (F.row_number().over(Window.partitionBy("doc").orderBy("hash")) - 1).cast("long"))
    return hashed.join(numbers, ["doc", "hash"], "left").select("doc", F.coalesce("version", F.lit(0)).alias("version"), "text")


# A place in a text as one number: version, word and (of a chunk) length.
_VERSION, _WORD_BITS = 40, 8


def chunk_rows(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``chunk, doc, at`` of every chunk of ``rows`` (doc, version, text); ``at`` has version, first word and length."""
    small_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, owners, places = [], [], []
            for i, (version, t) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2))):
                digest, first, end = chunks(words_of(t.as_py()), min_words)
                digests.append(digest)
                owners.append(np.full(len(digest), i))
                places.append((version << _VERSION) + (first << _WORD_BITS) + (end - first))
            if digests:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(digests).view(np.int64)), batch.column(0).take(pa.array(np.concatenate(owners))),
                     pa.array(np.concatenate(places).astype(np.int64))], ["chunk", "doc", "at"])

    schema = T.StructType([T.StructField("chunk", T.LongType()), rows.schema["doc"], T.StructField("at", T.LongType())])
    return rows.select("doc", "version", "text").mapInArrow(run, schema)


def shared_places(rows: DataFrame) -> DataFrame:
    """``doc, places``: where the texts of each document have chunks that another document has too."""
    shared = (rows.groupBy("chunk").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most")
              .select("chunk"))
    return rows.join(shared, "chunk").groupBy("doc").agg(F.collect_set("at").alias("places"))


def windows(rows: DataFrame, places: DataFrame, min_words: int) -> DataFrame:
    """``a, b, doc, at``: digest and place (version and first word) of every window that holds one of the places."""
    small_batches(rows.sparkSession)
    rows = rows.join(places, "doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, version in enumerate(batch.column("version").to_pylist()):
                words = words_of(batch.column("text")[i].as_py())
                n = len(words) - min_words + 1
                at = batch.column("places")[i].values.to_numpy()
                at = at[at >> _VERSION == version] & (1 << _VERSION) - 1
                if n <= 0 or not len(at):
                    continue
                first = at >> _WORD_BITS
                end = first + (at & (1 << _WORD_BITS) - 1)
                edges = np.zeros(n + 1, np.int64)
                np.add.at(edges, np.clip(end - min_words, 0, n), 1)
                np.add.at(edges, np.clip(first + 1, 0, n), -1)
                starts = np.flatnonzero(np.cumsum(edges[:-1]) > 0)
                lanes = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), np.uint64).reshape(-1, 2)
                a, b = (gram_hashes(lanes[:, k].copy(), min_words, _ODD[k])[starts] for k in (0, 1))
                for k in range(0, len(starts), 1 << 18):
                    part = slice(k, k + (1 << 18))
                    doc = batch.column("doc").take(pa.array(np.full(len(starts[part]), i)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a[part].view(np.int64)), pa.array((b[part] >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                         doc, pa.array((version << _VERSION) + starts[part])], ["a", "b", "doc", "at"])

    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.IntegerType()), rows.schema["doc"],
                           T.StructField("at", T.LongType())])
    return rows.select("doc", "version", "text", "places").mapInArrow(run, schema)


def _stretches(covered: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs [first, end) of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
    return [(int(x), int(y)) for x, y in edges.reshape(-1, 2)]


def _cover(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in windows of ``size`` words."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + size, -1)
    return np.cumsum(edges[:-1]) > 0


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, version, start_word, end_word, n_words, first_doc_id, kept``: every maximal stretch of a
    document to remove, which lies in passages that smaller documents hold, and to keep (``kept``), which
    lies only in passages that it shares with larger ones; a kept stretch ends where one to remove begins, so
    it can be shorter than ``min_words``. ``first_doc_id`` is the least other document that shares a part of it."""
    if reach(min_words) + gear(min_words) >= 1 << _WORD_BITS:
        raise ValueError("passages of that many words have chunks that are too long")
    texts = _versions(docs, text, key)
    places = stored(shared_places(chunk_rows(texts, min_words)), "places")
    alike = Window.partitionBy("a", "b")
    met = (windows(texts, places, min_words)
           .withColumn("least", F.min("doc").over(alike))
           .withColumn("second", F.min(F.when(F.col("doc") > F.col("least"), F.col("doc"))).over(alike))
           .select("doc", F.shiftright("at", _VERSION).alias("version"), F.col("at").bitwiseAND((1 << _VERSION) - 1).cast("int").alias("start"),
                   F.when(F.col("doc") > F.col("least"), F.col("least")).otherwise(F.col("second")).alias("other"))
           .where("other IS NOT NULL").repartition("doc", "version").sortWithinPartitions("doc", "version", "start"))
    small_batches(docs.sparkSession)
    kind = met.schema["doc"].dataType
    arrow = to_arrow_type(kind)
    schema = T.StructType([T.StructField("doc", kind), T.StructField("version", T.LongType()), T.StructField("x", T.IntegerType()),
                           T.StructField("y", T.IntegerType()), T.StructField("other", kind), T.StructField("kept", T.BooleanType())])

    def spans(doc, starts: np.ndarray, others: list) -> Iterator[tuple]:
        base, starts = int(starts[0]), starts - starts[0]
        keeps = np.fromiter((o > doc for o in others), bool, len(others))
        gone = _cover(starts[~keeps], min_words, int(starts[-1]) + min_words)
        kept = _cover(starts[keeps], min_words, len(gone)) & ~gone
        for covered, which in ((gone, np.flatnonzero(~keeps)), (kept, np.flatnonzero(keeps))):
            for x, y in _stretches(covered):
                low, high = np.searchsorted(starts[which], (x - min_words + 1, y))
                yield base + x, base + y, min(others[k] for k in which[low:high]), covered is kept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, starts, others = None, [], []
        names = ["doc", "version", "x", "y", "other", "kept"]
        types = pa.schema(list(zip(names, [arrow, pa.int64(), pa.int32(), pa.int32(), arrow, pa.bool_()])))

        def rows() -> list[dict]:
            found = spans(now[0], np.concatenate(starts).astype(np.int64), others) if starts else ()
            return [dict(zip(names, (*now, *r))) for r in found]

        for batch in batches:
            out, texts = [], list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            at, other = batch.column(2).to_numpy(), batch.column(3).to_pylist()
            first = 0
            for i in [k for k in range(1, len(texts)) if texts[k] != texts[k - 1]] + [len(texts)]:
                if i == first:
                    continue
                if starts and texts[first] != now:
                    out += rows()
                    starts, others = [], []
                now = texts[first]
                starts.append(at[first:i])
                others.extend(other[first:i])
                first = i
            yield pa.RecordBatch.from_pylist(out, types)
        yield pa.RecordBatch.from_pylist(rows(), types)

    return met.mapInArrow(run, schema).select(
        F.col("doc").alias(key), "version", F.col("x").alias("start_word"), F.col("y").alias("end_word"),
        (F.col("y") - F.col("x")).alias("n_words"), F.col("other").alias("first_doc_id"), "kept")


def remove_repeated(docs: DataFrame, min_words: int = MIN_WORDS, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with the passages that are not kept cut out of the text (null stays null)."""
    spans = repeated_spans(docs, min_words, text, key).where(~F.col("kept"))
    cuts = (spans.groupBy(F.col(key).alias("__key"), F.col("version").alias("__version"))
            .agg(F.sort_array(F.collect_list(F.struct("start_word", "end_word"))).alias("cuts")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").alias("text"))
    numbers = _versions(docs, text, key).select(F.col("doc").alias("__key"), F.xxhash64("text").alias("__hash"),
                                                F.col("version").alias("__version")).distinct()
    cuts = cuts.join(numbers, ["__key", "__version"]).drop("__version")
    rows = rows.withColumn("__hash", F.xxhash64("text")).join(cuts, ["__key", "__hash"], "left").select("row", "text", "cuts")
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [cut_words(t, [(c["start_word"], c["end_word"]) for c in cuts or ()])
                     for t, cuts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["row", "text"])

    schema = T.StructType([rows.schema["row"], T.StructField("text", T.StringType())])
    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col("text").alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns])


def cut_words(text: str | None, cuts: list[tuple[int, int]]) -> str | None:
    """``text`` without the words of ``cuts``; what stands between the other words stays."""
    if not text or not cuts:
        return text
    data = text.encode()
    spans = [m.span() for m in _WORD.finditer(data)]
    out, at = [], 0
    for first, end in cuts:
        out.append(data[at:spans[first][0]])
        at = spans[end][0] if end < len(spans) else len(data)
    return b"".join([*out, data[at:]]).decode()


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(table(spark, sf_dir, "documents"))
