"""Benchmark decontamination over a distributed positional inverted index.

*Index*: every task cuts its documents into segments of bounded word count and stores one row per
segment: the sorted distinct terms, and per term its postings (positions in the segment, rising).
Documents lie one after another in a segment with a gap between them, so a posting names its
document and its word at once, and no list ever crosses a document. The table is written to the
shared folder, where any number of searches read it; a document longer than a segment gets a
segment of its own.

*Search*: the test items are compiled in blocks of bounded size. A segment looks the block's terms up once; phrases
that have a term which the segment lacks are dropped together. For each of the others the terms' lists are ordered
by length, the rarest gives the candidate starts (positions less the term's offset in the phrase), and every further
list, shifted by its own offset, is intersected with them. :func:`search` returns exact matches; ``slop`` widens
the intersection to a neighbourhood of each offset (proximity).

Defined cases: null or empty texts have no words; documents and items without words match nothing; a null ``item_id``
hits words but is not listed; items that repeat an id count once; documents that repeat an id (or have none) are
judged one by one; very long texts are indexed whole; without items no document is hit, without documents there are
no rows. Only the key and the text of either table are read, so other columns' names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import alnum_words, ship, shipped, small_batches, stored, table

SEGMENT_WORDS = 150_000      # words of a segment: bounds a task's memory and an index row
BLOCK_WORDS = 200_000        # words of the test items that a search takes at a time
WINDOW = 10
SEGMENT_SCHEMA = ("segment string, docs array<binary>, starts array<int>, lengths array<int>, "
                  "terms array<binary>, ends array<int>, postings array<int>")


# ---- index ------------------------------------------------------------------------------------

class _Codes(dict):
    """term -> number, in the order of first use."""

    def __missing__(self, term: bytes) -> int:
        self[term] = code = len(self)
        return code


def _segment(name: str, docs: list[tuple[bytes, list[bytes]]], gap: int) -> dict:
    """CSR postings of documents laid one after another, ``gap`` free positions between them."""
    ids = _Codes()
    lengths = np.array([len(w) for _, w in docs], np.int64)
    starts = np.cumsum(lengths + gap) - lengths - gap
    code = np.concatenate([np.fromiter(map(ids.__getitem__, w), np.int64, len(w)) for _, w in docs])
    place = np.arange(len(code)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(starts, lengths)
    terms = sorted(ids)
    order_of = np.empty(len(ids), np.int64)
    order_of[np.fromiter(map(ids.__getitem__, terms), np.int64, len(terms))] = np.arange(len(terms))
    code = order_of[code]
    order = np.argsort(code, kind="stable")
    return {"segment": name, "docs": [d for d, _ in docs], "starts": starts.astype(np.int32), "lengths": lengths.astype(np.int32),
            "terms": terms, "ends": np.cumsum(np.bincount(code, minlength=len(terms))).astype(np.int32),
            "postings": place[order].astype(np.int32)}


def build_index(docs: DataFrame, text: str = "text", key: str = "doc_id", gap: int = 64,
                segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """The stored index of all words of ``docs``; ids are kept as their decimal text (null: empty)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, list[bytes]]] = []
        words, flushed = 0, 0
        kinds = [pa.string(), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.list_(pa.int32()),
                 pa.list_(pa.binary()), pa.list_(pa.int32()), pa.list_(pa.int32())]

        def flush() -> pa.RecordBatch:
            name = f"{TaskContext.get().partitionId()}-{flushed}"
            row = _segment(name, held, gap)
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row.values(), kinds)],
                                              list(row))

        for batch in batches:
            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = alnum_words(t.as_py())
                if held and words + len(found) > segment_words:
                    yield flush()
                    held, words, flushed = [], 0, flushed + 1
                held.append((doc, found))
                words += len(found) + gap
        if held:
            yield flush()

    ids = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).cast("binary")
    return stored(docs.select(ids.alias("k"), F.col(f"`{text}`").alias("t")).mapInArrow(run, SEGMENT_SCHEMA),
                  "positional-index")


class Segment:
    """One index row, ready for look-ups."""

    def __init__(self, row: pa.RecordBatch, i: int) -> None:
        self.name = row.column("segment")[i].as_py()
        self.docs = row.column("docs")[i].values.to_pylist()
        self.starts, self.lengths, ends, self.postings = (
            row.column(c)[i].values.to_numpy() for c in ("starts", "lengths", "ends", "postings"))
        self.terms = row.column("terms")[i].values
        self.bounds = np.concatenate([[0], ends])
        self.sizes = np.diff(self.bounds)

    def codes(self, terms: pa.Array) -> np.ndarray:
        """The segment's numbers of the terms, -1 for those that it lacks."""
        found = pc.index_in(terms, value_set=self.terms)
        return pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def list_of(self, code: int) -> np.ndarray:
        return self.postings[self.bounds[code]:self.bounds[code + 1]]

    def phrase(self, codes: list[int], slop: int = 0) -> np.ndarray:
        """Rising start positions at which every term lies within ``slop`` of its offset."""
        rarest = sorted(range(len(codes)), key=lambda o: self.sizes[codes[o]])
        starts = self.list_of(codes[rarest[0]]) - rarest[0]
        if slop:
            starts = np.unique((starts[:, None] + np.arange(-slop, slop + 1)).ravel())
        for offset in rarest[1:]:
            if not len(starts):
                break
            postings, wanted = self.list_of(codes[offset]), starts + offset
            at = np.searchsorted(postings, wanted - slop)
            found = postings[np.minimum(at, len(postings) - 1)]
            starts = starts[(at < len(postings)) & (found >= wanted - slop) & (found <= wanted + slop)]
        if slop:                     # an occurrence may not reach into a neighbouring document
            own = self.doc_of(starts)
            starts = starts[(starts >= self.starts[own])
                            & (starts + len(codes) <= self.starts[own] + self.lengths[own])]
        return starts

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        return np.maximum(np.searchsorted(self.starts, positions, side="right") - 1, 0)


# ---- search -----------------------------------------------------------------------------------

def windows_of(words: list[bytes], window: int) -> list[tuple[bytes, ...]]:
    if not words:
        return []
    size = min(window, len(words))
    return [tuple(words[i:i + size]) for i in range(len(words) - size + 1)]


class Block:
    """Phrases, the ids of the items that have them, and their terms."""

    def __init__(self, phrases: dict[tuple[bytes, ...], set[str | None]]) -> None:
        terms = sorted({t for p in phrases for t in p})
        number = {t: n for n, t in enumerate(terms)}
        self.terms = pa.array(terms, pa.binary())
        self.ids = [sorted(i for i in ids if i is not None) for ids in phrases.values()]
        self.sizes = [len(p) for p in phrases]
        # Rows of term numbers; the number after the last one fills up short phrases.
        self.phrases = np.full((len(phrases), max(self.sizes, default=1)), len(terms), np.int64)
        for row, phrase in zip(self.phrases, phrases):
            row[:len(phrase)] = [number[t] for t in phrase]

    def possible(self, segment: Segment) -> Iterator[tuple[list[int], list[str]]]:
        """``(codes, item ids)`` of the phrases whose terms the segment has."""
        codes = np.append(segment.codes(self.terms), 0)[self.phrases]
        for n in np.flatnonzero(codes.min(axis=1) >= 0).tolist():
            yield codes[n, :self.sizes[n]].tolist(), self.ids[n]


def _blocks(items: DataFrame, key: str, text: str, window: int, block_words: int):
    """The phrases of the test items, phrase -> ids, in blocks of about ``block_words`` words. The
    driver holds one block at a time, whatever the number of items."""
    sized = items.select(F.col(f"`{key}`").cast("string").alias("i"), F.col(f"`{text}`").alias("t"))
    total = sized.agg(F.sum(F.length("t"))).first()[0] or 0
    n = max(1, -(-total // (block_words * 6)))
    for b in range(n):
        phrases: dict[tuple[bytes, ...], set[str | None]] = {}
        for row in sized.where(F.pmod(F.xxhash64("t"), F.lit(n)) == b).toLocalIterator():
            for phrase in windows_of(alnum_words(row.t), window):
                phrases.setdefault(phrase, set()).add(row.i)
        yield phrases


def search(index: DataFrame, items: DataFrame, key: str = "item_id", text: str = "text",
           window: int = WINDOW, slop: int = 0, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: ``segment, nth`` (its place in the index), ``doc, n_words``, ``spans
    array<struct<first,end>>`` (occurrences as word positions, end exclusive) and ``items``."""
    if window + slop > 64:
        raise ValueError("windows of more than 64 words need an index with a wider gap")
    spark, out, blocks = index.sparkSession, None, 0
    small_batches(spark)         # an index row is a few MB: a batch holds a few of them
    schema = "segment string, nth int, doc string, n_words long, spans array<struct<first:int,end:int>>, items array<string>"
    spans_type = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))

    for phrases in _blocks(items, key, text, window, block_words):
        block = ship(spark, Block(phrases))

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    yield _matches(Segment(batch, i), shipped(block), slop, spans_type)

        found = index.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
        blocks += 1
    if blocks == 1:
        return out
    return out.groupBy("segment", "nth").agg(
        F.first("doc").alias("doc"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_set("items")).alias("items"))


def _matches(segment: Segment, block: Block, slop: int, spans_type: pa.DataType) -> pa.RecordBatch:
    """A row for every document of the segment, with what occurs in it."""
    spans: dict[int, list[tuple[int, int]]] = {}
    items: dict[int, set[str]] = {}
    for codes, ids in block.possible(segment):
        starts = segment.phrase(codes, slop)
        for doc, start in zip(segment.doc_of(starts).tolist(), starts.tolist()):
            first = start - int(segment.starts[doc])
            spans.setdefault(doc, []).append((first, first + len(codes)))
            items.setdefault(doc, set()).update(ids)
    return pa.RecordBatch.from_arrays(
        [pa.array([segment.name] * len(segment.docs), pa.string()),
         pa.array(range(len(segment.docs)), pa.int32()),
         pa.array([d.decode() or None for d in segment.docs], pa.string()),
         pa.array(segment.lengths, pa.int64()),
         pa.array([_merged(spans.get(d, ())) for d in range(len(segment.docs))], spans_type),
         pa.array([sorted(items.get(d, ())) for d in range(len(segment.docs))], pa.list_(pa.string()))],
        ["segment", "nth", "doc", "n_words", "spans", "items"])


def _merged(spans) -> list[dict]:
    out: list[dict] = []
    for first, end in sorted(spans):
        if out and first <= out[-1]["end"]:
            out[-1]["end"] = max(end, out[-1]["end"])
        else:
            out.append({"first": first, "end": end})
    return out


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS,
                  segment_words: int = SEGMENT_WORDS, key: str = "doc_id") -> DataFrame:
    """Per document: ``key, n_words, n_hit, n_items, items_sha256, contaminated``."""
    found = search(build_index(docs, key=key, segment_words=segment_words), items, window=window,
                   block_words=block_words).select("doc", "n_words", "spans", "items")

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [_merged((s["first"], s["end"]) for s in x or ()) for x in batch.column(2).to_pylist()]
            hit = [sum(s["end"] - s["first"] for s in x) for x in spans]
            names = [sorted(set(x or ())) for x in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(hit, pa.int64()),
                 pa.array([len(x) for x in names], pa.int64()),
                 pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in names]),
                 pa.array([h > 0 for h in hit])],
                ["doc", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    summed = found.mapInArrow(summary, "doc string, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")
    return summed.select(F.col("doc").cast(docs.schema[key].dataType).alias(key), *summed.columns[1:])


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, list_slice(w, s, s + least(10, len(w)) - 1) AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
grams AS (
  SELECT doc_id, k, s, list_slice(w, s, s + k - 1) AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s
        FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)),
occ AS (SELECT doc_id, item_id, s, k FROM grams JOIN win USING (k, g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM occ) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
              string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names
       FROM occ GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""
