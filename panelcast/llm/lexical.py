"""Ranked lexical search by presence-mask grouping.

1. *Presence*: the items' distinct terms, in blocks of bounded size, are the vocabulary of a scan of all
   documents. Each task cuts its documents into segments and stores one row per segment: ids, lengths and,
   for every term of the block, the documents that hold it with its count there. Numbers of documents, words
   and documents per term are sums over these rows.
2. *Masks*: a segment's lists become one bitmap per term. For an item, the bitmaps of its terms are turned
   into one mask per document, and equal masks are a group. A mask's largest possible score is the
   sum of its terms' largest scores in the segment, looked up byte by byte.
3. *Evaluation*: groups are scored by descending possible score. A task keeps the ``k`` best documents of each
   item over all its segments; the rest of a segment is finished as soon as the next group's possible
   score is below the k-th best score met (an equal one is still scored, as ids break ties).
4. The best of all tasks meet in one window per item, behind Spark's partial group limit.

All scores are 64-bit integers; nothing is estimated, and no document is left out that could be among the best.

Defined cases: null and empty texts have no terms, are not counted and match nothing; rows of the items that
share an id (null included) are one item with the terms of all; rows of the documents that share an id are
ranked one by one, documents without an id come after equal scores with one; very long texts and items are
taken whole (a long text is a segment of its own); an empty table on either side gives no rows. Keys of the
documents must be integers. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from panelcast.llm.common import WORD, alnum_words, lower_ascii, ship, shipped, small_batches, stored, table

SEGMENT_DOCS = 2048          # documents of a segment, at most
SEGMENT_WORDS = 1_000_000    # words of a segment, unless one document has more
BLOCK_TERMS = 50_000         # item terms (with repeats over items) that one scan looks up, about
BITS = 1 << 25               # bits of an item's unpacked bitmaps at a time
K = 10
PRESENCE = "ids array<long>, lengths binary, terms binary, counts binary, docs binary, tfs binary"


# ---- presence ---------------------------------------------------------------------------------

def item_blocks(items: DataFrame, key: str, text: str, block_terms: int) -> Iterator[list[tuple]]:
    """``[(item id, distinct terms)]`` in blocks of about ``block_terms`` terms; an item is never split. The
    driver holds one block at a time."""
    words = F.regexp_extract_all(lower_ascii(F.col(f"`{text}`")), F.lit(f"({WORD})"), F.lit(1))
    terms = (items.select(F.col(f"`{key}`").alias("item"), F.explode(words).alias("term"))
             .groupBy("item").agg(F.sort_array(F.collect_set("term")).alias("terms")))
    terms = stored(terms, "item-terms")
    n = max(1, -(-(terms.agg(F.sum(F.size("terms"))).first()[0] or 0) // block_terms))
    for b in range(n):
        block = [(r.item, r.terms) for r in terms.where(F.pmod(F.xxhash64("item"), F.lit(n)) == b).toLocalIterator()]
        if block:
            yield block


def presence(docs: DataFrame, vocabulary: dict[bytes, int], key: str, text: str) -> DataFrame:
    """Stored segments: ``ids, lengths``, and of every vocabulary term met (``terms``, rising) its number of
    ``counts`` postings in ``docs`` (place in the segment) and ``tfs``."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code_of, missing = shared.value.get, itertools.repeat(-1)
        ids: list = []
        lengths: list[int] = []
        keys: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            pairs, tfs = np.unique(np.concatenate(keys), return_counts=True)
            terms, counts = np.unique(pairs >> 32, return_counts=True)
            columns = [np.array(lengths, np.int64), terms.astype(np.int32), counts.astype(np.int32),
                       (pairs & 0xFFFFFFFF).astype(np.int32), tfs.astype(np.int64)]
            return pa.RecordBatch.from_arrays(
                [pa.array([ids], pa.list_(pa.int64())), *(pa.array([c.tobytes()], pa.binary()) for c in columns)],
                ["ids", "lengths", "terms", "counts", "docs", "tfs"])

        for batch in batches:
            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = alnum_words(t.as_py())
                if not words:
                    continue
                if ids and (len(ids) >= SEGMENT_DOCS or held + len(words) > SEGMENT_WORDS):
                    yield flush()
                    ids, lengths, keys, held = [], [], [], 0
                held += len(words)
                codes = np.fromiter(map(code_of, words, missing), np.int64, len(words))
                keys.append((codes[codes >= 0] << 32) | len(ids))
                ids.append(doc)
                lengths.append(len(words))
        if ids:
            yield flush()

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    return stored(rows.mapInArrow(run, PRESENCE), "presence")


class Statistics:
    """N, L and the weight of every vocabulary term."""

    def __init__(self, docs: int, words: int, holding: dict[int, int], size: int) -> None:
        self.docs, self.words = docs, words
        self.weights = np.zeros(size, np.int64)
        for term, df in holding.items():
            self.weights[term] = math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))

    def norm(self, lengths: np.ndarray) -> np.ndarray:
        """m of every length."""
        return np.array([10 + 90 * n * self.docs // self.words for n in lengths.tolist()], np.int64)


def statistics(segments: DataFrame, size: int) -> Statistics:
    """Sums over the segments. The document frequencies of one block's terms come to the driver."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, words, holding = 0, 0, np.zeros(size, np.int64)
        for batch in batches:
            for lengths, terms, counts in zip(*(batch.column(c) for c in range(3))):
                lengths = np.frombuffer(lengths.as_buffer(), np.int64)
                docs, words = docs + len(lengths), words + int(lengths.sum())
                holding[np.frombuffer(terms.as_buffer(), np.int32)] += np.frombuffer(counts.as_buffer(), np.int32)
        met = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *met.tolist()], pa.int64()),
                                          pa.array([docs, words, *holding[met].tolist()], pa.int64())], ["term", "n"])

    rows = segments.select("lengths", "terms", "counts").mapInArrow(sums, "term long, n long")
    found = {r.term: r.n for r in rows.groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator()}
    return Statistics(found.pop(-2, 0), found.pop(-1, 0), found, size)


# ---- masks ------------------------------------------------------------------------------------

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)    # (256, 8)


class Segment:
    """One presence row with its bitmaps, impacts (score of a term in a document) and largest impacts."""

    def __init__(self, row: pa.RecordBatch, i: int, stats: Statistics) -> None:
        def column(name: str, kind: type) -> np.ndarray:
            return np.frombuffer(row.column(name)[i].as_buffer(), kind)

        self.ids = row.column("ids")[i].as_py()
        n = len(self.ids)
        terms, counts = column("terms", np.int32), column("counts", np.int32)
        docs, tfs = column("docs", np.int32).astype(np.int64), column("tfs", np.int64)
        norm = stats.norm(column("lengths", np.int64))
        rows = np.repeat(np.arange(len(terms)), counts)
        self.row_of = {t: r for r, t in enumerate(terms.tolist())}
        self.impacts = stats.weights[terms][rows] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * norm[docs]))
        self.keys = rows * n + docs                         # rising, one for each impact
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
        self.most = np.maximum.reduceat(self.impacts, starts) if len(terms) else np.empty(0, np.int64)
        self.width = -(-n // 8)
        bitmaps = np.zeros((len(terms), self.width * 8), np.uint8)
        bitmaps[rows, docs] = 1
        self.bitmaps = np.packbits(bitmaps, axis=1)

    def masks(self, rows: np.ndarray) -> np.ndarray:
        """(bytes, documents): bit ``t`` of a document's column says that it holds the t-th of ``rows``."""
        step = max(8, BITS // (8 * self.width) // 8 * 8)
        parts = [np.packbits(np.unpackbits(self.bitmaps[rows[a:a + step]], axis=1, count=len(self.ids)), axis=0)
                 for a in range(0, len(rows), step)]
        return np.concatenate(parts)

    def possible(self, rows: np.ndarray, masks: np.ndarray) -> np.ndarray:
        """The largest score that each document's mask allows."""
        most = np.zeros(8 * len(masks), np.int64)
        most[:len(rows)] = self.most[rows]
        tables = _BYTE_BITS @ most.reshape(-1, 8).T          # (256, bytes)
        total = np.zeros(masks.shape[1], np.int64)
        for b, column in enumerate(masks):
            total += tables[column, b]
        return total

    def scores(self, rows: np.ndarray, held: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Exact scores of ``docs``; ``held`` (terms, documents) says which of ``rows`` each one holds."""
        term, place = np.nonzero(held)
        impacts = self.impacts[np.searchsorted(self.keys, rows[term] * len(self.ids) + docs[place])]
        out = np.zeros(len(docs), np.int64)
        np.add.at(out, place, impacts)
        return out

    def best(self, terms: list[int], best: list[tuple], k: int) -> list[tuple]:
        """``best`` (score descending, id ascending) with this segment's documents ranked in."""
        rows = np.array([r for r in map(self.row_of.get, terms) if r is not None], np.int64)
        if not len(rows):
            return best
        masks = self.masks(rows)
        possible = self.possible(rows, masks)
        least = -best[-1][0] if len(best) >= k else 1
        docs = np.flatnonzero(possible >= max(1, least))
        if not len(docs):
            return best
        # Equal masks are equal columns of bytes.
        columns = np.ascontiguousarray(masks[:, docs].T)
        _, first, group = np.unique(columns.view(f"V{columns.shape[1]}").ravel(), return_index=True, return_inverse=True)
        allowed = possible[docs[first]]
        order = np.argsort(-allowed, kind="stable")
        members = np.argsort(group, kind="stable")
        ends = np.cumsum(np.bincount(group, minlength=len(first)))
        at, step = 0, 4 * k
        while at < len(order) and allowed[order[at]] >= least:
            # The next masks, with together at least ``step`` documents.
            taken: list[np.ndarray] = []
            n = 0
            while at < len(order) and n < step and allowed[order[at]] >= least:
                g = order[at]
                taken.append(members[ends[g - 1] if g else 0:ends[g]])
                n, at = n + len(taken[-1]), at + 1
            now = np.concatenate(taken)
            held = np.unpackbits(columns[now], axis=1, count=len(rows)).T
            scores = self.scores(rows, held, docs[now])
            for place in np.flatnonzero(scores >= max(1, least)).tolist():
                doc = self.ids[docs[now[place]]]
                best.append((-int(scores[place]), doc is None, doc or 0))
            best.sort()
            del best[k:]
            least = -best[-1][0] if len(best) >= k else 1
            step *= 2
        return best


# ---- search -----------------------------------------------------------------------------------

def search(docs: DataFrame, items: DataFrame, k: int = K, key: str = "doc_id", text: str = "text",
           item_key: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_key, rank, key, score``: the ``k`` best documents of every item with a score above 0."""
    spark = docs.sparkSession
    kind = items.schema[item_key].dataType
    if not isinstance(docs.schema[key].dataType, T.IntegralType):
        raise TypeError("the documents' key must be an integer column")
    schema = T.StructType([T.StructField("item", kind)]).add("doc", "long").add("score", "long")
    out = spark.createDataFrame([], schema)
    for block in item_blocks(items, item_key, item_text, block_terms):
        vocabulary = {t.encode(): n for n, t in enumerate(sorted({t for _, terms in block for t in terms}))}
        segments = presence(docs, vocabulary, key, text)
        stats = statistics(segments, len(vocabulary))
        wanted = [(item, [vocabulary[t.encode()] for t in terms]) for item, terms in block]
        shared = ship(spark, (wanted, stats))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            wanted, stats = shipped(shared)
            best: list[list[tuple]] = [[] for _ in wanted]
            for batch in batches:
                for i in range(batch.num_rows):
                    segment = Segment(batch, i, stats)
                    for n, (_, terms) in enumerate(wanted):
                        best[n] = segment.best(terms, best[n], k)
            found = [(item, None if none else doc, -score) for (item, _), rows in zip(wanted, best) for score, none, doc in rows]
            for a in range(0, len(found), 10_000):
                part = found[a:a + 10_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[0] for f in part], to_arrow_type(kind)), pa.array([f[1] for f in part], pa.int64()),
                     pa.array([f[2] for f in part], pa.int64())], ["item", "doc", "score"])

        out = out.unionByName(segments.mapInArrow(run, schema))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    ranked = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(item_key), "rank", F.col("doc").cast(docs.schema[key].dataType).alias(key),
                         "score")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
ORACLE = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS t FROM benchmark),
s AS (SELECT count(*)::BIGINT AS big_n, sum(len(w))::BIGINT AS big_l FROM d WHERE len(w) > 0),
tf AS (SELECT doc_id, n, t, count(*)::BIGINT AS tf
       FROM (SELECT doc_id, len(w)::BIGINT AS n, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
df AS (SELECT t, count(*)::BIGINT AS df FROM tf GROUP BY t),
weight AS (SELECT t, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, s),
scored AS (SELECT item_id, doc_id,
                  sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * big_n) // big_l))))::BIGINT AS score
           FROM q JOIN tf USING (t) JOIN weight USING (t), s GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
           FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
