"""Toxicity by class-conditional Kneser-Ney models.

Words are spelt by two character models of order five, one per class, that share the counts of the
lowest orders: an n-gram rare in its class falls back, at the end, to continuation counts of both
classes together. A word's evidence is the difference of its two log-likelihoods; a document has two
length-normalised differences, over all its characters and over its most toxic run of
:data:`RUN` words, and a logistic curve fitted on a calibration fold turns them into a score.

Only labelled rows whose crc32(id as text) mod 5 is not 0 are learnt from: remainders 2 to 4 give
the counts and remainder 1 the curve. Both folds use at most about ``sample`` labelled rows, dealt
by a hash of the id; that bound is what makes the model small enough to broadcast. Its n-gram
counts are grouped aggregations in Spark.

Defined cases: null and empty texts have no evidence and score the curve's value there; rows
without a label, null labels and labels without a document are not learnt from; with one class or
none to learn from, every score is 0.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.llm.common import LOWER_BYTES, WORD, lower_ascii, ship, shipped, small_batches, table

SAMPLE_ROWS = 30_000        # labelled rows learnt from, at most (about)
ORDER = 5
SHARED = 2                  # n-grams of this length and shorter are counted over both classes
DISCOUNT = 0.75
RUN = 3                     # words of the run that counts by itself
FOLDS = 5
MEMO_ENTRIES = 100_000      # entries of each memo, at most; memos end with their task
PAD = "\x02"
STOP = "\x03"


def fold(key: Column) -> Column:
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(FOLDS))


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> DataFrame:
    """``id, text, toxic`` of the sampled rows that may be learnt from."""
    known = (labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic"))
             .where("id IS NOT NULL AND toxic IN (0, 1)").where(fold(F.col("id")) != 0))
    n = known.count()
    if n > sample:
        known = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int((1 << 30) * sample / n))
    texts = docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(known, "id")


def gram_counts(rows: DataFrame) -> DataFrame:
    """``gram, ordinary, toxic``: counts of the highest-order n-grams by class."""
    words = (rows.select("toxic", F.explode(F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(f"({WORD})"),
                                                                 F.lit(1))).alias("word"))
             .groupBy("toxic", "word").agg(F.count(F.lit(1)).alias("n")))
    spelt = F.concat(F.lit(PAD * (ORDER - 1)), F.col("word"), F.lit(STOP))
    starts = F.sequence(F.lit(1), F.char_length("word") + 1)
    grams = words.select("toxic", "n", F.explode(F.transform(starts, lambda i: F.substring(spelt, i, F.lit(ORDER)))
                                                 ).alias("gram"))
    return grams.groupBy("gram").agg(F.sum(F.expr("IF(toxic = 0, n, 0)")).alias("ordinary"),
                                     F.sum(F.expr("IF(toxic = 1, n, 0)")).alias("toxic"))


class KneserNey:
    """Two character models that differ above :data:`SHARED` and share all counts from there down."""

    def __init__(self, counts: list[tuple[str, int, int]]) -> None:
        own: list[list[dict[str, int]]] = []             # [side][level]: n-grams of ORDER - level
        for side in (1, 2):
            levels = [{c[0]: c[side] for c in counts if c[side]}]
            while ORDER - len(levels) > SHARED:
                levels.append(Counter(g[1:] for g in levels[-1]))    # distinct left extensions
            own.append(levels)
        lower = [Counter(g[1:] for g in {*own[0][-1], *own[1][-1]})]
        while len(lower) < SHARED:
            lower.append(Counter(g[1:] for g in lower[-1]))
        shared = [(c, _contexts(c)) for c in lower]
        self.levels = [[(c, _contexts(c)) for c in levels] + shared for levels in own]
        self.uniform = 1 / (max(1, len(lower[-1])) + 1)
        self.known: list[dict[str, float]] = [{}, {}]    # probabilities of n-grams under ORDER, by side
        self.ratios: dict[str, float] = {}
        self.memo: dict[bytes, float] = {}

    def forget(self) -> None:
        """Drop the memos: the worker process lives on after its task."""
        self.known, self.ratios, self.memo = [{}, {}], {}, {}

    def _p(self, side: int, gram: str) -> float:
        """Interpolated Kneser-Ney: p(last character of ``gram`` | those before it)."""
        if not gram:
            return self.uniform
        p = self.known[side].get(gram)
        if p is None:
            p = self._p(side, gram[1:])
            counts, contexts = self.levels[side][ORDER - len(gram)]
            total, kinds = contexts.get(gram[:-1], (0, 0))
            if total:
                p = (max(counts.get(gram, 0) - DISCOUNT, 0) + DISCOUNT * kinds * p) / total
            if len(gram) < ORDER:
                _keep(self.known[side], gram, p)
        return p

    def _ratio(self, gram: str) -> float:
        """log p(gram | toxic) - log p(gram | ordinary). There are far fewer n-grams than words, so
        a word that was not met before costs look-ups, not probabilities."""
        ratio = self.ratios.get(gram)
        if ratio is None:
            ratio = _keep(self.ratios, gram, math.log(self._p(1, gram)) - math.log(self._p(0, gram)))
        return ratio

    def evidence(self, word: bytes) -> float:
        """log p(word | toxic) - log p(word | ordinary)."""
        known = self.memo.get(word)
        if known is None:
            spelt = PAD * (ORDER - 1) + word.decode("utf-8", "replace") + STOP
            known = 0.0
            for i in range(len(spelt) - ORDER + 1):
                known += self._ratio(spelt[i:i + ORDER])
            _keep(self.memo, word, known)
        return known

    def features(self, words: list[bytes]) -> tuple[float, float]:
        """Evidence per character: of the whole text, and of its most toxic run of words."""
        if not words:
            return 0.0, 0.0
        gain = np.fromiter(map(self.evidence, words), float, len(words))
        size = np.fromiter(map(len, words), float, len(words)) + 1
        n = min(RUN, len(words))
        total, length = np.cumsum(np.append(0, gain)), np.cumsum(np.append(0, size))
        run = (total[n:] - total[:-n]) / (length[n:] - length[:-n])
        return float(total[-1] / length[-1]), float(run.max())


def _keep(memo: dict, key: str | bytes, value: float) -> float:
    """Remember ``value``; a memo that is full starts anew."""
    if len(memo) >= MEMO_ENTRIES:
        memo.clear()
    memo[key] = value
    return value


def _contexts(counts: dict[str, int]) -> dict[str, tuple[int, int]]:
    """context -> (sum of counts, distinct continuations)."""
    sums: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    for gram, n in counts.items():
        s = sums[gram[:-1]]
        s[0] += n
        s[1] += 1
    return {c: (a, b) for c, (a, b) in sums.items()}


def tox_words(text: str | None) -> list[bytes]:
    return text.encode().translate(_BYTES).split() if text else []


_BYTES = bytes(LOWER_BYTES[b] if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def logistic_fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights (bias last) of a ridge logistic regression, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w, keep = np.zeros(x.shape[1]), np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
        w += step
        if abs(step).max() < 1e-8:
            break
    return w


class Scorer:
    """What is broadcast: the models and the curve."""

    def __init__(self, model: KneserNey, weights: np.ndarray) -> None:
        self.model, self.weights = model, weights

    def score(self, text: str | None) -> float:
        a, b = self.model.features(tox_words(text))
        z = self.weights[0] * a + self.weights[1] * b + self.weights[2]
        return float(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> Scorer | None:
    """None where the sample lacks a class."""
    rows = labelled(docs, labels, sample)
    # Bounded by the sample: the counts come to the driver as they will be broadcast.
    counts = [tuple(r) for r in gram_counts(rows.where(fold(F.col("id")) > 1)).collect()]
    if not any(o for _, o, _ in counts) or not any(t for _, _, t in counts):
        return None
    model = KneserNey(counts)
    shared = ship(docs.sparkSession, model)
    small_batches(docs.sparkSession)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                found = [shipped(shared).features(tox_words(t.as_py())) for t in batch.column(0)]
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.float64()),
                                                  pa.array([f[1] for f in found], pa.float64()),
                                                  batch.column(1)], ["a", "b", "y"])
        finally:
            shipped(shared).forget()

    held = rows.where(fold(F.col("id")) == 1).select("text", "toxic").mapInArrow(
        features, "a double, b double, y int").collect()
    x, y = np.array([(r.a, r.b) for r in held]).reshape(-1, 2), np.array([r.y for r in held], float)
    if len(set(y.tolist())) < 2:
        return None
    return Scorer(model, logistic_fit(x, y))


def score(docs: DataFrame, scorer: Scorer | None, text: str = "text") -> DataFrame:
    """``row`` (the input row as a struct) and ``score``; no input column's name can clash."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(f"`{text}`").alias("text"))
    if scorer is None:
        return rows.select("row", F.lit(0.0).alias("score"))
    shared = ship(docs.sparkSession, scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                found = [shipped(shared).score(t.as_py()) for t in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["row", "score"])
        finally:
            shipped(shared).model.forget()

    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels, sample))
    return scored.select("row.doc_id", (fold(F.col("row.doc_id")) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
