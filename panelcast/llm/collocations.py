"""Phrase collocations by weighted acyclic automata.

1. *Heavy hitters*: a first scan adds every word and every pair of neighbouring words to counters of fixed number,
   by hash and language. A word or pair whose counter stays below ``min_count`` is certainly rarer than that; all
   others may go on. So the next step drops nothing that could count, whatever share of the counters is full.
2. *Shard automata*: a task turns each chunk of its texts into the sorted n-grams (up to ``longest`` words) of what is
   left and builds their count transducer incrementally: an n-gram adds only the states behind the prefix that it
   shares with the one before. The root's labels are the languages; a state's weight is the count of its n-gram
   in the chunk, and that of a language is the number of all its words.
3. *Union by prefix range*: sampled n-grams split the sorted order of all n-grams into ranges. A shard's automaton is
   cut there, and a task unites the parts of one range and sums their weights. Every n-gram lies in one
   range and comes once from each chunk, so the commonest word or phrase is no larger than any other; a
   common prefix has its n-grams in several ranges. States below ``min_count`` go.
4. *Part look-ups*: each range's candidates ask for the counts of their first and last words, as an
   automaton that is cut by the same ranges and composed with the count transducer there; the answers go back.
   A part is asked for once per range, however many candidates have it.
5. Every candidate has its lowest-scoring cut, in exact integers. A candidate is dropped if one with one more word
   has its count (a longer one that has, has such a part in between). One window per language ranks the rest.

Defined cases: a null text is empty, and empty texts have no words; a null language is ``und``, as is the language of
that name; repeated rows and ids count row by row, and ids are not read; very long texts and words are taken whole;
ties are settled by the contract's order, phrases being distinct; an empty table gives no rows. Only ``text`` and ``lang`` are
read, so other names cannot clash.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.llm.common import LOWER_BYTES, fan_out, small_batches, stored, table

LONGEST = 5
MIN_COUNT = 100
TOP = 2000
CHUNK_WORDS = 1 << 20        # words of a shard automaton, and those of the text that reaches it
UNION_STATES = 1 << 19       # states that a task gathers before it unites them, or as many as the union has
RANGE_WORDS = 1 << 21        # words of the corpus for each range, about
BUCKETS = 1 << 24            # counters of pairs; half as many of words. A worker holds a byte for each, or four
BLOCK = 1 << 16              # counters in a row
SAMPLE = 20_000              # sampled n-grams that the ranges' bounds are chosen from, at most
CHUNK_SAMPLE = 256
END = b"\xff"                # ends a piece; no byte of UTF-8
AUTOMATON = "words array<binary>, depths binary, labels binary, weights binary"

_PIECES = bytes(0xFF if b in b".,;:!?" or 10 <= b <= 13 else 32 if b == 9 else LOWER_BYTES[b] for b in range(256))


def tokens(text: str | None) -> list[bytes]:
    """Words, with :data:`END` after every piece."""
    if not text:
        return []
    out = text.encode().translate(_PIECES).replace(END, b" \xff ").split()
    out.append(END)
    return out


class _Codes(dict):
    """word -> number, in the order of first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list[bytes], dict[bytes, np.ndarray]]]:
    """(vocabulary, codes by language) of about CHUNK_WORDS words; code 0 ends a piece."""
    codes, by_lang, n = _Codes({END: 0}), {}, 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = tokens(text.as_py())
            if not words:
                continue
            lang = lang.encode()
            by_lang.setdefault(lang, []).append(np.fromiter(map(codes.__getitem__, words), np.int64, len(words)))
            n += len(words)
            if n >= CHUNK_WORDS:
                yield list(codes), {k: np.concatenate(v) for k, v in by_lang.items()}
                codes, by_lang, n = _Codes({END: 0}), {}, 0
    if by_lang:
        yield list(codes), {k: np.concatenate(v) for k, v in by_lang.items()}


# ---- heavy hitters ----------------------------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _places(words: list[bytes], lang: bytes, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counters of every word and of the pair that begins with it (the last one's means nothing)."""
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))[codes]
    of_lang = _mix(np.array([xxhash.xxh64_intdigest(lang)], np.uint64))[0]
    pair = hashes * np.uint64(0x9E3779B97F4A7C15) + np.roll(hashes, -1)
    return (BUCKETS + (_mix(hashes ^ of_lang) % np.uint64(BUCKETS // 2)).astype(np.int64),
            (_mix(pair ^ of_lang) % np.uint64(BUCKETS)).astype(np.int64))


def heavy_hitters(rows: DataFrame, min_count: int) -> tuple[np.ndarray, int, list[tuple[bytes, ...]]]:
    """(live counters as bits, number of words, sampled n-grams). All three are of fixed size."""
    cap = 255 if min_count <= 255 else (1 << 32) - 1
    kind = np.uint8 if min_count <= 255 else np.uint32

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, n, sample = np.zeros(BUCKETS + BUCKETS // 2, kind), 0, []

        def add(places: np.ndarray) -> None:
            at, more = np.unique(places, return_counts=True)
            counters[at] = np.minimum(counters[at] + more, cap)       # from the cap on, a counter is live by itself

        for words, by_lang in _chunks(batches):
            for lang, codes in by_lang.items():
                word, pair = _places(words, lang, codes)
                real = codes > 0
                n += int(real.sum())
                add(word[real])
                add(pair[real & np.roll(real, -1)])
                starts = np.flatnonzero(real)
                for i in starts[::max(1, len(starts) * len(by_lang) // CHUNK_SAMPLE)].tolist():
                    gram = codes[i:i + LONGEST]
                    gram = gram[:int(np.argmin(gram > 0))] if (gram == 0).any() else gram
                    sample.append([lang, *(words[c] for c in gram)])
        blocks, data = [], []
        for b in range(len(counters) // BLOCK):
            part = counters[b * BLOCK:(b + 1) * BLOCK]
            some = np.flatnonzero(part)
            if len(some):
                thin = len(some) * (2 + part.itemsize) < part.nbytes
                blocks.append(b)
                data.append(some.astype(np.uint16).tobytes() + part[some].tobytes() if thin else part.tobytes())
        for a in range(0, len(blocks), 16):
            yield pa.RecordBatch.from_pydict({
                "block": pa.array(blocks[a:a + 16], pa.int32()), "data": pa.array(data[a:a + 16], pa.binary()),
                "n": pa.array([0] * len(blocks[a:a + 16]), pa.int64()),
                "gram": pa.array([None] * len(blocks[a:a + 16]), pa.list_(pa.binary()))})
        grams = [*sample, None]
        yield pa.RecordBatch.from_pydict({
            "block": pa.array([-1] * len(grams), pa.int32()), "data": pa.array([None] * len(grams), pa.binary()),
            "n": pa.array([0] * len(sample) + [n], pa.int64()), "gram": pa.array(grams, pa.list_(pa.binary()))})

    def live(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        size = np.dtype(kind).itemsize
        for batch in batches:
            for b, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                data, sums = data.as_buffer(), total.setdefault(b, np.zeros(BLOCK, np.int64))
                if data.size == BLOCK * size:
                    sums += np.frombuffer(data, kind)
                else:
                    n = data.size // (2 + size)
                    sums[np.frombuffer(data, np.uint16, n)] += np.frombuffer(data[2 * n:], kind)
        for b, sums in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()),
                                              pa.array([np.packbits(sums >= min_count).tobytes()], pa.binary())], ["block", "bits"])

    found = stored(rows.mapInArrow(count, "block int, data binary, n long, gram array<binary>"), "heavy-hitters")
    n = found.agg(F.sum("n")).first()[0] or 0
    bits = np.zeros((BUCKETS + BUCKETS // 2) // 8, np.uint8)
    blocks = found.where("block >= 0").select("block", "data").repartition(fan_out(rows.sparkSession), "block")
    for row in blocks.mapInArrow(live, "block int, bits binary").toLocalIterator():
        bits[row.block * BLOCK // 8:(row.block + 1) * BLOCK // 8] = np.frombuffer(row.bits, np.uint8)
    sample = found.where("gram IS NOT NULL").select("gram").orderBy(F.xxhash64("gram")).limit(SAMPLE)
    return bits, n, [tuple(bytes(w) for w in r.gram) for r in sample.toLocalIterator()]


def live_lengths(bits: np.ndarray, words: list[bytes], lang: bytes, codes: np.ndarray) -> np.ndarray:
    """How many words (0 to LONGEST) may be counted together from each place on."""
    word, pair = _places(words, lang, codes)

    def set_at(places: np.ndarray) -> np.ndarray:
        return (bits[places >> 3] >> (7 - (places & 7)).astype(np.uint8) & 1).astype(bool)

    lone = set_at(word) & (codes > 0)
    linked = lone & np.append(lone[1:], False) & set_at(pair)
    run, shifted = linked.copy(), linked
    lengths = lone.astype(np.int64) + run
    for _ in range(LONGEST - 2):
        shifted = np.append(shifted[1:], False)
        run = run & shifted
        lengths += run
    return lengths


def range_bounds(bits: np.ndarray, sample: list[tuple[bytes, ...]], n: int) -> list[tuple[bytes, ...]]:
    """At most ``n - 1`` rising n-grams between the ranges, from the live parts of the sampled ones."""
    grams = []
    for lang, *words in sample:
        size = int(live_lengths(bits, [END, *words], lang, np.arange(1, len(words) + 1))[0]) if words else 0
        if size:
            grams.append((lang, *words[:size]))
    # Each once: a range holds distinct n-grams of a chunk, however often they occur there.
    grams = sorted(set(grams))
    return sorted({grams[len(grams) * i // n] for i in range(1, n)}) if grams else []


# ---- automata ---------------------------------------------------------------------------------

class Automaton:
    """A weighted deterministic acyclic automaton over words, states in preorder.

    ``depths`` and ``labels`` (places in the sorted ``words``) say how a state is reached from the one before it;
    depth 0 is a language. ``weights`` are counts; a state that only leads to others has 0.
    """

    def __init__(self, words: list[bytes], depths: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> None:
        self.words, self.depths, self.labels, self.weights = words, depths, labels, weights

    @classmethod
    def build(cls, words: list[bytes], paths: np.ndarray, weights: np.ndarray) -> Automaton:
        """From sorted distinct paths: rows of ranks (from 1) in the sorted ``words``, filled up with 0. A path adds
        the states behind its longest common prefix with the path before."""
        n, width = paths.shape
        same = np.zeros((n, width), bool)
        same[1:] = (paths[1:] == paths[:-1]) & (paths[1:] > 0)
        common = np.logical_and.accumulate(same, axis=1).sum(axis=1)
        size = (paths > 0).sum(axis=1)
        new = size - common
        last = np.cumsum(new) - 1
        row = np.repeat(np.arange(n), new)
        depths = np.arange(len(row)) - (last - new + 1)[row] + common[row]
        used, labels = np.unique(paths[row, depths], return_inverse=True)
        held = np.zeros(len(row), np.int64)
        held[last] = weights
        return cls([words[u - 1] for u in used.tolist()], depths.astype(np.uint8), labels.astype(np.uint32), held)

    def paths(self) -> np.ndarray:
        """Rows of ranks (from 1) in ``words``, filled up with 0; one for each state."""
        n = len(self.depths)
        out = np.zeros((n, LONGEST + 1), np.int32)
        at = np.arange(n, dtype=np.int32)
        for d in range(LONGEST + 1):
            last = np.maximum.accumulate(np.where(self.depths == d, at, np.int32(-1)))
            held = self.depths >= d
            out[held, d] = self.labels[last[held]].astype(np.int32) + 1
        return out

    def items(self) -> Iterator[tuple[tuple[bytes, ...], int]]:
        path: list[bytes] = []
        for depth, label, weight in zip(self.depths.tolist(), self.labels.tolist(), self.weights.tolist()):
            del path[depth:]
            path.append(self.words[label])
            yield tuple(path), weight

    @classmethod
    def of(cls, grams: dict[tuple[bytes, ...], int]) -> Automaton:
        words = sorted({w for g in grams for w in g})
        rank = {w: r for r, w in enumerate(words, 1)}
        order = sorted(grams)
        paths = np.zeros((len(order), LONGEST + 1), np.int64)
        for i, g in enumerate(order):
            paths[i, :len(g)] = [rank[w] for w in g]
        return cls.build(words, paths, np.array([grams[g] for g in order], np.int64))

    @classmethod
    def union(cls, parts: list[Automaton]) -> Automaton:
        """One automaton whose weights are the sums."""
        words = sorted({w for p in parts for w in p.words})
        rank = {w: r for r, w in enumerate(words, 1)}
        paths, at = np.empty((sum(len(p.depths) for p in parts), LONGEST + 1), np.int32), 0
        for p in parts:
            paths[at:at + len(p.depths)] = np.array([0, *(rank[w] for w in p.words)], np.int32)[p.paths()]
            at += len(p.depths)
        del rank
        paths, weights = summed(paths, np.concatenate([p.weights for p in parts]), len(words))
        return cls.build(words, paths, weights)

    def where(self, keep: np.ndarray) -> Automaton:
        """The kept states, and those that lead to them with weight 0."""
        return Automaton.build(self.words, self.paths()[keep], self.weights[keep])

    def row(self) -> list:
        return [self.words, self.depths.tobytes(), self.labels.tobytes(), self.weights.tobytes()]

    @classmethod
    def read(cls, batch: pa.RecordBatch, i: int) -> Automaton:
        words, depths, labels, weights = (batch.column(c)[i] for c in ("words", "depths", "labels", "weights"))
        return cls(words.as_py(), *(np.frombuffer(v.as_buffer(), k) for v, k in (
            (depths, np.uint8), (labels, np.uint32), (weights, np.int64))))


def summed(paths: np.ndarray, weights: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct rows with the sums of their weights; no entry is above ``top``."""
    if not len(paths):
        return paths, weights
    bits = max(1, top.bit_length())
    each = 63 // bits
    keys = []
    for a in range(0, paths.shape[1], each):
        key = np.zeros(len(paths), np.int64)
        for column in paths[:, a:a + each].T:
            key <<= bits
            key |= column
        keys.append(key)
    order = np.lexsort(keys[::-1])
    changed = np.zeros(len(order), bool)
    changed[0] = True
    for key in keys:
        key = key[order]
        changed[1:] |= key[1:] != key[:-1]
    first = np.flatnonzero(changed)
    return paths[order[first]], np.add.reduceat(weights[order], first)


def shard(words: list[bytes], by_lang: dict[bytes, np.ndarray], bits: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(sorted vocabulary, sorted n-grams as rows of ranks, counts) of one chunk."""
    order = sorted({*words[1:], *by_lang})
    rank = {w: r for r, w in enumerate(order, 1)}
    ranks = np.array([0, *(rank[w] for w in words[1:])], np.int64)
    paths, weights = [], []
    for lang in sorted(by_lang):
        codes = by_lang[lang]
        lengths = live_lengths(bits, words, lang, codes)
        padded = np.append(ranks[codes], np.zeros(LONGEST, np.int64))
        # Places that may count no pair are summed by word; the others are rows of their own.
        alone = np.bincount(padded[:len(codes)][lengths == 1], minlength=len(order) + 1)
        single = np.flatnonzero(alone)
        starts = np.flatnonzero(lengths > 1)
        windows = np.stack([np.where(lengths[starts] > j, padded[starts + j], 0) for j in range(LONGEST)], axis=1)
        rows = np.zeros((len(single), LONGEST), np.int64)
        rows[:, 0] = single
        rows, counts = summed(np.concatenate([rows, windows]),
                              np.concatenate([alone[single], np.ones(len(starts), np.int64)]), len(order))
        grams, sums = _prefixes(rows, counts)
        paths += [np.array([[rank[lang]] + [0] * LONGEST], np.int64),
                  np.concatenate([np.full((len(grams), 1), rank[lang], np.int64), grams], axis=1)]
        weights += [np.array([np.count_nonzero(codes)], np.int64), sums]
    return order, np.concatenate(paths), np.concatenate(weights)


def _prefixes(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All prefixes of sorted distinct rows, in order, with the sums of the rows that begin with them."""
    n, width = rows.shape
    if not n:
        return rows, counts
    same = np.zeros((n, width), bool)
    same[1:] = (rows[1:] == rows[:-1]) & (rows[1:] > 0)
    common = np.logical_and.accumulate(same, axis=1).sum(axis=1)
    size = (rows > 0).sum(axis=1)
    offset = np.concatenate([[0], np.cumsum(size - common)])
    out, sums = np.zeros((offset[-1], width), np.int64), np.zeros(offset[-1], np.int64)
    total = np.concatenate([[0], np.cumsum(counts)])
    for level in range(1, width + 1):
        breaks = np.append(np.flatnonzero(common < level), n)    # where another prefix of this length begins
        begin, end = breaks[:-1], breaks[1:]
        real = size[begin] >= level
        begin, end = begin[real], end[real]
        at = offset[begin] + level - 1 - common[begin]
        out[at, :level] = rows[begin, :level]
        sums[at] = total[end] - total[begin]
    return out, sums


def cut(words: list[bytes], paths: np.ndarray, bounds: list[tuple[bytes, ...]]) -> list[int]:
    """Where the sorted paths pass each bound (first place that is not below it)."""
    places, low = [], 0
    for bound in bounds:
        wanted = []
        for w in bound:
            at = bisect_left(words, w)
            wanted.append(2 * at + 2 if at < len(words) and words[at] == w else 2 * at + 1)
        wanted += [0] * (paths.shape[1] - len(wanted))
        high = len(paths)
        while low < high:
            middle = (low + high) // 2
            if [2 * x for x in paths[middle].tolist()] < wanted:
                low = middle + 1
            else:
                high = middle
        places.append(low)
    return places


def _parts(words: list[bytes], paths: np.ndarray, weights: np.ndarray,
           bounds: list[tuple[bytes, ...]]) -> Iterator[tuple[int, Automaton]]:
    """The automaton of each range that has paths."""
    places = [0, *cut(words, paths, bounds), len(paths)]
    for r, (a, b) in enumerate(zip(places, places[1:])):
        if a < b:
            yield r, Automaton.build(words, paths[a:b], weights[a:b])


_KINDS = [pa.list_(pa.binary()), pa.binary(), pa.binary(), pa.binary()]
_NAMES = ["words", "depths", "labels", "weights"]


def _record(lead: dict[str, int], automaton: Automaton) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*(pa.array([v], pa.int32()) for v in lead.values()),
         *(pa.array([v], k) for v, k in zip(automaton.row(), _KINDS))], [*lead, *_NAMES])


# ---- jobs -------------------------------------------------------------------------------------

def count_transducers(docs: DataFrame, text: str = "text", lang: str = "lang",
                      min_count: int = MIN_COUNT) -> tuple[DataFrame, list[tuple[bytes, ...]]]:
    """Stored automata ``part, words, depths, labels, weights`` of all n-grams that reach ``min_count``, one row for each
    range, with the bounds between the ranges."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
                       F.col(f"`{text}`").alias("text"))
    bits, n, sample = heavy_hitters(rows, min_count)
    ranges = max(2 * fan_out(spark), n // RANGE_WORDS)
    bounds = range_bounds(bits, sample, ranges)
    shared = spark.sparkContext.broadcast((bits, bounds))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, bounds = shared.value
        for words, by_lang in _chunks(batches):
            for r, part in _parts(*shard(words, by_lang, bits), bounds):
                yield _record({"part": r}, part)

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, states, united = None, [], 0, 0

        def done() -> Iterator[pa.RecordBatch]:
            whole = Automaton.union(held)
            whole = whole.where((whole.weights >= min_count) | (whole.depths == 0) & (whole.weights > 0))
            if len(whole.depths):
                yield _record({"part": now}, whole)

        for batch in batches:
            for i, r in enumerate(batch.column("part").to_pylist()):
                if r != now and held:
                    yield from done()
                    held, states, united = [], 0, 0
                now = r
                held.append(Automaton.read(batch, i))
                states += len(held[-1].depths)
                if states >= max(UNION_STATES, united):
                    held = [Automaton.union(held)]
                    states, united = 0, len(held[0].depths)
        if held:
            yield from done()

    cuts = rows.mapInArrow(shards, f"part int, {AUTOMATON}")
    united = (cuts.repartition(ranges, "part").sortWithinPartitions("part")
              .mapInArrow(unite, f"part int, {AUTOMATON}"))
    return stored(united, "count-transducers"), bounds


def _cuts(gram: tuple[bytes, ...]) -> Iterator[tuple[tuple[bytes, ...], tuple[bytes, ...]]]:
    """(first part, rest) of a language's phrase, by rising length of the first part."""
    lang, words = gram[:1], gram[1:]
    return ((lang + words[:k], lang + words[k:]) for k in range(1, len(words)))


def candidates(counts: DataFrame, bounds: list[tuple[bytes, ...]], min_count: int = MIN_COUNT) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of every phrase of at least two words, and ``inner``: the phrases with one word
    less that have its count."""
    spark = counts.sparkSession
    shared = spark.sparkContext.broadcast(bounds)
    n_parts = len(bounds) + 1

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, asker in enumerate(batch.column("part").to_pylist()):
                parts: dict[tuple[bytes, ...], int] = {}
                for gram, weight in Automaton.read(batch, i).items():
                    if weight and len(gram) > 2:
                        parts[gram[:1]] = 1
                        for pair in _cuts(gram):
                            parts.update(dict.fromkeys(pair, 1))
                if parts:
                    asked = Automaton.of(parts)
                    paths = asked.paths()[asked.weights > 0]
                    for r, part in _parts(asked.words, paths, np.ones(len(paths), np.int64), shared.value):
                        yield _record({"part": r, "asker": asker}, part)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, known = None, {}
        for batch in batches:
            for i, (r, asker) in enumerate(zip(batch.column("part").to_pylist(), batch.column("asker").to_pylist())):
                automaton = Automaton.read(batch, i)
                if asker < 0:
                    now, known = r, dict(automaton.items())
                elif r == now:
                    found = {g: known[g] for g, wanted in automaton.items() if wanted and known.get(g)}
                    if found:
                        yield _record({"part": asker, "asker": 0}, Automaton.of(found))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, now, known = None, None, {}

        def done() -> Iterator[pa.RecordBatch]:
            out: list[tuple] = []
            for gram, a in own.items():
                if not a or len(gram) < 3:
                    continue
                n = known[gram[:1]]
                at_most, l, r = min(((1000 * a * n // (known[x] * known[y]), known[x], known[y]) for x, y in _cuts(gram)),
                                    key=lambda cut: cut[0])      # the first of equals: the smallest cut
                inner = [b" ".join(g[1:]).decode() for g in (gram[:-1], gram[:1] + gram[2:]) if len(g) > 2 and known[g] == a]
                out.append((gram[0].decode(), b" ".join(gram[1:]).decode(), a, l, r, n, at_most, inner))
            for at in range(0, len(out), 5000):
                columns = list(zip(*out[at:at + 5000]))
                kinds = [pa.string(), pa.string(), *[pa.int64()] * 5, pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                 ["lang", "phrase", "a", "l", "r", "n", "score", "inner"])

        for batch in batches:
            for i, (r, asker) in enumerate(zip(batch.column("part").to_pylist(), batch.column("asker").to_pylist())):
                if r != now and own is not None:
                    yield from done()
                if r != now:
                    own, now, known = None, r, {}
                if asker < 0:
                    own = Automaton.read(batch, i)
                else:
                    known.update((g, w) for g, w in Automaton.read(batch, i).items() if w)
        if own is not None:
            yield from done()

    def dealt(rows: DataFrame) -> DataFrame:
        return (counts.select("part", F.lit(-1).alias("asker"), *_NAMES).unionByName(rows)
                .repartition(n_parts, "part").sortWithinPartitions("part", "asker"))

    kind = f"part int, asker int, {AUTOMATON}"
    answers = dealt(counts.mapInArrow(ask, kind)).mapInArrow(answer, kind)
    scored = dealt(answers).mapInArrow(score, "lang string, phrase string, a long, l long, r long, n long, score long, "
                                              "inner array<string>")
    return stored(scored, "collocations")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT,
                 top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of every language."""
    found = candidates(*count_transducers(docs, text, lang, min_count), min_count)
    within = found.select("lang", F.explode("inner").alias("phrase")).distinct()
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = (found.drop("inner").join(within, ["lang", "phrase"], "left_anti")
              .withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top))
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
n AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS s FROM w),
f AS (SELECT lang, k, array_to_string(list_slice(w, s, s + k - 1), ' ') AS g, count(*)::HUGEINT AS f
      FROM g, (SELECT unnest(range(1, 6)) AS k) WHERE s + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, k, g, f, string_split(g, ' ') AS words FROM f WHERE k > 1),
cuts AS (SELECT c.lang, c.g, c.k, c.f AS a, i, array_to_string(c.words[1:i], ' ') AS x, array_to_string(c.words[i + 1:], ' ') AS y
         FROM c, (SELECT unnest(range(1, 5)) AS i) WHERE i < k),
scored AS (SELECT cuts.lang, cuts.g, cuts.k, a, i, fx.f AS l, fy.f AS r, n, (1000 * a * n) // (fx.f * fy.f) AS score
           FROM cuts JOIN f fx ON fx.lang = cuts.lang AND fx.g = x AND fx.k = i
                     JOIN f fy ON fy.lang = cuts.lang AND fy.g = y AND fy.k = cuts.k - i JOIN n ON n.lang = cuts.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, i) = 1),
dropped AS (SELECT DISTINCT c.lang, array_to_string(c.words[s:s + m - 1], ' ') AS g, f
            FROM c, (SELECT unnest(range(2, 5)) AS m), (SELECT unnest(range(1, 5)) AS s) WHERE m < k AND s + m - 1 <= k),
kept AS (SELECT best.* FROM best WHERE NOT EXISTS (
           SELECT 1 FROM dropped d WHERE d.lang = best.lang AND d.g = best.g AND 100 * d.f >= 100 * best.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, g AS phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
       score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""
