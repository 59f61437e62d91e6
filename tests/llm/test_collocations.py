"""Collocations against plain counting; automata against dictionaries."""

import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from panelcast.llm import collocations as co

SCHEMA = "doc_id long, text string, lang string, phrase string, n long"


def brute(rows, min_count, top):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, 6):
                counts.setdefault(lang, Counter()).update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {g: a for g, a in f.items() if len(g) > 1 and a >= min_count}
        dropped = set()
        for g, a in found.items():
            for m in range(2, len(g)):
                for s in range(len(g) - m + 1):
                    if 100 * a >= 100 * f[g[s:s + m]]:
                        dropped.add(g[s:s + m])
        rows = []
        for g, a in found.items():
            if g not in dropped:
                score, _, l, r = min((1000 * a * totals[lang] // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]])
                                     for k in range(1, len(g)))
                rows.append((-score, -a, " ".join(g).encode(), l, r))
        out += [(lang, n, p.decode(), -a, l, r, totals[lang], -s) for n, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def found(spark, rows, min_count, top=2000, parts=3):
    docs = spark.createDataFrame([(1, t, lang, "x", 0) for t, lang in rows], SCHEMA).repartition(parts)
    return sorted(tuple(r) for r in co.collocations(docs, min_count=min_count, top=top).collect())


@pytest.fixture()
def small(monkeypatch):
    """Many chunks and unions of few words."""
    monkeypatch.setattr(co, "CHUNK_WORDS", 40)
    monkeypatch.setattr(co, "UNION_STATES", 30)
    monkeypatch.setattr(co, "RANGE_WORDS", 25)


TEXT = st.lists(st.sampled_from(["a", "B", "b", "cc", "é", "日本", "A.", "b,", "zz\n", "\t", "x\x0b"]), max_size=30).map(" ".join)
ROWS = st.lists(st.tuples(st.one_of(st.none(), TEXT), st.sampled_from([None, "und", "en", "", "a", "line\nend"])), max_size=14)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=ROWS, min_count=st.integers(1, 4))
def test_equals_plain_counting(spark, small, rows, min_count):
    assert found(spark, rows, min_count) == brute(rows, min_count, 2000)


def test_limits_ties_long_texts_and_full_counters(spark, monkeypatch):
    rows = [(" ".join(f"w{(i * j) % 7}" for i in range(60)) + ".", "en") for j in range(1, 12)]
    rows += [("up and down " * 30_000, "en"), ("l" * 200_000 + " " + "l" * 200_000, "de")] + [("never again", "de")] * 300
    whole = brute(rows, 100, 5)
    assert found(spark, rows, 100, 5) == whole
    # Where every counter is live the results are the same.
    monkeypatch.setattr(co, "BUCKETS", 1 << 17)
    monkeypatch.setattr(co, "live_lengths", lambda bits, words, lang, codes, real=co.live_lengths: real(bits | 255, words, lang, codes))
    monkeypatch.setattr(co, "CHUNK_WORDS", 5_000)
    assert found(spark, rows, 100, 5) == whole
    assert found(spark, rows, 300, 5) == brute(rows, 300, 5)       # counters of four bytes


def test_empty_tables(spark):
    assert found(spark, [], 1) == found(spark, [(None, None), ("", "en"), (" . ", "en")], 1) == []


def test_products_beyond_64_bits():
    """1000 * a * n passes 64 bits from about 10^8 occurrences on; the arithmetic is that of Python's integers."""
    a, n = 10 ** 9, 10 ** 12
    assert (1000 * a * n) // (a * a) == 10 ** 6


GRAMS = st.dictionaries(st.lists(st.sampled_from([b"a", b"b", b"ab", b"\xc3\xa9"]), min_size=1, max_size=6).map(tuple),
                        st.integers(1, 9), min_size=1, max_size=40)


@settings(max_examples=60, deadline=None)
@given(a=GRAMS, b=GRAMS, bounds=st.lists(st.lists(st.sampled_from([b"a", b"aa", b"c"]), min_size=1, max_size=6).map(tuple), max_size=4))
def test_automata_union_and_cut(a, b, bounds):
    one, two = co.Automaton.of(a), co.Automaton.of(b)
    assert {g: w for g, w in one.items() if w} == a
    whole = co.Automaton.union([one, two])
    total = dict(Counter(a) + Counter(b))
    assert {g: w for g, w in whole.items() if w} == total
    assert [g for g, _ in whole.items()] == sorted({g[:k] for g in total for k in range(1, len(g) + 1)})
    bounds = sorted(set(bounds))
    keep = whole.weights > 0
    parts = dict(co._parts(whole.words, whole.paths()[keep], whole.weights[keep], bounds))
    for r, part in parts.items():
        for gram, weight in part.items():
            if weight:
                assert (r == 0 or bounds[r - 1] <= gram) and (r == len(bounds) or gram < bounds[r])
    assert sum((Counter({g: w for g, w in p.items() if w}) for p in parts.values()), Counter()) == Counter(total)


def test_a_hot_prefix_is_in_several_ranges(spark, monkeypatch):
    """A third of all n-grams begin with one word: the bounds split them."""
    monkeypatch.setattr(co, "RANGE_WORDS", 500)
    rng = np.random.default_rng(1)
    rows = [(" . ".join(f"hot w{x}" for x in rng.integers(0, 90, 60)), "en") for _ in range(200)]
    docs = spark.createDataFrame([(1, t, lang, "x", 0) for t, lang in rows], SCHEMA)
    counts, bounds = co.count_transducers(docs, min_count=10)
    sizes = Counter({r.part: len(r.depths) for r in counts.collect()})
    assert len(sizes) > 5 and max(sizes.values()) < sum(sizes.values()) / 3
    assert found(spark, rows, 10) == brute(rows, 10, 2000)


def test_ranges_are_bounded_by_distinct_ngrams():
    """An n-gram that makes up most of the sample is one entry, so the others are still dealt into ranges."""
    bits = np.full((co.BUCKETS + co.BUCKETS // 2) // 8, 255, np.uint8)
    sample = [(b"en", b"often")] * 1000 + [(b"en", b"w%02d" % n) for n in range(20)]
    assert len(co.range_bounds(bits, sample, 8)) == 7


def test_union_of_many_parts():
    parts = [co.Automaton.of({(b"en", b"w%d" % (n % 7)): 1, (b"en", b"a", b"b%d" % n): 2}) for n in range(50)]
    whole = {g: w for g, w in co.Automaton.union(parts).items() if w}
    assert sum(whole.values()) == 150 and len(whole) == 57 and whole[b"en", b"w0"] == 8
