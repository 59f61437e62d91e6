"""The metric-space join against all pairs."""

import random
import re

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelcast.llm import metric_join as mj

SCHEMA = "doc_id long, text string, node string, cell long, n long"


def shingle_set(text, size):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(rows, shingle=3, similarity=90):
    sets = [shingle_set(t, shingle) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        known = least.get(find(i))
        least[find(i)] = d if known is None else known if d is None else min(known, d)
    return sorted(((d, len(s), least[find(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def found(spark, rows, **how):
    docs = spark.createDataFrame([(d, t, "x", 0, 0) for d, t in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in mj.jaccard_join(docs, **how).collect()), key=repr)


def copies(seed, groups, size, edits, words=120):
    """Groups of near copies: each copy replaces up to ``edits`` words of its group's text."""
    rng, out = random.Random(seed), []
    for g in range(groups):
        base = [f"g{g}w{rng.randrange(10 ** 6)}" for _ in range(words)]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randrange(edits + 1)):
                text[rng.randrange(words)] = f"e{rng.randrange(10 ** 6)}"
            out.append(" ".join(text[rng.randrange(4):]))
    return out


def test_groups_of_near_copies_at_every_distance(spark):
    texts = copies(1, 4, 40, 9) + ["", None, " \t", "a", "A", "a b", "a b c", "a b c d"] + ["same text here now"] * 5
    rows = [(n * 7 % 1009, t) for n, t in enumerate(texts)]
    rows += [(None, texts[0]), (None, None), (3, texts[50]), (3, "another text of this id")]
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("shingle, similarity", [(2, 80), (1, 50), (5, 80), (3, 95)])
def test_other_thresholds(spark, shingle, similarity):
    rows = list(enumerate(copies(2, 5, 16, 12, words=60)))
    assert found(spark, rows, shingle=shingle, similarity=similarity) == brute(rows, shingle, similarity)


def test_recursion_into_rings(spark, monkeypatch):
    """Cells of more than three rows are divided around pivots, as often as it takes."""
    monkeypatch.setattr(mj, "LEAF", 3)
    monkeypatch.setattr(mj, "ROUNDS", 4)
    monkeypatch.setattr(mj, "SMALLER", 0.9)
    rows = list(enumerate(copies(3, 2, 60, 14)))
    assert found(spark, rows) == brute(rows)


def test_long_texts_and_clashing_columns(spark):
    long = " ".join(f"w{n}" for n in range(120_000))
    rows = [(1, long), (2, long + " and a little more"), (3, "x" * 300_000), (4, "x" * 300_000), (5, long[:400_000])]
    assert found(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert found(spark, []) == []


SIZES = st.integers(1, 400)


@settings(max_examples=300, deadline=None)
@given(SIZES, st.integers(0, 60), st.integers(0, 60), st.sampled_from([50, 80, 90, 95]), st.integers(0, 10 ** 9))
def test_similar_sets_share_a_cell(common, left, right, similarity, seed):
    """The cells lose no pair that reaches the similarity."""
    values = np.random.default_rng(seed).choice(1 << 60, common + left + right, replace=False).astype(np.uint64)
    a, b = np.sort(values[:common + left]), np.sort(np.concatenate([values[:common], values[common + left:]]))
    if left + right and 100 * common >= similarity * (common + left + right):
        shells = mj.Shells(similarity)
        assert len(np.intersect1d(mj.cells_of(a, shells), mj.cells_of(b, shells)))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 100), st.integers(1, 100)), min_size=2, max_size=30), st.sampled_from([80, 90, 95]))
def test_near_rows_meet_in_a_ring(spark, fractions, similarity):
    """Two rows whose distances from the pivot differ by no more than the allowed distance share a ring."""
    rows = [(1, n + 1, 9, 1, 0, min(c, t), t) for n, (c, t) in enumerate(fractions)]
    cells = spark.createDataFrame([(1, 0, 9, 1, 0, 5)] + [(1, r[1], 9, 1, 0, 5) for r in rows],
                                  "cell long, nid long, n long, root long, pivot long, size long")
    near = spark.createDataFrame([(0, r[1], r[5], r[6]) for r in rows], "a long, b long, common long, total long")
    homes = {}
    for r in mj.rings(cells, near, similarity, 0).collect():
        homes.setdefault(r.nid, set()).add(r.cell)
    from fractions import Fraction
    far = {r[1]: 1 - Fraction(r[5], r[6]) for r in rows} | {0: Fraction(0)}
    for a in far:
        for b in far:
            if abs(far[a] - far[b]) <= Fraction(100 - similarity, 100):
                assert homes[a] & homes[b]


def test_rows_without_text_hash_clash(spark):
    """A set is fetched from a row with its id and text, whatever else has that id."""
    base = copies(5, 1, 6, 1)
    rows = [(1, t) for t in base] + [(None, t) for t in base]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("place", F.lit(0))
    assert sorted((tuple(r) for r in mj.jaccard_join(docs).collect()), key=repr) == brute(rows)


def test_hubs_bound_the_pairs_of_a_large_group(spark):
    """A cell's rows meet at most HUBS others of it, whatever its size; folds lose no pair that the sketches allow."""
    sets = [np.arange(n, n + 200, dtype=np.uint64) for n in range(60)]
    rows = spark.createDataFrame([(1, n, 200, n) for n in range(60)], "cell long, nid long, n long, root long")
    sketches = spark.createDataFrame([(n, mj.parity_sketch(s).tolist()) for n, s in enumerate(sets)], "nid long, sketch array<long>")
    pairs = {(r.a, r.b) for r in mj.hub_pairs(rows, sketches, 90, 0).collect()}
    hubs = {a for a, _ in pairs}
    assert 0 < len(hubs) <= mj.HUBS < 60
    assert pairs >= {(a, b) for a in hubs for b in range(60) if a != b and 100 * (200 - abs(a - b)) >= 90 * (200 + abs(a - b))}


def test_rows_of_many_cells_share_their_hubs(spark):
    """The pairs grow with the rows, not with the cells that they share, and the links from them are nearly as few as the rows."""
    sets = [np.arange(n, n + 900, dtype=np.uint64) for n in range(40)]
    cells = [(c, n, 900, n) for n in range(40) for c in range(12) if (n + c) % 5]
    rows = spark.createDataFrame(cells, "cell long, nid long, n long, root long")
    sketches = spark.createDataFrame([(n, mj.parity_sketch(s).tolist()) for n, s in enumerate(sets)], "nid long, sketch array<long>")
    pairs = mj.hub_pairs(rows, sketches, 90, 0).distinct()
    met = [(r.a, r.b) for r in pairs.collect()]
    assert {b for _, b in met} == set(range(40))
    assert len(met) <= mj.HUBS * 40
    few = [(r.a, r.b) for r in mj.contracted(pairs).collect()]
    hubs = {a for a, _ in met}
    assert len(few) <= 40 + len(hubs) ** 2
    assert reached(few) == reached(met)


def test_contracted_links_keep_the_components(spark):
    rng = random.Random(7)
    links = [(rng.randrange(12), rng.randrange(60)) for _ in range(90)] + [(100, 101), (101, 102), (3, 3), (100, 101)]
    few = [(r.a, r.b) for r in mj.contracted(spark.createDataFrame(links, "a long, b long")).collect()]
    assert reached(few) == reached(links)
    assert mj.contracted(spark.createDataFrame([], "a long, b long")).isEmpty()


def reached(links):
    """The components of links, as sorted lists of their nodes."""
    home = {n: {n} for link in links for n in link}
    for a, b in links:
        if home[a] is not home[b]:
            home[a] |= home[b]
            for n in home[b]:
                home[n] = home[a]
    return sorted({tuple(sorted(h)) for h in home.values()})
