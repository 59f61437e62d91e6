"""Ranked lexical search against a plain ranking of every document."""

import math
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelcast.llm import lexical

DOCS = "doc_id long, text string, item long, score string, terms string"
ITEMS = "item_id long, text string, doc_id string"


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, items, k):
    of_doc = [(d, words(t)) for d, t in docs]
    of_doc = [(d, w) for d, w in of_doc if w]
    n_docs, n_words = len(of_doc), sum(len(w) for _, w in of_doc)
    of_item = {}
    for i, t in items:
        of_item.setdefault(i, set()).update(words(t))
    out = []
    for i, terms in of_item.items():
        rows = []
        for d, w in of_doc:
            m = 10 + 90 * len(w) * n_docs // n_words
            score = 0
            for t in terms & set(w):
                df = sum(t in set(x) for _, x in of_doc)
                tf = w.count(t)
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * (1000000000 * tf // (1000 * tf + 8 * m))
            if score > 0:
                rows.append((-score, d is None, d or 0))
        out += [(i, n, None if none else d, -s) for n, (s, none, d) in enumerate(sorted(rows)[:k], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, k=10, **how):
    d = spark.createDataFrame([(a, b, 0, "x", "y") for a, b in docs], DOCS).repartition(3)
    i = spark.createDataFrame([(a, b, "z") for a, b in items], ITEMS)
    return sorted((tuple(r) for r in lexical.search(d, i, k, **how).collect()), key=repr)


VOCABULARY = ["a", "B", "b", "cc", "é", "É", "7", "zz9", "日本", "of"]
TEXT = st.one_of(st.none(), st.lists(st.sampled_from(VOCABULARY), max_size=12).map("-- ".join))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(docs=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 30)), TEXT), max_size=25),
       items=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), TEXT), max_size=4), k=st.integers(1, 4))
def test_equals_a_plain_ranking(spark, docs, items, k):
    assert found(spark, docs, items, k) == brute(docs, items, k)


def test_many_terms_ties_blocks_and_segments(spark, monkeypatch):
    docs = [(n, " ".join(f"w{(n * j) % 97}" for j in range(1, 40 + n % 5))) for n in range(60)]
    docs += [(n + 100, docs[n][1]) for n in range(60)] + [(None, docs[3][1]), (None, None), (7, docs[3][1])]
    items = [(i, " ".join(f"W{(i * 31 + j) % 120}" for j in range(50))) for i in range(7)]
    whole = brute(docs, items, 10)
    assert found(spark, docs, items) == whole
    assert found(spark, docs, items, block_terms=20) == whole
    monkeypatch.setattr(lexical, "BITS", 64)
    monkeypatch.setattr(lexical, "SEGMENT_DOCS", 5)
    assert found(spark, docs, items) == whole


def test_a_very_long_text_and_a_very_long_item(spark):
    docs = [(1, "x y " * 150_000 + "needle"), (2, "needle x"), (3, "y"), (4, ""), (5, None), (6, "n" * 100_000)]
    items = [(1, "needle"), (2, " ".join(f"t{n}" for n in range(30_000)) + " y"), (3, "n" * 100_000), (4, "")]
    assert found(spark, docs, items) == brute(docs, items, 10)


def test_empty_tables(spark):
    one = [(1, "a b")]
    assert found(spark, [], one) == found(spark, one, []) == found(spark, [], []) == []


def test_the_best_are_found_without_scoring_every_document(spark):
    """Groups are scored by descending possible score and left as soon as it is safe."""
    import numpy as np
    import pyarrow as pa
    n = 2000
    docs = np.repeat(np.arange(n), 2)
    terms = np.where(np.arange(2 * n) % 2 == 0, 0, 1 + docs % 7)       # one common term, one of seven
    order = np.lexsort((docs, terms))
    kinds, counts = np.unique(terms, return_counts=True)
    columns = [np.full(n, 50, np.int64), kinds.astype(np.int32), counts.astype(np.int32),
               docs[order].astype(np.int32), np.ones(2 * n, np.int64)]
    row = pa.RecordBatch.from_arrays([pa.array([list(range(n))]), *(pa.array([c.tobytes()], pa.binary()) for c in columns)],
                                     ["ids", "lengths", "terms", "counts", "docs", "tfs"])
    stats = lexical.Statistics(n, 50 * n, dict(zip(kinds.tolist(), counts.tolist())), 8)
    segment = lexical.Segment(row, 0, stats)
    scored = []
    exact = segment.scores
    segment.scores = lambda rows, held, docs: scored.append(len(docs)) or exact(rows, held, docs)
    best = segment.best([0, 3], [], 10)
    assert [d for _, _, d in best] == [2 + 7 * j for j in range(10)]
    assert sum(scored) <= counts[3]


def test_keys_must_be_integers(spark):
    import pytest
    docs = spark.createDataFrame([("a", "b")], "doc_id string, text string")
    items = spark.createDataFrame([(1, "b")], "item_id long, text string")
    with pytest.raises(TypeError):
        lexical.search(docs, items)
    assert lexical.search(docs.select(F.lit(1).cast("int").alias("doc_id"), "text"), items).dtypes[2] == ("doc_id", "int")
