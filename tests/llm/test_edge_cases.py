"""Nulls, empty and very long texts, repeated rows, empty tables and clashing column names, for every operator."""

import hashlib

import pytest
from pyspark.sql import functions as F

from panelcast.llm import (bpe, collocations, decontaminate, exact_dedup, language, lexical, line_dedup, metric_join, near_dedup,
                           preference, substrings, toxicity, warc)

LONG = "word " * 60_000 + "w" * 200_000
TEXTS = [(1, "one two three four five six seven"), (1, "one two three four five six seven"), (1, "another text of this id"), (2, None),
         (3, ""), (4, LONG), (5, LONG + " end"), (None, "no id here"), (None, None)]
# Names that the operators use for columns of their own.
CLASHES = ["id", "text_", "node", "row", "salt", "__row", "__id", "cells", "n", "score", "version", "doc", "places", "a", "b", "size", "keep_id"]


@pytest.fixture()
def docs(spark):
    rows = spark.createDataFrame(TEXTS, "doc_id long, text string").withColumn("lang", F.lit("en"))
    return rows.select("*", *[F.lit("clash").alias(c) for c in CLASHES]).repartition(3)


@pytest.fixture()
def items(spark):
    return spark.createDataFrame([(1, "two three four"), (None, "x"), (2, None), (1, "")], "item_id long, text string").withColumn("doc_id", F.lit(0))


@pytest.fixture()
def labels(spark):
    return spark.createDataFrame([(1, 1), (4, 0), (None, 1), (5, None)], "doc_id long, toxic int").withColumn("text", F.lit("x"))


def run(docs, items, labels):
    vocabulary = bpe.default_vocabulary()
    return {
        "exact": lambda: exact_dedup.dedup_report(docs), "kept": lambda: exact_dedup.exact_dedup(docs),
        "bpe": lambda: bpe.round_trip(docs, *vocabulary), "near": lambda: near_dedup.near_duplicates(docs, shingle=2),
        "leaks": lambda: decontaminate.contamination(docs, items), "lines": lambda: line_dedup.line_report(docs),
        "line texts": lambda: line_dedup.line_dedup(docs), "spans": lambda: substrings.repeated_spans(docs),
        "cut": lambda: substrings.remove_repeated(docs), "toxic": lambda: toxicity.toxicity(docs, labels),
        "phrases": lambda: collocations.collocations(docs), "join": lambda: metric_join.jaccard_join(docs),
        "search": lambda: lexical.search(docs, items)}


NAMES = ["exact", "kept", "bpe", "near", "leaks", "lines", "line texts", "spans", "cut", "toxic", "phrases", "join", "search"]
ROWS = {"exact": 9, "kept": 6, "bpe": 9, "near": 9, "leaks": 9, "lines": 8, "line texts": 9, "cut": 9, "toxic": 9, "join": 9}


@pytest.mark.parametrize("name", NAMES)
def test_every_case_has_a_result(docs, items, labels, name):
    out = run(docs, items, labels)[name]()
    rows = out.collect()
    assert len(rows) == ROWS.get(name, len(rows))
    if name in ("kept", "line texts", "cut"):
        assert out.columns == docs.columns and all(r["__row"] == "clash" and r.salt == "clash" for r in rows)
    if name == "exact":
        assert sum(r.kept for r in rows) == 6 and {r.keep_id for r in rows if r.text_sha256 == hashlib.sha256(b"").hexdigest()} == {3}
    if name == "bpe":
        assert [r.n_tokens for r in rows if r.doc_id in (2, 3)] == [0, 0] and sum(r.doc_id is None for r in rows) == 2
    if name in ("near", "join"):
        # The repeated word makes one shingle, so the two long texts share two of three.
        assert {r.component_id for r in rows if r.doc_id in (4, 5)} == {4, 5} and {r.n_shingles for r in rows if r.doc_id in (2, 3)} == {0}
    if name == "leaks":
        assert sum(r.contaminated for r in rows) == 2
    if name == "lines":
        assert {tuple(r.refers_to) for r in rows} == {(), (1,)} or all(r.refers_to is not None for r in rows)
    if name == "spans":
        assert {(r.doc_id, r.kept) for r in rows} == {(4, True), (5, False)}
    if name == "toxic":
        assert all(0 <= r.score <= 1 for r in rows)
    if name == "phrases":
        assert {r.phrase for r in rows} == {" ".join(["word"] * k) for k in range(2, 6)}
    if name == "search":
        assert [(r.item_id, r.rank, r.doc_id) for r in rows] == [(1, 1, 1), (1, 2, 1)]


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(docs, items, labels, name):
    assert run(docs.limit(0), items, labels)[name]().collect() == []
    if name in ("leaks", "toxic", "search"):
        rows = run(docs, items.limit(0), labels.limit(0))[name]().collect()
        assert len(rows) == (0 if name == "search" else 9)


PAGES = "page_id long, url string, html string, host string, declared string, salt string, payload string"


def test_pages_of_every_kind(spark, tmp_path):
    rows = [(1, "http://a.de/x", "<html lang='de'>" + "der die das " * 50), (1, "http://a.de/x", "<html lang='de'>" + "der die das " * 50),
            (2, None, None), (3, "", ""), (None, "http://b.fr", "le la"), (4, "http://b.fr/y", "<!--" * 100_000), (5, "x", "z" * 500_000)]
    pages = spark.createDataFrame([(*r, "h", "d", "s", "p") for r in rows], PAGES)
    docs = spark.createDataFrame([(1, "der die das", "de"), (2, "le la les", "fr"), (3, None, "fr"), (4, "x", None)], "doc_id long, text string, lang string")
    found = language.identify(pages, docs).collect()
    assert len(found) == 7 and {r.lang for r in found if r.page_id == 1} == {"de"}
    assert language.identify(pages.limit(0), docs).collect() == [] and len(language.identify(pages, docs.limit(0)).collect()) == 7
    manifest = warc.write_archives(pages, str(tmp_path)).collect()
    assert sum(r.records for r in manifest) == 7
    records, gaps = warc.read_archives(spark, str(tmp_path))
    got = records.collect()
    assert len(got) == 7 and gaps.count() == 0 and sum(r.payload_bytes for r in got) == sum(len(h or "") for _, _, h in rows)
    assert warc.write_archives(pages.limit(0), str(tmp_path / "none")).collect() == []


def test_many_small_members_are_read_in_linear_time():
    import time
    member = warc._gzip(warc.record_bytes({"WARC-Type": "resource", "WARC-Record-ID": "<urn:x>"}, b"x" * 500))
    began = time.process_time()
    assert len(warc.salvage(member * 16_000).records) == 16_000
    assert time.process_time() - began < 8


@pytest.mark.parametrize("html", ["<!--" * 250_000, "<script>" * 125_000, "<" * 1_000_000, "<style </style" * 70_000])
def test_hostile_pages_are_read_in_linear_time(html):
    import time
    began = time.process_time()
    language.visible_text(html)
    assert time.process_time() - began < 5


def test_conversations_of_every_kind(spark):
    rows = [(0, 0, "user", "hi"), (0, 1, "assistant", None), (1, 0, "user", "hi"), (1, 1, "assistant", LONG), (2, None, None, ""),
            (None, 0, "user", "lost"), (0, 0, "user", "hi")]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("pair_id", F.lit("x")).withColumn("side", F.lit("y"))
    found = {r.pair_id: r for r in preference.preference_rows(preference.adjacent_pairs(turns)).collect()}
    assert found[0].status == "pair" and found[0].n_prompt_turns == 1 and len(found[0].rejected) > len(LONG) and found[1].status == "unpaired"
    assert preference.preference_rows(preference.adjacent_pairs(turns.limit(0))).collect() == []


def test_all_code_points_are_split_as_the_library_does():
    """Every code point as ``chr(i) + "'s"``, ``"a" + chr(i)`` and ``chr(i) + "1"``."""
    import tiktoken
    path, pattern = bpe.default_vocabulary()
    raw = bpe.read_ranks(path)
    codec = bpe.Codec(bpe.Ranks(raw), pattern)
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=raw, special_tokens={})
    points = [i for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    # Many in one text, each alone between line ends, so that the library is called some hundred times only.
    for form in ("{}'s", "a{}", "{}1"):
        for at in range(0, len(points), 4000):
            text = "\n".join(form.format(chr(i)) for i in points[at:at + 4000])
            assert codec.encode([text])[0] == library.encode_ordinary(text)
