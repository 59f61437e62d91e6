"""The corpus operators against brute force on small tables with nulls, ties, repeats and long texts."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

tiktoken = pytest.importorskip("tiktoken")
P = pytest.importorskip("public_tokenizers")

from panelcast.llm import (bpe, decontaminate, exact_dedup, language, line_dedup, near_dedup, preference,  # noqa: E402
                           substrings, toxicity, warc)
from panelcast.llm.common import alnum_words, space_words  # noqa: E402

RND = random.Random(7)
VOCABULARY = [a + b for a in ("al", "be", "cor", "du", "é") for b in ("ta", "ni", "sk", "rö", "m")]


def words(n, rnd=RND):
    return " ".join(rnd.choice(VOCABULARY) + rnd.choice(VOCABULARY) for _ in range(n))


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")


EDGES = [(1, None), (2, ""), (3, "  \n\t"), (4, "one"), (5, "ONE"), (5, "ONE"), (None, "one"), (None, None), (6, "É x"), (7, "é x")]


# ---- 2 -------------------------------------------------------------------------------------------

@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda c: F.substring(F.sha2(c.cast("binary"), 256), 1, 1)])
def test_exact_dedup_compares_contents_not_digests(spark, digest):
    rows = EDGES + [(10 + i, RND.choice(("Hot text", "hot TEXT", f"cold {i}"))) for i in range(60)]
    got = exact_dedup.dedup_report(documents(spark, rows), digest=digest, salts=3).collect()
    norm = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    want = []
    for i, t in rows:
        ids = groups[norm(t)]
        keep = max((x for x in ids if x is not None), default=None)
        want.append((i, keep, len(ids), hashlib.sha256(norm(t).encode()).hexdigest()))
    key = lambda x: tuple(str(v) for v in x)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=key) == sorted(want, key=key)
    assert sum(r.kept for r in got) == len(groups)
    kept = exact_dedup.exact_dedup(documents(spark, rows), digest=digest, salts=3).collect()
    assert len(kept) == len(groups) and len({norm(r.text) for r in kept}) == len(groups)


def test_exact_dedup_keeps_columns_whose_names_clash(spark):
    df = documents(spark, EDGES).withColumns({"__d": F.lit(1), "keep_id": F.lit("x"), "text_sha256": F.lit("y")})
    out = exact_dedup.exact_dedup(df)
    assert out.columns == df.columns and out.count() == 5
    assert exact_dedup.exact_dedup(df.limit(0)).count() == 0


# ---- 3 -------------------------------------------------------------------------------------------

def test_bpe_equals_the_library_and_round_trips(spark):
    path, pattern = bpe.default_vocabulary()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    texts = [None, "", " ", "a\x1c b \n\n c's 12½", "漢字かな 🎉🎉", "x" * 20_000, words(500),
             "".join(RND.choice("ab é\n1'") for _ in range(3000))]
    docs = documents(spark, list(enumerate(texts)))
    got = {r.doc_id: r for r in bpe.round_trip(docs, path, pattern, keep_ids=True).collect()}
    for i, t in enumerate(texts):
        ids = library.encode_ordinary(t or "")
        assert got[i].ids == ids and got[i].n_tokens == len(ids)
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    back = bpe.decode(bpe.encode(docs, path, pattern), path, pattern).collect()
    assert {r.doc_id: bytes(r.text).decode() for r in back} == {i: t or "" for i, t in enumerate(texts)}


# ---- 5 -------------------------------------------------------------------------------------------

def test_near_duplicates_equal_all_pairs(spark):
    rows = list(EDGES)
    for base in range(8):
        text = words(60).split()
        for copy in range(12):
            other = list(text)
            for _ in range(RND.randint(0, 6)):
                other[RND.randrange(len(other))] = words(1)
            rows.append((100 * base + copy + 50, " ".join(other)))
    sets = []
    for _, t in rows:
        w = space_words(t)
        sets.append({tuple(w[k:k + 2]) for k in range(max(len(w) - 1, min(len(w), 1)))})
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    least = {}
    for x, (i, _) in enumerate(rows):
        if i is not None:
            least[find(x)] = min(i, least.get(find(x), i))
    want = sorted(str((i, len(sets[x]), least.get(find(x)) if sets[x] else i)) for x, (i, _) in enumerate(rows))
    got = near_dedup.near_duplicates(documents(spark, rows), shingle=2).collect()
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in got) == want
    assert near_dedup.near_duplicates(documents(spark, rows).limit(0)).count() == 0


# ---- 6 -------------------------------------------------------------------------------------------

def test_contamination_equals_a_scan(spark):
    bench = [(1, words(25)), (2, "Tiny item"), (3, None), (4, "..."), (None, words(12)), (1, words(15))]
    rows = [*EDGES, (20, words(30) + " " + bench[0][1][:160] + " " + words(10)), (21, "a tiny, ITEM! b tiny"),
            (22, bench[4][1]), (23, words(3000))]
    items = spark.createDataFrame(bench, "item_id long, text string")
    want = []
    for i, t in rows:
        w, hit, names = alnum_words(t), set(), set()
        for item, text in bench:
            for phrase in decontaminate.windows_of(alnum_words(text), 10):
                for at in range(len(w) - len(phrase) + 1):
                    if tuple(w[at:at + len(phrase)]) == phrase:
                        hit.update(range(at, at + len(phrase)))
                        names |= {str(item)} if item is not None else set()
        want.append(str((i, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest())))
    for block_words in (decontaminate.BLOCK_WORDS, 10):
        got = decontaminate.contamination(documents(spark, rows), items, block_words=block_words, segment_words=200).collect()
        assert sorted(str((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256)) for r in got) == sorted(want)


def test_proximity_search_allows_slop(spark):
    index = decontaminate.build_index(documents(spark, [(1, "the quick brown lazy fox"), (2, "quick fox"), (3, "fox quick")]))
    items = spark.createDataFrame([(1, "quick fox")], "item_id long, text string")
    near = decontaminate.search(index, items, slop=2).where("size(items) > 0").collect()
    assert "2" in {r.doc for r in near} and "2" == {r.doc for r in decontaminate.search(index, items).where("size(items) > 0").collect()}.pop()


# ---- 7 -------------------------------------------------------------------------------------------

def test_warc_round_trip_with_revisits(spark, tmp_path):
    pages = spark.createDataFrame([(3, "http://a/", "same"), (1, "http://b/", "same"), (2, None, None), (4, "u", ""), (None, "v", "same")],
                                  "page_id long, url string, html string")
    assert warc.write_archives(pages, f"file://{tmp_path}/w", archive_bytes=1).count() == 5
    records, gaps = warc.read_archives(spark, f"file://{tmp_path}/w")
    got = {r.page_id: (r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in records.collect()}
    same, empty = warc.sha1_base32(b"same"), warc.sha1_base32(b"")
    assert got == {"1": ("response", None, 4, same), "3": ("revisit", "1", 4, same), None: ("revisit", "1", 4, same),
                   "2": ("response", None, 0, empty), "4": ("revisit", "2", 0, empty)}
    assert gaps.count() == 0


@pytest.mark.parametrize("pack", [warc._gzip, lambda data: data])
def test_salvage_recovers_what_follows_the_damage(pack):
    members = [pack(warc.page_record(str(i), "http://x/", words(50).encode(), None)) for i in range(5)]
    data = bytearray(b"".join(members))
    start = len(members[0]) + len(members[1])
    at = start + len(members[2]) - 40
    data[at:at + 6] = b"\x00broke"
    found = warc.salvage(bytes(data))
    assert [r.headers["WARC-Record-ID"] for r in found.records] == [f"<urn:page:{i}>" for i in (0, 1, 3, 4)]
    assert [(a, b) for a, b, _ in found.gaps] == [(start, start + len(members[2]))]
    cut = warc.salvage(bytes(b"".join(members)[:-20]))
    assert len(cut.records) == 4 and cut.gaps[-1][1] == sum(map(len, members)) - 20
    assert warc.salvage(b"").records == [] and warc.salvage(b"no archive").gaps[0][:2] == (0, 10)


def _stored_member(data):
    z = zlib.compressobj(0, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


@pytest.mark.parametrize("pack", [warc._gzip, _stored_member])
def test_salvage_reads_on_inside_members(pack):
    records = [warc.page_record(str(i), "http://x/", words(2000).encode(), None) for i in range(5)]
    ends = list(itertools.accumulate(map(len, records)))
    ids = lambda found: [r.headers["WARC-Record-ID"][10:-1] for r in found.records]
    broken = bytearray(b"".join(records))
    broken[ends[2] - 40] ^= 1
    member, after = pack(bytes(broken)), warc._gzip(warc.page_record("9", "http://y/", b"z", None))
    found = warc.salvage(member + after)                                  # a bad record in an intact member
    assert ids(found) == ["0", "1", "3", "4", "9"]
    assert found.gaps == [(0, len(member), f"block digest differs, inflated bytes {ends[1]} to {ends[2]}")]
    whole = pack(b"".join(records))
    cut = warc.salvage(whole[:-40])                                       # a cut tail
    assert ids(cut) == ["0", "1", "2", "3"] and [g[:2] for g in cut.gaps] == [(0, len(whole) - 40)]
    both = warc.salvage(member[:-40] + after)                             # both, and a member behind them
    assert ids(both) == ["0", "1", "3", "9"] and {g[:2] for g in both.gaps} == {(0, len(member) - 40)} and len(both.gaps) == 2
    tail = warc.salvage(whole[:-8] + b"\0\0\0\0" + whole[-4:] + after)    # a wrong checksum, all records right
    assert ids(tail) == ["0", "1", "2", "3", "4", "9"] and [g[:2] for g in tail.gaps] == [(0, len(whole))]
    bad = bytearray(whole)
    bad[len(whole) * 7 // 10] ^= 0x55                                     # a wrong byte in the middle
    found = warc.salvage(bytes(bad) + after)
    assert ids(found)[:3] == ["0", "1", "2"] and ids(found)[-1] == "9" and len(set(ids(found))) == len(found.records)
    assert all(r.block in b"".join(records) + warc.page_record("9", "http://y/", b"z", None) for r in found.records)


# ---- 8 -------------------------------------------------------------------------------------------

def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def edited(text, n):
    chars = list(text)
    for _ in range(n):
        at = RND.randrange(len(chars) + 1)
        chars[at:at + RND.randint(0, 1)] = RND.choice(("", "z", "yé"))
    return "".join(chars)


def test_bounded_distance_is_the_edit_distance():
    for _ in range(3000):
        a = "".join(RND.choice("abc") for _ in range(RND.randint(0, 12)))
        b = edited(a, RND.randint(0, 4)) if a else "ab"
        for most in (1, 2, 3):
            d = distance(a, b)
            assert line_dedup.bounded_distance(a, b, most) == (d if d <= most else None)


def test_line_links_equal_all_pairs(spark):
    base = [words(6) for _ in range(12)]
    rows = [(i, "\n".join(edited(RND.choice(base), RND.randint(0, 3)) for _ in range(6)) + "\n\n") for i in range(20)] + EDGES
    docs = documents(spark, rows)
    lines = sorted({x for _, t in rows for x in line_dedup.lines_of(t) if len(x) >= line_dedup.MIN_CHARS})
    want = {frozenset((a, b)) for a, b in itertools.combinations(lines, 2) if distance(a, b) <= 2}
    by = {line_dedup._digest(x): x for x in lines}
    got = {frozenset((by[bytes(r.a)], by[bytes(r.b)])) for r in line_dedup.near_lines(docs).collect()}
    assert got == want and want
    report = line_dedup.line_report(docs).collect()
    assert all(r.n_lines == r.n_kept + r.n_copies + r.n_near for r in report)
    cleaned = line_dedup.line_dedup(docs).collect()
    assert sum(len([x for x in line_dedup.lines_of(r.text) if x]) for r in cleaned) >= sum(r.n_kept for r in report)


# ---- 9 -------------------------------------------------------------------------------------------

def test_repeated_passages_are_found_exactly(spark):
    passage = words(60)
    rows = [(i, words(80)) for i in range(10)] + [(50, words(33) + "  " + passage + "\n" + words(20)), (51, passage), (52, words(7) + " " + passage)]
    rows += [(60, words(30) + " " + " ".join(passage.split()[:30])), (None, passage), (61, None), (62, "")]
    docs = documents(spark, rows)
    got = {r.doc_id: (r.start_word, r.end_word, r.kept) for r in substrings.repeated_spans(docs).collect()}
    assert got == {50: (33, 93, True), 51: (0, 60, False), 52: (7, 67, False)}
    left = {r.doc_id: r.text for r in substrings.remove_repeated(docs).collect()}
    assert left[51] == "" and len(left[52].split()) == 7 and left[50] == rows[10][1] and left[61] is None


def brute_spans(rows, size):
    """Windows met in another document, laid over each other."""
    held = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - size + 1) if i is not None else ():
            held.setdefault(tuple(w[k:k + size]), set()).add((i, k))
    covered = {}
    for places in held.values():
        if len({i for i, _ in places}) > 1:
            for i, k in places:
                covered.setdefault(i, set()).update(range(k, k + size))
    return {(i, x) for i, words_ in covered.items() for x in words_}


def test_repeated_passages_equal_brute_force(spark):
    """A passage whose parts lie in other orders in smaller documents, long ones that go on elsewhere, one word over and over."""
    passage, long = words(66).split(), words(400).split()
    rows = [(1, " ".join([*passage[44:], *words(3).split(), *passage[22:44], *words(3).split(), *passage[:22]])),
            (2, words(20) + " " + " ".join(passage)), (3, " ".join(passage) + " " + words(9)),
            (4, " ".join(long[150:300])), (5, " ".join(long[:200])), (6, words(5) + " " + " ".join(long)), (7, " ".join(long) + " " + words(5)),
            (8, words(3) + " go" * 130), (9, "go " * 70 + words(4)), (10, "a b c " * 40), (11, words(2) + " b c a" * 30), (None, " ".join(long)), (12, None)]
    docs = documents(spark, rows)
    for size in (50, 7, 1):
        got = substrings.repeated_spans(docs, size).collect()
        assert {(r.doc_id, x) for r in got for x in range(r.start_word, r.end_word)} == brute_spans(rows, size)
    assert {2, 3} <= {r.doc_id for r in substrings.repeated_spans(docs).collect()}


def test_adjacent_passages_are_kept_once_each(spark):
    one, two, three = (words(60) for _ in range(3))
    tail = " ".join(one.split()[10:])
    rows = [(2, one), (5, one + " " + two), (9, words(4) + " " + two + " " + three), (11, three + " " + one), (12, tail + " " + words(70)),
            (20, words(5)), (30, " ".join(two.split()[5:]) + " " + words(3))]
    docs = documents(spark, rows)
    got = {(r.doc_id, r.start_word, r.end_word, r.first_doc_id, r.kept) for r in substrings.repeated_spans(docs).collect()}
    assert got == {(2, 0, 60, 5, True), (5, 0, 60, 2, False), (5, 60, 120, 9, True), (9, 4, 64, 5, False), (9, 64, 124, 11, True),
                   (11, 0, 120, 2, False), (12, 0, 50, 2, False), (30, 0, 55, 5, False)}
    left = " | ".join(r.text for r in substrings.remove_repeated(docs).collect())
    assert all(left.count(p) == 1 for p in (one, two, three))
    a, b = words(40), words(60)
    lapped = documents(spark, [(1, a + " " + b), (2, a + " " + b + " " + a), (3, words(2) + " " + b + " " + a)])
    got = {(r.doc_id, r.start_word, r.end_word, r.first_doc_id, r.kept) for r in substrings.repeated_spans(lapped).collect()}
    assert got == {(1, 0, 100, 2, True), (2, 0, 100, 1, False), (2, 100, 140, 3, True), (3, 2, 102, 1, False)}


# ---- 10 ------------------------------------------------------------------------------------------

def test_toxicity_is_learnt_and_held_out(spark):
    rows = [(i, words(40) + (f" grumpf{RND.choice(VOCABULARY)} " * 2 + words(10) if i % 5 == 0 else "")) for i in range(600)] + [(9000, None), (9001, "")]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(600)] + [(None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(got) == 602 and all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [(r.predicted, int(i % 5 == 0)) for i, r in got.items() if r.held_out and i < 600]
    assert sum(a == b for a, b in held) / len(held) > 0.95
    assert all(r.score == 0 for r in toxicity.toxicity(docs, labels.where("toxic = 0")).collect())


# ---- 1 and 4 -------------------------------------------------------------------------------------

def test_preference_prompt_is_the_common_prefix(spark):
    turns = spark.createDataFrame(
        [(0, 0, "user", "hi"), (0, 1, "assistant", "good"), (1, 0, "user", "hi"), (1, 1, "assistant", "bad"), (1, 1, "assistant", "bad"),
         (2, 0, "user", None), (3, 0, "user", ""), (4, None, None, "x"), (None, 0, "user", "lost")],
        "conv_id long, turn long, role string, text string")
    got = {r.pair_id: r for r in preference.preference_rows(preference.adjacent_pairs(turns)).collect()}
    assert got[0].prompt == "<|im_start|>user\nhi<|im_end|>\n" and got[0].status == "pair" and got[0].n_prompt_turns == 1
    assert got[0].chosen == "<|im_start|>assistant\ngood<|im_end|>\n"
    assert [(m.chars, m.train) for m in got[0].rejected_mask] == [(len("<|im_start|>assistant\n"), False), (len("bad<|im_end|>\n"), True)]
    assert got[1].status == "identical" and got[2].status == "unpaired" and len(got) == 3


def test_language_fuses_evidence(spark):
    docs = spark.createDataFrame([("le chat et la souris sont dans la maison " * 5, "fr"), ("the cat and the mouse are in the house " * 5, "en"), ("x", None)],
                                 "text string, lang string")
    pages = spark.createDataFrame(
        [(i, f"http://h{i % 3}.example.{'fr' if i % 2 else 'com'}/p", f"<html lang='{'fr' if i % 2 else 'en'}'><p>{'la souris et le chat' if i % 2 else 'the mouse and the cat'}</p>")
         for i in range(30)] + [(99, None, None), (98, "http://h1.example.fr/", "<html lang=fr></html>")], "page_id long, url string, html string")
    got = {r.page_id: r for r in language.identify(pages, docs).collect()}
    assert len(got) == 32 and all(got[i].lang == ("fr" if i % 2 else "en") for i in range(30))
    assert got[98].lang == "fr" and got[99].lang in ("en", "fr")      # no text: markup, address and host decide
    assert {r.lang for r in language.identify(pages, docs.limit(0)).collect()} == {None}


@pytest.mark.parametrize("head", ["", "<!-- licence " + "x" * 10_000 + " -->", " " * 10_000, "<html>" + "<script>" + "y" * 5000 + "</script>"])
def test_declared_language_is_found_anywhere(head):
    assert language.declared_language(head + "<HTML class=a\n lang = ' De-AT'><p>x") == "de"
    assert language.declared_language(head + "<html class=a><p lang=fr>x") == ""
    assert language.declared_language(head + "<html lang=\"\">") == "" == language.declared_language(None)


def test_pipeline_stages_keep_clean_documents(spark, tmp_path):
    import corpus_pipeline
    bench = words(30)
    clean = [(i, words(60)) for i in range(40)]
    rows = clean + [(100, clean[0][1]), (101, clean[1][1] + " " + words(1)), (102, words(20) + " " + bench)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == ({i for i, _ in clean} - {0}) | {100}


def test_parity_sketches_differ_in_at_most_the_unshared_shingles():
    """The test that drops candidate pairs must never drop a link, at any size of the sets."""
    rng = np.random.default_rng(7)
    for n in (0, 1, 5, 150, 5000, 40_000):
        a = np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64))
        for kept in (0.0, 0.5, 0.89, 1.0):
            b = np.unique(np.concatenate([a[:int(len(a) * kept)], rng.integers(0, 1 << 62, n // 9, dtype=np.uint64)]))
            x, y = near_dedup.parity_sketch(a), near_dedup.parity_sketch(b)
            assert len(x) == near_dedup.SKETCH_WORDS
            assert sum(int(v).bit_count() for v in (x ^ y).view(np.uint64)) <= len(np.setxor1d(a, b))


def test_components_are_packed_into_few_tasks(spark):
    """Few edges make few tasks (and shuffle files), whatever the number of shuffle partitions."""
    from panelcast.llm.common import connected_components
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        edges = spark.createDataFrame([(n, n + 1) for n in range(30)] + [(50, 51)], "a long, b long")
        roots = connected_components(edges)
        assert roots.rdd.getNumPartitions() <= 40 + spark.sparkContext.defaultParallelism
        assert sorted(map(tuple, roots.collect())) == [(n, 0) for n in range(31)] + [(50, 50), (51, 50)]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
