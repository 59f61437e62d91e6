"""The corpus pipeline, stage by stage, against plain versions of its operators."""

import hashlib
import random

import pytest

pytest.importorskip("corpus_pipeline")

import tiktoken  # noqa: E402

import corpus_pipeline  # noqa: E402
from panelcast.llm import bpe, decontaminate, toxicity  # noqa: E402
from panelcast.llm.common import alnum_words, space_words  # noqa: E402

RND = random.Random(11)
CLEAN = [a + b for a in ("al", "be", "cor", "du", "fi") for b in ("ta", "ni", "sk", "ro", "m")]
TOXIC = ["grrk", "zzax", "krrn", "xxogg"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string"


def prose(n):
    return " ".join(RND.choice(CLEAN) + str(RND.randrange(50)) for _ in range(n))


def near(text):
    words = text.split()
    words[len(words) // 2] = "changed"
    return " ".join(words)


def near_groups(rows):
    """Groups of row numbers linked by five-word shingles."""
    sets = {}
    for n, (_, t, *_) in rows:
        w = space_words(t)
        sets[n] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {n: n for n in sets}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    groups = {}
    for n in sets:
        groups.setdefault(find(n), set()).add(n)
    return list(groups.values())


def contaminated(text, bench):
    w = alnum_words(text)
    windows = {p for _, b in bench for p in decontaminate.windows_of(alnum_words(b), 10)}
    return any(tuple(w[i:i + len(p)]) == p for p in windows for i in range(len(w) - len(p) + 1))


@pytest.fixture()
def folder(spark, tmp_path):
    toxic = [(n, prose(20) + " " + " ".join(RND.choice(TOXIC) for _ in range(12))) for n in range(0, 40)]
    clean = [(n, prose(40)) for n in range(40, 100)]
    bench = [(1, prose(30)), (2, "tiny item"), (None, prose(15)), (4, None)]
    text = prose(60)
    more = [(None, text), (None, text.upper()), (None, near(text)), (None, "clean row without an id " + prose(30)), (None, None), (None, ""),
            (200, text), (200, prose(30)), (200, "x " + bench[0][1] + " y"), (None, prose(5) + " " + bench[2][1]), (201, "A Tiny, ITEM."),
            (202, prose(20_000)), (203, "w" * 50_000), (204, near(clean[5][1])), (205, near(near(clean[5][1] + " tail")))]
    rows = [(d, t, "en", "s", len(t or ""), "own column") for d, t in toxic + clean + more]
    labels = [(d, 1, int(d < 40)) for d, _ in toxic + clean if d % 3] + [(None, 1, 1), (999, 1, None)]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path), bench


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_every_stage_equals_its_plain_version(spark, folder):
    sf, bench = folder
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    scorer = toxicity.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    at, stages = docs, dict(corpus_pipeline.STAGES)

    def run(name):
        out = corpus_pipeline.stored(stages[name](spark, at, sf), "t")
        assert out.columns == docs.columns or name == "tokens"
        return out

    before, at = collected(at), run("toxicity")
    after = collected(at)
    assert after == sorted((r for r in before if scorer.score(r[1]) < 0.5), key=repr) and len(before) - len(after) >= 38
    assert {r[0] for r in after if r[0] is not None} >= set(range(40, 100))              # clean documents stay
    before, at = after, run("exact dedup")
    groups = {}
    for r in before:
        groups.setdefault("".join(c.lower() if "A" <= c <= "Z" else c for c in r[1] or ""), []).append(r)
    after = collected(at)
    assert len(after) == len(groups)
    for r in after:
        same = groups["".join(c.lower() if "A" <= c <= "Z" else c for c in r[1] or "")]
        assert r in same and r[0] == max((x[0] for x in same if x[0] is not None), default=None)
    before, at = after, run("near dedup")
    kept = collected(at)
    found = near_groups(list(enumerate(before)))
    assert len(kept) == len(found) and all(sum(before[n] in kept for n in g) == 1 for g in found)
    before, at = kept, run("decontamination")
    assert collected(at) == sorted((r for r in before if not contaminated(r[1], bench)), key=repr)
    assert any(r[0] is None and "without an id" in (r[1] or "") for r in collected(at))
    path, pattern = bpe.default_vocabulary()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    want = sorted(((r[0], library.encode_ordinary(r[1] or "")) for r in collected(at)), key=repr)
    tokens = run("tokens").collect()
    assert sorted(((r.doc_id, list(r.ids)) for r in tokens), key=repr) == want
    assert all(r.n_tokens == len(r.ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest() for r in tokens)


def test_empty_tables(spark, folder, tmp_path):
    sf, _ = folder
    none = tmp_path / "none"
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{sf}/{name}.parquet").limit(0).write.parquet(str(none / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(none)).collect() == []
    some = tmp_path / "some"
    for name in ("documents", "benchmark", "labels"):
        rows = spark.read.parquet(f"{sf}/{name}.parquet")
        (rows.where("doc_id > 50") if name == "documents" else rows.limit(0)).write.parquet(str(some / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(some)).where("doc_id = 202").count() == 1
