"""Language identification of pages by Bayesian evidence fusion.

For each page and language the log-posterior adds up

* the *text*: a naive Bayes likelihood of the visible text's letter trigrams, hashed into a table
  of fixed size. The table counts every document with a declared language. As trigrams overlap and
  are far from independent, a page's evidence counts as :data:`EFFECTIVE` independent trigrams at most;
* the *markup*: P(declared ``lang`` | language), the *address*: P(first path part that looks like a
  language code | language) and P(last label of the host name | language), all from counts of soft
  text labels over all pages, with additive smoothing, less the page's own share;
* the *host prior*: P(language | host), smoothed towards its registered domain, that towards the last
  label, and that towards all pages, from the same soft counts, less the page's own share.

All counts are grouped aggregations. Hosts are summed and looked up by (host, salt), so a host with
a third of all pages is spread over as many tasks as there are salts.

Defined cases: null html is empty (text evidence 0); null or malformed addresses have host and
suffix ``''``; undeclared languages count as the declaration ``''``; ties go to the first language
in alphabetical order; pages without any known language (no training text) get a null one. Rows that repeat a page
are judged alike. Extra columns are ignored.
"""

from __future__ import annotations

import html as markup
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.llm.common import LOWER_BYTES, fan_out, small_batches, stored, table

BUCKETS = 1 << 16
EFFECTIVE = 40.0
SMOOTHING = 0.5          # added to every trigram bucket
EVIDENCE = 1.0           # added to every declaration, spread over the languages
STRENGTH = 5.0           # pages' worth of the wider level in each level of the host prior
MOST_LANGUAGES = 500
_OPEN = re.compile(r"(?i)<(?:(script|style)\b|(!--))?")
_CLOSE = {"script": re.compile(r"(?i)</script\s*>"), "style": re.compile(r"(?i)</style\s*>"), "!--": re.compile("-->"),
          "": re.compile(">")}
_HTML_TAG = re.compile(r"(?i)<html\b[^>]*")
_DECLARED = re.compile(r"(?i)\blang\s*=\s*+[\"']?\s*+([a-z]{2,3})\b")
_CODE = r"^[a-z]{2}$"
_LETTERS = bytes(LOWER_BYTES[b] if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def visible_text(html: str | None) -> str:
    """The text without tags, comments, scripts and styles, each replaced by a space. One that is never closed is taken as a
    tag, and a tag that is never closed as text. One pass: what was not found once is not looked for again."""
    if not html:
        return ""
    out, at, seen, missing = [], 0, 0, set()
    while "" not in missing and (start := _OPEN.search(html, seen)):
        close = None
        for kind in ((start[1] or start[2] or "").lower(), ""):
            if kind not in missing:
                close = _CLOSE[kind].search(html, start.end() if kind else start.start())
                if close:
                    break
                missing.add(kind)
        if close:
            out += [html[at:start.start()], " "]
            at = seen = close.end()
    return markup.unescape("".join([*out, html[at:]]))


def declared_language(html: str | None) -> str:
    """The language of the first html tag that declares one, wherever it stands."""
    for tag in _HTML_TAG.finditer(html or ""):
        if found := _DECLARED.search(tag[0], 5):
            return found[1].lower()
    return ""


def trigram_buckets(text: str | None) -> np.ndarray:
    """Bucket of every byte trigram of the lower-cased letters; words are separated by one space."""
    data = np.frombuffer(b" " + b" ".join(text.encode().translate(_LETTERS).split()) + b" " if text else b"", np.uint8)
    if len(data) < 3:
        return np.empty(0, np.int64)
    x = data.astype(np.uint32)
    code = x[:-2] << np.uint32(16) | x[1:-1] << np.uint32(8) | x[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


def trigram_model(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages, log-likelihoods languages x buckets) from the counts of all labelled documents."""
    known = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).where("lang IS NOT NULL AND lang != ''")
    languages = sorted(r.lang for r in known.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError("the labels are not language codes: there are too many of them")
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            for t, name in zip(batch.column(0), batch.column(1).to_pylist()):
                found = trigram_buckets(t.as_py())
                total = sums.setdefault(name, np.zeros(BUCKETS, np.int64))
                if len(found) < BUCKETS // 16:
                    np.add.at(total, found, 1)
                else:
                    total += np.bincount(found, minlength=BUCKETS)
        for name, total in sums.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(used), pa.string()), pa.array(used.astype(np.int32)),
                                              pa.array(total[used])], ["lang", "bucket", "n"])

    counts = known.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    model = np.full((len(languages), BUCKETS), SMOOTHING)
    at = {name: i for i, name in enumerate(languages)}
    for r in counts.toLocalIterator():          # languages x buckets at most
        model[at[r.lang], r.bucket] += r.n
    return languages, np.log(model) - np.log(model.sum(axis=1, keepdims=True))


def _host_parts() -> tuple[Column, Column, Column, Column]:
    """(host, registered domain, last label, language-like first path part) of ``url``."""
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit("")))
    first = F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#.]*)", 1), F.lit("")))
    return (host, F.substring_index(host, ".", -2), F.substring_index(host, ".", -1),
            F.when(first.rlike(_CODE), first).otherwise(""))


def text_evidence(pages: DataFrame, languages: list[str], model: np.ndarray) -> DataFrame:
    """``page_id, url, declared, loglik array<double>, soft array<double>`` (soft: posterior of the text alone)."""
    shared = pages.sparkSession.sparkContext.broadcast(model)     # languages x buckets: fixed size
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            declared, logs, soft = [], [], []
            for t in batch.column(2):
                page = t.as_py()
                declared.append(declared_language(page))
                found = trigram_buckets(visible_text(page))
                log = shared.value[:, found].sum(axis=1) * (min(1.0, EFFECTIVE / len(found)) if len(found) else 0.0)
                p = np.exp(log - log.max())
                logs.append(log.tolist())
                soft.append((p / p.sum()).tolist())
            array = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(declared, pa.string()),
                                              pa.array(logs, array), pa.array(soft, array)],
                                             ["page_id", "url", "declared", "loglik", "soft"])

    rows = pages.select("page_id", "url", "html")
    array = T.ArrayType(T.DoubleType())
    schema = T.StructType([rows.schema["page_id"], rows.schema["url"]]).add("declared", "string").add("loglik", array).add("soft", array)
    return rows.mapInArrow(run, schema)


def _sums(rows: DataFrame, keys: list[str], n: int, name: str) -> DataFrame:
    """Soft counts per language by ``keys``, as one array."""
    return rows.groupBy(*keys).agg(F.array(*[F.sum(F.col("soft")[i]) for i in range(n)]).alias(name))


def _less(total: Column, own: Column) -> Column:
    """Counts without the page's own share (rounding may leave a tiny negative)."""
    return F.transform(F.arrays_zip(total.alias("t"), own.alias("o")), lambda z: F.greatest(z["t"] - z["o"], F.lit(0.0)))


def _smoothed(counts: Column, wider: Column) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x) + STRENGTH
    return F.transform(F.arrays_zip(counts.alias("c"), wider.alias("w")), lambda z: (z["c"] + STRENGTH * z["w"]) / total)


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """``page_id, host, declared, text_lang, lang, confidence`` of every page."""
    languages, model = trigram_model(docs)
    host, domain, suffix, path = _host_parts()
    if not languages:
        none = F.lit(None).cast("string")
        return pages.select("page_id", host.alias("host"), F.lit("").alias("declared"), none.alias("text_lang"),
                            none.alias("lang"), F.lit(0.0).alias("confidence"))
    n, salts = len(languages), fan_out(pages.sparkSession)
    rows = text_evidence(pages, languages, model).select(
        "*", host.alias("host"), domain.alias("domain"), suffix.alias("suffix"), path.alias("path")).drop("url")
    # A number of the stored row, so that pages without an id, or with one id, are spread as well.
    rows = stored(rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")), "page-evidence")

    def add(name: str) -> list[Column]:
        return [F.sum(F.col(name)[i]) for i in range(n)]

    by_host = _sums(rows, ["suffix", "domain", "host", "salt"], n, "part")
    hosts = by_host.groupBy("suffix", "domain", "host").agg(F.array(*add("part")).alias("in_host"), F.collect_set("salt").alias("salts"))
    domains = hosts.groupBy("suffix", "domain").agg(F.array(*add("in_host")).alias("in_domain"))
    suffixes = domains.groupBy("suffix").agg(F.array(*add("in_domain")).alias("in_suffix"))
    # Declarations and path codes are at most three letters: their tables are bounded by the alphabet.
    declared = _sums(rows, ["declared"], n, "with_declared")
    paths = _sums(rows, ["path"], n, "with_path")
    everywhere = suffixes.agg(F.array(*add("in_suffix")).alias("overall")).first()
    if everywhere is None or everywhere.overall[0] is None:
        overall = [1.0] * n
    else:
        overall = list(everywhere.overall)
    levels = (hosts.join(domains, ["suffix", "domain"]).join(suffixes, "suffix")
              .select("suffix", "domain", "host", "in_host", "in_domain", "in_suffix", F.explode("salts").alias("salt")))
    rows = (rows.join(levels, ["suffix", "domain", "host", "salt"])
            .join(F.broadcast(declared), "declared").join(F.broadcast(paths), "path"))

    own, total = F.col("soft"), F.array(*[F.lit(float(x)) for x in overall])
    base = _smoothed(_less(total, own), F.array(*[F.lit(1.0 / n)] * n))
    prior = base
    for level in ("in_suffix", "in_domain", "in_host"):
        rows = rows.withColumn(f"p_{level}", _smoothed(_less(F.col(level), own), prior))
        prior = F.col(f"p_{level}")
    rows = rows.withColumns({"base": _less(total, own), "d": _less(F.col("with_declared"), own),
                             "p": _less(F.col("with_path"), own), "s": _less(F.col("in_suffix"), own)})

    def log_given(with_it: str, i: int) -> Column:
        """log P(what the page declares | language i)."""
        return F.log((F.col(with_it)[i] + EVIDENCE / n) / (F.col("base")[i] + EVIDENCE))

    logs = [F.col("loglik")[i] + log_given("d", i) + log_given("p", i) + log_given("s", i)
            + F.log(prior[i] / F.col("p_in_suffix")[i]) + F.log(_at(base, i)) for i in range(n)]
    rows = rows.withColumn("logs", F.array(*logs))
    best = F.array_max("logs")
    names = F.array(*[F.lit(x) for x in languages])
    spread = F.aggregate(F.transform("logs", lambda x: F.exp(x - best)), F.lit(0.0), lambda a, x: a + x)
    return rows.select("page_id", "host", "declared",
                       F.element_at(names, F.array_position("loglik", F.array_max("loglik")).cast("int")).alias("text_lang"),
                       F.element_at(names, F.array_position("logs", best).cast("int")).alias("lang"),
                       F.round(1 / spread, 6).alias("confidence"))


def _at(array: Column, i: int) -> Column:
    return F.element_at(array, i + 1)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))
