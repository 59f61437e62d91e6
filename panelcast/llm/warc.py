"""WARC: archives of pages with revisit records, and a reader that salvages damaged archives.

*Writing*: pages with equal payloads are found by SHA-256 and length in two salted steps, so a payload
that a third of the pages share is spread over all reducers; the smallest page id becomes the
response and the others revisit it. Each partition writes archives of bounded size, one gzip
member per record, under a name that depends on its partition alone: a task that runs again puts
the same bytes in place of the same file.

*Reading*: members are inflated and checked one by one (CRC, version line, content length, block
digest). After a failed check the reader searches for the next place where a whole valid member or version
line begins, goes on from there, and logs the bytes between as quarantined. Of a member that is damaged, or holds
a damaged record, it keeps what inflated and searches that for the records in the same way. Compressed and plain
archives, and mixtures, are read alike.

Defined cases: a null payload is empty; payloads below ``min_bytes`` are all responses; null page
ids sort after every id and are written as ``null``; an empty table writes no archive and reads as no rows.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import fan_out, salt_of, salted_least, shared_path, small_batches, table

ARCHIVE_BYTES = 16 << 20     # an archive is closed once it is this large
MIN_BYTES = 0
GZIP_MAGIC = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---- records ----------------------------------------------------------------------------------

@dataclass
class Record:
    headers: dict[str, str]
    block: bytes
    offset: int = 0

    @property
    def kind(self) -> str:
        return self.headers.get("WARC-Type", "")

    @property
    def payload(self) -> bytes:
        """What follows the block's own HTTP header."""
        return self.block.partition(b"\r\n\r\n")[2]


def record_bytes(headers: dict[str, str], block: bytes) -> bytes:
    lines = {**headers, "WARC-Block-Digest": f"sha1:{sha1_base32(block)}", "Content-Length": str(len(block))}
    head = "".join(f"{k}: {v}\r\n" for k, v in lines.items())
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id: str | None, url: str | None, payload: bytes, original: str | None) -> bytes:
    """A response, or a revisit of ``original`` (its payload is left out, its HTTP header stays)."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    headers = {"WARC-Type": "response" if original is None else "revisit",
               "WARC-Record-ID": f"<urn:page:{'null' if page_id is None else page_id}>",
               "WARC-Target-URI": re.sub(r"\s", "%20", url or ""),
               "WARC-Payload-Digest": f"sha1:{sha1_base32(payload)}",
               "Content-Type": "application/http;msgtype=response"}
    if original is not None:
        headers |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<urn:page:{original}>"}
        payload = b""
    return record_bytes(headers, http.encode() + payload)


# ---- salvage reader ---------------------------------------------------------------------------

@dataclass
class Salvage:
    records: list[Record] = field(default_factory=list)
    gaps: list[tuple[int, int, str]] = field(default_factory=list)   # first byte, end, reason


PIECE = 1 << 14              # compressed bytes inflated at a time


class Damage(ValueError):
    pass


def parse_record(data: bytes, at: int) -> tuple[Record, int]:
    """The record that begins at ``at``, and where it ends; Damage if any check fails."""
    version = VERSION.match(data, at)
    if not version:
        raise Damage("no version line")
    end = data.find(b"\r\n\r\n", version.end() - 2)
    if end < 0:
        raise Damage("header has no end")
    headers = {}
    for line in data[version.end():end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damage("malformed header line")
        headers[name.decode("utf-8", "replace").strip()] = value.decode("utf-8", "replace").strip()
    length = headers.get("Content-Length", "")
    if not length.isascii() or not length.isdigit():
        raise Damage("no content length")
    start = end + 4
    stop = start + int(length)
    if data[stop:stop + 4] != b"\r\n\r\n":
        raise Damage("record is cut or its length is wrong")
    block = data[start:stop]
    digest = headers.get("WARC-Block-Digest", "")
    if digest.startswith("sha1:") and digest[5:] != sha1_base32(block):
        raise Damage("block digest differs")
    return Record(headers, block, at), stop + 4


def inflate(data: bytes, at: int) -> tuple[bytes, int]:
    """The gzip member at ``at`` and where it ends."""
    z, out, first = zlib.decompressobj(31), [], at
    try:
        while not z.eof and first < len(data):      # piece by piece: what follows the member is not copied for it
            piece = data[first:first + PIECE]
            out.append(z.decompress(piece))
            first += len(piece)
    except zlib.error as e:
        raise Damage(f"gzip: {e}") from None
    if not z.eof:
        raise Damage("gzip: member is cut")
    return b"".join(out), first - len(z.unused_data)


def inflate_part(data: bytes, at: int) -> tuple[bytes, int, bool]:
    """What a damaged gzip member yields, how far it could be read, and whether no byte of it was wrong: it is only cut."""
    z, out, first = zlib.decompressobj(31), [], at
    for step in (1 << 16, 1 << 8):
        while first < len(data):
            held = z.copy()
            try:
                out.append(z.decompress(data[first:first + step]))
            except zlib.error:
                z = held
                break
            first += step
        else:
            return b"".join(out), len(data), True
    try:                                        # the last bytes one by one, up to the wrong one
        while first < len(data):
            rest = data[first:first + 1]
            while piece := z.decompress(rest, 1):
                out.append(piece)
                rest = z.unconsumed_tail
            first += 1
    except zlib.error:
        pass
    return b"".join(out), first, False


def _records(content: bytes, at: int, sure: bool) -> tuple[list[Record], list[str]]:
    """The intact records of the member at ``at``, and what lies between them. If the member is not ``sure``
    to be right, only records with a block digest count."""
    records, lost, inner, bad, why = [], [], 0, -1, ""
    while inner < len(content):
        try:
            record, end = parse_record(content, inner)
            if not sure and not record.headers.get("WARC-Block-Digest", "").startswith("sha1:"):
                raise Damage("no block digest in a damaged member")
        except Damage as e:
            if bad < 0:
                bad, why = inner, str(e)
            found = VERSION.search(content, inner + 1)
            inner = found.start() if found else len(content)
            continue
        if bad >= 0:
            lost.append(f"{why}, inflated bytes {bad} to {inner}")
            bad = -1
        record.offset = at
        records.append(record)
        inner = end
    if bad >= 0:
        lost.append(f"{why}, inflated bytes {bad} to {len(content)}")
    return records, lost


def _member(data: bytes, at: int) -> tuple[list[Record], int, list[str]]:
    if data.startswith(GZIP_MAGIC, at):
        content, end = inflate(data, at)
        records, lost = _records(content, at, True)
        if not records:
            raise Damage(lost[0] if lost else "empty member")
        return records, end, lost
    record, end = parse_record(data, at)
    return [record], end, []


_NEXT = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")


def salvage(data: bytes) -> Salvage:
    """Every intact record, and the byte ranges that had to be left out. A member that is damaged or holds
    damaged records is a gap for each of them, whose reason gives the inflated bytes that are lost."""
    out, at, bad, why = Salvage(), 0, -1, []
    part, reach = b"", 0                        # what the last damaged member yielded, and how far it was read

    def close(end: int) -> None:
        out.gaps.extend((bad, end, w) for w in why)

    while at < len(data):
        try:
            records, end, lost = _member(data, at)
            if at < reach and data[at:end] in part:
                raise Damage("part of the damaged member")
        except Damage as e:
            kept, lost, content, stop = [], [], b"", at
            if data.startswith(GZIP_MAGIC, at):
                content, stop, cut = inflate_part(data, at)
                if not (at < reach and data[at:stop] in part):
                    kept, lost = _records(content, at, cut)
            if kept:
                if bad >= 0:
                    close(at)
                bad, why = at, [f"{e}: {x}" for x in lost] or [str(e)]
                out.records += kept
                part, reach = content, stop
            elif bad < 0:
                bad, why = at, [str(e)]
            found = _NEXT.search(data, at + 1)
            at = found.start() if found else len(data)
            continue
        if bad >= 0:
            close(at)
            bad = -1
        out.gaps += [(at, end, x) for x in lost]
        out.records += records
        at = end
    if bad >= 0:
        close(len(data))
    return out


# ---- jobs -------------------------------------------------------------------------------------

def with_originals(pages: DataFrame, min_bytes: int = MIN_BYTES, salts: int | None = None) -> DataFrame:
    """``page_id, url, payload, original``: the page that a revisit refers to, null for responses.

    Equal payloads are joined by (SHA-256, length, salt); first the least id of each salted group is
    taken, then of the at most ``salts`` groups of a payload. Of rows that repeat the least id one is the response."""
    salts = salts or fan_out(pages.sparkSession)
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).select(
        "*", F.sha2("payload", 256).alias("key"), F.octet_length("payload").alias("size"),
        salt_of(salts, F.col("page_id"), F.col("url")).alias("salt"))
    joined = (rows.join(salted_least(rows, ["key", "size"], "page_id"), ["key", "size", "salt"])
              .withColumnRenamed("least", "original"))
    revisit = (F.col("size") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("original"))
    return joined.select("page_id", "url", "payload", "size", "key", "original",
                         F.when(revisit, F.col("original")).alias("refers"))


def _put(directory: str, name: str, data: bytes) -> None:
    """Write whole or not at all; a second attempt replaces the same bytes. The URI may name what pyarrow's file systems
    know (``file``, ``hdfs``, ``s3``, ``gs``, ``abfs``); ``s3a`` and ``abfss``, as Hadoop calls the same stores, are renamed."""
    from pyarrow import fs
    scheme, colon, rest = directory.partition("://")
    files, path = fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3", "abfss": "abfs"}.get(scheme, scheme) + colon + rest)
    files.create_dir(path, recursive=True)
    draft = posixpath.join(path, f"_{name}.{TaskContext.get().taskAttemptId()}")
    with files.open_output_stream(draft) as out:
        out.write(data)
    files.move(draft, posixpath.join(path, name))


def write_archives(pages: DataFrame, directory: str, archive_bytes: int = ARCHIVE_BYTES,
                   min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write ``pages`` under ``directory``; the manifest ``archive, records, bytes`` (one row each)."""
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, nth, held, size = TaskContext.get().partitionId(), 0, [], 0

        def close() -> pd.DataFrame:
            name = f"part-{part:05d}-{nth:05d}.warc.gz"
            info = record_bytes({"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:archive:{name}>",
                                 "Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n")
            data = b"".join([_gzip(info), *held])
            _put(directory, name, data)
            return pd.DataFrame({"archive": [name], "records": [len(held)], "bytes": [len(data)]})

        seen = (None, None)
        for batch in batches:
            for row in batch.itertuples(index=False):
                page, refers = row.page_id, row.refers
                if refers is None and page is not None and row.size >= min_bytes and seen == (page, row.key):
                    refers = page                    # the response's own id again: it revisits itself
                seen = (page, row.key)
                held.append(_gzip(page_record(page, row.url, bytes(row.payload), refers)))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield close()
                    nth, held, size = nth + 1, [], 0
        if held:
            yield close()

    # Sorted rows make the archives of a partition the same in every attempt.
    rows = (with_originals(pages, min_bytes).drop("original")
            .withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers")})
            .sortWithinPartitions("page_id", "key", "url"))
    return rows.mapInPandas(run, "archive string, records long, bytes long")


def _gzip(data: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _page(uri: str) -> str | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", uri)
    return found[1] if found else None


def read_archives(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame]:
    """(records, quarantined gaps) of every archive under ``directory``."""
    small_batches(spark)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*")
             .option("recursiveFileLookup", "true").load(directory).select("path", "content"))

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                rows = [_row(path, r) for r in salvage(bytes(content)).records if r.kind in ("response", "revisit")]
                yield pd.DataFrame(rows, columns=["archive", "offset", "page_id", "url", "record_type", "refers_to",
                                                  "payload_digest", "payload_bytes", "payload"])

    def gaps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                yield pd.DataFrame([(path, *g) for g in salvage(bytes(content)).gaps],
                                   columns=["archive", "first", "end", "reason"])

    return (files.mapInPandas(records, "archive string, offset long, page_id string, url string, record_type string, "
                                       "refers_to string, payload_digest string, payload_bytes long, payload binary"),
            files.mapInPandas(gaps, "archive string, first long, end long, reason string"))


def _row(path: str, r: Record) -> tuple:
    http = r.block.partition(b"\r\n\r\n")[0]
    length = re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)
    payload = r.payload
    revisit = r.kind == "revisit"
    digest = r.headers.get("WARC-Payload-Digest", "").removeprefix("sha1:") if revisit else sha1_base32(payload)
    return (path, r.offset, _page(r.headers.get("WARC-Record-ID", "")), r.headers.get("WARC-Target-URI"), r.kind,
            _page(r.headers.get("WARC-Refers-To", "")), digest,
            int(length[1]) if revisit and length else len(payload), None if revisit else payload)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the archives of ``pages`` to the shared folder and read them back."""
    pages = table(spark, sf_dir, "pages")
    directory = shared_path(spark, "warc")
    written = write_archives(pages, directory).agg(F.sum("records")).first()[0]
    kind = pages.schema["page_id"].dataType
    if not written:
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, "
                                         "record_type string, refers_to long")
    records, _ = read_archives(spark, directory)
    return records.select(F.col("page_id").cast(kind), "payload_bytes", "payload_digest", "record_type",
                          F.col("refers_to").cast(kind))


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
m AS (SELECT *, min(page_id) OVER (PARTITION BY b) AS first_id FROM p),
bits AS (SELECT *, [CAST(((('0x' || substr(sha1(b), 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) AS INTEGER)
                    FOR i IN range(0, 32)] AS v FROM m)
SELECT page_id, octet_length(b)::BIGINT AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', x + 1, 1) FOR x IN v], '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM bits
"""
