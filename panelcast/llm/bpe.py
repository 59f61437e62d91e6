"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Texts are split by the tokenizer's pattern, with the character classes of the Unicode version that the tokenizer's
library has; every match (pre-token) is encoded on its own. A pre-token that is itself a token is emitted as it is.
All others of a batch that are not remembered are laid into one linked list of bytes, with borders that no pair crosses:

* each adjacent pair whose concatenation has a merge rank puts its left position into the bucket
  of that rank (a small heap, so equal ranks merge from the left);
* a two-level bitmap over the ranks marks the buckets in use; find-first-set from the top gives
  the next rank in constant time, whatever the number and the length of the pre-tokens;
* an entry whose node was merged away, or whose pair has another rank by now, is stale and skipped;
* a bucket is worked off at once, unless a merge makes a pair of a lower rank, which then comes first.

Each merge pushes at most two entries, so n bytes cost O(n log n) time and O(n) memory, for one very long
pre-token as for many short ones. Ids of short pre-tokens are kept in a memo that is bounded and ends with its task.

Defined cases: null and empty texts have no ids (``n_tokens`` 0, digests of the empty string); rows that repeat an id are
encoded one by one, null ids stay null; very long texts and pre-tokens are encoded whole; an empty table gives no rows.
Only the id and the text are read, so other columns' names cannot clash.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
import re
import unicodedata
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from panelcast.llm.common import ship, shipped, small_batches, table

MEMO_ENTRIES = 200_000
MEMO_BYTES = 64
LIST_BYTES = 1 << 14         # bytes of the linked list (which a cache holds), unless one pre-token has more

# Letters and numbers that Unicode 16.0, the library's version, has beyond 15.1, and the code points
# with the property White_Space.
LETTERS_16 = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0)]
NUMBERS_16 = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9),
    (0x1E5F1, 0x1E5FA)]
WHITE_SPACE = [
    (0x9, 0xD), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029),
    (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)]


BASIC = 0xFFFF               # the engine has bitmaps for classes up to here
_BEYOND = re.compile("[\U00010000-\U0010ffff]").search


def _within(code: int, ranges: list[tuple[int, int]]) -> bool:
    return any(a <= code <= b for a, b in ranges)


def _category(code: int) -> str:
    """L, N or another letter."""
    return "L" if _within(code, LETTERS_16) else "N" if _within(code, NUMBERS_16) else unicodedata.category(chr(code))[0]


def _class(codes: Iterable[int]) -> str:
    """The inside of a character class."""
    ranges: list[list[int]] = []
    for c in codes:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in ranges)


class _StandIns(dict):
    """Code points beyond BASIC to one of their class below it (white space has none beyond)."""

    def __missing__(self, code: int) -> int:
        self[code] = found = code if code <= BASIC else {"L": 0xAA, "N": 0xB2}.get(_category(code), 0xA4)
        return found


@functools.cache
def splitter(pattern: str):
    """text -> its matches of the pattern. The classes are written out up to BASIC; a text that goes beyond is
    matched through stand-ins of the same class, which no pattern names one by one."""
    kinds: dict[str, list[int]] = {"L": [], "N": []}
    for c in range(BASIC + 1):
        kinds.get(_category(c), []).append(c)
    letters, numbers = _class(kinds["L"]), _class(kinds["N"])
    white = _class(c for a, b in WHITE_SPACE for c in range(a, b + 1))
    written = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{white}{letters}{numbers}]")
    for escape, chars in ((r"\p{L}", f"[{letters}]"), (r"\p{N}", f"[{numbers}]"), (r"\S", f"[^{white}]"), (r"\s", f"[{white}]")):
        written = written.replace(escape, chars)
    engine, stand_ins = re.compile(written), _StandIns()

    def split(text: str) -> list[str]:
        if not _BEYOND(text):
            return engine.findall(text)
        return [text[m.start():m.end()] for m in engine.finditer(text.translate(stand_ins))]

    return split


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Ranks:
    """The vocabulary, and the rank of every pair of tokens whose concatenation is a token. Its size is the vocabulary's."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.of = ranks
        self.size = max(ranks.values()) + 1
        get = ranks.get
        self.pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = get(token[:cut]), get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left * self.size + right] = rank
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.bytes = np.array([[get(bytes([a, b]), -1) for b in range(256)] for a in range(256)], np.int64)


def merge_pretokens(pieces: list[bytes], ranks: Ranks) -> list[list[int]]:
    """Ids of every piece.

    The queue is written out in the loop: ``buckets`` has the heap of left positions of each rank in
    use; bit ``r & 255`` of ``leaf[r >> 8]`` says that rank ``r`` is in use, and bit ``g`` of ``top`` that
    ``leaf[g]`` is not zero. ``x & -x`` leaves the first set bit.
    """
    if not pieces:
        return []
    size, pair_of = ranks.size, ranks.pairs.get
    data = np.frombuffer(b"".join(pieces), np.uint8)
    n = len(data)
    starts = np.cumsum([0, *map(len, pieces)])
    end = list(range(1, n + 1))          # node i covers the bytes i to end[i], which is the next node
    before = np.arange(-1, n - 1)
    before[starts[:-1]] = -1
    before = before.tolist()
    border = bytearray(n + 1)            # where a piece begins; no pair crosses it
    for at in starts.tolist():
        border[at] = 1
    token = ranks.byte[data].tolist()
    first = np.append(ranks.bytes[data[:-1], data[1:]], -1)     # rank of the pair that starts at each node
    first[starts[1:] - 1] = -1
    rank_at = first.tolist()
    order = np.argsort(first, kind="stable")
    order = order[np.searchsorted(first[order], 0):]
    kinds, counts = np.unique(first[order], return_counts=True)
    buckets: dict[int, list[int]] = {}
    leaf: dict[int, int] = {}
    top = at = 0
    for rank, count in zip(kinds.tolist(), counts.tolist()):
        buckets[rank] = order[at:at + count].tolist()           # rising positions are a heap
        at += count
        leaf[rank >> 8] = leaf.get(rank >> 8, 0) | 1 << (rank & 255)
        top |= 1 << (rank >> 8)
    while top:
        group = (top & -top).bit_length() - 1
        bits = leaf[group]
        rank = group << 8 | ((bits & -bits).bit_length() - 1)
        bucket = buckets[rank]
        lower = False                    # a pair of a lower rank came up
        while bucket and not lower:
            i = heappop(bucket)
            if rank_at[i] != rank:
                continue                 # stale: merged away, or another pair by now
            middle = end[i]
            stop = end[i] = end[middle]
            rank_at[middle] = -1
            token[i] = rank
            left, spot = before[i], i
            if border[stop]:
                pair = -1
            else:
                before[stop] = i
                pair = pair_of(rank * size + token[stop], -1)
            while True:                  # the pair that starts here, then the one that ends here
                rank_at[spot] = pair
                if pair >= 0:
                    if pair in buckets:
                        heappush(buckets[pair], spot)
                    else:
                        buckets[pair] = [spot]
                        group = pair >> 8
                        leaf[group] = leaf.get(group, 0) | 1 << (pair & 255)
                        top |= 1 << group
                    if pair < rank:
                        lower = True
                if spot != i or left < 0:
                    break
                spot = left
                pair = pair_of(token[left] * size + rank, -1)
        if not bucket:
            del buckets[rank]
            group = rank >> 8
            leaf[group] ^= 1 << (rank & 255)
            if not leaf[group]:
                top ^= 1 << group
    out = []
    for i, stop in zip(starts.tolist(), starts[1:].tolist()):
        ids = []
        while i < stop:
            ids.append(token[i])
            i = end[i]
        out.append(ids)
    return out


class Codec:
    """Encoder and decoder, with a bounded memo of short pre-tokens."""

    def __init__(self, ranks: Ranks, pattern: str) -> None:
        self.ranks, self.split = ranks, splitter(pattern)
        self.tokens: list[bytes] = [b""] * ranks.size
        for token, rank in ranks.of.items():
            self.tokens[rank] = token
        self.names = [str(n) for n in range(len(self.tokens))]
        self.memo: dict[str, list[int]] = {}

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of every text. The texts' unknown pre-tokens are merged together."""
        if len(self.memo) > MEMO_ENTRIES:
            self.memo.clear()
        known, split = self.memo, [self.split(t or "") for t in texts]
        unknown = set().union(*split).difference(known)
        long: list[str] = []
        held: list[bytes] = []
        names: list[str] = []
        size = 0

        def merge() -> None:
            known.update(zip(names, merge_pretokens(held, self.ranks)))
            names.clear()
            held.clear()

        for name in unknown:
            piece = name.encode()
            whole = self.ranks.of.get(piece)
            if len(piece) > MEMO_BYTES:
                long.append(name)
            if whole is not None:
                known[name] = [whole]
                continue
            if held and size + len(piece) > LIST_BYTES:
                merge()
                size = 0
            names.append(name)
            held.append(piece)
            size += len(piece)
        merge()
        out = [list(itertools.chain.from_iterable(map(known.__getitem__, pieces))) for pieces in split]
        for name in long:
            del known[name]
        return out

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def _few(values: pa.Array, size: int = 1 << 20) -> Iterator[list[str | None]]:
    """The texts, some at a time: about ``size`` characters, so that memory is bounded by that and the longest text."""
    held: list[str | None] = []
    n = 0
    for value in values:
        held.append(value.as_py())
        n += len(held[-1] or "")
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def _codec(docs: DataFrame, vocabulary: str, pattern: str, make, schema: str) -> DataFrame:
    # The rank table's size is that of the vocabulary, not of the data. The codec, its memo included, is the task's own:
    # a worker that waits for its next task holds the table alone.
    ranks = ship(docs.sparkSession, Ranks(read_ranks(vocabulary)))
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shipped(ranks), pattern)
        for batch in batches:
            yield make(codec, batch)

    return docs.mapInArrow(run, schema)


def encode(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text", ids: str = "ids",
           id_of: str = "doc_id") -> DataFrame:
    """``id_of, ids array<int>`` of every row."""
    def make(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [ids for texts in _few(batch.column(1)) for ids in codec.encode(texts)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(found, pa.list_(pa.int32()))], [id_of, ids])

    kind = docs.schema[id_of].dataType.simpleString()
    return _codec(docs.select(id_of, text), vocabulary, pattern, make, f"`{id_of}` {kind}, `{ids}` array<int>")


def decode(encoded: DataFrame, vocabulary: str, pattern: str, ids: str = "ids", text: str = "text",
           id_of: str = "doc_id") -> DataFrame:
    """``id_of, text binary``: the bytes of the ids (null ids give empty bytes)."""
    def make(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        back = [codec.decode(x or ()) for x in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(back, pa.binary())], [id_of, text])

    kind = encoded.schema[id_of].dataType.simpleString()
    return _codec(encoded.select(id_of, ids), vocabulary, pattern, make, f"`{id_of}` {kind}, `{text}` binary")


def round_trip(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text",
               id_of: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """``id_of, n_tokens, ids_sha256, decoded_sha256`` (and ``ids``) in one pass: encode, then decode
    the ids."""
    def make(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, of_ids, of_text, found = [], [], [], []
        for ids in (ids for texts in _few(batch.column(1)) for ids in codec.encode(texts)):
            counts.append(len(ids))
            of_ids.append(hashlib.sha256(",".join(map(codec.names.__getitem__, ids)).encode()).hexdigest())
            of_text.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            if keep_ids:
                found.append(pa.array(ids, pa.int32()))
        columns = {id_of: batch.column(0), "n_tokens": pa.array(counts, pa.int64()),
                   "ids_sha256": pa.array(of_ids, pa.string()), "decoded_sha256": pa.array(of_text, pa.string())}
        if keep_ids:
            columns["ids"] = pa.ListArray.from_arrays(
                pa.array([0, *itertools.accumulate(counts)], pa.int32()),
                pa.concat_arrays([pa.array([], pa.int32()), *found]))
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    kind = docs.schema[id_of].dataType.simpleString()
    return _codec(docs.select(id_of, text), vocabulary, pattern, make,
                  f"`{id_of}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
                  + ", ids array<int>" * keep_ids)


def default_vocabulary() -> tuple[str, str]:
    """The installed multilingual vocabulary and the split pattern of its library."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), *default_vocabulary())
