"""Byte-level BPE by the ranks of a vocabulary: encoding in two tiers, and decoding.

Texts are cut into pieces by the classes of their characters. A piece that is a token itself is
found through a minimal perfect hash of the vocabulary, for all pieces of a block at once. The others
are merged: a heap holds the pairs of neighbouring parts by rank, and the parts are linked bytes.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from auditlens.llm.common import (
    PieceIds,
    blocks,
    cut_pieces,
    distinct_pieces,
    eight_bytes,
    gathered,
    mixed,
    prefix_sums,
    range_hash,
    repeated,
    same_bytes,
    utf8,
    worker_cache,
)

# Keys that share a bucket of the hash, on average.
BUCKET_KEYS = 4
_STEP = np.uint64(0x9E3779B97F4A7C15)

# Classes of characters, as the pattern of the vocabulary names them.
OTHER, LETTER, NUMBER, SPACE = range(4)


@dataclass(frozen=True)
class PerfectHash:
    """A hash from n keys onto 0 to n - 1.

    Keys fall into buckets. A bucket has a shift that sends all its keys to free places, found from
    the largest bucket down; a bucket of one key names its place, as a negative number.
    """

    shift: np.ndarray
    size: int

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two keys have one hash")
        n, buckets = len(keys), len(keys) // BUCKET_KEYS + 1
        bucket = (keys % np.uint64(buckets)).astype(np.int64)
        by_bucket = np.split(keys[np.argsort(bucket, kind="stable")], np.cumsum(np.bincount(bucket, minlength=buckets))[:-1])
        shift, taken = np.zeros(buckets, np.int64), np.zeros(n, dtype=bool)
        order = sorted(range(buckets), key=lambda b: -len(by_bucket[b]))
        single = [b for b in order if len(by_bucket[b]) == 1]
        for b in order:
            if len(by_bucket[b]) < 2:
                break
            tried, step = 0, 32
            while True:
                places = _places(by_bucket[b][:, None], np.arange(tried, tried + step)[None, :], n)
                ordered = np.sort(places, axis=0)
                fits = ~taken[places].any(axis=0) & (ordered[1:] != ordered[:-1]).all(axis=0)
                if fits.any():
                    break
                tried, step = tried + step, min(2 * step, 4096)
            shift[b] = tried + int(fits.argmax())
            taken[places[:, fits.argmax()]] = True
        shift[single] = -1 - np.flatnonzero(~taken)
        return cls(shift, n)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key. What is no key has a place too, so the caller compares."""
        shift = self.shift[(keys % np.uint64(len(self.shift))).astype(np.int64)]
        return np.where(shift < 0, -1 - shift, _places(keys, np.maximum(shift, 0), self.size))


def _places(keys: np.ndarray, shift: np.ndarray, n: int) -> np.ndarray:
    return (mixed(keys + shift.astype(np.uint64) * _STEP) % np.uint64(n)).astype(np.int64)


@dataclass(frozen=True)
class Vocabulary:
    """Tokens by rank, the hash that finds them, and the classes of all characters.

    Its size is that of the vocabulary file and a byte per character, whatever the corpus.
    """

    name: str
    tokens: tuple[bytes, ...]
    flat: np.ndarray  # the bytes of all tokens, in the order of their places in the hash
    begin: np.ndarray
    length: np.ndarray
    rank: np.ndarray
    hash: PerfectHash
    classes: np.ndarray

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """A file with a line per token: its bytes in base64, and its rank. Ranks count from 0."""
        with open(path, "rb") as lines:
            content = lines.read()
        pairs = (line.split() for line in content.splitlines() if line)
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        tokens = sorted(ranks, key=ranks.get)
        if [ranks[t] for t in tokens] != list(range(len(tokens))) or not all(bytes([b]) in ranks for b in range(256)):
            raise ValueError("ranks have to count from 0, and each byte has to be a token")
        length = np.fromiter(map(len, tokens), np.int64, len(tokens))
        end = np.cumsum(length)
        keys = range_hash(prefix_sums(np.frombuffer(b"".join(tokens), np.uint8)), end - length, end)
        found = PerfectHash.of(keys)
        rank = np.empty(len(tokens), np.int64)
        rank[found.places(keys)] = np.arange(len(tokens))
        length = length[rank]
        flat = np.frombuffer(b"".join(tokens[r] for r in rank.tolist()), np.uint8)
        return cls(
            f"{path}-{zlib.crc32(content)}", tuple(tokens), flat, np.cumsum(length) - length, length, rank, found,
            _character_classes(),
        )

    def find(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Rank of each piece of a block, -1 where it is no token. Found ones are compared byte by byte."""
        place = self.hash.places(range_hash(prefix_sums(data), begin, end))
        fits = self.length[place] == end - begin
        at = place[fits]
        fits[fits] = same_bytes(eight_bytes(data), begin[fits], eight_bytes(self.flat), self.begin[at], self.length[at])
        return np.where(fits, self.rank[place], -1)


def _character_classes() -> np.ndarray:
    """Class of each code point, by the library whose results the ids have to equal.

    A pattern that matches one class gives the bytes of just these characters.
    """
    import tiktoken

    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    single = {bytes([b]): b for b in range(256)}
    classes = np.full(0x110000, OTHER, np.uint8)
    for number, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        found = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        text = bytes(found.encode_ordinary(every)).decode()
        classes[np.frombuffer(text.encode("utf-32-le"), np.uint32)] = number
    return classes


def pieces(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of all texts of a block begin and end.

    A piece is a run of letters, numbers or other characters with a blank before it, if there is one;
    an apostrophe with s, t, re, ve, m, ll or d after it; or white space without the last character
    before something else. Together they are the matches of the pattern, and cover the texts.
    """
    at = np.flatnonzero(data & 0xC0 != 0x80)
    codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = classes[codes]
    opens = np.zeros(n + 1, dtype=bool)  # a text begins, or all end
    opens[np.searchsorted(at, offsets)] = True
    start = opens[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    after_space = np.flatnonzero(start[1:] & ~opens[1:n] & (kind[:-1] == SPACE) & (kind[1:] != SPACE)) + 1
    start[after_space - 1] = True
    start[after_space[codes[after_space - 1] == ord(" ")]] = False
    mark = np.flatnonzero(start & (codes == ord("'")) & ~opens[1:])
    if len(mark):
        padded, last = np.append(codes, [0, 0]), np.append(opens, True)
        one, two = padded[mark + 1], np.where(last[mark + 2], 0, padded[mark + 2])
        size = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, 0)
        for a, b in ("re", "ve", "ll"):
            size[(one == ord(a)) & (two == ord(b))] = 2
        mark, size = mark[size > 0], size[size > 0]
        start[mark + 1] = False
        rest = mark + 1 + size
        start[rest[rest < n]] = True
    begin = at[start]
    return begin, np.append(begin[1:], len(data))


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ranks of the tokens of a piece: of two neighbours, those of least rank merge first, left before right."""
    n = len(piece)
    after = list(range(1, n + 1))  # where the part that begins here ends; 0 where none begins
    before = list(range(-1, n))  # where the part begins that ends here
    heap = []
    for i in range(n - 1):
        rank = ranks.get(piece[i : i + 2])
        if rank is not None:
            heap.append((rank, i, i + 2))
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        middle = after[i]
        if not middle or middle >= n or after[middle] != end:
            continue
        after[i], after[middle] = end, 0
        if end < n:
            before[end] = i
            rank = ranks.get(piece[i : after[end]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, after[end]))
        left = before[i]
        if left >= 0:
            rank = ranks.get(piece[left:end])
            if rank is not None:
                heapq.heappush(heap, (rank, left, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


def encode_block(data: np.ndarray, offsets: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a block in a row, and where those of each text begin and the last end."""
    begin, end = pieces(data, offsets, vocabulary.classes)
    rank = vocabulary.find(data, begin, end)
    missed = np.flatnonzero(rank < 0)
    cache = worker_cache()
    ranks = cache.get(("ranks", vocabulary.name))
    if ranks is None:
        ranks = cache["ranks", vocabulary.name] = {t: i for i, t in enumerate(vocabulary.tokens)}
    learned = cache.setdefault(("pieces", vocabulary.name), PieceIds())
    first, number = distinct_pieces(data, begin[missed], end[missed])
    different = cut_pieces(data, begin[missed][first], end[missed][first])
    ids, counts = repeated(*learned.of(different, lambda new: [merged(p, ranks) for p in new]), number)
    length, place = np.ones(len(begin), np.int64), rank
    length[missed] = counts
    place[missed] = len(vocabulary.tokens) + np.cumsum(counts) - counts
    flat = np.concatenate((np.arange(len(vocabulary.tokens), dtype=np.uint32), ids))
    upto = np.concatenate(([0], np.cumsum(length)))
    return flat[gathered(place, length)], upto[np.searchsorted(begin, offsets)]


def encoded(docs: DataFrame, vocabulary: Vocabulary, keep: Sequence[str]) -> DataFrame:
    """The columns `keep` with `ids`, the token ids of the whole text.

    A NULL or empty text has no ids. Every row stays, repeated ones too; a column `ids` of `docs` is
    replaced. A text of any length is encoded whole, as a block of its own if it is long.
    """
    keep = [c for c in keep if c != "ids"]
    docs = docs.select(*dict.fromkeys([*keep, "text"]))
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                ids, begins = encode_block(*utf8(block.column("text")), shared.value)
                lists = pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays([*(block.column(c) for c in keep), lists], names=[*keep, "ids"])

    return docs.mapInArrow(run, schema)


def decoded(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Adds `decoded`, the bytes of the tokens `ids`; NULL for NULL. An id that is no rank fails."""
    rows = rows.drop("decoded")
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = shared.value.tokens.__getitem__
        for batch in batches:
            texts = [None if ids is None else b"".join(map(token, ids)) for ids in _lists(batch.column("ids"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], names=[*batch.schema.names, "decoded"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("decoded", T.BinaryType())]))


def _lists(column: pa.Array) -> Iterator[list[int] | None]:
    for row in column:
        yield row.values.to_numpy(zero_copy_only=False).tolist() if row.is_valid else None
