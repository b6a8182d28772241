"""Small helpers that several operators share."""

from __future__ import annotations

import sys
from array import array
from collections.abc import Callable, Iterable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Classes that the contracts of the operators fix.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
NAME_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Bytes of text that a kernel works on at once. A longer text is a block of its own.
BLOCK_BYTES = 1 << 20


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once, however often the body reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def native_count(text: Column, pattern: str) -> Column:
    """Matches of a pattern in a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("long")


def blocks(batch: pa.RecordBatch, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with up to `limit` bytes of column `text`, one row at least."""
    ends = np.cumsum(pa.compute.binary_length(batch.column("text")).fill_null(0).to_numpy())
    row = 0
    while row < batch.num_rows:
        before = ends[row - 1] if row else 0
        until = max(row + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(row, until - row)
        row = until


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins and the last ends. NULL is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    if not column.buffers()[2]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


# Polynomial hashes of byte ranges modulo 2 to the 64th: any range costs one subtraction and one
# product, once the prefix sums of a block are there.

_BASE = 0x9E3779B97F4A7C15
_BYTE_VALUES = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    table = _powers.get(base)
    if table is None or len(table) < n:
        size = max(n, BLOCK_BYTES + 1)
        table = np.full(size, base % 2**64, dtype=np.uint64)
        table[0] = 1
        _powers[base] = table = np.cumprod(table, dtype=np.uint64)
    return table[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of a hash over all 64."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums of a block of bytes, or of hashes of words, for `range_hash`."""
    values = _BYTE_VALUES[data] if data.dtype == np.uint8 else data
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _power_table(_BASE, len(values)), dtype=np.uint64, out=sums[1:])
    return sums


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of what lies from start to end, the same wherever it stands."""
    inverse = _power_table(pow(_BASE, -1, 2**64), len(sums))
    return mixed((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """Least or greatest of each `width` neighbours, in a logarithmic number of passes."""
    done, out = 1, values
    while done < width:
        step = min(done, width - done)
        out = pick(out[:-step], out[step:])
        done += step
    return out


# Pieces of text, each different one worked on once.

_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(8)] + [2**64 - 1], np.uint64)


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of a block on as one number; zeros follow the block."""
    return np.ndarray(len(data) + 1, "<u8", np.concatenate((data, np.zeros(9, np.uint8))), strides=1)


def same_bytes(a: np.ndarray, begin: np.ndarray, b: np.ndarray, other: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the bytes of `a` from begin on are those of `b` from other on. Both are `eight_bytes`."""
    same = np.ones(len(length), dtype=bool)
    rows = np.flatnonzero(length > 0) if a is not b else np.flatnonzero((length > 0) & (begin != other))
    at = 0
    while len(rows):
        mask = _LOW_BYTES[np.minimum(length[rows] - at, 8)]
        equal = (a[begin[rows] + at] ^ b[other[rows] + at]) & mask == 0
        same[rows[~equal]] = False
        at += 8
        rows = rows[equal]
        rows = rows[length[rows] > at]
    return same


def distinct_pieces(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of each different piece of a block, and the number of each piece among these.

    Pieces meet by hash and are then compared byte by byte; one that differs from the first of its
    hash is on its own.
    """
    _, first, number = np.unique(range_hash(prefix_sums(data), begin, end), return_index=True, return_inverse=True)
    words, length, like = eight_bytes(data), end - begin, first[number]
    same = (length == length[like]) & same_bytes(words, begin, words, begin[like], np.minimum(length, length[like]))
    odd = np.flatnonzero(~same)
    number[odd] = len(first) + np.arange(len(odd))
    return np.concatenate((first, odd)), number


def gathered(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Places of all members of the given ranges, range after range."""
    upto = np.cumsum(length)
    return np.repeat(begin - upto + length, length) + np.arange(upto[-1] if len(upto) else 0)


def worker_cache() -> dict:
    """What a Python worker keeps over all tasks it runs. A lost worker only has to learn anew.

    Functions travel to the workers by value, so a variable of their module lasts one task only.
    """
    module = sys.modules.setdefault("_auditlens_llm_worker", ModuleType("_auditlens_llm_worker"))
    return vars(module).setdefault("cache", {})


def cut_pieces(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[bytes]:
    text = data.tobytes()
    return [text[i:j] for i, j in zip(begin.tolist(), end.tolist())]


class PieceIds:
    """Token ids of pieces of text. A worker remembers short pieces, those it sees first."""

    LIMIT = 200_000
    SHORT = 64

    def __init__(self) -> None:
        self.known: dict[bytes, bytes] = {}

    def of(self, pieces: list[bytes], encode: Callable[[list[bytes]], Iterable[list[int]]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and how many each has. `encode` gives the ids of new pieces."""
        found = list(map(self.known.get, pieces))
        new = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(new, encode([pieces[i] for i in new])):
            found[i] = array("I", ids).tobytes()
            if len(self.known) < self.LIMIT and len(pieces[i]) <= self.SHORT:
                self.known[pieces[i]] = found[i]
        counts = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return np.frombuffer(b"".join(found), np.uint32), counts


def repeated(flat: np.ndarray, counts: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Members of lists in a row, for the lists of the given numbers, and how many each has."""
    return flat[gathered((np.cumsum(counts) - counts)[number], counts[number])], counts[number]
