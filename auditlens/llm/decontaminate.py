"""Benchmark decontamination by winnowing.

In every window of words the least hash of the word k-grams inside is its fingerprint. A training
window and a benchmark window with the same words have the same fingerprint, so a join of the
fingerprints misses no shared window. Hits are extended to whole windows and checked word by word.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlens.llm.common import blocks, prefix_sums, range_hash, sliding, utf8

WINDOW_WORDS = 10
# Bytes of benchmark text whose windows go to the executors at once. A larger benchmark is cut into
# blocks, and the documents pass them one after the other.
BENCHMARK_BYTES = 4 << 20

# Bytes of words, lower-cased; all other bytes are 0.
_WORD_BYTE = np.zeros(256, np.uint8)
for _a, _b in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
    _WORD_BYTE[_a : _b + 1] = np.arange(_a, _b + 1)
_WORD_BYTE[0x41:0x5B] = np.arange(0x61, 0x7B)


@dataclass
class _Words:
    """The words of several texts in a row."""

    data: np.ndarray  # lower-cased bytes, 0 between words
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray  # number of the first word of each text, and of all words
    sums: np.ndarray  # prefix sums of the hashes of the words


def _words(texts: pa.Array) -> _Words:
    data, offsets = utf8(texts)
    data = _WORD_BYTE[data]
    inside = data > 0
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    opens[cuts] = inside[cuts]
    closes[cuts - 1] = inside[cuts - 1]
    begin, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    hashes = range_hash(prefix_sums(data), begin, end)
    return _Words(data, begin, end, np.searchsorted(begin, offsets), prefix_sums(hashes))


def _windows(words: _Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of all windows of a length that lie within one text, and their fingerprints."""
    k = (length + 1) // 2
    n = len(words.begin)
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    start = np.arange(n - k + 1)
    least = sliding(range_hash(words.sums, start, start + k), length - k + 1, np.minimum)
    start = np.arange(n - length + 1)
    last = words.first[np.searchsorted(words.first, start, side="right")]
    whole = start + length <= last
    return start[whole], least[whole]


def _plain(words: _Words, start: int, length: int) -> bytes:
    data = words.data[words.begin[start] : words.end[start + length - 1]].tobytes()
    return b" ".join(filter(None, data.split(b"\0")))


def _index(ids: list[str | None], texts: list[str | None]) -> list[tuple]:
    """By window length: fingerprints, window hashes, where their items are listed, items, words."""
    words = _words(pa.array(texts, pa.string()))
    counts = np.diff(words.first)
    index = []
    for length in sorted({min(int(c), WINDOW_WORDS) for c in counts if c}):
        start, prints = _windows(words, length)
        item = np.searchsorted(words.first, start, side="right") - 1
        right = np.minimum(counts[item], WINDOW_WORDS) == length
        start, prints, item = start[right], prints[right], item[right]
        hashes = range_hash(words.sums, start, start + length)
        order = np.argsort(hashes, kind="stable")
        unique, at = np.unique(hashes[order], return_index=True)
        plain = b"\n".join(_plain(words, int(s), length) for s in start[order][at])
        index.append(
            (length, np.unique(prints), unique, np.append(at, len(order)), item[order], plain)
        )
    return [(ids, *entry) for entry in index]


def _benchmark_blocks(benchmark: DataFrame) -> Iterator[tuple[list, list]]:
    """Item ids and texts in blocks of about BENCHMARK_BYTES, by a hash of the item."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").filter("text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = int(total // BENCHMARK_BYTES + 1)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for i in range(count):
        rows = items.filter(block == i).collect()
        yield [r["item_id"] for r in rows], [r["text"] for r in rows]


def mark_contaminated(docs: DataFrame, benchmark: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The columns `keep` with n_words, hits (runs of words: from, until) and items (their ids).

    A benchmark window is any 10 consecutive words of an item, or a whole item of fewer words. Items
    without words have none; items without an id hit words but are not listed. A NULL or empty text
    has no words. Repeated rows are marked alike.
    """
    names = ("n_words", "hits", "items")
    keep = [c for c in keep if c not in names]
    run = T.StructType().add("from", "long").add("until", "long")
    marks = T.StructType().add("n_words", "long").add("hits", T.ArrayType(run)).add("items", T.ArrayType(T.StringType()))
    docs = docs.select(*dict.fromkeys([*keep, "text"]))
    docs = docs.withColumns({m.name: F.lit(None).cast(m.dataType) for m in marks.fields})
    indexes = [_index(*block) for block in _benchmark_blocks(benchmark)]
    for number, index in enumerate(indexes):
        last = number == len(indexes) - 1
        carried = keep if last else list(dict.fromkeys([*keep, "text"]))
        schema = T.StructType([docs.schema[c] for c in carried] + marks.fields)
        docs = docs.mapInArrow(_marker(docs.sparkSession.sparkContext.broadcast(index), carried, schema), schema)
    return docs


def _marker(shared, carried: list[str], schema: T.StructType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = [entry[-1].split(b"\n") for entry in shared.value]
        for batch in batches:
            for block in blocks(batch):
                words = _words(block.column("text"))
                hits = [[(h["from"], h["until"]) for h in old or ()] for old in block.column("hits").to_pylist()]
                items = [set(old or ()) for old in block.column("items").to_pylist()]
                for (ids, length, *tables), plain in zip(shared.value, lines):
                    _extend(words, length, tables, plain, ids, hits, items)
                spans = [[{"from": a, "until": b} for a, b in _merged(h)] for h in hits]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(block.column(c) for c in carried),
                        pa.array(np.diff(words.first)),
                        pa.array(spans, pa.list_(pa.struct([("from", pa.int64()), ("until", pa.int64())]))),
                        pa.array([sorted(i) for i in items], pa.list_(pa.string())),
                    ],
                    names=[*carried, "n_words", "hits", "items"],
                )

    return run


def _member(sorted_values: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values are among the sorted ones, and where they would be."""
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return sorted_values[at] == values, at


def _extend(words: _Words, length: int, tables: list, plain: list[bytes], ids: list, hits: list, items: list) -> None:
    """Put the hits of one window length into the lists of their documents."""
    prints, hashes, at, item = tables[0], tables[1], tables[2], tables[3]
    start, own = _windows(words, length)
    if not len(start) or not len(prints):
        return
    new = np.ones(len(own), dtype=bool)
    new[1:] = own[1:] != own[:-1]
    found, _ = _member(prints, own[new])
    start = start[found[np.cumsum(new) - 1]]
    if not len(start):
        return
    found, place = _member(hashes, range_hash(words.sums, start, start + length))
    document = np.searchsorted(words.first, start, side="right") - 1
    for s, p, d in zip(start[found].tolist(), place[found].tolist(), document[found].tolist()):
        if _plain(words, s, length) == plain[p]:
            first = s - int(words.first[d])
            if hits[d] and hits[d][-1][0] <= first <= hits[d][-1][1]:
                hits[d][-1] = (hits[d][-1][0], max(hits[d][-1][1], first + length))
            else:
                hits[d].append((first, first + length))
            items[d].update(ids[i] for i in item[at[p] : at[p + 1]].tolist() if ids[i] is not None)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows (doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for every document."""
    marked = mark_contaminated(docs, benchmark, ["doc_id"])
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["until"] - h["from"])
    return marked.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that share no window with the benchmark."""
    names = {c: f"__{i}" for i, c in enumerate(docs.columns) if c != "text"}
    marked = mark_contaminated(docs.withColumnsRenamed(names), benchmark, ["text", *names.values()])
    clean = marked.filter(F.size("hits") == 0).drop("n_words", "hits", "items")
    return clean.withColumnsRenamed({v: k for k, v in names.items()}).select(*docs.columns)
