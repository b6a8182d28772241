"""Near-duplicates by SimHash fingerprints and multi-index hashing.

A fingerprint is cut into segments. Two fingerprints within the allowed distance agree in some
segment up to a few bits, so each enters a table under its own segments and asks for the small
Hamming ball around them. What shares a table key is verified over all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlens.llm.common import blocks
from auditlens.llm.components import components
from auditlens.session import settle

SEED = 42
SHINGLE_WORDS = 4
MAX_DISTANCE = 4
SEGMENTS = 3

# A table key with more members or questions than this is dealt out over several tasks.
KEY_ROWS = 8192

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """Hashes of the word shingles of a text, repeats included. A text with fewer words is one shingle."""
    words = text.translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words))) + np.arange(len(words))
    begins = np.concatenate(([0], ends[:-1] + 1))
    view, digest = memoryview(joined), xxhash.xxh64_intdigest
    n = len(words) - width + 1
    return np.fromiter(
        [digest(view[i:j], SEED) for i, j in zip(begins[:n].tolist(), ends[width - 1 :].tolist())],
        np.uint64,
        n,
    )


def _fingerprint(text: bytes, width: int) -> int:
    """SimHash of the word shingles of a text, repeats included; 0 without a word."""
    hashes = shingle_hashes(text, width)
    n = len(hashes)
    if n <= 1:
        return int(hashes[0]) if n else 0
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 15):
        bits = np.unpackbits(hashes[i : i + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """Adds `fp`, the fingerprint of the whole text as a signed long; other columns but text stay.

    A NULL or empty text, and one of spaces only, has fingerprint zero.
    """
    columns = [c for c in docs.columns if c not in ("text", "fp")]
    fields = [docs.schema[c] for c in columns]
    docs = docs.select(*columns, "text")
    schema = T.StructType([*fields, T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                texts = block.column("text").cast(pa.binary()).to_pylist()
                fp = np.array([_fingerprint(t or b"", width) for t in texts], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [*(block.column(c) for c in columns), pa.array(fp.view(np.int64))],
                    names=[*columns, "fp"],
                )

    return docs.mapInArrow(run, schema)


def _segments(segments: int) -> list[tuple[int, int]]:
    """Shift and width of each segment."""
    cuts = [round(64 * i / segments) for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _radii(segments: int, distance: int) -> list[int]:
    """Radius to search in each segment so that no pair is missed.

    With distance = segments * a + b, either one of the first b + 1 segments differs by up to a
    bits, or one of the others by less than a.
    """
    a, b = divmod(distance, segments)
    return [a if i <= b else a - 1 for i in range(segments)]


def _table_rows(prints: DataFrame, segments: int, distance: int) -> DataFrame:
    """Rows (key, asks, fp): each fingerprint under its segments, and its questions.

    Two segments that differ in one bit meet once: the one with the bit unset asks. For larger
    differences both halves of the ball are asked for.
    """
    entries: list[Column] = []
    for i, ((shift, width), radius) in enumerate(zip(_segments(segments), _radii(segments, distance))):
        if radius < 0:
            continue
        mask = (1 << width) - 1
        value = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit(mask))
        key = lambda v, i=i: v + F.lit(i << 32)
        entries.append(F.struct(key(value).alias("key"), F.lit(False).alias("asks")))
        for size in range(1, radius + 1):
            for bits in combinations(range(width), size):
                flip = sum(1 << b for b in bits)
                upward = value.bitwiseAND(F.lit(1 << bits[0])) == 0
                entries.append(F.when(upward, F.struct(key(value.bitwiseXOR(F.lit(flip))).alias("key"), F.lit(True).alias("asks"))))
    rows = prints.select("fp", F.explode(F.array(*entries)).alias("e")).filter("e IS NOT NULL")
    return rows.select("e.key", "e.asks", "fp")


def dealt(rows: DataFrame) -> DataFrame:
    """Adds `part`: parts of a key that together hold every pair of a member and another row.

    Members and questions of a key are cut by a hash into groups of about KEY_ROWS; every pair of
    groups is a part. A key of usual size has one. A hot key that only has questions has none.
    """
    sizes = rows.groupBy("key").agg(
        F.ceil(F.count(F.when(~F.col("asks"), 1)) / KEY_ROWS).alias("members"),
        F.ceil(F.count(F.when(F.col("asks"), 1)) / KEY_ROWS).alias("questions"),
    )
    hot = settle(sizes.filter("members > 1 OR questions > 1"), "hot-keys")
    if hot.isEmpty():
        return rows.withColumn("part", F.lit("0"))
    rows = rows.join(hot, "key", "left")
    n, q = F.greatest("members", F.lit(1)), F.greatest("questions", F.lit(1))
    i, j = F.pmod(F.xxhash64("fp"), n), F.pmod(F.xxhash64("fp"), q)
    member = F.concat(
        F.transform(F.sequence(F.lit(0).cast('long'), n - 1), lambda o: F.concat_ws("-", F.lit("m"), F.least(i, o), F.greatest(i, o))),
        F.transform(F.sequence(F.lit(0).cast("long"), q - 1), lambda o: F.concat_ws("-", F.lit("q"), i, o)),
    )
    question = F.transform(F.sequence(F.lit(0).cast('long'), n - 1), lambda o: F.concat_ws("-", F.lit("q"), o, j))
    parts = (
        F.when(F.col("members").isNull(), F.array(F.lit("0")))
        .when(F.col("members") == 0, F.array().cast("array<string>"))
        .when(F.col("asks"), question)
        .otherwise(member)
    )
    return rows.select("key", "asks", "fp", F.explode(parts).alias("part"))


class _Links:
    """Verified links of one task, less those that close a circle."""

    def __init__(self, distance: int) -> None:
        self.distance = distance

    def of(self, group: np.ndarray, asks: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Spanning links within groups. Rows are sorted by group, and members come first in each.

        Neighbours at a growing lag are compared, all groups at once. A pair whose ends are joined
        already adds nothing and is not kept, so a group of n gives n - 1 links at most.
        """
        n = len(fp)
        root = np.arange(n)
        left, right = [], []
        rows, lag = np.flatnonzero(~asks), 1
        while len(rows):
            rows = rows[rows + lag < n]
            rows = rows[group[rows] == group[rows + lag]]
            near = np.bitwise_count(fp[rows] ^ fp[rows + lag]) <= self.distance
            a, b = rows[near], rows[near] + lag
            apart = root[a] != root[b]
            if apart.any():
                for x, y in zip(a[apart].tolist(), b[apart].tolist()):
                    x0, y0 = _find(root, x), _find(root, y)
                    if x0 != y0:
                        root[max(x0, y0)] = min(x0, y0)
                        left.append(x)
                        right.append(y)
                while True:
                    up = root[root]
                    if (up == root).all():
                        break
                    root = up
            lag += 1
        return np.array(left, np.int64), np.array(right, np.int64)


def _find(root: np.ndarray, x: int) -> int:
    while root[x] != x:
        x = int(root[x])
    return x


def links(prints: DataFrame, distance: int = MAX_DISTANCE, segments: int = SEGMENTS) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints within `distance` bits into their classes.

    Every pair of fingerprints is looked at that shares a table key; no pair becomes a row but
    those that join two classes of a task. No link between different classes is lost.
    """
    rows = dealt(_table_rows(prints, segments, distance))
    rows = rows.repartition("key", "part").sortWithinPartitions("key", "part", "asks", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, rest = _Links(distance), None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            key, part = table.column("key").to_numpy(), table.column("part").combine_chunks()
            same = (key == key[-1]) & pa.compute.equal(part, part[-1]).to_numpy(zero_copy_only=False)
            whole = int(same.argmax())
            yield from _found(finder, table.slice(0, whole))
            rest = table.slice(whole)
        if rest is not None:
            yield from _found(finder, rest)

    return rows.mapInArrow(run, "a long, b long")


def _found(finder: _Links, table: pa.Table) -> Iterator[pa.RecordBatch]:
    if not table.num_rows:
        return
    key = table.column("key").to_numpy()
    part = table.column("part").combine_chunks().dictionary_encode().indices.to_numpy()
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1])
    fp = table.column("fp").to_numpy()
    asks = table.column("asks").combine_chunks().to_numpy(zero_copy_only=False)
    a, b = finder.of(np.cumsum(new), asks, fp.view(np.uint64))
    yield pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], names=["a", "b"])


def near_duplicates(
    docs: DataFrame, width: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE, segments: int = SEGMENTS
) -> DataFrame:
    """Rows (doc_id, fp, component_id) for every row: the class of documents linked to each other.

    component_id is the least doc_id of the class; NULL where no document of the class has one.
    Copies share a fingerprint and are one node, so they are never paired. An empty table gives no
    rows; repeated rows are all returned.
    """
    prints = settle(fingerprints(docs.select("doc_id", "text"), width), "fingerprints")
    first = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "first-documents")
    roots = components(links(first.select("fp"), distance, segments))
    classes = first.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    classes = classes.withColumn("root", F.coalesce("root", "fp"))
    least = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = settle(classes.join(least, "root").select("fp", "component_id"), "classes")
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One document of each class stays: the one with the least doc_id.

    Of rows that repeat this doc_id, the first by text stays. Rows without doc_id stay.
    """
    found = near_duplicates(docs, **options)
    return drop_others(docs, found.filter("doc_id = component_id").select("doc_id").distinct())


def drop_others(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of the given doc_id, of each the first by text, and all rows without doc_id."""
    with_id = docs.filter("doc_id IS NOT NULL").join(kept, "doc_id", "left_semi")
    order = [F.col(c) for c in docs.columns if c != "doc_id"]
    one = with_id.groupBy("doc_id").agg(F.min(F.struct(*order)).alias("r")).select("doc_id", "r.*")
    return one.select(*docs.columns).unionByName(docs.filter("doc_id IS NULL"))
