"""Alignment of two tokenizers over the same texts.

Byte offsets where tokens of both end are found by a galloping intersection: the shorter list of
ends drives exponential and then binary searches into the longer one. The common ends cut both
lists into groups, and differences of ranks say how many tokens each group has.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlens.llm.common import PieceIds, blocks, cut_pieces, distinct_pieces, gathered, repeated, utf8, worker_cache
from auditlens.session import settle

# Text whose id pairs are counted together before they are shuffled.
BATCH_BYTES = 8 << 20
# Links of groups that are put together at once.
LINKS_AT_ONCE = 1 << 21

# White space in UTF-8 and the mark of a blank, after which texts are not cut.
_WIDE_SPACES = [
    int.from_bytes(chr(c).encode(), "big")
    for c in (0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x2581, 0x3000, 0xFEFF)
]


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves, the others as characters from 256 on."""
    plain = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    others = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


class _Tokenizers:
    """The two tokenizers of a worker, the bytes of their tokens, and what has been encoded."""

    def __init__(self, byte_level: str, pieces: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel parts
        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        byte = _byte_of_character()
        tokens_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            tokens_a[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        tokens_b = [bytes([int(n[3:5], 16)]) if self.b.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        self.bytes = [_Flat(tokens_a), _Flat(tokens_b)]
        self.known = [PieceIds(), PieceIds()]
        # Pieces that go on after a blank, or blanks that are merged, would cross the cuts.
        self.cuts = not any("▁" in n.lstrip("▁") for n in names) and self.b.encode("a  b ", out_type=str)[-1:] == ["▁"]
        self.blank = self.b.piece_to_id("▁")
        self.size = max(len(tokens_a), len(tokens_b))
        self.written = [b"%d%s" % (i, end) for end in (b",", b"|", b";") for i in range(self.size)]

    @classmethod
    def of_worker(cls, byte_level: str, pieces: str) -> _Tokenizers:
        cache = worker_cache()
        if ("aligned", byte_level, pieces) not in cache:
            cache["aligned", byte_level, pieces] = cls(byte_level, pieces)
        return cache["aligned", byte_level, pieces]

    def encode_a(self, pieces: list[bytes]) -> Iterator[list[int]]:
        coded = self.a.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)
        return (c.ids for c in coded)

    def encode_b(self, pieces: list[bytes]) -> list[list[int]]:
        """The model puts a blank before each text, so the one of the piece goes."""
        coded = self.b.encode([p[1:].decode() for p in pieces], num_threads=1)
        return [[self.blank] if p == b" " else ids for p, ids in zip(pieces, coded)]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For both: ids of all texts in a row, and where those of each text begin and the last end."""
        begin = offsets[:-1][np.diff(offsets) > 0]
        if self.cuts:
            begin = np.union1d(begin, _cuts(data))
        end = np.append(begin[1:], len(data))
        first, number = distinct_pieces(data, begin, end)
        pieces = cut_pieces(data, begin[first], end[first])
        out = []
        for known, encode in zip(self.known, (self.encode_a, self.encode_b)):
            ids, counts = repeated(*known.of(pieces, encode), number)
            upto = np.concatenate(([0], np.cumsum(counts)))
            out.append((ids.astype(np.int64), upto[np.searchsorted(begin, offsets)]))
        return out


class _Flat:
    """The bytes of all tokens in a row."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.length = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.begin = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def __len__(self) -> int:
        return len(self.length)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.data[gathered(self.begin[ids], self.length[ids])]


def _cuts(data: np.ndarray) -> np.ndarray:
    """Blanks after something that is no white space. Tokens of neither kind cross these places:
    white space is one run, and a blank begins a word."""
    at = np.flatnonzero(data == 0x20)
    at = at[at > 0]
    last = data[at - 1]
    two = (data[at - 2].astype(np.int64) << 8) | last
    wide = np.isin(two, _WIDE_SPACES) | np.isin((data[at - 3].astype(np.int64) << 16) | two, _WIDE_SPACES)
    return at[((last > 0x20) & (last < 0x7F)) | ((last >= 0x80) & ~wide)]


def gallop(needles: np.ndarray, start: np.ndarray, low: np.ndarray, high: np.ndarray, values: np.ndarray) -> np.ndarray:
    """First place in [low, high) with a value not less than the needle; values ascend there.

    All needles search at once. From its start a search doubles its steps in the direction of the
    needle until it has passed it, then halves what lies between. The last value must be enough.
    """
    below = values[start] < needles
    low, high = np.where(below, start, low - 1), np.where(below, high - 1, start)  # too small, large enough
    rows, step = np.arange(len(needles)), 1
    while len(rows):
        probe = np.where(below[rows], start[rows] + step, start[rows] - step)
        inside = (probe > low[rows]) & (probe < high[rows])
        rows, probe = rows[inside], probe[inside]
        small = values[probe] < needles[rows]
        low[rows[small]] = probe[small]
        high[rows[~small]] = probe[~small]
        rows = rows[small == below[rows]]
        step *= 2
    rows = np.flatnonzero(high - low > 1)
    while len(rows):
        middle = (low[rows] + high[rows]) // 2
        small = values[middle] < needles[rows]
        low[rows[small]] = middle[small]
        high[rows[~small]] = middle[~small]
        rows = rows[high[rows] - low[rows] > 1]
    return high


def common_ends(ends: list[np.ndarray], cuts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ranks in both lists of the ends that both have. `cuts`: where each text begins in each list."""
    sizes = [np.diff(c) for c in cuts]
    shorter = np.where(sizes[0] <= sizes[1], 0, 1)
    found = []
    for own, other in ((0, 1), (1, 0)):
        text = np.flatnonzero((shorter == own) & (sizes[own] > 0))
        rank = gathered(cuts[own][text], sizes[own][text])
        of = np.repeat(text, sizes[own][text])
        low, high = cuts[other][of], cuts[other][of + 1]
        start = low + (rank - cuts[own][of]) * (high - low) // np.maximum(sizes[own][of], 1)
        place = gallop(ends[own][rank], start, low, high, ends[other])
        both = ends[other][place] == ends[own][rank]
        found.append((rank[both], place[both]) if own == 0 else (place[both], rank[both]))
    a, b = (np.concatenate(c) for c in zip(*found))
    order = np.argsort(a)
    return a[order], b[order]


@dataclass
class _Aligned:
    """Alignment of the texts of a block: figures of each, and its id pairs with how often they are linked."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[bytes]
    pair_counts: np.ndarray
    pairs: np.ndarray  # a * size of the second vocabulary + b, ascending in each text
    links: np.ndarray


def align_block(texts: pa.Array, both: _Tokenizers) -> _Aligned:
    """Align texts that begin with a blank, where they are not empty."""
    data, offsets = utf8(texts)
    coded = both.encode(data, offsets)
    right = np.logical_and.reduce([_same_texts(data, offsets, *c, flat) for c, flat in zip(coded, both.bytes)])
    ids, cuts, ends = [], [], []
    for (own, cut), flat in zip(coded, both.bytes):
        own = own[np.repeat(right, np.diff(cut))]
        ids.append(own)
        cuts.append(np.concatenate(([0], np.cumsum(np.where(right, np.diff(cut), 0)))))
        ends.append(np.cumsum(flat.length[own]))
    last = common_ends(ends, cuts)
    first = [np.concatenate(([0], c[:-1] + 1)) if len(c) else c for c in last]
    size_a, size_b = (c - f + 1 for c, f in zip(last, first))
    group_cuts = np.searchsorted(last[0], cuts[0])
    text_of_group = np.repeat(np.arange(len(right)), np.diff(group_cuts))
    n_links = np.zeros(len(right), np.int64)
    np.add.at(n_links, text_of_group, size_a * size_b)
    keys, links = _linked(ids, (size_a, size_b), text_of_group, both)
    size = len(both.bytes[0]) * len(both.bytes[1])
    return _Aligned(
        np.diff(cuts[0]), np.diff(cuts[1]), np.diff(group_cuts), n_links, _written(ids, last, first, cuts, both),
        np.bincount(keys // size, minlength=len(right)), keys % size, links,
    )


def _same_texts(data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, cuts: np.ndarray, flat: _Flat) -> np.ndarray:
    """Which texts are the joined bytes of their tokens."""
    joined = flat.joined(ids)
    ends = np.concatenate(([0], np.cumsum(flat.length[ids])))[cuts]
    if len(joined) == len(data) and (ends == offsets).all() and (joined == data).all():
        return np.ones(len(offsets) - 1, dtype=bool)
    spans = zip(ends[:-1].tolist(), ends[1:].tolist(), offsets[:-1].tolist(), offsets[1:].tolist())
    return np.array([np.array_equal(joined[a:b], data[c:d]) for a, b, c, d in spans], dtype=bool)


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, and the sum of the values of each."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    begins = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[begins], np.add.reduceat(values[order], begins)


def _linked(ids: list[np.ndarray], sizes: tuple, text_of_group: np.ndarray, both: _Tokenizers) -> tuple[np.ndarray, np.ndarray]:
    """Id pairs of each text, and how many links each has. A group links each id of one side with each
    of the other as often as both stand there, so ids are counted first, and links are put together
    for some of the ids at a time."""
    groups, parts = np.arange(len(text_of_group)), []
    for own, size, flat in zip(ids, sizes, both.bytes):
        key, n = _summed(np.repeat(groups, size) * len(flat) + own, np.ones(len(own), np.int64))
        parts.append((key // len(flat), key % len(flat), n))
    (group_a, a, n_a), (group_b, b, n_b) = parts
    begin_b = np.searchsorted(group_b, groups)
    width = np.bincount(group_b, minlength=len(groups))[group_a]
    piece = np.cumsum(width) // LINKS_AT_ONCE
    cuts = np.flatnonzero(np.diff(piece, prepend=-1))
    keys, links = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), len(width)]):
        at = gathered(begin_b[group_a[i:j]], width[i:j])
        key = (np.repeat(text_of_group[group_a[i:j]] * len(both.bytes[0]) + a[i:j], width[i:j])) * len(both.bytes[1]) + b[at]
        key, n = _summed(key, np.repeat(n_a[i:j], width[i:j]) * n_b[at])
        keys.append(key)
        links.append(n)
    return _summed(np.concatenate(keys), np.concatenate(links))


def _written(ids: list, last: tuple, first: list, cuts: list, both: _Tokenizers) -> list[bytes]:
    """The groups of each text: `a1,a2|b1;a3|b2,b3`."""
    n_a, n_b = len(ids[0]), len(ids[1])
    if not n_a:
        return [b""] * (len(cuts[0]) - 1)
    group_a = np.searchsorted(last[0], np.arange(n_a))
    group_b = np.searchsorted(last[1], np.arange(n_b))
    place_a = np.arange(n_a) + first[1][group_a]
    place_b = np.arange(n_b) + last[0][group_b] + 1
    token, end = np.empty(n_a + n_b, np.int64), np.zeros(n_a + n_b, np.int64)
    token[place_a], token[place_b] = ids[0], ids[1]
    end[place_a[last[0]]], end[place_b[last[1]]] = 1, 2
    token += end * both.size
    bounds = (cuts[0] + cuts[1]).tolist()
    return [b"".join(map(both.written.__getitem__, token[i:j].tolist()))[:-1] for i, j in zip(bounds, bounds[1:])]


def _blank_first(docs: DataFrame) -> DataFrame:
    """Texts with the blank that both tokenizers see before them."""
    return docs.withColumn("text", F.when(F.length("text") > 0, F.concat(F.lit(" "), F.col("text"))))


def aligned_groups(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """Rows (doc_id, groups): the groups of each text as `a1,a2|b1;a3|b2,b3`, ids of both tokenizers.

    A text that is NULL or empty, or that the tokens of one side do not give back, has no groups: ''.
    """
    docs = _blank_first(docs.select("doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _Tokenizers.of_worker(byte_level, pieces)
        for batch in batches:
            for block in blocks(batch):
                groups = [g.decode() for g in align_block(block.column("text"), both).groups]
                yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(groups, pa.string())], names=["doc_id", "groups"])

    return docs.mapInArrow(run, T.StructType([docs.schema["doc_id"], T.StructField("groups", T.StringType())]))


_FIGURES = ("n_a", "n_b", "n_groups", "n_links")


def _counted(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """One row per batch of documents: their figures, their id pairs as a payload, and how many of
    these documents hold each different pair (pair, n), so a frequent pair is a row per batch."""
    docs = _blank_first(docs.select("doc_id", "text"))
    doc_ids = T.ArrayType(docs.schema["doc_id"].dataType)
    lists = {"doc_id": doc_ids, **{c: T.ArrayType(T.LongType()) for c in _FIGURES}, "groups_sha256": T.ArrayType(T.StringType())}
    schema = T.StructType().add("batch", "long")
    for name, kind in lists.items():
        schema = schema.add(name, kind)
    schema = schema.add("payload", "binary").add("pair", T.ArrayType(T.LongType())).add("n", T.ArrayType(T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, task, number = _Tokenizers.of_worker(byte_level, pieces), TaskContext.get().partitionId(), 0
        held: list[tuple[pa.Array, _Aligned, list]] = []
        size = 0

        def row() -> pa.RecordBatch:
            parts = [h[1] for h in held]
            pair, at, n = np.unique(np.concatenate([p.pairs for p in parts]), return_inverse=True, return_counts=True)
            payload = _packed(np.concatenate([p.pair_counts for p in parts]), at, np.concatenate([p.links for p in parts]))
            ids = pa.concat_arrays([h[0] for h in held])
            values = [
                pa.array([(task << 32) + number]),
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                *(_one_list(np.concatenate([getattr(p, c) for p in parts])) for c in _FIGURES),
                pa.array([[d for h in held for d in h[2]]], pa.list_(pa.string())),
                pa.array([payload], pa.binary()),
                _one_list(pair),
                _one_list(n),
            ]
            return pa.RecordBatch.from_arrays(values, names=schema.names)

        for batch in batches:
            for block in blocks(batch):
                part = align_block(block.column("text"), both)
                digests = [hashlib.sha256(g).hexdigest() if n else "" for g, n in zip(part.groups, part.n_a.tolist())]
                part.groups = []
                held.append((block.column("doc_id"), part, digests))
                size += block.column("text").nbytes
                if size >= BATCH_BYTES:
                    yield row()
                    held, size, number = [], 0, number + 1
        if held:
            yield row()

    return docs.mapInArrow(run, schema)


def _one_list(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, pa.int64()))


def _packed(pair_counts: np.ndarray, at: np.ndarray, links: np.ndarray) -> bytes:
    """How many pairs each document has, which, and how many links each, in a compressed row."""
    wide = links[links > 254]
    parts = [np.array([len(pair_counts), len(at)], "<i8"), pair_counts.astype("<i8"), at.astype("<u4"),
             np.minimum(links, 255).astype(np.uint8), wide.astype("<i8")]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(p.tobytes() for p in parts))


def _unpacked(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(payload)
    documents, pairs = np.frombuffer(data, "<i8", 2).tolist()
    counts = np.frombuffer(data, "<i8", documents, 16)
    at = np.frombuffer(data, "<u4", pairs, 16 + 8 * documents)
    links = np.frombuffer(data, np.uint8, pairs, 16 + 8 * documents + 4 * pairs).astype(np.int64)
    links[links == 255] = np.frombuffer(data[16 + 8 * documents + 5 * pairs :], "<i8")
    return counts, at, links


def link_report(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """Rows (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row.

    byte_level: file of a byte-level tokenizer of the tokenizers library; pieces: of a sentencepiece
    model. A pair's count is the number of rows, over all `docs`, that hold it linked; n_best counts
    the links whose count no other partner of their first id exceeds; count_sum adds counts over
    links. A text that is NULL or empty, or that its tokens do not give back, has zeros and ''.
    Repeated rows count and return each. An empty table gives no rows.
    """
    table = settle(_counted(docs, byte_level, pieces), "aligned")
    first = F.expr(f"pair div {_vocabulary_size(pieces)}")
    pairs = table.select("batch", F.posexplode(F.arrays_zip("pair", "n")).alias("place", "p"))
    pairs = pairs.select("batch", "place", "p.pair", "p.n")
    counts = settle(pairs.groupBy("pair").agg(F.sum("n").alias("count")), "pair-counts")
    best = counts.groupBy(first.alias("a")).agg(F.max("count").alias("best"))  # a row per id of the first vocabulary
    marked = counts.withColumn("a", first).join(F.broadcast(best), "a")
    marked = marked.select("pair", (F.col("count") * 2 + (F.col("count") == F.col("best")).cast("long")).alias("value"))
    known = pairs.join(marked, "pair").groupBy("batch").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("v"))
    rows = table.drop("pair", "n").join(known.select("batch", F.col("v.value").alias("value")), "batch", "left")
    names = ["doc_id", *_FIGURES, "groups_sha256", "n_best", "count_sum"]
    schema = T.StructType([T.StructField("doc_id", table.schema["doc_id"].dataType.elementType)])
    for name in names[1:]:
        schema = schema.add(name, "string" if name == "groups_sha256" else "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                of, at, links = _unpacked(row["payload"].as_py())
                value = row["value"].values.to_numpy(zero_copy_only=False) if row["value"].is_valid else np.zeros(0, np.int64)
                document = np.repeat(np.arange(len(of)), of)
                n_best, count_sum = np.zeros(len(of), np.int64), np.zeros(len(of), np.int64)
                np.add.at(n_best, document, links * (value[at] & 1))
                np.add.at(count_sum, document, links * (value[at] >> 1))
                columns = [row[c].values for c in names[:-2]]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(n_best), pa.array(count_sum)], names=names)

    return rows.mapInArrow(run, schema)


def _vocabulary_size(pieces: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces).get_piece_size()
