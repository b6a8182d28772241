"""Token ids in binary files: fixed-size blocks, cut into planes, each plane compressed.

A file is Parquet that Spark writes and commits; each row is a segment: the ids of some whole
documents in a row. Its ids are cut into blocks of a fixed number. A block is transposed, so that
bytes (or bits) of equal weight stand together, and each plane is compressed by zstandard. The row
also holds the chunk index (where each plane begins) and the documents with their lengths, so any
segment can be read alone.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from auditlens.llm.common import blocks, worker_cache
from auditlens.session import shared_folder

END_ID = 1
BLOCK_IDS = 1 << 16
SEGMENT_IDS = 1 << 18
PLANES = "byte"
LEVEL = 3
# Pieces of text whose ids a task remembers.
CACHED_PIECES = 400_000
PIECES_AT_ONCE = 4096

SEGMENTS = """part int, seq long, doc_ids array<long>, lengths array<long>, n_ids long, planes string,
    chunk_index array<long>, payload binary"""


def to_planes(ids: np.ndarray, planes: str) -> list[bytes]:
    """The planes of one block of unsigned 32-bit ids, lowest weight first."""
    rows = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if planes == "byte":
        return [rows[:, i].tobytes() for i in range(4)]
    bits = np.unpackbits(rows, axis=1, bitorder="little")
    return [np.packbits(bits[:, i], bitorder="little").tobytes() for i in range(32)]


def from_planes(found: list[bytes], n: int, planes: str) -> np.ndarray:
    """The ids that `to_planes` took apart."""
    if planes == "byte":
        rows = np.stack([np.frombuffer(p, np.uint8) for p in found], axis=1)
    else:
        bits = np.stack(
            [np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in found], axis=1
        )
        rows = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(rows).view("<u4").reshape(-1)


def pack(ids: np.ndarray, planes: str = PLANES, block: int = BLOCK_IDS) -> tuple[bytes, list[int]]:
    """Payload of a segment and its chunk index: where each plane begins, and the end."""
    compress = zstandard.ZstdCompressor(level=LEVEL).compress
    parts = [compress(p) for i in range(0, len(ids), block) for p in to_planes(ids[i : i + block], planes)]
    return b"".join(parts), [0, *np.cumsum([len(p) for p in parts]).tolist()]


def unpack(payload: bytes, index: list[int], n: int, planes: str = PLANES, block: int = BLOCK_IDS) -> np.ndarray:
    """The ids of a segment."""
    expand = zstandard.ZstdDecompressor().decompress
    per_block = 4 if planes == "byte" else 32
    out = []
    for number, i in enumerate(range(0, n, block)):
        cuts = index[number * per_block : (number + 1) * per_block + 1]
        out.append(from_planes([expand(payload[a:b]) for a, b in zip(cuts, cuts[1:])], min(block, n - i), planes))
    return np.concatenate(out) if out else np.zeros(0, "<u4")


class _Numbers(dict):
    """Numbers of pieces. A piece that is not known gets the next number, and is noted as new."""

    def __init__(self, known: dict[bytes, int]) -> None:
        super().__init__(known)
        self.new: list[bytes] = []

    def __missing__(self, piece: bytes) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number


class _Encoder:
    """Encodes texts with a tokenizer, each different piece of text once.

    Texts are cut at blanks and line ends, which the tokenizer drops and never joins tokens across,
    and between an ASCII letter or digit and a full stop or comma that ends a word, where its own
    pattern cuts as well. ASCII letters are lower-cased first, as it does itself. The tokenizer looks
    for its special tokens before it lower-cases, so a text that may hold one is encoded whole. So
    the ids are those of the whole text.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.may_be_special = re.compile("|".join(map(re.escape, special)), re.I) if special else None
        # An empty piece has no ids; the piece that ends a text has the end id.
        self.end = 1
        self.number = _Numbers({b"": 0, _END: self.end})
        self.flat = np.array([END_ID], np.uint32)
        self.begin, self.length = np.zeros(2, np.int64), np.array([0, 1])

    def _learn(self, new: list[bytes]) -> None:
        """Remember the ids of new pieces, encoded as the words of one text."""
        ids, lengths = [self.flat], [np.zeros(0, np.int64)]
        for i in range(0, len(new), PIECES_AT_ONCE):
            pieces = [p.decode() for p in new[i : i + PIECES_AT_ONCE]]
            coded = self.tokenizer.encode(pieces, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(coded.ids, np.uint32))
            lengths.append(np.bincount(np.array(coded.word_ids, np.int64), minlength=len(pieces)))
        length = np.concatenate(lengths)
        self.begin = np.concatenate((self.begin, len(self.flat) + np.cumsum(length) - length))
        self.length = np.concatenate((self.length, length))
        self.flat = np.concatenate(ids)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, with the end id."""
        whole = [i for i, t in enumerate(texts) if self.may_be_special and self.may_be_special.search(t)]
        if not whole:
            return self._encode_pieces(texts)
        coded = self._encode_pieces(["" if i in set(whole) else t for i, t in enumerate(texts)])
        for i in whole:
            ids = self.tokenizer.encode(texts[i], add_special_tokens=False).ids
            coded[i] = np.array([*ids, END_ID], np.uint32)
        return coded

    def _encode_pieces(self, texts: list[str]) -> list[np.ndarray]:
        # All texts in one run of bytes. No UTF-8 text holds the byte of the end piece.
        run = b"".join([part for text in texts for part in (text.encode(), b" ", _END, b" ")]).lower()
        pieces = _cut_at_word_ends(run).replace(b"\n", b" ").split(b" ")
        known, used = len(self.number), len(self.flat)
        number = np.fromiter(map(self.number.__getitem__, pieces), np.int64, len(pieces))
        new, self.number.new = self.number.new, []
        self._learn(new)
        begin, length = self.begin[number], self.length[number]
        upto = np.cumsum(length)
        ids = self.flat[np.repeat(begin - upto + length, length) + np.arange(upto[-1] if len(upto) else 0)]
        if known + len(new) > CACHED_PIECES:  # what was seen first, and so is frequent, stays known
            for piece in new:
                del self.number[piece]
            self.flat, self.begin, self.length = self.flat[:used], self.begin[:known], self.length[:known]
        return np.split(ids, upto[number == self.end])[:-1]


_END = b"\xff"
_PLAIN = np.isin(np.arange(256), np.frombuffer(b"0123456789abcdefghijklmnopqrstuvwxyz", np.uint8))
_BLANK = np.isin(np.arange(256), np.frombuffer(b" \n", np.uint8))


def _cut_at_word_ends(text: bytes) -> bytes:
    """The text with a blank between a plain letter or digit and a full stop or comma that ends a word."""
    data = np.frombuffer(text, np.uint8)
    at = np.flatnonzero((data == ord(".")) | (data == ord(",")))
    at = at[_PLAIN[data[at - 1]] & (at > 0)]
    at = at[(at == len(data) - 1) | _BLANK[data[np.minimum(at + 1, len(data) - 1)]]]
    return np.insert(data, at, ord(" ")).tobytes() if len(at) else text


def write_token_files(docs: DataFrame, tokenizer: str, path: str, planes: str = PLANES) -> None:
    """Write the ids of all documents in ascending order of doc_id, NULL first, then by text.

    Documents are dealt out by ranges of doc_id before they are encoded, so each text is encoded
    once, by the task that writes it. A NULL text is an empty one and has the end id alone.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = worker_cache()
        encoder = known.get(("encoder", tokenizer)) or known.setdefault(("encoder", tokenizer), _Encoder(tokenizer))
        part, seq = TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        coded: list[np.ndarray] = []

        def segment() -> pa.RecordBatch:
            ids = np.concatenate(coded)
            payload, index = pack(ids, planes)
            row = {
                "part": part, "seq": seq, "doc_ids": doc_ids, "lengths": [len(c) for c in coded],
                "n_ids": len(ids), "planes": planes, "chunk_index": index, "payload": payload,
            }
            return pa.RecordBatch.from_pylist([row], schema=_SEGMENT_TYPE)

        held = 0
        for batch in batches:
            for block in blocks(batch):
                names, texts = block.column("doc_id").to_pylist(), block.column("text").to_pylist()
                for name, ids in zip(names, encoder.encode(texts)):
                    doc_ids.append(name)
                    coded.append(ids)
                    held += len(ids)
                    if held >= SEGMENT_IDS:
                        yield segment()
                        doc_ids, coded, held, seq = [], [], 0, seq + 1
        if coded:
            yield segment()

    rows.mapInArrow(run, SEGMENTS).write.parquet(path)


_SEGMENT_TYPE = pa.schema(
    [
        ("part", pa.int32()), ("seq", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())), ("n_ids", pa.int64()), ("planes", pa.string()),
        ("chunk_index", pa.list_(pa.int64())), ("payload", pa.binary()),
    ]
)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32.

    Where a segment starts follows from sums over the writing tasks, and over the segments of each.
    """
    segments = spark.read.schema(SEGMENTS).parquet(path)
    sizes = segments.select("part", "seq", "n_ids")
    in_order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(in_order), F.lit(0)).alias("before"))
    in_part = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.join(parts, "part").withColumn(
        "begin", F.col("before") + F.coalesce(F.sum("n_ids").over(in_part), F.lit(0))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids = unpack(row["payload"], row["chunk_index"], row["n_ids"], row["planes"])
                ends = np.cumsum(row["lengths"])
                crc = [zlib.crc32(p.tobytes()) for p in np.split(ids, ends[:-1])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * len(crc), pa.int32()),
                        pa.array([row["seq"]] * len(crc), pa.int64()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(ends - row["lengths"]),
                        pa.array(row["lengths"], pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["part", "seq", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    found = segments.mapInArrow(
        run, "part int, seq long, doc_id long, inside long, n_tokens long, ids_crc32 long"
    )
    placed = found.join(begins.select("part", "seq", "begin"), ["part", "seq"])
    return placed.select("doc_id", (F.col("begin") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def tokenized(docs: DataFrame, tokenizer: str, path: str | None = None, planes: str = PLANES) -> DataFrame:
    """Write the token files of `docs` and read them back; without a path, in the shared folder."""
    import uuid

    spark = docs.sparkSession
    path = path or f"{shared_folder(spark)}/auditlens/tokens-{uuid.uuid4().hex}"
    write_token_files(docs, tokenizer, path, planes)
    return read_token_files(spark, path)
