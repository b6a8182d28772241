"""Byte-level BPE against the tiktoken library."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from auditlens.llm import bpe, common, queries

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.read(PATH)


def encode(texts, vocabulary):
    joined = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in joined])))
    ids, begins = bpe.encode_block(np.frombuffer(b"".join(joined), np.uint8), offsets, vocabulary)
    return [ids[a:b].tolist() for a, b in zip(begins, begins[1:])]


def test_all_characters(library, vocabulary):
    texts = [f"a{c}a1{c}1.{c}. {c} 's" for c in map(chr, (*range(0xD800), *range(0x10000, 0x14000), *range(0x16000, 0x19200), 0x20000, 0xE0001, 0x10FFFF))]
    for i in range(0, len(texts), 20000):
        part = texts[i : i + 20000]
        assert encode(part, vocabulary) == [library.encode_ordinary(t) for t in part]


def test_random_texts(library, vocabulary):
    rng = random.Random(4)
    alphabet = ["a", "s", "t", "'", "'", "re", "ll", "ve", "d", "m", " ", " ", "\n", "\t", "1", "23", ".", "-", "é", "ß", "中", " ", "　", "😀", "Kelvin", "the"]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(0, 30))) for _ in range(20000)]
    assert encode(texts, vocabulary) == [library.encode_ordinary(t) for t in texts]


def test_long_pieces(library, vocabulary):
    rng = random.Random(5)
    texts = ["a" * 3000, "".join(rng.choices("abcdefgh", k=5000)), " " * 2000 + "x", "é中" * 900, "'" * 700, "\n" * 500]
    assert encode(texts, vocabulary) == [library.encode_ordinary(t) for t in texts]


def test_hash_is_minimal_and_perfect():
    for n in (1, 2, 3, 50, 3000):
        keys = np.random.default_rng(n).integers(0, 2**63, n, dtype=np.uint64)
        assert sorted(bpe.PerfectHash.of(keys).places(keys)) == list(range(n))
    with pytest.raises(ValueError):
        bpe.PerfectHash.of(np.array([7, 7], np.uint64))


def test_pieces_with_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(common, "range_hash", lambda sums, a, b: np.zeros(len(a), np.uint64))
    data = np.frombuffer(b"abcabcabxyz", np.uint8)
    begin = np.array([0, 3, 6, 8])
    first, number = common.distinct_pieces(data, begin, np.array([3, 6, 8, 11]))
    assert number[0] == number[1] and len({*number.tolist()}) == 3 and (begin[first[number[2:]]] == [6, 8]).all()


@pytest.mark.parametrize("table", ["documents", "odd", "none"])
def test_encoded_rows(request, spark, library, vocabulary, table, monkeypatch):
    docs = request.getfixturevalue(table)
    monkeypatch.setattr(queries, "read_table", lambda *_: docs)
    expected = []
    for r in docs.select("doc_id", "text").collect():
        ids = library.encode_ordinary(r.text or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        expected.append((r.doc_id, len(ids), digest, hashlib.sha256((r.text or "").encode()).hexdigest()))
    found = [tuple(r) for r in queries.op13_two_tier_bpe(spark, "").collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, expected))


def test_other_columns_stay(odd, vocabulary):
    rows = bpe.decoded(bpe.encoded(odd.withColumn("ids", F.lit("x")), vocabulary, [*odd.columns, "ids"]), vocabulary)
    assert rows.columns == [*odd.columns, "ids", "decoded"] and rows.count() == odd.count()
    assert rows.filter("text IS NOT NULL AND decoded <> CAST(text AS BINARY)").isEmpty()
