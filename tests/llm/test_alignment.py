"""Alignment of two tokenizers against a brute-force version."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from auditlens.llm import alignment

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def byte_level():
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in keep]
    return {**{chr(b): b for b in keep}, **{chr(256 + i): b for i, b in enumerate(rest)}}


BYTES = byte_level()


def groups(text, a, b):
    """Groups of id lists, or none."""
    if not text:
        return []
    ids = [a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)]
    of_a = [bytes(BYTES[c] for c in a.id_to_token(i)) for i in ids[0]]
    names = [b.id_to_piece(i) for i in ids[1]]
    of_b = [bytes([int(n[3:5], 16)]) if b.is_byte(i) else n.replace("▁", " ").encode() for i, n in zip(ids[1], names)]
    if {b"".join(of_a), b"".join(of_b)} != {(" " + text).encode()}:
        return []
    ends = [set(np.cumsum([len(t) for t in of]).tolist()) for of in (of_a, of_b)]
    common, out, at = ends[0] & ends[1], [([], [])], [0, 0]
    parts = []
    for side, of in enumerate((of_a, of_b)):
        lists, current, end = [], [], 0
        for i, token in zip(ids[side], of):
            current.append(i)
            end += len(token)
            if end in common:
                lists.append(current)
                current = []
        parts.append(lists)
    return list(zip(*parts))


def report(rows, a, b):
    every = [groups(t, a, b) for _, t in rows]
    linked = [collections.Counter((x, y) for g in gs for x in g[0] for y in g[1]) for gs in every]
    counts = collections.Counter(p for links in linked for p in links)
    best = collections.defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    for (d, _), gs, links in zip(rows, every, linked):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in gs)
        yield (
            d, sum(len(g[0]) for g in gs), sum(len(g[1]) for g in gs), len(gs), sum(links.values()),
            sum(n for p, n in links.items() if counts[p] == best[p[0]]), sum(n * counts[p] for p, n in links.items()),
            hashlib.sha256(text.encode()).hexdigest() if gs else "",
        )


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("table, size", [("documents", 8 << 20), ("documents", 1), ("odd", 8 << 20), ("odd", 1), ("none", 1)])
def test_link_report(request, libraries, table, size, monkeypatch):
    monkeypatch.setattr(alignment, "BATCH_BYTES", size)
    monkeypatch.setattr(alignment, "LINKS_AT_ONCE", 64 if size == 1 else 1 << 21)
    docs = request.getfixturevalue(table)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = alignment.link_report(docs, A, B).select(*COLUMNS).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, report(rows, *libraries)))


def test_random_texts(libraries):
    rng = random.Random(7)
    alphabet = ["a", "the", "s", "'s", " ", " ", "  ", "\n", "\t", " ", "　", "▁", "é", "中文", "1", "23", ".", ",", "<s>", "<|endoftext|>", "<0x41>", "😀", "\x00", "\x85"]
    texts = [None, "", " ", "  ", "\n", *("".join(rng.choices(alphabet, k=rng.randrange(1, 25))) for _ in range(4000))]
    both = alignment._Tokenizers(A, B)
    assert both.cuts
    found = alignment.align_block(pa.array([" " + t if t else None for t in texts], pa.string()), both)
    for t, g in zip(texts, found.groups):
        expected = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups(t, *libraries))
        assert g.decode() == expected, repr(t)
    assert sum(map(bool, found.groups)) > 2000


def test_gallop_finds_the_first_not_less():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 10, 1000):
        values = np.unique(rng.integers(0, 5 * n, n))
        needles = rng.integers(0, values[-1] + 1, 300)
        zero = np.zeros(300, np.int64)
        found = alignment.gallop(needles, rng.integers(0, len(values), 300), zero, zero + len(values), values)
        assert (found == np.searchsorted(values, needles)).all()


def test_groups_are_texts(odd, libraries):
    found = {(r.doc_id, r.groups) for r in alignment.aligned_groups(odd, A, B).collect()}
    rows = {(r.doc_id, r.text) for r in odd.collect()}
    assert found == {(d, ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups(t, *libraries))) for d, t in rows}
