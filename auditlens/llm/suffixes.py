"""Removal of passages that an earlier document holds, by sorted suffixes.

Any 50-byte string has one anchor: the first place in it whose 20-byte gram has the least hash. Equal
strings have equal anchors, so each suffix needs to be sorted only once, next to others with the same
anchor gram.

1. Anchors of all texts meet by the hash of their gram, with a hash of the bytes around, which are those
   of the strings that have this anchor. Where the surroundings as a whole stand in an earlier document,
   all of them are removed.
2. Where a gram stands in different surroundings, the suffixes around it are sorted: by multikey
   quicksort to a shallow depth, and groups that are still equal there by blind tries. Suffixes
   equal over 50 bytes end in one leaf, and the least doc_id of the leaf stays.
3. A gram with very many surroundings is not sorted in one task. They are sorted by batches of anchors,
   and only the least document of each different suffix goes on: neighbouring suffixes in one row,
   which meet by the bytes that all of them hold. Where very many meet there too, they are parted
   again, down to single suffixes, of which only equal ones meet, one from each batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlens.llm.common import blocks, prefix_sums, range_hash, shuffle_partitions, sliding, utf8
from auditlens.session import settle

LENGTH = 50
GRAM = 20
BEFORE = LENGTH - GRAM
# Eight-byte characters that the multikey quicksort looks at before blind tries take over.
SHALLOW = 2
# Surroundings that are sorted at once. A gram with more of them is sorted offset by offset.
AT_ONCE = 4096
# A group with more rows than this is not brought to one task but parted first, from one width to the
# next: so many neighbouring suffixes share a row.
HOT_ROWS = 4096
WIDTHS = (BEFORE + 1, 8, 1)

# A place holds, from its lowest bit: where the gram begins in its text, how many bytes before it the
# surroundings begin, how many suffixes follow the one that begins there, and a tag of the text.
_AT_BITS = 32
_STEP_BITS = 5
_MORE_BITS = _AT_BITS + _STEP_BITS
_TAG_BITS = _MORE_BITS + _STEP_BITS


def _anchors(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all anchors: hash of the gram, hash of the surroundings, number of the text, place without tag."""
    data, offsets = utf8(texts)
    n = len(data)
    if n < LENGTH:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    sums = prefix_sums(data)
    start = np.arange(n - GRAM + 1)
    grams = range_hash(sums, start, start + GRAM)
    low = np.uint64((1 << _AT_BITS) - 1)
    least = sliding((grams & ~low) | start.astype(np.uint64), LENGTH - GRAM + 1, np.minimum) & low
    ends = np.repeat(offsets[1:], np.diff(offsets))
    whole = np.flatnonzero(start[: len(least)] + LENGTH <= ends[: len(least)])
    if not len(whole):
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    anchor = least[whole].astype(np.int64)
    begins = np.flatnonzero(_runs(anchor))
    place, left, last = anchor[begins], whole[begins], whole[np.append(begins[1:], len(anchor)) - 1]
    text = np.searchsorted(offsets, place, side="right") - 1
    around = range_hash(sums, left, last + LENGTH) ^ (place - left).astype(np.uint64)
    steps = (place - left) << _AT_BITS | (last - left) << _MORE_BITS
    return grams[place], around, text, place - offsets[text] | steps


def _at(place: np.ndarray) -> np.ndarray:
    return place & ((1 << _AT_BITS) - 1)


def _before(place: np.ndarray) -> np.ndarray:
    return place >> _AT_BITS & ((1 << _STEP_BITS) - 1)


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of 64-bit values as compressed byte planes."""
    planes = [c.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpacked(payload: bytes, columns: int) -> list[np.ndarray]:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), np.uint8)
    planes = data.reshape(columns, 8, -1)
    return [np.ascontiguousarray(p.T).view("<u8").reshape(-1) for p in planes]


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before."""
    new = np.ones(len(columns[0]), dtype=bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def _combined(grams, around, doc, place) -> tuple[np.ndarray, ...]:
    """Rows sorted by gram, surroundings and document; which lie in a later document than the first
    of their surroundings; and where new surroundings begin."""
    order = np.lexsort((place, doc, around, grams))
    grams, around, doc, place = grams[order], around[order], doc[order], place[order]
    new = _runs(grams, around)
    first = doc[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
    return grams, around, doc, place, doc > first, new


def _find_anchors(bucket_count: int):
    """Fragments (bucket, payload) of the anchors of a batch of documents.

    Anchors with the same surroundings are combined here already: only those of the least document
    go on, and the others are known to be removed. So a passage that very many documents share
    brings one anchor per batch to where it meets the rest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for block in blocks(batch):
                grams, around, text, place = _anchors(block.column("text"))
                doc = block.column("doc_id").to_numpy(zero_copy_only=False)[text]
                tag = block.column("tag").to_numpy(zero_copy_only=False)[text]
                parts.append((grams, around, doc, place + (tag << _TAG_BITS)))
            joined = (np.concatenate(c) for c in zip(*parts))
            grams, around, doc, place, gone, _ = _combined(*joined)
            if gone.any():
                bucket = int(doc[gone][0]) % bucket_count
                yield _fragments([bucket], [True], [_packed(doc[gone], place[gone])])
            rest = ~gone
            grams, around, doc, place = grams[rest], around[rest], doc[rest], place[rest]
            if not len(grams):
                continue
            bucket = (grams % np.uint64(bucket_count)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(_runs(bucket[order]))
            rows = np.split(order, cuts[1:])
            yield _fragments(
                [int(bucket[r[0]]) for r in rows],
                [False] * len(rows),
                [_packed(grams[r], around[r], doc[r], place[r]) for r in rows],
            )

    return run


def _fragments(buckets: list[int], gone: list[bool], payloads: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(buckets, pa.int32()), pa.array(gone), pa.array(payloads, pa.binary())],
        names=["bucket", "gone", "payload"],
    )


def _meet(hot_rows: int):
    """Rows (gram, hot, doc_id, place): gram is NULL where the surroundings are removed as a whole, and
    set where they have to be compared with others of the same gram; hot tells whether these are more
    than `hot_rows`. One bucket at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        current = None
        for batch in batches:
            for bucket, gone, payload in zip(*(batch.column(c).to_pylist() for c in ("bucket", "gone", "payload"))):
                if gone:
                    doc, place = _unpacked(payload, 2)
                    yield _met(doc, place)
                    continue
                if bucket != current and held:
                    yield from _bucket(held, hot_rows)
                    held = []
                current = bucket
                held.append(payload)
        if held:
            yield from _bucket(held, hot_rows)

    return run


def _met(doc: np.ndarray, place: np.ndarray, grams: np.ndarray | None = None, hot: np.ndarray | None = None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.nulls(len(doc), pa.int64()) if grams is None else pa.array(grams.view(np.int64)),
            pa.nulls(len(doc), pa.bool_()) if hot is None else pa.array(hot),
            pa.array(doc.view(np.int64)),
            pa.array(place.view(np.int64)),
        ],
        names=["gram", "hot", "doc_id", "place"],
    )


def _bucket(payloads: list[bytes], hot_rows: int) -> Iterator[pa.RecordBatch]:
    columns = [np.concatenate(c) for c in zip(*(_unpacked(p, 4) for p in payloads))]
    columns[2] = columns[2].view(np.int64)
    grams, _, doc, place, gone, new = _combined(*columns)
    if gone.any():
        yield _met(doc[gone], place[gone])
    new_gram = _runs(grams)
    of_gram, begins = np.cumsum(new_gram) - 1, np.flatnonzero(new_gram)
    kinds = np.bincount(of_gram, weights=new)
    least, most = np.minimum.reduceat(doc, begins), np.maximum.reduceat(doc, begins)
    compare = ~gone & ((kinds > 1) & (least < most))[of_gram]
    if compare.any():
        hot = np.bincount(of_gram, weights=compare)[of_gram] > hot_rows
        yield _met(doc[compare], place[compare], grams[compare], hot[compare])


# The suffixes around grams that stand in different surroundings.


def _shallow(group: np.ndarray, suffixes: np.ndarray) -> np.ndarray:
    """Rank of each suffix by its group and first bytes, equal where these are equal.

    Multikey quicksort on eight-byte characters: a pass sorts those by their next character that
    are equal so far, and leaves alone those that are placed.
    """
    characters = np.ascontiguousarray(suffixes[:, : 8 * SHALLOW]).view(">u8").astype(np.uint64)
    rank = group
    for depth in range(SHALLOW):
        order = np.lexsort((characters[:, depth], rank))
        new = _runs(rank[order], characters[order, depth])
        after = np.empty(len(rank), np.int64)
        after[order] = np.cumsum(new) - 1
        rank = after
    return rank


class _BlindTrie:
    """A trie of the places where strings part; the rest of each string is looked at once.

    An inner node is [depth, children]; a leaf is (string, members).
    """

    def __init__(self) -> None:
        self.root = None

    def insert(self, string: bytes, member: int) -> None:
        node = self.root
        if node is None:
            self.root = (string, [member])
            return
        while type(node) is list:
            children = node[1]
            node = children.get(string[node[0]]) or next(iter(children.values()))
        other = node[0]
        if other == string:
            node[1].append(member)
            return
        differ = int.from_bytes(string, "big") ^ int.from_bytes(other, "big")
        depth = len(string) - (differ.bit_length() + 7) // 8
        above, node = None, self.root
        while type(node) is list and node[0] < depth:
            above, node = node, node[1][string[node[0]]]
        if type(node) is list and node[0] == depth:
            node[1][string[depth]] = (string, [member])
            return
        parted = [depth, {other[depth]: node, string[depth]: (string, [member])}]
        if above is None:
            self.root = parted
        else:
            above[1][string[above[0]]] = parted

    def leaves(self) -> Iterator[list[int]]:
        """Members of each leaf, in the order of the strings."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if type(node) is list:
                stack.extend(child for _, child in sorted(node[1].items(), reverse=True))
            else:
                yield node[1]


def _later(group: np.ndarray, suffixes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which suffixes are equal to one of a lesser document in their group."""
    out = np.zeros(len(doc), dtype=bool)
    if len(doc) < 2:
        return out
    rank = _shallow(group, suffixes)
    order = np.argsort(rank, kind="stable")
    begins = np.flatnonzero(_runs(rank[order]))
    ends = np.append(begins[1:], len(order))
    least, most = np.minimum.reduceat(doc[order], begins), np.maximum.reduceat(doc[order], begins)
    deep = (least < most) & (ends - begins > 1)
    width, data = suffixes.shape[1], suffixes.tobytes()
    for a, b in zip(begins[deep].tolist(), ends[deep].tolist()):
        trie = _BlindTrie()
        members = order[a:b].tolist()
        for i in members:
            trie.insert(data[i * width : (i + 1) * width], i)
        for leaf in trie.leaves():
            if len(leaf) > 1:
                docs = doc[leaf]
                first = docs.min()
                out[[i for i, d in zip(leaf, docs.tolist()) if d > first]] = True
    return out


def _compare(width: int):
    """Runs (doc_id, tag, span) that the suffixes of groups give, and those that are known. Rows come
    sorted by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table, known = _open_and_known(batch)
            if known.num_rows:
                yield _known_runs(*(known.column(c).to_numpy() for c in ("doc_id", "place", "span")))
            if not table.num_rows:
                continue
            table = table if rest is None else pa.concat_tables([rest, table])
            group = table.column("group").to_numpy()
            cuts = np.append(np.flatnonzero(_runs(group)), len(group))
            begin = 0
            for i in range(1, len(cuts) - 1):
                if cuts[i + 1] - begin > AT_ONCE and cuts[i] > begin:
                    yield _sorted_around(table.slice(begin, cuts[i] - begin), width)
                    begin = int(cuts[i])
            last = int(cuts[-2])
            if last > begin:
                yield _sorted_around(table.slice(begin, last - begin), width)
            rest = table.slice(last)
        if rest is not None:
            yield _sorted_around(rest, width)

    return run


def _bytes_of(around: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all surroundings, and where each begins in them and the last ends."""
    around = around.cast(pa.large_binary())
    offsets = np.frombuffer(around.buffers()[1], np.int64)[around.offset : around.offset + len(around) + 1]
    return np.frombuffer(around.buffers()[2], np.uint8), offsets


class _Around:
    """Anchors with bytes around them, and the suffixes that begin `first` and up to `width` - 1 more
    bytes before each. Without a column `first` it is 0, and all suffixes that fit are open."""

    def __init__(self, table: pa.Table, width: int) -> None:
        self.width = width
        self.group, self.doc, self.place = (table.column(c).to_numpy() for c in ("group", "doc_id", "place"))
        self.data, self.offsets = _bytes_of(table.column("around").combine_chunks())
        parted = "first" in table.column_names
        self.first = table.column("first").to_numpy().astype(np.int64) if parted else np.zeros(len(self.doc), np.int64)
        self.at = _at(self.place)
        self.left = np.minimum(_before(self.place), self._reach(self.first, width))
        steps = np.arange(width)
        self.ahead = self.first[:, None] + steps
        left = self.left[:, None]
        self.open = (self.ahead <= left) & (left - self.ahead + LENGTH <= np.diff(self.offsets)[:, None])
        if parted:
            self.open &= (table.column("open").to_numpy()[:, None] >> steps & 1).astype(bool)

    @staticmethod
    def _reach(first: np.ndarray, width: int) -> np.ndarray:
        """How far before an anchor the bytes of a row begin, if its surroundings go so far."""
        return np.minimum(first + width - 1, BEFORE)

    def _suffixes(self, rows: np.ndarray, steps: np.ndarray) -> np.ndarray:
        start = self.offsets[rows] + self.left[rows] - self.ahead[rows, steps]
        return self.data[start[:, None] + np.arange(LENGTH)]

    def later(self) -> np.ndarray:
        """By anchor and step before it: whether a lesser document here has the suffix too.

        Up to AT_ONCE anchors are sorted at once; more of them, which are those of one group, step by
        step.
        """
        group = np.cumsum(_runs(self.group)) if len(self.group) else self.group
        gone = np.zeros(self.open.shape, dtype=bool)

        def sort(rows: np.ndarray, steps: np.ndarray) -> None:
            gone[rows, steps] = _later(group[rows] * self.width + steps, self._suffixes(rows, steps), self.doc[rows])

        if len(self.group) <= AT_ONCE:
            sort(*np.nonzero(self.open))
        else:
            for step in range(self.width):
                rows = np.flatnonzero(self.open[:, step])
                sort(rows, np.full(len(rows), step))
        return gone

    def runs(self, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(doc_id, place, span) of the bytes that suffixes cover, neighbours in one span."""
        gone = gone[:, ::-1]
        edge = np.zeros((len(gone), 1), np.int8)
        step = np.diff(np.concatenate((edge, gone.astype(np.int8), edge), axis=1), axis=1)
        row, begin = np.nonzero(step == 1)
        _, end = np.nonzero(step == -1)
        at = self.at[row] - (self.first[row] + self.width - 1) + begin
        return self.doc[row], self.place[row], at * 256 + (end - begin - 1 + LENGTH)

    def parts(self, still: np.ndarray, width: int) -> pa.RecordBatch:
        """Rows with the suffixes that are `still` open, up to `width` neighbours in one.

        Their group is a hash of the bytes that all these suffixes hold, so equal suffixes are in the
        same group.
        """
        count = -(-self.width // width)
        bits = np.zeros((len(still), count * width), dtype=bool)
        bits[:, : self.width] = still
        bits = bits.reshape(len(still), count, width)
        row, part = np.nonzero(bits.any(axis=2))
        first = self.first[row] + part * width
        anchor = self.offsets[row] + self.left[row]
        begin = anchor - np.minimum(self.left[row], self._reach(first, width))
        size = np.minimum(anchor - first + LENGTH, self.offsets[row + 1]) - begin
        ends = np.concatenate(([0], np.cumsum(size)))
        data = self.data[np.repeat(begin - ends[:-1], size) + np.arange(ends[-1])]
        shared = anchor - first
        group = range_hash(prefix_sums(self.data), shared, shared + LENGTH + 1 - width) ^ first.astype(np.uint64)
        buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data.tobytes())]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(group.view(np.int64)),
                pa.array(first.astype(np.int32)),
                pa.array((bits[row, part] << np.arange(width)).sum(axis=1).astype(np.int32)),
                pa.BinaryArray.from_buffers(pa.binary(), len(row), buffers),
                pa.array(self.doc[row]),
                pa.array(self.place[row]),
                pa.nulls(len(row), pa.int64()),
            ],
            names=_PART_NAMES,
        )


_PARTS = "group long, first int, open int, around binary, doc_id long, place long, span long"
_PART_NAMES = [column.split()[0] for column in _PARTS.split(", ")]


def _open_and_known(batch: pa.RecordBatch) -> tuple[pa.Table, pa.Table]:
    """Rows with suffixes to compare, and rows that are known spans."""
    table = pa.Table.from_batches([batch])
    if "span" not in table.column_names:
        return table, table.slice(0, 0)
    known = table.column("span").is_valid()
    return table.filter(pa.compute.invert(known)), table.filter(known)


def _part(width: int, narrower: int):
    """Rows of groups that are too large for one task, parted.

    Those of a batch are sorted here already: what a lesser document of the batch has too is removed,
    whatever others hold, and comes as a known span, with a group that spreads such rows. What is left
    is one document for each different suffix.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table, known = _open_and_known(batch)
            if known.num_rows:
                yield from known.select(_PART_NAMES).to_batches()
            for begin in range(0, table.num_rows, AT_ONCE):
                around = _Around(table.slice(begin, AT_ONCE).sort_by("group"), width)
                gone = around.later()
                doc, place, span = around.runs(gone)
                none = [pa.nulls(len(doc), t) for t in (pa.int32(), pa.int32(), pa.binary())]
                spread = (doc ^ place) * np.int64(0x2545F4914F6CDD1D)
                columns = [pa.array(spread), *none, pa.array(doc), pa.array(place), pa.array(span)]
                yield pa.RecordBatch.from_arrays(columns, names=_PART_NAMES)
                yield around.parts(around.open & ~gone, narrower)

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (group, n) of those with suffixes to compare, by batch."""
    for batch in batches:
        group, n = np.unique(_open_and_known(batch)[0].column("group").to_numpy(), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(group), pa.array(n)], names=["group", "n"])


def _known_runs(doc: np.ndarray, place: np.ndarray, span: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(doc), pa.array(place >> _TAG_BITS), pa.array(span)], names=["doc_id", "tag", "span"]
    )


def _sorted_around(table: pa.Table, width: int) -> pa.RecordBatch:
    around = _Around(table, width)
    return _known_runs(*around.runs(around.later()))


def _compared(rows: DataFrame, width: int) -> DataFrame:
    rows = rows.repartition("group").sortWithinPartitions("group")
    return rows.mapInArrow(_compare(width), "doc_id long, tag long, span long")


def _spans(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """Rows (doc_id, tag, span) of suffixes that a lesser document of their group has.

    Both frames hold rows (group, doc_id, place, around); groups of `hot` are too large for one task.
    All is one plan, so that texts are shuffled once. Parts are dealt out by group and document, once:
    their counts and both joins read them from there, and no large group comes together. For that the
    joins broadcast the large groups, at most one for HOT_ROWS parts. They are neither semi nor anti
    joins and compare null-safely: Spark moves those, and a filter for nulls, below the shuffle, and
    then makes the parts anew for each.
    """
    found = [_compared(rows, WIDTHS[0])]
    for width, narrower in zip(WIDTHS, WIDTHS[1:]):
        parts = hot.mapInArrow(_part(width, narrower), _PARTS)
        if narrower > 1:
            parts = parts.repartition("group", "doc_id")
            counts = parts.mapInArrow(_counted, "group long, n long").groupBy("group").agg(F.sum("n").alias("n"))
            large = F.broadcast(counts.filter(F.col("n") > HOT_ROWS).select(F.col("group").alias("large")))
            is_large = F.col("group").eqNullSafe(F.col("large"))
            hot = parts.join(large, is_large).drop("large")
            parts = parts.join(large, is_large, "left").filter("large IS NULL").drop("large")
        found.append(_compared(parts, narrower))
    return reduce(DataFrame.unionByName, found)


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text. A span is 256 times its begin plus its length."""
    for batch in batches:
        for block in blocks(batch):
            out = []
            for text, spans in zip(block.column("text").cast(pa.binary()).to_pylist(), block.column("spans")):
                out.append(_cut(text or b"", spans.values.to_numpy() if spans.is_valid else None))
            size, removed, runs, kept = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"),
                    pa.array(size, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array([len(r) for r in runs], pa.int64()),
                    pa.array(kept, pa.string()),
                    pa.array(runs, pa.list_(pa.list_(pa.int64()))),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"],
            )


def _cut(text: bytes, spans: np.ndarray | None) -> tuple[int, int, list, str]:
    if spans is None or not len(spans):
        return len(text), 0, [], hashlib.sha256(text).hexdigest()
    spans = np.sort(spans)
    begin, end = spans >> 8, np.minimum((spans >> 8) + (spans & 255), len(text))
    reach = np.maximum.accumulate(end)
    new = np.ones(len(begin), dtype=bool)
    new[1:] = begin[1:] > reach[:-1]
    begin, end = begin[new], reach[np.append(np.flatnonzero(new)[1:], len(new)) - 1]
    kept, last = hashlib.sha256(), 0
    for a, b in zip(begin.tolist(), end.tolist()):
        kept.update(text[last:a])
        last = b
    kept.update(text[last:])
    return len(text), int((end - begin).sum()), np.stack([begin, end], axis=1).tolist(), kept.hexdigest()


def removed_passages(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed) for every document.

    removed lists the maximal runs (begin, end) of removed bytes. NULL texts are empty. A document
    without doc_id has no place in the order: it loses nothing and takes nothing from others. Rows
    with the same doc_id take nothing from each other. An empty table gives no rows.
    """
    spark = docs.sparkSession
    tag = F.xxhash64("text").bitwiseAND(F.lit(0xFFFF))
    docs = docs.select("doc_id", "text", tag.alias("tag"))
    known = docs.filter("doc_id IS NOT NULL")
    fragments = known.mapInArrow(
        _find_anchors(4 * shuffle_partitions(spark)), "bucket int, gone boolean, payload binary"
    )
    fragments = fragments.repartition("bucket").sortWithinPartitions("bucket")
    met = settle(fragments.mapInArrow(_meet(HOT_ROWS), "gram long, hot boolean, doc_id long, place long"), "anchors")
    at = F.col("place").bitwiseAND(F.lit((1 << _AT_BITS) - 1))
    before, more = (F.shiftright("place", bits).bitwiseAND(F.lit((1 << _STEP_BITS) - 1)) for bits in (_AT_BITS, _MORE_BITS))
    met = met.withColumns({"tag": F.shiftright("place", _TAG_BITS), "start": at - before, "size": more + LENGTH})
    whole = met.filter("gram IS NULL").select("doc_id", "tag", (F.col("start") * 256 + F.col("size")).alias("span"))
    by_id = known.repartition("doc_id")
    around = F.substring(F.col("text").cast("binary"), F.col("start").cast("int") + 1, F.col("size").cast("int"))

    def with_around(rows: DataFrame) -> DataFrame:
        return rows.join(by_id, ["doc_id", "tag"]).select("group", "doc_id", "place", around.alias("around"))

    grams = met.filter("gram IS NOT NULL").withColumnRenamed("gram", "group")
    spans = whole.unionByName(_spans(with_around(grams.filter("NOT hot")), with_around(grams.filter("hot"))))
    spans = spans.groupBy("doc_id", "tag").agg(F.collect_list("span").alias("spans"))
    found = by_id.join(spans, ["doc_id", "tag"], "left").select("doc_id", "text", "spans")
    unknown = docs.filter("doc_id IS NULL").select("doc_id", "text", F.lit(None).cast("array<long>").alias("spans"))
    return found.unionByName(unknown).mapInArrow(
        _without,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<array<long>>",
    )
