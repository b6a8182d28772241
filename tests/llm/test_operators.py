"""Each operator against a brute-force version, on real and on odd rows, and on none."""

import collections
import hashlib
import math
import re
import uuid
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from auditlens.llm import (
    components,
    decontaminate,
    language,
    license_rules,
    licenses,
    mixing,
    pii,
    quality,
    sharding,
    simhash,
    suffixes,
    tokens,
)

LOWER = {i: i + 32 for i in range(65, 91)}
WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAME = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TABLES = ("documents", "odd", "none")


@pytest.fixture(params=TABLES)
def docs(request):
    return request.getfixturevalue(request.param)


def texts(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def same(found, expected):
    assert sorted(map(repr, found)) == sorted(map(repr, expected))


def test_languages(docs):
    found = language.held_out_languages(docs).collect()
    rows = docs.select("doc_id", "text", "lang").collect()
    same([r.doc_id for r in found], [r.doc_id for r in rows])
    held = {r.doc_id: r for r in found}
    learned = {r.lang for r in rows if r.lang and r.text is not None and r.doc_id is not None
               and zlib.crc32(str(r.doc_id).encode()) % 5}
    for r in rows:
        p = held[r.doc_id]
        letters = r.text is not None and any(c.isalpha() for c in r.text)
        assert (p.lang_pred in learned) if letters else (p.lang_pred == "und" and p.score == 0)
        assert 0 <= p.score <= 1
        assert p.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_held_out_accuracy(documents):
    found = language.held_out_languages(documents).filter("held_out").join(documents, "doc_id")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_mixture_of_two_languages(documents):
    by = {r.lang: r.text for r in documents.filter("n_chars > 1500").collect()}
    model = language.train(documents)
    mixed = documents.sparkSession.createDataFrame([(1, by["en"][:1500] + " " + by["fr"][:1500])], "doc_id long, text string")
    shares = dict(language.predict(mixed, model, ["doc_id"]).first().languages)
    assert set(shares) == {"en", "fr"} and abs(shares["en"] - 0.5) < 0.15


def fingerprint(text, width=4):
    words = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, distance=4):
    """Least node of the class of each print."""
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and bin(a ^ b).count("1") <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


def test_near_duplicates(docs):
    rows = [(d, fingerprint(t)) for d, t in texts(docs)]
    of = classes({p for _, p in rows})
    least = {}
    for d, p in rows:
        if d is not None:
            least[of[p]] = min(d, least.get(of[p], d))
    found = simhash.near_duplicates(docs).collect()
    same([(r.doc_id, r.fp % 2**64, r.component_id) for r in found], [(d, p, least.get(of[p])) for d, p in rows])


@pytest.mark.parametrize("distance, segments", [(4, 3), (4, 4), (6, 3), (3, 5)])
def test_links_of_hot_keys(spark, monkeypatch, distance, segments):
    monkeypatch.setattr(simhash, "KEY_ROWS", 16)
    rng = np.random.default_rng(5)
    prints = set()
    for base in rng.integers(0, 2**63, 3).tolist():
        prints.add(base)
        for _ in range(70):
            prints.add(base ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(1, 9)), replace=False)))
    frame = spark.createDataFrame([(p - 2**64 if p >= 2**63 else p,) for p in prints], "fp long")
    found = components.components(simhash.links(frame, distance, segments)).collect()
    groups = collections.defaultdict(set)
    for p in prints:
        groups[p].add(p)
    roots = {r.node % 2**64: r.root for r in found}
    expected = classes(prints, distance)
    by_root, by_class = collections.defaultdict(set), collections.defaultdict(set)
    for p in prints:
        by_root[roots.get(p, ("alone", p))].add(p)
        by_class[expected[p]].add(p)
    same([sorted(g) for g in by_root.values()], [sorted(g) for g in by_class.values()])
    assert len(found) == len(roots)


def test_one_of_each_class_stays(odd):
    kept = [r.doc_id for r in simhash.drop_near_duplicates(odd).collect()]
    assert sorted(d for d in kept if d) == [1, 4, 7, 8, 9, 10, 11, 12, 13, 14] and kept.count(None) == 1


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101), (100, 100)], "a long, b long")
    found = dict(components.components(links).collect())
    assert found == {**{i: 0 for i in range(51)}, 100: 100, 101: 100}


def statistics(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts, covered = collections.Counter(grams), set()
    for i, g in enumerate(grams):
        if counts[g] > 1:
            covered.update(range(i, i + 5))
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_base_statistics(docs):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    found = quality.judged(docs, ["doc_id"]).collect()
    same([(r.doc_id, *(r[n] for n in names)) for r in found], [(d, *statistics(t)) for d, t in texts(docs)])
    for r in found:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_outliers(documents):
    """Junk goes, labelled good documents stay."""
    good = documents.sparkSession.read.parquet("/root/testdata/sf0.001/labels.parquet").filter("quality = 1")
    found = quality.judged(documents, ["doc_id"])
    clean = found.filter("NOT base_failed").join(good, "doc_id")
    assert clean.filter("NOT kept").count() == 0 and clean.count() > 20
    junk = found.filter("n_symbols > n_words AND n_words > 50 AND NOT base_failed")
    assert junk.filter("kept").count() == 0


@pytest.mark.parametrize("partitions", [1, 8, 1000])
def test_hot_keys_join_like_others(spark, partitions):
    """However many keys count as hot, the rows and verdicts are those of a plain join."""
    rows = spark.range(600).select(
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 7 > 0, F.concat(F.lit("k"), F.col("id") % 40)).alias("key"),
        F.col("id").alias("__spread"),
    )
    counts = rows.filter("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("n"))
    table = counts.filter("key <> 'k7'").withColumn("is_hot", F.col("n") * partitions > 600)
    for how in ("inner", "left"):
        found = quality._join_hot(rows, table, ["key"], "is_hot", how)
        plain = rows.join(table.drop("is_hot"), ["key"], how)
        same([tuple(r) for r in found.select("key", "__spread", "n").collect()], [tuple(r) for r in plain.select("key", "__spread", "n").collect()])


@pytest.mark.parametrize("partitions", [1, 8, 1000])
def test_groups_are_dealt_in_parts(spark, partitions):
    """However many parts a group has, the rows are those of a plain join, found by one join."""
    named = F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 40))
    rows = spark.range(600).select(
        named.alias("group_lang"), F.lit("s").alias("group_source"), F.hash("id").cast("long").alias("__spread"), "id"
    )
    table = rows.groupBy("group_lang", "group_source").agg(F.count("*").alias("n"))
    table = table.withColumn("parts", F.ceil(F.col("n") * partitions / 600))
    rows = rows.join(table.drop("n"), ["group_lang", "group_source"])
    table = table.filter("group_lang <> 'k9'")
    for how in ("inner", "left"):
        found = quality._join_dealt(rows, table, how)
        assert found.columns == [*rows.columns, "n"]
        plain = rows.join(table.drop("parts"), ["group_lang", "group_source"], how)
        same([(r.id, r.n) for r in found.collect()], [(r.id, r.n) for r in plain.collect()])


def test_concentration_step(spark, monkeypatch):
    """Center and scatter of the bins that hold three quarters of a group, by a small plan."""
    rng = np.random.default_rng(3)
    groups = {("a", 0): 400, ("a", 1): 50, ("b", 0): 7, ("b", 1): 1}
    rows = []
    for (lang, start), n in groups.items():
        x = rng.integers(-3000, 3000, (n, quality.DIMENSIONS)).tolist()
        distance = rng.exponential(20, n).round(1).tolist()
        rows += [(lang, "s", 1, start, d, *v) for v, d in zip(x, distance)]
    names = [*quality._GROUP, "start", "distance", *quality._X]
    scored = spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in zip(names, ["string"] * 2 + ["long", "int", "double"] + ["long"] * 4)))
    settled = []
    monkeypatch.setattr(quality, "settle", lambda df, name: settled.append(df) or df)
    found = {(r.group_lang, r.start): r for r in quality._concentrated(scored, "step").collect()}
    assert found.keys() == groups.keys()
    for (lang, start), n in groups.items():
        own = [r for r in rows if (r[0], r[3]) == (lang, start)]
        bins = np.array([math.floor(16 * math.log2(1 + r[4])) for r in own])
        last = min(b for b in bins if (bins <= b).sum() >= quality.KEPT_SHARE * n)
        inner = np.array([r[5:] for r in own], float)[bins <= last] / quality.GRID
        scatter = (inner.T @ inner / len(inner) - np.outer(inner.mean(0), inner.mean(0))) * quality._consistency()
        scatter += np.diag(np.square(quality.LEAST_SPREAD))
        r = found[lang, start]
        factor = np.zeros((quality.DIMENSIONS, quality.DIMENSIONS))
        for i in range(quality.DIMENSIONS):
            factor[i, : i + 1] = [r[f"l_{i}_{j}"] for j in range(i + 1)]
        assert r.total == n
        assert np.allclose([r[f"m_{x}"] for x in quality._X], inner.mean(0))
        assert np.allclose(factor @ factor.T, scatter, atol=1e-9)
        assert math.isclose(r.log_det, np.log(np.diag(factor)).sum())
    plan = settled[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("windowspecdefinition") == 2
    joined = quality._with_distance(scored.drop("start", "distance").withColumn("__spread", F.hash("x0").cast("long")), settled[0])
    joins = re.findall(r"\bJoin \w+", joined._jdf.queryExecution().optimizedPlan().toString())
    assert len(joins) == 1


def test_good_rows_keep_their_columns(odd):
    kept = quality.keep_good(odd)
    assert kept.columns == odd.columns and kept.filter("doc_id = 7").count() == 1 and kept.filter("doc_id = 2").count() == 0


def shares(sizes, weights, repeats=3):
    """Targets by filling up to the level found by bisection."""
    low, high = 0.0, float(sum(sizes.values()) * repeats + 1)
    for _ in range(200):
        level = (low + high) / 2
        filled = sum(min(repeats * sizes[s], weights[s] * level) for s in sizes)
        low, high = (level, high) if filled < sum(sizes.values()) else (low, level)
    return {s: min(repeats * sizes[s], weights[s] * high) for s in sizes}


def test_mix(docs):
    rows = docs.select("doc_id", "text", "source").collect()
    found = mixing.mix_report(docs).collect()
    size = lambda t: len(WORD.findall(t or ""))
    same([(r.doc_id, r.size) for r in found], [(r.doc_id, size(r.text)) for r in rows])
    sizes = collections.Counter()
    for r in rows:
        sizes[r.source] += size(r.text)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = shares(sizes, {s: 1 + i % 3 for i, s in enumerate(order)})
    taken = collections.Counter()
    for r in found:
        taken[r.source] += r.taken
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
    longest = max([size(r.text) for r in rows], default=0)
    assert all(abs(taken[s] - target[s]) <= longest + 1 for s in order)
    assert sum(taken.values()) <= sum(sizes.values())
    same(found, mixing.mix_report(docs).collect())


def test_mixed_rows_follow_the_report(odd):
    mixed = collections.Counter(r.doc_id for r in mixing.mixed_documents(odd).collect())
    for r in mixing.mix_report(odd).groupBy("doc_id").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size")).collect():
        if r.size:
            assert bool(mixed[r.doc_id]) == bool(r.taken)
    assert mixing.mixed_documents(odd).columns == odd.columns


def test_shards(docs):
    found = sharding.hilbert_shards(docs.select("doc_id", "text", "lang", "source")).collect()
    expected = [(d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts(docs)]
    same([(r.doc_id, r["size"], r.text_crc32) for r in found], expected)
    slots = collections.defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[i]) for i in range(8)]
    assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(8))
    by_place = sorted(found, key=lambda r: (r.shard, r.slot))
    assert [r.cell for r in by_place] == sorted(r.cell for r in found)


@pytest.mark.parametrize("axes, bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_steps_to_neighbours(spark, axes, bits):
    size = 1 << bits
    cells = spark.range(size**axes).selectExpr(*(f"id div {size**i} % {size} AS a{i}" for i in range(axes)))
    index = sharding.hilbert_index([F.col(f"a{i}") for i in range(axes)], bits)
    rows = sorted((r.place, tuple(r)[:axes]) for r in cells.withColumn("place", index).collect())
    assert [p for p, _ in rows] == list(range(size**axes))
    assert all(sum(abs(x - y) for x, y in zip(a, b)) == 1 for (_, a), (_, b) in zip(rows, rows[1:]))


def detected(text):
    found = {(m.start(), m.end(), r.label, r.priority) for r in license_rules.RULES for m in re.finditer(r.regex, text, re.A)}

    def covered(a, b):
        same_place = (a[0], a[1]) == (b[0], b[1])
        wins = b[3] > a[3] or (b[3] == a[3] and (not same_place or b[2] < a[2]))
        return a != b and b[0] <= a[0] and a[1] <= b[1] and wins

    def covers(a, b):
        return a[0] <= b[0] and b[1] <= a[1] and b[3] > a[3]

    return sorted(a for a in found if not any(covered(a, b) or covers(a, b) for b in found))


def test_licenses(docs):
    expected = []
    for d, text in texts(docs):
        text = text or ""
        words, starts, labels = NAME.findall(text.translate(LOWER)), [], []
        for label, phrase in licenses.BASE_PHRASES:
            at = [i for i in range(len(words)) if tuple(words[i : i + len(phrase)]) == phrase]
            starts += at
            labels += [label] * bool(at)
        spans = detected(text)
        every = ",".join(sorted({*labels, *(s[2] for s in spans)}))
        expected.append((d, len(words), len(starts), min(starts, default=None), max(starts, default=None),
                         ",".join(sorted(labels)), every, spans))
    found = licenses.scanned(docs.select("doc_id", "text")).collect()
    same([(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, [tuple(x) for x in r.detections])
          for r in found], expected)
    assert all(0 <= r.score <= 1 and bool(r.score) == bool(r.labels) for r in found)


# Notices as they stand in files, with the label of each.
NOTICES = [
    ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software", "mit"),
    ("The above copyright notice and this permission notice shall be included in\nall copies or", "mit"),
    ("License: MIT", "mit"),
    ("the Expat License", "mit"),
    ("a Responsible AI License", "rail"),
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee", "isc"),
    ("# Redistribution and use in source and binary forms, with or\n# without modification, are permitted", "bsd"),
    (" * may be used to endorse or promote products derived from\n * this software without", "bsd-3-clause"),
    ("All advertising materials mentioning features or use of this\n   software must", "bsd-4-clause"),
    ('license = "BSD-3-Clause"', "bsd-3-clause"),
    ("Licensed under the Apache License,\n// Version 2.0 (the", "apache-2.0"),
    ("    http://www.apache.org/licenses/LICENSE-2.0", "apache-2.0"),
    ("released as Apache-2.0 code", "apache-2.0"),
    ("  GNU GENERAL PUBLIC LICENSE\n     Version 3, 29 June 2007", "gpl-3.0"),
    ("under the terms of the GNU General Public\n# License as published by the Free Software Foundation; either\n# version 2 of", "gpl-2.0"),
    (" * Lesser General Public License as published by the Free\n * Software Foundation; either version 2.1 of", "lgpl-2.1"),
    ("see https://www.gnu.org/licenses/agpl-3.0.html", "agpl-3.0"),
    ("It is GPLv3+ software", "gpl-3.0"),
    ("terms of the Mozilla Public\n# License, v. 2.0. If a copy", "mpl-2.0"),
    ("altered source versions must be plainly marked\n   as such, and", "zlib"),
    ("This is free and unencumbered software released into\nthe public domain.", "unlicense"),
    ("https://creativecommons.org/licenses/by-nc-sa/4.0/", "cc-by-nc-sa-4.0"),
    ("Creative Commons\nAttribution-ShareAlike 4.0", "cc-by-sa-4.0"),
    ("SPDX-License-Identifier: LGPL-2.1-or-later", "lgpl-2.1"),
]
PLAIN = ["the general served a mit of soup", "we clause by clause", "a public house, GPL14 and mpl", "it is granted", ""]


def test_notices_as_they_stand_in_files(spark):
    rows = [*NOTICES, *((text, None) for text in PLAIN)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    for found in licenses.scanned(docs).collect():
        text, label = rows[found.doc_id]
        assert [tuple(d) for d in found.detections] == detected(text), text
        assert (label in found.labels.split(",")) if label else not found.labels, (text, found.labels)


def test_score_follows_the_best_detection(spark):
    rows = ["all rights reserved", "cc by", "general public license", "SPDX-License-Identifier: MIT", "none", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string")
    assert [r.score for r in licenses.scanned(docs).orderBy("doc_id").collect()] == [0.25, 0.5, 0.5, 1.0, 0, 0]


def without_passages(rows):
    first = {}
    for d, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        for k in range(len(t) - 49):
            first.setdefault(t[k : k + 50], d)
    for d, t in rows:
        gone = bytearray(len(t))
        for k in range(len(t) - 49):
            if d is not None and first[t[k : k + 50]] < d:
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(t, gone) if not g)
        runs = sum(1 for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1]))
        yield d, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("at_once, hot_rows", [(4096, 4096), (1, 4096), (4096, 1)])
def test_passages(docs, monkeypatch, at_once, hot_rows):
    monkeypatch.setattr(suffixes, "AT_ONCE", at_once)
    monkeypatch.setattr(suffixes, "HOT_ROWS", hot_rows)
    found = suffixes.removed_passages(docs).drop("removed").collect()
    same([tuple(r) for r in found], without_passages([(d, (t or "").encode()) for d, t in texts(docs)]))


@pytest.mark.parametrize("hot_rows", [0, 40])
def test_passages_of_hot_grams(spark, monkeypatch, hot_rows):
    """A passage in other surroundings in each document: no task gets all rows of its gram."""
    rng = np.random.default_rng(4)
    some = lambda n: bytes(rng.integers(97, 123, n).astype(np.uint8)).decode()
    passage = some(75)
    rows = [(i, some(40 + i % 7) + passage + some(60 - i % 5)) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = list(without_passages([(d, t.encode()) for d, t in rows]))
    monkeypatch.setattr(suffixes, "HOT_ROWS", hot_rows)
    compare, limit = suffixes._compare, max(hot_rows, 1)

    def bounded(width):
        """Of single suffixes, equal ones meet: a row from each batch that holds them."""
        run = compare(width)

        def checked(batches):
            batches = list(batches)
            groups = collections.Counter(g for b in batches for g in b.column("group").to_pylist())
            assert width == 1 or max(groups.values(), default=0) <= limit
            yield from run(iter(batches))

        return checked

    monkeypatch.setattr(suffixes, "_compare", bounded)
    same([tuple(r) for r in suffixes.removed_passages(docs).drop("removed").collect()], expected)


def test_hot_grams_are_parted_once(spark, monkeypatch, tmp_path):
    """The parts of a hot gram are counted, parted again and compared, but made once."""
    rng = np.random.default_rng(6)
    some = lambda n: bytes(rng.integers(97, 123, n).astype(np.uint8)).decode()
    passage = some(75)
    rows = [(i, some(40) + passage + some(60)) for i in range(60)]
    monkeypatch.setattr(suffixes, "HOT_ROWS", 5)
    part = suffixes._part

    def written(width, narrower):
        run = part(width, narrower)

        def noted(batches):
            for batch in run(batches):
                if width == suffixes.WIDTHS[0]:
                    open_rows = batch.filter(batch.column("span").is_null())
                    lines = zip(*(open_rows.column(c).to_pylist() for c in ("doc_id", "place", "first")))
                    with open(tmp_path / uuid.uuid4().hex, "w") as file:
                        file.writelines(f"{line}\n" for line in lines)
                yield batch

        return noted

    monkeypatch.setattr(suffixes, "_part", written)
    suffixes.removed_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    made = [line for file in tmp_path.iterdir() for line in file.read_text().splitlines()]
    assert made and len(made) == len(set(made))


def test_each_suffix_has_one_anchor():
    rng = np.random.default_rng(5)
    texts = ["", "x" * 49, "x" * 300, *("".join(map(chr, rng.integers(97, 100, n))) for n in (50, 51, 400, 90))]
    _, _, text, place = suffixes._anchors(pa.array(texts))
    at, before, more = suffixes._at(place), suffixes._before(place), place >> suffixes._MORE_BITS
    found = sorted((t, a - b + k) for t, a, b, m in zip(*(c.tolist() for c in (text, at, before, more))) for k in range(m + 1))
    assert found == [(i, k) for i, t in enumerate(texts) for k in range(len(t) - 49)]
    assert all(0 <= b <= 30 and b - m >= 0 for b, m in zip(before.tolist(), more.tolist()))


def test_blind_trie_sorts():
    rng = np.random.default_rng(3)
    strings = [bytes(rng.integers(97, 100, 12).astype(np.uint8)) for _ in range(300)]
    trie = suffixes._BlindTrie()
    for i, s in enumerate(strings):
        trie.insert(s, i)
    leaves = list(trie.leaves())
    assert [strings[leaf[0]] for leaf in leaves] == sorted(set(strings))
    assert all(len({strings[i] for i in leaf}) == 1 for leaf in leaves)


def contamination(rows, items):
    windows, lengths = collections.defaultdict(set), set()
    for item, text in items:
        words = NAME.findall((text or "").translate(LOWER))
        n = min(10, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[i : i + n])].add(item)
            lengths.add(n)
    for d, text in rows:
        words, hit, found = NAME.findall((text or "").translate(LOWER)), set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if (w := tuple(words[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= {x for x in windows[w] if x is not None}
        listed = ",".join(sorted(str(x) for x in found))
        yield d, len(words), len(hit), len(found), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("block", [4 << 20, 300])
def test_contamination(spark, docs, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BENCHMARK_BYTES", block)
    real = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    own = [(900, "word0 AND0 word1 and1"), (901, None), (902, " .! "), (None, "general public license cc"), (903, "tail"),
           (904, "cc by é😀 all rights"), (904, "x")]
    items = real.select(F.col("item_id").cast("long"), "text").unionByName(spark.createDataFrame(own, "item_id long, text string"))
    expected = contamination(texts(docs), [tuple(r) for r in items.collect()])
    same([tuple(r) for r in decontaminate.contamination_report(docs, items).collect()], expected)


@pytest.mark.parametrize("block", [4 << 20, 1])
def test_runs_of_several_windows(spark, monkeypatch, block):
    """A long run of a short item is not cut by a window of a longer one that begins inside it."""
    monkeypatch.setattr(decontaminate, "BENCHMARK_BYTES", block)
    items = [(1, "a b"), (2, "b a b a b"), (3, "a b a b a b a b a b c")]
    text = [(1, "x " + "a b " * 30 + "y a b a b"), (2, "a b a b a b a b a b c d"), (3, "")]
    rows, bench = spark.createDataFrame(text, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination_report(rows, bench)
    same([tuple(r) for r in found.collect()], contamination(text, items))


def test_clean_rows_stay(spark, odd):
    items = spark.createDataFrame([(1, "all rights reserved")], "item_id long, text string")
    kept = decontaminate.drop_contaminated(odd, items)
    assert kept.columns == odd.columns
    assert kept.count() == odd.count() - 1 and not kept.filter("doc_id = 7").count()
    assert decontaminate.drop_contaminated(odd, items.filter("false")).count() == odd.count()


def test_texts_of_a_block_are_cut_in_one_run(monkeypatch):
    encoder, cuts = tokens._Encoder(public_tokenizers.path("word_bpe_49k.json")), []
    cut = tokens._cut_at_word_ends
    monkeypatch.setattr(tokens, "_cut_at_word_ends", lambda text: cuts.append(text) or cut(text))
    odd_texts = ["", ".", "a.", ".b", "A b,c, d.\n", "\n", "é. Ü,", " ", "x<|ENDOFTEXT|> y.", "1.5, 2."]
    runs = (odd_texts, odd_texts[::-1], odd_texts[:1], odd_texts)
    for run in runs:
        plain = [[*encoder.tokenizer.encode(t, add_special_tokens=False).ids, tokens.END_ID] for t in run]
        assert [c.tolist() for c in encoder.encode(run)] == plain
    assert encoder.encode([]) == []
    assert len(cuts) == len(runs) + 1


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_tokens(docs, tmp_path, planes):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = sorted(((d, t or "") for d, t in texts(docs)), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    expected, start = [], 0
    for d, t in rows:
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], dtype="<u4")
        expected.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    found = tokens.tokenized(docs, path, str(tmp_path / "t"), planes).collect()
    same([tuple(r) for r in found], expected)


@pytest.mark.parametrize("planes", ["byte", "bit"])
@pytest.mark.parametrize("n", [0, 1, 7, 64, 1000])
def test_planes_round_trip(planes, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
    payload, index = tokens.pack(ids, planes, block=64)
    assert (tokens.unpack(payload, index, n, planes, block=64) == ids).all()


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0


def digits(match):
    return re.sub("[^0-9]", "", match)


CHECKS = {
    "email": (EMAIL, lambda m: True),
    "ip": (IP, lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (CARD, lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
    "phone": (PHONE, lambda m: 9 <= len(digits(m)) <= 15),
}


def test_private_data(docs):
    expected = {}
    for d, t in texts(docs):
        spans = {k: [f"{k}:{m.start()}:{m.end()}" for m in p.finditer(t or "") if ok(m.group())] for k, (p, ok) in CHECKS.items()}
        expected[d] = spans
    found = pii.private_report(docs).collect()
    same([r.doc_id for r in found], [d for d, _ in texts(docs)])
    for r in found:
        spans = expected[r.doc_id]
        base = [s for k in CHECKS for s in spans[k]]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(spans[k]) for k in CHECKS)
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        every = r.spans.split(",") if r.spans else []
        assert every[: len(base)] == base
        assert all(s.split(":")[0] in pii.KINDS[4:] for s in every[len(base) :])


def test_redaction(spark, odd):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = pii.train(documents)
    assert any(t < float("inf") for t in model.thresholds) and len(model.trees) == pii.ROUNDS
    assert pii.train(documents.filter("false")).trees == ()
    out = {r.doc_id: r.text for r in pii.redacted(odd, model).collect()}
    assert "@e.f" not in out[8] and "[ip]" in out[8] and out[1] is None and out[2] == ""
    assert "24be64439e3e49cf" not in out[11]
    assert pii.redacted(odd, model).columns == odd.columns


def test_long_credentials_and_chains(spark):
    """A match is never cut to a prefix, and one that goes makes room for others."""
    everything = pii.Trees(0.0, (), (-1.0,) * len(pii.GENERATORS))
    jwt = "eyJhbGciOiJIUzI1NiJ9" * 18
    rows = [(1, f"see token: {jwt} end"), (2, f"see {jwt} end"), (3, "see " + "Q" * 60 + "7abc end"),
            (4, "see " + "1234 5678 " * 20 + "end"), (5, "see " + "Q" * 60 + " end"),
            (6, "12 34 56 78 90 12 34 56 78 9012345abcdefghij_token:Zz345678")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in pii.redacted(docs, everything).collect()}
    assert out == {1: "see [secret] end", 2: "see [key] end", 3: "see [key] end", 4: "see [number] end",
                   5: rows[4][1], 6: "[number]abcdefghij_[secret]"}
