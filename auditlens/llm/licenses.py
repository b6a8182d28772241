"""License scans by ordered signature rules.

Texts without any trigger word are passed over. In the others each rule whose keyword occurs is
searched for. Overlapping detections are resolved by priority and containment: a detection goes if
one of the same or a higher priority covers it, or if it covers one of a higher priority.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlens.llm.common import NAME_WORD, let, native_count
from auditlens.llm.license_rules import RULES, TRIGGERS, Rule

_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Label and words of each base phrase.
BASE_PHRASES = (
    ("cc-by", ("cc", "by")),
    ("gpl", ("general", "public", "license")),
    ("reserved", ("all", "rights", "reserved")),
)
BASE_PRIORITIES = (2, 2, 1)
PRIORITIES = 4

_SPAN = "struct<start:int,finish:int,label:string,priority:int>"


def _between(words: Sequence[str]) -> str:
    """The phrase as whole words with anything but words between. Only A-Z count as upper case."""
    return f"(?i)(?<!{NAME_WORD[:-1]}){_GAP.join(words)}(?!{NAME_WORD[:-1]})"


def _phrase_places(text: Column, lower: Column, words: Sequence[str], n_words: Column) -> Column:
    """Number of places of a phrase, and the words before the first and the last of them."""
    maybe = F.lit(True)
    for w in words:
        maybe = maybe & F.contains(lower, F.lit(w))

    def places(pieces: Column) -> Column:
        n = F.size(pieces) - 1
        first = native_count(F.get(pieces, F.lit(0)), NAME_WORD)
        last = n_words - native_count(F.get(pieces, n), NAME_WORD) - len(words)
        return F.struct(n.cast("long").alias("n"), F.when(n > 0, first).alias("first"), F.when(n > 0, last).alias("last"))

    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("last"))
    return F.when(maybe, let(F.split(text, _between(words), -1), places)).otherwise(none)


def spans_of(text: Column, regex: Column | str) -> Column:
    """Array of (start, finish) of all matches of a pattern that never matches an empty string, in
    code points. Follows from the lengths of the matches and of what lies between."""
    pattern = F.lit(regex) if isinstance(regex, str) else regex

    def joined(pieces: Column) -> Column:
        def placed(hits: Column) -> Column:
            start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,finish:int>>").alias("out"))

            def step(acc: Column, k: Column) -> Column:
                begin = acc["at"] + F.length(F.get(pieces, k))
                end = begin + F.length(F.get(hits, k))
                span = F.array(F.struct(begin.alias("start"), end.alias("finish")))
                return F.struct(end.alias("at"), F.concat(acc["out"], span).alias("out"))

            return F.aggregate(F.sequence(F.lit(0), F.size(hits) - 1), start, step, lambda acc: acc["out"])

        none = F.array().cast("array<struct<start:int,finish:int>>")
        hits = F.regexp_extract_all(text, pattern, F.lit(0))
        return F.when(F.size(pieces) > 1, let(hits, placed)).otherwise(none)

    return let(F.split(text, pattern, -1), joined)


def _resolved(found: Column) -> Column:
    """Detections that stay, sorted. Two sweeps, each with a bound per priority."""

    def swept(ordered: Column) -> Column:
        level = F.sequence(F.lit(1), F.lit(PRIORITIES))

        def sweep(rows: Column, start: int, better, hit) -> Column:
            """Flags of rows, from what came before: `bounds` holds the best end by priority."""
            state = F.struct(
                F.transform(level, lambda _: F.lit(start)).alias("bounds"), F.array().cast("array<boolean>").alias("out")
            )

            def step(acc: Column, d: Column) -> Column:
                gone = F.exists(F.transform(level, lambda p: hit(p, d, F.get(acc["bounds"], p - 1))), lambda x: x)
                bounds = F.transform(
                    level,
                    lambda p: F.when(p == d["priority"], better(F.get(acc["bounds"], p - 1), d["finish"])).otherwise(
                        F.get(acc["bounds"], p - 1)
                    ),
                )
                return F.struct(bounds.alias("bounds"), F.concat(acc["out"], F.array(gone)).alias("out"))

            return F.aggregate(rows, state, step, lambda acc: acc["out"])

        covered = sweep(ordered, -1, F.greatest, lambda p, d, end: (p >= d["priority"]) & (end >= d["finish"]))
        covers = sweep(
            F.reverse(ordered), 2**31 - 1, F.least, lambda p, d, end: (p > d["priority"]) & (end <= d["finish"])
        )
        flags = F.arrays_zip(ordered.alias("d"), covered.alias("a"), F.reverse(covers).alias("b"))
        kept = F.filter(flags, lambda x: ~x["a"] & ~x["b"])
        return F.transform(
            kept,
            lambda x: F.struct(
                x["d"]["start"].alias("start"),
                x["d"]["finish"].alias("finish"),
                x["d"]["label"].alias("label"),
                x["d"]["priority"].alias("priority"),
            ),
        )

    keyed = F.transform(
        found,
        lambda d: F.struct(
            d["start"].alias("start"), (-d["finish"]).alias("k1"), (-d["priority"]).alias("k2"),
            d["label"].alias("label"), d["finish"].alias("finish"), d["priority"].alias("priority"),
        ),
    )
    return let(F.sort_array(keyed), swept)


def detections(text: Column, lower: Column, rules: Sequence[Rule] = RULES) -> Column:
    """Resolved detections of a text: array of start, finish (code points), label, priority."""
    table = F.array(
        *(
            F.struct(
                F.lit(r.keyword).alias("keyword"),
                F.lit(r.regex).alias("regex"),
                F.lit(r.label).alias("label"),
                F.lit(r.priority).alias("priority"),
            )
            for r in rules
        )
    )
    candidates = F.filter(table, lambda r: F.contains(lower, r["keyword"]))

    def search(r: Column) -> Column:
        return F.transform(
            spans_of(text, r["regex"]),
            lambda s: F.struct(
                s["start"].alias("start"), s["finish"].alias("finish"), r["label"].alias("label"), r["priority"].alias("priority")
            ),
        )

    return _resolved(F.flatten(F.transform(candidates, search)))


def scanned(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Adds n_words, n_base, first_word, last_word, base_labels, labels, score and detections.

    A NULL text is an empty one: it has no words, no labels and score 0. score is the highest
    priority found over the number of priorities. Of the base phrases, reserved rights count as 1 and a
    license as 2.
    """
    added = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections")
    docs = docs.select(*(c for c in docs.columns if c not in added))
    text = F.coalesce(F.col("text"), F.lit(""))

    def scan(t: Column) -> Column:
        def known(both: Column) -> Column:
            lower, n = both["lower"], both["n"]
            triggered = F.lit(False)
            for word in TRIGGERS:
                triggered = triggered | F.contains(lower, F.lit(word))
            found = F.when(triggered, detections(t, lower, rules)).otherwise(F.array().cast(f"array<{_SPAN}>"))
            phrases = [_phrase_places(t, lower, words, n).alias(label) for label, words in BASE_PHRASES]
            return F.struct(n.alias("n"), F.struct(*phrases).alias("base"), found.alias("found"))

        return let(F.struct(F.lower(t).alias("lower"), native_count(t, NAME_WORD).alias("n")), known)

    rows = docs.withColumn("scan", let(text, scan))
    base = [F.col("scan.base").getField(label) for label, _ in BASE_PHRASES]
    base_labels = F.array_sort(
        F.filter(
            F.array(*(F.when(b["n"] > 0, F.lit(label)) for b, (label, _) in zip(base, BASE_PHRASES))),
            lambda x: x.isNotNull(),
        )
    )
    found = F.col("scan.found")
    both = F.concat(base_labels, F.transform(found, lambda d: d["label"]))
    priority = F.coalesce(F.array_max(F.transform(found, lambda d: d["priority"])), F.lit(0))
    return rows.withColumns(
        {
            "n_words": F.col("scan.n"),
            "n_base": base[0]["n"] + base[1]["n"] + base[2]["n"],
            "first_word": F.least(*(b["first"] for b in base)),
            "last_word": F.greatest(*(b["last"] for b in base)),
            "base_labels": F.array_join(base_labels, ","),
            "labels": F.array_join(F.sort_array(F.array_distinct(both)), ","),
            "score": F.greatest(priority, *(F.when(b["n"] > 0, p) for b, p in zip(base, BASE_PRIORITIES))) / PRIORITIES,
            "detections": found,
        }
    ).drop("scan")
