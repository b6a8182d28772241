"""Personal data by candidate gradient boosting.

Patterns fixed by the contract give the base spans. Besides, generators with a high recall propose
spans that may overlap: numbers with separators, keys and tokens, e-mail addresses in words. Boosted
trees on format and context score them, and a calibrated threshold for each generator selects.

The trees are fitted on counts of all candidates of the corpus by features. Features have few
values, so these counts are a table of bounded size, whatever the corpus; only it is collected. The
trees become one SQL expression.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlens.llm.common import let
from auditlens.llm.licenses import spans_of

# The base kinds and their patterns. The repeats that cannot match in another way are
# possessive, and a match begins where a run begins, so that long runs cost linear time.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE_KINDS = ("email", "ip", "card", "phone")
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"

# Generators: kind, something every match holds (a pattern, lower case), pattern. Kinds are listed
# after the base kinds, in this order. Repeats of secrets, keys and numbers are open, so that no match
# is cut short, and possessive, so that they cost linear time. A key holds a digit.
GENERATORS = (
    ("secret", "token|secret|passw|pwd|api|key|auth|bearer",
     r"(?i)(?<![a-z0-9])(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|auth|bearer)[\"']?\s{0,3}[:= ]\s{0,3}[\"']?[A-Za-z0-9+/_=.-]{8,}+"),
    ("key", "[0-9]", r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{16,}+"),
    ("number", "[0-9]", r"(?<![0-9])[0-9(](?:[\x20().,:/-]{0,2}[0-9]){6,}+"),
    ("contact", r" at |\(at\)|\[at\]",
     r"(?i)[A-Za-z0-9._%+-]{1,64}+\s?(?:\(at\)|\[at\]| at )\s?[A-Za-z0-9-]{1,63}\s?(?:\(dot\)|\[dot\]| dot |\.)\s?[A-Za-z]{2,24}"),
)
KINDS = (*BASE_KINDS, *(g[0] for g in GENERATORS))

CONTEXT = 24
ROUNDS = 24
RATE = 0.4
SMOOTHING = 2.0
# A generator's threshold is the lowest score whose candidates are personal data by this share.
PRECISION = 0.95
# A threshold lies halfway to the next worse candidate that was seen, or this much below if none was.
MARGIN = 1.0

_CONTEXT_WORDS = r"(?i)token|secret|passw|key|auth|card|visa|credit|phone|tel|call|mobile|fax|mail|contact|ip|server|host|ssn|account|iban"


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits is right."""
    n = F.length(digits)

    def value(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 1, twice).otherwise(d)

    total = F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), value), F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def _checked(kind: str, match: Column) -> Column:
    n = F.length(_digits(match))
    if kind == "ip":
        return match.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return F.when((n >= 13) & (n <= 19), let(_digits(match), _luhn)).otherwise(F.lit(False))
    if kind == "phone":
        return (n >= 9) & (n <= 15)
    return F.lit(True)


_SPANS = "array<struct<start:int,finish:int>>"


def _text_of(text: Column, span: Column) -> Column:
    return F.substring(text, span["start"] + 1, span["finish"] - span["start"])


def _passes(kind: str, text: Column):
    return lambda span: let(_text_of(text, span), lambda match: _checked(kind, match))


def base_spans(text: Column) -> dict[str, Column]:
    """Array of (start, finish) by base kind, in code points. A text that cannot hold a kind is not
    searched for it."""
    gates = {
        "email": F.contains(text, F.lit("@")),
        "ip": text.rlike(r"[0-9]\.[0-9]"),
        "card": text.rlike("[0-9]"),
        "phone": F.contains(text, F.lit("+")),
    }
    out = {}
    for kind, pattern in zip(BASE_KINDS, (EMAIL, IP, CARD, PHONE)):
        spans = spans_of(text, pattern)
        if kind != "email":
            spans = F.filter(spans, _passes(kind, text))
        out[kind] = F.when(gates[kind], spans).otherwise(F.array().cast(_SPANS))
    return out


# Features of a candidate: names and numbers of values.
FEATURES = {
    "generator": len(GENERATORS),
    "digits": 8,
    "letters": 4,
    "separators": 4,
    "length": 6,
    "hex": 2,
    "plus": 2,
    "word": 2,
    "left": 4,
    "right": 4,
    "starts_run": 2,
}


def _binned(n: Column, cuts: Sequence[int]) -> Column:
    out = F.lit(0)
    for c in cuts:
        out = out + F.when(n >= c, 1).otherwise(0)
    return out


def _side(c: Column) -> Column:
    return (
        F.when(c == "", 0).when(c.rlike(r"[\x20\x09-\x0D]"), 1).when(c.rlike("[A-Za-z0-9]"), 2).otherwise(3)
    )


def _features(text: Column, generator: int, span: Column) -> Column:
    """The features as an array of small numbers, in the order of FEATURES."""

    def of(p: Column) -> Column:
        m, before, after = p["match"], p["before"], p["after"]
        return F.array(
            F.lit(generator),
            _binned(F.length(_digits(m)), (4, 7, 9, 11, 13, 16, 20)),
            _binned(F.length(F.regexp_replace(m, "[^A-Za-z]", "")), (1, 6, 20)),
            _binned(F.length(F.regexp_replace(m, "[A-Za-z0-9]", "")), (1, 2, 4)),
            _binned(F.length(m), (10, 16, 24, 36, 60)),
            F.when(m.rlike("(?i)(?<![0-9a-f])[0-9a-f]{16,}+[\"']?$"), 1).otherwise(0),
            F.when(before.endswith("+"), 1).otherwise(0),
            F.when(before.rlike(_CONTEXT_WORDS), 1).otherwise(0),
            _side(F.right(before, F.lit(1))),
            _side(F.left(after, F.lit(1))),
            F.when(m.rlike("^[0-9]"), 1).otherwise(0),
        )

    from_ = F.greatest(span["start"] - CONTEXT, F.lit(0))
    parts = F.struct(
        _text_of(text, span).alias("match"),
        F.substring(text, from_ + 1, span["start"] - from_).alias("before"),
        F.substring(text, span["finish"] + 1, F.lit(CONTEXT)).alias("after"),
    )
    return let(parts, of)


_CANDIDATE = "array<struct<generator:int,start:int,finish:int,features:array<int>>>"


def _candidate(text: Column, generator: int):
    return lambda s: F.struct(
        F.lit(generator).alias("generator"),
        s["start"].alias("start"),
        s["finish"].alias("finish"),
        _features(text, generator, s).alias("features"),
    )


def _candidates(text: Column) -> Column:
    """All spans that the generators propose, with their features."""
    found = []
    low = F.lower(text)
    for i, (kind, gate, pattern) in enumerate(GENERATORS):
        spans = spans_of(text, pattern)
        if kind == "key":
            spans = F.filter(spans, lambda s: _text_of(text, s).rlike("[0-9]"))
        spans = F.transform(spans, _candidate(text, i))
        gated = (text if gate == "[0-9]" else low).rlike(gate)
        found.append(F.when(gated, spans).otherwise(F.array().cast(_CANDIDATE)))
    return F.concat(*found)


def _overlaps(spans: Column, c: Column) -> Column:
    return F.exists(spans, lambda s: (s["start"] < c["finish"]) & (c["start"] < s["finish"]))


def _proposed(docs: DataFrame) -> DataFrame:
    """Adds base (struct of arrays by kind) and candidates. A NULL text is an empty one."""

    def all_of(t: Column) -> Column:
        base = F.struct(*(spans.alias(kind) for kind, spans in base_spans(t).items()))
        return F.struct(base.alias("base"), _candidates(t).alias("candidates"))

    found = let(F.coalesce(F.col("text"), F.lit("")), all_of)
    return docs.withColumn("__found", found).withColumns(
        {"base": F.col("__found.base"), "candidates": F.col("__found.candidates")}
    ).drop("__found")


def _all_base(base: Column) -> Column:
    return F.concat(*(base.getField(k) for k in BASE_KINDS))


def _is_personal(base: Column, c: Column) -> Column:
    """What the trees learn: candidates that hold a checked span, and assigned secrets with a digit."""
    assigned = (c["generator"] == 0) & (F.get(c["features"], F.lit(1)) > 0)
    return _overlaps(_all_base(base), c) | assigned


@dataclass(frozen=True)
class Trees:
    """Boosted trees of two levels: feature, bound, then feature, bound and two values on each side."""

    start: float
    trees: tuple[tuple, ...]
    thresholds: tuple[float, ...]

    def score(self, features: Column) -> Column:
        """The sum of all trees as an expression."""
        total = F.lit(self.start)
        for (f, bound), low, high in self.trees:
            sides = []
            for (g, inner), a, b in (low, high):
                sides.append(F.when(F.get(features, F.lit(g)) < inner, F.lit(a)).otherwise(F.lit(b)))
            total = total + F.when(F.get(features, F.lit(f)) < bound, sides[0]).otherwise(sides[1])
        return total

    def scores(self, cells: np.ndarray) -> np.ndarray:
        total = np.full(len(cells), self.start)
        for (f, bound), low, high in self.trees:
            left = cells[:, f] < bound
            for side, ((g, inner), a, b) in ((left, low), (~left, high)):
                total[side] += np.where(cells[side, g] < inner, a, b)
        return total


def _split(cells: np.ndarray, gradient: np.ndarray, weight: np.ndarray) -> tuple[int, int]:
    """The split with the largest gain."""
    best, gain = (0, 1), -1.0
    for f, size in enumerate(FEATURES.values()):
        g = np.bincount(cells[:, f], gradient, size)[:size].cumsum()
        h = np.bincount(cells[:, f], weight, size)[:size].cumsum()
        value = g[:-1] ** 2 / (h[:-1] + SMOOTHING) + (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + SMOOTHING)
        if len(value) and value.max() > gain + 1e-9:
            best, gain = (f, int(value.argmax()) + 1), float(value.max())
    return best


def fit(cells: np.ndarray, positive: np.ndarray, total: np.ndarray) -> Trees:
    """Boost on counts by cell, by the logistic loss, then calibrate the thresholds."""
    if not len(cells) or not total.sum():
        return Trees(0.0, (), (math.inf,) * len(GENERATORS))
    share = min(max(positive.sum() / total.sum(), 1e-6), 1 - 1e-6)
    model = Trees(math.log(share / (1 - share)), (), ())
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-model.scores(cells)))
        gradient, weight = positive - total * p, total * p * (1 - p)
        f, bound = _split(cells, gradient, weight)
        left = cells[:, f] < bound
        sides = []
        for side in (left, ~left):
            g, inner = _split(cells[side], gradient[side], weight[side]) if side.any() else (0, 1)
            low = side & (cells[:, g] < inner)
            values = [
                round(float(RATE * gradient[s].sum() / (weight[s].sum() + SMOOTHING)), 6)
                for s in (low, side & ~low)
            ]
            sides.append(((g, inner), *values))
        model = Trees(model.start, (*model.trees, ((f, bound), *sides)), ())
    scores = model.scores(cells)
    thresholds = []
    for i in range(len(GENERATORS)):
        rows = np.flatnonzero(cells[:, 0] == i)
        rows = rows[np.argsort(-scores[rows], kind="stable")]
        share = positive[rows].cumsum() / np.maximum(total[rows].cumsum(), 1)
        enough = np.flatnonzero((share >= PRECISION) & (positive[rows].cumsum() > 0))
        if not len(enough):
            thresholds.append(math.inf)
            continue
        last = int(enough[-1])
        lowest = float(scores[rows[last]])
        below = float(scores[rows[last + 1]]) if last + 1 < len(rows) else lowest - 2 * MARGIN
        thresholds.append(round((lowest + below) / 2, 6) if below < lowest else lowest - 1e-6)
    return Trees(model.start, model.trees, tuple(thresholds))


def train(docs: DataFrame) -> Trees:
    """Fit the trees on the candidates of all documents."""
    rows = _proposed(docs.select("text")).select(
        F.explode(
            F.transform(
                "candidates",
                lambda c: F.struct(c["features"].alias("f"), _is_personal(F.col("base"), c).cast("int").alias("y")),
            )
        ).alias("c")
    )
    counts = rows.groupBy("c.f").agg(F.sum("c.y").alias("positive"), F.count("*").alias("total")).collect()
    counts.sort(key=lambda r: r["f"])
    return fit(
        np.array([r["f"] for r in counts], dtype=np.int64).reshape(-1, len(FEATURES)),
        np.array([r["positive"] for r in counts], dtype=float),
        np.array([r["total"] for r in counts], dtype=float),
    )


def found_in(docs: DataFrame, model: Trees | None = None) -> DataFrame:
    """Adds base (spans by base kind) and added (kind, start, finish, score), selected by the trees.

    A selected candidate that overlaps a base span adds nothing and is left out. The others are taken
    by score, then the longer, then the first, each unless it overlaps one that was taken.
    """
    model = model or train(docs)
    kinds = F.array(*(F.lit(g[0]) for g in GENERATORS))
    bounds = F.array(*(F.lit(float(t)) for t in model.thresholds))
    scored = F.transform(
        "candidates",
        lambda c: F.struct(
            model.score(c["features"]).alias("score"),
            (c["finish"] - c["start"]).alias("length"),
            (-c["start"]).alias("order"),
            c["generator"].alias("generator"),
            c["start"].alias("start"),
            c["finish"].alias("finish"),
        ),
    )
    base = F.col("base")
    passed = F.filter(scored, lambda c: (c["score"] > F.get(bounds, c["generator"])) & ~_overlaps(_all_base(base), c))

    def apart(cs: Column) -> Column:
        # Sorted by score, length, order and generator, which are the first fields.
        taken = F.aggregate(
            F.sort_array(cs, asc=False),
            F.filter(cs, lambda c: F.lit(False)),
            lambda acc, c: F.when(_overlaps(acc, c), acc).otherwise(F.concat(acc, F.array(c))),
        )
        return F.transform(
            taken,
            lambda c: F.struct(
                F.get(kinds, c["generator"]).alias("kind"),
                c["start"].alias("start"),
                c["finish"].alias("finish"),
                c["score"].alias("score"),
            ),
        )

    return _proposed(docs).withColumn("added", let(passed, apart)).drop("candidates")


def _listed(kind: str, spans: Column) -> Column:
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["finish"].alias("finish"))))
    return F.transform(ordered, lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["finish"]))


def private_report(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for every document."""
    rows = found_in(docs.select("doc_id", "text"))
    base = [_listed(k, F.col("base").getField(k)) for k in BASE_KINDS]
    of_kind = lambda kind: lambda s: s["kind"] == kind
    added = [_listed(k, F.filter("added", of_kind(k))) for k, *_ in GENERATORS]
    return rows.select(
        "doc_id",
        *(F.size(F.col("base").getField(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(F.array_join(F.concat(*base), ","), 256).alias("base_sha256"),
        F.array_join(F.concat(*base, *added), ",").alias("spans"),
    )


def redacted(docs: DataFrame, model: Trees | None = None) -> DataFrame:
    """The rows of `docs` with each found span replaced by its kind in brackets. NULL stays NULL."""
    kept = {c: f"__{i}" for i, c in enumerate(docs.columns) if c != "text"}
    rows = found_in(docs.withColumnsRenamed(kept), model)
    def marked(kind: str | None):
        return lambda s: F.struct(
            s["start"].alias("start"),
            s["finish"].alias("finish"),
            (s["kind"] if kind is None else F.lit(kind)).alias("kind"),
        )

    base = [F.transform(F.col("base").getField(k), marked(k)) for k in BASE_KINDS]
    spans = F.sort_array(F.concat(*base, F.transform("added", marked(None))))
    text = F.col("text")

    def step(acc: Column, s: Column) -> Column:
        between = F.when(s["start"] > acc["at"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"])).otherwise("")
        mark = F.when(s["start"] >= acc["at"], F.concat(F.lit("["), s["kind"], F.lit("]"))).otherwise("")
        return F.struct(
            F.greatest(acc["at"], s["finish"]).alias("at"), F.concat(acc["out"], between, mark).alias("out")
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))
    rows = rows.withColumn("text", F.when(F.size(spans) > 0, F.aggregate(spans, start, step, rest)).otherwise(text))
    return rows.drop("base", "added").withColumnsRenamed({v: k for k, v in kept.items()}).select(*docs.columns)
