"""Quality rules: fixed base rules, then robust multivariate outliers per language and source.

For each group a minimum covariance determinant estimate (center and scatter of the three quarters
of its rows that lie closest together) is found by concentration steps over the whole group. Rows
whose transformed statistics lie too far from the center, by Mahalanobis distance, are rejected.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditlens.llm.common import SPACES, WORD, let, native_count, shuffle_partitions
from auditlens.session import settle

WINDOW_WORDS = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# Statistics are whole multiples of 1 / GRID, so that sums are exact and do not depend on the order
# of rows.
GRID = 1024
# A spread below these counts as these: statistics that are nearly always zero have none.
LEAST_SPREAD = (0.10, 0.08, 0.10, 0.10)
DIMENSIONS = len(LEAST_SPREAD)
KEPT_SHARE = 0.75
STEPS = 4
# Squared distance. A normal group of any size in reach of a cluster exceeds it by chance never.
CUTOFF = 40.0
# Groups with fewer rows are pooled: by language, and if that is not enough, all together.
MIN_ROWS = 10 * DIMENSIONS

_X = [f"x{i}" for i in range(DIMENSIONS)]
_PAIRS = list(combinations_with_replacement(range(DIMENSIONS), 2))
# The last column follows from the others: to how many parts the rows of the group are dealt.
_GROUP = ["group_lang", "group_source", "parts"]
_PAIR = ["lang_name", "source_name"]


def _repeated_words(words: Column) -> Column:
    """Words that lie in a window of five words found twice or more in the text."""

    def covered(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
            return F.sort_array(
                F.transform(F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"])
            )

        def cover(p: Column) -> Column:
            step = F.transform(
                p, lambda x, k: F.least(F.lit(WINDOW_WORDS), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW_WORDS)))
            )
            return F.aggregate(step, F.lit(0), lambda a, b: a + b)

        return let(let(ordered, twice), cover)

    starts = F.sequence(F.lit(1), F.size(words) - (WINDOW_WORDS - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, F.lit(WINDOW_WORDS))))
    found = let(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)),
    )
    return F.when(F.size(words) >= WINDOW_WORDS, found).otherwise(F.lit(0))


def base_statistics(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) and base_failed.

    A NULL text has no words: its counts are 0, and it fails for having too few words.
    """
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    docs = docs.withColumn(
        "stats",
        F.struct(
            let(words, lambda w: F.struct(F.size(w).alias("n"), _repeated_words(w).alias("r"))).alias("w"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).alias("d"),
            F.length(F.regexp_replace(text, SPACES, "")).alias("c"),
            native_count(text, r"[#*$%&|<>]").alias("s"),
        ),
    )
    out = docs.withColumns(
        {
            "n_words": F.col("stats.w.n").cast("long"),
            "word_chars": F.col("stats.c").cast("long"),
            "n_symbols": F.col("stats.s"),
            "n_dup_lines": F.col("stats.d").cast("long"),
            "n_repeat_words": F.col("stats.w.r").cast("long"),
        }
    ).drop("stats")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return out.withColumn("base_failed", failed)


def _transformed() -> dict[str, Column]:
    """Word length, and shares of symbols, repeated words and repeated lines, as whole numbers.

    Shares are taken with some ordinary words added, so that a short text needs more than a few odd
    characters to stand out, and as square roots, which evens out the spread of counts.
    """
    n = F.col("n_words")
    values = [
        F.log2((F.col("word_chars") + 100) / (n + 20)),
        F.sqrt(F.col("n_symbols") / (n + 20)),
        F.sqrt(F.col("n_repeat_words") / (n + 50)),
        F.sqrt(F.col("n_dup_lines") / (n / 10 + 10)),
    ]
    return {x: F.round(v * GRID).cast("long") for x, v in zip(_X, values)}


def _named(column: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(column)), F.lit("NULL"))


def _join_hot(rows: DataFrame, table: DataFrame, keys: Sequence[str], hot: str, how: str = "inner") -> DataFrame:
    """Join with a table of which some keys are marked as hot, so that no task gets all rows of one.

    A hot key holds more than one in `shuffle partitions` of all rows, so there are fewer of them than
    partitions, and their part of the table is broadcast. The other keys meet in a shuffle, in which
    the rows that have found theirs, or have none, are dealt out by their hash `__spread`.
    """
    values = [c for c in table.columns if c not in (*keys, hot)]
    few = table.filter(hot).select(*keys, F.struct(*values).alias("__few"))
    # A column, not a literal: a literal would be folded and taken out of the keys of the shuffle.
    many = table.filter(~F.col(hot)).withColumn("__deal", F.col(hot).cast("long"))
    many = many.select(*keys, "__deal", F.struct(*values).alias("__many"))
    open_ = F.col("__few").isNull()
    for k in keys:
        open_ = open_ & F.col(k).isNotNull()
    met = rows.join(F.broadcast(few), list(keys), "left")
    met = met.withColumn("__deal", F.when(open_, F.lit(0)).otherwise(F.abs(F.col("__spread") % 2**40) + 1))
    met = met.join(many, [*keys, "__deal"], "left").withColumn("__met", F.coalesce("__few", "__many"))
    if how == "inner":
        met = met.filter("__met IS NOT NULL")
    return met.select(*rows.columns, *(F.col("__met").getField(v).alias(v) for v in values))


def _join_dealt(rows: DataFrame, table: DataFrame, how: str = "inner") -> DataFrame:
    """Join with a table of groups in one step, so that no task gets all rows of one.

    Rows are dealt to the parts of their group by their hash `__spread`, and each part meets a copy of
    the group's row. All groups together have at most `shuffle partitions` copies more than rows.
    """
    copies = table.withColumn("__part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = rows.withColumn("__part", F.pmod("__spread", "parts"))
    return dealt.join(copies, [*_GROUP, "__part"], how).select(
        *rows.columns, *(c for c in table.columns if c not in _GROUP)
    )


def _pooled_groups(rows: DataFrame) -> DataFrame:
    """Rows (lang_name, source_name, hot_pair, group_lang, group_source, parts): the group of each pair.

    Sizes of groups are those of the rows that count, a pair is hot by all its rows. The rows of a
    group that holds more than one in `shuffle partitions` of all are dealt to parts of that size.
    """
    partitions = shuffle_partitions(rows.sparkSession)
    pairs = rows.groupBy(*_PAIR).agg(F.count_if(~F.col("base_failed")).alias("n"), F.count("*").alias("all"))
    pairs = pairs.withColumn("group_source", F.when(F.col("n") >= MIN_ROWS, F.col("source_name")).otherwise("*"))
    pools = pairs.groupBy("lang_name", "group_source").agg(F.sum("n").alias("pool"))
    small = F.col("pool") < MIN_ROWS
    pairs = settle(
        pairs.join(pools, ["lang_name", "group_source"]).select(
            *_PAIR,
            "all",
            F.when(small, F.lit("*")).otherwise(F.col("lang_name")).alias("group_lang"),
            F.when(small, F.lit("*")).otherwise(F.col("group_source")).alias("group_source"),
        ),
        "quality-pairs",
    )
    total = pairs.agg(F.sum("all")).first()[0] or 0
    is_hot = F.col("all") * partitions > total
    sizes = pairs.groupBy("group_lang", "group_source").agg(F.sum("all").alias("all"))
    share = F.ceil(F.col("all") * partitions / F.lit(total))
    hot = sizes.filter(is_hot).select("group_lang", "group_source", share.alias("parts"))
    groups = pairs.join(F.broadcast(hot), ["group_lang", "group_source"], "left")
    return settle(
        groups.select(*_PAIR, is_hot.alias("hot_pair"), *_GROUP[:2], F.coalesce("parts", F.lit(1)).alias("parts")),
        "quality-groups",
    )


def _median_by_group(values: DataFrame, name: str) -> DataFrame:
    """Lower medians of whole numbers (group, x0..): counted by value, so no group is collected."""
    items = F.explode(F.array(*(F.struct(F.lit(x).alias("of"), F.col(x).alias("value")) for x in _X)))
    counts = values.select(*_GROUP, items.alias("i")).groupBy(*_GROUP, "i.of", "i.value").agg(F.count("*").alias("n"))
    by_value = Window.partitionBy(*_GROUP, "of").orderBy("value")
    total = F.sum("n").over(Window.partitionBy(*_GROUP, "of"))
    counts = counts.withColumns({"upto": F.sum("n").over(by_value), "total": total})
    middle = counts.filter(2 * F.col("upto") >= F.col("total")).groupBy(*_GROUP, "of").agg(F.min("value").alias("v"))
    wide = middle.groupBy(*_GROUP).agg(*(F.max(F.when(F.col("of") == x, F.col("v"))).alias(f"{name}_{x}") for x in _X))
    return settle(wide, f"quality-{name}")


def _consistency() -> float:
    """What the scatter of the inner share of a normal group is multiplied by (even dimensions)."""

    def upto(chi: float, dimensions: int) -> float:
        terms = sum((chi / 2) ** i / math.factorial(i) for i in range(dimensions // 2))
        return 1 - math.exp(-chi / 2) * terms

    low, high = 0.0, 100.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if upto(mid, DIMENSIONS) < KEPT_SHARE else (low, mid)
    return KEPT_SHARE / upto(low, DIMENSIONS + 2)


def _concentrated(scored: DataFrame, name: str) -> DataFrame:
    """Center and Cholesky factor of the closest share of each (group, start).

    Rows are added up by bins of their distance, with all products, so one pass gives both the
    bound of the share and its moments. The bin that the share ends in is taken whole. The driver
    keeps the plan of each step, so running sums are made of the counts only and the factor takes
    one projection a column.
    """
    by = [*_GROUP, "start"]
    names = ["n", *(f"s_{x}" for x in _X), *(f"p_{i}_{j}" for i, j in _PAIRS)]
    sums = [F.count("*").alias("n"), *(F.sum(x).alias(f"s_{x}") for x in _X)]
    sums += [F.sum(F.col(_X[i]) * F.col(_X[j])).alias(f"p_{i}_{j}") for i, j in _PAIRS]
    bins = scored.groupBy(*by, F.floor(16 * F.log2(1 + F.col("distance"))).alias("bin")).agg(*sums)
    group = Window.partitionBy(*by)
    before = F.sum("n").over(group.orderBy("bin")) - F.col("n")
    bins = bins.withColumns({"total": F.sum("n").over(group), "before": before})
    inner = bins.filter(F.col("before") < KEPT_SHARE * F.col("total")).groupBy(*by)
    inner = inner.agg(F.max("total").alias("total"), *(F.sum(c).alias(c) for c in names))
    inner = inner.withColumns({f"m_{x}": F.col(f"s_{x}") / F.col("n") / GRID for x in _X})
    scatter = {}
    for i, j in _PAIRS:
        c = F.col(f"p_{i}_{j}") / F.col("n") / (GRID * GRID) - F.col(f"m_{_X[i]}") * F.col(f"m_{_X[j]}")
        c = c * _consistency()
        scatter[f"c_{i}_{j}"] = F.greatest(c, F.lit(0.0)) + LEAST_SPREAD[i] ** 2 if i == j else c
    inner = inner.withColumns(scatter)
    for j in range(DIMENSIONS):
        column = {}
        for i in range(j, DIMENSIONS):
            rest = F.col(f"c_{j}_{i}")
            for k in range(j):
                rest = rest - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            if i == j:
                diagonal = F.sqrt(F.greatest(rest, F.lit(1e-12)))
            column[f"l_{i}_{j}"] = diagonal if i == j else rest / diagonal
        inner = inner.withColumns(column)
    log_det = sum((F.log(F.col(f"l_{i}_{i}")) for i in range(1, DIMENSIONS)), F.log(F.col("l_0_0")))
    factors = [f"l_{i}_{j}" for i in range(DIMENSIONS) for j in range(i + 1)]
    out = inner.select(*by, "total", *(f"m_{x}" for x in _X), *factors, log_det.alias("log_det"))
    return settle(out, f"quality-{name}")


def _with_distance(rows: DataFrame, estimates: DataFrame, how: str = "inner") -> DataFrame:
    """Adds the squared Mahalanobis distance of each row, by forward substitution."""
    joined = _join_dealt(rows, estimates, how)
    for i in range(DIMENSIONS):
        y = F.col(_X[i]) / GRID - F.col(f"m_{_X[i]}")
        for k in range(i):
            y = y - F.col(f"l_{i}_{k}") * F.col(f"y_{k}")
        joined = joined.withColumn(f"y_{i}", y / F.col(f"l_{i}_{i}"))
    squares = sum((F.col(f"y_{i}") * F.col(f"y_{i}") for i in range(1, DIMENSIONS)), F.col("y_0") * F.col("y_0"))
    return joined.withColumn("distance", squares)


def robust_estimates(vectors: DataFrame) -> DataFrame:
    """One row per group: center and scatter with the least determinant of all starts.

    Two fixed starts take the rows closest to the medians, once by the sum of squares and once by
    the largest deviation, both in units of the median deviation. Each concentration step can only
    lower the determinant.
    """
    median = _median_by_group(vectors, "median")
    centered = _join_dealt(vectors, median)
    deviation = centered.select(*_GROUP, *(F.abs(F.col(x) - F.col(f"median_{x}")).alias(x) for x in _X))
    spread = _median_by_group(deviation, "spread")
    joined = _join_dealt(centered, spread)
    z = [
        F.abs(F.col(x) - F.col(f"median_{x}")) / F.greatest(1.4826 * F.col(f"spread_{x}"), F.lit(least * GRID))
        for x, least in zip(_X, LEAST_SPREAD)
    ]
    squares = sum((v * v for v in z[1:]), z[0] * z[0])
    largest = F.greatest(*z)
    starts = F.explode(
        F.array(
            F.struct(F.lit(0).alias("start"), squares.alias("distance")),
            F.struct(F.lit(1).alias("start"), (largest * largest).alias("distance")),
        )
    )
    scored = joined.select(*_GROUP, *_X, starts.alias("s")).select(*_GROUP, *_X, "s.*")
    estimates = _concentrated(scored, "start")
    for step in range(STEPS):
        scored = _with_distance(vectors, estimates)
        estimates = _concentrated(scored, f"step-{step}")
    names = [c for c in estimates.columns if c not in (*_GROUP, "start", "log_det")]
    best = estimates.groupBy(*_GROUP).agg(F.min(F.struct("log_det", "start", *names)).alias("e"))
    best = best.select(*_GROUP, *(f"e.{c}" for c in names)).filter(F.col("total") >= MIN_ROWS)
    return settle(best, "quality-estimates")


def judged(docs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The columns `keep` with the base statistics, base_failed, distance and kept.

    Every row stays, repeated ones too. NULL languages and sources are groups of their own. Rows
    that failed the base rules do not count in the estimates. A row whose pool is still too small to
    estimate has no distance and is kept, as far as the base rules go.
    """
    docs = docs.select(*dict.fromkeys([*keep, "text", "lang", "source"]))
    stats = base_statistics(docs.withColumn("__spread", F.xxhash64(*docs.columns)))
    stats = stats.withColumns({"lang_name": _named("lang"), "source_name": _named("source"), **_transformed()})
    drop = [c for c in ("text", "lang", "source") if c not in keep]
    stats = stats.drop(*drop)
    narrow = [*_PAIR, "base_failed", "__spread", *_X]
    if "text" in keep:
        rows = settle(stats.select(*narrow), "quality-vectors")
    else:
        rows = stats = settle(stats, "quality-statistics")
    groups = _pooled_groups(rows)
    good = rows.filter(~F.col("base_failed")).select(*_PAIR, "__spread", *_X)
    vectors = _join_hot(good, groups, _PAIR, "hot_pair").select(*_GROUP, "__spread", *_X)
    estimates = robust_estimates(settle(vectors, "quality-grouped"))
    placed = _join_hot(stats, groups, _PAIR, "hot_pair", "left")
    result = _with_distance(placed, estimates, "left")
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= CUTOFF, F.lit(True))
    helpers = [c for c in result.columns if c[:2] in ("m_", "l_", "y_")]
    return result.withColumn("kept", kept).drop(*helpers, *_X, *_GROUP, *_PAIR, "__spread", "total")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that pass all rules, with their own columns."""
    helpers = {c: f"__{i}" for i, c in enumerate(docs.columns) if c not in ("text", "lang", "source")}
    renamed = docs.withColumnsRenamed(helpers)
    passed = judged(renamed, renamed.columns).filter("kept")
    return passed.select(*renamed.columns).withColumnsRenamed({v: k for k, v in helpers.items()})
