"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in shuffled order, and may be repeated. A copy finishes at a
virtual time: the tokens of its source up to and with it, divided by the weight of the source. All
copies in order of that time, cut where the budget is used up, are the mix.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditlens.llm.common import WORD, native_count
from auditlens.session import settle

WEIGHTS = (1, 2, 3)
REPEATS = 3
SEED = 42
# The rows of a source are cut into this many ranges of the shuffled order, for running sums.
RANGE_BITS = 10
# Words in a range of virtual time. The number of ranges grows with the corpus.
RANGE_WORDS = 10_000_000


def _sized(docs: DataFrame) -> DataFrame:
    """Adds size, the place `h` in the shuffled order and its range."""
    order = F.xxhash64(F.lit(SEED), "doc_id")
    return docs.withColumns(
        {"size": native_count(F.col("text"), WORD), "h": order, "range": F.shiftright(order, 64 - RANGE_BITS)}
    )


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """One row per source: number, weight, source_size, target.

    Sources in code point order, NULL last, take the weights in turn and share the sum of all sizes
    by them. A target ends at `repeats` times its source; the excess goes to the others by weight.
    The level up to which all fill is found over the sources sorted by when they are full.
    """
    of_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    turn = F.array(*(F.lit(int(w)).cast("long") for w in weights))
    rows = of_source.withColumn("number", number)
    rows = rows.withColumn("weight", F.get(turn, (F.col("number") - 1) % len(weights)))
    rows = rows.withColumn("full", F.col("source_size") * repeats)
    order = Window.orderBy(F.col("full") / F.col("weight"), "number")
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.sum("full").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("level", (F.sum("source_size").over(everything) - before) / open_weight)
    fits = F.when(F.col("level") * F.col("weight") <= F.col("full"), F.col("level"))
    rows = rows.withColumn("level", F.first(fits, ignorenulls=True).over(everything))
    target = F.least(F.col("full").cast("double"), F.col("level") * F.col("weight"))
    rows = rows.withColumn("target", F.coalesce(target, F.lit(0.0)))
    return settle(rows.select("source", "number", "weight", "source_size", "target"), "mix-targets")


@dataclass(frozen=True)
class Mix:
    """A mix that is settled: who gets how much, and where the queue is cut."""

    targets: DataFrame
    ranges: DataFrame
    weights: tuple[int, ...]
    repeats: int
    total_weight: int
    cut_range: int
    cut: tuple[int, int] | None

    def _finish(self, total: Column) -> Column:
        """Virtual time in units of one word over the common multiple of all weights."""
        multiple = math.lcm(*self.weights)
        return total * F.floor(F.lit(multiple) / F.col("weight")).cast("long")

    def _time_range(self, finish: Column) -> Column:
        width = math.lcm(*self.weights) * max(1, RANGE_WORDS // max(1, self.total_weight))
        return F.floor(finish / F.lit(width)).cast("long")

    def queued(self, sized: DataFrame) -> DataFrame:
        """Adds number, weight, source_size, target and `upto`, the words of the source up to here."""
        named = sized.withColumnRenamed("source", "__source")
        rows = named.join(self.targets, F.col("__source").eqNullSafe(F.col("source")))
        rows = rows.drop("source").withColumnRenamed("__source", "source")
        rows = rows.join(self.ranges, ["number", "range"])
        order = Window.partitionBy("number", "range").orderBy("h", "doc_id", "size")
        running = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
        return rows.withColumn("upto", F.col("before") + running)

    def copies(self, queued: DataFrame) -> DataFrame:
        """One row per document of at least one word and repeat: finish, number, size, time_range."""
        epoch = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(self.repeats - 1).cast("long")))
        rows = queued.filter("size > 0").withColumn("epoch", epoch)
        finish = self._finish(F.col("epoch") * F.col("source_size") + F.col("upto"))
        rows = rows.select(finish.alias("finish"), "number", "size")
        return rows.withColumn("time_range", self._time_range(F.col("finish")))

    def times_taken(self) -> Column:
        """How many copies of a queued row lie before the cut. A text without words is taken once."""
        taken = F.lit(0)
        for epoch in range(self.repeats):
            finish = self._finish(F.col("source_size") * epoch + F.col("upto"))
            inside = self._time_range(finish) < self.cut_range
            if self.cut is not None:
                at, number = self.cut
                last = (finish < at) | ((finish == at) & (F.col("number") <= number))
                inside = inside | ((self._time_range(finish) == self.cut_range) & last)
            taken = taken + F.when(inside, 1).otherwise(0)
        return F.when(F.col("size") == 0, F.lit(1)).otherwise(taken)


def plan_mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS) -> tuple[Mix, DataFrame]:
    """The mix of all documents, and their sizes (doc_id, source, size, h, range), both settled.

    Nothing but the cut comes to the driver: one range of virtual time and one place in it. The sums
    by range of the hot source are made in parallel; what runs in one task is over sources, over
    ranges, or over the copies of one range of time.
    """
    sizes = settle(_sized(docs.select("doc_id", "source", "text")).drop("text"), "mix-sizes")
    shares = targets(sizes, weights, repeats)
    by_range = sizes.join(
        shares.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source"))
    )
    by_range = by_range.groupBy("number", "range").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(
        Window.partitionBy("number").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    )
    ranges = settle(by_range.select("number", "range", F.coalesce(before, F.lit(0)).alias("before")), "mix-ranges")
    total = shares.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    budget, weight = total["words"] or 0, total["weight"] or 1
    mix = Mix(shares, ranges, tuple(weights), repeats, weight, 0, None)
    copies = settle(mix.copies(mix.queued(sizes)), "mix-copies")
    by_time = copies.groupBy("time_range").agg(F.sum("size").alias("words"))
    running = F.sum("words").over(Window.orderBy("time_range"))
    by_time = by_time.select("time_range", "words", running.alias("upto"))
    crossing = by_time.filter(F.col("upto") > budget).orderBy("time_range").first()
    if crossing is None:
        last = by_time.agg(F.max("time_range")).first()[0]
        return Mix(shares, ranges, tuple(weights), repeats, weight, (last or 0) + 1, None), sizes
    room = budget - (crossing["upto"] - crossing["words"])
    inside = copies.filter(F.col("time_range") == crossing["time_range"])
    upto = F.sum("size").over(Window.orderBy("finish", "number").rowsBetween(Window.unboundedPreceding, 0))
    cut = (
        inside.withColumn("upto", upto)
        .filter(F.col("upto") <= room)
        .agg(F.max(F.struct("finish", "number")).alias("cut"))
        .first()["cut"]
    )
    at = None if cut is None else (cut["finish"], cut["number"])
    return Mix(shares, ranges, tuple(weights), repeats, weight, crossing["time_range"], at), sizes


def mix_report(docs: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """Rows (doc_id, source, size, source_size, target, taken) for every document.

    taken is size times the number of copies in the mix, 0 for texts without words. NULL texts have
    size 0, a NULL source is a source. Repeated rows are separate documents. An empty table gives
    no rows.
    """
    mix, sizes = plan_mix(docs, weights, repeats)
    rows = mix.queued(sizes).withColumn("taken", F.col("size") * mix.times_taken())
    return rows.select("doc_id", "source", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """The mix itself: rows of `docs`, as often as they are taken. Texts without words stay once."""
    mix, _ = plan_mix(docs, weights, repeats)
    others = {c: f"__{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text", "source")}
    sized = _sized(docs.withColumnsRenamed(others))
    rows = mix.queued(sized).withColumn("times", mix.times_taken())
    rows = rows.filter("times > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
    rows = rows.select(*docs.withColumnsRenamed(others).columns)
    return rows.withColumnsRenamed({v: k for k, v in others.items()})
