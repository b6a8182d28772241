"""Sharding along a Hilbert curve.

Metadata columns become levels of a small grid, documents are sorted by the place of their cell on a
Hilbert curve, and the order is cut into runs of equal length. Documents that are close in all
columns lie close in the order, so each shard spans a narrow range of every column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditlens.llm.common import let
from auditlens.session import settle

SHARDS = 8
LEVEL_BITS = 5
# A hot cell of the grid is cut into this many ranges of a hash of doc_id.
RANGE_BITS = 10
LAW = "rows"


def _ranked_levels(docs: DataFrame, column: str) -> DataFrame:
    """Level of each value of a column: values in order, each level with about as many rows.

    One row per distinct value; NULL comes first.
    """
    counts = docs.groupBy(column).agg(F.count("*").alias("n"))
    order = Window.orderBy(F.col(column).asc_nulls_first())
    before = F.sum("n").over(order) - F.col("n")
    total = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    level = F.floor(before * (1 << LEVEL_BITS) / total).cast("long")
    levels = counts.select(F.col(column).alias(f"of_{column}"), level.alias(f"level_{column}"))
    return settle(levels, f"levels-{column}")


def _size_level(size: Column) -> Column:
    """Level of a size: doubling it takes it 1.25 levels up, and the last level is open."""
    return F.least(F.floor(F.log2(size) * 1.25), F.lit((1 << LEVEL_BITS) - 1)).cast("long")


def hilbert_index(axes: Sequence[Column], bits: int = LEVEL_BITS) -> Column:
    """Place on the curve of a cell with the given levels, whole numbers below 2 to the `bits`.

    The axes are turned into the transpose of the index from the highest bit down; then the bits of
    the transpose are put in turn. One expression over a small array, so that plans stay short.
    """
    n = len(axes)
    number = lambda v: F.lit(v).cast("long")
    turns = [
        F.struct(number(1 << b).alias("q"), number((1 << b) - 1).alias("p"), F.lit(i).alias("i"))
        for b in range(bits - 1, 0, -1)
        for i in range(n)
    ]

    def turn(x: Column, t: Column) -> Column:
        def turned(both: Column) -> Column:
            is_set = both["axis"].bitwiseAND(t["q"]) != 0
            swap = both["first"].bitwiseXOR(both["axis"]).bitwiseAND(t["p"])
            first = both["first"].bitwiseXOR(F.when(is_set, t["p"]).otherwise(swap))
            axis = F.when(is_set, both["axis"]).otherwise(both["axis"].bitwiseXOR(swap))
            return F.transform(x, lambda v, k: F.when(k == 0, first).when(k == t["i"], axis).otherwise(v))

        return let(F.struct(F.get(x, F.lit(0)).alias("first"), F.get(x, t["i"]).alias("axis")), turned)

    def gray(x: Column) -> Column:
        folded = [F.get(x, F.lit(0))]
        for i in range(1, n):
            folded.append(folded[-1].bitwiseXOR(F.get(x, F.lit(i))))
        return F.array(*folded)

    def joined(x: Column) -> Column:
        last, flip = F.get(x, F.lit(n - 1)), number(0)
        for b in range(bits - 1, 0, -1):
            mask = F.when(last.bitwiseAND(number(1 << b)) != 0, number((1 << b) - 1)).otherwise(number(0))
            flip = flip.bitwiseXOR(mask)

        def index(f: Column) -> Column:
            out = number(0)
            for b in range(bits):
                for i in range(n):
                    bit = F.shiftright(F.get(x, F.lit(i)).bitwiseXOR(f), b).bitwiseAND(number(1))
                    out = out + F.shiftleft(bit, b * n + n - 1 - i)
            return out

        return let(flip, index)

    start = F.array(*(F.coalesce(a.cast("long"), number(0)) for a in axes))
    return let(let(F.aggregate(F.array(*turns), start, turn), gray), joined)


def hilbert_shards(docs: DataFrame, shards: int = SHARDS, columns: Sequence[str] = ("lang", "source")) -> DataFrame:
    """Adds size, text_crc32, cell, place, shard and slot to each document.

    Axes: the given columns by rank, and the size of the text in bytes plus one. The order is by
    cell, then by a hash of doc_id; ties of repeated rows fall in any order among themselves.
    Shards are runs of this order whose lengths differ by one at most (law `rows`); slots count from
    0 in each shard. NULLs are the lowest value of a column; a NULL text has size 1 and the CRC of
    an empty one. An empty table gives no rows.

    Places come from sums over the cells of the grid (bounded), over ranges of a cell (bounded), and
    over the rows of one range, so a cell with a third of all rows is worked on by many tasks.
    """
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.withColumns(
        {
            "size": (F.octet_length(data) + 1).cast("long"),
            "text_crc32": F.crc32(data),
            "h": F.xxhash64("doc_id"),
        }
    )
    rows = rows.withColumn("range", F.shiftright("h", 64 - RANGE_BITS))
    for c in columns:
        levels = _ranked_levels(docs, c)
        rows = rows.join(levels, F.col(c).eqNullSafe(F.col(f"of_{c}"))).drop(f"of_{c}")
    rows = rows.withColumn("level_size", _size_level(F.col("size")))
    axes = [*(f"level_{c}" for c in columns), "level_size"]
    rows = rows.withColumn("cell", hilbert_index([F.col(a) for a in axes])).drop(*axes)
    ranges = settle(rows.groupBy("cell", "range").agg(F.count("*").alias("n")), "shard-ranges")
    in_cell = Window.partitionBy("cell").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    cells = ranges.groupBy("cell").agg(F.sum("n").alias("in_cell"))
    in_order = Window.orderBy("cell")
    everything = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cells = cells.select(
        "cell",
        (F.sum("in_cell").over(in_order) - F.col("in_cell")).alias("before_cell"),
        F.sum("in_cell").over(everything).alias("total"),
    )
    before = ranges.select("cell", "range", F.coalesce(F.sum("n").over(in_cell), F.lit(0)).alias("before_range"))
    before = settle(before.join(cells, "cell"), "shard-offsets")
    rows = rows.join(before, ["cell", "range"])
    number = F.row_number().over(Window.partitionBy("cell", "range").orderBy("h", "doc_id", "text_crc32", "size"))
    rows = rows.withColumn("place", F.col("before_cell") + F.col("before_range") + number - 1)
    # Whole-number division: a double would round places near a cut.
    rows = rows.withColumn("shard", F.expr(f"int(place * {shards} div total)"))
    rows = rows.withColumn("slot", F.expr(f"place - (shard * total + {shards - 1}) div {shards}"))
    return rows.drop("h", "range", "before_cell", "before_range", "total")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """The documents as Parquet with a folder per shard, each in curve order."""
    rows = hilbert_shards(docs, shards)
    rows.repartition("shard", F.floor(F.col("slot") / 100_000)).sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
