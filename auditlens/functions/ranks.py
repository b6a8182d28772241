"""Percent ranks over all rows, without sorting all rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Width of a bucket: 256 buckets for each doubling of the value. So the number of buckets follows
# the range of the values and not their count: some thousands for all values that costs and counts
# take, and below 1.1 million for all doubles.
_BUCKETS_PER_DOUBLING = 256
_BUCKET_OF_ONE = 1100 * _BUCKETS_PER_DOUBLING

def _bucket(value: Column) -> Column:
    """A bucket number that never falls as the value rises; 0 holds zero."""
    size = F.floor(F.log2(F.abs(value)) * _BUCKETS_PER_DOUBLING).cast("bigint") + _BUCKET_OF_ONE
    return F.when(value > 0, size).when(value < 0, -size).otherwise(F.lit(0).cast("bigint"))


def percent_ranks(counts: DataFrame) -> DataFrame:
    """Percent rank of each value of a part, ascending.

    `counts` has one row per (part, value) with the number of `rows` that hold it; `value` is a
    double and not NULL. Returns (part, value, percent_rank).

    The rows before a value are those in lower buckets plus those with a lower value in its own
    bucket. Sums over buckets are small; sums within a bucket run in parallel.
    """
    counts = counts.select("part", "value", "rows", _bucket(F.col("value")).alias("bucket"))
    before = (Window.unboundedPreceding, -1)
    by_bucket = Window.partitionBy("part").orderBy("bucket").rowsBetween(*before)
    by_value = Window.partitionBy("part", "bucket").orderBy("value").rowsBetween(*before)
    buckets = (
        counts.groupBy("part", "bucket")
        .agg(F.sum("rows").alias("rows"))
        .select(
            "part",
            "bucket",
            F.coalesce(F.sum("rows").over(by_bucket), F.lit(0)).alias("lower_buckets"),
            F.sum("rows").over(Window.partitionBy("part")).alias("total"),
        )
    )
    lower = F.col("lower_buckets") + F.coalesce(F.sum("rows").over(by_value), F.lit(0))
    rank = lower.cast("double") / (F.col("total") - 1).cast("double")
    return counts.join(buckets, ["part", "bucket"]).select(
        "part",
        "value",
        F.when(F.col("total") > 1, rank).otherwise(0.0).alias("percent_rank"),
    )
