"""Joins on keys that very many rows may share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Slices that the rows of a key are split into.
SLICES = 16


def sliced_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
) -> DataFrame:
    """Join where a key has few rows in `lookup` and may have very many in `rows`.

    The rows of a key are split over slices by a hash of `spread_by`, and the lookup is repeated in
    each slice. The hash of the same row is the same on every attempt of a task.
    """
    sliced = rows.withColumn("slice", F.pmod(F.xxhash64(*spread_by), F.lit(SLICES)))
    repeated = lookup.withColumn("slice", F.expr(f"explode(sequence(0L, {SLICES - 1}L))"))
    return sliced.join(repeated, [*keys, "slice"], how).drop("slice")
