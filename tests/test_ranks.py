import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rows import values
from auditlens.functions import joins
from auditlens.functions.ranks import percent_ranks


def ranked(rows):
    counts = rows.groupBy("part", "value").agg(F.count("*").alias("rows"))
    return joins.sliced_join(rows, percent_ranks(counts), ["part", "value"], ["id"])


@pytest.mark.parametrize("seed", range(3))
def test_equals_the_window_function(spark, seed):
    pick = random.Random(seed)
    pool = [0.0, 1.0, 1.0, 1.001, 5.0, 1e-9, 1e15, 0.1 + 0.2, 0.3, -2.0, -2.001, 5e-324]
    rows = [
        (n, pick.choice("ab"), pick.choice(pool) if pick.random() < 0.7 else pick.random() * 100)
        for n in range(300)
    ]
    df = spark.createDataFrame(rows, "id long, part string, value double")
    window = Window.partitionBy("part").orderBy("value")
    expected = df.withColumn("percent_rank", F.percent_rank().over(window))
    columns = ["id", "part", "value", "percent_rank"]
    assert values(ranked(df), *columns) == values(expected, *columns)


def test_one_row_and_ties(spark):
    df = spark.createDataFrame([(1, "one", 7.0), (2, "tie", 7.0), (3, "tie", 7.0)], "id long, part string, value double")
    assert values(ranked(df), "id", "percent_rank") == [(1, 0.0), (2, 0.0), (3, 0.0)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_slices_join_like_a_plain_join(spark, how):
    rows = spark.createDataFrame([(n, "hot" if n % 3 else str(n)) for n in range(60)] + [(60, None)], "id long, k string")
    lookup = spark.createDataFrame([("hot", 1), ("hot", 2), ("3", 3), (None, 4)], "k string, v int")
    found = joins.sliced_join(rows, lookup, ["k"], ["id"], how)
    assert values(found, "id", "k", "v") == values(rows.join(lookup, "k", how), "id", "k", "v")
