import random

import pytest
from pyspark.sql import functions as F

from cadenza.operators import feeds
from cadenza.operators.selection import smallest


def ordered(pairs):
    return sorted(pairs, key=lambda p: ((p[0] is not None, p[0]), p[1]))


@pytest.mark.parametrize("n", [0, 1, 40, 399, 1_234, 1_999, 2_000, 5_000])
def test_same_rows_as_a_sort(spark, n):
    rng = random.Random(3)
    pairs = [(rng.choice([None, "", "é", "z"] + [f"k{j}" for j in range(30)]), i) for i in range(2_000)]
    rows = spark.createDataFrame(pairs, "name string, id long").repartition(5)
    found = [tuple(r) for r in smallest(rows, ["name", "id"], n, most=30).collect()]
    assert ordered(found) == ordered(pairs)[:n]


def test_ties_of_a_hot_key_and_other_types(spark):
    rows = spark.range(900).select(F.when(F.col("id") % 3 == 0, F.lit(7.5)).otherwise(F.col("id") / 100).alias("x"), F.timestamp_seconds("id").alias("t"), "id")
    assert sorted(r.x for r in smallest(rows, ["x"], 700, most=20).collect()) == sorted(r.x for r in rows.collect())[:700]
    newest = smallest(rows, [-F.unix_timestamp("t")], 300, most=50)
    assert sorted(r.id for r in newest.collect()) == list(range(600, 900))
    assert {r.id for r in smallest(rows, ["t"], 300, most=50).collect()} == set(range(300))


def test_empty_and_equal_rows(spark):
    assert smallest(spark.range(0), ["id"], 50, most=5).count() == 0
    same = spark.range(200).select(F.lit(1).alias("a"), F.lit("b").alias("__k"))
    assert smallest(same, ["a"], 150, most=5).count() == 150


def test_no_task_holds_all_chosen_rows(spark):
    chosen = smallest(spark.range(0, 40_000, 1, 8), ["id"], 30_000, most=2_000)
    sizes = [r["count"] for r in chosen.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 30_000 and max(sizes) <= 5_000
    whole = feeds.fixed_size_sample(spark.range(3_000), "id", 1_000)
    cut = feeds.fixed_size_sample(spark.range(3_000), "id", 1_000, most=100)
    assert {r.id for r in whole.collect()} == {r.id for r in cut.collect()}
