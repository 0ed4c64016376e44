import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloom.operators import ranking
from tallyloom.operators.audits import (
    accepted_values,
    embedding_audit,
    fanout_audit,
    key_audit,
    orphan_audit,
)


@pytest.fixture(scope="module")
def numbers(spark):
    """Rows of which a third share one group and one value, with NULLs in both."""
    rnd = random.Random(3)
    data = []
    for i in range(3000):
        hot = i % 3 == 0
        group = "hot" if hot else rnd.choice(["a", "b", "c", None])
        value = 50 if hot and i % 2 else rnd.choice([None, *range(100)])
        data.append((i, group, value))
    return spark.createDataFrame(data, "id int, g string, x int").repartition(7).cache()


@pytest.fixture(autouse=True, scope="module")
def many_ranges(spark):
    """Keep several ranges even on small inputs."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_surrogate_key_equals_global_row_number(numbers, rows):
    keyed = ranking.surrogate_key(numbers, ["g", F.col("x").desc(), "id"], "k")
    window = Window.orderBy("g", F.col("x").desc(), "id")
    expected = numbers.withColumn("k", F.row_number().over(window))
    assert rows(keyed, "id", "k") == rows(expected, "id", "k")


@pytest.mark.parametrize("by_rows", [False, True])
@pytest.mark.parametrize("partition", [[], ["g"]])
@pytest.mark.parametrize("ours, built_in", [
    (ranking.dense_rank_by, F.dense_rank), (ranking.rank_by, F.rank),
])
def test_ranks_equal_windows(numbers, rows, partition, ours, built_in, by_rows):
    window = Window.partitionBy(*partition).orderBy(F.col("x").desc())
    expected = numbers.withColumn("r", built_in().over(window))
    assert rows(ours(numbers, "x", "r", partition, by_rows), "id", "r") == rows(expected, "id", "r")


@pytest.mark.parametrize("partition", [[], ["g"], ["g", "h"]])
@pytest.mark.parametrize("ours, built_in", [
    (ranking.dense_rank_by, F.dense_rank), (ranking.rank_by, F.rank),
])
def test_ties_over_several_ranges(spark, rows, partition, ours, built_in):
    """Two values hold nearly all rows, so each fills several ranges; NULLs and NaN tie with their like."""
    data = [(i, i % 2, None if i % 5 else "h", [7.0, 7.0, 7.0, None, None, float("nan"), -0.0, 0.0][i % 8]) for i in range(1500)]
    data += [(2000, 0, "h", 99.0), (2001, 1, None, -5.0), (2002, None, None, 7.0)]
    df = spark.createDataFrame(data, "id int, g int, h string, x double").repartition(5)
    expected = df.withColumn("r", built_in().over(Window.partitionBy(*partition).orderBy(F.col("x").desc())))
    assert rows(ours(df, "x", "r", partition, by_rows=True), "id", "r") == rows(expected, "id", "r")


def test_ranks_of_repeated_rows_and_of_none(spark, rows):
    df = spark.createDataFrame([(1, "a")] * 40 + [(0, "a")] * 3, "x int, g string")
    assert rows(ranking.rank_by(df, "x", "r", ["g"], by_rows=True)) == sorted([(0, "a", 41)] * 3 + [(1, "a", 1)] * 40, key=str)
    assert rows(ranking.dense_rank_by(df.where("false"), "x", "r", by_rows=True)) == []


def test_revenue_ranks_equal_windows(numbers, rows):
    ranked = ranking.revenue_ranks(numbers.withColumnRenamed("g", "category"), "x")
    desc = F.col("x").desc()
    expected = numbers.withColumn("a", F.dense_rank().over(Window.orderBy(desc))).withColumn(
        "b", F.dense_rank().over(Window.partitionBy("g").orderBy(desc))
    )
    assert rows(ranked, "id", "revenue_rank", "category_revenue_rank") == rows(expected, "id", "a", "b")


def test_ranks_do_not_join_on_the_value(numbers, capsys):
    ranking.dense_rank_by(numbers, "x", "r", by_rows=True).explain("formatted")
    joins = [line for line in capsys.readouterr().out.splitlines() if line.startswith(("Left keys", "Right keys"))]
    assert joins and not any("x#" in line for line in joins)


@pytest.mark.parametrize("count, lag", [(0, 7), (1, 7), (5, 7), (23, 7), (400, 7), (400, 1), (60, 30)])
def test_lag_equals_window(spark, rows, count, lag):
    """Also where ranges are shorter than the lag, so that a range's rows ahead come from several."""
    data = [(i * 3, None if i % 9 == 4 else float(i * i % 17)) for i in range(count)]
    df = spark.createDataFrame(data, "d int, x double").repartition(6)
    expected = df.withColumn("before", F.lag("x", lag).over(Window.orderBy("d")))
    ours = ranking.lag_growth(df, "d", "x", lag, "before", "growth")
    assert ours.columns == ["d", "x", "before", "growth"]
    assert rows(ours, "d", "x", "before") == rows(expected, "d", "x", "before")


def test_shares(spark, rows):
    df = spark.createDataFrame(
        [("a", "p", 1), ("a", "q", 3), ("b", "p", 0), (None, "p", 5)], "g string, k string, n long"
    )
    shared = ranking.share_of_partition(df, ["g"], "n", "pct")
    assert rows(shared, "g", "k", "pct") == [
        ("a", "p", 25.0), ("a", "q", 75.0), ("b", "p", None), (None, "p", 100.0),
    ]
    total = ranking.share_of_total(df.where("g = 'a'"), "n", "pct")
    assert rows(total, "k", "pct") == [("p", 25.0), ("q", 75.0)]


def test_first_n_per_limits_before_the_shuffle(numbers, rows, capsys):
    first = ranking.first_n_per(numbers, ["g"], [F.col("x").desc(), "id"], 4)
    window = Window.partitionBy("g").orderBy(F.col("x").desc(), "id")
    expected = numbers.withColumn("n", F.row_number().over(window)).where("n <= 4")
    assert rows(first, "id", "position") == rows(expected, "id", "n")
    first.explain()
    assert "WindowGroupLimit" in capsys.readouterr().out


def test_top_n_needs_no_full_sort(numbers, capsys):
    ranking.top_n(numbers, ["x", "id"], 5).explain()
    assert "TakeOrderedAndProject" in capsys.readouterr().out


def test_audits(spark, rows):
    left = spark.createDataFrame(
        [(1, "a"), (1, "a"), (2, "b"), (3, None)], "id int, code string"
    )
    right = spark.createDataFrame([("a",), ("a",), ("c",)], "key string")
    assert rows(key_audit(left, ["id", "code"])) == [(1, "a", 2, False), (3, None, 1, True)]
    keys = [("code", "key")]
    assert rows(orphan_audit(left, right, keys)) == [("b", 1), (None, 1)]
    assert rows(fanout_audit(left, right, keys)) == [(2, 1)]
    assert rows(fanout_audit(left, right.where("key = 'z'"), keys)) == [(0, 0)]
    assert rows(accepted_values(left, "code", ["a"])) == [("b", 1)]
    vectors = spark.createDataFrame(
        [([1.0, 2.0],), ([],), (None,), ([3.0, 4.0],)], "embedding array<float>"
    )
    assert rows(embedding_audit(vectors)) == [(0, 1), (2, 2), (None, 1)]
