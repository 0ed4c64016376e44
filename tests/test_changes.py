"""Snapshots compared, and an index that follows a table which is overwritten."""

import os

import pytest
from pyspark.sql import functions as F

from tallyloom.streaming import changes
from tallyloom.streaming.refresh import current_index, refresh_index

SCHEMA = "chunk_id string, text string, note string, tags array<string>, marks map<string,int>"


@pytest.fixture
def table(spark):
    def build(*found):
        return spark.createDataFrame([(*r, *[None] * (5 - len(r))) for r in found], SCHEMA)

    return build


def seen(df):
    return sorted((r["change"], r["chunk_id"], r["text"], r["note"]) for r in df.collect())


def test_all_kinds_and_nulls(table):
    before = table(("a", "x"), ("b", "x"), ("c", None, "y"), ("d", ""), (None, "n"), ("same", "s", None, ["p", None], {"k": 1}))
    after = table(("a", "x"), ("b", "z"), ("c", "y", None), ("d", None), ("e", "new"), ("same", "s", None, ["p", None], {"k": 1}))
    # "c": the same value in another column; "d": empty against null; the null key is gone
    found = changes.snapshot_changes(before, after, "chunk_id")
    assert found.columns == ["change", *before.columns]
    assert [(r["change"], r["chunk_id"], r["text"]) for r in found.orderBy("change", "chunk_id").collect()] == [
        ("delete", None, None), ("insert", "e", "new"), ("update", "b", "z"), ("update", "c", "y"), ("update", "d", None),
    ]
    back = changes.snapshot_changes(after, before, "chunk_id").groupBy("change").count().collect()
    assert sorted(map(tuple, back)) == [("delete", 1), ("insert", 1), ("update", 3)]


def test_nested_values_count(table):
    pairs = [(["p", None], [None, "p"]), (["p"], ["p", None]), ([], None), (["a,b"], ["a", "b"])]
    for one, other in pairs:
        found = changes.snapshot_changes(table(("k", "t", None, one)), table(("k", "t", None, other)), "chunk_id")
        assert [r["change"] for r in found.collect()] == ["update"]
    same = changes.snapshot_changes(table(("k", "t", None, None, {"a": 1, "b": 2})), table(("k", "t", None, None, {"b": 2, "a": 1})), "chunk_id")
    assert same.collect() == []


def test_watched_columns_repeated_rows_and_empty_tables(table):
    before, after = table(("a", "x", "1")), table(("a", "x", "2"), ("a", "x", "2"))
    assert changes.snapshot_changes(before, after, "chunk_id", ["text"]).collect() == []
    assert seen(changes.snapshot_changes(before, after, "chunk_id")) == [("update", "a", "x", "2")]
    several = table(("a", "x"), ("a", "y"), ("a", "z"))
    assert changes.snapshot_changes(several, several.orderBy(F.desc("text")), "chunk_id").collect() == []
    assert seen(changes.snapshot_changes(before, before.limit(0), "chunk_id")) == [("delete", "a", None, None)]
    assert changes.snapshot_changes(before.limit(0), before.limit(0), "chunk_id").collect() == []


def test_a_hot_key_is_combined_before_the_shuffle(spark, table):
    hot = table(("hot", "t")).crossJoin(spark.range(20000)).drop("id")
    plan = changes.snapshot_rows(hot, "chunk_id")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan
    assert changes.snapshot_changes(table(("hot", "t")), hot, "chunk_id").collect() == []


def index_rows(spark, index, schema):
    return sorted((r["chunk_id"], r["text"]) for r in current_index(spark, index, schema).collect())


def test_index_follows_overwritten_table(spark, table, tmp_path):
    source, state, index, progress, live = (str(tmp_path / p) for p in ("source", "state", "index", "progress", "live"))
    states = [
        table(("a", "1"), ("b", "1"), ("c", "1")), table(("a", "1"), ("b", "2")), table(("a", "1"), ("b", "2")),
        table(("a", "3"), ("c", "back")), table(("a", "3")).limit(0), table(("z", "9")),
    ]
    for n, now in enumerate(states, 1):
        now.drop("marks").write.mode("overwrite").parquet(live)
        held = spark.read.parquet(live)
        assert changes.deliver_changes(held, source, state) == n == changes.last_snapshot(spark, state)
        schema = changes.feed_schema(held)
        refresh_index(spark, source, index, progress, schema)
        assert index_rows(spark, index, schema) == sorted((r["chunk_id"], r["text"]) for r in now.collect())
    delivered = spark.read.schema(schema).parquet(source)
    assert delivered.where("version = 3").count() == 0
    assert sorted((r["chunk_id"], r["deleted"]) for r in delivered.where("version = 4").collect()) == [("a", False), ("b", True), ("c", False)]
    assert sorted(p for p in os.listdir(state) if p.startswith("snapshot")) == ["snapshot=5", "snapshot=6"]


def test_a_stop_before_the_state_is_written_loses_nothing(spark, table, tmp_path):
    source, state, index, progress = (str(tmp_path / p) for p in ("source", "state", "index", "progress"))
    first, second, third = (table(*r).drop("marks") for r in ((("a", "1"), ("b", "1")), (("a", "2"), ("c", "1")), (("a", "3"), ("c", "1"))))
    changes.deliver_changes(first, source, state)
    changes.deliver_changes(second, source, state)
    os.remove(f"{state}/snapshot=2/_SUCCESS")  # as if the second state had not been finished
    assert changes.last_snapshot(spark, state) == 1
    assert changes.deliver_changes(third, source, state) == 3
    schema = changes.feed_schema(first)
    refresh_index(spark, source, index, progress, schema)
    assert index_rows(spark, index, schema) == [("a", "3"), ("c", "1")]


def test_clashing_columns_are_refused(table, tmp_path):
    with pytest.raises(ValueError, match="version"):
        changes.deliver_changes(table(("a", "x")).withColumn("version", F.lit(1)), str(tmp_path / "s"), str(tmp_path / "t"))
