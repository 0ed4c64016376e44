import pytest

from tallyloom.session import scratch_path
from tallyloom.streaming.refresh import (
    compact_index,
    current_index,
    freshness,
    indexed_versions,
    refresh_index,
)

SCHEMA = "chunk_id string, version int, deleted boolean, text string"


def frame(spark, rows):
    return spark.createDataFrame([(k, n, gone, text) for k, n, gone, text in rows], SCHEMA)


class Feed:
    """A source folder with a checkpoint of its own into a shared index."""

    def __init__(self, spark, index):
        self.spark, self.index = spark, index
        self.source, self.checkpoint = scratch_path(spark, "src"), scratch_path(spark, "chk")

    def deliver(self, df):
        df.write.mode("append").parquet(self.source)
        self.run(df.schema)

    def run(self, schema, files=1000):
        refresh_index(self.spark, self.source, self.index, self.checkpoint, schema, files)


def test_replay_equals_batch_and_hot_keys_shrink(spark, rows):
    index = scratch_path(spark, "idx")
    feed = Feed(spark, index)
    first = frame(spark, [(f"c{i}", 1, False, f"v1 {i}") for i in range(50)])
    feed.deliver(first)
    assert rows(current_index(spark, index, first.schema)) == rows(first)
    feed.run(first.schema)
    assert rows(current_index(spark, index, first.schema)) == rows(first)
    resent = [("c1", 3, False, "late"), ("c2", 2, None, "new"), ("c3", 2, True, None)]
    feed.deliver(frame(spark, resent + [("c1", 2, False, "hot")] * 200).repartition(5))
    current = {r.chunk_id: (r.version, r.text) for r in current_index(spark, index, first.schema).collect()}
    assert current["c1"] == (3, "late") and current["c2"] == (2, "new")
    assert "c3" not in current and len(current) == 49
    assert indexed_versions(spark, index, first.schema).count() == 253


def test_two_checkpoints_into_one_index_keep_all_rows(spark):
    index = scratch_path(spark, "idx")
    one, two = Feed(spark, index), Feed(spark, index)
    one.deliver(frame(spark, [(f"a{i}", 1, False, "x") for i in range(20)]))
    two.deliver(frame(spark, [(f"b{i}", 1, False, "y") for i in range(7)]))
    schema = frame(spark, []).schema
    assert current_index(spark, index, schema).count() == 27


@pytest.mark.parametrize("files", [1, 1000])
def test_compaction_keeps_what_is_current(spark, rows, files):
    index = scratch_path(spark, "idx")
    feed = Feed(spark, index)
    feed.deliver(frame(spark, [(f"c{i}", 1, False, "old") for i in range(30)]))
    feed.deliver(frame(spark, [(f"c{i}", 2, i % 2 == 0, "new") for i in range(10)]))
    schema = frame(spark, []).schema
    before = rows(current_index(spark, index, schema))
    compact_index(spark, index, schema)
    assert rows(current_index(spark, index, schema)) == before and len(before) == 25
    assert indexed_versions(spark, index, schema).count() == 30
    feed.deliver(frame(spark, [("c0", 1, False, "too late"), ("z", 1, False, "more")]))
    compact_index(spark, index, schema)
    keys = {r.chunk_id for r in current_index(spark, index, schema).collect()}
    assert "z" in keys and "c0" not in keys and len(keys) == 26


def test_freshness_names_what_is_behind(spark, rows):
    source = frame(spark, [("a", 1, False, ""), ("b", 2, False, ""), ("c", 1, False, "")])
    index = frame(spark, [("b", 1, False, ""), ("c", 1, False, ""), ("d", 1, False, "")])
    assert rows(freshness(source, index)) == [(3, 3, 1, 1, 1, 3)]
    assert rows(freshness(source, source)) == [(3, 3, 0, 0, 0, 0)]
    assert rows(freshness(source.limit(0), index.limit(0))) == [(0, 0, 0, 0, 0, 0)]
