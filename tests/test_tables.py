from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.sources import folders
from wardflow.sources.tables import Reach, Segment, SegmentedTable, bucket_of

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])


@pytest.fixture
def table(spark, tmp_path):
    return SegmentedTable(spark, str(tmp_path / "table"), SCHEMA, "k")


def rows(spark, update=(), **values):
    """k1="a" is the row (1, "a"); keys listed in ``update`` are new images."""
    data = [(int(k[1:]), v, int(k[1:]) in update) for k, v in values.items()]
    return spark.createDataFrame(data, T.StructType([*SCHEMA.fields, T.StructField("_update", T.BooleanType())]))


def content(df):
    found = [(r.k, r.v) for r in df.collect()]
    assert len(found) == len(dict(found))
    return dict(found)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def fill(spark, table):
    table.write(rows(spark, k1="a", k2="b"), 1)
    table.write(rows(spark, update=[2], k2="c"), 2)
    table.write(rows(spark, update=[2], k2="d", k3="e"), 3)


@pytest.mark.parametrize("bound", [0, 100])
def test_newest_image_wins(spark, table, bound):
    table.broadcast_rows = bound
    assert table.read().count() == 0 and table.is_empty()
    fill(spark, table)
    assert content(table.read()) == {1: "a", 2: "d", 3: "e"}
    assert sorted(r.k for r in table.keys().collect()) == [1, 2, 3]
    assert content(table.read(before=3)) == {1: "a", 2: "c"}
    assert [(s.rows, s.updates) for s in table.live()] == [(2, 0), (1, 1), (2, 1)]


def test_reading_with_few_updates_broadcasts_only_them(spark, table):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        fill(spark, table)
        assert "Exchange hashpartitioning" not in plan(table.read())
        table.broadcast_rows = 0
        assert "Exchange hashpartitioning" in plan(table.read())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_base_is_folded_once_updates_outgrow_their_bounds(spark, table):
    fill(spark, table)
    assert table.fold() is None
    table.broadcast_rows = 1
    assert table.fold() == Segment(0, 3)
    assert table.live() == [Segment(0, 3)] and content(table.read()) == {1: "a", 2: "d", 3: "e"}
    # A retry of load 3 still sees the state before it.
    assert content(table.read(before=3)) == {1: "a", 2: "c"}
    table.write(rows(spark, update=[1], k1="z"), 4)
    assert content(table.read()) == {1: "z", 2: "d", 3: "e"}


def test_prune_keeps_what_a_retry_needs(spark, table):
    table.broadcast_rows = 0
    table.write(rows(spark, k1="v1"), 1)
    for load in (2, 3):
        table.write(rows(spark, update=[1], k1=f"v{load}"), load)
        table.fold(share=0.0)
    table.prune()
    assert content(table.read()) == {1: "v3"} and content(table.read(before=3)) == {1: "v2"}
    assert Segment(1, 1) not in table.committed()


def test_small_insert_segments_are_combined(spark, table):
    for load in range(1, 6):
        table.write(rows(spark, **{f"k{load}": str(load)}), load)
        table.fold(count=3)
    assert Segment(1, 3) in table.live() and Segment(1, 1) not in table.live()
    assert content(table.read()) == {n: str(n) for n in range(1, 6)}
    assert content(table.read(before=3)) == {1: "1", 2: "2"}
    assert "Exchange" not in plan(table.read())


def test_unfinished_segment_is_invisible(spark, table):
    table.write(rows(spark, k1="a"), 1)
    table.write(rows(spark, k2="b"), 2)
    folders.delete(spark, f"{table.path}/{Segment(2, 2).name}/_rows-1-0")
    assert content(table.read()) == {1: "a"}
    table.write(rows(spark, k2="b"), 2)
    assert content(table.read()) == {1: "a", 2: "b"}


def test_reach_limits_what_is_read(spark, table):
    fill(spark, table)
    keys = spark.createDataFrame([(2,), (3,), (9,)], "k bigint")
    assert content(table.read(reach=Reach(2, 9, keys))) == {2: "d", 3: "e"}
    assert content(table.read(reach=Reach(1, 2))) == {1: "a", 2: "d"}
    assert content(table.read(reach=Reach(None, None))) == {}
    near = table.keys(reach=Reach(2, 9, keys))
    assert sorted(r.k for r in near.collect()) == [2, 3]
    assert "PushedFilters: [IsNotNull(k), GreaterThanOrEqual(k,2), LessThanOrEqual(k,9)" in plan(near) or (
        "GreaterThanOrEqual(k,2)" in plan(near)
    )


def test_stage_folder_follows_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert folders.stage_folder(spark, "/some/root").startswith(shared)


def test_replace_makes_the_rows_the_whole_table(spark, table):
    fill(spark, table)
    table.replace(table.read().withColumn("v", F.lit("n")).where("k > 1"), 4)
    assert content(table.read()) == {2: "n", 3: "n"}


def files_read(df) -> int:
    """Files the scans of a plan open, by Spark's own listing."""
    df.collect()
    leaves, found = df._jdf.queryExecution().executedPlan().collectLeaves(), 0
    for k in range(leaves.size()):
        leaf = leaves.apply(k)
        if leaf.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            leaf = leaf.executedPlan().collectLeaves().apply(0)
        if "FileSourceScan" in leaf.getClass().getSimpleName():
            found += leaf.metrics().apply("numFiles").value()
    return found


def test_a_small_batch_opens_only_the_buckets_of_its_keys(spark, table):
    for load in (1, 2):
        data = spark.range(load * 10_000, load * 10_000 + 5_000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
        table.write(data, load)
    whole = files_read(table.read())
    touched = spark.createDataFrame([(10_007,), (20_003,)], "k bigint")
    buckets = tuple(r[0] for r in touched.select(bucket_of(F.col("k"))).collect())
    near = table.read(reach=Reach(10_007, 20_003, touched, buckets))
    assert sorted(r.k for r in near.collect()) == [10_007, 20_003]
    assert whole >= 2 * table.buckets and files_read(near) <= 2 * len(buckets)


def test_segments_with_updates_are_combined_too(spark, table):
    table.write(rows(spark, k1="a", k2="b"), 1)
    for load in range(2, 8):
        table.write(rows(spark, update=[1], k1=f"v{load}", **{f"k{load + 10}": "new"}), load)
        table.fold(count=3)
        table.prune()
    live = table.live()
    assert len(live) <= 3 and live[0].low == 1
    assert content(table.read()) == {1: "v7", 2: "b"} | {n + 10: "new" for n in range(2, 8)}
    assert content(table.read(before=7)) == {1: "v6", 2: "b"} | {n + 10: "new" for n in range(2, 7)}
    for load in range(8, 30):
        table.write(rows(spark, update=[1], k1=f"v{load}"), load)
        table.fold(count=2)
    assert len(table.live()) <= 4 and content(table.read())[1] == "v29"


def test_one_bucket_keeps_rows_where_they_are(spark, tmp_path):
    """A log is not gathered in one task; writing a load again replaces its rows."""
    log = SegmentedTable(spark, str(tmp_path / "log"), SCHEMA, "k", buckets=1)
    for n in (500, 300):
        log.write(spark.range(n).select(F.col("id").alias("k"), F.lit("a").alias("v")).repartition(5), 1)
        assert len(list((tmp_path / "log" / "_segment=1-1" / "_bucket=0").glob("*.parquet"))) == 5
        assert log.read().count() == log.stored_rows() == n and len(log.committed()) == 1


def test_copied_segment_is_not_shuffled(spark, tmp_path, monkeypatch):
    table, copied = (SegmentedTable(spark, str(tmp_path / name), SCHEMA, "k") for name in ("table", "copied"))
    fill(spark, table)
    hinted = []
    hint = type(spark.range(1)).hint
    monkeypatch.setattr(type(spark.range(1)), "hint", lambda df, *a: hinted.append(a[0]) or hint(df, *a))
    for segment in table.live():
        copied.copy(table.scan([segment]), segment)
    assert not hinted and content(copied.read()) == content(table.read())
    assert content(copied.read(reach=Reach(2, 9))) == {2: "d", 3: "e"}
