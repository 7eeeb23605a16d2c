"""Sinks under replay, and their counts."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from wattledger.streaming import sinks as S


@pytest.fixture
def feed(spark, tmp_path):
    """A folder stream of three files of ten rows each, one file per batch."""
    for i in range(3):
        spark.range(i * 10, i * 10 + 10).coalesce(1).write.mode("append").parquet(f"{tmp_path}/feed")
    return (
        spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/feed")
    )


def ids(spark, path):
    return sorted(r.id for r in spark.read.parquet(path).collect())


def test_counts_per_batch(spark, feed, tmp_path):
    written = S.write_each_batch(feed, f"{tmp_path}/out", f"{tmp_path}/cp")
    assert written == {0: 10, 1: 10, 2: 10}
    assert ids(spark, f"{tmp_path}/out") == list(range(30))


def test_empty_batch_counts_zero(spark, feed, tmp_path):
    written = S.write_each_batch(
        feed, f"{tmp_path}/out", f"{tmp_path}/cp", lambda batch: batch.where("id < 10")
    )
    assert sum(written.values()) == 10 and set(written) == {0, 1, 2}
    assert ids(spark, f"{tmp_path}/out") == list(range(10))


def test_batch_known_to_be_empty_counts_zero(spark, feed, tmp_path):
    written = S.write_each_batch(
        feed, f"{tmp_path}/out", f"{tmp_path}/cp", lambda batch: batch.where(F.lit(False))
    )
    assert written == {0: 0, 1: 0, 2: 0}


@pytest.mark.parametrize("stop_at", [0, 1, 2])
@pytest.mark.parametrize("named", [False, True])
def test_replayed_batch_replaces_itself(spark, feed, tmp_path, stop_at, named):
    stopped = []
    target = f"sinks.out_{stop_at}" if named else f"{tmp_path}/out"

    def write(batch, batch_id):
        S.write_batch(batch, batch_id, target)
        if batch_id == stop_at and not stopped:
            stopped.append(batch_id)
            raise RuntimeError("stopped")

    with pytest.raises(StreamingQueryException):
        S.run_to_end(feed.writeStream.foreachBatch(write), f"{tmp_path}/cp")
    S.run_to_end(feed.writeStream.foreachBatch(write), f"{tmp_path}/cp")
    assert stopped == [stop_at]
    stored = S.read_batches(spark, target).groupBy("batch_id").count().collect()
    assert {r.batch_id: r["count"] for r in stored} == {0: 10, 1: 10, 2: 10}
    assert sorted(r.id for r in S.read_batches(spark, target).collect()) == list(range(30))


def test_table_to_table_is_incremental(spark, feed, tmp_path):
    S.run_to_table(feed, "first_table", f"{tmp_path}/cp1", path=f"{tmp_path}/t")
    read = spark.readStream.table("first_table")
    assert sum(S.write_each_batch(read, f"{tmp_path}/out", f"{tmp_path}/cp2").values()) == 30
    spark.range(30, 35).write.mode("append").parquet(f"{tmp_path}/feed")
    S.run_to_table(feed, "first_table", f"{tmp_path}/cp1", path=f"{tmp_path}/t")
    assert sum(S.write_each_batch(read, f"{tmp_path}/out", f"{tmp_path}/cp2").values()) == 5
    assert ids(spark, f"{tmp_path}/out") == list(range(35))


def test_rewrite_touches_only_its_batches(spark, feed, tmp_path):
    out = f"{tmp_path}/out"
    S.write_each_batch(feed, out, f"{tmp_path}/cp")
    S.rewrite_batches(spark.range(100, 102).withColumn("batch_id", F.lit(1).cast("bigint")), out)
    stored = S.read_batches(spark, out).groupBy("batch_id").count()
    assert {r.batch_id: r["count"] for r in stored.collect()} == {0: 10, 1: 2, 2: 10}


@pytest.mark.parametrize("named", [False, True])
def test_batch_that_runs_again_without_rows_leaves_none(spark, tmp_path, named):
    target = "sinks.emptied" if named else f"{tmp_path}/out"
    rows = spark.range(10)
    assert [S.write_batch(rows, k, target) for k in (0, 1)] == [10, 10]
    assert S.write_batch(rows.where("id < 0"), 0, target) == 0
    stored = S.read_batches(spark, target).groupBy("batch_id").count().collect()
    assert {r.batch_id: r["count"] for r in stored} == {1: 10}
    assert S.write_batch(rows, 0, target) == 10
    assert S.read_batches(spark, target).count() == 20


@pytest.mark.parametrize("made_here", [False, True])
def test_batches_of_a_table_are_replaced_one_by_one(spark, monkeypatch, made_here):
    """A table made by the sink says so itself: the session's option isn't touched, which other
    streams may be using."""
    setting, table = "spark.sql.sources.partitionOverwriteMode", f"sinks.option_{made_here}"
    S.ensure_schema(spark, table)
    if not made_here:
        empty = spark.range(0).withColumn("batch_id", F.lit(0).cast("bigint"))
        empty.write.partitionBy("batch_id").saveAsTable(table)
    before, changed = spark.conf.get(setting), []
    put = type(spark.conf).set
    monkeypatch.setattr(
        type(spark.conf), "set", lambda conf, key, value: changed.append(key) or put(conf, key, value)
    )
    for batch, count in ((0, 3), (1, 4), (0, 5)):
        S.write_batch(spark.range(count), batch, table)
    assert S.read_batches(spark, table).count() == 9
    assert spark.conf.get(setting) == before and bool(changed) != made_here
