"""Streams into bucketed tables: restarts, replays, open windows, null keys."""

import os
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from hirelake.sources.buckets import BucketTable
from hirelake.sources.schemas import SCHEMAS
from hirelake.streaming import incremental

AT = datetime(2024, 3, 1, 12)


def _run(writer, check):
    writer.option("checkpointLocation", str(check)).trigger(availableNow=True).start().awaitTermination()


def _written(path):
    """When each bucket's files were written."""
    return {
        name: max(os.stat(os.path.join(folder, f)).st_mtime_ns for f in files if f.endswith(".parquet"))
        for folder, _, files in os.walk(path)
        if (name := os.path.basename(folder)).startswith("_bucket=")
    }


def test_first_rows_without_state(spark, tmp_path):
    schema = "seq int, k string"
    spark.createDataFrame([], schema).write.json(str(tmp_path / "in" / "none"))

    def batch(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.json(str(tmp_path / "in" / name))
        rows = spark.readStream.schema(schema).json(str(tmp_path / "in" / "*"))
        _run(incremental.first_rows_stream(rows, table, ["seq"]), tmp_path / "check")

    table = BucketTable(spark, str(tmp_path / "t"), spark.createDataFrame([], schema).schema, ["k"], buckets=16)
    batch("a", [(i, f"k{i % 40}") for i in range(400, 0, -1)] + [(900, None), (901, None)])
    before = _written(tmp_path / "t")
    batch("b", [(0, "k1"), (950, None), (1000, "new"), (1001, "new")])
    after = _written(tmp_path / "t")
    # The least of the first batch stays, also where a later batch has a smaller one.
    want = {f"k{i % 40}": i for i in range(40, 0, -1)} | {None: 900, "new": 1000}
    assert {r.k: r.seq for r in table.read().collect()} == want and table.read().count() == 42
    assert 1 <= sum(before.get(b) != t for b, t in after.items()) <= 3 < len(after)
    # A stream keeps no state of its own.
    assert not os.path.exists(tmp_path / "check" / "state")
    # Replayed from the start with a new checkpoint folder, nothing changes.
    again = spark.readStream.schema(schema).json(str(tmp_path / "in" / "b"))
    _run(incremental.first_rows_stream(again, table, ["seq"]), tmp_path / "check-2")
    assert {r.k: r.seq for r in table.read().collect()} == want


def test_open_windows_are_there(spark, tmp_path):
    schema = "ts timestamp, source_site string"

    def run(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.json(str(tmp_path / "in" / name))
        counts = incremental.daily_counts(spark.readStream.schema(schema).json(str(tmp_path / "in" / "*")))
        table = BucketTable(spark, str(tmp_path / "t"), counts.schema, ["day", "source_site"], buckets=8)
        _run(incremental.totals_stream(counts, table), tmp_path / "check")
        return {(r.date, r.source_site): r["count"] for r in table.read().withColumn("date", F.to_date("day").cast("string")).collect()}

    assert run("a", [(AT, "a"), (AT, "a"), (AT, None)]) == {("2024-03-01", "a"): 2, ("2024-03-01", None): 1}
    later = [(AT + timedelta(hours=3), "a"), (AT + timedelta(days=9), "b")]
    assert run("b", later) == {("2024-03-01", "a"): 3, ("2024-03-01", None): 1, ("2024-03-10", "b"): 1}
    # Behind the watermark: too late to count, but what was counted stays.
    assert run("c", [(AT, "a"), (AT + timedelta(days=9), None)])[("2024-03-01", "a")] == 3


def test_tracking_in_buckets(spark, tmp_path):
    schema = "seq int, job_url string, source_site string, session string, day date"
    table = BucketTable(spark, str(tmp_path / "t"), SCHEMAS["job_tracking"], ["job_url"], buckets=4)
    day = date(2024, 3, 1)
    for name, rows in (
        ("a", [(1, "u1", "jobinja", "s1", day), (2, None, "jobinja", "s1", day)]),
        ("b", [(3, "u1", "jobinja", "s2", day + timedelta(1)), (4, "u2", "jobinja", "s2", day)]),
    ):
        spark.createDataFrame(rows, schema).coalesce(1).write.json(str(tmp_path / "in" / name))
        found = spark.readStream.schema(schema).json(str(tmp_path / "in" / "*"))
        _run(incremental.track_buckets(found, table, ["seq"]), tmp_path / "check")
        batch = spark.createDataFrame(rows, schema).where("job_url is not null")
        # As after a crash between merge and commit.
        table.merge(batch, lambda old, new: incremental.track_urls(old, new, ["seq"], small_batch=True))
    got = {r.job_url: (r.first_seen_session, r.last_seen_session, r.is_active) for r in table.read().collect()}
    assert got == {"u1": ("s1", "s2", True), "u2": ("s2", "s2", True)}
