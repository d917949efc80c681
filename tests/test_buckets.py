from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from conftest import sensor_rows, utc
from voltlake.operators import ranking
from voltlake import (
    as_of,
    bucket_label,
    bucket_manifest,
    order_in_bucket,
    position_in_bucket,
    time_bucket,
    with_bucket,
)

ORIGIN = datetime(2000, 1, 3)


def expected_bucket(at: datetime, seconds: int) -> datetime:
    return ORIGIN + (at - ORIGIN) // timedelta(seconds=seconds) * timedelta(seconds=seconds)


def ntz(spark, *texts):
    rows = [(t,) for t in texts]
    return spark.createDataFrame(rows, "t string").select(F.col("t").cast("timestamp_ntz").alias("ts"))


@pytest.mark.parametrize("seconds", [1, 5, 7, 420, 86400, 259200])
def test_bucket_is_aligned_and_holds_the_row(spark, seconds):
    frame = ntz(
        spark,
        "2024-01-01 00:00:07.123456",
        "1999-12-31 23:59:59.5",
        "1969-12-31 23:59:58",
        "1969-12-31 23:59:59.999999",
        "2000-01-03 00:00:00",
    )
    for ts, bucket in frame.select("ts", time_bucket("ts", seconds).alias("bucket")).collect():
        assert bucket == expected_bucket(ts, seconds)
        assert bucket <= ts < bucket + timedelta(seconds=seconds)


def test_known_bucket_before_the_origin(spark):
    frame = ntz(spark, "1999-12-31 23:59:59.5")
    assert frame.select(time_bucket("ts", 7)).first()[0] == datetime(1999, 12, 31, 23, 59, 58)


def test_row_on_the_edge_starts_its_bucket(spark):
    frame = ntz(spark, "2000-01-03 00:07:00", "2000-01-03 00:06:59.999999")
    buckets = [r[0] for r in frame.select(time_bucket("ts", 420)).collect()]
    assert buckets == [datetime(2000, 1, 3, 0, 7), ORIGIN]


@pytest.mark.parametrize("seconds", [0, -5, 1.5, "5", True])
def test_bucket_width_must_be_whole_seconds(seconds):
    with pytest.raises(ValueError):
        time_bucket("ts", seconds)


def test_zoneless_bucket_ignores_the_session_zone(chicago):
    frame = ntz(chicago, "2024-03-10 02:30:07")
    row = frame.select(time_bucket("ts", 420).alias("bucket")).select(
        F.col("bucket").cast("string")
    )
    assert row.first()[0] == str(expected_bucket(datetime(2024, 3, 10, 2, 30, 7), 420))


def test_labels_of_a_repeated_hour_differ(chicago):
    instants = chicago.createDataFrame(
        [("2023-11-05T06:30:00Z",), ("2023-11-05T07:30:00Z",)], "t string"
    ).select(F.col("t").cast("timestamp").alias("ts"))
    bucketed = with_bucket(instants, "ts", 5)
    labels = [r[0] for r in bucketed.select(bucket_label(bucketed)).collect()]
    assert labels == ["2023-11-05_06-30-00", "2023-11-05_07-30-00"]
    assert bucketed.select("bucket").distinct().count() == 2


def test_bucket_column_comes_first(spark, sensor_table):
    table = spark.read.parquet(sensor_table)
    bucketed = with_bucket(table, "time_stamp", 5)
    assert bucketed.columns == ["bucket", *table.columns]


def test_as_of_is_strict_and_reaches_the_scan(spark, sensor_table):
    table = spark.read.parquet(sensor_table)
    edge = utc("2023-04-26 21:43:37")
    kept = as_of(table, "time_stamp", edge)
    assert kept.count() == sum(r[0] < edge for r in sensor_rows())
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(time_stamp" in plan


def test_as_of_defaults_to_now(spark):
    soon = datetime.now(timezone.utc) + timedelta(hours=2)
    past = datetime.now(timezone.utc) - timedelta(hours=2)
    instants = spark.createDataFrame([(soon,), (past,)], "ts timestamp")
    assert as_of(instants, "ts").count() == 1
    walls = spark.createDataFrame(
        [(soon.replace(tzinfo=None),), (past.replace(tzinfo=None),)], "ts timestamp_ntz"
    )
    assert as_of(walls, "ts").count() == 1


def test_zoneless_as_of_uses_the_session_wall_clock(chicago):
    walls = ntz(chicago, "2024-01-15 11:59:59", "2024-01-15 12:00:00")
    assert as_of(walls, "ts", utc("2024-01-15 18:00:00")).count() == 1


def test_order_in_bucket_puts_null_measures_last(spark, sensor_table):
    bucketed = with_bucket(spark.read.parquet(sensor_table), "time_stamp", 7).coalesce(1)
    rows = order_in_bucket(bucketed).select("bucket", "bat1_temp").collect()
    keys = [(r.bucket, r.bat1_temp is None, r.bat1_temp or 0) for r in rows]
    assert keys == sorted(keys)
    assert any(r.bat1_temp is None for r in rows)


@pytest.mark.parametrize("max_rows", [5_000_000, 4, 1])
def test_position_in_bucket(spark, sensor_table, max_rows):
    bucketed = with_bucket(spark.read.parquet(sensor_table), "time_stamp", 60)
    placed = position_in_bucket(bucketed, ["bat1_temp", "time_stamp"], max_rows=max_rows)
    by_bucket = {}
    for row in placed.collect():
        key = (row.bat1_temp is None, row.bat1_temp or 0, row.time_stamp)
        by_bucket.setdefault(row.bucket, []).append((row.pos, key))
    assert sum(map(len, by_bucket.values())) == len(sensor_rows())
    for entries in by_bucket.values():
        entries.sort()
        assert [pos for pos, _ in entries] == list(range(1, len(entries) + 1))
        keys = [key for _, key in entries]
        assert keys == sorted(keys)


@pytest.mark.parametrize("seconds", [7, 420, 86400, 604800])
def test_manifest_numbers_buckets_in_time_order(spark, sensor_table, seconds):
    table = spark.read.parquet(sensor_table)
    rows = bucket_manifest(table, "time_stamp", seconds).orderBy("bucket").collect()
    assert [r.bucket_no for r in rows] == list(range(1, len(rows) + 1))
    assert sum(r.n_rows for r in rows) == len(sensor_rows())
    assert all(r.bucket <= r.ts_from <= r.ts_to for r in rows)
    buckets = {expected_bucket(r[0].replace(tzinfo=None), seconds) for r in sensor_rows()}
    assert [r.bucket for r in rows] == sorted(buckets)


def test_manifest_of_nothing(spark, sensor_table):
    empty = spark.read.parquet(sensor_table).filter("false")
    assert bucket_manifest(empty, "time_stamp", 5).count() == 0


@pytest.mark.parametrize("seconds", [7, 420])
def test_manifest_of_many_buckets_is_numbered_by_day(spark, sensor_table, monkeypatch, seconds):
    """Beyond the size of one task only day totals meet in a single partition."""
    table = spark.read.parquet(sensor_table)
    expected = bucket_manifest(table, "time_stamp", seconds).collect()
    monkeypatch.setattr(ranking, "MAX_TASK_ROWS", 3)
    manifest = bucket_manifest(table, "time_stamp", seconds)
    plan = manifest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") == 1
    below = plan[plan.index("SinglePartition"):].split("\n", 2)[1]
    assert "HashAggregate(keys=[_vl_day" in below
    assert sorted(manifest.collect()) == sorted(expected)


def test_manifest_scans_the_rows_once(spark, sensor_table):
    manifest = bucket_manifest(spark.read.parquet(sensor_table), "time_stamp", 86400)
    plan = manifest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "ReadSchema: struct<time_stamp:timestamp>" in plan
