"""What a job refuses, what it keeps when it fails, and how it sizes its shuffles."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from voltlake import (
    as_of,
    bucket_manifest,
    export_batches,
    export_buckets,
    export_job,
    order_in_bucket,
    readings,
    time_bucket,
    with_batch_id,
    with_bucket,
    with_rank,
    write_parquet,
)
from voltlake.operators import ranking
from voltlake.plans import exports


def series(spark, n, seconds=5):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    ts = F.timestamp_add("SECOND", (F.col("id") * seconds).cast("int"), start)
    return spark.range(n).select(F.col("id").alias("event_id"), ts.alias("ts"), (F.col("id") % 7).alias("value"))


@pytest.fixture
def events(spark, folder):
    series(spark, 200).repartition(3).write.parquet(folder("events"))
    return spark.read.parquet(folder("events"))


def test_targets_around_the_input_are_refused(spark, sensor_table, folder, tmp_path):
    before = readings(spark, sensor_table).count()
    parent = sensor_table.rsplit("/", 1)[0]
    for out in (sensor_table, f"{sensor_table}/out", f"file:{sensor_table}/out/deep", parent):
        with pytest.raises(ValueError, match="input of the same job"):
            export_job(spark, sensor_table, out, "count", 10)
    for name in ("quarantine_path", "log_path"):
        with pytest.raises(ValueError, match="input of the same job"):
            export_job(spark, sensor_table, folder("out"), "count", 10, **{name: f"{sensor_table}/{name}"})
    with pytest.raises(ValueError, match="input of the same job"):
        write_parquet(readings(spark, sensor_table), f"{sensor_table}/copy")
    assert readings(spark, sensor_table).count() == before
    # A folder whose name only begins like the input's is another folder.
    write_parquet(readings(spark, sensor_table), f"{sensor_table}-copy")


def test_failed_overwrite_leaves_the_old_dataset(spark, events, folder):
    write_parquet(events, folder("out"))
    broken = events.withColumn("value", F.when(F.col("event_id") > 150, F.raise_error(F.lit("no"))).otherwise(1))
    with pytest.raises(Exception, match="no"):
        write_parquet(broken, folder("out"))
    assert spark.read.parquet(folder("out")).count() == 200
    write_parquet(events.limit(5), folder("out"))
    assert spark.read.parquet(folder("out")).count() == 5


def test_many_small_files_by_default(events, folder):
    result = export_batches(events, folder("out"), 1, ("ts", "event_id"))
    assert (result.n_groups, result.n_files) == (200, 200)
    with pytest.raises(ValueError, match="max_files"):
        export_buckets(events, folder("other"), 5, "ts", "value", max_files=199)


def test_null_times_keep_their_rows_or_fail(spark, events, folder):
    gaps = events.withColumn("ts", F.when(F.col("event_id") % 4 != 0, F.col("ts")))
    assert gaps.select(time_bucket("ts", 60)).count() == 200
    assert with_bucket(gaps, "ts", 60).filter("bucket is null").count() == 50
    manifest = bucket_manifest(gaps, "ts", 60).orderBy("bucket_no").collect()
    assert sum(r["n_rows"] for r in manifest) == 200
    assert manifest[-1]["bucket"] is None and [r["bucket_no"] for r in manifest] == list(range(1, 19))
    instants = gaps.select(F.col("ts").cast("timestamp").alias("ts"))
    assert instants.select(time_bucket("ts", 60).alias("b")).schema["b"].dataType.simpleString() == "timestamp"
    for export in (lambda: export_buckets(gaps, folder("a"), 60, "ts", "value"), lambda: export_batches(gaps, folder("b"), 10, ("ts",))):
        with pytest.raises(Exception, match="null in"):
            export()


def test_null_bucket_with_totals_by_day(spark, monkeypatch):
    monkeypatch.setattr(ranking, "MAX_TASK_ROWS", 3)
    frame = series(spark, 40, 40_000).withColumn("ts", F.when(F.col("event_id") > 1, F.col("ts")))
    rows = bucket_manifest(frame, "ts", 3600).orderBy("bucket_no").collect()
    assert [r["bucket_no"] for r in rows] == list(range(1, 40)) and rows[-1]["bucket"] is None


def test_reserved_names_are_refused(events, folder):
    with pytest.raises(ValueError, match="reserved"):
        with_bucket(events.withColumn("Bucket", F.lit(1)), "ts", 60)
    with pytest.raises(ValueError, match="reserved"):
        export_batches(events.withColumn("batch_id", F.lit(1)), folder("out"), 5, ("ts",))
    with pytest.raises(ValueError, match="reserved"):
        export_buckets(events.withColumn("bucket_label", F.lit(1)), folder("out"), 5, "ts", "value")


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_text_and_datetime_cut_alike(spark, events, ansi, kind):
    frame = events.select(F.col("ts").cast(kind).alias("ts"))
    at = datetime(2024, 1, 1, 5, 10, tzinfo=timezone(timedelta(hours=5)))
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        counts = {as_of(frame, "ts", x).count() for x in (at, at.isoformat(), "2024-01-01 00:10:00")}
        assert counts == {120}
        with pytest.raises(ValueError):
            as_of(frame, "ts", "next week")
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_ranks_of_frames_that_are_not_stored(spark, events):
    for frame, n in (
        (events.limit(50), 50),
        (events.withColumn("x", F.rand()), 200),
        (series(spark, 30), 30),
        (events.unionByName(events), 400),
    ):
        ranked = with_rank(frame, ["ts", "event_id"], max_rows=7)
        assert sorted(r["rank"] for r in ranked.collect()) == list(range(1, n + 1))


def test_order_in_bucket_is_total(events):
    rows = order_in_bucket(with_bucket(events, "ts", 100), "value", "ts").collect()
    placed = [(r["bucket"], r["value"], r["ts"]) for r in rows]
    assert len(placed) == 200 and placed == sorted(placed)


def test_shuffles_are_sized_from_the_count(spark, events, folder, monkeypatch):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        plan = ranking.sized_partitions(events, 200, 9, F.col("ts"))._jdf.queryExecution().toString()
        assert "hashpartitioning(ts" in plan and ", 23)" in plan.replace("#", "").replace("L", "")
        assert ranking.sized_partitions(events, 200, 100, F.col("ts")).rdd.getNumPartitions() <= 2
        seen = []
        sized = ranking.sized_partitions

        def spy(df, n_rows, max_rows, *keys):
            out = sized(df, n_rows, max_rows, *keys)
            seen.append((n_rows, max_rows))
            return out

        monkeypatch.setattr(ranking, "sized_partitions", spy)
        monkeypatch.setattr(exports, "sized_partitions", spy)
        with_rank(events, ["ts"], max_rows=50).count()
        export_batches(events, folder("a"), 40, ("ts",))
        export_buckets(events, folder("b"), 100, "ts", "value")
        # A table that fits one task is ranked by a window, so only the exports' own shuffles are sized.
        assert seen[0] == (200, 50) and [n for n, _ in seen[1:]] == [200, 200]
        del seen[:]
        with_batch_id(events, ["ts"], 50, max_rows=50).count()
        # Of larger tables only the rows of cells that a batch border crosses are ranked.
        assert seen == [(36, 50)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
