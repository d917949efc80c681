import glob
import os
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import sensor_rows, utc
from voltlake import (
    as_of,
    export_batches,
    export_buckets,
    export_job,
    export_names,
    log_run,
    verify_export,
    write_parquet,
)
from voltlake.plans.runlog import run_log
from voltlake.schema import file_labels, file_schema

TOTAL = len(sensor_rows())
LATE = "2024-01-01 00:00:00"


def files_by_folder(path):
    found = {}
    for file in glob.glob(f"{path}/*=*/*.parquet"):
        found.setdefault(os.path.basename(os.path.dirname(file)), []).append(file)
    return found


def values(file, *names):
    table = pq.read_table(file, partitioning=None)
    return list(zip(*[table[n].to_pylist() for n in names]))


def verified(spark, result):
    return verify_export(spark, result.path, result.manifest, result.key)


def snapshot(spark, path, key):
    return sorted(map(str, spark.read.parquet(path).orderBy(key).collect()))


def test_batch_export_writes_one_ordered_file_per_batch(spark, sensor_table, folder):
    table = spark.read.parquet(sensor_table)
    result = export_batches(table, folder("out"), 10)
    found = files_by_folder(folder("out"))
    n_batches = -(-TOTAL // 10)
    assert sorted(found) == sorted(f"batch_id={k}" for k in range(1, n_batches + 1))
    assert all(len(files) == 1 for files in found.values())
    last = None
    for k in range(1, n_batches + 1):
        times = [v[0] for v in values(found[f"batch_id={k}"][0], "time_stamp")]
        assert len(times) == (10 if k < n_batches else TOTAL - 10 * (n_batches - 1))
        assert times == sorted(times) and (last is None or last <= times[0])
        last = times[-1]
    assert (result.n_rows, result.n_groups, result.n_files) == (TOTAL, n_batches, n_batches)
    back = spark.read.parquet(folder("out")).drop("batch_id")
    assert back.exceptAll(table).count() == 0 and table.exceptAll(back).count() == 0
    assert verified(spark, result).filter("not ok").count() == 0


def test_batch_larger_than_a_file_is_cut_in_order(spark, sensor_table, folder):
    table = spark.read.parquet(sensor_table)
    result = export_batches(table, folder("out"), 30, rows_per_file=8)
    assert verified(spark, result).filter("not ok").count() == 0
    for files in files_by_folder(folder("out")).values():
        ranges = sorted((min(t), max(t)) for t in ([v[0] for v in values(f, "time_stamp")] for f in files))
        assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    assert max(map(len, files_by_folder(folder("out")).values())) > 1


def test_repeating_a_batch_export_gives_the_same_batches(spark, sensor_table, folder):
    table = spark.read.parquet(sensor_table)
    export_batches(table, folder("a"), 7)
    export_batches(table.repartition(5), folder("b"), 7)
    assert snapshot(spark, folder("a"), "batch_id") == snapshot(spark, folder("b"), "batch_id")


@pytest.mark.parametrize("seconds", [7, 60])
def test_bucket_export_writes_one_file_in_measure_order(spark, sensor_table, folder, seconds):
    table = spark.read.parquet(sensor_table)
    result = export_buckets(table, folder("out"), seconds, at=LATE)
    found = files_by_folder(folder("out"))
    assert all(len(files) == 1 for files in found.values())
    assert len(found) == result.n_groups == result.manifest.count() == result.n_files
    labels = {f"bucket_label={r.bucket_label}" for r in result.manifest.collect()}
    assert labels == set(found)
    for files in found.values():
        rows = values(files[0], "bucket", "time_stamp", "bat1_temp")
        keys = [(temp is None, temp or 0, at) for _, at, temp in rows]
        assert keys == sorted(keys)
        assert len({bucket for bucket, _, _ in rows}) == 1
        assert all(b <= t < b + timedelta(seconds=seconds) for b, t, _ in rows)
    back = spark.read.parquet(folder("out"))
    assert back.columns == ["bucket", *table.columns, "bucket_label"]
    back = back.drop("bucket", "bucket_label")
    assert back.exceptAll(table).count() == 0 and table.exceptAll(back).count() == 0
    assert verified(spark, result).filter("not ok").count() == 0


def test_bucket_export_stops_at_the_cut_off(spark, sensor_table, folder):
    edge = utc("2023-04-26 21:43:37")
    result = export_buckets(spark.read.parquet(sensor_table), folder("out"), 5, at=edge)
    assert result.n_rows == sum(r[0] < edge for r in sensor_rows())
    assert result.as_of == "2023-04-26 21:43:37+00:00"


@pytest.mark.parametrize("copies", [0, 600])
def test_large_bucket_is_spread_over_sorted_files(spark, folder, copies):
    """One bucket, or many copies of one row in it, holds a third of all rows."""
    day = datetime(2024, 1, 1)
    hot = [(day, 1, 5.0)] * copies or [(day + timedelta(seconds=i), i, (i * 37 % 101) / 2.0) for i in range(600)]
    hot += [(day, 9_999, None)]
    cold = [(day + timedelta(days=1 + i % 24, seconds=i), i, i * 1.0) for i in range(1200)]
    schema = "ts timestamp_ntz, id int, value double"
    spark.createDataFrame(hot + cold, schema).repartition(3).write.parquet(folder("t"))
    table = spark.read.parquet(folder("t"))
    result = export_buckets(table, folder("out"), 86400, "ts", "value", "2025-01-01", rows_per_file=100)
    found = files_by_folder(folder("out"))
    hot_files = found.pop("bucket_label=2024-01-01_00-00-00")
    assert all(len(files) == 1 for files in found.values())
    assert len(hot_files) >= 5
    pieces = []
    for file in hot_files:
        keys = [(v is None, v or 0) for (v,) in values(file, "value")]
        assert keys == sorted(keys) and len(keys) <= 250
        pieces.append((keys[0], keys[-1]))
    pieces.sort()
    assert all(a[1] <= b[0] for a, b in zip(pieces, pieces[1:]))
    assert verified(spark, result).filter("not ok").count() == 0
    back = spark.read.parquet(folder("out")).select("ts", "id", "value")
    kept = as_of(table, "ts", "2025-01-01")
    assert back.exceptAll(kept).count() == 0 and kept.exceptAll(back).count() == 0


def test_empty_export_clears_old_files(spark, sensor_table, folder):
    table = spark.read.parquet(sensor_table)
    export_buckets(table, folder("out"), 60, at=LATE)
    result = export_buckets(table, folder("out"), 60, at="1900-01-01")
    assert (result.n_rows, result.n_groups, result.n_files) == (0, 0, 0)
    assert files_by_folder(folder("out")) == {}
    assert verified(spark, result).count() == 0
    empty = export_batches(table.filter("false"), folder("batches"), 10)
    assert empty.n_files == 0 and verified(spark, empty).count() == 0


def test_overwrite_removes_a_longer_earlier_run(spark, sensor_table, folder):
    table = spark.read.parquet(sensor_table)
    export_batches(table, folder("out"), 5)
    export_batches(table, folder("out"), 30)
    assert len(files_by_folder(folder("out"))) == -(-TOTAL // 30)
    with pytest.raises(Exception):
        export_batches(table, folder("out"), 30, mode="errorifexists")


def test_too_many_files_are_refused_before_any_write(spark, sensor_table, folder):
    table = spark.read.parquet(sensor_table)
    with pytest.raises(ValueError, match="max_files"):
        export_batches(table, folder("out"), 10, max_files=3)
    with pytest.raises(ValueError, match="max_files"):
        export_buckets(table, folder("out"), 1, at=LATE, max_files=3)
    with pytest.raises(ValueError, match="max_files"):
        export_buckets(table, folder("out"), 10**9, at=LATE, max_files=3, rows_per_file=4)
    assert not os.path.exists(folder("out"))


def test_an_input_is_never_overwritten(spark, sensor_table, folder):
    table = spark.read.parquet(sensor_table)
    table.write.parquet(folder("data/inner"))
    copy = spark.read.parquet(folder("data/inner"))
    for target in (folder("data/inner"), folder("data"), f"file://{folder('data/inner')}/"):
        for call in (
            lambda: export_batches(copy, target, 10),
            lambda: export_buckets(copy, target, 10, at=LATE),
            lambda: write_parquet(copy, target),
        ):
            with pytest.raises(ValueError, match="input"):
                call()
    assert copy.count() == TOTAL


@pytest.mark.parametrize("codec", ["snappy", "gzip", "uncompressed"])
def test_codec_of_the_files(spark, sensor_table, folder, codec):
    table = spark.read.parquet(sensor_table)
    export_buckets(table, folder("buckets"), 60, at=LATE, codec=codec)
    write_parquet(table, folder("plain"), codec)
    for file in glob.glob(f"{folder('buckets')}/b*/*.parquet") + glob.glob(f"{folder('plain')}/*.parquet"):
        column = pq.ParquetFile(file).metadata.row_group(0).column(0)
        assert column.compression.lower() == codec
    back = spark.read.parquet(folder("plain"))
    assert back.exceptAll(table).count() == 0 and back.count() == TOTAL


def test_verification_finds_differences(spark, sensor_table, folder):
    table = spark.read.parquet(sensor_table)
    result = export_batches(table, folder("out"), 10)
    plan = verified(spark, result)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and f"{folder('out')}]" not in plan, "footers are read by tasks, no scan of the data"
    missing = files_by_folder(folder("out"))["batch_id=2"][0]
    os.remove(missing)
    extra = table.limit(3).withColumn("batch_id", F.lit(99).cast("bigint"))
    extra.write.mode("append").partitionBy("batch_id").parquet(folder("out"))
    wrong = {r.batch_id: (r.expected, r.found) for r in verified(spark, result).filter("not ok").collect()}
    assert wrong == {2: (10, 0), 99: (0, 3)}


def test_exports_leave_no_intermediate_tables(spark, sensor_table, folder):
    from voltlake.workspace import shared_folder

    table = spark.read.parquet(sensor_table)
    before = set(os.listdir(shared_folder(spark))) if os.path.isdir(shared_folder(spark)) else set()
    export_batches(table, folder("a"), 10)
    export_buckets(table, folder("b"), 60, at=LATE, rows_per_file=4)
    after = set(os.listdir(shared_folder(spark)))
    assert {n for n in after - before if n.startswith("voltlake-")} == set()


def test_writer_adds_no_sort_of_its_own(spark, sensor_table):
    """Rows arrive sorted by the folder column, so the measure order inside files holds."""
    from voltlake.functions import bucket_label
    from voltlake.operators.buckets import bucket_sort_keys, with_bucket

    bucketed = with_bucket(spark.read.parquet(sensor_table), "time_stamp", 60)
    keys = bucket_sort_keys(bucketed, "bat1_temp", "time_stamp")
    rows = (
        bucketed.repartition("bucket")
        .withColumn("bucket_label", bucket_label(bucketed))
        .sortWithinPartitions("bucket_label", *keys[1:])
    )
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1


def test_jobs_by_count_and_by_bucket(spark, sensor_table, folder):
    log = folder("log")
    by_count = export_job(spark, sensor_table, folder("c"), "count", 10, log_path=log)
    by_bucket = export_job(spark, sensor_table, folder("b"), "bucket", 60, at=LATE, log_path=log)
    assert spark.read.parquet(folder("c")).columns == [*file_labels("count"), "batch_id"]
    assert spark.read.parquet(folder("b")).columns == [*file_labels("bucket"), "bucket_label"]
    rows = {r.run_type: r for r in run_log(spark, log).collect()}
    assert set(rows) == {"count   ", "bucket  "}
    assert rows["count   "].n_rows == by_count.n_rows == TOTAL
    assert rows["bucket  "].n_files == by_bucket.n_files
    first = min(r[0] for r in sensor_rows())
    assert all(r.data_start_timestamp == first.replace(tzinfo=None) for r in rows.values())
    assert all(r.elapsed_ms > 0 for r in rows.values())
    with pytest.raises(ValueError):
        export_job(spark, sensor_table, folder("x"), "other", 10)


def test_narrow_job_fails_on_a_large_value_and_types_the_rest(spark, sensor_table, folder):
    with pytest.raises(Exception, match="does not fit"):
        export_job(spark, sensor_table, folder("n"), "bucket", 60, at=LATE, narrow=True)
    small = spark.read.parquet(sensor_table).filter("bat1_temp < 100 or bat1_temp is null")
    small.write.parquet(folder("small"))
    for group in ("bucket", "count"):
        export_job(spark, folder("small"), folder(group), group, 60, at=LATE, narrow=True)
        written = spark.read.parquet(folder(group)).schema
        for field in file_schema(group, narrow=True):
            assert written[field.name].dataType == field.dataType


def test_narrow_job_can_set_rows_apart(spark, sensor_table, folder):
    result = export_job(
        spark, sensor_table, folder("out"), "bucket", 60, at=LATE,
        narrow=True, quarantine_path=folder("bad"),
    )
    bad = spark.read.parquet(folder("bad"))
    assert {str(r["bat 1 temp"]) for r in bad.collect()} == {"100.000", "999.999"}
    assert result.n_rows + bad.count() == TOTAL


def test_a_dynamic_overwrite_session_still_replaces_the_export(spark, sensor_table, folder):
    table = spark.read.parquet(sensor_table)
    export_batches(table, folder("out"), 5)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        result = export_batches(table, folder("out"), 30)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert len(files_by_folder(folder("out"))) == -(-TOTAL // 30) == result.manifest.count()


def test_run_log_rules(spark, sensor_table, folder):
    table = spark.read.parquet(sensor_table)
    result = export_buckets(table, folder("out"), 60, at="1900-01-01")
    assert log_run(spark, folder("log"), "bucket", result.manifest) is False
    for run_type in ("", "much too long"):
        with pytest.raises(ValueError):
            log_run(spark, folder("log"), run_type, result.manifest)


def test_labels_as_columns_can_be_exported(spark, sensor_table, folder):
    table = export_names(spark.read.parquet(sensor_table), "sheet")
    result = export_batches(table, folder("out"), 20, ("timestamp", " bat 1 voltage"))
    assert verified(spark, result).filter("not ok").count() == 0
