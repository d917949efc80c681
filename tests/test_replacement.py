"""Replacing datasets: refused moves and interruptions at each step leave complete data."""

import glob
import os
import re
import threading

import pytest
from pyspark.sql import functions as F, types as T

from voltlake import export_batches, export_buckets, readings, verify_export, write_parquet
from voltlake import storage


class Killed(BaseException):
    """Ends the process between two steps: nothing after it runs."""


def numbers(spark, n):
    return spark.range(n).select("id", F.timestamp_micros(F.col("id") * 1_000_000).alias("ts"))


def count(spark, path):
    return readings(spark, path).count()


def beside(path):
    return sorted(os.path.basename(p) for p in glob.glob(f"{os.path.dirname(path)}/_*"))


STEPS = ("rename", "remove_folder", "_write_text")


def calls(monkeypatch, fail_at, error):
    """Counts the steps of a replacement and fails at one of them, before or after it was done."""
    seen = []

    def guarded(name):
        done = getattr(storage, name)

        def step(*args):
            seen.append(name)
            fails = len(seen) == fail_at[0]
            if fails and not fail_at[1]:
                raise error
            result = done(*args)
            if fails:
                raise error
            return result

        monkeypatch.setattr(storage, name, step)

    for name in STEPS:
        guarded(name)
    return seen


@pytest.mark.parametrize("n_targets", [1, 2])
def test_killed_between_any_two_steps(spark, folder, monkeypatch, n_targets):
    """After the next look at the datasets all are the old ones or all the new ones, and nothing is left beside."""
    sizes = set()
    for step in range(1, 60):
        for after in (False, True):
            base = folder(f"step{step}{after}")
            targets = [f"{base}/t{k}" for k in range(n_targets)]
            for target in targets:
                storage.write_files(numbers(spark, 3).coalesce(1), target)
            with monkeypatch.context() as patched:
                calls(patched, (step, after), Killed())
                replacement = storage.Replacement.of(spark, targets)
                for swap in replacement.swaps:
                    storage.write_files(numbers(spark, 5).coalesce(1), swap.staged)
                try:
                    replacement.publish()
                    ended = True
                except Killed:
                    ended = False
            # A kill leaves at least one whole copy of the data at any time.
            found = {count(spark, target) for target in targets}
            assert found in ({3}, {5}), (step, after, found)
            sizes |= found
            # Only a note that was not finished, and copies that nothing names yet, may be left.
            assert not [x for x in beside(targets[0]) if x.endswith("note") or "aside" in x or re.search("journal-[^.]*$", x)]
        if ended:
            break
    assert sizes == {3, 5} and step > 6


@pytest.mark.parametrize("refused", [1, 2])
def test_a_refused_rename_leaves_the_old_dataset(spark, folder, monkeypatch, refused):
    path = folder("refused")
    write_parquet(numbers(spark, 3), path)
    moves = []
    done = storage.rename

    def rename(spark, source, target):
        if not target.endswith(("note", "journal")) and ".journal" not in target and ".note" not in target:
            moves.append(target)
            if len(moves) == refused:
                raise OSError("refused")
        done(spark, source, target)

    with monkeypatch.context() as patched:
        patched.setattr(storage, "rename", rename)
        with pytest.raises(OSError, match="refused"):
            write_parquet(numbers(spark, 5), path)
    assert spark.read.parquet(path).count() == 3
    assert beside(path) == []
    write_parquet(numbers(spark, 7), path)
    assert spark.read.parquet(path).count() == 7


def test_renames_that_stay_refused_keep_both_copies(spark, folder, monkeypatch):
    path = folder("stuck")
    write_parquet(numbers(spark, 3), path)
    done, moves = storage.rename, []

    def rename(spark, source, target):
        if ".note" not in target and ".journal" not in target:
            moves.append(target)
            if len(moves) > 1:
                raise OSError("refused")
        done(spark, source, target)

    with monkeypatch.context() as patched:
        patched.setattr(storage, "rename", rename)
        with pytest.raises(OSError):
            write_parquet(numbers(spark, 5), path)
    kept = {spark.read.parquet(p).count() for p in glob.glob(f"{os.path.dirname(path)}/_stuck.*") if os.path.isdir(p)}
    assert kept == {3, 5}
    assert count(spark, path) == 5, "the next reader finishes what was decided"


@pytest.mark.parametrize("kind", ["batches", "buckets"])
def test_an_export_that_fails_is_not_there(spark, folder, kind, monkeypatch):
    table, path = folder("table"), folder("out")
    storage.write_files(numbers(spark, 40), table)
    rows = spark.read.parquet(table)

    def export():
        return export_batches(rows, path, 10, ("ts",)) if kind == "batches" else export_buckets(rows, path, 10, "ts", "id")

    from voltlake.plans import exports

    with monkeypatch.context() as patched:
        patched.setattr(exports, "_with_files", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError, match="stopped"):
            export()
    assert not os.path.exists(path) and beside(path) == []
    result = export()
    assert (result.n_rows, result.n_groups, result.n_files) == (40, 4, 4)
    assert (result.ts_to - result.ts_from).seconds == 39
    assert result.manifest.agg(F.sum("n_files"), F.sum("n_rows")).first()[:] == (4, 40)


def test_changed_values_are_found(spark, folder):
    table, path = folder("table"), folder("out")
    storage.write_files(numbers(spark, 40).withColumn("empty", F.lit(None).cast("string")), table)
    result = export_buckets(spark.read.parquet(table), path, 10, "ts", "id", contents=True)
    assert verify_export(spark, path, result.manifest, result.key).filter("not ok").isEmpty()
    label = result.manifest.orderBy("bucket").first()["bucket_label"]
    part = spark.read.parquet(f"{path}/bucket_label={label}")
    storage.write_table(part.withColumn("id", F.when(F.col("id") == 1, 0).otherwise(F.col("id"))), f"{path}/bucket_label={label}", "overwrite")
    checked = verify_export(spark, path, result.manifest, result.key).collect()
    assert [(r.bucket_label, r.expected, r.found) for r in checked if not r.ok] == [(label, 10, 10)]


def test_ten_thousand_groups_are_counted_by_tasks(spark, folder):
    """Files are not listed by the driver: with one task per 500 folders, 20 tasks read the footers."""
    from voltlake.sources.footers import group_files, group_keys

    path = folder("many")
    template = folder("one")
    storage.write_files(numbers(spark, 1).coalesce(1), template)
    (file,) = glob.glob(f"{template}/*.parquet")
    for k in range(10_000):
        os.makedirs(f"{path}/batch_id={k}")
        os.link(file, f"{path}/batch_id={k}/part-0.parquet")
    keys = group_keys(spark, path, "batch_id", "long")
    found = group_files(path, spark.range(10_001).select(F.col("id").alias("batch_id")), "batch_id", 10_000, "ts")
    assert found.rdd.getNumPartitions() == 20
    assert keys.count() == 10_000
    assert found.agg(F.sum("found"), F.sum("n_files"), F.count_if(F.expr("ts_from = ts_to")), F.count_if(F.expr("found = 0"))).first()[:] == (
        10_000, 10_000, 10_000, 1)


CONTRACT = T.StructType([T.StructField("temp", T.DecimalType(5, 3))])


def test_quarantine_evaluates_its_input_once(spark, folder):
    """A random column may not send a row to both folders or to none."""
    rows = spark.range(2000).select("id", (F.rand() * 200).alias("temp"))
    write_parquet(rows, folder("good"), schema=CONTRACT, policy="quarantine", quarantine_path=folder("bad"))
    good, bad = (spark.read.parquet(folder(name)) for name in ("good", "bad"))
    assert sorted(r.id for r in good.select("id").union(bad.select("id")).collect()) == list(range(2000))
    assert good.schema["temp"].dataType == T.DecimalType(5, 3) and good.columns == ["id", "temp"]
    assert bad.filter("temp < 99 or rejected_columns[0] <> 'temp'").isEmpty() and bad.count() > 500


def test_quarantine_of_no_rows_and_modes(spark, folder):
    def write(rows, mode="overwrite"):
        write_parquet(rows, folder("good"), mode=mode, schema=CONTRACT, policy="quarantine", quarantine_path=folder("bad"))
        return tuple(spark.read.parquet(folder(name)).count() for name in ("good", "bad"))

    frame = spark.range(10).select("id", F.col("id").cast("double").alias("temp"))
    assert write(frame) == (10, 0)
    assert write(frame.withColumn("temp", F.lit(500.0))) == (0, 10)
    assert write(frame, "append") == (10, 10)
    with pytest.raises(FileExistsError):
        write(frame, "errorifexists")
    assert write(frame.limit(0)) == (0, 0)


def test_two_exports_in_threads_write_microseconds(spark, folder):
    import pyarrow.parquet as pq

    before = spark.conf.get("spark.sql.parquet.outputTimestampType")
    failed = []

    def write(k):
        try:
            for _ in range(3):
                write_parquet(numbers(spark, 50), folder(f"thread{k}"))
                assert spark.conf.get("spark.sql.parquet.outputTimestampType") == before
        except BaseException as error:  # the main thread reports it
            failed.append(error)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(4)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert not failed and before == "INT96"
    for k in range(4):
        for file in glob.glob(folder(f"thread{k}") + "/*.parquet"):
            assert pq.ParquetFile(file).schema.column(1).physical_type == "INT64"
