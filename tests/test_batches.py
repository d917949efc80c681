from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import sensor_rows
from voltlake import batch_manifest, batch_summary, with_batch_id, with_rank
from voltlake.operators import ranking
from voltlake.workspace import Workspace

START = datetime(2024, 3, 10, 1, 59, 50)


def table(spark, path, rows, schema="ts timestamp_ntz, id int, note string"):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def steps(n):
    return [(START + timedelta(milliseconds=700 * i), i, "x") for i in range(n)]


def sizes(df):
    return [r.n for r in df.groupBy("batch_id").agg(F.count("*").alias("n")).orderBy("batch_id").collect()]


@pytest.mark.parametrize("rows, expected", [(23, [10, 10, 3]), (20, [10, 10]), (0, [])])
def test_batch_sizes(spark, folder, rows, expected):
    frame = table(spark, folder("t"), steps(rows))
    assert sizes(with_batch_id(frame, ["ts"], 10)) == expected
    manifest = batch_manifest(frame, 10, "ts").orderBy("batch_id").collect()
    assert [r.n_rows for r in manifest] == expected
    summary = batch_summary(frame, 10).first()
    assert tuple(summary) == (rows, rows // 10, rows % 10)


@pytest.mark.parametrize("n", [0, -1, 2.5, True])
def test_batch_size_must_be_positive(spark, folder, n):
    frame = table(spark, folder("t"), steps(1))
    for call in (
        lambda: with_batch_id(frame, ["ts"], n),
        lambda: batch_summary(frame, n),
        lambda: batch_manifest(frame, n, "ts"),
    ):
        with pytest.raises(ValueError):
            call()


def test_null_time_fails(spark, folder):
    frame = table(spark, folder("t"), [(None, 1, "x"), *steps(3)])
    with pytest.raises(Exception, match="null in required column ts"):
        with_batch_id(frame, ["ts"], 2).collect()


@pytest.mark.parametrize("max_rows", [5_000_000, 50, 42, 10, 3, 1])
def test_rank_equals_brute_force(spark, folder, max_rows):
    """Every cell width, and from some size down the range sort of large seconds."""
    rows = [(START + timedelta(seconds=i * i % 97, hours=i % 3), i, None) for i in range(60)]
    rows += [(START, 1000 + i, "same instant") for i in range(40)]
    rows += [(START - timedelta(days=20_000), -i, "early") for i in range(4)]
    frame = table(spark, folder("t"), rows)
    ranked = with_rank(frame, ["ts", "id"], max_rows=max_rows)
    got = sorted((r["rank"], r.ts, r.id, r.note) for r in ranked.collect())
    expected = [(i + 1, *r) for i, r in enumerate(sorted(rows, key=lambda r: r[:2]))]
    assert got == expected


def test_cells_too_many_for_one_task(spark, folder, monkeypatch):
    rows = [(START + timedelta(minutes=i * i % 9973), i, "x") for i in range(300)]
    frame = table(spark, folder("t"), rows)
    monkeypatch.setattr(ranking, "MAX_TASK_ROWS", 20)
    ranked = with_rank(frame, ["ts", "id"], max_rows=10).orderBy("rank").collect()
    assert [r.id for r in ranked] == [i for _, i, _ in sorted(rows)]


@pytest.mark.parametrize("max_rows", [5_000_000, 7])
def test_rank_does_not_depend_on_the_session_zone(chicago, folder, max_rows):
    frame = table(chicago, folder("t"), steps(60))
    ranked = with_rank(frame, ["ts"], max_rows=max_rows)
    assert [r.id for r in ranked.orderBy("rank").collect()] == list(range(60))


@pytest.mark.parametrize("from_files", [True, False])
def test_copies_of_one_row_are_spread_and_kept(spark, folder, from_files):
    """A third of the rows are copies of one row; no task gets them all."""
    copies = [(START, 7, "copy")] * 400
    rows = copies + steps(800)
    frame = table(spark, folder("t"), rows)
    if not from_files:
        frame = frame.distinct().withColumn(
            "k", F.explode(F.when(F.col("note") == "copy", F.array_repeat(F.lit(0), 400))
                           .otherwise(F.array(F.lit(0))))
        ).drop("k")
    workspace = Workspace(spark)
    ranked = with_rank(frame, ["ts", "id"], max_rows=50, workspace=workspace)
    got = ranked.select("rank", "id", "note").collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 1201))
    at_start = sorted(r["rank"] for r in got if r.note == "copy")
    assert at_start == list(range(at_start[0], at_start[0] + 400))

    saved = [f for f in ranked.inputFiles() if "sorted-groups" in f]
    per_file = spark.read.parquet(*saved).groupBy("_metadata.file_path").count()
    assert per_file.agg(F.max("count")).first()[0] <= 150


def test_ties_are_cut_the_same_way_each_time(spark, folder):
    rows = [(START, i, "tie") for i in range(30)]
    first = table(spark, folder("a"), rows)
    second = table(spark, folder("b"), rows[::-1])
    batches = [
        sorted(tuple(r) for r in with_batch_id(f, ["ts"], 7, max_rows=m).collect())
        for f in (first, second)
        for m in (5_000_000, 5)
    ]
    assert all(b == batches[0] for b in batches)


def test_null_position_matters_for_ties(spark, folder):
    rows = [(START, 1, None, 2), (START, 1, 2, None)] * 5
    schema = "ts timestamp_ntz, id int, a int, b int"
    frame = table(spark, folder("t"), rows, schema)
    batches = with_batch_id(frame, ["ts"], 5)
    assert batches.groupBy("batch_id").agg(F.count_distinct("a")).count() == 2
    assert {r.batch_id for r in batches.filter("a is null").collect()} in ({1}, {2})


@pytest.mark.parametrize("max_rows", [5_000_000, 2])
def test_sensor_batches_follow_each_other(spark, sensor_table, max_rows):
    frame = spark.read.parquet(sensor_table)
    batched = with_batch_id(frame, ["time_stamp"], 10, max_rows=max_rows)
    by_batch = {}
    for row in batched.collect():
        by_batch.setdefault(row.batch_id, []).append(row)
    total = len(sensor_rows())
    assert [len(by_batch[k]) for k in sorted(by_batch)] == [10] * (total // 10) + (
        [total % 10] if total % 10 else []
    )
    for k in range(1, len(by_batch)):
        assert max(r.time_stamp for r in by_batch[k]) <= min(r.time_stamp for r in by_batch[k + 1])
    columns = frame.columns
    assert sorted(map(str, (tuple(r[c] for c in columns) for b in by_batch.values() for r in b))) == (
        sorted(map(str, map(tuple, frame.collect())))
    )


def test_row_side_has_no_single_partition(spark, folder):
    frame = table(spark, folder("t"), steps(100))
    for max_rows in (50, 3):
        ranked = with_rank(frame, ["ts"], max_rows=max_rows)
        lines = ranked._jdf.queryExecution().executedPlan().toString().split("\n")
        for i, line in enumerate(lines):
            if "SinglePartition" in line:
                assert "HashAggregate" in lines[i + 1] or "Filter" in lines[i + 1], lines[i + 1]
                below = "".join(lines[i:i + 3])
                assert "_vl_cell" in below or "_vl_day" in below or "_vl_piece" in below


def test_broadcast_is_bound_by_a_row_count(spark):
    frame = spark.range(3)
    limit = ranking.MAX_BROADCAST_ROWS
    hinted = ranking.broadcast_if_small(frame, limit)._jdf.queryExecution().logical().toString()
    plain = ranking.broadcast_if_small(frame, limit + 1)._jdf.queryExecution().logical().toString()
    assert "hint" in hinted.lower() and "hint" not in plain.lower()
