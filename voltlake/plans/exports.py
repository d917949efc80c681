"""Parquet exports with one folder per batch or per time bucket."""

import math
import time
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import bucket_label, c, refuse_names
from ..operators.batches import batch_of, check_batch_size, with_batch_id
from ..operators.buckets import (
    as_of,
    bucket_counts,
    bucket_sort_keys,
    number_buckets,
    resolve_as_of,
    with_bucket,
)
from ..operators.ranking import (
    ADDRESS,
    MAX_TASK_ROWS,
    GroupSizes,
    TimeSpan,
    evaluated_once,
    sized_partitions,
    sort_keys,
    spread_by_range,
    with_rank,
)
from ..sources.footers import group_files, group_keys, readable_in_tasks
from ..sources.parquet import check_codec, refuse_own_input
from ..storage import path_exists, replacing, settle, write_files
from ..workspace import Workspace

# Folder of the manifest inside an export; readers of the export skip it.
MANIFEST = "_manifest"

# The folder column of an export tells its run type.
RUN_TYPES = {"batch_id": "count", "bucket_label": "bucket"}

_RANK = "_vl_rank"


@dataclass
class ExportResult:
    """What an export wrote. ``manifest`` reads the manifest stored beside the data.

    The manifest has the row count each group must have, found before the rows
    were written: bucket sizes by counting, batch sizes from the total.
    """

    path: str
    run_type: str
    key: str
    manifest: DataFrame
    n_rows: int
    n_groups: int
    n_files: int
    elapsed_ms: int
    as_of: str | None = None
    ts_from: datetime | None = None
    ts_to: datetime | None = None


def _refuse_too_many(n_files: int, max_files: int | None) -> None:
    """A guard for those who ask for one; by default any number of files is written."""
    if max_files is not None and n_files > max_files:
        raise ValueError(f"export would write {n_files} files, more than max_files={max_files}")


def _check_target(df: DataFrame, path: str, codec: str, mode: str) -> None:
    check_codec(codec)
    if mode not in ("overwrite", "errorifexists"):
        raise ValueError(f"unknown mode {mode!r}, expected 'overwrite' or 'errorifexists'")
    refuse_own_input(df, path)
    settle(df.sparkSession, path)
    if mode == "errorifexists" and path_exists(df.sparkSession, path):
        raise FileExistsError(path)


def _digest(columns: list[str], df: DataFrame) -> Column:
    """An order-free digest of rows: the sum of a hash of each, which also tells nulls apart."""
    plain = [n for n in columns if not any(t in df.schema[n].dataType.simpleString() for t in ("map<", "variant"))]
    row = F.xxhash64(*map(c, plain), *(c(n).isNull() for n in plain))
    return F.sum(row.cast("decimal(20,0)"))


def _publish(
    rows: DataFrame,
    manifest: DataFrame,
    path: str,
    key: str,
    ts: str,
    totals: tuple[int, int],
    contents: list[str] | None,
    codec: str,
    options: dict,
    started: float,
) -> ExportResult:
    """Write rows and manifest beside ``path``, check both, and put them in its place together.

    Rows, their time range and their digest are summed up while they are written; the files and times of each
    group come from the footers, read by tasks. An export that differs from its manifest is not published.
    """
    spark, (n_groups, n_rows) = rows.sparkSession, totals
    watched = {"n_rows": F.count(F.lit(1)), "ts_from": F.min(c(ts)), "ts_to": F.max(c(ts))}
    if contents:
        watched["digest"] = _digest(contents, rows)
    with Workspace(spark) as workspace, replacing(spark, path) as (staged,):
        written = write_files(rows, staged, codec=codec, partition_by=key, observe=watched, **options)
        if written["n_rows"] != n_rows:
            raise RuntimeError(f"{written['n_rows']} rows were written to {path}, {n_rows} expected")
        manifest, checks = _with_files(manifest, staged, rows, key, ts, n_groups, workspace)
        if contents:
            checks["digest"] = F.sum("digest")
        seen = write_files(manifest, f"{staged}/{MANIFEST}", observe=checks, only_observed=("found",))
        if seen["n_wrong"] or seen.get("digest") != written.get("digest"):
            raise RuntimeError(f"{seen['n_wrong']} groups of {path} differ from the manifest")
    stored = spark.read.schema(manifest.drop("found").schema).parquet(f"{path}/{MANIFEST}")
    elapsed_ms = round((time.monotonic() - started) * 1000)
    return ExportResult(
        path, RUN_TYPES[key], key, stored, n_rows, n_groups, seen["n_files"] or 0, elapsed_ms, None,
        written["ts_from"], written["ts_to"],
    )


def _with_files(
    manifest: DataFrame, staged: str, rows: DataFrame, key: str, ts: str, n_groups: int, workspace: Workspace
) -> tuple[DataFrame, dict[str, Column]]:
    """The manifest with ``n_files``, ``found`` and, where it has none yet, the time range of each group."""
    spark = rows.sparkSession
    if readable_in_tasks(spark, staged):
        ts_type = rows.schema[ts].dataType.simpleString()
        files = group_files(staged, manifest, key, n_groups, ts, ts_type).drop("n_bytes")
    else:
        # Spark lists the folders itself; only it can open this store.
        written = spark.read.schema(rows.schema).parquet(staged).groupBy(key)
        files = written.agg(
            F.count_distinct("_metadata.file_path").alias("n_files"),
            F.count(F.lit(1)).alias("found"),
            F.min(c(ts)).alias("ts_from"),
            F.max(c(ts)).alias("ts_to"),
        )
    if "ts_from" in manifest.columns:
        files = files.drop("ts_from", "ts_to")
    checks = {"n_files": F.sum("n_files"), "n_wrong": F.count_if(~c("found").eqNullSafe(c("n_rows")))}
    return manifest.join(files, key, "left").na.fill(0, ["n_files", "found"]), checks


def _batch_sizes(spark: SparkSession, n_rows: int, n: int) -> DataFrame:
    """The batches that ``n_rows`` rows make, from arithmetic alone."""
    n_before = (F.col("id") - 1) * F.lit(n)
    return spark.range(1, math.ceil(n_rows / n) + 1).select(
        F.col("id").alias("batch_id"),
        F.least(F.lit(n).cast("bigint"), F.lit(n_rows) - n_before).alias("n_rows"),
    )


def export_batches(
    df: DataFrame,
    path: str,
    n: int,
    order: tuple[str, ...] = ("time_stamp",),
    codec: str = "snappy",
    mode: str = "overwrite",
    max_files: int | None = None,
    rows_per_file: int = MAX_TASK_ROWS,
    contents: bool = False,
) -> ExportResult:
    """Write runs of ``n`` rows in time order, one folder ``batch_id=k`` with one file each.

    A batch larger than ``rows_per_file`` is written as several files, each a
    run of its own in the same order. With ``contents`` the manifest has a digest of each batch,
    by which :func:`verify_export` compares values; that takes a second pass over the rows.
    """
    check_batch_size(n)
    refuse_names(df, "batch_id")
    _check_target(df, path, codec, mode)
    spark, ts, started = df.sparkSession, order[0], time.monotonic()
    with Workspace(spark) as workspace:
        df = evaluated_once(df, workspace)
        span = TimeSpan.of(df, ts)
        n_rows = span.n_rows
        full, rest = divmod(n_rows, n)
        n_files = full * math.ceil(n / rows_per_file) + math.ceil(rest / rows_per_file)
        _refuse_too_many(n_files, max_files)
        spread, options, in_order = [c("batch_id")], {}, sort_keys(df, list(order))
        if n <= rows_per_file:
            batched = with_batch_id(df, list(order), n, workspace=workspace, span=span)
        else:
            ranked = with_rank(df, list(order), _RANK, workspace=workspace, span=span)
            batched = ranked.withColumn("batch_id", batch_of(c(_RANK), n))
            in_order = [c(_RANK)]
            # Parts of one batch may share a task; all but the last are full, so
            # the writer's own limit cuts between them.
            in_batch = (c(_RANK) - 1) % F.lit(n)
            spread.append(F.call_function("div", in_batch, F.lit(rows_per_file)))
            options["maxRecordsPerFile"] = rows_per_file
        rows = (
            sized_partitions(batched, n_rows, MAX_TASK_ROWS, *spread)
            .sortWithinPartitions("batch_id", *in_order)
            .select(*map(c, df.columns), "batch_id")
        )
        manifest = _batch_sizes(spark, n_rows, n)
        if contents:
            digests = batched.groupBy("batch_id").agg(_digest(df.columns, df).alias("digest"))
            manifest = workspace.save(manifest.join(digests, "batch_id", "left"), "digests")
        totals = math.ceil(n_rows / n), n_rows
        compared = df.columns if contents else None
        return _publish(rows, manifest, path, "batch_id", ts, totals, compared, codec, options, started)


def export_buckets(
    df: DataFrame,
    path: str,
    seconds: int,
    ts: str = "time_stamp",
    measure: str = "bat1_temp",
    at: datetime | str | None = None,
    codec: str = "snappy",
    mode: str = "overwrite",
    max_files: int | None = None,
    rows_per_file: int = MAX_TASK_ROWS,
    contents: bool = False,
) -> ExportResult:
    """Write the rows before ``at``, one folder ``bucket_label=…`` with one file per bucket.

    Rows inside a file are in the order of ``measure``, nulls last. A bucket with
    more than ``rows_per_file`` rows is written by several tasks, as sorted files
    over separate ranges of that order. A null timestamp, which is neither before nor after
    ``at``, fails the job. With ``contents`` the manifest has a digest of each bucket, by which
    :func:`verify_export` compares values; it is summed up where the rows are counted.
    """
    refuse_names(df, "bucket", "bucket_label")
    _check_target(df, path, codec, mode)
    spark, started = df.sparkSession, time.monotonic()
    at = resolve_as_of(df, ts, at)
    with Workspace(spark) as workspace:
        df = evaluated_once(df, workspace)
        if not df.filter(c(ts).isNull()).isEmpty():
            raise ValueError(f"null in {ts}")
        kept = as_of(df, ts, at)
        digest = {"digest": lambda rows: _digest(["bucket", *df.columns], rows)} if contents else {}
        counts = workspace.save(bucket_counts(kept, ts, seconds, digest), "bucket-counts")
        sizes = GroupSizes.of(counts, "bucket", rows_per_file)
        _refuse_too_many(sizes.n_pieces, max_files)

        bucketed = with_bucket(kept, ts, seconds)
        small, large = sizes.split(bucketed, "bucket")
        keys = bucket_sort_keys(bucketed, measure, ts)
        rows = sized_partitions(small, sizes.n_rows, rows_per_file, c("bucket"))
        if large is not None:
            spread = spread_by_range(large, keys, sizes.n_hot_pieces, workspace)
            rows = rows.unionByName(spread.drop(ADDRESS))
        # Labels sort like their buckets, so this is also the order partitionBy asks for.
        rows = rows.withColumn("bucket_label", bucket_label(bucketed)).sortWithinPartitions(
            "bucket_label", *keys[1:]
        )
        manifest = number_buckets(counts, sizes.n_groups)
        totals = sizes.n_groups, sizes.n_rows
        compared = bucketed.columns if contents else None
        result = _publish(rows, manifest, path, "bucket_label", ts, totals, compared, codec, {}, started)
        result.as_of = at
        return result


def verify_export(spark: SparkSession, path: str, manifest: DataFrame, key: str) -> DataFrame:
    """Compare the written groups with the manifest: their rows and, if it has digests, their values.

    Rows are counted in the file footers, which tasks read; the driver lists nothing. Groups missing on either
    side count as 0. Values are read back in full, and Spark lists the folders for that.
    """
    settle(spark, path)
    key_type = manifest.schema[key].dataType.simpleString()
    expected = manifest.select(key, F.col("n_rows").alias("expected"))
    if readable_in_tasks(spark, path):
        keys = manifest.select(key).union(group_keys(spark, path, key, key_type)).distinct()
        with_count = Workspace(spark).save(keys, "group-keys")
        found = group_files(path, with_count, key, with_count.count()).select(key, "found")
    else:
        written = spark.read.schema(f"`{key}` {key_type}").parquet(path)
        found = written.groupBy(key).agg(F.count(F.lit(1)).alias("found"))
    counts = expected.join(found, key, "full_outer").na.fill(0, ["expected", "found"])
    if "digest" not in manifest.columns:
        return counts.select(key, "expected", "found", (c("expected") == c("found")).alias("ok"))
    rows = spark.read.parquet(path)
    columns = [n for n in rows.columns if n != key]
    read_back = rows.groupBy(c(key).cast(key_type).alias(key)).agg(_digest(columns, rows).alias("read_back"))
    digests = manifest.select(key, "digest").join(read_back, key, "full_outer")
    same = c("digest").eqNullSafe(c("read_back"))
    ok = ((c("expected") == c("found")) & F.coalesce(same, F.lit(False))).alias("ok")
    return counts.join(digests, key, "left").select(key, "expected", "found", ok)
