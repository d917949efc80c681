"""The engine's operators on the supplied test tables, with the SQL that checks each.

``events`` stands in for the readings: ``ts`` for the time stamp, ``value`` for
the first measure, ``event_id`` as last word in the order.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from .. import operators as ops
from ..functions import bucket_label, time_bucket
from ..schema import MEASURES, file_schema
from ..sources import (
    export_csv,
    load_csv,
    order_readings,
    readings,
    row_count,
    write_parquet,
)
from ..storage import write_table
from ..workspace import Workspace
from .exports import export_batches, export_buckets, verify_export
from .runlog import log_run, run_log

AS_OF = "2024-01-15 00:00:00"
WIDTH = 420
SMALL_BATCH = 7
FILE_BATCH = 500


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return readings(spark, f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events")


def _hot_rows(df: DataFrame) -> int:
    """A task size of a hundredth of the table, so that it takes the way of large tables."""
    return max(1, df.count() // 100)


def q_time_bucket(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", time_bucket("ts", WIDTH).alias("bucket"))


def q_bucket_project(spark, sf_dir):
    events = _events(spark, sf_dir).select("event_id", "ts", "value")
    return ops.with_bucket(ops.as_of(events, "ts", AS_OF), "ts", WIDTH)


def q_as_of(spark, sf_dir):
    return ops.as_of(_events(spark, sf_dir), "ts", AS_OF).select("event_id", "ts")


def q_bucket_label(spark, sf_dir):
    bucketed = ops.with_bucket(_events(spark, sf_dir), "ts", WIDTH)
    return bucketed.select("event_id", bucket_label(bucketed).alias("label"))


def q_bucket_manifest(spark, sf_dir):
    events = ops.as_of(_events(spark, sf_dir), "ts", AS_OF)
    manifest = ops.bucket_manifest(events, "ts", WIDTH)
    return manifest.select("bucket", "bucket_no", "n_rows")


def q_order_in_bucket(spark, sf_dir):
    """The place of each row in its bucket, read off the order in which the sorted rows are stored."""
    events = _events(spark, sf_dir).select("event_id", "ts", "value")
    bucketed = ops.with_bucket(ops.as_of(events, "ts", AS_OF), "ts", WIDTH)
    ordered = ops.order_in_bucket(bucketed, "value", "ts").withColumn(
        "stored_at", F.monotonically_increasing_id()
    )
    stored = Workspace(spark).save(ordered, "ordered")
    before = Window.partitionBy("bucket").orderBy("stored_at")
    pos = F.row_number().over(before).cast("bigint").alias("pos")
    return stored.select("event_id", "bucket", "ts", "value", pos)


def q_position_in_bucket(spark, sf_dir):
    events = _events(spark, sf_dir).select("event_id", "ts", "value")
    bucketed = ops.with_bucket(ops.as_of(events, "ts", AS_OF), "ts", WIDTH)
    placed = ops.position_in_bucket(
        bucketed.select("bucket", "value", "event_id"), ["value", "event_id"]
    )
    return placed.select("event_id", "bucket", "pos")


def q_batch_assign(spark, sf_dir):
    events = _events(spark, sf_dir).select("event_id", "ts")
    batched = ops.with_batch_id(events, ["ts", "event_id"], SMALL_BATCH)
    return batched.select("event_id", "batch_id")


def q_batch_manifest(spark, sf_dir):
    return ops.batch_manifest(_events(spark, sf_dir), SMALL_BATCH, "ts")


def q_batch_summary(spark, sf_dir):
    return ops.batch_summary(_table(spark, sf_dir, "lineitem"), SMALL_BATCH)


def q_batch_export(spark, sf_dir):
    path = Workspace(spark).path("batches")
    export_batches(_events(spark, sf_dir), path, FILE_BATCH, ("ts", "event_id"))
    return spark.read.parquet(path).select("event_id", F.col("batch_id").cast("int").alias("batch_id"))


def q_batch_assign_ties(spark, sf_dir):
    """Only a few distinct times, and a task size for which each has too many rows."""
    month = F.date_trunc("month", "l_shipdate").cast("timestamp_ntz").alias("month")
    lines = _table(spark, sf_dir, "lineitem").select(month, "l_orderkey", "l_linenumber")
    order = ["month", "l_orderkey", "l_linenumber"]
    batched = ops.with_batch_id(lines, order, SMALL_BATCH, max_rows=_hot_rows(lines))
    return batched.select("l_orderkey", "l_linenumber", "batch_id")


def q_bucket_export_hot(spark, sf_dir):
    """Buckets of a day, each written as several files."""
    path = Workspace(spark).path("hot-buckets")
    events = _events(spark, sf_dir).select("event_id", "ts", "value")
    export_buckets(events, path, 86400, "ts", "value", AS_OF, rows_per_file=_hot_rows(events))
    return spark.read.parquet(path).select("bucket", "event_id", "ts", "value")


def q_bucket_nulls(spark, sf_dir):
    """Buckets of a table in which one time in ten is missing."""
    ts = F.when(F.col("event_id") % 10 != 0, F.col("ts")).alias("ts")
    events = _events(spark, sf_dir).select("event_id", ts)
    manifest = ops.bucket_manifest(events, "ts", WIDTH).select("bucket", "n_rows", "bucket_no")
    bucketed = ops.with_bucket(events, "ts", WIDTH)
    return bucketed.join(manifest, bucketed["bucket"].eqNullSafe(manifest["bucket"])).select(
        "event_id", bucketed["bucket"], "n_rows", "bucket_no"
    )


def q_typed_sink(spark, sf_dir):
    """Rows that fit the declared types from one folder, and those that do not from another."""
    workspace = Workspace(spark)
    good, bad = workspace.path("good"), workspace.path("bad")
    contract = T.StructType([T.StructField("temp", T.DecimalType(5, 3))])
    events = _events(spark, sf_dir).select("event_id", F.col("value").alias("temp"))
    write_parquet(events, good, "gzip", schema=contract, policy="quarantine", quarantine_path=bad)
    fit = spark.read.parquet(good).select("event_id", "temp", F.lit(None).cast("double").alias("was"))
    unfit = spark.read.parquet(bad).select(
        "event_id", F.lit(None).cast("decimal(5,3)").alias("temp"), F.col("temp").alias("was")
    )
    return fit.unionByName(unfit)


def q_sheet_export(spark, sf_dir):
    """The spreadsheet layout: its labels and declared types, gzipped."""
    path = Workspace(spark).path("sheet")
    measures = [F.col("value").alias(m) for m in MEASURES]
    named = ops.export_names(_events(spark, sf_dir).select("ts", *measures), "sheet", 1)
    contract = file_schema("sheet", 1)
    contract["timestamp"].dataType = T.TimestampNTZType()
    write_parquet(named, path, "gzip", schema=contract)
    return spark.read.parquet(path)


def q_csv_text_load(spark, sf_dir):
    """Texts with quotes, commas, blanks at the ends, empty ones and nulls, through CSV."""
    path = Workspace(spark).path("texts-csv")
    number = F.col("event_id") % 4
    note = (
        F.when(number == 0, F.concat(F.lit(' "'), "event_type", F.lit('", ')))
        .when(number == 1, F.lit(""))
        .when(number == 2, F.lit("  "))
    )
    export_csv(_events(spark, sf_dir).select("event_id", "props", note.alias(" note")), path)
    schema = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("props", T.StringType()),
            T.StructField("note", T.StringType()),
        ]
    )
    return load_csv(spark, path, schema, required=("event_id",))


def q_csv_line_breaks(spark, sf_dir):
    """Texts with line breaks, quotes and commas, through CSV files that many tasks read."""
    path = Workspace(spark).path("line-breaks-csv")
    number = F.col("event_id") % 3
    more = F.when(number == 0, F.lit('"\n\n')).when(number == 1, F.lit(",\n")).otherwise(F.lit(""))
    note = F.concat("event_type", F.lit("\n"), more, F.coalesce("props", F.lit(""))).alias("note")
    export_csv(_events(spark, sf_dir).select("event_id", note, "value"), path)
    schema = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("note", T.StringType()),
            T.StructField("value", T.DoubleType()),
        ]
    )
    return load_csv(spark, path, schema, required=("event_id",), multi_line=True)


def q_bucket_export(spark, sf_dir):
    path = Workspace(spark).path("buckets")
    events = _events(spark, sf_dir).select("event_id", "ts", "value")
    export_buckets(events, path, 86400, "ts", "value", AS_OF)
    return spark.read.parquet(path).select("bucket", "event_id", "ts", "value")


def q_typed_contract(spark, sf_dir):
    contract = T.StructType(
        [T.StructField("temp", T.DecimalType(5, 3)), T.StructField("charge", T.LongType())]
    )
    events = _events(spark, sf_dir).select(
        "event_id", F.col("value").alias("temp"), F.col("value").alias("charge")
    )
    checked = ops.check_contract(events, contract)
    rejected = (F.size("rejected_columns") > 0).alias("rejected")
    return checked.select("event_id", "temp", "charge", rejected)


def q_parquet_roundtrip(spark, sf_dir):
    path = Workspace(spark).path("orders")
    write_parquet(_table(spark, sf_dir, "orders"), path, codec="gzip")
    return spark.read.parquet(path)


def q_csv_load(spark, sf_dir):
    path = Workspace(spark).path("events-csv")
    export_csv(_events(spark, sf_dir).select("event_id", "ts", "value"), path)
    schema = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("ts", T.TimestampNTZType()),
            T.StructField("value", T.DecimalType(6, 3)),
        ]
    )
    return load_csv(spark, path, schema, required=("ts",))


def q_rename_export(spark, sf_dir):
    one_battery = [F.col("value").alias(m) for m in MEASURES]
    named = ops.export_names(_events(spark, sf_dir).select("ts", *one_battery), "count", 1)
    return named.select("timestamp", "bat 1 temp")


def q_readings_scan(spark, sf_dir):
    return order_readings(_events(spark, sf_dir), "ts")


def q_row_count(spark, sf_dir):
    return row_count(_table(spark, sf_dir, "lineitem"))


def q_verify_export(spark, sf_dir):
    path = Workspace(spark).path("batches")
    events = _events(spark, sf_dir)
    result = export_batches(events, path, FILE_BATCH, ("ts", "event_id"))
    return verify_export(spark, path, result.manifest, result.key)


def q_verify_contents(spark, sf_dir):
    """An export in which the value of one row is changed after the fact: its batch alone is not as written."""
    path = Workspace(spark).path("changed-batches")
    events = _events(spark, sf_dir).select("event_id", "ts", "value")
    result = export_batches(events, path, FILE_BATCH, ("ts", "event_id"), contents=True)
    changed = spark.read.schema(events.schema).parquet(f"{path}/batch_id=1")
    first = changed.agg(F.min("event_id")).first()[0]
    value = F.when(F.col("event_id") == first, F.col("value") + 1).otherwise(F.col("value"))
    write_table(changed.withColumn("value", value), f"{path}/batch_id=1", "overwrite")
    return verify_export(spark, path, result.manifest, result.key)


def q_batch_file_order(spark, sf_dir):
    """The place of each row in its file, as the rows are stored."""
    path = Workspace(spark).path("ordered-batches")
    export_batches(_events(spark, sf_dir).select("event_id", "ts"), path, FILE_BATCH, ("ts", "event_id"))
    stored = spark.read.parquet(path)
    pos = (F.col("_metadata.row_index") + 1).alias("pos")
    return stored.select("event_id", F.col("batch_id").cast("long").alias("batch_id"), pos)


def q_bucket_file_order(spark, sf_dir):
    path = Workspace(spark).path("ordered-buckets")
    events = _events(spark, sf_dir).select("event_id", "ts", "value")
    export_buckets(events, path, 86400, "ts", "value", AS_OF)
    pos = (F.col("_metadata.row_index") + 1).alias("pos")
    return spark.read.parquet(path).select("bucket", "event_id", pos)


def _roundtrip(codec):
    def query(spark, sf_dir):
        path = Workspace(spark).path(f"orders-{codec}")
        write_parquet(_table(spark, sf_dir, "orders"), path, codec=codec)
        return spark.read.parquet(path)

    return query


def q_run_metrics(spark, sf_dir):
    path = Workspace(spark).path("run-log")
    events = ops.as_of(_events(spark, sf_dir), "ts", AS_OF)
    manifest = ops.bucket_manifest(events, "ts", WIDTH)
    log_run(spark, path, "bucket", manifest)
    return run_log(spark, path).select(
        F.col("data_start_timestamp").cast("timestamp_ntz").alias("data_start_timestamp"),
        "run_type",
        "n_rows",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "time_bucket": q_time_bucket,
    "bucket_project": q_bucket_project,
    "as_of": q_as_of,
    "bucket_label": q_bucket_label,
    "bucket_manifest": q_bucket_manifest,
    "order_in_bucket": q_order_in_bucket,
    "position_in_bucket": q_position_in_bucket,
    "bucket_nulls": q_bucket_nulls,
    "batch_assign_ties": q_batch_assign_ties,
    "bucket_export_hot": q_bucket_export_hot,
    "typed_sink": q_typed_sink,
    "sheet_export": q_sheet_export,
    "csv_text_load": q_csv_text_load,
    "batch_assign": q_batch_assign,
    "batch_manifest": q_batch_manifest,
    "batch_summary": q_batch_summary,
    "batch_export": q_batch_export,
    "bucket_export": q_bucket_export,
    "typed_contract": q_typed_contract,
    "parquet_roundtrip": q_parquet_roundtrip,
    "csv_load": q_csv_load,
    "rename_export": q_rename_export,
    "readings_scan": q_readings_scan,
    "row_count": q_row_count,
    "verify_export": q_verify_export,
    "verify_contents": q_verify_contents,
    "batch_file_order": q_batch_file_order,
    "bucket_file_order": q_bucket_file_order,
    "parquet_roundtrip_snappy": _roundtrip("snappy"),
    "parquet_roundtrip_uncompressed": _roundtrip("uncompressed"),
    "csv_line_breaks": q_csv_line_breaks,
    "run_metrics": q_run_metrics,
}

_BUCKET = f"time_bucket(interval '{WIDTH} seconds', ts)"
_BEFORE = f"ts < timestamp '{AS_OF}'"


def _batch(n: int) -> str:
    return f"(row_number() over (order by ts, event_id) - 1) // {n} + 1"


ORACLES: dict[str, str] = {
    "time_bucket": f"select event_id, {_BUCKET} as bucket from events",
    "bucket_project": (
        f"select {_BUCKET} as bucket, event_id, ts, value from events where {_BEFORE}"
    ),
    "as_of": f"select event_id, ts from events where {_BEFORE}",
    "bucket_label": (
        f"select event_id, strftime({_BUCKET}, '%Y-%m-%d_%H-%M-%S') as label from events"
    ),
    "bucket_manifest": (
        "select bucket, row_number() over (order by bucket) as bucket_no, n_rows from "
        f"(select {_BUCKET} as bucket, count(*) as n_rows from events where {_BEFORE} group by 1)"
    ),
    "order_in_bucket": (
        "select event_id, bucket, ts, value, row_number() over "
        "(partition by bucket order by value nulls last, ts, event_id) as pos from "
        f"(select *, {_BUCKET} as bucket from events where {_BEFORE})"
    ),
    "position_in_bucket": (
        "select event_id, bucket, row_number() over "
        "(partition by bucket order by value nulls last, event_id) as pos from "
        f"(select *, {_BUCKET} as bucket from events where {_BEFORE})"
    ),
    "bucket_nulls": (
        "select event_id, bucket, count(*) over (partition by bucket) as n_rows, "
        "dense_rank() over (order by bucket nulls last) as bucket_no from "
        f"(select event_id, time_bucket(interval '{WIDTH} seconds', "
        "case when event_id % 10 <> 0 then ts end) as bucket from events)"
    ),
    "batch_assign_ties": (
        "select l_orderkey, l_linenumber, (row_number() over "
        "(order by date_trunc('month', l_shipdate), l_orderkey, l_linenumber) - 1) "
        f"// {SMALL_BATCH} + 1 as batch_id "
        "from lineitem"
    ),
    "bucket_export_hot": (
        "select time_bucket(interval '86400 seconds', ts) as bucket, event_id, ts, value "
        f"from events where {_BEFORE}"
    ),
    "typed_sink": (
        "select event_id, try_cast(value as decimal(5,3)) as temp, "
        "case when try_cast(value as decimal(5,3)) is null then value end as was from events"
    ),
    "sheet_export": (
        'select ts as "timestamp", value as "bat 1 temp", '
        'cast(trunc(value) as bigint) as "bat 1 charge", value as " bat 1 voltage" from events'
    ),
    "csv_text_load": (
        "select event_id, props, case event_id % 4 when 0 then ' \"' || event_type || '\", ' "
        "when 1 then '' when 2 then '  ' end as note from events"
    ),
    "batch_assign": f"select event_id, {_batch(SMALL_BATCH)} as batch_id from events",
    "batch_manifest": (
        "select batch_id, count(*) as n_rows, min(ts) as ts_from, max(ts) as ts_to from "
        f"(select *, {_batch(SMALL_BATCH)} as batch_id from events) group by 1"
    ),
    "batch_summary": (
        f"select count(*) as total_rows, count(*) // {SMALL_BATCH} as whole_batches, "
        f"count(*) % {SMALL_BATCH} as last_batch_rows from lineitem"
    ),
    "batch_export": (
        f"select event_id, cast({_batch(FILE_BATCH)} as integer) as batch_id from events"
    ),
    "bucket_export": (
        "select time_bucket(interval '86400 seconds', ts) as bucket, event_id, ts, value "
        f"from events where {_BEFORE}"
    ),
    "typed_contract": (
        "select event_id, try_cast(value as decimal(5,3)) as temp, "
        "try_cast(trunc(value) as bigint) as charge, value is not null and "
        "(try_cast(value as decimal(5,3)) is null or try_cast(trunc(value) as bigint) is null) "
        "as rejected from events"
    ),
    "parquet_roundtrip": "select * from orders",
    "csv_load": "select event_id, ts, cast(value as decimal(6,3)) as value from events",
    "rename_export": 'select ts as "timestamp", value as "bat 1 temp" from events',
    "readings_scan": "select * from events order by ts",
    "row_count": "select count(*) as n_rows from lineitem",
    "verify_export": (
        "select batch_id, count(*) as expected, count(*) as found, true as ok from "
        f"(select {_batch(FILE_BATCH)} as batch_id from events) group by 1"
    ),
    "verify_contents": (
        "select batch_id, count(*) as expected, count(*) as found, batch_id <> 1 as ok from "
        f"(select {_batch(FILE_BATCH)} as batch_id from events) group by 1"
    ),
    "batch_file_order": (
        "select event_id, batch_id, row_number() over (partition by batch_id order by ts, event_id) as pos "
        f"from (select *, {_batch(FILE_BATCH)} as batch_id from events)"
    ),
    "bucket_file_order": (
        "select bucket, event_id, row_number() over "
        "(partition by bucket order by value nulls last, ts, event_id) as pos from "
        f"(select *, time_bucket(interval '86400 seconds', ts) as bucket from events where {_BEFORE})"
    ),
    "parquet_roundtrip_snappy": "select * from orders",
    "parquet_roundtrip_uncompressed": "select * from orders",
    "csv_line_breaks": (
        "select event_id, event_type || chr(10) || case event_id % 3 when 0 then '\"' || chr(10) || chr(10) "
        "when 1 then ',' || chr(10) else '' end || coalesce(props, '') as note, value from events"
    ),
    "run_metrics": (
        "select min(ts) as data_start_timestamp, rpad('bucket', 8, ' ') as run_type, "
        f"count(*) as n_rows from events where {_BEFORE}"
    ),
}
