"""Whole jobs: load a CSV folder into the table, export the table, check and log the run."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, types as T

from ..operators.buckets import as_of, resolve_as_of
from ..operators.contract import enforce, export_names
from ..operators.ranking import MAX_TASK_ROWS
from ..schema import N_BATTERIES, file_schema, readings_schema
from ..sources.csv import load_csv
from ..sources.parquet import refuse_own_input, write_parquet
from ..sources.readings import append_readings, readings, row_count
from ..storage import settle
from .exports import ExportResult, export_batches, export_buckets, verify_export
from .runlog import log_run


def load_job(
    spark: SparkSession,
    csv_path: str,
    table_path: str,
    zone: str | None = None,
    n_batteries: int = N_BATTERIES,
) -> int:
    """Append a CSV folder to the readings table and return the table's row count."""
    append_readings(load_csv(spark, csv_path, readings_schema(n_batteries), zone=zone), table_path)
    return row_count(readings(spark, table_path)).first()["n_rows"]


def export_job(
    spark: SparkSession,
    table_path: str,
    out_path: str,
    group: str,
    size: int,
    at: datetime | str | None = None,
    codec: str = "snappy",
    narrow: bool = False,
    quarantine_path: str | None = None,
    log_path: str | None = None,
    max_files: int | None = None,
    rows_per_file: int = MAX_TASK_ROWS,
    n_batteries: int = N_BATTERIES,
    contents: bool = False,
) -> ExportResult:
    """Export the readings table by record ``count`` or by time ``bucket``, check it and log it.

    ``size`` is the records per batch or the bucket width in seconds. Files
    carry the export labels. ``narrow`` applies the tighter types; rows that do
    not fit fail the job, or go to ``quarantine_path`` if there is one. The
    cut-off ``at`` applies to bucket exports only: a count export takes every row. With ``contents`` the
    written values are read back and compared, not only the row counts.
    """
    settle(spark, table_path)
    table = readings(spark, table_path)
    refuse_own_input(table, out_path, quarantine_path, log_path)
    contract = file_schema(group, n_batteries, narrow) if group in ("count", "bucket") else None

    def fitted(rows: DataFrame) -> DataFrame:
        if not narrow:
            return rows
        policy = "quarantine" if quarantine_path else "fail"
        fields = [f for f in contract if f.name in rows.columns]
        good, bad = enforce(rows, T.StructType(fields), policy)
        if bad is not None:
            write_parquet(bad, quarantine_path, codec)
        return good

    if group == "count":
        rows = fitted(export_names(table, "count", n_batteries))
        result = export_batches(
            rows, out_path, size, ("timestamp",), codec=codec, max_files=max_files,
            rows_per_file=rows_per_file, contents=contents,
        )
    elif group == "bucket":
        # The bucket label comes first and is added by the export itself.
        rows = table.toDF(*contract.names[1:])
        at = resolve_as_of(rows, "time_stamp", at)
        rows = fitted(as_of(rows, "time_stamp", at))
        result = export_buckets(
            rows, out_path, size, "time_stamp", "bat 1 temp", at, codec, max_files=max_files,
            rows_per_file=rows_per_file, contents=contents,
        )
    else:
        raise ValueError(f"unknown group {group!r}, expected 'count' or 'bucket'")

    checked = verify_export(spark, out_path, result.manifest, result.key)
    wrong = checked.filter("not ok").count()
    if wrong:
        raise RuntimeError(f"{wrong} of {result.n_groups} groups in {out_path} differ from the manifest")
    if log_path:
        log_run(
            spark, log_path, result.run_type, result.manifest, result.n_files, result.elapsed_ms
        )
    return result
