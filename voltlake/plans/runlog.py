"""The run log: one row per export run, appended to a Parquet table."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import not_null
from ..schema import RUN_LOG_SCHEMA, RUN_TYPE_LENGTH
from ..storage import write_table


def log_run(
    spark: SparkSession,
    path: str,
    run_type: str,
    manifest: DataFrame,
    n_files: int | None = None,
    elapsed_ms: int | None = None,
) -> bool:
    """Append when the run took place, its first reading, its type and its size.

    ``run_type`` is padded to its fixed length and refused beyond it. A run
    without rows has no first reading and is not logged; the result tells. A
    zone-less first reading is taken in the session zone. An unknown number of
    files is null.
    """
    if not run_type or len(run_type) > RUN_TYPE_LENGTH:
        raise ValueError(f"run_type must have 1 to {RUN_TYPE_LENGTH} characters: {run_type!r}")
    if manifest.isEmpty():
        return False
    row = manifest.agg(
        F.min("ts_from").cast("timestamp").alias("data_start_timestamp"),
        F.sum("n_rows").alias("n_rows"),
    ).select(
        F.now().alias("last_runtime_stamp"),
        not_null("data_start_timestamp"),
        F.rpad(F.lit(run_type), RUN_TYPE_LENGTH, " ").alias("run_type"),
        "n_rows",
        F.lit(n_files).cast("bigint").alias("n_files"),
        F.lit(elapsed_ms).cast("bigint").alias("elapsed_ms"),
    )
    write_table(row, path, mode="append")
    return True


def run_log(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in RUN_LOG_SCHEMA])
    return spark.read.schema(schema).parquet(path)
