"""Sensor time-series landing and Parquet export, built from Spark DataFrame operations."""

from .functions import bucket_label, time_bucket
from .operators import (
    as_of,
    batch_manifest,
    batch_summary,
    bucket_manifest,
    check_contract,
    enforce,
    export_names,
    order_in_bucket,
    position_in_bucket,
    with_batch_id,
    with_bucket,
    with_rank,
)
from .plans import export_batches, export_buckets, load_job, export_job, log_run, verify_export
from .sources import (
    append_readings,
    export_csv,
    load_csv,
    order_readings,
    readings,
    row_count,
    write_parquet,
)
from .workspace import Workspace

__all__ = [
    "Workspace",
    "append_readings",
    "as_of",
    "batch_manifest",
    "batch_summary",
    "bucket_label",
    "bucket_manifest",
    "check_contract",
    "enforce",
    "export_batches",
    "export_buckets",
    "export_csv",
    "export_job",
    "export_names",
    "load_csv",
    "load_job",
    "log_run",
    "order_in_bucket",
    "order_readings",
    "position_in_bucket",
    "readings",
    "row_count",
    "time_bucket",
    "verify_export",
    "with_batch_id",
    "with_bucket",
    "with_rank",
    "write_parquet",
]
