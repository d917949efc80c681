from .exports import ExportResult, export_batches, export_buckets, verify_export
from .jobs import export_job, load_job
from .runlog import log_run

__all__ = [
    "ExportResult",
    "export_batches",
    "export_buckets",
    "export_job",
    "load_job",
    "log_run",
    "verify_export",
]
