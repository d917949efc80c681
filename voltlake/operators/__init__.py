from .batches import batch_manifest, batch_summary, with_batch_id
from .buckets import (
    as_of,
    bucket_manifest,
    order_in_bucket,
    position_in_bucket,
    resolve_as_of,
    with_bucket,
)
from .contract import check_contract, enforce, export_names
from .ranking import MAX_TASK_ROWS, with_rank

__all__ = [
    "MAX_TASK_ROWS",
    "as_of",
    "batch_manifest",
    "batch_summary",
    "bucket_manifest",
    "check_contract",
    "enforce",
    "export_names",
    "order_in_bucket",
    "position_in_bucket",
    "resolve_as_of",
    "with_batch_id",
    "with_bucket",
    "with_rank",
]
