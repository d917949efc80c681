from .columns import c, not_null, refuse_names
from .timebuckets import bucket_label, time_bucket

__all__ = ["bucket_label", "c", "not_null", "refuse_names", "time_bucket"]
