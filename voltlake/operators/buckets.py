"""Time-bucket operators: as-of filter, bucket column, order and manifest."""

from collections.abc import Callable
from datetime import datetime, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import bucket_label, c, refuse_names, time_bucket
from ..functions.timebuckets import DAY
from ..workspace import Workspace
from .ranking import (
    ADDRESS,
    MAX_TASK_ROWS,
    count_rows,
    evaluated_once,
    position_in_group,
    running_start,
    sort_keys,
    with_address,
)

# Days in the years 1 to 9999, the range of a timestamp.
CALENDAR_DAYS = 3_652_059


def resolve_as_of(df: DataFrame, ts: str, at: datetime | str | None = None) -> str:
    """The cut-off of a run as text, fixed once so that every step sees the same instant.

    Text must be an ISO date or time, with or without an offset; anything else is a
    ``ValueError``. A zone-less ``ts`` is compared with the wall clock of the session zone.
    """
    if isinstance(at, str):
        at = datetime.fromisoformat(at)
    zone = ZoneInfo(df.sparkSession.conf.get("spark.sql.session.timeZone"))
    at = at or datetime.now(timezone.utc)
    if at.tzinfo is None:
        return at.isoformat(sep=" ")
    at = at.astimezone(zone)
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        at = at.replace(tzinfo=None)
    return at.isoformat(sep=" ")


def as_of(df: DataFrame, ts: str = "time_stamp", at: datetime | str | None = None) -> DataFrame:
    """Rows strictly before ``at``, by default before now. The filter reaches the Parquet scan."""
    dtype = df.schema[ts].dataType
    if at is None:
        cutoff = F.localtimestamp() if isinstance(dtype, T.TimestampNTZType) else F.now()
    else:
        cutoff = F.lit(resolve_as_of(df, ts, at)).cast(dtype)
    return df.filter(c(ts) < cutoff)


def with_bucket(df: DataFrame, ts: str, seconds: int, name: str = "bucket") -> DataFrame:
    """The bucket start first, then every column of ``df``, which must not have one of that name."""
    refuse_names(df, name)
    return df.select(time_bucket(c(ts), seconds).alias(name), *map(c, df.columns))


def bucket_sort_keys(
    df: DataFrame, measure: str, ts: str, bucket: str = "bucket"
) -> list[Column]:
    return sort_keys(df, [bucket, measure, ts])


def order_in_bucket(
    df: DataFrame, measure: str = "bat1_temp", ts: str = "time_stamp", bucket: str = "bucket"
) -> DataFrame:
    """All rows in the order of bucket, then ``measure`` with nulls last, sorted in ranges.

    The stored address splits a bucket or row that repeats too often for one range.
    """
    keys = bucket_sort_keys(df, measure, ts, bucket)
    addressed = with_address(df)
    if addressed is None:
        return df.orderBy(*keys)
    return addressed.orderBy(*keys, ADDRESS).drop(ADDRESS)


def position_in_bucket(
    df: DataFrame,
    order: list[str],
    bucket: str = "bucket",
    name: str = "pos",
    max_rows: int = MAX_TASK_ROWS,
    workspace: Workspace | None = None,
) -> DataFrame:
    """``df`` plus ``name``, the 1-based place of each row in its bucket in ``order``."""
    workspace = workspace or Workspace(df.sparkSession)
    df = evaluated_once(df, workspace)
    counts = workspace.save(count_rows(df, bucket), "bucket-counts")
    return position_in_group(df, bucket, order, counts, name, max_rows, workspace)


def bucket_counts(
    df: DataFrame, ts: str, seconds: int, more: dict[str, Callable[[DataFrame], Column]] | None = None
) -> DataFrame:
    """Row count and time range of each non-empty bucket, and ``more`` sums; without those only ``ts`` is read."""
    bucketed = with_bucket(df if more else df.select(c(ts)), ts, seconds)
    return bucketed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(c(ts)).alias("ts_from"),
        F.max(c(ts)).alias("ts_to"),
        *(total(bucketed).alias(name) for name, total in (more or {}).items()),
    )


def number_buckets(counts: DataFrame, n_buckets: int) -> DataFrame:
    """Add to the bucket counts each bucket's ordinal in time order and its label."""
    one = F.lit(1).cast("bigint")
    return running_start(counts, "bucket", n_buckets, one, "earlier").select(
        "bucket",
        (c("earlier") + 1).alias("bucket_no"),
        bucket_label(counts).alias("bucket_label"),
        "n_rows",
        "ts_from",
        "ts_to",
        *(name for name in counts.columns if name not in ("bucket", "n_rows", "ts_from", "ts_to")),
    )


def bucket_manifest(
    df: DataFrame,
    ts: str = "time_stamp",
    seconds: int = 5,
    workspace: Workspace | None = None,
) -> DataFrame:
    """One row per non-empty bucket: its ordinal in time order, label, row count and time range.

    The calendar bounds the number of buckets of a day or more. Narrower ones
    are written out and counted first, so that the rows are scanned once.
    """
    counts = bucket_counts(df, ts, seconds)
    if seconds >= DAY:
        return number_buckets(counts, CALENDAR_DAYS)
    counts = (workspace or Workspace(df.sparkSession)).save(counts, "bucket-counts")
    return number_buckets(counts, counts.count())
