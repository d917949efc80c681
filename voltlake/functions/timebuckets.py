"""Origin-aligned time buckets and their labels."""

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .columns import c

# Buckets are counted from Monday 2000-01-03 00:00, given here as
# seconds after 1970-01-01, and labelled down to the second.
ORIGIN_SECONDS = 946857600
LABEL_PATTERN = "yyyy-MM-dd_HH-mm-ss"

DAY = 86400


def time_bucket(col: Column | str, seconds: int) -> Column:
    """Start of the ``seconds``-wide bucket that holds the timestamp.

    ``window`` works on the stored microseconds, so the result has the type of
    the input and does not depend on the session zone. A null timestamp has a
    null bucket. One width per ``select``.
    """
    if isinstance(seconds, bool) or not isinstance(seconds, int) or seconds < 1:
        raise ValueError(f"bucket width must be a whole number of seconds >= 1, got {seconds!r}")
    width = f"{seconds} seconds"
    ts = F.col(col) if isinstance(col, str) else col
    # ``window`` filters null times out of the table, so it must not see any.
    filled = F.coalesce(ts, F.lit("2000-01-03 00:00:00").cast("timestamp_ntz"))
    start = F.window(filled, width, width, f"{ORIGIN_SECONDS % seconds} seconds").getField("start")
    return F.when(ts.isNotNull(), start)


def bucket_label(df: DataFrame, bucket: str = "bucket") -> Column:
    """Text form of a bucket start, in UTC for instants and as is for zone-less timestamps.

    A label in the session zone would give two buckets of a clock change the
    same text.
    """
    start = c(bucket)
    if isinstance(df.schema[bucket].dataType, T.TimestampType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        start = F.timestamp_add("MICROSECOND", F.unix_micros(start), epoch)
    return F.date_format(start, LABEL_PATTERN)
