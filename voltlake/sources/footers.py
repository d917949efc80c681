"""Row counts and time ranges of a partitioned dataset, from the footers of its files.

Tasks list the folders of the groups they are given and read the footers there, so neither
file names nor footers of the whole dataset pass through the driver.
"""

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import c
from ..storage import full_path

# Folders that one task lists.
FOLDERS_PER_TASK = 500
_LISTED_AT_ONCE = 10_000


def _uri(spark: SparkSession, path: str) -> str:
    uri = full_path(spark, path)
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri


def readable_in_tasks(spark: SparkSession, path: str) -> bool:
    """Whether tasks can open the store themselves: local mounts, HDFS and the usual object stores."""
    try:
        fs.FileSystem.from_uri(_uri(spark, path))
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def _folder_files(store: fs.FileSystem, folder: str) -> list[fs.FileInfo]:
    found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return [f for f in found if f.type == fs.FileType.File and not f.base_name.startswith(("_", "."))]


def _time_range(footer: pq.FileMetaData, ts: str) -> tuple[int | None, int | None]:
    """Smallest and largest stored value of a column, as it is stored."""
    low = high = None
    for k in range(footer.num_row_groups):
        group = footer.row_group(k)
        columns = (group.column(i) for i in range(group.num_columns))
        found = next((column.statistics for column in columns if column.path_in_schema == ts), None)
        if found is not None and found.has_min_max:
            low = found.min_raw if low is None else min(low, found.min_raw)
            high = found.max_raw if high is None else max(high, found.max_raw)
    return low, high


def _footers(batches: Iterator[pa.RecordBatch], uri: str, key: str, ts: str | None) -> Iterator[pa.RecordBatch]:
    store, root = fs.FileSystem.from_uri(uri)
    for batch in batches:
        totals = []
        for value in batch[0].to_pylist():
            n_files = n_bytes = n_rows = 0
            lows, highs = [], []
            for info in _folder_files(store, f"{root}/{key}={value}"):
                with store.open_input_file(info.path) as file:
                    footer = pq.read_metadata(file)
                n_files, n_bytes, n_rows = n_files + 1, n_bytes + info.size, n_rows + footer.num_rows
                low, high = _time_range(footer, ts) if ts else (None, None)
                lows += [low] if low is not None else []
                highs += [high] if high is not None else []
            totals.append((n_files, n_bytes, n_rows, min(lows, default=None), max(highs, default=None)))
        columns = zip(*totals) if totals else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [batch[0], *(pa.array(values, pa.int64()) for values in columns)],
            ["key", "n_files", "n_bytes", "found", "ts_from", "ts_to"],
        )


def group_files(
    path: str, groups: DataFrame, key: str, n_groups: int, ts: str | None = None, ts_type: str = "timestamp"
) -> DataFrame:
    """``key``, ``n_files``, ``n_bytes``, ``found`` (rows) and the range of ``ts`` for each of ``groups``.

    ``groups`` has the keys of ``n_groups`` folders ``key=value``; a folder that is not there has no files. ``ts``
    is a column of instants or zone-less times, stored in microseconds.
    """
    spark = groups.sparkSession
    uri, key_type = _uri(spark, path), groups.schema[key].dataType.simpleString()
    n_tasks = max(1, -(-n_groups // FOLDERS_PER_TASK))
    keys = groups.select(c(key).alias("key")).repartition(n_tasks)
    schema = f"key {key_type}, n_files long, n_bytes long, found long, ts_from long, ts_to long"
    found = keys.mapInArrow(lambda batches: _footers(batches, uri, key, ts), schema)
    # A zone-less time is stored as if it were in UTC.
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    times = [
        F.timestamp_add("MICROSECOND", c(name), epoch) if ts_type == "timestamp_ntz" else F.timestamp_micros(c(name))
        for name in ("ts_from", "ts_to")
    ]
    times = [at.alias(name) for at, name in zip(times, ("ts_from", "ts_to"))]
    return found.select(c("key").alias(key), "n_files", "n_bytes", "found", *times)


def _folder_names(batches: Iterator[pa.RecordBatch], uri: str, key: str) -> Iterator[pa.RecordBatch]:
    store, root = fs.FileSystem.from_uri(uri)
    for _ in batches:
        pass
    found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
    names = [f.base_name for f in found if f.type == fs.FileType.Directory and f.base_name.startswith(f"{key}=")]
    for begin in range(0, len(names), _LISTED_AT_ONCE):
        values = [name[len(key) + 1 :] for name in names[begin : begin + _LISTED_AT_ONCE]]
        yield pa.RecordBatch.from_arrays([pa.array(values, pa.string())], ["key"])


def group_keys(spark: SparkSession, path: str, key: str, key_type: str) -> DataFrame:
    """The keys of the group folders that are there, listed by one task; files are not listed."""
    uri = _uri(spark, path)
    names = spark.range(0, 1, 1, 1).mapInArrow(lambda batches: _folder_names(batches, uri, key), "key string")
    return names.select(c("key").cast(key_type).alias(key))
