"""How tables are written, looked up, replaced and removed.

A dataset that replaces another is written beside it and takes its place by renames.
What is to be renamed is first put down in a journal, so an interrupted replacement is
finished, and one that was not decided yet is undone, by whoever next writes or reads here.
"""

import json
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_TIMESTAMP_TYPE = "spark.sql.parquet.outputTimestampType"
_MICROSECONDS = "TIMESTAMP_MICROS"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop_path.getFileSystem(configuration), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    files, location = _file_system(spark, path)
    return files.exists(location)


def full_path(spark: SparkSession, path: str) -> str:
    """``path`` with its file system, so that two spellings of one folder are equal."""
    files, location = _file_system(spark, path)
    return files.makeQualified(location).toString().rstrip("/")


def remove_folder(spark: SparkSession, path: str) -> None:
    files, location = _file_system(spark, path)
    files.delete(location, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    files, location = _file_system(spark, source)
    if not files.rename(location, _file_system(spark, target)[1]):
        raise OSError(f"cannot move {source} to {target}")


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all."""
    files, location = _file_system(spark, f"{path}.new")
    stream = files.create(location, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    rename(spark, f"{path}.new", path)


def _read_text(spark: SparkSession, path: str) -> str:
    files, location = _file_system(spark, path)
    stream = files.open(location)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


@dataclass(frozen=True)
class Swap:
    """One dataset that takes the place of another: where it waits, and where the older one goes meanwhile."""

    target: str
    staged: str
    aside: str

    @classmethod
    def at(cls, target: str, run: str) -> "Swap":
        # Readers of the folder around the dataset skip names that begin with an underscore.
        return cls(target, _beside(target, f"staged-{run}"), _beside(target, f"aside-{run}"))


def _beside(target: str, what: str) -> str:
    parent, _, name = target.rpartition("/")
    return f"{parent}/_{name}.{what}"


class Replacement:
    """Datasets that are published together, each in place of an older one or as a new one.

    Steps: a note beside each target names the journal; the journal, written at once, is the decision;
    older datasets are moved aside and new ones moved in; older ones are deleted; journal and notes
    go. Interrupted before the decision, all is as before; after it, :func:`settle` finishes the
    rest. If a move is refused, the moves already made are taken back. At no step is a dataset
    deleted before its successor is in place.
    """

    def __init__(self, spark: SparkSession, swaps: list[Swap], journal: str):
        self.spark, self.swaps, self.journal = spark, swaps, journal

    @classmethod
    def of(cls, spark: SparkSession, targets: list[str]) -> "Replacement":
        run = uuid.uuid4().hex[:12]
        swaps = [Swap.at(full_path(spark, t), run) for t in targets]
        return cls(spark, swaps, _beside(swaps[0].target, f"journal-{run}"))

    def publish(self) -> None:
        plan = json.dumps({"journal": self.journal, "swaps": [asdict(s) for s in self.swaps]})
        for swap in self.swaps:
            _write_text(self.spark, _beside(swap.target, "note"), plan)
        _write_text(self.spark, self.journal, plan)
        try:
            self._move_in()
        except OSError:
            self._move_back()
            raise
        self._clear()

    def finish(self) -> None:
        """Go on where an interrupted run stopped."""
        if path_exists(self.spark, self.journal):
            self._move_in()
        self._clear()

    def _move_in(self) -> None:
        for swap in self.swaps:
            if not path_exists(self.spark, swap.staged):
                continue
            if path_exists(self.spark, swap.target):
                # A rename that a store copies may have left half a copy; the target is still whole.
                remove_folder(self.spark, swap.aside)
                rename(self.spark, swap.target, swap.aside)
            rename(self.spark, swap.staged, swap.target)

    def _move_back(self) -> None:
        """The state before the decision; if that is refused too, journal and copies stay for a later run."""
        for swap in reversed(self.swaps):
            moved_in = not path_exists(self.spark, swap.staged)
            if moved_in:
                rename(self.spark, swap.target, swap.staged)
            if path_exists(self.spark, swap.aside):
                rename(self.spark, swap.aside, swap.target)
        remove_folder(self.spark, self.journal)
        self._clear()

    def _clear(self) -> None:
        """Without a journal nothing of an undecided run is kept; with one, all is in place by now."""
        for swap in self.swaps:
            if not path_exists(self.spark, swap.target) and path_exists(self.spark, swap.aside):
                rename(self.spark, swap.aside, swap.target)
            remove_folder(self.spark, swap.staged)
            remove_folder(self.spark, swap.aside)
        remove_folder(self.spark, self.journal)
        for swap in self.swaps:
            remove_folder(self.spark, _beside(swap.target, "note"))


def settle(spark: SparkSession, path: str) -> None:
    """Finish or undo a replacement of ``path`` that was interrupted; else nothing happens."""
    note = _beside(full_path(spark, path), "note")
    if path_exists(spark, note):
        plan = json.loads(_read_text(spark, note))
        Replacement(spark, [Swap(**s) for s in plan["swaps"]], plan["journal"]).finish()


@contextmanager
def replacing(spark: SparkSession, *targets: str) -> Iterator[list[str]]:
    """Folders to write in, one for each target; at the end all of them take the targets' places together.

    If the block fails, the targets stay as they were. One writer at a time for each dataset.
    """
    for target in targets:
        settle(spark, target)
    replacement = Replacement.of(spark, list(targets))
    try:
        yield [swap.staged for swap in replacement.swaps]
    except BaseException:
        for swap in replacement.swaps:
            remove_folder(spark, swap.staged)
        raise
    for swap in replacement.swaps:
        if not path_exists(spark, swap.staged):
            raise OSError(f"nothing was written for {swap.target}")
    replacement.publish()


def _with_microseconds(df: DataFrame) -> DataFrame:
    """``df`` in a copy of its session that writes instants as INT64 microseconds.

    Spark's default INT96 has no min/max statistics, so a time filter could not skip files
    or row groups. The type is a session setting; the caller's session keeps its own, so
    several threads may write at once.
    """
    spark = df.sparkSession
    instants = any(re.search(r"\btimestamp\b", field.dataType.simpleString()) for field in df.schema)
    if not instants or spark.conf.get(_TIMESTAMP_TYPE) == _MICROSECONDS:
        return df
    session = spark._jsparkSession.cloneSession()
    session.conf().set(_TIMESTAMP_TYPE, _MICROSECONDS)
    plan = df._jdf.queryExecution().logical()
    return DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(session, plan), spark)


def write_files(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    codec: str = "snappy",
    partition_by: str | None = None,
    observe: dict[str, Column] | None = None,
    only_observed: tuple[str, ...] = (),
    **options: int,
) -> dict:
    """Write Parquet as Spark does, and return what ``observe`` sums up of the rows on their way.

    Columns that are ``only_observed`` are not written.
    """
    df, seen = _with_microseconds(df), None
    if observe:
        seen = Observation()
        df = df.observe(seen, *(what.alias(name) for name, what in observe.items()))
    writer = df.drop(*only_observed).write.mode(mode).option("compression", codec).options(**options)
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "static").partitionBy(partition_by)
    writer.parquet(path)
    return seen.get if seen else {}


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    codec: str = "snappy",
    partition_by: str | None = None,
    observe: dict[str, Column] | None = None,
    **options: int,
) -> dict:
    """Write Parquet; ``overwrite`` replaces the whole dataset, whatever the session's overwrite mode.

    An existing dataset is replaced by one written beside it (:class:`Replacement`), so neither a
    failed job nor an interrupted one loses data.
    """
    spark = df.sparkSession
    if mode == "overwrite":
        settle(spark, path)
        if path_exists(spark, path):
            with replacing(spark, path) as (staged,):
                return write_files(df, staged, "errorifexists", codec, partition_by, observe, (), **options)
    return write_files(df, path, mode, codec, partition_by, observe, (), **options)
