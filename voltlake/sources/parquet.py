"""Parquet sink."""

from pyspark.sql import DataFrame, types as T

from ..operators.contract import FITS, REJECTED, enforce, typed, with_verdict
from ..storage import full_path, path_exists, remove_folder, rename, replacing, settle, write_files, write_table
from ..workspace import Workspace

CODECS = ("snappy", "gzip", "uncompressed")


def check_codec(codec: str) -> str:
    if codec not in CODECS:
        raise ValueError(f"unknown codec {codec!r}, expected one of {CODECS}")
    return codec


def _input_folders(df: DataFrame) -> list[str]:
    """The root folders that ``df`` reads, from its plan; no files are listed."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    folders = []
    for leaf in (leaves.apply(i) for i in range(leaves.size())):
        if leaf.nodeName() != "LogicalRelation":
            continue
        relation = leaf.relation()
        if relation.getClass().getSimpleName() == "HadoopFsRelation":
            roots = relation.location().rootPaths()
            folders += [roots.apply(i).toString().rstrip("/") for i in range(roots.size())]
    return folders


def refuse_own_input(df: DataFrame, *paths: str | None) -> None:
    """A job must not write into a folder that it reads, nor above or below one.

    Overwriting would delete the input; a dataset inside another makes that one
    unreadable. Missing paths (None) are passed over.
    """
    folders = _input_folders(df)
    for path in filter(None, paths):
        target = full_path(df.sparkSession, path)
        for source in folders:
            if f"{source}/".startswith(f"{target}/") or f"{target}/".startswith(f"{source}/"):
                raise ValueError(f"{path} is, holds or lies in an input of the same job")


def _write_fitting_apart(
    df: DataFrame, path: str, quarantine_path: str, codec: str, mode: str, schema: T.StructType
) -> None:
    """Rows that fit ``schema`` to one folder and the others to another, published together.

    ``df`` is evaluated once: all rows are stored first, in two folders by whether they fit. The folder
    of those that do not is the quarantine; the others are read from theirs, given their types
    and written.
    """
    spark = df.sparkSession
    judged = with_verdict(df, schema, FITS)
    for target in (path, quarantine_path):
        settle(spark, target)
        if mode == "errorifexists" and path_exists(spark, target):
            raise FileExistsError(target)

    def write_both(stored: str, good_path: str, bad_path: str, how: str) -> None:
        write_files(judged, stored, codec=codec, partition_by=FITS)
        fit, unfit = (f"{stored}/{FITS}={verdict}" for verdict in ("true", "false"))
        # Without rows there is no folder, and a dataset has at least its schema.
        empty = judged.drop(FITS).limit(0)
        for part in (fit, unfit):
            write_files(empty, part, "append", codec)
        rows = spark.read.schema(empty.schema).parquet(fit).drop(REJECTED)
        write_files(typed(rows, schema), good_path, how, codec)
        if how == "append":
            write_files(spark.read.schema(empty.schema).parquet(unfit), bad_path, how, codec)
        else:
            rename(spark, unfit, bad_path)

    if mode == "append":
        with Workspace(spark) as workspace:
            write_both(workspace.path("judged"), path, quarantine_path, mode)
        return
    with replacing(spark, path, quarantine_path) as (good_path, bad_path):
        stored = f"{bad_path}-judged"
        try:
            write_both(stored, good_path, bad_path, "errorifexists")
        finally:
            remove_folder(spark, stored)


def write_parquet(
    df: DataFrame,
    path: str,
    codec: str = "snappy",
    mode: str = "overwrite",
    schema: T.StructType | None = None,
    policy: str = "fail",
    quarantine_path: str | None = None,
) -> None:
    """Write Parquet, optionally against declared types.

    With ``policy="quarantine"`` the rows that break ``schema`` go to
    ``quarantine_path`` and the others to ``path``; both appear together, from one evaluation of ``df``.
    """
    check_codec(codec)
    if mode != "append":
        refuse_own_input(df, path)
    if schema is not None and policy == "quarantine":
        if not quarantine_path:
            raise ValueError("quarantine needs a quarantine_path")
        if mode != "append":
            refuse_own_input(df, quarantine_path)
        _write_fitting_apart(df, path, quarantine_path, codec, mode, schema)
        return
    if schema is not None:
        df, _ = enforce(df, schema, policy)
    write_table(df, path, mode, codec)
