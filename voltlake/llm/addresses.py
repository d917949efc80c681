"""Rows told apart by where they are stored."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from ..operators.ranking import evaluated_once
from ..workspace import Workspace

FILE, ROW = "_in_file", "_at_row"


def stored_rows(df: DataFrame, workspace: Workspace) -> DataFrame:
    """``df``, stored first unless each of its rows is one row of a file that numbers its rows."""
    once = evaluated_once(df, workspace)
    try:
        once.select("_metadata.row_index")
    except AnalysisException:
        return workspace.save(once, "addressed")
    return once


def addressed(df: DataFrame, workspace: Workspace) -> DataFrame:
    """``df`` plus ``_in_file`` and ``_at_row``, the same for a row in every evaluation.

    A frame that reads files has such addresses already; any other is stored first. Two calls
    store it twice and give other addresses: to compare them, address ``stored_rows`` of it.
    """
    return stored_rows(df, workspace).select(
        "*",
        F.xxhash64(F.col("_metadata.file_path")).alias(FILE),
        F.col("_metadata.row_index").alias(ROW),
    )
