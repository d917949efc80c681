"""The readings table: a Parquet dataset at a path."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.ranking import ADDRESS, sort_keys, with_address
from ..storage import settle, write_table


def readings(spark: SparkSession, path: str) -> DataFrame:
    """The table's rows; a replacement of the table that was interrupted is finished or undone first."""
    settle(spark, path)
    return spark.read.parquet(path)


def append_readings(df: DataFrame, table_path: str) -> None:
    """Add rows to the table; a failing job adds none. Loading a file twice adds it twice."""
    write_table(df, table_path, mode="append")


def row_count(df: DataFrame) -> DataFrame:
    """One row with the number of rows; a bare Parquet scan answers from the file footers."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def order_readings(df: DataFrame, ts: str = "time_stamp") -> DataFrame:
    """All rows and columns in time order, sorted in ranges.

    The stored address splits a timestamp or row that repeats too often for one range.
    """
    keys = sort_keys(df, [ts])
    addressed = with_address(df)
    if addressed is None:
        return df.orderBy(*keys)
    return addressed.orderBy(*keys, ADDRESS).drop(ADDRESS)
