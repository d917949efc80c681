"""Joins that stay even when one key holds a large share of all rows."""

from pyspark.sql import Column, DataFrame, functions as F

HOT_KEYS = 1000
PIECES = 32


def left_lookup(
    rows: DataFrame, table: DataFrame, keys: list[str], weight: str, n_rows: int
) -> DataFrame:
    """``rows`` left-joined with ``table`` on ``keys``; adds the table's other columns.

    ``table`` has one row per key and in ``weight`` the number of ``rows`` with
    that key. A key with more than 1/1000 of all rows is joined by broadcast: there
    can be no more than 1000 such keys, whatever the size of the data. All other
    keys are joined by shuffle. ``rows`` is read twice, so it should be a stored
    table. Null keys match nothing.
    """
    bound = n_rows / HOT_KEYS
    hot = table.filter(F.col(weight) > bound)
    cold = table.filter(F.col(weight) <= bound)
    hits = rows.join(F.broadcast(hot), keys, "inner")
    misses = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return hits.unionByName(misses.join(cold, keys, "left"))


def spread_join(rows: DataFrame, table: DataFrame, key: str, hot: DataFrame, spread: Column) -> DataFrame:
    """``rows`` joined with ``table``, which may have many rows per key.

    ``hot`` has one column, the keys with more than 1/1000 of all ``rows``, so at most 1000. Their
    ``rows`` are dealt to 32 pieces by the whole number ``spread``, and their rows of ``table``
    go to every piece. Null keys match nothing.
    """
    mark = F.broadcast(hot.withColumn("_is_hot", F.lit(True)))
    piece = F.when(F.col("_is_hot"), F.pmod(spread, F.lit(PIECES))).otherwise(0).cast("int")
    pieces = F.when(F.col("_is_hot"), F.sequence(F.lit(0), F.lit(PIECES - 1))).otherwise(F.array(F.lit(0)))
    many = rows.join(mark, key, "left").withColumn("_piece", piece).drop("_is_hot")
    few = table.join(mark, key, "left").withColumn("_piece", F.explode(pieces)).drop("_is_hot")
    return many.join(few, [key, "_piece"]).drop("_piece")
