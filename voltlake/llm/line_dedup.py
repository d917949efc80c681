"""Removal of repeated passages by windows of three consecutive lines."""

from pyspark.sql import Column, DataFrame, functions as F

from ..workspace import Workspace
from .addresses import FILE, ROW, addressed
from .names import shielded
from .skew import left_lookup

WINDOW = 3


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WINDOW,
    workspace: Workspace | None = None,
) -> DataFrame:
    """``docs`` with the text cleaned, plus ``n_lines`` and ``n_removed``.

    Lines are separated by a line feed. Each run of ``width`` consecutive lines is a
    window; windows with equal lines are occurrences of one passage. The occurrence
    with the smallest id, and in it the earliest line, stays. All others, in the same
    document too, are later ones: the positions that they cover are merged, and these
    lines go. All other lines stay as they are.

    Null ids come last; rows that repeat an id are told apart by where they are
    stored. A null text has no lines and stays null; an empty text is one empty line.
    A document of fewer than ``width`` lines has no window. If all lines go, the text is
    empty. Other columns are kept, but for ``n_lines`` and ``n_removed``, which are
    replaced. Windows are compared by 128 hash bits.
    """
    spark = docs.sparkSession
    workspace = workspace or Workspace(spark)
    rows, names = shielded(docs)
    at = addressed(rows, workspace)
    text = names[text_col]
    lines = F.split(at[text], "\n")

    def hashed(start: int) -> Column:
        return F.transform(lines, lambda line: F.xxhash64(F.lit(start), line))

    def windows_of(each: str) -> Column:
        parts = (F.get(F.col(each), F.col("_pos") + k) for k in range(width))
        return F.xxhash64(*parts)

    long_enough = at.filter(F.size(lines) >= width).select(
        F.col(names[id_col]).alias("_id"),
        FILE,
        ROW,
        hashed(1).alias("_one"),
        hashed(2).alias("_two"),
    )
    placed = long_enough.select(
        "*", F.explode(F.sequence(F.lit(0), F.size("_one") - width)).alias("_pos")
    )
    windows = workspace.save(
        placed.select(
            "_id", FILE, ROW, "_pos", windows_of("_one").alias("_h1"), windows_of("_two").alias("_h2")
        ),
        "windows",
    )

    occurrence = F.struct(F.col("_id").isNull().alias("last"), "_id", FILE, ROW, "_pos")
    passages = workspace.save(
        windows.groupBy("_h1", "_h2")
        .agg(F.min(occurrence).alias("_first"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1"),
        "passages",
    )
    found = left_lookup(windows, passages, ["_h1", "_h2"], "_n", windows.count())
    later = found.filter(
        F.col("_first").isNotNull()
        & ~(
            (F.col(f"_first.{FILE}") == F.col(FILE))
            & (F.col(f"_first.{ROW}") == F.col(ROW))
            & (F.col("_first._pos") == F.col("_pos"))
        )
    )
    covered = later.groupBy(FILE, ROW).agg(F.collect_set("_pos").alias("_starts"))

    merged = F.array_distinct(
        F.flatten(F.transform("_starts", lambda p: F.sequence(p, p + (width - 1))))
    )
    n_lines = F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)).cast("long")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
    cleaned = F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")
    others = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    return (
        at.join(covered, [FILE, ROW], "left")
        .withColumn("_gone", merged)
        .select(
            *(
                F.when(F.col("_gone").isNull(), at[text]).otherwise(cleaned).alias(c)
                if c == text_col
                else at[names[c]].alias(c)
                for c in others
            ),
            n_lines.alias("n_lines"),
            F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
        )
    )
