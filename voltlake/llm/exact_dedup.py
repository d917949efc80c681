"""Exact deduplication that no large group of copies can slow down."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..workspace import Workspace
from .addresses import FILE, ROW, addressed
from .skew import left_lookup

SALTS = 16

_KEYS = ["_digest", "_length", "_check"]


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
    addresses: bool = False,
    workspace: Workspace | None = None,
) -> DataFrame:
    """One row per document: its id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    With ``addresses`` also where the row is stored, as ``addressed`` has it.

    Texts are equal when their normalised contents are equal. Copies are combined
    three times: inside each task, among the rows of one salt, and among the
    salts' winners. The grouping key of every step is the digest *and* the whole
    content, so a collision of digests never joins different texts, and a group
    of any size reaches the last step as at most ``salts`` rows.

    Of equal texts the row with the smallest id is kept. Null ids come after all
    others; if the smallest id occurs in several rows with that text, the first of
    these rows by its stored place is kept. A null text equals an empty one. An empty table gives an empty result. Further columns of ``docs``
    are ignored.
    """
    spark = docs.sparkSession
    workspace = workspace or Workspace(spark)
    at = addressed(docs.select(docs[id_col], docs[text_col]), workspace)
    rows = at.select(at[id_col], FILE, ROW, normalised(at[text_col]).alias("_norm")).select(
        id_col,
        FILE,
        ROW,
        "_norm",
        digest(F.col("_norm")).alias("_digest"),
        F.length("_norm").alias("_length"),
        F.xxhash64("_norm").alias("_check"),
    )
    ids = workspace.save(rows.drop("_norm"), "ids")

    salt = F.pmod(F.xxhash64(id_col), F.lit(salts)).cast("int").alias("_salt")
    salted = rows.groupBy("_digest", "_norm", "_length", "_check", salt).agg(
        F.min(id_col).alias("_winner"), F.count(F.lit(1)).alias("_n")
    )
    whole = salted.groupBy("_digest", "_norm", "_length", "_check").agg(
        F.min("_winner").alias("keep_id"), F.sum("_n").alias("group_size")
    )
    groups = workspace.save(whole.select(*_KEYS, "keep_id", "group_size"), "groups")

    n_rows = groups.agg(F.coalesce(F.sum("group_size"), F.lit(0)).alias("n")).first()["n"]
    placed = left_lookup(ids, groups, _KEYS, "group_size", n_rows)
    placed = placed.withColumn("kept", F.col(id_col).eqNullSafe(F.col("keep_id")))

    # Rows that repeat the kept id with the same text: all but one must go.
    repeated = ids.groupBy(*_KEYS, id_col).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    if not repeated.isEmpty():
        first = (
            placed.filter("kept")
            .groupBy(*_KEYS)
            .agg(F.min(F.struct(FILE, ROW)).alias("_first"), F.max("group_size").alias("_weight"))
        )
        placed = left_lookup(workspace.save(placed, "placed"), first, _KEYS, "_weight", n_rows)
        placed = placed.withColumn("kept", F.col("kept") & (F.struct(FILE, ROW) == F.col("_first")))
    return placed.select(
        *([FILE, ROW] if addresses else []),
        id_col, "keep_id", "group_size", "kept", F.col("_digest").alias("text_sha256")
    )
