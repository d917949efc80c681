"""Contiguous shards with the smallest possible largest shard."""

import math
from collections import OrderedDict

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, Window

from ..workspace import Workspace

ROW_BYTES = 16
GROUPS_PER_BLOCK = 50_000
ROWS_PER_CELL = 200_000
_CACHED_BLOCKS = 128


class RunningSizes:
    """Running totals of the ordered group sizes, stored in blocks.

    The driver holds one total per block and the running totals, eight bytes a group, of at
    most 128 blocks that the search asks for. Keys stay in Spark: ``keys_at`` fetches those of the cuts.
    """

    def __init__(self, groups: DataFrame, n_blocks: int, workspace: Workspace):
        """``groups``: ``block`` int, ``key`` (ordered, also across blocks), ``size`` long."""
        window = Window.partitionBy("block").orderBy("key")
        running = groups.select("block", "key", F.sum("size").over(window).alias("upto"))
        self.table = workspace.save(running, "running")
        totals = self.table.groupBy("block").agg(F.max("upto").alias("size")).collect()
        per_block = np.zeros(n_blocks, np.int64)
        for row in totals:
            per_block[row["block"]] = row["size"]
        self.ends = np.cumsum(per_block)
        self.total = int(self.ends[-1]) if n_blocks else 0
        self._cache: OrderedDict[int, np.ndarray] = OrderedDict()

    def _start(self, block: int) -> int:
        return int(self.ends[block - 1]) if block else 0

    def _block(self, number: int) -> np.ndarray:
        if number in self._cache:
            self._cache.move_to_end(number)
            return self._cache[number]
        totals = self.table.filter(F.col("block") == number).select("upto").toArrow()
        upto = np.sort(totals["upto"].to_numpy().astype(np.int64)) + self._start(number)
        self._cache[number] = upto
        if len(self._cache) > _CACHED_BLOCKS:
            self._cache.popitem(last=False)
        return upto

    def reach(self, limit: int) -> int:
        """The largest running total <= ``limit``, 0 if there is none."""
        if limit >= self.total:
            return self.total
        block = int(np.searchsorted(self.ends, limit, side="right"))
        upto = self._block(block)
        i = int(np.searchsorted(upto, limit, side="right")) - 1
        return int(upto[i]) if i >= 0 else self._start(block)

    def keys_at(self, totals: list[int]) -> list:
        """The keys of the groups that end at the running totals, in their order, by one job."""
        wanted = F.lit(False)
        for total in totals:
            block = int(np.searchsorted(self.ends, total))
            wanted |= (F.col("block") == block) & (F.col("upto") == total - self._start(block))
        return [r["key"] for r in self.table.filter(wanted).select("key").orderBy("key").collect()]


def cut_greedily(sizes: RunningSizes, capacity: int, shards: int) -> list[int] | None:
    """Running total at the end of each shard but the last, or None if more than ``shards`` are needed."""
    cuts, done = [], 0
    for _ in range(shards):
        upto = sizes.reach(done + capacity)
        if upto >= sizes.total:
            return cuts
        if upto == done:
            return None
        cuts.append(upto)
        done = upto
    return None


def smallest_capacity(sizes: RunningSizes, largest: int, shards: int) -> int:
    """Binary search for the least capacity with which ``shards`` are enough.

    It lies between the mean (or the largest group) and the mean plus the largest
    group, so the number of checks depends on the largest group only.
    """
    low = max(math.ceil(sizes.total / shards), largest)
    high = math.ceil(sizes.total / shards) + largest
    while low < high:
        middle = (low + high) // 2
        if cut_greedily(sizes, middle, shards) is None:
            low = middle + 1
        else:
            high = middle
    return low


def shard_documents(
    docs: DataFrame,
    shards: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    workspace: Workspace | None = None,
    groups_per_block: int = GROUPS_PER_BLOCK,
    rows_per_cell: int = ROWS_PER_CELL,
) -> DataFrame:
    """One row per document: id, ``size``, ``text_crc32``, ``shard`` (0 to shards - 1), ``slot``.

    A row's size is the UTF-8 bytes of its text (null: none) plus 16. Rows with equal
    texts are one atomic group; null is a group apart from the empty text. The
    groups are ordered by the digest of their text and cut into contiguous shards
    whose largest total is the least possible. A group larger than the mean is a
    shard's lower bound; trailing shards may then be empty, as they are when there
    are fewer groups than shards. ``slot`` numbers the rows of a shard from 0 without
    gaps. The CRC of a null text is null. An empty table gives no rows. Further
    columns of ``docs`` are ignored; repeated rows are numbered one by one.
    """
    spark = docs.sparkSession
    workspace = workspace or Workspace(spark)
    text = docs[text_col]
    rows = workspace.save(
        docs.select(
            docs[id_col].alias(id_col),
            (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.coalesce(F.sha2(text, 256), F.lit("")).alias("_group"),
        ),
        "rows",
    )
    groups = workspace.save(
        rows.groupBy("_group").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")),
        "groups",
    )
    facts = groups.agg(
        F.count(F.lit(1)).alias("groups"), F.max("size").alias("largest"), F.sum("n").alias("n")
    ).first()
    if not facts["groups"]:
        return rows.select(
            id_col, "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot")
        )

    # Blocks of the digest order: the leading hex digits, so no sampling is needed.
    digits = max(1, math.ceil(math.log(facts["groups"] / groups_per_block + 1, 16)))
    prefix = F.rpad(F.substring("_group", 1, digits), digits, "0")
    block = F.conv(prefix, 16, 10).cast("int").alias("block")
    ordered = groups.select(block, F.col("_group").alias("key"), "size")
    sizes = RunningSizes(ordered, 16**digits, workspace)
    capacity = smallest_capacity(sizes, facts["largest"], shards)
    cuts = sizes.keys_at(cut_greedily(sizes, capacity, shards))

    # A shard is a range of digests, so a row finds its shard without a join.
    cells = max(1, math.ceil(facts["n"] / rows_per_cell))
    row, file = F.col("_metadata.row_index"), F.col("_metadata.file_name")
    placed = rows.select(
        *rows.columns,
        _number_of_cuts_below(F.col("_group"), cuts).alias("shard"),
        F.pmod(row, F.lit(cells)).cast("int").alias("_cell"),
        F.struct(file, row).alias("_address"),
    )
    counts = placed.groupBy("shard", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "shard", "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    in_cell = Window.partitionBy("shard", "_cell").orderBy(id_col, "_address")
    numbered = placed.withColumn("_no", F.row_number().over(in_cell) - 1)
    return numbered.join(starts, ["shard", "_cell"]).select(
        id_col, "size", "text_crc32", "shard", (F.col("_start") + F.col("_no")).alias("slot")
    )


def _number_of_cuts_below(key: Column, cuts: list) -> Column:
    """How many cuts lie before ``key``; each cut is the last key of its shard."""
    number = F.lit(0)
    for cut in cuts:
        number = number + (key > F.lit(cut)).cast("int")
    return number
