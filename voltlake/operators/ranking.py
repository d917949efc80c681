"""Exact row positions without a single-task sort.

Rows are numbered inside groups (time cells or buckets). A group that one task
can sort gets a plain window. A larger group, be it a busy minute, one repeated
timestamp or many copies of one row, is spread over tasks by a range sort and
numbered from the sizes of the sorted pieces.
"""

import math
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import c, not_null, time_bucket
from ..functions.timebuckets import DAY
from ..workspace import Workspace

# Rows one task sorts comfortably: about 1 GB of 19-column readings.
MAX_TASK_ROWS = 5_000_000

# Row count up to which a table of (key, number) pairs is broadcast: about 16 MB.
MAX_BROADCAST_ROWS = 500_000

HOUR = 3600
MINUTE = 60

ADDRESS = "_vl_address"
_SEQUENCE = "_vl_sequence"
_PIECE = "_vl_piece"
_ROW_IN_PIECE = "_vl_row_in_piece"
_PIECE_START = "_vl_piece_start"
CELL = "_vl_cell"
_DAY = "_vl_day"
_THAT_DAY = "_vl_that_day"
_START = "_vl_start"
_START_OF_DAY = "_vl_day_start"
_AMOUNT = "_vl_amount"

# monotonically_increasing_id: partition number above bit 33, row number below.
_ROW_BITS = 33


def sort_keys(df: DataFrame, order: list[str]) -> list[Column]:
    """``order``, then every other column, all ascending with nulls last.

    No key or uniqueness is declared on readings, so only the whole row settles
    a tie. Maps and variants have no order and take no part.
    """
    unordered = ("map<", "variant")
    rest = [
        f.name
        for f in df.schema
        if f.name not in order and not any(t in f.dataType.simpleString() for t in unordered)
    ]
    return [c(name).asc_nulls_last() for name in [*order, *rest]]


def _is_plain_scan(df: DataFrame) -> bool:
    """Only fixed filters and projections over one stored table, so each row is one stored row."""
    plan = df._jdf.queryExecution().analyzed()
    if not plan.deterministic():
        return False
    while plan.children().size() == 1:
        if plan.nodeName() not in ("Project", "Filter", "SubqueryAlias", "View"):
            return False
        plan = plan.children().head()
    return plan.children().isEmpty()


def with_address(df: DataFrame) -> DataFrame | None:
    """Add a number that tells copies of a row apart: a hash of file and row index.

    It depends on the stored data only, so a repeated task computes it again
    unchanged. None when the rows are not plainly those of Parquet files.
    """
    if not _is_plain_scan(df):
        return None
    try:
        return df.withColumn(ADDRESS, F.xxhash64("_metadata.file_path", "_metadata.row_index"))
    except AnalysisException:
        return None


def evaluated_once(df: DataFrame, workspace: Workspace) -> DataFrame:
    """``df``, stored first unless each evaluation reads the same stored rows.

    A limit, a sample or a random column could give other rows to the counting and
    to the numbering, and ranks with gaps.
    """
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    files = leaves.size() == 1 and leaves.head().nodeName() == "LogicalRelation"
    return df if files and _is_plain_scan(df) else workspace.save(df, "input")


def sized_partitions(df: DataFrame, n_rows: int, max_rows: int, *keys: Column) -> DataFrame:
    """Shuffle by ``keys`` into tasks of about ``max_rows``, however few partitions are set.

    Where the session's number is enough it stays, and adaptive execution may merge them.
    """
    needed = math.ceil(n_rows / max_rows)
    if needed <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df.repartition(*keys)
    return df.repartition(needed, *keys)


def broadcast_if_small(df: DataFrame, n_rows: int) -> DataFrame:
    return F.broadcast(df) if n_rows <= MAX_BROADCAST_ROWS else df


def count_rows(df: DataFrame, group: str) -> DataFrame:
    return df.groupBy(c(group)).agg(F.count(F.lit(1)).alias("n_rows"))


@dataclass
class GroupSizes:
    """Totals of a ``(group, n_rows)`` table, and its groups too large for one task."""

    max_rows: int
    n_groups: int
    n_rows: int
    n_pieces: int
    hot: DataFrame
    n_hot_groups: int
    n_hot_rows: int

    @classmethod
    def of(cls, counts: DataFrame, group: str, max_rows: int) -> "GroupSizes":
        large = F.col("n_rows") > max_rows
        pieces = F.ceil(F.col("n_rows") / F.lit(max_rows))
        totals = counts.agg(
            F.count(F.lit(1)),
            F.sum("n_rows"),
            F.sum(pieces),
            F.count_if(large),
            F.sum(F.when(large, F.col("n_rows"))),
        ).first()
        n_groups, n_rows, n_pieces, n_hot_groups, n_hot_rows = (v or 0 for v in totals)
        hot = counts.filter(large).select(group, "n_rows")
        return cls(max_rows, n_groups, n_rows, n_pieces, hot, n_hot_groups, n_hot_rows)

    @property
    def n_hot_pieces(self) -> int:
        """Tasks over which the rows of the large groups are spread."""
        return math.ceil(self.n_hot_rows / self.max_rows)

    def split(self, df: DataFrame, group: str) -> tuple[DataFrame, DataFrame | None]:
        """Rows outside and inside the large groups; the second is None if there are none."""
        if not self.n_hot_groups:
            return df, None
        keys = broadcast_if_small(self.hot.select(group), self.n_hot_groups)
        columns = df.columns
        outside = df.join(keys, group, "left_anti").select(*map(c, columns))
        inside = with_address(df)
        if inside is not None:
            columns = columns + [ADDRESS]
        else:
            inside = df
        return outside, inside.join(keys, group, "left_semi").select(*map(c, columns))


def spread_by_range(
    hot: DataFrame, keys: list[Column], n_pieces: int, workspace: Workspace
) -> DataFrame:
    """Range-partition by the keys and an added address, which splits even copies of one row."""
    if ADDRESS not in hot.columns:
        hot = with_address(workspace.save(hot, "large-groups"))
    return hot.repartitionByRange(n_pieces, *keys, c(ADDRESS))


def earlier_sum(order: str, amount: str = _AMOUNT, within: str | None = None) -> Column:
    """Sum of ``amount`` over the rows before this one, 0 for the first."""
    window = Window.partitionBy(c(within)) if within else Window.partitionBy()
    window = window.orderBy(c(order).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(amount).over(window), F.lit(0))


def positions(
    df: DataFrame, group: str, order: list[str], sizes: GroupSizes, name: str, workspace: Workspace
) -> tuple[DataFrame, DataFrame | None]:
    """Number the rows of each group from 1 in ``order``.

    The rows of small and of large groups come back as two frames, so that a
    caller can join each its own way.
    """
    small, large = sizes.split(df, group)
    keys = sort_keys(df, [group, *order])
    in_group = Window.partitionBy(c(group)).orderBy(*keys[1:])
    small = sized_partitions(small, sizes.n_rows, sizes.max_rows, c(group))
    small = small.withColumn(name, F.row_number().over(in_group).cast("bigint"))
    if large is None:
        return small, None

    n_pieces = max(
        sizes.n_hot_pieces, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    )
    written, pieces = _sorted_pieces(large, keys, n_pieces, workspace)
    # One row per large group: the window runs over a bounded table.
    groups = sizes.hot.select(group, earlier_sum(group, "n_rows").alias("_vl_group_start"))
    position = c(_PIECE_START) + c(_ROW_IN_PIECE) + 1 - c("_vl_group_start")
    large = (
        written.join(broadcast_if_small(pieces, n_pieces), _PIECE)
        .join(broadcast_if_small(groups, sizes.n_hot_groups), group)
        .select(*map(c, df.columns), position.alias(name))
    )
    return small, large


def _sorted_pieces(
    df: DataFrame, keys: list[Column], n_pieces: int, workspace: Workspace
) -> tuple[DataFrame, DataFrame]:
    """The rows in sorted pieces, each row with its piece and place in it; and where each piece starts.

    Written once: sequence numbers and piece sizes must come from one evaluation. There is one row per piece,
    so the window over the sizes is bounded.
    """
    spread = spread_by_range(df, keys, n_pieces, workspace)
    ordered = spread.sortWithinPartitions(*keys, c(ADDRESS)).drop(ADDRESS)
    sequenced = workspace.save(
        ordered.withColumn(_SEQUENCE, F.monotonically_increasing_id()), "sorted-groups"
    )
    written = sequenced.withColumn(_PIECE, F.shiftright(c(_SEQUENCE), _ROW_BITS)).withColumn(
        _ROW_IN_PIECE, c(_SEQUENCE).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    )
    pieces = count_rows(written, _PIECE).select(
        _PIECE, earlier_sum(_PIECE, "n_rows").alias(_PIECE_START)
    )
    return written, pieces


def rank_by_range(
    df: DataFrame, order: list[str], name: str, n_rows: int, max_rows: int, workspace: Workspace
) -> DataFrame:
    """``df`` plus ``name``, each row's rank, from one range shuffle by the whole order.

    The sizes of the sorted pieces tell where each starts; no time cells are counted. The rows are
    written once.
    """
    addressed = with_address(df)
    shuffled = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_pieces = max(math.ceil(n_rows / max_rows), shuffled)
    keys = sort_keys(df, order)
    written, pieces = _sorted_pieces(df if addressed is None else addressed, keys, n_pieces, workspace)
    rank = (c(_PIECE_START) + c(_ROW_IN_PIECE) + 1).alias(name)
    return written.join(broadcast_if_small(pieces, n_pieces), _PIECE).select(*map(c, df.columns), rank)


def position_in_group(
    df: DataFrame,
    group: str,
    order: list[str],
    counts: DataFrame,
    name: str,
    max_rows: int = MAX_TASK_ROWS,
    workspace: Workspace | None = None,
) -> DataFrame:
    """``df`` plus ``name``, the 1-based position of each row inside its group."""
    workspace = workspace or Workspace(df.sparkSession)
    sizes = GroupSizes.of(counts, group, max_rows)
    small, large = positions(df, group, order, sizes, name, workspace)
    return small if large is None else small.unionByName(large)


def running_start(
    table: DataFrame, time: str, n_rows: int, amount: Column, name: str
) -> DataFrame:
    """``table`` plus ``name``, the sum of ``amount`` over all rows with an earlier ``time``.

    ``time`` is unique and falls on whole seconds; a null one comes last. A table of ``n_rows`` that one
    task can sort gets a plain window. Beyond that the sum runs inside each day,
    over at most 86,400 rows, and only the day totals pass through one task.
    """
    table = table.withColumn(_AMOUNT, amount)
    if n_rows <= MAX_TASK_ROWS:
        return table.withColumn(name, earlier_sum(time)).drop(_AMOUNT)
    table = table.select("*", time_bucket(c(time), DAY).alias(_DAY))
    days = table.groupBy(_DAY).agg(F.sum(_AMOUNT).alias(_AMOUNT))
    days = days.select(_DAY, earlier_sum(_DAY).alias(_START_OF_DAY))
    start = c(_START_OF_DAY) + earlier_sum(time, within=_DAY)
    days = days.withColumnRenamed(_DAY, _THAT_DAY)
    joined = table.join(days, c(_DAY).eqNullSafe(c(_THAT_DAY)))
    return joined.withColumn(name, start).drop(_DAY, _THAT_DAY, _AMOUNT, _START_OF_DAY)


@dataclass
class TimeSpan:
    """How many rows there are and how many seconds they span, from one pass over ``ts`` without a shuffle."""

    n_rows: int
    seconds: int

    @classmethod
    def of(cls, df: DataFrame, ts: str) -> "TimeSpan":
        times = df.select(not_null(ts))
        seconds = F.timestamp_diff("SECOND", F.min(c(ts)), F.max(c(ts)))
        n_rows, seconds = times.agg(F.count(F.lit(1)), F.coalesce(seconds, F.lit(0))).first()
        return cls(n_rows, seconds)

    def rows_per_cell(self, width: int = MINUTE) -> float:
        return self.n_rows / (self.seconds / width + 1)


@dataclass
class TimeCells:
    """Rows per time cell: ``width`` seconds wide, with the large ones known.

    Counting the cells is the one extra pass an exact rank needs. It reads
    ``ts`` only, and its written result serves every later step of the same run.
    """

    width: int
    counts: DataFrame
    sizes: GroupSizes
    counted: DataFrame
    counted_width: int

    def narrow(self) -> "TimeCells":
        """The narrowest counted cells of which there are few enough to broadcast a table."""
        for width in (self.counted_width, HOUR, DAY):
            cells = self._rolled_up(self.counted, width, self.sizes.max_rows, self.counted_width)
            if cells.sizes.n_groups <= MAX_BROADCAST_ROWS:
                break
        return cells

    @classmethod
    def count(cls, df: DataFrame, ts: str, max_rows: int, workspace: Workspace) -> "TimeCells":
        """Take the widest cell that fits one task everywhere.

        If not even minutes do, the few busy ones are left to the range sort;
        when they hold most of the rows, single seconds are counted instead.
        """
        counted = _count_cells(df, ts, MINUTE, workspace)
        for width in (DAY, HOUR, MINUTE):
            cells = cls._rolled_up(counted, width, max_rows)
            if not cells.sizes.n_hot_groups:
                return cells
        if cells.sizes.n_hot_rows > cells.sizes.n_rows / 2:
            return cls._rolled_up(_count_cells(df, ts, 1, workspace), 1, max_rows, 1)
        return cells

    @classmethod
    def _rolled_up(
        cls, counted: DataFrame, width: int, max_rows: int, counted_width: int = MINUTE
    ) -> "TimeCells":
        wider = counted.withColumn(CELL, time_bucket(c(CELL), width))
        counts = wider.groupBy(CELL).agg(
            F.sum("n_rows").alias("n_rows"),
            F.min("ts_from").alias("ts_from"),
            F.max("ts_to").alias("ts_to"),
        )
        sizes = GroupSizes.of(counts, CELL, max_rows)
        return cls(width, counts, sizes, counted, counted_width)


def _count_cells(df: DataFrame, ts: str, width: int, workspace: Workspace) -> DataFrame:
    """Row count and time range of each cell."""
    times = df.select(not_null(ts)).select(c(ts), time_bucket(c(ts), width).alias(CELL))
    counts = times.groupBy(CELL).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(c(ts)).alias("ts_from"), F.max(c(ts)).alias("ts_to")
    )
    return workspace.save(counts, "cell-counts")


def with_rank(
    df: DataFrame,
    order: list[str],
    name: str = "rank",
    max_rows: int = MAX_TASK_ROWS,
    workspace: Workspace | None = None,
    cells: TimeCells | None = None,
    span: TimeSpan | None = None,
) -> DataFrame:
    """``df`` plus ``name``, the exact 1-based position of each row in the whole ``order``.

    The first column of ``order`` is a timestamp without nulls. A table of at most ``max_rows``, counted
    first, is sorted by one task. Beyond that, rows per time
    cell give the rank at which each cell starts; inside a cell rows are
    numbered by :func:`positions`. The rows themselves are shuffled once.
    """
    ts = order[0]
    workspace = workspace or Workspace(df.sparkSession)
    if cells is None:
        if span is None:
            df = evaluated_once(df, workspace)
            span = TimeSpan.of(df, ts)
        if span.n_rows <= max_rows:
            place = F.row_number().over(Window.orderBy(*sort_keys(df, order)))
            return df.select("*", place.cast("bigint").alias(name))
        cells = TimeCells.count(df, ts, max_rows, workspace)
    starts = running_start(
        cells.counts, CELL, cells.sizes.n_groups, F.col("n_rows"), _START
    ).select(CELL, _START)

    columns = df.columns
    celled = df.select(*map(c, columns), time_bucket(c(ts), cells.width).alias(CELL))
    small, large = positions(celled, CELL, order, cells.sizes, name, workspace)
    rank = (c(_START) + c(name)).alias(name)
    ranked = small.join(starts, CELL).select(*map(c, columns), rank)
    if large is None:
        return ranked
    n_hot = cells.sizes.n_hot_groups
    hot_cells = broadcast_if_small(cells.sizes.hot.select(CELL), n_hot)
    hot_starts = broadcast_if_small(starts.join(hot_cells, CELL, "left_semi"), n_hot)
    return ranked.unionByName(large.join(hot_starts, CELL).select(*map(c, columns), rank))
