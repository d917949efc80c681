"""Fixed-size record batches in time order."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import c, refuse_names, time_bucket
from ..workspace import Workspace
from .ranking import (
    CELL,
    MAX_BROADCAST_ROWS,
    MAX_TASK_ROWS,
    GroupSizes,
    TimeCells,
    TimeSpan,
    broadcast_if_small,
    evaluated_once,
    positions,
    rank_by_range,
    running_start,
    with_rank,
)

# Batches of fewer average time cells are cut by a range shuffle.
CELLS_PER_BATCH = 4

_RANK = "_vl_rank"
_BEFORE = "_vl_before"
_LAST = "_vl_last_batch"


def check_batch_size(n: int) -> int:
    if isinstance(n, bool) or not isinstance(n, int) or n < 1:
        raise ValueError(f"records per batch must be a whole number >= 1, got {n!r}")
    return n


def batch_of(rank: Column, n: int) -> Column:
    """Batch number, counted from 1, of the row with this 1-based rank."""
    return F.call_function("div", rank - 1, F.lit(n)) + 1


@dataclass
class BatchCells:
    """Time cells split by whether a batch ends inside them.

    ``whole`` has the one batch of each cell that lies in it with all its rows, ``border``
    the rank before each other cell. Only rows of border cells need a rank.
    """

    width: int
    whole: DataFrame
    n_whole: int
    border: DataFrame
    sizes: GroupSizes

    @classmethod
    def of(cls, cells: TimeCells, n: int, workspace: Workspace) -> "BatchCells | None":
        """None if most rows lie in border cells: ranking them all is then one shuffle less."""
        narrow = cells.narrow()
        table = running_start(narrow.counts, CELL, narrow.sizes.n_groups, F.col("n_rows"), _BEFORE)
        table = workspace.save(
            table.select(
                "*",
                batch_of(c(_BEFORE) + 1, n).alias("batch_id"),
                batch_of(c(_BEFORE) + F.col("n_rows"), n).alias(_LAST),
            ),
            "batch-cells",
        )
        border = table.filter(c("batch_id") != c(_LAST))
        sizes = GroupSizes.of(border, CELL, cells.sizes.max_rows)
        if sizes.n_rows > cells.sizes.n_rows / 2 or narrow.sizes.n_groups > MAX_BROADCAST_ROWS:
            return None
        n_whole = narrow.sizes.n_groups - sizes.n_groups
        return cls(narrow.width, table.filter(c("batch_id") == c(_LAST)), n_whole, border, sizes)

    def border_rows(self, df: DataFrame, order: list[str], n: int, workspace: Workspace) -> DataFrame:
        """The rows of the border cells with their ``batch_id``."""
        keys = broadcast_if_small(self.border.select(CELL), self.sizes.n_groups)
        celled = self._celled(df, order[0]).join(keys, CELL, "left_semi")
        small, large = positions(celled, CELL, order, self.sizes, _RANK, workspace)
        ranked = small if large is None else small.unionByName(large)
        starts = broadcast_if_small(self.border.select(CELL, _BEFORE), self.sizes.n_groups)
        batch = batch_of(c(_BEFORE) + c(_RANK), n).alias("batch_id")
        return ranked.join(starts, CELL).select(*map(c, df.columns), batch)

    def whole_rows(self, df: DataFrame, ts: str) -> DataFrame:
        """The rows of all other cells with the batch of their cell; they are not shuffled."""
        batches = broadcast_if_small(self.whole.select(CELL, "batch_id"), self.n_whole)
        return self._celled(df, ts).join(batches, CELL).select(*map(c, df.columns), "batch_id")

    def _celled(self, df: DataFrame, ts: str) -> DataFrame:
        return df.select(*map(c, df.columns), time_bucket(c(ts), self.width).alias(CELL))


def _small_batches(span: TimeSpan, n: int) -> bool:
    """Whether most rows would lie in time cells that a batch border crosses."""
    return n < CELLS_PER_BATCH * span.rows_per_cell()


def with_batch_id(
    df: DataFrame,
    order: list[str],
    n: int,
    max_rows: int = MAX_TASK_ROWS,
    workspace: Workspace | None = None,
    span: TimeSpan | None = None,
) -> DataFrame:
    """``df`` plus ``batch_id``: runs of ``n`` rows in ``order``; the last run may be short.

    Which way is taken depends on the number of rows and the seconds that they span: up to
    ``max_rows`` one task sorts them; small batches take one range shuffle by the whole order; large ones take time
    cells, most of which lie in one batch and need no shuffle.
    """
    check_batch_size(n)
    refuse_names(df, "batch_id")
    workspace = workspace or Workspace(df.sparkSession)
    if span is None:
        df = evaluated_once(df, workspace)
        span = TimeSpan.of(df, order[0])
    if span.n_rows <= max_rows:
        ranked = with_rank(df, order, _RANK, max_rows, workspace, span=span)
    elif _small_batches(span, n):
        ranked = rank_by_range(df, order, _RANK, span.n_rows, max_rows, workspace)
    else:
        cells = TimeCells.count(df, order[0], max_rows, workspace)
        split = BatchCells.of(cells, n, workspace)
        if split is not None:
            border = split.border_rows(df, order, n, workspace)
            return split.whole_rows(df, order[0]).unionByName(border)
        ranked = with_rank(df, order, _RANK, max_rows, workspace, cells)
    return ranked.select(*map(c, df.columns), batch_of(c(_RANK), n).alias("batch_id"))


def batch_summary(df: DataFrame, n: int) -> DataFrame:
    """Total rows, number of full batches and rows in the last short batch."""
    check_batch_size(n)
    total = df.agg(F.count(F.lit(1)).alias("total_rows"))
    return total.select(
        "total_rows",
        F.expr(f"total_rows div {n}").alias("whole_batches"),
        F.expr(f"total_rows % {n}").alias("last_batch_rows"),
    )


def batch_manifest(
    df: DataFrame,
    n: int,
    ts: str = "time_stamp",
    max_rows: int = MAX_TASK_ROWS,
    workspace: Workspace | None = None,
    span: TimeSpan | None = None,
) -> DataFrame:
    """The batches an export would write: rows and time range of each, nothing written.

    Which of several rows with one timestamp falls into which batch does not
    show in a manifest, so only ``ts`` is read. The way is chosen as by :func:`with_batch_id`; cells that lie
    in one batch are summed up from their counts.
    """
    check_batch_size(n)
    times = df.select(c(ts))
    workspace = workspace or Workspace(df.sparkSession)
    if span is None:
        times = evaluated_once(times, workspace)
        span = TimeSpan.of(times, ts)
    split = None
    if span.n_rows <= max_rows:
        ranked = with_rank(times, [ts], _RANK, max_rows, workspace, span=span)
    elif _small_batches(span, n):
        ranked = rank_by_range(times, [ts], _RANK, span.n_rows, max_rows, workspace)
    else:
        cells = TimeCells.count(times, ts, max_rows, workspace)
        split = BatchCells.of(cells, n, workspace)
        if split is None:
            ranked = with_rank(times, [ts], _RANK, max_rows, workspace, cells)
    if split is None:
        parts = ranked.select(batch_of(c(_RANK), n).alias("batch_id"), *_one_row(c(ts)))
    else:
        border = split.border_rows(times, [ts], n, workspace).select("batch_id", *_one_row(c(ts)))
        parts = split.whole.select("batch_id", "n_rows", "ts_from", "ts_to").unionByName(border)
    return parts.groupBy("batch_id").agg(
        F.sum("n_rows").alias("n_rows"),
        F.min("ts_from").alias("ts_from"),
        F.max("ts_to").alias("ts_to"),
    )


def _one_row(ts: Column) -> list[Column]:
    return [F.lit(1).cast("bigint").alias("n_rows"), ts.alias("ts_from"), ts.alias("ts_to")]
