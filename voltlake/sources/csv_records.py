"""Records of CSV files whose quoted fields hold line breaks, read by many tasks.

A line break ends a record if an even number of quotes precedes it in its file. Each task counts the
quotes of the block that it reads, as it reads it; sums over the blocks before tell how each block begins.
No task sorts or groups the lines of its block, so its memory does not grow with the block.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..workspace import Workspace

# Bytes of a record's lines that wait for the next batch; a longer record is put together from pieces.
OPEN_BYTES = 16 << 20

_LINE = "value binary, _file string, _block long, _seq long, _turns boolean, _blank boolean, _id long, _in_block long"
_PIECE = "value binary, _in_file long, _record long, _block long, _seq long, _header boolean, _n_turns long"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the ``_seq`` of the first line of each line's block, and the number of turns before the line in it."""
    at, first, n_before = None, 0, 0
    for batch in batches:
        turns = batch["_turns"].to_numpy(zero_copy_only=False).astype(np.int64)
        seq = batch["_seq"].to_numpy()
        before, ids = np.empty_like(turns), np.empty_like(turns)
        runs = (pc.run_end_encode(batch[name], run_end_type=pa.int64()) for name in ("_file", "_block"))
        start = 0
        for end in np.unique(np.concatenate([run.run_ends.to_numpy() for run in runs])):
            key = (batch["_file"][start].as_py(), batch["_block"][start].as_py())
            if key != at:
                at, first, n_before = key, seq[start], 0
            here = turns[start:end]
            ids[start:end] = first
            before[start:end] = n_before + np.cumsum(here) - here
            n_before += here.sum()
            start = end
        columns = [*batch.columns, pa.array(ids), pa.array(before)]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "_id", "_in_block"])


def _glued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for lines of a record that follow each other in a block; it is the whole record if it has two turns.

    Lines that come in another order only make more pieces.
    """

    def pieces(rows: pa.Table, starts: np.ndarray, n_turns: np.ndarray) -> pa.RecordBatch:
        offsets = pa.array(np.append(starts, len(rows)), pa.int32())
        lines = pa.ListArray.from_arrays(offsets, rows["value"].combine_chunks())
        first = rows.select(["_in_file", "_record", "_block", "_seq", "_header"]).take(pa.array(starts))
        end = pa.scalar(b"\n", lines.type.value_type)
        columns = [pc.binary_join(lines, end), *(c.combine_chunks() for c in first.columns), pa.array(n_turns)]
        return pa.RecordBatch.from_arrays(columns, names=["value", *first.schema.names, "_n_turns"])

    left = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if left is None else pa.concat_tables([left, rows])
        ids, record, seq = (rows[name].to_numpy() for name in ("_id", "_record", "_seq"))
        follows = (ids[1:] == ids[:-1]) & (record[1:] == record[:-1]) & (seq[1:] == seq[:-1] + 1)
        starts = np.append(0, np.flatnonzero(~follows) + 1)
        n_turns = np.add.reduceat(rows["_turns"].to_numpy().astype(np.int64), starts)
        left, last = None, rows.slice(starts[-1])
        if n_turns[-1] < 2 and last.nbytes < OPEN_BYTES:
            left, rows, starts, n_turns = last, rows.slice(0, starts[-1]), starts[:-1], n_turns[:-1]
        if len(starts):
            yield pieces(rows, starts, n_turns)
    if left is not None:
        yield pieces(left, np.zeros(1, np.int64), np.array([pc.sum(left["_turns"]).as_py()], np.int64))


def csv_records(spark: SparkSession, path: str, workspace: Workspace) -> DataFrame:
    """``record``: the text of each record without its line end; header records and blank lines are left out.

    Lines and records are stored. Only the records that lie in several blocks are shuffled. A file with a
    quote that is never closed is refused.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    read = spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").cast("binary").alias("value"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_seq"),
        (quotes % 2 == 1).alias("_turns"),
        (F.trim(F.rtrim("value", F.lit("\r"))) == "").alias("_blank"),
    )
    lines = workspace.save(read.mapInArrow(_counted, _LINE), "lines")

    blocks = lines.groupBy("_file", "_block", "_id").agg(
        F.sum(F.col("_turns").cast("long")).alias("_n_turns"),
        F.min(F.when(~F.col("_blank"), F.col("_seq"))).alias("_first"),
    )
    blocks = workspace.save(blocks, "blocks")
    left_open = blocks.groupBy("_file").agg(F.sum("_n_turns").alias("n")).filter("n % 2 = 1").first()
    if left_open:
        raise ValueError(f"a quote is never closed in {left_open['_file']}")
    # One row per block of a file is what the windows run over.
    in_file = Window.partitionBy("_file")
    earlier = in_file.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        "_id",
        F.min("_id").over(in_file).alias("_in_file"),
        F.coalesce(F.sum("_n_turns").over(earlier), F.lit(0)).alias("_start"),
        F.when(F.count("_first").over(earlier) == 0, F.col("_first")).alias("_header_at"),
    )
    told = (
        lines.join(workspace.save(starts, "starts"), "_id")
        .withColumn("_before", F.col("_start") + F.col("_in_block"))
        .withColumn("_header", F.col("_seq").eqNullSafe(F.col("_header_at")))
    )
    several = F.col("_turns") | (F.col("_before") % 2 == 1)

    def stored(rows: DataFrame) -> DataFrame:
        # Checks of the fields would else be tried before the header records are taken out.
        return workspace.save(rows.select(F.rtrim(F.col("value").cast("string"), F.lit("\r")).alias("record")), "records")

    single = told.filter(~several & ~F.col("_blank") & ~F.col("_header")).select("value")
    if blocks.filter("_n_turns > 0").isEmpty():
        return stored(single)

    # Turns open and close in pairs: all lines from one turn to the next are one record.
    glued = told.filter(several).select(
        "value",
        "_in_file",
        F.floor(F.col("_before") / 2).alias("_record"),
        "_block",
        "_seq",
        "_header",
        "_id",
        F.col("_turns").cast("int").alias("_turns"),
    )
    pieces = workspace.save(glued.mapInArrow(_glued, _PIECE), "pieces")
    whole = pieces.filter("_n_turns = 2 and not _header").select("value")
    parts = F.array_sort(F.collect_list(F.struct("_block", "_seq", F.col("value").cast("string").alias("value"))))
    joined = (
        pieces.filter("_n_turns < 2")
        .groupBy("_in_file", "_record")
        .agg(parts.alias("_parts"), F.bool_or("_header").alias("_header"))
        .filter("not _header")
        .select(F.array_join("_parts.value", "\n").cast("binary").alias("value"))
    )
    return stored(single.unionByName(whole).unionByName(joined))
