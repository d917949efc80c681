"""CSV files with line breaks in quotes, split over many tasks, against the reader of one task."""

import json
import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F, types as T

from voltlake import load_csv
from voltlake.sources import csv_records as code

SCHEMA = T.StructType(
    [T.StructField("a", T.LongType()), T.StructField("b", T.StringType()), T.StructField("c", T.StringType())]
)


@pytest.fixture
def small_blocks(spark):
    """Blocks of a few lines, so that records, quotes and line ends lie across them."""
    settings = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "1"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def one_task(spark, path):
    reader = spark.read.schema(SCHEMA).options(header=True, mode="FAILFAST", escape='"', nullValue="\x01", multiLine=True)
    return reader.csv(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def field(rng):
    plain = "".join(rng.choice("ab ,\n\"é") for _ in range(rng.randint(0, 30)))
    return '"' + plain.replace('"', '""') + '"' if rng.random() < 0.6 or set(plain) & set(',\n"') else plain or "x"


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_random_files_equal_the_one_task_reader(spark, tmp_path, small_blocks, end):
    rng = random.Random(11)
    folder = tmp_path / "csv"
    folder.mkdir()
    for k in range(3):
        lines = ["a,b,c"] + [f"{i},{field(rng)},{field(rng)}" for i in range(25)]
        (folder / f"{k}.csv").write_text(end.join(lines) + end * (k + 1), newline="")
    loaded = load_csv(spark, str(folder), SCHEMA, required=("a",), multi_line=True)
    expected = rows(one_task(spark, str(folder)))
    assert rows(loaded) == expected and len(expected) == 75
    read = spark.read.option("lineSep", "\n").text(str(folder))
    assert read.rdd.getNumPartitions() > 20


def test_header_with_a_line_break_and_no_rows(spark, tmp_path, small_blocks):
    file = tmp_path / "h.csv"
    file.write_text('"a\nfirst","b",c\n')
    assert load_csv(spark, str(file), SCHEMA, required=("a",), multi_line=True).collect() == []
    file.write_text('"a\nfirst","b",c\n1,"x\n\n\ny",""\n')
    assert rows(load_csv(spark, str(file), SCHEMA, required=("a",), multi_line=True)) == [(1, "x\n\n\ny", "")]


def test_a_record_of_many_blocks(spark, tmp_path, small_blocks):
    file = tmp_path / "long.csv"
    body = "\n".join(f"line {k}, with commas" for k in range(60))
    file.write_text(f'a,b,c\n1,"{body}",z\n2,,"""q"""\n')
    assert rows(load_csv(spark, str(file), SCHEMA, required=("a",), multi_line=True)) == [(1, body, "z"), (2, None, '"q"')]


def test_open_quotes_and_bad_rows_fail(spark, tmp_path):
    file = tmp_path / "bad.csv"
    file.write_text('a,b,c\n1,"open,z\n2,x,y\n')
    with pytest.raises(ValueError, match="never closed"):
        load_csv(spark, str(file), SCHEMA, required=("a",), multi_line=True)
    for line in ("1,short", "x,b,c", ",b,c"):
        file.write_text(f'a,b,c\n7,"two\nlines",c\n{line}\n')
        with pytest.raises(Exception):
            load_csv(spark, str(file), SCHEMA, required=("a",), multi_line=True).select("b").collect()


def test_files_without_quotes_are_read_alike(spark, tmp_path, small_blocks):
    file = tmp_path / "plain.csv"
    file.write_text("a,b,c\n" + "".join(f"{k},b{k},\n" for k in range(100)) + "\n")
    loaded = load_csv(spark, str(file), SCHEMA, required=("a",), multi_line=True)
    assert rows(loaded) == rows(one_task(spark, str(file))) and loaded.filter(F.col("c").isNull()).count() == 100


def test_records_of_many_batches(spark, tmp_path):
    """Records of more lines than one batch holds, beside short ones and a header of two lines."""
    bodies = ["\n".join(f"{k} line {i}" for i in range(n)) for k, n in enumerate([2, 25_000, 3, 1, 12_000, 2])]
    file = tmp_path / "long.csv"
    file.write_text('a,b,"c\n"\n' + "".join(f'{k},"{body}",\n' for k, body in enumerate(bodies)))
    expected = [(k, body, None) for k, body in enumerate(bodies)]
    assert rows(load_csv(spark, str(file), SCHEMA, required=("a",), multi_line=True)) == expected
    source = spark.read.option("lineSep", "\n").text(str(file))
    assert source.rdd.getNumPartitions() == 1


def test_lines_in_another_order_give_the_same_records():
    """Whatever waits and however the lines are dealt, the pieces of a record are its lines, each once."""
    import pyarrow as pa

    lines = [(f"r{r} l{i}".encode(), 5, r, 0, 10 * r + i, False, 5, int(i in (0, 3))) for r in range(40) for i in range(4)]
    names = ["value", "_in_file", "_record", "_block", "_seq", "_header", "_id", "_turns"]
    whole = {r: b"\n".join(x[0] for x in lines if x[2] == r) for r in range(40)}

    def pieces(order, size):
        batches = [order[i : i + size] for i in range(0, len(order), size)]
        out = code._glued(pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in b]) for b in batches)
        return [row for batch in out for row in batch.to_pylist()]

    for size in (1, 3, 7, 1000):
        assert {p["_record"]: p["value"] for p in pieces(lines, size)} == whole
        assert all(p["_n_turns"] == 2 for p in pieces(lines, size))
        mixed = random.Random(size).sample(lines, len(lines))
        parts = sorted(pieces(mixed, size), key=lambda p: (p["_record"], p["_seq"]))
        assert {r: b"\n".join(p["value"] for p in parts if p["_record"] == r) for r in range(40)} == whole


def test_open_lines_beyond_the_limit_become_a_piece(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(code, "OPEN_BYTES", 1)
    rows = [{"value": b"x%d" % i, "_in_file": 5, "_record": 0, "_block": 0, "_seq": i, "_header": False, "_id": 5, "_turns": int(i in (0, 5))} for i in range(6)]
    out = code._glued(pa.RecordBatch.from_pylist(rows[i : i + 2]) for i in (0, 2, 4))
    got = [(p["value"], p["_n_turns"]) for batch in out for p in batch.to_pylist()]
    assert got == [(b"x0\nx1", 1), (b"x2\nx3", 0), (b"x4\nx5", 1)]


LOAD = """
import sys
from pyspark.sql import SparkSession, functions as F, types as T
from voltlake import load_csv
file, folder = sys.argv[1:]
settings = {
    "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1", "spark.checkpoint.dir": f"{folder}/kept",
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{folder}/events",
    "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false",
}
spark = SparkSession.builder.master("local[2]").config(map=settings).getOrCreate()
schema = T.StructType().add("a", "long").add("b", "string").add("c", "string")
loaded = load_csv(spark, file, schema, required=("a",), multi_line=True)
print("rows", loaded.agg(F.count("b"), F.sum("a")).first()[:])
spark.stop()
"""


def test_no_task_holds_the_lines_of_its_block(tmp_path):
    """900,000 lines in one block: when a task sorted them, it took 176 MB for it."""
    (tmp_path / "events").mkdir()
    file = tmp_path / "lines.csv"
    file.write_text("a,b,c\n" + "".join(f'{k},"x\n\n{k}",\n' for k in range(300_000)))
    repo = os.path.dirname(os.path.dirname(code.__file__.removesuffix("/sources/csv_records.py")))
    run = [sys.executable, "-c", LOAD, str(file), str(tmp_path)]
    done = subprocess.run(run, env=os.environ | {"PYTHONPATH": repo}, capture_output=True, text=True, timeout=300)
    assert f"rows (300000, {sum(range(300_000))})" in done.stdout, done.stderr[-2000:]
    (log,) = (tmp_path / "events").iterdir()
    ends = [e for e in map(json.loads, log.read_text().splitlines()) if e["Event"] == "SparkListenerTaskEnd"]
    assert max(e["Task Metrics"]["Peak Execution Memory"] for e in ends) < 60e6
