"""CSV that neither changes nor hides data."""

import pytest
from pyspark.sql import functions as F, types as T

from voltlake import export_csv, load_csv, row_count

TEXTS = ["plain", " x ", "", None, 'say "hi"', 'say "hi", bob', '{"k": 1}', "a,b", "\\", "'", "\t"]
SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())])


def write(path, text):
    import os

    os.makedirs(path)
    with open(f"{path}/part.csv", "w", newline="") as f:
        f.write(text)
    return path


def test_texts_come_back_unchanged(spark, folder):
    rows = list(enumerate(TEXTS))
    export_csv(spark.createDataFrame(rows, SCHEMA), folder("out"))
    got = load_csv(spark, folder("out"), SCHEMA, required=("id",)).collect()
    assert sorted(tuple(r) for r in got) == rows


def test_labels_keep_their_blanks(spark, folder):
    frame = spark.createDataFrame([(1, "a")], SCHEMA).toDF("id", " bat 1 voltage")
    export_csv(frame.coalesce(1), folder("out"))
    assert spark.read.text(folder("out")).first()[0] == "id, bat 1 voltage"


def test_standard_quoting_is_read(spark, folder):
    path = write(folder("in"), 'id,text\n1,"say ""hi"""\n2,"say ""hi"", bob"\n3,""\n4,\n')
    got = {r["id"]: r["text"] for r in load_csv(spark, path, SCHEMA, required=("id",)).collect()}
    assert got == {1: 'say "hi"', 2: 'say "hi", bob', 3: "", 4: None}


def test_line_breaks_need_the_option(spark, folder):
    path = write(folder("in"), 'id,text\n1,"two\nlines"\n')
    row = load_csv(spark, path, SCHEMA, required=("id",), multi_line=True).first()
    assert row["text"] == "two\nlines"


@pytest.mark.parametrize("line", ["warm,a", "2", ",a"])
def test_bad_lines_fail_whatever_is_read(spark, folder, line):
    schema = T.StructType([*SCHEMA.fields, T.StructField("last", T.LongType())])
    good = write(folder("good"), "id,text,last\n1,a,3\n")
    assert row_count(load_csv(spark, good, schema, required=("id",))).first()[0] == 1
    path = write(folder("bad"), f"id,text,last\n1,a,3\n{line},4\n")
    loaded = load_csv(spark, path, schema, required=("id",))
    for frame in (loaded, loaded.select("last"), row_count(loaded), loaded.agg(F.max("text"))):
        with pytest.raises(Exception, match="(?i)malformed|null in required"):
            frame.collect()
