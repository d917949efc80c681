"""Spelling groups against every pair of words, on whole texts and small fixtures."""

import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from llm.helpers import DOC_SCHEMA, documents
from voltlake.llm import spelling
from voltlake.llm.spelling import group_spellings

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def counted(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(_LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += len(run) >= 5
    return n


def brute(rows):
    n = {w: c for w, c in counted(rows).items() if c >= 3}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len({r[0] for r in rows})
    return {r[0]: r[1:] for r in rows}


def test_random_words_equal_all_pairs(spark):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("aábÿ") for _ in range(rng.randint(4, 8))) for _ in range(400)]
    weights = [rng.choice((1, 2, 5, 20)) for _ in vocabulary]
    rows = [(i, " ".join(rng.choices(vocabulary, weights, k=300)).upper()) for i in range(40)]
    expected = brute(rows)
    assert any(v[0] and v[0] != v[1] for v in expected.values()), "no chain of forms"
    assert found(group_spellings(documents(spark, rows))) == expected


@pytest.mark.parametrize("block", [4 << 20, 700, 40])
def test_counts_do_not_depend_on_blocks(spark, block, monkeypatch):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(None, "Œuvre×÷ Ünïted " * 40), (7, None), (8, ""), (9, "x" * 3000), (10, "é" * 900 + " " + "abcde" * 40)]
    monkeypatch.setattr(spelling, "_BLOCK", block)
    ids = pa.array([None if i is None else str(i) for i, _ in rows])
    batch = pa.RecordBatch.from_arrays([ids, pa.array([t for _, t in rows])], ["_id", "_text"])
    total = Counter()
    for out in spelling._count_words(iter([batch]), 5):
        total.update(dict(zip(out[0].to_pylist(), out[1].to_pylist())))
    assert +total == +counted(rows)


def test_ties_thresholds_and_nulls(spark):
    text = "paper " * 6 + "papel " * 6 + "papes " * 3 + "papet " * 4 + "pape " * 9 + "rarer " * 2
    rows = [(1, text), (2, None), (3, ""), (None, "lower LOWER Lower"), (1, "again")]
    result = found(group_spellings(documents(spark, rows)))
    assert result == brute(rows)
    assert result["papes"][0] == "papel", "of equal counts the first in code-point order"
    assert result["papet"][0] is None, "six is less than twice four"
    assert "pape" not in result and "rarer" not in result
    assert result["lower"] == (None, "lower", 3, 0, None)


def test_repeated_rows_count_each_time(spark):
    rows = [(1, "twice")] * 3
    assert found(group_spellings(documents(spark, rows))) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    assert group_spellings(spark.createDataFrame([], DOC_SCHEMA)).collect() == []
    clash = documents(spark, [(1, "words words words")]).selectExpr("*", "1 as word", "2 as n", "3 as _text", "4 as _id", "5 as form")
    assert found(group_spellings(clash)) == {"words": (None, "words", 3, 0, None)}


def test_long_text(spark):
    rows = [(1, "lengthy lengthi " * 200_000)]
    assert found(group_spellings(documents(spark, rows)))["lengthi"][2:] == (200_000, 1, None)
