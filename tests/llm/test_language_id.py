import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.helpers import DOC_SCHEMA
from voltlake.llm import language_id
from voltlake.llm.language_id import (
    NONE,
    Penalties,
    fit_ftrl,
    fit_temperature,
    held_out,
    identify_languages,
    predict,
    train,
)

SF_DIR = "/root/testdata/sf0.001"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = {r["doc_id"]: r for r in identify_languages(docs, keep=["doc_id", "lang"]).collect()}
    assert len(got) == docs.count()
    unseen = [r for r in got.values() if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert sum(r["lang"] == r["lang_pred"] for r in unseen) >= 0.95 * len(unseen)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_held_out_rows_and_other_columns_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").filter("doc_id < 120")
    changed = docs.withColumn(
        "lang", F.when(held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang"))
    ).withColumn("source", F.lit("elsewhere"))
    columns = ["doc_id", "lang_pred", "score"]
    first, second = (
        {tuple(r) for r in identify_languages(d, keep=["doc_id"]).select(columns).collect()}
        for d in (docs, changed)
    )
    assert first == second


def test_edge_cases(spark):
    rows = [(i, f"the cat {i} and the dog", "en", None, None) for i in range(20)]
    rows += [(100 + i, f"der Hund {i} und die Katze", "de", None, None) for i in range(20)]
    rows += [(None, "xx yy", "zz", None, None), (300, None, "en", None, None), (301, "", "en", None, None)]
    rows += [(302, "12 ½ _ !", None, None, None), (303, "Ω", None, None, None), (0, rows[0][1], "en", None, None)]
    rows += [(304, "der und die " * 30_000, None, None, None)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA).withColumn("score", F.lit("x"))
    got = identify_languages(docs).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    assert {by_id[i]["lang_pred"] for i in (300, 301, 302)} == {"und"}
    assert {by_id[i]["score"] for i in (300, 301, 302)} == {0.0}
    assert by_id[303]["lang_pred"] in ("en", "de") and by_id[304]["lang_pred"] == "de"
    assert by_id[None]["lang_pred"] != "zz" and not by_id[None]["held_out"]
    assert identify_languages(docs.limit(0)).collect() == []
    unlabelled = identify_languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in unlabelled} == {("und", 0.0)}


def test_one_language_only(spark):
    rows = [(i, f"text {i}", "en", None, None) for i in range(9)]
    model = train(spark.createDataFrame(rows, DOC_SCHEMA))
    row = predict(spark.createDataFrame(rows[:1], DOC_SCHEMA), model).first()
    assert (row["lang_pred"], row["score"]) == ("en", 1.0)


def test_features_never_cross_texts(monkeypatch):
    r = random.Random(1)
    texts = ["".join(r.choice("aB é\n") for _ in range(r.randrange(0, 9))) for _ in range(50)] + [None]
    together, first = language_id._grams(texts)
    for k, t in enumerate(texts):
        alone, _ = language_id._grams([t])
        for n in range(language_id.MAX_N):
            mine = together[n][first[k] : first[k + 1]]
            assert mine.tolist() == alone[n].tolist()
            assert (mine < NONE).sum() == max(0, len(t or "") - n)


def test_document_frequencies_count_each_text_once():
    import pyarrow as pa

    texts = ["aaaa", "ab", None, "ba ab"]
    batch = pa.record_batch([pa.array(texts)], names=["text"])
    (out,) = language_id._document_frequencies([batch])
    got = dict(zip(out.column(0).to_pylist(), out.column(1).to_pylist()))
    expected = {}
    for t in texts:
        for f in set(np.concatenate(language_id._grams([t])[0]).tolist()) - {NONE}:
            expected[f] = expected.get(f, 0) + 1
    assert got == {**expected, -1: 4}


def test_l1_penalty_leaves_rare_features_at_zero():
    r = np.random.RandomState(0)
    rows = [(np.array([k % 2, 2 + r.randint(500)]), np.ones(2), k % 2) for k in range(400)]
    weights, _ = fit_ftrl(rows, 2, Penalties(l1=1.5), 2)
    assert np.abs(weights[:2]).min() > 0.5
    assert (weights[2:502] == 0).mean() > 0.9 and (weights[502:] == 0).all()


@pytest.mark.parametrize("true", [0.7, 3.0])
def test_temperature_is_recovered(true):
    r = np.random.RandomState(1)
    scores = r.normal(0, 3, (20_000, 3))
    p = np.exp(scores / true) / np.exp(scores / true).sum(1, keepdims=True)
    labels = (p.cumsum(1) > r.rand(len(p))[:, None]).argmax(1)
    assert abs(fit_temperature(scores, labels) / true - 1) < 0.1
    assert fit_temperature(np.zeros((0, 3)), np.zeros(0, int)) == 1.0
