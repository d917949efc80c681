import random

import numpy as np
from pyspark.sql import functions as F

from llm.helpers import documents, words
from voltlake.llm.decontaminate import TokenFilter, mark_benchmark

PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def plain(texts, items, width=10):
    windows = []
    for i, t in items:
        w = words(t, PATTERN)
        n = min(width, len(w))
        windows += [(str(i), w[k : k + n]) for k in range(len(w) - n + 1)] if n else []
    out = []
    for t in texts:
        w, hit, found = words(t, PATTERN), set(), set()
        for item, window in windows:
            for k in range(len(w) - len(window) + 1):
                if w[k : k + len(window)] == window:
                    hit.update(range(k, k + len(window)))
                    found.add(item)
        out.append((len(w), len(hit), sorted(found)))
    return out


def data():
    r = random.Random(2)
    word = lambda: r.choice(["a", "b", "C", "dé", "e1"])
    items = [(k, " ".join(word() for _ in range(r.randrange(1, 14)))) for k in range(12)]
    items += [(50, "!!"), (51, ""), (10, items[3][1]), (3, "x y")]
    texts = [None, "", "--", "only clean words"]
    for _ in range(60):
        parts = [word() for _ in range(r.randrange(0, 15))]
        if r.random() < 0.7:
            parts.append(r.choice(items)[1].upper())
        texts.append(", ".join(parts + [word() for _ in range(r.randrange(0, 5))]))
    return texts, items


def results(spark, texts, items, **options):
    docs = documents(spark, list(enumerate(texts))).withColumn("hit_items", F.lit(1))
    table = spark.createDataFrame(items, "item_id long, text string")
    rows = mark_benchmark(docs, table, keep=["doc_id", "n_chars"], **options).collect()
    return [(r["n_words"], r["n_hit"], r["hit_items"]) for r in sorted(rows, key=lambda r: r["doc_id"])]


def test_equals_plain_search_in_one_block_and_in_many(spark):
    texts, items = data()
    expected = plain(texts, items)
    assert results(spark, texts, items + [(None, "a b"), (99, None)]) == expected
    assert results(spark, texts, items, block_bytes=60) == expected
    assert results(spark, texts, items, window=4, shingle=2) == plain(texts, items, 4)


def test_without_items_or_documents(spark):
    assert results(spark, ["a b", None], []) == [(2, 0, []), (0, 0, [])]
    assert results(spark, [], [(1, "a b")]) == []


def test_one_hot_passage_a_long_text_and_clashing_columns(spark):
    r = random.Random(5)
    passage = " ".join(f"w{k}" for k in range(14))
    items = [(k, f"{passage} own{k}") for k in range(40)] + [(90, "zz"), (91, passage.upper())]
    texts = [f"x{k} {passage}, own{k % 50}" for k in range(80)]
    texts += [" ".join(r.choice(["zz", "q", "Überall", "w3"]) for _ in range(60_000))]
    docs = documents(spark, list(enumerate(texts)))
    inner = ["_in_file", "_at_row", "token", "at", "lead", "words", "run", "n", "start", "end", "item", "_piece"]
    for name in inner:
        docs = docs.withColumn(name, F.lit("caller"))
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("item", F.lit("caller"))
    rows = sorted(mark_benchmark(docs, table, block_bytes=500).collect(), key=lambda row: row["doc_id"])
    assert [(x["n_words"], x["n_hit"], x["hit_items"]) for x in rows[:80]] == plain(texts[:80], items)
    assert rows[80]["n_words"] == 60_000
    assert rows[80]["n_hit"] == texts[80].split().count("zz") and rows[80]["hit_items"] == ["90"]
    assert all(x[c] == "caller" for x in rows for c in inner)


def test_filter_passes_every_wanted_token(spark):
    tokens = [k * 0x9E3779B97F4A7C15 % 2**64 - 2**63 for k in range(3000)]
    wanted = TokenFilter(spark.createDataFrame([(t,) for t in tokens[:1000]], "token long"))
    passed = wanted.find(np.array(tokens, np.int64).view(np.uint64))
    assert passed[:1000].tolist() == list(range(1000)) and len(passed) < 1020
