import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm.helpers import documents, jaccard_components, shingles, stored
from voltlake.llm import ngram_join
from voltlake.llm.components import connected_components
from voltlake.llm.ngram_join import join_ngrams
from voltlake.llm.wordhash import NOT_SPACE, words_of
from voltlake.workspace import Workspace


def corpus(n=260, seed=3):
    """Chains of ever more changed copies, subsets, short texts, hot copies and blanks."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randrange(1, 5)))
    passage = [word() for _ in range(30)]
    texts = ["", None, " \t\n ", "a b", "A  B", "b a", "a b c d e", "a b c d", "é É ß", "x " * 3000]
    base = [word() for _ in range(60)]
    for _ in range(n):
        kind = r.randrange(5)
        if kind == 0:
            base = [word() for _ in range(r.randrange(6, 120))]
        elif kind == 1:
            base = base[: max(1, len(base) - r.randrange(1, 9))]
        elif kind == 2:
            base = [w if r.random() > 0.02 else word() for w in base]
        elif kind == 3:
            base = passage + base[:10]
        texts.append(" ".join(base))
    return texts


def components_of(spark, docs):
    return {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in join_ngrams(docs).collect()}


@pytest.mark.parametrize(
    ("tile_rows", "tile_classes", "pivot_from"),
    [(ngram_join.ROWS_PER_TILE, ngram_join.TILE_CLASSES, ngram_join.PIVOT_FROM), (5, 3, 3), (10**6, 2, 10**6)],
)
def test_equals_all_pairs(spark, folder, monkeypatch, tile_rows, tile_classes, pivot_from):
    monkeypatch.setattr(ngram_join, "ROWS_PER_TILE", tile_rows)
    monkeypatch.setattr(ngram_join, "TILE_CLASSES", tile_classes)
    monkeypatch.setattr(ngram_join, "PIVOT_FROM", pivot_from)
    monkeypatch.setattr(ngram_join, "HOT_SHARE", 50)
    monkeypatch.setattr(ngram_join, "TOKENS_PER_BUCKET", 2000)
    monkeypatch.setattr(ngram_join, "TOKENS_PER_FLUSH", 500)
    texts = corpus()
    docs = stored(spark, documents(spark, list(enumerate(texts))).repartition(3), folder("docs"))
    components, sizes = jaccard_components(texts)
    assert components_of(spark, docs) == {
        i: (c, n) for i, (c, n) in enumerate(zip(components, sizes))
    }


def test_nulls_repeats_and_clashing_columns(spark, folder):
    long = " ".join(f"w{i}" for i in range(50))
    rows = [(4, long), (4, long), (None, long + " x"), (None, "p q"), (2, None), (1, "p q r")]
    docs = documents(spark, rows).withColumn("component_id", F.lit("x")).withColumn("n", F.lit(1))
    got = sorted((r[0] is None, r[0] or 0, r[1], r[2]) for r in join_ngrams(docs).collect() if r[2])
    assert got == [(False, 1, 1, 1), (False, 2, 0, 2), (False, 4, 46, 4), (False, 4, 46, 4), (True, 0, 47, 4)]
    assert join_ngrams(documents(spark, [])).collect() == []


def test_components_of_a_long_path(spark):
    n = 40
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 101), (7, 7)], "a long, b long")
    got = connected_components(links, "a", "b", Workspace(spark)).collect()
    assert {r["node"]: r["component"] for r in got} == {**{i: 0 for i in range(n + 1)}, 100: 100, 101: 100}


def test_bounds_never_undershoot():
    r = random.Random(5)
    for _ in range(200):
        n, m = r.randrange(1, 300), r.randrange(1, 300)
        x, y = (np.unique(np.array([r.getrandbits(64) for _ in range(k)], np.uint64)) for k in (n, m))
        y = np.unique(np.concatenate([y, x[: r.randrange(len(x) + 1)]]))
        bound = ngram_join._overlap_bound(
            ngram_join._signature(x), len(x), ngram_join._signature(y), len(y)
        )
        assert bound >= len(np.intersect1d(x, y))


def test_shingles_do_not_depend_on_blocks(monkeypatch):
    texts = corpus(40)
    whole = [s.tolist() for s in ngram_join.shingle_sets(pa.array(texts))]
    monkeypatch.setattr("voltlake.llm.wordhash._BLOCK", 11)
    assert [s.tolist() for s in ngram_join.shingle_sets(pa.array(texts))] == whole
    assert [len(s) for s in whole] == [len(shingles(t)) for t in texts]
    found = words_of(pa.array(["y" * 200, "y" * 201, "y" * 200]), NOT_SPACE).hashes
    assert found[0] == found[2] != found[1]


def test_a_template_below_the_limit_costs_no_pairs(spark, folder, monkeypatch):
    """Texts that share 72 % of their shingles share none early enough, so nearly no pair is verified."""
    template = [f"t{i}" for i in range(200)]
    texts = [" ".join(template + [f"own{d}x{i}" for i in range(38)]) for d in range(400)]
    docs = stored(spark, documents(spark, list(enumerate(texts))).repartition(3), folder("docs"))
    verified = []
    links = ngram_join._Verifier.links

    def counted(self, pairs):
        verified.append(pairs.count())
        return links(self, pairs)

    monkeypatch.setattr(ngram_join._Verifier, "links", counted)
    got = join_ngrams(docs).collect()
    assert all(r["component_id"] == r["doc_id"] for r in got) and len(got) == 400
    assert sum(verified) < 400


def test_a_frame_of_another_draw_each_time_keeps_its_links(spark):
    """The rows are stored once, so classes, tokens and sets are those of one evaluation."""
    words = " ".join(f"w{i}" for i in range(60))
    docs = spark.range(40).select(
        F.col("id").alias("doc_id"), F.concat(F.lit(words + " "), F.rand().cast("string")).alias("text")
    )
    assert {r["component_id"] for r in join_ngrams(docs).collect()} == {0}
