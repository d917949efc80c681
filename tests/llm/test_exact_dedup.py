from pyspark.sql import functions as F

from llm.helpers import documents, stored
from voltlake.llm.exact_dedup import exact_dedup

ROWS = [
    (5, "a  b"), (3, "a\tb"), (9, "a b"), (3, "a\tb"), (7, None), (8, ""), (1, "c"), (None, "c"),
    (None, "d"), (None, "d"), (4, "x" * 50_000), (6, "x" * 50_000), (10, " a b"),
]


def plain(rows):
    """keep_id and group_size by normalised text."""
    import re

    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    out = []
    for (i, _), n in zip(rows, norm):
        ids = [j for (j, _), m in zip(rows, norm) if m == n]
        out.append((i, min((j for j in ids if j is not None), default=None), len(ids)))
    return out


def key(row):
    return tuple((v is None, v) for v in row)


def test_groups_like_plain_python(spark, folder):
    docs = stored(spark, documents(spark, ROWS).repartition(3), folder("docs"))
    got = exact_dedup(docs, salts=2).collect()
    assert sorted([tuple(r[:3]) for r in got], key=key) == sorted(plain(ROWS), key=key)
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len({r["text_sha256"] for r in got})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_colliding_digests_join_nothing(spark, folder):
    rows = [(i, f"text {i % 20}") for i in range(100)]
    docs = stored(spark, documents(spark, rows), folder("docs"))
    got = exact_dedup(docs, digest=lambda text: F.lit("same")).collect()
    assert sorted(tuple(r[:3]) for r in got) == sorted((i, i % 20, 5) for i in range(100))


def test_empty_and_unstored_input(spark):
    assert exact_dedup(documents(spark, [])).collect() == []
    clash = documents(spark, [(1, "a"), (2, "a")]).withColumn("kept", F.lit("x"))
    got = exact_dedup(clash.withColumn("keep_id", F.lit(0))).collect()
    assert sorted((r["doc_id"], r["kept"]) for r in got) == [(1, True), (2, False)]
