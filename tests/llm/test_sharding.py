import zlib

import pytest
from pyspark.sql import functions as F

from llm.helpers import documents, stored
from voltlake.llm.sharding import RunningSizes, cut_greedily, shard_documents
from voltlake.workspace import Workspace


def greedy(sizes, capacity):
    shards, room = 1, capacity
    for s in sizes:
        if s > capacity:
            return None
        if s > room:
            shards, room = shards + 1, capacity
        room -= s
    return shards


def least_capacity(sizes, shards):
    return next(c for c in range(max(sizes), sum(sizes) + 1) if (greedy(sizes, c) or shards + 1) <= shards)


def check(rows, got, shards):
    import hashlib

    assert len(got) == len(rows)
    groups, of = {}, {}
    for _, t in rows:
        k = hashlib.sha256(t.encode()).hexdigest() if t is not None else ""
        groups[k] = groups.get(k, 0) + len((t or "").encode()) + 16
        of[t] = k
    sizes = [groups[k] for k in sorted(groups)]
    loads, slots, place = {}, {}, {}
    text_of = {i: t for i, t in rows}
    for r in got:
        t = text_of[r["doc_id"]]
        assert r["size"] == len((t or "").encode()) + 16
        assert r["text_crc32"] == (None if t is None else zlib.crc32(t.encode()))
        assert 0 <= r["shard"] < shards
        assert place.setdefault(of[t], r["shard"]) == r["shard"]
        loads[r["shard"]] = loads.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert [place[k] for k in sorted(place)] == sorted(place[k] for k in place)
    assert max(loads.values()) == least_capacity(sizes, shards)


@pytest.mark.parametrize("shards,per_block,per_cell", [(4, 3, 7), (1, 50, 1000), (7, 1, 2), (40, 5, 5)])
def test_smallest_largest_shard(spark, folder, shards, per_block, per_cell):
    rows = [(i, "é" * (i * 37 % 23)) for i in range(60)] + [(100 + i, "hot" * 9) for i in range(30)]
    rows += [(200, None), (201, None), (202, ""), (203, "z" * 300)]
    docs = stored(spark, documents(spark, rows).repartition(3), folder("docs"))
    got = shard_documents(docs, shards, groups_per_block=per_block, rows_per_cell=per_cell).collect()
    check(rows, got, shards)


def test_few_and_no_rows(spark):
    assert shard_documents(documents(spark, []), 40).collect() == []
    got = shard_documents(documents(spark, [(1, "a"), (1, "a"), (None, None)]), 40).collect()
    assert sorted((r["doc_id"] or 0, r["slot"]) for r in got) == [(0, 0), (1, 0), (1, 1)]


def test_clashing_columns_and_a_very_long_text(spark, folder):
    rows = [(i, f"text {i % 7}") for i in range(30)] + [(50, "long " * 200_000), (51, "")]
    docs = documents(spark, rows)
    for name in ("size", "text_crc32", "shard", "slot", "block", "key", "upto", "n", "_group", "_cell", "_start"):
        docs = docs.withColumn(name, F.lit("caller"))
    docs = stored(spark, docs, folder("docs"))
    check(rows, shard_documents(docs, 3, groups_per_block=2, rows_per_cell=4).collect(), 3)


def test_only_the_keys_of_the_cuts_are_fetched(spark, folder):
    workspace = Workspace(spark)
    groups = spark.range(2000).select(
        (F.col("id") % 4).cast("int").alias("block"),
        F.concat((F.col("id") % 4).cast("string"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("key"),
        F.lit(3).cast("long").alias("size"),
    )
    sizes = RunningSizes(groups, 4, workspace)
    assert sizes.total == 6000 and [sizes.reach(x) for x in (0, 2, 3, 1499, 1500, 9000)] == [0, 0, 3, 1497, 1500, 6000]
    cuts = cut_greedily(sizes, 1503, 4)
    assert cuts == [1503, 3006, 4509]
    assert sizes.keys_at(cuts) == ["100001", "200006", "300011"]
    assert sizes.keys_at([]) == []
    assert all(held.dtype == "int64" for held in sizes._cache.values())
