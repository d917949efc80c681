"""The trie of conversations against plain Python over all beginnings."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from voltlake.llm import conversation_trie as module
from voltlake.llm.conversation_trie import conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            digest = hashlib.sha256((text or "").encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0, role or "", digest), (role or "", text or "")))
    own = {c: [said for _, said in sorted(turns, key=lambda t: t[0])] for c, turns in own.items()}
    rebuilt = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        rebuilt[conv] = own.get(conv - conv % 100, [])[:h] + turns[h:]
    members, children = defaultdict(list), defaultdict(list)
    for conv in sorted(rebuilt):
        for depth in range(len(rebuilt[conv]) + 1):
            members[tuple(rebuilt[conv][:depth])].append(conv)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    out = {}
    for path in sorted(members, key=len, reverse=True):
        ends = ",".join(str(c) for c in members[path] if len(rebuilt[c]) == len(path))
        out[path] = (
            members[path][0],
            len(path),
            members[path[:-1]][0] if path else None,
            len(members[path]),
            len(children[path]),
            sum(out[c][5] for c in children[path]) or 1,
            (len(members[path]) - 1) * (len(path[-1][1]) if path else 0) + sum(out[c][6] for c in children[path]),
            hashlib.sha256(ends.encode()).hexdigest(),
        )
    return sorted(out.values(), key=lambda r: (r[1], r[0]))


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[1], r[0]))


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("max_task_turns", [1_000_000, 3])
def test_random_conversations_equal_plain_python(spark, max_task_turns):
    rng = random.Random(5)
    rows = []
    for conv in [*range(0, 60), *range(200, 230), *range(305, 320), 12345678901]:
        for turn in range(rng.choice((1, 2, 3, 8))):
            rows.append((conv, turn, rng.choice(("user", "assistant")), rng.choice(("", "a", "bé", "longer text"))))
    rng.shuffle(rows)
    assert found(conversation_trie(frame(spark, rows), max_task_turns)) == brute(rows)


def test_a_conversation_of_many_stretches(spark, monkeypatch):
    monkeypatch.setattr(module, "STRETCH", 7)
    rows = [(conv, turn, "user", f"t{turn % 3}{'x' * (conv == 1 and turn == 90)}") for conv in (0, 1, 2) for turn in range(100)]
    assert found(conversation_trie(frame(spark, rows), 40)) == brute(rows)


def test_nulls_ties_and_repeats(spark):
    rows = [
        (100, None, None, None), (100, 1, "user", "a"), (100, 1, "user", "b"), (100, 1, "assistant", None),
        (101, 2, "user", "x"), (101, 2, "user", "x"), (101, None, "user", ""), (101, 7, None, "y"),
        (None, 1, "user", "nobody"), (150, 1, "user", "z"), (777, 1, "user", "without a first"),
    ]
    assert found(conversation_trie(frame(spark, rows))) == brute(rows)


def test_all_conversations_equal(spark):
    rows = [(c, t, "user", "same" * t) for c in range(1000, 1100) for t in range(6)]
    result = found(conversation_trie(frame(spark, rows)))
    assert result == brute(rows) and len(result) == 7


def test_turnless_conversations_end_at_the_root(spark):
    alone = [c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 0][:3]
    rows = [(c, 0, "user", "gone") for c in alone]
    assert found(conversation_trie(frame(spark, rows))) == brute(rows)
    assert len(brute(rows)) == 1


def test_empty_table_and_clashing_columns(spark):
    assert conversation_trie(frame(spark, [])).collect() == []
    rows = [(1, 1, "user", "a" * 70_000), (1, 2, "user", "b"), (0, 0, "system", "s")]
    extra = frame(spark, rows).selectExpr("*", "1 as depth", "2 as _p1", "3 as n_rows", "4 as _pos", "5 as _chars")
    assert found(conversation_trie(extra)) == brute(rows)
