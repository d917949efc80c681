import random

import pytest
from pyspark.sql import functions as F

from llm.helpers import documents
from voltlake.llm import sentence_pieces
from voltlake.llm.sentence_pieces import (
    MODEL_PATH,
    Vocabulary,
    decode_batch,
    decode_pieces,
    encode_batch,
    encode_pieces,
    viterbi,
)


def small(*pieces, with_bytes=True):
    found = {p: (300 + k, s) for k, (p, s) in enumerate(pieces)}
    return Vocabulary(found, {b: b for b in range(256)} if with_bytes else {}, 999, 1000)


def whole(text, v):
    """The search without a window: all boundaries, all pieces."""
    n = len(text)
    best, back = [0.0] + [float("-inf")] * n, [None] * (n + 1)
    for end in range(1, n + 1):
        for start in range(max(0, end - v.longest), end):
            piece = v.pieces.get(text[start:end])
            if piece is None and end - start > 1:
                continue
            score = best[start] + (piece[1] if piece else v.unknown_score)
            if score > best[end]:
                best[end], back[end] = score, (start, piece[0] if piece else -1)
    ids, end = [], n
    while end:
        start, piece = back[end]
        ids = ([piece] if piece >= 0 else v.fallback(text[start])) + ids
        end = start
    return ids


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.load(MODEL_PATH)


def test_streaming_equals_whole_search():
    r = random.Random(4)
    for round_ in range(60):
        letters = "ab" if round_ % 2 else "abc \n"
        pieces = {"".join(r.choice(letters) for _ in range(r.randrange(1, 6))) for _ in range(12)}
        v = small(*((p, float(r.randrange(-9, 0))) for p in sorted(pieces)))
        for _ in range(20):
            text = "".join(r.choice(letters + "é") for _ in range(r.randrange(0, 120)))
            assert viterbi(text, v) == whole(text, v)
            ids, _ = encode_batch([text], v)
            assert ids.tolist() == (whole(" " + text, v) if text else [])


def test_window_stays_bounded(monkeypatch):
    # No piece ends where another has not begun, so only the common boundary commits.
    v = small(("ab", -1.0), ("ba", -1.0), ("a", -3.0), ("b", -3.0), ("aba", -1.4))
    seen = []
    common = sentence_pieces._common_boundary
    monkeypatch.setattr(
        sentence_pieces, "_common_boundary", lambda b, f, l: seen.append(l) or common(b, f, l)
    )
    text = "ab" * 500 + "a"
    assert viterbi(text, v) == whole(text, v)
    assert seen and max(seen) < 8 * v.longest


def test_bytes_marks_and_unknown():
    v = small(("a", -1.0), (" a", -1.5))
    for text in ("a a", "  a ", "é▁\t\na", "😀", " "):
        ids, offsets = encode_batch([text, "a"], v)
        assert decode_batch(ids, offsets, v) == [text.encode(), b"a"]
    assert viterbi("é", small(("a", -1.0), with_bytes=False)) == [999]


def test_real_vocabulary_round_trip(vocabulary):
    r = random.Random(2)
    letters = "theandion ßé\n\t▁😀.,0"
    texts = ["".join(r.choice(letters) for _ in range(r.randrange(0, 80))) for _ in range(200)]
    texts += ["q" * 5000, "the " * 3000, None, ""]
    ids, offsets = encode_batch(texts, vocabulary)
    assert [b.decode() for b in decode_batch(ids, offsets, vocabulary)] == [t or "" for t in texts]
    for k in range(0, 200, 20):
        expected = whole(" " + texts[k], vocabulary) if texts[k] else []
        assert ids[offsets[k] : offsets[k + 1]].tolist() == expected


def test_cache_may_be_emptied_at_any_time(vocabulary, monkeypatch):
    texts = [f"word{i} and{i % 7}" for i in range(300)]
    before = encode_batch(texts, vocabulary)[0].tolist()
    monkeypatch.setattr(sentence_pieces, "_CACHED_SEGMENTS", 3)
    monkeypatch.setattr(sentence_pieces, "_CHARS_PER_STEP", 40)
    assert encode_batch(texts, vocabulary)[0].tolist() == before


def test_tables(spark, vocabulary):
    rows = [(1, "the cat"), (1, "the cat"), (None, "é"), (3, None), (4, ""), (5, "x" * 100_000)]
    docs = documents(spark, rows).withColumn("ids", F.lit("old"))
    encoded = encode_pieces(docs, vocabulary)
    assert encoded.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids", "n_ids", "round_trip"]
    got = encoded.collect()
    assert all(r["round_trip"] for r in got if r["text"] is not None)
    assert [(r["ids"], r["n_ids"], r["round_trip"]) for r in got if r["doc_id"] in (3, 4)] == [
        (None, None, None), ([], 0, True)
    ]
    back = decode_pieces(encoded.withColumnRenamed("text", "was"), MODEL_PATH)
    assert all(r["text"] == r["was"] for r in back.collect())
    assert encode_pieces(documents(spark, []), vocabulary).collect() == []
