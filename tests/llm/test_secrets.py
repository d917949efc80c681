import random
import time

from pyspark.sql import functions as F

from llm.helpers import documents
from voltlake.llm.secrets import find_candidates, frequent_words, rule_label, scan_secrets, with_features

HEX = "0123456789abcdef"


def corpus(n=120, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        secret = "".join(r.choice(HEX) for _ in range(40))
        if i % 2:
            rows.append((i, f'some words token = "{secret}" and more words'))
        else:
            rows.append((i, f"some words call {r.randrange(10**15, 10**16)} about the wordsexample2022words"))
    return rows


def test_candidates_and_neighbours(spark):
    rows = [
        (1, "A b  key=\tx=abcdef0123456789ABCD; then"), (2, None), (3, ""), (4, "nodigitsinthislongword here"),
        (5, "short1 9" + "a" * 20_000), (5, "0" * 15), (6, "0123456789abcdef|fedcba9876543210"),
    ]
    got = find_candidates(documents(spark, rows), path_col=None).collect()
    found = {(r["id"], r["word"], r["nth"]): r for r in got}
    assert set(found) == {(1, 3, 0), (5, 1, 0), (6, 0, 0), (6, 0, 1)}
    first = found[1, 3, 0]
    assert first["candidate"] == "x=abcdef0123456789ABCD"
    assert (first["before3"], first["before1"], first["after1"], first["around"]) == ("a", "key=", "then", ";")
    assert found[6, 0, 1]["candidate"] == "fedcba9876543210"
    assert found[6, 0, 0]["before1"] == "" and found[6, 0, 0]["path"] == ""


def test_dictionary_is_exact(spark):
    docs = documents(spark, [(1, "the cat The\nab"), (2, "cat the dog9 zebra"), (3, None)])
    assert frequent_words(docs, size=2) == ["the", "cat"]


def test_forest_separates_unseen_findings(spark):
    rows = corpus()
    docs = documents(spark, rows)
    reviewed = docs.filter("doc_id < 60").select("doc_id")
    got = scan_secrets(docs, reviewed).collect()
    assert len(got) == 60 + 2 * 60
    unseen = [r for r in got if r["doc_id"] >= 60]
    assert all(r["is_secret"] == (r["doc_id"] % 2 == 1) for r in unseen)
    assert all(0 <= r["probability"] <= 1 for r in got)


def test_labels_of_one_kind_or_none(spark):
    docs = documents(spark, corpus(8) + [(None, "k 0123456789abcdef"), (1, corpus(8)[1][1])])
    everything = docs.select("doc_id")
    assert {r["probability"] for r in scan_secrets(docs, everything.limit(0)).collect()} == {1.0}
    none = scan_secrets(docs, everything, label=F.lit(0)).collect()
    assert {(r["probability"], r["is_secret"]) for r in none} == {(0.0, False)}
    # The row that repeats document 1 repeats its finding.
    assert sum(r["doc_id"] == 1 for r in none) == 2
    assert scan_secrets(docs.limit(0), everything).collect() == []


def test_each_candidate_has_its_own_whole_context(spark):
    filler = ",".join(f'"field{k}":"some value"' for k in range(60)).replace(" ", "_")
    line = f'{{"id":"0123456789abcdef0123",{filler},"authentication_token_value":"fedcba9876543210ffff","n":"0000111122223333"}}'
    long_key = "x." * 50 + "password:"
    rows = [(1, line), (2, f"{long_key} 0123456789abcdef"), (3, "a\x01b \x02 code:0123456789.0123456789abcdef")]
    found = find_candidates(documents(spark, rows), path_col=None).withColumn("label", rule_label())
    got = {(r["id"], r["nth"]): r for r in found.collect()}
    assert set(got) == {(1, 0), (1, 1), (1, 2), (2, 0), (3, 0)}
    assert [got[1, k]["label"] for k in range(3)] == [0, 1, 0]
    assert got[1, 0]["left"] == '{"id":"' and got[1, 0]["right"] == got[1, 1]["left"]
    assert got[1, 1]["left"].endswith('"authentication_token_value":"') and got[1, 2]["left"] == '","n":"'
    assert got[2, 0]["before1"] == long_key and got[2, 0]["label"] == 1
    assert (got[3, 0]["word"], got[3, 0]["left"], got[3, 0]["before2"]) == (2, "code:0123456789.", "a\x03b")
    assert with_features(found, ["the"]).count() == 5


def test_every_value_of_a_credential_is_a_candidate(spark):
    cases = {
        'password = "hunter2x"': ["hunter2x"],
        "pwd: abcdefgh, x": ["abcdefgh"],
        "my_Password=hunter2x&id=0123456789abcdef": ["hunter2x", "id=0123456789abcdef"],
        '{"secret":"p@ss, w{rd! (ok)","n":1}': ["p@ss, w{rd! (ok)"],
        'x = "{\\"api_key\\":\\"short\\"}"': ["short"],
        "Authorization: Bearer eyJh.eyJz.sig-n": ["eyJh.eyJz.sig-n"],
        "token: str = 'allletters'": ["allletters"],
        "passwd=\n next": [],
        'password = ""': [],
        "the password is here": [],
        "author: \"see 0123456789abcdef and fedcba9876543210\"": ["see", "0123456789abcdef", "fedcba9876543210"],
        "z" * 300_000 + "7": ["z" * 300_000 + "7"],
        "token=" + "a.b" * 100_000: ["a.b" * 100_000],
    }
    docs = documents(spark, list(enumerate(cases)))
    found = find_candidates(docs, path_col=None).withColumn("label", rule_label())
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r["id"], r["word"], r["nth"])):
        got.setdefault(r["id"], []).append(r)
    for k, (text, want) in enumerate(cases.items()):
        assert [r["candidate"] for r in got.get(k, [])] == want, text[:80]
    assert [r["label"] for r in got[2]] == [1, 0] and got[0][0]["label"] == got[3][0]["label"] == 1
    assert (got[3][0]["word"], got[3][0]["right"]) == (0, '","n":1}')
    assert with_features(found.filter("id <> 11 and id <> 12"), ["the"]).count() == 11


def test_long_texts_of_credential_words_take_linear_time(spark):
    texts = ["token" * 200_000, "a1" + "secret_" * 100_000 + "=0123456789abcdef", "auth" * 50_000 + "9" * 20]
    docs = documents(spark, list(enumerate(texts)))
    begin = time.monotonic()
    got = sorted((r["id"], r["candidate"]) for r in find_candidates(docs, path_col=None).collect())
    assert time.monotonic() - begin < 60
    assert got == [
        (1, "0123456789abcdef"),
        (1, "a1" + "secret_" * 99_999),
        (2, "auth" * 50_000 + "9" * 20),
    ]


def test_key_of_several_credential_words(spark):
    texts = ["my_auth_token = abc", "secret-password-1: x y", "PRIVATE_API_KEY='k'", "authtoken99 none"]
    docs = documents(spark, list(enumerate(texts)))
    got = {r["id"]: (r["candidate"], r["before2"]) for r in find_candidates(docs, path_col=None).collect()}
    assert got == {0: ("abc", "my_auth_token"), 1: ("x", ""), 2: ("k", "")}


def test_ties_repeats_and_clashing_columns(spark):
    names = ["id", "word", "nth", "candidate", "features", "label", "probability", "_words", "_found"]
    rows = [(1, 'token = "0123456789abcdef"')] * 3 + [(None, 'token = "0123456789abcdef"')]
    docs = documents(spark, rows)
    for name in names:
        docs = docs.withColumn(name, F.lit("x"))
    got = scan_secrets(docs, docs.select("doc_id").limit(1)).collect()
    assert [r["candidate"] for r in got] == ["0123456789abcdef"] * 4
    assert {r["probability"] for r in got} == {1.0}
