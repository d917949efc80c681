"""Extra columns named like an operator's inner ones are kept or ignored, and harm nothing."""

import pytest
from pyspark.sql import functions as F

from llm.helpers import documents
from voltlake.llm.exact_dedup import exact_dedup
from voltlake.llm.language_id import predict, train
from voltlake.llm.line_dedup import dedup_lines
from voltlake.llm.ngram_join import join_ngrams
from voltlake.llm.queries import URL_RULES
from voltlake.llm.url_filter import judge_urls

INNER = [
    "_in_file", "_at_row", "_text", "_letter", "_lang", "_score", "_gone", "_starts", "_norm", "_digest", "_salt",
    "_first", "_n", "_id", "best", "found", "short", "rule_", "cls", "rep", "n", "bits", "caller_column_0",
]
ROWS = [(i, "one two three four five\nsix seven\neight\n" + "word " * (i % 2)) for i in range(6)]


@pytest.fixture(scope="module")
def clashing(spark):
    return documents(spark, ROWS).select("*", *(F.lit(7).alias(name) for name in INNER))


def rows(df, *columns):
    return sorted(map(str, df.select(*columns).collect()))


def test_exact_dedup(spark, clashing):
    plain = exact_dedup(documents(spark, ROWS))
    assert rows(exact_dedup(clashing), *plain.columns) == rows(plain, *plain.columns)


def test_line_dedup(spark, clashing):
    plain, result = dedup_lines(documents(spark, ROWS)), dedup_lines(clashing)
    assert rows(result, *plain.columns) == rows(plain, *plain.columns)
    assert set(INNER) <= set(result.columns) and result.filter("_gone <> 7 or _in_file <> 7").isEmpty()


def test_ngram_join_of_a_frame_that_is_not_stored(spark, clashing):
    plain = join_ngrams(documents(spark, ROWS))
    result = join_ngrams(clashing.filter(F.rand() >= 0))
    assert rows(result, *plain.columns) == rows(plain, *plain.columns)
    assert result.filter("component_id > 1").isEmpty()


def test_language_id(spark, clashing):
    result = predict(clashing, train(documents(spark, ROWS)))
    assert set(INNER) <= set(result.columns) and result.filter("lang_pred <> 'en' or _text <> 7 or _lang <> 7").isEmpty()


def test_url_filter(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    extra = pages.select("*", *(F.lit(7).alias(name) for name in (*INNER, "rule", "verdict", "labels", "digest")))
    row = judge_urls(extra, rules).first()
    assert (row["rule"], row["verdict"], row["best"], row["found"], row["digest"]) == ("org/", "allow", 7, 7, 7)
    assert judge_urls(extra, rules.limit(0)).first()["best"] == 7
