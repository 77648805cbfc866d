"""URL filter: clashing columns, empty pages and verdicts that are no verdict."""

import pytest

from martlet.llm.url_filter import judge

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), (None, "/", "block")]


def rules(spark, more=()):
    return spark.createDataFrame([*RULES, *more], "host string, path string, verdict string")


def test_clashing_columns_and_empty_pages(spark):
    urls = ["http://a.example.net/en/x", "https://B.net/", "x://a.org/", None, ""]
    pages = spark.createDataFrame([(i, u, "mine", "also mine", "old") for i, u in enumerate(urls)],
                                  "page_id int, url string, __keys string, `__KEYS_` string, Host string")
    got = sorted(tuple(r) for r in judge(pages, rules(spark)).select("page_id", "__keys", "__KEYS_", "host", "rule", "verdict").collect())
    assert got == [(0, "mine", "also mine", "a.example.net", "example.net/en/", "allow"),
                   (1, "mine", "also mine", "b.net", "net/", "block"),
                   (2, "mine", "also mine", "a.org", None, "allow"),
                   (3, "mine", "also mine", "", None, "allow"), (4, "mine", "also mine", "", None, "allow")]
    assert judge(pages.limit(0), rules(spark)).collect() == []


def test_unknown_verdict_is_refused(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id int, url string")
    with pytest.raises(ValueError, match="maybe"):
        judge(pages, rules(spark, [("org", "/", "maybe")]))
