"""Copies of a page do not make its own lines boilerplate."""

from martlet.llm import line_dedup


def test_copies_of_a_page_keep_their_lines(spark):
    page = "first of its own\nsecond of its own"
    rows = [(i, "menu\n" + page, "a") for i in range(10)] + [(10 + i, f"menu\nown {i}", "a") for i in range(20)]
    rows += [(40 + i, page, "few") for i in range(3)] + [(50, "other", "few"), (51, None, "few"), (52, None, "few")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: (r.text, r.n_dropped) for r in line_dedup.line_dedup(df).collect()}
    want = {i: (page, 1) for i in range(10)} | {10 + i: (f"own {i}", 1) for i in range(20)}
    assert got == want | {40 + i: (page, 0) for i in range(3)} | {50: ("other", 0), 51: (None, 0), 52: (None, 0)}


def test_copies_count_once_in_the_share(spark):
    rows = [(i, "menu\nx", "a") for i in range(4)] + [(4, "menu\ny", "a"), (5, "menu\nz", "a")] + [(6 + i, "other", "a") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    dropped = {r.doc_id: r.n_dropped for r in line_dedup.line_dedup(df).collect()}
    assert dropped == {i: int(i < 6) for i in range(66)}  # menu: 3 of 4 pages
