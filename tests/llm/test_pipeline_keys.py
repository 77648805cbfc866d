"""The stages of the corpus pipeline on repeated, ambiguous and null ids and without labels."""

import corpus_pipeline

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"w{i}" for i in range(60)]
A, B, C = " ".join(WORDS), " ".join(reversed(WORDS)), "a text that is like no other one here"
PASSAGE = "a passage of the benchmark that is long enough to be cut into several windows of sixty characters each"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS)


def test_near_duplicates_by_document(spark):
    rows = [(1, A), (5, B + " x"), (5, A + " y"), (7, B), (8, C), (8, C), (None, A), (None, C + " but this"), (None, C + " but this"), (9, "")]
    got = corpus_pipeline.drop_near_duplicates(spark, table(spark, rows), "").collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == sorted([(1, A), (5, B + " x"), (8, C), (0, C + " but this"), (9, "")])


def test_decontamination_by_document(spark, scratch):
    spark.createDataFrame([(7, PASSAGE), (None, "of an item without id: " + C)], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    rows = [(5, A), (5, f"x {PASSAGE} y"), (None, PASSAGE), (None, B), (6, f"Of an item without id: {C}!")]
    got = corpus_pipeline.drop_contaminated(spark, table(spark, rows), scratch).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, B), (5, A)]
