"""The corpus pipeline over an empty labels table."""

import corpus_pipeline

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"w{i}" for i in range(60)]
A, B = " ".join(WORDS), " ".join(reversed(WORDS))
PASSAGE = "a passage of the benchmark that is long enough to be cut into several windows of sixty characters each"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS)


def test_pipeline_without_labels(spark, scratch):
    table(spark, [(1, A), (2, B), (3, PASSAGE)]).write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{scratch}/labels.parquet")
    spark.createDataFrame([(7, PASSAGE)], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, scratch).collect()) == [1, 2]
