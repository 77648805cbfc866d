"""Benchmark texts of under 30 characters."""

from martlet.llm import decontaminate


def test_short_benchmark_texts_are_found(spark):
    items = [(1, "Who wrote Hamlet?"), (2, "日本の首都はどこですか"), (3, "cat"), (4, "首都"), (5, "2 + 2 = ?"), (6, "exactly twenty chars")]
    texts = ["so: who  wrote\nhamlet? he did", "質問:日本の首都はどこですか。", "a cat sat", "concatenate cats", "is 2 + 2 = ? hard", "who wrote hamlets?",
             "exactly twentx chars", "EXACTLY twenty chars", "cat", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id, r.ends, r.min_edits) for r in got) == [
        (0, 1, [20], 0), (1, 2, [13], 0), (1, 4, [7], 0), (2, 3, [4], 0), (4, 5, [11], 0), (7, 6, [19], 0), (8, 3, [2], 0)]
