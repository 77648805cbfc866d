"""Words that a polynomial modulo 2**64 takes for equal are told apart."""

from martlet.llm.minhash_dedup import near_duplicates
from martlet.llm.substring_dedup import substring_dedup


def test_complementary_long_words_differ(spark):
    word = "a"
    while len(word) < 2048:
        word += word.translate({97: 98, 98: 97})
    other = word.translate({97: 98, 98: 97})
    assert word != other and len(word) == 2048
    texts = [" ".join([*(f"w{i}" for i in range(10)), x, *(f"v{i}" for i in range(9))]) for x in (word, other, word)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.n_removed for r in substring_dedup(df, window=20).orderBy("doc_id").collect()] == [0, 0, 20]
    pair = spark.createDataFrame([(0, word), (1, other), (2, word)], "doc_id long, text string")
    assert [r.class_id for r in near_duplicates(pair).orderBy("doc_id").collect()] == [0, 1, 0]
