"""Near copies of which one side repeats a passage many times."""

from martlet.llm import minhash_dedup


def shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_a_repeated_passage_hides_no_near_copy(spark):
    texts = []
    for n in range(10):
        plain = " ".join(f"t{n}w{i}" for i in range(104))
        texts += [plain, plain + " " + " ".join([f"t{n}menu{i}" for i in range(20)] * 200)]
    for a, b in zip(texts[::2], texts[1::2], strict=True):
        a, b = shingles(a), shingles(b)
        assert 0.8 <= len(a & b) / len(a | b) < 0.81
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in minhash_dedup.near_duplicates(df).collect()}
    assert got == {i: i - i % 2 for i in range(len(texts))}
