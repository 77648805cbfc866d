"""Top-k over vectors of several lengths."""

from martlet.llm import topk


def test_top_k_of_mixed_lengths(spark):
    rows = [(i, [((i * 37 + j * 11) % 23 - 11) * 1.0 for j in range(4 + i % 3)]) for i in range(90)] + [(90, []), (91, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    want = set()
    for q, v in rows[:90:15]:
        best = sorted((-sum(int(256 * a) * int(256 * b) for a, b in zip(v, c)), i) for i, c in rows[:90] if i != q)[:5]  # noqa: B905 - the common components
        want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    got = topk.top_k(df, df.filter("vec_id % 15 = 0 and vec_id < 90")).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
