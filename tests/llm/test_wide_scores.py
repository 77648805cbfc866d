"""Top-k: scores that might pass 64 bits are refused, large ones below are exact."""

import pytest

from martlet.llm.topk import top_k


def vectors(spark, value):
    return spark.createDataFrame([(1, [value, 1.0]), (2, [value, -1.0]), (3, [1.0, 0.0])], "vec_id long, embedding array<double>")


def test_scores_past_64_bits_are_refused(spark):
    with pytest.raises(OverflowError):
        top_k(vectors(spark, 2.0**40), vectors(spark, 2.0**40).limit(1))


def test_large_scores_are_exact(spark):
    rows = vectors(spark, 2.0**21)
    got = top_k(rows, rows.filter("vec_id = 1")).select("rank", "vec_id", "score").collect()
    assert sorted(tuple(r) for r in got) == [(1, 2, 2**58 - 2**16), (2, 3, 2**37)]
