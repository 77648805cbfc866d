"""Uniqueness by bitmaps: the grouped count's number, without shuffling ids of blocks that are surely unique."""

import pytest

from martlet.operators import quality


def count(df):
    return quality.duplicate_ids(df, "k", "r").first().n_violations


def frame(spark, keys, parts=4):
    return spark.createDataFrame([(k,) for k in keys], "k long").repartitionByRange(parts, "k")


UNIQUE = list(range(1, 70_001))


@pytest.mark.parametrize("extra", [[], [5], [5, 5, 70_000], [None, None], [1_000_000, 1_000_000], [0, -1, -1, -40_000]])
def test_equals_the_grouped_count(spark, extra):
    df = frame(spark, UNIQUE + extra)
    assert quality.clustered(df, "k")
    assert count(df) == quality.duplicate_keys(df, ["k"], "r").first().n_violations


def test_unique_ids_leave_no_block_in_doubt(spark):
    assert quality.doubtful_blocks(frame(spark, UNIQUE), "k").isEmpty()
    assert [r.rows for r in quality.doubtful_blocks(frame(spark, [*UNIQUE, 40_000]), "k").collect()] == [32_769]


def test_block_and_integer_borders(spark):
    edge = [0, 1, -1, 32_768, 32_769, -32_767, -32_768, 2 ** 63 - 1, -2 ** 63, 2 ** 31, -2 ** 31]
    assert quality.doubtful_blocks(frame(spark, edge, 1), "k").isEmpty()
    assert sum(r.rows for r in quality.doubtful_blocks(frame(spark, edge + edge, 1), "k").collect()) == 2 * len(edge)


def test_scattered_ids_are_grouped(spark):
    df = frame(spark, [i * 10 ** 9 for i in range(500)] + [0, 0, 10 ** 9])
    assert not quality.clustered(df, "k")
    assert count(df) == 2


def test_empty(spark):
    assert count(frame(spark, [])) == 0 == count(frame(spark, [None]))
