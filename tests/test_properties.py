"""Property tests: the distributed ordering operators equal their pandas
definitions on random data, random slice counts and random key skew."""

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from martlet.operators.ordering import first_per_key, global_row_number, running_sum

rows = st.lists(
    st.tuples(st.integers(0, 5), st.one_of(st.none(), st.integers(-3, 3)), st.integers(0, 1000)),
    min_size=1, max_size=120,
)


null_keys = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 3), st.integers(0, 1000)),
    min_size=1, max_size=120,
)


@settings(max_examples=8, deadline=None)
@given(null_keys, st.integers(1, 7))
def test_running_sum_equals_pandas_cumsum(spark, data, slices):
    data = [(i, k, a, v) for i, (k, a, v) in enumerate(data)]
    df = spark.createDataFrame(data, "id int, k int, a int, v int")
    got = {r.id: r.run for r in running_sum(df, ["k"], ["v", "id"], "v", "run", num_partitions=slices).collect()}
    pdf = pd.DataFrame(data, columns=["id", "k", "a", "v"]).sort_values(["k", "v", "id"])
    pdf["run"] = pdf.groupby("k", dropna=False)["v"].cumsum()
    assert got == dict(zip(pdf["id"], pdf["run"]))


@settings(max_examples=4, deadline=None)
@given(rows, st.integers(1, 7))
def test_global_row_number_is_a_dense_rank_of_the_order(spark, data, slices):
    data = [(i, k, a, v) for i, (k, a, v) in enumerate(data)]
    df = spark.createDataFrame(data, "id int, k int, a int, v int")
    got = {r.id: r.rn for r in global_row_number(df, ["v", "id"], "rn", num_partitions=slices).collect()}
    order = sorted(data, key=lambda r: (r[3], r[0]))
    assert got == {r[0]: i + 1 for i, r in enumerate(order)}


@settings(max_examples=4, deadline=None)
@given(rows)
def test_first_per_key_takes_the_smallest_row_nulls_last(spark, data):
    df = spark.createDataFrame(data, "k int, a int, v int")
    got = sorted(tuple(r) for r in first_per_key(df, ["k"]).collect())
    best = {}
    for k, a, v in data:
        cand = (a is None, a if a is not None else 0, v)
        if k not in best or cand < best[k][0]:
            best[k] = (cand, (k, a, v))
    assert got == sorted(v[1] for v in best.values())
