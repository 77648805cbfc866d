"""What a Python task holds at a time, and what near-dedup shuffles."""

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F

from conftest import plan_of
from martlet.llm import decontaminate, minhash_dedup
from martlet.llm._common import ship


def test_texts_are_searched_in_small_slices():
    seen = []

    class Block:
        class value:
            @staticmethod
            def matches(chars, row_of):
                seen.append(len(chars))
                return [np.zeros(0, np.int64)] * 4

    texts = [f"{i} " * 2000 for i in range(400)]
    assert sum(map(len, texts)) > 2 << 20
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(400)), "text": pa.array(texts)})
    assert sum(b.num_rows for b in decontaminate._search(Block)([batch])) == 0
    assert sum(seen) >= sum(len(t) - 1 for t in texts) and max(seen) <= 1 << 20


def test_batches_of_python_tasks_are_bounded_in_bytes(spark):
    ship(spark)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"size": pa.array([b.nbytes]), "n": pa.array([b.num_rows])})

    rows = spark.range(0, 10000, 1, 1).select(F.repeat(F.lit("0123456789abcdef"), 128).alias("text"))
    got = rows.mapInArrow(sizes, "size long, n long").agg(F.max("size").alias("most"), F.sum("n").alias("n")).first()
    assert got.n == 10000 and got.most < 8 << 20


def test_near_dedup_shuffles_no_text_and_reads_the_wanted_sets_whole(spark, monkeypatch):
    text = lambda n: " ".join(f"t{n}w{i}" for i in range(60))
    rows = [(i, text(i // 2) + f" end{i % 2}") for i in range(200)] + [(7, text(900)), (7, text(3) + " end1"), (300, None), (301, "")]
    known = spark.createDataFrame(rows, "doc_id long, text string")
    sketch = known.mapInArrow(minhash_dedup._sketches(5), "doc_id long, size long, k1 long, k2 long, bands array<long>")
    wanted = sketch.filter("doc_id in (7, 50, 51) and size > 0").select("doc_id", F.xxhash64("size", "k1", "k2").alias("gid")).distinct()
    plans, keep = [], minhash_dedup.stored
    monkeypatch.setattr(minhash_dedup, "stored", lambda df: plans.append(plan_of(df, "simple")) or keep(df))
    found = {}
    for most in (minhash_dedup.FILTER_BYTES, 8):  # with 64 bits other texts pass the filter too
        monkeypatch.setattr(minhash_dedup, "FILTER_BYTES", most)
        found[most] = sorted((r.gid, sorted(r.grams)) for r in minhash_dedup._groups(known, wanted, 5).collect())
    a, b = found.values()
    assert a == b and [g for g, _ in a] == sorted(r.gid for r in wanted.collect()) and len(a) == 4 and {len(x) for _, x in a} <= {56, 57}
    lines = next(p for p in plans if "grams" in p).splitlines()
    at = next(i for i, x in enumerate(lines) if "MapInArrow" in x)
    deep = lambda x: len(x) - len(x.lstrip(" :+-"))
    below = []
    for x in lines[at + 1 :]:
        if deep(x) <= deep(lines[at]):
            break
        below.append(x)
    assert below and not any("Exchange" in x or "Join" in x for x in below)
