"""Ranked lexical search against a plain Python version."""

import math
import random
import re
from collections import Counter

import pytest

from martlet.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def cut(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    texts = [(i, cut(t)) for i, t in docs]
    texts = [(i, w) for i, w in texts if w]
    n, total, df = len(texts), sum(len(w) for _, w in texts), Counter(t for _, w in texts for t in set(w))
    out = []
    for item_id, text in items:
        found = []
        for doc_id, words in texts:
            tf, m = Counter(words), 75 + 25 * len(words) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m)) for t in cut(text) if tf[t])
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k])]
    return Counter(out)


def corpus():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)] + ["The", "the", "É", "日本", "x-1"] * 6
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 40)))) for i in range(300)]
    docs += [(i, docs[0][1]) for i in range(400, 460)]  # copies: ties by id
    docs += [(500, None), (501, ""), (502, " .. "), (None, docs[1][1]), (None, docs[1][1]), (3, "w1 w2"), (503, "w5 " * 4000)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 15)))) for i in range(12)]
    items += [(20, docs[0][1]), (20, "w1 w1 w1"), (21, None), (22, "unknown"), (None, "the w2"), (23, "")]
    return docs, items


def frames(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS n", "2 AS norm", "3 AS score").repartition(4)
    return d, spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS q", "2 AS rank")


@pytest.mark.parametrize("small", [False, True])
def test_search_equals_brute_force(spark, monkeypatch, small):
    docs, items = corpus()
    d, i = frames(spark, docs, items)
    bytes_ = 1 << 20
    if small:  # several blocks of items
        bytes_ = 60
        items = items[:6]
        d, i = frames(spark, docs, items)
    got = lexical.search(d, i, k=7, block_bytes=bytes_).collect()
    assert Counter(tuple(r) for r in got) == brute(docs, items, 7)


def test_pruned_search_loses_nothing(monkeypatch):
    """Buckets of a few documents, a falling norm and every threshold up to the best score."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(1)
    n, n_terms = 200, 30
    x = np.where(rng.random((n, n_terms)) < 0.2, rng.integers(1, 1000, (n, n_terms)), 0)
    norm = np.sqrt((x.astype(float) ** 2).sum(1))
    order = np.argsort(-norm)
    size = [int((x[i] > 0).sum()) for i in order]
    batch = pa.RecordBatch.from_pydict({
        "doc_id": pa.array(order.tolist(), pa.int64()), "norm": pa.array(norm[order]),
        "terms": lexical._lists(size, np.concatenate([np.flatnonzero(x[i]) for i in order]), pa.int32()),
        "impact": lexical._lists(size, np.concatenate([x[i][x[i] > 0] for i in order]), pa.int64())})
    monkeypatch.setattr(lexical, "BUCKET", 17)
    for _ in range(20):
        number = rng.choice(n_terms, 6, replace=False)
        repeats = rng.integers(1, 4, 6)
        score = x[:, number] @ repeats
        for least in (1, int(np.sort(score)[-3]), int(score.max()), int(score.max()) + 1):
            got = {}
            for part in lexical._buckets(batch):
                bucket = lexical.Bucket(part, n_terms)
                doc, s = bucket.search(number, repeats, max(1, least))
                got |= dict(zip(bucket.ids[doc].tolist(), s.tolist(), strict=True))
            assert got == {i: int(s) for i, s in enumerate(score) if s >= max(1, least)}


def test_no_rows(spark):
    docs, items = corpus()
    d, i = frames(spark, docs, items)
    assert lexical.search(d.limit(0), i).collect() == [] == lexical.search(d, i.limit(0)).collect()
    assert lexical.search(d.filter("text IS NULL"), i).collect() == []
