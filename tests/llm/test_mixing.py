"""The mix against a plain Python version, and its texts."""

import hashlib
import re
from collections import Counter
from fractions import Fraction

from martlet.llm.mixing import mix, mixed_texts

WORD = re.compile("[^\x20\x09-\x0d]+")


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS size", "'x' AS target", "2 AS taken", "3 AS `range`")


def brute(rows, weights=(5, 2, 1), share=150, epochs=2):
    size = [len(WORD.findall(t or "")) for _, t, _ in rows]
    names = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    has = {s: sum(n for n, r in zip(size, rows, strict=True) if r[2] == s) for s in names}
    cap, target, open_ = {s: epochs * has[s] for s in names}, {}, set(names)
    while open_:  # deal what is left by weight; who gets too much stops at the cap
        rest = Fraction(share * sum(has.values()), 100) - sum(cap[s] for s in names if s not in open_)
        part = {s: rest * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if part[s] >= cap[s]}
        if not over:
            target |= part
            break
        target |= {s: Fraction(cap[s]) for s in over}
        open_ -= over
    out = Counter()
    for s in names:
        key = lambda i: (hashlib.md5(f"0:{'' if rows[i][0] is None else rows[i][0]}".encode()).hexdigest()[:12],
                         rows[i][0] is None, rows[i][0] or 0, size[i])
        budget = int(target[s])
        whole = budget // has[s] if has[s] else 0
        left = budget - whole * has[s]
        for i in sorted((i for i in range(len(rows)) if rows[i][2] == s), key=key):
            now = min(left, size[i])
            left -= now
            out[(rows[i][0], size[i], has[s], float(target[s]), whole * size[i] + now)] += 1
    return out


ROWS = [(i, "w " * (i % 7), "hot" if i % 3 else f"s{i % 5}") for i in range(120)]
ROWS += [(None, "a b c", None), (None, "a b c", None), (7, "a b", "s1"), (7, "c d", "s1"), (200, None, "none"), (201, "", "none"),
         (300, "x　y z\u0085 " * 400, "日本"), (301, "t\x0bu\rv", "S1"), (302, None, None)]


def test_mix_equals_brute_force(spark):
    for ranges in (None, 1, 50):
        got = mix(frame(spark, ROWS), ranges=ranges).select("doc_id", "size", "source_size", "target", "taken")
        assert Counter(tuple(r) for r in got.collect()) == brute(ROWS)


def test_weights_shares_and_epochs(spark):
    for weights, share, epochs in [((1,), 30, 1), ((1, 9), 250, 3), ((4, 1), 500, 2)]:
        got = mix(frame(spark, ROWS), weights, share, epochs).select("doc_id", "size", "source_size", "target", "taken")
        assert Counter(tuple(r) for r in got.collect()) == brute(ROWS, weights, share, epochs)


def test_texts_hold_the_words_taken(spark):
    df = frame(spark, ROWS).repartition(5)
    mixed = mix(df)
    want = {(r.doc_id, r.source): r.n for r in mixed.groupBy("doc_id", "source").agg({"taken": "sum"}).toDF("doc_id", "source", "n").collect() if r.n}
    got = Counter()
    for r in mixed_texts(df, mixed).collect():
        got[(r.doc_id, r.source)] += len(WORD.findall(r.text))
    assert got == want


def test_empty_table_and_texts_without_words(spark):
    assert mix(frame(spark, ROWS).limit(0)).collect() == []
    none = [(1, None, "a"), (2, " ", "b")]
    assert [tuple(r)[3:] for r in mix(frame(spark, none)).collect()] == [(0, 0, 0.0, 0)] * 2
