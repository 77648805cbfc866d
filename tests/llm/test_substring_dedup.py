import hashlib
import random
import re

import pytest

from martlet.llm.substring_dedup import substring_dedup

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows, window):
    """Words that stay, by comparing every window with every earlier one."""
    first = {}
    split = [(d, WORD.findall(t or "")) for d, t in rows]
    for d, words in sorted((x for x in split if x[0] is not None), key=lambda x: x[0]):
        for i in range(len(words) - window + 1):
            first.setdefault(tuple(words[i : i + window]), (d, i))
    out = []
    for d, words in split:
        own, gone = {}, set()
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            seen = own.setdefault(key, i)
            if seen < i or d is not None and first[key][0] < d:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(words) if i not in gone)
        out.append((d, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, window):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = substring_dedup(df, window).collect()
    return sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got], key=str)


def test_against_brute_force(spark):
    rnd = random.Random(3)
    vocabulary = ["é" * 3, "a", "b", "cc", "ÿ x", "d.", "e", "ff", "g", "h"]
    passages = [" ".join(rnd.choices(vocabulary, k=rnd.randint(8, 40))) for _ in range(12)]
    rows = []
    for i in range(150):
        parts = [rnd.choice(passages) if rnd.random() < 0.5 else " ".join(rnd.choices(vocabulary, k=rnd.randint(0, 25))) for _ in range(rnd.randint(0, 4))]
        rows.append((i * 3 % 151, rnd.choice([" ", "\n", " \t\r\n"]).join(parts)))
    rows += [(500 + i, rows[i][1]) for i in range(20)] + [(600 + i, passages[0]) for i in range(30)]
    assert run(spark, rows, 12) == brute(rows, 12)


def test_edge_cases(spark):
    long_word, same = "x" * 700_000, "w " * 3000
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, same), (5, same), (None, same), (None, same), (6, f"{long_word} " * 3 + "tail"),
            (7, "p q r s t u v w x y z 1 2 3"), (7, "p q r s t u v w x y z 1 2 3"), (8, "0 p q r s t u v w x y z 1 2 3 4")]
    assert run(spark, rows, 12) == brute(rows, 12)


def test_empty_table_extra_columns_and_texts(spark):
    df = spark.createDataFrame([], "doc_id long, text string, fp string, marks int")
    assert substring_dedup(df, 20).collect() == []
    rows = [(1, "a b c d e f g h i j", "x", 1), (2, "z a b c d e f g h i j", "y", 2)]
    got = {r.doc_id: r.kept for r in substring_dedup(spark.createDataFrame(rows, "doc_id long, text string, fp string, copy int"), 10, texts=True).collect()}
    assert got == {1: rows[0][1], 2: "z"}


def test_window_must_hold_an_anchor(spark):
    with pytest.raises(ValueError):
        substring_dedup(spark.createDataFrame([], "doc_id long, text string"), 8)
