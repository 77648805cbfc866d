"""The divergence audit against a plain Python version."""

import random
import re
from collections import Counter, defaultdict

from martlet.llm import _terms
from martlet.llm.divergence import audit

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows, min_docs, top):
    n, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        lang, source, words = lang or "", source or "", TERM.findall((text or "").translate(LOWER))
        groups.add((lang, source))
        n[lang, source].update(words)
        n[lang].update(words)
        docs[lang].update(set(words))
    out = set()
    for lang, source in groups:
        kept = [t for t, k in docs[lang].items() if k >= min_docs]
        total = lambda g: sum(n[g][t] for t in kept)
        p = lambda g, t: 1 + 10**9 * (n[g][t] + 2) // (total(g) + 2 * len(kept))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        others = [s for x, s in groups if x == lang and s != source]
        mine = {t: p((lang, source), t) for t in kept}
        pair = [(sum(f(mine[t], p((lang, s), t)) for t in kept), s) for s in others]
        term = [(f(mine[t], p(lang, t)), t) for t in kept if n[lang, source][t] and mine[t] > p(lang, t)]
        for part, items, most in (("pair", pair, len(pair)), ("term", term, top)):
            items.sort(key=lambda x: (-x[0], x[1].encode()))
            out |= {(lang, source, part, item, value, k + 1) for k, (value, item) in enumerate(items[:most])}
    return out


def corpus():
    rng = random.Random(5)
    words = ["The", "the", "menu", "É", "日本", "ﬁ", "İ", "x1y", "rare", "a", "b"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(30))), rng.choice(["en", "de"]), rng.choice(["s1", "s2", "S3", "日"])) for i in range(150)]
    rows += [(i, "hot words again again", "en", "s1") for i in range(200, 260)]  # copies in one group
    rows += [(300, None, "en", "empty"), (301, "", None, None), (302, "lone", "fr", "s1"), (303, "lone two", "fr", "s2"), (304, "x " * 5000 + "y" * 3000, "en", None)]
    return rows + rows[:5]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "1 AS n", "2 AS term", "3 AS p", "4 AS h")


def test_audit_equals_brute_force(spark):
    rows = corpus()
    df = frame(spark, rows).repartition(4)
    for block, min_docs, top in ((24 << 20, 10, 10), (4000, 3, 2)):  # one run a task, and many
        got = audit(df, min_docs, top, block).select("lang", "source", "part", "item", "value", "rank").collect()
        assert {tuple(r) for r in got} == brute(rows, min_docs, top) and len(got) == len(set(got))


def test_many_sources_and_flushed_sums(spark, monkeypatch):
    from martlet.llm import divergence

    monkeypatch.setattr(divergence, "PAIRS", 7)
    monkeypatch.setattr(divergence, "SUMS", 5)
    rows = [(i, "a b c d"[: 1 + 2 * (i % 4)], "en", f"s{i % 9}") for i in range(90)]
    rows = [(i, t, g, s) for i, t, g, s in rows if i % 7]
    batches = lambda df: df.orderBy("lang", "term", "source").toArrow().to_batches(max_chunksize=5)
    freq = divergence.frequencies(frame(spark, rows))
    shared = divergence.shares(freq, divergence.statistics(frame(spark, rows), freq))
    sums = Counter()
    for out in divergence._corrections(batches(shared)):
        for r in out.to_pylist():
            sums[r["a"], r["b"]] += r["corr"]
    want, of = Counter(), defaultdict(list)
    for r in shared.collect():
        of[r.term].append(r)
    f = lambda a, b: (a - b) ** 2 // (a + b)
    for rows_ in of.values():
        for a in rows_:
            for b in rows_:
                if a.source < b.source:
                    want[a.source, b.source] += f(a.p, b.p) - f(a.p, b.p0) - f(a.p0, b.p)
    assert sums == want


def test_no_rows_and_no_kept_terms(spark):
    df = frame(spark, corpus())
    assert audit(df.limit(0)).collect() == []
    blank = audit(frame(spark, [(1, None, "x", "p"), (2, " 1", "x", None)])).select("source", "item", "value", "rank").collect()
    assert sorted(map(tuple, blank)) == [("", "p", 0, 1), ("p", "", 0, 1)]
    few = audit(frame(spark, [(1, "a", "x", "p"), (2, "b", "x", "q")])).select("source", "item", "value", "rank").collect()
    assert sorted(map(tuple, few)) == [("p", "q", 0, 1), ("q", "p", 0, 1)]


def test_terms_across_slices(monkeypatch):
    monkeypatch.setattr(_terms, "SLICE", 3)
    keep = _terms.table()
    for text in ("", "abc", "ab CD,efghijk x", "日本語 テスト", " a", "a ", "9"):
        got = [w.decode() for part in _terms.terms(text.encode(), keep) for w in part]
        assert got == TERM.findall(text.translate(LOWER))
