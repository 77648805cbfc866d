"""Edge cases and brute-force versions of the training-data operators."""

import re

import pytest

from martlet.llm import chat, decontaminate, line_dedup, minhash_dedup, pieces, quality, token_counts, topk, url_filter
from martlet.llm._common import tokenizer

MODEL, VOCABULARY = tokenizer("piece_bpe_32k.model"), tokenizer("byte_bpe_50k.tiktoken")
TEXTS = ["", None, "  ", "a", " a  b ", "日本語 x", "\n\n\t", " " * 50, "x" * 3000, "\0 a\0", "😀😀 x", "the quick brown " * 30, "the quick brown " * 30]


def docs(spark, texts=TEXTS, extra=""):
    return spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], f"doc_id long, text string, source string{extra}")


def test_pieces_match_the_library_and_round_trip(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    out = pieces.decode(pieces.encode(docs(spark), MODEL), MODEL).collect()
    assert {r.doc_id: (r.token_ids, r.decoded) for r in out} == {
        i: (None, None) if t is None else (sp.encode(t), t) for i, t in enumerate(TEXTS)}
    assert pieces.encode(docs(spark, []), MODEL).collect() == []


def test_token_counts_share_prefixes(spark):
    counter = token_counts.Counter(token_counts.load(MODEL))
    alone = lambda t: sum(counter.alone(u) for u in token_counts.UNIT.findall("▁" + t.replace(" ", "▁"))) if t else 0
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs(spark), MODEL).collect()}
    assert got == {i: alone(t) for i, t in enumerate(TEXTS)}
    assert token_counts.token_counts(docs(spark, []), MODEL).collect() == []


def test_near_duplicates_against_brute_force(spark):
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base), " ".join(base), " ".join([*base, "tail"]), " ".join(["head", *base[:-1]]), " ".join(reversed(base)),
             "short one", "short  one", "short two", "", None]
    sets = []
    for i, t in enumerate(texts):
        words = re.findall("[^\x20\x09-\x0d]+", t or "")
        sets.append({tuple(words[j : j + 5]) for j in range(max(1, len(words) - 4))} if words else {("none", i)})
    part = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if len(a & b) >= 0.8 * len(a | b):
                    part[i] = part[j] = min(part[i], part[j])
    df = docs(spark, texts)
    assert {r.doc_id: r.class_id for r in minhash_dedup.near_duplicates(df).collect()} == dict(enumerate(part))
    assert minhash_dedup.near_duplicates(df.limit(0)).collect() == []
    lone = spark.createDataFrame([(None, "a b"), (1, "c d"), (1, "c d")], "doc_id long, text string")
    assert sorted(minhash_dedup.near_duplicates(lone).collect(), key=str) == sorted([(1, 1), (1, 1), (None, None)], key=str)


def test_line_dedup_cases(spark):
    rows = [(i, f"menu\nown {i}\n\nmenu", "a") for i in range(4)] + [(9, None, "a"), (10, "menu\nx", None), (11, "menu\ny", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "'z' AS n_lines")
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in line_dedup.line_dedup(df, ratio=0.5).collect()}
    want = {i: (f"own {i}\n", 4, 2) for i in range(4)}
    assert got == want | {9: (None, 0, 0), 10: ("menu\nx", 2, 0), 11: ("menu\ny", 2, 0)}
    assert line_dedup.line_dedup(df.limit(0)).collect() == []


def test_decontamination_finds_edits_and_spares_others(spark):
    passage = "a passage of the benchmark that is long enough to be cut into several windows of sixty characters each, for a test"
    near = passage.replace("several", "sevral").replace(" ", "  \n", 3).upper()
    df = docs(spark, [f"before {passage} after", f"x {near} y", passage[:40], "clean text " * 40, None, ""])
    bench = spark.createDataFrame([(7, passage), (8, None), (9, ""), (7, passage), (None, passage)], "item_id long, text string")
    got = decontaminate.contaminated(df, bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(0, 7), (1, 7)]
    assert decontaminate.contaminated(df, bench.limit(0)).collect() == [] == decontaminate.contaminated(df.limit(0), bench).collect()


def test_top_k_against_brute_force(spark):
    rows = [(i, [((i * 37 + j * 11) % 23 - 11) / 7 for j in range(6)]) for i in range(120)]
    rows += [(200 + i, rows[0][1]) for i in range(30)] + [(300, None), (301, [float("nan")] * 6), (302, [1.0] * 5 + [None]), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    import math

    good = {i: [math.floor(256 * x) for x in v] for i, v in rows[:150]}
    want = set()
    for q in (i for i in good if i % 50 == 0):
        best = sorted((-sum(a * b for a, b in zip(good[q], v, strict=True)), i) for i, v in good.items() if i != q)[:5]
        want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    got = topk.top_k(df, df.filter("vec_id % 50 = 0")).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert topk.top_k(df.limit(0), df).collect() == []


def test_chat_round_trip(spark):
    rows = [(1, 0, "user", "<|im_end|>\\<|x"), (1, 1, "assistant", "\\"), (1, 2, "assistant", "<|im_start|>"), (2, 0, None, None), (2, 0, "a\nb", "t\n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    import hashlib

    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(df, VOCABULARY), VOCABULARY).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got[1].turns_sha256 == sha("".join(f"{r}\n{t}\n" for _, _, r, t in rows[:3]))
    assert got[1].loss_sha256 == sha("\\<|im_start|>") and got[1].loss_chars == 13
    assert got[2].turns_sha256 == sha("\n\na\nb\nt\n\n") and got[2].loss_sha256 == sha("")
    assert chat.read_back(chat.format_turns(df.limit(0), VOCABULARY), VOCABULARY).collect() == []


def test_url_rules(spark):
    urls = ["http://A.example.net/en/x?q", "https://b.net/", "b.net/", None, "x://example.net", "http://fr.org/fr/#a", "http://xnet/", "http://net/a"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "1 AS host")
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow"), ("org", "/fr/", "allow"), (None, "/", "block")],
                                  "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, rules).collect()}
    assert got == {0: ("a.example.net", "/en/x", "example.net/en/", "allow"), 1: ("b.net", "/", "net/", "block"), 2: ("", "", None, "allow"),
                   3: ("", "", None, "allow"), 4: ("example.net", "", None, "allow"), 5: ("fr.org", "/fr/", "org/fr/", "allow"),
                   6: ("xnet", "/", None, "allow"), 7: ("net", "/a", "net/", "block")}
    assert {r.verdict for r in url_filter.judge(pages, rules.limit(0)).collect()} == {"allow"}


def test_quality_learns_and_scores_every_text(spark):
    texts = [("plain words of a calm text " * 9 if i % 2 else "LOUD!! WORDS!! " * 15) + str(i) for i in range(80)] + [None, ""]
    df = docs(spark, texts)
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(3, None), (None, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.score(df, quality.fit(df, labels)).collect()}
    assert [got[i].predicted for i in range(80)] == [i % 2 for i in range(80)]
    assert all(0 <= r.score <= 1 for r in got.values()) and len(got) == 82
    assert quality.fit(df, labels.limit(0)) == 0.5
    assert quality.score(df.limit(0), 0.5).collect() == []
