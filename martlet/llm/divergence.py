r"""Source divergence audit: how the words of a source differ from the others.

Method: single-pass in-memory indexing. A task counts the terms of its
documents in a dictionary until that is full, writes it out as a run sorted by
(lang, term), each term with its postings (source, occurrences, documents),
and starts anew. The runs meet in hash shards of (lang, term); the shard's
external sort merges its runs, and one pass over the merged rows sums the
postings of equal terms to frequencies. A last pass streams the postings
of each term and corrects, for each pair of sources that both hold it, a sum
that was formed as if they didn't.

*Terms* are runs of ASCII letters (A-Z lower-cased) and non-ASCII characters.
Each lang keeps the V terms that stand in ``min_docs`` of its documents or
more. In a group (lang, source) and in the whole lang a kept term has the
share p = 1 + floor(10^9 (count + 2) / (N + 2 V)), N being the group's kept
occurrences. Two shares differ by f(p, q) = floor((p - q)^2 / (p + q)).

*Pairs*: the sum of f over all V terms needs no row for terms that a group
lacks. With p0 the share of a lacking term, the sum for g and h is
A(g, h) + A(h, g) + (V - |g or h|) f(p0g, p0h) + corrections, where A(g, h)
sums f(p, p0h) over g's terms (by g's distinct shares) and a term of both adds
f(pg, ph) - f(pg, p0h) - f(p0g, ph). Corrections are summed in a task by pair
of sources before they are shuffled. The result itself has one row for each
ordered pair of sources of a lang; nothing larger than that is built.

All numbers are whole; products that may pass 64 bits are decimals.

Bounds: a task holds one dictionary (``BLOCK`` bytes) and its run, or an Arrow
batch of postings and one term's sources. A common term sends one row for each
dictionary, so no text is counted in one place. Joins on lang alone go by (lang, salt).

Cases: null text, lang and source count as ''; a group without terms has its
rows in part ``pair`` (values 0 where V is 0) and none in part ``term``; a
lang of one source has no pairs; repeated rows are documents each; long texts
are cut into terms in slices; empty tables give no rows. Only ``text``,
``lang`` and ``source`` are read, so other columns may have any name.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm._common import ship, stored
from martlet.llm._terms import rows, table, terms

#: Bytes of a task's dictionary, by an estimate of ENTRY bytes an entry beside its term.
BLOCK, ENTRY = 64 << 20, 250
#: Pairs of a term's sources expanded at a time, and sums kept in a task.
PAIRS, SUMS = 1 << 18, 1 << 17
SALT = 16
RUN = "lang string, term string, source array<string>, n array<long>, docs array<long>"
FREQ = "lang string, source string, term string, n long, lang_n long, first int"
CORR = "lang string, a string, b string, c long, corr long"


def _whole(now: pa.Table, column: str) -> pa.Array:
    return pa.concat_arrays(now.column(column).chunks)


def _starts(now: pa.Table, columns: list[str]) -> np.ndarray:
    """Where a row differs from the one before in one of ``columns``."""
    new = np.zeros(now.num_rows, bool)
    new[:1] = True
    for c in columns:
        col = _whole(now, c)
        new[1:] |= pc.not_equal(col.slice(1), col.slice(0, len(col) - 1)).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def _posted(keys: pa.Table, offsets: np.ndarray, source, n, docs) -> pa.Table:
    """Rows (lang, term, source[], n[], docs[]) of the (lang, term) in ``keys``."""
    lists = lambda v: pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), v)
    return pa.table({"lang": _whole(keys, "lang"), "term": _whole(keys, "term"), "source": lists(source), "n": lists(n), "docs": lists(docs)})


# ---- runs -------------------------------------------------------------------


def _run(block: dict) -> pa.RecordBatch:
    """A dictionary as a run sorted by (lang, term): one row a term with its sources."""
    parts = []
    for (lang, source), (n, docs) in block.items():
        size = len(n)
        parts.append(pa.table({
            "lang": pa.repeat(pa.scalar(lang.decode()), size), "term": pa.array(n, pa.binary()).cast(pa.string()),
            "source": pa.repeat(pa.scalar(source.decode()), size), "n": pa.array(n.values(), pa.int64()),
            "docs": pa.array(map(docs.__getitem__, n), pa.int64(), size=size)}))
    flat = pa.concat_tables(parts).combine_chunks().sort_by([("lang", "ascending"), ("term", "ascending")])
    at = _starts(flat, ["lang", "term"])
    return _posted(flat.take(pa.array(at)), np.append(at, flat.num_rows), *(_whole(flat, c) for c in ("source", "n", "docs"))).to_batches()[0]


def _runs(limit: int):
    def run(batches):
        keep = table()
        block: dict[tuple[bytes, bytes], tuple[Counter, Counter]] = {}
        full = 0
        for part, texts in rows(batches):
            groups = zip(*(part.column(c).cast(pa.binary()).to_pylist() for c in ("lang", "source")), strict=True)
            for group, text in zip(groups, texts, strict=True):
                n, docs = block.setdefault(group, (Counter(), Counter()))
                seen: set[bytes] = set()
                for words in terms(text, keep):
                    own, had = set(words), len(n)
                    n.update(words)
                    full += ENTRY * (len(n) - had) + (sum(map(len, own)) if len(n) > had else 0)
                    seen |= own
                docs.update(seen)
                if full > limit:
                    yield _run(block)
                    block, full = {}, 0
        if full:
            yield _run(block)

    return run


def runs(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Term-sorted runs: (lang, term) with its sources, occurrences and documents."""
    ship(docs.sparkSession)
    blank = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return docs.select(blank("lang"), blank("source"), blank("text")).mapInArrow(_runs(block), RUN)


# ---- merge ------------------------------------------------------------------


def _whole_terms(batches, shrink=None):
    """Tables of whole (lang, term) groups from sorted batches; the last group
    of a batch waits for the next, shrunk by ``shrink``."""
    wait = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        now = pa.concat_tables([wait, now]).combine_chunks() if wait is not None else now
        if shrink:
            now = shrink(now)
        last = int(_starts(now, ["lang", "term"])[-1])
        if last:
            yield now.slice(0, last).combine_chunks()
        wait = now.slice(last).combine_chunks()
    if wait is not None:
        yield wait


def _summed(now: pa.Table) -> pa.Table:
    """One row for each (lang, term), one entry for each of its sources."""
    at = _starts(now, ["lang", "term"])
    source, n, docs = (_whole(now, c) for c in ("source", "n", "docs"))
    term = np.repeat(np.arange(len(at)), np.diff(np.append(at, now.num_rows)))
    term = np.repeat(term, source.value_lengths().to_numpy())
    named = source.flatten().dictionary_encode()
    key = term * max(1, len(named.dictionary)) + named.indices.to_numpy()
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.diff(key[order], prepend=-1))
    add = lambda v: pa.array(np.add.reduceat(v.flatten().to_numpy()[order], first))
    size = np.bincount(term[order][first], minlength=len(at))
    return _posted(now.take(pa.array(at)), np.concatenate([[0], np.cumsum(size)]), named.dictionary.take(named.indices.take(pa.array(order[first]))), add(n), add(docs))


def _merge(min_docs: int):
    def run(batches):
        for now in _whole_terms(batches, _summed):
            docs = _whole(now, "docs")
            total = np.add.reduceat(docs.flatten().to_numpy(), docs.offsets.to_numpy()[:-1] - docs.offsets[0].as_py())
            now = now.filter(pa.array(total >= min_docs))
            if not now.num_rows:
                continue
            source, n = _whole(now, "source"), _whole(now, "n").flatten()
            size = source.value_lengths().to_numpy()
            at = np.cumsum(size) - size
            of = pa.array(np.repeat(np.arange(len(size)), size))
            first = np.zeros(len(n), np.int32)
            first[at] = 1
            yield pa.RecordBatch.from_pydict({
                "lang": _whole(now, "lang").take(of), "source": source.flatten(), "term": _whole(now, "term").take(of), "n": n,
                "lang_n": pa.array(np.repeat(np.add.reduceat(n.to_numpy(), at), size)), "first": pa.array(first)})

    return run


def frequencies(docs: DataFrame, min_docs: int = 10, block: int = BLOCK) -> DataFrame:
    """Kept terms of each group: (lang, source, term, n, lang_n, first);
    ``first`` is 1 on one row of each (lang, term)."""
    merged = runs(docs, block).repartition("lang", "term").sortWithinPartitions("lang", "term")
    return stored(merged.mapInArrow(_merge(min_docs), FREQ))


# ---- shares -----------------------------------------------------------------


def _share(n: str, total: str, kept: str = "V"):
    big = lambda e: f"CAST({e} AS DECIMAL(20, 0))"
    return F.expr(f"1 + {big(f'{n} + 2')} * 1000000000 div greatest({big(f'{total} + 2 * {kept}')}, 1)")


def _f(p: str, q: str):
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def statistics(docs: DataFrame, freq: DataFrame) -> DataFrame:
    """One row for each group that occurs: total (N), n_terms, p0, and V and lang_total of its lang."""
    blank = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    groups = docs.select(blank("lang"), blank("source")).distinct()
    own = freq.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("n_terms"), F.sum("first").alias("v"))
    own = stored(own)
    langs = own.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("v").alias("V"))
    zero = {c: 0 for c in ("total", "n_terms", "lang_total", "V")}
    out = groups.join(own.drop("v"), ["lang", "source"], "left").join(langs, "lang", "left").fillna(zero)
    return stored(out.withColumn("p0", _share("0", "total")))


def shares(freq: DataFrame, stats: DataFrame) -> DataFrame:
    """``freq`` with the group's share p, its p0, and the lang's share q."""
    met = freq.join(stats, ["lang", "source"])
    return met.select("lang", "source", "term", _share("n", "total").alias("p"), "p0", _share("lang_n", "lang_total").alias("q"))


# ---- pairs ------------------------------------------------------------------


def _loss(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _corrections(batches):
    names: dict[tuple[str, str], int] = {}
    sums: dict[int, list[int]] = {}

    def flush():
        own = list(names)
        a, b = ([own[k >> 32] for k in sums], [own[k & 0xFFFFFFFF] for k in sums])
        out = pa.RecordBatch.from_pydict({
            "lang": pa.array([x[0] for x in a], pa.string()), "a": pa.array([x[1] for x in a], pa.string()), "b": pa.array([x[1] for x in b], pa.string()),
            "c": pa.array([v[0] for v in sums.values()], pa.int64()), "corr": pa.array([v[1] for v in sums.values()], pa.int64())})
        sums.clear()
        return out

    for now in _whole_terms(batches):
        at = _starts(now, ["lang", "term"])
        later = np.repeat(np.append(at[1:], now.num_rows), np.diff(np.append(at, now.num_rows))) - np.arange(now.num_rows) - 1
        groups = list(zip(now.column("lang").to_pylist(), now.column("source").to_pylist(), strict=True))
        p, p0 = (now.column(c).to_numpy() for c in ("p", "p0"))
        total = np.concatenate([[0], np.cumsum(later)])
        code = {g: names.setdefault(g, len(names)) for g in set(groups)}
        gid = np.array([code[g] for g in groups], np.int64)
        i = 0
        while i < now.num_rows:
            j = max(i + 1, int(np.searchsorted(total, total[i] + PAIRS, side="right")) - 1)
            left = np.repeat(np.arange(i, j), later[i:j])
            right = left + 1 + np.arange(len(left)) - np.repeat(total[i:j] - total[i], later[i:j])
            i = j
            if not len(left):
                continue
            x, y, x0, y0 = p[left], p[right], p0[left], p0[right]
            corr = _loss(x, y) - _loss(x, y0) - _loss(x0, y)
            key = (gid[left] << 32) | gid[right]
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            count, added = np.diff(np.append(first, len(key))), np.add.reduceat(corr[order], first)
            for k, c, v in zip(key[first].tolist(), count.tolist(), added.tolist(), strict=True):
                have = sums.setdefault(k, [0, 0])
                have[0] += c
                have[1] += v
            if len(sums) > SUMS:
                yield flush()
    yield flush()


def _with_all(left: DataFrame, stats: DataFrame) -> DataFrame:
    """Each row of ``left`` with every other source of its lang (as ``h``, its share ``h0`` and terms ``h_terms``)."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))
    other = stats.select(F.col("lang").alias("l"), F.col("source").alias("h"), F.col("p0").alias("h0"), F.col("n_terms").alias("h_terms"), salts.alias("s"))
    left = left.withColumn("salt", F.pmod(F.xxhash64(*left.columns), F.lit(SALT)).cast("int"))
    return left.join(other, (F.col("lang") == F.col("l")) & (F.col("salt") == F.col("s")) & (F.col("source") != F.col("h"))).drop("l", "s", "salt")


def pair_sums(shared: DataFrame, stats: DataFrame) -> DataFrame:
    """For each ordered pair of sources of a lang: lang, source, h, h0 and the sum of f over all kept terms (value)."""
    by_share = shared.groupBy("lang", "source", "p").agg(F.count("*").alias("n"))
    alone = stored(_with_all(by_share, stats).groupBy("lang", "source", "h").agg(F.sum(F.col("n") * _f("p", "h0")).alias("A")))
    merged = shared.select("lang", "source", "term", "p", "p0").repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    both = stored(merged.mapInArrow(_corrections, CORR).groupBy("lang", "a", "b").agg(F.sum("c").alias("c"), F.sum("corr").alias("corr")))
    both = both.selectExpr("lang", "a AS source", "b AS h", "c", "corr").unionByName(both.selectExpr("lang", "b AS source", "a AS h", "c", "corr"))
    pairs = _with_all(stats.select("lang", "source", "V", "n_terms", "p0"), stats)
    key = ["lang", "source", "h"]
    pairs = pairs.join(alone, key, "left")
    pairs = pairs.join(alone.selectExpr("lang", "h AS source", "source AS h", "A AS B"), key, "left").join(both, key, "left").fillna(0, ["A", "B", "c", "corr"])
    value = F.col("A") + F.col("B") + F.col("corr") + (F.col("V") - F.col("n_terms") - F.col("h_terms") + F.col("c")) * _f("p0", "h0")
    return pairs.select(*key, "h0", value.alias("value"))


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10, block: int = BLOCK) -> DataFrame:
    """(lang, source, part, item, q, value, rank): part ``pair`` ranks all
    other sources by how far they are, part ``term`` the ``top`` terms that
    are more frequent in the source than in its lang."""
    freq = frequencies(docs, min_docs, block)
    stats = statistics(docs, freq)
    shared = stored(shares(freq, stats))
    pairs = pair_sums(shared, stats).selectExpr("lang", "source", "'pair' AS part", "h AS item", "h0 AS q", "value")
    over = shared.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "q", _f("p", "q").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    return ranked(pairs).unionByName(ranked(over).filter(F.col("rank") <= top))
