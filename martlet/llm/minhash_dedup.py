"""MinHash near-dedup with ProbMinHash signatures.

Texts are sets of word shingles, each of weight 1 however often it occurs, as
in the similarity that decides on a link. ProbMinHash: each element sends a
Poisson process of arrivals at the rate of its weight, each at a random one
of ``M`` registers; a register keeps the element that comes first. Two
signatures agree in a register with the probability Jaccard of the weights,
here the Jaccard similarity of the sets. An element stops as soon
as its next arrival is later than every register's, so a text costs about
(elements + M log M) arrivals.

Signatures are cut in ``BANDS`` bands; texts that share a band are
candidates, and a link needs a Jaccard similarity of the shingle sets of
``threshold`` or more, counted exactly. Classes are the connected parts.

Skew. Texts with equal shingles are one *group*, found first, so copies are
no candidates of one another. In a bucket every member meets one hub only:
pairs grow with the rows of the bucket, not with its square. Rounds take
different hubs, and only members that are not yet in the hub's part, until a
round links few of its pairs. Texts with a bucket partner that is still in
another part are the *rest*. Shingles of the rest are put in one order, the
rare ones first; two sets of a similarity of 0.8 share a shingle among the
first fifth of each (the prefix filter of set similarity joins, which loses
no pair), so only texts that share such a shingle and are in different parts
meet. Texts that have just a common passage in common do not. Within a part
nothing is left to decide. A text with many partners is dealt to several
tasks, as many as its number of partners asks for.

Cases: null and empty texts, and texts of under ``shingle`` words, are
compared as whole texts: word for word equal ones form a class, but texts
without any word are each their own class. Repeated rows of a doc_id give
one row for each; null ids are their own class (null).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm import _words as w
from martlet.llm import url_filter
from martlet.llm._common import ship, spent, stored

M, BANDS = 80, 20
ROWS = M // BANDS
#: Partners of one text that one task takes.
PARTNERS = 500
#: Rounds of hubs at most, before the rest of the buckets.
ROUNDS = 8
#: The rounds end once one links less than this share of its pairs.
YIELD = 0.05
#: Bytes of text whose shingles a task holds at a time.
SLICE = 1 << 19
#: Bytes of the filter of the texts that are read again, at most; beyond it more of the others pass.
FILTER_BYTES = 64 << 20
GRAM_BASE = 0x9E3779B97F4A7C15
U = np.uint64


def shingle_sets(col, k: int):
    """(text, shingle) of all texts, sorted, each once; texts of fewer than k
    words have one shingle of all their words."""
    buf, offsets = w.text_bytes(col)
    starts, ends, rows = w.word_spans(buf, offsets)
    n = len(offsets) - 1
    words = w.word_hashes(buf, starts, ends)
    grams = w.gram_hashes(words, k, GRAM_BASE)
    inside = w.within_rows(rows, k)
    count = np.bincount(rows, minlength=n)
    short = np.flatnonzero((count > 0) & (count < k))
    first = np.searchsorted(rows, short)
    extra = np.array([w.mix(np.array([np.bitwise_xor.reduce(w.mix(words[a : a + c] + np.arange(1, c + 1, dtype=U) * w.MUL))]))[0]
                      for a, c in zip(first, count[short], strict=True)], U)
    of = np.concatenate([rows[: len(grams)][inside], short])
    code = np.concatenate([grams[inside], extra])
    order = np.lexsort((code, of))
    of, code = of[order], code[order]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (code[1:] != code[:-1])
    return of[new], code[new], n


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> U(11)).astype(np.float64) + 0.5) / 9007199254740992.0


def signatures(of: np.ndarray, code: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Registers (n x M) of the elements that arrive first."""
    time = np.full(n * M, np.inf)
    sig = np.zeros(n * M, U)
    who, h, i = np.arange(len(of)), np.zeros(len(of)), 0
    while len(who):
        i += 1
        seed = w.mix(code[who] + U((i * 0xD1342543DE82EF95) & 0xFFFFFFFFFFFFFFFF))
        h = h - np.log(_uniform(seed)) / weight[who]
        slot = of[who] * M + (w.mix(seed ^ w.MUL) % U(M)).astype(np.int64)
        order = np.lexsort((h, slot))
        s = slot[order]
        lead = order[np.concatenate([[True], s[1:] != s[:-1]])]
        lead = lead[h[lead] < time[slot[lead]]]
        time[slot[lead]], sig[slot[lead]] = h[lead], code[who[lead]]
        last = time.reshape(n, M).max(1)
        stay = h < last[of[who]]
        who, h = who[stay], h[stay]
    return sig.reshape(n, M)


def _keys(of: np.ndarray, code: np.ndarray, n: int) -> dict:
    """Size and two hashes of each shingle set."""
    edge = np.searchsorted(of, np.arange(n + 1))
    out = {"size": pa.array(np.diff(edge).astype(np.int64))}
    for name, salt in (("k1", 0), ("k2", 0xA5A5A5A5A5A5A5A5)):
        total = np.concatenate([np.zeros(1, U), np.cumsum(w.mix(code ^ U(salt)), dtype=U)])
        out[name] = pa.array((total[edge[1:]] - total[edge[:-1]]).view(np.int64))
    return out


def _sets(k: int, wanted):
    """The sorted shingles of the texts whose doc_id the filter ``wanted`` lets through."""

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_numpy().astype(np.int64).view(U)
            for part in w.pieces(batch.filter(pa.array(url_filter.passes(wanted.value, ids, 0))), "text", SLICE):
                of, code, n = shingle_sets(part.column("text"), k)
                edge = pa.array(np.searchsorted(of, np.arange(n + 1)).astype(np.int32))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), **_keys(of, code, n), "grams": pa.ListArray.from_arrays(edge, pa.array(code.view(np.int64)))})

    return run


def _sketches(k: int):
    """For each text: a key of its shingle set and its band keys."""

    def run(batches):
        for batch in batches:
            for part in w.pieces(batch, "text", SLICE):
                of, code, n = shingle_sets(part.column("text"), k)
                sig = signatures(of, code, np.ones(len(of)), n)
                bands = np.zeros((n, BANDS), U)
                for b in range(BANDS):
                    key = np.full(n, U(b + 1))
                    for r in range(ROWS):
                        key = w.mix(key * w.MUL + sig[:, b * ROWS + r])
                    bands[:, b] = key
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), **_keys(of, code, n),
                    "bands": pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * BANDS), pa.array(bands.ravel().view(np.int64))),
                })

    return run


def verified(pairs: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of groups whose sets are similar enough, as a stored table.
    The set of a ``b`` with many partners is sent to several tasks."""
    sets = groups.select("gid", "grams")
    slices = stored(pairs.groupBy("b").agg(F.floor(F.count("*") / PARTNERS).cast("int").alias("n")))
    many = slices.filter("n > 0").select(F.col("b").alias("hub"), "n")
    left = pairs.join(many, F.col("b") == F.col("hub"), "left").select("a", "b", F.pmod(F.xxhash64("a"), F.coalesce("n", F.lit(0)) + 1).cast("int").alias("slice"))
    right = sets.join(slices, F.col("gid") == F.col("b")).select("b", F.col("grams").alias("gb"), F.explode(F.sequence(F.lit(0), "n")).alias("slice"))
    met = left.join(sets.select(F.col("gid").alias("a"), F.col("grams").alias("ga")), "a").join(right, ["b", "slice"])
    short, long = F.least(F.size("ga"), F.size("gb")), F.greatest(F.size("ga"), F.size("gb"))
    both = F.size(F.array_intersect("ga", "gb"))  # a set has a shingle once
    links = stored(met.filter((short >= threshold * long) & (both >= threshold * (short + long - both))).select("a", "b"))
    spent(slices)
    return links


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def parts(links: DataFrame) -> DataFrame:
    """Connected parts of links (a, b): rows (id, part), the part being its
    least id; that id itself has no row. Large-star and small-star steps
    alternate until nothing changes."""
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    before = _mark(edges)
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, F.col("a") == F.col("id")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        tied = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        old, edges = edges, stored(tied.unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        spent(old)
        after = _mark(edges)
        if after == before:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("part"))
        before = after


def _tagged(entries: DataFrame, label: DataFrame) -> DataFrame:
    """Members of the buckets that hold two parts or more, with their part."""
    tagged = entries.join(label, entries.gid == label.id, "left").select("band", "gid", F.coalesce("part", "gid").alias("part"))
    mixed = tagged.groupBy("band").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo < hi").select("band")
    return stored(tagged.join(mixed, "band"))


def rest_pairs(entries: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of texts of different parts whose sets can be similar
    enough: they share a shingle within their prefixes, early enough that the
    shingles from there on can be the overlap that they need."""
    left = entries.groupBy("gid").agg(F.min("part").alias("part"))
    grams = stored(groups.join(left, "gid").select("gid", "part", F.size("grams").alias("n"), F.explode("grams").alias("gram")))
    # Stored, so that the planner knows its size and can split a frequent shingle.
    shared = stored(grams.groupBy("gram").agg(F.count("*").alias("df")).filter("df > 1"))
    # Shingles of one text lead its order and meet no other: the others' ranks start after them.
    mine = Window.partitionBy("gid")
    rank = F.col("n") - F.count("*").over(mine) + F.row_number().over(mine.orderBy("df", "gram"))
    least = F.ceil(F.lit(threshold) * F.col("n") - 1e-9)
    prefix = stored(
        grams.join(shared, "gram").withColumn("rank", rank)
        .filter(F.col("rank") <= F.col("n") - least + 1).select("gid", "part", "gram", "n", (F.col("n") - F.col("rank") + 1).alias("tail"))
    )
    other = prefix.select("gram", F.col("gid").alias("b"), F.col("part").alias("other"), F.col("n").alias("m"), F.col("tail").alias("rest"))
    fits = F.least("tail", "rest") >= F.lit(threshold / (1 + threshold)) * (F.col("n") + F.col("m")) - 1e-9
    pairs = stored(prefix.join(other, "gram").filter((F.col("part") < F.col("other")) & fits).select(F.col("gid").alias("a"), "b").distinct())
    spent(grams, shared, prefix)
    return pairs


def _groups(known: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(gid, grams): the whole sets of the ``wanted`` (doc_id, gid), as a stored table.

    Only the texts that share a band are read again. A Bloom filter of their
    ids goes to the tasks that read the texts, so the sets of the others are
    not built and no text is shuffled; the join decides exactly."""
    spark, same = known.sparkSession, ["size", "k1", "k2"]
    wanted = stored(wanted)
    words = min(max(4, -(-wanted.count() * url_filter.BITS // 64)), FILTER_BYTES // 8)
    sent = spark.sparkContext.broadcast(url_filter.bitmap(wanted.select(F.col("doc_id").alias("h")), 0, words))
    sets = known.mapInArrow(_sets(shingle, sent), "doc_id long, size long, k1 long, k2 long, grams array<long>")
    sets = sets.select("doc_id", F.xxhash64(*same).alias("gid"), "grams")
    return stored(sets.join(wanted, ["doc_id", "gid"]).dropDuplicates(["doc_id", "gid"]).select("gid", "grams"))


def near_duplicates(docs: DataFrame, shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id and
    ``class_id``, the least doc_id of its class."""
    spark = docs.sparkSession
    ship(spark)
    known = docs.filter("doc_id is not null").select("doc_id", "text")
    sketch = stored(known.mapInArrow(_sketches(shingle), "doc_id long, size long, k1 long, k2 long, bands array<long>"))
    same = ["size", "k1", "k2"]
    member = stored(sketch.filter("size > 0").groupBy(*same).agg(F.min("doc_id").alias("first_id")).withColumn("gid", F.xxhash64(*same)))
    entries = (
        sketch.join(member.withColumnRenamed("first_id", "doc_id"), ["doc_id", *same])
        .dropDuplicates(["gid"]).select("gid", F.explode("bands").alias("band"))
    )
    label = spark.createDataFrame([], "id long, part long")
    entries = _tagged(entries, label)
    groups = _groups(known, member.join(entries.select("gid").distinct(), "gid").select(F.col("first_id").alias("doc_id"), "gid"), shingle)
    hubs = True
    for r in range(ROUNDS + 1):
        if entries.isEmpty():
            break
        hubs = hubs and r < ROUNDS
        if hubs:
            hub = entries.groupBy("band").agg(F.min_by(F.struct("gid", "part"), F.xxhash64("gid", "band", F.lit(r))).alias("hub"))
            pairs = entries.join(hub, "band").filter("part <> hub.part").select(F.col("gid").alias("a"), F.col("hub.gid").alias("b"))
            pairs = stored(pairs.distinct())
        else:
            pairs = rest_pairs(entries, groups, threshold)
        new = verified(pairs, groups, threshold)
        found, tried = new.count(), pairs.count()
        if found:
            label = parts(new.unionByName(label.select(F.col("id").alias("a"), F.col("part").alias("b"))))
        spent(pairs, new)
        if not hubs:
            break
        hubs = found >= YIELD * tried
        if found:
            old, entries = entries, _tagged(entries.select("band", "gid"), label)
            spent(old)
    of = member.join(label, member.gid == label.id, "left").withColumn("part", F.coalesce("part", "gid"))
    least = of.groupBy("part").agg(F.min("first_id").alias("class_id"))
    classes = stored(of.join(least, "part").select(*same, "class_id"))
    out = sketch.select("doc_id", *same).join(classes, same, "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
    lone = docs.filter("doc_id is null").select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("class_id"))
    return out.unionByName(lone)
