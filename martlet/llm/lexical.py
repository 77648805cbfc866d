r"""Ranked lexical search: the k highest-scoring documents of each item.

Method: LEMP-style norm buckets. The documents of a block of items become
*impact vectors* over the block's terms, impact = weight of the term times its
saturated frequency in the document, a whole number. Vectors are ordered by
length (Euclidean norm), in ranges over the tasks and in buckets within them.
For an item with threshold t and query norm |q|:

* Cauchy-Schwarz: a bucket whose longest vector v has |q| |v| < t is skipped,
  and whatever lies below the smallest t / |q| is not read at all;
* coordinates: with c the greatest impact of a term in the bucket, terms of
  the smallest q c are set aside as long as these sum to less than t. A
  document must hold one of the others, and its sum over them plus the part
  set aside must reach t;
* survivors are scored exactly over all terms, in integers.

The thresholds are the kth scores among the longest vectors (all above the
norm's ``SEED`` quantile, searched first) and rise within a task with what it
has found. They only prune; ties with the kth score are kept and ordered.

*Score*: terms are runs of letters (A-Z lower-cased), digits and non-ASCII
characters. N documents have terms, L in all, n in one, df documents hold a
term, tf times. w = floor(1000 ln((2 N + 2) / (2 df + 1))),
m = 75 + (25 n N) div L; the score adds w ((10^9 tf) div (1000 tf + 12 m))
for each term of the item, repeats included.

Bounds: items are a stated query set. They come to the driver in blocks of at
most ``block_bytes`` (or one item), each searched against all rows; the block's
terms and weights are broadcast and released after it. A task holds one slice
of texts (1 MB) or one bucket (``ENTRIES`` impacts); a document has at most
one impact for each term of the block. A task sends an item at most k rows a
bucket, so no document or term has a hot place.

Cases: null or empty texts and items have no terms: such documents don't count
in N and such items have no rows; each row of items is an item of its own, and
each row of documents a document, equal scores in order of doc_id, null last;
long texts are cut in slices; no documents or no items give no rows. Only
``doc_id``, ``text``, ``item_id`` are read, so other columns may have any name.
"""

from __future__ import annotations

import math
import string
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm._common import ship, stored
from martlet.llm._terms import rows, table, terms

#: Documents and impacts of a bucket.
BUCKET, ENTRIES = 4096, 1 << 19
SEED = 0.98
VECTORS = "doc_id long, n long, terms array<int>, tf array<long>"
IMPACTS = "doc_id long, norm double, terms array<int>, impact array<long>"
FOUND = "q int, item_id long, doc_id long, score long"


def _keep() -> bytes:
    return table(string.digits)


# ---- items ------------------------------------------------------------------


class Items:
    """A block of items: its vocabulary and, for each item, term numbers and repeats."""

    def __init__(self, batch: list[tuple[int | None, bytes]]):
        self.vocabulary: dict[bytes, int] = {}
        self.items: list[tuple[int | None, np.ndarray, np.ndarray]] = []
        for item_id, text in batch:
            count = Counter(w for part in terms(text, _keep()) for w in part)
            number = [self.vocabulary.setdefault(t, len(self.vocabulary)) for t in count]
            if count:
                self.items.append((item_id, np.array(number, np.int64), np.array(list(count.values()), np.int64)))


def item_blocks(items: DataFrame, block_bytes: int):
    """The items in blocks, one after the other."""
    batch: list[tuple[int | None, bytes]] = []
    size = 0
    for r in items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).toLocalIterator():
        text = r["text"].encode()
        if batch and size + len(text) > block_bytes:
            yield Items(batch)
            batch, size = [], 0
        batch.append((r["item_id"], text))
        size += len(text)
    if batch:
        yield Items(batch)


# ---- vectors ----------------------------------------------------------------


def _lists(counts: list[int], values, kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values, kind))


def _vectors(block):
    def run(batches):
        keep, vocabulary = _keep(), block.value.vocabulary
        for part, texts in rows(batches):
            ids = part.column("doc_id").to_pylist()
            out, size, n_, number, tf = [], [], [], [], []
            for doc_id, text in zip(ids, texts, strict=True):
                n, count = 0, Counter()
                for words in terms(text or b"", keep):
                    n += len(words)
                    here = Counter(words)
                    for t in here.keys() & vocabulary.keys():
                        count[vocabulary[t]] += here[t]
                if n:
                    out.append(doc_id)
                    n_.append(n)
                    size.append(len(count))
                    number += count.keys()
                    tf += count.values()
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(out, pa.int64()), "n": pa.array(n_, pa.int64()), "terms": _lists(size, number, pa.int32()), "tf": _lists(size, tf, pa.int64())})

    return run


def _document_frequencies(n_terms: int):
    def run(batches):
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            df += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=n_terms)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"term": pa.array(at, pa.int32()), "df": pa.array(df[at], pa.int64())})

    return run


def _impacts(weights, n_docs: int, n_all: int):
    def run(batches):
        for batch in batches:
            m = np.array([75 + 25 * n * n_docs // n_all for n in batch.column("n").to_pylist()], np.int64)
            size = batch.column("terms").value_lengths().to_numpy()
            t, tf = (batch.column(c).flatten().to_numpy() for c in ("terms", "tf"))
            of = np.repeat(np.arange(len(size)), size)
            x = weights.value[t] * (1_000_000_000 * tf // (1000 * tf + 12 * m[of]))
            norm = np.sqrt(np.bincount(of, x.astype(float) ** 2, len(size)))
            use = norm > 0
            own = use[of] & (x > 0)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id").filter(pa.array(use)), "norm": pa.array(norm[use]),
                "terms": _lists(np.bincount(of[own], minlength=len(size))[use], t[own], pa.int32()),
                "impact": _lists(np.bincount(of[own], minlength=len(size))[use], x[own], pa.int64())})

    return run


# ---- search -----------------------------------------------------------------


class Bucket:
    """Impact vectors of neighbouring norms, by term."""

    def __init__(self, part: pa.RecordBatch, n_terms: int):
        ids = part.column("doc_id")
        self.null = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy()
        self.norm = part.column("norm").to_numpy().max(initial=0.0)
        t = part.column("terms").flatten().to_numpy()
        by_term = np.argsort(t, kind="stable")
        self.impact = part.column("impact").flatten().to_numpy()[by_term]
        self.doc = np.repeat(np.arange(part.num_rows), part.column("terms").value_lengths().to_numpy())[by_term]
        size = np.bincount(t, minlength=n_terms)
        self.at = np.concatenate([[0], np.cumsum(size)])
        self.top = np.zeros(n_terms, np.int64)
        if len(t):
            self.top[size > 0] = np.maximum.reduceat(self.impact, self.at[:-1][size > 0])

    def postings(self, t: int):
        a, b = self.at[t], self.at[t + 1]
        return self.doc[a:b], self.impact[a:b]

    def search(self, number: np.ndarray, repeats: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that score ``least`` (1 or more) at least, and their scores."""
        most = repeats * self.top[number]
        order = np.argsort(most, kind="stable")
        order = order[most[order] > 0]
        total = np.cumsum(most[order])
        aside = int(np.searchsorted(total, least))  # these terms alone stay below ``least``
        score = np.zeros(len(self.ids), np.int64)
        for j in order[aside:]:
            doc, impact = self.postings(number[j])
            score[doc] += repeats[j] * impact
        rest = int(total[aside - 1]) if aside else 0
        left = np.flatnonzero((score > 0) & (score + rest >= least))
        score = score[left]
        for j in order[:aside]:
            if not len(left):
                break
            doc, impact = self.postings(number[j])
            k = np.minimum(np.searchsorted(doc, left), len(doc) - 1)
            score += np.where(doc[k] == left, repeats[j] * impact[k], 0)
        use = score >= least
        return left[use], score[use]


def _buckets(batch: pa.RecordBatch):
    """``batch`` in buckets of at most BUCKET documents and ENTRIES impacts (or one document)."""
    total = np.concatenate([[0], np.cumsum(batch.column("terms").value_lengths().to_numpy())])
    i = 0
    while i < batch.num_rows:
        j = int(np.searchsorted(total, total[i] + ENTRIES, side="right")) - 1
        j = max(i + 1, min(j, i + BUCKET))
        yield batch.slice(i, j - i)
        i = j


def _search(block, least: list[int], k: int):
    def run(batches):
        items, n_terms = block.value.items, len(block.value.vocabulary)
        length = [math.sqrt(float((r.astype(float) ** 2).sum())) * (1 + 1e-9) for _, _, r in items]
        know = list(least)
        best = [np.zeros(0, np.int64)] * len(items)
        for batch in batches:
            for part in _buckets(batch):
                bucket = Bucket(part, n_terms)
                out: list[list] = [[], [], [], []]
                for q, (item_id, number, repeats) in enumerate(items):
                    if length[q] * bucket.norm < know[q]:
                        continue
                    doc, score = bucket.search(number, repeats, max(1, know[q]))
                    if not len(doc):
                        continue
                    order = np.lexsort((bucket.ids[doc], bucket.null[doc], -score))[:k]
                    doc, score = doc[order], score[order]
                    best[q] = np.sort(np.append(best[q], score))[-k:]
                    if len(best[q]) == k:
                        know[q] = max(know[q], int(best[q][0]))
                    out[0] += [q] * len(doc)
                    out[1] += [item_id] * len(doc)
                    out[2] += [None if n else i for i, n in zip(bucket.ids[doc].tolist(), bucket.null[doc].tolist(), strict=True)]
                    out[3] += score.tolist()
                yield pa.RecordBatch.from_pydict({
                    "q": pa.array(out[0], pa.int32()), "item_id": pa.array(out[1], pa.int64()),
                    "doc_id": pa.array(out[2], pa.int64()), "score": pa.array(out[3], pa.int64())})

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.col("doc_id").isNull(), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search_block(docs: DataFrame, items: Items, k: int) -> DataFrame:
    spark = docs.sparkSession
    sc = spark.sparkContext
    n_terms = len(items.vocabulary)
    block = sc.broadcast(items)
    vectors = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_vectors(block), VECTORS))
    n_docs, n_all = vectors.agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    df = np.zeros(n_terms, np.int64)
    counted = vectors.select("terms").mapInArrow(_document_frequencies(n_terms), "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for r in counted.collect():  # at most the terms of the block
        df[r["term"]] = r["df"]
    weights = sc.broadcast(np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64))
    impacts = vectors.mapInArrow(_impacts(weights, n_docs, n_all), IMPACTS)
    ordered = stored(impacts.repartitionByRange(F.desc("norm"), "doc_id").sortWithinPartitions(F.desc("norm"), "doc_id"))
    none = [0] * len(items.items)
    long = ordered.agg(F.percentile_approx("norm", SEED)).first()[0]
    if long is not None:
        seeds = _best(ordered.filter(F.col("norm") >= long).mapInArrow(_search(block, none, k), FOUND), k)
        for r in seeds.filter(F.col("rank") == k).select("q", "score").collect():  # one row an item
            none[r["q"]] = r["score"]
    lengths = [math.sqrt(float((r.astype(float) ** 2).sum())) for _, _, r in items.items]
    shortest = min((t / n * (1 - 1e-9) for t, n in zip(none, lengths, strict=True)), default=0.0)
    found = ordered.filter(F.col("norm") >= shortest).mapInArrow(_search(block, none, k), FOUND)
    out = stored(_best(found, k).select("item_id", "rank", "doc_id", "score"))
    block.destroy()
    weights.destroy()
    return out


def search(docs: DataFrame, items: DataFrame, k: int = 20, block_bytes: int = 1 << 20) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item with a score above 0."""
    spark = docs.sparkSession
    ship(spark)
    parts = [_search_block(docs, block, k) for block in item_blocks(items, block_bytes)]
    empty = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, parts, empty)
