"""Exact top-k search by distributed histogram selection.

Vectors are scaled to integers, ``floor(scale * x)``, and scored by their
integer inner product with every query. A global histogram of each query's
scores tells the bin of its kth highest score; the bin is refined until it
is one score wide. A last pass keeps the scores above the kth value and, of
those equal to it, the smallest ids.

Scores are computed in blocks: candidates as blocks of rows, the stated
queries in *waves* of bounded size that are broadcast. Each block adds its
own part to a histogram, and only its k highest bins: a bin below a block's
own kth score is below the global one too. It likewise sends at most k
scores above the kth value and k ties of a query, so equal vectors in any
number add k rows for a block.

Vectors of different lengths meet as if the shorter one had zeros at its end
(as in the SQL of op6): the product runs over the components that both have.
A block holds vectors of one length, so nothing is padded.

Cases: vectors that are null, empty, or hold a null or non-finite component
take no part (the SQL leaves out the same ones); neither do null ids. Repeated
ids are candidates each, and a query that is repeated counts once; a row
with the query's id is never its candidate. Vectors whose scores might not
stay below 2^61 are refused (``OverflowError``) before anything is scored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martlet.llm._common import ship, stored

BLOCK_ROWS, BINS = 4096, 1024
#: Bytes of query vectors in one wave.
WAVE_BYTES = 32 << 20


def integers(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, v array<bigint>) of the vectors that take part."""
    x = F.col("embedding")
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    ok = vectors.filter(F.col("vec_id").isNotNull() & (F.size(x) > 0) & good)
    return ok.select(F.col("vec_id").cast("long"), F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v"))


def _alike(batch, rows: int):
    """``batch`` in slices of at most ``rows`` vectors, all of one length."""
    size = batch.column("v").value_lengths().to_numpy()
    for m in np.unique(size):
        part = batch.take(pa.array(np.flatnonzero(size == m)))
        for a in range(0, part.num_rows, rows):
            yield part.slice(a, rows)


def _blocks(rows: int):
    def run(batches):
        for batch in batches:
            for part in _alike(batch, rows):
                yield pa.RecordBatch.from_pydict({
                    "n": pa.array([part.num_rows], pa.int64()), "ids": pa.array([part.column("vec_id").to_numpy().tobytes()], pa.binary()),
                    "matrix": pa.array([part.column("v").flatten().to_numpy().tobytes()], pa.binary())})

    return run


def blocks(rows: DataFrame, size: int = BLOCK_ROWS) -> DataFrame:
    return rows.select("vec_id", "v").mapInArrow(_blocks(size), "n long, ids binary, matrix binary")


def product(c: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact integer products over the common components; through doubles only where those are exact."""
    both = min(c.shape[1], q.shape[1])
    c, q = c[:, :both], q[:, :both]
    top = float(np.abs(c).max(initial=0)) * float(np.abs(q).max(initial=0)) * c.shape[1]
    return (c.astype(float) @ q.T.astype(float)).astype(np.int64) if top < 2.0**53 else c @ q.T


def _scores(batch):
    """For each (candidate block, query block) row: ids, scores (queries x candidates) and which count."""
    read = lambda name, i: np.frombuffer(batch.column(name)[i].as_buffer(), np.int64)
    for i in range(batch.num_rows):
        ids, own = read("ids", i), read("q_ids", i)
        s = product(read("matrix", i).reshape(len(ids), -1), read("q_matrix", i).reshape(len(own), -1)).T
        yield i, ids, own, s, own[:, None] != ids[None, :]


def _histogram(k: int):
    def run(batches):
        for batch in batches:
            for i, _, own, s, other in _scores(batch):
                low = np.frombuffer(batch.column("q_low")[i].as_buffer(), np.int64)[:, None]
                width = np.frombuffer(batch.column("q_width")[i].as_buffer(), np.int64)[:, None]
                bin_ = np.where(other, np.clip((s - low) // width, -1, BINS), -1)
                out = [[], [], []]
                for r in range(len(own)):
                    values, count = np.unique(bin_[r][bin_[r] >= 0], return_counts=True)
                    total = np.cumsum(count[::-1])[::-1]  # of this bin and all above
                    use = total - count < k
                    out[0].append(np.full(use.sum(), own[r]))
                    out[1].append(values[use])
                    out[2].append(count[use])
                yield pa.RecordBatch.from_pydict({c: pa.array(np.concatenate(o), pa.int64()) for c, o in zip(("query_id", "bin", "n"), out, strict=True)})

    return run


def _winners(k: int):
    def run(batches):
        for batch in batches:
            for i, ids, own, s, other in _scores(batch):
                value = np.frombuffer(batch.column("q_low")[i].as_buffer(), np.int64)
                out = [[], [], []]
                for r in range(len(own)):
                    above = np.flatnonzero(other[r] & (s[r] > value[r]))
                    above = above[np.lexsort((ids[above], -s[r][above]))[:k]]
                    ties = np.flatnonzero(other[r] & (s[r] == value[r]))
                    use = np.concatenate([above, ties[np.argsort(ids[ties], kind="stable")[:k]]])
                    for o, x in zip(out, (np.full(len(use), own[r]), ids[use], s[r][use]), strict=True):
                        o.append(x)
                yield pa.RecordBatch.from_pydict({c: pa.array(np.concatenate(o), pa.int64()) for c, o in zip(("query_id", "vec_id", "score"), out, strict=True)})

    return run


def _query_blocks(queries: DataFrame) -> DataFrame:
    """Query rows with their bin (low, width), packed by rows of 256."""

    def run(batches):
        for batch in batches:
            for part in _alike(batch, 256):
                pack = lambda c: pa.array([c.to_numpy().tobytes()], pa.binary())
                yield pa.RecordBatch.from_pydict({
                    "q_ids": pack(part.column("vec_id")), "q_matrix": pack(part.column("v").flatten()),
                    "q_low": pack(part.column("low")), "q_width": pack(part.column("width"))})

    return queries.select("vec_id", "v", "low", "width").mapInArrow(run, "q_ids binary, q_matrix binary, q_low binary, q_width binary")


def _wave(cand: DataFrame, queries: DataFrame, k: int, reach: int) -> DataFrame:
    """The k best of each query of one wave; ``reach`` bounds every score."""
    wide = max(1, -(-(2 * reach + 1) // BINS))
    state = queries.withColumn("low", F.lit(-reach).cast("long")).withColumn("width", F.lit(wide).cast("long"))
    meet = lambda s: cand.join(F.broadcast(_query_blocks(s)))  # noqa: E731 - the stated queries against all rows, in blocks
    while True:
        counts = meet(state).mapInArrow(_histogram(k), "query_id long, bin long, n long").groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("query_id").orderBy(F.desc("bin"))
        # the first bin with the kth score; with fewer than k scores the lowest bin. Scores above the refined bin count in the last one.
        kth = counts.withColumn("upto", F.sum("n").over(down)).filter(F.col("upto") - F.col("n") < k).groupBy("query_id").agg(F.min("bin").alias("bin"))
        state = stored(
            state.join(kth, F.col("vec_id") == F.col("query_id")).select(
                "vec_id", "v", (F.col("low") + F.col("bin") * F.col("width")).alias("low"),
                F.lit(max(1, -(-wide // BINS))).cast("long").alias("width")))
        if wide == 1:
            break
        wide = max(1, -(-wide // BINS))
    rows = meet(state).mapInArrow(_winners(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256) -> DataFrame:
    """The k best of ``vectors`` (vec_id, embedding) for each of ``queries``
    (same columns): query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    ship(spark)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows = integers(vectors, scale)
    cand = stored(blocks(rows))
    asked = stored(integers(queries, scale).dropDuplicates(["vec_id"]))
    sizes = lambda d: d.agg(F.max(F.array_max(F.transform("v", F.abs))), F.max(F.size("v")), F.sum(F.size("v").cast("long"))).first()
    (a, long, _), (b, wide, total) = sizes(rows), sizes(asked)
    if a is None or b is None:
        return empty
    reach = int(a) * int(b) * min(long, wide) + 1
    if min(int(a), int(b)) < 0 or reach > 2**61:
        raise OverflowError(f"components of up to {a} and {b} over {min(long, wide)} places: scores may pass 2^61")
    waves = int(total * 8 // WAVE_BYTES) + 1
    out = empty
    for k_ in range(waves):
        out = out.unionByName(_wave(cand, asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(waves)) == k_), k, reach))
    return out
