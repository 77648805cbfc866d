r"""Mixing sources to target weights.

Method: every document gets a hash-random key; the documents of a source are
sorted by it in ranges, sizes are summed up along that order, and the source
is cut at its exact budget. A budget beyond the source's own size takes whole
epochs first and the cut comes from what is left.

*Size* is the number of words, runs of ``[^\x20\x09-\x0D]``. *Budgets*: the
sources in code point order, null last, weigh as ``weights`` says, repeating;
together they get ``share`` percent of all words. No source gets more than
``epochs`` times its words; what it can't take is dealt again by weight among
the others until none is above. That has a closed form: with sources ordered
by cap / weight, those that a level below their cap / weight would overfill
are capped, the rest get the level times their weight.

*Ranges*: keys are uniform, so the range bounds need no sample: a key's range
is its first bits times the number of ranges of its source, and the number of
ranges grows with the source's share of the rows, up to ``ranges`` in all. A
source that holds a third of the rows is dealt to a third of the ranges. One
narrow row for each document (no text) is written once and shuffled once; the
prefix sum of a document is the sum of the ranges before (one row a range and
source) and the sum inside its range. Nothing depends on which task ran where.

DataFrame functions only.

Cases: null text has size 0 and is taken 0 words, as are texts without words;
a null doc_id is an id like any other; repeated rows are documents of their
own, equal ones are interchangeable; an empty table gives no rows. A share
that all epochs together can't fill ends at ``epochs`` times all words. A
document at the cut gives its first words only, so the taken words of a source
are its target without the fraction. Only ``doc_id``, ``text`` and ``source``
are read, so other columns may have any name. Weights are given by hand, so
sources are few: their table (one row a source) is ranked in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm._common import stored

WORD = r"[^\x20\x09-\x0D]+"
BITS = 48


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def sizes(docs: DataFrame, seed: int = 0) -> DataFrame:
    """One narrow row for each document: id, source, size, key (12 hex digits
    of a hash of the seed and the id) and a hash of the text, which tells
    documents of one id apart."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return docs.select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.substring(key, 1, BITS // 4).alias("key"), F.xxhash64("text").alias("tie"))


def targets(totals: DataFrame, weights: tuple[int, ...], share: int, epochs: int) -> DataFrame:
    """``totals`` (source, source_size; one row a source) with ``target``.
    All comparisons are of whole numbers, so ties are ties."""
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    turn = ((F.row_number().over(by_name) - 1) % len(weights)) + 1
    caps = totals.withColumn("w", F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), turn.cast("int")))
    caps = caps.withColumn("cap", F.col("source_size") * epochs)
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source")
    total = F.sum("source_size").over(Window.partitionBy())
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weight = F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    # The level of the others if all sources before are capped, as rest / (100 * weight).
    caps = caps.select("*", (total * share - before * 100).alias("rest"), weight.alias("others"))
    full = F.col("cap").cast("decimal(19,0)") * (F.col("others") * 100).cast("decimal(18,0)") <= F.col("w") * F.col("rest")
    # The capped ones lead the order, so the first of the others has the greatest weight from itself on.
    first = F.max_by(F.struct("rest", "others"), F.when(~F.col("full"), F.col("others"))).over(Window.partitionBy())
    level = F.expr("CAST(w * first.rest AS DOUBLE) / CAST(first.others * 100 AS DOUBLE)")
    whole = F.expr("(w * first.rest) div (first.others * 100)")
    return caps.withColumn("full", full).withColumn("first", first).select(
        "source", "source_size",
        F.when(F.col("full"), F.col("cap").cast("double")).otherwise(level).alias("target"),
        F.when(F.col("full"), F.col("cap")).otherwise(whole).alias("budget"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: int = 150, epochs: int = 2,
        seed: int = 0, ranges: int | None = None) -> DataFrame:
    """One row for each document: doc_id, source, tie, size, source_size,
    target, and taken, the words the mix takes of it (repeats counted)."""
    spark = docs.sparkSession
    if ranges is None:
        ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = stored(sizes(docs, seed))
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    share_of = totals.select("source", "n", F.sum("n").over(Window.partitionBy()).alias("all"))
    plan = targets(totals.drop("n"), weights, share, epochs).alias("t").join(
        share_of.alias("s"), _same(F.col("t.source"), F.col("s.source"))).select(
        F.col("t.source").alias("of"), "source_size", "target", "budget",
        F.ceil(F.lit(ranges) * F.col("n") / F.col("all")).cast("long").alias("ranges"))
    plan = stored(plan)
    part = (F.conv("key", 16, 10).cast("double") / F.lit(float(1 << BITS)) * F.col("ranges")).cast("long")
    rows = rows.join(plan.select("of", "ranges"), _same(F.col("source"), F.col("of"))).withColumn("range", part).drop("of", "ranges")
    sums = rows.groupBy("source", "range").agg(F.sum("size").alias("n"))
    starts = stored(sums.select(F.col("source").alias("of"), F.col("range").alias("at"), F.coalesce(
        F.sum("n").over(Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start")))
    inside = Window.partitionBy("source", "range").orderBy("key", F.col("doc_id").isNull(), "doc_id", "size", "tie")
    before = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("before", before)
    rows = rows.join(starts, _same(F.col("source"), F.col("of")) & (F.col("range") == F.col("at"))).drop("of", "at")
    rows = rows.join(plan.drop("ranges"), _same(F.col("source"), F.col("of")))
    # Whole epochs, then the part of the rest that lies behind this document's start.
    whole = F.expr("CASE WHEN source_size > 0 THEN budget div source_size ELSE 0 END")
    left = F.col("budget") - whole * F.col("source_size") - F.col("start") - F.col("before")
    taken = whole * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left))
    return rows.select("doc_id", "source", "tie", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed_texts(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The mix itself: one row for each time a document is taken (doc_id,
    source, epoch, text), the last time with its first words only where the
    budget ends in it. ``mixed`` is what ``mix`` gave for ``docs``. Equal rows
    are one document here, taken as often as they are together."""
    key = ["doc_id", "source", "tie"]
    taken = mixed.filter("taken > 0").groupBy(*key).agg(F.sum("taken").alias("taken"), F.first("size").alias("size"))
    texts = docs.select("doc_id", "source", F.xxhash64("text").alias("tie"), "text").dropDuplicates(key)
    same = [_same(taken[k], texts[k]) for k in key]
    got = taken.join(texts, same[0] & same[1] & same[2]).select(texts["doc_id"], texts["source"], "text", "taken", "size")
    got = got.withColumn("epoch", F.explode(F.expr("sequence(1L, (taken + size - 1) div size)")))
    words = F.least(F.col("size"), F.col("taken") - (F.col("epoch") - 1) * F.col("size"))
    begun = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(f"({WORD})")), F.lit(1), words.cast("int")), " ")
    return got.select("doc_id", "source", "epoch", F.when(words == F.col("size"), F.col("text")).otherwise(begun).alias("text"))
