"""Which lines of a batch are new, found before the fact is built.

The keys of a batch's lines (transaction, line, day) come from one narrow
join of headers and lines. A Bloom filter of the loaded line keys, stored for
each month, tells most new lines apart at about ten bits a loaded line; only
lines that it may hold meet the fact's own keys, of their months, in an exact
join. Baskets without a new line then drop out, so lookups, measures and
basket metrics run on baskets that have something to insert.

The filter of a month is ``blocks`` bitmaps of 32,768 bits (the size of
Spark's bitmap aggregates). A key belongs to one block by its hash and sets
``HASHES`` bits of it, so a test joins one row. A load adds bitmaps for its
own lines and readers merge them by OR. A filter that holds more lines than
it was sized for sends more lines to the exact join and changes no result;
the filter is written before the fact, so it never misses a loaded line.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.functions.dates import date_key, month_key
from martlet.operators import facts, skew
from martlet.operators.joins import broadcast_if_small
from martlet.schemas import FACT_LINE_KEY
from martlet.sources.readers import read_or_empty

BLOCK_BITS, HASHES = 32_768, 4
#: Bits for each line of a month's first load: ten a line, with room for as many lines again.
BITS_PER_LINE = 20
FILTER = T.StructType([T.StructField("month_key", T.IntegerType()), T.StructField("blocks", T.LongType()),
                       T.StructField("block", T.LongType()), T.StructField("bits", T.BinaryType())])


def _same(left: DataFrame, right: DataFrame) -> Column:
    return reduce(and_, (left[k].eqNullSafe(right[k]) for k in FACT_LINE_KEY))


def line_keys(tx_clean: DataFrame, items: DataFrame) -> DataFrame:
    """(transaction, line, day, month) of every line with a clean header, and
    the members it refers to; hot transactions are salted as in the fact build."""
    hot = skew.heavy_hitters(items, "transaction_id")
    body = items.select("transaction_item_id", "transaction_id", "product_id")
    head = tx_clean.select("transaction_id", "customer_id", "transaction_date")
    lines = skew.salted_join(body, head, "transaction_id", hot, row_id="transaction_item_id")
    lines = lines.withColumn("transaction_date_key", date_key("transaction_date"))
    return lines.select(*FACT_LINE_KEY, month_key("transaction_date_key").alias("month_key"), "customer_id", "product_id")


def insertable(new: DataFrame, dim_customer: DataFrame, dim_product: DataFrame) -> DataFrame:
    """The new keys whose members are in their dimensions; lines refused by
    an earlier load come up again in every batch and end here."""
    for dim, key in ((dim_customer, "customer_id"), (dim_product, "product_id")):
        new = new.join(broadcast_if_small(dim.select(key)), key, "left_semi")
    return new


# --- the filter ----------------------------------------------------------------


def blocks_for(keys: DataFrame, known: dict[int, int] | None = None) -> dict[int, int]:
    """Blocks of each month of ``keys`` (bounded by the calendar): those of
    the stored filter, or as many as its lines ask for."""
    counts = keys.where(F.col("month_key").isNotNull()).groupBy("month_key").count().collect()
    sized = {r["month_key"]: max(1, math.ceil(r["count"] * BITS_PER_LINE / BLOCK_BITS)) for r in counts}
    return sized | {m: b for m, b in (known or {}).items() if m in sized}


def _with_block(keys: DataFrame, blocks: dict[int, int]) -> DataFrame:
    known = [x for m, b in sorted(blocks.items()) for x in (F.lit(m), F.lit(b).cast("long"))]
    of = F.create_map(*known)[F.col("month_key")] if known else F.lit(None).cast("long")
    return keys.withColumn("blocks", of).withColumn("block", F.pmod(F.xxhash64(*FACT_LINE_KEY), F.col("blocks")))


def _positions() -> list[Column]:
    return [F.pmod(F.xxhash64(*FACT_LINE_KEY, F.lit(i)), F.lit(BLOCK_BITS).cast("long")) for i in range(1, HASHES + 1)]


def line_filter(keys: DataFrame, blocks: dict[int, int]) -> DataFrame:
    """The bitmaps of some line keys: (month_key, blocks, block, bits)."""
    rows = _with_block(keys, blocks).where(F.col("block").isNotNull()).select(
        "month_key", "blocks", "block", F.explode(F.array(*_positions())).alias("pos"))
    return rows.groupBy("month_key", "blocks", "block").agg(F.bitmap_construct_agg("pos").alias("bits"))


def _bit(bits: Column, pos: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(pos / 8).cast("int") + F.lit(1), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (pos % 8).cast("int")) == 1


def maybe_loaded(keys: DataFrame, bitmaps: DataFrame, blocks: dict[int, int]) -> DataFrame:
    """``keys`` with ``maybe``: false only for lines that are surely not
    loaded, as are all lines of a month without a filter."""
    merged = bitmaps.groupBy(F.col("month_key").alias("_m"), F.col("block").alias("_b")).agg(F.bitmap_or_agg("bits").alias("_bits"))
    at = _with_block(keys, blocks)
    met = at.join(merged, (F.col("month_key") == F.col("_m")) & (F.col("block") == F.col("_b")), "left")
    held = reduce(and_, (_bit(F.col("_bits"), p) for p in _positions()))
    return met.select(*keys.columns, F.coalesce(held, F.lit(False)).alias("maybe"))


# --- new lines -----------------------------------------------------------------


def new_keys(keys: DataFrame, bitmaps: DataFrame, blocks: dict[int, int], existing: DataFrame) -> tuple[DataFrame, int]:
    """The keys that ``existing`` (fact rows with ``month_key``) does not
    hold, and the number of those it does. The fact is read only where the
    filter leaves a doubt: its months, and not at all if there is none."""
    flagged = maybe_loaded(keys, bitmaps, blocks).checkpoint(eager=True)
    doubt = flagged.where("maybe")
    months = sorted(r["month_key"] for r in doubt.select("month_key").distinct().collect())
    sure = flagged.where(~F.col("maybe")).select(*keys.columns)
    if not months:
        return sure, 0
    held = existing.where(F.col("month_key").isin(months)).select(*FACT_LINE_KEY)
    fresh = doubt.join(held, _same(doubt, held), "left_anti").select(*keys.columns).checkpoint(eager=True)
    return sure.unionByName(fresh), doubt.count() - fresh.count()


def build_new(tx_clean: DataFrame, items: DataFrame, dim_customer: DataFrame, dim_product: DataFrame, new: DataFrame,
              loaded: int = 1) -> DataFrame:
    """The fact rows of the new lines. Baskets with a new line are built
    whole, as basket metrics need all their lines; the others are not read
    past their ids. Where none of the batch's lines is ``loaded``, all are
    new and nothing has to be looked for."""
    if not loaded:
        return facts.build_fact(tx_clean, items, dim_customer, dim_product)
    baskets = new.select("transaction_id").distinct()
    rows = facts.build_fact(tx_clean.join(baskets, "transaction_id", "left_semi"),
                            items.join(baskets, "transaction_id", "left_semi"), dim_customer, dim_product)
    return rows.join(new, _same(rows, new), "left_semi")


# --- the stored filter -----------------------------------------------------------


def stored_blocks(spark: SparkSession, path: str) -> dict[int, int]:
    """Blocks of each month that has a stored filter."""
    rows = read_or_empty(spark, path, FILTER).groupBy("month_key").agg(F.max("blocks").alias("b")).collect()
    return {r["month_key"]: r["b"] for r in rows}


def append_filter(keys: DataFrame, path: str, known: dict[int, int]) -> None:
    line_filter(keys, blocks_for(keys, known)).hint("rebalance", "month_key").write.mode("append").partitionBy("month_key").parquet(path)


def ensure_filter(spark: SparkSession, fact: DataFrame, path: str, months: list[int]) -> dict[int, int]:
    """Build the filter of those ``months`` that the fact holds and that have
    none yet; returns the blocks of every month with a filter."""
    known = stored_blocks(spark, path)
    missing = [m for m in months if m not in known]
    if missing:
        keys = fact.where(F.col("month_key").isin(missing)).select(*FACT_LINE_KEY, "month_key")
        if not keys.isEmpty():
            append_filter(keys, path, known)
            known = stored_blocks(spark, path)
    return known
