"""Order-dependent operators that stay distributed under skew.

Spark's ``row_number().over(Window.orderBy(...))`` without a partition key
moves every row to one task, and ``Window.partitionBy(k)`` moves every row
of a key to one task. Both break when one key (or the whole table) is large.
The operators here use the classic two-pass prefix scheme instead:

1. ``repartitionByRange`` on the full ordering, so every partition holds a
   contiguous slice of the order and a hot key is spread over several
   partitions; rows are then sorted inside their partition.
2. The slice is materialised once with ``checkpoint()`` in the cluster's
   checkpoint folder, so that the partition a row landed in is fixed for
   both passes below (range bounds are sampled per job) and a lost executor
   cannot change it.
3. Per (partition, group) totals, one row each, give every group its carry
   from earlier partitions via a window whose groups hold at most one row
   per partition.
4. Each row adds its in-partition prefix to the carry.

No step holds more than one partition's worth of a key in one task, and
nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.session import checkpoint_dir

_ROW = "_martlet_row"
_PID = "_martlet_pid"
_POS = "_martlet_pos"
_LOW_BITS = 33  # monotonically_increasing_id: partition id << 33 | position


def _cols(cols: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def range_slices(df: DataFrame, order: Sequence[Column | str],
                 num_partitions: int | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted on ``order``, with the slice
    number (``_martlet_pid``) and the position inside the slice
    (``_martlet_pos``, from 0), materialised in the checkpoint folder.
    Only the ``keep`` columns (default: all) are written there."""
    checkpoint_dir(df.sparkSession)
    order_cols = _cols(order)
    kept = list(keep) if keep is not None else df.columns
    # Without an explicit count AQE may merge adjacent range partitions by
    # their measured size: still contiguous slices of the order, but a small
    # input no longer runs hundreds of near-empty tasks.
    ranged = (df.repartitionByRange(num_partitions, *order_cols) if num_partitions
              else df.repartitionByRange(*order_cols))
    sliced = (
        ranged
        .sortWithinPartitions(*order_cols)
        .withColumn(_ROW, F.monotonically_increasing_id())
        .select(*kept, _ROW)
        .checkpoint(eager=True)
    )
    return (
        sliced.withColumn(_PID, F.shiftrightunsigned(F.col(_ROW), _LOW_BITS).cast("int"))
        .withColumn(_POS, F.col(_ROW).bitwiseAND(F.lit((1 << _LOW_BITS) - 1)))
        .drop(_ROW)
    )


def global_row_number(df: DataFrame, order: Sequence[Column | str], out: str,
                      num_partitions: int | None = None, offset: Column | int = 0,
                      keep: Sequence[str] | None = None) -> DataFrame:
    """Dense 1..n numbering of ``df`` in ``order`` (which must be total for
    a deterministic result), plus ``offset``. Distributed equivalent of
    ``row_number() over (order by ...)``. ``keep`` limits the columns
    carried past the numbering (default: all).

    The rows per slice (one number per partition: a list bounded by the
    partition count) are collected once; each row then adds the literal
    start of its slice to its position, a projection with no join."""
    sliced = range_slices(df, order, num_partitions, keep)
    sizes = {r[_PID]: int(r["_n"]) for r in
             sliced.groupBy(_PID).agg(F.count(F.lit(1)).alias("_n")).collect()}
    starts, acc = [], 0
    for pid in range(max(sizes) + 1 if sizes else 1):
        starts.append(acc)
        acc += sizes.get(pid, 0)
    off = offset if isinstance(offset, Column) else F.lit(offset)
    start = F.element_at(F.lit(starts).cast("array<bigint>"), F.col(_PID) + 1)
    return (
        sliced.withColumn(out, start + F.col(_POS) + 1 + off)
        .drop(_PID, _POS)
    )


def running_sum(df: DataFrame, partition_by: Sequence[str], order: Sequence[Column | str],
                value: Column | str, out: str, num_partitions: int | None = None) -> DataFrame:
    """``sum(value) over (partition by ... order by ... rows between
    unbounded preceding and current row)`` without putting a whole group
    in one task. ``order`` must be total within a group."""
    val = F.col(value) if isinstance(value, str) else value
    keyed = df.withColumn("_martlet_v", val)
    sliced = range_slices(keyed, [*partition_by, *order], num_partitions)
    local = sliced.withColumn(
        "_local",
        F.sum("_martlet_v").over(
            Window.partitionBy(_PID, *partition_by).orderBy(_POS)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ),
    )
    totals = sliced.groupBy(_PID, *partition_by).agg(F.sum("_martlet_v").alias("_t"))
    carry = totals.select(
        _PID, *partition_by,
        F.sum("_t").over(
            Window.partitionBy(*partition_by).orderBy(_PID)
            .rowsBetween(Window.unboundedPreceding, -1)
        ).alias("_carry"),
    )
    # A null group key is a group of its own, as in a window: the join is null-safe.
    keys = {c: f"_k_{c}" for c in [_PID, *partition_by]}
    carry = carry.withColumnsRenamed(keys)
    same = reduce(and_, (local[c].eqNullSafe(carry[k]) for c, k in keys.items()))
    result = local.join(carry, same).drop(*keys.values())
    return (
        result.withColumn(out, F.coalesce(F.col("_carry"), F.lit(0)) + F.col("_local"))
        .drop(_PID, _POS, "_local", "_carry", "_martlet_v")
    )


def rank_in_group(df: DataFrame, partition_by: Sequence[str], order: Sequence[Column | str],
                  out: str, num_partitions: int | None = None) -> DataFrame:
    """``row_number() over (partition by ... order by ...)``, skew-safe."""
    ranked = running_sum(df, partition_by, order, F.lit(1).cast("long"), out, num_partitions)
    return ranked.withColumn(out, F.col(out).cast("int"))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Keep the first row of every key, where "first" is the ascending order
    of ``order`` (default: every non-key column in schema order), NULLs last.

    Implemented as ``min(struct(order..., payload...))`` per key, an
    aggregate with a map-side partial step: a key that holds a third of
    all rows is reduced to one row per map task before the shuffle."""
    others = [c for c in df.columns if c not in keys]
    order = list(order) if order is not None else others
    payload = [c for c in others if c not in order]
    fields = []
    for i, c in enumerate(order):
        fields.append(F.col(c).isNull().alias(f"_n{i}"))
        fields.append(F.col(c).alias(c))
    fields += [F.col(c).alias(c) for c in payload]
    best = df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_first"))
    return best.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in others])
