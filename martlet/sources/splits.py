"""Splits of equal depth for relational reads.

Uniform bounds over a key's range leave most rows in a few splits where keys
are dense in some places and sparse in others. Here the key's own histogram
gives the bounds: the database counts rows in slots of one width, slots with
many rows are counted again in finer ones, one grouped query for each level,
and the slots are then cut into splits at multiples of the wanted depth.

The driver holds slot counts only, at most ``FINE * FAN`` for each split and
level. Slots are refined until they hold a ``FINE``-th of a split, so a split
is off its depth by that part at most, on either side; a single key value
that holds more rows cannot be cut and stays one slot.

The queries use integer arithmetic and MOD alone, which any dialect has. Null
keys go to the first split, and the outer splits are open, so rows inserted
after planning are read too. Keys are integers whose range fits 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from martlet.schemas import SOURCE_KEYS, SOURCES
from martlet.sources.readers import conform, jdbc_options

FIRST, FAN, FINE = 1024, 16, 8

Run = Callable[[str], DataFrame]


def range_sql(table: str, key: str) -> str:
    return f"SELECT MIN({key}) AS lo, MAX({key}) AS hi, COUNT({key}) AS n FROM {table}"


def slots_sql(table: str, key: str, lo: int, width: int, above: int | None = None, within: Sequence[int] = ()) -> str:
    """Rows of each slot of ``width`` keys, by the slot's offset from ``lo``;
    only inside some slots of the coarser width ``above``, if one is given."""
    at = f"({key} - ({lo}))"
    where = f"{key} IS NOT NULL"
    if above is not None:
        where += f" AND {at} - MOD({at}, {above}) IN ({', '.join(map(str, within))})"
    slot = f"{at} - MOD({at}, {width})"
    return f"SELECT {slot} AS slot, COUNT(*) AS n FROM {table} WHERE {where} GROUP BY {slot}"


def plan(run: Run, table: str, key: str, rows_per_split: int) -> list[str]:
    """WHERE conditions that cover every row of ``table`` once, each with
    about ``rows_per_split`` rows. ``run`` executes SQL on the source."""
    if rows_per_split < 1:
        raise ValueError("a split holds at least one row")
    lo, hi, n = run(range_sql(table, key)).first()
    if not n:
        return ["1 = 1"]
    lo, hi, n = int(lo), int(hi), int(n)
    width = max(1, math.ceil((hi - lo + 1) / FIRST))
    width = FAN ** math.ceil(math.log(width, FAN)) if width > 1 else 1
    done, above, heavy = [], None, []
    while True:
        counts = [(int(s), int(c)) for s, c in run(slots_sql(table, key, lo, width, above, heavy)).collect()]
        many = {s for s, c in counts if c * FINE > rows_per_split} if width > 1 else set()
        done += [(s, c) for s, c in counts if s not in many]
        if not many:
            break
        above, heavy, width = width, sorted(many), max(1, width // FAN)
    return predicates(key, lo, cuts(sorted(done), rows_per_split))


def cuts(slots: Sequence[tuple[int, int]], rows_per_split: int) -> list[int]:
    """Offsets at which a new split starts: where the rows so far pass a
    multiple of the depth, which is the wanted one or less so that the last
    split is as deep as the others."""
    total = sum(c for _, c in slots)
    depth = total / max(1, math.ceil(total / rows_per_split))
    out, before, split = [], 0, 0
    for slot, c in slots:
        # The split of a slot is that of its middle row.
        now = min(int((before + c / 2) / depth), math.ceil(total / depth) - 1)
        if now > split:
            if before:
                out.append(slot)
            split = now
        before += c
    return out


def predicates(key: str, lo: int, starts: Sequence[int]) -> list[str]:
    if not starts:
        return ["1 = 1"]
    at = [lo + s for s in starts]
    inner = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(at, at[1:])]
    return [f"{key} < {at[0]} OR {key} IS NULL", *inner, f"{key} >= {at[-1]}"]


def read_jdbc_splits(spark: SparkSession, url: str, table: str, rows_per_split: int = 1_000_000,
                     user: str | None = None, password: str | None = None, fetch_size: int = 10_000) -> DataFrame:
    """One source table over JDBC, read in splits of equal depth of its key."""
    opts = jdbc_options(url, table, user, password, fetch_size=fetch_size)

    def run(query: str) -> DataFrame:
        return spark.read.format("jdbc").options(**{**opts, "dbtable": f"({query}) q"}).load()

    conditions = plan(run, table, SOURCE_KEYS[table], rows_per_split)
    login = {k: v for k, v in opts.items() if k not in ("url", "dbtable")}
    return conform(spark.read.jdbc(url, table, predicates=conditions, properties=login), SOURCES[table])
