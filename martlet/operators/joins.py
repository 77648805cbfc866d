"""Join helpers with an explicit size check before broadcasting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONF_MAX_ROWS = ("martlet.broadcast.maxRows", 2_000_000)


def broadcast_if_small(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """``broadcast(df)`` when ``df`` provably has at most ``max_rows`` rows,
    else ``df`` unchanged (the planner keeps a shuffle join, and AQE may
    still broadcast it from measured sizes).

    The check reads at most ``max_rows + 1`` rows of ``df`` (a limited
    count), so it is cheap even when the frame turns out large."""
    key, default = CONF_MAX_ROWS
    limit = int(max_rows if max_rows is not None else df.sparkSession.conf.get(key, str(default)))
    n = df.limit(limit + 1).count()
    return F.broadcast(df) if n <= limit else df


def lookup_flag(df: DataFrame, ref: DataFrame, key: str, flag: str, row_id: str) -> DataFrame:
    """``df`` plus a boolean ``flag``: true when ``key`` is present in
    ``ref`` (NULL otherwise). Rows are never multiplied (the reference keys
    are made distinct) nor dropped.

    Broadcast when the distinct key set is under the checked bound;
    otherwise a left join on (key, bucket) where hot keys of ``df`` are
    spread over buckets (``row_id`` spreads them), since AQE cannot split a
    join whose other side is an aggregate."""
    from martlet.operators import skew

    keys = ref.select(key).where(F.col(key).isNotNull()).distinct().withColumn(flag, F.lit(True))
    small = broadcast_if_small(keys)
    if small is not keys:
        return df.join(small, key, "left")
    hot = skew.heavy_hitters(df, key)
    return skew.salted_join(df, keys, key, hot, row_id=row_id, how="left").drop(skew.SALT)


CONF_MAX_KEYS = ("martlet.lookup.maxInlineKeys", 100_000)


def lookup_flag_by_keys(df: DataFrame, ref: DataFrame, key: str, flag: str, row_id: str) -> DataFrame:
    """``lookup_flag`` for a small ``df`` (a streaming micro-batch) against a
    large, live reference table: the distinct keys of ``df`` (at most
    ``maxInlineKeys``, checked) become a literal ``isin`` filter on the
    reference scan, which Parquet min/max statistics can use to skip row
    groups, so a batch reads what it references rather than the whole
    table. Beyond the bound it falls back to ``lookup_flag``."""
    cfg, default = CONF_MAX_KEYS
    bound = int(df.sparkSession.conf.get(cfg, str(default)))
    keys = [r[key] for r in df.select(key).where(F.col(key).isNotNull()).distinct().limit(bound + 1).collect()]
    if len(keys) > bound:
        return lookup_flag(df, ref, key, flag, row_id)
    hits = ref.select(key).where(F.col(key).isin(keys)).distinct().withColumn(flag, F.lit(True))
    return df.join(F.broadcast(hits), key, "left")  # at most len(keys) rows
