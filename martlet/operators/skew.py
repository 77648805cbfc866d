"""Skew handling for the many-to-one joins of the fact build.

A transaction (or any join key) that holds a large share of the lines
would put all of them in one task of a sort-merge join, and AQE's skew-join
rule cannot split a join whose other side comes out of an aggregate. So the
hot keys are found up front and split explicitly:

* ``heavy_hitters`` samples the key column and keeps the ``1/min_share``
  most frequent keys (a proven bound: it is collected and broadcast) that
  also reach an absolute floor, each with a bucket count sized to
  ``rows_per_bucket``; any key left out holds at most ``min_share`` of the
  rows.
* ``salted_join`` spreads the many side of a hot key over its buckets
  (hash of a row id) and replicates the one side of that key once per
  bucket. Keys that are not hot get bucket 0 and are not replicated.

The two sides are joined on (key, bucket), so the output keeps that hash
partitioning and a second salted join on the same key (the basket metrics
join-back) needs no new shuffle of the many side.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SALT = "_martlet_salt"

# Tunables (session conf keys, defaults).
CONF_FRACTION = ("martlet.skew.sampleFraction", 0.01)
CONF_MIN_SHARE = ("martlet.skew.minShare", 1e-5)
CONF_MIN_SAMPLED = ("martlet.skew.minSampledRows", 200)
CONF_ROWS_PER_BUCKET = ("martlet.skew.rowsPerBucket", 2_000_000)
CONF_MAX_BUCKETS = ("martlet.skew.maxBuckets", 4096)


def _conf(spark: SparkSession, item: tuple[str, float]) -> float:
    key, default = item
    return float(spark.conf.get(key, str(default)))


@dataclass
class HotKeys:
    """The hot values of ``key`` and their bucket counts (a bounded list
    held on the driver), plus the same list as a broadcastable frame."""

    key: str
    buckets: dict = field(default_factory=dict)
    frame: DataFrame | None = None

    @property
    def values(self) -> list:
        return list(self.buckets)


def heavy_hitters(df: DataFrame, key: str, seed: int = 17) -> HotKeys:
    """Hot values of ``key`` with their bucket counts; at most
    ``1 / minShare`` of them, found from one sampled aggregate."""
    spark = df.sparkSession
    frac = _conf(spark, CONF_FRACTION)
    min_share = _conf(spark, CONF_MIN_SHARE)
    floor_rows = _conf(spark, CONF_MIN_SAMPLED)
    per_bucket = _conf(spark, CONF_ROWS_PER_BUCKET)
    max_buckets = int(_conf(spark, CONF_MAX_BUCKETS))
    sample = df.select(key).where(F.col(key).isNotNull()).sample(fraction=frac, seed=seed)
    counts = sample.groupBy(key).agg(F.count(F.lit(1)).alias("_c"))
    # At most 1/min_share keys, taken as a distributed top-k (each task keeps
    # its k largest, the driver merges k per task): a bounded list. A key
    # outside the top k holds at most min_share of the sample.
    top = int(math.ceil(1 / min_share))
    rows = counts.where(F.col("_c") >= floor_rows).orderBy(F.col("_c").desc()).limit(top).collect()
    pairs = [(r[key], int(min(max_buckets, max(2, math.ceil(r["_c"] / frac / per_bucket))))) for r in rows]
    schema = f"{key} {df.schema[key].dataType.simpleString()}, _buckets int"
    return HotKeys(key, dict(pairs), spark.createDataFrame(pairs, schema))


def _with_buckets(df: DataFrame, key: str, hot: HotKeys) -> DataFrame:
    if not hot.buckets:
        return df.withColumn("_buckets", F.lit(1))
    return df.join(F.broadcast(hot.frame), key, "left").withColumn(
        "_buckets", F.coalesce(F.col("_buckets"), F.lit(1)))


def spread(many: DataFrame, key: str, hot: HotKeys, row_id: str) -> DataFrame:
    """Many side: bucket = hash(row id) mod buckets of its key (0 if cold)."""
    b = _with_buckets(many, key, hot)
    return b.withColumn(SALT, F.pmod(F.xxhash64(row_id), F.col("_buckets")).cast("int")).drop("_buckets")


def replicate(one: DataFrame, key: str, hot: HotKeys) -> DataFrame:
    """One side: one copy per bucket of its key (a single copy if cold)."""
    b = _with_buckets(one, key, hot)
    return b.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.col("_buckets") - 1))).drop("_buckets")


def salted_join(many: DataFrame, one: DataFrame, key: str, hot: HotKeys,
                row_id: str | None = None, how: str = "inner") -> DataFrame:
    """``many`` joined to ``one`` (at most one row per key) on ``key`` with
    hot keys split over buckets; ``how`` is ``inner`` or ``left``. ``many``
    may already carry the bucket column (from an earlier salted join on the
    same key and hot list); otherwise ``row_id`` names the column that
    spreads its rows."""
    if SALT not in many.columns:
        many = spread(many, key, hot, row_id)
    return many.join(replicate(one, key, hot), [key, SALT], how)
