"""Data-quality audits: the constraints a relational warehouse enforces at
write time, reported as DataFrames of (rule, n_violations).

Each audit over one table is a single aggregate pass (conditional counts),
unpivoted to one row per rule; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.operators.joins import broadcast_if_small

# Declared column lengths of the source tables.
VARCHAR_LIMITS = {
    "customers": {"name": 100, "email": 150, "city": 100},
    "products": {"product_name": 150, "category": 100},
    "marketing_campaigns": {"campaign_name": 150, "channel": 50},
}


def rules_to_rows(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One aggregate pass: rule name -> count of rows where the violation
    predicate is true; then one output row per rule."""
    names = list(rules)
    agg = df.agg(*[F.count_if(F.coalesce(rules[n], F.lit(False))).alias(f"_r{i}")
                   for i, n in enumerate(names)])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(n).alias("rule"), F.col(f"_r{i}").cast("long").alias("n_violations"))
        for i, n in enumerate(names)
    ]))
    return agg.select(stacked.alias("_x")).select("_x.rule", "_x.n_violations")


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def null_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """NOT NULL on every column of every table."""
    return _union([
        rules_to_rows(df, {f"{t}.{c} not null": F.col(c).isNull() for c in df.columns})
        for t, df in tables.items()
    ])


def duplicate_keys(df: DataFrame, keys: Sequence[str], rule: str) -> DataFrame:
    """Number of key values held by more than one row (NULL keys are not
    compared, as in a UNIQUE constraint). Grouped count with map-side
    combine, so a hot key costs one row per map task."""
    keys = list(keys)
    non_null = df.dropna(subset=keys)
    dup = non_null.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > 1)
    return dup.agg(F.count(F.lit(1)).cast("long").alias("n_violations")) \
        .select(F.lit(rule).alias("rule"), "n_violations")


def unique_violations(checks: Sequence[tuple[str, DataFrame, Sequence[str]]]) -> DataFrame:
    return _union([duplicate_keys(df, keys, rule) for rule, df, keys in checks])


#: Ids of a block, the size of Spark's bitmaps, and the bytes of one bitmap.
BLOCK_IDS, BLOCK_BYTES = 32_768, 4096


def doubtful_blocks(df: DataFrame, key: str) -> DataFrame:
    """(block, rows): blocks of consecutive integer ids that hold more rows
    than different ids. A block is a bitmap, a bit an id, so this is exact;
    one bitmap for each task and block is shuffled, and no id."""
    at = F.col(key).cast("long")
    blocks = df.where(at.isNotNull()).groupBy(F.bitmap_bucket_number(at).alias("block")).agg(
        F.count(F.lit(1)).alias("rows"), F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(at))).alias("_ids"))
    return blocks.where(F.col("rows") > F.col("_ids")).drop("_ids")


def clustered(df: DataFrame, key: str) -> bool:
    """Whether bitmaps of all (partition, block) pairs take less room than the
    ids: so where ids lie together, as in files written in id order."""
    at = F.col(key).cast("long")
    pairs = df.where(at.isNotNull()).groupBy(F.spark_partition_id().alias("p"), F.bitmap_bucket_number(at).alias("block")) \
        .agg(F.count(F.lit(1)).alias("n"))
    n_pairs, rows = pairs.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    return n_pairs * BLOCK_BYTES <= rows * 8


def duplicate_ids(df: DataFrame, key: str, rule: str) -> DataFrame:
    """``duplicate_keys`` of one integer key (null ids are not compared) that
    shuffles the ids of doubtful blocks only: none where all are unique.
    Where the ids lie scattered, bitmaps would be larger than the ids, and the
    grouped count is taken; both give the same number."""
    if not clustered(df, key):
        return duplicate_keys(df, [key], rule)
    blocks = doubtful_blocks(df, key).select("block")
    at = df.select(F.col(key).cast("long").alias(key)).where(F.col(key).isNotNull()).withColumn("block", F.bitmap_bucket_number(key))
    return duplicate_keys(at.join(broadcast_if_small(blocks), "block", "left_semi"), [key], rule)


def check_violations(checks: Sequence[tuple[str, DataFrame, Column]]) -> DataFrame:
    """CHECK constraints: a row violates when the predicate is FALSE (a
    NULL result passes, as in SQL)."""
    return _union([rules_to_rows(df, {rule: ~pred}) for rule, df, pred in checks])


def length_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    frames = []
    for t, limits in VARCHAR_LIMITS.items():
        df = tables[t]
        frames.append(rules_to_rows(df, {f"{t}.{c} length <= {n}": F.length(c) > n
                                          for c, n in limits.items()}))
    return _union(frames)


def precision_violations(checks: Sequence[tuple[str, DataFrame, Column, str]]) -> DataFrame:
    """Values that do not fit their declared decimal type."""
    return _union([
        rules_to_rows(df, {rule: value.isNotNull() & value.try_cast(dtype).isNull()})
        for rule, df, value, dtype in checks
    ])


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose parent key is missing (foreign-key violations).

    The missing keys are found on one row per key (child keys aggregated
    with a map-side combine, then anti-joined to the distinct parent keys),
    so a hot key never sits in one task; only then are the child rows of
    the missing keys fetched, with a checked broadcast of that key set."""
    missing = _missing_keys(child, parent, key, key)
    return child.join(broadcast_if_small(missing.select(key)), key)


def _missing_keys(child: DataFrame, parent: DataFrame, ckey: str, pkey: str) -> DataFrame:
    counts = child.where(F.col(ckey).isNotNull()).groupBy(ckey).agg(F.count(F.lit(1)).alias("_rows"))
    parents = parent.select(F.col(pkey).alias(ckey)).where(F.col(ckey).isNotNull()).distinct()
    return counts.join(parents, ckey, "left_anti")


def fk_violations(checks: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """rule, n: rows of a child whose (non-NULL) key is not in the parent,
    counted on one row per key (skew-safe)."""
    frames = []
    for rule, child, ckey, parent, pkey in checks:
        miss = _missing_keys(child, parent, ckey, pkey)
        frames.append(miss.agg(F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("n_violations"))
                      .select(F.lit(rule).alias("rule"), "n_violations"))
    return _union(frames)


def fk_violations_one_pass(child: DataFrame, checks: Sequence[tuple[str, str, DataFrame, str]]) -> DataFrame:
    """Several foreign keys of one (large) child table in one pass.

    Each child row is exploded into one (rule, key) pair per foreign key
    and aggregated with a map-side combine, so the child is read once and a
    hot key costs one row per task; the pairs are then anti-joined to the
    parent keys tagged with the same rule. ``checks`` = (rule, child key
    column, parent, parent key column); key values are compared as long."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.col(ckey).cast("long").alias("k"))
        for rule, ckey, _, _ in checks
    ]))
    counts = (child.select(pairs.alias("_p")).select("_p.rule", "_p.k").where(F.col("k").isNotNull())
              .groupBy("rule", "k").agg(F.count(F.lit(1)).alias("_rows")))
    parents = _union([parent.select(F.lit(rule).alias("rule"), F.col(pkey).cast("long").alias("k"))
                      for rule, _, parent, pkey in checks]).distinct()
    missing = counts.join(parents, ["rule", "k"], "left_anti").groupBy("rule").agg(F.sum("_rows").alias("_n"))
    rules = child.sparkSession.createDataFrame([(r,) for r, _, _, _ in checks], "rule string")
    return rules.join(missing, "rule", "left").select(
        "rule", F.coalesce(F.col("_n"), F.lit(0)).cast("long").alias("n_violations"))
