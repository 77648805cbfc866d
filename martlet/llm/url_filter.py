"""URL filters: exact membership of listed keys by a cascade of Bloom filters.

A rule is a host and a path. Its key is compared with the keys of a url: its
host's last labels with a beginning of its path, for each (number of labels,
length of path) that occurs among the rules. All such keys of the corpus are
the *universe*. Level 1 of a cascade encodes the listed keys; level 2 the
keys of the universe that level 1 takes wrongly; level 3 the listed keys
that level 2 takes wrongly, and so on until a level has no wrong keys. On
the universe the cascade is then exact, and judging the urls needs no join.

One cascade holds the block rules, another the allow rules. Of the listed
keys of a url the longest wins (then the longer host); a key that is on both
lists allows. A url without a listed key is allowed.

A filter has ``BITS`` bits for a key, built by Spark as words of 64 bits.
Filters grow with the rules and are sent to the tasks; ``max_bytes`` bounds
them, and beyond it the rules are refused rather than cut.

Cases: a null url or one without ``://`` has empty host and path and no
rule. Rules are (host, path, verdict) rows; rows with nulls are left out,
repeated ones count once. Extra columns of the pages are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm import _words as w
from martlet.llm._common import ship, stored

BITS, HASHES = 12, 6
U = np.uint64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 2)


def slots(h: np.ndarray, level: int, bits: int) -> np.ndarray:
    """HASHES bit positions for each key hash, different on each level."""
    a = w.mix(h + U(level) * w.MUL)
    b = w.mix(a ^ w.MUL) | U(1)
    return ((a[:, None] + np.arange(HASHES, dtype=U) * b[:, None]) % U(bits)).astype(np.int64)


def passes(words: np.ndarray, h: np.ndarray, level: int) -> np.ndarray:
    at = slots(h, level, 64 * len(words))
    return (words[at >> 6] >> (at & 63).astype(U) & U(1)).astype(bool).all(1)


class Cascade:
    """Filters of one list; ``member`` is exact on the universe."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels

    def member(self, h: np.ndarray) -> np.ndarray:
        out = np.full(len(h), len(self.levels) % 2 == 1)
        left = np.arange(len(h))
        for k, words in enumerate(self.levels):
            ok = passes(words, h[left], k)
            out[left[~ok]] = k % 2 == 1
            left = left[ok]
        return out


def bitmap(keys: DataFrame, level: int, words: int) -> np.ndarray:
    """A Bloom filter of ``words`` words of the hashes ``h``."""

    def bits(batches):
        for batch in batches:
            at = np.unique(slots(batch.column("h").to_numpy().view(U), level, 64 * words))
            yield pa.RecordBatch.from_pydict({"word": pa.array(at >> 6), "bits": pa.array((U(1) << (at & 63).astype(U)).view(np.int64))})

    rows = keys.select("h").mapInArrow(bits, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(words, U)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(U)
    return out


def _filter(keys: DataFrame, level: int, max_bytes: int) -> np.ndarray | None:
    """A Bloom filter of the keys' hashes, or None if there are no keys."""
    n = keys.count()
    if not n:
        return None
    words = max(4, -(-n * BITS // 64))
    if 8 * words > max_bytes:
        raise ValueError(f"{n} keys need a filter of {8 * words} bytes, over max_bytes")
    return bitmap(keys, level, words)


def _passing(keys: DataFrame, words: np.ndarray, level: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(passes(words, batch.column("h").to_numpy().view(U), level)))

    return keys.mapInArrow(run, keys.schema)


def build(listed: DataFrame, universe: DataFrame, max_bytes: int = 256 << 20) -> Cascade:
    """The cascade of ``listed`` over ``universe``, both (host, path, h)."""
    key = ["host", "path"]
    inside, outside, levels = stored(listed), universe, []
    while len(levels) < 64:
        words = _filter(inside, len(levels), max_bytes)
        if words is None:
            return Cascade(levels)
        wrong = _passing(outside, words, len(levels))
        if not levels:  # the universe has the listed keys as well
            wrong = wrong.join(inside, key, "left_anti")
        levels.append(words)
        inside, outside = stored(wrong), inside
    raise RuntimeError("two different keys have the same hash")


def _keys(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The keys of a url that have one of the rules' shapes."""
    labels = F.split(host, "\\.", -1)
    at = lambda n: F.array_join(F.slice(labels, F.size(labels) - (n - 1), n), ".")
    one = [F.when((host != "") & (F.size(labels) >= n) & (F.length(path) >= m), F.struct(at(n).alias("host"), F.substring(path, 1, m).alias("path")))
           for n, m in shapes]
    return F.filter(F.array(*one), lambda x: x.isNotNull())


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", max_bytes: int = 256 << 20) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (null if none) and ``verdict``.

    Columns of ``pages`` with one of these four names, in any case, are
    replaced. A rule whose verdict is neither ``block`` nor ``allow`` is an
    error (``ValueError``)."""
    spark = pages.sparkSession
    ship(spark)
    rules = stored(rules.select("host", "path", "verdict").dropna().distinct().withColumn("h", F.xxhash64("host", "path")))
    odd = rules.filter(~F.col("verdict").isin("block", "allow")).first()
    if odd is not None:
        raise ValueError(f"verdict of rule {odd['host']}{odd['path']} is neither block nor allow: {odd['verdict']}")
    sizes = F.size(F.split("host", "\\.", -1)), F.length("path")
    shapes = sorted(tuple(r) for r in rules.select(*sizes).distinct().collect())
    host, path = host_and_path(F.col(url))
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    pages = pages.select(*[F.col(f"`{c}`") for c in kept], host.alias("host"), path.alias("path"))
    own = "__keys"
    while own in {c.lower() for c in kept}:
        own += "_"
    if not shapes:
        return pages.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit("allow"))
    keys = _keys(F.col("host"), F.col("path"), shapes)
    universe = stored(pages.select(F.explode(keys).alias("k")).select("k.*").distinct().withColumn("h", F.xxhash64("host", "path")))
    lists = [build(rules.filter(F.col("verdict") == v).select("host", "path", "h"), universe, max_bytes) for v in ("block", "allow")]
    sent = spark.sparkContext.broadcast(lists)

    def run(batches):
        block, allow = sent.value
        for batch in batches:
            lists_ = batch.column(own)
            edge = lists_.offsets.to_numpy()
            flat = lists_.flatten()
            h = flat.field("h").to_numpy().view(U)
            hosts, paths = flat.field("host").to_pylist(), flat.field("path").to_pylist()
            on = np.where(allow.member(h), 2, np.where(block.member(h), 1, 0))
            rule, verdict = [None] * batch.num_rows, ["allow"] * batch.num_rows
            best = [(-1, -1)] * batch.num_rows
            row = np.repeat(np.arange(batch.num_rows), np.diff(edge))
            for i in np.flatnonzero(on).tolist():
                size = (len(hosts[i]) + len(paths[i]), len(hosts[i]))
                r = int(row[i])
                if size > best[r]:
                    best[r], rule[r], verdict[r] = size, hosts[i] + paths[i], "allow" if on[i] == 2 else "block"
            rest = batch.drop_columns([own])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                                             names=[*rest.schema.names, "rule", "verdict"])

    hashed = F.transform(keys, lambda k: F.struct(k["host"].alias("host"), k["path"].alias("path"), F.xxhash64(k["host"], k["path"]).alias("h")))
    wide = pages.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit("")).schema
    return pages.withColumn(own, hashed).mapInArrow(run, wide)
