"""Buckets of the ingest's tables, and their compaction.

Layout: ``<table>/bucket=B/query_id=Q/batch_id=N/*.parquet``. Merging goes by
levels: a bucket with more than ``MAX_BATCHES`` folders of one level (0 are
the batches) has these merged to one of the next. So a row is written again
once a level, and a bucket holds at most ``MAX_BATCHES`` folders of each of a
number of levels that grows with the logarithm of the batches. A merge is:

1. the rows of the listed folders are written to ``_merge-<level>-<id>/`` in
   the bucket (a name that readers skip);
2. ``_merge-<level>-<id>.done`` is created, holding the folders merged;
3. these folders are deleted;
4. the new one is renamed to ``query_id=merged-<level>/batch_id=<id>``;
5. the marker is deleted.

A crash before 2 leaves a folder that is thrown away, a crash after it is
rolled forward by ``recover``, which runs before the next batch. Rows are
never seen twice; between 3 and 4 a reader misses the merged rows, which an
insert-only load picks up the next time. A batch that runs again after its
rows were merged finds them stored and writes none of them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.sources.files import Files

BUCKET, BUCKETS = "bucket", 64
MAX_BATCHES = 16
MERGE, DONE, MERGED = "_merge-", ".done", "query_id=merged-"
#: Bytes of a merged file, about.
FILE_BYTES = 256 << 20
TAGS = (BUCKET, "query_id", "batch_id")


def bloom(level: int) -> dict[str, str]:
    """Writer options: a Bloom filter of the ids, sized for a batch's bucket and up by level."""
    return {"parquet.bloom.filter.enabled#transaction_id": "true",
            "parquet.bloom.filter.expected.ndv#transaction_id": str(min(10_000 * MAX_BATCHES**level, 2_000_000))}


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def write_buckets(df: DataFrame, path: str) -> None:
    """Write a batch, one file for each bucket it touches, replacing only the
    batch's own partitions."""
    (df.withColumn(BUCKET, bucket_of("transaction_id")).repartition(BUCKET).sortWithinPartitions(BUCKET, "transaction_id")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**bloom(0)).partitionBy(*TAGS).parquet(path))


def stored_buckets(spark: SparkSession, path: str, buckets: list[int]) -> DataFrame | None:
    """The stored rows of some buckets; other buckets are not even listed."""
    files = Files(spark, path)
    folders = [f"{path}/{BUCKET}={b}" for b in buckets if any(not n.startswith(("_", ".")) for n in files.names(f"{path}/{BUCKET}={b}"))]
    return spark.read.option("basePath", path).parquet(*folders) if folders else None


def batches(files: Files, folder: str) -> list[str]:
    """The batch folders of a bucket, as ``query_id=Q/batch_id=N``."""
    return [f"{q}/{n}" for q in files.names(folder) if q.startswith("query_id=") for n in files.names(f"{folder}/{q}") if n.startswith("batch_id=")]


def level_of(part: str) -> int:
    return int(part.removeprefix(MERGED).split("/")[0]) if part.startswith(MERGED) else 0


def compact(spark: SparkSession, path: str, buckets: list[int]) -> None:
    """Merge the levels of ``buckets`` that hold too many folders."""
    files = Files(spark, path)
    for b in buckets:
        folder, level = f"{path}/{BUCKET}={b}", 0
        parts = batches(files, folder)
        while parts:
            mine = [p for p in parts if level_of(p) == level]
            if len(mine) > MAX_BATCHES:
                name = f"{MERGE}{level + 1}-{uuid.uuid4().hex}"
                rows = spark.read.parquet(*[f"{folder}/{p}" for p in mine])
                n = 1 + sum(files.size(f"{folder}/{p}") for p in mine) // FILE_BYTES
                rows = rows.coalesce(1) if n == 1 else rows.repartitionByRange(n, "transaction_id")
                rows.sortWithinPartitions("transaction_id").write.options(**bloom(level + 1)).parquet(f"{folder}/{name}")
                files.write(f"{folder}/{name}{DONE}", "\n".join(mine))
                _finish(files, folder, name)
                parts = batches(files, folder)
            elif all(level_of(p) <= level for p in parts):
                break
            level += 1


def _finish(files: Files, folder: str, name: str) -> None:
    """Steps 3 to 5; each may have happened before."""
    for p in files.read(f"{folder}/{name}{DONE}").splitlines():
        files.delete(f"{folder}/{p}")
    if name in files.names(folder):
        level, _, key = name.removeprefix(MERGE).partition("-")
        files.rename(f"{folder}/{name}", f"{folder}/{MERGED}{level}/batch_id={key}")
    files.delete(f"{folder}/{name}{DONE}")


def recover(spark: SparkSession, path: str) -> None:
    """Roll merges forward that a crash has interrupted, throw unfinished ones away."""
    files = Files(spark, path)
    for bucket in files.names(path):
        if not bucket.startswith(f"{BUCKET}="):
            continue
        folder = f"{path}/{bucket}"
        names = files.names(folder)
        marked = {n.removesuffix(DONE) for n in names if n.endswith(DONE)}
        for name in sorted(marked):
            _finish(files, folder, name)
        for name in names:
            if name.startswith(MERGE) and not name.endswith(DONE) and name not in marked:
                files.delete(f"{folder}/{name}")
