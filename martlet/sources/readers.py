"""Readers and writers of the source, staging and warehouse tables.

Sources are read with an explicit schema; a relational source is read in
parallel slices over its key range (``partitionColumn`` / bounds) instead
of the reference's 10,000-row chunk loop.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.operators.gate import Gate, Rules, refuse
from martlet.schemas import SOURCE_KEYS, SOURCES
from martlet.sources.files import Files

LOG = "_log"


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 partition_column: str | None = None, lower: int | None = None,
                 upper: int | None = None, num_partitions: int = 64,
                 fetch_size: int = 10_000) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")``: a parallel key-range scan
    with a bounded fetch size (the JDBC driver jar must be on the cluster)."""
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if partition_column is not None and lower is not None and upper is not None:
        opts.update(partitionColumn=partition_column, lowerBound=str(lower),
                    upperBound=str(upper), numPartitions=str(num_partitions))
    return opts


def read_jdbc_source(spark: SparkSession, url: str, table: str, lower: int, upper: int,
                     **kw) -> DataFrame:
    """One source table over JDBC, sliced on its primary key."""
    opts = jdbc_options(url, table, partition_column=SOURCE_KEYS[table], lower=lower, upper=upper, **kw)
    df = spark.read.format("jdbc").options(**opts).load()
    return conform(df, SOURCES[table])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to the declared schema (missing columns and values
    that do not fit their type -> NULL, for the cleaning rules to judge)."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def read_parquet_source(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A source table stored as Parquet under ``root/table`` (extra columns,
    such as the partition columns the stream ingest adds, are dropped)."""
    return conform(spark.read.parquet(f"{root.rstrip('/')}/{table}"), SOURCES[table])


def snapshot_to_staging(spark: SparkSession, tables: Mapping[str, DataFrame], staging_root: str,
                        run_id: str | None = None, rules: Mapping[str, Rules] | None = None) -> str:
    """Copy every source table into ``staging_root/run=<id>/<table>`` and
    then publish them together by one entry of the commit log.

    With ``rules`` (by table) the violations are counted by the copy itself;
    if any table has some, the run is not published and ``RuleViolation``
    names those of all tables."""
    run_id = run_id or uuid.uuid4().hex
    root = staging_root.rstrip("/")
    violated: dict[str, int] = {}
    for name, df in tables.items():
        rows, guard = conform(df, SOURCES[name]), None
        if rules and name in rules:
            guard = Gate(rows, rules[name])
            rows = guard.rows
        rows.write.mode("overwrite").parquet(f"{root}/run={run_id}/{name}")
        if guard:
            violated.update({rule: n for rule, n in guard.counts().items() if n})
    refuse(violated)
    publish(spark, root, run_id, {name: f"run={run_id}/{name}" for name in tables})
    return run_id


def publish(spark: SparkSession, staging_root: str, run_id: str, folders: Mapping[str, str]) -> int:
    """Add the next entry to the commit log: an immutable file
    ``_log/<number>.json`` that names the folders of all tables of a run. It
    is created only if absent (of two writers one takes the next number) and
    nothing of an earlier run is touched, so a crash at any point leaves the
    previous snapshot as it is. Returns the number."""
    root = staging_root.rstrip("/")
    files = Files(spark, root)
    text = json.dumps({"run_id": run_id, "folders": dict(folders), "end": True})
    number = max([n for n, _ in _entries(files, root)], default=-1) + 1
    while True:
        path = f"{root}/{LOG}/{number:020d}.json"
        if not files.fs.exists(files.path(path)):
            try:
                files.write(path, text)
                return number
            except Exception:  # noqa: BLE001 - created by another writer meanwhile
                if not files.fs.exists(files.path(path)):
                    raise
        number += 1


def _entries(files: Files, root: str) -> list[tuple[int, str]]:
    names = files.names(f"{root}/{LOG}")
    return sorted((int(n.removesuffix(".json")), n) for n in names if n.endswith(".json") and n.removesuffix(".json").isdigit())


def published(spark: SparkSession, staging_root: str) -> dict:
    """The highest complete entry of the commit log: run_id and folders. An
    entry that a crash cut short does not parse and is passed over."""
    root = staging_root.rstrip("/")
    files = Files(spark, root)
    for _, name in reversed(_entries(files, root)):
        try:
            entry = json.loads(files.read(f"{root}/{LOG}/{name}"))
        except ValueError:
            continue
        if isinstance(entry, dict) and entry.get("end"):
            return entry
    raise RuntimeError(f"no published staging snapshot under {staging_root}")


def current_run(spark: SparkSession, staging_root: str) -> str:
    return published(spark, staging_root)["run_id"]


def read_staging(spark: SparkSession, staging_root: str) -> dict[str, DataFrame]:
    """The staged tables of the published run."""
    root, folders = staging_root.rstrip("/"), published(spark, staging_root)["folders"]
    return {t: spark.read.schema(SOURCES[t]).parquet(f"{root}/{folder}") for t, folder in folders.items()}


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a readable table.

    Asks the path's Hadoop file system directly (works for any scheme the
    cluster is configured for); a failed read attempt is the fallback where
    that gateway is not available (Spark Connect)."""
    try:
        jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(jsc.hadoopConfiguration())
        if not fs.exists(p):
            return False
        return any(not st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(p))
    except Exception:  # noqa: BLE001 - no JVM gateway
        pass
    try:
        spark.read.parquet(path).schema  # noqa: B018 - listing only, no job
        return True
    except Exception:  # noqa: BLE001 - missing path or empty folder
        return False


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A warehouse table, or an empty frame of its schema before the first load."""
    if path_exists(spark, path):
        return conform(spark.read.parquet(path), schema)
    return spark.createDataFrame([], schema)
