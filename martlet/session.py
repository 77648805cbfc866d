"""Session construction and the runtime settings the mart relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime SQL settings. They are applied only where the cluster has not set
# them already, so a deployment keeps full control over sizing.
RUNTIME_DEFAULTS = {
    # AQE re-plans joins from real shuffle sizes: a dimension that turns out
    # small becomes a broadcast join, large ones stay sort-merge, and a hot
    # key on the probe side is split by the skew-join rule.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Every timestamp in the mart is wall-clock without zone; pin the session
    # zone so that date_format / date_trunc never depend on the host.
    "spark.sql.session.timeZone": "UTC",
    # Dynamic partition pruning of fact month partitions through dim_date.
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``RUNTIME_DEFAULTS`` where unset and make sure a checkpoint
    directory is known (see :func:`checkpoint_dir`)."""
    for key, value in RUNTIME_DEFAULTS.items():
        if key == "spark.sql.session.timeZone":
            spark.conf.set(key, value)
            continue
        try:
            current = spark.conf.get(key, None)
        except Exception:  # pragma: no cover - conf not readable
            current = None
        if current is None:
            spark.conf.set(key, value)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory named by the cluster.

    The setting ``spark.checkpoint.dir`` is read from the session. Only a
    local-mode session without one (unit tests) gets a private directory;
    on a cluster a missing setting is an error, because a machine-local
    folder would not survive the loss of that machine.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server's setting applies
        return spark.conf.get("spark.checkpoint.dir", "")
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="martlet-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; point it at a shared, durable folder"
    )


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "martlet") -> SparkSession:
    """Session for tests and the local benchmark (UI off, UTC)."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
