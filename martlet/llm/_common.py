"""Small helpers that the operators of this package share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

from martlet.session import checkpoint_dir

#: Bytes of rows that Spark sends a Python task at a time, where the session names no bound.
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so Python
    tasks can import it wherever they run, and bound the batches that these get."""
    if spark.conf.get(BATCH[0], None) is None:
        spark.conf.set(*BATCH)
    sc = spark.sparkContext
    if getattr(sc, "_martlet_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="martlet-zip-"), "martlet_pkg.zip")
    root = os.path.dirname(PACKAGE)
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(PACKAGE):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    sc._martlet_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.

    Unlike a cache this survives the loss of any executor, and the files are
    compressed columns with known sizes, so later joins are planned from
    real figures. The files stay until the folder is cleaned up.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/martlet-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spent(*tables: DataFrame) -> None:
    """Delete the files of ``stored`` tables that no later result reads."""
    for df in tables:
        spark = df.sparkSession
        for path in {os.path.dirname(f) for f in df.inputFiles()}:
            if not os.path.basename(path).startswith("martlet-"):
                raise ValueError(f"not a stored table: {path}")
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def arrow_schema(df: DataFrame, *drop: str):
    """The Arrow schema of ``df`` without some columns."""
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.drop(*drop).schema)


def tokenizer(name: str) -> str:
    """A vocabulary file of the folder ``MARTLET_TOKENIZERS`` names (/opt/tokenizers if unset)."""
    return os.path.join(os.environ.get("MARTLET_TOKENIZERS", "/opt/tokenizers"), name)
