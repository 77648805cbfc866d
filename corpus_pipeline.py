"""The corpus pipeline: five training-data operators over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which the
caller writes and reads again as the next stage's documents. All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm import decontaminate, line_dedup, minhash_dedup, pieces, quality
from martlet.llm._common import stored, table, tokenizer
from martlet.session import checkpoint_dir


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; all of them
    where the labels teach no classifier (none is usable, or one class only)."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    if isinstance(model, float):
        return docs
    return quality.score(docs, model, cut=0.7).filter("predicted = 1").select(*docs.columns)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that are common on their site."""
    out = line_dedup.line_dedup(docs, host="source", ratio=0.1, min_pages=3)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a key of each document in ``__key``: a hash of its doc_id and text, either of them null or not."""
    return docs.withColumn("__key", F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each class of near copies, null ids
    last. A document is a doc_id and a text: repeated rows are one document,
    two texts of one doc_id are two, and a null id is an id like any other."""
    rows = keyed(docs)
    known = stored(rows.groupBy("__key").agg(F.min("doc_id").alias("id"), F.count("*").alias("n")))
    again = stored(known.filter("n > 1").select("__key"))
    near = stored(minhash_dedup.near_duplicates(rows.select(F.col("__key").alias("doc_id"), "text"), shingle=5, threshold=0.8))
    moved = near.filter("doc_id <> class_id")
    several = stored(moved.select("doc_id", "class_id").unionByName(moved.select(F.col("class_id").alias("doc_id"), "class_id")).distinct())
    of = stored(several.join(known, several.doc_id == known["__key"]).select("__key", "id", "class_id"))
    best = stored(of.groupBy("class_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "__key")).alias("best")))
    gone = of.join(best, "class_id").filter(F.col("__key") != F.col("best.__key")).select("__key")
    left = rows.join(stored(gone), "__key", "left_anti")
    if not again.isEmpty():
        once = left.join(again, "__key", "left_semi").groupBy("__key").agg(F.min(F.struct(*docs.columns)).alias("row"))
        left = left.join(again, "__key", "left_anti").select(*docs.columns).unionByName(once.select("row.*"))
    return left.select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage, of an item with an id or without."""
    rows = keyed(docs)
    items = table(spark, sf_dir, "benchmark").withColumn("item_id", F.coalesce("item_id", F.lit(-1)))
    found = decontaminate.contaminated(rows.select(F.col("__key").alias("doc_id"), "text"), items).select("doc_id").distinct()
    return rows.join(stored(found.withColumnRenamed("doc_id", "__key")), "__key", "left_anti").select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids; ``round_trip`` says that they decode to the text."""
    return pieces.encode(docs, tokenizer("piece_bpe_32k.model"), verify=True)


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_boilerplate),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding and decoding", tokenize),
]

#: SQL can express neither the classifier nor the signatures.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    root = f"{checkpoint_dir(spark)}/martlet-pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{k}")
        docs = spark.read.parquet(f"{root}/{k}")
    return docs
