"""Event ingest with Structured Streaming.

``read_kafka`` / ``read_json_files`` -> ``parse`` -> ``start_ingest``:
every micro-batch is validated against the static customer and product
tables, rejects go to ``rejects/`` with their reason, and accepted events
are split into ``transactions/`` (one header per transaction) and
``transaction_items/`` (one line per event), in the source-table schemas, so
the daily load reads them like any other source snapshot.

Delivery: the checkpoint gives at-least-once replay of a micro-batch, and
the sink makes it effectively once:

* headers and lines lie in ``BUCKETS`` hash buckets of the transaction id,
  rejects by day; below that everything is partitioned by (``query_id``,
  ``batch_id``). A batch overwrites only its own partitions, so a re-run
  replaces its own files and a query with a new checkpoint (its ids start at
  0 again) replaces nothing of an older one;
* before writing, a batch drops the headers and lines that anything but this
  very batch has stored. Line ids hash the event, so a replayed event inserts
  nothing and another sale of a known transaction id still gets its line. Its
  header stays the first one stored.

Cost: a batch lists and opens only the buckets of its own ids. Files carry a
Parquet Bloom filter of the transaction id, and the ids of the batch reach the
scan as a literal filter, so old files without a match give their footer only.
Batches of a bucket are merged by levels (``streaming.compaction``), so the
folders of a lookup grow with the logarithm of the history only. One ingest writes to an output at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martlet.operators import events
from martlet.session import configure
from martlet.streaming import compaction
from martlet.streaming.compaction import BUCKET, bucket_of, stored_buckets, write_buckets


HEADERS, LINES, REJECTS = "transactions", "transaction_items", "rejects"
CONF_MAX_IDS = ("martlet.ingest.maxInlineIds", 10_000)


def read_kafka(spark: SparkSession, brokers: str, topic: str,
               starting_offsets: str = "earliest", max_offsets_per_trigger: int | None = None) -> DataFrame:
    """The sale-event topic as a stream of JSON text (``value``). Needs the
    Kafka connector on the cluster; offsets live in the query checkpoint,
    so a restart resumes where the last committed batch ended."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", brokers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return reader.load().select(F.col("value").cast("string").alias("value"))


def read_json_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines files as a stream of text (``value``): the same shape as
    the Kafka source, for tests and file drops."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def write_kafka(df: DataFrame, brokers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Publish events as JSON text (producer side)."""
    return (events.to_kafka_records(df).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", brokers).option("topic", topic)
            .option("checkpointLocation", checkpoint).start())


def parse(stream: DataFrame, text: str = "value") -> DataFrame:
    return events.from_payload(stream, text)


def _unstored(df: DataFrame, path: str, keys: list[str], query_id: str, batch_id: int, buckets: list[int], ids: Callable[[], list[int] | None]) -> DataFrame:
    """Rows of ``df`` whose key nothing but this very batch has stored in the
    batch's ``buckets``. ``ids`` gives its transaction ids, or None where they
    are too many for a literal filter; the join decides either way."""
    stored = stored_buckets(df.sparkSession, path, buckets)
    if stored is None:
        return df
    stored = stored.where(~((F.col("query_id") == query_id) & (F.col("batch_id").cast("string") == str(batch_id))))
    known = ids()
    if known is not None:
        stored = stored.where(F.col("transaction_id").isin(known))
    return df.join(stored.select(*keys), keys, "left_anti")


def split_batch(batch: DataFrame, batch_id: int, customers: DataFrame, products: DataFrame,
                out_root: str, query_id: str = "batch") -> None:
    """foreachBatch body: validate, split, drop what is stored, write."""
    root = out_root.rstrip("/")
    spark = batch.sparkSession
    tag = [F.lit(query_id).alias("query_id"), F.lit(batch_id).alias("batch_id")]
    day = F.coalesce(F.to_date("transaction_date"), F.lit("1970-01-01").cast("date")).alias("event_date")
    checked = events.validate(batch, customers, products, per_batch=True).persist()
    try:
        ok = checked.where(F.col("reason").isNull())
        key, default = CONF_MAX_IDS
        bound = int(spark.conf.get(key, str(default)))
        buckets = sorted(r[BUCKET] for r in ok.select(bucket_of("transaction_id").alias(BUCKET)).distinct().collect())  # at most BUCKETS

        @cache
        def known() -> list[int] | None:
            ids = [r["transaction_id"] for r in ok.select("transaction_id").distinct().limit(bound + 1).collect()]
            return ids if len(ids) <= bound else None

        for name in (HEADERS, LINES):
            compaction.recover(spark, f"{root}/{name}")
        heads = _unstored(events.headers(ok), f"{root}/{HEADERS}", ["transaction_id"], query_id, batch_id, buckets, known)
        lines = _unstored(events.lines(ok), f"{root}/{LINES}", ["transaction_id", "transaction_item_id"], query_id, batch_id, buckets, known)
        write_buckets(heads.select("*", *tag), f"{root}/{HEADERS}")
        write_buckets(lines.select("transaction_item_id", "transaction_id", "product_id", "quantity", "price", *tag), f"{root}/{LINES}")
        (checked.where(F.col("reason").isNotNull()).select("*", day, *tag).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("event_date", "query_id", "batch_id").parquet(f"{root}/{REJECTS}"))
        for name in (HEADERS, LINES):
            compaction.compact(spark, f"{root}/{name}", buckets)
    finally:
        checked.unpersist()


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in the checkpoint of a streaming query; it
    outlives restarts and is new for a new checkpoint."""
    return spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def start_ingest(stream: DataFrame, customers: DataFrame, products: DataFrame, out_root: str,
                 checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Run the ingest: ``stream`` is raw JSON text in ``value``."""
    configure(stream.sparkSession)
    events.require_reference_data(customers, products)
    parsed = parse(stream)
    writer = (parsed.writeStream
              .foreachBatch(lambda df, bid: split_batch(df, bid, customers, products, out_root,
                                                        _query_id(df.sparkSession, checkpoint)))
              .option("checkpointLocation", checkpoint))
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
