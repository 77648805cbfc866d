"""Completed per-minute transaction counts from the event stream.

A tumbling one-minute window on the event time with a watermark: in append
mode a minute is emitted once, only after an event later than the minute's
end (plus the allowed lateness) has been seen, and an event older than the
watermark is dropped, so a printed minute is never printed again. Empty
minutes are not emitted. State holds only minutes that are still open.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martlet.functions.dates import minute_label
from martlet.operators import events

TIME = "transaction_date"


def event_time(col: str = TIME) -> F.Column:
    """The event instant. The wire time is UTC wall clock and the session
    zone is pinned to UTC (``martlet.session``), so the cast is exact;
    watermarks need this zoned type."""
    return F.col(col).cast("timestamp")


def minute_counts(parsed: DataFrame, lateness: str = "0 seconds") -> DataFrame:
    """(minute, n) for every completed minute of a parsed event stream.

    Every sale counts, also two with one transaction id; a replayed event
    (equal in all fields) is dropped while its minute is open. The
    de-duplication state expires with the watermark, so it stays bounded."""
    timed = (parsed.where(F.col(TIME).isNotNull() & F.col("transaction_id").isNotNull())
             .withColumn("_event_ts", event_time()))
    counts = (timed.withWatermark("_event_ts", lateness)
              .dropDuplicatesWithinWatermark(parsed.columns)
              .groupBy(F.window("_event_ts", "1 minute").alias("w"))
              .agg(F.count(F.lit(1)).alias("n")))
    return counts.select(minute_label(F.col("w.start")).alias("minute"), "n")


def start_console(parsed: DataFrame, checkpoint: str, lateness: str = "0 seconds",
                  trigger: dict | None = None) -> StreamingQuery:
    """Print ``"<minute> -> <n> transactions"`` for each completed minute."""
    lines = events.minute_lines(minute_counts(parsed, lateness))
    writer = (lines.writeStream.outputMode("append").format("console")
              .option("truncate", "false").option("checkpointLocation", checkpoint))
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def start_to_table(parsed: DataFrame, path: str, checkpoint: str, lateness: str = "0 seconds",
                   trigger: dict | None = None) -> StreamingQuery:
    """Append completed minutes to a Parquet table (file sink: exactly once)."""
    writer = (minute_counts(parsed, lateness).writeStream.outputMode("append").format("parquet")
              .option("path", path).option("checkpointLocation", checkpoint))
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
