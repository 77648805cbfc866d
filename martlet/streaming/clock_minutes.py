"""Per-minute transaction counts closed by the wall clock.

``streaming.minute_counts`` closes a minute when a later event arrives, so the
last minute of a source that falls silent stays open. Here a minute is closed
once the clock has passed its end, whether or not anything arrives: each open
minute is one key of a stateful operator with a processing-time timer, and
Spark runs batches without data while timers are pending.

Steps of the plan:

1. replays (equal in all fields) that arrive within ``replay_window`` of the
   first copy are dropped, by a watermark on the arrival time; an event is never
   late for this step, whatever its own time, and the state expires;
2. each task counts its Arrow batches by minute, so a busy minute sends a row
   for every 10,000 or so of its events and not one for each;
3. one key for each minute adds those counts and emits the minute once.

A minute closes at ``max(end of the minute, first arrival) + grace`` by the
clock. A sale that arrives later adds nothing and the minute is not printed
again: a closed minute keeps one small row of state for good (half a million
a year). A backlog of old minutes that takes several batches to read needs a
``grace`` that covers the reading; the event-time counter needs none.
Events without a time or a transaction id are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martlet.functions.dates import minute_label
from martlet.operators import events
from martlet.streaming.minute_counts import TIME, event_time

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _partial_counts():
    """Arrow batches of ``start`` -> (start, n) of each batch. Defined here so
    that it is pickled by value and tasks need no copy of the package."""

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                seen = pa.Table.from_batches([batch]).group_by("start").aggregate([("start", "count")])
                yield from seen.select(["start", "start_count"]).rename_columns(["start", "n"]).to_batches()

    return count


def _closer(grace_ms: int):
    """The stateful processor: one key for each minute (its start in ms)."""
    from pyspark.sql import Row
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    class Closer(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.count = handle.getValueState("count", "n long, closed boolean")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
            added = sum(r.n for r in rows)
            held = self.count.get() if self.count.exists() else None
            if held is None:
                now = timerValues.getCurrentProcessingTimeInMs()
                self.handle.registerTimer(max(key[0] + 60_000, now) + grace_ms)
            if held is None or not held[1]:
                self.count.update((added + (held[0] if held else 0), False))
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
            n, closed = self.count.get()
            if not closed:
                self.count.update((n, True))
                yield Row(start=key[0], n=n)

        def close(self) -> None:
            pass

    return Closer()


def minute_counts(parsed: DataFrame, grace_ms: int = 0, replay_window: str = "10 minutes") -> DataFrame:
    """(minute, n) of a parsed event stream, each minute once, when the clock
    has passed it. Needs the RocksDB state store (see :func:`start`)."""
    if grace_ms < 0:
        raise ValueError("grace_ms must not be negative")
    timed = (parsed.where(F.col(TIME).isNotNull() & F.col("transaction_id").isNotNull())
             .withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", replay_window)
             .dropDuplicatesWithinWatermark(parsed.columns))
    starts = timed.select(F.unix_millis(F.date_trunc("minute", event_time())).alias("start"))
    closed = (starts.mapInArrow(_partial_counts(), "start long, n long")
              .groupBy("start").transformWithState(_closer(grace_ms), "start long, n long", "Append", "ProcessingTime"))
    return closed.select(minute_label(F.timestamp_millis("start")).alias("minute"), "n")


def _start(df: DataFrame, fmt: str, checkpoint: str, trigger: dict | None, **options: str) -> StreamingQuery:
    """Start with the RocksDB state store that timers need. A query keeps the
    settings of its start, so the session's own choice is put back."""
    spark = df.sparkSession
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return (df.writeStream.outputMode("append").format(fmt).options(**options)
                .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "1 second"})).start())
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def start_console(parsed: DataFrame, checkpoint: str, grace_ms: int = 0, trigger: dict | None = None) -> StreamingQuery:
    """Print ``"<minute> -> <n> transactions"`` once the clock has passed a minute."""
    return _start(events.minute_lines(minute_counts(parsed, grace_ms)), "console", checkpoint, trigger, truncate="false")


def start_to_table(parsed: DataFrame, path: str, checkpoint: str, grace_ms: int = 0,
                   trigger: dict | None = None) -> StreamingQuery:
    """Append closed minutes to a Parquet table (file sink: exactly once)."""
    return _start(minute_counts(parsed, grace_ms), "parquet", checkpoint, trigger, path=path)
