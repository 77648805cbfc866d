"""Sale events: wire format, validation, the header / line split and the
per-minute transaction counter. Used by the batch queries and, unchanged, by
the streaming jobs in ``martlet.streaming``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.functions.dates import minute_label
from martlet.operators.joins import lookup_flag, lookup_flag_by_keys
from martlet.operators.ordering import first_per_key
from martlet.schemas import EVENT_FIELDS, EVENT_TIME_FORMAT, SALE_EVENT

CORRUPT = "_corrupt_record"

# Reasons an event is refused, checked in this order.
REASONS = ("malformed", "missing_field", "quantity", "price", "total_amount", "unknown_customer", "unknown_product")


def event_amount(price: Column | str = "price", quantity: Column | str = "quantity") -> Column:
    """round(price x quantity, 2) as decimal(12,2)."""
    p = F.col(price) if isinstance(price, str) else price
    q = F.col(quantity) if isinstance(quantity, str) else quantity
    return F.round(p * q.cast("decimal(10,0)"), 2).cast("decimal(12,2)")


def event_struct(df: DataFrame, ts: str = "transaction_date") -> Column:
    """The event object in wire order; the time as UTC text."""
    fields = []
    for name in EVENT_FIELDS:
        if name == "transaction_date":
            fields.append(F.date_format(F.col(ts), EVENT_TIME_FORMAT).alias(name))
        else:
            fields.append(F.col(name).alias(name))
    return F.struct(*fields)


def to_payload(df: DataFrame) -> DataFrame:
    """(transaction_id, payload): one JSON text per event."""
    return df.select("transaction_id", F.to_json(event_struct(df)).alias("payload"))


def to_kafka_records(df: DataFrame) -> DataFrame:
    """Rows ready for the Kafka sink: ``value`` = JSON text (no key, as the
    producer sends none)."""
    return df.select(F.to_json(event_struct(df)).alias("value"))


def parse_payload(text: Column | str) -> Column:
    """JSON text -> event struct (PERMISSIVE: bad text leaves the fields
    NULL and keeps the text in ``_corrupt_record``)."""
    t = F.col(text) if isinstance(text, str) else text
    schema = T.StructType([*SALE_EVENT.fields, T.StructField(CORRUPT, T.StringType(), True)])
    return F.from_json(t, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def parse_event_time(text: Column) -> Column:
    """Wire time text -> timestamp without zone; NULL when it does not
    match the format (the session zone is pinned to UTC)."""
    return F.try_to_timestamp(text, F.lit(EVENT_TIME_FORMAT)).cast("timestamp_ntz")


def from_payload(df: DataFrame, text: str = "payload") -> DataFrame:
    """Parse JSON events into typed columns; the event time becomes a
    timestamp and a row that is not valid JSON keeps its text in
    ``_corrupt_record``."""
    parsed = df.select(parse_payload(text).alias("_e"))
    cols = [F.col(f"_e.{n}").alias(n) for n in EVENT_FIELDS if n != "transaction_date"]
    cols.insert(EVENT_FIELDS.index("transaction_date"),
                parse_event_time(F.col("_e.transaction_date")).alias("transaction_date"))
    return parsed.select(*cols, F.col(f"_e.{CORRUPT}").alias(CORRUPT))


def validate(events: DataFrame, customers: DataFrame, products: DataFrame,
             per_batch: bool = False) -> DataFrame:
    """Every event with ``reason`` (NULL = accepted): the first failing
    check among malformed, a missing field, quantity > 0, price and total
    not negative, known customer, known product.

    The reference lookups are left joins against the distinct id sets (one
    row per id), so an event is never multiplied; see ``lookup_flag`` for
    the broadcast check and the skew fallback. ``per_batch`` (streaming)
    reads only the reference rows the batch's keys point at
    (``lookup_flag_by_keys``)."""
    has_corrupt = CORRUPT in events.columns
    ev = events if has_corrupt else events.withColumn(CORRUPT, F.lit(None).cast("string"))
    flag = lookup_flag_by_keys if per_batch else lookup_flag
    tagged = flag(ev, customers, "customer_id", "_known_c", row_id="transaction_id")
    tagged = flag(tagged, products, "product_id", "_known_p", row_id="transaction_id")
    malformed = (F.col(CORRUPT).isNotNull() | F.col("transaction_id").isNull()
                 | F.col("transaction_date").isNull())
    missing = F.lit(False)
    for name in EVENT_FIELDS:
        missing = missing | F.col(name).isNull()
    reason = (
        F.when(malformed, "malformed")
        .when(missing, "missing_field")
        .when(~(F.col("quantity") > 0), "quantity")
        .when(F.col("price") < 0, "price")
        .when(F.col("total_amount") < 0, "total_amount")
        .when(F.col("_known_c").isNull(), "unknown_customer")
        .when(F.col("_known_p").isNull(), "unknown_product")
    )
    out = tagged.withColumn("reason", reason).drop("_known_c", "_known_p")
    return out if has_corrupt else out.drop(CORRUPT)


def accepted(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("reason").isNull()).select(*EVENT_FIELDS)


def rejected(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("reason").isNotNull())


HEADER_FIELDS = ["customer_id", "transaction_date", "total_amount"]


def headers(accepted_events: DataFrame) -> DataFrame:
    """One header per transaction id (a replay inserts nothing)."""
    return first_per_key(accepted_events.select("transaction_id", *HEADER_FIELDS), ["transaction_id"])


def event_line_id() -> Column:
    """The line id of an event: a positive 64-bit hash of all its fields, so
    a replay maps to the same line and another sale to another one."""
    content = F.sha2(F.to_json(F.struct(*EVENT_FIELDS), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}), 256)
    return F.conv(F.substring(content, 1, 15), 16, 10).cast("long")


def lines(accepted_events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One line per distinct event: sales that share a transaction id each
    keep their line, an event equal in all fields is a replay."""
    cols = ["transaction_id", "product_id", "quantity", "price"]
    distinct = accepted_events.select(*EVENT_FIELDS).distinct()
    return distinct.select(event_line_id().alias("transaction_item_id"), *cols, *keep)


def minute_counts(events: DataFrame, ts: str = "transaction_date") -> DataFrame:
    """(minute, n): events per UTC minute; empty minutes are absent."""
    return (events.groupBy(minute_label(ts).alias("minute"))
            .agg(F.count(F.lit(1)).alias("n")))


def completed_minutes(counts: DataFrame) -> DataFrame:
    """Minutes before the latest one seen (the latest may still grow). The
    latest minute is a scalar subquery (one global aggregate), no join."""
    latest = counts.select(F.max("minute")).scalar()
    return counts.where(F.col("minute") < latest)


def minute_lines(counts: DataFrame) -> DataFrame:
    """The console text of a completed minute."""
    return counts.select(F.format_string("%s -> %d transactions", "minute", "n").alias("line"))


def id_high_water(headers_df: DataFrame, lines_df: DataFrame) -> DataFrame:
    """(last_id, next_id): the largest transaction id in headers or lines
    (0 when both are empty) and the id the next event takes."""
    ids = (headers_df.select(F.col("transaction_id").cast("long").alias("i"))
           .unionByName(lines_df.select(F.col("transaction_id").cast("long").alias("i"))))
    last = F.coalesce(F.max("i"), F.lit(0).cast("long"))
    return ids.agg(last.alias("last_id"), (last + 1).alias("next_id"))


def reference_ranges(customers: DataFrame, products: DataFrame) -> DataFrame:
    """(kind, n, min_id, max_id) of the ids an event may reference."""
    def one(df: DataFrame, col: str, kind: str) -> DataFrame:
        return df.agg(F.count(col).alias("n"), F.min(col).alias("min_id"), F.max(col).alias("max_id")) \
            .select(F.lit(kind).alias("kind"), "n", "min_id", "max_id")
    return one(customers, "customer_id", "customer").unionByName(one(products, "product_id", "product"))


def require_reference_data(customers: DataFrame, products: DataFrame) -> None:
    """Refuse to start a stream against empty reference tables."""
    if customers.isEmpty() or products.isEmpty():
        raise RuntimeError("customers/products table is empty")
