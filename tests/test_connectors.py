"""What the Kafka and JDBC readers and writers ask Spark for (their jars are
not here, so nothing is sent), and the same rows through a file stream."""

import os
from types import SimpleNamespace

import duckdb

from martlet.operators import events
from martlet.sources import splits
from martlet.streaming import ingest
from martlet.streaming import minute_counts as mc
from test_streaming import drop, ev


class Recorder:
    """A reader or writer that keeps the format and options it is given."""

    def __init__(self, df=None):
        self.kind, self.opts, self.df = None, {}, df

    def format(self, kind):
        self.kind = kind
        return self

    def option(self, k, v):
        self.opts[k] = v
        return self

    def load(self):
        return self.df

    def start(self):
        return self


def test_kafka_source_options(spark):
    reader = Recorder(spark.createDataFrame([(bytearray(b"{}"), "topic")], "value binary, topic string"))
    got = ingest.read_kafka(SimpleNamespace(readStream=reader), "h1:9092,h2:9092", "sales", max_offsets_per_trigger=500)
    assert reader.kind == "kafka"
    assert reader.opts == {"kafka.bootstrap.servers": "h1:9092,h2:9092", "subscribe": "sales", "startingOffsets": "earliest",
                           "maxOffsetsPerTrigger": "500"}
    assert got.dtypes == [("value", "string")] and got.first().value == "{}"
    bare = Recorder(reader.df)
    ingest.read_kafka(SimpleNamespace(readStream=bare), "h:9092", "sales")
    assert "maxOffsetsPerTrigger" not in bare.opts


def test_kafka_sink_options(spark, monkeypatch):
    writer, rows = Recorder(), []
    monkeypatch.setattr(events, "to_kafka_records", lambda df: rows.append(df) or SimpleNamespace(writeStream=writer))
    ingest.write_kafka("events", "h:9092", "sales", "/ck")
    assert (writer.kind, rows) == ("kafka", ["events"])
    assert writer.opts == {"kafka.bootstrap.servers": "h:9092", "topic": "sales", "checkpointLocation": "/ck"}


def test_records_come_back_through_a_stream(spark, scratch):
    inbox, topic = os.path.join(scratch, "in"), os.path.join(scratch, "topic")
    drop(inbox, "a.json", [ev(1, "2024-01-01 00:00:05", price=2.25), ev(2, "2024-01-01 00:00:50", q=3)])
    sent = ingest.parse(ingest.read_json_files(spark, inbox))
    (events.to_kafka_records(sent).writeStream.format("text").option("path", topic)
     .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start().awaitTermination())
    fields = ["transaction_id", "customer_id", "product_id", "quantity", "price", "transaction_date", "total_amount"]
    plain = lambda path: sorted(map(tuple, events.from_payload(spark.read.text(path), "value").select(*fields).collect()))
    assert len(plain(topic)) == 2 and plain(topic) == plain(inbox)


def test_completed_minutes_reach_the_console(spark, scratch):
    inbox = os.path.join(scratch, "in")
    drop(inbox, "a.json", [ev(1, "2024-01-01 00:00:05"), ev(2, "2024-01-01 00:01:50")])
    q = mc.start_console(ingest.parse(ingest.read_json_files(spark, inbox)), os.path.join(scratch, "ck"),
                         trigger={"availableNow": True})
    q.awaitTermination(90)
    assert q.exception() is None
    assert sum(p["sink"]["numOutputRows"] for p in q.recentProgress) == 1


def test_jdbc_reads_by_planned_splits(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE products AS SELECT CASE WHEN i < 50 THEN i ELSE i * 1000 END AS product_id FROM range(100) r(i)")
    asked, login = [], {"user": "u", "password": "p", "fetchsize": "10000"}

    class Reader:
        def format(self, kind):
            assert kind == "jdbc"
            return self

        def options(self, **opts):
            assert {k: opts[k] for k in login} == login and opts["url"] == "jdbc:x"
            self.query = opts["dbtable"]
            return self

        def load(self):
            rows = con.execute(f"SELECT * FROM {self.query}").fetchall()
            return SimpleNamespace(first=lambda: rows[0], collect=lambda: rows)

        def jdbc(self, url, table, predicates, properties):
            asked.append((url, table, predicates, properties))
            return spark.range(3).selectExpr("id product_id")

    got = splits.read_jdbc_splits(SimpleNamespace(read=Reader()), "jdbc:x", "products", 10, "u", "p")
    (url, table, conditions, properties), = asked
    assert (url, table, properties) == ("jdbc:x", "products", login)
    depths = [con.execute(f"SELECT COUNT(*) FROM products WHERE {c}").fetchone()[0] for c in conditions]
    assert sum(depths) == 100 and len(depths) == 10 and max(depths) <= 12
    assert got.columns == ["product_id", "product_name", "category", "price"]
