"""Streaming jobs: completed minute counts with zero lateness, and the
idempotent header/line split (replays, malformed events, restarts)."""

import json
import os
from collections import Counter

from martlet.streaming import ingest
from martlet.streaming import minute_counts as mc


def ev(i, t, cust=1, prod=1, q=1, price=2.5):
    return json.dumps({"transaction_id": i, "customer_id": cust, "product_id": prod, "quantity": q,
                       "price": price, "transaction_date": t, "total_amount": round(price * q, 2)})


def drop(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def counts(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).collect())


def test_minute_counts_emit_completed_minutes_once(spark, scratch):
    inbox = os.path.join(scratch, "in")
    drop(inbox, "a.json", [ev(1, "2024-01-01 00:00:05"), ev(2, "2024-01-01 00:00:50"), "{malformed",
                           ev(3, "2024-01-01 00:01:10"), ev(3, "2024-01-01 00:01:10")])  # replay of 3
    parsed = ingest.parse(ingest.read_json_files(spark, inbox))
    out, ck = os.path.join(scratch, "mc"), os.path.join(scratch, "ck")
    mc.start_to_table(parsed, out, ck, trigger={"availableNow": True}).awaitTermination()
    assert counts(spark, out) == [("2024-01-01 00:00:00", 2)]
    drop(inbox, "b.json", [ev(4, "2024-01-01 00:00:55"), ev(5, "2024-01-01 00:03:00")])
    mc.start_to_table(parsed, out, ck, trigger={"availableNow": True}).awaitTermination()
    assert counts(spark, out) == [("2024-01-01 00:00:00", 2), ("2024-01-01 00:01:00", 1)]


def test_console_line_format(spark):
    from martlet.operators.events import minute_lines
    df = spark.createDataFrame([("2026-08-07 02:18:00", 58)], "minute string, n long")
    assert minute_lines(df).first()["line"] == "2026-08-07 02:18:00 -> 58 transactions"


def test_ingest_split_dedupes_replays_and_quarantines(spark, scratch):
    inbox = os.path.join(scratch, "in")
    drop(inbox, "a.json", [ev(1, "2024-01-01 00:00:05"), ev(2, "2024-01-01 00:00:50", q=0),
                           "{malformed", ev(3, "2024-01-01 00:01:10", cust=99),
                           ev(4, "2024-01-01 00:01:20", prod=99), ev(1, "2024-01-01 00:00:05")])
    drop(inbox, "b.json", [ev(5, "2024-01-02 00:00:01"),
                           ev(1, "2024-01-01 00:00:05"),             # id 1 replayed in a later batch
                           ev(1, "2024-01-05 00:00:09"),             # another sale with id 1
                           ev(4, "2024-01-03 00:00:09", prod=1)])    # rejected id 4, now valid
    cust = spark.createDataFrame([(1,)], "customer_id int")
    prod = spark.createDataFrame([(1,)], "product_id int")
    out, ck = os.path.join(scratch, "out"), os.path.join(scratch, "ck")
    stream = ingest.read_json_files(spark, inbox, max_files_per_trigger=1)
    ingest.start_ingest(stream, cust, prod, out, ck, trigger={"availableNow": True}).awaitTermination()
    heads = spark.read.parquet(os.path.join(out, "transactions"))
    lines = spark.read.parquet(os.path.join(out, "transaction_items"))
    rejects = spark.read.parquet(os.path.join(out, "rejects"))
    assert sorted(r.transaction_id for r in heads.collect()) == [1, 4, 5]
    # the replay of 1 is not stored again, the other sale with that id has its line
    assert sorted(r.transaction_id for r in lines.collect()) == [1, 1, 4, 5]
    assert lines.select("transaction_item_id").distinct().count() == 4
    assert heads.where("transaction_id = 1").count() == 1
    assert sorted(r.reason for r in rejects.collect()) == ["malformed", "quantity", "unknown_customer",
                                                           "unknown_product"]
    # restart: nothing new arrives, nothing is written twice
    ingest.start_ingest(stream, cust, prod, out, ck, trigger={"availableNow": True}).awaitTermination()
    assert spark.read.parquet(os.path.join(out, "transactions")).count() == 3


def split(spark, out, texts, batch_id, query_id):
    cust = spark.createDataFrame([(1,)], "customer_id int")
    prod = spark.createDataFrame([(1,), (2,)], "product_id int")
    batch = ingest.parse(spark.createDataFrame([(t,) for t in texts], "value string"))
    ingest.split_batch(batch, batch_id, cust, prod, out, query_id)


def stored_ids(spark, out, table):
    return sorted(r.transaction_id for r in spark.read.parquet(os.path.join(out, table)).collect())


def test_batches_of_other_queries_are_kept_and_searched(spark, scratch):
    out = os.path.join(scratch, "out")
    split(spark, out, [ev(1, "2024-01-01 00:00:05")], 5, "q1")
    split(spark, out, [ev(1, "2024-01-01 00:00:05"), ev(2, "2024-01-01 00:00:06")], 0, "q2")  # a new checkpoint
    assert stored_ids(spark, out, "transactions") == [1, 2]
    split(spark, out, [ev(1, "2024-01-01 00:00:05"), ev(2, "2024-01-01 00:00:06")], 0, "q2")  # the batch runs again
    assert stored_ids(spark, out, "transactions") == stored_ids(spark, out, "transaction_items") == [1, 2]


def test_sales_of_one_id_keep_their_lines_and_bad_money_is_refused(spark, scratch):
    out = os.path.join(scratch, "out")
    t = "2024-01-01 00:00:05"
    no_total = json.dumps({"transaction_id": 9, "customer_id": 1, "product_id": 1, "quantity": 1, "price": 1.0,
                           "transaction_date": t})
    split(spark, out, [ev(1, t, prod=1), ev(1, t, prod=2), ev(1, t, prod=2), ev(7, t, price=-9.5), no_total], 0, "q")
    assert stored_ids(spark, out, "transactions") == [1]
    assert stored_ids(spark, out, "transaction_items") == [1, 1]
    rejects = spark.read.parquet(os.path.join(out, "rejects"))
    assert sorted((r.transaction_id, r.reason) for r in rejects.collect()) == [(7, "price"), (9, "missing_field")]


def test_stream_minute_counts_equal_batch_query(spark, scratch):
    """Streaming the whole topic (replays included) gives the completed
    minutes of the batch query."""
    import __spark_entry__ as entry
    from conftest import SF_SMALL
    from martlet.operators import events
    from martlet.sources.fixtures import sources

    src = sources(spark, SF_SMALL)
    inbox = os.path.join(scratch, "topic")
    events.to_payload(src.sale_events).select("payload").write.text(inbox)
    parsed = ingest.parse(ingest.read_json_files(spark, inbox))
    out = os.path.join(scratch, "mc")
    mc.start_to_table(parsed, out, os.path.join(scratch, "ck"), trigger={"availableNow": True}).awaitTermination()
    batch = entry.queries()["minute_counts_completed"](spark, SF_SMALL)
    assert counts(spark, out) == sorted(tuple(r) for r in batch.collect())


def test_sink_lists_and_keeps_few_files_however_many_batches(spark, scratch, monkeypatch):
    """Every bucket holds a bounded number of batch folders, nothing is lost
    or doubled, and a lookup reads only its own buckets."""
    from martlet.streaming import compaction

    monkeypatch.setattr(compaction, "BUCKETS", 4)
    monkeypatch.setattr(compaction, "MAX_BATCHES", 3)
    out = os.path.join(scratch, "out")
    most = []
    for n in range(14):
        texts = [ev(100 * n + k, f"2024-01-01 00:{n:02d}:{k:02d}") for k in range(5)]
        split(spark, out, texts + [ev(0, "2024-01-01 00:00:00")], n, "q")  # sale 0 is replayed in every batch
        files = compaction.Files(spark, out)
        most.append([Counter(map(compaction.level_of, compaction.batches(files, f"{out}/transactions/bucket={b}"))) for b in range(4)])
    assert all(n <= 3 for buckets in most for level in buckets for n in level.values())
    assert max(level for bucket in most[-1] for level in bucket) <= 2 < 14
    want = sorted(100 * n + k for n in range(14) for k in range(5))
    assert stored_ids(spark, out, "transactions") == want == stored_ids(spark, out, "transaction_items")
    split(spark, out, texts, 13, "q")  # a batch whose rows were merged runs again
    assert stored_ids(spark, out, "transactions") == want == stored_ids(spark, out, "transaction_items")
    one = compaction.stored_buckets(spark, f"{out}/transactions", [2])
    assert all("bucket=2" in f for f in one.inputFiles()) and compaction.stored_buckets(spark, f"{out}/transactions", [9]) is None


def test_interrupted_merges_lose_and_double_nothing(spark, scratch, monkeypatch):
    from martlet.streaming import compaction

    path = os.path.join(scratch, "t")
    for n in range(3):
        rows = spark.createDataFrame([(n * 10 + k,) for k in range(6)], "transaction_id int").selectExpr("*", "'q' AS query_id", f"{n} AS batch_id")
        compaction.write_buckets(rows, path)
    want = sorted(n * 10 + k for n in range(3) for k in range(6))
    ids = lambda: sorted(r.transaction_id for r in spark.read.parquet(path).collect())
    monkeypatch.setattr(compaction, "MAX_BATCHES", 1)
    steps = ("write", "delete", "rename")
    for step in steps:  # the first call of each step fails, before or after which files differ

        class Failing(compaction.Files):
            pass

        def fail(*_):
            raise KeyboardInterrupt

        setattr(Failing, step, fail)
        monkeypatch.setattr(compaction, "Files", Failing)
        try:
            compaction.compact(spark, path, range(64))
        except KeyboardInterrupt:
            pass
        monkeypatch.undo()
        monkeypatch.setattr(compaction, "MAX_BATCHES", 1)
        compaction.recover(spark, path)
        assert ids() == want, step
    compaction.compact(spark, path, range(64))
    files = compaction.Files(spark, path)
    assert ids() == want and max(len(compaction.batches(files, f"{path}/bucket={b}")) for b in range(64)) == 1
    assert not [n for b in range(64) for n in files.names(f"{path}/bucket={b}") if n.startswith("_merge")]
