"""Minutes closed by the wall clock (``streaming.clock_minutes``)."""

import datetime as dt
import json
import os
import time

import pytest

from martlet.streaming import clock_minutes as cm
from martlet.streaming import ingest


def drop(inbox, name, events):
    os.makedirs(inbox, exist_ok=True)
    hidden = os.path.join(inbox, f".{name}")
    with open(hidden, "w") as f:
        f.writelines(json.dumps({"transaction_id": i, "customer_id": 1, "product_id": 1, "quantity": 1, "price": 2.5,
                                 "transaction_date": t, "total_amount": 2.5}) + "\n" for i, t in events)
    os.rename(hidden, os.path.join(inbox, f"{name}.json"))


def label(when):
    return when.strftime("%Y-%m-%d %H:%M:%S")


def rows(spark, out):
    try:
        return sorted((r.minute, r.n) for r in spark.read.schema("minute string, n long").parquet(out).collect())
    except Exception:  # noqa: BLE001 - nothing written yet
        return []


def wait_for(spark, q, out, n, seconds):
    end = time.time() + seconds
    while time.time() < end and len(rows(spark, out)) < n:
        assert q.exception() is None
        time.sleep(0.5)
    return rows(spark, out)


def test_past_minutes_close_without_a_later_event(spark, scratch):
    """Also the last minute is emitted; replays count once, sales that share
    an id each, events without a time not at all."""
    inbox, out, ck = (os.path.join(scratch, d) for d in ("in", "out", "ck"))
    drop(inbox, "a", [(1, "2024-01-01 00:00:10"), (1, "2024-01-01 00:00:10"), (1, "2024-01-01 00:00:11"),
                      (2, "2024-01-01 00:01:00"), (3, None)])
    parsed = ingest.parse(ingest.read_json_files(spark, inbox))
    q = cm.start_to_table(parsed, out, ck, trigger={"processingTime": "500 milliseconds"})
    try:
        want = [("2024-01-01 00:00:00", 2), ("2024-01-01 00:01:00", 1)]
        assert wait_for(spark, q, out, 2, 60) == want
        drop(inbox, "b", [(9, "2024-01-01 00:00:30"), (4, "2024-01-01 00:02:00")])  # one late, one new
        want.append(("2024-01-01 00:02:00", 1))
        assert wait_for(spark, q, out, 3, 30) == want
    finally:
        q.stop()
    # after a restart a closed minute stays closed
    drop(inbox, "c", [(10, "2024-01-01 00:01:30"), (5, "2024-01-01 00:03:00")])
    q = cm.start_to_table(ingest.parse(ingest.read_json_files(spark, inbox)), out, ck, trigger={"processingTime": "500 milliseconds"})
    try:
        assert wait_for(spark, q, out, 4, 60) == [*want, ("2024-01-01 00:03:00", 1)]
    finally:
        q.stop()


def test_idle_source_closes_the_current_minute_by_the_clock(spark, scratch):
    """Two events of the running minute, in two batches, then silence."""
    inbox, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    now = dt.datetime.now(dt.timezone.utc)
    if now.second > 40:  # leave time for both batches before the minute ends
        time.sleep(61 - now.second)
        now = dt.datetime.now(dt.timezone.utc)
    minute = now.replace(second=0, microsecond=0)
    drop(inbox, "a", [(1, label(minute))])
    q = cm.start_to_table(ingest.parse(ingest.read_json_files(spark, inbox)), out, os.path.join(scratch, "ck"),
                          trigger={"processingTime": "500 milliseconds"})
    try:
        time.sleep(8)
        drop(inbox, "b", [(2, label(minute + dt.timedelta(seconds=1)))])
        early = rows(spark, out)
        assert early == [] or dt.datetime.now(dt.timezone.utc) >= minute + dt.timedelta(minutes=1)
        got = wait_for(spark, q, out, 1, 75)
        assert got == [(label(minute), 2)]
        assert dt.datetime.now(dt.timezone.utc) >= minute + dt.timedelta(minutes=1)
    finally:
        q.stop()


def test_console_runs_and_the_state_setting_is_put_back(spark, scratch, monkeypatch):
    inbox = os.path.join(scratch, "in")
    drop(inbox, "a", [(1, "2024-01-01 00:00:10")])
    before = spark.conf.get(cm.PROVIDER, None)
    q = cm.start_console(ingest.parse(ingest.read_json_files(spark, inbox)), os.path.join(scratch, "ck"),
                         trigger={"availableNow": True})
    q.awaitTermination(60)
    assert q.exception() is None and spark.conf.get(cm.PROVIDER, None) == before


def test_negative_grace_is_refused(spark, scratch):
    inbox = os.path.join(scratch, "in")
    drop(inbox, "a", [])
    with pytest.raises(ValueError):
        cm.minute_counts(ingest.parse(ingest.read_json_files(spark, inbox)), grace_ms=-1)
