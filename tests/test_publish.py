"""A crash between any two steps of a snapshot leaves the previous one readable."""

import os

import pytest

from martlet.sources import readers
from test_pipeline import SOURCE_TABLES, small_sources


def names(spark, staging):
    return [r["name"] for r in readers.read_staging(spark, staging)["customers"].collect()]


@pytest.mark.parametrize("table", SOURCE_TABLES)
def test_crash_while_a_table_is_written(spark, scratch, monkeypatch, table):
    readers.snapshot_to_staging(spark, small_sources(spark, "Old"), scratch)
    whole = readers.conform

    def conform(df, schema):
        if schema == readers.SOURCES[table]:
            raise KeyboardInterrupt
        return whole(df, schema)

    monkeypatch.setattr(readers, "conform", conform)
    with pytest.raises(KeyboardInterrupt):
        readers.snapshot_to_staging(spark, small_sources(spark, "New"), scratch)
    assert names(spark, scratch) == ["Old"]
    monkeypatch.undo()
    readers.snapshot_to_staging(spark, small_sources(spark, "New"), scratch)
    assert names(spark, scratch) == ["New"]


def test_crash_before_and_inside_the_log_entry(spark, scratch, monkeypatch):
    readers.snapshot_to_staging(spark, small_sources(spark, "Old"), scratch, run_id="r1")

    def stop(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(readers.Files, "write", stop)
    with pytest.raises(KeyboardInterrupt):
        readers.snapshot_to_staging(spark, small_sources(spark, "New"), scratch, run_id="r2")
    assert names(spark, scratch) == ["Old"]
    monkeypatch.undo()
    log = os.path.join(scratch, "_log")
    for n, text in ((1, ""), (2, '{"run_id": "r2", "fold'), (3, "[]")):  # cut short
        with open(os.path.join(log, f"{n:020d}.json"), "w") as f:
            f.write(text)
    assert readers.current_run(spark, scratch) == "r1"
    readers.snapshot_to_staging(spark, small_sources(spark, "New"), scratch, run_id="r2")
    assert readers.current_run(spark, scratch) == "r2" and names(spark, scratch) == ["New"]


def test_entries_are_never_replaced(spark, scratch):
    first = readers.publish(spark, scratch, "a", {"customers": "x"})
    second = readers.publish(spark, scratch, "b", {"customers": "y"})
    assert (first, second) == (0, 1)
    with pytest.raises(Exception):  # noqa: B017 - the file system's own error
        readers.Files(spark, scratch).write(os.path.join(scratch, "_log", f"{0:020d}.json"), "c")
    assert readers.current_run(spark, scratch) == "b"


def test_nothing_published(spark, scratch):
    with pytest.raises(RuntimeError):
        readers.read_staging(spark, scratch)
