"""Versioned tables: readers between steps, writers that stop, batches that come again."""

import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F

from kpimill.plans import jobs
from kpimill.sinks.versions import Conflict, VersionedTable, open_table

D = dt.date
SCHEMA = "p string, d date, v int"
START = [("a", D(2021, 1, 1), 1), ("a", D(2021, 1, 2), 2), ("b:/ c", None, 3), (None, D(2021, 1, 1), 4)]
NEW = [("a", D(2021, 1, 1), 10), ("x", D(2021, 1, 1), 11)]
on_day = lambda: F.col("d") == F.lit(D(2021, 1, 1))
LATER = sorted([START[1], START[2], *NEW], key=repr)
STEPS = ["prepared", "written", "listed", "committed"]


def made(spark, path, by):
    table = open_table(spark, path, SCHEMA, by)
    table.replace(F.lit(True), spark.createDataFrame(START, SCHEMA))
    return table


@pytest.mark.parametrize("by", [[], ["p"], ["p", "d"]])
def test_replace(spark, tmp_path, by):
    table = made(spark, str(tmp_path / "t"), by)
    assert rows(table.read()) == sorted(START, key=repr) and table.rows() == 4
    old = table.read()
    assert table.replace(on_day(), spark.createDataFrame(NEW, SCHEMA)) == {"deleted": 2, "inserted": 2}
    assert rows(table.read()) == LATER and rows(old) == sorted(START, key=repr) and rows(table.read(2)) == rows(old)
    assert table.replace(F.lit(True)) == {"deleted": 4, "inserted": 0} and table.read().count() == 0
    with pytest.raises(ValueError, match="1 new rows lie outside"):
        table.replace(on_day(), spark.createDataFrame([START[0], START[1]], SCHEMA))
    assert table.versions() == [1, 2, 3, 4]
    assert table.expire(keep=1, older_than=dt.timedelta(days=1)) == 0  # young folders may belong to a writer
    assert table.expire(keep=1, older_than=dt.timedelta(0)) == 3 and table.versions() == [4] and table.read().count() == 0


@pytest.mark.parametrize("by", [[], ["p"]])
def test_a_reader_between_steps_sees_one_version(spark, tmp_path, by):
    path = str(tmp_path / "t")
    seen = []
    made(spark, path, by)
    look = lambda step: seen.append((step, rows(VersionedTable(spark, path).read())))
    VersionedTable(spark, path, look).replace(on_day(), spark.createDataFrame(NEW, SCHEMA))
    assert seen == [(s, sorted(START, key=repr)) for s in STEPS[:3]] + [("committed", LATER)]


@pytest.mark.parametrize("stop", STEPS)
def test_a_writer_that_stops_leaves_no_half_state(spark, tmp_path, stop):
    path = str(tmp_path / "t")
    made(spark, path, ["p"])

    def watch(step):
        if step == stop:
            raise InterruptedError(step)

    with pytest.raises(InterruptedError):
        VersionedTable(spark, path, watch).replace(on_day(), spark.createDataFrame(NEW, SCHEMA), ("feed", 7))
    table = VersionedTable(spark, path)
    there = stop == "committed"
    assert rows(table.read()) == (LATER if there else sorted(START, key=repr)) and table.seen("feed", 7) == there
    assert table.replace(on_day(), spark.createDataFrame(NEW, SCHEMA), ("feed", 7)) == {"deleted": 0 if there else 2, "inserted": 0 if there else 2}
    assert rows(table.read()) == LATER and table.versions() == [1, 2, 3]
    assert not table.seen("other", 0) and table.seen("feed", 6) and not table.seen("feed", 8)


def test_two_writers(spark, tmp_path):
    path = str(tmp_path / "t")
    made(spark, path, [])

    def other(step):
        if step == "written":
            VersionedTable(spark, path).replace(F.lit(True), spark.createDataFrame(START[:1], SCHEMA))

    with pytest.raises(Conflict):
        VersionedTable(spark, path, other).replace(on_day(), spark.createDataFrame(NEW, SCHEMA))
    with pytest.raises(Conflict):
        VersionedTable(spark, path).create(SCHEMA)
    assert rows(VersionedTable(spark, path).read()) == START[:1]


def test_arrivals(spark, tmp_path):
    source, table = tmp_path / "in", open_table(spark, str(tmp_path / "t"), jobs.CDR_SCHEMA, jobs.CDR_SLICE)
    source.mkdir()
    head = "START_DATE;Carrier1;Destination1;DURATION;Total_Cost\n"
    feed = lambda name, days, minutes="1,5": (source / name).write_text(head + "".join(f"{d:02d}.03.2021;T_ABC N2 X;p;{minutes};2\n" for d in days))
    schema = "START_DATE string, Carrier1 string, Destination1 string, DURATION string, Total_Cost string"
    run = lambda: jobs.arrive_cdr(spark, str(source), table, schema, str(tmp_path / "ck"), D(2021, 4, 1), glob="*.csv")
    feed("one.csv", [1, 2])
    feed("bad.csv", [1, 2, 3], "1 234,5")
    run()
    assert rows(table.read().select("data_source").distinct()) == [("one.csv",)]
    assert sorted((n["data_source"], n["load"], n["refused"]) for n in table.manifest()["notes"]) == [("bad.csv", False, True), ("one.csv", True, False)]
    feed("older.csv", [1, 1, 1])  # more rows, but an older last day
    run()
    assert rows(table.read().select("data_source").distinct()) == [("one.csv",)] and table.last_batch("call-records") == 1
    feed("two.csv", [1, 2, 3])
    run()
    run()
    assert rows(table.read().select("data_source").distinct()) == [("two.csv",)] and table.versions() == [1, 2, 3, 4]


def test_new_rows_are_written_once(spark, tmp_path):
    """Nothing is staged beside the table, files of partitions that lose nothing stay, and a refused change leaves no files."""
    from kpimill.session import scratch_scope

    table = made(spark, str(tmp_path / "t"), ["p"])
    held = {tuple(e["values"]): e["folder"] for e in table.manifest()["files"]}
    with scratch_scope(spark) as scope:
        table.replace(F.col("v") > 9, spark.createDataFrame([("a", None, 12)], SCHEMA))
        assert scope.paths == []
    files = table.manifest()["files"]
    assert {tuple(e["values"]) for e in files} == set(held) and len(files) == 4 and set(held.values()) < {e["folder"] for e in files}
    folders = sorted(f.name for f in (tmp_path / "t" / "data").iterdir())
    with pytest.raises(ValueError, match="1 new rows lie outside"):
        table.replace(on_day(), spark.createDataFrame([START[1]], SCHEMA))
    assert sorted(f.name for f in (tmp_path / "t" / "data").iterdir()) == folders
