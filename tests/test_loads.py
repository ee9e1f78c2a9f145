import datetime as dt
import os

import pytest
from helpers import rows
from pyspark.sql import functions as F

from kpimill.functions import fixed_values as fv
from kpimill.operators import market
from kpimill.plans import jobs
from kpimill.sinks import tables
from kpimill.sources import files
from kpimill.streaming import streams

D = dt.date
SCHEMA = "p string, d date, v int"
START = [("a", D(2021, 1, 1), 1), ("a", D(2021, 1, 2), 2), ("b", D(2021, 1, 1), 3), ("b", None, 4), (None, D(2021, 1, 1), 5)]


def _table(spark, path, by=None):
    tables.full_reload(spark.createDataFrame(START, SCHEMA), path, by)
    return lambda: rows(spark.read.schema(SCHEMA).parquet(path), "p", "d", "v")


@pytest.mark.parametrize("by", [None, ["p"]])
@pytest.mark.parametrize("known", [False, True])
def test_replace_slice(spark, tmp_path, by, known):
    path = str(tmp_path / "t")
    read = _table(spark, path, by)
    new = spark.createDataFrame([("a", D(2021, 1, 1), 10), ("c", D(2021, 1, 1), 11)], SCHEMA)
    cond = F.col("d") == F.lit(D(2021, 1, 1))
    want = sorted([("a", D(2021, 1, 1), 10), ("a", D(2021, 1, 2), 2), ("b", None, 4), ("c", D(2021, 1, 1), 11)], key=repr)
    for _ in range(2):  # a repeated run changes nothing
        tables.replace_slice(spark, path, cond, new, by, gaining={("a",), ("c",)} if by and known else None)
        assert read() == want
    if by:
        assert not os.path.exists(f"{path}/p=__HIVE_DEFAULT_PARTITION__")
    tables.clear_slice(spark, path, F.col("p") == "a", by)
    assert read() == [r for r in want if r[0] != "a"]
    if by:
        assert not os.path.exists(f"{path}/p=a")


def test_partition_named_but_not_filled_is_removed(spark, tmp_path):
    path = str(tmp_path / "t")
    read = _table(spark, path, ["p"])
    new = spark.createDataFrame([("b", D(2021, 1, 1), 10)], SCHEMA)
    tables.replace_slice(spark, path, F.col("p").isin("a", "b"), new, ["p"], gaining={("a",), ("b",)})
    assert read() == sorted([("b", D(2021, 1, 1), 10), (None, D(2021, 1, 1), 5)], key=repr)


def test_rows_outside_the_slice_are_refused(spark, tmp_path):
    for by in (None, ["p"]):
        path = str(tmp_path / ("parts" if by else "flat"))
        read = _table(spark, path, by)
        cond = (F.col("p") == "a") & (F.col("v") == 1)
        for bad in [("a", D(2021, 1, 1), 2), ("b", D(2021, 1, 1), 1), (None, D(2021, 1, 1), 1), ("a", D(2021, 1, 1), None)]:
            new = spark.createDataFrame([("a", D(2021, 1, 1), 1), bad], SCHEMA)
            with pytest.raises(ValueError, match="outside"):
                tables.replace_slice(spark, path, cond, new, by, gaining={("a",)} if by else None)
            assert read() == sorted(START, key=repr)


def test_partitions_that_were_not_named_are_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    read = _table(spark, path, ["p"])
    new = spark.createDataFrame([("a", D(2021, 1, 1), 1), ("z", D(2021, 1, 1), 1)], SCHEMA)
    with pytest.raises(ValueError, match="not named"):
        tables.replace_slice(spark, path, F.col("d") == F.lit(D(2021, 1, 1)), new, ["p"], gaining={("a",)})
    assert read() == sorted(START, key=repr)


def test_a_source_that_grows_loses_nothing(spark, tmp_path):
    """The source gets a row in another partition while the refresh runs: what was staged is what counts."""
    path, src = str(tmp_path / "t"), str(tmp_path / "src")
    read = _table(spark, path, ["p"])
    spark.createDataFrame([("a", D(2021, 1, 2), 20)], SCHEMA).write.parquet(src)
    seen = []
    real = tables.staged

    def slow(df, name):
        out = real(df, name)
        if not seen:
            seen.append(1)
            spark.createDataFrame([("b", D(2021, 1, 2), 30)], SCHEMA).write.mode("append").parquet(src)
        return out

    tables.staged = slow
    try:
        tables.incremental_refresh(spark, path, spark.read.schema(SCHEMA).parquet(src), "d", D(2021, 1, 2), ["p"])
    finally:
        tables.staged = real
    assert [r for r in START if r[1] != D(2021, 1, 2)] == [r for r in START if r in read()]
    assert ("a", D(2021, 1, 2), 20) in read()


def test_live_base_of_another_version_is_refused(spark, tmp_path):
    path = str(tmp_path / "live")
    row = lambda v, kpi, d: (d, v, kpi, None, None, 1, None, None, None, None, None, 1.0)
    stored = [row("Plan", fv.LIVE_BASE_KPI, D(2021, 1, 1)), row("Plan", "Other", D(2021, 1, 1)), row("Plan", fv.LIVE_BASE_KPI, D(2020, 1, 1))]
    tables.full_reload(spark.createDataFrame(stored, fv.PARAMETERS_SCHEMA), path, ["param_1"])
    with pytest.raises(ValueError):
        jobs.load_live_base(spark, path, spark.createDataFrame(stored[:1], fv.PARAMETERS_SCHEMA), version="Budget")
    assert spark.read.parquet(path).count() == 3


def test_keys_with_blanks_keep_other_months(spark, tmp_path):
    path, backup = str(tmp_path / "p"), str(tmp_path / "b")
    old = [(D(2021, m, 1), "AC", "x", None, None, 1, None, None, None, None, None, float(m)) for m in (1, 2, 3)]
    tables.full_reload(spark.createDataFrame(old, fv.PARAMETERS_SCHEMA), path, ["param_1"])
    raw = spark.createDataFrame([("AC ", "3", "2021", "c", "x", 30.0)], "version string, month string, year string, region string, account string, param_value double")
    codes = spark.createDataFrame([(1, "c", "n")], "branch_id int, code string, code_name string")
    jobs.load_plan(spark, path, backup, raw, codes, tables.SliceSpec("report_date", keys={"param_1": ["AC "], "param_2": None}))
    got = rows(spark.read.schema(fv.PARAMETERS_SCHEMA).parquet(path), "report_date", "param_value")
    assert got == [(D(2021, 1, 1), 1.0), (D(2021, 2, 1), 2.0), (D(2021, 3, 1), 30.0)]


def test_slices_of_too_many_keys_are_refused(spark, monkeypatch):
    monkeypatch.setattr(tables, "MAX_KEYS", 3)
    df = spark.createDataFrame([(D(2021, 1, 1), f"k{i}") for i in range(4)], "d date, k string")
    with pytest.raises(ValueError, match="more than 3"):
        tables.SliceSpec("d", keys={"k": None}).resolve(df)


def test_every_file_is_gated(spark):
    from kpimill.operators import control

    make = lambda f, n, last: [("s", D(2021, 3, 1), D(2021, 3, 1 + i * (last - 1) // (n - 1)), f) for i in range(n)]
    cols = "k string, m date, d date, f string"
    stored = spark.createDataFrame(make("old", 60, 9), cols)
    new = spark.createDataFrame(make("A", 100, 10) + make("B", 50, 12), cols)
    got = control.freshness_gate(new, stored, ["k", "m"], "d", "m", "f").collect()
    assert [(r.f, r.max_date, r.row_count, r.load) for r in got] == [("A", D(2021, 3, 10), 100, True)]
    none = control.freshness_gate(spark.createDataFrame(make("B", 50, 12), cols), stored, ["k", "m"], "d", "m", "f").collect()
    assert [(r.f, r.load) for r in none] == [("B", False)]


CDR_HEAD = "data_source string, START_DATE string, Carrier1 string, Destination1 string, DURATION string, Total_Cost string, DIRECTION string"


def test_records_are_looked_up_by_their_direction(spark):
    feed = spark.createDataFrame([("f", "01.03.2021", "T_ABC N2 X", "Germany", "1", "2", d) for d in ("Incoming", "Outgoing", "Transit")], CDR_HEAD)
    incoming = spark.createDataFrame([("Germany", "DE-in", "EU")], "destination string, country string, area string")
    mapping = spark.createDataFrame([("Germany", "81049", "DE-out", "")], "destination string, codes string, country string, area string")
    codes = spark.createDataFrame([("49, 490", "REWRITTEN")], "dial_codes string, new_destination string")
    out = jobs.normalize_cdr(feed, D(2021, 4, 1), incoming, mapping, codes)
    assert rows(out, "direction", "destination", "country", "area") == [
        ("Incoming", "Germany", "DE-in", "EU"), ("Outgoing", "REWRITTEN", "DE-out", "Unknown"), ("Transit", "Germany", None, None)]


def test_files_of_several_months_or_with_bad_cells_are_refused(spark, tmp_path):
    path = str(tmp_path / "cdr")
    line = lambda f, day, minutes="1,5": (f, day, "T_ABC N2 X", "p", minutes, "2", "Outgoing")
    feed = spark.createDataFrame(
        [line("good", "01.03.2021"), line("good", "02.03.2021", " "), line("long", "31.01.2021"), line("long", "01.02.2021"), line("bad", "03.03.2021", "1 234,5"),
         line("bad", "04.03.2021"), line("undated", "05.03.2021"), line("undated", "x")], CDR_HEAD)
    records = jobs.read_cdr(feed)
    report = jobs.cdr_file_report(records)
    assert rows(report, "data_source", "months", "unreadable", "ok") == [("bad", 1, 1, False), ("good", 1, 0, True), ("long", 2, 0, False), ("undated", 0, 2, False)]
    decision = jobs.load_cdr(spark, path, jobs.cdr_layout(records, D(2021, 4, 1)), report)
    assert rows(decision, "data_source", "load", "refused") == [("bad", False, True), ("good", True, False), ("long", False, True), ("undated", False, True)]
    assert rows(spark.read.parquet(path).select("data_source").distinct()) == [("good",)]
    later = jobs.load_cdr(spark, path, jobs.normalize_cdr(feed, D(2021, 4, 1)))  # their own report is made
    assert rows(later.where("refused"), "data_source") == [("bad",), ("long",), ("undated",)]
    with pytest.raises(ValueError, match="need a report"):
        jobs.load_cdr(spark, path, jobs.normalize_cdr(feed, D(2021, 4, 1)).drop("unreadable"))
    assert "unreadable" not in spark.read.parquet(path).columns


def test_plan_sheets_lose_no_row(spark, tmp_path):
    def book(name, *values):
        lines = "".join(f"AC,{i},{v}\n" for i, v in enumerate(values))
        folder = tmp_path / name / "sheet=data"
        folder.mkdir(parents=True)
        (folder / "a.csv").write_text("version,region,param_value\n" + lines)
        return files.read_typed_sheets(spark, str(tmp_path / name), {"data": ("version", "region", "param_value"), "gone": ("x",)}, {"param_value"})

    assert rows(book("good", "1.5", "", " 2 ", "-3e2"), "region", "param_value") == [("0", 1.5), ("2", 2.0), ("3", -300.0)]
    for bad in ("1 234,5", "#DIV/0!", "x"):
        with pytest.raises(Exception, match="no number in column param_value of sheet data: " + bad[:3]):
            book(f"bad {ord(bad[0])}", "1", f'"{bad}"').collect()


def test_partitions_of_several_columns(spark, tmp_path):
    path, by = str(tmp_path / "t"), ["p", "d"]
    rows_in = [("x:1/2", D(2021, 1, 1), 1), ("x:1/2", D(2021, 1, 2), 2), ("y", D(2021, 1, 1), 3), ("y", None, 4)]
    tables.full_reload(spark.createDataFrame(rows_in, SCHEMA), path, by)
    tables.clear_slice(spark, path, (F.col("p") == "x:1/2") & (F.col("d") == F.lit(D(2021, 1, 1))), by)
    got = rows(spark.read.schema(SCHEMA).parquet(path), "p", "d", "v")
    assert got == sorted(rows_in[1:], key=repr)


def test_backup_and_refresh(spark, tmp_path):
    path = str(tmp_path / "t")
    read = _table(spark, path)
    source = spark.createDataFrame([("n", D(2021, 1, 2), 20), ("n", D(2020, 1, 1), 21)], SCHEMA)
    tables.incremental_refresh(spark, path, source, "d", D(2021, 1, 2))
    assert ("n", D(2021, 1, 2), 20) in read() and len(read()) == 5
    assert rows(spark.read.schema(SCHEMA).parquet(f"{path}__backup"), "p", "d", "v") == sorted(START, key=repr)


def test_append_is_positional(spark, tmp_path):
    path = str(tmp_path / "t")
    read = _table(spark, path)
    tables.append(spark.createDataFrame([(D(2021, 5, 1), 9, "z")], "a date, b int, c string").select("c", "a", "b"), path, ["p", "d", "v"])
    assert ("z", D(2021, 5, 1), 9) in read()
    with pytest.raises(ValueError):
        tables.append(spark.createDataFrame([(1,)], "a int"), path, ["p", "d", "v"])


def test_slice_spec(spark):
    df = spark.createDataFrame([(D(2021, 1, 1), " BU ", "x"), (D(2021, 3, 1), "AC", "y"), (D(2021, 2, 1), "BU", "y")],
                               "d date, v string, a string")
    spec = tables.SliceSpec("d", D(2021, 2, 1), None, {"v": ["BU"], "a": None}).resolve(df)
    assert (spec.max_date, spec.keys) == (D(2021, 3, 31), {"v": ["BU"], "a": ["x", "y"]})
    assert df.where(spec.column()).count() == 1
    target = df.toDF("report_date", "param_1", "param_2")
    assert target.where(spec.column({"d": "report_date", "v": "param_1", "a": "param_2"})).count() == 1
    assert tables.SliceSpec("d", keys={"v": None}).resolve(df).min_date == D(2021, 1, 1)


def test_tracking_profiles(spark):
    head = "`Показатель` string, `Оператор` string, `Категория` string, `Категория_Выбор` string, `Разбивка1` string, `Вариант1` string"
    data = [("AA", "o", "Region new", "Volga", "Subs / nonsubs", "Есть", "1,5", "2"), ("AA", "o", "Region new", "Total X", "Subs / nonsubs", "Нет", "1", "2"),
            ("zz", "o", "Region new", "Volga", "Subs / nonsubs", "Нет", "1", "2"), ("AA", "o", "Region new", "Volga", "Area", "Нет", "3", "4")]
    sheet = spark.createDataFrame(data, head + ", `Q1'20` string, `Base Q1` string")
    general = jobs.normalize_tracking(sheet, "general")
    assert general.columns == list(fv.TRACKING_COLUMNS)
    assert rows(general, "area", "cat_1", "cat_3", "period_start", "source_table") == [("Волга", None, "Свой", D(2020, 1, 1), "general")]
    social = jobs.normalize_tracking(sheet, "social")
    assert rows(social, "cat_1", "cat_2", "cat_3", "param_value") == [("Area", "Нет", None, 3.0)]
    express = spark.createDataFrame([("NPS", "Region", "Siberia", "o", "7", "1")], "kpi string, `География` string, `Выбор` string, `Оператор` string, `4Q'20` string, `Изменение Q` string")
    assert rows(jobs.normalize_tracking(express, "express"), "kpi", "area", "cat_1", "period_end", "param_value") == [
        ("NPS", "Сибирь", None, D(2020, 12, 31), 7.0)]


def test_sales_mix_sentinel(spark):
    sheet = spark.createDataFrame([("r", "Total", "0x7", "1.005"), ("r", "Shop", "2", "3")], "`Регион` string, Channels string, `A план` string, `B план` string")
    assert rows(jobs.sales_mix_long(sheet, "old")) == [("r", "Total", "B", 1.01)]
    assert rows(jobs.sales_mix_long(sheet, "old", totals=False)) == [("r", "Shop", "A", 2.0), ("r", "Shop", "B", 3.0)]


def test_sales_mix_headers_that_meet(spark):
    sheet = spark.createDataFrame([("r", "Total", "1", "2")], "`Регион` string, Channels string, `Мой онлайн план` string, `Мой онлайн/Online план` string")
    assert rows(jobs.sales_mix_long(sheet, "old")) == [("r", "Total", "Мой онлайн", 1.0), ("r", "Total", "Мой онлайн", 2.0)]
    own = {**fv.SALES_MIX_HEADERS, "Мой онлайн": "x"}
    assert rows(jobs.sales_mix_long(sheet, "old", headers=own), "tariff") == [("x",), ("x",)]


def test_sales_mix_cells_that_are_no_numbers(spark):
    sheet = spark.createDataFrame([("r", "Total", "1 234,5")], "`Регион` string, Channels string, `A план` string")
    with pytest.raises(Exception, match="1 234,5"):
        jobs.sales_mix_long(sheet, "old").collect()


def test_tracking_layout_is_told_by_names():
    assert jobs.tracking_profile("/in/2021 Osnovnye.v2.xlsx", ["x", "Динамика KPIs"]) == "general"
    assert jobs.tracking_profile("Соц дем абоненты.xlsx", ["data"]) == "social_subs"
    with pytest.raises(ValueError):
        jobs.tracking_profile("2021 Osnovnye.xlsx", ["data"])


def test_tracking_keeps_empty_cells(spark):
    sheet = spark.createDataFrame([("NPS", "Region", "Siberia", "o", None, "1")], "kpi string, `География` string, `Выбор` string, `Оператор` string, `4Q'20` string, `Q1'21` string")
    assert rows(jobs.normalize_tracking(sheet, "express"), "period_start", "period_end", "param_value") == [
        (D(2020, 10, 1), D(2020, 12, 31), None), (D(2021, 1, 1), D(2021, 3, 31), 1.0)]


def test_forecast_retention(spark, tmp_path):
    path = str(tmp_path / "p")
    names = ["AC", "F1_2020_01", "F2_2021_01", "F1_2021_01"]
    empty = [None] * 4
    df = spark.createDataFrame([(D(2021, 1, 1), n, *empty[:3], 1, *empty[:1], None, None, None, None, 1.0) for n in names], fv.PARAMETERS_SCHEMA)
    tables.full_reload(df, path, ["param_1"])
    jobs.keep_latest_forecast(spark, path)
    assert rows(spark.read.schema(fv.PARAMETERS_SCHEMA).parquet(path), "param_1") == [("AC",), ("F2_2021_01",)]


def test_call_record_load(spark, tmp_path):
    path = str(tmp_path / "cdr")
    feed = lambda f, days, kind="T_ABC N2 X": spark.createDataFrame(
        [(f, f"{d:02d}.03.2021", kind, "p", "1,5", "2") for d in days], "data_source string, START_DATE string, Carrier1 string, OPERATOR_NAME string, DURATION string, Total_Cost string")
    load = lambda df: jobs.load_cdr(spark, path, jobs.normalize_cdr(df, D(2021, 4, 1)))
    stored = lambda: spark.read.schema(jobs.CDR_SCHEMA).parquet(path)
    load(feed("one", range(1, 4)).unionByName(feed("one", [1], "T_INT N2 X")).unionByName(feed("one", [1], "Z_ABC N2 X")))
    assert rows(stored().select("data_source", "direction").distinct()) == [("one", "Incoming")] and stored().count() == 3
    load(feed("older", [1, 1, 2, 2]))  # more rows, but an older last day
    load(feed("fewer", [5]))  # newer, but fewer rows
    assert rows(stored().select("data_source").distinct()) == [("one",)]
    decision = load(feed("two", range(1, 6)))
    assert [r.load for r in decision.collect()] == [True]
    assert rows(stored().select("data_source", "branch", "carrier_type").distinct()) == [("two", "N2 X", "T")] and stored().count() == 5


TICK = "ts timestamp, k string, p double, id bigint"


def _ticks(spark, path, minutes):
    at = lambda m: dt.datetime(2024, 1, 1, 10, 0, 1) + dt.timedelta(minutes=m)
    data = [(at(m), "x", float(i), i) for i, m in enumerate(minutes)]
    spark.createDataFrame(data, TICK).coalesce(1).write.mode("append").parquet(str(path))


def test_late_ticks_are_dropped(spark, tmp_path):
    src, out, ck = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    run = lambda: streams.run_to_table(
        streams.stream_ohlcv(streams.table_stream(spark, str(src), TICK), "ts", "k", "p", "id"), out, ck)
    _ticks(spark, src, [0, 0, 1, 30])
    run()
    _ticks(spark, src, [1, 31, 60])  # minute 1 is behind the watermark by now
    run()
    got = rows(spark.read.parquet(out), "bar_start", "open", "close", "volume")
    assert [(r[0].minute, r[1], r[2], r[3]) for r in got] == [(0, 0.0, 1.0, 2), (1, 2.0, 2.0, 1), (30, 3.0, 3.0, 1), (31, 1.0, 1.0, 1)]


def test_file_arrivals(spark, tmp_path):
    src, out, ck = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    src.mkdir()
    seen = []

    def handler(df, batch):
        seen.append(sorted(r[0] for r in df.select("data_source").distinct().collect()))
        df.write.mode("append").parquet(out)

    run = lambda: streams.stream_files(spark, str(src), "a string, b int", handler, ck, glob="*.csv")
    (src / "1.csv").write_text("a;b\nx;1\n")
    (src / "1.txt").write_text("a;b\nskip;1\n")
    run()
    (src / "2.csv").write_text("a;b\ny;2\n")
    run()
    run()
    assert seen == [["1.csv"], ["2.csv"]] and rows(spark.read.parquet(out), "a", "b") == [("x", 1), ("y", 2)]


def test_book(spark):
    levels = spark.createDataFrame([("i", "bid", 1.0, 1), ("i", "bid", 3.0, 2), ("i", "bid", 2.0, 3), ("i", "ask", 5.0, 4), ("i", "ask", 4.0, 5)],
                                   "i string, side string, price double, id int")
    depth = market.book_depth(levels, "i", 2, "id")
    assert rows(depth, "side", "level", "price") == [("ask", 1, 4.0), ("ask", 2, 5.0), ("bid", 1, 3.0), ("bid", 2, 2.0)]
    # the limit is applied before the shuffle
    assert "WindowGroupLimit" in depth._jdf.queryExecution().optimizedPlan().toString()


def test_bars_are_hash_aggregated(spark):
    ticks = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 0, 1), "x", 1.0, 2), (dt.datetime(2024, 1, 1, 10, 0, 1), "x", 5.0, 1)], TICK)
    bars = market.ohlcv(ticks, "ts", "k", "p", "1 minute", "id")
    assert "SortAggregate" not in bars._jdf.queryExecution().executedPlan().toString()
    assert rows(bars, "open", "close", "volume") == [(5.0, 1.0, 2)]


def test_latest_events_and_ties(spark):
    at = dt.datetime(2024, 1, 1, 10)
    for order in (1, -1):
        books = spark.createDataFrame([("x", at, 1, [1.0, 0.5], [2.0]), ("x", at, 2, [3.0, 0.5], [4.0]), ("y", at, 1, [5.0], []), ("x", at.replace(hour=9), 3, [9.0], [])][::order],
                                      "k string, ts timestamp, id bigint, bids array<double>, asks array<double>")
        last = market.latest_book(books, "k", "ts", 1, "id")
        assert rows(last, "k", "bids", "asks") == [("x", [3.0], [4.0]), ("y", [5.0], [])]
        assert "SortAggregate" not in last._jdf.queryExecution().executedPlan().toString()


def test_row_counts_are_reported(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame(START, SCHEMA)
    assert tables.full_reload(df, path, ["p"]) == 5
    assert tables.append(df.where("p = 'a'"), path, df.columns, ["p"]) == 2
    assert tables.replace_slice(spark, path, F.col("p") == "a", df.where("v = 1"), ["p"]) == {"deleted": 4, "inserted": 1}
    assert tables.clear_slice(spark, path, F.col("p") == "b", ["p"]) == {"deleted": 2, "inserted": 0}
    flat = str(tmp_path / "flat")
    tables.full_reload(df, flat)
    assert tables.replace_slice(spark, flat, F.col("p") == "a", df.where("v = 1")) == {"deleted": 2, "inserted": 1}


def test_interrupted_swap_is_undone(spark, tmp_path):
    path = str(tmp_path / "t")
    read = _table(spark, path)
    os.rename(path, f"{path}__backup")
    tables.replace_slice(spark, path, F.col("p") == "a")
    assert read() == sorted([r for r in START if r[0] != "a"], key=repr)


def test_hot_group(spark):
    """One seller and one group hold most rows: counts and sums stay exact."""
    from kpimill.functions.periods import window
    from kpimill.operators import cube

    n = 30_000
    lots = spark.range(n).selectExpr(
        "id AS lot_id", "DATE '2021-01-05' AS lot_placement_date", "CAST(NULL AS DATE) AS lot_purchase_date",
        "CAST(NULL AS DATE) AS subs_revocation_date", "CAST(NULL AS INT) AS sys_revocation_flag", "1 AS subs_flag",
        "IF(id % 3 = 0, 'hot', CAST(id % 7 AS STRING)) AS traffic_type", "IF(id % 3 = 0, 1, id) AS subs_id_seller",
        "CAST(NULL AS BIGINT) AS subs_id_purchaser", "1 AS branch_id_seller", "1 AS branch_id_purchaser", "1L AS tp_id_seller",
        "1L AS tp_id_purchaser", "1.0D AS lot_volume", "2.0D AS lot_value")
    out = cube.lot_arms(lots, [window("monthly", D(2021, 1, 1), D(2021, 1, 31))], ["sellers", "distinct_all"])
    hot = {r.table_name: r for r in out.where("traffic_type = 'hot'").collect()}
    assert (hot["sellers"].sellers_count, hot["sellers"].lot_count, hot["sellers"].sold_value) == (1, n // 3, 2.0 * n / 3)
    assert hot["distinct all subs"].sellers_count == 1
    assert out.where("table_name = 'sellers'").agg(F.sum("lot_count")).first()[0] == n


def test_late_ticks_change_their_bars(spark, tmp_path):
    src, ck = tmp_path / "in", str(tmp_path / "ck")
    bars = streams.bars_table(spark, str(tmp_path / "bars"))
    run = lambda: streams.run_to_bars(streams.table_stream(spark, str(src), TICK), bars, ck, "ts", "k", "p", "id")
    got = lambda: [(r[0].minute, *r[1:]) for r in rows(bars.read(), "bar_start", "open", "close", "highest", "volume")]
    _ticks(spark, src, [0, 0, 1, 30])
    run()
    assert got() == [(0, 0.0, 1.0, 1.0, 2), (1, 2.0, 2.0, 2.0, 1), (30, 3.0, 3.0, 3.0, 1)]
    assert bars.manifest()["notes"]["late"] == 0
    _ticks(spark, src, [1, 31, 25])  # minute 1 is late, minute 25 is not
    bars.watch = lambda step: (_ for _ in ()).throw(InterruptedError(step)) if step == "committed" else None
    with pytest.raises(Exception, match="InterruptedError"):
        run()
    bars.watch = lambda step: None
    run()  # the batch is given again, and is known
    assert got() == [(0, 0.0, 1.0, 1.0, 2), (1, 0.0, 2.0, 2.0, 2), (25, 2.0, 2.0, 2.0, 1), (30, 3.0, 3.0, 3.0, 1), (31, 1.0, 1.0, 1.0, 1)]
    assert (bars.manifest()["notes"]["late"], bars.manifest()["notes"]["late_in_all"], len(bars.versions())) == (1, 1, 3)
    batch = spark.read.parquet(str(src))
    whole = market.merged_bars(market.partial_bars(batch, "ts", "k", "p", "1 minute", "id"))
    assert rows(bars.read(), *whole.columns) == rows(whole)


def test_daily_plan_is_made_where_it_is_written(spark, tmp_path, monkeypatch):
    """The daily rows and the backup's are not staged beside their tables; a refused plan changes nothing."""
    raw = spark.createDataFrame(
        [("F1_2021_01", "2", "2021", "100", "Revenue", "28"), ("F2_2021_01", "2", "2021", "100", "Revenue", "56"), ("AC ", "2", "2021", "100", "Revenue", "7")],
        "version string, month string, year string, region string, account string, param_value string")
    codes = spark.createDataFrame([(5, "100", "x")], "branch_id int, code string, code_name string")
    path, backup = str(tmp_path / "t"), str(tmp_path / "b")
    tables.full_reload(jobs.plan_params(raw.limit(0), codes), path)
    held, before = [], spark.conf.get(tables.OPEN_FILES_CONF)
    monkeypatch.setattr(tables, "staged", lambda df, name: held.append(name) or pytest.fail("staged again"))
    spec = tables.SliceSpec("report_date", keys={"param_1": None, "param_2": None})
    read = lambda p: rows(spark.read.schema(fv.PARAMETERS_SCHEMA).parquet(p), "param_1", "report_date", "param_value", "branch_id")
    want = sorted([("AC", D(2021, 2, 1), 7.0, 5)] + [("F2_2021_01", D(2021, 2, d), 2.0, 5) for d in range(1, 29)], key=repr)
    for _ in range(3):
        jobs.load_plan(spark, path, backup, raw, codes, spec)
        assert read(path) == want and not held
    # the backup of the third run replaces that of the second one
    assert read(backup) == want and spark.conf.get(tables.OPEN_FILES_CONF) == before
    with pytest.raises(ValueError, match="outside"):
        tables.replace_slice(spark, path, F.col("param_1") == "BU", spark.read.schema(fv.PARAMETERS_SCHEMA).parquet(backup), ["param_1"], stored=True, gather=False)
    assert read(path) == want


def test_arriving_files_do_not_grow_with_the_tasks(spark, tmp_path):
    from kpimill.plans import job_queries

    feed = spark.createDataFrame([(f"file_{i % 3}", str(i)) for i in range(60)], "source_file string, v string").repartition(8)
    job_queries._drop_files(feed, str(tmp_path / "in"))
    assert len(list((tmp_path / "in").glob("source_file=*/part-*.csv"))) == 3
    assert spark.read.option("header", True).csv(str(tmp_path / "in")).count() == 60


def test_reload_without_gathering(spark, tmp_path):
    """More partitions than a task keeps files open for are written as well, and no row is lost."""
    feed = spark.range(1000, numPartitions=2).selectExpr("CAST(id % 100 AS STRING) AS p", "id AS v")
    assert tables.full_reload(feed, str(tmp_path / "t"), ["p"], gather=False) == 1000
    assert spark.read.parquet(str(tmp_path / "t")).agg(F.countDistinct("v"), F.countDistinct("p")).first() == (1000, 100)


def test_refresh_queries_join_their_lots_once(spark, monkeypatch):
    """Both refreshes of a query read the same staged lots."""
    from kpimill.plans import job_queries

    made, stand = [], (lambda what: lambda spark, sf: made.append(what) or spark.range(1))
    seen = []
    monkeypatch.setattr(job_queries.A, "lots", stand("lots"))
    monkeypatch.setattr(job_queries.A, "base_daily", stand("daily"))
    monkeypatch.setattr(job_queries, "table", lambda *_: spark.createDataFrame([(dt.datetime(2001, 12, 1),)], "o_orderdate timestamp_ntz"))

    class Done(Exception):
        pass

    def refresh(spark, path, lots, daily, *rest, **options):
        seen.append((lots, daily))
        if len(seen) % 2 == 0:
            raise Done

    monkeypatch.setattr(job_queries.jobs, "refresh_all", refresh)
    for query in (job_queries.refresh_all, job_queries.refresh_statistics):
        with pytest.raises(Done):
            query(spark, "none")
    assert made == ["lots", "daily"] * 2 and seen[0][0] is seen[1][0] and seen[2][0] is seen[3][0]
