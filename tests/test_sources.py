import datetime as dt
import gzip
import json

import pytest
from helpers import rows

from kpimill import session
from kpimill.sources import files, pages, workbook

D = dt.date


def test_delimiters(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text('x;"y, z"\n1;"2,5"\n')
    assert rows(files.read_delimited(spark, str(tmp_path / "a.csv"))) == [("1", "2")]
    out = files.read_delimited(spark, str(tmp_path / "b.csv"))
    assert out.columns == ["x", "y, z"] and rows(out) == [("1", "2,5")]


def test_layout_per_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id;name\n1;x\n")
    (tmp_path / "b.csv").write_text("name,id\ny,2\n")
    out = files.read_delimited(spark, str(tmp_path))
    assert rows(out, "id", "name") == [("1", "x"), ("2", "y")]
    (tmp_path / "sheet=s").mkdir()
    (tmp_path / "sheet=s" / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "sheet=s" / "2.csv").write_text("b,c\n3,4\n")
    assert rows(files.read_sheets(spark, str(tmp_path)), "a", "b", "c") == [("1", "2", None), (None, "3", "4")]


def test_stray_quotes(spark, tmp_path):
    with gzip.open(tmp_path / "feed.txt.gz", "wt") as f:
        f.write('"A";"B";"C"\n"1";"say "hi"";\n"2";x"y;"3"\n')
    out = files.read_gz_feed(spark, str(tmp_path / "feed.txt.gz"))
    assert out.columns == ["A", "B", "C"] and rows(out) == [("1", "say hi", None), ("2", "xy", "3")]


def test_sheets(spark, tmp_path):
    for name, text in {"AA": "area,Q1\nx,1\n", "Удобный, простой": "area,Q2\ny,2\ny,2\n", "skip": "a\n1\n"}.items():
        (tmp_path / f"sheet={name}").mkdir()
        (tmp_path / f"sheet={name}" / "part.csv").write_text(text)
    assert files.sheet_names(spark, str(tmp_path)) == ["AA", "skip", "Удобный, простой"]
    out = files.read_sheets(spark, str(tmp_path), ["AA", "BB", "Удобный, простой"], "kpi", distinct=True)
    assert rows(out, "kpi", "area", "Q1", "Q2") == [("AA", "x", "1", None), ("Удобный, простой", "y", None, "2")]
    with pytest.raises(ValueError):
        files.read_sheets(spark, str(tmp_path), ["none"])


def test_late_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('43831;;\njunk;Регион;\nРегион;A;"B;b"\nx;1;"2;2"\ny;3;4\n\n')
    (tmp_path / "b.csv").write_text("Регион;C;A\nz;5;6\n")
    out = files.find_header(spark, str(tmp_path), "Регион")
    assert rows(out, "Регион", "A", "`B;b`", "C") == [("x", "1", "2;2", None), ("y", "3", "4", None), ("z", "6", None, "5")]
    (tmp_path / "c.csv").write_text("no;header\n")
    with pytest.raises(ValueError, match="c.csv"):
        files.find_header(spark, str(tmp_path), "Регион")


def test_headers_cost_no_job(spark, tmp_path):
    """Layouts, first lines and report months come from the heads of the files without a pass over the data."""
    import gzip

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a b.csv").write_text("\ufeffx;y\n1;2\n")
    (tmp_path / "in" / "Я.csv").write_text("y,z\r\n3,4\r\n")
    (tmp_path / "in" / "empty.csv").write_text("")
    with gzip.open(tmp_path / "in" / "c.csv.gz", "wt") as f:
        f.write("x;y\n5;6\n")
    path = str(tmp_path / "in")
    spark.sparkContext.setJobGroup("heads", "heads")
    found = files.layouts(spark, path)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("heads")
    read = files.read_delimited(spark, path)  # Spark takes the column names from one line of each layout
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("heads")) <= len(found)
    spark.sparkContext.setJobGroup("other", "other")
    assert sorted((k, len(v)) for k, v in found.items()) == [((",", "y,z"), 1), ((";", "x;y"), 2)]
    assert rows(read, "x", "y", "z") == [("1", "2", None), ("5", "6", None), (None, "3", "4")]
    index = files.header_index(spark, path)
    assert rows(index, "delimiter", "header") == [(",", "y,z"), (";", "x;y"), (";", "x;y")]
    names = spark.read.text(path).select("_metadata.file_path").distinct()
    assert rows(index, "source_file") == rows(names)
    scans = read._jdf.queryExecution().executedPlan().toString().count("FileScan")
    assert scans == len(found)  # one for each layout, each over its own files
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "a.csv").write_text("43831;x\ny\n")
    assert rows(files.report_months(spark, str(tmp_path / "m")), "report_month") == [(D(2020, 1, 1),)]


def test_late_header_in_split_files(spark, tmp_path):
    """A file cut into many splits keeps its line order."""
    body = "".join(f"k{i};{i}\n" for i in range(20_000))
    (tmp_path / "big.csv").write_text("junk;1\njunk;2\nРегион;N\n" + body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        out = files.find_header(spark, str(tmp_path), "Регион")
        assert out.count() == 20_000 and out.where("N = '2'").count() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_last_duplicates(spark, tmp_path):
    (tmp_path / "d.csv").write_text("region;A;B;A;B;C\nx;1;2;3;4;5\n")
    out = files.read_last_duplicates(spark, str(tmp_path / "d.csv"))
    assert out.columns == ["A", "B"] and rows(out) == [("3", "4")]


def test_listing(spark, tmp_path):
    import os

    for i, name in enumerate(["old.csv", "new.csv", "note.txt"]):
        (tmp_path / name).write_text("x")
        os.utime(tmp_path / name, (1_600_000_000 + i * 1000,) * 2)
    listed = files.list_files(spark, str(tmp_path), "*.csv")
    assert files.latest_file(listed).first().file_name == "new.csv"
    since = dt.datetime.fromtimestamp(1_600_000_500, dt.timezone.utc)
    assert rows(files.list_files(spark, str(tmp_path), "*.csv", since), "file_name") == [("new.csv",)]


def test_pages(spark, tmp_path):
    page = lambda start, cols, data: {"start": start, "history": {"columns": cols, "data": data}}
    all_pages = [page(0, ["SECID", "LEGALCLOSEPRICE", "X", "NUMTRADES"], [["A", 1.5, "q", 3], ["B", None, "q", None]]),
                 page(2, ["NUMTRADES", "SECID", "LEGALCLOSEPRICE"], [[7, "C", 2.5]]), page(3, ["SECID"], [])]
    (tmp_path / "p.json").write_text("\n".join(json.dumps(p) for p in all_pages))
    read = pages.read_pages(spark, str(tmp_path))
    assert rows(pages.block_rows(read)) == [("A", 1.5, 3.0), ("B", 0.0, 0.0), ("C", 2.5, 7.0)]
    assert pages.page_gaps(read).count() == 0
    assert rows(pages.page_gaps(read.where("start <> 0"))) == [(2,)]


def test_workbook(spark, tmp_path):
    (tmp_path / "w.twb").write_text("""<workbook><datasources>
      <column caption='Profit' name='[Calc_1]'><calculation class='calc' formula='// money&#13;&#10;SUM([Sales]) - [Calc_2]'/></column>
      <column caption='Cost' name='[Calc_2]'><calculation formula='[Calc_1] + [x'/></column>
      <column caption='Group' name='[G]'><calculation class='bin'/></column>
      <column name='[Calc_3]'><calculation formula='1'/></column>
      <column caption='Plain' name='[Sales]'/>
      <column caption='Cost' name='[Calc_2]'><calculation formula='[Calc_1] + [x'/></column>
    </datasources></workbook>""")
    out = workbook.read_workbook_calcs(spark, str(tmp_path))
    assert rows(out, "name", "remote_name", "formula", "comment") == [
        ("[Cost]", "[Calc_2]", "[Profit] + [x ", ""), ("[Profit]", "[Calc_1]", "SUM([Sales]) - [Cost] ", "// money ")]


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_report_month(spark, tmp_path):
    (tmp_path / "a.csv").write_text("44256.0;x\nРегион;A\n")
    assert rows(files.report_months(spark, str(tmp_path)), "report_month") == [(D(2021, 3, 1),)]
    (tmp_path / "b.csv").write_text("Регион;A\n")
    with pytest.raises(ValueError, match="b.csv"):
        files.report_months(spark, str(tmp_path))


def test_scratch_is_removed(spark):
    import os

    there = lambda path: os.path.exists(path.removeprefix("file:"))
    with session.scratch_scope(spark) as outer:
        first = session.staged(spark.range(3), "x")[1]
        with session.scratch_scope(spark) as inner:
            a, b = (session.staged(spark.range(3), "x")[1] for _ in range(2))
            inner.keep(b)
            assert there(a) and there(b)
        assert there(first) and not there(a) and there(b)
        outer.keep(first)
    assert there(first) and not there(b)
    with pytest.raises(InterruptedError), session.scratch_scope(spark):
        c = session.staged(spark.range(3), "x")[1]
        raise InterruptedError
    assert not there(c)
    session.discard(spark, first)
