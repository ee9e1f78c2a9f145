"""Source and sink queries. Files are written from the tables to the shared folder, then read back."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from kpimill.functions import fixed_values as fv
from kpimill.operators import reshape
from kpimill.plans.registry import query
from kpimill.session import scratch_path
from kpimill.sinks import tables, versions
from kpimill.sources import analog as A
from kpimill.sources import files, pages, workbook
from kpimill.sources.analog import table, with_views


def write_feed(df: DataFrame, head: list[str], name: str) -> str:
    """Text files, one per task, that each start with the given lines; ``value`` holds the rows."""
    path = scratch_path(df.sparkSession, name)
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0  # row number inside the task
    rows = F.when(first, F.array(*map(F.lit, head), "value")).otherwise(F.array("value"))
    df.select("value", rows.alias("rows")).select(F.explode("rows").alias("value")).write.text(path)
    return path


_CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


def _customer_types(df: DataFrame) -> DataFrame:
    return df.selectExpr("CAST(c_custkey AS BIGINT) AS c_custkey", "c_name", "CAST(c_nationkey AS INT) AS c_nationkey",
                         "CAST(c_acctbal AS DOUBLE) AS c_acctbal", "c_mktsegment")


@query("scan_delimited", _CUSTOMER_SQL)
def scan_delimited(spark, sf):
    """Semicolon text; the delimiter is found from the header."""
    path = scratch_path(spark, "delimited")
    tables.export_csv(table(spark, sf, "customer"), path, ";")
    return _customer_types(files.read_delimited(spark, path))


@query("scan_gz", _CUSTOMER_SQL)
def scan_gz(spark, sf):
    path = scratch_path(spark, "gz")
    table(spark, sf, "customer").write.option("header", True).option("sep", ";").option("quoteAll", True).option(
        "compression", "gzip").csv(path)
    return _customer_types(files.read_gz_feed(spark, path))


@query("sheet_union", """
    SELECT o_orderpriority AS kpi, o_orderkey, o_totalprice FROM orders""")
def sheet_union(spark, sf):
    """A workbook folder: the sheet's name becomes the KPI column."""
    path = scratch_path(spark, "book")
    sheets = table(spark, sf, "orders").selectExpr("o_orderpriority AS sheet", "o_orderkey", "o_totalprice")
    sheets.write.option("header", True).partitionBy("sheet").csv(path)
    stacked = files.read_sheets(spark, path, label="kpi", distinct=True)
    return stacked.selectExpr("kpi", "CAST(o_orderkey AS BIGINT) AS o_orderkey", "CAST(o_totalprice AS DOUBLE) AS o_totalprice")


_PLAN_SHEET = ("CASE o_orderstatus WHEN 'F' THEN 'AC ' WHEN 'O' THEN 'FC BU 1' ELSE concat('F', CAST(quarter(o_orderdate) AS "
               "{s}), '_', CAST(year(o_orderdate) AS {s}), '_01') END AS version, CAST(month(o_orderdate) AS {s}) AS month, "
               "CAST(year(o_orderdate) AS {s}) AS year, concat(CAST(o_custkey % 25 AS {s}), '00') AS region")


def plan_sheets(spark, sf) -> str:
    """Two plan sheets with different columns, written as a workbook folder; the third sheet is absent."""
    path = scratch_path(spark, "plan")
    orders = table(spark, sf, "orders")
    cents = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS param_value"
    head = _PLAN_SHEET.format(s="STRING")
    data = orders.where("o_orderpriority < '4'").selectExpr(*_split(head), "o_orderpriority AS account", cents)
    phd = orders.where("o_orderpriority >= '4'").selectExpr(
        *_split(head), "CASE WHEN o_custkey % 2 = 0 THEN '#' ELSE 'B2C' END AS base_type",
        "CASE o_custkey % 4 WHEN 0 THEN '1100' WHEN 1 THEN '2000' WHEN 2 THEN '#' END AS tariff",
        "o_orderpriority AS account", cents)
    for name, sheet in (("data", data), ("phd", phd)):
        sheet.write.option("header", True).option("ignoreTrailingWhiteSpace", False).csv(f"{path}/sheet={name}")
    return path


def _split(select_list: str) -> list[str]:
    """Cut a select list at commas outside parentheses."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(select_list):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            out.append(select_list[start:i])
            start = i + 1
    return out + [select_list[start:]]


def read_plan_sheets(spark, path) -> DataFrame:
    # the file system may or may not tell "data" from "Data": one of the two spellings is enough
    sheets = {k: v for k, v in fv.PLAN_SHEETS.items() if k != "Data"}
    return files.read_typed_sheets(spark, path, sheets, {"param_value"})


PLAN_RAW_SQL = f"""
    SELECT {_PLAN_SHEET.format(s='VARCHAR')}, o_orderpriority AS account, o_totalprice AS param_value,
      CAST(NULL AS VARCHAR) AS base_type, CAST(NULL AS VARCHAR) AS tariff FROM orders WHERE o_orderpriority < '4'
    UNION ALL SELECT {_PLAN_SHEET.format(s='VARCHAR')}, o_orderpriority, o_totalprice,
      CASE WHEN o_custkey % 2 = 0 THEN '#' ELSE 'B2C' END,
      CASE o_custkey % 4 WHEN 0 THEN '1100' WHEN 1 THEN '2000' WHEN 2 THEN '#' END
    FROM orders WHERE o_orderpriority >= '4' AND o_custkey % 4 <> 3"""


@query("typed_sheet_union", PLAN_RAW_SQL)
def typed_sheet_union(spark, sf):
    """Known sheets by typed schema: incomplete rows dropped per sheet, a missing sheet is no error.

    The trailing blank of a version survives the text file.
    """
    return read_plan_sheets(spark, plan_sheets(spark, sf))


@query("find_header", """SELECT CAST(o_orderkey AS VARCHAR) AS "Регион", o_orderpriority AS channel, CAST(o_custkey AS VARCHAR) AS cust FROM orders""")
def find_header(spark, sf):
    """Files with two junk lines above the header."""
    lines = table(spark, sf, "orders").selectExpr("concat_ws(';', o_orderkey, o_orderpriority, o_custkey) AS value")
    path = write_feed(lines, ["43831;;", "junk;Регион;", "Регион;channel;cust"], "late-header")
    return files.find_header(spark, path, fv.REGION_MARKER).drop("source_file")


@query("select_by_marker", """SELECT l_returnflag AS region, l_linestatus AS channel, round(sum(l_quantity), 2) AS "A план" FROM lineitem GROUP BY 1, 2""")
def select_by_marker(spark, sf):
    """Key columns and the columns whose header has the plan marker."""
    wide = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("region"), F.col("l_linestatus").alias("channel")).agg(
        F.sum("l_tax").alias("A факт"), F.round(F.sum("l_quantity"), 2).alias("A план"), F.sum("l_discount").alias("B факт"))
    return wide.select(*reshape.columns_with_marker(wide.columns, fv.PLAN_MARKER, 2))


@query("last_dup_column", """SELECT CAST(o_custkey AS VARCHAR) AS A, o_orderstatus AS B FROM orders""")
def last_dup_column(spark, sf):
    """Of repeated headers the last column counts; a header that occurs once is dropped."""
    lines = table(spark, sf, "orders").selectExpr("concat_ws(';', o_orderkey, 'x', 'y', o_custkey, o_orderstatus, 'c') AS value")
    return files.read_last_duplicates(spark, write_feed(lines, ["region;A;B;A;B;C"], "duplicates"))


@query("scan_table", "SELECT s_suppkey, s_name, s_nationkey FROM supplier WHERE s_nationkey IS NOT NULL")
def scan_table(spark, sf):
    """A catalog table by name."""
    name = f"supplier_{uuid.uuid4().hex}"
    path = scratch_path(spark, "catalog")
    table(spark, sf, "supplier").write.parquet(path)
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    rows = spark.table(name).where("s_nationkey IS NOT NULL").select("s_suppkey", "s_name", "s_nationkey")
    spark.sql(f"DROP TABLE {name}")  # the plan has its files by now
    return rows


@query("scan_dir", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def scan_dir(spark, sf):
    """Only the delimited files of a tree; other files in it are ignored."""
    path = scratch_path(spark, "tree")
    events = table(spark, sf, "events").select("event_type", "event_id")
    events.write.partitionBy("event_type").option("header", True).csv(path)
    events.write.mode("append").partitionBy("event_type").json(path)
    rows = spark.read.option("header", True).option("pathGlobFilter", "part-*.csv").csv(path)
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def _event_files(spark, sf) -> str:
    path = scratch_path(spark, "arrivals")
    table(spark, sf, "events").select("event_id", "event_type").write.partitionBy("event_type").option("header", True).csv(path)
    return path


@query("latest_file", "SELECT n_nationkey, n_name FROM nation")
def latest_file(spark, sf):
    """What is in the newest file of a tree: one marked file is written after all others."""
    path = _event_files(spark, sf)
    time.sleep(0.05)  # a later modification time, also where clocks tick in milliseconds
    nation = table(spark, sf, "nation").selectExpr("n_nationkey", "n_name").coalesce(1)
    nation.write.mode("append").option("header", True).csv(f"{path}/event_type=marked")
    newest = files.latest_file(files.list_files(spark, path, "part-*.csv", recursive=True)).first()["path"]
    rows = spark.read.option("header", True).csv(newest)
    return rows.selectExpr(*[f"CAST({c} AS {t}) AS {c}" for c, t in nation.dtypes])


@query("recent_files", "SELECT event_type, CAST(min(event_id) AS BIGINT) AS first_id, count(*) AS n FROM events GROUP BY 1")
def recent_files(spark, sf):
    """Rows of the files that arrived since yesterday."""
    since = (dt.datetime.now(dt.timezone.utc) - dt.timedelta(days=1)).strftime("%Y-%m-%dT%H:%M:%S")
    rows = spark.read.option("header", True).option("modifiedAfter", since).csv(_event_files(spark, sf))
    return rows.groupBy("event_type").agg(F.min(F.expr("CAST(event_id AS BIGINT)")).alias("first_id"), F.count(F.lit(1)).alias("n"))


@query("paged_block", """
    SELECT CAST(o_orderkey AS VARCHAR) AS SECID, CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE o_totalprice END AS LEGALCLOSEPRICE,
      CAST(CASE WHEN o_custkey % 11 = 0 THEN 0 ELSE o_custkey END AS DOUBLE) AS NUMTRADES FROM orders""")
def paged_block(spark, sf):
    """Pages of at most a hundred positional rows, two column orders, missing numbers."""
    rows = table(spark, sf, "orders").selectExpr(
        "o_orderkey DIV 100 AS page",
        "CASE WHEN o_orderkey DIV 100 % 2 = 0 THEN array(CAST(o_orderkey AS STRING), IF(o_orderkey % 7 = 0, NULL, CAST(o_totalprice "
        "AS STRING)), IF(o_custkey % 11 = 0, NULL, CAST(o_custkey AS STRING))) ELSE array(IF(o_custkey % 11 = 0, NULL, CAST(o_custkey "
        "AS STRING)), CAST(o_orderkey AS STRING), IF(o_orderkey % 7 = 0, NULL, CAST(o_totalprice AS STRING))) END AS r")
    order = F.when(F.col("page") % 2 == 0, F.array(*map(F.lit, ("SECID", "LEGALCLOSEPRICE", "NUMTRADES")))).otherwise(
        F.array(*map(F.lit, ("NUMTRADES", "SECID", "LEGALCLOSEPRICE"))))
    grouped = rows.groupBy("page").agg(F.collect_list("r").alias("data")).select(
        (F.col("page") * 100).alias("start"), F.struct(order.alias("columns"), "data").alias("history"))
    path = scratch_path(spark, "pages")
    grouped.write.json(path)
    return pages.block_rows(pages.read_pages(spark, path))


@query("flatten_positions", """
    SELECT CAST(c_custkey AS VARCHAR) AS figi, c_mktsegment AS ticker, 'I' || c_custkey AS isin, 'Stock' AS instrument_type,
      c_acctbal AS balance, CAST(NULL AS DOUBLE) AS blocked, 'USD' AS expected_yield_currency, c_acctbal AS expected_yield_value,
      c_custkey % 10 AS lots, 'LCL' AS average_price_currency, c_acctbal AS average_price_value,
      CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS average_price_no_nkd, c_name AS name FROM customer""")
def flatten_positions(spark, sf):
    """Portfolios of nested positions, from JSON."""
    money = lambda cur: f"named_struct('currency', '{cur}', 'value', c_acctbal)"
    one = (f"named_struct('figi', CAST(c_custkey AS STRING), 'ticker', c_mktsegment, 'isin', concat('I', c_custkey), "
           f"'instrument_type', 'Stock', 'balance', c_acctbal, 'expected_yield', {money('USD')}, 'lots', c_custkey % 10, "
           f"'average_position_price', {money('LCL')}, 'average_position_price_no_nkd', IF(c_custkey % 2 = 0, {money('LCL')}, NULL), "
           "'name', c_name) AS p")
    path = scratch_path(spark, "portfolio")
    nested = table(spark, sf, "customer").selectExpr("c_custkey DIV 100 AS owner", one)
    nested.groupBy("owner").agg(F.collect_list("p").alias("positions")).write.json(path)
    return pages.flatten_positions(spark.read.schema(pages.POSITION_SCHEMA).json(path))


@query("daily_history", """
    SELECT CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS date, c_mktsegment AS ticker, min(o_totalprice) AS open,
      max(o_totalprice) AS highest, min(o_totalprice) AS lowest, max(o_totalprice) AS close, count(*) AS volume
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1999-01-01' GROUP BY 1, 2""")
def daily_history(spark, sf):
    """Nested candle histories per ticker and month, read for a date range."""
    customer = table(spark, sf, "customer").selectExpr("c_custkey AS o_custkey", "c_mktsegment AS ticker")
    bars = table(spark, sf, "orders").join(customer, "o_custkey").groupBy("ticker", F.date_trunc("day", "o_orderdate").cast("timestamp_ntz").alias("time")).agg(
        F.min("o_totalprice").alias("l"), F.max("o_totalprice").alias("h"), F.count(F.lit(1)).alias("v"))
    nested = bars.groupBy("ticker", F.trunc("time", "month").alias("m")).agg(
        F.collect_list(F.expr("named_struct('time', time, 'o', l, 'h', h, 'l', l, 'c', h, 'v', v)")).alias("candles")).drop("m")
    path = scratch_path(spark, "candles")
    nested.write.parquet(path)
    return pages.candle_rows(spark.read.parquet(path), "ticker", "candles", "1996-01-01", "1999-01-01")


@query("incremental_pull", "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1997-06-01'")
def incremental_pull(spark, sf):
    """Source rows from a date on; the date is a parameter of the query and reaches the scan."""
    return spark.sql("SELECT * FROM {t} WHERE o_orderdate >= CAST(:since AS TIMESTAMP_NTZ)", args={"since": "1997-06-01"},
                     t=table(spark, sf, "orders"))


@query("xml_calcs", """
    SELECT '[' || p_name || ' ' || p_partkey || ']' AS name, '[Calc_' || p_partkey || ']' AS remote_name,
      'SUM([' || p_name || ' ' || p_partkey || ']) * 2 + [raw] ' AS formula, '// ' || p_brand || ' ' AS comment
    FROM part WHERE p_size % 3 > 0""")
def xml_calcs(spark, sf):
    """Workbook XML: captioned calculations only, comment lines split off, names replaced by captions."""
    path = scratch_path(spark, "workbook")
    fields = table(spark, sf, "part").selectExpr(
        "IF(p_size % 3 > 0, concat(p_name, ' ', p_partkey), NULL) AS _caption", "concat('[Calc_', p_partkey, ']') AS _name",
        "named_struct('_formula', concat('// ', p_brand, '\\r\\nSUM([Calc_', p_partkey, ']) * 2 + [raw]')) AS calculation")
    fields.write.format("xml").option("rootTag", "workbook").option("rowTag", "column").save(path)
    return workbook.read_workbook_calcs(spark, path)


@query("top_n_sample", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_n_sample(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10)


# ---- sinks ---------------------------------------------------------------------------------------

_PARTS = ["param_1"]


def _plan_table(spark, sf):
    path = scratch_path(spark, "params")
    plan = A.plan_monthly(spark, sf)
    tables.full_reload(plan, path, _PARTS)
    return path, plan


def _plan_rows(spark, path, plan):
    return spark.read.schema(plan.schema).parquet(path).select(*plan.columns)


_SLICE = "param_1 IN ('AC', 'BU') AND report_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'"


@query("replace_slice", with_views("plan_monthly", f"""
    SELECT report_date, param_1, param_2, branch_id, param_value FROM plan_monthly
    WHERE NOT ({_SLICE}) AND param_1 <> 'F1_1995_01'
    UNION ALL SELECT report_date, param_1, param_2, branch_id, param_value + 1 FROM plan_monthly
    WHERE {_SLICE} AND param_2 <> '5-LOW'"""))
def replace_slice(spark, sf):
    """Delete a slice and add new rows; a second slice is cleared, which removes its whole partition."""
    path, plan = _plan_table(spark, sf)
    new = plan.where(f"{_SLICE} AND param_2 <> '5-LOW'").withColumn("param_value", F.col("param_value") + 1)
    tables.replace_slice(spark, path, F.expr(_SLICE), new, _PARTS)
    tables.clear_slice(spark, path, F.col("param_1") == "F1_1995_01", _PARTS)
    return _plan_rows(spark, path, plan)


@query("replace_slice_versions", with_views("plan_monthly", f"""
    SELECT 'prepared' AS step, param_1, count(*) AS rows, round(sum(param_value), 2) AS total FROM plan_monthly GROUP BY 2
    UNION ALL SELECT s, param_1, count(*), round(sum(param_value), 2) FROM plan_monthly, (VALUES ('written'), ('listed')) v(s) GROUP BY 1, 2
    UNION ALL SELECT 'committed', param_1, count(*), round(sum(CASE WHEN {_SLICE} THEN param_value + 1 ELSE param_value END), 2) FROM plan_monthly
      WHERE NOT ({_SLICE}) OR param_2 <> '5-LOW' GROUP BY 2"""))
def replace_slice_versions(spark, sf):
    """What a reader finds in a versioned table before each step of a slice replacement: the old rows until the commit, the new
    ones after it."""
    plan, seen = A.plan_monthly(spark, sf), []
    stored = versions.open_table(spark, scratch_path(spark, "plan-versions"), plan.schema, _PARTS)
    stored.replace(F.lit(True), plan)

    def look(step):
        found = versions.VersionedTable(spark, stored.path).read()
        seen.append(found.groupBy("param_1").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("param_value"), 2).alias("total")).withColumn("step", F.lit(step)))

    stored.watch = look
    stored.replace(F.expr(_SLICE), plan.where(f"{_SLICE} AND param_2 <> '5-LOW'").withColumn("param_value", F.col("param_value") + 1))
    return reduce(DataFrame.unionByName, seen).select("step", "param_1", "rows", "total")


@query("replace_slice_neighbours", with_views("plan_monthly", """
    SELECT report_date, param_1, param_2, branch_id, CASE WHEN param_1 = 'BU' AND param_2 = '2-HIGH' AND year(report_date) = 1996 THEN param_value + 1
      ELSE param_value END AS param_value FROM plan_monthly"""))
def replace_slice_neighbours(spark, sf):
    """One account of one version in one year is replaced: other accounts, other years and other versions keep their rows. Then
    rows outside the slice are offered, which is refused and changes nothing."""
    path, plan = _plan_table(spark, sf)
    slice_ = F.expr("param_1 = 'BU' AND param_2 = '2-HIGH' AND year(report_date) = 1996")
    new = plan.where(slice_).withColumn("param_value", F.col("param_value") + 1)
    for _ in range(2):
        tables.replace_slice(spark, path, slice_, new, _PARTS)
    try:
        tables.replace_slice(spark, path, slice_, plan.where("param_1 = 'AC'"), _PARTS)
    except ValueError:
        return _plan_rows(spark, path, plan)
    raise AssertionError("rows outside the slice were taken")


@query("load_counts", with_views("plan_monthly", f"""
    SELECT 'reload' AS step, 0::BIGINT AS deleted, count(*) AS inserted FROM plan_monthly
    UNION ALL SELECT 'append', 0, count(*) FROM plan_monthly WHERE param_1 = 'AC'
    UNION ALL SELECT 'replace', count(*) + count(*) FILTER (param_1 = 'AC'), count(*) FILTER (param_2 <> '5-LOW') FROM plan_monthly WHERE {_SLICE}
    UNION ALL SELECT 'clear', count(*), 0 FROM plan_monthly WHERE param_1 = 'F1_1995_01'"""))
def load_counts(spark, sf):
    """Rows that every step of a load reports."""
    path, plan = scratch_path(spark, "counts"), A.plan_monthly(spark, sf)
    steps = [("reload", 0, tables.full_reload(plan, path, _PARTS))]
    steps.append(("append", 0, tables.append(plan.where("param_1 = 'AC'"), path, plan.columns, _PARTS)))
    done = tables.replace_slice(spark, path, F.expr(_SLICE), plan.where(f"{_SLICE} AND param_2 <> '5-LOW'"), _PARTS)
    steps.append(("replace", done["deleted"], done["inserted"]))
    done = tables.clear_slice(spark, path, F.col("param_1") == "F1_1995_01", _PARTS)
    steps.append(("clear", done["deleted"], done["inserted"]))
    return spark.createDataFrame(steps, "step string, deleted bigint, inserted bigint")


@query("full_reload", with_views("plan_monthly", "SELECT report_date, param_1, param_2, branch_id, param_value FROM plan_monthly WHERE param_1 = 'BU'"))
def full_reload(spark, sf):
    path, plan = _plan_table(spark, sf)
    tables.full_reload(plan.where("param_1 = 'BU'"), path, _PARTS)
    return _plan_rows(spark, path, plan)


@query("append", with_views("plan_monthly", """
    SELECT report_date, param_1, param_2, branch_id, param_value FROM plan_monthly
    UNION ALL SELECT report_date, param_1, param_2, branch_id, param_value FROM plan_monthly WHERE param_1 = 'AC'"""))
def append(spark, sf):
    """Positional: the new rows' own names do not matter."""
    path, plan = _plan_table(spark, sf)
    more = plan.where("param_1 = 'AC'").toDF("a", "b", "c", "d", "e")
    tables.append(more, path, plan.columns, _PARTS)
    return _plan_rows(spark, path, plan)


@query("backup_slice", with_views("plan_monthly", f"SELECT report_date, param_1, param_2, branch_id, param_value FROM plan_monthly WHERE {_SLICE}"))
def backup_slice(spark, sf):
    """Two backups of one slice: the second replaces the first."""
    path, plan = _plan_table(spark, sf)
    for _ in range(2):
        tables.backup_slice(spark, path, f"{path}-backup", F.expr(_SLICE), _PARTS)
    return _plan_rows(spark, f"{path}-backup", plan)


@query("export_csv", _CUSTOMER_SQL)
def export_csv(spark, sf):
    path = scratch_path(spark, "export")
    tables.export_csv(table(spark, sf, "customer"), path)
    return _customer_types(spark.read.option("header", True).csv(path))


@query("load_history", """
    SELECT TIMESTAMP '2021-03-01 10:00:00' + to_days(CAST(n_nationkey AS INTEGER)) AS loaded_at, n_name AS file_name,
      'dic' AS schema_name, 'nation' AS table_name FROM nation WHERE n_regionkey = 1""")
def load_history(spark, sf):
    """Audit rows of one user, newest first."""
    path = scratch_path(spark, "history")
    rows = table(spark, sf, "nation").selectExpr(
        "CAST(date_add(DATE '2021-03-01', n_nationkey) AS TIMESTAMP_NTZ) + INTERVAL 10 HOUR AS loaded_at", "n_name AS file_name",
        "'dic' AS schema_name", "'nation' AS table_name", "CAST(n_regionkey AS STRING) AS user_name")
    tables.append(rows, path)
    tables.add_history(spark, path, "other.csv", "dic", "nation", "nobody", dt.datetime(2021, 3, 1, 10, 0, 0, 7))
    return tables.get_history(spark, path, "1")


@query("incremental_refresh", """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN o_totalprice + 1
      ELSE o_totalprice END AS o_totalprice, year(o_orderdate)::INTEGER AS order_year FROM orders""")
def incremental_refresh(spark, sf):
    """Rows from a date on come anew from the source; only the partitions from that date are rewritten."""
    orders = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "CAST(o_orderdate AS DATE) AS order_date", "o_totalprice", "year(o_orderdate) AS order_year")
    path = scratch_path(spark, "extract")
    tables.full_reload(orders, path, ["order_year"])
    source = orders.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    tables.incremental_refresh(spark, path, source, "order_date", dt.date(2000, 1, 1), ["order_year"])
    return spark.read.schema(orders.schema).parquet(path).select(*orders.columns)


@query("analyze", """
    SELECT 'o_custkey' AS column_name, count(*) AS row_count, count(*) FILTER (o_custkey IS NULL) AS null_count, min(o_custkey)::VARCHAR AS min_value,
      max(o_custkey)::VARCHAR AS max_value FROM orders
    UNION ALL SELECT 'order_day', count(*), count(*) FILTER (o_orderkey % 7 = 0), CAST(min(o_orderdate) FILTER (o_orderkey % 7 <> 0) AS DATE)::VARCHAR,
      CAST(max(o_orderdate) FILTER (o_orderkey % 7 <> 0) AS DATE)::VARCHAR FROM orders
    UNION ALL SELECT 'o_orderstatus', count(*), 0, NULL, NULL FROM orders""")
def analyze(spark, sf):
    """Column statistics of a catalog table: what is exact of them (of texts Spark keeps no least and greatest value)."""
    name, path = f"orders_{uuid.uuid4().hex}", scratch_path(spark, "stats")
    table(spark, sf, "orders").selectExpr(
        "o_custkey", "o_orderstatus", "IF(o_orderkey % 7 = 0, NULL, CAST(o_orderdate AS DATE)) AS order_day").write.parquet(path)
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    try:
        return tables.analyze(spark, name, ["o_custkey", "order_day", "o_orderstatus"]).drop("distinct_count")
    finally:
        spark.sql(f"DROP TABLE {name}")


@query("scan_mixed_layouts", "SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS c_mktsegment FROM customer")
def scan_mixed_layouts(spark, sf):
    """One folder with files of three layouts: other delimiters, another column order, a column more."""
    path, customer = scratch_path(spark, "mixed"), table(spark, sf, "customer")
    for rest, sep, columns in ((0, ";", ["c_custkey", "c_name", "c_mktsegment"]), (1, ",", ["c_name", "c_custkey"]), (2, "|", ["c_custkey", "c_name"])):
        part = customer.where(f"c_custkey % 3 = {rest}").select(*columns)
        part.write.mode("append").option("header", True).option("sep", sep).csv(path)
    return files.read_delimited(spark, path).selectExpr("CAST(c_custkey AS BIGINT) AS c_custkey", "c_name", "c_mktsegment")
