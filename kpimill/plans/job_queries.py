"""Whole loads as queries."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from kpimill.functions import fixed_values as fv
from kpimill.operators import cube, lookup, project, reshape
from kpimill.plans import jobs
from kpimill.plans.cube_queries import arm_sql
from kpimill.plans.registry import query
from kpimill.plans.scan_queries import PLAN_RAW_SQL, plan_sheets, read_plan_sheets
from kpimill.session import materialize, scratch_path
from kpimill.sinks import statistics, tables, versions
from kpimill.sources import analog as A, files
from kpimill.sources.analog import VIEW_SQL, table, with_views

PARAM_NAMES = [c.split()[0] for c in fv.PARAMETERS_SCHEMA.split(", ")]


def params_sql(**known: str) -> str:
    """Select list of the parameters layout."""
    types = dict(c.split() for c in fv.PARAMETERS_SCHEMA.split(", "))
    sql_type = {"string": "VARCHAR", "int": "INTEGER"}
    return ", ".join(f"CAST({known.get(c, 'NULL')} AS {sql_type.get(t, t)}) AS {c}" for c, t in types.items())


# ---- cube refresh --------------------------------------------------------------------------------

MONTHS_FROM = dt.date(1995, 1, 1)


_STATISTICS = ("period", "table_name", "report_date", "status", "branch_id_seller", "lot_count", "sellers_count")
_NUMBERS = ("branch_id_seller", "lot_count", "sellers_count")


def _refresh_sql() -> str:
    # the rolling ranges end with the last load date of the orders: filter the full arms by report date
    bounds = """m AS (SELECT CAST(max(o_orderdate) AS DATE) AS d FROM orders)"""
    keep = {
        "daily": "report_date BETWEEN (SELECT d - 30 FROM m) AND (SELECT d FROM m)",
        "weekly": "report_date BETWEEN (SELECT CAST(date_trunc('week', d - 140) AS DATE) FROM m) "
        "AND (SELECT CAST(date_trunc('week', d) AS DATE) - 1 FROM m)",
        "monthly": "report_date BETWEEN DATE '1995-01-01' AND (SELECT CAST(date_trunc('month', d) AS DATE) - 1 FROM m)",
    }
    arms = " UNION ALL ".join(
        f"SELECT * FROM ({arm_sql(a, k)}) WHERE {c}" for k, c in keep.items() for a in cube.PRODUCTION_ARMS)
    return with_views("lots base_daily", f"SELECT *, DATE '2001-12-31' AS insert_date FROM ({arms})", bounds)


@query("refresh_all", _refresh_sql())
def refresh_all(spark, sf):
    """Rebuild the cube table twice: the second run replaces all three periods and changes nothing."""
    path = scratch_path(spark, "cube")
    max_date = table(spark, sf, "orders").agg(F.max("o_orderdate").cast("date")).first()[0]
    lots, daily = materialize(A.lots(spark, sf), "lots"), materialize(A.base_daily(spark, sf), "base-daily")
    for _ in range(2):
        jobs.refresh_all(spark, path, lots, daily, max_date, MONTHS_FROM, dt.date(2001, 12, 31))
    out = spark.read.parquet(path)
    return out.withColumn("lot_volume", F.round("lot_volume", 2)).withColumn("sold_value", F.round("sold_value", 2))


# ---- tracking ------------------------------------------------------------------------------------

_TRACK_KEYS = {
    "Показатель": "CASE o_orderpriority WHEN '1-URGENT' THEN 'AA' WHEN '2-HIGH' THEN 'BA' WHEN '3-MEDIUM' THEN 'NPS' "
    "WHEN '4-NOT SPECIFIED' THEN 'VFM' ELSE 'Other' END",
    "Оператор": "c_mktsegment",
    "Категория": "CASE c_nationkey % 4 WHEN 0 THEN 'Region new' WHEN 1 THEN 'Total Russia' WHEN 2 THEN 'Cluster New' ELSE 'aggr' END",
    "Категория_Выбор": "CASE c_nationkey % 5 WHEN 0 THEN 'Volga' WHEN 1 THEN 'Total Russia all' WHEN 2 THEN 'Total West' "
    "WHEN 3 THEN 'Siberia' ELSE 'Place' END",
    "Разбивка1": "CASE WHEN o_custkey % 3 = 0 THEN 'Subs / nonsubs' WHEN o_orderstatus = 'F' THEN 'Area' WHEN o_orderstatus = 'O' THEN 'ARPU declared' "
    "ELSE 'Other' END",
    "Вариант1": "CASE WHEN c_nationkey < 12 THEN 'Есть низкий' ELSE 'high' END",
    "Вариант2": "CASE WHEN o_orderstatus = 'F' THEN 'Есть карта' ELSE 'Нет' END",
}
_TRACK_QUARTERS = [f"Q{q}'{y:02d}" if q % 2 else f"{q}Q'{y:02d}" for y in (95, 96, 97, 98, 99, 0, 1) for q in range(1, 5)]


def tracking_sheet(spark, sf):
    """Wide sheet: quarter columns in both spellings, a change and a base column."""
    label = ("concat(IF(quarter(o_orderdate) % 2 = 1, concat('Q', quarter(o_orderdate)), concat(quarter(o_orderdate), 'Q')), "
             "\"'\", lpad(CAST(year(o_orderdate) % 100 AS STRING), 2, '0')) AS q")
    customer = table(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey")
    rows = table(spark, sf, "orders").join(customer, "o_custkey").selectExpr(
        *[f"{e} AS `{c}`" for c, e in _TRACK_KEYS.items()], label, "CAST(o_totalprice AS DECIMAL(18,2)) AS v")
    wide = reshape.pivot_sum(rows, list(_TRACK_KEYS), "q", "v", _TRACK_QUARTERS)
    return wide.withColumns({"Изменение Q": F.lit(1), "Base Q": F.lit(2), "Note": F.lit("x")})


def _track_sql(profile: str, where: str, cats: str, area_cat: str = '"Категория"', kpis: str = "'AA', 'BA', 'NPS', 'VFM'") -> str:
    """Every kept key row in every quarter of the sheet, empty cells included."""
    values = ", ".join(f"(DATE '{2000 + int(q[-2:])}-{3 * int(q[:2].strip('Q')) - 2:02d}-01')" for q in _TRACK_QUARTERS)
    keys = ", ".join(f'"{c}"' for c in _TRACK_KEYS)
    return f"""
    WITH r AS (SELECT {', '.join(f'{e} AS "{c}"' for c, e in _TRACK_KEYS.items())}, make_date(CAST(2000 + year(o_orderdate) % 100 AS INTEGER),
        CAST(quarter(o_orderdate) * 3 - 2 AS INTEGER), 1) AS d, CAST(o_totalprice AS DECIMAL(18,2)) AS v FROM orders JOIN customer ON o_custkey = c_custkey),
      g AS (SELECT {keys}, d, CAST(sum(v) AS DOUBLE) AS v FROM r GROUP BY ALL), k AS (SELECT DISTINCT {keys} FROM r), q(d) AS (VALUES {values}),
      s AS (SELECT * FROM k CROSS JOIN q LEFT JOIN g USING ({keys}, d))
    SELECT "Показатель" AS kpi, "Оператор" AS operator, {area_cat} AS area_cat, CASE "Категория_Выбор" WHEN 'Volga' THEN 'Волга' WHEN 'Total Russia all' THEN 'Total Russia'
      WHEN 'Siberia' THEN 'Сибирь' ELSE "Категория_Выбор" END AS area, {cats}, CAST(d AS DATE) AS period_start,
      CAST(d + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS period_end, v AS param_value, '{profile}' AS source_table
    FROM s WHERE "Показатель" IN ({kpis}) AND "Категория_Выбор" <> 'Total West' AND {where}"""


_OWN = "CASE WHEN contains({c}, 'Есть') THEN 'Свой' ELSE 'Чужой' END AS cat_3"
_SOCIAL = """ "Категория" <> 'aggr' AND "Разбивка1" IN ('Area', 'ARPU declared')"""
_TRACK_SQL = {
    "social_subs": _track_sql("social_subs", _SOCIAL, '"Разбивка1" AS cat_1, "Вариант1" AS cat_2, ' + _OWN.format(c='"Вариант2"')),
    "social": _track_sql("social", _SOCIAL, '"Разбивка1" AS cat_1, "Вариант1" AS cat_2, CAST(NULL AS VARCHAR) AS cat_3'),
    "general": _track_sql(
        "general", """ "Категория" <> 'aggr' AND "Разбивка1" = 'Subs / nonsubs'""",
        "CAST(NULL AS VARCHAR) AS cat_1, CAST(NULL AS VARCHAR) AS cat_2, " + _OWN.format(c='"Вариант1"'), kpis="'AA', 'BA', 'VFM'"),
    "express": _track_sql(
        "express", """ "Вариант1" = 'Есть низкий' AND "Вариант2" = 'Нет' AND "Разбивка1" = 'ARPU declared' """,
        "CAST(NULL AS VARCHAR) AS cat_1, CAST(NULL AS VARCHAR) AS cat_2, CAST(NULL AS VARCHAR) AS cat_3", area_cat="'Region'"),
}


def _profile_sheet(spark, sf, profile):
    sheet = tracking_sheet(spark, sf)
    if profile != "express":
        return sheet
    sheet = sheet.where("`Вариант1` = 'Есть низкий' AND `Вариант2` = 'Нет' AND `Разбивка1` = 'ARPU declared'")
    sheet = sheet.drop("Вариант1", "Вариант2", "Разбивка1", "Категория").withColumn("География", F.lit("Region"))
    return sheet.withColumnRenamed("Категория_Выбор", "Выбор")


@query("tracking_long", _TRACK_SQL["social_subs"])
def tracking_long(spark, sf):
    return jobs.normalize_tracking(tracking_sheet(spark, sf), "social_subs")


def _track_query(profile):
    @query(f"tracking_{profile}", _TRACK_SQL[profile])
    def run(spark, sf):
        return jobs.normalize_tracking(_profile_sheet(spark, sf, profile), profile)

    return run


for _profile in _TRACK_SQL:
    _track_query(_profile)


@query("tracking_load", f"""
    SELECT * FROM ({_TRACK_SQL['general']}) UNION ALL SELECT * FROM ({_TRACK_SQL['social']})""")
def tracking_load(spark, sf):
    """Two workbooks as files: the layout is told by their names, and each load replaces its own rows only. The first one is
    loaded again."""
    book, path = scratch_path(spark, "tracking-book"), scratch_path(spark, "tracking")
    sheet = tracking_sheet(spark, sf)
    for name in ("Динамика KPIs", "data"):
        sheet.write.option("header", True).option("quoteAll", True).csv(f"{book}/sheet={name}")
    empty = jobs.normalize_tracking(sheet, "general").limit(0)
    tables.full_reload(empty, path, ["source_table"])
    for name in ("2021 Osnovnye.xlsx", "2021 Соцдем.xlsx", "2021 Основные.xlsx"):
        long = jobs.read_tracking(spark, book, name)
        jobs.load_tracking(spark, path, long, jobs.tracking_profile(name, ["data", "Динамика KPIs"]))
    return spark.read.schema(empty.schema).parquet(path).select(*fv.TRACKING_COLUMNS)


# ---- sales mix -----------------------------------------------------------------------------------

_BRANDS = [f"Brand#{i}" for i in range(1, 26)]
_MIX_REGIONS = {"NATION_4": "NATION_7", "NATION_9": "NATION_3"}


def _mix_wide(spark, sf):
    """Region by tariff sheet, every value in cents."""
    part = table(spark, sf, "part").selectExpr("p_partkey AS l_partkey", "p_brand")
    nation = table(spark, sf, "nation").selectExpr("n_nationkey", "n_name AS region")
    sold = table(spark, sf, "lineitem").selectExpr(
        "l_partkey", "l_suppkey % 25 AS n_nationkey", "CAST(l_extendedprice AS DECIMAL(18,2)) / 3 AS v")
    rows = sold.join(part, "l_partkey").groupBy("n_nationkey", "p_brand").agg(F.sum("v").alias("v")).join(nation, "n_nationkey")
    return reshape.pivot_sum(rows, ["region"], "p_brand", "v", _BRANDS)


def _branches(spark, sf):
    retail = lookup.retail_branches(
        A.branch(spark, sf), A.region_dim(spark, sf), fv.EXCLUDED_BRANCH_MARKS, fv.DEFERRED_CLUSTER)
    return lookup.representative_key(retail, ["region_name"], "branch_id")


_MIX_SQL = f"""
    WITH v AS (SELECT n_name AS region0, p_brand AS tariff, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS s
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN nation ON l_suppkey % 25 = n_nationkey GROUP BY 1, 2),
      keep AS (SELECT region0 FROM v GROUP BY 1 HAVING count(DISTINCT tariff) = {len(_BRANDS)}),
      p AS (SELECT p_brand AS tariff, min(p_partkey) AS tp_id FROM part GROUP BY 1),
      b AS (SELECT min(s_suppkey) AS branch_id, n_name AS region FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 2)
    SELECT {{params}} FROM (SELECT *, CASE region0 WHEN 'NATION_4' THEN 'NATION_7' WHEN 'NATION_9' THEN 'NATION_3' ELSE region0 END AS region
      FROM v WHERE region0 IN (SELECT region0 FROM keep)) JOIN p USING (tariff) JOIN b USING (region)"""
_MIX_VALUE = "round(CAST(s / 3 AS DECIMAL(18,6)), 2)"


@query("sales_mix_params", _MIX_SQL.format(params=params_sql(
    report_date="DATE '2021-03-01'", param_1="'SM Plan'", branch_id="branch_id", tp_id_1="tp_id", param_value=_MIX_VALUE)))
def sales_mix_params(spark, sf):
    """New layout: incomplete regions dropped, tariffs to plan ids, regions to branches, loaded as a slice."""
    long = jobs.sales_mix_long(_mix_wide(spark, sf).withColumnRenamed("region", fv.REGION_MARKER), "new")
    month = dt.date(2021, 3, 1)
    params = jobs.sales_mix_params(long, month, A.price_plan(spark, sf), _branches(spark, sf), _MIX_REGIONS)
    path = scratch_path(spark, "mix")
    tables.full_reload(params.withColumn("param_value", F.lit(0.0)), path, ["param_1"])
    jobs.load_sales_mix(spark, path, params, month)
    return spark.read.schema(fv.PARAMETERS_SCHEMA).parquet(path).select(*PARAM_NAMES)


@query("sales_mix_params_by_channel", _MIX_SQL.format(params=params_sql(
    report_date="DATE '2020-05-01'", param_1="'SM Plan'", param_2="'Shops'", branch_id="branch_id", tp_id_1="tp_id",
    param_value=_MIX_VALUE)))
def sales_mix_params_by_channel(spark, sf):
    """Old layout: plan columns by marker, header clean-up, all channels but the total."""
    wide = _mix_wide(spark, sf)
    sheet = wide.select(F.col("region").alias("Регион"), F.explode(F.array(F.lit("Total"), F.lit("Shops"))).alias("Channels"),
                        *[F.col(f"`{b}`").alias(f"{b} план") for b in _BRANDS], F.lit(7).alias("Brand#1 факт"))
    long = jobs.sales_mix_long(sheet, "old", 2, totals=False)
    return jobs.sales_mix_params(
        long, dt.date(2020, 5, 1), A.price_plan(spark, sf), _branches(spark, sf), _MIX_REGIONS, by_channel=True)


def _old_sheets(spark, sf) -> str:
    """One file per order year: month in its first cell, a junk line, the header, a row per nation. Two headers mean one plan,
    and some cells hold the division error."""
    path = scratch_path(spark, "mix-files")
    customer = table(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey")
    orders = table(spark, sf, "orders").join(customer, "o_custkey").selectExpr(
        "year(o_orderdate) AS y", "c_nationkey AS n", "CAST(o_totalprice AS DECIMAL(18,2)) AS v")
    cells = orders.groupBy("y", "n").agg(F.sum("v").alias("a"), F.count(F.lit(1)).alias("b"))
    body = cells.selectExpr(
        "y", "3 AS at", "concat_ws(';', concat('NATION_', n), 'Total', a, 'x', IF(n % 5 = 0, '0x7', CAST(b AS STRING)), b + 1) AS value")
    head = cells.select("y").distinct().selectExpr(
        "y", "posexplode(array(concat(datediff(make_date(y, 3, 1), DATE '1899-12-30'), ';;'), 'note;;', "
        "'Регион;Channels;Brand#11 план;Brand#11 факт;Lite план;Lite/Old план')) AS (at, value)")
    # a file per year, its lines in order
    lines = head.unionByName(body).repartition("y").sortWithinPartitions("y", "at", "value")
    lines.select("y", "value").write.partitionBy("y").text(path)
    return path


_OLD_MIX_SQL = """
    WITH c AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, c_nationkey AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS a, count(*) AS b
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
      l AS (SELECT y, n, 'Brand#11' AS tariff, CAST(a AS DOUBLE) AS v FROM c UNION ALL SELECT y, n, 'Brand#12', b FROM c WHERE n % 5 <> 0
        UNION ALL SELECT y, n, 'Brand#12', b + 1 FROM c)"""
_OLD_HEADERS = {**fv.SALES_MIX_HEADERS, "Lite": "Brand#12", "Lite/Old": "Brand#12"}


@query("sales_mix_old_layout", f"""{_OLD_MIX_SQL}
    SELECT concat('NATION_', n) AS region, 'Total' AS channel, tariff, make_date(y, 3, 1) AS report_month, round(v, 2) AS subs_count FROM l""")
def sales_mix_old_layout(spark, sf):
    """Files with their month and a late header; two headers that become one plan stay two rows."""
    long = jobs.sales_mix_files(spark, _old_sheets(spark, sf), headers=_OLD_HEADERS)
    return long.select("region", "channel", "tariff", "report_month", "subs_count")


@query("sales_mix_load", f"""{_OLD_MIX_SQL},
      p AS (SELECT p_brand AS tariff, min(p_partkey) AS tp_id FROM part GROUP BY 1),
      b AS (SELECT min(s_suppkey) AS branch_id, n_name AS region FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 2)
    SELECT {params_sql(report_date="make_date(y, 3, 1)", param_1="'SM Plan'", branch_id="branch_id", tp_id_1="tp_id", param_value="round(v, 2)")}
    FROM l JOIN p USING (tariff) JOIN b ON b.region = concat('NATION_', l.n)
    UNION ALL SELECT {params_sql(report_date="DATE '2050-01-01'", param_1="'SM Plan'", param_value="1")}""")
def sales_mix_load(spark, sf):
    """The files' months replaced in the parameters table, twice; another month's rows stay."""
    long = jobs.sales_mix_files(spark, _old_sheets(spark, sf), headers=_OLD_HEADERS)
    params = jobs.sales_mix_params(long, "report_month", A.price_plan(spark, sf), _branches(spark, sf), {})
    path = scratch_path(spark, "mix-table")
    other = {"report_date": F.lit("2050-01-01"), "param_1": fv.SALES_MIX_PARAM, "param_value": F.lit(1.0)}
    tables.full_reload(project.conform(spark.range(1), fv.PARAMETERS_SCHEMA, other), path, ["param_1"])
    months = [r[0] for r in params.select("report_date").distinct().collect()]
    for _ in range(2):
        jobs.load_sales_mix(spark, path, params, *months)
    return spark.read.schema(fv.PARAMETERS_SCHEMA).parquet(path).select(*PARAM_NAMES)


@query("report_month_check", """
    SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y, make_date(CAST(year(o_orderdate) AS INTEGER), 3, 1) AS report_month FROM orders""")
def report_month_check(spark, sf):
    """Every file's report month, from the day number in its first cell."""
    months = files.report_months(spark, _old_sheets(spark, sf))
    return months.selectExpr("CAST(regexp_extract(source_file, 'y=([0-9]+)', 1) AS INT) AS y", "report_month")


# ---- finance plan --------------------------------------------------------------------------------

_PLAN_CTES = f"raw AS ({PLAN_RAW_SQL}), branch AS ({VIEW_SQL['branch']}), " \
    "codes AS (SELECT min(branch_id) AS branch_id, code, code_name FROM branch WHERE b2c_flag = 1 GROUP BY 2, 3)"
_PLAN_PARAMS = params_sql(
    report_date="make_date(CAST(year AS INTEGER), CAST(month AS INTEGER), 1)",
    param_1="CASE WHEN contains(version, 'BU') THEN 'BU' ELSE trim(version) END", param_2="account", branch_id="branch_id",
    base_type="CASE base_type WHEN '#' THEN 'NOT A' ELSE base_type END",
    tariff_1="CASE tariff WHEN '1100' THEN 'Bundle' WHEN '2000' THEN 'PAYG' WHEN '#' THEN 'NO SUBS' ELSE tariff END",
    param_value="round(CAST(param_value AS DECIMAL(24,8)), 4)")


def _retail_codes(spark, sf):
    return A.branch(spark, sf).where("code IS NOT NULL AND b2c_flag = 1")


@query("plan_params", f"WITH {_PLAN_CTES} SELECT {_PLAN_PARAMS} FROM raw JOIN codes ON raw.region = codes.code")
def plan_params(spark, sf):
    """Plan sheets to the parameters layout."""
    return jobs.plan_params(read_plan_sheets(spark, plan_sheets(spark, sf)), _retail_codes(spark, sf))


_KEEP = ", ".join(c for c in PARAM_NAMES if c not in ("report_date", "param_value"))


@query("plan_load", f"""
    WITH {_PLAN_CTES}, p AS (SELECT {_PLAN_PARAMS} FROM raw JOIN codes ON raw.region = codes.code),
      d AS (SELECT {_KEEP}, report_date, param_value FROM p WHERE param_1 = 'AC' OR param_2 = '5-LOW'
        UNION ALL SELECT {_KEEP}, CAST(unnest(generate_series(report_date, last_day(report_date), INTERVAL 1 DAY)) AS DATE),
          param_value / day(last_day(report_date)) FROM p WHERE param_1 <> 'AC' AND param_2 <> '5-LOW')
    SELECT {_KEEP}, report_date, round(param_value, 6) AS param_value FROM d
    WHERE param_1 NOT LIKE 'F%' OR param_1 = (SELECT arg_max(param_1, concat(split_part(param_1, '_', 2), '|', split_part(param_1, '_', 1)))
      FROM p WHERE param_1 LIKE 'F%')""")
def plan_load(spark, sf):
    """The whole load: backup, slice replacement with daily values, newest forecast only. Run twice."""
    path, backup = scratch_path(spark, "plan-target"), scratch_path(spark, "plan-backup")
    raw = read_plan_sheets(spark, plan_sheets(spark, sf))
    codes = _retail_codes(spark, sf)
    tables.full_reload(jobs.plan_params(raw.limit(0), codes), path)
    spec = tables.SliceSpec("report_date", keys={"param_1": None, "param_2": None})
    for _ in range(2):
        jobs.load_plan(spark, path, backup, raw, codes, spec, "5-LOW")
    return spark.read.schema(fv.PARAMETERS_SCHEMA).parquet(path).select(*PARAM_NAMES).withColumn("param_value", F.round("param_value", 6))


@query("plan_load_other_months", f"""
    WITH {_PLAN_CTES}, p AS (SELECT {_PLAN_PARAMS} FROM raw JOIN codes ON raw.region = codes.code),
      d AS (SELECT {_KEEP}, report_date, param_value FROM p WHERE param_1 = 'AC' OR param_2 = '5-LOW'
        UNION ALL SELECT {_KEEP}, CAST(unnest(generate_series(report_date, last_day(report_date), INTERVAL 1 DAY)) AS DATE),
          param_value / day(last_day(report_date)) FROM p WHERE param_1 <> 'AC' AND param_2 <> '5-LOW')
    SELECT {_KEEP}, report_date, CASE WHEN report_date BETWEEN DATE '1996-01-01' AND DATE '1996-06-30' THEN round(param_value, 6) ELSE -1 END AS param_value
    FROM d WHERE param_1 IN ('AC', 'BU')""")
def plan_load_other_months(spark, sf):
    """Half a year of two versions, named with blanks around them, loaded onto a table with all months: the other months stay
    as they are."""
    path, backup = scratch_path(spark, "plan-part"), scratch_path(spark, "plan-part-backup")
    raw = read_plan_sheets(spark, plan_sheets(spark, sf))
    codes = _retail_codes(spark, sf)
    old = jobs.daily_plan(jobs.plan_params(raw, codes).where("param_1 IN ('AC', 'BU')"), "5-LOW").withColumn("param_value", F.lit(-1.0))
    tables.full_reload(old, path, ["param_1"], gather=False)
    spec = tables.SliceSpec("report_date", dt.date(1996, 1, 1), dt.date(1996, 6, 1), {"param_1": ["AC ", " BU"], "param_2": None})
    for _ in range(2):
        jobs.load_plan(spark, path, backup, raw, codes, spec, "5-LOW")
    return spark.read.schema(fv.PARAMETERS_SCHEMA).parquet(path).select(*PARAM_NAMES).withColumn("param_value", F.round("param_value", 6))


_SEG_MONTHS = [f"2021-{m:02d}-01" for m in range(1, 13)]


@query("plan_two_segments", f"""
    WITH branch AS ({VIEW_SQL['branch']}), o AS (SELECT concat(CAST(c_nationkey AS VARCHAR), '00') AS code, o_orderpriority AS base,
        CAST(month(o_orderdate) AS INTEGER) AS m, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS v
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3),
      k AS (SELECT DISTINCT code, base FROM o), mm AS (SELECT CAST(unnest(generate_series(1, 12)) AS INTEGER) AS m),
      bb AS (SELECT concat(CAST(c_nationkey AS VARCHAR), '00') AS code, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS v FROM customer GROUP BY 1),
      u AS (SELECT k.code, upper(k.base) AS base, mm.m, o.v, 'B2C' AS seg FROM k CROSS JOIN mm LEFT JOIN o ON o.code = k.code AND o.base = k.base AND o.m = mm.m
        UNION ALL SELECT code, NULL, m, v, 'B2B' FROM bb CROSS JOIN mm)
    SELECT {params_sql(report_date="make_date(2021, m, 1)", param_1="'Plan'", param_2="'Core Live Subs'", param_3="seg", branch_id="branch_id",
                       base_type="base", param_value="v")} FROM u JOIN branch b ON b.code = u.code""")
def plan_two_segments(spark, sf):
    """Consumer plan with month columns, business plan without: replicated over the same months."""
    customer = table(spark, sf, "customer").selectExpr(
        "c_custkey AS o_custkey", "concat(CAST(c_nationkey AS STRING), '00') AS code", "CAST(c_acctbal AS DECIMAL(18,2)) AS bal")
    orders = table(spark, sf, "orders").selectExpr(
        "o_custkey", "lower(o_orderpriority) AS base", "concat('2021-', lpad(CAST(month(o_orderdate) AS STRING), 2, '0'), '-01') AS m",
        "CAST(o_totalprice AS DECIMAL(18,2)) AS v")
    b2c = reshape.pivot_sum(orders.join(customer, "o_custkey"), ["code", "base"], "m", "v", _SEG_MONTHS)
    b2c = b2c.select("code", F.lit("r").alias("region"), "base", *[F.col(f"`{m}`").cast("double").alias(m) for m in _SEG_MONTHS])
    b2b = customer.groupBy("code").agg(F.sum("bal").cast("double").alias("value"))
    return jobs.plan_two_segments(b2c, b2b, A.branch(spark, sf))


@query("live_base_load", f"""
    WITH branch AS ({VIEW_SQL['branch']}), bb AS (SELECT c_nationkey AS n, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS v FROM customer GROUP BY 1),
      y AS (SELECT 2021 AS y UNION ALL SELECT 2020), mm AS (SELECT CAST(unnest(generate_series(1, 12)) AS INTEGER) AS m)
    SELECT {params_sql(report_date="make_date(y, m, 1)", param_1="'Plan'", param_2="'Core Live Subs'", param_3="'B2B'", branch_id="branch_id",
                       param_value="CASE y WHEN 2021 THEN v ELSE 0 END")}
    FROM bb CROSS JOIN y CROSS JOIN mm JOIN branch b ON b.code = concat(CAST(n AS VARCHAR), '00')""")
def live_base_load(spark, sf):
    """Plan of a year and its zero copy for the year before, each replacing its own year; run twice."""
    customer = table(spark, sf, "customer").selectExpr("concat(CAST(c_nationkey AS STRING), '00') AS code", "CAST(c_acctbal AS DECIMAL(18,2)) AS bal")
    b2b = customer.groupBy("code").agg(F.sum("bal").cast("double").alias("value"))
    no_rows = customer.where("false").selectExpr("code", "'' AS region", "'' AS base", *[f"0.0 AS `{m}`" for m in _SEG_MONTHS])
    params = jobs.plan_two_segments(no_rows, b2b, A.branch(spark, sf))
    path = scratch_path(spark, "live")
    tables.full_reload(params.limit(0), path)
    for _ in range(2):
        jobs.load_live_base(spark, path, params, "Plan", 2021)
        jobs.load_live_base(spark, path, jobs.previous_year_zero(params), "Plan", 2020)
    return spark.read.schema(fv.PARAMETERS_SCHEMA).parquet(path).select(*PARAM_NAMES)


@query("target_levels", f"""
    WITH branch AS ({VIEW_SQL['branch']}), t AS (SELECT c_nationkey AS n, min(c_acctbal) AS lo, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS mid,
        max(c_acctbal) AS hi FROM customer GROUP BY 1), l AS (SELECT unnest(['Min', 'Target', 'Stretch']) AS level)
    SELECT {params_sql(report_date="DATE '2021-01-01'", param_1="'BU'", param_2="'Core Live Subs'", param_3="level", branch_id="branch_id",
                       param_value="CASE level WHEN 'Min' THEN lo WHEN 'Target' THEN mid ELSE hi END")}
    FROM t CROSS JOIN l JOIN branch b ON b.code = concat(CAST(n AS VARCHAR), '00')""")
def target_levels(spark, sf):
    """Two KPIs in the sheet, one kept; codes padded."""
    per = table(spark, sf, "customer").groupBy("c_nationkey").agg(
        F.min("c_acctbal").alias("lo"), F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("mid"),
        F.max("c_acctbal").alias("hi"))
    sheet = per.select(F.lit("x"), F.explode(F.array(F.lit(fv.LIVE_BASE_KPI), F.lit("Revenue"))), "c_nationkey", F.lit("r"), "lo", "mid", "hi")
    return jobs.target_levels(sheet, A.branch(spark, sf), dt.date(2021, 1, 1))


@query("refresh_statistics", f"""
    WITH r AS ({_refresh_sql()}), c AS (UNPIVOT (SELECT {', '.join(f"CAST({c} AS VARCHAR) AS {c}" for c in _STATISTICS)} FROM r)
        ON COLUMNS(*) INTO NAME column_name VALUE v)
    SELECT n.column_name, (SELECT count(*) FROM r) AS row_count, (SELECT count(*) FROM r) - count(v) AS null_count,
      CASE WHEN n.column_name IN ('lot_count', 'branch_id_seller', 'sellers_count') THEN min(TRY_CAST(v AS DOUBLE)) END AS low,
      CASE WHEN n.column_name IN ('lot_count', 'branch_id_seller', 'sellers_count') THEN max(TRY_CAST(v AS DOUBLE)) END AS high,
      CASE WHEN n.column_name NOT IN ('lot_count', 'branch_id_seller', 'sellers_count') THEN min(v) END AS low_text,
      CASE WHEN n.column_name NOT IN ('lot_count', 'branch_id_seller', 'sellers_count') THEN max(v) END AS high_text,
      TRUE AS distinct_fits, TRUE AS median_fits
    FROM (SELECT unnest({list(_STATISTICS)}) AS column_name) n LEFT JOIN c ON c.column_name = n.column_name GROUP BY n.column_name""")
def refresh_statistics(spark, sf):
    """Statistics of the cube table after two refreshes. Estimates are held against the exact values: distinct counts within three
    standard errors, the median's rank within its bound."""
    path, stats = scratch_path(spark, "cube"), scratch_path(spark, "cube-statistics")
    max_date = table(spark, sf, "orders").agg(F.max("o_orderdate").cast("date")).first()[0]
    lots, daily = materialize(A.lots(spark, sf), "lots"), materialize(A.base_daily(spark, sf), "base-daily")
    for months_from in (dt.date(1996, 1, 1), MONTHS_FROM):
        jobs.refresh_all(spark, path, lots, daily, max_date, months_from, dt.date(2001, 12, 31), statistics_path=stats)
    found = statistics.table_statistics(versions.VersionedTable(spark, stats)).where(F.col("column_name").isin(*_STATISTICS))
    rows = spark.read.parquet(path)
    texts = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("text"), F.col(c).cast("double").alias("number") if c in _NUMBERS
                               else F.lit(None).cast("double").alias("number")) for c in _STATISTICS])
    cells = rows.select(F.inline(texts)).join(found.select("column_name", F.col("quantiles")[1].alias("median")), "column_name")
    exact = cells.groupBy("column_name").agg(
        F.countDistinct("text").alias("n"), F.avg((F.col("number") < F.col("median")).cast("double")).alias("below"),
        F.avg((F.col("number") <= F.col("median")).cast("double")).alias("upto"))
    near = F.abs(F.col("distinct_count") - F.col("n")) <= F.ceil(F.col("n") * 3 * statistics.DISTINCT_ERROR)
    rank = (F.col("below") <= 0.5 + statistics.RANK_ERROR) & (F.col("upto") >= 0.5 - statistics.RANK_ERROR)
    return found.join(exact, "column_name", "left").select(
        "column_name", "row_count", "null_count", "low", "high", "low_text", "high_text",
        F.coalesce(near, F.col("distinct_count") == 0).alias("distinct_fits"), F.coalesce(rank, F.lit(True)).alias("median_fits"))


# ---- call records --------------------------------------------------------------------------------

_CDR_BODY = """
      m AS (SELECT source_file, min(CAST(date_trunc('month', true_date) AS DATE)) AS cdr_month FROM cdr WHERE Carrier1[1] IN ('T', 'H') GROUP BY 1),
      codes AS (SELECT code, min(new_destination) AS dest FROM (SELECT unnest(string_split(dial_codes, ', ')) AS code, new_destination
        FROM dial_lists) WHERE length(code) >= 2 GROUP BY 1),
      map AS (SELECT CAST(p_partkey AS VARCHAR) AS destination, replace(string_split('810' || p_partkey || '5, 77', ',')[1], '810', '') AS first_code,
        CASE WHEN p_size % 5 = 0 THEN '' ELSE p_brand END AS country, CASE WHEN p_size % 7 <> 0 THEN p_type END AS area FROM part WHERE p_partkey % 10 <> 3),
      best AS (SELECT first_code, max_by(dest, length(code)) AS dest FROM (SELECT DISTINCT first_code FROM map) JOIN codes ON starts_with(first_code, code) GROUP BY 1)"""


@query("cdr_normalize", f"""
    WITH cdr AS ({VIEW_SQL['cdr']}), dial_lists AS ({VIEW_SQL['dial_lists']}), {_CDR_BODY}
    SELECT m.cdr_month, c.true_date AS cdr_date, Carrier1[1:5] AS carrier, Carrier1[7:] AS branch, 'Outgoing' AS direction,
      coalesce(best.dest, Destination1) AS destination, CAST(replace(DURATION, ',', '.') AS DOUBLE) AS minutes,
      CAST(replace(Total_Cost, ',', '.') AS DOUBLE) AS cost, CAST(NULL AS VARCHAR) AS currency, DATE '2021-03-01' AS insert_date,
      Carrier1[1] AS carrier_type, CASE WHEN map.destination IS NOT NULL THEN coalesce(nullif(country, ''), 'Unknown') END AS country,
      CASE WHEN map.destination IS NOT NULL THEN coalesce(nullif(area, ''), 'Unknown') END AS area, c.source_file AS data_source
    FROM cdr c JOIN m ON c.source_file = m.source_file LEFT JOIN map ON map.destination = Destination1
      LEFT JOIN best ON best.first_code = map.first_code WHERE Carrier1[1] IN ('T', 'H')""")
def cdr_normalize(spark, sf):
    """Outgoing feeds: one date format per file, carrier gate, country and area, longest dialling code."""
    return _normal_cdr(spark, sf).drop("unreadable").withColumns({c: F.col(c).cast("double") for c in ("minutes", "cost")})


def _mapping(spark, sf):
    return table(spark, sf, "part").where("p_partkey % 10 <> 3").selectExpr(
        "CAST(p_partkey AS STRING) AS destination", "concat('810', p_partkey, '5, 77') AS codes",
        "CASE WHEN p_size % 5 = 0 THEN '' ELSE p_brand END AS country", "CASE WHEN p_size % 7 <> 0 THEN p_type END AS area")


def _normal_cdr(spark, sf):
    feed = A.cdr(spark, sf).withColumnRenamed("source_file", "data_source")
    return jobs.normalize_cdr(feed, dt.date(2021, 3, 1), mapping=_mapping(spark, sf), dictionary=A.dial_lists(spark))


@query("cdr_incoming", f"""
    WITH cdr AS ({VIEW_SQL['cdr']}), f AS (SELECT * FROM cdr WHERE Carrier1[1] IN ('T', 'H'))
    SELECT CAST(date_trunc('month', min(true_date) OVER (PARTITION BY source_file)) AS DATE) AS cdr_month, true_date AS cdr_date,
      Carrier1[1:5] AS carrier, Carrier1[7:] AS branch, 'Incoming' AS direction, Destination1 AS destination,
      CAST(replace(DURATION, ',', '.') AS DOUBLE) AS minutes, s_name AS country, CAST(s_nationkey AS VARCHAR) AS area, source_file AS data_source
    FROM f LEFT JOIN supplier ON Destination1 = CAST(s_suppkey AS VARCHAR)""")
def cdr_incoming(spark, sf):
    """Incoming feeds are told by their operator column and looked up in their own dictionary."""
    feed = A.cdr(spark, sf).withColumnsRenamed({"source_file": "data_source", "Destination1": "OPERATOR_NAME", "Carrier1": "CARRIER_SHORT_NAME"})
    dictionary = table(spark, sf, "supplier").selectExpr(
        "CAST(s_suppkey AS STRING) AS destination", "s_name AS country", "CAST(s_nationkey AS STRING) AS area")
    out = jobs.normalize_cdr(feed, dt.date(2021, 3, 1), incoming=dictionary)
    return out.withColumn("minutes", F.col("minutes").cast("double")).drop("cost", "currency", "insert_date", "carrier_type", "unreadable")


@query("cdr_load", f"""
    WITH cdr AS ({VIEW_SQL['cdr']}), f AS (SELECT *, CAST(date_trunc('month', min(true_date) OVER (PARTITION BY source_file)) AS DATE) AS cdr_month
        FROM cdr WHERE Carrier1[1] IN ('T', 'H')),
      w AS (SELECT cdr_month, source_file, max(true_date) AS d, count(*) AS n FROM f GROUP BY 1, 2),
      b AS (SELECT cdr_month, arg_max(source_file, (d, n, source_file)) AS best FROM w GROUP BY 1)
    SELECT 'Outgoing' AS direction, f.cdr_month, source_file AS data_source, count(*) AS rows, max(true_date) AS max_date
    FROM f JOIN b ON b.cdr_month = f.cdr_month AND b.best = f.source_file GROUP BY 1, 2, 3""")
def cdr_load(spark, sf):
    """Gate and replace: loading the same files again changes nothing, as they have no more rows than stored."""
    path = scratch_path(spark, "cdr")
    records = _normal_cdr(spark, sf)
    for _ in range(2):
        jobs.load_cdr(spark, path, records)
    stored = spark.read.schema(jobs.CDR_SCHEMA).parquet(path)
    return stored.groupBy("direction", "cdr_month", "data_source").agg(
        F.count(F.lit(1)).alias("rows"), F.max("cdr_date").alias("max_date"))


_CDR_LINES = VIEW_SQL["cdr"].replace("FROM lineitem", ", l_linenumber FROM lineitem")


@query("cdr_by_direction", f"""
    WITH cdr AS (SELECT *, CASE l_linenumber % 3 WHEN 0 THEN 'Incoming' WHEN 1 THEN 'Outgoing' ELSE 'Transit' END AS direction FROM ({_CDR_LINES})),
      dial_lists AS ({VIEW_SQL['dial_lists']}), {_CDR_BODY}
    SELECT direction, CASE WHEN direction = 'Outgoing' THEN coalesce(best.dest, Destination1) ELSE Destination1 END AS destination,
      CASE direction WHEN 'Incoming' THEN s_name WHEN 'Outgoing' THEN CASE WHEN map.destination IS NOT NULL THEN coalesce(nullif(map.country, ''), 'Unknown') END END AS country,
      CASE direction WHEN 'Incoming' THEN CAST(s_nationkey AS VARCHAR)
        WHEN 'Outgoing' THEN CASE WHEN map.destination IS NOT NULL THEN coalesce(nullif(map.area, ''), 'Unknown') END END AS area,
      count(*) AS rows, sum(CAST(replace(DURATION, ',', '.') AS DECIMAL(18,2)))::DOUBLE AS minutes
    FROM cdr c LEFT JOIN map ON map.destination = Destination1 LEFT JOIN best ON best.first_code = map.first_code
      LEFT JOIN supplier ON Destination1 = CAST(s_suppkey AS VARCHAR) WHERE Carrier1[1] IN ('T', 'H') GROUP BY 1, 2, 3, 4""")
def cdr_by_direction(spark, sf):
    """One feed with incoming, outgoing and other records, each looked up by its own direction."""
    way = "CASE l_linenumber % 3 WHEN 0 THEN 'Incoming' WHEN 1 THEN 'Outgoing' ELSE 'Transit' END AS DIRECTION"
    feed = A.cdr(spark, sf, way).withColumnRenamed("source_file", "data_source")
    incoming = table(spark, sf, "supplier").selectExpr(
        "CAST(s_suppkey AS STRING) AS destination", "s_name AS country", "CAST(s_nationkey AS STRING) AS area")
    out = jobs.normalize_cdr(feed, dt.date(2021, 3, 1), incoming=incoming, mapping=_mapping(spark, sf), dictionary=A.dial_lists(spark))
    return out.groupBy("direction", "destination", "country", "area").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("minutes").cast("double").alias("minutes"))


# some files are named by year, so they hold several months; some cells have a thousands mark
_FILES_SQL = f"""
    WITH c AS (SELECT CASE WHEN source_file LIKE 'file_3%' THEN left(source_file, 11) ELSE source_file END AS f, true_date,
        source_file LIKE 'file_1%01' AND CAST(Destination1 AS INTEGER) % 50 = 7 AS bad FROM ({VIEW_SQL['cdr']}) WHERE Carrier1[1] IN ('T', 'H')),
      r AS (SELECT f AS data_source, count(*) AS rows, CAST(date_trunc('month', min(true_date)) AS DATE) AS first_month,
        CAST(date_trunc('month', max(true_date)) AS DATE) AS last_month, count(DISTINCT date_trunc('month', true_date)) AS months,
        count(*) FILTER (bad) AS unreadable, max(true_date) AS last_day FROM c GROUP BY 1)"""


def _untidy_records(spark, sf):
    feed = A.cdr(spark, sf).withColumnRenamed("source_file", "data_source")
    feed = feed.withColumn("DURATION", F.expr("IF(data_source LIKE 'file_1%01' AND CAST(Destination1 AS INT) % 50 = 7, '1 234,5', DURATION)"))
    feed = feed.withColumn("data_source", F.expr("IF(data_source LIKE 'file_3%', left(data_source, 11), data_source)"))
    return jobs.read_cdr(feed)


@query("cdr_file_report", f"{_FILES_SQL} SELECT * EXCLUDE (last_day), months = 1 AND unreadable = 0 AS ok FROM r")
def cdr_file_report(spark, sf):
    """Files with several months or with cells that are no numbers."""
    return jobs.cdr_file_report(_untidy_records(spark, sf))


@query("cdr_load_refuses", f"""{_FILES_SQL}
    SELECT data_source, rows FROM r WHERE months = 1 AND unreadable = 0
    QUALIFY row_number() OVER (PARTITION BY first_month ORDER BY last_day DESC, rows DESC, data_source DESC) = 1""")
def cdr_load_refuses(spark, sf):
    """Refused files stay out of the load; of the others, one per month passes the gate."""
    path = scratch_path(spark, "cdr-refuses")
    records = _untidy_records(spark, sf)
    jobs.load_cdr(spark, path, jobs.cdr_layout(records, dt.date(2021, 3, 1)), jobs.cdr_file_report(records))
    return spark.read.schema(jobs.CDR_SCHEMA).parquet(path).groupBy("data_source").agg(F.count(F.lit(1)).alias("rows"))


def _drop_files(feed, folder: str) -> None:
    """The feed's files as they are dropped into a folder: the rows of a file are gathered first, so there are no more files
    for having more tasks."""
    gathered = feed.hint("rebalance", F.col("source_file"))
    gathered.write.mode("append").partitionBy("source_file").option("header", True).option("sep", ";").csv(folder)


@query("arrivals_load", f"""
    WITH cdr AS ({VIEW_SQL['cdr']}), f AS (SELECT source_file, CAST(date_trunc('month', true_date) AS DATE) AS m, true_date FROM cdr WHERE Carrier1[1] IN ('T', 'H')),
      w AS (SELECT m, source_file, max(true_date) AS d, count(*) AS n, source_file[6] IN ('2', '3') AS late FROM f GROUP BY 1, 2),
      one AS (SELECT m, arg_max(source_file, (d, n, source_file)) AS f, max((d, n, source_file)) AS best FROM w WHERE NOT late GROUP BY 1),
      two AS (SELECT w.m, arg_max(source_file, (d, n, source_file)) AS f FROM w LEFT JOIN one ON one.m = w.m
        WHERE late AND (one.m IS NULL OR (d >= best[1] AND n > best[2])) GROUP BY 1),
      b AS (SELECT coalesce(one.m, two.m) AS m, coalesce(two.f, one.f) AS f FROM one FULL JOIN two ON one.m = two.m)
    SELECT 'Outgoing' AS direction, w.m AS cdr_month, w.source_file AS data_source, n AS rows, d AS max_date, 3 AS versions
    FROM w JOIN b ON b.m = w.m AND b.f = w.source_file""")
def arrivals_load(spark, sf):
    """Files that arrive in two portions, gated and loaded batch by batch. The first load stops before its commit and the second
    after it: the first batch is given again and loaded, the second is given again and known. So there are three versions: the
    empty table, and one per portion."""
    source, path, checkpoint = (scratch_path(spark, n) for n in ("cdr-arriving", "cdr-versions", "cdr-checkpoint"))
    feed = A.cdr(spark, sf)
    stops = {"written": 1, "committed": 1}

    def watch(step):
        done = len(table.versions())
        if stops.get(step) and (step, done) in (("written", 1), ("committed", 3)):
            stops[step] = 0
            raise InterruptedError(step)

    table = versions.open_table(spark, path, jobs.CDR_SCHEMA, jobs.CDR_SLICE)
    table.watch = watch
    kind = ", ".join(f"{c} string" for c in [*feed.drop("source_file").columns, "source_file"])
    for portion in (("0", "1"), ("2", "3")):
        arrived = feed.where(F.substring("source_file", 6, 1).isin(*portion))
        _drop_files(arrived, source)
        for _ in range(2):
            try:
                jobs.arrive_cdr(spark, source, table, kind, checkpoint, dt.date(2021, 3, 1), file_col="source_file", glob="part-*.csv", files_per_batch=100_000)
            except StreamingQueryException as stopped:
                if "InterruptedError" not in str(stopped):
                    raise
    return table.read().groupBy("direction", "cdr_month", "data_source").agg(
        F.count(F.lit(1)).alias("rows"), F.max("cdr_date").alias("max_date")).withColumn("versions", F.lit(len(table.versions())))


# ---- upload --------------------------------------------------------------------------------------


@query("typed_load", """
    SELECT CAST(o_orderkey AS INTEGER) AS NOMER, CAST(o_orderdate AS DATE) AS DATA, o_totalprice AS SUMMA,
      o_orderpriority AS PRIORITET, CAST(NULL AS VARCHAR) AS EXTRA FROM orders""")
def typed_load(spark, sf):
    """Text feed with Cyrillic headers: types proposed, columns mapped and coerced, appended, audited."""
    feed = table(spark, sf, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS `Номер`", "date_format(o_orderdate, 'dd.MM.yyyy') AS `Дата`",
        "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS `Сумма`", "o_orderpriority AS `Приоритет`")
    path, history = scratch_path(spark, "upload"), scratch_path(spark, "upload-history")
    mapping = {"NOMER": "Номер", "DATA": "Дата", "SUMMA": "Сумма", "PRIORITET": "Приоритет", "EXTRA": None}
    jobs.typed_load(spark, feed, path, history, "orders.csv", "sales.orders", "me", dt.datetime(2021, 3, 1, 9, 30), mapping)
    return spark.read.parquet(path)
