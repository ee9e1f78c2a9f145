"""Projection, filter, reshape and scalar queries."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import functions as F

from kpimill.functions import fixed_values as fv
from kpimill.functions import periods as P
from kpimill.functions import text as X
from kpimill.operators import coltypes, project, reshape
from kpimill.plans.registry import query
from kpimill.sinks.tables import SliceSpec
from kpimill.sources import analog as A
from kpimill.sources.analog import table, with_views

# ---- renames, layouts, conditionals --------------------------------------------------------------


@query("rename_synonyms", with_views("cdr", """
    SELECT source_file, START_DATE AS CDR_DATE, Carrier1 AS CARRIER, Destination1 AS DESTINATION,
      DURATION AS MINUTES, Total_Cost AS COST FROM cdr"""))
def rename_synonyms(spark, sf):
    """Two spellings of the carrier in one feed: the filled one wins."""
    feed = A.cdr(spark, sf).withColumn("GlobalCarrier", F.lit(None).cast("string"))
    return project.rename_synonyms(feed, fv.CDR_SYNONYMS)


@query("rename_regex", """
    SELECT l_returnflag AS region, round(sum(l_quantity), 2) AS "Мой онлайн+", round(sum(l_extendedprice), 2) AS "Безлимит"
    FROM lineitem GROUP BY 1""")
def rename_regex(spark, sf):
    """Header clean-up: strip the plan suffix, then the dictionary; done twice as spellings can nest."""
    wide = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("Регион")).agg(
        F.round(F.sum("l_quantity"), 2).alias("Мой онлайн + план"),
        F.round(F.sum("l_extendedprice"), 2).alias("Мой безлимит план"))
    clean = lambda c: fv.SALES_MIX_HEADERS.get(n := re.sub(fv.PLAN_SUFFIX_PATTERN, r"\1", c).strip(), n)
    return project.rename_by(project.rename_by(wide, clean), clean)


@query("conform", """
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS report_date, 'SM Plan' AS param_1,
      CAST(NULL AS VARCHAR) AS param_2, 'Total' AS param_3, CAST(NULL AS VARCHAR) AS param_4,
      CAST(o_custkey AS INTEGER) AS branch_id, o_orderstatus AS base_type, CAST(NULL AS INTEGER) AS tp_id_1,
      CAST(NULL AS INTEGER) AS tp_id_2, CAST(NULL AS VARCHAR) AS tariff_1, CAST(NULL AS VARCHAR) AS tariff_2,
      o_totalprice AS param_value FROM orders""")
def conform(spark, sf):
    """Target layout from a feed with other names, other order, missing and surplus columns."""
    feed = table(spark, sf, "orders").withColumnsRenamed(
        {"o_custkey": "branch_id", "o_orderstatus": "base_type", "o_totalprice": "param_value"})
    constants = {"param_1": fv.SALES_MIX_PARAM, "param_3": "Total", "report_date": F.trunc("o_orderdate", "month")}
    return project.conform(feed, fv.PARAMETERS_SCHEMA, constants)


@query("relabel", """
    SELECT CASE c_mktsegment WHEN 'BUILDING' THEN 'Bundle' WHEN 'MACHINERY' THEN 'PAYG' ELSE c_mktsegment END AS segment,
      count(*) AS n FROM customer GROUP BY 1""")
def relabel(spark, sf):
    df = table(spark, sf, "customer").withColumnRenamed("c_mktsegment", "segment")
    return project.relabel(df, "segment", {"BUILDING": "Bundle", "MACHINERY": "PAYG"}).groupBy("segment").agg(
        F.count(F.lit(1)).alias("n"))


@query("substring_relabel", """
    SELECT o_orderkey, CASE WHEN contains(o_orderpriority, 'LOW') THEN 'BU' ELSE trim(o_orderpriority) END AS version,
      CASE WHEN contains(o_orderpriority, 'U') THEN 'Свой' ELSE 'Чужой' END AS flag FROM orders""")
def substring_relabel(spark, sf):
    p = F.col("o_orderpriority")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(p.contains("LOW"), fv.BUDGET_VERSION).otherwise(F.trim(p)).alias("version"),
        F.when(p.contains("U"), fv.OWN_LABEL).otherwise(fv.OTHER_LABEL).alias("flag"))


@query("split_levels", """
    SELECT p_partkey, CASE WHEN contains(p_type, 'STANDARD') THEN p_brand END AS region,
      CASE WHEN contains(p_type, 'PROMO') THEN p_brand END AS macroregion,
      CASE WHEN contains(p_type, 'ECONOMY') THEN p_brand END AS total FROM part""")
def split_levels(spark, sf):
    levels = {"region": "STANDARD", "macroregion": "PROMO", "total": "ECONOMY"}
    out = reshape.split_levels(table(spark, sf, "part"), "p_type", "p_brand", levels)
    return out.select("p_partkey", *levels)


@query("drop_by_rule", """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem""")
def drop_by_rule(spark, sf):
    """Keep the key columns and quantity; drop names that lack the marker or carry an excluded word."""
    rule = lambda c: "disc" in c or "quant" not in c
    return reshape.drop_by_rule(table(spark, sf, "lineitem"), rule, ["l_orderkey", "l_linenumber"])


@query("null_default", """
    SELECT o_orderkey, CASE WHEN s_suppkey IS NOT NULL AND (nullif(s_name, 'Supplier#000000001') IS NULL)
      THEN 'Unknown' ELSE nullif(s_name, 'Supplier#000000001') END AS area, coalesce(s_acctbal, 0) AS balance
    FROM orders LEFT JOIN supplier ON o_custkey = s_suppkey""")
def null_default(spark, sf):
    """Matched rows with an empty name become 'Unknown', unmatched ones stay NULL; missing numbers are 0."""
    dim = table(spark, sf, "supplier").selectExpr(
        "s_suppkey AS o_custkey", "nullif(s_name, 'Supplier#000000001') AS area", "s_acctbal", "true AS matched")
    joined = table(spark, sf, "orders").join(dim, "o_custkey", "left")
    return joined.select("o_orderkey", X.or_unknown("area", F.coalesce("matched", F.lit(False))).alias("area"),
                         F.coalesce("s_acctbal", F.lit(0.0)).alias("balance"))


@query("positional_map", """
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS title, CAST(c_nationkey AS VARCHAR) AS place,
      CAST(NULL AS VARCHAR) AS extra, CAST(NULL AS VARCHAR) AS more FROM customer""")
def positional_map(spark, sf):
    """Target i from source i, one user override, surplus targets NULL."""
    feed = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    full = feed.join(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_custkey")
    mapping = project.default_mapping(["id", "title", "place", "extra", "more"], feed.columns, {"title": "c_mktsegment"})
    return coltypes.coerce(project.map_columns(full, mapping), {"id": "CV", "place": "CV"})


@query("coerce_types", """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS placed, CAST(date_trunc('second', o_orderdate) AS TIMESTAMP) AS stamp,
      o_totalprice AS price, CAST(o_custkey AS INTEGER) AS cust, o_orderkey * 3000000000 AS big,
      CAST(o_custkey AS VARCHAR) AS note FROM orders""")
def coerce_types(spark, sf):
    """Text columns to warehouse types by code; the date format is found from the data."""
    text = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "date_format(o_orderdate, 'dd.MM.yyyy') AS placed",
        "date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') AS stamp",
        "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS price", "CAST(o_custkey AS STRING) AS cust",
        "CAST(o_orderkey * 3000000000 AS STRING) AS big", "o_custkey AS note")
    codes = {"placed": "DA", "stamp": "TS", "price": "F", "cust": "I", "big": "I8", "note": "CV"}
    return coltypes.coerce(text, codes)


@query("default_columns", """
    SELECT o_orderkey, o_totalprice, 0 AS online, 0 AS online_plus FROM orders""")
def default_columns(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return project.default_columns(df, {"online": 0, "online_plus": 0, "o_totalprice": 0})


@query("shift_year", with_views("plan_monthly", """
    SELECT CAST(report_date - INTERVAL 12 MONTH AS DATE) AS report_date, param_1, param_2, branch_id,
      CAST(0 AS DOUBLE) AS param_value FROM plan_monthly"""))
def shift_year(spark, sf):
    return P.shift_year(A.plan_monthly(spark, sf), "report_date", -1, "param_value")


@query("pad_code", """SELECT c_custkey, concat(CAST(c_nationkey AS VARCHAR), '00') AS code FROM customer""")
def pad_code(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", F.concat(F.col("c_nationkey").cast("string"), F.lit("00")).alias("code"))


@query("positional_rename", """
    SELECT n_nationkey AS code, n_name AS region, n_regionkey AS cluster FROM nation""")
def positional_rename(spark, sf):
    return project.positional_rename(table(spark, sf, "nation"), ["code", "region", "cluster"])


# ---- filters -------------------------------------------------------------------------------------


@query("filter_in", """
    SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem
    WHERE l_returnflag IN ('A', 'N') AND l_linestatus NOT IN ('O')""")
def filter_in(spark, sf):
    return table(spark, sf, "lineitem").where(
        F.col("l_returnflag").isin("A", "N") & ~F.col("l_linestatus").isin("O")
    ).select("l_orderkey", "l_linenumber", "l_returnflag")


@query("filter_between", """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-02-01' AND DATE '1998-02-28'""")
def filter_between(spark, sf):
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").where(day.between("1996-02-01", "1998-02-28")).select("o_orderkey", day.alias("day"))


@query("filter_like", """
    SELECT p_partkey, p_name, p_brand FROM part WHERE p_name IS NOT NULL AND p_name NOT LIKE '%anvil%'
      AND p_name NOT LIKE '%blue%' AND p_brand <> 'Brand#11'""")
def filter_like(spark, sf):
    n = F.col("p_name")
    return table(spark, sf, "part").where(
        n.isNotNull() & ~n.like("%anvil%") & ~n.like("%blue%") & (F.col("p_brand") != "Brand#11")
    ).select("p_partkey", "p_name", "p_brand")


@query("like_escape", with_views("plan_monthly", """
    SELECT report_date, param_1, param_2, branch_id, param_value FROM plan_monthly
    WHERE param_1 LIKE 'F_Z_____Z___' ESCAPE 'Z' OR param_1 LIKE '%U%'"""))
def like_escape(spark, sf):
    """Forecast versions by an escaped pattern (literal underscores), or budget ones by a plain pattern."""
    return A.plan_monthly(spark, sf).where("param_1 LIKE 'F_Z_____Z___' ESCAPE 'Z' OR param_1 LIKE '%U%'")


@query("keep_one_total", """
    SELECT c_custkey, c_mktsegment FROM customer
    WHERE NOT contains(c_mktsegment, 'U') OR c_mktsegment = 'FURNITURE'""")
def keep_one_total(spark, sf):
    return table(spark, sf, "customer").where(reshape.keep_one_total("c_mktsegment", "U", "FURNITURE")).select(
        "c_custkey", "c_mktsegment")


@query("dropna", with_views("lots", """
    SELECT lot_id, lot_purchase_date, subs_id_purchaser FROM lots
    WHERE lot_purchase_date IS NOT NULL AND subs_id_purchaser IS NOT NULL"""))
def dropna(spark, sf):
    return A.lots(spark, sf).select("lot_id", "lot_purchase_date", "subs_id_purchaser").dropna()


@query("drop_sentinel", """
    SELECT l_orderkey, l_linenumber, l_quantity AS subs_count FROM lineitem WHERE l_returnflag <> 'R'""")
def drop_sentinel(spark, sf):
    """The spreadsheet's division error goes before the cast."""
    feed = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber",
        f"CASE WHEN l_returnflag = 'R' THEN '{fv.DIV_ZERO_SENTINEL}' ELSE CAST(l_quantity AS STRING) END AS subs_count")
    kept = feed.where(F.col("subs_count") != fv.DIV_ZERO_SENTINEL)
    return kept.withColumn("subs_count", X.to_number("subs_count"))


@query("slice_filter", with_views("plan_monthly", """
    SELECT p.report_date, param_1, param_2, branch_id, param_value FROM plan_monthly p,
      (SELECT last_day(max(report_date)) AS hi FROM plan_monthly) m
    WHERE p.report_date BETWEEN DATE '1996-03-01' AND hi AND param_1 IN ('AC', 'BU')"""))
def slice_filter(spark, sf):
    """One slice description: lower date and versions given, upper date and accounts from the data."""
    plan = A.plan_monthly(spark, sf)
    spec = SliceSpec("report_date", dt.date(1996, 3, 1), None, {"param_1": ["AC", "BU"], "param_2": None})
    return plan.where(spec.resolve(plan).column())


@query("point_lookup", """SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_name = 'Customer#000000042'""")
def point_lookup(spark, sf):
    return table(spark, sf, "customer").where(F.col("c_name") == "Customer#000000042").select(
        "c_custkey", "c_name", "c_mktsegment")


# ---- reshape -------------------------------------------------------------------------------------

_STATUSES = ["F", "O", "P"]


def _wide_status(spark, sf):
    """Region by order status, as a sheet: exact sums in cents."""
    orders = table(spark, sf, "orders").selectExpr("o_custkey % 25 AS region", "o_orderstatus",
                                                   "CAST(o_totalprice AS DECIMAL(18,2)) AS price", "o_orderpriority")
    return reshape.pivot_sum(orders, ["region", "o_orderpriority"], "o_orderstatus", "price", _STATUSES)


@query("unpivot_tariff", """
    WITH g AS (SELECT o_custkey % 25 AS region, o_orderpriority, o_orderstatus,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS v FROM orders GROUP BY 1, 2, 3),
      k AS (SELECT DISTINCT region, o_orderpriority FROM g), t AS (SELECT unnest(['F', 'O', 'P']) AS tariff)
    SELECT k.region, k.o_orderpriority, t.tariff, round(v, 2) AS subs_count FROM k CROSS JOIN t
    LEFT JOIN g ON g.region = k.region AND g.o_orderpriority = k.o_orderpriority AND g.o_orderstatus = t.tariff""")
def unpivot_tariff(spark, sf):
    """Tariff columns to rows; empty cells stay as NULL rows."""
    long = reshape.melt(_wide_status(spark, sf), ["region", "o_orderpriority"], None, "tariff", "subs_count")
    return long.withColumn("subs_count", F.round("subs_count", 2).cast("double"))


@query("unpivot_quarter", """
    WITH r AS (SELECT o_orderpriority AS kpi, c_nationkey AS area, concat('Q', CAST(quarter(o_orderdate) AS VARCHAR), '''',
        lpad(CAST(year(o_orderdate) % 100 AS VARCHAR), 2, '0')) AS quarter, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS param_value
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3)
    SELECT kpi, area, quarter, param_value FROM (SELECT DISTINCT kpi, area FROM r) CROSS JOIN (SELECT DISTINCT quarter FROM r)
      LEFT JOIN r USING (kpi, area, quarter)""")
def unpivot_quarter(spark, sf):
    """All quarters of the data as columns, then to rows, recognised by their name; empty cells stay as NULL rows, and a change
    column is dropped first."""
    wide = wide_quarters(spark, sf).withColumn("Изменение Q", F.lit(0))
    wide = reshape.drop_by_rule(wide, lambda c: fv.CHANGE_MARK in c or fv.QUARTER_MARK not in c, ["kpi", "area"])
    return reshape.melt(wide, ["kpi", "area"], [c for c in wide.columns if fv.QUARTER_MARK in c], "quarter", "param_value")


def wide_quarters(spark, sf):
    orders = table(spark, sf, "orders").selectExpr(
        "o_custkey AS c_custkey", "o_orderpriority AS kpi", "CAST(o_totalprice AS DECIMAL(18,2)) AS price",
        "concat('Q', quarter(o_orderdate), \"'\", lpad(CAST(year(o_orderdate) % 100 AS STRING), 2, '0')) AS q")
    quarters = reshape.values_of(orders, "q")
    joined = orders.join(table(spark, sf, "customer").selectExpr("c_custkey", "c_nationkey AS area"), "c_custkey")
    wide = reshape.pivot_sum(joined, ["kpi", "area"], "q", "price", quarters)
    return wide.select("kpi", "area", *[F.col(f"`{c}`").cast("double").alias(c) for c in quarters])


@query("unpivot_levels", """
    SELECT c_mktsegment AS cluster, c_nationkey AS code, level AS param_3, round(CASE level WHEN 'Min' THEN lo
      WHEN 'Target' THEN mid ELSE hi END, 4) AS param_value
    FROM (SELECT c_mktsegment, c_nationkey, min(c_acctbal) AS lo,
        CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS mid, max(c_acctbal) AS hi FROM customer GROUP BY 1, 2),
      (SELECT unnest(['Min', 'Target', 'Stretch']) AS level)""")
def unpivot_levels(spark, sf):
    wide = table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("cluster"), F.col("c_nationkey").alias("code")).agg(
        F.min("c_acctbal").alias("Min"),
        F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("Target"),
        F.max("c_acctbal").alias("Stretch"))
    long = reshape.melt(wide, ["cluster", "code"], ["Min", "Target", "Stretch"], "param_3", "param_value")
    return long.withColumn("param_value", F.round("param_value", 4))


def _pivot_sql(key, cols, val):
    return ", ".join(f"round(CAST(sum(CASE WHEN {key} = '{c}' THEN {val} END) AS DOUBLE), 2) AS \"{c}\"" for c in cols)


@query("pivot_channel", f"""
    SELECT p_type AS tariff, {_pivot_sql('l_returnflag', ['A', 'N', 'R'], 'CAST(l_quantity AS DECIMAL(18,2))')}
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def pivot_channel(spark, sf):
    sold = table(spark, sf, "lineitem").selectExpr(
        "l_partkey AS p_partkey", "l_returnflag", "CAST(l_quantity AS DECIMAL(18,2)) AS q")
    joined = sold.join(table(spark, sf, "part").selectExpr("p_partkey", "p_type AS tariff"), "p_partkey")
    wide = reshape.pivot_sum(joined, ["tariff"], "l_returnflag", "q", ["A", "N", "R"])
    return wide.select("tariff", *[F.round(F.col(c).cast("double"), 2).alias(c) for c in ("A", "N", "R")])


@query("pivot_month", """
    WITH r AS (SELECT o_orderpriority AS tariff, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS v FROM orders GROUP BY 1, 2)
    SELECT tariff, CAST(month AS VARCHAR) AS month, round(v, 2) AS value FROM (SELECT DISTINCT tariff FROM r) CROSS JOIN (SELECT DISTINCT month FROM r)
      LEFT JOIN r USING (tariff, month)""")
def pivot_month(spark, sf):
    """One column per month of the data, all of them; shown as (tariff, month, value), as the months are not known beforehand."""
    orders = table(spark, sf, "orders").selectExpr(
        "o_orderpriority AS tariff", "CAST(trunc(o_orderdate, 'month') AS STRING) AS month",
        "CAST(o_totalprice AS DECIMAL(18,2)) AS v")
    wide = reshape.pivot_sum(orders, ["tariff"], "month", "v", reshape.values_of(orders, "month"))
    long = reshape.melt(wide, ["tariff"], None, "month", "value")
    return long.withColumn("value", F.round(F.col("value").cast("double"), 2))


@query("quarter_to_months", """
    SELECT kpi, CAST(q + to_months(i) AS DATE) AS quarter, v AS value FROM (
      SELECT o_orderpriority AS kpi, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS q, count(*) AS v
      FROM orders GROUP BY 1, 2), (SELECT unnest([0, 1, 2])::INTEGER AS i)""")
def quarter_to_months(spark, sf):
    per_quarter = table(spark, sf, "orders").groupBy(
        F.col("o_orderpriority").alias("kpi"), F.date_trunc("quarter", "o_orderdate").cast("date").alias("quarter")
    ).agg(F.count(F.lit(1)).alias("value"))
    return reshape.quarter_to_months(per_quarter, "quarter")


_PASS = "param_1 = 'AC' OR (param_1 <> 'AC' AND param_2 = '5-LOW')"


@query("plan_daily", with_views("plan_monthly", f"""
    SELECT report_date, param_1, param_2, branch_id, round(param_value, 4) AS param_value FROM plan_monthly WHERE {_PASS}
    UNION ALL
    SELECT CAST(unnest(generate_series(report_date, last_day(report_date), INTERVAL 1 DAY)) AS DATE), param_1, param_2,
      branch_id, round(param_value / day(last_day(report_date)), 4) FROM plan_monthly
    WHERE param_1 <> 'AC' AND param_2 <> '5-LOW'"""))
def plan_daily(spark, sf):
    daily = reshape.allocate_daily(A.plan_monthly(spark, sf), "report_date", "param_value", _PASS)
    return daily.withColumn("param_value", F.round("param_value", 4))


@query("cross_months", """
    SELECT c_nationkey AS code, month, round(v, 2) AS param_value FROM (SELECT c_nationkey,
      CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS v FROM customer GROUP BY 1),
      (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders)""")
def cross_months(spark, sf):
    """Rows without a month axis, once per month of another sheet."""
    rows = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("code")).agg(
        F.round(F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double"), 2).alias("param_value"))
    months = table(spark, sf, "orders").select(F.trunc("o_orderdate", "month").alias("month"))
    return reshape.replicate(rows, months, "month")


# ---- scalars -------------------------------------------------------------------------------------


@query("quarter_parse", """
    SELECT o_orderkey, make_date(CAST(2000 + year(o_orderdate) % 100 AS INTEGER), CAST(quarter(o_orderdate) * 3 - 2 AS INTEGER), 1)
      AS period_start, CAST(make_date(CAST(2000 + year(o_orderdate) % 100 AS INTEGER), CAST(quarter(o_orderdate) * 3 - 2 AS INTEGER), 1)
      + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS period_end FROM orders""")
def quarter_parse(spark, sf):
    """Both label spellings: Q1'96 and 1Q'96."""
    label = F.expr("""CASE WHEN o_orderkey % 2 = 0 THEN concat('Q', quarter(o_orderdate)) ELSE concat(quarter(o_orderdate), 'Q') END
        || "'" || lpad(CAST(year(o_orderdate) % 100 AS STRING), 2, '0')""")
    start = P.quarter_start("label")
    return table(spark, sf, "orders").select("o_orderkey", label.alias("label")).select(
        "o_orderkey", start.alias("period_start"), P.quarter_end(start).alias("period_end"))


@query("parse_dates", with_views("cdr", """
    SELECT source_file, START_DATE AS cdr_text, true_date AS parsed_date FROM cdr"""))
def parse_dates(spark, sf):
    feed = A.cdr(spark, sf).withColumnRenamed("START_DATE", "cdr_text").select("source_file", "cdr_text")
    return coltypes.parse_dates(feed, "cdr_text", fv.CDR_DATE_FORMATS, ["source_file"])


@query("make_month", """
    SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS report_month FROM orders""")
def make_month(spark, sf):
    parts = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "CAST(year(o_orderdate) AS STRING) AS y", "concat(' ', month(o_orderdate)) AS m")
    return parts.select("o_orderkey", P.make_month("y", "m").alias("report_month"))


@query("excel_serial", """
    SELECT p_partkey, CAST(DATE '1900-01-01' + CAST(p_partkey - 2 AS INTEGER) AS DATE) AS day FROM part""")
def excel_serial(spark, sf):
    return table(spark, sf, "part").select("p_partkey", P.excel_serial("p_partkey").alias("day"))


@query("string_ops", """
    SELECT p_partkey, upper(trim(p_name)) AS name_up, contains(p_type, 'PROMO') AS promo, starts_with(p_brand, 'Brand#1') AS b1,
      ends_with(p_brand, '5') AS b5, replace(p_brand, '#', '') AS plain, regexp_replace(p_brand, '[0-9]+', 'N', 'g') AS masked
    FROM part""")
def string_ops(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", F.upper(F.trim("p_name")).alias("name_up"), F.col("p_type").contains("PROMO").alias("promo"),
        F.col("p_brand").startswith("Brand#1").alias("b1"), F.col("p_brand").endswith("5").alias("b5"),
        F.translate("p_brand", "#", "").alias("plain"), F.regexp_replace("p_brand", "[0-9]+", "N").alias("masked"))


@query("split_route", """
    SELECT c_custkey, c_mktsegment AS from_place, CASE WHEN c_custkey % 3 > 0 THEN CAST(c_nationkey AS VARCHAR) END AS to_place
    FROM customer""")
def split_route(spark, sf):
    """'A to B' into two trimmed columns; a text without the word gives no second part."""
    route = F.expr("CASE WHEN c_custkey % 3 > 0 THEN concat(c_mktsegment, '  to ', c_nationkey, ' ') ELSE c_mktsegment END")
    start, end = X.split_route(route)
    return table(spark, sf, "customer").select("c_custkey", start.alias("from_place"), end.alias("to_place"))


@query("proper_name", """
    SELECT c_custkey, concat('MOJ_TARIF_', regexp_replace(c_name, '[^0-9A-Za-z_]', '', 'g').upper(), 'SCHUKA') AS name
    FROM customer""")
def proper_name(spark, sf):
    """Name normaliser on values: Cyrillic letters, blanks, symbols."""
    return table(spark, sf, "customer").select(
        "c_custkey", X.proper_name_col(F.concat(F.lit("Мой тариф "), "c_name", F.lit("щука"))).alias("name"))


@query("decimal_comma", with_views("cdr", """
    SELECT source_file, CAST(replace(DURATION, ',', '.') AS DOUBLE) AS minutes,
      CAST(replace(Total_Cost, ',', '.') AS DOUBLE) AS cost FROM cdr"""))
def decimal_comma(spark, sf):
    return A.cdr(spark, sf).select(
        "source_file", X.to_number("DURATION", ",").alias("minutes"), X.to_number("Total_Cost", ",").alias("cost"))


@query("thousands", """SELECT o_orderkey, o_totalprice AS price FROM orders""")
def thousands(spark, sf):
    text = table(spark, sf, "orders").selectExpr("o_orderkey", "format_number(CAST(o_totalprice AS DECIMAL(18,2)), 2) AS t")
    return text.select("o_orderkey", X.to_number("t", ".", ",").alias("price"))


@query("round_values", """
    SELECT l_orderkey, l_linenumber, CAST(round(CAST(l_extendedprice * l_discount AS DECIMAL(18,6)), 2) AS DOUBLE) AS r2,
      CAST(round(CAST(l_extendedprice * l_tax AS DECIMAL(18,6)), 4) AS DOUBLE) AS r4 FROM lineitem""")
def round_values(spark, sf):
    """Rounding on the decimal value, so that ties do not depend on binary fractions."""
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "CAST(round(CAST(l_extendedprice * l_discount AS DECIMAL(18,6)), 2) AS DOUBLE) AS r2",
        "CAST(round(CAST(l_extendedprice * l_tax AS DECIMAL(18,6)), 4) AS DOUBLE) AS r4")


@query("infer_types", """
    WITH t AS (SELECT CAST(max(l_orderkey) AS BIGINT) AS m, max(length(l_returnflag)) AS w, max(length(d)) AS wd
      FROM (SELECT *, strftime(l_shipdate, '%d.%m.%Y') AS d FROM lineitem))
    SELECT * FROM (SELECT 'l_orderkey' AS "column", 'L_ORDERKEY' AS column_name,
        CASE WHEN m > 2147483647 THEN 'BIGINT' ELSE 'INTEGER' END AS dtype FROM t
      UNION ALL SELECT 'big', 'BIG', 'BIGINT' UNION ALL SELECT 'subs_id', 'SUBS_ID', 'DECIMAL(12,0)'
      UNION ALL SELECT 'msisdn', 'MSISDN', 'VARCHAR(11)' UNION ALL SELECT 'l_extendedprice', 'L_EXTENDEDPRICE', 'FLOAT'
      UNION ALL SELECT 'l_returnflag', 'L_RETURNFLAG', CASE WHEN w <= 11 THEN 'VARCHAR(11)' ELSE 'VARCHAR(100)' END FROM t
      UNION ALL SELECT 'shipped', 'SHIPPED', 'DATE' UNION ALL SELECT 'Мой текст', 'MOJ_TEKST', 'VARCHAR(500)'
      UNION ALL SELECT 'nothing', 'NOTHING', 'INTEGER')""")
def infer_types(spark, sf):
    feed = table(spark, sf, "lineitem").selectExpr(
        "CAST(l_orderkey AS STRING) AS l_orderkey", "CAST(l_orderkey + 3000000000 AS STRING) AS big",
        "CAST(l_suppkey AS STRING) AS subs_id", "CAST(79000000000 + l_partkey AS STRING) AS msisdn",
        "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) AS l_extendedprice", "l_returnflag",
        "date_format(l_shipdate, 'dd.MM.yyyy') AS shipped", "repeat('text ', 40) AS `Мой текст`",
        "CAST(NULL AS STRING) AS nothing")
    return coltypes.infer_types(feed)


@query("rule_check", """
    SELECT 'pattern:c_name' AS rule, count(*) FILTER (NOT regexp_full_match(c_name, '[A-Za-z][A-Za-z0-9_]*')) AS violations FROM customer
    UNION ALL SELECT 'required:c_mktsegment', count(*) FILTER (c_mktsegment IS NULL) FROM customer
    UNION ALL SELECT 'blocked:c_mktsegment', count(*) FILTER (upper(c_mktsegment) IN
      (SELECT upper(n_name) FROM nation UNION ALL SELECT 'BUILDING')) FROM customer
    UNION ALL SELECT 'unique:c_nationkey', count(*) FROM (SELECT c_nationkey FROM customer GROUP BY 1 HAVING count(*) > 1)""")
def rule_check(spark, sf):
    words = table(spark, sf, "nation").select("n_name").union(spark.sql("SELECT 'building'"))
    return coltypes.check_rules(
        table(spark, sf, "customer"), ["c_nationkey"], {"c_name": fv.NAME_PATTERN}, ["c_mktsegment"],
        {"c_mktsegment": words})
