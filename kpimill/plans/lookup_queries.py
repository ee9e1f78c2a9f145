"""Lookup, aggregation, set and load-control queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpimill.functions import fixed_values as fv
from kpimill.functions import text as X
from kpimill.operators import control, diff, lookup, project
from kpimill.plans.registry import query
from kpimill.sources import analog as A
from kpimill.sources.analog import table, with_views


@query("plan_lookup", with_views("price_plan", """
    SELECT p_brand AS tariff, tp_id, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS subs_count
    FROM lineitem JOIN part ON l_partkey = p_partkey
      JOIN (SELECT name_report, min(tp_id) AS tp_id FROM price_plan GROUP BY 1) d ON d.name_report = p_brand
    GROUP BY 1, 2"""))
def plan_lookup(spark, sf):
    """Tariff name to plan id: summed per tariff first, then looked up in a dictionary with one id per name."""
    feed = table(spark, sf, "lineitem").selectExpr("l_partkey AS p_partkey", "CAST(l_quantity AS BIGINT) AS q").join(
        table(spark, sf, "part").selectExpr("p_partkey", "p_brand AS tariff"), "p_partkey")
    per_tariff = feed.groupBy("tariff").agg(F.sum("q").alias("subs_count"))
    plans = lookup.representative_key(A.price_plan(spark, sf), ["name_report"], "tp_id")
    return lookup.map_dim(per_tariff, plans, {"tariff": "name_report"})


@query("branch_lookup", with_views("branch region_dim", """
    SELECT upper(c_mktsegment) AS segment, region, branch_id, count(*) AS n FROM (
      SELECT c_mktsegment, CASE n_name WHEN 'NATION_4' THEN 'NATION_7' ELSE n_name END AS region
      FROM customer JOIN nation ON c_nationkey = n_nationkey) c
      JOIN (SELECT min(b.branch_id) AS branch_id, region_name FROM branch b JOIN region_dim r ON b.region_id = r.region_id
        WHERE b.product_cluster_name <> 'ASIA' AND b.branch_name NOT LIKE '%9%' GROUP BY 2) d ON d.region_name = c.region
    GROUP BY 1, 2, 3"""))
def branch_lookup(spark, sf):
    """Region names relabelled, then looked up in one branch per region."""
    nation = table(spark, sf, "nation").selectExpr("n_nationkey AS c_nationkey", "n_name AS region")
    feed = table(spark, sf, "customer").join(nation, "c_nationkey")
    feed = project.relabel(feed, "region", {"NATION_4": "NATION_7"}).groupBy(F.upper("c_mktsegment").alias("segment"), "region").agg(
        F.count(F.lit(1)).alias("n"))
    retail = lookup.retail_branches(A.branch(spark, sf), A.region_dim(spark, sf), ["9"], "ASIA")
    dim = lookup.representative_key(retail, ["region_name"], "branch_id")
    return lookup.map_dim(feed, dim, {"region": "region_name"})


@query("left_lookup", """
    SELECT l_orderkey, l_linenumber, l_partkey, s_name AS country, s_nationkey AS area
    FROM lineitem LEFT JOIN supplier ON l_partkey = s_suppkey""")
def left_lookup(spark, sf):
    dim = table(spark, sf, "supplier").selectExpr("s_suppkey AS destination", "s_name AS country", "s_nationkey AS area")
    feed = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return lookup.map_dim(feed, dim, {"l_partkey": "destination"}, "left")


_PREFIX_SQL = with_views("dial_lists", """
    , codes AS (SELECT code, min(new_destination) AS dest FROM (SELECT unnest(string_split(dial_codes, ', ')) AS code,
        new_destination FROM dial_lists) WHERE length(code) >= 2 GROUP BY 1),
      k AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS k FROM lineitem),
      best AS (SELECT k, max_by(dest, length(code)) AS dest FROM k JOIN codes ON starts_with(k, code) GROUP BY 1)
    SELECT l_orderkey, l_linenumber, best.dest AS new_destination, coalesce(best.dest, CAST(l_orderkey AS VARCHAR)) AS destination
    FROM lineitem LEFT JOIN best ON best.k = CAST(l_orderkey AS VARCHAR)""".replace("    , codes", ", codes", 1))


def _prefix(spark, sf):
    feed = table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", "CAST(l_orderkey AS STRING) AS first_code")
    out = lookup.longest_prefix(feed, "first_code", A.dial_lists(spark), "dial_codes", "new_destination", "new_destination")
    return out.select("l_orderkey", "l_linenumber", "new_destination",
                      F.coalesce(X.blank_to_null("new_destination"), "first_code").alias("destination"))


@query("longest_prefix", _PREFIX_SQL)
def longest_prefix(spark, sf):
    return _prefix(spark, sf)


@query("longest_prefix_large_dictionary", """
    WITH codes AS (SELECT code, min(p_name) AS dest FROM (SELECT unnest([CAST(p_partkey AS VARCHAR), CAST(p_partkey AS VARCHAR) || '7']) AS code, p_name
        FROM part) WHERE length(code) >= 2 GROUP BY 1),
      k AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS k FROM lineitem),
      p AS (SELECT k, substr(k, 1, CAST(n AS INTEGER)) AS code FROM k, unnest(generate_series(2, length(k))) AS u(n)),
      best AS (SELECT k, max_by(dest, length(code)) AS dest FROM p JOIN codes USING (code) GROUP BY 1)
    SELECT l_orderkey, l_linenumber, best.dest AS new_destination FROM lineitem LEFT JOIN best ON best.k = CAST(l_orderkey AS VARCHAR)""")
def longest_prefix_large_dictionary(spark, sf):
    """The same lookup with two codes for every part."""
    feed = table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", "CAST(l_orderkey AS STRING) AS k")
    codes = table(spark, sf, "part").selectExpr("concat(p_partkey, ', ', p_partkey, '7') AS dial_codes", "p_name AS dest")
    out = lookup.longest_prefix(feed, "k", codes, "dial_codes", "dest", "new_destination")
    return out.select("l_orderkey", "l_linenumber", "new_destination")


@query("branch_dim", with_views("branch region_dim", """
    SELECT min(b.branch_id) AS branch_id, r.region_name FROM branch b JOIN region_dim r ON b.region_id = r.region_id
    WHERE product_cluster_name IS NOT NULL AND branch_id IS NOT NULL AND b.branch_name NOT LIKE '%CDMA%'
      AND b.branch_name NOT LIKE '%MVNO%' AND b.branch_name NOT LIKE '%LTE450%' AND b.product_cluster_name <> 'Deferred'
    GROUP BY 2"""))
def branch_dim(spark, sf):
    retail = lookup.retail_branches(
        A.branch(spark, sf), A.region_dim(spark, sf), fv.EXCLUDED_BRANCH_MARKS, fv.DEFERRED_CLUSTER)
    return lookup.representative_key(retail, ["region_name"], "branch_id")


@query("code_dim", with_views("branch", """
    SELECT min(branch_id) AS branch_id, code, code_name FROM branch WHERE code IS NOT NULL AND b2c_flag = 1 GROUP BY 2, 3"""))
def code_dim(spark, sf):
    rows = A.branch(spark, sf).where("code IS NOT NULL AND b2c_flag = 1")
    return lookup.representative_key(rows, ["code", "code_name"], "branch_id")


@query("other_bucket", with_views("price_plan", """
    SELECT CASE WHEN name_report IN (SELECT p_brand FROM lineitem JOIN part ON l_partkey = p_partkey
      WHERE l_quantity >= 50 AND p_size > 40) THEN name_report ELSE 'Other' END AS name_report, min(tp_id) AS tp_id
    FROM price_plan GROUP BY 1"""))
def other_bucket(spark, sf):
    """The list of named tariffs comes from the feed."""
    big = table(spark, sf, "lineitem").where("l_quantity >= 50").selectExpr("l_partkey AS p_partkey")
    names = table(spark, sf, "part").where("p_size > 40").join(big, "p_partkey", "left_semi").select("p_brand")
    return lookup.other_bucket(A.price_plan(spark, sf), names, "name_report", "tp_id")


@query("unmatched_keys", """
    SELECT l_partkey, count(*) AS rows FROM lineitem WHERE l_partkey NOT IN (SELECT s_suppkey FROM supplier) GROUP BY 1""")
def unmatched_keys(spark, sf):
    return lookup.unmatched(table(spark, sf, "lineitem"), table(spark, sf, "supplier"), {"l_partkey": "s_suppkey"})


@query("unknown_names", """
    SELECT DISTINCT p_brand FROM part WHERE p_brand NOT IN (SELECT p_brand FROM part WHERE p_size = 7)""")
def unknown_names(spark, sf):
    part = table(spark, sf, "part")
    return lookup.membership(part, part.where("p_size = 7").selectExpr("p_brand AS known"), ("p_brand", "known"))


# ---- sets, keys, watermarks ----------------------------------------------------------------------

_SNAP_A = "c_custkey, CASE WHEN c_custkey % 7 = 3 THEN NULL ELSE c_mktsegment END AS segment, c_acctbal"
_SNAP_B = ("c_custkey, CASE WHEN c_custkey % 7 = 3 THEN NULL ELSE c_mktsegment END AS segment, "
           "CASE WHEN c_custkey % 7 = 2 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal")


def _snapshots(spark, sf):
    """Two states of one table: rows removed, changed, duplicated, with NULLs in a compared column."""
    c = table(spark, sf, "customer")
    a = c.where("c_custkey % 7 <> 5").selectExpr(*_SNAP_A.split(", "))
    b = c.where("c_custkey % 7 <> 1").selectExpr(*_SNAP_B.split(", "))
    return a.unionAll(a.where("c_custkey % 7 = 4")), b


_DIFF_SQL = f"""
    WITH a0 AS (SELECT {_SNAP_A} FROM customer WHERE c_custkey % 7 <> 5),
      a AS (SELECT * FROM a0 UNION ALL SELECT * FROM a0 WHERE c_custkey % 7 = 4),
      b AS (SELECT {_SNAP_B} FROM customer WHERE c_custkey % 7 <> 1),
      u AS (SELECT *, 1 AS l, 0 AS r FROM a UNION ALL SELECT *, 0, 1 FROM b)
    SELECT c_custkey, segment, c_acctbal, CAST(sum(l) AS BIGINT) AS left_rows, CAST(sum(r) AS BIGINT) AS right_rows,
      CASE WHEN sum(r) = 0 THEN 'left_only' WHEN sum(l) = 0 THEN 'right_only' ELSE 'both' END AS side
    FROM u GROUP BY 1, 2, 3"""


@query("table_diff", f"SELECT * FROM ({_DIFF_SQL}) WHERE side = 'right_only'")
def table_diff(spark, sf):
    return diff.table_diff(*_snapshots(spark, sf))


@query("table_diff_both_sides", f"SELECT * FROM ({_DIFF_SQL}) WHERE side <> 'both'")
def table_diff_both_sides(spark, sf):
    return diff.table_diff(*_snapshots(spark, sf), which=None)


@query("table_diff_by_digest", f"SELECT * FROM ({_DIFF_SQL}) WHERE side <> 'both'")
def table_diff_by_digest(spark, sf):
    """The same differences; rows of buckets that are equal on both sides are not shuffled."""
    return diff.table_diff_by_digest(*_snapshots(spark, sf), which=None)


_LINES = "l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag"


@query("table_diff_few_changes", f"""
    WITH a AS (SELECT {_LINES} FROM lineitem), b AS (SELECT {_LINES.replace('l_quantity', 'l_quantity + CASE WHEN l_orderkey % 5000 = 3 THEN 1 ELSE 0 END AS l_quantity')}
      FROM lineitem WHERE l_orderkey % 7000 <> 5), x AS (SELECT *, count(*) AS n FROM a GROUP BY ALL), y AS (SELECT *, count(*) AS n FROM b GROUP BY ALL)
    SELECT {_LINES}, coalesce(x.n, 0) AS left_rows, coalesce(y.n, 0) AS right_rows, CASE WHEN x.n IS NULL THEN 'right_only' ELSE 'left_only' END AS side
    FROM x FULL JOIN y USING ({_LINES}) WHERE x.n IS NULL OR y.n IS NULL""")
def table_diff_few_changes(spark, sf):
    """Two large versions of a table with a few changed and removed rows."""
    old = table(spark, sf, "lineitem").select(*_LINES.split(", "))
    new = old.where("l_orderkey % 7000 <> 5").withColumn("l_quantity", F.expr("l_quantity + CASE WHEN l_orderkey % 5000 = 3 THEN 1 ELSE 0 END"))
    return diff.table_diff_by_digest(old, new, which=None)


@query("except_rows", f"""
    WITH a0 AS (SELECT {_SNAP_A} FROM customer WHERE c_custkey % 7 <> 5),
      a AS (SELECT * FROM a0 UNION ALL SELECT * FROM a0 WHERE c_custkey % 7 = 4),
      b AS (SELECT {_SNAP_B} FROM customer WHERE c_custkey % 7 <> 1)
    SELECT * FROM a EXCEPT ALL SELECT * FROM b""")
def except_rows(spark, sf):
    """Bag difference: copies beyond those on the other side."""
    every = diff.table_diff(*_snapshots(spark, sf), which="left_only").unionByName(
        diff.table_diff(*_snapshots(spark, sf), which="both"))
    extra = every.withColumn("n", F.col("left_rows") - F.col("right_rows")).drop("side", "left_rows", "right_rows")
    return diff.repeat_rows(extra, "n")


_PLAN_OLD = "report_date < DATE '1998-01-01' OR param_1 = 'BU'"


@query("delta_keys", with_views("plan_monthly", f"""
    SELECT report_date, param_1, param_2, branch_id, param_value FROM plan_monthly WHERE (param_1, report_date, param_2) NOT IN
      (SELECT (param_1, report_date, param_2) FROM plan_monthly WHERE {_PLAN_OLD})"""))
def delta_keys(spark, sf):
    plan = A.plan_monthly(spark, sf)
    return diff.delta_keys(plan, plan.where(_PLAN_OLD), ["param_1", "report_date", "param_2"])


@query("distinct_keys", with_views("plan_monthly", """
    SELECT param_1, report_date, param_2 FROM plan_monthly WHERE param_1 IN ('BU', 'AC') OR param_1 LIKE '%F%' GROUP BY 1, 2, 3"""))
def distinct_keys(spark, sf):
    return A.plan_monthly(spark, sf).where("param_1 IN ('BU', 'AC') OR param_1 LIKE '%F%'").select(
        "param_1", "report_date", "param_2").distinct()


@query("value_counts", """SELECT o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 1""")
def value_counts(spark, sf):
    counts = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), "value")


@query("accumulate_distinct", """
    SELECT l_returnflag, l_linestatus, l_quantity FROM lineitem UNION SELECT l_returnflag, l_linestatus, l_quantity
    FROM lineitem WHERE l_quantity > 10""")
def accumulate_distinct(spark, sf):
    """Files stacked one after another, repeated rows once."""
    one = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    return one.unionByName(one.where("l_quantity > 10")).dropDuplicates()


def _cdr_slices(spark, sf):
    """Call records with a direction and their month, from two files per slice of different length."""
    line = table(spark, sf, "lineitem").selectExpr(
        "CASE WHEN l_returnflag = 'R' THEN 'Incoming' ELSE 'Outgoing' END AS direction",
        "trunc(l_shipdate, 'month') AS cdr_month", "CAST(l_shipdate AS DATE) AS cdr_date",
        "concat('f', CASE WHEN l_linenumber > 2 THEN 2 ELSE 1 END) AS data_source", "l_suppkey")
    return line


@query("slice_watermark", """
    SELECT CASE WHEN l_returnflag = 'R' THEN 'Incoming' ELSE 'Outgoing' END AS direction,
      CAST(date_trunc('month', l_shipdate) AS DATE) AS cdr_month, CAST(max(l_shipdate) AS DATE) AS max_date, count(*) AS row_count
    FROM lineitem GROUP BY 1, 2""")
def slice_watermark(spark, sf):
    return control.slice_watermark(_cdr_slices(spark, sf), ["direction", "cdr_month"], "cdr_date")


@query("freshness_gate", """
    WITH c AS (SELECT CASE WHEN l_returnflag = 'R' THEN 'Incoming' ELSE 'Outgoing' END AS direction,
        CAST(date_trunc('month', l_shipdate) AS DATE) AS cdr_month, CAST(l_shipdate AS DATE) AS d,
        concat('f', CASE WHEN l_linenumber > 2 THEN '2' ELSE '1' END) AS f, l_suppkey FROM lineitem),
      w AS (SELECT direction, cdr_month, f, max(d) AS md, count(*) AS n FROM c GROUP BY 1, 2, 3),
      s AS (SELECT direction, cdr_month, max(d) AS md, count(*) AS n FROM c WHERE l_suppkey % 2 = 0 AND cdr_month < DATE '1999-01-01' GROUP BY 1, 2),
      j AS (SELECT w.direction, w.cdr_month, w.f, w.md, w.n, s.md AS smd, s.n AS sn,
          w.md >= coalesce(s.md, w.cdr_month) AND w.n > coalesce(s.n, 0) AS load FROM w LEFT JOIN s USING (direction, cdr_month))
    SELECT direction, cdr_month, f AS data_source, md AS max_date, n AS row_count, smd AS stored_max_date, sn AS stored_row_count, load FROM j
    QUALIFY row_number() OVER (PARTITION BY direction, cdr_month ORDER BY load DESC, md DESC, n DESC, f DESC) = 1""")
def freshness_gate(spark, sf):
    """New slices against a stored half: which of them replace it."""
    new = _cdr_slices(spark, sf)
    stored = new.where("l_suppkey % 2 = 0 AND cdr_month < DATE '1999-01-01'")
    return control.freshness_gate(new, stored, ["direction", "cdr_month"], "cdr_date", "cdr_month", "data_source")


@query("freshness_gate_per_file", """
    WITH c AS (SELECT l_returnflag AS direction, CAST(date_trunc('month', l_shipdate) AS DATE) AS cdr_month, CAST(l_shipdate AS DATE) AS d,
        concat('f', CASE WHEN day(l_shipdate) > 26 THEN '9' ELSE CAST(l_linenumber % 3 AS VARCHAR) END) AS f, l_suppkey FROM lineitem),
      w AS (SELECT direction, cdr_month, f, max(d) AS md, count(*) AS n FROM c GROUP BY 1, 2, 3),
      s AS (SELECT direction, cdr_month, max(d) AS md, count(*) AS n FROM c WHERE l_suppkey % 4 = 0 AND day(d) < 20 GROUP BY 1, 2),
      j AS (SELECT w.direction, w.cdr_month, f, w.md, w.n, s.md AS smd, s.n AS sn,
          w.md >= coalesce(s.md, w.cdr_month) AND w.n > coalesce(s.n, 0) AS load FROM w LEFT JOIN s USING (direction, cdr_month))
    SELECT direction, cdr_month, f AS data_source, md AS max_date, n AS row_count, smd AS stored_max_date, sn AS stored_row_count, load FROM j
    QUALIFY row_number() OVER (PARTITION BY direction, cdr_month ORDER BY load DESC, md DESC, n DESC, f DESC) = 1""")
def freshness_gate_per_file(spark, sf):
    """The latest file of a month holds its last days only and is often too small to replace what is stored; then the best of
    the earlier files that pass stands for the slice."""
    new = table(spark, sf, "lineitem").selectExpr(
        "l_returnflag AS direction", "trunc(l_shipdate, 'month') AS cdr_month", "CAST(l_shipdate AS DATE) AS cdr_date",
        "concat('f', IF(day(l_shipdate) > 26, 9, l_linenumber % 3)) AS data_source", "l_suppkey")
    stored = new.where("l_suppkey % 4 = 0 AND day(cdr_date) < 20")
    return control.freshness_gate(new, stored, ["direction", "cdr_month"], "cdr_date", "cdr_month", "data_source")
