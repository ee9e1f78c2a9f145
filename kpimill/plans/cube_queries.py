"""Queries over the marketplace cube."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from kpimill.functions import periods as P
from kpimill.operators import cube as C
from kpimill.operators import daily_counts
from kpimill.plans.registry import query
from kpimill.session import materialize, scratch_path
from kpimill.sinks import versions
from kpimill.sources import analog as A
from kpimill.sources.analog import with_views

FROM, TILL = dt.date(1995, 1, 1), dt.date(2001, 12, 31)
WEEK_FROM = dt.date(1994, 12, 26)
AS_OF = dt.date(2001, 12, 31)

_TRUNC = {
    "daily": "{c}",
    "weekly": "CAST(date_trunc('week', {c}) AS DATE)",
    "monthly": "CAST(date_trunc('month', {c}) AS DATE)",
}
_STATUS = """CASE WHEN lot_purchase_date IS NOT NULL AND sys_revocation_flag IS NULL THEN 'sold'
  WHEN subs_revocation_date IS NOT NULL AND sys_revocation_flag IS NULL THEN 'revoked'
  WHEN subs_revocation_date IS NULL AND sys_revocation_flag IS NOT NULL AND lot_purchase_date IS NULL THEN 'expired'
  WHEN subs_revocation_date IS NULL AND sys_revocation_flag IS NULL AND lot_purchase_date IS NULL THEN 'active'
  ELSE 'undefined' END"""
_SELLER = "CASE subs_flag WHEN 1 THEN 'Subs' ELSE 'Operator' END"
_START = {"daily": FROM, "weekly": WEEK_FROM, "monthly": FROM}


def _trunc(kind: str, c: str) -> str:
    return _TRUNC[kind].format(c=c)


def arm_sql(arm: str, kind: str, with_status: bool = True, purchasers_by: str = "placement") -> str:
    """One arm in SQL, in the 18-column layout without the insert date."""
    null = lambda t: f"CAST(NULL AS {t})"
    placed, bought = "lot_placement_date", "lot_purchase_date"
    date = {"sellers": placed, "revoked": "subs_revocation_date", "distinct_sellers": placed,
            "distinct_purchasers": bought, "purchasers": bought if purchasers_by == "purchase" else placed}.get(arm)
    pdate = _trunc(kind, bought) if with_status else null("DATE")
    status = _STATUS if with_status else null("VARCHAR")
    sums = "count(lot_id) AS lot_count, round(sum(lot_volume), 2) AS lot_volume, round(sum(lot_value), 2) AS sold_value"
    no_int = null("BIGINT")
    head = f"'{kind}' AS period, '{C.TABLE_NAMES[arm]}' AS table_name"
    where = f"{date} BETWEEN DATE '{_START[kind]}' AND DATE '{TILL}'"
    if kind == "weekly":
        where = f"{date} BETWEEN DATE '{WEEK_FROM}' AND DATE '2002-01-06'"

    def shape(rd, pd, st, tr, bs, bp, ts, tp, stat, sc, pc, rest, src, cond):
        return (
            f"SELECT {head}, {rd} AS report_date, {pd} AS purchase_date, {null('DATE')} AS revocation_date, "
            f"{st} AS seller_type, {tr} AS traffic_type, {bs} AS branch_id_seller, {bp} AS branch_id_purchaser, "
            f"{ts} AS tp_id_seller, {tp} AS tp_id_purchaser, {stat} AS status, {sc} AS sellers_count, "
            f"{pc} AS purchasers_count, {rest} FROM {src} WHERE {cond} GROUP BY ALL"
        )

    ni, nv = null("INTEGER"), null("VARCHAR")
    if arm == "sellers":
        return shape(_trunc(kind, date), pdate, _SELLER, "traffic_type", "branch_id_seller", ni, "tp_id_seller", no_int,
                     status, "count(DISTINCT subs_id_seller)", no_int, sums, "lots", where)
    if arm == "purchasers":
        st = "'Subs'" if purchasers_by == "purchase" else _SELLER
        return shape(_trunc(kind, date), pdate, st, "traffic_type", ni, "branch_id_purchaser", no_int, "tp_id_purchaser",
                     status, no_int, "count(DISTINCT subs_id_purchaser)", sums, "lots",
                     f"{where} AND {bought} IS NOT NULL")
    if arm == "revoked":
        return shape(_trunc(kind, date), null("DATE"), _SELLER, "traffic_type", "branch_id_seller", ni, "tp_id_seller",
                     no_int, nv, no_int, no_int, sums, "lots", where)
    if arm == "distinct_sellers":
        return shape(_trunc(kind, date), null("DATE"), nv, "traffic_type", "branch_id_seller", ni, no_int, no_int, nv,
                     "count(DISTINCT subs_id_seller)", no_int, sums, "lots", where)
    if arm == "distinct_purchasers":
        return shape(_trunc(kind, date), null("DATE"), nv, "traffic_type", ni, "branch_id_purchaser", no_int, no_int, nv,
                     no_int, "count(DISTINCT subs_id_purchaser)", sums, "lots", where)
    if arm == "distinct_all":
        span = lambda c: (f"{c} BETWEEN DATE '{_START[kind]}' AND "
                          f"DATE '{'2002-01-06' if kind == 'weekly' else TILL}'")
        src = (f"(SELECT {_trunc(kind, placed)} AS rd, traffic_type, branch_id_seller AS br, subs_id_seller AS id "
               f"FROM lots WHERE {span(placed)} UNION SELECT {_trunc(kind, bought)}, traffic_type, "
               f"branch_id_purchaser, subs_id_purchaser FROM lots WHERE {span(bought)}) d")
        empty = f"{no_int} AS lot_count, {null('DOUBLE')} AS lot_volume, {null('DOUBLE')} AS sold_value"
        return shape("rd", null("DATE"), nv, "traffic_type", "br", "br", no_int, no_int, nv, "count(DISTINCT id)",
                     "count(DISTINCT id)", empty, src, "TRUE")
    end = {"daily": "TRUE", "weekly": "isodow(report_date) = 7", "monthly": "report_date = last_day(report_date)"}[kind]
    active = "CAST(sum(flash_active_count) AS BIGINT)"
    empty = f"{no_int} AS lot_count, {null('DOUBLE')} AS lot_volume, {null('DOUBLE')} AS sold_value"
    return shape(_trunc(kind, "b.report_date"), null("DATE"), "'Subs'", nv, "branch_id", "branch_id", "tp_id", "tp_id", nv,
                 active, active, empty, "base_daily b", f"calc_platform_id IN (-1, 1, 2) AND {end}")


def _rounded(df):
    return df.withColumn("lot_volume", F.round("lot_volume", 2)).withColumn("sold_value", F.round("sold_value", 2))


def _window(kind):
    return P.window(kind, _START[kind], TILL)


def _arm_query(arm, kind, **options):
    return lambda spark, sf: _rounded(C.lot_arms(A.lots(spark, sf), [_window(kind)], [arm], **options))


for _name, _arm, _kind, _opts in [
    ("cube_sellers", "sellers", "monthly", {}),
    ("cube_sellers_weekly", "sellers", "weekly", {}),
    ("cube_sellers_no_status", "sellers", "monthly", {"with_status": False}),
    ("cube_purchasers", "purchasers", "monthly", {}),
    ("cube_purchasers_by_purchase", "purchasers", "monthly", {"with_status": False, "purchasers_by": "purchase"}),
    ("cube_revoked", "revoked", "monthly", {}),
    ("cube_distinct_sellers", "distinct_sellers", "monthly", {}),
    ("cube_distinct_purchasers", "distinct_purchasers", "monthly", {}),
    ("cube_distinct_all", "distinct_all", "monthly", {}),
]:
    query(_name, with_views("lots", arm_sql(_arm, _kind, **_opts)))(_arm_query(_arm, _kind, **_opts))


_CHANGED = [dt.date(1997, 3, d) for d in (3, 4, 31)] + [dt.date(1997, 4, 1)]


@query("cube_distinct_refreshed", with_views("lots", " UNION ALL ".join(
    f"({arm_sql(a, k)})" for a in daily_counts.DISTINCT_ARMS for k in ("weekly", "monthly"))))
def cube_distinct_refreshed(spark, sf):
    """Distinct counts of weeks and months from daily bitmaps. A few days were loaded with wrong sellers and volumes; only
    they are made again, and all periods over them are right."""
    needed = ["lot_id", "lot_volume", "lot_value", "traffic_type"] + [
        f"{c}_{role}" for c in ("subs_id", "branch_id") for role in ("seller", "purchaser")]
    # read for the first load, for the wrong days and for the refresh
    lots = materialize(A.lots(spark, sf).select("lot_placement_date", "lot_purchase_date", *needed), "lots")
    changed = F.col("lot_placement_date").cast("date").isin(_CHANGED)
    wrong = lots.withColumns({"subs_id_seller": F.expr("subs_id_seller + 100000"), "traffic_type": F.lit("wrong")}).where(changed)
    days = daily_counts.days_sql(_CHANGED)
    first = daily_counts.daily_bitmaps(lots, f"NOT ({days})").unionByName(daily_counts.daily_bitmaps(wrong, days))
    table_ = versions.open_table(spark, scratch_path(spark, "daily-bitmaps"), daily_counts.DAILY_SCHEMA, daily_counts.PARTITION_BY)
    table_.replace(F.lit(True), first)
    daily_counts.refresh_days(table_, lots, _CHANGED)
    return _rounded(daily_counts.distinct_counts(table_.read(), [_window(k) for k in ("weekly", "monthly")]))


@query("cube_base", with_views("base_daily", arm_sql("base", "monthly")))
def cube_base(spark, sf):
    return C.base_arm(A.base_daily(spark, sf), [_window("monthly")])


def _union_sql(kinds, arms, **opts):
    body = " UNION ALL ".join(arm_sql(a, k, **opts) for k in kinds for a in arms)
    # daily and weekly base arms end with the span of the windows
    return with_views("lots base_daily", f"SELECT *, DATE '{AS_OF}' AS insert_date FROM ({body})")


def _cube(spark, sf, kinds, arms, **opts):
    cube = C.period_cube(A.lots(spark, sf), A.base_daily(spark, sf), [_window(k) for k in kinds], arms, AS_OF, **opts)
    return _rounded(cube)


@query("period_cube", _union_sql(["monthly"], C.PRODUCTION_ARMS))
def period_cube(spark, sf):
    return _cube(spark, sf, ["monthly"], C.PRODUCTION_ARMS)


_VARIANT = {"with_status": False, "purchasers_by": "purchase"}


@query("period_cube_all_arms", _union_sql(["monthly"], C.ALL_ARMS, **_VARIANT))
def period_cube_all_arms(spark, sf):
    return _cube(spark, sf, ["monthly"], C.ALL_ARMS, **_VARIANT)


@query("period_cube_daily", _union_sql(["daily"], C.PRODUCTION_ARMS))
def period_cube_daily(spark, sf):
    return _cube(spark, sf, ["daily"], C.PRODUCTION_ARMS)


@query("period_cube_three_kinds", _union_sql(["daily", "weekly", "monthly"], C.PRODUCTION_ARMS))
def period_cube_three_kinds(spark, sf):
    """All three period kinds from one scan of the lots."""
    return _cube(spark, sf, ["daily", "weekly", "monthly"], C.PRODUCTION_ARMS)


@query(
    "cumulative_metrics",
    with_views("lots", """
    SELECT 'sellers_count' AS metric, count(DISTINCT subs_id_seller) AS metric_value FROM lots WHERE subs_flag = 1
    UNION ALL SELECT 'purchasers_count', count(DISTINCT subs_id_purchaser) FROM lots WHERE subs_flag = 1
    UNION ALL SELECT 'traders_count', count(DISTINCT id) FROM (SELECT subs_id_seller AS id FROM lots WHERE subs_flag = 1
      UNION ALL SELECT subs_id_purchaser FROM lots WHERE subs_flag = 1)"""),
)
def cumulative_metrics(spark, sf):
    return C.cumulative_metrics(A.lots(spark, sf))


def _who_sql(since):
    return with_views("lots", f"""
    SELECT 'seller' AS who, branch_id_seller AS branch_id, lot_placement_date AS report_date, traffic_type,
      round(sum(lot_volume), 2) AS lot_volume FROM lots WHERE lot_placement_date >= DATE '{since}' GROUP BY ALL
    UNION ALL
    SELECT 'purchaser', branch_id_purchaser, lot_purchase_date, traffic_type, round(sum(lot_volume), 2)
      FROM lots WHERE lot_purchase_date >= DATE '{since}' GROUP BY ALL""")


@query("who_volume", _who_sql(FROM))
def who_volume(spark, sf):
    df = C.who_volume(A.lots(spark, sf), FROM)
    return df.withColumn("lot_volume", F.round("lot_volume", 2))


@query("who_volume_recent", _who_sql(AS_OF - dt.timedelta(days=200)))
def who_volume_recent(spark, sf):
    """Look-back form: the window is counted from an explicit as-of date."""
    df = C.who_volume(A.lots(spark, sf), AS_OF - dt.timedelta(days=200))
    return df.withColumn("lot_volume", F.round("lot_volume", 2))


@query(
    "bundle_subs",
    with_views("base_daily price_plan", f"""
    SELECT b.report_date, b.branch_id, CAST(sum(b.flash_active_count) AS BIGINT) AS subs_count
    FROM base_daily b JOIN price_plan p ON b.tp_id = p.tp_id
    WHERE calc_platform_id IN (-1, 1, 2) AND p.bundle_flag = 1 AND b.report_date >= DATE '{FROM}' GROUP BY 1, 2"""),
)
def bundle_subs(spark, sf):
    return C.bundle_subs(A.base_daily(spark, sf), A.price_plan(spark, sf), FROM)


@query(
    "latest_version",
    with_views("plan_monthly", """
    SELECT report_date, param_1, param_2, branch_id, param_value FROM plan_monthly
    WHERE NOT (param_1 LIKE 'F%') OR param_1 = (SELECT max_by(param_1, concat(split_part(param_1, '_', 2), '|',
      split_part(param_1, '_', 1))) FROM plan_monthly WHERE param_1 LIKE 'F%')"""),
)
def latest_version(spark, sf):
    return C.latest_version(A.plan_monthly(spark, sf))


@query("lot_status", with_views("lots", f"SELECT {_STATUS} AS status, count(*) AS n FROM lots GROUP BY 1"))
def lot_status(spark, sf):
    return A.lots(spark, sf).groupBy(C.lot_status().alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("seller_type", with_views("lots", f"""
    SELECT {_SELLER} AS seller_type, traffic_type, count(*) AS n FROM lots GROUP BY 1, 2"""))
def seller_type(spark, sf):
    return A.lots(spark, sf).groupBy(C.seller_type().alias("seller_type"), "traffic_type").agg(
        F.count(F.lit(1)).alias("n"))


def _spine_values(kind):
    step = {"daily": "1 DAY", "weekly": "7 DAY", "monthly": "1 MONTH"}[kind]
    end = {"daily": "d", "weekly": "d + 6", "monthly": "last_day(d)"}[kind]
    return (f"SELECT '{kind}' AS period, d AS period_start, {end} AS period_end FROM (SELECT CAST(unnest(generate_series("
            f"lo, hi, INTERVAL {step})) AS DATE) AS d FROM (SELECT CAST({{lo_{kind}}} AS DATE) AS lo, hi FROM b))")


_SPINE_SQL = (
    "WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo0, CAST(max(o_orderdate) AS DATE) AS hi FROM orders), "
    "s AS (" + " UNION ALL ".join(_spine_values(k) for k in P.KINDS).format(
        lo_daily="lo0", lo_weekly="date_trunc('week', lo0)", lo_monthly="date_trunc('month', lo0)") + ") "
    "SELECT period, period_start, period_end, count(o_orderkey) AS orders FROM s JOIN orders "
    "ON CAST(o_orderdate AS DATE) BETWEEN period_start AND period_end GROUP BY 1, 2, 3"
)


@query("period_spine", _SPINE_SQL)
def period_spine(spark, sf):
    """Orders per period of the spine over the data's own date range; joined on the period start."""
    orders = A.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    low, high = orders.agg(F.min("d"), F.max("d")).first()
    starts = {"daily": low, "weekly": low - dt.timedelta(days=low.weekday()), "monthly": low.replace(day=1)}
    per_day = orders.groupBy("d").agg(F.count(F.lit(1)).alias("n"))
    parts = []
    for kind in P.KINDS:
        counts = per_day.groupBy(P.trunc_period("d", kind).alias("period_start")).agg(F.sum("n").alias("orders"))
        parts.append(P.period_spine(spark, kind, starts[kind], high).join(counts, "period_start"))
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.select("period", "period_start", "period_end", "orders")


@query("load_status", """
    SELECT 'sales' AS database_name, 'orders' AS table_name, CAST(max(o_orderdate) AS DATE) AS max_report_date
    FROM orders""")
def load_status(spark, sf):
    return _load_status(spark, sf).where(
        (F.lower("database_name") == "sales") & (F.lower("table_name") == "orders")
    ).select(F.lower("database_name").alias("database_name"), F.lower("table_name").alias("table_name"),
             "max_report_date")


def _load_status(spark, sf):
    """Load status of two tables, written in mixed case as the control table does."""
    parts = [
        A.table(spark, sf, t).agg(F.max(c).cast("date").alias("max_report_date")).select(
            F.lit("Sales").alias("database_name"), F.lit(t.title()).alias("table_name"), "max_report_date")
        for t, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"))
    ]
    return parts[0].unionByName(parts[1])


@query("refresh_ranges", """
    WITH m AS (SELECT CAST(max(o_orderdate) AS DATE) AS d FROM orders)
    SELECT 'daily' AS period, d - 30 AS from_date, d AS till_date FROM m UNION ALL
    SELECT 'weekly', CAST(date_trunc('week', d - 140) AS DATE), CAST(date_trunc('week', d) AS DATE) - 1 FROM m UNION ALL
    SELECT 'monthly', DATE '1995-01-01', CAST(date_trunc('month', d) AS DATE) - 1 FROM m""")
def refresh_ranges(spark, sf):
    status = _load_status(spark, sf).where(F.lower("table_name") == "orders")
    return P.refresh_ranges(status, "max_report_date", FROM)


@query("period_trunc", """
    SELECT CAST(o_orderdate AS DATE) AS day, CAST(date_trunc('week', o_orderdate) AS DATE) AS week,
      CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n FROM orders GROUP BY 1, 2, 3""")
def period_trunc(spark, sf):
    d = "o_orderdate"
    return A.table(spark, sf, "orders").groupBy(
        P.trunc_period(d, "daily").alias("day"), P.trunc_period(d, "weekly").alias("week"),
        P.trunc_period(d, "monthly").alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query("month_facts", """
    SELECT o_orderkey, last_day(o_orderdate) AS month_end, CAST(day(last_day(o_orderdate)) AS INTEGER) AS month_days,
      CAST(year(o_orderdate) AS INTEGER) AS year FROM orders""")
def month_facts(spark, sf):
    end = P.period_end("o_orderdate", "monthly")
    return A.table(spark, sf, "orders").select(
        "o_orderkey", end.alias("month_end"), F.day(end).alias("month_days"), F.year("o_orderdate").alias("year"))
