import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F

from kpimill.functions import periods as P
from kpimill.operators import cube as C

D = dt.date
LOTS = """lot_id bigint, lot_placement_date date, lot_purchase_date date, subs_revocation_date date, sys_revocation_flag int,
 subs_flag int, traffic_type string, subs_id_seller bigint, subs_id_purchaser bigint, branch_id_seller int,
 branch_id_purchaser int, tp_id_seller bigint, tp_id_purchaser bigint, lot_volume double, lot_value double"""


@pytest.fixture(scope="module")
def lots(spark):
    data = [
        (1, D(2021, 1, 5), D(2021, 1, 6), None, None, 1, "gb", 10, 20, 1, 2, 1, 1, 1.0, 10.0),
        (2, D(2021, 1, 5), D(2021, 2, 2), None, None, 1, "gb", 10, 10, 1, 1, 1, 1, 2.0, 20.0),
        (3, D(2021, 1, 31), None, D(2021, 2, 1), None, 0, "gb", 11, None, 1, None, 2, None, 4.0, 40.0),
        (4, D(2021, 2, 1), None, None, 1, None, "min", 11, None, 1, None, 2, None, 8.0, 80.0),
        (5, D(2021, 2, 1), None, None, None, 1, "min", None, None, 1, None, 2, None, 16.0, 160.0),
        (6, D(2021, 2, 3), D(2021, 2, 4), None, 1, 1, "min", 12, 20, 3, 3, 2, 1, 32.0, 320.0),
    ]
    return spark.createDataFrame(data, LOTS)


def test_status_and_seller_type(lots):
    got = rows(lots.select("lot_id", C.lot_status().alias("s"), C.seller_type().alias("t")))
    assert got == [(1, "sold", "Subs"), (2, "sold", "Subs"), (3, "revoked", "Operator"), (4, "expired", "Operator"),
                   (5, "active", "Subs"), (6, "undefined", "Subs")]


def test_distinct_counts_are_per_grain(lots):
    w = [P.window("monthly", D(2021, 1, 1), D(2021, 2, 28))]
    coarse = C.lot_arms(lots, w, ["distinct_sellers"])
    got = {(r.report_date, r.traffic_type, r.branch_id_seller): r.sellers_count for r in coarse.collect()}
    assert got[(D(2021, 1, 1), "gb", 1)] == 2  # seller 10 twice, seller 11 once
    assert got[(D(2021, 2, 1), "min", 1)] == 1  # a NULL seller is not counted
    everyone = C.lot_arms(lots, w, ["distinct_all"])
    got = {(r.report_date, r.traffic_type, r.branch_id_seller): r.sellers_count for r in everyone.collect()}
    assert got[(D(2021, 2, 1), "gb", 1)] == 1 and got[(D(2021, 2, 1), "min", 3)] == 2


def test_purchase_outside_the_window_still_counts_by_placement(lots):
    w = [P.window("monthly", D(2021, 1, 1), D(2021, 1, 31))]
    placed = C.lot_arms(lots, w, ["purchasers"])
    assert sum(r.lot_count for r in placed.collect()) == 2
    bought = C.lot_arms(lots, w, ["purchasers"], with_status=False, purchasers_by="purchase")
    assert sum(r.lot_count for r in bought.collect()) == 1


def test_all_windows_in_one_pass_equal_single_windows(lots):
    windows = [P.window("daily", D(2021, 1, 1), D(2021, 2, 10)), P.window("weekly", D(2021, 1, 4), D(2021, 2, 8)),
               P.window("monthly", D(2021, 1, 1), D(2021, 2, 10))]
    arms = [a for a in C.ALL_ARMS if a != "base"]
    together = C.lot_arms(lots, windows, arms)
    one = [r for w in windows for a in arms for r in rows(C.lot_arms(lots, [w], [a]))]
    assert rows(together) == sorted(one, key=repr)


def test_base_is_the_last_day_only(spark):
    agg = spark.createDataFrame(
        [(D(2021, 1, 30), 1, 1, 1, 5), (D(2021, 1, 31), 1, 1, 1, 7), (D(2021, 1, 31), 1, 1, 2, 1), (D(2021, 1, 31), 1, 1, 3, 100)],
        "report_date date, branch_id int, tp_id bigint, calc_platform_id int, flash_active_count bigint")
    out = C.base_arm(agg, [P.window("monthly", D(2021, 1, 1), D(2021, 1, 31))]).collect()
    assert [(r.report_date, r.sellers_count) for r in out] == [(D(2021, 1, 1), 8)]


def test_cumulative_metrics_ignore_missing_ids(lots):
    got = dict(rows(C.cumulative_metrics(lots)))
    assert got == {"sellers_count": 2, "purchasers_count": 2, "traders_count": 3}
    assert dict(rows(C.cumulative_metrics(lots.where("false")))) == dict.fromkeys(got, 0)


def test_latest_version(spark):
    names = ["F1_2020_01", "F4_2020_01", "F2_2021_01", "F1_2021_01", "BU", None]
    df = spark.createDataFrame([(n,) for n in names], "param_1 string")
    assert rows(C.latest_version(df)) == [("BU",), ("F2_2021_01",), (None,)]
    assert C.latest_version(df.where("param_1 = 'BU'")).count() == 1


def test_windows():
    with pytest.raises(ValueError):
        P.window("weekly", D(2021, 1, 5), D(2021, 2, 1))
    with pytest.raises(ValueError):
        P.window("monthly", D(2021, 1, 2), D(2021, 2, 1))
    with pytest.raises(ValueError):
        P.window("yearly", D(2021, 1, 1), D(2021, 2, 1))
    assert P.window("monthly", D(2021, 1, 1), D(2021, 2, 1)).end == D(2021, 2, 28)
    assert P.window("weekly", D(2021, 1, 4), D(2021, 1, 11)).end == D(2021, 1, 17)


def test_spine_and_ranges(spark):
    assert rows(P.period_spine(spark, "monthly", D(2021, 1, 1), D(2021, 3, 15)), "period_start", "period_end") == [
        (D(2021, 1, 1), D(2021, 1, 31)), (D(2021, 2, 1), D(2021, 2, 28)), (D(2021, 3, 1), D(2021, 3, 31))]
    assert P.period_spine(spark, "daily", D(2021, 1, 2), D(2021, 1, 1)).count() == 0
    top = D(2021, 3, 17)
    ranges = P.refresh_ranges(spark.createDataFrame([(top,)], "d date"), "d", D(2019, 9, 1))
    got = {r.period: (r.from_date, r.till_date) for r in ranges.collect()}
    assert got == {w.kind: (w.start, w.end) for w in P.refresh_windows(top, D(2019, 9, 1))}
    assert got["weekly"] == (D(2020, 10, 26), D(2021, 3, 14)) and got["daily"] == (D(2021, 2, 15), top)


def test_calendar_functions(spark):
    df = spark.createDataFrame([("Q1'20",), ("4Q'20",), ("Q5'20",), ("x",), (None,)], "q string")
    got = rows(df.select("q", P.quarter_start("q").alias("s"), P.quarter_end(P.quarter_start("q")).alias("e")))
    assert got == sorted([("Q1'20", D(2020, 1, 1), D(2020, 3, 31)), ("4Q'20", D(2020, 10, 1), D(2020, 12, 31)),
                          ("Q5'20", None, None), ("x", None, None), (None, None, None)], key=repr)
    days = spark.createDataFrame([(44197,), (2,)], "n int")
    assert rows(days.select(P.excel_serial("n"))) == [(D(1900, 1, 1),), (D(2021, 1, 1),)]
    leap = spark.createDataFrame([(D(2020, 2, 29), 5.0)], "d date, v double")
    assert rows(P.shift_year(leap, "d", -1, "v")) == [(D(2019, 2, 28), 0.0)]
    assert rows(leap.select(P.make_month(F.lit(" 2021"), F.lit("3")))) == [(D(2021, 3, 1),)]


KINDS = [P.window("daily", D(2021, 1, 1), D(2021, 3, 31)), P.window("weekly", D(2021, 1, 4), D(2021, 3, 28)), P.window("monthly", D(2021, 1, 1), D(2021, 3, 31))]


@pytest.mark.parametrize("arms", [C.PRODUCTION_ARMS, C.ALL_ARMS])
def test_one_row_per_lot_and_party_is_exchanged(lots, arms):
    """The entries of arms and windows are made behind the first exchange, not carried through it."""
    plan = C.lot_arms(lots, KINDS, arms)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if " Exchange hashpartitioning(" in line]
    assert len(exchanges) == 2 and "spread" in exchanges[1] and "spread" not in exchanges[0]
    below = plan[plan.index(exchanges[1]):].split("(1) Scan")[0]
    entries = [line for line in below.splitlines() if "Generate explode(" in line]
    assert len(entries) == 1 and entries[0].count("named_struct(") == 2


def test_spread_groups_count_every_subscriber_once(spark):
    """More subscribers than spreads in one group, each with several lots on several days, and lots of nobody."""
    data = [(i, 1, i % 100 if i % 10 else None, D(2021, 1, 1 + i % 28), D(2021, 2, 1)) for i in range(1000)]
    df = spark.createDataFrame(data, "lot_id bigint, subs_flag int, id bigint, lot_placement_date date, lot_purchase_date date").selectExpr(
        "*", "id AS subs_id_seller", "id + 50 AS subs_id_purchaser", "CAST(NULL AS DATE) AS subs_revocation_date", "CAST(NULL AS INT) AS sys_revocation_flag",
        "'t' AS traffic_type", "1 AS branch_id_seller", "1 AS branch_id_purchaser", "1L AS tp_id_seller", "2L AS tp_id_purchaser", "1.0D AS lot_volume", "2.0D AS lot_value")
    out = C.lot_arms(df, [KINDS[2]], ["sellers", "purchasers", "distinct_sellers", "distinct_all"], with_status=False, purchasers_by="purchase")
    got = {(r.table_name, r.report_date.month): (r.sellers_count, r.purchasers_count, r.lot_count, r.lot_volume, r.tp_id_seller, r.tp_id_purchaser) for r in out.collect()}
    assert got == {
        ("sellers", 1): (90, None, 1000, 1000.0, 1, None), ("purchasers", 2): (None, 90, 1000, 1000.0, None, 2),
        ("distinct sellers by traffic type", 1): (90, None, 1000, 1000.0, None, None),
        ("distinct all subs", 1): (90, 90, None, None, None, None), ("distinct all subs", 2): (90, 90, None, None, None, None)}


def test_a_group_comes_in_few_parts(spark):
    """The second exchange gets a group in at most eight parts, however many tasks and subscribers there are."""
    df = spark.range(4000).selectExpr(
        "id AS lot_id", "1 AS subs_flag", "DATE '2021-01-05' AS lot_placement_date", "CAST(NULL AS DATE) AS lot_purchase_date",
        "CAST(NULL AS DATE) AS subs_revocation_date", "CAST(NULL AS INT) AS sys_revocation_flag", "'t' AS traffic_type", "id AS subs_id_seller",
        "id AS subs_id_purchaser", "1 AS branch_id_seller", "1 AS branch_id_purchaser", "1L AS tp_id_seller", "1L AS tp_id_purchaser", "1.0D AS lot_volume",
        "1.0D AS lot_value")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        out = C.lot_arms(df, [KINDS[2]], ["sellers"])
        assert [r.sellers_count for r in out.collect()] == [4000]
        shares = C._party_rows(df, [KINDS[2]], [("sellers", "seller")], True, "placement").selectExpr(
            f"pmod(xxhash64(subs_id), {C.SPREAD}) AS s").distinct().count()
        assert shares <= 8
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
