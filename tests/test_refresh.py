"""Daily bitmaps and merged statistics: a refreshed part equals a full rebuild."""

import datetime as dt

from helpers import rows
from pyspark.sql import functions as F

from kpimill.functions.periods import window
from kpimill.operators import cube, daily_counts
from kpimill.sinks import statistics, versions

D = dt.date
LOT = (
    "lot_id bigint, subs_id_seller bigint, subs_id_purchaser bigint, branch_id_seller int, branch_id_purchaser int, traffic_type string, "
    "lot_placement_date date, lot_purchase_date date, lot_volume double, lot_value double"
)


def lots(spark):
    data = [(i, i % 7 if i % 11 else None, 40_000 + i % 5, i % 3, i % 2, "ab"[i % 2], D(2021, 1 + i % 3, 1 + i % 28), D(2021, 2, 1 + i % 20) if i % 4 else None, 1.0, float(i))
            for i in range(400)]
    return spark.createDataFrame(data, LOT)


def test_bitmaps_give_the_cube(spark, tmp_path):
    df = lots(spark)
    windows = [window("daily", D(2021, 1, 1), D(2021, 3, 31)), window("weekly", D(2021, 1, 4), D(2021, 3, 28)), window("monthly", D(2021, 1, 1), D(2021, 3, 31))]
    status = {"subs_flag": F.lit(1), "sys_revocation_flag": F.lit(None).cast("int"), "subs_revocation_date": F.lit(None).cast("date"),
              "tp_id_seller": F.lit(1), "tp_id_purchaser": F.lit(1)}
    want = cube.lot_arms(df.withColumns(status), windows, daily_counts.DISTINCT_ARMS)
    table = versions.open_table(spark, str(tmp_path / "days"), daily_counts.DAILY_SCHEMA, daily_counts.PARTITION_BY)
    days = [D(2021, 2, 3), D(2021, 2, 4)]
    # two days are loaded wrongly, and one that is in no lot at all
    wrong = df.withColumns({"subs_id_seller": F.lit(99), "subs_id_purchaser": F.lit(98)})
    text = daily_counts.days_sql(days)
    table.replace(F.lit(True), daily_counts.daily_bitmaps(df, f"NOT ({text})").unionByName(daily_counts.daily_bitmaps(wrong, text)))
    before = {tuple(e["values"]): e["folder"] for e in table.manifest()["files"]}
    assert rows(daily_counts.distinct_counts(table.read(), windows)) != rows(want)
    daily_counts.refresh_days(table, df, days + [D(2020, 1, 1)])
    after = {tuple(e["values"]): e["folder"] for e in table.manifest()["files"]}
    assert {k for k in after if after[k] != before.get(k)} == {("2021-02-01",)}
    columns = want.columns
    assert rows(daily_counts.distinct_counts(table.read(), windows), *columns) == rows(want, *columns)
    full = daily_counts.daily_bitmaps(df)
    assert rows(table.read().withColumn("bitmap", F.hex("bitmap"))) == rows(full.withColumn("bitmap", F.hex("bitmap")))


def test_statistics_of_changed_partitions(spark, tmp_path):
    make = lambda p, n, shift: [(p, i + shift, None if i % 10 == 0 else f"t{i % 50:02d}", D(2021, 1, 1 + i % 28)) for i in range(n)]
    schema = "p string, v int, s string, d date"
    old = spark.createDataFrame(make("a", 1000, 0) + make("b", 500, 5000) + make(None, 100, -100), schema)
    path = str(tmp_path / "stats")
    statistics.update_statistics(spark, path, old, ["p"])
    new = spark.createDataFrame(make("a", 200, 0) + make("c", 300, 9000), schema)
    now = old.where("p IS NULL OR p = 'x'").unionByName(new)  # b is gone, a is smaller, c is new
    store = statistics.update_statistics(spark, path, now, ["p"], F.col("p").isin("a", "b", "c"))
    got = {r["column_name"]: r for r in statistics.table_statistics(store).collect()}
    full = statistics.merged(statistics.column_profiles(now, statistics.partition_key(["p"])))
    plain = lambda r: {k: v for k, v in r.asDict().items() if k not in ("quantiles", "distinct_count")}  # estimates
    assert {c: plain(r) for c, r in got.items()} == {r["column_name"]: plain(r) for r in full.collect()}
    assert (got["v"]["row_count"], got["v"]["null_count"], got["v"]["low"], got["v"]["high"]) == (600, 0, -100.0, 9299.0)
    assert (got["s"]["null_count"], got["s"]["low_text"], got["s"]["high_text"], got["p"]["null_count"]) == (60, "t01", "t49", 100)
    assert abs(got["v"]["distinct_count"] - 600) <= 600 * 3 * statistics.DISTINCT_ERROR and got["s"]["distinct_count"] == 45
    values = sorted(r.v for r in now.collect())
    for share, q in zip(statistics.QUANTILES, got["v"]["quantiles"]):
        assert abs(sum(v < q for v in values) / len(values) - share) <= statistics.RANK_ERROR
    assert got["d"]["quantiles"] is None and got["d"]["high_text"] == "2021-01-28"


def test_bitmaps_are_made_behind_one_exchange(spark):
    """Ids are exchanged, not bitmaps; both roles together are a union of the others, of which nothing is stored."""
    daily = daily_counts.daily_bitmaps(lots(spark))
    plan = daily._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "bitmap_construct_agg" not in plan[plan.index("Exchange "):].split("Arguments")[0]
    assert {r.arm for r in daily.select("arm").distinct().collect()} == {"distinct_sellers", "distinct_purchasers"}
    windows = [window("monthly", D(2021, 1, 1), D(2021, 3, 31))]
    alone = daily_counts.distinct_counts(daily_counts.daily_bitmaps(lots(spark), arms=["distinct_all"]), windows, ["distinct_all"])
    assert rows(alone, "report_date", "traffic_type", "branch_id_seller", "sellers_count") == rows(
        daily_counts.distinct_counts(daily, windows).where("table_name = 'distinct all subs'"), "report_date", "traffic_type", "branch_id_seller", "sellers_count")
