import datetime as dt
import random

import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from kpimill.functions import text as X
from kpimill.operators import coltypes, control, diff, lookup, project, reshape

D = dt.date


def test_daily_values_add_up(spark):
    data = [(D(2021, 1 + i % 12, 1), "BU" if i % 3 else "AC", "x", 1.5 * i) for i in range(36)]
    df = spark.createDataFrame(data + [(D(2021, 2, 1), None, "x", 1.0)], "d date, v string, a string, p double")
    out = reshape.allocate_daily(df, "d", "p", "v = 'AC' OR (v <> 'AC' AND a = 'keep')")
    assert out.columns == df.columns
    total = out.groupBy("v").agg(F.round(F.sum("p"), 6)).collect()
    want = df.where("v is not null").groupBy("v").agg(F.round(F.sum("p"), 6)).collect()
    assert sorted(map(tuple, total)) == sorted(map(tuple, want))
    assert out.where("v = 'BU' AND d BETWEEN '2021-02-01' AND '2021-02-28'").count() == 28 * 3  # rows 1, 13 and 25


def test_pivot_and_melt_are_inverse(spark):
    data = [(k, c, float(i)) for i, (k, c) in enumerate((k, c) for k in "xyz" for c in "abc")]
    df = spark.createDataFrame(data, "k string, c string, v double")
    assert rows(reshape.melt(reshape.pivot_sum(df, ["k"], "c", "v", list("abc")), ["k"], None, "c", "v")) == sorted(data)


def test_headers():
    assert reshape.last_duplicate_columns(["r", "A", "B", "A", "B", "C", "A"]) == {4: "B", 6: "A"}
    assert reshape.columns_with_marker(["r", "c", "A план", "A факт"], "план", 2) == ["r", "c", "A план"]


def test_replicate_without_months_gives_nothing(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    months = spark.createDataFrame([(D(2021, 1, 1),), (D(2021, 2, 1),), (D(2021, 1, 1),), (None,)], "m date")
    assert reshape.replicate(df, months, "m").count() == 4
    assert reshape.replicate(df, months.where("false"), "m").count() == 0


def test_replicate_takes_calendars_only(spark, monkeypatch):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    with pytest.raises(ValueError, match="not a calendar"):
        reshape.replicate(df, spark.createDataFrame([("x",)], "m string"), "m")
    monkeypatch.setattr(reshape, "CALENDAR_KEYS", 2)
    with pytest.raises(Exception, match="not a calendar"):
        reshape.replicate(df, spark.range(5).withColumnRenamed("id", "m"), "m").collect()


def _brute(key, codes, min_len=2):
    for n in range(len(key), min_len - 1, -1):
        if key[:n] in codes:
            return codes[key[:n]]
    return None


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10_000))
def test_longest_prefix(spark, seed):
    rnd = random.Random(seed)
    word = lambda lo, hi: "".join(rnd.choice("123") for _ in range(rnd.randint(lo, hi)))
    lists = [(", ".join({word(1, 5) for _ in range(3)}), f"d{i}") for i in range(12)]
    codes = {}
    for text, dest in lists:
        for c in text.split(", "):
            if len(c) >= 2:
                codes[c] = min(dest, codes.get(c, dest))
    hot = word(3, 7)  # one key holds a third of the rows
    keys = [word(0, 7) for _ in range(60)] + [hot] * 30 + [None]
    df = spark.createDataFrame(list(enumerate(keys)), "id int, k string").repartition(4)
    dictionary = spark.createDataFrame(lists, "codes string, dest string")
    want = sorted((i, k, _brute(k, codes) if k else None) for i, k in enumerate(keys) if True)
    found = lookup.longest_prefix(df, "k", dictionary, "codes", "dest", "hit")
    assert sorted(map(tuple, found.select("id", "k", "hit").collect()), key=lambda r: r[0]) == sorted(want, key=lambda r: r[0])


def test_no_prefix_join_is_forced(spark):
    df = spark.range(1000).selectExpr("CAST(id AS STRING) AS k")
    dictionary = spark.createDataFrame([("12, 345", "a")], "codes string, dest string")
    found = lookup.longest_prefix(df, "k", dictionary, "codes", "dest", "o")
    assert "hint" not in found._jdf.queryExecution().analyzed().toString().lower()
    assert found.where("o IS NOT NULL").count() == 12


def test_table_diff(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x"), (3, "y")], "k int, v string")
    b = spark.createDataFrame([(1, None), (2, "z"), (3, "y"), (3, "y")], "k int, v string")
    assert diff.table_diff(a, a, None).count() == 0
    assert rows(diff.table_diff(a, b), "k", "v", "right_rows") == [(2, "z", 1)]
    assert rows(diff.table_diff(a, b, None), "k", "side") == [(2, "left_only"), (2, "right_only")]
    assert rows(diff.table_diff(a, b, "both"), "k", "left_rows", "right_rows") == [(1, 2, 1), (3, 1, 2)]


def test_repeat_rows(spark):
    df = spark.createDataFrame([("a", 7), ("b", 0), ("c", 3), ("d", 4)], "k string, n bigint")
    got = diff.repeat_rows(df, "n", chunk=3).groupBy("k").count()
    assert rows(got) == [("a", 7), ("c", 3), ("d", 4)]


def test_delta_keys_match_null(spark):
    new = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3), ("b", 4)], "k string, v int")
    old = spark.createDataFrame([(None,), ("a",), ("a",)], "k string")
    assert rows(diff.delta_keys(new, old, ["k"])) == [("b", 3), ("b", 4)]
    assert rows(diff.fresh_keys(new, old, ["k"])) == [("b",)]


def test_lookups(spark):
    dim = spark.createDataFrame([(5, "A"), (3, "A"), (1, "B"), (2, "C")], "id int, name string")
    names = spark.createDataFrame([("A",), ("A",), ("Z",)], "tariff string")
    assert rows(lookup.other_bucket(dim, names, "name", "id"), "name", "id") == [("A", 3), ("Other", 1)]
    assert rows(lookup.representative_key(dim, ["name"], "id"), "name", "id") == [("A", 3), ("B", 1), ("C", 2)]
    assert rows(lookup.unmatched(names, dim, {"tariff": "name"})) == [("Z", 1)]
    assert rows(lookup.membership(names, dim, ("tariff", "name"))) == [("Z",)]
    known = dim.dropDuplicates(["name"]).withColumnRenamed("name", "tariff")
    assert lookup.map_dim(names, known, {"tariff": "tariff"}, "left").columns == ["tariff", "id"]


def test_empty_lookup_values(spark):
    df = spark.createDataFrame([("x", True), ("", True), (None, True), (None, False), ("", False)], "c string, m boolean")
    assert rows(df.select(X.or_unknown("c", "m"))) == sorted(
        [("x",), ("Unknown",), ("Unknown",), (None,), ("",)], key=repr)


def test_synonyms_do_not_collide(spark):
    df = spark.createDataFrame([("a", None, 1), (None, "b", 2)], "DIRECTION string, Traffic string, n int")
    out = project.rename_synonyms(df, {"Traffic": "DIRECTION"})
    assert out.columns == ["DIRECTION", "n"] and rows(out) == [("a", 1), ("b", 2)]


def test_not_a_number_is_missing(spark):
    df = spark.createDataFrame([("nan", float("nan")), ("1", 1.0)], "t string, v double")
    assert rows(project.conform(df, "v double")) == [(1.0,), (None,)]
    assert rows(df.select(X.to_number("t"))) == [(1.0,), (None,)]
    assert rows(coltypes.coerce(df, {"t": "F"}).select("t")) == [(1.0,), (None,)]


def test_layouts(spark):
    df = spark.createDataFrame([(1, "x")], "b int, a string")
    out = project.conform(df, "a string, c double, b bigint", {"c": 2.5})
    assert rows(out) == [("x", 2.5, 1)] and dict(out.dtypes)["b"] == "bigint"
    assert project.default_mapping(["p", "q", "r"], ["b"], {"q": "a"}) == {"p": "b", "q": "a", "r": None}
    with pytest.raises(ValueError):
        project.positional_rename(df, ["only"])


TYPES = {
    "day": (["01.02.2021", None, "3.4.2021"], "DATE"),
    "MSISDN 1": (["79001234567"] * 3, "VARCHAR(11)"),
    "small": (["1", "2", None], "INTEGER"),
    "big": (["3000000000", "1", "2"], "BIGINT"),
    "subs_id": (["1", "2", "3"], "DECIMAL(12,0)"),
    "part": (["1.5", "2", "3"], "FLOAT"),
    "t5": (["abcde"] * 3, "VARCHAR(11)"),
    "t50": (["a" * 50] * 3, "VARCHAR(100)"),
    "t300": (["a" * 300] * 3, "VARCHAR(500)"),
    "t3000": (["a" * 3000] * 3, "VARCHAR(5000)"),
    "t6000": (["a" * 6000] * 3, "LONG VARCHAR"),
    "void": ([None] * 3, "INTEGER"),
    "mixed": (["01.02.2021", "2021-02-01", "1"], "VARCHAR(11)"),
    "Имя поля": (["x"] * 3, "VARCHAR(11)"),
}


def test_infer_types(spark):
    schema = ", ".join(f"`{c}` string" for c in TYPES)
    feed = spark.createDataFrame([tuple(v[0][i] for v in TYPES.values()) for i in range(3)], schema)
    got = {r["column"]: (r["column_name"], r["dtype"]) for r in coltypes.infer_types(feed).collect()}
    assert {c: t for c, (_, t) in got.items()} == {c: v[1] for c, v in TYPES.items()}
    assert got["Имя поля"][0] == "IMJA_POLJA" and got["MSISDN 1"][0] == "MSISDN_1"


def test_dates_per_file(spark):
    data = [("iso", "31.12.2020"), ("iso", "1.1.2021"), ("short", "1.2.21"), ("short", "05.06.99"), ("slash", "3/4/2021"),
            ("time", "12/31/2020 10:00:00"), ("mixed", "1.1.2021"), ("mixed", "1/1/2021"), ("gap", None), ("gap", "1.1.2021")]
    df = spark.createDataFrame(data, "f string, t string")
    out = coltypes.parse_dates(df, "t", ("d.M.yyyy", "d.M.yy", "d/M/yyyy", "M/d/yyyy H:m:s"), ["f"], "d", "m")
    assert rows(out, "f", "t", "d") == sorted([
        ("iso", "31.12.2020", D(2020, 12, 31)), ("iso", "1.1.2021", D(2021, 1, 1)), ("short", "1.2.21", D(2021, 2, 1)),
        ("short", "05.06.99", D(1999, 6, 5)), ("slash", "3/4/2021", D(2021, 4, 3)), ("time", "12/31/2020 10:00:00", D(2020, 12, 31)),
        ("mixed", "1.1.2021", None), ("mixed", "1/1/2021", None), ("gap", None, None), ("gap", "1.1.2021", D(2021, 1, 1))], key=repr)
    assert rows(out.select("f", "m").distinct().where("f = 'iso'")) == [("iso", D(2020, 12, 1))]


def test_coercion(spark):
    df = spark.createDataFrame([("1.2.2021", "2021-01-02 03:04:05", " 7 ", "x", "1,5"), ("bad", "bad", "bad", None, "2,5")],
                               "d string, t string, i string, s string, n string")
    out = coltypes.coerce(df, {"d": "DA", "t": "TS", "i": "I", "s": "CV"})
    assert rows(out.select("i", "s")) == [(7, "x"), (None, None)]
    assert [r.d for r in out.collect()] == [None, None]  # no single format reads the column
    assert rows(df.select(X.to_number("n", ","))) == [(1.5,), (2.5,)]
    assert rows(df.select(X.to_number(F.lit("1,234.50"), ".", ","))) == [(1234.5,), (1234.5,)]


def test_names(spark):
    assert X.proper_name("Мой тариф, №1 (щука)") == "MOJ_TARIF_1_SCHUKA"
    df = spark.createDataFrame([("Мой тариф, №1 (щука)",), ("Ёжик в ЮЖНОМ",)], "n string")
    assert {r[0] for r in df.select(X.proper_name_col("n")).collect()} == {X.proper_name(r[0]) for r in df.collect()}


def test_gate(spark):
    new = spark.createDataFrame(
        [("in", D(2021, 3, 1), D(2021, 3, 5), "a")] * 3 + [("in", D(2021, 3, 1), D(2021, 3, 4), "b")] * 9
        + [("out", D(2021, 3, 1), D(2021, 3, 5), "a")] * 2 + [("out", D(2021, 4, 1), D(2021, 4, 1), "a")],
        "direction string, m date, d date, f string")
    stored = spark.createDataFrame([("in", D(2021, 3, 1), D(2021, 3, 5))] * 2 + [("out", D(2021, 3, 1), D(2021, 3, 1))] * 2,
                                   "direction string, m date, d date")
    gate = control.freshness_gate(new, stored, ["direction", "m"], "d", "m", "f")
    assert rows(gate, "direction", "m", "f", "load") == [
        ("in", D(2021, 3, 1), "a", True), ("out", D(2021, 3, 1), "a", False), ("out", D(2021, 4, 1), "a", True)]
    assert control.accepted(new, gate, ["direction", "m"], "f").count() == 4


def test_diff_by_digest(spark):
    base = [(i % 50, f"v{i % 7}" if i % 3 else None, i % 2 == 0) for i in range(300)]
    schema = "k int, v string, b boolean"
    a = spark.createDataFrame(base, schema)
    assert diff.changed_buckets(a, a.repartition(3), a.columns) == []
    assert diff.table_diff_by_digest(a, a, None).count() == 0
    # nulls in another column, one copy more, one less
    b = spark.createDataFrame(base[2:] + [base[5], (None, "v1", True), (7, None, None)], schema)
    for which in (None, "left_only", "right_only"):
        assert rows(diff.table_diff_by_digest(a, b, which)) == rows(diff.table_diff(a, b, which))
    swapped = spark.createDataFrame([(None, "x"), ("x", None)], "p string, q string")
    assert len(diff.changed_buckets(swapped.limit(1), swapped.where("q IS NULL"), ["p", "q"])) == 2
    with pytest.raises(ValueError):
        diff.table_diff_by_digest(a, b, "both")


def test_few_changes_shuffle_few_rows(spark):
    a = spark.range(100_000).selectExpr("id", "id % 13 AS v")
    b = a.withColumn("v", F.expr("CASE WHEN id = 77 THEN -1 ELSE v END"))
    found = diff.changed_buckets(a, b, ["id", "v"])
    assert len(found) == 2
    compared = a.where(F.pmod(diff._row_hash(["id", "v"], 1), F.lit(diff.BUCKETS)).isin(found))
    assert compared.count() < 150
    assert rows(diff.table_diff_by_digest(a, b, None), "id", "v", "side") == [(77, -1, "right_only"), (77, 12, "left_only")]


def test_types_of_many_columns(spark):
    """Groups of columns give the same types as one aggregation, and each group is compiled."""
    names = [f"c{i}" for i in range(500)]
    kinds = ["CAST(id AS STRING)", "date_format(date_add(DATE '2021-01-01', CAST(id AS INT)), 'dd.MM.yyyy')", "concat('x', id)", "CAST(id / 4 AS STRING)", "CAST(NULL AS STRING)"]
    df = spark.range(30).selectExpr(*[f"{kinds[i % 5]} AS {n}" for i, n in enumerate(names)])
    got = {r["column"]: (r["column_name"], r["dtype"]) for r in coltypes.infer_types(df).collect()}
    assert [got[n] for n in names] == [(n.upper(), t) for n, t in zip(names, ["INTEGER", "DATE", "VARCHAR(11)", "FLOAT", "INTEGER"] * 100)]
    some = df.select(*names[:7])
    whole = rows(coltypes.profile(some, group=7))
    assert rows(coltypes.profile(some, group=3)) == whole and rows(coltypes.profile(some.limit(0), group=3)) == rows(coltypes.profile(some.limit(0), group=7))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = coltypes.profile(df)._jdf.queryExecution().executedPlan()
        parts = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$").__getattr__("MODULE$").codegenStringSeq(plan)
        sizes = [parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())]
        assert sizes and 0 < max(sizes) < 65_535
        assert "HashAggregate" in plan.toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
