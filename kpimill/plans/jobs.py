"""Whole loads, assembled from the operators: each takes DataFrames and gives a DataFrame or writes a slice."""

from __future__ import annotations

import datetime as dt
import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kpimill.functions import fixed_values as fv
from kpimill.functions import periods as P
from kpimill.functions import text as X
from kpimill.operators import coltypes, control, cube, lookup, project, reshape
from kpimill.session import discard, materialize, staged
from kpimill.sinks import statistics, tables, versions
from kpimill.sources import files
from kpimill.streaming import streams

# ---- marketplace cube ----------------------------------------------------------------------------


def refresh_all(
    spark: SparkSession,
    path: str,
    lots: DataFrame,
    agg: DataFrame,
    max_date: dt.date,
    months_from: dt.date,
    as_of: dt.date,
    arms=cube.PRODUCTION_ARMS,
    statistics_path: str | None = None,
    **options,
) -> None:
    """Rebuild the daily, weekly and monthly cube for the rolling ranges and replace all three periods; the statistics of
    what was replaced are made again where a path for them is given."""
    windows = P.refresh_windows(max_date, months_from)
    rows = cube.period_cube(lots, agg, windows, arms, as_of, **options)
    if tables.exists(spark, path):
        tables.replace_slice(spark, path, F.col("period").isin(*P.KINDS), rows, ["period"])
    else:
        tables.full_reload(rows, path, ["period"])
    if statistics_path:
        stored = spark.read.schema(rows.schema).parquet(path)
        statistics.update_statistics(spark, statistics_path, stored, ["period"], F.col("period").isin(*P.KINDS))


# ---- brand tracking ------------------------------------------------------------------------------


@dataclass(frozen=True)
class TrackingProfile:
    name: str
    headers: dict[str, str]
    kpis: tuple[str, ...]
    area_cats: tuple[str, ...]
    breakdown: tuple[str, tuple[str, ...]] | None = None  # column and the values kept
    own_flag: bool = False


TRACKING_PROFILES = {
    "express": TrackingProfile("express", fv.EXPRESS_HEADERS, fv.EXPRESS_KPIS, fv.EXPRESS_AREA_CATS),
    "general": TrackingProfile("general", fv.GENERAL_HEADERS, fv.GENERAL_KPIS, fv.GENERAL_AREA_CATS,
                               ("Разбивка1", fv.GENERAL_BREAKDOWN), True),
    "social_subs": TrackingProfile("social_subs", fv.SOCIAL_SUBS_HEADERS, fv.SOCIAL_KPIS, fv.SOCIAL_AREA_CATS,
                                   ("cat_1", fv.SOCIAL_BREAKDOWNS), True),
    "social": TrackingProfile("social", fv.SOCIAL_HEADERS, fv.SOCIAL_KPIS, fv.SOCIAL_AREA_CATS,
                              ("cat_1", fv.SOCIAL_BREAKDOWNS)),
}


def normalize_tracking(sheet: DataFrame, profile: TrackingProfile | str) -> DataFrame:
    """Wide tracking sheet to the 11-column table: one row per KPI, operator, area, breakdown and quarter."""
    p = TRACKING_PROFILES[profile] if isinstance(profile, str) else profile
    df = project.rename_synonyms(sheet, p.headers)
    df = df.where(F.col("kpi").isin(*p.kpis) & F.col("area_cat").isin(*p.area_cats))
    if p.breakdown:
        df = df.where(F.col(p.breakdown[0]).isin(*p.breakdown[1]))
    if p.own_flag:
        df = df.withColumn("cat_3", F.when(F.col("cat_3").contains(fv.OWN_MARK), fv.OWN_LABEL).otherwise(fv.OTHER_LABEL))
    df = df.where(reshape.keep_one_total("area", "Total", fv.KEPT_TOTAL_AREA))
    ids = {*p.headers.values(), "kpi"} | ({"cat_3"} if p.own_flag else set())
    dropped = lambda c: fv.CHANGE_MARK in c or fv.BASE_MARK in c or fv.QUARTER_MARK not in c
    df = reshape.drop_by_rule(df, dropped, ids)
    keys = [c for c in df.columns if c in ids]
    columns = []
    for q in (c for c in df.columns if c not in ids):
        start, end = P.quarter_dates(q)  # the label is a column name: its dates are literals of the plan
        columns.append((q, {"period_start": start, "period_end": end}))
    if not columns:
        raise ValueError("no quarter columns")
    df = df.withColumns({q: X.to_number(F.col(f"`{q}`")) for q, _ in columns})
    long = project.relabel(reshape.melt_as(df, keys, columns, "param_value"), "area", fv.TRACKING_AREAS)
    types = {"period_start": "date", "period_end": "date", "param_value": "double"}
    schema = ", ".join(f"{c} {types.get(c, 'string')}" for c in fv.TRACKING_COLUMNS)
    return project.conform(long, schema, {"source_table": p.name})


def tracking_profile(file_name: str, sheets: list[str]) -> str:
    """The layout of a workbook, told by the end of its file name and a sheet that it holds."""
    stem = file_name.rsplit("/", 1)[-1].split(".")[0]
    for name, (endings, wanted) in fv.TRACKING_FILES.items():
        if stem.endswith(endings) and set(wanted) & set(sheets):
            return name
    raise ValueError(f"no tracking layout for {file_name} with sheets {sheets}")


def read_tracking(spark: SparkSession, root: str, file_name: str) -> DataFrame:
    """A tracking workbook (a folder of sheets) in the 11-column layout; express sheets name their KPI."""
    profile = tracking_profile(file_name, files.sheet_names(spark, root))
    label = "kpi" if profile == "express" else "__sheet"
    stacked = files.read_sheets(spark, root, list(fv.TRACKING_FILES[profile][1]), label, distinct=True)
    return normalize_tracking(stacked.drop("__sheet"), profile)


def load_tracking(spark: SparkSession, path: str, long: DataFrame, profile: str) -> dict[str, int]:
    """Replace one layout's rows of the tracking table, which is cut by ``source_table``."""
    return tables.replace_slice(spark, path, F.col("source_table") == profile, long, ["source_table"])


# ---- planned sales mix ---------------------------------------------------------------------------


def _clean_header(name: str, headers: dict[str, str]) -> str:
    bare = re.sub(fv.PLAN_SUFFIX_PATTERN, r"\1", name).strip()
    return headers.get(bare, bare)


def sales_mix_long(
    raw: DataFrame, layout: str, keys: int = 2, totals: bool = True, headers: dict[str, str] | None = None, extra: tuple[str, ...] = ()
) -> DataFrame:
    """Wide sales-mix sheet to (region, channel, tariff, subs_count), and the ``extra`` columns as they are.

    ``new``: the sheet's last repeated columns, one channel. ``old``: the key columns and every plan column;
    either only the total channel is kept or only the others. ``headers`` maps header spellings to names; two columns
    that get one name give rows of their own. Rows with an empty cell are left out, and so are cells with the
    spreadsheet's division error; a cell with any other text that is no number fails the query with that text.
    """
    headers = fv.SALES_MIX_HEADERS if headers is None else headers
    body = [c for c in raw.columns if c not in extra]
    if layout == "new":
        picked = {c: headers.get(c, c) if c == fv.REGION_MARKER else c for c in body}
    elif layout == "old":
        kept = reshape.columns_with_marker(body, fv.PLAN_MARKER, keys)
        picked = {c: _clean_header(_clean_header(c, headers), headers) for c in kept}
    else:
        raise ValueError(f"unknown layout {layout!r}")
    ids = {n: c for c, n in picked.items() if n in ("region", "channel", "macroregion", "cluster")}
    tariffs = [(c, {"tariff": n}) for c, n in picked.items() if n not in ids]
    wide = raw.select(*[F.col(f"`{c}`") for c in (*picked, *extra)]).dropna(subset=[f"`{c}`" for c in picked])
    wide = wide.select(
        *[F.col(f"`{c}`").alias(n) for n, c in ids.items()], *[F.col(f"`{c}`") for c in extra],
        *[F.col(f"`{c}`").cast("string").alias(f"__{i}") for i, (c, _) in enumerate(tariffs)])
    if layout == "new":
        wide = wide.withColumn("channel", F.lit("Total"))
    else:
        wide = wide.where((F.col("channel") == "Total") if totals else (F.col("channel") != "Total"))
    tariffs = [(f"__{i}", label) for i, (_, label) in enumerate(tariffs)]
    long = reshape.melt_as(wide, ["region", "channel", *extra], tariffs, "subs_count").where(F.col("subs_count") != fv.DIV_ZERO_SENTINEL)
    number = X.to_number("subs_count", type_="decimal(18,6)")
    bad = F.concat(F.lit("not a number in the sales mix: "), F.col("region"), F.lit(", "), F.col("tariff"), F.lit(": "), F.col("subs_count"))
    number = F.when(number.isNull(), F.raise_error(bad)).otherwise(F.round(number, 2))
    return long.withColumn("subs_count", number.cast("double"))


def sales_mix_files(spark: SparkSession, path: str, sep: str = ";", headers: dict[str, str] | None = None) -> DataFrame:
    """Sales-mix files of the old layout, stacked: each file's report month stands in its first cell, its header further
    down. Files without a month or a header are refused."""
    raw = files.find_header(spark, path, fv.REGION_MARKER, sep)
    months = files.report_months(spark, path, sep)
    dated = lookup.map_dim(raw, months, {"source_file": "source_file"}).drop("source_file")
    return sales_mix_long(dated, "old", headers=headers, extra=("report_month",))


def sales_mix_params(
    long: DataFrame, report_month: dt.date | str, plans: DataFrame, branches: DataFrame, regions: dict[str, str], by_channel: bool = False
) -> DataFrame:
    """Long sales mix to the parameters layout: plan id by tariff name, branch id by region name. The month is a date, or the
    column that holds it."""
    long = materialize(long, "sales-mix")  # the sheet is read once: for its tariff names and for its rows
    plan_ids = lookup.other_bucket(plans, long.select("tariff"), "name_report", "tp_id")
    mapped = lookup.map_dim(long, plan_ids, {"tariff": "name_report"})
    mapped = lookup.map_dim(project.relabel(mapped, "region", regions), branches, {"region": "region_name"})
    month = F.col(report_month) if isinstance(report_month, str) else F.lit(report_month)
    constants = {"report_date": month, "param_1": fv.SALES_MIX_PARAM, "tp_id_1": F.col("tp_id"),
                 "param_value": F.col("subs_count")}
    if by_channel:
        constants["param_2"] = F.col("channel")
    return project.conform(mapped, fv.PARAMETERS_SCHEMA, constants)


def load_sales_mix(spark: SparkSession, path: str, params: DataFrame, *report_months: dt.date) -> None:
    """Replace the sales mix of the given months."""
    slice_ = (F.col("param_1") == fv.SALES_MIX_PARAM) & F.col("report_date").isin(*report_months)
    tables.replace_slice(spark, path, slice_, params, ["param_1"])


# ---- finance plan --------------------------------------------------------------------------------


def plan_params(raw: DataFrame, codes: DataFrame) -> DataFrame:
    """Stacked plan sheets to monthly parameters: month, rounding, code relabels, versions, branch by code."""
    df = raw.withColumn("report_month", P.make_month("year", "month"))
    df = df.withColumn("param_value", F.round(F.col("param_value").cast("decimal(24,8)"), 4).cast("double"))
    df = project.default_columns(df, {"tariff": None, "base_type": None})
    df = df.withColumns({"tariff": F.col("tariff").cast("string"), "base_type": F.col("base_type").cast("string")})
    df = project.relabel(project.relabel(df, "tariff", fv.PLAN_TARIFFS), "base_type", fv.PLAN_BASE_TYPES)
    version = F.col("version")
    df = df.withColumns({
        "version": F.when(version.contains(fv.BUDGET_VERSION), fv.BUDGET_VERSION).otherwise(F.trim(version)),
        "account": F.trim("account"),
    })
    branch_of = lookup.representative_key(codes, ["code", "code_name"], "branch_id")
    df = lookup.map_dim(df, branch_of, {"region": "code"})
    constants = {"report_date": F.col("report_month"), "param_1": F.col("version"), "param_2": F.col("account"),
                 "tariff_1": F.col("tariff")}
    return project.conform(df, fv.PARAMETERS_SCHEMA, constants)


def daily_plan(params: DataFrame, account: str = fv.PASSTHROUGH_ACCOUNT) -> DataFrame:
    """Monthly plan values per day; actuals and one account keep their monthly row."""
    whole = (f"param_1 = '{fv.ACTUAL_VERSION}' OR (param_1 <> '{fv.ACTUAL_VERSION}' AND param_2 = {X.sql_text(account)})")
    return reshape.allocate_daily(params, "report_date", "param_value", whole)


def load_plan(
    spark: SparkSession, path: str, backup: str, raw: DataFrame, codes: DataFrame, spec: tables.SliceSpec,
    account: str = fv.PASSTHROUGH_ACCOUNT,
) -> None:
    """Back up the slice, replace it with the daily plan, keep only the newest forecast version.

    The slice is described on the parameters' columns and cut by version (param_1), the table's partition. The daily rows, up to
    31 times the monthly ones, are made where they are written: they are neither staged nor exchanged.
    """
    params, stage = staged(plan_params(raw, codes), "plan-params")  # monthly rows, used three times
    spec = spec.resolve(params)
    cond = spec.column()
    tables.backup_slice(spark, path, backup, cond, ["param_1"])
    tables.replace_slice(spark, path, cond, daily_plan(params.where(cond), account), ["param_1"], stored=True, gather=False)
    keep_latest_forecast(spark, path)
    discard(spark, stage)


def keep_latest_forecast(spark: SparkSession, path: str) -> None:
    """Delete all forecast versions but the newest; the versions are partition names."""
    table = spark.read.schema(fv.PARAMETERS_SCHEMA).parquet(path)
    versions = table.select("param_1").where(F.col("param_1").like(fv.FORECAST_PATTERN)).distinct()
    newest = cube.latest_version(versions).select("param_1").collect()
    if newest:
        old = F.col("param_1").like(fv.FORECAST_PATTERN) & (F.col("param_1") != newest[0][0])
        tables.clear_slice(spark, path, old, ["param_1"])


def plan_two_segments(b2c: DataFrame, b2b: DataFrame, codes: DataFrame) -> DataFrame:
    """Consumer sheet with one column per month, business sheet without months: both as parameters."""
    months = [c for c in b2c.columns if c not in ("code", "region", "base")]
    consumer = reshape.melt(b2c, ["code", "region", "base"], months, "report_date", "param_value").select(
        "code", F.upper("base").alias("base_type"), F.col("report_date").cast("date").alias("report_date"),
        F.col("param_value").cast("double").alias("param_value"), F.lit("B2C").alias("param_3"))
    business = b2b.withColumnRenamed("value", "param_value").withColumn(
        "report_date", F.explode(F.array(*[F.lit(m).cast("date") for m in months])))
    business = business.select(
        "code", F.lit(None).cast("string").alias("base_type"), "report_date",
        F.col("param_value").cast("double").alias("param_value"), F.lit("B2B").alias("param_3"))
    mapped = lookup.map_dim(consumer.unionByName(business), codes.where("code IS NOT NULL"), {"code": "code"})
    return project.conform(mapped, fv.PARAMETERS_SCHEMA, {"param_1": "Plan", "param_2": fv.LIVE_BASE_KPI})


def previous_year_zero(params: DataFrame) -> DataFrame:
    """The same rows a year earlier with value 0, so that year-on-year reports have a base."""
    return P.shift_year(params, "report_date", -1, "param_value")


def load_live_base(spark: SparkSession, path: str, params: DataFrame, version: str, year: int | None = None) -> dict:
    """Replace the live-base rows of a version, or of one year of it."""
    slice_ = (F.col("param_1") == version) & (F.col("param_2") == fv.LIVE_BASE_KPI)
    if year is not None:
        slice_ = slice_ & (F.year("report_date") == year)
    return tables.replace_slice(spark, path, slice_, params, ["param_1"])


def target_levels(sheet: DataFrame, codes: DataFrame, report_date: dt.date, kpi: str = fv.LIVE_BASE_KPI) -> DataFrame:
    """Sheet of Min, Target and Stretch values of one KPI as parameters."""
    names = ["cluster", "kpi", "code", "region", "Min", "Target", "Stretch"]
    df = project.positional_rename(sheet, names).where(F.col("kpi") == kpi)
    df = df.withColumn("code", F.concat(F.col("code").cast("string"), F.lit("00")))
    df = lookup.map_dim(df, codes.where("code IS NOT NULL"), {"code": "code"})
    long = reshape.melt(df, ["kpi", "branch_id"], ["Min", "Target", "Stretch"], "param_3", "param_value")
    constants = {"report_date": F.lit(report_date), "param_1": fv.BUDGET_VERSION, "param_2": F.col("kpi")}
    return project.conform(long, fv.PARAMETERS_SCHEMA, constants)


# ---- call records --------------------------------------------------------------------------------

CDR_SCHEMA = (
    "cdr_month date, cdr_date date, carrier string, branch string, direction string, destination string, "
    "minutes decimal(18,6), cost decimal(18,6), currency string, insert_date date, carrier_type string, "
    "country string, area string, data_source string"
)


def feed_direction(df: DataFrame) -> str | None:
    """Direction told by a feed's headers; None when a column holds it.

    Feeds named by direction get that column from ``text.first_word`` of the file name beforehand.
    """
    if "OPERATOR_NAME" in df.columns:
        return "Incoming"
    return None if "DIRECTION" in df.columns else "Outgoing"


def read_cdr(feed: DataFrame, file_col: str = "data_source", carrier_types=fv.CARRIER_TYPES) -> DataFrame:
    """Call records of one layout (any number of files) with typed cells and the direction of each record; the gate on
    carrier types is applied. ``unreadable`` counts the filled cells of a record that are no number or date."""
    direction = feed_direction(feed)
    df = project.rename_synonyms(feed, fv.CDR_SYNONYMS)
    numbers = {c: X.to_number(c, ",", type_="decimal(18,6)") for c in ("MINUTES", "COST")}
    filled = lambda c: F.coalesce(F.trim(F.col(c).cast("string")) != "", F.lit(False))
    bad = sum((F.when(filled(c) & n.isNull(), 1).otherwise(0) for c, n in numbers.items()), F.lit(0))
    df = df.withColumns({**numbers, "unreadable": bad})
    if direction:
        df = df.withColumn("DIRECTION", F.lit(direction))
    carrier = F.col("CARRIER")
    if "BRANCH" not in df.columns:
        # the type letter is the first of the carrier that the pattern finds
        cut = lambda group: F.regexp_extract(carrier, fv.CARRIER_PATTERN, group)
        df = project.compute_once(df, {"CARRIER": cut(1), "BRANCH": cut(2)})
        df = df.withColumns({c: X.blank_to_null(c) for c in ("CARRIER", "BRANCH")})
        df = df.withColumn("CARRIER_TYPE", F.substring("CARRIER", 1, 1))
    else:
        df = project.compute_once(df, {"CARRIER_TYPE": F.regexp_extract(carrier, fv.CARRIER_TYPE_PATTERN, 1)})
    df = df.where(F.col("CARRIER_TYPE").isin(*carrier_types) & ~F.col("CARRIER").isin(*fv.EXCLUDED_CARRIERS))
    # read twice from here on, for the formats of the files' dates and for the records: cut and gated once
    df = materialize(df.withColumnRenamed("CDR_DATE", "__text_date"), "gated")
    df = coltypes.parse_dates(df, "__text_date", fv.CDR_DATE_FORMATS, [file_col], "CDR_DATE", "CDR_MONTH")
    undated = F.when(filled("__text_date") & F.col("CDR_DATE").isNull(), 1).otherwise(0)
    return df.withColumn("unreadable", F.col("unreadable") + undated)


def cdr_file_report(records: DataFrame, file_col: str = "data_source") -> DataFrame:
    """Per file of ``read_cdr`` or ``normalize_cdr``: records, first and last month, number of months, unreadable cells. A file
    that may be loaded has one month and no unreadable cell (``ok``)."""
    month = F.trunc("CDR_DATE", "month")
    # months of a file are counted from their distinct values, combined before the shuffle
    per_month = records.groupBy(file_col, month.alias("m")).agg(F.count(F.lit(1)).alias("n"), F.sum("unreadable").alias("u"))
    out = per_month.groupBy(F.col(file_col).alias("data_source")).agg(
        F.sum("n").alias("rows"), F.min("m").alias("first_month"), F.max("m").alias("last_month"), F.count("m").alias("months"),
        F.sum("u").alias("unreadable"))
    return out.withColumn("ok", (F.col("months") == 1) & (F.col("unreadable") == 0))


def normalize_cdr(
    feed: DataFrame,
    as_of: dt.date,
    incoming: DataFrame | None = None,
    mapping: DataFrame | None = None,
    dictionary: DataFrame | None = None,
    file_col: str = "data_source",
    carrier_types=fv.CARRIER_TYPES,
) -> DataFrame:
    """Call-record feed of one layout (any number of files) to the target layout.

    ``incoming``: destination, country, area. ``mapping``: destination, codes, country, area.
    ``dictionary``: dial_codes, new_destination. Each record is looked up by its own direction, so one feed may hold
    several; other directions than the two are looked up nowhere. ``unreadable`` goes along, for ``load_cdr``.
    """
    return cdr_layout(read_cdr(feed, file_col, carrier_types), as_of, incoming, mapping, dictionary, file_col)


def cdr_layout(
    df: DataFrame, as_of: dt.date, incoming: DataFrame | None = None, mapping: DataFrame | None = None,
    dictionary: DataFrame | None = None, file_col: str = "data_source",
) -> DataFrame:
    """Records of ``read_cdr`` to the target layout, with the lookups of their direction, and their ``unreadable`` cells."""
    if mapping is not None:
        df = _outgoing_destinations(df, mapping, dictionary)
    if incoming is not None:
        known = incoming.select("destination", F.col("country").alias("__in_country"), F.col("area").alias("__in_area"))
        df = lookup.map_dim(df, known, {"DESTINATION": "destination"}, "left", F.col("DIRECTION") == "Incoming")
        found = lambda c: F.when(F.col("DIRECTION") == "Incoming", F.col(f"__in_{c}"))
        df = df.withColumns({c: F.coalesce(found(c), c) if c in df.columns else found(c) for c in ("country", "area")})
    return project.conform(df, f"{CDR_SCHEMA}, unreadable int", {"insert_date": F.lit(as_of), "data_source": F.col(file_col)})


def _outgoing_destinations(df: DataFrame, mapping: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Country and area by destination, then the destination by the longest code of its dialling code.

    The prefix lookup runs on the mapping, which has one row per destination, not on the records.
    """
    coded = mapping.withColumn("first_code", X.first_code("codes"))
    coded = lookup.longest_prefix(coded, "first_code", dictionary, "dial_codes", "new_destination", "new_destination")
    coded = coded.select("destination", "country", "area", "new_destination", F.lit(True).alias("matched"))
    coded = materialize(coded, "destinations")  # one row per destination, now of known size
    df = lookup.map_dim(df, coded, {"DESTINATION": "destination"}, "left", F.col("DIRECTION") == "Outgoing")
    matched = F.coalesce("matched", F.lit(False))
    return df.withColumns({
        "DESTINATION": F.coalesce(X.blank_to_null("new_destination"), "DESTINATION"),
        "country": X.or_unknown("country", matched),
        "area": X.or_unknown("area", matched),
    })


CDR_SLICE = ["direction", "cdr_month"]


def cdr_slices(records: DataFrame, stored: DataFrame, report: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """What of new records is to replace its (direction, month) slice: (rows, decisions).

    Files that the report does not find in order (``cdr_file_report`` of these records, unless one is given) are refused:
    none of their rows is loaded, and they come back as decisions with ``refused``. The others go through the freshness gate.
    """
    if report is None:
        if "unreadable" not in records.columns:
            raise ValueError("records without their unreadable cells need a report of their files")
        report = cdr_file_report(records)
    refused = materialize(report.where("NOT ok").select("data_source", F.col("rows").alias("row_count")), "refused")
    gone = refused.select(F.col("data_source").alias("__file"))
    fit = records.join(gone, F.equal_null(F.col("data_source"), F.col("__file")), "left_anti").drop("unreadable")
    decision = control.freshness_gate(fit, stored, CDR_SLICE, "cdr_date", "cdr_month", "data_source")
    decision = materialize(decision.withColumn("refused", F.lit(False)), "gate")
    rows = control.accepted(fit, decision, CDR_SLICE, "data_source")
    return rows, decision.unionByName(refused.withColumns({"load": F.lit(False), "refused": F.lit(True)}), allowMissingColumns=True)


def cdr_slice_filter(decision: DataFrame) -> Column | None:
    """The slices that the gate lets through, as many as folders; None when there is none."""
    yes = [tuple(r) for r in decision.where("load").select(*CDR_SLICE).distinct().collect()]
    return F.struct(*CDR_SLICE).isin([F.struct(F.lit(d), F.lit(m)) for d, m in yes]) if yes else None


def load_cdr(spark: SparkSession, path: str, records: DataFrame, report: DataFrame | None = None) -> DataFrame:
    """Replace the (direction, month) slices whose new rows pass the freshness gate; gives the decisions of ``cdr_slices``.

    Files with cells that could not be read, undated records or several months are refused, also without a report.
    """
    records, stage = staged(records, "cdr")  # parsed once: for the gate and for the write
    here = tables.exists(spark, path)
    schema = records.drop("unreadable").schema
    stored = spark.read.schema(schema).parquet(path) if here else spark.createDataFrame([], schema)
    rows, decision = cdr_slices(records, stored, report)
    if not here:
        tables.full_reload(rows, path, CDR_SLICE)
    elif (slices := cdr_slice_filter(decision)) is not None:
        tables.replace_slice(spark, path, slices, rows, CDR_SLICE)
    discard(spark, stage)
    return decision


def arrive_cdr(
    spark: SparkSession, source: str, table: versions.VersionedTable, schema: str, checkpoint: str, as_of: dt.date,
    feed_name: str = "call-records", file_col: str = "data_source", glob: str = "*", files_per_batch: int = 100, **dictionaries: DataFrame,
) -> None:
    """Load call-record files as they arrive: read, report, freshness gate and slice replacement for every batch of new files.

    A batch goes into the table in one commit together with its number, so it is loaded once: one that is given again after
    its commit is known and passed over, one that was cut off before it is done again from the start. The decisions of a batch
    are the notes of its version. ``table`` holds ``CDR_SCHEMA`` by ``CDR_SLICE``; ``dictionaries`` are those of ``normalize_cdr``.
    """

    def load(rows: DataFrame, batch: int) -> None:
        if table.seen(feed_name, batch):
            return
        feed = rows if file_col == "data_source" else rows.drop("data_source").withColumnRenamed(file_col, "data_source")
        records, stage = staged(normalize_cdr(feed, as_of, **dictionaries), "cdr")
        new, decision = cdr_slices(records, table.read())
        slices = cdr_slice_filter(decision)
        notes = [json.loads(r[0]) for r in decision.select(F.to_json(F.struct("*"))).collect()]  # one per slice or refused file
        table.replace(F.lit(False) if slices is None else slices, None if slices is None else new, (feed_name, batch), notes)
        discard(spark, stage)

    streams.stream_files(spark, source, schema, load, checkpoint, glob=glob, files_per_batch=files_per_batch)


# ---- file upload ---------------------------------------------------------------------------------

_CODE_OF = {"DATE": "DA", "TIMESTAMP(0)": "TS", "FLOAT": "F", "INTEGER": "I", "BIGINT": "I8"}


def type_code(dtype: str) -> str:
    return "D" if dtype.startswith("DECIMAL") else _CODE_OF.get(dtype, "CV")


def typed_load(
    spark: SparkSession, feed: DataFrame, path: str, history: str, file_name: str, table_name: str, user: str,
    at: dt.datetime, mapping: dict[str, str | None] | None = None,
) -> DataFrame:
    """Propose types, map and coerce columns, append, and write the audit row; gives the proposed types."""
    proposed = coltypes.infer_types(feed).collect()  # one row per column
    types = {r["column"]: r["dtype"] for r in proposed}
    names = {r["column"]: r["column_name"] for r in proposed}
    mapping = mapping or {names[c]: c for c in feed.columns}
    codes = {t: type_code(types[s]) for t, s in mapping.items() if s}
    typed = coltypes.coerce(project.map_columns(feed, mapping), codes)
    tables.append(typed, path)
    schema, _, name = table_name.rpartition(".")
    tables.add_history(spark, history, file_name, schema, name, user, at)
    return spark.createDataFrame(proposed)
