"""Period cube: KPI arms at fixed grains with exact distinct counts and end-of-period snapshots.

All lot arms of all requested windows are computed from one scan of the lots. Every lot is turned into
one row per party, and that only once exchanged into the few (arm, period) entries it belongs to; the entries
are summed per (arm, keys, subscriber), and the per-subscriber rows then give both the distinct count and the
sums. The first exchange spreads a group over tasks by its subscribers, so one that holds much of the data is
no single task's work.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from kpimill.functions.periods import Window, end_sql, trunc_sql, window

OWN_SELLER = "Subs"
COMPANY_SELLER = "Operator"
PLATFORMS = (-1, 1, 2)

ENTRY_KEYS = {
    "period": "string",
    "table_name": "string",
    "report_date": "date",
    "purchase_date": "date",
    "revocation_date": "date",
    "seller_type": "string",
    "traffic_type": "string",
    "branch_id_seller": "int",
    "branch_id_purchaser": "int",
    "tp_id_seller": "bigint",
    "tp_id_purchaser": "bigint",
    "status": "string",
}
MEASURES = ("sellers_count", "purchasers_count", "lot_count", "lot_volume", "sold_value")

TABLE_NAMES = {
    "sellers": "sellers",
    "purchasers": "purchasers",
    "base": "base",
    "revoked": "revoked",
    "distinct_sellers": "distinct sellers by traffic type",
    "distinct_purchasers": "distinct purchasers by traffic type",
    "distinct_all": "distinct all subs",
}
PRODUCTION_ARMS = ("sellers", "purchasers", "base")
ALL_ARMS = tuple(TABLE_NAMES)


STATUS_SQL = """CASE
    WHEN lot_purchase_date IS NOT NULL AND sys_revocation_flag IS NULL THEN 'sold'
    WHEN subs_revocation_date IS NOT NULL AND sys_revocation_flag IS NULL THEN 'revoked'
    WHEN subs_revocation_date IS NULL AND sys_revocation_flag IS NOT NULL AND lot_purchase_date IS NULL THEN 'expired'
    WHEN subs_revocation_date IS NULL AND sys_revocation_flag IS NULL AND lot_purchase_date IS NULL THEN 'active'
    ELSE 'undefined' END"""


def lot_status() -> Column:
    """Five lifecycle states; the first rule that holds decides."""
    return F.expr(STATUS_SQL)


def _seller_sql(company: str) -> str:
    return f"CASE WHEN subs_flag = 1 THEN '{OWN_SELLER}' ELSE '{company}' END"


def seller_type(company: str = COMPANY_SELLER) -> Column:
    """Subscribers are flagged 1; any other flag, also NULL, is the company itself."""
    return F.expr(_seller_sql(company))


# Grouping columns of an entry: small codes stand for the (window, arm) pair, the seller type and the status until the last
# projection, so their texts are not shuffled with every row; branch and plan are those of the party the row is about.
_STATES = ("sold", "revoked", "expired", "active", "undefined")
_ENTRY = {"code": "smallint", "report_date": "date", "purchase_date": "date", "own": "boolean", "tp": "bigint", "status": "tinyint",
          "lot": "tinyint", "volume": "double", "value": "double"}
SELLER_ARMS = ("sellers", "revoked", "distinct_sellers", "distinct_all")
PURCHASER_ARMS = ("purchasers", "distinct_purchasers", "distinct_all")
# Tasks that share a group of lots by their subscribers: a group that holds much of the data is spread over them, and a group
# comes in at most so many parts to the second exchange.
SPREAD = 8


def _struct(types: dict[str, str], known: dict[str, str]) -> str:
    return "named_struct({})".format(", ".join(f"'{k}', CAST({known.get(k, 'NULL')} AS {t})" for k, t in types.items()))


def _arm_date(arm: str, side: str, purchasers_by: str) -> str:
    """The date of a lot that an arm counts it under."""
    if arm == "revoked":
        return "subs_revocation_date"
    if arm == "purchasers":
        return f"lot_{purchasers_by}_date"
    return "lot_placement_date" if side == "seller" else "lot_purchase_date"


def _sides(arms: Iterable[str]) -> list[tuple[str, str]]:
    """(arm, side) of the lot-based arms; both roles land in one group of the last arm, so a trader in both is counted once."""
    unknown = [a for a in arms if a not in TABLE_NAMES]
    if unknown:
        raise ValueError(f"unknown arm {unknown[0]!r}")
    of = {"seller": SELLER_ARMS, "purchaser": PURCHASER_ARMS}
    return [(a, side) for a in arms for side, known in of.items() if a in known]


def _party_rows(lots: DataFrame, windows: list[Window], sides: list[tuple[str, str]], with_status: bool, purchasers_by: str) -> DataFrame:
    """One row per lot and party: what the arms of that side need to know of the lot, if one of them counts it."""
    dates = sorted({_arm_date(a, s, purchasers_by) for a, s in sides} | ({"lot_purchase_date"} if with_status or ("purchasers", "purchaser") in sides else set()))
    types = {"seller": "boolean", **dict.fromkeys(dates, "date"), "own": "boolean", "traffic_type": "string", "branch": "int", "tp": "bigint",
             "status": "tinyint", "subs_id": "bigint", "lot": "tinyint", "volume": "double", "value": "double"}
    state = "array_position(array({}), {})".format(", ".join(f"'{s}'" for s in _STATES), STATUS_SQL) if with_status else "NULL"
    parties = []
    for side in ("seller", "purchaser"):
        wanted = sorted({w.sql(_arm_date(a, s, purchasers_by)) for w in windows for a, s in sides if s == side})
        if wanted:
            known = {
                "seller": str(side == "seller"), **{d: d for d in dates}, "own": "coalesce(subs_flag = 1, false)", "traffic_type": "traffic_type",
                "branch": f"branch_id_{side}", "tp": f"tp_id_{side}", "status": state, "subs_id": f"subs_id_{side}",
                "lot": "CASE WHEN lot_id IS NOT NULL THEN 1 END", "volume": "lot_volume", "value": "lot_value",
            }
            if all(a.startswith("distinct") for a, _ in sides):  # their lots need not have plans and flags
                known |= {"own": "NULL", "tp": "NULL", "status": "NULL"}
            bought = "" if side == "seller" else "lot_purchase_date IS NOT NULL AND "
            parties.append(f"CASE WHEN {bought}({' OR '.join(wanted)}) THEN {_struct(types, known)} END")
    # a filter on the plain date columns, so that it reaches the scan
    needed = sorted({w.sql(_arm_date(a, s, purchasers_by)) for w in windows for a, s in sides})
    return lots.where(" OR ".join(needed)).selectExpr(f"explode(array({', '.join(parties)})) AS p").where("p IS NOT NULL").select("p.*")


def _entry(code: int, arm: str, side: str, win: Window, with_status: bool, purchasers_by: str) -> str:
    """SQL of the entry that a party's row adds to one arm in one window, or NULL when its date is outside."""
    date = _arm_date(arm, side, purchasers_by)
    known = {"code": str(code), "report_date": trunc_sql(date, win.kind)}
    if arm != "distinct_all":
        known |= {"lot": "lot", "volume": "volume", "value": "value"}
    if not arm.startswith("distinct"):
        by_purchase = arm == "purchasers" and purchasers_by == "purchase"
        known |= {"own": "true" if by_purchase else "own", "tp": "tp"}
        if with_status and arm != "revoked":
            known |= {"purchase_date": trunc_sql("lot_purchase_date", win.kind), "status": "status"}
    return f"CASE WHEN {'' if side == 'seller' else 'NOT '}seller AND {win.sql(date)} THEN {_struct(_ENTRY, known)} END"


def lot_arms(
    lots: DataFrame,
    windows: list[Window],
    arms: Iterable[str],
    with_status: bool = True,
    purchasers_by: str = "placement",
    company: str = COMPANY_SELLER,
) -> DataFrame:
    """The lot-based arms over all windows, from one scan and two exchanges.

    The first exchange moves one row per lot and party, whatever the number of arms and windows: to the task of its group's
    columns that all arms have in common and of its share of the subscribers. There the entries of all arms and windows are
    made and summed per subscriber and then per group; the second exchange moves one row per group and task.
    """
    windows, sides = list(windows), _sides([a for a in arms if a != "base"])
    pairs = [(w, a) for w in windows for a in dict.fromkeys(a for a, _ in sides)]
    entries = [_entry(code, a, s, w, with_status, purchasers_by) for code, (w, a) in enumerate(pairs) for b, s in sides if b == a]
    rows = _party_rows(lots, windows, sides, with_status, purchasers_by)
    # lots without a subscriber are never compared, so any spread of them will do
    dates = ", ".join(c for c in rows.columns if c.endswith("_date"))
    rows = rows.withColumn("spread", F.expr(f"CAST(pmod(xxhash64(coalesce(subs_id, xxhash64({dates}))), {SPREAD}) AS TINYINT)"))
    shared = ["traffic_type", "branch"] + ([] if any(a.startswith("distinct") for _, a in pairs) else ["tp"])
    # a number of its own keeps the partitions from being merged: what comes of a row is larger than the row
    parts = int(lots.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    made = rows.repartition(parts, *shared, "spread").selectExpr(*shared, "spread", "subs_id", f"explode(array({', '.join(entries)})) AS e")
    made = made.where("e IS NOT NULL").selectExpr(*shared, "spread", "subs_id", *[f"e.{k}" for k in _ENTRY if k not in shared])
    keys = ["code", "report_date", "purchase_date", "own", "traffic_type", "branch", "tp", "status"]
    per_subscriber = made.groupBy(*keys, "spread", "subs_id").agg(
        F.expr("count(lot) AS lots"), F.expr("sum(volume) AS volume"), F.expr("sum(value) AS value")
    )
    grouped = per_subscriber.groupBy(*keys).agg(
        F.expr("count(subs_id) AS subs"),
        F.expr("sum(lots) AS lots"),
        F.expr("sum(volume) AS lot_volume"),
        F.expr("sum(value) AS sold_value"),
    )
    texts = lambda values: "element_at(array({}), code + 1)".format(", ".join(f"'{v}'" for v in values))
    codes = lambda *names: "code IN ({})".format(", ".join(str(i) for i, p in enumerate(pairs) if p[1] in names) or "-1")
    of = {
        "revocation_date": "CAST(NULL AS DATE)",
        "seller_type": f"CASE WHEN own THEN '{OWN_SELLER}' WHEN NOT own THEN '{company}' END",
        "branch_id_seller": f"CASE WHEN {codes(*SELLER_ARMS)} THEN branch END",
        "branch_id_purchaser": f"CASE WHEN {codes(*PURCHASER_ARMS)} THEN branch END",
        "tp_id_seller": f"CASE WHEN {codes(*SELLER_ARMS)} THEN tp END",
        "tp_id_purchaser": f"CASE WHEN {codes(*PURCHASER_ARMS)} THEN tp END",
        "status": "CASE status {} END".format(" ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(_STATES, 1))),
    }
    return grouped.selectExpr(
        f"{texts([w.kind for w, _ in pairs])} AS period",
        f"{texts([TABLE_NAMES[a] for _, a in pairs])} AS table_name",
        *[f"{of.get(k, k)} AS {k}" for k in ENTRY_KEYS if k not in ("period", "table_name")],
        f"CASE WHEN {codes('sellers', 'distinct_sellers', 'distinct_all')} THEN subs END AS sellers_count",
        f"CASE WHEN {codes('purchasers', 'distinct_purchasers', 'distinct_all')} THEN subs END AS purchasers_count",
        f"CASE WHEN NOT {codes('distinct_all')} THEN lots END AS lot_count",
        "lot_volume",
        "sold_value",
    )


def base_arm(agg: DataFrame, windows: list[Window], platforms: Iterable[int] = PLATFORMS) -> DataFrame:
    """Semi-additive snapshot: only the last day of each period counts, shown under the period start."""
    snaps = [
        f"CASE WHEN {w.sql('report_date')} AND report_date = {end_sql('report_date', w.kind)} "
        f"THEN named_struct('period', '{w.kind}', 'start', {trunc_sql('report_date', w.kind)}) END"
        for w in windows
    ]
    snap = (
        agg.where(F.col("calc_platform_id").isin(*platforms))
        .where(" OR ".join(w.sql("report_date") for w in windows))
        .selectExpr("branch_id", "tp_id", "flash_active_count", f"explode(array({', '.join(snaps)})) AS w")
        .where("w IS NOT NULL")
        .groupBy("w.period", F.expr("w.start AS report_date"), "branch_id", "tp_id")
        .agg(F.sum("flash_active_count").alias("active"))
    )
    known = {
        "period": "period",
        "table_name": f"'{TABLE_NAMES['base']}'",
        "report_date": "report_date",
        "seller_type": f"'{OWN_SELLER}'",
        "branch_id_seller": "branch_id",
        "branch_id_purchaser": "branch_id",
        "tp_id_seller": "tp_id",
        "tp_id_purchaser": "tp_id",
    }
    return snap.selectExpr(
        *[f"CAST({known.get(k, 'NULL')} AS {t}) AS {k}" for k, t in ENTRY_KEYS.items()],
        "active AS sellers_count",
        "active AS purchasers_count",
        "CAST(NULL AS bigint) AS lot_count",
        "CAST(NULL AS double) AS lot_volume",
        "CAST(NULL AS double) AS sold_value",
    )


def period_cube(
    lots: DataFrame,
    agg: DataFrame | None,
    windows: Window | list[Window],
    arms: Iterable[str] = PRODUCTION_ARMS,
    as_of: dt.date | None = None,
    with_status: bool = True,
    purchasers_by: str = "placement",
    company: str = COMPANY_SELLER,
) -> DataFrame:
    """Union of the chosen arms over the given windows, in the layout of the cube table."""
    windows = [windows] if isinstance(windows, Window) else list(windows)
    arms = list(arms)
    parts = []
    if any(a != "base" for a in arms):
        parts.append(lot_arms(lots, windows, arms, with_status, purchasers_by, company))
    if "base" in arms:
        parts.append(base_arm(agg, windows))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("insert_date", F.lit(as_of).cast("date"))


def single_arm(lots: DataFrame, arm: str, kind: str, start: dt.date, till: dt.date, **options) -> DataFrame:
    return lot_arms(lots, [window(kind, start, till)], [arm], **options)


def cumulative_metrics(lots: DataFrame) -> DataFrame:
    """All-time distinct sellers, purchasers and traders of subscriber lots, one row per metric.

    One exchange on the subscriber id: each id carries its roles, and the roles are counted.
    """
    role = lambda c, s, p: f"named_struct('id', {c}, 'sells', {s}, 'buys', {p})"
    roles = (
        lots.where("subs_flag = 1")
        .selectExpr(f"explode(array({role('subs_id_seller', 1, 0)}, {role('subs_id_purchaser', 0, 1)})) AS r")
        .where("r.id IS NOT NULL")
        .groupBy("r.id")
        .agg(F.max("r.sells").alias("sells"), F.max("r.buys").alias("buys"))
    )
    totals = roles.agg(
        F.coalesce(F.sum("sells"), F.lit(0)).alias("sellers_count"),
        F.coalesce(F.sum("buys"), F.lit(0)).alias("purchasers_count"),
        F.count(F.lit(1)).alias("traders_count"),
    )
    names = ["sellers_count", "purchasers_count", "traders_count"]
    return totals.unpivot([], names, "metric", "metric_value")


def who_volume(lots: DataFrame, since: dt.date) -> DataFrame:
    """Volume by role, branch, date and traffic since a date; sellers by placement, purchasers by purchase."""
    def side(who: str, branch: str, date: str) -> str:
        return (
            f"CASE WHEN {date} >= DATE '{since}' THEN named_struct('who', '{who}', 'branch_id', {branch}, "
            f"'report_date', {date}, 'traffic_type', traffic_type, 'volume', lot_volume) END"
        )

    seller = side("seller", "branch_id_seller", "lot_placement_date")
    purchaser = side("purchaser", "branch_id_purchaser", "lot_purchase_date")
    return (
        lots.where(f"lot_placement_date >= DATE '{since}' OR lot_purchase_date >= DATE '{since}'")
        .selectExpr(f"explode(array({seller}, {purchaser})) AS e")
        .where("e IS NOT NULL")
        .groupBy("e.who", "e.branch_id", "e.report_date", "e.traffic_type")
        .agg(F.sum("e.volume").alias("lot_volume"))
    )


def bundle_subs(agg: DataFrame, plans: DataFrame, since: dt.date, platforms: Iterable[int] = PLATFORMS) -> DataFrame:
    """Active count by date and branch over bundle plans."""
    fact = agg.where(F.col("calc_platform_id").isin(*platforms) & (F.col("report_date") >= F.lit(since)))
    return (
        fact.join(plans.where(F.col("bundle_flag") == 1).select("tp_id"), "tp_id")
        .groupBy("report_date", "branch_id")
        .agg(F.sum("flash_active_count").alias("subs_count"))
    )


def latest_version(df: DataFrame, col: str = "param_1", pattern: str = "F%") -> DataFrame:
    """Among versions like the pattern keep only the latest by (second part, first part); others stay.

    The winner is one value, looked up in the same plan, not on the driver.
    """
    v = F.col(col)
    order = F.struct(F.split_part(v, F.lit("_"), F.lit(2)), F.split_part(v, F.lit("_"), F.lit(1)))
    newest = df.where(v.like(pattern)).groupBy(v).agg(F.lit(1)).agg(F.max_by(v, order)).scalar()
    return df.where(F.coalesce(~(v.like(pattern) & (v != newest)), F.lit(True)))
