"""The warehouse tables of the reporting jobs, derived from the star-schema parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Declared schemas: no job has to open file footers before a plan can be built.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marketplace lots: placement, purchase and revocation dates, both parties, volume and value.

    Customers join the orders, not the lots, so the lots move once.
    """
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    return (
        table(spark, sf_dir, "lineitem")
        .join(orders.join(table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey"), "o_custkey"), "l_orderkey")
        .join(table(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "l_suppkey"), "l_suppkey")
        .selectExpr(
            "l_orderkey AS lot_id",
            "CAST(o_orderdate AS DATE) AS lot_placement_date",
            "CASE WHEN l_shipdate >= o_orderdate THEN CAST(l_shipdate AS DATE) END AS lot_purchase_date",
            "CASE WHEN l_shipdate < o_orderdate AND l_returnflag = 'R' THEN CAST(o_orderdate AS DATE) END "
            "AS subs_revocation_date",
            "CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 1 END AS sys_revocation_flag",
            "CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS subs_flag",
            "l_returnflag AS traffic_type",
            "l_suppkey AS subs_id_seller",
            "CASE WHEN l_shipdate >= o_orderdate THEN o_custkey END AS subs_id_purchaser",
            "s_nationkey AS branch_id_seller",
            "c_nationkey AS branch_id_purchaser",
            "l_partkey % 5 AS tp_id_seller",
            "o_custkey % 5 AS tp_id_purchaser",
            "l_quantity AS lot_volume",
            "l_extendedprice AS lot_value",
        )
    )


def base_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily product aggregate: active count by date, branch, plan and platform."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey",
        "CAST(o_orderdate AS DATE) AS report_date",
        "o_custkey % 5 AS tp_id",
        "CASE o_orderpriority WHEN '1-URGENT' THEN -1 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 ELSE 3 END "
        "AS calc_platform_id",
    )
    customer = table(spark, sf_dir, "customer").selectExpr("c_custkey AS o_custkey", "c_nationkey AS branch_id")
    keys = ["report_date", "branch_id", "tp_id", "calc_platform_id"]
    return orders.join(customer, "o_custkey").groupBy(*keys).count().withColumnRenamed("count", "flash_active_count")


def price_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS tp_id", "p_brand AS name_report", "p_size % 2 AS bundle_flag"
    )


def region_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr("n_nationkey AS region_id", "n_name AS region_name")


def branch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Branches with their region id, cluster, warehouse code and retail flag."""
    nation = table(spark, sf_dir, "nation").withColumnsRenamed(
        {"n_nationkey": "s_nationkey", "n_regionkey": "r_regionkey"}
    )
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, "s_nationkey")
        .join(table(spark, sf_dir, "region"), "r_regionkey")
        .selectExpr(
            "s_suppkey AS branch_id",
            "s_name AS branch_name",
            "s_nationkey AS region_id",
            "r_name AS product_cluster_name",
            "concat(CAST(s_nationkey AS STRING), '00') AS code",
            "n_name AS code_name",
            "s_suppkey % 2 AS b2c_flag",
        )
    )


def plan_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly plan, budget and forecast values by version and account."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey",
        "trunc(o_orderdate, 'month') AS report_date",
        "CASE o_orderstatus WHEN 'F' THEN 'AC' WHEN 'O' THEN 'BU' ELSE concat('F', CAST(quarter(o_orderdate) AS STRING), "
        "'_', CAST(year(o_orderdate) AS STRING), '_01') END AS param_1",
        "o_orderpriority AS param_2",
        "CAST(o_totalprice AS DECIMAL(18,2)) AS price",
    )
    customer = table(spark, sf_dir, "customer").selectExpr("c_custkey AS o_custkey", "c_nationkey AS branch_id")
    return (
        orders.join(customer, "o_custkey")
        .groupBy("report_date", "param_1", "param_2", "branch_id")
        .agg({"price": "sum"})
        .selectExpr("report_date", "param_1", "param_2", "branch_id", "CAST(`sum(price)` AS DOUBLE) AS param_value")
    )


def cdr(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """Call records as their feeds write them: a month and a date format per file, decimal-comma numbers; ``more`` columns."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat('file_', l_suppkey % 4, '_', date_format(l_shipdate, 'yyyyMM')) AS source_file",
        "CASE l_suppkey % 4 WHEN 0 THEN date_format(l_shipdate, 'dd.MM.yyyy') "
        "WHEN 1 THEN date_format(l_shipdate, 'dd.MM.yy') WHEN 2 THEN date_format(l_shipdate, 'dd/MM/yyyy') "
        "ELSE date_format(l_shipdate, 'MM/dd/yyyy HH:mm:ss') END AS START_DATE",
        "concat(CASE l_returnflag WHEN 'A' THEN 'T' WHEN 'N' THEN 'H' ELSE 'Z' END, '_ABC N2 ', l_linestatus) "
        "AS Carrier1",
        "CAST(l_partkey AS STRING) AS Destination1",
        "replace(CAST(CAST(l_quantity AS DECIMAL(18,2)) AS STRING), '.', ',') AS DURATION",
        "replace(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING), '.', ',') AS Total_Cost",
        *more,
    )


def dial_lists(spark: SparkSession) -> DataFrame:
    """Outgoing dictionary: code lists joined by ', ' and the destination they stand for."""
    rows = [
        ("10, 101", "A"), ("12, 123", "B"), ("45", "C"), ("2, 29", "D"), ("300, 31", "E"), ("5999, 59", "F"),
    ]
    return spark.createDataFrame(rows, "dial_codes string, new_destination string")


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_name AS name",
        "c_mktsegment AS ticker",
        "CASE WHEN c_nationkey % 2 = 0 THEN 'USD' ELSE 'LCL' END AS currency",
        "c_custkey % 10 AS lots",
        "c_acctbal AS average_price",
        "c_acctbal * 2 AS expected_yield",
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "CAST(ts AS TIMESTAMP) AS ts", "event_type AS ticker", "value AS price", "event_id"
    )


def book(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_type AS instrument",
        "CASE WHEN user_id % 2 = 0 THEN 'bid' ELSE 'ask' END AS side",
        "value AS price",
        "event_id",
    )


# The same views as SQL text for the cross-check engine.
VIEW_SQL = {
    "lots": """
        SELECT l_orderkey AS lot_id, CAST(o_orderdate AS DATE) AS lot_placement_date,
          CASE WHEN l_shipdate >= o_orderdate THEN CAST(l_shipdate AS DATE) END AS lot_purchase_date,
          CASE WHEN l_shipdate < o_orderdate AND l_returnflag = 'R' THEN CAST(o_orderdate AS DATE) END
            AS subs_revocation_date,
          CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 1 END AS sys_revocation_flag,
          CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS subs_flag, l_returnflag AS traffic_type,
          l_suppkey AS subs_id_seller, CASE WHEN l_shipdate >= o_orderdate THEN o_custkey END AS subs_id_purchaser,
          s_nationkey AS branch_id_seller, c_nationkey AS branch_id_purchaser,
          l_partkey % 5 AS tp_id_seller, o_custkey % 5 AS tp_id_purchaser,
          l_quantity AS lot_volume, l_extendedprice AS lot_value
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
          JOIN supplier ON l_suppkey = s_suppkey""",
    "base_daily": """
        SELECT CAST(o_orderdate AS DATE) AS report_date, c_nationkey AS branch_id, o_custkey % 5 AS tp_id,
          CASE o_orderpriority WHEN '1-URGENT' THEN -1 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 ELSE 3 END
            AS calc_platform_id, count(*) AS flash_active_count
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3, 4""",
    "price_plan": "SELECT p_partkey AS tp_id, p_brand AS name_report, p_size % 2 AS bundle_flag FROM part",
    "region_dim": "SELECT n_nationkey AS region_id, n_name AS region_name FROM nation",
    "branch": """
        SELECT s_suppkey AS branch_id, s_name AS branch_name, s_nationkey AS region_id,
          r_name AS product_cluster_name, concat(CAST(n_nationkey AS VARCHAR), '00') AS code,
          n_name AS code_name, s_suppkey % 2 AS b2c_flag
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "plan_monthly": """
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS report_date,
          CASE o_orderstatus WHEN 'F' THEN 'AC' WHEN 'O' THEN 'BU' ELSE concat('F',
            CAST(quarter(o_orderdate) AS VARCHAR), '_', CAST(year(o_orderdate) AS VARCHAR), '_01') END AS param_1,
          o_orderpriority AS param_2, c_nationkey AS branch_id,
          CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS param_value
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3, 4""",
    "cdr": """
        SELECT concat('file_', CAST(l_suppkey % 4 AS VARCHAR), '_', strftime(l_shipdate, '%Y%m')) AS source_file,
          CASE l_suppkey % 4 WHEN 0 THEN strftime(l_shipdate, '%d.%m.%Y') WHEN 1 THEN strftime(l_shipdate, '%d.%m.%y')
            WHEN 2 THEN strftime(l_shipdate, '%d/%m/%Y') ELSE strftime(l_shipdate, '%m/%d/%Y %H:%M:%S') END
            AS START_DATE, CAST(l_shipdate AS DATE) AS true_date,
          concat(CASE l_returnflag WHEN 'A' THEN 'T' WHEN 'N' THEN 'H' ELSE 'Z' END, '_ABC N2 ', l_linestatus)
            AS Carrier1, CAST(l_partkey AS VARCHAR) AS Destination1,
          replace(CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS DURATION,
          replace(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS Total_Cost
        FROM lineitem""",
    "dial_lists": """
        SELECT * FROM (VALUES ('10, 101', 'A'), ('12, 123', 'B'), ('45', 'C'), ('2, 29', 'D'), ('300, 31', 'E'),
          ('5999, 59', 'F')) AS v(dial_codes, new_destination)""",
    "positions": """
        SELECT c_name AS name, c_mktsegment AS ticker,
          CASE WHEN c_nationkey % 2 = 0 THEN 'USD' ELSE 'LCL' END AS currency, c_custkey % 10 AS lots,
          c_acctbal AS average_price, c_acctbal * 2 AS expected_yield
        FROM customer""",
    "ticks": "SELECT ts, event_type AS ticker, value AS price, event_id FROM events",
    "book": """
        SELECT event_type AS instrument, CASE WHEN user_id % 2 = 0 THEN 'bid' ELSE 'ask' END AS side,
          value AS price, event_id FROM events""",
}


def with_views(names: str, body: str, extra: str = "") -> str:
    """``WITH <views> <body>`` for the views named in a space-separated list; ``extra`` adds more CTEs."""
    ctes = [f"{n} AS ({VIEW_SQL[n]})" for n in names.split()]
    if extra:
        ctes.append(extra)
    return f"WITH {', '.join(ctes)} {body}" if ctes else body
