"""The star schema seen as assessments: orders are tests, lines are repetitions, customers are profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsonwalk import wide_to_long
from ..operators.fact import first_of

METRICS = ["quantity", "extendedprice", "discount", "tax"]
IDS = ["profile_id", "team_group_id", "assessment_family", "test_id", "test_type", "test_date", "side", "rep_number"]
_LINE = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per order and line number, the first by all its columns; dealt by order, so that what is done by order needs no other shuffle."""
    return first_of(table(spark, sf_dir, "lineitem").repartition("l_orderkey"), ["l_orderkey", "l_linenumber"], [F.asc_nulls_last(c) for c in _LINE])


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    customer = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    side = F.when(F.col("l_returnflag") == "R", "right").when(F.col("l_returnflag") == "A", "left")
    return lines(spark, sf_dir).join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("profile_id"), F.col("n_regionkey").alias("team_group_id"), F.col("c_mktsegment").alias("assessment_family"), F.col("o_orderkey").alias("test_id"),
        F.col("o_orderpriority").alias("test_type"), F.col("o_orderdate").cast("timestamp").alias("test_date"), side.alias("side"), F.col("l_linenumber").alias("rep_number"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("extendedprice"), F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"),
    )


def long(rows: DataFrame) -> DataFrame:
    return wide_to_long(rows, IDS, METRICS)


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long(wide(spark, sf_dir))


_SIDE = "CASE l_returnflag WHEN 'R' THEN 'right' WHEN 'A' THEN 'left' END"
WIDE_SQL = f"""
lines AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(_LINE)}) AS n FROM lineitem) WHERE n = 1),
wide AS MATERIALIZED (SELECT o_custkey AS profile_id, n_regionkey AS team_group_id, c_mktsegment AS assessment_family, o_orderkey AS test_id,
  o_orderpriority AS test_type, o_orderdate AS test_date, {_SIDE} AS side, l_linenumber AS rep_number, l_quantity AS quantity,
  l_extendedprice AS extendedprice, l_discount AS discount, l_tax AS tax
  FROM lines JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""
FACT_SQL = WIDE_SQL + ",\nfact AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT {', '.join(IDS)}, '{m}' AS metric_name, {m} AS metric_value FROM wide" for m in METRICS) + ")"


def limits_sql(factor: float) -> str:
    return (
        FACT_SQL
        + f""",
limits AS MATERIALIZED (SELECT assessment_family, team_group_id, test_type, metric_name, side, count(metric_value) AS n_rows, quantile_cont(metric_value, 0.99) AS p99,
  quantile_cont(metric_value, 0.25) AS p25, quantile_cont(metric_value, 0.99) * {factor} AS upper_limit, quantile_cont(metric_value, 0.25) AS lower_limit FROM fact GROUP BY ALL),
labelled AS MATERIALIZED (SELECT f.*, coalesce(f.metric_value > l.upper_limit, false) AS is_above, coalesce(f.metric_value < l.lower_limit, false) AS is_below
  FROM fact f LEFT JOIN limits l ON f.assessment_family = l.assessment_family AND f.team_group_id = l.team_group_id AND f.metric_name = l.metric_name
  AND f.test_type IS NOT DISTINCT FROM l.test_type AND f.side IS NOT DISTINCT FROM l.side)"""
    )
