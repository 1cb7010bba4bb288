"""Filing-shaped views of the driver's tables, in Spark and in SQL.

Company = customer, filing = order, fact = line item. Money is in whole cents,
so sums don't depend on order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import table

CODES = ("1231", "0630", "0131", "0229")


def cents(column: str):
    return F.round(F.col(column) * 100).cast("bigint")


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cik, accession, concept, end_date, fiscal_year, quarter, value (cents)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("cik"),
        F.lpad(F.col("o_orderkey").cast("string"), 10, "0").alias("accession"),
        F.col("o_orderpriority").alias("concept"),
        F.to_date("o_orderdate").alias("end_date"),
        F.year("o_orderdate").cast("bigint").alias("fiscal_year"),
        F.quarter("o_orderdate").cast("bigint").alias("quarter"),
        cents("o_totalprice").alias("value"),
    )


ORDER_FACTS = """
o AS (
  SELECT lpad(o_custkey::VARCHAR, 10, '0') AS cik, lpad(o_orderkey::VARCHAR, 10, '0') AS accession, o_orderpriority AS concept,
    o_orderdate::DATE AS end_date, year(o_orderdate) AS fiscal_year, quarter(o_orderdate) AS quarter, round(o_totalprice * 100)::BIGINT AS value
  FROM orders
)"""


def quarter_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cik, concept, fiscal_year, quarter, value."""
    return order_facts(spark, sf_dir).groupBy("cik", "concept", "fiscal_year", "quarter").agg(F.sum("value").alias("value"))


QUARTER_SUMS = (
    ORDER_FACTS
    + """, q AS (
  SELECT cik, concept, fiscal_year, quarter, sum(value)::BIGINT AS value FROM o GROUP BY ALL
)"""
)


def line_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item with its order's and part's columns."""
    lines, o, p = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "part"))
    return lines.join(o, lines["l_orderkey"] == o["o_orderkey"]).join(p, lines["l_partkey"] == p["p_partkey"])


LINE_FACTS = "f AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"


def with_calendar(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with the fiscal-year-end code and convention of their customer."""
    code = F.element_at(F.array(*[F.lit(c) for c in CODES]), (F.col("c_nationkey") % 4 + 1).cast("int"))
    c = customers.select("c_custkey", code.alias("code"), F.when(F.col("c_custkey") % 2 == 0, "start").otherwise("end").alias("convention"))
    return orders.join(c, orders["o_custkey"] == c["c_custkey"])


WITH_CALENDAR = """
k AS (
  SELECT *, o_orderdate::DATE AS d, CASE c_nationkey % 4 WHEN 0 THEN '1231' WHEN 1 THEN '0630' WHEN 2 THEN '0131' ELSE '0229' END AS code,
    CASE WHEN c_custkey % 2 = 0 THEN 'start' ELSE 'end' END AS convention
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""


def fiscal_sql(day: str, code: str = "code", convention: str = "convention") -> tuple[str, str]:
    """SQL for the fiscal year and quarter of a date."""

    def end(y: str) -> str:
        return f"try_cast(lpad(({y} + CASE WHEN {convention} = 'start' AND substr({code}, 1, 2) IN ('01', '02') THEN 1 ELSE 0 END)::VARCHAR, 4, '0') || '-' || substr({code}, 1, 2) || '-' || substr({code}, 3, 2) AS DATE)"

    inside, gaps = [], []
    for k in (-1, 0, 1):
        y = f"(year({day}) + {k})"
        inside.append(f"CASE WHEN {day} >= {end(f'({y} - 1)')} + 1 - 7 AND {day} <= {end(y)} + 7 THEN {y} END")
        gaps.append(f"CASE WHEN {end(y)} IS NOT NULL THEN {{'gap': abs({day} - {end(y)}), 'y': {y}}} END")
    year = f"coalesce({', '.join(inside)}, list_sort(list_filter([{', '.join(gaps)}], lambda x: x IS NOT NULL))[1].y)"
    start = f"({end('(fiscal_year - 1)')} + 1)"
    ends = ", ".join(f"{{'gap': abs({day} - (({start} + INTERVAL {3 * q} MONTH)::DATE - 1)), 'q': {q}}}" for q in (1, 2, 3, 4))
    quarter = f"CASE WHEN fiscal_year IS NULL OR {start} IS NULL THEN CASE WHEN fiscal_year IS NOT NULL THEN 1 END ELSE list_sort([{ends}])[1].q END"
    return year, quarter
