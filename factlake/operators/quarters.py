"""Quarterly values from year-to-date values, and fourth quarters from annual ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Concepts whose fourth quarter is the annual value, not a difference.
SHARE_COUNT_PATTERN = r"(?i)(weightedaveragenumberof|sharesoutstanding)"


def _at(quarter: int, what: Column) -> Column:
    return F.max(F.when(F.col("quarter") == quarter, what))


def deaccumulate(values: DataFrame, series: list[str], year: str = "fiscal_year", value: str = "value") -> DataFrame:
    """Adds ``quarter_value`` to year-to-date rows (series, fiscal_year, quarter 1 to 3, value, calculated).

    One row per series, year and quarter (one that isn't calculated is
    preferred). Q1 stays; Q2 is its total less Q1; Q3 is its total less Q2's
    total, or less nothing if the series lacks both. Rows already calculated
    pass. A quarter whose predecessor is absent from the whole company and year
    isn't emitted; a series that is absent from a predecessor that exists counts
    as zero there. ``series``: the columns of a series, the company first.
    """
    first = Window.partitionBy(*series, year, "quarter").orderBy(F.col("calculated").cast("int"), value)
    rows = values.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")
    own, company = Window.partitionBy(*series, year), Window.partitionBy(series[0], year)
    # A calculated predecessor holds the quarter alone, so totals are rebuilt from the left.
    is_total = ~F.col("calculated")
    q1 = _at(1, F.col(value)).over(own)
    q2 = _at(2, F.col(value)).over(own)
    q2_is_total = F.max(F.when((F.col("quarter") == 2) & is_total, True)).over(own)
    has1, has2 = (F.max(F.col("quarter") == q).over(company) for q in (1, 2))
    zero = F.lit(0).cast(values.schema[value].dataType)
    upto2 = F.when(q2.isNull(), F.coalesce(q1, zero)).when(F.coalesce(q2_is_total, F.lit(False)), q2).otherwise(F.coalesce(q1, zero) + q2)
    out = (
        F.when(F.col("calculated") | (F.col("quarter") == 1), F.col(value))
        .when((F.col("quarter") == 2) & has1, F.col(value) - F.coalesce(q1, zero))
        .when((F.col("quarter") == 3) & has2, F.col(value) - upto2)
    )
    return rows.withColumn("quarter_value", out).filter("quarter_value is not null")


def deaccumulate_simply(values: DataFrame, series: list[str], year: str = "fiscal_year", value: str = "value") -> DataFrame:
    """Each total less the one before in the year; a missing one counts as zero."""
    w = Window.partitionBy(*series, year).orderBy("quarter")
    return values.withColumn("quarter_value", F.col(value) - F.coalesce(F.lag(value).over(w), F.lit(0).cast(values.schema[value].dataType)))


def fourth_quarters(annual: DataFrame, quarterly: DataFrame, keys: list[str], statement: str = "statement_type") -> DataFrame:
    """keys + value of Q4: only where the annual value and Q1 to Q3 exist.

    Balance sheets and share counts take the annual value, others annual less
    the three quarters.
    """
    q = quarterly.filter("quarter in (1, 2, 3)").groupBy(*keys).agg(F.count_distinct("quarter").alias("n"), F.sum("value").alias("sum3")).filter("n = 3")
    level = (F.col(statement) == "balancesheet") | F.col("concept").rlike(SHARE_COUNT_PATTERN)
    return annual.join(q, keys).select(*[annual[k] for k in keys], F.when(level, F.col("value")).otherwise(F.col("value") - F.col("sum3")).alias("q4_value"))


def redundant_calculated(calculated: DataFrame, reported: DataFrame, keys: list[str]) -> DataFrame:
    """Calculated rows to store: income rows that a reported row already says go, cash-flow rows all stay."""
    same = [*keys, "value"]
    stays = calculated.filter("statement_type = 'cashflow'")
    return calculated.filter("statement_type <> 'cashflow'").join(reported.select(*same).distinct(), same, "left_anti").unionByName(stays)


def stored_and_new(batch: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """A batch with the stored quarters of the same years that it lacks."""
    return batch.unionByName(stored.join(batch.select(*keys).distinct(), keys, "left_anti").select(*batch.columns))
