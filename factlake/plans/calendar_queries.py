"""Queries over period text and the fiscal calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import periods as P
from .registry import query, table
from .tables import WITH_CALENDAR, fiscal_sql, with_calendar

_YEAR, _QUARTER = fiscal_sql("d")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_calendar(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")).withColumn("d", F.to_date("o_orderdate"))


@query(f"WITH {WITH_CALENDAR}, y AS (SELECT *, {_YEAR} AS fiscal_year FROM k) SELECT o_orderkey, fiscal_year::BIGINT AS fiscal_year, ({_QUARTER})::BIGINT AS fiscal_quarter FROM y")
def fiscal_year_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C01, C02, C03, C04, C05, C06"""
    o = _orders(spark, sf_dir)
    year = P.fiscal_year_of(F.col("d"), F.col("code"), F.col("convention"))
    quarter = P.fiscal_quarter_of(F.col("d"), F.col("code"), F.col("convention"))
    return o.select("o_orderkey", year.cast("bigint").alias("fiscal_year"), quarter.cast("bigint").alias("fiscal_quarter"))


_END_YEAR, _ = fiscal_sql("d", "code", "'end'")
_START_YEAR, _ = fiscal_sql("d", "code", "'start'")


@query(f"""WITH {WITH_CALENDAR}, a AS (
  SELECT o_custkey, d, code, CASE WHEN o_custkey % 3 = 0 THEN year(d) - 1 ELSE year(d) END AS labelled, row_number() OVER (PARTITION BY o_custkey ORDER BY d DESC, o_orderkey DESC) AS n FROM k
), v AS (SELECT o_custkey, coalesce({_END_YEAR} = labelled, false) AS e, coalesce({_START_YEAR} = labelled, false) AS s FROM a WHERE n <= 8)
SELECT o_custkey, count(*) FILTER (e) AS ends, count(*) FILTER (s) AS starts,
  CASE WHEN count(*) FILTER (e) > count(*) FILTER (s) THEN 'end' WHEN count(*) FILTER (e) < count(*) FILTER (s) THEN 'start' END AS convention FROM v GROUP BY o_custkey""")
def convention_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C08"""
    o = _orders(spark, sf_dir)
    last = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.col("d").desc(), F.col("o_orderkey").desc()))
    labelled = F.when(F.col("o_custkey") % 3 == 0, F.year("d") - 1).otherwise(F.year("d"))
    o = o.withColumns({"n": last, "labelled": labelled}).filter("n <= 8")
    as_end, as_start = (F.coalesce(P.fiscal_year_of(F.col("d"), F.col("code"), c) == F.col("labelled"), F.lit(False)) for c in ("end", "start"))
    votes = o.groupBy("o_custkey").agg(F.count_if(as_end).alias("ends"), F.count_if(as_start).alias("starts"))
    return votes.withColumn("convention", F.when(F.col("ends") > F.col("starts"), "end").when(F.col("ends") < F.col("starts"), "start"))


@query("""WITH d AS (SELECT l_orderkey, l_linenumber, o_orderdate::DATE AS s, l_shipdate::DATE AS e FROM lineitem JOIN orders ON l_orderkey = o_orderkey), m AS (SELECT *, (e - s) / 30.4 AS months FROM d)
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, (e - s)::BIGINT AS days, abs(months - 3.0) <= 0.35 AS quarterly, abs(months - 12.0) <= 1.0 AS annual,
  abs(e - (s + 91)) <= 7 AND abs(months - 3.0) <= 0.35 AS matches, e > s AND e - s <= 548 AND year(e) BETWEEN 1990 AND 2004 AS valid FROM m""")
def duration_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B03, B27, C16"""
    lines, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    s, e = F.to_date("o_orderdate"), F.to_date("l_shipdate")
    months = P.months_between_days(s, e)
    return lines.join(o, lines["l_orderkey"] == o["o_orderkey"]).select(
        "l_orderkey",
        F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        F.datediff(e, s).cast("bigint").alias("days"),
        P.is_quarterly_length(months).alias("quarterly"),
        P.is_annual_length(months).alias("annual"),
        P.matches_form(s, e, F.date_add(s, 91), F.lit("10-Q")).alias("matches"),
        P.valid_dates(s, e, F.to_date(F.lit("2002-01-01"))).alias("valid"),
    )


@query("""WITH p AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_orderdate::DATE::VARCHAR || ' to ' || (o_orderdate::DATE + 91)::VARCHAR WHEN 1 THEN o_orderdate::DATE::VARCHAR || ' (Q1)'
  WHEN 2 THEN year(o_orderdate)::VARCHAR || '-Q' || quarter(o_orderdate)::VARCHAR ELSE year(o_orderdate)::VARCHAR END AS period FROM orders)
SELECT o_orderkey, period,
  (CASE WHEN contains(period, ' to ') THEN try_cast(substr(split_part(period, ' to ', 1), 1, 10) AS DATE) END)::VARCHAR AS start_date,
  (CASE WHEN o_orderkey % 4 = 0 THEN try_cast(substr(split_part(period, ' to ', 2), 1, 10) AS DATE) WHEN o_orderkey % 4 = 1 THEN try_cast(substr(period, 1, 10) AS DATE) WHEN o_orderkey % 4 = 3 THEN NULL END)::VARCHAR AS end_date,
  (CASE WHEN contains(period, ' to ') THEN 91 END)::BIGINT AS days,
  coalesce(nullif(regexp_extract(period, ' to (\\d{4}-\\d{2}-\\d{2})', 1), ''), nullif(regexp_extract(period, '^(\\d{4}-\\d{2}-\\d{2})', 1), ''), period) AS period_key,
  coalesce(nullif(regexp_extract(period, '^(\\d{4}-\\d{2}-\\d{2})', 1), ''), period) AS plain_key,
  (CASE o_orderkey % 4 WHEN 2 THEN last_day(make_date(substr(period, 1, 4)::INT, 3 * substr(period, 7, 1)::INT, 1)) WHEN 3 THEN make_date(period::INT, 12, 31) ELSE try_cast(substr(period, 1, 10) AS DATE) END)::VARCHAR AS orderable
FROM p""")
def period_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B01, B04, B05, B06, B07, B08"""
    day, year = F.to_date("o_orderdate"), F.year("o_orderdate").cast("string")
    k = F.col("o_orderkey") % 4
    text = F.when(k == 0, F.concat_ws(" to ", day.cast("string"), F.date_add(day, 91).cast("string"))).when(k == 1, F.concat(day.cast("string"), F.lit(" (Q1)")))
    text = text.when(k == 2, F.concat(year, F.lit("-Q"), F.quarter("o_orderdate").cast("string"))).otherwise(year)
    o = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("period"))
    p = F.col("period")
    end = F.when(F.col("o_orderkey") % 4 < 2, P.period_end(p))
    return o.select(
        "o_orderkey", "period", P.period_start(p).cast("string").alias("start_date"), end.cast("string").alias("end_date"), P.duration_days(p).cast("bigint").alias("days"),
        P.period_key(p).alias("period_key"), P.plain_key(p).alias("plain_key"), P.orderable_period(p).cast("string").alias("orderable"),
    )


@query("""WITH t AS (SELECT event_id, CASE event_type WHEN 'click' THEN 'Quarterly' WHEN 'error' THEN 'yearly' WHEN 'purchase' THEN ' Q3 ' WHEN 'signup' THEN '' ELSE event_type END AS raw,
  CASE event_type WHEN 'click' THEN 'Three Months Ended March' WHEN 'error' THEN 'Nine Months Ended' WHEN 'purchase' THEN 'Fiscal Year Ended' ELSE 'As of' END AS heading FROM events)
SELECT event_id, CASE lower(trim(raw)) WHEN 'quarterly' THEN 'quarterly' WHEN 'yearly' THEN 'annual' WHEN 'q3' THEN 'quarterly' WHEN '' THEN 'unknown' ELSE lower(trim(raw)) END AS period_type,
  CASE heading WHEN 'Three Months Ended March' THEN 'quarterly' WHEN 'Nine Months Ended' THEN 'cumulative' WHEN 'Fiscal Year Ended' THEN 'annual' ELSE 'other' END AS heading_class FROM t""")
def period_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B09, B10"""
    e = F.col("event_type")
    raw = F.when(e == "click", "Quarterly").when(e == "error", "yearly").when(e == "purchase", " Q3 ").when(e == "signup", "").otherwise(e)
    heading = F.when(e == "click", "Three Months Ended March").when(e == "error", "Nine Months Ended").when(e == "purchase", "Fiscal Year Ended").otherwise("As of")
    return table(spark, sf_dir, "events").select("event_id", P.period_type(raw).alias("period_type"), P.period_class(heading).alias("heading_class"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'FY ' || year(o_orderdate)::VARCHAR ELSE 'Q' || quarter(o_orderdate)::VARCHAR || ' ' || year(o_orderdate)::VARCHAR END AS label,
  CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate::DATE ELSE ((o_orderdate::DATE - INTERVAL (CASE WHEN o_orderkey % 5 = 0 THEN 12 ELSE 3 END) MONTH)::DATE + 1) END::VARCHAR AS start_date,
  CASE WHEN o_orderkey % 7 = 0 THEN 2010 WHEN o_orderkey % 7 = 1 THEN year(o_orderdate) WHEN dayofyear(o_orderdate) <= 7 THEN year(o_orderdate) - 1 ELSE year(o_orderdate) END::BIGINT AS fiscal_year FROM orders""")
def reporting_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C11"""
    day, k = F.to_date("o_orderdate"), F.col("o_orderkey")
    year, annual = F.year("o_orderdate"), k % 5 == 0
    stated = F.when(k % 7 == 0, 2010).when(k % 7 == 1, year)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        P.display_label(year, F.when(~annual, F.quarter("o_orderdate"))).alias("label"),
        P.standard_start(F.when(k % 2 == 0, day), day, annual).cast("string").alias("start_date"),
        P.fiscal_year_chain(stated, day, F.lit("1231"), F.lit("")).cast("bigint").alias("fiscal_year"),
    )
