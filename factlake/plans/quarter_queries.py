"""Queries over quarterly series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import quarters, series
from .registry import query, table
from .tables import ORDER_FACTS, QUARTER_SUMS, cents, order_facts, quarter_sums


def _totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("cik", "concept", "fiscal_year").orderBy("quarter").rowsBetween(Window.unboundedPreceding, 0)
    return quarter_sums(spark, sf_dir).filter("quarter <= 3").withColumn("value", F.sum("value").over(w)).withColumn("calculated", F.lit(False))


TOTALS = QUARTER_SUMS + """, y AS (
  SELECT cik, concept, fiscal_year, quarter, sum(value) OVER (PARTITION BY cik, concept, fiscal_year ORDER BY quarter)::BIGINT AS value FROM q WHERE quarter <= 3
)"""


@query(f"""WITH {TOTALS}, h AS (
  SELECT cik, fiscal_year, bool_or(quarter = 1) AS h1, bool_or(quarter = 2) AS h2 FROM y GROUP BY ALL
), p AS (
  SELECT cik, concept, fiscal_year, max(value) FILTER (quarter = 1) AS v1, max(value) FILTER (quarter = 2) AS v2 FROM y GROUP BY ALL
), r AS (
  SELECT y.cik, y.concept, y.fiscal_year, y.quarter, y.value,
    CASE WHEN quarter = 1 THEN value WHEN quarter = 2 AND h1 THEN value - coalesce(v1, 0) WHEN quarter = 3 AND h2 THEN value - coalesce(v2, v1, 0) END AS quarter_value
  FROM y JOIN h USING (cik, fiscal_year) JOIN p USING (cik, concept, fiscal_year)
) SELECT * FROM r WHERE quarter_value IS NOT NULL""")
def ytd_deaccumulate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H01, B03"""
    return quarters.deaccumulate(_totals(spark, sf_dir), ["cik", "concept"]).drop("calculated")


@query(f"""WITH {TOTALS} SELECT cik, concept, fiscal_year, quarter, value,
  value - coalesce(lag(value) OVER (PARTITION BY cik, concept, fiscal_year ORDER BY quarter), 0) AS quarter_value FROM y""")
def ytd_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H02"""
    return quarters.deaccumulate_simply(_totals(spark, sf_dir), ["cik", "concept"]).drop("calculated")


@query(f"""WITH {QUARTER_SUMS}, s AS (SELECT *, CASE WHEN concept LIKE '1%' THEN 'balancesheet' ELSE 'income' END AS statement_type FROM q),
a AS (SELECT cik, concept, statement_type, fiscal_year, sum(value)::BIGINT AS value FROM s GROUP BY ALL),
t AS (SELECT cik, concept, statement_type, fiscal_year, sum(value)::BIGINT AS sum3 FROM s WHERE quarter <= 3 GROUP BY ALL HAVING count(DISTINCT quarter) = 3)
SELECT cik, concept, statement_type, fiscal_year, CASE WHEN statement_type = 'balancesheet' THEN value ELSE value - sum3 END AS q4_value FROM a JOIN t USING (cik, concept, statement_type, fiscal_year)""")
def q4_from_annual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H05"""
    kind = F.when(F.col("concept").startswith("1"), "balancesheet").otherwise("income").alias("statement_type")
    q = quarter_sums(spark, sf_dir).select("*", kind)
    keys = ["cik", "concept", "statement_type", "fiscal_year"]
    return quarters.fourth_quarters(q.groupBy(*keys).agg(F.sum("value").alias("value")), q, keys)


@query(f"""WITH {QUARTER_SUMS}, c AS (SELECT cik, concept, fiscal_year, quarter, CASE WHEN quarter % 2 = 0 THEN 'cashflow' ELSE 'income' END AS statement_type, value FROM q),
r AS (SELECT * FROM c WHERE fiscal_year % 2 = 0)
SELECT c.* FROM c WHERE statement_type = 'cashflow' OR NOT EXISTS (SELECT 1 FROM r WHERE r.cik = c.cik AND r.concept = c.concept AND r.fiscal_year = c.fiscal_year AND r.quarter = c.quarter AND r.value = c.value)""")
def redundant_calculated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H04"""
    kind = F.when(F.col("quarter") % 2 == 0, "cashflow").otherwise("income").alias("statement_type")
    c = quarter_sums(spark, sf_dir).select("cik", "concept", "fiscal_year", "quarter", kind, "value")
    return quarters.redundant_calculated(c, c.filter("fiscal_year % 2 = 0"), ["cik", "concept", "fiscal_year", "quarter"])


@query(f"""WITH {QUARTER_SUMS}, b AS (SELECT * FROM q WHERE quarter = 3),
r AS (SELECT q.* FROM q SEMI JOIN (SELECT DISTINCT cik, concept, fiscal_year FROM b) x USING (cik, concept, fiscal_year) WHERE quarter < 3)
SELECT * FROM b UNION ALL SELECT * FROM r""")
def stored_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H03, F15"""
    q = quarter_sums(spark, sf_dir)
    keys = ["cik", "concept", "fiscal_year", "quarter"]
    batch = q.filter("quarter = 3")
    wanted = batch.select("cik", "concept", "fiscal_year", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("quarter") - 1)).alias("quarter"))
    return quarters.stored_and_new(batch, q.join(wanted, keys, "left_semi"), keys)


_PERIODS = QUARTER_SUMS + ", v AS (SELECT *, fiscal_year::VARCHAR || '-Q' || quarter::VARCHAR AS period FROM q), u AS (SELECT DISTINCT cik, period FROM v), s AS (SELECT cik, concept, min(period) AS a, max(period) AS z FROM v GROUP BY ALL)"


def _periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarter_sums(spark, sf_dir).withColumn("period", F.concat(F.col("fiscal_year").cast("string"), F.lit("-Q"), F.col("quarter").cast("string")))


@query(f"WITH {_PERIODS} SELECT s.cik, s.concept, u.period FROM s JOIN u ON u.cik = s.cik AND period > a AND period < z ANTI JOIN v ON v.cik = s.cik AND v.concept = s.concept AND v.period = u.period")
def interior_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H06, F13"""
    return series.interior_gaps(_periods(spark, sf_dir), ["cik"], ["cik", "concept"])


@query(f"WITH {_PERIODS} SELECT s.cik, s.concept, u.period FROM s JOIN u ON u.cik = s.cik ANTI JOIN v ON v.cik = s.cik AND v.concept = s.concept AND v.period = u.period")
def edge_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H08"""
    return series.interior_gaps(_periods(spark, sf_dir), ["cik"], ["cik", "concept"], edges=True)


@query("""WITH l AS (
  SELECT l_suppkey, l_returnflag, strftime(l_shipdate, '%Y-%m-%d') || '-' || lpad(l_orderkey::VARCHAR, 12, '0') || '-' || l_linenumber::VARCHAR AS period, round(l_extendedprice * 100)::BIGINT AS value FROM lineitem
), w AS (
  SELECT *, lag(period) OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY period) AS previous_period, lag(value) OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY period) AS previous_value FROM l
) SELECT * FROM w WHERE value > 1 AND previous_value > 1 AND greatest(value, previous_value) >= least(value, previous_value) * 20.0""")
def scale_jumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H07"""
    period = F.concat_ws("-", F.date_format("l_shipdate", "yyyy-MM-dd"), F.lpad(F.col("l_orderkey").cast("string"), 12, "0"), F.col("l_linenumber").cast("string"))
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", period.alias("period"), cents("l_extendedprice").alias("value"))
    return series.scale_jumps(rows, ["l_suppkey", "l_returnflag"], ratio=20.0)


_GAP_SQL = f"""WITH {QUARTER_SUMS}, d AS (
  SELECT cik, concept, make_date(fiscal_year, 3 * quarter - 2, 1) AS starts, last_day(make_date(fiscal_year, 3 * quarter, 1)) AS ends, value FROM q
), u AS (SELECT DISTINCT cik, ends FROM d), s AS (SELECT cik, min(ends) AS a, max(ends) AS z FROM d WHERE concept = '1-URGENT' GROUP BY cik),
g AS (SELECT s.cik, u.ends FROM s JOIN u ON u.cik = s.cik AND ends > a AND ends < z ANTI JOIN (SELECT * FROM d WHERE concept = '1-URGENT') x ON x.cik = s.cik AND x.ends = u.ends),
m AS (
  SELECT g.cik, g.ends, d.concept AS tag, d.value AS val, row_number() OVER (PARTITION BY g.cik, g.ends ORDER BY CASE d.concept WHEN '2-HIGH' THEN 0 ELSE 1 END) AS n
  FROM g JOIN d ON d.cik = g.cik AND d.ends = g.ends AND d.concept IN ('2-HIGH', '3-MEDIUM') AND d.ends - d.starts BETWEEN 80 AND 100
) SELECT cik, '1-URGENT' AS canonical, ends::VARCHAR AS period_end, tag, val FROM m WHERE n = 1"""


@query(_GAP_SQL)
def gap_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F09, H08"""
    start = F.make_date(F.col("fiscal_year").cast("int"), (F.col("quarter") * 3 - 2).cast("int"), F.lit(1))
    rows = quarter_sums(spark, sf_dir).withColumns({"start": start, "period_end": F.last_day(F.add_months(start, 2))})
    target = "1-URGENT"
    gaps = series.interior_gaps(rows, ["cik"], ["cik", "concept"], "period_end").filter(F.col("concept") == target)
    gaps = gaps.select("cik", F.col("concept").alias("canonical"), "period_end", F.lit(False).alias("is_instant"), F.lit(None).cast("int").alias("expected_days"))
    facts = rows.select("cik", F.col("concept").alias("tag"), "start", F.col("period_end").alias("end"), F.col("value").alias("val"), F.lit("10-Q").alias("form"), F.lit(None).cast("string").alias("frame"), F.lit("").alias("accession"))
    classes = spark.createDataFrame([(target, "2-HIGH", 0), (target, "3-MEDIUM", 1)], "canonical string, tag string, rank int")
    stored = rows.select("cik", F.col("concept").alias("canonical"), "period_end")
    filled = series.fill_gaps(gaps, facts, classes, stored, ["cik"], annual=False)
    return filled.select("cik", "canonical", F.col("period_end").cast("string").alias("period_end"), "tag", "val")


@query("""SELECT c_nationkey, c_mktsegment, CASE WHEN min(c_acctbal) > 0 THEN 1 ELSE -1 END AS sign FROM customer WHERE c_acctbal <> 0
GROUP BY c_nationkey, c_mktsegment HAVING min(c_acctbal) > 0 OR max(c_acctbal) < 0""")
def sign_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The signs"""
    return series.one_sign(table(spark, sf_dir, "customer"), ["c_nationkey", "c_mktsegment"], "c_acctbal")


@query("""WITH w AS (SELECT user_id, event_id, event_type AS status, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) SELECT user_id, event_id, status FROM w WHERE n = 1""")
def latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G13"""
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", F.col("event_type").alias("status"))
    return series.latest(rows, ["user_id"], [F.col("ts"), F.col("event_id")]).drop("ts")


@query(f"""WITH {ORDER_FACTS}, c AS (SELECT concept, fiscal_year, quarter, end_date, count(*) AS n FROM o GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY concept, fiscal_year, quarter ORDER BY n DESC, end_date) AS k FROM c)
SELECT concept, fiscal_year, quarter, end_date::VARCHAR AS period_date FROM r WHERE k = 1""")
def majority_period_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G09, F05"""
    out = series.majority(order_facts(spark, sf_dir), ["concept", "fiscal_year", "quarter"], "end_date", "period_date")
    return out.withColumn("period_date", F.col("period_date").cast("string"))


@query("""WITH d AS (SELECT l_suppkey, l_shipmonth, days FROM (SELECT l_suppkey, month(l_shipdate) AS l_shipmonth, (l_shipdate::DATE - o_orderdate::DATE) AS days,
  row_number() OVER (PARTITION BY l_suppkey, month(l_shipdate) ORDER BY l_shipdate::DATE DESC, l_shipdate::DATE - o_orderdate::DATE DESC) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey) WHERE n = 1)
SELECT l_suppkey, l_shipmonth::BIGINT AS end_month, days::BIGINT AS learned_days FROM d""")
def learned_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H08"""
    lines, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    rows = lines.join(o, lines["l_orderkey"] == o["o_orderkey"]).select("l_suppkey", F.to_date("l_shipdate").alias("end"), F.datediff("l_shipdate", "o_orderdate").alias("days"))
    out = series.learned_durations(rows, ["l_suppkey"], "end", "days")
    return out.select("l_suppkey", F.col("end_month").cast("bigint").alias("end_month"), F.col("learned_days").cast("bigint").alias("learned_days"))
