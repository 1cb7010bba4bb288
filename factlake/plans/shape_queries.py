"""Queries over roles, nested facts, sources and the stage graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import canonical
from ..operators import shape
from ..sources import files
from . import pipeline
from .quarter_queries import TOTALS, _totals
from .registry import query, table
from .statement_queries import _MATH, _once, lines
from .tables import LINE_FACTS, cents, line_facts

_ROLE_CASE = "CASE p_size % 6 WHEN 0 THEN 'CONSOLIDATED BALANCE SHEETS' WHEN 1 THEN 'Consolidated Statements of Cash Flows' WHEN 2 THEN 'BALANCE SHEETS (Parenthetical)' WHEN 3 THEN 'Combined Statements of Operations' WHEN 4 THEN 'Statements of Comprehensive Income' ELSE 'Details' END"


def _roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_size") % 6
    text = F.when(k == 0, "CONSOLIDATED BALANCE SHEETS").when(k == 1, "Consolidated Statements of Cash Flows").when(k == 2, "BALANCE SHEETS (Parenthetical)")
    text = text.when(k == 3, "Combined Statements of Operations").when(k == 4, "Statements of Comprehensive Income").otherwise("Details")
    return table(spark, sf_dir, "part").select(F.col("p_brand").alias("filing"), F.col("p_partkey").alias("role"), text.alias("description"), F.col("p_partkey").alias("position"), F.lit(False).alias("synthesised"))


_ROLES = f"""r AS (SELECT p_brand AS filing, p_partkey AS role, {_ROLE_CASE} AS description, p_type FROM part),
c AS (SELECT *, CASE description WHEN 'CONSOLIDATED BALANCE SHEETS' THEN 'balancesheet' WHEN 'BALANCE SHEETS (Parenthetical)' THEN 'balancesheet' WHEN 'Consolidated Statements of Cash Flows' THEN 'cashflow' WHEN 'Combined Statements of Operations' THEN 'income' WHEN 'Statements of Comprehensive Income' THEN 'comprehensive_income'
  ELSE CASE WHEN p_type = 'PROMO' THEN 'income' WHEN p_type = 'SMALL' THEN 'comprehensive_income' END END AS statement,
  50 + CASE WHEN lower(description) LIKE '%consolidated%' THEN -20 ELSE 0 END + CASE WHEN lower(description) LIKE '%combined%' THEN -10 ELSE 0 END + CASE WHEN lower(description) LIKE '%parenthetical%' THEN 30 ELSE 0 END AS priority FROM r)"""


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    concepts = table(spark, sf_dir, "part").select(F.col("p_brand").alias("filing"), F.col("p_partkey").alias("role"), F.concat(F.lit("us-gaap:"), F.col("p_type")).alias("concept"))
    keys = spark.createDataFrame([("income", "promo"), ("comprehensive_income", "Small")], "statement string, pattern string")
    return shape.classified_roles(_roles(spark, sf_dir), concepts, keys, ["filing"])


@query(f"WITH {_ROLES} SELECT filing, role, statement, CASE WHEN description <> 'Details' THEN 100.0 WHEN p_type = 'SMALL' THEN 2.0 ELSE 0.5 END::DOUBLE AS score, priority::BIGINT AS priority FROM c WHERE statement IS NOT NULL")
def role_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E02, E04"""
    return _classified(spark, sf_dir).select("filing", "role", "statement", F.col("score").cast("double").alias("score"), "priority")


@query(f"WITH {_ROLES} SELECT filing, statement, role FROM (SELECT *, row_number() OVER (PARTITION BY filing, statement ORDER BY priority, role) AS n FROM c WHERE statement IS NOT NULL) WHERE n = 1")
def statement_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E01, E03"""
    return shape.one_role_per_statement(_classified(spark, sf_dir), ["filing"]).select("filing", "statement", "role")


@query("""SELECT s AS raw, CASE WHEN s IN ('Income Statement', 'operations') THEN 'income' WHEN s = 'balance-sheet' THEN 'balancesheet' WHEN s = 'Cash Flows' THEN 'cashflow' ELSE 'other_thing' END AS name, count(*) AS n
FROM (SELECT ['Income Statement', 'operations', 'balance-sheet', 'Cash Flows', 'Other Thing'][event_id % 5 + 1] AS s FROM events) GROUP BY ALL""")
def statement_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E01"""
    raw = F.element_at(F.array(*map(F.lit, ("Income Statement", "operations", "balance-sheet", "Cash Flows", "Other Thing"))), (F.col("event_id") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "events").select(raw.alias("raw")).groupBy("raw", canonical.statement_name(F.col("raw")).alias("name")).agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey, (o_orderdate::DATE + 91)::VARCHAR AS period_key, round(o_totalprice * 100)::DOUBLE AS value FROM orders UNION ALL SELECT o_orderkey, o_orderdate::DATE::VARCHAR, -5.0 FROM orders""")
def period_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E10, E11"""
    day = F.to_date("o_orderdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.create_map(F.concat_ws(" to ", day.cast("string"), F.date_add(day, 91).cast("string")), cents("o_totalprice").cast("string"), F.concat(day.cast("string"), F.lit(" (Q1)")), F.lit("(5)"), F.lit("2020-01-01"), F.lit("n/a")).alias("periods"))
    return shape.period_values(o, ["o_orderkey"])


@query(f"WITH {LINE_FACTS} SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey FROM f WHERE p_size % 3 > 0 AND NOT EXISTS (SELECT 1 FROM f g WHERE g.l_orderkey = f.l_orderkey AND g.p_type = f.p_type AND g.l_returnflag = 'A')")
def outside_presentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E17, D17"""
    f = line_facts(spark, sf_dir).select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey", "l_suppkey", F.col("p_type").alias("concept"), (F.col("p_size") % 3).alias("n_dims"), "l_returnflag")
    return shape.outside_presentation(f, f.filter("l_returnflag = 'A'"), ["l_orderkey"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("""SELECT n_regionkey::BIGINT AS n_regionkey, 'domain-member' AS arcrole, 'axis' || (n_nationkey % 2)::VARCHAR AS parent, string_agg(DISTINCT n_name, ',' ORDER BY n_name) AS members FROM nation GROUP BY ALL""")
def dimension_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E16"""
    n = table(spark, sf_dir, "nation").select(F.col("n_regionkey").cast("bigint").alias("n_regionkey"), F.lit("domain-member").alias("arcrole"), F.concat(F.lit("axis"), (F.col("n_nationkey") % 2).cast("string")).alias("parent"), F.col("n_name").alias("child"))
    return shape.dimension_sets(n.unionByName(n), ["n_regionkey"]).withColumn("members", F.array_join("members", ","))


@query("""WITH f AS (SELECT o_custkey, year(o_orderdate) AS period, o_orderkey AS position, round(o_totalprice * 100)::BIGINT AS value, o_orderkey % 3 AS n_dims FROM orders), p AS (SELECT o_custkey, max(period) AS p FROM f GROUP BY ALL),
x AS (SELECT f.* FROM f JOIN p USING (o_custkey) WHERE period <> p) SELECT o_custkey, period::BIGINT AS period, position, value FROM x WHERE n_dims > 0
UNION ALL SELECT o_custkey, period, position, value FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, period ORDER BY position) AS n FROM x WHERE n_dims = 0) WHERE n = 1""")
def comparative_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E19"""
    f = table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").cast("bigint").alias("period"), F.col("o_orderkey").alias("position"), cents("o_totalprice").alias("value"), (F.col("o_orderkey") % 3).alias("n_dims"))
    return shape.comparative_facts(f, f.groupBy("o_custkey").agg(F.max("period").alias("period")), ["o_custkey"]).select("o_custkey", "period", "position", "value")


@query("""WITH c AS (SELECT o_custkey, CASE WHEN o_orderkey % 4 = 0 THEN 'bad' ELSE year(o_orderdate)::VARCHAR END AS value, o_orderkey % 2 AS dims, o_orderdate::DATE AS e FROM orders)
SELECT o_custkey, arg_max(value, (CASE WHEN value <> 'bad' THEN 50 ELSE -50 END + CASE WHEN dims = 0 THEN 10 ELSE 0 END + (e - DATE '1970-01-01') / 1e6, value)) AS value FROM c GROUP BY o_custkey""")
def entity_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C12"""
    k = F.col("o_orderkey")
    c = table(spark, sf_dir, "orders").select("o_custkey", F.when(k % 4 == 0, "bad").otherwise(F.year("o_orderdate").cast("string")).alias("value"), (k % 2).alias("n_dims"), F.to_date("o_orderdate").alias("end"))
    return shape.best_entity_value(c, ["o_custkey"])


@query("""SELECT lpad(c_custkey::VARCHAR, 10, '0') AS cik, c_name AS name, c_mktsegment AS sic, 'T' || c_custkey::VARCHAR AS ticker, '1231' AS fiscal_year_end FROM customer""")
def company_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """companies"""
    raw = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cik"), F.concat(F.lit(" "), F.col("c_name")).alias("name"), F.col("c_mktsegment").alias("sic"), F.array(F.concat(F.lit("T"), F.col("c_custkey").cast("string"))).alias("tickers"), F.array(F.lit("X")).alias("exchanges"), F.lit("1231").alias("fiscal_year_end"))
    return shape.company_rows(raw).select("cik", "name", "industry.sic", F.get("market_info.tickers", F.lit(0)).alias("ticker"), "corporate_info.fiscal_year_end")


@query("""WITH f AS (SELECT o_custkey, list(o_orderkey ORDER BY o_orderkey) AS k FROM orders GROUP BY o_custkey) SELECT lpad(o_custkey::VARCHAR, 10, '0') AS cik, unnest(k)::VARCHAR AS accession, '10-Q' AS form, true AS is_xbrl FROM f""")
def submissions_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recent filings, rows written as submission documents and parsed again"""
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_list("o_orderkey")).alias("k"))
    each = lambda v: F.transform("k", lambda _: F.lit(v))
    recent = F.struct(each("10-Q").alias("form"), F.transform("k", lambda x: x.cast("string")).alias("accessionNumber"), each("2024-01-01").alias("filingDate"), each("2023-12-31").alias("reportDate"), each(1).alias("isXBRL"), each("a.htm").alias("primaryDocument"))
    doc = F.to_json(F.struct(F.col("o_custkey").cast("string").alias("cik"), F.struct(recent.alias("recent")).alias("filings")))
    raw = o.select(F.from_json(doc, files.FILINGS_SCHEMA).alias("d")).select("d.*")
    return files.filing_rows(raw).select("cik", "accession", "form", "is_xbrl")


@query("""SELECT lpad(c_custkey::VARCHAR, 10, '0') AS cik, 'us-gaap:' || c_mktsegment AS tag, 'USD' AS unit, '2023-12-31' AS end_date, c_acctbal AS val FROM customer""")
def company_facts_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A04"""
    row = F.struct(F.lit("2023-01-01").alias("start"), F.lit("2023-12-31").alias("end"), F.col("c_acctbal").alias("val"), F.lit("10-K").alias("form"))
    facts = F.create_map(F.lit("us-gaap"), F.create_map(F.col("c_mktsegment"), F.struct(F.lit("l").alias("label"), F.create_map(F.lit("USD"), F.array(row)).alias("units"))))
    doc = F.to_json(F.struct(F.col("c_custkey").alias("cik"), F.col("c_name").alias("entityName"), facts.alias("facts")))
    raw = table(spark, sf_dir, "customer").select(F.from_json(doc, files.COMPANY_FACTS_SCHEMA).alias("d")).select("d.*")
    return files.fact_rows(raw).select("cik", "tag", "unit", F.col("end").cast("string").alias("end_date"), "val")


@query("SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def point_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report of the first twenty"""
    return shape.point_scan(table(spark, sf_dir, "orders"), {"o_orderstatus": "F"}, ["o_orderkey", "o_orderpriority", "o_totalprice"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 20)


@query(f"""WITH {_MATH}, o AS (SELECT *, row_number() OVER (PARTITION BY filing, concept ORDER BY position) AS n FROM s), c AS (SELECT filing, statement_type, NOT bool_or(CASE WHEN statement_type = 'income' THEN regexp_matches(lower(concept), 'revenue|operatingincome|netincome') ELSE regexp_matches(lower(concept), 'asset|liabilit|equity') END) AS missing FROM o WHERE n = 1 GROUP BY ALL)
SELECT c.filing, CASE WHEN missing OR m.filing IS NOT NULL THEN 'skip' ELSE 'write' END AS action, CASE WHEN missing OR m.filing IS NOT NULL THEN '' ELSE c.statement_type END AS statements, CASE WHEN missing THEN '' ELSE c.statement_type END AS permitted FROM c LEFT JOIN m USING (filing)""")
def filing_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrich, check, decide; the decision on every filing"""
    frames = pipeline.run(pipeline.FILING_STAGE, {"lines": _once(lines(spark, sf_dir))})
    return frames["decision"].withColumns({"statements": F.array_join("statements", ","), "permitted": F.array_join("permitted", ",")})


@query(f"""WITH {TOTALS}, h AS (SELECT cik, fiscal_year, bool_or(quarter = 1) AS h1, bool_or(quarter = 2) AS h2 FROM y GROUP BY ALL), p AS (SELECT cik, concept, fiscal_year, max(value) FILTER (quarter = 1) AS v1, max(value) FILTER (quarter = 2) AS v2 FROM y GROUP BY ALL),
r AS (SELECT y.cik, concept, y.fiscal_year::VARCHAR || '-' || quarter::VARCHAR AS period, CASE WHEN quarter = 1 THEN value WHEN quarter = 2 AND h1 THEN value - coalesce(v1, 0) WHEN quarter = 3 AND h2 THEN value - coalesce(v2, v1, 0) END AS value FROM y JOIN h USING (cik, fiscal_year) JOIN p USING (cik, concept, fiscal_year)),
v AS (SELECT * FROM r WHERE value IS NOT NULL), s AS (SELECT cik, concept, min(period) AS a, max(period) AS z FROM v GROUP BY ALL), u AS (SELECT DISTINCT cik, period FROM v),
g AS (SELECT s.cik, s.concept, u.period FROM s JOIN u ON u.cik = s.cik AND period > a AND period < z ANTI JOIN v ON v.cik = s.cik AND v.concept = s.concept AND v.period = u.period),
f AS (SELECT g.*, v.value FROM g JOIN v ON v.cik = g.cik AND v.period = g.period AND v.concept = '2-HIGH'), w AS (SELECT cik, concept, period, value FROM v UNION ALL SELECT * FROM f),
l AS (SELECT g.* FROM g ANTI JOIN f USING (cik, concept, period)), j AS (SELECT *, lag(value) OVER (PARTITION BY cik, concept ORDER BY period) AS prev FROM w), k AS (SELECT cik FROM j WHERE abs(value) > 1 AND abs(prev) > 1 AND greatest(abs(value), abs(prev)) >= 500 * least(abs(value), abs(prev)))
SELECT c.cik, (SELECT count(*) FROM g WHERE g.cik = c.cik) AS gaps, (SELECT count(*) FROM f WHERE f.cik = c.cik) AS filled, (SELECT count(*) FROM l WHERE l.cik = c.cik) AS "left", (SELECT count(*) FROM k WHERE k.cik = c.cik) AS jumps,
  CASE WHEN EXISTS (SELECT 1 FROM l WHERE l.cik = c.cik) OR EXISTS (SELECT 1 FROM k WHERE k.cik = c.cik) THEN 'findings_detected' ELSE 'clean' END AS status FROM (SELECT DISTINCT cik FROM y) c""")
def company_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deaccumulate, fill gaps from a provider of facts, audit, finalise"""
    totals = _totals(spark, sf_dir)
    facts = pipeline.deaccumulated({"totals": totals})["quarterly"].filter("concept = '2-HIGH'")
    facts = facts.select("cik", F.concat_ws("-", "fiscal_year", "quarter").alias("period"), F.col("quarter_value").alias("val"))
    frames = pipeline.run(pipeline.company_stage(lambda gaps: gaps.join(facts, ["cik", "period"])), {"totals": totals})
    return frames["companies"]
