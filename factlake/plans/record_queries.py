"""Queries over periods and labels of filings, summaries, fills, archives and queues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import periods as P
from ..operators import cache, concepts, documents, guidance, hierarchy, series, shape, statements
from ..sources import files, landing
from ..streaming import queue
from .registry import query, table
from .tables import ORDER_FACTS, WITH_CALENDAR, cents, fiscal_sql, order_facts, with_calendar

_YEAR, _QUARTER = fiscal_sql("d")
_Y_END, _Q_END = fiscal_sql("d", "code", "'end'")


def _calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_calendar(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")).withColumn("d", F.to_date("o_orderdate"))


@query(f"""WITH {WITH_CALENDAR}, y AS (SELECT *, {_YEAR} AS fiscal_year FROM k), z AS (SELECT *, ({_QUARTER}) AS q FROM y)
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'annual' ELSE 'quarterly' END AS period_type, (CASE WHEN o_orderkey % 5 = 0 THEN 2001 WHEN o_orderkey % 13 <> 0 THEN fiscal_year END)::BIGINT AS fiscal_year,
  (CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN 2 WHEN o_orderkey % 13 <> 0 THEN q END)::BIGINT AS quarter FROM z""")
def filing_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stated year for every fifth, a stated quarter for every seventh, no report date for every thirteenth"""
    k = F.col("o_orderkey")
    p = P.filing_period(F.when(k % 3 == 0, "20-F").otherwise("10-Q"), F.when(k % 13 != 0, F.col("d").cast("string")).otherwise("?"), F.col("code"), F.col("convention"), F.when(k % 5 == 0, 2001).when(k % 5 == 1, 1901), F.when(k % 7 == 0, 2).when(k % 7 == 1, 9))
    return _calendar(spark, sf_dir).select("o_orderkey", p["period_type"].alias("period_type"), p["fiscal_year"].cast("bigint").alias("fiscal_year"), p["quarter"].cast("bigint").alias("quarter"))


@query(f"""WITH {WITH_CALENDAR}, y AS (SELECT *, {_Y_END} AS fiscal_year FROM k), z AS (SELECT *, ({_Q_END}) AS q, o_orderkey % 4 = 0 AS annual FROM y)
SELECT o_orderkey, (CASE WHEN o_orderkey % 3 = 0 THEN d - 80 WHEN o_orderkey % 3 = 1 THEN d - 100 ELSE (d - INTERVAL (CASE WHEN annual THEN 12 ELSE 3 END) MONTH)::DATE + 1 END)::VARCHAR AS start_date, CASE WHEN o_orderkey % 5 = 0 THEN 1999 ELSE fiscal_year END::BIGINT AS fiscal_year,
  CASE WHEN annual THEN CASE WHEN o_orderkey % 7 = 0 THEN 3 END WHEN o_orderkey % 6 = 1 THEN 2 WHEN o_orderkey % 7 = 0 THEN 3 ELSE q END::BIGINT AS quarter, CASE WHEN annual THEN NULL WHEN o_orderkey % 6 = 1 THEN 'xbrl_document' WHEN o_orderkey % 7 <> 0 AND q IS NOT NULL THEN 'form_type_and_date' END AS source FROM z""")
def standard_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C14"""
    k, d = F.col("o_orderkey"), F.col("d")
    primary = F.when(k % 3 == 1, F.concat_ws(" to ", F.date_sub(d, 100).cast("string"), d.cast("string")))
    p = P.standard_period(F.when(k % 3 == 0, F.date_sub(d, 80)), d, primary, F.when(k % 4 == 0, "annual").otherwise("quarterly"), F.lit("10-Q"), F.col("code"), F.when(k % 5 == 0, 1999), F.when(k % 7 == 0, 3), F.when(k % 6 == 1, "Q2").otherwise("FY"))
    return _calendar(spark, sf_dir).select("o_orderkey", p["start_date"].cast("string").alias("start_date"), p["fiscal_year"].cast("bigint").alias("fiscal_year"), p["quarter"].cast("bigint").alias("quarter"), p["source"].alias("source"))


@query("""WITH o AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate::DATE END AS e, CASE o_orderkey % 6 WHEN 0 THEN 'annual' WHEN 1 THEN 'annual' WHEN 2 THEN 'quarterly' WHEN 3 THEN 'quarterly' WHEN 4 THEN 'quarterly' ELSE 'annual' END AS kind, CASE WHEN o_orderkey % 2 = 0 THEN quarter(o_orderdate) END AS q FROM orders)
SELECT k AS o_orderkey, CASE WHEN e IS NOT NULL THEN kind END AS period_type, CASE WHEN e IS NOT NULL AND kind <> 'annual' THEN q END AS quarter, CASE WHEN e IS NOT NULL THEN CASE WHEN k % 9 = 0 THEN 'Own' WHEN kind = 'annual' THEN 'Fiscal Year Ended ' || e::VARCHAR ELSE 'Three Months Ended ' || e::VARCHAR END END AS label,
  CASE WHEN e IS NOT NULL THEN 'FY' || year(e)::VARCHAR || CASE WHEN kind <> 'annual' AND q IS NOT NULL THEN ' Q' || q::VARCHAR ELSE ' (annual)' END END AS short_label FROM o""")
def detected_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the stated kind, the form, or whether there is a quarter"""
    k = F.col("o_orderkey")
    q = F.when(k % 2 == 0, F.quarter("o_orderdate").cast("bigint"))
    kind = F.when(k % 6 == 0, "Annual").when(k % 6 == 2, "interim").otherwise("")
    form = F.when(k % 6 == 1, "10-k").when(k % 6 == 3, "10-Q").otherwise("20-F")
    p = P.detected_period(F.when(k % 11 != 0, F.to_date("o_orderdate")), q, F.lit(None).cast("int"), kind, form, F.when(k % 9 == 0, "Own"))
    return table(spark, sf_dir, "orders").select("o_orderkey", *[p[c].alias(c) for c in ("period_type", "quarter", "label", "short_label")])


@query("""WITH o AS (SELECT o_orderkey AS k, date_trunc('quarter', o_orderdate)::DATE AS s, o_orderdate::DATE AS d FROM orders)
SELECT k AS o_orderkey, CASE k % 5 WHEN 0 THEN 'Q' || quarter(s)::VARCHAR || ' ' || year(s)::VARCHAR WHEN 1 THEN 'FY ' || year(s)::VARCHAR WHEN 2 THEN 'As of ' || d::VARCHAR WHEN 3 THEN d::VARCHAR || ' to ' || (d + 45)::VARCHAR ELSE 'Unknown Period' END AS label, CASE WHEN k % 2 = 0 THEN year(d)::VARCHAR ELSE (year(d) + 1)::VARCHAR || '-Q1' END AS latest FROM o""")
def period_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B29, B08"""
    k, d = F.col("o_orderkey"), F.to_date("o_orderdate")
    s = F.to_date(F.date_trunc("quarter", "o_orderdate"))
    year = F.to_date(F.date_trunc("year", "o_orderdate"))
    to = lambda a, b: F.concat(a.cast("string"), F.lit(" 00:00:00 to "), b.cast("string"), F.lit(" 00:00:00"))
    text = F.when(k % 5 == 0, to(s, F.add_months(s, 3))).when(k % 5 == 1, to(year, F.add_months(year, 12))).when(k % 5 == 2, F.concat(d.cast("string"), F.lit(" 00:00:00"))).when(k % 5 == 3, to(d, F.date_add(d, 45))).otherwise("")
    y = F.year("o_orderdate")
    labels = F.array(F.concat(y.cast("string"), F.lit("-Q4")), F.lit("nothing"), F.when(k % 2 == 0, y.cast("string")).otherwise(F.concat((y + 1).cast("string"), F.lit("-Q1"))), F.concat((y - 1).cast("string"), F.lit("-12-31")))
    # A year and its fourth quarter end on one day: the first of equals would be the quarter, so the year stands first.
    labels = F.when(k % 2 == 0, F.reverse(labels)).otherwise(labels)
    return table(spark, sf_dir, "orders").select("o_orderkey", P.period_label(text).alias("label"), P.latest_label(labels).alias("latest"))


@query("""SELECT lpad(o_custkey::VARCHAR, 10, '0') AS cik, o_orderkey::VARCHAR AS accession, o_orderdate::DATE::VARCHAR AS filing_date, CASE WHEN o_orderkey % 3 < 2 THEN epoch_us(o_orderdate::DATE + INTERVAL 10 HOUR) + CASE WHEN o_orderkey % 3 = 0 THEN 250000 ELSE 0 END END AS accepted FROM orders""")
def filing_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filings with acceptance times of two formats"""
    k, d = F.col("o_orderkey"), F.to_date("o_orderdate").cast("string")
    at = F.when(k % 3 == 0, F.concat(d, F.lit("T10:00:00.250Z"))).when(k % 3 == 1, F.concat(d, F.lit("T10:00:00"))).otherwise("soon")
    raw = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("cik"), k.cast("string").alias("accession"), F.lit("10-Q").alias("form"), d.alias("filing_date"), at.alias("acceptance"))
    return shape.filing_records(raw).select("cik", "accession", F.col("filing_date").cast("string").alias("filing_date"), F.unix_micros("accepted").alias("accepted"))


@query(f"""WITH {ORDER_FACTS} SELECT cik, fiscal_year, list_aggregate(list_sort(list_distinct(list(quarter) FILTER (quarter < 4))), 'string_agg', ',') AS periods, arg_max(value, accession) FILTER (quarter = 4) AS annual FROM o GROUP BY ALL""")
def fiscal_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G10, G20"""
    o = order_facts(spark, sf_dir).select("cik", "fiscal_year", F.col("quarter").alias("period"), (F.col("quarter") == 4).alias("annual"), F.col("accession").alias("position"), "value")
    return shape.fiscal_years(o, ["cik"]).withColumn("periods", F.nullif(F.array_join("periods", ","), F.lit("")))


@query(f"""WITH {ORDER_FACTS}, a AS (SELECT cik, list_sort(list_distinct(list(accession))) AS a, max(end_date)::VARCHAR AS latest, list_sort(list_distinct(list(fiscal_year))) AS y FROM o GROUP BY cik)
SELECT cik, len(a)::BIGINT AS accessions, list_aggregate(a[greatest(len(a) - 9, 1):], 'string_agg', ',') AS last, latest, list_aggregate(y, 'string_agg', ',') AS years FROM a""")
def company_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G14, G20"""
    out = shape.company_summary(order_facts(spark, sf_dir), ["cik"])
    return out.select("cik", F.col("accessions").cast("bigint").alias("accessions"), F.array_join("last", ",").alias("last"), F.col("latest").cast("string").alias("latest"), F.array_join("years", ",").alias("years"))


@query(f"""WITH {ORDER_FACTS}, r AS (SELECT cik, end_date, CASE WHEN quarter = 4 THEN 1 ELSE 0 END AS a, fiscal_year, CASE WHEN quarter < 4 THEN quarter END AS q FROM o), b AS (SELECT cik, arg_max({{'e': end_date, 'a': a, 'f': fiscal_year, 'q': q}}, (end_date, a, fiscal_year, coalesce(q, 0))) AS b FROM r GROUP BY cik)
SELECT cik, b.e::VARCHAR AS end_date, 'FY' || b.f::VARCHAR || CASE WHEN b.a = 1 THEN ' Annual' ELSE ' Q' || b.q::VARCHAR END AS label FROM b""")
def latest_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G15"""
    o = order_facts(spark, sf_dir)
    return shape.latest_label(o.filter("quarter = 4"), o.filter("quarter < 4"), ["cik"]).withColumn("end_date", F.col("end_date").cast("string"))


@query(f"""WITH {ORDER_FACTS} SELECT DISTINCT cik FROM o WHERE quarter = 4 OR fiscal_year < 1997""")
def processed_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G02"""
    o = order_facts(spark, sf_dir)
    return shape.processed(o.filter("quarter = 4"), o.filter("fiscal_year < 1997"), ["cik"])


@query("""WITH w AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS status FROM events GROUP BY user_id) SELECT status, count(*) AS n FROM w GROUP BY status""")
def outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G12"""
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", F.col("event_type").alias("status"))
    return series.latest(rows, ["user_id"], [F.col("ts"), F.col("event_id")]).groupBy("status").agg(F.count("*").alias("n"))


@query("""WITH r AS (SELECT c_nationkey::BIGINT AS cik, lpad((c_custkey % 7 + 1)::VARCHAR, 3, '0') || CASE WHEN c_custkey % 3 > 0 THEN '.' || lpad((c_custkey % 5 + 1)::VARCHAR, 3, '0') ELSE '' END AS path, CASE WHEN c_custkey % 3 > 0 THEN 1 ELSE 0 END::BIGINT AS level FROM customer), p AS (SELECT cik, level, path, count(*) AS n FROM r GROUP BY ALL)
SELECT cik, level, sum(n)::BIGINT AS nodes, count(*) FILTER (n > 1) AS conflicts FROM p GROUP BY ALL""")
def level_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and shared paths of each level"""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("bigint").alias("cik"), F.concat_ws(".", F.lpad((k % 7 + 1).cast("string"), 3, "0"), F.when(k % 3 > 0, F.lpad((k % 5 + 1).cast("string"), 3, "0"))).alias("path"), F.when(k % 3 > 0, 1).otherwise(0).cast("bigint").alias("level"))
    return hierarchy.level_counts(rows, ["cik"])


@query(f"""WITH {ORDER_FACTS}, f AS (SELECT cik, accession, fiscal_year, CASE WHEN value % 11 = 0 THEN '10-Q/A' WHEN value % 11 = 1 THEN '8-K' WHEN quarter = 4 THEN '10-K' ELSE '10-Q' END AS form, quarter, end_date FROM o)
SELECT cik, accession, row_number() OVER (PARTITION BY cik ORDER BY fiscal_year DESC, CASE WHEN form IN ('10-K', '20-F') THEN 4 WHEN form = '10-Q' THEN quarter WHEN form LIKE '%/A' THEN 5 ELSE 6 END, end_date, accession) AS place FROM f""")
def filing_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest year first, in it quarters, annual, amendments, others"""
    form = F.when(F.col("value") % 11 == 0, "10-Q/A").when(F.col("value") % 11 == 1, "8-K").when(F.col("quarter") == 4, "10-K").otherwise("10-Q")
    return series.filing_order(order_facts(spark, sf_dir).withColumn("form", form), ["cik"]).select("cik", "accession", F.col("place").cast("bigint").alias("place"))


@query(f"""WITH {ORDER_FACTS}, v AS (SELECT cik, concept, fiscal_year, CASE WHEN cik::BIGINT % 4 = 0 AND quarter = 1 THEN -value ELSE value END AS value, quarter FROM o), s AS (SELECT cik, concept, min(sign(value)) AS a, max(sign(value)) AS b FROM v WHERE quarter <= 2 AND value <> 0 GROUP BY ALL),
f AS (SELECT DISTINCT cik, concept, fiscal_year, 1000::BIGINT + fiscal_year AS val FROM v WHERE quarter = 3), h AS (SELECT DISTINCT cik, concept, fiscal_year FROM v WHERE quarter = 4)
SELECT f.cik, f.concept, f.fiscal_year, CASE WHEN s.a = s.b AND f.concept <> '5-LOW' THEN (s.a * abs(val))::BIGINT ELSE val END AS val, CASE WHEN h.cik IS NOT NULL THEN 'exists' ELSE 'filled' END AS state FROM f LEFT JOIN s USING (cik, concept) LEFT JOIN h USING (cik, concept, fiscal_year)
UNION ALL SELECT DISTINCT cik, concept, fiscal_year, NULL, 'absent' FROM v WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.cik = v.cik AND f.concept = v.concept AND f.fiscal_year = v.fiscal_year)""")
def aligned_fills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fills take the sign of the stored values unless the concept may change it; what was filled, was there, or wasn't found"""
    v = order_facts(spark, sf_dir).withColumn("value", F.when((F.col("cik").cast("bigint") % 4 == 0) & (F.col("quarter") == 1), -F.col("value")).otherwise(F.col("value")))
    keys = ["cik", "concept"]
    gaps = v.select(*keys, "fiscal_year").distinct()
    fills = v.filter("quarter = 3").select(*keys, "fiscal_year", (F.lit(1000) + F.col("fiscal_year")).alias("val")).distinct()
    return series.applied_fills(gaps, fills, v.filter("quarter = 4").select(*keys, "fiscal_year").distinct(), v.filter("quarter <= 2"), keys, ["fiscal_year"], ("5-LOW",))


@query(f"""WITH e AS (SELECT p_size::BIGINT AS filing, ['dimension-domain', 'domain-member', 'all', 'dimension-default'][p_partkey % 4 + 1] AS arcrole, p_brand AS parent, p_type AS child, p_partkey % 8 = 0 AS typed FROM part)
SELECT filing, {', '.join(f"coalesce(list_aggregate(list_sort(list_distinct(list({e}) FILTER ({c}))), 'string_agg', ','), '') AS {n}" for n, e, c in (('dimensions', 'parent', "arcrole = 'dimension-domain'"), ('domains', 'child', "arcrole = 'dimension-domain'"), ('members', 'child', "arcrole = 'domain-member'"), ('primary_items', 'parent', "arcrole = 'all'"), ('hypercubes', 'child', "arcrole = 'all'"), ('defaults', "parent || '=' || child", "arcrole = 'dimension-default'"), ('typed', 'parent', 'typed')))} FROM e GROUP BY filing""")
def dimensional_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E16"""
    k = F.col("p_partkey")
    roles = F.array(*map(F.lit, ("dimension-domain", "domain-member", "all", "dimension-default")))
    edges = table(spark, sf_dir, "part").select(F.col("p_size").cast("bigint").alias("filing"), F.element_at(roles, (k % 4 + 1).cast("int")).alias("arcrole"), F.col("p_brand").alias("parent"), F.col("p_type").alias("child"), (k % 8 == 0).alias("typed"))
    out = shape.dimensional_model(edges, ["filing"])
    return out.select("filing", *[F.array_join(c, ",").alias(c) for c in out.columns[1:]])


@query("""WITH l AS (SELECT l_orderkey, l_returnflag, CASE WHEN l_suppkey % 3 = 0 THEN 'a:X=' || l_linestatus || ' | b:Y=m' ELSE '' END AS slice, l_linenumber % 2 AS p, round(l_extendedprice * 100)::BIGINT AS v, (l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS pos FROM lineitem)
SELECT l_orderkey, l_returnflag AS concept, slice, arg_max(v, pos) FILTER (p = 0) AS "2023", arg_max(v, pos) FILTER (p = 1) AS "2024" FROM l GROUP BY l_orderkey, l_returnflag, slice""")
def statement_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each dimension combination"""
    dims = F.when(F.col("l_suppkey") % 3 == 0, F.create_map(F.lit("b:Y"), F.lit("m"), F.lit("a:X"), F.col("l_linestatus")))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("concept"), F.when(F.col("l_linenumber") % 2 == 0, "2023").otherwise("2024").alias("period"), cents("l_extendedprice").alias("value"), dims.alias("dimensions"), F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("position"))
    return files.statement_sheet(rows, ["l_orderkey"], ["2023", "2024"])


# --- guidance ---------------------------------------------------------------


@query(f"""WITH {ORDER_FACTS}, q AS (SELECT cik, concept, fiscal_year, quarter, max(value) AS actual FROM o GROUP BY ALL),
g AS (SELECT o_orderkey AS k, lpad(o_custkey::VARCHAR, 10, '0') AS cik, o_orderpriority AS concept, year(o_orderdate) AS fy, quarter(o_orderdate) AS q, round(o_totalprice * 100)::BIGINT::DOUBLE AS v, ['point', 'min', 'max', 'range', 'qualitative'][o_orderkey % 5 + 1] AS form FROM orders WHERE o_orderkey % 2 = 0),
j AS (SELECT g.*, actual::DOUBLE AS a, CASE WHEN form = 'range' THEN v * 0.5 END AS lo, CASE WHEN form = 'range' AND k % 3 <> 0 THEN v * 0.75 END AS hi FROM g JOIN q ON q.cik = g.cik AND q.concept = g.concept AND q.fiscal_year = g.fy AND q.quarter = g.q)
SELECT k AS o_orderkey, CASE form WHEN 'qualitative' THEN 'qualitative' WHEN 'min' THEN CASE WHEN a > v THEN 'beat' ELSE 'miss' END WHEN 'max' THEN CASE WHEN a < v THEN 'beat' ELSE 'miss' END WHEN 'range' THEN CASE WHEN coalesce(a > hi, false) THEN 'beat' WHEN a < lo THEN 'miss' ELSE 'inline' END ELSE CASE WHEN a > v THEN 'beat' WHEN a < v THEN 'miss' ELSE 'inline' END END AS outcome,
  CASE WHEN form <> 'qualitative' THEN a - v END AS delta_abs, CASE WHEN form <> 'qualitative' THEN (a - v) / abs(v) * 100 END AS delta_pct FROM j""")
def guidance_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every arrived guidance joined with its actual"""
    o = order_facts(spark, sf_dir).withColumnRenamed("concept", "concept_id")
    values = o.groupBy("cik", "concept_id", "fiscal_year", "quarter").agg(F.max("value").cast("double").alias("value"), F.min("accession").alias("accession"))
    k = F.col("o_orderkey")
    v = F.round(F.col("o_totalprice") * 100).cast("bigint").cast("double")
    form = F.element_at(F.array(*map(F.lit, ("point", "min", "max", "range", "qualitative"))), (k % 5 + 1).cast("int"))
    g = table(spark, sf_dir, "orders").filter(k % 2 == 0).select(k, F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("cik"), F.col("o_orderpriority").alias("concept_id"), F.year("o_orderdate").cast("bigint").alias("fiscal_year"), F.quarter("o_orderdate").cast("bigint").alias("quarter"), v.alias("said"), form.alias("form"))
    joined = concepts.actuals(g, values, values.limit(0), ["cik"])
    lo, hi = F.when(F.col("form") == "range", F.col("said") * 0.5), F.when((F.col("form") == "range") & (k % 3 != 0), F.col("said") * 0.75)
    r = guidance.result(F.col("value"), F.col("said"), lo, hi, F.col("form"), F.lit("Revenue"))
    return joined.filter("value is not null").select("o_orderkey", r["outcome"].alias("outcome"), r["delta_abs"].alias("delta_abs"), r["delta_pct"].alias("delta_pct"))


@query("""WITH s AS (SELECT event_id AS id, user_id, event_type, event_id % 10 AS day, event_id % 7 = 0 AS manual FROM events WHERE event_id % 2 = 0), b AS (SELECT event_id AS id, user_id, event_type, event_id % 10 AS day, false AS manual FROM events WHERE event_id % 2 = 1 AND user_id % 3 = 0),
b2 AS (SELECT user_id, day + 1 AS day, event_type, id FROM b WHERE day % 2 = 1), n AS (SELECT *, row_number() OVER (PARTITION BY user_id, day, event_type ORDER BY id) AS k FROM b2), f AS (SELECT DISTINCT user_id, day FROM b2)
SELECT id, 'keep' AS action FROM s WHERE manual OR NOT EXISTS (SELECT 1 FROM f WHERE f.user_id = s.user_id AND f.day = s.day)
UNION ALL SELECT id, CASE WHEN EXISTS (SELECT 1 FROM s WHERE s.user_id = n.user_id AND s.day = n.day AND s.event_type = n.event_type AND NOT s.manual) THEN 'update' ELSE 'insert' END FROM n WHERE k = 1""")
def guidance_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filing read again replaces its own rows and sweeps what it no longer says"""
    k = F.col("event_id")
    e = table(spark, sf_dir, "events")
    stored = e.filter(k % 2 == 0).select(k.alias("id"), "user_id", "event_type", (k % 10).alias("day"), (k % 7 == 0).alias("manual"))
    batch = e.filter((k % 2 == 1) & (F.col("user_id") % 3 == 0)).select(k.alias("id"), "user_id", "event_type", (k % 10 + 1).alias("day"), F.lit(False).alias("manual"))
    return guidance.after_rerun(stored, batch, ["user_id", "day"], ["event_type"]).select("id", "action")


@query("""SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN 'annual' WHEN 1 THEN 'annual' WHEN 2 THEN 'quarterly' WHEN 3 THEN 'quarterly' WHEN 4 THEN 'quarterly' ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'annual' ELSE 'quarterly' END END AS kind, CASE WHEN round(o_totalprice * 100) * CASE o_orderkey % 4 WHEN 0 THEN 1e9 WHEN 1 THEN 1e6 ELSE 1 END <= 1e16 THEN round(o_totalprice * 100) * CASE o_orderkey % 4 WHEN 0 THEN 1e9 WHEN 1 THEN 1e6 ELSE 1 END END AS raw FROM orders""")
def guidance_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M10, M04"""
    k = F.col("o_orderkey")
    kind = F.when(k % 8 == 0, "Annual").when(k % 8 == 1, "multi_year").when(k % 8 == 2, "ytd").when(k % 8 == 3, "current_quarter").when(k % 8 == 4, "quarterly").when(k % 8 == 5, "other")
    scale = F.when(k % 4 == 0, "billions").when(k % 4 == 1, "Million").when(k % 4 == 2, "units")
    raw = guidance.raw_value(F.round(F.col("o_totalprice") * 100), scale, F.lit("Revenue"), F.lit("USD"))
    return table(spark, sf_dir, "orders").select("o_orderkey", guidance.period_kind(kind, F.when(k % 3 != 0, F.quarter("o_orderdate"))).alias("kind"), raw.alias("raw"))


@query("""SELECT page_id, 0::BIGINT AS table_no, 1::BIGINT AS place, CASE WHEN page_id % 2 = 0 THEN 7 ELSE 4 END::BIGINT AS score, 6::BIGINT AS rows FROM pages UNION ALL SELECT page_id, 1, 2, 0, 1 FROM pages""")
def table_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A balance sheet whose words stand in its first four rows, or partly below, before a short table"""
    rows = ["<tr><td>Consolidated</td></tr>", "<tr><td>Total assets</td><td>5</td></tr>", "<tr><td>x</td></tr>", "<tr><td>{}</td></tr>", "<tr><td>Stockholders</td></tr>", "<tr><td>end</td></tr>"]
    made = [F.lit("<table>" + "".join(rows).format(w) + "</table><table><tr><td>note</td></tr></table>") for w in ("Liabilities", "y")]
    pages = table(spark, sf_dir, "pages").select("page_id", F.when(F.col("page_id") % 2 == 0, made[0]).otherwise(made[1]).alias("html"))
    out = documents.listed_tables(documents.html_tables(pages, "page_id", "html"), ["page_id"], "balance sheet")
    return out.select("page_id", *[F.col(c).cast("bigint").alias(c) for c in ("table_no", "place", "score", "rows")])


# --- files and queues -------------------------------------------------------


@query("""WITH r AS (SELECT lpad(o_custkey::VARCHAR, 10, '0') AS cik, o_orderkey::VARCHAR AS accession, o_orderdate::DATE AS d FROM orders)
SELECT cik, accession, d::VARCHAR AS filing_date, row_number() OVER (PARTITION BY cik ORDER BY d DESC, accession) AS place FROM r""")
def paged_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of a company's filings lie in page files"""
    o = table(spark, sf_dir, "orders").select("o_custkey", (F.col("o_orderkey") % 2).alias("half"), F.struct("o_orderkey", F.to_date("o_orderdate").cast("string").alias("d")).alias("x"))
    g = o.groupBy("o_custkey", "half").agg(F.collect_list("x").alias("x"))
    each = lambda v: F.transform("x", lambda _: F.lit(v))
    arrays = F.struct(each("10-Q").alias("form"), F.transform("x", lambda x: x["o_orderkey"].cast("string")).alias("accessionNumber"), F.transform("x", lambda x: x["d"]).alias("filingDate"), F.transform("x", lambda x: x["d"]).alias("reportDate"), each(1).alias("isXBRL"), each("a.htm").alias("primaryDocument"))
    doc = F.to_json(F.struct(F.col("o_custkey").cast("string").alias("cik"), F.struct(arrays.alias("recent")).alias("filings")))
    raw = g.filter("half = 0").select(F.from_json(doc, files.FILINGS_SCHEMA).alias("d")).select("d.*")
    name = F.concat(F.lit("CIK"), F.lpad(F.col("o_custkey").cast("string"), 10, "0"), F.lit("-submissions-001.json"))
    pages = g.filter("half = 1").select(F.from_json(F.to_json(arrays), files.PAGE_SCHEMA).alias("d"), name.alias("file")).select("d.*", "file")
    out = files.all_filings(raw, pages)
    return out.select("cik", "accession", F.col("filing_date").cast("string").alias("filing_date"), F.col("place").cast("bigint").alias("place"))


@query("""SELECT 'a' || page_id::VARCHAR AS accession, html FROM pages""")
def archive_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as an archive, two files each, and read again"""
    path = landing.new_path(spark, "archive")
    rows = table(spark, sf_dir, "pages").select(F.concat(F.lit("T"), (F.col("page_id") % 5).cast("string")).alias("ticker"), F.concat(F.lit("a"), F.col("page_id").cast("string")).alias("accession"), "html")
    files.write_html_archive(rows, path).count()
    return files.html_archive(spark, f"{path}/*")


@query("""SELECT 'us-gaap:' || p_type AS concept, round(p_retailprice * 100)::BIGINT::VARCHAR AS value, 'iso4217:USD' AS measure, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE '2023-01-01' END AS start, CASE WHEN p_partkey % 3 = 0 THEN '2023-12-31' END AS instant, CASE WHEN p_partkey % 2 = 0 THEN 'co:' || p_partkey::VARCHAR ELSE '' END AS member FROM part""")
def xbrl_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """XML instances written and read with contexts and units"""
    k = F.col("p_partkey")
    i = k.cast("string")
    segment = F.when(k % 2 == 0, F.concat(F.lit('<segment><explicitMember dimension="a:X">co:'), i, F.lit("</explicitMember></segment>"))).otherwise("")
    period = F.when(k % 3 == 0, "<instant>2023-12-31</instant>").otherwise("<startDate>2023-01-01</startDate><endDate>2023-12-31</endDate>")
    context = F.concat(F.lit('<context id="c'), i, F.lit('"><entity><identifier>1</identifier>'), segment, F.lit("</entity><period>"), period, F.lit("</period></context>"))
    fact = F.concat(F.lit('<fact concept="us-gaap:'), "p_type", F.lit('" contextRef="c'), i, F.lit('" unitRef="u" decimals="0">'), F.round(F.col("p_retailprice") * 100).cast("bigint").cast("string"), F.lit("</fact>"))
    path = landing.new_path(spark, "instances")
    parts = table(spark, sf_dir, "part").select((k % 8).alias("file"), F.concat(context, fact).alias("x"))
    unit = '<unit id="u"><measure>iso4217:USD</measure></unit>'
    made = parts.groupBy("file").agg(F.concat_ws("", F.collect_list("x")).alias("x"))
    body = F.concat(F.lit("<xbrl>"), F.when(F.col("file") == 0, unit).otherwise(""), "x", F.lit("</xbrl>"))
    made.select("file", body.alias("value")).write.partitionBy("file").text(path)
    out = files.xbrl_instance(spark, f"{path}/*")
    return out.select("concept", "value", "measure", "start", "instant", F.coalesce(F.array_join(F.map_values("dimensions"), ","), F.lit("")).alias("member"))


@query("""SELECT p_type AS concept, arg_max('L' || p_partkey::VARCHAR, (p_partkey % 9, 'L' || p_partkey::VARCHAR)) AS label FROM part WHERE p_partkey % 2 = 0 AND p_partkey % 5 <> 0 GROUP BY p_type""")
def taxonomy_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of several years, roles and languages"""
    k = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(F.col("p_type").alias("concept"), F.when(k % 2 == 0, "label").otherwise("terseLabel").alias("role"), F.when(k % 5 == 0, "de").otherwise("en-US").alias("lang"), (k % 9).cast("int").alias("year"), F.concat(F.lit("L"), k.cast("string")).alias("label"))
    return files.newest_labels(rows)


@query("""SELECT DISTINCT 'T' || (c_custkey % 50)::VARCHAR AS identifier FROM customer WHERE c_custkey % 3 = 0""")
def identifier_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text file with comments, blank lines and small letters"""
    k = F.col("c_custkey")
    path = landing.new_path(spark, "identifiers")
    table(spark, sf_dir, "customer").select(F.when(k % 3 == 0, F.concat(F.lit(" t"), (k % 50).cast("string"))).when(k % 3 == 1, "# note").otherwise("").alias("value")).write.text(path)
    return files.identifiers(spark, path)


@query("""SELECT o_orderkey AS id, o_orderpriority AS form FROM orders""")
def batch_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with lists of objects, one document each"""
    o = table(spark, sf_dir, "orders")
    one = F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("form")))
    text = F.concat_ws(",", F.collect_list(one))
    path = landing.new_path(spark, "states")
    # Written with one partition folder per file, each with one document.
    lists = o.filter("o_orderkey % 10 <> 0").groupBy((F.col("o_custkey") % 5).alias("file")).agg(F.concat(F.lit("["), text, F.lit("]")).alias("value"))
    single = o.filter("o_orderkey % 10 = 0").select((F.lit(5) + F.col("o_orderkey")).alias("file"), one.alias("value"))
    single = single.groupBy((F.col("file") % 7 + 5).alias("file")).agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list("value")), F.lit("]")).alias("value"))
    lists.unionByName(single).write.partitionBy("file").text(path)
    return files.batch_states(spark, f"{path}/*", "id bigint, form string")


@query("""SELECT event_id AS id, event_type AS status FROM events WHERE event_id % 2 = 0 OR event_id % 3 = 0""")
def event_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events appended twice, with broken lines between, and read again"""
    path = landing.new_path(spark, "ledger")
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("status"))
    files.append_ledger(e.filter("id % 2 = 0"), path)
    files.append_ledger(e.filter("id % 2 = 1 and id % 3 = 0"), path)
    spark.createDataFrame([("{broken",), ('{"id": "x"',)], "value string").write.mode("append").text(path)
    return files.ledger(spark, path, "id bigint, status string")


@query("""SELECT l_returnflag AS statement_type, l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey FROM lineitem""")
def statement_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder of JSON per statement"""
    path = landing.new_path(spark, "export")
    files.export_statements(table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("statement_type"), "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey", "l_suppkey"), path)
    return spark.read.schema("l_orderkey bigint, l_linenumber bigint, l_partkey bigint, l_suppkey bigint, statement_type string").json(path)


@query("""SELECT event_id::VARCHAR AS job_id, CASE WHEN event_type <> 'error' THEN 'done' WHEN event_id % 3 = 0 THEN 'dead' ELSE 'done' END AS route, CASE WHEN event_type <> 'error' THEN 0 WHEN event_id % 3 = 0 THEN 3 ELSE event_id % 3 END::BIGINT AS attempts FROM events""")
def queue_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of jobs; failed ones go back into the queue, every third until its attempts are used up, the others once or twice"""
    path = landing.new_path(spark, "queue")
    k = F.col("event_id")
    job = F.to_json(F.struct(k.cast("string").alias("job_id"), F.lit("10-Q").alias("filing_type"), F.lit(0).alias("attempts"), F.col("event_type").alias("ticker")))
    table(spark, sf_dir, "events").select(job.alias("value")).write.text(f"{path}/in/first")

    def work(jobs: DataFrame) -> DataFrame:
        n = F.col("job_id").cast("bigint") % 3
        fails = (F.col("ticker") == "error") & ((n == 0) | (F.coalesce("attempts", F.lit(0)) < n))
        return jobs.withColumn("failed", fails)

    queue.drain_queue(spark, f"{path}/in", f"{path}/out", f"{path}/checkpoint", work)
    out = spark.read.parquet(f"{path}/out")
    return out.filter("route in ('done', 'dead')").select("job_id", "route", F.col("attempts").cast("bigint").alias("attempts"))


@query("""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'none' WHEN event_id % 5 IN (1, 2) AND event_id % 4 + 1 < 3 THEN 'retry' ELSE 'fail' END AS next FROM events""")
def error_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N07"""
    k = F.col("event_id")
    message = F.when(k % 5 == 1, "Read timed out").when(k % 5 == 2, "HTTP 429 Too Many").when(k % 5 == 3, "no such key").when(k % 5 == 4, "")
    return table(spark, sf_dir, "events").select("event_id", queue.recovery(k % 4, message).alias("next"))


@query("""WITH l AS (SELECT user_id, arg_max(event_type, event_id) AS s FROM events GROUP BY user_id) SELECT DISTINCT o_custkey AS accession FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM l WHERE s = 'click')""")
def resume_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs whose latest record isn't saved"""
    ledger = table(spark, sf_dir, "events").select(F.col("user_id").alias("accession"), F.when(F.col("event_type") == "click", "saved").otherwise(F.col("event_type")).alias("status"), F.col("event_id").alias("position"))
    jobs = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("accession")).distinct()
    return queue.pending(jobs, ledger)


@query("""WITH e AS (SELECT event_id, event_type, epoch_us(ts) AS t, row_number() OVER (PARTITION BY event_type ORDER BY epoch_us(ts), event_id) AS i FROM events), p AS (SELECT *, max(t - i * 300000000.0) OVER (PARTITION BY event_type ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS paid FROM e)
SELECT event_id, ceil(greatest(t::DOUBLE, coalesce(i * 300000000.0 + paid - 3 * 300000000.0, t::DOUBLE)))::BIGINT AS granted FROM p""")
def token_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request in five minutes, four held"""
    return queue.granted(table(spark, sf_dir, "events"), ["event_type"], 1 / 300, 4).select("event_id", "granted")


@query("""WITH j AS (SELECT o_orderkey AS job, epoch_us(o_orderdate) AS s, epoch_us(o_orderdate) + (o_orderkey % 400) * 1000000 AS e FROM orders), b AS (SELECT job, unnest(range(s + 60000000, e, 60000000)) AS t FROM j WHERE e - s > 60000000), a AS (SELECT job, s AS t, 'start' AS kind FROM j UNION ALL SELECT job, e, 'end' FROM j UNION ALL SELECT job, t, 'heartbeat' FROM b)
SELECT job, kind, count(*) AS n, min(t) AS first, max(t) AS last FROM a GROUP BY ALL""")
def progress_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A25"""
    start = F.unix_micros(F.col("o_orderdate").cast("timestamp"))
    jobs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("job"), start.alias("started"), (start + F.col("o_orderkey") % 400 * 1_000_000).alias("ended"))
    return queue.heartbeats(jobs).groupBy("job", "kind").agg(F.count("*").alias("n"), F.min("at").alias("first"), F.max("at").alias("last"))


@query(r"""WITH r AS (SELECT p_partkey, 'm' || (p_partkey % 2)::VARCHAR AS model, p_name AS prompt FROM part), c AS (SELECT DISTINCT model, prompt FROM r WHERE p_partkey % 3 = 0)
SELECT p_partkey, CASE WHEN c.prompt IS NOT NULL THEN 'stored' ELSE 'new ' || r.prompt END AS response, c.prompt IS NOT NULL AS hit FROM r LEFT JOIN c USING (model, prompt)""")
def cached_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a provider answers is asked once per question"""
    k = F.col("p_partkey")
    r = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("m"), (k % 2).cast("string")).alias("model"), F.col("p_name").alias("prompt"))
    stored = r.filter(k % 3 == 0).select(cache.cache_key(F.col("model"), F.col("prompt")).alias("key"), F.lit("stored").alias("response")).distinct()
    out, _ = cache.answered(r, stored, lambda asked: asked.select("key", F.concat(F.lit("new "), "prompt").alias("response")))
    return out.select("p_partkey", "response", "hit")


# --- trees of roles, patterns, functions ------------------------------------

#: Arcs of one role per customer: parent, child, order, preferred label; and the rows they make.
_ARCS = [("r:Root", "c:B", 2.0, None), ("r:Root", "c:A", 1.0, "http://x/role/negatedLabel"), ("c:A", "c:D", 1.0, None), ("c:B", "c:D", 0.5, "http://x/role/totalLabel"), ("c:B", "c:C", 1.0, None), ("c:C", "c:B", 3.0, None), ("c:X", "c:Y", 1.0, None), ("c:Y", "c:X", 1.0, None)]
_ITEMS_OUT = "('r:Root', NULL, 0, 1, 0.0, NULL), ('c:A', 'r:Root', 1, 2, 1.0, 'http://x/role/negatedLabel'), ('c:D', 'c:A', 2, 3, 0.5, 'http://x/role/totalLabel'), ('c:B', 'r:Root', 1, 4, 2.0, NULL), ('c:C', 'c:B', 2, 5, 1.0, NULL)"


@query(f"""WITH t(concept, parent, level, place, ord, role) AS (VALUES {_ITEMS_OUT}) SELECT c_custkey, concept, parent, level, place, ord::DOUBLE AS "order", role FROM customer CROSS JOIN t""")
def presentation_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A concept under two parents, a ring inside the tree and a ring beside it"""
    arcs = spark.createDataFrame([(*a, k) for k, a in enumerate(_ARCS)], "parent string, child string, order double, role string, position int")
    return statements.presentation_items(table(spark, sf_dir, "customer").select("c_custkey").crossJoin(F.broadcast(arcs)), ["c_custkey"])


_NODES_IN = [(1, None, "x:StatementAbstract", False, None), (2, 1, "x:Sales", True, None), (3, 1, "x:CostsAbstract", False, None), (4, 3, "x:Rent", True, "negatedLabel"), (5, 4, "x:Land", True, "totalLabel"), (6, 2, "x:DetailTable", False, None), (7, 6, "x:Part", True, None)]
_NODES_OUT = "(1, 1, 0, NULL), (2, 2, 1, 'x:StatementAbstract'), (6, 3, 2, 'x:Sales'), (7, 4, 3, 'x:Sales'), (3, 5, 1, 'x:StatementAbstract'), (4, 6, 2, 'x:CostsAbstract'), (5, 7, 3, 'x:Rent')"
_NODE_NAMES = ", ".join(f"({i}, '{c}', {str(v).lower()}, {str(bool(r and 'negated' in r)).lower()})" for i, _, c, v, r in _NODES_IN)


def _serial(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = spark.createDataFrame([(*n, n[0]) for n in _NODES_IN], "id int, parent int, concept string, valued boolean, role string, position int")
    c = table(spark, sf_dir, "customer").select("c_custkey", F.round(F.col("c_acctbal") * 100).cast("bigint").alias("v"))
    rows = c.crossJoin(F.broadcast(nodes)).withColumn("value", F.when(F.col("valued"), F.col("v")))
    arcs = c.crossJoin(F.broadcast(spark.createDataFrame([("x:Rent", "x:Total", -1.0, 2), ("x:Rent", "x:Costs", None, 1)], "concept string, parent string, weight double, position int")))
    return statements.serialised(rows, arcs, ["c_custkey"])


@query(f"""WITH n(id, concept, valued, negated) AS (VALUES {_NODE_NAMES}), o(id, reading_order, level, parent) AS (VALUES {_NODES_OUT})
SELECT c_custkey, concept, level, reading_order, parent AS parent_concept, CASE WHEN id = 4 THEN 'x:Costs' END AS calc_parent, CASE WHEN id = 4 THEN 1.0 END::DOUBLE AS calc_weight, negated, CASE WHEN valued AND c_acctbal <> 0 THEN sign(c_acctbal) END::INTEGER AS sign FROM customer CROSS JOIN n JOIN o USING (id)""")
def serialised_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E08"""
    return _serial(spark, sf_dir).drop("id", "value")


@query("""WITH f AS (SELECT c_custkey, unnest([2, 4, 5, 7]) AS id FROM customer), x AS (SELECT c_custkey, id, CASE WHEN (c_custkey + id) % 3 = 0 THEN '2022' WHEN (c_custkey + id) % 3 = 1 THEN '2021' ELSE '' END AS period, (c_custkey + id) % 2 = 0 AS d FROM f)
SELECT c_custkey, period, count(*) FILTER (NOT d) AS concepts, count(*) FILTER (d) AS dimensional FROM x WHERE period <> '' GROUP BY ALL""")
def serialised_comparatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Other periods, by period"""
    serial = _serial(spark, sf_dir)
    k = F.col("c_custkey") + F.col("id")
    facts = serial.filter("id in (2, 4, 5, 7)").select("c_custkey", "id", F.when(k % 3 == 0, "2022").when(k % 3 == 1, "2021").otherwise("").alias("period"), F.lit(1.0).alias("value"), (k % 2 == 0).alias("dimensional"))
    out = statements.comparatives_by_period(serial, facts, ["c_custkey"])
    return out.select("c_custkey", "period", F.size("concepts").cast("bigint").alias("concepts"), F.size("dimensional").cast("bigint").alias("dimensional"))


_PATTERN_ROWS = ", ".join(f"('{t}', '{st}', '{p}')" for t, kinds in shape.CONCEPT_PATTERNS.items() for st, ps in kinds.items() for p in ps)


@query(f"""WITH p(taxonomy, statement, pattern) AS (VALUES {_PATTERN_ROWS}), c AS (SELECT DISTINCT p_size::BIGINT AS filing, ['us-gaap:AssetsCurrent', 'ifrs-full:Equity', 'us-gaap:Goodwill', 'co:NetRevenues', 'us-gaap:StockholdersEquity', 'us-gaap:OtherComprehensiveIncomeLoss'][p_partkey % 6 + 1] AS concept FROM part),
x AS (SELECT DISTINCT p_size::BIGINT AS filing, ['us-gaap', 'ifrs-full', 'dei'][p_partkey % 3 + 1] AS taxonomy FROM part WHERE p_partkey % 4 = 0) SELECT c.filing, statement, taxonomy, pattern, concept FROM c JOIN x USING (filing) JOIN p USING (taxonomy) WHERE contains(concept, pattern)""")
def key_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E04"""
    k = F.col("p_partkey")
    p = table(spark, sf_dir, "part")
    filing = F.col("p_size").cast("bigint").alias("filing")
    names = F.array(*map(F.lit, ("us-gaap:AssetsCurrent", "ifrs-full:Equity", "us-gaap:Goodwill", "co:NetRevenues", "us-gaap:StockholdersEquity", "us-gaap:OtherComprehensiveIncomeLoss")))
    concepts_ = p.select(filing, F.element_at(names, (k % 6 + 1).cast("int")).alias("concept"))
    taxonomies = p.filter(k % 4 == 0).select(filing, F.element_at(F.array(F.lit("us-gaap"), F.lit("ifrs-full"), F.lit("dei")), (k % 3 + 1).cast("int")).alias("taxonomy"))
    return shape.key_concepts(concepts_, taxonomies, ["filing"])


@query("""WITH p AS (SELECT p_partkey AS k, round(p_retailprice * 100)::BIGINT AS v FROM part)
SELECT k AS p_partkey, CASE k % 6 WHEN 0 THEN v WHEN 1 THEN -v WHEN 2 THEN v WHEN 3 THEN NULL WHEN 4 THEN NULL END::DOUBLE AS number, CASE k % 6 WHEN 0 THEN v::VARCHAR WHEN 1 THEN '(' || v::VARCHAR || ')' WHEN 2 THEN '$' || v::VARCHAR WHEN 3 THEN 'see note' END AS text FROM p""")
def fact_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first of five sources; nil and nothing are NULL, words stay text"""
    from ..functions.text import fact_value

    k, v = F.col("p_partkey") % 6, F.round(F.col("p_retailprice") * 100).cast("bigint")
    text = v.cast("string")
    number, shown = fact_value(F.when(k == 0, v), F.when(k == 1, F.concat(F.lit("("), text, F.lit(")"))), F.when(k == 2, F.concat(F.lit("$"), text)).when(k == 0, "other"), F.when(k == 3, "see note"), F.when(k == 4, "nil"))
    return table(spark, sf_dir, "part").select("p_partkey", number.alias("number"), shown.alias("text"))


@query("""SELECT c_custkey, 'A' || c_custkey::VARCHAR AS local, lpad(c_custkey::VARCHAR, 10, '0') AS cik, c_custkey % 3 = 0 AS safe, '2023-12-31' AS ends, c_custkey::DOUBLE * 2 + 1 AS value, CASE WHEN c_custkey % 5 <> 0 THEN 10 // (c_custkey % 5) END::INTEGER AS own FROM customer""")
def sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Library functions called from SQL, and a Python function of the caller's; a value it fails on is NULL"""
    from ..functions import register

    register.register(spark)
    own = register.wrapped(lambda x: 10 // (x % 5), "int")
    rows = table(spark, sf_dir, "customer").select("c_custkey", own(F.col("c_custkey")).alias("own"))
    return spark.sql(
        "SELECT c_custkey, fl_local_name(concat('us-gaap:A', c_custkey)) AS local, fl_ten_digit_cik(cast(c_custkey AS STRING)) AS cik, fl_usd_safe(CASE c_custkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'usd' END) AS safe, "
        "cast(fl_period_end('2023-01-01 to 2023-12-31') AS STRING) AS ends, fl_arithmetic(concat('(', c_custkey, ') * 2 + 1')) AS value, own FROM {rows}",
        rows=rows,
    )
