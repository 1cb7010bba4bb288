"""Queries over keyed writes and maintenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import merge
from .registry import query, table
from .tables import ORDER_FACTS, QUARTER_SUMS, cents, order_facts, quarter_sums


@query(f"""WITH {QUARTER_SUMS}, s AS (SELECT cik, concept, fiscal_year, CASE WHEN concept LIKE '5%' THEN NULL ELSE quarter END AS quarter, sum(value)::BIGINT AS value FROM q WHERE fiscal_year <= 1998 GROUP BY ALL),
b AS (SELECT cik, concept, fiscal_year, CASE WHEN concept LIKE '5%' THEN NULL ELSE quarter END AS quarter, sum(CASE WHEN quarter % 2 = 0 THEN value + 1000 ELSE value END)::BIGINT AS value FROM q WHERE fiscal_year >= 1998 GROUP BY ALL)
SELECT coalesce(b.cik, s.cik) AS cik, coalesce(b.concept, s.concept) AS concept, coalesce(b.fiscal_year, s.fiscal_year) AS fiscal_year, coalesce(b.quarter, s.quarter) AS quarter, coalesce(b.value, s.value) AS value,
  CASE WHEN abs(b.value - s.value) > greatest(abs(b.value) * 1e-6, 1) THEN s.value END AS corrected_from, CASE WHEN s.cik IS NULL THEN 'insert' WHEN b.cik IS NOT NULL THEN 'update' ELSE 'keep' END AS action
FROM s FULL JOIN b ON s.cik = b.cik AND s.concept = b.concept AND s.fiscal_year = b.fiscal_year AND s.quarter IS NOT DISTINCT FROM b.quarter""")
def value_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K01, K06"""
    q = quarter_sums(spark, sf_dir).withColumns({"bump": F.when(F.col("quarter") % 2 == 0, F.col("value") + 1000).otherwise(F.col("value")), "quarter": F.when(~F.col("concept").startswith("5"), F.col("quarter"))})
    keys = ["cik", "concept", "fiscal_year", "quarter"]
    stored = q.filter("fiscal_year <= 1998").groupBy(*keys).agg(F.sum("value").alias("value"))
    batch = q.filter("fiscal_year >= 1998").groupBy(*keys).agg(F.sum("bump").alias("value"))
    return merge.upsert_values(stored, batch, keys)


@query(f"""WITH {ORDER_FACTS} SELECT cik, accession, fiscal_year, quarter, (first_value(end_date) OVER (PARTITION BY cik, fiscal_year, quarter ORDER BY end_date DESC, accession))::VARCHAR AS end_date FROM o""")
def period_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K07"""
    rows = order_facts(spark, sf_dir).select("cik", "accession", "fiscal_year", "quarter", "end_date")
    out = merge.align_periods(rows, ["cik", "fiscal_year", "quarter"], ["end_date"], [F.col("end_date").desc(), F.col("accession")])
    return out.withColumn("end_date", F.col("end_date").cast("string"))


_PROMOTED = QUARTER_SUMS + """, m AS (SELECT cik, CASE WHEN concept = '2-HIGH' AND cik::BIGINT % 2 = 0 THEN '1-URGENT' ELSE concept END AS winner, concept, fiscal_year, quarter, value FROM q),
r AS (SELECT *, row_number() OVER (PARTITION BY cik, winner, fiscal_year, quarter ORDER BY CASE WHEN winner <> concept THEN 1 ELSE 0 END, concept) AS n FROM m)"""


def _promoted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    q = quarter_sums(spark, sf_dir)
    pairs = q.filter(F.col("cik").cast("bigint") % 2 == 0).select("cik").distinct().select("cik", F.lit("2-HIGH").alias("loser"), F.lit("1-URGENT").alias("winner"))
    return merge.promote(q, pairs, ["fiscal_year", "quarter"])


@query(f"WITH {_PROMOTED} SELECT cik, winner AS concept, fiscal_year, quarter, value FROM r WHERE n = 1")
def promote_collision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K08"""
    return _promoted(spark, sf_dir)[0]


@query(f"WITH {_PROMOTED} SELECT cik, concept AS was, winner AS concept, count(*) FILTER (n = 1) AS moved, count(*) FILTER (n > 1) AS dropped FROM r WHERE winner <> concept GROUP BY ALL")
def promote_receipt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K08"""
    return _promoted(spark, sf_dir)[1]


@query("SELECT user_id, event_type, ts::DATE::VARCHAR AS day, count(*) AS n FROM events GROUP BY ALL HAVING count(*) > 1")
def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G06"""
    e = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts").cast("string"))
    return merge.duplicate_groups(e, ["user_id", "event_type", "day"])


@query("SELECT user_id, event_type, max(ts)::VARCHAR AS newest, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY ALL")
def duplicate_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G07"""
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id")
    out = merge.newest_of_duplicates(e, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")])
    return out.select("user_id", "event_type", F.col("ts").cast("string").alias("newest"), "event_id")


@query("""WITH s AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderkey % 2 = 0) SELECT c_custkey AS k, c_name AS name FROM customer ANTI JOIN s ON s.k = c_custkey""")
def company_copy_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K11, K20"""
    batch = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    stored = table(spark, sf_dir, "orders").filter("o_orderkey % 2 = 0").select(F.col("o_custkey").alias("k"))
    return merge.insert_missing(stored, batch, ["k"])


@query(f"""WITH {ORDER_FACTS}, s AS (SELECT cik, fiscal_year, quarter, accession, value FROM o), b AS (SELECT cik, fiscal_year, quarter, accession, value * 2 AS value FROM s WHERE fiscal_year = 1999 AND quarter = 1)
SELECT s.* FROM s ANTI JOIN b USING (cik, fiscal_year, quarter) UNION ALL SELECT * FROM b""")
def reload_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K14"""
    s = order_facts(spark, sf_dir).select("cik", "fiscal_year", "quarter", "accession", "value")
    b = s.filter("fiscal_year = 1999 and quarter = 1").withColumn("value", F.col("value") * 2)
    return merge.replace_scope(s, b, ["cik", "fiscal_year", "quarter"])


@query("SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey FROM lineitem WHERE NOT (l_returnflag = 'N' AND l_linestatus = 'F') AND l_returnflag <> 'R'")
def prune_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K15, K18"""
    li = table(spark, sf_dir, "lineitem").filter(~((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F")))
    return merge.without_members(li, ["R"], "l_returnflag").select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey")


@query("""WITH n AS (SELECT n_nationkey::BIGINT AS id, n_regionkey, CASE WHEN n_nationkey < 5 THEN '001' WHEN n_nationkey = 24 THEN '404.001' ELSE '001.' || lpad((n_nationkey)::VARCHAR, 3, '0') END AS path FROM nation), p AS (SELECT n_regionkey, path, min(id) AS parent_id FROM n GROUP BY ALL)
SELECT id, n.path, parent_id FROM n LEFT JOIN p ON p.n_regionkey = n.n_regionkey AND p.path = CASE WHEN contains(n.path, '.') AND NOT regexp_matches(n.path, '(^|\\.)(404|555)(\\.|$)') THEN regexp_replace(n.path, '\\.[^.]*$', '') END""")
def parent_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K16, D19"""
    k = F.col("n_nationkey")
    n = table(spark, sf_dir, "nation").select(k.cast("bigint").alias("id"), "n_regionkey", F.when(k < 5, "001").when(k == 24, "404.001").otherwise(F.concat(F.lit("001."), F.lpad(k.cast("string"), 3, "0"))).alias("path"))
    return merge.parent_links(n, ["n_regionkey"]).select("id", "path", "parent_id")


@query("""SELECT c_custkey, c_name FROM customer WHERE c_custkey % 7 <> 0 AND c_acctbal >= 0""")
def insert_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K05"""
    from ..operators.guard import admitted

    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.when(k % 7 == 0, "us-gaap:AssetsAbstract").otherwise("custom:SegmentsAbstract").alias("concept"), F.when(F.col("c_acctbal") >= 0, "001").otherwise("404.1").alias("path"))
    return admitted(rows).select("c_custkey", "c_name")
