"""Queries over trees."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import hierarchy
from .registry import query, table

_NODES = """
t AS (
  SELECT 'r' || r_regionkey::VARCHAR AS id, NULL::VARCHAR AS parent, r_regionkey::BIGINT AS position FROM region
  UNION ALL SELECT 'n' || n_nationkey::VARCHAR, 'r' || n_regionkey::VARCHAR, n_nationkey::BIGINT FROM nation
  UNION ALL SELECT 's' || s_suppkey::VARCHAR, 'n' || s_nationkey::VARCHAR, s_suppkey FROM supplier
), m AS (SELECT *, lpad((row_number() OVER (PARTITION BY parent ORDER BY position, id))::VARCHAR, 3, '0') AS seg FROM t),
p AS (SELECT id, seg AS path, 0 AS level FROM m WHERE parent IS NULL UNION ALL SELECT m.id, p.path || '.' || m.seg, p.level + 1 FROM p JOIN m ON m.parent = p.id)"""


def _nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    def name(letter: str, column: str):
        return F.concat(F.lit(letter), F.col(column).cast("string"))

    r = table(spark, sf_dir, "region").select(name("r", "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent"), F.col("r_regionkey").cast("bigint").alias("position"))
    n = table(spark, sf_dir, "nation").select(name("n", "n_nationkey").alias("id"), name("r", "n_regionkey").alias("parent"), F.col("n_nationkey").cast("bigint").alias("position"))
    s = table(spark, sf_dir, "supplier").select(name("s", "s_suppkey").alias("id"), name("n", "s_nationkey").alias("parent"), F.col("s_suppkey").alias("position"))
    return r.unionByName(n).unionByName(s)


@query(f"WITH RECURSIVE {_NODES} SELECT id, path, level::BIGINT AS level FROM p")
def tree_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E05, E08, H11"""
    return hierarchy.tree_paths(_nodes(spark, sf_dir), []).select("id", "path", F.col("level").cast("bigint").alias("level"))


@query(f"""WITH RECURSIVE {_NODES} SELECT count(*) AS nodes, count(*) FILTER (level = 0) AS roots, count(*) FILTER (NOT EXISTS (SELECT 1 FROM p c WHERE c.path LIKE p.path || '.%')) AS leaves, max(level)::BIGINT AS deepest, substr(path, 1, 3) AS region FROM p GROUP BY substr(path, 1, 3)""")
def tree_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G17"""
    rows = hierarchy.tree_paths(_nodes(spark, sf_dir), []).withColumn("region", F.substring("path", 1, 3))
    return hierarchy.tree_stats(rows, ["region"]).withColumn("deepest", F.col("deepest").cast("bigint"))


@query("""WITH r AS (SELECT n_nationkey::BIGINT AS n_nationkey, n_regionkey::BIGINT AS n_regionkey, row_number() OVER (PARTITION BY n_nationkey // 30 ORDER BY n_name, n_nationkey) - 1 AS rank FROM nation) SELECT *, chr((97 + rank % 26)::INT) AS order_key FROM r""")
def order_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H14"""
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("n_nationkey"), F.col("n_regionkey").cast("bigint").alias("n_regionkey"), "n_name").withColumn("g", F.floor(F.col("n_nationkey") / 30))
    out = hierarchy.order_rank(n, ["g"], [F.col("n_name"), F.col("n_nationkey")])
    return out.select("n_nationkey", "n_regionkey", F.col("rank").cast("bigint").alias("rank"), "order_key")


@query("""WITH l AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS position, (l_quantity::INT % 3)::BIGINT AS level FROM lineitem),
n AS (SELECT l_orderkey, position, level - min(level) OVER (PARTITION BY l_orderkey) AS level FROM l)
SELECT a.l_orderkey, a.position, a.level, CASE WHEN a.level > 0 THEN (SELECT max(b.position) FROM n b WHERE b.l_orderkey = a.l_orderkey AND b.position < a.position AND b.level = a.level - 1) END AS parent_position FROM n a""")
def parents_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H12, H13"""
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", F.row_number().over(order).cast("bigint").alias("position"), (F.col("l_quantity").cast("int") % 3).cast("bigint").alias("level"))
    return hierarchy.parents_by_level(hierarchy.levelled(rows, ["l_orderkey"]), ["l_orderkey"])


@query("""WITH p AS (SELECT s_nationkey, lpad((s_suppkey % 50 + 1)::VARCHAR, 3, '0') || '.001' AS path FROM supplier UNION ALL SELECT s_nationkey, '404.002' FROM supplier)
SELECT s_nationkey::BIGINT AS s_nationkey, lpad((max(split_part(path, '.', 1)::INT) FILTER (path NOT LIKE '404%') + 1)::VARCHAR, 3, '0') AS next FROM p GROUP BY s_nationkey""")
def next_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H18"""
    s = table(spark, sf_dir, "supplier")
    rows = s.select(F.col("s_nationkey").cast("bigint").alias("s_nationkey"), F.concat(F.lpad((F.col("s_suppkey") % 50 + 1).cast("string"), 3, "0"), F.lit(".001")).alias("path"))
    rows = rows.unionByName(rows.select("s_nationkey", F.lit("404.002").alias("path")))
    return hierarchy.next_path(rows, ["s_nationkey"])


@query("""WITH p AS (SELECT c_custkey, c_nationkey, CASE WHEN c_nationkey % 2 = 0 THEN '001.' ELSE '' END || lpad((c_custkey % 900)::VARCHAR, 3, '0') AS path FROM customer),
w AS (SELECT *, bool_and(path LIKE '001.%') OVER (PARTITION BY c_nationkey) AS strip FROM p) SELECT c_custkey, CASE WHEN strip THEN substr(path, 5) ELSE path END AS path FROM w""")
def rerooted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E21"""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.concat(F.when(F.col("c_nationkey") % 2 == 0, "001.").otherwise(""), F.lpad((k % 900).cast("string"), 3, "0")).alias("path"))
    return hierarchy.rerooted(rows, ["c_nationkey"]).select("c_custkey", "path")


@query("""SELECT n_nationkey::BIGINT AS id, (n_nationkey // 5)::BIGINT AS g, CASE n_nationkey % 5 WHEN 1 THEN n_nationkey - 1 WHEN 2 THEN n_nationkey - 1 WHEN 4 THEN n_nationkey - 1 END::BIGINT AS parent FROM nation""")
def broken_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows 0 <- 1 <- 2, and 3 and 4 that name each other; row 0 names an absent parent"""
    k = F.col("n_nationkey").cast("bigint")
    up = F.when(k % 5 == 0, F.lit(-7)).when((k % 5 == 1) | (k % 5 == 2) | (k % 5 == 4), k - 1).otherwise(k + 1)
    rows = table(spark, sf_dir, "nation").select(k.alias("id"), F.floor(k / 5).alias("g"), up.cast("bigint").alias("parent"), k.alias("position"))
    return hierarchy.broken_cycles(rows, ["g"]).select("id", "g", "parent")


@query("""SELECT n_nationkey::BIGINT AS id, (n_nationkey // 5)::BIGINT AS g, CASE n_nationkey % 5 WHEN 0 THEN '001' WHEN 1 THEN '001.007' WHEN 2 THEN '001.008' WHEN 3 THEN '555.001' ELSE '002' END AS path FROM nation""")
def tree_placement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A root, a stored child, a new child, a hidden row, a row whose parent is absent"""
    k = F.col("n_nationkey").cast("bigint")
    parent = F.when((k % 5 == 1) | (k % 5 == 2), k - k % 5).when(k % 5 == 4, F.lit(-1))
    rows = table(spark, sf_dir, "nation").select(F.floor(k / 5).alias("g"), k.cast("string").alias("id"), parent.cast("string").alias("parent"), k.alias("position"), F.when(k % 5 == 1, "001.007").alias("stored_path"), (k % 5 == 3).alias("hidden"))
    return hierarchy.placed(rows, ["g"]).select(F.col("id").cast("bigint").alias("id"), "g", "path")


#: One balance sheet and one cash-flow statement of a customer: kind, concept, position, parent of a calculation arc, expected section parent.
_SECTIONS = [
    ("balancesheet", "us-gaap:Cash", 0, None, "us-gaap:Assets"), ("balancesheet", "us-gaap:Stock", 1, "us-gaap:Cash", "us-gaap:Cash"), ("balancesheet", "us-gaap:Assets", 2, None, None), ("balancesheet", "us-gaap:Debt", 3, None, "us-gaap:LiabilitiesAndStockholdersEquity"),
    ("balancesheet", "us-gaap:LiabilitiesAndStockholdersEquity", 4, None, None), ("balancesheet", "us-gaap:Note", 5, None, None), ("cashflow", "us-gaap:Depreciation", 0, None, "us-gaap:NetCashProvidedByUsedInOperatingActivities"),
    ("cashflow", "us-gaap:NetCashProvidedByUsedInOperatingActivities", 1, None, None), ("cashflow", "us-gaap:Capex", 2, "us-gaap:Depreciation", "us-gaap:NetCashProvidedByUsedInInvestingActivities"), ("cashflow", "us-gaap:NetCashProvidedByUsedInInvestingActivities", 3, None, None),
    ("cashflow", "us-gaap:Dividends", 4, "us-gaap:NetCashProvidedByUsedInFinancingActivities", "us-gaap:NetCashProvidedByUsedInFinancingActivities"), ("cashflow", "us-gaap:InterestPaid", 5, None, None), ("cashflow", "us-gaap:NetCashProvidedByUsedInFinancingActivities", 6, None, None),
]
_EXPECTED = ", ".join("(" + ", ".join("NULL" if v is None else repr(v) for v in r) + ")" for r in _SECTIONS)


@query(f"""SELECT c_custkey, kind AS statement_type, concept, parent FROM customer CROSS JOIN (VALUES {_EXPECTED}) t(kind, concept, position, arc, parent)""")
def filing_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calculation parents first, then the sections' totals"""
    lines = spark.createDataFrame(_SECTIONS, "statement_type string, concept string, position int, arc string, expected string").drop("expected")
    all_rows = table(spark, sf_dir, "customer").select("c_custkey").crossJoin(F.broadcast(lines))
    keys = ["c_custkey", "statement_type"]
    arcs = all_rows.filter("arc is not null").select(*keys, F.col("arc").alias("parent"), "concept", F.lit(1.0).alias("weight"), "position")
    rows = all_rows.select(*keys, "concept", "position", F.lit(None).cast("string").alias("parent"), F.lit(None).cast("string").alias("section"))
    return hierarchy.section_parents(hierarchy.calculation_parents(rows, arcs, keys), keys).select(*keys, "concept", "parent")
