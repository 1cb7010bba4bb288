"""Queries over joins, lookups, counts and fact selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import canonical, text
from ..operators import lookups, select, series
from .registry import query, table
from .tables import LINE_FACTS, ORDER_FACTS, cents, line_facts, order_facts

_TAGS = [t for c in canonical.EQUIVALENCE_CLASSES[3:5] for t in c]
_LIST = "[" + ", ".join(f"'{t}'" for t in _TAGS) + "]"
_CLASSES = ", ".join(f"('{t}', '{c[0]}')" for c in canonical.EQUIVALENCE_CLASSES for t in c)


@query(f"""WITH m(tag, canonical) AS (VALUES {_CLASSES}),
w AS (SELECT DISTINCT p_size, {_LIST}[p_partkey % {len(_TAGS)} + 1] AS concept, p_type AS label FROM part WHERE p_partkey % 2 = 0),
s AS (SELECT p_size, p_partkey AS id, {_LIST}[(p_partkey * 7) % {len(_TAGS)} + 1] AS concept, CASE WHEN p_partkey % 4 = 1 THEN {_LIST}[(p_partkey * 3) % {len(_TAGS)} + 1] END AS alias, p_type AS label,
  CASE WHEN p_partkey % 6 = 1 THEN '404.001' ELSE '001' END AS path FROM part WHERE p_partkey % 2 = 1),
u AS (SELECT * FROM s WHERE path = '001'),
c AS (
  SELECT w.*, id, 'exact' AS how, 0 AS p FROM w JOIN u USING (p_size, concept)
  UNION ALL SELECT w.*, id, 'alias', 1 FROM w JOIN u ON u.p_size = w.p_size AND u.alias = w.concept
  UNION ALL SELECT w.*, id, 'class', 2 FROM w JOIN m a ON a.tag = w.concept JOIN u ON u.p_size = w.p_size JOIN m b ON b.tag = u.concept AND a.canonical = b.canonical
  UNION ALL SELECT w.*, id, 'label', 3 FROM w JOIN u ON u.p_size = w.p_size AND lower(u.label) = lower(w.label)
), r AS (SELECT *, row_number() OVER (PARTITION BY p_size, concept, label ORDER BY p, id) AS n FROM c)
SELECT w.p_size::BIGINT AS p_size, w.concept, w.label, r.id, r.how FROM w LEFT JOIN r ON r.n = 1 AND r.p_size = w.p_size AND r.concept = w.concept AND r.label = w.label""")
def resolve_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F02"""
    p, k, n = table(spark, sf_dir, "part"), F.col("p_partkey"), len(_TAGS)
    tags = F.array(*map(F.lit, _TAGS))
    wanted = p.filter(k % 2 == 0).select(F.col("p_size").cast("bigint").alias("p_size"), F.element_at(tags, (k % n + 1).cast("int")).alias("concept"), F.col("p_type").alias("label")).distinct()
    alias = F.when(k % 4 == 1, F.array(F.element_at(tags, ((k * 3) % n + 1).cast("int")))).otherwise(F.array().cast("array<string>"))
    stored = p.filter(k % 2 == 1).select(F.col("p_size").cast("bigint").alias("p_size"), k.alias("id"), F.element_at(tags, ((k * 7) % n + 1).cast("int")).alias("concept"), alias.alias("aliases"), F.col("p_type").alias("label"), F.when(k % 6 == 1, "404.001").otherwise("001").alias("path"))
    return lookups.resolve_cascade(wanted, stored, canonical.class_table(spark), ["p_size"])


@query("""WITH v AS (SELECT l_orderkey * 10 + l_linenumber AS value_id, l_partkey AS concept_id, lpad(l_suppkey::VARCHAR, 10, '0') AS cik, l_returnflag AS concept FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag FROM lineitem)),
c AS (SELECT p_partkey AS id, lpad((p_partkey % 100)::VARCHAR, 10, '0') AS cik, CASE WHEN p_partkey % 2 = 0 THEN 'A' ELSE 'N' END AS concept FROM part WHERE p_partkey % 10 = 0),
o AS (SELECT p_partkey AS id, lpad((p_partkey % 100)::VARCHAR, 10, '0') AS cik, 'R' AS concept FROM part WHERE p_partkey % 10 = 3),
a AS (SELECT cik, concept, min(id) AS id FROM c GROUP BY ALL), b AS (SELECT cik, concept, min(id) AS id FROM o GROUP BY ALL), l AS (SELECT v.* FROM v ANTI JOIN c ON c.id = v.concept_id)
SELECT value_id, CASE WHEN a.id IS NOT NULL THEN 'relink' WHEN b.id IS NOT NULL THEN 'mirror' ELSE 'drop' END AS action, coalesce(a.id, b.id) AS new_id FROM l LEFT JOIN a USING (cik, concept) LEFT JOIN b USING (cik, concept)""")
def orphan_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F12"""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag").distinct()
    values = li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("value_id"), F.col("l_partkey").alias("concept_id"), text.ten_digit_cik(F.col("l_suppkey")).alias("cik"), F.col("l_returnflag").alias("concept"))
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    cik = text.ten_digit_cik(k % 100).alias("cik")
    concepts = p.filter(k % 10 == 0).select(k.alias("id"), cik, F.when(k % 2 == 0, "A").otherwise("N").alias("concept"))
    return lookups.orphan_values(values, concepts, p.filter(k % 10 == 3).select(k.alias("id"), cik, F.lit("R").alias("concept")))


@query(f"""WITH {ORDER_FACTS}, s AS (SELECT DISTINCT cik, end_date, concept FROM o), d AS (SELECT DISTINCT cik, end_date, concept FROM o WHERE fiscal_year < 1998 OR quarter = 2)
SELECT cik, end_date::VARCHAR AS end_date, concept FROM s ANTI JOIN d USING (cik, end_date, concept)""")
def unprocessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F13, G03, K20"""
    o = order_facts(spark, sf_dir)
    source = o.select("cik", "end_date", "concept").distinct()
    out = lookups.unprocessed(source, o.filter("fiscal_year < 1998"), o.filter("quarter = 2"), ["cik", "end_date", "concept"])
    return out.withColumn("end_date", F.col("end_date").cast("string"))


@query(f"""WITH {ORDER_FACTS} SELECT fiscal_year, quarter, count(DISTINCT cik) AS companies, count(DISTINCT (cik, concept, end_date)) AS statements, count(*) AS filings, max(end_date)::VARCHAR AS last_date FROM o GROUP BY ALL""")
def company_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G01, G04"""
    return order_facts(spark, sf_dir).groupBy("fiscal_year", "quarter").agg(
        F.count_distinct("cik").alias("companies"), F.count_distinct("cik", "concept", "end_date").alias("statements"), F.count("*").alias("filings"), F.max("end_date").cast("string").alias("last_date")
    )


@query("""SELECT (SELECT count(DISTINCT c_custkey) FROM customer) AS total, (SELECT count(DISTINCT o_custkey) FROM orders) AS processed, (SELECT count(DISTINCT o_custkey) FROM orders) * 100 / (SELECT count(DISTINCT c_custkey) FROM customer) AS percent""")
def processing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G05"""
    source = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    return lookups.processing_summary(source, table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), ["k"])


@query(f"""WITH {ORDER_FACTS}, h AS (SELECT cik, fiscal_year, list_distinct(list(concept)) AS k FROM o GROUP BY ALL) SELECT cik, fiscal_year FROM h WHERE list_has_all(k, ['1-URGENT', '2-HIGH', '5-LOW'])""")
def complete_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F14"""
    return lookups.complete_filings(order_facts(spark, sf_dir), ["cik", "fiscal_year"], "concept", ("1-URGENT", "2-HIGH", "5-LOW"))


@query(f"""WITH {ORDER_FACTS}, r AS (SELECT cik, fiscal_year, quarter, CASE WHEN value % 3 <> 0 THEN accession END AS accession, value FROM o), s AS (SELECT cik, fiscal_year, quarter, min(accession) AS f FROM o GROUP BY ALL)
SELECT cik, fiscal_year, quarter, coalesce(accession, f) AS accession, value FROM r JOIN s USING (cik, fiscal_year, quarter)""")
def accession_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F18"""
    o = order_facts(spark, sf_dir).select("cik", "fiscal_year", "quarter", "accession", "value")
    rows = o.withColumn("accession", F.when(F.col("value") % 3 != 0, F.col("accession")))
    return lookups.backfilled(rows, o, ["cik", "fiscal_year", "quarter"], "accession")


@query("""WITH a AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL), b AS (SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY ALL)
SELECT x.p_brand, x.p_type, y.p_size::BIGINT AS p_size FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) AS r FROM a) x JOIN (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_size) AS r FROM b) y ON x.p_brand = y.p_brand AND x.r = 1 AND y.r = 1""")
def cross_company_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F05, G19"""
    return lookups.independent_modes(table(spark, sf_dir, "part"), ["p_brand"], ["p_type", "p_size"]).withColumn("p_size", F.col("p_size").cast("bigint"))


@query("""WITH n AS (SELECT p_size, p_partkey, p_name AS name FROM part UNION ALL SELECT p_size, p_partkey, p_type FROM part UNION ALL SELECT p_size, p_partkey, p_brand FROM part WHERE p_partkey % 2 = 0)
SELECT p_size::BIGINT AS p_size, name, min(p_partkey) AS id FROM n GROUP BY ALL""")
def first_name_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F07"""
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    c = p.select(F.col("p_size").cast("bigint").alias("p_size"), k.alias("id"), k.alias("position"), F.col("p_name").alias("concept"), F.col("p_type").alias("canonical"), F.when(k % 2 == 0, F.array("p_brand")).alias("aliases"))
    return lookups.first_name_lookup(c, ["p_size"])


@query("""WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice * 100)::BIGINT AS value, l_shipdate::DATE::VARCHAR AS period, l_returnflag AS concept, l_linestatus AS dimensions FROM lineitem)
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, round(CASE WHEN concept = 'A' THEN 0.4 ELSE 0.0 END + CASE WHEN least(value, 2500000) / greatest(value, 2500000) >= 0.99 THEN 0.3 WHEN least(value, 2500000) / greatest(value, 2500000) >= 0.9 THEN 0.1 ELSE 0.0 END
  + CASE WHEN period = '1998-06-01' THEN 0.2 ELSE 0.0 END + CASE WHEN dimensions = 'F' THEN 0.1 ELSE 0.0 END, 2)::DOUBLE AS score FROM s WHERE round(CASE WHEN concept = 'A' THEN 0.4 ELSE 0.0 END + CASE WHEN least(value, 2500000) / greatest(value, 2500000) >= 0.99 THEN 0.3 WHEN least(value, 2500000) / greatest(value, 2500000) >= 0.9 THEN 0.1 ELSE 0.0 END
  + CASE WHEN period = '1998-06-01' THEN 0.2 ELSE 0.0 END + CASE WHEN dimensions = 'F' THEN 0.1 ELSE 0.0 END, 2) >= 0.6""")
def similar_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F19"""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey", "l_suppkey", cents("l_extendedprice").alias("value"), F.to_date("l_shipdate").cast("string").alias("period"), F.col("l_returnflag").alias("concept"), F.col("l_linestatus").alias("dimensions"),
    )
    return lookups.similar_facts(rows, {"concept": "A", "value": 2500000, "period": "1998-06-01", "dimensions": "F"}, 0.6).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "score")


@query("""WITH v AS (SELECT c_nationkey, list_sort(list(round(c_acctbal * 100)::BIGINT)) AS v FROM customer GROUP BY ALL) SELECT c_nationkey::BIGINT AS c_nationkey, v[len(v) // 2 + 1] AS median, v[len(v)] AS most FROM v""")
def upper_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G18"""
    rows = table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("bigint").alias("c_nationkey"), cents("c_acctbal").alias("v"))
    out = lookups.upper_medians(rows, ["c_nationkey"], "v")
    return out.select("c_nationkey", F.col("median").cast("bigint").alias("median"), "most")


@query("""WITH a AS (SELECT c_custkey AS k, 'map' AS source FROM customer WHERE c_custkey % 2 = 0), b AS (SELECT DISTINCT o_custkey AS k, 'stored' AS source FROM orders)
SELECT k, 'stored' AS source FROM b UNION ALL SELECT k, source FROM a ANTI JOIN b USING (k)""")
def ticker_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A05"""
    a = table(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"), F.lit("map").alias("source"))
    b = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.lit("stored").alias("source")).distinct()
    return lookups.by_priority(b, a, keys=["k"])


# --- selection --------------------------------------------------------------


@query(f"""WITH {LINE_FACTS}, b AS (
  SELECT l_orderkey, p_type, l_partkey, l_suppkey, l_linenumber, o_orderdate::DATE AS s, l_shipdate::DATE AS e, p_size % 3 AS dims, CASE WHEN o_orderkey % 2 = 0 THEN '10-Q' ELSE '10-K' END AS form, l_extendedprice FROM f
), m AS (SELECT *, (e - s) / 30.4 AS months FROM b),
c AS (SELECT *, CASE WHEN form = '10-Q' THEN CASE WHEN abs(months - 3.0) <= 0.35 THEN 1200 END WHEN abs(months - 12.0) <= 1 THEN 1200 ELSE 400 END + (e - DATE '1970-01-01') + CASE WHEN dims = 0 THEN 500 ELSE 200 END + CASE WHEN dims = 2 THEN -10000 ELSE 0 END + 100 AS score FROM m),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, p_type ORDER BY score DESC NULLS LAST, CASE WHEN score IS NULL THEN dims END, CASE WHEN score IS NULL THEN e END DESC, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS n FROM c)
SELECT l_orderkey, p_type, l_partkey, l_suppkey, score::BIGINT AS score FROM r WHERE n = 1""")
def primary_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D01, D08, D12"""
    f = line_facts(spark, sf_dir).withColumns({"s": F.to_date("o_orderdate"), "e": F.to_date("l_shipdate"), "dims": F.col("p_size") % 3})
    form = F.when(F.col("o_orderkey") % 2 == 0, "10-Q").otherwise("10-K")
    score = select.primary_score(form, F.lit("income"), F.col("s"), F.col("e"), F.lit(True), F.col("dims"), F.col("dims") == 2, F.lit(True))
    position = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    out = select.primary_facts(f, ["l_orderkey", "p_type"], score, [F.col("dims"), -F.unix_date("e")], position)
    return out.select("l_orderkey", "p_type", "l_partkey", "l_suppkey", F.col("score").cast("bigint").alias("score"))


@query("""WITH m AS (SELECT user_id, max(ts::DATE) AS d FROM events GROUP BY ALL) SELECT e.user_id, event_id, e.ts::DATE::VARCHAR AS day FROM events e JOIN m ON m.user_id = e.user_id AND e.ts::DATE = m.d""")
def latest_instant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D06"""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.to_date("ts").alias("day"))
    return select.at_latest(e, ["user_id"], "day").withColumn("day", F.col("day").cast("string"))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 2026 WHEN event_id % 3 = 1 THEN 2025 ELSE 2024 END > 2025 AS future, abs(ts::DATE - DATE '2024-01-15') <= 2 OR event_id % 10 = 0 AS near FROM events""")
def future_period_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D11, D12"""
    k = F.col("event_id")
    words = F.concat(F.lit("Year ended 2024 against "), F.when(k % 3 == 0, "2026").when(k % 3 == 1, "2025").otherwise("2024"))
    end = F.when(k % 10 != 0, F.to_date("ts"))
    return table(spark, sf_dir, "events").select("event_id", select.future_period(words, F.lit(2024)).alias("future"), select.near_target(end, F.to_date(F.lit("2024-01-15"))).alias("near"))


@query(f"""WITH {ORDER_FACTS}, f AS (SELECT cik, accession, fiscal_year, quarter, CASE WHEN quarter = 4 THEN '10-K' ELSE '10-Q' END AS form, end_date FROM o) SELECT cik, accession, form, row_number() OVER (PARTITION BY cik ORDER BY fiscal_year DESC, CASE WHEN form = '10-K' THEN 4 ELSE quarter END, end_date, accession) AS place FROM f WHERE fiscal_year = 1997 AND quarter IN (2)""")
def filings_of_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D20"""
    f = order_facts(spark, sf_dir).withColumn("form", F.when(F.col("quarter") == 4, "10-K").otherwise("10-Q"))
    rank = F.when(F.col("form") == "10-K", 4).otherwise(F.col("quarter"))
    w = Window.partitionBy("cik").orderBy(F.col("fiscal_year").desc(), rank, "end_date", "accession")
    return select.filings_of_period(f, 1997, 2).select("cik", "accession", "form", F.row_number().over(w).cast("bigint").alias("place"))


@query("""WITH b AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, o_orderdate::DATE AS s, l_shipdate::DATE AS e FROM lineitem JOIN orders ON l_orderkey = o_orderkey), m AS (SELECT *, (e - s) / 30.4 AS months FROM b),
t AS (SELECT *, CASE WHEN months BETWEEN 2.5 AND 4.0 THEN 0 WHEN months BETWEEN 2.3 AND 4.2 THEN 1 ELSE 2 END AS tier FROM m), x AS (SELECT *, min(tier) OVER (PARTITION BY l_orderkey) AS best FROM t),
y AS (SELECT *, dense_rank() OVER (PARTITION BY l_orderkey ORDER BY e DESC, e - s) AS r FROM x WHERE tier = best) SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber::BIGINT AS l_linenumber, e::VARCHAR AS end_date FROM y WHERE best = 2 OR r = 1""")
def primary_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D02"""
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    f = li.join(o, li["l_orderkey"] == o["o_orderkey"]).select("l_orderkey", "l_partkey", "l_suppkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), F.to_date("o_orderdate").alias("s"), F.to_date("l_shipdate").alias("e"))
    out = select.latest_period_group(f, ["l_orderkey"], "s", "e", F.lit("10-Q"))
    return out.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("e").cast("string").alias("end_date"))


@query("""SELECT l_orderkey, l_returnflag, l_linestatus, min(l_shipdate)::DATE::VARCHAR AS first_date, count(*) AS n FROM lineitem WHERE l_discount <> 0 GROUP BY ALL""")
def clean_and_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D08, D14"""
    li = table(spark, sf_dir, "lineitem").withColumn("dims", F.create_map(F.lit("a"), F.col("l_linestatus")))
    kept = select.clean_facts(li, "l_discount", "dims")
    n = kept.groupBy("l_orderkey", "l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))
    first = series.first_wins(kept, ["l_orderkey", "l_returnflag", "l_linestatus"], F.struct("l_shipdate", "l_linenumber", "l_partkey"))
    return first.select("l_orderkey", "l_returnflag", "l_linestatus", F.to_date("l_shipdate").cast("string").alias("first_date")).join(n, ["l_orderkey", "l_returnflag", "l_linestatus"])
