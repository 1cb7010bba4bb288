"""Queries over the write path and repairs of stored rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import canonical as C
from ..operators import decide, persist
from .concept_queries import _ITEMS, _items
from .registry import query, table
from .statement_queries import _POLICY, _findings, _statements
from .tables import ORDER_FACTS, order_facts


@query(f"""WITH {_POLICY}, i AS (SELECT l_orderkey AS filing, l_returnflag AS statement_type, l_linestatus AS concept FROM lineitem),
pp AS (SELECT c.filing, c.statement_type, drop_concepts, q.n = 0 AS ok FROM c JOIN q USING (filing)),
ww AS (SELECT filing, CASE WHEN bool_and(ok) THEN 'write' ELSE 'skip' END AS action, count(*) FILTER (ok) AS written, count(*) AS total, coalesce(string_agg(CASE WHEN NOT ok THEN statement_type END, ',' ORDER BY statement_type), '') AS skipped FROM pp GROUP BY filing),
k AS (SELECT i.filing, count(*) FILTER (list_contains(string_split(drop_concepts, ','), concept)) AS dropped, count(*) FILTER (NOT list_contains(string_split(drop_concepts, ','), concept)) AS items FROM i JOIN pp USING (filing, statement_type) WHERE ok GROUP BY i.filing)
SELECT ww.*, coalesce(dropped, 0) AS dropped, coalesce(items, 0) AS items FROM ww LEFT JOIN k USING (filing)""")
def persist_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions take effect, with a receipt per filing"""
    findings = _findings(spark, sf_dir)
    ceiling = decide.write_ceiling(_statements(spark, sf_dir), findings, ["filing"])
    policy = decide.policy(ceiling, findings, ["filing"])
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("filing"), F.col("l_returnflag").alias("statement_type"), F.col("l_linestatus").alias("concept"))
    kept, receipt = persist.gate(policy, ceiling, items, ["filing"])
    n = kept.groupBy("filing").agg(F.count("*").alias("items"))
    return receipt.withColumn("skipped", F.array_join("skipped", ",")).join(n, "filing", "left").withColumn("items", F.coalesce("items", F.lit(0)))


_BUNDLE = _ITEMS + """, mx AS (SELECT max(id) AS last FROM s),
g0 AS (SELECT * FROM pl WHERE path IS DISTINCT FROM '404.001' AND concept <> '' AND NOT (concept LIKE '%Abstract' AND concept NOT LIKE 'custom:%')),
nw AS (SELECT "row", cik, concept, CASE WHEN concept LIKE 'custom:%' THEN coalesce(parent_concept, '') ELSE '' END AS sc FROM g0 WHERE action = 'create'),
nid AS (SELECT cik, concept, sc, last + row_number() OVER (ORDER BY cik, min("row")) AS id FROM nw, mx GROUP BY cik, concept, sc, last),
ids AS (SELECT "row", id AS concept_id FROM g0 WHERE action IN ('reuse', 'adopt') UNION ALL SELECT nw."row", nid.id FROM nw JOIN nid USING (cik, concept, sc)),
b AS (SELECT p_size::BIGINT AS cik, concept_id, p_partkey % 3 + 2020 AS fy, arg_max(round(p_retailprice * 100)::BIGINT, p_partkey) AS value, arg_max('a' || p_partkey::VARCHAR, p_partkey) AS accession FROM ids JOIN part ON p_partkey = "row" WHERE p_partkey % 4 <> 3 GROUP BY ALL),
sv AS (SELECT p_size::BIGINT AS cik, p_partkey AS concept_id, p_partkey % 3 + 2020 AS fy, round(p_retailprice * 100)::BIGINT + 7 AS value, 's' || p_partkey::VARCHAR AS accession FROM part WHERE p_partkey % 2 = 0),
mv AS (SELECT coalesce(b.cik, sv.cik) AS cik, coalesce(b.concept_id, sv.concept_id) AS concept_id, coalesce(b.fy, sv.fy) AS fy, CASE WHEN b.cik IS NOT NULL THEN b.value ELSE sv.value END AS value, CASE WHEN b.cik IS NOT NULL THEN b.accession ELSE sv.accession END AS accession, CASE WHEN sv.cik IS NULL THEN 'insert' WHEN b.cik IS NOT NULL THEN 'update' ELSE 'keep' END AS action FROM sv FULL JOIN b ON b.cik = sv.cik AND b.concept_id = sv.concept_id AND b.fy = sv.fy)"""


def _bundle(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    items, stored = _items(spark, sf_dir)
    k = F.col("p_partkey")
    cents = F.round(F.col("p_retailprice") * 100).cast("bigint")
    p = table(spark, sf_dir, "part")
    more = p.select(k.alias("row"), (k % 3 + 2020).alias("fy"), F.when(k % 4 != 3, cents).alias("value"), F.concat(F.lit("a"), k.cast("string")).alias("accession"))
    values = p.filter(k % 2 == 0).select(F.col("p_size").cast("bigint").alias("cik"), k.alias("concept_id"), (k % 3 + 2020).alias("fy"), (cents + 7).alias("value"), F.concat(F.lit("s"), k.cast("string")).alias("accession"))
    return persist.write_bundle(items.join(more, "row"), stored, values, C.class_table(spark), ["cik"], ["fy"])


@query(f"WITH {_BUNDLE} SELECT cik, concept_id, fy, value, action, first_value(accession) OVER (PARTITION BY cik, fy ORDER BY action = 'keep', accession DESC NULLS LAST) AS accession FROM mv")
def bundle_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values after concepts were found or made"""
    return _bundle(spark, sf_dir)["values"].drop("corrected_from")


@query(f"WITH {_BUNDLE} SELECT \"row\", CASE WHEN concept LIKE '%Abstract' AND concept NOT LIKE 'custom:%' THEN 'abstract' ELSE action END AS reason FROM pl WHERE action IN ('skip', 'refuse') OR (concept LIKE '%Abstract' AND concept NOT LIKE 'custom:%')")
def bundle_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items that got no concept"""
    return _bundle(spark, sf_dir)["rejects"]


@query(f"WITH {_BUNDLE} SELECT id, true AS stored FROM s UNION ALL SELECT id, false FROM nid")
def bundle_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The concept table after the bundle, old and new rows"""
    out = _bundle(spark, sf_dir)["concepts"]
    _, stored = _items(spark, sf_dir)
    return out.select("id").join(stored.select("id", F.lit(True).alias("stored")), "id", "left").select("id", F.coalesce("stored", F.lit(False)).alias("stored"))


@query("""WITH r AS (SELECT p_partkey AS id, p_size AS cik, p_type AS concept, lpad((p_partkey % 9 + 1)::VARCHAR, 3, '0') AS path FROM part WHERE p_partkey % 2 = 0), bp AS (SELECT cik, path, min(concept) AS concept FROM r GROUP BY ALL),
d AS (SELECT p_partkey AS id, p_size AS cik, CASE WHEN p_partkey % 3 = 0 THEN p_partkey - 1 END AS parent_id, lpad((p_partkey % 9 + 1)::VARCHAR, 3, '0') || '.001' AS path, CASE WHEN p_partkey % 5 <> 0 THEN p_brand END AS concept_name, CASE WHEN p_partkey % 7 = 0 THEN 'own' END AS own FROM part WHERE p_partkey % 2 = 1)
SELECT d.id, coalesce(own, r.concept, bp.concept, concept_name) AS parent, CASE WHEN own IS NOT NULL THEN 'kept' WHEN coalesce(r.concept, bp.concept, concept_name) IS NOT NULL THEN 'filled' ELSE 'unresolved' END AS how FROM d LEFT JOIN r ON r.id = d.parent_id LEFT JOIN bp ON bp.cik = d.cik AND bp.path = split_part(d.path, '.', 1)""")
def dimension_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K17"""
    k = F.col("p_partkey")
    top = F.lpad((k % 9 + 1).cast("string"), 3, "0")
    p = table(spark, sf_dir, "part")
    rows = p.filter(k % 2 == 0).select(k.alias("id"), F.col("p_size").alias("cik"), F.col("p_type").alias("concept"), top.alias("path"), F.lit(False).alias("dimensional"))
    dims = p.filter(k % 2 == 1).select(k.alias("id"), F.col("p_size").alias("cik"), F.when(k % 3 == 0, k - 1).alias("parent_id"), F.concat(top, F.lit(".001")).alias("path"), F.when(k % 5 != 0, F.col("p_brand")).alias("concept_name"), F.when(k % 7 == 0, "own").alias("parent_concept"))
    return persist.dimension_parents(dims, rows, ["cik"]).select("id", "parent", "how")


@query("""WITH c AS (SELECT c_custkey AS id, c_custkey % 2 = 0 AS annual, c_mktsegment AS path, 'a' AS order_key, c_custkey % 3 = 0 AS hide, 1::BIGINT AS level, 'p' AS parent_concept FROM customer),
u AS (SELECT c_custkey AS id, CASE c_custkey % 4 WHEN 0 THEN '555' WHEN 1 THEN '001.002' END AS path, CASE WHEN c_custkey % 5 = 0 THEN 'b' END AS order_key, CASE WHEN c_custkey % 7 = 0 THEN true END AS hide FROM customer WHERE c_custkey % 3 <> 1)
SELECT c.id, annual, coalesce(u.path, c.path) AS path, coalesce(u.order_key, c.order_key) AS order_key, CASE WHEN u.path = '555' THEN false ELSE coalesce(u.hide, c.hide) END AS hide, level, parent_concept FROM c LEFT JOIN u USING (id)""")
def hierarchy_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repairs name the wrong cadence for half of the rows"""
    k, none = F.col("c_custkey"), F.lit(None).cast("string")
    c = table(spark, sf_dir, "customer")
    rows = c.select(k.alias("id"), F.col("c_mktsegment").alias("path"), F.lit("a").alias("order_key"), (k % 3 == 0).alias("hide"), F.lit(1).cast("bigint").alias("level"), F.lit("p").alias("parent_concept"))
    updates = c.filter(k % 3 != 1).select(
        k.alias("id"), F.when(k % 6 < 3, "10-Q").otherwise("10-K").alias("form_type"), F.when(k % 4 == 0, "555").when(k % 4 == 1, "001.002").alias("path"), F.when(k % 5 == 0, "b").alias("order_key"), F.when(k % 7 == 0, F.lit(True)).alias("hide"),
        F.lit(None).cast("bigint").alias("level"), none.alias("parent_concept"),
    )
    annual, quarterly = persist.hierarchy_updates(rows.filter("id % 2 = 0"), rows.filter("id % 2 = 1"), updates)
    return annual.withColumn("annual", F.lit(True)).unionByName(quarterly.withColumn("annual", F.lit(False)))


@query("""WITH p AS (SELECT o_custkey AS cik, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS kinds FROM orders WHERE o_orderkey % 3 = 0 GROUP BY ALL)
SELECT c_custkey AS cik, CASE WHEN kinds IS NOT NULL THEN 1 END AS seed_version, CASE WHEN kinds IS NULL THEN CASE WHEN c_custkey % 4 = 0 THEN '1-URGENT,z' END WHEN c_custkey % 4 = 0 THEN CASE WHEN contains(kinds, '1-URGENT') THEN kinds || ',z' ELSE '1-URGENT,' || kinds || ',z' END ELSE kinds END AS seeded_types FROM customer LEFT JOIN p ON p.cik = c_custkey""")
def seed_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of statements that a plan seeded"""
    k = F.col("c_custkey")
    companies = table(spark, sf_dir, "customer").select(k.alias("cik"), F.lit(None).cast("int").alias("seed_version"), F.when(k % 4 == 0, F.array(F.lit("1-URGENT"), F.lit("z"))).alias("seeded_types"))
    plans = table(spark, sf_dir, "orders").filter("o_orderkey % 3 = 0").select(F.col("o_custkey").alias("cik"), F.array("o_orderpriority").alias("statement_types"))
    return persist.seeded(companies, plans).withColumn("seeded_types", F.array_join("seeded_types", ","))


@query(f"""WITH {ORDER_FACTS}, s AS (SELECT cik, concept AS statement_type, fiscal_year AS end_date, min(accession) AS have FROM o WHERE quarter = 1 GROUP BY ALL), b AS (SELECT DISTINCT cik, concept AS statement_type, fiscal_year AS end_date, accession AS filing_id FROM o WHERE quarter <= 2)
SELECT b.*, CASE WHEN filing_id <> coalesce(have, min(filing_id) OVER (PARTITION BY b.cik, b.statement_type, b.end_date)) THEN 'skip' WHEN have IS NOT NULL THEN 'update' ELSE 'insert' END AS action FROM b LEFT JOIN s USING (cik, statement_type, end_date)""")
def saved_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K10"""
    o = order_facts(spark, sf_dir).select("cik", F.col("concept").alias("statement_type"), F.col("fiscal_year").alias("end_date"), F.col("accession").alias("filing_id"), "quarter")
    return persist.saved_statements(o.filter("quarter = 1"), o.filter("quarter <= 2").drop("quarter").distinct())


@query(f"""WITH {ORDER_FACTS}, s AS (SELECT cik, concept AS concept_id, fiscal_year, max(value) AS value FROM o WHERE quarter = 1 GROUP BY ALL), b AS (SELECT cik, concept AS concept_id, fiscal_year, max(value) AS value FROM o WHERE quarter = 2 GROUP BY ALL)
SELECT coalesce(b.cik, s.cik) AS cik, coalesce(b.concept_id, s.concept_id) AS concept_id, coalesce(b.fiscal_year, s.fiscal_year) AS fiscal_year, coalesce(b.value, s.value) AS value, CASE WHEN abs(b.value - s.value) > greatest(abs(b.value) * 1e-6, 1) THEN s.value END AS corrected_from,
  CASE WHEN s.cik IS NULL THEN 'insert' WHEN b.cik IS NULL THEN 'keep' ELSE 'update' END AS action FROM s FULL JOIN b ON s.cik = b.cik AND s.concept_id = b.concept_id AND s.fiscal_year = b.fiscal_year""")
def dimensional_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the stored values keep their id in the older place"""
    o = order_facts(spark, sf_dir)
    s = o.filter("quarter = 1").groupBy("cik", "concept", "fiscal_year").agg(F.max("value").alias("value"))
    old = F.col("fiscal_year") % 2 == 0
    stored = s.select("cik", F.when(~old, F.col("concept")).alias("concept_id"), F.when(old, F.col("concept")).alias("dimensional_concept_id"), "fiscal_year", "value")
    batch = o.filter("quarter = 2").groupBy("cik", F.col("concept").alias("concept_id"), "fiscal_year").agg(F.max("value").alias("value"))
    return persist.dimensional_values(stored, batch, ["fiscal_year"])


@query("""WITH r AS (SELECT c_custkey AS id, c_nationkey::BIGINT AS cik, lpad((c_custkey % 9)::VARCHAR, 3, '0') AS path, CASE WHEN c_custkey % 2 = 0 THEN 'a' ELSE 'b' END AS order_key FROM customer)
SELECT cik, path, order_key, first_id, id FROM (SELECT *, min(id) OVER (PARTITION BY cik, path, order_key) AS first_id FROM r) WHERE id <> first_id""")
def path_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G08"""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(k.alias("id"), F.col("c_nationkey").cast("bigint").alias("cik"), F.lpad((k % 9).cast("string"), 3, "0").alias("path"), F.when(k % 2 == 0, "a").otherwise("b").alias("order_key"))
    return persist.path_conflicts(rows, ["cik"])


@query(f"""WITH {ORDER_FACTS}, s AS (SELECT cik, accession, concept AS form, 'old' AS status FROM o WHERE fiscal_year < 1998), b AS (SELECT cik, accession, concept AS form, 'new' AS status FROM o WHERE fiscal_year IN (1997, 1998)), r AS (SELECT * FROM s ANTI JOIN b USING (cik, accession, form) UNION ALL SELECT * FROM b)
SELECT r.*, CASE WHEN accession::BIGINT % 3 = 0 THEN 'write' END AS decision, cik::BIGINT % 2 = 0 AS final FROM r""")
def report_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A24"""
    o = order_facts(spark, sf_dir).select("cik", "accession", F.col("concept").alias("form"), "fiscal_year")
    decisions = o.filter("cast(accession as bigint) % 3 = 0").withColumn("decision", F.lit("write"))
    return persist.reports(o.filter("fiscal_year < 1998").withColumn("status", F.lit("old")), o.filter("fiscal_year in (1997, 1998)").withColumn("status", F.lit("new")), decisions, o.filter("cast(cik as bigint) % 2 = 0"))


