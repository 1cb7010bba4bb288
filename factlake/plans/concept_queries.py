"""Queries over stored concepts: dimensional resolution, get-or-create, coalescing, navigation, guidance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import canonical as C
from ..functions import text as T
from ..operators import concepts, dimensions
from .registry import query, table
from .tables import ORDER_FACTS, cents, order_facts

# Stored members are customers: company = nation, member = segment (every fifth under another name with the segment as an alias, every seventh as "old_<segment>"),
# parent = customer key modulo 3, signature missing for every fourth. Wanted members are orders.
_DIMS = """
s AS (SELECT c_custkey AS id, c_nationkey::BIGINT AS cik, CASE WHEN c_custkey % 5 = 0 THEN 'co:M' || (c_custkey % 50)::VARCHAR WHEN c_custkey % 7 = 0 THEN 'old_' || c_mktsegment ELSE c_mktsegment END AS concept,
  CASE WHEN c_custkey % 5 = 0 THEN [c_mktsegment] ELSE []::VARCHAR[] END AS aliases, c_custkey % 3 AS parent_id, CASE WHEN c_custkey % 4 <> 0 THEN 'brand=' || lower(c_mktsegment) END AS signature,
  CASE WHEN c_custkey % 2 = 0 THEN 'custom:H' END AS header, 'Label ' || (c_custkey % 20)::VARCHAR AS label, CASE c_custkey % 6 WHEN 0 THEN '404.001' WHEN 1 THEN '001.002' END AS path,
  'P' || (c_custkey % 2)::VARCHAR AS parent_name, 'a' AS order_key FROM customer),
w AS (SELECT o_orderkey AS "row", o_custkey % 25 AS cik, ['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY', 'OTHER'][o_orderkey % 6 + 1] AS member, o_custkey % 3 AS parent_id,
  CASE WHEN o_orderkey % 11 <> 0 THEN 'brand=' || lower(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY', 'OTHER'][o_orderkey % 6 + 1]) END AS signature, CASE WHEN o_orderkey % 2 = 0 THEN 'custom:H' END AS header,
  'Label ' || (o_orderkey % 25)::VARCHAR AS label, 'P' || (o_custkey % 2)::VARCHAR AS parent_name, CASE WHEN o_orderkey % 13 = 0 THEN 'co:M' || (o_custkey % 50)::VARCHAR END AS target, CASE WHEN o_orderkey % 3 = 0 THEN '001.002' END AS path FROM orders),
n AS (SELECT id, unnest([concept, concept[5:]]) AS name FROM s WHERE concept LIKE 'old_%' UNION ALL SELECT id, concept FROM s WHERE concept NOT LIKE 'old_%' UNION ALL SELECT id, unnest(aliases) FROM s),
c AS (
  SELECT w."row", s.id, CASE WHEN w.signature IS NULL OR w.signature = s.signature THEN 0 WHEN s.signature IS NULL THEN 1 END AS p FROM w JOIN n ON n.name = w.member JOIN s USING (id) WHERE s.cik = w.cik AND s.parent_id = w.parent_id AND coalesce(s.header, '') = coalesce(w.header, '')
  UNION ALL SELECT w."row", s.id, 2 FROM w JOIN s ON s.cik = w.cik AND s.parent_id = w.parent_id AND coalesce(s.header, '') = coalesce(w.header, '') AND list_contains(s.aliases, w.member)
  UNION ALL SELECT w."row", s.id, 3 FROM w JOIN s ON s.cik = w.cik AND s.parent_id = w.parent_id AND coalesce(s.header, '') = coalesce(w.header, '') AND s.label = w.label AND s.path IS DISTINCT FROM '404.001'
), f AS (SELECT "row", arg_min(id, p * 1000000000::BIGINT + id) AS id, min(p) AS p FROM c WHERE p IS NOT NULL GROUP BY "row")"""
_DRIFT = _DIMS + """, d0 AS (SELECT DISTINCT w."row", s.id, s.path, s.label = w.label AS hit FROM w JOIN n ON n.name = w.member JOIN s USING (id) WHERE s.cik = w.cik AND s.parent_name = w.parent_name AND coalesce(s.header, '') = coalesce(w.header, '')
    AND 'brand=' || lower(CASE WHEN s.id % 5 = 0 THEN s.aliases[1] WHEN s.id % 7 = 0 THEN s.concept[5:] ELSE s.concept END) = w.signature AND s.path IS DISTINCT FROM '404.001'),
d AS (SELECT * FROM (SELECT *, bool_or(hit) OVER (PARTITION BY "row") AS any_hit, count(*) OVER (PARTITION BY "row") AS n FROM d0) WHERE n = 1 OR NOT any_hit OR hit)"""
_PLACED = _DRIFT + """, t AS (SELECT w."row", arg_min(s.id, CASE WHEN coalesce(w.header, '') <> '' AND w.header IS DISTINCT FROM s.header THEN 1000000000 ELSE 0 END + s.id) AS id FROM w JOIN s ON s.cik = w.cik AND s.parent_id = w.parent_id AND (s.concept = w.target OR list_contains(s.aliases, w.target)) GROUP BY w."row"),
g AS (SELECT d."row", list(d.id) AS ids, min(d.id) AS oldest, count(*) FILTER (w.path = d.path) AS n_here, min(d.id) FILTER (w.path = d.path) AS here FROM d JOIN w USING ("row") GROUP BY d."row"),
j AS (SELECT w."row", coalesce(t.id, f.id) AS own, t.id AS target_id, f.p, g.*, g.ids IS NOT NULL AND NOT coalesce(list_contains(g.ids, coalesce(t.id, f.id)), false) AS strayed FROM w LEFT JOIN t USING ("row") LEFT JOIN f USING ("row") LEFT JOIN g USING ("row")),
pl AS (SELECT "row", CASE WHEN strayed THEN CASE WHEN n_here = 1 THEN here ELSE oldest END ELSE own END AS id, CASE WHEN strayed THEN 'drift' WHEN target_id IS NOT NULL THEN 'target' ELSE ['slice', 'legacy', 'alias', 'label'][p + 1] END AS how FROM j)"""


def _dims(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    k, seg = F.col("c_custkey"), F.col("c_mktsegment")
    none = F.array().cast("array<string>")
    stored = table(spark, sf_dir, "customer").select(
        k.alias("id"), F.col("c_nationkey").cast("bigint").alias("cik"), F.when(k % 5 == 0, F.concat(F.lit("co:M"), (k % 50).cast("string"))).when(k % 7 == 0, F.concat(F.lit("old_"), seg)).otherwise(seg).alias("concept"),
        F.when(k % 5 == 0, F.array(seg)).otherwise(none).alias("aliases"), (k % 3).alias("parent_id"), F.when(k % 4 != 0, F.concat(F.lit("brand="), F.lower(seg))).alias("signature"), F.when(k % 2 == 0, "custom:H").alias("parent_header"),
        F.concat(F.lit("Label "), (k % 20).cast("string"), F.lit(" [Member]")).alias("label"), F.when(k % 6 == 0, "404.001").when(k % 6 == 1, "001.002").alias("path"), F.concat(F.lit("P"), (k % 2).cast("string")).alias("concept_name"),
        F.lit("a").alias("order_key"), F.create_map(F.lit("co:BrandAxis"), seg, F.lit("x:explicitMember"), F.lit("z")).alias("dimensions"),
    )
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    member = F.element_at(F.array(*map(F.lit, ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "OTHER"))), (o % 6 + 1).cast("int"))
    wanted = table(spark, sf_dir, "orders").select(
        o.alias("row"), (c % 25).alias("cik"), member.alias("member"), (c % 3).alias("parent_id"), F.when(o % 11 != 0, F.concat(F.lit("brand="), F.lower(member))).alias("signature"), F.when(o % 2 == 0, "custom:H").alias("parent_header"),
        F.concat(F.lit("Label "), (o % 25).cast("string")).alias("label"), F.concat(F.lit("P"), (c % 2).cast("string")).alias("parent_name"), F.when(o % 13 == 0, F.concat(F.lit("co:M"), (c % 50).cast("string"))).alias("alias_target"),
        F.when(o % 3 == 0, "001.002").alias("path"), F.lit(None).cast("string").alias("order_key"),
    )
    return wanted, stored


@query(f"""WITH {_DIMS} SELECT "row", id, ['slice', 'legacy', 'alias', 'label'][p + 1] AS how FROM f""")
def resolve_dimensional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F03"""
    return concepts.resolve_dimensional(*_dims(spark, sf_dir), ["cik"])


@query(f"""WITH {_DRIFT} SELECT "row", id, path FROM d""")
def drifted_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F04"""
    return concepts.drifted(*_dims(spark, sf_dir), ["cik"]).select("row", "id", "path")


@query(f"""WITH {_PLACED} SELECT "row", id, CASE WHEN id IS NOT NULL THEN how END AS how, CASE WHEN id IS NULL THEN 'create' ELSE 'reuse' END AS action FROM pl""")
def place_dimensional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K04"""
    return concepts.place_dimensional(*_dims(spark, sf_dir), ["cik"])


@query(f"""WITH {_PLACED}, l AS (SELECT pl.id, max(pl."row") AS "row" FROM pl WHERE pl.id IS NOT NULL GROUP BY pl.id),
x AS (SELECT s.*, w.member, w.label AS w_label, w.parent_id AS w_parent, w.parent_name AS w_name, w.signature AS w_signature, w.path AS w_path, w.header AS w_header, w.target IS NOT NULL OR coalesce(list_contains(s.aliases, w.member), false) AS winner, w."row" IS NOT NULL AS hit, w."row" IS NOT NULL AND s.path IS DISTINCT FROM '404.001' AS live FROM s LEFT JOIN l USING (id) LEFT JOIN w USING ("row"))
SELECT id, CASE WHEN live AND concept <> member AND NOT winner THEN member ELSE concept END AS concept, list_aggregate(list_sort(CASE WHEN NOT hit OR concept = member THEN aliases WHEN winner THEN list_distinct(list_append(aliases, member)) ELSE list_distinct(list_append(aliases, concept)) END), 'string_agg', ',') AS aliases,
  CASE WHEN live AND NOT winner THEN w_label WHEN live THEN label ELSE label || ' [Member]' END AS label, CASE WHEN live AND path IS NULL AND w_path IS NOT NULL THEN w_path ELSE path END AS path, CASE WHEN live THEN w_parent ELSE parent_id END AS parent_id,
  CASE WHEN live THEN w_name ELSE parent_name END AS concept_name, CASE WHEN live AND w_signature IS NOT NULL THEN w_signature ELSE signature END AS signature, CASE WHEN live AND header IS NULL THEN w_header ELSE header END AS parent_header FROM x""")
def next_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored members after the batch"""
    out = concepts.after_batch(*_dims(spark, sf_dir), ["cik"])
    return out.select("id", "concept", F.nullif(F.array_join("aliases", ","), F.lit("")).alias("aliases"), "label", "path", "parent_id", "concept_name", "signature", "parent_header")


@query(f"""WITH {_PLACED}, dup AS (SELECT d.id AS loser, min(pl.id) AS winner FROM d JOIN pl USING ("row") JOIN s a ON a.id = d.id JOIN s b ON b.id = pl.id WHERE d.id <> pl.id AND d.path IS NULL AND a.label = b.label GROUP BY d.id),
v AS (SELECT o_custkey AS concept, year(o_orderdate) AS fy, quarter(o_orderdate) AS q, sum(round(o_totalprice * 100))::BIGINT AS value FROM orders GROUP BY ALL),
m AS (SELECT coalesce(winner, concept) AS id, concept AS was, winner IS NOT NULL AS moved, fy, q, value FROM v LEFT JOIN dup ON loser = concept),
r AS (SELECT *, row_number() OVER (PARTITION BY id, fy, q ORDER BY moved, was) AS n FROM m) SELECT was AS loser, id AS winner, count(*) FILTER (n = 1) AS moved, count(*) FILTER (n > 1) AS dropped FROM r WHERE moved GROUP BY ALL""")
def coalesce_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K09"""
    wanted, stored = _dims(spark, sf_dir)
    pairs = concepts.duplicate_dimensions(wanted, stored, concepts.place_dimensional(wanted, stored, ["cik"]), ["cik"])
    o = table(spark, sf_dir, "orders")
    values = o.groupBy(F.lit(0).alias("cik"), F.col("o_custkey").alias("concept"), F.year("o_orderdate").alias("fiscal_year"), F.quarter("o_orderdate").alias("quarter")).agg(F.sum(cents("o_totalprice")).alias("value"))
    receipt = concepts.coalesced(values, pairs.withColumn("cik", F.lit(0)), ["fiscal_year", "quarter"])[1]
    return receipt.select(F.col("was").alias("loser"), F.col("concept").alias("winner"), "moved", "dropped")


# Stored concepts are parts with an even key, items parts with an odd one; a company is a part size.
_TAGS = [t for c in C.EQUIVALENCE_CLASSES[3:5] for t in c]
_LIST = "[" + ", ".join(f"'{t}'" for t in _TAGS) + "]"
_CLASSES = ", ".join(f"('{t}', '{c[0]}')" for c in C.EQUIVALENCE_CLASSES for t in c)
_ITEMS = f"""
m(tag, canonical) AS (VALUES {_CLASSES}),
s AS (SELECT p_partkey AS id, p_size::BIGINT AS cik, CASE WHEN p_partkey % 8 = 0 THEN 'custom:' || p_type ELSE {_LIST}[(p_partkey * 7) % {len(_TAGS)} + 1] END AS concept, CASE WHEN p_partkey % 10 = 2 THEN ['co:' || p_type] ELSE []::VARCHAR[] END AS aliases, p_brand AS label,
  CASE WHEN p_partkey % 14 = 2 THEN '404.001' WHEN p_partkey % 6 = 0 THEN '001' END AS path, CASE WHEN p_partkey % 16 = 0 THEN 'P' || (p_partkey % 3)::VARCHAR END AS parent_concept FROM part WHERE p_partkey % 2 = 0),
i AS (SELECT p_partkey AS "row", p_size::BIGINT AS cik, CASE WHEN p_partkey % 9 = 0 THEN 'custom:' || p_type WHEN p_partkey % 11 = 0 THEN 'us-gaap:AssetsAbstract' WHEN p_partkey % 7 = 0 THEN 'co:' || p_type ELSE {_LIST}[(p_partkey * 5) % {len(_TAGS)} + 1] END AS concept, p_brand AS label,
  CASE WHEN p_partkey % 9 = 0 THEN 'P' || (p_partkey % 3)::VARCHAR END AS parent_concept, CASE WHEN p_partkey % 5 = 0 THEN '001' END AS path, p_partkey % 27 = 0 OR p_partkey % 35 = 0 AS abstract FROM part WHERE p_partkey % 2 = 1),
u AS (SELECT * FROM s WHERE path IS DISTINCT FROM '404.001'),
c AS (
  SELECT i."row", u.id, 0 AS p FROM i JOIN u USING (cik, concept) WHERE i.concept NOT LIKE 'custom:%'
  UNION ALL SELECT i."row", u.id, 1 FROM i JOIN u ON u.cik = i.cik AND list_contains(u.aliases, i.concept) WHERE i.concept NOT LIKE 'custom:%'
  UNION ALL SELECT i."row", u.id, 2 FROM i JOIN m a ON a.tag = i.concept JOIN u ON u.cik = i.cik JOIN m b ON b.tag = u.concept AND a.canonical = b.canonical
  UNION ALL SELECT i."row", u.id, 3 FROM i JOIN u ON u.cik = i.cik AND lower(u.label) = lower(i.label) WHERE i.concept NOT LIKE 'custom:%'
  UNION ALL SELECT i."row", u.id, 0 FROM i JOIN u USING (cik, concept) WHERE i.concept LIKE 'custom:%' AND coalesce(u.parent_concept, '') = i.parent_concept
), f AS (SELECT "row", arg_min(id, p * 1000000000::BIGINT + id) AS id, min(p) AS p FROM c GROUP BY "row"),
g AS (SELECT i."row", count(*) AS n, min(s.id) AS one, count(*) FILTER (s.path = i.path) AS m, min(s.id) FILTER (s.path = i.path) AS same FROM i ANTI JOIN f USING ("row") JOIN s USING (cik, concept) WHERE i.concept LIKE 'custom:%' AND s.parent_concept IS NULL GROUP BY i."row"),
pl AS (SELECT i.*, CASE WHEN i.concept LIKE '%Abstract' THEN NULL WHEN f.id IS NOT NULL THEN f.id WHEN g.n = 1 THEN g.one WHEN g.m = 1 THEN g.same END AS id,
  CASE WHEN i.concept LIKE '%Abstract' THEN NULL WHEN f.id IS NOT NULL THEN ['exact', 'alias', 'class', 'label'][f.p + 1] WHEN g.n = 1 OR g.m = 1 THEN 'adopted' WHEN g.n IS NOT NULL THEN 'ambiguous' END AS how,
  CASE WHEN i.concept LIKE '%Abstract' THEN 'skip' WHEN f.id IS NOT NULL THEN 'reuse' WHEN g.n = 1 OR g.m = 1 THEN 'adopt' WHEN g.n IS NOT NULL THEN 'refuse' WHEN abstract AND i.concept NOT LIKE 'custom:%' THEN 'skip' ELSE 'create' END AS action FROM i LEFT JOIN f USING ("row") LEFT JOIN g USING ("row"))"""


def _items(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    p, k, n = table(spark, sf_dir, "part"), F.col("p_partkey"), len(_TAGS)
    tags, none = F.array(*map(F.lit, _TAGS)), F.array().cast("array<string>")
    size, string = F.col("p_size").cast("bigint").alias("cik"), F.lit(None).cast("string")
    stored = p.filter(k % 2 == 0).select(
        k.alias("id"), size, F.when(k % 8 == 0, F.concat(F.lit("custom:"), "p_type")).otherwise(F.element_at(tags, ((k * 7) % n + 1).cast("int"))).alias("concept"), F.when(k % 10 == 2, F.array(F.concat(F.lit("co:"), "p_type"))).otherwise(none).alias("aliases"),
        F.col("p_brand").alias("label"), F.when(k % 14 == 2, "404.001").when(k % 6 == 0, "001").alias("path"), F.when(k % 16 == 0, F.concat(F.lit("P"), (k % 3).cast("string"))).alias("parent_concept"), string.alias("order_key"), F.lit("10-K").alias("form_type"),
    )
    concept = F.when(k % 9 == 0, F.concat(F.lit("custom:"), "p_type")).when(k % 11 == 0, "us-gaap:AssetsAbstract").when(k % 7 == 0, F.concat(F.lit("co:"), "p_type")).otherwise(F.element_at(tags, ((k * 5) % n + 1).cast("int")))
    items = p.filter(k % 2 == 1).select(
        k.alias("row"), size, concept.alias("concept"), F.concat(F.lit(" "), "p_brand", F.lit("  [Member]")).alias("label"), F.when(k % 9 == 0, F.concat(F.lit("P"), (k % 3).cast("string"))).alias("parent_concept"), F.when(k % 5 == 0, "001").alias("path"),
        string.alias("order_key"), F.lit("10-Q").alias("form_type"), ((k % 27 == 0) | (k % 35 == 0)).alias("abstract"), string.alias("alias_target"),
    )
    return items, stored


@query(f"""WITH {_ITEMS} SELECT "row", id, how, action FROM pl""")
def place_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K03"""
    items, stored = _items(spark, sf_dir)
    return concepts.place(items, stored, ["cik"], C.class_table(spark))


@query(f"""WITH {_ITEMS}, l AS (SELECT id, max("row") AS "row", list(concept) AS names FROM pl WHERE action IN ('reuse', 'adopt') GROUP BY id),
x AS (SELECT s.*, l.names, i.concept AS w_concept, i.label AS w_label, i.path AS w_path, i.parent_concept AS w_parent, i.action = 'adopt' AS adopt, i."row" IS NOT NULL AND i.action <> 'adopt' AND s.path IS DISTINCT FROM '404.001' AS live FROM s LEFT JOIN l USING (id) LEFT JOIN pl i ON i."row" = l."row")
SELECT id, CASE WHEN live THEN w_concept ELSE concept END AS concept, CASE WHEN live THEN w_label ELSE label END AS label, CASE WHEN live THEN '10-Q' ELSE '10-K' END AS form_type,
  list_aggregate(list_sort(CASE WHEN live THEN list_distinct(list_concat(aliases, [concept], names)) ELSE aliases END), 'string_agg', ',') AS aliases,
  CASE WHEN (live AND path IS NULL) OR adopt THEN coalesce(w_path, path) ELSE path END AS path, CASE WHEN adopt OR (live AND path IS NULL AND w_path IS NOT NULL AND parent_concept IS NULL AND w_parent IS NOT NULL) THEN w_parent ELSE parent_concept END AS parent_concept FROM x""")
def next_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored concepts after the batch"""
    items, stored = _items(spark, sf_dir)
    out = concepts.next_concepts(items, stored, concepts.place(items, stored, ["cik"], C.class_table(spark)))
    return out.select("id", "concept", "label", "form_type", F.nullif(F.array_join("aliases", ","), F.lit("")).alias("aliases"), "path", "parent_concept")


@query(f"""WITH {_ITEMS}, r AS (SELECT *, row_number() OVER (PARTITION BY cik, concept, CASE WHEN concept LIKE 'custom:%' THEN coalesce(parent_concept, '') ELSE '' END ORDER BY "row") AS n FROM pl WHERE action = 'create')
SELECT "row", cik, concept, coalesce(canonical, concept) AS canonical, label, abstract AND concept LIKE 'custom:%' AS abstract FROM r LEFT JOIN m ON tag = concept WHERE n = 1""")
def new_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows to insert"""
    items, stored = _items(spark, sf_dir)
    out = concepts.new_concepts(items, concepts.place(items, stored, ["cik"], C.class_table(spark)), ["cik"])
    return out.select("row", "cik", "concept", "canonical", "label", "abstract")


@query("""WITH p AS (SELECT p_partkey AS id, p_size::BIGINT AS cik, CASE p_partkey % 3 WHEN 0 THEN 'cashflow' WHEN 1 THEN 'cash_flow' ELSE 'income' END AS st, p_type AS concept, p_partkey % 5 <> 0 AS quarterly FROM part WHERE p_partkey % 2 = 0),
w AS (SELECT p_partkey AS "row", p_size::BIGINT AS cik, CASE p_partkey % 3 WHEN 0 THEN 'cashflow' WHEN 1 THEN 'cash_flow' ELSE 'income' END AS st, p_type AS concept FROM part WHERE p_partkey % 2 = 1),
c AS (SELECT w."row", p.id, p.quarterly, CASE WHEN p.st = w.st THEN 0 ELSE 2 END + CASE WHEN p.quarterly THEN 0 ELSE 1 END AS pr FROM w JOIN p ON p.cik = w.cik AND p.concept = w.concept AND (p.st = w.st OR (p.st LIKE 'cash%' AND w.st LIKE 'cash%')))
SELECT "row", arg_min(id, pr * 1000000000::BIGINT + id) AS id, CASE WHEN arg_min(quarterly, pr * 1000000000::BIGINT + id) THEN 'quarterly' ELSE 'annual' END AS cadence FROM c GROUP BY "row" """)
def any_cadence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F08"""
    k = F.col("p_partkey")
    p = table(spark, sf_dir, "part").select(k.alias("id"), F.col("p_size").cast("bigint").alias("cik"), F.when(k % 3 == 0, "cashflow").when(k % 3 == 1, "cash_flow").otherwise("income").alias("statement_type"), F.col("p_type").alias("concept"))
    stored = p.filter("id % 2 = 0")
    return concepts.any_cadence(p.filter("id % 2 = 1").withColumnRenamed("id", "row"), stored.filter("id % 5 <> 0"), stored.filter("id % 5 = 0"), ["cik"])


@query("""WITH c AS (SELECT c_custkey AS id, c_nationkey::BIGINT AS cik, lpad((c_custkey % 7 + 1)::VARCHAR, 3, '0') || CASE WHEN c_custkey % 3 > 0 THEN '.' || lpad((c_custkey % 5 + 1)::VARCHAR, 3, '0') ELSE '' END || CASE WHEN c_custkey % 3 = 2 THEN '.001' ELSE '' END AS path FROM customer),
u AS (SELECT *, CASE WHEN contains(path, '.') THEN regexp_replace(path, '\\.[^.]*$', '') ELSE '' END AS up FROM c)
SELECT a.id, (SELECT count(*) FROM u b WHERE b.cik = a.cik AND b.up = a.path) AS children, (SELECT count(*) - 1 FROM u b WHERE b.cik = a.cik AND b.up = a.up) AS siblings FROM u a""")
def tree_navigation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F06"""
    k = F.col("c_custkey")
    path = F.concat_ws(".", F.lpad((k % 7 + 1).cast("string"), 3, "0"), F.when(k % 3 > 0, F.lpad((k % 5 + 1).cast("string"), 3, "0")), F.when(k % 3 == 2, "001"))
    rows = table(spark, sf_dir, "customer").select(k.alias("id"), F.col("c_nationkey").cast("bigint").alias("cik"), path.alias("path"))
    below = concepts.children(rows, ["cik"]).groupBy("id").agg(F.count("*").alias("children"))
    return concepts.siblings(rows, ["cik"]).join(below, "id", "left").select("id", F.coalesce("children", F.lit(0)).alias("children"), "siblings")


_MAP = "(VALUES ('income', 'Revenue', ['us-gaap:A', 'us-gaap:B']), ('income', 'Cost', ['us-gaap:C']), ('income', 'Tax', ['us-gaap:None']))"


@query(f"""WITH mp(st, label, concepts) AS {_MAP}, p AS (SELECT c_custkey AS id, c_nationkey::BIGINT AS cik, ['us-gaap:A', 'us-gaap:B', 'us-gaap:C', 'co:X'][c_custkey % 4 + 1] AS concept, 'Own ' || (c_custkey % 6)::VARCHAR AS label, c_custkey % 2 = 0 AS annual FROM customer WHERE c_custkey % 3 <> 0),
g AS (SELECT o_orderkey AS "row", o_custkey % 25 AS cik, CASE WHEN o_orderkey % 5 = 0 THEN 'co:X' END AS concept, ['Total Revenues', 'Costs', 'own 2', 'Taxes', 'Revenue'][o_orderkey % 5 + 1] AS label, o_orderkey % 3 = 0 AS annual FROM orders),
k AS (SELECT g."row", g.cik, g.annual, unnest(concepts) AS name FROM g JOIN mp ON mp.label IN (CASE g.label WHEN 'Total Revenues' THEN 'Revenue' WHEN 'Costs' THEN 'Cost' WHEN 'Revenue' THEN 'Revenue' END) WHERE g.concept IS NULL),
c AS (SELECT g."row", p.id, p.concept, p.annual, g.annual <> p.annual AS other FROM g JOIN p USING (cik, concept) UNION ALL SELECT k."row", p.id, p.concept, p.annual, k.annual <> p.annual FROM k JOIN p ON p.cik = k.cik AND p.concept = k.name
  UNION ALL SELECT g."row", p.id, p.concept, p.annual, g.annual <> p.annual FROM g ANTI JOIN k ON k."row" = g."row" JOIN p ON p.cik = g.cik AND lower(p.label) = lower(g.label) WHERE g.concept IS NULL)
SELECT "row", arg_min(id, id + CASE WHEN other THEN 1000000000 ELSE 0 END) AS id, arg_min(concept, id + CASE WHEN other THEN 1000000000 ELSE 0 END) AS concept, CASE WHEN arg_min(annual, id + CASE WHEN other THEN 1000000000 ELSE 0 END) THEN 'annual' ELSE 'quarterly' END AS cadence FROM c GROUP BY "row" """)
def guidance_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F10"""
    k, o = F.col("c_custkey"), F.col("o_orderkey")
    rows = table(spark, sf_dir, "customer").filter(k % 3 != 0).select(k.alias("id"), F.col("c_nationkey").cast("bigint").alias("cik"), F.lit("income").alias("statement_type"), F.element_at(F.array(*map(F.lit, ("us-gaap:A", "us-gaap:B", "us-gaap:C", "co:X"))), (k % 4 + 1).cast("int")).alias("concept"), F.concat(F.lit("Own  "), (k % 6).cast("string")).alias("label"))
    label = F.element_at(F.array(*map(F.lit, ("Total Revenues", "Costs", "own 2", "Taxes", "Revenue"))), (o % 5 + 1).cast("int"))
    g = table(spark, sf_dir, "orders").select(o.alias("row"), (F.col("o_custkey") % 25).alias("cik"), F.lit(None).cast("string").alias("statement_type"), F.when(o % 5 == 0, "co:X").alias("concept"), label.alias("standard_label"), F.when(o % 3 == 0, "annual").otherwise("quarterly").alias("period_type"))
    mapping = spark.createDataFrame([("income", "Revenue", ["us-gaap:A", "us-gaap:B"]), ("income", "Cost", ["us-gaap:C"]), ("income", "Tax", ["us-gaap:None"])], "statement_type string, standard_label string, concepts array<string>")
    return concepts.guidance_concepts(g, mapping, rows.filter("id % 2 = 1"), rows.filter("id % 2 = 0"), ["cik"])


@query(f"""WITH {ORDER_FACTS}, q AS (SELECT cik, concept, fiscal_year, quarter, max(value) AS value, min(accession) AS accession FROM o GROUP BY ALL), a AS (SELECT cik, concept, fiscal_year, max(value) AS value, min(accession) AS accession FROM o GROUP BY ALL),
g AS (SELECT o_orderkey AS "row", lpad(o_custkey::VARCHAR, 10, '0') AS cik, o_orderpriority AS concept, year(o_orderdate) + o_orderkey % 2 AS fiscal_year, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 4 + 1 END AS quarter FROM orders)
SELECT g."row", CASE WHEN g.quarter IS NULL THEN a.value ELSE q.value END AS value, CASE WHEN g.quarter IS NULL THEN a.accession ELSE q.accession END AS accession FROM g LEFT JOIN q ON q.cik = g.cik AND q.concept = g.concept AND q.fiscal_year = g.fiscal_year AND q.quarter = g.quarter LEFT JOIN a ON a.cik = g.cik AND a.concept = g.concept AND a.fiscal_year = g.fiscal_year""")
def guidance_actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F11"""
    o, k = order_facts(spark, sf_dir).withColumnRenamed("concept", "concept_id"), F.col("o_orderkey")
    q = o.groupBy("cik", "concept_id", "fiscal_year", "quarter").agg(F.max("value").alias("value"), F.min("accession").alias("accession"))
    a = o.groupBy("cik", "concept_id", "fiscal_year").agg(F.max("value").alias("value"), F.min("accession").alias("accession"))
    g = table(spark, sf_dir, "orders").select(k.alias("row"), T.ten_digit_cik(F.col("o_custkey")).alias("cik"), F.col("o_orderpriority").alias("concept_id"), (F.year("o_orderdate") + k % 2).alias("fiscal_year"), F.when(k % 3 != 0, k % 4 + 1).alias("quarter"))
    return concepts.actuals(g, q, a, ["cik"]).select("row", "value", "accession")


# --- dimensional facts ------------------------------------------------------

#: Axis, member, segment type; in order of the part key.
_AXES = [
    ("srt:ProductOrServiceAxis", "co:PhoneMember", "product_service", "custom:ProductSegmentation"), ("us-gaap:InvestmentTypeAxis", "us-gaap:CorporateBondSecuritiesMember", "investment_type", "custom:InvestmentSegmentation"),
    ("us-gaap:FairValueByFairValueHierarchyLevelAxis", "us-gaap:FairValueInputsLevel1Member", "fair_value_level", "custom:FairValueSegmentation"), ("us-gaap:ScheduleOfCashAxis", "co:CashMember", "cash_securities_schedule", "custom:InvestmentSegmentation"),
    ("srt:StatementGeographicalAxis", "country:US", "geographic_segment", "custom:GeographicSegmentation"), ("us-gaap:StatementBusinessSegmentsAxis", "co:CloudMember", "business_segment", "custom:BusinessSegments"),
    ("us-gaap:StatementEquityComponentsAxis", "us-gaap:CommonStockMember", "equity_component", "custom:EquityComponentSegmentation"), ("us-gaap:ReclassificationOutOfAccumulatedOtherComprehensiveIncomeAxis", "co:XMember", "comprehensive_income", "custom:ComprehensiveIncomeSegmentation"),
    ("us-gaap:DerivativeInstrumentRiskAxis", "co:ForwardMember", "derivative_risk", "custom:DerivativeSegmentation"), ("ifrs-full:NatureOfExpenseAxis", "co:WagesMember", "expense_nature", "custom:ExpenseNatureSegmentation"),
    ("us-gaap:RevenueRemainingPerformanceObligationAxis", "2025-01-01", "performance_obligation", "custom:PerformanceObligationSegmentation"), ("co:DueAxis", "2026-06-30", "typed_date_co:due", "custom:TypedDateCoDueSegmentation"),
    ("srt:ConsolidationItemsAxis", "co:CorporateMember", "consolidation", "custom:BusinessSegments"), ("co:StatementOfThingsAxis", "co:ThingMember", "co:things", "custom:CoThingsSegmentation"), ("srt:ConsolidationItemsAxis", "srt:EliminationsMember", "unknown", None),
]
_AXIS_CONCEPTS = [m if t not in ("performance_obligation", "unknown") and not t.startswith("typed") else {"performance_obligation": f"us-gaap:RevenueRemainingPerformanceObligation_{m}", "unknown": "unknown"}.get(t, f"co:due_{m}") for _, m, t, _ in _AXES]
_AXIS_ROWS = ", ".join(f"({k}, '{t}', '{c}', {'NULL' if h is None else repr(h)})" for k, ((_, _, t, h), c) in enumerate(zip(_AXES, _AXIS_CONCEPTS, strict=True)))


def _axis_map(k):
    at = (k % len(_AXES) + 1).cast("int")
    axis, member = (F.element_at(F.array(*[F.lit(r[j]) for r in _AXES]), at) for j in (0, 1))
    return axis, member


@query(f"""WITH a(i, segment_type, concept, header) AS (VALUES {_AXIS_ROWS}) SELECT p_partkey, segment_type, CASE WHEN segment_type = 'unknown' OR segment_type LIKE 'typed%' OR segment_type = 'performance_obligation' OR p_partkey % 4 <> 0 THEN concept ELSE 'q:' || concept END AS concept, header FROM part JOIN a ON i = p_partkey % {len(_AXES)}""")
def segment_typing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part also has an explicitMember entry and an unknown axis"""
    k = F.col("p_partkey")
    axis, member = _axis_map(k)
    dims = F.create_map(F.lit("explicitMember"), F.lit("z"), axis, member)
    info = C.segment_info(dims, F.create_map(axis, F.when(k % 4 == 0, F.concat(F.lit("q:"), member))))
    return table(spark, sf_dir, "part").select("p_partkey", info["segment_type"].alias("segment_type"), info["concept"].alias("concept"), C.segment_header(info["segment_type"]).alias("header"))


@query(f"""WITH a(i, segment_type, concept, header) AS (VALUES {_AXIS_ROWS}), f AS (SELECT l_orderkey, CASE WHEN l_suppkey % 3 = 0 THEN 'co:Other' ELSE l_returnflag END AS parent, segment_type, concept, l_linenumber, l_suppkey FROM lineitem JOIN a ON i = l_partkey % {len(_AXES)} WHERE segment_type <> 'unknown')
SELECT l_orderkey, parent, segment_type, concept, max(l_linenumber * 100000 + l_suppkey)::BIGINT % 100000 AS supplier FROM f GROUP BY ALL""")
def dimensional_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E12"""
    axis, member = _axis_map(F.col("l_partkey"))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    fact = F.struct(F.when(F.col("l_suppkey") % 3 == 0, "co:Other").alias("concept_name"), F.create_map(axis, member).alias("dimensions"), empty.alias("qualified"), F.col("l_suppkey").alias("supplier"))
    none = F.struct(F.lit("co:Other").alias("concept_name"), empty.alias("dimensions"), empty.alias("qualified"), F.lit(0).cast("bigint").alias("supplier"))
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_linenumber") * 100000 + F.col("l_suppkey")).alias("position"), F.col("l_returnflag").alias("concept"), F.array(none, fact).alias("facts"))
    return dimensions.dimensional_concepts(items, ["l_orderkey"]).select("l_orderkey", "parent", "segment_type", "concept", F.col("fact.supplier").alias("supplier"))


@query("""SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'business' WHEN 1 THEN 'product_service' WHEN 2 THEN 'area' WHEN 3 THEN 'unknown' ELSE 'business' END AS segment_type,
  CASE p_partkey % 5 WHEN 0 THEN p_brand WHEN 1 THEN p_type WHEN 2 THEN p_name WHEN 3 THEN 'unknown' ELSE 'unknown' END AS concept FROM part""")
def legacy_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E14"""
    k = F.col("p_partkey") % 5
    info = C.legacy_segment_info(F.when(k == 0, "").when(k == 4, ""), F.when(k == 0, F.col("p_brand")), F.when(k == 1, F.col("p_type")), F.when(k == 2, "area").when(k == 3, ""), F.when(k >= 2, F.col("p_name")))
    return table(spark, sf_dir, "part").select("p_partkey", info["segment_type"].alias("segment_type"), info["concept"].alias("concept"))


#: Concept, label, the type that its names say.
_BREAK = [("co:CorporateMember", "x", "consolidation"), ("country:DE", "Germany", "geographic"), ("co:AMember", "Asia", "geographic"), ("us-gaap:CommonStockMember", "c", "equity"), ("co:CloudSegmentMember", "Cloud", "business_segment"), ("co:XProductMember", "p", "product_service"), ("co:EnergyMember", "e", "product_service"), ("co:OwnMember", "own", "product_service"), ("co:BusinessOneMember", "one", "other"), ("co:Thing", "thing", "other"), ("co:TMember", "Operating segments", "business_segment")]
_BREAK_ROWS = ", ".join(f"({k}, '{c}', '{x}', '{t}')" for k, (c, x, t) in enumerate(_BREAK))


@query(f"""WITH b(i, concept, label, found) AS (VALUES {_BREAK_ROWS}) SELECT p_partkey, CASE WHEN p_partkey % 4 = 3 THEN 'unknown' ELSE concept END AS concept, CASE p_partkey % 4 WHEN 0 THEN label WHEN 1 THEN label WHEN 2 THEN 'General' ELSE 'Unknown' END AS label,
  CASE p_partkey % 4 WHEN 0 THEN found WHEN 1 THEN 'segment' WHEN 2 THEN 'given' ELSE 'other' END AS segment_type FROM part JOIN b ON i = p_partkey % {len(_BREAK)}""")
def standard_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record with a vague type, two of the older form, an empty one"""
    k = F.col("p_partkey")
    at = (k % len(_BREAK) + 1).cast("int")
    concept, label = (F.element_at(F.array(*[F.lit(r[j]) for r in _BREAK]), at) for j in (0, 1))
    newer = F.create_map(F.lit("value"), F.lit("1"), F.lit("concept"), concept, F.lit("label"), label, F.lit("segment_type"), F.lit("other"))
    older = F.create_map(F.lit("segment_id"), concept, F.lit("segment_label"), label, F.lit("product_id"), F.lit("z"))
    named = F.create_map(F.lit("equity_id"), concept, F.lit("label"), F.lit("General"), F.lit("equity_type"), F.lit("given"))
    out = dimensions.standard_breakdown(F.when(k % 4 == 0, newer).when(k % 4 == 1, older).when(k % 4 == 2, named).otherwise(F.create_map(F.lit("value"), F.lit("0"))))
    return table(spark, sf_dir, "part").select("p_partkey", out["concept"].alias("concept"), out["label"].alias("label"), out["segment_type"].alias("segment_type"))


@query("""WITH f AS (SELECT l_orderkey, l_linestatus = 'O' AS dims, l_returnflag AS member, l_suppkey % 3 AS axis FROM lineitem)
SELECT l_orderkey, count(*) AS facts, count(*) FILTER (dims) AS dimensional, count(*) FILTER (NOT dims) AS plain, count(DISTINCT axis) FILTER (dims) + CASE WHEN bool_or(dims) THEN 1 ELSE 0 END AS axes, count(DISTINCT member) FILTER (dims) + CASE WHEN bool_or(dims) THEN 1 ELSE 0 END AS members,
  round(count(*) FILTER (dims) / count(*) * 100, 2) AS percent FROM f GROUP BY l_orderkey""")
def axis_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E18"""
    dims = F.when(F.col("l_linestatus") == "O", F.create_map((F.col("l_suppkey") % 3).cast("string"), F.col("l_returnflag"), F.lit("a:Axis"), F.lit("x:Member")))
    return dimensions.axis_summary(table(spark, sf_dir, "lineitem").withColumn("dimensions", dims), ["l_orderkey"])


@query("""WITH i AS (SELECT l_orderkey, CASE WHEN l_returnflag = 'A' THEN l_quantity END AS value, l_linestatus = 'F' AS abstract, (l_linenumber % 4)::BIGINT AS level, l_suppkey % 5 = 0 AS dims, l_partkey % 3 AS nf, l_partkey % 2 AS c, l_partkey % 4 AS p FROM lineitem)
SELECT l_orderkey, count(*) AS items, count(value) AS with_values, count(*) FILTER (abstract) AS abstract_items, count(*) FILTER (dims OR nf > 0) AS with_dimensions, sum(nf)::BIGINT AS facts, count(*) FILTER (nf > 0) AS fact_values, count(*) FILTER (c > 0) AS summation_parents, count(*) FILTER (p > 0) AS summation_children, max(level) AS deepest,
  round(count(value) * 100 / count(*), 1) AS value_rate, round(count(*) FILTER (dims OR nf > 0) * 100 / count(*), 1) AS dimension_rate, coalesce(round(count(*) FILTER (nf > 0) * 100 / nullif(sum(nf), 0), 1), 0) AS fact_value_rate, round(count(*) FILTER (c > 0) * 100 / count(*), 1) AS parent_rate, round(count(*) FILTER (p > 0) * 100 / count(*), 1) AS child_rate FROM i GROUP BY l_orderkey""")
def statement_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E18"""
    fact = lambda v: F.struct(v.alias("value"))
    k = F.col("l_partkey")
    facts = F.slice(F.array(fact(F.lit(1.0)), fact(F.lit(None).cast("double"))), F.lit(1), (k % 3).cast("int"))
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.when(F.col("l_returnflag") == "A", F.col("l_quantity")).alias("value"), (F.col("l_linestatus") == "F").alias("abstract"), (F.col("l_linenumber") % 4).cast("bigint").alias("level"),
        F.when(F.col("l_suppkey") % 5 == 0, F.array(F.lit("a"))).alias("dimensions"), facts.alias("facts"), (k % 2).alias("calculation_children"), (k % 4).alias("calculation_parents"),
    )
    return dimensions.statement_stats(items, ["l_orderkey"])


@query("""WITH f AS (SELECT p_size, p_partkey % 3 = 0 AS nl, p_partkey % 2 = 0 AS nd, p_partkey % 5 IN (1, 2) AS cr, p_partkey % 7 < 2 AS nn FROM part),
g AS (SELECT *, nl::INT + nd::INT + cr::INT + nn::INT AS issues, CASE WHEN nn THEN 0 ELSE 4 END + CASE WHEN nl THEN 0 ELSE 3 END + CASE WHEN nd THEN 0 ELSE 2 END + CASE WHEN cr THEN 0 ELSE 1 END AS points FROM f),
r AS (SELECT p_size::BIGINT AS p_size, count(*) AS facts, count(*) FILTER (nl) AS no_label, count(*) FILTER (nd) AS empty_dimension_details, count(*) FILTER (cr) AS cryptic_concept_name, count(*) FILTER (nn) AS no_readable_identifier, count(*) FILTER (issues >= 2) AS problematic, sum(points)::BIGINT AS points FROM g GROUP BY p_size)
SELECT *, (no_label > facts * 0.3)::INT::BIGINT + (empty_dimension_details > facts * 0.5)::INT + (cryptic_concept_name > facts * 0.2)::INT + (problematic > facts * 0.1)::INT AS suggestions FROM r""")
def unidentified_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G16"""
    k = F.col("p_partkey")
    concept = F.when(k % 5 == 1, "us-gaap:Note1234").when(k % 5 == 2, "us-gaap:a_b").otherwise("co:NetSales")
    rows = table(spark, sf_dir, "part").select(
        F.col("p_size").cast("bigint").alias("p_size"), F.when(k % 3 == 0, "N/A").otherwise(F.col("p_name")).alias("fact_label"), concept.alias("concept_name"), F.when(k % 2 == 1, F.create_map(F.lit("a"), F.lit("b"))).alias("dimensions"),
        F.when(k % 7 == 0, "Unknown").when(k % 7 > 1, F.col("p_name")).alias("identifier"),
    )
    report = dimensions.identification_report(rows, ["p_size"]).withColumn("suggestions", F.size("suggestions").cast("bigint"))
    points = dimensions.identification(rows).groupBy("p_size").agg(F.sum(F.round(F.col("score") * 10).cast("bigint")).alias("points"))
    return report.join(points, "p_size")


@query("""WITH s AS (SELECT c_custkey AS position, c_nationkey::BIGINT AS cik, c_custkey % 3 <> 0 AS dimensional, 'P' || (c_custkey % 4)::VARCHAR AS parent, CASE WHEN c_custkey % 6 = 0 THEN 'custom:ProductLines' ELSE 'custom:Regions' END AS concept, ['product_service', 'geo', 'area'][c_custkey % 5 % 3 + 1] AS st, CASE WHEN c_custkey % 5 = 0 THEN 'custom:Own' || (c_custkey % 2)::VARCHAR END AS header FROM customer),
d AS (SELECT o_orderkey AS "row", o_custkey % 25 AS cik, 'P' || (o_orderkey % 5)::VARCHAR AS parent, ['product_service', 'geo', 'area', '', 'product lines'][o_orderkey % 5 % 5 + 1] AS st FROM orders),
a AS (SELECT cik, parent, st, arg_min(header, position) AS same FROM s WHERE dimensional AND header IS NOT NULL GROUP BY ALL), l AS (SELECT cik, parent, arg_min(header, position) AS loose FROM s WHERE dimensional AND header IS NOT NULL GROUP BY ALL),
h AS (SELECT cik, parent, count(*) AS n, arg_min(concept, position) AS first, arg_min(position, position) FILTER (concept = 'custom:ProductLines') AS p, arg_min(concept, position) FILTER (concept = 'custom:ProductLines') AS lines FROM s WHERE NOT dimensional GROUP BY ALL)
SELECT d."row", coalesce(same, CASE WHEN d.st IN ('product_service', 'product lines') THEN lines END, CASE d.st WHEN 'product_service' THEN 'custom:ProductSegmentation' WHEN 'geo' THEN 'custom:GeographicSegmentation' WHEN 'area' THEN 'custom:AreaSegmentation' WHEN 'product lines' THEN 'custom:ProductSegmentation' END,
  CASE WHEN h.n = 1 THEN first WHEN h.n IS NULL THEN loose END) AS header FROM d LEFT JOIN a USING (cik, parent, st) LEFT JOIN l USING (cik, parent) LEFT JOIN h USING (cik, parent)""")
def inferred_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J19"""
    k, o = F.col("c_custkey"), F.col("o_orderkey")
    types = F.array(*map(F.lit, ("product_service", "geo", "area", "", "product lines")))
    stored = table(spark, sf_dir, "customer").select(
        k.alias("position"), F.col("c_nationkey").cast("bigint").alias("cik"), (k % 3 != 0).alias("dimensional"), F.concat(F.lit("P"), (k % 4).cast("string")).alias("parent_concept"), F.when(k % 6 == 0, "custom:ProductLines").otherwise("custom:Regions").alias("concept"),
        F.element_at(types, (k % 5 % 3 + 1).cast("int")).alias("segment_type"), F.when(k % 5 == 0, F.concat(F.lit("custom:Own"), (k % 2).cast("string"))).alias("parent_header"),
    )
    dims = table(spark, sf_dir, "orders").select(o.alias("row"), (F.col("o_custkey") % 25).alias("cik"), F.concat(F.lit("P"), (o % 5).cast("string")).alias("parent_concept"), F.element_at(types, (o % 5 + 1).cast("int")).alias("segment_type"))
    return dimensions.inferred_headers(dims, stored, ["cik"]).select("row", F.col("parent_header").alias("header"))
