"""Queries over names, numbers, units, labels and identity keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import canonical as C
from ..functions import text as T
from .registry import query, table
from .tables import LINE_FACTS, line_facts


@query(r"""SELECT doc_id, len(regexp_extract_all(text, '(\d[\d,]*(?:\.\d+)?)', 1))::BIGINT AS n,
  list_aggregate(list_transform(regexp_extract_all(text, '(\d[\d,]*(?:\.\d+)?)', 1), lambda x: try_cast(replace(x, ',', '') AS DOUBLE)), 'max') AS largest FROM documents""")
def number_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B13"""
    found = T.number_tokens(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(found).cast("bigint").alias("n"), F.array_max(found).alias("largest"))


@query("""SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN -round(-c_acctbal, 0) ELSE round(c_acctbal, 0) END AS value, CASE c_custkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'shares' WHEN 2 THEN 'EUR' ELSE 'USD' END AS unit,
  CASE c_custkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'SHARES' WHEN 2 THEN 'EUR' ELSE NULL END AS plain_unit FROM customer""")
def unit_standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B11, B14"""
    k = F.col("c_custkey") % 4
    unit = F.when(k == 0, "US$").when(k == 1, "xbrli:shares").when(k == 2, "eur")
    whole = F.round("c_acctbal", 0)
    shown = F.when(whole < 0, F.concat(F.lit("($"), F.format_number(-whole, 0), F.lit(")"))).otherwise(F.format_number(whole, 0))
    value, _ = T.fact_value(F.lit(None).cast("string"), shown)
    plain = F.when(k == 0, T.plain_unit(F.lit("iso4217:usd"))).when(k < 3, T.plain_unit(unit))
    return table(spark, sf_dir, "customer").select("c_custkey", value.alias("value"), T.standard_unit(unit).alias("unit"), plain.alias("plain_unit"))


@query(f"""WITH {LINE_FACTS}, j AS (SELECT f.*, n_name FROM f JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, 'brand=' || lower(trim(p_brand)) || CASE WHEN l_linenumber % 2 = 0 THEN '|geographical=' || lower(trim(n_name)) ELSE '' END AS signature,
  lpad(o_custkey::VARCHAR, 10, '0') || '|10-Q|income|' || CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE l_shipdate::DATE::VARCHAR END || '|' || p_type AS row_key FROM j""")
def dimension_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L01, L03, B21"""
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    f = line_facts(spark, sf_dir).join(s, F.col("l_suppkey") == s["s_suppkey"]).join(n, F.col("s_nationkey") == n["n_nationkey"])
    place = F.when(F.col("l_linenumber") % 2 == 0, F.col("n_name")).otherwise("")
    dims = F.create_map(F.lit("srt:GeographicalAxis"), place, F.lit("co:BrandAxis"), F.col("p_brand"), F.lit("x:explicitMember"), F.lit("z"))
    period = F.when(F.col("l_linenumber") % 3 != 0, F.to_date("l_shipdate").cast("string"))
    key = T.row_key(T.ten_digit_cik(F.col("o_custkey")), F.lit("10-Q"), F.lit("income"), period, F.col("p_type"))
    return f.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), T.dimension_signature(dims).alias("signature"), key.alias("row_key"))


@query(r"""SELECT o_orderkey, a AS accession, regexp_matches(a, '^\d{10}-\d{2}-\d{6}$') AS ok, '20' || substr(a, 12, 2) || '-01-01' AS filed, substr(md5(a), 1, 24) AS id
FROM (SELECT o_orderkey, lpad(o_custkey::VARCHAR, 10, '0') || '-' || substr(year(o_orderdate)::VARCHAR, 3, 2) || '-' || lpad((o_orderkey % 1000000)::VARCHAR, 6, '0') AS a FROM orders)""")
def accession_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B24, B25, B26, A05"""
    o = table(spark, sf_dir, "orders")
    raw = F.concat_ws("-", T.ten_digit_cik(F.col("o_custkey")), F.substring(F.year("o_orderdate").cast("string"), 3, 2), F.lpad((F.col("o_orderkey") % 1000000).cast("string"), 6, "0"), F.lit("xbrl"))
    a = T.plain_accession(raw)
    return o.select("o_orderkey", a.alias("accession"), T.is_accession(a).alias("ok"), T.filing_date_from_accession(a).alias("filed"), T.filing_id(a).alias("id"))


@query(r"""SELECT p_partkey, regexp_replace(trim(p_name), '\s+', ' ', 'g') AS label,
  list_aggregate(list_sort(list_distinct(list_filter(regexp_extract_all(lower(p_name), '[a-z]+'), lambda x: length(x) > 2 AND x NOT IN ('and','the','for','from','with','net','total','other','of','in')))), 'string_agg', ' ') AS tokens FROM part""")
def clean_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B18, B19, B20"""
    tag = F.when(F.col("p_partkey") % 3 == 0, " [Member]").when(F.col("p_partkey") % 3 == 1, "  [Line Items]").otherwise("")
    shown = F.concat(F.lit("  "), F.replace(F.col("p_name"), F.lit(" "), F.lit("  ")), tag)
    tokens = F.array_join(F.array_sort(T.concept_tokens(F.concat(F.lit("co:"), F.col("p_name")))), " ")
    return table(spark, sf_dir, "part").select("p_partkey", T.clean_label(shown).alias("label"), F.nullif(tokens, F.lit("")).alias("tokens"))


_CLASS_ROWS = ", ".join(f"('{t}', '{c[0]}')" for c in C.EQUIVALENCE_CLASSES for t in c)
_TAGS = [t for c in C.EQUIVALENCE_CLASSES for t in c] + ["us-gaap:Goodwill"]
_TAG_LIST = ", ".join(f"'{t}'" for t in _TAGS)


@query(f"""WITH m(tag, canonical) AS (VALUES {_CLASS_ROWS}), p AS (SELECT p_partkey, [{_TAG_LIST}][p_partkey % {len(_TAGS)} + 1] AS concept FROM part)
SELECT p_partkey, concept, coalesce(canonical, concept) AS canonical, split_part(concept, ':', 2) AS local FROM p LEFT JOIN m ON m.tag = p.concept""")
def canonical_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F21, B17"""
    concept = F.element_at(F.array(*[F.lit(t) for t in _TAGS]), (F.col("p_partkey") % len(_TAGS) + 1).cast("int"))
    p = table(spark, sf_dir, "part").select("p_partkey", concept.alias("concept"))
    return C.with_canonical(p).withColumn("local", T.local_name(F.col("concept")))


@query(r"""SELECT n_nationkey::BIGINT AS n_nationkey, upper(substr(n_name, 1, 1)) || replace(lower(substr(n_name, 2)), '_', ' ') AS pretty, lower(n_name) AS member FROM nation""")
def member_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B21, B22"""
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").cast("bigint").alias("n_nationkey"), T.pretty_member(F.col("n_name")).alias("pretty"), T.member_name(F.col("n_name")).alias("member"))


@query("""SELECT o_orderkey, round(o_totalprice * 100)::BIGINT * 2 - 7 AS value FROM orders""")
def safe_arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B30"""
    from ..functions.arithmetic import evaluate

    c = F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string")
    return table(spark, sf_dir, "orders").select("o_orderkey", evaluate(F.concat(F.lit("("), c, F.lit(") * 2 - 7"))).cast("bigint").alias("value"))
