"""Queries over documents, guidance and the event queue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import documents, guidance
from .registry import query, table


_BLOCKS = "|".join(documents.BLOCK_TAGS)
_PLAIN = "html"
for _pattern, _to in (
    ("(?is)<script[^>]*>.*?</script>", ""), ("(?is)<style[^>]*>.*?</style>", ""), ("(?s)<!--.*?-->", ""), (f"(?i)</?({_BLOCKS})(\\s[^>]*)?/?>", "\n"), ("(?s)<[!a-zA-Z/][^>]*>", ""),
):
    _PLAIN = f"regexp_replace({_PLAIN}, '{_pattern}', '{_to}', 'g')"
for _entity, _char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&#x27;", "''"), ("&nbsp;", "\u00a0"), ("&copy;", "\u00a9"), ("&middot;", "\u00b7"), ("&eacute;", "\u00e9"), ("&mdash;", "\u2014"), ("&ndash;", "\u2013"), ("&hellip;", "\u2026"), ("&amp;", "&")):
    _PLAIN = f"replace({_PLAIN}, '{_entity}', '{_char}')"


@query(f"""WITH l AS (SELECT page_id, list_filter(list_transform(string_split({_PLAIN}, chr(10)), lambda x: trim(regexp_replace(replace(x, chr(160), ' '), '\\s+', ' ', 'g'))), lambda x: x <> '') AS l FROM pages)
SELECT page_id, unnest(l) AS line, (generate_subscripts(l, 1) - 1)::INTEGER AS line_no FROM l""")
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E24"""
    return documents.html_lines(table(spark, sf_dir, "pages"), "page_id", "html")


@query("""WITH c(row_no, col_no, cell, value) AS (VALUES (0, 0, 'Total assets', NULL), (0, 1, '$ 1,234', 1234.0), (0, 2, NULL, NULL), (1, 0, 'Net income', NULL), (1, 1, '-', NULL))
SELECT page_id, 0 AS table_no, row_no, col_no, coalesce(cell, '(' || page_id::VARCHAR || ')') AS cell, CASE WHEN cell IS NULL THEN -page_id ELSE value END::DOUBLE AS value, CASE WHEN cell IS NULL THEN -sign(page_id) ELSE sign(value) END::INTEGER AS sign, 'balancesheet' AS statement FROM pages CROSS JOIN c""")
def html_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a table behind them"""
    rows = F.concat(F.lit("<table><tr><td>Total assets</td><td>$ 1,234</td><td>("), F.col("page_id").cast("string"), F.lit(")</td></tr><tr><td>Net income</td><td>-</td></tr></table>"))
    pages = table(spark, sf_dir, "pages").select("page_id", F.concat(F.col("html"), rows).alias("html"))
    cells = documents.html_tables(pages, "page_id", "html")
    return cells.join(documents.statement_vote(cells, ["page_id", "table_no"]), ["page_id", "table_no"], "left")


@query("""SELECT page_id, 0::BIGINT AS table_no, CASE page_id % 4 WHEN 0 THEN 0 ELSE 1 END::BIGINT AS row_no, CASE page_id % 4 WHEN 0 THEN 18 WHEN 1 THEN 2 ELSE 12 END::BIGINT AS points FROM pages WHERE page_id % 4 < 3""")
def table_value_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole pages, with a table before them that shows the value in thousands, negative, in millions with a decimal, or not at all"""
    k = F.col("page_id") % 4
    rows = F.when(k == 0, "<tr><td>Total assets</td><td>$ 1,234</td></tr><tr><td>Other</td><td>(1,234)</td></tr>").when(k == 1, "<tr><td>Assets</td><td>99</td></tr><tr><td>Other</td><td>(1,234)</td></tr>").when(k == 2, "<tr><td>Assets</td><td>99</td></tr><tr><td>Other</td><td>1.2</td></tr>").otherwise("<tr><td>Total assets</td><td>77</td></tr>")
    pages = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("<table>"), rows, F.lit("</table>"), F.coalesce("html", F.lit(""))).alias("html"))
    cells = documents.html_tables(pages, "page_id", "html")
    out = documents.tables_with_value(cells, ["page_id"], 1_234_000.0, "assets")
    return out.select("page_id", *[F.col(c).cast("bigint").alias(c) for c in ("table_no", "row_no", "points")])


_SEARCH = r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents),
h AS (SELECT *, list_distinct(regexp_extract_all(lower(line), '[a-z]{4,}')) AS ws, contains(lower(line), 'this from') AS d FROM l), k AS (SELECT *, list_contains(ws, 'this')::INT + list_contains(ws, 'from')::INT AS w FROM h),
f AS (SELECT * FROM (SELECT *, max(w) OVER (PARTITION BY doc_id) AS m FROM k WHERE w > 0 OR d) WHERE d OR (m = 2 AND w = 2) OR (m < 2 AND w > 0)),
g AS (SELECT *, CASE WHEN line_no - lag(line_no) OVER (PARTITION BY doc_id ORDER BY line_no) <= 6 THEN 0 ELSE 1 END AS fresh FROM f), b AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY line_no) AS block FROM g)
SELECT doc_id, greatest(min(line_no) - 3, 0)::BIGINT AS first, (max(line_no) + 3)::BIGINT AS last, count(*) AS hits FROM b WHERE block <= 15 GROUP BY doc_id, block"""


def _lines_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


@query(_SEARCH)
def text_search_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M11"""
    out = documents.search_blocks(_lines_of(spark, sf_dir), ["doc_id"], "this from")
    return out.select("doc_id", F.col("first").cast("bigint").alias("first"), F.col("last").cast("bigint").alias("last"), "hits")


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents), w AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(line), '[a-z]{4,}'))) AS word FROM l) SELECT word, count(*) AS lines, count(DISTINCT doc_id) AS documents FROM w GROUP BY word""")
def text_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The word index"""
    return documents.word_index(_lines_of(spark, sf_dir), ["doc_id"]).groupBy("word").agg(F.count("*").alias("lines"), F.count_distinct("doc_id").alias("documents"))


@query("""SELECT doc_id, CASE WHEN length(text) >= 900 THEN 'Item 7. Management''s Discussion ' || text END AS section FROM documents""")
def section_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts after a table of contents; short texts have no heading"""
    head = "Item 7. Management's Discussion "
    whole = F.concat(F.lit("Contents\n" + head + "12\n"), F.lit("Item 8. Statements 40\n"), F.lit(head), "text", F.lit("Item 8. Statements and more"))
    text = F.when(F.length("text") >= 900, whole).otherwise(F.concat(F.lit("None here. "), F.col("text")))
    return table(spark, sf_dir, "documents").select("doc_id", documents.section(text).alias("section"))


@query("""SELECT page_id, page_id % 3 = 0 AND page_id % 2 = 0 AS annual FROM pages""")
def annual_covers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D22"""
    k = F.col("page_id")
    cover = F.when(k % 3 == 0, "☒ ANNUAL REPORT pursuant to").otherwise("☐ ANNUAL REPORT ☒ TRANSITION REPORT")
    return table(spark, sf_dir, "pages").select("page_id", documents.annual_cover(F.when(k % 2 == 0, "20-F").otherwise("6-K"), F.lit("2024-03-31"), cover).alias("annual"))


# --- guidance ---------------------------------------------------------------


@query("""WITH g AS (SELECT o_orderkey, o_orderkey % 5 AS k, round(o_totalprice * 100)::BIGINT AS v, o_orderpriority AS metric FROM orders),
b AS (SELECT *, CASE k WHEN 0 THEN v * 0.9 WHEN 1 THEN v * 1.0 WHEN 3 THEN v - 1000.0 WHEN 4 THEN NULL END::DOUBLE AS low, CASE k WHEN 0 THEN v * 1.1 WHEN 2 THEN v * 1.0 WHEN 3 THEN v + 1000.0 WHEN 4 THEN NULL END::DOUBLE AS high FROM g),
a AS (SELECT *, (v + 1500 * (o_orderkey % 3 - 1))::DOUBLE AS actual FROM b)
SELECT o_orderkey, low, high, CASE WHEN actual > high THEN CASE WHEN o_orderkey % 2 = 0 THEN 'miss' ELSE 'beat' END WHEN actual < low THEN CASE WHEN o_orderkey % 2 = 0 THEN 'beat' ELSE 'miss' END ELSE 'inline' END AS outcome FROM a""")
def guidance_band_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M03"""
    k = F.col("o_orderkey") % 5
    v = F.round(F.col("o_totalprice") * 100).cast("bigint").cast("double")
    form = F.when(k == 0, "range").when(k == 1, "min").when(k == 2, "max").when(k == 3, "point").otherwise("qualitative")
    made = guidance.band(form, v, F.when(k == 0, v * 0.9), F.when(k == 0, v * 1.1), F.when(k == 3, 1000.0), F.lit("absolute"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", made.alias("b"), (v + 1500 * (F.col("o_orderkey") % 3 - 1)).alias("actual"))
    low, high = F.col("b.low"), F.col("b.high")
    metric = F.when(F.col("o_orderkey") % 2 == 0, "Operating expense").otherwise("Revenue")
    return o.select("o_orderkey", low.alias("low"), high.alias("high"), guidance.score(F.col("actual"), low, high, metric).alias("outcome"))


@query("""WITH e AS (SELECT event_id, user_id, event_type, event_id % 4 = 0 AS qualitative, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS position FROM events),
r AS (SELECT *, min(position) OVER (PARTITION BY user_id, event_type) AS place, row_number() OVER (PARTITION BY user_id, event_type ORDER BY qualitative, position) AS n FROM e)
SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY place) AS k FROM r WHERE n = 1) WHERE k <= 3""")
def guidance_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M05"""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", (F.col("event_id") % 4 == 0).alias("qualitative"), F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")).alias("position"))
    return guidance.deduplicated(e, ["user_id"], ["event_type"], 3).select("user_id", "event_type", "event_id")


@query("""WITH r AS (SELECT event_id AS id, user_id, event_type, event_id % 50 = 0 AS manual FROM events)
SELECT id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY manual DESC, id DESC) = 1 AS is_current, lag(id) OVER (PARTITION BY user_id, event_type ORDER BY id) AS supersedes FROM r""")
def guidance_supersede(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who precedes whom"""
    r = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), "user_id", "event_type", (F.col("event_id") % 50 == 0).alias("manual"))
    return guidance.superseded(r, ["user_id", "event_type"], [F.col("id")]).select("id", "is_current", "supersedes")


@query("""WITH o AS (SELECT o_orderkey, year(o_orderdate) AS fy, quarter(o_orderdate) AS q, o_orderkey % 3 AS k FROM orders),
p AS (SELECT *, CASE WHEN k = 0 THEN CASE WHEN q = 4 THEN fy + 1 ELSE fy END WHEN k = 1 THEN fy + 1 ELSE fy - 1 END AS gfy, CASE WHEN k = 0 THEN CASE WHEN q = 4 THEN 1 ELSE q + 1 END WHEN k = 2 THEN 2 END AS gq FROM o)
SELECT o_orderkey, gfy::BIGINT AS fiscal_year, gq::BIGINT AS quarter, gfy * 4 + coalesce(gq, 4) > fy * 4 + q AS future, gfy * 4 + coalesce(gq, 4) <= fy * 4 + q AS arrived,
  CASE o_orderkey % 4 WHEN 0 THEN 1e3 WHEN 1 THEN 1e6 WHEN 2 THEN 1e9 ELSE 1.0 END::DOUBLE AS factor FROM p""")
def guidance_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M01, M02, M06"""
    k, fy, q = F.col("o_orderkey") % 3, F.year("o_orderdate"), F.quarter("o_orderdate")
    said_fy, said_q = F.when(k == 1, fy + 1).when(k == 2, fy - 1), F.when(k == 2, 2)
    period = guidance.default_period(said_fy, said_q, fy, F.when(k >= 0, q), F.when(k == 1, "annual").otherwise("quarterly"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", period.alias("p"), fy.alias("fy"), q.alias("q"))
    scale = F.when(F.col("o_orderkey") % 4 == 0, "thousands").when(F.col("o_orderkey") % 4 == 1, "Millions").when(F.col("o_orderkey") % 4 == 2, "billions").otherwise("billions")
    metric = F.when(F.col("o_orderkey") % 4 == 3, "Earnings per share").otherwise("Revenue")
    g = (F.col("p.fiscal_year"), F.col("p.quarter"))
    return o.select("o_orderkey", g[0].alias("fiscal_year"), g[1].alias("quarter"), guidance.is_future(*g, F.col("fy"), F.col("q")).alias("future"), guidance.arrived(*g, F.col("fy"), F.col("q")).alias("arrived"), guidance.multiplier(scale, metric, F.lit("USD")).alias("factor"))
