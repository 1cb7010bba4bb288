"""Queries over contexts, periods and filings that are kept or dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import periods as P
from ..functions import text as T
from ..operators import select
from .registry import query, table
from .tables import ORDER_FACTS, WITH_CALENDAR, fiscal_sql, order_facts, with_calendar

#: Member, whether its name alone excludes a fact, whether it excludes an item (where whole words count too).
_MEMBERS = [
    ("us-gaap:ForeignExchangeContractMember", True, True), ("co:ForeignExchangeContractMember", False, False), ("InterestRateContractMember", True, True),
    ("us-gaap:AdditionalPaidInCapitalMember", True, True), ("us-gaap:AccumulatedOtherComprehensiveIncomeMember", True, True), ("srt:AllSegmentsMember", True, True),
    ("srt:MaterialReconcilingItemsMember", True, True), ("us-gaap:ErrorCorrectionMember", True, True), ("us-gaap:PlannedMember", True, True),
    ("us-gaap:ProjectedMember", True, True), ("co:ReportableSegmentMember", False, True), ("us-gaap:LifeInsuranceSegmentMember", False, False),
    ("co:WidgetMember", False, False), ("co:ProjectedSalesMember", False, True), ("us-gaap:RestatementMember", True, True),
    ("us-gaap:IntersubsegmentEliminationsMember", True, True), ("co:RestatementsMember", False, False),
]
_MEMBER_ROWS = ", ".join(f"({k}, '{m}', {a}, {b})" for k, (m, a, b) in enumerate(_MEMBERS))
_N = len(_MEMBERS)


def _member(k):
    return F.element_at(F.array(*[F.lit(m) for m, _, _ in _MEMBERS]), (k % _N + 1).cast("int"))


@query(f"""WITH m(i, member, fact, item) AS (VALUES {_MEMBER_ROWS})
SELECT p_partkey, fact OR p_partkey % 7 = 0 OR p_partkey % 11 = 0 AS fact_excluded, item OR p_partkey % 7 = 0 AS item_excluded FROM part JOIN m ON i = p_partkey % {_N}""")
def context_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D07, D09"""
    k = F.col("p_partkey")
    axis = F.when(k % 7 == 0, "srt:StatementScenarioAxis").otherwise("srt:ProductOrServiceAxis")
    label = F.when(k % 11 == 0, F.concat("p_name", F.lit(" Change in Estimate"))).otherwise(F.concat("p_name", F.lit(" exchange")))
    details = F.create_map(axis, F.struct(F.lit(None).cast("string").alias("axis_qname"), F.lit(None).cast("string").alias("member_qname"), label.alias("member_label")))
    item = F.array(F.struct(axis.alias("axis"), _member(k).alias("member")))
    return table(spark, sf_dir, "part").select("p_partkey", select.excluded_fact(F.create_map(axis, _member(k)), details).alias("fact_excluded"), select.excluded_item(item).alias("item_excluded"))


@query(f"""WITH m(i, member, fact, item) AS (VALUES {_MEMBER_ROWS})
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, (CASE WHEN b.fact THEN 0 ELSE 1 END + CASE WHEN c.fact OR l_partkey % 3 = 0 THEN 0 ELSE 1 END)::BIGINT AS facts
FROM lineitem JOIN m a ON a.i = l_partkey % {_N} JOIN m b ON b.i = (l_partkey + 1) % {_N} JOIN m c ON c.i = (l_partkey + l_suppkey) % {_N} WHERE NOT a.item""")
def statement_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D10"""
    k, axis = F.col("l_partkey"), "srt:ProductOrServiceAxis"
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<struct<axis_qname:string,member_qname:string,member_label:string>>"))
    detail = F.create_map(F.lit("a"), F.struct(F.when(k % 3 == 0, "us-gaap:RestatementAxis").alias("axis_qname"), F.lit("x").alias("member_qname"), F.lit("Widgets").alias("member_label")))
    facts = F.array(F.struct(F.create_map(F.lit(axis), _member(k + 1)).alias("dimensions"), none.alias("details")), F.struct(F.create_map(F.lit(axis), _member(k + F.col("l_suppkey"))).alias("dimensions"), detail.alias("details")))
    rows = table(spark, sf_dir, "lineitem").withColumns({"dimensions": F.array(F.struct(F.lit(axis).alias("axis"), _member(k).alias("member"))), "facts": facts})
    return select.without_excluded(rows).select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey", "l_suppkey", F.size("facts").cast("bigint").alias("facts"))


_TAGS = [(" [Member]", ""), (" Segment [Member]", " Segment"), (" Segments [domain]", " Segments"), (" [Text Block]", ""), ("  [Policy Text Block]", ""), (" [Line Item]", ""), (" Segment [Axis]", " Segment"), (" [Own Tag]", " [Own Tag]"), (", Segments [Member]", ", Segments"), (" [roll forward rules]", "")]
_TAG_ROWS = ", ".join(f"({k}, '{b}', {'true' if 'egment' in a and ('ember' in a or 'omain' in a) else 'false'})" for k, (a, b) in enumerate(_TAGS))


@query(f"""WITH t(i, kept, segment) AS (VALUES {_TAG_ROWS}), p AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'Geographic' WHEN 1 THEN 'Products' ELSE p_type END AS base FROM part)
SELECT p_partkey, CASE WHEN segment AND base NOT IN ('Geographic', 'Products') THEN base ELSE base || kept END AS label FROM p JOIN t ON i = (p_partkey // 4) % {len(_TAGS)}""")
def label_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B20"""
    k = F.col("p_partkey")
    base = F.when(k % 4 == 0, "Geographic").when(k % 4 == 1, "Products").otherwise(F.col("p_type"))
    tag = F.element_at(F.array(*[F.lit(a) for a, _ in _TAGS]), (F.floor(k / 4) % len(_TAGS) + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", T.clean_label(F.concat(base, tag)).alias("label"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate::DATE >= DATE '2000-06-30' - 1095 WHEN o_orderkey % 3 = 1 THEN o_orderkey % 2 = 0 ELSE o_orderkey % 2 = 1 END AS primary_period FROM orders""")
def primary_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instants, three months and twelve, on a 10-Q and a 10-K"""
    k, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    text = F.when(k % 3 == 0, day.cast("string")).otherwise(F.concat_ws(" to ", F.add_months(day, F.when(k % 3 == 1, -3).otherwise(-12)).cast("string"), day.cast("string")))
    return table(spark, sf_dir, "orders").select("o_orderkey", P.is_primary_period(text, F.when(k % 2 == 0, "10-Q").otherwise("10-K"), F.to_date(F.lit("2000-06-30"))).alias("primary_period"))


_HEADINGS = ["Three Months Ended", "Six Months Ended", "Nine Months Ended", "Twelve Months Ended", "Year Ended", "As of", "Q2 2024 Cumulative", ""]
_HEADING_LIST = ", ".join(f"'{h}'" for h in _HEADINGS)


@query(f"""WITH e AS (SELECT event_id, [{_HEADING_LIST}][event_id % {len(_HEADINGS)} + 1] AS h, CASE WHEN event_id % 3 = 0 THEN '10-Q' ELSE '10-K' END AS form FROM events)
SELECT event_id, h IN ('Three Months Ended', 'Q2 2024 Cumulative') AS quarterly, h IN ('Twelve Months Ended', 'Year Ended') AS annual, h IN ('Six Months Ended', 'Nine Months Ended', 'Twelve Months Ended', 'Q2 2024 Cumulative') AS cumulative,
  CASE h WHEN 'Six Months Ended' THEN 75 WHEN 'Nine Months Ended' THEN 100 WHEN 'Twelve Months Ended' THEN 150 WHEN 'Year Ended' THEN 150 ELSE 50 END AS penalty,
  CASE WHEN h = '' THEN 'none' WHEN form = '10-Q' AND h IN ('Six Months Ended', 'Nine Months Ended', 'Twelve Months Ended') THEN 'cumulative' WHEN form = '10-Q' AND h IN ('Year Ended', 'As of') THEN 'not quarterly'
    WHEN form = '10-K' AND h IN ('Three Months Ended', 'Q2 2024 Cumulative') THEN 'quarterly' ELSE 'ok' END AS reason FROM e""")
def period_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B10, C17"""
    k = F.col("event_id")
    h = F.element_at(F.array(*map(F.lit, _HEADINGS)), (k % len(_HEADINGS) + 1).cast("int"))
    choice = P.period_choice(h, F.when(k % 3 == 0, "10-Q").otherwise("10-K"))
    return table(spark, sf_dir, "events").select("event_id", P.is_quarterly_heading(h).alias("quarterly"), P.is_annual_heading(h).alias("annual"), P.is_cumulative_heading(h).alias("cumulative"), P.cumulative_penalty(h).alias("penalty"), choice["reason"].alias("reason"))


@query("""WITH v AS (SELECT l_orderkey, CASE WHEN l_orderkey % 2 = 0 THEN '10-Q' ELSE '10-K' END AS form, l_linenumber % 4 AS position, l_discount AS value FROM lineitem),
g0 AS (SELECT l_orderkey, form, position, bool_or(value <> 0) AS filled FROM v GROUP BY ALL), g AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n FROM g0),
s AS (SELECT l_orderkey, position, CASE WHEN form = '10-Q' AND position = 0 THEN -10000 WHEN form = '10-Q' AND position = 1 THEN n - position + 1000 WHEN form = '10-Q' THEN n - position - 5000
  WHEN position = 0 OR position = 2 THEN n - position + 100 WHEN position = 1 THEN n - position - 50 ELSE n - position END + 10 + CASE WHEN filled THEN 5 ELSE 0 END AS score FROM g)
SELECT l_orderkey, ['Twelve Months Ended', 'Three Months Ended', 'Year Ended', 'Note'][arg_max(position, score * 10 - position) + 1] AS heading, max(score)::BIGINT AS score FROM s GROUP BY l_orderkey""")
def primary_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D16"""
    at = F.col("l_linenumber") % 4
    heading = F.element_at(F.array(*map(F.lit, ("Twelve Months Ended", "Three Months Ended", "Year Ended", "Note"))), at + 1)
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", F.when(F.col("l_orderkey") % 2 == 0, "10-Q").otherwise("10-K").alias("form"), at.alias("position"), heading.alias("heading"), F.col("l_discount").alias("value"))
    return select.primary_column(rows, ["l_orderkey"], "form").withColumn("score", F.col("score").cast("bigint"))


@query("""WITH r AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, o_orderdate::DATE AS s, CASE WHEN l_linenumber % 5 <> 0 THEN l_shipdate::DATE END AS e FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber::BIGINT AS l_linenumber FROM r WHERE e IS NOT NULL AND l_linenumber <= 3 AND abs((e - s) / 30.4 - 3) <= 0.35""")
def period_length_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D15, B02"""
    lines, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    rows = lines.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "l_partkey", "l_suppkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), F.to_date("o_orderdate").cast("string").alias("period_start"), F.when(F.col("l_linenumber") % 5 != 0, F.to_date("l_shipdate").cast("string")).alias("period_end"))
    target = F.concat(F.date_add(F.to_date("period_end"), (2 * F.col("l_linenumber")).cast("int")).cast("string"), F.lit(" (Q1)"))
    return select.of_period_length(rows, F.coalesce(target, F.lit("1997-03-29 (Q1)")), 3).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


@query("""WITH f AS (SELECT o_custkey, o_orderkey, o_orderdate::DATE AS d FROM orders)
SELECT c_custkey, count(o_orderkey) FILTER (year(d) >= 1997 OR o_orderkey % 9 = 0) AS facts FROM customer LEFT JOIN f ON o_custkey = c_custkey WHERE c_custkey % 4 = 0 OR (1995 + c_custkey % 4) >= 1997 GROUP BY c_custkey""")
def prior_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D13"""
    o = table(spark, sf_dir, "orders")
    fact = F.struct(F.when(F.col("o_orderkey") % 9 == 0, "unknown").otherwise(F.concat(F.lit("1990-01-01 to "), F.to_date("o_orderdate").cast("string"))).alias("period"))
    facts = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.collect_list(fact).alias("facts"))
    k = F.col("c_custkey")
    items = table(spark, sf_dir, "customer").select("c_custkey", F.when(k % 4 != 0, F.concat((1995 + k % 4).cast("string"), F.lit("-06-30"))).alias("period")).join(facts, "c_custkey", "left")
    out = select.without_prior(items, 1997)
    return out.select("c_custkey", F.coalesce(F.when(F.col("facts").isNotNull(), F.size("facts")), F.lit(0)).cast("bigint").alias("facts"))


_YEAR, _ = fiscal_sql("d", "code", "'end'")


@query(f"WITH {WITH_CALENDAR}, y AS (SELECT *, {_YEAR} AS fiscal_year, CASE o_orderkey % 4 WHEN 0 THEN '10-K' WHEN 1 THEN '10-Q' WHEN 2 THEN '20-F' ELSE '8-K' END AS form, o_orderkey % 6 <> 2 AS dated, year(d + 60) AS filed FROM k) SELECT o_orderkey, form FROM y WHERE form <> '8-K' AND (form <> '20-F' OR dated) AND (filed >= 1998 OR (dated AND fiscal_year >= 1998)) AND (filed <= 1999 OR (dated AND fiscal_year <= 1999))")
def filings_in_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A02, A03"""
    o, k = with_calendar(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")), F.col("o_orderkey")
    day = F.to_date("o_orderdate")
    o = o.select("o_orderkey", "code", F.when(k % 4 == 0, "10-K").when(k % 4 == 1, "10-Q").when(k % 4 == 2, "20-F").otherwise("8-K").alias("form"), F.date_add(day, 60).cast("string").alias("filed"), F.when(k % 6 != 2, day.cast("string")).otherwise("").alias("reported"))
    return o.filter(P.in_years(F.col("form"), F.col("filed"), F.col("reported"), F.col("code"), 1998, 1999)).select("o_orderkey", "form")


@query(f"""WITH {ORDER_FACTS}, s AS (SELECT cik, max(end_date) AS mark FROM o WHERE fiscal_year < 1998 AND cik::BIGINT % 5 <> 0 GROUP BY cik),
f AS (SELECT cik, accession, CASE quarter WHEN 4 THEN '10-K' WHEN 3 THEN '8-K' ELSE '10-Q' END AS form, CASE WHEN value % 3 = 0 THEN NULL ELSE end_date END AS reported, end_date + 30 AS filed FROM o),
n AS (SELECT f.* FROM f LEFT JOIN s USING (cik) WHERE mark IS NULL OR coalesce(reported, filed) > mark)
SELECT cik, accession, filed::VARCHAR AS filed, row_number() OVER (PARTITION BY cik ORDER BY form = '8-K', filed DESC, accession) = 1 AND form <> '8-K' AS newest FROM n""")
def newer_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N03, D21"""
    o = order_facts(spark, sf_dir)
    stored = o.filter("fiscal_year < 1998 and cast(cik as bigint) % 5 <> 0").select("cik", "end_date")
    form = F.when(F.col("quarter") == 4, "10-K").when(F.col("quarter") == 3, "8-K").otherwise("10-Q")
    filings = o.select("cik", "accession", form.alias("form"), F.when(F.col("value") % 3 != 0, F.col("end_date").cast("string")).alias("report_date"), F.date_add("end_date", 30).cast("string").alias("filing_date"))
    new = select.newer_filings(filings, stored, ["cik"])
    newest = select.latest_filing(new, ["cik"]).select("cik", "accession", F.lit(True).alias("newest"))
    return new.join(newest, ["cik", "accession"], "left").select("cik", "accession", F.col("filing_date").alias("filed"), F.coalesce("newest", F.lit(False)).alias("newest"))


@query("""WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderdate::DATE AS s, l_shipdate::DATE AS e, CASE l_orderkey % 3 WHEN 0 THEN '10-Q' WHEN 1 THEN '10-K' ELSE '6-K' END AS form, l_linenumber % 2 = 0 AS instant FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
d AS (SELECT *, (e - s) / 30.4 AS m, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, e) AS position FROM b),
k AS (SELECT *, CASE WHEN instant THEN e = max(e) FILTER (instant AND l_suppkey % 5 <> 0) OVER (PARTITION BY l_orderkey) ELSE abs(m - 3) <= 0.35 END AS current FROM d),
x AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey % 3, l_suppkey % 2, instant, CASE WHEN instant THEN NULL ELSE s END, e ORDER BY position) AS n FROM k WHERE form <> '10-K' AND current AND l_suppkey % 5 <> 0)
SELECT l_orderkey, position FROM x WHERE n = 1 AND l_suppkey % 2 = 1 UNION ALL SELECT l_orderkey, position FROM d WHERE form = '10-K' AND l_suppkey % 5 <> 0 AND (instant OR m BETWEEN 11 AND 13 OR m BETWEEN 2.5 AND 4)""")
def current_dimensional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth supplier has no dimensions, every second member is a forecast"""
    from pyspark.sql import Window

    lines, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    s, e, k = F.to_date("o_orderdate"), F.to_date("l_shipdate"), F.col("l_orderkey") % 3
    position = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"))
    period = F.when(F.col("l_linenumber") % 2 == 0, e.cast("string")).otherwise(F.concat_ws(" to ", s.cast("string"), e.cast("string")))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    member = F.when(F.col("l_suppkey") % 2 == 0, "srt:ScenarioForecastMember").otherwise("co:OwnMember")
    details = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<struct<axis_qname:string,member_qname:string,member_label:string>>"))
    null = F.lit(None)
    rows = lines.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", position.cast("bigint").alias("position"), period.alias("period"), F.when(k == 0, "10-Q").when(k == 1, "10-K").otherwise("6-K").alias("form"), (F.col("l_partkey") % 3).alias("concept"),
        F.when(F.col("l_suppkey") % 5 == 0, empty).otherwise(F.create_map(F.lit("srt:ProductOrServiceAxis"), member)).alias("dimensions"), details.alias("details"),
        null.cast("int").alias("fiscal_year"), null.cast("int").alias("quarter"), null.cast("string").alias("code"), F.lit("end").alias("convention"),
    )
    return select.current_dimensional(rows, ["l_orderkey"]).select("l_orderkey", "position")


@query("""WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderdate::DATE AS s, l_shipdate::DATE AS e, year(l_shipdate) AS fy, quarter(l_shipdate) AS q, l_orderkey % 2 = 0 AS quarterly FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
d AS (SELECT *, (e - s) / 30.4 AS m, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, e) AS position, make_date(fy, 3 * q - 2, 1) AS qs, last_day(make_date(fy, 3 * q, 1)) AS qe FROM b),
x AS (SELECT *, bool_or(abs(m - 12) <= 1) OVER (PARTITION BY l_orderkey, e) AS hit, row_number() OVER (PARTITION BY l_orderkey, e ORDER BY abs(m - 12), position) AS n FROM d)
SELECT l_orderkey, position FROM x WHERE CASE WHEN quarterly THEN (CASE WHEN e <= make_date(fy - 1, 12, 31) + 7 THEN fy - 1 ELSE fy END) = fy AND abs(e - qe) <= 7 AND abs(s - qs) <= 7 AND abs(m - 3) <= 0.35 ELSE abs(m - 12) <= 1 OR (NOT hit AND n = 1) END""")
def target_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D05"""
    from pyspark.sql import Window

    lines, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    s, e = F.to_date("o_orderdate"), F.to_date("l_shipdate")
    position = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"))
    rows = lines.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", position.cast("bigint").alias("position"), F.concat_ws(" to ", s.cast("string"), e.cast("string")).alias("period"), F.when(F.col("l_orderkey") % 2 == 0, "10-Q").otherwise("10-K").alias("form"),
        F.year(e).alias("fiscal_year"), F.quarter(e).alias("quarter"), F.lit("1231").alias("code"), F.lit("end").alias("convention"),
    )
    return select.duration_facts(rows, ["l_orderkey"]).select("l_orderkey", "position")


_CONCEPTS = [("us-gaap:Assets", False, False), ("us-gaap:StatementTable", False, True), ("dei:EntityName", False, True), ("us-gaap:OwnAxis", False, True), ("us-gaap:AssetsAbstract", True, True), ("us-gaap:PlanDomain", True, True), ("us-gaap:BrandMember", True, False), ("us-gaap:Debt", True, False), ("us-gaap:IncomeStatementAbstract", False, True)]
_CONCEPT_ROWS = ", ".join(f"({k}, '{c}', {a}, {x})" for k, (c, a, x) in enumerate(_CONCEPTS))


@query(f"""WITH c(i, concept, abstract, structural) AS (VALUES {_CONCEPT_ROWS}) SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, structural, structural OR (concept = 'us-gaap:BrandMember' AND l_suppkey % 2 = 0) AS irrelevant,
  l_returnflag <> 'R' AND NOT abstract AND l_linestatus = 'O' AND l_suppkey % 7 <> 0 AS capturable FROM lineitem JOIN c ON i = l_partkey % {len(_CONCEPTS)}""")
def concept_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D17, D18"""
    at = (F.col("l_partkey") % len(_CONCEPTS) + 1).cast("int")
    concept, abstract = F.element_at(F.array(*[F.lit(c) for c, _, _ in _CONCEPTS]), at), F.element_at(F.array(*[F.lit(a) for _, a, _ in _CONCEPTS]), at)
    namespace = F.when(F.col("l_linestatus") == "O", "http://fasb.org/us-gaap/2024").otherwise("http://xbrl.sec.gov/dei/2024")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey", "l_suppkey", select.structural_concept(concept, abstract).alias("structural"), select.irrelevant_concept(concept, abstract, F.col("l_suppkey") % 2 == 1).alias("irrelevant"),
        select.capturable(F.col("l_returnflag") != "R", abstract, namespace, F.col("l_suppkey") % 7 == 0).alias("capturable"),
    )


@query("""SELECT l_orderkey, bool_or(l_returnflag = 'A' AND l_linestatus = 'O') OR bool_or(l_suppkey % 11 = 0) AS has_data FROM lineitem GROUP BY l_orderkey""")
def statement_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open returned lines have a value, every eleventh supplier a nested one"""
    value = F.when(F.col("l_linestatus") == "O", F.col("l_quantity"))
    facts = F.array(F.struct(F.lit(None).cast("double").alias("value")), F.struct(F.when(F.col("l_suppkey") % 11 == 0, F.col("l_tax")).alias("value")))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_returnflag") != "A").alias("abstract"), value.alias("value"), facts.alias("facts"))
    return select.statements_with_data(rows, ["l_orderkey"])


@query(f"""WITH {ORDER_FACTS}, u AS (SELECT cik, fiscal_year, CASE WHEN cik::BIGINT % 3 = 0 THEN 'EUR' WHEN cik::BIGINT % 3 = 1 AND quarter = 1 THEN 'EUR' WHEN cik::BIGINT % 3 = 1 THEN 'USD' END AS unit FROM o)
SELECT cik, fiscal_year, CASE WHEN count(DISTINCT unit) = 1 THEN max(unit) ELSE 'USD' END AS currency, CASE WHEN count(DISTINCT unit) = 1 THEN max(unit) ELSE 'USD' END = 'USD' AS safe FROM u GROUP BY ALL""")
def filing_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B15, B16"""
    from ..operators.dimensions import filing_currency as currency

    k = F.col("cik").cast("bigint") % 3
    rows = order_facts(spark, sf_dir).select("cik", "fiscal_year", F.when(k == 0, "iso4217:eur").when((k == 1) & (F.col("quarter") == 1), "EUR").when(k == 1, "usd").alias("unit"))
    out = currency(rows, ["cik", "fiscal_year"])
    return out.withColumn("safe", T.is_usd_safe(F.col("currency")))


@query("""WITH l(name, label) AS (VALUES ('Assets', 'Total assets'), ('us-gaap_Debt', 'Debt, net'), ('us-gaap_Assets', 'Assets of us-gaap')),
p AS (SELECT p_partkey, ['us-gaap:Assets', 'Debt', 'us-gaap_Debt', 'co:Unknown', ' us-gaap_Assets', 'us-gaap_Cash'][p_partkey % 6 + 1] AS concept FROM part)
SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'Total assets' WHEN 1 THEN 'Debt, net' WHEN 2 THEN 'Debt, net' WHEN 3 THEN 'co:Unknown' WHEN 4 THEN 'Assets of us-gaap' ELSE 'us-gaap_Cash' END AS label FROM p""")
def concept_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B23"""
    from ..operators.lookups import concept_label

    names = ("us-gaap:Assets", "Debt", "us-gaap_Debt", "co:Unknown", " us-gaap_Assets", "us-gaap_Cash")
    rows = table(spark, sf_dir, "part").select("p_partkey", F.element_at(F.array(*map(F.lit, names)), (F.col("p_partkey") % 6 + 1).cast("int")).alias("concept"))
    labels = spark.createDataFrame([("Assets", "Total assets"), ("us-gaap_Debt", "Debt, net"), ("us-gaap_Assets", "Assets of us-gaap")], "concept string, label string")
    return concept_label(rows, labels).select("p_partkey", "label")


@query("""WITH f AS (SELECT c_custkey, o_orderkey, row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderkey) AS position, make_date(year(o_orderdate), 1 + (o_orderkey % 4)::INT, 28) AS e, o_orderkey % 3 AS r, c_custkey % 2 = 0 AS starts FROM customer JOIN orders ON o_custkey = c_custkey),
a AS (SELECT *, CASE WHEN starts THEN year(e) - 1 ELSE year(e) END AS fy FROM f),
x AS (SELECT c_custkey, r, position, CASE WHEN month(e) <= 2 THEN CASE WHEN fy = year(e) THEN 'end' ELSE 'start' END END AS c FROM a),
g AS (SELECT c_custkey, r, arg_max(c, position) FILTER (c IS NOT NULL) AS c FROM x WHERE r < 2 GROUP BY ALL)
SELECT c_custkey AS cik, arg_min(coalesce(c, ''), r) AS convention FROM g GROUP BY c_custkey""")
def facts_convention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenues, then assets decide; a third concept isn't listed"""
    from pyspark.sql import Window

    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    end = F.make_date(F.year("o_orderdate"), (1 + k % 4).cast("int"), F.lit(28))
    fy = F.when(F.col("o_custkey") % 2 == 0, F.year(end) - 1).otherwise(F.year(end))
    facts = o.select(F.col("o_custkey").alias("cik"), F.when(k % 3 == 0, "Revenues").when(k % 3 == 1, "Assets").otherwise("Goodwill").alias("concept"), F.lit("USD").alias("unit"), F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).alias("position"), F.lit("10-K").alias("form"), F.lit("FY").alias("fp"), fy.alias("fy"), end.cast("string").alias("end"))
    return select.convention_of_facts(facts).withColumn("convention", F.coalesce("convention", F.lit("")))


_END, _ = fiscal_sql("d", "code", "'end'")
_START, _ = fiscal_sql("d", "code", "'start'")
_FY, _Q = fiscal_sql("d", "code", "'end'")


@query(f"""WITH {WITH_CALENDAR}, y AS (SELECT *, {_FY} AS fiscal_year, {_START} AS as_start, year(d) AS labelled FROM k)
SELECT o_orderkey, (CASE o_orderkey % 4 WHEN 0 THEN 4 WHEN 1 THEN {_Q} END)::BIGINT AS quarter, CASE WHEN fiscal_year = labelled AND as_start <> labelled THEN 'end' WHEN as_start = labelled AND fiscal_year <> labelled THEN 'start' END AS convention FROM y""")
def form_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C07, C10"""
    o = with_calendar(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")).withColumn("d", F.to_date("o_orderdate"))
    k = F.col("o_orderkey") % 4
    form = F.when(k == 0, "10-K").when(k == 1, "10-Q").when(k == 2, "20-F").otherwise("8-K")
    return o.select("o_orderkey", P.quarter_by_form(form, F.col("d"), F.col("code")).cast("bigint").alias("quarter"), P.convention_from_anchor(F.col("d"), F.col("code"), F.year("d")).alias("convention"))


@query("""SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, CASE WHEN l_partkey % 2 = 0 THEN l_partkey ELSE l_suppkey END AS anchor, l_partkey % 2 = 0 OR l_returnflag = 'A' AS dimensional,
  CASE WHEN l_partkey % 2 = 0 AND l_suppkey % 2 = 0 THEN l_partkey = l_suppkey ELSE l_returnflag = l_linestatus END AS same_parent, split_part('us-gaap:Net:Sales', ':', 2) || ':' || split_part('us-gaap:Net:Sales', ':', 3) AS local FROM lineitem""")
def parent_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L02, L04, B17"""
    left, right = F.when(F.col("l_partkey") % 2 == 0, F.col("l_partkey")), F.when(F.col("l_suppkey") % 2 == 0, F.col("l_suppkey"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey", "l_suppkey", T.parent_anchor(left, F.col("l_suppkey")).alias("anchor"), T.is_dimensional(left, F.when(F.col("l_returnflag") == "A", F.lit("x"))).alias("dimensional"),
        T.same_parent(left, F.col("l_returnflag"), right, F.col("l_linestatus")).alias("same_parent"), T.name_after_first_colon(F.lit("us-gaap:Net:Sales")).alias("local"),
    )


