"""Queries over statements: signs, subtotals, checks, decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import decide, derive, signs, validate
from .registry import query, table
from .tables import cents

INCOME = ("Revenues", "CostOfRevenue", "SellingGeneralAndAdministrativeExpense", "ResearchAndDevelopmentExpense", "OperatingIncomeLoss", "GrossProfit", "NetIncomeLoss")
BALANCE = ("AssetsCurrent", "PropertyPlantAndEquipmentNet", "Goodwill", "Assets", "LiabilitiesCurrent", "LongTermDebtNoncurrent", "StockholdersEquity")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """filing, statement_type, position, concept, label, value (cents), abstract, path, order_key, level, period."""
    li = table(spark, sf_dir, "lineitem")
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    odd = F.col("l_orderkey") % 2 == 1
    name = F.when(odd, F.element_at(F.array(*map(F.lit, BALANCE)), F.col("l_linenumber"))).otherwise(F.element_at(F.array(*map(F.lit, INCOME)), F.col("l_linenumber")))
    return li.select(
        F.col("l_orderkey").alias("filing"),
        F.when(odd, "balancesheet").otherwise("income").alias("statement_type"),
        F.row_number().over(order).cast("bigint").alias("position"),
        F.concat(F.lit("us-gaap:"), name).alias("concept"),
        F.lit(None).cast("string").alias("label"),
        cents("l_extendedprice").alias("value"),
        F.lit(False).alias("abstract"),
        F.when(F.col("l_linenumber") == 1, "001").otherwise(F.concat(F.lit("00"), (F.col("l_linenumber") / 2).cast("int").cast("string"), F.lit(".00"), F.col("l_linenumber").cast("string"))).alias("path"),
        F.when(F.col("l_linenumber") < 7, "a").alias("order_key"),
        (F.col("l_linenumber") - 2).alias("level"),
        F.concat_ws(" to ", F.to_date("l_shipdate").cast("string"), F.date_add("l_shipdate", F.col("l_linenumber") * 70).cast("string")).alias("period"),
    )


def _names(names: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


LINES = f"""
s AS (
  SELECT l_orderkey AS filing, CASE WHEN l_orderkey % 2 = 1 THEN 'balancesheet' ELSE 'income' END AS statement_type,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS position,
    'us-gaap:' || CASE WHEN l_orderkey % 2 = 1 THEN {_names(BALANCE)}[l_linenumber] ELSE {_names(INCOME)}[l_linenumber] END AS concept,
    round(l_extendedprice * 100)::BIGINT AS value,
    CASE WHEN l_linenumber = 1 THEN '001' ELSE '00' || (l_linenumber // 2)::VARCHAR || '.00' || l_linenumber::VARCHAR END AS path,
    CASE WHEN l_linenumber < 7 THEN 'a' END AS order_key, l_linenumber - 2 AS level, l_linenumber * 70 AS days
  FROM lineitem
)"""


def _first(*names: str) -> str:
    return f"arg_min(value, position) FILTER (concept IN ({', '.join(chr(39) + 'us-gaap:' + n + chr(39) for n in names)}))"


INCOME_ROLES = f"""
r AS (SELECT filing, {_first('Revenues')} AS revenue, {_first('CostOfRevenue')} AS cost, {_first('GrossProfit')} AS gross, {_first('OperatingIncomeLoss')} AS income,
  {_first('SellingGeneralAndAdministrativeExpense')} AS total, count(*) FILTER (concept LIKE '%Expense') AS n, sum(abs(value)) FILTER (concept LIKE '%Expense')::BIGINT AS kids FROM s WHERE statement_type = 'income' GROUP BY filing),
g AS (SELECT *, CASE WHEN gross IS NULL THEN revenue - abs(cost) END AS new_gross, coalesce(gross, revenue - abs(cost)) AS any_gross FROM r),
x AS (SELECT *, CASE WHEN n >= 2 AND kids > 0 AND coalesce(abs(kids - (any_gross - income)) <= greatest(abs(any_gross - income) * 0.02, 1.0), true) THEN kids END AS new_expenses FROM g),
z AS (SELECT *, CASE WHEN income IS NULL THEN any_gross - abs(coalesce(new_expenses, total)) END AS new_income FROM x)"""


_INCOME_SQL = f"""WITH {LINES}, {INCOME_ROLES}
SELECT filing, 'us-gaap:GrossProfit' AS concept, new_gross AS value FROM z WHERE new_gross IS NOT NULL
UNION ALL SELECT filing, 'us-gaap:OperatingExpenses', new_expenses FROM z WHERE new_expenses IS NOT NULL
UNION ALL SELECT filing, 'us-gaap:OperatingIncomeLoss', new_income FROM z WHERE new_income IS NOT NULL"""


@query(_INCOME_SQL)
def derived_subtotals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I01, I02, I03"""
    return derive.income_subtotals(lines(spark, sf_dir).filter("statement_type = 'income'"), ["filing"])


_BALANCE_SQL = f"""WITH {LINES}, r AS (
  SELECT filing, {_first('Assets')} AS assets, min(position) FILTER (concept = 'us-gaap:Assets') AS a_at, {_first('AssetsCurrent')} AS ac, min(position) FILTER (concept = 'us-gaap:AssetsCurrent') AS ac_at,
    {_first('LiabilitiesCurrent')} AS lc, min(position) FILTER (concept = 'us-gaap:LiabilitiesCurrent') AS lc_at, {_first('StockholdersEquity')} AS eq, min(position) FILTER (concept = 'us-gaap:StockholdersEquity') AS eq_at
  FROM s WHERE statement_type = 'balancesheet' GROUP BY filing
), l AS (SELECT *, CASE WHEN coalesce(assets - eq >= lc - 1.0, true) THEN assets - eq END AS liabilities, CASE WHEN eq_at > lc_at THEN eq_at END AS last_at FROM r),
c AS (
  SELECT l.filing, count(*) FILTER (s.position BETWEEN ac_at + 1 AND a_at - 1 AND concept <> 'us-gaap:Assets') AS n_a,
    count(*) FILTER (s.position > lc_at AND coalesce(s.position < last_at, true) AND concept <> 'us-gaap:StockholdersEquity') AS n_b
  FROM l JOIN s USING (filing) WHERE statement_type = 'balancesheet' GROUP BY l.filing
), z AS (SELECT *, CASE WHEN n_a >= 2 AND assets - ac >= -1 THEN assets - ac END AS anc, CASE WHEN n_b >= 2 AND liabilities - lc >= -1 THEN liabilities - lc END AS lnc FROM l JOIN c USING (filing))
SELECT filing, 'us-gaap:Liabilities' AS concept, liabilities AS value FROM z WHERE liabilities IS NOT NULL
UNION ALL SELECT filing, 'us-gaap:AssetsNoncurrent', anc FROM z WHERE anc IS NOT NULL
UNION ALL SELECT filing, 'us-gaap:LiabilitiesNoncurrent', lnc FROM z WHERE lnc IS NOT NULL"""


@query(_BALANCE_SQL)
def balance_subtotals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I04, I05, I06"""
    return derive.balance_subtotals(lines(spark, sf_dir).filter("statement_type = 'balancesheet'"), ["filing"])


@query(f"""SELECT filing, 'income' AS statement_type, concept, value FROM ({_INCOME_SQL}) UNION ALL SELECT filing, 'balancesheet', concept, value FROM ({_BALANCE_SQL})""")
def all_subtotals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules by the statement's kind"""
    return derive.subtotals(lines(spark, sf_dir), ["filing"])


@query("""WITH v AS (SELECT o_custkey, year(o_orderdate) AS period, o_orderpriority AS concept, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS value FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY ALL)
SELECT o_custkey, period::BIGINT AS period, sum(CASE WHEN concept = '1-URGENT' THEN value ELSE -abs(value) END)::BIGINT AS value FROM v GROUP BY ALL HAVING count(*) = 2""")
def derived_comparatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I07"""
    o = table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").cast("bigint").alias("period"), F.col("o_orderpriority").alias("concept"), cents("o_totalprice").alias("value"))
    v = o.groupBy("o_custkey", "period", "concept").agg(F.sum("value").alias("value"))
    return derive.comparatives(v, ["o_custkey"], "period", {"1-URGENT": 1, "2-HIGH": -1})


_MATH = f"""{LINES}, r AS (
  SELECT filing, {_first('Revenues')} AS revenue, {_first('CostOfRevenue')} AS cost, {_first('GrossProfit')} AS gross FROM s WHERE statement_type = 'income' GROUP BY filing
), m AS (
  SELECT filing, 'math_mismatch' AS type, 'high' AS severity, 'income' AS statement_type, 'us-gaap:GrossProfit' AS concept, gross AS target, revenue - cost AS expected FROM r
  WHERE revenue IS NOT NULL AND cost IS NOT NULL AND gross IS NOT NULL AND abs(gross - (revenue - cost)) > greatest(abs(gross) * 0.005, 1.0) AND abs(gross - (revenue - abs(cost))) > greatest(abs(gross) * 0.005, 1.0)
)"""


@query(f"WITH {_MATH} SELECT filing, type, severity, statement_type, concept, target::VARCHAR AS target, expected::VARCHAR AS expected FROM m")
def identity_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J01"""
    found = validate.check_math(_once(lines(spark, sf_dir)), ["filing"])
    return found.select("filing", "type", "severity", "statement_type", "concept", F.col("evidence")["target"].alias("target"), F.col("evidence")["expected"].alias("expected"))


def _once(rows: DataFrame) -> DataFrame:
    """The first line of each concept in a filing."""
    w = Window.partitionBy("filing", "concept").orderBy("position")
    return rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


@query(f"""WITH {LINES}, o AS (SELECT filing, statement_type, count(*) AS n, min(value) AS a, max(value) AS b, count(*) FILTER (abs(value) > 1e15) AS huge FROM s GROUP BY ALL)
SELECT filing, statement_type, 'all_values_identical' AS type, n::VARCHAR AS n FROM o WHERE n >= 3 AND a = b UNION ALL SELECT filing, statement_type, 'implausible_magnitude', huge::VARCHAR FROM o WHERE huge > 0
UNION ALL SELECT filing, statement_type, 'unexpected_negative_value', count(*)::VARCHAR FROM (SELECT * FROM s WHERE filing % 10 = 0 AND concept IN ('us-gaap:Revenues', 'us-gaap:CostOfRevenue')) GROUP BY ALL""")
def plausibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J04"""
    flipped = lines(spark, sf_dir).withColumn("value", F.when((F.col("filing") % 10 == 0) & F.col("concept").isin("us-gaap:Revenues", "us-gaap:CostOfRevenue"), -F.col("value")).otherwise(F.col("value")))
    return validate.check_plausibility(flipped, ["filing"]).select("filing", "statement_type", "type", F.col("evidence")["n"].alias("n"))


@query(f"""WITH {LINES} SELECT filing, statement_type, 'missing_mandatory_concept' AS type, count(*)::VARCHAR AS n FROM s GROUP BY ALL
HAVING NOT bool_or(CASE WHEN statement_type = 'income' THEN regexp_matches(lower(concept), 'revenue|operatingincome|netincome') ELSE regexp_matches(lower(concept), 'asset|liabilit|equity') END)""")
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J05"""
    return validate.check_coverage(lines(spark, sf_dir), ["filing"]).select("filing", "statement_type", "type", F.col("evidence")["n"].alias("n"))




@query(f"""WITH {LINES}, f AS (
  SELECT filing, statement_type, 'missing_hierarchy_path' AS type, 1 AS n FROM s WHERE order_key IS NULL
  UNION ALL SELECT filing, statement_type, 'negative_hierarchy_level', count(*) FROM s WHERE level < 0 GROUP BY ALL
  UNION ALL SELECT filing, statement_type, 'duplicate_path_order', count(DISTINCT concept) FROM s WHERE order_key IS NOT NULL GROUP BY filing, statement_type, path, order_key HAVING count(DISTINCT concept) > 1
  UNION ALL SELECT a.filing, a.statement_type, 'orphan_hierarchy_path', count(*) FROM s a WHERE contains(path, '.') AND NOT EXISTS (SELECT 1 FROM s b WHERE b.filing = a.filing AND b.path = split_part(a.path, '.', 1)) GROUP BY ALL
) SELECT filing, statement_type, type, count(*) AS findings, sum(n)::BIGINT AS rows FROM f GROUP BY ALL""")
def structure_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J02"""
    found = validate.check_structure(lines(spark, sf_dir), ["filing"]).filter("type <> 'duplicate_concept'")
    n = F.coalesce(F.col("evidence")["n"].cast("bigint"), F.lit(1))
    return found.groupBy("filing", "statement_type", "type").agg(F.count("*").alias("findings"), F.sum(n).alias("rows"))


@query(f"""WITH {LINES}, p AS (
  SELECT l_orderkey AS filing, CASE WHEN l_orderkey % 2 = 1 THEN 'balancesheet' ELSE 'income' END AS statement_type, count(*) AS n FROM lineitem WHERE l_linenumber * 70 < 30 OR l_linenumber * 70 > 400 GROUP BY ALL
), f AS (SELECT DISTINCT filing, statement_type FROM s)
SELECT filing, statement_type, 'unusual_period_duration' AS type FROM p UNION ALL SELECT filing, statement_type, 'missing_period_end' FROM f WHERE filing % 11 = 0 UNION ALL SELECT filing, statement_type, 'unparseable_period_end' FROM f WHERE filing % 11 = 1
UNION ALL SELECT filing, statement_type, 'missing_fiscal_year' FROM f WHERE filing % 7 = 0 UNION ALL SELECT filing, statement_type, 'period_type_form_mismatch' FROM f WHERE filing % 5 = 0""")
def period_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J03"""
    rows = lines(spark, sf_dir)
    f = F.col("filing")
    statements = rows.select("filing", "statement_type").distinct().select(
        "*", F.when(f % 11 == 1, "not a date").when(f % 11 != 0, "2024-01-01").alias("end_text"), F.when(f % 7 != 0, 2024).alias("fiscal_year"), F.when(f % 5 == 0, "quarterly").otherwise("annual").alias("period_type"), F.lit("10-K").alias("form")
    )
    return validate.check_periods(statements, rows, ["filing"]).select("filing", "statement_type", "type")


@query("""WITH n AS (SELECT l_orderkey, l_shipdate::DATE::VARCHAR AS period, l_returnflag, max_by(round(l_extendedprice * 100)::BIGINT, (l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS v FROM lineitem GROUP BY ALL)
SELECT a.l_orderkey AS filing, a.period, a.v AS income, b.v AS cashflow FROM n a JOIN n b USING (l_orderkey, period) WHERE a.l_returnflag = 'A' AND b.l_returnflag = 'N' AND abs(a.v - b.v) > 1""")
def cross_statement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F17, J07"""
    kind = F.when(F.col("l_returnflag") == "A", "income").when(F.col("l_returnflag") == "N", "cashflow").otherwise("other")
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("filing"), F.to_date("l_shipdate").cast("string").alias("period"), kind.alias("statement_type"), F.lit("us-gaap:NetIncomeLoss").alias("concept"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("position"), cents("l_extendedprice").alias("value"),
    )
    return validate.cross_statement(rows, ["filing"])


@query(f"""WITH {LINES.replace('s AS (', 's AS MATERIALIZED (', 1)}, a AS MATERIALIZED (SELECT filing, concept, max(value) AS value FROM s GROUP BY ALL), b AS MATERIALIZED (SELECT filing, concept, CASE WHEN filing % 5 = 1 THEN NULL WHEN filing % 5 = 2 THEN -value ELSE value END AS value FROM a WHERE filing % 5 <> 0)
SELECT a.filing, a.concept, CASE WHEN b.filing IS NULL THEN 'missing_concept' WHEN b.value IS NULL THEN 'missing_value' ELSE 'sign_mismatch' END AS type FROM a LEFT JOIN b USING (filing, concept) WHERE b.filing IS NULL OR b.value IS NULL OR sign(a.value) * sign(b.value) < 0""")
def presentation_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F16, J06"""
    shown = lines(spark, sf_dir).groupBy("filing", "concept").agg(F.max("value").alias("value"))
    k = F.col("filing") % 5
    bundle = shown.filter(k != 0).withColumn("value", F.when(k == 1, None).when(k == 2, -F.col("value")).otherwise(F.col("value")))
    return validate.presentation_diff(bundle, shown, ["filing"])


@query(f"""WITH {LINES}, a AS (SELECT filing, concept, max(value) AS value FROM s GROUP BY ALL)
SELECT filing, concept, value, 'p:' || concept AS parent, CASE WHEN filing % 5 <= 1 THEN 'presentation' ELSE 'bundle' END AS source FROM a UNION ALL SELECT filing, concept, NULL, 'p:' || concept, 'bundle' FROM a WHERE filing % 5 = 1""")
def presentation_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the bundles of presentation_diff, completed"""
    shown = lines(spark, sf_dir).groupBy("filing", "concept").agg(F.max("value").alias("value")).withColumn("parent", F.concat(F.lit("p:"), F.col("concept")))
    k = F.col("filing") % 5
    bundle = shown.filter(k != 0).withColumns({"value": F.when(k == 1, None).when(k == 2, -F.col("value")).otherwise(F.col("value")), "parent": F.when(k == 3, "")})
    return validate.recovered(bundle, shown, ["filing"])


@query(f"""WITH {LINES} SELECT filing, statement_type, count(*) AS n, count(*) >= 25 OR CASE statement_type
  WHEN 'income' THEN coalesce(bool_or(value IS NOT NULL AND regexp_matches(concept, 'Revenues|SalesRevenueNet|SalesRevenueGoodsNet|RevenueFromContractWithCustomer|GrossProfit|OperatingIncomeLoss|CostOfRevenue|CostOfGoodsAndServicesSold')), false)
  WHEN 'balancesheet' THEN coalesce(bool_or(value IS NOT NULL AND regexp_matches(concept, 'Assets|Liabilities|StockholdersEquity')), false)
  WHEN 'cashflow' THEN coalesce(bool_or(value IS NOT NULL AND regexp_matches(concept, 'NetCashProvidedByUsedIn(Operating|Investing|Financing)Activities')), false) ELSE true END AS valid FROM s GROUP BY filing, statement_type""")
def statement_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D24"""
    return validate.classification(lines(spark, sf_dir), ["filing"])


def _findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").filter("l_quantity >= 45")
    kind = F.when(F.col("l_quantity") >= 49, "math_mismatch").when(F.col("l_quantity") >= 47, "duplicate_concept").otherwise("missing_fiscal_year")
    severity = F.when(F.col("l_quantity") >= 47, "high").otherwise("low")
    return li.select(
        F.col("l_orderkey").alias("filing"), F.when(F.col("l_linenumber") <= 6, F.col("l_returnflag")).alias("statement_type"), kind.alias("type"), severity.alias("severity"),
        F.when(F.col("l_linenumber") % 2 == 0, F.col("l_linestatus")).alias("concept"),
    )


_FINDINGS = """
f AS (
  SELECT l_orderkey AS filing, CASE WHEN l_linenumber <= 6 THEN l_returnflag END AS statement_type, CASE WHEN l_quantity >= 49 THEN 'math_mismatch' WHEN l_quantity >= 47 THEN 'duplicate_concept' ELSE 'missing_fiscal_year' END AS type,
    CASE WHEN l_quantity >= 47 THEN 'high' ELSE 'low' END AS severity, CASE WHEN l_linenumber % 2 = 0 THEN l_linestatus END AS concept FROM lineitem WHERE l_quantity >= 45
), b AS (SELECT * FROM f WHERE severity = 'high' AND type = 'math_mismatch'), st AS (SELECT DISTINCT l_orderkey AS filing, l_returnflag AS statement_type FROM lineitem),
w AS (SELECT DISTINCT filing FROM b WHERE statement_type IS NULL), p AS (SELECT filing, statement_type, bool_or(concept IS NULL) AS blocked, string_agg(DISTINCT concept, ',' ORDER BY concept) AS drops FROM b WHERE statement_type IS NOT NULL GROUP BY ALL),
c AS (SELECT st.filing, st.statement_type, w.filing IS NULL AND NOT coalesce(blocked, false) AS permitted, coalesce(drops, '') AS drop_concepts FROM st LEFT JOIN p USING (filing, statement_type) LEFT JOIN w USING (filing))"""


def _statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("filing"), F.col("l_returnflag").alias("statement_type")).distinct()


@query(f"WITH {_FINDINGS} SELECT * FROM c")
def write_ceiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J09, J10"""
    out = decide.write_ceiling(_statements(spark, sf_dir), _findings(spark, sf_dir), ["filing"])
    return out.withColumn("drop_concepts", F.array_join("drop_concepts", ","))


_POLICY = _FINDINGS + """, n AS (SELECT filing, count(*) AS n FROM b GROUP BY ALL),
q AS (SELECT filing, string_agg(statement_type, ',' ORDER BY statement_type) AS alls, coalesce(string_agg(CASE WHEN permitted THEN statement_type END, ',' ORDER BY statement_type), '') AS permitted, coalesce(any_value(n.n), 0) AS n FROM c LEFT JOIN n USING (filing) GROUP BY filing)"""


@query(f"WITH {_POLICY} SELECT filing, CASE WHEN n = 0 THEN 'write' ELSE 'skip' END AS action, CASE WHEN n = 0 THEN alls ELSE '' END AS statements, permitted FROM q")
def policy_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J11"""
    findings = _findings(spark, sf_dir)
    out = decide.policy(decide.write_ceiling(_statements(spark, sf_dir), findings, ["filing"]), findings, ["filing"])
    return out.select("filing", "action", F.array_join("statements", ",").alias("statements"), F.array_join("permitted", ",").alias("permitted"))


@query(f"""WITH {_POLICY}, x AS (SELECT filing, CASE WHEN filing % 3 = 0 THEN 'skip' ELSE 'write' END AS act, permitted, array_to_string(list_sort(list_filter(string_split(permitted, ','), lambda t: t <> '' AND (filing % 3 <> 1 OR t IN ('A', 'N')))), ',') AS selected FROM q)
SELECT filing, CASE WHEN act = 'skip' OR selected = '' THEN 'skip' WHEN selected = permitted THEN 'write' ELSE 'write_partial' END AS action, CASE WHEN act = 'skip' THEN '' ELSE selected END AS statements FROM x""")
def plan_narrowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J12"""
    findings = _findings(spark, sf_dir)
    policy = decide.policy(decide.write_ceiling(_statements(spark, sf_dir), findings, ["filing"]), findings, ["filing"])
    k = F.col("filing") % 3
    plan = policy.select("filing", F.when(k == 0, "skip").otherwise("write").alias("plan_action"), F.when(k == 1, F.array(F.lit("N"), F.lit("A"), F.lit("X"))).alias("plan_statements"), F.lit(None).cast("array<string>").alias("extra_drops"))
    return decide.narrowed(policy, plan, ["filing"]).withColumn("statements", F.array_join("statements", ","))


@query(f"""WITH {_FINDINGS} SELECT filing, count(*) FILTER (severity = 'high') AS high, count(*) FILTER (severity = 'medium') AS medium, count(*) FILTER (severity = 'low') AS low,
  CASE WHEN bool_or(severity = 'high' AND type = 'math_mismatch') THEN 'fail' ELSE 'pass_with_findings' END AS status FROM f GROUP BY filing""")
def severity_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G11"""
    return validate.severity_counts(_findings(spark, sf_dir), ["filing"])


@query("""WITH p AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS place, round(l_extendedprice * 100)::BIGINT AS old, l_linenumber % 4 AS k FROM lineitem)
SELECT l_orderkey, place, CASE WHEN k = 1 THEN old + 5 WHEN k = 2 THEN old - 9 ELSE old END AS value, CASE WHEN k IN (1, 2) THEN old END AS corrected_from, CASE WHEN k IN (1, 2) THEN 'filing' END AS corrected_by FROM p""")
def corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions of the gate applied to the lines"""
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", place.cast("bigint").alias("place"), (F.col("l_linenumber") % 4).alias("k"), cents("l_extendedprice").alias("value"))
    v = F.col("value")
    new = F.when(F.col("k") == 1, v + 5).when(F.col("k") == 2, v - 9).otherwise(v)
    source = F.when(F.col("k") == 0, "rumour").otherwise("filing")
    gate = decide.approve(v, v, new, source, F.lit("checked"), F.lit("repair"))
    decisions = rows.select("l_orderkey", "place", gate["approved"].alias("approved"), new.alias("new"), source.alias("source"))
    return decide.corrected(rows.drop("k"), decisions, ["l_orderkey", "place"])


@query(f"""WITH {_MATH}, a AS (SELECT m.*, r.revenue - abs(r.cost) AS absolute FROM m JOIN r USING (filing)) SELECT filing, concept, target::DOUBLE AS old, (CASE WHEN abs(target - expected) <= abs(target - absolute) THEN expected ELSE absolute END)::DOUBLE AS new FROM a""")
def repair_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the identities that don't hold"""
    flipped = _once(lines(spark, sf_dir))
    return decide.proposals(validate.check_math(flipped, ["filing"]), ["filing"]).select("filing", "concept", "old", "new")


@query(f"""WITH {LINES}, o AS (SELECT *, row_number() OVER (PARTITION BY filing, concept ORDER BY position) AS n FROM s), x AS (SELECT * FROM o WHERE n = 1),
st AS (SELECT filing, any_value(statement_type) AS statement_type, count(DISTINCT statement_type) AS statements FROM x GROUP BY filing),
mm AS (SELECT filing, {_first('Revenues')} AS revenue, {_first('CostOfRevenue')} AS cost, {_first('GrossProfit')} AS gross FROM x WHERE statement_type = 'income' GROUP BY filing),
f AS (
  SELECT filing, 'high' AS severity, true AS blocking FROM mm WHERE revenue IS NOT NULL AND cost IS NOT NULL AND gross IS NOT NULL AND abs(gross - (revenue - cost)) > greatest(abs(gross) * 0.005, 1.0) AND abs(gross - (revenue - abs(cost))) > greatest(abs(gross) * 0.005, 1.0)
  UNION ALL SELECT filing, 'low', false FROM x GROUP BY filing, statement_type HAVING count(*) >= 3 AND min(value) = max(value)
  UNION ALL SELECT filing, 'medium', false FROM x WHERE order_key IS NULL
  UNION ALL SELECT filing, 'medium', false FROM x GROUP BY filing, statement_type HAVING count(*) FILTER (level < 0) > 0
  UNION ALL SELECT filing, 'medium', false FROM x WHERE order_key IS NOT NULL GROUP BY filing, statement_type, path, order_key HAVING count(DISTINCT concept) > 1
  UNION ALL SELECT a.filing, 'medium', false FROM x a WHERE contains(path, '.') AND NOT EXISTS (SELECT 1 FROM x b WHERE b.filing = a.filing AND b.path = split_part(a.path, '.', 1)) GROUP BY a.filing, a.statement_type
  UNION ALL SELECT filing, 'low', false FROM x WHERE days < 30 OR days > 400 GROUP BY filing, statement_type
  UNION ALL SELECT filing, 'low', false FROM st WHERE filing % 7 = 0
  UNION ALL SELECT filing, 'high', true FROM x WHERE filing % 2 = 0 GROUP BY filing, statement_type HAVING NOT bool_or(CASE WHEN statement_type = 'income' THEN regexp_matches(lower(concept), 'revenue|operatingincome|netincome') ELSE regexp_matches(lower(concept), 'asset|liabilit|equity') END)
), c AS (SELECT filing, count(*) FILTER (severity = 'high') AS high, count(*) FILTER (severity = 'medium') AS medium, count(*) FILTER (severity = 'low') AS low, count(*) FILTER (blocking) AS blocking FROM f GROUP BY filing)
SELECT st.filing, statements, CASE WHEN st.filing % 2 = 0 THEN 6 ELSE 4 END AS checks, coalesce(high, 0) AS high, coalesce(medium, 0) AS medium, coalesce(low, 0) AS low, coalesce(blocking, 0) AS blocking, CASE WHEN blocking > 0 THEN 'fail' WHEN high + medium + low > 0 THEN 'pass_with_findings' ELSE 'pass' END AS status FROM st LEFT JOIN c USING (filing)""")
def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every check over every filing; even ones have a presentation, the same as their lines"""
    rows = _once(lines(spark, sf_dir))
    f = F.col("filing")
    statements = rows.select("filing", "statement_type").distinct().select("*", F.lit("2024-01-01").alias("end_text"), F.when(f % 7 != 0, 2024).alias("fiscal_year"), F.lit("annual").alias("period_type"), F.lit("10-K").alias("form"))
    shown = rows.filter(f % 2 == 0).select("filing", "concept", "value")
    return validate.report(statements, rows, ["filing"], shown)[1].select("filing", "statements", F.col("checks").cast("int").alias("checks"), "high", "medium", "low", "blocking", "status")


@query("""WITH v AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round(l_extendedprice * 100)::BIGINT AS v, l_linenumber % 3 AS k, l_suppkey % 5 = 0 AS odd FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber::BIGINT AS l_linenumber, v AS original_value, CASE k WHEN 0 THEN -v WHEN 1 THEN v ELSE -v END AS value, CASE k WHEN 0 THEN -7 ELSE 7 END AS nested, odd AS period_warning, CASE WHEN l_linenumber % 2 = 0 THEN 'USD' ELSE 'shares' END AS unit FROM v""")
def line_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A payment, a receipt, and a sign that the HTML shows, each with a nested fact"""
    n = F.col("l_linenumber")
    k = n % 3
    concept = F.when(k == 0, "us-gaap:PaymentsToAcquireBusinesses").otherwise("us-gaap:ProceedsFromIssuanceOfDebt")
    none = F.lit(None)
    fact = F.struct(none.cast("string").alias("concept"), none.cast("string").alias("label"), F.lit(7).cast("bigint").alias("value"), F.when(k == 2, 1).alias("sign"))
    period = F.when(F.col("l_suppkey") % 5 == 0, "2024-12-31 to 2024-01-01").otherwise("2024-01-01 to 2024-03-31")
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", n.cast("bigint").alias("l_linenumber"), cents("l_extendedprice").alias("value"), concept.alias("concept"), F.lit("cash_flow").alias("statement_type"), none.cast("string").alias("label"),
        F.when(n % 2 == 0, "US$").otherwise("xbrli:shares").alias("unit"), none.cast("double").alias("weight"), none.cast("string").alias("role"), F.when(k == 2, -1).alias("html_sign"), period.alias("period"), F.array(fact).alias("facts"),
    )
    out = signs.transformed(items, F.to_date(F.lit("2024-06-30")))
    return out.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "original_value", F.col("value").cast("bigint").alias("value"), F.col("facts")[0]["value"].cast("int").alias("nested"), "period_warning", "unit")


_SIGNED = ("PaymentsToAcquireBusinesses", "ProceedsFromIssuanceOfDebt", "IncreaseDecreaseInAccountsReceivable", "IncreaseDecreaseInAccountsPayable", "ShareBasedCompensation", "NetCashProvidedByUsedInOperatingActivities", "OtherNoncashIncomeExpense")


@query(f"""WITH v AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * round(l_extendedprice * 100)::BIGINT AS v, {_names(_SIGNED)}[l_linenumber] AS c FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber::BIGINT AS l_linenumber, v AS raw, CASE l_linenumber WHEN 1 THEN -abs(v) WHEN 2 THEN v WHEN 3 THEN -v WHEN 4 THEN v WHEN 5 THEN abs(v) WHEN 6 THEN v ELSE -abs(v) END AS shown,
  CASE l_linenumber % 3 WHEN 0 THEN -abs(v) WHEN 1 THEN -v ELSE abs(v) END AS balance FROM v""")
def sign_convention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E26, E27, E28, E29"""
    li = table(spark, sf_dir, "lineitem")
    v = F.when(F.col("l_returnflag") == "R", -cents("l_extendedprice")).otherwise(cents("l_extendedprice"))
    n = F.col("l_linenumber")
    none, text = F.lit(None).cast("int"), F.lit(None).cast("string")
    concept = F.concat(F.lit("us-gaap:"), F.element_at(F.array(*map(F.lit, _SIGNED)), n))
    balance = F.when(n % 3 == 0, "us-gaap:AccumulatedDepreciation").when(n % 3 == 1, "us-gaap:OtherLiabilities").otherwise("us-gaap:AccountsReceivableNetCurrent")
    role = F.when(n % 3 == 1, "http://x/role/negatedLabel")
    rows = li.select("l_orderkey", "l_partkey", "l_suppkey", n.cast("bigint").alias("l_linenumber"), v.alias("raw"), concept.alias("cash"), balance.alias("sheet"), role.alias("role"))
    raw = F.col("raw")
    rows = signs.with_presented(rows, "shown", raw, F.col("cash"), F.lit("cash_flow"), text, none.cast("double"), text, none)
    rows = signs.with_presented(rows, "balance", raw, F.col("sheet"), F.lit("balance_sheet"), text, none.cast("double"), F.col("role"), none)
    return rows.drop("cash", "sheet", "role")
