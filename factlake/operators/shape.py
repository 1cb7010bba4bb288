"""From presentation roles, nested facts and entity facts to flat tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import periods as P
from ..functions import text as T

# --- fixed values -----------------------------------------------------------
#: Statement by words of the role's description, tried in this order.
ROLE_WORDS = (
    ("comprehensive_income", r"comprehensive\s+(income|loss)"),
    ("balancesheet", r"balance\s+sheet|financial\s+(position|condition)"),
    ("cashflow", r"cash\s+flow"),
    ("equity", r"(stockholders|shareholders|changes\s+in).{0,3}\s+(equity|deficit)"),
    ("income", r"(income|operations|earnings|profit)"),
)
#: Concepts that show a statement's kind, by taxonomy; they are looked for inside concept names.
CONCEPT_PATTERNS = {
    "us-gaap": {
        "balance_sheet": ("Assets", "Liabilities", "StockholdersEquity", "AssetsCurrent"),
        "income_statement": (
            "Revenues", "SalesRevenueNet", "SalesRevenueGoodsNet", "RevenueFromContractWithCustomerExcludingAssessedTax", "RevenueFromContractWithCustomerIncludingAssessedTax",
            "OperatingIncomeLoss", "GrossProfit", "CostOfGoodsAndServicesSold", "CostOfRevenue",
        ),
        "comprehensive_income": (
            "ComprehensiveIncomeNetOfTax", "OtherComprehensiveIncomeLossNetOfTax", "OtherComprehensiveIncomeLoss", "ComprehensiveIncome", "AccumulatedOtherComprehensiveIncomeLoss",
        ),
        "cash_flow": ("CashAndCashEquivalentsAtCarryingValue", "NetCashProvidedByUsedInOperatingActivities"),
        "equity_changes": ("StockholdersEquity", "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest", "RetainedEarningsAccumulatedDeficit"),
    },
    "ifrs-full": {
        "balance_sheet": ("Assets", "Liabilities", "Equity", "CurrentAssets"),
        "income_statement": ("Revenue", "ProfitLoss", "OperatingExpense", "GrossProfit"),
        "comprehensive_income": ("ComprehensiveIncome", "OtherComprehensiveIncome", "ComponentsOfOtherComprehensiveIncome"),
        "cash_flow": ("CashAndCashEquivalents", "CashFlowsFromUsedInOperatingActivities"),
        "equity_changes": ("Equity", "RetainedEarnings"),
    },
    "dei": {"balance_sheet": ("Assets", "Liabilities"), "income_statement": ("Revenue",), "cash_flow": ("CashAndCashEquivalents",), "equity_changes": ("Equity",)},
}
ROLE_SCORE, COMPREHENSIVE_WEIGHT, OTHER_WEIGHT = 100.0, 2.0, 0.5
BASE_PRIORITY, CONSOLIDATED, COMBINED, PARENTHETICAL = 50, -20, -10, 30
VALID_FISCAL_YEAR, NO_DIMENSIONS = 50, 10
MOST_PATTERNS = 10_000


def role_statement(description: Column) -> Column:
    low = F.lower(description)
    out = F.lit(None).cast("string")
    for name, words in reversed(ROLE_WORDS):
        out = F.when(low.rlike(words), F.lit(name)).otherwise(out)
    return out


def role_priority(description: Column) -> Column:
    low = F.lower(description)
    return (
        F.lit(BASE_PRIORITY)
        + F.when(low.contains("consolidated"), CONSOLIDATED).otherwise(0)
        + F.when(low.contains("combined"), COMBINED).otherwise(0)
        + F.when(low.contains("parenthetical"), PARENTHETICAL).otherwise(0)
    )


def classified_roles(roles: DataFrame, concepts: DataFrame, keys: DataFrame, filing: list[str]) -> DataFrame:
    """roles + statement, score, priority.

    The description decides; a role without a telling one goes to the statement
    with the most key concepts (weighted). ``concepts``: filing, role, concept;
    ``keys``: statement, pattern (matched as substrings, so they are broadcast; their number is checked).
    """
    if keys.count() > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} patterns")
    hits = concepts.join(F.broadcast(keys), F.lower("concept").contains(F.lower("pattern")))
    weight = F.when(F.col("statement") == "comprehensive_income", COMPREHENSIVE_WEIGHT).otherwise(OTHER_WEIGHT)
    counts = hits.groupBy(*filing, "role", "statement").agg((F.count_distinct("concept") * F.first(weight)).alias("s"))
    best = counts.groupBy(*filing, "role").agg(F.max(F.struct("s", "statement")).alias("b")).select(*filing, "role", F.col("b.statement").alias("by_count"), F.col("b.s").alias("count_score"))
    named = roles.withColumns({"by_text": role_statement(F.col("description")), "priority": role_priority(F.col("description"))})
    j = named.join(best, [*filing, "role"], "left")
    return j.select(
        *roles.columns, F.coalesce("by_text", "by_count").alias("statement"), F.when(F.col("by_text").isNotNull(), ROLE_SCORE).otherwise(F.col("count_score")).alias("score"), F.col("priority").cast("bigint").alias("priority")
    ).filter("statement is not null")


def one_role_per_statement(roles: DataFrame, filing: list[str]) -> DataFrame:
    """The role of the least priority, the first in the document of equals; a real role beats a synthesised one."""
    w = Window.partitionBy(*filing, "statement").orderBy(F.col("synthesised").cast("int"), "priority", "position")
    return roles.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def period_values(items: DataFrame, keys: list[str], periods: str = "periods") -> DataFrame:
    """keys, period_key, value: one row per period of an item's map; ranges are keyed by their end, text that isn't a number goes."""
    rows = items.select(*keys, F.explode(periods).alias("_p", "_v"))
    value = T.number_of(F.col("_v").cast("string"))
    return rows.select(*keys, P.plain_key(P.period_key(F.col("_p"))).alias("period_key"), value.alias("value")).filter("value is not null")


def outside_presentation(facts: DataFrame, presented: DataFrame, keys: list[str], plain: bool = False) -> DataFrame:
    """Facts whose concept is in no presentation tree: dimensional ones, and plain numeric ones if asked."""
    lost = facts.join(presented.select(*keys, "concept").distinct(), [*keys, "concept"], "left_anti")
    return lost if plain else lost.filter("n_dims > 0")


def dimension_sets(edges: DataFrame, filing: list[str]) -> DataFrame:
    """filing, arcrole, parent, members (sorted): the relationships of a dimensional model from its arcs."""
    return edges.groupBy(*filing, "arcrole", "parent").agg(F.array_sort(F.collect_set("child")).alias("members"))


def comparative_facts(facts: DataFrame, primary: DataFrame, keys: list[str]) -> DataFrame:
    """Other periods of a concept's primary fact: the first plain fact per period, and every dimensional one."""
    other = facts.join(primary.select(*keys, F.col("period").alias("_p")), keys).filter("period <> _p and value is not null").drop("_p")
    w = Window.partitionBy(*keys, "period").orderBy("position")
    plain = other.filter("n_dims = 0").withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
    return plain.unionByName(other.filter("n_dims > 0"))


def best_entity_value(candidates: DataFrame, keys: list[str]) -> DataFrame:
    """keys, value: by score - a valid fiscal year, no dimensions, recency."""
    year = F.col("value").try_cast("int")
    score = F.when(year.between(1990, 2100), VALID_FISCAL_YEAR).otherwise(-VALID_FISCAL_YEAR) + F.when(F.col("n_dims") == 0, NO_DIMENSIONS).otherwise(0) + F.unix_date("end") / 1e6
    return candidates.groupBy(*keys).agg(F.max(F.struct(score.alias("s"), F.col("value"))).alias("b")).select(*keys, F.col("b.value").alias("value"))


def company_rows(raw: DataFrame) -> DataFrame:
    """Nested company rows of flat ones: cik, name, industry, market_info, corporate_info."""
    return raw.select(
        T.ten_digit_cik(F.col("cik")).alias("cik"), F.trim("name").alias("name"), F.struct(F.col("sic")).alias("industry"),
        F.struct(F.col("tickers"), F.col("exchanges")).alias("market_info"), F.struct(F.col("fiscal_year_end")).alias("corporate_info"),
    )


def point_scan(rows: DataFrame, equal: dict, columns: list[str], order: list[Column], limit: int) -> DataFrame:
    """Rows that equal the given values, projected, ordered, the first ``limit``: filters reach the scan, the order is a top-k."""
    out = rows
    for c, v in equal.items():
        out = out.filter(F.col(c) == v)
    return out.select(*columns).orderBy(*order).limit(limit)


def filing_records(raw: DataFrame) -> DataFrame:
    """cik, accession, form, filing_date, accepted: filings of submissions, the acceptance time in either of its two formats."""
    accepted = F.coalesce(F.try_to_timestamp("acceptance", F.lit("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")), F.try_to_timestamp("acceptance", F.lit("yyyy-MM-dd'T'HH:mm:ss")))
    return raw.select(T.ten_digit_cik(F.col("cik")).alias("cik"), "accession", "form", F.col("filing_date").try_cast("date").alias("filing_date"), accepted.alias("accepted"))


def dimensional_model(edges: DataFrame, filing: list[str]) -> DataFrame:
    """filing, dimensions, domains, members, primary_items, hypercubes, defaults, typed: what the arcs (arcrole, parent, child) and dimensions (typed) of a taxonomy say, sorted arrays."""

    def of(role: str, end: str) -> Column:
        return F.array_sort(F.collect_set(F.when(F.col("arcrole") == role, F.col(end))))

    return edges.groupBy(*filing).agg(
        of("dimension-domain", "parent").alias("dimensions"), of("dimension-domain", "child").alias("domains"), of("domain-member", "child").alias("members"), of("all", "parent").alias("primary_items"),
        of("all", "child").alias("hypercubes"), F.array_sort(F.collect_set(F.when(F.col("arcrole") == "dimension-default", F.concat_ws("=", "parent", "child")))).alias("defaults"), F.array_sort(F.collect_set(F.when(F.col("typed"), F.col("parent")))).alias("typed"),
    )


def fiscal_years(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, fiscal_year, periods (sorted array), annual: the quarters of each fiscal year, and its last annual value."""
    q = F.array_sort(F.collect_set(F.when(~F.col("annual"), F.col("period"))))
    return rows.groupBy(*keys, "fiscal_year").agg(q.alias("periods"), F.max(F.when(F.col("annual"), F.struct("position", "value")))["value"].alias("annual"))


def company_summary(rows: DataFrame, keys: list[str], most: int = 10) -> DataFrame:
    """keys, accessions, last (the last ten by text), latest, years (sorted)."""
    acc = F.array_sort(F.collect_set("accession"))
    out = rows.groupBy(*keys).agg(acc.alias("_a"), F.max("end_date").alias("latest"), F.array_sort(F.collect_set("fiscal_year")).alias("years"))
    return out.select(*keys, F.size("_a").alias("accessions"), F.slice("_a", F.greatest(F.size("_a") - most + 1, F.lit(1)), F.lit(most)).alias("last"), "latest", "years")


def latest_label(annual: DataFrame, quarterly: DataFrame, keys: list[str]) -> DataFrame:
    """keys, end_date, label of the newest stored period of either table; on a tie the annual one."""
    a = annual.select(*keys, "end_date", "fiscal_year", F.lit(None).cast("bigint").alias("quarter"), F.lit(1).alias("_a"))
    q = quarterly.select(*keys, "end_date", "fiscal_year", "quarter", F.lit(0).alias("_a"))
    best = a.unionByName(q).groupBy(*keys).agg(F.max(F.struct("end_date", "_a", "fiscal_year", "quarter")).alias("b"))
    year = F.concat(F.lit("FY"), F.col("b.fiscal_year").cast("string"))
    label = F.when((F.col("b._a") == 0) & F.col("b.quarter").isNotNull(), F.concat(year, F.lit(" Q"), F.col("b.quarter").cast("string"))).otherwise(F.concat(year, F.lit(" Annual")))
    return best.select(*keys, F.col("b.end_date").alias("end_date"), label.alias("label"))


def processed(annual: DataFrame, quarterly: DataFrame, keys: list[str]) -> DataFrame:
    """The companies that either table has."""
    return annual.select(*keys).union(quarterly.select(*keys)).distinct()


def pattern_table(spark) -> DataFrame:
    """taxonomy, statement, pattern: a few dozen rows."""
    rows = [(t, st, p) for t, kinds in CONCEPT_PATTERNS.items() for st, patterns in kinds.items() for p in patterns]
    return spark.createDataFrame(rows, "taxonomy string, statement string, pattern string")


def key_concepts(concepts: DataFrame, taxonomies: DataFrame, keys: list[str]) -> DataFrame:
    """keys, statement, taxonomy, pattern, concept: a filing's concepts that the patterns of its taxonomies name."""
    named = concepts.select(*keys, "concept").distinct().join(F.broadcast(pattern_table(concepts.sparkSession)), F.col("concept").contains(F.col("pattern")))
    return named.join(taxonomies.select(*keys, "taxonomy").distinct(), [*keys, "taxonomy"], "left_semi").select(*keys, "statement", "taxonomy", "pattern", "concept")
