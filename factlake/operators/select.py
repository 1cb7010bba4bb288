"""Choosing facts: scores, period filters, context filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import periods as P
from ..functions import text as T

# --- fixed values -----------------------------------------------------------
EXCLUDED_MEMBERS = (
    "srt:ScenarioForecastMember", "us-gaap:ScenarioForecastMember", "srt:ScenarioUnspecifiedMember", "us-gaap:ScenarioUnspecifiedMember",
    "us-gaap:ChangeInAccountingEstimateByTypeMember", "us-gaap:ChangeInAccountingPrincipleMember", "us-gaap:ErrorCorrectionMember",
    "us-gaap:RestatementMember", "us-gaap:AdjustmentMember", "us-gaap:ProFormaMember", "us-gaap:ProFormaAdjustmentMember",
    "us-gaap:BudgetMember", "us-gaap:PlannedMember", "us-gaap:ProjectedMember", "srt:ReportableSegmentsMember", "srt:OperatingSegmentsMember",
    "srt:AllSegmentsMember", "srt:MaterialReconcilingItemsMember", "srt:EliminationsMember", "us-gaap:IntersegmentEliminationMember",
    "us-gaap:IntersubsegmentEliminationsMember", "us-gaap:ForeignExchangeContractMember", "ForeignExchangeContractMember",
    "us-gaap:InterestRateContractMember", "InterestRateContractMember", "us-gaap:ReclassificationOutOfAccumulatedOtherComprehensiveIncomeMember",
    "ReclassificationOutOfAccumulatedOtherComprehensiveIncomeMember", "us-gaap:RetainedEarningsMember", "RetainedEarningsMember",
    "us-gaap:CommonStockMember", "CommonStockMember", "us-gaap:AdditionalPaidInCapitalMember", "AdditionalPaidInCapitalMember",
    "us-gaap:TreasuryStockCommonMember", "TreasuryStockCommonMember", "us-gaap:TreasuryStockPreferredMember", "TreasuryStockPreferredMember",
    "us-gaap:AccumulatedOtherComprehensiveIncomeMember", "AccumulatedOtherComprehensiveIncomeMember",
)
EXCLUDED_AXES = (
    "srt:StatementScenarioAxis", "us-gaap:ChangeInAccountingEstimateByTypeAxis", "us-gaap:ChangeInAccountingPrincipleAxis",
    "us-gaap:ErrorCorrectionAxis", "us-gaap:RestatementAxis", "us-gaap:StatementEquityComponentsAxis",
)
EXCLUDED_WORDS = (
    "forecast", "scenario", "estimate", "adjustment", "restatement", "error", "correction", "proforma", "forma", "budget",
    "planned", "projected", "unspecified", "change", "useful", "reportable",
)
NON_FINANCIAL_SPACES = ("dei", "srt", "country", "invest")
ALWAYS_STRUCTURAL = (
    "IncomeStatementAbstract", "StatementOfFinancialPositionAbstract", "StatementOfCashFlowsAbstract", "StatementOfIncomeAndComprehensiveIncomeAbstract",
    "StatementOfStockholdersEquityAbstract", "StatementTable", "StatementLineItems", "ComprehensiveIncomeNetOfTaxAbstract",
    "WeightedAverageNumberOfSharesOutstandingAbstract",
)
INSTANT_SCORE, QUARTER_SCORE, CASH_SCORE, ANNUAL_SCORE, OTHER_SCORE = 1000, 1200, 2000, 1200, 400
PLAIN_SCORE, MEMBER_SCORE, FORBIDDEN_SCORE, VALUE_SCORE = 500, 200, -10000, 100


def _in(value: Column, names: tuple[str, ...]) -> Column:
    return F.coalesce(value.isin(*names), F.lit(False))


def has_excluded_word(name: Column) -> Column:
    """Whether a whole word of a name or label (camel case and separators part words) marks an unwanted context."""
    return F.coalesce(F.arrays_overlap(T.camel_tokens(name), F.array(*map(F.lit, EXCLUDED_WORDS))), F.lit(False))


def excluded_fact(dimensions: Column, details: Column | None = None) -> Column:
    """Whether a dimensional fact is a forecast, a restatement, a total of segments or an equity column.

    ``dimensions``: map axis -> member. ``details``: map of structs with
    axis_qname, member_qname and member_label; words are looked for in labels only.
    """
    out = F.exists(F.map_values(dimensions), lambda m: _in(m, EXCLUDED_MEMBERS)) | F.exists(F.map_keys(dimensions), lambda a: _in(a, EXCLUDED_AXES))
    out = F.coalesce(out, F.lit(False))
    if details is not None:
        one = F.exists(F.map_values(details), lambda d: _in(d["axis_qname"], EXCLUDED_AXES) | _in(d["member_qname"], EXCLUDED_MEMBERS) | has_excluded_word(d["member_label"]))
        out = out | F.coalesce(one, F.lit(False))
    return out


def excluded_item(dimensions: Column) -> Column:
    """The same for an item's own dimensions, an array of structs (axis, member); words count in members and axes."""
    one = F.exists(dimensions, lambda d: _in(d["member"], EXCLUDED_MEMBERS) | _in(d["axis"], EXCLUDED_AXES) | has_excluded_word(d["member"]) | has_excluded_word(d["axis"]))
    return F.coalesce(one, F.lit(False))


def without_excluded(items: DataFrame, dimensions: str = "dimensions", facts: str = "facts") -> DataFrame:
    """Items of wanted contexts, with the wanted of their nested facts (structs with dimensions and details)."""
    kept = F.filter(F.col(facts), lambda f: ~excluded_fact(f["dimensions"], f["details"]))
    return items.filter(~excluded_item(F.col(dimensions))).withColumn(facts, kept)


def without_prior(items: DataFrame, year: int, period: str = "period", facts: str = "facts") -> DataFrame:
    """Items whose period ends in ``year`` or later, with their nested facts that do; periods that can't be read stay."""

    def current(text: Column) -> Column:
        return F.coalesce(F.year(P.period_end(text)) >= year, F.lit(True))

    return items.filter(current(F.col(period))).withColumn(facts, F.filter(F.col(facts), lambda f: current(f["period"])))


def primary_score(form: Column, statement: Column, start: Column, end: Column, fiscal_year_ok: Column, n_dims: Column, forbidden: Column, has_value: Column) -> Column:
    """Score of a fact as its concept's primary fact; NULL if it can't be one."""
    months = P.months_between_days(start, end)
    quarterly = form == "10-Q"
    cash = statement == "cashflow"
    whole = F.least(*[F.abs(months - m) for m in (3, 6, 9, 12)]) <= 1
    length = (
        F.when(start.isNull(), F.lit(INSTANT_SCORE))
        .when(quarterly & cash, F.when(whole, F.lit(CASH_SCORE)))
        .when(quarterly, F.when(P.is_quarterly_length(months), F.lit(QUARTER_SCORE)))
        .when(P.is_annual_length(months), F.lit(ANNUAL_SCORE))
        .otherwise(F.lit(OTHER_SCORE))
    )
    context = F.when(n_dims == 0, F.lit(PLAIN_SCORE)).otherwise(F.lit(MEMBER_SCORE)) + F.when(forbidden, F.lit(FORBIDDEN_SCORE)).otherwise(F.lit(0))
    total = length + F.unix_date(end) + context + F.when(has_value, F.lit(VALUE_SCORE)).otherwise(F.lit(0))
    return F.when(~quarterly | fiscal_year_ok, total)


def primary_facts(facts: DataFrame, keys: list[str], score: Column, fallback: list[Column], position: Column) -> DataFrame:
    """One fact per key: the best score, the first of equals; without a scored fact the first by ``fallback``."""
    order = Window.partitionBy(*keys).orderBy(F.col("_score").desc_nulls_last(), *[F.when(F.col("_score").isNull(), c) for c in fallback], position)
    return facts.withColumn("_score", score).withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n").withColumnRenamed("_score", "score")


def at_latest(facts: DataFrame, keys: list[str], instant: str) -> DataFrame:
    """Rows of each key's latest instant."""
    return facts.withColumn("_m", F.max(instant).over(Window.partitionBy(*keys))).filter(F.col(instant) == F.col("_m")).drop("_m")


def latest_period_group(facts: DataFrame, keys: list[str], start: str, end: str, form: Column) -> DataFrame:
    """Facts of a length that the form calls for, of the most recent end and length of each key; all facts where none fits."""
    months = P.months_between_days(F.col(start), F.col(end))
    annual = form.isin(*P.ANNUAL_FORMS)
    strict = F.when(annual, months.between(11, 13)).otherwise(months.between(2.5, 4.0))
    lenient = F.when(annual, months.between(10.5, 13.5)).otherwise(months.between(2.3, 4.2))
    tier = F.when(strict, 0).when(lenient, 1).otherwise(2)
    w = Window.partitionBy(*keys)
    best = F.min("_tier").over(w)
    rows = facts.withColumn("_tier", tier).withColumn("_best", best).filter("_tier = _best")
    rank = F.dense_rank().over(Window.partitionBy(*keys).orderBy(F.col(end).desc(), F.datediff(end, start)))
    return rows.withColumn("_r", rank).filter("_best = 2 or _r = 1").drop("_tier", "_best", "_r")


def future_period(period: Column, filing_year: Column) -> Column:
    """Whether a 20xx year in the period's text lies more than a year after the filing's."""
    years = F.regexp_extract_all(period, F.lit(r"\b(20\d{2})\b"), F.lit(1))
    return F.coalesce(F.array_max(F.transform(years, lambda y: y.cast("int"))) > filing_year + 1, F.lit(False))


def near_target(end: Column, target: Column, days: int = 2) -> Column:
    """Within ``days`` of the target; an end that can't be read is kept."""
    return F.coalesce(F.abs(F.datediff(end, target)) <= days, F.lit(True))


def clean_facts(facts: DataFrame, value: str, dimensions: str) -> DataFrame:
    """Without NULL and zero values and without empty dimensions."""
    return facts.filter(F.col(value).isNotNull() & (F.col(value) != 0) & (F.size(dimensions) > 0))


def _always_structural(concept: Column) -> Column:
    out = F.element_at(F.split(concept, ":"), 1).isin(*NON_FINANCIAL_SPACES) & concept.contains(":")
    out = out | concept.endswith("Axis")
    for name in ALWAYS_STRUCTURAL:
        out = out | concept.contains(name)
    return out


def structural_concept(concept: Column, abstract: Column) -> Column:
    """Namespace noise, axes, listed wrappers, and abstract headings and domains."""
    local = T.local_name(concept)
    return _always_structural(concept) | (abstract & (local.endswith("Abstract") | local.endswith("Domain")))


def irrelevant_concept(concept: Column, abstract: Column, has_facts: Column) -> Column:
    """As ``structural_concept``, and abstract members without dimensional facts."""
    return structural_concept(concept, abstract) | (abstract & T.local_name(concept).endswith("Member") & ~has_facts)


def capturable(numeric: Column, abstract: Column, namespace: Column, nil: Column) -> Column:
    """Numeric, neither abstract nor nil, and no cover-page metadata."""
    return F.coalesce(numeric, F.lit(False)) & ~F.coalesce(abstract, F.lit(False)) & ~F.lower(F.coalesce(namespace, F.lit(""))).contains("dei") & ~F.coalesce(nil, F.lit(False))


def of_period_length(rows: DataFrame, target: Column, months: int, start: str = "period_start", end: str = "period_end") -> DataFrame:
    """Rows of the target's end (a date inside a label) and length; without a target all.

    A row without both dates stays only where the target isn't a quarter.
    """
    goal = P.label_date(target)
    s, e = P.lenient_date(F.col(start)), P.lenient_date(F.col(end))
    length = P.months_between_days(s, e)
    tolerance = P.QUARTER_TOLERANCE if months != 12 else P.ANNUAL_TOLERANCE
    match = (F.abs(F.datediff(e, goal)) <= P.DATE_TOLERANCE_DAYS) & (F.abs(length - months) <= tolerance)
    return rows.filter(goal.isNull() | F.when(s.isNotNull() & e.isNotNull(), match).otherwise(F.lit(months != 3)))


def primary_column(values: DataFrame, keys: list[str], form: str, heading: str = "heading", position: str = "position", value: str = "value") -> DataFrame:
    """keys, heading: the best column of a wide statement, given long (keys, form, heading, position from 0, value).

    Earlier columns score a little, headings by the form, data in a column a
    little; of equal scores the first column wins.
    """
    per = values.groupBy(*keys, form, heading, position).agg((F.count(value) > 0).alias("_any"), F.coalesce(F.bool_or(F.col(value) != 0), F.lit(False)).alias("_some"))
    base = F.count("*").over(Window.partitionBy(*keys, form)) - F.col(position)
    h, f = F.col(heading), F.col(form)
    quarterly, cumulative, annual = P.is_quarterly_heading(h), P.is_cumulative_heading(h), P.is_annual_heading(h)
    score = (
        F.when((f == "10-Q") & quarterly, base + 1000)
        .when((f == "10-Q") & cumulative, F.lit(-10000))
        .when(f == "10-Q", base - 5000)
        .when(f.isin(*P.ANNUAL_FORMS) & annual, base + 100)
        .when(f.isin(*P.ANNUAL_FORMS) & quarterly, base - 50)
        .otherwise(base)
    )
    score = score + F.when(F.col("_any"), 10).otherwise(0) + F.when(F.col("_some"), 5).otherwise(0)
    best = F.max(F.struct(F.col("_score"), (-F.col(position)).alias("_p"), h.alias("_h")))
    return per.withColumn("_score", score).groupBy(*keys).agg(best.alias("_b")).select(*keys, F.col("_b._h").alias(heading), F.col("_b._score").alias("score"))


def duration_facts(facts: DataFrame, keys: list[str], position: str = "position") -> DataFrame:
    """Facts (keys, period, form, fiscal_year, quarter, code, convention) of the length that the form calls for.

    A 10-Q with a known fiscal quarter: that quarter and no comparative one,
    with a week's tolerance at both ends. Otherwise by end date: those of the
    right length, or for an annual form the nearest one. Ranges that can't be
    read stay but for a 10-Q.
    """
    s, e = P.period_start(F.col("period")), P.period_end(F.col("period"))
    months = P.months_between_days(s, e)
    form, fy, q, code, conv = (F.col(c) for c in ("form", "fiscal_year", "quarter", "code", "convention"))
    first, last = P.quarter_start(fy, q, code, conv), P.quarter_end(fy, q, code, conv)
    fiscal = (form == "10-Q") & fy.isNotNull() & q.isNotNull() & code.isNotNull() & last.isNotNull()
    near = (F.abs(F.datediff(e, last)) <= P.DATE_TOLERANCE_DAYS) & (F.abs(F.datediff(s, first)) <= P.DATE_TOLERANCE_DAYS)
    own = (P.fiscal_year_of(e, code, conv) == fy) & near & P.is_quarterly_length(months)
    annual = form.isin(*P.ANNUAL_FORMS)
    right = F.when(annual, P.is_annual_length(months)).otherwise(P.is_quarterly_length(months))
    rows = facts.withColumns({"_s": s, "_e": e, "_m": months, "_fiscal": F.coalesce(fiscal, F.lit(False)), "_own": F.coalesce(own, F.lit(False)), "_right": F.coalesce(right, F.lit(False)), "_annual": F.coalesce(annual, F.lit(False))})
    end = Window.partitionBy(*keys, "_e")
    nearest = F.row_number().over(end.orderBy(F.abs(F.col("_m") - 12.0), position))
    rows = rows.withColumns({"_hit": F.max("_right").over(end), "_n": nearest})
    keep = (
        F.when(F.col("_s").isNull() | F.col("_e").isNull(), ~F.coalesce(form == "10-Q", F.lit(False)))
        .when(F.col("_fiscal"), F.col("_own"))
        .when(F.col("_right"), F.lit(True))
        .otherwise(F.col("_annual") & ~F.col("_hit") & (F.col("_n") == 1))
    )
    return rows.filter(keep).select(*facts.columns)


def current_dimensional(facts: DataFrame, keys: list[str], position: str = "position") -> DataFrame:
    """Dimensional facts of an item's current period (columns of ``duration_facts``, concept, dimensions, details).

    Facts without dimensions go. An annual form keeps instants and ranges of a
    year or a quarter. Any other known form keeps ranges of ``duration_facts``
    and the latest instant, each concept, slice and period once, and only wanted
    contexts. Without a form all facts with dimensions stay.
    """
    dims, details, period = F.col("dimensions"), F.col("details"), F.col("period")
    facts = facts.filter((F.coalesce(F.size(dims), F.lit(0)) > 0) | (F.coalesce(F.size(details), F.lit(0)) > 0))
    months = P.months_between_days(P.period_start(period), P.period_end(period))
    annual = F.coalesce(F.col("form").isin(*P.ANNUAL_FORMS), F.lit(False))
    ranged = F.coalesce(period.contains(" to "), F.lit(False))
    yearly = facts.filter(annual & (~ranged | F.coalesce(months.between(11.0, 13.0) | months.between(2.5, 4.0), F.lit(True))))
    formless = facts.filter(F.col("form").isNull())
    other = facts.filter(~annual & F.col("form").isNotNull() & (F.coalesce(period, F.lit("")) != ""))
    ranges = duration_facts(other.filter(ranged), keys, position).withColumn("_kind", F.lit(0))
    latest = F.first(period).over(Window.partitionBy(*keys).orderBy(P.period_end(period).desc_nulls_last(), position))
    some = F.max(P.period_end(period).isNotNull()).over(Window.partitionBy(*keys))
    instants = other.filter(~ranged).withColumns({"_l": latest, "_some": some}).filter(~F.col("_some") | (period == F.col("_l"))).drop("_l", "_some").withColumn("_kind", F.lit(1))
    slice_of = F.to_json(F.array_sort(F.map_entries(dims)))
    once = F.row_number().over(Window.partitionBy(*keys, "concept", slice_of, "period").orderBy("_kind", position))
    others = ranges.unionByName(instants).withColumn("_n", once).filter("_n = 1").filter(~excluded_fact(dims, details)).drop("_n", "_kind")
    return yearly.unionByName(formless).unionByName(others)


def statements_with_data(items: DataFrame, keys: list[str]) -> DataFrame:
    """keys, has_data: whether an item that isn't abstract, or a nested fact of any item, has a value."""
    own = ~F.coalesce(F.col("abstract"), F.lit(False)) & F.col("value").isNotNull()
    nested = F.coalesce(F.exists("facts", lambda f: f["value"].isNotNull()), F.lit(False))
    return items.groupBy(*keys).agg((F.bool_or(own) | F.bool_or(nested)).alias("has_data"))


def newer_filings(filings: DataFrame, stored: DataFrame, keys: list[str], report: str = "report_date", filed: str = "filing_date") -> DataFrame:
    """Filings whose reporting period (or else filing date) is after the latest stored end date of their company; all of a company without one."""
    mark = stored.groupBy(*keys).agg(F.max("end_date").alias("_mark"))
    day = F.coalesce(P.lenient_date(F.col(report)), P.lenient_date(F.col(filed)))
    return filings.join(mark, keys, "left").filter(F.col("_mark").isNull() | (day > F.col("_mark"))).drop("_mark")


def latest_filing(filings: DataFrame, keys: list[str], filed: str = "filing_date") -> DataFrame:
    """The most recently filed financial form of each company."""
    order = Window.partitionBy(*keys).orderBy(F.col(filed).desc_nulls_last(), "accession")
    return filings.filter(F.col("form").isin(*P.FINANCIAL_FORMS)).withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def convention_of_facts(facts: DataFrame) -> DataFrame:
    """cik, convention: 'end' or 'start' from company facts (cik, concept, unit, position, form, fp, fy, end).

    The first listed concept with annual facts decides: its last one that ends
    in January or February and is labelled with that year or the year before.
    Facts in USD count, else those in the concept's first unit.
    """
    rank = F.array_position(F.array(*map(F.lit, P.CONVENTION_CONCEPTS)), F.col("concept")).cast("int")
    rows = facts.withColumn("_rank", rank).filter("_rank > 0")
    w = Window.partitionBy("cik", "concept")
    unit = F.when(F.max(F.col("unit") == "USD").over(w), F.lit("USD")).otherwise(F.min(F.struct("position", "unit")).over(w)["unit"])
    rows = rows.withColumn("_u", unit).filter("unit = _u and fp = 'FY'").filter(F.col("form").isin(*P.ANNUAL_FORMS))
    end = P.lenient_date(F.col("end"))
    named = F.when(F.month(end).isin(1, 2), F.when(F.col("fy") == F.year(end), "end").when(F.col("fy") == F.year(end) - 1, "start"))
    per = rows.filter(F.coalesce(F.col("end"), F.lit("")) != "").groupBy("cik", "_rank").agg(F.max(F.when(named.isNotNull(), F.struct("position", named.alias("c")))).alias("_c"))
    return per.groupBy("cik").agg(F.min(F.struct("_rank", "_c")).alias("_f")).select("cik", F.col("_f._c.c").alias("convention"))


def filings_of_period(filings: DataFrame, fiscal_year: int, quarter: int | None) -> DataFrame:
    """A fiscal year or its fourth quarter means annual forms, other quarters the 10-Q of that quarter."""
    annual = F.col("form").isin(*P.ANNUAL_FORMS)
    wanted = annual if quarter in (None, 4) else (F.col("form") == "10-Q") & (F.col("quarter") == quarter)
    return filings.filter((F.col("fiscal_year") == fiscal_year) & wanted)
