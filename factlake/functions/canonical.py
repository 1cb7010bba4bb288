"""Concept classes, statement names and segment types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# --- fixed values -----------------------------------------------------------
#: Concepts that mean one line item; the first is the canonical name.
EQUIVALENCE_CLASSES = (
    ("us-gaap:NetCashProvidedByUsedInOperatingActivities", "us-gaap:NetCashProvidedByUsedInOperatingActivitiesContinuingOperations"),
    ("us-gaap:NetCashProvidedByUsedInInvestingActivities", "us-gaap:NetCashProvidedByUsedInInvestingActivitiesContinuingOperations"),
    ("us-gaap:NetCashProvidedByUsedInFinancingActivities", "us-gaap:NetCashProvidedByUsedInFinancingActivitiesContinuingOperations"),
    ("us-gaap:RevenueFromContractWithCustomerExcludingAssessedTax", "us-gaap:Revenues", "us-gaap:SalesRevenueNet", "us-gaap:SalesRevenueGoodsNet", "us-gaap:SalesRevenueServicesNet", "us-gaap:RevenueFromContractWithCustomerIncludingAssessedTax"),
    ("us-gaap:CostOfRevenue", "us-gaap:CostOfGoodsAndServicesSold", "us-gaap:CostOfGoodsSold", "us-gaap:CostOfServices"),
    ("us-gaap:CashCashEquivalentsRestrictedCashAndRestrictedCashEquivalentsPeriodIncreaseDecreaseIncludingExchangeRateEffect", "us-gaap:CashAndCashEquivalentsPeriodIncreaseDecrease", "us-gaap:CashCashEquivalentsRestrictedCashAndRestrictedCashEquivalentsPeriodIncreaseDecreaseExcludingExchangeRateEffect", "us-gaap:CashAndCashEquivalentsPeriodIncreaseDecreaseExcludingExchangeRateEffect"),
    ("us-gaap:CashCashEquivalentsRestrictedCashAndRestrictedCashEquivalents", "us-gaap:CashAndCashEquivalentsAtCarryingValue"),
    ("us-gaap:EffectOfExchangeRateOnCashCashEquivalentsRestrictedCashAndRestrictedCashEquivalents", "us-gaap:EffectOfExchangeRateOnCashAndCashEquivalents", "us-gaap:EffectOfExchangeRateOnCashCashEquivalentsRestrictedCashAndRestrictedCashEquivalentsContinuingOperations"),
    ("us-gaap:IncomeLossFromContinuingOperationsBeforeIncomeTaxesMinorityInterestAndIncomeLossFromEquityMethodInvestments", "us-gaap:IncomeLossFromContinuingOperationsBeforeIncomeTaxesExtraordinaryItemsNoncontrollingInterest"),
    ("us-gaap:LongTermDebtNoncurrent", "us-gaap:LongTermDebt"),
    ("us-gaap:RepaymentsOfLongTermDebt", "us-gaap:RepaymentsOfDebt"),
    ("us-gaap:PaymentsOfDividendsCommonStock", "us-gaap:PaymentsOfDividends"),
    ("us-gaap:IncomeTaxesPaidNet", "us-gaap:IncomeTaxesPaid"),
    ("us-gaap:InterestPaidNet", "us-gaap:InterestPaid"),
)
STATEMENT_NAMES = {
    "income": ("income", "income_statement", "incomestatement", "operations"),
    "balancesheet": ("balancesheet", "balance_sheet", "balance", "financialposition"),
    "cashflow": ("cashflow", "cash_flow", "cashflows", "cash_flows"),
}
#: Members that stand for the sum of all segments or for what is eliminated between them, by the end of their lower-case names.
AGGREGATE_MEMBERS = (
    "reportablesegmentmember", "reportablesegmentsmember", "allsegmentsmember", "operatingsegmentsmember", "materialsreconcilingitemsmember",
    "materialreconcilingitemsmember", "eliminationsmember", "intersegmenteliminationmember", "intersubsegmenteliminationsmember",
)
#: Segment type by a part of the axis's lower-case name, in order of priority, but for products, schedules and typed dates.
AXIS_TYPES = (
    (("statementgeographical", "geographic"), "geographic_segment"), (("statementbusinesssegments",), "business_segment"),
    (("statementequitycomponents", "reclassificationoutofaccumulated"), "equity_component"), (("derivativeinstrumentrisk",), "derivative_risk"),
    (("natureofexpense",), "expense_nature"),
)
DROPPED_AXIS_PARTS = ("statementof", "scheduleof", "us_gaap_", "usgaap")
#: Grouping header by parts of a segment type's name, in order of priority.
HEADERS = (
    (("prod", "serv"), "custom:ProductSegmentation"), (("geo", "country", "region"), "custom:GeographicSegmentation"),
    (("seg", "bus", "oper", "consolidat"), "custom:BusinessSegments"), (("awardtype", "award_type"), "custom:AwardTypeSegmentation"),
    (("incomestatementlocation",), "custom:IncomeStatementLocationSegmentation"), (("investment", "cash_securities"), "custom:InvestmentSegmentation"),
    (("fair_value", "fairvalue"), "custom:FairValueSegmentation"), (("derivative",), "custom:DerivativeSegmentation"),
)


def class_table(spark) -> DataFrame:
    """tag, canonical, rank: one row per tag of a class (a few dozen rows)."""
    rows = [(t, c[0], k) for c in EQUIVALENCE_CLASSES for k, t in enumerate(c)]
    return spark.createDataFrame(rows, "tag string, canonical string, rank int")


def with_canonical(rows: DataFrame, concept: str = "concept") -> DataFrame:
    """Adds ``canonical``: the class's first name; an unknown concept is its own."""
    classes = class_table(rows.sparkSession).drop("rank")
    return rows.join(F.broadcast(classes), rows[concept] == classes["tag"], "left").withColumn("canonical", F.coalesce("canonical", concept)).drop("tag")


def statement_name(raw: Column) -> Column:
    low = F.lower(F.regexp_replace(F.trim(raw), "[ -]", "_"))
    out = F.lit(None).cast("string")
    for name, names in STATEMENT_NAMES.items():
        out = F.when(low.isin(*names), F.lit(name)).otherwise(out)
    return F.coalesce(out, low)


def _has(text: Column, parts: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | text.contains(p)
    return out


def _no_axis(axis: Column) -> Column:
    return F.lower(F.replace(axis, F.lit("Axis"), F.lit("")))


def segment_info(dimensions: Column, qualified: Column) -> Column:
    """struct(segment_type, concept): what a dimensional fact breaks down by, and its member.

    ``dimensions``: map axis -> member; ``qualified``: map axis -> member's full
    name, which is preferred. The first axis of the best priority counts. Facts
    of nothing but totals and eliminations, and facts without dimensions, are
    (unknown, unknown).
    """
    entries = F.filter(F.map_entries(dimensions), lambda e: e["key"] != "explicitMember")
    totals = F.forall(entries, lambda e: _has_end(F.lower(e["value"]), AGGREGATE_MEMBERS))
    low = lambda e: F.lower(e["key"])

    def schedule(e: Column) -> Column:
        return (low(e).contains("scheduleof") & _has(low(e), ("cash", "securities"))) | _has(low(e), ("investmenttype", "fairvaluebyfairvaluehierarchylevel"))

    def named(e: Column) -> Column:
        return F.coalesce(F.try_element_at(qualified, e["key"]), e["value"])

    def typed(kind: Column, e: Column, concept: Column | None = None) -> Column:
        return F.struct(kind.alias("segment_type"), (named(e) if concept is None else concept).alias("concept"))

    def holds(parts: tuple[str, ...]):
        return lambda x: _has(low(x), parts)

    def first(cond) -> Column:
        return F.get(F.filter(entries, cond), F.lit(0))

    e = first(lambda x: _has(low(x), ("product", "service")))
    out = F.when(e.isNotNull(), typed(F.lit("product_service"), e))
    e = first(schedule)
    kind = F.when(low(e).contains("investmenttype"), "investment_type").when(low(e).contains("fairvalue"), "fair_value_level").otherwise("cash_securities_schedule")
    out = out.when(e.isNotNull(), typed(kind, e))
    for parts, name in AXIS_TYPES:
        e = first(holds(parts))
        kind = F.when(low(e).contains(parts[0]), name).otherwise("comprehensive_income") if name == "equity_component" else F.lit(name)
        out = out.when(e.isNotNull(), typed(kind, e))
    e = first(lambda x: x["value"].rlike(r"^\d{4}-\d{2}-\d{2}$"))
    owed, axis = low(e).contains("performanceobligation"), _no_axis(e["key"])
    kind = F.when(owed, "performance_obligation").when(axis != "", F.concat(F.lit("typed_date_"), axis)).otherwise("typed_date")
    concept = F.when(owed, F.concat(F.lit("us-gaap:RevenueRemainingPerformanceObligation_"), e["value"])).when(axis != "", F.concat_ws("_", axis, e["value"])).otherwise(e["value"])
    out = out.when(e.isNotNull(), typed(kind, e, concept))
    e = first(lambda x: low(x).contains("consolidationitems"))
    out = out.when(e.isNotNull(), typed(F.lit("consolidation"), e))
    # No known axis: the first by a fixed order, with a type made from its name.
    order = lambda x: F.struct(~_has(low(x), ("product", "service")), ~_has(low(x), ("cash", "securit", "investment")), ~low(x).contains("geograph"), ~low(x).contains("segment"), low(x), x.alias("e"))
    e = F.array_min(F.transform(entries, order))["e"]
    axis = _no_axis(e["key"])
    for part in DROPPED_AXIS_PARTS:
        axis = F.replace(axis, F.lit(part), F.lit(""))
    out = out.when(e.isNotNull(), typed(F.when(axis == "", "dimensional").otherwise(axis), e))
    unknown = F.struct(F.lit("unknown").alias("segment_type"), F.lit("unknown").alias("concept"))
    return F.when(F.coalesce(F.size(entries), F.lit(0)) <= 0, unknown).when(totals, unknown).otherwise(out)


def _has_end(text: Column, ends: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for x in ends:
        out = out | text.endswith(x)
    return out


def legacy_segment_info(consolidation_id: Column, segment_id: Column, product_id: Column, segment_type: Column, concept: Column) -> Column:
    """The same from the field names of older records."""

    def some(c: Column) -> Column:
        return F.nullif(c, F.lit(""))

    business = consolidation_id.isNotNull() | segment_id.isNotNull()
    kind = F.when(business, "business").when(product_id.isNotNull(), "product_service").otherwise(F.coalesce(some(segment_type), F.lit("unknown")))
    name = F.when(business, F.coalesce(some(consolidation_id), some(segment_id))).when(product_id.isNotNull(), some(product_id)).when(some(segment_type).isNotNull(), concept)
    return F.struct(kind.alias("segment_type"), F.coalesce(name, F.lit("unknown")).alias("concept"))


def segment_header(kind: Column) -> Column:
    """Grouping header of a segment type; NULL for an unknown one."""
    low = F.lower(F.trim(kind))
    words = F.regexp_extract_all(low, F.lit("[a-z0-9]+"), F.lit(0))
    pascal = F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1000))), "")
    own = F.when(pascal.endswith("Segmentation") | pascal.endswith("Segments"), pascal).otherwise(F.concat(pascal, F.lit("Segmentation")))
    out = F.when(F.coalesce(low, F.lit("")).isin("", "unknown", "dimensional"), F.lit(None).cast("string"))
    for parts, header in HEADERS:
        out = out.when(_has(low, parts), F.lit(header))
    return out.when(F.size(words) > 0, F.concat(F.lit("custom:"), own))
