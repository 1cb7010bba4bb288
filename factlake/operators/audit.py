"""Audit of a company's stored trees: findings, structural linter, sanitiser, the whole stock."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from . import hierarchy, series

# --- fixed values -----------------------------------------------------------
UNGROUPED_MEMBERS = 3
WRAPPER_WORDS = ("ActivitiesSection", "Consolidation", "Statement", "CashFlow")
HIDDEN = "555"
INCOME_ROOTS = (
    "Revenues", "SalesRevenueNet", "SalesRevenueGoodsNet", "RevenueFromContractWithCustomerExcludingAssessedTax", "RevenueFromContractWithCustomerIncludingAssessedTax",
    "RevenuesNetOfInterestExpense", "InterestAndNoninterestRevenue", "CostOfGoodsAndServicesSold", "CostOfRevenue", "CostOfGoodsSold", "GrossProfit", "OperatingExpenses",
    "CostsAndExpenses", "NoninterestExpense", "OperatingIncomeLoss", "NonoperatingIncomeExpense",
    "IncomeLossFromContinuingOperationsBeforeIncomeTaxesExtraordinaryItemsNoncontrollingInterest",
    "IncomeLossFromContinuingOperationsBeforeIncomeTaxesMinorityInterestAndIncomeLossFromEquityMethodInvestments",
    "IncomeLossFromContinuingOperationsBeforeIncomeTaxesDomestic", "IncomeLossFromContinuingOperations", "IncomeTaxExpenseBenefit", "NetIncomeLoss", "ProfitLoss",
    "NetIncomeLossAvailableToCommonStockholdersBasic", "ComprehensiveIncomeNetOfTax", "EarningsPerShareBasic", "EarningsPerShareDiluted",
    "WeightedAverageNumberOfSharesOutstandingBasic", "WeightedAverageNumberOfDilutedSharesOutstanding",
)
OPERATING_CHILDREN = (
    "ResearchAndDevelopmentExpense", "ResearchAndDevelopmentExpenseSoftwareExcludingAcquiredInProcessCost", "SellingGeneralAndAdministrativeExpense",
    "SellingAndMarketingExpense", "SellingExpense", "MarketingExpense", "GeneralAndAdministrativeExpense", "RestructuringCharges",
    "RestructuringSettlementAndImpairmentProvisions",
)
OPERATING_TOTALS = ("us-gaap:OperatingExpenses", "system:TotalOperatingExpenses", "us-gaap:NoninterestExpense", "us-gaap:CostsAndExpenses")
NONOPERATING = "us-gaap:NonoperatingIncomeExpense"
NONOPERATING_CHILDREN = (
    "InterestIncomeExpenseNet", "InterestIncomeExpenseNonoperatingNet", "InterestExpense", "InterestExpenseNonoperating", "InvestmentIncomeInterest",
    "InterestIncomeOperating", "OtherNonoperatingIncomeExpense",
)
LIABILITY_ROOTS = ("us-gaap:Liabilities", "ifrs-full:Liabilities")
LIABILITY_CHILDREN = ("us-gaap:LiabilitiesCurrent", "ifrs-full:CurrentLiabilities", "us-gaap:LiabilitiesNoncurrent", "ifrs-full:NoncurrentLiabilities")
PLANT_NET, PLANT_GROSS = "us-gaap:PropertyPlantAndEquipmentNet", "us-gaap:PropertyPlantAndEquipmentGross"
CASH_ROOTS = ("CashCashEquivalentsRestrictedCash", "CashAndCashEquivalentsPeriodIncreaseDecrease", "CashAndCashEquivalentsAtCarryingValue", "EffectOfExchangeRateOnCash")
SUPPLEMENTAL = "custom:SupplementalCashFlowInformation"
COST_TOTALS, EXPENSE_TOTALS = ("CostsAndExpenses", "TotalCostsAndExpenses"), ("OperatingExpenses", "TotalOperatingExpenses")


def _blank(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) == ""


def _findings(rows: DataFrame, keys: list[str], kind: str, concept: Column | None = None, n: Column | None = None) -> DataFrame:
    text = F.lit(None).cast("string") if concept is None else concept
    return rows.select(*keys, F.lit(kind).alias("type"), text.alias("concept"), (F.lit(1) if n is None else n).cast("bigint").alias("n"))


def hierarchy_findings(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, type, concept, n of stored rows (keys, concept, path, order_key, parent, dimensional, parent_header, hide).

    ``keys`` name a statement of one cadence. Hidden rows are left out. Missing
    and quarantined paths, parents that aren't there (custom headers aside),
    places that rows of one kind share, three members or more under one parent
    without a header.
    """
    live = rows.filter(~F.coalesce(F.col("hide"), F.lit(False)) & ~_blank("concept"))
    path = F.coalesce("path", F.lit(""))
    bad = (path == "") | (path == "404") | path.contains(".404") | path.startswith("404.")
    known = rows.select(*keys, F.col("concept").alias("parent")).distinct()
    lost = live.filter(~_blank("parent") & ~F.col("parent").startswith("custom:")).join(known, [*keys, "parent"], "left_anti")
    shared = live.filter(~_blank("path") & ~_blank("order_key") & (F.col("path") != HIDDEN)).groupBy(*keys, "dimensional", "path", "order_key").agg(F.count_distinct("concept").alias("m")).filter("m > 1")
    loose = live.filter(F.col("dimensional") & ~_blank("parent") & F.col("parent_header").isNull()).groupBy(*keys, "parent").agg(F.count_distinct("concept").alias("m")).filter(F.col("m") >= UNGROUPED_MEMBERS)
    return reduce(DataFrame.unionByName, (
        _findings(live.filter(bad), keys, "polluted_or_missing_path", F.col("concept")),
        _findings(lost, keys, "orphan_parent_concept", F.col("concept")),
        _findings(shared, keys, "duplicate_path_order_key", F.concat_ws("/", "path", "order_key"), F.col("m")),
        _findings(loose, keys, "ungrouped_dimensional_members", F.col("parent"), F.col("m")),
    ))


def linter(rows: DataFrame, keys: list[str], known: DataFrame | None = None, placed: bool = True) -> DataFrame:
    """keys, rule, concept, n: the ten structural rules over a tree's rows and members.

    ``rows``: keys, concept, path, order_key, parent, dimensional, parent_header.
    ``known``: keys, concept of names that count as present. 1 shared paths, 2
    shared places within a kind, 3 absent parents, 4 headers that wrap the whole
    statement, 5 headers without a parent, 6 a header under several parents, 7
    three members or more without a header, 8 absent headers, 9 rows without a
    path, 10 order keys of siblings that aren't a, b, c and so on.
    """
    lines, dims = rows.filter("not dimensional"), rows.filter("dimensional")
    custom = F.col("concept").startswith("custom:")
    at = rows.filter(~_blank("path") & (F.col("path") != HIDDEN))
    kind = F.concat(F.coalesce("concept", F.lit("")), F.when(F.col("dimensional"), "[dim]").otherwise("[row]"))
    names = lines.filter(~_blank("concept")).select(*keys, "concept")
    names = (names if known is None else names.unionByName(known.select(*keys, "concept"))).distinct()
    wraps = F.lit(False)
    for w in WRAPPER_WORDS:
        wraps = wraps | F.col("concept").contains(w)
    siblings = Window.partitionBy(*keys, "parent")
    rank = hierarchy.letters_rank(F.coalesce("order_key", F.lit("")))
    order = at.filter("not dimensional").withColumn("_r", rank)
    order = order.withColumn("_ok", F.col("_r") == F.row_number().over(siblings.orderBy("_r")) - 1).groupBy(*keys, "parent").agg(F.count_if(~F.col("_ok")).alias("m")).filter("m > 0")
    out = [
        _findings(at.groupBy(*keys, "path").agg(F.count_distinct(kind).alias("m")).filter("m > 1"), keys, "1", F.col("path"), F.col("m")),
        _findings(at.groupBy(*keys, "path", F.coalesce("order_key", F.lit("")).alias("o"), "dimensional").agg(F.count_distinct("concept").alias("m")).filter("m > 1"), keys, "2", F.concat_ws("/", "path", "o"), F.col("m")),
        _findings(lines.filter(~_blank("parent")).join(names.withColumnRenamed("concept", "parent"), [*keys, "parent"], "left_anti"), keys, "3", F.col("concept")),
        _findings(lines.filter(custom & wraps), keys, "4", F.col("concept")),
        _findings(lines.filter(custom & _blank("parent")), keys, "5", F.col("concept")),
        _findings(lines.filter(custom).groupBy(*keys, "concept").agg(F.count_distinct(F.coalesce("parent", F.lit(""))).alias("m")).filter("m > 1"), keys, "6", F.col("concept"), F.col("m")),
        _findings(dims.filter(~_blank("parent")).groupBy(*keys, "parent").agg(F.count("*").alias("m"), F.count_if(~_blank("parent_header")).alias("h")).filter((F.col("m") >= UNGROUPED_MEMBERS) & (F.col("h") == 0)), keys, "7", F.col("parent"), F.col("m")),
        _findings(dims.filter(~_blank("parent_header")).join(names.withColumnRenamed("concept", "parent_header"), [*keys, "parent_header"], "left_anti"), keys, "8", F.col("concept")),
        _findings(order, keys, "10", F.coalesce("parent", F.lit("ROOT")), F.col("m")),
    ]
    if placed:
        out.append(_findings(rows.filter(_blank("path")), keys, "9", kind))
    return reduce(DataFrame.unionByName, out).withColumnRenamed("type", "rule")


def sanitised(rows: DataFrame, filing: DataFrame, keys: list[str]) -> DataFrame:
    """Proposed rows (keys, statement_type, concept, parent, position, stored, hide) with parents that accounting and the filing allow, and order among siblings.

    ``keys`` name a statement, in which a concept is once. ``filing``: keys,
    concept, parent, calc_parent. Stored rows stay. Where a row is placed under
    what by calculation is its own part, the two change places, and with them
    the part's other children. Then by statement. Income: revenue lines, results
    and the like are roots; operating and other expenses go under their totals.
    Balance sheet: current and other liabilities under liabilities, net plant
    over gross. Cash flow: cash, exchange effects and supplemental lines are
    roots. Nothing is hidden; in a fresh tree siblings are numbered anew.
    """
    free = ~F.coalesce(F.col("stored"), F.lit(False))
    r = rows.withColumn("parent", F.nullif("parent", F.lit("")))
    # Inversion: the parent's own calculation parent is the row.
    f = filing.select(*keys, F.col("concept").alias("parent"), F.coalesce("calc_parent", "parent").alias("_of_parent"))
    own = filing.select(*keys, "concept", F.coalesce("parent", "calc_parent").alias("_upper"))
    names = r.select(*keys, F.col("concept").alias("_upper"), F.lit(True).alias("_there"))
    r = r.join(f, [*keys, "parent"], "left").join(own, [*keys, "concept"], "left").join(names, [*keys, "_upper"], "left")
    swaps = F.coalesce(free & (F.col("_of_parent") == F.col("concept")), F.lit(False))
    r = r.withColumn("_swap", swaps)
    moved = r.filter("_swap").groupBy(*keys, F.col("parent").alias("_below")).agg(F.min("concept").alias("_over"))
    upper = F.when(F.col("_there") & (F.col("_upper") != F.col("parent")), F.col("_upper"))
    by_self = moved.withColumnsRenamed({"_below": "concept", "_over": "_over_self"})
    by_parent = moved.withColumnsRenamed({"_below": "parent", "_over": "_over_parent"})
    r = r.join(by_self, [*keys, "concept"], "left").join(by_parent, [*keys, "parent"], "left")
    parent = F.when(F.col("_swap"), upper).when(free & F.col("_over_self").isNotNull(), F.col("_over_self")).when(free & F.col("_over_parent").isNotNull(), F.col("_over_parent")).otherwise(F.col("parent"))
    r = r.withColumns({"_was": F.col("parent"), "parent": parent})

    w = Window.partitionBy(*keys)
    has = lambda c: F.coalesce(F.max(F.col("concept") == c).over(w), F.lit(False))
    marks = {f"_t{k}": has(c) for k, c in enumerate(OPERATING_TOTALS)} | {"_nonop": has(NONOPERATING), "_l0": has(LIABILITY_ROOTS[0]), "_l1": has(LIABILITY_ROOTS[1]), "_noncurrent": has("us-gaap:AssetsNoncurrent"), "_assets": has("us-gaap:Assets")}
    net_under_gross = F.coalesce(F.max((F.col("concept") == PLANT_NET) & (F.col("parent") == PLANT_GROSS) & free).over(w), F.lit(False)) & has(PLANT_GROSS)
    r = r.withColumns({**marks, "_plant": net_under_gross, "_fresh": ~F.max(~free).over(w)})
    st = F.lower(F.regexp_replace("statement_type", "[- ]", "_"))
    local, up = T.local_name(F.col("concept")), F.col("parent")
    up_local = T.local_name(F.coalesce(up, F.lit("")))
    operating = F.lit(None).cast("string")
    for k in range(len(OPERATING_TOTALS) - 1, -1, -1):
        operating = F.when(F.col(f"_t{k}"), OPERATING_TOTALS[k]).otherwise(operating)
    none = F.lit(None).cast("string")
    income = (
        F.when(local.isin(*INCOME_ROOTS), none)
        .when(local.isin(*OPERATING_CHILDREN), F.when(operating.isNotNull(), operating).when(up.startswith("custom:"), up))
        .when(local.isin(*NONOPERATING_CHILDREN), F.when(F.col("_nonop"), NONOPERATING).when(up_local.isin(*INCOME_ROOTS), none).otherwise(up))
        .otherwise(up)
    )
    liabilities = F.when(F.col("_l0"), LIABILITY_ROOTS[0]).when(F.col("_l1"), LIABILITY_ROOTS[1])
    assets = F.when(F.col("_noncurrent"), "us-gaap:AssetsNoncurrent").when(F.col("_assets"), "us-gaap:Assets")
    plant = F.when(F.col("concept") == PLANT_NET, assets).when((F.col("concept") == PLANT_GROSS) | (up == PLANT_GROSS), PLANT_NET).otherwise(up)
    balance = F.when(F.col("concept").isin(*LIABILITY_CHILDREN) & liabilities.isNotNull(), liabilities).when(F.col("_plant"), plant).otherwise(up)
    rooted = F.lit(False)
    for x in CASH_ROOTS:
        rooted = rooted | local.startswith(x)
    cash = F.when(rooted | ((F.col("concept") == SUPPLEMENTAL) & up_local.contains("PeriodIncreaseDecrease")), none).otherwise(up)
    fixed = F.when(~free, up).when(st.contains("income"), income).when(st.contains("balance"), balance).when(st.contains("cash") | st.contains("flow"), cash).otherwise(up)
    r = r.withColumn("parent", fixed)
    changed = F.max(~F.col("parent").eqNullSafe(F.col("_was"))).over(w)
    order = F.row_number().over(Window.partitionBy(*keys, "parent").orderBy("position"))
    r = r.withColumns({"order": F.when(changed & F.col("_fresh"), order), "hide": F.lit(False)})
    return r.select(*rows.columns, "order")


def promotion(pairs: DataFrame, locked: bool = False) -> DataFrame:
    """Adds keep: which of two equal tags (incoming, stored; incoming_period, stored_period) survives, the incoming one only if its latest period is strictly newer.

    'refused' where one means all costs and the other operating expenses only;
    under a lock always the stored one.
    """
    a, b = T.local_name(F.col("incoming")), T.local_name(F.col("stored"))
    different = (a.isin(*COST_TOTALS) & b.isin(*EXPENSE_TOTALS)) | (b.isin(*COST_TOTALS) & a.isin(*EXPENSE_TOTALS))
    newer = F.coalesce(F.col("incoming_period") > F.col("stored_period"), F.lit(False)) & F.lit(not locked)
    return pairs.withColumn("keep", F.when(different, "refused").when(newer, "incoming").otherwise("stored"))


def whole_stock(concepts: DataFrame, values: DataFrame) -> DataFrame:
    """cik, cadence, kind, n: hierarchy issues, gaps in series and scale jumps of every company, and clean where it has none.

    ``concepts``: cik, cadence, statement_type and the columns of ``hierarchy_findings``. ``values``: cik,
    cadence, statement_type, concept, period, value. A series' periods are those of its statement.
    """
    own = ["cik", "cadence", "statement_type"]
    parts = (
        hierarchy_findings(concepts, own).select("cik", "cadence", F.lit("hierarchy").alias("kind")),
        series.interior_gaps(values, own, [*own, "concept"]).select("cik", "cadence", F.lit("gap").alias("kind")),
        series.scale_jumps(values, [*own, "concept"]).select("cik", "cadence", F.lit("scale").alias("kind")),
    )
    found = reduce(DataFrame.unionByName, parts).groupBy("cik", "cadence", "kind").agg(F.count("*").alias("n"))
    clean = concepts.select("cik", "cadence").distinct().join(found.select("cik", "cadence").distinct(), ["cik", "cadence"], "left_anti")
    return found.unionByName(clean.select("cik", "cadence", F.lit("clean").alias("kind"), F.lit(0).cast("bigint").alias("n")))
