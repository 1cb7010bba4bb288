"""Subtotals that a statement lacks.

Lines come as rows (keys, position, concept, value, abstract). Roles are picked
per statement by conditional aggregation - the least rank of the role's names,
then the least position - so a statement is one row while it is decided and
nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import local_name

# --- fixed values -----------------------------------------------------------
REVENUE = ("Revenues", "RevenueFromContractWithCustomerExcludingAssessedTax", "RevenueFromContractWithCustomerIncludingAssessedTax", "SalesRevenueNet", "SalesRevenueGoodsNet", "SalesRevenueServicesNet", "RevenueFromSaleOfGoods", "Revenue")
COST = ("CostOfGoodsAndServicesSold", "CostOfRevenue", "CostOfGoodsSold", "CostOfGoodsAndServiceExcludingDepreciationDepletionAndAmortization", "CostOfSales")
GROSS = ("GrossProfit", "GrossMargin")
OPERATING_INCOME = ("OperatingIncomeLoss", "IncomeLossFromOperations")
EXPENSES = ("OperatingExpenses", "TotalOperatingExpenses", "NoninterestExpense")
EXPENSE_TOTALS = ("OperatingExpenses", "TotalOperatingExpenses", "SellingGeneralAndAdministrativeExpense")
EXPENSE_CHILDREN = (
    "SellingGeneralAndAdministrativeExpense", "SellingAndMarketingExpense", "GeneralAndAdministrativeExpense", "ResearchAndDevelopmentExpense",
    "ResearchAndDevelopmentExpenseExcludingAcquiredInProcessCost", "MarketingExpense", "SellingExpense", "DepreciationAndAmortization",
    "DepreciationDepletionAndAmortization", "RestructuringCharges", "RestructuringSettlementAndImpairmentProvisions", "GoodwillImpairmentLoss",
    "AssetImpairmentCharges", "PreOpeningCosts", "OtherCostAndExpenseOperating", "OtherOperatingExpenses",
)
ASSETS, ASSETS_CURRENT, ASSETS_NONCURRENT = ("Assets",), ("AssetsCurrent", "CurrentAssets"), ("AssetsNoncurrent", "NoncurrentAssets")
BOTH_SIDES = ("LiabilitiesAndStockholdersEquity", "EquityAndLiabilities")
LIABILITIES, LIABILITIES_CURRENT, LIABILITIES_NONCURRENT = ("Liabilities", "TotalLiabilities"), ("LiabilitiesCurrent", "CurrentLiabilities"), ("LiabilitiesNoncurrent", "NoncurrentLiabilities")
EQUITY = ("StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest", "StockholdersEquity", "Equity")
MEZZANINE = ("TemporaryEquityCarryingAmountAttributableToParent", "TemporaryEquityCarryingAmountIncludingPortionAttributableToNoncontrollingInterests", "RedeemableNoncontrollingInterestEquityCarryingAmount")
SHARE_OF_IMPLIED, LEAST_SLACK = 0.02, 1.0


def _role(names: tuple[str, ...]) -> tuple[Column, Column]:
    """Value and position of a role's best line."""
    local = local_name(F.col("concept"))
    rank = F.array_position(F.array(*map(F.lit, names)), local)
    usable = local.isin(*names) & ~F.col("abstract") & F.col("value").isNotNull()
    best = F.min(F.when(usable, F.struct(rank.alias("r"), F.col("position").alias("p"), F.col("value").alias("v"))))
    return best["v"], best["p"]


def _present(names: tuple[str, ...]) -> Column:
    return F.bool_or(local_name(F.col("concept")).isin(*names))


def _emit(rows: DataFrame, keys: list[str], derived: dict[str, Column]) -> DataFrame:
    items = F.array(*[F.struct(F.lit(name).alias("concept"), v.alias("value")) for name, v in derived.items()])
    return rows.select(*keys, F.explode(F.filter(items, lambda x: x["value"].isNotNull())).alias("x")).select(*keys, "x.concept", "x.value")


def income_subtotals(lines: DataFrame, keys: list[str]) -> DataFrame:
    """keys, concept, value of the gross profit, operating expenses and operating income that can be derived.

    Each later subtotal may use an earlier derived one.
    """
    child = local_name(F.col("concept")).isin(*EXPENSE_CHILDREN) & ~F.col("abstract") & F.col("value").isNotNull()
    revenue, cost, gross, income, total = (_role(x) for x in (REVENUE, COST, GROSS, OPERATING_INCOME, EXPENSE_TOTALS))
    one = lines.groupBy(*keys).agg(
        revenue[0].alias("revenue"), cost[0].alias("cost"), gross[0].alias("gross"), income[0].alias("income"), income[1].alias("income_at"), total[0].alias("total"),
        _present(GROSS).alias("has_gross"), _present(EXPENSES).alias("has_expenses"), _present(OPERATING_INCOME).alias("has_income"),
    )
    # Children count up to the operating income, whose position the first pass gives.
    kids = lines.filter(child).join(one.select(*keys, "income_at"), keys).filter("income_at is null or position < income_at")
    kids = kids.groupBy(*keys).agg(F.count("*").alias("n_kids"), F.sum(F.abs("value")).alias("sum_kids"))
    one = one.join(kids, keys, "left")
    new_gross = F.when(~F.col("has_gross"), F.col("revenue") - F.abs("cost"))
    one = one.withColumn("new_gross", new_gross).withColumn("any_gross", F.coalesce("gross", "new_gross"))
    implied = F.col("any_gross") - F.col("income")
    agrees = F.coalesce(F.abs(F.col("sum_kids") - implied) <= F.greatest(F.abs(implied) * SHARE_OF_IMPLIED, F.lit(LEAST_SLACK)), F.lit(True))
    new_expenses = F.when(~F.col("has_expenses") & (F.col("n_kids") >= 2) & (F.col("sum_kids") > 0) & agrees, F.col("sum_kids"))
    one = one.withColumn("new_expenses", new_expenses)
    new_income = F.when(~F.col("has_income"), F.col("any_gross") - F.abs(F.coalesce("new_expenses", "total")))
    return _emit(one, keys, {"us-gaap:GrossProfit": F.col("new_gross"), "us-gaap:OperatingExpenses": F.col("new_expenses"), "us-gaap:OperatingIncomeLoss": new_income})


def balance_subtotals(lines: DataFrame, keys: list[str]) -> DataFrame:
    """keys, concept, value of the liabilities, non-current assets and non-current liabilities that can be derived."""
    roles = {"assets": ASSETS, "assets_current": ASSETS_CURRENT, "both": BOTH_SIDES, "liabilities": LIABILITIES, "liabilities_current": LIABILITIES_CURRENT, "equity": EQUITY}
    aggs: list[Column] = []
    for name, names in roles.items():
        value, at = _role(names)
        aggs += [value.alias(name), at.alias(f"{name}_at")]
    local = local_name(F.col("concept"))
    usable = ~F.col("abstract") & F.col("value").isNotNull()
    aggs += [F.sum(F.when(usable & local.isin(*MEZZANINE), F.col("value"))).alias("mezzanine"), _present(LIABILITIES).alias("has_liabilities"), _present(ASSETS_NONCURRENT).alias("has_anc"), _present(LIABILITIES_NONCURRENT).alias("has_lnc")]
    one = lines.groupBy(*keys).agg(*aggs)
    found = F.coalesce("both", "assets") - F.col("equity") - F.coalesce("mezzanine", F.lit(0))
    found = F.when(~F.col("has_liabilities") & F.coalesce(found >= F.col("liabilities_current") - LEAST_SLACK, F.lit(True)), found)
    one = one.withColumn("new_liabilities", found)
    last = F.when(F.col("equity_at") > F.col("liabilities_current_at"), F.col("equity_at")).when(F.col("liabilities_at") > F.col("liabilities_current_at"), F.col("liabilities_at"))
    spans = one.select(*keys, "assets_at", "assets_current_at", "liabilities_current_at", last.alias("last_at"))
    inside = lines.filter(usable).join(spans, keys)
    own = local_name(F.col("concept"))
    a = F.col("position").between(F.col("assets_current_at") + 1, F.col("assets_at") - 1) & ~own.isin(*ASSETS)
    b = (F.col("position") > F.col("liabilities_current_at")) & F.coalesce(F.col("position") < F.col("last_at"), F.lit(True)) & ~own.isin(*LIABILITIES, *EQUITY, *MEZZANINE)
    counts = inside.groupBy(*keys).agg(F.count_if(F.coalesce(a, F.lit(False))).alias("n_a"), F.count_if(F.coalesce(b, F.lit(False))).alias("n_b"))
    one = one.join(counts, keys, "left")
    rest_assets = F.col("assets") - F.col("assets_current")
    rest_liabilities = F.coalesce("liabilities", "new_liabilities") - F.col("liabilities_current")
    anc = F.when(~F.col("has_anc") & (F.col("n_a") >= 2) & (rest_assets >= -LEAST_SLACK), rest_assets)
    lnc = F.when(~F.col("has_lnc") & (F.col("n_b") >= 2) & (rest_liabilities >= -LEAST_SLACK), rest_liabilities)
    return _emit(one, keys, {"us-gaap:Liabilities": F.col("new_liabilities"), "us-gaap:AssetsNoncurrent": anc, "us-gaap:LiabilitiesNoncurrent": lnc})


def comparatives(values: DataFrame, keys: list[str], period: str, signs: dict[str, int]) -> DataFrame:
    """keys, period, value: the signed sum over the periods that every operand has (absolute subtrahends)."""
    sign = F.lit(None).cast("int")
    for concept, s in signs.items():
        sign = F.when(F.col("concept") == concept, F.lit(s)).otherwise(sign)
    used = values.filter(F.col("concept").isin(*signs)).withColumn("_s", sign)
    part = F.when(F.col("_s") < 0, -F.abs("value")).otherwise(F.col("value"))
    return used.groupBy(*keys, period).agg(F.sum(part).alias("value"), F.count_distinct("concept").alias("_n")).filter(F.col("_n") == len(signs)).drop("_n")


def subtotals(lines: DataFrame, keys: list[str]) -> DataFrame:
    """keys, statement_type, concept, value: the subtotals that statements lack, by the rules of their kind; other kinds have none."""
    kind = F.lower("statement_type")
    income = income_subtotals(lines.filter(kind.contains("income")), keys).withColumn("statement_type", F.lit("income"))
    balance = balance_subtotals(lines.filter(kind.contains("balance")), keys).withColumn("statement_type", F.lit("balancesheet"))
    return income.unionByName(balance).select(*keys, "statement_type", "concept", "value")
