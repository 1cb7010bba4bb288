"""Checks over statements; every check gives findings with one schema.

type, severity, statement_type, concept and evidence (map of text), beside the
statement's keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import periods as P
from ..functions.text import local_name, parent_path

# --- fixed values -----------------------------------------------------------
MANY_LINES = 25
MARKERS = {
    ("income",): ("Revenues", "SalesRevenueNet", "SalesRevenueGoodsNet", "RevenueFromContractWithCustomer", "GrossProfit", "OperatingIncomeLoss", "CostOfRevenue", "CostOfGoodsAndServicesSold"),
    ("balance", "balance_sheet", "balancesheet"): ("Assets", "Liabilities", "StockholdersEquity"),
    ("cash_flow", "cashflow"): ("NetCashProvidedByUsedInOperatingActivities", "NetCashProvidedByUsedInInvestingActivities", "NetCashProvidedByUsedInFinancingActivities"),
}
RELATIVE_TOLERANCE, ABSOLUTE_TOLERANCE = 0.005, 1.0
IMPLAUSIBLE = 1e15
SHORTEST_DAYS, LONGEST_DAYS = 30, 400
NEVER_NEGATIVE = (
    "Assets", "AssetsCurrent", "AssetsNoncurrent", "Liabilities", "LiabilitiesCurrent", "Revenues",
    "RevenueFromContractWithCustomerExcludingAssessedTax", "RevenueFromContractWithCustomerIncludingAssessedTax", "SalesRevenueNet",
    "SalesRevenueGoodsNet", "CostOfRevenue", "CostOfGoodsAndServicesSold",
)
NOT_BLOCKING = (
    "missing_concept", "empty_statement", "duplicate_path_order", "orphan_hierarchy_path", "missing_hierarchy_path",
    "negative_hierarchy_level", "missing_concept_name", "abstract_in_concrete_set", "duplicate_concept",
)
REVENUE = ("us-gaap:Revenues", "us-gaap:RevenueFromContractWithCustomerExcludingAssessedTax", "us-gaap:RevenueFromContractWithCustomerIncludingAssessedTax", "us-gaap:SalesRevenueNet", "us-gaap:SalesRevenueGoodsNet")
COST = ("us-gaap:CostOfRevenue", "us-gaap:CostOfGoodsAndServicesSold", "us-gaap:CostOfGoodsSold", "us-gaap:CostOfServices")
EXPENSES = ("us-gaap:OperatingExpenses", "us-gaap:CostsAndExpenses")
EQUITY = ("us-gaap:StockholdersEquity", "us-gaap:StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest")
#: name, target, (names, sign) of each term, statement.
IDENTITIES = (
    ("gross_profit", ("us-gaap:GrossProfit",), ((REVENUE, 1), (COST, -1)), "income"),
    ("operating_income", ("us-gaap:OperatingIncomeLoss",), ((("us-gaap:GrossProfit",), 1), (EXPENSES, -1)), "income"),
    ("assets_equals_liabilities_and_equity", ("us-gaap:Assets",), ((("us-gaap:LiabilitiesAndStockholdersEquity",), 1),), "balancesheet"),
    ("assets_equals_liabilities_plus_equity", ("us-gaap:Assets",), ((("us-gaap:Liabilities",), 1), (EQUITY, 1)), "balancesheet"),
)
MANDATORY = {
    "income": (
        ("Revenues", "Revenue", "SalesRevenueNet", "SalesRevenueGoodsNet", "SalesRevenueServicesNet", "RevenueFromContractWithCustomer", "RevenueFromContractWithCustomerExcludingAssessedTax", "RevenueFromContractWithCustomerIncludingAssessedTax", "RevenueFromSaleOfGoods", "OperatingIncomeLoss", "IncomeLossFromOperations"),
        ("revenue", "sales", "turnover", "operatingincome", "operating income", "operating profit", "netincome", "net income", "profitloss", "interestincome", "interest income", "feeincome", "premium"),
    ),
    "balancesheet": (("Assets", "Liabilities", "StockholdersEquity", "LiabilitiesAndStockholdersEquity"), ("asset", "liabilit", "equity")),
    "cashflow": (("NetCashProvidedByUsedInOperatingActivities", "NetCashProvidedByUsedInInvestingActivities", "NetCashProvidedByUsedInFinancingActivities"), ("operating", "investing", "financing", "cashflow", "cash flow")),
}


def _finding(rows: DataFrame, keys: list[str], kind: Column | str, severity: str, concept: Column | None = None, **evidence: Column) -> DataFrame:
    pairs = [x for k, v in evidence.items() for x in (F.lit(k), v.cast("string"))]
    detail = F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,string>")
    name = F.lit(kind) if isinstance(kind, str) else kind
    return rows.select(*keys, name.alias("type"), F.lit(severity).alias("severity"), (F.lit(None).cast("string") if concept is None else concept).alias("concept"), detail.alias("evidence"))


def _found(when: Column, kind: str, severity: str, concept: Column | None = None, **evidence: Column) -> Column:
    """A finding as a struct where ``when`` holds, else NULL."""
    pairs = [x for k, v in evidence.items() for x in (F.lit(k), v.cast("string"))]
    detail = F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,string>")
    name = F.lit(None).cast("string") if concept is None else concept
    return F.when(when, F.struct(F.lit(kind).alias("type"), F.lit(severity).alias("severity"), name.alias("concept"), detail.alias("evidence")))


def _each(rows: DataFrame, keys: list[str], *findings: Column) -> DataFrame:
    """The findings of each row, from one pass over the rows."""
    return rows.select(*keys, F.explode(F.array_compact(F.array(*findings))).alias("_f")).select(*keys, "_f.*")


def _close(target: Column, expected: Column) -> Column:
    return F.abs(target - expected) <= F.greatest(F.abs(target) * RELATIVE_TOLERANCE, F.lit(ABSOLUTE_TOLERANCE))


def _first(names: tuple[str, ...]) -> Column:
    """Value of the first of the names that a statement has."""
    rank = F.array_position(F.array(*map(F.lit, names)), F.col("concept"))
    return F.min(F.when(F.col("concept").isin(*names) & F.col("value").isNotNull(), F.struct(rank.alias("r"), F.col("value").alias("v"))))["v"]


def check_math(lines: DataFrame, keys: list[str]) -> DataFrame:
    """math_mismatch for each identity that holds neither with stored signs nor with absolute subtrahends; incomplete ones are skipped."""
    aggs = []
    for i, (_, target, terms, _) in enumerate(IDENTITIES):
        aggs.append(_first(target).alias(f"t{i}"))
        aggs += [_first(names).alias(f"t{i}_{j}") for j, (names, _) in enumerate(terms)]
    one = lines.groupBy(*keys, "statement_type").agg(*aggs)
    out = []
    for i, (name, target, terms, statement) in enumerate(IDENTITIES):
        t = F.col(f"t{i}")
        stored = sum((F.col(f"t{i}_{j}") * s for j, (_, s) in enumerate(terms)), F.lit(0))
        absolute = sum((F.col(f"t{i}_{j}") if s > 0 else -F.abs(F.col(f"t{i}_{j}")) for j, (_, s) in enumerate(terms)), F.lit(0))
        bad = (F.col("statement_type") == statement) & ~(_close(t, stored) | _close(t, absolute))
        out.append(_found(bad, "math_mismatch", "high", F.lit(target[0]), identity=F.lit(name), target=t, expected=stored, absolute=absolute))
    return _each(one, [*keys, "statement_type"], *out)


def check_plausibility(lines: DataFrame, keys: list[str]) -> DataFrame:
    k = [*keys, "statement_type"]
    one = lines.filter("value is not null").groupBy(*k).agg(
        F.count_if(F.abs("value") > IMPLAUSIBLE).alias("huge"),
        F.count_if((F.col("value") < 0) & local_name(F.col("concept")).isin(*NEVER_NEGATIVE)).alias("negative"),
        F.count("*").alias("n"), F.min("value").alias("least"), F.max("value").alias("most"),
    )
    return _each(
        one, k,
        _found(F.col("huge") > 0, "implausible_magnitude", "medium", n=F.col("huge")),
        _found(F.col("negative") > 0, "unexpected_negative_value", "medium", n=F.col("negative")),
        _found((F.col("n") >= 3) & (F.col("least") == F.col("most")), "all_values_identical", "low", n=F.col("n")),
    )


def check_coverage(lines: DataFrame, keys: list[str]) -> DataFrame:
    """missing_mandatory_concept where neither a tag nor a word of the statement's list occurs."""
    local = local_name(F.col("concept"))
    text = F.lower(F.concat_ws(" ", local, F.coalesce("label", F.lit(""))))
    hit = F.lit(False)
    for name, (tags, words) in MANDATORY.items():
        hit = F.when(F.col("statement_type") == name, local.isin(*tags) | text.rlike("|".join(words))).otherwise(hit)
    one = lines.filter(F.col("value").isNotNull() & F.col("statement_type").isin(*MANDATORY)).groupBy(*keys, "statement_type").agg(F.bool_or(hit).alias("ok"), F.count("*").alias("n"))
    return _finding(one.filter("not ok"), [*keys, "statement_type"], "missing_mandatory_concept", "high", n=F.col("n"))


def check_structure(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Missing names, concepts twice in a period, missing and shared places, negative levels, abstract rows, orphan paths.

    ``lines``: concept, period, path, order_key, level, abstract beside the keys.
    """
    k = [*keys, "statement_type"]
    named = F.coalesce(F.col("concept"), F.lit("")) != ""
    placed = named & F.col("path").isNotNull() & F.col("order_key").isNotNull()
    up = F.when(F.col("path").contains(".") & ~F.col("path").startswith("555"), parent_path(F.col("path")))
    rows = lines.select(*k, "concept", "period", "path", "order_key", "level", "abstract", named.alias("_named"), placed.alias("_placed"), up.alias("_up"))
    # Dealt by statement once: the groups inside a statement are windows that need no other shuffle.
    rows = rows.repartition(*k)
    same, place, whole = ([*k, "_named", "concept", "period"], [*k, "_placed", "path", "order_key"], k)
    first = lambda part: F.row_number().over(Window.partitionBy(*part).orderBy("path", "concept"))
    rows = rows.withColumns({"_n_same": F.count("*").over(Window.partitionBy(*same)), "_i_same": first(same)})
    rows = rows.withColumns({"_n_place": F.size(F.collect_set("concept").over(Window.partitionBy(*place))), "_i_place": first(place)})
    w = Window.partitionBy(*whole)
    rows = rows.withColumns({"_n_level": F.count_if(F.col("level") < 0).over(w), "_n_leaks": F.count_if("abstract").over(w), "_paths": F.collect_set(F.nullif("path", F.lit(""))).over(w), "_i": first(whole)})
    rows = rows.withColumn("_lost", F.coalesce(~F.array_contains("_paths", F.col("_up")), F.lit(False))).drop("_paths")
    rows = rows.withColumn("_n_lost", F.count_if("_lost").over(w))
    one = F.col("_i") == 1
    return _each(
        rows, k,
        _found(~F.col("_named"), "missing_concept_name", "high"),
        _found(F.col("_named") & (F.col("_i_same") == 1) & (F.col("_n_same") > 1), "duplicate_concept", "medium", F.col("concept"), n=F.col("_n_same")),
        _found(F.col("_named") & ~F.col("_placed"), "missing_hierarchy_path", "medium", F.col("concept")),
        _found(F.col("_placed") & (F.col("_i_place") == 1) & (F.col("_n_place") > 1), "duplicate_path_order", "medium", n=F.col("_n_place")),
        _found(one & (F.col("_n_level") > 0), "negative_hierarchy_level", "medium", n=F.col("_n_level")),
        _found(one & (F.col("_n_leaks") > 0), "abstract_in_concrete_set", "low", n=F.col("_n_leaks")),
        _found(one & (F.col("_n_lost") > 0), "orphan_hierarchy_path", "medium", n=F.col("_n_lost")),
    )


def check_periods(statements: DataFrame, lines: DataFrame, keys: list[str]) -> DataFrame:
    """``statements``: end_text, fiscal_year, period_type, form; ``lines``: period text."""
    k = [*keys, "statement_type"]
    annual = F.col("form").isin(*P.ANNUAL_FORMS)
    kind = F.lower("period_type")
    mismatch = (annual & (kind != "annual")) | ((F.col("form") == "10-Q") & ~kind.isin("quarterly", "interim"))
    days = P.duration_days(F.col("period"))
    odd = lines.withColumn("days", days).filter((F.col("days") < SHORTEST_DAYS) | (F.col("days") > LONGEST_DAYS)).groupBy(*k).agg(F.count("*").alias("n"))
    found = _each(
        statements, k,
        _found(F.coalesce(F.col("end_text"), F.lit("")) == "", "missing_period_end", "medium"),
        _found((F.col("end_text") != "") & P.lenient_date(F.col("end_text")).isNull(), "unparseable_period_end", "medium"),
        _found(F.col("fiscal_year").isNull(), "missing_fiscal_year", "low"),
        _found((kind != "") & mismatch, "period_type_form_mismatch", "medium"),
    )
    return found.unionByName(_finding(odd, k, "unusual_period_duration", "low", n=F.col("n")))


def cross_statement(lines: DataFrame, keys: list[str], concept: str = "us-gaap:NetIncomeLoss", most: float = 1.0) -> DataFrame:
    """keys, period, income, cashflow where one concept differs between the two statements; the last row of a period counts."""
    rows = lines.filter((F.col("concept") == concept) & F.col("value").isNotNull())
    last = F.max(F.struct("position", "value"))["value"]
    by = rows.groupBy(*keys, "period", "statement_type").agg(last.alias("value"))
    a = by.filter("statement_type = 'income'").select(*keys, "period", F.col("value").alias("income"))
    b = by.filter("statement_type = 'cashflow'").select(*keys, "period", F.col("value").alias("cashflow"))
    return a.join(b, [*keys, "period"]).filter(F.abs(F.col("income") - F.col("cashflow")) > most)


def presentation_diff(bundle: DataFrame, shown: DataFrame, keys: list[str]) -> DataFrame:
    """keys, concept, type: shown lines that the bundle lacks, has without a value, or has with the other sign."""
    b = bundle.groupBy(*keys, "concept").agg(F.max("value").alias("have"), F.lit(True).alias("_b"))
    j = shown.join(b, [*keys, "concept"], "left")
    kind = F.when(F.col("_b").isNull(), "missing_concept").when(F.col("have").isNull() & F.col("value").isNotNull(), "missing_value").when((F.signum("have") * F.signum("value")) < 0, "sign_mismatch")
    return j.select(*keys, "concept", kind.alias("type")).filter("type is not null")


def recovered(bundle: DataFrame, shown: DataFrame, keys: list[str]) -> DataFrame:
    """The bundle (keys, concept, value, parent) with the presentation's lines (the same, one row per concept) that it lacks, and ``source``.

    A line is appended if the presentation shows a value for it and the bundle
    has none. A missing parent comes from the presentation, and so does the sign
    of a value that isn't zero.
    """
    have = bundle.filter("value is not null").select(*keys, "concept").distinct()
    new = shown.filter("value is not null").join(have, [*keys, "concept"], "left_anti")
    columns = [*keys, "concept", "value", "parent"]
    rows = bundle.select(*columns, F.lit("bundle").alias("source")).unionByName(new.select(*columns, F.lit("presentation").alias("source")))
    pres = shown.select(*keys, "concept", F.signum("value").alias("_sign"), F.col("parent").alias("_parent"))
    j = rows.join(pres, [*keys, "concept"], "left")
    other = (F.signum("value") * F.col("_sign")) < 0
    parent = F.coalesce(F.nullif("parent", F.lit("")), "_parent")
    return j.withColumns({"value": F.when(other, -F.col("value")).otherwise(F.col("value")), "parent": parent}).select(*columns, "source")


def classification(lines: DataFrame, keys: list[str]) -> DataFrame:
    """keys, statement_type, n, valid: whether a statement with under 25 lines has a valued concept that marks its kind; other kinds are valid."""
    marked = F.lit(True)
    for kind, words in MARKERS.items():
        marked = F.when(F.col("statement_type").isin(*kind), F.col("concept").rlike("|".join(words)) & F.col("value").isNotNull()).otherwise(marked)
    out = lines.groupBy(*keys, "statement_type").agg(F.count("*").alias("n"), F.coalesce(F.bool_or(marked), F.lit(False)).alias("_m"))
    return out.select(*keys, "statement_type", "n", (F.col("_m") | (F.col("n") >= MANY_LINES)).alias("valid"))


def is_blocking() -> Column:
    return (F.col("severity") == "high") & ~F.col("type").isin(*NOT_BLOCKING)


def severity_counts(findings: DataFrame, keys: list[str]) -> DataFrame:
    """keys, high, medium, low, status."""
    one = findings.groupBy(*keys).agg(*[F.count_if(F.col("severity") == s).alias(s) for s in ("high", "medium", "low")], F.coalesce(F.bool_or(is_blocking()), F.lit(False)).alias("blocked"))
    return one.withColumn("status", F.when(F.col("blocked"), "fail").when(F.col("high") + F.col("medium") + F.col("low") > 0, "pass_with_findings").otherwise("pass")).drop("blocked")


#: Checks of every statement, by name.
CHECKS = {"math": check_math, "plausibility": check_plausibility, "structure": check_structure}


def report(statements: DataFrame, lines: DataFrame, keys: list[str], shown: DataFrame | None = None, cross: bool = False) -> tuple[DataFrame, DataFrame]:
    """Findings of all checks (one schema, with check), and a report per filing: status, counts by severity, blocking, checks.

    ``statements`` as in ``check_periods``, one row per statement. Coverage and
    the presentation's differences are checked for filings that ``shown`` has,
    one concept in two statements only on request.
    """
    def named(f: DataFrame, name: str) -> DataFrame:
        return f.select(*keys, "statement_type", "type", "severity", "concept", F.lit(name).alias("check"))

    parts = [named(f(lines, keys), name) for name, f in CHECKS.items()] + [named(check_periods(statements, lines, keys), "periods")]
    n_checks = F.lit(len(CHECKS) + 1)
    one = statements.groupBy(*keys).agg(F.count("*").alias("statements"))
    if shown is not None:
        have = shown.select(*keys).distinct()
        parts.append(named(check_coverage(lines, keys).join(have, keys, "left_semi"), "coverage"))
        diff = presentation_diff(lines, shown, keys).select("*", F.lit(None).cast("string").alias("statement_type"), F.lit("medium").alias("severity"))
        parts.append(named(diff, "presentation"))
        one = one.join(have.withColumn("_h", F.lit(2)), keys, "left")
        n_checks = n_checks + F.coalesce("_h", F.lit(0))
    if cross:
        both = cross_statement(lines, keys).select(*keys, F.lit(None).cast("string").alias("statement_type"), F.lit("cross_statement_mismatch").alias("type"), F.lit("high").alias("severity"), F.lit("us-gaap:NetIncomeLoss").alias("concept"))
        parts.append(named(both, "cross"))
    findings = reduce(DataFrame.unionByName, parts)
    counts = findings.groupBy(*keys).agg(*[F.count_if(F.col("severity") == x).alias(x) for x in ("high", "medium", "low")], F.count_if(is_blocking()).alias("blocking"))
    out = one.withColumn("checks", F.col("statements") * n_checks).join(counts, keys, "left").fillna(0, ["high", "medium", "low", "blocking"])
    status = F.when(F.col("blocking") > 0, "fail").when(F.col("high") + F.col("medium") + F.col("low") > 0, "pass_with_findings").otherwise("pass")
    return findings, out.withColumn("status", status).select(*keys, "statements", "checks", "high", "medium", "low", "blocking", "status")
