"""Operators on literal inputs with known results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from factlake.functions import arithmetic, canonical
from factlake.functions import periods as P
from factlake.functions import text as T
from factlake.operators import decide, derive, documents, guidance, hierarchy, lookups, merge, quarters, select, series, signs, validate


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def d(text):
    return F.to_date(F.lit(text))


@pytest.mark.parametrize(
    ("day", "code", "convention", "year", "quarter"),
    [("2023-12-31", "0630", "end", 2024, 2), ("2024-05-04", "0131", "end", 2025, 1), ("2025-08-03", "0201", "start", 2025, 2), ("2022-05-21", "0131", "end", 2023, 1), ("2023-12-31", "1231", "end", 2023, 4), ("2024-01-05", "1231", "end", 2023, 4), ("2023-05-01", "0229", "end", None, None), ("2023-05-01", "abc", "end", None, None)],
)
def test_fiscal_calendar(spark, day, code, convention, year, quarter):
    got = spark.range(1).select(P.fiscal_year_of(d(day), F.lit(code), convention).alias("y"), P.fiscal_quarter_of(d(day), F.lit(code), convention).alias("q")).first()
    if year is None:
        # A leap-day code has no year end in a common year; only a leap year gives one.
        assert got["y"] in (None, 2024)
    else:
        assert (got["y"], got["q"]) == (year, quarter)


def test_fiscal_year_end_on_a_weekday(spark):
    assert one(spark, P.fiscal_year_end(F.lit(2024), F.lit("0930"), "end", F.lit(5))) == dt.date(2024, 9, 28)
    assert one(spark, P.fiscal_year_end(F.lit(2023), F.lit("0229"))) is None


def test_periods(spark):
    p = F.lit("2024-01-01 to 2024-03-31")
    assert one(spark, P.duration_days(p)) == 90
    assert one(spark, P.duration_days(F.lit("2024-03-31"))) is None
    assert one(spark, P.period_key(p)) == "2024-03-31"
    assert one(spark, P.period_start(F.lit("x to y"))) is None
    assert one(spark, P.period_type(F.lit(" Q3"))) == "quarterly"
    assert one(spark, P.valid_dates(d("2024-01-01"), d("2026-01-01"), d("2024-06-01"))) is False


@pytest.mark.parametrize(("text", "value"), [("(1,234)", -1234.0), ("$ 5.5", 5.5), ("abc", None), ("", None), ("-3", -3.0)])
def test_number_of(spark, text, value):
    assert one(spark, T.number_of(F.lit(text))) == value


def test_number_tokens_hyphen_is_no_minus(spark):
    assert one(spark, T.number_tokens(F.lit("$61-64 billion"))) == [61.0, 64.0]


@pytest.mark.parametrize(("label", "clean"), [("Revenue  [Abstract]", "Revenue"), ("Family of Apps Segment [Member]", "Family of Apps"), ("Reportable Segment [Member]", "Reportable Segment"), ("[Member]", "[Member]"), ("Net sales", "Net sales")])
def test_clean_label_is_idempotent(spark, label, clean):
    assert one(spark, T.clean_label(F.lit(label))) == clean
    assert one(spark, T.clean_label(T.clean_label(F.lit(label)))) == clean


def test_signature_ignores_order_and_wrappers(spark):
    a = F.create_map(F.lit("us-gaap:StatementBusinessSegmentsAxis"), F.lit("meta:FamilyOfAppsMember"), F.lit("srt:ProductOrServiceAxis"), F.lit("x:Ads"))
    b = F.create_map(F.lit("srt:ProductOrServiceAxis"), F.lit(" X:ads "), F.lit("x:explicitMember"), F.lit("y"), F.lit("us-gaap:StatementBusinessSegmentsAxis"), F.lit("meta:FamilyOfAppsMember"))
    left, right = one(spark, T.dimension_signature(a)), one(spark, T.dimension_signature(b))
    assert left == right == "productorservice=x:ads|statementbusinesssegments=meta:familyofappsmember"
    assert one(spark, T.dimension_signature(F.lit(None).cast("map<string,string>"))) == ""


def test_arithmetic_refuses_everything_else():
    assert arithmetic.value_of("(1,000 + 2) * -3") == -3006.0
    for bad in ("__import__('os')", "2 ** 9", "a + 1", "1 / 0", "", None):
        assert arithmetic.value_of(bad) is None


YTD = "cik string, concept string, fiscal_year int, quarter int, value bigint, calculated boolean"


def test_deaccumulate(spark):
    rows = [("1", "ocf", 2024, q, v, False) for q, v in ((1, 4965), (2, 7414), (3, 8405))]
    rows += [("1", "capex", 2024, q, v, False) for q, v in ((1, -549), (2, -1082), (3, -1578))]
    rows += [("2", "ocf", 2024, 1, 100, True), ("2", "ocf", 2024, 2, 50, True), ("2", "ocf", 2024, 3, 225, False)]  # stored single quarters
    rows += [("3", "ocf", 2024, 3, 70, False)]  # no predecessor at all
    rows += [("1", "late", 2024, 2, 30, False)]  # absent from an existing quarter: zero
    out = {(r["cik"], r["concept"], r["quarter"]): r["quarter_value"] for r in quarters.deaccumulate(spark.createDataFrame(rows, YTD), ["cik", "concept"]).collect()}
    assert [out["1", "ocf", q] for q in (1, 2, 3)] == [4965, 2449, 991]
    assert [out["1", "capex", q] for q in (1, 2, 3)] == [-549, -533, -496]
    assert out["2", "ocf", 3] == 75
    assert ("3", "ocf", 3) not in out
    assert out["1", "late", 2] == 30


def test_fourth_quarters(spark):
    keys = ["concept", "statement_type"]
    annual = spark.createDataFrame([("Revenue", "income", 1000), ("WeightedAverageNumberOfShares", "income", 320), ("Assets", "balancesheet", 5000), ("Cost", "income", 9)], "concept string, statement_type string, value bigint")
    q = [(c, s, k, v) for c, s, vs in (("Revenue", "income", (200, 250, 260)), ("WeightedAverageNumberOfShares", "income", (322, 321, 320)), ("Assets", "balancesheet", (1, 2, 3))) for k, v in enumerate(vs, 1)]
    q += [("Cost", "income", 1, 2), ("Cost", "income", 2, 2)]
    out = quarters.fourth_quarters(annual, spark.createDataFrame(q, "concept string, statement_type string, quarter int, value bigint"), keys)
    assert {r["concept"]: r["q4_value"] for r in out.collect()} == {"Revenue": 290, "WeightedAverageNumberOfShares": 320, "Assets": 5000}


def test_gaps_and_jumps(spark):
    v = spark.createDataFrame([("a", "x", "2022", 100e6), ("a", "x", "2024", 1e5), ("a", "y", "2023", 1.0), ("a", "x", "2025", 1.2e8)], "cik string, concept string, period string, value double")
    assert [tuple(r) for r in series.interior_gaps(v, ["cik"], ["cik", "concept"]).collect()] == [("a", "x", "2023")]
    assert series.interior_gaps(v, ["cik"], ["cik", "concept"], edges=True).count() == 4
    assert {r["period"] for r in series.scale_jumps(v, ["cik", "concept"]).collect()} == {"2024", "2025"}


def test_upsert_twice_is_once(spark):
    schema = "cik string, q int, value double"
    stored = spark.createDataFrame([("a", 1, 10.0), ("a", None, 5.0), ("b", 1, 7.0)], schema)
    batch = spark.createDataFrame([("a", 1, 20.0), ("a", None, 5.5), ("c", 1, 1.0)], schema)
    first = merge.upsert_values(stored, batch, ["cik", "q"])
    got = {(r["cik"], r["q"]): (r["value"], r["corrected_from"], r["action"]) for r in first.collect()}
    assert got == {("a", 1): (20.0, 10.0, "update"), ("a", None): (5.5, None, "update"), ("b", 1): (7.0, None, "keep"), ("c", 1): (1.0, None, "insert")}
    again = merge.upsert_values(first.select("cik", "q", "value"), batch, ["cik", "q"]).select("cik", "q", "value")
    assert sorted(map(tuple, again.fillna(0).collect())) == sorted(map(tuple, first.select("cik", "q", "value").fillna(0).collect()))


def test_promote_keeps_the_winner(spark):
    v = spark.createDataFrame([("1", "old", "2023", 1), ("1", "new", "2023", 2), ("1", "old", "2022", 3)], "cik string, concept string, period string, value int")
    kept, receipt = merge.promote(v, spark.createDataFrame([("1", "old", "new")], "cik string, loser string, winner string"), ["period"])
    assert {(r["period"], r["value"]) for r in kept.collect()} == {("2023", 2), ("2022", 3)}
    assert tuple(receipt.select("moved", "dropped").first()) == (1, 1)


LINES = "filing string, statement_type string, position int, concept string, label string, value double, abstract boolean"


def lines(spark, statement, *pairs):
    return spark.createDataFrame([("f", statement, k, f"us-gaap:{c}", None, float(v), False) for k, (c, v) in enumerate(pairs)], LINES)


def test_subtotals(spark):
    income = lines(spark, "income", ("Revenues", 1000), ("CostOfRevenue", 400), ("SellingGeneralAndAdministrativeExpense", 100), ("ResearchAndDevelopmentExpense", 50), ("OperatingIncomeLoss", 450))
    assert {r["concept"]: r["value"] for r in derive.income_subtotals(income, ["filing"]).collect()} == {"us-gaap:GrossProfit": 600.0, "us-gaap:OperatingExpenses": 150.0}
    balance = lines(spark, "balancesheet", ("AssetsCurrent", 6000), ("PropertyPlantAndEquipmentNet", 3000), ("OperatingLeaseRightOfUseAsset", 1000), ("Assets", 10000), ("LiabilitiesCurrent", 2500), ("LongTermDebtNoncurrent", 2000), ("OperatingLeaseLiabilityNoncurrent", 1500), ("StockholdersEquity", 4000), ("LiabilitiesAndStockholdersEquity", 10000))
    assert {r["concept"]: r["value"] for r in derive.balance_subtotals(balance, ["filing"]).collect()} == {"us-gaap:Liabilities": 6000.0, "us-gaap:AssetsNoncurrent": 4000.0, "us-gaap:LiabilitiesNoncurrent": 3500.0}


def test_math_mismatch(spark):
    good = lines(spark, "income", ("Revenues", 1e6), ("CostOfRevenue", 4e5), ("GrossProfit", 6e5))
    assert validate.check_math(good, ["filing"]).count() == 0
    assert validate.check_math(lines(spark, "income", ("Revenues", 1e6), ("CostOfRevenue", -4e5), ("GrossProfit", 6e5)), ["filing"]).count() == 0
    bad = validate.check_math(lines(spark, "income", ("Revenues", 1e6), ("CostOfRevenue", 4e5), ("GrossProfit", 999999)), ["filing"]).first()
    assert (bad["type"], bad["severity"], bad["evidence"]["identity"]) == ("math_mismatch", "high", "gross_profit")


def test_ceiling_and_policy(spark):
    st = spark.createDataFrame([("f", "income"), ("f", "cashflow"), ("g", "income")], "filing string, statement_type string")
    fs = spark.createDataFrame([("f", "income", "math_mismatch", "high", None), ("f", "cashflow", "math_mismatch", "high", "us-gaap:X"), ("g", "income", "duplicate_concept", "high", None)], "filing string, statement_type string, type string, severity string, concept string")
    c = {(r["filing"], r["statement_type"]): (r["permitted"], r["drop_concepts"]) for r in decide.write_ceiling(st, fs, ["filing"]).collect()}
    assert c == {("f", "income"): (False, []), ("f", "cashflow"): (True, ["us-gaap:X"]), ("g", "income"): (True, [])}
    strict = {r["filing"]: r["action"] for r in decide.policy(decide.write_ceiling(st, fs, ["filing"]), fs, ["filing"]).collect()}
    assert strict == {"f": "skip", "g": "write"}
    loose = {r["filing"]: r["statements"] for r in decide.policy(decide.write_ceiling(st, fs, ["filing"]), fs, ["filing"], strict=False).collect()}
    assert loose["f"] == ["cashflow"]


@pytest.mark.parametrize(
    ("concept", "statement", "value", "shown"),
    [("us-gaap:PaymentsToAcquireBusinesses", "cash_flow", 5, -5), ("us-gaap:IncreaseDecreaseInAccountsReceivable", "cash_flow", 5, -5), ("us-gaap:IncreaseDecreaseInAccountsPayable", "cash_flow", -5, -5), ("us-gaap:ShareBasedCompensation", "cash_flow", -5, 5), ("us-gaap:AccumulatedDepreciation", "balance_sheet", 5, -5), ("us-gaap:AccountsReceivableNetCurrent", "balance_sheet", -5, 5), ("us-gaap:RetainedEarningsAccumulatedDeficit", "balance_sheet", -5, -5), ("us-gaap:CostOfRevenue", "income", 5, 5)],
)
def test_signs(spark, concept, statement, value, shown):
    none = F.lit(None)
    assert one(spark, signs.presented(F.lit(value), F.lit(concept), F.lit(statement), none.cast("string"), none.cast("double"), none.cast("string"), none.cast("int"))) == shown


def test_sign_of_the_table_wins(spark):
    assert one(spark, signs.presented(F.lit(5), F.lit("x:ProceedsFromX"), F.lit("cash_flow"), F.lit(None).cast("string"), F.lit(None).cast("double"), F.lit("negatedLabel"), F.lit(1))) == 5


@pytest.mark.parametrize(
    ("member", "label", "dropped"),
    [
        ("us-gaap:ForeignExchangeContractMember", "Foreign Exchange Contract", True), ("co:ForeignExchangeContractMember", "Foreign Exchange Contract", False), ("us-gaap:InterestRateContractMember", "x", True),
        ("us-gaap:LifeInsuranceSegmentMember", "Life Insurance", False), ("co:AMember", "Change in Estimate", True), ("co:AMember", "Exchange rates", False), ("nflx:ReportableSegmentMember", "Reportable Segment", True),
        ("srt:AllSegmentsMember", "All", True), ("srt:MaterialReconcilingItemsMember", "x", True), ("AccumulatedOtherComprehensiveIncomeMember", "x", True),
    ],
)
def test_context_filter(spark, member, label, dropped):
    details = F.create_map(F.lit("a"), F.struct(F.lit("srt:ProductOrServiceAxis").alias("axis_qname"), F.lit(member).alias("member_qname"), F.lit(label).alias("member_label")))
    assert one(spark, select.excluded_fact(F.create_map(F.lit("srt:ProductOrServiceAxis"), F.lit(member)), details)) is dropped
    assert len(select.EXCLUDED_MEMBERS) == 39


@pytest.mark.parametrize(
    ("label", "clean"),
    [
        ("Rest Of World [Member]", "Rest Of World"), ("Geographic Segment [Member]", "Geographic Segment"), ("Products Segment [Member]", "Products Segment"), ("Cloud Segment [Member]", "Cloud"), ("Operating Segments [Member]", "Operating Segments"),
        ("Debt [Text Block]", "Debt"), ("Debt [Policy Text Block]", "Debt"), ("Debt [Line Item]", "Debt"), ("Debt [Roll Forward Rules]", "Debt"), ("[Member]", "[Member]"), ("Debt [Note]", "Debt [Note]"), ("  Two   words ", "Two words"), ("", ""), (None, None),
    ],
)
def test_clean_label(spark, label, clean):
    from factlake.functions.text import clean_label

    assert one(spark, clean_label(F.lit(label).cast("string"))) == clean
    assert one(spark, clean_label(clean_label(F.lit(label).cast("string")))) == clean


def test_cascade(spark):
    stored = spark.createDataFrame([("a", 1, "us-gaap:Revenues", ["x:Sales"], "Sales", "001"), ("a", 2, "us-gaap:Goodwill", [], "Goodwill [Member]", "001.002"), ("a", 3, "us-gaap:Cash", [], "Cash", "404.001")], "cik string, id int, concept string, aliases array<string>, label string, path string")
    wanted = spark.createDataFrame([("a", c, n) for c, n in (("us-gaap:Revenues", "z"), ("x:Sales", "z"), ("us-gaap:SalesRevenueNet", "z"), ("x:G", "goodwill"), ("us-gaap:Cash", "q"))], "cik string, concept string, label string")
    out = {r["concept"]: (r["id"], r["how"]) for r in lookups.resolve_cascade(wanted, stored, canonical.class_table(spark), ["cik"]).collect()}
    assert out == {"us-gaap:Revenues": (1, "exact"), "x:Sales": (1, "alias"), "us-gaap:SalesRevenueNet": (1, "class"), "x:G": (2, "label"), "us-gaap:Cash": (None, None)}


def test_tree(spark):
    nodes = spark.createDataFrame([("a", None, 0), ("b", "a", 1), ("c", "a", 2), ("d", "c", 3)], "id string, parent string, position int")
    assert {r["id"]: r["path"] for r in hierarchy.tree_paths(nodes, []).collect()} == {"a": "001", "b": "001.001", "c": "001.002", "d": "001.002.001"}
    assert [one(spark, hierarchy.letters(F.lit(k))) for k in (0, 25, 26, 51, 52)] == ["a", "z", "aa", "az", "ba"]


def test_guidance(spark):
    b = one(spark, guidance.band(F.lit("range"), F.lit(None).cast("double"), F.lit(4.7), F.lit(4.9), F.lit(None).cast("double"), F.lit(None).cast("string")))
    assert (b["low"], round(b["mid"], 6), b["high"]) == (4.7, 4.8, 4.9)
    assert one(spark, guidance.multiplier(F.lit("billions"), F.lit("Revenue"), F.lit("USD"))) * 108 == 108e9
    assert one(spark, guidance.multiplier(F.lit("billions"), F.lit("EPS"), F.lit("USD"))) == 1.0
    assert one(spark, guidance.is_future(F.lit(2023), F.lit(None).cast("int"), F.lit(2024), F.lit(None).cast("int"))) is False
    assert one(spark, guidance.is_future(F.lit(2024), F.lit(None).cast("int"), F.lit(2024), F.lit(2))) is True
    assert one(spark, guidance.score(F.lit(5.0), F.lit(None).cast("double"), F.lit(4.0), F.lit("Revenue"))) == "beat"


def test_html(spark):
    html = "<html><script>var a='<p>';</script><p>One &amp; two</p><table><tr><td>Total assets</td><td>(1,234)</td></tr></table></html>"
    pages = spark.createDataFrame([(1, html), (2, None)], "page_id int, html string")
    assert [r["line"] for r in documents.html_lines(pages, "page_id", "html").orderBy("line_no").collect()] == ["One & two", "Total assets(1,234)"]
    cells = documents.html_tables(pages, "page_id", "html")
    assert [(r["cell"], r["value"], r["sign"]) for r in cells.orderBy("col_no").collect()] == [("Total assets", None, None), ("(1,234)", -1234.0, -1)]
    assert documents.statement_vote(cells, ["page_id"]).first()["statement"] == "balancesheet"


def test_letters_of_any_rank(spark):
    from factlake.operators import hierarchy

    ranks = [0, 25, 26, 701, 702, 1999, 18277, 18278, 2**31, 2**62]
    got = spark.createDataFrame([(r,) for r in ranks], "r bigint").select("r", hierarchy.letters(F.col("r")).alias("k"), hierarchy.letters_rank(hierarchy.letters(F.col("r"))).alias("back")).collect()

    def key(n):
        out, n = "", n + 1
        while n:
            n, d = divmod(n - 1, 26)
            out = chr(97 + d) + out
        return out

    assert {r["r"]: r["k"] for r in got} == {r: key(r) for r in ranks}
    assert all(r["r"] == r["back"] for r in got)
    assert one(spark, hierarchy.letters(F.lit(-1))) is None
    assert one(spark, hierarchy.letters_rank(F.lit("a1"))) == -1


@pytest.mark.parametrize(("left", "right", "key"), [(None, None, "a"), (None, "d", "b"), (None, "a", "0n"), ("b", None, "c"), ("z", None, "aa"), ("a1", None, "a1n"), ("a", "c", "b"), ("a", "b", "an"), ("ab", "ad", "ac"), ("an", "ao", "ann")])
def test_keys_between(spark, left, right, key):
    from factlake.operators import hierarchy

    assert one(spark, hierarchy.key_between(F.lit(left).cast("string"), F.lit(right).cast("string"))) == key


def test_trees_beyond_a_million_rows(spark):
    from factlake.operators import hierarchy

    n = 1_200_000
    i = F.col("id")
    nodes = spark.range(n).select(i.alias("id"), F.when(i >= 1000, F.floor(i / 1000) - 1).alias("parent"), i.alias("position"))
    got = hierarchy.tree_paths(nodes, []).groupBy("level").agg(F.count("*").alias("n"), F.count_distinct("path").alias("paths")).collect()
    assert sum(r["n"] for r in got) == n
    assert {r["level"]: r["n"] for r in got}[0] == 1000


def test_deep_trees_and_rings(spark):
    from factlake.operators import hierarchy

    rows = [(k, k - 1 if k else None, k) for k in range(60)] + [(100, 101, 0), (101, 100, 0)]
    got = hierarchy.tree_paths(spark.createDataFrame(rows, "id bigint, parent bigint, position bigint"), []).collect()
    assert len(got) == 60 and max(r["level"] for r in got) == 59


def test_statement_totals_become_parents(spark):
    from factlake.operators import statements

    rows = [
        ("f", 1, None, 0, "us-gaap:AssetsCurrentAbstract", None, True, 0, None), ("f", 2, 1, 0, "us-gaap:Cash", 1.0, False, 0, None), ("f", 3, 1, 1, "us-gaap:AssetsCurrent", 2.0, False, 0, None),
        ("g", 1, None, 0, "co:Ring", 1.0, False, 0, None), ("g", 2, 3, 0, "co:A", 1.0, False, 0, None), ("g", 3, 2, 0, "co:B", 1.0, False, 0, None),
    ]
    nodes = spark.createDataFrame(rows, "k string, id int, parent_id int, position int, concept string, value double, abstract boolean, facts int, role string")
    got = {(r["k"], r["concept"]): (r["parent"], r["level"]) for r in statements.flat_rows(nodes, ["k"]).collect()}
    assert got == {("f", "us-gaap:Cash"): ("us-gaap:AssetsCurrent", 1), ("f", "us-gaap:AssetsCurrent"): (None, 0), ("g", "co:Ring"): (None, 0)}
    assert statements.flat_rows(nodes.filter("false"), ["k"]).count() == 0


def test_guidance_of_one_bound_has_a_result(spark):
    from factlake.operators import guidance

    lit = lambda v: F.lit(v).cast("double")
    r = one(spark, guidance.result(lit(5.0), lit(4.0), lit(3.0), lit(None), F.lit("range"), F.lit("Revenue")))
    assert (r["outcome"], r["delta_abs"], r["delta_pct"]) == ("inline", 1.0, 25.0)
    assert one(spark, guidance.result(lit(5.0), lit(4.0), lit(None), lit(None), F.lit("point"), F.lit("Operating expense")))["outcome"] == "miss"
    assert one(spark, guidance.result(lit(5.0), lit(0.0), lit(None), lit(None), F.lit("min"), F.lit("Revenue")))["delta_pct"] is None


def test_long_arithmetic(spark):
    from factlake.functions.arithmetic import value_of

    assert value_of("+".join(["1"] * 900)) == 900.0
    assert value_of("1" + "+1" * 20_000) in (20_001.0, None)


def test_parents_by_level(spark):
    rows = spark.createDataFrame([("a", 1, 0), ("a", 2, 1), ("a", 3, 2), ("a", 4, 1), ("a", 5, None), ("a", 6, 2), ("a", 7, 5), (None, 1, 0), (None, 2, 1)], "k string, position int, level int")
    got = {(r["k"], r["position"]): r["parent_position"] for r in hierarchy.parents_by_level(rows, ["k"]).collect()}
    assert got == {("a", 1): None, ("a", 2): 1, ("a", 3): 2, ("a", 4): 1, ("a", 5): None, ("a", 6): 4, ("a", 7): None, (None, 1): None, (None, 2): 1}
    assert hierarchy.parents_by_level(rows.filter("false"), ["k"]).count() == 0
