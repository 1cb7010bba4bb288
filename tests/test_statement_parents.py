"""Parents by calculation arcs and by the place between section totals."""

from factlake.operators import hierarchy

ROWS = "st string, statement_type string, concept string, position int, parent string, section string"


def parents(df):
    return {(r["st"], r["concept"]): r["parent"] for r in df.collect()}


def test_calculation_parents(spark):
    rows = [
        ("b", "balance_sheet", "x:A", 0, "x:Old", None), ("b", "balance_sheet", "x:T", 1, None, None), ("b", "balance_sheet", "x:N", 2, "x:Old", None),
        ("i", "income", "x:R", 0, "x:Old", "s"), ("i", "income", "x:U", 1, "x:Old", "s"), ("i", "income", "x:P", 2, None, "s"), ("i", "income", "x:Q", 3, None, "s"), ("i", "income", "x:V", 4, "x:Old", "s"), ("i", "income", "x:W", 5, "x:Old", "s"),
        ("i", "income", "x:CostsAndExpenses", 6, None, "s"), ("i", "income", "x:Y", 7, "x:Old", "s"), ("i", "income", "x:Z", 8, "x:Old", "other"),
        ("c", "cashflow", "x:D", 0, "x:Old", None), ("c", "cashflow", "x:NetCashProvidedByUsedInOperatingActivities", 1, "x:Old", None), ("c", "cashflow", "x:E", 2, "x:Old", None),
        ("o", "equity", "x:A", 0, "x:Old", None), ("o", "equity", "x:T", 1, None, None),
    ]
    arcs = [
        ("b", "x:Gone", "x:A", 1.0, 0), ("b", "x:T", "x:A", -1.0, 1), ("i", "x:P", "x:R", 1.0, 0), ("i", "x:P", "x:U", None, 1), ("i", "x:P", "x:Z", 1.0, 2), ("i", "x:P", "x:Gone", -1.0, 3),
        ("i", "x:Q", "x:V", 1.0, 0), ("i", "x:Q", "x:W", -1.0, 1), ("i", "x:CostsAndExpenses", "x:Y", 1.0, 0), ("c", "x:NetCashProvidedByUsedInOperatingActivities", "x:D", 1.0, 0), ("c", "x:D", "x:E", 1.0, 0), ("o", "x:T", "x:A", 1.0, 0),
    ]
    got = parents(hierarchy.calculation_parents(spark.createDataFrame(rows, ROWS), spark.createDataFrame(arcs, "st string, parent string, concept string, weight double, position int"), ["st"]))
    assert len(got) == len(rows)
    changed = {("b", "x:A"): "x:T", ("b", "x:N"): "x:Old", ("i", "x:R"): "x:P", ("i", "x:U"): "x:P", ("c", "x:D"): "x:NetCashProvidedByUsedInOperatingActivities", ("c", "x:E"): "x:Old", ("o", "x:A"): "x:Old"}
    assert {k: v for k, v in got.items() if v} == changed


def test_section_parents(spark):
    rows = [("a", "balance", "us-gaap:Cash", 0, None, None), ("a", "balance", "ifrs-full:EquityAndLiabilities", 1, None, None), ("a", "balance", "us-gaap:After", 2, None, None)]
    rows += [("k", "cash_flow", f"x:{c}", n, p, None) for n, (c, p) in enumerate([("Gain", None), ("CashFlowsFromUsedInOperatingActivities", None), ("Kept", "x:Gain"), ("Loan", None), ("IncomeTaxesPaid", None), ("CashFlowsFromUsedInInvestingActivities", None), ("Tail", None)])]
    rows.append(("i", "income", "x:R", 0, None, None))
    got = parents(hierarchy.section_parents(spark.createDataFrame(rows, ROWS), ["st"]))
    assert len(got) == len(rows)
    assert {k: v for k, v in got.items() if v} == {
        ("a", "us-gaap:Cash"): "ifrs-full:EquityAndLiabilities", ("k", "x:Gain"): "x:CashFlowsFromUsedInOperatingActivities", ("k", "x:Kept"): "x:Gain", ("k", "x:Loan"): "x:CashFlowsFromUsedInInvestingActivities",
    }
