"""Scales of inline facts, recovered presentation lines, statements that lack their markers."""

from factlake.operators import documents, validate

HTML = """<table><tr><td>Total assets</td><td>$ <ix:nonFraction name="a" scale="6">1,234</ix:nonFraction></td><td>(<ix:nonFraction scale="3">5</ix:nonFraction><ix:nonFraction scale="9"></ix:nonFraction>)</td>
<td><ix:nonFraction scale="-2">50</ix:nonFraction></td><td><ix:nonFraction scale="x">7</ix:nonFraction></td><td>8</td></tr></table>"""


def test_inline_scale(spark):
    df = documents.html_tables(spark.createDataFrame([(1, HTML), (2, "<table><tr><td>9</td></tr></table>"), (3, None)], "id int, html string"), "id", "html")
    assert df.columns == ["id", "table_no", "row_no", "col_no", "cell", "value", "sign"]
    assert [r["value"] for r in df.orderBy("id", "col_no").collect()] == [None, 1_234_000_000.0, -5000.0, 0.5, 7.0, 8.0, 9.0]


def test_recovered(spark):
    schema = "f int, concept string, value double, parent string"
    bundle = spark.createDataFrame([(1, "A", -5.0, None), (1, "B", 0.0, "own"), (1, "C", None, ""), (1, "X", 3.0, None)], schema)
    shown = spark.createDataFrame([(1, "A", 7.0, "p"), (1, "B", 2.0, "p"), (1, "C", 4.0, "p"), (1, "D", 1.0, "p"), (1, "E", None, "p")], schema)
    got = sorted((tuple(r)[1:] for r in validate.recovered(bundle, shown, ["f"]).collect()), key=str)
    assert got == sorted([("A", 5.0, "p", "bundle"), ("B", 0.0, "own", "bundle"), ("C", None, "p", "bundle"), ("C", 4.0, "p", "presentation"), ("D", 1.0, "p", "presentation"), ("X", 3.0, None, "bundle")], key=str)


def test_classification(spark):
    rows = [(1, "income", "us-gaap:Tax", 1.0), (2, "income", "us-gaap:GrossProfit", None), (3, "income", "us-gaap:GrossProfit", 1.0), (4, "cashflow", "x", 1.0), (6, "equity", "x", None), (7, "balance_sheet", "us-gaap:AssetsCurrent", 1.0)] + [(5, "balancesheet", f"x{i}", None) for i in range(25)]
    got = validate.classification(spark.createDataFrame(rows, "f int, statement_type string, concept string, value double"), ["f"])
    assert {r["f"]: r["valid"] for r in got.collect()} == {1: False, 2: False, 3: True, 4: False, 5: True, 6: True, 7: True}
