"""Presentation signs: one ordered expression per statement."""

from __future__ import annotations

from dataclasses import dataclass
from dataclasses import fields as dataclass_fields
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import periods as P
from ..functions import text as T
from ..functions.text import local_name

# --- fixed values -----------------------------------------------------------
OUTFLOWS = (
    "payments", "payment", "purchase", "acquisition", "repayment", "repaid", "redemption", "decrease", "reduction", "used", "dividends",
    "distribution", "purchaseof", "additionsto", "acquisitionof", "repurchase", "treasurystock", "stockrepurchased",
)
INFLOWS = (
    "proceeds", "received", "receipt", "collection", "increase", "addition", "issuance", "sale", "disposal", "divestiture", "borrowing",
    "debtissuance", "stockissuance",
)
CONTRA = (
    "accumulateddepreciation", "accumulatedamortization", "reserve", "impairment", "valuation", "treasurystock", "discount",
    "deferredcompensation", "unamortizeddebt", "debtdiscount",
)
OPERATING_ASSETS = ("receivable", "inventor", "operatingasset", "prepaid", "contractwithcustomerasset", "contractasset", "otherasset")
OPERATING_LIABILITIES = ("payable", "liabilit", "accrued")
NET_LABELS = ("after allowance", "net of allowance", "less allowance", "after accumulated depreciation")
KEEP_BALANCE = ("accumulatedothercomprehensive", "retainedearnings", "deficit")


def _any(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, (text.contains(w) for w in words))


@dataclass(frozen=True)
class Names:
    """What the rules look at: the local name, the concept without separators, the concept, concept and label together, the label, and the statement, all in lower case."""

    low: Column
    flat: Column
    whole: Column
    text: Column
    label: Column
    kind: Column

    @classmethod
    def of(cls, concept: Column, label: Column, statement: Column) -> Names:
        return cls(
            F.lower(local_name(concept)), F.regexp_replace(F.lower(concept), "[-_:]", ""), F.lower(concept), F.lower(F.concat_ws(" ", concept, F.coalesce(label, F.lit("")))), F.lower(F.coalesce(label, F.lit(""))),
            F.lower(F.coalesce(statement, F.lit(""))),
        )


def _asset_change(low: Column) -> Column:
    return low.startswith("increasedecrease") & ~_any(low, OPERATING_LIABILITIES) & _any(low, OPERATING_ASSETS)


def operating_asset_change(concept: Column) -> Column:
    return _asset_change(F.lower(local_name(concept)))


def _cash(value: Column, n: Names, weight: Column) -> Column:
    plus = F.coalesce(weight == 1.0, F.lit(False))
    minus = F.coalesce(weight == -1.0, F.lit(False))
    down = -F.abs(value)
    return (
        F.when(n.low.contains("sharebasedcompensation"), F.abs(value))
        .when(_asset_change(n.low), -value)
        .when(_any(n.low, ("paymentsforproceedsfromotherinvestingactivities", "othernoncashincomeexpense")), F.when(plus, F.abs(value)).otherwise(down))
        .when(minus & (value > 0) & ~_any(n.low, ("increasedecrease", "netcash", "netchange")), down)
        .when(_any(n.flat, ("increasedecrease", "proceedsfrompayments", "proceedsfromsale")), value)
        .when(n.flat.contains("maturit") & n.flat.contains("proceed"), F.abs(value))
        .when(_any(n.whole, ("netcash", "netchange", "total")) | (value < 0), value)
        .when(_any(n.flat, ("equitymethodinvestmentdividends", "incurredbutnotyetpaid", "noncash")), value)
        .when(_any(n.text, OUTFLOWS), down)
        .when(_any(n.text, INFLOWS), F.abs(value))
        .otherwise(value)
    )


def _balance(value: Column, n: Names) -> Column:
    allowance = n.low.contains("allowance")
    asset = n.low.contains("receivable") | n.label.contains("receivable") | _any(n.label, NET_LABELS) | _any(n.low, ("afteraccumulateddepreciation", "netofaccumulateddepreciation"))
    itself = allowance & ~_any(n.low, ("netcurrent", "grosscurrent", "nontrade", "accountsnotes"))
    contra = (allowance & ~_any(n.low, ("netcurrent", "grosscurrent"))) | _any(n.low, CONTRA)
    return F.when(asset & ~itself, F.abs(value)).when(_any(n.low, KEEP_BALANCE), value).when(contra, -F.abs(value)).otherwise(F.abs(value))


def _presented(value: Column, n: Names, weight: Column, role: Column, shown_sign: Column) -> Column:
    rules = (
        F.when(_any(n.kind, ("cash", "flow")), _cash(value, n, weight))
        .when(_any(n.kind, ("balance", "position")), _balance(value, n))
        .when(_any(n.kind, ("income", "operations")), value)
        .when(_any(n.kind, ("equity", "stockholder")), F.abs(value))
        .otherwise(value)
    )
    negated = F.coalesce(F.lower(role).contains("negated"), F.lit(False))
    return F.when(value.isNull() | (value == 0), value).when(shown_sign.isin(-1, 1), shown_sign * F.abs(value)).when(negated, -value).otherwise(rules)


def presented(value: Column, concept: Column, statement: Column, label: Column, weight: Column, role: Column, shown_sign: Column) -> Column:
    """Value as the filing shows it.

    The sign seen in the rendered table wins, then a negated label role, then
    the rules of the statement; zero and NULL stay.
    """
    return _presented(value, Names.of(concept, label, statement), weight, role, shown_sign)


def with_presented(rows: DataFrame, name: str, value: Column, concept: Column, statement: Column, label: Column, weight: Column, role: Column, shown_sign: Column) -> DataFrame:
    """Adds ``name``: as ``presented``, with the names in columns of their own, so that each row makes them once and not in every rule."""
    rows = rows.withColumns({"_concept": concept, "_label": label, "_statement": statement})
    made = Names.of(F.col("_concept"), F.col("_label"), F.col("_statement"))
    fields = [f.name for f in dataclass_fields(Names)]
    rows = rows.withColumns({f"_n_{f}": getattr(made, f) for f in fields})
    n = Names(*[F.col(f"_n_{f}") for f in fields])
    return rows.withColumn(name, _presented(value, n, weight, role, shown_sign)).drop("_concept", "_label", "_statement", *[f"_n_{f}" for f in fields])


def transformed(items: DataFrame, as_of: Column) -> DataFrame:
    """Line items (concept, statement_type, label, value, unit, weight, role, html_sign, period, facts) as they are shown.

    Units are standard, the value before the sign rules is kept as
    original_value, nested facts (structs with concept, label, value and sign)
    follow the item's rules, and odd period dates are marked.
    """
    def shown(value: Column, concept: Column, label: Column, html: Column) -> Column:
        return presented(value, concept, F.col("statement_type"), label, F.col("weight"), F.col("role"), html)

    facts = F.transform("facts", lambda f: F.struct(f["concept"].alias("concept"), f["label"].alias("label"), shown(f["value"], F.coalesce(f["concept"], F.col("concept")), F.coalesce(f["label"], F.col("label")), F.coalesce(f["sign"], F.col("html_sign"))).alias("value"), f["sign"].alias("sign")))
    start, end = P.period_start(F.col("period")), P.period_end(F.col("period"))
    odd = F.coalesce(start.isNotNull() & end.isNotNull() & ~P.valid_dates(start, end, as_of), F.lit(False))
    out = items.withColumns({"original_value": F.col("value"), "unit": F.when(F.col("value").isNotNull(), T.standard_unit(F.col("unit"))).otherwise(F.col("unit")), "facts": facts, "period_warning": odd})
    out = with_presented(out, "_shown", F.col("original_value"), F.col("concept"), F.col("statement_type"), F.col("label"), F.col("weight"), F.col("role"), F.col("html_sign"))
    return out.withColumn("value", F.col("_shown")).drop("_shown")
