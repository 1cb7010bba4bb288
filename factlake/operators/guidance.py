"""Forward guidance: periods, bands, scales, scores, supersession."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
SCALES = {"thousands": 1e3, "thousand": 1e3, "millions": 1e6, "million": 1e6, "billions": 1e9, "billion": 1e9}
LARGEST = 1e16
MOST_RECORDS = 15
LOWER_IS_BETTER = r"(?i)(expense|cost|tax rate|capex|capital expenditure|debt)"
UNSCALED = r"(?i)(ratio|per[ _-]?share|eps|percent|%|margin|rate)"


def default_period(fy: Column, q: Column, filing_fy: Column, filing_q: Column, kind: Column) -> Column:
    """struct(fiscal_year, quarter) of guidance whose period isn't said in full: the next quarter, or the next year for annual guidance."""
    next_year = F.when(filing_q.isNull() | (filing_q == 4), filing_fy + 1).otherwise(filing_fy)
    next_quarter = F.when(filing_q.isNull() | (filing_q == 4), F.lit(1)).otherwise(filing_q + 1)
    annual = kind == "annual"
    year = F.coalesce(fy, next_year)
    quarter = F.when(~annual, F.coalesce(q, next_quarter))
    return F.struct(year.cast("bigint").alias("fiscal_year"), quarter.cast("bigint").alias("quarter"))


def period_ordinal(fy: Column, q: Column) -> Column:
    """Quarters since year 0 at the period's end; a year ends with its fourth quarter."""
    return fy * 4 + F.coalesce(q, F.lit(4))


def is_future(fy: Column, q: Column, filing_fy: Column, filing_q: Column) -> Column:
    """After the filing's period; the same year counts for annual guidance in a quarterly filing."""
    return F.when(q.isNull() & (fy == filing_fy), filing_q.isNotNull()).otherwise(period_ordinal(fy, q) > period_ordinal(filing_fy, filing_q))


def arrived(fy: Column, q: Column, filing_fy: Column, filing_q: Column) -> Column:
    return period_ordinal(fy, q) <= period_ordinal(filing_fy, filing_q)


def band(form: Column, value: Column, low: Column, high: Column, plus_minus: Column, plus_minus_unit: Column) -> Column:
    """struct(low, mid, high): a point with a margin, a range, one bound, or nothing for words."""
    margin = F.when(plus_minus_unit == "percent", F.abs(value) * plus_minus / 100).otherwise(plus_minus)
    lo = F.when(form == "range", low).when(form == "min", F.coalesce(low, value)).when(form == "max", None).when(form == "qualitative", None).otherwise(value - F.coalesce(margin, F.lit(0.0)))
    hi = F.when(form == "range", high).when(form == "max", F.coalesce(high, value)).when(form == "min", None).when(form == "qualitative", None).otherwise(value + F.coalesce(margin, F.lit(0.0)))
    mid = F.when(form == "qualitative", None).when(form == "range", (low + high) / 2).otherwise(F.coalesce(value, lo, hi))
    return F.struct(lo.cast("double").alias("low"), mid.cast("double").alias("mid"), hi.cast("double").alias("high"))


def multiplier(scale: Column, metric: Column, unit: Column) -> Column:
    """Factor to whole units; ratios, shares of something and per-share amounts aren't scaled."""
    out = F.lit(1.0)
    for name, factor in SCALES.items():
        out = F.when(F.lower(scale) == name, F.lit(factor)).otherwise(out)
    return F.when(F.concat_ws(" ", metric, unit).rlike(UNSCALED), F.lit(1.0)).otherwise(out)


def score(actual: Column, low: Column, high: Column, metric: Column) -> Column:
    """beat, miss or inline; an absent bound is open; for costs lower is better."""
    above, below = F.coalesce(actual > high, F.lit(False)), F.coalesce(actual < low, F.lit(False))
    lower = metric.rlike(LOWER_IS_BETTER)
    return F.when(actual.isNull(), None).when(above, F.when(lower, "miss").otherwise("beat")).when(below, F.when(lower, "beat").otherwise("miss")).otherwise("inline")


def raw_value(value: Column, scale: Column, metric: Column, unit: Column) -> Column:
    """A number in whole units; NULL beyond what any company reports."""
    out = value * multiplier(scale, metric, unit)
    return F.when(F.abs(out) <= LARGEST, out)


def result(actual: Column, value: Column, low: Column, high: Column, form: Column, metric: Column) -> Column:
    """struct(outcome, delta_abs, delta_pct) of guidance and its actual.

    Words have no result; a floor or ceiling is missed when it is crossed,
    whatever the metric; a band without bounds is the value itself, and a bound
    that is missing is open.
    """
    form = F.lower(F.coalesce(form, F.lit("point")))
    words = (form == "qualitative") | value.isNull()
    none = low.isNull() & high.isNull()
    lo, hi = F.when(none, value).otherwise(low), F.when(none, value).otherwise(high)
    outcome = F.when(words, "qualitative").when(form == "min", F.when(actual > value, "beat").otherwise("miss")).when(form == "max", F.when(actual < value, "beat").otherwise("miss")).otherwise(score(actual, lo, hi, metric))
    delta = F.when(~words, actual - value)
    return F.struct(outcome.alias("outcome"), delta.alias("delta_abs"), F.when(value != 0, delta / F.abs(value) * 100).alias("delta_pct"))


def period_kind(kind: Column, quarter: Column) -> Column:
    """quarterly or annual, from the period's own kind, else from whether it has a quarter."""
    low = F.lower(F.trim(F.coalesce(kind, F.lit(""))))
    return F.when(low.isin("annual", "multi_year"), "annual").when(low.isin("quarterly", "ytd", "current_quarter"), "quarterly").when(quarter.isNotNull(), "quarterly").otherwise("annual")


def after_rerun(stored: DataFrame, batch: DataFrame, filing: list[str], keys: list[str]) -> DataFrame:
    """The guidance table after a filing was read again, with action: keep, update, insert.

    Rows of other filings and rows that a person entered stay; of the filing's
    own rows those with a key of the batch are replaced and all others swept.
    """
    own = batch.select(*filing).distinct().withColumn("_f", F.lit(True))
    s = stored.join(own, filing, "left")
    kept = s.filter(F.col("_f").isNull() | F.col("manual")).drop("_f").withColumn("action", F.lit("keep"))
    replaced = s.filter(F.col("_f").isNotNull() & ~F.col("manual")).select(*filing, *keys).distinct().withColumn("_r", F.lit(True))
    first = F.row_number().over(Window.partitionBy(*filing, *keys).orderBy("id"))
    new = batch.withColumn("_n", first).filter("_n = 1").drop("_n").join(replaced, [*filing, *keys], "left")
    new = new.withColumn("action", F.when(F.col("_r"), "update").otherwise("insert")).drop("_r")
    return kept.unionByName(new)


def deduplicated(records: DataFrame, filing: list[str], keys: list[str], most: int = MOST_RECORDS) -> DataFrame:
    """One record per key: numbers replace words, else the first; it keeps the first's place; the first ``most`` of a filing."""
    own = Window.partitionBy(*filing, *keys)
    rows = records.withColumns({
        "_place": F.min("position").over(own),
        "_n": F.row_number().over(own.orderBy(F.col("qualitative").cast("int"), "position")),
    }).filter("_n = 1")
    rank = F.row_number().over(Window.partitionBy(*filing).orderBy("_place"))
    return rows.withColumn("_r", rank).filter(F.col("_r") <= most).drop("_n", "_r", "_place")


def superseded(records: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Adds is_current and supersedes: a manual record wins, else the latest; the others say which they precede."""
    w = Window.partitionBy(*keys).orderBy(F.col("manual").cast("int").desc(), *[c.desc() for c in order])
    back = Window.partitionBy(*keys).orderBy(*order)
    return records.withColumns({"is_current": F.row_number().over(w) == 1, "supersedes": F.lag("id").over(back)})
