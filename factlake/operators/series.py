"""Series over periods: gaps, jumps, signs, majorities and latest rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
JUMP_RATIO = 500.0
JUMP_LEAST = 1.0
ANNUAL_DAYS = (340, 380)
QUARTER_DAYS = (80, 100)
LEARNED_TOLERANCE_DAYS = 12


def interior_gaps(values: DataFrame, universe: list[str], series: list[str], period: str = "period", edges: bool = False) -> DataFrame:
    """Periods that a series lacks although its group (``universe`` columns) has them.

    Strictly between the series' first and last period, or anywhere with
    ``edges``. The universe is joined per group, so the product is bounded by
    series times periods of one group.
    """
    periods = values.select(*universe, period).distinct()
    spans = values.groupBy(*series).agg(F.min(period).alias("_first"), F.max(period).alias("_last"))
    wanted = spans.join(periods, universe)
    if not edges:
        wanted = wanted.filter((F.col(period) > F.col("_first")) & (F.col(period) < F.col("_last")))
    return wanted.select(*series, period).join(values.select(*series, period).distinct(), [*series, period], "left_anti")


def scale_jumps(values: DataFrame, series: list[str], period: str = "period", value: str = "value", ratio: float = JUMP_RATIO) -> DataFrame:
    """Neighbouring periods, both over 1 in size, whose sizes differ by ``ratio`` or more."""
    w = Window.partitionBy(*series).orderBy(period)
    rows = values.withColumns({"previous_period": F.lag(period).over(w), "previous_value": F.lag(value).over(w)})
    a, b = F.abs(F.col(value)), F.abs(F.col("previous_value"))
    return rows.filter((a > JUMP_LEAST) & (b > JUMP_LEAST) & (F.greatest(a, b) >= F.least(a, b) * ratio))


def latest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key; ``order`` must be total."""
    w = Window.partitionBy(*keys).orderBy(*[c.desc() for c in order])
    return rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def first_wins(rows: DataFrame, keys: list[str], position: Column) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(position)
    return rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def majority(rows: DataFrame, keys: list[str], value: str, name: str = "majority") -> DataFrame:
    """The most frequent value of each key, the least of equally frequent ones."""
    counts = rows.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*keys).orderBy(F.col("_n").desc(), F.col(value))
    return counts.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select(*keys, F.col(value).alias(name))


def one_sign(rows: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """keys + sign: of keys whose non-zero values all have one sign."""
    sign = F.signum(F.col(value))
    return rows.filter(F.col(value) != 0).groupBy(*keys).agg(F.min(sign).alias("a"), F.max(sign).alias("b")).filter("a = b").select(*keys, F.col("a").cast("int").alias("sign"))


def learned_durations(rows: DataFrame, keys: list[str], end: str, days: str) -> DataFrame:
    """keys, end month, days: the length last seen for periods that end in that month."""
    month = F.month(end).alias("end_month")
    return rows.filter(F.col(days).isNotNull()).groupBy(*keys, month).agg(F.max(F.struct(F.col(end), F.col(days)))[days].alias("learned_days"))


def fill_gaps(gaps: DataFrame, facts: DataFrame, classes: DataFrame, stored: DataFrame, keys: list[str], annual: bool) -> DataFrame:
    """Facts for gaps: same end date, a tag of the concept's class, a fitting length, the best candidate, not stored yet.

    ``gaps``: keys, canonical, period_end, is_instant, expected_days.
    ``facts``: keys, tag, start, end, val, form, frame, accession.
    ``classes``: canonical, tag, rank.
    """
    low, high = ANNUAL_DAYS if annual else QUARTER_DAYS
    form = "10-K" if annual else "10-Q"
    days = F.datediff("end", "start")
    fits = F.when(F.col("is_instant"), F.col("start").isNull()).otherwise(
        F.when(F.col("expected_days").isNotNull(), F.abs(days - F.col("expected_days")) <= LEARNED_TOLERANCE_DAYS).otherwise(days.between(low, high))
    )
    found = gaps.join(classes, "canonical").join(facts.withColumnRenamed("end", "period_end").withColumn("end", F.col("period_end")), [*keys, "tag", "period_end"]).filter(fits)
    order = Window.partitionBy(*keys, "canonical", "period_end").orderBy((F.col("form") != form).cast("int"), F.col("frame").isNull().cast("int"), "rank", "accession", "val")
    best = found.withColumn("_n", F.row_number().over(order)).filter("_n = 1")
    return best.join(stored.select(*keys, "canonical", "period_end").distinct(), [*keys, "canonical", "period_end"], "left_anti").select(*keys, "canonical", "period_end", "tag", "val", "accession")


def filing_order(filings: DataFrame, keys: list[str]) -> DataFrame:
    """Adds place: newest fiscal year first, in it the quarters, the annual report, amendments, others."""
    form = F.col("form")
    rank = F.when(form.isin("10-K", "20-F"), 4).when(form == "10-Q", F.coalesce("quarter", F.lit(6))).when(form.endswith("/A"), 5).otherwise(6)
    return filings.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("fiscal_year").desc_nulls_last(), rank, "end_date", "accession")))


def applied_fills(gaps: DataFrame, fills: DataFrame, stored: DataFrame, values: DataFrame, keys: list[str], period: list[str], may_flip: tuple[str, ...] = (), concept: str = "concept") -> DataFrame:
    """keys, period, val, state of each gap: 'filled' (to be inserted), 'exists' (stored meanwhile) or 'absent' (nothing found).

    A fill takes the sign that all stored values of its series have, unless the
    concept is one that may change its sign. Writing the filled rows only is
    the run, writing none a dry run.
    """
    on = [*keys, *period]
    signed = fills.join(one_sign(values, keys), keys, "left")
    keep = F.col("sign").isNull() | F.col(concept).isin(*may_flip)
    signed = signed.withColumn("val", F.when(keep, F.col("val")).otherwise(F.col("sign") * F.abs("val"))).drop("sign")
    out = gaps.join(signed, on, "left").join(stored.select(*on, F.lit(True).alias("_s")), on, "left")
    state = F.when(F.col("val").isNull(), "absent").when(F.col("_s"), "exists").otherwise("filled")
    return out.select(*on, "val", state.alias("state"))
