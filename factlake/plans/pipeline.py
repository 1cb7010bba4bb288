"""Stages as functions of named frames, composed into a filing stage and a company stage.

A stage takes and returns a dict of DataFrames; providers (a source of company
facts, a planner) are injected, so a run is a fold over stages and nothing is
computed until a frame is written.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import decide, derive, quarters, series, validate

Frames = dict[str, DataFrame]
Stage = Callable[[Frames], Frames]


def run(stages: list[Stage], frames: Frames) -> Frames:
    return reduce(lambda at, stage: at | stage(at), stages, frames)


def enrich(frames: Frames) -> Frames:
    """Adds the subtotals that statements lack to ``lines``."""
    lines = frames["lines"]
    new = derive.income_subtotals(lines.filter("statement_type = 'income'"), ["filing"]).withColumn("statement_type", F.lit("income"))
    new = new.unionByName(derive.balance_subtotals(lines.filter("statement_type = 'balancesheet'"), ["filing"]).withColumn("statement_type", F.lit("balancesheet")))
    return {"derived": new}


def check(frames: Frames) -> Frames:
    lines = frames["lines"]
    return {"findings": reduce(DataFrame.unionByName, (f(lines, ["filing"]) for f in (validate.check_math, validate.check_plausibility, validate.check_coverage)))}


def decision(planner: Callable[[DataFrame], DataFrame] | None = None, strict: bool = True) -> Stage:
    """Ceiling and policy; a planner may narrow what they permit."""

    def stage(frames: Frames) -> Frames:
        ceiling = decide.write_ceiling(frames["lines"], frames["findings"], ["filing"])
        out = decide.policy(ceiling, frames["findings"], ["filing"], strict)
        if planner:
            out = decide.narrowed(out, planner(out), ["filing"])
        return {"decision": out}

    return stage


def deaccumulated(frames: Frames) -> Frames:
    return {"quarterly": quarters.deaccumulate(frames["totals"], ["cik", "concept"])}


def reconciled(provider: Callable[[DataFrame], DataFrame]) -> Stage:
    """Adds what a provider (gaps -> cik, concept, period, val) has for the gaps of the series."""

    def stage(frames: Frames) -> Frames:
        at = frames["quarterly"].withColumn("period", F.concat_ws("-", "fiscal_year", "quarter"))
        gaps = series.interior_gaps(at, ["cik"], ["cik", "concept"])
        fills = provider(gaps).join(gaps, ["cik", "concept", "period"], "left_semi")
        whole = at.select("cik", "concept", "period", F.col("quarter_value").alias("value")).unionByName(fills.select("cik", "concept", "period", F.col("val").alias("value")))
        return {"gaps": gaps, "fills": fills, "series": whole}

    return stage


def audited(frames: Frames) -> Frames:
    """What is still missing, and jumps of scale, after fills."""
    left = series.interior_gaps(frames["series"], ["cik"], ["cik", "concept"])
    return {"left": left, "jumps": series.scale_jumps(frames["series"], ["cik", "concept"])}


def finalised(frames: Frames) -> Frames:
    """One row per company: gaps, filled, left, jumps and a status."""

    def per(name: str, column: str) -> DataFrame:
        return frames[name].groupBy("cik").agg(F.count("*").alias(column))

    out = frames["totals"].select("cik").distinct()
    for name, column in (("gaps", "gaps"), ("fills", "filled"), ("left", "left"), ("jumps", "jumps")):
        out = out.join(per(name, column), "cik", "left")
    out = out.fillna(0, ["gaps", "filled", "left", "jumps"])
    return {"companies": out.withColumn("status", F.when(F.col("left") + F.col("jumps") > 0, "findings_detected").otherwise("clean"))}


def company_stage(provider: Callable[[DataFrame], DataFrame]) -> list[Stage]:
    return [deaccumulated, reconciled(provider), audited, finalised]


FILING_STAGE: list[Stage] = [enrich, check, decision()]
