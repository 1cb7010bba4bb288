"""What may be written: ceilings from findings, policies, plans that narrow, corrections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .validate import is_blocking

# --- fixed values -----------------------------------------------------------
CORRECTION_SOURCES = ("filing", "presentation", "calculation", "html")


def write_ceiling(statements: DataFrame, findings: DataFrame, keys: list[str]) -> DataFrame:
    """keys, statement_type, permitted, drop_concepts.

    A blocking finding about a concept drops the concept, one about a statement
    blocks it, one about the filing (no statement) blocks all of it.
    """
    bad = findings.filter(is_blocking())
    whole = bad.filter("statement_type is null").select(*keys).distinct().withColumn("_w", F.lit(True))
    per = bad.filter("statement_type is not null").groupBy(*keys, "statement_type").agg(
        F.bool_or(F.col("concept").isNull()).alias("_s"), F.array_sort(F.collect_set("concept")).alias("drop_concepts")
    )
    out = statements.select(*keys, "statement_type").distinct().join(per, [*keys, "statement_type"], "left").join(whole, keys, "left")
    permitted = F.col("_w").isNull() & ~F.coalesce("_s", F.lit(False))
    return out.select(*keys, "statement_type", permitted.alias("permitted"), F.coalesce("drop_concepts", F.array().cast("array<string>")).alias("drop_concepts"))


def policy(ceiling: DataFrame, findings: DataFrame, keys: list[str], strict: bool = True) -> DataFrame:
    """keys, action, statements, permitted: skip without statements; write all without blocking findings; else what the mode allows."""
    blocking = findings.groupBy(*keys).agg(F.count_if(is_blocking()).alias("_b"))
    one = ceiling.groupBy(*keys).agg(F.array_sort(F.collect_set("statement_type")).alias("all_statements"), F.array_sort(F.collect_set(F.when(F.col("permitted"), F.col("statement_type")))).alias("permitted"))
    one = one.join(blocking, keys, "left").withColumn("_b", F.coalesce("_b", F.lit(0)))
    none = F.array().cast("array<string>")
    allowed = none if strict else F.col("permitted")
    statements = F.when(F.col("_b") == 0, F.col("all_statements")).otherwise(allowed)
    return one.withColumn("statements", statements).select(*keys, F.when(F.size("statements") > 0, "write").otherwise("skip").alias("action"), "statements", "permitted")


def narrowed(decision: DataFrame, plan: DataFrame, keys: list[str]) -> DataFrame:
    """A plan (keys, plan_action, plan_statements, extra_drops) folded into a decision: it selects from the permitted statements only."""
    j = decision.join(plan, keys)
    asked = F.coalesce("plan_statements", F.array().cast("array<string>"))
    selected = F.when(F.size(asked) > 0, F.array_intersect(asked, "permitted")).when(F.col("plan_action") == "write", F.col("permitted")).otherwise(F.array().cast("array<string>"))
    j = j.withColumn("selected", F.array_sort(selected))
    nothing = (F.col("plan_action") == "skip") | (F.size("selected") == 0)
    whole = (F.size("selected") == F.size("permitted")) & (F.size(F.coalesce("extra_drops", F.array().cast("array<string>"))) == 0)
    action = F.when(nothing, "skip").when(whole, "write").otherwise("write_partial")
    return j.select(*keys, action.alias("action"), F.when(nothing, F.array().cast("array<string>")).otherwise(F.col("selected")).alias("statements"))


def proposal(old: Column, stored: Column, absolute: Column) -> Column:
    """Of two expected values the one nearer to the old value."""
    return F.when(F.abs(old - stored) <= F.abs(old - absolute), stored).otherwise(absolute)


def proposals(findings: DataFrame, keys: list[str]) -> DataFrame:
    """keys, statement_type, concept, old, new, reason, source: a repair for every identity that doesn't hold (finding with target, expected and absolute in its evidence)."""
    e = lambda c: F.col("evidence")[c].cast("double")
    bad = findings.filter((F.col("type") == "math_mismatch") & e("target").isNotNull() & e("expected").isNotNull() & F.col("concept").isNotNull())
    new = proposal(e("target"), e("expected"), F.coalesce(e("absolute"), e("expected")))
    return bad.select(*keys, "statement_type", "concept", e("target").alias("old"), new.alias("new"), F.concat(F.lit("recomputed from "), F.coalesce(F.col("evidence")["identity"], F.lit("an identity"))).alias("reason"), F.lit("calculation").alias("source"))


def approve(current: Column, old: Column, new: Column, source: Column, reason: Column, mode: Column) -> Column:
    """struct(approved, why): finite, an allowed source, a reason, the old value still current, a real change, a mode that repairs."""
    why = (
        F.when(new.isNull() | F.isnan(new.cast("double")), "not_finite")
        .when(~F.coalesce(source.isin(*CORRECTION_SOURCES), F.lit(False)), "source")
        .when(F.coalesce(F.trim(reason), F.lit("")) == "", "reason")
        .when(~current.eqNullSafe(old), "stale")
        .when(current == new, "no_change")
        .when(mode == "report", "report_only")
    )
    return F.struct(why.isNull().alias("approved"), F.coalesce(why, F.lit("ok")).alias("why"))


def corrected(lines: DataFrame, decisions: DataFrame, keys: list[str]) -> DataFrame:
    """Lines with approved new values, their old values and sources."""
    j = lines.join(decisions.filter("approved").select(*keys, F.col("new").alias("_new"), F.col("source").alias("corrected_by")), keys, "left")
    return j.withColumn("corrected_from", F.when(F.col("_new").isNotNull(), F.col("value"))).withColumn("value", F.coalesce("_new", "value")).drop("_new")
