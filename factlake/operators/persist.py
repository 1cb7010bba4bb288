"""Writing a filing's statements: the gate, the order of writes, receipts, and repairs of stored rows.

Each function returns the next version of a table or a receipt; the caller
writes them in the order that ``write_bundle`` gives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from . import concepts, guard, merge

# --- fixed values -----------------------------------------------------------
HIDDEN_PATH = "555"
SEED_VERSION = 1


def _blank(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) == ""


def gate(decisions: DataFrame, statements: DataFrame, items: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """The items that may be written, and a receipt per filing.

    ``decisions``: keys, action, statements (array of the kinds to write);
    ``statements``: keys, statement_type, drop_concepts (array); ``items``: keys,
    statement_type, concept and more. Nothing is written of a skipped filing or
    a filing without a decision. Receipt: action, written, total, skipped
    (array of kinds), dropped (items left out of written statements).
    """
    plan = statements.join(decisions.select(*keys, "action", F.col("statements").alias("_chosen")), keys, "left")
    write = F.coalesce((F.col("action") != "skip") & F.array_contains("_chosen", F.col("statement_type")), F.lit(False))
    plan = plan.withColumn("_write", write)
    j = items.join(plan.filter("_write").select(*keys, "statement_type", F.coalesce("drop_concepts", F.array().cast("array<string>")).alias("_drops")), [*keys, "statement_type"])
    dropped = F.array_contains("_drops", F.col("concept"))
    per = plan.groupBy(*keys).agg(
        F.coalesce(F.max("action"), F.lit("skip")).alias("action"), F.count_if("_write").alias("written"), F.count("*").alias("total"),
        F.array_sort(F.collect_list(F.when(~F.col("_write"), F.col("statement_type")))).alias("skipped"),
    )
    lost = j.filter(dropped).groupBy(*keys).agg(F.count("*").alias("dropped"))
    return j.filter(~dropped).select(*items.columns), per.join(lost, keys, "left").withColumn("dropped", F.coalesce("dropped", F.lit(0)))


def write_bundle(items: DataFrame, stored: DataFrame, values: DataFrame, classes: DataFrame, keys: list[str], period: list[str], allow_create: bool = True) -> dict[str, DataFrame]:
    """The next versions of a company's tables after a batch of items, in the order of writing, and what was refused.

    ``items``: keys, row, concept, label, parent_concept, path, order_key,
    form_type, abstract, alias_target, period columns, value, accession.
    concepts: stored ones updated and new ones with ids of their own behind the
    stored ones (a new row's id is the largest stored id plus its place by company and row); links:
    each row's parent by path; values: upserted by concept and period, with one
    accession per period; rejects: items that got no concept, with the reason.
    """
    placed = concepts.place(items, stored, keys, classes, allow_create)
    bad = guard.rejects(items.select("row", "concept", "path")).select("row", "reason")
    refused = placed.filter("action in ('skip', 'refuse')").select("row", "action").join(bad, "row", "full_outer").select("row", F.coalesce("reason", "action").alias("reason"))
    good = placed.join(bad.select("row"), "row", "left_anti")
    new = concepts.new_concepts(items, good, keys)
    last = stored.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_last"))  # one row
    ahead = new.groupBy(*keys).agg(F.count("*").alias("_n")).withColumn("_ahead", F.sum("_n").over(Window.orderBy(*keys)) - F.col("_n")).drop("_n")  # one row per company
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("row"))
    new = new.join(ahead, keys).crossJoin(F.broadcast(last)).withColumn("id", F.col("_last") + F.col("_ahead") + place).drop("_last", "_ahead")
    columns = [c for c in stored.columns if c in new.columns]
    table = concepts.next_concepts(items, stored, good).unionByName(new.select(*columns), allowMissingColumns=True)
    scope = lambda d: F.when(F.col(f"{d}concept").startswith("custom:"), F.coalesce(F.col(f"{d}parent_concept"), F.lit(""))).otherwise("")
    made = new.select(*keys, "concept", scope("").alias("_s"), F.col("id").alias("_new"))
    created = items.join(good.filter("action = 'create'").select("row"), "row").withColumn("_s", scope("")).join(made, [*keys, "concept", "_s"]).select("row", F.col("_new").alias("concept_id"))
    found = good.filter("action in ('reuse', 'adopt')").select("row", F.col("id").alias("concept_id"))
    ids = found.unionByName(created)
    batch = items.join(ids, "row").filter("value is not null").groupBy(*keys, "concept_id", *period).agg(F.max_by(F.struct("value", "accession"), "row").alias("_v"))
    batch = batch.select(*keys, "concept_id", *period, F.col("_v.value").alias("value"), F.col("_v.accession").alias("accession"))
    merged = merge.upsert_values(values, batch, [*keys, "concept_id", *period], carried=("accession",))
    aligned = merge.align_periods(merged, [*keys, *period], ["accession"], [F.when(F.col("action") == "keep", 1).otherwise(0), F.col("accession").desc_nulls_last()])
    return {"concepts": table, "links": merge.parent_links(table, keys), "values": aligned, "rejects": refused}


def dimension_parents(dims: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Adds parent, filled for members without parent_concept: the concept of the row that they name by id, else of the row at their parent path, else the name that they carry.

    ``dims``: keys, id, parent_id, path, concept_name, parent_concept; ``rows``: keys, id, path, concept, dimensional.
    """
    by_id = rows.select(F.col("id").alias("parent_id"), F.col("concept").alias("_by_id"))
    by_path = rows.filter(~F.col("dimensional") & ~_blank("path")).groupBy(*keys, F.col("path").alias("_up")).agg(F.min("concept").alias("_by_path"))
    j = dims.withColumn("_up", T.parent_path(F.col("path"))).join(by_id, "parent_id", "left").join(by_path, [*keys, "_up"], "left")
    found = F.coalesce(F.nullif("_by_id", F.lit("")), "_by_path", F.nullif("concept_name", F.lit("")))
    own = F.nullif("parent_concept", F.lit(""))
    how = F.when(own.isNotNull(), "kept").when(found.isNotNull(), "filled").otherwise("unresolved")
    return j.withColumns({"parent": F.coalesce(own, found), "how": how}).drop("_up", "_by_id", "_by_path")


def hierarchy_updates(annual: DataFrame, quarterly: DataFrame, updates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The next annual and quarterly rows (id, path, order_key, hide, level, parent_concept) after repairs (id, form_type and the same fields).

    Only fields that are given change; a row that goes to the hidden path isn't
    hidden. A repair of a 10-Q looks in the quarterly table first, any other in
    the annual one; where the id isn't there, in the other.
    """
    fields = ("path", "order_key", "hide", "level", "parent_concept")
    both = annual.select("id", F.lit("annual").alias("_t")).unionByName(quarterly.select("id", F.lit("quarterly").alias("_t")))
    first = F.when(F.col("form_type") == "10-Q", "quarterly").otherwise("annual")
    where = both.join(updates.select("id", first.alias("_want")).distinct(), "id").groupBy("id", "_want").agg(F.coalesce(F.max(F.when(F.col("_t") == F.col("_want"), F.col("_t"))), F.max("_t")).alias("_t"))
    aimed = updates.withColumn("_want", first).join(where, ["id", "_want"])

    def applied(rows: DataFrame, name: str) -> DataFrame:
        u = aimed.filter(F.col("_t") == name).select("id", *[F.col(f).alias(f"_{f}") for f in fields])
        hide = F.when(F.col("_path") == HIDDEN_PATH, F.lit(False)).otherwise(F.coalesce("_hide", "hide"))
        j = rows.join(u, "id", "left")
        return j.withColumns({f: hide if f == "hide" else F.coalesce(f"_{f}", f) for f in fields}).select(*rows.columns)

    return applied(annual, "annual"), applied(quarterly, "quarterly")


def seeded(companies: DataFrame, plans: DataFrame) -> DataFrame:
    """Companies with the statement kinds that a plan seeded (cik, statement_types) and the version of the seed."""
    p = plans.groupBy("cik").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("statement_types")))).alias("_new"))
    j = companies.join(p, "cik", "left")
    kinds = F.array_sort(F.array_union(F.coalesce("seeded_types", F.array().cast("array<string>")), F.coalesce("_new", F.array().cast("array<string>"))))
    return j.withColumns({"seed_version": F.when(F.col("_new").isNotNull(), SEED_VERSION).otherwise(F.col("seed_version")), "seeded_types": F.when(F.size("_new") > 0, kinds).otherwise(F.col("seeded_types"))}).drop("_new")


def saved_statements(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """cik, statement_type, end_date, filing_id, action for the statements of a batch: skip where another filing has the end date, update its own, insert otherwise.

    Of several in a batch with one end date the first filing (least id) counts.
    """
    key = ["cik", "statement_type", "end_date"]
    have = stored.groupBy(*key).agg(F.min("filing_id").alias("_have"))
    first = F.min("filing_id").over(Window.partitionBy(*key))
    j = batch.withColumn("_first", first).join(have, key, "left")
    owner = F.coalesce("_have", "_first")
    action = F.when(F.col("filing_id") != owner, "skip").when(F.col("_have").isNotNull(), "update").otherwise("insert")
    return j.select(*key, "filing_id", action.alias("action"))


def dimensional_values(stored: DataFrame, batch: DataFrame, period: list[str]) -> DataFrame:
    """The values of dimensional concepts after a batch; older rows that keep the id under dimensional_concept_id are the same value."""
    own = stored.withColumn("concept_id", F.coalesce("concept_id", "dimensional_concept_id")).drop("dimensional_concept_id")
    return merge.upsert_values(own, batch, ["cik", "concept_id", *period])


def path_conflicts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, path, order_key, first_id, id: every further row of a place, paired with its first."""
    w = Window.partitionBy(*keys, "path", "order_key").orderBy("id")
    out = rows.withColumns({"first_id": F.first("id").over(w), "_n": F.row_number().over(w)}).filter("_n > 1")
    return out.select(*keys, "path", "order_key", "first_id", "id")


def reports(stored: DataFrame, batch: DataFrame, decisions: DataFrame, companies: DataFrame) -> DataFrame:
    """Validation reports (cik, accession, form, status, decision, final): a batch replaces whole reports, decisions are attached, companies finalised."""
    key = ["cik", "accession", "form"]
    rows = merge.replace_scope(stored.select(*key, "status"), batch.select(*key, "status"), key)
    d = decisions.groupBy(*key).agg(F.max("decision").alias("decision"))
    done = companies.select("cik", F.lit(True).alias("_final")).distinct()
    return rows.join(d, key, "left").join(done, "cik", "left").withColumn("final", F.coalesce("_final", F.lit(False))).drop("_final")
