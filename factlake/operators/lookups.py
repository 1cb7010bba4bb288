"""Joins and lookups: cascades by priority, orphans, backfills, counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean_label, is_polluted_path


def resolve_cascade(wanted: DataFrame, stored: DataFrame, classes: DataFrame, keys: list[str]) -> DataFrame:
    """wanted rows + id, how: the stored concept by exact name, alias, class or label, in this order.

    ``wanted``: keys, concept, label. ``stored``: keys, id, concept, aliases
    (array), label, path; quarantined paths don't count. All candidates come
    from one union with a priority and are ranked once.
    """
    usable = stored.filter(~is_polluted_path(F.col("path")))
    names = [
        (0, "exact", usable.select(*keys, "id", F.col("concept").alias("name"))),
        (1, "alias", usable.select(*keys, "id", F.explode("aliases").alias("name"))),
        (2, "class", usable.join(F.broadcast(classes.select(F.col("tag").alias("concept"), "canonical")), "concept").select(*keys, "id", F.col("canonical").alias("name"))),
        (3, "label", usable.select(*keys, "id", F.lower(clean_label(F.col("label"))).alias("name"))),
    ]
    asked = wanted.join(F.broadcast(classes.select(F.col("tag").alias("concept"), "canonical")), "concept", "left")
    tries = F.array(*[F.struct(F.lit(p).alias("priority"), n.alias("name")) for p, n in ((0, F.col("concept")), (1, F.col("concept")), (2, F.col("canonical")), (3, F.lower(clean_label(F.col("label")))))])
    asked = asked.select(*keys, "concept", "label", F.explode(tries).alias("t")).select(*keys, "concept", "label", "t.priority", "t.name")
    pool = None
    for priority, how, rows in names:
        rows = rows.select(*keys, "id", "name", F.lit(priority).alias("priority"), F.lit(how).alias("how")).distinct()
        pool = rows if pool is None else pool.unionByName(rows)
    found = asked.join(pool, [*keys, "priority", "name"])
    best = F.row_number().over(Window.partitionBy(*keys, "concept", "label").orderBy("priority", "id"))
    found = found.withColumn("_n", best).filter("_n = 1").select(*keys, "concept", "label", "id", "how")
    w, f = wanted.alias("w"), found.alias("f")
    same = [F.col(f"w.{k}").eqNullSafe(F.col(f"f.{k}")) for k in [*keys, "concept", "label"]]
    return w.join(f, same, "left").select("w.*", "f.id", "f.how")


def first_name_lookup(concepts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, name, id: own name, canonical name and aliases; the first concept (by position) that claims a name has it."""
    names = F.array_distinct(F.concat(F.array_compact(F.array("concept", "canonical")), F.coalesce("aliases", F.array().cast("array<string>"))))
    rows = concepts.select(*keys, "id", "position", F.explode(names).alias("name"))
    w = Window.partitionBy(*keys, "name").orderBy("position", "id")
    return rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").select(*keys, "name", "id")


def orphan_values(values: DataFrame, concepts: DataFrame, other: DataFrame) -> DataFrame:
    """value_id, action, new_id for values whose concept is gone: relink by name, else mirror the other cadence's concept, else drop."""
    lost = values.join(concepts.select(F.col("id").alias("concept_id")), "concept_id", "left_anti")
    own = concepts.groupBy("cik", "concept").agg(F.min("id").alias("own_id"))
    far = other.groupBy("cik", "concept").agg(F.min("id").alias("far_id"))
    j = lost.join(own, ["cik", "concept"], "left").join(far, ["cik", "concept"], "left")
    action = F.when(F.col("own_id").isNotNull(), "relink").when(F.col("far_id").isNotNull(), "mirror").otherwise("drop")
    return j.select("value_id", action.alias("action"), F.coalesce("own_id", "far_id").alias("new_id"))


def unprocessed(source: DataFrame, annual: DataFrame, quarterly: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key neither value table has."""
    done = annual.select(*keys).unionByName(quarterly.select(*keys)).distinct()
    return source.join(done, keys, "left_anti")


def complete_filings(stored: DataFrame, filing: list[str], kind: str, wanted: tuple[str, ...]) -> DataFrame:
    """Filings that have every wanted statement."""
    have = stored.groupBy(*filing).agg(F.collect_set(kind).alias("_k"))
    return have.filter(F.size(F.array_except(F.array(*map(F.lit, wanted)), "_k")) == 0).drop("_k")


def backfilled(rows: DataFrame, source: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Rows whose ``column`` is NULL take the source's least value of their key."""
    s = source.groupBy(*keys).agg(F.min(column).alias("_f"))
    return rows.join(s, keys, "left").withColumn(column, F.coalesce(column, "_f")).drop("_f")


def similar_facts(facts: DataFrame, target: dict, threshold: float) -> DataFrame:
    """Facts with a score of likeness to one fact: concept, value ratio, period, dimensions; zero and mixed signs have no ratio."""
    v, t = F.col("value"), F.lit(target["value"])
    same = F.col("concept") == target["concept"]
    local = F.element_at(F.split("concept", ":"), -1) == target["concept"].split(":")[-1]
    ratio = F.when((F.signum(v) == F.signum(t)) & (v != 0), F.least(F.abs(v), F.abs(t)) / F.greatest(F.abs(v), F.abs(t)))
    score = F.when(same, 0.4).when(local, 0.2).otherwise(0.0) + F.when(ratio >= 0.99, 0.3).when(ratio >= 0.9, 0.1).otherwise(0.0)
    score = score + F.when(F.col("period") == target["period"], 0.2).otherwise(0.0) + F.when(F.col("dimensions") == target["dimensions"], 0.1).otherwise(0.0)
    return facts.withColumn("score", F.round(score, 2)).filter(F.col("score") >= threshold)


def independent_modes(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The most frequent value of each column on its own; the least of equals."""
    out = None
    for c in columns:
        counts = rows.groupBy(*keys, c).agg(F.count("*").alias("_n"))
        w = Window.partitionBy(*keys).orderBy(F.col("_n").desc(), F.col(c))
        top = counts.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select(*keys, c)
        out = top if out is None else out.join(top, keys)
    return out


def processing_summary(source: DataFrame, processed: DataFrame, keys: list[str]) -> DataFrame:
    """total, processed, percent (NULL for an empty source)."""
    both = source.select(*keys, F.lit(True).alias("_s")).unionByName(processed.select(*keys, F.lit(False).alias("_s")))
    key = F.struct(*keys)
    both = both.agg(F.count_distinct(F.when(F.col("_s"), key)).alias("total"), F.count_distinct(F.when(~F.col("_s"), key)).alias("processed"))
    return both.withColumn("percent", F.try_divide(F.col("processed") * 100, F.col("total")))


def by_priority(*tables: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of several tables; of a key that several have, the first table's row."""
    out = None
    for k, t in enumerate(tables):
        t = t.withColumn("_p", F.lit(k))
        out = t if out is None else out.unionByName(t)
    w = Window.partitionBy(*keys).orderBy("_p")
    return out.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n", "_p")


def upper_medians(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, median, most: the middle value, the upper of two, from counts of equal values that each task makes first."""
    down = F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {value} DESC)")
    return rows.groupBy(*keys).agg(down.alias("median"), F.max(value).alias("most"))


def concept_label(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds label: of the local name, with or without the us-gaap_ prefix; the concept itself where none is known.

    ``labels`` (concept, label) is a taxonomy, so its names are joined by equality; all tries are one join.
    """
    name = F.trim(F.element_at(F.split("concept", ":"), -1))
    bare = F.regexp_replace(name, "us-gaap_", "")
    other = F.when(name.startswith("us-gaap_"), bare).otherwise(F.concat(F.lit("us-gaap_"), name))
    asked = rows.select("concept").distinct()
    tries = asked.select("concept", F.explode(F.array(F.struct(F.lit(0).alias("p"), name.alias("n")), F.struct(F.lit(1).alias("p"), other.alias("n")))).alias("t")).select("concept", "t.p", "t.n")
    found = tries.join(labels.select(F.col("concept").alias("n"), "label"), "n").groupBy("concept").agg(F.min(F.struct("p", "label"))["label"].alias("_l"))
    return rows.join(found, "concept", "left").withColumn("label", F.coalesce("_l", "concept")).drop("_l")
