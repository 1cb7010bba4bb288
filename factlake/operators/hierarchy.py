"""Trees as edge tables: paths, levels, orders, placement.

A path is the chain of three-digit sibling numbers from the root ("001.002").
A tree is walked level by level with joins, never in the driver.
"""

from __future__ import annotations

from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.landing import stored

if TYPE_CHECKING:  # workers import it; a driver that runs other queries needn't
    import pandas as pd

# --- fixed values -----------------------------------------------------------
SEGMENT_DIGITS = 3
MOST_LETTERS = 14  # 26**14 is beyond 64 bits
HIDDEN_PATH = "555"
ACTIVITY_TOTALS = ("NetCashProvidedByUsedIn", "CashFlowsFromUsedIn")
CASH_ROOTS = (
    *ACTIVITY_TOTALS, "CashCashEquivalentsRestrictedCash", "CashAndCashEquivalentsPeriodIncreaseDecrease", "IncreaseDecreaseInCash", "CashAndCashEquivalents", "EffectOfExchangeRateOnCash",
)
SUPPLEMENTAL = ("InterestPaid", "IncomeTaxesPaid")
COST_TOTALS = ("CostsAndExpenses", "TotalCostsAndExpenses")
ACTIVITIES = ("Operating", "Investing", "Financing")


def sibling_numbers(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``sibling``: the place among the children of a parent, by position, from 1."""
    w = Window.partitionBy(*keys, "parent").orderBy("position", "id")
    return nodes.withColumn("sibling", F.row_number().over(w))


def tree_paths(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """keys, id, path, level: nodes (keys, id, parent, position) reached from the roots.

    Siblings are numbered in order of position. One join per level, written to
    the shared folder; it ends when a level is empty, however many rows a level
    has and however deep the tree is. A node on a cycle is never reached.
    """
    numbered = sibling_numbers(nodes, keys).withColumn("segment", F.lpad(F.col("sibling").cast("string"), SEGMENT_DIGITS, "0")).select(*keys, "id", "parent", "segment")
    numbered = stored(numbered, "tree-nodes")
    at = stored(numbered.filter("parent is null").select(*keys, "id", F.col("segment").alias("path"), F.lit(0).alias("level")), "tree-level")
    levels = [at]
    on = [F.col(f"n.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys]
    while not at.isEmpty():
        below = numbered.alias("n").join(at.alias("t"), [F.col("n.parent") == F.col("t.id"), *on])
        at = stored(below.select(*[F.col(f"n.{k}") for k in keys], "n.id", F.concat_ws(".", "t.path", "n.segment").alias("path"), (F.col("t.level") + 1).alias("level")), "tree-level")
        levels.append(at)
    return reduce(DataFrame.unionByName, levels)


def reading_order(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Adds reading_order from 1: the place of a path in the statement, numbers compared as numbers."""
    parts = F.transform(F.split("path", r"\."), lambda x: x.cast("int"))
    return rows.withColumn("reading_order", F.row_number().over(Window.partitionBy(*keys).orderBy(parts)))


def parents_by_level(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Adds parent_position: the last earlier row that is one level higher, for flat lists with levels.

    Each row appears twice: under its own level, where it can be found, and under
    the level above, where it looks. Rows that are partitioned by ``keys`` stay
    where they are.
    """
    both = rows.withColumn("_looks", F.explode(F.array(F.lit(False), F.lit(True)))).withColumn("_at", F.col("level") - F.col("_looks").cast("int"))
    earlier = Window.partitionBy(*keys, "_at").orderBy(F.col("position").cast("bigint")).rangeBetween(Window.unboundedPreceding, -1)
    found = F.max(F.when(~F.col("_looks") & F.col("level").isNotNull(), F.col("position").cast("bigint"))).over(earlier)
    return both.withColumn("parent_position", found).filter("_looks").drop("_looks", "_at")


def levelled(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Levels less the least level of the statement."""
    return rows.withColumn("level", F.col("level") - F.min("level").over(Window.partitionBy(*keys)))


def order_rank(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Adds the integer rank among siblings and its letters (0 a, 25 z, 26 aa); sort by the rank, letters don't sort."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(w) - 1).withColumn("order_key", letters(F.col("rank")))


def letters(rank: Column) -> Column:
    """Bijective base 26 (0 a, 25 z, 26 aa) of any rank from 0; NULL below."""
    left, out = rank.cast("bigint") + 1, F.when(rank >= 0, F.lit(""))
    for _ in range(MOST_LETTERS):
        # Each step uses the one before once, so the expression stays small; a number that is used up stays at 0.
        out = F.concat(F.when(left > 0, F.char(F.pmod(left - 1, F.lit(26)) + 97)).otherwise(""), out)
        left = F.call_function("div", left - 1, F.lit(26))
    return out


def letters_rank(key: Column) -> Column:
    """The rank of letters, -1 for anything else."""
    low = F.lower(F.trim(key))
    n = F.aggregate(F.split(low, ""), F.lit(0).cast("bigint"), lambda a, c: a * 26 + F.when(c == "", 0).otherwise(F.ascii(c) - 96))
    return F.when(low.rlike("^[a-z]+$"), n - 1).otherwise(F.lit(-1).cast("bigint"))


def key_between(left: Column, right: Column) -> Column:
    """A text key strictly between two neighbours' keys, of which either may be missing."""
    a, b = F.nullif(left, F.lit("")), F.nullif(right, F.lit(""))
    same = F.size(F.filter(F.sequence(F.lit(1), F.greatest(F.least(F.length(a), F.length(b)), F.lit(1))), lambda n: F.substring(a, 1, n) == F.substring(b, 1, n)))
    low = F.when(same < F.length(a), F.ascii(F.substring(a, same + 1, F.lit(1)))).otherwise(96)
    high = F.when(same < F.length(b), F.ascii(F.substring(b, same + 1, F.lit(1)))).otherwise(123)
    middle = F.concat(F.substring(a, F.lit(1), same), F.char(F.floor((low + high) / 2)))
    inside = lambda c: (a < c) & (c < b)
    both = F.when((high - low > 1) & inside(middle), middle).when(inside(F.concat(a, F.lit("n"))), F.concat(a, F.lit("n"))).when(inside(F.concat(a, F.lit("m"))), F.concat(a, F.lit("m"))).otherwise(F.concat(a, F.lit("n")))
    first = F.when((F.length(b) == 1) & (b > "a"), F.char(F.floor((96 + F.ascii(b)) / 2))).otherwise("0n")
    last = F.when(letters_rank(a) >= 0, letters(letters_rank(a) + 1)).otherwise(F.concat(a, F.lit("n")))
    return F.when(a.isNull() & b.isNull(), "a").when(a.isNull(), first).when(b.isNull(), last).otherwise(both)


def between(left: Column, right: Column) -> Column:
    """A rank strictly between two, as a fraction: text keys are made when rows are written."""
    return F.when(right.isNull(), left + 1).otherwise((left + right) / 2)


def next_path(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, next: the root segment after the largest one, quarantine segments aside."""
    first = F.split("path", r"\.")[0].try_cast("int")
    used = rows.withColumn("_s", first).filter(~F.col("_s").isin(404, 555))
    return used.groupBy(*keys).agg(F.lpad((F.max("_s") + 1).cast("string"), SEGMENT_DIGITS, "0").alias("next"))


def rerooted(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Drops a common leading "001." when every path has it and none is "001"."""
    w = Window.partitionBy(*keys)
    strip = F.min(F.col("path").startswith("001.").cast("int")).over(w) == 1
    return rows.withColumn("_s", strip).withColumn("path", F.when(F.col("_s"), F.expr("substring(path, 5)")).otherwise(F.col("path"))).drop("_s")


def _local(concept: Column) -> Column:
    return F.regexp_extract(concept, r"([^:]*)$", 1)


def _starts(name: Column, heads: tuple[str, ...]) -> Column:
    return name.rlike(f"^(?:{'|'.join(heads)})")


def _kind(statement: Column) -> Column:
    low = F.lower(statement)
    return F.when(low.contains("balance"), "balance").when(low.contains("cash") | low.contains("flow"), "cash").when(low.contains("income"), "income")


def calculation_parents(rows: DataFrame, arcs: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, statement_type, concept, position, parent, section) with ``parent`` overridden by calculation arcs.

    ``keys`` name a statement and a concept is in it once. ``arcs``: keys,
    parent, concept, weight (null is 1), position. The calculation parent is the
    first parent that the statement has. Balance sheet: it is the parent. Cash
    flow: only an activity total is, and totals and cash are roots. Income: only
    with weight 1, in the parent's own section, when all of the parent's
    children in the statement are positive and it is no total of all costs; a
    row without such a parent is a root. Other statements stay.
    """
    shown = rows.select(*keys, "concept")
    inside = arcs.filter("parent <> concept").withColumn("weight", F.coalesce("weight", F.lit(1.0))).join(shown, [*keys, "concept"], "left_semi").join(shown.withColumnRenamed("concept", "parent"), [*keys, "parent"], "left_semi")
    first = inside.groupBy(*keys, "concept").agg(F.min_by(F.struct("parent", "weight"), F.struct("position", "parent")).alias("_c"))
    sums = inside.groupBy(*keys, "parent").agg((F.min("weight") > 0).alias("_positive")).withColumnRenamed("parent", "_p")
    sections = rows.select(*keys, F.col("concept").alias("_p"), F.col("section").alias("_s"))
    j = rows.join(first, [*keys, "concept"], "left").withColumns({"_p": F.col("_c.parent"), "_w": F.col("_c.weight")})
    j = j.join(sums, [*keys, "_p"], "left").join(sections, [*keys, "_p"], "left")
    kind, calc = _kind(F.col("statement_type")), F.col("_p")
    rollup = (F.col("_w") == 1) & F.col("_positive") & (F.col("section") != "") & (F.col("section") == F.col("_s")) & ~_local(calc).isin(*COST_TOTALS)
    cash = F.when(_starts(_local(F.col("concept")), CASH_ROOTS), F.lit(None)).when(_starts(_local(calc), ACTIVITY_TOTALS), calc).otherwise(F.col("parent"))
    out = F.when(kind == "balance", F.coalesce(calc, "parent")).when(kind == "cash", cash).when(kind == "income", F.when(rollup, calc)).otherwise(F.col("parent"))
    return j.withColumn("parent", out).select(*rows.columns)


def section_parents(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, statement_type, concept, position from 0, parent): those without a parent go under their section's total.

    Balance sheet: before Assets under Assets, from there to liabilities and
    equity under the latter. Cash flow: under the next activity total; totals,
    cash, exchange effects and supplemental lines stay roots.
    """
    w, concept, at = Window.partitionBy(*keys), F.col("concept"), F.col("position")

    def anchor(hit: Column) -> Column:
        return F.min(F.when(hit, F.struct("position", "concept"))).over(w)

    def either(a: str, b: str) -> Column:
        return F.coalesce(anchor(concept == a), anchor(concept == b))

    marks = {"_assets": either("us-gaap:Assets", "ifrs-full:Assets"), "_lse": either("us-gaap:LiabilitiesAndStockholdersEquity", "ifrs-full:EquityAndLiabilities")}
    for x in ACTIVITIES:
        marks[f"_{x}"] = anchor(_local(concept).rlike(f"^(?:NetCashProvidedByUsedIn{x}Activities(?:ContinuingOperations)?|CashFlowsFromUsedIn{x}Activities)$"))
    j, kind = rows.withColumns(marks), _kind(F.col("statement_type"))

    def place(mark: str) -> Column:
        return F.coalesce(F.col(f"{mark}.position"), F.lit(-1))

    def total(mark: str) -> Column:
        return F.col(f"{mark}.concept")

    def root(mark: str) -> Column:
        return F.coalesce(concept == total(mark), F.lit(False))

    balance = F.when(root("_assets") | root("_lse"), F.lit(None)).when(at < place("_assets"), total("_assets")).when((at > place("_assets")) & (at < place("_lse")), total("_lse"))
    o, i, f = (f"_{x}" for x in ACTIVITIES)
    exempt = root(o) | root(i) | root(f) | _starts(_local(concept), (*CASH_ROOTS, *SUPPLEMENTAL))
    cash = F.when(exempt, F.lit(None)).when(at < place(o), total(o)).when((at > place(o)) & (at < place(i)), total(i)).when((at > place(i)) & (at < place(f)), total(f))
    parent = F.when(F.col("parent").isNotNull() & (F.col("parent") != ""), F.col("parent")).when(kind == "balance", balance).when(kind == "cash", cash)
    return j.withColumn("parent", parent).select(*rows.columns)


def broken_cycles(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, id, parent, position) with the parent cleared where it is absent or where following parents comes back.

    A cycle is broken at its row with the lowest position.
    """
    known = edges.select(*keys, F.col("id").alias("parent"), F.lit(True).alias("_k"))
    rows = edges.join(known, [*keys, "parent"], "left").withColumn("parent", F.when(F.col("_k"), F.col("parent"))).drop("_k").select(*edges.columns)

    def cut(pdf: pd.DataFrame) -> pd.DataFrame:
        up = dict(zip(pdf["id"], pdf["parent"], strict=True))
        place = dict(zip(pdf["id"], pdf["position"], strict=True))
        state: dict = {}
        for start in pdf["id"]:
            walk, at = [], start
            while at is not None and at == at and at not in state:
                state[at] = start
                walk.append(at)
                at = up.get(at)
            if at is not None and at == at and state.get(at) == start:
                ring = walk[walk.index(at) :]
                up[min(ring, key=lambda x: place[x])] = None
        return pdf.assign(parent=pdf["id"].map(lambda i: up[i]).astype(object).where(lambda s: s.notna(), None))

    return rows.groupBy(*keys).applyInPandas(cut, edges.schema)


def placed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Paths for stored and new rows of a statement (keys, id, parent, position, stored_path, hidden).

    A stored path stays where it lies inside its parent's path; a new row takes
    the number after its parent's largest child; hidden rows go below the
    hidden root; rows whose parent is absent become roots. One group is one
    company's statement (some hundred rows), so its rows fit a task.
    """

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        known = set(pdf["id"])
        rows = pdf.sort_values(["position", "id"]).to_dict("records")
        paths: dict = {}
        largest: dict[str, int] = {}

        def claim(path: str) -> str:
            parent, _, last = path.rpartition(".")
            if last.isdigit() and last not in ("404", HIDDEN_PATH):
                largest[parent] = max(largest.get(parent, 0), int(last))
            return path

        for r in rows:
            if r["stored_path"]:
                claim(r["stored_path"])
        waiting = rows
        while waiting:
            later = []
            for r in waiting:
                parent = r["parent"] if r["parent"] in known and r["parent"] != r["id"] else None
                if parent is not None and parent not in paths:
                    later.append(r)
                    continue
                base = HIDDEN_PATH if r["hidden"] else paths.get(parent, "") if parent is not None else ""
                stored = r["stored_path"] or ""
                if stored and not r["hidden"] and stored.rpartition(".")[0] == base:
                    paths[r["id"]] = stored
                else:
                    n = largest.get(base, 0) + 1
                    while n in (404, 555):
                        n += 1
                    paths[r["id"]] = claim(f"{base}.{n:03d}" if base else f"{n:03d}")
            if len(later) == len(waiting):  # a ring: its first row becomes a root
                later[0]["parent"] = None
            waiting = later
        return pdf.assign(path=pdf["id"].map(paths))[[*keys, "id", "path"]]

    types = rows.schema
    schema = ", ".join(f"`{k}` {types[k].dataType.simpleString()}" for k in [*keys, "id"]) + ", path string"
    return rows.groupBy(*keys).applyInPandas(place, schema)


def tree_stats(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, nodes, roots, leaves, deepest (rows: path, level)."""
    inner = rows.filter(F.col("path").contains(".")).select(*keys, F.regexp_replace("path", r"\.[^.]*$", "").alias("path")).distinct().withColumn("_i", F.lit(True))
    j = rows.join(inner, [*keys, "path"], "left")
    return j.groupBy(*keys).agg(F.count("*").alias("nodes"), F.count_if(F.col("level") == 0).alias("roots"), F.count_if(F.col("_i").isNull()).alias("leaves"), F.max("level").alias("deepest"))


def level_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, level, nodes, conflicts: rows of each level, and paths there that several rows have."""
    per = rows.groupBy(*keys, "level", "path").agg(F.count("*").alias("n"))
    return per.groupBy(*keys, "level").agg(F.sum("n").alias("nodes"), F.count_if(F.col("n") > 1).alias("conflicts"))
