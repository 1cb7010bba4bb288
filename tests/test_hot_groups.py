"""Many rows of a batch meet many stored rows of one name: results, and rows that joins make on the way."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from factlake import catalogue
from factlake.operators import concepts, dimensions

N = 1200
SF = "/root/testdata/sf0.001"


def joined_rows(df):
    """The rows of ``df``, and the most rows that any join made for them."""
    rows = df.collect()
    most, rest = 0, [df._jdf.queryExecution().executedPlan()]
    while rest:
        node = rest.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            rest.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            rest.append(node.plan())
            continue
        if "Join" in name and node.metrics().contains("numOutputRows"):
            most = max(most, node.metrics().apply("numOutputRows").value())
        children = node.children()
        rest += [children.apply(k) for k in range(children.size())]
    return rows, most


def test_guidance_of_one_name_is_answered_once(spark):
    k = F.col("id")
    g = spark.range(N).select(F.lit(1).alias("cik"), k.alias("row"), F.lit(None).cast("string").alias("statement_type"), F.when(k % 3 == 0, "co:X").alias("concept"), F.when(k % 3 == 1, "Total Revenues").when(k % 3 == 2, "own  label").alias("standard_label"), F.when(k % 2 == 0, "annual").when(k % 4 == 1, "quarterly").alias("period_type"))
    rows = spark.range(N).select(k, F.lit(1).alias("cik"), F.lit("income").alias("statement_type"), F.when(k % 2 == 0, "co:X").otherwise("us-gaap:A").alias("concept"), F.lit("Own Label").alias("label"))
    mapping = spark.createDataFrame([("income", "Revenue", ["us-gaap:A"])], "statement_type string, standard_label string, concepts array<string>")
    got, most = joined_rows(concepts.guidance_concepts(g, mapping, rows.filter("id >= 10"), rows.filter("id < 10"), ["cik"]))
    assert len(got) == N and most <= N
    by = {r["row"]: (r["id"], r["concept"], r["cadence"]) for r in got}
    assert by[0] == (0, "co:X", "annual") and by[9] == (10, "co:X", "quarterly") and by[3] == (0, "co:X", "annual")  # the last has no period type
    assert by[4] == (1, "us-gaap:A", "annual") and by[1] == (11, "us-gaap:A", "quarterly")
    assert by[2] == (0, "co:X", "annual") and by[5] == (10, "co:X", "quarterly")


def test_headers_of_a_parent_are_read_by_name(spark):
    k = F.col("id")
    dims = spark.range(40).select(k.alias("row"), F.lit(1).alias("cik"), F.when(k < 36, "P").alias("parent_concept"), F.element_at(F.array(*map(F.lit, ("product lines", "unknown", "", "geo"))), (k % 4 + 1).cast("int")).alias("segment_type"))
    names = F.when(k % 3 == 0, "custom:Regions").when(k % 3 == 1, "custom:ProductLines").otherwise("custom:Lines")
    stored = spark.range(N).select(k.alias("position"), F.lit(1).alias("cik"), F.lit(False).alias("dimensional"), F.lit("P").alias("parent_concept"), names.alias("concept"), F.lit(None).cast("string").alias("segment_type"), F.lit(None).cast("string").alias("parent_header"))
    one = stored.filter("position = 7").withColumn("parent_concept", F.lit("Q"))
    asked = dims.unionByName(dims.filter("row = 1").withColumns({"row": F.lit(100).cast("bigint"), "parent_concept": F.lit("Q")}))
    out = dimensions.inferred_headers(asked, stored.unionByName(one), ["cik"])
    got, most = joined_rows(out)
    by = {r["row"]: r["parent_header"] for r in got}
    assert len(got) == 41 and most <= 41
    assert by[0] == "custom:ProductLines" and by[1] is None and by[2] is None and by[3] == "custom:GeographicSegmentation"
    assert by[100] == "custom:ProductLines" and by[36] == "custom:ProductSegmentation" and by[37] is None
    # No list of all stored headers goes with every row.
    assert "collect_list" not in out._jdf.queryExecution().optimizedPlan().toString()


WANTED = "cik int, row long, member string, parent_id long, signature string, parent_header string, label string, parent_name string, alias_target string, path string, order_key string"
STORED = "cik int, id long, concept string, aliases array<string>, parent_id long, signature string, parent_header string, label string, path string, concept_name string, order_key string, dimensions map<string,string>"


def members(seed, n):
    """Wanted and stored members of few names, labels and places, some of them NULL or empty."""
    r = random.Random(seed)
    wanted = [(r.choice([1, 2, None]), k, r.choice(["a", "b", "x_a", "c", None]), r.choice([1, 2, None]), r.choice(["brand=a", "brand=b", None]), r.choice(["H", "", None]), r.choice(["L", "M [Member]", "", None]), r.choice(["P", "Q", None]), r.choice(["a", "t", "", None]), r.choice(["001", "002", "", None]), r.choice(["a", "b", "", None])) for k in range(n)]
    stored = [(r.choice([1, 2, None]), k, r.choice(["a", "b", "x_a", "old_x_b"]), r.choice([["a"], ["t", "b"], [], None]), r.choice([1, 2, None]), r.choice(["brand=a", "brand=b", None]), r.choice(["H", "", None]), r.choice(["L", "L ", "M", "", None]), r.choice(["001", "002", "404.001", "", None]), r.choice(["P", "Q", None]), r.choice(["a", "b", "", None]), {"co:BrandAxis": r.choice(["a", "b"])}) for k in range(n)]
    return wanted, stored


def frames(spark, seed, n):
    return spark.createDataFrame(members(seed, n)[0], WANTED), spark.createDataFrame(members(seed, n)[1], STORED)


def names_of(concept, aliases):
    parts = concept.split("_")
    return {"_".join(parts[k:]) for k in range(len(parts))} | set(aliases or [])


def cleaned(label):
    text = label.strip() if label is not None else None
    return text.removesuffix(" [Member]") if text else text


def resolved_plainly(wanted, stored):
    out = {}
    for cik, row, member, parent, signature, header, label, *_ in wanted:
        tries = []
        for s_cik, s_id, concept, aliases, s_parent, s_signature, s_header, s_label, path, *_ in stored:
            if cik is None or cik != s_cik or (header or "") != (s_header or "") or not (parent is None or parent == s_parent):
                continue
            if member in names_of(concept, aliases) and (signature is None or signature == s_signature):
                tries.append((0, s_id))
            elif member in names_of(concept, aliases) and s_signature is None:
                tries.append((1, s_id))
            if member in (aliases or []):
                tries.append((2, s_id))
            if cleaned(label) and cleaned(label) == cleaned(s_label) and path != "404.001":
                tries.append((3, s_id))
        if tries:
            p, s_id = min(tries)
            out[row] = (s_id, ["slice", "legacy", "alias", "label"][p])
    return out


def test_resolution_of_few_names(spark):
    for seed in range(3):
        wanted, stored = members(seed, 120)
        got = {r["row"]: (r["id"], r["how"]) for r in concepts.resolve_dimensional(*frames(spark, seed, 120), ["cik"]).collect()}
        assert got == resolved_plainly(wanted, stored) and got
    rows, most = joined_rows(concepts.resolve_dimensional(*frames(spark, 9, N), ["cik"]))
    assert most <= 4 * N and len({r["row"] for r in rows}) == len(rows)


def strays_plainly(wanted, stored):
    out = {}
    for cik, row, member, _, signature, header, label, parent_name, *_ in wanted:
        if None in (cik, member, signature, parent_name):
            continue
        same = [s for s in stored if s[0] == cik and member in names_of(s[2], s[3]) and signature == f"brand={s[11]['co:BrandAxis']}" and (s[6] or "") == (header or "") and s[9] == parent_name and s[8] != "404.001"]
        hit = [s for s in same if label is not None and s[7] is not None and cleaned(s[7]) == cleaned(label)]
        if same:
            out[row] = hit or same
    return out


def test_strays_are_joined_once(spark):
    for seed in range(3):
        wanted, stored = members(seed, 150)
        got = {(r["row"], r["id"], r["path"], r["order_key"], r["label"]) for r in concepts.drifted(*frames(spark, seed, 150), ["cik"]).collect()}
        assert got == {(row, s[1], s[8], s[10], s[7]) for row, ss in strays_plainly(wanted, stored).items() for s in ss} and got
    k = F.col("id")
    one = spark.range(N).select(k, k.alias("row"), *[F.lit(v).alias(c) for c, v in (("cik", 1), ("member", "a"), ("concept", "a"), ("parent_header", "H"), ("parent_name", "P"), ("concept_name", "P"), ("signature", "brand=a"))], F.lit(None).cast("string").alias("path"), F.lit("a").alias("order_key"), k.cast("string").alias("label"), F.array().cast("array<string>").alias("aliases"), F.create_map(F.lit("co:BrandAxis"), F.lit("a")).alias("dimensions"))
    rows, most = joined_rows(concepts.drifted(one, one, ["cik"]))
    assert len(rows) == N and most <= N


def targets_plainly(wanted, stored):
    out = {}
    for cik, row, _, parent, _, header, _, _, target, *_ in wanted:
        found = [(bool(header) and header != (s[6] or ""), s[1]) for s in stored if cik is not None and s[0] == cik and target and target in {s[2], *(s[3] or [])} and (parent is None or parent == s[4])]
        found = [x for x in found if not x[0] or parent is not None]
        if found:
            out[row] = min(found)[1]
    return out


def placed_plainly(wanted, stored):
    targets, found, strays, out = targets_plainly(wanted, stored), resolved_plainly(wanted, stored), strays_plainly(wanted, stored), {}
    for w in wanted:
        row, path, order = w[1], w[9], w[10]
        own, how = targets.get(row), "target"
        if own is None:
            own, how = found.get(row, (None, None))
        if row in strays and own not in {s[1] for s in strays[row]}:
            here = [s[1] for s in strays[row] if path and s[8] == path and (not order or s[10] == order)]
            own, how = here[0] if len(here) == 1 else min(s[1] for s in strays[row]), "drift"
        out[row] = (own, how, "create" if own is None else "reuse")
    return out


def merged_plainly(wanted, stored):
    label, placed, strays, out = {s[1]: cleaned(s[7]) for s in stored}, placed_plainly(wanted, stored), strays_plainly(wanted, stored), {}
    for row, ss in strays.items():
        winner = placed[row][0]
        for s in ss:
            if winner is not None and s[1] != winner and not s[8] and cleaned(s[7]) == label[winner]:
                out[s[1]] = min(winner, out.get(s[1], winner))
    return out


def test_placement_and_copies_of_few_names(spark):
    for seed, n in ((0, 150), (1, 150), (2, 400)):
        wanted, stored = members(seed, n)
        placed = concepts.place_dimensional(*frames(spark, seed, n), ["cik"]).cache()
        assert {r["row"]: (r["id"], r["how"], r["action"]) for r in placed.collect()} == placed_plainly(wanted, stored)
        pairs = concepts.duplicate_dimensions(*frames(spark, seed, n), placed, ["cik"])
        assert {r["loser"]: r["winner"] for r in pairs.collect()} == merged_plainly(wanted, stored)
    assert merged_plainly(wanted, stored)
    rows, most = joined_rows(concepts.place_dimensional(*frames(spark, 9, N), ["cik"]))
    assert len(rows) == N and most <= 4 * N
    rows, most = joined_rows(concepts.duplicate_dimensions(*frames(spark, 2, 400), placed, ["cik"]))
    assert rows and most <= 4 * 400


def test_next_members_of_few_names(spark):
    wanted, stored = frames(spark, 9, N)
    rows, most = joined_rows(concepts.next_dimensions(wanted, stored, concepts.place_dimensional(wanted, stored, ["cik"])))
    assert sorted(r["id"] for r in rows) == list(range(N)) and most <= 4 * N


def test_batch_is_placed_by_its_last_questions(spark):
    kept = ["id", "concept", "aliases", "label", "path", "order_key", "parent_id", "concept_name", "signature", "parent_header"]
    for seed, n in ((0, 150), (1, 400)):
        wanted, stored = frames(spark, seed, n)
        apart = concepts.next_dimensions(wanted, stored, concepts.place_dimensional(wanted, stored, ["cik"]))
        together = concepts.after_batch(wanted, stored, ["cik"])
        assert sorted(map(str, together.select(*kept).collect())) == sorted(map(str, apart.select(*kept).collect()))


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")
def test_next_dimensions_reads_the_batch_once(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # equal exchanges are one in the plan at once
    try:
        plan = catalogue.queries()["next_dimensions"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(re.findall(r"FileScan parquet \[o_orderkey", plan)) == 1 and len(re.findall(r"FileScan parquet \[c_custkey", plan)) <= 2
