"""Mixing sources to target weights with a low-discrepancy source schedule.

Slot n of the schedule has the point frac(n * golden ratio), held exactly as a
64-bit integer, which falls into one source's part of the cumulative weights.
The slots of a source are ranked; rank k takes block k mod (blocks of the
source) of the source's shuffled documents, in pass k div (blocks). Blocks have
equal numbers of words, so a long document spans several.

Ranks and word offsets are running counts over all rows. Both are made in two
levels - sums of bounded pieces, a running sum over the pieces, a running sum
inside each - so no task holds a source's rows.

Defined cases: null text has size 0 and is never taken; the null source is a
source and comes last; an empty table gives an empty result; repeated rows are
rows of their own. Documents are ordered by a hash of their id, those with equal
ids by size, and reruns agree; rows without an id have no lasting identity, so
their order (but not their number of words) may differ from run to run. Columns
beyond the three named ones and those carried are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .workspace import ship, stored

WORD = r"[^\x20\x09-\x0D]+"
GOLDEN = 0x9E3779B97F4A7C15  # 2**64 / golden ratio, odd
WEIGHTS = (5.0, 2.0, 1.0)
MOST_REPEATS = 3
SEED = 20240607
SLOTS_PER_DOC = 4
PIECE_ROWS = 4096
PIECE_SLOTS = 1 << 16
#: The plan has a row for each source; up to this many it is broadcast (8 bytes a source and column).
BROADCAST_SOURCES = 10_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_plan(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_REPEATS, share: float = 1.0) -> DataFrame:
    """source, source_idx, source_size, target: one row per source.

    Targets share ``share`` of all words by weight; a target above ``most``
    times its source's size stops there and the excess goes to the others by
    weight. In order of cap over weight the capped sources come first, so the
    fixed point needs running sums only, over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    at = F.row_number().over(by_name) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (at % len(weights) + 1).cast("int"))
    per = per.select("source", "source_size", at.cast("int").alias("source_idx"), w.alias("w"))
    all_rows = Window.partitionBy()
    per = per.withColumns({
        "total": F.sum("source_size").over(all_rows) * F.lit(float(share)),
        "cap": (F.col("source_size") * most).cast("double"),
    })
    order = Window.orderBy((F.col("cap") / F.col("w")).asc(), "source_idx")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    left = F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    per = per.withColumn("capped", left * F.col("w") > F.col("cap") * F.sum("w").over(onward))
    free_words = F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(all_rows), F.lit(0.0))
    free_weight = F.sum(F.when(~F.col("capped"), F.col("w"))).over(all_rows)
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.least("cap", free_words * F.col("w") / free_weight))
    return per.select("source", "source_idx", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def _slots(bounds: bytes):
    """Source of each slot number, from the upper bounds of the sources' parts as 64-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper = np.frombuffer(bounds, np.uint64)
        for b in batches:
            n = b.column(0).to_numpy(zero_copy_only=False).astype(np.uint64)
            idx = np.searchsorted(upper, (n + np.uint64(1)) * np.uint64(GOLDEN), side="right")
            yield pa.record_batch({"slot": n.astype(np.int64), "source_idx": np.minimum(idx, len(upper) - 1).astype(np.int32)})

    return run


def schedule(plan: DataFrame, block_words: int) -> DataFrame:
    """slot, source_idx, rank, block, pass, words: the slots of the mix.

    ``plan`` needs source_idx, source_size and target. A source gets as many
    slots as fill its target; the few that the sequence leaves short (its
    discrepancy) follow at the end, the few beyond the need aren't used. The
    last slot of a source takes what is missing (``words``).
    """
    spark = plan.sparkSession
    ship(spark)
    n_blocks = F.ceil(F.col("source_size") / block_words)
    goal = F.floor("target")
    passes = F.floor(F.try_divide(goal, F.col("source_size")))
    rest = goal - passes * F.col("source_size")
    need = F.when(F.col("source_size") > 0, passes * n_blocks + F.ceil(rest / block_words)).otherwise(0)
    plan = plan.select("source_idx", "source_size", goal.alias("goal"), n_blocks.alias("n_blocks"), need.cast("bigint").alias("need"))
    # One row per source, eight bytes of it in the closure: the size of the mix's description, not of its data.
    needs = plan.orderBy("source_idx").select("need").toArrow()["need"].to_numpy()
    total = int(needs.sum())
    if not total:
        upper = np.zeros(max(1, len(needs)), np.uint64)
    else:
        ends, run = [], 0
        for x in needs.tolist():
            run += x
            ends.append(min(run * 2**64 // total, 2**64 - 1))
        upper = np.array(ends, np.uint64)
    drawn = spark.range(0, total, 1, max(1, min(math.ceil(total / PIECE_SLOTS), 4096))).mapInArrow(_slots(upper.tobytes()), "slot long, source_idx int")
    drawn = stored(drawn.withColumn("piece", F.floor(F.col("slot") / PIECE_SLOTS)), "mix-slots")
    pieces = drawn.groupBy("source_idx", "piece").agg(F.count("*").alias("n"))
    ahead = F.sum("n").over(Window.partitionBy("source_idx").orderBy("piece")) - F.col("n")
    pieces = pieces.select("source_idx", "piece", ahead.alias("ahead"))
    within = F.row_number().over(Window.partitionBy("source_idx", "piece").orderBy("slot")) - 1
    ranked = drawn.withColumn("within", within).join(pieces, ["source_idx", "piece"]).select("slot", "source_idx", (F.col("ahead") + F.col("within")).alias("rank"))
    got = drawn.groupBy("source_idx").agg(F.count("*").alias("got"))
    short = plan.join(got, "source_idx", "left").select("source_idx", "need", F.coalesce("got", F.lit(0)).alias("got")).filter("got < need")
    short = short.select("source_idx", F.explode(F.sequence("got", F.col("need") - 1)).alias("rank"))
    short = short.select((F.lit(total) + F.row_number().over(Window.orderBy("source_idx", "rank")) - 1).alias("slot"), "source_idx", "rank")
    at = ranked.unionByName(short).join(F.broadcast(plan) if len(needs) <= BROADCAST_SOURCES else plan, "source_idx").filter("rank < need")
    at = at.withColumns({"block": F.col("rank") % F.col("n_blocks"), "pass": F.floor(F.col("rank") / F.col("n_blocks"))})
    start = F.col("block") * block_words
    cum = F.col("pass") * F.col("source_size") + start
    words = F.least(F.lit(block_words), F.col("source_size") - start, F.col("goal") - cum)
    return at.select("slot", "source_idx", "rank", "block", "pass", F.greatest(words, F.lit(0)).cast("bigint").alias("words"))


def _shuffled(sizes: DataFrame, n_docs: int) -> DataFrame:
    """Each row's place (in words) in its source's shuffled order."""
    bits = max(1, math.ceil(math.log2(max(2, n_docs / PIECE_ROWS))))
    # Rows without an id are spread by their number, else they would all lie in one piece.
    hashed = F.xxhash64(F.lit(SEED), F.coalesce("doc_id", "row_id"))
    rows = sizes.withColumn("h", hashed).withColumn("piece", F.shiftrightunsigned("h", 64 - bits))
    pieces = rows.groupBy("source_idx", "piece").agg(F.sum("size").alias("n"))
    ahead = F.sum("n").over(Window.partitionBy("source_idx").orderBy("piece")) - F.col("n")
    pieces = pieces.select("source_idx", "piece", ahead.alias("ahead"))
    order = Window.partitionBy("source_idx", "piece").orderBy("h", F.col("doc_id").asc_nulls_first(), "size").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumn("upto", F.sum("size").over(order))
        .join(pieces, ["source_idx", "piece"])
        .select("row_id", "source_idx", "size", (F.col("ahead") + F.col("upto") - F.col("size")).alias("start"))
    )


def mix(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_REPEATS, share: float = 1.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, taken and the columns ``carry``: one row per row of ``docs``.

    ``taken``: words that the schedule takes from the document, repeats counted.
    """
    rows = docs.select(*carry, F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"))
    rows = stored(rows.withColumn("row_id", F.monotonically_increasing_id()), "mix-sizes")
    plan = stored(source_plan(rows, weights, most, share), "mix-plan")
    all_of = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("words"), F.count_distinct("source").alias("sources")).first()
    block_words = max(1, math.ceil(all_of["words"] / max(1, SLOTS_PER_DOC * all_of["n"])))
    few = all_of["sources"] < BROADCAST_SOURCES
    sized = rows.join(F.broadcast(plan) if few else plan, rows["source"].eqNullSafe(plan["source"])).drop(plan["source"])
    placed = _shuffled(sized, all_of["n"])
    cut = placed.filter("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words))))
    begin = F.greatest("start", F.col("block") * block_words) - F.col("block") * block_words
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words) - F.col("block") * block_words
    cut = cut.select("row_id", "source_idx", "block", begin.alias("begin"), end.alias("end"))
    # Every use of a block but a source's last one takes all of it, so uses and the one shorter use say it all.
    uses = schedule(plan, block_words).groupBy("source_idx", "block").agg(F.count("*").alias("uses"), F.min("words").alias("least_words"))
    part = F.greatest(F.least("end", "least_words") - F.col("begin"), F.lit(0))
    taken = cut.join(uses, ["source_idx", "block"]).select("row_id", ((F.col("uses") - 1) * (F.col("end") - F.col("begin")) + part).alias("t"))
    taken = taken.groupBy("row_id").agg(F.sum("t").alias("taken"))
    return sized.join(taken, "row_id", "left").select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"), *carry)
