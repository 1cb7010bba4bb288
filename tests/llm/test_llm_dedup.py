"""Exact and near deduplication, components and mixing against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from factlake.llm import exact_dedup, minhash, mixing
from factlake.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, cluster string, rep string, h128 int"


def table(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, None, s, 0, "x", "y", "z", 1) for i, t, s in rows], SCHEMA)


def words(n, seed, of=5000):
    r = random.Random(seed)
    return [f"w{r.randrange(of)}" for _ in range(n)]


def edited(ws, share, seed):
    r = random.Random(seed)
    return [f"e{r.randrange(10**6)}" if r.random() < share else w for w in ws]


def odd_rows():
    return [
        (1, "a b c d e f g", "s"), (2, "a  b\tc d e\nf g", "s"), (3, None, None), (4, "", "s"), (5, " \n\t ", "s"), (6, "one", "t"), (7, "One", "t"),
        (8, "é 日本 😀", "t"), (9, "x\x0by\x0cz", None), (10, " ".join(words(30000, 1)), "u"), (11, " ".join(words(30000, 1)), "u"), (6, "one", "t"),
    ]


def test_exact_dedup(spark):
    rows = odd_rows()
    groups: dict[str, list] = {}
    for i, t, _ in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((i, t or ""))
    want = []
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0]))[0]
        want += [(i, keep, len(members), i == keep, hashlib.sha256(norm.encode()).hexdigest()) for i, _ in members]
    got = exact_dedup.exact_dedup(table(spark, rows)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_exact_dedup_of_nothing(spark):
    assert exact_dedup.exact_dedup(table(spark, [])).count() == 0


def test_exact_dedup_survives_hash_collisions(spark):
    rows = [(k, f"text {k % 7}", "s") for k in range(40)]
    weak = exact_dedup.exact_dedup(table(spark, rows), hash_of=lambda c: F.substring(F.md5(c), 1, 0))
    assert {r["doc_id"]: r["keep_id"] for r in weak.collect()} == {k: k % 7 for k in range(40)}


def test_exact_dedup_extreme_and_missing_ids(spark):
    rows = [(-(2**63), "t", "s"), (2**63 - 1, "t", "s"), (None, "t", "s"), (None, "only", "s")]
    got = {(r["doc_id"], r["text_sha256"][:4]): (r["keep_id"], r["kept"]) for r in exact_dedup.exact_dedup(table(spark, rows)).collect()}
    t, only = (hashlib.sha256(x.encode()).hexdigest()[:4] for x in ("t", "only"))
    assert got == {(-(2**63), t): (-(2**63), True), (2**63 - 1, t): (-(2**63), False), (None, t): (-(2**63), False), (None, only): (None, True)}


def brute(rows):
    sets = {}
    for i, t in rows:
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
                    x, y = root(a), root(b)
                    up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def family_rows():
    rows = list(odd_rows()[:11])
    at = 100
    for f in range(6):
        base = words(120 + 40 * f, 50 + f)
        rows.append((at + 57, " ".join(base), "s"))
        for k in range(14):
            rows.append((at + k, " ".join(edited(base, 0.004 * (k % 8), at + k)), "s"))
        at += 100
    passage = words(60, 7)
    rows += [(2000 + k, " ".join(words(60, 3000 + k) + passage + words(50, 4000 + k)), "s") for k in range(60)]
    rows += [(3000 + k, " ".join(words(200, 5000 + k)), "s") for k in range(40)]
    return rows


@pytest.mark.parametrize("banding", [minhash.Banding(), minhash.Banding(block=8, block_shingles=700, tile=5)])
def test_near_duplicates(spark, banding):
    rows = family_rows()
    want = brute([(i, t) for i, t, _ in rows])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(table(spark, rows), banding).collect()}
    assert got == want


def test_a_large_family_of_edits(spark):
    """Many copies of one text, most pairs under the threshold, joined through a few."""
    base = words(150, 99)
    rows = [(k, " ".join(edited(base, 0.02, 10_000 + k)), "s") for k in range(150)]
    want = brute([(i, t) for i, t, _ in rows])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(table(spark, rows), minhash.Banding(block=32, block_shingles=3000, tile=16)).collect()}
    assert got == want


def test_dominant_clusters_change_no_component(spark):
    """Outliers that a bucket's dominant cluster takes in are decided by full sets, as without it."""
    base = words(120, 5)
    rows = [(k, " ".join(edited(base, 0.003 * (k % 4), 500 + k)), "s") for k in range(60)]
    rows += [(100 + k, " ".join(base[: 30 + 2 * k] + words(90 - 2 * k, 700 + k)), "s") for k in range(45)]
    want = {i: c for i, (_, c) in brute([(i, t) for i, t, _ in rows]).items()}
    for dominant in (2, 8, 10**9):
        got = minhash.near_duplicates(table(spark, rows), minhash.Banding(dominant=dominant, dominant_share=0.5, block_shingles=2000, tile=8))
        assert {r["doc_id"]: r["component_id"] for r in got.collect()} == want


def test_rows_that_share_an_id_are_one_node(spark):
    a, c = words(40, 1), words(40, 2)
    rows = [(1, " ".join(a), "s"), (5, " ".join(a), "s"), (5, " ".join(c), "s"), (5, None, "s"), (7, " ".join(c), "s"), (7, " ".join(c), "s"), (9, "other", "s"), (9, "text", "s")]
    got = sorted((r["doc_id"], r["component_id"]) for r in minhash.near_duplicates(table(spark, rows)).collect())
    assert got == [(1, 1), (5, 1), (5, 1), (5, 1), (7, 1), (7, 1), (9, 9), (9, 9)]


def test_near_duplicates_of_nothing_and_repeats(spark):
    assert minhash.near_duplicates(table(spark, [])).count() == 0
    got = minhash.near_duplicates(table(spark, [(1, None, "s"), (2, "", "s"), (3, " ", "s"), (None, "a b", "s"), (4, "a b", "s"), (4, "a b", "s")]))
    by = {r["doc_id"]: r for r in got.collect()}
    assert [by[k]["component_id"] for k in (1, 2, 3, 4)] == [1, 2, 3, 4]
    assert by[None]["kept"] and by[None]["component_id"] is None
    assert got.count() == 6


def test_components(spark):
    r = random.Random(5)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1040)] + [(5000, 5000 + k) for k in range(1, 200)]
    up = {}

    def root(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    nodes = {x for ab in links for x in ab}
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert got == {x: root(x) for x in nodes if root(x) != x}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def fair_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s: most * sizes[s] for s in free if share[s] > most * sizes[s]}
        if not over:
            return capped | share
        capped |= over


def test_mixing(spark):
    r = random.Random(2)
    rows = [(k, " ".join(words(r.randrange(0, 120), k)), r.choice(["a", "a", "a", "b", "c", "é", None, "tiny"] if k % 50 else ["tiny"])) for k in range(700)]
    rows += [(9000, None, "a"), (9001, "", "empty"), (9002, " ".join(words(30_000, 8)), "long")]
    size = {k: len(WORD.findall(t or "")) for k, t, _ in rows}
    per: dict = {}
    for k, _, s in rows:
        per[s] = per.get(s, 0) + size[k]
    want = fair_targets(per)
    docs = table(spark, rows)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    taken: dict = {}
    for x in got:
        assert x["size"] == size[x["doc_id"]]
        assert x["source_size"] == per[x["source"]]
        assert x["target"] == pytest.approx(want[x["source"]], rel=1e-9, abs=1e-6)
        assert 0 <= x["taken"] <= 3 * x["size"]
        taken[x["source"]] = taken.get(x["source"], 0) + x["taken"]
    for s, n in taken.items():
        assert abs(n - want[s]) <= 1
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted((x["doc_id"], x["taken"]) for x in got) == sorted((x["doc_id"], x["taken"]) for x in again)


def taken_by_brute_force(rows, plan, block_words):
    """Words taken from each row: the schedule slot by slot, the blocks word by word."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    hashed = {(x["doc_id"]): x["h"] for x in spark.createDataFrame([(k,) for k, _, _ in rows], "doc_id bigint").select("doc_id", F.xxhash64(F.lit(mixing.SEED), "doc_id").alias("h")).collect()}
    names = sorted(plan, key=lambda s: (s is None, (s or "").encode()))
    need, goal = {}, {}
    for s in names:
        size, target = plan[s]
        goal[s] = int(target)
        full, rest = divmod(goal[s], size) if size else (0, 0)
        need[s] = full * -(-size // block_words) + -(-rest // block_words) if size else 0
    total, run, upper = sum(need.values()), 0, []
    for s in names:
        run += need[s]
        upper.append(min(run * 2**64 // total, 2**64 - 1))
    slots = {s: [] for s in names}
    for n in range(total):
        point = (n + 1) * mixing.GOLDEN % 2**64
        at = next((k for k, u in enumerate(upper) if point < u), len(names) - 1)
        slots[names[at]].append(n)
    taken = {k: 0 for k, _, _ in rows}
    for s in names:
        order = sorted(((hashed[k] % 2**64, k, n) for k, n, source in rows if source == s and n))
        words_of = [k for _, k, n in order for _ in range(n)]
        size = len(words_of)
        ranks = max(len(slots[s]), need[s])
        for rank in range(min(ranks, need[s])):
            blocks = -(-size // block_words)
            start = rank % blocks * block_words
            count = min(block_words, size - start, goal[s] - (rank // blocks * size + start))
            for k in words_of[start : start + max(0, count)]:
                taken[k] += 1
    return taken


def test_taken_words_per_document(spark):
    r = random.Random(8)
    rows = [(k, " ".join(words(r.choice([0, 3, 17, 40, 200]), k)), r.choice(["a", "b", "b", "c", None])) for k in range(120)]
    got = mixing.mix(table(spark, rows)).collect()
    size = {k: len(WORD.findall(t)) for k, t, _ in rows}
    plan = {x["source"]: (x["source_size"], x["target"]) for x in got}
    block_words = max(1, -(-sum(size.values()) // (mixing.SLOTS_PER_DOC * len(rows))))
    want = taken_by_brute_force([(k, size[k], s) for k, _, s in rows], plan, block_words)
    assert {x["doc_id"]: x["taken"] for x in got} == want


def test_mixing_nothing(spark):
    assert mixing.mix(table(spark, [])).count() == 0
    assert [x["taken"] for x in mixing.mix(table(spark, [(1, None, None), (2, "", "a")])).collect()] == [0, 0]


def test_schedule_spreads_sources(spark):
    plan = spark.createDataFrame([(0, 8000, 8000.0), (1, 4000, 4000.0), (2, 4000, 4000.0)], "source_idx int, source_size bigint, target double")
    slots = [r["source_idx"] for r in mixing.schedule(plan, 10).orderBy("slot").collect()]
    for at in range(0, 1500, 100):  # every stretch of the schedule has nearly the shares
        part = slots[at : at + 100]
        assert abs(part.count(0) - 50) <= 3 and abs(part.count(1) - 25) <= 3
