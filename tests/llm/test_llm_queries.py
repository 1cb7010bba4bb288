"""The registered queries and the pipeline."""

import glob
import os
import re

import duckdb
import pytest
from sentencepiece import SentencePieceProcessor
from test_llm_dedup import brute

import corpus_pipeline
from factlake.llm import langid, mixing, queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")


def plain(rows):
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    cur = con.execute(queries.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    got = queries.queries()[name](spark, SF).select(*names).collect()
    assert plain(got) == plain(cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(queries.oracle_sql())))
def test_one_row_per_document(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.queries()[name](spark, SF)
    assert sorted(r["doc_id"] for r in got.select("doc_id").collect()) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())


def test_pipeline_stages_take_effect(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "MinHash near-dedup", "mixing", "SentencePiece"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10**6, None, "en", "a", 0), (10**6 + 1, "123 ?!", "en", "a", 0), (10**6 + 2, None, None, None, None)], docs.schema)
    at = docs.unionByName(extra)
    ids = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        at = stage(spark, at, SF)
        if k < 4:
            assert at.columns == docs.columns
        at = spark.createDataFrame(at.collect(), at.schema)
        ids[name] = [r["doc_id"] for r in at.collect()]
    assert not set(ids["language ID"]) & {10**6, 10**6 + 1, 10**6 + 2}
    assert set(ids["language ID"]) == {r["doc_id"] for r in langid.languages(docs).collect() if not r["rejected"]}
    kept = {r["doc_id"] for r in queries.op5_exact_dedup(spark, SF).collect() if r["kept"]}
    assert set(ids["exact dedup"]) <= kept
    near = {r["doc_id"] for r in queries.op7_minhash(spark, SF).collect()}
    assert set(ids["MinHash near-dedup"]) <= near and len(set(ids["MinHash near-dedup"])) == len(ids["MinHash near-dedup"])
    assert set(ids["mixing"]) <= set(ids["MinHash near-dedup"]) and len(ids["mixing"]) > len(set(ids["mixing"]))
    assert sorted(ids["mixing"]) == sorted(ids["SentencePiece"])


COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def through(spark, docs, upto):
    for name, stage in corpus_pipeline.STAGES[1:]:
        docs = stage(spark, docs, SF)
        if name == upto:
            return docs
    return None


def test_rows_that_share_an_id_are_judged_apart(spark):
    rows = [(1, "alpha beta gamma"), (1, "other text here"), (2, "alpha  beta gamma"), (None, "alpha beta gamma"), (None, "third text"), (3, "third text"), (3, "third text"), (4, "fourth")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], COLUMNS)
    exact = corpus_pipeline.exact_duplicates(spark, docs, SF)
    assert exact.columns == docs.columns
    got = sorted((r["doc_id"], r["text"]) for r in exact.collect())
    assert got == [(1, "other text here"), (2, "alpha  beta gamma"), (3, "third text"), (4, "fourth")]
    ws = [f"w{k}" for k in range(60)]
    near = [(7, " ".join(ws)), (7, "something else altogether"), (7, None), (None, " ".join([*ws[:-1], "new"])), (5, " ".join([*ws[:-2], "new", "newer"])), (8, " ".join(f"v{k}" for k in range(60)))]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in near], COLUMNS)
    got = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    assert sorted((r["doc_id"], (r["text"] or "")[:9]) for r in got) == [(5, "w0 w1 w2 "), (7, ""), (7, "something"), (8, "v0 v1 v2 ")]
    mixed = corpus_pipeline.source_mix(spark, docs.filter("text is not null"), SF)
    assert mixed.columns == docs.columns
    assert sorted({(r["doc_id"] or 0, r["text"]) for r in mixed.collect()}) == sorted((i or 0, t) for i, t in near if t)


def test_stages_of_nothing_and_with_clashing_columns(spark):
    schema = COLUMNS + ", row_of_stage string, row_of_stage_copies int, size string, kept string, rep int, h string, letter int, taken string, target int, source_idx int, row_id string, tokens string, n_tokens int, label int, cluster int"
    extra = (None, 1, "x", "y", 2, "h", 3, "t", 4, 5, "r", "k", 6, 7, 8)
    rows = [(k, f"the text number {k} with some more words in it " * (k % 3 + 1), "en", "s", 0, *extra) for k in range(30)] + [(30, None, None, None, None, *extra), (31, "", "en", "s", 0, *extra)]
    docs = spark.createDataFrame(rows, schema)
    for table in (docs, docs.filter("false")):
        at = table
        for name, stage in corpus_pipeline.STAGES:
            at = stage(spark, at, SF)
            if name != "SentencePiece":
                assert at.columns == docs.columns, name
            at = spark.createDataFrame(at.collect(), at.schema)
        n = at.count()
        assert n if table is docs else n == 0


def test_rows_of_files_are_numbered_in_place(spark, tmp_path):
    from factlake.llm.workspace import numbered

    rows = spark.range(1000).selectExpr("id % 7 as doc_id", "cast(id as string) as text", "1 as _at")
    rows.repartition(6).write.parquet(str(tmp_path / "t"))
    docs = spark.read.parquet(str(tmp_path / "t"))
    for frame in (docs, docs.filter("doc_id < 5"), rows):
        got = numbered(frame, "r")
        assert got.columns == [*frame.columns, "r"]
        seen = {x["text"]: x["r"] for x in got.collect()}
        assert len(set(seen.values())) == len(seen) == frame.count()
        assert seen == {x["text"]: x["r"] for x in got.coalesce(1).filter("r >= 0").collect()}
    assert numbered(docs.filter("false"), "r").count() == 0


def test_pipeline_as_brute_force(spark):
    """Every stage over the whole driver table against plain Python, from the rows that the stage before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    at, kept = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, SF)
        kept[name] = [(r["doc_id"], r["text"]) for r in at.collect()]
        at = spark.createDataFrame(at.collect(), at.schema)
    best = {}
    for i, t in kept["language ID"]:
        norm = re.sub(r"[\x20\x09-\x0D]", "", t)
        if norm not in best or (-len(t), i) < best[norm][0]:
            best[norm] = ((-len(t), i), (i, t))
    assert sorted(kept["exact dedup"]) == sorted(x for _, x in best.values())
    of = brute(kept["exact dedup"])
    assert sorted(i for i, _ in kept["MinHash near-dedup"]) == sorted(i for i, (_, c) in of.items() if i == c)
    sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in kept["MinHash near-dedup"]}
    mixed = mixing.mix(spark.createDataFrame([(i, t, s) for i, t, s in ((r["doc_id"], r["text"], r["source"]) for r in docs.collect()) if i in sizes], "doc_id bigint, text string, source string")).collect()
    want = [r["doc_id"] for r in mixed for _ in range(int(r["taken"] / r["size"] + 0.5))]
    assert sorted(i for i, _ in kept["mixing"]) == sorted(want)
    lib = SentencePieceProcessor(model_file=queries.tokenizer_path("piece_bpe_32k.model"))
    got = corpus_pipeline.sentencepiece(spark, at, SF).collect()
    assert sorted((r["doc_id"], tuple(r["tokens"])) for r in got) == sorted((i, tuple(lib.encode(t))) for i, t in kept["mixing"])
