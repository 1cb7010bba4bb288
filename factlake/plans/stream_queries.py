"""Batch forms of the queue and window operators, and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import files
from ..streaming import queue
from .registry import query, table
from .tables import cents


def _jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    job = F.to_json(F.struct(k.cast("string").alias("job_id"), F.when(k % 7 == 0, "8-K").otherwise("10-Q").alias("filing_type"), (k % 4).cast("int").alias("attempts"), (F.col("event_type") == "error").alias("failed")))
    return e.select(F.when(k % 100 == 99, F.lit("{broken")).otherwise(job).alias("value"), "event_id")


@query("""WITH j AS (SELECT CASE WHEN event_id % 100 = 99 THEN 'invalid' WHEN event_id % 7 = 0 THEN 'skipped' WHEN event_type <> 'error' THEN 'done' WHEN event_id % 4 + 1 < 3 THEN 'retry' ELSE 'dead' END AS route, event_id % 4 AS a, event_id FROM events)
SELECT route, CASE WHEN route = 'invalid' THEN 0 WHEN route IN ('retry', 'dead') THEN a + 1 ELSE a END::BIGINT AS attempts, count(*) AS n FROM j GROUP BY ALL""")
def queue_retry_dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The routes"""
    done = queue.routed(queue.parsed(_jobs(spark, sf_dir)))
    return done.groupBy("route", F.col("attempts").cast("bigint").alias("attempts")).agg(F.count("*").alias("n"))


@query("""SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY epoch_us(ts) RANGE BETWEEN 600000000 PRECEDING AND CURRENT ROW) AS used,
  count(*) OVER (PARTITION BY event_type ORDER BY epoch_us(ts) RANGE BETWEEN 600000000 PRECEDING AND CURRENT ROW) > 2 AS over FROM events""")
def sliding_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N05"""
    return queue.sliding_budget(table(spark, sf_dir, "events"), ["event_type"], 600, 2).select("event_id", "used", "over")


@query("""WITH g AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) <= 36000000000 THEN 0 ELSE 1 END AS fresh FROM events),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM g) SELECT user_id, session::BIGINT AS session, epoch_us(min(ts)) AS first, epoch_us(max(ts)) AS last, count(*) AS n FROM s GROUP BY user_id, session""")
def session_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of a stream: gaps of ten hours"""
    s = queue.sessions(table(spark, sf_dir, "events"), ["user_id"], 36_000)
    return s.select("user_id", "session", F.unix_micros(F.col("first").cast("timestamp")).alias("first"), F.unix_micros(F.col("last").cast("timestamp")).alias("last"), "n")


@query("""SELECT epoch_us(time_bucket(INTERVAL 5 MINUTES, ts)) AS start, event_type, count(*) AS n, sum(round(value * 100)::BIGINT)::BIGINT AS total FROM events GROUP BY ALL""")
def windowed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling windows of five minutes with a watermark (batch form)"""
    e = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", cents("value").alias("value"))
    return queue.windowed_counts(e).select(F.unix_micros("window.start").alias("start"), "event_type", "n", "total")


@query("""SELECT l_orderkey, sum(round(l_extendedprice * 100)::BIGINT) FILTER (l_returnflag = 'A')::BIGINT AS "A", sum(round(l_extendedprice * 100)::BIGINT) FILTER (l_returnflag = 'N')::BIGINT AS "N", sum(round(l_extendedprice * 100)::BIGINT) FILTER (l_returnflag = 'R')::BIGINT AS "R" FROM lineitem GROUP BY l_orderkey""")
def pivot_statement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without dimensions"""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", cents("l_extendedprice").alias("v"))
    return files.pivoted(li, ["l_orderkey"], "l_returnflag", "v", ["A", "N", "R"])


@query("""SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 145 WHEN 1 THEN 110 WHEN 2 THEN 80 WHEN 3 THEN 0 WHEN 4 THEN 30 ELSE 60 END::BIGINT AS score FROM customer""")
def candidate_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A07"""
    k = F.col("c_custkey") % 6
    acc = "0000320193-24-000123"
    name = F.when(k == 0, f"{acc}_htm.xml").when(k == 1, "abc-20240101.htm").when(k == 2, f"{acc}.xml").when(k == 3, "FilingSummary.xml").when(k == 4, "notes.txt").otherwise("other.xml")
    return table(spark, sf_dir, "customer").select("c_custkey", files.xbrl_file_score(name, F.lit(acc)).cast("bigint").alias("score"))


@query("""SELECT c_custkey, CASE c_custkey % 11 WHEN 0 THEN 100 WHEN 1 THEN 90 WHEN 2 THEN 80 WHEN 3 THEN 70 WHEN 4 THEN 65 WHEN 5 THEN 40 WHEN 6 THEN 50 WHEN 7 THEN 5 WHEN 8 THEN 0 WHEN 9 THEN 0 WHEN 10 THEN 55 END::BIGINT AS score FROM customer""")
def candidate_html_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A08"""
    k = F.col("c_custkey") % 11
    name = F.when(k == 0, "abc-20240101.htm").when(k == 1, "abc-10k_20180630.htm").when(k == 2, "000032019324000123.htm").when(k == 3, "d827041d10q.htm").when(k == 4, "form10k.htm").when(k == 5, "doc1234567.htm").when(k == 6, "acme-report.htm").when(k == 7, "r12.htm").when(k == 8, "abcex99.htm").when(k == 9, "main.html").otherwise("my_10-k_filing.htm")
    return table(spark, sf_dir, "customer").select("c_custkey", files.html_file_score(name, F.lit("0000320193-24-000123")).cast("bigint").alias("score"))


@query("""SELECT c_custkey, CASE c_custkey % 8 WHEN 0 THEN 115 WHEN 1 THEN 100 WHEN 2 THEN 70 WHEN 3 THEN 50 WHEN 4 THEN 0 WHEN 5 THEN 50 WHEN 6 THEN 0 WHEN 7 THEN 50 END::BIGINT AS score FROM customer""")
def candidate_sec_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A09"""
    k = F.col("c_custkey") % 8
    name = F.when(k == 0, "abc-20240101_htm.xml").when(k == 1, "instance.xml").when(k == 2, "0000320193-24-000123.xml").when(k == 3, "0000320193-24-000123.txt").when(k == 4, "abc-20240101_lab.xml").when(k == 5, "other.xml").when(k == 6, "a.htm").otherwise("filing_document.txt")
    return table(spark, sf_dir, "customer").select("c_custkey", files.sec_file_score(name).cast("bigint").alias("score"))


@query("""SELECT c_custkey, c_custkey % 5 <> 4 AS fallback FROM customer""")
def txt_fallbacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No address, an empty one, a text file, the submission's own address, an instance"""
    k = F.col("c_custkey") % 5
    xbrl = F.when(k == 1, "").when(k == 2, "a/b.TXT").when(k == 3, "a/sub").when(k == 4, F.concat(F.lit("a/"), F.col("c_custkey").cast("string"), F.lit("_htm.xml")))
    return table(spark, sf_dir, "customer").select("c_custkey", files.txt_fallback(xbrl, F.when(k == 3, "a/sub")).alias("fallback"))


@query("""WITH a AS (SELECT o_custkey, o_orderdate::DATE AS d, o_orderkey FROM orders WHERE o_orderkey % 2 = 0), b AS (SELECT o_custkey, year(o_orderdate) AS y, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS amendment FROM orders WHERE o_orderkey % 2 = 1 GROUP BY ALL)
SELECT o_orderkey, amendment FROM a LEFT JOIN b ON a.o_custkey = b.o_custkey AND year(a.d) = b.y""")
def amendment_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10"""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("cik"), F.year("o_orderdate").alias("report"), F.when(F.col("o_orderkey") % 2 == 0, "10-K").otherwise("10-K/A").alias("form"), F.col("o_orderdate").alias("filed"))
    return files.amendments(o, "o_orderkey").select("o_orderkey", "amendment")
