"""The rankers of candidate files and the test of a filing without XBRL."""

from pyspark.sql import functions as F

from factlake.sources import files

HTML = [("abc-20240101.htm", 100), ("abc-10k_20180630.htm", 90), ("000032019324000123.htm", 80), ("d827041d10q.htm", 70), ("form10k.htm", 65), ("doc1234567.htm", 40), ("acme-report.htm", 50), ("r12.htm", 5), ("abcex99.htm", 0), ("main.html", 0), ("my_10-k_filing.htm", 55), ("abc-20240101.HTM", 100), ("XYZ_document.htm", 40), ("index.htm", 0), (None, None)]
SEC = [("abc-20240101_htm.xml", 115), ("instance.xml", 100), ("0000320193-24-000123.xml", 70), ("0000320193-24-000123.txt", 50), ("abc-20240101_lab.xml", 0), ("other.xml", 50), ("a.htm", 0), ("filing_document.txt", 50), ("ABC-20240101.xml", 65), ("schema.xml", 0), (None, None)]
URLS = [(None, None, True), ("", "t", True), ("x/a.TXT", None, True), ("x/a", "x/a", True), ("x/a_htm.xml", "x/a.txt", False), ("x/a_htm.xml", None, False)]


def test_html_rank(spark):
    df = spark.createDataFrame(HTML, "name string, score int").withColumn("got", files.html_file_score(F.col("name"), F.lit("0000320193-24-000123")))
    assert [r["name"] for r in df.collect() if r["got"] != r["score"]] == []


def test_processors_rank(spark):
    df = spark.createDataFrame(SEC, "name string, score int").withColumn("got", files.sec_file_score(F.col("name")))
    assert [r["name"] for r in df.collect() if r["got"] != r["score"]] == []


def test_text_fallback(spark):
    df = spark.createDataFrame(URLS, "x string, t string, want boolean").withColumn("got", files.txt_fallback(F.col("x"), F.col("t")))
    assert [tuple(r) for r in df.collect() if r["got"] is not r["want"]] == []
