import gzip
import json

from pyspark.sql import functions as F

from factlake.sources import files
from factlake.streaming import queue


def test_submissions_and_facts(spark, tmp_path):
    sub = {"cik": "320193", "name": "A", "tickers": ["AAA"], "exchanges": ["X"], "sic": "1", "fiscalYearEnd": "0930", "filings": {"recent": {"form": ["10-K", "8-K"], "accessionNumber": ["0000320193-24-000001", "b"], "filingDate": ["2024-11-01", "bad"], "reportDate": ["2024-09-28", ""], "isXBRL": [1, 0], "primaryDocument": ["a.htm", "b.htm"]}}}
    (tmp_path / "s.json").write_text(json.dumps(sub, indent=1))
    companies, filings = files.company_submissions(spark, str(tmp_path / "s.json"))
    assert companies.first()["cik"] == "0000320193"
    assert [(r["form"], r["is_xbrl"], str(r["filing_date"])) for r in filings.orderBy("form").collect()] == [("10-K", True, "2024-11-01"), ("8-K", False, "None")]
    facts = {"cik": 320193, "entityName": "A", "facts": {"us-gaap": {"Revenues": {"label": "R", "units": {"USD": [{"start": "2023-01-01", "end": "2023-12-31", "val": 5.0, "accn": "x", "fy": 2023, "fp": "FY", "form": "10-K"}]}}}}}
    (tmp_path / "f.json").write_text(json.dumps(facts))
    row = files.company_facts(spark, str(tmp_path / "f.json")).first()
    assert (row["tag"], row["unit"], row["val"], str(row["end"])) == ("us-gaap:Revenues", "USD", 5.0, "2023-12-31")


def test_archive_ledger_labels(spark, tmp_path):
    html = tmp_path / "html"
    html.mkdir()
    with gzip.open(html / "acc1.html.gz", "wt") as f:
        f.write("<p>gz</p>")
    (html / "acc1.htm").write_text("<p>plain</p>")
    (html / "acc2.htm").write_text("<p>two</p>")
    assert {r["accession"]: r["html"] for r in files.html_archive(spark, str(html)).collect()} == {"acc1": "<p>gz</p>", "acc2": "<p>two</p>"}
    files.append_ledger(spark.createDataFrame([("a", "saved")], "accession string, status string"), str(tmp_path / "ledger"))
    (tmp_path / "ledger" / "part-broken.json").write_text("{broken\n")
    assert [tuple(r) for r in files.ledger(spark, str(tmp_path / "ledger"), "accession string, status string").collect()] == [("a", "saved")]
    labels = spark.createDataFrame([("c", "label", "en-US", 2023, "Old"), ("c", "label", "en-US", 2024, "New"), ("c", "label", "de", 2025, "Neu")], files.LABEL_SCHEMA)
    assert files.newest_labels(labels).first()["label"] == "New"
    (tmp_path / "ids.txt").write_text("aapl\n# no\n\nmsft\nAAPL\n")
    assert sorted(r[0] for r in files.identifiers(spark, str(tmp_path / "ids.txt")).collect()) == ["AAPL", "MSFT"]


def test_queue_stream(spark, tmp_path):
    jobs = [{"job_id": "1", "filing_type": "10-K", "attempts": 0, "failed": False}, {"job_id": "2", "filing_type": "10-Q", "attempts": 0, "failed": True}, {"job_id": "3", "filing_type": "10-Q", "attempts": 2, "failed": True}, {"job_id": "4", "filing_type": "8-K", "attempts": 0}]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(map(json.dumps, jobs)) + "\nnot json\n")
    out = str(tmp_path / "out")
    for _ in range(3):  # the second run finds the job to retry, the third nothing
        q = queue.run_queue(spark, str(tmp_path / "in"), out, str(tmp_path / "ck"))
        q.awaitTermination(120)
        assert q.exception() is None
    rows = spark.read.option("basePath", out).parquet(f"{out}/batch=*")
    got = sorted(((r["job_id"] or "", r["route"], r["attempts"]) for r in rows.collect()))
    assert got == [("", "invalid", 0), ("1", "done", 0), ("2", "done", 1), ("2", "retry", 1), ("3", "dead", 3), ("4", "skipped", 0)]


def test_watermark_stream(spark, tmp_path):
    rows = [("2024-01-01 00:00:00", "a", 1.0), ("2024-01-01 00:01:00", "a", 2.0), ("2024-01-01 01:00:00", "b", 3.0)]
    spark.createDataFrame(rows, "t string, event_type string, value double").select(F.to_timestamp("t").alias("ts"), "event_type", "value").write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema("ts timestamp, event_type string, value double").parquet(str(tmp_path / "e"))
    q = queue.windowed_counts(stream).writeStream.outputMode("append").format("memory").queryName("counts").option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        q.processAllAvailable()
        assert [(r["event_type"], r["n"], r["total"]) for r in spark.sql("SELECT * FROM counts").collect()] == [("a", 2, 3.0)]
    finally:
        q.stop()
