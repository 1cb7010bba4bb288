"""Job queues as streams: retries, dead letters, budgets over sliding windows, sessions.

A batch of jobs is routed by pure DataFrame functions, so the batch queries and
the streams share them. Streams use ``foreachBatch`` with checkpoints: a batch
that fails is run again, and the tables it writes are keyed by batch, so the
second run replaces the first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# --- fixed values -----------------------------------------------------------
MOST_ATTEMPTS = 3
FORMS = ("10-K", "10-Q", "20-F", "20-F/A")
JOB_SCHEMA = "job_id string, filing_url string, ticker string, filing_type string, attempts int, failed boolean"
TRANSIENT = r"(?i)(timeout|timed out|connection|temporarily|429|503|rate limit)"


def parsed(raw: DataFrame, column: str = "value") -> DataFrame:
    """Jobs of JSON messages; a message that can't be read has only its raw text."""
    job = F.from_json(F.col(column).cast("string"), JOB_SCHEMA)
    return raw.select(F.col(column).cast("string").alias("raw"), job.alias("j")).select("raw", "j.*")


def routed(jobs: DataFrame, most: int = MOST_ATTEMPTS) -> DataFrame:
    """Adds route: done, retry (one attempt more), dead (attempts used up), invalid, skipped (another form)."""
    attempts = F.coalesce("attempts", F.lit(0))
    route = (
        F.when(F.col("job_id").isNull(), "invalid")
        .when(~F.col("filing_type").isin(*FORMS), "skipped")
        .when(~F.coalesce("failed", F.lit(False)), "done")
        .when(attempts + 1 < most, "retry")
        .otherwise("dead")
    )
    return jobs.withColumn("route", route).withColumn("attempts", F.when(F.col("route").isin("retry", "dead"), attempts + 1).otherwise(attempts))


def is_transient(message: Column) -> Column:
    return F.coalesce(message.rlike(TRANSIENT), F.lit(False))


def recovery(attempts: Column, message: Column, most: int = MOST_ATTEMPTS) -> Column:
    """What to do after an error: 'retry' a passing one while attempts are left, 'fail' otherwise; 'none' without an error."""
    return F.when(message.isNull(), "none").when(is_transient(message) & (F.coalesce(attempts, F.lit(0)) + 1 < most), "retry").otherwise("fail")


def pending(jobs: DataFrame, ledger: DataFrame, key: str = "accession") -> DataFrame:
    """Jobs whose latest record in the ledger (key, status, position) isn't 'saved'."""
    last = ledger.groupBy(key).agg(F.max_by("status", "position").alias("_s")).filter("_s = 'saved'")
    return jobs.join(last.select(key), key, "left_anti")


def run_queue(spark: SparkSession, source: str, out: str, checkpoint: str, work: Callable[[DataFrame], DataFrame] | None = None, files_per_batch: int = 100) -> StreamingQuery:
    """Consume all job messages that are there, route them into tables ``out``/batch=<n>/route=<r>, and stop.

    Jobs to retry go back to the source as messages with one attempt more, in a
    folder of the batch's own, so a batch that is run again replaces them.
    """
    raw = spark.readStream.schema("value string").option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", True).text(source)

    def write(batch: DataFrame, number: int) -> None:
        jobs = parsed(batch)
        jobs = routed(work(jobs) if work else jobs)
        jobs.write.mode("overwrite").partitionBy("route").parquet(f"{out}/batch={number}")
        done = spark.read.schema(jobs.schema).parquet(f"{out}/batch={number}")  # what was written is what is retried
        again = done.filter("route = 'retry'").select(F.to_json(F.struct("job_id", "filing_url", "ticker", "filing_type", "attempts", F.lit(False).alias("failed"))).alias("value"))
        again.write.mode("overwrite").text(f"{source}/retry-{number}")

    return raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def drain_queue(spark: SparkSession, source: str, out: str, checkpoint: str, work: Callable[[DataFrame], DataFrame], most: int = MOST_ATTEMPTS) -> None:
    """Run the queue until nothing is left to retry: each run takes the messages that the one before put back."""
    for _ in range(most):
        run_queue(spark, source, out, checkpoint, work).awaitTermination()


def windowed_counts(events: DataFrame, late: str = "10 minutes", length: str = "5 minutes") -> DataFrame:
    """Counts and sums per window and type; rows later than ``late`` are dropped by the watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", length), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def _micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def sliding_budget(events: DataFrame, keys: list[str], seconds: int = 60, most: int | None = None, bucket: int = 100) -> DataFrame:
    """Adds used: events of the key in the last ``seconds`` (the row itself included), and over: whether that passes ``most``.

    Time is cut into buckets of ``bucket`` windows, each a group of its own, and
    a bucket also gets the rows of the window before it; so a key with many
    events is shared out over time.
    """
    micros, length = _micros("ts"), seconds * 1_000_000
    span = length * bucket
    own = F.floor(micros / span)
    rows = events.withColumn("_b", F.explode(F.when(F.pmod(micros, F.lit(span)) >= span - length, F.array(own, own + 1)).otherwise(F.array(own)))).withColumn("_own", F.col("_b") == own)
    w = Window.partitionBy(*keys, "_b").orderBy(micros).rangeBetween(-length, 0)
    out = rows.withColumn("used", F.count("*").over(w)).filter("_own").drop("_b", "_own")
    return out if most is None else out.withColumn("over", F.col("used") > most)


def sessions(events: DataFrame, keys: list[str], gap_seconds: int = 600) -> DataFrame:
    """keys, session, first, last, n: runs of events with gaps of at most ``gap_seconds``."""
    w = Window.partitionBy(*keys).orderBy("ts", "event_id")
    gap = _micros("ts") - F.lag(_micros("ts")).over(w)
    rows = events.withColumn("_new", F.coalesce(gap > gap_seconds * 1_000_000, F.lit(True)).cast("int"))
    rows = rows.withColumn("session", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*keys, "session").agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.count("*").alias("n"))


def granted(requests: DataFrame, keys: list[str], rate: float, capacity: float | None = None, at: str = "ts") -> DataFrame:
    """Adds granted (microseconds): when a token bucket of ``rate`` tokens a second lets each request of a key pass, in order of arrival.

    The bucket is full at first and holds ``capacity`` tokens (the rate, unless
    given). Request i may pass when the bucket's debt is paid: a running maximum
    over the arrivals before it says when, so no request is walked through.
    """
    step, held = 1_000_000 / rate, (rate if capacity is None else capacity) - 1
    order = Window.partitionBy(*keys).orderBy(_micros(at), "event_id")
    rows = requests.withColumns({"_t": _micros(at).cast("double"), "_i": F.row_number().over(order).cast("double")})
    paid = F.max(F.col("_t") - F.col("_i") * step).over(order.rowsBetween(Window.unboundedPreceding, -1))
    free = F.col("_i") * step + paid - held * step
    return rows.withColumn("granted", F.ceil(F.greatest(F.col("_t"), F.coalesce(free, F.col("_t")))).cast("bigint")).drop("_t", "_i")


def heartbeats(jobs: DataFrame, seconds: int = 60) -> DataFrame:
    """job, at (microseconds), kind: the progress events of jobs (job, started, ended in microseconds): start, one beat every ``seconds`` while they run, end."""
    step = seconds * 1_000_000
    beats = F.transform(F.when(F.col("ended") - F.col("started") > step, F.sequence(F.col("started") + step, F.col("ended") - 1, F.lit(step))).otherwise(F.array().cast("array<bigint>")), lambda t: F.struct(t.alias("at"), F.lit("heartbeat").alias("kind")))
    ends = F.array(F.struct(F.col("started").alias("at"), F.lit("start").alias("kind")), F.struct(F.col("ended").alias("at"), F.lit("end").alias("kind")))
    return jobs.select("job", F.inline(F.concat(ends, beats)))
