"""Landing files to tables, and tables to files. Schemas are fixed, never inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import ten_digit_cik

# --- fixed values -----------------------------------------------------------
FILINGS_SCHEMA = (
    "cik string, name string, tickers array<string>, exchanges array<string>, sic string, fiscalYearEnd string, filings struct<recent: struct<"
    "form: array<string>, accessionNumber: array<string>, filingDate: array<string>, reportDate: array<string>, isXBRL: array<int>, primaryDocument: array<string>>>"
)
PAGE_SCHEMA = "form array<string>, accessionNumber array<string>, filingDate array<string>, reportDate array<string>, isXBRL array<int>, primaryDocument array<string>"
COMPANY_FACTS_SCHEMA = (
    "cik bigint, entityName string, facts map<string, map<string, struct<label: string, units: map<string, array<struct<"
    "start: string, end: string, val: double, accn: string, fy: int, fp: string, form: string, filed: string, frame: string>>>>>>"
)
LABEL_SCHEMA = "concept string, role string, lang string, year int, label string"
SKIPPED_FILES = r"(?i)(filingsummary|metalinks|financial_report|\.xsd$|_cal\.xml$|_def\.xml$|_lab\.xml$|_pre\.xml$|^r\d+\.)"

SKIPPED_HTML = r"index|ex|graphic|logo|image|\.jpg|\.png|\.gif|\.css|\.js|img"
SKIPPED_SEC = r"_(?:lab|cal|pre|def|ref)\.xml|schema|taxonomy|linkbase|label|calculation|presentation|definition|reference"
HTML_FORMS = "10-k|10-q|8-k|20-f|10k|10q|8k|20f"
MAIN_WORDS = "instance|document|filing"


def company_submissions(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Companies and filings of submission files; parallel arrays are zipped by index, newest filings first within a company."""
    raw = spark.read.schema(FILINGS_SCHEMA).option("multiLine", True).json(path)
    companies = raw.select(ten_digit_cik(F.col("cik")).alias("cik"), "name", F.get("tickers", F.lit(0)).alias("ticker"), "tickers", "exchanges", "sic", F.col("fiscalYearEnd").alias("fiscal_year_end"))
    return companies, filing_rows(raw)


def filing_rows(raw: DataFrame) -> DataFrame:
    """One row per filing of submission documents."""
    zipped = F.arrays_zip(*[F.col(f"filings.recent.{c}") for c in ("form", "accessionNumber", "filingDate", "reportDate", "isXBRL", "primaryDocument")])
    filings = raw.select(ten_digit_cik(F.col("cik")).alias("cik"), F.inline(zipped))
    return filings.select(
        "cik", "form", F.col("accessionNumber").alias("accession"), F.col("filingDate").try_cast("date").alias("filing_date"), F.col("reportDate").try_cast("date").alias("report_date"), (F.col("isXBRL") == 1).alias("is_xbrl"), F.col("primaryDocument").alias("document")
    )


def paged_filings(pages: DataFrame) -> DataFrame:
    """One row per filing of the older pages of a submission: the arrays are at the top, the company's number is in the file's name."""
    zipped = F.arrays_zip("form", "accessionNumber", "filingDate", "reportDate", "isXBRL", "primaryDocument")
    cik = ten_digit_cik(F.regexp_extract("file", r"CIK(\d+)-", 1))
    return pages.select(cik.alias("cik"), F.inline(zipped)).select(
        "cik", "form", F.col("accessionNumber").alias("accession"), F.col("filingDate").try_cast("date").alias("filing_date"), F.col("reportDate").try_cast("date").alias("report_date"), (F.col("isXBRL") == 1).alias("is_xbrl"), F.col("primaryDocument").alias("document")
    )


def all_filings(raw: DataFrame, pages: DataFrame) -> DataFrame:
    """Recent and paged filings with their place in the company, newest first."""
    rows = filing_rows(raw).unionByName(paged_filings(pages))
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("cik").orderBy(F.col("filing_date").desc_nulls_last(), "accession")))


def submission_pages(spark: SparkSession, path: str) -> DataFrame:
    """The page files of submissions, with their names."""
    return spark.read.schema(PAGE_SCHEMA).option("multiLine", True).json(path).withColumn("file", F.col("_metadata.file_name"))


def company_facts(spark: SparkSession, path: str) -> DataFrame:
    """One row per reported fact of company-facts files."""
    return fact_rows(spark.read.schema(COMPANY_FACTS_SCHEMA).option("multiLine", True).json(path))


def fact_rows(raw: DataFrame) -> DataFrame:
    """One row per reported fact of company-facts documents."""
    spaces = raw.select(ten_digit_cik(F.col("cik")).alias("cik"), F.explode("facts").alias("space", "tags"))
    tags = spaces.select("cik", "space", F.explode("tags").alias("tag", "t"))
    units = tags.select("cik", F.concat_ws(":", "space", "tag").alias("tag"), F.explode("t.units").alias("unit", "rows"))
    return units.select("cik", "tag", "unit", F.inline("rows")).withColumns({"start": F.col("start").try_cast("date"), "end": F.col("end").try_cast("date")})


def xbrl_facts(spark: SparkSession, path: str, tag: str = "fact") -> DataFrame:
    """Facts of XML files: elements ``tag`` with concept, contextRef, unitRef, decimals and value."""
    schema = "_concept string, _contextRef string, _unitRef string, _decimals string, _VALUE string"
    return spark.read.format("xml").option("rowTag", tag).schema(schema).load(path).select(F.col("_concept").alias("concept"), F.col("_contextRef").alias("context"), F.col("_unitRef").alias("unit"), F.col("_decimals").alias("decimals"), F.col("_VALUE").alias("value"))


def xbrl_contexts(spark: SparkSession, path: str) -> DataFrame:
    """context, entity, start, end, instant, dimensions (axis -> member) of XML instances."""
    member = "array<struct<_dimension: string, _VALUE: string>>"
    schema = f"_id string, entity struct<identifier: string, segment: struct<explicitMember: {member}>>, period struct<startDate: string, endDate: string, instant: string>"
    rows = spark.read.format("xml").option("rowTag", "context").schema(schema).load(path)
    dims = F.map_from_entries(F.transform(F.coalesce("entity.segment.explicitMember", F.array().cast(member)), lambda m: F.struct(m["_dimension"], m["_VALUE"])))
    return rows.select(F.col("_id").alias("context"), F.col("entity.identifier").alias("entity"), F.col("period.startDate").alias("start"), F.col("period.endDate").alias("end"), F.col("period.instant").alias("instant"), dims.alias("dimensions"))


def xbrl_units(spark: SparkSession, path: str) -> DataFrame:
    """unit, measure."""
    return spark.read.format("xml").option("rowTag", "unit").schema("_id string, measure string").load(path).select(F.col("_id").alias("unit"), "measure")


def xbrl_instance(spark: SparkSession, path: str) -> DataFrame:
    """Facts with their contexts and units; a fact whose context is absent has no period."""
    facts, contexts, units = xbrl_facts(spark, path), xbrl_contexts(spark, path), xbrl_units(spark, path)
    return facts.join(contexts, "context", "left").join(units, "unit", "left").select("concept", "value", "decimals", "measure", "entity", "start", "end", "instant", "dimensions")


def batch_states(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON files that hold one object or a list of objects each."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def _archive_writer(uri: str):
    def run(batches):
        import gzip

        import pyarrow as pa
        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(uri)
        for b in batches:
            names, sizes = [], []
            for ticker, accession, html in zip(*(c.to_pylist() for c in b.columns), strict=True):
                raw = (html or "").encode()
                store.create_dir(f"{folder}/{ticker}", recursive=True)
                for name, body in ((f"{ticker}/{accession}.htm", raw), (f"{ticker}/{accession}.html.gz", gzip.compress(raw, mtime=0))):
                    with store.open_output_stream(f"{folder}/{name}", compression=None) as f:
                        f.write(body)
                    names.append(name)
                    sizes.append(len(body))
            yield pa.record_batch({"file": pa.array(names, pa.string()), "bytes": pa.array(sizes, pa.int64())})

    return run


def write_html_archive(rows: DataFrame, path: str) -> DataFrame:
    """Write <ticker>/<accession>.htm and .html.gz of rows (ticker, accession, html); file and bytes of each. A task that runs again writes the same files."""
    return rows.select("ticker", "accession", "html").mapInArrow(_archive_writer(path), "file string, bytes long")


def newest_labels(labels: DataFrame) -> DataFrame:
    """concept, label: the standard English label of the newest year."""
    return labels.filter("role = 'label' and lang = 'en-US'").groupBy("concept").agg(F.max_by("label", F.struct("year", "label")).alias("label"))


def identifiers(spark: SparkSession, path: str) -> DataFrame:
    """Identifiers of a text file: one a line, comments and empty lines aside, in capitals."""
    line = F.upper(F.trim("value"))
    return spark.read.text(path).select(line.alias("identifier")).filter("identifier <> '' and identifier not like '#%'").distinct()


def html_archive(spark: SparkSession, path: str) -> DataFrame:
    """accession, html of an archive of text files (.html.gz, .html, .htm); of several files of one accession the first in this order."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("html"))
    rank = F.when(F.col("file").endswith(".html.gz"), 0).when(F.col("file").endswith(".html"), 1).otherwise(2)
    w = Window.partitionBy("accession").orderBy(rank, "file")
    rows = rows.withColumn("accession", F.regexp_extract("file", r"^(.+?)\.html?(?:\.gz)?$", 1)).filter("accession <> ''")
    return rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").select("accession", "html")


def ledger(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON-lines ledger; lines that can't be read are left out."""
    rows = spark.read.schema(f"{schema}, _bad string").option("columnNameOfCorruptRecord", "_bad").json(path)
    return rows.filter("_bad is null").drop("_bad")


def append_ledger(events: DataFrame, path: str) -> None:
    events.write.mode("append").json(path)


def export_statements(rows: DataFrame, path: str, statement: str = "statement_type") -> None:
    """One folder of JSON lines per statement."""
    rows.write.mode("overwrite").partitionBy(statement).json(path)


def pivoted(rows: DataFrame, keys: list[str], period: str, value: str, periods: list[str]) -> DataFrame:
    """Lines by periods; the columns are given, so no extra pass looks for them."""
    return rows.groupBy(*keys).pivot(period, periods).agg(F.sum(value))


def statement_sheet(rows: DataFrame, keys: list[str], periods: list[str]) -> DataFrame:
    """keys, concept, slice and a column per period: a row for each line item, and one for each of its dimension combinations ("axis=member | ...") under it.

    ``rows``: keys, concept, period, value, dimensions; of several facts of a cell the last by position counts.
    """
    pairs = F.transform(F.map_entries("dimensions"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    own = F.when(F.coalesce(F.size("dimensions"), F.lit(0)) > 0, F.array_join(F.array_sort(pairs), " | ")).otherwise("")
    return rows.withColumn("slice", own).groupBy(*keys, "concept", "slice").pivot("period", periods).agg(F.max_by("value", "position"))


def xbrl_file_score(name: Column, accession: Column) -> Column:
    """Rank of a file as a filing's data file: the higher the likelier, 0 never."""
    low, acc = F.lower(name), F.lower(accession)
    has = low.contains(acc) | low.contains(F.replace(acc, F.lit("-"), F.lit("")))
    dated = low.rlike(r"^[a-z]+-\d{8}\.")
    return (
        F.when(low.rlike(SKIPPED_FILES), 0)
        .when(low.endswith("_htm.xml"), 125 + F.when(has, 20).otherwise(0))
        .when(dated & low.endswith(".xml"), 120 + F.when(F.length(low) <= 16, 5).otherwise(0))
        .when(low.rlike(r"\.html?$"), 110)
        .when(has & low.endswith(".xml"), 80)
        .when(has & low.endswith(".txt"), 70)
        .when(low.endswith(".xml"), 60)
        .when(low.endswith(".txt"), 30)
        .otherwise(0)
    )


def html_file_score(name: Column, accession: Column) -> Column:
    """Rank of a file as a filing's main HTML document: the higher the likelier, 0 never; NULL without a name."""
    low = F.lower(name)
    has = name.contains(F.replace(accession, F.lit("-"), F.lit("")))
    form = F.when(low.rlike(HTML_FORMS), 15).otherwise(0)
    kind = F.when(low.rlike(MAIN_WORDS), 20).otherwise(0)
    return F.when(
        name.isNotNull(),
        F.when(low.rlike(SKIPPED_HTML) | ~low.endswith(".htm"), 0)
        .when(low.rlike(r"^r\d+\.htm$"), 5)
        .when(low.rlike(r"^[a-z]{2,5}-\d{8}\.htm$"), 100 + F.when(has, 10).otherwise(0))
        .when(low.rlike(r"^[a-z]{2,5}-\d+[a-z]+_\d{8}\.htm$"), 90)
        .when(has, 80)
        .when(low.rlike(r"^d\d+d10[qk]\.htm$"), 70)
        .when(low.rlike(r"^[a-z]*\d+[a-z]*\.htm$") & (F.length(name) < 20), F.when(low.rlike(r"\d{6,}"), 40).otherwise(65))
        .when(low.rlike(r"^[a-z]+-.*\.htm$"), 50)
        .otherwise(20 + form + kind),
    )


def sec_file_score(name: Column) -> Column:
    """The processor's rank of a data file, kept apart from ``xbrl_file_score`` because its scores differ; NULL without a name."""
    low = F.lower(name)
    kind = F.when(low.endswith("_htm.xml"), 100).when(low.endswith(".xml") & low.contains("instance"), 90).when(low.endswith(".xml"), 50).when(low.endswith(".txt"), 30).otherwise(0)
    bonus = F.when(name.rlike(r"\d{10}-\d{2}-\d{6}"), 20).otherwise(0) + F.when(low.rlike(r"[a-z]{2,5}-\d{8}"), 15).otherwise(0)
    words = sum((F.when(low.contains(w), 10).otherwise(0) for w in MAIN_WORDS.split("|")), F.lit(0))
    return F.when(name.isNotNull(), F.when(low.rlike(SKIPPED_SEC), 0).otherwise(kind + bonus + words))


def txt_fallback(xbrl_url: Column, txt_url: Column) -> Column:
    """Whether a filing has no XBRL: no address, that of a text file, or that of the whole submission."""
    none = xbrl_url.isNull() | (xbrl_url == "")
    return none | F.lower(xbrl_url).endswith(".txt") | F.coalesce((txt_url != "") & (xbrl_url == txt_url), F.lit(False))


def amendments(filings: DataFrame, key: str) -> DataFrame:
    """Each original filing (cik, report, form, filed) with the earliest amendment of the same company and report."""
    late = filings.filter(F.col("form").endswith("/A")).groupBy("cik", "report", F.regexp_replace("form", "/A$", "").alias("form")).agg(F.min_by(key, F.struct("filed", key)).alias("amendment"))
    return filings.filter(~F.col("form").endswith("/A")).join(late, ["cik", "report", "form"], "left")
