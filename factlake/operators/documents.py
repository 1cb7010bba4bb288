"""Filing documents: HTML to text and tables, section cuts, text search."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

if TYPE_CHECKING:  # workers import it; a driver that runs other queries needn't
    import pandas as pd

# --- fixed values -----------------------------------------------------------
BLOCK_TAGS = ("p", "div", "br", "tr", "li", "table", "h1", "h2", "h3", "h4", "h5", "h6", "article", "section", "ul", "ol", "nav", "footer", "title")
SILENT_TAGS = ("script", "style")
SECTION_STARTS = r"(?i)item\s+(?:7|2|5)\s*\.?\s*management.s\s+discussion"
SECTION_ENDS = r"(?i)item\s+(?:7a|8|3|4|6)\s*\."
LEAST_SECTION_CHARS = 800
LEAST_WORD = 4
LISTING_HINTS = {"income": ("income", "oper"), "balance": ("balance",), "cash": ("cash",)}
LISTING_WORDS = {
    "income": ("operations", "income", "earnings", "revenue", "sales", "gross profit"),
    "balance": ("balance sheet", "financial position", "assets", "liabilities", "stockholders"),
    "cash": ("cash flows", "operating activities", "investing activities", "financing activities"),
}
LISTING_GENERAL = ("consolidated", "in millions", "in thousands")
TABLE_SCALES = (1.0, 1e3, 1e6)


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.silent = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in SILENT_TAGS:
            self.silent += 1
        elif tag in BLOCK_TAGS:
            self.out.append("\n")

    def handle_endtag(self, tag: str) -> None:
        if tag in SILENT_TAGS:
            self.silent = max(0, self.silent - 1)
        elif tag in BLOCK_TAGS:
            self.out.append("\n")

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.out.append(data)


def text_lines(html: str | None) -> list[str]:
    """Visible text by lines, white space collapsed, empty lines dropped."""
    p = _Text()
    p.feed(html or "")
    p.close()
    lines = (re.sub(r"\s+", " ", x).strip() for x in "".join(p.out).split("\n"))
    return [x for x in lines if x]


def _parsed(f):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield f(pdf)

    return run


def html_lines(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """id, line_no, line of each page; the parser runs on Arrow batches, one row at a time in memory."""
    kind = pages.schema[id_col].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [(i, n, x) for i, h in zip(pdf[id_col], pdf[html_col], strict=True) for n, x in enumerate(text_lines(h))]
        import pandas as pd

        return pd.DataFrame(rows, columns=[id_col, "line_no", "line"])

    return pages.select(id_col, html_col).mapInPandas(_parsed(run), f"`{id_col}` {kind}, line_no int, line string")


class _Tables(HTMLParser):
    """Rows of cells of each table: text, and the scale of the cell's first inline fact (a power of ten)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[tuple[str, int | None]]]] = []
        self.open: list[int] = []
        self.cell: list[str] | None = None
        self.facts = 0
        self.scale: int | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "table":
            self.tables.append([])
            self.open.append(len(self.tables) - 1)
        elif tag == "tr" and self.open:
            self.tables[self.open[-1]].append([])
        elif tag in ("td", "th") and self.open and self.tables[self.open[-1]]:
            self.cell, self.facts, self.scale = [], 0, None
        elif tag == "ix:nonfraction" and self.cell is not None:
            self.facts += 1
            scale = (dict(attrs).get("scale") or "").strip()
            if self.facts == 1 and re.fullmatch(r"[+-]?\d{1,2}", scale, re.ASCII):
                self.scale = int(scale)

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th") and self.cell is not None and self.open:
            self.tables[self.open[-1]][-1].append((re.sub(r"\s+", " ", "".join(self.cell)).strip(), self.scale))
            self.cell = None
        elif tag == "table" and self.open:
            self.open.pop()

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell.append(data)


def html_tables(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """id, table_no, row_no, col_no, cell, value, sign: every cell of every table; parentheses are a minus, values are times the scale of an inline fact."""
    kind = pages.schema[id_col].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        import pandas as pd

        rows = []
        for i, h in zip(pdf[id_col], pdf[html_col], strict=True):
            p = _Tables()
            p.feed(h or "")
            p.close()
            rows += [(i, t, r, c, x, z) for t, table in enumerate(p.tables) for r, cells in enumerate(table) for c, (x, z) in enumerate(cells)]
        return pd.DataFrame(rows, columns=[id_col, "table_no", "row_no", "col_no", "cell", "_scale"]).astype({"_scale": "Int32"})

    cells = pages.select(id_col, html_col).mapInPandas(_parsed(run), f"`{id_col}` {kind}, table_no int, row_no int, col_no int, cell string, _scale int")
    from ..functions.text import number_of

    number = number_of(F.col("cell"))
    value = F.when(F.col("_scale") < 0, number / F.pow(F.lit(10.0), -F.col("_scale"))).otherwise(number * F.pow(F.lit(10.0), F.coalesce("_scale", F.lit(0))))
    return cells.withColumn("value", value).drop("_scale").withColumn("sign", F.signum("value").cast("int"))


def statement_vote(cells: DataFrame, keys: list[str]) -> DataFrame:
    """keys, statement: by the words of the labels (first column), the most votes win."""
    label = F.lower("cell")
    vote = (
        F.when(label.rlike("cash flow|operating activities|financing activities|investing activities"), "cashflow")
        .when(label.rlike("total assets|liabilit|equity|receivable|inventor"), "balancesheet")
        .when(label.rlike("revenue|net income|gross profit|operating income|expense"), "income")
    )
    votes = cells.filter("col_no = 0").withColumn("statement", vote).filter("statement is not null").groupBy(*keys, "statement").agg(F.count("*").alias("n"))
    w = Window.partitionBy(*keys).orderBy(F.col("n").desc(), "statement")
    return votes.withColumn("_n", F.row_number().over(w)).filter("_n = 1").select(*keys, "statement")


def tables_with_value(cells: DataFrame, keys: list[str], value: float, hint: str, most: int = 4) -> DataFrame:
    """Tables that show a value in units, thousands or millions, with the best row of each, best first.

    A scaled match counts by how exact the shown number is, ten points for the
    right sign, five for each word of the hint in the row.
    """
    row = [*keys, "table_no", "row_no"]
    shown = F.abs(F.col("value"))
    digits = F.when(F.col("cell").rlike(r"\.\d\d"), 1).when(F.col("cell").rlike(r"\.\d"), 2).otherwise(3)
    hit = F.lit(False)
    for s in TABLE_SCALES:
        hit = hit | (shown == F.round(F.lit(abs(value) / s), 0)) | (shown == F.round(F.lit(abs(value) / s), 1)) | (shown == F.round(F.lit(abs(value) / s), 2))
    words = [w for w in re.findall(r"[a-z]+", hint.lower()) if len(w) >= LEAST_WORD]
    text = cells.groupBy(*row).agg(F.lower(F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct("col_no", "cell"))), lambda x: x["cell"]))).alias("row_text"))
    found = cells.filter(hit).withColumn("points", digits + F.when(F.col("sign") == (1 if value >= 0 else -1), 10).otherwise(-1)).groupBy(*row).agg(F.max("points").alias("points")).join(text, row)
    bonus = sum((F.when(F.col("row_text").contains(w), 5).otherwise(0) for w in words), F.lit(0))
    found = found.withColumn("points", F.col("points") + bonus)
    best = F.row_number().over(Window.partitionBy(*keys, "table_no").orderBy(F.col("points").desc(), "row_no"))
    top = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("points").desc(), "table_no"))
    return found.withColumn("_b", best).filter("_b = 1").drop("_b").withColumn("_t", top).filter(F.col("_t") <= most).drop("_t")


def section(text: Column, starts: str = SECTION_STARTS, ends: str = SECTION_ENDS) -> Column:
    """The last section that has at least 800 characters left, up to the next end mark; NULL without one."""
    usable = F.substring(text, 1, 2_000_000_000)
    marked = F.regexp_replace(usable, f"({starts})", "\u0001$1")
    parts = F.split(marked, "\u0001")
    # Parts after the first begin with a heading; the last one with enough text behind it is the section.
    tails = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: F.array_join(F.slice(parts, i + 1, F.size(parts)), ""))
    long_enough = F.filter(tails, lambda t: F.length(t) >= LEAST_SECTION_CHARS)
    chosen = F.when((F.size(parts) > 1) & (F.size(long_enough) > 0), F.element_at(long_enough, -1))
    return F.regexp_extract(chosen, f"(?s)^(.+?)(?:{ends}|$)", 1)


def word_index(lines: DataFrame, keys: list[str]) -> DataFrame:
    """keys, word, line_no: the words of four letters and more of each line, once a line."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("line"), F.lit(f"[a-z]{{{LEAST_WORD},}}"), F.lit(0)))
    return lines.select(*keys, "line_no", F.explode(words).alias("word"))


def search_blocks(lines: DataFrame, keys: list[str], query: str, context: int = 3, most: int = 15) -> DataFrame:
    """keys, first, last, hits: blocks of lines around those that have all words of a query, or any where none has all, and those that have the query itself.

    Words have four letters at least. Blocks whose contexts touch are one; the
    first ``most`` of a document are reported.
    """
    text = query.lower()
    words = list(dict.fromkeys(re.findall(rf"[a-z]{{{LEAST_WORD},}}", text)))
    direct = F.lower("line").contains(text)
    found = F.array_intersect(F.regexp_extract_all(F.lower("line"), F.lit(f"[a-z]{{{LEAST_WORD},}}"), F.lit(0)), F.array(*map(F.lit, words)) if words else F.array().cast("array<string>"))
    rows = lines.withColumns({"_w": F.size(found), "_d": direct}).filter("_w > 0 or _d")
    full = F.max((F.col("_w") == len(words)) & (F.col("_w") > 0)).over(Window.partitionBy(*keys))
    hits = rows.withColumn("_f", full).filter(F.col("_d") | F.when(F.col("_f"), F.col("_w") == len(words)).otherwise(F.col("_w") > 0))
    w = Window.partitionBy(*keys).orderBy("line_no")
    hits = hits.withColumn("_new", F.coalesce(F.col("line_no") - F.lag("line_no").over(w) > 2 * context, F.lit(True)).cast("int"))
    hits = hits.withColumn("_block", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    blocks = hits.groupBy(*keys, "_block").agg((F.min("line_no") - context).alias("first"), (F.max("line_no") + context).alias("last"), F.count("*").alias("hits"))
    return blocks.filter(F.col("_block") <= most).select(*keys, F.greatest("first", F.lit(0)).alias("first"), "last", "hits")


def listed_tables(cells: DataFrame, keys: list[str], hint: str = "", most: int = 20) -> DataFrame:
    """keys, table_no, rows, score, place: the tables whose first four rows speak most of a statement, the first ``most`` of a document."""
    low = hint.strip().lower()
    kind = next((k for k, words in LISTING_HINTS.items() if any(w in low for w in words)), None)
    head = F.lower(F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.when(F.col("row_no") < 4, F.struct("row_no", "col_no", "cell")))), lambda x: x["cell"])))
    per = cells.groupBy(*keys, "table_no").agg((F.max("row_no") + 1).alias("rows"), head.alias("_head"))
    score = sum((F.when(F.col("_head").contains(w), 3).otherwise(0) for w in LISTING_WORDS.get(kind, ())), F.lit(0))
    general = F.lit(False)
    for w in LISTING_GENERAL:
        general = general | F.col("_head").contains(w)
    per = per.withColumn("score", score + F.when(general, 1).otherwise(0))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("score").desc(), "table_no"))
    return per.withColumn("place", place).filter(F.col("place") <= most).drop("_head")


def table_rows(cells: DataFrame, keys: list[str], table_no: int, start: int = 0, most: int = 80) -> DataFrame:
    """keys, row_no, line: rows of one table as text, from ``start`` on, at most 150."""
    last = start + max(1, min(most, 150))
    rows = cells.filter((F.col("table_no") == table_no) & (F.col("row_no") >= start) & (F.col("row_no") < last))
    line = F.concat_ws(" | ", F.transform(F.array_sort(F.collect_list(F.struct("col_no", "cell"))), lambda x: x["cell"]))
    return rows.groupBy(*keys, "row_no").agg(line.alias("line"))


def annual_cover(form: Column, report_date: Column, text: Column) -> Column:
    """Whether a 20-F cover says that it is an annual report: the form, a report date, and the checked box."""
    checked = text.rlike(r"(?is)(?:\[x\]|☒|☑|&#9746;)\s*annual\s+report")
    return form.isin("20-F", "20-F/A") & report_date.isNotNull() & checked
