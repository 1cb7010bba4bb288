"""Names, numbers, units, labels and identity keys, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
STOP_WORDS = ("and", "the", "for", "from", "with", "net", "total", "other", "of", "in")
LABEL_TAGS = (
    "member", "axis", "domain", "line items", "line item", "table", "abstract", "text block", "policy text block", "deprecated", "roll up",
    "roll down", "roll forward", "roll forward rules", "details", "hierarchy", "alternative label", "preferred label", "documentation",
    "calculation", "presentation", "definition",
)
MEMBER_TAGS = ("member", "domain")
GENERIC_BASES = (
    "operating", "reportable", "all", "other", "total", "combined", "business", "geographic", "geographical", "product", "products",
    "service", "services", "customer", "customers", "industry", "consolidated", "segment",
)
SAFE_CURRENCY = "USD"
WRAPPER_AXES = ("explicitmember", "typedmember", "dimension", "axis")
USD_NAMES = ("USD", "US$", "U.S. DOLLAR", "U.S. DOLLARS", "US DOLLAR", "US DOLLARS", "DOLLARS", "ISO4217:USD")
SHARE_NAMES = ("SHARES", "SHARE", "XBRLI:SHARES")


def number_of(text: Column) -> Column:
    """"(1,234)" is -1234; dollar signs, commas and blanks go; NULL if no number is left."""
    bare = F.regexp_replace(F.trim(text), "[$,\\s ]", "")
    inner = F.regexp_extract(bare, r"^\((.*)\)$", 1)
    return F.when(inner != "", -inner.try_cast("double")).otherwise(bare.try_cast("double"))


def fact_value(*sources: Column) -> tuple[Column, Column]:
    """Number and text of the first source that isn't NULL; "nil" is NULL."""
    text = F.coalesce(*[s.cast("string") for s in sources])
    text = F.when(F.lower(F.trim(text)) == "nil", F.lit(None)).otherwise(text)
    return number_of(text), text


def number_tokens(text: Column) -> Column:
    """All numbers in a text; the hyphen of a range is no minus."""
    found = F.regexp_extract_all(text, F.lit(r"(\d[\d,]*(?:\.\d+)?)"), F.lit(1))
    return F.transform(found, lambda x: F.replace(x, F.lit(","), F.lit("")).try_cast("double"))


def standard_unit(unit: Column) -> Column:
    up = F.upper(F.trim(unit))
    return F.when(up.isNull() | (up == "") | up.isin(*USD_NAMES), F.lit("USD")).when(up.isin(*SHARE_NAMES), F.lit("shares")).otherwise(up)


def plain_unit(unit: Column) -> Column:
    """Upper case, after the last colon."""
    return F.upper(F.element_at(F.split(F.trim(unit), ":"), -1))


def is_usd_safe(currency: Column) -> Column:
    """Only the exact text USD; NULL isn't."""
    return F.coalesce(currency == SAFE_CURRENCY, F.lit(False))


def local_name(concept: Column) -> Column:
    return F.element_at(F.split(concept, ":"), -1)


def name_after_first_colon(concept: Column) -> Column:
    return F.regexp_replace(concept, "^[^:]*:", "")


def camel_tokens(name: Column) -> Column:
    """Distinct lower-case words of a camelCase name, in order of appearance."""
    parted = F.regexp_replace(F.regexp_replace(name, "([a-z0-9])([A-Z])", "$1 $2"), "[^A-Za-z]+", " ")
    return F.array_distinct(F.filter(F.split(F.lower(F.trim(parted)), " "), lambda x: x != ""))


def concept_tokens(concept: Column) -> Column:
    """Meaningful words of a concept's local name: over two letters and no stop word."""
    return F.array_except(F.filter(camel_tokens(local_name(concept)), lambda x: F.length(x) > 2), F.array(*[F.lit(w) for w in STOP_WORDS]))


def clean_label(label: Column) -> Column:
    """White space collapsed and one trailing [tag] of the known ones dropped; after a member tag also a trailing Segment(s).

    "Segment" stays where only a generic word would be left ("Operating Segments"); the result is never empty.
    """
    flat = F.trim(F.regexp_replace(label, r"(?U)\s+", " "))
    tag = F.lower(F.trim(F.regexp_extract(flat, r"\[([^\[\]]*)\]$", 1)))
    base = F.when(tag.isin(*LABEL_TAGS), F.trim(F.regexp_replace(flat, r"\s*\[[^\[\]]*\]$", ""))).otherwise(flat)
    short = F.trim(F.regexp_extract(base, r"(?i)^(.*?)[\s,]+segments?$", 1))
    out = F.when(tag.isin(*MEMBER_TAGS) & (short != "") & ~F.lower(short).isin(*GENERIC_BASES), short).otherwise(base)
    return F.when(out == "", flat).otherwise(out)


def axis_name(axis: Column) -> Column:
    """Local name without "Axis", letters and digits in lower case; a bare "Axis" keeps its whole name."""
    local = F.regexp_replace(F.lower(F.regexp_replace(local_name(axis), "Axis$", "")), r"[^\p{L}\p{N}]", "")
    return F.when(local == "", F.regexp_replace(F.lower(axis), r"[^\p{L}\p{N}]", "")).otherwise(local)


def member_name(member: Column) -> Column:
    return F.lower(F.trim(member))


def pretty_member(member: Column) -> Column:
    """Blanks for separators, title case, known abbreviations in capitals."""
    out = F.initcap(F.regexp_replace(F.trim(member), "[_-]+", " "))
    for a, b in (("Usa", "USA"), ("Us ", "US "), ("Uk", "UK"), ("Emea", "EMEA"), ("Apac", "APAC")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def ten_digit_cik(cik: Column) -> Column:
    return F.lpad(F.trim(cik.cast("string")), 10, "0")


def plain_accession(accession: Column) -> Column:
    return F.regexp_replace(F.trim(accession), "-xbrl$", "")


def is_accession(accession: Column) -> Column:
    return F.coalesce(accession.rlike(r"^\d{10}-\d{2}-\d{6}$"), F.lit(False))


def filing_date_from_accession(accession: Column) -> Column:
    year = F.regexp_extract(accession, r"-(\d{2})-\d{6}", 1)
    return F.when(year != "", F.concat(F.lit("20"), year, F.lit("-01-01")))


def filing_id(accession: Column) -> Column:
    return F.substring(F.md5(accession), 1, 24)


def is_polluted_path(path: Column) -> Column:
    """A quarantine segment (404 or 555) anywhere in a path."""
    return F.coalesce(path.rlike(r"(^|\.)(404|555)(\.|$)"), F.lit(False))


def parent_path(path: Column) -> Column:
    return F.when(path.contains("."), F.regexp_replace(path, r"\.[^.]*$", ""))


def dimension_signature(dimensions: Column) -> Column:
    """axis=member pairs, sorted and joined by |, whatever the order of the map; wrapper axes don't count."""
    pairs = F.transform(F.map_entries(dimensions), lambda e: F.struct(axis_name(e["key"]).alias("a"), member_name(e["value"]).alias("m")))
    real = F.filter(pairs, lambda p: ~p["a"].isin(*WRAPPER_AXES) & (p["m"] != ""))
    return F.coalesce(F.array_join(F.array_sort(F.transform(real, lambda p: F.concat(p["a"], F.lit("="), p["m"]))), "|"), F.lit(""))


def row_key(*parts: Column) -> Column:
    """Parts joined by |; NULL is an empty part, not a missing one."""
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def parent_anchor(parent_id: Column, concept_id: Column) -> Column:
    return F.coalesce(parent_id, concept_id)


def same_parent(left_id: Column, left_name: Column, right_id: Column, right_name: Column) -> Column:
    """By id where both sides have one, else by name."""
    return F.when(left_id.isNotNull() & right_id.isNotNull(), left_id == right_id).otherwise(left_name.eqNullSafe(right_name))


def is_dimensional(parent_id: Column, parent_concept: Column) -> Column:
    """A row under a parent, whether it is named by id or by concept."""
    return parent_id.isNotNull() | (F.coalesce(parent_concept, F.lit("")) != "")
