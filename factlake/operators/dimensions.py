"""Dimensional facts: concepts, segments, breakdowns and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import canonical as C
from ..functions import text as T
from . import merge

# --- fixed values -----------------------------------------------------------
#: Segment type by parts of a concept's and of a label's lower-case text, in order of priority.
CONSOLIDATION_PARTS = ("consolidation", "elimination", "reconciling", "materialreconcilingitems", "corporate", "unallocated")
CONSOLIDATION_WORDS = ("consolidation", "elimination", "reconciling", "corporate", "unallocated")
PLACE_PARTS = ("geographic", "region", "americas", "europe", "asia", "china", "japan", "pacific", "othercountries")
PLACE_WORDS = ("us", "united states", "china", "europe", "asia", "america", "japan", "country", "region", "countries")
EQUITY_PARTS = ("equity", "stock", "shares", "retained", "earnings", "retainedearningsmember", "commonstockmember")
EQUITY_WORDS = ("equity", "stock", "shares", "retained", "earnings")
BUSINESS_PARTS = ("segmentmember", "divisonmember", "operatingsegmentsmember")
BUSINESS_WORDS = ("segment", "division", "operating segments")
PRODUCT_PARTS = ("productmember", "servicemember", "salesmember", "leasingmember")
PRODUCT_WORDS = ("product", "service", "sales", "leasing")
INDUSTRY_PARTS = ("automotive", "energy")
BUSINESS_TERMS = ("business", "operating")
VAGUE_TYPES = ("concept", "other", "unknown")
READABLE_BLANKS = ("", "Unknown Fact", "Unknown")
LABEL_BLANKS = ("", "Unknown", "N/A")


def filing_currency(facts: DataFrame, keys: list[str], unit: str = "unit") -> DataFrame:
    """keys, currency: the one unit of a filing; USD where there is none or several."""
    units = F.collect_set(T.plain_unit(F.col(unit)))
    return facts.groupBy(*keys).agg(units.alias("_u")).select(*keys, F.when(F.size("_u") == 1, F.col("_u")[0]).otherwise("USD").alias("currency"))


def dimensional_concepts(items: DataFrame, keys: list[str], position: str = "position") -> DataFrame:
    """keys, parent, segment_type, concept, fact: each once, with its last fact.

    ``items``: keys, position, concept, facts (structs with concept_name,
    dimensions, qualified). A fact belongs to the concept that it names, or
    else to its item; facts without dimensions or of no known segment go.
    """
    rows = items.select(*keys, position, F.col("concept").alias("_item"), F.posexplode("facts").alias("_at", "fact"))
    info = C.segment_info(F.col("fact.dimensions"), F.col("fact.qualified"))
    rows = rows.withColumns({"_info": info, "parent": F.coalesce("fact.concept_name", "_item")}).filter("_info.segment_type <> 'unknown' or _info.concept <> 'unknown'")
    last = F.max_by("fact", F.struct(position, "_at"))
    return rows.groupBy(*keys, "parent", F.col("_info.segment_type").alias("segment_type"), F.col("_info.concept").alias("concept")).agg(last.alias("fact"))


def type_of_concept(concept: Column, label: Column) -> Column:
    """Segment type by the words of a concept and its label."""
    c, text = F.lower(concept), F.lower(F.coalesce(label, F.lit("")))
    has = C._has
    return (
        F.when(has(c, CONSOLIDATION_PARTS) | has(text, CONSOLIDATION_WORDS), "consolidation")
        .when(c.startswith("country:") | has(c, PLACE_PARTS) | has(text, PLACE_WORDS), "geographic")
        .when(has(c, EQUITY_PARTS) | has(text, EQUITY_WORDS), "equity")
        .when(has(c, BUSINESS_PARTS) | has(text, BUSINESS_WORDS), "business_segment")
        .when(has(c, PRODUCT_PARTS) | has(text, PRODUCT_WORDS) | has(c, INDUSTRY_PARTS) | has(text, INDUSTRY_PARTS), "product_service")
        .when(c.contains("member") & ~has(c, BUSINESS_TERMS) & ~has(text, BUSINESS_TERMS), "product_service")
        .otherwise("other")
    )


def standard_breakdown(fields: Column) -> Column:
    """struct(concept, label, segment_type) from a record of either form, a map of its fields.

    The newer form has a concept; the older has <kind>_id, <kind>_label and
    <kind>_type, the first such kind counts. A vague type is found from the names.
    """

    def at(key: Column | str) -> Column:
        return F.nullif(F.try_element_at(fields, key if isinstance(key, Column) else F.lit(key)), F.lit(""))

    kind = F.get(F.transform(F.filter(F.map_keys(fields), lambda k: k.endswith("_id")), lambda k: F.regexp_replace(k, "_id$", "")), F.lit(0))
    newer = F.map_contains_key(fields, "concept")
    concept = F.when(newer, at("concept")).otherwise(at(F.concat(kind, F.lit("_id"))))
    label = F.when(newer, at("label")).otherwise(F.coalesce(at(F.concat(kind, F.lit("_label"))), at("label")))
    named = F.when(newer, at("segment_type")).otherwise(F.coalesce(at(F.concat(kind, F.lit("_type"))), kind))
    named = F.coalesce(named, at("segment_type"), F.lit("other"))
    out = F.when(named.isin(*VAGUE_TYPES) & concept.isNotNull(), type_of_concept(concept, label)).otherwise(named)
    return F.struct(F.coalesce(concept, F.lit("unknown")).alias("concept"), F.coalesce(label, concept, F.lit("Unknown")).alias("label"), out.alias("segment_type"))


def axis_summary(facts: DataFrame, keys: list[str], dimensions: str = "dimensions") -> DataFrame:
    """keys, facts, dimensional, plain, axes, members, percent: how far a filing's facts have dimensions."""
    dims = F.coalesce(F.size(dimensions), F.lit(0)) > 0
    per = facts.groupBy(*keys).agg(F.count("*").alias("facts"), F.count_if(dims).alias("dimensional"))
    pairs = facts.filter(dims).select(*keys, F.explode(F.map_entries(dimensions)).alias("_e")).groupBy(*keys).agg(F.count_distinct("_e.key").alias("axes"), F.count_distinct("_e.value").alias("members"))
    out = per.join(pairs, keys, "left").withColumns({"plain": F.col("facts") - F.col("dimensional"), "axes": F.coalesce("axes", F.lit(0)), "members": F.coalesce("members", F.lit(0))})
    return out.withColumn("percent", F.round(F.col("dimensional") / F.col("facts") * 100, 2))


def statement_stats(items: DataFrame, keys: list[str]) -> DataFrame:
    """Counts and rates (percent, one decimal) of a statement's items (value, abstract, level, dimensions, facts, calculation children and parents)."""
    n_facts = F.greatest(F.coalesce(F.size("facts"), F.lit(0)), F.lit(0))
    n_values = F.coalesce(F.size(F.filter("facts", lambda f: f["value"].isNotNull())), F.lit(0))
    n_values = F.greatest(n_values, F.lit(0))
    any_dims = (F.coalesce(F.size("dimensions"), F.lit(0)) > 0) | (n_facts > 0)
    out = items.groupBy(*keys).agg(
        F.count("*").alias("items"), F.count("value").alias("with_values"), F.count_if("abstract").alias("abstract_items"), F.count_if(any_dims).alias("with_dimensions"),
        F.sum(n_facts).alias("facts"), F.sum(n_values).alias("fact_values"), F.count_if(F.col("calculation_children") > 0).alias("summation_parents"),
        F.count_if(F.col("calculation_parents") > 0).alias("summation_children"), F.max("level").alias("deepest"),
    )

    def rate(a: str, b: str) -> Column:
        return F.coalesce(F.round(F.try_divide(F.col(a) * 100, F.col(b)), 1), F.lit(0.0))

    return out.withColumns({"value_rate": rate("with_values", "items"), "dimension_rate": rate("with_dimensions", "items"), "fact_value_rate": rate("fact_values", "facts"), "parent_rate": rate("summation_parents", "items"), "child_rate": rate("summation_children", "items")})


def is_cryptic(concept: Column) -> Column:
    """A name of long numbers or technical prefixes, or with two weaker signs: very long, many underscores, no camel case."""
    local = T.local_name(concept)
    strong = local.rlike(r"\d{3,}") | (concept.contains("_") & concept.contains("us-gaap"))
    weak = (F.length(local) > 50).cast("int") + (F.length(local) - F.length(F.replace(local, F.lit("_"), F.lit(""))) > 3).cast("int") + (~local.rlike("[A-Z][a-z]")).cast("int")
    return (concept == "") | strong | (weak >= 2)


def identification(facts: DataFrame) -> DataFrame:
    """Adds issues (array), problematic and score: how well a fact (fact_label, concept_name, dimensions, identifier) can be identified."""
    label, concept, name = (F.coalesce(F.col(c), F.lit("")) for c in ("fact_label", "concept_name", "identifier"))
    no_label, no_name = label.isin(*LABEL_BLANKS), name.isin(*READABLE_BLANKS)
    no_dims = F.coalesce(F.size("dimensions"), F.lit(0)) <= 0
    cryptic = (concept != "") & is_cryptic(concept)
    issues = F.array_compact(F.array(F.when(no_label, "no_label"), F.when(no_dims, "empty_dimension_details"), F.when(cryptic, "cryptic_concept_name"), F.when(no_name, "no_readable_identifier")))
    points = F.when(no_name, 0).otherwise(4) + F.when(no_label, 0).otherwise(3) + F.when(no_dims, 0).otherwise(2) + F.when((concept != "") & ~cryptic, 1).otherwise(0)
    return facts.withColumns({"issues": issues, "problematic": F.size(issues) >= 2, "score": points / 10})


def identification_report(facts: DataFrame, keys: list[str]) -> DataFrame:
    """Counts of each issue, of problematic facts, and which suggestions they call for."""
    rows = identification(facts)

    def n(issue: str) -> Column:
        return F.count_if(F.array_contains("issues", issue)).alias(issue)

    out = rows.groupBy(*keys).agg(F.count("*").alias("facts"), n("no_label"), n("empty_dimension_details"), n("cryptic_concept_name"), n("no_readable_identifier"), F.count_if("problematic").alias("problematic"))
    over = lambda c, share: F.when(F.col(c) > F.col("facts") * share, c)
    return out.withColumn("suggestions", F.array_compact(F.array(over("no_label", 0.3), over("empty_dimension_details", 0.5), over("cryptic_concept_name", 0.2), over("problematic", 0.1))))


def inferred_headers(dims: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Adds parent_header to ``dims`` (keys, row, parent_concept, segment_type).

    In this order: the header of a stored member of the same type under the same
    parent; a stored custom header there whose words meet the type; the type's
    own header; the only stored header; with none stored, any member's header.
    ``stored``: keys, position, concept, dimensional, parent_concept, segment_type, parent_header.
    """
    on = [*keys, "parent_concept"]
    asked = [*on, "segment_type"]
    low = F.lower(F.trim("segment_type"))
    members = stored.filter("dimensional and parent_header is not null and parent_header <> ''")
    same = members.groupBy(*asked).agg(F.min_by("parent_header", "position").alias("_same"))
    loose = members.groupBy(*on).agg(F.min_by("parent_header", "position").alias("_loose"))
    headers = stored.filter("not dimensional and startswith(concept, 'custom:')").groupBy(*on, "concept").agg(F.min(F.struct("position", "concept")).alias("_at"), F.count("*").alias("_n"))
    first = headers.groupBy(*on).agg(F.sum("_n").alias("_n"), F.min("_at")["concept"].alias("_first"))
    asks = dims.select(*asked).distinct()
    # Each type under each parent meets each name of a header once, however many rows have them.
    meets = F.lower("concept").contains(low) | F.arrays_overlap(T.concept_tokens(low), T.concept_tokens(F.col("concept")))
    fitting = asks.filter(F.coalesce(low, F.lit("")) != "").join(headers, on).filter(meets).groupBy(*asked).agg(F.min("_at")["concept"].alias("_fitting"))
    rows = asks.join(same, asked, "left").join(fitting, asked, "left").join(loose, on, "left").join(first, on, "left")
    only = F.when(F.col("_n") == 1, F.col("_first")).when(F.col("_n").isNull(), F.col("_loose"))
    answers = rows.select(*asked, F.coalesce("_same", "_fitting", C.segment_header(F.col("segment_type")), only).alias("parent_header"))
    return merge.null_safe_join(dims.drop("parent_header"), answers, asked, "left")
