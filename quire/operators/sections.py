"""Statement headings in page text, and document classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire import values as V
from quire.functions.text import (
    LINE_WITH_BREAK,
    bind,
    computed_once,
    first_matching,
    first_rule,
    fold_text,
    strip,
)

PAGE = ("document_id", "page_number")


def lines_with_breaks(text: Column) -> Column:
    """Lines of a text with their terminators, so that lengths add up to offsets."""
    return F.regexp_extract_all(text, F.lit(LINE_WITH_BREAK), F.lit(0))


def _rule_struct(rule: V.HeadingRule) -> Column:
    return F.struct(
        F.lit(rule.section).alias("section"), F.lit(rule.name).alias("matched_rule"),
        F.lit(rule.confidence).alias("confidence"), F.lit(rule.priority).alias("priority"),
    )


def heading_rule(
    line: Column, rules: Sequence[V.HeadingRule] = V.HEADING_RULES,
    max_chars: int = V.MAX_HEADING_CHARS,
) -> Column:
    """The highest-priority rule a line matches; null for a long, blank or ordinary line."""
    ordered = sorted(rules, key=lambda rule: -rule.priority)
    match = lambda folded: first_rule(folded, ordered, _rule_struct)
    return bind(strip(line), lambda bare: F.when(
        F.length(bare).between(1, max_chars), bind(fold_text(bare), match)
    ))


def split_lines(pages: DataFrame) -> DataFrame:
    """One row per line with its 0-based number and character offset.

    The offset window holds the lines of one page, that is of one input row.
    """
    before = W.partitionBy(*PAGE).orderBy("line_no").rowsBetween(W.unboundedPreceding, -1)
    lines = pages.select(
        *PAGE, F.posexplode(lines_with_breaks(F.col("text"))).alias("line_no", "raw")
    )
    return lines.select(
        *PAGE, "line_no",
        F.coalesce(F.sum(F.length("raw")).over(before), F.lit(0)).cast("bigint").alias("start_char"),
        F.rtrim(F.col("raw"), F.lit("\r\n")).alias("line"),
    )


def match_headings(
    lines: DataFrame, rules: Sequence[V.HeadingRule] = V.HEADING_RULES,
    max_chars: int = V.MAX_HEADING_CHARS,
) -> DataFrame:
    """Lines that are headings, each with the one rule it matches."""
    matched = lines.select(
        "*", computed_once(heading_rule(F.col("line"), rules, max_chars)).alias("rule")
    )
    return matched.where("rule IS NOT NULL").select(
        *lines.columns, F.col("rule.section"), F.col("rule.matched_rule"), F.col("rule.confidence"),
        F.col("rule.priority"),
    )


def text_headings(text: Column, rules: Sequence[V.HeadingRule] = V.HEADING_RULES) -> Column:
    """Array of (line number, line, rule) of the heading lines of a text."""
    return _heading_lines(lines_with_breaks(text), rules)


def _heading_lines(lines: Column, rules: Sequence[V.HeadingRule]) -> Column:
    numbered = F.transform(lines, lambda line, i: F.struct(
        i.alias("line_no"), strip(line).alias("line"), heading_rule(line, rules).alias("rule")
    ))
    return F.filter(numbered, lambda x: x["rule"].isNotNull())


def collect_section_hits(
    pages: DataFrame, rules: Sequence[V.HeadingRule] = V.HEADING_RULES,
    one_hit_per_section: bool = True,
) -> DataFrame:
    """Section headings per page, the first of each section unless told otherwise.

    All the work is inside one row, so nothing is shuffled and lines without a heading are never
    exploded. A text is parted into lines once; offsets are summed for the hits only.
    """
    parted = bind(lines_with_breaks(F.col("text")), lambda lines: F.struct(
        lines.alias("lines"), _heading_lines(lines, rules).alias("hits")))
    found = pages.select(*PAGE, computed_once(parted).alias("x")).where(F.size("x.hits") > 0).select(*PAGE, "x.*")
    hits = F.col("hits")
    if one_hit_per_section:
        def first_of(section: str) -> Column:
            return F.get(F.filter(hits_found, lambda x: x["rule"]["section"] == section), F.lit(0))

        hits_found = hits
        firsts = [first_of(section) for section in sorted({rule.section for rule in rules})]
        hits = F.array_sort(F.array_compact(F.array(*firsts)))
    lines = F.col("lines")
    placed = F.transform(hits, lambda x: F.struct(
        x["line_no"].alias("line_no"),
        x["rule"]["section"].alias("section"),
        x["rule"]["matched_rule"].alias("matched_rule"),
        x["line"].alias("matched_text"),
        x["rule"]["confidence"].alias("confidence"),
        F.aggregate(F.slice(lines, 1, x["line_no"]), F.lit(0).cast("bigint"),
                    lambda total, line: total + F.length(line)).alias("start_char"),
    ))
    return found.select(*PAGE, F.inline(placed)).drop("line_no")


def best_heading(
    text: Column, rules: Sequence[V.HeadingRule] = V.HEADING_RULES, headings: Column | None = None
) -> Column:
    """Heading of highest priority, the earliest of equals; else the first 180 characters as one line.

    ``headings`` are the `text_headings` of the text, where they are known.
    """
    known = text_headings(text, rules) if headings is None else headings
    ranked = F.array_sort(F.transform(known, lambda x: F.struct(
        (-x["rule"]["priority"]).alias("rank"), x["line_no"].alias("line_no"),
        x["rule"]["section"].alias("section"), x["line"].alias("matched_text"),
        x["rule"]["confidence"].alias("confidence"),
    )))
    start = F.substring(strip(text), 1, V.MAX_HEADING_CHARS)
    heading = lambda section, matched, confidence: F.struct(
        section.alias("section"), matched.alias("matched_text"), confidence.alias("confidence"))
    whole = bind(heading_rule(start, rules), lambda rule: F.when(
        rule.isNotNull(), heading(rule["section"], start, rule["confidence"])))
    return bind(F.get(ranked, F.lit(0)), lambda first: F.when(
        first.isNotNull(), heading(first["section"], first["matched_text"], first["confidence"])
    ).otherwise(whole))


def distinct_sections(
    text: Column, rules: Sequence[V.HeadingRule] = V.HEADING_RULES, headings: Column | None = None
) -> Column:
    known = text_headings(text, rules) if headings is None else headings
    return F.array_distinct(F.transform(known, lambda x: x["rule"]["section"]))


def sheet_section_hits(
    sheets: DataFrame, rules: Sequence[V.HeadingRule] = V.HEADING_RULES
) -> DataFrame:
    """Sheet names read as headings; the first sheet of each section in the workbook."""
    named = sheets.select(
        "*", computed_once(heading_rule(F.col("sheet_name"), rules)).alias("rule")
    ).where("rule IS NOT NULL")
    first = F.min(F.struct("sheet_index", "sheet_name", "rule")).alias("first")
    return named.groupBy("document_id", F.col("rule.section").alias("section")).agg(first).select(
        "document_id", "section", F.col("first.rule.matched_rule").alias("matched_rule"),
        F.col("first.sheet_name").alias("matched_text"),
        F.col("first.rule.confidence").alias("confidence"),
        (F.col("first.sheet_index") + 1).alias("page_number"),
    )


def first_hit_per_section(hits: DataFrame) -> DataFrame:
    """First hit of each section of a page, by offset."""
    rest = [c for c in hits.columns if c not in (*PAGE, "section")]
    first = F.min(F.struct("start_char", *[c for c in rest if c != "start_char"])).alias("first")
    return hits.groupBy(*PAGE, "section").agg(first).select(*PAGE, "section", "first.*")


def sections_found(hits: DataFrame) -> DataFrame:
    """Distinct sections of a document in first-seen order, each with its first page."""
    firsts = hits.groupBy("document_id", "section").agg(
        F.min(F.struct("page_number", "start_char")).alias("at")
    )
    # One entry per section of the rule list.
    ordered = F.array_sort(F.collect_list(F.struct("at", "section")))
    return firsts.groupBy("document_id").agg(ordered.alias("s")).select(
        "document_id",
        F.transform("s", lambda x: x["section"]).alias("sections_found"),
        F.transform("s", lambda x: x["at"]["page_number"]).alias("first_pages"),
    )


def merge_section_hits(primary: DataFrame, extra: DataFrame) -> DataFrame:
    """Primary hits plus the extra ones not there yet, by section, page and text."""
    key = ["document_id", "page_number", "section", "matched_text"]
    rest = [c for c in extra.columns if c not in key]
    new = extra.join(primary.select(*key), key, "left_anti").groupBy(*key).agg(
        F.min(F.struct(*sorted(rest, key=lambda c: c != "start_char"))).alias("first")
    ).select(*key, "first.*")
    return primary.unionByName(new.select(*primary.columns))


def section_hints(hits: DataFrame) -> DataFrame:
    """The section of each page that has exactly one."""
    return (
        hits.groupBy("document_id", F.col("page_number").alias("page"))
        .agg(F.min("section").alias("section_hint"), F.max("section").alias("last"))
        .where("section_hint = last")
        .drop("last")
    )


def section_hint_join(tables: DataFrame, hits: DataFrame) -> DataFrame:
    return tables.join(section_hints(hits), ["document_id", "page"], "left")


# --- document classes -----------------------------------------------------------------------------


def class_rule(
    *fields: Column, rules: Sequence[V.ClassRule] = V.CLASS_RULES
) -> Column:
    """First rule that any field matches; the order of rules beats the order of fields.

    Each field is tested by itself, so anchors and wildcards of a rule stay within it. They are folded
    as one text and parted again.
    """
    result = lambda rule: F.struct(
        F.lit(rule.document_class).alias("document_class"),
        F.lit(rule.confidence).alias("confidence"), F.lit(rule.name).alias("matched_pattern"),
    )
    parted = bind(F.concat_ws("\x00", *fields), lambda text: F.split(fold_text(text), "\x00"))
    return bind(parted, lambda folded: first_matching(
        lambda pattern: F.exists(folded, lambda field: field.rlike(pattern)), rules, result))


def metadata_class(metadata: Column) -> Column:
    """Class named by the metadata: the class keys first, then the type keys."""
    table = F.create_map(*[F.lit(x) for pair in V.TYPE_TO_CLASS.items() for x in pair])
    hits = []
    for keys, confidence in (
        (V.METADATA_CLASS_KEYS, V.METADATA_CLASS_CONFIDENCE),
        (V.METADATA_TYPE_KEYS, V.METADATA_TYPE_CONFIDENCE),
    ):
        for key in keys:
            mapped = F.try_element_at(
                table, F.lower(strip(F.try_element_at(metadata, F.lit(key))))
            )
            hits.append(F.when(mapped.isNotNull(), F.struct(
                mapped.alias("document_class"), F.lit(confidence).alias("confidence"),
                F.lit(f"metadata:{key}").alias("reason"),
            )))
    return F.coalesce(*hits)


def classify_by_metadata(docs: DataFrame) -> DataFrame:
    return docs.withColumn("m", metadata_class(F.col("metadata"))).select(
        *[c for c in docs.columns if c != "metadata"], "m.document_class", "m.confidence", "m.reason"
    )


def classify_documents(
    docs: DataFrame, rules: Sequence[V.ClassRule] = V.CLASS_RULES,
    accept_confidence: float = V.ACCEPT_CONFIDENCE,
) -> DataFrame:
    """Class, method, confidence, pattern and reason from title, file name, text sample, metadata."""
    if not 0.0 <= accept_confidence <= 1.0:
        raise ValueError("accept_confidence must be in [0, 1]")
    p, m = F.col("p"), F.col("m")
    found = docs.withColumns({
        "p": class_rule(F.col("title"), F.col("filename"), F.col("text_sample"), rules=rules),
        "m": metadata_class(F.col("metadata")),
    })
    none = F.lit(None).cast("string")

    def outcome(cls, method, confidence, pattern, reason):
        return F.struct(
            cls.alias("document_class"), F.lit(method).alias("method"),
            confidence.alias("confidence"), pattern.alias("matched_pattern"), reason.alias("reason"),
        )

    def by_pattern(reason):
        return outcome(p["document_class"], "pattern", p["confidence"], p["matched_pattern"],
                       F.lit(reason))

    result = (
        F.when(p["confidence"] >= accept_confidence, by_pattern("pattern_match"))
        .when(m["confidence"] >= accept_confidence,
              outcome(m["document_class"], "metadata", m["confidence"], none, m["reason"]))
        .when(p.isNotNull(), by_pattern("pattern_below_threshold"))
        .otherwise(outcome(F.lit("other"), "pattern", F.lit(0.0), none,
                           F.lit("unmatched_needs_llm")))
    )
    kept = [c for c in docs.columns if c not in ("title", "filename", "text_sample", "metadata")]
    return found.select(*kept, result.alias("r")).select(*kept, "r.*")
