"""Secret scans: credential patterns, and how many owners and repositories each found value appears in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import table, written
from quire.llm.registry import query

#: The patterns of the base kinds. Runs shorter than asked for are left out by the pattern
#: itself where a run cannot begin inside another, and after matching for assignments.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Runs in mixed case with digits, which are no base kind; they are added spans.
MIXED = r"[A-Za-z0-9_+/-]{24,}"
KINDS = ("assign", "access", "hex", "mixed")
SHORTEST_VALUE = 6
#: A value that so many owners have in so many repositories is a widely copied example.
EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES = 3, 3

SPAN = "struct<start:int,kind:int,end:int,value:string>"


def matches(text: Column, pattern: str, kind: str, value_group: int = 0, shortest: int = 0) -> Column:
    """Leftmost non-overlapping matches as an array of spans, in code points, end exclusive.

    The pieces between matches give the places: a match starts where the pieces and matches before it end.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    empty = F.array().cast(f"array<{SPAN}>")

    def add(state: Column, i: Column) -> Column:
        hit = F.element_at(state["hits"], i)
        start = state["at"] + F.length(F.element_at(state["gaps"], i))
        value = F.regexp_extract(hit, pattern, value_group) if value_group else hit
        span = F.struct(start.cast("int").alias("start"), F.lit(KINDS.index(kind)).alias("kind"),
                        (start + F.length(hit)).cast("int").alias("end"), value.alias("value"))
        keep = F.length(value) >= shortest if shortest else F.lit(True)
        return F.struct((start + F.length(hit)).cast("int").alias("at"), state["hits"].alias("hits"),
                        state["gaps"].alias("gaps"),
                        F.concat(state["spans"], F.filter(F.array(span), lambda _: keep)).alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), hits.alias("hits"), gaps.alias("gaps"), empty.alias("spans"))
    found = F.aggregate(F.sequence(F.lit(1), F.regexp_count(text, F.lit(pattern))), begin, add, lambda s: s["spans"])
    return F.when(text.rlike(pattern), found).otherwise(empty)


def base_spans(text: Column) -> Column:
    """Spans of the base kinds, by start and then in the order of ``KINDS``."""
    return F.array_sort(F.concat(
        matches(text, ASSIGN, "assign", 2, SHORTEST_VALUE), matches(text, ACCESS, "access"), matches(text, HEX, "hex")))


def mixed_spans(text: Column, base: Column) -> Column:
    """Mixed runs with a digit and letters of both cases that overlap no base span."""
    return F.filter(matches(text, MIXED, "mixed"), lambda s: (
        s["value"].rlike("[0-9]") & s["value"].rlike("[a-z]") & s["value"].rlike("[A-Z]")
        & ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def ownership(candidates: DataFrame) -> DataFrame:
    """(digest, owners, repositories) of (digest, owner, repository): distinct ones, counted level by level.

    Each level is summed before it is shuffled, so a value that a third of all rows hold is no hot group.
    """
    return (candidates.groupBy("digest", "owner", "repository").agg(F.count("*").alias("rows"))
            .groupBy("digest", "owner").agg(F.count("*").alias("repositories"))
            .groupBy("digest").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories")))


def judged_spans(docs: DataFrame, kept: list[str], owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """(doc, base, spans): the ``kept`` columns of each row, its base spans, and base and added spans judged.

    All values found in the corpus are counted by distinct owners and repositories. What at least
    ``EXAMPLE_OWNERS`` owners and ``EXAMPLE_REPOSITORIES`` repositories hold is a widely copied example; what
    is left looks live. Mixed runs are added as spans and judged by the same bound. A missing owner or repository
    counts as one of its own. A null text has no spans; rows without any have null in ``spans``.
    Rows are told apart by a number that is written with them, so null and repeated ids are fine.
    """
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("\0"))
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select(F.struct(*kept).alias("doc"), name(owner).alias("owner"), name(repository).alias("repository"),
                        text.alias("text")).withColumn("base", base_spans(F.col("text")))
    found = written(found.withColumn("mixed", mixed_spans(F.col("text"), F.col("base"))).withColumn(
        "row", F.monotonically_increasing_id()).drop("text"), "secret-spans")
    values = found.where((F.size("base") > 0) | (F.size("mixed") > 0)).select(
        "row", "owner", "repository", F.explode(F.concat("base", "mixed")).alias("span")
    ).withColumn("digest", F.sha2("span.value", 256))
    judged = values.join(ownership(values), "digest").select("row", F.struct(
        "span.start", "span.kind", "span.end", "span.value",
        ((F.col("owners") >= EXAMPLE_OWNERS) & (F.col("repositories") >= EXAMPLE_REPOSITORIES)).alias("example"),
    ).alias("span"))
    per_row = judged.groupBy("row").agg(F.array_sort(F.collect_list("span")).alias("spans"))
    return found.join(per_row, "row", "left").select("doc", "base", "spans")


def secret_scan(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_examples) per row of ``docs``.

    See ``judged_spans``. ``spans`` lists base and added spans; the first counts and the digest are of base
    spans, the last two of all.
    """
    judged = judged_spans(docs, ["doc_id"], owner, repository)
    of_kind = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    among = lambda test: F.when(F.col("spans").isNull(), 0).otherwise(
        F.size(F.filter("spans", test))).cast("long")
    return judged.select(
        "doc.doc_id", *(of_kind(kind).alias(f"n_{kind}") for kind in KINDS[:3]),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        F.coalesce(listed(F.col("spans")), F.lit("")).alias("spans"),
        among(lambda s: ~s["example"]).alias("n_live"), among(lambda s: s["example"]).alias("n_examples"))


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by a label; overlapping spans are one."""
    begin = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def add(state: Column, span: Column) -> Column:
        at, label = state["at"], F.when(span["example"], F.lit("[EXAMPLE]")).otherwise(F.lit("[SECRET]"))
        more = F.concat(state["out"], F.substring(text, at + 1, span["start"] - at), label)
        return F.struct(F.when(span["start"] >= at, more).otherwise(state["out"]).alias("out"),
                        F.greatest(at, span["end"]).alias("at"))

    return F.aggregate(spans, begin, add, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))


def redact_secrets(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """``docs``, all rows and columns, with secrets in ``text`` replaced by ``[SECRET]`` or ``[EXAMPLE]``.

    Only rows with a match of any pattern are judged and shuffled; the others go through as they are.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    suspect = text.rlike("|".join((ACCESS, HEX, MIXED, ASSIGN)))
    judged = judged_spans(docs.where(suspect), docs.columns, owner, repository)
    shown = F.when(F.col("spans").isNull(), F.col("doc.text")).otherwise(redacted(F.col("doc.text"), F.col("spans")))
    return judged.select(*((shown if c == "text" else F.col("doc")[c]).alias(c) for c in docs.columns)).unionByName(
        docs.where(~suspect))


@query("op3_secret_scan")
def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan(table(spark, folder, "documents"))
