"""Discovery, de-duplication, run counters and the normalising job."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire import values as V
from quire.operators.upserts import first_per_key


def _between(day: Column, start: str | None, end: str | None) -> Column:
    inside = F.lit(True)
    if start:
        inside = inside & (day >= F.lit(start).cast("date"))
    if end:
        inside = inside & (day <= F.lit(end).cast("date"))
    return inside


def discover(
    publications: DataFrame, ticker: str | None = None, start: str | None = None,
    end: str | None = None, stored_upper: bool = False,
) -> DataFrame:
    """Publications of a ticker, any case, in an inclusive date range.

    An ISO text time counts with the date written in it, which is the date at its own offset. The range
    is compared with the stored column itself, so the scan skips what lies outside. With
    ``stored_upper`` tickers are known to be stored in upper case and are compared as they are.
    """
    kind = publications.schema["published_at"].dataType.simpleString()
    bound = (lambda day: F.lit(str(day))) if kind == "string" else (lambda day: F.lit(str(day)).cast(kind))
    published, found = F.col("published_at"), publications
    if start:
        found = found.where(published >= bound(date.fromisoformat(start)))
    if end:
        found = found.where(published < bound(date.fromisoformat(end) + timedelta(days=1)))
    if ticker is None:
        return found
    return found.where((F.col("ticker") if stored_upper else F.upper("ticker")) == ticker.upper())


def discover_by_update_date(
    publications: DataFrame, start: str | None = None, end: str | None = None
) -> DataFrame:
    """The same range on date-only rows; their publication time is unknown."""
    return publications.where(_between(F.col("source_updated_date"), start, end)).withColumns({
        "published_at": F.lit(None).cast("timestamp_ntz"),
        "published_at_precision": F.lit("DATE"),
    })


def lookup_by_key(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose key columns are in ``keys``; one literal key is a plain filter instead."""
    return df.join(keys.distinct(), keys.columns, "left_semi")


def lookup_one(df: DataFrame, **key: object) -> DataFrame:
    condition = F.lit(True)
    for column, value in key.items():
        condition = condition & (F.col(column) == F.lit(value))
    return df.where(condition)


MIN_PDF_BYTES = 1000


def named_as_pdf() -> Column:
    return F.col("mime_type").ilike("%pdf%") | F.col("filename").ilike("%.pdf")


def pdf_candidates(df: DataFrame, min_bytes: int = MIN_PDF_BYTES) -> DataFrame:
    return df.where(named_as_pdf() & (F.col("size_bytes") > min_bytes))


def pending_attachments(attachments: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Attachments not stored yet; runs before anything that reads bytes."""
    keys = ["publication_id", "attachment_reference"]
    return attachments.join(artifacts.select(*keys), keys, "left_anti")


def with_source_path(rows: DataFrame, known_sources: DataFrame) -> DataFrame:
    """``rows`` with ``source_path``, the object path of their known source key, else null."""
    by_source = known_sources.select(
        "source", "source_document_id", F.col("object_path").alias("source_path")
    )
    return rows.join(by_source, ["source", "source_document_id"], "left")


def dedup_decision(batch: DataFrame, known_sources: DataFrame | None, known_objects: DataFrame) -> DataFrame:
    """Skip download and persist on a known source key, skip only the download on known bytes.

    Where many rows share a source key, `with_source_path` on the publications and ``known_sources`` None spare
    the batch a shuffle by that key: it has ``source_path`` then.
    """
    if known_sources is not None:
        batch = with_source_path(batch, known_sources)
    by_sha = known_objects.select("sha256", F.col("object_path").alias("sha_path"))
    same_source, same_bytes = F.col("source_path").isNotNull(), F.col("sha_path").isNotNull()
    return (
        batch.join(by_sha, "sha256", "left")
        .withColumns({
            "skip_download": same_source | same_bytes,
            "skip_persist": same_source,
            "existing_object_path": F.coalesce("source_path", "sha_path"),
            "reason": F.when(same_source, "source_document_id").when(same_bytes, "sha256"),
        })
        .drop("source_path", "sha_path")
    )


def candidate_key_distinct(attachments: DataFrame) -> DataFrame:
    """Distinct ``source:id:reference`` identities."""
    key = F.concat_ws(":", "source", "source_document_id", "attachment_reference")
    return attachments.select(key.alias("candidate_key")).distinct()


def error_summary(errors: DataFrame, by: str = "run_id", limit: int = 10) -> DataFrame:
    """The first ``limit`` errors of each run joined by '; '.

    The row number filter lets Spark cut each group to ``limit`` rows before the shuffle.
    """
    first = W.partitionBy(by).orderBy("seq")
    top = errors.where("error IS NOT NULL").withColumn("n", F.row_number().over(first))
    parts = F.array_sort(F.collect_list(F.struct("n", "error")))
    return (
        top.where(F.col("n") <= limit)
        .groupBy(by)
        .agg(F.array_join(F.transform(parts, lambda p: p["error"]), "; ").alias("error_summary"))
    )


def run_metrics(
    outcomes: DataFrame, created: DataFrame | None = None, dry_run: bool = False
) -> DataFrame:
    """Counters and final status per run, from one row per attachment.

    ``outcomes`` has run_id, publication_id, outcome (downloaded, skipped, failed), seq, error; a
    publication without attachments is a row with a null outcome. A dry run skips everything.
    """
    outcome = F.when(F.lit(dry_run) & F.col("outcome").isNotNull(), "skipped").otherwise(
        F.col("outcome")
    )
    rows = outcomes.withColumn("outcome", outcome)
    count = lambda name: F.count_if(F.col("outcome") == name)
    # Two levels, so that one large run is spread over its publications.
    per_publication = rows.groupBy("run_id", "publication_id").agg(
        count("downloaded").alias("downloaded"), count("skipped").alias("skipped"),
        count("failed").alias("failed"),
    )
    counters = per_publication.groupBy("run_id").agg(
        F.count("publication_id").alias("discovered"),
        *[F.sum(c).alias(c) for c in ("downloaded", "skipped", "failed")],
    )
    if created is not None:
        made = created.groupBy("run_id").agg(F.count_if("created").alias("publications_created"))
        counters = counters.join(made, "run_id", "left").fillna(0, ["publications_created"])
    done = (F.col("downloaded") > 0) | (F.col("skipped") > 0)
    status = (
        F.when((F.col("failed") > 0) & done, "PARTIAL")
        .when(F.col("failed") > 0, "FAILED")
        .otherwise("COMPLETED")
    )
    return counters.withColumn("status", status)


def start_finish_run(
    runs: DataFrame, metrics: DataFrame, errors: DataFrame, finished_at: Column
) -> DataFrame:
    """Run rows: the started run closed with its counters, status and error summary.

    A run without a metrics row has not finished and stays RUNNING.
    """
    return (
        runs.join(metrics, "run_id", "left")
        .join(error_summary(errors), "run_id", "left")
        .withColumn("finished_at", F.when(F.col("status").isNotNull(), finished_at))
        .withColumn("status", F.coalesce("status", F.lit("RUNNING")))
    )


def count_by_company(publications: DataFrame) -> DataFrame:
    return publications.groupBy("company_id").agg(F.count(F.lit(1)).alias("documents"))


def corpus_coverage(items: DataFrame, targets: dict[tuple[str, str], int]) -> DataFrame:
    """Items per kind and storage against the wanted minimum; a kind without items counts zero."""
    wanted = items.sparkSession.createDataFrame(
        [(kind, storage, minimum) for (kind, storage), minimum in targets.items()],
        "kind string, storage string, target bigint",
    )
    counts = items.groupBy("kind", "storage").agg(F.count(F.lit(1)).alias("items"))
    found = F.coalesce("items", F.lit(0))
    # The counts are one row per kind and storage that there is; the targets keep their rows.
    return wanted.join(counts, ["kind", "storage"], "left").select(
        "kind", "storage", "target", found.alias("items"), (found >= F.col("target")).alias("met")
    )


# --- joins over the stored tables ----------------------------------------------------------------


def company_artifacts(
    artifacts: DataFrame, publications: DataFrame, company_id: object | None = None
) -> DataFrame:
    """Artifacts of one company, or of every company, newest first within each."""
    owners = publications.select(F.col("id").alias("publication_id"), "company_id")
    if company_id is not None:
        owners = owners.where(F.col("company_id") == company_id)
    return artifacts.join(owners, "publication_id").orderBy(
        "company_id", F.desc("created_at"), F.desc("id")
    )


def company_documents_newest(publications: DataFrame, company_id: object | None = None) -> DataFrame:
    """Publications newest first within each company; an unknown time comes first, ties by id."""
    mine = publications if company_id is None else lookup_one(publications, company_id=company_id)
    return mine.orderBy("company_id", F.desc_nulls_first("published_at"), F.desc("id"))


def newest_per_sha(df: DataFrame) -> DataFrame:
    """The newest row of each digest."""
    return first_per_key(
        df.withColumn("age", F.lit(0) - F.unix_micros(F.col("created_at").cast("timestamp"))),
        ["sha256"], ["age", "id"],
    ).drop("age")


def artifact_export_candidates(
    artifacts: DataFrame, raw_objects: DataFrame, publications: DataFrame
) -> DataFrame:
    """PDF artifacts with their bytes and title, one per digest, the newest.

    What its bytes must be holds for all artifacts of a digest, so the newest is taken before the objects are
    joined; both lie by the digest then, and the artifacts are not shuffled again for them.
    """
    titles = publications.select(
        F.col("id").alias("publication_id"), F.col("title").alias("publication_title")
    )
    newest = newest_per_sha(artifacts.where(named_as_pdf()).join(titles, "publication_id"))
    objects = raw_objects.where(F.col("size_bytes") > MIN_PDF_BYTES).dropDuplicates(["sha256"])
    return newest.join(objects, "sha256")


def pattern_priority_topk(candidates: DataFrame, patterns: Sequence[str], limit: int) -> DataFrame:
    """Candidates in order of the first file name pattern they match, each digest once, top k."""
    first = F.coalesce(*[
        F.when(F.coalesce("filename", F.lit("")).rlike(f"(?i){p}"), i)
        for i, p in enumerate(patterns)
    ])
    ranked = candidates.withColumn("pattern_index", first).where("pattern_index IS NOT NULL")
    best = first_per_key(ranked, ["sha256"], ["pattern_index", "id"])
    return best.orderBy("pattern_index", "sha256").limit(limit)


def processing_requests(
    artifacts: DataFrame, raw_objects: DataFrame, publications: DataFrame
) -> DataFrame:
    """What to process: bytes are required (an error row without), the publication is optional."""
    titles = publications.select(
        F.col("id").alias("publication_id"), "title", "document_type"
    )
    paths = raw_objects.select("sha256", "object_path")
    return (
        artifacts.join(paths, "sha256", "left")
        .join(titles, "publication_id", "left")
        .withColumn(
            "error",
            F.when(
                F.col("object_path").isNull(),
                F.concat(F.lit("raw object missing for artifact: "), F.col("id").cast("string")),
            ),
        )
    )


def drop_orphan_blocks(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    return blocks.join(pages, ["document_id", "page_number"], "left_semi")


def trace_provenance(
    blocks: DataFrame, pages: DataFrame, artifacts: DataFrame, raw_objects: DataFrame,
    publications: DataFrame,
) -> DataFrame:
    """Every block with its page, artifact, publication and stored bytes."""
    source = artifacts.join(raw_objects.select("sha256", "object_path"), "sha256").join(
        publications.select(F.col("id").alias("publication_id"), "source", "source_document_id"),
        "publication_id",
    )
    source = source.select(
        F.col("id").alias("document_id"), "publication_id", "sha256", "object_path", "source",
        "source_document_id",
    )
    return blocks.join(
        pages.select("document_id", "page_number"), ["document_id", "page_number"]
    ).join(source, "document_id")


# --- wide legacy rows to three tables -------------------------------------------------------------


def backfill_raw_objects(legacy: DataFrame) -> DataFrame:
    """One object per digest, the row with the smallest text id."""
    rows = legacy.select(
        "id", "sha256", "object_path", "mime_type", F.col("file_size").alias("size_bytes")
    )
    return first_per_key(rows, ["sha256"], [F.col("id").cast("string")])


def backfill_publications(legacy: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Publications by natural key; a key the state already has is ignored."""
    columns = [c for c in legacy.columns
               if c not in ("sha256", "object_path", "mime_type", "file_size", "filename")]
    keys = ["source", "source_document_id"]
    rows = first_per_key(legacy.select(*columns), keys, [F.col("id").cast("string")])
    return rows if state is None else rows.join(state.select(*keys), keys, "left_anti")


def backfill_artifacts(legacy: DataFrame, raw_objects: DataFrame) -> DataFrame:
    """Artifacts whose reference is the legacy object path, bound to the object of their digest."""
    objects = raw_objects.select("sha256", F.col("id").alias("raw_object_id"))
    return legacy.join(objects, "sha256").select(
        "id", F.col("id").alias("publication_id"), F.col("object_path").alias("attachment_reference"),
        "filename", "mime_type", "file_size", "raw_object_id",
    )


# --- checks ---------------------------------------------------------------------------------------


def violations(**rules: Column) -> Column:
    """Names of the broken rules; a null condition counts as not broken.

    Arrays are joined, as a lambda over them would be interpreted for every row.
    """
    none = F.array().cast("array<string>")
    return F.concat(*[F.when(broken, F.array(F.lit(name))).otherwise(none) for name, broken in rules.items()])


def check_page_rows(pages: DataFrame) -> DataFrame:
    method, confidence = F.col("extraction_method"), F.col("ocr_confidence")
    return pages.withColumn("violations", violations(
        page_number=F.col("page_number") < 1,
        size=(F.col("width") <= 0) | (F.col("height") <= 0),
        native_confidence=(method == "native") & confidence.isNotNull(),
        ocr_confidence=(method == "ocr") & confidence.isNull(),
    ))


# An object of one short plain member. It is valid JSON whatever its text says, so it needs no parser.
_PLAIN_OBJECT = r'^\{"[^"\\\x00-\x1f]{1,200}":"[^"\\\x00-\x1f]{0,2000}"\}\z'


def _is_object(content: Column) -> Column:
    """Whether ``content`` is a JSON object. What parses and begins with a brace is one; its schema isn't worked out."""
    parsed = F.ltrim(content, F.lit(" \t\r\n")).startswith("{") & F.try_parse_json(content).isNotNull()
    return F.coalesce(content.rlike(_PLAIN_OBJECT) | parsed, F.lit(False))


def check_block_rows(blocks: DataFrame) -> DataFrame:
    """Box complete or absent, box ordered, index not negative, content a JSON object."""
    corners = [F.col(c).isNull().cast("int") for c in ("bbox_x0", "bbox_y0", "bbox_x1", "bbox_y1")]
    missing = sum(corners[1:], corners[0])
    return blocks.withColumn("violations", violations(
        bbox_order=(F.col("bbox_x1") < F.col("bbox_x0")) | (F.col("bbox_y1") < F.col("bbox_y0")),
        bbox_partial=missing.between(1, 3),
        block_index=F.col("block_index") < 0,
        content=~_is_object(F.col("content")),
    ))


def check_companies(companies: DataFrame) -> DataFrame:
    from quire.functions.text import normalize_ticker

    return companies.withColumns({
        "ticker": normalize_ticker(F.col("ticker")),
        "violations": violations(
            ticker=normalize_ticker(F.col("ticker")).isNull(),
            fiscal_year_end_month=~F.col("fiscal_year_end_month").between(1, 12),
        ),
    })


def check_enums(
    df: DataFrame, columns: dict[str, str], confidences: Sequence[str] = ()
) -> DataFrame:
    """Columns checked against their value list, and confidences against [0, 1]."""
    rules = {c: ~F.col(c).isin(*V.ENUMS[enum]) for c, enum in columns.items()}
    rules |= {c: ~F.col(c).between(0.0, 1.0) | F.isnan(c) for c in confidences}
    return df.withColumn("violations", violations(**rules))
