"""Value lists, thresholds, rules and patterns.

Everything here must equal the published behaviour for results to agree. Rules are plain data and
every operator that uses them takes them as a parameter.
"""

from __future__ import annotations

from typing import NamedTuple

# --- fixed values: enumerations -----------------------------------------------------------------
EXCHANGES = ("HOSE", "HNX", "UPCOM")
SOURCES = ("HOSE", "HNX", "SSC", "ISSUER_IR", "FIXTURE")
DOCUMENT_TYPES = (
    "periodic_report", "financial_statement", "event_disclosure", "material_disclosure", "other",
)
SCOPES = ("consolidated", "parent", "standalone", "unknown")
AUDIT_STATUSES = ("audited", "unaudited", "unknown")
PROCESSING_STATUSES = ("PENDING", "PROCESSING", "PROCESSED", "NEEDS_REVIEW", "FAILED")
TERMINAL_STATUSES = ("PROCESSED", "NEEDS_REVIEW", "FAILED")
FILE_TYPES = ("PDF", "XLS", "XLSX", "DOCX", "unknown")
EXTRACTION_METHODS = ("native", "ocr")
BLOCK_TYPES = ("text", "table", "image")
RUN_STATUSES = ("RUNNING", "COMPLETED", "PARTIAL", "FAILED")
VERSION_RESOLUTIONS = ("NEW_DOCUMENT", "DUPLICATE", "NEW_VERSION", "CORRECTION")
DOCUMENT_CLASSES = (
    "financial_statement", "annual_report", "management_explanation", "board_resolution",
    "shareholder_document", "material_disclosure", "other",
)

ENUMS = {
    "exchange": EXCHANGES,
    "source": SOURCES,
    "document_type": DOCUMENT_TYPES,
    "scope": SCOPES,
    "audit_status": AUDIT_STATUSES,
    "processing_status": PROCESSING_STATUSES,
    "file_type": FILE_TYPES,
    "extraction_method": EXTRACTION_METHODS,
    "block_type": BLOCK_TYPES,
    "run_status": RUN_STATUSES,
    "version_resolution": VERSION_RESOLUTIONS,
}

# --- fixed values: thresholds and policy names ----------------------------------------------------
MIN_NATIVE_CHARS = 50
HIGH_IMAGE_COVERAGE = 0.20
LOW_IMAGE_COVERAGE = 0.05
OCR_POLICY_VERSION = "ocr-policy-v1"
MIN_OCR_CONFIDENCE = 0.60
OCR_QUALITY_VERSION = "ocr-quality-v1"
ACCEPT_CONFIDENCE = 0.60
MAX_HEADING_CHARS = 180
MAX_UNIT_CHARS = 120
MAX_HEADER_ROWS = 4
MAX_FILE_BYTES = 50 * 1024 * 1024
STALE_AFTER_SECONDS = 3600
TEXT_SAMPLE_PAGES = 5
TEXT_SAMPLE_CHARS = 4000
REPLACE_OVERLAP = 0.8


class ClassRule(NamedTuple):
    document_class: str
    pattern: str
    confidence: float
    name: str


class HeadingRule(NamedTuple):
    section: str
    pattern: str
    confidence: float
    name: str
    priority: int


SEPARATOR = r"[\s_\-]+"


def spaced(pattern: str) -> str:
    """Read every blank in a rule as 'blanks, underscores or hyphens'."""
    return pattern.replace(" ", SEPARATOR)


# --- fixed values: document class rules on folded text, in order of precedence --------------------
CLASS_RULES = (
    ClassRule(
        "management_explanation",
        spaced(
            r"\b(thuyet minh bao cao tai chinh|giai trinh|management discussion|md\s*&\s*a"
            r"|explanation of (?:the )?(?:board|management))\b"
        ),
        0.88,
        "management_explanation",
    ),
    ClassRule(
        "financial_statement",
        spaced(r"\b(bao cao tai chinh|bctc|financial statements?)\b"),
        0.92,
        "financial_statement",
    ),
    ClassRule(
        "annual_report", spaced(r"\b(bao cao thuong nien|annual report)\b"), 0.90, "annual_report"
    ),
    ClassRule(
        "board_resolution",
        spaced(
            r"\b(nghi quyet (?:hdqt|hoi dong quan tri)|board (?:of directors )?resolution"
            r"|resolution of the board)\b"
        ),
        0.90,
        "board_resolution",
    ),
    ClassRule(
        "shareholder_document",
        spaced(r"\b(dhcd|dai hoi co dong|co dong|shareholders?(?: meeting)?|agm\b)\b"),
        0.85,
        "shareholder_document",
    ),
    ClassRule(
        "material_disclosure",
        spaced(
            r"\b(cong bo thong tin|cbtt|information disclosures?|material disclosure"
            r"|unusual transaction)\b"
        ),
        0.86,
        "material_disclosure",
    ),
)

# --- fixed values: statement heading rules on folded lines, highest priority first ----------------
HEADING_RULES = (
    HeadingRule(
        "notes", spaced(r"^thuyet minh bao cao tai chinh(?:\b.*)?$"), 0.92, "vi_notes", 100
    ),
    HeadingRule(
        "balance_sheet",
        spaced(r"\b(bang can doi ke toan|bao cao tinh hinh tai chinh)\b"),
        0.95,
        "vi_balance_sheet",
        90,
    ),
    HeadingRule(
        "income_statement",
        spaced(
            r"\b(bao cao ket qua hoat dong kinh doanh|bao cao lai lo|ket qua hoat dong kinh doanh)\b"
        ),
        0.95,
        "vi_income_statement",
        90,
    ),
    HeadingRule(
        "cash_flow_statement",
        spaced(r"\b(bao cao luu chuyen tien te|luu chuyen tien te)\b"),
        0.95,
        "vi_cash_flow",
        90,
    ),
    HeadingRule(
        "notes", spaced(r"\bnotes to (?:the )?financial statements?\b"), 0.82, "en_notes", 50
    ),
    HeadingRule(
        "balance_sheet",
        spaced(r"\b(balance sheet|statement of financial position)\b"),
        0.85,
        "en_balance_sheet",
        40,
    ),
    HeadingRule(
        "income_statement",
        spaced(
            r"\b(income statement|statement of profit|statement of comprehensive income|p\s*&\s*l)\b"
        ),
        0.85,
        "en_income_statement",
        40,
    ),
    HeadingRule(
        "cash_flow_statement",
        spaced(r"\b(cash flow statements?|statement of cash flows?)\b"),
        0.85,
        "en_cash_flow",
        40,
    ),
    HeadingRule("notes", spaced(r"^thuyet minh$"), 0.75, "vi_notes_short_heading", 30),
)

# --- fixed values: metadata keys and the classes their values map to ------------------------------
METADATA_CLASS_KEYS = ("document_class", "classified_as", "doc_class")
METADATA_TYPE_KEYS = ("document_type", "doc_type", "type")
METADATA_CLASS_CONFIDENCE = 0.80
METADATA_TYPE_CONFIDENCE = 0.75
TYPE_TO_CLASS = {
    **{name: name for name in DOCUMENT_CLASSES},
    "periodic_report": "annual_report",
    "event_disclosure": "material_disclosure",
}

# --- fixed values: units, periods, header roles ---------------------------------------------------
UNIT_CAPTION = (
    r"(đơn\s*vị(?:\s*tính)?\s*[:\-–]?\s*[^\n]{0,80}"
    r"|đvt\s*[:\-–]?\s*[^\n]{0,80}"
    r"|unit(?:s)?\s*(?:of\s*measure)?\s*[:\-–]?\s*[^\n]{0,80}"
    r"|in\s+(?:thousands?|millions?|billions?)\s+of[^\n]{0,80})"
)
UNIT_SCALE = (
    r"((?:nghìn|nghin|triệu|trieu|tỷ|ty)\s*đồng"
    r"|(?:thousand|million|billion)s?\s*(?:vnd|dong)"
    r"|\bvnd\b)"
)
PERIOD_TOKENS = (
    r"^(19|20)\d{2}$",
    r"^\d{1,2}[/.\-]\d{1,2}[/.\-]\d{2,4}$",
    r"^\d{4}[/.\-]\d{1,2}[/.\-]\d{1,2}$",
    r"^(?:\d{1,2}\s+[A-Za-z]{3,9}\s+\d{4}|[A-Za-z]{3,9}\s+\d{1,2},?\s+\d{4})$",
    r"^(kỳ này|kỳ trước|năm nay|năm trước|số cuối kỳ|số đầu kỳ"
    r"|current(?: period)?|comparative|previous(?: period)?"
    r"|this period|year to date|quarter\s*(?:i{1,3}|iv|[1-4])|q[1-4]|quý\s*[1-4])$",
)
SEPARATOR_CELL = r"^[\s\-–—_=.*]+$"
HEADER_ROLES = (
    ("label", r"\b(chi tieu|items?|noi dung|description|label|assets|resources)\b"),
    ("index", r"\b(stt|so tt|no|number)\b"),
    ("code", r"\b(ma so|codes?)\b"),
    ("note", r"\b(thuyet minh|notes?)\b"),
)
REVIEW_WARNINGS = (
    "empty_raw_table", "unknown_table_type", "no_header_or_body", "empty_body",
    "conflicting_table_type", "ambiguous_section_context", "uncertain_header_row",
    "ambiguous_label_column", "header_band_incomplete", "oversized_header_band", "jagged_rows",
    "empty_grid",
)
REVIEW_PREFIXES = (
    "ocr_required_but_engine_not_configured", "ocr_needs_review", "ocr_failed",
    "raw_table_source_failed", "table_extraction_failed", "table_extraction_needs_review",
    "table_reconstruction_needs_review", "classification_unmatched", "xls_not_supported",
)

# --- fixed values: listing cards ------------------------------------------------------------------
TITLE_SPAN = (
    r"<span[^>]*>\s*(information\s+disclosures?\b[^<]*"
    r"|audited\s+(?:consolidated|separate)\s+financial\s+statements?\b[^<]*)</span>"
)
DOWNLOAD_LINK = r'href="(/api/download\?url=[^"]+)"'
UPDATED_DATE = r"updated[^0-9]*(\d{1,2}/\d{1,2}/\d{4})"

# --- fixed values: source tiers and corpus targets ------------------------------------------------
SOURCE_TIERS = {"HOSE": "A", "HNX": "A", "SSC": "A", "ISSUER_IR": "A"}
HTML_MARKERS = ("<!doctype html", "<html")
XLSX_MIME = "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet"
DOCX_MIME = "application/vnd.openxmlformats-officedocument.wordprocessingml.document"
