"""Raw files: bytes, digest, detected type, and what must not pass."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quire import values as V
from quire.sources.files import list_files

_HEAD_BYTES = 256


def binary_facts(files: DataFrame, content: str = "content") -> DataFrame:
    """Size and SHA-256 of every file's bytes."""
    return files.withColumns({
        "size_bytes": F.octet_length(content).cast("bigint"), "sha256": F.sha2(F.col(content), 256),
    })


def read_binary_corpus(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Files under a path with bytes, size and digest. Files without content have empty bytes.

    Spark's reader passes over files of zero bytes; a listing by tasks adds them (`list_files`).
    """
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True).load(path)
    ).select("path", "modificationTime", "content")
    empty = list_files(spark, path, glob).where("size_bytes = 0").select(
        "path", F.col("modified").alias("modificationTime"), F.lit(b"").alias("content"))
    return binary_facts(files.unionByName(empty))


def _office_kind(contents: pd.Series) -> pd.Series:
    """XLSX or DOCX by the folders that an archive's directory lists; none if it has both or neither."""

    def kind(data: bytes | None) -> str | None:
        if data is None:
            return None
        try:
            with zipfile.ZipFile(io.BytesIO(data)) as archive:
                names = archive.namelist()
        except (zipfile.BadZipFile, OSError, ValueError, NotImplementedError):
            return None
        sheet = any(name.startswith("xl/") for name in names)
        text = any(name.startswith("word/") for name in names)
        return "XLSX" if sheet and not text else "DOCX" if text and not sheet else None

    return contents.map(kind)


office_kind = F.pandas_udf(_office_kind, StringType())


def _head(content: Column, size: int = _HEAD_BYTES) -> Column:
    """First bytes as one character each."""
    return F.decode(F.substring(content, 1, size), "ISO-8859-1")


def has_html_marker(content: Column) -> Column:
    head = F.lower(_head(content))
    found = F.lit(False)
    for marker in V.HTML_MARKERS:
        found = found | head.contains(marker)
    return found


def _starts(content: Column, magic: bytes) -> Column:
    return F.substring(content, 1, len(magic)) == F.lit(bytearray(magic))


#: The mark of an old office file, and the first record of one that holds a workbook.
_OLE = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1"
_WORKBOOK_RECORD = b"\x09\x08\x10\x00\x00\x06\x05\x00"
_SECTOR_MARK, _SECTOR_KINDS = b"\xfd\xff\xff\xff", (b"\x00", b"\x02")


def _holds_old_sheet(content: Column) -> Column:
    """An old office file whose first sector says that it holds a workbook."""
    at = lambda start, size: F.substring(content, start + 1, size)
    kind = F.lit(False)
    for value in _SECTOR_KINDS:
        kind = kind | (at(518, 1) == F.lit(bytearray(value)))
    first = (at(512, 8) == F.lit(bytearray(_WORKBOOK_RECORD))) | (
        (at(512, 4) == F.lit(bytearray(_SECTOR_MARK))) & kind)
    return _starts(content, _OLE) & (F.octet_length(content) > 520) & first


def detect_file_type(files: DataFrame, content: str = "content") -> DataFrame:
    """``file_type`` and ``mime_type`` from the bytes alone; the name never decides.

    Office formats are told apart by the member names in the archive's directory, never by a search of its
    contents. Only rows that start like an archive are handed to the function that walks the directory.
    """
    data = F.col(content)
    empty = data.isNull() | (F.octet_length(data) == 0)
    office = office_kind(F.when(_starts(data, b"PK"), data))
    files = files.withColumn("_office", office)
    kinds = (
        (empty, "unknown", None),
        (has_html_marker(data), "unknown", "text/html"),
        (_starts(data, b"%PDF"), "PDF", "application/pdf"),
        (F.col("_office") == "XLSX", "XLSX", V.XLSX_MIME),
        (F.col("_office") == "DOCX", "DOCX", V.DOCX_MIME),
        (_holds_old_sheet(data), "XLS", "application/vnd.ms-excel"),
        (_starts(data, _OLE), "unknown", "application/x-ole-storage"),
    )
    result = None
    for test, kind, mime in kinds:
        value = F.struct(F.lit(kind).alias("file_type"), F.lit(mime).cast("string").alias("mime_type"))
        result = F.when(test, value) if result is None else result.when(test, value)
    result = result.otherwise(F.struct(
        F.lit("unknown").alias("file_type"), F.lit(None).cast("string").alias("mime_type")))
    return files.withColumn("detected", result).select("*", "detected.*").drop("detected", "_office")


def resolve_mime(detected: Column, reported: Column, content: Column) -> Column:
    """Detected type, else the reported one, else what the first bytes say, else plain bytes."""
    return F.coalesce(
        detected, F.nullif(reported, F.lit("")),
        F.when(_starts(content, b"%PDF"), "application/pdf"), F.lit("application/octet-stream"),
    )


def quarantine_disguised_html(files: DataFrame, content: str = "content") -> tuple[DataFrame, DataFrame]:
    """Good files, and HTML pages that pass themselves off as PDF with the reason."""
    as_pdf = F.lower("filename").endswith(".pdf") | (F.col("mime_type") == "application/pdf")
    html = has_html_marker(F.col(content)) | F.col("mime_type").startswith("text/html")
    rejected = F.coalesce(as_pdf & html, F.lit(False))
    reason = F.lit("Rejected HTML content masquerading as PDF")
    return files.where(~rejected), files.where(rejected).withColumn("reason", reason)


def oversize_filter(files: DataFrame, max_bytes: int = V.MAX_FILE_BYTES) -> tuple[DataFrame, DataFrame]:
    """Files within the size limit, and those beyond it with the reason."""
    small = F.col("size_bytes") <= max_bytes
    return files.where(small), files.where(~small).withColumn(
        "reason", F.lit(f"File exceeds max size {max_bytes}")
    )
