"""Sheet cells produced upstream: one row per cell, coordinates and visibility kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SHEET_CELL_SCHEMA = (
    "document_id bigint, sheet_index int, sheet_name string, visibility string, row int, "
    "column int, address string, value_kind string, value_text string, number_format string, "
    "formula_text string, is_merged boolean, merge_range string"
)


def read_sheet_cells(spark: SparkSession, path: str) -> DataFrame:
    """Parquet cells with a fixed schema; hidden sheets are read like visible ones."""
    return spark.read.schema(SHEET_CELL_SCHEMA).parquet(path)
