"""Disclosure feeds as a Spark data source: batch and stream reads of a registered connector."""

from __future__ import annotations

import importlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as D
from pyspark.sql import functions as F

from quire.sources.catalog import CATALOG_SCHEMA, with_defaults
from quire.sources.files import _opened

FORMAT = "quire_disclosures"
BATCH_ROWS = 1000


class Connector(Protocol):
    """A feed of publications. It is made from the reader's options, and must pickle."""

    #: Name of the feed; the ``source`` of its publications.
    source: str

    def units(self) -> list[tuple[str, str]]:
        """(position, unit): pieces of work that are read independently. Positions rise as units are added."""

    def read(self, unit: str) -> Iterator[dict]:
        """Publications of a unit, as objects of a catalog."""


class CatalogFolder:
    """Catalog files in a folder, a unit each: an array of objects, or one object. Positions are file times and names."""

    source = "FIXTURE"

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]

    def units(self) -> list[tuple[str, str]]:
        from pyarrow import fs as pafs

        store, inner, _ = _opened(self.path)
        found = store.get_file_info(pafs.FileSelector(inner, recursive=True))
        files = [f for f in found if f.is_file and not f.base_name.startswith(("_", "."))]
        return sorted((f"{f.mtime_ns:020d} {f.path}", f.path) for f in files)

    def read(self, unit: str) -> Iterator[dict]:
        store, _, _ = _opened(self.path)
        with store.open_input_stream(unit) as stream:
            held = json.loads(stream.read())
        yield from held if isinstance(held, list) else [held]


def connector(options: dict[str, str]) -> Connector:
    """The connector that ``connector`` names as ``module:Class``."""
    module, _, name = options.get("connector", f"{__name__}:CatalogFolder").partition(":")
    return getattr(importlib.import_module(module), name)(options)


@dataclass
class Units(D.InputPartition):
    units: list[str]


class _Reads:
    """Publications of units that pass the conditions of the read."""

    def __init__(self, options: dict[str, str]):
        self.options = options
        self.ticker, self.document = options.get("ticker", "").upper(), options.get("document")
        self.first, self.last = options.get("from"), options.get("to")

    def wanted(self, row: dict) -> bool:
        day = (row.get("published_at") or "")[:10]
        return ((not self.ticker or (row.get("ticker") or "").upper() == self.ticker)
                and (self.document is None or row.get("source_document_id") == self.document)
                and (self.first is None or day >= self.first) and (self.last is None or (day != "" and day <= self.last)))

    def read(self, partition: Units) -> Iterator[pa.RecordBatch]:
        feed, rows = connector(self.options), []
        for unit in partition.units:
            for row in feed.read(unit):
                if self.wanted(row):
                    rows.append(json.dumps(row, ensure_ascii=False))
                    if len(rows) == BATCH_ROWS:
                        yield pa.RecordBatch.from_pydict({"publication": rows})
                        rows = []
        if rows:
            yield pa.RecordBatch.from_pydict({"publication": rows})


class BatchReader(_Reads, D.DataSourceReader):
    def partitions(self) -> list[Units]:
        return [Units([unit]) for _, unit in connector(self.options).units()] or [Units([])]


class StreamReader(_Reads, D.DataSourceStreamReader):
    """Units past the last offset. An offset is the position of the last unit read."""

    def initialOffset(self) -> dict:
        return {"at": ""}

    def latestOffset(self) -> dict:
        return {"at": max((at for at, _ in connector(self.options).units()), default="")}

    def partitions(self, start: dict, end: dict) -> list[Units]:
        return [Units([unit]) for at, unit in connector(self.options).units() if start["at"] < at <= end["at"]]


class Disclosures(D.DataSource):
    """``format("quire_disclosures")``, read or streamed. Options: ``connector`` (``module:Class``; a folder of catalog files
    if absent), those of the connector, and the conditions ``ticker``, ``from``, ``to`` (days) and ``document``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "publication string"

    def _options(self) -> dict[str, str]:
        return {name.lower(): value for name, value in dict(self.options).items()}

    def reader(self, schema) -> BatchReader:
        return BatchReader(self._options())

    def streamReader(self, schema) -> StreamReader:
        return StreamReader(self._options())


def _typed(raw: DataFrame, options: dict[str, str]) -> DataFrame:
    items = raw.select(F.from_json("publication", CATALOG_SCHEMA).alias("p")).select("p.*")
    return with_defaults(items, connector({k.lower(): v for k, v in options.items()}).source)


def read_feed(spark: SparkSession, **options: str) -> DataFrame:
    """Publications of a connector: `discover` with ``ticker``, ``from`` and ``to``; one of them with ``document``."""
    spark.dataSource.register(Disclosures)
    return _typed(spark.read.format(FORMAT).options(**options).load(), options)


def stream_feed(spark: SparkSession, **options: str) -> DataFrame:
    """The same as a stream of the units that are added."""
    spark.dataSource.register(Disclosures)
    return _typed(spark.readStream.format(FORMAT).options(**options).load(), options)
