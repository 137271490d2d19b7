"""State tables in buckets of their keys: a log of deltas over a base.

A version holds the new rows of the keys it names, which replace all earlier rows of these keys; a key without
new rows is gone. Files lie at ``<root>/<piece>/g=<bucket>``, and ``<root>/_log/<version>.json`` names the buckets that a
version wrote. The log entry comes last and makes the version, so a failed write changes nothing, and a version that is
there is not written again. Batches write what they change and read the buckets that they touch; `compact` folds deltas
into the base of the buckets that have some, and removes what no kept version reads.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

BUCKETS = 64
_GONE = "_gone"


@contextmanager
def settings(spark: SparkSession, values: dict[str, object]) -> Iterator[None]:
    """The session with other settings while a write is planned and run. They change no result."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@dataclass(frozen=True)
class Piece:
    """Rows of one bucket that one version wrote: a delta, or all that the bucket held then."""

    version: int
    bucket: int
    folder: str
    whole: bool


class KeyedState:
    """Rows by key under ``root``; a key may have several rows, and no null part. ``schema`` are the rows' columns.

    A root keeps the bucket count that it was first written with. One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType | str, keys: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), list(keys), buckets
        self.schema = spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema
        self.schema = StructType([StructField(f.name, f.dataType) for f in self.schema])

    # --- the log ---------------------------------------------------------------------------------------------

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _store(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _entries(self) -> list[dict]:
        """Log entries, a base after the delta of its version. There are as many as versions kept, whatever the data."""
        fs, log = self._store(), self._path("_log")
        if not fs.exists(log):
            return []
        entries = []
        for status in fs.listStatus(log):
            if status.getPath().getName().endswith(".json"):
                stream = fs.open(status.getPath())
                try:
                    entries.append(json.loads(bytes(stream.readAllBytes()).decode()))
                finally:
                    stream.close()
        return sorted(entries, key=lambda e: (e["version"], "pieces" in e))

    def _record(self, name: str, entry: dict) -> None:
        fs, target = self._store(), self._path(f"_log/{name}.json")
        draft = self._path(f"_log/.{name}-{uuid.uuid4().hex}")
        stream = fs.create(draft, True)
        stream.write(json.dumps(entry).encode())
        stream.close()
        if not fs.rename(draft, target):
            fs.delete(draft, False)
            raise RuntimeError(f"{target} is there already")

    def versions(self) -> list[int]:
        """Versions that can be read."""
        return sorted({e["version"] for e in self._entries()})

    def pieces(self, before: int | None = None) -> list[Piece]:
        """What makes up the state of all versions, or of those older than ``before``."""
        live: dict[int, list[Piece]] = {}
        entries = self._entries()
        if before is not None and entries and "pieces" in entries[0] and before <= entries[0]["version"]:
            raise ValueError(f"the state before version {before} was removed")
        for entry in entries:
            if before is not None and entry["version"] >= before:
                continue
            if "pieces" in entry:
                live = {}
                for version, bucket, folder, whole in entry["pieces"]:
                    live.setdefault(bucket, []).append(Piece(version, bucket, folder, whole))
            else:
                for bucket in entry["buckets"]:
                    live.setdefault(bucket, []).append(Piece(entry["version"], bucket, entry["folder"], False))
        return [p for bucket in sorted(live) for p in live[bucket]]

    # --- reading ---------------------------------------------------------------------------------------------

    def bucket(self) -> Column:
        """A row's bucket; it is also the one that Spark gives a row in a table clustered by the keys."""
        return F.pmod(F.hash(*self.keys), F.lit(self.buckets))

    def _table(self, pieces: list[Piece]) -> DataFrame:
        """The pieces' rows with ``_v`` and ``g``, as a table that joins on the keys without a shuffle."""
        if not pieces:
            empty = StructType([*self.schema.fields, StructField(_GONE, BooleanType())])
            return self.spark.createDataFrame([], empty).withColumns({"_v": F.lit(0).cast("long"), "g": F.lit(0)})
        parts = " ".join(f"PARTITION (_v={p.version}, g={p.bucket}) LOCATION '{self.root}/{p.folder}/g={p.bucket}'" for p in pieces)
        name = f"quire_state_{hashlib.md5((self.root + parts).encode()).hexdigest()}"
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
            keys = ", ".join(f"`{k}`" for k in self.keys)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}, {_GONE} boolean, _v long, g int) USING parquet PARTITIONED BY (_v, g) "
                f"CLUSTERED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{self.root}/_none'")
            self.spark.sql(f"ALTER TABLE {name} ADD {parts}")
        return self.spark.table(name)

    def _current(self, pieces: list[Piece], wanted: DataFrame | None = None) -> DataFrame:
        """Rows of the newest version of each key; of the ``wanted`` keys only, if given."""
        deltas = {p.bucket for p in pieces if not p.whole}
        parts = [[p for p in pieces if p.bucket not in deltas], [p for p in pieces if p.bucket in deltas]]
        found = []
        for part in [p for p in parts if p] or [[]]:
            rows = self._table(part)
            if wanted is not None:
                rows = rows.join(wanted, self.keys, "left_semi")
            if part and part[0].bucket in deltas:
                # The rows of a key lie in one bucket, so this needs no shuffle.
                newest = F.max("_v").over(Window.partitionBy(*self.keys))
                rows = rows.withColumn("_newest", newest).where(f"_v = _newest AND NOT {_GONE}")
            found.append(rows.select(*[f"`{f.name}`" for f in self.schema]))
        return reduce(DataFrame.unionByName, found)

    def read(self, before: int | None = None) -> DataFrame:
        """All rows, of the newest version or of the newest one older than ``before``."""
        return self._current(self.pieces(before))

    def lookup(self, wanted: DataFrame, before: int | None = None) -> DataFrame:
        """Rows whose key is among those of ``wanted``. Buckets without such a key are not read; the state is not shuffled."""
        pieces = self.pieces(before)
        if not pieces:
            return self._current([])
        wanted = wanted.select(*self.keys)
        # As many numbers as buckets at most; the keys themselves aren't shuffled for them.
        touched = {r["g"] for r in wanted.select(self.bucket().alias("g")).distinct().collect()}
        return self._current([p for p in pieces if p.bucket in touched], wanted.distinct())

    # --- writing ---------------------------------------------------------------------------------------------

    def committed(self, version: int) -> bool:
        return any(e["version"] >= version for e in self._entries())

    def dealing(self):
        """Settings under which what is grouped by the keys is dealt into this table's buckets by that very shuffle."""
        return settings(self.spark, {"spark.sql.shuffle.partitions": self.buckets,
                                     "spark.sql.adaptive.coalescePartitions.initialPartitionNum": self.buckets})

    def _put(self, rows: DataFrame, folder: str, dealt: bool = False) -> list[int]:
        """Write ``rows`` by bucket; the buckets that got some. Rows that come ``dealt`` by bucket are not shuffled.

        A task has the rows of few buckets and keeps their files open, so rows are not sorted by bucket first.
        """
        fs, path = self._store(), self._path(folder)
        fs.delete(path, True)  # what a failed write of this version left
        name = f"quire_put_{uuid.uuid4().hex}"
        columns = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema]
        try:
            rows = rows.select(*columns, F.col(_GONE)).withColumn("g", self.bucket())
            rows = rows if dealt else rows.repartition(self.buckets, *self.keys)
            with settings(self.spark, {"spark.sql.maxConcurrentOutputFileWriters": 4}):
                (rows.write.partitionBy("g").bucketBy(self.buckets, *self.keys).option("path", f"{self.root}/{folder}")
                 .option("compression", "zstd").saveAsTable(name))
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        if not fs.exists(path):
            return []
        found = (s.getPath().getName() for s in fs.listStatus(path))
        return sorted(int(name[2:]) for name in found if name.startswith("g="))

    def write(self, rows: DataFrame, version: int, keys: DataFrame | None = None, dealt: bool = False) -> bool:
        """Replace all rows of the keys in ``rows`` by those in ``rows``; False if the version is there already.

        ``keys`` names keys that are replaced too and may have no new rows: these are gone. Rows come ``dealt`` if they
        were grouped by the keys under `dealing`; others are dealt here.
        """
        if self.committed(version):
            return False
        rows = rows.select(*[f"`{f.name}`" for f in self.schema]).withColumn(_GONE, F.lit(False))
        if keys is not None:
            gone = keys.select(*self.keys).distinct().join(rows.select(*self.keys), self.keys, "left_anti")
            rest = {f.name: F.lit(None).cast(f.dataType) for f in self.schema if f.name not in self.keys}
            rows = rows.unionByName(gone.withColumns({**rest, _GONE: F.lit(True)}))
        folder = f"v={version}"
        buckets = self._put(rows, folder, dealt)
        self._record(f"{version:012d}", {"version": version, "folder": folder, "buckets": buckets})
        return True

    def compact(self, least: int = 8, keep: int = 1) -> bool:
        """Fold the deltas of buckets that have ``least`` or more into a new base; other buckets keep their files.

        State as of the ``keep`` newest versions before stays readable; older files and log entries go.
        """
        pieces, versions = self.pieces(), self.versions()
        count: dict[int, int] = {}
        for p in pieces:
            count[p.bucket] = count.get(p.bucket, 0) + (not p.whole)
        full = {b for b, n in count.items() if n >= least}
        if not full:
            return False
        version = versions[-1]
        folder = f"base={version}-{uuid.uuid4().hex[:8]}"
        folded = self._current([p for p in pieces if p.bucket in full])
        written = self._put(folded.withColumn(_GONE, F.lit(False)), folder, dealt=True)
        kept = [[p.version, p.bucket, p.folder, p.whole] for p in pieces if p.bucket not in full]
        self._record(f"{version:012d}.base", {"version": version, "pieces": kept + [[version, b, folder, True] for b in written]})
        self._clean(keep)
        return True

    def _clean(self, keep: int) -> None:
        """Remove pieces and log entries that no kept version needs."""
        fs, entries = self._store(), self._entries()
        versions = sorted({e["version"] for e in entries})
        oldest = versions[max(0, len(versions) - 1 - keep)]
        # A base entry says all, so those before the last one at or before the oldest kept version say nothing more.
        bases = [e for e in entries if "pieces" in e and e["version"] <= oldest]
        live = set()
        for version in versions:
            if version >= oldest:
                live |= {(p.folder, p.bucket) for p in self.pieces(version + 1)}
                if version > oldest:
                    live |= {(p.folder, p.bucket) for p in self.pieces(version)}
        for status in fs.listStatus(self._path("")):
            folder = status.getPath().getName()
            if folder.startswith(("v=", "base=")):
                for part in fs.listStatus(status.getPath()):
                    name = part.getPath().getName()
                    if name.startswith("g=") and (folder, int(name[2:])) not in live:
                        fs.delete(part.getPath(), True)
        if bases:
            for e in entries:
                if (e["version"], "pieces" in e) < (bases[-1]["version"], True):
                    name = f"{e['version']:012d}" + (".base" if "pieces" in e else "")
                    fs.delete(self._path(f"_log/{name}.json"), False)
