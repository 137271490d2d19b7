"""Whitening of embeddings by an incremental eigendecomposition."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import table, written
from quire.llm.registry import query
from quire.llm.spectra import Spectra

COMPONENTS = 32
#: Fixed values of the grid that entries are put on.
STEP, SHIFT = 64, 1_000_000
#: Rows that a partition takes in side by side, and states that one task combines.
LANES, FAN = 16, 8
STATE = "part long, state binary"


def finite(vector: Column) -> Column:
    """Not null, and without null or non-finite entries."""
    limit = float("inf")
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (x < limit) & (x > -limit)), F.lit(False))


def _grid(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """Entries as whole numbers; beyond 2^62 they are no longs, which is an error."""
    flat = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(float)
    scaled = np.floor(flat * STEP)
    if len(scaled) and np.abs(scaled).max() >= 2.0 ** 62:
        raise OverflowError("an entry is too large for the grid")
    return scaled.astype(np.int64).reshape(-1, width) + SHIFT


def _sums(width: int) -> Callable:
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * width
        for batch in batches:
            x = _grid(batch, width)
            # High and low halves, so that no sum of a batch passes 64 bits.
            high, low = (x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)
            total = [t + (int(h) << 32) + int(l) for t, h, l in zip(total, high, low)]
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(width), pa.int32()), pa.array([n] * width, pa.int64()),
                 pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], ["dim", "n", "s"])

    return sums


class Centre:
    """n and the sums of each dimension: n * x - S without rounding, and the rows about the mean."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.base = n, [s // n for s in sums]
        self.rest = [s - n * b for s, b in zip(sums, self.base)]

    def exact(self, x: np.ndarray) -> np.ndarray:
        off = x - np.array(self.base, np.int64)
        if len(off) and int(np.abs(off).max()) * self.n + self.n >= 1 << 62:
            off = off.astype(object)
        return off * self.n - np.array(self.rest, off.dtype)

    def rows(self, x: np.ndarray) -> np.ndarray:
        return (self.exact(x) / self.n).astype(float)

    def deviations(self, x: np.ndarray) -> list[Decimal]:
        off = self.exact(x)
        if off.dtype != object and len(off) and int(np.abs(off).max()) ** 2 * off.shape[1] >= 1 << 62:
            off = off.astype(object)
        return [Decimal(int(v)) for v in (off * off).sum(1)]


def _part_state(fold: Callable[[Iterator[np.ndarray]], bytes | None], width: int) -> Callable:
    """A state of each partition out of its rows on the grid."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = fold(x for x in (_grid(b, width) for b in batches) if len(x))
        if state is not None:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([state], pa.binary())], ["part", "state"])

    return run


def combined(states: DataFrame, merge: Callable[[bytes, bytes], bytes], name: str) -> bytes:
    """All states in one, in rounds of ``FAN`` to a task: neither a task nor the driver holds more than a few."""
    def group(found: pa.Table) -> pa.Table:
        rows = sorted(zip(found.column("part").to_pylist(), found.column("state").to_pylist()))
        state = rows[0][1]
        for _, other in rows[1:]:
            state = merge(state, other)
        return pa.table({"part": pa.array([rows[0][0] // FAN]), "state": pa.array([state], pa.binary())})

    states = written(states, name)
    while states.count() > 1:
        grouped = states.groupBy(F.expr(f"part div {FAN}").alias("to")).applyInArrow(group, STATE)
        states = written(grouped, name)
    return bytes(states.first()["state"])


def _spectrum(centre: Centre, width: int) -> Callable:
    def fold(blocks: Iterator[np.ndarray]) -> bytes | None:
        held = None
        for x in blocks:
            rows = centre.rows(x)
            if held is None:
                held = Spectra(int(np.clip(len(rows) // (4 * width), 1, LANES)), width)
            for start in range(0, len(rows), len(held.n)):
                held.add(rows[start:start + len(held.n)])
        return None if held is None else held.merged().to_bytes()

    return fold


def _moments(project: Callable[[np.ndarray], np.ndarray], size: int) -> Callable:
    """Count, mean and sum of products about the mean of the projected rows."""
    def fold(blocks: Iterator[np.ndarray]) -> bytes | None:
        state = None
        for x in blocks:
            y = project(x)
            mean = y.mean(0)
            one = np.concatenate([[len(y)], mean, ((y - mean).T @ (y - mean)).ravel()]).tobytes()
            state = one if state is None else _add_moments(size)(state, one)
        return state

    return fold


def _add_moments(size: int) -> Callable[[bytes, bytes], bytes]:
    def add(a: bytes, b: bytes) -> bytes:
        a, b = np.frombuffer(a), np.frombuffer(b)
        n, off = a[0] + b[0], b[1:1 + size] - a[1:1 + size]
        products = a[1 + size:] + b[1 + size:] + (np.outer(off, off) * (a[0] * b[0] / n)).ravel()
        return np.concatenate([[n], a[1:1 + size] + off * (b[0] / n), products]).tobytes()

    return add


def _covariance(state: bytes, size: int) -> np.ndarray:
    flat = np.frombuffer(state)
    return flat[1 + size:].reshape(size, size) / flat[0]


def _merge_spectra(width: int) -> Callable[[bytes, bytes], bytes]:
    def merge(a: bytes, b: bytes) -> bytes:
        held = Spectra.from_bytes(a, width)
        held.combine(Spectra.from_bytes(b, width))
        return held.to_bytes()

    return merge


def eigenbasis(rows: DataFrame, centre: Centre, width: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(eigenvalues, falling; eigenvectors as columns; trace) of the covariance of ``rows``.

    Each partition takes its rows in by centred rank-one changes of a spectrum; spectra are combined by the
    rank-one changes of their eigenvectors and of their means. The basis found is refined once by Rayleigh-Ritz:
    the covariance of all rows projected on it, a sum over partitions, is all but diagonal, and its
    eigenvectors turn the basis to full precision. A vector's largest coordinate is positive.
    """
    state = combined(rows.mapInArrow(_part_state(_spectrum(centre, width), width), STATE), _merge_spectra(width), "spectra")
    basis = np.linalg.qr(Spectra.from_bytes(state, width).vectors[0])[0]
    projected = rows.mapInArrow(_part_state(_moments(lambda x: centre.rows(x) @ basis, width), width), STATE)
    small = _covariance(combined(projected, _add_moments(width), "ritz"), width)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    vectors = (basis @ turn)[:, ::-1]
    top = np.abs(vectors).argmax(0)
    return values[::-1], vectors * np.sign(vectors[top, np.arange(width)]), float(np.trace(small))


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of ``vectors`` (vec_id, embedding).

    Rows whose vector is null or holds null or non-finite entries go; zero vectors stay, and so do repeated rows
    and rows without an id. Entries are put on a grid; n and the sums are whole numbers, so deviations (decimals) are
    exact and rows are centred before anything is multiplied. Vectors of another width are whitened by
    themselves; empty ones have no component. A component without variance has no whitened value (null) and
    no part in ``identity_error``; where there is no variance at all, ``explained`` is null too. Equal
    eigenvalues leave the choice of their vectors open. Other columns are not looked at.

    A spectrum is width^2 numbers and a row costs a change of width^3 steps; nothing else grows but the table.
    """
    good = vectors.select("vec_id", "embedding").where(finite(F.col("embedding")))
    widths = [r["width"] for r in good.groupBy(F.size("embedding").alias("width")).count().collect()]
    found = [_whitened(good, w, components) for w in sorted(widths) if w > 0]
    if not found:
        return vectors.sparkSession.createDataFrame([], _schema(vectors))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _schema(vectors: DataFrame) -> str:
    return (f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation decimal(38,0), "
            "whitened double, explained double, identity_error double")


def _whitened(good: DataFrame, width: int, components: int) -> DataFrame:
    rows = good.where(F.size("embedding") == width).select("embedding")
    sums = rows.mapInArrow(_sums(width), "dim int, n long, s decimal(38,0)").groupBy("dim").agg(
        F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s")).orderBy("dim").collect()
    n = sums[0]["n"]
    centre = Centre(n, [int(r["s"]) for r in sums])
    values, basis, trace = eigenbasis(rows, centre, width)
    kept = min(components, width)
    values, basis = values[:kept], basis[:, :kept]
    varied = values > width * np.finfo(float).eps * max(values[0], 0)
    scale = np.where(varied, 1 / np.sqrt(np.where(varied, values, 1)), np.nan)
    explained = [float(max(v, 0) / trace) if trace > 0 else None for v in values]
    parts = int(varied.sum())
    error = None
    if parts:
        project = lambda x: (centre.rows(x) @ basis * scale)[:, varied]
        check = combined(rows.mapInArrow(_part_state(_moments(project, parts), width), STATE), _add_moments(parts), "identity")
        error = float(np.abs(_covariance(check, parts) - np.eye(parts)).max())

    def project_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _grid(batch, width)
            y = (centre.rows(x) @ basis * scale).ravel()
            y = pa.array(y, mask=np.isnan(y))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(y) + 1, kept), pa.int32()), y)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(centre.deviations(x), pa.decimal128(38, 0)), lists],
                ["vec_id", "deviation", "y"])

    kind = good.schema["vec_id"].dataType.simpleString()
    out = good.where(F.size("embedding") == width).mapInArrow(
        project_rows, f"vec_id {kind}, deviation decimal(38,0), y array<double>")
    share = F.array(*[F.lit(v).cast("double") for v in explained])
    return out.select("vec_id", "deviation", F.posexplode("y").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    found = whiten(table(spark, folder, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").cast("long"))
