"""Whitening of embeddings by shifted CholeskyQR: Gram passes, triangular solves, SVD of the composed R.

Entries become integers, ``x = floor(1024 * c) + 100000``, so that n and the sums S of the dimensions are
exact; a centred entry is the exact integer ``n * x - S`` divided by n, never a difference of rounded
means.  With Y the centred rows, each pass sums a Gram matrix over all partitions, factors it on the
driver and goes on with rows multiplied by the inverse factor:

    G1 = Y'Y,    R1'R1 = G1 + s I     (the shift s makes the factor exist for any condition number)
    Q1 = Y / R1, G2 = Q1'Q1 = R2'R2, Q2 = Q1 / R2, ... until G is the identity

Rows are never orthogonalised in place: a pass reads the table and solves for the factors so far, so
nothing but d x d matrices is kept between passes and lost tasks are run again.  ``R = ... R2 R1``
satisfies R'R = Y'Y without the squared condition number of a single Gram matrix.  The SVD of R gives
the components (right singular vectors) and eigenvalues sigma^2 / n of the covariance.

Partial Gram matrices are summed per task, by entry in Spark, and d (d + 1) / 2 numbers reach the driver;
``most_dimensions`` bounds them.

Defined cases: rows whose vector is null, empty, or has null or non-finite entries are left out; no
rows left give an empty result; other vectors must have one length (else ValueError) and entries up to
2^40 (else ValueError); a component without variance, up to rounding, is kept with ``explained`` as it is and a null
``whitened``; ``deviation`` is null where it passes 64 bits; rows with equal vectors have equal
results, also under equal or null keys; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET = 1024.0, 100_000
LARGEST = 2.0**40
PASSES = 8
ROUNDING = np.finfo(np.float64).eps / 2
# Below this part of the largest standard deviation a component is rounding, not variance.
NO_VARIANCE = 1e-11


@dataclass
class Whitening:
    """Exact n and S, and the components (columns) with their eigenvalues, largest first."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    total: float  # the trace of the covariance
    passes: int  # Gram passes that were needed

    def project(self, x: np.ndarray, k: int) -> np.ndarray:
        """Whitened coordinates of integer rows; nan for components without variance."""
        scale = np.sqrt(self.eigenvalues[:k])
        none = scale <= NO_VARIANCE * np.sqrt(self.total)
        return np.where(none, np.nan, centred(x, self.n, self.sums) @ self.components[:, :k] / np.where(none, 1.0, scale))


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n, rounded once: S = q n + r, so the integer x - q is exact and only r / n is not."""
    whole, rest = np.divmod(sums, n)
    return (x - whole).astype(np.float64) - rest / n


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Key and vector (array of double) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    # Not below infinity: null, nan (larger than all) and the infinities.
    fine = F.forall(v, lambda c: F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False)))
    return vectors.filter(F.col(vector).isNotNull() & (F.size(vector) > 0) & fine).select(
        F.col(key).alias("vec_id"), v.alias("vector")
    )


def _integers(batch: pa.RecordBatch) -> np.ndarray:
    """The integer entries of a batch, one row per vector."""
    column = batch.column("vector")
    sizes = np.unique(pc.list_value_length(column).to_numpy(zero_copy_only=False))
    if len(sizes) > 1:
        raise ValueError(f"vectors of {int(sizes[0])} and of {int(sizes[-1])} entries")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) and np.abs(flat).max() > LARGEST:
        raise ValueError("an entry passes 2^40")
    return np.floor(flat * SCALE).astype(np.int64).reshape(len(column), -1) + OFFSET


def _summed(rows: DataFrame, partial: Callable[[np.ndarray], np.ndarray], value: str) -> np.ndarray:
    """The sum over all rows of ``partial``: per task, then by entry over the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = partial(_integers(batch))
                if total is not None and len(total) != len(found):
                    raise ValueError("vectors of different lengths")
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["place", "value"])

    parts = rows.mapInArrow(run, f"place long, value {value}")
    found = parts.groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    order = np.argsort(found.column("place").to_numpy())
    return found.column("value").to_numpy()[order]


def _triangle(gram: np.ndarray) -> np.ndarray:
    return gram[np.triu_indices(len(gram))]


def _square(triangle: np.ndarray, d: int) -> np.ndarray:
    whole = np.zeros((d, d))
    whole[np.triu_indices(d)] = triangle
    return np.triu(whole) + np.triu(whole, 1).T


def solve_upper(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """rows / upper for an upper triangular matrix, by forward substitution over its columns."""
    out = np.empty_like(rows)
    for j in range(len(upper)):
        out[:, j] = (rows[:, j] - out[:, :j] @ upper[:j, j]) / upper[j, j]
    return out


def factor(gram: np.ndarray, n: int, first: bool) -> tuple[np.ndarray, bool]:
    """The upper Cholesky factor, shifted in the first pass and where it would not exist otherwise."""
    d = len(gram)
    norm = float(np.trace(gram))
    shift = 11 * (n * d + d * (d + 1)) * ROUNDING * norm if first else 0.0
    shift = min(shift, 1e-4 * norm)
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(d)).T, shift > 0
        except np.linalg.LinAlgError:
            shift = max(10 * shift, 4 * d * ROUNDING * norm)


def fit(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", most_dimensions: int = 2048) -> Whitening | None:
    """Components and eigenvalues of the usable vectors; None when there is none."""
    rows = usable(vectors, key, vector)
    counted = rows.agg(F.count("*").alias("n"), F.min(F.size("vector")).alias("least"), F.max(F.size("vector")).alias("d"))
    n, least, d = counted.first()
    if not n:
        return None
    if least != d or d > most_dimensions:
        raise ValueError(f"vectors of {least} to {d} entries; one length up to {most_dimensions} is expected")
    # Sums stay exact: the high and low halves of the entries are added apart, as Python integers in the end.
    low = (1 << 20) - 1
    halves = _summed(rows, lambda x: np.concatenate([(x >> 20).sum(axis=0), (x & low).sum(axis=0)]), "long")
    exact = [(int(h) << 20) + int(w) for h, w in zip(halves[:d], halves[d:])]
    if max(map(abs, exact)) >> 63:
        raise ValueError("the sum of a dimension passes 64 bits")
    sums = np.array(exact, np.int64)

    factors: list[np.ndarray] = []
    composed, total = np.eye(d), 0.0

    def gram(x: np.ndarray) -> np.ndarray:
        q = centred(x, n, sums)
        for upper in factors:
            q = solve_upper(q, upper)
        return _triangle(q.T @ q)

    for number in range(PASSES):
        found = _square(_summed(rows, gram, "double"), d)
        if number == 0:
            total = float(np.trace(found)) / n
            if total == 0:
                return Whitening(n, sums, np.eye(d), np.zeros(d), 0.0, 1)
        upper, shifted = factor(found, n, number == 0)
        factors.append(upper)
        composed = upper @ composed
        if not shifted and np.abs(found - np.eye(d)).max() < 1e-8:
            break  # this factor is a last correction; what is left is its square
    _, sigma, right = np.linalg.svd(composed)
    turned = right * np.where(right[np.arange(d), np.abs(right).argmax(axis=1)] < 0, -1.0, 1.0)[:, None]
    return Whitening(n, sums, turned.T, sigma**2 / n, total, len(factors))


def identity_error(vectors: DataFrame, found: Whitening, k: int, key: str = "vec_id", vector: str = "embedding") -> float:
    """The largest absolute entry of the covariance of the whitened rows minus the identity."""

    def moments(x: np.ndarray) -> np.ndarray:
        w = found.project(x, k)
        w = w[:, ~np.isnan(w[0])]
        return np.concatenate([w.sum(axis=0), _triangle(w.T @ w)])

    k = min(k, int((found.eigenvalues > NO_VARIANCE**2 * found.total).sum()))
    if k == 0:
        return 0.0
    sums = _summed(usable(vectors, key, vector), moments, "double") / found.n
    covariance = _square(sums[k:], k) - np.outer(sums[:k], sums[:k])
    return float(np.abs(covariance - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """The exact sum over dimensions of (n x - S)^2, None where it passes 64 bits."""
    whole, rest = np.divmod(sums, n)
    apart = x - whole
    if float(np.abs(apart).max(initial=0) + 1) * n < 2.0**62:
        scaled = apart * n - rest
        if float(np.abs(scaled).max(initial=0)) ** 2 * x.shape[1] < 2.0**62:
            return (scaled * scaled).sum(axis=1).tolist()
    scaled = apart.astype(object) * n - rest.astype(object)
    return [s if s < 1 << 63 else None for s in (scaled * scaled).sum(axis=1)]


def whiten(vectors: DataFrame, found: Whitening | None, k: int = 8, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per usable vector and component: component, n, deviation, whitened, explained, identity_error."""
    rows = usable(vectors, key, vector)
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if found is None:
        return rows.filter("false").select(
            "vec_id", *[F.lit(None).cast(t).alias(c) for c, t in (f.split() for f in schema.split(", ")[1:])]
        )
    k = min(k, len(found.sums))
    explained = found.eigenvalues[:k] / found.total if found.total else np.zeros(k)
    error = identity_error(vectors, found, k, key, vector)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 4096):
                batch = whole.slice(start, 4096)
                x, size = _integers(batch), batch.num_rows
                values = found.project(x, k).ravel()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(np.repeat(np.arange(size), k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)),
                        pa.array(np.full(size * k, found.n, np.int64)),
                        pa.array([s for s in deviations(x, found.n, found.sums) for _ in range(k)], pa.int64()),
                        pa.array(values, mask=np.isnan(values)),
                        pa.array(np.tile(explained, size)),
                        pa.array(np.full(size * k, error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(run, schema)
