"""Embedding whitening: exact covariance in the cluster, its components by QDWH spectral divide-and-conquer."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.llm.common import free_name

SCALE, OFFSET = 64.0, 1_000_000
COMPONENTS = 32
EPS = np.finfo(float).eps
EXACT = 1 << 53


def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal factor of a symmetric matrix by dynamically weighted Halley steps (QDWH): eigenvalues go to their signs.

    The weights follow a lower bound of the singular values, so a handful of steps does; while it is small a step goes
    through a QR factorisation of the stacked matrix, which keeps it backward stable, later through a Cholesky one."""
    size = len(a)
    x = a / np.linalg.norm(a)
    low, eye = EPS, np.eye(size)
    for _ in range(40):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square))
        root = np.sqrt(1 + d)
        wa = root + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * root))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
            new = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:size] @ q[size:].T)
        else:
            factor = np.linalg.cholesky(eye + wc * (x.T @ x))
            half = np.linalg.solve(factor, x.T)
            new = (wb / wc) * x + (wa - wb / wc) * np.linalg.solve(factor.T, half).T
        new = (new + new.T) / 2
        low = min(1.0, low * (wa + wb * square) / (1 + wc * square))
        moved, x = np.linalg.norm(new - x), new
        if moved <= 10 * EPS * np.sqrt(size) or (1 - low < EPS and moved < np.cbrt(EPS)):
            break
    return x


def halves(a: np.ndarray, scale: float) -> tuple[np.ndarray, int] | None:
    """An orthogonal basis whose first columns span the subspace of the eigenvalues above a shift, and their number.

    (I + polar factor of a - shift) / 2 is the spectral projector. The median of the diagonal splits evenly as a rule; the mean
    of the eigenvalues always has some on each side. None: no shift splits, the eigenvalues are one to double precision."""
    size = len(a)
    mean = np.trace(a) / size
    spread = np.linalg.norm(a - mean * np.eye(size))
    if spread <= 4 * EPS * scale * np.sqrt(size):
        return None
    start = np.random.default_rng(size).standard_normal((size, size))
    for shift in (float(np.median(np.diag(a))), mean, mean + 1e-3 * spread, mean - 1e-3 * spread, mean + 1e-2 * spread, mean - 1e-2 * spread):
        moved = a - shift * np.eye(size)
        if np.linalg.norm(moved) <= EPS * scale:
            continue
        projector = (np.eye(size) + polar(moved)) / 2
        k = round(float(np.trace(projector)))
        if not 0 < k < size:
            continue
        basis, _ = np.linalg.qr(projector @ start[:, :k])
        basis, _ = np.linalg.qr(projector @ basis, mode="complete")
        if np.linalg.norm(basis[:, k:].T @ a @ basis[:, :k]) <= 100 * EPS * scale * size:
            return basis, k
    return None


def components(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns of a symmetric matrix. Invariant subspaces are split in two until
    each holds one direction, or directions of one eigenvalue. Of a vector's signs, its largest entry is positive."""
    size = len(v)
    scale = float(np.linalg.norm(v))
    found: list[np.ndarray] = []
    open_: list[np.ndarray] = [np.eye(size)] if size else []
    while open_:
        basis = open_.pop()
        block = basis.T @ v @ basis
        block = (block + block.T) / 2
        split = halves(block, scale) if basis.shape[1] > 1 and scale else None
        if split is None:
            found += list(basis.T)
        else:
            turn, k = split
            open_ += [basis @ turn[:, :k], basis @ turn[:, k:]]
    vectors = np.array(found).T.reshape(size, size)
    values = np.einsum("ij,ij->j", vectors, v @ vectors)
    order = np.argsort(-values, kind="stable")
    vectors, values = vectors[:, order], values[order]
    if size:
        vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(size)] < 0, -1.0, 1.0)
    return values, vectors


@dataclass
class Whitener:
    """Of the fit list: rows, whole parts and remainders of the means (``S = n * whole + rest``), components and eigenvalues."""

    n: int
    whole: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def explained(self) -> list[float]:
        return [float(e / self.trace) if self.trace > 0 else 0.0 for e in self.values]

    @property
    def turned(self) -> np.ndarray:
        """Projections to unit variance. A component without variance, to double precision, gives zeros."""
        some = self.values > len(self.vectors) * EPS * max(self.trace, 0.0)
        return np.where(some, self.vectors / np.sqrt(np.where(some, self.values, 1.0)), 0.0)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(float) - (self.rest / self.n if self.n else 0.0)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Exact sums of (n * x - S) ** 2."""
        y = x - self.whole
        most = (int(np.abs(y).max(initial=0)) + 1) * max(1, self.n)
        if most * most * max(1, y.shape[1]) >= 1 << 63:
            y = y.astype(object)
        z = y * self.n - self.rest.astype(y.dtype)
        return [int(s) for s in (z * z).sum(axis=1)] if y.shape[1] else [0] * len(y)


def usable(vector: Column) -> Column:
    """Not NULL, not empty, and without NULL or non-finite entries."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def whole_numbers(column: pa.ListArray, dims: int) -> np.ndarray:
    """floor(64 * c) + 1000000 of each entry, a row per vector."""
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dims)
    return np.floor(SCALE * flat).astype(np.int64) + OFFSET


def summed(rows: DataFrame, partial, kind: str) -> dict[int, object]:
    """Element-wise sums of the lists that each task makes of its rows; they reach the driver as one list of that length."""
    schema = f"v array<struct<at:int,x:{kind}>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = partial(batches)
        if total is not None:
            item = [{"at": i, "x": v} for i, v in enumerate(total)]
            yield pa.RecordBatch.from_arrays([pa.array([item], pa.list_(pa.struct([("at", pa.int32()), ("x", pa.decimal128(38, 0) if "decimal" in kind else pa.float64())])))], names=["v"])

    made = rows.mapInArrow(run, schema).select(F.explode("v").alias("p")).groupBy("p.at").agg(F.sum("p.x").alias("x"))
    return {r["at"]: r["x"] for r in made.collect()}


def exact_numbers(values) -> list:
    return [Decimal(int(v)) for v in values]


def gram(y: np.ndarray) -> np.ndarray:
    """Exact y.T @ y of whole numbers, as Python numbers: products in doubles where all sums stay below 2 ** 53."""
    most = int(np.abs(y).max(initial=0))
    step = EXACT // (most * most + 1)
    if step < 1:
        return y.astype(object).T @ y.astype(object)
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for i in range(0, len(y), step):
        part = y[i : i + step].astype(float)
        total = total + (part.T @ part).astype(np.int64).astype(object)
    return total


def fit(df: DataFrame, vector: str = "embedding", count: int = COMPONENTS) -> Whitener:
    """Covariance of all usable vectors, without rounding, and its first components.

    Three passes: sums, products of entries from which the whole part of the mean is already taken, and the covariance of
    the whitened rows. Per task and pass one list of at most dims * dims numbers is shuffled. The dimension is that of
    the longest usable vector; shorter ones take no part. Entries may be as large as 2 ** 47."""
    good = df.select(F.col(f"`{vector}`").alias("v")).filter(usable(F.col("v")))
    dims = good.agg(F.max(F.size("v")).alias("d")).first()["d"] or 0
    if not dims:
        return Whitener(0, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros((0, 0)), 0.0)
    good = good.filter(F.size("v") == dims)

    def sums(batches):
        n, total = 0, np.zeros(dims, object)
        for b in batches:
            x = whole_numbers(b.column("v"), dims)
            n, total = n + len(x), total + x.sum(axis=0).astype(object)
        return exact_numbers([n, *total]) if n else None

    found = summed(good, sums, "decimal(38,0)")
    n, s = int(found[0]), [int(found[i + 1]) for i in range(dims)]
    whole, rest = np.array([v // n for v in s], np.int64), np.array([v % n for v in s], np.int64)
    corner = np.triu_indices(dims)

    def products(batches):
        total, any_ = np.zeros((dims, dims), object), False
        for b in batches:
            if b.num_rows:
                total, any_ = total + gram(whole_numbers(b.column("v"), dims) - whole), True
        return exact_numbers(total[corner]) if any_ else None

    found = summed(good, products, "decimal(38,0)")
    v = np.zeros((dims, dims))
    for k, (i, j) in enumerate(zip(*corner)):
        # (n * G - r r') / n ** 2 in whole numbers, rounded once.
        v[i, j] = v[j, i] = (n * int(found[k]) - int(rest[i]) * int(rest[j])) / (n * n)
    values, vectors = components(v)
    made = Whitener(n, whole, rest, values[:count], vectors[:, :count], float(np.trace(v)))
    turned, kept = made.turned, min(count, dims)

    def spread(batches):
        total, any_ = np.zeros((kept + 1, kept)), False
        for b in batches:
            if b.num_rows:
                w = made.centred(whole_numbers(b.column("v"), dims)) @ turned
                total, any_ = total + np.vstack([w.T @ w, w.sum(axis=0)]), True
        return [float(x) for x in total.ravel()] if any_ else None

    found = summed(good, spread, "double")
    total = np.array([found[i] for i in range((kept + 1) * kept)]).reshape(kept + 1, kept)
    mean = total[-1] / n
    error = np.abs(total[:-1] / n - np.outer(mean, mean) - np.diag((turned != 0).any(axis=0).astype(float)))
    made.identity_error = float(error.max(initial=0.0))
    return made


def whitened(df: DataFrame, model: Whitener, vector: str = "embedding", out: str = "whitening") -> DataFrame:
    """The usable rows of ``df`` with a struct: ``deviation`` (exact sum of (n * x - S) ** 2) and ``values``, the whitened
    components. The model has a fixed size and goes with the tasks; nothing is shuffled."""
    dims, turned = len(model.whole), model.turned
    name = free_name(df, out)
    kind = T.StructType.fromDDL("deviation decimal(38,0), values array<double>")

    good = df.filter(usable(F.col(f"`{vector}`")) & (F.size(F.col(f"`{vector}`")) == dims))
    schema = T.StructType(df.schema.fields + [T.StructField(name, kind)])
    struct = pa.struct([("deviation", pa.decimal128(38, 0)), ("values", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = whole_numbers(b.column(vector), dims)
            w = model.centred(x) @ turned
            values = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
            made = pa.StructArray.from_arrays([pa.array(exact_numbers(model.deviations(x)), pa.decimal128(38, 0)), values], fields=list(struct))
            yield pa.RecordBatch.from_arrays([*b.columns, made], names=schema.names)

    return good.mapInArrow(run, schema)


def component_rows(df: DataFrame, model: Whitener, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """One row per usable vector and component, numbered from 1. ``deviation`` is NULL where a long can't hold it."""
    rows = whitened(df.select(F.col(f"`{key}`"), F.col(f"`{vector}`")), model, vector, "_whitening")
    shares = F.array(*[F.lit(x) for x in model.explained]) if model.n else F.array().cast("array<double>")
    item = F.posexplode("_whitening.values").alias("_at", "whitened")
    flat = rows.select(F.col(f"`{key}`"), F.col("_whitening.deviation").try_cast("long").alias("deviation"), item)
    return flat.select(
        key,
        (F.col("_at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("_at")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
