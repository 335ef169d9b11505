"""Whitening of embeddings by shifted CholeskyQR.

The covariance is never decomposed. The centred rows A of the fit list are orthogonalised: a pass
over the table adds up the Gram matrix, the driver takes its Cholesky factor R, and the next pass
solves the rows through it, row by row, before it adds up the next Gram matrix. The first
Gram matrix is shifted by a small s, so that its factor exists whatever the rank. The shift is kept as
d further rows sqrt(s) * I that take part in every pass: so the factors' product R belongs to A with
these rows, Q becomes orthogonal to the last digit in three passes also where columns depend on each
other, and R'R is A'A + s * I exactly. The SVD of R has the principal axes, and its squared
singular values less s are n times the eigenvalues.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerlark.llm.common import pieces_of, rows_of, written

PASSES = 3
LARGEST = 2**61


def finite_vectors(vectors: DataFrame, scale: float, vector: str, keep: Sequence[str]) -> DataFrame:
    """``row`` (the columns ``keep``) and ``x``: floor(scale * component) as longs.

    Rows whose vector is null or holds a null or non-finite component are left out; scaled
    components outside the long range are cut to it, as a cast does.
    """
    doubles = F.col(vector).cast("array<double>")
    rows = vectors.select(F.struct(*keep).alias("row"), doubles.alias("v")).filter(
        "v IS NOT NULL AND NOT exists(v, c -> c IS NULL OR isnan(c) OR abs(c) = double('infinity'))"
    )
    return rows.select("row", F.transform("v", lambda c: F.floor(F.lit(float(scale)) * c)).alias("x"))


def matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def solved(rows: np.ndarray, factors: Sequence[np.ndarray]) -> np.ndarray:
    """rows * inverse(R) for each upper triangular R in turn, column by column."""
    for r in factors:
        out = np.empty_like(rows)
        for j in range(len(r)):
            out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
        rows = out
    return rows


def added(frame: DataFrame, width: int) -> np.ndarray:
    """The sum over all tasks of a matrix that each task sends as rows (piece, data).

    Rows of one number meet in a task; ``width`` doubles a row come to the driver, whatever the
    number of tasks.
    """

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for at, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                part = np.frombuffer(data, np.float64)
                held[at] = held[at] + part if at in held else part
        return pieces_of(held)

    rows = frame.repartition("piece").mapInArrow(unite, "piece int, data binary").collect()
    out = np.zeros((width, width))
    for row in rows:
        out[row["piece"]] = np.frombuffer(row["data"], np.float64)
    return out


class Centre:
    """Size and sums of the fit list: ``n * x - S`` is exact, its n-th part a centred row."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums, self.dim = n, sums, len(sums)

    def offsets(self, x: np.ndarray) -> np.ndarray:
        return self.n * x - np.array(self.sums, np.int64)

    def rows(self, x: np.ndarray) -> np.ndarray:
        return self.offsets(x) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of squared offsets: halves of 31 bits are squared apart, as one square may not fit."""
        offset = np.abs(self.offsets(x))
        high, low = offset >> 31, offset & 0x7FFFFFFF
        parts = [high * high, high * low, low * low]
        # Sums of squares may pass 64 bits as well: again by halves.
        sums = [((p >> 32).sum(axis=1).tolist(), (p & 0xFFFFFFFF).sum(axis=1).tolist()) for p in parts]
        out = []
        for i in range(len(x)):
            hh, hl, ll = (((a[i] << 32) + b[i]) for a, b in sums)
            total = (hh << 62) + (hl << 32) + ll
            out.append(total if total < 2**63 else None)
        return out


def centre_of(fit: DataFrame, dim: int) -> Centre:
    """Number and exact sums of the rows; every task sends one row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(dim, np.int64), np.zeros(dim, np.int64)
        for b in batches:
            x = matrix(b.column("x"), dim)
            n, high, low = n + len(x), high + (x >> 31).sum(axis=0), low + (x & 0x7FFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"n": [n], "high": [high.tolist()], "low": [low.tolist()]})

    parts = fit.mapInArrow(count, "n bigint, high array<bigint>, low array<bigint>")
    whole = parts.agg(F.sum("n"), *[F.sum(F.col(c)[i]) for c in ("high", "low") for i in range(dim)]).first()
    sums = [(whole[1 + i] << 31) + whole[1 + dim + i] for i in range(dim)]
    n = whole[0]
    return Centre(n, sums)


def gram(fit: DataFrame, centre: Centre, factors: Sequence[np.ndarray]) -> np.ndarray:
    """The Gram matrix of the centred rows, solved through the factors."""
    dim = centre.dim

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for b in batches:
            q = solved(centre.rows(matrix(b.column("x"), dim)), factors)
            total += q.T @ q
        return pieces_of(dict(enumerate(total)))

    return added(fit.mapInArrow(build, "piece int, data binary"), dim)


class Axes:
    """Principal axes as columns, with the eigenvalues and the trace of the covariance.

    Axes without variance have the eigenvalue 0.
    """

    def __init__(self, axes: np.ndarray, values: np.ndarray, trace: float):
        self.axes, self.values, self.trace = axes, values, trace

    def whiten(self, rows: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return (rows @ self.axes) / np.sqrt(self.values)


def principal_axes(fit: DataFrame, centre: Centre, k: int) -> Axes:
    """The first ``k`` axes by :data:`PASSES` Gram passes over the fit list."""
    dim, n = centre.dim, centre.n
    first = gram(fit, centre, [])
    trace = float(np.trace(first))
    if trace == 0:
        return Axes(np.eye(dim)[:, :k], np.zeros(min(k, dim)), 0.0)
    shift = 11 * (dim * (dim + 1) + dim * np.log2(n + 2)) * np.finfo(float).eps * trace
    pad, factors, whole = np.sqrt(shift) * np.eye(dim), [], first
    for step in range(PASSES):
        if step:
            whole = gram(fit, centre, factors)
        factors.append(np.linalg.cholesky(whole + pad.T @ pad).T)
        pad = solved(pad, factors[-1:])
    r = reduce(lambda product, factor: factor @ product, factors)
    _, spread, axes = np.linalg.svd(r)
    values = (spread**2 - shift) / n
    axes, values = axes[:k].T, np.where(values > 4 * shift / n, values, 0.0)[:k]
    largest = axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])]
    return Axes(axes * np.sign(largest), values, trace / n)


def identity_error(fit: DataFrame, centre: Centre, axes: Axes) -> float:
    """Largest absolute entry of the covariance of the whitened fit list less the identity.

    The whitened rows are projections of centred rows and so centred. Axes without variance do
    not count; 0 if there are none with it.
    """
    dim, live = centre.dim, np.flatnonzero(axes.values > 0)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(live), len(live)))
        for b in batches:
            w = axes.whiten(centre.rows(matrix(b.column("x"), dim)))[:, live]
            total += w.T @ w
        return pieces_of(dict(enumerate(total)))

    if not len(live):
        return 0.0
    covariance = added(fit.mapInArrow(build, "piece int, data binary"), len(live)) / centre.n
    return float(np.abs(covariance - np.eye(len(live))).max())


def whiten(
    vectors: DataFrame, components: int = 4, scale: float = 256, vector: str = "embedding", keep: Sequence[str] | None = None
) -> DataFrame:
    """One row for each vector and component: the columns ``keep`` (all) packed in ``row``, then
    ``component, n, deviation, whitened, explained, identity_error``.

    Vectors become x = floor(scale * component); rows whose vector is null or holds null or
    non-finite components are dropped, and so are empty vectors, which have no component. Each distinct x is fitted
    once, however many rows share it, so that a vector of many copies weighs one; every row gets its components.
    Vectors of each length are whitened apart, as spaces of their own. Components are
    numbered by falling variance, with the sign that makes their largest entry positive; among equal
    variances any axes are right. A component without variance has a null ``whitened``; ``explained`` is null where
    nothing varies. ``deviation`` is exact, and null where it passes a long; entries must keep n times the
    greatest below 2**61, else the query fails. An empty table gives no rows.
    """
    stored = written(finite_vectors(vectors, scale, vector, keep or vectors.columns), "whole-vectors")
    distinct = written(stored.select("x").distinct().filter("size(x) > 0"), "distinct-vectors")
    sizes = distinct.groupBy(F.size("x").alias("dim")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.greatest(F.array_max("x"), -F.array_min("x"))).alias("most")
    )
    parts = []
    for size in sizes.orderBy("dim").collect():  # one row a vector length
        if size["n"] * size["most"] >= LARGEST:
            raise ValueError(f"vectors of length {size['dim']}: sums do not fit into 64 bits")
        this = F.size("x") == size["dim"]
        parts.append(_whitened(stored.filter(this), distinct.filter(this), size["dim"], components))
    if not parts:
        nothing = (("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"),
                   ("explained", "double"), ("identity_error", "double"))
        return stored.filter("false").select("row", *[F.lit(None).cast(t).alias(n) for n, t in nothing])
    return reduce(DataFrame.unionByName, parts)


def _whitened(rows: DataFrame, fit: DataFrame, dim: int, components: int) -> DataFrame:
    centre = centre_of(fit, dim)
    axes = principal_axes(fit, centre, components)
    error = identity_error(fit, centre, axes)
    live = axes.values > 0
    schema = rows.select("row").schema.add("n", "long").add("deviation", "long").add("parts", T.ArrayType(T.DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column("x"), dim)
            whitened = axes.whiten(centre.rows(x))
            parts = pa.array([[v if ok else None for v, ok in zip(r, live)] for r in whitened.tolist()], pa.list_(pa.float64()))
            fields = [("row", b.schema.field("row").type), ("n", pa.int64()), ("deviation", pa.int64()), ("parts", parts.type)]
            yield rows_of(pa.schema(fields), [b.column("row"), [centre.n] * len(x), centre.deviations(x), parts])

    share = F.array(*[F.lit(float(v / axes.trace) if axes.trace else None).cast("double") for v in axes.values])
    long = rows.mapInArrow(run, schema).select("row", "n", "deviation", F.posexplode("parts").alias("at", "whitened"))
    return long.select(
        "row", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
        F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
