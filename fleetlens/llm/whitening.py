"""Whitening of embeddings by shifted CholeskyQR.

The fit list is every distinct vector once. Its exact sums give the mean; its centred rows A are
never gathered. A pass over the list adds up the Gram matrix of Q = A R^-1 (each task solves the
triangular systems for its own rows), and the Cholesky factor of that matrix is multiplied onto
R. The first pass has R = I and a shift on the diagonal, so it can't break down for nearly
dependent columns; the next ones make Q orthogonal to rounding. A's singular values and right
singular vectors are those of the small matrix R, whose SVD gives the components.

Columns are scaled by powers of two for the first factor, which is exact, so that one of large
spread doesn't hide another in the shift. Columns without spread can't be orthogonalised; they
have loading zero. Components whose variance is below ``floor`` of the whole are rounding noise
and are left out: there are at most as many as A has rank.

Rows whose vector is null, empty, or has null or non-finite entries (or of 2^56 and more, beyond
64 bits when scaled) are dropped, as are those of another length than most (of the smaller length
in a tie). Repeated rows and copies count once in the fit and are all whitened. Rows without an id
are ordinary rows. Components of equal variance may be any orthogonal ones of their space, the same
for all rows; the sign is that of the largest loading, made positive. A table without spread (empty, or one distinct vector) gives no row.

Only sums, Gram matrices (dimensions squared) and R reach the driver, whatever the rows are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.shared import written

BLOCK = 4096
LIMIT = float(1 << 62)


def whole_numbers(vector: Column, scale: int = 64, offset: int = 1_000_000) -> Column:
    """Entries as whole numbers: floor(scale * entry) + offset."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * scale) + F.lit(offset).cast("long"))


def usable(vector: Column) -> Column:
    """True for a vector with entries, all of them finite numbers that 64 bits can hold scaled."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < 2.0**56)
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, finite), F.lit(False))


def integer_rows(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x) of the usable rows of the usual length."""
    kept = rows.where(usable(F.col(vector_col))).select(F.col(id_col).alias("id"), whole_numbers(F.col(vector_col)).alias("x"))
    lengths = kept.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n"))
    usual = lengths.orderBy(F.desc("n"), "d").first()
    return kept.where(F.size("x") == (usual["d"] if usual else 0))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.int64)


def _added(parts: DataFrame) -> dict[int, np.ndarray]:
    """Sums of the arrays ``v`` of every ``at``; entry by entry, so partial sums are combined before the shuffle."""
    entries = parts.select("at", F.posexplode("v").alias("k", "c")).groupBy("at", "k").agg(F.sum("c").alias("c")).collect()
    width = 1 + max((r["k"] for r in entries), default=-1)
    out: dict[int, np.ndarray] = {}
    for r in entries:
        out.setdefault(r["at"], np.zeros(width, np.array(r["c"]).dtype))[r["k"]] = r["c"]
    return out


def fit_sums(fit: DataFrame) -> tuple[int, np.ndarray]:
    """The number of rows of the fit list and its exact sums by dimension."""

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for frame in frames:
            if len(frame):
                x = _matrix(frame["x"])
                part = np.concatenate([[len(x)], x.sum(0)])
                total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"at": [0], "v": [total.tolist()]})

    found = _added(fit.mapInPandas(add, "at int, v array<long>")).get(0)
    return (0, np.zeros(0, np.int64)) if found is None else (int(found[0]), found[1:])


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums/n: the difference is taken in whole numbers, so only the division rounds."""
    whole, rest = np.divmod(sums, n)
    return (x - whole).astype("f8") - rest / n


def solved(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Q of Q R = A for an upper triangular R, column by column."""
    q = np.empty_like(a)
    for k in range(a.shape[1]):
        q[:, k] = (a[:, k] - q[:, :k] @ r[:k, k]) / r[k, k]
    return q


def gram(fit: DataFrame, n: int, sums: np.ndarray, columns: np.ndarray | None = None, r: np.ndarray | None = None) -> np.ndarray:
    """Q'Q over the fit list, with Q = A R^-1 (A itself without R) solved row block by row block."""
    columns = np.arange(len(sums)) if columns is None else columns
    d = len(columns)

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((d, d))
        for frame in frames:
            for i in range(0, len(frame), BLOCK):
                q = centred(_matrix(frame["x"].iloc[i : i + BLOCK]), n, sums)[:, columns]
                if r is not None:
                    q = solved(q, r)
                total += q.T @ q
        yield pd.DataFrame({"at": np.arange(d, dtype=np.int32), "v": list(total)})

    found = _added(fit.mapInPandas(add, "at int, v array<double>"))
    return np.stack([found[k] for k in range(d)])


def shifted_cholesky_qr(fit: DataFrame, n: int, sums: np.ndarray, columns: np.ndarray, first: np.ndarray, passes: int = 3) -> np.ndarray:
    """R of the centred fit list's columns, from their Gram matrix ``first`` and ``passes - 1`` more passes.

    Every pass multiplies the Cholesky factor of the Gram matrix of Q onto R.
    """
    d, eps = len(columns), np.finfo("f8").eps
    scale = 2.0 ** -np.round(np.log2(np.diag(first)) / 2)
    scaled = first * scale[:, None] * scale
    # Above the rounding of the Gram matrix, so that this one can be factored.
    shift = min(11 * (n * d + d * (d + 1)) * eps * np.linalg.norm(scaled, 2), 1e-8 * np.trace(scaled))
    r = _cholesky(scaled, shift) / scale
    for _ in range(passes - 1):
        r = _cholesky(gram(fit, n, sums, columns, r), 0.0) @ r
    return r


def _cholesky(g: np.ndarray, shift: float) -> np.ndarray:
    """The upper factor of g + shift * I; the shift grows until there is one."""
    d = len(g)
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, np.finfo("f8").eps * np.trace(g))


@dataclass(frozen=True)
class Whitener:
    """What whitens a vector: exact sums of the fit list, loadings (dimension, component), variances."""

    n: int
    sums: np.ndarray
    loadings: np.ndarray
    variances: np.ndarray
    explained: np.ndarray

    def project(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums) @ self.loadings / np.sqrt(self.variances)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - sums)^2, exactly; None beyond 64 bits."""
        far = x * self.n - self.sums
        if (far.astype("f8") ** 2).sum(1).max(initial=0) < LIMIT:
            return (far * far).sum(1).tolist()
        exact = [sum(int(v) ** 2 for v in row) for row in far]
        return [v if v < 1 << 63 else None for v in exact]


def fit_whitener(fit: DataFrame, components: int = 16, passes: int = 3, floor: float = 1e-13) -> Whitener:
    """The leading components of a fit list ``x`` of distinct vectors."""
    n, sums = fit_sums(fit)
    nothing = Whitener(n, sums, np.zeros((len(sums), 0)), np.zeros(0), np.zeros(0))
    if n < 2:
        return nothing
    first = gram(fit, n, sums)
    spread = np.diag(first)
    columns = np.flatnonzero(spread > 0)
    if not len(columns):
        return nothing
    r = shifted_cholesky_qr(fit, n, sums, columns, first[np.ix_(columns, columns)], passes)
    _, s, vt = np.linalg.svd(r)
    variances = s * s / n
    kept = min(components, int((variances > floor * variances.sum()).sum()))
    loadings = np.zeros((len(sums), kept))
    loadings[columns] = vt[:kept].T
    loadings *= np.sign(loadings[np.abs(loadings).argmax(0), np.arange(kept)])
    return Whitener(n, sums, loadings, variances[:kept], variances[:kept] / (spread.sum() / n))


def identity_error(fit: DataFrame, whitener: Whitener) -> float:
    """The largest entry of the whitened fit list's covariance minus the identity."""
    k = len(whitener.variances)

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, first = np.zeros((k, k)), np.zeros(k)
        for frame in frames:
            for i in range(0, len(frame), BLOCK):
                w = whitener.project(_matrix(frame["x"].iloc[i : i + BLOCK]))
                total, first = total + w.T @ w, first + w.sum(0)
        yield pd.DataFrame({"at": np.arange(k + 1, dtype=np.int32), "v": [*total, first]})

    found = _added(fit.mapInPandas(add, "at int, v array<double>"))
    mean = found[k] / whitener.n
    covariance = np.stack([found[i] for i in range(k)]) / whitener.n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(rows: DataFrame, components: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of every usable row and component."""
    given = written(integer_rows(rows, id_col, vector_col), "vectors", merged=False)
    fit = written(given.select("x").distinct(), "fit")
    whitener = fit_whitener(fit, components)
    kept = len(whitener.variances)
    if not kept:
        error, given = 0.0, given.limit(0)
    else:
        error = identity_error(fit, whitener)

    @F.pandas_udf("deviation long, whitened array<double>")
    def project(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _matrix(batch) if len(batch) else np.zeros((0, len(whitener.sums)), np.int64)
            yield pd.DataFrame({"deviation": pd.array(whitener.deviation(x), "Int64"), "whitened": list(whitener.project(x))})

    explained = F.array(*[F.lit(float(e)) for e in whitener.explained]) if kept else F.array(F.lit(0.0))
    done = given.select("id", project("x").alias("p"))
    return done.select("id", "p.deviation", F.posexplode("p.whitened").alias("k", "whitened")).select(
        F.col("id").alias(id_col),
        (F.col("k") + 1).alias("component"),
        F.lit(whitener.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(explained, F.col("k") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
