"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

With X the centred rows, the method alternates u = Xv and v = X'u, orthogonalises each new vector
against all earlier ones of its side, and collects the coefficients in a small bidiagonal matrix
whose singular values and vectors are those of X. The long vectors u are never stored: each is X
times a vector as wide as a row (``w`` below), so a pass over the rows rebuilds all of them, works
out the new one, its products with the earlier ones, and X'u. A pass sends back as many numbers as
a row has entries, plus one per step, added up before they reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwell.llm.common import fresh, stored

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
# A step ends the search once every wanted singular value is known to this share of the largest.
CONVERGED = 1e-14
# Singular values below this share of the largest are rounding: such components cannot be whitened.
RANK = 1e-9


@dataclass
class Whitening:
    """Counts, exact column sums, and the leading eigenpairs of the covariance."""

    n: int
    sums: np.ndarray  # long, per dimension
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # one column per eigenvector
    trace: float
    steps: int


def usable(vectors: DataFrame, column: str = "embedding", name: str = "x") -> DataFrame:
    """Rows whose vector is not null and holds finite entries only, with the vector in whole steps.

    ``name`` gets floor(1024 * entry) + 100000 of every entry, taken as double, as array of longs;
    a column of that name is replaced.
    """
    v = F.col(f"`{column}`")
    fine = v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    steps = F.transform(v, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + OFFSET)
    return vectors.filter(fine).withColumn(name, steps)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _centred(column: pa.Array, n: int, sums: np.ndarray) -> np.ndarray:
    # n * x - sum is a whole number, so nothing is lost before the one division.
    return (n * _matrix(column, len(sums)) - sums).astype(np.float64) / n


def _added(rows: DataFrame, name: str, length: int, of) -> np.ndarray:
    """Sum over all partitions of ``of(array of a batch)``, a vector of ``length`` doubles."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for batch in batches:
            if batch.num_rows:
                total += of(batch.column(0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(length)), pa.array(total)], ["at", "v"])

    parts = rows.select(f"`{name}`").mapInArrow(part, "at long, v double")
    out = np.zeros(length)
    for r in parts.groupBy("at").agg(F.sum("v").alias("v")).collect():
        out[r["at"]] = r["v"]
    return out


def _orthogonal(rng, basis: np.ndarray, width: int) -> np.ndarray | None:
    """A random unit vector at right angles to the columns of ``basis``; None if they fill the space."""
    if basis.shape[1] >= width:
        return None
    v = rng.standard_normal(width)
    for _ in range(3):
        v = v - basis @ (basis.T @ v)
        v /= np.linalg.norm(v)
    return v


def fit(rows: DataFrame, name: str = "x", k: int = COMPONENTS) -> Whitening | None:
    """The ``k`` leading components of the long vectors in ``name``; None without rows.

    Vectors of different lengths raise ValueError. Of a covariance of lower rank only the
    components with a variance are returned, so constant vectors have none. Repeated rows count
    each time. The driver holds two vectors per step, each as wide as a row; there are at most as
    many steps as dimensions, fewer if the wanted components have settled before.
    """
    width = F.size(F.col(f"`{name}`"))
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.min(width).alias("least"), F.max(width).alias("most")).first()
    if not sizes["n"]:
        return None
    if sizes["least"] != sizes["most"]:
        raise ValueError(f"vectors have from {sizes['least']} to {sizes['most']} entries")
    n, d = sizes["n"], sizes["most"]
    sums = np.zeros(d, np.int64)
    entries = rows.select(F.posexplode(F.col(f"`{name}`")).alias("at", "x"))
    for r in entries.groupBy("at").agg(F.sum("x").alias("s")).collect():
        sums[r["at"]] = r["s"]

    trace = _added(rows, name, 1, lambda x: np.array([np.square(_centred(x, n, sums)).sum()]))[0] / n
    none = Whitening(n, sums, np.zeros(0), np.zeros((d, 0)), trace, 0)
    if trace == 0 or d == 0:
        return none

    rng = np.random.default_rng(0)
    right, left, images = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))  # v, w with u = Xw, and X'u
    alphas: list[float] = []
    betas: list[float] = []
    v, size = _orthogonal(rng, right, d), math.sqrt(trace * n)
    while True:
        asked = v if not len(alphas) else v - betas[-1] * left[:, -1]
        both = np.column_stack([left, asked])

        def products(x, both=both):
            y = _centred(x, n, sums)
            u = y @ both
            return np.concatenate([u.T @ u[:, -1], y.T @ u[:, -1]])

        got = _added(rows, name, both.shape[1] + d, products)
        along, square, image = got[: left.shape[1]], got[left.shape[1]], got[both.shape[1] :]
        # The new u without its shares of the earlier ones, which are of length one.
        asked, image = asked - left @ along, image - images @ along
        alpha = math.sqrt(max(0.0, square - along @ along))
        right = np.column_stack([right, v])
        if alpha > RANK * size:
            w, image = asked / alpha, image / alpha
        else:  # v lies where the rows do not reach
            alpha, w, image = 0.0, np.zeros(d), np.zeros(d)
        left, images = np.column_stack([left, w]), np.column_stack([images, image])
        alphas.append(alpha)
        new = image - alpha * v
        for _ in range(2):
            new = new - right @ (right.T @ new)
        beta = float(np.linalg.norm(new))

        small = np.diag(alphas) + np.diag(betas, 1)
        ends, singular, turned = np.linalg.svd(small)
        wanted = min(k, d)
        settled = len(alphas) >= wanted and np.all(beta * np.abs(ends[-1, :wanted]) <= CONVERGED * singular[0])
        # One vector started the search, so equal eigenvalues may hide: only a full space proves there are no more.
        if len(alphas) == d or (settled and beta > RANK * size):
            break
        if beta > RANK * size:
            v = new / beta
            betas.append(beta)
        else:
            v = _orthogonal(rng, right, d)
            betas.append(0.0)

    held = singular[:wanted] > RANK * size
    values = np.square(singular[:wanted][held]) / n
    return Whitening(n, sums, values, (right @ turned.T)[:, :wanted][:, held], trace, len(alphas))


def whiten(rows: DataFrame, model: Whitening, keep: list[str], name: str = "x") -> DataFrame:
    """``keep`` columns, deviation (long) and whitened (array of double, one per component) of each row.

    deviation is the exact sum over dimensions of (n * x - sum) squared; beyond 64 bits it raises.
    Columns of ``keep`` with these names are replaced.
    """
    n, sums, turn = model.n, model.sums, model.vectors / np.sqrt(model.values)

    @F.arrow_udf("deviation long, whitened array<double>")
    def worked(x: pa.Array) -> pa.Array:
        whole = n * _matrix(x, len(sums)) - sums
        if len(whole) and np.square(whole.astype(np.float64)).sum(axis=1).max() > 9.2e18:
            raise OverflowError("a deviation takes more than 64 bits")
        out = (whole.astype(np.float64) / n) @ turn
        lists = pa.ListArray.from_arrays(np.arange(len(out) + 1, dtype=np.int32) * out.shape[1], pa.array(out.ravel()))
        return pa.StructArray.from_arrays([pa.array(np.square(whole).sum(axis=1)), lists], ["deviation", "whitened"])

    result = fresh(rows, "__whitened")
    kept = [rows[f"`{c}`"] for c in keep if c.lower() not in ("deviation", "whitened")]
    marked = rows.select(*kept, worked(rows[f"`{name}`"]).alias(result))
    return marked.select(*[marked[f"`{c}`"] for c in marked.columns[:-1]], f"{result}.deviation", f"{result}.whitened")


def identity_error(rows: DataFrame, model: Whitening, name: str = "x") -> float | None:
    """Largest absolute entry of the whitened rows' covariance minus the identity, in two passes."""
    k, turn = len(model.values), model.vectors / np.sqrt(model.values)
    if not k:
        return None
    n, sums = model.n, model.sums
    mean = _added(rows, name, k, lambda x: (_centred(x, n, sums) @ turn).sum(axis=0)) / n

    def squares(x):
        z = _centred(x, n, sums) @ turn - mean
        return (z.T @ z).ravel()

    return float(np.abs(_added(rows, name, k * k, squares).reshape(k, k) / n - np.eye(k)).max())


def components(vectors: DataFrame, id_col: str = "vec_id", column: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null, or holds a null or non-finite entry, drop out. Ids may be null or
    repeated: rows are never joined. No usable rows, and vectors that are all the same, give none.
    """
    rows = stored(usable(vectors.select(f"`{id_col}`", f"`{column}`"), column, "x").select(f"`{id_col}`", "x"))
    model = fit(rows, "x", k)
    shape = f"`{id_col}` {dict(rows.dtypes)[id_col]}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], shape)
    shares = F.array(*[F.lit(float(e / model.trace)) for e in model.values])
    error = identity_error(rows, model)
    out = whiten(rows, model, [id_col])
    return out.select(f"`{id_col}`", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        f"`{id_col}`",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
