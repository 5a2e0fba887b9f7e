"""Operator 12, embedding whitening: upper-triangle column aggregates, then LAPACK.

Vectors become grid points: an entry ``c`` is the long ``floor(64 * c) + 1000000``. One aggregation has the
sums of all dimensions, a second one a sum of centred products for each pair of dimensions, as generated
SQL. Products are centred on the whole number next to the mean, so that they and their sums are whole
numbers, which doubles hold exactly up to 2^53 whatever the order of summing; what is left of the mean,
under a half, is taken off in exact integer arithmetic. The covariance, at most some thousand dimensions
square, is decomposed on the driver; vectors are projected where they lie, without a shuffle.

Vectors of more than ``BLOCK`` dimensions have their triangle cut into blocks, one row of sums each, so that
the generated SQL stays bounded; each is still one aggregation over all rows.

Defined results: rows whose vector is null, holds a null, NaN or infinite entry, or one whose grid point does
not fit in a long go, and so do those not of the commonest length (of equally common ones the longest);
null and repeated ids, repeated rows are kept, each counts. Components whose eigenvalue is not above
``FLAT`` times the largest do not exist: whitening would divide by nothing. So a single row, rows all alike
and an empty table give no rows. A deviation that does not fit in a long is null. Columns other than the id
and the vector are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import ship

ship(__name__)

SCALE, SHIFT = 64, 1_000_000
#: Entries must be smaller, so that grid points fit in a long.
LARGEST = float(2**56)
#: Dimensions of a block of the triangle.
BLOCK = 64
#: Smallest part of the largest eigenvalue that counts as a direction.
FLAT = 1e-12


def on_grid(rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, x): the grid points of the rows that remain, before lengths are compared."""
    good = F.coalesce(F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST, F.lit(False))), F.lit(False))
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(SCALE))) + F.lit(SHIFT))
    return rows.where(good).select(F.col(key).alias(key), x.alias("x"))


def commonest_length(grid: DataFrame) -> int:
    """0 if there are no rows."""
    first = grid.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    return first.dims if first else 0


def dimension_sums(grid: DataFrame, dims: int) -> tuple[int, list[int]]:
    """The number of rows, and the exact sum of each dimension."""
    row = grid.agg(F.count("*"), *[F.sum(F.get("x", F.lit(i)).cast("decimal(20,0)")) for i in range(dims)]).first()
    return row[0], [int(v or 0) for v in row[1:]]


def _listed(sums) -> str:
    return f"array({', '.join(sums)}) as s"


def pair_sums(rows: DataFrame, values: list[Column], block: int = BLOCK) -> np.ndarray:
    """The sum over all rows of the product of each two values, as a symmetric matrix, by one aggregation."""
    dims = len(values)
    if dims <= block:
        pairs = [(i, j) for i in range(dims) for j in range(i, dims)]
        flat = rows.select(*[v.alias(f"v{i}") for i, v in enumerate(values)])
        sums = flat.selectExpr(_listed(f"sum(v{i} * v{j})" for i, j in pairs)).first()
        found = [(i, j, s) for (i, j), s in zip(pairs, sums.s)]
    else:
        starts = range(0, dims, block)
        width = {s: min(block, dims - s) for s in starts}
        parts = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in starts for b in starts if a <= b])
        held = rows.select(F.array(*values).alias("v"), F.explode(parts).alias("at"))
        # The last block may be narrower: a place past the end counts as nothing.
        flat = held.select(
            "at",
            *[F.coalesce(F.get("v", F.col(f"at.{s}") + i), F.lit(0.0)).alias(f"{s}{i}") for s in "ab" for i in range(block)],
        )
        sums = flat.groupBy("at").agg(F.expr(_listed(f"sum(a{i} * b{j})" for i in range(block) for j in range(block)))).collect()
        found = [(r["at"].a + i, r["at"].b + j, r.s[i * block + j]) for r in sums for i in range(width[r["at"].a]) for j in range(width[r["at"].b])]
    out = np.empty((dims, dims), object)
    for i, j, s in found:
        out[i, j] = out[j, i] = s
    return out


@dataclass(frozen=True)
class Fit:
    """What whitening needs: the number of rows, the sums, and the components by falling eigenvalue as columns."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def kept(self, most: int) -> int:
        """Components that exist, ``most`` at most."""
        top = self.values[0] if len(self.values) else 0.0
        return min(most, int((self.values > FLAT * top).sum())) if top > 0 else 0


def fit(grid: DataFrame, dims: int, block: int = BLOCK) -> Fit:
    """Means, covariance with divisor n, eigenvectors of all rows of ``grid``."""
    n, sums = dimension_sums(grid, dims)
    if n == 0 or dims == 0:
        return Fit(n, tuple(sums), np.empty(0), np.empty((dims, 0)), 0.0)
    centres = [(2 * s + n) // (2 * n) for s in sums]
    centred = [(F.get("x", F.lit(i)) - F.lit(c)).cast("double") for i, c in enumerate(centres)]
    products = pair_sums(grid, centred, block)
    rest = [s - n * c for s, c in zip(sums, centres)]
    # Whole numbers of any size, rounded once by the division.
    covariance = np.array([[(n * int(products[i, j]) - rest[i] * rest[j]) / (n * n) for j in range(dims)] for i in range(dims)])
    values, vectors = np.linalg.eigh(covariance)
    return Fit(n, tuple(sums), values[::-1], np.ascontiguousarray(vectors[:, ::-1]), float(np.trace(covariance)))


def project(grid: DataFrame, of: Fit, most: int, key: str = "vec_id") -> DataFrame:
    """(key, deviation, whitened): the squared distance from the mean in n-ths, exact, and the components of each row."""
    k, n, dims = of.kept(most), of.n, len(of.sums)
    weights = of.vectors[:, :k] / np.sqrt(of.values[:k])
    # The mean as a whole number and what is left, so that no digits are lost.
    whole = [s // n for s in of.sums] if n else []
    left = np.array([(s - n * w) / n for s, w in zip(of.sums, whole)])

    def run(batches):
        import pyarrow as pa

        for b in batches:
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            centred = (x - np.array(whole, np.int64)).astype(float) - left
            out = centred @ weights
            offsets = np.arange(0, out.size + 1, k, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))], names=[key, "x", "whitened"])

    if not k:
        return grid.select(key, F.lit(0).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened")).limit(0)
    kind = grid.schema[key].dataType.simpleString()
    rows = grid.mapInArrow(run, f"`{key}` {kind}, x array<long>, whitened array<double>")
    fits = max(map(abs, of.sums)) < 2**63
    # From n * x on, what does not fit in a long is null.
    gaps = F.zip_with("x", F.array(*[F.lit(s).cast("long") for s in of.sums]), lambda x, s: F.try_subtract(F.try_multiply(F.lit(n).cast("long"), x), s)) if fits else F.array(F.lit(None).cast("long"))
    deviation = F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: F.try_add(a, F.try_multiply(g, g)))
    return rows.select(key, deviation.alias("deviation"), "whitened")


def identity_error(projected: DataFrame, n: int, k: int) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity. Their means, nothing but rounding, are taken off too."""
    if not k:
        return 0.0
    values = [F.get("whitened", F.lit(i)) for i in range(k)]
    sums = pair_sums(projected, [*values, F.lit(1.0)]).astype(float)
    means = sums[:k, k] / n
    return float(np.abs(sums[:k, :k] / n - np.outer(means, means) - np.eye(k)).max())


def whiten(rows: DataFrame, most: int = 32, key: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, Fit, float]:
    """(key, deviation, whitened) with ``whitened`` an array of up to ``most`` components; the fit; and the identity error.

    Four passes over the vectors, which are read anew in each: lengths, sums, products, and the check of the result.
    """
    grid = on_grid(rows, key, vector)
    dims = commonest_length(grid)
    grid = grid.where(F.size("x") == dims)
    of = fit(grid, dims)
    projected = project(grid, of, most, key)
    return projected, of, identity_error(projected, of.n, of.kept(most))


def whitening_report(rows: DataFrame, most: int = 32) -> DataFrame:
    """The query's rows: one for each vector and component."""
    projected, of, error = whiten(rows, most)
    explained = F.array(*[F.lit(float(v / of.trace)) for v in of.values[: of.kept(most)]]).cast("array<double>")
    each = projected.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(of.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
