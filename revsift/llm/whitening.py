"""Whitening of embeddings from exact integer cross-products, by a bit-sliced scatter.

Entries become integers.  A block of rows is shifted by its smallest value in each dimension, and bit k of a dimension's
shifted values is packed across the rows into 64-bit words, a bit plane.  The cross-product of two dimensions is then the
sum over pairs of their planes of 2**(a+b) times the ones in both, an AND and a population count; the shift is taken
out again with the block's sums.  Tasks hand on the sums in limbs of 32 bits, so Spark adds them up exactly at any size;
the scatter is centred as integers, and only then goes to the eigensolver."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revsift.llm import common as C
from revsift.session import cut_lineage

SCALE = 256
COMPONENTS = 4
#: Rows of a block: 64 words a plane.
BLOCK = 4096
LIMB = 32
#: Eigenvalues below this share of the trace count as zero: such a component has no direction of its own.
ZERO = 1e-12
LONG = np.iinfo(np.int64)


def quantised(vector: Column) -> Column:
    """x = floor(256 * c) of every entry, as long (beyond a long's range: its end)."""
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(c * F.lit(float(SCALE))).cast("long"))


def usable(vector: Column) -> Column:
    """Neither null nor with a null, NaN or infinite entry; a vector without entries isn't usable either."""
    odd = F.exists(vector.cast("array<double>"), lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(odd, F.lit(True))


def matrix(column, dims: int) -> np.ndarray:
    """Rows of an Arrow list column as (rows, dims) longs; a shorter vector ends in zeros."""
    ends = np.asarray(column.offsets, np.int64)
    flat = np.asarray(column.values, np.int64)
    size = np.diff(ends)
    if len(size) and (size == dims).all():
        return flat[ends[0]:ends[-1]].reshape(-1, dims)
    out = np.zeros((len(size), dims), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(ends[0], ends[-1]) - np.repeat(ends[:-1], size)] = flat[ends[0]:ends[-1]]
    return out


def planes(shifted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of non-negative columns: (dimension, bit) of each plane, and its words."""
    rows = len(shifted)
    dim, bit, words = [], [], []
    for j in range(shifted.shape[1]):
        for k in range(int(shifted[:, j].max()).bit_length()):
            packed = np.packbits(((shifted[:, j] >> np.uint64(k)) & np.uint64(1)).astype(np.uint8), bitorder="little")
            words.append(np.pad(packed, (0, -(-rows // 64) * 8 - len(packed))).view(np.uint64))
            dim.append(j)
            bit.append(k)
    return np.array(dim, int), np.array(bit, int), np.array(words, np.uint64).reshape(len(dim), -(-rows // 64))


def cross_products(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sum of x_i, sum of x_i * x_j) of a block, exact Python integers."""
    n, dims = x.shape
    low = x.min(axis=0)
    shifted = x.astype(np.uint64) - low.astype(np.uint64)   # modulo 2**64: right for any two longs
    dim, bit, words = planes(shifted)
    both = np.empty((len(dim), len(dim)), np.int64)
    for p in range(len(dim)):
        both[p, p:] = np.bitwise_count(words[p] & words[p:]).sum(axis=1)
        both[p:, p] = both[p, p:]
    # a product below 2**52 is exact in doubles and longs alike
    small = len(bit) == 0 or 2 * (int(bit.max()) + 1) + n.bit_length() < 52
    weights = np.zeros((dims, len(dim)), np.float64 if small else object)
    for p, (j, k) in enumerate(zip(dim, bit)):
        weights[j, p] = 1 << int(k)
    ones = np.diag(both).astype(weights.dtype)
    raw = weights @ both.astype(weights.dtype) @ weights.T if len(dim) else np.zeros((dims, dims))
    first = weights @ ones if len(dim) else np.zeros(dims)
    raw = np.array([[int(v) for v in r] for r in raw], object).reshape(dims, dims)
    s = np.array([int(v) for v in first], object)
    m = np.array([int(v) for v in low], object)
    return s + n * m, raw + np.outer(m, s) + np.outer(s, m) + n * np.outer(m, m)


def limbs(values) -> tuple[list[int], list[int], list[int]]:
    """(place, limb, value) rows of exact integers: limbs of LIMB bits, all of the value's sign."""
    at, limb, out = [], [], []
    for i, v in enumerate(values):
        sign, v, k = (-1, -v, 0) if v < 0 else (1, v, 0)
        while v:
            at.append(i)
            limb.append(k)
            out.append(sign * (v & ((1 << LIMB) - 1)))
            v >>= LIMB
            k += 1
    return at, limb, out


def _scatter(dims: int):
    """Per task: row count, sums and upper triangle of cross-products, in limbs."""
    def run(batches):
        upper = np.triu_indices(dims)
        total = [0] * (1 + dims + len(upper[0]))
        for b in batches:
            x = matrix(b.column("x"), dims)
            for a in range(0, len(x), BLOCK):
                part = x[a:a + BLOCK]
                s, g = cross_products(part)
                for i, v in enumerate([len(part), *s, *g[upper]]):
                    total[i] += v
        at, limb, out = limbs(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(limb, pa.int32()), pa.array(out, pa.int64())],
                                         names=["place", "limb", "value"])
    return run


def scatter(distinct: DataFrame, dims: int) -> tuple[int, list[int], np.ndarray]:
    """(rows n, sums S, cross-products) of ``x array<long>``; the driver gets dims**2 / 2 numbers."""
    rows = (distinct.select("x").mapInArrow(_scatter(dims), "place int, limb int, value long")
            .groupBy("place", "limb").agg(F.sum("value").alias("value")).collect())
    upper = np.triu_indices(dims)
    total = [0] * (1 + dims + len(upper[0]))
    for r in rows:
        total[r.place] += r.value << (LIMB * r.limb)
    g = np.zeros((dims, dims), object)
    g[upper] = total[1 + dims:]
    g.T[upper] = total[1 + dims:]
    return total[0], total[1:1 + dims], g


def components(n: int, sums: list[int], products: np.ndarray, count: int) -> dict:
    """Unit eigenvectors (dims, k) of the covariance and their eigenvalues, falling; the trace."""
    s = np.array(sums, object)
    centred = n * products - np.outer(s, s)          # n**2 times the covariance, exact
    cov = np.array([[v / (n * n) for v in row] for row in centred], float).reshape(len(s), len(s))
    values, vectors = np.linalg.eigh(cov)
    k = min(count, len(s))
    order = np.argsort(-values, kind="stable")[:k]
    trace = sum(int(centred[i, i]) for i in range(len(s))) / (n * n)
    values = np.where(values[order] > ZERO * trace, values[order], 0.0)
    return {"n": n, "sums": [int(v) for v in sums], "vectors": vectors[:, order], "values": values, "trace": trace}


def _largest(x: np.ndarray, n: int, sums: list[int]) -> int:
    """A bound on every abs(n * x - S)."""
    return n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) + max(map(abs, sums), default=0)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list:
    """Sum over dimensions of (n * x - S) ** 2, exact; None where a long can't hold it."""
    most = _largest(x, n, sums)
    if most * most * len(sums) <= LONG.max:
        d = n * x - np.array(sums, np.int64)
        return (d * d).sum(axis=1).tolist()
    out = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    return [v if v <= LONG.max else None for v in out]


def project(x: np.ndarray, model: dict) -> np.ndarray:
    """(rows, k): x - S/n on the components, over the root of their eigenvalues; zero for an eigenvalue of zero."""
    n = model["n"]
    if _largest(x, n, model["sums"]) <= LONG.max:
        centred = (n * x - np.array(model["sums"], np.int64)) / n
    else:
        centred = np.array([[(n * int(v) - s) / n for v, s in zip(row, model["sums"])] for row in x], float).reshape(x.shape)
    root = np.sqrt(model["values"])
    return np.divide(centred @ model["vectors"], root, out=np.zeros((len(x), len(root))), where=root > 0)


def _moments(shared, dims: int):
    def run(batches):
        m = shared.value
        k = len(m["values"])
        first, second = np.zeros(k), np.zeros((k, k))
        for b in batches:
            w = project(matrix(b.column("x"), dims), m)
            first += w.sum(axis=0)
            second += w.T @ w
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array([*range(-k, 0), *range(len(i))], pa.int32()),
                                          pa.array([*first, *second[i, j]], pa.float64())], names=["place", "value"])
    return run


def identity_error(distinct: DataFrame, shared, dims: int, model: dict) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, measured over the rows; components
    of eigenvalue zero, whose values are all zero, are left out (0 if there is no other)."""
    k = len(model["values"])
    rows = (distinct.select("x").mapInArrow(_moments(shared, dims), "place int, value double")
            .groupBy("place").agg(F.sum("value").alias("value")).collect())
    got = {r.place: r.value for r in rows}
    mean = np.array([got[i - k] for i in range(k)]) / model["n"]
    cov = np.zeros((k, k))
    cov[np.triu_indices(k)] = [got[i] / model["n"] for i in range(k * (k + 1) // 2)]
    cov = np.triu(cov) + np.triu(cov, 1).T - np.outer(mean, mean)
    real = model["values"] > 0
    return float(np.abs(cov - np.eye(k))[np.ix_(real, real)].max(initial=0.0))


_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components_: int = COMPONENTS) -> DataFrame:
    """One row per usable row and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Rows whose vector is null, empty or holds a null or non-finite entry go.  Each distinct quantised vector counts once
    in the fit; a vector shorter than the longest ends in zeros.  A component of eigenvalue zero (constant or dependent
    data) has whitened and explained 0; a deviation that no long holds is null.  Repeated rows and null ids give rows
    each; other columns are not read; an empty table, or one without a usable row, gives an empty result."""
    spark = C.prepare(df.sparkSession)
    vector = F.col(f"`{vector_col}`")
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.when(usable(vector), quantised(vector)).alias("x")).where("x is not null")
    distinct = cut_lineage(rows.select("x").distinct())   # copies are met in their task first
    dims = distinct.agg(F.max(F.size("x"))).first()[0]
    if not dims:
        return spark.createDataFrame([], _OUT)
    if distinct.where(F.size("x") < dims).limit(1).count():   # equal but for their zeros at the end
        pad = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("x")))
        distinct = cut_lineage(distinct.select(pad.alias("x")).distinct())
    model = components(*scatter(distinct, dims), components_)
    shared = spark.sparkContext.broadcast(model)
    error = identity_error(distinct, shared, dims, model)
    share = [float(v / model["trace"]) if model["trace"] > 0 else 0.0 for v in model["values"]]

    def run(batches):
        m = shared.value
        k = len(m["values"])
        for b in batches:
            x = matrix(b.column("x"), dims)
            d = deviations(x, m["n"], m["sums"])
            rows_, w = len(x), project(x, m)
            yield pa.RecordBatch.from_arrays([
                b.column("vec_id").take(pa.array(np.repeat(np.arange(rows_), k))),
                pa.array(np.tile(np.arange(1, k + 1), rows_), pa.int32()), pa.array([m["n"]] * rows_ * k, pa.int64()),
                pa.array([v for v in d for _ in range(k)], pa.int64()), pa.array(w.reshape(-1)),
                pa.array(np.tile(share, rows_)), pa.array([error] * rows_ * k, pa.float64())],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return rows.mapInArrow(run, _OUT)
