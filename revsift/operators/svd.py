"""Truncated (uncentred) SVD of the TF-IDF matrix and projection onto it.

Exact fit (up to ``MAX_EXACT_DIM`` features): one pass over Arrow batches.  A
task scatters 1024 sparse rows at a time into a dense block with a column of
ones and adds the block's product to its partial Gramian, so the same pass
gives ``X^T X``, the column sums and the row count.  Partials are cut into
strips of a few MB and summed in a tree, eight at a time, until one is left;
its top-``k`` eigenpairs give ``V`` and the singular values.

Randomised fit (more features, where ``d x d`` is too big, or on request): a
range finder.  Each pass multiplies ``X^T (X Q)`` for a thin ``Q`` of ``k``
plus some columns and orthonormalises the result; after a few passes ``Q``
spans the leading directions, and the small matrix ``(XQ)^T (XQ)`` gives the
singular pairs inside it.  Every pass moves ``d x l`` numbers per partial.

Signs follow the usual convention: the largest-magnitude loading of each
component is positive.

Transform: ``V`` (``d x k`` doubles) is broadcast; a pandas UDF scatters each
Arrow batch, 1024 rows at a time, into a dense ``rows x d`` block and
projects it with one BLAS matrix product.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

# Features up to which the d x d Gramian is formed.
MAX_EXACT_DIM = 4096
# Rows of a dense block, bytes of a strip, partials summed at once, and partials at most.
CHUNK, STRIP_BYTES, FAN_IN, MAX_PARTIALS = 1024, 4 << 20, 8, 64
# The range finder's extra columns and passes.
OVERSAMPLE, PASSES = 10, 6


@dataclass
class SvdModel:
    components: np.ndarray       # (k, d): rows are right singular vectors
    singular_values: np.ndarray  # (k,)
    explained_variance: np.ndarray
    explained_variance_ratio: np.ndarray
    n_rows: int
    dim: int

    @property
    def k(self) -> int:
        return self.components.shape[0]


def dense_blocks(batches, dim: int, rows: int = CHUNK):
    """Dense (rows, dim) blocks of sparse rows in the Arrow columns ``indices`` and ``values``; nulls are empty rows."""
    for b in batches:
        idx, val = b.column("indices"), b.column("values")
        for start in range(0, b.num_rows, rows):
            i, v = idx.slice(start, rows), val.slice(start, rows)
            size = np.array([0 if n is None else n for n in i.value_lengths().to_pylist()], np.int64)
            block = np.zeros((len(i), dim))
            block[np.repeat(np.arange(len(i)), size), np.asarray(i.flatten(), np.int64)] = np.asarray(v.flatten(), float)
            yield block


def _strips(total: np.ndarray, part: int) -> pa.RecordBatch:
    step = max(1, STRIP_BYTES // (8 * total.shape[1]))
    cut = [total[a:a + step].tobytes() for a in range(0, len(total), step)]
    return pa.RecordBatch.from_arrays([pa.array([part] * len(cut), pa.int32()), pa.array(range(len(cut)), pa.int32()),
                                       pa.array(cut, pa.binary())], names=["part", "strip", "data"])


def summed(sparse_rows: DataFrame, shape: tuple[int, int], of_block, dim: int) -> np.ndarray:
    """The sum over all dense blocks of ``of_block(block)``, a matrix of ``shape``: a partial per task, summed in a tree."""
    def run(batches):
        from pyspark import TaskContext
        total = np.zeros(shape)
        for block in dense_blocks(batches, dim):
            total += of_block(block)
        yield _strips(total, TaskContext.get().partitionId())

    def add(table: pa.Table) -> pa.Table:
        data = table.column("data").to_pylist()
        total = np.frombuffer(data[0]).copy()
        for d in data[1:]:
            total += np.frombuffer(d)
        return pa.table({"part": table.column("part").slice(0, 1), "strip": table.column("strip").slice(0, 1),
                         "data": pa.array([total.tobytes()], pa.binary())})
    ddl = "part int, strip int, data binary"
    partials = cut_lineage(sparse_rows.select("indices", "values").coalesce(MAX_PARTIALS).mapInArrow(run, ddl))
    left = partials.agg(F.max("part")).first()[0]
    while left:   # partials are numbered from 0: FAN_IN neighbours become one
        partials = cut_lineage(partials.withColumn("part", F.expr(f"part div {FAN_IN}").cast("int"))
                               .groupBy("part", "strip").applyInArrow(add, ddl))
        left //= FAN_IN
    rows = partials.orderBy("strip").collect()   # one matrix, its size set by parameters
    return np.frombuffer(b"".join(bytes(r["data"]) for r in rows)).reshape(shape) if rows else np.zeros(shape)


def gramian(sparse_rows: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray, int]:
    """``(X^T X, column sums, rows)`` in one pass."""
    def of_block(x):
        x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
        return x.T @ x
    total = summed(sparse_rows, (dim + 1, dim + 1), of_block, dim)
    return total[:dim, :dim], total[dim, :dim], int(round(total[dim, dim]))


def _signed(V: np.ndarray) -> np.ndarray:
    signs = np.sign(V[np.arange(V.shape[0]), np.argmax(np.abs(V), axis=1)])
    return V * np.where(signs == 0, 1.0, signs)[:, None]


def _model(V, lam, sums, squares, n, dim) -> SvdModel:
    """``squares``: the sum of all squared entries."""
    mean = sums / max(n, 1)
    exp_var = lam / max(n, 1) - (V @ mean) ** 2
    full_var = float(squares / max(n, 1) - (mean ** 2).sum())
    ratio = exp_var / full_var if full_var > 0 else np.zeros_like(exp_var)
    return SvdModel(V, np.sqrt(lam), exp_var, ratio, n, dim)


def svd_fit(sparse_rows: DataFrame, dim: int, k: int = 100, method: str = "auto", passes: int = PASSES, seed: int = 42) -> SvdModel:
    """Top-``k`` singular triplets of the rows' matrix.  ``method``: "exact", "randomized", or "auto" (exact up to
    ``MAX_EXACT_DIM`` features).  Rows without entries count as rows."""
    if method == "auto":
        method = "exact" if dim <= MAX_EXACT_DIM else "randomized"
    k = min(k, dim)
    if method == "exact":
        G, sums, n = gramian(sparse_rows, dim)
        w, vecs = np.linalg.eigh(G)
        order = np.argsort(w)[::-1][:k]
        return _model(_signed(vecs[:, order].T), np.clip(w[order], 0.0, None), sums, np.trace(G), n, dim)
    spark = sparse_rows.sparkSession
    width = min(dim, k + OVERSAMPLE)
    if width < 2:
        return svd_fit(sparse_rows, dim, k, "exact")
    Q, _ = np.linalg.qr(np.random.RandomState(seed).standard_normal((dim, width)))
    sums = np.zeros(dim)
    for _ in range(max(1, passes)):
        shared = spark.sparkContext.broadcast(Q)

        def of_block(x, shared=shared):   # one column more: the column sums
            return np.concatenate([x.T @ (x @ shared.value), x.sum(axis=0)[:, None]], axis=1)
        total = summed(sparse_rows, (dim, width + 1), of_block, dim)
        shared.unpersist()
        sums = total[:, width]
        Q, _ = np.linalg.qr(total[:, :width])
    shared = spark.sparkContext.broadcast(Q)

    def inside(x):   # (XQ)^T (XQ), and in one row more the squares and the rows
        y, more = x @ shared.value, np.zeros((1, width))
        more[0, 0], more[0, -1] = (x * x).sum(), len(x)
        return np.concatenate([y.T @ y, more])
    small = summed(sparse_rows, (width + 1, width), inside, dim)
    w, vecs = np.linalg.eigh(small[:width])
    order = np.argsort(w)[::-1][:k]
    return _model(_signed((Q @ vecs[:, order]).T), np.clip(w[order], 0.0, None), sums, small[width, 0], int(round(small[width, -1])), dim)


def model_from_basis(basis: DataFrame, dim: int) -> SvdModel:
    """A model whose components are given: ``(component, feature_index, loading)``, absent loadings are zero.
    It projects and exports like a fitted one; its values are zero, see :func:`explained_variance`."""
    rows = basis.select("component", "feature_index", "loading").collect()   # k x d, bounded by parameters
    k = max((r["component"] for r in rows), default=-1) + 1
    V = np.zeros((k, dim))
    for r in rows:
        V[r["component"], r["feature_index"]] = r["loading"]
    return SvdModel(V, np.zeros(k), np.zeros(k), np.zeros(k), 0, dim)


def explained_variance(projected: DataFrame, svd_col: str = "svd") -> DataFrame:
    """``(component, explained_variance, explained_variance_ratio)`` measured on projected rows that still have their
    sparse columns: population variance of each component over that of all features, implicit zeros included."""
    n = projected.agg(F.count(F.lit(1))).scalar()
    entries = projected.select(F.inline(F.arrays_zip(F.col("indices").alias("i"), F.col("values").alias("v"))))
    per = entries.groupBy("i").agg(F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("q"))
    full = per.agg(F.sum(F.col("q") / n - (F.col("s") / n) * (F.col("s") / n))).scalar()
    comps = projected.select(F.posexplode(svd_col).alias("component", "x")).groupBy("component").agg(F.var_pop("x").alias("explained_variance"))
    return comps.select("component", "explained_variance",
                        F.coalesce(F.try_divide("explained_variance", full), F.lit(0.0)).alias("explained_variance_ratio"))


def svd_transform(sparse_rows: DataFrame, model: SvdModel, out_col: str = "svd") -> DataFrame:
    """Append the ``k``-dim projection ``x V^T`` as ``array<double>``."""
    spark = sparse_rows.sparkSession
    bV = spark.sparkContext.broadcast(np.ascontiguousarray(model.components.T))  # (d, k)
    k = model.k

    dim = model.dim
    chunk = 1024          # chunk x dim dense block: at most 16 MB for dim <= 2000

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def project(indices: pd.Series, values: pd.Series) -> pd.Series:
        Vt = bV.value
        n = len(indices)
        out = np.zeros((n, k))
        for start in range(0, n, chunk):
            idx_part = indices.iloc[start:start + chunk]
            val_part = values.iloc[start:start + chunk]
            lens = np.array([0 if i is None else len(i) for i in idx_part], dtype=np.int64)
            if lens.sum() == 0:
                continue
            cols = np.concatenate([np.asarray(i, dtype=np.int64) for i in idx_part if i is not None and len(i)])
            vals = np.concatenate([np.asarray(v, dtype=float) for v in val_part if v is not None and len(v)])
            rows = np.repeat(np.arange(len(lens)), lens)
            block = np.zeros((len(lens), dim))
            block[rows, cols] = vals
            out[start:start + len(lens)] = block @ Vt
        return pd.Series(list(out))

    return sparse_rows.withColumn(out_col, project(F.col("indices"), F.col("values")))


def components_frame(spark, model: SvdModel, vocabulary: DataFrame, n_components: int = 10) -> DataFrame:
    """``(component, feature_name, loading)`` for the first components."""
    n_components = min(n_components, model.k)
    rows = [(c, j, float(model.components[c, j])) for c in range(n_components) for j in range(model.dim)]
    comp = spark.createDataFrame(rows, "component int, feature_index int, loading double")
    return comp.join(F.broadcast(vocabulary.select("feature_name", "feature_index")), "feature_index") \
        .select("component", "feature_name", "loading")


def singular_values_frame(spark, model: SvdModel) -> DataFrame:
    rows = [(i, float(s), float(v), float(r)) for i, (s, v, r) in
            enumerate(zip(model.singular_values, model.explained_variance, model.explained_variance_ratio))]
    return spark.createDataFrame(rows, "component int, singular_value double, explained_variance double, "
                                       "explained_variance_ratio double")
