"""TF-IDF and SVD properties on the smallest driver table."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from revsift.operators import svd as SV
from revsift.operators import tfidf as TF
from revsift.sources import fixtures as FX
from revsift.functions.text import clean_text

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def corpus(spark):
    d = FX.read_table(spark, SF_SMALL, "documents")
    return d.select("doc_id", clean_text(F.col("text")).alias("text_clean"))


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["x"],), ([],)], "t array<string>")
    got = [r[0] for r in df.select(TF.ngrams_1_2(F.col("t"))).collect()]
    assert got == [["a", "b", "c", "a b", "b c"], ["x"], []]


def test_rows_unit_norm_and_svd_properties(spark, corpus):
    vocab, long = TF.tfidf_fit_transform_long(corpus, "doc_id", max_features=300, min_df=2)
    norms = long.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("n")).collect()
    assert all(abs(r["n"] - 1.0) < 1e-9 for r in norms)
    d = vocab.count()
    assert d <= 300
    idx = sorted(r["feature_index"] for r in vocab.collect())
    assert idx == list(range(d))
    sparse = TF.tfidf_transform(corpus, vocab, "doc_id")
    a = {(r["doc_id"], i): round(x, 9) for r in sparse.collect() for i, x in zip(r["indices"], r["values"])}
    b = {(r["doc_id"], r["feature_index"]): round(r["weight"], 9) for r in long.collect()}
    assert a == b
    plan = TF.tfidf_columns(corpus, vocab)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan  # scoring shuffles nothing
    model = SV.svd_fit(sparse, d, 10)
    V = model.components
    assert np.allclose(V @ V.T, np.eye(10), atol=1e-8)
    assert np.all(np.diff(model.singular_values) <= 1e-9)
    proj = SV.svd_transform(sparse, model).select("indices", "values", "svd").collect()
    assert all(len(r["svd"]) == 10 for r in proj)
    for r in proj[:50]:
        x = np.zeros(d)
        x[np.asarray(r["indices"], dtype=int)] = r["values"]
        assert np.allclose(np.asarray(r["svd"]), V @ x, atol=1e-10)


def _sparse(spark, X):
    rows = [([int(j) for j in np.flatnonzero(r)], [float(v) for v in r[np.flatnonzero(r)]]) for r in X]
    return spark.createDataFrame(rows, "indices array<int>, values array<double>")


def test_exact_svd_equals_dense(spark, monkeypatch):
    """Many partials and strips: the tree sum gives the Gramian, singular values and variances of the dense matrix."""
    rng = np.random.RandomState(4)
    X = rng.rand(230, 17) * (rng.rand(230, 17) < 0.3)
    X[5] = 0.0
    monkeypatch.setattr(SV, "STRIP_BYTES", 400)
    sparse = _sparse(spark, X).repartition(20)
    G, sums, n = SV.gramian(sparse, 17)
    assert np.allclose(G, X.T @ X, atol=1e-12) and np.allclose(sums, X.sum(axis=0)) and n == 230
    model = SV.svd_fit(sparse, 17, 6)
    u, s, vt = np.linalg.svd(X, full_matrices=False)
    assert np.allclose(model.singular_values, s[:6], atol=1e-8)
    assert np.allclose(np.abs(model.components @ vt[:6].T), np.eye(6), atol=1e-6)
    assert np.allclose(model.explained_variance, (X @ model.components.T).var(axis=0), atol=1e-10)
    assert np.allclose(model.explained_variance_ratio, model.explained_variance / X.var(axis=0).sum(), atol=1e-10)
    measured = {r.component: r for r in SV.explained_variance(SV.svd_transform(sparse, model)).collect()}
    assert np.allclose([measured[c].explained_variance_ratio for c in range(6)], model.explained_variance_ratio, atol=1e-10)


def test_randomized_svd_finds_the_leading_values(spark):
    rng = np.random.RandomState(5)
    X = (rng.randn(300, 8) * [50, 30, 20, 12, 8, 5, 1, 1]) @ np.linalg.qr(rng.randn(40, 8))[0].T + 0.01 * rng.randn(300, 40)
    sparse = _sparse(spark, X).repartition(6)
    exact, fast = SV.svd_fit(sparse, 40, 6, "exact"), SV.svd_fit(sparse, 40, 6, "randomized")
    assert np.allclose(fast.singular_values, exact.singular_values, rtol=1e-8)
    assert np.allclose(fast.components, exact.components, atol=1e-6)
    assert np.allclose(fast.explained_variance_ratio, exact.explained_variance_ratio, atol=1e-8) and fast.n_rows == 300


def test_svd_of_no_rows_and_of_one_feature(spark):
    X = np.array([[2.0], [0.0], [1.0]])
    for method in ("exact", "randomized"):
        assert np.allclose(SV.svd_fit(_sparse(spark, X), 1, 5, method).singular_values, [5 ** 0.5])
    empty = _sparse(spark, X).where("1 = 0")
    assert SV.svd_fit(empty, 3, 2).n_rows == 0
