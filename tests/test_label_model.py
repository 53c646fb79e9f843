"""Label model: ties, posterior properties and recovery on simulated votes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from revsift.operators import label_model as LM
from revsift.operators import labeling as LB


def test_tie_break_abstains(spark):
    rows = [(0.25, 0.25, 0.25, 0.25), (0.4, 0.4, 0.1, 0.1), (0.5, 0.3, 0.1, 0.1)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in LM.PROB_COLUMNS))
    got = [r["weak_label"] for r in LM.label_model_predict(df).collect()]
    assert got == [-1, -1, 0]


def _simulate(n=4000, m=6, k=4, seed=7):
    rng = np.random.RandomState(seed)
    y = rng.randint(0, k, size=n)
    acc = np.array([0.9, 0.85, 0.8, 0.75, 0.7, 0.65])[:m]
    cov = 0.6
    L = -np.ones((n, m), dtype=int)
    for j in range(m):
        vote = rng.rand(n) < cov
        right = rng.rand(n) < acc[j]
        wrong = (y + rng.randint(1, k, size=n)) % k
        L[:, j] = np.where(vote, np.where(right, y, wrong), -1)
    return L, y


@pytest.fixture(scope="module")
def simulated(spark):
    L, y = _simulate()
    rows = [(i, [int(v) for v in L[i]], int(y[i])) for i in range(len(y))]
    return spark.createDataFrame(rows, "id long, votes array<int>, y int"), L, y


def test_overlap_matrix_matches_numpy(spark, simulated):
    df, L, _ = simulated
    m, k = L.shape[1], 4
    O = LM.overlap_to_numpy(LB.vote_overlap_matrix(df), m, k)
    onehot = np.zeros((L.shape[0], m * k))
    for j in range(m):
        for c in range(k):
            onehot[:, j * k + c] = L[:, j] == c
    assert np.allclose(O, onehot.T @ onehot / L.shape[0])


def test_posteriors_sum_to_one_and_recover_labels(spark, simulated):
    df, L, y = simulated
    params = LM.label_model_fit(df, L.shape[1], n_epochs=500)
    scored = LM.weak_labels(df, params)
    s = scored.select(sum(F.col(c) for c in LM.PROB_COLUMNS).alias("s")).agg(F.min("s"), F.max("s")).first()
    assert abs(s[0] - 1) < 1e-9 and abs(s[1] - 1) < 1e-9
    acc = scored.where("weak_label <> -1").agg(F.avg((F.col("weak_label") == F.col("y")).cast("double"))).first()[0]
    assert acc > 0.8
    # beats majority vote (ties -> abstain) on the share of all rows labelled correctly
    mv = []
    for row in L:
        v = [x for x in row if x >= 0]
        c = np.bincount(v, minlength=4) if v else np.zeros(4)
        mv.append(int(c.argmax()) if v and (c == c.max()).sum() == 1 else -1)
    mv_correct = float((np.array(mv) == y).mean())
    lm_correct = scored.agg(F.avg((F.col("weak_label") == F.col("y")).cast("double"))).first()[0]
    assert lm_correct > mv_correct


def test_all_abstain_row_gets_prior(spark):
    params = LM.LabelModelParams(mu=np.full((8, 4), 0.5), prior=np.full(4, 0.25), m=2)
    df = spark.createDataFrame([([-1, -1],)], "votes array<int>")
    row = LM.weak_labels(df, params).first()
    assert all(abs(row[c] - 0.25) < 1e-12 for c in LM.PROB_COLUMNS)
    assert row["weak_label"] == -1 and abs(row["confidence"] - 0.25) < 1e-12


def test_lf_summary_definitions(spark):
    rows = [([0, 0, -1],), ([0, 1, -1],), ([-1, -1, 2],), ([-1, -1, -1],)]
    df = spark.createDataFrame(rows, "votes array<int>")
    out = {r["j"]: r for r in LB.lf_summary(df, lfs=[_lf(0), _lf(1), _lf(2)]).collect()}
    assert out[0]["polarity"] == "0" and out[1]["polarity"] == "0,1"
    assert out[0]["coverage"] == 0.5 and out[0]["overlaps"] == 0.5 and out[0]["conflicts"] == 0.25
    assert out[2]["overlaps"] == 0.0


def _lf(i):
    from revsift.functions.lfs import LabelingFunction
    return LabelingFunction(f"lf{i}", (0,), lambda: F.lit(-1))


def test_permuting_lfs_permutes_parameters(simulated):
    _, L, _ = simulated
    m, k = L.shape[1], 4

    def moments(M):
        onehot = np.zeros((M.shape[0], m * k))
        for j in range(m):
            for c in range(k):
                onehot[:, j * k + c] = M[:, j] == c
        return onehot.T @ onehot / M.shape[0]

    perm = [3, 0, 5, 1, 4, 2]
    a = LM.fit_label_model(moments(L), m, n_epochs=200)
    b = LM.fit_label_model(moments(L[:, perm]), m, n_epochs=200)
    for new_j, old_j in enumerate(perm):
        assert np.allclose(b.mu[new_j * k:(new_j + 1) * k], a.mu[old_j * k:(old_j + 1) * k], atol=1e-9)


def test_triplet_start_recovers_accuracies(spark):
    """Rules that err independently: the closed form finds P(vote | class) of every rule, without an epoch."""
    rng = np.random.RandomState(7)
    n, m, k = 40_000, 8, 4
    y = rng.randint(k, size=n)
    right, speaks = rng.uniform(0.5, 0.9, m), rng.uniform(0.5, 0.9, m)
    O = np.zeros((m * k, m * k))
    onehot = np.zeros((n, m * k))
    for j in range(m):
        wrong = (y + rng.randint(1, k, size=n)) % k
        vote = np.where(rng.rand(n) < right[j], y, wrong)
        said = rng.rand(n) < speaks[j]
        onehot[np.flatnonzero(said), j * k + vote[said]] = 1
    O = onehot.T @ onehot / n
    mu = LM.triplet_start(O, m, k).mu
    for j in range(m):
        for c in range(k):
            for cls in range(k):
                want = speaks[j] * (right[j] if c == cls else (1 - right[j]) / (k - 1))
                assert abs(mu[j * k + c, cls] - want) < 0.05
    # a rule that always says the same has no covariance: it starts at the given precision
    O2 = np.zeros((m * k + k, m * k + k))
    both = np.concatenate([onehot, np.tile([1.0, 0, 0, 0], (n, 1))], axis=1)
    O2 = both.T @ both / n
    last = LM.triplet_start(O2, m + 1, k).mu[m * k:]
    assert last[0][0] == 1.0 and np.allclose(last[1:], 0.0)
    fitted = LM.fit_label_model(O, m, k, n_epochs=50, start="triplets")
    assert np.abs(fitted.mu - mu).max() < 0.1
