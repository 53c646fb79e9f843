"""Label model: combine LF votes into class posteriors.

Model (Ratner et al., "Training Complex Models with Multi-Task Weak
Supervision", AAAI 2019): conditionally independent LFs with parameters
``mu[j, c, y] = P(LF j votes c | Y = y)`` and a class prior ``p``.  The
parameters are fitted to the second-moment matrix ``O`` of the one-hot
votes (``vote_overlap_matrix``), minimising
``|| mask * (O - mu diag(p) mu^T) ||^2 + || mu diag(p) 1 - diag(O) ||^2``
with off-diagonal LF blocks in the mask.

Spark computes ``O`` (a ``(m*k) x (m*k)`` table, 92 x 92 for 23 LFs); the
fit itself runs on that constant-size matrix on the driver.  Scoring is a
pure projection: the fitted ``log mu`` are literal arrays, so each row's
posterior is 23 array lookups per class - no join, no shuffle, and
nothing that grows with the data is ever collected.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import ABSTAIN, CARDINALITY, CLASSES
from ..functions.text import computed_once
from .labeling import vote_overlap_matrix

PROB_COLUMNS = ["prob_genuine", "prob_promotion", "prob_irrelevant", "prob_rant"]


@dataclass
class LabelModelParams:
    mu: np.ndarray                        # (m*k, k): row j*k+c, column y
    prior: np.ndarray                     # (k,)
    m: int
    k: int = CARDINALITY
    history: list = field(default_factory=list)

    def clipped_log_mu(self, lo: float = 0.01, hi: float = 0.99) -> np.ndarray:
        return np.log(np.clip(self.mu, lo, hi))

    def to_rows(self):
        """Long form ``(j, vote, y, mu)`` for persisting / inspection."""
        out = []
        for j in range(self.m):
            for c in range(self.k):
                for y in range(self.k):
                    out.append((j, c, y, float(self.mu[j * self.k + c, y])))
        return out


def overlap_to_numpy(overlap: DataFrame, m: int, k: int = CARDINALITY) -> np.ndarray:
    """Collect the (m*k)^2-bounded moment table into a dense matrix."""
    d = m * k
    O = np.zeros((d, d))
    for r in overlap.collect():
        O[r["a"], r["b"]] = r["value"]
    return O


def init_mu(O: np.ndarray, m: int, k: int, prior: np.ndarray, prec_init: float = 0.7) -> np.ndarray:
    """Start each LF at ``prec_init`` precision: ``mu[j,y,y] = cov(j,y) *
    prec_init / p_y`` (clamped to [0,1]), zero elsewhere."""
    lps = np.diag(O)
    mu = np.zeros((m * k, k))
    for j in range(m):
        for y in range(k):
            idx = j * k + y
            mu[idx, y] = min(max(lps[idx] * prec_init / prior[y], 0.0), 1.0)
    return mu


def _mask(m: int, k: int) -> np.ndarray:
    mask = np.ones((m * k, m * k))
    for j in range(m):
        mask[j * k:(j + 1) * k, j * k:(j + 1) * k] = 0.0
    return mask


def _break_permutation_symmetry(mu: np.ndarray, prior: np.ndarray, m: int, k: int) -> np.ndarray:
    """Among classes with equal prior, pick the column permutation that
    maximises the summed diagonal of the per-LF blocks (LF polarity anchors
    the class identity)."""
    probs_sum = sum(mu[j * k:(j + 1) * k] for j in range(m)) @ np.diag(prior)
    groups: dict[float, list[int]] = {}
    for i, p in enumerate(prior):
        groups.setdefault(round(float(p), 3), []).append(i)
    Z = np.zeros((k, k))
    for g in groups.values():
        best, best_perm = -math.inf, None
        for perm in itertools.permutations(range(len(g))):
            s = sum(probs_sum[g[perm[i]], g[i]] for i in range(len(g)))
            if s > best:
                best, best_perm = s, perm
        for i in range(len(g)):
            Z[g[i], g[best_perm[i]]] = 1.0
    return mu @ Z


#: Least covariance, in absolute value, that a triplet may divide by or multiply.
TRIPLET_MIN_COV = 1e-6


def triplet_start(O: np.ndarray, m: int, k: int = CARDINALITY, class_balance=None, prec_init: float = 0.7) -> LabelModelParams:
    """Closed-form parameters from triplets of rules, without any epoch.

    For class y let x_j say that rule j votes y.  If the rules are independent given whether the class is y, then
    ``cov(x_i, x_j) = p (1 - p) d_i d_j`` with ``d_j = P(x_j | y) - P(x_j | not y)``, so every pair (i, k) of other
    rules gives ``d_j ** 2 p (1 - p) = cov(ij) cov(jk) / cov(ik)``.  The median over all pairs whose three covariances
    are large enough and whose quotient is positive is taken, with d_j positive (rules beat chance), and
    ``P(x_j | y) = P(x_j) + (1 - p) d_j``, ``P(x_j | not y) = P(x_j) - p d_j``, cut to 0..1.  The table is general: a
    rule has a probability for votes of every class under every class.  A rule and class without a usable triplet start
    at ``prec_init`` precision: ``P(x_j | y) = P(x_j) prec_init / p``, the rest of its votes spread over the others."""
    prior = np.full(k, 1.0 / k) if class_balance is None else np.asarray(class_balance, dtype=float)
    mu = np.zeros((m * k, k))
    for y in range(k):
        at = np.arange(m) * k + y
        mean = O[at, at]
        cov = O[np.ix_(at, at)] - np.outer(mean, mean)
        usable = np.abs(cov) > TRIPLET_MIN_COV
        np.fill_diagonal(usable, False)
        p = prior[y]
        for j in range(m):
            i, l = np.nonzero(np.triu(usable & usable[j][:, None] & usable[j][None, :], 1))
            q = cov[j, i] * cov[j, l] / cov[i, l]
            q = q[q > 0]
            if len(q):
                d = np.sqrt(np.median(q) / (p * (1 - p)))
                yes, no = mean[j] + (1 - p) * d, mean[j] - p * d
            else:
                yes = mean[j] * prec_init / p
                no = (mean[j] - p * min(yes, 1.0)) / (1 - p)
            mu[at[j]] = min(max(no, 0.0), 1.0)
            mu[at[j], y] = min(max(yes, 0.0), 1.0)
    return LabelModelParams(mu=mu, prior=prior, m=m, k=k)


def fit_label_model(O: np.ndarray, m: int, k: int = CARDINALITY, n_epochs: int = 500, lr: float = 0.01,
                    momentum: float = 0.9, l2: float = 0.0, seed: int = 123, prec_init: float = 0.7,
                    class_balance=None, log_freq: int = 100, start: str = "precision") -> LabelModelParams:
    """Full-batch SGD with momentum on the moment-matching objective, from ``start``: "precision" (every rule at
    ``prec_init`` precision, scaled by a random draw) or "triplets" (:func:`triplet_start`)."""
    prior = np.full(k, 1.0 / k) if class_balance is None else np.asarray(class_balance, dtype=float)
    P = np.diag(prior)
    rng = np.random.RandomState(seed)
    if start == "triplets":
        mu0 = triplet_start(O, m, k, prior, prec_init).mu
        mu = mu0.copy()
    else:
        mu0 = init_mu(O, m, k, prior, prec_init)
        mu = mu0 * rng.random_sample()
    mask = _mask(m, k)
    dO = np.diag(O)
    vel = np.zeros_like(mu)
    hist = []
    for epoch in range(n_epochs):
        R = mask * (mu @ P @ mu.T - O)
        s = (mu @ P).sum(axis=1) - dO
        grad = 4.0 * R @ mu @ P + 2.0 * np.outer(s, prior) + 2.0 * l2 * (mu - mu0)
        vel = momentum * vel + grad
        mu = mu - lr * vel
        if log_freq and (epoch % log_freq == 0 or epoch == n_epochs - 1):
            hist.append((epoch, float((R ** 2).sum() + (s ** 2).sum())))
    mu = _break_permutation_symmetry(mu, prior, m, k)
    return LabelModelParams(mu=mu, prior=prior, m=m, k=k, history=hist)


def label_model_fit(votes: DataFrame, m: int, **kw) -> LabelModelParams:
    O = overlap_to_numpy(vote_overlap_matrix(votes), m)
    return fit_label_model(O, m, **kw)


def params_frame(spark, params: LabelModelParams) -> DataFrame:
    return spark.createDataFrame(params.to_rows(), "j int, vote int, y int, mu double")

# ------------------------------------------------------------------ scoring


def _class_score(votes: Column, log_mu: np.ndarray, log_prior: float, m: int, k: int, y: int) -> Column:
    """log p_y + sum_j log mu[j, vote_j, y] (abstain contributes 0)."""
    total = F.lit(float(log_prior))
    for j in range(m):
        table = F.array(F.lit(0.0), *[F.lit(float(log_mu[j * k + c, y])) for c in range(k)])
        total = total + F.element_at(table, votes[j] + 2)
    return total


def label_model_proba(df: DataFrame, params: LabelModelParams, votes_col: str = "votes",
                      prob_cols=PROB_COLUMNS) -> DataFrame:
    """Posterior per class as columns (softmax of the class scores)."""
    log_mu = params.clipped_log_mu()
    log_p = np.log(params.prior)
    v = F.col(votes_col)
    scores = [_class_score(v, log_mu, log_p[y], params.m, params.k, y) for y in range(params.k)]
    df = df.select("*", *[s.alias(f"_s{y}") for y, s in enumerate(scores)])
    mx = F.greatest(*[F.col(f"_s{y}") for y in range(params.k)])
    df = df.select("*", *[F.exp(F.col(f"_s{y}") - mx).alias(f"_e{y}") for y in range(params.k)])
    z = sum((F.col(f"_e{y}") for y in range(params.k)), F.lit(0.0))
    out = df.select("*", *[(F.col(f"_e{y}") / z).alias(prob_cols[y]) for y in range(params.k)])
    return out.drop(*[f"_s{y}" for y in range(params.k)], *[f"_e{y}" for y in range(params.k)])


def label_model_predict(df: DataFrame, prob_cols=PROB_COLUMNS, tol: float = 1e-5) -> DataFrame:
    """Hard label = argmax; ties within ``tol`` -> ABSTAIN; ``confidence`` = max probability."""
    probs = F.array(*[F.col(c) for c in prob_cols])
    mx = F.array_max(probs)
    n_top = F.size(F.filter(probs, lambda p: F.abs(p - mx) < tol))
    first = F.array_position(F.transform(probs, lambda p: F.abs(p - mx) < tol), True) - 1
    # filters on label or confidence read the value: put in their place, the nested class scores would be written out
    # thousands of times in one expression
    return computed_once(df, weak_label=F.when(n_top == 1, first.cast("int")).otherwise(F.lit(ABSTAIN)),
                         confidence=F.greatest(*[F.col(c) for c in prob_cols]))


def weak_labels(df: DataFrame, params: LabelModelParams, votes_col: str = "votes") -> DataFrame:
    return label_model_predict(label_model_proba(df, params, votes_col))


assert len(CLASSES) == len(PROB_COLUMNS)
