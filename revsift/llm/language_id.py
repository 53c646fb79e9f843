"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Trained by follow-the-regularised-leader with elastic-net penalties, one coordinate at a time with its own learning
rate; a temperature fitted on examples kept out of the training calibrates the probabilities.  Document frequencies
cover every training text; only the regression sees a bounded sample."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revsift.llm import common as C
from revsift.llm import char_features as CF

BITS, NGRAM = 14, 3
#: Bound of the sample that the regression is fitted on: texts per language.
MAX_PER_LANGUAGE = 500
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
UNKNOWN = "und"


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], n_features: int, n_classes: int,
             seed: int = 7) -> np.ndarray:
    """rows of (feature index, value, class) -> weights (n_features + 1, n_classes), the last row the bias."""
    z = np.zeros((n_features + 1, n_classes))
    g2 = np.zeros_like(z)
    rng = np.random.default_rng(seed)

    def weights(z, g2):
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(g2)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    for _ in range(EPOCHS):
        for r in rng.permutation(len(rows)):
            at, x, y = rows[r]
            at, x = np.append(at, n_features), np.append(x, 1.0)
            zi, gi = z[at], g2[at]
            w = weights(zi, gi)
            p = softmax((x @ w)[None, :])[0]
            p[y] -= 1.0
            g = x[:, None] * p
            g_new = gi + g * g
            z[at] = zi + g - (np.sqrt(g_new) - np.sqrt(gi)) / ALPHA * w
            g2[at] = g_new
    return weights(z, g2)


def softmax(a: np.ndarray) -> np.ndarray:
    e = np.exp(a - a.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """Temperature of least negative log likelihood, by golden section on its logarithm."""
    if not len(y):
        return 1.0

    def loss(t):
        return -np.log(softmax(logits / np.exp(t))[np.arange(len(y)), y] + 1e-12).mean()
    a, b, g = -4.0, 3.0, (np.sqrt(5) - 1) / 2
    for _ in range(40):
        c, d = b - g * (b - a), a + g * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def fit(train: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict:
    """Model from the rows of ``train`` with a text and a language; an empty model if there are none."""
    feats = CF.CharNgrams(BITS, NGRAM, fold=True)
    t = (train.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      F.col(lang_col).cast("string").alias("lang")).where("lang is not null and text is not null"))
    counts, n = CF.document_frequency(t, "text", feats)
    weight = CF.idf(counts, n)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    # the sample's ids first, without the texts; a row count per language bounds it
    pick = (t.select("doc_id", "lang").withColumn("i", F.row_number().over(order))
            .where(F.col("i") <= MAX_PER_LANGUAGE).select("doc_id", "lang").distinct())
    rows = CF.sparse_rows(t.join(F.broadcast(pick), ["doc_id", "lang"]), feats, "doc_id", "lang")
    rows = sorted(rows, key=lambda r: (r["lang"], r["doc_id"] is None, r["doc_id"], r["at"]))
    langs = sorted({r["lang"] for r in rows})
    examples = []
    for r in rows:
        v = CF.weighted(CF.dense(r, BITS), weight)
        at = np.flatnonzero(v)
        examples.append((at, v[at].astype(np.float64), langs.index(r["lang"])))
    kept_out = [e for i, e in enumerate(examples) if i % 5 == 0]
    learn = [e for i, e in enumerate(examples) if i % 5]
    w = fit_ftrl(learn or examples, 1 << BITS, max(1, len(langs)))
    logits = np.array([x @ w[at] + w[-1] for at, x, _ in kept_out]).reshape(len(kept_out), w.shape[1])
    t_ = fit_temperature(logits, np.array([y for _, _, y in kept_out], int)) if len(langs) > 1 else 1.0
    return {"langs": langs, "w": w.astype(np.float32), "idf": weight, "temperature": t_}


def predict(df: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", keep=()) -> DataFrame:
    """One row per input row: ``doc_id, lang_pred, score`` and the columns named in ``keep``.

    A null text or one without letters (a model without languages too) gives ``und`` and 0.0; ties go to the
    alphabetically first language; repeated rows and null ids give a row each; other columns are not read; an
    empty table gives an empty result."""
    spark = C.prepare(df.sparkSession)
    feats = CF.CharNgrams(BITS, NGRAM, fold=True)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        langs, w, idf, temp = m["langs"], m["w"], m["idf"], m["temperature"]
        for b in batches:
            texts = b.column("text").to_pylist()
            known = np.array([bool(langs) and t is not None and any(map(str.isalpha, t)) for t in texts], bool)
            x = np.zeros((len(texts), 1 << BITS), np.float32)
            for i in np.flatnonzero(known):
                x[i] = CF.weighted(feats.counts(texts[i]), idf)
            if known.any():
                p = softmax((x @ w[:-1] + w[-1]).astype(np.float64) / temp)
                best = p.argmax(axis=1)
                pred = [langs[k] if ok else UNKNOWN for k, ok in zip(best, known)]
                score = np.where(known, p[np.arange(len(p)), best], 0.0)
            else:
                pred, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(pred, pa.string()), pa.array(score), *b.columns[2:]],
                                             names=["doc_id", "lang_pred", "score", *keep])
    extra, ddl = C.carried(df, keep)
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *extra)
    return rows.mapInArrow(C.trimmed(run), f"doc_id long, lang_pred string, score double{ddl}")


def language_id(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                keep=()) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row and the columns named in ``keep``, learning from rows that are not held out
    (crc32 of the id as text modulo 4 is 2; a null id is never held out)."""
    C.prepare(df.sparkSession)
    held = F.coalesce(C.crc_mod(id_col, 4) == 2, F.lit(False))
    model = fit(df.where(~held), id_col, text_col, lang_col)
    out = predict(df, model, id_col, text_col, [c for c in keep if c != "doc_id"])
    return out.select("doc_id", F.coalesce(C.crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
                      "lang_pred", "score", *[c for c in keep if c != "doc_id"])
