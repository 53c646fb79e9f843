"""Quality by nearest-neighbour voting in a latent-semantic space.

TF-IDF over hashed character n-grams is projected to a few latent directions (truncated SVD of a bounded sample),
next to them stand the shares of words that repeat the word before, of capitals, of symbols and of short lines, which
n-gram counts can't tell.  The labelled sample's vectors, bounded by a parameter, are broadcast; every document is compared with all of them
in exact cosine blocks, and its nearest neighbours vote with weights that fall with their distance."""

from __future__ import annotations

import operator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revsift.llm import common as C
from revsift.llm import char_features as CF

BITS, NGRAM = 12, 3
#: Bound of the labelled sample (its vectors are broadcast) and of the part that fixes the latent directions.
MAX_LABELLED, MAX_SVD = 4000, 2000
DIMENSIONS, NEIGHBOURS, POWER = 64, 15, 6
#: Weight of the style shares beside the latent coordinates, whose length is at most 1.
STYLE_WEIGHT = 1.5
ACCEPT = 0.7
#: Rows whose dense TF-IDF vectors (16 KB each) are held at once.
ROWS = 256


def latent(vectors: np.ndarray, k: int, seed: int = 11) -> np.ndarray:
    """Right singular vectors (features, k) of the rows, by randomised range finding with two power steps."""
    k = min(k, *vectors.shape)
    q = np.random.default_rng(seed).standard_normal((vectors.shape[1], k + 8)).astype(np.float32)
    for _ in range(3):
        q, _ = np.linalg.qr(vectors.T @ (vectors @ q))
    _, _, vt = np.linalg.svd(vectors @ q, full_matrices=False)
    return (q @ vt.T)[:, :k].astype(np.float32)


def style(text: str | None) -> list[float]:
    """Shares in 0..1: words equal to the word before, upper-case words of two letters or more, symbol characters."""
    words = (text or "").split()
    if not words:
        return [0.0, 0.0, 0.0]
    symbols = sum(map(text.count, "#*$%&|<>!{}"))
    return [sum(map(operator.eq, words, words[1:])) / len(words),
            sum(len(w) > 1 and w.isupper() for w in words) / len(words),
            min(1.0, symbols / len(words))]


def place(x: np.ndarray, texts: list, basis: np.ndarray) -> np.ndarray:
    """Unit vectors of the texts: latent coordinates of their TF-IDF rows, then the weighted style shares."""
    shares = np.array([style(t) for t in texts], np.float32).reshape(len(texts), 3)
    return _unit(np.concatenate([x @ basis, STYLE_WEIGHT * shares], axis=1))


def _unit(v: np.ndarray) -> np.ndarray:
    norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return np.divide(v, norm, out=np.zeros_like(v), where=norm > 0)




def fit(docs: DataFrame, labels: DataFrame, corpus: DataFrame | None = None, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality") -> dict:
    """Model from the documents that carry a label (0 or 1).  Document frequencies cover every text of ``corpus``
    (default: ``docs``).  A document labelled twice counts with its larger label."""
    feats = CF.CharNgrams(BITS, NGRAM, fold=False)
    weight = CF.idf(*CF.document_frequency(corpus if corpus is not None else docs, text_col, feats))
    t = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    l = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
         .where("doc_id is not null and y is not null").groupBy("doc_id").agg(F.max("y").alias("y")))
    ids = t.select("doc_id").distinct().join(l, "doc_id")
    pick = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    rows = CF.sparse_rows(t.join(F.broadcast(pick), "doc_id"), feats, "doc_id", "y", extra=style)
    rows = sorted(rows, key=lambda r: (r["doc_id"], r["at"]))[:MAX_LABELLED]
    x = np.array([CF.weighted(CF.dense(r, BITS), weight) for r in rows], np.float32).reshape(len(rows), 1 << BITS)
    y = np.array([r["y"] for r in rows], np.float32)
    some = np.random.default_rng(5).permutation(len(x))[:MAX_SVD]
    basis = latent(x[np.sort(some)], DIMENSIONS) if len(x) else np.zeros((1 << BITS, 1), np.float32)
    shares = np.array([r["extra"] for r in rows], np.float32).reshape(len(rows), 3)
    return {"idf": weight, "basis": basis, "y": y,
            "vectors": _unit(np.concatenate([x @ basis, STYLE_WEIGHT * shares], axis=1)),
            "prior": float(y.mean()) if len(y) else 0.5}


def vote(vectors: np.ndarray, model: dict) -> np.ndarray:
    """Score in 0..1 per unit vector: the similarity-weighted share of label 1 among its nearest neighbours."""
    known, y = model["vectors"], model["y"]
    if not len(y):
        return np.full(len(vectors), model["prior"])
    out, k = np.empty(len(vectors)), min(NEIGHBOURS, len(y))
    for a in range(0, len(vectors), ROWS):
        cos = vectors[a:a + ROWS] @ known.T
        at = np.argpartition(-cos, k - 1, axis=1)[:, :k]
        w = np.maximum(np.take_along_axis(cos, at, 1).astype(np.float64), 0.0) ** POWER
        total = w.sum(axis=1)
        share = (w * y[at]).sum(axis=1)
        out[a:a + ROWS] = np.where(total > 1e-9, share / np.maximum(total, 1e-9), model["prior"])
    return np.clip(out, 0.0, 1.0)


def score(df: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", keep=()) -> DataFrame:
    """One row per input row: ``doc_id, score, predicted`` and the columns named in ``keep``.

    A null or empty text has no direction and gets the share of label 1 among the labelled sample; without labels
    every score is 0.5.  Repeated rows and null ids give a row each; other columns are not read; an empty table
    gives an empty result."""
    spark = C.prepare(df.sparkSession)
    feats = CF.CharNgrams(BITS, NGRAM, fold=False)
    shared = spark.sparkContext.broadcast(model)
    extra, ddl = C.carried(df, keep)
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *extra)
    return (rows.mapInArrow(C.trimmed(_score(shared, feats, keep)), f"doc_id long, score double{ddl}")
            .withColumn("predicted", F.when(F.col("score") >= ACCEPT, 1).otherwise(0)))


def _score(shared, feats: CF.CharNgrams, keep):
    def run(batches):
        m = shared.value
        for b in batches:
            s, x = np.empty(b.num_rows), np.empty((min(ROWS, b.num_rows), 1 << BITS), np.float32)
            for a in range(0, len(s), ROWS):
                texts = b.column("text").slice(a, ROWS).to_pylist()
                for i, t in enumerate(texts):
                    x[i] = CF.weighted(feats.counts(t), m["idf"])
                s[a:a + ROWS] = vote(place(x[:len(texts)], texts, m["basis"]), m)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s, pa.float64()), *b.columns[2:]],
                                             names=["doc_id", "score", *keep])
    return run


def quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep=()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row and the columns named in ``keep``; labels are learned only from rows that are not held out
    (crc32 of the id as text modulo 4 is 2)."""
    C.prepare(df.sparkSession)
    held = F.coalesce(C.crc_mod(id_col, 4) == 2, F.lit(False))
    model = fit(df.where(~held), labels, df, id_col, text_col)
    keep = [c for c in keep if c != "doc_id"]
    return (score(df, model, id_col, text_col, keep)
            .select("doc_id", F.coalesce(C.crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
                    "score", "predicted", *keep))
