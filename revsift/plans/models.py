"""Fitted artefacts: persistence and scoring.

The vocabulary and the SVD components are small tables (bounded by
``max_features`` and ``n_components``) written as Parquet, and so is the
forest, a row a tree.  Everything is written under one directory, which on
a cluster must be shared storage (by default a folder under the session's
``spark.checkpoint.dir``)."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import forest as RF
from ..operators import svd as SV
from ..operators import tfidf as TF
from ..operators import training as TR
from ..operators.profile import label_name
from ..session import ensure_checkpoint_dir


@dataclass
class Artifacts:
    vocabulary: DataFrame
    svd: SV.SvdModel
    forest: RF.Forest


def shared_dir(spark: SparkSession, name: str) -> str:
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + f"/revsift-{name}-{uuid.uuid4().hex[:8]}"


def model_save(art: Artifacts, path: str) -> str:
    spark = art.vocabulary.sparkSession
    art.vocabulary.select("feature_name", "feature_index", "df", "idf").write.mode("overwrite").parquet(
        path + "/vocabulary")
    V = art.svd.components
    comp = spark.createDataFrame(
        [(c, j, float(V[c, j])) for c in range(V.shape[0]) for j in range(V.shape[1]) if V[c, j] != 0.0],
        "component int, feature_index int, loading double")
    comp.write.mode("overwrite").parquet(path + "/svd_components")
    SV.singular_values_frame(spark, art.svd).withColumn("n_rows", F.lit(art.svd.n_rows)).withColumn(
        "dim", F.lit(art.svd.dim)).write.mode("overwrite").parquet(path + "/svd_values")
    art.forest.save(path + "/forest")
    return path


def model_load(spark: SparkSession, path: str) -> Artifacts:
    """Restore the artefacts.  A missing part, or parts that were not fitted together, fail with a clear message."""
    def need(p):
        try:
            return spark.read.parquet(p)
        except Exception as e:  # noqa: BLE001
            raise FileNotFoundError(f"model part not found: {p} ({type(e).__name__})") from None
    vocab = need(path + "/vocabulary")
    vals = need(path + "/svd_values").orderBy("component").collect()
    k, dim = len(vals), int(vals[0]["dim"])
    V = np.zeros((k, dim))
    for r in need(path + "/svd_components").collect():     # k x d, bounded by parameters
        V[r["component"], r["feature_index"]] = r["loading"]
    model = SV.SvdModel(V, np.array([r["singular_value"] for r in vals]),
                        np.array([r["explained_variance"] for r in vals]),
                        np.array([r["explained_variance_ratio"] for r in vals]), int(vals[0]["n_rows"]), dim)
    try:
        forest = RF.Forest.load(spark, path + "/forest")
    except Exception as e:  # noqa: BLE001
        raise FileNotFoundError(f"model part not found: {path}/forest ({type(e).__name__})") from None
    check_fit(path, vocab.count(), model, forest.n_features)
    return Artifacts(vocab, model, forest)


def check_fit(path: str, n_terms: int, model: SV.SvdModel, n_features: int) -> None:
    """Vocabulary, SVD and forest must have been fitted on each other: sizes that differ name the parts."""
    if n_terms != model.dim:
        raise ValueError(f"model parts do not fit together in {path}: the vocabulary has {n_terms} terms, the SVD {model.dim} features")
    if n_features != model.k + 1:
        raise ValueError(f"model parts do not fit together in {path}: the forest takes {n_features} features, "
                         f"the SVD gives {model.k} and the text length one")


def featurize(df: DataFrame, art: Artifacts, key: str, text_col: str = "text_clean",
              length_col: str | None = None) -> DataFrame:
    """Saved vocabulary -> TF-IDF -> SVD -> + text length -> feature vector: a
    projection of each row, so scoring shuffles nothing."""
    length = F.col(length_col) if length_col else F.length(F.col(text_col))
    rows = TF.tfidf_columns(df.withColumn("text_length", length.cast("bigint")), art.vocabulary, text_col)
    return TR.assemble_features(SV.svd_transform(rows, art.svd).drop("indices", "values"))


def score_reviews(df: DataFrame, art: Artifacts, key: str, text_col: str = "text") -> DataFrame:
    """Score any table of review texts: strip only (no full cleaning, as in
    single-review inference), featurise, predict, name the label."""
    from ..functions.text import strip_ws
    d = df.select(key, strip_ws(F.coalesce(F.col(text_col).cast("string"), F.lit("None"))).alias("_text"))
    feats = featurize(d, art, key, "_text")
    pred = TR.random_forest_predict(art.forest, feats)
    return pred.select(key, "predicted_label", label_name("predicted_label").alias("predicted_class"),
                       "prediction_confidence")


def gold_evaluation(gold: DataFrame, art: Artifacts, key: str = "doc_id", label_col: str = "gold_label") -> DataFrame:
    """Gold set -> saved featurisation -> forest -> results table."""
    from ..operators import evaluation as EV
    feats = featurize(gold, art, key, "text_clean")
    pred = TR.random_forest_predict(art.forest, feats)
    return EV.gold_results(pred.select(key, "text_clean", label_col, "predicted_label", "prediction_confidence"),
                           label_col, "predicted_label")

