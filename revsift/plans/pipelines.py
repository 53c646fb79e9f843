"""End-to-end compositions of the operators (the original scripts' ``main``s)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cleaning as C
from ..sources import fixtures as FX

CLEANED_COLUMNS = [
    "ingest_seq", "user_id", "gmap_id", "time", "rating", "text", "name", "pics", "resp",
    "category_all", "category_primary", "timestamp", "date", "year", "month",
    "has_photos", "photo_count", "text_clean", "text_length", "word_count", "name_clean",
    "has_response", "response_length", "user_review_count", "business_review_count",
]


#: The key of the event dedupe.
EVENT = ("user_id", "gmap_id", "time")


def clean_pipeline(reviews_raw: DataFrame, meta_raw: DataFrame | None, order_col: str = "ingest_seq",
                   response_flag: str = "filled", columns=None) -> DataFrame:
    """ingest -> metadata join -> raw dedupe -> clean.  ``columns``: those of ``CLEANED_COLUMNS`` that are wanted (None: all).

    The first row of an event (user_id, gmap_id, time) is the first of its raw key too, as that holds the event's columns:
    after the event dedupe the raw one, and the closing one on (gmap_id, user_id, time, text_clean), remove nothing more.
    What reads all rows of the raw dedupe is the rating median; it gets them without their texts.  Metadata and counts
    meet the events first, so whole reviews are shuffled once, by event, and staged once."""
    from ..session import cut_lineage, stage_table
    if meta_raw is None or "gmap_id" not in reviews_raw.columns or not set(EVENT) <= set(reviews_raw.columns):
        df = C.clean_review_data(reviews_raw, order_col=order_col, response_flag=response_flag, materialize=cut_lineage)
        return df.select(*[c for c in CLEANED_COLUMNS if c in df.columns and (columns is None or c in columns)])
    have, wanted = set(reviews_raw.columns), set(CLEANED_COLUMNS if columns is None else columns)
    key = F.struct(*EVENT).alias("_event")
    first = C.keep_first(reviews_raw.select("*", key), ["_event"], order_col)
    if extra := [c for c in ("category_all", "category_primary", "user_review_count", "business_review_count") if c in wanted]:
        meta = C.meta_first_per_key(C.normalize_meta(meta_raw), order_col=order_col)
        events = C.join_meta(reviews_raw.select(*EVENT).distinct(), meta)
        if "user_review_count" in wanted:
            events = C.user_review_count(events)
        if "business_review_count" in wanted:
            events = C.business_review_count(events)
        first = first.join(events.select(key, *extra), "_event")
    if "rating" in have:
        raw = C.dedupe_raw(reviews_raw.select(*C.RAW_DEDUPE_KEYS, order_col, "rating"), order_col) if "text" in have else reviews_raw
        first = first.withColumn("rating", F.coalesce("rating", F.lit(raw.agg(F.median("rating")).first()[0])))
    df = C.derived_columns(first.drop("_event"), response_flag)
    df = stage_table(df.select(*[c for c in CLEANED_COLUMNS if c in df.columns and (c in wanted or c in ("text_length", "rating"))]))
    if "text" in have:
        df = C.filter_length_quantiles(df)
    if "rating" in have:
        df = C.filter_rating_range(df)
    return df.select(*[c for c in df.columns if c in wanted])


def fixture_cleaned(spark: SparkSession, sf_dir: str, columns=None) -> DataFrame:
    return clean_pipeline(FX.fx_reviews(spark, sf_dir), FX.fx_meta_raw(spark, sf_dir), columns=columns)


def fixture_nonempty(spark: SparkSession, sf_dir: str, columns=None) -> DataFrame:
    return C.nonempty_text(fixture_cleaned(spark, sf_dir, columns))


def weak_label_pipeline(nonempty: DataFrame, lfs=None, n_epochs: int = 500, seed: int = 123) -> DataFrame:
    """votes -> moment matrix -> label-model fit -> posteriors, hard labels, confidence."""
    from ..functions.lfs import resolve
    from ..operators import label_model as LM
    from ..operators import labeling as LB
    from ..session import stage_table
    # stage output: materialised once, reused by the moment matrix and the scoring
    votes = stage_table(LB.apply_lfs(nonempty, lfs))
    m = len(resolve(lfs))
    params = LM.label_model_fit(votes, m, n_epochs=n_epochs, seed=seed)
    return LM.weak_labels(votes, params)


def feature_pipeline(weak: DataFrame, key: str = "ingest_seq", max_features: int = 2000, n_components: int = 100,
                     text_col: str = "text_clean"):
    """TF-IDF -> truncated SVD -> 100 components + text_length (+ labels).

    Returns ``(features, vocabulary, svd_model)``; ``features`` carries
    ``key, weak_label, confidence, text_length, svd, features, features_vec``."""
    from ..operators import svd as SV
    from ..operators import tfidf as TF
    from ..operators import training as TR
    from ..session import stage_table
    vocab = TF.tfidf_fit(weak, key, text_col, max_features=max_features)
    keep = [c for c in (key, "weak_label", "confidence", "text_length") if c in weak.columns]
    sparse = stage_table(TF.tfidf_columns(weak.select(*dict.fromkeys([*keep, text_col])), vocab, text_col)
                         .select(*keep, "indices", "values"))
    d = vocab.count()
    model = SV.svd_fit(sparse, d, min(n_components, d))
    feats = SV.svd_transform(sparse, model).drop("indices", "values")
    return TR.assemble_features(feats), vocab, model


def train_pipeline(features: DataFrame, key: str = "ingest_seq", label_col: str = "weak_label",
                   test_size: float = 0.2, seed: int = 42, **forest_kw):
    """drop abstain -> stratified split -> SMOTE -> balanced weights -> forest.
    Returns ``(model, test_predictions, train_resampled)``."""
    from pyspark.ml.functions import array_to_vector
    from ..operators import training as TR
    from ..session import cut_lineage
    labeled = TR.drop_abstain(features, label_col)
    split = cut_lineage(TR.stratified_split(labeled, label_col, [key], test_size, seed))
    train = split.where(F.col("split") == "train")
    test = split.where(F.col("split") == "test")
    res = cut_lineage(TR.smote_oversample(train, label_col, key, "features", seed))
    res = TR.class_weights(res.withColumn("features_vec", array_to_vector("features")), label_col)
    res = cut_lineage(res)
    model = TR.random_forest_fit(res, label_col=label_col, weight_col="class_weight", seed=seed, **forest_kw)
    pred = TR.random_forest_predict(model, test)
    return model, pred, res
