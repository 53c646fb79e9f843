"""Registered queries: one per operator of the inventory, each paired (where
the operation is expressible in SQL) with independent DuckDB SQL.

Every query reads the driver's tables through the fixture derivations in
:mod:`revsift.sources.fixtures` and runs over whole tables and whole texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..operators import cleaning as C
from ..operators import profile as P
from ..sources import fixtures as FX
from ..sources import readers as R
from . import oracle as O
from . import pipelines as PL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _ts_str(col: str) -> F.Column:
    return F.date_format(F.col(col), "yyyy-MM-dd HH:mm:ss")

# ------------------------------------------------------------------ shared stage builders


def _meta(spark, sf):
    return C.normalize_meta(FX.fx_meta_raw(spark, sf))


def _joined(spark, sf):
    meta = C.meta_first_per_key(_meta(spark, sf))
    return C.join_meta(FX.fx_reviews(spark, sf), meta)


def _dedup_raw(spark, sf):
    """Materialised like in ``clean_pipeline``: the median subquery and the
    main branch both read it."""
    from ..session import cut_lineage
    return cut_lineage(C.dedupe_raw(_joined(spark, sf)))


def _derived(spark, sf):
    """dedupe_raw -> all column derivations, before the event dedupe."""
    df = _dedup_raw(spark, sf)
    df = C.derive_time(df)
    df = C.impute_median(df, "rating")
    df = C.fill_text_none(df)
    df = C.photo_features(df)
    df = C.text_features(df)
    df = C.clean_name(df)
    return C.response_features(df)


def _counted(spark, sf):
    from ..session import cut_lineage
    df = cut_lineage(C.dedupe_event(_derived(spark, sf)))
    return C.business_review_count(C.user_review_count(df))

# ------------------------------------------------------------------ 2.1 sources


@register("read_meta", O.with_ctes(O.fx_meta_ctes(),
          "SELECT ingest_seq, gmap_id, category_all, category_primary FROM fx_meta"))
def q_read_meta(spark, sf):
    return _meta(spark, sf)


@register("meta_first_per_key", O.with_ctes(O.fx_meta_ctes(),
          "SELECT ingest_seq, gmap_id, category_all, category_primary FROM fx_meta_first"))
def q_meta_first(spark, sf):
    return C.meta_first_per_key(_meta(spark, sf))


@register("head_sample", O.with_ctes(O.cleaned_ctes(),
          "SELECT " + ", ".join(O.CLEANED_CHECK_COLUMNS) + " FROM cleaned ORDER BY ingest_seq LIMIT 1000"))
def q_head_sample(spark, sf):
    df = R.head_sample(PL.fixture_cleaned(spark, sf), 1000).withColumn("timestamp_str", _ts_str("timestamp"))
    return df.select(*O.CLEANED_CHECK_COLUMNS)


# ------------------------------------------------------------------ 2.3 cleaning


@register("join_meta", O.with_ctes(O.cleaned_ctes(),
          "SELECT ingest_seq, gmap_id, category_all, category_primary FROM joined"))
def q_join_meta(spark, sf):
    return _joined(spark, sf).select("ingest_seq", "gmap_id", "category_all", "category_primary")


@register("dedupe_raw", O.with_ctes(O.cleaned_ctes(),
          "SELECT ingest_seq, gmap_id, user_id, time, text FROM dedup_raw"))
def q_dedupe_raw(spark, sf):
    return _dedup_raw(spark, sf).select("ingest_seq", "gmap_id", "user_id", "time", "text")


@register("derive_time", O.with_ctes(O.fx_reviews_ctes(), """
SELECT ingest_seq, strftime(epoch_ms(time), '%Y-%m-%d %H:%M:%S') AS timestamp_str,
       CAST(epoch_ms(time) AS DATE) AS date, CAST(year(epoch_ms(time)) AS INTEGER) AS year,
       CAST(month(epoch_ms(time)) AS INTEGER) AS month
FROM fx_reviews"""))
def q_derive_time(spark, sf):
    df = C.derive_time(FX.fx_reviews(spark, sf))
    return df.select("ingest_seq", _ts_str("timestamp").alias("timestamp_str"), "date", "year", "month")


@register("impute_rating_median", O.with_ctes(O.cleaned_ctes(), "SELECT ingest_seq, rating FROM filled"))
def q_impute(spark, sf):
    return C.impute_median(_dedup_raw(spark, sf), "rating").select("ingest_seq", "rating")


@register("impute_rating_median_bounded", ORACLE["impute_rating_median"])
def q_impute_bounded(spark, sf):
    """The same ratings with the median found by a sketch's brackets."""
    from ..session import cut_lineage
    return C.impute_median(cut_lineage(_dedup_raw(spark, sf)), "rating", bounded=True).select("ingest_seq", "rating")


@register("fill_text_none", O.with_ctes(O.cleaned_ctes(), "SELECT ingest_seq, text, name FROM filled"))
def q_fill(spark, sf):
    return C.fill_text_none(_dedup_raw(spark, sf)).select("ingest_seq", "text", "name")


@register("photo_features", O.with_ctes(O.fx_reviews_ctes(), """
SELECT ingest_seq, (n_pics IS NOT NULL) AS has_photos, CAST(coalesce(n_pics, 0) AS BIGINT) AS photo_count
FROM fx_reviews"""))
def q_photos(spark, sf):
    return C.photo_features(FX.fx_reviews(spark, sf)).select("ingest_seq", "has_photos", "photo_count")


@register("clean_text", O.with_ctes(O.cleaned_ctes(), "SELECT ingest_seq, text_clean FROM derived"))
def q_clean_text(spark, sf):
    return _derived(spark, sf).select("ingest_seq", "text_clean")


@register("text_stats", O.with_ctes(O.cleaned_ctes(), "SELECT ingest_seq, text_length, word_count FROM derived2"))
def q_text_stats(spark, sf):
    return _derived(spark, sf).select("ingest_seq", "text_length", "word_count")


@register("clean_name", O.with_ctes(O.cleaned_ctes(), "SELECT ingest_seq, name_clean FROM derived2"))
def q_clean_name(spark, sf):
    return _derived(spark, sf).select("ingest_seq", "name_clean")


@register("response_features", O.with_ctes(O.cleaned_ctes(),
          "SELECT ingest_seq, has_response, response_length FROM derived2"))
def q_response(spark, sf):
    return _derived(spark, sf).select("ingest_seq", "has_response", "response_length")


@register("dedupe_event", O.with_ctes(O.cleaned_ctes(),
          "SELECT ingest_seq, user_id, gmap_id, time FROM dedup_event"))
def q_dedupe_event(spark, sf):
    return C.dedupe_event(_derived(spark, sf)).select("ingest_seq", "user_id", "gmap_id", "time")


@register("dedupe_event_removed", O.with_ctes(O.cleaned_ctes(), """
SELECT (SELECT count(*) FROM derived2) AS n_before, count(*) AS n_after,
       (SELECT count(*) FROM derived2) - count(*) AS n_removed FROM dedup_event"""))
def q_dedupe_event_removed(spark, sf):
    d = _derived(spark, sf)
    return C.removed_count(d, C.dedupe_event(d))


@register("user_review_count", O.with_ctes(O.cleaned_ctes(), "SELECT ingest_seq, user_review_count FROM counted"))
def q_user_count(spark, sf):
    return _counted(spark, sf).select("ingest_seq", "user_review_count")


@register("business_review_count", O.with_ctes(O.cleaned_ctes(),
          "SELECT ingest_seq, business_review_count FROM counted"))
def q_biz_count(spark, sf):
    return _counted(spark, sf).select("ingest_seq", "business_review_count")


@register("filter_length_quantiles", O.with_ctes(O.cleaned_ctes(), """
SELECT c.ingest_seq, c.text_length FROM counted c, len_bounds b
WHERE c.text_length >= b.lo AND c.text_length <= b.hi"""))
def q_len_filter(spark, sf):
    return C.filter_length_quantiles(_counted(spark, sf)).select("ingest_seq", "text_length")


@register("filter_length_quantiles_bounded", ORACLE["filter_length_quantiles"])
def q_len_filter_bounded(spark, sf):
    """The same rows with quantiles found by a sketch's brackets instead of a map of all lengths."""
    from ..session import cut_lineage
    return C.filter_length_quantiles(cut_lineage(_counted(spark, sf)), bounded=True).select("ingest_seq", "text_length")


@register("filter_rating_range", O.with_ctes(O.cleaned_ctes(),
          "SELECT ingest_seq, rating FROM counted WHERE rating BETWEEN 1 AND 5"))
def q_rating_filter(spark, sf):
    return C.filter_rating_range(_counted(spark, sf)).select("ingest_seq", "rating")


@register("dedupe_clean", O.with_ctes(O.cleaned_ctes(), """
SELECT ingest_seq FROM cleaned
QUALIFY row_number() OVER (PARTITION BY gmap_id, user_id, time, text_clean ORDER BY ingest_seq) = 1"""))
def q_dedupe_clean(spark, sf):
    return C.dedupe_clean(PL.fixture_cleaned(spark, sf)).select("ingest_seq")


@register("clean_pipeline", O.with_ctes(O.cleaned_ctes(),
          "SELECT " + ", ".join(O.CLEANED_CHECK_COLUMNS) + " FROM cleaned"))
def q_clean_pipeline(spark, sf):
    df = PL.fixture_cleaned(spark, sf).withColumn("timestamp_str", _ts_str("timestamp"))
    return df.select(*O.CLEANED_CHECK_COLUMNS)


@register("nonempty_text", O.with_ctes(O.cleaned_ctes(), "SELECT ingest_seq, text_clean FROM nonempty"))
def q_nonempty(spark, sf):
    return PL.fixture_nonempty(spark, sf).select("ingest_seq", "text_clean")

# ------------------------------------------------------------------ 2.2 profiling


_PROFILE_COLS = ["user_id", "gmap_id", "time", "rating", "text", "name", "pics", "resp",
                 "category_all", "category_primary"]


@register("profile_schema_nulls", O.with_ctes(O.cleaned_ctes(), """
SELECT column_name, CAST(n_rows AS BIGINT) AS n_rows, CAST(n_null AS BIGINT) AS n_null FROM (
  SELECT count(*) AS n_rows,
         count(*) FILTER (WHERE user_id IS NULL) AS user_id,
         count(*) FILTER (WHERE gmap_id IS NULL) AS gmap_id,
         count(*) FILTER (WHERE time IS NULL) AS time,
         count(*) FILTER (WHERE rating IS NULL) AS rating,
         count(*) FILTER (WHERE text IS NULL) AS text,
         count(*) FILTER (WHERE name IS NULL) AS name,
         count(*) FILTER (WHERE n_pics IS NULL) AS pics,
         count(*) FILTER (WHERE NOT resp_present) AS resp,
         count(*) FILTER (WHERE category_all IS NULL) AS category_all,
         count(*) FILTER (WHERE category_primary IS NULL) AS category_primary
  FROM dedup_raw)
UNPIVOT (n_null FOR column_name IN (user_id, gmap_id, time, rating, text, name, pics, resp,
                                     category_all, category_primary))"""))
def q_profile(spark, sf):
    return P.profile_schema_nulls(_dedup_raw(spark, sf), _PROFILE_COLS).select("column_name", "n_rows", "n_null")


@register("report_totals", O.with_ctes(O.cleaned_ctes(), """
SELECT count(*) AS n_reviews, count(DISTINCT user_id) AS n_users, count(DISTINCT gmap_id) AS n_businesses
FROM cleaned"""))
def q_totals(spark, sf):
    return P.report_totals(PL.fixture_cleaned(spark, sf))


@register("report_rating_dist", O.with_ctes(O.cleaned_ctes(), """
SELECT rating, count(*) AS n_reviews FROM cleaned WHERE rating IS NOT NULL GROUP BY rating ORDER BY rating"""))
def q_rating_dist(spark, sf):
    return P.report_rating_dist(PL.fixture_cleaned(spark, sf))


@register("report_averages", O.with_ctes(O.cleaned_ctes(), """
SELECT avg(rating) AS avg_rating, avg(text_length) AS avg_chars, avg(word_count) AS avg_words FROM cleaned"""))
def q_averages(spark, sf):
    return P.report_averages(PL.fixture_cleaned(spark, sf))


@register("report_time_range", O.with_ctes(O.cleaned_ctes(), """
SELECT min(timestamp_str) AS min_timestamp, max(timestamp_str) AS max_timestamp FROM cleaned"""))
def q_time_range(spark, sf):
    df = P.report_time_range(PL.fixture_cleaned(spark, sf))
    return df.select(_ts_str("min_timestamp").alias("min_timestamp"), _ts_str("max_timestamp").alias("max_timestamp"))


@register("report_photo_response_share", O.with_ctes(O.cleaned_ctes(), """
SELECT count(*) FILTER (WHERE has_photos) AS n_with_photos, avg(CAST(has_photos AS INTEGER)) * 100 AS pct_with_photos,
       count(*) FILTER (WHERE has_response) AS n_with_response,
       avg(CAST(has_response AS INTEGER)) * 100 AS pct_with_response
FROM cleaned"""))
def q_share(spark, sf):
    return P.report_photo_response_share(PL.fixture_cleaned(spark, sf))

# ------------------------------------------------------------------ 2.4-2.6 labeling

import numpy as _np  # noqa: E402

from ..functions import lexicon as LX  # noqa: E402
from ..functions import lfs as LFS  # noqa: E402
from ..operators import label_model as LM  # noqa: E402
from ..operators import labeling as LB  # noqa: E402

_LF_COLS = ["ingest_seq"] + LFS.DEFAULT_LFS


#: What the labeling functions and the features read, and the key.
_LF_INPUT = ("ingest_seq", "text_clean", "text_length", "word_count", "rating", "has_photos", "photo_count", "has_response",
             "category_all", "category_primary")


def _votes(spark, sf, wanted=None):
    """The vote table is a stage output: materialised, so later filters on
    labels cannot be rewritten into the 23 labeling-function expressions."""
    from ..session import restage
    votes = lambda: LB.apply_lfs(PL.fixture_nonempty(spark, sf, _LF_INPUT))
    return restage(spark, lambda: votes().select(*wanted) if wanted else votes())


def _votes_alone(spark, sf):
    """The votes without the texts they were cast on."""
    return _votes(spark, sf, (*_LF_COLS, "votes"))


def _fitted_labels(spark, sf):
    """Keys, texts and fitted weak labels, staged."""
    from ..session import restage
    return restage(spark, lambda: PL.weak_label_pipeline(PL.fixture_nonempty(spark, sf, _LF_INPUT)).select(
        "ingest_seq", "text_clean", "text_length", "weak_label", "confidence"))


def _init_params(votes):
    """Moment-initialised parameters (zero SGD epochs) - SQL-reproducible."""
    m = len(LFS.DEFAULT_LFS)
    return LM.fit_label_model(LM.overlap_to_numpy(LB.vote_overlap_matrix(votes), m), m, n_epochs=0)


def _init_scored(spark, sf):
    v = _votes(spark, sf)
    return LM.weak_labels(v, _init_params(v))


_R_INIT = float(_np.random.RandomState(123).random_sample())


@register("review_sample", O.with_ctes(O.init_params_ctes(_R_INIT), """
SELECT ingest_seq, text_clean, weak_label, confidence, prob_genuine, prob_promotion, prob_irrelevant, prob_rant FROM lm_pred
ORDER BY CAST(('0x' || substr(md5('42:' || CAST(ingest_seq AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0, ingest_seq
LIMIT 100"""))
def q_review_sample(spark, sf):
    return R.review_sample(_init_scored(spark, sf), 100)


@register("category_family", O.with_ctes(O.labeled_ctes(), "SELECT ingest_seq, fam AS family FROM lf_ctx"))
def q_family(spark, sf):
    df = PL.fixture_nonempty(spark, sf)
    return df.select("ingest_seq", LX.category_family(LX.primary_category()).alias("family"))


@register("word_tokens", O.with_ctes(O.labeled_ctes(),
          "SELECT ingest_seq, CAST(len(tok) AS INTEGER) AS n_tokens, array_to_string(tok, ' ') AS tokens FROM lf_ctx"))
def q_tokens(spark, sf):
    from ..functions.text import letter_tokens
    df = PL.fixture_nonempty(spark, sf).select("ingest_seq", letter_tokens(F.lower("text_clean")).alias("tok"))
    return df.select("ingest_seq", F.size("tok").alias("n_tokens"), F.array_join("tok", " ").alias("tokens"))


@register("word_count_rx", O.with_ctes(O.labeled_ctes(), "SELECT ingest_seq, wc FROM lf_ctx"))
def q_wc(spark, sf):
    from ..functions.text import regex_word_count
    return PL.fixture_nonempty(spark, sf).select("ingest_seq", regex_word_count("text_clean").alias("wc"))


@register("lexicon_contains", O.with_ctes(O.labeled_ctes(),
          f"SELECT ingest_seq, {O.sql_any('tl', K.PROMO_WORDS)} AS has_promo, "
          f"{O.sql_any('tl', K.NEVER_VISITED_PHRASES)} AS has_never_visited FROM lf_ctx"))
def q_lexicon(spark, sf):
    from ..functions.text import contains_any
    tl = F.lower("text_clean")
    return PL.fixture_nonempty(spark, sf).select(
        "ingest_seq", contains_any(tl, K.PROMO_WORDS).alias("has_promo"),
        contains_any(tl, K.NEVER_VISITED_PHRASES).alias("has_never_visited"))


@register("domain_term_hits", O.with_ctes(O.labeled_ctes(),
          "SELECT ingest_seq, fam AS family, CAST(hits AS INTEGER) AS hits, CAST(ftot AS INTEGER) AS filtered_tokens, "
          "CAST(fhits AS INTEGER) AS filtered_hits FROM lf_ctx"))
def q_domain_hits(spark, sf):
    df = LFS.add_lf_context(PL.fixture_nonempty(spark, sf))
    return df.select("ingest_seq", F.col(LFS.FAM).alias("family"), F.col(LFS.HITS).alias("hits"),
                     F.col(LFS.FTOT).alias("filtered_tokens"), F.col(LFS.FHITS).alias("filtered_hits"))


@register("apply_lfs", O.with_ctes(O.labeled_ctes(), "SELECT " + ", ".join(_LF_COLS) + " FROM lf_votes"))
def q_apply_lfs(spark, sf):
    return _votes_alone(spark, sf).select(*_LF_COLS)


@register("lf_bind_columns", O.with_ctes(
    O.cleaned_ctes() + O.lf_ctes("cleaned", "name_clean", "coalesce(category_all, '')"),
    "SELECT " + ", ".join(_LF_COLS) + " FROM lf_votes"))
def q_lf_bind(spark, sf):
    """The LFs bound to other columns: text from ``name_clean``, category from ``category_all``."""
    df = PL.fixture_cleaned(spark, sf)
    return LB.apply_lfs(df, text_col="name_clean", category_col="category_all").select(*_LF_COLS)


@register("lf_raw_text")
def q_lf_raw(spark, sf):
    """The LFs on the raw review text.  Rows check only: raw text holds
    non-ASCII letters, where word classes and boundaries differ between
    Java regex and RE2, so the SQL engine cannot serve as an oracle."""
    df = PL.fixture_cleaned(spark, sf)
    return LB.apply_lfs(df, text_col="text").select(*_LF_COLS)


@register("lf_summary", O.sql_lf_summary())
def q_lf_summary(spark, sf):
    return LB.lf_summary(_votes_alone(spark, sf))


@register("lf_total_coverage", O.with_ctes(O.labeled_ctes(), """
SELECT count(*) FILTER (WHERE list_bool_or(list_transform(votes, lambda x: x <> -1))) * 100.0 / count(*)
       AS total_coverage_pct FROM lf_arr"""))
def q_lf_total(spark, sf):
    return LB.lf_total_coverage(_votes_alone(spark, sf))


@register("lf_coverage", O.sql_lf_coverage())
def q_lf_coverage(spark, sf):
    return LB.lf_coverage(_votes_alone(spark, sf))


@register("vote_overlap_matrix", O.sql_overlap_matrix())
def q_overlap(spark, sf):
    return LB.vote_overlap_matrix(_votes_alone(spark, sf))


@register("label_model_proba", O.with_ctes(O.init_params_ctes(_R_INIT),
          "SELECT ingest_seq, prob_genuine, prob_promotion, prob_irrelevant, prob_rant FROM lm_pred"))
def q_lm_proba(spark, sf):
    return _init_scored(spark, sf).select("ingest_seq", *LM.PROB_COLUMNS)


@register("label_model_predict", O.with_ctes(O.init_params_ctes(_R_INIT),
          "SELECT ingest_seq, weak_label FROM lm_pred"))
def q_lm_predict(spark, sf):
    return _init_scored(spark, sf).select("ingest_seq", "weak_label")


@register("label_confidence", O.with_ctes(O.init_params_ctes(_R_INIT), "SELECT ingest_seq, confidence FROM lm_pred"))
def q_lm_conf(spark, sf):
    return _init_scored(spark, sf).select("ingest_seq", "confidence")


@register("label_distribution", O.with_ctes(O.init_params_ctes(_R_INIT), """
SELECT weak_label AS label,
       CASE weak_label WHEN -1 THEN 'ABSTAIN' WHEN 0 THEN 'GENUINE' WHEN 1 THEN 'PROMOTION' WHEN 2 THEN 'IRRELEVANT'
            WHEN 3 THEN 'RANT' ELSE 'UNKNOWN_' || CAST(weak_label AS VARCHAR) END AS label_name,
       count(*) AS n_rows, count(*) * 100.0 / (SELECT count(*) FROM lm_pred) AS pct
FROM lm_pred GROUP BY weak_label ORDER BY weak_label"""))
def q_label_dist(spark, sf):
    return P.label_distribution(_init_scored(spark, sf))


def _triplet_params(votes):
    m = len(LFS.DEFAULT_LFS)
    return LM.triplet_start(LM.overlap_to_numpy(LB.vote_overlap_matrix(votes), m), m)


@register("label_model_start", O.with_ctes(O.triplet_ctes(), "SELECT j, vote, y, mu FROM lm_mu"))
def q_lm_start(spark, sf):
    """Closed-form parameters P(rule j votes c | class y) from triplets of rules."""
    return LM.params_frame(spark, _triplet_params(_votes(spark, sf)))


@register("label_model_proba_general", O.with_ctes(O.triplet_ctes() + """,
ls AS (SELECT v.ingest_seq, m.y, ln(0.25) + sum(CASE WHEN v.y = -1 THEN 0.0 ELSE ln(least(greatest(m.mu, 0.01), 0.99)) END) AS s
       FROM tr_v v JOIN lm_mu m ON m.j = v.j AND m.vote = CASE WHEN v.y = -1 THEN 0 ELSE v.y END GROUP BY ALL),
le AS (SELECT ingest_seq, y, exp(s - max(s) OVER (PARTITION BY ingest_seq)) AS e FROM ls),
lp AS (SELECT ingest_seq, y, e / sum(e) OVER (PARTITION BY ingest_seq) AS p FROM le)""", """
SELECT ingest_seq, max(p) FILTER (WHERE y = 0) AS prob_genuine, max(p) FILTER (WHERE y = 1) AS prob_promotion,
       max(p) FILTER (WHERE y = 2) AS prob_irrelevant, max(p) FILTER (WHERE y = 3) AS prob_rant FROM lp GROUP BY ingest_seq"""))
def q_lm_proba_general(spark, sf):
    """Posteriors under a general table, where a vote says something about every class."""
    v = _votes(spark, sf)
    return LM.label_model_proba(v, _triplet_params(v)).select("ingest_seq", *LM.PROB_COLUMNS)


@register("confidence_stats", O.with_ctes(O.init_params_ctes(_R_INIT),
          "SELECT avg(confidence) AS mean_confidence, stddev_samp(confidence) AS std_confidence FROM lm_pred"))
def q_conf_stats(spark, sf):
    return P.confidence_stats(_init_scored(spark, sf))


@register("confidence_histogram", O.with_ctes(O.init_params_ctes(_R_INIT) + """,
hb AS (SELECT min(confidence) AS lo, max(confidence) AS hi FROM lm_pred),
hc AS (SELECT CAST(CASE WHEN hb.hi = hb.lo THEN 0
                        ELSE least(floor((confidence - hb.lo) / ((hb.hi - hb.lo) / 50.0)), 49) END AS INTEGER) AS bin,
              count(*) AS n
       FROM lm_pred, hb WHERE confidence IS NOT NULL GROUP BY 1)""", """
SELECT CAST(g.bin AS INTEGER) AS bin, hb.lo + g.bin * ((hb.hi - hb.lo) / 50.0) AS lo,
       hb.lo + (g.bin + 1) * ((hb.hi - hb.lo) / 50.0) AS hi, CAST(coalesce(hc.n, 0) AS BIGINT) AS n_rows
FROM (SELECT range AS bin FROM range(50)) g CROSS JOIN hb LEFT JOIN hc ON hc.bin = g.bin ORDER BY g.bin"""))
def q_conf_hist(spark, sf):
    return P.confidence_histogram(_init_scored(spark, sf))


@register("label_model_fit")
def q_lm_fit(spark, sf):
    """Fitted parameters (500 SGD epochs, seed 123) - iterative, rows check only."""
    v = _votes(spark, sf)
    m = len(LFS.DEFAULT_LFS)
    params = LM.label_model_fit(v, m)
    return LM.params_frame(spark, params)


@register("weak_label_pipeline")
def q_weak_pipeline(spark, sf):
    from . import pipelines as _pl
    return _pl.weak_label_pipeline(PL.fixture_nonempty(spark, sf)).select(
        "ingest_seq", "weak_label", "confidence", *LM.PROB_COLUMNS)

# ------------------------------------------------------------------ 2.9 evaluation

from ..operators import evaluation as EV  # noqa: E402


def _pred(spark, sf):
    g = FX.fx_predictions(spark, sf)
    return C.nonempty_text(g)


@register("gold_class_counts", O.with_ctes(O.gold_ctes(), """
SELECT gold_label AS label, count(*) AS n_rows FROM fx_pred GROUP BY gold_label ORDER BY n_rows DESC, label"""))
def q_gold_counts(spark, sf):
    return EV.gold_class_counts(_pred(spark, sf))


@register("confusion_matrix", O.with_ctes(O.gold_ctes(), """
SELECT t.label AS true_label, p.label AS pred_label, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM fx_labels t CROSS JOIN fx_labels p
LEFT JOIN fx_cm c ON c.true_label = t.label AND c.pred_label = p.label"""))
def q_confusion(spark, sf):
    return EV.confusion_matrix(_pred(spark, sf))


@register("classification_report", O.with_ctes(O.gold_ctes() + """,
fx_per AS (
  SELECT l.label,
         coalesce(sum(c.n) FILTER (WHERE c.true_label = l.label AND c.pred_label = l.label), 0) AS tp,
         coalesce(sum(c.n) FILTER (WHERE c.true_label = l.label), 0) AS support,
         coalesce(sum(c.n) FILTER (WHERE c.pred_label = l.label), 0) AS predicted
  FROM fx_labels l LEFT JOIN fx_cm c ON c.true_label = l.label OR c.pred_label = l.label
  GROUP BY l.label),
fx_prf AS (
  SELECT label, tp, support,
         CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS precision,
         CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall
  FROM fx_per),
fx_prf1 AS (
  SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END
         AS f1_score FROM fx_prf),
fx_tot AS (SELECT sum(support) AS total FROM fx_prf1)""", f"""
SELECT {O.label_name_sql('label')} AS row_name, CAST(label AS INTEGER) AS label, precision, recall, f1_score,
       CAST(support AS BIGINT) AS support FROM fx_prf1
UNION ALL
SELECT 'accuracy', NULL, NULL, NULL, sum(tp) / (SELECT total FROM fx_tot), CAST((SELECT total FROM fx_tot) AS BIGINT)
FROM fx_prf1
UNION ALL
SELECT 'macro avg', NULL, avg(precision), avg(recall), avg(f1_score), CAST((SELECT total FROM fx_tot) AS BIGINT)
FROM fx_prf1
UNION ALL
SELECT 'weighted avg', NULL, sum(precision * support) / (SELECT total FROM fx_tot),
       sum(recall * support) / (SELECT total FROM fx_tot), sum(f1_score * support) / (SELECT total FROM fx_tot),
       CAST((SELECT total FROM fx_tot) AS BIGINT)
FROM fx_prf1"""))
def q_report(spark, sf):
    return EV.classification_report(_pred(spark, sf))


@register("overall_accuracy", O.with_ctes(O.gold_ctes(), """
SELECT avg(CASE WHEN gold_label = predicted_label THEN 1.0 ELSE 0.0 END) AS accuracy, count(*) AS n_rows
FROM fx_pred"""))
def q_accuracy(spark, sf):
    return EV.overall_accuracy(_pred(spark, sf))


@register("per_class_accuracy", O.with_ctes(O.gold_ctes(), f"""
SELECT gold_label AS label, {O.label_name_sql('gold_label')} AS label_name,
       avg(CASE WHEN gold_label = predicted_label THEN 1.0 ELSE 0.0 END) AS accuracy, count(*) AS n_rows
FROM fx_pred GROUP BY gold_label"""))
def q_per_class(spark, sf):
    return EV.per_class_accuracy(_pred(spark, sf))


@register("high_confidence_accuracy", O.with_ctes(O.gold_ctes(), """
SELECT count(*) FILTER (WHERE prediction_confidence > 0.8) AS n_high_confidence, count(*) AS n_rows,
       avg(CASE WHEN gold_label = predicted_label THEN 1.0 ELSE 0.0 END) FILTER (WHERE prediction_confidence > 0.8)
         AS accuracy
FROM fx_pred"""))
def q_high_conf(spark, sf):
    return EV.high_confidence_accuracy(_pred(spark, sf))


@register("gold_results", O.with_ctes(O.gold_ctes(), f"""
SELECT doc_id, text_clean, gold_label, predicted_label, prediction_confidence,
       CAST(gold_label = predicted_label AS INTEGER) AS correct, {O.label_name_sql('predicted_label')} AS predicted_class
FROM fx_pred"""))
def q_gold_results(spark, sf):
    return EV.gold_results(_pred(spark, sf))


@register("error_rows", O.with_ctes(O.gold_ctes(), f"""
SELECT doc_id, substr(text_clean, 1, 100) AS text_preview, {O.label_name_sql('gold_label')} AS true_class,
       {O.label_name_sql('predicted_label')} AS predicted_class,
       (SELECT count(*) FROM fx_pred WHERE gold_label <> predicted_label) AS n_incorrect
FROM fx_pred WHERE gold_label <> predicted_label ORDER BY doc_id LIMIT 5"""))
def q_errors(spark, sf):
    return EV.error_rows(_pred(spark, sf))


@register("class_counts", O.with_ctes(O.gold_ctes(), """
SELECT predicted_label AS label, count(*) AS n_rows FROM fx_pred GROUP BY predicted_label ORDER BY label"""))
def q_class_counts(spark, sf):
    return P.class_counts(_pred(spark, sf), "predicted_label")

# ------------------------------------------------------------------ 2.7 text features

from ..operators import tfidf as TF  # noqa: E402


def _tf_corpus(spark, sf):
    return PL.fixture_nonempty(spark, sf)


@register("tokenize_stop", O.with_ctes(O.cleaned_ctes() + O.tfidf_ctes(), """
SELECT doc_key AS ingest_seq, CAST(len(toks) AS INTEGER) AS n_tokens, array_to_string(toks, ' ') AS tokens FROM tf_docs"""))
def q_tokenize(spark, sf):
    t = TF.doc_terms(_tf_corpus(spark, sf), "ingest_seq", stop_words=K.SPARK_ENGLISH_STOP_WORDS)
    # unigrams are the first half of the term list: n unigrams + (n - 1) bigrams
    n = ((F.size("terms") + 1) / 2).cast("int")
    uni = F.slice("terms", 1, F.greatest(n, F.lit(1)))
    uni = F.when(F.size("terms") == 0, F.array().cast("array<string>")).otherwise(uni)
    return t.select("ingest_seq", F.size(uni).alias("n_tokens"), F.array_join(uni, " ").alias("tokens"))


@register("ngrams_1_2", O.with_ctes(O.cleaned_ctes() + O.tfidf_ctes(), """
SELECT doc_key AS ingest_seq, term, CAST(count(*) AS BIGINT) AS n FROM tf_terms GROUP BY ALL"""))
def q_ngrams(spark, sf):
    t = TF.doc_terms(_tf_corpus(spark, sf), "ingest_seq")
    return (t.select("ingest_seq", F.explode("terms").alias("term"))
            .groupBy("ingest_seq", "term").agg(F.count(F.lit(1)).alias("n")))


@register("term_doc_freq", O.with_ctes(O.cleaned_ctes() + O.tfidf_ctes(),
          "SELECT term, df, CAST(corpus_count AS BIGINT) AS corpus_count FROM tf_df"))
def q_term_df(spark, sf):
    t = TF.doc_terms(_tf_corpus(spark, sf), "ingest_seq")
    return TF.term_doc_freq(t)


@register("vocabulary_select", O.with_ctes(O.cleaned_ctes() + O.tfidf_ctes(),
          "SELECT feature_name, feature_index, df, idf FROM tf_vocab"))
def q_vocab(spark, sf):
    vocab = TF.tfidf_fit(_tf_corpus(spark, sf), "ingest_seq")
    return vocab


@register("save_vocabulary", O.with_ctes(O.cleaned_ctes() + O.tfidf_ctes(),
          "SELECT feature_name, feature_index FROM tf_vocab"))
def q_save_vocab(spark, sf):
    vocab = TF.tfidf_fit(_tf_corpus(spark, sf), "ingest_seq")
    return vocab.select("feature_name", "feature_index")


@register("tfidf_fit_transform", O.with_ctes(O.cleaned_ctes() + O.tfidf_ctes(),
          "SELECT doc_key AS ingest_seq, feature_index, weight FROM tf_long"))
def q_tfidf(spark, sf):
    _, long = TF.tfidf_fit_transform_long(_tf_corpus(spark, sf), "ingest_seq")
    return long


_GOLD_TFIDF = O.with_ctes(O.cleaned_ctes() + O.tfidf_ctes() + "," + O.gold_ctes() + f""",
gold_docs AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text_clean), '\\b\\w\\w+\\b'),
                     lambda x: NOT list_contains({O.lit_list(K.SPARK_ENGLISH_STOP_WORDS)}, x)) AS toks FROM fx_gold),
gold_terms AS (SELECT doc_id, unnest(list_concat(toks, list_transform(range(1, len(toks)),
                                                  lambda i: toks[i] || ' ' || toks[i + 1]))) AS term FROM gold_docs),
gold_counts AS (SELECT doc_id, term, count(*) AS cnt FROM gold_terms GROUP BY ALL),
gold_w AS (SELECT c.doc_id, v.feature_index, (1.0 + ln(c.cnt)) * v.idf AS w
           FROM gold_counts c JOIN tf_vocab v ON c.term = v.feature_name),
gold_n AS (SELECT doc_id, sqrt(sum(w * w)) AS nrm FROM gold_w GROUP BY doc_id)""", """
SELECT w.doc_id, w.feature_index, CASE WHEN nrm > 0 THEN w / nrm ELSE 0.0 END AS weight
FROM gold_w w JOIN gold_n n ON w.doc_id = n.doc_id""")


@register("tfidf_transform", _GOLD_TFIDF)
def q_tfidf_transform(spark, sf):
    """Gold-set documents weighted with the vocabulary fitted on the reviews."""
    vocab = TF.tfidf_fit(_tf_corpus(spark, sf), "ingest_seq")
    return TF.tfidf_transform_long(_pred(spark, sf), vocab, "doc_id")

# ------------------------------------------------------------------ 2.7 SVD / 2.8 training

from ..operators import svd as SV  # noqa: E402
from ..operators import training as TR  # noqa: E402


def _embeddings(spark, sf):
    e = FX.read_table(spark, sf, "embeddings")
    return e.select("vec_id", F.col("label").cast("int").alias("label"),
                    F.col("embedding").cast("array<double>").alias("features"))


def _weak_init(spark, sf):
    """Reviews with moment-initialised weak labels (SQL-reproducible)."""
    return _init_scored(spark, sf)


def _features(spark, sf):
    return PL.feature_pipeline(_fitted_labels(spark, sf))


@register("drop_abstain", O.with_ctes(O.init_params_ctes(_R_INIT),
          "SELECT ingest_seq, weak_label FROM lm_pred WHERE weak_label <> -1"))
def q_drop_abstain(spark, sf):
    return TR.drop_abstain(_weak_init(spark, sf)).select("ingest_seq", "weak_label")


_MD5U = "CAST(('0x' || substr(md5('42:' || CAST({k} AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0"


@register("stratified_split", O.with_ctes("""
e AS (SELECT vec_id, CAST(label AS INTEGER) AS label FROM embeddings),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY """ + _MD5U.format(k="vec_id") + """, CAST(vec_id AS VARCHAR))
             AS rk, count(*) OVER (PARTITION BY label) AS nc FROM e)""", """
SELECT vec_id, label, CASE WHEN rk <= ceil(0.2 * nc) THEN 'test' ELSE 'train' END AS split FROM r"""))
def q_split(spark, sf):
    return TR.stratified_split(_embeddings(spark, sf), "label", ["vec_id"]).select("vec_id", "label", "split")


@register("class_weights", O.with_ctes("""
e AS (SELECT vec_id, CAST(label AS INTEGER) AS label FROM embeddings),
c AS (SELECT label, count(*) AS nc FROM e GROUP BY label)""", """
SELECT e.vec_id, e.label, (SELECT count(*) FROM e) / ((SELECT count(*) FROM c) * c.nc) AS class_weight
FROM e JOIN c USING (label)"""))
def q_weights(spark, sf):
    return TR.class_weights(_embeddings(spark, sf), "label").select("vec_id", "label", "class_weight")


@register("nearest_neighbours", O.with_ctes("""
e AS (SELECT vec_id, CAST(label AS INTEGER) AS label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
p AS (SELECT a.vec_id, b.vec_id AS nn_key,
             list_reduce(list_transform(list_zip(a.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])),
                         lambda s, v: s + v) AS d2
      FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id)""", """
SELECT vec_id, arg_min(nn_key, (d2, nn_key)) AS nn_key, min(d2) AS nn_dist2 FROM p GROUP BY vec_id"""))
def q_nn(spark, sf):
    """Exact same-class nearest neighbour; the oracle is a brute-force self-join."""
    return TR.nearest_neighbours(_embeddings(spark, sf), "label", "vec_id")


@register("nearest_neighbours_blocks", ORACLE["nearest_neighbours"])
def q_nn_blocks(spark, sf):
    """The same in blocks of 16 rows, so that cells, rings and the search across blocks all take part."""
    return TR.nearest_neighbours(_embeddings(spark, sf), "label", "vec_id", block_rows=16)


@register("stratified_folds", O.with_ctes("""
e AS (SELECT vec_id, CAST(label AS INTEGER) AS label FROM embeddings)""", f"""
SELECT vec_id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY {_MD5U.format(k="vec_id")}, CAST(vec_id AS VARCHAR)) - 1) % 3
       AS INTEGER) AS fold FROM e"""))
def q_folds(spark, sf):
    """Fold of every row in a stratified 3-fold cross-validation."""
    return TR.with_folds(_embeddings(spark, sf), "label", "vec_id", 3).select("vec_id", "label", F.col("_fold").alias("fold"))


@register("smote_oversample", O.with_ctes(f"""
e AS (SELECT vec_id, CAST(label AS INTEGER) AS label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
p AS (SELECT a.vec_id, b.vec_id AS nn_key,
             list_reduce(list_transform(list_zip(a.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])),
                         lambda s, v: s + v) AS d2
      FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id),
nn AS (SELECT vec_id, arg_min(nn_key, (d2, nn_key)) AS nn_key FROM p GROUP BY vec_id),
ranked AS (SELECT label, vec_id, x, count(*) OVER (PARTITION BY label) AS nc,
                  row_number() OVER (PARTITION BY label ORDER BY {_MD5U.format(k='vec_id')}, CAST(vec_id AS VARCHAR)) - 1 AS r0
           FROM e),
cls AS (SELECT label, count(*) AS nc FROM e GROUP BY label),
need AS (SELECT label, nc, (SELECT max(nc) FROM cls) - nc AS n FROM cls),
plan AS (SELECT *, CAST(coalesce(sum(n) OVER (ORDER BY label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
                   AS start FROM need),
ids AS (SELECT label, nc, start + i AS sid, i % nc AS r0 FROM (SELECT *, unnest(range(n)) AS i FROM plan)),
syn AS (SELECT i.label, i.sid, r.x AS a, f.x AS b,
               CAST(('0x' || substr(md5('42:gap:' || CAST(i.sid AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0 AS gap
        FROM ids i JOIN ranked r ON r.label = i.label AND r.r0 = i.r0 JOIN nn ON nn.vec_id = r.vec_id
        JOIN e f ON f.vec_id = nn.nn_key),
vec AS (SELECT label, CAST(NULL AS BIGINT) AS vec_id, sid AS synthetic_id,
               list_transform(list_zip(a, b), lambda z: z[1] + gap * (z[2] - z[1])) AS x FROM syn
        UNION ALL SELECT label, vec_id, NULL, x FROM e)""", """
SELECT label, vec_id, synthetic_id, synthetic_id IS NOT NULL AS synthetic, x[1] AS x_first, x[len(x)] AS x_last,
       list_sum(list_transform(x, lambda v, i: v * i)) AS x_weighted FROM vec"""))
def q_smote(spark, sf):
    """SMOTE on the embedding table: every class raised to the majority size, with a digest of each vector."""
    x = F.col("features")
    weighted = F.aggregate(F.transform(x, lambda v, i: v * (i + 1)), F.lit(0.0), lambda s, v: s + v)
    return TR.smote_oversample(_embeddings(spark, sf), "label", "vec_id").select(
        "label", "vec_id", "synthetic_id", "synthetic", F.get(x, F.lit(0)).alias("x_first"),
        F.element_at(x, -1).alias("x_last"), weighted.alias("x_weighted"))


@register("svd_fit")
def q_svd_fit(spark, sf):
    """Singular values and explained variance of the review TF-IDF matrix."""
    _, _, model = PL.feature_pipeline(_weak_init(spark, sf))
    return SV.singular_values_frame(spark, model)


@register("save_svd_components")
def q_svd_components(spark, sf):
    _, vocab, model = PL.feature_pipeline(_weak_init(spark, sf))
    return SV.components_frame(spark, model, vocab, 10)


@register("svd_transform")
def q_svd_transform(spark, sf):
    feats, _, _ = PL.feature_pipeline(_weak_init(spark, sf))
    return feats.select("ingest_seq", "svd")


@register("assemble_features")
def q_assemble(spark, sf):
    feats, _, _ = PL.feature_pipeline(_weak_init(spark, sf))
    return feats.select("ingest_seq", "weak_label", "confidence", "text_length", "features")


#: Components of the given basis: orthonormal cosines over the vocabulary (DCT-IV), a rule that SQL states as well.
GIVEN_K = 8
_GIVEN = O.with_ctes(O.cleaned_ctes() + O.tfidf_ctes() + f""",
gd AS (SELECT count(*) AS d FROM tf_vocab),
basis AS (SELECT CAST(c AS INTEGER) AS component, feature_index, sqrt(2.0 / d) * cos(pi() / d * (feature_index + 0.5) * (c + 0.5)) AS loading
          FROM tf_vocab, gd, range({GIVEN_K}) r(c)),
proj AS (SELECT n.ingest_seq, c.component, coalesce(sum(l.weight * b.loading), 0.0) AS x
         FROM nonempty n CROSS JOIN (SELECT DISTINCT component FROM basis) c
         LEFT JOIN tf_long l ON l.doc_key = n.ingest_seq
         LEFT JOIN basis b ON b.component = c.component AND b.feature_index = l.feature_index
         GROUP BY n.ingest_seq, c.component)""", "{}")


def _given(spark, sf):
    """(sparse rows of all cleaned reviews, vocabulary, model of the given basis)"""
    from ..session import cut_lineage
    corpus = _tf_corpus(spark, sf).select("ingest_seq", "text_clean", "text_length")
    vocab = TF.tfidf_fit(corpus, "ingest_seq")
    d = vocab.count()
    c = F.explode(F.sequence(F.lit(0), F.lit(GIVEN_K - 1))).alias("component")
    loading = F.sqrt(F.lit(2.0 / max(d, 1))) * F.cos(F.lit(_np.pi / max(d, 1)) * (F.col("feature_index") + 0.5) * (F.col("component") + 0.5))
    basis = vocab.select("feature_index", c).withColumn("loading", loading)
    sparse = cut_lineage(TF.tfidf_columns(corpus, vocab).drop("text_clean"))
    return sparse, vocab, SV.model_from_basis(basis, d)


@register("svd_transform_given", _GIVEN.replace("{}", "SELECT ingest_seq, component, x FROM proj"))
def q_svd_transform_given(spark, sf):
    """Projection of every cleaned review onto a given orthonormal basis."""
    sparse, _, model = _given(spark, sf)
    return SV.svd_transform(sparse, model).select("ingest_seq", F.posexplode("svd").alias("component", "x"))


@register("assemble_features_given", _GIVEN.replace("{}", f"""
SELECT p.ingest_seq, {GIVEN_K + 1} AS n_features, max(x) FILTER (WHERE component = 0) AS first_feature,
       CAST(max(n.text_length) AS DOUBLE) AS last_feature, sum(x * (component + 1)) + max(n.text_length) * {GIVEN_K + 1} AS weighted
FROM proj p JOIN nonempty n ON n.ingest_seq = p.ingest_seq GROUP BY p.ingest_seq"""))
def q_assemble_given(spark, sf):
    """Components of a given basis followed by the text length, as one feature array."""
    sparse, _, model = _given(spark, sf)
    x = F.col("features")
    weighted = F.aggregate(F.transform(x, lambda v, i: v * (i + 1)), F.lit(0.0), lambda s, v: s + v)
    return TR.assemble_features(SV.svd_transform(sparse, model)).select(
        "ingest_seq", F.size(x).alias("n_features"), F.get(x, F.lit(0)).alias("first_feature"),
        F.element_at(x, -1).alias("last_feature"), weighted.alias("weighted"))


@register("save_svd_components_given", _GIVEN.replace("{}", """
SELECT component, feature_name, loading FROM basis JOIN tf_vocab USING (feature_index)"""))
def q_svd_components_given(spark, sf):
    """The component export of a model whose basis is given."""
    _, vocab, model = _given(spark, sf)
    return SV.components_frame(spark, model, vocab, 10)


@register("explained_variance_given", _GIVEN.replace("{}", """
SELECT component, var_pop(x) AS explained_variance, var_pop(x) / (
         SELECT sum(q / n - (s / n) * (s / n)) FROM (SELECT sum(weight) AS s, sum(weight * weight) AS q FROM tf_long GROUP BY feature_index),
                (SELECT count(*) AS n FROM nonempty)) AS explained_variance_ratio
FROM proj GROUP BY component"""))
def q_explained_given(spark, sf):
    """Variance along each component of a given basis, and its share of the features' variance."""
    sparse, _, model = _given(spark, sf)
    return SV.explained_variance(SV.svd_transform(sparse, model))


@register("svd_gramian", O.with_ctes(O.cleaned_ctes() + O.tfidf_ctes() + """,
ds AS (SELECT doc_key, sum(weight) AS total FROM tf_long GROUP BY doc_key)""", """
SELECT feature_index, sum(weight * weight) AS diagonal, sum(weight * total) AS row_sum, sum(weight) AS column_sum
FROM tf_long JOIN ds USING (doc_key) GROUP BY feature_index"""))
def q_gramian(spark, sf):
    """The Gramian that the exact SVD is taken from: its diagonal and row sums, and the column sums of the matrix."""
    corpus = _tf_corpus(spark, sf).select("ingest_seq", "text_clean")
    vocab = TF.tfidf_fit(corpus, "ingest_seq")
    G, sums, _ = SV.gramian(TF.tfidf_columns(corpus, vocab), vocab.count())
    rows = [(i, float(G[i, i]), float(G[i].sum()), float(sums[i])) for i in range(len(G))]
    return spark.createDataFrame(rows, "feature_index int, diagonal double, row_sum double, column_sum double")


@register("random_forest_fit")
def q_forest(spark, sf):
    """Forest on the embedding table (reference settings: 200 trees, depth 25)."""
    e = _embeddings(spark, sf)
    from pyspark.ml.functions import array_to_vector
    split = TR.stratified_split(e, "label", ["vec_id"]).withColumn("features_vec", array_to_vector("features"))
    model = TR.random_forest_fit(split.where("split = 'train'"), label_col="label")
    return TR.random_forest_predict(model, split.where("split = 'test'")).select(
        "vec_id", "label", "predicted_label", "prediction_confidence")

# ------------------------------------------------------------------ trained pipeline, persistence, scoring

from . import models as MD  # noqa: E402

_TRAINED: dict = {}


def _version(spark, sf, *tables) -> tuple:
    """Files of the input tables with their sizes and modification times: a changed table is another input."""
    out = []
    for t in tables:
        m = FX.read_table(spark, sf, t).select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
        out += [tuple(map(str, r)) for r in m.distinct().collect()]
    return tuple(sorted(out))


def _trained(spark, sf):
    """Clean -> weak labels -> features -> SMOTE -> forest, once per session and state of the documents' files."""
    k = (spark.sparkContext.applicationId, sf, _version(spark, sf, "documents"))
    if k not in _TRAINED:
        feats, vocab, svd = PL.feature_pipeline(_fitted_labels(spark, sf))
        model, pred, res = PL.train_pipeline(feats)
        _TRAINED[k] = (MD.Artifacts(vocab, svd, model), pred, res, feats)
    return _TRAINED[k]


@register("train_pipeline")
def q_train_pipeline(spark, sf):
    """Held-out report of the forest trained on SMOTE-balanced weak labels."""
    from ..operators import evaluation as EV
    _, pred, _, _ = _trained(spark, sf)
    return EV.classification_report(pred, "weak_label", "predicted_label")


@register("random_forest_predict")
def q_forest_predict(spark, sf):
    _, pred, _, _ = _trained(spark, sf)
    return pred.select("ingest_seq", "weak_label", "predicted_label", "prediction_confidence")


@register("feature_importance")
def q_importance(spark, sf):
    art, _, _, _ = _trained(spark, sf)
    names = [f"tfidf_svd_{i}" for i in range(art.svd.k)] + ["text_length"]
    return TR.feature_importance(spark, art.forest, names, 10)


@register("cross_validate")
def q_cv(spark, sf):
    """3-fold accuracy over the SMOTE output (as originally done), mean and std rows."""
    _, _, res, _ = _trained(spark, sf)
    return TR.cross_validate(res, "weak_label", ["ingest_seq", "synthetic_id"], folds=3)


@register("cross_validate_before_smote")
def q_cv_before(spark, sf):
    """3-fold accuracy on the embedding table where each fold's training part is oversampled by itself."""
    return TR.cross_validate(_embeddings(spark, sf), "label", "vec_id", folds=3, folds_before_smote=True)


@register("explained_variance")
def q_explained(spark, sf):
    art, _, _, _ = _trained(spark, sf)
    return SV.singular_values_frame(spark, art.svd).agg(
        F.sum("explained_variance_ratio").alias("explained_variance_ratio"), F.count(F.lit(1)).alias("n_components"))


@register("model_save_load")
def q_model_io(spark, sf):
    """Save vocabulary, SVD and forest to shared storage, load them back and
    score the held-out rows with the loaded copy."""
    art, pred, _, feats = _trained(spark, sf)
    path = MD.model_save(art, MD.shared_dir(spark, "model"))
    loaded = MD.model_load(spark, path)
    held = FX.fx_reviews(spark, sf).join(pred.select("ingest_seq"), "ingest_seq")   # raw texts of the held-out rows
    return MD.score_reviews(held, loaded, "ingest_seq", "text")


@register("gold_evaluation_pipeline")
def q_gold_eval(spark, sf):
    """Gold set scored with the saved featurisation and forest, then reported."""
    from ..operators import evaluation as EV
    art, _, _, _ = _trained(spark, sf)
    res = MD.gold_evaluation(_pred(spark, sf).drop("predicted_label", "prediction_confidence"), art)
    return EV.evaluation_summary(res)


@register("evaluation_summary", O.with_ctes(O.gold_ctes() + """,
cl AS (SELECT label, (SELECT count(*) FROM fx_pred WHERE gold_label = label) AS support,
              (SELECT count(*) FROM fx_pred WHERE predicted_label = label) AS predicted,
              (SELECT count(*) FROM fx_pred WHERE gold_label = label AND predicted_label = label) AS tp FROM fx_labels),
pr AS (SELECT *, CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS p,
              CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS r FROM cl),
f1 AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f FROM pr),
ev AS (SELECT avg(CASE WHEN gold_label = predicted_label THEN 1.0 ELSE 0.0 END) AS acc, count(*) AS n FROM fx_pred)""", f"""
SELECT 'overall' AS section, 'accuracy' AS name, acc AS value, n AS n_rows FROM ev
UNION ALL SELECT 'class accuracy', {O.label_name_sql('gold_label')},
  avg(CASE WHEN gold_label = predicted_label THEN 1.0 ELSE 0.0 END), count(*) FROM fx_pred GROUP BY gold_label
UNION ALL SELECT 'high confidence', 'accuracy', avg(CASE WHEN gold_label = predicted_label THEN 1.0 ELSE 0.0 END), count(*)
  FROM fx_pred WHERE prediction_confidence > 0.8
UNION ALL SELECT 'precision', {O.label_name_sql('label')}, p, support FROM f1
UNION ALL SELECT 'precision', 'accuracy', NULL, (SELECT n FROM ev)
UNION ALL SELECT 'precision', 'macro avg', avg(p), (SELECT n FROM ev) FROM f1
UNION ALL SELECT 'precision', 'weighted avg', sum(p * support) / sum(support), (SELECT n FROM ev) FROM f1
UNION ALL SELECT 'recall', {O.label_name_sql('label')}, r, support FROM f1
UNION ALL SELECT 'recall', 'accuracy', NULL, (SELECT n FROM ev)
UNION ALL SELECT 'recall', 'macro avg', avg(r), (SELECT n FROM ev) FROM f1
UNION ALL SELECT 'recall', 'weighted avg', sum(r * support) / sum(support), (SELECT n FROM ev) FROM f1
UNION ALL SELECT 'f1_score', {O.label_name_sql('label')}, f, support FROM f1
UNION ALL SELECT 'f1_score', 'accuracy', acc, n FROM ev
UNION ALL SELECT 'f1_score', 'macro avg', avg(f), (SELECT n FROM ev) FROM f1
UNION ALL SELECT 'f1_score', 'weighted avg', sum(f * support) / sum(support), (SELECT n FROM ev) FROM f1"""))
def q_eval_summary(spark, sf):
    """All figures of an evaluation at once, on the fixed prediction table."""
    from ..operators import evaluation as EV
    return EV.evaluation_summary(_pred(spark, sf))


@register("resampling_counts", """
SELECT CAST(label AS INTEGER) AS label, count(*) AS n_before, (SELECT max(c) FROM (SELECT count(*) AS c FROM embeddings GROUP BY label))
  AS n_after FROM embeddings GROUP BY label""")
def q_resampling_counts(spark, sf):
    """Class counts before and after SMOTE."""
    e = _embeddings(spark, sf)
    return TR.resampling_counts(e, TR.smote_oversample(e, "label", "vec_id"), "label")


@register("nonempty_removed", O.with_ctes(O.cleaned_ctes(), """
SELECT (SELECT count(*) FROM cleaned) AS n_before, (SELECT count(*) FROM nonempty) AS n_after,
       (SELECT count(*) FROM cleaned) - (SELECT count(*) FROM nonempty) AS n_removed"""))
def q_nonempty_removed(spark, sf):
    """How many cleaned reviews the non-empty filter removes."""
    from ..session import cut_lineage
    cleaned = cut_lineage(PL.fixture_cleaned(spark, sf))
    return C.removed_count(cleaned, C.nonempty_text(cleaned))


@register("score_reviews")
def q_score(spark, sf):
    """Every raw review text scored (strip only), as single-review inference does."""
    art, _, _, _ = _trained(spark, sf)
    return MD.score_reviews(FX.fx_reviews(spark, sf), art, "ingest_seq", "text")

# ------------------------------------------------------------------ sources / sinks round trips


@register("read_reviews", O.with_ctes(O.fx_reviews_ctes(), """
SELECT user_id, gmap_id, time, rating, text, name, CAST(n_pics AS INTEGER) AS n_pics, resp_present AS has_resp
FROM fx_reviews"""))
def q_read_reviews(spark, sf):
    """Reviews written as JSON lines to shared storage and read back with the
    explicit review schema (malformed lines land in ``_corrupt_record``)."""
    path = MD.shared_dir(spark, "reviews-json")
    FX.fx_reviews(spark, sf).drop("ingest_seq").write.mode("overwrite").json(path)
    df = R.read_reviews(spark, path)
    return df.select("user_id", "gmap_id", "time", "rating", "text", "name",
                     F.size("pics").alias("n_pics"), F.col("resp").isNotNull().alias("has_resp"))


@register("read_meta_json", O.with_ctes(O.fx_meta_ctes(), "SELECT gmap_id, category_all, category_primary FROM fx_meta"))
def q_read_meta_json(spark, sf):
    """Metadata JSON (array or bare-string categories) read back and normalised."""
    path = MD.shared_dir(spark, "meta-json")
    raw = FX.fx_meta_raw(spark, sf).withColumn("arr", F.when(F.col("category").startswith("["),
                                                             F.from_json("category", "array<string>")))
    lines = F.when(F.col("arr").isNotNull(), F.to_json(F.struct("gmap_id", F.col("arr").alias("category")))
                   ).otherwise(F.to_json(F.struct("gmap_id", "category")))
    raw.select(lines.alias("value")).write.mode("overwrite").text(path)
    return C.normalize_meta(R.read_meta(spark, path)).drop("ingest_seq")


_WRITTEN = ("ingest_seq", "user_id", "gmap_id", "time", "rating", "text_clean", "text_length", "word_count", "has_photos")


@register("write_dataset", O.with_ctes(O.cleaned_ctes(), " UNION ALL ".join(
          f"SELECT '{fmt}' AS fmt, {', '.join(_WRITTEN)} FROM cleaned" for fmt in ("parquet", "csv"))))
def q_write(spark, sf):
    """Cleaned reviews, all columns, written as Parquet and as CSV and read back."""
    base = MD.shared_dir(spark, "cleaned")
    from ..session import passing_stages
    with passing_stages(spark):
        R.write_dataset(PL.fixture_cleaned(spark, sf), base + "/parquet", "parquet", compression="zstd")
    df = R.read_stage(spark, base + "/parquet")
    R.write_dataset(df, base + "/csv", "csv", compression="gzip")
    flat = R.flat_schema(df.schema)
    back = [R.read_stage(spark, base + "/parquet").withColumn("fmt", F.lit("parquet")),
            R.read_stage(spark, base + "/csv", "csv", schema=flat).withColumn("fmt", F.lit("csv"))]
    return back[0].select("fmt", *_WRITTEN).unionByName(back[1].select("fmt", *_WRITTEN))


@register("read_labeled_csv", O.with_ctes(O.gold_ctes(), "SELECT doc_id, text_clean, gold_label FROM fx_pred"))
def q_read_csv(spark, sf):
    """A gold-set CSV export read back with header and quoted multi-line text."""
    path = MD.shared_dir(spark, "gold-csv")
    R.write_dataset(_pred(spark, sf).select("doc_id", "text_clean", "gold_label"), path, "csv")
    back = R.read_stage(spark, path, "csv", schema="doc_id long, text_clean string, gold_label int")
    return C.require_columns(back, ["gold_label", "text_clean"])


@register("stream_weak_labels", O.with_ctes(O.init_params_ctes(_R_INIT),
          "SELECT ingest_seq, weak_label, confidence FROM lm_pred"))
def q_stream(spark, sf):
    """Review JSON files taken in by the stream (one available-now run), then
    labelled by the batch operators over everything taken in."""
    from ..session import cut_lineage
    from ..streaming import ingest as ST
    base = MD.shared_dir(spark, "stream")
    FX.fx_reviews(spark, sf).write.mode("overwrite").json(base + "/in")
    ST.start(spark, base + "/in", base + "/stage", base + "/ckpt", available_now=True).awaitTermination()
    cleaned = PL.clean_pipeline(ST.stage(spark, base + "/stage"), FX.fx_meta_raw(spark, sf))
    votes = cut_lineage(LB.apply_lfs(C.nonempty_text(cleaned)))
    return LM.weak_labels(votes, _init_params(votes)).select("ingest_seq", "weak_label", "confidence")

# ------------------------------------------------------------------ one query per labeling function (2.5)


def _lf_query(name):
    def q(spark, sf):
        return _votes_alone(spark, sf).select("ingest_seq", name)
    q.__doc__ = f"Votes of {name} on every cleaned review."
    return q


for _name in LFS.DEFAULT_LFS:
    register(_name, O.with_ctes(O.labeled_ctes(), f"SELECT ingest_seq, {_name} FROM lf_votes"))(_lf_query(_name))


@register("lf_never_visited", O.with_ctes(O.labeled_ctes(), f"""
SELECT ingest_seq, CASE WHEN {O.sql_any('tl', K.NEVER_VISITED_PHRASES)} THEN 3 ELSE -1 END AS lf_never_visited
FROM lf_ctx"""))
def q_lf_never_visited(spark, sf):
    """Defined in the original rule set but not part of the default list; available on request."""
    return LB.apply_lfs(PL.fixture_nonempty(spark, sf), lfs=["lf_never_visited"]).select(
        "ingest_seq", "lf_never_visited")


@register("lf_registry", O.with_ctes(O.labeled_ctes(), "\nUNION ALL\n".join(
    f"SELECT {j} AS j, {O.lit(n)} AS lf_name, count(*) FILTER (WHERE {n} <> -1) AS n_votes FROM lf_votes"
    for j, n in enumerate(LFS.DEFAULT_LFS))))
def q_lf_registry(spark, sf):
    """The ordered registry (vote-matrix column order) with the votes each LF casts."""
    votes = _votes_alone(spark, sf)
    names = LB.lf_names()
    wide = votes.agg(*[F.count_if(F.col("votes")[j] != -1).alias(f"n{j}") for j in range(len(names))])
    rows = F.array(*[F.struct(F.lit(j).alias("j"), F.lit(n).alias("lf_name"), F.col(f"n{j}").alias("n_votes"))
                     for j, n in enumerate(names)])
    return wide.select(F.inline(rows))


@register("require_columns", O.with_ctes(O.gold_ctes(), "SELECT doc_id, gold_label, text_clean FROM fx_gold"))
def q_require(spark, sf):
    """Gold set passes the required-column check (a missing column raises before planning)."""
    return C.require_columns(_pred(spark, sf), ["gold_label", "text_clean"]).select("doc_id", "gold_label",
                                                                                  "text_clean")
