"""Independent DuckDB SQL for the correctness gate.

Each function returns SQL text over the driver's pre-registered views
(``documents``, ``labels``...).  The fixture rules and cleaning steps are
restated in SQL from the same fixed values, never generated from the Spark
plans, so a bug in one engine does not hide in the other.
"""

from __future__ import annotations

from ..constants import WHITESPACE_CLASS
from ..sources import fixtures as FX


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def lit_list(items) -> str:
    return "[" + ", ".join(lit(x) for x in items) + "]"

# ------------------------------------------------------------------ scalar expressions


def sql_strip(x: str) -> str:
    ws = WHITESPACE_CLASS
    return f"regexp_replace({x}, '^{ws}+|{ws}+$', '', 'g')"


def sql_clean_text(x: str) -> str:
    ws = WHITESPACE_CLASS
    return (f"regexp_replace(regexp_replace({sql_strip(x)}, '{ws}+', ' ', 'g'), "
            f"'[^A-Za-z0-9 ]', '', 'g')")


def sql_title(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN NULL ELSE array_to_string(list_transform("
            f"regexp_extract_all(lower({x}), '[^\\p{{L}}]+|\\p{{L}}+'), "
            f"lambda r: upper(substr(r, 1, 1)) || substr(r, 2)), '') END")


def sql_split_wc(x: str) -> str:
    return f"CAST(len(regexp_extract_all({x}, '[^ ]+')) AS BIGINT)"

# ------------------------------------------------------------------ fixtures


def _phrase_case() -> str:
    parts = [f"WHEN {i} THEN {lit(p)}" for i, p in enumerate(FX.PHRASES) if p is not None]
    return "CASE doc_id % 20 " + " ".join(parts) + " ELSE NULL END"


def fx_reviews_ctes() -> str:
    return f"""
fx_base AS (
  SELECT doc_id AS ingest_seq,
         'u' || CAST(doc_id % {FX.N_USERS} AS VARCHAR) AS user_id,
         'g' || CAST(doc_id // {FX.DOCS_PER_BUSINESS} AS VARCHAR) AS gmap_id,
         CAST({FX.BASE_TIME_MS} + doc_id * {FX.HOUR_MS} AS BIGINT) AS time,
         CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 41 = 0 THEN 7.0
              ELSE CAST(1 + (doc_id // 3) % 5 AS DOUBLE) END AS rating,
         {_phrase_case()} AS phrase,
         CASE WHEN {_phrase_case()} IS NULL THEN text ELSE {_phrase_case()} || ' ' || text END AS text,
         CASE WHEN doc_id % 11 = 0 THEN NULL
              ELSE 'o''neil user-' || CAST(doc_id % {FX.N_USERS} AS VARCHAR) END AS name,
         CASE WHEN doc_id % 3 = 0 THEN doc_id % 4 END AS n_pics,
         (doc_id % 6 = 0) AS resp_present
  FROM documents),
fx_reviews AS (
  SELECT * EXCLUDE (phrase) FROM fx_base
  UNION ALL
  SELECT ingest_seq + {FX.SHORT_OFFSET}, user_id, gmap_id, time + {FX.SHORT_DELAY_MS}, rating, phrase, name, n_pics,
         resp_present
  FROM fx_base WHERE ingest_seq % {FX.SHORT_EVERY} = {FX.SHORT_SLOT}
  UNION ALL
  SELECT ingest_seq + {FX.EXACT_COPY_OFFSET}, user_id, gmap_id, time, rating, text, name, n_pics, resp_present
  FROM fx_base WHERE ingest_seq % 10 = 4
  UNION ALL
  SELECT ingest_seq + {FX.EDIT_COPY_OFFSET}, user_id, gmap_id, time, rating, {lit(FX.EDITED_TEXT)}, name, n_pics,
         resp_present
  FROM fx_base WHERE ingest_seq % 10 = 3)"""


def fx_meta_ctes() -> str:
    cats = "[" + ", ".join(lit(FX._category_json(c)) for c in FX.CATEGORIES) + "]"
    n = len(FX.CATEGORIES)
    return f"""
fx_biz AS (SELECT DISTINCT doc_id // {FX.DOCS_PER_BUSINESS} AS b FROM documents),
fx_meta_raw AS (
  SELECT CAST(b * 2 AS BIGINT) AS ingest_seq, 'g' || CAST(b AS VARCHAR) AS gmap_id,
         {cats}[b % {FX.N_CATEGORY_SLOTS} + 1] AS category
  FROM fx_biz WHERE b % {FX.N_CATEGORY_SLOTS} < {n}
  UNION ALL
  SELECT CAST(b * 2 + 1 AS BIGINT), 'g' || CAST(b AS VARCHAR), {lit(FX._category_json(FX.SECOND_ROW_CATEGORY))}
  FROM fx_biz WHERE b % {FX.N_CATEGORY_SLOTS} = {FX.SECOND_ROW_SLOT}),
fx_meta_cats AS (
  SELECT ingest_seq, gmap_id,
         CASE WHEN category IS NULL THEN CAST([] AS VARCHAR[])
              WHEN ltrim(category) LIKE '[%' THEN CAST(json_extract_string(category, '$[*]') AS VARCHAR[])
              ELSE [category] END AS cats
  FROM fx_meta_raw),
fx_meta AS (
  SELECT ingest_seq, gmap_id, coalesce(array_to_string(cats, ';'), '') AS category_all,
         coalesce(cats[1], '') AS category_primary
  FROM fx_meta_cats),
fx_meta_first AS (
  SELECT * FROM fx_meta QUALIFY row_number() OVER (PARTITION BY gmap_id ORDER BY ingest_seq) = 1)"""


def cleaned_ctes() -> str:
    """fx_reviews -> ... -> ``cleaned`` (the full cleaning sequence)."""
    return fx_reviews_ctes() + "," + fx_meta_ctes() + f""",
joined AS (
  SELECT r.*, m.category_all, m.category_primary
  FROM fx_reviews r LEFT JOIN fx_meta_first m ON r.gmap_id IS NOT DISTINCT FROM m.gmap_id),
dedup_raw AS (
  SELECT * FROM joined
  QUALIFY row_number() OVER (PARTITION BY gmap_id, user_id, time, text ORDER BY ingest_seq) = 1),
filled AS (
  SELECT ingest_seq, user_id, gmap_id, time, category_all, category_primary,
         epoch_ms(time) AS ts,
         coalesce(rating, (SELECT median(rating) FROM dedup_raw)) AS rating,
         coalesce(text, 'NONE') AS text, coalesce(name, 'NONE') AS name,
         n_pics, resp_present
  FROM dedup_raw),
derived AS (
  SELECT *, {sql_clean_text('text')} AS text_clean
  FROM filled),
derived2 AS (
  SELECT ingest_seq, user_id, gmap_id, time, rating, category_all, category_primary, text,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp_str,
         CAST(ts AS DATE) AS date, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
         (n_pics IS NOT NULL) AS has_photos, CAST(coalesce(n_pics, 0) AS BIGINT) AS photo_count,
         text_clean, CAST(length(text_clean) AS BIGINT) AS text_length, {sql_split_wc('text_clean')} AS word_count,
         {sql_title(sql_strip('name'))} AS name_clean,
         TRUE AS has_response, CAST(CASE WHEN resp_present THEN 2 ELSE 4 END AS BIGINT) AS response_length
  FROM derived),
dedup_event AS (
  SELECT * FROM derived2
  QUALIFY row_number() OVER (PARTITION BY user_id, gmap_id, time ORDER BY ingest_seq) = 1),
counted AS (
  SELECT *,
         CASE WHEN user_id IS NULL THEN NULL ELSE count(*) OVER (PARTITION BY user_id) END AS user_review_count,
         CASE WHEN gmap_id IS NULL THEN NULL ELSE count(*) OVER (PARTITION BY gmap_id) END
           AS business_review_count
  FROM dedup_event),
len_bounds AS (
  SELECT round(quantile_cont(text_length, 0.01), 6) AS lo, round(quantile_cont(text_length, 0.99), 6) AS hi
  FROM counted),
cleaned AS (
  SELECT c.* FROM counted c, len_bounds b
  WHERE c.text_length >= b.lo AND c.text_length <= b.hi AND c.rating BETWEEN 1 AND 5),
nonempty0 AS (
  SELECT * REPLACE (CASE WHEN text_clean IN ('NA', 'NULL', 'NaN', 'None', 'nan', 'null') THEN ''
                         ELSE coalesce(text_clean, '') END AS text_clean)
  FROM cleaned),
nonempty AS MATERIALIZED (SELECT * FROM nonempty0 WHERE trim(text_clean) <> '')"""


CLEANED_CHECK_COLUMNS = [
    "ingest_seq", "user_id", "gmap_id", "time", "rating", "category_all", "category_primary",
    "timestamp_str", "date", "year", "month", "has_photos", "photo_count", "text_clean", "text_length",
    "word_count", "name_clean", "has_response", "response_length", "user_review_count", "business_review_count",
]


def with_ctes(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip().rstrip(",") + "\n" + body

# ------------------------------------------------------------------ labeling functions

from .. import constants as K  # noqa: E402
from ..functions.lfs import DEFAULT_LFS  # noqa: E402


def sql_any(x: str, terms) -> str:
    return "(" + " OR ".join(f"contains({x}, {lit(t)})" for t in terms) + ")"


def sql_rx(x: str, rx: str, ci: bool = False) -> str:
    return f"regexp_matches({x}, {lit(rx)}" + (", 'i')" if ci else ")")


def sql_family(cat: str) -> str:
    low = f"lower(coalesce({cat}, ''))"
    parts = [f"WHEN {sql_any(low, keys)} THEN {lit(fam)}" for fam, keys in K.FAMILY_MAP.items()]
    return "CASE " + " ".join(parts) + f" ELSE {lit(K.GENERIC_FAMILY)} END"


def sql_domain(fam: str) -> str:
    parts = [f"WHEN {fam} = {lit(f)} THEN {lit_list(t)}" for f, t in K.DOMAIN_TERMS.items() if t]
    return "CASE " + " ".join(parts) + " ELSE CAST([] AS VARCHAR[]) END"


def _v(cond: str, label: int) -> str:
    return f"CASE WHEN {cond} THEN {label} ELSE -1 END"


def sql_lf_votes() -> dict[str, str]:
    """Vote expression per LF over the ``lf_ctx`` columns."""
    v = {}
    v["lf_contains_url_phone_email"] = _v(
        f"({sql_rx('tl', K.URL_RX)} OR {sql_rx('tl', K.EMAIL_RX)} OR {sql_rx('tl', K.PHONE_RX)})", 1)
    v["lf_contains_promo_words"] = _v(sql_any("tl", K.PROMO_WORDS), 1)
    v["lf_promotion_social_handles"] = _v(sql_rx("tl", K.SOCIAL_RX), 1)
    v["lf_offdomain_by_category"] = _v(
        f"fam <> 'generic' AND len(tok) >= 25 AND ftot > 0 AND NOT (fhits >= 2 OR CAST(fhits AS DOUBLE) / ftot >= 0.12)"
        f" AND CAST(ftot - fhits AS DOUBLE) / ftot > 0.9", 2)
    v["lf_irrelevant_generic_template"] = _v(sql_rx("trim(t)", K.GENERIC_TEMPLATE_RX, True), 2)
    v["lf_irrelevant_other_business_compare"] = _v(
        f"wc >= 12 AND {sql_rx('tl', K.COMPARE_RX)} AND {sql_rx('t', K.PROPER_NAME_RX)}", 2)
    v["lf_irrelevant_politics"] = _v(sql_rx("t", K.POLITICS_RX, True), 2)
    v["lf_irrelevant_employment"] = _v(sql_rx("t", K.EMPLOYMENT_RX, True), 2)
    v["lf_irrelevant_too_short"] = _v("wc < 2", 2)
    hit = f"(wc <= 6 AND {sql_any('trim(tl)', K.GENERIC_SHORT_PHRASES)})"
    v["lf_generic_short_review"] = (f"CASE WHEN {hit} AND rating IS NOT NULL AND rating >= 4 THEN 0 "
                                    f"WHEN {hit} THEN 2 ELSE -1 END")
    v["lf_rant_never_visit_explicit"] = _v("x_explicit", 3)
    v["lf_rant_never_visit_hearsay"] = _v(f"x_hearsay AND {sql_any('tl', K.HEARSAY_NEGATIVE)}", 3)
    v["lf_rant_never_visit_phone_only"] = _v("x_phone AND (x_explicit OR x_hearsay OR x_driveby)", 3)
    v["lf_rant_never_visit_driveby"] = _v("x_driveby", 3)
    v["lf_rant_never_visit_closed_no_entry"] = _v(sql_rx("t", K.CLOSED_NO_ENTRY_RX, True), 3)
    v["lf_rant_never_visit_metadata_boost"] = _v(
        "(x_explicit OR x_driveby OR x_phone) AND NOT coalesce(has_photos, false) AND wc <= 40", 3)
    v["lf_high_quality_signal"] = _v(f"{sql_any('pad', K.HQ_FIRST_PERSON)} AND {sql_any('pad', K.HQ_PAST_TENSE)}", 0)
    v["lf_genuine_first_person"] = _v(f"{sql_any('pad', K.FP_PRONOUNS)} AND {sql_any('pad', K.FP_VERBS)}", 0)
    v["lf_genuine_descriptive"] = _v(f"wc >= 12 AND {sql_any('pad', K.DESCRIPTIVE_TERMS)}", 0)
    v["lf_genuine_domain_hits"] = _v("fam <> 'generic' AND len(tok) >= 6 AND hits >= 3", 0)
    v["lf_genuine_rating_len"] = _v("rating IS NOT NULL AND rating >= 4 AND wc >= 15", 0)
    v["lf_genuine_photos_or_response"] = _v(
        "(coalesce(has_photos, false) AND coalesce(photo_count, 0) > 0) OR coalesce(has_response, false)", 0)
    v["lf_rating_based_genuine"] = _v("coalesce(rating, 0.0) >= 4 AND coalesce(word_count, 0) >= 5", 0)
    return v


def lf_ctes(src: str = "nonempty", text_col: str = "text_clean", cat: str | None = None) -> str:
    cat = cat or "coalesce(nullif(category_primary, ''), category_all, '')"
    votes = sql_lf_votes()
    vote_cols = ", ".join(f"{votes[n]} AS {n}" for n in DEFAULT_LFS)
    return f""",
lf_ctx0 AS (SELECT *, coalesce(CAST({text_col} AS VARCHAR), '') AS t, {sql_family(cat)} AS fam FROM {src}),
lf_ctx1 AS (SELECT *, lower(t) AS tl, CAST(len(regexp_extract_all(t, {lit(K.WORD_RX)})) AS BIGINT) AS wc FROM lf_ctx0),
lf_ctx2 AS (
  SELECT *, ' ' || tl || ' ' AS pad, regexp_extract_all(tl, {lit(K.LETTER_TOKEN_RX)}) AS tok, {sql_domain('fam')} AS dom,
         {sql_rx('t', K.NEVER_EXPLICIT_RX, True)} AS x_explicit, {sql_rx('t', K.HEARSAY_RX, True)} AS x_hearsay,
         {sql_rx('t', K.DRIVEBY_RX, True)} AS x_driveby, {sql_rx('t', K.PHONE_ONLY_RX, True)} AS x_phone
  FROM lf_ctx1),
lf_ctx3 AS (
  SELECT *, len(list_filter(tok, lambda x: list_contains(dom, x))) AS hits,
         list_filter(tok, lambda x: NOT list_contains({lit_list(K.WHITELIST_COMMON)}, x)) AS ftok
  FROM lf_ctx2),
lf_ctx AS (SELECT *, len(ftok) AS ftot, len(list_filter(ftok, lambda x: list_contains(dom, x))) AS fhits FROM lf_ctx3),
lf_votes AS (SELECT *, {vote_cols} FROM lf_ctx),
lf_arr AS MATERIALIZED (SELECT *, [{", ".join(DEFAULT_LFS)}] AS votes FROM lf_votes)"""


def labeled_ctes() -> str:
    return cleaned_ctes() + lf_ctes()


def sql_lf_summary() -> str:
    parts = []
    for j, n in enumerate(DEFAULT_LFS):
        parts.append(f"""SELECT {j} AS j, {lit(n)} AS lf_name,
  coalesce(array_to_string(list_sort(list_distinct(list({n}) FILTER (WHERE {n} <> -1))), ','), '') AS polarity,
  count(*) FILTER (WHERE {n} <> -1) / count(*) AS coverage,
  count(*) FILTER (WHERE {n} <> -1 AND n_votes > 1) / count(*) AS overlaps,
  count(*) FILTER (WHERE {n} <> -1 AND n_labels > 1) / count(*) AS conflicts
FROM lf_rc""")
    return with_ctes(labeled_ctes() + """,
lf_rc AS MATERIALIZED (SELECT *, len(list_filter(votes, lambda x: x <> -1)) AS n_votes,
                 len(list_distinct(list_filter(votes, lambda x: x <> -1))) AS n_labels FROM lf_arr)""",
                     "\nUNION ALL\n".join(parts))


def sql_lf_coverage() -> str:
    parts = [f"SELECT {j} AS j, {lit(n)} AS lf_name, count(*) FILTER (WHERE {n} <> -1) * 100.0 / count(*) "
             f"AS coverage_pct FROM lf_arr" for j, n in enumerate(DEFAULT_LFS)]
    return with_ctes(labeled_ctes(), "\nUNION ALL\n".join(parts))


def sql_overlap_matrix(k: int = 4) -> str:
    return with_ctes(labeled_ctes() + f""",
lf_idx AS (SELECT list_filter(list_transform(votes, lambda x, i: CASE WHEN x <> -1 THEN (i - 1) * {k} + x END),
                              lambda y: y IS NOT NULL) AS idx FROM lf_arr),
lf_a AS (SELECT unnest(idx) AS a, idx FROM lf_idx),
lf_ab AS (SELECT a, unnest(idx) AS b FROM lf_a)""", """
SELECT CAST(a AS INTEGER) AS a, CAST(b AS INTEGER) AS b, count(*) / (SELECT count(*) FROM lf_arr) AS value
FROM lf_ab GROUP BY a, b""")


def triplet_ctes(prec_init: float = 0.7, k: int = 4, min_cov: float = 1e-6) -> str:
    """lm_mu (j, vote, y, mu): the closed-form start of the label model, uniform classes."""
    p = 1.0 / k
    return labeled_ctes() + f""",
tr_v AS (SELECT CAST(j AS INTEGER) - 1 AS j, CAST(votes[j] AS INTEGER) AS y, ingest_seq FROM lf_arr, range(1, {len(DEFAULT_LFS)} + 1) r(j)),
tr_n AS (SELECT count(*) AS n FROM lf_arr),
tr_g AS (SELECT j, y FROM range({len(DEFAULT_LFS)}) a(j), range({k}) b(y)),
tr_m AS (SELECT g.j, g.y, count(v.ingest_seq) / (SELECT n FROM tr_n) AS m FROM tr_g g LEFT JOIN tr_v v ON v.j = g.j AND v.y = g.y GROUP BY ALL),
tr_o AS (SELECT a.j AS i, b.j AS j, a.y, count(*) / (SELECT n FROM tr_n) AS o
         FROM tr_v a JOIN tr_v b ON a.ingest_seq = b.ingest_seq AND a.y = b.y AND a.j <> b.j WHERE a.y >= 0 GROUP BY ALL),
tr_c AS (SELECT a.j AS i, b.j AS j, a.y, coalesce(o.o, 0.0) - a.m * b.m AS c
         FROM tr_m a JOIN tr_m b ON a.y = b.y AND a.j <> b.j LEFT JOIN tr_o o ON o.i = a.j AND o.j = b.j AND o.y = a.y),
tr_u AS (SELECT * FROM tr_c WHERE abs(c) > {min_cov!r}),
tr_q AS (SELECT a.j, a.y, a.c * b.c / ik.c AS q
         FROM (SELECT j, i, y, c FROM tr_u) a JOIN tr_u b ON b.j = a.j AND b.y = a.y AND b.i > a.i
         JOIN tr_u ik ON ik.i = a.i AND ik.j = b.i AND ik.y = a.y),
tr_d AS (SELECT j, y, sqrt(median(q) / {p * (1 - p)!r}) AS d FROM tr_q WHERE q > 0 GROUP BY j, y),
tr_p AS (SELECT m.j, m.y, CASE WHEN d IS NULL THEN m.m * {prec_init!r} / {p!r} ELSE m.m + {1 - p!r} * d END AS yes,
                CASE WHEN d IS NULL THEN (m.m - {p!r} * least(m.m * {prec_init!r} / {p!r}, 1.0)) / {1 - p!r} ELSE m.m - {p!r} * d END AS no
         FROM tr_m m LEFT JOIN tr_d d ON d.j = m.j AND d.y = m.y),
lm_mu AS (SELECT CAST(t.j AS INTEGER) AS j, CAST(t.y AS INTEGER) AS vote, CAST(c.y AS INTEGER) AS y,
                 least(greatest(CASE WHEN t.y = c.y THEN yes ELSE no END, 0.0), 1.0) AS mu FROM tr_p t, range({k}) c(y))"""


def init_params_ctes(r: float, prec_init: float = 0.7, k: int = 4) -> str:
    """Posteriors under the moment-initialised parameters (no SGD epochs):
    mu[j,y,y] = r * clamp(cov(j,y) * prec_init / p_y, 0, 1), other entries 0,
    clipped to [0.01, 0.99] before the log."""
    m = len(DEFAULT_LFS)
    covs = ", ".join(f"count(*) FILTER (WHERE {n} = {c}) / count(*) AS cov_{j}_{c}"
                     for j, n in enumerate(DEFAULT_LFS) for c in range(k))
    scores = []
    for y in range(k):
        terms = [f"ln({1.0 / k!r})"]
        for j, n in enumerate(DEFAULT_LFS):
            mu = f"least(greatest(least(greatest(cov_{j}_{y} * {prec_init!r} / {1.0 / k!r}, 0.0), 1.0) * {r!r}, 0.01), 0.99)"
            terms.append(f"CASE WHEN {n} = -1 THEN 0.0 WHEN {n} = {y} THEN ln({mu}) ELSE ln(0.01) END")
        scores.append(" + ".join(terms) + f" AS s{y}")
    probs = ", ".join(f"exp(s{y} - mx) / ({' + '.join(f'exp(s{i} - mx)' for i in range(k))}) AS p{y}"
                      for y in range(k))
    assert m == 23
    return labeled_ctes() + f""",
lm_cov AS (SELECT {covs} FROM lf_arr),
lm_s AS (SELECT a.*, {", ".join(scores)} FROM lf_arr a, lm_cov),
lm_m AS (SELECT *, greatest(s0, s1, s2, s3) AS mx FROM lm_s),
lm_p AS (SELECT *, {probs} FROM lm_m),
lm_pred AS (
  SELECT *, p0 AS prob_genuine, p1 AS prob_promotion, p2 AS prob_irrelevant, p3 AS prob_rant,
         CASE WHEN len(list_filter([p0, p1, p2, p3], lambda p: abs(p - greatest(p0, p1, p2, p3)) < 1e-5)) = 1
              THEN CAST(list_position(list_transform([p0, p1, p2, p3],
                        lambda p: abs(p - greatest(p0, p1, p2, p3)) < 1e-5), true) - 1 AS INTEGER)
              ELSE -1 END AS weak_label,
         greatest(p0, p1, p2, p3) AS confidence
  FROM lm_p)"""

# ------------------------------------------------------------------ gold set / predictions


def gold_ctes() -> str:
    return f"""
fx_gold0 AS (
  SELECT l.doc_id, {sql_clean_text('d.text')} AS text_clean,
         CAST(CASE WHEN l.toxic = 1 THEN 3 WHEN l.quality = 1 AND l.doc_id % 5 <> 0 THEN 0
                   WHEN l.quality = 1 THEN 1 ELSE 2 END AS INTEGER) AS gold_label
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
fx_gold AS (SELECT * FROM fx_gold0
            WHERE trim(CASE WHEN text_clean IN ('NA', 'NULL', 'NaN', 'None', 'nan', 'null') THEN ''
                            ELSE coalesce(text_clean, '') END) <> ''),
fx_pred AS (
  SELECT doc_id, text_clean, gold_label,
         CAST((gold_label + CASE WHEN doc_id % 4 = 0 THEN 1 ELSE 0 END) % 4 AS INTEGER) AS predicted_label,
         CAST(0.25 + CAST(doc_id % 76 AS DOUBLE) / 100.0 AS DOUBLE) AS prediction_confidence
  FROM fx_gold),
fx_cm AS (SELECT gold_label AS true_label, predicted_label AS pred_label, count(*) AS n FROM fx_pred GROUP BY ALL),
fx_labels AS (SELECT DISTINCT label FROM (SELECT gold_label AS label FROM fx_pred UNION ALL
                                          SELECT predicted_label FROM fx_pred) WHERE label IS NOT NULL)"""


LABEL_NAME_SQL = ("CASE {c} WHEN -1 THEN 'ABSTAIN' WHEN 0 THEN 'GENUINE' WHEN 1 THEN 'PROMOTION' "
                  "WHEN 2 THEN 'IRRELEVANT' WHEN 3 THEN 'RANT' ELSE 'UNKNOWN_' || CAST({c} AS VARCHAR) END")


def label_name_sql(c: str) -> str:
    return LABEL_NAME_SQL.format(c=c)

# ------------------------------------------------------------------ tf-idf


def tfidf_ctes(src: str = "nonempty", key: str = "ingest_seq", max_features: int = 2000, min_df: int = 5,
               max_df: float = 0.8) -> str:
    stop = lit_list(K.SPARK_ENGLISH_STOP_WORDS)
    return f""",
tf_docs AS (
  SELECT {key} AS doc_key,
         list_filter(regexp_extract_all(lower(text_clean), '\\b\\w\\w+\\b'), lambda x: NOT list_contains({stop}, x)) AS toks
  FROM {src}),
tf_terms AS (
  SELECT doc_key, unnest(list_concat(toks, list_transform(range(1, len(toks)),
                                                          lambda i: toks[i] || ' ' || toks[i + 1]))) AS term
  FROM tf_docs),
tf_counts AS (SELECT doc_key, term, count(*) AS cnt FROM tf_terms GROUP BY doc_key, term),
tf_df AS (SELECT term, count(*) AS df, sum(cnt) AS corpus_count FROM tf_counts GROUP BY term),
tf_n AS (SELECT count(*) AS n FROM tf_docs),
tf_top AS (
  SELECT term, df, corpus_count FROM tf_df, tf_n
  WHERE df >= {min_df} AND df <= CAST({max_df!r} AS DOUBLE) * n
  ORDER BY corpus_count DESC, term LIMIT {max_features}),
tf_vocab AS (
  SELECT term AS feature_name, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS feature_index, df,
         ln((1.0 + (SELECT n FROM tf_n)) / (1.0 + df)) + 1.0 AS idf
  FROM tf_top),
tf_w AS (
  SELECT c.doc_key, v.feature_index, (1.0 + ln(c.cnt)) * v.idf AS w
  FROM tf_counts c JOIN tf_vocab v ON c.term = v.feature_name),
tf_norm AS (SELECT doc_key, sqrt(sum(w * w)) AS nrm FROM tf_w GROUP BY doc_key),
tf_long AS (
  SELECT w.doc_key, w.feature_index, CASE WHEN nrm > 0 THEN w / nrm ELSE 0.0 END AS weight
  FROM tf_w w JOIN tf_norm n ON w.doc_key = n.doc_key)"""
