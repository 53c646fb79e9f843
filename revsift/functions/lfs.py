"""Labeling functions as Column expressions, and their registry.

A labeling function (LF) maps a row to a class code or ``ABSTAIN``.  Here
each LF is a builder returning ``F.when(cond, label).otherwise(-1)`` over
built-in expressions, so applying all of them is one projection in
whole-stage codegen, not a Python call per row.  Shared work (lower-cased
text, padded text, word count, letter tokens, category family, pattern
flags) is computed once in a first projection and referenced by name.

User LFs can be registered with :func:`labeling_function`; a builder may
return any Column, including a ``pandas_udf`` call.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from .lexicon import category_family, domain_hits, drop_whitelist, primary_category
from .text import contains_any, letter_tokens, regex_word_count


@dataclass(frozen=True)
class LabelingFunction:
    name: str
    polarity: tuple[int, ...]
    build: Callable[[], Column]


REGISTRY: dict[str, LabelingFunction] = {}


def labeling_function(name: str, polarity: tuple[int, ...]):
    def deco(build):
        REGISTRY[name] = LabelingFunction(name, polarity, build)
        return build
    return deco


def _vote(cond: Column, label: int) -> Column:
    return F.when(cond, F.lit(label)).otherwise(F.lit(K.ABSTAIN))


def _ci(rx: str) -> str:
    return "(?i)" + rx


# helper column names produced by :func:`add_lf_context`
T, TL, PAD, WC, FAM, TOK, FTOK, HITS, FTOT, FHITS = (
    "_lf_t", "_lf_tl", "_lf_pad", "_lf_wc", "_lf_fam", "_lf_tok", "_lf_ftok", "_lf_hits", "_lf_ftot", "_lf_fhits")
X_EXPLICIT, X_HEARSAY, X_DRIVEBY, X_PHONE = "_lf_explicit", "_lf_hearsay", "_lf_driveby", "_lf_phone"
CONTEXT_COLUMNS = [T, TL, PAD, WC, FAM, TOK, FTOK, HITS, FTOT, FHITS, X_EXPLICIT, X_HEARSAY, X_DRIVEBY, X_PHONE]


def add_lf_context(df: DataFrame, text_col: str = "text_clean", category_col: str | None = None) -> DataFrame:
    """First projection: the per-row values several LFs share.

    ``text_col`` / ``category_col`` choose the columns the LFs read (the
    defaults are cleaned text and ``category_primary`` falling back to
    ``category_all``)."""
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    if category_col is None:
        cat = primary_category() if "category_primary" in df.columns else F.lit("")
    else:
        cat = F.coalesce(F.col(category_col), F.lit(""))
    df = df.select("*", t.alias(T))
    df = df.select("*", F.lower(F.col(T)).alias(TL), regex_word_count(F.col(T)).alias(WC),
                   category_family(cat).alias(FAM))
    df = df.select("*", F.concat(F.lit(" "), F.col(TL), F.lit(" ")).alias(PAD),
                   letter_tokens(F.col(TL)).alias(TOK),
                   F.col(T).rlike(_ci(K.NEVER_EXPLICIT_RX)).alias(X_EXPLICIT),
                   F.col(T).rlike(_ci(K.HEARSAY_RX)).alias(X_HEARSAY),
                   F.col(T).rlike(_ci(K.DRIVEBY_RX)).alias(X_DRIVEBY),
                   F.col(T).rlike(_ci(K.PHONE_ONLY_RX)).alias(X_PHONE))
    # the family and the tokens are each read by several expressions below, so the optimiser computes them once per row
    df = df.select("*", drop_whitelist(F.col(TOK)).alias(FTOK))
    return df.select("*", domain_hits(F.col(TOK), F.col(FAM)).alias(HITS), F.size(F.col(FTOK)).alias(FTOT),
                     domain_hits(F.col(FTOK), F.col(FAM)).alias(FHITS))

# ------------------------------------------------------------------ the 23 registered LFs (fixed order)


@labeling_function("lf_contains_url_phone_email", (K.PROMOTION,))
def lf_contains_url_phone_email():
    tl = F.col(TL)
    return _vote(tl.rlike(K.URL_RX) | tl.rlike(K.EMAIL_RX) | tl.rlike(K.PHONE_RX), K.PROMOTION)


@labeling_function("lf_contains_promo_words", (K.PROMOTION,))
def lf_contains_promo_words():
    return _vote(contains_any(F.col(TL), K.PROMO_WORDS), K.PROMOTION)


@labeling_function("lf_promotion_social_handles", (K.PROMOTION,))
def lf_promotion_social_handles():
    return _vote(F.col(TL).rlike(K.SOCIAL_RX), K.PROMOTION)


@labeling_function("lf_offdomain_by_category", (K.IRRELEVANT,))
def lf_offdomain_by_category():
    tot, hits = F.col(FTOT), F.col(FHITS)
    off = tot - hits
    cond = ((F.col(FAM) != K.GENERIC_FAMILY) & (F.size(F.col(TOK)) >= K.OFFDOMAIN_MIN_TOKENS) & (tot > 0)
            & ~((hits >= K.OFFDOMAIN_MAX_DOMAIN_HITS)
                | (hits.cast("double") / tot >= K.OFFDOMAIN_MAX_DOMAIN_RATIO))
            & (off.cast("double") / tot > K.OFFDOMAIN_MIN_OFF_RATIO))
    return _vote(cond, K.IRRELEVANT)


@labeling_function("lf_irrelevant_generic_template", (K.IRRELEVANT,))
def lf_irrelevant_generic_template():
    return _vote(F.trim(F.col(T)).rlike(_ci(K.GENERIC_TEMPLATE_RX)), K.IRRELEVANT)


@labeling_function("lf_irrelevant_other_business_compare", (K.IRRELEVANT,))
def lf_irrelevant_other_business_compare():
    cond = (F.col(WC) >= 12) & F.col(TL).rlike(K.COMPARE_RX) & F.col(T).rlike(K.PROPER_NAME_RX)
    return _vote(cond, K.IRRELEVANT)


@labeling_function("lf_irrelevant_politics", (K.IRRELEVANT,))
def lf_irrelevant_politics():
    return _vote(F.col(T).rlike(_ci(K.POLITICS_RX)), K.IRRELEVANT)


@labeling_function("lf_irrelevant_employment", (K.IRRELEVANT,))
def lf_irrelevant_employment():
    return _vote(F.col(T).rlike(_ci(K.EMPLOYMENT_RX)), K.IRRELEVANT)


@labeling_function("lf_irrelevant_too_short", (K.IRRELEVANT,))
def lf_irrelevant_too_short():
    return _vote(F.col(WC) < 2, K.IRRELEVANT)


@labeling_function("lf_generic_short_review", (K.GENUINE, K.IRRELEVANT))
def lf_generic_short_review():
    hit = (F.col(WC) <= 6) & contains_any(F.trim(F.col(TL)), K.GENERIC_SHORT_PHRASES)
    good = F.col("rating").isNotNull() & (F.col("rating") >= 4)
    return (F.when(hit & good, F.lit(K.GENUINE)).when(hit, F.lit(K.IRRELEVANT))
            .otherwise(F.lit(K.ABSTAIN)))


@labeling_function("lf_rant_never_visit_explicit", (K.RANT,))
def lf_rant_never_visit_explicit():
    return _vote(F.col(X_EXPLICIT), K.RANT)


@labeling_function("lf_rant_never_visit_hearsay", (K.RANT,))
def lf_rant_never_visit_hearsay():
    return _vote(F.col(X_HEARSAY) & contains_any(F.col(TL), K.HEARSAY_NEGATIVE), K.RANT)


@labeling_function("lf_rant_never_visit_phone_only", (K.RANT,))
def lf_rant_never_visit_phone_only():
    never = F.col(X_EXPLICIT) | F.col(X_HEARSAY) | F.col(X_DRIVEBY)
    return _vote(F.col(X_PHONE) & never, K.RANT)


@labeling_function("lf_rant_never_visit_driveby", (K.RANT,))
def lf_rant_never_visit_driveby():
    return _vote(F.col(X_DRIVEBY), K.RANT)


@labeling_function("lf_rant_never_visit_closed_no_entry", (K.RANT,))
def lf_rant_never_visit_closed_no_entry():
    return _vote(F.col(T).rlike(_ci(K.CLOSED_NO_ENTRY_RX)), K.RANT)


@labeling_function("lf_rant_never_visit_metadata_boost", (K.RANT,))
def lf_rant_never_visit_metadata_boost():
    cue = F.col(X_EXPLICIT) | F.col(X_DRIVEBY) | F.col(X_PHONE)
    no_photos = ~F.coalesce(F.col("has_photos"), F.lit(False))
    return _vote(cue & no_photos & (F.col(WC) <= 40), K.RANT)


@labeling_function("lf_high_quality_signal", (K.GENUINE,))
def lf_high_quality_signal():
    p = F.col(PAD)
    return _vote(contains_any(p, K.HQ_FIRST_PERSON) & contains_any(p, K.HQ_PAST_TENSE), K.GENUINE)


@labeling_function("lf_genuine_first_person", (K.GENUINE,))
def lf_genuine_first_person():
    p = F.col(PAD)
    return _vote(contains_any(p, K.FP_PRONOUNS) & contains_any(p, K.FP_VERBS), K.GENUINE)


@labeling_function("lf_genuine_descriptive", (K.GENUINE,))
def lf_genuine_descriptive():
    return _vote((F.col(WC) >= 12) & contains_any(F.col(PAD), K.DESCRIPTIVE_TERMS), K.GENUINE)


@labeling_function("lf_genuine_domain_hits", (K.GENUINE,))
def lf_genuine_domain_hits():
    cond = ((F.col(FAM) != K.GENERIC_FAMILY) & (F.size(F.col(TOK)) >= K.DOMAIN_HITS_MIN_TOKENS)
            & (F.col(HITS) >= K.DOMAIN_HITS_MIN))
    return _vote(cond, K.GENUINE)


@labeling_function("lf_genuine_rating_len", (K.GENUINE,))
def lf_genuine_rating_len():
    return _vote(F.col("rating").isNotNull() & (F.col("rating") >= 4) & (F.col(WC) >= 15), K.GENUINE)


@labeling_function("lf_genuine_photos_or_response", (K.GENUINE,))
def lf_genuine_photos_or_response():
    photos = F.coalesce(F.col("has_photos"), F.lit(False)) & (F.coalesce(F.col("photo_count"), F.lit(0)) > 0)
    return _vote(photos | F.coalesce(F.col("has_response"), F.lit(False)), K.GENUINE)


@labeling_function("lf_rating_based_genuine", (K.GENUINE,))
def lf_rating_based_genuine():
    cond = (F.coalesce(F.col("rating"), F.lit(0.0)) >= 4) & (F.coalesce(F.col("word_count"), F.lit(0)) >= 5)
    return _vote(cond, K.GENUINE)


# Defined but not part of the default set (it was never registered in the original list).
@labeling_function("lf_never_visited", (K.RANT,))
def lf_never_visited():
    return _vote(contains_any(F.col(TL), K.NEVER_VISITED_PHRASES), K.RANT)


DEFAULT_LFS = [
    "lf_contains_url_phone_email", "lf_contains_promo_words", "lf_promotion_social_handles",
    "lf_offdomain_by_category", "lf_irrelevant_generic_template", "lf_irrelevant_other_business_compare",
    "lf_irrelevant_politics", "lf_irrelevant_employment", "lf_irrelevant_too_short", "lf_generic_short_review",
    "lf_rant_never_visit_explicit", "lf_rant_never_visit_hearsay", "lf_rant_never_visit_phone_only",
    "lf_rant_never_visit_driveby", "lf_rant_never_visit_closed_no_entry", "lf_rant_never_visit_metadata_boost",
    "lf_high_quality_signal", "lf_genuine_first_person", "lf_genuine_descriptive", "lf_genuine_domain_hits",
    "lf_genuine_rating_len", "lf_genuine_photos_or_response", "lf_rating_based_genuine",
]


def resolve(lfs=None) -> list[LabelingFunction]:
    names = list(lfs) if lfs is not None else DEFAULT_LFS
    return [REGISTRY[n] if isinstance(n, str) else n for n in names]
