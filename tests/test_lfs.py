"""Labeling-function truth tables and quirks."""

import pytest

from revsift import constants as K
from revsift.functions.lexicon import category_family
from revsift.functions.lfs import DEFAULT_LFS
from revsift.operators.labeling import apply_lfs

SCHEMA = ("text_clean string, text string, rating double, word_count long, has_photos boolean, "
          "photo_count long, has_response boolean, category_primary string, category_all string")


def votes(spark, text, rating=3.0, has_photos=False, photo_count=0, has_response=False, cat="", raw=None,
          text_col="text_clean"):
    wc = len(text.split())
    df = spark.createDataFrame([(text, raw if raw is not None else text, rating, wc, has_photos, photo_count,
                                 has_response, cat, cat)], SCHEMA)
    row = apply_lfs(df, text_col=text_col).first()
    return {n: row[n] for n in DEFAULT_LFS}


CASES = [
    ("lf_contains_url_phone_email", "call 307 555 1234 today", "call me today"),
    ("lf_contains_promo_words", "an ideal spot", "a plain spot"),
    ("lf_promotion_social_handles", "see us on instagram", "see us on the street"),
    ("lf_irrelevant_generic_template", "Nice place", "Nice place here"),
    ("lf_irrelevant_politics", "the election was loud", "the soup was loud"),
    ("lf_irrelevant_employment", "they are hiring now", "they are eating now"),
    ("lf_irrelevant_too_short", "ok", "ok then"),
    ("lf_rant_never_visit_explicit", "I never visited this", "I often visited this"),
    ("lf_rant_never_visit_driveby", "we drove by it", "we drove to it"),
    ("lf_rant_never_visit_closed_no_entry", "no reservation at all", "a reservation at all"),
    ("lf_high_quality_signal", "we ordered soup", "you ordered soup"),
    ("lf_genuine_first_person", "i ate there", "you ate there"),
]


@pytest.mark.parametrize("name,pos,neg", CASES)
def test_truth_table(spark, name, pos, neg):
    assert votes(spark, pos)[name] != K.ABSTAIN
    assert votes(spark, neg)[name] == K.ABSTAIN


def test_hearsay_needs_negative_cue(spark):
    assert votes(spark, "I heard it is a scam")["lf_rant_never_visit_hearsay"] == K.RANT
    assert votes(spark, "I heard it is nice")["lf_rant_never_visit_hearsay"] == K.ABSTAIN


def test_phone_only_needs_never_cue(spark):
    v = votes(spark, "I called twice never been inside")
    assert v["lf_rant_never_visit_phone_only"] == K.RANT
    assert votes(spark, "I called twice")["lf_rant_never_visit_phone_only"] == K.ABSTAIN


def test_metadata_boost_respects_photos(spark):
    assert votes(spark, "we drove by it")["lf_rant_never_visit_metadata_boost"] == K.RANT
    assert votes(spark, "we drove by it", has_photos=True)["lf_rant_never_visit_metadata_boost"] == K.ABSTAIN


def test_generic_short_review_rating_split(spark):
    assert votes(spark, "nice food", rating=5.0)["lf_generic_short_review"] == K.GENUINE
    assert votes(spark, "nice food", rating=2.0)["lf_generic_short_review"] == K.IRRELEVANT
    assert votes(spark, "nice food", rating=None)["lf_generic_short_review"] == K.IRRELEVANT


def test_compare_needs_proper_name(spark):
    t = "this one is way better than the other spot and we liked it a lot"
    assert votes(spark, t)["lf_irrelevant_other_business_compare"] == K.ABSTAIN
    assert votes(spark, t.replace("other spot", "Smith spot"))["lf_irrelevant_other_business_compare"] == K.IRRELEVANT


def test_descriptive_and_rating_len(spark):
    t = "the soup was delicious and the bread was warm and we will come back again soon"
    v = votes(spark, t, rating=5.0)
    assert v["lf_genuine_descriptive"] == K.GENUINE and v["lf_genuine_rating_len"] == K.GENUINE
    assert v["lf_rating_based_genuine"] == K.GENUINE


def test_photos_or_response_always_with_filled_response(spark):
    assert votes(spark, "x", has_response=True)["lf_genuine_photos_or_response"] == K.GENUINE
    assert votes(spark, "x", has_photos=True, photo_count=0)["lf_genuine_photos_or_response"] == K.ABSTAIN
    assert votes(spark, "x", has_photos=True, photo_count=2)["lf_genuine_photos_or_response"] == K.GENUINE


def test_domain_hits(spark):
    t = "the menu food and staff were ok today"
    assert votes(spark, t, cat="Pizza restaurant")["lf_genuine_domain_hits"] == K.GENUINE
    assert votes(spark, t, cat="")["lf_genuine_domain_hits"] == K.ABSTAIN


def _offdomain_text(n_tokens, hits):
    words = ["menu"] * hits + [f"w{chr(97 + i % 26)}x" for i in range(n_tokens - hits)]
    words = [w if w == "menu" else "zz" + "q" * (1 + i % 5) for i, w in enumerate(words)]
    pad = ["good"] * max(0, 25 - n_tokens)           # whitelisted: count as tokens, not as filtered
    return " ".join(words + pad)


@pytest.mark.parametrize("n,hits,expected", [(9, 1, -1), (10, 1, -1), (11, 1, 2), (11, 0, 2)])
def test_offdomain_edges(spark, n, hits, expected):
    v = votes(spark, _offdomain_text(n, hits), cat="Pizza restaurant")
    assert v["lf_offdomain_by_category"] == expected


def test_family_precedence(spark):
    rows = [("Barber shop",), ("Sewing shop",), ("Beginner school",), ("Auto repair service",),
            ("Public library",), ("tire shop",), ("",), (None,)]
    df = spark.createDataFrame(rows, "c string")
    from pyspark.sql import functions as F
    got = [r[0] for r in df.select(category_family(F.col("c"))).collect()]
    assert got == ["bar_pub", "restaurant", "hotel_lodging", "campground_rv", "bar_pub", "retail_specialty",
                   "generic", "generic"]


def test_raw_text_binding_sees_urls_and_handles(spark):
    for raw in ("see www.x.com", "a.b@x.org", "@shop"):
        v = votes(spark, "clean", raw=raw, text_col="text")
        assert K.PROMOTION in (v["lf_contains_url_phone_email"], v["lf_promotion_social_handles"])


def test_stop_words_equal_spark_list(spark):
    from pyspark.ml.feature import StopWordsRemover
    assert K.SPARK_ENGLISH_STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")
