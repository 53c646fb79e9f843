"""Scalar text operators against hand-written rows."""

from pyspark.sql import functions as F

from revsift.functions.text import clean_text, letter_tokens, split_word_count, title_case
from revsift.operators import cleaning as C


def _one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("o")).first()["o"]


def test_clean_text_order_of_steps(spark):
    raw = "  a -  b c! "
    # strip -> collapse (NBSP is whitespace) -> drop punctuation: the space left by '-' stays
    assert _one(spark, clean_text(F.col("s")), raw) == "a  b c"


def test_clean_text_keeps_edge_space_after_punctuation(spark):
    assert _one(spark, clean_text(F.col("s")), "- a") == " a"


def test_title_case_like_python(spark):
    s = "o'neil MARY-jane they're 3rd éric"
    assert _one(spark, title_case(F.col("s")), s) == s.title()


def test_letter_tokens(spark):
    assert _one(spark, letter_tokens(F.col("s")), "abc1 good food 1x yes") == ["good", "food", "yes"]


def test_split_word_count(spark):
    assert _one(spark, split_word_count(F.col("s")), " a  b c ") == 3


def test_quantile_bounds_linear(spark):
    df = spark.createDataFrame([(1,), (2,), (10,), (40,)], "text_length long")
    lo, hi = C.quantile_bounds(df, "text_length", (0.01, 0.99))
    mid = df.agg(F.percentile("text_length", 0.5)).first()[0]
    row = df.select(lo.alias("lo"), hi.alias("hi")).first()
    assert (round(row["lo"], 6), round(mid, 6), round(row["hi"], 6)) == (1.03, 6.0, 39.1)


def test_keep_first_is_partition_invariant(spark):
    rows = [(i % 7, f"t{i % 3}", i) for i in range(200)]
    base = spark.createDataFrame(rows, "k int, t string, ingest_seq long")
    expected = {(k, t): min(s for kk, tt, s in rows if (kk, tt) == (k, t)) for k, t, _ in rows}
    for parts in (1, 4, 17):
        got = C.keep_first(base.repartition(parts), ["k", "t"]).collect()
        assert {(r["k"], r["t"]): r["ingest_seq"] for r in got} == expected


def test_dedupe_is_idempotent(spark):
    rows = [("u", "g", 1, "x", 1), ("u", "g", 1, "x", 2), ("u", "g", 2, "y", 3)]
    df = spark.createDataFrame(rows, "user_id string, gmap_id string, time long, text string, ingest_seq long")
    once = C.dedupe_raw(df)
    twice = C.dedupe_raw(once)
    assert sorted(once.collect()) == sorted(twice.collect())
    assert once.count() == 2


def test_nonempty_text_tokens(spark):
    df = spark.createDataFrame([("None",), ("NONE",), ("  ",), (None,), ("ok",)], "text_clean string")
    assert sorted(r[0] for r in C.nonempty_text(df).collect()) == ["NONE", "ok"]


def test_response_quirk(spark):
    df = spark.createDataFrame([(None,), ((1, "thanks"),)], "resp struct<time:long,text:string>")
    rows = C.response_features(df).collect()
    assert [r["has_response"] for r in rows] == [True, True]
    assert [r["response_length"] for r in rows] == [4, 2]
    src = C.response_features(df, response_flag="source").collect()
    assert [r["has_response"] for r in src] == [False, True]


def test_hot_key_counts_and_dedupe(spark):
    """One user owns a third of all rows: counts and keep-first stay exact."""
    n = 3000
    rows = [("hot" if i % 3 == 0 else f"u{i}", f"g{i % 7}", i // 2, f"t{i % 5}", i) for i in range(n)]
    df = spark.createDataFrame(rows, "user_id string, gmap_id string, time long, text string, ingest_seq long")
    counted = {r["user_id"]: r["user_review_count"] for r in C.user_review_count(df.repartition(17)).collect()}
    assert counted["hot"] == n // 3 and counted["u1"] == 1
    first = {(r["user_id"], r["gmap_id"], r["time"]): r["ingest_seq"] for r in C.dedupe_event(df).collect()}
    expected = {}
    for u, g, t, _, s in rows:
        expected[(u, g, t)] = min(s, expected.get((u, g, t), s))
    assert first == expected


def test_samples_are_partition_invariant(spark):
    from revsift.sources.readers import head_sample, review_sample
    rows = [(i, f"text {i % 13}") for i in range(500)]
    base = spark.createDataFrame(rows, "ingest_seq long, text_clean string")
    got_r, got_h = [], []
    for parts in (1, 4, 17):
        df = base.repartition(parts)
        got_r.append(sorted(r["ingest_seq"] for r in review_sample(df, 100, cols=("text_clean",)).collect()))
        got_h.append([r["ingest_seq"] for r in head_sample(df, 50).collect()])
    assert got_r[0] == got_r[1] == got_r[2] and len(got_r[0]) == 100
    assert got_h[0] == got_h[1] == got_h[2] == list(range(50))
