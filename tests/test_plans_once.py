"""Expensive expressions stand once in a plan, and say what they said before."""

import random

from pyspark.sql import functions as F

from revsift.constants import WHITESPACE_CLASS as WS
from revsift.functions.text import clean_text, computed_once
from revsift.operators import cleaning as C
from revsift.operators import label_model as LM
from revsift.operators import profile as P
from revsift.operators import tfidf as TF


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_clean_text_equals_its_plain_steps(spark):
    r = random.Random(3)
    chars = list("ab Z9 \t\n\r\x0b\x0c\x1c\x1f\x85\xa0  　.-éЖ中😀  ")
    texts = ["".join(r.choice(chars) for _ in range(r.randrange(0, 40))) for _ in range(3000)]
    texts += ["", " ", "  ", "\n", "a\n", " \na", "a \n", " ", "é", "é é", None, "x" + " " * 5000 + "y", " " * 5000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    strip = F.regexp_replace("t", f"^{WS}+|{WS}+$", "")
    plain = F.regexp_replace(F.regexp_replace(strip, f"{WS}+", " "), "[^A-Za-z0-9 ]", "")
    assert df.where(~clean_text("t").eqNullSafe(plain)).collect() == []


def test_cleaned_text_is_computed_once(spark):
    df = spark.createDataFrame([(1, " a  b "), (2, "é"), (3, None), (4, "null")], "k int, t string")
    out = C.nonempty_text(df.select("k", clean_text("t").alias("text_clean")))
    assert plan(out.agg(F.count(F.lit(1)))).count("clean(") == 1
    assert [tuple(r) for r in out.collect()] == [(1, "a b")]


def test_computed_once_keeps_rows_nulls_and_column_order(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    out = computed_once(df, b=F.upper("b"), c=F.col("a") + 1)
    assert out.columns == ["a", "b", "c"]
    assert sorted(map(tuple, out.collect())) == [(1, None, 2), (2, "X", 3)]


def scored(spark):
    import numpy as np
    votes = spark.createDataFrame([([c, -1, (c + 1) % 4],) for c in range(4)] * 3 + [([-1, -1, -1],)], "votes array<int>")
    mu = np.full((12, 4), 0.2)
    for j in range(3):
        for c in range(4):
            mu[j * 4 + c, c] = 0.3 + 0.1 * j
    return LM.weak_labels(votes, LM.LabelModelParams(mu=mu, prior=np.full(4, 0.25), m=3))


def test_a_filter_on_the_label_does_not_repeat_the_scores(spark):
    df = scored(spark)
    kept = df.where(F.col("weak_label") != -1).select("weak_label")
    assert len(plan(kept)) < 2 * len(plan(df.select("weak_label")))
    assert kept.count() == 12


def test_histogram_bounds_stay_out_of_its_plan(spark):
    df = scored(spark)
    hist = P.confidence_histogram(df)
    assert len(plan(hist)) < 4 * len(plan(df))
    assert sum(r["n_rows"] for r in hist.collect()) == df.count()


def test_weights_are_computed_once(spark):
    import math
    vocab = spark.createDataFrame([("apple", 0, 1.5), ("pear", 1, 1.0)], "feature_name string, feature_index int, idf double")
    df = spark.createDataFrame([(1, "apple pear apple"), (2, "plum"), (3, None)], "k int, text_clean string")
    long = TF.tfidf_transform_long(df, vocab, "k")
    assert plan(long).count("UDF(") == 4   # tokens, stop words, bigrams, counts
    a, b = (1 + math.log(2)) * 1.5, 1.0
    got = {(r["k"], r["feature_index"]): r["weight"] for r in long.collect()}
    assert got.keys() == {(1, 0), (1, 1)}
    assert abs(got[1, 0] - a / math.hypot(a, b)) < 1e-12 and abs(got[1, 1] - b / math.hypot(a, b)) < 1e-12
