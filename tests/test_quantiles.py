"""Exact quantiles with bounded state, and the cleaning options that use them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from revsift.operators import cleaning as C
from revsift.operators import quantiles as Q


@pytest.mark.parametrize("kind", ["distinct", "ties", "one value", "two values"])
def test_equal_to_percentile_with_a_tiny_state(spark, kind):
    """Sketch of 50, at most 20 grouped values: every bracket has to shrink, and the numbers are those of a full sort."""
    rng = np.random.RandomState(1)
    values = {"distinct": rng.randn(3000) * 1e6, "ties": rng.randint(0, 40, 3000).astype(float) ** 2,
              "one value": np.full(50, 7.0), "two values": np.repeat([1.0, 9.0], [30, 970])}[kind]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)] * 5, "v double").repartition(7)
    q = [0.0, 0.01, 0.25, 0.5, 0.77, 0.99, 1.0]
    assert np.allclose(Q.quantiles(df, "v", q, accuracy=50, max_values=20), np.quantile(values, q), rtol=0, atol=1e-9)
    assert Q.quantiles(df.where("v is null"), "v", q) == [None] * 7


def test_integers_dates_and_ranks(spark):
    df = spark.range(1000).select((F.col("id") * 3).alias("v"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    assert Q.order_statistics(df, "v", [0, 10, 999], accuracy=20, max_values=5) == {0: 0, 10: 30, 999: 2997}
    assert str(Q.order_statistics(df, "d", [1], accuracy=20, max_values=5)[1]) == "2020-01-02"


def test_cleaning_options_agree(spark):
    rng = np.random.RandomState(2)
    df = spark.createDataFrame([(int(i), int(rng.randint(1, 4000)), None if i % 7 == 0 else float(rng.randint(1, 6))) for i in range(900)],
                               "ingest_seq long, text_length long, rating double")
    for f in (C.filter_length_quantiles, C.impute_median):
        a, b = (sorted(map(tuple, f(df, bounded=x).collect())) for x in (False, True))
        assert a == b


def test_keep_first_decides_by_type(spark):
    """A key is hashed for being a string, whatever its name; keys of other types stand as they are."""
    df = spark.createDataFrame([(1, 5, "a", "x"), (2, 5, "a", "x"), (3, 6, "a", "x"), (4, 6, None, "x"), (5, 6, None, "x")],
                               "ingest_seq long, textual_id int, body string, gmap_id string")
    assert sorted(r.ingest_seq for r in C.keep_first(df, ["textual_id", "body", "gmap_id"]).collect()) == [1, 3, 4]


def test_category_in_brackets_that_is_no_array(spark):
    df = spark.createDataFrame([("a", "[new] Cafe"), ("b", '["Bakery","Shop"]'), ("c", "Bar"), ("d", None), ("e", "[]")], "gmap_id string, category string")
    got = {r.gmap_id: (r.category_all, r.category_primary) for r in C.normalize_meta(df).collect()}
    assert got == {"a": ("[new] Cafe", "[new] Cafe"), "b": ("Bakery;Shop", "Bakery"), "c": ("Bar", "Bar"), "d": ("", ""), "e": ("", "")}


def test_artefacts_that_do_not_fit(spark):
    from revsift.operators.svd import SvdModel
    from revsift.plans.models import check_fit
    model = SvdModel(np.zeros((3, 10)), np.zeros(3), np.zeros(3), np.zeros(3), 5, 10)
    check_fit("p", 10, model, 4)
    with pytest.raises(ValueError, match="vocabulary has 9"):
        check_fit("p", 9, model, 4)
    with pytest.raises(ValueError, match="forest takes 101"):
        check_fit("p", 10, model, 101)
