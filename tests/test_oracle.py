"""A slice of the correctness gate on the smallest scale: Spark vs DuckDB."""

import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL

NAMES = ["clean_pipeline", "apply_lfs", "lf_summary", "vote_overlap_matrix", "label_model_proba",
         "classification_report", "tfidf_fit_transform", "nearest_neighbours", "stratified_split", "smote_oversample",
         "read_reviews", "read_meta_json", "write_dataset", "read_labeled_csv", "stream_weak_labels"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 6) if not math.isnan(v) else "nan"
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "labels", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    a = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    b = sorted((tuple(_norm(dict(zip(rel.columns, r))[c]) for c in cols) for r in rel.fetchall()), key=repr)
    assert a == b


def test_every_query_has_a_callable():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 80


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0


def test_checkpoint_folder_must_be_shared_on_a_cluster():
    from revsift.session import local_folder
    assert local_folder("local[4]", "/tmp/x,/tmp/y").startswith("/tmp/x/")
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(RuntimeError):
            local_folder(master, "/tmp")


def test_reviews_hold_every_whole_text(spark):
    from revsift.sources import fixtures as FX
    docs = spark.read.parquet(os.path.join(SF_SMALL, "documents.parquet")).select("doc_id", "text")
    whole = FX.fx_reviews(spark, SF_SMALL).alias("r").join(docs.alias("d"), docs.doc_id == F.col("r.ingest_seq"))
    n, held = whole.agg(F.count("*"), F.sum(F.col("r.text").endswith(F.col("d.text")).cast("int"))).first()
    assert n == held == docs.count()


def test_malformed_lines_go_to_the_reject_table(spark, tmp_path):
    from revsift.sources import readers as R
    (tmp_path / "r.json").write_text('{"user_id":"u","gmap_id":"g","time":1,"rating":4,"text":"fine"}\n{"user_id": broken\n')
    good, bad = R.split_rejects(R.read_reviews(spark, str(tmp_path)).persist())
    assert [r.text for r in good.collect()] == ["fine"] and bad.count() == 1
