"""Stage tables: what they take, when they go, and that the cleaning pipeline gives the rows of its plain steps."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from revsift import session as S
from revsift.operators import cleaning as C
from revsift.plans import pipelines as PL
from revsift.plans import registry as G


def _folder(spark) -> str:
    return S.ensure_checkpoint_dir(spark).removeprefix("file:")


def _bytes(path: str) -> int:
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names)


def test_votes_leave_less_than_the_texts(spark):
    """The vote query keeps neither texts nor uncompressed copies of the reviews."""
    texts = spark.read.parquet(os.path.join(SF_SMALL, "documents.parquet")).agg(F.sum(F.octet_length("text"))).first()[0]
    before = _bytes(_folder(spark))
    assert G.QUERIES["lf_irrelevant_politics"](spark, SF_SMALL).count() > 0
    assert _bytes(_folder(spark)) - before < 0.5 * texts


def test_restage_drops_what_lies_between(spark):
    def stages():
        return {x for x in os.listdir(_folder(spark)) if x.startswith("stage-")}
    before = stages()
    out = S.restage(spark, lambda: S.stage_table(spark.range(5)).where("id > 1"))
    assert len(stages() - before) == 1 and sorted(r.id for r in out.collect()) == [2, 3, 4]
    with S.passing_stages(spark):
        S.stage_table(spark.range(3))
        assert len(stages() - before) == 2
    assert len(stages() - before) == 1


def test_clean_pipeline_gives_the_rows_of_its_steps(spark):
    """Null keys, copies, edited copies and null ratings: the same rows as join, raw dedupe and cleaning one after the other."""
    rows, seq = [], 0
    for i in range(120):
        user, biz = (None if i % 11 == 0 else f"u{i % 5}"), (None if i % 13 == 0 else f"g{i % 7}")
        for text in (f"text {'word ' * (i % 9)}{i}", f"text {'word ' * (i % 9)}{i}", None if i % 4 else f"later {i}"):
            rows.append((seq, user, biz, None if i % 17 == 0 else 1000 * i, None if i % 3 == 0 else float(1 + (i + len(rows)) % 6), text, None if i % 5 else f"n {i}"))
            seq += 1
    df = spark.createDataFrame(rows, "ingest_seq long, user_id string, gmap_id string, time long, rating double, text string, name string")
    df = df.withColumn("pics", F.lit(None).cast("array<struct<url:array<string>>>")).withColumn("resp", F.lit(None).cast("struct<time:bigint,text:string>"))
    meta = spark.createDataFrame([(1, "g1", '["a","b"]'), (2, "g2", "c"), (3, "g2", "d"), (4, None, "none")], "ingest_seq long, gmap_id string, category string")
    joined = C.join_meta(df, C.meta_first_per_key(C.normalize_meta(meta)))
    plain = C.clean_review_data(S.cut_lineage(C.dedupe_raw(joined)), materialize=S.cut_lineage).select(*PL.CLEANED_COLUMNS)
    got = PL.clean_pipeline(df, meta)
    assert got.columns == plain.columns and got.dtypes == plain.dtypes
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect())) and plain.count() > 50
    some = ("ingest_seq", "text_clean", "user_review_count")
    assert sorted(map(repr, PL.clean_pipeline(df, meta, columns=some).select(*some).collect())) == sorted(map(repr, plain.select(*some).collect()))


def test_csv_export_can_be_compressed(spark, tmp_path):
    from revsift.sources import readers as R
    df = spark.createDataFrame([(1, ' a "b"\nc '), (2, None)], "k int, t string")
    R.write_dataset(df, str(tmp_path / "c"), "csv", compression="gzip")
    assert all(x.endswith(".csv.gz") for x in os.listdir(tmp_path / "c") if x.startswith("part-"))
    back = R.read_stage(spark, str(tmp_path / "c"), "csv", schema="k int, t string")
    assert sorted(map(tuple, back.collect())) == [(1, ' a "b"\nc '), (2, None)]
