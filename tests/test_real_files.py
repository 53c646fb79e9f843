"""JSON files with a bad line -> reject table -> clean -> label -> features -> train -> score, on the reader's own key."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from revsift.operators import cleaning as C
from revsift.operators import training as TR
from revsift.plans import models as MD
from revsift.plans import pipelines as PL
from revsift.session import cut_lineage
from revsift.sources import fixtures as FX
from revsift.sources import readers as R


def test_from_files_to_scores(spark, tmp_path):
    FX.fx_reviews(spark, SF_SMALL).drop("ingest_seq").coalesce(2).write.json(f"{tmp_path}/reviews")
    with open(f"{tmp_path}/reviews/bad.json", "w") as f:
        f.write('{"user_id": "u", broken\n')
    raw = FX.fx_meta_raw(spark, SF_SMALL)
    raw.select(F.to_json(F.struct("gmap_id", "category")).alias("value")).coalesce(1).write.text(f"{tmp_path}/meta")

    reviews, rejects = R.split_rejects(cut_lineage(R.read_reviews(spark, f"{tmp_path}/reviews")))
    assert rejects.count() == 1 and reviews.count() == FX.fx_reviews(spark, SF_SMALL).count()
    cleaned = cut_lineage(C.nonempty_text(PL.clean_pipeline(reviews, R.read_meta(spark, f"{tmp_path}/meta"))))
    assert 0 < cleaned.count() < reviews.count()
    weak = PL.weak_label_pipeline(cleaned, n_epochs=20)
    feats, vocab, svd = PL.feature_pipeline(weak, max_features=60, n_components=5)
    counts = {r[0]: r[1] for r in feats.groupBy("weak_label").count().collect()}
    common = [c for c, n in counts.items() if c >= 0 and n >= 4]     # a class of one row has no neighbour
    model, pred, res = PL.train_pipeline(feats.where(F.col("weak_label").isin(common)), num_trees=3, max_depth=3)
    balanced = {r[0]: r[1] for r in res.groupBy("weak_label").count().collect()}
    assert len(set(balanced.values())) == 1 and pred.count() > 0
    scored = MD.score_reviews(reviews, MD.Artifacts(vocab, svd, model), "ingest_seq", "text")
    assert scored.count() == reviews.count() and scored.schema["ingest_seq"].dataType == reviews.schema["ingest_seq"].dataType
    wide = TR.wide_features(feats, svd.k)
    assert [c for c in wide.columns if c.startswith("tfidf_svd_")] == [f"tfidf_svd_{i}" for i in range(svd.k)]
