"""Split quotas, exact ranks, nearest neighbours and SMOTE properties."""

import math

import numpy as np
from pyspark.sql import functions as F

from revsift.operators import training as TR


def _points(spark, n=300, dim=5, seed=3):
    rng = np.random.RandomState(seed)
    lab = rng.choice([0, 1, 2], size=n, p=[0.7, 0.2, 0.1])
    X = rng.randn(n, dim)
    X[:, 0] *= 5
    rows = [(int(i), int(lab[i]), [float(v) for v in X[i]]) for i in range(n)]
    return spark.createDataFrame(rows, "id long, label int, features array<double>"), X, lab


def test_split_quotas_exact_and_partition_invariant(spark):
    df, _, lab = _points(spark)
    results = []
    for parts in (1, 4, 17):
        out = TR.stratified_split(df.repartition(parts), "label", ["id"])
        results.append(sorted((r["id"], r["split"]) for r in out.collect()))
        counts = {r["label"]: r["n"] for r in out.where("split = 'test'").groupBy("label")
                  .agg(F.count(F.lit(1)).alias("n")).collect()}
        for c in (0, 1, 2):
            assert counts[c] == math.ceil(0.2 * (lab == c).sum())
    assert results[0] == results[1] == results[2]


def test_split_is_a_projection_and_null_labels_are_a_class(spark):
    df = spark.createDataFrame([(i, None if i % 5 == 0 else i % 3, f"k{i % 90}") for i in range(400)], "id long, label int, part string")
    out = TR.stratified_split(df, "label", ["part", "id"], test_size=0.25)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Window" not in plan
    rows = out.collect()
    for c in {r.label for r in rows}:
        mine = [r for r in rows if r.label == c]
        assert sum(r.split == "test" for r in mine) == math.ceil(0.25 * len(mine))
    assert TR.stratified_split(df.where("1 = 0"), "label", ["id"]).collect() == []
    assert {r.split for r in TR.stratified_split(df, "label", ["id"], test_size=0.0).collect()} == {"train"}
    assert {r.split for r in TR.stratified_split(df, "label", ["id"], test_size=1.0).collect()} == {"test"}


def test_exact_rank_matches_sort(spark):
    df = spark.createDataFrame([(i % 3, float((i * 37) % 101), i) for i in range(500)], "g int, v double, k long")
    d = df.withColumn("b", F.floor(F.col("v") / 10)).withColumn("t", F.col("k").cast("string"))
    got = {r["k"]: r["_rank"] for r in TR.exact_rank(d, "g", "v", "t", "b").collect()}
    rows = sorted(df.collect(), key=lambda r: (r["g"], r["v"], str(r["k"])))
    expected, last, i = {}, None, 0
    for r in rows:
        i = i + 1 if r["g"] == last else 1
        last = r["g"]
        expected[r["k"]] = i
    assert got == expected


def test_nearest_neighbours_brute_force(spark):
    df, X, lab = _points(spark, n=250)
    got = {r["id"]: r["nn_key"] for r in TR.nearest_neighbours(df, "label", "id", block_rows=8).collect()}
    for i in range(len(lab)):
        same = [j for j in range(len(lab)) if lab[j] == lab[i] and j != i]
        d = [(float(((X[i] - X[j]) ** 2).sum()), j) for j in same]
        assert got[i] == min(d)[1]


def test_smote_balances_and_interpolates(spark):
    df, X, lab = _points(spark, n=200)
    out = TR.smote_oversample(df, "label", "id")
    counts = {r["label"]: r["n"] for r in out.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert len(set(counts.values())) == 1
    nn = {r["id"]: r["nn_key"] for r in TR.nearest_neighbours(df, "label", "id").collect()}
    synth = out.where("synthetic").collect()
    assert len(synth) == sum(counts.values()) - 200
    for r in synth[:50]:
        p = np.array(r["features"])
        # on the segment between some same-class base point and its neighbour
        ok = False
        for i in np.where(lab == r["label"])[0]:
            a, b = X[i], X[nn[int(i)]]
            ab = b - a
            t = float((p - a) @ ab / (ab @ ab)) if ab @ ab > 0 else 0.0
            if -1e-9 <= t <= 1 + 1e-9 and np.allclose(a + t * ab, p, atol=1e-9):
                ok = True
                break
        assert ok


def test_class_weights_balanced(spark):
    df, _, lab = _points(spark, n=100)
    w = {r["label"]: r["class_weight"] for r in TR.class_weights(df, "label").select("label", "class_weight")
         .distinct().collect()}
    for c in (0, 1, 2):
        assert abs(w[c] - 100 / (3 * (lab == c).sum())) < 1e-12


def test_nearest_neighbours_with_heavy_ties(spark):
    """Most points share the dominant coordinate: the search must stay exact."""
    rng = np.random.RandomState(11)
    n = 240
    X = rng.randn(n, 4)
    X[:, 0] = np.where(rng.rand(n) < 0.7, 100.0, rng.randn(n) * 50)
    lab = rng.choice([0, 1], size=n)
    rows = [(int(i), int(lab[i]), [float(v) for v in X[i]]) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, label int, features array<double>")
    got = {r["id"]: r["nn_key"] for r in TR.nearest_neighbours(df, "label", "id", block_rows=8).collect()}
    for i in range(n):
        d = [(float(((X[i] - X[j]) ** 2).sum()), j) for j in range(n) if lab[j] == lab[i] and j != i]
        assert got[i] == min(d)[1]


def test_classes_of_any_size(spark):
    """A class of more rows than a classifier's fit takes: every row has its exact neighbour, and SMOTE keeps every row."""
    n = TR.MAX_FIT_ROWS_PER_CLASS + 500
    x = np.random.RandomState(5).permutation(n).astype(float) ** 1.1
    df = spark.createDataFrame([(i, int(i < 60), [float(v), 0.0]) for i, v in enumerate(x)], "id long, label int, features array<double>")
    got = {r["id"]: r["nn_dist2"] for r in TR.nearest_neighbours(df, "label", "id").collect()}
    assert len(got) == n
    for same in (np.arange(60), np.arange(60, n)):
        order = same[np.argsort(x[same])]
        gap = np.concatenate(([np.inf], np.diff(x[order]), [np.inf]))
        assert np.allclose([got[i] for i in order], np.minimum(gap[:-1], gap[1:]) ** 2)
    counts = TR.resampling_counts(df, TR.smote_oversample(df, "label", "id"), "label").collect()
    assert {(r["label"], r["n_before"], r["n_after"]) for r in counts} == {(0, n - 60, n - 60), (1, 60, n - 60)}


def _clusters(spark, n=3000, centres=40, dim=8, seed=6):
    rng = np.random.RandomState(seed)
    mid = rng.randn(centres, dim) * 30
    lab = rng.choice([0, 1], size=n, p=[0.8, 0.2])
    X = mid[rng.randint(centres, size=n)] + rng.randn(n, dim)
    return spark.createDataFrame([(int(i), int(lab[i]), [float(v) for v in X[i]]) for i in range(n)],
                                 "id long, label int, features array<double>"), X, lab


def _brute(X, lab):
    out = {}
    for i in range(len(lab)):
        d = ((X - X[i]) ** 2).sum(axis=1)
        d[(lab != lab[i]) | (np.arange(len(lab)) == i)] = np.inf
        out[i] = int(d.argmin()) if np.isfinite(d.min()) else None
    return out


def test_index_opens_few_blocks_of_clustered_rows(spark):
    """Cells and rings rule out most pairs of blocks, and the answer stays that of all pairs."""
    from revsift.operators.neighbours import neighbour_search
    df, X, lab = _clusters(spark)
    got, report = neighbour_search(df, "label", "id", block_rows=25, report=True)
    assert {r["id"]: r["nn_key"] for r in got.collect()} == _brute(X, lab)
    for r in report.collect():
        assert r.vectors == (lab == r.label).sum() and r.blocks >= r.vectors / 25
        assert r.block_pairs < 0.2 * r.blocks ** 2


def test_index_on_rows_without_structure(spark):
    """Where nothing can be ruled out, the search is exact all the same."""
    from revsift.operators.neighbours import neighbour_search
    rng = np.random.RandomState(3)
    X = rng.randn(400, 24)
    lab = rng.choice([0, 1, 2], size=400)
    df = spark.createDataFrame([(i, str(lab[i]), [float(v) for v in X[i]]) for i in range(400)], "id int, label string, features array<double>")
    got, report = neighbour_search(df, "label", "id", block_rows=16, report=True)
    assert {r["id"]: r["nn_key"] for r in got.collect()} == _brute(X, lab)
    assert all(r.block_pairs <= r.blocks ** 2 for r in report.collect())


def test_copies_are_neighbours_without_pairs(spark):
    """A third of a class are copies: each takes the smallest other key, and no block of copies is compared."""
    from revsift.operators.neighbours import neighbour_search
    rng = np.random.RandomState(9)
    X = np.concatenate([rng.randn(60, 3), np.tile([[0.25, 0.5, -1.0]], (500, 1)), np.array([[9.0, 9.0, 9.0]])])
    lab = np.array([0] * 560 + [1])
    order = rng.permutation(560)
    X[:560] = X[:560][order]
    df = spark.createDataFrame([(i, int(lab[i]), [float(v) for v in X[i]]) for i in range(561)] , "id long, label int, features array<double>")
    none = spark.createDataFrame([(900, None, [0.0, 0.0, 0.0])], df.schema)
    got, report = neighbour_search(df.unionByName(none), "label", "id", block_rows=10, report=True)
    assert {r["id"]: r["nn_key"] for r in got.collect()} == _brute(X, lab)
    assert {r.label: r.vectors for r in report.collect()} == {0: 61, 1: 1}
    assert neighbour_search(df.where("1 = 0"), "label", "id")[0].collect() == []


def test_smote_names_the_parents(spark):
    df, X, lab = _points(spark, n=120)
    out = TR.smote_oversample(df, "label", "id", parents=True)
    for r in out.where("synthetic").collect():
        assert lab[r.base_key] == lab[r.nn_key] == r.label
        a, b = X[r.base_key], X[r.nn_key]
        t = (np.array(r.features) - a) @ (b - a) / ((b - a) @ (b - a))
        assert 0 <= t < 1 and np.allclose(a + t * (b - a), r.features)
    assert out.where("not synthetic and (base_key is not null or nn_key is not null)").count() == 0


def test_class_weights_keep_rows_without_a_label(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, None)], "id int, label int")
    got = {r.id: r.class_weight for r in TR.class_weights(df, "label").collect()}
    assert got == {1: 4 / 6, 2: 4 / 6, 3: 4 / 3, 4: 4 / 3}


def test_folds_before_smote_part_parents_from_tests(spark):
    """No synthetic row of a fold's training set has a parent in the fold it is tested on."""
    df, X, lab = _points(spark, n=150)
    folded = TR.with_folds(df, "label", "id", 3).cache()
    where = {r.id: r._fold for r in folded.collect()}
    assert sorted(where) == list(range(150))
    for f in range(3):
        train = TR.fold_training_set(folded, f, "label", "id", parents=True).collect()
        assert {r.id for r in train if not r.synthetic} == {i for i, k in where.items() if k != f}
        assert all(where[r.base_key] != f and where[r.nn_key] != f for r in train if r.synthetic)
        sizes = [sum(r.label == c for r in train) for c in (0, 1, 2)]
        assert len(set(sizes)) == 1
    cv = TR.cross_validate(df, "label", "id", folds_before_smote=True, num_trees=5, max_depth=4)
    got = {r.fold: r.accuracy for r in cv.collect()}
    assert set(got) == {-2, -1, 0, 1, 2} and abs(got[-1] - np.mean([got[f] for f in range(3)])) < 1e-12


def test_forest_is_bounded(spark):
    """Beyond the bounds, neither the rows of the fit nor the nodes of its trees grow with the table."""
    from pyspark.ml.functions import array_to_vector
    rng = np.random.RandomState(2)
    X = rng.randn(4000, 4)
    y = rng.randint(0, 2, 4000)   # noise: an unbounded tree would take all rows apart
    df = spark.createDataFrame([(float(y[i]), [float(v) for v in X[i]]) for i in range(4000)], "label double, features array<double>")
    df = df.withColumn("features_vec", array_to_vector("features"))
    small, large = df.limit(1000), df
    counts, nodes = [], []
    for rows in (small, large):
        taken, share = TR.forest_sample(rows, max_rows=1000, rows_per_tree=200)
        assert share == 0.2
        counts.append(taken.count())
        model = TR.random_forest_fit(rows, num_trees=4, max_rows=1000, rows_per_tree=200)
        nodes.append(max(r.nodes for r in TR.forest_shape(spark, model).collect()))
    assert counts[0] == 1000 and 850 < counts[1] < 1150
    assert max(nodes) <= 2 * 200 and nodes[1] < 1.5 * nodes[0]
    assert TR.forest_sample(df) [1] == 1.0 and TR.forest_sample(df, rows_per_tree=None)[0].count() == 4000
    a, b = (TR.forest_sample(df.repartition(k), max_rows=1000)[0].agg(F.sum(F.hash("features"))).first()[0] for k in (2, 9))
    assert a == b


def _noisy(spark, n=3000, d=9, classes=3, seed=4):
    from pyspark.ml.functions import array_to_vector
    rng = np.random.RandomState(seed)
    X = np.round(rng.randn(n, d), 2)
    y = (X[:, 0] > 0).astype(int) + (X[:, 1] > 0.5) * (classes - 2)
    y = np.where(rng.rand(n) < 0.1, rng.randint(0, classes, n), y)
    df = spark.createDataFrame([(i, int(y[i]), [float(v) for v in X[i]]) for i in range(n)], "id long, label int, features array<double>")
    return df.withColumn("features_vec", array_to_vector("features")), X, y


def test_no_query_samples_its_fit():
    """Neither SMOTE, the folds nor the forest take fewer rows than there are unless asked to."""
    import inspect
    for f in (TR.bounded_per_class, TR.smote_oversample, TR.fold_training_set, TR.forest_sample, TR.random_forest_fit):
        bounds = {k: p.default for k, p in inspect.signature(f).parameters.items() if k in ("max_rows", "max_rows_per_class", "rows_per_tree")}
        assert bounds and set(bounds.values()) == {None}, f.__name__


def test_training_takes_every_labelled_row(spark, monkeypatch):
    from revsift.plans import pipelines as PL
    monkeypatch.setattr(TR, "MAX_FIT_ROWS_PER_CLASS", 50)
    df, X, y = _noisy(spark, 600)
    _, pred, res = PL.train_pipeline(df, "id", "label", num_trees=3, max_depth=3)
    test = {r.id for r in pred.select("id").collect()}
    assert {r.id for r in res.where("not synthetic").collect()} == set(range(600)) - test


def test_splits_of_small_and_large_nodes_are_the_best():
    """Sorted entries and histograms find the same decrease, that of all splits tried one by one."""
    from revsift.operators import forest as RF
    rng = np.random.RandomState(1)
    n, d, C, B, k = 400, 5, 4, 6, 7
    bins, y = rng.randint(0, B, (n, d)).astype(np.uint8), rng.randint(0, C, n)
    c = rng.randint(1, 4, n)
    w = c * rng.choice([0.5, 1.25, 3.0], n)
    node = np.sort(rng.randint(0, k, n))
    feats = np.stack([np.sort(rng.permutation(d)[:3]) for _ in range(k)])
    totals = np.stack([np.bincount(y[node == i], w[node == i], C) for i in range(k)])
    best, pos, cut = RF._best_of_many(bins, y, w, c, node, feats, totals, B, 2)

    def gini(r):
        t = np.bincount(y[r], w[r], C)
        return t.sum() - (t ** 2).sum() / t.sum()
    for i in range(k):
        mine = node == i
        tried = {}
        for j, f in enumerate(feats[i]):
            for b in range(B - 1):
                left, right = mine & (bins[:, f] <= b), mine & (bins[:, f] > b)
                if c[left].sum() >= 2 and c[right].sum() >= 2:
                    tried[j, b] = gini(mine) - gini(left) - gini(right)
        assert abs(best[i] - max(tried.values())) < 1e-9 and abs(tried[pos[i], cut[i]] - best[i]) < 1e-9
        h, k_rows = RF._histogram(bins, y, w, c, feats[i], B, C, np.flatnonzero(mine))
        assert abs(RF._best_of_histograms(h[None], k_rows[None], 2)[0][0] - best[i]) < 1e-9
    assert np.allclose(RF._best_of_histograms(*RF._histograms(bins, y, w, c, node, feats, B, C), 2)[0], best)


def test_forest_over_blocks_does_what_the_broadcast_one_does(spark, monkeypatch):
    """Upper nodes over all tasks, subtrees in one: about as accurate, every tree's root takes its whole bootstrap."""
    from revsift.operators import forest as RF
    df, X, y = _noisy(spark)
    acc = []
    for local, model_bytes in ((32 << 20, 32 << 20), (30_000, 5_000)):
        monkeypatch.setattr(RF, "LOCAL_BYTES", local)
        monkeypatch.setattr(RF, "MODEL_BYTES", model_bytes)
        m = TR.random_forest_fit(df.coalesce(2), num_trees=8, max_depth=8)
        assert (len(m.groups()) > 1) == (model_bytes == 5_000) and abs(m.importances.sum() - 1) < 1e-9
        assert set(np.argsort(m.importances)[-2:]) == {0, 1}
        shape = TR.forest_shape(spark, m).collect()
        assert sorted(r.tree for r in shape) == list(range(8)) and all(1 < r.nodes < 2 ** 9 and 0 < r.depth <= 8 for r in shape)
        got = TR.random_forest_predict(m, df).collect()
        assert all(abs(sum(r.probabilities) - 1) < 1e-6 and r.probabilities[r.predicted_label] == r.prediction_confidence for r in got)
        acc.append(np.mean([r.predicted_label == r.label for r in got]))
    assert min(acc) > 0.85 and abs(acc[0] - acc[1]) < 0.03


def test_forest_comes_back_from_storage(spark, tmp_path):
    from revsift.operators import forest as RF
    df, X, y = _noisy(spark, 300)
    m = TR.random_forest_fit(df, num_trees=4, max_depth=5)
    m.save(str(tmp_path / "f"))
    a, b = (sorted((r.id, r.predicted_label, tuple(r.probabilities)) for r in TR.random_forest_predict(x, df).collect())
            for x in (m, RF.Forest.load(spark, str(tmp_path / "f"))))
    assert a == b and len(a) == 300


def test_a_row_goes_to_a_page_once(spark, monkeypatch):
    """Many small blocks in pages of 64 rows, no structure to rule anything out: the answer of all pairs."""
    from revsift.operators import neighbours as NB
    monkeypatch.setattr(NB, "PAGE_ROWS", 64)
    rng = np.random.RandomState(8)
    X = np.round(rng.randn(500, 12), 1)
    X[100:110] = X[0]
    lab = rng.choice([0, 1], size=500, p=[0.8, 0.2])
    df = spark.createDataFrame([(i, int(lab[i]), [float(v) for v in X[i]]) for i in range(500)], "id long, label int, features array<double>")
    assert {r["id"]: r["nn_key"] for r in NB.nearest_neighbours(df, "label", "id", block_rows=4).collect()} == _brute(X, lab)


def test_rows_asked_for_are_shuffled_by_page(spark):
    """The plan sends a vector to pages, not to each of their blocks."""
    from revsift.operators import neighbours as NB
    df, X, lab = _points(spark, n=300)
    plan = NB.nearest_neighbours(df, "label", "id", block_rows=8)._jdf.queryExecution().analyzed().toString()
    assert "_page_nearest" in plan and "_until" in plan and "_lo" in plan
