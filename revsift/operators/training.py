"""Training-set preparation and the classifier.

* exact per-class ranks without a per-class window (:func:`.ranks.exact_rank`):
  rows are bucketed by their ordering value, per-(class, bucket) counts give
  each bucket's offset, and the row number is taken only inside a bucket -
  so a class holding a third of all rows is spread over many tasks;
* stratified split with exact per-class quotas, a projection that shuffles no row;
* SMOTE with an exact within-class nearest neighbour
  (:mod:`.neighbours`), for classes of any size;
* balanced class weights, random forest (:mod:`.forest`), feature importances,
  k-fold cross-validation.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import ABSTAIN
from ..session import cut_lineage
from ..sources.readers import hash_rank
from . import forest as RF
from .neighbours import nearest_neighbours
from .ranks import class_sizes, exact_rank, n_buckets

# Buckets of the hash in which a class's quota is looked for: the rows ranked are about a class's rows over these.
SPLIT_BUCKETS = 1 << 14
# Rows per class that a caller may bound a classifier's fit by, drawn by a seeded hash rank; no query does.
MAX_FIT_ROWS_PER_CLASS = 20_000


def drop_abstain(df: DataFrame, label_col: str = "weak_label") -> DataFrame:
    return df.where(F.col(label_col) != ABSTAIN)


def assemble_features(df: DataFrame, svd_col: str = "svd", extra_cols=("text_length",),
                      out_col: str = "features") -> DataFrame:
    """SVD components followed by the extra numeric columns, as one array
    (and ``features_vec`` as an ML vector)."""
    arr = F.concat(F.col(svd_col), F.array(*[F.col(c).cast("double") for c in extra_cols]))
    return df.withColumn(out_col, arr).withColumn(out_col + "_vec", array_to_vector(F.col(out_col)))


def wide_features(df: DataFrame, k: int, svd_col: str = "svd", prefix: str = "tfidf_svd_",
                  cols=("weak_label", "confidence", "text_length"), key: str = "ingest_seq") -> DataFrame:
    """One column per component (``tfidf_svd_0`` ...) next to the label columns, for an export."""
    parts = [F.get(F.col(svd_col), F.lit(i)).alias(f"{prefix}{i}") for i in range(k)]
    return df.select(key, *parts, *[c for c in cols if c in df.columns])


def resampling_counts(before: DataFrame, after: DataFrame, label_col: str) -> DataFrame:
    """``(label, n_before, n_after)`` of a resampling."""
    a = before.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n_before"))
    b = after.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n_after"))
    return a.join(b, "label", "left")

# ------------------------------------------------------------------ split and weights


def stratified_split(df: DataFrame, label_col: str, key_cols, test_size: float = 0.2, seed: int = 42,
                     split_col: str = "split") -> DataFrame:
    """Exactly ``ceil(test_size * n_class)`` rows of each class go to
    ``test``: those of the lowest seeded hash rank (independent of partitioning).
    Rows without a label count as one more class; rows that share a key go
    the same way.

    No row is shuffled.  Counts per class and bucket of the hash show in which
    bucket a class's quota is reached; only the rows of that bucket are ranked,
    and the last one taken is the class's threshold.  The split is a projection
    with one comparison per class."""
    u = hash_rank(key_cols, seed)
    tie = F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols])
    keys = df.select(F.col(label_col).alias("_c"), u.alias("_u"), tie.alias("_tie")).withColumn("_b", F.floor(F.col("_u") * SPLIT_BUCKETS))
    counts = cut_lineage(keys.groupBy("_c", "_b").agg(F.count(F.lit(1)).alias("_n")))   # at most classes x SPLIT_BUCKETS
    whole = Window.partitionBy("_c")
    sums = counts.select("_c", "_b", "_n", F.ceil(F.sum("_n").over(whole) * F.lit(test_size)).alias("_quota"),
                         F.sum("_n").over(whole.orderBy("_b")).alias("_upto"))
    met = (sums.where((F.col("_upto") >= F.col("_quota")) & (F.col("_upto") - F.col("_n") < F.col("_quota")))
           .select(F.col("_c").alias("_mc"), F.col("_b").alias("_mb"), (F.col("_quota") - F.col("_upto") + F.col("_n")).alias("_take")))
    near = keys.join(F.broadcast(met), F.col("_c").eqNullSafe(F.col("_mc")) & (F.col("_b") == F.col("_mb")))   # a row per class
    last = (near.withColumn("_rank", F.row_number().over(whole.orderBy("_u", "_tie")))
            .where("_rank = _take").select("_c", "_u", "_tie").collect())
    test = F.lit(False)
    for r in last:  # one branch per class
        same = F.col(label_col).isNull() if r["_c"] is None else F.col(label_col) == F.lit(r["_c"])
        test = F.when(same, (u < F.lit(r["_u"])) | ((u == F.lit(r["_u"])) & (tie <= F.lit(r["_tie"])))).otherwise(test)
    return df.withColumn(split_col, F.when(test, "test").otherwise("train"))


def class_weights(df: DataFrame, label_col: str, weight_col: str = "class_weight") -> DataFrame:
    """``n / (k * n_class)`` per row ("balanced"); class totals are a k-row aggregate.
    Rows without a label count as one more class, as in :func:`stratified_split`."""
    per = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("_nc"))
    n = df.agg(F.count(F.lit(1))).scalar()
    k = per.agg(F.count(F.lit(1))).scalar()
    w = per.select(F.col(label_col).alias("_wl"), (n / (k * F.col("_nc"))).alias(weight_col))
    return df.join(F.broadcast(w), F.col(label_col).eqNullSafe(F.col("_wl"))).drop("_wl")

# ------------------------------------------------------------------ bounded samples and SMOTE


def bounded_per_class(df: DataFrame, label_col: str, key_col: str, max_rows: int | None = None,
                      seed: int = 42) -> DataFrame:
    """At most ``max_rows`` rows of each class (None: all), those of the lowest seeded hash rank; adds ``_rank`` (from 1)."""
    B = n_buckets(sum(class_sizes(df, label_col).values()))
    d = (df.withColumn("_u", hash_rank([key_col], seed)).withColumn("_b", F.floor(F.col("_u") * B).cast("int"))
         .withColumn("_tie", F.col(key_col).cast("string")))
    ranked = exact_rank(d, label_col, "_u", "_tie", "_b").drop("_u", "_b", "_tie")
    return ranked if max_rows is None else ranked.where(F.col("_rank") <= max_rows)


def smote_oversample(df: DataFrame, label_col: str, key_col: str, feat_col: str = "features", seed: int = 42,
                     max_rows_per_class: int | None = None, parents: bool = False) -> DataFrame:
    """Raise every class to the majority size with synthetic rows
    ``x + u * (nn(x) - x)`` (Chawla et al., 2002, one neighbour).

    Takes all rows, or with ``max_rows_per_class`` at most so many of each
    class (lowest seeded hash rank).  Synthetic row
    ``s`` of class ``c`` uses the base row of rank ``s mod n_c`` and a
    hash-derived gap ``u`` in [0, 1).  Output keeps the rows taken
    (``synthetic`` false, ``synthetic_id`` null, their key of any type) plus
    the new ones (null key, ``synthetic_id`` from 0).  ``parents`` adds the keys
    of the two rows a synthetic one lies between (``base_key``, ``nn_key``;
    null for the rows taken).  A null label, or a minority class of one row,
    raises."""
    spark = df.sparkSession
    rows = cut_lineage(bounded_per_class(df.select(label_col, key_col, F.col(feat_col).cast("array<double>").alias(feat_col)),
                                         label_col, key_col, max_rows_per_class, seed))
    sizes = class_sizes(rows, label_col)
    base = rows.select(label_col, key_col, feat_col, F.lit(False).alias("synthetic"),
                       F.lit(None).cast("long").alias("synthetic_id"))
    if parents:
        none = F.lit(None).cast(df.schema[key_col].dataType)
        base = base.select("*", none.alias("base_key"), none.alias("nn_key"))
    if not sizes:
        return base
    if None in sizes:
        raise ValueError(f"{label_col} has null labels")
    n_max = max(sizes.values())
    need = {c: n_max - m for c, m in sizes.items() if n_max > m}
    lone = sorted(str(c) for c in need if sizes[c] < 2)
    if lone:
        raise ValueError(f"classes of one row have no neighbour: {', '.join(lone)}")
    if not need:
        return base
    minority = rows.where(F.col(label_col).isin(list(need)))
    nn = nearest_neighbours(minority, label_col, key_col, feat_col)
    feats = minority.select(F.col(key_col).alias("nn_key"), F.col(feat_col).alias("_nnx"))
    ranked = (minority.withColumn("_r0", F.col("_rank") - 1).drop("_rank").join(nn, key_col).join(feats, "nn_key"))
    plan, acc = [], 0
    for c in sorted(need):
        plan.append((c, acc, need[c], sizes[c]))
        acc += need[c]
    kind = df.schema[label_col].dataType.simpleString()
    # a range of synthetic ids per class, dealt over tasks as any range
    syn = reduce(DataFrame.unionByName, [
        spark.range(start, start + n).select(F.lit(c).cast(kind).alias(label_col), F.col("id").alias("_sid"),
                                             ((F.col("id") - start) % m).alias("_r0")) for c, start, n, m in plan])
    gap = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:gap:"), F.col("_sid").cast("string"))), 1, 8), 16, 10) \
        .cast("bigint") / F.lit(4294967296.0)
    out = syn.join(ranked, [label_col, "_r0"]).withColumn("_gap", gap).select(
        label_col, F.lit(None).cast(df.schema[key_col].dataType).alias(key_col),
        F.zip_with(F.col(feat_col), F.col("_nnx"), lambda a, b: a + F.col("_gap") * (b - a)).alias(feat_col),
        F.lit(True).alias("synthetic"), F.col("_sid").cast("long").alias("synthetic_id"),
        *([F.col(key_col).alias("base_key"), "nn_key"] if parents else []))
    return base.unionByName(out)

# ------------------------------------------------------------------ forest


def forest_sample(train: DataFrame, features_col: str = "features_vec", label_col: str = "label",
                  max_rows: int | None = None, rows_per_tree: int | None = None, seed: int = 42) -> tuple[DataFrame, float]:
    """The rows a forest is fitted on and each tree's share of them: all, unless a caller asks for fewer.

    Beyond ``max_rows``, those whose hashed label and features fall below
    ``max_rows / n``, whatever the partitioning.  Each tree then draws
    ``rows_per_tree`` of them with replacement (all of them when there are fewer)."""
    if max_rows is None and rows_per_tree is None:
        return train, 1.0
    n = train.count()
    if max_rows is not None and n > max_rows:
        draw = F.pmod(F.xxhash64(vector_to_array(F.col(features_col)), F.col(label_col), F.lit(seed)), F.lit(1 << 32)) / float(1 << 32)
        train, n = train.where(draw < max_rows / n), max_rows
    return train, 1.0 if rows_per_tree is None or n <= rows_per_tree else rows_per_tree / n


def random_forest_fit(train: DataFrame, label_col: str = "label", features_col: str = "features_vec",
                      weight_col: str | None = None, num_trees: int = 200, max_depth: int = 25,
                      min_instances_per_node: int = 2, seed: int = 42, max_bins: int = 32,
                      max_rows: int | None = None, rows_per_tree: int | None = None) -> RF.Forest:
    """A forest over all rows, ``ceil(sqrt(d))`` features drawn per split: see :mod:`.forest`.  The driver holds the upper
    nodes and never a whole tree.  ``max_rows`` and ``rows_per_tree`` bound the fit if asked for (:func:`forest_sample`)."""
    rows, share = forest_sample(train, features_col, label_col, max_rows, rows_per_tree, seed)
    return RF.fit(rows, label_col, features_col, weight_col, num_trees, max_depth, min_instances_per_node, seed, max_bins, share)


def forest_shape(spark, model) -> DataFrame:
    """``(tree, nodes, depth)`` of a fitted forest."""
    return model.trees.select("tree", "nodes", "depth")


def random_forest_predict(model, df: DataFrame, features_col: str = "features_vec") -> DataFrame:
    return RF.predict(model, df, features_col)


def feature_importance(spark, model, names, top: int = 10) -> DataFrame:
    rows = [(names[i], float(model.importances[i])) for i in range(len(names))]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"),
                                                                                    "feature").limit(top)


def with_folds(df: DataFrame, label_col: str, key_cols, folds: int, seed: int = 42) -> DataFrame:
    """Adds ``_fold``: a row's hash-rank position inside its class, modulo ``folds``
    (exact, partition independent)."""
    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    buckets = n_buckets(sum(class_sizes(df, label_col).values()))
    d = df.withColumn("_tie", F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in keys]))
    d = d.withColumn("_u", hash_rank(["_tie"], seed)).withColumn("_b", F.floor(F.col("_u") * buckets).cast("int"))
    return (exact_rank(d, label_col, "_u", "_tie", "_b").withColumn("_fold", ((F.col("_rank") - 1) % folds).cast("int"))
            .drop("_rank", "_u", "_b", "_tie"))


def fold_training_set(folded: DataFrame, fold: int, label_col: str, key_col: str, feat_col: str = "features", seed: int = 42,
                      max_rows_per_class: int | None = None, parents: bool = False) -> DataFrame:
    """The rows outside a fold, oversampled among themselves: neighbours and synthetic rows come from them alone."""
    rest = folded.where(F.col("_fold") != fold).select(label_col, key_col, feat_col)
    return smote_oversample(rest, label_col, key_col, feat_col, seed, max_rows_per_class, parents)


def cross_validate(df: DataFrame, label_col: str, key_cols, folds: int = 3, seed: int = 42, folds_before_smote: bool = False,
                   feat_col: str = "features", features_col: str = "features_vec", **forest_kw) -> DataFrame:
    """Stratified k-fold accuracy with one forest per fold: per-fold accuracy
    plus mean (fold -1) and population std (fold -2).

    By default the folds part the rows as given, which for oversampled rows
    puts synthetic ones and their parents on both sides.  ``folds_before_smote``
    takes rows that are not oversampled yet (one key column, ``feat_col`` an
    array): each fold's training part is oversampled by itself
    (:func:`fold_training_set`) and tested on the fold's own rows."""
    spark = df.sparkSession
    key = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    d = cut_lineage(with_folds(df, label_col, key, folds, seed))   # ranked once, read by every fold
    rows = []
    for f in range(folds):
        te = d.where(F.col("_fold") == f)
        if folds_before_smote:
            tr = cut_lineage(fold_training_set(d, f, label_col, key[0], feat_col, seed)).withColumn(features_col, array_to_vector(F.col(feat_col)))
            te = te.withColumn(features_col, array_to_vector(F.col(feat_col)))
        else:
            tr = d.where(F.col("_fold") != f)
        model = random_forest_fit(tr, label_col=label_col, features_col=features_col, **forest_kw)
        pred = random_forest_predict(model, te, features_col)
        acc = pred.agg(F.avg((F.col("predicted_label") == F.col(label_col)).cast("double"))).first()[0]
        rows.append((f, float(acc if acc is not None else 0.0)))
    accs = [a for _, a in rows]
    mean = sum(accs) / len(accs)
    std = math.sqrt(sum((a - mean) ** 2 for a in accs) / len(accs))
    return spark.createDataFrame(rows + [(-1, mean), (-2, std)], "fold int, accuracy double")
