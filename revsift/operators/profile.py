"""Profiling and reporting aggregates.  Each returns a small DataFrame; all of
them are single-pass partial aggregations (no driver loops)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import LABEL_NAMES
from ..session import cut_lineage


def profile_schema_nulls(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows, and missing values per column, as a long table
    ``(column_name, data_type, n_rows, n_null)`` from one aggregation."""
    cols = list(cols or df.columns)
    types = dict((f.name, f.dataType.simpleString()) for f in df.schema.fields)
    wide = df.agg(F.count(F.lit(1)).alias("n_rows"),
                  *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    long = wide.unpivot("n_rows", [f"_n{i}" for i in range(len(cols))], "_slot", "n_null")
    names = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(f"_n{i}"), F.lit(c))])
    dtypes = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(types[c]))])
    return (long.select(names[F.col("_slot")].alias("column_name"), "n_rows",
                        F.col("n_null").cast("bigint").alias("n_null"))
            .withColumn("data_type", dtypes[F.col("column_name")]))


def report_totals(df: DataFrame, user_col: str = "user_id", business_col: str = "gmap_id",
                  approx: bool = False) -> DataFrame:
    """Total rows, distinct users, distinct businesses (nulls not counted).
    ``approx=True`` swaps in HyperLogLog++ for very large tables."""
    cd = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(c))
    return df.agg(F.count(F.lit(1)).alias("n_reviews"),
                  cd(F.col(user_col)).cast("bigint").alias("n_users"),
                  cd(F.col(business_col)).cast("bigint").alias("n_businesses"))


def report_rating_dist(df: DataFrame, col: str = "rating") -> DataFrame:
    return (df.where(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n_reviews")).orderBy(col))


def report_averages(df: DataFrame) -> DataFrame:
    return df.agg(F.avg("rating").alias("avg_rating"), F.avg("text_length").alias("avg_chars"),
                  F.avg("word_count").alias("avg_words"))


def report_time_range(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    return df.agg(F.min(ts_col).alias("min_timestamp"), F.max(ts_col).alias("max_timestamp"))


def report_photo_response_share(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count_if(F.col("has_photos")).alias("n_with_photos"),
        (F.avg(F.col("has_photos").cast("int")) * 100).alias("pct_with_photos"),
        F.count_if(F.col("has_response")).alias("n_with_response"),
        (F.avg(F.col("has_response").cast("int")) * 100).alias("pct_with_response"))


def label_name(col) -> F.Column:
    """Label code -> name; unknown codes become ``UNKNOWN_<n>``."""
    c = F.col(col) if isinstance(col, str) else col
    m = F.create_map(*[x for k, v in LABEL_NAMES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[c], F.concat(F.lit("UNKNOWN_"), c.cast("string")))


def label_distribution(df: DataFrame, label_col: str = "weak_label") -> DataFrame:
    """Count and share of rows per label, named, ordered by label.  The total
    is a scalar subquery, not a window over one partition."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return (df.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n_rows"))
            .select("label", label_name("label").alias("label_name"), "n_rows",
                    (F.col("n_rows") * 100.0 / total).alias("pct"))
            .orderBy("label"))


def confidence_stats(df: DataFrame, col: str = "confidence") -> DataFrame:
    return df.agg(F.avg(col).alias("mean_confidence"), F.stddev_samp(col).alias("std_confidence"))


def confidence_histogram(df: DataFrame, col: str = "confidence", bins: int = 50) -> DataFrame:
    """Equal-width bins between min and max, last bin closed, empty bins
    kept: ``(bin, lo, hi, n_rows)``.  Bounds are scalar subqueries on one
    materialised row, so the expressions that name them stay small."""
    spark = df.sparkSession
    bounds = cut_lineage(df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")))
    lo, hi = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    width = (hi - lo) / F.lit(float(bins))
    idx = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((F.col(col) - lo) / width), F.lit(bins - 1))).cast("int")
    counts = (df.where(F.col(col).isNotNull()).groupBy(idx.alias("bin"))
              .agg(F.count(F.lit(1)).alias("n_rows")))
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (grid.join(counts, "bin", "left")
            .select("bin", (lo + F.col("bin") * width).alias("lo"), (lo + (F.col("bin") + 1) * width).alias("hi"),
                    F.coalesce(F.col("n_rows"), F.lit(0)).cast("bigint").alias("n_rows"))
            .orderBy("bin"))


def class_counts(df: DataFrame, label_col: str = "weak_label") -> DataFrame:
    return df.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n_rows")).orderBy("label")
