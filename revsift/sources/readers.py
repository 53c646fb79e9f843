"""Sources and sinks: JSON-lines reviews and metadata, stage tables, exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REVIEW_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("time", T.LongType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("text", T.StringType()),
    T.StructField("pics", T.ArrayType(T.StructType([T.StructField("url", T.ArrayType(T.StringType()))]))),
    T.StructField("resp", T.StructType([T.StructField("time", T.LongType()), T.StructField("text", T.StringType())])),
    T.StructField("gmap_id", T.StringType()),
    T.StructField("_corrupt_record", T.StringType()),
])

META_SCHEMA = "gmap_id string, category string"


def _with_ingest_order(df: DataFrame) -> DataFrame:
    """Stamp a stable read-order key once at scan: file path, split start,
    then position inside the split.  "Keep first" always means the lowest key."""
    return df.withColumn(
        "ingest_seq",
        F.struct(F.col("_metadata.file_path").alias("file"),
                 F.col("_metadata.file_block_start").alias("block"),
                 F.monotonically_increasing_id().alias("pos")))


def read_reviews(spark: SparkSession, path: str, schema: T.StructType = REVIEW_SCHEMA) -> DataFrame:
    """JSON lines (plain or .gz) with an explicit schema; malformed lines are
    kept in ``_corrupt_record`` instead of failing the job
    (:func:`split_rejects` parts them off)."""
    df = (spark.read.schema(schema)
          .option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt_record")
          .json(path))
    return _with_ingest_order(df)


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(reviews, rejects)`` of :func:`read_reviews`: a malformed line is no
    review and must not reach medians, quantiles or counts; it goes to the
    reject table with its read-order key."""
    bad = F.col("_corrupt_record").isNotNull()
    return df.where(~bad).drop("_corrupt_record"), df.where(bad).select("ingest_seq", "_corrupt_record")


def read_meta(spark: SparkSession, path: str) -> DataFrame:
    """Business metadata; ``category`` read as text keeps arrays as JSON text
    and bare strings as is (reading it as an array would null the strings).
    Blank lines are skipped by the JSON source."""
    df = spark.read.schema(META_SCHEMA).json(path)
    return _with_ingest_order(df)


def read_stage(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """Read a stage table written by :func:`write_dataset` (Parquet), or an
    external CSV export (header, quoted multi-line fields)."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    reader = (spark.read.option("header", True).option("multiLine", True)
              .option("escape", '"'))
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def flat_schema(schema: T.StructType) -> T.StructType:
    """Schema of a CSV export: nested columns are JSON text there."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    return T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, nested) else f.dataType)
                         for f in schema.fields])


def write_dataset(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                  partition_by=None, compression: str | None = None) -> str:
    """``compression``: a codec of the format, such as "zstd" for Parquet and "gzip" for CSV (None: the session's)."""
    codec = {"compression": compression} if compression else {}
    w = df.write.mode(mode).options(**codec)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "parquet":
        w.parquet(path)
    elif fmt == "csv":
        flat = df
        for f in df.schema.fields:
            if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
                flat = flat.withColumn(f.name, F.to_json(F.col(f.name)))
        w = flat.write.mode(mode).options(**codec)
        (w.option("header", True).option("escape", "\"").option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(path))  # texts keep their outer white space
    else:
        raise ValueError(fmt)
    return path


def head_sample(df: DataFrame, n: int = 1000, order_col: str = "ingest_seq") -> DataFrame:
    """First ``n`` rows in ingest order (a top-n, planned as TakeOrderedAndProject)."""
    return df.orderBy(F.col(order_col)).limit(n)


def hash_rank(key_cols, seed: int) -> F.Column:
    """Deterministic pseudo-random rank: first 8 hex digits of md5(seed:key) / 2^32.
    Identical in Spark and DuckDB, independent of partitioning."""
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols])
    h = F.md5(F.concat(F.lit(f"{seed}:"), key))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def review_sample(df: DataFrame, n: int = 100, key_cols=("ingest_seq",), seed: int = 42,
                  cols=("text_clean", "weak_label", "confidence", "prob_genuine", "prob_promotion",
                        "prob_irrelevant", "prob_rant")) -> DataFrame:
    """``min(n, rows)`` rows drawn without replacement by a seeded hash rank."""
    keep = [c for c in list(key_cols) + list(cols) if c in df.columns]
    return (df.withColumn("_u", hash_rank(key_cols, seed))
            .orderBy("_u", *key_cols).limit(n).select(*keep))
