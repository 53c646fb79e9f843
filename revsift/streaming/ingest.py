"""Taking in arriving review files (Structured Streaming).

The stream appends new JSON files to a Parquet stage table, each file exactly
once.  Cleaning needs whole-table values (keep-first dedupe, rating median,
length quantiles, counts), so labelling runs the batch operators over the
stage table: the result equals a batch run over the same files, with no
watermark that drops late events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..sources.readers import REVIEW_SCHEMA

STAGE_SCHEMA = T.StructType([T.StructField("ingest_seq", T.LongType())]
                            + [f for f in REVIEW_SCHEMA.fields if f.name != "_corrupt_record"])


def start(spark: SparkSession, input_dir: str, stage_dir: str, checkpoint_dir: str, available_now: bool = False):
    """Start the file-to-stage stream; returns the StreamingQuery."""
    w = (spark.readStream.schema(STAGE_SCHEMA).json(input_dir).writeStream.format("parquet").option("path", stage_dir)
         .option("checkpointLocation", checkpoint_dir).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def stage(spark: SparkSession, stage_dir: str) -> DataFrame:
    """Everything taken in so far, in whole committed files."""
    return spark.read.schema(STAGE_SCHEMA).parquet(stage_dir)
