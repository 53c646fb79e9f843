"""Helpers shared by the training-data operators: session set-up, word splitting, hashing, links -> components."""

from __future__ import annotations

import ctypes
import gc
import pickle
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revsift.session import configure

#: Rows per Arrow batch, small enough that a batch of long texts fits a Python worker.
BATCH_ROWS = 1000
#: Bytes per Arrow batch: long texts make smaller batches (one row at least).
BATCH_BYTES = "8m"
#: Bits of the bounded membership bitmap (2 MB): it only thins rows ahead of an exact join.
BITMAP_BITS = 1 << 24
#: Word hashes memoised by one task before the table is emptied.
CACHE_WORDS = 200_000


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings for these operators (checkpoint folder, small Arrow batches)."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def trimmed(run):
    """A mapInArrow function that gives its memory back to the system when its partition ends.  Python workers are
    reused: what the arrays and caches of one stage took would stay with the process through the stages after it."""
    def out(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (OSError, AttributeError):   # another C library
                pass
    return out


class Shared:
    """A broadcast object of this package's classes.  Their code travels inside the pickled bytes, as a UDF's does, so
    executors need no installed copy; each worker unpickles once."""

    def __init__(self, spark: SparkSession, value):
        self._bytes, self._value = spark.sparkContext.broadcast(cloudpickle.dumps(value)), None

    def __getstate__(self):
        return {"_bytes": self._bytes, "_value": None}

    @property
    def value(self):
        if self._value is None:
            self._value = pickle.loads(self._bytes.value)
        return self._value


def shared_dir(spark: SparkSession) -> str:
    """A new folder name for stage tables, inside the checkpoint folder that all executors share."""
    prepare(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/stages-{uuid.uuid4().hex}"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(col: str, m: int):
    """crc32 of the id as text, modulo m (null for a null id)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % m


class WordHash(dict):
    """word (bytes) -> 64-bit hash, memoised up to CACHE_WORDS words."""

    def __missing__(self, word):
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mix64(x: np.ndarray) -> np.ndarray:
    """Invertible 64-bit finaliser: spreads every input bit over the word."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_STEP = np.uint64(0x9E3779B97F4A7C15)


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k consecutive values: polynomial in 2**64, then mixed."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = h[:n].copy()
    for i in range(1, k):
        acc *= _STEP
        acc += h[i:i + n]
    return mix64(acc)


def word_hashes(texts: list[bytes | None], cache: WordHash, lower: bool) -> list[np.ndarray]:
    """Per text the hashes of its words (maximal runs without ASCII white space); one text is split at a time, as the
    words of a whole batch take ten times its size."""
    out = []
    for t in texts:
        words = (t.lower() if lower else t).split() if t else []
        out.append(np.fromiter(map(cache.__getitem__, words), np.uint64, len(words)))
    return out


def text_batches(batches, text: str = "text"):
    """(batch, texts as bytes or None) for Arrow record batches whose text column is binary."""
    for b in batches:
        if b.num_rows:
            yield b, b.column(text).to_pylist()


def with_text(df: DataFrame, text_col: str, *cols) -> DataFrame:
    """Only the wanted columns, the text as UTF-8 bytes named ``text``."""
    return df.select(*cols, F.col(text_col).cast("string").cast("binary").alias("text"))


def carried(df: DataFrame, keep) -> tuple[list, str]:
    """Columns to carry through a mapInArrow unchanged: renamed out of the way of its own columns, and their DDL."""
    return ([F.col(f"`{c}`").alias(f"_keep_{i}") for i, c in enumerate(keep)],
            "".join(f", `{c}` {df.schema[c].dataType.simpleString()}" for c in keep))


def as_table(schema: pa.Schema, **cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) for f in schema], schema=schema)


def id_bitmap(ids: DataFrame, col: str) -> bytes:
    """A fixed-size bitmap of hashed ids (one hash): a superset test whose size never grows with the data.
    Past its capacity it only passes more rows on to the exact join behind it."""
    bit = F.pmod(F.xxhash64(F.col(col)), F.lit(BITMAP_BITS))
    rows = (ids.select((bit + 1).alias("p"))  # bitmap positions count from one
            .groupBy(F.bitmap_bucket_number("p").alias("b"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("m")).collect())
    out = bytearray(BITMAP_BITS // 8)
    for r in rows:
        at = (r.b - 1) * 4096
        out[at:at + 4096] = bytes(r.m)
    return bytes(out)


def maybe_in(df: DataFrame, col: str, bitmap: bytes, inside: bool = True) -> DataFrame:
    """Rows whose id may be in the bitmap, or (``inside`` false) those whose id is not: the two parts make the whole.
    The test runs in the JVM, before any Python or shuffle sees the text; a null id is not in it."""
    spark = df.sparkSession
    p = F.pmod(F.xxhash64(F.col(col)), F.lit(BITMAP_BITS))
    step = 1 << 18  # bytes per row of the broadcast table
    parts = [bitmap[i:i + step] for i in range(0, len(bitmap), step)]
    table = F.broadcast(spark.createDataFrame([(i, bytearray(x)) for i, x in enumerate(parts)], "_part int, _bits binary"))
    at = F.shiftright(p, 3)
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.pmod(at, F.lit(step)) + 1).cast("int"), F.lit(1))), 16, 10)
    hit = F.col(col).isNotNull() & (F.getbit(byte.cast("int"), F.pmod(p, F.lit(8)).cast("int")) == 1)
    # xxhash64 of a null is its seed: every row finds its part
    return (df.join(table, F.floor(at / step) == F.col("_part")).where(hit if inside else ~hit).drop("_part", "_bits"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id that has an edge; component is the smallest id reachable.

    Each round every id takes the smallest label among its own, its neighbours' and its label's label; rounds end
    when no label changes.  Only the count of changes reaches the driver; each round is checkpointed."""
    from revsift.session import cut_lineage
    both = cut_lineage(edges.select(F.col(a).alias("src"), F.col(b).alias("dst"))
                       .union(edges.select(F.col(b), F.col(a))).where("src <> dst").distinct())
    labels = cut_lineage(both.groupBy("src").agg(F.min("dst").alias("m"))
                         .select(F.col("src").alias("id"), F.least("src", "m").alias("component")))
    while True:
        near = (both.join(labels, both.dst == labels.id).groupBy("src").agg(F.min("component").alias("near")))
        step = (labels.join(near, labels.id == near.src, "left")
                .select("id", "component", F.least("component", F.coalesce("near", "component")).alias("c1")))
        jump = labels.select(F.col("id").alias("c1"), F.col("component").alias("c2"))
        step = cut_lineage(step.join(jump, "c1", "left")
                           .select("id", F.least("c1", F.coalesce("c2", "c1")).alias("new"),
                                   (F.col("component") != F.least("c1", F.coalesce("c2", "c1"))).alias("moved")))
        labels = step.select("id", F.col("new").alias("component"))
        if not step.where("moved").limit(1).count():
            return labels
