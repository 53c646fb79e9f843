"""Document fingerprints by one-permutation MinHash, in DataFrame expressions only.

The hashes of a text's word shingles are taken once.  Their top bits choose a bin, and each bin keeps its smallest
hash; a bin that no shingle falls into borrows from the first filled bin on its own hashed walk over the bins
(optimal densification), and hashes what it borrows with its own number.  Of every bin only the low-order bits are kept,
packed as hex digits.  Two unrelated digits agree once in 2**bits by chance; the likeness takes that bias out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revsift.llm import common as C

WORDS = 5
#: Bins are 2**BIN_BITS; the low DIGIT_BITS = 4 bits of each are one hex digit.
BIN_BITS = 7
BINS = 1 << BIN_BITS
PROBES = 8
#: Rows a neighbour bucket aims at, and quantiles of the ids that bound the buckets.
BUCKET_ROWS, QUANTILES = 4000, 128


def _lent(b: Column) -> Column:
    """What an empty bin borrows: it probes bins by a hash of (bin, attempt) until one is filled; after PROBES failures
    it takes the filled bin of the smallest hash, the end of the same walk for nearly empty texts."""
    probe = [F.get("_v", F.pmod(F.xxhash64(b, F.lit(t)), F.lit(BINS)).cast("int")) for t in range(PROBES)]
    last = F.array_min(F.transform("_b", lambda c: F.struct(F.xxhash64(b, c, F.lit(-1)).alias("h"), c.alias("c"))))["c"]
    return F.coalesce(*probe, F.get("_v", last))


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``, the fingerprint of the text column: BINS hex digits.  Words are maximal runs without ASCII white
    space; a text of fewer than five is one shingle, a null text counts as empty and has a fingerprint too."""
    keep = [F.col(f"`{c}`") for c in df.columns]
    trimmed = F.expr(f"trim(BOTH ' \\t\\n\\u000b\\u000c\\r' FROM coalesce(`{text}`, ''))")
    step = df.select(*keep, F.split(trimmed, "[\\x20\\x09-\\x0D]+").alias("_w"))
    step = step.select(*keep, F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"))
    many = F.transform(F.sequence(F.lit(1), F.size("_h") - (WORDS - 1)), lambda i: F.xxhash64(F.slice("_h", i, WORDS)))
    step = step.select(*keep, F.sort_array(F.when(F.size("_h") < WORDS, F.array(F.xxhash64("_h"))).otherwise(many)).alias("_s"))
    shift = 64 - BIN_BITS
    first = F.filter("_s", lambda x, i: (i == 0) | (F.shiftright(x, shift) != F.shiftright(F.get("_s", i - 1), shift)))
    step = step.select(*keep, first.alias("_m"))
    step = step.select(*keep, "_m", F.transform("_m", lambda x: (F.shiftright(x, shift) + BINS // 2).cast("int")).alias("_b"))
    step = step.select(*keep, "_b", F.map_from_arrays("_b", "_m").alias("_d"))
    own = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: F.try_element_at("_d", b))
    step = step.select(*keep, "_b", own.alias("_v"))
    # a borrowed hash is hashed with the bin that borrows it, or texts of few shingles would agree in one digit everywhere
    full = F.when(F.size("_b") == BINS, F.col("_v")).otherwise(
        F.transform("_v", lambda v, b: F.coalesce(v, F.xxhash64(_lent(b), b))))
    step = step.select(*keep, full.alias("_f"))
    return step.select(*keep, F.array_join(F.transform("_f", lambda v: F.substring(F.lit("0123456789abcdef"), v.bitwiseAND(F.lit(15)).cast("int") + 1, F.lit(1))), "").alias(out))


def likeness(a: str, b: str) -> Column:
    """Estimated resemblance of two fingerprints, 0..1: share of equal digits without those equal by chance."""
    same = F.size(F.filter(F.sequence(F.lit(1), F.lit(BINS)),
                           lambda i: F.substring(F.col(a), i, F.lit(1)) == F.substring(F.col(b), i, F.lit(1))))
    chance = 1.0 / 16
    return F.greatest(F.lit(0.0), (same / F.lit(float(BINS)) - chance) / (1 - chance))


def _with_bucket(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Adds ``bucket (c, f)``: ascending ranges of doc_id of about BUCKET_ROWS rows.  Quantiles of the ids bound the
    coarse ranges c, each split evenly into f; null ids come first."""
    n = ids.count()
    cuts = sorted({int(x) for x in ids.approxQuantile("doc_id", [i / QUANTILES for i in range(QUANTILES + 1)], 0.001)})
    if not cuts:
        return docs.withColumn("c", F.lit(-1)).withColumn("f", F.lit(0))
    bounds = F.array(*[F.lit(x).cast("long") for x in cuts])
    fine = max(1, round(n / len(cuts) / BUCKET_ROWS))
    c = F.when(F.col("doc_id").isNull(), -1).otherwise(F.size(F.filter(bounds, lambda x: x <= F.col("doc_id"))))
    docs = docs.withColumn("c", c)
    low, high = F.get(bounds, F.greatest(F.col("c") - 1, F.lit(0))), F.get(bounds, F.col("c"))
    part = F.floor(fine * ((F.col("doc_id").cast("double") - low) / F.greatest(high - low, F.lit(1))))
    return docs.withColumn("f", F.when((F.col("c") <= 0) | high.isNull(), 0)
                           .otherwise(F.greatest(F.lit(0), F.least(F.lit(fine - 1), part))).cast("int"))


def with_next(docs: DataFrame, value_cols: list[str], derive=lambda d: d) -> DataFrame:
    """Adds ``next_<col>`` of the row after each in descending doc_id (ties by text, null ids last; after the last
    the first).  Rows are dealt into ranges of ids; a range also gets a copy of the next lower range's first rows, so
    each is finished alone.  ``derive`` adds columns once the copies are chosen, so it runs once per row."""
    ids = docs.select("doc_id")
    real = _with_bucket(docs, ids)
    top = _with_bucket(ids, ids).groupBy("c", "f").agg(F.max("doc_id").alias("top"))
    # the next higher range of each range: neighbours inside a coarse range, then across their few ends
    w = Window.partitionBy("c").orderBy("f")
    top = top.withColumn("to_f", F.lead("f").over(w)).withColumn("to_c", F.when(F.col("to_f").isNotNull(), F.col("c")))
    ends = top.groupBy("c").agg(F.min("f").alias("low_f"))
    lead_c = Window.orderBy("c")  # at most QUANTILES + 2 rows
    ends = ends.withColumn("up_c", F.lead("c").over(lead_c)).withColumn("up_f", F.lead("low_f").over(lead_c))
    ends = ends.withColumn("up_c", F.coalesce("up_c", F.first("c").over(lead_c))).withColumn(
        "up_f", F.coalesce("up_f", F.first("low_f").over(lead_c)))
    to = (top.join(F.broadcast(ends), "c")
          .select(F.col("top"), F.coalesce("to_c", "up_c").alias("c"), F.coalesce("to_f", "up_f").alias("f")))
    # few rows are wanted here: a bitmap of their ids thins the table before the join
    known = to.where("top is not null")
    ghost = C.maybe_in(docs, "doc_id", C.id_bitmap(known, "top")).join(known, F.col("doc_id") == F.col("top")).drop("top")
    none = to.where("top is null").drop("top")
    ghost = ghost.unionByName(docs.where("doc_id is null").join(F.broadcast(none), F.lit(True)).select(ghost.columns))
    both = derive(real.withColumn("ghost", F.lit(0)).unionByName(ghost.withColumn("ghost", F.lit(1))))
    order = Window.partitionBy("c", "f").orderBy("ghost", F.desc_nulls_last("doc_id"), "text")
    for v in value_cols:
        both = both.withColumn(f"next_{v}", F.lead(v).over(order))
    return both.where("ghost = 0").drop("ghost", "c", "f")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``.  The edited text has its last third replaced by as many characters (or all) of the next document's
    beginning.  A null text counts as empty; repeated rows and null ids give a row each; other columns are not read;
    a single row is its own next; an empty table gives an empty result."""
    C.prepare(df.sparkSession)
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    docs = with_next(docs, ["text", "fingerprint"], lambda d: with_fingerprint(d, "text", "fingerprint"))
    docs = docs.withColumn("n_chars", F.char_length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    docs = docs.withColumn("edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - cut).cast("int")),
                                              F.substring("next_text", F.lit(1), cut))).drop("text", "next_text")
    docs = docs.withColumn("edited_sha256", F.sha2(F.encode("edited", "UTF-8"), 256))
    docs = with_fingerprint(docs, "edited", "edited_fingerprint").drop("edited")
    return docs.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
                       likeness("fingerprint", "next_fingerprint").alias("near_next"))
