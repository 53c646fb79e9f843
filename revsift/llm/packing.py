"""Packing by minimum bin slack.

A document of T ids is cut into full windows and one remainder of T mod capacity ids, so the bins left to fill depend
on nothing but the multiset of remainder lengths: a histogram of at most ``capacity`` numbers, whatever the corpus
size.  For the longest length left, a bitset subset-sum (one big integer per shift) finds the sums that the remaining
lengths can reach with their counts; the reachable sum closest to the capacity is backtracked to counts per length,
and that pattern is repeated as often as the counts last.  Every pattern uses up a length, so there are at most
``capacity`` patterns.  Spark numbers the pieces inside each length with salted counts and computes each piece's
pattern, repetition and offset from its number by arithmetic: no bin is ever built on the driver."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revsift.llm import common as C
from revsift.llm.word_ids import WordIds
from revsift.session import cut_lineage

#: Salts that split the numbering of a length shared by many pieces.
SALTS = 64

_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])
_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _cut(path: str, end_id: int, capacity: int):
    def run(batches):
        ids_of, end = WordIds(path), np.array([end_id], "<u4").tobytes()
        for b in batches:
            cols = {f.name: [] for f in _PIECES}
            # no token spans ASCII white space, so the ids of a text are those of its words in a row; the words of one
            # text at a time: those of a whole batch take ten times its size
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                ids = b"".join(map(ids_of.__getitem__, (text.as_py() or b"").split())) + end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    part = ids[4 * start:4 * (start + capacity)]
                    for k, v in (("doc_id", doc_id), ("start", start), ("length", len(part) // 4),
                                 ("ids_crc32", zlib.crc32(part)), ("doc_tokens", total)):
                        cols[k].append(v)
            yield C.as_table(_PIECES, **cols)
    return run


def fill(lengths: list[int], counts: list[int], capacity: int) -> tuple[int, list[int]]:
    """Closest reachable sum to ``capacity`` and how many of each length make it (bounded subset sum).

    ``reach[i]`` is the bitset of sums reachable with the first i items, where an item is a length times a power of
    two (binary splitting of its count); backtracking reads the items from the bitsets, last to first."""
    items, mask, reach = [], (1 << (capacity + 1)) - 1, [1]
    for i, (length, count) in enumerate(zip(lengths, counts)):
        k, left = 1, min(count, capacity // length)
        while left > 0:
            n = min(k, left)
            items.append((i, n))
            reach.append((reach[-1] | (reach[-1] << (n * length))) & mask)
            left -= n
            k *= 2
        if reach[-1] >> capacity & 1:
            break
    total = reach[-1].bit_length() - 1
    used, rest = [0] * len(lengths), total
    for (i, n), before in zip(reversed(items), reversed(reach[:-1])):
        if not before >> rest & 1:
            used[i] += n
            rest -= n * lengths[i]
    return total, used


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """[(repetitions, {length: pieces in one bin})] that uses every piece of the histogram once."""
    left = {n: c for n, c in histogram.items() if c > 0}
    out = []
    if capacity in left:
        out.append((left.pop(capacity), {capacity: 1}))
    while left:
        first = max(left)
        left[first] -= 1
        others = sorted(left, reverse=True)
        others = [n for n in others if left[n]]
        _, used = fill(others, [left[n] for n in others], capacity - first)
        left[first] += 1
        pattern = {first: 1}
        for n, k in zip(others, used):
            if k:
                pattern[n] = pattern.get(n, 0) + k
        times = min(left[n] // k for n, k in pattern.items())
        out.append((times, pattern))
        for n, k in pattern.items():
            left[n] -= times * k
            if not left[n]:
                del left[n]
    return out


def _slots(patterns: list[tuple[int, dict[int, int]]]) -> list[tuple]:
    """(length, first number, pieces per bin, first bin, offset of the first of them) per pattern and length."""
    rows, used, bins = [], {}, 0
    for times, pattern in patterns:
        offset = 0
        for n in sorted(pattern, reverse=True):
            k = pattern[n]
            rows.append((n, used.get(n, 0), times * k, k, bins, offset))
            used[n] = used.get(n, 0) + times * k
            offset += n * k
        bins += times
    return rows


def pack(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096,
         end_id: int = 2) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A null or empty text is the end id alone; repeated rows and null ids are documents of their own; other columns
    are not read; an empty table gives an empty result.  Equal lengths are numbered by (doc_id, start, checksum)."""
    spark = C.prepare(df.sparkSession)
    docs = C.with_text(df, text_col, F.col(id_col).cast("long").alias("doc_id"))
    pieces = cut_lineage(docs.mapInArrow(C.trimmed(_cut(path, end_id, capacity)), _DDL)
                         .withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(SALTS))))
    counts = cut_lineage(pieces.groupBy("length", "salt").count())
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.withColumn("base", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    rows = _slots(plan(histogram, capacity))
    slots = spark.createDataFrame(rows, "length long, first long, n long, per_bin long, bin long, at long")
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32")
    numbered = (pieces.withColumn("i", F.row_number().over(inside) - 1)
                .join(base, ["length", "salt"]).withColumn("number", F.col("i") + F.col("base")))
    # at most capacity lengths, each in a bounded number of patterns: the table of slots is bounded
    s = F.broadcast(slots.groupBy("length").agg(F.sort_array(F.collect_list(F.struct(
        "first", "n", "per_bin", "bin", "at"))).alias("slots")))
    hit = F.filter("slots", lambda x: (x["first"] <= F.col("number")) & (F.col("number") < x["first"] + x["n"]))[0]
    k = F.col("number") - F.col("hit.first")
    return (numbered.join(s, "length").withColumn("hit", hit)
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                    (F.col("hit.bin") + F.floor(k / F.col("hit.per_bin"))).alias("sequence_id"),
                    (F.col("hit.at") + F.pmod(k, F.col("hit.per_bin")) * F.col("length")).alias("offset")))
