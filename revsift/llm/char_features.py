"""Hashed character n-gram counts of whole texts, and document frequencies of the buckets over a whole table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revsift.llm import common as C

#: Code points handled at once; longer texts are cut with an overlap, so no n-gram is lost.
BLOCK = 1 << 21
_K = np.uint32(0x9E3779B1)
_M = np.uint32(0x85EBCA6B)


def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x10000)), bool, 0x10000)


class CharNgrams:
    """text -> counts in ``1 << bits`` buckets of its n-grams of 1..n characters.

    ``fold``: case is folded and everything but letters reads as a space (language); otherwise characters count as
    they are and digits read as 0 (quality)."""

    def __init__(self, bits: int, n: int, fold: bool):
        self.bits, self.n, self.fold = bits, n, fold
        self.letters = _letters()

    def points(self, text: str) -> np.ndarray:
        c = np.frombuffer((text.lower() if self.fold else text).encode("utf-32-le", "surrogatepass"), "<u4")
        if self.fold:
            return np.where(self.letters[np.minimum(c, 0xFFFF)] | (c > 0xFFFF), c, np.uint32(32))
        return np.where((c >= 48) & (c <= 57), np.uint32(48), c)

    def counts(self, text: str | None) -> np.ndarray:
        total = np.zeros(1 << self.bits, np.int64)
        if not text:
            return total
        c = self.points(text)
        for at in range(0, len(c), BLOCK):
            part = c[at:at + BLOCK + self.n - 1]
            h = part * _M + np.uint32(1)
            shift = np.uint32(32 - self.bits)
            for k in range(1, self.n + 1):
                take = min(BLOCK, len(part) - k + 1)
                if take <= 0:
                    break
                if k > 1:
                    h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * _M + part[k - 1:]
                total += np.bincount((h[:take] * _K) >> shift, minlength=1 << self.bits)
        return total


def document_frequency(df: DataFrame, text_col: str, feats: CharNgrams) -> tuple[np.ndarray, int]:
    """(texts that have each bucket, texts) over every non-null text of ``df``; partial sums per task, then Spark."""
    def run(batches):
        total, n = np.zeros(1 << feats.bits, np.int64), 0
        for b in batches:
            for t in b.column("text").to_pylist():
                if t:
                    total += feats.counts(t) > 0
                    n += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(total))), pa.array(np.append([n], total))],
                                         names=["bucket", "n"])
    rows = (df.select(F.col(text_col).cast("string").alias("text")).mapInArrow(C.trimmed(run), "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).where("n > 0").toPandas())
    total = np.zeros(1 << feats.bits, np.int64)
    inside = rows["bucket"].to_numpy() >= 0
    total[rows["bucket"].to_numpy()[inside]] = rows["n"].to_numpy()[inside]
    return total, int(rows["n"][~inside].sum())


def idf(df_counts: np.ndarray, n: int) -> np.ndarray:
    return (np.log((1.0 + n) / (1.0 + df_counts)) + 1.0).astype(np.float32)


def weighted(counts: np.ndarray, idf_: np.ndarray) -> np.ndarray:
    """Sublinear tf times idf, length one (a text without n-grams stays zero)."""
    v = np.log1p(counts.astype(np.float32)) * idf_
    norm = np.sqrt(v @ v)
    return v / norm if norm > 0 else v


def sparse_rows(df: DataFrame, feats: CharNgrams, *cols: str, extra=lambda text: []) -> list:
    """Collected (cols..., index array, count array, further numbers) of a *bounded* labelled sample with a text."""
    names = list(cols)

    def run(batches):
        for b in batches:
            at, cnt, more = [], [], []
            for t in b.column("text").to_pylist():
                c = feats.counts(t)
                i = np.flatnonzero(c)
                at.append(i.astype("<i4").tobytes())
                cnt.append(c[i].astype("<i4").tobytes())
                more.append([float(x) for x in extra(t)])
            yield pa.RecordBatch.from_arrays([b.column(n) for n in names] + [pa.array(at, pa.binary()),
                                                                            pa.array(cnt, pa.binary()),
                                                                            pa.array(more, pa.list_(pa.float64()))],
                                             names=[*names, "at", "cnt", "extra"])
    types = dict(df.dtypes)
    ddl = ", ".join(f"{n} {types[n]}" for n in names) + ", at binary, cnt binary, extra array<double>"
    return df.select(*names, F.col("text")).mapInArrow(C.trimmed(run), ddl).collect()


def dense(row, bits: int) -> np.ndarray:
    v = np.zeros(1 << bits, np.int64)
    v[np.frombuffer(row["at"], "<i4")] = np.frombuffer(row["cnt"], "<i4")
    return v
