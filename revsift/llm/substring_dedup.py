"""Exact substring deduplication by recompression.

Every text is parsed bottom-up.  Round 0 names maximal runs of one word.  In each later round a hash deals the symbols
to a left and a right side, and every left symbol followed by a right one becomes one symbol, named after the two.  A
name is a 64-bit hash of what it stands for, so equal pairs get equal names in every task and no dictionary is
shuffled.  With each symbol goes its *context*: the words that alone decide that the symbol is there.  Wherever a
window of words occurs, the symbols whose context lies inside it are the same.

A window's anchor is the symbol of most words (ties: smallest hash) among those; a window without one, such as the
inside of a long run, is its own anchor.  Equal windows so have equal anchors.  Spark gathers the anchors: one that
lies in a single text ends there.  Texts with shared anchors are read once more, and the windows at those anchors are
verified by a 96-bit hash of their words against the smallest document that has them."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revsift.llm import common as C
from revsift.session import cut_lineage

#: Rounds of pair naming; a symbol whose context can't fit a window is useless, so few are enough.
ROUNDS = 6
#: Bytes of text parsed together: their symbols take about a hundred times as much while they are named.
BLOCK_BYTES = 1_500_000
_FAR = np.int64(1) << np.int64(40)


def _name(*parts) -> np.ndarray:
    acc = np.full(len(parts[0]), 0x2545F4914F6CDD1D, np.uint64)
    for p in parts:
        acc = C.mix64(acc ^ p.astype(np.uint64, copy=False))
    return acc


def _runs(words: np.ndarray, text: np.ndarray):
    """Round 0: (name, first word, end, context start, context end, text) of the maximal runs of equal words."""
    n = len(words)
    new = np.ones(n, bool)
    new[1:] = (words[1:] != words[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    end = np.append(at[1:], n)
    size = end - at
    name = np.where(size > 1, _name(words[at], size), words[at])
    t = text[at]
    # the words beside a run show that it ends there; a text's edge shows nothing
    lo = np.where(np.append(False, t[1:] == t[:-1]), at - 1, -_FAR)
    hi = np.where(np.append(t[1:] == t[:-1], False), end + 1, _FAR)
    return name, at, end, lo, hi, t


def _pairs(name, at, end, lo, hi, t, r: int):
    """One round of pair naming.  A pair is decided by its two symbols; a left symbol that stays single also by the
    one after it, a right one by the one before it."""
    right = (C.mix64(name + np.uint64(r * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> np.uint64(63)).astype(bool)
    near = t[1:] == t[:-1]
    first = np.append(~right[:-1] & right[1:] & near, False)
    second = np.append(False, first[:-1])
    alone_l = ~right & ~first
    alone_r = right & ~second
    after_hi = np.append(np.where(near, hi[1:], _FAR), _FAR)
    before_lo = np.append(-_FAR, np.where(near, lo[:-1], -_FAR))
    after_lo = np.append(np.where(near, lo[1:], _FAR), _FAR)
    before_hi = np.append(-_FAR, np.where(near, hi[:-1], -_FAR))
    joined = first | alone_l
    new_lo = np.where(joined, np.minimum(lo, after_lo), np.minimum(lo, before_lo))
    new_hi = np.where(joined, np.maximum(hi, after_hi), np.maximum(hi, before_hi))
    both = np.flatnonzero(first)
    out = name.copy()
    out[both] = _name(name[both], name[both + 1], np.full(len(both), r))
    new_end = end.copy()
    new_end[both] = end[both + 1]
    keep = ~second
    return out[keep], at[keep], new_end[keep], new_lo[keep], new_hi[keep], t[keep]


def anchors(words: np.ndarray, text: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window start, anchor, window hash) of every window of ``window`` words inside one text, for the word hashes
    of several texts in a row."""
    n = len(words) - window + 1
    if n <= 0:
        e = np.empty(0, np.uint64)
        return np.empty(0, np.int64), e, e
    starts = np.flatnonzero(text[:n] == text[window - 1:])
    best = np.full(n, ~np.uint64(0))
    level = _runs(words, text)
    for r in range(ROUNDS + 1):
        if r:
            level = _pairs(*level, r)
        name, at, end, lo, hi, _ = level
        ok = hi - lo <= window
        lo, hi, span = lo[ok], hi[ok], (end - at)[ok]
        # most words first, then the smallest hash; the hash of the name is the rest of the key
        key = ((window - np.minimum(span, window)).astype(np.uint64) << np.uint64(59)) | (C.mix64(name[ok]) >> np.uint64(5))
        for d in range(window):
            i = lo - d
            fits = (i >= 0) & (i >= hi - window) & (i < n)
            if not fits.any():
                continue
            np.minimum.at(best, i[fits], key[fits])
    whole = C.rolling(words, window)
    own = best == ~np.uint64(0)
    best[own] = whole[own] | np.uint64(1 << 63)
    return starts, best[starts], whole[starts]


def _blocks(batches):
    """Rows in blocks of bounded text size: (batch, first row, texts)."""
    for b, texts in C.text_batches(batches):
        a, size = 0, 0
        for i, t in enumerate(texts):
            size += len(t or b"")
            if size >= BLOCK_BYTES or i == len(texts) - 1:
                yield b, a, texts[a:i + 1]
                a, size = i + 1, 0


def _flat(texts, cache):
    hashes = C.word_hashes(texts, cache, lower=False)
    sizes = np.array([len(h) for h in hashes], np.int64)
    flat = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    return flat, np.repeat(np.arange(len(sizes)), sizes), np.concatenate(([0], np.cumsum(sizes)))


def _emit_anchors(window: int):
    def run(batches):
        cache, seen = C.WordHash(), set()
        for b, a, texts in _blocks(batches):
            s1 = b.column("s1").to_pylist()[a:a + len(texts)]
            fresh = []
            for s, t in zip(s1, texts):
                if s not in seen:
                    seen.add(s)
                    fresh.append((s, t))
            if len(seen) > 200_000:
                seen.clear()
            flat, text, _ = _flat([t for _, t in fresh], cache)
            starts, key, _ = anchors(flat, text, window)
            t = text[starts]
            # neighbouring windows mostly share their anchor: one row per stretch
            new = np.ones(len(starts), bool)
            new[1:] = (key[1:] != key[:-1]) | (t[1:] != t[:-1])
            owner = np.array([s for s, _ in fresh], np.int64)[t[new]] if len(starts) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key[new].view(np.int64)), pa.array(owner, pa.int64())],
                                             names=["anchor", "s1"])
    return run


def _emit_windows(window: int):
    def run(batches):
        cache = C.WordHash()
        for b, a, texts in _blocks(batches):
            ids = b.column("doc_id").to_pylist()[a:a + len(texts)]
            s1 = b.column("s1").to_pylist()[a:a + len(texts)]
            wanted = b.column("anchors").slice(a, len(texts))
            flat, text, offset = _flat(texts, cache)
            starts, key, whole = anchors(flat, text, window)
            t = text[starts]
            hit = np.zeros(len(starts), bool)
            edges = np.searchsorted(t, np.arange(len(texts) + 1))
            for i in range(len(texts)):
                own = slice(edges[i], edges[i + 1])
                hit[own] = np.isin(key[own].view(np.int64), wanted[i].values.to_numpy())
            starts, whole, t = starts[hit], whole[hit], t[hit]
            check = C.rolling(C.mix64(flat ^ np.uint64(0xA0761D6478BD642F)), window)[starts] if len(starts) else whole
            yield pa.RecordBatch.from_arrays(
                [pa.array(whole.view(np.int64)), pa.array((check >> np.uint64(33)).astype(np.int32)),
                 pa.array(np.array(ids, np.int64)[t]), pa.array(np.array(s1, np.int64)[t]),
                 pa.array((starts - offset[t]).astype(np.int32))], names=["w", "w2", "doc_id", "s1", "at"])
    return run


def _strip(window: int, digest: bool, keep):
    def run(batches):
        for b, texts in C.text_batches(batches):
            words, removed, kept = [], [], []
            for t, at, copy in zip(texts, b.column("starts"), b.column("copy").to_pylist()):
                w = t.split() if t else []
                words.append(len(w))
                if copy and len(w) >= window:
                    w = []
                elif at.is_valid and len(w):
                    edge = np.zeros(len(w) + 1, np.int64)
                    starts = at.values.to_numpy()
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, starts + window, -1)
                    w = [x for x, gone in zip(w, np.cumsum(edge[:-1]).tolist()) if not gone]
                removed.append(words[-1] - len(w))
                text = b" ".join(w)
                kept.append(hashlib.sha256(text).hexdigest() if digest else text.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(words, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.string()), *b.columns[4:]], names=["doc_id", "n_words", "n_removed", "kept", *keep])
    return run


def substring_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13,
                    digest: bool = False, keep=()) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, kept`` (the kept words joined by one space; with
    ``digest`` the lowercase hex SHA-256 of that) and the columns named in ``keep``.

    A word goes if a window of ``window`` words covers it whose words also start in a document with a smaller id.
    Words are compared unchanged.  Null, empty and short texts lose nothing; rows with a null id lose nothing and
    make nobody else lose words; rows that repeat an id with equal text are no smaller document for each other; other
    columns are not read; an empty table gives an empty result."""
    C.prepare(df.sparkSession)
    extra, ddl = C.carried(df, keep)
    full = (C.with_text(df, text_col, F.col(id_col).cast("long").alias("doc_id"), *extra)
            .withColumn("s1", F.coalesce(F.xxhash64("text"), F.lit(0)))
            .withColumn("s2", F.coalesce(F.xxhash64(F.lit(1), "text"), F.lit(0))))
    docs = full.select("doc_id", "text", "s1", "s2")
    ids = docs.where("doc_id is not null").select("doc_id", "s1", "s2")
    classes = cut_lineage(ids.groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("size")))

    # anchors that at least two texts share
    e = (docs.where("doc_id is not null").select("s1", "text")
         .mapInArrow(C.trimmed(_emit_anchors(window)), "anchor long, s1 long"))
    w = Window.partitionBy("anchor")
    shared = (e.withColumn("lo", F.min("s1").over(w)).withColumn("hi", F.max("s1").over(w))
              .where("lo <> hi").groupBy("s1").agg(F.collect_set("anchor").alias("anchors")))
    shared = cut_lineage(shared.join(classes.select("s1", "rep"), "s1"))

    # the windows at shared anchors, against the smallest document that has them
    near = C.maybe_in(docs, "doc_id", C.id_bitmap(shared, "rep")).select("doc_id", "s1", "text")
    near = near.join(shared.select(F.col("rep").alias("doc_id"), "s1", "anchors"), ["doc_id", "s1"])
    windows = near.mapInArrow(C.trimmed(_emit_windows(window)), "w long, w2 int, doc_id long, s1 long, at int")
    first = Window.partitionBy("w", "w2")
    starts = cut_lineage(windows.withColumn("least", F.min("doc_id").over(first)).where("least < doc_id")
                         .groupBy("doc_id", "s1").agg(F.collect_set("at").alias("starts")))

    # later copies of a whole text lose every word, if they have a window at all
    copies = (ids.join(classes.where("size > 1"), ["s1", "s2"]).where("rep < doc_id")
              .select("doc_id", "s1", F.lit(None).cast("array<int>").alias("starts"), F.lit(True).alias("copy")).distinct())
    found = cut_lineage(starts.withColumn("copy", F.lit(False)).union(copies))
    touched = C.id_bitmap(found, "doc_id")
    hit = C.maybe_in(full, "doc_id", touched).join(found, ["doc_id", "s1"], "left")
    rest = (C.maybe_in(full, "doc_id", touched, inside=False)
            .withColumn("starts", F.lit(None).cast("array<int>")).withColumn("copy", F.lit(False)))
    cols = ["doc_id", "text", "starts", "copy", *(f"_keep_{i}" for i in range(len(keep)))]
    return (hit.select(*cols).union(rest.select(*cols))
            .mapInArrow(C.trimmed(_strip(window, digest, list(keep))), f"doc_id long, n_words long, n_removed long, kept string{ddl}"))
