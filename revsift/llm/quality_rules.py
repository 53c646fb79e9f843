"""Quality rules from repetition coverage.

Words become 64-bit hashes; rolling hashes of several n-gram lengths are compared inside each text with numpy.  An
(n+1)-gram can only repeat where its n-gram prefix repeats, so each length looks at the survivors of the one before.
Coverage of a length is the share of word characters that lie in a later occurrence of a repeated n-gram; for lines,
the share that lies in lines equal to an earlier one.  Everything is per row: no shuffle."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revsift.llm import common as C

#: n-gram length -> largest share of word characters that later occurrences of repeated n-grams may cover.
COVERAGE_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Largest share of lines, and of word characters in lines, that may equal an earlier line.
LINE_LIMIT, LINE_CHARS_LIMIT = 0.30, 0.20
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_LENGTHS = tuple(range(2, max(COVERAGE_LIMITS) + 1))
_SYMBOLS = np.zeros(256, np.int64)
_SYMBOLS[list(b"#*$%&|<>")] = 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()),
                  ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
                  ("n_lines", pa.int64()), ("dup_line_chars", pa.int64()), ("dup_ngram_chars", pa.list_(pa.int64()))])
_DDL = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "n_lines long, dup_line_chars long, dup_ngram_chars array<long>")


def _covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie in an n-gram that starts at one of ``starts``."""
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + n, -1)
    return np.cumsum(edge[:-1]) > 0


def repetition(h: np.ndarray, lengths: np.ndarray) -> tuple[int, list[int]]:
    """(words in 3-grams found twice or more, per n in 2..10 the characters in later occurrences of repeated n-grams)."""
    size, repeat_words, chars = len(h), 0, []
    at = np.arange(size)
    key = h
    for n in _LENGTHS:
        at = at[at + n <= size]
        if not len(at):
            chars.append(0)
            continue
        key = C.rolling(h, n)[at]
        order = np.argsort(key, kind="stable")
        k = key[order]
        same = k[1:] == k[:-1]
        later = np.zeros(len(k), bool)
        later[1:] = same                       # stable: positions ascend inside equal keys
        member = later.copy()
        member[:-1] |= same
        if n == 3:
            repeat_words = int(_covered(at[order[member]], n, size).sum())
        chars.append(int(lengths[_covered(at[order[later]], n, size)].sum()))
        at = np.sort(at[order[member]])
    return repeat_words, chars


def _line_stats(text: bytes) -> tuple[int, int, int]:
    """(lines with a word, those equal to an earlier line, word characters in the latter)."""
    seen, lines, dup, chars = set(), 0, 0, 0
    for line in text.split(b"\n"):
        if line and line.split(None, 1):
            lines += 1
            if line in seen:
                dup += 1
                chars += sum(len(w.decode("utf-8", "replace")) for w in line.split())
            else:
                seen.add(line)
    return lines, dup, chars


def _measure(batches):
    cache = C.WordHash()
    for b, texts in C.text_batches(batches):
        cols = {f.name: [] for f in _OUT}
        cols["doc_id"] = b.column("doc_id")
        for text in texts:
            text = text or b""
            raw = np.frombuffer(text, np.uint8)
            space = _SPACE[raw]
            words = text.split()
            h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
            # code points per word: bytes that don't continue a character, summed from each word's first byte
            first = np.flatnonzero(~space & np.concatenate(([True], space[:-1]))) if len(raw) else raw
            point = (~space & ((raw & 0xC0) != 0x80)).astype(np.int64)
            lengths = np.add.reduceat(point, first) if len(first) else np.empty(0, np.int64)
            lines, dup, dup_chars = _line_stats(text)
            repeat_words, chars = repetition(h, lengths)
            for k, v in (("n_words", len(words)), ("word_chars", int(lengths.sum())),
                         ("n_symbols", int(_SYMBOLS[raw].sum())), ("n_dup_lines", dup),
                         ("n_repeat_words", repeat_words), ("n_lines", lines), ("dup_line_chars", dup_chars),
                         ("dup_ngram_chars", chars)):
                cols[k].append(v)
        yield C.as_table(_OUT, **cols)


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row its counts, ``dup_ngram_chars`` (one number per n-gram length from 2 to 10), ``base_failed``,
    ``repetitive`` (the method's verdict) and ``kept``.

    A null text counts as empty: all counts 0 and base_failed, since it has fewer than MIN_WORDS words.  Repeated
    rows and null ids give a row each; other columns are not read; an empty table gives an empty result."""
    C.prepare(df.sparkSession)
    m = C.with_text(df, text_col, F.col(id_col).cast("long").alias("doc_id")).mapInArrow(_measure, _DDL)
    too_much = [F.col("dup_ngram_chars")[n - 2] > F.lit(limit) * F.col("word_chars")
                for n, limit in COVERAGE_LIMITS.items()]
    too_much += [F.col("n_dup_lines") > F.lit(LINE_LIMIT) * F.col("n_lines"),
                 F.col("dup_line_chars") > F.lit(LINE_CHARS_LIMIT) * F.col("word_chars")]
    verdict = too_much[0]
    for c in too_much[1:]:
        verdict = verdict | c
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (m.withColumn("base_failed", failed).withColumn("repetitive", verdict)
            .withColumn("kept", ~F.col("base_failed") & ~F.col("repetitive")))
