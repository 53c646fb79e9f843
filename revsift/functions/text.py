"""Scalar text expressions.  All but :func:`clean_text` are built-in Column
expressions, so they run inside whole-stage codegen on the executors."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import LETTER_TOKEN_RX, NONE_TOKEN, WHITESPACE_CLASS, WORD_RX


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ws(col) -> Column:
    """Python ``str.strip()``: remove every Unicode whitespace at both ends
    (``F.trim`` only removes ASCII spaces)."""
    ws = WHITESPACE_CLASS
    # a run is tried from its first character alone, so long runs cost their length
    return F.regexp_replace(_c(col), f"^{ws}++|(?<!{ws}){ws}++$", "")


def clean_text(col) -> Column:
    """strip -> collapse whitespace runs to one space -> drop every character
    that is not an ASCII letter, digit or space.  The order matters: edge and
    double spaces can survive the last step.

    An Arrow function: ``str.split`` knows the same white space as
    ``WHITESPACE_CLASS``, and splitting and dropping bytes cost far less than
    three regular expressions, which took most of the cleaning's time."""
    drop = bytes(set(range(128)) - set(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789 "))

    def clean(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else " ".join(t.decode("utf-8", "replace").split()).encode("ascii", "ignore")
                         .translate(None, drop).decode() for t in texts.to_pylist()], pa.string())
    return F.arrow_udf(clean, "string")(_c(col).cast("string").cast("binary"))


def computed_once(df: DataFrame, **cols: Column) -> DataFrame:
    """Sets columns to expressions that each row evaluates once.  A generator's
    output is not replaced by its expression, so filters and projections above
    read the value and don't repeat the work."""
    made = F.inline(F.array(F.struct(*[c.alias(f"_once_{n}") for n, c in cols.items()])))
    out = df.select("*", made)
    kept = [F.col(f"`_once_{n}`").alias(n) if n in cols else F.col(f"`{n}`") for n in df.columns]
    return out.select(*kept, *[F.col(f"`_once_{n}`").alias(n) for n in cols if n not in df.columns])


def fill_none(col) -> Column:
    return F.coalesce(_c(col), F.lit(NONE_TOKEN))


def char_length(col) -> Column:
    return F.length(_c(col)).cast("bigint")


def split_word_count(col) -> Column:
    """``len(s.split())`` on cleaned text (whitespace there is only spaces)."""
    return F.regexp_count(_c(col), F.lit("[^ ]+")).cast("bigint")


def regex_word_count(col) -> Column:
    """Number of ``\\b\\w+\\b`` matches."""
    return F.regexp_count(_c(col), F.lit(WORD_RX)).cast("bigint")


def letter_tokens(lower_col) -> Column:
    """``[a-z]+`` runs bounded by word boundaries (``abc1`` yields nothing)."""
    return F.regexp_extract_all(_c(lower_col), F.lit(LETTER_TOKEN_RX), 0)


def title_case(col) -> Column:
    """Python ``str.title()``: a letter run starts upper case, the rest of the
    run is lower case; any non-letter (digit, apostrophe) starts a new run."""
    runs = F.regexp_extract_all(F.lower(_c(col)), F.lit(r"[^\p{L}]+|\p{L}+"), 0)
    cased = F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.substring(r, 2, 1 << 30)))
    return F.when(_c(col).isNull(), F.lit(None).cast("string")).otherwise(F.array_join(cased, ""))


def padded_lower(col) -> Column:
    return F.concat(F.lit(" "), F.lower(_c(col)), F.lit(" "))


def contains_any(col, terms) -> Column:
    """True when any literal term is a substring (``any(t in s for t in terms)``)."""
    c = _c(col)
    out = F.lit(False)
    for t in terms:
        out = out | F.contains(c, F.lit(t))
    return out
