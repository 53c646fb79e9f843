"""Exact quantiles with bounded state.

``percentile`` keeps a map of all distinct values of a column, in every task and in the final one.  That is fine for
ratings and lengths, and too much for a column of many distinct values in a very large table.  Here a mergeable sketch
(``percentile_approx``) gives a bracket around the wanted rank; one pass counts the rows below and inside it, and the
search goes on inside the bracket until its distinct values fit a bound.  Those are grouped and counted, and the answer
is read off: the same number that sorting all rows would give."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size of the sketch, and distinct values that the last step groups.
ACCURACY, MAX_VALUES = 10_000, 100_000


def order_statistics(df: DataFrame, col: str, ranks, accuracy: int = ACCURACY, max_values: int = MAX_VALUES) -> dict:
    """{rank: value} of the non-null values of ``col`` in ascending order (rank 0 is the least), exact."""
    values = df.select(F.col(col).alias("v")).where("v is not null")
    return {k: _order_statistic(values, k, accuracy, max_values) for k in sorted(set(ranks))}


def _order_statistic(values: DataFrame, rank: int, accuracy: int, max_values: int):
    below, inside = 0, values     # rows left out below the bracket, rows inside it
    margin = 2.0 / accuracy
    while True:
        n, distinct, least, most = inside.agg(F.count("v"), F.approx_count_distinct("v", 0.02), F.min("v"), F.max("v")).first()
        if least == most:
            return least
        if distinct <= max_values:
            for r in inside.groupBy("v").count().orderBy("v").toLocalIterator():   # about max_values rows at most
                below += r["count"]
                if rank < below:
                    return r["v"]
        at = (rank - below + 0.5) / n
        lo, hi = inside.agg(F.percentile_approx("v", [max(0.0, at - margin), min(1.0, at + margin)], accuracy)).first()[0]
        smaller, upto = inside.agg(F.count_if(F.col("v") < F.lit(lo)), F.count_if(F.col("v") <= F.lit(hi))).first()
        if below + smaller <= rank < below + upto and upto - smaller < n:
            below, inside = below + smaller, inside.where(F.col("v").between(lo, hi))
        else:   # the bracket missed the rank, or is all there is: ask wider, or split at a value of the middle
            margin = min(0.5, margin * 4)
            if upto - smaller >= n:
                mid = inside.agg(F.percentile_approx("v", 0.5, accuracy)).first()[0]
                less, same = inside.agg(F.count_if(F.col("v") < F.lit(mid)), F.count_if(F.col("v") == F.lit(mid))).first()
                if rank < below + less:
                    inside = inside.where(F.col("v") < F.lit(mid))
                elif rank < below + less + same:
                    return mid
                else:
                    below, inside = below + less + same, inside.where(F.col("v") > F.lit(mid))


def quantiles(df: DataFrame, col: str, q, accuracy: int = ACCURACY, max_values: int = MAX_VALUES) -> list[float | None]:
    """Linearly interpolated quantiles, as ``percentile`` gives them; None for a column without values."""
    n = df.where(F.col(col).isNotNull()).count()
    if not n:
        return [None] * len(q)
    places = [p * (n - 1) for p in q]
    found = order_statistics(df, col, [k for x in places for k in (math.floor(x), math.ceil(x))], accuracy, max_values)
    out = []
    for x in places:
        lo, hi = float(found[math.floor(x)]), float(found[math.ceil(x)])
        out.append(lo + (x - math.floor(x)) * (hi - lo))
    return out
