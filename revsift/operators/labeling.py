"""Vote matrix and labeling-function analysis.

The vote "matrix" is never collected: each row carries its 23 votes as
integer columns plus a ``votes`` array, and every statistic is one
aggregation pass over those columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import ABSTAIN, CARDINALITY
from ..functions.lfs import CONTEXT_COLUMNS, add_lf_context, resolve


def apply_lfs(df: DataFrame, lfs=None, text_col: str = "text_clean", category_col: str | None = None,
              votes_col: str = "votes") -> DataFrame:
    """Add one vote column per LF (named after it) and ``votes`` (their array,
    in LF order).  Two chained projections: shared context, then votes."""
    fns = resolve(lfs)
    ctx = add_lf_context(df, text_col=text_col, category_col=category_col)
    keep = [c for c in df.columns]
    out = ctx.select(*keep, *[fn.build().alias(fn.name) for fn in fns])
    return out.withColumn(votes_col, F.array(*[F.col(fn.name) for fn in fns]))


def lf_names(lfs=None) -> list[str]:
    return [fn.name for fn in resolve(lfs)]


def _row_counters(df: DataFrame, votes_col: str) -> DataFrame:
    nonab = F.filter(F.col(votes_col), lambda v: v != ABSTAIN)
    return df.select("*", F.size(nonab).alias("_n_votes"), F.size(F.array_distinct(nonab)).alias("_n_labels"))


def lf_summary(votes: DataFrame, lfs=None, votes_col: str = "votes") -> DataFrame:
    """Per LF: polarity (labels it emits), coverage (share of rows it votes
    on), overlaps (share where it and at least one other LF vote), conflicts
    (share where it votes and the row carries two different labels).
    One aggregation with 4 expressions per LF, then unpivot."""
    names = lf_names(lfs)
    d = _row_counters(votes, votes_col)
    aggs = []
    for j, _ in enumerate(names):
        v = F.col(votes_col)[j]
        voted = v != ABSTAIN
        aggs += [
            F.array_join(F.array_sort(F.collect_set(F.when(voted, v))).cast("array<string>"), ",").alias(f"p{j}"),
            F.avg(voted.cast("double")).alias(f"c{j}"),
            F.avg((voted & (F.col("_n_votes") > 1)).cast("double")).alias(f"o{j}"),
            F.avg((voted & (F.col("_n_labels") > 1)).cast("double")).alias(f"x{j}"),
        ]
    wide = d.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(j).alias("j"), F.lit(n).alias("lf_name"), F.col(f"p{j}").alias("polarity"),
                              F.col(f"c{j}").alias("coverage"), F.col(f"o{j}").alias("overlaps"),
                              F.col(f"x{j}").alias("conflicts")) for j, n in enumerate(names)])
    return wide.select(F.inline(rows))


def lf_total_coverage(votes: DataFrame, votes_col: str = "votes") -> DataFrame:
    """Percent of rows with at least one non-abstain vote."""
    return votes.agg((F.avg(F.exists(F.col(votes_col), lambda v: v != ABSTAIN).cast("double")) * 100)
                     .alias("total_coverage_pct"))


def lf_coverage(votes: DataFrame, lfs=None, votes_col: str = "votes") -> DataFrame:
    """Percent of rows each LF votes on, ``(j, lf_name, coverage_pct)``."""
    names = lf_names(lfs)
    wide = votes.agg(*[(F.avg((F.col(votes_col)[j] != ABSTAIN).cast("double")) * 100).alias(f"c{j}")
                       for j in range(len(names))])
    rows = F.array(*[F.struct(F.lit(j).alias("j"), F.lit(n).alias("lf_name"), F.col(f"c{j}").alias("coverage_pct"))
                     for j, n in enumerate(names)])
    return wide.select(F.inline(rows))


def vote_patterns(votes: DataFrame, votes_col: str = "votes") -> DataFrame:
    """Distinct vote vectors with their row counts (partial aggregation)."""
    return votes.groupBy(F.col(votes_col).alias("pattern")).agg(F.count(F.lit(1)).alias("n_rows"))


def vote_overlap_matrix(votes: DataFrame, cardinality: int = CARDINALITY, votes_col: str = "votes") -> DataFrame:
    """Second-moment matrix of the one-hot votes, ``O[a, b] = mean(psi_a *
    psi_b)`` with ``a = j * cardinality + label``: the label model's
    sufficient statistic, returned as a long table of non-zero entries.

    Rows are first compressed to distinct vote patterns; each pattern emits
    the index pairs of its own non-abstain entries (at most ``m^2`` pairs per
    pattern, a constant), weighted by the pattern's row count."""
    n = votes.agg(F.count(F.lit(1))).scalar()
    pats = vote_patterns(votes, votes_col)
    idx = F.filter(F.transform(F.col("pattern"), lambda v, j: F.when(v != ABSTAIN, j * cardinality + v)),
                   lambda x: x.isNotNull())
    pairs = pats.select("n_rows", idx.alias("idx")).select(
        "n_rows", F.explode(F.col("idx")).alias("a"), "idx").select("n_rows", "a", F.explode("idx").alias("b"))
    return (pairs.groupBy("a", "b").agg(F.sum("n_rows").alias("_cnt"))
            .select(F.col("a").cast("int").alias("a"), F.col("b").cast("int").alias("b"),
                    (F.col("_cnt") / n).alias("value")))


def drop_context(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in CONTEXT_COLUMNS if c in df.columns])
