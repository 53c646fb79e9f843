"""Cleaning operators: joins, dedupes, derived columns and outlier filters.

Every operator is ``DataFrame -> DataFrame`` and takes column names, so it
works on any table with the needed columns.  Scalars (median, quantile
bounds) are scalar subqueries that stay inside the plan; nothing is pulled
to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..constants import LENGTH_QUANTILES, NONE_TOKEN, RATING_RANGE
from ..functions.text import char_length, clean_text, computed_once, fill_none, split_word_count, strip_ws, title_case
from .quantiles import quantiles

# ------------------------------------------------------------------ dedupe

#: String keys that are ids: compared as they are.
SHORT_KEYS = ("user_id", "gmap_id")


def keep_first(df: DataFrame, keys: Sequence[str], order_col: str = "ingest_seq") -> DataFrame:
    """One row per key, the one with the lowest ``order_col`` ("keep first").

    ``row_number() = 1``: Spark keeps the first row of each key in every map
    task already (window group limit), so a key that owns a third of all rows
    ships one row per task, and rows are hashed and sorted by narrow keys only:
    a string key is compared by its SHA-256, unless it is a known short id.
    Null keys compare equal, like pandas ``drop_duplicates``.
    """
    wide = {f.name for f in df.schema if isinstance(f.dataType, StringType)} - set(SHORT_KEYS)
    narrow = [F.sha2(F.col(k), 256) if k in wide else F.col(k) for k in keys]
    w = Window.partitionBy(*narrow).orderBy(order_col)
    return df.withColumn("_first", F.row_number().over(w)).where("_first = 1").drop("_first")


RAW_DEDUPE_KEYS = ("gmap_id", "user_id", "time", "text")
EVENT_DEDUPE_KEYS = ("user_id", "gmap_id", "time")
CLEAN_DEDUPE_KEYS = ("gmap_id", "user_id", "time", "text_clean")


def dedupe_raw(df: DataFrame, order_col: str = "ingest_seq") -> DataFrame:
    return keep_first(df, RAW_DEDUPE_KEYS, order_col)


def dedupe_event(df: DataFrame, order_col: str = "ingest_seq") -> DataFrame:
    return keep_first(df, EVENT_DEDUPE_KEYS, order_col)


def dedupe_clean(df: DataFrame, order_col: str = "ingest_seq") -> DataFrame:
    """Keys contain the ``dedupe_event`` keys, so after that step this is a
    no-op; ``clean_pipeline`` therefore skips it (saves a shuffle)."""
    return keep_first(df, CLEAN_DEDUPE_KEYS, order_col)


def removed_count(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows removed by a step, as a one-row table (report "Removed N")."""
    n_before = before.agg(F.count(F.lit(1))).scalar()
    return (after.agg(F.count(F.lit(1)).alias("n_after"))
            .select(n_before.alias("n_before"), "n_after", (n_before - F.col("n_after")).alias("n_removed")))

# ------------------------------------------------------------------ metadata


def normalize_meta(meta_raw: DataFrame, category_col: str = "category") -> DataFrame:
    """``category`` arrives as raw JSON text (array) or a bare string or null;
    produce ``category_all`` (``;``-joined, "" if none) and
    ``category_primary`` (first element, "" if none)."""
    c = F.col(category_col)
    cats = (F.when(c.isNull(), F.array().cast("array<string>"))
            .when(F.ltrim(c).startswith("["), F.coalesce(F.from_json(c, "array<string>"), F.array(c)))   # "[new] Cafe" is a name
            .otherwise(F.array(c)))
    keep = [x for x in meta_raw.columns if x != category_col]
    return (meta_raw.select(*keep, cats.alias("_cats"))
            .select(*keep,
                    F.coalesce(F.array_join("_cats", ";"), F.lit("")).alias("category_all"),
                    F.coalesce(F.get(F.col("_cats"), 0), F.lit("")).alias("category_primary")))


def meta_first_per_key(meta: DataFrame, key: str = "gmap_id", order_col: str = "ingest_seq") -> DataFrame:
    return keep_first(meta, [key], order_col)


def join_meta(reviews: DataFrame, meta: DataFrame, key: str = "gmap_id") -> DataFrame:
    """Left join reviews to one-row-per-business metadata, null keys matching
    (pandas merge semantics).  No broadcast hint: the planner and AQE
    broadcast the metadata only when its measured size is under
    ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and fall back to a
    shuffle join otherwise; skewed businesses are split by AQE skew join."""
    m = meta.select(F.col(key).alias("_mkey"), "category_all", "category_primary")
    return (reviews.join(m, reviews[key].eqNullSafe(m["_mkey"]), "left").drop("_mkey"))

# ------------------------------------------------------------------ derived columns


def derive_time(df: DataFrame, time_col: str = "time") -> DataFrame:
    """Epoch milliseconds -> timestamp, date, year, month (session TZ = UTC)."""
    ts = F.timestamp_millis(F.col(time_col))
    return (df.withColumn("timestamp", ts)
            .withColumn("date", F.to_date("timestamp"))
            .withColumn("year", F.year("timestamp"))
            .withColumn("month", F.month("timestamp")))


def impute_median(df: DataFrame, col: str = "rating", bounded: bool = False) -> DataFrame:
    """Null -> global median (exact, linearly interpolated).  The median is a
    scalar subquery; ``percentile`` keeps a value->count map, which stays
    small because ratings have few distinct values.  ``bounded``: the same
    number by :mod:`.quantiles`, whose state is bounded for any column."""
    med = F.lit(quantiles(df, col, [0.5])[0]) if bounded else df.agg(F.median(F.col(col))).scalar()
    return df.withColumn(col, F.coalesce(F.col(col), med))


def fill_text_none(df: DataFrame, cols: Sequence[str] = ("text", "name")) -> DataFrame:
    """Null text columns -> ``'NONE'``.  ``resp`` is a record, handled by
    :func:`response_features`."""
    for c in cols:
        if c in df.columns:
            df = df.withColumn(c, fill_none(c))
    return df


def photo_features(df: DataFrame, pics_col: str = "pics") -> DataFrame:
    p = F.col(pics_col)
    return (df.withColumn("has_photos", p.isNotNull())
            .withColumn("photo_count", F.when(p.isNull(), F.lit(0)).otherwise(F.size(p)).cast("bigint")))


def text_features(df: DataFrame, text_col: str = "text") -> DataFrame:
    return (df.withColumn("text_clean", clean_text(F.col(text_col)))
            .withColumn("text_length", char_length("text_clean"))
            .withColumn("word_count", split_word_count("text_clean")))


def clean_name(df: DataFrame, name_col: str = "name") -> DataFrame:
    return df.withColumn("name_clean", title_case(strip_ws(F.col(name_col))))


def response_features(df: DataFrame, resp_col: str = "resp", response_flag: str = "filled") -> DataFrame:
    """``response_flag='filled'`` (default) reproduces the original behaviour:
    the response is filled with ``'NONE'`` before the flag is taken, so every
    row "has a response", and the length of a missing response is 4 while a
    present record counts its fields.  ``'source'`` uses the unfilled column."""
    r = F.col(resp_col)
    if response_flag == "source":
        flag = r.isNotNull()
    else:
        flag = F.lit(True)
    if isinstance(df.schema[resp_col].dataType, StructType):
        present_len = F.lit(len(df.schema[resp_col].dataType.fields))
    else:
        present_len = F.length(r.cast("string"))
    length = F.when(r.isNull(), F.lit(len(NONE_TOKEN))).otherwise(present_len).cast("bigint")
    return df.withColumn("has_response", flag).withColumn("response_length", length)


def add_key_count(df: DataFrame, key: str, name: str) -> DataFrame:
    """Rows per key joined back (``value_counts`` + ``map``); null key -> null.

    Partial aggregation makes the count cheap even for a hot key; the join
    back is a left join that AQE turns into a broadcast when the count table
    is small, or a sort-merge join with skewed partitions split otherwise.
    A window count would buffer a whole (possibly huge) group in one task.
    """
    counts = (df.where(F.col(key).isNotNull()).groupBy(key)
              .agg(F.count(F.lit(1)).cast("bigint").alias(name)))
    return df.join(counts, on=key, how="left")


def user_review_count(df: DataFrame, user_col: str = "user_id") -> DataFrame:
    return add_key_count(df, user_col, "user_review_count")


def business_review_count(df: DataFrame, business_col: str = "gmap_id") -> DataFrame:
    return add_key_count(df, business_col, "business_review_count")

# ------------------------------------------------------------------ filters


def quantile_bounds(df: DataFrame, col: str = "text_length", q=LENGTH_QUANTILES, bounded: bool = False) -> tuple[Column, Column]:
    """Linear-interpolated quantiles as two scalar-subquery Columns, rounded
    to 6 dp (interpolation between integer lengths at these ranks has at most
    two decimals, so rounding removes float noise without moving a bound).
    ``bounded``: the same numbers as literals, by :mod:`.quantiles`."""
    if bounded:
        return tuple(F.round(F.lit(x), 6) for x in quantiles(df, col, q))
    qs = df.agg(F.percentile(F.col(col), F.array(*[F.lit(x) for x in q])).alias("qs")).scalar()
    return F.round(F.get(qs, 0), 6), F.round(F.get(qs, 1), 6)


def filter_length_quantiles(df: DataFrame, col: str = "text_length", q=LENGTH_QUANTILES, bounded: bool = False) -> DataFrame:
    lo, hi = quantile_bounds(df, col, q, bounded)
    return df.where((F.col(col) >= lo) & (F.col(col) <= hi))


def filter_rating_range(df: DataFrame, col: str = "rating", lo: float = RATING_RANGE[0],
                        hi: float = RATING_RANGE[1]) -> DataFrame:
    return df.where(F.col(col).between(lo, hi))


DEFAULT_NULL_TOKENS = ("NA", "NULL", "NaN", "None", "nan", "null")


def nonempty_text(df: DataFrame, col: str = "text_clean", null_tokens: Sequence[str] = DEFAULT_NULL_TOKENS) -> DataFrame:
    """Tokens that a CSV hand-off would have read back as missing become "";
    rows whose text is blank after stripping are dropped."""
    c = F.col(col)
    if null_tokens:
        c = F.when(c.isin(*null_tokens), F.lit(None).cast("string")).otherwise(c)
    c = F.coalesce(c, F.lit(""))
    return computed_once(df, **{col: c}).where(F.trim(F.col(col)) != "")


def require_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df

# ------------------------------------------------------------------ composition


def clean_review_data(df: DataFrame, order_col: str = "ingest_seq", response_flag: str = "filled",
                      materialize=None) -> DataFrame:
    """The cleaning sequence, in its original order: time -> rating median ->
    'NONE' fill -> photos -> text -> name -> response -> dedupe -> counts ->
    length quantiles -> rating range.  Optional columns are skipped when absent.

    ``materialize`` (e.g. :func:`revsift.session.cut_lineage`) is applied
    where the plan fans out - the deduplicated table feeds two count
    aggregations, the quantile subquery and the main branch - so the
    upstream cleaning runs once instead of once per branch."""
    cols = set(df.columns)
    materialize = materialize or (lambda x: x)
    if "rating" in cols:
        df = impute_median(df, "rating")
    df = materialize(dedupe_event(derived_columns(df, response_flag), order_col))
    if "user_id" in cols:
        df = user_review_count(df)
    if "gmap_id" in cols:
        df = business_review_count(df)
    if "text" in cols:
        df = filter_length_quantiles(df)
    if "rating" in cols:
        df = filter_rating_range(df)
    return df


def derived_columns(df: DataFrame, response_flag: str = "filled") -> DataFrame:
    """The columns that a row's own values give: time -> 'NONE' fill -> photos -> text -> name -> response."""
    cols = set(df.columns)
    if "time" in cols:
        df = derive_time(df)
    df = fill_text_none(df, [c for c in ("text", "name") if c in cols])
    if "pics" in cols:
        df = photo_features(df)
    if "text" in cols:
        df = text_features(df)
    if "name" in cols:
        df = clean_name(df)
    if "resp" in cols:
        df = response_features(df, response_flag=response_flag)
    return df
