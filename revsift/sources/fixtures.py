"""Review-shaped inputs derived from the driver's tables.

The moderation pipeline expects business reviews, business metadata and a
human-labelled gold set.  These are derived deterministically from the
``documents`` and ``labels`` tables (every document becomes a review and
keeps its whole text), so the work grows with the tables and the DuckDB
oracle (``revsift.plans.oracle``) can rebuild the same rows with plain SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table_path

# FIXED VALUES of the fixture rules (mirrored in revsift/plans/oracle.py).
BASE_TIME_MS = 1546300800000
HOUR_MS = 3600000
N_USERS = 37
DOCS_PER_BUSINESS = 20
N_CATEGORY_SLOTS = 23          # slot 22 has no metadata row (unmatched join)
EXACT_COPY_OFFSET = 1_000_000_000
EDIT_COPY_OFFSET = 2_000_000_000
EDITED_TEXT = "edited later"
# short reviews: extra rows (own key range, half an hour later) with the phrase alone, null where there is none
SHORT_OFFSET, SHORT_EVERY, SHORT_SLOT, SHORT_DELAY_MS = 3_000_000_000, 7, 2, 1800000

# phrase per doc_id % 20, put in front of the whole document text; None = the document text alone
PHRASES = [
    None,
    "Call 307-555-1234 for a limited time discount!",
    "Find us on facebook and follow us",
    "Great food",
    "nice food",
    "Way better than the other spot and Smith makes a nicer burger here folks",
    "Turn right after the election office",
    "They are hiring cooks, apply today",
    "ok",
    "I haven't been inside, never visited",
    "I heard it is a scam and terrible",
    "I called twice, no answer, never been inside",
    "We drove by and it looked closed",
    "No reservation so we were turned away",
    "My brother came by and we were happy",
    "We went for lunch and I ordered the soup",
    "The sauce was delicious and crispy with spicy fresh salad and a cold beer on the menu",
    None,
    None,
    "  Visit   https://shop.example.com \n now - 50% off!! ",
]

CATEGORIES = [
    ["Sewing shop", "Store"], "Bakery", ["Barber shop"], ["Beginner school"], ["Auto repair service"],
    ["Hot spring"], ["Grocery store"], ["Gift shop"], ["Apparel outlet"], ["Book shop"], ["Car wash"],
    ["Gas station"], ["Airport"], ["Hospital"], ["Hair salon"], ["Real estate agency"],
    ["Law office attorney"], ["Credit union"], ["Elementary school"], ["Church"], ["City hall"], ["Plumber"],
]
SECOND_ROW_SLOT = 2
SECOND_ROW_CATEGORY = ["Plumber"]


def _category_json(cat) -> str:
    """Raw text Spark's JSON reader returns for a ``category`` read as STRING."""
    if isinstance(cat, str):
        return cat
    return "[" + ",".join('"' + c + '"' for c in cat) + "]"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def fx_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw reviews (with ``ingest_seq``), including exact and edited copies."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    k = F.col("doc_id") % 20
    phrase = F.lit(None).cast("string")
    for i in range(len(PHRASES) - 1, -1, -1):
        if PHRASES[i] is not None:
            phrase = F.when(k == i, F.lit(PHRASES[i])).otherwise(phrase)
    c = F.floor(F.col("doc_id") / 3)
    n_pics = F.when(F.col("doc_id") % 3 == 0, F.col("doc_id") % 4)
    time_ms = F.lit(BASE_TIME_MS) + F.col("doc_id") * F.lit(HOUR_MS)
    base = d.select(
        F.col("doc_id").alias("ingest_seq"),
        F.concat(F.lit("u"), (F.col("doc_id") % N_USERS).cast("string")).alias("user_id"),
        F.concat(F.lit("g"), F.floor(F.col("doc_id") / DOCS_PER_BUSINESS).cast("string")).alias("gmap_id"),
        time_ms.cast("bigint").alias("time"),
        F.when(F.col("doc_id") % 17 == 0, F.lit(None).cast("double"))
         .when(F.col("doc_id") % 41 == 0, F.lit(7.0))
         .otherwise((F.lit(1) + c % 5).cast("double")).alias("rating"),
        F.when(phrase.isNull(), F.col("text")).otherwise(F.concat(phrase, F.lit(" "), F.col("text"))).alias("text"),
        phrase.alias("phrase"),
        F.when(F.col("doc_id") % 11 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("o'neil user-"), (F.col("doc_id") % N_USERS).cast("string"))).alias("name"),
        F.when(n_pics.isNotNull(),
               F.array_repeat(F.struct(F.array(F.lit("https://img.example/p.jpg")).alias("url")),
                              n_pics.cast("int"))).alias("pics"),
        F.when(F.col("doc_id") % 6 == 0,
               F.struct((time_ms + F.lit(86400000)).cast("bigint").alias("time"),
                        F.lit("Thank you").alias("text"))).alias("resp"),
    )
    exact = base.where(F.col("ingest_seq") % 10 == 4).withColumn(
        "ingest_seq", F.col("ingest_seq") + F.lit(EXACT_COPY_OFFSET))
    edited = (base.where(F.col("ingest_seq") % 10 == 3)
              .withColumn("ingest_seq", F.col("ingest_seq") + F.lit(EDIT_COPY_OFFSET))
              .withColumn("text", F.lit(EDITED_TEXT)))
    short = (base.where(F.col("ingest_seq") % SHORT_EVERY == SHORT_SLOT)
             .withColumn("ingest_seq", F.col("ingest_seq") + F.lit(SHORT_OFFSET))
             .withColumn("time", F.col("time") + F.lit(SHORT_DELAY_MS))
             .withColumn("text", F.col("phrase")))
    return base.unionByName(exact).unionByName(edited).unionByName(short).drop("phrase")


def fx_meta_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Business metadata as the JSON reader yields it: ``category`` is raw JSON
    text (array) or a bare string.  One business per 20 documents."""
    b = (read_table(spark, sf_dir, "documents")
         .select(F.floor(F.col("doc_id") / DOCS_PER_BUSINESS).alias("b")).distinct())
    slot = (F.col("b") % N_CATEGORY_SLOTS).cast("int")
    cat_text = F.element_at(F.array(*[F.lit(_category_json(c)) for c in CATEGORIES]), slot + 1)
    gmap = F.concat(F.lit("g"), F.col("b").cast("string"))
    first = (b.where(slot < len(CATEGORIES))
             .select((F.col("b") * 2).cast("bigint").alias("ingest_seq"), gmap.alias("gmap_id"),
                     cat_text.alias("category")))
    second = (b.where(slot == SECOND_ROW_SLOT)
              .select((F.col("b") * 2 + 1).cast("bigint").alias("ingest_seq"), gmap.alias("gmap_id"),
                      F.lit(_category_json(SECOND_ROW_CATEGORY)).alias("category")))
    return first.unionByName(second)


def gold_label_expr() -> F.Column:
    return (F.when(F.col("toxic") == 1, F.lit(3))
            .when((F.col("quality") == 1) & (F.col("doc_id") % 5 != 0), F.lit(0))
            .when(F.col("quality") == 1, F.lit(1))
            .otherwise(F.lit(2))).cast("int")


def fx_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Human-labelled gold set: labels joined to their documents' cleaned text."""
    from ..functions.text import clean_text
    labels = read_table(spark, sf_dir, "labels")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return (labels.join(docs, "doc_id", "inner")
            .select("doc_id", clean_text(F.col("text")).alias("text_clean"),
                    gold_label_expr().alias("gold_label")))


def fx_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold set plus a deterministic prediction table, so every evaluation
    operator can be checked without a trained model."""
    g = fx_gold(spark, sf_dir)
    return g.select(
        "doc_id", "text_clean", "gold_label",
        ((F.col("gold_label") + F.when(F.col("doc_id") % 4 == 0, 1).otherwise(0)) % 4)
        .cast("int").alias("predicted_label"),
        (F.lit(0.25) + (F.col("doc_id") % 76) / F.lit(100.0)).alias("prediction_confidence"),
    )
