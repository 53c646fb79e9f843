"""A training corpus from raw documents: quality, language, near copies, repeated passages, packing.

Every stage reads all that its predecessor kept, its decisions take effect, and all but the last return the columns of
``documents`` (doc_id, text, lang, source, n_chars)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revsift.llm import common as C
from revsift.llm import language_id as LI
from revsift.llm import quality_knn as QK
from revsift.llm.jaccard_join import jaccard_rows, with_set_signature
from revsift.llm.packing import pack
from revsift.llm.substring_dedup import substring_dedup
from revsift.session import cut_lineage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Least probability of the predicted language that keeps a document.
MIN_LANGUAGE_SCORE = 0.5


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; its labels are those of ``labels`` outside the held-out rows.
    Every row is judged by its text alone: equal texts go or stay together, null and empty ones by the share of
    accepted labels; an empty table stays empty, and without labels every document goes."""
    scored = QK.quality(docs, C.read(spark, sf_dir, "labels"), keep=COLUMNS)
    return scored.where("predicted = 1").select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the model knows with some certainty; null, empty and other texts without letters go.
    Equal texts go or stay together; without any known language every document goes."""
    found = LI.language_id(docs, keep=COLUMNS).withColumnRenamed("score", "certainty")
    return found.where((F.col("lang_pred") != LI.UNKNOWN) & (F.col("certainty") >= MIN_LANGUAGE_SCORE)).select(*COLUMNS)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies: the one of the smallest id, and of that id's rows the first text.

    Null ids, and texts without words (in no group), stay.  Ids may repeat: rows are told apart by their id and the
    signature of their shingles, so a text that only shares its id with a copy stays.  Few documents are shuffled: a
    bitmap of the ids that go, or that repeat, parts the table."""
    found = cut_lineage(jaccard_rows(docs, words=5, percent=75).where("doc_id is not null"))
    later = found.where("component_id <> doc_id").select("doc_id").distinct()
    again = found.groupBy("doc_id").count().where("count > 1").select("doc_id")
    bits = C.id_bitmap(later.union(again), "doc_id")
    some = C.maybe_in(docs, "doc_id", bits)
    once = some.join(again, "doc_id", "left_anti").join(later, "doc_id", "left_anti")
    # rows of repeated ids, each with the group of its own text
    more = with_set_signature(some.join(again, "doc_id", "left_semi"), keep=COLUMNS[2:])
    mine = found.select("doc_id", "s1", "s2", "group_id", "component_id").distinct()
    more = more.join(mine, ["doc_id", "s1", "s2"]).where("group_id is null or component_id = doc_id")
    first = Window.partitionBy("group_id").orderBy("text")   # keeps a row a group before it shuffles
    kept = more.where("group_id is null").unionByName(
        more.where("group_id is not null").withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n"))
    kept = kept.withColumn("text", F.col("text").cast("string")).select(*COLUMNS)
    return C.maybe_in(docs, "doc_id", bits, inside=False).select(*COLUMNS).union(once.select(*COLUMNS)).union(kept)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a smaller id has; a document that loses nothing keeps its text as it is, one
    that loses everything stays with an empty text.  Null ids lose nothing; a null text stays null."""
    found = substring_dedup(docs, window=13, keep=COLUMNS[1:])
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    return (found.withColumn("text", text).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 ids; a null or empty text is its end id alone."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality classifier", quality_classifier), ("language id", language_id),
          ("n-gram jaccard join", ngram_jaccard_join), ("substring dedup", drop_repeats), ("packing", packing)]

#: The stages train models and build components; SQL can't express them, tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared checkpoint folder and read again."""
    C.prepare(spark)
    docs = C.read(spark, sf_dir, "documents")
    base = C.shared_dir(spark)
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{base}/stage{i}")
        docs = spark.read.parquet(f"{base}/stage{i}")
    return docs
