"""TF-IDF over 1-2-grams with a document-frequency-filtered, size-capped vocabulary.

Definitions (the usual scikit-learn-style text vectoriser): lower-case;
tokens are runs of two or more word characters; stop words are removed
before bigrams are formed; keep terms with ``min_df <= df <= max_df * n``;
keep the ``max_features`` terms with the largest corpus count (ties by
term); index the vocabulary alphabetically; ``tf = 1 + ln(count)``;
``idf = ln((1 + n) / (1 + df)) + 1``; rows are l2-normalised.

Plan: tokens and n-grams are built in-row; ``explode`` + ``groupBy(doc,
term)`` (partial aggregation: a document's occurrences collapse before the
shuffle) gives term counts; ``groupBy(term)`` gives df and corpus count;
the vocabulary is a global top-k (at most ``max_features`` rows, so it is
broadcast); documents are reassembled by ``groupBy(doc)`` into sparse
``(indices, values)`` arrays of at most ``max_features`` entries each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import SPARK_ENGLISH_STOP_WORDS
from ..functions.text import computed_once

TOKEN_RX = r"\b\w\w+\b"


def tokenize_stop(text: F.Column, stop_words=SPARK_ENGLISH_STOP_WORDS) -> F.Column:
    """Column form of the tokenizer + stop-word filter (for ad-hoc use on
    short columns); :func:`doc_terms` uses the JVM transformers instead."""
    toks = F.regexp_extract_all(F.lower(text), F.lit(TOKEN_RX), 0)
    if stop_words:
        stop = F.array(*[F.lit(w) for w in stop_words])
        toks = F.filter(toks, lambda x: ~F.array_contains(stop, x))
    return toks


def ngrams_1_2(toks: F.Column) -> F.Column:
    """Unigrams followed by adjacent bigrams.  Bigrams pair the array with
    itself shifted by one (``arrays_zip``), so no lambda reads an outer column."""
    shifted = F.slice(toks, 2, F.greatest(F.size(toks), F.lit(1)))
    pairs = F.filter(F.arrays_zip(toks.alias("a"), shifted.alias("b")), lambda z: z["b"].isNotNull())
    return F.concat(toks, F.transform(pairs, lambda z: F.concat(z["a"], F.lit(" "), z["b"])))


def with_terms(df: DataFrame, text_col: str = "text_clean", out: str = "terms",
               stop_words=SPARK_ENGLISH_STOP_WORDS) -> DataFrame:
    """Adds the 1-2-gram sequence of each document, built with Spark ML's JVM
    transformers (regex tokenizer, hash-set stop-word remover, bigram
    generator) - no per-token interpreted lambdas, no shuffle."""
    from pyspark.ml.feature import NGram, RegexTokenizer, StopWordsRemover
    d = df.withColumn("_txt", F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    d = RegexTokenizer(inputCol="_txt", outputCol="_tok", pattern=TOKEN_RX, gaps=False, toLowercase=False,
                       minTokenLength=1).transform(d)
    if stop_words:
        d = StopWordsRemover(inputCol="_tok", outputCol="_uni", stopWords=list(stop_words),
                             caseSensitive=True).transform(d)
    else:
        d = d.withColumn("_uni", F.col("_tok"))
    d = NGram(n=2, inputCol="_uni", outputCol="_bi").transform(d)
    return d.withColumn(out, F.concat("_uni", "_bi")).drop("_txt", "_tok", "_uni", "_bi")


def doc_terms(df: DataFrame, key: str, text_col: str = "text_clean", stop_words=SPARK_ENGLISH_STOP_WORDS) -> DataFrame:
    """``(key, terms)``: the 1-2-gram sequence of each document."""
    return with_terms(df.select(key, text_col), text_col, "terms", stop_words).select(key, "terms")


def term_doc_freq(terms: DataFrame) -> DataFrame:
    """``(term, df, corpus_count)`` of documents given as ``terms`` arrays.
    Each document's distinct terms count for df, all its terms for
    corpus_count; both are partial sums by term, so no (document, term) pair
    is ever shuffled."""
    marks = F.concat(F.transform(F.array_distinct("terms"), lambda t: F.struct(t.alias("term"), F.lit(1).alias("d"), F.lit(0).alias("c"))),
                     F.transform("terms", lambda t: F.struct(t.alias("term"), F.lit(0).alias("d"), F.lit(1).alias("c"))))
    return (terms.select(F.explode(marks).alias("m")).groupBy(F.col("m.term").alias("term"))
            .agg(F.sum("m.d").alias("df"), F.sum("m.c").alias("corpus_count")))


def vocabulary_select(freq: DataFrame, n_docs, max_features: int = 2000, min_df: int = 5,
                      max_df: float = 0.8) -> DataFrame:
    """Filter by document frequency, keep the top ``max_features`` by corpus
    count (ties by term), index alphabetically.  The window runs over at
    most ``max_features`` rows."""
    kept = freq.where((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df) * n_docs))
    top = kept.orderBy(F.desc("corpus_count"), F.asc("term")).limit(max_features)
    idx = F.row_number().over(Window.orderBy("term")) - 1
    return top.select(F.col("term").alias("feature_name"), idx.cast("int").alias("feature_index"), "df",
                      (F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0).alias("idf"))


def sparse_to_long(sparse: DataFrame, key: str) -> DataFrame:
    """``(key, feature_index, weight)`` - a projection, no shuffle."""
    return sparse.select(key, F.posexplode(F.arrays_zip("indices", "values")).alias("_p", "_z")).select(
        key, F.col("_z.indices").alias("feature_index"), F.col("_z.values").alias("weight"))


def tfidf_fit(df: DataFrame, key: str, text_col: str = "text_clean", max_features: int = 2000, min_df: int = 5,
              max_df: float = 0.8, stop_words=SPARK_ENGLISH_STOP_WORDS) -> DataFrame:
    """The vocabulary (at most ``max_features`` rows), materialised: it is the
    only thing a transform needs."""
    from ..session import cut_lineage
    freq = term_doc_freq(doc_terms(df, key, text_col, stop_words))
    n_docs = df.agg(F.count(F.lit(1))).scalar()
    return cut_lineage(vocabulary_select(freq, n_docs, max_features, min_df, max_df))


def tfidf_columns(df: DataFrame, vocab: DataFrame, text_col: str = "text_clean",
                  stop_words=SPARK_ENGLISH_STOP_WORDS) -> DataFrame:
    """Adds ``indices`` and ``values``, the l2-normalised sparse row of each
    document (empty arrays if it has no term of the vocabulary).

    A document is one row, so this is a projection: terms are counted inside
    the row against the vocabulary, and weights and norm are expressions over
    the row's counts.  No shuffle, no join, every other column is carried."""
    from pyspark.ml.feature import CountVectorizerModel
    rows = vocab.select("feature_index", "feature_name", "idf").orderBy("feature_index").collect()  # <= max_features
    if not rows:
        return df.withColumn("indices", F.array().cast("array<int>")).withColumn("values", F.array().cast("array<double>"))
    d = with_terms(df, text_col, "_terms", stop_words)
    model = CountVectorizerModel.from_vocabulary([r["feature_name"] for r in rows], inputCol="_terms", outputCol="_counts")
    d = model.transform(d).withColumn("_v", F.unwrap_udt("_counts"))
    idf = F.lit([float(r["idf"]) for r in rows])
    w = F.transform(F.arrays_zip(F.col("_v.indices").alias("i"), F.col("_v.values").alias("n")),
                    lambda z: (F.lit(1.0) + F.log(z["n"])) * F.get(idf, z["i"]))
    d = d.withColumn("_w", w)
    norm = F.sqrt(F.aggregate("_w", F.lit(0.0), lambda acc, x: acc + x * x))
    d = d.withColumn("_n", norm)
    # made once a row: a filter on the arrays, also the one Spark infers for their explode, would tokenise the text again
    return (computed_once(d, indices=F.col("_v.indices"),
                          values=F.transform("_w", lambda x: F.when(F.col("_n") > 0, x / F.col("_n")).otherwise(0.0)))
            .drop("_terms", "_counts", "_v", "_w", "_n"))


def tfidf_transform(df: DataFrame, vocab: DataFrame, key: str, text_col: str = "text_clean",
                    stop_words=SPARK_ENGLISH_STOP_WORDS) -> DataFrame:
    """``(key, indices, values)`` of the documents with a term of a fitted (saved) vocabulary."""
    return (tfidf_columns(df.select(key, text_col), vocab, text_col, stop_words)
            .select(key, "indices", "values").where(F.size("indices") > 0))


def tfidf_fit_transform(df: DataFrame, key: str, text_col: str = "text_clean", stop_words=SPARK_ENGLISH_STOP_WORDS,
                        **kw) -> tuple[DataFrame, DataFrame]:
    """``(vocabulary, sparse rows)``: one pass for the vocabulary, one for the rows."""
    vocab = tfidf_fit(df, key, text_col, stop_words=stop_words, **kw)
    return vocab, tfidf_transform(df, vocab, key, text_col, stop_words)


def tfidf_fit_transform_long(df: DataFrame, key: str, text_col: str = "text_clean", **kw) -> tuple[DataFrame, DataFrame]:
    vocab, sparse = tfidf_fit_transform(df, key, text_col, **kw)
    return vocab, sparse_to_long(sparse, key)


def tfidf_transform_long(df: DataFrame, vocab: DataFrame, key: str, text_col: str = "text_clean",
                         stop_words=SPARK_ENGLISH_STOP_WORDS) -> DataFrame:
    return sparse_to_long(tfidf_transform(df, vocab, key, text_col, stop_words), key)
