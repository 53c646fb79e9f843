"""Registered queries of the training-data operators: each applies one operator, with production parameters, to its
whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from revsift.llm import common as C
from revsift.llm.byte_bpe import bpe_encode
from revsift.llm.fingerprint import fingerprints
from revsift.llm.html_extract import extract_main_text
from revsift.llm.jaccard_join import jaccard_components
from revsift.llm.language_id import language_id
from revsift.llm.lm_scoring import lm_scores
from revsift.llm.merkle import merkle_manifest
from revsift.llm.oracle import ORACLE  # noqa: F401  SQL where it can express an operator
from revsift.llm.packing import pack
from revsift.llm.quality_knn import quality
from revsift.llm.quality_rules import quality_rules
from revsift.llm.substring_dedup import substring_dedup
from revsift.llm.toxicity import toxicity
from revsift.llm.whitening import whiten


def op1_language_id(spark, sf_dir):
    return language_id(C.read(spark, sf_dir, "documents"))


def op2_html_extraction(spark, sf_dir):
    return extract_main_text(C.read(spark, sf_dir, "pages"))


def op3_jaccard_join(spark, sf_dir):
    return jaccard_components(C.read(spark, sf_dir, "documents"), "doc_id", "text", words=5, percent=75)


def op4_lm_scoring(spark, sf_dir):
    # 49407 is the tokenizer's own end mark, which it never gives without special tokens
    return lm_scores(C.read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=49407)


def op5_fingerprints(spark, sf_dir):
    return fingerprints(C.read(spark, sf_dir, "documents"))


def op6_quality_classifier(spark, sf_dir):
    return quality(C.read(spark, sf_dir, "documents"), C.read(spark, sf_dir, "labels"))


def op7_substring_dedup(spark, sf_dir):
    out = substring_dedup(C.read(spark, sf_dir, "documents"), window=13, digest=True)
    return out.withColumnRenamed("kept", "kept_sha256")


def op8_byte_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = bpe_encode(C.read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, decode=True)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_packing(spark, sf_dir):
    return pack(C.read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_quality_rules(spark, sf_dir):
    return (quality_rules(C.read(spark, sf_dir, "documents"))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"))


def op11_toxicity(spark, sf_dir):
    return toxicity(C.read(spark, sf_dir, "documents"), C.read(spark, sf_dir, "labels"))


def op12_merkle_manifest(spark, sf_dir):
    return merkle_manifest(C.read(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark, sf_dir):
    return whiten(C.read(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_html_extraction, op3_jaccard_join, op4_lm_scoring, op5_fingerprints, op6_quality_classifier,
    op7_substring_dedup, op8_byte_bpe, op9_packing, op10_quality_rules, op11_toxicity, op12_merkle_manifest,
    op13_embedding_whitening)}
