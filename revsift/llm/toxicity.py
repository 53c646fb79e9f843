"""Toxicity by class-conditional Kneser-Ney models over words.

Two models, of toxic and of ordinary text, give each word a probability by interpolated absolute discounting:

    P_c(word) = (max(n_c(word) - D, 0) + W_c * P_c(stem) / forms(stem)) / N_c
    P_c(stem) = (max(n_c(stem) - D, 0) + S_c * P(stem)) / N_c

n_c are the class's counts, a stem is a word's first letters, and P(stem) is the Kneser-Ney continuation share: the
distinct words of both classes that a stem has, out of all.  So a rare word leans on its stem, and a rare stem on what
the classes share, where their ratio says nothing.  W_c and S_c are the discounted masses; the counts of the larger class
are scaled to the smaller class's total first, or the smaller class would look surprised by every rare word.

A text is judged by the difference of its two log-likelihoods per word: over the whole text, and over its most toxic
passage of 1, 2, 4 and 8 words, as a few words make a text toxic.  A logistic regression turns these into a score;
it is fitted on labelled texts that the word counts it uses left out."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revsift.llm import common as C
from revsift.session import cut_lineage

STEM, DISCOUNT = 4, 1.0
#: Labelled documents of each class that a fit takes, about: those whose hashed id is below their share.
MAX_PER_CLASS = 40_000
#: Every fifth of them, by hash, fits the regression.
CALIBRATION_FOLDS = 5
WINDOWS = (1, 2, 4, 8)
RIDGE = 0.1
#: Distinct words a counting task holds before it hands them on; words a scoring task remembers beside the model's.
COUNTED_WORDS, KNOWN_WORDS, KNOWN_LENGTH = 200_000, 100_000, 40

_WORD = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def _count(batches):
    """Per task: word -> counts in ordinary and toxic texts of the fit's part, then of the rest."""
    found: dict = {}

    def hand_on():
        n = np.array(list(found.values()), np.int64).reshape(-1, 4)
        out = pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), *(pa.array(n[:, i]) for i in range(4))],
                                         names=["word", "o0", "t0", "o1", "t1"])
        found.clear()
        return out
    for b in batches:
        for text, toxic, rest in zip(b.column("text").to_pylist(), b.column("y").to_pylist(), b.column("rest").to_pylist()):
            at = 2 * int(rest) + int(toxic)
            for w in words(text):
                if w not in found:
                    if len(found) >= COUNTED_WORDS:
                        yield hand_on()
                    found[w] = [0, 0, 0, 0]
                found[w][at] += 1
    yield hand_on()


def _scaled(counts: DataFrame) -> tuple[DataFrame, float] | None:
    """Counts with both classes brought to the smaller one's total, and that total; None if a class has no word."""
    sums = counts.agg(F.sum("o").alias("o"), F.sum("t").alias("t")).first()
    if not sums.o or not sums.t:
        return None
    n = min(sums.o, sums.t)
    return counts.select("word", *[(F.col(c) * (n / sums[c])).alias(c) for c in ("o", "t")]), float(n)


def _kneser_ney(counts: DataFrame) -> dict | None:
    """Log-likelihood ratios (toxic over ordinary) of the words and stems whose counts outlive the discount, and the one
    ratio of all other stems.  ``counts``: word, o, t."""
    scaled = _scaled(counts)
    if scaled is None:
        return None
    rows, n = scaled
    d = F.lit(DISCOUNT)
    rows = rows.withColumn("stem", F.substring("word", 1, STEM))
    stems = cut_lineage(rows.groupBy("stem").agg(F.sum("o").alias("so"), F.sum("t").alias("st"), F.count("word").alias("forms")))
    lost = [F.sum(F.least(F.col(c), d)).alias(c) for c in ("o", "t")]
    w = rows.agg(*lost, F.count("word").alias("words")).first()
    s = stems.agg(F.sum(F.least("so", d)).alias("o"), F.sum(F.least("st", d)).alias("t")).first()
    shared = F.col("forms") / F.lit(float(w.words))
    for c in ("o", "t"):  # P_c(stem)
        stems = stems.withColumn(f"p{c}", (F.greatest(F.col(f"s{c}") - d, F.lit(0.0)) + s[c] * shared) / n)
    of_stem = F.log(w.t * F.col("pt")) - F.log(w.o * F.col("po"))
    kept_stems = stems.where(F.greatest("so", "st") > d).select("stem", of_stem.alias("llr"))
    p = {c: (F.greatest(F.col(c) - d, F.lit(0.0)) + w[c] * F.col(f"p{c}") / F.col("forms")) / n for c in ("o", "t")}
    kept_words = (rows.where(F.greatest("o", "t") > d).join(stems, "stem")
                  .select("word", (F.log(p["t"]) - F.log(p["o"])).alias("llr")))

    def table(df):
        got = df.toPandas()
        return dict(zip(got.iloc[:, 0].tolist(), got.iloc[:, 1].tolist()))
    return {"words": table(kept_words), "stems": table(kept_stems), "other": float(np.log(w.t * s.t) - np.log(w.o * s.o))}


class Ratios(dict):
    """word -> log-likelihood ratio; unknown short words are remembered, up to a bound."""

    def __init__(self, model: dict):
        super().__init__(model["words"])
        self.stems, self.other = model["stems"], model["other"]
        self.bound = len(self) + KNOWN_WORDS

    def __missing__(self, word):
        value = self.stems.get(word[:STEM], self.other)
        if len(word) <= KNOWN_LENGTH and len(self) < self.bound:
            self[word] = value
        return value


def evidence(text: str | None, ratios: Ratios) -> list[float]:
    """1, log(1 + words), mean ratio of the text, and of its most toxic passages; zeros for a text without words."""
    ws = words(text)
    if not ws:
        return [1.0] + [0.0] * (2 + len(WINDOWS))
    sums = np.concatenate(([0.0], np.cumsum(np.fromiter(map(ratios.__getitem__, ws), float, len(ws)))))
    top = []
    for k in WINDOWS:
        k = min(k, len(ws))
        top.append(float((sums[k:] - sums[:-k]).max() / k))
    return [1.0, float(np.log1p(len(ws))), float(sums[-1] / len(ws)), *top]


def logistic(x: np.ndarray, y: np.ndarray) -> dict:
    """Ridge-penalised logistic regression by Newton steps on standardised columns (the first is the constant)."""
    mean, spread = x.mean(axis=0), x.std(axis=0)
    mean[0], spread = 0.0, np.where(spread > 1e-12, spread, 1.0)
    z, w = (x - mean) / spread, np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -35, 35)))
        gradient = z.T @ (p - y) + RIDGE * w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + RIDGE * np.eye(len(w)), gradient)
        w -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return {"mean": mean, "spread": spread, "weights": w}


def _applied(df: DataFrame, ddl: str, names: list[str], of) -> DataFrame:
    """mapInArrow that puts ``of(texts)``, columns of an array, in place of the column ``text``."""
    def run(batches):
        f = None
        for b in batches:
            f = f or of()
            out = f(b.column("text").to_pylist())
            others = [b.column(i) for i, n in enumerate(b.schema.names) if n != "text"]
            yield pa.RecordBatch.from_arrays([*others, *(pa.array(c) for c in out)], names=names)
    return df.mapInArrow(run, ddl)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> dict:
    """Model from the documents that carry a label (0 or 1); a document labelled twice counts with its larger label.

    About MAX_PER_CLASS documents of each class are read, all of a class that has fewer.  Word counts are summed in
    Spark; the driver gets the words counted more than DISCOUNT times, the stems, and the calibration part's numbers,
    all bounded by MAX_PER_CLASS.  Without words of both classes, in both parts, every score is the share of label 1
    (0.5 without labels)."""
    spark = C.prepare(docs.sparkSession)
    y = (labels.select(F.col("doc_id").cast("long").alias("_id"), F.col(label_col).cast("int").alias("y"))
         .where("_id is not null and y in (0, 1)").groupBy("_id").agg(F.max("y").alias("y")))
    text = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("text"))
    labelled = cut_lineage(text.select("_id").distinct().join(y, "_id"))
    sizes = {r.y: r.n for r in labelled.groupBy("y").agg(F.count("_id").alias("n")).collect()}
    model = {"prior": sizes.get(1, 0) / sum(sizes.values()) if sizes else 0.5, "words": None}
    if len(sizes) < 2:
        return model
    place = F.pmod(F.xxhash64(F.col("_id"), F.lit("toxicity")), F.lit(1 << 32)) / float(1 << 32)
    share = F.when(F.col("y") == 1, min(1.0, MAX_PER_CLASS / sizes[1])).otherwise(min(1.0, MAX_PER_CLASS / sizes[0]))
    part = F.pmod(F.xxhash64(F.col("_id"), F.lit("calibration")), F.lit(CALIBRATION_FOLDS)) == 0
    pick = labelled.where(place < share).withColumn("rest", part)
    # the table of picked ids is bounded by MAX_PER_CLASS, whatever the number of labels
    taken = text.join(F.broadcast(pick), "_id").select("text", "y", "rest")
    counts = cut_lineage(taken.mapInArrow(_count, "word string, o0 long, t0 long, o1 long, t1 long")
                         .groupBy("word").agg(*[F.sum(c).alias(c) for c in ("o0", "t0", "o1", "t1")]))
    part_model = _kneser_ney(counts.select("word", F.col("o0").alias("o"), F.col("t0").alias("t")).where("o + t > 0"))
    whole_model = _kneser_ney(counts.select("word", (F.col("o0") + F.col("o1")).alias("o"), (F.col("t0") + F.col("t1")).alias("t")))
    if part_model is None or whole_model is None:
        return model
    shared = spark.sparkContext.broadcast(part_model)

    def numbers():
        ratios = Ratios(shared.value)
        return lambda texts: np.array([evidence(t, ratios) for t in texts]).reshape(len(texts), -1).T
    names = [f"x{i}" for i in range(3 + len(WINDOWS))]
    got = _applied(taken.where("rest").select("y", "text"), "y int, " + ", ".join(f"{n} double" for n in names),
                   ["y", *names], numbers).toPandas()
    shared.unpersist()
    if got["y"].nunique() < 2:
        return model
    got = got.sort_values(list(got.columns))  # sums in one order
    return model | whole_model | logistic(got[names].to_numpy(float), got["y"].to_numpy(float))


def score(df: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, score, predicted`` (1 from a score of 0.5).

    A null or empty text has no word and no evidence: the regression's value for that.  Repeated rows and null ids give
    a row each; equal texts have equal scores; other columns are not read; an empty table gives an empty result."""
    spark = C.prepare(df.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    def scores():
        m = shared.value
        if m["words"] is None:
            return lambda texts: [np.full(len(texts), m["prior"])]
        ratios = Ratios(m)

        def of(texts):
            x = np.array([evidence(t, ratios) for t in texts]).reshape(len(texts), -1)
            # summed column by column: a text's score doesn't depend on the texts beside it
            z = sum(((x[:, i] - m["mean"][i]) / m["spread"][i] * m["weights"][i] for i in range(x.shape[1])), np.zeros(len(x)))
            return [1 / (1 + np.exp(-np.clip(z, -35, 35)))]
        return of
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return (_applied(rows, "doc_id long, score double", ["doc_id", "score"], scores)
            .withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0)))


def toxicity(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; labels are learned only from rows that are not held out
    (crc32 of the id as text modulo 5 is 0).  Odd rows: see :func:`fit` and :func:`score`."""
    held = F.coalesce(C.crc_mod(id_col, 5) == 0, F.lit(False))
    out = score(df, fit(df.where(~held), labels, id_col, text_col), id_col, text_col)
    return out.select("doc_id", F.coalesce(C.crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")
