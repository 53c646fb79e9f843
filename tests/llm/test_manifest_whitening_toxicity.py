"""Toxicity, the Merkle manifest and embedding whitening: against plain restatements, on the tables and on odd rows."""

import math
import random
import zlib

import brute_merkle
import brute_whitening
import numpy as np
import pytest

import __spark_entry__ as E

pytest.importorskip("revsift.llm.queries")
SF_SMALL = "/root/testdata/sf0.001"
COLS = ("doc_id", "source", "lang", "n_chars", "text")


# ------------------------------------------------------------------ toxicity


def _labelled(spark, n=600, seed=4):
    """Invented prose; the toxic documents hold one of three words, or a rare ending of a stem."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice(["ba", "ne", "ti", "so", "ru", "ling", "dor"]) for _ in range(rng.randint(1, 4))) for _ in range(900)]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(20, 200))]
        toxic = int(i % 4 == 0)
        for _ in range(rng.randint(1, 3) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["Zounder!", "grimbul", "vexx" + rng.choice(vocabulary)]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_held_out(spark):
    from revsift.llm.toxicity import toxicity
    docs, labels = _labelled(spark)
    got = {r.doc_id: r for r in toxicity(docs, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    held = [d for d, r in got.items() if r.held_out]
    assert np.mean([got[d].predicted == 1 for d in held if d % 4 == 0]) >= 0.9
    assert np.mean([got[d].predicted == 0 for d in held if d % 4]) >= 0.97


def test_toxicity_learns_nothing_from_held_out_labels(spark):
    from pyspark.sql import functions as F
    from revsift.llm.toxicity import toxicity
    docs, labels = _labelled(spark, 200)
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic"))
                               .otherwise(F.col("toxic")))
    a, b = ({r.doc_id: r.score for r in toxicity(docs, x).collect()} for x in (labels, turned))
    assert a == b


def test_kneser_ney_against_plain_counts(spark):
    """Ratios of every word against the formula over Python dicts; probabilities of each class sum to one."""
    from revsift.llm import toxicity as T
    rng = random.Random(8)
    counts = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 7))): (rng.randint(0, 9), rng.randint(0, 5)) for _ in range(300)}
    counts = {w: c for w, c in counts.items() if sum(c)}
    model = T._kneser_ney(spark.createDataFrame([(w, *c) for w, c in counts.items()], "word string, o long, t long"))
    totals = [sum(c[i] for c in counts.values()) for i in (0, 1)]
    n = min(totals)
    scaled = {w: [c[i] * n / totals[i] for i in (0, 1)] for w, c in counts.items()}
    stems = {}
    for w, c in scaled.items():
        s = stems.setdefault(w[:T.STEM], [0.0, 0.0, 0])
        s[0], s[1], s[2] = s[0] + c[0], s[1] + c[1], s[2] + 1
    d = T.DISCOUNT
    word_mass = [sum(min(c[i], d) for c in scaled.values()) for i in (0, 1)]
    stem_mass = [sum(min(s[i], d) for s in stems.values()) for i in (0, 1)]

    def p(w, i):
        s = stems[w[:T.STEM]]
        of_stem = (max(s[i] - d, 0) + stem_mass[i] * s[2] / len(scaled)) / n
        return (max(scaled[w][i] - d, 0) + word_mass[i] * of_stem / s[2]) / n
    assert all(abs(sum(p(w, i) for w in scaled) - 1) < 1e-9 for i in (0, 1))
    ratios = T.Ratios(model)
    for w in scaled:
        assert abs(ratios[w] - math.log(p(w, 1) / p(w, 0))) < 1e-9
    # unknown word of a known stem: leans on the stem; unknown stem: the one shared ratio
    known = max(stems, key=lambda s: stems[s][1])
    if len(known) == T.STEM:
        assert ratios[known + "zzz"] == model["stems"][known]
    assert ratios["zzzzzz"] == model["other"]


def test_toxicity_on_odd_rows(spark):
    from revsift.llm.toxicity import toxicity
    docs, labels = _labelled(spark, 300)
    long = "ba ne " * 40_000 + "grimbul"
    odd = [(1001, None), (1002, ""), (1003, " \n"), (1004, "!!! ..."), (1005, long), (1006, "grimbul"), (1006, "grimbul"), (None, "grimbul")]
    odd = spark.createDataFrame([(*r, 0.5, "x", 7) for r in odd], "doc_id long, text string, score double, toxic string, y int")
    all_docs = odd.unionByName(docs.selectExpr("*", "0.1D score", "'z' toxic", "1 y"))
    more = labels.union(spark.createDataFrame([(None, 1, 1), (3, 0, None), (1, 0, 1), (1, 0, 0)], labels.schema))
    rows = toxicity(all_docs, more).collect()
    assert len(rows) == 308
    by = {r.doc_id: r for r in rows}
    assert by[1001].score == by[1002].score == by[1003].score == by[1004].score < 0.5
    assert by[1006].predicted == 1 and len({r.score for r in rows if r.doc_id in (1006, None)}) == 1 and not by[None].held_out
    assert toxicity(all_docs.where("1 = 0"), more).collect() == []
    # without labels, or with labels of one class only, every score is the share of label 1
    assert {r.score for r in toxicity(docs, labels.where("1 = 0")).collect()} == {0.5}
    assert {r.score for r in toxicity(docs, labels.where("toxic = 0")).collect()} == {0.0}


def test_op11_query(spark):
    rows = E.queries()["op11_toxicity"](spark, SF_SMALL).collect()
    assert len(rows) == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    assert all(0 <= r.score <= 1 for r in rows)


# ------------------------------------------------------------------ manifest


def _documents(n, sources, seed=2):
    rng = random.Random(seed)
    rows = [(i, sources[0] if i % 3 == 0 else rng.choice(sources), rng.choice(["en", None]), rng.choice([None, 7, -3]),
             rng.choice([None, "", "Text Ü ÄB", "lower", f"Row {i}"])) for i in range(n)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n,sources", [(1, ["a"]), (16, ["a"]), (17, ["a", None]), (700, ["hot", "b", "é", "", None, "Z"]),
                                       (400, [f"s{i}" for i in range(300)])])
def test_merkle_against_one_process(spark, n, sources):
    from revsift.llm.merkle import merkle_manifest
    rows = _documents(n, sources)
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    got = sorted(map(str, (tuple(r) for r in merkle_manifest(df).collect())))
    assert got == sorted(map(str, brute_merkle.manifest(rows)))


def test_merkle_on_odd_rows(spark):
    """Repeated rows, repeated ids of different texts, null ids, a very long text and clashing extra columns."""
    from revsift.llm.merkle import merkle_manifest
    rows = [(i, "a", "en", 4, "Same") for i in range(20)] + [(7, "a", "en", 4, "Same")] * 40 + [(7, "a", None, None, t) for t in ("x", "Y", None)]
    rows += [(None, "a", "en", 1, "T"), (None, "a", "en", 1, None), (None, None, None, None, None), (25, "b", "en", 9, "Long " * 300_000)]
    df = spark.createDataFrame([(*r, 3, "x", "p") for r in rows],
                               "doc_id long, source string, lang string, n_chars long, text string, idx int, hash string, grp string").repartition(4)
    got = sorted(map(str, (tuple(r) for r in merkle_manifest(df).collect())))
    assert got == sorted(map(str, brute_merkle.manifest(rows)))
    assert merkle_manifest(df.where("1 = 0")).collect() == []


def test_merkle_does_not_depend_on_partitions(spark):
    from revsift.llm.merkle import merkle_manifest
    df = spark.createDataFrame(_documents(300, ["a", "b"]), "doc_id long, source string, lang string, n_chars long, text string")
    one, many = (sorted(map(str, merkle_manifest(df.repartition(k)).collect())) for k in (1, 13))
    assert one == many


def test_op12_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = sorted(map(str, (tuple(r) for r in E.queries()["op12_merkle_manifest"](spark, SF_SMALL).collect())))
    assert got == sorted(map(str, brute_merkle.manifest([tuple(r) for r in docs.select(*COLS).collect()])))


# ------------------------------------------------------------------ whitening


@pytest.mark.parametrize("low,high", [(-300, 300), (0, 1), (-1, 2), (-2 ** 40, 2 ** 40), (-2 ** 63, 2 ** 63 - 1)])
def test_bit_sliced_scatter_is_exact(low, high):
    from revsift.llm.whitening import cross_products, limbs
    x = np.random.default_rng(3).integers(low, high, size=(131, 4), endpoint=False)
    sums, products = cross_products(x)
    plain = x.astype(object)
    assert list(sums) == list(plain.sum(axis=0)) and (products == plain.T @ plain).all()
    values = [int(v) for v in products.reshape(-1)]
    back = [0] * len(values)
    for at, limb, v in zip(*limbs(values)):
        back[at] += v << (32 * limb)
    assert back == values


def _check(rows, got):
    n, deviation, eigenvalues, cov, kept, sums = brute_whitening.whiten(rows)
    k = min(4, len(cov))
    assert len(got) == k * len(kept) and {r.n for r in got} == {n}
    left = sorted(((i is None, i or 0), deviation[x]) for i, x in kept for _ in range(k))
    assert sorted(((r.vec_id is None, r.vec_id or 0), r.deviation) for r in got) == left
    total = np.trace(cov)
    for r in got:
        assert abs(r.explained * total - eigenvalues[r.component - 1]) <= 1e-9 * total and r.identity_error <= 1e-9
    by = dict(kept)
    values = {(r.vec_id, r.component): r.whitened for r in got}
    fit = {x: i for i, x in kept if i is not None}   # a row for each distinct vector
    w = np.array([[values[i, c] for c in range(1, k + 1)] for i in fit.values()])
    assert np.abs(w.T @ w / n - np.eye(k)).max() <= 1e-9 and np.abs(w.mean(axis=0)).max() <= 1e-9
    # each component is an eigenvector: it correlates with the data as its eigenvalue says
    x = np.array([by[i] for i in fit.values()], float) - np.array(sums) / n
    directions = (x.T @ w) / n / np.sqrt(eigenvalues[:k])
    assert np.allclose(cov @ directions, directions * eigenvalues[:k], atol=1e-8 * total)
    assert np.allclose((directions ** 2).sum(axis=0), 1)


def test_whitening_against_python_integers(spark):
    from revsift.llm.whitening import whiten
    rng = np.random.default_rng(5)
    base = rng.standard_normal((300, 6)) * [3, 1, 1, 0.5, 0.2, 0.1] + [5, 0, -3, 0, 0, 0]
    rows = [(i, [float(v) for v in base[i]]) for i in range(300)] + [(1000 + i, [float(v) for v in base[0]]) for i in range(150)]
    rows += [(2000, None), (2001, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2002, [float("nan")] * 6), (2003, [float("inf")] + [0.0] * 5),
             (2004, []), (None, [float(v) for v in base[1]]), (3, [float(v) for v in base[3]])]
    df = spark.createDataFrame([(*r, 1, "a", 2.0) for r in rows], "vec_id long, embedding array<double>, n int, x string, whitened double").repartition(4)
    _check(rows, whiten(df).collect())
    assert whiten(df.where("1 = 0")).collect() == []
    assert whiten(df.where("vec_id between 2000 and 2004")).collect() == []


def test_whitening_of_flat_and_uneven_vectors(spark):
    from revsift.llm.whitening import whiten
    schema = "vec_id long, embedding array<float>"
    one = whiten(spark.createDataFrame([(1, [0.5, -0.5]), (2, [0.5, -0.5])], schema)).collect()
    assert len(one) == 4 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one} == {(1, 0, 0.0, 0.0, 0.0)}
    line = whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(10)], schema)).collect()
    assert {r.component: round(r.explained, 9) for r in line} == {1: 1.0, 2: 0.0, 3: 0.0} and max(r.identity_error for r in line) < 1e-9
    uneven = [(1, [1.0]), (2, [1.0, 0.0]), (3, [0.5, 2.0]), (4, [0.0, 1.0, 0.0]), (5, [3.0, 1.5, 1.0])]
    got = whiten(spark.createDataFrame(uneven, schema)).collect()
    assert len(got) == 15 and {r.n for r in got} == {4}   # (1) and (1, 0) are the same vector
    far = whiten(spark.createDataFrame([(1, [1e17, 0.0]), (2, [-1e17, 0.0]), (3, [0.0, 1.0])], "vec_id long, embedding array<double>")).collect()
    assert {r.deviation for r in far} == {None} or all(r.deviation is None or r.deviation < 2 ** 63 for r in far)
    assert max(r.identity_error for r in far) < 1e-4


def test_op13_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    _check(rows, E.queries()["op13_embedding_whitening"](spark, SF_SMALL).collect())
