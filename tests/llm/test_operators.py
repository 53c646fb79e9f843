"""Each operator against a plain restatement of its contract on the smallest tables."""

import hashlib
import os
import random
import re
import zlib

import brute
import numpy as np
import pytest

import __spark_entry__ as E

pytest.importorskip("public_tokenizers")
import public_tokenizers as PT  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(os.path.join(SF_SMALL, "documents.parquet"))


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_op1_language_id(spark, docs):
    got = {r.doc_id: r for r in E.queries()["op1_language_id"](spark, SF_SMALL).collect()}
    held = [r for r in docs.collect() if got[r.doc_id].held_out]
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in docs.collect())
    assert np.mean([got[r.doc_id].lang_pred == r.lang for r in held if r.lang]) >= 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_op1_ftrl_against_one_coordinate_at_a_time():
    """The regression's weights, from a plain restatement of FTRL-proximal with elastic net over dicts."""
    from math import exp, sqrt

    from revsift.llm import language_id as L
    rng = np.random.default_rng(1)
    rows = [(np.sort(rng.choice(12, 4, replace=False)), rng.random(4), int(rng.integers(3))) for _ in range(25)]
    rows.append((np.array([3, 12]), np.array([0.5, 0.001]), 1))   # too little of feature 12 to leave zero
    z, n = {}, {}

    def weight(i, c):
        v = z.get((i, c), 0.0)
        if abs(v) <= L.L1:
            return 0.0
        return -(v - (L.L1 if v > 0 else -L.L1)) / ((L.BETA + sqrt(n.get((i, c), 0.0))) / L.ALPHA + L.L2)
    order = np.random.default_rng(7)
    for _ in range(L.EPOCHS):
        for r in order.permutation(len(rows)):
            at, x, y = rows[r]
            features = [*zip(at.tolist(), x.tolist()), (13, 1.0)]
            score = [sum(v * weight(i, c) for i, v in features) for c in range(3)]
            total = sum(exp(v) for v in score)
            old = {(i, c): weight(i, c) for i, _ in features for c in range(3)}
            for i, v in features:
                for c in range(3):
                    g = v * (exp(score[c]) / total - (c == y))
                    before = n.get((i, c), 0.0)
                    z[i, c] = z.get((i, c), 0.0) + g - (sqrt(before + g * g) - sqrt(before)) / L.ALPHA * old[i, c]
                    n[i, c] = before + g * g
    want = np.array([[weight(i, c) for c in range(3)] for i in range(14)])
    assert np.allclose(L.fit_ftrl(rows, 13, 3), want, atol=1e-9) and (want[12] == 0).all()


def test_op1_predictions_against_one_text_at_a_time(spark, docs, rows):
    """Every prediction and score from the model's parts: n-gram counts by slicing, TF-IDF, weights, temperature."""
    from revsift.llm import char_features as CF
    from revsift.llm import language_id as L
    model = L.fit(docs)
    feats = CF.CharNgrams(L.BITS, L.NGRAM, fold=True)
    got = {r.doc_id: r for r in L.predict(docs, model).collect()}
    texts = [t or "" for _, t in rows]
    seen = sum((feats.counts(t) > 0).astype(int) for t in texts if t)
    assert np.allclose(model["idf"], np.log((1 + sum(map(bool, texts))) / (1 + seen)) + 1, atol=1e-5) or docs.where("lang is null").count()
    for d, t in rows[::7]:
        if not any(c.isalpha() for c in t or ""):
            assert got[d].lang_pred == "und"
            continue
        c = feats.counts(t)
        v = np.log1p(c.astype(float)) * model["idf"]
        v /= np.sqrt(v @ v)
        logit = (v @ model["w"][:-1] + model["w"][-1]) / model["temperature"]
        p = np.exp(logit - logit.max())
        p /= p.sum()
        assert got[d].lang_pred == model["langs"][int(p.argmax())] and got[d].score == pytest.approx(p.max(), abs=1e-3)


def test_op2_html(spark):
    import html
    pages = spark.read.parquet(os.path.join(SF_SMALL, "pages.parquet")).collect()

    def want(h):
        inner = h[h.index("<article>") + 9:h.index("</article>")]
        parts = re.split(r"<(?:/?p|/?h1)>", inner)
        parts = [" ".join(html.unescape(x.replace("<br>", " ").replace("<b>", "")).split()) for x in parts]
        return "\n\n".join(x for x in parts if x)
    got = {r.page_id: r for r in E.queries()["op2_html_extraction"](spark, SF_SMALL).collect()}
    assert len(got) == len(pages)
    assert np.mean([got[p.page_id].text == want(p.html) for p in pages]) >= 0.98
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_op2_decoding_has_no_contradiction():
    from revsift.llm.html_extract import decode
    rng = np.random.default_rng(4)
    for _ in range(50):
        n = 12
        parent = [-1] + [int(rng.integers(i)) for i in range(1, n)]
        odds = rng.normal(0, 2, n)
        keep = decode(parent, odds)
        assert keep[0] and all(keep[parent[i]] or not keep[i] for i in range(1, n))

        def ll(k):
            return -np.logaddexp(0, np.where(k, -odds, odds)).sum()
        best = max(ll(np.array(k)) for k in _consistent(parent))
        assert ll(keep) == pytest.approx(best)


def _consistent(parent):
    out = [[True]]
    for i in range(1, len(parent)):
        out = [k + [c] for k in out for c in ((True, False) if k[parent[i]] else (False,))]
    return out


def test_op3_jaccard(spark, rows):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in E.queries()["op3_jaccard_join"](spark, SF_SMALL).collect()}
    assert got == brute.jaccard_components(rows)


def test_op3_groups_of_copies(spark):
    """Many near copies of one text, some linked only through others, beside a passage that all texts share."""
    from revsift.llm.jaccard_join import jaccard_components
    rng = random.Random(5)
    base = [f"w{i}" for i in range(90)]
    shared = [f"s{i}" for i in range(40)]
    rows = []
    for i in range(160):
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(w + (shared if i % 3 == 0 else []))))
    for i in range(160, 260):
        rows.append((i, " ".join([f"y{rng.randrange(10 ** 6)}" for _ in range(rng.randint(1, 60))] + shared)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df).collect()}
    assert got == brute.jaccard_components(rows)


def test_op4_base_and_held_out(spark, rows):
    import math
    from collections import Counter
    got = {r.doc_id: r for r in E.queries()["op4_lm_scoring"](spark, SF_SMALL).collect()}
    c = Counter()
    tokens = {d: brute.WORD.findall(brute.lower(t or "")) + [None] for d, t in rows}
    for d, w in tokens.items():
        if zlib.crc32(str(d).encode()) % 5 != 1:
            c.update(w)
    total, distinct = sum(c.values()), len(c)
    for d, w in tokens.items():
        r = got[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(c[x] > 0 for x in w), total)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + .5) / (total + .5 * (distinct + 1))) for x in w))
        assert r.score < 0


def test_op4_model():
    from revsift.llm import lm_scoring as L
    rng = np.random.default_rng(0)
    texts = [(rng.integers(0, L.TYPES, n).astype(np.uint16), rng.integers(0, L.CLASSES, n).astype(np.uint8))
             for n in (1, 2, 4, 15, 16, 17, 28, 29, 40, 200)]
    m = L.Attention()
    for t in texts:  # every id is scored by exactly one window
        _, _, weight = L._batch([t])
        assert weight.sum() == len(t[1])
    together = L.class_log10(m, texts)
    assert np.allclose(together, [L.class_log10(m, [t])[0] for t in texts], rtol=1e-4)
    xs, ys, _ = L._batch(texts)
    assert np.allclose(m.target_log(xs, ys), np.take_along_axis(m.forward(xs), ys[..., None], 2)[..., 0], atol=1e-4)
    x = np.array([t[0][:16] for t in texts[-2:]])
    p = np.exp(m.forward(x)).sum(axis=2)
    assert np.allclose(p, 1, atol=1e-4)
    y = x.copy()
    y[:, 9] = 0  # causal: a later id changes nothing before it
    assert np.allclose(m.forward(x)[:, :9], m.forward(y)[:, :9], atol=1e-6)
    # gradients agree with differences
    xs, ys, w = L._batch(texts[-2:])
    _, g = m.gradients(xs, ys, w)
    for name, at in (("wq", (1, 2)), ("wv", (0, 3)), ("wu", (2, 5)), ("pos", (3, 1)), ("wo", (4, 4)), ("wk", (2, 2))):
        a = getattr(m, name)
        old = a[at]
        losses = []
        for step in (1e-2, -1e-2):
            a[at] = old + step
            losses.append(m.gradients(xs, ys, w)[0])
        a[at] = old
        assert g[name][at] == pytest.approx((losses[0] - losses[1]) / 2e-2, abs=2e-3)


def test_op4_shares_sum_to_one_in_each_class():
    from revsift.llm import lm_scoring as L
    counts = np.arange(500)[::-1].astype(float)
    cls, share = L.classes_of(counts)
    keys = np.array([(3 << 32) | 7, (3 << 32) | 11, (L.START << 32) | 5], np.int64)
    s = L.PairShares(keys, np.array([4, 1, 9]), cls, share)
    for before in (3, L.START, 77):
        p = 10 ** s.log10(np.arange(500), np.full(500, before))
        assert np.allclose(np.bincount(cls, p, L.CLASSES)[np.unique(cls)], 1)


def test_op4_next_events_sum_to_one():
    """After any ids: the word goes on, another word begins, or the text ends; over all of them, probability one."""
    from revsift.llm import lm_scoring as L
    rng = np.random.default_rng(3)
    n, end = 400, 399
    per_id = rng.integers(0, 50, n).astype(float)
    cls, share = L.classes_of(per_id)
    kinds = L.types_of(per_id)
    keys = np.unique((rng.integers(0, n, 900) << 32) | rng.integers(0, n, 900))
    # no id is followed more often than it was met
    keys = keys[per_id[keys >> 32] > 5]
    starts = (np.int64(L.START) << 32) | np.unique(np.append(rng.integers(0, n, 60), end))
    counts = np.ones(len(keys), np.int64)
    shares = L.PairShares(np.concatenate((keys, starts)), np.concatenate((counts, np.full(len(starts), 3))), cls, share)
    context, at = np.unique(L.contexts_of(keys, cls), return_inverse=True)
    goes_on, ends = L.boundaries(per_id, context, np.bincount(at, counts).astype(float))
    model = L.Attention()
    every = np.arange(n)
    for a in (3, 77, 250):
        history = np.array([[L.TYPES, *kinds[rng.integers(0, n, 8)], kinds[a]] + [0] * (L.WINDOW - 10)])
        p_class = np.exp(model.forward(history)[0, 9])
        inside = (p_class[cls] * 10 ** shares.log10(every, np.full(n, a))).sum() * 10 ** goes_on[a]
        begins = (p_class[cls] * 10 ** shares.log10(every, np.full(n, L.START))).sum() * 10 ** ends[a]
        present = p_class[np.unique(cls)].sum()   # classes without an id have no share to give
        assert inside + begins == pytest.approx(present, abs=1e-4)
        assert 10 ** goes_on[a] + 10 ** ends[a] == pytest.approx(1)


def test_op4_scores_are_the_factors(spark, rows, monkeypatch):
    """Every score, recomputed id by id: boundary, class and share, the end of the text included."""
    from revsift.llm import lm_scoring as L
    seen, score = [], L._score
    monkeypatch.setattr(L, "_score", lambda path, shared: seen.append(shared.value) or score(path, shared))
    path = PT.path("word_bpe_49k.json")
    some = [*rows[:60], (900_001, None), (900_002, "one"), (900_003, " ")]
    got = {r.doc_id: r.score for r in L.lm_scores(_lm_table(spark, some), path, end_id=49407).collect()}
    s, ids_of = seen[0], L.WordIds(path)
    goes_on, ends = s["boundaries"]
    for d, t in some:
        ids, before, size = L._flat_ids((t or "").lower().encode().split(), ids_of)
        ids, before = np.append(ids, 49407), np.append(before, L.START)
        want = s["shares"].log10(ids, before).sum()
        for i in range(len(ids) - 1):   # what follows each id
            want += ends[ids[i]] if before[i + 1] == L.START else goes_on[ids[i]]
        want += L.class_log10(s["model"], [(s["kinds"][ids], s["class"][ids])])[0]
        assert got[d] == pytest.approx(want, rel=1e-4, abs=1e-3)


def test_op4_least_frequent_count(spark):
    from revsift.llm.lm_scoring import frequent
    df = spark.createDataFrame([(i, n) for i, n in enumerate([9, 9, 7, 7, 7, 2, 2, 1])], "key long, n long")
    assert [frequent(df, k) for k in (1, 2, 4, 5, 7, 8, 99)] == [1 << 62, 9, 9, 7, 2, 1, 1]


def _lm_table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_op4_fit_reads_every_training_text(spark, rows, monkeypatch):
    from revsift.llm import lm_scoring as L
    from revsift.llm.word_ids import WordIds
    path = PT.path("word_bpe_49k.json")
    monkeypatch.setattr(L, "MAX_FIT_TEXTS", 2)
    seen, fit = [], L.Attention.fit
    monkeypatch.setattr(L.Attention, "fit", lambda self, texts, **kw: seen.append((len(texts), kw["pairs"])) or fit(self, texts, **kw))
    ids_of = WordIds(path)
    flat = [np.append(np.frombuffer(b"".join(ids_of.ids(w) for w in (t or "").lower().encode().split()), "<u4"), 49407) for _, t in rows]
    counts = np.bincount(np.concatenate(flat), minlength=49408).astype(float)
    kinds, (cls, _) = L.types_of(counts), L.classes_of(counts)
    train = _lm_table(spark, rows).selectExpr("doc_id", "cast(text as binary) AS text")
    got = L.fit_all(train, path, kinds, cls, sum(map(len, flat)), 49407)
    want = np.zeros((L.TYPES + 1, L.CLASSES))
    for i in flat:
        np.add.at(want, (np.append(L.TYPES, kinds[i[:-1]]), cls[i]), 1)
    assert seen[0][0] == 2 and np.array_equal(seen[0][1], want)
    # small parts: every part's windows change the weights, however the table is partitioned
    monkeypatch.setattr(L, "PART_IDS", 20_000)
    many = L.fit_all(train, path, kinds, cls, sum(map(len, flat)), 49407)
    again = L.fit_all(train.repartition(7), path, kinds, cls, sum(map(len, flat)), 49407)
    assert np.allclose(many.weights(), again.weights(), atol=1e-5)
    texts = [(kinds[i], cls[i]) for i in flat]
    start = fit(L.Attention(), texts[:2], pairs=want)
    for model in (got, many):
        assert L.class_log10(model, texts).sum() > L.class_log10(start, texts).sum()


def test_op4_pairs_outside_the_broadcast_keep_their_counts(spark, rows, monkeypatch):
    from revsift.llm import lm_scoring as L
    df, path = _lm_table(spark, rows[:120]), PT.path("word_bpe_49k.json")
    want = {r.doc_id: r.score for r in L.lm_scores(df, path, end_id=49407).collect()}
    for limit in (1, 300):
        monkeypatch.setattr(L, "FREQUENT_PAIRS", limit)
        got = {r.doc_id: r.score for r in L.lm_scores(df, path, end_id=49407).collect()}
        assert got == pytest.approx(want, rel=1e-6)


def test_op5_fingerprints(spark, rows):
    got = {r.doc_id: r for r in E.queries()["op5_fingerprints"](spark, SF_SMALL).collect()}
    order = sorted(((d, t or "") for d, t in rows), reverse=True)

    def grams(t):
        w = brute.WORD.findall(t)
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}
    near, nxt, seen = [], [], {}
    for i, (d, t) in enumerate(order):
        after = order[(i + 1) % len(order)][1]
        m = len(t) // 3
        edited = t[:len(t) - m] + after[:m]
        r = got[d]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert seen.setdefault(t, r.fingerprint) == r.fingerprint and len(r.fingerprint) == 128
        a, b, c = grams(t), grams(edited), grams(after)
        near.append(r.near_edited - len(a & b) / len(a | b))
        nxt.append(r.near_next - len(a & c) / len(a | c))
    assert abs(np.mean(near)) < 0.03 and np.mean(np.abs(near)) < 0.06 and np.mean(np.abs(nxt)) < 0.03


def test_op5_trims_white_space_and_nothing_else(spark):
    """Letters that look like escapes stay; form feeds and the like go; texts that differ in them are told apart."""
    from revsift.llm.fingerprint import with_fingerprint
    texts = ["fff", "", "four words of beef", "our words of bee", "\ff of\f", "f of", "\x0b\x0c\r\n\t t", "t", "ttt nnn", "rn", "vb f"]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {r.i: r.fp for r in with_fingerprint(spark.createDataFrame(rows, "i int, t string"), "t", "fp").collect()}
    words = [tuple(brute.WORD.findall(t)) for t in texts]
    for i in range(len(texts)):
        for j in range(len(texts)):
            assert (got[i] == got[j]) == (words[i] == words[j]), (texts[i], texts[j])


def test_op5_no_python_in_the_plan(spark, docs):
    from revsift.llm.fingerprint import fingerprints
    plan = fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|MapIn", plan)


def test_op6_quality(spark):
    got = {r.doc_id: r for r in E.queries()["op6_quality_classifier"](spark, SF_SMALL).collect()}
    labels = spark.read.parquet(os.path.join(SF_SMALL, "labels.parquet")).collect()
    held = [(got[r.doc_id], r.quality) for r in labels if got[r.doc_id].held_out]
    assert all(g.predicted == int(g.score >= 0.7) and 0 <= g.score <= 1 for g in got.values())
    good = [g.predicted for g, q in held if q == 1]
    bad = [g.predicted for g, q in held if q == 0]
    assert np.mean(good) >= 0.95 and (not bad or np.mean(bad) <= 0.4)


def test_op6_vote_is_exact():
    from revsift.llm import quality_knn as Q
    rng = np.random.default_rng(1)
    known = Q._unit(rng.normal(size=(300, 8)).astype(np.float32))
    y = rng.integers(0, 2, 300).astype(np.float32)
    asked = Q._unit(rng.normal(size=(40, 8)).astype(np.float32))
    got = Q.vote(asked, {"vectors": known, "y": y, "prior": 0.5})
    for a, g in zip(asked, got):
        cos = known @ a
        at = np.argsort(-cos)[:Q.NEIGHBOURS]
        w = np.maximum(cos[at], 0).astype(float) ** Q.POWER
        assert g == pytest.approx((w * y[at]).sum() / w.sum(), abs=1e-4)


def test_op7_substring_dedup(spark, rows):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256)
           for r in E.queries()["op7_substring_dedup"](spark, SF_SMALL).collect()}
    want = brute.substring_dedup(rows)
    assert got == {d: (n, r, hashlib.sha256(k.encode()).hexdigest()) for d, (n, r, k) in want.items()}


def test_op7_runs_periods_and_shared_passages(spark):
    from revsift.llm.substring_dedup import substring_dedup
    rng = random.Random(9)
    rows = [(1, "a " * 40), (2, "a " * 25 + "b"), (3, "x " + "a " * 13), (4, "a " * 12), (5, "a b " * 20),
            (6, "b a " * 9 + "q"), (7, "p q r " * 12), (8, "z " + "q r p " * 5)]
    passage = [rng.choice("klmno") + str(rng.randrange(9)) for _ in range(14)]
    for i in range(9, 60):
        w = [rng.choice(["the", "of", "and", f"u{rng.randrange(50)}"]) for _ in range(rng.randrange(30))]
        rows.append((i, " ".join(w + passage[rng.randrange(2):rng.randrange(12, 15)] + w[::-1])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring_dedup(df).collect()}
    assert got == brute.substring_dedup(rows)


def test_op8_round_trip(spark, rows):
    import base64
    tiktoken = pytest.importorskip("tiktoken")
    with open(PT.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=PT.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in E.queries()["op8_byte_bpe"](spark, SF_SMALL).collect()}
    for d, t in rows:
        ids = enc.encode_ordinary(t or "")
        assert got[d].n_tokens == len(ids)
        assert got[d].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[d].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_op8_decodes_any_ids(spark):
    """Decoding in the worker that encodes, and by itself, give the same bytes; chunks cut anywhere change nothing."""
    from revsift.llm import byte_bpe
    path = PT.path("byte_bpe_multi_50k.tiktoken")
    texts = [None, "", "a b", "Ünï cödé 漢字", "x" * 5000, " ".join(f"w{i}" for i in range(4000))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    one = {r.doc_id: (r.ids, bytes(r.decoded)) for r in byte_bpe.bpe_encode(df, path, PT.PATTERN, decode=True).collect()}
    two = {r.doc_id: (r.ids, bytes(r.decoded)) for r in byte_bpe.bpe_decode(byte_bpe.bpe_encode(df, path, PT.PATTERN), path).collect()}
    assert one == two and all(one[i][1].decode() == (t or "") for i, t in enumerate(texts))


def test_op8_long_and_odd_pieces():
    import base64
    tiktoken = pytest.importorskip("tiktoken")
    from revsift.llm.byte_bpe import RankBitmap, RankTable
    path = PT.path("byte_bpe_multi_50k.tiktoken")
    table = RankTable(path)
    enc = tiktoken.Encoding("own", pat_str=r"(?s:.+)", mergeable_ranks=table.ranks, special_tokens={})
    rng = random.Random(3)
    pieces = ["a" * 4000, "".join(rng.choice("ab") for _ in range(3000)), "the" * 900, "漢字" * 300, "=" * 77, " \n" * 99,
              *("".join(rng.choice("aeinrst ehAÉ'1\n") for _ in range(rng.randint(1, 90))) for _ in range(150))]
    got = [np.frombuffer(x, "<i4").tolist() for x in table.encode([p.encode() for p in pieces])]
    assert got == [enc.encode_ordinary(p) for p in pieces]
    q, want = RankBitmap(300_000), sorted(rng.sample(range(300_000), 200))
    for i in rng.sample(want, len(want)):
        q.add(i)
    assert [q.pop_first() for _ in want] == want and q.pop_first() == -1


def test_op9_packing(spark, rows):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(PT.path("word_bpe_49k.json"))
    got = E.queries()["op9_packing"](spark, SF_SMALL).collect()
    pieces, layout = {}, {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append(r)
        layout.setdefault(r.sequence_id, []).append(r)
    for d, t in rows:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for r in sorted(pieces[d], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for parts in layout.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    assert sum(r.length for r in got) / (4096 * len(layout)) > 0.95


def test_op9_fills_windows_from_all_lengths():
    """Thousands of distinct lengths: every one is offered to the subset-sum, so next to nothing is padded."""
    from revsift.llm.packing import plan
    rng = random.Random(4)
    hist = {}
    for _ in range(20_000):
        n = rng.randint(700, 2500)
        hist[n] = hist.get(n, 0) + 1
    bins = plan(hist, 4096)
    used = {}
    for times, pattern in bins:
        assert sum(n * k for n, k in pattern.items()) <= 4096
        for n, k in pattern.items():
            used[n] = used.get(n, 0) + times * k
    assert used == hist
    assert sum(n * c for n, c in hist.items()) / (4096 * sum(t for t, _ in bins)) > 0.98


def test_op9_fill_and_plan():
    from revsift.llm.packing import fill, plan
    rng = random.Random(6)
    for _ in range(200):
        lengths = sorted(rng.sample(range(1, 60), rng.randint(1, 6)), reverse=True)
        counts = [rng.randint(0, 4) for _ in lengths]
        room = rng.randint(0, 120)
        total, used = fill(lengths, counts, room)
        reach = {0}
        for n, c in zip(lengths, counts):
            reach = {s + k * n for s in reach for k in range(c + 1) if s + k * n <= room}
        assert total == max(reach) == sum(n * u for n, u in zip(lengths, used))
        assert all(u <= c for u, c in zip(used, counts))
    histogram = {n: rng.randint(1, 9) for n in range(1, 101)}
    used = {}
    for times, pattern in plan(histogram, 100):
        assert times > 0 and sum(n * k for n, k in pattern.items()) <= 100
        for n, k in pattern.items():
            used[n] = used.get(n, 0) + times * k
    assert used == histogram


def test_word_ids_equal_the_tokenizer():
    from revsift.llm.word_ids import WordIds
    ids_of = WordIds(PT.path("word_bpe_49k.json"))
    rng = random.Random(2)
    alphabet = "abcXYZ éÉßñÑüÜ'’ſİıĲ0192½²ªº.,!?$%&€漢字Σς  ́\x85\x1c<|>~\\—"
    texts = ["don't", "O'NEIL'S", "<|endoftext|>", "a<|endoftext|>b", "ﬁ", *(
        "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 9))) for _ in range(1500))]
    for t in texts:
        got = np.frombuffer(b"".join(ids_of[w] for w in t.encode().split()), "<u4").tolist()
        assert got == ids_of.tok.encode(t, add_special_tokens=False).ids, t


def test_op10_base_counts(spark, rows):
    got = {r.doc_id: r for r in E.queries()["op10_quality_rules"](spark, SF_SMALL).collect()}
    for d, t in rows:
        assert tuple(got[d][k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                         "base_failed")) == brute.quality_base(t)
        assert not (got[d].kept and got[d].base_failed)


def test_op10_coverage():
    from revsift.llm import common as C
    from revsift.llm.quality_rules import repetition
    rng = random.Random(8)
    for _ in range(60):
        w = [rng.choice("abcde") * rng.randint(1, 3) for _ in range(rng.randint(0, 60))]
        h = np.array([hash(x) & 0xFFFFFFFF for x in w], np.uint64)
        n, chars = repetition(C.mix64(h), np.array([len(x) for x in w], np.int64))
        assert (n, chars) == brute.coverage(w)


def test_pipeline_stages(spark, docs):
    """Each stage against its operator's brute force or its own decision, on its own input."""
    import corpus_pipeline as P
    assert [n for n, _ in P.STAGES] == ["quality classifier", "language id", "n-gram jaccard join", "substring dedup",
                                        "packing"]
    first = P.STAGES[0][1](spark, docs, SF_SMALL)
    assert tuple(first.columns) == P.COLUMNS and 0 < first.count() < docs.count()
    second = P.STAGES[1][1](spark, docs.limit(150).unionByName(
        spark.createDataFrame([(10 ** 6, "123 456 --", None, None, 10)], docs.schema)), SF_SMALL)
    assert 10 ** 6 not in {r.doc_id for r in second.collect()} and second.count() == 150
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    third = {r.doc_id for r in P.STAGES[2][1](spark, docs, SF_SMALL).collect()}
    assert third == {c for _, c in brute.jaccard_components(rows).values()}
    fourth = {r.doc_id: (r.text, r.n_chars) for r in P.STAGES[3][1](spark, docs, SF_SMALL).collect()}
    want = {d: k if gone else dict(rows)[d] for d, (_, gone, k) in brute.substring_dedup(rows).items()}
    assert fourth == {d: (t, len(t)) for d, t in want.items()}


@pytest.mark.parametrize("name", ["op3_jaccard_join", "op7_substring_dedup", "op10_quality_rules"])
def test_sql_agrees(spark, name):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == sorted(df.columns)
    assert sorted(rel.fetchall()) == sorted(tuple(r[c] for c in rel.columns) for r in df.collect())
