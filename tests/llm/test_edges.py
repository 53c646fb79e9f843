"""Nulls, empty and long texts, repeated rows, empty tables and clashing extra columns, for every operator."""

import random

import brute
import pytest

pytest.importorskip("public_tokenizers")
import public_tokenizers as PT  # noqa: E402

LONG = " ".join(random.Random(1).choice(["alpha", "beta", "gamma", "delta", "42", "é'é"]) + str(i % 977) for i in range(60_000))
ROWS = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one two three four"), (6, LONG), (7, "word"), (7, "word"),
        (8, "Ünï cödé 漢字   x"), (None, "a row without an id and some more words to make fourteen of them in it"),
        (9, "a row without an id and some more words to make fourteen of them in it"),
        (10, "a row without an id and some more words to make fourteen of them in it"), (11, "<|endoftext|> & <b> ###")]
#: Names that operators use inside.
CLASH = ("score", "token", "s1", "n", "rep", "kept", "ids", "starts", "copy", "c", "f", "ghost", "length", "_keep_0")


@pytest.fixture(scope="module")
def odd(spark):
    values = [(d, t, "en" if t and len(t) > 3 else None, None, *([1] * len(CLASH))) for d, t in ROWS]
    cols = "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} int" for c in CLASH)
    return spark.createDataFrame(values, cols).repartition(3)


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("1 = 0")


def _ops(spark):
    from revsift.llm import byte_bpe, fingerprint, jaccard_join, language_id, lm_scoring, packing, quality_knn
    from revsift.llm import quality_rules, substring_dedup
    labels = spark.createDataFrame([(4, 0, 0), (5, 1, 0), (9, 1, None), (10, None, 1), (None, 1, 1), (5, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    ids, ranks = PT.path("word_bpe_49k.json"), PT.path("byte_bpe_multi_50k.tiktoken")
    return {
        "language_id": lambda d: language_id.language_id(d),
        "jaccard": lambda d: jaccard_join.jaccard_components(d),
        "lm": lambda d: lm_scoring.lm_scores(d, ids, end_id=49407),
        "fingerprints": lambda d: fingerprint.fingerprints(d),
        "quality": lambda d: quality_knn.quality(d, labels),
        "substring": lambda d: substring_dedup.substring_dedup(d),
        "bpe": lambda d: byte_bpe.bpe_decode(byte_bpe.bpe_encode(d, ranks, PT.PATTERN), ranks),
        "packing": lambda d: packing.pack(d, ids),
        "rules": lambda d: quality_rules.quality_rules(d),
    }


NAMES = ["language_id", "jaccard", "lm", "fingerprints", "quality", "substring", "bpe", "packing", "rules"]


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, none, name):
    assert _ops(spark)[name](none).collect() == []


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(spark, odd, name):
    got = _ops(spark)[name](odd).collect()
    if name != "packing":
        assert sorted(map(str, (r.doc_id for r in got))) == sorted(str(d) for d, _ in ROWS)
    by = {r.doc_id: r for r in got}
    if name == "language_id":
        assert all(by[i].lang_pred == "und" and by[i].score == 0.0 for i in (1, 2, 3))
    elif name == "jaccard":
        want = brute.jaccard_components([(d, t) for d, t in ROWS if d is not None])
        assert {d: (r.n_shingles, r.component_id) for d, r in by.items() if d is not None} == want
        assert by[None].component_id is None
    elif name == "lm":
        assert all(by[i].n_tokens == 1 for i in (1, 2, 3)) and by[6].n_tokens == 60_001
    elif name == "fingerprints":
        assert by[1].fingerprint == by[2].fingerprint and by[9].fingerprint == by[10].fingerprint
    elif name == "quality":
        assert all(0 <= r.score <= 1 for r in got) and by[1].score == by[2].score
    elif name == "substring":
        want = brute.substring_dedup([(d, t) for d, t in ROWS if d is not None])
        assert {d: (r.n_words, r.n_removed, r.kept) for d, r in by.items() if d is not None} == want
        assert by[None].n_removed == 0
    elif name == "bpe":
        assert all(bytes(by[d].decoded).decode() == (t or "") for d, t in ROWS)
    elif name == "packing":
        assert len([r for r in got if r.doc_id == 7]) == 2
        assert all(r.doc_tokens == 1 for r in got if r.doc_id in (1, 2, 3))
    elif name == "rules":
        assert all(by[d].base_failed == brute.quality_base(t)[-1] for d, t in ROWS)


def test_odd_pages(spark):
    from revsift.llm.html_extract import extract_main_text
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<"), (4, None, "<p>" * 50 + "unclosed"), (5, "u", "</div></p>x<!-- never"),
            (6, "u", "<script>if (a < b) {"), (None, "u", "<body><p>text &amp; more &am text here</body>"), (7, "u", "plain"), (7, "u", "plain"),
            (8, "u", "<article>" + "<p>a long paragraph of an article, with commas.</p>" * 3000 + "</article>"),
            (9, "u", "<div>" * 3000 + "deep" + "</div>" * 3000)]
    df = spark.createDataFrame([(*r, 5, "z") for r in rows], "page_id long, url string, html string, text int, n_chars string")
    got = extract_main_text(df).collect()
    assert sorted(map(str, (r.page_id for r in got))) == sorted(str(r[0]) for r in rows)
    by = {r.page_id: r for r in got}
    assert by[1].text == by[2].text == "" and by[6].text == ""
    assert by[8].text.count("a long paragraph") == 3000
    assert all(r.n_chars == len(r.text) for r in got)
    assert extract_main_text(df.where("1 = 0")).collect() == []


def test_pages_with_embedded_elements(spark):
    from revsift.llm.html_extract import Page, extract_main_text
    tags = ("math", "object", "canvas", "noscript", "svg", "select")
    inner = {"math": "<mi>x</mi><mo>=</mo><mn>42</mn>", "svg": "<text>x = 42</text>", "select": "<option>x = 42"}
    body = "<p>a long paragraph of an article, with commas, that goes on for a while.</p>"
    rows = []
    for i, tag in enumerate(tags):
        here = f"<p>before it, <{tag}>{inner.get(tag, 'x = 42')}"
        rows.append((2 * i, f"<article>{body * 5}{here}</{tag}> after it.</p>{body * 5}</article>"))
        rows.append((2 * i + 1, f"<article>{body * 5}{here} </p>{body * 5}<p>the last words.</p></article>"))
        for _, page in rows[-2:]:  # elements with a parent, and features and a decision of their own
            assert tag in Page(page).tags
    got = {r.page_id: r.text for r in extract_main_text(spark.createDataFrame(
        [(i, "u", h) for i, h in rows], "page_id long, url string, html string")).collect()}
    for i, tag in enumerate(tags):
        closed, unclosed = got[2 * i], got[2 * i + 1]
        assert closed.count("a long paragraph") == 10 and "before it," in closed and "after it." in closed
        assert unclosed.count("a long paragraph") == 10 and unclosed.endswith("the last words.")
        if tag != "select":  # a form control: the trees decide
            assert "42" in closed


def test_unclosed_quotes_in_tags(spark):
    from revsift.llm.html_extract import extract_main_text
    body = "<p>a long paragraph of an article, with commas, that goes on for a while.</p>"
    page = f"<article>{body * 5}<p>before <a href='#x>link</a> after.</p>{body * 5}</article>"
    got = extract_main_text(spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")).first().text
    assert "href" not in got and "<" not in got and got.count("a long paragraph") == 10 and "before link after." in got


SCRIPT = """
import sys
sys.path.insert(0, {repo!r})   # the driver's path only: workers get the code with their functions
import public_tokenizers as PT
from revsift.session import get_session
from revsift.llm import html_extract, lm_scoring, merkle, toxicity, whitening
spark = get_session("local[2]", shuffle_partitions=2, extra={{"spark.ui.showConsoleProgress": "false"}})
docs = spark.createDataFrame([(i, "some words of text number %d" % i, "en", "s", 3) for i in range(30)],
                             "doc_id long, text string, lang string, source string, n_chars long")
pages = spark.createDataFrame([(i, "u", "<article><p>a paragraph of some length, with a comma.</p></article>") for i in range(9)],
                              "page_id long, url string, html string")
vectors = spark.createDataFrame([(i, [float(i), 1.0, float(i % 3)]) for i in range(9)], "vec_id long, embedding array<double>")
labels = docs.selectExpr("doc_id", "1 quality", "cast(doc_id % 2 as int) toxic")
assert html_extract.extract_main_text(pages).count() == 9
assert len(lm_scoring.lm_scores(docs, PT.path("word_bpe_49k.json"), end_id=49407).collect()) == 30
assert len(toxicity.toxicity(docs, labels).collect()) == len(merkle.merkle_manifest(docs).collect()) == 30
assert len(whitening.whiten(vectors).collect()) == 27
print("all ran")
"""


def test_workers_without_the_package(tmp_path):
    """Everything that tasks need travels with them: the package lies on the driver's path alone."""
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    (tmp_path / "run.py").write_text(SCRIPT.format(repo=repo))
    done = subprocess.run([sys.executable, "run.py"], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "all ran" in done.stdout, done.stderr[-3000:]


def test_near_copies_of_repeated_ids(spark):
    """A text that only shares its id with a copy stays; of a group one row stays, whatever ids repeat in it."""
    import corpus_pipeline as P
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    near = a + " one more"
    rows = [(1, a), (5, a), (5, b), (5, b), (6, near), (7, ""), (7, c), (7, None), (8, c), (8, near), (9, c + " "), (None, a), (None, a)]
    df = spark.createDataFrame([(i, t, "en", "s", 1, "extra") for i, t in rows],
                               "doc_id long, text string, lang string, source string, n_chars long, group_id string").repartition(3)
    got = sorted((str(r.doc_id), str(r.text)) for r in P.ngram_jaccard_join(spark, df, "").collect())
    assert got == sorted([("1", a), ("5", b), ("7", ""), ("7", "None"), ("7", c), ("None", a), ("None", a)])


def test_pipeline_on_odd_rows(spark, odd, tmp_path):
    import corpus_pipeline as P
    docs = odd.withColumn("n_chars", odd.doc_id)
    spark.createDataFrame([(4, 0, 0), (5, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    for _, stage in P.STAGES:
        assert stage(spark, docs.where("1 = 0"), str(tmp_path)).collect() == []
        stage(spark, docs, str(tmp_path)).collect()
