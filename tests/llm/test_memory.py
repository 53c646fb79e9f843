"""Memory of the functions that run inside Python workers: bounded by a text, not by a batch of them."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from revsift.llm import common as C  # noqa: E402
from revsift.llm.packing import _cut  # noqa: E402

TEXT = b"one two three four five six seven eight nine ten " * 400


def peak(run) -> int:
    tracemalloc.start()
    run()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most


def test_word_hashes_split_one_text_at_a_time():
    texts = [TEXT, None, b"", b" \t"] + [TEXT] * 196
    out = C.word_hashes(texts[:4], C.WordHash(), lower=True)
    assert [len(h) for h in out] == [4000, 0, 0, 0] and all(h.dtype == np.uint64 for h in out)
    assert np.array_equal(out[0], np.tile(out[0][:10], 400))
    # the hashes are 1.6 x the texts; the words of all texts at once would be eight times as much
    assert peak(lambda: C.word_hashes(texts, C.WordHash(), lower=False)) < 3 * sum(len(t or b"") for t in texts)


def test_packing_splits_one_text_at_a_time():
    texts = [TEXT, None, b""] + [TEXT] * 197
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.binary())], names=["doc_id", "text"])
    out = []
    most = peak(lambda: out.extend(_cut(public_tokenizers.path("word_bpe_49k.json"), 2, 4096)([batch])))
    tokens = dict(zip(out[0].column("doc_id").to_pylist(), out[0].column("doc_tokens").to_pylist()))
    assert tokens[0] == 4001 and tokens[1] == tokens[2] == 1 and tokens[199] == 4001
    # what the tokenizer takes is the same for any batch
    few = peak(lambda: list(_cut(public_tokenizers.path("word_bpe_49k.json"), 2, 4096)([batch.slice(0, 3)])))
    assert most - few < 2 * batch.nbytes


def test_quality_holds_the_vectors_of_few_rows():
    from types import SimpleNamespace

    from revsift.llm import char_features as CF
    from revsift.llm import quality_knn as QK
    rng = np.random.default_rng(3)
    texts = [None, ""] + [" ".join(rng.choice(["alpha", "Beta", "42", "x!"], 12)) for _ in range(998)]
    feats = CF.CharNgrams(QK.BITS, QK.NGRAM, fold=False)
    model = {"idf": np.ones(1 << QK.BITS, np.float32), "basis": rng.standard_normal((1 << QK.BITS, 8)).astype(np.float32),
             "y": rng.integers(0, 2, 50).astype(np.float32), "prior": 0.5}
    x = lambda some: np.array([CF.weighted(feats.counts(t), model["idf"]) for t in some], np.float32)
    model["vectors"] = QK.place(x(texts[:50]), texts[:50], model["basis"])
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])
    out = []
    run = QK._score(SimpleNamespace(value=model), feats, [])
    most = peak(lambda: out.extend(run([batch])))
    assert np.allclose(out[0].column("score").to_numpy(), QK.vote(QK.place(x(texts), texts, model["basis"]), model), atol=1e-5)
    assert most < 1000 * (4 << QK.BITS) / 2   # all rows' vectors would be 16 MB, and twice that while they are put together
