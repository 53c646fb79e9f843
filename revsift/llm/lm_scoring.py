"""Language-model scoring: a causal self-attention model over subword ids, trained in numpy, beside a unigram base.

Subword ids come from a given tokenizer.  The probability of the next id has three factors: whether its word goes on or
another one begins (or the text ends), given the id before; its *class*, which attention predicts from the ids before
(rare ones by group); and its share of the class, given the id before it in its word, or that it begins one.  The first
and the last come from counts over all training texts; the end of a text is one of the ids that begin a word.  Over all
next ids and both cases the probabilities sum to one.  Classes hold about equal mass, so frequent ids stand alone.  A
text is scored in windows that overlap: every id is scored once, with at least ``OVERLAP`` ids before it (fewer at the
start of the text), by batched masked attention.

Counts (words, ids, pairs, the class after each kind) cover every training text.  The attention weights start from a
small sample and are then fitted on every window of every training text: texts are dealt by a hash into parts of about
``PART_IDS`` ids, each part takes Adam steps through its windows, and the parts' weights are averaged by their ids."""

from __future__ import annotations

import copy
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revsift.llm import common as C
from revsift.llm.word_ids import WordIds
from revsift.session import cut_lineage

CLASSES, DIM, WINDOW, OVERLAP = 32, 8, 16, 4
#: Kinds of id that attention reads: all but the last RARE_TYPES are single frequent ids.
TYPES, RARE_TYPES = 2048, 64
#: Most frequent pairs of ids inside words whose counts are broadcast; the counts of all others meet their texts in a join.
FREQUENT_PAIRS = 400_000
#: Texts and steps of the starting weights; the fit goes on from them through all training texts.
MAX_FIT_TEXTS, STEPS, BATCH = 400, 500, 128
#: Ids of a part of the training texts, windows per step, first rate and ids read at a time in the fit on all texts.
PART_IDS, PART_BATCH, PART_RATE, PART_READ = 2_000_000, 256, 0.004, 200_000
#: Most frequent words whose counts are broadcast; the counts of all others meet their texts in a join.
FREQUENT_WORDS = 120_000
#: Distinct words a task counts before it hands its counts on, and words it remembers while scoring.
COUNT_WORDS, CACHE_WORDS = 400_000, 350_000
#: Hash that stands for the end of a text (no word has it but by a 2**-64 chance).
END = -1
MODULUS = 5
#: Stands for the id before a word's first one.
START = 1 << 24


def word_keys(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(C.xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)


def _flat_ids(words: list[bytes], ids_of: WordIds) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids of all words, the id before each in its word or START, ids per word)."""
    raw = list(map(ids_of.ids, words))
    size = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
    flat = np.frombuffer(b"".join(raw), "<u4").astype(np.int64)
    before = np.append(START, flat[:-1])[:len(flat)]
    before[(np.cumsum(size) - size)[size > 0]] = START
    return flat, before, size


def _count_words(batches):
    """Per task (word, count) of its training texts; the null word counts the texts' ends."""
    words, texts = Counter(), 0

    def out():
        return pa.RecordBatch.from_arrays([pa.array([*words, None], pa.binary()), pa.array([*words.values(), texts], pa.int64())],
                                          names=["word", "n"])
    for _, batch in C.text_batches(batches):
        words.update(chain.from_iterable((t or b"").lower().split() for t in batch))
        texts += len(batch)
        if len(words) > COUNT_WORDS:
            yield out()
            words, texts = Counter(), 0
    yield out()


def _count_ids(path: str, end_id: int):
    """From (word, count) of distinct words: (0, word hash, count), (1, subword id, count), (2, pair in a word, count)."""
    def run(batches):
        ids_of = WordIds(path)
        ids, pairs = np.zeros(0, np.int64), {}
        for b in batches:
            names, n = b.column("word").to_pylist(), b.column("n").to_numpy()
            real = np.array([w is not None for w in names], bool)
            key = np.full(len(names), END, np.int64)
            names = [w for w in names if w is not None]
            key[real] = word_keys(names)
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(n), np.int32)), pa.array(key), b.column("n")],
                                             names=["kind", "key", "n"])
            flat, before, size = _flat_ids(names, ids_of)
            each = np.repeat(n[real], size)
            if not real.all():   # the end of a text begins where a word could
                flat, before, each = np.append(flat, end_id), np.append(before, START), np.append(each, n[~real].sum())
            c = np.bincount(flat, each).astype(np.int64)
            ids = np.pad(ids, (0, max(0, len(c) - len(ids))))
            ids[:len(c)] += c
            pair, at = np.unique((before << 32) | flat, return_inverse=True)
            for k, v in zip(pair.tolist(), np.bincount(at, each, len(pair)).astype(np.int64).tolist()):
                pairs[k] = pairs.get(k, 0) + v
            if len(pairs) > COUNT_WORDS:
                yield _pair_rows(pairs)
                pairs = {}
        some = np.flatnonzero(ids)
        yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(some), np.int32)), pa.array(some), pa.array(ids[some])],
                                         names=["kind", "key", "n"])
        yield _pair_rows(pairs)
    return run


def _pair_rows(pairs: dict[int, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), 2, np.int32)), pa.array(list(pairs), pa.int64()),
                                       pa.array(list(pairs.values()), pa.int64())], names=["kind", "key", "n"])


# ---------------------------------------------------------------- the model
def classes_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class of each id, log10 share of its class): ids in order of frequency, cut into classes of about equal mass."""
    c = counts + 0.5
    order = np.argsort(-c, kind="stable")
    mass = np.cumsum(c[order]) - c[order]
    cls = np.empty(len(c), np.int64)
    cls[order] = np.minimum(CLASSES - 1, (mass / c.sum() * CLASSES).astype(np.int64))
    total = np.bincount(cls, c, CLASSES)
    return cls.astype(np.uint8), np.log10(c / total[cls])


def types_of(counts: np.ndarray) -> np.ndarray:
    """Kind of each id as attention reads it: frequent ids alone, the others in groups of about equal mass."""
    order = np.argsort(-counts, kind="stable")
    single = TYPES - RARE_TYPES
    kind = np.empty(len(counts), np.int64)
    kind[order[:single]] = np.arange(min(single, len(order)))
    rare = counts[order[single:]] + 0.5
    if len(rare):
        kind[order[single:]] = single + np.minimum(
            RARE_TYPES - 1, ((np.cumsum(rare) - rare) / rare.sum() * RARE_TYPES).astype(np.int64))
    return kind.astype(np.uint16)


class PairShares:
    """log10 of an id's share of its class, given the id before it in its word: pair counts, smoothed by the share
    over all texts with as much weight as the context has different followers in that class.

    ``contexts``: (context, total, followers) over all pairs where ``keys`` are only the most frequent ones.  A pair
    outside ``keys`` then scores as never seen, and :meth:`bonus` of its count makes that whole."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, cls: np.ndarray, log_share: np.ndarray, contexts=None):
        order = np.argsort(keys)
        self.keys, self.n = np.append(keys[order], np.int64(1 << 62)), np.append(n[order].astype(np.float64), 0.0)
        self.cls, self.share = cls, 10.0 ** log_share
        context, at, kinds = np.unique(contexts_of(keys, cls), return_inverse=True, return_counts=True)
        total = held = np.bincount(at, n, len(context))
        if contexts is not None:
            order = np.argsort(contexts[0])
            every, total, kinds = (np.asarray(c)[order] for c in contexts)
            held = np.zeros(len(every))
            held[np.searchsorted(every, context)] = np.bincount(at, n, len(context))
            context = every
        self.context, self.kinds = np.append(context, np.int64(1 << 62)), np.append(kinds, 0)
        self.total, self.open = np.append(total.astype(np.float64), 0.0), np.append(total > held, False)

    def _context(self, ids: np.ndarray, before: np.ndarray):
        """(place, known, weight of the share over all texts) of each pair's context."""
        context = (before << 8) | self.cls[ids]
        at = np.searchsorted(self.context, context)
        known = self.context[at] == context
        return at, known, np.where(known, self.kinds[at], 0) + 0.5

    def log10(self, ids: np.ndarray, before: np.ndarray) -> np.ndarray:
        key = (before << 32) | ids
        at = np.searchsorted(self.keys, key)
        n = np.where(self.keys[at] == key, self.n[at], 0.0)
        at, known, extra = self._context(ids, before)
        return np.log10((n + extra * self.share[ids]) / (np.where(known, self.total[at], 0.0) + extra))

    def outside(self, ids: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Whether a pair may have a count outside ``keys``: it is not in them, and its context has such pairs."""
        key = (before << 32) | ids
        at, known, _ = self._context(ids, before)
        return known & self.open[at] & (self.keys[np.searchsorted(self.keys, key)] != key)

    def bonus(self, keys: np.ndarray, n: np.ndarray) -> np.ndarray:
        """What the count of a pair outside ``keys`` adds to :meth:`log10`."""
        ids, before = keys & 0xFFFFFFFF, keys >> 32
        return np.log10(1 + n / (self._context(ids, before)[2] * self.share[ids]))


def boundaries(per_id: np.ndarray, context: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log10 that a word goes on after each id, log10 that it ends there): how often ids were followed inside a word,
    from the totals ``n`` of the contexts (id before, class), out of how often they were met."""
    before = context >> 8
    known = before < len(per_id)
    inside = np.bincount(before[known], n[known], len(per_id))
    goes_on = (inside + 0.5) / (per_id + 1.0)
    return np.log10(goes_on), np.log10(1.0 - goes_on)


def frequent(counts: DataFrame, most: int) -> int:
    """The least count such that at most ``most`` rows have it or more.  The driver reads how many rows there are of
    each count, from the top, until they are too many: no row of the table itself."""
    least, rows = 1 << 62, 0
    for r in counts.groupBy("n").agg(F.count("*").alias("rows")).orderBy(F.desc("n")).toLocalIterator():
        rows += r["rows"]
        if rows > most:
            break
        least = r["n"]
    return least


def contexts_of(keys: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """(id before, class) of pairs as one number."""
    return ((keys >> 32) << 8) | cls[keys & 0xFFFFFFFF]


def _count_contexts(cls: np.ndarray):
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(contexts_of(b.column("key").to_numpy(), cls)), b.column("n")],
                                             names=["context", "n"])
    return run


def _pair_bonus(shared):
    def run(batches):
        shares = shared.value["shares"]
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), pa.array(shares.bonus(b.column("key").to_numpy(), b.column("n").to_numpy()))],
                names=["key", "bonus"])
    return run


def _mask() -> np.ndarray:
    return np.triu(np.full((WINDOW, WINDOW), -1e9, np.float32), 1)


class Attention:
    """One layer of causal self-attention with a residual path and a learned bias per kind of the id before."""

    NAMES = ("emb", "pos", "wq", "wk", "wv", "wo", "wu", "last")

    def __init__(self, seed: int = 13):
        rng = np.random.default_rng(seed)
        r = lambda *s: (rng.standard_normal(s) * 0.2).astype(np.float32)
        self.emb, self.pos = r(TYPES + 1, DIM), r(WINDOW, DIM)   # kind TYPES is the start of a text
        self.wq, self.wk, self.wv, self.wo, self.wu = r(DIM, DIM), r(DIM, DIM), r(DIM, DIM), r(DIM, DIM), r(DIM, CLASSES)
        self.last = np.zeros((TYPES + 1, CLASSES), np.float32)
        self.mask = _mask()

    def forward(self, x: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Log-probabilities (windows, WINDOW, CLASSES) of the next class at every position."""
        e = self.emb[x] + self.pos
        q, k, v = e @ (self.wq / np.float32(np.sqrt(DIM))), e @ self.wk, e @ self.wv
        a = np.matmul(q, k.transpose(0, 2, 1))
        a += self.mask
        a -= a.max(axis=2, keepdims=True)
        np.exp(a, out=a)
        a /= a.sum(axis=2, keepdims=True)
        m = np.matmul(a, v)
        h = e + m @ self.wo
        z = h @ self.wu
        z += self.last[x]
        top = z.max(axis=2, keepdims=True)
        z -= top
        z -= np.log(np.exp(z).sum(axis=2, keepdims=True))
        if keep is not None:
            keep.update(e=e, q=q, k=k, v=v, a=a, m=m, h=h)
        return z

    def target_log(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Natural log-probability of the given classes: :meth:`forward` at ``y`` alone, with the products that only
        depend on the kind or the position taken once."""
        if not hasattr(self, "tables"):
            qkv = np.concatenate((self.wq / np.float32(np.sqrt(DIM)), self.wk, self.wv), axis=1)
            self.tables = (self.emb @ qkv, self.pos @ qkv, self.emb @ self.wu + self.last, self.pos @ self.wu, self.wo @ self.wu)
        emb_qkv, pos_qkv, emb_u, pos_u, out_u = self.tables
        e = emb_qkv[x]
        e += pos_qkv
        a = np.matmul(e[..., :DIM], e[..., DIM:2 * DIM].transpose(0, 2, 1))
        a += self.mask
        a -= a.max(axis=2, keepdims=True)
        np.exp(a, out=a)
        m = np.matmul(a, e[..., 2 * DIM:])
        m /= a.sum(axis=2, keepdims=True)
        z = m @ out_u
        z += emb_u[x]
        z += pos_u
        z -= z.max(axis=2, keepdims=True)
        picked = np.take_along_axis(z, y[..., None], 2)[..., 0]
        np.exp(z, out=z)
        return picked - np.log(z.sum(axis=2))

    def gradients(self, x, y, weight):
        s: dict = {}
        z = self.forward(x, s)
        d = np.exp(z)
        rows = np.arange(x.size)
        flat = d.reshape(-1, CLASSES)
        flat[rows, y.ravel()] -= 1
        d *= (weight / max(1.0, weight.sum()))[..., None]
        f = lambda t: t.reshape(-1, t.shape[-1])
        g = {"wu": f(s["h"]).T @ f(d), "last": np.zeros_like(self.last)}
        dh = d @ self.wu.T
        dm = dh @ self.wo.T
        g["wo"] = f(s["m"]).T @ f(dh)
        da = np.matmul(dm, s["v"].transpose(0, 2, 1))
        dv = np.matmul(s["a"].transpose(0, 2, 1), dm)
        ds = s["a"] * (da - (da * s["a"]).sum(axis=2, keepdims=True))
        dq, dk = np.matmul(ds, s["k"]), np.matmul(ds.transpose(0, 2, 1), s["q"])
        scale = np.float32(1 / np.sqrt(DIM))
        g["wq"], g["wk"], g["wv"] = f(s["e"]).T @ f(dq) * scale, f(s["e"]).T @ f(dk), f(s["e"]).T @ f(dv)
        de = dh + dq @ self.wq.T * scale + dk @ self.wk.T + dv @ self.wv.T
        g["pos"], g["emb"] = de.sum(axis=0), np.zeros_like(self.emb)
        order = np.argsort(x.ravel(), kind="stable")
        kind, first = np.unique(x.ravel()[order], return_index=True)
        g["last"][kind] = np.add.reduceat(f(d)[order], first, axis=0)
        g["emb"][kind] = np.add.reduceat(f(de)[order], first, axis=0)
        loss = -(np.take_along_axis(z, y[..., None], 2)[..., 0] * weight).sum() / max(1.0, weight.sum())
        return float(loss), g

    def fit(self, texts: list[tuple[np.ndarray, np.ndarray]], seed: int = 17, pairs: np.ndarray | None = None) -> "Attention":
        """texts: (kinds, classes) of their ids.  Adam on random batches of windows; starts from smoothed counts of
        (kind before, class): ``pairs``, or those of the texts."""
        x, y, weight = _batch(texts)
        if not len(x):
            return self
        if pairs is None:
            pairs = np.zeros((TYPES + 1, CLASSES))
            np.add.at(pairs, (x[weight > 0], y[weight > 0]), 1)
        any_ = (pairs.sum(axis=0) + 0.5) / (pairs.sum() + 0.5 * CLASSES)
        pairs = pairs + 4 * any_
        self.last = np.log(pairs / pairs.sum(axis=1, keepdims=True)).astype(np.float32)
        self.wu *= 0.1
        rng = np.random.default_rng(seed)
        self.start()
        for t in range(1, STEPS + 1):
            at = rng.integers(len(x), size=BATCH)
            self.step(x[at], y[at], weight[at], 0.02 * (1 - t / (STEPS + 1)))
        return self

    def start(self):
        self.t = 0
        self.m = {k: np.zeros_like(getattr(self, k)) for k in self.NAMES}
        self.v = {k: np.zeros_like(getattr(self, k)) for k in self.NAMES}

    def step(self, x, y, weight, rate: float):
        """One step of Adam."""
        _, g = self.gradients(x, y, weight)
        self.t += 1
        m, v, rate, spread = self.m, self.v, np.float32(rate / (1 - 0.9 ** self.t)), np.float32(1 / (1 - 0.99 ** self.t))
        for k in self.NAMES:
            m[k] += np.float32(0.1) * (g[k] - m[k])
            v[k] += np.float32(0.01) * (g[k] * g[k] - v[k])
            setattr(self, k, getattr(self, k) - rate * m[k] / (np.sqrt(v[k] * spread) + np.float32(1e-8)))

    def weights(self) -> np.ndarray:
        return np.concatenate([getattr(self, k).ravel() for k in self.NAMES]).astype(np.float64)

    def put(self, weights: np.ndarray) -> "Attention":
        """A model of these weights, without what only the fit needs."""
        out, at = Attention(), 0
        for k in self.NAMES:
            old = getattr(self, k)
            setattr(out, k, weights[at:at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size
        return out


def _windows(kinds: np.ndarray, classes: np.ndarray, sizes: np.ndarray):
    """Windows of texts that lie one after the other: (kind before, class, 1.0 where this window is the one that
    scores it, text)."""
    first = np.cumsum(sizes) - sizes
    before = np.empty(len(kinds), np.int32)
    before[1:] = kinds[:-1]
    before[first] = TYPES
    count = np.maximum(1, -(-(sizes - OVERLAP) // (WINDOW - OVERLAP)))
    owner = np.repeat(np.arange(len(sizes)), count)
    inside = (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) * (WINDOW - OVERLAP)
    at = inside[:, None] + np.arange(WINDOW)
    weight = at < sizes[owner][:, None]
    weight &= (inside == 0)[:, None] | (np.arange(WINDOW) >= OVERLAP)
    at += first[owner][:, None]
    np.minimum(at, len(classes) - 1, out=at)
    return before[at], classes[at], weight.astype(np.float32), owner


def _batch(texts: list[tuple[np.ndarray, np.ndarray]]):
    """The windows of (kinds, classes) of several texts, without their owners."""
    if not texts:
        e = np.zeros((0, WINDOW), np.int64)
        return e, e, e.astype(np.float32)
    sizes = np.array([len(c) for _, c in texts], np.int64)
    return _windows(np.concatenate([k for k, _ in texts]), np.concatenate([c for _, c in texts]).astype(np.int64), sizes)[:3]


def flat_log10(model: Attention, kinds: np.ndarray, classes: np.ndarray, sizes: np.ndarray, most: int = 200_000,
               block: int = 2048) -> np.ndarray:
    """log10 probability of each text's class sequence; every position is scored by exactly one window.  Texts are
    taken in groups of about ``most`` ids, windows in blocks."""
    out = np.zeros(len(sizes))
    ends = np.cumsum(sizes)
    a = 0
    while a < len(sizes):
        start = ends[a] - sizes[a]
        b = max(a + 1, int(np.searchsorted(ends, start + most)))
        part = slice(int(start), int(ends[b - 1]))
        x, y, weight, owner = _windows(kinds[part], classes[part].astype(np.int64), sizes[a:b])
        got = np.empty(len(x))
        for i in range(0, len(x), block):
            z = model.target_log(x[i:i + block], y[i:i + block])
            got[i:i + block] = (z * weight[i:i + block]).sum(axis=1, dtype=np.float64)
        out[a:b] = np.bincount(owner, got, b - a) / np.log(10)
        a = b
    return out


def class_log10(model: Attention, texts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """:func:`flat_log10` of texts given as (kinds, classes)."""
    return flat_log10(model, np.concatenate([k for k, _ in texts]), np.concatenate([c for _, c in texts]),
                      np.array([len(c) for _, c in texts], np.int64))


# ---------------------------------------------------------------- the fit on all training texts
def _encode(path: str, kinds: np.ndarray, cls: np.ndarray, end_id: int):
    """(h, text) -> (h, kinds, classes) of the text's ids and its end."""
    def run(batches):
        ids_of, end = WordIds(path), end_id.to_bytes(4, "little")
        for b, texts in C.text_batches(batches):
            raw = [b"".join(map(ids_of.__getitem__, (t or b"").lower().split())) + end for t in texts]
            edge = np.concatenate(([0], np.cumsum([len(r) // 4 for r in raw])))
            ids = np.frombuffer(b"".join(raw), "<u4")
            cols = [pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer((edge * a.itemsize).astype(np.int32)),
                                                                  pa.py_buffer(a)]) for a in (kinds[ids], cls[ids])]
            yield pa.RecordBatch.from_arrays([b.column("h"), *cols], names=["h", "kinds", "classes"])
    return run


def _encoded(batches):
    """(kinds, classes, sizes) of about PART_READ ids of whole texts at a time."""
    kinds, classes, n = [], [], 0

    def out():
        return (np.frombuffer(b"".join(kinds), np.uint16), np.frombuffer(b"".join(classes), np.uint8),
                np.fromiter(map(len, classes), np.int64, len(classes)))
    for b in batches:
        for k, c in zip(b.column("kinds").to_pylist(), b.column("classes").to_pylist()):
            kinds.append(k)
            classes.append(c)
            n += len(c)
            if n >= PART_READ:
                yield out()
                kinds, classes, n = [], [], 0
    if n:
        yield out()


def _count_classes(batches):
    """(kind before * CLASSES + class, count) of a part."""
    size = (TYPES + 1) * CLASSES
    total = np.zeros(size, np.int64)
    for kinds, classes, sizes in _encoded(batches):
        before = np.empty(len(kinds), np.int64)
        before[1:] = kinds[:-1]
        before[np.cumsum(sizes) - sizes] = TYPES
        total += np.bincount(before * CLASSES + classes, minlength=size)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["key", "n"])


def _fit_part(shared, slots: int):
    """(slot, ids, weights times ids) after a part's windows, each taken once."""
    def run(batches):
        model, seen = copy.deepcopy(shared.value), 0
        rng, t, most = np.random.default_rng(19), 0, PART_IDS / (WINDOW - OVERLAP) / PART_BATCH
        for kinds, classes, sizes in _encoded(batches):
            x, y, weight, _ = _windows(kinds, classes.astype(np.int64), sizes)
            for at in np.array_split(rng.permutation(len(x)), -(-len(x) // PART_BATCH)):
                model.step(x[at], y[at], weight[at], PART_RATE * max(0.05, 1 - t / most))
                t += 1
            seen += len(classes)
        if seen:
            yield _weights_row(TaskContext.get().partitionId() % slots, seen, model.weights() * seen)
    return run


def _weights_row(slot: int, n: int, weights: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([n], pa.int64()),
                                       pa.array([weights.tobytes()], pa.binary())], names=["slot", "n", "weights"])


def _sum_weights(batches):
    n, total = 0, 0.0
    for b in batches:
        for m, w in zip(b.column("n").to_pylist(), b.column("weights").to_pylist()):
            n, total = n + m, total + np.frombuffer(w)
    if n:
        yield _weights_row(0, n, total)


def fit_all(train: DataFrame, path: str, kinds: np.ndarray, cls: np.ndarray, n_ids: int, end_id: int) -> Attention:
    """The model of all rows (doc_id, text) of ``train``, which have ``n_ids`` ids.  Which part a text is in, and its
    place there, follow from its hash: the partitions of the table don't matter."""
    spark = train.sparkSession
    parts = max(1, -(-n_ids // PART_IDS))
    encoded = cut_lineage(train.select(F.xxhash64("doc_id", "text").alias("h"), "text")
                          .mapInArrow(_encode(path, kinds, cls, end_id), "h long, kinds binary, classes binary")
                          .repartition(parts, "h").sortWithinPartitions("h", "kinds", "classes"))
    # at most (TYPES + 1) * CLASSES rows
    got = encoded.mapInArrow(_count_classes, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toPandas()
    pairs = np.zeros((TYPES + 1) * CLASSES)
    pairs[got["key"].to_numpy(np.int64)] = got["n"].to_numpy(np.float64)
    least = encoded.select("h").orderBy("h").limit(MAX_FIT_TEXTS).agg(F.max("h")).first()[0]
    first = [] if least is None else encoded.where(F.col("h") <= least).limit(MAX_FIT_TEXTS).collect()
    first = sorted(first, key=lambda r: (r["h"], r["kinds"], r["classes"]))
    model = Attention().fit([(np.frombuffer(r["kinds"], np.uint16), np.frombuffer(r["classes"], np.uint8)) for r in first],
                            pairs=pairs.reshape(TYPES + 1, CLASSES))
    if not first:
        return model
    slots = int(np.ceil(np.sqrt(parts)))
    row = "slot int, n long, weights binary"
    rows = (encoded.mapInArrow(_fit_part(C.Shared(spark, model), slots), row)
            .repartition(slots, "slot").mapInArrow(_sum_weights, row).collect())
    return model.put(sum(np.frombuffer(r["weights"]) for r in rows) / sum(r["n"] for r in rows))


class _Words:
    """What scoring needs of each word, in arrays by the word's number; number 0 is the end of a text."""

    def __init__(self, s: dict, ids_of: WordIds):
        self.s, self.ids_of, self.number = s, ids_of, {}
        one = np.array([s["end_id"]])
        self.kinds, self.classes = s["kinds"][one], s["class"][one]
        self.start, self.length = np.zeros(1, np.int64), np.ones(1, np.int64)
        begins = np.array([START])
        self.inside, self.base = s["shares"].log10(one, begins), np.array([s["end_base"]])
        self.rare, self.key = np.zeros(1, bool), np.zeros(1, np.int64)
        self.pairs = ((begins << 32) | one)[s["shares"].outside(one, begins)] if s["more_pairs"] else np.zeros(0, np.int64)
        self.pair_start, self.n_pairs = np.zeros(1, np.int64), np.array([len(self.pairs)])

    def add(self, fresh: list[bytes]):
        s = self.s
        key = word_keys(fresh)
        at = np.minimum(np.searchsorted(s["keys"], key), max(0, len(s["keys"]) - 1))
        known = s["keys"][at] == key if len(s["keys"]) else np.zeros(len(fresh), bool)
        ids, before, size = _flat_ids(fresh, self.ids_of)
        edge = np.concatenate(([0], np.cumsum(size)))
        last = np.zeros(len(ids), bool)
        last[edge[1:][size > 0] - 1] = True
        goes_on, ends = s["boundaries"]
        total = np.concatenate(([0.0], np.cumsum(s["shares"].log10(ids, before) + np.where(last, ends[ids], goes_on[ids]))))
        base = np.where(known, s["log10"][at], 0.0) if len(s["keys"]) else np.zeros(len(fresh))
        self.number.update(zip(fresh, range(len(self.start), len(self.start) + len(fresh))))
        outside = s["shares"].outside(ids, before) if s["more_pairs"] else np.zeros(len(ids), bool)
        odd = np.concatenate(([0], np.cumsum(outside)))[edge]
        for name, new in (("start", edge[:-1] + len(self.kinds)), ("length", size), ("inside", total[edge[1:]] - total[edge[:-1]]),
                          ("base", base), ("rare", ~known), ("key", key), ("kinds", s["kinds"][ids]), ("classes", s["class"][ids]),
                          ("pair_start", odd[:-1] + len(self.pairs)), ("n_pairs", np.diff(odd)),
                          ("pairs", ((before << 32) | ids)[outside])):
            setattr(self, name, np.concatenate((getattr(self, name), new)))


def _score(path: str, shared):
    def run(batches):
        s, ids_of = shared.value, WordIds(path)
        words = _Words(s, ids_of)
        for b, texts in C.text_batches(batches):
            split = [(t or b"").lower().split() for t in texts]
            if len(words.number) > CACHE_WORDS:
                words = _Words(s, ids_of)
            words.add(list(set(chain.from_iterable(split)).difference(words.number)))
            sizes = np.fromiter(map(len, split), np.int64, len(split)) + 1
            get = words.number.__getitem__
            at = np.fromiter(chain.from_iterable(chain(map(get, ws), (0,)) for ws in split), np.int64, int(sizes.sum()))
            first = np.cumsum(sizes) - sizes
            length = words.length[at]
            place = _places(words.start[at], length)
            score = flat_log10(s["model"], words.kinds[place], words.classes[place], np.add.reduceat(length, first))
            score += np.add.reduceat(words.inside[at], first)
            rare = words.rare[at]
            ends = np.concatenate(([0], np.cumsum(np.add.reduceat(rare.astype(np.int64), first)))).astype(np.int32)
            n_pairs = words.n_pairs[at]
            pair_ends = np.concatenate(([0], np.cumsum(np.add.reduceat(n_pairs, first)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(sizes), pa.array(np.add.reduceat(words.base[at], first)),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(words.key[at[rare]])),
                 pa.ListArray.from_arrays(pa.array(pair_ends), pa.array(words.pairs[_places(words.pair_start[at], n_pairs)])),
                 pa.array(score)], names=["doc_id", "n_tokens", "frequent", "rare", "pairs", "score"])
    return run


def _places(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run, one run after the other."""
    return np.repeat(start - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))


def lm_scores(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> DataFrame:
    """One row per input row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Learns from rows whose crc32 of the id as text modulo 5 is not 1 (a null id is learned from).  A null text counts
    as empty: the end token alone.  Repeated rows give a row each; other columns are not read; without training rows
    every base probability is 1 by its formula; an empty table gives an empty result.  ``end_id`` is an id that the
    tokenizer doesn't give, for the end of a text."""
    spark = C.prepare(df.sparkSession)
    docs = C.with_text(df, text_col, F.col(id_col).cast("long").alias("doc_id"))
    held = F.coalesce(C.crc_mod("doc_id", MODULUS) == 1, F.lit(False))
    train = docs.where(~held)
    distinct_words = train.mapInArrow(_count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = cut_lineage(distinct_words.where("n > 0").mapInArrow(_count_ids(path, end_id), "kind int, key long, n long"))
    words = counts.where("kind = 0").select("key", "n")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    log_z = float(np.log10(total + 0.5 * (distinct + 1)))
    unseen = float(np.log10(0.5)) - log_z
    listed = words.where(F.col("key") != END)
    top = listed.where(F.col("n") >= frequent(listed, FREQUENT_WORDS)).toPandas().sort_values("key")
    keys, n = top["key"].to_numpy(np.int64), top["n"].to_numpy(np.float64)
    ends = [r["n"] for r in words.where(F.col("key") == END).collect()]
    # at most as many rows as the tokenizer has ids
    ids = counts.where("kind = 1").groupBy("key").agg(F.sum("n").alias("n")).toPandas()
    from tokenizers import Tokenizer
    per_id = np.zeros(max(Tokenizer.from_file(path).get_vocab_size(), end_id + 1))
    per_id[ids["key"].to_numpy(np.int64)] = ids["n"].to_numpy(np.float64)
    cls, share = classes_of(per_id)
    kinds = types_of(per_id)
    pairs = cut_lineage(counts.where("kind = 2").groupBy("key").agg(F.sum("n").alias("n")))
    least = frequent(pairs, FREQUENT_PAIRS)
    pair = pairs.where(F.col("n") >= least).toPandas().sort_values("key")
    # at most as many contexts as the tokenizer has ids, times CLASSES
    context = (pairs.mapInArrow(_count_contexts(cls), "context long, n long").groupBy("context")
               .agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).toPandas())
    shares = PairShares(pair["key"].to_numpy(np.int64), pair["n"].to_numpy(np.int64), cls, share,
                        [context[c].to_numpy(np.int64) for c in ("context", "n", "kinds")])
    more_pairs = bool(shares.open.any())

    model = fit_all(train, path, kinds, cls, int(per_id.sum()), end_id)
    end_base = float(np.log10((ends[0] if ends else 0) + 0.5)) - log_z
    shared = C.Shared(spark, {
        "keys": keys, "log10": np.log10(n + 0.5) - log_z, "kinds": kinds, "class": cls, "shares": shares,
        "model": model, "end_id": end_id, "end_base": end_base, "more_pairs": more_pairs,
        "boundaries": boundaries(per_id, context["context"].to_numpy(np.int64), context["n"].to_numpy(np.float64))})
    scored = cut_lineage(docs.mapInArrow(_score(path, shared), "doc_id long, n_tokens long, frequent double, "
                                         "rare array<long>, pairs array<long>, score double")
                         .withColumn("row", F.monotonically_increasing_id()))
    odd = scored.select("row", F.explode("rare").alias("key")).join(words, "key")
    odd = odd.groupBy("row").agg(F.count("*").alias("found"), F.sum(F.log10(F.col("n") + 0.5) - log_z).alias("sum_rare"))
    if more_pairs:
        bonus = pairs.where(F.col("n") < least).mapInArrow(_pair_bonus(shared), "key long, bonus double")
        bonus = (scored.select("row", F.explode("pairs").alias("key")).join(bonus, "key")
                 .groupBy("row").agg(F.sum("bonus").alias("bonus")))
        scored = (scored.join(bonus, "row", "left")
                  .withColumn("score", F.col("score") + F.coalesce("bonus", F.lit(0.0))).drop("bonus"))
    missing = F.size("rare") - F.coalesce("found", F.lit(0))
    end_unknown = 0 if ends else 1
    return (scored.join(odd, "row", "left")
            .select("doc_id", F.coalesce(C.crc_mod("doc_id", MODULUS) == 1, F.lit(False)).alias("held_out"), "n_tokens",
                    (F.col("n_tokens") - missing - end_unknown).alias("n_known"),
                    F.lit(int(total)).cast("long").alias("train_tokens"),
                    (F.col("frequent") + F.coalesce("sum_rare", F.lit(0.0)) + missing * F.lit(unseen)).alias("base_score"),
                    "score"))
