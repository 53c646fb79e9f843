"""Plain restatements of the operators' contracts, for small inputs."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingles(text, k=5):
    w = WORD.findall(lower(text or ""))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def jaccard_components(rows):
    """rows: (doc_id, text) -> {doc_id: (n_shingles, component)}; all pairs through an inverted index."""
    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    where = {}
    for d, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(d)
    for d, s in sets.items():
        both = {}
        for x in s:
            for o in where[x]:
                if o < d:
                    both[o] = both.get(o, 0) + 1
        for o, c in both.items():
            if 100 * c >= 75 * (len(s) + len(sets[o]) - c):
                a, b = sorted((root(o), root(d)))
                parent[b] = a
    return {d: (len(s), root(d)) for d, s in sets.items()}


def substring_dedup(rows, window=13):
    """rows: (doc_id, text) -> {doc_id: (n_words, n_removed, kept text)}"""
    first = {}
    words = {d: WORD.findall(t or "") for d, t in rows}
    for d, w in words.items():
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            first[k] = min(first.get(k, d), d)
    out = {}
    for d, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < d:
                gone[i:i + window] = [True] * window
        out[d] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def quality_base(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)"""
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    inside = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)} if len(w) < 400 else _inside(grams)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside),
            len(w) < 50 or 100 * len(inside) > 50 * len(w))


def _inside(grams):
    from collections import Counter
    c = Counter(grams)
    return {i + k for i, g in enumerate(grams) if c[g] > 1 for k in range(3)}


def coverage(w):
    """(words in repeated 3-grams, per n = 2..10 the characters in later occurrences of repeated n-grams)"""
    chars = []
    for n in range(2, 11):
        seen, inside = set(), set()
        for i in range(len(w) - n + 1):
            g = tuple(w[i:i + n])
            if g in seen:
                inside.update(range(i, i + n))
            seen.add(g)
        chars.append(sum(len(w[i]) for i in inside))
    return len(_inside([tuple(w[i:i + 3]) for i in range(len(w) - 2)])), chars
