"""Byte-level BPE encoding and decoding by a hierarchical-bitmap rank queue.

All new pre-tokens of a chunk of texts lie in one linked list of byte positions with walls between them.  Each merge
rank has a bucket of list positions whose pair merges to that rank; a three-level bitmap over the ranks (64 children
per word) gives the smallest non-empty bucket by find-first-set.  A popped bucket drops stale entries, merges the rest
left to right, and pushes the pairs that the merges made.  A bucket costs its entries, not the length of a pre-token,
so one pre-token of a million bytes costs as much as many short ones."""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revsift.llm import common as C

#: Rank of a position whose pair doesn't merge.
_NONE = np.int64(1 << 40)
#: Buckets below this size are merged one entry at a time: numpy calls would cost more.
_SMALL = 12
#: Bytes of text a task encodes together, and pre-tokens it remembers.
CHUNK_BYTES = 1_500_000
CACHE_PIECES = 150_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Numbers(dict):
    """Numbers things in the order they are first asked for."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


class RankBitmap:
    """Set of small integers with find-first-set over three levels of 64-bit words."""

    def __init__(self, size: int):
        self.levels = []
        while True:
            size = (size + 63) >> 6
            self.levels.append([0] * size)
            if size == 1:
                break

    def add(self, i: int):
        for words in self.levels:
            words[i >> 6] |= 1 << (i & 63)
            i >>= 6

    def pop_first(self) -> int:
        """Remove and return the smallest member, -1 if empty."""
        if not self.levels[-1][0]:
            return -1
        i = 0
        for words in reversed(self.levels):
            word = words[i]
            i = (i << 6) | ((word & -word).bit_length() - 1)
        at = i
        for words in self.levels:
            words[at >> 6] &= ~(1 << (at & 63))
            if words[at >> 6]:
                break
            at >>= 6
        return i


class RankTable:
    """Merge table of a rank file: (left id, right id) -> id of the joined bytes."""

    def __init__(self, path: str):
        self.ranks = read_ranks(path)
        self.size = max(self.ranks.values()) + 1
        self.byte_id = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        self.pairs = {}
        #: Tokens that can join a neighbour to a token of a lower rank: their merges must go one at a time.
        self.unsafe = np.zeros(self.size, bool)
        for token, r in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    self.pairs[(a << 32) | b] = r
                    if r < a:
                        self.unsafe[a] = True
                    if r < b:
                        self.unsafe[b] = True
        keys = np.fromiter(self.pairs, np.int64, len(self.pairs))
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.int64(1 << 62))
        self.values = np.append(np.fromiter(self.pairs.values(), np.int64, len(self.pairs))[order], _NONE)

    def lookup(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a << 32) | b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.values[at], _NONE)

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian int32 bytes; pieces never merge into each other."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        total = int(sizes.sum())
        if not total:
            return [b""] * len(pieces)
        ids = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        piece = np.repeat(np.arange(len(pieces)), sizes)
        # position i links to the next and previous living position; total and total + 1 are walls
        nxt = np.arange(1, total + 2)
        prv = np.arange(-1, total + 1)
        prv[0] = total + 1
        rank = np.full(total + 2, _NONE)
        inside = np.flatnonzero(piece[1:] == piece[:-1])
        rank[inside] = self.lookup(ids[inside], ids[inside + 1])
        alive = np.ones(total + 2, bool)
        alive[total:] = False
        ids = np.append(ids, [0, 0])
        piece = np.append(piece, [-1, -2])
        nxt = np.append(nxt, total)[:total + 2]
        prv = np.append(prv, total)[:total + 2]
        buckets: dict[int, list] = {}
        queue = RankBitmap(self.size)

        def push(at: np.ndarray):
            r = rank[at]
            at, r = at[r < _NONE], r[r < _NONE]
            if not len(at):
                return
            order = np.argsort(r, kind="stable")
            at, r = at[order], r[order]
            edge = np.flatnonzero(r[1:] != r[:-1]) + 1
            for value, part in zip(r[np.concatenate(([0], edge))].tolist(), np.split(at, edge)):
                if value in buckets:
                    buckets[value].append(part)
                else:
                    buckets[value] = [part]
                    queue.add(value)

        def push_one(i: int, r: int):
            if r in buckets:
                buckets[r].append((i,))
            else:
                buckets[r] = [(i,)]
                queue.add(r)

        push(inside)
        while (r := queue.pop_first()) >= 0:
            parts = buckets.pop(r)
            if sum(map(len, parts)) < _SMALL:
                for i in sorted({int(x) for part in parts for x in part}):
                    if not alive[i] or rank[i] != r:
                        continue
                    if r in buckets and self.unsafe[r]:
                        buckets[r].append((i,))
                        continue
                    j = int(nxt[i])
                    k = int(nxt[j])
                    alive[j] = False
                    ids[i], nxt[i], prv[k] = r, k, i
                    me = int(piece[i])
                    rank[i] = x = self.pairs.get((r << 32) | int(ids[k]), int(_NONE)) if piece[k] == me else int(_NONE)
                    if x < _NONE:
                        push_one(i, x)
                    h = int(prv[i])
                    if piece[h] == me:
                        rank[h] = x = self.pairs.get((int(ids[h]) << 32) | r, int(_NONE))
                        if x < _NONE:
                            push_one(h, x)
                    if self.unsafe[r]:  # a lower rank may have come up: let the queue decide, then go on with this bucket
                        buckets.setdefault(r, [])
                        queue.add(r)
                continue
            at = np.unique(np.concatenate([np.asarray(p, np.int64) for p in parts]))
            at = at[alive[at] & (rank[at] == r)]
            if not len(at):
                continue
            if self.unsafe[r]:
                head = np.concatenate(([True], piece[at[1:]] != piece[at[:-1]]))
                if not head.all():
                    buckets[r] = [at[~head]]
                    queue.add(r)
                at = at[head]
            else:  # in a run such as aaaa every second pair is left over
                linked = np.concatenate(([False], nxt[at[:-1]] == at[1:]))
                start = np.maximum.accumulate(np.where(linked, 0, np.arange(len(at))))
                at = at[((np.arange(len(at)) - start) & 1) == 0]
            right = nxt[at]
            after = nxt[right]
            alive[right] = False
            ids[at] = r
            nxt[at] = after
            prv[after] = at
            touched = np.concatenate((at, prv[at]))
            touched = np.unique(touched[touched < total])
            touched = touched[alive[touched]]
            follow = nxt[touched]
            same = (follow < total) & (piece[np.minimum(follow, total)] == piece[touched])
            rank[touched] = np.where(same, self.lookup(ids[touched], ids[np.minimum(follow, total)]), _NONE)
            push(touched)
        left = alive[:total]
        flat = ids[:total][left].astype("<i4")
        ends = np.cumsum(np.bincount(piece[:total][left], minlength=len(pieces))).tolist()
        raw = flat.tobytes()
        out, a = [], 0
        for e in ends:
            out.append(raw[4 * a:4 * e])
            a = e
        return out


def _decoded(token: dict[int, bytes], ids: np.ndarray) -> bytes:
    return b"".join(map(token.__getitem__, ids.tolist()))


def _encode(path: str, pattern: str, decode: bool = False):
    def run(batches):
        table, split = RankTable(path), regex.compile(pattern)
        token = {r: t for t, r in table.ranks.items()} if decode else None
        number, encoded = Numbers(), []   # pre-token -> number -> ids

        def done(chunk):
            # numbers are dealt in order, so the new pre-tokens are those at the end
            fresh = list(number)[len(encoded):]
            encoded.extend(table.encode([p.encode() for p in fresh]))
            for ids, pieces in chunk:
                flat = [b"".join(map(encoded.__getitem__, ps.tolist())) for ps in pieces]
                ends = np.cumsum([0, *(len(x) // 4 for x in flat)]).astype(np.int32)
                values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(flat))])
                columns = [ids, pa.ListArray.from_arrays(pa.array(ends), values)]
                if decode:   # from the ids alone, in the same worker
                    columns.append(pa.array([_decoded(token, np.frombuffer(x, "<i4")) for x in flat], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"][:len(columns)])
            if len(number) > CACHE_PIECES:
                number.clear()
                encoded.clear()

        chunk, size = [], 0
        for b in batches:
            pieces = []
            for t in b.column("text").to_pylist():
                found = split.findall(t) if t else []
                pieces.append(np.fromiter(map(number.__getitem__, found), np.int32, len(found)))
            chunk.append((b.column("doc_id"), pieces))
            size += b.nbytes
            if size >= CHUNK_BYTES:
                yield from done(chunk)
                chunk, size = [], 0
        if chunk:
            yield from done(chunk)
    return run


def _decode(path: str):
    def run(batches):
        token = {r: t for t, r in read_ranks(path).items()}
        for b in batches:
            ids = b.column("ids")
            out = [_decoded(token, x.values.to_numpy()) if x.is_valid else None for x in ids]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), ids, pa.array(out, pa.binary())],
                                             names=["doc_id", "ids", "decoded"])
    return run


def bpe_encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
               decode: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, ids array<int>``, and with ``decode`` the bytes that the ids stand for,
    ``decoded binary``, looked up by the task that made them (:func:`bpe_decode` does it for any ids).  A null or empty text gives an empty array; repeated rows
    and null ids give a row each; other columns are not read; an empty table gives an empty result."""
    C.prepare(df.sparkSession)
    return (df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(_encode(path, pattern, decode), "doc_id long, ids array<int>" + (", decoded binary" if decode else "")))


def bpe_decode(df: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids`` plus ``decoded binary``, the bytes the ids stand for (null ids: null)."""
    return df.select("doc_id", "ids").mapInArrow(_decode(path), "doc_id long, ids array<int>, decoded binary")
