"""Ids of single words by a tokenizer file whose pre-tokens never span white space, memoised per task."""

from __future__ import annotations

import numpy as np
import regex

#: Words, and pre-tokens, remembered: a full table becomes the old one, and what is met again moves to the new one.
CACHE = 150_000
#: Pre-tokens of a lower-case word (fixed by the tokenizer file).
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_MARKS = (b".", b",")
#: Below this character a printable text is in normal form C, and lower-casing looks at single characters.
_LATIN_END = "ɐ"


def _byte_alphabet() -> dict[int, int]:
    """Byte-level BPE's stand-ins: printable Latin-1 bytes are themselves, the others follow from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: 256 + i for i, b in enumerate(rest)}


_ALPHABET = _byte_alphabet()


class WordIds(dict):
    """word (UTF-8 bytes without ASCII white space) -> its ids as little-endian uint32 bytes.

    For a tokenizer of the form NFC, lower case, pattern split, byte-level BPE.  A text's ids are those of its words in
    a row.  Words beyond printable Latin, or with what may be a special token, are left to the tokenizer as a whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.id_bytes = [int(i).to_bytes(4, "little") for i in range(self.tok.get_vocab_size())]
        self.old: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE:
            self.old = dict(self)
            self.clear()
        out = self.old.pop(word, None)
        if out is None:
            out = self.ids(word)
        self[word] = out
        return out

    def ids(self, word: bytes) -> bytes:
        """Ids of a word, its pre-tokens remembered but not the word."""
        if word.isalpha():   # ASCII letters: one pre-token
            return self._piece(word.lower().decode("ascii"))
        if word[-1:] in _MARKS and word[:-1].isalpha():   # and a full stop or comma behind it: two
            return self._piece(word[:-1].lower().decode("ascii")) + self._piece(word[-1:].decode("ascii"))
        text = word.decode("utf-8", "replace")
        if "<|" in text or max(text) >= _LATIN_END or not text.isprintable():
            return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        low = text.lower()
        return self._piece(low) if low.isalpha() else b"".join(map(self._piece, _SPLIT.findall(low)))

    def _piece(self, piece: str) -> bytes:
        out = self.pieces.get(piece)
        if out is None:
            if len(self.pieces) >= CACHE:
                self.pieces.clear()
            raw = piece if piece.isascii() else piece.encode().decode("latin-1").translate(_ALPHABET)
            out = self.pieces[piece] = b"".join([self.id_bytes[t.id] for t in self.model.tokenize(raw)])
        return out
