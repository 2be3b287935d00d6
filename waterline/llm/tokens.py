"""Token ids of a public tokenizer, packed as bytes and looked up by word.

The tokenizer's normaliser and splitter never look across white space, and no token holds any, so a
text's ids are the ids of its ASCII-space-separated pieces laid end to end. Pieces repeat, so their
ids are kept in a bounded table. A piece of plain Latin letters, digits and marks is split by the
tokenizer's own pattern and handed to its model word by word; any other piece goes through the whole
tokenizer.
"""

from __future__ import annotations

import re
import struct

# Characters on which composing and lower-casing act one by one, as Python does them.
_PLAIN = re.compile(r"[!-~¡-İĲ-ſ]*")
# Fixed: the split pattern of word_bpe_49k, its letters and numbers spelled out for plain pieces.
_LETTER, _NUMBER = "a-zªµºß-öø-ſ", "0-9²³¹¼½¾"
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\s{_LETTER}{_NUMBER}]+")


def _byte_letters() -> dict[int, str]:
    """The public byte-level alphabet: visible bytes stand for themselves, others for U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(others)}


class _Recent(dict):
    """A bounded table: when it is full it becomes the old half, and used entries return."""

    def __init__(self, make, entries: int):
        super().__init__()
        self._make, self._entries, self._old = make, entries, {}

    def __missing__(self, key):
        value = self._old.get(key)
        if value is None:
            value = self._make(key)
        if len(self) >= self._entries:
            self._old = dict(self)
            self.clear()
        if len(key) <= 64:
            self[key] = value
        return value


class PackedTokenizer:
    """``encode(text)`` gives the ids as little-endian unsigned 32-bit numbers, without special tokens."""

    def __init__(self, path: str, entries: int = 100_000):
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        self._model = self._whole.model
        self._letters = _byte_letters()
        self._packed = [struct.pack("<I", i) for i in range(self._whole.get_vocab_size())]
        self._pieces = _Recent(self._piece, entries)
        self._words = _Recent(self._word, entries)

    def _word(self, word: str) -> bytes:
        letters = word if word.isascii() else word.encode().decode("latin-1").translate(self._letters)
        packed = self._packed
        return b"".join([packed[token.id] for token in self._model.tokenize(letters)])

    def _piece(self, piece: bytes) -> bytes:
        if piece.isalpha():  # ASCII letters only
            return self._words[piece.lower().decode()]
        if piece[-1] in b".," and piece[:-1].isalpha():
            return self._words[piece[:-1].lower().decode()] + self._words[chr(piece[-1])]
        text = piece.decode()
        if _PLAIN.fullmatch(text) and "<|" not in text:
            return b"".join(map(self._words.__getitem__, _SPLIT.findall(text.lower())))
        packed = self._packed
        return b"".join([packed[i] for i in self._whole.encode(text, add_special_tokens=False).ids])

    def encode(self, text: str) -> bytes:
        return b"".join(map(self._pieces.__getitem__, text.encode().split()))


_loaded: dict[str, PackedTokenizer] = {}


def tokenizer(path: str) -> PackedTokenizer:
    """One per Python worker."""
    if path not in _loaded:
        _loaded[path] = PackedTokenizer(path)
    return _loaded[path]
