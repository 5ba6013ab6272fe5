"""Token ids by the tokenizers library, with a cache of words."""

from __future__ import annotations

import re
import struct

import numpy as np
from tokenizers import Tokenizer

#: Words kept by a worker; about 200 bytes each. A full cache starts anew.
CACHE_WORDS = 1_500_000
_encoders: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """The encoder of a vocabulary file, one for each worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class _Words(dict):
    """Ids of words after ``lead`` (nothing or a space) as bytes, found when first asked for."""

    def __init__(self, encode, lead: str):
        super().__init__()
        self._encode, self._lead = encode, lead

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        m = _MARKED.fullmatch(word)
        ids = self[m[1]] + self._encode(m[2]) if m else self._encode(self._lead + word)
        self[word] = ids
        return ids


# letters of these blocks are letters for every pre-tokenizer; marks: ASCII but for the apostrophe
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_PLAIN = re.compile(f" ?[{_LETTERS}]+")
_MARKED = re.compile(f"([{_LETTERS}]+)([!-&(-/:-@\\[-`{{-~]+)")


def _alphabet() -> dict[int, str]:
    """Byte-level tokenizers write bytes as characters: visible ones as themselves, the others from 256 on in their order."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return dict(zip((b for b in range(256) if b not in visible), map(chr, range(256, 512))))


class Encoder:
    """Ids of whole texts, equal to those of ``Tokenizer.encode(text, add_special_tokens=False)``.

    The byte-level pre-tokenizer never joins a visible character with a space or newline after it, so a text may be cut before
    a single space and around a single newline that stand between visible characters. Each word is encoded by the library
    once and kept: plain words by its model directly, marks behind a word by themselves, all else by the whole tokenizer. Texts
    with other white space (runs of it, or at an end) are cut at the places where this holds. Texts that hold an added token
    (``<|endoftext|>``) are never cut. Only for byte-level BPE; others need ``words=False``, which passes texts through whole.
    """

    def __init__(self, path: str, words: bool = True):
        self._t = Tokenizer.from_file(path)
        self._added = [t.content for t in self._t.get_added_tokens_decoder().values()]
        self._words, self._map, self._marks = words, _alphabet(), {}
        self._first, self._next = _Words(self._piece, ""), _Words(self._piece, " ")

    def size(self) -> int:
        return self._t.get_vocab_size()

    def _piece(self, piece: str) -> bytes:
        if _PLAIN.fullmatch(piece):
            ids = [t.id for t in self._t.model.tokenize(piece.encode().decode("latin-1").translate(self._map))]
        elif piece in self._marks:
            return self._marks[piece]
        else:
            ids = self._t.encode(piece, add_special_tokens=False).ids
        out = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= 2:
            self._marks[piece] = out
        return out

    _cut = re.compile(r"(?<=\S)(?= \S)|(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)")

    def _bytes(self, text: str) -> bytes:
        out: list[bytes] = []
        first, following = self._first.__getitem__, self._next.__getitem__
        for i, line in enumerate(text.split("\n")):
            words = line.split(" ")
            # only words with one space between them; others have white space that belongs to a token
            if not line or not line.isprintable() or "  " in line or line[0] == " " or line[-1] == " ":
                return b"".join(map(first, self._cut.split(text)))
            if i:
                out.append(self._newline())
            out.append(first(words[0]))
            out.extend(map(following, words[1:]))
        return b"".join(out)

    def _newline(self) -> bytes:
        return self._marks.get("\n") or self._piece("\n")

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Unsigned 32-bit ids of each text."""
        if not self._words:
            return [np.array(e.ids, dtype="<u4") for e in self._t.encode_batch(texts, add_special_tokens=False)]
        return [np.array(self._t.encode(t, add_special_tokens=False).ids, dtype="<u4") if self._holds_added(t) else np.frombuffer(self._bytes(t) if t else b"", dtype="<u4") for t in texts]

    def _holds_added(self, text: str | None) -> bool:
        return bool(text) and any(a in text for a in self._added)
