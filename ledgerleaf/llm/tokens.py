"""Subword ids of whole texts, word by word, with a bounded memory of words."""

from __future__ import annotations

import os
import re
import struct

import numpy as np

MAX_WORDS = 300_000  # remembered in each of two generations; what is used again outlives the older one
#: Lower-case letters of Latin-1: neither normalising nor splitting changes a word of them.
PLAIN = re.compile("[a-zß-öø-ÿ]+")
#: Marks that are split off behind a letter.
MARKS = b".,;:!?"


def byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write bytes: visible Latin-1 characters as themselves, the others in order from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class Words(dict):
    """Ids of words (UTF-8 bytes) as bytes of ``kind``. The vocabulary's splitting never joins what white space parts, so a text's ids are its words' ids."""

    def __init__(self, path: str, end: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.model = self.tokenizer.model
        self.code = "H" if self.size <= 1 << 16 else "I"
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.end = b"" if end is None else np.array([end], self.kind).tobytes()
        self.older: dict[bytes, bytes] = {}
        self.letters = byte_letters()
        self.marks = {m: self._encoded(chr(m)) for m in MARKS}

    def _packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def _encoded(self, text: str) -> bytes:
        return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __missing__(self, w: bytes) -> bytes:
        ids = self.older.get(w)
        if ids is None:
            mark = self.marks.get(w[-1])
            ids = self[w[:-1]] + mark if mark is not None and b"<|" not in w and self._letter(w) else self._made(w)
        if len(self) >= MAX_WORDS:
            self.older = dict(self)
            self.clear()
        self[w] = ids
        return ids

    @staticmethod
    def _letter(w: bytes) -> bool:
        """Whether a letter of ASCII or Latin-1 (C3 and 80 to BF, without the two signs among them) stands before the last byte."""
        return w[-2:-1].isalpha() or w[-3:-2] == b"\xc3" and w[-2] not in (0x97, 0xB7)

    def _made(self, w: bytes) -> bytes:
        if w.isalpha():  # ASCII
            return self._packed([t.id for t in self.model.tokenize(w.lower().decode())])
        text = w.decode()
        if b"<|" not in w and PLAIN.fullmatch(low := text.lower()):
            return self._packed([t.id for t in self.model.tokenize(low.encode().decode("latin-1").translate(self.letters))])
        return self._encoded(text)

    def texts(self, texts: list[bytes | None]) -> list[bytes]:
        """Ids of each text and the end id, as bytes. The vocabulary is one of lower case, so texts that can't hold a special token are lowered first."""
        return [b"".join(map(self.__getitem__, (t if b"<|" in t else t.lower()).split())) + self.end if t else self.end for t in texts]


_made: dict[tuple, Words] = {}


def words(path: str, end: int | None = None) -> Words:
    """One memory of words a worker process."""
    if (path, end) not in _made:
        _made[path, end] = Words(path, end)
    return _made[path, end]
