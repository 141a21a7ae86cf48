"""Tokenising whole texts with a public vocabulary, one library call per new piece.

Library tokenizers run at about 1 MB a second; most of a corpus is repeated
words.  Both vocabularies used here split a text into pre-tokens that never
cross certain white space, so a text's ids are the joined ids of its pieces.
Each Python worker keeps the ids of recent pieces as packed bytes and asks the
library only for pieces it hasn't met: plain words go to the library's model
directly, all others through its whole chain.  Ids are exactly the library's.

Cuts that are safe:

* byte-level vocabulary (``byte=True``): before a single space, and before and
  after a single line feed, if both neighbours are not white space.  The space
  belongs to the following piece, as in the vocabulary's own rule.  A text with
  any other white space (double spaces, indents, tabs) is cut only where the
  rule holds.
* word-end vocabulary (``byte=False``), which drops white space: at every run
  of ASCII white space.

The strings of special tokens in a text are ordinary text
(``encode_special_tokens``), as the vocabularies' notes show.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

#: Pieces kept by a worker, twice (recent and older); about 200 bytes each.
CACHE_PIECES = 450_000

#: White space in the widest sense of any regex engine; cuts stay away from it.
_WS = r"\s\x00-\x20\x85\xa0᠎​﻿"
_EDGE = re.compile(rf"^[{_WS}]|[{_WS}]$")
_CUT = re.compile(rf"(?<=[^{_WS}])(?= [^{_WS}])")


class _Irregular(Exception):
    """A piece whose ids depend on its neighbours."""


class _Cache(dict):
    """Piece -> packed ids; two generations bound the memory."""

    def __init__(self, owner: "PieceTokenizer"):
        super().__init__()
        self.owner, self.old = owner, {}

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.owner.encode_piece(piece)
        if len(self) >= CACHE_PIECES:
            self.old = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class PieceTokenizer:
    def __init__(self, path: str, byte: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tk = Tokenizer.from_file(path)
        self.tk.encode_special_tokens = True
        self.byte = byte
        size = self.tk.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.cache = _Cache(self)
        self.feed = self._ids("\n") if byte else b""
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.marks: dict[str, bytes] = {}  # ids of punctuation runs
        # the byte-level alphabet, as the library itself spells the 256 bytes
        spell = ByteLevel(add_prefix_space=False, use_regex=False)
        low = [c for c in range(0x80, 0x250) if chr(c).isalpha()] + list(range(0x21, 0x7F))
        self.spelt = {c: spell.pre_tokenize_str(chr(c))[0][0] for c in low}

    def _ids(self, text: str) -> bytes:
        ids = self.tk.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype=self.dtype).tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of one pre-token in byte-level spelling, by the library's model."""
        return array(self.code, [t.id for t in self.tk.model.tokenize(word)]).tobytes()

    def _plain(self, s: str, space: bool) -> bytes | None:
        """Ids of Latin letters, perhaps with stops behind: two pre-tokens at most."""
        core = s.rstrip(".,;:!?")
        if not core.isalpha() or not core.isascii() and max(core) >= "\u0250" or "İ" in core:
            return None
        if len(core) < len(s):
            tail = s[len(core):]
            if tail not in self.marks:
                self.marks[tail] = self._ids(tail)
            if space or not self.byte:  # the same letters without stops may be known
                return self.cache[core.encode()] + self.marks[tail]
            return self._plain(core, space) + self.marks[tail]
        if not self.byte:
            core = core.lower()
        return self._word(("Ġ" if space else "") + core.translate(self.spelt))

    def encode_piece(self, piece: bytes) -> bytes:
        """Ids of one piece; the byte-level form of a plain piece has its space put back."""
        s = piece.decode("utf-8", "replace")
        if piece.isalpha():  # ASCII letters only
            return self._word("Ġ" + s if self.byte else s.lower())
        if not self.byte:
            ids = self._plain(s, False)
            return self._ids(s) if ids is None else ids
        line = s[:1] == "\n"
        body = s[1:] if line else s
        if not body or _EDGE.search(body):
            raise _Irregular
        ids = self._plain(body, not line)
        if ids is None:
            return self._ids(s if line else " " + s)
        return self.feed + ids if line else ids

    def encode_batch(self, texts: list[bytes | None]) -> list[bytes]:
        """Packed ids (``dtype``) of each UTF-8 text; null counts as empty."""
        get = self.cache.__getitem__
        if not self.byte:
            return [b"".join(map(get, (t or b"").split())) for t in texts]
        out = []
        for t in texts:
            ps = (t or b"").replace(b"\n", b" \n").split(b" ")
            try:
                out.append(self._head(ps[0]) + b"".join(map(get, ps[1:])))
            except _Irregular:
                out.append(self._irregular(t.decode("utf-8", "replace")))
        return out

    def _head(self, first: bytes) -> bytes:
        s = first.decode("utf-8", "replace")
        if s and _EDGE.search(s):
            raise _Irregular
        return self._ids(s)

    def _irregular(self, text: str) -> bytes:
        """A text with uncommon white space, cut only where that is safe."""
        cuts = _CUT.split(text)
        out = [self._ids(cuts[0])]
        get = self.cache.__getitem__
        for c in cuts[1:]:
            body = c[1:]
            out.append(self._ids(c) if "\n" in body or _EDGE.search(body) else get(body.encode()))
        return b"".join(out)


_LOADED: dict[tuple[str, bool], PieceTokenizer] = {}


def tokenizer(path: str, byte: bool) -> PieceTokenizer:
    """One instance per Python worker, kept between tasks."""
    if (path, byte) not in _LOADED:
        _LOADED[path, byte] = PieceTokenizer(path, byte)
    return _LOADED[path, byte]


def sub_batches(texts: list[bytes | int | None], limit: int = 4 << 20):
    """Index ranges of about ``limit`` bytes, so that long texts don't pile up; of texts or their lengths."""
    start = size = 0
    for i, t in enumerate(texts):
        size += t if isinstance(t, int) else len(t or b"")
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
