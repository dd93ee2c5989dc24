"""Token ids of whole texts by the tokenizers library, with a bounded cache of what is between white space.

A tokenizer that drops white space and never looks across it, which some probes
tell, gives a text the ids of its chunks in turn; any other gets whole texts.  So each chunk is encoded once while it stays in the
cache of the Python worker.  Chunks of plain Latin letters, digits and signs
are cut into pre-tokens, whose ids the library's model gives; all other chunks
go through the whole tokenizer.
"""

from __future__ import annotations

import os
import re
import sys
from array import array

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Entries of a generation of the cache, of which there are two.  Results do not depend on it.
CACHE = 220_000
#: Letters that lower-case to one letter of this range and are single code points after composition.
_PLAIN = re.compile(r"[!-&(-;=-~À-ÖØ-öø-ÿ]+")
_PIECES = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")

#: White space to Python's split() but not to the tokenizers.
_CONTROLS = re.compile("[\x1c-\x1f]")
_SPACE = re.compile(r"[\x20\t-\r]+")

_encoders: dict[str, Encoder] = {}


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level model: itself where printable, else the next from U+0100 on."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in kept else next(spare)) for b in range(256)]


class Encoder:
    """Ids as bytes of ``dtype``: two bytes an id where the vocabulary allows it."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        letters = _byte_letters()
        self.letters = {c: "".join(letters[b] for b in chr(c).encode()) for c in (*range(33, 127), *range(0xC0, 0x100))}
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.by_chunk = self.by_piece = True
        self.by_piece = self._agrees()
        self.by_chunk = self._apart()
        self.known.clear()

    def _library(self, chunk: str) -> bytes:
        return self._packed(self.tokenizer.encode(chunk, add_special_tokens=False).ids)

    def _packed(self, ids: list[int]) -> bytes:
        if sys.byteorder == "little":
            return array("H" if self.dtype.itemsize == 2 else "I", ids).tobytes()
        return np.asarray(ids, self.dtype).tobytes()

    def _piece(self, piece: str) -> bytes:
        return self._packed([t.id for t in self.tokenizer.model.tokenize(piece.translate(self.letters))])

    def _by_piece(self, chunk: str) -> bytes:
        pieces = _PIECES.findall(chunk.lower())
        if len(pieces) == 1 and pieces[0] == chunk:
            return self._piece(chunk)
        return b"".join([self.known.get(x) or self._ids(x) for x in pieces])

    def _agrees(self) -> bool:
        """Whether cutting chunks gives what the whole tokenizer gives; if not, it is used for every chunk."""
        probes = ["Thatthtieror,", "ÉÇÄÖÜß", "a1b22", "x***$$$", "(743)", "best.54@mail3.example.com", '"a-b"!?', "ÿñ_é|", "%%A~Z"]
        return all(self._by_piece(x) == self._library(x) for x in probes)

    def _apart(self) -> bool:
        """Whether the tokenizer drops white space and never looks across it; if not, whole texts go through it."""
        probes = ["the cat  sat.", " a\nb\tc ", "It's 1 2 33 é", "x\r\n\r\ny", "don 't , no"]
        return all(self.encode(x) == self._library(x) for x in probes)

    def _ids(self, chunk: str) -> bytes:
        """Ids of a chunk, or of a pre-token, which is a chunk too, that the young generation does not have."""
        ids = self.old.get(chunk)
        if ids is None:
            ids = self._by_piece(chunk) if self.by_piece and _PLAIN.fullmatch(chunk) else self._library(chunk)
        if len(chunk) <= 64:
            if len(self.known) >= CACHE:
                self.known, self.old = {}, self.known
            self.known[chunk] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        text = text or ""
        if not self.by_chunk:
            return self._library(text)
        known, out = self.known, []
        for chunk in _SPACE.split(text) if _CONTROLS.search(text) else text.split():
            ids = known.get(chunk)
            if ids is None:
                ids = self._ids(chunk)
                known = self.known
            out.append(ids)
        return b"".join(out)


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def end_bytes(enc: Encoder, end_id: int) -> bytes:
    return np.asarray([end_id], enc.dtype).tobytes()
