"""Token ids of whole texts from a public tokenizer file, with each distinct word encoded once per task or worker.

Both vocabularies here cut a text before every run "white space, then something else", so encoding the
pieces between such cuts and joining the ids gives what encoding the whole text gives. Invented or
rare words dominate the cost, hence the table of known pieces.
"""

from __future__ import annotations

import gc
import os
import re
import unicodedata
from array import array
from collections.abc import Iterable
from functools import lru_cache

#: White space other than space and line feed, or what one of the two sides might take for it.
_ODD_SPACE = tuple("\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B))))
_CUT = re.compile(r"(?<=\S) (?=\S)")
_TAIL = frozenset(".,;:!?")
#: Pieces remembered by one encoder; the table starts afresh beyond it.
KNOWN_PIECES = 600_000


class _Known(dict):
    """Ids of pieces; one that isn't there yet is encoded. A piece stands behind a space unless it begins with a line feed."""

    def __init__(self, tokenizer, byte_level: bool):
        self.tokenizer, self.byte_level = tokenizer, byte_level
        # the printable stand-in of each byte that byte-level vocabularies are written in
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        self.letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.space = self.letters[32] if byte_level else ""
        self.marks = {c: self.whole(c) for c in _TAIL}
        self.line = self.whole("\n")

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def word(self, letters: str, space: str) -> bytes:
        """A run of letters is one piece to the model, with nothing left to normalise or cut."""
        own = letters if letters.isascii() else letters.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(space + own)]).tobytes()

    def __missing__(self, piece: str) -> bytes:
        lead, rest, space = b"", piece, self.space
        if self.byte_level and piece[:1] == "\n":
            lead, rest, space = self.line, piece[1:], ""
        plain = self.byte_level or (rest == rest.lower() and unicodedata.is_normalized("NFC", rest))
        if plain and rest.isalpha():
            ids = lead + self.word(rest, space)
        elif plain and rest[-1:] in _TAIL and rest[:-1].isalpha():
            ids = self[piece[:-1]] + self.marks[rest[-1]]
        else:
            ids = self.whole(" " + piece if self.byte_level and not lead else piece)
        self[piece] = ids
        return ids


class PieceEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    ``byte_level``: a piece keeps its leading space (byte-level BPE). Otherwise white space is dropped
    and letters are lower-cased by the tokenizer (word-end BPE).
    """

    def __init__(self, path: str, byte_level: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.byte_level = byte_level
        self.known = _Known(self.tokenizer, byte_level)

    def _one(self, text: str) -> bytes:
        known = self.known
        if not self.byte_level:
            if "Σ" not in text and unicodedata.is_normalized("NFC", text):
                text = text.lower()
            # str.split also cuts at these four, which are no white space to the tokenizer
            if any(c in text for c in "\x1c\x1d\x1e\x1f"):
                return b"".join([known[w] for w in text.split(" ") if w])
            return b"".join(map(known.__getitem__, text.split()))
        if not text:
            return b""
        if "  " in text or " \n" in text or "\n " in text or "\n\n" in text or text[-1] in " \n" or text[0] in " \n" or any(c in text for c in _ODD_SPACE):
            first, *rest = _CUT.split(text)
            return known.whole(first) + b"".join(map(known.__getitem__, rest))
        # a line end before the text, and its id off again
        return b"".join(map(known.__getitem__, ("\n" + text.replace("\n", " \n")).split(" ")))[len(known.line) :]

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of every text, in order; an empty text has none."""
        if len(self.known) > KNOWN_PIECES:
            self.known = _Known(self.tokenizer, self.byte_level)
        gc.disable()  # millions of small objects, none of them in cycles
        try:
            return [self._one(text) for text in texts]
        finally:
            gc.enable()


@lru_cache(maxsize=1)
def worker_encoder(path: str, byte_level: bool) -> PieceEncoder:
    """The encoder of this Python worker: its vocabulary and its known pieces live on from task to task."""
    return PieceEncoder(path, byte_level)


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size()
