"""Token ids of a public BPE tokenizer, remembered word by word.

``word_bpe_49k.json`` normalises (NFC, white space to one space, lower case), splits
by a pattern that never joins text across white space, and encodes each piece on its
own. A piece therefore has the same ids wherever it stands. Texts of plain Latin
characters are split here by the same pattern and each distinct piece is encoded
once by the library's model; every other text goes to the library as it is.
"""

from __future__ import annotations

import functools
import re
from array import array

import numpy as np

#: Characters for which NFC does nothing and both lower-casing and the classes of the
#: pattern agree between Python and the library.
PLAIN = re.compile("[\t\n\r -~À-ÖØ-öø-ÿ–—‘’“”…€]*")
#: The tokenizer's own split pattern, over the lower-cased plain characters.
PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-zß-öø-ÿ0-9]+")
SPACE = re.compile("[ \t\n\r]")
#: Pieces remembered per worker; beyond this the memory is started anew.
REMEMBERED = 300_000
#: Longer pieces are not remembered.
LONGEST = 64
SLICE = 65_536


def byte_letters() -> dict[int, str]:
    """The byte-level pre-tokenizer's letter of each byte: itself where it is a visible
    Latin-1 character, else the next character from 256 on."""
    out, extra = {}, 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            out[b] = chr(b)
        else:
            out[b], extra = chr(extra), extra + 1
    return out


class Pieces(dict):
    """Ids of the split pattern's pieces; one that is not there yet is encoded by the library's model."""

    def __init__(self, model):
        super().__init__()
        self.encode, self.letters = model.tokenize, byte_letters()

    def __missing__(self, piece: str) -> bytes:
        word = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        ids = array("I", [t.id for t in self.encode(word)]).tobytes()
        if len(self) >= REMEMBERED:
            self.clear()
        if len(piece) <= LONGEST:
            self[piece] = ids
        return ids


class WordBpe:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.pieces = Pieces(self.lib.model)

    def _library(self, text: str) -> bytes:
        return np.asarray(self.lib.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    @staticmethod
    def plain(text: str) -> bool:
        return "<|" not in text and PLAIN.fullmatch(text) is not None

    def _slice(self, text: str) -> bytes:
        if not self.plain(text):
            return self._library(text)
        return b"".join(map(self.pieces.__getitem__, PIECE.findall(text.lower())))

    def ids(self, text: str) -> bytes:
        """All ids of ``text`` as little-endian unsigned 32-bit integers.

        A long text is encoded in slices cut at white space, where neither the
        normaliser, nor the split, nor a special string can reach across."""
        if len(text) <= SLICE:
            return self._slice(text)
        out, at = [], 0
        while at < len(text):
            m = SPACE.search(text, min(len(text), at + SLICE))
            end = m.start() if m else len(text)
            out.append(self._slice(text[at:end]))
            at = end
        return b"".join(out)

    def starts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Piece starts (characters) and the number of tokens before each of them."""
        if self.plain(text):
            low = text.lower()
            pieces = list(PIECE.finditer(low))
            n = np.fromiter((len(self.pieces[m.group()]) // 4 for m in pieces), np.int64, len(pieces))
            at = np.fromiter((m.start() for m in pieces), np.int64, len(pieces))
            return at, np.cumsum(n) - n
        off = self.lib.encode(text, add_special_tokens=False).offsets
        at = np.fromiter((a for a, _ in off), np.int64, len(off))
        return at, np.arange(len(at), dtype=np.int64)


@functools.lru_cache(maxsize=4)
def load(path: str) -> WordBpe:
    """One encoder per Python worker and vocabulary file."""
    return WordBpe(path)
