"""Token ids of whole texts by a byte-level BPE vocabulary of the tokenizers library.

The vocabulary's splitter never joins across a single space between two other characters: what
follows such a space is encoded alike in any text. A line break alone, or one of two, between other
characters is a token of its own, so lines are cut there as well. Each distinct piece is encoded once
per Python worker and looked up afterwards, which is several times as fast as encoding running text
and gives the same ids.
"""

import os
import re
import sys
from array import array

import numpy as np

# Texts with any of these, or with spaces or line breaks in a row, are cut by the slower pattern.
_RARE_SPACE = re.compile(
    "[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
)
_SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
_LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]+")
LONGEST_PIECE = 64  # characters of a piece that is kept
MOST_PIECES = 500_000  # of each of two generations, about 250 bytes each and 600 at most

_ENCODERS = {}


def _byte_marks():
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def _is_word(piece):
    """Whether a piece is letters alone, which the splitter keeps together."""
    return piece.isascii() and piece.isalpha() or _LETTERS.fullmatch(piece) is not None


class _Pieces(dict):
    """Piece to the bytes of its ids; ``lead`` is the space before every piece but a text's first.

    A full dictionary becomes the elder generation, from which pieces in use move to the new one.
    Longer pieces, such as texts without spaces, are encoded and not kept.
    """

    def __init__(self, encoder, lead):
        super().__init__()
        self.encoder, self.lead, self.elder = encoder, lead, {}

    def __missing__(self, piece):
        if len(piece) > LONGEST_PIECE:
            return self.encoder.plain(self.lead + piece)
        if len(self) >= MOST_PIECES:
            self.elder = dict(self)
            self.clear()
        ids = self.elder.pop(piece, None)
        if ids is None:
            ids = self._encoded(piece)
        self[piece] = ids
        return ids

    def _encoded(self, piece):
        if _is_word(piece):
            return self.encoder.word(self.lead + piece)
        if piece[-1:] in (",", ".") and _is_word(piece[:-1]):
            return self[piece[:-1]] + self.encoder.marks[piece[-1]]
        return self.encoder.plain(self.lead + piece)


class Encoder:
    def __init__(self, path):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.kind, self.swapped = "H" if self.dtype.itemsize == 2 else "I", sys.byteorder != "little"
        self.space = _byte_marks()[32]
        self.stand_in = str.maketrans({chr(b): c for b, c in _byte_marks().items()})
        self.marks = {c: self.plain(c) for c in ",.\n"}
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.firsts, self.others = _Pieces(self, ""), _Pieces(self, " ")

    def plain(self, text):
        return self._bytes(self.library.encode(text, add_special_tokens=False).ids)

    def _bytes(self, ids):
        return np.array(ids, self.dtype).tobytes() if self.swapped else array(self.kind, ids).tobytes()

    def word(self, text):
        """Ids of letters, perhaps after a space: the merges alone, without the splitter."""
        if text.isascii():
            marks = text.replace(" ", self.space)
        else:
            marks = text.encode().decode("latin-1").translate(self.stand_in)
        return self._bytes([t.id for t in self.library.model.tokenize(marks)])

    def encode(self, text):
        """The ids as little-endian numbers of ``dtype``, in bytes."""
        if self._awkward(text):
            first, *others = _SAFE_CUT.split(text)
            return self.firsts[first] + b"".join(map(self.others.__getitem__, others))
        return self.marks["\n"].join(map(self._line, text.split("\n")))

    def _line(self, text):
        first, *others = text.split(" ")
        return self.firsts[first] + b"".join(map(self.others.__getitem__, others))

    def _awkward(self, text):
        """Whether white space may meet in a token, or a special string end what comes before it."""
        return (
            "  " in text or " \n" in text or "\n " in text or "\n\n\n" in text
            or text.endswith("\n\n")
            or any(s in text for s in self.special)
            or _RARE_SPACE.search(text) is not None
        )


def encoder(path):
    """The worker's encoder of a vocabulary file, made once."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def forget():
    """Frees the worker's encoders and the pieces that they keep."""
    _ENCODERS.clear()


def ids_crc32(ids, dtype):
    """Checksum of ids, given as bytes of ``dtype``, in their form of 32 bits each."""
    import zlib

    return zlib.crc32(np.frombuffer(ids, dtype).astype("<u4").tobytes())
