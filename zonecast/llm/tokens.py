"""Whole-text tokenisation with the ``tokenizers`` library and bounded memos.

Byte-pair merges never cross the pre-tokeniser's pieces, so a text can be cut at
safe blanks, each distinct word split into pieces, each distinct piece merged once
by the library's model, and the ids joined again.  A text that spells an added token
(``<|endoftext|>``) gets that token's id there, as the library gives it; the text
between such tokens is encoded on its own.  The memos live as long as the
Python worker and hold at most ``WORDS`` words and ``PIECE_BYTES`` of pieces, also within one text, and no
word over ``LONG`` letters, which bounds both in bytes; they change the time, never the
ids.  Texts with unusual blanks, and words beyond plain Latin letters, go through
the library's full encoder.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

#: longest word or piece (letters) that is remembered, and an entry's bytes beside its letters and ids
LONG, _ENTRY = 32, 210
#: the words' memo by entries, of at most _ENTRY + LONG * (4 + 16) bytes each: 213 MB, about 60 MB with
#: ordinary words; the pieces' memo by bytes
WORDS, PIECE_BYTES = 250_000, 160 << 20
#: ASCII marks that end a word
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: blanks other than space and newline, which the library and Python may class differently
_RARE_BLANK = re.compile("[" + "".join(map(chr, (
    0, 9, 11, 12, 13, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
))) + "]")

# The Latin letters and numbers (up to U+017F) for which the piece patterns are used here.
_L = "A-Za-zªµºÀ-ÖØ-öø-ſ"
_N = "0-9²³¹¼-¾"
_PLAIN = re.compile("[!-~\n¡-¬®-ſ]*\\Z")

# The two tokenizers' piece patterns.
_PIECES = {
    "leading": re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+"),
    "dropped": re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\s{_L}{_N}]+"),
}


def _byte_letters() -> dict[int, int]:
    """Byte-level alphabet: printable Latin-1 stands for itself, other bytes follow from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {b: b for b in own} | {b: 256 + k for k, b in enumerate(others)}


_LETTERS = _byte_letters()
_LOADED: dict[tuple[str, str], "WordMemo"] = {}


class _Memo(dict):
    """Results of ``make``, emptied at ``most`` entries; long words are not remembered."""

    def __init__(self, make, most: int):
        self.make, self.most = make, most

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= LONG:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


def _lower(text: str) -> str:
    """Letter by letter, as the library does (no rule for a sigma at a word's end)."""
    return text.lower() if text.isascii() else "".join(c.lower() for c in text)


class WordMemo:
    """Texts to ids; ``style`` 'leading' keeps the space before a word with the word
    (byte-level pieces), 'dropped' is for lower-casing tokenizers that discard blanks."""

    def __init__(self, path: str, style: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.merge = self.tok.model.tokenize
        self.style = style
        self.find = _PIECES[style].findall
        self.words = _Memo(self.word, WORDS)
        self.pieces: dict[str, bytes] = {}
        self.piece_bytes = 0
        added = self.tok.get_added_tokens_decoder()
        # tokens that match as they are written, with nothing around them taken in
        plain = not any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in added.values())
        self.added = {t.content: np.asarray([i], "<u4").tobytes() for i, t in added.items()} if plain else None
        longest_first = sorted((t.content for t in added.values()), key=len, reverse=True)
        self.split = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")").split if added else None
        self.literals = longest_first

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def cut(self, text: str) -> list[str] | None:
        """Words that can be encoded one by one; None if a cut could move a piece's border."""
        if self.style == "dropped":
            return text.replace("\n", " ").split(" ")
        if ("  " in text or "\n \n" in text or text[:1].isspace() or text[-1:].isspace()
                or _RARE_BLANK.search(text)):
            return None
        # a word with no space before it is marked by a zero character, which the text has not
        if "\n" in text and "\n\n" not in text and " \n" not in text and "\n " not in text:
            text = text.replace("\n", " \0\n \0")  # a lone line end is a piece of its own
        words = text.split(" ")
        words[0] = "\0" + words[0]
        return words

    def piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            letters = piece.encode().decode("latin-1").translate(_LETTERS)
            ids = array("I", [t.id for t in self.merge(letters)]).tobytes()
            n = len(piece)
            if n <= LONG:
                self.piece_bytes += _ENTRY + 4 * n + len(ids)
                if self.piece_bytes > PIECE_BYTES:
                    self.pieces.clear()
                    self.piece_bytes = _ENTRY + 4 * n + len(ids)
                self.pieces[piece] = ids
        return ids

    def word(self, word: str) -> bytes:
        letters = word.rstrip(_MARKS)
        if letters.isalpha() and _PLAIN.match(letters):
            # letters and perhaps one run of marks: two pieces at most
            if self.style == "leading":
                first = self.piece(" " + letters)
            else:
                first = self.piece(_lower(letters))
            return first if len(letters) == len(word) else first + self.piece(word[len(letters):])
        if self.style == "leading":
            text = word[1:] if word[:1] == "\0" else " " + word
        else:
            text = word
        if not _PLAIN.match(text[1:] if text[:1] == " " else text):
            return self.whole(text)
        if self.style == "dropped":
            text = _lower(text)
        return b"".join(map(self.piece, self.find(text)))

    def plain(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        words = self.cut(text)
        return self.whole(text) if words is None else b"".join(map(self.words.__getitem__, words))

    def one(self, text: str) -> bytes:
        if self.added is None:
            return self.whole(text)
        if not any(t in text for t in self.literals):
            return self.plain(text)
        # odd places hold the added tokens
        return b"".join(self.added[t] if k % 2 else self.plain(t) for k, t in enumerate(self.split(text)) if t)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        return [self.one(text) for text in texts]


def tokenizer(path: str, style: str) -> WordMemo:
    if (path, style) not in _LOADED:
        _LOADED[path, style] = WordMemo(path, style)
    return _LOADED[path, style]
