"""Token ids of words under public vocabularies, each distinct word encoded once per worker."""

from __future__ import annotations

from array import array
from collections.abc import Callable
from itertools import chain

import numpy as np

#: Most words and most pieces of words in a generation of what a table of the second kind remembers.
WORDS, PIECES = 450_000, 200_000


class TokenTable(dict):
    """Words seen by a worker process: number, and token ids.

    For vocabularies whose tokens never cross the blanks that words are cut
    at.  Subclasses encode the new words of a text in one call.
    """

    def __init__(self, size: int = 250_000):
        super().__init__()
        self.size = size
        self._reset()

    def _reset(self):
        self.clear()
        self.tokens, self.n_tokens = np.empty(1 << 16, np.int32), 0
        self.starts, self.lengths = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def encode(self, words: list) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each word has."""
        raise NotImplementedError

    def _learn(self, words: list) -> None:
        flat, lengths = self.encode(words)
        first, last = len(self), len(self) + len(words)
        while self.n_tokens + len(flat) > len(self.tokens):
            self.tokens = np.resize(self.tokens, 2 * len(self.tokens))
        while last > len(self.starts):
            size = 2 * len(self.starts)
            self.starts, self.lengths = np.resize(self.starts, size), np.resize(self.lengths, size)
        self.tokens[self.n_tokens : self.n_tokens + len(flat)] = flat
        self.starts[first:last] = self.n_tokens + np.cumsum(lengths) - lengths
        self.lengths[first:last] = lengths
        self.n_tokens += len(flat)
        self.update(zip(words, range(first, last)))

    def numbers(self, words: list) -> np.ndarray:
        """A number per word, valid until the next call: a full table starts anew."""
        if len(self) >= self.size:
            self._reset()
        if new := [w for w in set(words) if w not in self]:
            self._learn(new)
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def ids(self, numbers: np.ndarray) -> np.ndarray:
        """The token ids of numbered words, one after another."""
        lengths = self.lengths[numbers]
        total = int(lengths.sum())
        first = np.repeat(self.starts[numbers] - np.cumsum(lengths) + lengths, lengths)
        return self.tokens[first + np.arange(total)]


class PieceTable(TokenTable):
    """A sentencepiece vocabulary with byte fallback; words are UTF-8 without ASCII white space."""

    def __init__(self, model: str):
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=model)
        every = range(self.pieces.get_piece_size())
        self.is_byte = np.array([self.pieces.is_byte(i) for i in every])
        self.opens = np.array([self.pieces.id_to_piece(i).startswith("▁") for i in every])
        super().__init__()

    def encode(self, words):
        texts = [w.decode("utf-8", "replace") for w in words]
        flat = np.array(self.pieces.encode(" ".join(texts)), np.int32)
        begins = np.flatnonzero(self.opens[flat])
        if len(begins) == len(words) and begins[0] == 0:
            return flat, np.diff(np.r_[begins, len(flat)])
        each = self.pieces.encode(texts, num_threads=1)  # a word has the vocabulary's blank sign itself
        lengths = np.fromiter(map(len, each), np.int64, len(each))
        return np.fromiter(chain.from_iterable(each), np.int32, int(lengths.sum())), lengths


class Recent(dict):
    """Values of ``make(key)``, kept for the keys that were asked for lately.

    Two generations of at most ``size`` keys: a key that is asked for moves to
    the newer one, and a full newer one takes the place of the older.  So what
    is frequent stays, however many rare keys pass through.
    """

    def __init__(self, make: Callable, size: int):
        super().__init__()
        self.make, self.size, self.older = make, size, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class WordBpeTable:
    """A tokenizers file that drops white space; texts are cut at blanks and line ends.

    A word's ids are bytes (32-bit integers), so that those of a text are one
    join.  Words of plain Latin letters are split and merged piece by piece,
    pieces being fewer than words; any other word goes through the whole
    tokenizer.
    """

    def __init__(self, path: str, words: int = WORDS, pieces: int = PIECES):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # Fixed value: the vocabulary's own split, with its white space written out.
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\t\n\v\f\r \x85\xa0\p{L}\p{N}]+")
        self.letters = byte_letters()
        self.words, self.pieces = Recent(self._word, words), Recent(self._piece, pieces)

    def _piece(self, piece: str) -> bytes:
        text = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        return array("i", [t.id for t in self.model.tokenize(text)]).tobytes()

    def _word(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            return self.pieces[word.lower()]
        if word and (max(word) > "ɏ" or min(word) < "!" or "<|" in word or "\x7f" in word):
            return array("i", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.pieces.__getitem__, self.split.findall(word.lower())))

    def of_text(self, text: str | None) -> np.ndarray:
        words = (text or "").replace("\n", " ").split(" ")
        return np.frombuffer(b"".join(map(self.words.__getitem__, words)), np.int32)


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(others)}
