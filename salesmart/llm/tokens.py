"""Token ids of whole texts by a tokenizer file of the tokenizers library.

The tokenizers library spends most of its time on offsets and on words it has seen before. Both files
used here split texts at white space before they merge, so ids of a text are the ids of
its words in a row: words are looked up, and each new word is encoded once by the
library's own model. A text on which that splitting could matter goes to the library whole.
"""

import os
import re
import unicodedata
from array import array

import regex

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Splitting of words in the two tokenizer files.
BYTE_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LOWER_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Characters that Python takes for white space and the tokenizers do not.
ODD_SPACE = re.compile("[\x1c-\x1f]")
MOST_WORDS = 200_000  # words remembered in a worker; only a matter of speed


def byte_letters() -> list[str]:
    """The letter that stands for each byte in vocabularies of bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


_LETTERS = byte_letters()


class Encoder:
    """Ids as bytes (unsigned 32-bit, little-endian) of texts, equal to the library's.

    Strings of special tokens in a text become those tokens, as the library has it.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        added = self._whole.get_added_tokens_decoder().values()
        self._special = [t.content.lower() for t in added]
        # What all of them begin with, as far as it has no letters: "<|" in both files.
        self._sign = re.match(r"[^\w\s]*", os.path.commonprefix(self._special)).group()
        self._model = self._whole.model
        self._lower = self._whole.normalizer is not None
        self._split = regex.compile(LOWER_WORDS if self._lower else BYTE_WORDS).findall
        self._words: list[dict[str, bytes]] = [{}, {}]
        self._firsts: list[dict[str, bytes]] = [{}, {}]
        self._ends = {mark: self._part(mark) for mark in ".,"}
        self._break = self.library("\n")

    def library(self, text: str) -> bytes:
        ids = self._whole.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def _part(self, part: str) -> bytes:
        """Ids of what the pattern of the file leaves whole."""
        if part.isascii():
            letters = part.replace(" ", _LETTERS[32])
        else:
            letters = "".join([_LETTERS[b] for b in part.encode()])
        return array("I", [t.id for t in self._model.tokenize(letters)]).tobytes()

    def _unseen(self, word: str, space: str) -> bytes:
        """Ids of a word with what stands before it."""
        if self._lower:
            if "\u03a3" in word or not unicodedata.is_normalized("NFC", word):
                return self.library(word)
            word = word.lower()
        if word.isalpha():
            return self._part(space + word)
        if word.isprintable():
            return b"".join([self._part(p) for p in self._split(space + word)])
        return self.library(space + word)

    def _ids(self, words: list[str], space: str, known: list[dict[str, bytes]]) -> list[bytes]:
        recent = known[0]
        if len(recent) > MOST_WORDS // 2:
            # Words in use come back from the older half; the others are forgotten with it.
            known[:] = {}, recent
            recent = known[0]
        return [recent.get(w) or self._recalled(w, space, known) for w in words]

    def _recalled(self, word: str, space: str, known: list[dict[str, bytes]]) -> bytes:
        recent, older = known
        ids = older.get(word)
        if ids is None:
            start = None
            if word[-1] in ".," and word[:-1].isalpha() and "\u0130" not in word:
                start = recent.get(word[:-1]) or older.get(word[:-1])
            ids = self._unseen(word, space) if start is None else start + self._ends[word[-1]]
        recent[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if self._sign in text and any(s in text.lower() for s in self._special):
            return self.library(text)
        words = text.split()
        if self._lower:
            if ODD_SPACE.search(text):
                return self.library(text)
            return b"".join(self._ids(words, "", self._words))
        if not words or " ".join(words) != text.replace("\n", " "):
            return self.library(text)
        # One space or one line end between words: a word keeps its space, a line end is
        # a part of its own.
        ids = self._ids(words, " ", self._words)
        place = 0
        for line in text.split("\n"):
            first = self._ids([words[place]], "", self._firsts)[0]
            ids[place] = self._break + first if place else first
            place += line.count(" ") + 1
        return b"".join(ids)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a file, one per worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
