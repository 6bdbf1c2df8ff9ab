"""Token ids of a public byte-level vocabulary, with a bounded cache of the pieces between white space.

The vocabulary splits a text before any merge, always before a blank that a visible character follows.
So the ids of a text are those of its pieces, and a piece that was seen needs no second look.
Texts with two white-space characters in a row are split by the vocabulary's own pattern instead.
"""

from __future__ import annotations

import os
import re
import string
from array import array
from collections.abc import Callable, Iterable
from itertools import compress, repeat
from operator import is_

import numpy as np

CACHE_KEYS = 400_000
WHITE_RUN = re.compile(r"\s\s")
# The byte-level alphabet by its rule: a byte that prints stands for itself, the others for the characters from 256 on.
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
LETTERS = {b: 256 + i for i, b in enumerate(sorted({*range(256)} - {*PRINTED}))}
BLANK = chr(LETTERS[32])


def vocabulary_path(name: str) -> str:
    """Place of a vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def blank_pieces(text: str) -> list[str]:
    """Cut before each blank and each line feed; joined, the pieces are the text."""
    first, *rest = text.replace("\n", " \n").split(" ")
    pieces = [x if x[:1] == "\n" else " " + x for x in rest]
    return [first, *pieces] if first else pieces


class Generations:
    """A bounded cache: when the young part is full it becomes the old part, and what is used again moves back."""

    def __init__(self, keys: int):
        self.young, self.old, self.keys = {}, {}, keys

    def values(self, wanted: list[str], make: Callable[[list[str]], Iterable]) -> list:
        """The value of each wanted key; `make` gives those of keys that neither part has."""
        found = list(map(self.young.get, wanted))
        places = list(compress(range(len(found)), map(is_, found, repeat(None))))
        if not places:
            return found
        new = {wanted[i] for i in places}
        if len(self.young) + len(new) > self.keys:
            self.old, self.young = self.young, {}
            places, new = range(len(found)), set(wanted)
        kept = {x: self.old[x] for x in new if x in self.old}
        fresh = [x for x in new if x not in kept]
        self.young.update(kept)
        self.young.update(zip(fresh, make(fresh), strict=True))
        for i in places:
            found[i] = self.young[wanted[i]]
        return found


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes; equal to the tokenizer's own, special names as plain text.

    In the usual text no white-space characters stand side by side. With a line feed put before it, it is cut at blanks and before
    line feeds; a key without a line feed stands for a blank and the key.
    """

    def __init__(self, path: str, cache_keys: int = CACHE_KEYS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.model = self.tokenizer.model
        self.by_word = isinstance(self.tokenizer.pre_tokenizer, ByteLevel) and self.tokenizer.normalizer is None
        self.signs: dict[str, bytes] = {}
        self.usual, self.other = Generations(cache_keys), Generations(cache_keys // 4)
        feed = self._direct(["\n"])[0]
        self.feed = feed[0] if len(feed) == 1 else None
        self.feed_bytes = array("I", feed).tobytes()

    def _direct(self, pieces: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _other_ids(self, pieces: list[str]) -> list[bytes]:
        return [np.array(ids, "<u4").tobytes() for ids in self._direct(pieces)]

    def _word_ids(self, word: str, blank: bool = False) -> bytes:
        """Ids of one piece of the vocabulary's pattern, by the tokenizer's model alone; `blank` stands before the word."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(LETTERS)
        return array("I", [x.id for x in self.model.tokenize(BLANK + word if blank else word)]).tobytes()

    def _usual_ids(self, keys: list[str]) -> list[bytes]:
        """A word and the signs behind it are looked up as two pieces, so a word is merged once whatever follows it."""
        out: list = [None] * len(keys)
        made: dict[str, bytes] = {}
        for i, key in enumerate(keys):
            feed, word, signs = key[:1] == "\n", key[1:] if key[:1] == "\n" else key, ""
            if not word.isalpha():  # letters alone are one piece
                word, whole = word.rstrip(string.punctuation), word
                signs = whole[len(word) :]
            if not self.by_word or not word.isalpha():
                continue
            if feed:
                ids = self.feed_bytes + self._word_ids(word)
            elif (ids := made.get(word) or self.usual.young.get(word)) is None:
                ids = made[word] = self._word_ids(word, blank=True)
            if signs:
                if (tail := self.signs.get(signs)) is None:
                    tail = self._word_ids(signs)
                    if len(self.signs) < CACHE_KEYS // 10:
                        self.signs[signs] = tail
                ids += tail
            out[i] = ids
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(rest, self._other_ids([keys[i] if keys[i][:1] == "\n" else " " + keys[i] for i in rest]), strict=True):
            out[i] = ids
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list = [None] * len(texts)
        usual, keys = [], []
        for i, text in enumerate(texts):
            text = "\n" + text
            if self.feed is None or WHITE_RUN.search(text):
                out[i] = b"".join(self.other.values(self.split(texts[i]), self._other_ids))
                continue
            keys += text.replace("\n", " \n").split(" ")[1:]
            usual.append((i, len(keys)))
            if len(keys) > 50_000 or i == len(texts) - 1:
                self._join(usual, keys, out)
                usual, keys = [], []
        self._join(usual, keys, out)
        return out

    def _join(self, usual: list[tuple[int, int]], keys: list[str], out: list) -> None:
        found, start = self.usual.values(keys, self._usual_ids), 0
        for i, end in usual:
            out[i] = b"".join(found[start:end])[4:]
            start = end
