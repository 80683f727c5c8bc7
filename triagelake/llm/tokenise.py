"""Token ids of whole texts with a cache of words.

The vocabulary splits at white space first, so a text's ids are those of its blank-separated
words in a row. A word is encoded when a worker first meets it and looked up afterwards. Words of
Latin letters, digits and signs are cut by the vocabulary's own pattern and their pieces go to its
BPE model directly; words with anything else take the tokenizer's whole path. Both give the ids
of the whole path over the whole text (tests compare them).
"""

from __future__ import annotations

import os
import re
from array import array
from functools import cache
from itertools import islice

import regex
from tokenizers import Tokenizer

from triagelake.llm.common import tokenizer_file

VOCABULARY = "word_bpe_49k.json"
#: Words and pieces kept by a worker; beyond it the older half stays, for frequent words come
#: early. Longer ones are not kept.
CACHED = 250_000
CACHED_LENGTH = 64
#: The vocabulary's pattern (fixed value).
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
PLAIN = re.compile("[!-~¡-ɏ]+")
#: The pattern's byte alphabet: printable Latin-1 stands for itself, the rest follows from U+0100.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTES = {b: chr(b) for b in _SHOWN}
BYTES |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in BYTES)}


class Encoder:
    def __init__(self, vocabulary: str = VOCABULARY, end: int = 1, id_bytes: int = 4):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(tokenizer_file(vocabulary))
        self.model = self.tokenizer.model
        self.kind = {2: "H", 4: "I"}[id_bytes]
        self.end = array(self.kind, [end]).tobytes()
        self.words: dict[str, bytes] = {"": b""}
        self.pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(BYTES)
            ids = array(self.kind, [t.id for t in self.model.tokenize(shown)]).tobytes()
            if len(piece) <= CACHED_LENGTH:
                self.pieces[piece] = ids
        return ids

    def _word(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            return self._piece(word.lower())
        if PLAIN.fullmatch(word) and "<|" not in word:
            return b"".join(map(self._piece, PIECES.findall(word.lower())))
        return array(self.kind, self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def __call__(self, text: str | None) -> bytes:
        """Little-endian unsigned ids of the text, ``id_bytes`` each, then the end id."""
        words = (text or "").replace("\n", " ").split(" ")
        if len(self.words) > CACHED:
            self.words = dict(islice(self.words.items(), CACHED // 2))
        if len(self.pieces) > CACHED:
            self.pieces = dict(islice(self.pieces.items(), CACHED // 2))
        known, long = self.words, []
        for word in set(words).difference(known):
            known[word] = self._word(word)
            if len(word) > CACHED_LENGTH:
                long.append(word)
        out = b"".join([*map(known.__getitem__, words), self.end])
        for word in long:
            del known[word]
        return out


@cache
def encoder(vocabulary: str = VOCABULARY, end: int = 1, id_bytes: int = 4) -> Encoder:
    """One encoder for each Python worker, kept from task to task."""
    return Encoder(vocabulary, end, id_bytes)
