"""Token ids of whole texts, word by word.

Both vocabularies cut a text at certain spaces before they merge anything, so the ids of a text are those of its
pieces in a row. Pieces recur, so a worker keeps the ids of those it has met of late in a bounded table and asks the
tokenizer for others only, a batch at a time.
"""

from __future__ import annotations

import gc
import os
import re
from array import array
from collections.abc import Collection, Iterator

import numpy as np

from assaylake.llm.common import single_thread

# Words and marks a worker remembers; about 170 bytes each. Workers outlive a query, so all they keep adds up.
MEMORY = 400_000
_BESIDE_SPACE = re.compile(r"\x20(?:\s|(?<=\s\x20))")
# A word, a mark, and the same again behind a line end: both vocabularies cut between these parts.
_SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]?)(?:(\n)([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]?))?")
_LETTERS = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")
_SINGLE_SPACE = re.compile(r"(?<=\S)\x20(?=\S)")


class Remembered:
    """A bounded table in two halves. What is asked for again moves to the newer one, and the older one is dropped for it when it is full."""

    def __init__(self):
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def find(self, words: Collection[str]) -> dict[str, bytes]:
        newer, older = self.newer, self.older
        found = {w: newer[w] for w in words if w in newer}
        if older and len(found) < len(words):
            again = {w: older[w] for w in words if w not in found and w in older}
            newer.update(again)
            found.update(again)
        return found

    def add(self, ids: dict[str, bytes]) -> None:
        self.newer.update(ids)

    def age(self, most: int) -> None:
        if len(self.newer) > most // 2:
            self.newer, self.older = {}, self.newer


class PieceTokenizer:
    """Ids as packed little-endian bytes of ``width`` each."""

    def __init__(self, path: str, width: int):
        single_thread()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Names of added tokens stand for one id wherever they occur, so a text that holds one is encoded whole.
        names = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.named = re.compile("|".join(map(re.escape, names)) or "(?!)", re.IGNORECASE)
        # What all names begin with, up to a letter: a plain search for it rules out nearly every text.
        self.sign = re.match("[^a-z]*", os.path.commonprefix([n.lower() for n in names]))[0]
        self.code = {2: "H", 4: "I"}[width]
        # A vocabulary that keeps spaces gives a piece together with the space before it.
        self.keeps_space = len(self.ids([" a"])[0]) != len(self.ids(["a"])[0]) or self.ids([" a"]) != self.ids(["a"])
        # Ids of words and marks, and of words behind a space where that belongs to them.
        self.known, self.spaced = Remembered(), Remembered()
        # Tokens that begin (spaces kept) or end (spaces dropped) a word.
        edge = str.startswith if self.keeps_space else str.endswith
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.edges = np.zeros(max(vocabulary.values()) + 1, bool)
        self.edges[[i for token, i in vocabulary.items() if edge(token, "Ġ" if self.keeps_space else "</w>")]] = True

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, text: str) -> list[str]:
        """The text at spaces that surely end a piece: those between two characters that are no white space."""
        if self.keeps_space and _BESIDE_SPACE.search(text):
            return _SINGLE_SPACE.split(text)
        return text.split(" ")  # where white space is dropped, any space does

    def _words(self, words: list[str]) -> Iterator[bytes]:
        """Ids of words of letters: they are encoded as texts of many words and told apart by their edge tokens."""
        runs = [words[i : i + 500] for i in range(0, len(words), 500)]
        texts = [("" if self.keeps_space else " ").join(run) for run in runs]
        for run, ids in zip(runs, self.ids(texts)):
            ids = np.array(ids, np.dtype(self.code))
            cuts = np.flatnonzero(self.edges[ids])
            ends = [*cuts[1:].tolist(), len(ids)] if self.keeps_space else (cuts + 1).tolist()
            if len(ends) != len(run):
                raise ValueError("words and edge tokens differ in number")
            packed, begin = ids.tobytes(), 0
            for end in ends:
                yield packed[begin * ids.itemsize : end * ids.itemsize]
                begin = end

    def _encode(self, new: list[str]) -> list[bytes]:
        found = {}
        words = [x for x in new if len(x) > 1 and x[0].isspace() == self.keeps_space and _LETTERS.fullmatch(x)]
        found.update(zip(words, self._words(words)))
        rest = [x for x in new if x not in found]
        found.update((x, array(self.code, ids).tobytes()) for x, ids in zip(rest, self.ids(rest)))
        return [found[x] for x in new]

    def _ids_of(self, pieces: set[str], lead: str) -> dict[str, bytes]:
        """Ids of pieces behind ``lead``; a word with its marks is put together from parts, and parts are remembered."""
        own = self.spaced if lead else self.known
        own.age(MEMORY)
        found = own.find(pieces)
        rows = {p: m.groups("") if (m := _SIMPLE.fullmatch(p)) else (p,) for p in pieces if p not in found}
        heads = self._parts({row[0] for row in rows.values()}, own, lead)
        tails = self._parts({x for row in rows.values() for x in row[1:]}, self.known, "")
        for p, row in rows.items():
            found[p] = heads[row[0]] if len(row) == 1 else heads[row[0]] + b"".join(map(tails.__getitem__, row[1:]))
        return found

    def _parts(self, parts: set[str], own: Remembered, lead: str) -> dict[str, bytes]:
        found = own.find(parts)
        new = [x for x in parts if x not in found]
        encoded = dict(zip(new, self._encode([lead + x for x in new])))
        own.add(encoded)
        found.update(encoded)
        return found

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The packed ids of each text."""
        for begin in range(0, len(texts), 512):
            block = texts[begin : begin + 512]
            whole = {x for x in block if self.sign in x and self.named.search(x)}
            apart = dict(zip(whole, (array(self.code, ids).tobytes() for ids in self.ids(list(whole))))) if whole else {}
            gc.disable()  # nothing here forms cycles, and each collection would walk the whole table
            try:
                rows = [self._pieces("" if t in whole else t) for t in block]
                first = self._ids_of({row[0] for row in rows}, "")
                rest = [row[1:] for row in rows]
                found = self._ids_of(set().union(*rest), " " if self.keeps_space else "")
                packed = [
                    apart[t] if t in whole else first[row[0]] + b"".join(map(found.__getitem__, others))
                    for t, row, others in zip(block, rows, rest)
                ]
            finally:
                gc.enable()
            yield from packed


_LOADED: dict[tuple[str, int], PieceTokenizer] = {}


def tokenizer(path: str, width: int) -> PieceTokenizer:
    """One per worker process: workers are reused, and so is what they remember."""
    if (path, width) not in _LOADED:
        _LOADED[path, width] = PieceTokenizer(path, width)
    return _LOADED[path, width]
