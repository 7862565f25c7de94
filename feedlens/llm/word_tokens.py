"""Token ids of whole texts, put together from the ids of their words.

Both tokenizers used here never join a word to the space after it: the byte-level one cuts a text so that a
single space opens the word it stands before, and the piece model has no piece with a space inside or at the end (checked when it is loaded).
A text can therefore be cut before every single space between two signs that are no white space, and
each part be encoded by itself, most of them once per worker. Texts of other white space are cut only where that holds.
"""

from __future__ import annotations

import re
from collections import ChainMap
from collections.abc import Callable

import numpy as np

_RUNS = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S)(?= \S)")
#: A part that may be encoded beside others: it opens with a space before a sign, and ends with a sign.
_PLAIN = re.compile(r" \S(?:.*\S)?\Z", re.DOTALL)
#: Words remembered by a worker, and the longest of them.
MOST_WORDS, LONGEST = 1 << 18, 64
#: New words encoded as one text.
TOGETHER = 1000


def parts(text: str) -> list[str]:
    """The text cut before single spaces; joined again they are the text."""
    if not text:
        return []
    if text[-1].isspace() or _RUNS.search(text):
        return _CUT.split(text)
    first, *others = text.split(" ")
    return ([first] if first else []) + [" " + word for word in others]


class WordTokens:
    """Ids of texts by remembered ids of their words.

    ``encode`` maps texts to their lists of ids; ``token_bytes`` holds the bytes of every id. New words are encoded
    many at once, as one text, and told apart by the tokens' lengths; where that does not give the words back, one by one.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], token_bytes: list[bytes], cut: bool = True) -> None:
        self.encode, self.token_bytes, self.cut = encode, token_bytes, cut
        self.lengths = np.array([len(own) for own in token_bytes], np.int64)
        # Two generations: words not met again while ``known`` filled up are forgotten.
        self.known: dict[str, bytes | None] = {}
        self.older: dict[str, bytes | None] = {}

    def _alone(self, words: list[str]) -> dict[str, bytes | None]:
        """Packed ids of the words; None where they do not stand for exactly the word."""
        found = {}
        for word, ids in zip(words, self.encode(words), strict=True):
            good = b"".join([self.token_bytes[number] for number in ids]) == word.encode()
            found[word] = np.array(ids, np.uint32).tobytes() if good else None
        return found

    def _together(self, words: list[str]) -> dict[str, bytes | None]:
        text = "".join(words)
        ids = np.array(self.encode([text])[0], np.uint32)
        ends = np.cumsum(self.lengths[ids])
        word_ends = np.cumsum([len(word.encode()) for word in words])
        last = np.searchsorted(ends, word_ends)
        if not len(ids) or ends[-1] != word_ends[-1] or (ends[last] != word_ends).any():
            return self._alone(words)
        if b"".join([self.token_bytes[number] for number in ids]) != text.encode():
            return self._alone(words)
        starts = np.concatenate([[0], last[:-1] + 1])
        return {word: ids[start:end + 1].tobytes() for word, start, end in zip(words, starts, last, strict=True)}

    def _learn(self, words: list[str]) -> dict[str, bytes | None]:
        plain = [word for word in words if self.cut and _PLAIN.match(word)]
        found = {}
        for start in range(0, len(plain), TOGETHER):
            found.update(self._together(plain[start:start + TOGETHER]))
        others = [word for word in words if word not in found]
        return {**found, **self._alone(others)} if others else found

    def ids(self, text: str) -> np.ndarray | None:
        """The text's ids, or None if they do not stand for exactly the text."""
        return self.many([text])[0]

    def many(self, texts: list[str]) -> list[np.ndarray | None]:
        cut = [parts(text) if self.cut else [text] if text else [] for text in texts]
        if len(self.known) > MOST_WORDS:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        new = {word for words in cut for word in words}.difference(known)
        again = new.intersection(older)
        known.update((word, older[word]) for word in again)
        new = list(new.difference(again))
        if new:
            learned = self._learn(new)
            self.known.update((word, ids) for word, ids in learned.items() if len(word) <= LONGEST)
            if any(len(word) > LONGEST for word in new):
                known = ChainMap(learned, self.known)
        packed = [list(map(known.__getitem__, words)) for words in cut]
        return [None if None in own else np.frombuffer(b"".join(own), np.uint32) for own in packed]


def byte_level_table(vocabulary: dict[str, int]) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary, whose entries write each byte as one printable sign."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in set(printable)]
    signs = {chr(byte): byte for byte in printable} | {chr(256 + place): byte for place, byte in enumerate(others)}
    table = [b""] * (max(vocabulary.values()) + 1)
    for entry, number in vocabulary.items():
        table[number] = bytes([signs[sign] for sign in entry])
    return table
