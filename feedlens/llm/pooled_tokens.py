"""Token ids of many whole texts at once by a byte-level tokenizer, put together from the ids of their parts.

The tokenizer cuts a text by the pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`` and encodes each match
by itself. Some cuts are there whatever stands around them: before a single space and around a single newline between two signs
that are no white space, and between an ASCII letter or digit and ASCII punctuation other than an apostrophe. A text is
cut at these alone, so that a part's ids are the same wherever it stands. Signs of a kind that bytes do not tell (white space
beyond ASCII is among those of U+0080 to U+00BF and from U+0800 on) are not cut at. A text that holds an added token, or of a tokenizer
without this pattern, is one part.

Parts of up to 15 bytes are two integers each and looked up by numpy; Arrow tells the others and the new ones apart. Each different new part is
encoded once, and the texts' ids are gathered from a pool.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from feedlens.llm.repair import gather

#: Parts remembered by a worker, the ids of their pool, and the bytes of the longest of them.
MOST_PARTS, MOST_IDS, LONGEST = 1 << 20, 1 << 23, 64
#: New parts encoded as one text.
TOGETHER = 1000
#: Bytes cut and parts looked up or gathered at once.
BYTES_CUT, GATHERED = 1 << 18, 1 << 18
#: Longest part, in bytes, that is held as two integers, the last byte of which is its length.
NARROW = 15

_WORD, _MARK, _APOSTROPHE, _SPACE, _NEWLINE, _LEAD, _REST = 1, 2, 4, 8, 16, 32, 64
_KIND = np.zeros(256, np.uint8)
_KIND[33:127] = _MARK
for _first, _last in (b"09", b"AZ", b"az"):
    _KIND[_first:_last + 1] = _WORD
_KIND[ord("'")] = _APOSTROPHE
_KIND[ord(" ")] = _SPACE
_KIND[ord("\n")] = _NEWLINE
# U+00C0 to U+07FF, none of them white space.
_KIND[0xC3:0xE0] = _LEAD
_KIND[0x80:0xC0] = _REST
_MASKS = np.array([(1 << 8 * size) - 1 for size in range(9)], np.uint64)
_SPREADS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93], np.uint64)
_ASCII_SIGN = _WORD | _MARK | _APOSTROPHE


def cut_places(data: np.ndarray) -> np.ndarray:
    """Whether UTF-8 bytes may be cut before each byte."""
    kind = _KIND[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = (kind[1:] ^ kind[:-1]) == _WORD | _MARK
    blanks = np.flatnonzero(kind & (_SPACE | _NEWLINE))
    blanks = blanks[(blanks > 1) & (blanks < len(data) - 1)]
    last = kind[blanks - 1]
    between = (last & _ASCII_SIGN != 0) | (last == _REST) & (kind[blanks - 2] == _LEAD)
    between &= kind[blanks + 1] & (_ASCII_SIGN | _LEAD) != 0
    blanks = blanks[between]
    cut[blanks] = True
    cut[blanks[kind[blanks] == _NEWLINE] + 1] = True
    return cut[:-1]


def _layout(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of strings and their bytes, both from 0."""
    kind = np.int64 if pa.types.is_large_string(strings.type) else np.int32
    offsets = np.frombuffer(strings.buffers()[1], kind)[strings.offset:strings.offset + len(strings) + 1].astype(np.int64)
    held = strings.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0]:offsets[-1]] if held is not None and held.size else np.zeros(0, np.uint8)
    return offsets - offsets[0], data


def narrow_keys(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parts of up to ``NARROW`` bytes as two integers, different for different parts. ``data`` has 16 bytes beyond the parts."""
    eights = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    low = eights[starts] & _MASKS[np.minimum(sizes, 8)]
    high = eights[starts + 8] & _MASKS[np.clip(sizes - 8, 0, 7)]
    return low, high | sizes.astype(np.uint64) << np.uint64(56)


class PartTable:
    """Numbers of narrow parts: slots of numbers, and the parts' keys by number (0 for numbers that are not found here)."""

    def __init__(self, low: np.ndarray, high: np.ndarray) -> None:
        self.low, self.high = low[:0], high[:0]
        self.slots = np.full(1 << 10, -1, np.int32)
        self.add(low, high)

    def _home(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        mixed = low * _SPREADS[0] ^ high * _SPREADS[1]
        mixed ^= mixed >> np.uint64(29)
        return (mixed * _SPREADS[2] >> np.uint64(65 - len(self.slots).bit_length())).astype(np.int64)

    def _place(self, numbers: np.ndarray) -> None:
        places = self._home(self.low[numbers], self.high[numbers])
        while len(numbers):
            free = self.slots[places] < 0
            self.slots[places[free]] = numbers[free]
            others = self.slots[places] != numbers
            numbers, places = numbers[others], places[others] + 1 & len(self.slots) - 1

    def add(self, low: np.ndarray, high: np.ndarray) -> None:
        """Number new keys, none of them held, from the last number on."""
        numbers = np.arange(len(self.low), len(self.low) + len(low), dtype=np.int32)
        self.low, self.high = np.concatenate([self.low, low]), np.concatenate([self.high, high])
        if 2 * len(self.low) > len(self.slots):
            self.slots = np.full(1 << (2 * len(self.low)).bit_length(), -1, np.int32)
            numbers = np.arange(len(self.low), dtype=np.int32)
        self._place(numbers[self.high[numbers] > 0])

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The keys' numbers, or -1."""
        places = self._home(low, high)
        numbers = self.slots[places]
        look = np.flatnonzero((numbers >= 0) & ((self.low[numbers] != low) | (self.high[numbers] != high)))
        while len(look):
            places[look] = places[look] + 1 & len(self.slots) - 1
            found = numbers[look] = self.slots[places[look]]
            look = look[(found >= 0) & ((self.low[found] != low[look]) | (self.high[found] != high[look]))]
        return numbers


class PooledTokens:
    """Ids of texts by remembered ids of their parts, an end id after each text.

    ``encode`` maps texts to their lists of ids; ``token_bytes`` holds the bytes of every id; ``added`` are the tokens found in whole
    texts before these are cut. With ``cut`` false every text is one part.
    """

    def __init__(
        self, encode: Callable[[list[str]], list[list[int]]], token_bytes: list[bytes], added: list[str], end_id: int, cut: bool = True
    ) -> None:
        self.encode, self.added, self.cut = encode, added, cut
        self.widths = np.array([len(own) for own in token_bytes], np.int64)
        self.token_data = np.frombuffer(b"".join(token_bytes), np.uint8)
        self.token_starts = np.cumsum(self.widths) - self.widths
        # Numbers of parts that are not narrow.
        self.known: dict[str, int] = {}
        # Part 0 is the end of a text.
        self.pool = np.array([end_id], np.uint32)
        self.starts, self.lengths, self.uses = np.zeros(1, np.int64), np.ones(1, np.int64), np.zeros(1, np.int64)
        self.table = PartTable(np.zeros(1, np.uint64), np.zeros(1, np.uint64))

    def _forget(self) -> None:
        """Drop the less used half of the parts, and those not remembered."""
        numbers = np.concatenate([np.flatnonzero(self.table.high), np.fromiter(self.known.values(), np.int64, len(self.known))])
        if len(numbers) > MOST_PARTS // 2:
            # The later one first among parts of as many uses.
            order = np.argpartition(self.uses[numbers] * len(self.starts) + numbers, len(numbers) - MOST_PARTS // 2)
            numbers = numbers[order[len(numbers) - MOST_PARTS // 2:]]
        numbers = np.concatenate([[0], np.sort(numbers)])
        renumbered = np.full(len(self.starts), -1, np.int64)
        renumbered[numbers] = np.arange(len(numbers))
        self.known = {part: int(renumbered[number]) for part, number in self.known.items() if renumbered[number] >= 0}
        self.table = PartTable(self.table.low[numbers], self.table.high[numbers])
        self.pool = gather(self.pool, self.starts[numbers], self.lengths[numbers])
        self.lengths, self.uses = self.lengths[numbers], self.uses[numbers] // 2
        self.starts = np.cumsum(self.lengths) - self.lengths

    def _add(self, parts: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> None:
        """Add parts by the ids that stand for them one after another. Long ones are numbered, but not remembered."""
        ends, data = _layout(parts)
        sizes = np.diff(ends)
        low, high = narrow_keys(np.concatenate([data, np.zeros(16, np.uint8)]), ends[:-1], sizes)
        high[sizes > NARROW] = 0
        wide = np.flatnonzero((sizes > NARROW) & (sizes <= LONGEST))
        self.known.update(zip(parts.take(pa.array(wide)).to_pylist(), (wide + len(self.starts)).tolist(), strict=True))
        self.table.add(low, high)
        self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(lengths) - lengths])
        self.pool = np.concatenate([self.pool, ids])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.uses = np.concatenate([self.uses, np.zeros(len(parts), np.int64)])

    def _together(self, data: bytes, part_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of parts encoded as one text and their numbers, or None if these do not tell the parts apart."""
        ids = np.array(self.encode([data.decode()])[0], np.uint32)
        widths = self.widths[ids]
        ends = np.cumsum(widths)
        last = np.searchsorted(ends, part_ends)
        if not len(ids) or ends[-1] != len(data) or (ends[last] != part_ends).any():
            return None
        if gather(self.token_data, self.token_starts[ids], widths).tobytes() != data:
            return None
        return ids, np.diff(last, prepend=-1)

    def _alone(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.encode(parts)
        return np.array([number for ids in found for number in ids], np.uint32), np.array([len(ids) for ids in found], np.int64)

    def _learn(self, parts: pa.Array, added: bool) -> np.ndarray:
        """Numbers of new parts."""
        ends, data = _layout(parts)
        sizes = np.diff(ends)
        # May be encoded beside others: opens with a space before a sign, and ends with a sign.
        plain = (sizes > 1) & (sizes <= LONGEST) & (data[ends[:-1]] == ord(" "))
        kind = _KIND[data]
        plain[plain] = kind[ends[:-1][plain] + 1] & (_ASCII_SIGN | _LEAD) != 0
        last = ends[1:][plain] - 1
        plain[plain] = (kind[last] & _ASCII_SIGN != 0) | (kind[last] == _REST) & (kind[last - 1] == _LEAD)
        if added:
            plain &= [not any(token in part for token in self.added) for part in parts.to_pylist()]
        joined = parts.filter(pa.array(plain))
        part_ends, data = _layout(joined)
        packed = data.tobytes()
        numbers = np.empty(len(parts), np.int64)
        found = []
        for start in range(0, len(joined), TOGETHER):
            stop = min(start + TOGETHER, len(joined))
            low, high = int(part_ends[start]), int(part_ends[stop])
            ids = self._together(packed[low:high], part_ends[start + 1:stop + 1] - low)
            found.append(ids or self._alone(joined.slice(start, stop - start).to_pylist()))
        others = np.flatnonzero(~plain)
        if len(others):
            found.append(self._alone(parts.take(pa.array(others)).to_pylist()))
        order = np.concatenate([np.flatnonzero(plain), others])
        numbers[order] = np.arange(len(self.starts), len(self.starts) + len(order))
        self._add(
            parts.take(pa.array(order)), np.concatenate([ids for ids, _ in found]), np.concatenate([lengths for _, lengths in found])
        )
        return numbers

    def _numbers(self, data: np.ndarray, at: np.ndarray, added: bool) -> np.ndarray:
        """The numbers of the parts that begin ``at`` these places."""
        ends = np.append(at, len(data))
        sizes = np.diff(ends)
        padded = np.concatenate([data, np.zeros(16, np.uint8)])
        numbers = np.empty(len(at), np.int32)
        for start in range(0, len(at), GATHERED):
            own = slice(start, start + GATHERED)
            numbers[own] = self.table.find(*narrow_keys(padded, at[own], sizes[own]))
        numbers[sizes > NARROW] = -1
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            parts = pa.StringArray.from_buffers(len(at), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(padded)).take(pa.array(missing))
            parts = parts.dictionary_encode()
            found = np.fromiter(map(self.known.get, parts.dictionary.to_pylist(), repeat(-1)), np.int64, len(parts.dictionary))
            new = np.flatnonzero(found < 0)
            if len(new):
                found[new] = self._learn(parts.dictionary.take(pa.array(new)), added)
            numbers[missing] = found[parts.indices.to_numpy()]
        self.uses += np.bincount(numbers, minlength=len(self.uses))
        return numbers

    def _parts(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, bool]:
        """Where the parts of texts begin, and whether any text holds an added token."""
        cut = np.zeros(len(data), bool)
        for start in range(0, len(data), BYTES_CUT) if self.cut else ():
            low = max(start - 4, 0)
            cut[start:start + BYTES_CUT] = cut_places(data[low:start + BYTES_CUT + 1])[start - low:][:BYTES_CUT]
        packed = data.tobytes() if self.cut and self.added else b""
        whole = [token for token in self.added if token.encode() in packed]
        for start, stop in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True) if whole else ():
            if any(packed.find(token.encode(), start, stop) >= 0 for token in whole):
                cut[start:stop] = False
        cut[starts[:-1][starts[:-1] < len(data)]] = True
        return np.flatnonzero(cut), bool(whole)

    def many(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of some texts at a time, each with its end id, and each text's number of ids. NULL is an empty text."""
        if len(self.starts) > MOST_PARTS or len(self.pool) > MOST_IDS:
            self._forget()
        starts, data = _layout(pc.fill_null(texts, "") if texts.null_count else texts)
        at, added = self._parts(data, starts) if len(data) else (np.zeros(0, np.int64), False)
        numbers = self._numbers(data, at, added)
        after = np.searchsorted(at, starts[1:])
        first = low = 0
        while first < len(after):
            stop = max(int(np.searchsorted(after, low + GATHERED, side="right")), first + 1)
            own = after[first:stop] - low
            sequence = np.insert(numbers[low:low + own[-1]], own, 0)
            lengths = self.lengths[sequence]
            ends = np.cumsum(lengths)[own + np.arange(len(own))]
            yield gather(self.pool, self.starts[sequence], lengths), np.diff(ends, prepend=0)
            first, low = stop, low + int(own[-1])
