"""Re-Pair grammars of token ids: frequent pairs of neighbours become nonterminals, again and again.

A grammar has rules ``number -> (left, right)``, the numbers following the terminals', and the sequence that is left. The
lengths of the rules' expansions are stored, so that any place of the ids is found in the sequence by prefix sums and
only the symbols around it are expanded.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: A rule is made of a pair that is replaced this often or more.
LEAST_USES = 4
#: A round replaces the pairs that are at least this fraction as frequent as the most frequent one.
ROUND_SHARE = 32
#: How often a round looks again for places beside those it has taken; what is left is the next round's.
PASSES = 16
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_SLOT_BITS = 18


class Grammar(NamedTuple):
    rules: np.ndarray  # (n, 2), uint32
    lengths: np.ndarray  # of the rules' expansions, uint32
    symbols: np.ndarray  # uint32


def _frequent(keys: np.ndarray, bits: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Places of the pairs that a round replaces, the pairs in ascending order, their numbers of places and the least such number.

    Pairs met less than ``least`` times are left out. ``bits`` is the width of the keys.
    """
    # Counters by hash drop most rare pairs before the sort; a pair is never met more often than its counter says.
    slot_bits = min(_SLOT_BITS, len(keys).bit_length() + 1)
    slots = (keys * _SPREAD >> np.uint64(64 - slot_bits)).astype(np.intp)
    counters = np.bincount(slots)
    met = counters[slots]
    for limit in sorted({max(least, int(counters.max()) // ROUND_SHARE), least}, reverse=True):
        places = np.flatnonzero(met >= limit)
        found = keys[places]
        width = len(keys).bit_length()
        if bits + width <= 64:
            # Pair and place in one number: sorting these is faster than sorting places by their pairs.
            packed = np.sort(found << np.uint64(width) | places.astype(np.uint64))
            found = packed >> np.uint64(width)
            places = (packed & np.uint64((1 << width) - 1)).astype(np.int64)
        else:
            order = np.argsort(found, kind="stable")
            places, found = places[order], found[order]
        starts = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else np.zeros(0, np.int64)
        counts = np.diff(np.append(starts, len(found)))
        good = counts >= limit
        if good.any():
            break
    return places[np.repeat(good, counts)], found[starts[good]], counts[good], limit


def _apart(places: np.ndarray, rank: np.ndarray, size: int) -> np.ndarray:
    """The places whose pairs can be replaced at once: better ranked than the overlapping ones; of a run of one pair, every second.

    Places that overlap no chosen one are looked at again, up to ``PASSES`` times.
    """
    own = np.zeros(size + 2, np.int32)
    own[places + 1] = rank
    at = np.sort(places) + 1
    chosen = []
    for _ in range(PASSES):
        mine, before, after = own[at], own[at - 1], own[at + 1]
        taken = at[(before < mine) & (after < mine)]
        equal = (before == mine) | (after == mine)
        if equal.any():
            # Runs of one pair, as in a, a, a, a: taken whole if nothing beside them ranks higher.
            run = at[equal]
            opens = np.concatenate([[True], (run[1:] != run[:-1] + 1) | (own[run[1:]] != own[run[:-1]])])
            first = run[np.flatnonzero(opens)]
            last = run[np.append(np.flatnonzero(opens)[1:], len(run)) - 1]
            number = np.cumsum(opens) - 1
            free = (own[first - 1] < own[first]) & (own[last + 1] < own[last])
            taken = np.concatenate([taken, run[free[number] & ((run - first[number]) % 2 == 0)]])
        chosen.append(taken)
        own[taken] = own[taken - 1] = own[taken + 1] = 0
        at = at[own[at] > 0]
        if not len(at):
            break
    return np.sort(np.concatenate(chosen)) - 1


def compress(ids: np.ndarray, terminals: int, least: int = LEAST_USES) -> Grammar:
    """The grammar of ``ids``, all below ``terminals``."""
    symbols = ids.astype(np.uint32)
    rules, lengths = [], []
    known = np.ones(terminals, np.uint32)
    # Where a pair met ``least`` times may stand; None: anywhere.
    watched = None
    while len(symbols) > 1 and (watched is None or len(watched)):
        half = len(known).bit_length()
        if watched is None:
            left, right = symbols[:-1], symbols[1:]
        else:
            left, right = symbols[watched], symbols[watched + 1]
        places, pairs, counts, limit = _frequent(left.astype(np.uint64) << np.uint64(half) | right, 2 * half, least)
        if not len(pairs):
            break
        if watched is not None:
            places = watched[places]
        rank = np.argsort(np.argsort(counts, kind="stable"), kind="stable").astype(np.int32) + 1
        of_place = np.repeat(rank, counts)
        chosen = _apart(places, of_place, len(symbols) - 1)
        by_place = np.zeros(len(symbols), np.int32)
        by_place[places] = of_place
        picked = by_place[chosen]
        worth = np.bincount(picked, minlength=len(pairs) + 1) >= least
        if not worth.any():
            break
        pair_of_rank = np.zeros(len(pairs) + 1, np.uint64)
        pair_of_rank[rank] = pairs
        ranks = np.flatnonzero(worth)
        number = np.zeros(len(worth), np.uint32)
        number[ranks] = len(known) + np.arange(len(ranks))
        chosen = chosen[worth[picked]]
        new = pair_of_rank[ranks]
        rules.append(np.stack([new >> np.uint64(half), new & np.uint64((1 << half) - 1)], axis=1).astype(np.uint32))
        lengths.append(known[rules[-1]].sum(axis=1, dtype=np.uint32))
        known = np.concatenate([known, lengths[-1]])
        symbols[chosen] = number[by_place[chosen]]
        stay = np.ones(len(symbols), bool)
        stay[chosen + 1] = False
        symbols = symbols[stay]
        if limit == least or watched is not None:
            # All such pairs were found: from now on they are among those left over and those that hold a new symbol.
            watch = by_place > 0
            if limit > least:
                watch[watched] = True
            watch = watch[stay]
            fresh = symbols >= number[ranks[0]]
            watch |= fresh
            watch[:-1] |= fresh[1:]
            watched = np.flatnonzero(watch[:-1])
    return Grammar(
        np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32),
        np.concatenate(lengths) if lengths else np.zeros(0, np.uint32), symbols,
    )


def gather(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The pieces of ``pool`` from ``starts``, one after another."""
    ends = np.cumsum(lengths, dtype=np.int64)
    kind = np.int32 if len(pool) < 1 << 31 and len(ends) and ends[-1] < 1 << 31 else np.int64
    places = np.repeat((starts - ends + lengths).astype(kind), lengths)
    places += np.arange(len(places), dtype=kind)
    return pool[places]


def _expanded(symbols: np.ndarray, rules: np.ndarray, terminals: int) -> np.ndarray:
    """The ids that the symbols stand for."""
    symbols = symbols.astype(np.uint32)
    while True:
        nested = symbols >= terminals
        if not nested.any():
            return symbols
        ends = np.cumsum(1 + nested)
        wider = np.empty(int(ends[-1]), np.uint32)
        plain, inner = ~nested, symbols[nested] - terminals
        wider[ends[plain] - 1] = symbols[plain]
        wider[ends[nested] - 2] = rules[inner, 0]
        wider[ends[nested] - 1] = rules[inner, 1]
        symbols = wider


def expand(grammar: Grammar, terminals: int) -> np.ndarray:
    """All ids."""
    if not len(grammar.rules):
        return grammar.symbols
    if grammar.lengths.sum(dtype=np.int64) > grammar.lengths[grammar.symbols[grammar.symbols >= terminals] - terminals].sum(dtype=np.int64):
        return _expanded(grammar.symbols, grammar.rules, terminals)
    # Every rule is expanded once, and the sequence put together from these.
    pool = _expanded(np.arange(terminals, terminals + len(grammar.rules), dtype=np.uint32), grammar.rules, terminals)
    nested = np.flatnonzero(grammar.symbols >= terminals)
    inner = grammar.symbols[nested] - terminals
    widths = np.ones(len(grammar.symbols), np.int64)
    widths[nested] = grammar.lengths[inner]
    starts = np.arange(len(pool), len(pool) + len(grammar.symbols))
    starts[nested] = (np.cumsum(grammar.lengths, dtype=np.int64) - grammar.lengths)[inner]
    return gather(np.concatenate([pool, grammar.symbols]), starts, widths)


def expand_range(grammar: Grammar, terminals: int, start: int, stop: int) -> np.ndarray:
    """The ids from ``start`` to ``stop``, expanding only the symbols that hold them."""
    if stop <= start:
        return np.zeros(0, np.uint32)
    widths = np.concatenate([np.ones(terminals, np.uint32), grammar.lengths])[grammar.symbols]
    ends = np.cumsum(widths, dtype=np.int64)
    first, last = np.searchsorted(ends, [start, stop - 1], side="right")
    before = int(ends[first - 1]) if first else 0
    return _expanded(grammar.symbols[first:last + 1], grammar.rules, terminals)[start - before:stop - before]
