"""A lexicon's trie walked by Levenshtein automata."""

from __future__ import annotations

from dataclasses import dataclass, field

#: Most edits of a term, by the first length that allows them.
EDITS_FROM = ((10, 2), (5, 1))

#: Nodes in the kept states of one trie, at most: then they are made anew.
MOST_KEPT = 2_000_000


def most_edits(term: str) -> int:
    return next((edits for length, edits in EDITS_FROM if len(term) >= length), 0)


@dataclass
class _Node:
    children: dict[str, int] = field(default_factory=dict)
    term: int = -1


class FuzzyTrie:
    """Terms within their edit distance, found in one walk over a word.

    A state is a set of (trie node, edits so far): the Levenshtein automata of all terms,
    intersected with the trie. States and steps are made when first met and kept, so a word
    costs one lookup per character and most words end in the empty state early. A term that ends with ``*`` is a stem: it
    accepts any ending.
    """

    def __init__(self, terms: list[str]) -> None:
        self.terms = [term.rstrip("*") for term in terms]
        self.limits = [most_edits(term) for term in self.terms]
        self.stems = [term.endswith("*") for term in terms]
        self.nodes = [_Node()]
        for number in range(len(terms)):
            at = 0
            for letter in self.terms[number]:
                at = self.nodes[at].children.setdefault(letter, len(self.nodes))
                if at == len(self.nodes):
                    self.nodes.append(_Node())
            self.nodes[at].term = number
        self.deepest = self._most_below()
        self.letters = {letter for node in self.nodes for letter in node.children}
        self._forget()

    def _forget(self) -> None:
        """Only the first state is left."""
        self._kept = 0
        self._numbers: dict[frozenset, int] = {}
        self._states: list[tuple[dict[int, int], tuple[int, int] | None]] = []
        self._steps: list[dict[str, int]] = []
        self._found: list[tuple[int, int] | None] = []
        self.start = self._number(self._closed({0: 0}), None)

    def _most_below(self) -> list[int]:
        """By node: the most edits of any term at or below it."""
        most = [0] * len(self.nodes)
        for at in range(len(self.nodes) - 1, -1, -1):  # children have larger numbers
            node = self.nodes[at]
            own = self.limits[node.term] if node.term >= 0 else 0
            most[at] = max([own, *(most[child] for child in node.children.values())])
        return most

    def _closed(self, state: dict[int, int]) -> dict[int, int]:
        """With the nodes reached by leaving out letters of a term."""
        todo = list(state.items())
        while todo:
            at, edits = todo.pop()
            for child in self.nodes[at].children.values():
                if edits + 1 <= self.deepest[child] and edits + 1 < state.get(child, 99):
                    state[child] = edits + 1
                    todo.append((child, edits + 1))
        return state

    def _number(self, state: dict[int, int], stem: tuple[int, int] | None) -> int:
        """The state's number; ``stem`` is the best stem that the word has already completed: (edits, term)."""
        ends = [(edits, self.nodes[at].term) for at, edits in state.items()
                if self.nodes[at].term >= 0 and edits <= self.limits[self.nodes[at].term]]
        stem = min([end for end in ends if self.stems[end[1]]] + ([stem] if stem else []), default=None)
        best = min(ends + ([stem] if stem else []), default=None)
        key = frozenset(state.items()) | ({("stem", stem)} if stem else set())
        number = self._numbers.get(key)
        if number is None:
            number = self._numbers[key] = len(self._states)
            self._kept += 1 + len(state)
            self._states.append((dict(state), stem))
            self._steps.append({})
            self._found.append(best)
        return number

    def _step(self, number: int, letter: str) -> int:
        state, stem = self._states[number]
        after: dict[int, int] = {}
        for at, edits in state.items():
            for sign, child in self.nodes[at].children.items():
                cost = edits + (sign != letter)
                if cost <= self.deepest[child] and cost < after.get(child, 99):
                    after[child] = cost
            if edits + 1 <= self.deepest[at] and edits + 1 < after.get(at, 99):
                after[at] = edits + 1
        return self._number(self._closed(after), stem)

    def find(self, word: str) -> tuple[int, int] | None:
        """(edits, term number) of the nearest term of a word, or None."""
        if self._kept > MOST_KEPT:
            self._forget()
        at = self.start
        for letter in word:
            letter = letter if letter in self.letters else ""
            steps = self._steps[at]
            following = steps.get(letter)
            if following is None:
                following = steps[letter] = self._step(at, letter)
            at = following
            if not self._states[at][0]:
                break
        return self._found[at]
