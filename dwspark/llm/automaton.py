"""Levenshtein automata of a whole lexicon at once: a trie walked with edit counts.

A state is the set of (trie node, edits so far) that a word's letters can have
reached; states and their moves are made when first needed and kept.
"""

from __future__ import annotations

STEM, EXACT, FUZZY = "stem", "exact", "fuzzy"
MAX_STATES = 100_000


def allowed_edits(term: str) -> int:
    """Edits that a misspelled term may have: none below 5 letters, 2 from 9 letters on."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class LexiconAutomaton:
    def __init__(self, terms: list[str], stems: list[str]):
        """``terms`` match as whole words, also misspelled; ``stems`` match exactly, with any ending."""
        self.next: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.stem: list[str | None] = [None]
        for words, field in ((terms, self.term), (stems, self.stem)):
            for w in sorted(words):
                at = 0
                for ch in w:
                    if ch not in self.next[at]:
                        self.next[at][ch] = len(self.next)
                        self.next.append({})
                        self.term.append(None)
                        self.stem.append(None)
                    at = self.next[at][ch]
                field[at] = w
        # the most edits that any term below a node allows; -1: there is none
        self.most = [-1] * len(self.next)
        for node in range(len(self.next) - 1, -1, -1):
            own = allowed_edits(self.term[node]) if self.term[node] else 0 if self.stem[node] else -1
            self.most[node] = max([own, *(self.most[c] for c in self.next[node].values())])
        self.letters = {ch for n in self.next for ch in n}
        self.reset()

    def reset(self) -> None:
        self.number: dict[frozenset, int] = {}
        self.sets: list[dict[int, int]] = []
        self.moves: list[dict[str, int]] = []
        self.start = self._state({0: 0})

    def _state(self, reached: dict[int, int]) -> int:
        """Number of a state; ``reached``: fewest edits by node. Letters of a term may be left out."""
        todo = list(reached)
        while todo:
            node = todo.pop()
            for child in self.next[node].values():
                e = reached[node] + 1
                if e <= self.most[child] and e < reached.get(child, 99):
                    reached[child] = e
                    todo.append(child)
        if not reached:
            return -1
        key = frozenset(reached.items())
        if key not in self.number:
            self.number[key] = len(self.sets)
            self.sets.append(reached)
            self.moves.append({})
        return self.number[key]

    def _step(self, state: int, ch: str) -> int:
        out: dict[int, int] = {}

        def reach(node: int, e: int) -> None:
            if e <= self.most[node] and e < out.get(node, 99):
                out[node] = e

        for node, e in self.sets[state].items():
            reach(node, e + 1)  # a letter too many
            for letter, child in self.next[node].items():
                reach(child, e + (letter != ch))
        return self._state(out)

    def match(self, word: str) -> tuple[str, str] | None:
        """(kind, term) of the best match: a stem, the term itself, or the term with the fewest edits."""
        if len(self.sets) > MAX_STATES:
            self.reset()
        at, plain = self.start, 0
        for ch in word:
            plain = self.next[plain].get(ch, -1) if plain >= 0 else -1
            if plain >= 0 and self.stem[plain]:
                return STEM, self.stem[plain]
            ch = ch if ch in self.letters else "\0"
            move = self.moves[at].get(ch)
            if move is None:
                move = self.moves[at][ch] = self._step(at, ch)
            if move < 0:
                return None
            at = move
        if plain >= 0 and self.term[plain]:
            return EXACT, self.term[plain]
        best = min(((e, self.term[n]) for n, e in self.sets[at].items() if self.term[n] and e <= allowed_edits(self.term[n])), default=None)
        return (FUZZY, best[1]) if best and best[0] else None
