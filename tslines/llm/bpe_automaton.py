"""A byte-level BPE vocabulary compiled, on demand, into a deterministic counting transducer.

What the transducer rests on: in BPE a token sequence is the encoding of its bytes exactly
when every two neighbours are, so the encoding of a prefix is fixed by where its last token
starts and by the encoding up to there. Reading one byte therefore needs only the starts
whose bytes so far still begin some token. A state is that set; it is deterministic, its
transitions carry the change in the number of tokens, and only states that texts reach are
ever built.
"""

from __future__ import annotations

import json

NEVER = 1 << 60


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies spell bytes: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    rest = (b for b in range(256) if b not in set(plain))
    return letters | {chr(256 + n): b for n, b in enumerate(rest)}


class Vocabulary:
    """Tokens as bytes, and the merges that make them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, model = byte_letters(), spec["model"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = {t: i for t, i in model["vocab"].items() if t not in self.specials}
        self.ids = {bytes(letters[c] for c in t): i for t, i in vocab.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair = (vocab[left], vocab[right])
            self.rank[pair] = rank
            self.halves[vocab[left + right]] = pair

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The symbols that stand at one edge of a token while it is merged, each with the
        rank of the merge that takes it in. side 0: the left edge, 1: the right one."""
        line, taken = [], NEVER
        while True:
            line.append((token, taken))
            if token not in self.halves:
                return line[::-1]
            taken = self.rank[self.halves[token]]
            token = self.halves[token][side]


def _member(last: int, node: int, behind: int) -> int:
    """The three numbers of a state's member in one."""
    return (last + 1) << 40 | node << 16 | (behind + 0x8000)


class Transducer:
    """Counts the tokens of one pre-token, byte by byte.

    States are numbers; `arcs[state]` maps a byte to (next state, change in tokens). Past
    `max_states` all states are dropped and built again, so memory is bounded for any text.
    """

    def __init__(self, vocabulary: Vocabulary, max_states: int = 150_000):
        self.vocabulary, self.max_states = vocabulary, max_states
        self.children: list[dict[int, int]] = [{}]
        self.token_at: list[int] = [-1]
        for token, number in vocabulary.ids.items():
            self._spell(token, number)
        self.right: dict[int, list] = {}
        self.left: dict[int, list] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self._forget()

    def _spell(self, token: bytes, number: int) -> None:
        node = 0
        for b in token:
            if b not in self.children[node]:
                self.children[node][b] = len(self.children)
                self.children.append({})
                self.token_at.append(-1)
            node = self.children[node][b]
        self.token_at[node] = number

    def _forget(self) -> None:
        start = (_member(-1, 0, 0),)
        self.numbers = {start: 0}
        self.states, self.arcs = [start], [{}]

    def _fit(self, first: int, second: int) -> bool:
        """Whether two tokens stand as they are side by side: no merge crosses the line
        between them before the symbols at the line are taken into their own tokens."""
        if first < 0:
            return True
        known = self.fits.get((first, second))
        if known is not None:
            return known
        a = self.right.get(first) or self.right.setdefault(first, self.vocabulary.edge(first, 1))
        b = self.left.get(second) or self.left.setdefault(second, self.vocabulary.edge(second, 0))
        rank, i, j, fit = self.vocabulary.rank, 0, 0, True
        while True:
            (x, x_taken), (y, y_taken) = a[i], b[j]
            across = rank.get((x, y), NEVER)
            if across < x_taken and across <= y_taken and across < NEVER:
                fit = False
                break
            if x_taken == NEVER and y_taken == NEVER:
                break
            if x_taken <= y_taken:
                i += 1
            else:
                j += 1
        if len(self.fits) > 2_000_000:
            self.fits.clear()
        self.fits[first, second] = fit
        return fit

    def _arc(self, state: int, byte: int) -> tuple[int, int]:
        """Build one transition. Members of a state are (token that ends at a start, trie
        node of the bytes since, tokens up to the start less tokens up to here)."""
        alive, best = [], None
        for member in self.states[state]:
            last, behind = (member >> 40) - 1, (member & 0xFFFF) - 0x8000
            node = self.children[member >> 16 & 0xFFFFFF].get(byte)
            if node is None:
                continue
            token = self.token_at[node]
            if best is None and token >= 0 and self._fit(last, token):
                best = (token, behind + 1)
            if self.children[node]:
                alive.append((last, node, behind))
        token, change = best
        key = (*(_member(last, node, behind - change) for last, node, behind in alive), _member(token, 0, 0))
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.states)
            self.states.append(key)
            self.arcs.append({})
        self.arcs[state][byte] = (number, change)
        return number, change

    def count(self, piece: bytes) -> int:
        """Tokens of a pre-token."""
        if len(self.states) > self.max_states:
            self._forget()
        state, total, arcs = 0, 0, self.arcs
        for byte in piece:
            arc = arcs[state].get(byte)
            if arc is None:
                arc = self._arc(state, byte)
            state = arc[0]
            total += arc[1]
        return total
