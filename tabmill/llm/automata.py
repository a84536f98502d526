"""Probabilistic automata from example strings, by merging compatible states of their prefix tree."""

from __future__ import annotations

import math

CONFIDENCE = 0.05   # of the test that keeps two states apart
FLOOR = 0.1         # added to each symbol's count when a string is scored
SYMBOLS = 70        # symbols that may follow a state, the end included


class Automaton:
    """States with counts: how often each symbol follows, where it leads, how often a string ends."""

    def __init__(self) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.counts: list[dict[str, int]] = [{}]
        self.ends: list[int] = [0]
        self.totals: list[int] = [0]

    def add(self, text: str) -> None:
        state = 0
        for symbol in text:
            self.totals[state] += 1
            self.counts[state][symbol] = self.counts[state].get(symbol, 0) + 1
            if symbol not in self.next[state]:
                self.next[state][symbol] = len(self.next)
                self.next.append({})
                self.counts.append({})
                self.ends.append(0)
                self.totals.append(0)
            state = self.next[state][symbol]
        self.totals[state] += 1
        self.ends[state] += 1

    def differ(self, a: int, b: int) -> bool:
        """Whether the strings that follow two states are too unlike for one state: Hoeffding's bound, all the way down."""
        bound = math.sqrt(0.5 * math.log(2 / CONFIDENCE))
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            na, nb = self.totals[a], self.totals[b]
            if not na or not nb:
                continue
            limit = bound * (1 / math.sqrt(na) + 1 / math.sqrt(nb))
            if limit < 1:
                if abs(self.ends[a] / na - self.ends[b] / nb) > limit:
                    return True
                for s in {*self.counts[a], *self.counts[b]}:
                    if abs(self.counts[a].get(s, 0) / na - self.counts[b].get(s, 0) / nb) > limit:
                        return True
            stack.extend((self.next[a][s], t) for s, t in self.next[b].items() if s in self.next[a])
        return False

    def fold(self, into: int, tree: int) -> None:
        """Add a subtree's counts to a state and what follows it."""
        stack = [(into, tree)]
        while stack:
            a, b = stack.pop()
            self.totals[a] += self.totals[b]
            self.ends[a] += self.ends[b]
            for s, n in self.counts[b].items():
                self.counts[a][s] = self.counts[a].get(s, 0) + n
            for s, t in self.next[b].items():
                if s in self.next[a]:
                    stack.append((self.next[a][s], t))
                else:
                    self.next[a][s] = t


def learn(strings: list[str]) -> Automaton:
    """The automaton of some strings: states are met from the root, and each is merged with the first it does not differ from."""
    tree = Automaton()
    for text in strings:
        tree.add(text)
    settled, at = [0], 0
    while at < len(settled):
        state = settled[at]
        for symbol in sorted(tree.next[state]):
            child = tree.next[state][symbol]
            if child in settled:
                continue
            twin = next((s for s in settled if not tree.differ(s, child)), None)
            if twin is None:
                settled.append(child)
            else:
                tree.next[state][symbol] = twin
                tree.fold(twin, child)
        at += 1
        if any(t not in settled for s in settled[:at] for t in tree.next[s].values()):
            at = 0  # a merge has brought a settled state new children
    return trimmed(tree, settled)


def trimmed(tree: Automaton, settled: list[int]) -> Automaton:
    """Only the states in use."""
    number = {s: i for i, s in enumerate(settled)}
    out = Automaton()
    out.next = [{c: number[t] for c, t in tree.next[s].items()} for s in settled]
    out.counts = [tree.counts[s] for s in settled]
    out.ends = [tree.ends[s] for s in settled]
    out.totals = [tree.totals[s] for s in settled]
    return out


def log_chance(model: Automaton, text: str) -> float:
    """Log likelihood of a string, per symbol and its end. A symbol never seen in a state is rare and stays in that state."""
    state, total = 0, 0.0
    for symbol in text:
        total += math.log((model.counts[state].get(symbol, 0) + FLOOR) / (model.totals[state] + FLOOR * SYMBOLS))
        state = model.next[state].get(symbol, state)
    total += math.log((model.ends[state] + FLOOR) / (model.totals[state] + FLOOR * SYMBOLS))
    return total / (len(text) + 1)
