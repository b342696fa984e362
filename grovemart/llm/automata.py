"""Substring dedup: suffix automata of reference shards, matching statistics of documents.

`overlap` deals the texts that may repeat to shards. A shard reads its texts by ascending
doc_id: each is streamed through the automaton of the texts before it, which gives for every word the
length of the longest match that ends there; where that reaches the threshold, the stretch
occurs in a smaller doc_id. Then the text becomes part of the automaton.

Automata of a whole corpus grow with it, so they are not broadcast: a shard's automata are
built where the texts that can match them arrive, one per seed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from grovemart.llm import overlap

WORDS = overlap.Unit("words", length=13, seed=4)


class Automaton:
    """Suffix automaton of several sequences: every state knows its longest text and its suffix link."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, next_: dict, link: int) -> int:
        self.next.append(next_)
        self.length.append(length)
        self.link.append(link)
        return len(self.link) - 1

    def _step(self, p: int, symbol: bytes) -> int:
        """State of `symbol` after `p` with exactly one symbol more, split off if need be."""
        q, length = self.next[p][symbol], self.length[p] + 1
        if self.length[q] == length:
            return q
        clone = self._state(length, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = clone
            p = self.link[p]
        return clone

    def add(self, words: list[bytes]) -> None:
        """Takes in a sequence with all its substrings."""
        last = 0
        for word in words:
            if word in self.next[last]:
                last = self._step(last, word)
                continue
            new = self._state(self.length[last] + 1, {}, 0)
            p = last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._step(p, word)
            last = new

    def matches(self, words: list[bytes]) -> list[int]:
        """Per word: length of the longest substring of the taken-in sequences that ends there."""
        next_, link, length = self.next, self.link, self.length
        state, matched, out = 0, 0, []
        for word in words:
            while state and word not in next_[state]:
                state = link[state]
                matched = length[state]
            if word in next_[state]:
                state = next_[state][word]
                matched += 1
            out.append(matched)
        return out


def repeated(rows: pa.Table, unit: overlap.Unit) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of `rows` (sorted by key and doc_id) that a smaller doc_id of the same key holds."""
    keys, ids = rows["key"].to_numpy(), rows["doc_id"].to_numpy()
    bodies = rows["body"].to_pylist()
    found_row: list[int] = []
    found_stretch: list[int] = []
    automaton, waiting, need = Automaton(), [], unit.length - 1
    for i, body in enumerate(bodies):
        if i and keys[i] != keys[i - 1]:
            automaton, waiting = Automaton(), []
        elif i and ids[i] != ids[i - 1]:
            for earlier in waiting:
                automaton.add(earlier)
            waiting = []
        words = body.split()
        hits = [j - need for j, m in enumerate(automaton.matches(words)) if m > need]
        found_row.extend([i] * len(hits))
        found_stretch.extend(hits)
        if len(hits) < len(words) - need:
            waiting.append(words)
    return np.array(found_row, np.int64), np.array(found_stretch, np.int64)


def dedup(docs: DataFrame, unit: overlap.Unit = WORDS) -> DataFrame:
    """`docs` with `kept`, `n_units`, `n_removed`, `n_spans`; see `overlap.cut`."""
    return overlap.cut(docs, unit, repeated)
