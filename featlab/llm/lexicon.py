"""A minimal acyclic automaton over byte strings whose words are numbered, stored as one flat file.

Words that share a prefix share states from the start, words that share a
suffix share them at the end (states with the same finality and the same edges
are one state). Every edge carries how many words sort before those behind it,
so a walk adds up to the word's rank, and the rank points into a table of
outputs. The file is mapped, not loaded; lookups walk all words of a batch at
once, one byte per step.
"""

from __future__ import annotations

import numpy as np

from featlab.llm.store import get_array, put

HEADER = 6  # 64-bit numbers: states, edges, words, output ids, longest word, format


def build(words: list[bytes], outputs: list[list[int]]) -> bytes:
    """The file's bytes for distinct words (any order) and their outputs."""
    order = sorted(range(len(words)), key=words.__getitem__)
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

    def settle(final: bool, edges: list[tuple[int, int]]) -> int:
        key = (final, tuple(edges))
        if key not in register:
            register[key] = len(states)
            states.append(key)
        return register[key]

    # open path of the last word: [final, finished edges, pending label]
    path: list[list] = [[False, []]]
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            final, edges = path.pop()
            path[-1][1].append((last[len(path) - 1], settle(final, edges)))

    for k in order:
        word = words[k]
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        close(common)
        path.extend([False, []] for _ in range(len(word) - common))
        path[-1][0] = True
        last = word
    close(0)
    root = settle(path[0][0], path[0][1])
    below = np.zeros(len(states), np.int64)      # words in the language of a state
    for s, (final, edges) in enumerate(states):  # targets settle before their sources
        below[s] = final + sum(below[t] for _, t in edges)
    keys, targets, skips = [], [], []
    for s, (final, edges) in enumerate(states):
        before = int(final)
        for label, t in edges:
            keys.append(s << 8 | label)
            targets.append(t)
            skips.append(before)
            before += int(below[t])
    flat = [i for k in order for i in outputs[k]]
    starts = np.cumsum([0, *(len(outputs[k]) for k in order)])
    head = np.asarray([len(states), len(keys), len(words), len(flat), max(map(len, words), default=0), root], "<i8")
    return b"".join(np.asarray(x, t).tobytes() for x, t in (
        (head, "<i8"), (keys, "<i8"), (targets, "<i8"), (skips, "<i8"), (starts, "<i8"),
        ([f for f, _ in states], "<i8"), (flat, "<i8")))


def save(folder: str, words: list[bytes], outputs: list[list[int]]) -> None:
    put(folder, "lexicon", [build(words, outputs)], "driver")


class Lexicon:
    """A saved automaton, mapped."""

    def __init__(self, data: np.ndarray):
        states, edges, words, out, self.longest, self.root = (int(x) for x in data[:HEADER])
        cuts = np.cumsum([HEADER, edges, edges, edges, words + 1, states, out])
        self.keys, self.targets, self.skips, self.starts, self.final, self.out = (data[a:b] for a, b in zip(cuts, cuts[1:]))
        self.states, self.words = states, words

    @classmethod
    def open(cls, folder: str) -> Lexicon:
        return cls(get_array(folder, "lexicon", "<i8"))

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """Rank of every word, -1 for those not in the lexicon."""
        n = len(words)
        lens = np.fromiter(map(len, words), np.int64, n)
        found = np.full(n, -1, np.int64)
        if not n or not self.words:
            return found
        text = np.frombuffer(b"".join(words) + b"\0", np.uint8)
        starts = np.cumsum(lens) - lens
        live = np.flatnonzero(lens <= self.longest)
        state, rank = np.full(len(live), self.root, np.int64), np.zeros(len(live), np.int64)
        step = 0
        while len(live):
            at_end = lens[live] == step
            ended = at_end & (self.final[state] == 1)
            found[live[ended]] = rank[ended]
            go = ~at_end
            live, state, rank = live[go], state[go], rank[go]
            if not len(live) or not len(self.keys):
                break
            key = state << 8 | text[starts[live] + step]
            e = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[e] == key
            live, state, rank = live[ok], self.targets[e[ok]], rank[ok] + self.skips[e[ok]]
            step += 1
        return found

    def outputs(self, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all ranks back to back, number of ids of each)."""
        a, b = self.starts[ranks], self.starts[ranks + 1]
        lens = b - a
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(ends) else 0
        return self.out[np.repeat(a - (ends - lens), lens) + np.arange(total)], lens
