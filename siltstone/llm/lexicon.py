"""A minimal acyclic word automaton with token ids as outputs.

Words are byte strings. The automaton shares suffixes, numbers its words in byte
order by counting what each edge skips, and keeps the ids of word ``i`` between
``offsets[i]`` and ``offsets[i + 1]``. It is stored as plain arrays that every
worker of a machine maps into memory, so that its pages are held once.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Sequence
from uuid import uuid4

import numpy as np

ARRAYS = ("edge_key", "edge_next", "edge_skip", "final", "offsets", "ids")


def compile_lexicon(entries: Iterable[tuple[bytes, Sequence[int]]]) -> dict[str, np.ndarray]:
    """The automaton's arrays for ``(word, ids)`` pairs; of a repeated word the first counts.

    Built in byte order, word after word: whatever the next word cannot extend any
    more is replaced by an equal state that exists already, if there is one.
    """
    table: dict[bytes, Sequence[int]] = {}
    for word, ids in entries:
        table.setdefault(word, ids)
    words = sorted(table)
    register: dict[tuple, int] = {}
    done: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    # The path of the word before: per depth [is a word, finished edges, byte of the open edge].
    path: list[list] = [[False, [], None]]

    def close(depth: int) -> None:
        while len(path) - 1 > depth:
            accept, edges, _ = path.pop()
            key = (accept, tuple(edges))
            state = register.get(key)
            if state is None:
                state = register[key] = len(done)
                done.append(key)
            parent = path[-1]
            parent[1].append((parent[2], state))
            parent[2] = None

    before = b""
    for word in words:
        same = 0
        for x, y in zip(before, word):
            if x != y:
                break
            same += 1
        close(same)
        for byte in word[same:]:
            path[-1][2] = byte
            path.append([False, [], None])
        path[-1][0] = True
        before = word
    close(0)
    root = len(done)
    done.append((path[0][0], tuple(path[0][1])))

    below = [0] * len(done)  # words that can be read from a state on; children come before parents
    keys, nexts, skips = [], [], []
    for state, (accept, edges) in enumerate(done):
        count = int(accept)
        for byte, child in edges:
            keys.append(state << 8 | byte)
            nexts.append(child)
            skips.append(count)
            count += below[child]
        below[state] = count
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    lengths = np.fromiter((len(table[w]) for w in words), np.int64, len(words))
    return {
        "edge_key": np.array(keys, np.int64)[order],
        "edge_next": np.array(nexts, np.int32)[order],
        "edge_skip": np.array(skips, np.int32)[order],
        "final": np.array([accept for accept, _ in done] + [False], bool),
        "offsets": np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)]),
        "ids": np.fromiter((i for w in words for i in table[w]), np.int32, int(lengths.sum())),
        "root": np.array([root], np.int64),
    }


def save_lexicon(arrays: dict[str, np.ndarray], folder: str) -> str:
    os.makedirs(folder, exist_ok=True)
    for name, value in arrays.items():
        np.save(os.path.join(folder, f"{name}.npy"), value)
    return folder


class Lexicon:
    """Look-up in an automaton that is mapped from ``folder`` or held in ``arrays``."""

    def __init__(self, folder: str | None = None, arrays: dict[str, np.ndarray] | None = None):
        get = arrays.__getitem__ if arrays is not None else lambda n: np.load(os.path.join(folder, f"{n}.npy"), mmap_mode="r")
        for name in ARRAYS:
            setattr(self, name, get(name))
        self.root = int(get("root")[0])
        self.name = folder or uuid4().hex

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Lexicon) and self.name == other.name

    def __hash__(self) -> int:
        return hash(self.name)

    def find(self, words: Sequence[bytes]) -> np.ndarray:
        """Of each word its number, -1 where the automaton doesn't hold it. All words advance together, a byte at a time."""
        found = np.full(len(words), -1, np.int64)
        if not len(words) or not len(self.edge_key):
            return found
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(lengths) - lengths
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        alive = np.arange(len(words))
        state = np.full(len(words), self.root, np.int64)
        number = np.zeros(len(words), np.int64)
        depth = 0
        while len(alive):
            ends = lengths[alive] == depth
            if ends.any():
                at = alive[ends]
                ok = self.final[state[ends]]
                found[at[ok]] = number[ends][ok]
                alive, state, number = alive[~ends], state[~ends], number[~ends]
                if not len(alive):
                    break
            key = state << 8 | data[starts[alive] + depth]
            edge = np.minimum(np.searchsorted(self.edge_key, key), len(self.edge_key) - 1)
            hit = self.edge_key[edge] == key
            edge, alive = edge[hit], alive[hit]
            state, number = self.edge_next[edge].astype(np.int64), number[hit] + self.edge_skip[edge]
            depth += 1
        return found

    def outputs(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these words in a row, and how many each word has."""
        begin = self.offsets[numbers]
        lengths = self.offsets[numbers + 1] - begin
        before = np.cumsum(lengths) - lengths
        return self.ids[np.arange(int(lengths.sum())) + np.repeat(begin - before, lengths)], lengths
