"""A minimal acyclic transducer: sorted words with sequences of ids as outputs, in one automaton that shares prefixes and suffixes.

Words are added in byte order. Each arc carries the ids that all words through it have in common and no earlier arc has said, so words
that differ only in front share the states of their ends. The automaton is a flat block of bytes that is searched where it lies, which
may be a memory map: nothing is read into Python objects but the few numbers of the arcs on the way.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable

import numpy as np

Ids = tuple[int, ...]


def _common(a: Ids, b: Ids) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


class _Open:
    """A state of the latest word, not yet merged with an equal one."""

    __slots__ = ("arcs", "final")

    def __init__(self):
        self.arcs: list[list] = []  # [label, state, output]; the last one's state is still open
        self.final: Ids | None = None

    def put_before(self, ids: Ids) -> None:
        for arc in self.arcs:
            arc[2] = ids + arc[2]
        if self.final is not None:
            self.final = ids + self.final


class Builder:
    def __init__(self):
        self.known: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.path, self.last = [_Open()], b""

    def _close(self, state: _Open) -> int:
        key = (state.final, tuple(map(tuple, state.arcs)))
        n = self.known.get(key)
        if n is None:
            n = self.known[key] = len(self.states)
            self.states.append(key)
        return n

    def _shorten(self, length: int) -> None:
        while len(self.path) > length + 1:
            done = self._close(self.path.pop())
            self.path[-1].arcs[-1][1] = done

    def add(self, word: bytes, ids: Ids) -> None:
        """Words come in strictly rising order."""
        if word <= self.last and (self.last or self.path[0].final is not None):
            raise ValueError("words must rise")
        same = _common(tuple(word), tuple(self.last))
        self._shorten(same)
        for at in range(same):
            arc = self.path[at].arcs[-1]
            n = _common(arc[2], ids)
            rest, arc[2], ids = arc[2][n:], arc[2][:n], ids[n:]
            if rest:
                self.path[at + 1].put_before(rest)
        for label in word[same:]:
            self.path[-1].arcs.append([label, -1, ids])
            self.path.append(_Open())
            ids = ()
        self.path[-1].final = ids
        self.last = word

    def packed(self) -> bytes:
        """Sections behind a header of six numbers: where each state's arcs begin, what it ends with, the arcs' states and outputs,
        where each output begins, the outputs' ids, the arcs' labels."""
        self._shorten(0)
        root = self._close(self.path[0])
        pool: dict[Ids, int] = {(): 0}
        number = lambda ids: pool.setdefault(ids, len(pool))
        begins, finals, targets, outputs, labels = [0], [], [], [], bytearray()
        for final, arcs in self.states:
            finals.append(0 if final is None else 1 + number(final))
            for label, target, ids in arcs:
                labels.append(label)
                targets.append(target)
                outputs.append(number(ids))
            begins.append(len(targets))
        ends = np.cumsum([0, *map(len, pool)])
        sections = [begins, finals, targets, outputs, ends, [i for ids in pool for i in ids]]
        head = struct.pack("<8I", root, *map(len, sections), len(labels))
        return head + b"".join(np.array(x, "<u4").tobytes() for x in sections) + bytes(labels)


class Transducer:
    """Searches a block that Builder.packed has made; block: bytes or a memory map that begins at byte `at` of it."""

    def __init__(self, block, at: int = 0):
        self.root, *sizes, n_labels = struct.unpack_from("<8I", block, at)
        view, at, parts = memoryview(block), at + 32, []
        for n in sizes:
            parts.append(view[at : at + 4 * n].cast("I"))
            at += 4 * n
        self.begins, self.finals, self.targets, self.outputs, self.ends, self.ids = parts
        self.block, self.labels, self.end = block, at, at + n_labels
        self.one = [bytes([b]) for b in range(256)]
        self.keys: np.ndarray | None = None

    @property
    def n_states(self) -> int:
        return len(self.finals)

    def _said(self, output: int) -> list[int]:
        return self.ids[self.ends[output] : self.ends[output + 1]].tolist()

    def find(self, word: bytes) -> list[int] | None:
        """The ids of a word, or null if the automaton lacks it."""
        state, out, base = self.root, [], self.labels
        begins, targets, outputs, one, look = self.begins, self.targets, self.outputs, self.one, self.block.find
        for b in word:
            arc = look(one[b], base + begins[state], base + begins[state + 1]) - base
            if arc < 0:
                return None
            if said := outputs[arc]:
                out += self._said(said)
            state = targets[arc]
        final = self.finals[state]
        return out + self._said(final - 1) if final else None

    def holds(self, words: list[bytes]) -> np.ndarray:
        """Whether the automaton has each of many words; all walk at once, a byte a step."""
        begins, finals = np.asarray(self.begins), np.asarray(self.finals)
        labels = np.frombuffer(self.block, np.uint8, self.end - self.labels, self.labels)
        if self.keys is None:  # arcs by state and label; the states' arcs lie one after another, labels rising
            self.keys = np.append(np.repeat(np.arange(len(begins) - 1), np.diff(begins.astype(np.int64))) << 8 | labels, np.iinfo(np.int64).max)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat, starts = np.frombuffer(b"".join(words), np.uint8), np.cumsum(sizes) - sizes
        state, alive, step = np.full(len(words), self.root, np.int64), np.arange(len(words)), 0
        out = np.zeros(len(words), bool)
        targets = np.append(np.asarray(self.targets), 0)
        while len(alive):
            ended = sizes[alive] == step
            out[alive[ended]] = finals[state[alive[ended]]] > 0
            alive = alive[~ended]
            key = state[alive] << 8 | flat[starts[alive] + step]
            arc = np.searchsorted(self.keys, key)
            hit = self.keys[arc] == key
            alive = alive[hit]
            state[alive] = targets[arc[hit]]
            step += 1
        return out


def compiled(words: Iterable[tuple[bytes, Ids]]) -> bytes:
    builder = Builder()
    for word, ids in sorted(words):
        builder.add(word, ids)
    return builder.packed()
