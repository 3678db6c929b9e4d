"""Weighted acyclic automata over label sequences, as numpy levels.

A :class:`Counts` transducer reads sequences of one fixed length (shorter ones
end in zeros) and weighs them. Level d holds its states after d + 1 labels in
sorted order: the parent state, the label read, and the weight of all
sequences through the state. As the sequences come in sorted order, a level
follows from the one before in one pass over the new labels.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_HEAD = struct.Struct("<IQ")


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the place of each key among them."""
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = ranked[1:] != ranked[:-1]
    place = np.empty(len(keys), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    return ranked[new], place


@dataclass
class Counts:
    parents: list[np.ndarray]
    labels: list[np.ndarray]
    weights: list[np.ndarray]

    @classmethod
    def build(cls, columns: list[np.ndarray], weights: np.ndarray | None = None, least: int = 0) -> Counts:
        """From sequences given by their label columns (labels under 2**32).
        Sequences through a state of weight under ``least`` are left out
        below it; the weights of the states that stay are exact."""
        out = cls([], [], [])
        place = np.zeros(len(columns[0]), dtype=np.int64)
        live = None
        for depth, labels in enumerate(columns):
            if live is not None:
                labels = labels[live]
            keys, place = _ranked((place.astype(np.uint64) << np.uint64(32)) | labels.astype(np.uint64))
            own = weights if weights is None or live is None else weights[live]
            total = (np.bincount(place, minlength=len(keys)) if own is None
                     else np.bincount(place, own, len(keys)).astype(np.int64) if own.sum() < 1 << 52
                     else _exact_sums(place, own, len(keys)))
            out.parents.append((keys >> np.uint64(32)).astype(np.int64))
            out.labels.append((keys & np.uint64(0xFFFFFFFF)).astype(np.int64))
            out.weights.append(total.astype(np.int64))
            if least and depth + 1 < len(columns):
                keep = total[place] >= least
                if not keep.all():
                    live = np.flatnonzero(keep) if live is None else live[keep]
                    place = place[keep]
        return out

    def sequences(self) -> tuple[list[np.ndarray], np.ndarray]:
        """Label columns of the full sequences in order, and their weights."""
        at = np.arange(len(self.labels[-1]))
        columns = []
        for parents, labels in zip(reversed(self.parents), reversed(self.labels)):
            columns.append(labels[at])
            at = parents[at]
        return columns[::-1], self.weights[-1]

    def states(self, depth: int, least: int = 1) -> tuple[list[np.ndarray], np.ndarray]:
        """Label columns and weights of the states after ``depth`` labels, none
        of them an end, of at least that weight: the counts of prefixes."""
        some = np.flatnonzero((self.weights[depth - 1] >= least) & (self.labels[depth - 1] != 0))
        at, columns = some, []
        for parents, labels in zip(reversed(self.parents[:depth]), reversed(self.labels[:depth])):
            columns.append(labels[at])
            at = parents[at]
        return columns[::-1], self.weights[depth - 1][some]

    @classmethod
    def union(cls, parts: list[Counts], alphabets: list[np.ndarray], least: int = 0) -> Counts:
        """Sum of transducers; ``alphabets[i]`` maps the labels of part i."""
        found = [p.sequences() for p in parts]
        columns = [np.concatenate([a[c[d]].astype(np.uint32) for (c, _), a in zip(found, alphabets)])
                   for d in range(len(parts[0].labels))]
        return cls.build(columns, np.concatenate([w for _, w in found]), least)

    def compose(self, columns: list[np.ndarray]) -> np.ndarray:
        """The weights this transducer gives to the sequences of an acceptor,
        0 where it does not read them: both descend level by level, and a
        pair of states goes on where their labels agree."""
        state = np.zeros(len(columns[0]), dtype=np.int64)
        alive = np.ones(len(state), dtype=bool)
        for parents, labels, wanted in zip(self.parents, self.labels, columns):
            keys = (parents.astype(np.uint64) << np.uint64(32)) | labels.astype(np.uint64)
            want = (state.astype(np.uint64) << np.uint64(32)) | wanted.astype(np.uint64)
            if not len(keys):
                return np.zeros(len(state), dtype=np.int64)
            place = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            alive &= keys[place] == want
            state = np.where(alive, place, 0)
        return np.where(alive, self.weights[-1][state], 0)

    def pack(self) -> bytes:
        """Per level the number of children of each state and their labels;
        weights of the last level (all others follow)."""
        parts = []
        for parents, labels, above in zip(self.parents, self.labels, [[0], *self.labels]):
            parts += [np.bincount(parents, minlength=len(above)).astype("<u4").tobytes(), labels.astype("<u4").tobytes()]
        parts.append(self.weights[-1].astype("<i8").tobytes())
        sizes = struct.pack(f"<{len(self.labels)}Q", *map(len, self.labels))
        body = b"".join(parts)
        return _HEAD.pack(len(self.labels), len(body)) + sizes + pa.compress(body, codec="zstd", asbytes=True)

    @classmethod
    def unpack(cls, data: bytes) -> Counts:
        depth, size = _HEAD.unpack_from(data)
        sizes = struct.unpack_from(f"<{depth}Q", data, _HEAD.size)
        body = pa.decompress(memoryview(data)[_HEAD.size + 8 * depth:], size, codec="zstd", asbytes=True)
        at, above, parents, labels = 0, 1, [], []
        for n in sizes:
            children = np.frombuffer(body, "<u4", above, at)
            labels.append(np.frombuffer(body, "<u4", n, at + 4 * above).astype(np.int64))
            parents.append(np.repeat(np.arange(above), children))
            at, above = at + 4 * (above + n), n
        weights = [np.frombuffer(body, "<i8", sizes[-1], at).astype(np.int64)]
        for p, n in zip(reversed(parents[1:]), reversed(sizes[:-1])):
            # Children of a state stand together, so sums are differences.
            total = np.concatenate(([0], np.cumsum(weights[0])))
            ends = np.searchsorted(p, np.arange(n), side="right")
            weights.insert(0, np.diff(total[np.concatenate(([0], ends))]))
        return cls(parents, labels, weights)


def _exact_sums(place: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, dtype=np.int64)
    np.add.at(out, place, weights)
    return out
