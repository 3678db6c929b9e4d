"""Re-Pair grammars over sequences of token ids, as numpy arrays.

A grammar is a base (ids below it are terminals), rules (row k gives the two
symbols that nonterminal base + k stands for, both smaller than it) and a
sequence of symbols.
"""

from __future__ import annotations

import numpy as np


def _frequent_pairs(s: np.ndarray, min_count: int, slack: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Left symbols, right symbols and counts of the adjacent pairs that occur
    ``min_count`` times and a ``slack``-th as often as the most frequent."""
    wide = int(s.max()) >= 1 << 16
    kind, shift = (np.uint64, 32) if wide else (np.uint32, 16)
    keys = s[:-1].astype(kind)
    keys <<= kind(shift)
    keys |= s[1:].astype(kind, copy=False)
    keys.sort()
    # Only keys that occur min_count times recur so many places later, each
    # min_count - 1 times less than it occurs.
    later = keys[min_count - 1:]
    keys = keys[:len(later)][later == keys[:len(later)]]
    if not len(keys):
        return (np.zeros(0, dtype=np.int64),) * 3
    edge = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True])))
    counts = np.diff(edge) + min_count - 1
    some = np.flatnonzero(counts >= int(counts.max()) // slack)
    keys = keys[edge[some]]
    return (keys >> kind(shift)).astype(np.int64), (keys & kind((1 << shift) - 1)).astype(np.int64), counts[some]


def _replaced(s: np.ndarray, left: np.ndarray, right: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """``s`` with occurrences of the pairs replaced, and whether each pair was
    at all; those that were are numbered from ``first``. Where two occurrences
    overlap the one of the earlier pair goes first, of equal ones the left
    one; the other may follow in the next round."""
    n, size = len(left), int(s.max()) + 1
    row, col, side = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.uint8)
    ls, rs = np.unique(left), np.unique(right)
    row[ls], col[rs] = np.arange(len(ls)) * len(rs), np.arange(len(rs))
    rank = np.full(len(ls) * len(rs), n, dtype=np.int32)
    rank[row[left] + col[right]] = np.arange(n)
    # Where a left symbol stands before a right one, then where a pair does.
    side[ls] = 1
    side[rs] += 2
    sides = side[s]
    at = np.flatnonzero((sides[:-1] & (sides[1:] >> 1) & 1).view(bool))
    own = rank[row[s[at]] + col[s[1:][at]]]
    some = own < n
    at, own = at[some], own[some]
    next_to = at[1:] == at[:-1] + 1
    before, after = np.full(len(own), n, dtype=np.int32), np.full(len(own), n, dtype=np.int32)
    before[1:], after[:-1] = np.where(next_to, own[:-1], n), np.where(next_to, own[1:], n)
    fits = (own <= before) & (own <= after)
    again = np.flatnonzero(own == before)
    if len(again):  # a run of one symbol: every second place of it
        first_again = np.diff(again, prepend=-1) != 1
        fits[again] &= (again - np.maximum.accumulate(np.where(first_again, again, 0))) % 2 == 1
    hit, pair = at[fits], own[fits]
    live = np.bincount(pair, minlength=n) > 0
    out = s.copy()
    out[hit] = (first + np.cumsum(live) - 1)[pair]
    keep = np.ones(len(s), dtype=bool)
    keep[hit + 1] = False
    return out[keep], live


def compress(ids: np.ndarray, base: int, min_count: int = 16, slack: int = 64, rounds: int = 6,
             batch: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Rules (k x 2) and sequence of a Re-Pair grammar of ``ids`` (each below
    ``base``). A round replaces the most frequent pairs, down to a
    ``slack``-th of the top count, by nonterminals of their own. Rounds end
    when no pair occurs ``min_count`` times, after ``rounds``, or when the
    symbols of 16 bits are used up where the base leaves such; this bounds
    the effort only, the grammar always stands for all ids."""
    limit = 1 << 16 if base < 1 << 16 else 1 << 31
    s, rules = np.ascontiguousarray(ids, dtype=np.uint32), np.zeros((0, 2), dtype=np.uint32)
    for _ in range(rounds):
        room = min(batch, limit - base - len(rules))
        if len(s) < 2 or room <= 0:
            break
        left, right, counts = _frequent_pairs(s, max(1, min_count), slack)
        some = np.argsort(-counts, kind="stable")[:room]
        if not len(some):
            break
        # Pairs of about equal count go in a scattered order: along a repeated
        # passage, whose pairs overlap one another, a third is replaced at once.
        level = np.frexp(counts[some].astype(float))[1]
        some = some[np.lexsort(((left[some] * 31 + right[some]) * 2654435761 % 4093, -level))]
        # A pair that always gave way needs no rule.
        s, live = _replaced(s, left[some], right[some], base + len(rules))
        rules = np.concatenate((rules, np.stack((left[some][live], right[some][live]), 1).astype(np.uint32)))
    return rules, s


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """Number of ids each nonterminal stands for."""
    out: list[int] = []
    for a, b in rules.tolist():
        out.append((out[a - base] if a >= base else 1) + (out[b - base] if b >= base else 1))
    return np.array(out, dtype=np.int64)


def gather(flat: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices [begin, begin + size) of ``flat``, one after the other."""
    ends = np.cumsum(sizes)
    at = np.repeat(begins - (ends - sizes), sizes)
    at += np.arange(len(at))
    return flat[at]


def _rounds(s: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """Each round replaces every nonterminal by its two symbols, as often as
    the grammar is deep."""
    s = s.astype(np.uint32)
    while len(s):
        deep = s >= base
        if not deep.any():
            break
        at = np.cumsum(deep) - deep + np.arange(len(s))
        out = np.empty(len(s) + int(deep.sum()), dtype=np.uint32)
        out[at[~deep]] = s[~deep]
        two = rules[s[deep] - base]
        out[at[deep]], out[at[deep] + 1] = two[:, 0], two[:, 1]
        s = out
    return s


def expand(s: np.ndarray, rules: np.ndarray, base: int, lengths: np.ndarray | None = None) -> np.ndarray:
    """The ids of a sequence of symbols. Given the expansion lengths, every
    rule is expanded once and the sequence gathers from that, unless the
    rules are longer than what the sequence stands for."""
    if lengths is None or not len(rules):
        return _rounds(s, rules, base)
    sizes, deep = np.ones(len(s), dtype=np.int64), s >= base
    begins = s.astype(np.int64)  # terminals stand first in the flat table
    begins[deep] -= base
    sizes[deep] = lengths[begins[deep]]
    if int(lengths.sum()) > 4 * int(sizes.sum()) + (1 << 16):
        return _rounds(s, rules, base)
    bodies = _rounds(np.arange(base, base + len(rules), dtype=np.uint32), rules, base)
    known, first = np.arange(base, dtype=np.uint32), np.cumsum(lengths) - lengths
    begins[deep] = base + first[begins[deep]]
    return gather(np.concatenate((known, bodies)), begins, sizes)


def expand_range(s: np.ndarray, rules: np.ndarray, lengths: np.ndarray, base: int, lo: int, hi: int) -> np.ndarray:
    """Ids ``lo`` to ``hi`` (exclusive) alone: the expansion lengths name the
    symbols that hold them, and only those are expanded."""
    size = np.ones(len(s), dtype=np.int64)
    deep = s >= base
    size[deep] = lengths[s[deep].astype(np.int64) - base]
    ends = np.cumsum(size)
    i, j = int(np.searchsorted(ends, lo, side="right")), int(np.searchsorted(ends, hi, side="left")) + 1
    before = int(ends[i - 1]) if i else 0
    return expand(s[i:j], rules, base)[lo - before:hi - before]
