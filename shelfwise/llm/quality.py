"""Quality: histogram gradient-boosted trees over document statistics.

Tasks compute the statistics with numpy over whole Arrow batches. The trees
are grown level by level on binned statistics of a bounded labelled sample
and flattened into arrays (feature, threshold, leaf value by node number),
so a batch of documents walks down all at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import tokens as tk
from shelfwise.llm.labelled import labelled_sample

STATISTICS = [
    "log_bytes", "log_words", "mean_word", "upper_share", "digit_share", "punctuation_share",
    "symbol_share", "bang_share", "wide_share", "control_share", "space_share", "distinct_words",
    "top_word_share", "lines_per_word", "distinct_lines", "repeated_line_bytes", "long_word_share",
    "marked_word_share", "upper_word_share", "mean_line",
]

_LOWER, _UPPER, _DIGIT, _PUNCT, _SYMBOL, _BANG, _WIDE, _CONTROL, _SPACE, _NEWLINE = range(10)
_KIND = np.full(256, _SYMBOL, dtype=np.int64)
_KIND[0x00:0x20] = _CONTROL
_KIND[0x61:0x7B], _KIND[0x41:0x5B], _KIND[0x30:0x3A] = _LOWER, _UPPER, _DIGIT
_KIND[0x7F], _KIND[0x80:] = _CONTROL, _WIDE
_KIND[[ord(c) for c in ".,;:'\"()-"]] = _PUNCT
_KIND[[ord(c) for c in "!?"]] = _BANG
_KIND[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = _SPACE
_KIND[0x0A] = _NEWLINE
_NOT_NEWLINE = ~tk.byte_class([0x0A])


def _per_row(row: np.ndarray, n: int, weights=None) -> np.ndarray:
    return np.bincount(row, weights=weights, minlength=n).astype(np.float64)


def _repeats(row: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and the count of the most frequent one, per row."""
    key = np.sort((row.astype(np.uint64) << tk.U64(40)) | (h >> tk.U64(24)))
    edge = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, dtype=np.int64)
    size = np.diff(np.append(edge, len(key)))
    at = (key[edge] >> tk.U64(40)).astype(np.int64)
    top = np.zeros(n)
    np.maximum.at(top, at, size)
    return _per_row(at, n), top


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """[row, STATISTICS] of some texts given as bytes."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(np.float64)
    kind = np.zeros((n, 10))
    for lo, hi in tk.pieces(offsets, tk.BLOCK):
        own = np.repeat(np.arange(hi - lo), np.diff(offsets[lo:hi + 1]))
        kind[lo:hi] = np.bincount(own * 10 + _KIND[data[offsets[lo]:offsets[hi]]],
                                  minlength=10 * (hi - lo)).reshape(-1, 10)
    starts, ends, row = tk.words(data, offsets, tk.NON_SPACE)
    words = _per_row(row, n)
    length = (ends - starts).astype(np.float64)
    distinct, top = _repeats(row, tk.word_hashes(data, starts, ends), n)
    last = _KIND[data[ends - 1]] if len(ends) else np.zeros(0, dtype=np.int64)
    upper = np.concatenate([[0], np.cumsum(_KIND[data] == _UPPER, dtype=np.int32)])
    lower = np.concatenate([[0], np.cumsum(_KIND[data] == _LOWER, dtype=np.int32)])
    shout = (upper[ends] - upper[starts] > 1) & (lower[ends] == lower[starts])
    begin, stop, line_row = tk.words(data, offsets, _NOT_NEWLINE)
    lines = _per_row(line_row, n)
    line_hash = tk.word_hashes(data, begin, stop)
    distinct_lines, _ = _repeats(line_row, line_hash, n)
    order = np.lexsort((line_hash, line_row))
    again = np.zeros(len(begin), dtype=bool)
    again[order[1:]] = (line_hash[order[1:]] == line_hash[order[:-1]]) & (line_row[order[1:]] == line_row[order[:-1]])
    per_byte, per_word, per_line = np.maximum(size, 1), np.maximum(words, 1), np.maximum(lines, 1)
    return np.stack([
        np.log1p(size), np.log1p(words), _per_row(row, n, length) / per_word,
        kind[:, _UPPER] / per_byte, kind[:, _DIGIT] / per_byte, kind[:, _PUNCT] / per_byte,
        kind[:, _SYMBOL] / per_byte, kind[:, _BANG] / per_byte, kind[:, _WIDE] / per_byte,
        kind[:, _CONTROL] / per_byte, (kind[:, _SPACE] + kind[:, _NEWLINE]) / per_byte,
        distinct / per_word, top / per_word, lines / per_word, distinct_lines / per_line,
        _per_row(line_row[again], n, (stop - begin)[again]) / per_byte,
        _per_row(row[length > 20], n) / per_word,
        _per_row(row[(last == _SYMBOL) | (last == _BANG)], n) / per_word,
        _per_row(row[shout], n) / per_word, size / per_line,
    ], axis=1)


def _statistic_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = tk.text_bytes(batch.column("text"))
        for lo, hi in tk.pieces(offsets):
            x = statistics(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
            part = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("label"), pa.array(list(x), pa.list_(pa.float64()))],
                ["id", "label", "x"])


class Trees:
    """Complete binary trees of one depth in flat arrays: node k has the
    children 2k + 1 and 2k + 2, a statistic above the threshold goes right."""

    def __init__(self, feature: np.ndarray, threshold: np.ndarray, leaf: np.ndarray, base: float):
        self.feature, self.threshold, self.leaf, self.base = feature, threshold, leaf, base

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            while len(node) and node[0] < inner:  # all rows are on one level
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.raw(x), -35, 35)))


def grow(x: np.ndarray, y: np.ndarray, *, trees: int, depth: int, bins: int, rate: float,
         l2: float, min_hessian: float) -> Trees:
    """Gradient boosting of the logistic loss on histograms: per level one
    histogram of gradients and hessians over (node, statistic, bin)."""
    n, f = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="higher")) for j in range(f)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    inner, width = (1 << depth) - 1, bins + 1
    feature = np.zeros((trees, inner), dtype=np.int64)
    threshold = np.full((trees, inner), np.inf)  # a node that isn't split sends all left
    leaf = np.zeros((trees, inner + 1))
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    total = np.full(n, base)
    cell = np.arange(f) * width + binned
    for t in range(trees):
        p = 1.0 / (1.0 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, here = (1 << level) - 1, 1 << level
            at = ((node - first)[:, None] * (f * width) + cell).ravel()
            hist = [np.bincount(at, weights=np.repeat(v, f), minlength=here * f * width).reshape(here, f, width)
                    for v in (g, h)]
            gl, hl = (np.cumsum(v, axis=2) for v in hist)
            gt, ht = gl[:, :, -1:], hl[:, :, -1:]
            gain = gl ** 2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt ** 2 / (ht + l2)
            gain[(hl < min_hessian) | (ht - hl < min_hessian)] = 0
            best = gain.reshape(here, -1).argmax(axis=1)
            for k in range(here):
                j, b = divmod(int(best[k]), width)
                if gain[k, j, b] > 1e-9 and b < len(cuts[j]):
                    feature[t, first + k], threshold[t, first + k] = j, cuts[j][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > threshold[t, node])
        node -= inner
        gs, hs = (np.bincount(node, weights=v, minlength=inner + 1) for v in (g, h))
        leaf[t] = -rate * gs / (hs + l2)
        total += leaf[t][node]
    return Trees(feature, threshold, leaf, base)


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "quality", id_col: str = "doc_id",
        text_col: str = "text", per_class: int = 4000, trees: int = 60, depth: int = 4, bins: int = 64,
        rate: float = 0.2, l2: float = 1.0, min_hessian: float = 1.0) -> Trees:
    """Fits on at most ``per_class`` labelled documents of each class (the
    bound of the rows of statistics that come to the driver). The base score
    is set to the class share of all labelled rows given, so scores keep the
    corpus odds. Without labelled rows every score is 0.5."""
    sample = labelled_sample(docs, labels, label, per_class=per_class, id_col=id_col, text_col=text_col)
    got = (sample.select("id", "label", "text")
           .mapInArrow(_statistic_rows, f"id {dict(sample.dtypes)['id']}, label int, x array<double>")
           .orderBy("id").toArrow())
    y = got.column("label").to_numpy().astype(np.float64)
    if not len(y):
        return Trees(np.zeros((0, 1), dtype=np.int64), np.zeros((0, 1)), np.zeros((0, 2)), 0.0)
    x = np.stack(got.column("x").to_pylist())
    model = grow(x, y, trees=trees, depth=depth, bins=bins, rate=rate, l2=l2, min_hessian=min_hessian)
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull())
    ones, rows = known.agg(F.sum(F.col(label).cast("double")), F.count(F.lit(1))).first()
    share = min(max((ones or 0.0) / max(rows, 1), 1e-6), 1 - 1e-6)
    model.base += float(np.log(share / (1 - share))) - model.base  # the sample is balanced by class
    return model


def score(docs: DataFrame, model: Trees, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, ``score`` (0 to 1) and the
    document statistics (``statistics``, in the order of STATISTICS).

    Only the text is looked at. Defined cases: null and empty texts have all
    statistics 0 and the score of such a row; repeated rows score the same;
    null ids are passed through; an empty table gives an empty result; whole
    texts are read, however long.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tk.text_bytes(batch.column("text"))
            for lo, hi in tk.pieces(offsets):
                x = statistics(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                ids = batch.column(id_col).slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(shared.value.score(x)), pa.array(list(x), pa.list_(pa.float64()))],
                    [id_col, "score", "statistics"])

    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` {dict(rows.dtypes)[id_col]}, score double, statistics array<double>")
