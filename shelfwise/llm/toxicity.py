"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams.

Features of a text are its distinct words, word pairs and skip-pairs (one
word left out), hashed to 32 bits, each with value 1. FTRL-proximal keeps a
learning rate per coordinate and sets weights to zero by L1, so the
fitted model is a short list of (hash, weight) that is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import tokens as tk
from shelfwise.llm.labelled import labelled_sample


def _grams(data: np.ndarray, offsets: np.ndarray):
    """Row and 32-bit hash of every word, pair and skip-pair."""
    data = tk.LOWER[data]
    starts, ends, row = tk.words(data, offsets, tk.ALNUM)
    h = tk.word_hashes(data, starts, ends)
    rows, grams = [row], [h]
    for gap, salt in ((1, 3), (2, 5)):
        same = row[gap:] == row[:-gap]
        rows.append(row[gap:][same])
        grams.append(tk.mix64(h[:-gap] * tk.U64(salt) + h[gap:])[same])
    return np.concatenate(rows), (np.concatenate(grams) >> tk.U64(32)).astype(np.uint32)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = tk.text_bytes(batch.column("text"))
        out = []
        for i in range(batch.num_rows):
            body = data[offsets[i]:offsets[i + 1]]
            _, g = _grams(body, np.array([0, len(body)]))
            out.append(np.unique(g).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("label"), pa.array(out, pa.binary())], ["id", "label", "grams"])


class ToxicModel:
    def __init__(self, grams: np.ndarray, weights: np.ndarray, bias: float):
        self.grams, self.weights, self.bias = grams, weights, bias  # grams sorted


def ftrl(rows: list[np.ndarray], labels: np.ndarray, size: int, *, epochs: int, alpha: float, beta: float,
         l1: float, l2: float, seed: int = 11) -> tuple[np.ndarray, float]:
    """Weights of ``size`` coordinates and the bias, from one pass after the
    other over the rows in seeded order. Only a row's own coordinates are
    touched; weights follow from the sums z and n when they are needed. The
    rarer class counts by the square root of the ratio of the classes."""
    z, n = np.zeros(size), np.zeros(size)
    ones = max(1.0, labels.sum())
    weight = max(1.0, ((len(labels) - ones) / ones) ** 0.5)
    zb = nb = 0.0
    rng = np.random.default_rng(seed)

    def weights(z, n):
        w = -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at = rows[i]
            w = weights(z[at], n[at])
            b = -zb / ((beta + np.sqrt(nb)) / alpha)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + b, -35, 35))) - labels[i]
            g *= weight if labels[i] else 1.0
            for_n = np.sqrt(n[at] + g * g)
            z[at] += g - (for_n - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
            zb += g - (np.sqrt(nb + g * g) - np.sqrt(nb)) / alpha * b
            nb += g * g
    return weights(z, n), float(-zb / ((beta + np.sqrt(nb)) / alpha))


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", id_col: str = "doc_id",
        text_col: str = "text", per_class: int = 2500, min_rows: int = 4, epochs: int = 8,
        alpha: float = 1.0, beta: float = 1.0, l1: float = 6.0, l2: float = 0.01) -> ToxicModel:
    """Fits on at most ``per_class`` labelled documents of each class (the
    bound of what comes to the driver: hashes, not texts). Features are made
    in tasks; those in fewer than ``min_rows`` sampled texts are dropped.
    Without labelled rows of both classes every score is the class share."""
    sample = labelled_sample(docs, labels, label, per_class=per_class, id_col=id_col, text_col=text_col)
    got = (sample.select("id", "label", "text")
           .mapInArrow(_feature_rows, f"id {dict(sample.dtypes)['id']}, label int, grams binary")
           .orderBy("id").toArrow())
    y = got.column("label").to_numpy().astype(np.float64)
    rows = [np.frombuffer(b, dtype=np.uint32) for b in got.column("grams").to_pylist()]
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return ToxicModel(np.zeros(0, np.uint32), np.zeros(0), 6.0 * (2 * share - 1))
    grams, n = np.unique(np.concatenate(rows), return_counts=True)
    grams = grams[n >= min_rows]
    at = []
    for r in rows:
        k = np.searchsorted(grams, r)
        k[k == len(grams)] = 0
        at.append(k[grams[k] == r] if len(grams) else k[:0])
    w, bias = ftrl(at, y, len(grams), epochs=epochs, alpha=alpha, beta=beta, l1=l1, l2=l2)
    used = w != 0
    return ToxicModel(grams[used], w[used], bias)


def row_scores(data: np.ndarray, offsets: np.ndarray, model: ToxicModel) -> np.ndarray:
    total = np.full(len(offsets) - 1, model.bias)
    if len(model.grams) and len(data):
        row, g = _grams(data, offsets)
        seen = np.zeros(1 << 16, dtype=bool)
        seen[model.grams & 0xFFFF] = True
        maybe = seen[g & 0xFFFF]
        row, g = row[maybe], g[maybe]
        k = np.searchsorted(model.grams, g)
        k[k == len(model.grams)] = 0
        hit = model.grams[k] == g
        pairs = np.unique(row[hit] * len(model.grams) + k[hit])  # a feature counts once a text
        np.add.at(total, pairs // len(model.grams), model.weights[pairs % len(model.grams)])
    return 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))


def score(docs: DataFrame, model: ToxicModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col`` and ``score`` (0 to 1).

    Only the text is looked at. Defined cases: null and empty texts score by
    the bias alone; repeated rows score the same; null ids are passed
    through; an empty table gives an empty result; long texts are searched
    whole, in blocks of bytes.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tk.text_bytes(batch.column("text"))
            out = np.empty(batch.num_rows)
            for lo, hi in tk.pieces(offsets):
                out[lo:hi] = row_scores(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(out)], [id_col, "score"])

    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` {dict(rows.dtypes)[id_col]}, score double")
