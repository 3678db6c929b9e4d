"""Substring dedup: Rabin-Karp hashes of every window of words, counted in
Spark, repeated windows merged into maximal removal intervals.

Documents are grouped into ranges of ids (about ``group_bytes`` of text,
from percentiles of the id column), so that the order of groups is the
order of documents.

1. Each group hashes all its windows (prefix sums of the word hashes) and
   keeps the first occurrence of each hash: the combine before the shuffle.
   Its sorted distinct hashes go to hash buckets, packed to seven bytes,
   one row per (group, bucket). However often a window occurs, a group
   sends it once.
2. Each bucket finds, for every hash, the first group that has it, and
   answers the later groups with a bit per hash.
3. Each group reads its documents again with its answers. A window starts
   earlier if it is not the first of its group or its bit is set. Covered
   words merge into maximal intervals.

No step holds more than a group of documents or a bucket of hashes, and the
text is shuffled once (the exchange by group is reused).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import tokens as tk

_BUCKET_BYTES = 7


def _range_group(id_col: str, bounds: list[int]) -> Column:
    """Number of bounds at or below the id (null: -1), looked up in two
    steps of about sqrt(len(bounds)) comparisons each."""
    if not bounds:
        return F.when(F.col(id_col).isNull(), -1).otherwise(0).cast("long")
    width = max(1, math.isqrt(len(bounds)))
    rows = [bounds[i:i + width] for i in range(0, len(bounds), width)]
    heads = F.lit([r[0] for r in rows[1:]]).cast("array<bigint>") if len(rows) > 1 else F.array().cast("array<bigint>")
    ident = F.col(id_col)
    row = F.size(F.filter(heads, lambda x: x <= ident))
    inner = F.element_at(F.array(*[F.lit(r).cast("array<bigint>") for r in rows]), row + 1)
    return (F.when(ident.isNull(), -1)
            .otherwise(row * width + F.size(F.filter(inner, lambda x: x <= ident))).cast("long"))


def _ordered(docs: pa.Table) -> pa.Table:
    """Rows by (id, text), nulls first: the same order in both passes."""
    order = pc.sort_indices(docs, sort_keys=[("id", "ascending"), ("text", "ascending")],
                            null_placement="at_start")
    return docs.take(order)


def _windows(docs: pa.Table, window: int):
    """Distinct window hashes in sorted order, for each window of the group
    its place among them and whether it is the first with its hash there,
    the window starts, and the words (start, end, row) with their bytes."""
    data, offsets = tk.text_bytes(docs.column("text"))
    starts, ends, row = tk.words(data, offsets, tk.NON_SPACE)
    h = tk.window_hashes(tk.word_hashes(data, starts, ends), window)
    at = np.flatnonzero(row[:len(h)] == row[window - 1:]) if len(h) else np.zeros(0, dtype=np.int64)
    h = h[at]
    order = np.argsort(h, kind="stable")
    ranked = h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = ranked[1:] != ranked[:-1]
    place = np.empty(len(h), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    first = np.zeros(len(h), dtype=bool)
    first[order[new]] = True
    return ranked[new], place, first, at, (data, offsets, starts, ends, row)


def _cuts(distinct: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins among the sorted hashes (buckets are equal
    ranges of the hash)."""
    edges = np.array([(b << 64) // buckets for b in range(buckets)], dtype=tk.U64)
    return np.append(np.searchsorted(distinct, edges), len(distinct))


def _hash_rows(window: int, buckets: int):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table) -> pa.Table:
        distinct, *_ = _windows(_ordered(docs), window)
        cut = _cuts(distinct, buckets)
        raw = distinct.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_BUCKET_BYTES]
        used = np.flatnonzero(cut[1:] > cut[:-1])
        return pa.table({
            "bucket": pa.array(used, pa.int64()),
            "grp": pa.array(np.full(len(used), key[0].as_py()), pa.int64()),
            "hashes": pa.array([raw[cut[b]:cut[b + 1]].tobytes() for b in used], pa.binary()),
        })
    return run


def _earlier_rows(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """For each hash of the bucket a bit: does an earlier group have it?"""
    rows = rows.take(pc.sort_indices(rows, sort_keys=[("grp", "ascending")]))
    blobs = rows.column("hashes").to_pylist()
    counts = np.array([len(b) // _BUCKET_BYTES for b in blobs], dtype=np.int64)
    packed = np.zeros((int(counts.sum()), 8), dtype=np.uint8)
    packed[:, :_BUCKET_BYTES] = np.frombuffer(b"".join(blobs), dtype=np.uint8).reshape(-1, _BUCKET_BYTES)
    h = packed.view("<u8").ravel()
    order = np.argsort(h, kind="stable")  # equal hashes stay in group order
    seen = np.zeros(len(h), dtype=bool)
    seen[order[1:]] = h[order[1:]] == h[order[:-1]]
    ends = np.cumsum(counts)
    bits = [seen[e - n:e] for e, n in zip(ends.tolist(), counts.tolist())]
    some = [i for i, b in enumerate(bits) if b.any()]
    grp = rows.column("grp").to_numpy()
    return pa.table({
        "grp": pa.array(grp[some], pa.int64()),
        "bucket": pa.array(np.full(len(some), key[0].as_py()), pa.int64()),
        "bits": pa.array([np.packbits(bits[i]).tobytes() for i in some], pa.binary()),
    })


def _span_rows(window: int, buckets: int):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, answers: pa.Table) -> pa.Table:
        docs = _ordered(docs)
        distinct, place, first, at, (data, offsets, starts, ends, row) = _windows(docs, window)
        cut = _cuts(distinct, buckets)
        earlier = np.zeros(len(distinct), dtype=bool)
        for b, bits in zip(answers.column("bucket").to_pylist(), answers.column("bits").to_pylist()):
            n = int(cut[b + 1] - cut[b])
            earlier[cut[b]:cut[b + 1]] = np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=n).astype(bool)
        gone = at[~first | earlier[place]] if len(at) else at
        delta = np.zeros(len(starts) + 1, dtype=np.int64)
        np.add.at(delta, gone, 1)
        np.add.at(delta, gone + window, -1)
        covered = np.cumsum(delta[:-1]) > 0
        first_word = np.searchsorted(row, np.arange(docs.num_rows + 1))
        spans, kept = [], []
        body = data.tobytes()
        for i, (lo, hi) in enumerate(zip(first_word[:-1].tolist(), first_word[1:].tolist())):
            words = body[offsets[i]:offsets[i + 1]].split()
            c = covered[lo:hi]
            if c.any():
                edge = np.flatnonzero(np.diff(np.concatenate(([0], c.astype(np.int8), [0]))))
                spans.append([{"begin": int(a), "end": int(b)} for a, b in edge.reshape(-1, 2)])
                words = [w for w, out in zip(words, c.tolist()) if not out]
            else:
                spans.append([])
            kept.append(b" ".join(words).decode("utf-8"))
        return pa.table({
            "id": docs.column("id"),
            "n_words": pa.array(np.diff(first_word), pa.int64()),
            "spans": pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
            "kept_text": pa.array(kept, pa.string()),
        })
    return run


def substring_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    window: int = 20, group_bytes: int = 2 << 20,
                    bucket_hashes: int = 3_000_000) -> DataFrame:
    """One row per input row: ``id_col``, ``n_words``, ``spans`` (maximal
    [begin, end) word intervals to remove) and ``kept_text`` (the words left,
    joined by one space).

    A word goes if a window of ``window`` words over it has a word sequence
    that also starts earlier: in a smaller id, or earlier in the same text.
    Windows compare by 64-bit hashes of 64-bit word hashes.

    Defined cases: null and empty texts have no words and no spans, a text
    shorter than a window is kept; a null id counts as the smallest; rows
    with the same id are taken in order of text as if one came earlier; an
    empty table gives an empty result; other columns are not looked at. A
    very long text is one group of its own, in memory bounded by its size.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    groups = max(1, math.ceil(total / group_bytes))
    buckets = max(8, math.ceil(total / 5 / bucket_hashes))
    marks = [i / groups for i in range(1, groups)]
    bounds = []
    if marks:
        found = rows.agg(F.percentile_approx("id", marks, max(10_000, 20 * groups)).alias("p")).first()["p"]
        bounds = sorted(set(found or []))
    grouped = rows.withColumn("grp", _range_group("id", bounds)).repartition("grp")
    sent = (grouped.groupBy("grp")
            .applyInArrow(_hash_rows(window, buckets), "bucket long, grp long, hashes binary"))
    answers = (sent.groupBy("bucket")
               .applyInArrow(_earlier_rows, "grp long, bucket long, bits binary"))
    out = (grouped.groupBy("grp").cogroup(answers.groupBy("grp"))
           .applyInArrow(_span_rows(window, buckets),
                         "id long, n_words long, spans array<struct<begin:long,end:long>>, kept_text string"))
    return out.withColumnRenamed("id", id_col)
