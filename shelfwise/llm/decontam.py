"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The test strings are runs of item words. For each pattern length m a block
is the last two words under the search position:

* the shift table says, by the block's hash, how far the position may move
  without missing an occurrence (m - 1 where no pattern has the block);
* where the shift is zero, the patterns that end in the block and begin
  with the window's first block are the bucket to test;
* a test compares the words themselves.

A whole Arrow batch is searched at once: its words are cut into a few
thousand lanes whose positions move independently, so every step is one
numpy operation over all lanes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm import tokens as tk
from shelfwise.llm.tables import carried, written

_TABLE_BITS = 18
_LANES = 4096


def _split(text: bytes):
    """Lower-cased words of one text with their hashes."""
    data = tk.LOWER[np.frombuffer(text, dtype=np.uint8)]
    starts, ends, _ = tk.words(data, np.array([0, len(data)]), tk.ALNUM)
    body = data.tobytes()
    return [body[a:b] for a, b in zip(starts.tolist(), ends.tolist())], tk.word_hashes(data, starts, ends)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return tk.mix64(a * tk.U64(3) + b)


class Patterns:
    """The tables for one set of items [(item id, text)]."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        found: dict[bytes, set[str]] = {}
        hashed: dict[bytes, np.ndarray] = {}
        for item, text in items:
            words, h = _split((text or "").encode("utf-8"))
            m = min(window, len(words))
            for i in range(len(words) - m + 1 if m else 0):
                p = b" ".join(words[i:i + m])
                found.setdefault(p, set()).add(item)
                hashed[p] = h[i:i + m]
        self.items = {p: sorted(s) for p, s in found.items()}
        lengths: dict[int, list[bytes]] = {}
        for p in sorted(found):
            lengths.setdefault(len(hashed[p]), []).append(p)
        self.tables = [self._table(m, ps, np.stack([hashed[p] for p in ps])) for m, ps in sorted(lengths.items())]

    @staticmethod
    def _table(m: int, patterns: list[bytes], h: np.ndarray) -> dict:
        block = min(2, m)
        shift = np.full(1 << _TABLE_BITS, m - block + 1, dtype=np.int64)
        for end in range(block - 1, m):
            key = _blocks(h[:, end - 1], h[:, end], block)
            np.minimum.at(shift, key >> tk.U64(64 - _TABLE_BITS), m - 1 - end)
        bucket = _bucket(h, block)
        order = np.argsort(bucket, kind="stable")
        return {"m": m, "block": block, "shift": shift, "bucket": bucket[order],
                "pattern": [patterns[i] for i in order]}


def _blocks(before: np.ndarray, last: np.ndarray, block: int) -> np.ndarray:
    return _pair(before, last) if block == 2 else tk.mix64(last)


def _bucket(h: np.ndarray, block: int) -> np.ndarray:
    """Key of a window's last and first block."""
    return _blocks(h[:, -2] if block == 2 else h[:, -1], h[:, -1], block) ^ (
        _blocks(h[:, 0], h[:, 1] if block == 2 else h[:, 0], block) * tk.U64(5))


def search(h: np.ndarray, row: np.ndarray, table: dict) -> tuple[np.ndarray, np.ndarray]:
    """Window starts and the first bucket entry of each candidate."""
    m, block, n = table["m"], table["block"], len(h)
    if n < m:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    edge = np.linspace(0, n - m + 1, min(_LANES, n - m + 1) + 1).astype(np.int64)
    pos, stop = edge[:-1] + m - 1, edge[1:] + m - 1  # a lane has the windows that start in it
    zero = []
    while len(pos):
        key = _blocks(h[pos - 1] if block == 2 else h[pos], h[pos], block)
        step = table["shift"][key >> tk.U64(64 - _TABLE_BITS)]
        hit = step == 0
        if hit.any():
            zero.append(pos[hit])
        pos = pos + np.maximum(step, 1)
        live = pos < stop
        pos, stop = pos[live], stop[live]
    if not zero:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    start = np.sort(np.concatenate(zero)) - (m - 1)
    start = start[row[start] == row[start + m - 1]]
    key = _bucket(np.stack([h[start + i] for i in sorted({0, min(1, m - 1), max(0, m - 2), m - 1})], axis=1)
                  if m > 1 else h[start][:, None], block)
    at = np.searchsorted(table["bucket"], key)
    known = at < len(table["bucket"])
    known[known] = table["bucket"][at[known]] == key[known]
    return start[known], at[known]


def _scan(patterns: Patterns):
    """Adds to each row's spans and items what the patterns find."""
    def rows(body, ids, earlier) -> pa.RecordBatch:
        data, offsets = tk.text_bytes(body)
        data = tk.LOWER[data]
        starts, ends, row = tk.words(data, offsets, tk.ALNUM)
        h = tk.word_hashes(data, starts, ends)
        delta = np.zeros(len(starts) + 1, dtype=np.int64)
        items: dict[int, set[str]] = {}
        raw = data.tobytes()
        for t in patterns.tables:
            m, bucket, names = t["m"], t["bucket"], t["pattern"]
            begin, at = search(h, row, t)
            for i, k in zip(begin.tolist(), at.tolist()):
                key = bucket[k]
                text = b" ".join([raw[a:b] for a, b in zip(starts[i:i + m].tolist(), ends[i:i + m].tolist())])
                while k < len(bucket) and bucket[k] == key:
                    if names[k] == text:
                        delta[i] += 1
                        delta[i + m] -= 1
                        items.setdefault(int(row[i]), set()).update(patterns.items[text])
                        break
                    k += 1
        n = len(ids)
        first = np.searchsorted(row, np.arange(n + 1))
        spans_of, items_of = earlier
        for r in np.flatnonzero([bool(s) for s in spans_of]).tolist():  # of earlier blocks of items
            for s in spans_of[r]:
                delta[first[r] + s["begin"]] += 1
                delta[first[r] + s["end"]] -= 1
            items.setdefault(r, set()).update(items_of[r])
        covered = np.cumsum(delta[:-1]) > 0
        spans: list[list[dict]] = [[] for _ in range(n)]
        for r in items:
            c = covered[first[r]:first[r + 1]].astype(np.int8)
            edge = np.flatnonzero(np.diff(np.concatenate(([0], c, [0]))))
            spans[r] = [{"begin": int(a), "end": int(b)} for a, b in edge.reshape(-1, 2)]
        return pa.RecordBatch.from_arrays([
            ids, body, pa.array(np.diff(first), pa.int64()),
            pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
            pa.array([sorted(items.get(r, ())) for r in range(n)], pa.list_(pa.string())),
        ], ["key", "text", "n_words", "spans", "items"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = tk.text_bytes(batch.column("text"))
            for lo, hi in tk.pieces(offsets):
                part = batch.slice(lo, hi - lo)
                had = (part.column("spans").to_pylist(), part.column("items").to_pylist())
                yield rows(part.column("text"), part.column("key"), had)
    return run


def item_blocks(items: DataFrame, limit: int) -> int:
    """Number of blocks so that one holds about ``limit`` bytes of text."""
    total = items.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    return max(1, -(-total // limit))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = 10,
                  carry: list[str] | None = None, block_bytes: int = 8 << 20) -> DataFrame:
    """One row per input row: ``id_col``, ``n_words``, ``spans`` (maximal
    [begin, end) word intervals inside occurrences of item windows) and
    ``items`` (sorted ids, as strings, of the items with occurring windows),
    and with ``carry`` the named input columns in a struct ``carried``.

    A window is ``window`` consecutive words of an item, or the whole item
    where it has fewer words. The items are the query set, searched in
    blocks of about ``block_bytes`` of item text: one block's tables are
    sent to the tasks, all documents are searched, and the next block goes
    over the written result, so no broadcast grows with the benchmark.

    Defined cases: null and empty texts have no words; items without words
    have no windows; items repeated with the same id count once; a null item
    id is the empty string; an empty benchmark finds nothing; an empty
    ``docs`` gives an empty result; a null document id is passed through;
    other columns are not looked at unless named in ``carry``.
    """
    spans_type = T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))
    others = [c for c in carry or [] if c != text_col]
    key = F.struct(F.col(id_col).alias("id"), carried(others).alias("others"))
    state = docs.select(key.alias("key"), F.col(text_col).alias("text"),
                        F.array().cast(spans_type).alias("spans"),
                        F.array().cast("array<string>").alias("items"))
    tests = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                             F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    blocks = item_blocks(tests, block_bytes)
    schema = T.StructType([T.StructField("key", state.schema["key"].dataType), T.StructField("text", T.StringType()),
                           T.StructField("n_words", T.LongType()), T.StructField("spans", spans_type),
                           T.StructField("items", T.ArrayType(T.StringType()))])
    for b in range(blocks):
        part = tests.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
        patterns = Patterns([(r["item"], r["text"]) for r in part.collect()], window)
        if b:
            state = written(state, "decontam-block")
        state = state.select("key", "text", "spans", "items").mapInArrow(_scan(patterns), schema)
    row = F.struct(*[(F.col("text") if c == text_col else F.col(f"key.others.`{c}`")).alias(c) for c in carry or []])
    return state.select(F.col("key.id").alias(id_col), *([row.alias("carried")] if carry else []),
                        "n_words", "spans", "items")
