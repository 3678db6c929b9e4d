"""SimHash near-dedup with deletion-variant signatures.

A fingerprint is cut into two 32-bit segments. Of at most three differing
bits, one segment gets at most one, so two linked fingerprints share a
segment up to one bit: they agree on one of that segment's 32 one-wildcard
variants. Every distinct fingerprint is listed under its 64 variants, an
equality on the variant brings candidates together, and the bit distance
verifies them.

Copies and equal fingerprints meet in a hash aggregate first, so the index
holds each fingerprint once. Under one variant at most 2**33 fingerprints
can differ; a run of equal variants is searched breadth first, and only a
spanning forest of its verified links leaves the task, so the output never
grows with the pairs. Components come from the distributed label exchange
of ``components``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.components import connected_components
from shelfwise.llm.tables import rows_with_keys, written

SEED = 42
SEGMENTS = 2
BITS = 32


def fingerprint(text: str | None, shingle: int) -> int:
    """SimHash of one text, as a signed 64-bit value. A-Z are lower-cased;
    shingles are word runs joined by one space, repeats included; a text of
    fewer words is one shingle, a text without words has fingerprint 0."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        end = np.cumsum(size + 1) - 1
        begin = end - size
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in
                  zip(begin[:len(words) - shingle + 1].tolist(), end[shingle - 1:].tolist())]
    ones = np.zeros(64, dtype=np.int64)
    for lo in range(0, len(hashes), 1 << 16):  # bounds the unpacked bits of a long text
        part = np.array(hashes[lo:lo + (1 << 16)], dtype="<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = ones * 2 > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_key"), pa.array(fps, pa.int64())], ["id", "text_key", "fp"])
    return run


def _variants() -> Column:
    """The 64 keys of a fingerprint: (segment, wildcard) in the key's low
    bits, the segment without the wildcard's bit above them."""
    keys = []
    for s in range(SEGMENTS):
        seg = F.shiftrightunsigned(F.col("fp"), s * BITS).bitwiseAND(F.lit(0xFFFFFFFF))
        for i in range(BITS):
            masked = seg.bitwiseAND(F.lit(0xFFFFFFFF & ~(1 << i)))
            keys.append(F.shiftleft(masked, 6).bitwiseOR(F.lit(s * BITS + i).cast("long")))
    return F.array(*keys)


def _run_links(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within one run (positions): each
    fingerprint reached is compared once with those not reached yet."""
    out: list[tuple[int, int]] = []
    left = np.arange(len(fps))
    while len(left):
        reached, left = [int(left[0])], left[1:]
        while reached and len(left):
            i = reached.pop()
            near = np.bitwise_count(fps[left] ^ fps[i]) <= distance
            got = left[near].tolist()
            if got:
                out += [(i, j) for j in got]
                reached += got
                left = left[~near]
    return out


def _links(distance: int):
    def settle(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        edge = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(edge, len(key)))
        two = edge[size == 2]
        two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= distance]
        a, b = [fp[two]], [fp[two + 1]]
        for lo, n in zip(edge[size > 2].tolist(), size[size > 2].tolist()):
            got = _run_links(fp[lo:lo + n], distance)
            if got:
                i = np.array(got, dtype=np.int64) + lo
                a.append(fp[i[:, 0]])
                b.append(fp[i[:, 1]])
        x, y = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
        if len(x):
            pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.concatenate([key, batch.column("key").to_numpy()])
            fp = np.concatenate([fp, batch.column("fp").to_numpy()])
            cut = int(np.searchsorted(key, key[-1]))  # rows come sorted by key
            if cut:
                yield from settle(key[:cut], fp[:cut].view(np.uint64))
                key, fp = key[cut:], fp[cut:]
        if len(key):
            yield from settle(key, fp.view(np.uint64))
    return run


def text_key(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row per input row: ``id_col``, ``text_key`` (a hash of the text),
    ``fingerprint`` (signed 64-bit), ``component_id``, the smallest id
    reachable over links of at most ``distance`` (0 to 3) differing bits, the
    row's own included, and ``kept``, true for one row of each component, one
    with its smallest id. Tables written on the way hold no text.

    Defined cases: texts without words (null, empty, white space) have
    fingerprint 0 and link like any other; rows repeated with the same id
    give one row each and link only by their fingerprints; a null id gets
    the component of its fingerprint, and null where all rows of the
    component have null ids; an empty table gives an empty result; other
    columns are not looked at.
    """
    if not 0 <= distance <= 2 * SEGMENTS - 1:
        raise ValueError("two segments with one wildcard find at most three differing bits")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_key(text_col).alias("text_key"),
                       F.col(text_col).alias("text"))
    prints = written(rows.mapInArrow(_fingerprints(shingle), "id long, text_key long, fp long")
                     .withColumn("row", F.monotonically_increasing_id()), "simhash-prints")
    # A node per distinct fingerprint; its label is its smallest id.
    nodes = written(prints.groupBy("fp").agg(F.min("id").alias("label")), "simhash-nodes")
    keyed = nodes.select("fp", F.explode(_variants()).alias("key"))
    links = (keyed.repartition("key").sortWithinPartitions("key")
             .mapInArrow(_links(distance), "a long, b long"))
    classes = written(connected_components(links, nodes.select(F.col("fp").alias("node"), "label")),
                      "simhash-classes")
    # One row for each component: the smallest id, one of its rows.
    by_print = prints.groupBy("fp").agg(F.min("id").alias("id"), F.min_by("row", "id").alias("row"),
                                        F.min("row").alias("any_row"))
    stays = (by_print.join(classes, by_print["fp"] == classes["node"]).groupBy("root")
             .agg(F.coalesce(F.min_by("row", "id"), F.min("any_row")).alias("keep_row")))
    classes = written(classes.join(stays, "root"), "simhash-stays")
    out = prints.join(classes, prints["fp"] == classes["node"])
    return out.select(F.col("id").alias(id_col), "text_key", F.col("fp").alias("fingerprint"), F.col("component").alias("component_id"),
                      (F.col("row") == F.col("keep_row")).alias("kept"))


def drop_near_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                     shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row of each component, with all its columns."""
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, shingle=shingle, distance=distance)
    stays = found.where("kept").select(id_col, "text_key")
    return rows_with_keys(docs, [F.col(id_col).cast("long"), text_key(text_col)], stays, "left_semi")
