"""Phrase collocations: counts of word sequences by weighted acyclic automata.

Texts are encoded as shards of word numbers and written. Every shard learns
which of its words and word pairs are frequent over all shards; then it sorts
its sequences of up to five words, each cut at its first rare pair, and builds
count transducers from them, cut into ranges of prefixes. Spark brings the
parts of a range together, where their union sums the weights by prefix.
Sequences frequent enough become a table, and the counts of a phrase's parts
are looked up by composing transducers of that table with the parts asked for.

Prefixes of one and of two words have transducers (and ranges) of their own,
longer ones are dealt out by their first three words, so a frequent word or
word pair loads no single range; a frequent passage is one sequence a shard.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm import tokens as tk
from shelfwise.llm.automata import Counts
from shelfwise.llm.tables import written

UNDETERMINED = "und"
_BREAKS = tk.byte_class([*b".,;:!?", *range(0x0A, 0x0E)])
_WORD = ~(_BREAKS | tk.byte_class([0x20, 0x09]))
_FOUND = "lang string, m int, phrase string, f long"


# --------------------------------------------------------------------------
# Shards
# --------------------------------------------------------------------------

def _cut_words(texts: pa.Array):
    """Words of the lower-cased texts: bytes, starts, ends, row, and for each
    word how many words follow it in its piece."""
    data, offsets = tk.text_bytes(texts)
    data = tk.LOWER[data]
    starts, ends, row = tk.words(data, offsets, _WORD)
    n = len(starts)
    if not n:
        return data, starts, ends, row, np.zeros(0, dtype=np.int64)
    # A piece ends at a break between two words, and with its text.
    breaks = np.concatenate(([0], np.cumsum(_BREAKS[data], dtype=np.int32)))  # a batch is under 2 GB
    last = np.ones(n, dtype=bool)
    last[:-1] = (breaks[starts[1:]] != breaks[ends[:-1]]) | (row[1:] != row[:-1])
    end = np.flatnonzero(last)
    after = end[np.searchsorted(end, np.arange(n))] - np.arange(n)
    return data, starts, ends, row, after


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words at the given places as a binary column."""
    sizes = ends - starts
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [
        None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data[at].tobytes())])


def _zip(a: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(a).tobytes()
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def _unzip(data: bytes, kind) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    return np.frombuffer(pa.decompress(memoryview(data)[8:], size, codec="zstd", asbytes=True) if size else b"", kind)


def _pack_words(words: pa.Array) -> tuple[bytes, bytes]:
    raw, offsets = tk.text_bytes(words.cast(pa.large_string()))
    return _zip(np.diff(offsets).astype("<u4")), _zip(raw)


def _unpack_words(sizes: bytes, body: bytes) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum(_unzip(sizes, "<u4").astype(np.int64))))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [
        None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(_unzip(body, "u1").tobytes())])


_SHARD = ("shard long, names array<string>, n array<long>, sizes binary, words binary, tokens binary, langs binary, "
          "after binary")


def _encode(longest: int, shard_bytes: int):
    """Texts to shards: the distinct words, and per word of the text its
    number, its language and how many words follow it in its piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shard = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        size = 0

        def packed():
            rows = pa.Table.from_batches(held)
            data, starts, ends, row, after = _cut_words(rows.column(1))
            _, first, word = np.unique(tk.word_hashes(data, starts, ends), return_index=True, return_inverse=True)
            names = pc.fill_null(rows.column(0).combine_chunks(), UNDETERMINED).dictionary_encode()
            lang = names.indices.to_numpy(zero_copy_only=False)[row]
            sizes, words = _pack_words(_strings(data, starts[first], ends[first]))
            return pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int64()), "names": pa.array([names.dictionary.to_pylist()], pa.list_(pa.string())),
                "n": pa.array([np.bincount(lang, minlength=len(names.dictionary)).tolist()], pa.list_(pa.int64())),
                "sizes": pa.array([sizes], pa.binary()), "words": pa.array([words], pa.binary()),
                "tokens": pa.array([_zip(word.astype("<u4"))], pa.binary()), "langs": pa.array([_zip(lang.astype("<u4"))], pa.binary()),
                "after": pa.array([_zip(np.minimum(after, longest - 1).astype("u1"))], pa.binary())})

        for batch in batches:
            _, offsets = tk.text_bytes(batch.column(1))
            for lo, hi in tk.pieces(offsets, shard_bytes):
                held.append(batch.slice(lo, hi - lo))
                size += int(offsets[hi] - offsets[lo])
                if size >= shard_bytes:
                    yield packed()
                    held, size, shard = [], 0, shard + 1
        if held:
            yield packed()
    return run


class _Shard:
    """An encoded shard, with the hash of the first 1, 2 and 3 words from
    every place on (language included; they depend on the words alone)."""

    def __init__(self, row: dict):
        self.names, self.words = row["names"], _unpack_words(row["sizes"], row["words"])
        self.word, self.lang = _unzip(row["tokens"], "<u4").astype(np.int64), _unzip(row["langs"], "<u4").astype(np.int64)
        self.after = _unzip(row["after"], "u1")

    def hashes(self, upto: int) -> list[np.ndarray]:
        def each(words: pa.Array) -> np.ndarray:
            data, offsets = tk.text_bytes(words.cast(pa.large_string()))
            full = np.flatnonzero(np.diff(offsets))  # a language may be an empty text
            out = np.zeros(len(offsets) - 1, dtype=tk.U64)
            out[full] = tk.word_hashes(data, offsets[:-1][full], offsets[1:][full])
            return out
        word, out = each(self.words)[self.word], []
        mixed = each(pa.array(self.names, pa.string()))[self.lang]
        for m in range(upto):
            mixed = tk.mix64(mixed[:len(word) - m] ^ (word[m:] + tk.U64(m + 1)))
            out.append(mixed)
        return out


# --------------------------------------------------------------------------
# Which words and word pairs are frequent at all
# --------------------------------------------------------------------------

_LOW = 40  # bits of a hash that are sent; its range implies more
_BYTES = _LOW // 8
_MASK = tk.U64((1 << _LOW) - 1)


def _ranges(hashes: np.ndarray, ranges: int) -> np.ndarray:
    return ((hashes >> tk.U64(32)) * tk.U64(ranges) >> tk.U64(32)).astype(np.int64)


def _pack_low(values: np.ndarray) -> bytes:
    """Sorted 40-bit values, byte by byte."""
    return _zip(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_BYTES].T)


def _unpack_low(data: bytes) -> np.ndarray:
    planes = _unzip(data, "u1").reshape(_BYTES, -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, :_BYTES] = planes.T
    return out.view("<u8").ravel()


def _keys(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """What of a hash the shards and ranges exchange: range and low bits."""
    return (_ranges(hashes, ranges).astype(tk.U64) << tk.U64(_LOW)) | (hashes & _MASK)


def _ask(ranges: int, least: int):
    """Per shard and range: every distinct word and word pair once, with its
    count there (at most ``least``, which is all that matters)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                s = _Shard(row)
                one, two = s.hashes(2)
                pairs = two[s.after[:len(two)] >= 1] if len(two) else two
                keys, counts = np.unique(np.concatenate((_keys(one, ranges), _keys(pairs, ranges))), return_counts=True)
                counts = np.minimum(counts, least).astype("<u4")
                where = (keys >> tk.U64(_LOW)).astype(np.int64)
                cut = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1]))) if len(keys) else []
                ends = [*cut[1:], len(keys)]
                yield pa.RecordBatch.from_pydict({
                    "range": pa.array(where[cut] if len(keys) else [], pa.int64()),
                    "shard": pa.array([row["shard"]] * len(cut), pa.int64()),
                    "keys": pa.array([_pack_low(keys[i:j] & _MASK) for i, j in zip(cut, ends)], pa.binary()),
                    "counts": pa.array([_zip(counts[i:j]) for i, j in zip(cut, ends)], pa.binary())})
    return run


def _answer(least: int):
    """Of one range: for each shard those of its words and pairs whose counts
    add up to ``least`` over all shards."""
    def run(key: tuple[pa.Scalar, ...], asked: pa.Table) -> pa.Table:
        keys = [_unpack_low(k) for k in asked.column("keys").to_pylist()]
        counts = np.concatenate([_unzip(c, "<u4") for c in asked.column("counts").to_pylist()]).astype(np.int64)
        _, place = np.unique(np.concatenate(keys), return_inverse=True)
        often = (np.bincount(place, counts) >= least)[place]
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        found = [k[o] for k, o in zip(keys, np.split(often, cuts))]
        some = [i for i, f in enumerate(found) if len(f)]
        return pa.table({"shard": asked.column("shard").take(pa.array(some, pa.int64())),
                         "range": pa.array([key[0].as_py()] * len(some), pa.int64()),
                         "keys": pa.array([_pack_low(found[i]) for i in some], pa.binary())})
    return run


# --------------------------------------------------------------------------
# Transducers of a shard
# --------------------------------------------------------------------------

def shard_parts(shard: _Shard, frequent: np.ndarray, longest: int, asked_ranges: int, ranges: int):
    """(range, alphabet, transducers) of one shard. A sequence ends where its
    next word pair is not among the ``frequent`` keys: no longer one can be
    frequent. Labels are 1 and above: places in the alphabet, a binary array
    of words and of languages (these after a tab, which no word has). Three
    transducers: of language and word, language and two words, and language
    and 3 to ``longest`` words."""
    hashes = shard.hashes(min(3, longest))
    known = [_member(_keys(h, asked_ranges), frequent) for h in hashes[:2]]
    single = known[0]
    # How many words follow within frequent pairs.
    joined = np.zeros(len(single), dtype=bool)
    if len(known) > 1:
        joined[:len(known[1])] = known[1]
    joined &= shard.after >= 1
    follow = np.zeros(len(single), dtype=np.int64)
    alive = np.ones(len(single), dtype=bool)
    padded = np.concatenate((joined, np.zeros(longest, dtype=bool)))
    for i in range(longest - 1):
        alive &= padded[i:i + len(single)]
        follow += alive
    names = pa.array([b"\t" + n.encode() for n in shard.names], pa.large_binary())
    alphabet = pa.concat_arrays([shard.words, names])
    word, lang = (shard.word + 1).astype(np.uint32), (shard.lang + len(shard.words) + 1).astype(np.uint32)
    parts: dict[int, list] = {}
    for prefix, mixed in enumerate(hashes, 1):
        at = np.flatnonzero((follow >= prefix - 1) & single) if prefix > 1 else np.flatnonzero(single)
        if not len(at):
            continue
        columns = [lang[at], *(word[at + i] for i in range(prefix))]
        if prefix == 3:
            for i in range(3, longest):
                more = np.zeros(len(at), dtype=np.uint32)
                long = follow[at] >= i
                more[long] = word[at[long] + i]
                columns.append(more)
        where = _ranges(mixed[at], ranges)
        order = np.argsort(where, kind="stable")
        ranked = where[order]
        cut = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        for i, j in zip(cut.tolist(), [*cut[1:].tolist(), len(ranked)]):
            some = order[i:j]
            parts.setdefault(int(ranked[i]), []).append((prefix, Counts.build([c[some] for c in columns])))
    for r, found in parts.items():
        yield r, alphabet, found


def _member(values: np.ndarray, ranked: np.ndarray) -> np.ndarray:
    if not len(ranked):
        return np.zeros(len(values), dtype=bool)
    return ranked[np.minimum(np.searchsorted(ranked, values), len(ranked) - 1)] == values


def _shared_alphabet(alphabet: pa.Array, found: list) -> tuple[pa.Array, list]:
    """The labels these transducers use, renumbered in their old order."""
    used = np.zeros(len(alphabet) + 1, dtype=bool)
    for _, counts in found:
        for labels in counts.labels:
            used[labels] = True
    used[0] = False
    number = np.cumsum(used)
    number[0] = 0
    for _, counts in found:
        counts.labels = [number[labels] * (labels > 0) for labels in counts.labels]
    return alphabet.take(pa.array(np.flatnonzero(used) - 1)), found


_SENT = "range long, sizes binary, words binary, prefixes array<int>, bodies array<binary>"


def _send(longest: int, asked_ranges: int, ranges: int):
    def run(key: tuple[pa.Scalar, ...], shards: pa.Table, answers: pa.Table) -> pa.Table:
        out: dict[str, list] = {"range": [], "sizes": [], "words": [], "prefixes": [], "bodies": []}
        frequent = [(np.full(0, 0, dtype=tk.U64))]
        for r, k in zip(answers.column("range").to_pylist(), answers.column("keys").to_pylist()):
            frequent.append(_unpack_low(k) | tk.U64(r << _LOW))
        ranked = np.sort(np.concatenate(frequent))
        for row in shards.to_pylist():
            for r, alphabet, found in shard_parts(_Shard(row), ranked, longest, asked_ranges, ranges):
                words, found = _shared_alphabet(alphabet, found)
                sizes, body = _pack_words(words)
                for c, v in zip(out, (r, sizes, body, [p for p, _ in found], [c.pack() for _, c in found])):
                    out[c].append(v)
        return pa.table([pa.array(v, t) for v, t in zip(out.values(), (
            pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.binary())))], names=list(out))
    return run


# --------------------------------------------------------------------------
# Ranges
# --------------------------------------------------------------------------

def _frequent(least: int):
    """Of one range: sequences with a count of ``least`` or more."""
    def run(key: tuple[pa.Scalar, ...], sent: pa.Table) -> pa.Table:
        alphabets = [_unpack_words(*x) for x in zip(*(sent.column(c).to_pylist() for c in ("sizes", "words")))]
        joint = pa.chunked_array(alphabets, pa.large_binary()).combine_chunks().dictionary_encode()
        symbols = joint.dictionary.to_pylist()
        number = joint.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
        cuts = np.concatenate(([0], np.cumsum([len(a) for a in alphabets])))
        maps = [np.concatenate(([0], number[a:b])) for a, b in zip(cuts, cuts[1:])]
        prefixes, bodies = sent.column("prefixes").to_pylist(), sent.column("bodies").to_pylist()
        out: list[tuple] = []

        def keep(columns, weights, m):
            for *labels, f in zip(*(c.tolist() for c in columns), weights.tolist()):
                words = [symbols[i - 1] for i in labels]
                out.append((words[0][1:].decode(), m, b" ".join(words[1:]).decode(), f))

        for prefix in (1, 2, 3):
            mine = [(i, Counts.unpack(body)) for i in range(len(bodies)) for p, body in zip(prefixes[i], bodies[i]) if p == prefix]
            if not mine:
                continue
            joined = Counts.union([c for _, c in mine], [maps[i] for i, _ in mine], least)
            for depth in range(prefix + 1, len(joined.labels) + 1):
                keep(*joined.states(depth, least), depth - 1)
        return pa.table({n: pa.array(c, t) for n, c, t in zip(
            ("lang", "m", "phrase", "f"), zip(*out) if out else ((),) * 4, (pa.string(), pa.int32(), pa.string(), pa.int64()))})
    return run


def phrase_counts(docs: DataFrame, *, lang_col: str = "lang", text_col: str = "text", longest: int = 5,
                  least: int = 100, range_bytes: int = 32 << 20, shard_bytes: int = 6 << 20) -> tuple[DataFrame, DataFrame]:
    """(lang, m, phrase, f): every sequence of up to ``longest`` words within
    a piece that occurs ``least`` times or more in its language, with its
    exact count; and (lang, n): the words of each language. Both over tables
    in the shared folder.

    Shards first send each distinct word and word pair once, as five bytes of
    a hash, and learn which add up to ``least``; hashes that meet only let a
    few more through, whose exact counts drop them in the end.
    """
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    ranges = max(1, math.ceil(total / range_bytes))
    shards = written(rows.mapInArrow(_encode(longest, shard_bytes), _SHARD), "phrase-shards")
    totals = shards.select(F.explode(F.arrays_zip("names", "n")).alias("x")).groupBy(F.col("x.names").alias("lang")).agg(
        F.sum("x.n").alias("n"))
    answers = (shards.mapInArrow(_ask(ranges, least), "range long, shard long, keys binary, counts binary")
               .groupBy("range").applyInArrow(_answer(least), "shard long, range long, keys binary"))
    sent = shards.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(_send(longest, ranges, ranges), _SENT)
    return written(sent.groupBy("range").applyInArrow(_frequent(least), _FOUND), "phrases"), totals


# --------------------------------------------------------------------------
# Parts and scores
# --------------------------------------------------------------------------

def _looked_up(longest: int):
    """Of one group of phrases: the counted ones (f) form a transducer, the
    asked ones (no f) are composed with it."""
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.select(["lang", "phrase", "f"]).combine_chunks()
        split = pc.split_pattern(rows.column("phrase").combine_chunks(), " ")
        words = split.flatten().dictionary_encode()
        labels = words.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
        lang = rows.column("lang").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False) + 1
        begins = np.asarray(split.offsets)[:-1] - split.offsets[0].as_py()
        sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False)
        columns = [lang.astype(np.int64)]
        for i in range(longest):
            c = np.zeros(rows.num_rows, dtype=np.int64)
            has = sizes > i
            c[has] = labels[begins[has] + i]
            columns.append(c)
        f = rows.column("f").combine_chunks()
        counted, asked = np.flatnonzero(f.is_valid()), np.flatnonzero(f.is_null())
        known = Counts.build([c[counted] for c in columns], f.take(pa.array(counted)).to_numpy(zero_copy_only=False))
        return pa.table({"lang": rows.column("lang").take(pa.array(asked)), "phrase": rows.column("phrase").take(pa.array(asked)),
                         "f": pa.array(known.compose([c[asked] for c in columns]), pa.int64())})
    return run


def _slice(words: Column, begin, size) -> Column:
    return F.array_join(F.slice(words, begin, size), " ")


def collocations(docs: DataFrame, *, lang_col: str = "lang", text_col: str = "text", longest: int = 5, least: int = 100,
                 share: int = 100, top: int | None = 2000, group_rows: int = 500_000, **counting) -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words in each language: lang,
    rank, phrase, a (its count), l, r (counts of its parts), n (words of the
    language) and score = floor(1000 * a * n / (l * r)) of the lowest-scoring
    cut, ties to the shortest first part.

    Texts are lower-cased (A-Z), split at punctuation and line ends into
    pieces and these at spaces and tabs into words. A phrase counts from
    ``least`` occurrences on, and goes if a longer such phrase that holds it
    has at least ``share`` per cent of its count. Ranked by score, count (both
    descending) and phrase.

    Defined cases: null and empty texts have no words; a null language is
    ``und``; repeated rows count as often as they stand there; a language
    without phrases has no rows; an empty table gives an empty result; other
    columns are not looked at. A very long text is a shard of its own, in
    memory bounded by its size. Within one shard words count as equal by a
    64-bit hash; across shards their bytes are compared.
    """
    counts, totals = phrase_counts(docs, lang_col=lang_col, text_col=text_col, longest=longest, least=least, **counting)
    words = F.split("phrase", " ")
    found = counts.where("m > 1").select("lang", "m", "phrase", F.col("f").alias("a"), words.alias("words"))

    # Counts of the parts: equal phrases meet in groups of bounded size.
    cut = found.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", _slice(F.col("words"), 1, F.col("k")).alias("left"),
        _slice(F.col("words"), F.col("k") + 1, F.lit(longest)).alias("right"))
    asked = cut.select("lang", F.explode(F.array("left", "right")).alias("phrase")).distinct()
    groups = max(1, math.ceil(counts.count() / group_rows))
    both = (counts.select("lang", "phrase", "f").unionByName(asked.withColumn("f", F.lit(None).cast("long")))
            .withColumn("g", F.pmod(F.xxhash64("lang", "phrase"), F.lit(groups))))
    parts = written(both.groupBy("g").applyInArrow(_looked_up(longest), "lang string, phrase string, f long"), "parts")

    wide = lambda c: F.col(c).cast("decimal(20,0)")
    scored = (cut.join(parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
              .join(parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
              .join(totals, "lang")
              .withColumns({"_an": (wide("a") * wide("n")).cast("decimal(34,0)"), "_lr": (wide("l") * wide("r")).cast("decimal(38,0)")})
              .withColumn("score", F.expr("(_an * 1000BD) div _lr")))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))

    # The largest count of a longer phrase around each phrase.
    m = F.size("words")
    inside = found.where(m > 2).select(
        "lang", "a", "words", F.explode(F.sequence(F.lit(2), m - 1)).alias("q")).select(
        "lang", "a", "words", "q", F.explode(F.sequence(F.lit(1), m - F.col("q") + 1)).alias("at")).select(
        "lang", "a", _slice(F.col("words"), F.col("at"), F.col("q")).alias("phrase"))
    longer = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = (best.join(longer, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * share))
            .select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if top:  # the first of each slice of a language, then the first of these
        slices = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
        kept = kept.withColumn("_s", F.row_number().over(slices)).where(F.col("_s") <= top).drop("_s")
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return (ranked.where(F.col("rank") <= top) if top else ranked).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
