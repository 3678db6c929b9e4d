"""Token ids of documents as Re-Pair compressed shards in files.

Documents are ordered by id in Spark, tokenised in tasks, and every shard of
consecutive documents becomes one binary value in a Parquet table (Spark's
writer commits it, so a lost executor leaves no half shard). A shard holds its
documents' ids and lengths, a grammar over its token ids, and the expansion
length of every rule, so any document decodes without the rest of the shard.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm import repair
from shelfwise.llm import tokens as tk

FILE_SCHEMA = "part int, shard int, n_docs long, n_ids long, body binary"
_HEAD = struct.Struct("<8sIIQQQ")  # magic, base, bytes a symbol, documents, rules, symbols
_MAGIC = b"REPAIR01"

#: Words, and pieces of words, whose ids a worker keeps between batches (some
#: 40 bytes each).
_KEPT_WORDS = 1_500_000
_KEPT_PIECES = 750_000
_ENCODED_AT_ONCE = 4096
#: Stands between words that are encoded as one text.
_MARK = "\x01"


# --------------------------------------------------------------------------
# Shard format
# --------------------------------------------------------------------------

def pack_shard(doc_ids: np.ndarray, known: np.ndarray, lengths: np.ndarray, ids: np.ndarray, base: int,
               **grammar) -> bytes:
    """One shard: documents (``known`` false: null id), the number of token
    ids of each, and the ids of all in one run."""
    rules, symbols = repair.compress(ids, base, **grammar)
    wide = "<u2" if base + len(rules) <= 1 << 16 else "<u4"
    return b"".join([
        _HEAD.pack(_MAGIC, base, int(wide[-1]), len(doc_ids), len(rules), len(symbols)),
        doc_ids.astype("<i8").tobytes(), known.astype(np.uint8).tobytes(), lengths.astype("<u8").tobytes(),
        repair.expansion_lengths(rules, base).astype("<u8").tobytes(),
        rules.astype(wide).tobytes(), symbols.astype(wide).tobytes()])


class Shard:
    """A packed shard's parts, and the ids of all or of some documents."""

    def __init__(self, body: bytes):
        magic, self.base, size, docs, rules, symbols = _HEAD.unpack_from(body)
        if magic != _MAGIC:
            raise ValueError("not a token shard")
        at, wide = _HEAD.size, f"<u{size}"

        def take(kind, n):
            nonlocal at
            out = np.frombuffer(body, dtype=kind, count=n, offset=at)
            at += out.nbytes
            return out

        self.doc_ids, self.known, self.lengths = take("<i8", docs), take("u1", docs).astype(bool), take("<u8", docs)
        self.rule_lengths = take("<u8", rules).astype(np.int64)
        self.rules = take(wide, 2 * rules).reshape(-1, 2).astype(np.uint32)
        self.symbols = take(wide, symbols)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths.astype(np.int64))))

    def ids(self) -> np.ndarray:
        return repair.expand(self.symbols, self.rules, self.base, self.rule_lengths)

    def document(self, i: int) -> np.ndarray:
        """The ids of document ``i`` alone."""
        return repair.expand_range(self.symbols, self.rules, self.rule_lengths, self.base,
                                   int(self.starts[i]), int(self.starts[i + 1]))


# --------------------------------------------------------------------------
# Tokenising whole batches
# --------------------------------------------------------------------------

class _Words:
    """Ids of words, by the sorted hashes of the words."""

    def __init__(self, hashes=(), sizes=(), flat=()):
        hashes, sizes = np.asarray(hashes, dtype=np.uint64), np.asarray(sizes, dtype=np.int64)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.flat = repair.gather(np.asarray(flat, dtype=np.uint32), (np.cumsum(sizes) - sizes)[order], sizes[order])
        self.begins = np.concatenate(([0], np.cumsum(sizes[order])))  # and the end of the last

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Where each of the hashes stands, or -1."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def joined(self, other: _Words) -> _Words:
        return _Words(*(np.concatenate(pair) for pair in (
            (self.hashes, other.hashes), (np.diff(self.begins), np.diff(other.begins)), (self.flat, other.flat))))


class _Memory:
    """Ids of the words met so far, a bounded number of them."""

    def __init__(self):
        self.known = [_Words()]

    def _learn(self, new: _Words) -> None:
        """Add the ids of new words. They are kept apart from the many older
        ones until a quarter as many have come."""
        if len(self.known) == 2:
            new = self.known.pop().joined(new)
        if 4 * len(new.hashes) > len(self.known[0].hashes):
            self.known = [self.known[0].joined(new)]
        else:
            self.known.append(new)

    def ids(self, hashes: np.ndarray, limit: int, encode) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words with these hashes in one run, and how many
        each has. ``encode`` gives the same for the words at some places; it
        gets one place of each word that is not known."""
        found = pa.array(hashes).dictionary_encode()
        distinct, inverse = found.dictionary.to_numpy(), found.indices.to_numpy()
        # Words are numbered as they first occur: there the highest number rises.
        first = np.flatnonzero(np.diff(np.maximum.accumulate(inverse), prepend=-1))
        order = np.argsort(distinct)
        distinct, first = distinct[order], first[order]
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        inverse = rank[inverse]
        known = [(k, k.places(distinct)) for k in self.known]
        new = np.flatnonzero(np.all([place < 0 for _, place in known], axis=0))
        if len(new) + sum(len(k.hashes) for k in self.known) > limit:
            self.known, known = [_Words()], []
            new = np.arange(len(distinct))
        if len(new):
            flat, sizes = encode(first[new])
            found = _Words(distinct[new], sizes, flat)
            place = np.full(len(distinct), -1)
            place[new] = np.arange(len(new))  # in the order of hashes, as in there
            known.append((found, place))
            self._learn(found)
        # The ids of the distinct words, then those of all words.
        sizes, flat = np.zeros(len(distinct), dtype=np.int64), []
        begins, at = np.zeros(len(distinct), dtype=np.int64), 0
        for k, place in known:
            here = np.flatnonzero(place >= 0)
            place = place[here]
            sizes[here] = k.begins[place + 1] - k.begins[place]
            begins[here] = at + np.cumsum(sizes[here]) - sizes[here]
            flat.append(repair.gather(k.flat, k.begins[place], sizes[here]))
            at += len(flat[-1])
        sizes, begins = sizes[inverse], begins[inverse]
        flat = np.concatenate(flat) if flat else np.zeros(0, dtype=np.uint32)
        return repair.gather(flat, begins, sizes), sizes


class WordEncoder:
    """Encodes texts word by word. For a tokenizer that drops white space and
    joins nothing across it, the ids of a text are those of its words between
    ASCII white space in turn; each distinct word is encoded once, and a
    bounded number stays known for the next batches."""

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core only
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self.mark = self.tokenizer.encode(_MARK, add_special_tokens=False).ids
        self.pieces = _Pieces(self.tokenizer) if _cuts_as_known(self.tokenizer) else None
        self.words, self.parts = _Memory(), _Memory()

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words in one run, and how many each has."""
        return self._encode_lines("\n".join(words), len(words))

    def _encode_lines(self, text: str, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the ``n`` words between line ends in one run, and how
        many each has. Words of common letters and signs are cut into pieces
        as the tokenizer's own pattern does, and its model encodes each
        distinct piece once; the others go through the whole tokenizer."""
        if self.pieces is None:
            return self._encode_whole(text.split("\n"))
        cut, rest = self.pieces.cut(text, n)
        data = np.frombuffer(cut, dtype=np.uint8)
        starts, ends, _ = tk.words(data, np.array([0, len(data)]), _IN_PIECE)
        ids, sizes = self.parts.ids(tk.word_hashes(data, starts, ends), _KEPT_PIECES,
                                    lambda at: self.pieces.encode(data, starts[at], ends[at]))
        # Plain words stand between line ends, each piece after a space.
        lines = np.concatenate(([0], np.cumsum(data == 0x0A)))[starts]
        total = np.bincount(lines, weights=sizes, minlength=n).astype(np.int64)
        if not len(rest):
            return ids, total
        begins = np.cumsum(total) - total
        words, more, counts = text.split("\n"), [ids], []
        for i in range(0, len(rest), _ENCODED_AT_ONCE):
            flat, each = self._encode_whole([words[j] for j in rest[i:i + _ENCODED_AT_ONCE].tolist()])
            more.append(flat)
            counts.append(each)
        total[rest] = np.concatenate(counts)
        begins[rest] = len(ids) + np.cumsum(total[rest]) - total[rest]
        return repair.gather(np.concatenate(more), begins, total), total

    def _encode_whole(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words in one run, and how many each has. The words
        are encoded as one text with a mark between them, which the ids show
        as one id; if a word holds the mark they are encoded one by one."""
        if len(self.mark) == 1:
            ids = np.array(self.tokenizer.encode(f" {_MARK} ".join(words), add_special_tokens=False).ids, dtype=np.uint32)
            marks = np.flatnonzero(ids == self.mark[0])
            if len(marks) == len(words) - 1 and not any(_MARK in w for w in words):
                return np.delete(ids, marks), np.diff(marks, prepend=-1, append=len(ids)) - 1
        found = [self.tokenizer.encode(w, add_special_tokens=False).ids for w in words]
        return np.array([i for f in found for i in f], dtype=np.uint32), np.array([len(f) for f in found], dtype=np.int64)

    def __call__(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, ``end`` after each text, and the number of ids a text."""
        data, offsets = tk.text_bytes(texts)
        starts, ends, row = tk.words(data, offsets, tk.NON_SPACE)

        def encode(at):
            found = [self._encode_lines(_joined(data, starts[at[a:b]], ends[at[a:b]]).decode("utf-8"), b - a)
                     for a, b in tk.pieces(np.concatenate(([0], np.cumsum(ends[at] - starts[at]))), tk.BLOCK)]
            return tuple(np.concatenate(x) for x in zip(*found))

        ids, sizes = self.words.ids(tk.word_hashes(data, starts, ends), _KEPT_WORDS, encode)
        # The end id goes in after the last id of each text.
        last = np.searchsorted(row, np.arange(len(offsets) - 1), side="right")
        total = np.concatenate(([0], np.cumsum(sizes)))[last]
        return np.insert(ids, total, np.uint32(end)), np.diff(total, prepend=0) + 1


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The words at these places, with line ends between them."""
    sizes = ends - starts + 1
    out = np.full(int(sizes.sum()), 0x0A, dtype=np.uint8)
    inside = np.ones(len(out), dtype=bool)
    inside[np.cumsum(sizes) - 1] = False
    out[inside] = repair.gather(data, starts, sizes - 1)
    return out[:-1].tobytes()


_IN_PIECE = ~tk.byte_class([0x0A, 0x20])
#: The pattern whose matches in a lower-cased word are its pieces.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _cuts_as_known(tokenizer) -> bool:
    """Whether the tokenizer normalises and cuts in the one way known here."""
    import json
    parts = json.loads(tokenizer.to_str())
    steps = [(n.get("type"), n.get("pattern"), n.get("content")) for n in (parts["normalizer"] or {}).get("normalizers", [])]
    cuts = (parts["pre_tokenizer"] or {}).get("pretokenizers", [])
    if steps != [("NFC", None, None), ("Replace", {"Regex": "\\s+"}, " "), ("Lowercase", None, None)] or len(cuts) != 2:
        return False
    split, level = cuts
    return (split.get("type"), split.get("pattern"), split.get("behavior"), split.get("invert")) == (
        "Split", {"Regex": _PATTERN}, "Removed", True) and (
        level.get("type"), level.get("add_prefix_space"), level.get("use_regex")) == ("ByteLevel", False, False)


class _Pieces:
    """Cuts plain words into the pieces that the tokenizer's model sees, and
    has the model encode them. Plain words consist of characters whose classes
    and lower case are the same in every version of Unicode, composed already,
    and have no special token's mark."""

    def __init__(self, tokenizer):
        import regex
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, WhitespaceSplit
        self.model = tokenizer.model
        self.tokenizer = Tokenizer(tokenizer.model)
        self.tokenizer.pre_tokenizer = WhitespaceSplit()
        # By character: lower case, and 1 for letters, 2 for numbers, 3 for
        # signs, 0 for what is not plain.
        self.lower, self.kind = np.arange(0x251, dtype=np.uint32), np.zeros(0x251, dtype=np.uint8)
        for c in (*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x250)):
            low = chr(c).lower()
            if len(low) == 1:
                self.lower[c] = ord(low)
                self.kind[c] = 1 if regex.match(r"\p{L}", low) else 2 if regex.match(r"\p{N}", low) else 3
        # The character that the byte-level step writes for a byte; a space
        # for the line ends between pieces.
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.byte_chars = np.zeros(256, dtype="<u4")
        for c in (*range(1, 0x800), *range(0x800, 0xD800, 0x800)):
            self.byte_chars[list(chr(c).encode())] = [ord(x) for x in level.pre_tokenize_str(chr(c))[0][0]]
        self.byte_chars[0x0A] = 0x20
        # Whether an id ends a piece.
        suffix = self.model.end_of_word_suffix
        self.ends = np.array([bool(suffix) and (tokenizer.id_to_token(i) or "").endswith(suffix)
                              for i in range(tokenizer.get_vocab_size())], dtype=bool)

    def cut(self, text: str, n: int) -> tuple[bytes, np.ndarray]:
        """Of the ``n`` words between line ends: lower-cased UTF-8 with a
        space before each piece, other than plain words left empty; and the
        places of those others."""
        c = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        line = c == 0x0A
        at = np.minimum(c, 0x250)
        kind = self.kind[at]
        bad = (kind == 0) & ~line
        bad[:-1] |= (c[:-1] == 0x3C) & (c[1:] == 0x7C)
        low = self.lower[at]
        low[line] = 0x0A
        rest = np.zeros(0, dtype=np.int64)
        if bad.any():
            word = np.cumsum(line)
            rest = np.unique(word[bad])
            other = np.zeros(n, dtype=bool)
            other[rest] = True
            keep = line | ~other[word]
            low, kind = low[keep], kind[keep]
        # Runs of letters, runs of signs, single numbers.
        before = np.concatenate((np.zeros(1, dtype=np.uint8), kind[:-1]))
        start = (kind != 0) & ((kind != before) | (kind == 2))
        # 's and the like: an apostrophe that begins a piece, and what follows.
        quote = np.flatnonzero(start & (low == 0x27))
        if len(quote):
            after = np.concatenate((low, np.zeros(3, dtype=low.dtype)))
            a, b = after[quote + 1], after[quote + 2]
            one = np.isin(a, _codes("stmd"))
            two = (np.isin(a, _codes("rv")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
            start[quote[one | two] + 1] = False
            then = np.concatenate((quote[one] + 2, quote[two] + 3))
            then = then[then < len(kind)]
            start[then[kind[then] != 0]] = True
        out = np.full(len(low) + int(start.sum()), 0x20, dtype="<u4")
        out[np.arange(len(low)) + np.cumsum(start)] = low
        return out.tobytes().decode("utf-32-le").encode("utf-8"), rest

    def encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces at these places in one run, and how many each
        has. The model writes the end of a piece into its last id."""
        found = []
        for i in range(0, len(starts), _ENCODED_AT_ONCE):
            n = len(starts[i:i + _ENCODED_AT_ONCE])
            body = np.frombuffer(_joined(data, starts[i:i + n], ends[i:i + n]), dtype=np.uint8)
            text = self.byte_chars[body].tobytes().decode("utf-32-le")
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)
            last = np.flatnonzero(self.ends[ids])
            if len(last) == n and last[-1] == len(ids) - 1:
                found.append((ids, np.diff(last, prepend=-1)))
            else:
                each = [[t.id for t in self.model.tokenize(p)] for p in text.split(" ")]
                found.append((np.array([i for e in each for i in e], dtype=np.uint32), np.array([len(e) for e in each])))
        return np.concatenate([f for f, _ in found]), np.concatenate([k for _, k in found])


def _codes(chars: str) -> list[int]:
    return [ord(c) for c in chars]


_ENCODERS: dict[str, WordEncoder] = {}


def _pack(path: str, end: int, shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        if path not in _ENCODERS:
            _ENCODERS[path] = WordEncoder(path)
        encoder, part, shard = _ENCODERS[path], TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []
        size = 0

        def packed():
            docs = pa.Table.from_batches(held)
            ids, lengths = encoder(docs.column("text"), end)
            key = docs.column("id")
            body = pack_shard(key.fill_null(0).to_numpy(), key.is_valid().to_numpy(), lengths, ids,
                              max(encoder.size, end + 1))
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()),
                "n_docs": pa.array([docs.num_rows], pa.int64()), "n_ids": pa.array([len(ids)], pa.int64()),
                "body": pa.array([body], pa.binary())})

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


def write_token_files(docs: DataFrame, path: str, tokenizer: str, *, end: int = 1, id_col: str = "doc_id",
                      text_col: str = "text", part_bytes: int = 32 << 20, shard_bytes: int = 4 << 20) -> None:
    """Write the token ids of every whole text, ``end`` after each, as shards
    in ascending id order to a Parquet table of FILE_SCHEMA at ``path``.

    ``tokenizer`` is a file of the tokenizers library whose ids never depend
    on text across white space (see :class:`WordEncoder`).

    Defined cases: a null text is empty, an empty text has the end id only; a
    null id sorts first; rows with one id are ordered by hash and then by
    text, and a range of them may be split over tasks; an empty table gives a
    table without rows; other columns are not looked at. A very long text
    makes a shard of its own, in memory bounded by its size. Words count as
    equal by a 64-bit hash within one worker.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    parts = max(1, math.ceil(total / part_bytes))
    order = ["id", F.xxhash64("text"), "text"]
    ordered = rows.repartitionByRange(parts, *order[:2]).sortWithinPartitions(*order)
    ordered.mapInArrow(_pack(tokenizer, end, shard_bytes), FILE_SCHEMA).write.parquet(path)


# --------------------------------------------------------------------------
# Reading
# --------------------------------------------------------------------------

_DOC_SCHEMA = "id long, part int, shard int, place int, start long, n_tokens long, ids_crc32 long"


def _unpack(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, shard, start, body in zip(*(batch.column(i).to_pylist() for i in range(4))):
                s = Shard(body)
                ids = s.ids().astype("<u4")
                n = len(s.lengths)
                raw, cut = memoryview(ids.tobytes()), (4 * s.starts).tolist()
                crc = np.fromiter((zlib.crc32(raw[a:b]) for a, b in zip(cut, cut[1:])), dtype=np.int64, count=n)
                out = {
                    "id": pa.array(s.doc_ids, pa.int64(), mask=~s.known), "part": pa.array(np.full(n, part), pa.int32()),
                    "shard": pa.array(np.full(n, shard), pa.int32()), "place": pa.array(np.arange(n), pa.int32()),
                    "start": pa.array(start + s.starts[:-1], pa.int64()),
                    "n_tokens": pa.array(s.lengths.astype(np.int64), pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}
                if with_ids:
                    out["ids"] = pa.LargeListArray.from_arrays(s.starts, pa.array(ids.astype(np.int64))).cast(
                        pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(out)
    return run


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document of the files: id, its place (part, shard, place),
    ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``
    (of the ids as little-endian unsigned 32-bit integers) and, on request,
    the ``ids``. Starts come from the shards' counts: sums per part, a running
    total over the parts, and one over the shards of each part."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    counts = files.select("part", "shard", "n_ids")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task of the write, however large the corpus.
    parts = counts.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = (counts.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
              .join(parts, "part").select("part", "shard", (F.col("part_start") + F.col("inside")).alias("start")))
    placed = files.join(starts, ["part", "shard"]).select("part", "shard", "start", "body")
    return placed.mapInArrow(_unpack(with_ids), _DOC_SCHEMA + (", ids array<long>" if with_ids else ""))
