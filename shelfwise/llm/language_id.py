"""Language identification of mixed-language text.

Words are runs of letters (with their marks). A word's script, read from
code point ranges, narrows the candidate languages; its score for each
candidate is the log-likelihood of its letter trigrams. Viterbi over the
words, with a penalty for each switch of language, labels spans.

The trigram counts cover every labelled document: tasks and then Spark add
them up by the exact trigram, and the table of the model has at least twice
as many buckets as there are distinct trigrams. Its size follows the learned
alphabets (tens of thousands of trigrams for Latin script, the observed ones
for large alphabets), not the number of documents.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm import tokens as tk
from shelfwise.llm.tables import carried

_BLOCK = 1 << 18
_BATCH_BYTES = 2 << 20
UNKNOWN = "und"

# First code point of each range and its script.
SCRIPT_RANGES = [
    (0x0000, "Latin"), (0x0250, "Other"), (0x0370, "Greek"), (0x0400, "Cyrillic"),
    (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0700, "Other"),
    (0x0750, "Arabic"), (0x0780, "Other"), (0x08A0, "Arabic"), (0x0900, "Devanagari"),
    (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Oriya"),
    (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"),
    (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"),
    (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"),
    (0x1380, "Other"), (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, "Other"),
    (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"), (0x2C60, "Latin"),
    (0x2C80, "Other"), (0x3040, "Kana"), (0x3100, "Other"), (0x3130, "Hangul"),
    (0x3190, "Other"), (0x31F0, "Kana"), (0x3200, "Other"), (0x3400, "Han"),
    (0xA000, "Other"), (0xA640, "Cyrillic"), (0xA6A0, "Other"), (0xA720, "Latin"),
    (0xA800, "Other"), (0xAC00, "Hangul"), (0xD7B0, "Other"), (0xF900, "Han"),
    (0xFB00, "Latin"), (0xFB13, "Other"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"),
    (0xFE00, "Other"), (0xFE70, "Arabic"), (0xFF00, "Latin"), (0xFF66, "Kana"),
    (0xFFA0, "Hangul"), (0xFFE0, "Other"), (0x20000, "Han"), (0x32000, "Other"),
]
SCRIPTS = sorted({s for _, s in SCRIPT_RANGES})

_TABLES: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """1 for letters, 2 for marks, 0 else, by code point."""
    if "letters" not in _TABLES:
        _TABLES["letters"] = np.array(
            [{"L": 1, "M": 2}.get(unicodedata.category(chr(i))[0], 0) for i in range(sys.maxunicode + 1)],
            dtype=np.uint8)
    return _TABLES["letters"]


def _scripts(code: np.ndarray) -> np.ndarray:
    starts = np.array([s for s, _ in SCRIPT_RANGES], dtype=np.uint32)
    names = np.array([SCRIPTS.index(n) for _, n in SCRIPT_RANGES], dtype=np.int64)
    return names[np.searchsorted(starts, code, side="right") - 1]


class _Text:
    """Words and trigram features of some rows, each row ended by a NUL."""

    def __init__(self, texts: list[str | None]):
        low = [(t or "").lower() for t in texts]
        code = np.frombuffer(("\0".join(low) + "\0").encode("utf-32-le", "surrogatepass"), dtype="<u4")
        kind = _letters()[code]
        inside = kind > 0
        before = np.empty_like(inside)
        before[0], before[1:] = False, inside[:-1]
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(before & ~inside)  # the boundary after the word
        # A run of marks alone is no word.
        letters = np.add.reduceat(kind == 1, np.stack([self.starts, self.ends], axis=1).ravel(), dtype=np.int64)[::2] \
            if len(self.starts) else np.zeros(0, dtype=np.int64)
        real = letters > 0
        self.starts, self.ends, self.letters = self.starts[real], self.ends[real], letters[real]
        row_end = np.cumsum(np.fromiter((len(t) + 1 for t in low), dtype=np.int64, count=len(low)))
        self.row = np.searchsorted(row_end, self.starts, side="right")
        self.first = np.searchsorted(self.row, np.arange(len(texts) + 1))
        self.script = _scripts(code[self.starts])
        self._code, self._inside = code, inside

    def blocks(self) -> Iterator[tuple[int, int, np.ndarray, int]]:
        """(first word, end word, features from the first word's start on, that start)."""
        i, n = 0, len(self.starts)
        while i < n:
            base = int(self.starts[i])
            j = max(i + 1, int(np.searchsorted(self.ends, base + _BLOCK, side="right")))
            stop = int(self.ends[j - 1]) + 1
            yield i, j, self._features(base, stop), base
            i = j

    def _features(self, lo: int, hi: int) -> np.ndarray:
        """The trigram that ends at each position, as 3 x 21 bits; letters
        of another word count as the boundary 0."""
        c = np.where(self._inside[lo:hi], self._code[lo:hi], 0).astype(np.uint64)
        one = np.zeros_like(c)
        one[1:] = c[:-1]
        two = np.zeros_like(c)
        two[2:] = np.where(one[2:] > 0, c[:-2], 0)
        return (two << tk.U64(42)) ^ (one << tk.U64(21)) ^ c


def buckets(trigrams: np.ndarray, bits: int) -> np.ndarray:
    return (tk.mix64(trigrams) >> tk.U64(64 - bits)).astype(np.int64)


class _Sums:
    """Counts by key, merged whenever many have come together."""

    def __init__(self):
        self.keys, self.counts, self.held = [], [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.held += len(keys)
        if self.held > 1 << 20 and len(self.keys) > 1:
            self.merged()
            self.held = min(self.held, len(self.keys[0]) // 2)  # a large sum waits for as much again

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        keys, place = np.unique(np.concatenate(self.keys), return_inverse=True)
        counts = np.bincount(place, np.concatenate(self.counts), len(keys)).astype(np.int64)
        self.keys, self.counts = [keys], [counts]
        return keys, counts


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial sums of one task: (lang, kind, at, n) with kind 0 for
    trigrams and 1 for words by script."""
    grams: dict[str, _Sums] = {}
    scripts: dict[str, np.ndarray] = {}
    for batch in batches:
        _, offsets = tk.text_bytes(batch.column("text"))
        for lo, hi in tk.pieces(offsets, _BATCH_BYTES):
            part = batch.slice(lo, hi - lo)
            langs = part.column("lang").to_pylist()
            for lang in set(langs):
                text = _Text([t for t, k in zip(part.column("text").to_pylist(), langs) if k == lang])
                g = grams.setdefault(lang, _Sums())
                s = scripts.setdefault(lang, np.zeros(len(SCRIPTS), dtype=np.int64))
                s += np.bincount(text.script, minlength=len(SCRIPTS))
                for i, j, f, base in text.blocks():
                    used = np.zeros(len(f) + 1, dtype=np.int64)
                    used[text.starts[i:j] - base] += 1
                    used[text.ends[i:j] - base + 1] -= 1
                    g.add(*np.unique(f[np.cumsum(used[:-1]) > 0], return_counts=True))
    sums = [(0, lang, *g.merged()) for lang, g in grams.items() if g.keys]
    sums += [(1, lang, np.flatnonzero(t), t[np.flatnonzero(t)]) for lang, t in scripts.items()]
    for kind, lang, at, n in sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(np.full(len(at), kind), pa.int32()),
             pa.array(at.astype(np.int64), pa.int64()), pa.array(n, pa.int64())], ["lang", "kind", "at", "n"])


class LanguageModel:
    """langs; log-probabilities [trigram bucket, language], a power of two of
    buckets; which languages use a script [script, language]; log-priors."""

    def __init__(self, langs: list[str], logp: np.ndarray, allowed: np.ndarray, prior: np.ndarray, switch: float):
        self.langs, self.logp, self.allowed, self.prior, self.switch = langs, logp, allowed, prior, switch
        self.bits = len(logp).bit_length() - 1


def learn(labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang", smoothing: float = 0.5,
          script_share: float = 0.01, switch: float = 15.0) -> LanguageModel:
    """A model from every row with a language and a text. The counts are
    summed in Spark. A script belongs to the languages that write at least
    ``script_share`` of their words in it."""
    rows = (labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
            .where("lang is not null and text is not null"))
    sums = (rows.mapInArrow(_counts, "lang string, kind int, at long, n long")
            .groupBy("lang", "kind", "at").agg(F.sum("n").alias("n"))).toArrow().to_pandas()
    langs = sorted(sums["lang"].unique())
    index = {k: i for i, k in enumerate(langs)}
    grams, words = sums[sums["kind"] == 0], sums[sums["kind"] == 1]
    bits = max(10, (2 * grams["at"].nunique() - 1).bit_length())
    counts = np.zeros((1 << bits, len(langs)))
    scripts = np.zeros((len(SCRIPTS), len(langs)))
    for t, part, at in ((counts, grams, buckets(grams["at"].to_numpy().astype(tk.U64), bits)),
                        (scripts, words, words["at"].to_numpy())):
        np.add.at(t, (at, part["lang"].map(index).to_numpy(dtype=np.int64)), part["n"].to_numpy())
    used = max(1, int((counts.sum(axis=1) > 0).sum()))
    logp = np.log(counts + smoothing) - np.log(counts.sum(axis=0) + smoothing * used)
    total = scripts.sum(axis=0)
    allowed = scripts >= script_share * np.maximum(total, 1)
    prior = np.log((total + 1) / (total.sum() + len(langs))) if langs else total
    return LanguageModel(langs, logp.astype(np.float32), allowed, prior, switch)


def word_scores(text: _Text, model: LanguageModel) -> np.ndarray:
    """[word, language] log-likelihoods, relative to the word's best. A
    language that does not use the word's script is out of reach; a word in
    a script of no learned language tells nothing."""
    out = np.zeros((len(text.starts), len(model.langs)), dtype=np.float32)
    for i, j, f, base in text.blocks():
        edges = np.stack([text.starts[i:j], text.ends[i:j] + 1], axis=1).ravel() - base
        g = np.concatenate([model.logp[buckets(f, model.bits)], np.zeros((1, len(model.langs)), dtype=np.float32)])
        out[i:j] = np.add.reduceat(g, edges, axis=0)[::2]
    ok = model.allowed[text.script]
    known = ok.any(axis=1)
    out[known] = np.where(ok[known], out[known], -1e4)
    out[~known] = 0
    return out - out.max(axis=1, keepdims=True) if len(out) else out


def _one_language(s: np.ndarray, first: np.ndarray, best: np.ndarray, row: np.ndarray, penalty: float) -> np.ndarray:
    """Rows whose best path is surely their best single language: no run of
    words gains as much by leaving it as its switches cost. The gain of a
    word is its largest over the other languages, so this never says yes
    wrongly; other rows go through Viterbi."""
    n = len(best)
    if s.shape[1] == 1:
        return np.ones(n, dtype=bool)
    gain = s.astype(np.float64)
    own = gain[np.arange(len(s)), best[row]]
    gain[np.arange(len(s)), best[row]] = -np.inf
    gain = gain.max(axis=1) - own
    shift = 1e6 * row  # keeps running extremes of earlier rows out
    upto = np.cumsum(gain)
    low = np.minimum.accumulate(upto - gain - shift)
    high = np.zeros(n, dtype=bool)
    some = np.flatnonzero(first[1:] > first[:-1])
    at, end = first[some], first[some + 1] - 1
    start = upto[at] - gain[at]
    inner = np.maximum.reduceat(upto - shift - low, at)
    head = np.maximum.reduceat(upto, at) - start
    tail = upto[end] - np.minimum.reduceat(upto - gain, at)
    high[some] = (inner < 2 * penalty) & (head < penalty) & (tail < penalty)
    return high


def viterbi(s: np.ndarray, first: np.ndarray, rows: np.ndarray, penalty: float) -> dict[int, np.ndarray]:
    """The best label sequence of each of ``rows``, all rows one step at a
    time: V = max(V, max(V) - penalty) + score."""
    size = first[rows + 1] - first[rows]
    rows = rows[np.argsort(-size, kind="stable")]
    begin, size = first[rows], first[rows + 1] - first[rows]
    if not len(rows):
        return {}
    base = np.concatenate([[0], np.cumsum(size)])
    switched = np.zeros((int(base[-1]), s.shape[1]), dtype=bool)
    source = np.zeros(int(base[-1]), dtype=np.int32)
    v = np.zeros((len(rows), s.shape[1]))
    left = len(rows)
    for t in range(int(size[0])):
        while size[left - 1] <= t:
            left -= 1
        top = v[:left].argmax(axis=1)
        most = v[np.arange(left), top][:, None] - penalty
        at = base[:left] + t
        if t:
            switched[at] = most > v[:left]
            v[:left] = np.maximum(v[:left], most)
        source[at] = top
        v[:left] += s[begin[:left] + t]
    label = v.argmax(axis=1)
    out = np.empty(int(base[-1]), dtype=np.int32)
    live = np.searchsorted(-size, -np.arange(1, int(size[0]) + 1), side="right")  # rows longer than t
    for t in range(int(size[0]) - 1, -1, -1):
        k = live[t]
        at = base[:k] + t
        out[at] = label[:k]
        label[:k] = np.where(switched[at, label[:k]], source[at], label[:k])
    return {int(r): out[base[i]:base[i + 1]] for i, r in enumerate(rows)}


def label_rows(texts: list[str | None], model: LanguageModel):
    """(language, score, spans) of each text."""
    return [row[:3] for row in label_known(texts, model)]


def label_known(texts: list[str | None], model: LanguageModel):
    """(language, score, spans, known) of each text; known is the share of
    the letters in words whose script some learned language uses."""
    text = _Text(texts)
    out: list[tuple[str, float, list[dict], float]] = [(UNKNOWN, 0.0, [], 0.0)] * len(texts)
    if not model.langs or not len(text.starts):
        return out
    s = word_scores(text, model)
    in_script = text.letters * model.allowed[text.script].any(axis=1)
    some = np.flatnonzero(text.first[1:] > text.first[:-1])
    totals = np.zeros((len(texts), len(model.langs)))
    totals[some] = np.add.reduceat(s.astype(np.float64), text.first[some], axis=0)
    best = (totals + 1e-9 * model.prior).argmax(axis=1)
    sure = _one_language(s, text.first, best, text.row, model.switch)
    paths = viterbi(s, text.first, some[~sure[some]], model.switch)
    for r in some.tolist():
        lo, hi = int(text.first[r]), int(text.first[r + 1])
        path = paths.get(r)
        every = text.letters[lo:hi].sum()
        known = float(in_script[lo:hi].sum() / every)
        if path is None:
            out[r] = (model.langs[best[r]], known, [{"begin": 0, "end": hi - lo, "lang": model.langs[best[r]]}], known)
            continue
        letters = np.bincount(path, weights=in_script[lo:hi], minlength=len(model.langs))
        top = int((letters + 1e-9 * totals[r]).argmax())
        edge = np.append(np.flatnonzero(np.append(True, path[1:] != path[:-1])), hi - lo).tolist()
        out[r] = (model.langs[top], float(letters[top] / every),
                  [{"begin": a, "end": b, "lang": model.langs[path[a]]} for a, b in zip(edge[:-1], edge[1:])], known)
    return out


def identify(docs: DataFrame, model: LanguageModel, *, id_col: str = "doc_id", text_col: str = "text",
             carry: list[str] | None = None) -> DataFrame:
    """One row per input row: ``id_col``, ``lang_pred`` (a learned language,
    or ``und`` for a text without letters), ``score`` (share of the letters
    in spans of that language, in words whose script some learned language
    uses), ``spans`` (begin, end, lang: maximal runs of words of one
    language) and ``known`` (share of the letters in words of such scripts,
    whatever their language); with ``carry`` also the named input columns
    in a struct ``carried``.

    Only the text is looked at. Defined cases: null, empty and letterless
    texts are ``und`` with score 0 and no spans, as is every text when
    nothing was learned; repeated rows get the same answer each; ties go to
    the language with more training words; an empty table gives an empty
    result. A very long text is scored in blocks of code points; only small
    arrays per word are held for all of it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType()),
                         T.StructField("lang", T.StringType())])
    rows = docs.select(F.struct(F.col(id_col).alias("id"), carried(carry).alias("carried")).alias("key"),
                       F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("key", rows.schema["key"].dataType), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(span)),
                           T.StructField("known", T.DoubleType())])
    arrow_span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = tk.text_bytes(batch.column("text"))
            for lo, hi in tk.pieces(offsets, _BATCH_BYTES):
                part = batch.slice(lo, hi - lo)
                got = label_known(part.column("text").to_pylist(), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array([g[0] for g in got], pa.string()),
                     pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], arrow_span),
                     pa.array([g[3] for g in got], pa.float64())],
                    ["key", "lang_pred", "score", "spans", "known"])

    out = rows.mapInArrow(run, schema)
    return out.select(F.col("key.id").alias(id_col), *([F.col("key.carried").alias("carried")] if carry else []),
                      "lang_pred", "score", "spans", "known")
