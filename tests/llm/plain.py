"""Brute-force statements of the operators, over lists of dicts."""

import hashlib
import math
import re

import xxhash

SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def id_order(v):
    return (v is not None, v if v is not None else 0)


def substring(docs, window=20):
    """[(id, n_words, removed word indices, kept text)] in (id, text) order."""
    rows = sorted(docs, key=lambda d: (id_order(d["doc_id"]), (d["text"] is not None, (d["text"] or "").encode())))
    seen, out = set(), []
    for d in rows:
        w = SPACE_WORDS.findall(d["text"] or "")
        gone = set()
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            if k in seen:
                gone.update(range(i, i + window))
            seen.add(k)
        out.append((d["doc_id"], len(w), gone, " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def simhash(text, k=3):
    w = SPACE_WORDS.findall(lower(text))
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(w[i:i + k]).encode(), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(prints, distance=3):
    """Root per position, for fingerprints that link at ``distance`` bits."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def normalised(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(text, items, window=10):
    """(n_words, hit word indices, item ids)."""
    w = ALNUM_WORDS.findall(lower(text))
    hit, ids = set(), set()
    for item, t in items:
        iw = ALNUM_WORDS.findall(lower(t))
        m = min(window, len(iw))
        for i in range(len(iw) - m + 1 if m else 0):
            for j in range(len(w) - m + 1):
                if w[j:j + m] == iw[i:i + m]:
                    hit.update(range(j, j + m))
                    ids.add("" if item is None else str(item))
    return len(w), hit, sorted(ids)


def targets(sizes, weights=(5, 2, 1), share=1.5, repeats=2):
    """Target per source by repeated sharing of the excess."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    wt = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = share * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(capped.values())
        t = {s: rest * wt[s] / sum(wt[x] for x in free) for s in free}
        over = [s for s in free if t[s] > repeats * sizes[s]]
        if not over:
            return {**capped, **t}
        capped.update({s: float(repeats * sizes[s]) for s in over})
        if len(capped) == len(order):
            return capped


def sainte_lague(votes, seats):
    """Seats per party by the full list of quotients; ties to the smaller key."""
    quotients = sorted((-v / (2 * k + 1), key) for key, v in votes.items() if v > 0 for k in range(seats))
    out = dict.fromkeys(votes, 0)
    for _, key in quotients[:seats]:
        out[key] += 1
    return out


def signed_hash(text):
    h = xxhash.xxh64_intdigest((text or "").encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def mix(docs, block=64, shard_words=200_000, seed=7):
    """taken per position."""
    size = [len(SPACE_WORDS.findall(d["text"] or "")) for d in docs]
    sizes = {}
    for d, n in zip(docs, size):
        sizes[d["source"]] = sizes.get(d["source"], 0) + n
    t = targets(sizes) if sizes else {}
    block = max(1, min(block, math.floor(min((x for x in t.values() if x > 0), default=16) / 16)))
    blocks = math.floor(sum(t.values()) / block + 0.5)
    quota = sainte_lague({(s is None, s or ""): v for s, v in t.items()}, blocks)
    taken = [0] * len(docs)
    for s in sizes:
        shards = max(1, math.ceil(sizes[s] / shard_words))
        place = {}
        for i, d in enumerate(docs):
            if d["source"] == s:
                h = hashlib.md5(f"{seed}:{'' if d['doc_id'] is None else d['doc_id']}".encode()).hexdigest()
                place.setdefault(int(h[:8], 16) % shards, []).append(
                    (h, d["doc_id"] is None, d["doc_id"] or 0, size[i], signed_hash(d["text"]), size[i], i))
        q = sainte_lague({k: sum(x[3] for x in v) for k, v in place.items()}, quota[(s is None, s or "")])
        for k, rows in place.items():
            total = sum(x[3] for x in rows)
            for turn in range(2):
                at = 0
                for *_, n, i in sorted(rows):
                    taken[i] += max(0, min(n, q[k] * block - turn * total - at))
                    at += n
    return size, sizes, t, taken
