"""DuckDB SQL for the queries that SQL can express, written independently
of the operators (full windows, full lists of quotients)."""

from __future__ import annotations

_SPACE_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_ALNUM_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
                r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

OP2 = f"""
WITH w AS (SELECT doc_id, {_SPACE_WORDS} AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS k
        FROM w, unnest(range(1, greatest(len(ws) - 18, 1))) AS t(i)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS rn
                               FROM win) WHERE rn > 1),
word AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM w),
hit AS (SELECT word.doc_id, word, pos,
               max(CASE WHEN rep.i IS NULL THEN 0 ELSE 1 END) OVER (
                   PARTITION BY word.doc_id ORDER BY pos ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
        FROM word LEFT JOIN rep ON rep.doc_id = word.doc_id AND rep.i = word.pos),
per AS (SELECT doc_id, sum(gone)::BIGINT AS n_removed,
               string_agg(word, ' ' ORDER BY pos) FILTER (gone = 0) AS kept FROM hit GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN per USING (doc_id)
"""

OP4 = r"""
WITH c AS (SELECT page_id, url, make_timestamp((1704067200 + ((page_id * 7919) % 8784) * 3600) * 1000000) AS fetched_at,
                  rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '.') AS host,
                  list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/+([^?#]*)', 1), '/'),
                              lambda s: s <> '') AS segs
           FROM pages),
named AS (SELECT DISTINCT * FROM (
            SELECT 'hosts' AS list, host AS pattern FROM c
            UNION ALL SELECT 'domains', regexp_extract(host, '([^.]+\.[^.]+)$', 1) FROM c
            UNION ALL SELECT 'paths', lower(host || '/' || segs[1]) FROM c WHERE len(segs) > 0 AND host <> '')
          WHERE pattern <> ''),
listed AS (SELECT list, pattern, list || ':' || pattern AS k FROM named
           WHERE ('0x' || substr(md5('listed:' || list || ':' || pattern), 1, 4))::BIGINT % 3 = 0),
ev AS (SELECT list, pattern, i, make_timestamp((1704067200
                + (('0x' || substr(md5('day:' || k || ':' || i), 1, 6))::BIGINT % 366) * 86400) * 1000000) AS ts
       FROM listed, unnest(range(1, ('0x' || substr(md5('events:' || k), 1, 4))::BIGINT % 6 + 2)) AS u(i)),
day AS (SELECT list, pattern, ts, max(i % 2) AS adds FROM ev GROUP BY ALL),
-- the latest event at or before the fetch decides, per list and pattern
cand AS (SELECT page_id, url, fetched_at, host, day.list, day.pattern, day.ts, adds,
                row_number() OVER (PARTITION BY page_id, url, fetched_at, day.list, day.pattern ORDER BY day.ts DESC) AS rn
         FROM c JOIN day ON day.ts <= fetched_at
              AND ((day.list <> 'paths' AND ('.' || host) LIKE ('%.' || day.pattern))
                   OR (day.list = 'paths' AND len(segs) > 0 AND lower(host || '/' || segs[1]) = day.pattern))),
act AS (SELECT * FROM cand WHERE rn = 1 AND adds = 1),
-- the standing entry began at the first add after the last remove
since AS (SELECT a.page_id, a.url, a.fetched_at, a.list, a.pattern,
                 (SELECT min(d.ts) FROM day d WHERE d.list = a.list AND d.pattern = a.pattern AND d.adds = 1 AND d.ts <= a.ts
                   AND d.ts > coalesce((SELECT max(r.ts) FROM day r WHERE r.list = a.list AND r.pattern = a.pattern
                                        AND r.adds = 0 AND r.ts < a.ts), TIMESTAMP '1970-01-01')) AS listed_since
          FROM act a),
best AS (SELECT *, row_number() OVER (PARTITION BY page_id, url, fetched_at
                                      ORDER BY length(pattern) DESC, pattern, listed_since) AS rn FROM since),
agg AS (SELECT page_id, url, fetched_at, count(*) AS n_entries,
               string_agg(DISTINCT list, ',' ORDER BY list) AS lists FROM since GROUP BY ALL)
SELECT DISTINCT c.page_id, c.url, c.fetched_at, c.host, coalesce(n_entries, 0)::BIGINT AS n_entries,
       coalesce(n_entries, 0) > 0 AS blocked, coalesce(lists, '') AS lists, best.pattern, best.listed_since
FROM c LEFT JOIN agg ON agg.page_id = c.page_id AND agg.url = c.url AND agg.fetched_at = c.fetched_at
     LEFT JOIN best ON best.page_id = c.page_id AND best.url = c.url AND best.fetched_at = c.fetched_at AND best.rn = 1
"""

OP5 = f"""
WITH d AS (SELECT doc_id, source, len({_SPACE_WORDS})::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ([5.0, 2.0, 1.0])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS wt,
             2.0::DOUBLE * source_size AS cap FROM s),
levels AS (SELECT a.source, a.cap / a.wt AS ratio,
                  ((SELECT sum(source_size) FROM w)::DOUBLE * 1.5::DOUBLE
                   - coalesce((SELECT sum(cap) FROM w b WHERE b.cap / b.wt < a.cap / a.wt), 0)::DOUBLE)
                  / ((SELECT sum(wt) FROM w)
                     - coalesce((SELECT sum(wt) FROM w b WHERE b.cap / b.wt < a.cap / a.wt), 0)) AS level
           FROM w a),
chosen AS (SELECT level FROM levels WHERE ratio >= level ORDER BY ratio LIMIT 1),
t AS (SELECT source, source_size, least(cap, (SELECT level FROM chosen) * wt)::DOUBLE AS target FROM w),
size AS (SELECT greatest(1, least(64, floor(coalesce(min(target) FILTER (target > 0), 16) / 16)))::BIGINT AS b FROM t),
blocks AS (SELECT round(sum(target) / (SELECT b FROM size))::BIGINT AS n FROM t),
q AS (SELECT source, target / (2 * k + 1) AS quotient FROM t, unnest(range(0, (SELECT n FROM blocks))) AS u(k)
      WHERE target > 0),
won AS (SELECT source, count(*)::BIGINT AS quota FROM
        (SELECT source, row_number() OVER (ORDER BY quotient DESC, source NULLS LAST) AS r FROM q)
        WHERE r <= (SELECT n FROM blocks) GROUP BY source),
placed AS (SELECT d.*, t.source_size, t.target, coalesce(won.quota, 0) AS quota, md5('7:' || d.doc_id) AS ord,
                  greatest(1, ceil(t.source_size / 200000.0))::BIGINT AS shards
           FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
                LEFT JOIN won ON d.source IS NOT DISTINCT FROM won.source),
sharded AS (SELECT *, ('0x' || substr(ord, 1, 8))::BIGINT % shards AS shard FROM placed),
ss AS (SELECT source, shard, sum(size)::BIGINT AS shard_size, max(quota) AS quota FROM sharded GROUP BY source, shard),
sq AS (SELECT source, shard, quota, shard_size::DOUBLE / (2 * k + 1) AS quotient
       FROM ss, unnest(range(0, quota)) AS u(k) WHERE shard_size > 0),
sw AS (SELECT source, shard, count(*)::BIGINT AS blocks FROM
       (SELECT *, row_number() OVER (PARTITION BY source ORDER BY quotient DESC, shard) AS r FROM sq)
       WHERE r <= quota GROUP BY source, shard),
run AS (SELECT a.doc_id, a.size, a.source_size, a.target, ss.shard_size, coalesce(sw.blocks, 0) * (SELECT b FROM size) AS words,
               sum(a.size) OVER (PARTITION BY a.source, a.shard ORDER BY a.ord, a.doc_id, a.size
                                 ROWS UNBOUNDED PRECEDING) - a.size AS beg
        FROM sharded a JOIN ss ON a.source IS NOT DISTINCT FROM ss.source AND a.shard = ss.shard
             LEFT JOIN sw ON a.source IS NOT DISTINCT FROM sw.source AND a.shard = sw.shard)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, words - beg)) + greatest(0, least(size, words - shard_size - beg)))::BIGINT AS taken
FROM run
"""

OP7 = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm)::BIGINT AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM n
"""

OP10 = f"""
WITH d AS (SELECT doc_id, {_ALNUM_WORDS} AS ws FROM documents),
b AS (SELECT item_id::VARCHAR AS item_id, {_ALNUM_WORDS} AS ws FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(ws)) AS m, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS k
       FROM b, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS t(i) WHERE len(ws) > 0),
lens AS (SELECT DISTINCT m FROM bw),
dw AS (SELECT doc_id, i, m, array_to_string(ws[i:i + m - 1], ' ') AS k
       FROM d, lens, unnest(range(1, greatest(len(ws) - m + 2, 1))) AS t(i)),
hits AS (SELECT doc_id, i, dw.m, item_id FROM dw JOIN bw ON dw.m = bw.m AND dw.k = bw.k),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM
        (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hits) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
        FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""


def _round(at: int) -> str:
    """CTEs of one assignment to the centroids c{at} and of their means."""
    return f"""
d{at} AS (SELECT vec_id, c.c, list_sum(list_transform(list_zip(kept.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
       FROM kept, c{at} AS c),
a{at} AS (SELECT vec_id, c, d FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, c) AS rn FROM d{at}) WHERE rn = 1),
m{at} AS (SELECT c, list(q ORDER BY i) AS v FROM (
         SELECT c, i, ((s - (((s % n) + n) % n)) // n)::BIGINT AS q
         FROM (SELECT a.c, t.i, sum(kept.v[t.i])::HUGEINT AS s, count(*)::HUGEINT AS n
               FROM a{at} AS a JOIN kept USING (vec_id), unnest(range(1, 65)) AS t(i) GROUP BY ALL)) GROUP BY c),
c{at + 1} AS (SELECT c.c, coalesce(m.v, c.v) AS v FROM c{at} AS c LEFT JOIN m{at} AS m USING (c)),"""


OP12 = f"""
WITH kept AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (SELECT row_number() OVER (ORDER BY h) - 1 AS c, v FROM
       (SELECT v, sha256('1:' || vec_id) AS h FROM kept ORDER BY h LIMIT 16)),
{"".join(_round(i) for i in range(4))}
per AS (SELECT c, sum(d)::BIGINT AS inertia FROM a3 GROUP BY c)
SELECT vec_id, a3.c::INTEGER AS cluster, d AS distance, per.inertia AS cluster_inertia,
       (SELECT sum(d)::BIGINT FROM a3) AS inertia, sha256(array_to_string(c3.v, ',')) AS centroid_sha256
FROM a3 JOIN per USING (c) JOIN c3 USING (c)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP13 = rf"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws FROM piece),
f AS (SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase, count(*)::HUGEINT AS f
      FROM w, unnest(range(1, 6)) AS t(m), unnest(range(1, greatest(len(ws) - m + 2, 1))) AS u(i) GROUP BY ALL),
n AS (SELECT lang, sum(f)::HUGEINT AS n FROM f WHERE m = 1 GROUP BY lang),
cand AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE m >= 2 AND f >= 100),
cut AS (SELECT c.lang, c.m, c.phrase, c.a, k, l.f AS l, r.f AS r, n.n, (1000 * c.a * n.n) // (l.f * r.f) AS score
        FROM cand c JOIN n USING (lang), unnest(range(1, m)) AS t(k)
        JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[:k], ' ')
        JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[k + 1:], ' ')),
low AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS rn FROM cut) WHERE rn = 1),
inside AS (SELECT DISTINCT lang, array_to_string(ws[i:i + q - 1], ' ') AS phrase, max(a) AS longer
           FROM cand, unnest(range(2, m)) AS t(q), unnest(range(1, m - q + 2)) AS u(i) GROUP BY lang, array_to_string(ws[i:i + q - 1], ' ')),
kept AS (SELECT low.* FROM low LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= 2000
"""

ORACLE_SQL = {
    "op2_substring_dedup": OP2,
    "op4_url_filter": OP4,
    "op5_mix_sources": OP5,
    "op7_exact_dedup": OP7,
    "op10_decontaminate": OP10,
    "op12_centroids": OP12,
    "op13_collocations": OP13,
}
