"""DuckDB twins of the operators that SQL can express."""

from __future__ import annotations

from signalbook.llm import line_rules, sharding

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

#: Links by brute force over shared shingles, then the smallest id reachable.
OP1 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS sh
  FROM d),
x AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS sh FROM s),
link AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.sh = b.sh AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id, doc_id AS r FROM s
  UNION
  SELECT reach.doc_id, link.b FROM reach JOIN link ON reach.r = link.a)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, min(r) AS component_id, s.doc_id = min(r) AS kept
FROM s JOIN reach USING (doc_id) GROUP BY s.doc_id, s.sh
"""

OP2 = rf"""
WITH d AS (SELECT doc_id, source, text, {_WORDS} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ln
  FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, w FROM d),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS k FROM win),
dup AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM g),
rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM dup, range(5) t(j) WHERE c > 1 GROUP BY doc_id),
base AS (SELECT d.doc_id, coalesce(source, chr(0)) AS host, text, CAST(len(w) AS BIGINT) AS n_words,
    CAST(len(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ln) - len(list_distinct(ln)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN rep USING (doc_id)),
txt AS (SELECT DISTINCT coalesce(source, chr(0)) AS host, text FROM documents),
pos AS (SELECT host, text, unnest(string_split(regexp_replace(regexp_replace(lower(text), '[0-9]+', '0', 'g'),
    '[\x20\x09\x0B-\x0D]+', ' ', 'g'), chr(10))) AS raw FROM txt),
l AS (SELECT host, text, trim(raw) AS line, len(trim(raw)) - len(replace(trim(raw), ' ', '')) + 1 AS n
  FROM pos WHERE trim(raw) <> ''),
com AS (SELECT host, line FROM l GROUP BY host, line HAVING count(DISTINCT text) > {line_rules.MIN_DOCS}),
cut AS (SELECT host, text, CAST(sum(n) AS BIGINT) AS removed_words FROM l JOIN com USING (host, line) GROUP BY host, text),
v AS (SELECT base.*, coalesce(removed_words, 0) AS removed_words,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
  FROM base LEFT JOIN cut USING (host, text))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, removed_words, base_failed,
  NOT base_failed AND removed_words <= {line_rules.MOST_REMOVED} * n_words AND n_words - removed_words >= 10 AS kept
FROM v
"""


def _crc32_table() -> list[int]:
    table = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        table.append(byte)
    return table


def op9(n_shards: int, seed: int) -> str:
    keys = sharding.round_keys(seed)
    rounds = len(keys)
    return f"""
WITH RECURSIVE crc AS (SELECT {_crc32_table()}::BIGINT[] AS t),
byte AS (SELECT doc_id, text, list_prepend(4294967295::BIGINT, list_transform(
    regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT)) AS b FROM documents),
d AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 8 AS size,
    CASE WHEN text IS NOT NULL THEN xor(list_reduce(b, lambda c, x:
      xor(c >> 8, crc.t[(xor(c, x) & 255) + 1])), 4294967295) END AS text_crc32,
    md5(coalesce(doc_id::VARCHAR, '')) AS k FROM byte, crc),
n AS (SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS high,
    CAST(ceil(count(*) / ceil(sqrt(count(*)))) AS BIGINT) AS wide, CAST(floor(sqrt(count(*))) AS BIGINT) + 1 AS buckets FROM d),
num AS (SELECT d.*, row_number() OVER (
    ORDER BY ('0x' || substr(k, 1, 8))::BIGINT % buckets, k, doc_id, text_crc32, size) - 1 AS i FROM d, n),
key AS (SELECT {[k[0] for k in keys]}::BIGINT[] AS fa, {[k[1] for k in keys]}::BIGINT[] AS su),
walk AS (
  SELECT i, i // wide AS l, i % wide AS r, 0 AS step FROM num, n
  UNION ALL
  SELECT i, CASE WHEN step % 2 = 0 THEN (l + ((h * h + h) >> 9)) % high ELSE l END,
    CASE WHEN step % 2 = 1 THEN (r + ((h * h + h) >> 9)) % wide ELSE r END, step + 1
  FROM (SELECT walk.*, high, wide, n.n, ((CASE WHEN step % 2 = 0 THEN r ELSE l END) % {sharding.PRIME}
      * fa[step % {rounds} + 1] + su[step % {rounds} + 1]) % {sharding.PRIME} AS h FROM walk, n, key)
  WHERE step = 0 OR step % {rounds} <> 0 OR l * wide + r >= n),
p AS (SELECT i, l * wide + r AS p FROM walk, n WHERE step > 0 AND step % {rounds} = 0 AND l * wide + r < n.n)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(p % {n_shards} AS INT) AS shard, p // {n_shards} AS slot,
  CAST(NULL AS INT) AS grown_shard
FROM num JOIN p USING (i)
"""


def op10(weights: list[int], share: float, most: float, seed: int) -> str:
    return rf"""
WITH d AS (SELECT doc_id, source, text, CAST(len({_WORDS}) AS BIGINT) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST({weights}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} + 1] AS DOUBLE) AS weight,
    {most}::DOUBLE * source_size AS ceiling, {share}::DOUBLE * sum(source_size) OVER ()::DOUBLE AS total FROM s),
lv AS (SELECT *, (total - coalesce(sum(ceiling) OVER (ORDER BY ceiling / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY ceiling / weight, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
op AS (SELECT *, max(CASE WHEN level * weight <= ceiling THEN level END) OVER () AS open_level FROM lv),
t AS (SELECT source, source_size, least(ceiling, coalesce(open_level * weight, ceiling)) AS target FROM op),
k AS (SELECT d.*, t.source_size, t.target, md5({seed} || ':' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size, md5(text)
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before,
    CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes FROM k)
SELECT doc_id, size, source_size, target,
  CAST(passes * size + least(size, greatest(0, CAST(floor(target) AS BIGINT) - passes * source_size - before)) AS BIGINT) AS taken
FROM c
"""


#: Every window of a text by its bytes in hex; those that occur twice join to runs.
OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
part AS (SELECT r, b, substr(h, CAST(1024 * b + 1 AS BIGINT), 1822) AS h
  FROM (SELECT r, h, unnest(range((len(h) // 2 - 400) // 512 + 1)) AS b FROM d WHERE len(h) >= 800)),
w AS (SELECT r, 512 * b + j AS i, md5_number(substr(h, CAST(2 * j + 1 AS BIGINT), 800)) AS k
  FROM (SELECT *, unnest(range(least(512, len(h) // 2 - 399))) AS j FROM part)),
twice AS (SELECT k FROM w GROUP BY k HAVING count(*) > 1),
s AS (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS p FROM w SEMI JOIN twice USING (k)),
run AS (SELECT r, i, sum(CASE WHEN p IS NULL OR i > p + 400 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS n FROM s),
span AS (SELECT r, n, min(i) AS a, max(i) + 400 AS b FROM run GROUP BY r, n),
cut AS (SELECT r, a, b, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS e FROM span),
kept AS (SELECT r, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS e,
    string_agg(substr(h, CAST(2 * e + 1 AS BIGINT), CAST(2 * (a - e) AS BIGINT)), '' ORDER BY a) AS front
  FROM cut JOIN d USING (r) GROUP BY r)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(front, '') || substr(h, CAST(2 * coalesce(e, 0) + 1 AS BIGINT)))) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""


#: All anchors against all rows.
OP13 = """
WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: CAST(floor(256.0::DOUBLE * c::DOUBLE) AS BIGINT)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label,
    coalesce(list_sum(list_transform(list_zip(a.x, b.x, true), lambda z: z[1] * z[2])), 0)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND (a.vec_id, a.label, a.x) IS DISTINCT FROM (b.vec_id, b.label, b.x)),
p AS (SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id, own ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id, p.own
    ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id, own)
WHERE s.label <> own AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


SQL = {
    "op1_minhash_near_dedup": OP1,
    "op2_line_frequency_rules": OP2,
    "op9_feistel_shards": op9(24, 0),
    "op10_source_mix": op10([3, 1, 2], 1.5, 2.0, 0),
    "op12_suffix_array_family": OP12,
    "op13_threshold_hard_negatives": OP13,
}
