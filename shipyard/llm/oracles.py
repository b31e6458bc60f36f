"""DuckDB SQL for the operators that SQL can express, written from their definitions."""

from __future__ import annotations

#: Private keys as op8 defines them, from header to END line.
PEM = (
    r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----(?:[\x20\r\n]{0,9}[A-Za-z-]{1,20}:\x20[^\r\n]{0,100}){0,5}"
    r"""([A-Za-z0-9+/=\\"',.\x20\t\r\n]+)-----END [A-Z ]{0,20}PRIVATE KEY-----"""
)


def line_dedup(divisor: int = 3) -> str:
    """op6 by windows over exploded lines."""
    return f"""
WITH lines AS (
  SELECT doc_id, unnest(str_split(text, chr(10))) AS line, generate_subscripts(str_split(text, chr(10)), 1) AS i,
         len(str_split(text, chr(10))) AS n
  FROM documents WHERE text IS NOT NULL),
hashed AS (SELECT *, CAST('0x' || substr(md5(line), 1, 7) AS BIGINT) AS h FROM lines),
raw AS (
  SELECT *, i = 1 OR (lag(h) OVER (PARTITION BY doc_id ORDER BY i) * 31 + h) % 1000003 % {divisor} = 0 AS candidate FROM hashed),
ended AS (
  SELECT *, i = n OR (i > 1 AND i < n - 1 AND candidate AND NOT lag(candidate) OVER (PARTITION BY doc_id ORDER BY i)) AS ends FROM raw),
numbered AS (
  SELECT *, coalesce(sum(CAST(ends AS INT)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS number
  FROM ended),
pieces AS (
  SELECT doc_id, number, count(*) AS lines, string_agg(line, chr(10) ORDER BY i) AS chunk FROM numbered GROUP BY doc_id, number),
judged AS (
  SELECT *, lines > 1 AND length(trim(chunk, ' ' || chr(9) || chr(10) || chr(13))) > 0
            AND row_number() OVER (PARTITION BY lines > 1, chunk ORDER BY doc_id, number) > 1 AS gone FROM pieces),
kept AS (
  SELECT doc_id, count(*) AS n_chunks, count(*) FILTER (gone) AS n_removed_chunks,
         coalesce(string_agg(chunk, chr(10) ORDER BY number) FILTER (NOT gone), '') AS text FROM judged GROUP BY doc_id)
SELECT d.doc_id, n_chunks, n_removed_chunks, length(k.text) AS kept_chars, md5(k.text) AS kept_md5
FROM documents d LEFT JOIN kept k USING (doc_id)"""


def _case(column: str, weights: dict[str, int], default: int) -> str:
    return "CASE " + " ".join(f"WHEN {column} = '{k}' THEN {v}" for k, v in weights.items()) + f" ELSE {default} END" if weights else str(default)


def mixing(weights: dict[str, dict[str, int]], share: tuple[int, int], epochs: int, seed: int, default: int) -> str:
    """op4: water filling level by level, then running sums over each leaf's order."""

    def level(name: str, column: str, above: list[str], budget: str) -> str:
        keys = ", ".join([*above, column])
        part = f"PARTITION BY {', '.join(above)}" if above else ""
        below = ["domain", "lang", "source"][len(above) + 1 :]
        usable = " AND ".join(f"{_case(c, weights.get({'lang': 'language'}.get(c, c), {}), default)} > 0" for c in below) or "true"
        join = f"JOIN {budget} b ON " + " AND ".join(f"n.{c} IS NOT DISTINCT FROM b.{c}" for c in above) if above else "CROSS JOIN total b"
        return f"""
{name}_nodes AS (SELECT {keys}, sum(CASE WHEN {usable} THEN tokens ELSE 0 END) * {epochs} AS capacity, {_case(column, weights.get({'lang': 'language'}.get(column, column), {}), default)} AS weight FROM leaves GROUP BY {keys}),
{name}_open AS (
  SELECT n.*, b.given AS budget, coalesce(sum(capacity) OVER ({part.replace(', ', ', n.').replace('BY ', 'BY n.')} ORDER BY CAST(capacity AS DOUBLE) / weight, n.{column} NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken,
         sum(weight) OVER ({part.replace(', ', ', n.').replace('BY ', 'BY n.')} ORDER BY CAST(capacity AS DOUBLE) / weight, n.{column} NULLS FIRST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM {name}_nodes n {join} WHERE weight > 0),
{name}_full AS (
  SELECT *, bool_and(CAST(capacity AS HUGEINT) * rest <= CAST(greatest(budget - taken, 0) AS HUGEINT) * weight)
    OVER ({part} ORDER BY CAST(capacity AS DOUBLE) / weight, {column} NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM {name}_open),
{name} AS (
  SELECT {keys}, CAST(CASE WHEN filled THEN capacity ELSE least(capacity,
      (CAST(budget AS HUGEINT) - coalesce(sum(CASE WHEN filled THEN capacity END) OVER ({part}), 0)) * weight // sum(CASE WHEN NOT filled THEN weight END) OVER ({part})) END AS BIGINT) AS given
  FROM {name}_full)"""

    return f"""
WITH sized AS (
  SELECT doc_id, text, lang, source, 'd' || CAST(CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) % 4 AS VARCHAR) AS domain,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens) AS tokens FROM sized GROUP BY ALL),
total AS (SELECT sum(tokens) * {share[0]} // {share[1]} AS given FROM leaves),
{level('by_domain', 'domain', [], 'total')},
{level('by_language', 'lang', ['domain'], 'by_domain')},
{level('by_source', 'source', ['domain', 'lang'], 'by_language')},
plan AS (
  SELECT l.*, given, CASE WHEN tokens > 0 THEN given // tokens ELSE 0 END AS whole FROM leaves l JOIN by_source b
  ON l.domain IS NOT DISTINCT FROM b.domain AND l.lang IS NOT DISTINCT FROM b.lang AND l.source IS NOT DISTINCT FROM b.source),
ordered AS (
  SELECT s.*, p.whole, p.tokens, p.given - p.whole * p.tokens AS room,
         sum(n_tokens) OVER (PARTITION BY s.domain, s.lang, s.source
           ORDER BY md5('{seed}:' || CAST(p.whole AS VARCHAR) || ':' || CAST(doc_id AS VARCHAR)) || md5(coalesce(text, ''))) AS upto
  FROM sized s JOIN plan p ON s.domain IS NOT DISTINCT FROM p.domain AND s.lang IS NOT DISTINCT FROM p.lang AND s.source IS NOT DISTINCT FROM p.source),
taken AS (
  SELECT *, unnest(range(CAST(whole AS BIGINT))) AS epoch FROM ordered
  UNION ALL SELECT *, whole AS epoch FROM ordered WHERE upto <= room AND (room > 0 OR tokens = 0))
SELECT doc_id, CAST(epoch AS INTEGER) AS epoch, domain, lang, source, CAST(n_tokens AS BIGINT) AS n_tokens FROM taken"""


def secret_scan() -> str:
    """op8: places by splitting at the pattern, then owners per value."""
    kinds = [
        ("assign", 0, r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
        ("access", 1, r"AKIA[A-Z0-9]+", 0, 20, True),
        ("hex", 2, r"[0-9a-f]+", 0, 24, True),
        ("service", 3, r"(?:gh[pousr]_|sk-|xox[abprs]-)[A-Za-z0-9-]{20,}", 0, 20, False),
        ("jwt", 4, r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 30, False),
        ("pem", 5, PEM.replace("'", "''"), 1, 20, False),
        ("mixed", 6, r"[A-Za-z0-9+/]{32,}", 0, 32, False),
    ]
    each = " UNION ALL ".join(
        f"""SELECT doc_id, source, lang, '{name}' AS kind, {rank} AS rank, {str(base).upper()} AS base, {least} AS least,
  unnest(regexp_extract_all(text, '{pattern}', 0)) AS whole, unnest(regexp_extract_all(text, '{pattern}', {group})) AS value,
  unnest(list_slice(string_split_regex(text, '{pattern}'), 1, len(regexp_extract_all(text, '{pattern}', 0)))) AS piece,
  generate_subscripts(regexp_extract_all(text, '{pattern}', 0), 1) AS k FROM t"""
        for name, rank, pattern, group, least, base in kinds
    )
    return f"""
WITH t AS (SELECT doc_id, source, lang, coalesce(text, '') AS text FROM documents),
matched AS ({each}),
placed AS (
  SELECT *, sum(length(piece) + length(whole)) OVER (PARTITION BY doc_id, kind ORDER BY k) - length(whole) AS a,
            sum(length(piece) + length(whole)) OVER (PARTITION BY doc_id, kind ORDER BY k) AS b FROM matched),
found AS (SELECT * FROM placed WHERE length(value) >= least),
owned AS (
  SELECT value, count(DISTINCT coalesce('=' || source, '')) AS owners,
         count(DISTINCT coalesce('=' || source, '') || ' ' || concat_ws('/', source, lang)) AS repositories FROM found GROUP BY value),
judged AS (
  SELECT f.*, CASE WHEN owners <= 1 AND len(list_distinct(str_split(f.value, ''))) >= 8 AND regexp_matches(f.value, '[0-9]')
      AND regexp_matches(f.value, '[A-Za-z]') THEN 'live' WHEN owners >= 3 OR owners >= 2 AND repositories >= 4 THEN 'example' ELSE 'unclear' END AS verdict
  FROM found f JOIN owned USING (value)),
shown AS (
  SELECT * FROM judged j WHERE base OR (verdict = 'live' AND NOT EXISTS (
    SELECT 1 FROM found s WHERE s.doc_id = j.doc_id AND s.base AND s.a < j.b AND j.a < s.b))),
text_of AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         coalesce(string_agg(kind || ':' || CAST(CAST(a AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(b AS BIGINT) AS VARCHAR), ',' ORDER BY a, rank) FILTER (base), '') AS base,
         string_agg(kind || ':' || CAST(CAST(a AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(b AS BIGINT) AS VARCHAR), ',' ORDER BY a, rank) AS spans,
         count(*) FILTER (verdict = 'live') AS n_live, count(*) FILTER (verdict = 'example') AS n_example
  FROM shown GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM t LEFT JOIN text_of USING (doc_id)"""


def embedding_dedup(limit: float = 0.95) -> str:
    """op2: all pairs, then the smallest id over the closure of the links."""
    return f"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e,
         embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
           AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS fine FROM embeddings),
ok AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_inner_product(e, e))) AS u FROM v WHERE fine),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.u) = len(b.u)
  AND list_inner_product(a.u, b.u) >= {limit}),
reached AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT m.vec_id, (SELECT count(*) FROM links l WHERE l.a = m.vec_id) AS n_links, component_id, m.vec_id = component_id AS kept
FROM least m"""


def embedding_copies() -> str:
    """``embedding_dedup`` over the vectors and their copies."""
    many = """
WITH RECURSIVE source AS (SELECT vec_id AS id, embedding AS e, len(embedding) AS size FROM embeddings),
many AS (
  SELECT id * 3 AS vec_id, e AS embedding FROM source
  UNION ALL SELECT id * 3 + 1, list_transform(e, lambda x, i: CAST(CASE WHEN i - 1 = id % size THEN -x ELSE x END AS FLOAT)) FROM source
  UNION ALL SELECT id * 3 + 2, list_transform(e, lambda x, i: CAST(CASE WHEN (i - 1) * 2 < size THEN x * 2 ELSE x END AS FLOAT)) FROM source),
"""
    return many + embedding_dedup().replace("FROM embeddings", "FROM many").replace("\nWITH RECURSIVE ", "", 1)


def substring_dedup(width: int = 13) -> str:
    """op3 over all windows as text."""
    return f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(words) - {width} + 2)) AS i,
         unnest(list_transform(range(1, len(words) - {width} + 2), lambda x: array_to_string(words[x:x + {width - 1}], ' '))) AS text FROM w),
firsts AS (SELECT text, min(doc_id) AS first FROM windows GROUP BY text),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + {width})) AS pos FROM windows JOIN firsts USING (text) WHERE first < doc_id),
kept AS (
  SELECT e.doc_id, e.pos, e.word FROM (SELECT doc_id, unnest(range(1, len(words) + 1)) AS pos, unnest(words) AS word FROM w) e
  ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.pos = g.pos),
joined AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS text FROM kept GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(j.text, '')) AS kept_sha256
FROM w LEFT JOIN joined j USING (doc_id)"""


def exact_topk(every: int = 20, k: int = 20, scale: int = 64) -> str:
    """op9: the stated queries against all rows."""
    return f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % {every} = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= {k}"""


def resampling(buckets: int = 10_000, least_words: int = 20, share: tuple[int, int] = (10, 100), seed: int = 2024) -> str:
    """op13: the CRC byte by byte over each different word."""
    return f"""
WITH RECURSIVE steps AS (
  SELECT i, CAST(i AS BIGINT) AS c, 0 AS k FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
texts AS (
  SELECT doc_id AS id, true AS own, text FROM documents UNION ALL SELECT item_id, false, text FROM benchmark),
split AS (
  SELECT id, own, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM texts),
used AS (SELECT id, own, unnest(words) AS word FROM split),
hashed AS (
  SELECT word, xor(list_reduce(
           list_transform(range(strlen(word)), lambda k: CAST('0x' || substr(hex(word), 2 * k + 1, 2) AS BIGINT)),
           lambda c, b: xor(c // 256, t[1 + xor(c, b) % 256]), CAST(4294967295 AS BIGINT)), 4294967295) % {buckets} AS bucket
  FROM (SELECT DISTINCT word FROM used), crc),
placed AS (SELECT id, own, bucket FROM used JOIN hashed USING (word)),
totals AS (SELECT count(*) FILTER (own) AS s, count(*) FILTER (NOT own) AS t FROM placed),
counts AS (SELECT bucket, count(*) FILTER (own) AS s, count(*) FILTER (NOT own) AS t FROM placed GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(c.t + 1 AS DOUBLE) * CAST(a.s + {buckets} AS DOUBLE)
    / (CAST(c.s + 1 AS DOUBLE) * CAST(a.t + {buckets} AS DOUBLE)))) AS BIGINT) AS gain FROM counts c, totals a),
weights AS (SELECT id, sum(gain) AS weight FROM placed JOIN gains USING (bucket) WHERE own GROUP BY id),
scored AS (
  SELECT d.id AS doc_id, CAST(len(words) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{seed}:' || CAST(d.id AS VARCHAR)), 1, 8) AS BIGINT) + 0.5)
           / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM split d LEFT JOIN weights w ON d.id = w.id WHERE own),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= {least_words} ORDER BY score DESC, doc_id) AS place,
         count(*) OVER (PARTITION BY n_features >= {least_words}) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= {least_words} AND place <= {share[0]} * n // {share[1]} THEN place END AS rank
FROM ranked"""


def prefix_trie(most: int = 5) -> str:
    """op11: every prefix of every rebuilt conversation as text, and sums over the
    prefixes of each. DuckDB has no CRC-32; it is built byte by byte over the digits."""
    return f"""
WITH RECURSIVE steps AS (
  SELECT i, CAST(i AS BIGINT) AS c, 0 AS k FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         substr(sha256(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS h
  FROM conversations WHERE conv_id IS NOT NULL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, h) AS i FROM turns),
ids AS (
  SELECT conv_id, xor(list_reduce(
      list_transform(range(length(CAST(conv_id AS VARCHAR))), lambda k: CAST(ascii(substr(CAST(conv_id AS VARCHAR), CAST(k + 1 AS BIGINT), 1)) AS BIGINT)),
      lambda c, b: xor(c // 256, t[1 + xor(c, b) % 256]), CAST(4294967295 AS BIGINT)), 4294967295) % {most + 1} AS n_given
  FROM (SELECT DISTINCT conv_id FROM turns), crc),
taken AS (
  SELECT c.conv_id, 0 AS part, i, h, length(text) AS size FROM ids c JOIN numbered b ON b.conv_id = c.conv_id - c.conv_id % 100 AND i <= n_given
  UNION ALL SELECT conv_id, 1, i, h, length(text) FROM ids JOIN numbered USING (conv_id) WHERE i > n_given),
placed AS (SELECT conv_id, h, size, row_number() OVER (PARTITION BY conv_id ORDER BY part, i) AS depth FROM taken),
prefixes AS (
  SELECT conv_id, depth, size, string_agg(h, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM placed
  UNION ALL SELECT conv_id, 0, 0, '' FROM ids),
lengths AS (SELECT conv_id, max(depth) AS n FROM prefixes GROUP BY conv_id),
nodes AS (
  SELECT path, min(p.conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs, any_value(size) AS size,
         sha256(coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (depth = n), '')) AS ends_sha256
  FROM prefixes p JOIN lengths l USING (conv_id) GROUP BY path),
children AS (SELECT substr(path, 1, length(path) - 32) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
whole AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (path)),
above AS (
  SELECT substr(path, 1, CAST(32 * k AS BIGINT)) AS path, n_children = 0 AS leaf, (n_convs - 1) * size AS saved
  FROM (SELECT *, unnest(range(depth + 1)) AS k FROM whole)),
sums AS (SELECT path, count(*) FILTER (leaf) AS n_leaves, sum(saved) AS saved_tokens FROM above GROUP BY path)
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, w.ends_sha256
FROM whole w JOIN sums s ON s.path = w.path LEFT JOIN nodes p ON w.depth > 0 AND p.path = substr(w.path, 1, length(w.path) - 32)"""
