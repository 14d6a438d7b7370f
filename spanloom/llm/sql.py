"""SQL counterparts of the corpus queries, for the engine that checks the results."""

from __future__ import annotations

from spanloom.llm.centroids import CLUSTERS, DIMS, ROUNDS, SCALE
from spanloom.llm.centroids import SEED as CENTROID_SEED
from spanloom.llm.mixing import HASH_DIGITS
from spanloom.llm.sharding import LAW, MIX_FACTORS, MIX_SHIFTS, SEED, SHARDS, round_keys

# Host, path and verdict of the URL rules.
URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

EXACT_DEDUP = """
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AND tie = 1 AS kept, text_sha256
FROM (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256,
    max(doc_id) OVER (PARTITION BY sha256(coalesce(text, ''))) AS keep_id,
    count(*) OVER (PARTITION BY sha256(coalesce(text, ''))) AS group_size,
    row_number() OVER (PARTITION BY sha256(coalesce(text, '')), doc_id) AS tie
  FROM documents)
"""

# The capped sources are a prefix of the sources in the order of cap per weight.
SOURCE_MIXING = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size,
    CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, {HASH_DIGITS}) AS BIGINT) AS u
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, 3 * source_size AS cap,
    [5, 2, 1][CAST((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS weight
  FROM totals),
ordered AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0) AS remaining,
    sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weights
  FROM weighted
  WINDOW before AS (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
clamped AS (SELECT *, remaining * weight > cap * weights AS held FROM ordered),
level AS (
  SELECT sum(source_size) - coalesce(sum(cap) FILTER (held), 0) AS remaining,
    sum(weight) FILTER (NOT held) AS weights FROM clamped),
targets AS (
  SELECT c.source, c.source_size,
    CASE WHEN held THEN CAST(cap AS DOUBLE)
      ELSE CAST(CAST(c.weight * l.remaining AS BIGINT) AS DOUBLE) / CAST(l.weights AS DOUBLE) END AS target
  FROM clamped c, level l),
plan AS (
  SELECT *, CAST(floor(target / greatest(source_size, 1)) AS BIGINT) AS whole,
    target - CAST(floor(target / greatest(source_size, 1)) AS BIGINT) * source_size AS need
  FROM targets),
hashes AS (SELECT source, u, sum(size) AS size FROM sized GROUP BY source, u),
running AS (
  SELECT *, CAST(sum(size) OVER (PARTITION BY source ORDER BY u) AS BIGINT) AS through FROM hashes),
cuts AS (
  SELECT r.source, max(r.u) AS cut
  FROM running r JOIN plan p ON r.source IS NOT DISTINCT FROM p.source
  WHERE p.need > 0 AND through - size < need AND abs(through - need) <= abs(through - size - need)
  GROUP BY r.source)
SELECT s.doc_id, s.size, p.source_size, p.target,
  s.size * (p.whole + CASE WHEN s.u <= coalesce(c.cut, -1) THEN 1 ELSE 0 END) AS taken
FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source
LEFT JOIN cuts c ON s.source IS NOT DISTINCT FROM c.source
"""

_RULE_ROWS = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)

URL_FILTERS = f"""
WITH parsed AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
rules(rule_host, rule_path, rule_verdict) AS (VALUES {_RULE_ROWS}),
judged AS (
  SELECT p.*, r.*
  FROM parsed p LEFT JOIN rules r
    ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) = 1)
SELECT page_id, host, path, rule_host || rule_path AS rule, coalesce(rule_verdict, 'allow') AS verdict
FROM judged
"""

SUBSTRING_DEDUP = f"""
WITH words AS (
  SELECT doc_id, u.pos, u.word, count(*) OVER (PARTITION BY doc_id) AS n
  FROM (SELECT doc_id, {WORDS} AS w FROM documents) d, unnest(list_zip(range(1, len(w) + 1), w)) AS x(u0),
    LATERAL (SELECT u0[1] AS pos, u0[2] AS word) u),
windows AS (
  SELECT *, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING) AS w
  FROM words),
marked AS (
  SELECT *, pos + 34 <= n AND count(*) FILTER (pos + 34 <= n) OVER (PARTITION BY w) > 1 AS repeated FROM windows),
covered AS (
  SELECT *, bool_or(repeated) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
  FROM marked),
kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept_text
  FROM covered GROUP BY doc_id)
SELECT d.doc_id, CAST(len({WORDS}) AS BIGINT) AS n_words, coalesce(k.n_removed, 0) AS n_removed,
  sha256(coalesce(k.kept_text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)
"""

BYTE_DEDUP = """
WITH hexed AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
places AS (SELECT doc_id, h, unnest(range(0, len(h) // 2)) AS pos FROM hexed),
windows AS (
  SELECT doc_id, pos, substr(h, 2 * pos + 1, 2) AS byte,
    CASE WHEN 2 * pos + 100 <= len(h) THEN substr(h, 2 * pos + 1, 100) END AS w
  FROM places),
marked AS (
  SELECT doc_id, pos, byte,
    w IS NOT NULL AND min(doc_id) OVER (PARTITION BY w) < doc_id AS repeated
  FROM windows),
covered AS (
  SELECT *, bool_or(repeated) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM marked),
edges AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), false) AS opens FROM covered),
kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans,
    string_agg(byte, '' ORDER BY pos) FILTER (NOT gone) AS kept_hex
  FROM edges GROUP BY doc_id)
SELECT x.doc_id, CAST(len(x.h) // 2 AS BIGINT) AS n_bytes, coalesce(k.n_removed, 0) AS n_removed,
  coalesce(k.n_spans, 0) AS n_spans, sha256(unhex(coalesce(k.kept_hex, ''))) AS kept_sha256
FROM hexed x LEFT JOIN kept k USING (doc_id)
"""

JACCARD_JOIN = """
WITH RECURSIVE lowered AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) END AS shingles
  FROM lowered),
tokens AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS token FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id <> b.doc_id
    AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reached(x, y) AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(min(r.y), s.doc_id)) AS component_id
FROM sets s LEFT JOIN reached r ON s.doc_id = r.x
GROUP BY s.doc_id, s.shingles
"""



def _crc_step(value: int) -> int:
    """A CRC-32 register after one more zero byte."""
    for _ in range(8):
        value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
    return value


def _linear(value: str, images: list[int]) -> str:
    """The linear map of 32 bits that sends bit ``k`` to ``images[k]``."""
    found = "CAST(0 AS UBIGINT)"
    for k, image in enumerate(images):
        found = f"xor({found}, (({value} >> {k}) & 1) * {image})"
    return found


def _crc(source: str, levels: int) -> str:
    """``(i, crc)`` of the rows ``(i, text)`` of ``source`` with texts below ``2 ** levels`` bytes.

    A register is linear in the bytes: a byte ``d`` places before the end adds its own register after
    ``d`` zero bytes. Bytes are added up in pairs, pairs of pairs and so on from the end, where the
    farther half passes as many zero bytes as the nearer one has.
    """
    images = [_crc_step(1 << k) for k in range(32)]
    rows = f"""
      SELECT i, n - k AS d, {_linear("CAST('0x' || o AS UBIGINT)", images)} AS v
      FROM (SELECT i, len(octets) AS n, unnest(octets) AS o, generate_subscripts(octets, 1) AS k
        FROM (SELECT i, regexp_extract_all(hex(encode(text)), '..') AS octets FROM {source}))
      UNION ALL
      SELECT i, octet_length(encode(text)) AS d, CAST(4294967295 AS UBIGINT) AS v FROM {source}"""
    for _ in range(levels):
        rows = f"""SELECT i, d // 2 AS d, bit_xor(CASE WHEN d % 2 = 0 THEN v ELSE {_linear("v", images)} END) AS v
      FROM ({rows}) GROUP BY i, d // 2"""
        doubled = []
        for image in images:
            bits = [images[k] for k in range(32) if image >> k & 1]
            value = 0
            for bit in bits:
                value ^= bit
            doubled.append(value)
        images = doubled
    return f"SELECT i, CAST(xor(v, 4294967295) AS BIGINT) AS crc FROM ({rows})"


def _mixed(half: str, key: int) -> str:
    """The 32-bit mix of ``half`` and a key, as nested lists of one value so that each is named once."""
    value = f"[CAST(({half} + {key}) % 4294967296 AS UBIGINT)]"
    for shift, factor in zip(MIX_SHIFTS, (*MIX_FACTORS, None)):
        value = f"[xor(v, v >> {shift}) FOR v IN {value}]"
        if factor is not None:
            value = f"[(v * {factor}) % 4294967296 FOR v IN {value}]"
    return f"{value}[1]"


def _network(source: str) -> str:
    """One pass of the Feistel network over the columns ``n, bits, p`` of ``source``."""
    rows = f"""SELECT * EXCLUDE (p), p >> bits AS l, p & ((CAST(1 AS UBIGINT) << bits) - 1) AS r
      FROM ({source})"""
    for key in round_keys(SEED):
        mixed = f"{_mixed('r', key)} & ((CAST(1 AS UBIGINT) << bits) - 1)"
        rows = f"SELECT * EXCLUDE (l, r), r AS l, xor(l, {mixed}) AS r FROM ({rows})"
    return f"SELECT i, n, bits, (l << bits) | r AS p FROM ({rows})"


SHARDING = f"""
WITH RECURSIVE numbered AS (
  SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 8 AS BIGINT) AS size, coalesce(text, '') AS text,
    CAST(row_number() OVER (ORDER BY doc_id NULLS FIRST, text) - 1 AS UBIGINT) AS i,
    CAST(count(*) OVER () AS UBIGINT) AS n
  FROM documents),
started AS (
  SELECT i, n, CAST(greatest(1, ceil(floor(log2(greatest(n - 1, 1)) + 1) / 2)) AS UBIGINT) AS bits, i AS p FROM numbered),
walked AS (
  {_network("SELECT * FROM started")}
  UNION ALL
  {_network("SELECT * FROM walked WHERE p >= n")}),
checked AS ({_crc("numbered", 24)})
SELECT doc_id, size, crc AS text_crc32, '{LAW}' AS law, CAST(p % {SHARDS} AS INTEGER) AS shard,
  CAST(p // {SHARDS} AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM numbered JOIN walked USING (i) JOIN checked USING (i)
WHERE p < walked.n
"""


def _lloyd_rounds() -> str:
    """The assignment and centroids of every round, as common table expressions."""
    steps = ""
    for r in range(ROUNDS + 1):
        steps += f"""
a{r} AS (
  SELECT vec_id, arg_min(cluster, [distance, cluster]) AS cluster, min(distance) AS distance
  FROM (SELECT e.vec_id, c.cluster, CAST(sum((e.x - c.x) * (e.x - c.x)) AS BIGINT) AS distance
    FROM parts e JOIN c{r} c USING (dim) GROUP BY e.vec_id, c.cluster)
  GROUP BY vec_id),"""
        if r < ROUNDS:
            steps += f"""
c{r + 1} AS (
  SELECT c.cluster, c.dim, coalesce(m.x, c.x) AS x
  FROM c{r} c LEFT JOIN (
    SELECT cluster, dim, CAST((s - (s % n + n) % n) // n AS BIGINT) AS x
    FROM (SELECT a.cluster, e.dim, sum(e.x) AS s, count(*) AS n FROM parts e JOIN a{r} a USING (vec_id) GROUP BY a.cluster, e.dim)) m
  USING (cluster, dim)),"""
    return steps


CENTROIDS = f"""
WITH kept AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMS}),
parts AS (
  SELECT vec_id, generate_subscripts(embedding, 1) AS dim,
    CAST(floor({SCALE} * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x
  FROM kept),
seeds AS (
  SELECT vec_id, CAST(row_number() OVER (ORDER BY sha256('{CENTROID_SEED}:' || vec_id)) - 1 AS INTEGER) AS cluster FROM kept),
c0 AS (SELECT s.cluster, p.dim, p.x FROM parts p JOIN seeds s USING (vec_id) WHERE s.cluster < {CLUSTERS}),{_lloyd_rounds()}
digests AS (
  SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY dim)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY cluster)
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{ROUNDS} JOIN digests USING (cluster)
"""


def _ext(value: str, cost: str, letters: str) -> str:
    """``value``, eight digits of cost and an audit, after edits; null stays null."""
    total = f"CAST(CAST(left({value}, 8) AS INTEGER) + {cost} AS VARCHAR)"
    return f"lpad({total}, 8, '0') || substr({value}, 9) || '{letters}'"


# Least values of the four states once rows may be inserted: nothing yet, after s, after u, after a.
_INSERTED = f"""
  v0 AS c0, v1 AS c1,
  least(v2, {_ext("v0", "3", "I")}, {_ext("v1", "3", "I")}, {_ext("v3", "3", "I")}) AS c2,
  least(v3, {_ext("v2", "3", "I")}, {_ext("v0", "6", "II")}, {_ext("v1", "6", "II")}) AS c3"""


def _read(state: int, initial: str, before: tuple[int, ...], written: bool) -> str:
    """The least value of a state after one more row."""
    ways = [_ext(f"c{state}", "4", "D")]
    for b in before:
        ways.append(f"CASE WHEN may AND c = '{initial}' THEN {_ext(f'c{b}', 'late', 'K')} END")
        if written:
            ways.append(f"CASE WHEN may THEN {_ext(f'c{b}', '3 + late', 'R')} END")
    return f"least({', '.join(ways)}, NULL) AS v{state}"


CONVERSATIONS = f"""
WITH RECURSIVE keyed AS MATERIALIZED (
  SELECT row_number() OVER () AS i, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS body,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS text
  FROM conversations),
acted AS MATERIALIZED (
  SELECT conv_id, turn, crc % 20 AS act, CASE WHEN crc % 20 = 4 THEN 'user' ELSE role END AS role,
    CASE crc % 20 WHEN 1 THEN '' WHEN 2 THEN regexp_replace(body, '[.!?]', '', 'g') ELSE body END AS text
  FROM keyed JOIN ({_crc("keyed", 6)}) crcs USING (i)),
numbered AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, left(role, 1) AS c
  FROM (SELECT * FROM acted WHERE act <> 0 UNION ALL SELECT * FROM acted WHERE act = 3)),
faulty AS MATERIALIZED (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' ELSE 'none' END AS fault,
    c || lead(c) OVER (PARTITION BY conv_id ORDER BY i) AS pair
  FROM numbered),
symbols AS MATERIALIZED (
  SELECT conv_id, i, c, fault NOT IN ('blank', 'duplicate') AS may, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS late
  FROM faulty),
walked(conv_id, i, v0, v1, v2, v3) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), '00000000', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)
  FROM keyed
  UNION ALL
  SELECT conv_id, i + 1, {_read(0, "-", (), False)}, {_read(1, "s", (0,), False)}, {_read(2, "u", (0, 1, 3), True)},
    {_read(3, "a", (2,), True)}
  FROM (SELECT conv_id, i, {_INSERTED} FROM walked) w
  JOIN (SELECT conv_id, i - 1 AS i, c, may, late FROM symbols) s USING (conv_id, i)),
counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id),
solved AS MATERIALIZED (
  SELECT conv_id, CAST(left(best, 8) AS BIGINT) AS cost, substr(best, 9) AS audit
  FROM (SELECT w.conv_id, least(c0, c3) AS best
    FROM (SELECT conv_id, i, {_INSERTED} FROM walked) w LEFT JOIN counted USING (conv_id)
    WHERE w.i = coalesce(n, 0))),
letters AS (
  SELECT conv_id, j, letter, count(*) FILTER (letter <> 'I') OVER upto AS i, count(*) FILTER (letter <> 'D') OVER upto AS place
  FROM (SELECT conv_id, j, substr(audit, CAST(j AS BIGINT), 1) AS letter FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS j FROM solved))
  WINDOW upto AS (PARTITION BY conv_id ORDER BY j ROWS UNBOUNDED PRECEDING)),
edited AS (
  SELECT l.conv_id, j, letter, place, role, text,
    coalesce(max(CASE WHEN place = 1 AND letter = 'K' AND c = 's' THEN 1 END) OVER (PARTITION BY l.conv_id), 0) AS system
  FROM letters l LEFT JOIN faulty f ON f.conv_id = l.conv_id AND f.i = l.i AND letter <> 'I'
  WHERE letter <> 'D'),
repaired AS (
  SELECT conv_id, string_agg(
    CASE WHEN letter = 'K' THEN role WHEN (place - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''),
    chr(10) ORDER BY j) AS whole
  FROM edited GROUP BY conv_id)
SELECT s.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM solved s LEFT JOIN counted USING (conv_id) LEFT JOIN repaired USING (conv_id)
"""

SQL = {
    "op1_substring_dedup": SUBSTRING_DEDUP,
    "op2_exact_dedup": EXACT_DEDUP,
    "op4_ngram_jaccard_join": JACCARD_JOIN,
    "op5_source_mixing": SOURCE_MIXING,
    "op6_suffix_array_dedup": BYTE_DEDUP,
    "op10_url_filters": URL_FILTERS,
    "op11_centroid_clustering": CENTROIDS,
    "op12_conversation_repair": CONVERSATIONS,
    "op13_sharding": SHARDING,
}
