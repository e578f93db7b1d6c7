"""SQL twins of the queries of this package, for DuckDB."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op2_quality_rule_ledger"] = r"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM words WHERE len(w) >= 3
), counted AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM windows
), repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM counted WHERE n > 1) GROUP BY doc_id
), measured AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    len(lines) AS n_lines,
    len(list_filter(w, lambda x: strlen(x) > 1 AND regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS n_shouted
  FROM words LEFT JOIN repeated USING (doc_id)
), ledger AS (
  SELECT *, (
    CASE WHEN n_words < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN n_words > 0 AND 100 * n_symbols > 30 * n_words THEN 4 ELSE 0 END
    + CASE WHEN n_lines > 0 AND 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN n_words > 0 AND word_chars > 20 * n_words THEN 16 ELSE 0 END
    + CASE WHEN n_words > 0 AND word_chars < 2 * n_words THEN 32 ELSE 0 END
    + CASE WHEN n_words > 0 AND 100 * n_shouted > 60 * n_words THEN 64 ELSE 0 END)::BIGINT AS failed_bits
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  failed_bits & 3 <> 0 AS base_failed, failed_bits = 0 AS kept, failed_bits
FROM ledger
"""

ORACLES["op1_warc_revisits"] = r"""
WITH hashed AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages
), digested AS (
  SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + ((('0x' || substr(h, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))::BIGINT) & 31)::BIGINT, 1)), '')
      AS payload_digest
  FROM hashed
), counted AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS original FROM digested
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id < original THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < original THEN original END AS refers_to
FROM counted
"""

ORACLES["op8_hyperminhash_dedup"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3)
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM words WHERE len(w) IN (1, 2)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), linked AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_have
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN sizes m ON m.doc_id = a JOIN sizes n ON n.doc_id = b
  WHERE 100 * both_have >= 85 * (m.n + n.n - both_have)
), reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reached r JOIN linked l ON r.b = l.a
)
SELECT a AS doc_id, coalesce(max(n), 0)::BIGINT AS n_shingles, min(b) AS component_id, min(b) = a AS kept
FROM reached LEFT JOIN sizes ON doc_id = a GROUP BY a
"""

# Kind, pattern, group whose length counts, least length.
_SECRETS = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
    ("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", 0, 1),
    ("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    ("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
]


def _secrets() -> str:
    kinds = " UNION ALL ".join(
        f"""SELECT doc_id, {k} AS k, '{name}' AS kind, {least} AS least, regexp_extract_all(t, {pattern}, 0) AS m,
          regexp_extract_all(t, {pattern}, {group}) AS v, string_split_regex(t, {pattern}) AS gaps FROM texts"""
        for k, (name, pattern, group, least) in enumerate(
            (n, "'" + p.replace("'", "''") + "'", g, x) for n, p, g, x in _SECRETS
        )
    )
    until = "list_sum(list_transform({0}[1:i], lambda x: length(x)))"
    counts = ", ".join(f"count(*) FILTER (k = {k}) AS n_{name}" for k, (name, *_) in enumerate(_SECRETS[:3]))
    zeros = ", ".join(f"coalesce(n_{name}, 0)::BIGINT AS n_{name}" for name, *_ in _SECRETS[:3])
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents
), found AS (
  SELECT *, unnest(range(1, len(m) + 1)) AS i FROM ({kinds}) WHERE len(m) > 0
), spans AS (
  SELECT doc_id, k, kind, ({until.format('gaps')} + {until.format('m')})::BIGINT AS stop, stop - length(m[i]) AS start
  FROM found WHERE length(v[i]) >= least
), per AS (
  SELECT doc_id, {counts}, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) FILTER (k < 3) AS base,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) AS spans
  FROM spans GROUP BY doc_id
)
SELECT doc_id, {zeros}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN per USING (doc_id)
"""


ORACLES["op6_blob_ledger_secrets"] = _secrets()

# CRC-32 of "conv_id:turn", bit by bit; ids and turns are ASCII.
CRC = r"""xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({text}, ''),
    lambda c: list_transform(range(8), lambda i: ((ascii(c) >> i::INTEGER) & 1)::BIGINT)))),
    lambda crc, bit: CASE WHEN xor(crc, bit) & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END), 4294967295)"""

ORACLES["op11_audited_repair"] = (
    r"""
WITH RECURSIVE moves(p, initial, letters, q, cost, inserted, role) AS (VALUES
  (0, '*', 'D', 0, 3, []::VARCHAR[], ''), (1, '*', 'D', 1, 3, [], ''), (2, '*', 'D', 2, 3, [], ''), (3, '*', 'D', 3, 3, [], ''),
  (0, 's', 'K', 1, 0, [], ''), (0, 'u', 'K', 2, 0, [], ''), (1, 'u', 'K', 2, 0, [], ''), (2, 'a', 'K', 3, 0, [], ''),
  (3, 'u', 'K', 2, 0, [], ''), (0, 'a', 'IK', 3, 2, ['user:'], ''), (1, 'a', 'IK', 3, 2, ['user:'], ''),
  (2, 'u', 'IK', 2, 2, ['assistant:'], ''), (3, 'a', 'IK', 3, 2, ['user:'], ''),
  (0, '*', 'R', 2, 2, [], 'user'), (1, '*', 'R', 2, 2, [], 'user'), (2, '*', 'R', 3, 2, [], 'assistant'),
  (3, '*', 'R', 2, 2, [], 'user'), (0, '*', 'IR', 3, 4, ['user:'], 'assistant'), (1, '*', 'IR', 3, 4, ['user:'], 'assistant'),
  (2, '*', 'IR', 2, 4, ['assistant:'], 'user'), (3, '*', 'IR', 3, 4, ['user:'], 'assistant')
), closing(q, letters, cost, inserted) AS (VALUES
  (0, '', 0, []::VARCHAR[]), (1, 'II', 4, ['user:', 'assistant:']), (2, 'I', 2, ['assistant:']), (3, '', 0, [])
), given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    """
    + CRC.format(text="coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")
    + r""" % 20 AS fault
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    role AS old_role, text AS old_text, unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM given WHERE fault <> 0
), numbered AS (
  SELECT *, left(role, 1) AS initial,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, old_role, old_text, copy) AS n
  FROM damaged
), seen AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS cut,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY n) || initial AS pair
  FROM numbered
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE NOT blank AND again) AS duplicate,
    count(*) FILTER (WHERE NOT blank AND NOT again AND cut) AS truncated,
    count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM seen GROUP BY conv_id
), paths AS (
  SELECT conv_id, 0::BIGINT AS n, 0 AS q, {'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]} AS best
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, n, q, min(best) FROM (
    SELECT paths.conv_id, seen.n, moves.q, {
      'cost': best.cost + moves.cost + CASE WHEN letters <> 'D' AND cut THEN 1 ELSE 0 END,
      'audit': best.audit || letters,
      'lines': list_concat(best.lines, inserted, CASE WHEN letters = 'D' THEN []
        ELSE [(CASE WHEN moves.role = '' THEN seen.role ELSE moves.role END) || ':' || text] END)} AS best
    FROM paths JOIN seen ON paths.conv_id IS NOT DISTINCT FROM seen.conv_id AND seen.n = paths.n + 1
    JOIN moves ON moves.p = paths.q AND (moves.initial = '*' OR moves.initial = seen.initial)
      AND (letters = 'D' OR NOT (blank OR again))
  ) GROUP BY conv_id, n, q
), ended AS (
  SELECT conv_id, min({'cost': best.cost + closing.cost, 'audit': best.audit || letters,
    'lines': list_concat(best.lines, inserted)}) AS best
  FROM paths JOIN closing USING (q)
  WHERE n = (SELECT count(*) FROM seen WHERE seen.conv_id IS NOT DISTINCT FROM paths.conv_id) GROUP BY conv_id
)
SELECT ended.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.cost AS cost, best.audit AS audit,
  sha256(array_to_string(best.lines, chr(10))) AS repaired_sha256
FROM ended LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM ended.conv_id
"""
)

ORACLES["op13_prefix_trie"] = (
    r"""
WITH numbered AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
    {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS t
  FROM conversations WHERE conv_id IS NOT NULL
), conv AS (
  SELECT c, list(t ORDER BY pos) AS own, c - ((c % 5) + 5) % 5 AS base, """
    + CRC.format(text="c::VARCHAR")
    + r""" % 9 AS h
  FROM numbered GROUP BY c
), rebuilt AS (
  SELECT conv.c, CASE WHEN conv.c = conv.base THEN conv.own
    ELSE list_concat(coalesce(b.own[1:conv.h], []), conv.own[conv.h + 1:]) END AS seq
  FROM conv LEFT JOIN conv b ON b.c = conv.base
), through AS (
  SELECT c, unnest(range(0, len(seq) + 1)) AS depth, seq FROM rebuilt
), nodes AS (
  SELECT depth, seq[1:depth] AS path, min(c) AS c, count(*) AS n_convs,
    coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE len(seq) = depth), '') AS ends
  FROM through GROUP BY depth, seq[1:depth]
), named AS (
  SELECT *, row_number() OVER () AS id FROM nodes
), related AS (
  SELECT v.id, v.depth, v.c, v.n_convs, v.ends, p.c AS parent_c, p.id AS parent_id,
    CASE WHEN v.depth = 0 THEN 0 ELSE (v.n_convs - 1) * strlen(v.path[v.depth].text) END AS saved
  FROM named v LEFT JOIN named p ON p.depth = v.depth - 1 AND p.path = v.path[1:v.depth - 1]
), counted AS (
  SELECT related.*, coalesce(n_children, 0) AS n_children
  FROM related LEFT JOIN (SELECT parent_id AS id, count(*) AS n_children FROM related GROUP BY parent_id) USING (id)
), above AS (
  SELECT a.id, v.saved, (v.n_children = 0)::BIGINT AS leaf
  FROM counted v JOIN named n ON n.id = v.id JOIN named a ON a.depth <= n.depth AND a.path = n.path[1:a.depth]
)
SELECT c AS conv_id, depth, parent_c AS parent_conv_id, n_convs, n_children, sum(leaf)::BIGINT AS n_leaves,
  sum(above.saved)::BIGINT AS saved_tokens, sha256(ends) AS ends_sha256
FROM counted JOIN above USING (id) GROUP BY id, c, depth, parent_c, n_convs, n_children, ends
"""
)


def llm_oracles() -> dict[str, str]:
    return dict(ORACLES)
