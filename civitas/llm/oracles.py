"""DuckDB SQL of the queries that SQL can express."""

#: Unsigned CRC-32 of a text of ASCII characters, bit by bit.
CRC32 = """xor(4294967295, list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))))"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0}::VARCHAR END"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "{0}", "text")) + ")"

MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_LEAF.format("n_chars")} AS leaf,
    {_LEAF.format("(n_chars + 1)")} AS changed, {CRC32.format("doc_id::VARCHAR")} % 7 = 0 AS tampered,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n
  FROM documents),
tree AS (
  SELECT lang, 0 AS lvl, idx, n, leaf AS h FROM leaves
  UNION ALL
  SELECT lang, lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx))
  FROM tree WHERE n > 1 GROUP BY lang, lvl, idx // 2, n),
subroots AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
  FROM tree WHERE n = 1),
top AS (
  SELECT 0 AS lvl, idx, n, subroot AS h FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx))
  FROM top WHERE n > 1 GROUP BY lvl, idx // 2, n),
steps AS (
  SELECT l.doc_id, own.lvl, own.idx, other.h FROM leaves l
  JOIN tree own ON own.lang IS NOT DISTINCT FROM l.lang AND own.n > 1 AND own.idx = l.idx >> own.lvl
  LEFT JOIN tree other ON other.lang IS NOT DISTINCT FROM own.lang AND other.lvl = own.lvl AND other.idx = xor(own.idx, 1)
  UNION ALL
  SELECT l.doc_id, 1000 + own.lvl, own.idx, other.h FROM leaves l
  JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
  JOIN top own ON own.n > 1 AND own.idx = s.idx >> own.lvl
  LEFT JOIN top other ON other.lvl = own.lvl AND other.idx = xor(own.idx, 1)),
proofs AS (
  SELECT doc_id, coalesce(string_agg(h, '' ORDER BY lvl), '') AS siblings,
    list(CASE WHEN h IS NULL THEN '-' WHEN idx % 2 = 1 THEN 'L' || h ELSE 'R' || h END ORDER BY lvl) AS path
  FROM steps GROUP BY doc_id),
folds AS (
  SELECT l.doc_id, l.leaf, s.subroot, (SELECT h FROM top WHERE n = 1) AS root, sha256(coalesce(p.siblings, '')) AS proof_sha256,
    list_reduce(list_prepend(CASE WHEN l.tampered THEN l.changed ELSE l.leaf END, coalesce(p.path, [])), lambda below, step:
      sha256(CASE step[1] WHEN 'L' THEN step[2:] || below WHEN 'R' THEN below || step[2:] ELSE below END)) AS folded_root
  FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang LEFT JOIN proofs p ON p.doc_id = l.doc_id)
SELECT *, folded_root = root AS verified FROM folds"""


#: States: 0 nothing, 1 system, 2 user, 3 assistant; ``b`` best (cost, audit)
#: without an insertion first, ``v`` with.
_AHEAD = {0: 2, 1: 2, 2: 3, 3: 2}


def _best(s: int) -> str:
    fit = {0: "CASE r.kind WHEN 's' THEN t.v1 WHEN 'u' THEN t.v2 END", 1: "CASE r.kind WHEN 'u' THEN t.v2 END",
           2: "CASE r.kind WHEN 'a' THEN t.v3 END", 3: "CASE r.kind WHEN 'u' THEN t.v2 END"}[s]
    after = f"t.v{_AHEAD[s]}"
    return f"""list_min([{{'c': t.v{s}.c + 3, 'a': 'D' || t.v{s}.a}},
      CASE WHEN r.fault NOT IN (1, 2) AND ({fit}) IS NOT NULL THEN
        {{'c': ({fit}).c + (r.fault = 3)::INT, 'a': 'K' || ({fit}).a}} END,
      CASE WHEN r.fault NOT IN (1, 2) THEN {{'c': {after}.c + 2 + (r.fault = 3)::INT, 'a': 'R' || {after}.a}} END])"""


def _inserted(s: int) -> str:
    one = _AHEAD[s]
    two = _AHEAD[one]
    return f"""list_min([b{s}, {{'c': b{one}.c + 2, 'a': 'I' || b{one}.a}}, {{'c': b{two}.c + 4, 'a': 'II' || b{two}.a}}])"""


CONVERSATIONS = f"""
WITH RECURSIVE faulty AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {CRC32.format("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS kind
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM faulty WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER w - 1 AS i, left(role, 1) AS kind, lag(left(role, 1)) OVER w || left(role, 1) AS pair,
    count(*) OVER (PARTITION BY conv_id) AS n, right(rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '), 1) AS final,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
rows_ AS (
  SELECT *, CASE WHEN final = '' THEN 1 WHEN nth > 1 THEN 2 WHEN final NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM placed),
costs AS (
  SELECT conv_id, n AS i, {{'c': 0, 'a': ''}} AS v0, {{'c': 4, 'a': 'II'}} AS v1, {{'c': 2, 'a': 'I'}} AS v2, {{'c': 0, 'a': ''}} AS v3
  FROM rows_ GROUP BY conv_id, n
  UNION ALL
  SELECT conv_id, i, {', '.join(_inserted(s) for s in range(4))} FROM (
    SELECT t.conv_id, r.i, {', '.join(_best(s) + f' AS b{s}' for s in range(4))}
    FROM costs t JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM t.conv_id AND r.i = t.i - 1)),
plans AS (SELECT conv_id, v0.c AS cost, v0.a AS audit FROM costs WHERE i = 0),
edits AS (
  SELECT conv_id, p, audit[p] AS edit, p - 1 - (length(audit[:p - 1]) - length(replace(audit[:p - 1], 'I', ''))) AS i
  FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS p FROM plans)),
written AS (
  SELECT e.conv_id, e.edit, r.role, CASE e.edit WHEN 'I' THEN '' ELSE r.text END AS text, r.kind,
    row_number() OVER (PARTITION BY e.conv_id ORDER BY p) AS line
  FROM edits e LEFT JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM e.conv_id AND r.i = e.i AND e.edit <> 'I' WHERE e.edit <> 'D'),
lines AS (
  SELECT *, line - max((line = 1 AND edit = 'K' AND kind = 's')::INT) OVER (PARTITION BY conv_id) AS place FROM written),
digests AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN place % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
    chr(10) ORDER BY line)) AS digest FROM lines GROUP BY conv_id),
sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
    count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows_ GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN plans p ON p.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN digests d ON d.conv_id IS NOT DISTINCT FROM o.conv_id"""
