"""The training-data queries in SQL, where SQL can express them."""

from __future__ import annotations

# Fixed values of the line key: what SQL strips from a line's ends.
_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
# A-Z only; lower() would change other letters too.
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = r"""
WITH RECURSIVE source AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), texts AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS raw,
         regexp_replace(coalesce(text, ''), '([<\[])(\\*(/?s>|\|>|/?INST\]|/?SYS\]))', '\1\\\2', 'g') AS text
  FROM source
), turns AS (
  SELECT *, CAST(ceil(length(text) / 4.0) AS BIGINT) + 3 AS tokens, length(role) + length(text) + 10 AS chars,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(raw, 256), md5(raw)) AS i
  FROM texts
), sums AS (
  SELECT *, sum(tokens) OVER (PARTITION BY conv_id ORDER BY i) AS past,
         i = 1 AND role = 'system' AS is_system FROM turns
), fixed AS (
  SELECT conv_id, coalesce(sum(tokens) FILTER (is_system), 0) AS tokens,
         coalesce(sum(chars) FILTER (is_system), 0) AS chars FROM sums GROUP BY conv_id
), opened AS (
  SELECT s.conv_id, s.i, any_value(s.past) AS past, any_value(s.tokens) AS tokens,
         coalesce(sum(t.tokens), 0) AS repeated,
         any_value(f.tokens) AS fixed_tokens, any_value(f.chars) + coalesce(sum(t.chars), 0) AS repeated_chars
  FROM sums s JOIN fixed f ON s.conv_id = f.conv_id
  LEFT JOIN sums t ON t.conv_id = s.conv_id AND t.i < s.i AND NOT t.is_system
    AND s.past - s.tokens - t.past + t.tokens <= greatest(0, least(128, 512 - f.tokens - s.tokens))
  GROUP BY s.conv_id, s.i
), walk AS (
  SELECT conv_id, i, greatest(past, 512) AS most, 0 AS extra FROM opened WHERE i = 1
  UNION ALL
  SELECT o.conv_id, o.i,
         CASE WHEN o.past > w.most THEN greatest(o.past, o.past - o.tokens + 512 - o.fixed_tokens - o.repeated)
              ELSE w.most END,
         CASE WHEN o.past > w.most THEN o.repeated_chars ELSE 0 END
  FROM walk w JOIN opened o ON o.conv_id = w.conv_id AND o.i = w.i + 1
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || raw || chr(10), '' ORDER BY i)) AS turns_sha256,
       CAST(coalesce(sum(length(raw)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(raw, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars + extra) AS BIGINT) AS formatted_chars
FROM sums JOIN walk USING (conv_id, i) GROUP BY conv_id
"""

OP2 = f"""
WITH lines AS (
  SELECT d, doc_id, i, list_extract(parts, i) AS line
  FROM (SELECT row_number() OVER () AS d, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
       LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS i)
), keyed AS (
  SELECT *, {_LOWER.format(f"trim(line, {_WHITE})")} AS key FROM lines
), frequent AS (
  SELECT key, max(doc_id) AS owner FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT d) >= 5
), marked AS (
  SELECT d, k.doc_id, i, line, owner IS NOT NULL AND owner <> k.doc_id AS gone
  FROM keyed k LEFT JOIN frequent f ON k.key = f.key
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY d
"""

OP6 = f"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")},
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")},
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(13, len(ws)) AS n, array_to_string(ws[i:i + least(13, len(ws)) - 1], ' ') AS w
  FROM item_words, LATERAL (SELECT unnest(range(1, greatest(1, len(ws) - 12) + 1)) AS i)
  WHERE len(ws) > 0
), lengths AS (SELECT DISTINCT n FROM windows
), places AS (
  SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS w
  FROM doc_words, lengths, LATERAL (SELECT unnest(range(1, len(ws) - n + 2)) AS i)
), found AS (
  SELECT p.doc_id, p.i, p.n, w.item_id FROM places p JOIN windows w ON p.n = w.n AND p.w = w.w
), hits AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM found, LATERAL (SELECT unnest(range(i, i + n)) AS pos) GROUP BY doc_id
), ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM doc_words d LEFT JOIN hits USING (doc_id) LEFT JOIN ids USING (doc_id)
"""

# Base32 of SHA-1: each five hexadecimal digits are four characters.
OP8 = """
WITH hashed AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
), digests AS (
  SELECT page_id, payload, array_to_string(list_transform(range(0, 32), lambda k:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
      (CAST('0x' || substr(hex, CAST(5 * (k // 4) + 1 AS INT), 5) AS BIGINT) >> (15 - 5 * (k % 4))) & 31 AS INT), 1)), '') AS digest
  FROM hashed
), firsts AS (SELECT payload, min(page_id) AS first FROM digests GROUP BY payload)
SELECT page_id, CAST(strlen(d.payload) AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM digests d JOIN firsts f ON d.payload = f.payload
"""

OP10 = f"""
WITH texts AS (SELECT doc_id, {_LOWER.format("coalesce(text, '')")} AS t FROM documents
), groups AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM texts JOIN groups USING (t)
"""



def _way(before: str, cost: str, letter: str) -> str:
    """A way (twelve digits of cost, then letters) with one more edit."""
    return f"printf('%012d', CAST(left({before}, 12) AS BIGINT) + {cost}) || substr({before}, 13) || '{letter}'"


# The cheapest ways to each state, turn by turn: v0 nothing yet, v1 after s, v2 after u, v3 after a.
# least() of twelve digits and letters takes the cheapest, then the least letters; it skips nulls.
_PUT_U = f"least(v2, {_way('v0', '5', 'I')}, {_way('v1', '5', 'I')}, {_way('v3', '5', 'I')})"
_TWO_PUT = _way("{0}", "10", "II")
OP11 = f"""
WITH RECURSIVE source AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                        lambda c: CAST(ascii(c) AS BIGINT)) AS codes
  FROM conversations
), cased AS (
  SELECT conv_id, turn, role, text, xor(CAST(4294967295 AS BIGINT), list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), codes), lambda crc, code: list_reduce(
      list_prepend(xor(crc, code), range(8)), lambda x, n: xor(x >> 1, 3988292384 * (x & 1))))) % 20 AS fault
  FROM source
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE fault WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM cased
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
         rtrim(text, {_WHITE}) AS trimmed, left(role, 1) AS k
  FROM damaged
), repeated AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         lag(k) OVER (PARTITION BY conv_id ORDER BY i) || k AS met
  FROM numbered
), faults AS (
  SELECT *, trimmed = '' AS blank, trimmed <> '' AND again AS duplicate,
         trimmed <> '' AND NOT again AND right(trimmed, 1) NOT IN ('.', '!', '?') AS truncated
  FROM repeated
), sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
         count(*) FILTER (truncated) AS truncated,
         count(*) FILTER (met NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM faults GROUP BY conv_id
), moves AS (
  SELECT conv_id, i, k, CASE WHEN blank OR duplicate THEN NULL WHEN truncated THEN 5 ELSE 0 END AS kept FROM faults
), walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, printf('%012d', 0) AS v0, CAST(NULL AS VARCHAR) AS v1,
         CAST(NULL AS VARCHAR) AS v2, CAST(NULL AS VARCHAR) AS v3 FROM sums
  UNION ALL
  SELECT conv_id, i,
    {_way('v0', '2', 'D')},
    least({_way('v1', '2', 'D')}, CASE WHEN k = 's' THEN {_way('v0', 'kept', 'K')} END),
    least({_way('v2', '2', 'D')},
      CASE WHEN k = 'u' THEN {_way('least(v0, v1, v3)', 'kept', 'K')} ELSE {_way('least(v0, v1, v3)', 'kept + 1', 'R')} END),
    least({_way('v3', '2', 'D')},
      CASE WHEN k = 'a' THEN {_way('v2', 'kept', 'K')} ELSE {_way('v2', 'kept + 1', 'R')} END)
  FROM (
    SELECT m.conv_id, m.i, k, kept, v0, v1, u AS v2, least(v3, {_way('u', '5', 'I')}) AS v3
    FROM (SELECT *, {_PUT_U} AS u FROM walk) w
    JOIN moves m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.i = w.i + 1
  )
), ends AS (
  SELECT conv_id, CAST(left(best, 12) AS BIGINT) AS cost, substr(best, 13) AS audit FROM (
    SELECT s.conv_id, least(v0, v3, {_TWO_PUT.format('v0')},
      {_TWO_PUT.format('v1')}, {_way('v2', '5', 'I')}) AS best
    FROM walk w JOIN sums s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.n = w.i)
), letters AS (
  SELECT conv_id, p, audit[p] AS letter, length(replace(audit[1:p], 'I', '')) AS i,
         length(replace(audit[1:p], 'D', '')) AS place, length(replace(audit, 'D', '')) AS places
  FROM ends, LATERAL (SELECT unnest(range(1, length(audit) + 1)) AS p)
), lines AS (
  SELECT l.conv_id, p, CASE WHEN letter = 'K' THEN f.role
           WHEN (places - place) % 2 = 0 THEN 'assistant' ELSE 'user' END || ':'
         || CASE WHEN letter = 'I' THEN '' ELSE f.text END AS line
  FROM letters l LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.i = l.i AND letter <> 'I'
  WHERE letter <> 'D'
), digests AS (
  SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY p)) AS repaired_sha256 FROM lines GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
       coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN digests d ON d.conv_id IS NOT DISTINCT FROM c.conv_id
"""

_TERMS = "unnest(regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + ", '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))"
OP12 = f"""
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, text FROM documents
), asked AS (SELECT row_number() OVER () AS q, item_id, text FROM benchmark
), tfs AS (SELECT d, t, count(*) AS tf FROM (SELECT d, {_TERMS} AS t FROM docs) GROUP BY d, t
), lengths AS (SELECT d, CAST(sum(tf) AS BIGINT) AS n FROM tfs GROUP BY d
), totals AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM lengths
), norms AS (SELECT d, 100 - 25 + (25 * n * nn) // ll AS m FROM lengths, totals
), weights AS (
  SELECT t, CAST(floor(1000 * ln(CAST(2 * any_value(nn) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tfs, totals GROUP BY t
), terms AS (SELECT q, t, count(*) AS times FROM (SELECT q, {_TERMS} AS t FROM asked) GROUP BY q, t
), scores AS (
  SELECT q, d, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM terms JOIN tfs USING (t) JOIN weights USING (t) JOIN norms USING (d) GROUP BY q, d
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scores JOIN docs USING (d) JOIN asked USING (q) WHERE score > 0
) WHERE rank <= 20
"""

ORACLE: dict[str, str] = {
    "op1_chat_format": OP1,
    "op2_line_dedup": OP2,
    "op6_decontaminate": OP6,
    "op8_warc": OP8,
    "op10_exact_dedup": OP10,
    "op11_structure_repair": OP11,
    "op12_ranked_search": OP12,
}
