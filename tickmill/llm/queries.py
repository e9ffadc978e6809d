"""The registered queries of this subpackage: each operator on its whole table."""

from __future__ import annotations

from . import bpe, chat, decontam, fingerprint, hot_join, langid, lm, ngram_join, quality, repair, substring, toxicity, warc


def queries() -> dict:
    return {
        "op1_warc": warc.op1,
        "op2_decontamination": decontam.op2,
        "op3_byte_bpe": bpe.op3,
        "op4_ngram_jaccard": ngram_join.op4,
        "op5_quality": quality.op5,
        "op6_substring_dedup": substring.op6,
        "op7_lm_scoring": lm.op7,
        "op8_toxicity": toxicity.op8,
        "op9_language_id": langid.op9,
        "op10_fingerprint": fingerprint.op10,
        "op11_hot_join": hot_join.op11,
        "op12_conversation_repair": repair.op12,
        "op13_chat_format": chat.op13,
    }


#: What DuckDB can express over the same tables.
OP1 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages WHERE page_id IS NOT NULL),
     h AS (SELECT page_id, cast(octet_length(encode(html)) AS bigint) AS payload_bytes, sha1(html) AS payload_digest,
                  max(page_id) OVER (PARTITION BY html) AS holder FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND holder <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND holder <> page_id THEN holder END AS refers_to
FROM h
"""

OP4 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
                                     WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM i JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.y, r.c FROM r JOIN e ON e.x = r.doc_id WHERE r.c < e.y)
SELECT d.doc_id, cast(coalesce(any_value(n.n), 0) AS bigint) AS n_shingles, min(r.c) AS component_id
FROM documents d JOIN r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id
"""

_OP6_WORDS = r"""
w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM {docs}),
v AS (SELECT doc_id, unnest(range(1, len(ws) - 11)) AS i, unnest(list_transform(range(1, len(ws) - 11), lambda i: array_to_string(ws[i:i + 12], ' '))) AS g FROM w WHERE len(ws) >= 13),
f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) < doc_id AS again FROM v),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM f WHERE again),
x AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM w),
k AS (SELECT x.doc_id, count(*) AS n_words, count(gone.i) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY x.i) FILTER (WHERE gone.i IS NULL), '') AS kept,
             count(*) FILTER (WHERE gone.i IS NOT NULL AND p.i IS NULL) AS n_repeats
      FROM x LEFT JOIN gone ON gone.doc_id = x.doc_id AND gone.i = x.i LEFT JOIN gone p ON p.doc_id = x.doc_id AND p.i = x.i - 1 GROUP BY 1)
"""
OP6 = (
    "WITH "
    + _OP6_WORDS.format(docs="documents")
    + """
SELECT d.doc_id, cast(coalesce(n_words, 0) AS bigint) AS n_words, cast(coalesce(n_removed, 0) AS bigint) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256, cast(coalesce(n_repeats, 0) AS bigint) AS n_repeats
FROM documents d LEFT JOIN k USING (doc_id)
"""
)

#: crc32 byte by byte: the table by its rule, and the fold over an ASCII string.
_CRC_TABLE = "SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda a, i: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, b)) AS t"
_CRC = "xor(list_reduce(list_transform(range(1, length({0}) + 1), lambda i: cast(ascii({0}[i]) AS bigint)), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295)"
OP11 = (
    r"""
WITH t AS MATERIALIZED (""" + _CRC_TABLE + r"""),
raw AS (
  SELECT 'click' AS side, click_id AS id, client_id, value AS amount FROM clicks
  UNION ALL SELECT 'sale', sale_id, client_id, total FROM sales),
named AS (SELECT side, id, client_id, cast(id AS varchar) AS a, coalesce(cast(id AS varchar), '') || ':' || coalesce(cast(cast(floor(100 * amount + 0.5) AS bigint) AS varchar), '') AS b FROM raw),
hashed AS (
  SELECT side, id, client_id,
         """ + _CRC.format("a") + r""" AS h,
         """ + _CRC.format("b") + r""" AS crc
  FROM named, t),
dealt AS (SELECT side, id, CASE WHEN h % 10 < 3 THEN (h // 10) % 7 ELSE client_id END AS client_id, crc FROM hashed),
keyed AS (SELECT client_id, side, count(*) AS n, sum(crc) AS s FROM dealt WHERE client_id IS NOT NULL GROUP BY 1, 2),
met AS (SELECT d.side, d.id, d.client_id, coalesce(k.n, 0) AS n, coalesce(k.s, 0) AS s FROM dealt d LEFT JOIN keyed k ON k.client_id = d.client_id AND k.side <> d.side)
SELECT side, id, min(client_id) AS client_id, count(*) AS copies, cast(sum(n) AS bigint) AS inner_rows,
       cast(sum(CASE WHEN side = 'click' THEN greatest(n, 1) ELSE n END) AS bigint) AS left_rows, cast(sum(greatest(n, 1)) AS bigint) AS full_rows, cast(sum(s) AS bigint) AS partner_crc
FROM met GROUP BY side, id
"""
)

#: A turn takes 8 + 8 + 7 characters of marks, and a backslash for each control string in its role or text.
OP13 = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
f AS (SELECT *, length(role) + length(text) + 23 + len(regexp_extract_all(role || chr(0) || text, '<\\*(\|(turn|text|end)\|>|/?s>)|\[\\*/?INST\]')) AS chars FROM r),
g AS (
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, sha256(text))) AS turns_sha256,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, sha256(text)) FILTER (WHERE role = 'assistant'), '') AS trained, cast(sum(chars) AS bigint) AS formatted_chars
  FROM f GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, cast(length(trained) AS bigint) AS loss_chars, sha256(trained) AS loss_sha256, formatted_chars FROM g
"""


def _op12_sql() -> str:
    """The edits as rows (state, kind of row, cost, letters, state after, inserted role, given role), and the layers as a recursive query over rows."""
    from .repair import INSERT, TURN, _moves

    ways = [f"({state}, '{k}', {cost}, '{letters}', {to}, {repr(TURN[state][0] + ':') if 'I' in letters else 'NULL'}, {repr(_role(state, letters)) if 'R' in letters else 'NULL'})" for state in TURN for k in "suaoSUAOx" for cost, letters, to in _moves(state, k)]
    ends = ", ".join(f"({s}, {INSERT * n}, '{'I' * n}', {text})" for s, n, text in ((0, 0, "[]"), (1, 2, "['user:', 'assistant:']"), (2, 1, "['assistant:']"), (3, 0, "[]")))
    return (
        r"""
WITH RECURSIVE t AS MATERIALIZED ("""
        + _CRC_TABLE
        + r"""),
named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(cast(conv_id AS varchar), ' ') || ':' || coalesce(cast(turn AS varchar), ' ') AS a FROM conversations),
coded AS (SELECT *, """
        + _CRC.format("a")
        + r""" % 20 AS code FROM named, t),
damaged AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role, CASE WHEN code = 1 THEN '' WHEN code = 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE WHEN code = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM coded WHERE code <> 0),
trimmed AS (SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare, substring(role, 1, 1) AS initial, sha256(text) AS digest FROM damaged),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, digest ORDER BY turn NULLS FIRST, copy) > 1 AS again,
         row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n, lag(initial) OVER w || initial AS pair FROM trimmed WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, digest, copy)),
marked AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault, CASE WHEN initial IN ('s', 'u', 'a') THEN initial ELSE 'o' END AS letter FROM numbered),
signed AS (SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 'x' WHEN fault = 'truncated' THEN upper(letter) ELSE letter END AS k FROM marked),
ways(state, k, cost, letters, after, inserted, given) AS (VALUES """
        + ", ".join(ways)
        + r"""),
dp(conv_id, i, n, state, cost, audit, made) AS (
  SELECT DISTINCT conv_id, cast(0 AS bigint), n, 0, 0, '', cast([] AS varchar[]) FROM signed
  UNION ALL
  SELECT conv_id, i, n, after, cost, audit, made FROM (
    SELECT d.conv_id, s.i, d.n, w.after, d.cost + w.cost AS cost, d.audit || w.letters AS audit,
           list_concat(d.made, CASE WHEN w.inserted IS NULL THEN [] ELSE [w.inserted] END, CASE WHEN w.letters LIKE '%D' THEN [] ELSE [coalesce(w.given, s.role) || ':' || s.text] END) AS made,
           row_number() OVER (PARTITION BY d.conv_id, w.after ORDER BY d.cost + w.cost, d.audit || w.letters) AS r
    FROM dp d JOIN signed s ON s.conv_id IS NOT DISTINCT FROM d.conv_id AND s.i = d.i + 1 JOIN ways w ON w.state = d.state AND w.k = s.k)
  WHERE r = 1),
ends(state, cost, letters, made) AS (VALUES """
        + ends
        + r"""),
best AS (
  SELECT d.conv_id, d.cost + e.cost AS cost, d.audit || e.letters AS audit, sha256(array_to_string(list_concat(d.made, e.made), chr(10))) AS repaired_sha256,
         row_number() OVER (PARTITION BY d.conv_id ORDER BY d.cost + e.cost, d.audit || e.letters) AS r
  FROM dp d JOIN ends e USING (state) WHERE d.i = d.n),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM signed GROUP BY conv_id)
SELECT o.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate, coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal,
       cast(coalesce(b.cost, 0) AS bigint) AS cost, coalesce(b.audit, '') AS audit, coalesce(b.repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id AND b.r = 1
"""
    )


def _role(state: int, letters: str) -> str:
    """The role that a row gets in this state, after the insertion if there is one."""
    from .repair import TURN

    return TURN[TURN[state][1] if "I" in letters else state][0]


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": OP1, "op4_ngram_jaccard": OP4, "op6_substring_dedup": OP6, "op11_hot_join": OP11, "op12_conversation_repair": _op12_sql(), "op13_chat_format": OP13}
