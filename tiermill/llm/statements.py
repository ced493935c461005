"""The expected results of those queries that SQL can express, from their definitions and not from the operators."""

from __future__ import annotations

from tiermill.llm.chat_windows import BUDGET, HISTORY, MARKUP_TOKENS

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x20\x09-\x0D]+')"


def _escape(column: str) -> str:
    return rf"regexp_replace({column}, '([<\[])(\\*/?(?:s>|INST\]))', '\1\\\2', 'g')"


REMOVED = """
WITH docs AS (SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
starts AS (SELECT doc_id, b, unnest(generate_series(1, n - 49)) AS p FROM docs WHERE n >= 50),
strings AS MATERIALIZED (SELECT doc_id, p, array_slice(b, p, p + 49) AS s FROM starts),
earliest AS (SELECT s, min(doc_id) AS first_doc FROM strings GROUP BY s),
hits AS (SELECT doc_id, p FROM strings JOIN earliest USING (s) WHERE first_doc < doc_id),
steps AS (SELECT *, p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50 AS apart FROM hits),
numbered AS (SELECT *, count(*) FILTER (WHERE apart) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM steps),
runs AS (SELECT doc_id, min(p) AS a, max(p) + 49 AS z FROM numbered GROUP BY doc_id, run),
gaps AS (
  SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) + 1 AS a, a - 1 AS z FROM runs
  UNION ALL SELECT doc_id, max(z) + 1, any_value(n) FROM runs JOIN docs USING (doc_id) GROUP BY doc_id),
rest AS (
  SELECT doc_id, string_agg(hex(array_slice(b, g.a, g.z)), '' ORDER BY g.a) FILTER (WHERE g.a <= g.z) AS kept
  FROM gaps g JOIN docs USING (doc_id) GROUP BY doc_id),
sums AS (SELECT doc_id, sum(z - a + 1) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  CASE WHEN n_spans IS NULL THEN sha256(b) ELSE sha256(unhex(coalesce(kept, ''))) END AS kept_sha256
FROM docs LEFT JOIN sums USING (doc_id) LEFT JOIN rest USING (doc_id)
"""

CHATS = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, len(regexp_extract_all(text, '\\S+')) + {MARKUP_TOKENS} AS tokens,
    length('<s>' || {_escape("role")} || '[INST]' || {_escape("text")} || '</s>') AS chars FROM said),
placed AS (
  SELECT *, row_number() OVER w AS place, sum(tokens) OVER (w ROWS UNBOUNDED PRECEDING) AS e FROM sized
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
lead_in AS (SELECT conv_id, chars AS s_chars, tokens AS s_tokens FROM placed WHERE place = 1 AND role = 'system'),
cells AS (
  SELECT placed.*, e - tokens AS s, greatest(1, {BUDGET - HISTORY} - coalesce(s_tokens, 0)) AS cell
  FROM placed LEFT JOIN lead_in USING (conv_id)),
spanned AS (SELECT *, (s // cell, (e - 1) // cell > s // cell) AS span FROM cells),
spans AS (SELECT conv_id, span, min(s) AS s, max(e) AS e FROM spanned GROUP BY conv_id, span),
again AS (
  SELECT t.conv_id, sum(t.chars) AS chars FROM spanned t
  JOIN spans a ON a.conv_id = t.conv_id AND a.span = t.span JOIN spans b ON b.conv_id = a.conv_id AND b.s = a.e
  WHERE a.e - t.s <= {HISTORY} AND NOT (t.place = 1 AND t.role = 'system') GROUP BY t.conv_id),
kept AS (SELECT conv_id, (count(*) - 1) * any_value(s_chars) AS chars FROM spans JOIN lead_in USING (conv_id) GROUP BY conv_id),
whole AS (
  SELECT conv_id, count(*) AS n_turns, sum(chars) AS chars,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '') AS learned
  FROM placed GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
  CAST(whole.chars + coalesce(again.chars, 0) + coalesce(kept.chars, 0) AS BIGINT) AS formatted_chars
FROM whole LEFT JOIN again USING (conv_id) LEFT JOIN kept USING (conv_id)
"""

LINKED = f"""
WITH RECURSIVE split AS MATERIALIZED (SELECT doc_id, {_WORDS} AS w FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(generate_series(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS shingle FROM split),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY ALL),
links AS MATERIALIZED (
  SELECT x, y FROM pairs JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * shared >= 90 * (a.n + b.n - shared)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, edges.y FROM reach JOIN edges ON edges.x = reach.y)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM documents
LEFT JOIN sizes USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) AS least USING (doc_id)
"""

ARCHIVED = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
sized AS (
  SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha256(html) AS payload_digest, min(page_id) OVER (PARTITION BY html) AS first_page
  FROM payloads)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN first_page END AS refers_to
FROM (SELECT *, payload_bytes >= 100 AND first_page < page_id AS again FROM sized)
"""

# crc32 of a text: its bytes (``bytes``, a list) folded over the table of the polynomial
_CRC_TABLE = """
RECURSIVE bits AS (
  SELECT i, 0 AS step, i AS v FROM range(256) AS bytes(i)
  UNION ALL SELECT i, step + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE step < 8),
crcs AS MATERIALIZED (SELECT list(v ORDER BY i) AS t FROM bits WHERE step = 8)
"""


def _crc32(text: str) -> str:
    cells = f"list_transform(range(1, 2 * octet_length(encode({text})), 2), lambda p: CAST('0x' || substr(hex(encode({text})), p, 2) AS BIGINT))"
    folded = f"list_reduce(list_prepend(4294967295::BIGINT, {cells}), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))"
    return f"xor({folded}, 4294967295)"


def _leaf(text: str) -> str:
    cells = [f"coalesce(octet_length(encode({c})) || ':' || {c}, '-')" for c in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)]
    return f"sha256({' || '.join(cells)})"


def _tree(name: str, leaves: str) -> str:
    """Nodes of all trees with their siblings; ``leaves`` has tree, pos, digest."""
    return f"""
{name}_up AS (
  SELECT tree, 0 AS level, pos, digest, count(*) OVER (PARTITION BY tree) AS n FROM {leaves}
  UNION ALL SELECT tree, level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 7) // 8
  FROM {name}_up WHERE n > 1 GROUP BY tree, level, pos // 8),
{name}_nodes AS MATERIALIZED (
  SELECT *, string_agg(digest, '' ORDER BY pos) OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
    string_agg(digest, '' ORDER BY pos) OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS behind
  FROM {name}_up WINDOW run AS (PARTITION BY tree, level, pos // 8 ORDER BY pos)),
{name}_tops AS (SELECT tree, digest FROM {name}_nodes WHERE n = 1)"""


MANIFEST = f"""
WITH {_CRC_TABLE},
hashed AS MATERIALIZED (
  SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, {_leaf("text")} AS leaf,
    CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN {_leaf(f"translate(text, '{_UPPER}', '{_UPPER.lower()}')")} END AS tampered
  FROM documents, crcs),
rows AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM hashed),
leaves AS (SELECT tree, pos, leaf AS digest FROM rows),
{_tree("low", "leaves")},
subroots AS (SELECT 0 AS tree, tree AS pos, digest FROM low_tops),
{_tree("high", "subroots")},
walk AS (
  SELECT tree, pos AS doc, 0 AS stage, 0 AS level, pos, coalesce(tampered, leaf) AS folded, '' AS proof FROM rows
  UNION ALL
  SELECT walk.tree, doc, stage + CASE WHEN coalesce(l.n, h.n) = 1 THEN 1 ELSE 0 END,
    CASE WHEN coalesce(l.n, h.n) = 1 THEN 0 ELSE walk.level + 1 END,
    CASE WHEN coalesce(l.n, h.n) = 1 THEN walk.tree ELSE walk.pos // 8 END,
    CASE WHEN coalesce(l.n, h.n) = 1 THEN folded
      ELSE sha256(coalesce(l.before, h.before, '') || folded || coalesce(l.behind, h.behind, '')) END,
    proof || coalesce(l.before, h.before, '') || coalesce(l.behind, h.behind, '')
  FROM walk LEFT JOIN low_nodes l ON stage = 0 AND l.tree = walk.tree AND l.level = walk.level AND l.pos = walk.pos
  LEFT JOIN high_nodes h ON stage = 1 AND h.level = walk.level AND h.pos = walk.pos WHERE stage < 2),
ends AS (SELECT tree, doc AS pos, folded, proof FROM walk WHERE stage = 2)
SELECT doc_id, leaf, low_tops.digest AS subroot, high_tops.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
  folded = high_tops.digest AS verified
FROM rows JOIN ends USING (tree, pos) JOIN low_tops USING (tree) CROSS JOIN high_tops
"""

SPELLED = f"""
WITH {_CRC_TABLE},
said AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[a-z\u00C0-\u00FF]+')) AS run
  FROM documents),
pairs AS (SELECT doc_id, run, count(*) AS n FROM said GROUP BY ALL),
coded AS (SELECT run, n, {_crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM pairs, crcs),
slipped AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM coded),
words AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
places AS (SELECT word, n, unnest(range(length(word))) AS i FROM words),
gaps AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i) AS a, substr(word, i + 2) AS z FROM places),
near AS (
  SELECT x.word, y.word AS other, y.n AS other_n FROM gaps x JOIN gaps y ON x.i = y.i AND x.a = y.a AND x.z = y.z AND x.word <> y.word
  UNION SELECT x.word, w.word, w.n FROM gaps x JOIN words w ON w.word = x.a || x.z
  UNION SELECT w.word, x.word, x.n FROM gaps x JOIN words w ON w.word = x.a || x.z),
sums AS (SELECT word, count(*) AS n_near, max(other_n) AS form_n, arg_min(other, (-other_n, other)) AS form FROM near GROUP BY word),
known AS MATERIALIZED (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * words.n THEN form END AS form,
    CASE WHEN form_n >= 5 * words.n THEN form_n END AS form_n FROM words LEFT JOIN sums USING (word)),
walk AS (
  SELECT word, word AS root FROM known
  UNION ALL SELECT walk.word, known.form FROM walk JOIN known ON known.word = walk.root WHERE known.form IS NOT NULL),
ends AS (SELECT walk.word, walk.root FROM walk JOIN known ON known.word = walk.root WHERE known.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM known JOIN ends USING (word)
"""

STATEMENTS: dict[str, str] = {
    "op3_suffix_levels": REMOVED,
    "op5_chat_windows": CHATS,
    "op9_ngram_join": LINKED,
    "op11_arc_to_warc": ARCHIVED,
    "op12_merkle": MANIFEST,
    "op13_spelling": SPELLED,
}
