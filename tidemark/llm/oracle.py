"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

_OP2 = r"""
WITH split AS (
  SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
numbered AS (
  SELECT doc_id, unnest(parts) AS body, unnest(range(1, len(parts) + 1)) AS spot FROM split),
worded AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY spot) AS place
  FROM numbered WHERE regexp_matches(body, '[^\x20\x09-\x0D]')),
windows AS (
  SELECT a.doc_id, a.spot AS line, c.spot AS last, a.body AS x, b.body AS y, c.body AS z
  FROM worded a JOIN worded b ON a.doc_id = b.doc_id AND b.place = a.place + 1
  JOIN worded c ON a.doc_id = c.doc_id AND c.place = a.place + 2),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY x, y, z ORDER BY doc_id, line) AS nth FROM windows),
covered AS (
  SELECT DISTINCT doc_id, unnest(range(line, last + 1)) AS spot FROM ranked WHERE nth > 1)
SELECT d.doc_id,
  coalesce(string_agg(n.body, chr(10) ORDER BY n.spot) FILTER (WHERE c.spot IS NULL), CASE WHEN any_value(d.text) IS NOT NULL THEN '' END) AS text,
  CAST(count(n.spot) AS INTEGER) AS lines, CAST(count(c.spot) AS INTEGER) AS removed_lines
FROM documents d LEFT JOIN numbered n ON n.doc_id = d.doc_id
LEFT JOIN covered c ON c.doc_id = n.doc_id AND c.spot = n.spot
GROUP BY d.doc_id
"""


def _tree(name: str, source: str) -> str:
    """CTEs over the leaves ``source`` (grp, rank, n, hash): the runs of every level, and each group's top."""
    return f"""
{name}_nodes AS (
  SELECT grp, 0 AS level, rank, n, hash FROM {source}
  UNION ALL
  SELECT grp, level + 1, rank // 8, (n + 7) // 8, sha256(string_agg(hash, '' ORDER BY rank))
  FROM {name}_nodes WHERE n > 1 GROUP BY grp, level, rank // 8, n),
{name}_runs AS (
  SELECT grp, level, rank // 8 AS run, list(hash ORDER BY rank) AS hashes
  FROM {name}_nodes WHERE n > 1 GROUP BY grp, level, rank // 8),
{name}_tops AS (SELECT grp, hash FROM {name}_nodes WHERE n = 1)"""


def _walk(name: str, source: str) -> str:
    """CTE <name>_ends: ``proof`` and ``node`` of the rows of ``source`` (id, grp, rank, proof, node) after all levels."""
    return f"""
{name}_walk AS (
  SELECT id, grp, 0 AS level, rank, proof, node FROM {source}
  UNION ALL
  SELECT w.id, w.grp, w.level + 1, w.rank // 8,
    w.proof || array_to_string(r.hashes[:w.rank % 8], '') || array_to_string(r.hashes[w.rank % 8 + 2:], ''),
    sha256(array_to_string(r.hashes[:w.rank % 8], '') || w.node || array_to_string(r.hashes[w.rank % 8 + 2:], ''))
  FROM {name}_walk w JOIN {name}_runs r ON r.grp = w.grp AND r.level = w.level AND r.run = w.rank // 8),
{name}_ends AS (SELECT id, arg_max(proof, level) AS proof, arg_max(node, level) AS node FROM {name}_walk GROUP BY id)"""


def _leaf(text: str) -> str:
    fields = ("doc_id", "source", "lang", "n_chars", text)
    return "sha256(" + " || ".join(f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || {f}, '-')" for f in fields) + ")"


#: crc32 of an integer's decimal text, bit by bit (reflected polynomial 0xEDB88320).
_CRC32 = """xor(4294967295, list_reduce(
  list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda crc, c: list_reduce(list_prepend(xor(crc, c), range(8)),
    lambda x, bit: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)))"""

_OP12 = f"""
WITH RECURSIVE hashed AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce('=' || lang, '') AS grp, {_leaf("text")} AS leaf,
    CASE WHEN {_CRC32} % 3 = 0
      THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed
  FROM documents),
leaves AS (
  SELECT *, leaf AS hash, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
    count(*) OVER (PARTITION BY grp) AS n FROM hashed),
{_tree("low", "leaves")},
subroots AS (
  SELECT '' AS grp, grp AS of_grp, hash, row_number() OVER (ORDER BY grp) - 1 AS rank, count(*) OVER () AS n FROM low_tops),
{_tree("high", "subroots")},
starts AS (SELECT id, grp, rank, '' AS proof, coalesce(changed, leaf) AS node FROM leaves),
{_walk("low", "starts")},
halves AS (
  SELECT e.id, s.grp, s.rank, e.proof, e.node FROM low_ends e JOIN leaves l ON l.id = e.id JOIN subroots s ON s.of_grp = l.grp),
{_walk("high", "halves")}
SELECT l.doc_id, l.leaf, s.hash AS subroot, t.hash AS root, sha256(e.proof) AS proof_sha256, e.node AS folded_root,
  e.node = t.hash AS verified
FROM leaves l JOIN subroots s ON s.of_grp = l.grp JOIN high_ends e ON e.id = l.id CROSS JOIN high_tops t
"""

_TERMS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

_OP11 = f"""
WITH docs AS (SELECT row_number() OVER () AS id, doc_id, {_TERMS} AS terms FROM documents),
lengths AS (SELECT id, doc_id, len(terms) AS n FROM docs WHERE len(terms) > 0),
totals AS (SELECT count(*) AS all_docs, CAST(sum(n) AS BIGINT) AS all_terms FROM lengths),
tfs AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(terms) AS term FROM docs) GROUP BY id, term),
dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * all_docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM dfs, totals),
asked AS (
  SELECT item_id, text, term, count(*) AS times FROM (
    SELECT item_id, text, unnest({_TERMS}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark))
  GROUP BY item_id, text, term),
scores AS (
  SELECT a.item_id, a.text, f.id, any_value(l.doc_id) AS doc_id, CAST(sum(
    a.times * w.w * ((1000000000 * f.tf) // (1000 * f.tf + 12 * (100 - 25 + (25 * l.n * t.all_docs) // t.all_terms)))) AS BIGINT) AS score
  FROM asked a JOIN weights w ON w.term = a.term JOIN tfs f ON f.term = a.term JOIN lengths l ON l.id = f.id, totals t
  GROUP BY a.item_id, a.text, f.id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""

ORACLE_SQL: dict[str, str] = {"op2_line_dedup": _OP2, "op11_lexical_search": _OP11, "op12_merkle_manifest": _OP12}
