"""ANSI SQL for the queries of ``data_queries``, run by DuckDB on the same tables."""

from __future__ import annotations

from tessellon.functions.curie import WHITE_SPACE

_CHARS = " || ".join(f"chr({ord(c)})" for c in WHITE_SPACE)


def trim(c: str) -> str:
    return f"trim({c}, {_CHARS})"


def plain(c: str) -> str:
    """Plain form of a CURIE, null without a colon."""
    t = trim(c)
    return f"(CASE WHEN instr({t}, ':') > 0 THEN upper(left({t}, instr({t}, ':') - 1)) || substr({t}, instr({t}, ':')) END)"


def value(c: str) -> str:
    return f"(CASE WHEN {trim(c)} <> '' THEN coalesce({plain(c)}, {trim(c)}) END)"


def present(c: str) -> str:
    return f"coalesce({trim(c)} <> '', false)"


_LIST = """(CASE json_type({0}) WHEN 'ARRAY' THEN json_extract({0}, '$[*]') WHEN 'NULL' THEN NULL ELSE [{0}] END)"""
_IDENTS = f"""
lines AS (SELECT line_id, raw_line::JSON AS j FROM compendium_jsonl WHERE raw_line IS NOT NULL),
held AS (SELECT line_id, unnest([json_extract(j, '$.identifiers'), json_extract(j, '$.equivalent_identifiers')]) AS a FROM lines),
opened AS (SELECT line_id, CASE WHEN json_type(a) = 'VARCHAR' AND json_valid(json_extract_string(a, '$')) THEN json_extract_string(a, '$')::JSON ELSE a END AS a FROM held WHERE a IS NOT NULL),
listed AS (SELECT line_id, {_LIST.format('a')} AS l FROM opened),
idents AS (SELECT line_id, unnest(range(len(l))) AS pos, unnest(l) AS o FROM listed WHERE l IS NOT NULL)"""


def _part(source: str, pos: str, path: str, kind: str) -> str:
    inner = f"json_extract({'o' if source == 'idents' else 'j'}, '$.{path}')"
    return f"""SELECT line_id, pos::INT AS pos, '{kind}' AS child_kind, ord::INT AS ord FROM (
  SELECT line_id, pos, unnest(range(len(l))) AS ord, unnest(l) AS x FROM (SELECT line_id, {pos} AS pos, {_LIST.format('v')} AS l FROM (SELECT *, {inner} AS v FROM {source}) WHERE v IS NOT NULL) WHERE l IS NOT NULL
) WHERE json_type(x) <> 'NULL'"""


P2_FOUND = f"""WITH {_IDENTS}
SELECT line_id, pos::INT AS pos, 'identifier' AS child_kind, 0 AS ord FROM idents WHERE json_type(o) <> 'NULL'
UNION ALL {_part('idents', 'pos', 'd', 'description')}
UNION ALL {_part('idents', 'pos', 't', 'taxon')}
UNION ALL {_part('lines', '-1', 'type', 'record_type')}
UNION ALL {_part('lines', '-1', 'taxa', 'record_taxon')}
UNION ALL {_part('lines', '-1', 'descriptions', 'record_description')}
UNION ALL SELECT line_id, -1, 'ic', 0 FROM lines WHERE json_type(j, '$.ic') NOT IN ('OBJECT', 'ARRAY', 'NULL', 'BOOLEAN')
  AND regexp_full_match(json_extract_string(j, '$.ic'), '\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*')"""

P2_IDENTIFIERS = f"""WITH {_IDENTS}
SELECT line_id, pos::INT AS pos, coalesce(json_extract_string(o, '$.i'), json_extract_string(o, '$.identifier'), CASE WHEN json_type(o) <> 'OBJECT' THEN json_extract_string(o, '$') END) AS curie,
  coalesce(json_extract_string(o, '$.l'), json_extract_string(o, '$.label')) AS label
FROM idents WHERE json_type(o) <> 'NULL'"""

_CLASS = "".join(f"\\x{{{ord(c):x}}}" for c in WHITE_SPACE)
_FIELD = '"(?:[^"]|"")*"|[^"\\t][^\\t]*|'
_UNQUOTE = "CASE WHEN left(f, 1) = '\"' THEN replace(substr(f, 2, length(f) - 2), '\"\"', '\"') ELSE f END"
_PARSED = f"""
lines AS (SELECT line_id, filename, rtrim(raw_line, chr(13)) AS l, CASE WHEN filename LIKE 'synonyms/%' THEN 'synonyms' WHEN filename = 'drugchemical.tsv' THEN 'drugchemical' END AS kind
  FROM raw_lines WHERE {present('raw_line')} AND left(raw_line, 1) <> '#'),
split AS (SELECT *, regexp_full_match(l, '(?s)(?:{_FIELD})(?:\\t(?:{_FIELD}))*') AS whole,
  list_transform(regexp_extract_all(l || chr(9), '(?s)("(?:[^"]|"")*"|[^\\t]*)\\t', 1), lambda f: {_UNQUOTE}) AS fields FROM lines),
judged AS (SELECT line_id, kind, fields, CASE
  WHEN NOT whole THEN 'quoting'
  WHEN len(fields) <> CASE kind WHEN 'synonyms' THEN 3 ELSE 5 END THEN 'column_count'
  WHEN NOT regexp_full_match(fields[1], '[^:{_CLASS}]+:[^{_CLASS}]+') THEN 'invalid_value'
  WHEN NOT EXISTS (SELECT 1 FROM known_predicates k WHERE k.filename = kind AND k.predicate = fields[2]) THEN 'invalid_value'
  WHEN kind = 'synonyms' AND (NOT regexp_matches(fields[3], '[\\p{{L}}\\p{{N}}]') OR regexp_matches(fields[3], '[\\x{{fffd}}\\x00-\\x08\\x0b-\\x1f\\x7f-\\x{{9f}}]')) THEN 'invalid_value'
  WHEN kind = 'drugchemical' AND NOT regexp_full_match(fields[3], '[^:{_CLASS}]+:[^{_CLASS}]+') THEN 'invalid_value'
  WHEN kind = 'drugchemical' AND fields[5] <> '' AND NOT regexp_full_match(fields[5], 'https?://[^{_CLASS}]*') THEN 'invalid_value'
  END AS reason FROM split)"""
P3_FOUND = f"WITH {_PARSED} SELECT line_id, reason FROM judged WHERE reason IS NOT NULL"
P3_SYNONYMS = f"WITH {_PARSED} SELECT line_id, fields[1] AS curie, fields[2] AS predicate, fields[3] AS synonym FROM judged WHERE reason IS NULL AND kind = 'synonyms'"
P3_DRUGCHEMICAL = f"WITH {_PARSED} SELECT line_id, fields[1] AS subject, fields[2] AS predicate, fields[3] AS object, fields[4] AS notes, fields[5] AS url FROM judged WHERE reason IS NULL AND kind = 'drugchemical'"

_CHANGES = """WITH rels AS (SELECT * FROM (VALUES (0, '2024mar24'), (1, '2024jul13'), (2, '2024oct24'), (3, '2025jan23'), (4, '2025mar31')) t(i, tag)),
ranked AS (SELECT i, count_path, round(TRY_CAST(replace(trim(cnt), ',', '') AS DECIMAL(38, 6)))::BIGINT AS n,
  row_number() OVER (PARTITION BY i, count_path ORDER BY delivered_at DESC, row_id DESC) AS rn FROM release_counts JOIN rels ON tag = release_tag),
snap AS (SELECT i, count_path, n FROM ranked WHERE rn = 1),
pairs AS (SELECT coalesce(a.i, b.i - 1) AS i, coalesce(a.count_path, b.count_path) AS count_path, a.i AS ai, b.i AS bi, a.n AS an, b.n AS bn
  FROM (SELECT * FROM snap WHERE i < 4) a FULL OUTER JOIN (SELECT * FROM snap WHERE i > 0) b ON a.i + 1 = b.i AND a.count_path = b.count_path)
SELECT f.tag AS from_release, t.tag AS to_release, count_path, CASE WHEN ai IS NULL THEN 'added' WHEN bi IS NULL THEN 'removed' ELSE 'changed' END AS change_kind{more}
FROM pairs JOIN rels f ON f.i = pairs.i JOIN rels t ON t.i = pairs.i + 1 WHERE ai IS NULL OR bi IS NULL OR an IS DISTINCT FROM bn"""
P4_FOUND = _CHANGES.replace("{more}", "")
P4_VALUES = _CHANGES.replace("{more}", ", an AS old_n, bn AS new_n")

_TYPE = "(CASE WHEN starts_with(trim(biolink_type), 'biolink:') THEN trim(biolink_type) ELSE 'biolink:' || trim(biolink_type) END)"
_PAIRS = f"""WITH a AS (SELECT DISTINCT {value('clique_leader')} AS k, {value('curie')} AS m FROM edge WHERE {present('clique_leader')} AND {present('curie')}),
b AS (SELECT DISTINCT {_TYPE} AS k, {value('clique_leader')} AS m FROM clique WHERE {present('biolink_type')} AND {present('clique_leader')}),
c AS (SELECT 'edge.clique_leader' AS field_name, k AS key_value, count(*) AS n FROM a GROUP BY k UNION ALL SELECT 'clique.biolink_type', k, count(*) FROM b GROUP BY k)"""
P5_FOUND = _PAIRS + " SELECT field_name, key_value FROM (SELECT *, sum(n) OVER (PARTITION BY field_name) AS total FROM c) WHERE n * 100 >= total"
P5_PER_KEY = _PAIRS + " SELECT field_name, key_value, n AS pairs FROM c"
P5_LEADER_TYPES = f"""WITH t AS (SELECT DISTINCT {plain('clique_leader')} AS leader, {_TYPE} AS type FROM clique WHERE {present('biolink_type')})
SELECT type, count(*) AS edges FROM (SELECT {plain('clique_leader')} AS leader FROM edge) JOIN t USING (leader) GROUP BY type"""

_REFS = " UNION ALL ".join(
    f"SELECT '{t}' AS tbl, row_id, '{f}' AS field_name, release_tag, loaded_at, {plain(f)} AS k FROM {t} WHERE {present(f)}"
    for t, f in (("edge", "curie"), ("drugchemical", "subject"), ("drugchemical", "object"))
)
P7_FOUND = f"""WITH r AS ({_REFS}), i AS (SELECT {plain('curie')} AS k, registered_at, retired_at FROM ids),
j AS (SELECT r.tbl, r.row_id, r.field_name, r.release_tag,
  bool_or(coalesce(i.registered_at <= r.loaded_at AND (i.retired_at IS NULL OR i.retired_at > r.loaded_at), false)) AS covered,
  bool_or(i.k IS NOT NULL) AS listed, bool_or(coalesce(i.registered_at > r.loaded_at, false)) AS later
  FROM r LEFT JOIN i ON r.k = i.k GROUP BY ALL)
SELECT tbl, row_id, field_name, release_tag, CASE WHEN NOT listed THEN 'missing' WHEN later THEN 'late' ELSE 'deleted' END AS orphan_state FROM j WHERE NOT covered"""
P7_REPORT = f"SELECT tbl, field_name, release_tag, orphan_state, count(*) AS refs FROM ({P7_FOUND}) GROUP BY ALL"

SQL = {
    "p2_found": P2_FOUND, "p2_identifiers": P2_IDENTIFIERS, "p3_found": P3_FOUND, "p3_synonyms": P3_SYNONYMS, "p3_drugchemical": P3_DRUGCHEMICAL,
    "p4_found": P4_FOUND, "p4_values": P4_VALUES, "p5_found": P5_FOUND, "p5_per_key": P5_PER_KEY, "p5_leader_types": P5_LEADER_TYPES,
    "p7_found": P7_FOUND, "p7_report": P7_REPORT,
}
