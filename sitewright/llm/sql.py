"""DuckDB SQL for the queries of the llm problems that SQL can express."""

from __future__ import annotations

_B = r"\s\x{00a0}\x{0085}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_WORDS = r"""regexp_extract_all(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(text), '[\x{200b}-\x{200d}\x{ad}\x{feff}]', '', 'g'),
  '<[^<>\n]{1,200}>', ' ', 'g'), '\[[^\[\]\n]{1,80}\]', ' ', 'g'), '&#?[\p{L}\p{N}_]{1,10};', ' ', 'g'), '[\p{L}\p{N}]+')"""


def _runs(key: str, source: str) -> str:
    return f"SELECT DISTINCT {key}, array_to_string(w[i:i + 12], ' ') AS run FROM (SELECT {key}, w, unnest(range(1, len(w) - 11)) AS i FROM (SELECT {key}, {_WORDS} AS w FROM {source} WHERE text IS NOT NULL))"


_TEXT = f"SELECT doc_id, source, regexp_replace(text, '[{_B}]+$', '') AS t FROM documents"
_CLOSERS = rf"""["''”’»)\]}}*_{_B}]*\z"""
_LINE = rf"regexp_replace(l[-1], '^[>{_B}]+|[>{_B}]+$', '', 'g')"
_CUT = rf"""SELECT doc_id, source, t, string_split(t, chr(10)) AS l,
    regexp_matches(t, '\x{{fffd}}\z|[\[(](?:\.\.\.|…)[\])]\z|[\[<][^\]>\n\r]{{0,60}}\z|&#?[\p{{L}}\p{{N}}_]{{0,9}}\z') AS never FROM ({_TEXT}) WHERE t <> ''"""
_FOUND = rf"""SELECT doc_id FROM ({_CUT}) WHERE never OR NOT (
    len(list_filter(l[greatest(len(l) - 3, 1):len(l) - 1], lambda x: regexp_matches(regexp_replace(x, '^[>{_B}]+|[>{_B}]+$', '', 'g'), '^(?:--|[_~]{{4,}})\z'))) > 0
    OR regexp_matches(t, '(?i)(?:</[^<>\n]{{1,60}}>|\[/[^\[\]\n]{{1,60}}\]|<br\s*/?>){_CLOSERS}')
    OR regexp_matches(t, '(?:[:;]-?[)(DP]|[\x{{2600}}-\x{{27bf}}\x{{1f300}}-\x{{1faff}}][\x{{fe0e}}\x{{fe0f}}]?|[.!?…。！？]){_CLOSERS}')
    OR regexp_matches({_LINE}, '(?i)^(?:https?://|www\.)\S+\z')
    OR (len(regexp_split_to_array({_LINE}, '[{_B}]+')) <= 4 AND length({_LINE}) <= 30))"""
_PREFIXES = f"""SELECT d.doc_id, v.whole_id FROM ({_TEXT}) d JOIN (
    SELECT t, lead(t) OVER o AS u, lead(value_id) OVER o AS whole_id FROM (SELECT t, min(doc_id) AS value_id FROM ({_TEXT}) WHERE t <> '' GROUP BY 1) WINDOW o AS (ORDER BY t)) v
  ON d.t = v.t WHERE starts_with(v.u, v.t)"""

_KEY = "trial, subject, sample, mode, refgenome"
_CLUSTERED = rf"""SELECT DISTINCT readid, {_KEY}, regexp_replace(clusterid, '^[{_B}]+|[{_B}]+$', '', 'g') AS cluster FROM buildstdfragments
    WHERE readid IS NOT NULL AND trial IS NOT NULL AND subject IS NOT NULL AND sample IS NOT NULL AND mode IS NOT NULL AND refgenome IS NOT NULL AND regexp_replace(clusterid, '^[{_B}]+|[{_B}]+$', '', 'g') NOT IN ('', 'NA')"""
# every match is followed from its least read on; a read's group is the least read that reaches it
_GROUPS = f"""m AS ({_CLUSTERED}), k AS (SELECT *, min(readid) OVER (PARTITION BY {_KEY}, cluster) AS head FROM m),
  e AS (SELECT DISTINCT readid AS u, head AS v FROM k WHERE readid <> head UNION SELECT DISTINCT head, readid FROM k WHERE readid <> head),
  reach AS (SELECT u AS readid, u AS groupid FROM e UNION SELECT e.v, reach.groupid FROM reach JOIN e ON e.u = reach.readid),
  g AS (SELECT readid, min(groupid) AS groupid FROM reach GROUP BY 1)"""

SQL = {
    "p2_found": f"WITH RECURSIVE {_GROUPS} SELECT * FROM g",
    "p2_cluster_counts": f"""WITH RECURSIVE {_GROUPS}, t AS (SELECT {_KEY}, count(DISTINCT groupid) AS n FROM m JOIN g USING (readid) GROUP BY ALL),
  r AS (SELECT trial, subject, sample, mode, ref_genome AS refgenome, max(total_clusters) AS total_clusters FROM multihit_clusters GROUP BY ALL)
  SELECT {_KEY}, coalesce(n, 0) AS n_groups, total_clusters FROM r LEFT JOIN t USING ({_KEY})""",
    "p7_found": f"SELECT DISTINCT doc_id, item_id FROM ({_runs('doc_id', 'documents')}) JOIN ({_runs('item_id', 'eval_items')}) USING (run)",
    "p8_found": _FOUND,
    "p8_prefixes": _PREFIXES,
    "p8_sources": rf"""SELECT regexp_replace(source, '^[{_B}]+|[{_B}]+$', '', 'g') AS source, count(*) AS n_docs, count(f.doc_id) AS n_cut, count(p.doc_id) AS n_prefix
  FROM documents d LEFT JOIN ({_FOUND}) f ON d.doc_id = f.doc_id LEFT JOIN ({_PREFIXES}) p ON d.doc_id = p.doc_id GROUP BY 1""",
}
