"""Queries of the general training-data problems (1 and 4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewright.functions.genome import parsed_position
from sitewright.operators.heavy_keys import aggregate_skewed
from sitewright.operators.sheet_parser import loaded_rows, rejected_rows, sheet_report
from sitewright.session import table


def p1_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, reads and fragments of every position."""
    rows = table(spark, sf_dir, "known_sites").select("nreads", "nfrags", F.inline(F.filter(F.array(parsed_position(F.col("posid"))), lambda x: x["posid"].isNotNull())))
    sites = rows.select("posid", "nreads", "nfrags")
    return aggregate_skewed(sites, "posid", [F.count("*").alias("n_rows"), F.sum("nreads").cast("long").alias("sum_nreads"), F.sum("nfrags").cast("long").alias("sum_nfrags")])


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions with at least 1% of all rows."""
    total = table(spark, sf_dir, "known_sites").agg(F.count("*").alias("total"))
    return p1_positions(spark, sf_dir).join(F.broadcast(total)).where(F.col("n_rows") * 100 >= F.col("total")).select("posid")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_rows(table(spark, sf_dir, "sampledata_lines"))


def p4_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_rows(table(spark, sf_dir, "sampledata_lines"))


def sheet_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: the report of every sheet."""
    return sheet_report(table(spark, sf_dir, "sampledata_lines"))


QUERIES = {"p1_found": p1_found, "p1_positions": p1_positions, "p4_found": p4_found, "p4_loaded": p4_loaded, "sheet_status": sheet_status}

# The oracle spells a position as sign and number, read the plain way.
_POSITIONS = r"""
  SELECT regexp_replace(lower(regexp_replace(posid, '^[\s\x{00a0}]+|[\s\x{00a0}]+$', '', 'g')), '^chr', '') AS t, nreads, nfrags
  FROM known_sites WHERE posid IS NOT NULL
"""
_GROUPED = rf"""
  SELECT 'chr' || upper(regexp_extract(t, '^([^+-]+)[+-]', 1)) || regexp_extract(t, '^[^+-]+([+-])', 1)
         || CAST(CAST(round(CAST(regexp_extract(t, '^[^+-]+[+-](.*)$', 1) AS DOUBLE)) AS BIGINT) AS VARCHAR) AS posid,
         count(*) AS n_rows, CAST(sum(nreads) AS BIGINT) AS sum_nreads, CAST(sum(nfrags) AS BIGINT) AS sum_nfrags
  FROM ({_POSITIONS}) GROUP BY 1
"""

# A cell is quoted whole or holds no quote; the line end may have one carriage return.
_CELL = r'"(?:[^"]|"")*"|[^"\t]*'
_LINES = rf"""SELECT line_id, sheet, line_no, regexp_replace(CASE WHEN line_no = 1 THEN ltrim(line, chr(65279)) ELSE line END, '\r\z', '') AS line FROM sampledata_lines"""
_CELLS = rf"""SELECT line_id, sheet, line_no, regexp_full_match(line, '(?s)(?:{_CELL})(?:\t(?:{_CELL}))*') AS sound,
    list_transform(regexp_extract_all(chr(9) || line, '(?s)\t({_CELL})', 1), lambda c: CASE WHEN starts_with(c, '"') THEN replace(c[2:-2], '""', '"') ELSE c END) AS cells FROM ({_LINES})"""
_ROWS = f"""SELECT b.line_id, b.sound, len(b.cells) = len(h.names) AS fits, b.cells[list_position(h.names, 'index1seq')] AS i,
    b.cells[list_position(h.names, 'adriftreadlinkerseq')] AS a, b.cells[list_position(h.names, 'replicate')] AS r
  FROM ({_CELLS}) b LEFT JOIN (SELECT sheet, list_transform(cells, lambda c: lower(trim(c))) AS names FROM ({_CELLS}) WHERE line_no = 1) h USING (sheet) WHERE line_no > 1"""

_OPTIONAL = ("trial", "subject", "sample", "index1seq", "adriftreadlinkerseq", "refgenome", "leaderseqhmm", "vectorfastafile", "mode")
_VALID = r"""sound AND fits AND coalesce(regexp_full_match(i, '(?i)[ACGTN]{12}'), true) AND coalesce(regexp_full_match(a, '(?i)[ACGT]{3,}N{5,}[ACGT]{3,}'), true)
    AND coalesce(regexp_full_match(r, '[+-]?[0-9]+(\.0+)?') AND coalesce(abs(TRY_CAST(regexp_extract(r, '^[+-]?[0-9]+') AS HUGEINT)) <= 2147483647, false), true)"""

_FAULTS = rf"""WITH r AS ({_ROWS})
  SELECT line_id, 'quotes' AS reason FROM r WHERE NOT sound UNION ALL
  SELECT line_id, 'columns' FROM r WHERE sound AND NOT coalesce(fits, false) UNION ALL
  SELECT line_id, 'index1seq' FROM r WHERE sound AND fits AND NOT regexp_full_match(i, '(?i)[ACGTN]{{12}}') UNION ALL
  SELECT line_id, 'adriftreadlinkerseq' FROM r WHERE sound AND fits AND NOT regexp_full_match(a, '(?i)[ACGT]{{3,}}N{{5,}}[ACGT]{{3,}}') UNION ALL
  SELECT line_id, 'replicate' FROM r WHERE sound AND fits AND NOT (regexp_full_match(r, '[+-]?[0-9]+(\.0+)?') AND coalesce(abs(TRY_CAST(regexp_extract(r, '^[+-]?[0-9]+') AS HUGEINT)) <= 2147483647, false))"""

SQL = {
    "p4_loaded": f"""WITH b AS (SELECT b.line_id, b.sheet, b.line_no, b.sound, len(b.cells) = len(h.names) AS fits, b.cells, h.names, b.cells[list_position(h.names, 'index1seq')] AS i,
    b.cells[list_position(h.names, 'adriftreadlinkerseq')] AS a, b.cells[list_position(h.names, 'replicate')] AS r
    FROM ({_CELLS}) b LEFT JOIN (SELECT sheet, list_transform(cells, lambda c: lower(trim(c))) AS names FROM ({_CELLS}) WHERE line_no = 1) h USING (sheet) WHERE line_no > 1)
  SELECT line_id, sheet, line_no, TRY_CAST(regexp_extract(r, '^[+-]?[0-9]+') AS INTEGER) AS replicate, {", ".join(f"nullif(cells[list_position(names, '{c}')], '') AS {c}" for c in _OPTIONAL)} FROM b WHERE {_VALID}""",
    "p4_found": _FAULTS,
    "sheet_status": rf"""WITH f AS (SELECT sheet, count(*) AS n FROM ({_FAULTS}) JOIN sampledata_lines USING (line_id) GROUP BY 1)
  SELECT sheet, count(*) FILTER (WHERE line_no IS NULL OR line_no > 1) AS n_rows, coalesce(max(n), 0) AS n_issues, CASE WHEN coalesce(max(n), 0) > 0 THEN 'FAILED' ELSE 'PASS' END AS status
  FROM sampledata_lines LEFT JOIN f USING (sheet) GROUP BY 1""",
    "p1_positions": _GROUPED,
    "p1_found": f"SELECT posid FROM ({_GROUPED}) WHERE n_rows * 100 >= (SELECT count(*) FROM known_sites)",
}
