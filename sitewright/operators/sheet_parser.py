"""Parsing of tab-separated sheets in which some rows are broken.

Each Arrow batch is indexed structurally: numpy masks mark the quotes, the parity of the quotes
before a byte tells whether a tab separates cells, and the cells are cut out of the batch's own byte
buffer. There is no loop over rows or characters. Counts and types are then checked by column
expressions, so that a row either becomes a valid record or a row with its reasons.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TAB, QUOTE, CR = 9, 34, 13
BOM = (0xEF, 0xBB, 0xBF)


def cut_cells(lines: pa.Array, is_header: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Whether each line's quoting is sound, and its unquoted cells (null for an unsound or null line)."""
    lines = pa.concat_arrays([lines.fill_null("").cast(pa.large_string()), pa.array([], pa.large_string())])  # offset 0
    n = len(lines)
    offsets = np.frombuffer(lines.buffers()[1], np.int64, n + 1)
    data = lines.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    begin, full_end = offsets[:-1].copy(), offsets[1:]
    padded = np.concatenate([buf, np.zeros(3, np.uint8)])
    end = full_end - ((full_end > begin) & (padded[np.maximum(full_end - 1, 0)] == CR))
    marked = is_header & (padded[begin] == BOM[0]) & (padded[np.minimum(begin + 1, len(buf))] == BOM[1]) & (padded[np.minimum(begin + 2, len(buf) + 1)] == BOM[2])
    begin += 3 * marked

    quotes = np.flatnonzero(buf == QUOTE)
    owner = np.searchsorted(full_end, quotes, side="right")
    first_quote = np.searchsorted(quotes, offsets)
    opening = (np.arange(len(quotes)) - first_quote[owner]) % 2 == 0
    before = np.where(quotes > begin[owner], padded[np.maximum(quotes - 1, 0)], TAB)
    after = np.where(quotes + 1 < end[owner], padded[quotes + 1], TAB)
    # an opening quote stands at a cell's start, or right after a closing one (an escaped quote);
    # a closing one stands at a cell's end, or right before an opening one
    unsound = np.where(opening, (before != TAB) & (before != QUOTE), (after != TAB) & (after != QUOTE))
    sound = np.ones(n, bool)
    sound[owner[unsound]] = False
    sound &= np.diff(first_quote) % 2 == 0

    tabs = np.flatnonzero(buf == TAB)
    tab_owner = np.searchsorted(full_end, tabs, side="right")
    outside = (np.searchsorted(quotes, tabs) - first_quote[tab_owner]) % 2 == 0
    splits = tabs[outside & sound[tab_owner] & (tabs >= begin[tab_owner])]

    keep = np.zeros(len(buf) + 1, np.int32)
    np.add.at(keep, begin[sound], 1)
    np.add.at(keep, end[sound], -1)
    keep = np.cumsum(keep)[:-1].astype(bool)
    keep[splits] = False
    keep[quotes[~opening]] = False
    keep[quotes[opening & (before != QUOTE)]] = False
    kept = np.concatenate([[0], np.cumsum(keep)])
    split_owner = np.searchsorted(full_end, splits, side="right")
    cells = np.where(sound, 1 + np.bincount(split_owner, minlength=n), 0)
    bounds = np.sort(np.concatenate([end[sound], splits]))
    cell_offsets = np.concatenate([[0], kept[bounds]]).astype(np.int32)
    values = pa.StringArray.from_buffers(len(bounds), pa.py_buffer(cell_offsets.tobytes()), pa.py_buffer(buf[keep].tobytes()))
    list_offsets = pa.array(np.concatenate([[0], np.cumsum(cells)]).astype(np.int32), mask=np.concatenate([~sound, [False]]))
    return sound, pa.ListArray.from_arrays(list_offsets, values)


def _index_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        number = b.column("line_no").fill_null(0).to_numpy(zero_copy_only=False)
        lines = b.column("line")
        sound, cells = cut_cells(lines, number == 1)
        missing = lines.is_null().to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([b.column("line_id"), b.column("sheet"), b.column("line_no"), pa.array(sound & ~missing, mask=missing), cells], ["line_id", "sheet", "line_no", "sound", "cells"])


def parse_lines(lines: DataFrame) -> DataFrame:
    """line_id, sheet, line_no, sound, cells of each line; cells is null where the quoting is unsound."""
    return lines.select("line_id", "sheet", "line_no", "line").mapInArrow(_index_batches, "line_id long, sheet string, line_no int, sound boolean, cells array<string>")


def whole_number(c: Column) -> Column:
    """ASCII digits with an optional sign and an optional zero fraction, as int; null for anything else."""
    digits = F.regexp_replace(F.regexp_extract(c, r"^[+-]?([0-9]+)(?:\.0+)?\z", 1), "^0+(?=.)", "")
    size = F.when((digits != "") & (F.length(digits) <= 10), digits.cast("long"))
    return F.when(size <= 2147483647, F.when(c.startswith("-"), -size).otherwise(size).cast("int"))


def sheet_rows(lines: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Each line after its sheet's header as a map of its cells (`cell`) with its faults (`reasons`).

    checks: reason -> condition that holds for a valid row, over the column `cell`, a map from the
    header's lower-case names to the row's cells. reasons is an empty array for a valid row, `quotes`
    or `columns` alone for a row that has no cells to check, else every check that fails.

    A null line, and any line of a sheet without a sound header, cannot be told apart from a wrong
    number of cells: `columns`. A repeated header counts once, the one with the least line_id. An
    empty line is one empty cell. A check over a column that the sheet lacks sees null and passes. The
    sheet is the key of an equi-join with one header row each, so that adaptive execution may split a crowded
    one; no sheet is gathered.
    """
    # the lines are split before the kernel, through which Catalyst pushes no filter
    header = (
        parse_lines(lines.where("line_no = 1"))
        .groupBy("sheet")
        .agg(F.min_by("cells", "line_id").alias("names"))
        .select("sheet", F.transform("names", lambda x: F.lower(F.trim(x))).alias("names"))
    )
    rows = parse_lines(lines.where("line_no is null or line_no > 1")).join(header, "sheet", "left")
    fits = F.coalesce(F.size("cells") == F.size("names"), F.lit(False))
    rows = rows.withColumn("cell", F.when(fits, F.map_from_entries(F.array_distinct(F.arrays_zip(F.col("names").alias("key"), F.col("cells").alias("value"))))))
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(True)), F.lit(reason)) for reason, ok in checks.items()]))
    reasons = F.when(~F.coalesce("sound", F.lit(True)), F.array(F.lit("quotes"))).when(~fits, F.array(F.lit("columns"))).otherwise(failed)
    return rows.select("line_id", "sheet", "line_no", "cell", reasons.alias("reasons"))


def sample_sheet_checks() -> dict[str, Column]:
    """What makes a row of a sample sheet loadable."""
    cell = lambda name: F.col("cell")[name]
    return {
        "index1seq": cell("index1seq").rlike(r"(?i)^[ACGTN]{12}\z"),
        "adriftreadlinkerseq": cell("adriftreadlinkerseq").rlike(r"(?i)^[ACGT]{3,}N{5,}[ACGT]{3,}\z"),
        "replicate": F.when(cell("replicate").isNotNull(), whole_number(cell("replicate")).isNotNull()),
    }


def rejected_rows(lines: DataFrame) -> DataFrame:
    """line_id and reason: one row for each fault of a sample-sheet line."""
    return sheet_rows(lines, sample_sheet_checks()).select("line_id", F.explode("reasons").alias("reason"))


def loaded_rows(lines: DataFrame) -> DataFrame:
    """The valid rows of sample sheets with typed columns; a missing or empty optional cell is null."""
    ok = sheet_rows(lines, sample_sheet_checks()).where(F.size("reasons") == 0)
    cell = lambda name: F.when(F.col("cell")[name] != "", F.col("cell")[name])
    names = ("trial", "subject", "sample", "index1Seq", "adriftReadLinkerSeq", "refGenome", "leaderSeqHMM", "vectorFastaFile", "mode")
    return ok.select("line_id", "sheet", "line_no", whole_number(F.col("cell")["replicate"]).alias("replicate"), *[cell(n.lower()).alias(n.lower()) for n in names])


def sheet_report(lines: DataFrame) -> DataFrame:
    """K9: per sheet its sample rows, its issues and FAILED or PASS; a sheet of a header alone has no rows and no issues."""
    rows = sheet_rows(lines, sample_sheet_checks()).groupBy("sheet").agg(F.count("*").alias("n_rows"), F.sum(F.size("reasons")).alias("n_issues"))
    heads = lines.where("line_no = 1").select("sheet", F.lit(0).cast("long").alias("n_rows"), F.lit(0).cast("long").alias("n_issues"))
    both = rows.union(heads).groupBy("sheet").agg(F.max("n_rows").alias("n_rows"), F.max("n_issues").alias("n_issues"))
    return both.withColumn("status", F.when(F.col("n_issues") > 0, "FAILED").otherwise("PASS"))
