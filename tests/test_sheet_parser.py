import random
import re

import pyarrow as pa
import pytest

from sitewright.operators import sheet_parser as sp
from sitewright.session import table

HEADER = "trial\tindex1Seq\treplicate\tadriftReadLinkerSeq"
LINKER = "ACGTNNNNNACG"


def slow_cells(line):
    """The cells character by character, or None where the quoting is unsound."""
    line = line[:-1] if line.endswith("\r") else line
    cells, i = [], 0
    while True:
        cell = []
        if line[i : i + 1] == '"':
            i += 1
            while True:
                if i >= len(line):
                    return None
                if line[i] == '"':
                    if line[i + 1 : i + 2] == '"':
                        cell.append('"')
                        i += 2
                        continue
                    i += 1
                    break
                cell.append(line[i])
                i += 1
            if i < len(line) and line[i] != "\t":
                return None
        else:
            while i < len(line) and line[i] != "\t":
                if line[i] == '"':
                    return None
                cell.append(line[i])
                i += 1
        cells.append("".join(cell))
        if i >= len(line):
            return cells
        i += 1


def slow_reasons(line, names):
    cells = slow_cells(line)
    if cells is None:
        return ["quotes"]
    if len(cells) != len(names):
        return ["columns"]
    row = dict(zip(names, cells))
    bad = []
    if not re.fullmatch("[ACGTNacgtn]{12}", row["index1seq"]):
        bad.append("index1seq")
    if not re.fullmatch("(?i)[ACGT]{3,}N{5,}[ACGT]{3,}", row["adriftreadlinkerseq"]):
        bad.append("adriftreadlinkerseq")
    m = re.fullmatch(r"([+-]?[0-9]+)(\.0+)?", row["replicate"])
    if not m or abs(int(m[1])) > 2147483647:
        bad.append("replicate")
    return bad


def test_cells_agree_with_a_character_loop():
    rng = random.Random(5)
    lines = ["".join(rng.choice(['"', '"', "\t", "a", "é", "\r", "\n", " "]) for _ in range(rng.randrange(9))) for _ in range(4000)]
    lines += ["", '""', '"a""b"\t', "x" * 200_000, '"' + '""' * 50_000 + '"', None]
    array = pa.array([None, *lines], pa.string()).slice(1)
    sound, cells = sp.cut_cells(array, sp.np.zeros(len(lines), bool))
    for line, ok, got in zip(lines, sound, cells.to_pylist()):
        want = slow_cells(line or "")
        assert (got if ok else None) == want, (line, ok, got, want)


def test_reasons(spark):
    rows = [
        ("s", 1, "﻿" + HEADER + "\r"),
        ("s", 2, f"T\tACGTACGTACGT\t1\t{LINKER}"),
        ("s", 3, f'"T"\tacgtnacgtact\t-2147483647.00\t"{LINKER.lower()}"\r'),
        ("s", 4, f"T\tACGTACGTACGT\t2147483648\t{LINKER}"),
        ("s", 5, f"T\tACGTACGTACG\t1.5\tACNNNNNACG"),
        ("s", 6, f'T"\tACGTACGTACGT\t1\t{LINKER}\tmore'),
        ("s", 7, f"T\tACGTACGTACGT\t1"),
        ("s", 8, None),
        ("s", 9, ""),
        ("s", 10, f'"a\tb\n"\tACGTACGTACGT\t000000000000001\t{LINKER}'),
        ("s", 11, f"T\tACGTACGTACGT \t +1\t{LINKER}"),
        ("none", 2, f"T\tACGTACGTACGT\t1\t{LINKER}"),
        ("t", 1, 'replicate\t"Trial"\tadriftReadLinkerSeq\tindex1Seq'),
        ("t", 2, f"4\tT\t{LINKER}\tACGTACGTACGT"),
        ("t", 2, f"4\tT\t{LINKER}\tACGTACGTACGT"),
    ]
    df = spark.createDataFrame([(i, s, n, line, "x", "y") for i, (s, n, line) in enumerate(rows)], "line_id long, sheet string, line_no int, line string, cells string, reasons string")
    got = {}
    for r in sp.rejected_rows(df).collect():
        got.setdefault(r.line_id, set()).add(r.reason)
    assert got == {3: {"replicate"}, 4: {"index1seq", "replicate", "adriftreadlinkerseq"}, 5: {"quotes"}, 6: {"columns"}, 7: {"columns"}, 8: {"columns"}, 10: {"index1seq", "replicate"}, 11: {"columns"}}
    loaded = {r.line_id: r for r in sp.loaded_rows(df).collect()}
    assert set(loaded) == {1, 2, 9, 13, 14}
    assert loaded[2].replicate == -2147483647 and loaded[9].trial == "a\tb\n" and loaded[13].replicate == 4 and loaded[1].leaderseqhmm is None


def test_table(spark, sf):
    lines = table(spark, sf, "sampledata_lines")
    rows = lines.collect()
    names = {r.sheet: [x.lower() for x in slow_cells(r.line.removeprefix("﻿"))] for r in rows if r.line_no == 1}
    want = {(r.line_id, x) for r in rows if r.line_no > 1 for x in slow_reasons(r.line, names[r.sheet])}
    assert {tuple(r) for r in sp.rejected_rows(lines).collect()} == want
    assert sp.loaded_rows(lines).count() == sum(r.line_no > 1 for r in rows) - len({i for i, _ in want})


def test_empty(spark):
    df = spark.createDataFrame([], "line_id long, sheet string, line_no int, line string")
    assert sp.rejected_rows(df).count() == 0 and sp.loaded_rows(df).count() == 0


@pytest.mark.parametrize(("text", "value"), [("1", 1), ("+01.000", 1), ("-5", -5), ("1.", None), ("1e3", None), ("٣", None), ("", None), ("2147483647", 2147483647), ("-2147483648", None), ("1\n", None)])
def test_whole_number(spark, text, value):
    assert spark.createDataFrame([(text,)], "a string").select(sp.whole_number(sp.F.col("a")).alias("v")).first().v == value
