"""Column expressions on identifiers and free strings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What counts as a blank: ASCII white space and the Unicode spaces, no-break space included.
BLANKS = r"[\s\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

#: The same, one by one.
BLANK_LETTERS = "\t\n\x0b\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip_blanks(c: Column) -> Column:
    """Remove outer blanks (tabs and no-break spaces included)."""
    return F.btrim(c, F.lit(BLANK_LETTERS))


def bind(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), where value is computed once however often f uses it."""
    return F.transform(F.array(value), f)[0]


def ascii_upper(c: Column) -> Column:
    """a-z to A-Z only; every other letter stays."""
    return F.translate(c, "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def normalize_id(c: Column) -> Column:
    """P10: trim, collapse blank runs to one `_`, ASCII upper case."""
    return ascii_upper(F.regexp_replace(strip_blanks(c), f"{BLANKS}+", "_"))


def valid_id(c: Column) -> Column:
    """P10: a normalised identifier that may be used as a key."""
    return F.coalesce(c.rlike(r"^[A-Z0-9_.\-]+\z") & (c != "NA"), F.lit(False))
