"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Every white-space character, the same set `str.strip` removes.
_BLANK = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())


def strip(column: Column) -> Column:
    """Remove white space of any kind at both ends (plain `trim` would drop spaces only)."""
    return F.btrim(column.cast("string"), F.lit(_BLANK))


def normalize(column: Column) -> Column:
    """Strip and lower-case; null stays null."""
    return F.lower(strip(column))
