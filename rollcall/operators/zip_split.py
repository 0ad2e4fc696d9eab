"""Splitting ZIP+4 into ZIP and suffix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.names import quoted

# Accepted names of the column, and what it becomes.
ZIP_NAMES = ("ZIP", "zip")
SPLIT_NAMES = ("zip", "plus4")


def zip_parts(c: Column) -> tuple[Column, Column]:
    """What stands before the first hyphen and between it and the next one."""
    pieces = F.split(F.regexp_replace(F.coalesce(c, F.lit("")), "\r", ""), "-")
    return F.get(pieces, F.lit(0)), F.coalesce(F.get(pieces, F.lit(1)), F.lit(""))


def split_zip_plus4(df: DataFrame) -> DataFrame:
    """Replace the first column called ``ZIP`` or ``zip`` by ``zip`` and ``plus4``, in place."""
    at = next((i for i, name in enumerate(df.columns) if name in ZIP_NAMES), None)
    if at is None:
        raise ValueError(f"no column called {' or '.join(ZIP_NAMES)}")
    others = [*df.columns[:at], *df.columns[at + 1 :]]
    taken = [name for name in others if name.lower() in SPLIT_NAMES]
    if taken:
        raise ValueError(f"columns in the way of the split: {taken}")
    zip_part, plus4 = zip_parts(F.col(quoted(df.columns[at])))
    before, after = others[:at], others[at:]
    return df.select(
        *[F.col(quoted(c)) for c in before],
        zip_part.alias(SPLIT_NAMES[0]),
        plus4.alias(SPLIT_NAMES[1]),
        *[F.col(quoted(c)) for c in after],
    )
