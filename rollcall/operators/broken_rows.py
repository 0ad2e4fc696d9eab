"""Lines whose number of fields differs from the header's, and chunks of the others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.operators.row_numbers import number_stored_lines
from rollcall.sources.lines import VALUE

# Data rows per chunk unless told otherwise.
CHUNK_ROWS = 100_000


def field_count(line: Column, separator: str = ",", quote_aware: bool = False) -> Column:
    """Fields of a line; 0 for an empty one. Quotes are ignored unless ``quote_aware``."""
    bare = F.regexp_replace(line, '"[^"]*("|$)', "q") if quote_aware else line
    fields = F.size(F.split(bare, "\\Q" + separator + "\\E", -1))
    return F.when(line == "", F.lit(0)).otherwise(fields)


def fits_header(
    line: Column, header: str, separator: str = ",", quote_aware: bool = False
) -> Column:
    """True when a line has as many fields as the header."""
    return field_count(line, separator, quote_aware) == field_count(
        F.lit(header), separator, quote_aware
    )


def broken_lines(stored: DataFrame, fits: Column) -> DataFrame:
    """Lines of stored files that do not fit, with their line number in the file."""
    return number_stored_lines(stored).filter(~fits)


def good_lines(stored: DataFrame, fits: Column) -> DataFrame:
    """Data lines of stored files that fit, with their position among these in the file."""
    # The header fits itself and comes first, so it takes the number 1.
    return (
        number_stored_lines(stored.filter(fits), "position")
        .filter(F.col("position") > 1)
        .withColumn("position", F.col("position") - 1)
    )


def quarantine_text(broken: DataFrame) -> DataFrame:
    """Broken lines as ``Line <number>: <content>``."""
    entry = F.format_string("Line %d: %s", F.col("line_number"), F.col(VALUE))
    return broken.select(entry.alias(VALUE))


def chunk_of(position: Column, chunk_rows: int = CHUNK_ROWS) -> Column:
    """Chunk, from 0, of a 1-based position."""
    if chunk_rows < 1:
        raise ValueError("a chunk has at least one row")
    return F.floor((position - 1) / chunk_rows)
