"""Header-driven import of delimited lists: every column a string, names from the header."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions.names import Header, quoted
from rollcall.functions.text import blank_to_null
from rollcall.sources.lines import VALUE, LineCounts, first_line, read_lines


def data_lines(lines: DataFrame, header: Header) -> DataFrame:
    """Lines other than the header, which every file of a folder may repeat."""
    return lines.filter(F.col(VALUE) != F.lit(header.line))


def parse_lines(
    lines: DataFrame, header: Header, keep: Iterable[str] = (), corrupt_column: str | None = None
) -> DataFrame:
    """Parse each line into the header's columns.

    Short lines are padded with NULL and surplus fields dropped; ``corrupt_column`` then holds
    the line as it was read, NULL for lines that fit. ``keep`` names line columns to carry along.
    """
    options = {"sep": header.delimiter, "quote": '"', "escape": '"'}
    ddl = header.ddl
    if corrupt_column:
        options["columnNameOfCorruptRecord"] = corrupt_column
        ddl += f", `{corrupt_column}` STRING"
    return lines.select(*keep, F.from_csv(VALUE, ddl, options).alias("_parsed")).select(
        *keep, "_parsed.*"
    )


def clean_columns(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Trim every string and turn blanks into NULL, in one projection."""
    wanted = set(df.columns if columns is None else columns)
    return df.select(
        *[
            blank_to_null(df[quoted(c)]).alias(c) if c in wanted else df[quoted(c)]
            for c in df.columns
        ]
    )


@dataclass(frozen=True)
class ImportedList:
    """An imported list, the lines that did not fit its header, and what was read."""

    rows: DataFrame
    misfits: DataFrame
    header: Header
    counts: LineCounts


def import_lines(lines: DataFrame, header: Header) -> DataFrame:
    """Cleaned rows of lines whose header is known."""
    return clean_columns(parse_lines(data_lines(lines, header), header))


def misfit_lines(lines: DataFrame, header: Header) -> DataFrame:
    """Lines with too few or too many fields (an open quote swallows some), as they were read."""
    column = "_misfit"
    while column in header.names:
        column = "_" + column
    kept = [c for c in lines.columns if c != VALUE and c not in header.names]
    parsed = parse_lines(data_lines(lines, header), header, keep=kept, corrupt_column=column)
    # The corrupt column cannot be read alone, so one data column stays in the projection.
    return (
        parsed.filter(F.col(column).isNotNull())
        .select(*kept, F.col(column).alias(VALUE))
    )


def import_list(
    spark: SparkSession,
    path: str | list[str],
    delimiter: str | None = None,
    same_header: bool = True,
) -> ImportedList:
    """Import a delimited file or folder. Quoted line breaks are not supported.

    One scan finds the header and checks that all files share it (``same_header``); parsing
    happens when the rows are used.
    """
    lines = read_lines(spark, path)
    line, counts = first_line(lines, same_header)
    header = Header.parse(line, delimiter)
    if data_lines(lines, header).isEmpty():
        raise ValueError("no data rows found after removing the header")
    return ImportedList(
        import_lines(lines, header), misfit_lines(lines, header), header, counts
    )
