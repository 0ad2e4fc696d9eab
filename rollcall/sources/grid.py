"""Sheets as a grid of cells: one delimited file per sheet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.operators.row_numbers import number_lines
from rollcall.sources.lines import FILE, VALUE, file_stem, read_lines

# A comma outside quotes: an even number of quotes follows.
_SEPARATOR = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def lines_to_cells(numbered: DataFrame) -> DataFrame:
    """Cells (rows and columns from 0) of lines ``sheet, row, value``; other columns stay."""
    others = [c for c in numbered.columns if c not in ("row", VALUE)]
    cells = numbered.select(
        *others, "row", F.posexplode(F.split(VALUE, _SEPARATOR, -1)).alias("col", "field")
    )
    field = F.trim("field")
    inner = F.replace(F.expr("substring(trim(field), 2, length(trim(field)) - 2)"), F.lit('""'), F.lit('"'))
    return cells.select(
        *others, "row", "col", F.when(field.rlike('^".*"$'), inner).otherwise(F.col("field")).alias("value")
    )


def read_grid(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Cells of every sheet file; the sheet is named like its file without extension.

    ``sheet_id`` is the path: files of one name in two folders are two sheets.
    """
    numbered = number_lines(read_lines(spark, path))
    return lines_to_cells(
        numbered.select(
            F.col(FILE).alias("sheet_id"),
            file_stem(F.col(FILE)).alias("sheet"),
            (F.col("line_number") - 1).alias("row"),
            VALUE,
        )
    )
