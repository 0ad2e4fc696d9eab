"""Export files of a folder, chosen by a name pattern."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions.names import Header, quoted
from rollcall.operators.orders import EXPORT_PATTERN
from rollcall.sources.delimited import data_lines, parse_lines
from rollcall.sources.lines import FILE, file_name, file_profile, read_lines, reader_path

def read_exports(
    spark: SparkSession, folder: str, pattern: str = EXPORT_PATTERN
) -> Iterator[tuple[Header, DataFrame]]:
    """Rows of the matching files, all strings, one DataFrame per header line.

    Each has the header's columns under their original names and ``_file_name``. Every file is
    read twice, for its header line and for its rows, however many layouts there are.
    """
    try:
        lines = read_lines(spark, folder, pattern)
    except AnalysisException as missing:
        raise FileNotFoundError(f"{folder} cannot be read") from missing
    files = F.array_sort(F.collect_list(FILE)).alias("files")
    layouts = file_profile(lines).groupBy("first_line").agg(files).orderBy("first_line")
    found = False
    # Header lines and file names only, one layout at a time.
    for first_line, paths in layouts.toLocalIterator():
        found = True
        header = Header.parse(first_line)
        mine = read_lines(spark, [reader_path(path) for path in paths])
        named = mine.withColumnRenamed(FILE, "_rc_file")
        parsed = parse_lines(data_lines(named, header), header, keep=["_rc_file"])
        yield header, parsed.select(
            *[F.col(quoted(safe)).alias(raw) for safe, raw in zip(header.names, header.original)],
            file_name(F.col("_rc_file")).alias("_file_name"),
        )
    if not found:
        raise FileNotFoundError(f"no files in {folder} match {pattern}")
