"""Raw text lines of a file or folder, with the file they come from."""

from __future__ import annotations

import re
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Line columns: the text plus where it was read.
VALUE, FILE, BLOCK = "value", "file_path", "block_start"


def read_lines(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Lines as ``value, file_path, block_start``; ``glob`` restricts the file names."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    return reader.text(path).select(
        VALUE,
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
    )


def file_name(path: Column) -> Column:
    """Last part of a path as Spark reports it (percent-encoded)."""
    encoded = F.element_at(F.split(path, "/"), -1)
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def reader_path(path: str) -> str:
    """A path that Spark reports (percent-encoded) as its readers take it (a pattern)."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(path))


def file_stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def file_profile(lines: DataFrame) -> DataFrame:
    """First line and number of lines of every file.

    Lines are folded per file before the shuffle: one scan and a small exchange.
    """
    position = F.when(F.col(BLOCK) == 0, F.monotonically_increasing_id())
    return (
        lines.select(VALUE, FILE, position.alias("position"))
        .groupBy(FILE)
        .agg(F.min_by(VALUE, "position").alias("first_line"), F.count(F.lit(1)).alias("lines"))
    )


@dataclass(frozen=True)
class LineCounts:
    files: int
    lines: int


def first_line(lines: DataFrame, same_in_all_files: bool = True) -> tuple[str, LineCounts]:
    """First line of the first file by path; by default every file must start with it."""
    found = (
        file_profile(lines)
        .agg(
            F.min_by("first_line", FILE).alias("line"),
            F.min(F.struct("first_line", FILE)).alias("low"),
            F.max(F.struct("first_line", FILE)).alias("high"),
            F.count(F.lit(1)).alias("files"),
            F.sum("lines").alias("lines"),
        )
        .first()
    )
    if not found["lines"]:
        raise ValueError("no lines found in the input")
    low, high = found["low"], found["high"]
    if same_in_all_files and low["first_line"] != high["first_line"]:
        raise ValueError(
            f"header lines differ, for example in {low[FILE]} and {high[FILE]}: "
            f"{low['first_line'][:200]!r}, {high['first_line'][:200]!r}"
        )
    return found["line"], LineCounts(found["files"], found["lines"])
