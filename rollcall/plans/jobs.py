"""End-to-end jobs: what a scheduler would launch."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.operators.broken_rows import (
    CHUNK_ROWS,
    broken_lines,
    chunk_of,
    fits_header,
    good_lines,
    quarantine_text,
)
from rollcall.operators.geo_tiers import flatten_tiers, sorted_flat, tier_summary
from rollcall.operators.matching import MatchRules, match_with_sizes
from rollcall.operators.orders import EXPORT_PATTERN, output_name, stamp_orders
from rollcall.operators.reports import (
    counted,
    match_type_distribution,
    quality_report,
    score_distribution,
)
from rollcall.operators.zip_split import split_zip_plus4
from rollcall.sinks.files import (
    register_table,
    write_chunks,
    write_clean,
    write_csv,
    write_csv_by_name,
    write_lines,
    write_parquet,
    write_table,
)
from rollcall.sources.delimited import import_list
from rollcall.sources.exports import read_exports
from rollcall.sources.grid import read_grid
from rollcall.sources.lines import VALUE, first_line, read_lines
from rollcall.sources.tables import read_table
from rollcall.storage import materialize


# Rows of the sample in a job report.
SAMPLE_ROWS = 5


def column_mapping(mapping: Mapping[str, str] | str | None) -> dict[str, str] | None:
    """Mapping given as a dict or as JSON text."""
    if mapping is None or not isinstance(mapping, str):
        return dict(mapping) if mapping else None
    try:
        parsed = json.loads(mapping)
    except json.JSONDecodeError as error:
        raise ValueError(f"the column mapping is not valid JSON: {error}") from error
    if not isinstance(parsed, dict):
        raise ValueError("the column mapping has to be a JSON object")
    return parsed


@dataclass(frozen=True)
class JobReport:
    """What a job read and wrote; the frames read the written output."""

    counts: dict[str, int]
    output: DataFrame
    reports: dict[str, DataFrame]
    renamed: dict[str, str]
    duplicate_names: list[str]
    # Of a match: rows of the list and of the consumers, and pairs in the same block.
    sizes: dict[str, int] = field(default_factory=dict)


def import_job(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    output_table: str | None = None,
    delimiter: str | None = None,
    partition_keys: tuple[str, ...] = (),
) -> JobReport:
    """Import a list, write it as Parquet (and table) and check its quality."""
    imported = import_list(spark, input_path, delimiter)
    rows, seen = counted(imported.rows, "imported")
    if output_table:
        write_table(rows, output_table, output_path, partition_keys)
    else:
        write_parquet(rows, output_path)
    output = spark.read.parquet(output_path)
    header = imported.header
    return JobReport(
        {
            "files": imported.counts.files,
            "lines": imported.counts.lines,
            "imported": seen.get["rows"],
        },
        output,
        {
            "quality": quality_report(output),
            "misfits": imported.misfits,
            "sample": output.limit(SAMPLE_ROWS),
        },
        dict(zip(header.original, header.names)),
        header.duplicate_safe_names,
    )


def _write_matches(
    spark: SparkSession, matches: DataFrame, counts: dict[str, int], output_path: str,
    output_table: str | None, renamed: dict[str, str], duplicates: list[str], sizes: dict[str, int],
) -> JobReport:
    """Evaluate the match once, into the output; the reports read it back."""
    rows, seen = counted(matches, "matched")
    write_parquet(rows, output_path)
    if output_table:
        register_table(spark, output_table, output_path)
    output = spark.read.parquet(output_path)
    return JobReport(
        {**counts, "matched": seen.get["rows"]},
        output,
        {
            "match_types": match_type_distribution(output),
            "scores": score_distribution(output),
            "sample": output.limit(SAMPLE_ROWS),
        },
        renamed,
        duplicates,
        sizes,
    )


def _rules(rules: MatchRules | None, threshold: int | None) -> MatchRules:
    """The rules, with another threshold only if one is given."""
    rules = rules or MatchRules()
    return rules if threshold is None else replace(rules, threshold=int(threshold))


def import_and_match_job(
    spark: SparkSession,
    input_path: str,
    match_table: str,
    output_path: str,
    output_table: str | None = None,
    threshold: int | None = None,
    mapping: Mapping[str, str] | str | None = None,
    delimiter: str | None = None,
    state: str | None = None,
    rules: MatchRules | None = None,
    state_exact: bool = False,
) -> JobReport:
    """Import a list and match it to a consumer table in one go.

    The import is stored once, so that sizing the blocks reads three columns and not the text.
    ``state_exact`` compares stored states as they are, which the scan can skip by.
    """
    rules = _rules(rules, threshold)
    imported = import_list(spark, input_path, delimiter)
    people, consumers = materialize(imported.rows), read_table(spark, match_table)
    source = column_mapping(mapping)
    matches, sizes = match_with_sizes(people, consumers, source, rules, state, imported.header, state_exact)
    header = imported.header
    counts = {"files": imported.counts.files, "lines": imported.counts.lines}
    return _write_matches(
        spark, matches, counts, output_path, output_table,
        dict(zip(header.original, header.names)), header.duplicate_safe_names, sizes,
    )


def match_tables_job(
    spark: SparkSession,
    input_table: str,
    match_table: str,
    output_path: str,
    output_table: str | None = None,
    threshold: int | None = None,
    mapping: Mapping[str, str] | str | None = None,
    state: str | None = None,
    rules: MatchRules | None = None,
    state_exact: bool = False,
) -> JobReport:
    """Match a table of people to a consumer table."""
    rules = _rules(rules, threshold)
    people, consumers = read_table(spark, input_table), read_table(spark, match_table)
    source = column_mapping(mapping)
    matches, sizes = match_with_sizes(people, consumers, source, rules, state, state_exact=state_exact)
    return _write_matches(spark, matches, {}, output_path, output_table, {}, [], sizes)


def geo_tiers_job(spark: SparkSession, grid_path: str, output_folder: str, stem: str,
                  compat: bool = False) -> tuple[str, str]:
    """Flatten the sheets of a folder into a flat file and a summary named after ``stem``."""
    tiers = flatten_tiers(read_grid(spark, grid_path), compat=compat)
    flat_path = f"{output_folder}/{stem}_flattened.csv"
    summary_path = f"{output_folder}/{stem}_tier_summary.csv"
    write_csv(sorted_flat(tiers.flat), flat_path)
    # The summary reads the flat rows back instead of flattening again.
    flat = spark.read.option("header", True).csv(flat_path)
    write_csv(tier_summary(replace(tiers, flat=flat)), summary_path)
    return flat_path, summary_path


def clean_and_chunk_job(
    spark: SparkSession,
    input_path: str,
    output_folder: str,
    stem: str,
    chunk_rows: int = CHUNK_ROWS,
    separator: str = ",",
    quote_aware: bool = False,
) -> dict[str, str]:
    """Set broken lines of one file aside; write the others in order, and in chunks with a header each."""
    lines = read_lines(spark, input_path)
    header, counts = first_line(lines)
    if counts.files != 1:
        raise ValueError("chunks are cut from one file at a time")
    paths = {
        "bad_rows": f"{output_folder}/{stem}_bad_rows.log",
        "clean": f"{output_folder}/{stem}_clean",
        "parts": f"{output_folder}/{stem}_parts",
    }
    fits = fits_header(F.col(VALUE), header, separator, quote_aware)
    # Both passes over the lines, and both outputs, read what is stored here.
    stored = materialize(lines)
    write_lines(quarantine_text(broken_lines(stored, fits)), paths["bad_rows"])
    chunk = chunk_of(F.col("position"), chunk_rows).alias("chunk_id")
    good = good_lines(stored, fits).select("position", VALUE, chunk)
    write_clean(good, header, paths["clean"])
    write_chunks(good, header, paths["parts"])
    return paths


def split_zip_job(spark: SparkSession, input_path: str, output_path: str) -> None:
    """Rewrite a CSV file with its ZIP+4 column split; header names are kept as they are."""
    rows = (
        spark.read.option("header", True).option("escape", '"').option("inferSchema", False)
        .csv(input_path)
        .na.fill("")
    )
    write_csv(split_zip_plus4(rows), output_path)


def stamp_orders_job(
    spark: SparkSession,
    input_folder: str,
    output_folder: str,
    pattern: str = EXPORT_PATTERN,
    order_date: str | None = None,
) -> list[str]:
    """Stamp order columns on the export files of a folder, one sub-folder per layout and file."""
    written = []
    for number, (_, rows) in enumerate(read_exports(spark, input_folder, pattern)):
        name = F.col("_file_name")
        stamped = stamp_orders(rows, name, order_date).withColumn("file", output_name(name))
        path = f"{output_folder}/layout={number}"
        write_csv_by_name(stamped.drop("_file_name"), "file", path)
        written.append(path)
    return written
