"""Writing results: Parquet, catalog tables, CSV, chunks and quarantined lines."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions.names import quoted
from rollcall.sources.lines import VALUE


def write_parquet(df: DataFrame, path: str) -> None:
    """Snappy Parquet; earlier output at the path is replaced."""
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def table_name(name: str) -> str:
    return ".".join(quoted(part.strip("`")) for part in name.split("."))


def _external_location(spark: SparkSession, table: str) -> str | None:
    """Location of an external Parquet table, None for any other table or view."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    # The details follow the columns, which may have the same names.
    details = {r["col_name"]: r["data_type"] for r in rows}
    if details.get("Type") == "EXTERNAL" and details.get("Provider", "").lower() == "parquet":
        return details.get("Location")
    return None


def register_table(spark: SparkSession, name: str, path: str) -> None:
    """Make ``name`` an external table over the Parquet files at ``path``.

    An external Parquet table of that name gets the new location if its schema is the same. If the
    schema differs, the new entry is made under another name before it takes the old one's place,
    so an entry that can't be made leaves the old one as it is. Files of the old table stay. Any
    other table or view of that name is an error.
    """
    table, stored = table_name(name), spark.read.parquet(path).schema
    if spark.catalog.tableExists(table):
        location = _external_location(spark, table)
        if location is None:
            raise ValueError(f"{name} exists and is no external Parquet table; it is left as it is")
        known = spark.table(table).schema
        same = [(f.name, f.dataType) for f in known] == [(f.name, f.dataType) for f in stored]
        if same:
            if _plain_path(location) != _plain_path(_qualified(spark, path)):
                spark.sql(f"ALTER TABLE {table} SET LOCATION {_sql_text(_qualified(spark, path))}")
            spark.catalog.refreshTable(table)
            return
        staged = table_name(f"{name.rstrip('`')}_{uuid.uuid4().hex[:12]}")
        spark.sql(f"CREATE TABLE {staged} USING parquet LOCATION {_sql_text(path)}")
        spark.sql(f"DROP TABLE {table}")
        spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
        return
    spark.sql(f"CREATE TABLE {table} USING parquet LOCATION {_sql_text(path)}")


def _sql_text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as the catalog stores it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(hadoop).toString()


def _plain_path(location: str) -> str:
    return re.sub(r"^file:/+", "file:/", location).rstrip("/")


def write_table(df: DataFrame, name: str, path: str, partition_keys: Sequence[str] = ()) -> None:
    """Write Parquet and its catalog entry in one step."""
    writer = df.write.mode("overwrite").format("parquet").option("compression", "snappy")
    if partition_keys:
        writer = writer.partitionBy(*partition_keys)
    writer.option("path", path).saveAsTable(table_name(name))


# Quotes are doubled, as spreadsheets and the import expect, and empty texts are left bare.
_CSV = {"header": True, "escape": '"', "emptyValue": ""}


def write_csv(df: DataFrame, path: str, rows_per_file: int | None = None) -> None:
    """CSV with a header in every file; ``rows_per_file`` bounds the rows of a file."""
    writer = df.write.mode("overwrite").options(**_CSV)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.csv(path)


def write_csv_by_name(df: DataFrame, name_column: str, path: str) -> None:
    """CSV with one sub-folder per value of ``name_column``, which is not written itself."""
    df.write.mode("overwrite").options(**_CSV).partitionBy(name_column).csv(path)


def write_chunks(lines: DataFrame, header: str, path: str) -> None:
    """Text chunks: one file per ``chunk_id`` (``position`` orders its lines), header line first.

    A chunk has a bounded number of lines, so one task can write it.
    """
    heads = lines.select("chunk_id").distinct().select(
        "chunk_id", F.lit(0).cast("bigint").alias("position"), F.lit(header).alias(VALUE)
    )
    body = lines.select("chunk_id", F.col("position").cast("bigint").alias("position"), VALUE)
    (
        body.unionByName(heads)
        .repartition("chunk_id")
        .sortWithinPartitions("chunk_id", "position")
        .select("chunk_id", VALUE)
        .write.mode("overwrite")
        .partitionBy("chunk_id")
        .text(path)
    )


def write_clean(lines: DataFrame, header: str, path: str) -> None:
    """Lines in the order of ``position`` as text files that follow one another by name.

    The header line comes first, at the head of the first file only.
    """
    head = lines.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("position"), F.lit(header).alias(VALUE))
    body = lines.select(F.col("position").cast("bigint").alias("position"), VALUE)
    ordered = body.unionByName(head).orderBy("position")
    ordered.select(VALUE).write.mode("overwrite").text(path)


def write_lines(df: DataFrame, path: str) -> None:
    """Lines of text (one string column)."""
    df.write.mode("overwrite").text(path)
