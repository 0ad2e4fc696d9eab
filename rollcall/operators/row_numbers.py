"""Contiguous numbering of lines and rows without collecting them in one task.

Numbers follow from the position within a piece (an input split or a range of rows) and the sizes
of the pieces before it. Both passes need the same pieces, and Spark may split the same file
differently when it is read again, so the rows are stored before the first pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.sources.lines import BLOCK, FILE
from rollcall.storage import materialize

# Offsets (one row with a file path per input split) are broadcast up to this number of rows.
BROADCAST_ROWS = 100_000


def number_stored_lines(stored: DataFrame, name: str = "line_number") -> DataFrame:
    """Add the 1-based position of each line in its file, in the order of the splits.

    ``stored`` has to keep its partitions from one pass to the next, as :func:`materialize`
    makes sure; filters and projections of stored lines do too.
    """
    rows = stored.withColumn("_at", F.monotonically_increasing_id())
    earlier = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(
        rows.groupBy(FILE, BLOCK)
        .agg(F.min("_at").alias("first"), F.count(F.lit(1)).alias("size"))
        .select(
            FILE,
            BLOCK,
            (F.coalesce(F.sum("size").over(earlier), F.lit(0)) - F.col("first") + 1).alias("_shift"),
        )
    )
    if offsets.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    return (
        rows.join(offsets, [FILE, BLOCK])
        .withColumn(name, F.col("_at") + F.col("_shift"))
        .drop("_at", "_shift")
    )


def number_lines(lines: DataFrame, name: str = "line_number") -> DataFrame:
    """Add the 1-based position of each line in its file; the lines are read once and stored."""
    return number_stored_lines(materialize(lines), name)


def ordered_lines(df: DataFrame, *order: str) -> DataFrame:
    """Stored rows in the order of the given columns, as the splits of one file."""
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(ranges.withColumns({FILE: F.lit(""), BLOCK: F.spark_partition_id()}))


def number_rows(df: DataFrame, *order: str, name: str = "row_number") -> DataFrame:
    """Add the 1-based position of each row in the order of the given columns."""
    return number_stored_lines(ordered_lines(df, *order), name).drop(FILE, BLOCK)
