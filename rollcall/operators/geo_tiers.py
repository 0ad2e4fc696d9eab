"""Geographic targeting grids: flat geography per tier and a summary of the tiers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions.geo import GEO_TYPES, read_cell, slug
from rollcall.storage import materialize

# Grid rows that are ordered together; the label in force is carried from one band to the next.
BAND_ROWS = 10_000


@dataclass(frozen=True)
class GeoTiers:
    """Flat geography (``geo_value, geo_type, tier``) and states named by tier labels."""

    flat: DataFrame
    label_states: DataFrame


def read_cells(cells: DataFrame, header_rows: int = 1, compat: bool = False) -> DataFrame:
    """Cells below the header that are a tier label or geography, with what they say."""
    reading = F.array(read_cell(F.col("value"), compat))
    useful = F.filter(reading, lambda r: r["label"].isNotNull() | r["geo_type"].isNotNull())
    # A generator reads each cell once; a filter after a projection would read it twice.
    if "sheet_id" not in cells.columns:
        cells = cells.withColumn("sheet_id", F.col("sheet"))
    return cells.filter(F.col("row") >= header_rows).select(
        "sheet_id", "sheet", "row", "col", F.inline(useful)
    )


def fill_labels(cells: DataFrame, band_rows: int = BAND_ROWS) -> DataFrame:
    """Add ``current_label``: the latest label of the sheet in reading order, NULL before the first.

    Cells are ordered within bands of rows only. The last label of each band is folded before
    the shuffle, and one row per band is enough to carry it on, so a sheet of any size is
    spread over many tasks.
    """
    banded = cells.withColumn("band", F.floor(F.col("row") / band_rows))
    place = F.when(F.col("label").isNotNull(), F.struct("row", "col"))
    bands = banded.groupBy("sheet_id", "band").agg(F.max_by("label", place).alias("last_label"))
    before = (
        Window.partitionBy("sheet_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = bands.select(
        "sheet_id", "band", F.last("last_label", ignorenulls=True).over(before).alias("carried")
    )
    so_far = (
        Window.partitionBy("sheet_id", "band")
        .orderBy("row", "col")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    in_row = Window.partitionBy("sheet_id", "band", "row")
    return (
        banded.join(carried, ["sheet_id", "band"])
        .withColumn(
            "current_label",
            F.coalesce(F.last("label", ignorenulls=True).over(so_far), F.col("carried")),
        )
        .withColumn("row_has_zip", F.max(F.coalesce(F.col("geo_type") == "zip", F.lit(False))).over(in_row))
        .drop("band", "carried")
    )


def flatten_tiers(
    cells: DataFrame, header_rows: int = 1, compat: bool = False, band_rows: int = BAND_ROWS
) -> GeoTiers:
    """Flatten cells ``sheet, row, col, value`` (rows and columns from 0).

    Sheets of one name are told apart by ``sheet_id``, if there is one. Cells are read once: the
    useful ones are stored, and all further steps start from these.
    """
    read = materialize(read_cells(cells, header_rows, compat))
    tier = F.concat_ws("_", slug(F.col("sheet")), F.col("current_label"))
    filled = fill_labels(read, band_rows).withColumn("tier", tier)
    flat = (
        filled.filter(F.col("geo_type").isNotNull())
        # A three-digit prefix next to a ZIP only repeats it.
        .filter(~((F.col("geo_type") == "scf") & F.col("row_has_zip")))
        .select("geo_value", "geo_type", "tier")
        .distinct()
    )
    label_states = (
        read.filter(F.col("label_state").isNotNull())
        .select(F.concat_ws("_", slug(F.col("sheet")), F.col("label")).alias("tier"), "label_state")
        .distinct()
    )
    return GeoTiers(flat, label_states)


def sorted_flat(flat: DataFrame) -> DataFrame:
    return flat.orderBy("tier", "geo_type", "geo_value")


def _joined(values) -> object:
    return F.concat_ws(",", F.array_sort(F.collect_set(values)))


def tier_summary(tiers: GeoTiers) -> DataFrame:
    """Counts per tier, the states it covers and the states its label names."""
    counts = tiers.flat.groupBy("tier").agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col("geo_type") == kind).alias(f"{kind}_count") for kind in GEO_TYPES],
        _joined(F.when(F.col("geo_type") == "state", F.col("geo_value"))).alias("audience_states"),
    )
    labels = tiers.label_states.groupBy("tier").agg(_joined("label_state").alias("label_states"))
    return (
        counts.join(labels, "tier", "left")
        .na.fill("", ["audience_states", "label_states"])
        .orderBy(F.desc("row_count"), "tier")
    )


def tier_pivot(flat: DataFrame) -> DataFrame:
    """Rows of each geography type per tier, 0 where a tier has none."""
    return flat.groupBy("tier").pivot("geo_type", list(GEO_TYPES)).count().na.fill(0)


def geo_type_counts(flat: DataFrame) -> DataFrame:
    """Rows per geography type, and over how many tiers they spread."""
    return (
        flat.groupBy("geo_type")
        .agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("tier").alias("tiers"))
        .orderBy(F.desc("row_count"), "geo_type")
    )


def distinct_tiers(flat: DataFrame) -> DataFrame:
    return flat.agg(F.count_distinct("tier").alias("tiers"))
