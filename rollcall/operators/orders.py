"""Order code and date columns for export files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Default file pattern, suffix of the output, names of the columns.
EXPORT_PATTERN = "*_OmitFile_Export_*.csv"
OUTPUT_SUFFIX = "_with_orders"
ORDER_CODE, ORDER_DATE = "OrderCode", "OrderDate"


def order_code(file_name: Column) -> Column:
    """File name up to the first underscore."""
    return F.substring_index(file_name, "_", 1)


def output_name(file_name: Column) -> Column:
    """File name with the suffix before its extension."""
    return F.regexp_replace(file_name, r"^(.+?)(\.[^.]*)?$", f"$1{OUTPUT_SUFFIX}$2")


def stamp_orders(df: DataFrame, file_name: Column, order_date: str | None = None) -> DataFrame:
    """Add (or replace) the order code of the file and the order date, today by default."""
    day = F.lit(order_date) if order_date else F.date_format(F.current_date(), "yyyy-MM-dd")
    return df.withColumns({ORDER_CODE: order_code(file_name), ORDER_DATE: day})
