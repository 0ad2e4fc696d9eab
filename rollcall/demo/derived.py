"""People, consumers, list lines and sheet cells derived from the benchmark tables.

The tables hold no people, so names, addresses and ZIPs are computed from their keys. The
expressions use only functions that Spark and an ANSI database share, so that the same text
describes the inputs of a query and of its SQL counterpart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_FIRST = "John,Mary,Robert,Barbara,Ann,Joanne,James,Catherine,Katherine,Jon,Beverly,Rev. Paul,Martha,Bob,Linda,St. John,Mark"
_LAST = (
    "Smith,Smyth,Straiton,Straitor,Johnson,Johnsson,Smith-Jones,Jones,De La Cruz,Cruz,Lee,O''Brien,"
    "Van Der Berg,Quill,Miller,Muller,Brown,Browne,Garcia,Wright,Knight,Thompson,Schmidt"
)
_STREETS = "Main,Maine,Elm,Oak,N Oak,Hill,Lake View,St James,Mt Vernon,First,Park,Church,Mill"
_KINDS = "St,Rd,Ave,Dr,Blvd"
_STATES = "OH,MI,RI,WV"


def _pick(words: str, key: str) -> str:
    count = words.count(",") + 1
    return f"split_part('{words}', ',', CAST({key} % {count} AS INT) + 1)"


def _person(key: str) -> list[str]:
    """A person per key; two neighbouring keys share a household, twenty a ZIP."""
    home = f"CAST(floor({key} / 2) AS BIGINT)"
    return [
        f"{_pick(_FIRST, key)} AS first_base",
        f"{_pick(_LAST, home)} AS last_base",
        f"CAST({home} % 900 + 100 AS STRING) AS house",
        f"{_pick(_STREETS, home)} AS street_base",
        f"{_pick(_KINDS, home)} AS kind",
        f"{_pick(_STATES, f'CAST(floor({key} / 20) AS BIGINT)')} AS state_base",
        f"CASE WHEN {key} % 97 <> 0 THEN CAST(CAST(floor({key} / 20) AS BIGINT) AS STRING) END AS zip_base",
        f"CASE {home} % 3 WHEN 0 THEN '12' WHEN 1 THEN '0034' END AS zip4_base",
    ]


# One consumer per customer.
CONSUMER_BASE = ["c_custkey", *_person("c_custkey")]
CONSUMER = [
    "c_custkey AS id",
    "first_base AS first_name",
    "last_base AS last_name",
    "house || ' ' || street_base || ' ' || kind AS address",
    "state_base AS state",
    "zip_base AS zip",
    "zip4_base AS zip4",
]

# One list row per order, most of them with a slip of some kind.
LIST_BASE = ["o_orderkey", "o_orderkey % 13 AS slip", *_person("o_custkey")]
LIST = [
    "CAST(o_orderkey AS STRING) AS finder_number",
    """CASE slip WHEN 1 THEN upper(first_base)
       WHEN 2 THEN substring(first_base, 1, length(first_base) - 1)
       WHEN 3 THEN 'Zed' WHEN 4 THEN '  ' || first_base || ' ' WHEN 5 THEN NULL
       ELSE first_base END AS firstname""",
    """CASE slip WHEN 6 THEN last_base || '-Jones' WHEN 7 THEN last_base || '  JR'
       WHEN 9 THEN 'Quill' ELSE last_base END AS lastname""",
    """CASE slip WHEN 8 THEN street_base || ' ' || kind || ' ' || house
       WHEN 9 THEN house || ' ' || street_base || ' ' || kind || 'reet'
       WHEN 10 THEN house || '1 ' || street_base || ' ' || kind
       WHEN 11 THEN house || ' ' || street_base || ' ' || kind || ' Apt 4'
       ELSE house || ' ' || street_base || ' ' || kind END AS street""",
    "CASE WHEN slip = 3 THEN 'Berne North' ELSE 'Adams' END AS city",
    "CASE WHEN slip = 2 THEN lower(state_base) ELSE state_base END AS state",
    """CASE slip WHEN 11 THEN lpad(zip_base, 5, '0') || '-1234' WHEN 12 THEN '  '
       ELSE zip_base END AS zipcode""",
    "CASE WHEN slip = 10 THEN lpad(zip4_base, 4, '0') ELSE zip4_base END AS plus4",
]
MAPPING = {
    "first_name": "firstname",
    "last_name": "lastname",
    "address": "street",
    "city": "city",
    "state": "state",
    "zip": "zipcode",
    "zip4": "plus4",
}

# The list as text lines under a header that needs cleaning.
HEADER = "FINDER NUMBER,FIRST NAME,Last Name,1st_address,city,,ZIP,zip"
HEADER_NAMES = ["finder_number", "first_name", "last_name", "_1st_address", "city", "col_6", "zip", "zip_2"]
_FIELDS = ["finder_number", "firstname", "lastname", "street", "city", "state", "zipcode", "plus4"]
LINE = "concat_ws(','," + ", ".join(f"coalesce({f}, '')" for f in _FIELDS) + ")"
LINES = ["CAST(finder_number AS BIGINT) AS line_key", f"{LINE} AS value"]

# The same lines with some of them damaged.
DAMAGED_BASE = ["CAST(finder_number AS BIGINT) AS line_key", "finder_number", "street", f"{LINE} AS line"]
DAMAGED_LINES = [
    "line_key",
    """CASE line_key % 11 WHEN 3 THEN finder_number || ',' || street WHEN 5 THEN line || ',x'
       WHEN 7 THEN '' WHEN 9 THEN replace(line, 'Adams', '"Adams, N"') ELSE line END AS value""",
]

# ZIP and suffix in one column, under the name the split looks for.
ZIP_LIST = [
    "finder_number",
    """CASE CAST(finder_number AS BIGINT) % 5 WHEN 0 THEN zipcode
       WHEN 1 THEN coalesce(zipcode, '') || '-' || coalesce(plus4, '')
       WHEN 2 THEN zipcode || '-1-2' WHEN 3 THEN '' ELSE zipcode || '-' || plus4 END AS ZIP""",
    "state",
]

# Rows of export files.
EXPORT_ROWS = [
    "o_orderkey",
    """CASE WHEN o_orderkey % 10 = 9 THEN 'other.csv'
       ELSE 'QB' || CAST(o_orderkey % 7 + 100 AS STRING) || '_OmitFile_Export_1125.csv'
       END AS file_name""",
]

# A sheet per nation, four cells per row.
CELLS = [
    "'Tier ' || CAST(c_nationkey AS STRING) || ' (US)' AS sheet",
    "CAST(floor(c_custkey / 4) AS BIGINT) AS row",
    "CAST(c_custkey % 4 AS INT) AS col",
    """CASE CAST(floor(c_custkey / 3) AS BIGINT) % 19
       WHEN 0 THEN 'Tier 1 OH - Non-Lucas Co. Ohio'
       WHEN 1 THEN 'Tier ' || CAST(c_custkey % 3 AS STRING) || ' MI- balance of Michigan'
       WHEN 2 THEN 'all zips in Rhode Island' WHEN 3 THEN 'balance of West Virginia'
       WHEN 4 THEN 'mi' WHEN 5 THEN 'NaN' WHEN 6 THEN '  ' WHEN 7 THEN 'see notes'
       WHEN 8 THEN 'frontier - x' WHEN 9 THEN 'Tier A'
       WHEN 10 THEN lpad(CAST(c_custkey % 990 AS STRING), 3, '0')
       WHEN 11 THEN lpad(CAST(c_custkey % 990 AS STRING), 3, '0')
       WHEN 12 THEN ' OR ' WHEN 13 THEN 'balance of LUCAS CO. OHIO' WHEN 14 THEN NULL
       WHEN 15 THEN chr(9) || lpad(CAST(c_custkey % 89989 AS STRING), 5, '0')
       WHEN 16 THEN 'MI' || chr(160)
       WHEN 17 THEN lpad(CAST(c_custkey % 79999 AS STRING), 5, '0') || chr(160) || chr(10)
       ELSE lpad(CAST(c_custkey * 7 % 99991 AS STRING), 5, '0') END AS value""",
]


def sql(table: str, *steps: Sequence[str]) -> str:
    """The SQL text of a chain of projections over a table."""
    text = table
    for step in steps:
        text = f"(SELECT {', '.join(step)} FROM {text})"
    return text


def frame(spark: SparkSession, folder: str, table: str, *steps: Sequence[str]) -> DataFrame:
    """The same chain as a DataFrame."""
    df = spark.read.parquet(f"{folder}/{table}.parquet")
    for step in steps:
        df = df.selectExpr(*step)
    return df


def consumers(spark: SparkSession, folder: str) -> DataFrame:
    return frame(spark, folder, "customer", CONSUMER_BASE, CONSUMER)


def people(spark: SparkSession, folder: str) -> DataFrame:
    return frame(spark, folder, "orders", LIST_BASE, LIST)
