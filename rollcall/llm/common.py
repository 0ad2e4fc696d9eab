"""What several operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StringType, StructType

from rollcall.storage import checkpoint_dir

#: Characters between words, as a Java and RE2 character class body.
BLANKS = r"\x20\x09-\x0D"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the folder; the path is only ever opened by Spark."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_path(spark: SparkSession, what: str) -> str:
    """A new path below the checkpoint directory, which all executors share."""
    return f"{checkpoint_dir(spark)}/{what}-{uuid.uuid4().hex}"


def landed(df: DataFrame, what: str, **options: int) -> DataFrame:
    """``df`` written once as Parquet to the shared folder, with options of the writer, and read back."""
    path = shared_path(df.sparkSession, what)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of an action go when it ends, not when the driver collects garbage.

    For steps that store what they need again: an action that reads such files later runs their stages anew.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not use yet, in any case."""
    used = {c.lower() for c in df.columns}
    while wanted.lower() in used:
        wanted += "_"
    return wanted


#: Rows of the batches in which texts go to Python and back; by default they are sized for numbers.
TEXT_ROWS = 2_000


def small_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches by ``TEXT_ROWS``, unless they are smaller already."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= TEXT_ROWS:
        spark.conf.set(key, str(TEXT_ROWS))


def texts(documents: DataFrame) -> DataFrame:
    """Only doc_id and text, so that other columns never clash."""
    small_batches(documents.sparkSession)
    return documents.select(F.col("doc_id"), F.col("text"))


def bound(value: Column, of) -> Column:
    """``of(value)`` with ``value`` computed once, though ``of`` uses it several times."""
    return F.transform(F.array(value), of)[0]


#: What a scanner finds in one text, in order of start, then kind, then end. ``base`` findings are
#: those of the plain patterns.
FINDINGS = StructType().add(
    "found",
    ArrayType(
        StructType()
        .add("kind", StringType())
        .add("start", LongType())
        .add("end", LongType())
        .add("base", BooleanType())
        .add("score", DoubleType())
        .add("layers", StringType())
    ),
)


def span_digests(scanned: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """doc_id, n_<kind>, base_sha256 and spans of (doc_id, found)."""
    base = F.filter("found", lambda f: f["base"])

    def joined(found: Column) -> Column:
        return F.concat_ws(",", F.transform(found, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])))

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")

    digest = F.sha2(joined(base).cast("binary"), 256).alias("base_sha256")
    return scanned.select("doc_id", *map(count, kinds), digest, joined(F.col("found")).alias("spans"))
