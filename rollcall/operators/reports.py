"""Reports about imports and matches."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# A quality rule: an aggregate over the rows and what its value has to satisfy.
Rule = tuple[Column, Callable[[Column], Column]]


def row_count_positive() -> dict[str, Rule]:
    """Default rule set: at least one row."""
    return {"RowCount > 0": (F.count(F.lit(1)), lambda n: n > 0)}


def quality_report(df: DataFrame, rules: Mapping[str, Rule] | None = None) -> DataFrame:
    """One row per rule (``rule, outcome, actual``) from a single aggregation; never raises."""
    rules = rules or row_count_positive()
    values = df.agg(*[value.cast("double").alias(f"v{i}") for i, (value, _) in enumerate(rules.values())])
    entries = [
        F.struct(
            F.lit(name).alias("rule"),
            F.when(holds(F.col(f"v{i}")), "Passed").otherwise("Failed").alias("outcome"),
            F.col(f"v{i}").alias("actual"),
        )
        for i, (name, (_, holds)) in enumerate(rules.items())
    ]
    return values.select(F.inline(F.array(*entries)))


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The same rows, with their number observed while another action reads them."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def match_type_distribution(matches: DataFrame) -> DataFrame:
    return (
        matches.groupBy("match_type")
        .agg(
            F.count(F.lit(1)).alias("match_count"),
            F.round(F.avg("match_overall_score"), 2).alias("avg_overall_score"),
        )
        .orderBy(F.desc("match_count"), "match_type")
    )


def score_distribution(matches: DataFrame) -> DataFrame:
    last = "match_last_name_score"
    return (
        matches.groupBy("match_type")
        .agg(
            F.count(F.lit(1)).alias("match_count"),
            F.round(F.avg("match_first_name_score"), 2).alias("avg_first_name_score"),
            F.round(F.avg(last), 2).alias("avg_last_name_score"),
            F.round(F.avg("match_address_score"), 2).alias("avg_address_score"),
            F.min(last).alias("min_last_name_score"),
            F.max(last).alias("max_last_name_score"),
        )
        .orderBy(F.desc("match_count"), "match_type")
    )


def comparison_sizes(people: DataFrame, consumers: DataFrame, blocks: DataFrame) -> DataFrame:
    """Comparisons without blocking against those within blocks, and the largest block."""

    def entry(df: DataFrame, name: str, value: Column) -> DataFrame:
        return df.agg(F.coalesce(value.cast("double"), F.lit(0.0)).alias("value")).select(
            F.lit(name).alias("name"), "value"
        )

    rows = F.count(F.lit(1))
    entries = (
        entry(people, "list_rows", rows)
        .unionByName(entry(consumers, "consumer_rows", rows))
        .unionByName(entry(blocks, "blocked_pairs", F.sum("pairs")))
        .unionByName(entry(blocks, "largest_block", F.max("pairs")))
    )

    def value(name: str) -> Column:
        return F.max(F.when(F.col("name") == name, F.col("value")))

    return entries.agg(
        value("list_rows").cast("bigint").alias("list_rows"),
        value("consumer_rows").cast("bigint").alias("consumer_rows"),
        (value("list_rows") * value("consumer_rows")).alias("unblocked_pairs"),
        value("blocked_pairs").alias("blocked_pairs"),
        value("largest_block").alias("largest_block"),
    )
