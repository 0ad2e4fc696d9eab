"""Registered queries: every operator over whole benchmark tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.demo import derived as d
from rollcall.functions.names import Header
from rollcall.functions.phonetic import PHONETIC_CODES, phonetic_score
from rollcall.functions.similarity import (
    edit_score,
    indel_ratio,
    name_part_score,
    partial_ratio,
    token_set_ratio,
    token_sort_ratio,
)
from rollcall.functions.text import name_parts, normalize_text, zip4_key, zip_key
from rollcall.operators import geo_tiers as geo
from rollcall.operators import matching as m
from rollcall.operators import reports
from rollcall.operators.broken_rows import chunk_of, fits_header, quarantine_text
from rollcall.operators.orders import output_name, stamp_orders
from rollcall.operators.people import ADDRESS, FIRST, LAST
from rollcall.operators.row_numbers import number_rows
from rollcall.operators.zip_split import split_zip_plus4
from rollcall.sources.delimited import import_lines, misfit_lines

CHUNK = 1_000
ORDER_DATE = "2025-11-25"
EDIT_ONLY = m.MatchRules(92, phonetic=False)


# ---------------------------------------------------------------- import and preparation


def _as_read(lines: DataFrame) -> DataFrame:
    """Derived lines behind a generator, so that filters do not derive the text once more."""
    others = [c for c in lines.columns if c != "value"]
    return lines.select(*others, F.explode(F.array("value")).alias("value"))


def _list_lines(spark: SparkSession, folder: str) -> DataFrame:
    """List lines, with the header line once per order priority as if from several files."""
    lines = d.frame(spark, folder, "orders", d.LIST_BASE, d.LIST, d.LINES).select("value")
    heads = d.frame(spark, folder, "orders", ["o_orderpriority"]).distinct()
    return heads.select(F.lit(d.HEADER).alias("value")).unionByName(_as_read(lines))


def import_clean_rows(spark: SparkSession, folder: str) -> DataFrame:
    return import_lines(_list_lines(spark, folder), Header.parse(d.HEADER))


def import_quality_report(spark: SparkSession, folder: str) -> DataFrame:
    return reports.quality_report(import_clean_rows(spark, folder))


def _damaged_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _as_read(
        d.frame(spark, folder, "orders", d.LIST_BASE, d.LIST, d.DAMAGED_BASE, d.DAMAGED_LINES)
    )


def quarantine_bad_rows(spark: SparkSession, folder: str) -> DataFrame:
    numbered = number_rows(_damaged_lines(spark, folder), "line_key", name="row_number")
    # The header is line 1.
    lines = numbered.withColumn("line_number", F.col("row_number") + 1)
    return quarantine_text(lines.filter(~fits_header(F.col("value"), d.HEADER)))


def import_misfits(spark: SparkSession, folder: str) -> DataFrame:
    return misfit_lines(_damaged_lines(spark, folder), Header.parse(d.HEADER))


def chunk_assignment(spark: SparkSession, folder: str) -> DataFrame:
    good = _damaged_lines(spark, folder).filter(fits_header(F.col("value"), d.HEADER))
    return number_rows(good, "line_key", name="position").select(
        "line_key", chunk_of(F.col("position"), CHUNK).alias("chunk_id")
    )


def split_zip(spark: SparkSession, folder: str) -> DataFrame:
    return split_zip_plus4(d.frame(spark, folder, "orders", d.LIST_BASE, d.LIST, d.ZIP_LIST))


def stamp_order_columns(spark: SparkSession, folder: str) -> DataFrame:
    rows = d.frame(spark, folder, "orders", d.EXPORT_ROWS)
    stamped = stamp_orders(rows, F.col("file_name"), ORDER_DATE)
    return stamped.withColumn("file_name", output_name(F.col("file_name")))


# ---------------------------------------------------------------- keys and scores


def zip_keys(spark: SparkSession, folder: str) -> DataFrame:
    return d.people(spark, folder).select(
        "finder_number",
        zip_key(F.col("zipcode")).alias("zip_key"),
        zip4_key(F.col("plus4")).alias("zip4_key"),
    )


def normalize_names(spark: SparkSession, folder: str) -> DataFrame:
    last = normalize_text(F.col("lastname"))
    return d.people(spark, folder).select(
        "finder_number",
        normalize_text(F.col("firstname")).alias("first_text"),
        last.alias("last_text"),
        normalize_text(F.col("street")).alias("address_text"),
        F.array_join(name_parts(last), "|").alias("last_parts"),
    )


def _sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return (
        m.blocked_list(d.people(spark, folder), d.MAPPING),
        m.blocked_consumers(d.consumers(spark, folder)),
    )


def _text_pairs(spark: SparkSession, folder: str, kinds: tuple[str, ...]) -> DataFrame:
    """Distinct texts that meet in a block."""
    blocked, consumers = _sides(spark, folder)
    left = m.list_texts(blocked.repartition("zipcode"), d.MAPPING, EDIT_ONLY)
    right = m.consumer_texts(consumers, EDIT_ONLY)
    columns = {"first": (FIRST, m.C_FIRST), "last": (LAST, m.C_LAST), "address": (ADDRESS, m.C_ADDRESS)}

    def texts(side: DataFrame, at: int, name: str) -> DataFrame:
        kept = [F.struct(F.lit(k).alias("kind"), F.col(columns[k][at]).alias(name)) for k in kinds]
        # Distinct per block before the join, so that copies do not multiply.
        return side.select(*m.BLOCK_KEYS, F.inline(F.array(*kept))).filter(F.col(name) != "").distinct()

    met = texts(left, 0, "a").join(texts(right, 1, "b"), [*m.BLOCK_KEYS, "kind"])
    return met.select("a", "b").distinct().repartition("a", "b")


def _scores(kinds: tuple[str, ...], **scores: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        pairs = _text_pairs(spark, folder, kinds)
        a, b = F.col("a"), F.col("b")
        return pairs.select("a", "b", *[score(a, b).alias(name) for name, score in scores.items()])

    return query


ALL_TEXTS = ("first", "last", "address")


def phonetic_codes(spark: SparkSession, folder: str) -> DataFrame:
    kinds = F.array(*[normalize_text(F.col(c)) for c in ("firstname", "lastname", "street")])
    names = d.people(spark, folder).select(F.explode(kinds).alias("name"))
    return names.distinct().select(
        "name", *[code(F.col("name")).alias(kind) for kind, code in PHONETIC_CODES.items()]
    )


# ---------------------------------------------------------------- matching


def block_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return m.block_sizes(*_sides(spark, folder))


def comparison_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return reports.comparison_sizes(
        d.people(spark, folder), d.consumers(spark, folder), block_sizes(spark, folder)
    )


def candidate_pairs(spark: SparkSession, folder: str) -> DataFrame:
    pairs = m.candidate_pairs(*_sides(spark, folder), d.MAPPING, EDIT_ONLY)
    return pairs.select("finder_number", "match_id")


def _match(rules: m.MatchRules, state: str | None = None) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return m.match_people(
            d.people(spark, folder), d.consumers(spark, folder), d.MAPPING, rules, state
        )

    return query


match_best = _match(EDIT_ONLY)
match_phonetic = _match(m.MatchRules(92))
match_phonetic_low = _match(m.MatchRules(85))
match_one_state = _match(EDIT_ONLY, "oh")
# Blocks over a low limit take the way of hot blocks; the rows are those of the plain match.
match_best_narrowed = _match(m.MatchRules(92, phonetic=False, pair_limit=300))
match_phonetic_narrowed = _match(m.MatchRules(85, pair_limit=300))
match_low_household = _match(m.MatchRules(92, household_threshold=75, phonetic=False))
match_house_number = _match(m.MatchRules(85, phonetic=False, strict_house_number=True))
match_every_row = _match(m.MatchRules(92, phonetic=False, per_row=True, keep_unmatched=True))


def match_type_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return reports.match_type_distribution(match_best(spark, folder))


def score_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return reports.score_distribution(match_best(spark, folder))


# ---------------------------------------------------------------- geography


def _tiers(spark: SparkSession, folder: str, compat: bool = False) -> geo.GeoTiers:
    return geo.flatten_tiers(d.frame(spark, folder, "customer", d.CELLS), compat=compat)


def geo_flat(spark: SparkSession, folder: str) -> DataFrame:
    return geo.sorted_flat(_tiers(spark, folder).flat)


def geo_flat_compat(spark: SparkSession, folder: str) -> DataFrame:
    return geo.sorted_flat(_tiers(spark, folder, compat=True).flat)


def geo_tier_summary(spark: SparkSession, folder: str) -> DataFrame:
    return geo.tier_summary(_tiers(spark, folder))


def geo_tier_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return geo.tier_pivot(_tiers(spark, folder).flat)


def geo_type_counts(spark: SparkSession, folder: str) -> DataFrame:
    return geo.geo_type_counts(_tiers(spark, folder).flat)


def geo_distinct_tiers(spark: SparkSession, folder: str) -> DataFrame:
    return geo.distinct_tiers(_tiers(spark, folder).flat)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "import_clean_rows": import_clean_rows,
    "import_quality_report": import_quality_report,
    "import_misfits": import_misfits,
    "quarantine_bad_rows": quarantine_bad_rows,
    "chunk_assignment": chunk_assignment,
    "split_zip_plus4": split_zip,
    "stamp_order_columns": stamp_order_columns,
    "zip_keys": zip_keys,
    "normalize_names": normalize_names,
    "indel_scores": _scores(ALL_TEXTS, score=indel_ratio),
    "token_scores": _scores(ALL_TEXTS, sort_score=token_sort_ratio, set_score=token_set_ratio),
    "partial_scores": _scores(ALL_TEXTS, score=partial_ratio),
    "best_edit_scores": _scores(ALL_TEXTS, score=edit_score),
    "last_name_scores": _scores(("last",), score=name_part_score),
    "phonetic_codes": phonetic_codes,
    "phonetic_agreement": _scores(ALL_TEXTS, score=phonetic_score),
    "block_sizes": block_sizes,
    "comparison_sizes": comparison_sizes,
    "candidate_pairs": candidate_pairs,
    "match_best": match_best,
    "match_phonetic": match_phonetic,
    "match_phonetic_low": match_phonetic_low,
    "match_best_narrowed": match_best_narrowed,
    "match_phonetic_narrowed": match_phonetic_narrowed,
    "match_low_household": match_low_household,
    "match_house_number": match_house_number,
    "match_one_state": match_one_state,
    "match_every_row": match_every_row,
    "match_type_distribution": match_type_distribution,
    "score_distribution": score_distribution,
    "geo_flat": geo_flat,
    "geo_flat_compat": geo_flat_compat,
    "geo_tier_summary": geo_tier_summary,
    "geo_tier_pivot": geo_tier_pivot,
    "geo_type_counts": geo_type_counts,
    "geo_distinct_tiers": geo_distinct_tiers,
}
