"""Targeting grids: the example grid, state detection and bands."""

import pytest
from pyspark.sql import functions as F

from rollcall.functions.geo import slug, state_in_text
from rollcall.operators.geo_tiers import (
    distinct_tiers,
    fill_labels,
    flatten_tiers,
    geo_type_counts,
    read_cells,
    sorted_flat,
    tier_pivot,
    tier_summary,
)

LABEL = "Tier 1 OH - Non-Lucas Co. Ohio"
GRID = [
    ("Tier 1", 0, 0, "43999"), ("Tier 1", 1, 0, "43001"), ("Tier 1", 1, 1, "430"),
    ("Tier 1", 2, 0, "431"), ("Tier 1", 3, 0, LABEL), ("Tier 1", 3, 1, "43002"),
    ("Tier 1", 4, 0, "balance of Ohio"), ("Tier 1", 5, 0, "43002"),
    ("Tier 2", 1, 0, "all zips in Rhode Island"), ("Tier 2", 2, 0, "MI"),
]
LONG = "tier_1_tier_1_oh_non_lucas_co_ohio"


@pytest.fixture(scope="module")
def grid(spark):
    return spark.createDataFrame(GRID, "sheet string, row int, col int, value string")


def test_example_grid(grid):
    tiers = flatten_tiers(grid)
    assert [tuple(r) for r in sorted_flat(tiers.flat).collect()] == [
        ("431", "scf", "tier_1"), ("43001", "zip", "tier_1"), ("OH", "state", LONG),
        ("43002", "zip", LONG), ("MI", "state", "tier_2"), ("RI", "state", "tier_2"),
    ]
    assert [tuple(r) for r in tier_summary(tiers).collect()] == [
        ("tier_1", 2, 1, 1, 0, "", ""), (LONG, 2, 1, 0, 1, "OH", "OH"), ("tier_2", 2, 0, 0, 2, "MI,RI", ""),
    ]
    assert {tuple(r) for r in tier_pivot(tiers.flat).collect()} == {
        ("tier_1", 1, 1, 0), (LONG, 1, 0, 1), ("tier_2", 0, 0, 2)}
    assert [tuple(r) for r in geo_type_counts(tiers.flat).collect()] == [
        ("state", 3, 2), ("zip", 2, 2), ("scf", 1, 1)]
    assert distinct_tiers(tiers.flat).first()[0] == 3


def test_compat_takes_two_letter_words_in_any_case(grid):
    states = flatten_tiers(grid, compat=True).flat.filter("geo_type = 'state' AND tier = 'tier_2'")
    assert {r["geo_value"] for r in states.collect()} == {"IN", "MI"}


@pytest.mark.parametrize("band_rows", [1, 2, 3, 10_000])
def test_bands_do_not_change_the_labels(grid, band_rows):
    whole = {tuple(r) for r in fill_labels(read_cells(grid)).collect()}
    assert {tuple(r) for r in fill_labels(read_cells(grid), band_rows).collect()} == whole


def test_no_geography_gives_empty_results(spark):
    empty = spark.createDataFrame([("s", 1, 0, "notes")], "sheet string, row int, col int, value string")
    tiers = flatten_tiers(empty)
    assert tiers.flat.columns == ["geo_value", "geo_type", "tier"]
    assert tiers.flat.count() == tier_summary(tiers).count() == 0


def test_states_and_slugs(spark):
    cases = [
        ("balance of West Virginia", "WV", "VA"), ("all zips in Rhode Island", "RI", "IN"),
        ("balance of Lucas Co. Ohio", "OH", "CO"), ("LUCAS CO. OHIO", "OH", "CO"), ("oh", "OH", "OH"),
        ("Tier 1 MI- x", "MI", "MI"), ("DC", None, None), ("nothing", None, None), (None, None, None),
    ]
    df = spark.createDataFrame(cases, "t string, ours string, compat string")
    wrong = df.filter(
        ~state_in_text(F.col("t")).eqNullSafe(F.col("ours"))
        | ~state_in_text(F.col("t"), compat=True).eqNullSafe(F.col("compat"))
    )
    assert wrong.collect() == []
    assert spark.range(1).select(slug(F.lit("  1st Tier--A ")), slug(F.lit("—"))).first() == ("1st_tier_a", "")


def test_labels_need_a_tier_word_and_a_qualifier(spark):
    texts = {"Tier 1 OH": True, "Tier A": False, "frontier - x": False, "tier 2 non-metro": True,
             "Tiers – all": True, "balance of Ohio": False}
    df = spark.createDataFrame([("s", 1, i, t) for i, t in enumerate(texts)], "sheet string, row int, col int, value string")
    labels = {r["col"] for r in read_cells(df).filter("label IS NOT NULL").collect()}
    assert labels == {i for i, wanted in enumerate(texts.values()) if wanted}
    compat = {r["col"] for r in read_cells(df, compat=True).filter("label IS NOT NULL").collect()}
    assert compat - labels == {2}
