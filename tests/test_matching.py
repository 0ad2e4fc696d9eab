"""Matching: fixture tables, options, and equality with a brute-force match."""

import random

import pytest
from pyspark.sql import functions as F

from rollcall.functions.similarity import best_edit_score, best_name_part_score
from rollcall.operators import candidates
from rollcall.operators import matching as m
from rollcall.operators.matching import (
    MATCH_COLUMNS,
    MatchRules,
    address_score,
    match_people,
    name_score,
)
from rollcall.operators.people import Texts
from rollcall.functions.text import STREET_EXPANSIONS, WORD_EXPANSIONS, normalize_text

LIST_COLUMNS = "finder_number firstname lastname street city state zipcode plus4".split()
LIST_ROWS = [
    ("A1", "JOHN", "STRAITOR", "12 Main St", "Adams", "OH", "43001", "12"),
    ("A2", "Mary", "Straitor", "12  Main St", "Adams", "OH", "43001", "0012"),
    ("A3", "Zed", "Quill", "12 Main St", "Adams", "OH", "43001-9999", "0012"),
    ("A4", "John", "Straitor", "99 Oak Ave", "Adams", "OH", "43001", "0012"),
    ("A5", "John", "Straitor", "12 Main St", "Adams", "OH", None, None),
    ("A6", "JOHN", "STRAITOR", "12 Main St", "Adams", "OH", "43001", "12"),
    ("A7", "John", "Smith-Jones", "5 Elm St", "Berne, North", "oh", "1234", None),
]
MAPPING = {
    "first_name": "firstname", "last_name": "lastname", "address": "street", "city": "city",
    "state": "state", "zip": "zipcode", "zip4": "plus4",
}
CONSUMER_DDL = "id int, first_name string, last_name string, address string, state string, zip string, zip4 string"
CONSUMERS = [
    (1, "John", "Straiton", "12 Main St", "OH", "43001", "12"),
    (2, "Ann", "Jones", "5 Elm St Apt 2", "OH", "1234", None),
    (3, None, "Lost", "1 Nowhere", "OH", None, None),
]
EXPECTED = {
    "A1": (1, 100, 93, 100, "INDIVIDUAL_MATCH", 293 / 3),
    "A2": (1, 0, 93, 100, "HOUSEHOLD_MATCH", 96.5),
    "A3": (1, 0, 22, 100, "ADDRESS_MATCH", 100.0),
    "A7": (2, 50, 100, 100, "HOUSEHOLD_MATCH", 100.0),
}


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(LIST_ROWS, ", ".join(f"{c} string" for c in LIST_COLUMNS))


@pytest.fixture(scope="module")
def consumers(spark):
    return spark.createDataFrame(CONSUMERS, CONSUMER_DDL)


def outcome(df):
    return {
        r["finder_number"]: (
            r["match_id"], r["match_first_name_score"], r["match_last_name_score"],
            r["match_address_score"], r["match_type"], r["match_overall_score"],
        )
        for r in df.collect()
    }


@pytest.mark.parametrize("pair_limit", [250_000, 0])
def test_expected_matches(people, consumers, pair_limit):
    rules = MatchRules(92, phonetic=False, pair_limit=pair_limit)
    found = match_people(people, consumers, MAPPING, rules)
    assert found.columns == LIST_COLUMNS + list(MATCH_COLUMNS)
    assert outcome(found) == {k: (*v[:5], pytest.approx(v[5])) for k, v in EXPECTED.items()}


def test_scorers_as_columns(spark):
    pairs = [
        ("STRAITOR", "Straiton", 93, 93), ("SMITH", "Smith", 100, 100), ("JOHNSON", "Johnsson", 93, 93),
        ("Smith", "Smyth", 80, 90), ("Smith-Jones", "Jonas", 80, 90), (None, "x", 0, 0), (" ", "x", 0, 0),
    ]
    df = spark.createDataFrame(pairs, "a string, b string, edit int, both int").withColumns(
        {"a": normalize_text(F.col("a")), "b": normalize_text(F.col("b"))})
    a, b = F.col("a"), F.col("b")
    scored = df.select("edit", "both", name_score(a, b, True, phonetic=False), name_score(a, b, True))
    assert all((r[0], r[1]) == (r[2], r[3]) for r in scored.collect())
    zips = spark.createDataFrame([("1", "1", 100), ("1", "2", 0), ("", "", 0)], "x string, y string, s int")
    gated = address_score(F.lit("1 oak"), F.lit("1 oak ave"), F.col("x"), F.col("y"))
    assert zips.filter(gated != F.col("s")).count() == 0


def test_per_row_and_unmatched(people, consumers):
    rules = MatchRules(phonetic=False, per_row=True, keep_unmatched=True)
    found = outcome(match_people(people, consumers, MAPPING, rules))
    assert set(found) == {row[0] for row in LIST_ROWS}
    assert found["A6"] == found["A1"]
    assert found["A4"] == (None, None, None, None, "NO_MATCH", None)
    one = outcome(match_people(people, consumers, MAPPING, MatchRules(keep_unmatched=True)))
    assert set(one) == set(found) - {"A6"}


def test_state_filter_ignores_case_and_checks_the_code(people, consumers):
    found = match_people(people, consumers, MAPPING, MatchRules(phonetic=False), state="oh")
    assert "A7" in outcome(found)
    assert match_people(people, consumers, MAPPING, state="WY").count() == 0
    with pytest.raises(ValueError):
        match_people(people, consumers, MAPPING, state="Ohio")


@pytest.mark.parametrize("threshold", [0, -1, 101])
def test_threshold_range(threshold):
    with pytest.raises(ValueError):
        MatchRules(threshold)


def test_missing_and_reserved_columns(people, consumers):
    with pytest.raises(ValueError, match="zip4"):
        match_people(people.drop("plus4"), consumers, MAPPING)
    with pytest.raises(ValueError, match="reserved"):
        match_people(people.withColumn("match_id", F.lit(1)), consumers, MAPPING)


def test_columns_ending_in_norm_are_kept(people, consumers):
    found = match_people(people.withColumn("zip_norm", F.lit("x")), consumers, MAPPING)
    assert "zip_norm" in found.columns


def test_street_words_and_house_numbers(spark):
    columns = "id string, first_name string, last_name string, address string, zip string, zip4 string, state string"
    left = spark.createDataFrame(
        [("a", "Jo", "Lee", "12 Main Street", "1", "1", "OH"), ("b", "Jo", "Lee", "112 Main St", "1", "1", "OH")],
        columns,
    ).withColumnRenamed("id", "row")
    right = spark.createDataFrame([("c", "Jo", "Lee", "12 Main St", "1", "1", "OH")], columns)

    def rows(**options):
        found = match_people(left, right, rules=MatchRules(phonetic=False, **options))
        return {r["row"]: r["match_address_score"] for r in found.collect()}

    assert rows() == {"b": 100}
    spelled = Texts(WORD_EXPANSIONS, STREET_EXPANSIONS)
    assert rows(texts=spelled) == {"a": 100, "b": 100}
    assert rows(texts=spelled, strict_house_number=True) == {"a": 100}


# ------------------------------------------------ large blocks against brute force

FIRST = "john jon johnny mary marie martha ann joanne j robert bob al".split()
LAST = ["smith", "smyth", "smith-jones", "jones", "de la cruz", "cruz", "lee", "straiton",
        "straitor", "o'brien", "van der berg", "berg", "a a a a"]
STREETS = ["main st", "maine st", "elm road", "elm rd", "oak ave", "n oak ave apt 4", "st john st"]


def random_people(rng, count, ids):
    rows = []
    for i in range(count):
        zip_, zip4 = rng.choice([("43001", ""), ("43001", ""), ("43001", "0012"), ("43002", "")])
        rows.append((
            f"{ids}{i:04d}", rng.choice(FIRST + [""]), rng.choice(LAST + [""]),
            f"{rng.randint(1, 30)} {rng.choice(STREETS)}", zip_, zip4,
        ))
    return rows


def brute_force(left, right, threshold, household):
    """Best match per person by plain loops over all pairs, phonetics off."""
    expand = lambda s: " ".join(WORD_EXPANSIONS.get(w, w) for w in s.split())
    best = {}
    for row in sorted(left):
        person = row[1:]
        choices = []
        for c in right:
            if (c[4], c[5]) != (row[4], row[5]):
                continue
            a = best_edit_score(expand(row[3]), expand(c[3]))
            if a < threshold:
                continue
            f = best_edit_score(row[1], c[1])
            l = best_name_part_score(row[2], c[2]) if row[2] and c[2] else 0
            if f >= threshold and l >= threshold:
                key = (1, -(f + l + a) / 3.0)
            elif l >= household:
                key = (2, -(l + a) / 2.0)
            else:
                key = (3, -float(a))
            choices.append((*key, c[0], f, l, a))
        if choices and person not in best:
            rank, minus, match, f, l, a = min(choices)
            best[person] = (row[0], match, f, l, a, rank, -minus)
    return set(best.values())


@pytest.mark.parametrize(
    "threshold,household,limits",
    [(92, 92, (250_000, 20, 0)), (85, 70, (0,)), (100, 100, (250_000,)), (60, 60, (0,))],
)
def test_large_blocks_equal_brute_force(spark, threshold, household, limits):
    rng = random.Random(threshold)
    left, right = random_people(rng, 160, "p"), random_people(rng, 160, "c")
    columns = "{} string, first_name string, last_name string, address string, zip string, zip4 string"
    people = spark.createDataFrame(left, columns.format("row"))
    consumers = spark.createDataFrame(right, columns.format("id"))
    expected = brute_force(left, right, threshold, household)
    for pair_limit in limits:
        rules = MatchRules(threshold, household, phonetic=False, pair_limit=pair_limit)
        found = {
            (r["row"], r["match_id"], r["match_first_name_score"], r["match_last_name_score"],
             r["match_address_score"],
             ["INDIVIDUAL_MATCH", "HOUSEHOLD_MATCH", "ADDRESS_MATCH"].index(r["match_type"]) + 1,
             r["match_overall_score"])
            for r in match_people(people, consumers, rules=rules).collect()
        }
        assert found == expected, pair_limit


@pytest.mark.parametrize("threshold", [80])
def test_large_blocks_equal_small_ones_with_phonetics(spark, threshold):
    rng = random.Random(threshold)
    columns = "{} string, first_name string, last_name string, address string, zip string, zip4 string"
    people = spark.createDataFrame(random_people(rng, 120, "p"), columns.format("row"))
    consumers = spark.createDataFrame(random_people(rng, 120, "c"), columns.format("id"))
    small, large = (
        {tuple(r) for r in match_people(people, consumers, rules=MatchRules(threshold, pair_limit=n)).collect()}
        for n in (250_000, 0)
    )
    assert small == large and small


def test_list_rows_of_blocks_without_consumers_go_before_the_shuffle(spark, monkeypatch):
    monkeypatch.setattr(candidates, "LONELY_ROWS", 50)
    monkeypatch.setattr(m, "LONELY_ROWS", 50)
    rows = [(str(i), "John", "Straiton", "12 Main St", "99999", "") for i in range(400)]
    rows += [("a", "John", "Straitor", "12 Main St", "43001", "12"), ("b", "Ann", "Jones", "5 Elm St", "43002", None)]
    people = spark.createDataFrame(rows, "fid string, first_name string, last_name string, address string, zip string, zip4 string")
    consumers = spark.createDataFrame(
        [(1, "John", "Straiton", "12 Main St", "43001", "12"), (2, "Ann", "Jones", "5 Elm St", "43002", None)],
        "id long, first_name string, last_name string, address string, zip string, zip4 string",
    )
    for buckets in (1 << 20, 1):
        monkeypatch.setattr(candidates, "BUCKETS", buckets)
        found, sizes = m.match_with_sizes(people, consumers)
        assert sizes == {"people": 402, "consumers": 2, "comparisons": 2}
        assert sizes == m.match_sizes(people, consumers)
        assert sorted((r["fid"], r["match_id"]) for r in found.collect()) == [("a", 1), ("b", 2)]
        source = m.resolve_mapping(people.columns)
        blocked = m.blocked_list(people, source)
        blocks = m.Blocks.of(people, consumers, source, m.MatchRules())
        assert blocks.lonely.count() == 1 and blocks.large is None
        kept = candidates.with_partners(blocked, m.blocked_consumers(consumers), m.BLOCK_KEYS, blocks.lonely)
        assert kept.count() == 2
    text = found._jdf.queryExecution().executedPlan().toString()
    lines = text.split("\n")
    shuffle = next(i for i, line in enumerate(lines) if "REPARTITION_BY_COL" in line)
    assert any("LeftSemi" in line for line in lines[shuffle:])


def test_address_codes_come_once_per_text_or_per_row(spark, monkeypatch):
    rng = random.Random(7)
    columns = "{} string, first_name string, last_name string, address string, zip string, zip4 string"
    people = spark.createDataFrame(random_people(rng, 80, "p") + [("x", "Al", "Lee", None, "43001", "")], columns.format("row"))
    consumers = spark.createDataFrame(random_people(rng, 80, "c"), columns.format("id"))
    source, rules = m.resolve_mapping(people.columns), MatchRules(85)
    sides = m.blocked_list(people, source), m.blocked_consumers(consumers)
    table = m.address_codes(*sides, source, rules)
    texts = [r["text"] for r in table.collect()]
    assert len(texts) == len(set(texts)) and all(len(r["codes"]) == 4 for r in table.collect())

    def found(pair_limit):
        rows = match_people(people, consumers, rules=MatchRules(85, pair_limit=pair_limit)).collect()
        return {tuple(r) for r in rows}

    coded = found(250_000)
    assert coded and coded == found(10)
    monkeypatch.setattr(m, "CODED_ADDRESSES", len(texts) - 1)
    assert m.address_codes(*sides, source, rules) is None
    assert coded == found(250_000) == found(10)
