"""Linking people on a list to a consumer table: best individual, household or address match."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from rollcall.functions.names import Header, quoted
from rollcall.functions.phonetic import (
    PHONETIC_CODES,
    PHONETIC_SCORE,
    codes_agree,
    forms_agree,
    phonetic_codes,
)
from rollcall.functions.similarity import edit_score, name_part_score
from rollcall.functions.text import name_forms, normalize_text
from rollcall.operators.candidates import (
    LONELY_ROWS,
    PAIR_LIMIT,
    chosen_groups,
    group_sizes,
    group_table,
    text_pairs,
    with_partners,
)
from rollcall.operators.people import (
    ADDRESS,
    BLOCK_KEYS,
    CONSUMER,
    FIRST,
    LAST,
    PERSON,
    ZIP,
    ZIP4,
    Texts,
    block_keys,
    can_match,
    comparable,
    compared_texts,
    in_state,
    require,
    resolve_mapping,
    state_code,
)
from rollcall.storage import materialize

# Match types by rank, and the columns a match adds to the list.
MATCH_TYPES = ("INDIVIDUAL_MATCH", "HOUSEHOLD_MATCH", "ADDRESS_MATCH", "NO_MATCH")
INDIVIDUAL, HOUSEHOLD, AT_ADDRESS, NO_MATCH = MATCH_TYPES
CONSUMER_COLUMNS = (
    "match_id",
    "match_first_name",
    "match_last_name",
    "match_address",
    "match_zip",
    "match_zip4",
)
SCORE_COLUMNS = ("match_first_name_score", "match_last_name_score", "match_address_score")
MATCH_COLUMNS = (*CONSUMER_COLUMNS, *SCORE_COLUMNS, "match_type", "match_overall_score")

# Distinct names, and distinct addresses, whose codes are broadcast; of more, codes are derived per row.
CODED_NAMES = CODED_ADDRESSES = 100_000

_CONSUMER_SIDE = "_rc_c"
C_FIRST, C_LAST, C_ADDRESS = (_CONSUMER_SIDE + c for c in (FIRST, LAST, ADDRESS))
ADDRESS_CODES, FIRST_CODES, LAST_CODES = "_rc_codes", "_rc_first_codes", "_rc_last_codes"
C_ADDRESS_CODES, C_FIRST_CODES, C_LAST_CODES = (
    _CONSUMER_SIDE + c for c in (ADDRESS_CODES, FIRST_CODES, LAST_CODES)
)


@dataclass(frozen=True)
class MatchRules:
    """Options of a match.

    ``threshold`` is the least score that counts as agreement (1 to 100), ``household_threshold``
    the one for the last name of a household match (default: the same). ``phonetic`` lets names
    and addresses that sound alike score 90. ``per_row`` returns every list row of a matched
    person instead of one, ``keep_unmatched`` adds people without a match. ``strict_house_number``
    demands equal leading numbers of the addresses. Blocks with more than ``pair_limit`` pairs
    are narrowed by an exact condition before texts are compared.
    """

    threshold: int = 92
    household_threshold: int | None = None
    phonetic: bool = True
    per_row: bool = False
    keep_unmatched: bool = False
    strict_house_number: bool = False
    texts: Texts = field(default_factory=Texts.default)
    pair_limit: int = PAIR_LIMIT

    def __post_init__(self) -> None:
        for value in (self.threshold, self.household):
            if not 1 <= value <= 100:
                raise ValueError(f"a threshold lies between 1 and 100, not {value}")

    @property
    def household(self) -> int:
        return self.threshold if self.household_threshold is None else self.household_threshold

    @property
    def phonetic_decides(self) -> bool:
        """Whether sounding alike is enough for an address to agree."""
        return self.phonetic and self.threshold <= PHONETIC_SCORE


# ---------------------------------------------------------------- scores


def name_score(
    a: Column,
    b: Column,
    is_last_name: bool = False,
    phonetic: bool = True,
    agree: Column | None = None,
) -> Column:
    """Score of two normalized names; last names are also compared by their parts.

    ``agree`` tells whether they sound alike, if that is known from codes per row.
    """
    edit = name_part_score(a, b) if is_last_name else edit_score(a, b)
    if not phonetic:
        return edit
    if agree is None:
        agree = forms_agree(name_forms(a), name_forms(b)) if is_last_name else codes_agree(a, b)
    return _raise_to_phonetic(a, b, edit, agree)


def address_score(
    a: Column,
    b: Column,
    zip_a: Column | None = None,
    zip_b: Column | None = None,
    phonetic: bool = True,
) -> Column:
    """Score of two normalized addresses; 0 where ZIP keys are given and differ or are blank."""
    score = edit_score(a, b)
    if phonetic:
        score = _raise_to_phonetic(a, b, score, codes_agree(a, b))
    if zip_a is None or zip_b is None:
        return score
    return F.when((zip_a == zip_b) & (zip_a != ""), score).otherwise(F.lit(0))


def _agreement(a: Column, b: Column, agree: Column, rules: MatchRules) -> Column:
    """Address score that is exact from the threshold up, which is all that a match shows."""
    edit = edit_score(a, b, needed=rules.threshold)
    return _raise_to_phonetic(a, b, edit, agree) if rules.phonetic_decides else edit


def _single_agree(a: str, b: str) -> Column:
    """Whether the codes of two single texts agree: one of each kind, in the same order."""
    agree = F.lit(False)
    for kind in range(len(PHONETIC_CODES)):
        agree = agree | (F.get(F.col(a), F.lit(kind)) == F.get(F.col(b), F.lit(kind)))
    return agree


def _raise_to_phonetic(a: Column, b: Column, edit: Column, agree: Column) -> Column:
    """``edit``, or the phonetic score where that is higher and the texts agree by sound.

    The edit score goes through an array, whose one element has several uses: it is computed
    once, while Spark would call the scorer for every use of the column.
    """
    blank = a.isNull() | b.isNull() | (a == "") | (b == "")

    def raised(score: Column) -> Column:
        # Codes are only derived where they can raise the score.
        return F.when(blank | (score >= PHONETIC_SCORE), score).otherwise(
            F.when(agree, F.lit(PHONETIC_SCORE)).otherwise(score)
        )

    return F.get(F.transform(F.array(edit), raised), F.lit(0))


def match_type(first: Column, last: Column, address: Column, rules: MatchRules) -> Column:
    t = rules.threshold
    return (
        F.when((first >= t) & (last >= t) & (address >= t), INDIVIDUAL)
        .when((last >= rules.household) & (address >= t), HOUSEHOLD)
        .when(address >= t, AT_ADDRESS)
        .otherwise(NO_MATCH)
    )


def overall_score(kind: Column, first: Column, last: Column, address: Column) -> Column:
    """Mean of the scores that make up the match type."""
    return (
        F.when(kind == INDIVIDUAL, (first + last + address) / F.lit(3.0))
        .when(kind == HOUSEHOLD, (last + address) / F.lit(2.0))
        .otherwise(address.cast("double"))
    )


def type_rank(kind: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, MATCH_TYPES)), kind).cast("int")


# ---------------------------------------------------------------- sides


def blocked_list(people: DataFrame, source: Mapping[str, str]) -> DataFrame:
    """List rows that can match, with their block keys."""
    return comparable(people, source).select("*", *block_keys(source))


def blocked_consumers(
    consumers: DataFrame, state: str | None = None, state_exact: bool = False
) -> DataFrame:
    """Consumers that can match: the six columns a match needs, named as in the result."""
    require({c: c for c in consumers.columns}, CONSUMER)
    source = {c: c for c in PERSON}
    chosen = comparable(in_state(consumers, "state", state, state_exact), source)
    return chosen.select(
        *[F.col(c).alias(m) for c, m in zip(CONSUMER, CONSUMER_COLUMNS)], *block_keys(source)
    )


def list_texts(people: DataFrame, source: Mapping[str, str], rules: MatchRules) -> DataFrame:
    """Blocked list rows with the texts to compare."""
    return people.select("*", *compared_texts(source, rules.texts))


def consumer_texts(consumers: DataFrame, rules: MatchRules) -> DataFrame:
    """Blocked consumers with the texts to compare."""
    source = dict(zip(PERSON, CONSUMER_COLUMNS[1:]))
    return consumers.select("*", *compared_texts(source, rules.texts, _CONSUMER_SIDE))


def name_codes(
    people: DataFrame, consumers: DataFrame, source: Mapping[str, str], rules: MatchRules
) -> DataFrame | None:
    """``is_last, text, codes``: phonetic codes of the names of both blocked sides, once per text.

    Names are folded before anything is derived from them. ``None`` if there are more than
    ``CODED_NAMES``, too many to broadcast: codes are then derived per row.
    """
    sides = []
    for side, columns in ((people, source), (consumers, dict(zip(PERSON, CONSUMER_COLUMNS[1:])))):
        names = [
            F.struct(F.lit(is_last).alias("is_last"), F.col(quoted(columns[key])).cast("string").alias("name"))
            for key, is_last in (("first_name", False), ("last_name", True))
        ]
        sides.append(side.select(F.inline(F.array(*names))))
    names = sides[0].union(sides[1]).distinct()
    texts = names.select("is_last", normalize_text(F.col("name"), rules.texts.names).alias("text"))
    text = F.col("text")
    codes = F.when(F.col("is_last"), phonetic_codes(name_forms(text))).otherwise(phonetic_codes(F.array(text)))
    coded = materialize(texts.distinct().withColumn("codes", codes))
    return coded if coded.count() <= CODED_NAMES else None


def address_codes(
    people: DataFrame, consumers: DataFrame, source: Mapping[str, str], rules: MatchRules
) -> DataFrame | None:
    """``text, codes``: phonetic codes of the addresses of both blocked sides, once per text.

    ``None`` if there are more than ``CODED_ADDRESSES``; texts are counted before they are coded.
    """
    columns = ((people, source["address"]), (consumers, CONSUMER_COLUMNS[3]))
    left, right = (side.select(F.col(quoted(c)).cast("string").alias("address")) for side, c in columns)
    raw = materialize(left.union(right).distinct())
    text = normalize_text(F.col("address"), rules.texts.addresses).alias("text")
    # A text has at least one raw form, and forms of one text are few.
    if raw.count() > 4 * CODED_ADDRESSES:
        return None
    texts = materialize(raw.select(text).distinct().repartition(raw.sparkSession.sparkContext.defaultParallelism))
    if texts.count() > CODED_ADDRESSES:
        return None
    return materialize(texts.withColumn("codes", phonetic_codes(F.array(F.col("text")))))


@dataclass(frozen=True)
class Codes:
    """Phonetic codes by text: tables of names and of addresses, or None where codes are derived per row."""

    names: DataFrame | None = None
    addresses: DataFrame | None = None

    @classmethod
    def of(cls, people: DataFrame, consumers: DataFrame, source: Mapping[str, str], rules: MatchRules) -> Codes:
        return cls(
            name_codes(people, consumers, source, rules) if rules.phonetic else None,
            address_codes(people, consumers, source, rules) if rules.phonetic_decides else None,
        )


def _looked_up(df: DataFrame, table: DataFrame, text: str, code: str) -> DataFrame:
    coded = table.select(F.col("text").alias(text), F.col("codes").alias(code))
    return df.join(F.broadcast(coded), text, "left")


def _with_name_codes(df: DataFrame, side: str, rules: MatchRules, codes: Codes) -> DataFrame:
    """Phonetic codes of the names, where they can decide."""
    if not rules.phonetic:
        return df
    if codes.names is None:
        return df.withColumns(
            {
                side + FIRST_CODES: phonetic_codes(F.array(F.col(side + FIRST))),
                side + LAST_CODES: phonetic_codes(name_forms(F.col(side + LAST))),
            }
        )
    for is_last, text, code in ((False, FIRST, FIRST_CODES), (True, LAST, LAST_CODES)):
        df = _looked_up(df, codes.names.filter(F.col("is_last") == is_last), side + text, side + code)
    return df


def _with_address_codes(df: DataFrame, side: str, rules: MatchRules, codes: Codes) -> DataFrame:
    """Phonetic codes of the addresses, where they can decide."""
    if not rules.phonetic_decides:
        return df
    if codes.addresses is None:
        return df.withColumn(side + ADDRESS_CODES, phonetic_codes(F.array(F.col(side + ADDRESS))))
    return _looked_up(df, codes.addresses, side + ADDRESS, side + ADDRESS_CODES)


def _with_codes(df: DataFrame, side: str, rules: MatchRules, codes: Codes) -> DataFrame:
    """Codes that pairs bring along: of addresses, and of names that are too many for a table.

    Codes of other names are looked up for the pairs that agree on the address.
    """
    df = _with_address_codes(df, side, rules, codes)
    return df if codes.names is not None else _with_name_codes(df, side, rules, codes)


def block_sizes(people: DataFrame, consumers: DataFrame) -> DataFrame:
    """Rows on both sides and pairs of every block that occurs on both."""
    sizes = group_sizes(people, consumers, BLOCK_KEYS)
    return sizes.select(
        F.col(ZIP).alias("zip"), F.col(ZIP4).alias("zip4"), "left_rows", "right_rows", "pairs"
    )


@dataclass(frozen=True)
class Blocks:
    """What the sizes of the blocks say: rows of either side, all pairs, blocks with too many pairs,
    and blocks of very many list rows that no consumer is in."""

    people: int
    consumers: int
    pairs: int
    large: DataFrame | None
    lonely: DataFrame | None

    @classmethod
    def of(cls, people: DataFrame, consumers: DataFrame, source: Mapping[str, str], rules: MatchRules) -> Blocks:
        """One pass over either side; rows that cannot match only count as rows."""
        sides = [
            side.select(*block_keys(own), can_match(own).alias("fits"))
            for side, own in ((people, source), (consumers, {c: c for c in PERSON}))
        ]
        groups = group_table(*sides, BLOCK_KEYS, "fits")
        large = F.col("pairs") > rules.pair_limit
        lonely = (F.col("right_rows") == 0) & (F.col("left_rows") > LONELY_ROWS)
        counts = {"left_all": F.sum("left_all"), "right_all": F.sum("right_all"), "pairs": F.sum("pairs")}
        counts |= {"large": F.count_if(large), "lonely": F.count_if(lonely)}
        n = groups.agg(*[value.alias(name) for name, value in counts.items()]).first()
        named = [chosen_groups(groups, c, n[k], BLOCK_KEYS) for k, c in (("large", large), ("lonely", lonely))]
        return cls(*[int(n[k] or 0) for k in ("left_all", "right_all", "pairs")], *named)


def candidate_pairs(
    people: DataFrame,
    consumers: DataFrame,
    source: Mapping[str, str],
    rules: MatchRules,
    fold: Callable[[DataFrame], DataFrame] | None = None,
    codes: Codes = Codes(),
) -> DataFrame:
    """All pairs of a blocked list row and a blocked consumer in the same block.

    The list is partitioned by block even where Spark can broadcast the consumers: comparing
    texts costs far more than moving rows, and a short list would be scored by one task.
    ``fold`` may join rows of a block before their texts are derived, ``codes`` are those known by text.
    """
    placed = people.repartition(*BLOCK_KEYS)
    spread = list_texts(fold(placed) if fold else placed, source, rules)
    right = _with_codes(consumer_texts(consumers, rules), _CONSUMER_SIDE, rules, codes)
    return _with_codes(spread, "", rules, codes).join(right, BLOCK_KEYS)


# ---------------------------------------------------------------- best match


def person_columns(source: Mapping[str, str]) -> list[str]:
    """List columns whose raw values tell people apart."""
    return list(dict.fromkeys(source[key] for key in PERSON))


def _orderable(df: DataFrame, columns: list[str]) -> list[str]:
    """Columns usable as tie-break."""
    unordered = (MapType, VariantType)
    return [c for c in columns if not isinstance(df.schema[c].dataType, unordered)]


def _same_house_number(a: Column, b: Column) -> Column:
    number = r"^(\d*)"
    return F.regexp_extract(a, number, 1) == F.regexp_extract(b, number, 1)


def _folded(
    people: DataFrame, person: list[str], rest: list[str], tie_break: list[str], keys: list[str]
) -> DataFrame:
    """One row per person, with the other columns of the row that ranks first among its copies.

    Copies of a person have the same texts, so they differ in the tie-break only. ``keys``
    follow from the person.
    """
    row, order = (
        F.struct(*[F.col(quoted(c)) for c in columns], F.lit(0).alias("_rc_none"))
        for columns in (rest, tie_break)
    )
    return people.groupBy(*[F.col(quoted(c)) for c in person], *keys).agg(
        F.min_by(row, order).alias("_rc_rest")
    )


def _ranked(pairs: DataFrame, person: list[str], tie_break: list[str]) -> DataFrame:
    """The first pair of each person: by match type, overall score, match, then list columns."""
    order = [
        type_rank(F.col("match_type")),
        F.desc("match_overall_score"),
        *CONSUMER_COLUMNS,
        *[F.col(quoted(c)) for c in tie_break],
    ]
    window = Window.partitionBy(*[F.col(quoted(c)) for c in person]).orderBy(*order)
    return pairs.withColumn("_rc_place", F.row_number().over(window)).filter(
        F.col("_rc_place") == 1
    )


def _scored(pairs: DataFrame, rules: MatchRules, codes: Codes) -> DataFrame:
    """Pairs that agree on the address, with all scores; names are scored only for these."""
    address = SCORE_COLUMNS[2]
    agree = _single_agree(ADDRESS_CODES, C_ADDRESS_CODES) if rules.phonetic_decides else None
    if rules.strict_house_number:
        pairs = pairs.filter(_same_house_number(F.col(ADDRESS), F.col(C_ADDRESS)))
    return _typed(
        pairs.withColumn(
            address, _agreement(F.col(ADDRESS), F.col(C_ADDRESS), agree, rules)
        ).filter(F.col(address) >= rules.threshold),
        rules,
        codes,
    )


def _typed(pairs: DataFrame, rules: MatchRules, codes: Codes) -> DataFrame:
    first, last, address = SCORE_COLUMNS
    if FIRST_CODES not in pairs.columns:
        for side in ("", _CONSUMER_SIDE):
            pairs = _with_name_codes(pairs, side, rules, codes)
    first_agree = _single_agree(FIRST_CODES, C_FIRST_CODES) if rules.phonetic else None
    last_agree = F.arrays_overlap(LAST_CODES, C_LAST_CODES) if rules.phonetic else None
    scored = pairs.withColumns(
        {
            first: name_score(F.col(FIRST), F.col(C_FIRST), False, rules.phonetic, first_agree),
            last: name_score(F.col(LAST), F.col(C_LAST), True, rules.phonetic, last_agree),
        }
    )
    typed = scored.withColumn(
        "match_type", match_type(F.col(first), F.col(last), F.col(address), rules)
    )
    return typed.withColumn(
        "match_overall_score",
        overall_score(F.col("match_type"), F.col(first), F.col(last), F.col(address)),
    )


def _best_in_large_blocks(
    people: DataFrame,
    consumers: DataFrame,
    person: list[str],
    rest: list[str],
    rules: MatchRules,
    codes: Codes,
) -> DataFrame:
    """Best match where a block is too large to compare all its pairs.

    ``people`` are folded. Addresses are paired, last names within paired addresses and
    first names within paired last names, each on distinct texts, so that people never meet
    consumers they cannot match. The best consumer of each level is carried along as the least
    of a struct ordered like the ranking, which the aggregations fold before the shuffle.
    Texts of either side are derived once and stored.
    """
    keys = [*BLOCK_KEYS, ADDRESS, LAST, FIRST]
    folded = materialize(people.select(*[F.col(quoted(c)) for c in (*person, *rest)], *keys))
    consumers = materialize(consumers)
    consumer = F.struct(*CONSUMER_COLUMNS)

    def least_consumer(*columns: str) -> DataFrame:
        return consumers.groupBy(*BLOCK_KEYS, *columns).agg(F.min(consumer).alias("_rc_match"))

    def pairs(left: DataFrame, right: DataFrame, group: list[str], a: str, b: str,
              threshold: int, parts: bool = False) -> DataFrame:
        return text_pairs(
            left, right, group, a, b, threshold, parts, rules.phonetic, rules.pair_limit
        )

    def best(found: DataFrame, score: Column, level: list[str], name: str) -> DataFrame:
        choice = F.struct((-score).alias("minus"), F.col("_rc_match"), F.col("_rc_a"))
        return found.groupBy(*BLOCK_KEYS, *level).agg(F.min(choice).alias(name))

    # Addresses.
    at_address = least_consumer(C_ADDRESS)
    address_pairs = pairs(
        _with_address_codes(folded.select(*BLOCK_KEYS, ADDRESS).distinct(), "", rules, codes),
        _with_address_codes(consumers.select(*BLOCK_KEYS, C_ADDRESS).distinct(), _CONSUMER_SIDE, rules, codes),
        BLOCK_KEYS, ADDRESS, C_ADDRESS, rules.threshold,
    )
    if rules.strict_house_number:
        address_pairs = address_pairs.filter(_same_house_number(F.col(ADDRESS), F.col(C_ADDRESS)))
    sounds = _single_agree(ADDRESS_CODES, C_ADDRESS_CODES) if rules.phonetic_decides else None
    address_pairs = materialize(
        address_pairs.withColumn("_rc_a", _agreement(F.col(ADDRESS), F.col(C_ADDRESS), sounds, rules))
        .filter(F.col("_rc_a") >= rules.threshold)
        .select(*BLOCK_KEYS, ADDRESS, C_ADDRESS, "_rc_a")
    )

    def named(found: DataFrame, text: str, other: str, code: str, is_last: bool) -> tuple[DataFrame, Column | None]:
        """Pairs with the codes of their names, and whether these sound alike, if they are in the table."""
        if not rules.phonetic or codes.names is None:
            return found, None
        table = codes.names.filter(F.col("is_last") == is_last)
        for side, column in (("", text), (_CONSUMER_SIDE, other)):
            found = _looked_up(found, table, column, side + code)
        other_code = _CONSUMER_SIDE + code
        return found, F.arrays_overlap(code, other_code) if is_last else _single_agree(code, other_code)

    by_address = best(
        address_pairs.join(at_address, [*BLOCK_KEYS, C_ADDRESS]),
        F.col("_rc_a").cast("double"), [ADDRESS], "_rc_by_address",
    )

    # Last names at paired addresses.
    last_needed = min(rules.threshold, rules.household)
    surnames = folded.filter(F.col(LAST) != "").select(*BLOCK_KEYS, ADDRESS, LAST).distinct()
    last_pairs = pairs(
        surnames.join(address_pairs, [*BLOCK_KEYS, ADDRESS]),
        consumers.filter(F.col(C_LAST) != "").select(*BLOCK_KEYS, C_ADDRESS, C_LAST).distinct(),
        [*BLOCK_KEYS, C_ADDRESS], LAST, C_LAST, last_needed, parts=True,
    )
    columns = last_pairs.columns
    last_pairs, sounds = named(last_pairs, LAST, C_LAST, LAST_CODES, True)
    last_pairs = materialize(
        last_pairs.withColumn("_rc_l", name_score(F.col(LAST), F.col(C_LAST), True, rules.phonetic, sounds))
        .filter(F.col("_rc_l") >= last_needed)
        .select(*columns, "_rc_l")
    )
    by_household = best(
        last_pairs.filter(F.col("_rc_l") >= rules.household).join(
            least_consumer(C_ADDRESS, C_LAST), [*BLOCK_KEYS, C_ADDRESS, C_LAST]
        ),
        (F.col("_rc_l") + F.col("_rc_a")) / F.lit(2.0), [ADDRESS, LAST], "_rc_by_household",
    )

    # First names at paired last names.
    given = folded.filter(F.col(FIRST) != "").select(*BLOCK_KEYS, ADDRESS, LAST, FIRST).distinct()
    first_pairs = pairs(
        given.join(
            last_pairs.filter(F.col("_rc_l") >= rules.threshold), [*BLOCK_KEYS, ADDRESS, LAST]
        ),
        consumers.filter(F.col(C_FIRST) != "")
        .select(*BLOCK_KEYS, C_ADDRESS, C_LAST, C_FIRST)
        .distinct(),
        [*BLOCK_KEYS, C_ADDRESS, C_LAST], FIRST, C_FIRST, rules.threshold,
    )
    first_pairs, sounds = named(first_pairs, FIRST, C_FIRST, FIRST_CODES, False)
    first_pairs = first_pairs.withColumn(
        "_rc_f", name_score(F.col(FIRST), F.col(C_FIRST), False, rules.phonetic, sounds)
    ).filter(F.col("_rc_f") >= rules.threshold)
    by_person = best(
        first_pairs.join(
            least_consumer(C_ADDRESS, C_LAST, C_FIRST), [*BLOCK_KEYS, C_ADDRESS, C_LAST, C_FIRST]
        ),
        (F.col("_rc_f") + F.col("_rc_l") + F.col("_rc_a")) / F.lit(3.0),
        [ADDRESS, LAST, FIRST],
        "_rc_by_person",
    )

    chosen = (
        folded.join(by_address, [*BLOCK_KEYS, ADDRESS])
        .join(by_household, [*BLOCK_KEYS, ADDRESS, LAST], "left")
        .join(by_person, [*BLOCK_KEYS, ADDRESS, LAST, FIRST], "left")
        .withColumn(
            "_rc_best", F.coalesce("_rc_by_person", "_rc_by_household", "_rc_by_address")
        )
    )
    match = F.col("_rc_best._rc_match")
    unpacked = chosen.select(
        *[F.col(quoted(c)) for c in person],
        *[F.col(quoted(c)) for c in rest],
        *keys,
        *[match[c].alias(c) for c in CONSUMER_COLUMNS],
        F.col("_rc_best._rc_a").alias(SCORE_COLUMNS[2]),
    )
    return _typed(consumer_texts(unpacked, rules), rules, codes)


def best_matches(
    people: DataFrame,
    consumers: DataFrame,
    source: Mapping[str, str],
    columns: list[str],
    rules: MatchRules,
    blocks: Blocks,
) -> DataFrame:
    """Best match of every person on the list who has one, with all the list ``columns``.

    ``people`` and ``consumers`` carry block keys.
    """
    person = person_columns(source)
    rest = [c for c in columns if c not in person]
    tie_break = _orderable(people, rest)
    output = [F.col(quoted(c)) for c in (*columns, *MATCH_COLUMNS)]

    def one_per_person(rows: DataFrame) -> DataFrame:
        # The shuffle by block places all copies of a person in one task already.
        return _folded(rows, person, rest, tie_break, list(BLOCK_KEYS)).select(
            *[F.col(quoted(c)) for c in person],
            *[F.col("_rc_rest")[c].alias(c) for c in rest],
            *BLOCK_KEYS,
        )

    def best_of_all_pairs(
        left: DataFrame, right: DataFrame, fold: Callable[[DataFrame], DataFrame] | None = None
    ) -> DataFrame:
        pairs = candidate_pairs(left, right, source, rules, fold, codes)
        scored = _scored(pairs, rules, codes)
        return _ranked(scored, person, tie_break).select(*output)

    large = blocks.large
    if large is None:
        codes = Codes.of(people, consumers, source, rules)
        people = with_partners(people, consumers, BLOCK_KEYS, blocks.lonely)
        return best_of_all_pairs(people, consumers, one_per_person)
    # Folded by person, not by block, so that copies in a hot block do not meet in one task. What
    # follows reads the list several times, so its rows are stored.
    people = materialize(one_per_person(with_partners(people, consumers, BLOCK_KEYS, blocks.lonely)))
    consumers = materialize(consumers)
    codes = Codes.of(people, consumers, source, rules)
    small = best_of_all_pairs(
        people.join(large, BLOCK_KEYS, "left_anti"), consumers.join(large, BLOCK_KEYS, "left_anti")
    )
    narrowed = _best_in_large_blocks(
        list_texts(people.join(large, BLOCK_KEYS, "left_semi"), source, rules),
        consumer_texts(consumers.join(large, BLOCK_KEYS, "left_semi"), rules),
        person, rest, rules, codes,
    )
    return small.unionByName(narrowed.select(*output))


def match_sizes(
    people: DataFrame,
    consumers: DataFrame,
    mapping: Mapping[str, str] | None = None,
    state: str | None = None,
    header: Header | None = None,
    state_exact: bool = False,
) -> dict[str, int]:
    """Rows of the list and of the consumers in the state, and pairs that share a block."""
    source = resolve_mapping(people.columns, mapping, header)
    state = state_code(state)
    people = in_state(people, source["state"], state) if state else people
    chosen = in_state(consumers, "state", state, state_exact)
    sizes = group_sizes(blocked_list(people, source), blocked_consumers(chosen), BLOCK_KEYS)
    pairs = sizes.agg(F.sum("pairs").alias("n")).first()["n"]
    return {"people": people.count(), "consumers": chosen.count(), "comparisons": int(pairs or 0)}


def match_people(
    people: DataFrame,
    consumers: DataFrame,
    mapping: Mapping[str, str] | None = None,
    rules: MatchRules | None = None,
    state: str | None = None,
    header: Header | None = None,
    state_exact: bool = False,
) -> DataFrame:
    """Match a list to a consumer table: all list columns plus the match columns.

    People are told apart by first name, last name, address, ZIP and ZIP+4 as they stand on the
    list; of rows that agree in all five one is kept unless ``rules.per_row``.
    """
    return match_with_sizes(people, consumers, mapping, rules, state, header, state_exact)[0]


def match_with_sizes(
    people: DataFrame,
    consumers: DataFrame,
    mapping: Mapping[str, str] | None = None,
    rules: MatchRules | None = None,
    state: str | None = None,
    header: Header | None = None,
    state_exact: bool = False,
) -> tuple[DataFrame, dict[str, int]]:
    """As :func:`match_people`, with what :func:`match_sizes` tells.

    Rows are counted while the sizes of the blocks are, which every match needs and stores once.
    """
    rules = rules or MatchRules()
    source = resolve_mapping(people.columns, mapping, header)
    require(source, PERSON)
    state = state_code(state)
    if state:
        require(source, ("state",))
        people = in_state(people, source["state"], state)
    columns = people.columns
    clash = [c for c in columns if c in MATCH_COLUMNS or c.startswith("_rc_")]
    if clash:
        raise ValueError(f"list columns with reserved names: {clash}")

    person = person_columns(source)
    chosen = in_state(consumers, "state", state, state_exact)
    blocks = Blocks.of(people, chosen, source, rules)
    sizes = {"people": blocks.people, "consumers": blocks.consumers, "comparisons": blocks.pairs}
    found = best_matches(blocked_list(people, source), blocked_consumers(chosen), source, columns, rules, blocks)
    if rules.per_row or rules.keep_unmatched:
        rows = people if rules.per_row else _one_per_person(people, person)
        found = _attach(rows, found, person, columns, rules)
    return found, sizes


def _one_per_person(people: DataFrame, person: list[str]) -> DataFrame:
    rest = [c for c in people.columns if c not in person]
    if not rest:
        return people.distinct()
    row = F.struct(*[F.col(quoted(c)) for c in rest])
    order = F.struct(*[F.col(quoted(c)) for c in _orderable(people, rest)] or [F.lit(0)])
    folded = people.groupBy(*[F.col(quoted(c)) for c in person]).agg(
        F.min_by(row, order).alias("_rc_row")
    )
    return folded.select(*[F.col(quoted(c)) for c in person], "_rc_row.*")


def _attach(
    rows: DataFrame, found: DataFrame, person: list[str], columns: list[str], rules: MatchRules
) -> DataFrame:
    """Give list rows the match of their person."""
    keys = {c: f"_rc_key{i}" for i, c in enumerate(person)}
    matches = found.select(
        *[F.col(quoted(c)).alias(k) for c, k in keys.items()], *MATCH_COLUMNS
    )
    same = [F.col(quoted(c)).eqNullSafe(F.col(k)) for c, k in keys.items()]
    joined = rows.join(matches, same, "left" if rules.keep_unmatched else "inner")
    if rules.keep_unmatched:
        joined = joined.withColumn("match_type", F.coalesce("match_type", F.lit(NO_MATCH)))
    return joined.select(*[F.col(quoted(c)) for c in (*columns, *MATCH_COLUMNS)])
