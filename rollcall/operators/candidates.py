"""Which texts of a group have to be compared.

Small groups compare everything with everything. A group whose pairs would exceed a limit
is narrowed first by an exact condition on character grams, so a ZIP or an address that
holds a large share of all rows does not lead to all its pairs.

The condition. A score of at least T leaves at most ``e`` edits (characters only one side
has) between the shorter of the two compared strings, of length n, and what it is compared
with: ``e = (n + n * (200 - T) / T) * (100 - T) / 100``. One edit spoils at most one of
several disjoint grams, so of any ``e + 1`` disjoint grams inside the words of the shorter
text one occurs unchanged inside a word of the other text. That holds for whole, word-sorted,
word-set and windowed comparison, as none of them breaks up words. Each side looks up the
``e + 1`` grams that are rarest on the other side, and of all its disjoint grams (and of its
letters) all but ``e`` must occur there. Texts too short to have ``e + 1`` are compared with
the whole group, in pieces of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from rollcall.functions.phonetic import PHONETIC_SCORE, phonetic_codes
from rollcall.functions.text import name_forms
from rollcall.storage import materialize

# Pairs a group may have before it is narrowed by grams.
PAIR_LIMIT = 250_000
# Groups over the limit are broadcast up to this number.
BROADCAST_GROUPS = 100_000
# Rows of one gram and side that meet in one piece.
PIECE = 2_000
# Longest gram used.
GRAM = 5


def group_sizes(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of both sides and their pairs, for every group that occurs on both."""
    n = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("left_rows"))
    m = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("right_rows"))
    # Sizes are multiplied as doubles: two hot groups may exceed a bigint.
    return n.join(m, list(keys)).withColumn(
        "pairs", F.col("left_rows").cast("double") * F.col("right_rows")
    )


def large_groups(
    left: DataFrame, right: DataFrame, keys: Sequence[str], limit: int = PAIR_LIMIT
) -> DataFrame | None:
    """Keys of the groups over the limit, or None if there are none."""
    found = materialize(group_sizes(left, right, keys).filter(F.col("pairs") > limit).select(*keys))
    if found.isEmpty():
        return None
    return F.broadcast(found) if found.count() <= BROADCAST_GROUPS else found


# Hash values of the groups of one side, which bound what is broadcast of them.
BUCKETS = 1 << 20
# Rows from which on a group that occurs on one side only is left out by name.
LONELY_ROWS = 10_000


def group_table(left: DataFrame, right: DataFrame, keys: Sequence[str], fits: str) -> DataFrame:
    """Stored sizes of every group: rows of both sides, those that fit, and the pairs of these."""

    def sizes(side: DataFrame, name: str) -> DataFrame:
        counts = F.count_if(fits).alias(f"{name}_rows"), F.count(F.lit(1)).alias(f"{name}_all")
        return side.groupBy(*keys).agg(*counts)

    joined = sizes(left, "left").join(sizes(right, "right"), list(keys), "full").na.fill(0)
    return materialize(joined.withColumn("pairs", F.col("left_rows").cast("double") * F.col("right_rows")))


def chosen_groups(groups: DataFrame, condition: Column, n: int, keys: Sequence[str]) -> DataFrame | None:
    """Keys of the ``n`` stored groups that meet a condition, or None if none does; few are broadcast."""
    if not n:
        return None
    found = groups.filter(condition).select(*keys)
    return F.broadcast(found) if n <= BROADCAST_GROUPS else found


def with_partners(left: DataFrame, right: DataFrame, keys: Sequence[str], lonely: DataFrame | None = None) -> DataFrame:
    """Rows of the left side without most that no row of the right side shares a group with.

    A row stays if the hash of its group is among those of the right side, of which there are at most
    ``BUCKETS``; they are broadcast, so rows go before anything is shuffled. ``lonely`` names groups
    that go in any case.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
    known = F.broadcast(right.select(bucket.alias("_rc_bucket")).distinct())
    kept = left.withColumn("_rc_bucket", bucket).join(known, "_rc_bucket", "left_semi").drop("_rc_bucket")
    return kept if lonely is None else kept.join(lonely, list(keys), "left_anti")


def _edits(text: Column, threshold: int) -> Column:
    n = F.length(text)
    longest = n + F.floor(n * (200 - threshold) / threshold)
    return F.floor(longest * (100 - threshold) / 100).cast("int")


def _words(text: Column) -> Column:
    return F.filter(F.array_distinct(F.split(text, " ")), lambda word: word != "")


def _gram_lengths(words: Column, needed: Column) -> Column:
    """Gram lengths at which the words contain the needed number of disjoint grams."""

    def enough(size: Column) -> Column:
        pieces = F.transform(words, lambda word: F.floor(F.length(word) / size).cast("int"))
        return F.aggregate(pieces, F.lit(0), lambda total, n: total + n) >= needed

    return F.filter(F.sequence(F.lit(1), F.lit(GRAM)), enough)


def _cut(word: Column, size: Column, step: Column) -> Column:
    """Grams of one word, every ``step`` characters."""
    last = F.length(word) - size + 1
    return F.when(last < 1, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1)), step), lambda at: word.substr(at, size))
    )


def _disjoint_grams(words: Column, size: Column) -> Column:
    return F.array_distinct(F.flatten(F.transform(words, lambda word: _cut(word, size, size))))


def _all_grams(text: Column) -> Column:
    words = _words(text)
    sizes = F.sequence(F.lit(1), F.lit(GRAM))
    return F.array_distinct(
        F.flatten(
            F.transform(
                words,
                lambda word: F.flatten(F.transform(sizes, lambda size: _cut(word, size, F.lit(1)))),
            )
        )
    )


# Stands for "compare with the whole group"; no gram is blank.
_ANY = ""


def _picks(
    side: DataFrame, other_grams: DataFrame, group: list[str], text: str, threshold: int, parts: bool
) -> DataFrame:
    """The grams of each text that are looked up on the other side.

    Of the possible gram lengths each text takes the one whose picks are rarest over there.
    ``_all`` are all its disjoint grams of that length and ``_letters`` its letters; of each all
    but ``_edits`` must occur.
    """
    forms = name_forms(F.col(text)) if parts else F.array(F.col(text))
    uses = other_grams.groupBy(*group, "_gram").agg(F.count(F.lit(1)).alias("_uses"))
    words, edits = F.col("_words"), F.col("_edits")
    sizes = F.coalesce(
        F.nullif(_gram_lengths(words, edits + 1), F.array().cast("array<int>")), F.array(F.lit(0))
    )
    cut = (
        side.select(*side.columns, F.explode(forms).alias("_form"))
        .withColumns({"_edits": _edits(F.col("_form"), threshold), "_words": _words(F.col("_form"))})
        .select("*", F.explode(sizes).alias("_size"))
        .withColumn(
            "_all",
            F.when(F.col("_size") == 0, F.array().cast("array<string>")).otherwise(
                _disjoint_grams(words, F.greatest(F.col("_size"), F.lit(1)))
            ),
        )
        .select(
            *side.columns, "_form", "_edits", "_size", "_all",
            F.explode(F.when(F.col("_size") == 0, F.array(F.lit(_ANY))).otherwise(F.col("_all"))).alias("_gram"),
        )
    )
    counted = cut.join(uses, [*group, "_gram"], "left").withColumn(
        "_uses", F.coalesce("_uses", F.lit(0))
    )
    # The grams of one text are few, so they can be put together.
    ranked = counted.groupBy(*side.columns, "_form", "_edits", "_size", "_all").agg(
        F.slice(F.sort_array(F.collect_list(F.struct("_uses", "_gram"))), F.lit(1), edits + 1).alias("_rare")
    )
    total = F.aggregate("_rare", F.lit(0).cast("bigint"), lambda sum_, pick: sum_ + pick["_uses"])
    chosen = ranked.groupBy(*side.columns, "_form", "_edits").agg(
        F.min_by(F.struct("_rare", "_all"), F.struct(total, -F.col("_size"))).alias("_best")
    )
    return chosen.select(
        *side.columns, "_edits", F.col("_best._all").alias("_all"),
        _disjoint_grams(_words(F.col("_form")), F.lit(1)).alias("_letters"),
        F.explode("_best._rare._gram").alias("_gram"),
    )


def _grid(
    picks: DataFrame, other: DataFrame, keys: list[str], piece: int = PIECE
) -> tuple[DataFrame, DataFrame]:
    """Both sides with the pieces in which the rows of a frequent gram meet.

    A gram with many rows is cut into pieces on either side; each piece of one side is copied to
    all pieces of the other, so every pair meets once and a piece has bounded rows. The sides
    are partitioned by gram and pieces, in a fixed number of partitions: a few megabytes of
    grams can meet in millions of pairs, so they must not be put together by size.
    """
    n = picks.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    m = other.groupBy(*keys).agg(F.count(F.lit(1)).alias("_m"))
    frequent = materialize(n.join(m, keys).filter((F.col("_n") > piece) | (F.col("_m") > piece)))
    partitions = int(picks.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def cut(side: DataFrame, own: str, own_rows: str, others: str, other_rows: str) -> DataFrame:
        pieces = {c: F.coalesce(F.ceil(F.col(c) / piece), F.lit(1)) for c in (own_rows, other_rows)}
        placed = side.join(frequent, keys, "left").select(
            *side.columns,
            F.pmod(F.xxhash64(*[c for c in side.columns if c not in keys and _hashable(side, c)]), pieces[own_rows]).alias(own),
            F.explode(F.sequence(F.lit(0).cast("bigint"), pieces[other_rows] - 1)).alias(others),
        )
        return placed.repartition(partitions, *keys, own, others)

    return cut(picks, "_p", "_n", "_q", "_m"), cut(other, "_q", "_m", "_p", "_n")


def _hashable(df: DataFrame, column: str) -> bool:
    return not isinstance(df.schema[column].dataType, (MapType, VariantType))


def _gram_pairs(
    left: DataFrame,
    right: DataFrame,
    group: list[str],
    left_text: str,
    right_text: str,
    threshold: int,
    parts: bool,
) -> DataFrame:
    columns = [*left.columns, *[c for c in right.columns if c not in group]]

    def grams(side: DataFrame, text: str) -> DataFrame:
        own = F.concat(_all_grams(F.col(text)), F.array(F.lit(_ANY)))
        return side.select(*side.columns, F.explode(own).alias("_gram"))

    def looked_up(side: DataFrame, text: str, other: DataFrame, other_text: str) -> DataFrame:
        picks = _picks(side, other, group, text, threshold, parts)

        def enough(grams: str) -> Column:
            kept = F.filter(grams, lambda gram: F.contains(F.col(other_text), gram))
            return F.size(kept) >= F.size(grams) - F.col("_edits")

        picked, held = _grid(materialize(picks), other, [*group, "_gram"])
        met = picked.join(held, [*group, "_gram", "_p", "_q"])
        return met.filter(enough("_letters") & enough("_all")).select(*columns)

    forward = looked_up(left, left_text, grams(right, right_text), right_text)
    back = looked_up(right, right_text, grams(left, left_text), left_text)
    return forward.unionByName(back).distinct()


def _code_pairs(
    left: DataFrame, right: DataFrame, group: list[str], left_text: str, right_text: str, parts: bool
) -> DataFrame:
    """Pairs that sound alike: one join on the phonetic codes."""

    def coded(side: DataFrame, text: str) -> DataFrame:
        forms = name_forms(F.col(text)) if parts else F.array(F.col(text))
        return side.select(*side.columns, F.explode(phonetic_codes(forms)).alias("_code"))

    return (
        coded(left, left_text)
        .join(coded(right, right_text), [*group, "_code"])
        .select(*left.columns, *[c for c in right.columns if c not in group])
        .distinct()
    )


def text_pairs(
    left: DataFrame,
    right: DataFrame,
    group: list[str],
    left_text: str,
    right_text: str,
    threshold: int,
    parts: bool = False,
    phonetic: bool = True,
    limit: int = PAIR_LIMIT,
) -> DataFrame:
    """Pairs within a group that include every pair scoring at least ``threshold``.

    Both sides hold distinct rows with texts that are not blank. ``parts`` says that compound
    names are also compared by their parts.
    """
    large = large_groups(left, right, group, limit)
    if large is None:
        return left.join(right, group)
    columns = [*left.columns, *[c for c in right.columns if c not in group]]
    small = left.join(large, group, "left_anti").join(
        right.join(large, group, "left_anti"), group
    )
    big_left = left.join(large, group, "left_semi")
    big_right = right.join(large, group, "left_semi")
    found = _gram_pairs(big_left, big_right, group, left_text, right_text, threshold, parts)
    if phonetic and threshold <= PHONETIC_SCORE:
        found = found.unionByName(
            _code_pairs(big_left, big_right, group, left_text, right_text, parts)
        ).distinct()
    return small.select(*columns).unionByName(found)
