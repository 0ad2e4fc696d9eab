"""Similarity of two normalized texts, integers from 0 to 100.

``100 * 2 * LCS / (len(a) + len(b))``, rounded down, is the base measure (LCS is the
longest common subsequence). Whole-text, word-sorted and word-set similarity are Column
expressions. Partial similarity slides a window, and the best of all four, which the match
uses, shares its work between them: both are Arrow UDFs.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

# ---------------------------------------------------------------- Column expressions

# A bigint holds one bit per character of the shorter text, with room for the carry.
_BITS = 62


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _chars(c: Column) -> Column:
    return F.filter(F.split(c, ""), lambda ch: ch != "")


def _lcs_bits(texts: Column) -> Column:
    """Bit-parallel LCS length (Hyyro 2004); the shorter text fits one bigint."""
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")

    def bit(at: Column) -> Column:
        return F.call_function("shiftleft", one, at)

    def with_masks(t: Column) -> Column:
        def mask(ch: Column) -> Column:
            hits = F.transform(t["short"], lambda own, at: F.when(own == ch, bit(at)).otherwise(zero))
            return F.aggregate(hits, zero, lambda bits, hit: bits.bitwiseOR(hit))

        known = F.array_distinct(t["short"])
        return F.struct(
            F.map_from_arrays(known, F.transform(known, mask)).alias("masks"),
            (bit(F.size(t["short"])) - 1).alias("full"),
            t["long"].alias("long"),
        )

    def length(t: Column) -> Column:
        def step(state: Column, ch: Column) -> Column:
            hit = state.bitwiseAND(F.coalesce(F.try_element_at(t["masks"], ch), zero))
            return (state + hit).bitwiseOR(state - hit).bitwiseAND(t["full"])

        state = F.aggregate(t["long"], t["full"], step)
        return F.bit_count(F.bitwise_not(state).bitwiseAND(t["full"])).cast("int")

    return _bind(_bind(texts, with_masks), length)


def _lcs_rows(texts: Column) -> Column:
    """LCS length row by row, for two texts that are both longer than a bigint."""

    def length(t: Column) -> Column:
        letters, n = t["short"], F.size(t["short"])

        def next_row(row: Column, ch: Column) -> Column:
            return F.aggregate(
                F.sequence(F.lit(1), n),
                F.array(F.lit(0)),
                lambda done, at: F.concat(
                    done,
                    F.array(
                        F.when(F.get(letters, at - 1) == ch, F.get(row, at - 1) + 1).otherwise(
                            F.greatest(F.get(row, at), F.get(done, at - 1))
                        )
                    ),
                ),
            )

        return F.get(F.aggregate(t["long"], F.array_repeat(F.lit(0), n + 1), next_row), n)

    return _bind(texts, length)


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence."""

    def ordered(t: Column) -> Column:
        a_first = F.size(t["a"]) <= F.size(t["b"])
        return F.struct(
            F.when(a_first, t["a"]).otherwise(t["b"]).alias("short"),
            F.when(a_first, t["b"]).otherwise(t["a"]).alias("long"),
        )

    def length(t: Column) -> Column:
        n = F.size(t["short"])
        return (
            F.when(n == 0, F.lit(0)).when(n <= _BITS, _lcs_bits(t)).otherwise(_lcs_rows(t))
        )

    return _bind(_bind(F.struct(_chars(a).alias("a"), _chars(b).alias("b")), ordered), length)


def _percent(common: Column, total: Column) -> Column:
    return F.floor(F.lit(200) * common / total).cast("int")


def _gated(a: Column, b: Column, score: Column) -> Column:
    """Blank or NULL on either side scores 0, equal texts score 100."""
    blank = a.isNull() | b.isNull() | (a == "") | (b == "")
    return F.when(blank, F.lit(0)).when(a == b, F.lit(100)).otherwise(score)


def indel_ratio(a: Column, b: Column) -> Column:
    """Similarity of the whole texts."""
    return _gated(a, b, _percent(lcs_length(a, b), F.length(a) + F.length(b)))


def _tokens(c: Column) -> Column:
    return F.filter(F.split(c, r"(?U)\s+"), lambda token: token != "")


def token_sort_ratio(a: Column, b: Column) -> Column:
    """Similarity after sorting the words of each text."""
    left = F.array_join(F.array_sort(_tokens(a)), " ")
    right = F.array_join(F.array_sort(_tokens(b)), " ")
    both = F.struct(left.alias("a"), right.alias("b"))
    return _gated(a, b, _bind(both, lambda t: indel_ratio(t["a"], t["b"])))


def token_set_ratio(a: Column, b: Column) -> Column:
    """Similarity of the word sets: what both share against what each has on top."""

    def join(words: Column) -> Column:
        return F.array_join(F.array_sort(words), " ")

    def rests(t: Column) -> Column:
        return F.struct(
            F.length(join(F.array_intersect(t["a"], t["b"]))).alias("n"),
            join(F.array_except(t["a"], t["b"])).alias("a"),
            join(F.array_except(t["b"], t["a"])).alias("b"),
        )

    def score(t: Column) -> Column:
        # The shared words are a common prefix, so each LCS follows from that of the rests.
        n, x, y = t["n"], F.length(t["a"]), F.length(t["b"])
        best = F.greatest(
            _percent(n, n + n + 1 + x),
            _percent(n, n + n + 1 + y),
            _percent(n + 1 + lcs_length(t["a"], t["b"]), n + n + 2 + x + y),
        )
        return (
            F.when(n == 0, indel_ratio(t["a"], t["b"]))
            .when((x == 0) | (y == 0), F.lit(100))
            .otherwise(best)
        )

    words = F.struct(
        F.array_distinct(_tokens(a)).alias("a"), F.array_distinct(_tokens(b)).alias("b")
    )
    return _gated(a, b, _bind(_bind(words, rests), score))


# ---------------------------------------------------------------- Arrow UDFs

# The helpers below travel with the UDF, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _positions(text: str) -> dict[str, int]:
    """Bit mask of the places of each character."""
    where: dict[str, int] = {}
    for at, ch in enumerate(text):
        where[ch] = where.get(ch, 0) | 1 << at
    return where


def _running_lcs(where: dict[str, int], size: int, other: str) -> Iterator[int]:
    """LCS length of a text (its positions and size) with each prefix of the other."""
    full = state = (1 << size) - 1
    for ch in other:
        hit = state & where.get(ch, 0)
        state = ((state + hit) | (state - hit)) & full
        yield size - state.bit_count()


def _lcs(a: str, b: str) -> int:
    full = state = (1 << len(a)) - 1
    where = _positions(a)
    for ch in b:
        hit = state & where.get(ch, 0)
        state = ((state + hit) | (state - hit)) & full
    return len(a) - state.bit_count()


def _best_window(short: str, long: str, common: int, best: int) -> int:
    """Highest score of ``short`` on a window of ``long``, or ``best`` if none beats it."""
    if short in long:
        return 100
    n, where = len(short), _positions(short)
    for size, shared in enumerate(_running_lcs(where, n, long[: n - 1]), start=1):
        best = max(best, 200 * shared // (n + size))
    for start in range(len(long)):
        window = long[start : start + n]
        # A full window ending in a foreign character is no better than its left neighbour.
        if len(window) == n and window[-1] not in where:
            continue
        total = n + len(window)
        if 200 * min(common, len(window)) // total > best:
            *_, shared = _running_lcs(where, n, window)
            best = max(best, 200 * shared // total)
    return best


def best_partial_score(a: str, b: str) -> int:
    """Best score of the shorter text on a stretch of the longer one of its length or less."""
    if not a or not b:
        return 0
    short, long = sorted((a, b), key=len)
    best = _best_window(short, long, len(short), 0)
    return _best_window(long, short, len(short), best) if len(short) == len(long) else best


def best_edit_score(a: str, b: str, needed: int = 0) -> int:
    """Best of whole, word-sorted, word-set and partial similarity.

    Exact from ``needed`` up; below it the result is only known to be below it.
    """
    if not a or not b:
        return 0
    if a == b:
        return 100
    words_a, words_b = a.split(), b.split()
    many = len(words_a) > 1 or len(words_b) > 1
    shared = set(words_a) & set(words_b)
    if many and shared and len(shared) in (len(set(words_a)), len(set(words_b))):
        return 100
    common = _lcs(a, b)
    best = 200 * common // (len(a) + len(b))
    if many:
        x, y = " ".join(sorted(words_a)), " ".join(sorted(words_b))
        best = max(best, 200 * _lcs(x, y) // max(len(x) + len(y), 1))
        n = len(" ".join(shared))
        x = " ".join(sorted(set(words_a) - shared))
        y = " ".join(sorted(set(words_b) - shared))
        if shared:
            rest = 200 * (n + 1 + _lcs(x, y)) // (2 * n + 2 + len(x) + len(y))
            best = max(best, 200 * n // (2 * n + 1 + min(len(x), len(y))), rest)
        else:
            best = max(best, 200 * _lcs(x, y) // max(len(x) + len(y), 1))
    short, long = sorted((a, b), key=len)
    # A window shares at most ``common`` characters, which bounds every partial score.
    if 200 * common // (len(short) + common or 1) > max(best, needed - 1):
        best = _best_window(short, long, common, best)
        if len(short) == len(long):
            best = _best_window(long, short, common, best)
    return best


def _traits(text: str) -> tuple[int, int, int, frozenset[str]]:
    """Length, number of words, bag of characters and different words of a text.

    The bag has a bit for each occurrence of a character: the first ones, the second ones and so on,
    in rows of 64. Characters that share a place only make bags look more alike.
    """
    bag, seen = 0, [0] * 64
    for ch in text:
        place = ord(ch) % 64
        bag |= 1 << (place + 64 * seen[place])
        seen[place] += 1
    words = text.split()
    return len(" ".join(words)), len(words), bag, frozenset(words)


def _may_reach(a: tuple, b: tuple, needed: int) -> bool:
    """Whether two texts with these traits can score ``needed``: common characters bound every LCS.

    A bound is only taken where no word occurs twice in a text.
    """
    (size_a, n_a, bag_a, words_a), (size_b, n_b, bag_b, words_b) = a, b
    if n_a != len(words_a) or n_b != len(words_b):
        return True
    common = (bag_a & bag_b).bit_count()
    # A window is no longer than the shorter text and shares at most ``common`` characters with it.
    best = 200 * common // (min(size_a, size_b) + common or 1)
    if best >= needed:
        return True
    shared = words_a & words_b
    if not shared:
        return False  # the whole texts share less than a window may
    if len(shared) in (n_a, n_b):
        return True
    n = sum(map(len, shared)) + len(shared) - 1
    x, y = size_a - n - 1, size_b - n - 1
    rest = min(x, y, max(0, common - n - 1))
    return max(200 * n // (2 * n + 1 + min(x, y)), 200 * (n + 1 + rest) // (2 * n + 2 + x + y)) >= needed


def _forms(name: str) -> list[str]:
    return list(dict.fromkeys([name, *(part for part in re.split(r"[\s\-]+", name) if part)]))


def best_name_part_score(a: str, b: str) -> int:
    """Best score of a name or one of its parts against the other name or one of its parts."""
    return max(best_edit_score(x, y) for x in _forms(a) for y in _forms(b))


def _scorer(score):
    def column_scorer(a: pd.Series, b: pd.Series) -> pd.Series:
        known = lru_cache(maxsize=None)(score)  # names repeat within an Arrow batch
        scores = [known(x, y) if x and y else 0 for x, y in zip(a, b)]
        return pd.Series(scores, index=a.index, dtype="int32")

    # Non-deterministic, so that a filter on the score is not pushed below the projection
    # (which would evaluate the score twice per pair).
    return F.pandas_udf(column_scorer, IntegerType()).asNondeterministic()


def _scorer_from(needed: int):
    """As the scorer of ``best_edit_score``; pairs whose characters rule out ``needed`` are not compared."""

    def column_scorer(a: pd.Series, b: pd.Series) -> pd.Series:
        traits = lru_cache(maxsize=None)(_traits)  # a text meets many others within an Arrow batch

        @lru_cache(maxsize=None)
        def known(x: str, y: str) -> int:
            if x == y:
                return 100
            return best_edit_score(x, y, needed) if _may_reach(traits(x), traits(y), needed) else 0

        scores = [known(x, y) if x and y else 0 for x, y in zip(a, b)]
        return pd.Series(scores, index=a.index, dtype="int32")

    return F.pandas_udf(column_scorer, IntegerType()).asNondeterministic()


_whole_text = _scorer(best_edit_score)
_partial = _scorer(best_partial_score)
_name_parts = _scorer(best_name_part_score)


def partial_ratio(a: Column, b: Column) -> Column:
    """Best similarity of the shorter text to any stretch of the longer one of its length or less."""
    return _partial(a, b)


def edit_score(a: Column, b: Column, needed: int = 0) -> Column:
    """Best of the four similarities; below ``needed`` only known to be below it."""
    if needed:
        return _scorer_from(needed)(a, b)
    return _whole_text(a, b)


def name_part_score(a: Column, b: Column) -> Column:
    """As :func:`edit_score`, also comparing the parts of compound names."""
    return _name_parts(a, b)
