"""Normalization of names, addresses and ZIP keys as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whole words and what they stand for when texts are compared.
WORD_EXPANSIONS = {
    "jr": "junior",
    "sr": "senior",
    "ii": "2",
    "iii": "3",
    "iv": "4",
    "v": "5",
    "vi": "6",
    "vii": "7",
    "viii": "8",
    "ix": "9",
    "x": "10",
    "st": "saint",
    "mt": "mount",
    "dr": "doctor",
    "rev": "reverend",
    "hon": "honorable",
    "prof": "professor",
    "mr": "mister",
    "mrs": "missus",
    "ms": "miss",
    "miss": "miss",
    "mstr": "master",
}

# Optional replacement for addresses: street words are spelled out instead of "saint"/"doctor".
STREET_EXPANSIONS = {
    **WORD_EXPANSIONS,
    "st": "street",
    "dr": "drive",
    "rd": "road",
    "ave": "avenue",
    "blvd": "boulevard",
    "ln": "lane",
    "ct": "court",
}


def blank_to_null(c: Column) -> Column:
    """Trim spaces; an empty result becomes NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def squeeze(c: Column) -> Column:
    """One space between words, none around them, lower case."""
    # Most texts have single spaces already, and finding that out is cheaper than replacing.
    irregular = c.rlike(r"(?U)[^\S ]|  ")
    spaced = F.when(irregular, F.regexp_replace(c, r"(?U)\s+", " ")).otherwise(c)
    return F.lower(F.trim(spaced))


def expand_words(c: Column, words: Mapping[str, str]) -> Column:
    """Replace whole words by their expansion, in one pass and only where one occurs."""
    if not words:
        return c
    table = F.create_map(*[F.lit(part) for pair in words.items() for part in pair])
    expanded = F.array_join(
        F.transform(
            F.split(c, r"(?U)\b"), lambda run: F.coalesce(F.try_element_at(table, run), run)
        ),
        "",
    )
    return F.when(c.rlike(rf"(?U)\b(?:{'|'.join(words)})\b"), expanded).otherwise(c)


def normalize_text(c: Column, words: Mapping[str, str] = WORD_EXPANSIONS) -> Column:
    """Text as the scorers compare it; NULL becomes an empty string."""
    return expand_words(squeeze(F.coalesce(c.cast("string"), F.lit(""))), words)


def code_key(c: Column, width: int) -> Column:
    """First ``width`` characters of a code, left-padded with zeros; blank stays blank."""
    head = F.substring(F.trim(F.coalesce(c.cast("string"), F.lit(""))), 1, width)
    return F.when(head == "", F.lit("")).otherwise(F.lpad(head, width, "0"))


def zip_key(c: Column) -> Column:
    return code_key(c, 5)


def zip4_key(c: Column) -> Column:
    return code_key(c, 4)


def name_parts(c: Column) -> Column:
    """Pieces of a name between spaces and hyphens."""
    return F.filter(F.split(c, r"(?U)[\s\-]+"), lambda part: part != "")


def name_forms(c: Column) -> Column:
    """The whole name and its pieces, each once."""
    return F.array_distinct(F.concat(F.array(c), name_parts(c)))
