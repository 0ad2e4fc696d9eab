"""Person records on both sides of a match: column mapping, filters and comparison keys."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.names import Header, quoted, safe_name
from rollcall.functions.text import WORD_EXPANSIONS, normalize_text, zip4_key, zip_key

# Standard keys a mapping may name; the first five identify a person on a list.
PERSON = ("first_name", "last_name", "address", "zip", "zip4")
STANDARD = (*PERSON, "city", "state")
CONSUMER = ("id", *PERSON)

# Internal columns; the prefix keeps them apart from whatever a list contains.
ZIP, ZIP4 = "_rc_zip", "_rc_zip4"
FIRST, LAST, ADDRESS = "_rc_first", "_rc_last", "_rc_address"
BLOCK_KEYS = [ZIP, ZIP4]


def resolve_mapping(
    columns: list[str], mapping: Mapping[str, str] | None = None, header: Header | None = None
) -> dict[str, str]:
    """Input column of each standard key; a key that is not mapped stands for itself."""
    unknown = set(mapping or ()) - set(STANDARD)
    if unknown:
        raise ValueError(f"unknown keys in the column mapping: {sorted(unknown)}")
    resolved = {}
    for key in STANDARD:
        wanted = (mapping or {}).get(key, key)
        if header is not None:
            found = header.column_for(wanted)
        elif wanted in columns:
            found = wanted
        else:
            found = safe_name(wanted)
        if found in columns:
            resolved[key] = found
    return resolved


def require(resolved: Mapping[str, str], keys: tuple[str, ...]) -> None:
    missing = [key for key in keys if key not in resolved]
    if missing:
        raise ValueError(f"no input column for: {', '.join(missing)}")


def state_code(value: str | None) -> str | None:
    """Two-letter state of a filter option, or None for no filter."""
    if value is None or not value.strip():
        return None
    code = value.strip().upper()
    if len(code) != 2 or not code.isalpha():
        raise ValueError(f"a state filter is a two-letter code, not {value!r}")
    return code


def in_state(df: DataFrame, column: str, state: str | None, exact: bool = False) -> DataFrame:
    """Rows of one state; ``exact`` compares the stored text, which a Parquet scan can skip by."""
    if state is None:
        return df
    stored = F.col(quoted(column))
    return df.filter((stored if exact else F.upper(F.trim(stored))) == state)


@dataclass(frozen=True)
class Texts:
    """How texts are normalized before they are compared."""

    names: Mapping[str, str]
    addresses: Mapping[str, str]

    @classmethod
    def default(cls) -> Texts:
        return cls(WORD_EXPANSIONS, WORD_EXPANSIONS)


def block_keys(source: Mapping[str, str]) -> list[Column]:
    """Keys that both sides of a pair share."""
    return [
        zip_key(F.col(quoted(source["zip"]))).alias(ZIP),
        zip4_key(F.col(quoted(source["zip4"]))).alias(ZIP4),
    ]


def compared_texts(source: Mapping[str, str], texts: Texts, prefix: str = "") -> list[Column]:
    """Normalized texts, computed once per row."""
    words = {"first_name": texts.names, "last_name": texts.names, "address": texts.addresses}
    names = {"first_name": FIRST, "last_name": LAST, "address": ADDRESS}
    return [
        normalize_text(F.col(quoted(source[key])), words[key]).alias(prefix + names[key])
        for key in names
    ]


def can_match(source: Mapping[str, str]) -> Column:
    """Whether a row can match at all: every match type needs a ZIP and an address.

    Tested on the raw columns, so that texts are not normalized twice.
    """
    zip_code, address = (F.col(quoted(source[key])).cast("string") for key in ("zip", "address"))
    return F.coalesce((F.trim(zip_code) != "") & address.rlike(r"(?U)\S"), F.lit(False))


def comparable(df: DataFrame, source: Mapping[str, str]) -> DataFrame:
    """Rows that can match."""
    return df.filter(can_match(source))
