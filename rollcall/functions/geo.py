"""Geography in the cells of targeting sheets: ZIPs, ZIP prefixes, states and tier labels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The fifty states, by name.
STATES = {
    "alabama": "AL",
    "alaska": "AK",
    "arizona": "AZ",
    "arkansas": "AR",
    "california": "CA",
    "colorado": "CO",
    "connecticut": "CT",
    "delaware": "DE",
    "florida": "FL",
    "georgia": "GA",
    "hawaii": "HI",
    "idaho": "ID",
    "illinois": "IL",
    "indiana": "IN",
    "iowa": "IA",
    "kansas": "KS",
    "kentucky": "KY",
    "louisiana": "LA",
    "maine": "ME",
    "maryland": "MD",
    "massachusetts": "MA",
    "michigan": "MI",
    "minnesota": "MN",
    "mississippi": "MS",
    "missouri": "MO",
    "montana": "MT",
    "nebraska": "NE",
    "nevada": "NV",
    "new_hampshire": "NH",
    "new_jersey": "NJ",
    "new_mexico": "NM",
    "new_york": "NY",
    "north_carolina": "NC",
    "north_dakota": "ND",
    "ohio": "OH",
    "oklahoma": "OK",
    "oregon": "OR",
    "pennsylvania": "PA",
    "rhode_island": "RI",
    "south_carolina": "SC",
    "south_dakota": "SD",
    "tennessee": "TN",
    "texas": "TX",
    "utah": "UT",
    "vermont": "VT",
    "virginia": "VA",
    "washington": "WA",
    "west_virginia": "WV",
    "wisconsin": "WI",
    "wyoming": "WY",
}
# Phrases that make a state the audience, words that make a text a tier label.
AUDIENCE_PHRASES = ("all zips", "balance of", "zips in")
LABEL_WORDS = ("balance", "county", "co.", "co ", "non-", "non ", "all zips", "zips in")
DASHES = ("-", "–", "—")

GEO_TYPES = ("zip", "scf", "state")


def slug(c: Column) -> Column:
    """Lower-case words joined by underscores."""
    return F.btrim(F.regexp_replace(F.lower(strip(c)), "[^a-z0-9]+", "_"), F.lit("_"))


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"(?U)^[\s\x{1C}-\x{1F}]+|[\s\x{1C}-\x{1F}]+\z", "")


def cell_text(c: Column) -> Column:
    """Trimmed cell, NULL when blank or ``nan``."""
    text = strip(c)
    return F.when((text != "") & (F.lower(text) != "nan"), text)


def _contains_any(text: Column, words: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | F.contains(text, F.lit(word))
    return found


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _state(text: Column, spelled: Column, compat: bool) -> Column:
    codes = F.array(*[F.lit(code) for code in STATES.values()])
    names = sorted(STATES) if compat else sorted(STATES, key=lambda name: (-len(name), name))
    table = F.array(
        *[F.struct(F.lit(n).alias("name"), F.lit(STATES[n]).alias("code")) for n in names]
    )
    if compat:
        words = F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\b[a-z]{2}\b"), F.lit(0))
    else:
        words = F.when(text.rlike(r"^[A-Za-z]{2}\z"), F.array(text)).otherwise(
            F.regexp_extract_all(text, F.lit(r"(?U)\b(?!CO\.)[A-Z]{2}\b"), F.lit(0))
        )
    by_code = F.filter(F.transform(words, F.upper), lambda word: F.array_contains(codes, word))
    by_name = F.filter(table, lambda row: F.contains(spelled, row["name"]))
    return F.coalesce(F.get(by_code, F.lit(0)), F.get(by_name, F.lit(0))["code"])


def state_in_text(c: Column, compat: bool = False) -> Column:
    """Two-letter code of the state a text names, NULL if none.

    A two-letter word wins over a spelled-out name. It has to be in capitals (unless it is the
    whole text), so that "in" or "or" is no state, and ``CO.`` stands for county; of several
    names the longest counts ("West Virginia"). ``compat`` takes two-letter words in any case
    and the first name in alphabetical order.
    """
    return _bind(strip(c), lambda text: _state(text, slug(text), compat))


def _geo(text: Column, low: Column, state: Column) -> tuple[Column, Column]:
    is_state = state.isNotNull() & (
        low.rlike(r"^[a-z]{2}\z") | _contains_any(low, AUDIENCE_PHRASES)
    )
    kind = (
        F.when(text.rlike(r"^[0-9]{5}\z"), "zip")
        .when(text.rlike(r"^[0-9]{3}\z"), "scf")
        .when(is_state, "state")
    )
    value = F.when(text.rlike(r"^(?:[0-9]{5}|[0-9]{3})\z"), text).when(is_state, state)
    return kind, value


def _is_label(text: Column, low: Column, state: Column, compat: bool) -> Column:
    tier = F.contains(low, F.lit("tier")) if compat else low.rlike(r"(?U)\btier")
    qualified = (
        state.isNotNull() | _contains_any(low, LABEL_WORDS) | _contains_any(text, DASHES)
    )
    return F.coalesce(tier & qualified, F.lit(False))


def read_cell(c: Column, compat: bool = False) -> Column:
    """What a cell says, as a struct: ``label`` (slug) and ``label_state`` of a narrative tier
    label such as "Tier 1 OH - Non-Lucas Co. Ohio", else ``geo_type`` and ``geo_value``.

    A cell of five digits is a ZIP, of three a ZIP prefix. A state counts when it is the whole
    cell or comes with a phrase of inclusion. All fields are NULL for any other cell.
    """

    def read(cell: Column) -> Column:
        text, low, spelled, state = (cell[f] for f in ("text", "low", "slug", "state"))
        label = _is_label(text, low, state, compat)
        kind, value = _geo(text, low, state)
        return _bind(
            label,
            lambda is_label: F.struct(
                F.when(is_label, spelled).alias("label"),
                F.when(is_label, state).alias("label_state"),
                F.when(~is_label, kind).alias("geo_type"),
                F.when(~is_label, value).alias("geo_value"),
            ),
        )

    def with_state(cell: Column) -> Column:
        return F.struct(
            cell["text"].alias("text"),
            cell["low"].alias("low"),
            cell["slug"].alias("slug"),
            _state(cell["text"], cell["slug"], compat).alias("state"),
        )

    def forms(text: Column) -> Column:
        return F.struct(text.alias("text"), F.lower(text).alias("low"), slug(text).alias("slug"))

    return _bind(_bind(_bind(cell_text(c), forms), with_state), read)
