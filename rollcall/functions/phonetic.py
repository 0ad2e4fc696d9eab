"""Phonetic codes as Column expressions (no Python per row) and their agreement.

Each code is a chain of replacements after the published descriptions: Soundex,
Metaphone (1990), NYSIIS (1970) and the Match Rating codex (1977). Characters that
are not letters have no sound: Soundex keeps one only in first place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _rewrite(c: Column, rules: Sequence[tuple[str, str]]) -> Column:
    for pattern, replacement in rules:
        c = F.regexp_replace(c, pattern, replacement)
    return c


def soundex_code(c: Column) -> Column:
    """First character and up to three digits; H and W do not separate equal digits."""
    text = F.upper(c)
    # Letter groups of the published code. Other characters separate like a vowel.
    letters, digits = "BFPVCGJKQSXZDTLMNR", "111122222222334556"
    silent = F.regexp_replace(text, "(?<=.)[HW]", "")
    coded = F.translate(F.regexp_replace(silent, "[^A-Z]", "_"), letters, digits)
    sounds = _rewrite(coded, [(r"([1-6])\1+", "$1"), ("^.", ""), ("[^1-6]", "")])
    return F.when(text == "", F.lit("")).otherwise(
        F.concat(F.substring(text, 1, 1), F.rpad(F.substring(sounds, 1, 3), 3, "0"))
    )


# Sounds are written in lower case while letters still to be read are upper case.
_METAPHONE = (
    # initial letter groups
    ("^(?:AE|GN|KN|PN|WR)", "<$0"),
    ("^<.", ""),
    ("^X", "S"),
    ("^WH", "W"),
    # doubled letters count once, except C
    (r"([A-BD-Z])\1+", "$1"),
    # silent letters
    ("(?<=M)B$", ""),
    ("(?<=S)C(?=[EIY])", ""),
    ("G(?=H[^AEIOU])", ""),
    ("G(?=N(?:ED)?$)", ""),
    # letter groups
    ("SCH", "sk"),
    ("TCH", "x"),
    ("C(?=IA)", "x"),
    ("CH", "x"),
    ("C(?=[EIY])", "s"),
    ("[CQ]K?", "k"),
    ("DG(?=[EIY])", "j"),
    ("D", "t"),
    ("G(?=[EIY])", "j"),
    ("PH", "f"),
    ("SH", "x"),
    ("[ST](?=I[AO])", "x"),
    ("TH", "0"),
    # H sounds only before a vowel and not after C, G, P, S or T (those are read by now)
    ("(?<=[AEIOUG])H(?![AEIOU])", ""),
    ("(?<=G)H", ""),
    ("G", "k"),
    ("K", "k"),
    ("X", "ks"),
    ("[WY](?![AEIOU])", ""),
    # vowels sound only at the start of a word
    ("(?<=[^ ])[AEIOU]", ""),
    ("[^A-Za-z0 ]", ""),
)


def metaphone_code(c: Column) -> Column:
    """Consonant sounds of the text, initial vowels kept; digits and signs have no sound."""
    letters = F.regexp_replace(F.upper(c), "[^A-Z ]", "")
    return F.translate(F.upper(_rewrite(letters, _METAPHONE)), "VZ", "FS")


_NYSIIS = (
    # first characters
    ("^MAC", "MCC"),
    ("^KN", "NN"),
    ("^K", "C"),
    ("^P[HF]", "FF"),
    ("^SCH", "SSS"),
    # last characters
    ("(?:EE|IE)$", "Y"),
    ("(?:DT|RT|RD|NT|ND)$", "D"),
    # the rest, after the first character
    ("(?<=.)EV", "AF"),
    ("(?<=.)Q", "G"),
    ("(?<=.)Z", "S"),
    ("(?<=.)M", "N"),
    ("(?<=.)KN", "NN"),
    ("(?<=.)K", "C"),
    ("(?<=.)SCH", "SSS"),
    ("(?<=.)PH", "FF"),
    # H next to a consonant repeats the letter before it, W after a vowel too
    ("(?<=[^AEIOU])H", ""),
    ("(?<=[AEIOU])H(?![AEIOU])", ""),
    ("(?<=[AEIOU])W", ""),
    ("(?<=.)[AEIOU]", "A"),
    # repeated characters, then the endings
    (r"(.)\1+", "$1"),
    ("(?<=.)S$", ""),
    ("AY$", "Y"),
    ("(?<=.)A$", ""),
)


def nysiis_code(c: Column) -> Column:
    return _rewrite(F.upper(c), _NYSIIS)


def match_rating_code(c: Column) -> Column:
    """Without inner vowels and doubled consonants; first and last three letters if longer than six."""
    kept = _rewrite(
        F.upper(c), [(r"([^AEIOU])\1+", "$1"), ("(?<=.)[AEIOU]", ""), (" ", "")]
    )
    return F.when(
        F.length(kept) > 6, F.concat(F.substring(kept, 1, 3), F.substring(kept, -3, 3))
    ).otherwise(kept)


PHONETIC_CODES = {
    "soundex": soundex_code,
    "metaphone": metaphone_code,
    "nysiis": nysiis_code,
    "match_rating": match_rating_code,
}

# Fixed value: score of two different texts that share a code.
PHONETIC_SCORE = 90


def phonetic_codes(forms: Column) -> Column:
    """All codes of an array of texts, each marked with its kind."""
    kinds = [
        F.transform(F.transform(forms, code), lambda value: F.concat(F.lit(f"{kind}:"), value))
        for kind, code in PHONETIC_CODES.items()
    ]
    return F.array_distinct(F.concat(*kinds))


def forms_agree(a_forms: Column, b_forms: Column) -> Column:
    """True when any of one array of texts shares a code with any of the other."""
    agree = F.lit(False)
    for code in PHONETIC_CODES.values():
        agree = agree | F.arrays_overlap(F.transform(a_forms, code), F.transform(b_forms, code))
    return agree


def codes_agree(a: Column, b: Column) -> Column:
    """True when the texts have one of the four codes in common."""
    return forms_agree(F.array(a), F.array(b))


def phonetic_score(a: Column, b: Column) -> Column:
    """100 for equal texts, 90 when a code agrees, 0 otherwise or when one is blank."""
    blank = a.isNull() | b.isNull() | (a == "") | (b == "")
    return (
        F.when(blank, F.lit(0))
        .when(a == b, F.lit(100))
        .when(codes_agree(a, b), F.lit(PHONETIC_SCORE))
        .otherwise(F.lit(0))
    )
