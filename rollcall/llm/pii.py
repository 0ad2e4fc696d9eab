"""Personal data in texts: patterns propose spans, checks confirm them, context moves the score.

E-mail and network addresses, card and phone numbers are found by plain patterns with their own
checks (parts up to 255, Luhn, number of digits). Beyond those, bank accounts need a valid mod-97
remainder, and social security numbers and local phone numbers need a word nearby that names them.
All patterns read a text once from left to right, whatever is in it.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import FINDINGS, span_digests, texts

KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("iban", "ssn", "local_phone")
#: Findings beyond the plain ones need this score.
LEAST_SCORE = 0.6
#: Characters on either side that count as near.
NEAR = 40

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+(-])(?:\([0-9]{2,5}\)\x20?|[0-9]{3}[.-])[0-9]{3,4}[\x20.-]?[0-9]{4}(?![0-9-])")
#: Words that name a kind of personal data; each nearby adds to the score.
_CONTEXT = {
    "iban": re.compile(r"\b(?:iban|account|konto|kontonummer|compte|cuenta|bank|banque|banco)\b", re.I),
    "ssn": re.compile(r"\b(?:ssn|social\s+security|tax\s*id|taxpayer)\b", re.I),
    "local_phone": re.compile(r"\b(?:tel|phone|telephone|mobile|fax|call|telefon|handy|anruf|t[ée]l[ée]phone|portable|tel[ée]fono|m[óo]vil)\b", re.I),
    "email": re.compile(r"\b(?:e-?mail|contact|kontakt|correo|courriel)\b", re.I),
    "ip": re.compile(r"\b(?:ip|host|server|address|client)\b", re.I),
    "card": re.compile(r"\b(?:card|visa|mastercard|amex|credit|karte|carte|tarjeta)\b", re.I),
}
_CONTEXT["phone"] = _CONTEXT["local_phone"]
#: What a confirmed match is worth without context.
_ALONE = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.4, "local_phone": 0.4}


def luhn(digits: str) -> bool:
    """Whether the last digit checks the others by the Luhn rule."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number, country and check digits first, leaves 1 modulo 97."""
    turned = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses without overlap, found from their @ outwards."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        done = domain.end() if domain else at + 1
        if domain:
            yield start, done
        at = text.find("@", done)


def plain_findings(text: str) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) of the plain patterns that pass their checks."""
    for start, end in emails(text):
        yield "email", start, end
    if not any(map(text.__contains__, "0123456789")):
        return
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            yield "ip", m.start(), m.end()
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield "card", m.start(), m.end()
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            yield "phone", m.start(), m.end()


def more_findings(text: str) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) beyond the plain patterns; account numbers are checked."""
    for m in _IBAN.finditer(text):
        end = m.end()
        # The pattern can run into a following capital word: the longest valid number counts.
        while end - m.start() >= 15:
            account = text[m.start() : end].replace(" ", "")
            if 15 <= len(account) <= 34 and mod97(account):
                yield "iban", m.start(), end
                break
            end = text.rfind(" ", m.start(), end)
    for m in _SSN.finditer(text):
        yield "ssn", m.start(), m.end()
    for m in _LOCAL_PHONE.finditer(text):
        yield "local_phone", m.start(), m.end()


def score(text: str, kind: str, start: int, end: int) -> float:
    """Worth of a confirmed match, with 0.3 for a word nearby that names its kind."""
    around = text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR]
    return min(1.0, _ALONE[kind] + 0.3 * bool(_CONTEXT[kind].search(around)))


def scan(text: str | None) -> list[tuple]:
    """(kind, start, end, base, score, layers) of a text, in order of start, kind and end."""
    if not text:
        return []
    found = [(k, a, b, True, score(text, k, a, b), None) for k, a, b in plain_findings(text)]
    if found or any(map(text.__contains__, "0123456789")):
        taken = sorted((a, b) for _, a, b, *_ in found)
        starts = [a for a, _ in taken]
        # The furthest end of all findings up to each.
        ends = list(accumulate((b for _, b in taken), max))
        for kind, start, end in more_findings(text):
            worth = score(text, kind, start, end)
            before = bisect_left(starts, end)
            if worth >= LEAST_SCORE and not (before and ends[before - 1] > start):
                found.append((kind, start, end, False, worth, None))
    order = {k: i for i, k in enumerate(KINDS + MORE_KINDS)}
    return sorted(found, key=lambda f: (f[1], order[f[0]], f[2]))


@F.pandas_udf(FINDINGS)
def _scan_column(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame({"found": pd.Series([scan(t) for t in text], dtype="object")})


def find_personal_data(documents: DataFrame) -> DataFrame:
    """doc_id and found, the personal data of each text with spans and scores.

    Matches of the plain patterns that pass their checks are ``base`` and always stay, whatever
    their score; others need ``LEAST_SCORE`` and must not overlap those. Null and empty texts have
    none. Repeated rows and null ids stay rows.
    """
    return texts(documents).select("doc_id", _scan_column("text")["found"].alias("found"))


def personal_data_digests(documents: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of each row."""
    return span_digests(find_personal_data(documents), KINDS)
