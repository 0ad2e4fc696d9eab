"""Column names and delimiters taken from a list header (driver side, header only)."""

from __future__ import annotations

import csv
import re
from collections import Counter
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

# Delimiter words accepted besides the character itself.
DELIMITER_WORDS = {"tab": "\t", "pipe": "|"}


def delimiter_text(option: str | None) -> str:
    """Delimiter for a user option: none, a word, an escape such as ``\\t`` or the text itself."""
    if not option:
        return ","
    if option.lower() in DELIMITER_WORDS:
        return DELIMITER_WORDS[option.lower()]
    if "\\" in option:
        try:
            return option.encode("ascii").decode("unicode_escape")
        except UnicodeError:
            return option
    return option


def safe_name(raw: str | None) -> str:
    """Lower-case name of ``[a-z0-9_]`` that never starts with a digit; may be empty."""
    name = "_".join(re.findall(r"[a-z0-9]+", (raw or "").lower()))
    return f"_{name}" if name[:1].isdigit() else name


def unique_names(names: Iterable[str | None]) -> list[str]:
    """Fill blanks with ``col_<position>`` and number repeats until every name is unused."""
    taken: set[str] = set()
    result = []
    for position, name in enumerate(names, start=1):
        base = (name or "").strip() or f"col_{position}"
        candidate, copy = base, 1
        while candidate in taken:
            copy += 1
            candidate = f"{base}_{copy}"
        taken.add(candidate)
        result.append(candidate)
    return result


def quoted(name: str) -> str:
    """Backtick-quoted identifier, safe for dots, spaces and backticks in the name."""
    if name is None:
        raise ValueError("a column name is required")
    return "`" + str(name).replace("`", "``") + "`"


@dataclass(frozen=True)
class Header:
    """First line of a list: the line, its delimiter, original and safe names."""

    line: str
    delimiter: str
    original: tuple[str, ...]
    names: tuple[str, ...]

    @classmethod
    def parse(cls, line: str, delimiter: str | None = None) -> Header:
        sep = delimiter_text(delimiter)
        if not line or not line.strip():
            raise ValueError("the header line is blank")
        # The csv module takes one character only, so a longer delimiter is read as one that the line lacks.
        mark = sep if len(sep) == 1 else next(c for c in map(chr, range(0xE000, 0xF8FF)) if c not in line)
        fields: Sequence[str]
        fields = [f.replace(mark, sep) for f in next(csv.reader([line.replace(sep, mark)], delimiter=mark))]
        original = tuple(field.strip().strip('"') for field in fields)
        return cls(line, sep, original, tuple(unique_names(safe_name(f) for f in original)))

    @property
    def ddl(self) -> str:
        return ", ".join(f"{quoted(name)} STRING" for name in self.names)

    @property
    def duplicate_safe_names(self) -> list[str]:
        """Safe names that more than one header field maps to, before numbering."""
        counts = Counter(name for name in map(safe_name, self.original) if name)
        return sorted(name for name, n in counts.items() if n > 1)

    def column_for(self, wanted: str) -> str:
        """Input column for an original header, a safe name or something that sanitizes to one."""
        hits = [safe for raw, safe in zip(self.original, self.names) if raw == wanted]
        if len(hits) > 1:
            raise ValueError(f"ambiguous mapping: {wanted!r} occurs {len(hits)} times in the header")
        if hits:
            return hits[0]
        return wanted if wanted in self.names else safe_name(wanted)
