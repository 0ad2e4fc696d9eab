"""Secrets in texts, also below layers of encoding.

A worklist holds layers of a text. Each layer is scanned by the plain patterns; then every encoded
run in it is unwrapped: URL escapes, Unicode escapes, base64, and gzip, zlib, bzip2, xz or
Zstandard data inside base64, one in the other. Base64 is also read over line breaks and behind
what is glued to it. What comes out is a new layer, until no layer is new; a layer whose
content was seen at the same place before is not scanned again, so cycles end. Every layer keeps,
for each of its characters, where that character came from in the text, so findings are spans of it.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import codecs
import gzip
import hashlib
import io
import lzma
import re
import zlib
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from rollcall.llm.common import FINDINGS, small_batches, span_digests, texts

KINDS = ("assign", "access", "hex")
#: Bytes inflated at once, and the first bytes of a stream that tell what it is.
PIECE = 1 << 16
#: Characters of a window of inflated text, before it is cut at the end of a sentence, and the most
#: of one that has no such end.
WINDOW, LONGEST = 1 << 20, 1 << 24
#: Characters of a window that the next one starts with: after an end, and inside a run that is LONGEST.
OVERLAP, INSIDE = 1 << 8, 1 << 16

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ASSIGN_HINTS = ("passw", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of [0-9a-f]+ that are long enough
_URL_TAIL = re.compile(r"(?:%[0-9A-Fa-f]{2}[^\s%]*)+")
_ESCAPE_TAIL = re.compile(r"\\[ux](?:[^\s\\]|\\[ux])*")
_ESCAPE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\u\{([0-9A-Fa-f]{1,6})\}|\\x([0-9A-Fa-f]{2})")
_END = re.compile(r"[^A-Za-z0-9+/=_\-\s%\\]\s")  # no run of base64, wrapped or not, goes on here
_BASE64_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")

#: Lines of base64, each but the first and last as a whole; the last one may be short.
_BASE64_WRAPPED = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}\r?\n(?:[ \t]*[A-Za-z0-9+/_-]{16,}\r?\n)*[ \t]*[A-Za-z0-9+/_-]+={0,2}"
)
_BASE64_LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
_SIGN = re.compile(r"[+/_-]")


def _marks(characters: bytes) -> bytes:
    return bytes(120 if b in characters else 32 for b in range(256))


_HEX_MARKS = _marks(b"0123456789abcdef")
_BASE64_MARKS = _marks(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")


def plain_findings(text: str, raw: bytes) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) of the plain patterns, leftmost and without overlap in each kind."""
    low = text.lower()
    if any(hint in low for hint in _ASSIGN_HINTS):
        for m in _ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 6:
                yield "assign", m.start(), m.end()
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            if m.end() - m.start() >= 20:
                yield "access", m.start(), m.end()
    if b"x" * 24 in raw.translate(_HEX_MARKS):
        for m in _HEX.finditer(text):
            yield "hex", m.start(), m.end()


class Layer:
    """Decoded characters; character i came from starts[i] to ends[i] of the text."""

    def __init__(self, text: str, starts: list[int] | range, ends: list[int] | range, path: str) -> None:
        self.text, self.starts, self.ends, self.path = text, starts, ends, path

    def span(self, start: int, end: int) -> tuple[int, int]:
        return min(self.starts[start:end]), max(self.ends[start:end])

    def whole(self, start: int, end: int, text: str, how: str) -> Layer:
        """A layer of which every character came from all of start to end."""
        a, b = self.span(start, end)
        return Layer(text, [a] * len(text), [b] * len(text), f"{self.path}>{how}")


def _is_text(text: str) -> bool:
    """Whether there are few control characters, or bytes that are no character, in a text."""
    return sum(not (c.isprintable() or c in "\t\n\r") for c in text) * 20 <= len(text)


def _decoded(data: bytes) -> str | None:
    """Text of bytes that are text."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    return text if text and _is_text(text) else None


class _Source:
    """A stream whose first bytes can be looked at."""

    def __init__(self, read, first: int = PIECE) -> None:
        self.more, self.head = read, b""
        while len(self.head) < first and (piece := self._next(first)):
            self.head += piece
        self.rest = self.head

    def _next(self, n: int) -> bytes:
        """What can still be read; damaged data ends where the damage is."""
        try:
            return self.more(n)
        except (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError, zstandard.ZstdError):
            self.more = lambda _: b""
            return b""

    def read(self, n: int = PIECE) -> bytes:
        out, self.rest = self.rest[:n], self.rest[n:]
        return out or self._next(n)


class _Inflater:
    """zlib streams, one after the other."""

    def __init__(self, source: _Source) -> None:
        self.source, self.one, self.left = source, zlib.decompressobj(), b""

    def read(self, n: int) -> bytes:
        while True:
            if self.one.eof:
                self.left, self.one = self.one.unused_data or self.source.read(), zlib.decompressobj()
                if not _is_zlib(self.left):
                    return b""
            self.left = self.left or self.source.read()
            if out := self.one.decompress(self.left, n):
                self.left = self.one.unconsumed_tail
                return out
            self.left = self.one.unconsumed_tail
            if not self.one.eof and not self.left:
                self.left = self.source.read()
                if not self.left:
                    return b""


def _is_zlib(head: bytes) -> bool:
    return head[:1] == b"x" and len(head) > 2 and (head[0] << 8 | head[1]) % 31 == 0


def _opened(source: _Source):
    """Reads the content of compressed data, all its members, recognized by its first bytes."""
    head = source.head
    if head[:2] == b"\x1f\x8b":
        return gzip.GzipFile(fileobj=source).read1
    if _is_zlib(head):
        return _Inflater(source).read
    if head[:3] == b"BZh":
        return bz2.BZ2File(source).read1
    if head[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMAFile(source).read1
    if head[:4] == b"\x28\xb5\x2f\xfd":
        return zstandard.ZstdDecompressor().stream_reader(source, read_across_frames=True).read1
    return None


def _inflates(head: bytes) -> bool:
    """Whether anything comes out of data with this beginning."""
    read = _opened(_Source(io.BytesIO(head).read))
    return read is not None and bool(_Source(read, 1).head)


def _inflated(data: bytes) -> tuple[_Source, int] | None:
    """Innermost content of compressed data, if it is, and how often it was compressed.

    Data that holds itself, as far as its beginning tells, is not opened again.
    """
    source, seen = _Source(io.BytesIO(data).read), set()
    while source.head not in seen and _inflates(source.head):
        seen.add(source.head)
        source = _Source(_opened(source))
    return (source, len(seen)) if seen else None


def windows(source: _Source) -> Iterator[str]:
    """The text of a stream in parts that overlap, cut where neither a secret nor an encoded run is."""
    decoder = codecs.getincrementaldecoder("utf-8")("surrogateescape")
    held, more, wanted = "", True, WINDOW
    while more:
        piece = source.read()
        more = bool(piece)
        held += decoder.decode(piece, not more)
        if more and len(held) < wanted:
            continue
        cut, again = len(held), 0
        if more:
            ends = [m.end() for m in _END.finditer(held, len(held) - WINDOW // 2)]
            if not ends and len(held) < LONGEST:
                wanted = len(held) + WINDOW // 2
                continue
            cut, again = (ends[-1], OVERLAP) if ends else (len(held), INSIDE)
        if held[:cut] and _is_text(held[:cut]):
            yield held[:cut]
        held, wanted = held[max(0, cut - again) :], WINDOW


def _runs(text: str, tail: re.Pattern, sign: str) -> Iterator[tuple[int, int]]:
    """(start, end) of each run of unbroken text with escapes, grown to both sides of its first escape.

    Blanks and signs that begin no escape end a run. Every character is passed once in each direction.
    """
    done = 0
    for m in tail.finditer(text):
        start = m.start()
        while start > done and text[start - 1] != sign and not text[start - 1].isspace():
            start -= 1
        done = m.end()
        yield start, done


def _from_base64(run: str) -> Iterator[tuple[str, str]]:
    """(text, how) of a base64 run in either alphabet, with or without padding."""
    body = run.rstrip("=").translate({45: 43, 95: 47})
    if len(body) % 4 == 1:
        return
    try:
        data = base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return
    inner = _inflated(data)
    if inner is not None:
        for text in windows(inner[0]):
            yield text, "base64" + ">inflate" * inner[1]
    elif text := _decoded(data):
        yield text, "base64"


def _glued(run: str) -> Iterator[tuple[int, str, str]]:
    """(start, text, how) of base64 behind a sign of the run, if it is out of step with what went before."""
    done = {0} if any(True for _ in _from_base64(run)) else set()
    for m in _SIGN.finditer(run, 0, len(run) - 16):
        at = m.end()
        if at % 4 not in done and _starts_well(run[at : at + 16]):
            for text, how in _from_base64(run[at:]):
                done.add(at % 4)
                yield at, text, how


def _starts_well(run: str) -> bool:
    """Whether 16 characters of base64 can begin a text or compressed data."""
    if "=" in run.rstrip("=") or len(run) < 16:
        return False
    data = base64.b64decode(run.rstrip("=").translate({45: 43, 95: 47}) + "=" * (-len(run.rstrip("=")) % 4))
    if data[:2] == b"\x1f\x8b" or _is_zlib(data) or data[:3] == b"BZh" or data[:4] in (b"\xfd7zX", b"\x28\xb5\x2f\xfd"):
        return True
    return _is_text(codecs.getincrementaldecoder("utf-8")("surrogateescape").decode(data))


def _wrapped(layer: Layer, start: int, end: int) -> Iterator[Layer]:
    """Layers of base64 in lines; words in the first and last line may not belong to it."""
    lines = [m.span() for m in _BASE64_LINE.finditer(layer.text, start, end)]
    for first, last in ((0, 0), (0, 1), (1, 0), (1, 1)):
        part = lines[first : len(lines) - last]
        if len(part) > 1 or (part and len(lines) > 1 and first):
            found = False
            for text, how in _from_base64("".join(layer.text[a:b] for a, b in part)):
                found = True
                yield layer.whole(part[0][0], part[-1][1], text, how)
            if found:
                return


def _unescaped(layer: Layer, start: int, end: int, pattern: re.Pattern, value, how: str) -> Layer | None:
    """The run with escapes replaced, character by character."""
    text, starts, ends, at = [], [], [], start
    for m in pattern.finditer(layer.text, start, end):
        for i in range(at, m.start()):
            text.append(layer.text[i])
            starts.append(layer.starts[i])
            ends.append(layer.ends[i])
        plain = value(m)
        a, b = layer.span(m.start(), m.end())
        text.extend(plain)
        starts.extend([a] * len(plain))
        ends.extend([b] * len(plain))
        at = m.end()
    if at == start:
        return None
    for i in range(at, end):
        text.append(layer.text[i])
        starts.append(layer.starts[i])
        ends.append(layer.ends[i])
    return Layer("".join(text), starts, ends, f"{layer.path}>{how}")


def _escape_value(m: re.Match) -> str:
    code = int(m[1] or m[2] or m[3], 16)
    return chr(code) if code < 0xD800 or 0xDFFF < code < 0x110000 else "�"


_URL_BYTES = re.compile(r"(?:%[0-9A-Fa-f]{2})+")


def _url_value(m: re.Match) -> str:
    return bytes.fromhex(m[0].replace("%", "")).decode("utf-8", "replace")


def unwrapped(layer: Layer, raw: bytes) -> Iterator[Layer]:
    """The layers directly below a layer."""
    if "%" in layer.text:
        for start, end in _runs(layer.text, _URL_TAIL, "%"):
            if found := _unescaped(layer, start, end, _URL_BYTES, _url_value, "url"):
                yield found
    if "\\u" in layer.text or "\\x" in layer.text:
        for start, end in _runs(layer.text, _ESCAPE_TAIL, "\\"):
            if found := _unescaped(layer, start, end, _ESCAPE, _escape_value, "escape"):
                yield found
    if b"x" * 16 in raw.translate(_BASE64_MARKS):
        for m in _BASE64_RUN.finditer(layer.text):
            for found in _from_base64(m[0]):
                yield layer.whole(m.start(), m.end(), *found)
            for at, *found in _glued(m[0]):
                yield layer.whole(m.start() + at, m.end(), *found)
        if "\n" in layer.text:
            for m in _BASE64_WRAPPED.finditer(layer.text):
                yield from _wrapped(layer, m.start(), m.end())


def scan(text: str | None) -> list[tuple]:
    """(kind, start, end, base, score, layers) of a text, in order of start, kind and end."""
    if not text:
        return []
    found: dict[tuple, tuple] = {}
    hidden: dict[tuple, tuple] = {}
    # Layers are made one at a time, so that only one window of inflated text is held at each depth.
    work = [iter([Layer(text, range(len(text)), range(1, len(text) + 1), "text")])]
    seen: set[tuple] = set()
    while work:
        if (layer := next(work[-1], None)) is None:
            work.pop()
            continue
        if not layer.text:
            continue
        content = hashlib.blake2b(layer.text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        place = (content, layer.starts[0], layer.ends[-1])
        if place in seen:
            continue
        seen.add(place)
        raw = layer.text.encode("utf-8", "replace")
        base = layer.path == "text"
        for kind, start, end in plain_findings(layer.text, raw):
            key = (kind, *((start, end) if base else layer.span(start, end)))
            if base:
                found[key] = (*key, True, 1.0, layer.path)
            else:
                hidden.setdefault(key, (layer.path, layer.text[start:end]))
        work.append(unwrapped(layer, raw))
    # One secret can come out of two runs, one in the other; the wider counts.
    reached: dict[tuple, int] = {}
    for key in sorted(hidden.keys() - found.keys(), key=lambda k: (k[1], -k[2])):
        path, secret = hidden[key]
        if key[1] >= reached.get((key[0], secret), -1):
            reached[key[0], secret] = key[2]
            found[key] = (*key, False, 1.0, path)
    return sorted(found.values(), key=lambda f: (f[1], KINDS.index(f[0]), f[2]))


@F.pandas_udf(FINDINGS)
def _scan_column(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame({"found": pd.Series([scan(t) for t in text], dtype="object")})


def find_secrets(documents: DataFrame) -> DataFrame:
    """doc_id and found, the secrets of each text with their spans and layers.

    Findings on the text itself are ``base``; those of deeper layers span the encoded run that
    hides them. Null and empty texts have none. Repeated rows and null ids stay rows.
    """
    return texts(documents).select("doc_id", _scan_column("text")["found"].alias("found"))


def secret_digests(documents: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of each row."""
    return span_digests(find_secrets(documents), KINDS)


def redacted(text: str | None) -> str | None:
    """The text with every secret replaced by its kind in brackets; overlapping spans are joined."""
    if not text:
        return text
    out, at, spans = [], 0, []
    for kind, start, end, *_ in scan(text):
        if spans and start < spans[-1][2]:
            spans[-1][2] = max(spans[-1][2], end)
        else:
            spans.append([kind, start, end])
    for kind, start, end in spans:
        out += [text[at:start], f"[{kind}]"]
        at = end
    return "".join([*out, text[at:]])


@F.pandas_udf(StringType())
def _redact_column(text: pd.Series) -> pd.Series:
    return pd.Series([redacted(t) for t in text], dtype="object")


def secrets_redacted(documents: DataFrame) -> DataFrame:
    """The documents with secrets replaced in their texts; n_chars, if there is one, is counted anew."""
    small_batches(documents.sparkSession)
    clean = documents.withColumn("text", _redact_column("text"))
    if "n_chars" in documents.columns:
        same = F.col("n_chars").isNull() | F.col("text").isNull()
        clean = clean.withColumn("n_chars", F.when(same, F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return clean.select(*documents.columns)
