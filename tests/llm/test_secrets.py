import base64
import bz2
import gzip
import hashlib
import lzma
import re
import time
import zlib
from urllib.parse import quote

import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from rollcall.llm import secrets as s
from tests.llm.helpers import clashing, documents, odd_documents

ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def base(text):
    """(kind, start, end) by the plain patterns as they are stated."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda f: (f[1], s.KINDS.index(f[0])))


PIECES = ["password", "PassWd", "token", "api_key", "apikey", "ſecret", "secret", " ", "=", ":", '"', "'", "abc", "abcdef12", "AKIA", "ABCDEFGH12345678",
          "0123456789abcdef", "deadbeef", "\n", "é", "-", "%3D", "\\u003d", "x"]


@settings(max_examples=400)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_plain_findings(text):
    assert [f[:3] for f in s.scan(text) if f[3]] == base(text)


SECRET = "password=hunter2secret"


def b64(data):
    return base64.b64encode(data).decode()


@pytest.mark.parametrize("wrap", [
    lambda t: quote(t, safe=""), lambda t: b64(t.encode()), lambda t: "".join(f"\\u{ord(c):04x}" for c in t),
    lambda t: b64(gzip.compress(t.encode())), lambda t: b64(zlib.compress(t.encode())), lambda t: b64(bz2.compress(t.encode())),
    lambda t: b64(lzma.compress(t.encode())), lambda t: b64(zstandard.compress(t.encode())),
    lambda t: quote(b64(t.encode()), safe=""), lambda t: b64(b64(gzip.compress(quote(t, safe="").encode())).encode()),
    lambda t: base64.urlsafe_b64encode(b"\xc3\xbf>" + t.encode()).decode().rstrip("="), lambda t: "".join(f"\\x{ord(c):02x}" for c in t),
])
def test_layers_are_unwrapped(wrap):
    text = f"é before {wrap(SECRET)} after"
    found = [f for f in s.scan(text) if f[0] == "assign"]
    assert len(found) == 1 and not found[0][3]
    start, end = found[0][1:3]
    assert 9 <= start < end <= len(text) - 6


def test_spans_of_escapes_are_exact():
    text = "x=1 password%3Dhunter2secret%20 y"
    assert [(f[0], text[f[1] : f[2]]) for f in s.scan(text)] == [("assign", "password%3Dhunter2secret")]
    assert s.redacted(text) == "x=1 [assign]%20 y"


def test_cycles_and_bombs_end():
    deep = SECRET
    for _ in range(12):
        deep = b64(deep.encode())
    assert [f[0] for f in s.scan(deep)] == ["assign"]
    bomb = b64(gzip.compress(b"a " * (30 << 20)))
    assert [f[0] for f in s.scan(bomb)] == []
    assert s.scan("%25" * 2000) == [] and s.scan("\\" * 5000) == []


def test_long_texts_are_read_once():
    for text in ("a" * 200_000, "%41" * 20_000, "\\u0041" * 20_000, "token" * 40_000, "A" * 200_000, "\\u" * 50_000, "\\x41\\" * 20_000):
        s.scan(text)


def test_rows_of_digests(spark):
    texts = [f"a {SECRET} b 0123456789abcdef0123456789", "clean text", "AKIA" + "B" * 16 + " " + b64(SECRET.encode())]
    odd = clashing(odd_documents(spark, texts), "found", "spans", "n_hex")
    rows = s.secret_digests(odd).collect()
    assert len(rows) == odd.count()
    empty = hashlib.sha256(b"").hexdigest()
    assert {r["base_sha256"] for r in rows if (r["doc_id"] or 0) < 100} == {empty}
    for r in rows:
        if (r["doc_id"] or 0) >= 100:
            found = base(texts[r["doc_id"] - 100])
            joined = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
            assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
            assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(f[0] == k for f in found) for k in s.KINDS)
            assert r["spans"].startswith(joined)
    assert [r["spans"].count("assign") for r in rows if r["doc_id"] == 102] == [1]
    assert s.secret_digests(odd.limit(0)).count() == 0


def test_documents_are_redacted(spark):
    docs = clashing(documents(spark, [None, "", "clean", f"x {SECRET} y"]), "found")
    rows = {r["doc_id"]: r for r in s.secrets_redacted(docs).collect()}
    assert s.secrets_redacted(docs).columns == docs.columns
    assert [rows[i]["text"] for i in range(4)] == [None, "", "clean", "x [assign] y"]
    assert [rows[i]["n_chars"] for i in range(4)] == [None, 0, 5, 12]


COMPRESS = [gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress]


def kinds_in(data):
    return [f[0] for f in s.scan(f"see {b64(data)} end") if f[0] == "assign"]


@pytest.mark.parametrize("compress", COMPRESS)
def test_all_of_long_compressed_data_is_scanned(compress):
    long = "é word, ".encode() * ((17 << 20) // 9)
    assert kinds_in(compress(long + SECRET.encode())) == ["assign"]
    assert kinds_in(compress(b"x" + SECRET.encode() + b" " + "é".encode() * (9 << 20))) == ["assign"]


@pytest.mark.parametrize("compress", COMPRESS)
def test_all_members_are_scanned(compress):
    assert kinds_in(compress(b"first, ") + compress(SECRET.encode())) == ["assign"]


def test_windows_hold_runs_whole():
    run = b64(SECRET.encode() * 3)
    text = "some prose, " * 200_000 + run + " and. " + "more, " * 200_000
    for shift in (0, 7, 1 << 19):
        parts = list(s.windows(s._Source(s.io.BytesIO(b"." * shift + text.encode()).read)))
        assert len(parts) > 2 and any(run in p for p in parts)


@pytest.mark.parametrize("outer", COMPRESS)
@pytest.mark.parametrize("inner", COMPRESS)
def test_compressed_in_compressed(outer, inner):
    assert kinds_in(outer(inner(SECRET.encode()))) == kinds_in(outer(inner(outer(SECRET.encode())))) == ["assign"]


@pytest.mark.parametrize("width", [64, 76])
@pytest.mark.parametrize("end", ["\n", "\r\n", "\n    "])
@pytest.mark.parametrize("compress", [bytes, *COMPRESS])
@pytest.mark.parametrize("frame", ["{}", "key: {} end", "-----BEGIN CERTIFICATE-----\n{}\n-----END CERTIFICATE-----", "a\n{}\nafter"])
def test_wrapped_base64(width, end, compress, frame):
    noise = hashlib.sha512(b"1").hexdigest().upper()
    run = b64(compress(f"{noise[:90]} {SECRET} {noise} {noise[:70]}.".encode()))
    text = frame.format(end.join(run[i : i + width] for i in range(0, len(run), width)))
    found = [f for f in s.scan(text) if f[0] == "assign"]
    assert len(found) == 1
    assert text[found[0][1] : found[0][2]].split()[0][:8] == (run[:8] if found[0][1] == text.index(run[:8]) else found[0])


@pytest.mark.parametrize("glue", ["/x/", "/ab/c/", "url/path/to/", "/x_y/"])
@pytest.mark.parametrize("compress", [bytes, *COMPRESS])
def test_base64_glued_to_a_path(glue, compress):
    for text in (SECRET, SECRET + "?>?>?>?"):
        found = s.scan(f"at {glue}{b64(compress(text.encode()))} end")
        assert [f[0] for f in found] == ["assign"]


def test_data_that_holds_itself_ends(monkeypatch):
    monkeypatch.setattr(s, "_opened", lambda source: s.io.BytesIO(source.head).read)
    assert s._inflated(b"itself")[1] == 1


SPELLED = (
    "a%41%42 %zz%41 100% %4 %%41%", "x" * 40 + "%41%zz%42yy", "a\\u0041\\x42\\n\\u{1F600}z \\u12 \\\\u0041 q\\x4\\x41",
    "caf\u00e9%C3%A9\u3000%41", "\\", "%", "\\u", "a\\\\x41b\\x42 c",
)


@pytest.mark.parametrize("text", SPELLED)
def test_runs_are_those_of_the_plain_patterns(text):
    url = re.compile(r"[^\s%]*(?:%[0-9A-Fa-f]{2}[^\s%]*)+")
    escape = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2}|[^\s\\])*\\[ux](?:[^\s\\]|\\[ux])*")
    assert list(s._runs(text, s._URL_TAIL, "%")) == [m.span() for m in url.finditer(text)]
    assert list(s._runs(text, s._ESCAPE_TAIL, "\\")) == [m.span() for m in escape.finditer(text)]


@pytest.mark.parametrize("unit", ["x", "\u4e2d"])
@pytest.mark.parametrize("end", [" 5%", "%", "\\x", " \\u", "%4", "\\u{"])
def test_unbroken_runs_are_read_in_linear_time(unit, end):
    start = time.time()
    assert s.scan(unit * 200_000 + end) == []
    assert time.time() - start < 5
