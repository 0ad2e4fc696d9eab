import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.llm import packing as p
from rollcall.llm.queries import tokenizer_path
from tests.llm.helpers import clashing, documents, odd_documents

PATH = tokenizer_path()


def best_fit_by_search(lengths, capacity):
    """Space left in each sequence, by looking at all open ones."""
    left = []
    for length in sorted(lengths, reverse=True):
        fitting = [(space, i) for i, space in enumerate(left) if space >= length]
        if fitting:
            left[min(fitting)[1]] -= length
        else:
            left.append(capacity - length)
    return sorted(left)


@pytest.mark.parametrize("capacity", [1, 7, 64, 100, 2048])
def test_tree_finds_the_tightest_sequence(capacity):
    rng = random.Random(capacity)
    for n in (0, 1, 5, 300):
        lengths = np.array([rng.randint(1, capacity) for _ in range(n)], dtype=np.int64)
        bins, offsets, left = p.best_fit_decreasing(lengths, capacity)
        assert sorted(left.tolist()) == best_fit_by_search(lengths.tolist(), capacity)
        for b in range(len(left)):
            own = sorted((o, size) for o, size, x in zip(offsets, lengths, bins) if x == b)
            assert [o for o, _ in own] == [sum(s for _, s in own[:i]) for i in range(len(own))]
            assert left[b] == capacity - sum(s for _, s in own)


TEXTS = [
    None, "", "Hello, World! it's 3.14... don't", "<|endoftext|> a <|STARTOFTEXT|> b", "İstanbul ΑΣ. ΑΣ, é é, \U0001f600.",
    "a\x1cb\x85c d", "x., y,. z.. ., .", "100,000.50, 7.", "line\r\nline\x0b\x0c", "ß ẞ ﬁ Ǆ.", "<b>tag</b>, <|x|>.",
    "J\u030C T\u0308 H\u0331 W\u030A Y\u030A j\u030C É E\u0301. \u0301 A\u030A,",
]


def test_ids_equal_the_tokenizer():
    encoder = p.WordEncoder(PATH)
    for text in TEXTS * 2:
        whole = encoder.tokenizer.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), dtype="<u4").tolist() == whole, text


def odd_words(n, seed=5):
    rng = random.Random(seed)
    parts = ["a", "th", "ion", "é", "Ç", "ß", "ÿ", "µ", "ª", "'", "'s", "'LL", "###", ".", ",", "-", "<|", "|>", "</w>", "7", "42", "Z", "\u0130", "\u0301", "中", "\U0001f600", "×", "_", "\\"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 6))) for _ in range(n)]


@pytest.mark.parametrize("together", [1, 7, 10_000])
def test_ids_of_odd_words_equal_the_tokenizer(monkeypatch, together):
    monkeypatch.setattr(p, "TOGETHER", together, raising=False)
    encoder = p.WordEncoder(PATH)
    words = odd_words(3000)
    texts = [" ".join(words[at : at + 50]) for at in range(0, len(words), 50)] + words[:300]
    found = encoder.encode_all(texts)
    for text, ids in zip(texts, found, strict=True):
        assert np.frombuffer(ids, dtype="<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_plain_words_go_to_the_tokenizer_as_few_texts(monkeypatch):
    encoder = p.WordEncoder(PATH)
    sent = []
    ids = encoder._ids
    monkeypatch.setattr(encoder, "_ids", lambda words: (sent.extend(words), ids(words))[1])
    encoder.encode_all([" ".join(f"{a}{b}{c}é###" for a in "abcdefgh" for b in "ijklmnop" for c in "qrstuvwx")])
    assert 0 < len(sent) < 10  # a text for each word before


def test_ids_stay_right_when_words_are_forgotten(monkeypatch):
    monkeypatch.setattr(p, "REMEMBERED", 3)
    test_ids_equal_the_tokenizer()


def test_two_generations_are_remembered():
    known = p.Remembered()
    known.update({b"a": b"1", b"b": b"2"})
    known.turn(1)
    assert known.has(b"a") and known[b"a"] == b"1" and not dict.__contains__(known, b"b")
    known[b"c"] = b"3"
    known.turn(1)
    assert known.has(b"a") and known.has(b"c") and not known.has(b"b")


def test_pieces_and_places(spark):
    long = " ".join(f"word{i}" for i in range(3000))
    docs = clashing(documents(spark, [*TEXTS, long, long]), "piece", "row", "shard", "offset", "ids")
    packed = p.pack_documents(docs, PATH, 256, keep_ids=True)
    rows = packed.collect()
    encoder = p.WordEncoder(PATH)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for doc_id, text in texts.items():
        own = sorted((r for r in rows if r["doc_id"] == doc_id), key=lambda r: r["piece"])
        ids = [i for r in own for i in r["ids"]]
        assert ids == [*np.frombuffer(encoder.encode(text), dtype="<u4").tolist(), 0]
        assert [r["start"] for r in own] == [256 * i for i in range(len(own))]
        assert all(r["length"] == 256 for r in own[:-1]) and len(own) == -(-len(ids) // 256)
        for r in own:
            assert r["length"] == len(r["ids"])
            assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes())
    check_places(rows, 256)
    total = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) == -(-total // 256)
    found = {r["sequence_id"]: len(r["ids"]) for r in p.sequences(packed).collect()}
    assert sum(found.values()) == total and max(found.values()) <= 256


def check_places(rows, capacity):
    ends = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(end <= capacity for end in ends.values())


def test_groups_mix_until_few_sequences_are_open(spark):
    pieces = spark.range(4000).select("id", (F.pmod(F.xxhash64("id"), F.lit(90)) + 1).alias("length"))
    rows = p.pack_pieces(pieces, 100, slack=0, group=400).collect()
    check_places(rows, 100)
    assert len(rows) == len({r["id"] for r in rows}) == 4000
    least = -(-sum(r["length"] for r in rows) // 100)
    alone = len({r["sequence_id"] for r in p.pack_pieces(pieces, 100, slack=0, group=10_000).collect()})
    assert least <= alone <= len({r["sequence_id"] for r in rows}) <= alone * 1.02 + 1


def test_pieces_that_never_fit_together_end(spark):
    pieces = spark.range(500).select("id", F.lit(60).cast("long").alias("length"))
    assert len({r["sequence_id"] for r in p.pack_pieces(pieces, 100, slack=2, group=50).collect()}) == 500


def test_odd_rows(spark):
    odd = odd_documents(spark)
    rows = p.pack_documents(odd, PATH).collect()
    check_places(rows, 2048)
    assert sum(r["piece"] == 0 for r in rows) == odd.count()
    assert p.pack_documents(odd.limit(0), PATH).count() == 0
