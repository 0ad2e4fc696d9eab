"""Ranked search against a plain version."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from rollcall.llm import ranked_search as rs
from tests.llm.helpers import DOCUMENTS, SMALL, clashing, documents, odd_documents

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, items, size=50):
    """Sorted (item_id, rank, doc_id, score) of rows (id, text)."""
    own = [(i, Counter(TERM.findall((t or "").translate(LOW)))) for i, t in docs]
    own = [(i, c) for i, c in own if c]
    n_docs, n_terms = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item_id, text in items:
        found = []
        for doc_id, c in own:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // n_terms
            score = 0
            for t in set(TERM.findall((text or "").translate(LOW))):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0:
                found.append((-score, doc_id is None, doc_id))
        found.sort(key=lambda f: (f[0], f[1], f[2] or 0))
        out += [(item_id, rank, doc_id, -minus) for rank, (minus, _, doc_id) in enumerate(found[:size], 1)]
    return sorted(out, key=repr)


def items_of(spark, texts):
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "item_id long, text string")


def found(docs, items, size=50):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in rs.search(docs, items, size).collect()), key=repr)


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def check(docs, items, size=50):
    expected = plain(rows_of(docs.select("doc_id", "text")), rows_of(items.select("item_id", "text")), size)
    assert found(docs, items, size) == expected
    return expected


def test_odd_rows(spark):
    texts = ["The CAT sat", "the cat, the Cat; THE cat", "É é É", "é x1 X1", "a_b a-b a\x00b", "中文 cat", "\x7f~!", "dog " * 300, "cat dog"]
    docs = odd_documents(spark, texts)
    items = items_of(spark, ["cat dog É", None, "", "!?", "no such term here", "cat cat CAT", (None, "two words same"), (3, "word1 word996 row"), (3, "b é")])
    assert check(docs, items) and check(docs, items, 2)
    clash = clashing(docs, "n", "terms", "query", "rank", "score", "item_id"), clashing(items, "query", "term", "doc_id", "rank")
    check(*clash)


def test_empty_tables(spark):
    docs, items = documents(spark, ["some text"]), items_of(spark, ["some"])
    assert found(docs.limit(0), items) == [] and found(docs, items.limit(0)) == []
    assert found(spark.createDataFrame([], DOCUMENTS), items_of(spark, [None])) == []


@pytest.fixture
def tight(monkeypatch):
    """Small blocks and seeds, so that bounds rise from block to block."""
    monkeypatch.setattr(rs, "BLOCK_ROWS", 40)
    monkeypatch.setattr(rs, "SLICE", 20)
    monkeypatch.setattr(rs, "SEED_DOCUMENTS", 150)


def random_texts(seed, n, words=60, ties=False):
    random.seed(seed)
    names = [f"w{i}" for i in range(words)]
    shares = [1 / (i + 1) for i in range(words)]
    made = [" ".join(random.choices(names, shares, k=random.choice((3, 5, 5, 20, 90)))) for _ in range(n)]
    return made + made[: n // 3] * 2 if ties else made


@pytest.mark.parametrize("seed", [1, 2])
def test_random_texts_in_small_blocks(spark, tight, seed):
    docs = documents(spark, random_texts(seed, 500, ties=seed == 2)).repartition(3)
    items = items_of(spark, random_texts(seed + 7, 30))
    check(docs, items, 10)


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(rs, "ITEM_TERMS", 40)
    check(documents(spark, random_texts(3, 200)), items_of(spark, random_texts(4, 20)), 5)


def test_whole_tables(spark, tight):
    check(spark.read.parquet(SMALL + "/documents.parquet"), spark.read.parquet(SMALL + "/benchmark.parquet"))


def test_pairs_tighten_bounds_and_lose_nothing():
    """Documents hold one of two rare terms, never both: pairs leave out what single bounds score."""
    rng = np.random.default_rng(5)
    import pyarrow as pa

    held = [[0], [1], [2], [0, 3], [1, 3], [2, 3]]
    own = [[0, 1, 2, 3]] + [held[i] for i in rng.integers(0, 6, 2000)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(own))), pa.array([len(x) for x in own], pa.int64()), pa.array(own, pa.list_(pa.int32())),
         pa.array([[1] * len(x) for x in own], pa.list_(pa.int64()))],
        names=["doc_id", "n", "terms", "counts"],
    )
    corpus = rs.Corpus(len(own), sum(map(len, own)))
    weights = np.array([3000, 2900, 2800, 10])
    block = rs.Block([batch], corpus, weights)
    terms = np.arange(4)
    everything = [(t, -1, 0) for t in range(4)]
    pairs = {p: block.both(*p)[1] for p in rs.near_pairs(terms, block.most)}
    units = rs.matched_units(terms, block.most, pairs)
    assert any(b >= 0 for _, b, _ in units)
    needed = sum(int(block.at(t, np.array([0]))[0]) for t in range(4))
    single, paired = (rs.Best(needed, 5) for _ in range(2))
    scored = rs.search_block(block, everything, single), rs.search_block(block, units, paired)
    assert scored[1] <= scored[0] and single.ids.tolist() == paired.ids.tolist() == [0]
    total = sum(rs.unit_bound(int(block.most[a]), int(block.most[b]) if b >= 0 else 0, j) for a, b, j in units)
    assert total <= block.most.sum() and total >= needed


def test_long_documents_do_not_overflow():
    corpus = rs.Corpus(10**12, 10**13)
    assert corpus.lengths(np.array([10**7])).tolist() == [50 + 50 * 10**7 * 10**12 // 10**13]
    assert corpus.weight(0) == math.floor(1000 * math.log(2 * 10**12 + 2))
