import random
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from rollcall.llm import simhash as s
from rollcall.llm.components import components
from tests.llm.helpers import SMALL, clashing, documents, odd_documents


def test_every_word_decodes_to_the_codeword_within_three_bits():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 1 << 12, 500)
    codewords = (data << 11) | s._remainders(data << 11)
    for errors in range(4):
        noise = np.array([sum(1 << int(b) for b in rng.choice(23, errors, replace=False)) for _ in data])
        assert (s.decode(codewords ^ noise) == data).all()
    weights = np.bitwise_count((np.arange(4096) << 11) | s._remainders(np.arange(4096) << 11))
    assert weights[1:].min() == 7


def test_five_bits_always_share_a_key():
    rng = np.random.default_rng(2)
    one = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    for bits in range(6):
        two = one.copy()
        for i in range(len(two)):
            for b in rng.choice(64, bits, replace=False):
                two[i] ^= np.uint64(1 << int(b))
        keys = [set(), set()]
        for found, values in zip(keys, (one, two)):
            found.update(zip(*(x.tolist() for x in s.fingerprint_keys(values))))
        assert {i for i, _ in keys[0] & keys[1]} == set(range(300))


def fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    votes = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in votes) > len(votes))


def closure(values, linked):
    """Smallest index reachable from each value."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if find(i) != find(j) and linked(values[i], values[j]):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return [find(i) for i in range(len(values))]


def near_texts(seed=3, n=60):
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        words = [f"{rng.choice('abcdefgh')}{rng.randint(0, 400)}" for _ in range(rng.randint(30, 200))]
        texts.append(" ".join(words))
        for _ in range(rng.randint(0, 3)):
            copy = words.copy()
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = "new" + str(rng.random())
            texts.append(" ".join(copy).upper() if rng.random() < 0.2 else " ".join(copy))
    return texts


@pytest.mark.parametrize("shifts", [64, 2])
def test_components_equal_brute_force(spark, monkeypatch, shifts):
    monkeypatch.setattr(s, "SHIFTS", shifts)  # tasks of local mode import the module themselves
    texts = [None, "", " ", "one", "one two", "ONE TWO", *near_texts(), *["copy of words here"] * 30]
    prints = [fingerprint(t) for t in texts]
    wanted = closure(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    rows = s.simhash_components(documents(spark, texts)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["fingerprint"] == f"{prints[r['doc_id']]:016x}"
        assert r["component_id"] == wanted[r["doc_id"]]


@pytest.mark.parametrize("seed", range(4))
def test_large_groups_are_searched_whole(seed):
    rng = np.random.default_rng(seed)
    values = rng.integers(0, 1 << 12, 300, dtype=np.uint64)
    values = np.unique(values << np.uint64(20))
    first = s.group_stars(values[:, None], s.within_bits(1))
    assert first.tolist() == closure(values.tolist(), lambda a, b: (a ^ b).bit_count() <= 1)
    key = np.repeat([5, 9], [len(values), 3])
    both = np.r_[values, values[:3]]
    links = s.group_links(key, both[:, None], np.arange(len(both)), s.within_bits(1))
    groups = closure(list(range(len(both))), lambda a, b: any((x == a and y == b) or (x == b and y == a) for x, y in links))
    assert groups[: len(values)] == first.tolist()


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    edges = spark.createDataFrame([*chain, *star, (7, 7), (1, 0), (500, 400)], "a long, b long")
    found = {r["node"]: r["root"] for r in components(edges).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 400: 400, 500: 400}
    assert components(edges.limit(0)).count() == 0


def test_odd_rows(spark):
    odd = clashing(odd_documents(spark), "print", "fingerprint", "node", "least")
    rows = s.simhash_components(odd).collect()
    assert len(rows) == odd.count()
    assert {r["component_id"] for r in rows if r["fingerprint"] == "0" * 16} == {1}
    assert s.simhash_components(odd.limit(0)).count() == 0


def similarity(a, b):
    def shingles(text):
        words = (text or "").encode().lower().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def test_sketches_estimate_similarity():
    rng = random.Random(5)
    near = s.alike(0.77)
    for n in (40, 300, 3000):
        words = [str(rng.random()).encode() for _ in range(n)]
        for share, wanted in ((0.0, True), (0.12, False)):
            other = [b"x%d" % i if rng.random() < share else w for i, w in enumerate(words)]
            a, b = (np.frombuffer(s.shingle_sketch(w), dtype=np.uint8)[None] for w in (words, other))
            assert near(a, b)[0] == wanted


def test_one_of_each_group_of_near_copies_stays(spark):
    texts = near_texts(9, 80)
    groups = closure(texts, lambda a, b: similarity(a, b) >= 0.8)
    docs = clashing(documents(spark, [*texts, texts[0], None, "", " "]), "prints", "node", "text_hash", "root")
    kept = s.near_copies_removed(docs)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    sure = closure(texts, lambda a, b: similarity(a, b) >= 0.74)
    assert {g for g in sure} <= ids  # a clean text stays
    assert ids <= set(groups) | {len(texts) + 1}
    assert len(texts) not in ids and len(texts) + 1 in ids


def test_equal_rows_and_null_ids(spark):
    docs = documents(spark, [(7, "a b c d e f"), (7, "a b c d e f"), (None, "a b c d e f"), (None, "other words")])
    kept = sorted(s.near_copies_removed(docs).select("doc_id", "text").collect(), key=str)
    assert [tuple(r) for r in kept] == [(7, "a b c d e f"), (None, "other words")]
    assert s.near_copies_removed(docs.limit(0)).count() == 0


@pytest.mark.parametrize("chunk", [3, 50_000])
def test_groups_in_chunks_lose_no_link(spark, monkeypatch, chunk):
    monkeypatch.setattr(s, "CHUNK", chunk)
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(base[:i] + [f"n{i}"] + base[i + 1 :]) for i in range(0, 200, 9)]
    assert s.near_copies_removed(documents(spark, texts)).select("doc_id").collect()[0]["doc_id"] == 0


def test_near_copies_of_the_small_tables(spark):
    docs = spark.read.parquet(SMALL + "/documents.parquet")
    rows = docs.collect()
    kept = {r["doc_id"] for r in s.near_copies_removed(docs).collect()}
    texts = [r["text"] for r in rows]
    for row in rows:
        if row["doc_id"] not in kept:
            assert any(similarity(row["text"], t) > 0.7 for t in texts if t is not row["text"]) or texts.count(row["text"]) > 1
    pairs = [(a, b) for i, a in enumerate(rows) for b in rows[:i] if a["doc_id"] in kept and b["doc_id"] in kept and similarity(a["text"], b["text"]) >= 0.85]
    assert not pairs
    assert docs.filter(F.col("doc_id").isin(list(kept))).count() == len(kept)


def copies_of(kind, words, rng, wanted):
    """A copy by one kind of edit whose similarity to ``words`` is just ``wanted`` or more."""
    best = words
    for n in range(1, len(words)):
        new = [f"n{rng.random()}" for _ in range(n)]
        copy = {"append": words + new, "prepend": new + words, "truncate": words[:-n], "behead": words[n:]}[kind]
        if similarity(" ".join(words), " ".join(copy)) < wanted:
            break
        best = copy
    return best


@pytest.mark.parametrize("kind", ["append", "prepend", "truncate", "behead"])
def test_contiguous_edits_are_candidates(spark, kind):
    rng, texts = random.Random(kind), []
    for i in range(60):
        words = [f"w{rng.random()}" for _ in range(rng.randint(60, 300))]
        texts += [" ".join(words), " ".join(copies_of(kind, words, rng, (0.8, 0.85, 0.9)[i % 3]))]
    nodes = documents(spark, texts).select(F.col("doc_id").alias("node"), s._signature("text").alias("s")).select("node", "s.bands")
    found = {(r["a"], r["b"]) for r in s.band_links(nodes).collect()}
    assert found == {(i, i + 1) for i in range(0, 120, 2)}


def test_only_pairs_of_the_stated_similarity_are_removed(spark):
    rng, texts, far = random.Random(12), [], []
    for i in range(120):
        words = [f"w{rng.random()}" for _ in range(rng.randint(100, 400))]
        low = words
        while similarity(" ".join(words), " ".join(low)) >= 0.8:  # the last copy that is below
            low = low + [f"n{rng.random()}"]
        texts += [" ".join(words), " ".join(low if i % 2 else low[:-1])]
        far += [2 * i + 1] if i % 2 else []
    kept = {r["doc_id"] for r in s.near_copies_removed(documents(spark, texts)).collect()}
    assert kept == {*range(0, 240, 2), *far}


def signed_nodes(spark, texts):
    signed = documents(spark, texts).select(F.col("doc_id").alias("node"), s._signature("text").alias("s"))
    return signed.select("node", "s.prints", "s.bands")


def test_batches_connect_what_all_keys_connect(spark):
    nodes = signed_nodes(spark, [*near_texts(5, 60), "", "one two", "one two"])
    at_once = s.fingerprint_links(nodes, s.MOST_BITS).unionByName(s.band_links(nodes))
    wanted = sorted(tuple(r) for r in s.components(at_once).select("node", "root").collect())
    assert wanted and sorted(tuple(r) for r in s.candidate_groups(nodes).select("node", "root").collect()) == wanted
    assert s.candidate_groups(nodes.limit(0)).count() == 0


def test_a_large_group_of_near_copies_gives_few_links(spark, monkeypatch):
    rng, given = random.Random(3), []
    base = [f"w{i}" for i in range(300)]
    texts = []
    for i in range(400):
        words = list(base)
        for at in rng.sample(range(300), 4):
            words[at] = f"n{i}.{at}"
        texts.append(" ".join(words))
    seen = s.components
    monkeypatch.setattr(s, "components", lambda links: given.append(links.count()) or seen(links))
    nodes = signed_nodes(spark, texts)
    groups = s.candidate_groups(nodes).collect()
    assert len(groups) == 400 and {r["root"] for r in groups} == {0}
    # At once every node has links to the smallest node of each of its many keys.
    at_once = s.fingerprint_links(nodes, s.MOST_BITS).unionByName(s.band_links(nodes)).distinct().count()
    assert sum(given) < 8 * 400 < at_once


def test_near_copies_leave_no_shuffle_files(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        names = [f.getName() for f in (files.apply(i) for files in [disk.getAllFiles()] for i in range(files.size()))]
        return {name.split("_")[1] for name in names if name.startswith("shuffle_")}

    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[: 60 - i % 3]) if i < 20 else f"{i} " * 30) for i in range(40)]
    before, conf = shuffles(), spark.conf.get(key, "false")
    kept = s.near_copies_removed(spark.createDataFrame(rows, "doc_id long, text string"))
    left = shuffles() - before
    for _ in range(50):
        if len(left) <= 1:
            break
        time.sleep(0.2)
        left = shuffles() - before
    assert len(left) <= 1  # of the look for repeated ids
    assert spark.conf.get(key, "false") == conf
    assert kept.count() == kept.count() == 21
