"""Line deduplication against a plain version."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.llm import line_dedup as ld
from tests.llm.helpers import DOCUMENTS, SMALL, clashing, documents, odd_documents

LONG = "this line is long enough to count"


def plain(rows, least=20, copies=3):
    """Rows (doc_id, text) to sorted (doc_id, n_lines, n_dropped, text)."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(" \t\n\r\x0b\x0c").translate(low)
    holders = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                holders.setdefault(key(line), set()).add(doc_id)
    keep = {k: max((i for i in ids if i is not None), default=None) for k, ids in holders.items() if len(ids) >= copies}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if key(x) not in keep or keep[key(x)] == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


def found(df, **options):
    rows = ld.deduplicated_lines(df, **options).collect()
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in rows), key=repr)


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


CASES = [
    LONG + "\nown line one of the first", LONG.upper() + "  \nother", "\t" + LONG + "\r\nx", f"{LONG}\n{LONG}\nlast",
    "twenty points exactl", "twenty points exactl", "twenty points exactl", "nineteen points exa", "nineteen points exa",
    "nineteen points exa", "é" * 20, "É" * 20, "é" * 20, "é" * 20 + "\x85", "  " + "é" * 20, "only two documents share this", 
    "only two documents share this", "\n\n\n", "a\x0bb" * 10, "\x0b" + "a\x0bb" * 10, "A\x0bb" * 10 + "\x0c", "中" * 19, " " + "中" * 20,
]


def test_rules_of_lines(spark):
    df = odd_documents(spark, CASES)
    assert found(df) == plain(rows_of(df))
    rows = {i: (n, text) for i, n, _, text in found(df) if i}
    assert rows[103][1] == f"{LONG}\n{LONG}\nlast" and rows[100][1] == "own line one of the first" and rows[1] == (1, "")


def test_repeated_and_null_ids_are_one_document(spark):
    df = documents(spark, [(7, LONG), (7, LONG), (7, LONG), (8, LONG)])
    assert found(df) == plain(rows_of(df)) and all(n == 0 for _, _, n, _ in found(df))
    df = documents(spark, [(None, LONG), (None, LONG + "\nx"), (7, LONG), (7, "a\n" + LONG), (8, "b")] + [(None, LONG + str(i)) for i in range(3)])
    assert found(df) == plain(rows_of(df))
    df = documents(spark, [(None, LONG), (9, LONG), (7, LONG), (7, LONG + "\nother text of seven")])
    assert found(df) == plain(rows_of(df))


@pytest.mark.parametrize("seed", [1, 2])
def test_random_texts_and_full_filters(spark, seed, monkeypatch):
    random.seed(seed)
    lines = [f"line {i:03d} " + "x" * random.choice((3, 12, 30)) for i in range(150)]
    change = lambda x: random.choice((x, x.upper(), f" {x}\t"))
    texts = ["\n".join(change(random.choice(lines)) for _ in range(random.randint(0, 12))) for _ in range(120)]
    df = documents(spark, texts).repartition(7)
    expected = plain(rows_of(df))
    assert found(df) == expected
    monkeypatch.setattr(ld, "LEAST_BITS", 64)
    assert found(df, most_bits=64) == expected
    assert found(df, least=5, copies=2) == plain(rows_of(df), 5, 2)


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], DOCUMENTS)
    assert found(empty) == []
    df = clashing(documents(spark, [LONG] * 4), "spot", "keys", "key", "keep", "losing", "n_lines", "digests")
    assert found(df) == plain(rows_of(df))


def test_all_documents_of_the_folder(spark):
    df = spark.read.parquet(SMALL + "/documents.parquet")
    assert found(df) == plain(rows_of(df))
    digests = {(r.doc_id, r.kept_sha256) for r in ld.line_digests(df).collect()}
    assert digests == {(i, hashlib.sha256(t.encode()).hexdigest()) for i, _, _, t in plain(rows_of(df))}


def test_a_line_of_a_third_of_all_documents_and_a_long_text(spark):
    texts = [f"{LONG}\nown text number {i} of the documents" if i % 3 == 0 else f"another text number {i}" for i in range(3000)]
    texts.append("\n".join(f"a rather long line {i % 50_000}" for i in range(200_000)))
    df = documents(spark, texts)
    assert found(df) == plain(rows_of(df))


def test_filters_never_miss():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    pair, other = ld.BloomPair(1 << 16), ld.BloomPair(1 << 16)
    pair.add(values[:3000])
    other.add(values[2000:])
    merged = list(ld._merge(iter([*pair.segments(), *other.segments()])))
    filters = {name: np.frombuffer(merged[0].column(name)[0].as_py(), np.uint8) for name in ("once", "twice")}
    assert ld.holds(filters["once"], values).all() and ld.holds(filters["twice"], values[2000:3000]).all()
    once_only = np.r_[values[:2000], values[3000:]]
    assert ld.holds(filters["twice"], once_only).mean() < 0.2
    pair.add(np.array([5, 5], np.uint64))
    assert ld.holds(pair.twice, np.array([5], np.uint64)).all()
    assert ld.filter_bits(0) == ld.LEAST_BITS and ld.filter_bits(10**12) == ld.MOST_BITS and ld.filter_bits(1 << 20) == 1 << 24


def test_hashes_are_entered_and_looked_up_a_part_at_a_time(monkeypatch):
    monkeypatch.setattr(ld, "HASHES", 7)
    sizes = []
    places = ld._places
    monkeypatch.setattr(ld, "_places", lambda bits, hashes: (sizes.append(len(hashes)), places(bits, hashes))[1])
    values = np.random.default_rng(4).integers(0, 1 << 63, 100, dtype=np.uint64)
    pair = ld.BloomPair(1 << 16)
    pair.add(np.r_[values, values[:30]])
    assert ld.holds(pair.once, values).all() and ld.holds(pair.twice, values[:30]).all()
    assert not ld.holds(pair.twice, values[30:]).all()
    assert ld.holds(pair.once, values[:0]).tolist() == [] and max(sizes) <= 7


def test_jobs_do_not_grow_with_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    keys = spark.range(3000).select(F.xxhash64("id").alias("spot")).repartition(16)
    context = spark.sparkContext
    context.setJobGroup("filter", "filter")
    filter_ = ld.bloom_filter(keys, ld._spot_hashes, 1 << 20, "once")
    jobs = context.statusTracker().getJobIdsForGroup("filter")
    context.setLocalProperty("spark.jobGroup.id", None)
    assert ld.holds(filter_, np.array([r.spot for r in keys.collect()]).view(np.uint64)).all()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(jobs) <= 3  # one for each shuffle partition before


def test_texts_go_to_python_in_small_batches(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    ld.deduplicated_lines(documents(spark, [LONG] * 3))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 2_000
