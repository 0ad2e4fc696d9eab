import random

import numpy as np
from pyspark.sql import functions as F

from rollcall.llm import toxicity as t
from tests.llm.helpers import clashing, documents, odd_documents


def corpus(spark, n=900, seed=2):
    """Toxic texts hold words that begin like a few invented ones."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        toxic = int(rng.random() < 0.15)
        words = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmnrst')}{rng.randint(0, 80)}" for _ in range(rng.randint(20, 120))]
        words = [w.translate(str.maketrans("0123456789", "abcdefghij")) for w in words]
        for _ in range(rng.randint(2, 6) * toxic):
            words[rng.randrange(len(words))] = rng.choice(["zorkif", "vuxala", "zorkel", "vuxam"]) + rng.choice("abc")
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = corpus(spark)
    rows = t.toxicity(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert 200 < len(held) < 400 and len(rows) == 900
    toxic, clean = ([r for r in held if r["toxic"] == y] for y in (1, 0))
    assert np.mean([r["predicted"] for r in toxic]) > 0.9
    assert np.mean([r["predicted"] for r in clean]) < 0.02
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    kept = {r["doc_id"] for r in t.without_toxic(docs, labels).collect()}
    assert kept == {r["doc_id"] for r in rows if not r["predicted"]}


def test_held_out_rows_teach_nothing(spark):
    docs, labels = corpus(spark, 300)
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    first, second = ({r["doc_id"]: r["score"] for r in t.toxicity(docs, x).collect()} for x in (labels, turned))
    assert first == second


def test_lexicon_leaves_a_text_of_the_sample_out():
    lexicon = t.Lexicon(10, 20, {"=bad": (5, 2), "badl": (4, 1), "=idiot": (5, 0)})
    assert lexicon.word("bad", None) == lexicon.weight("=bad", None) > 0
    assert lexicon.weight("=bad", 1) < lexicon.weight("=bad", None) < lexicon.weight("=bad", 0)
    assert lexicon.weight("badl", 1) > 0 and lexicon.weight("other", None) == 0
    assert lexicon.weight("=idiot", 0) > 0 and t.features("an 1d1ot", lexicon, 0)[t.NAMES.index("disguised")] > 0
    assert lexicon.word("badly", None) == lexicon.weight("badl", None)


def test_features():
    lexicon = t.Lexicon(10, 20, {"=idiot": (9, 0)})
    one = dict(zip(t.NAMES, t.features("You IDIOT! an 1d10t, idi0t? sooo", lexicon)))
    assert one["hit_density"] > 0 and one["close_hits"] > 0 and one["second_person"] > 0
    assert one["disguised"] > 0 and one["disguised_hits"] > 0 and one["repeats"] > 0 and one["capitals"] > 0
    assert t.features(None, lexicon) == t.features("", lexicon)
    assert len(t.features("\U0001f600 é" * 3, lexicon)) == len(t.NAMES)
    assert all(np.isfinite(t.features("x" * 100_000, lexicon)))


def test_labels_of_one_kind_or_none(spark):
    docs, labels = corpus(spark, 60)
    for chosen, score in ((labels.filter("toxic = 0"), 0.0), (labels.filter("toxic = 1"), 1.0), (labels.limit(0), 0.0)):
        assert {r["score"] for r in t.toxicity(docs, chosen).collect()} == {score}


def test_odd_rows(spark):
    docs, labels = corpus(spark, 200)
    labels = labels.unionByName(labels.limit(5)).unionByName(spark.createDataFrame([(None, None, 1), (7, None, None)], labels.schema))
    odd = clashing(docs.unionByName(odd_documents(spark)), "features", "vector", "score", "toxic", "weight", "part", "row")
    rows = t.toxicity(odd, clashing(labels, "draw", "n", "text")).collect()
    assert len(rows) == 208 and all(r["score"] is not None for r in rows)
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [False, False]
    kept = t.without_toxic(odd, labels)
    assert kept.columns == odd.columns and kept.filter("text is null").count() == 2
    assert t.toxicity(odd.limit(0), labels).count() == 0
