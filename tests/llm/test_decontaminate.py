import random
import re

import pytest

from rollcall.llm import decontaminate as d
from tests.llm.helpers import clashing, documents, odd_documents


def shingles(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def items_of(spark, texts):
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "item_id long, text string")


def cases(seed=4):
    rng = random.Random(seed)

    def passage(n):
        return [f"w{rng.randint(0, 5000)}" for _ in range(n)]

    items = [passage(n) for n in (5, 6, 9, 12, 14, 20, 33, 40, 59, 64, 65)]
    texts = []
    for item in items:
        for edits in (0, 1, 1, 2, 3):
            copy = item.copy()
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = "edited"
            before, after = passage(rng.choice([0, 50, 4000])), passage(rng.choice([0, 30]))
            texts.append(" ".join(before + copy + after))
    texts += [" ".join(items[5]).upper() + "!", ", ".join(items[6]), " ".join(items[3] * 3), " ".join(items[7][:20])]
    return texts, [" ".join(i) for i in items]


@pytest.mark.parametrize("broadcast", [2_000_000, -1])
def test_equals_all_comparisons(spark, monkeypatch, broadcast):
    monkeypatch.setattr(d, "BROADCAST_ROWS", broadcast)
    texts, items = cases()
    items += ["four words only here", "", None, items[2]]
    docs = documents(spark, [*texts, None, "", *texts[:1]])
    wanted = []
    for row in docs.collect():
        own = shingles(row["text"])
        for number, item in enumerate(items):
            other = shingles(item)
            if other and 100 * len(own & other) >= 80 * len(other):
                wanted.append((row["doc_id"], number, len(other), len(own & other), len(own & other) / len(other)))
    found = [tuple(r) for r in d.contaminated(docs, items_of(spark, items)).collect()]
    assert sorted(found) == sorted(wanted) and len(wanted) > 30
    bad = {w[0] for w in wanted}
    kept = {r["doc_id"] for r in d.decontaminated(docs, items_of(spark, items)).collect()}
    assert kept == {r["doc_id"] for r in docs.collect()} - bad


def test_sketches_are_long_enough(spark):
    _, items = cases()
    for row in d.item_sketches(items_of(spark, items)).collect():
        n = len(row["shingles"])
        lacking = n - row["needed"]
        assert row["needed"] * 100 >= 80 * n > (row["needed"] - 1) * 100
        assert len(row["sketch"]) >= min(n, lacking + 1) and row["sketch"] == sorted(row["sketch"])


def test_odd_rows(spark):
    odd = clashing(odd_documents(spark, ["one two three four five six"]), "_key", "_items", "_contained", "text_key", "item_id", "shingles")
    items = clashing(items_of(spark, [(None, "two three four five six"), (None, None), (3, "two three four five six")]), "key", "item", "hash", "needed")
    found = {tuple(r)[:2] for r in d.contaminated(odd, items).collect()}
    assert found == {(100, None), (100, 3)}
    assert d.decontaminated(odd, items).count() == odd.count() - 1
    assert d.decontaminated(odd, items).columns == odd.columns
    assert d.contaminated(odd.limit(0), items).count() == d.contaminated(odd, items.limit(0)).count() == 0
    assert d.decontaminated(odd, items.limit(0)).count() == odd.count()


def test_no_python_in_the_plan(spark):
    texts, items = cases()
    plan = d.contaminated(documents(spark, texts[:1]).limit(0), items_of(spark, items[:1]).limit(0))._jdf.queryExecution().optimizedPlan().toString()
    assert "PythonUDF" not in plan and "Cartesian" not in plan
