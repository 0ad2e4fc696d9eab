import math
import re
from collections import Counter

import pytest

from rollcall.llm import licenses as n
from rollcall.llm.queries import op7_licenses
from tests.llm.helpers import SMALL, clashing

FILES = "row long, path string, text string"
APACHE = "Licensed under the Apache License, Version 2.0."
MIT = "Released under the MIT License."


def terms(text):
    return [t for t in re.split(r"[^a-z0-9]+", text.lower()) if t]


def best_by_hand(files):
    """(score, licence) of each file, by all units and without anchors."""
    total = len(files)
    df = Counter(t for _, _, text in files for t in set(terms(text or "")))
    weights = {t: math.log((1 + total) / (1 + df[t])) + 1 for t in n.VOCABULARY}
    other = sum(weights.values()) / len(weights)

    def vector(text):
        own = {t: c * weights.get(t, other) for t, c in Counter(terms(text)).items()}
        norm = math.sqrt(sum(w * w for w in own.values())) or 1
        return {t: w / norm for t, w in own.items()}

    templates = {k: vector(v) for k, v in n.TEMPLATES.items()}
    marks = n.anchors(n.template_vectors(weights))
    out = {}
    for row, path, text in files:
        lines = (text or "").split("\n")
        some = [x for x in lines if set(terms(x)) & marks]
        units = lines + [" ".join(some)] + ([text or ""] if path and re.search(n.LICENCE_FILE, path) else [])
        scored = [(0, None)]
        for unit in units:
            v = vector(unit)
            for name, t in templates.items():
                score = round(sum(w * t.get(k, 0) for k, w in v.items()), 6)
                if score >= n.LEAST:
                    scored.append((score, name.removesuffix(" short")))
        out[row] = max(scored, key=lambda s: (s[0], s[1] or ""))
    return out


TEXTS = [
    (1, "a/LICENSE", n.TEMPLATES["MIT"]), (2, "a/b/c/main.py", "no licence here"), (3, "a/b/COPYING.txt", "intro\n" + n.TEMPLATES["GPL-3.0"]),
    (4, "a/b/x.py", f"# {APACHE}\ncode\n"), (5, "z/deep/er/file", "text"), (6, None, "text"), (7, "a/b/c/null", None), (8, "LICENSE.md", ""),
    (9, "q/notice", MIT + "\n" + "word " * 400), (10, "q/r", "License of nothing in particular, really not"), (11, "top", "plain"),
    (12, "a/e/part", n.TEMPLATES["BSD-2-Clause"].replace("permitted", "\npermitted")), (13, "q/r2", "the MIT thing"), (14, "a/LICENSE", MIT),
    (15, "a/b/c/d.py", "released under the mit license"), (16, "/abs/dir/f", "x"), (17, "/abs/LICENCE", APACHE),
]


def test_scores_equal_the_definition(spark):
    rows = n.own_licences(spark.createDataFrame(TEXTS, FILES)).collect()
    wanted = best_by_hand(TEXTS)
    assert len(rows) == len(TEXTS)
    for r in rows:
        score, licence = wanted[r["row"]]
        assert r["licence"] == licence, (r, wanted[r["row"]])
        if licence:
            assert r["score"] == pytest.approx(score, abs=2e-6)


def test_anchors_are_proven():
    weights = {t: 1.0 + i % 7 for i, t in enumerate(n.VOCABULARY)}
    vectors = n.template_vectors(weights)
    marks = n.anchors(vectors)
    for vector in vectors.values():
        assert math.sqrt(sum(w * w for t, w in vector.items() if t not in marks)) < n.LEAST


def test_nearest_directory_above(spark):
    found = {r["row"]: r for r in n.file_licences(spark.createDataFrame(TEXTS, FILES)).collect()}
    assert len(found) == len(TEXTS)
    assert (found[1]["licence"], found[1]["how"]) == ("MIT", "own")
    assert (found[2]["licence"], found[2]["how"], found[2]["from_directory"]) == ("GPL-3.0", "inherited", "a/b")
    assert (found[4]["licence"], found[4]["how"]) == ("Apache-2.0", "own")
    assert found[7]["from_directory"] == "a/b" and found[15]["licence"] == "MIT"
    assert (found[13]["licence"], found[13]["from_directory"]) == ("MIT", "q")
    assert [found[i]["how"] for i in (5, 6, 8, 11)] == [None] * 4
    assert (found[16]["licence"], found[16]["from_directory"]) == ("Apache-2.0", "/abs")
    assert found[12]["licence"].startswith("BSD")


def test_odd_rows(spark):
    files = clashing(spark.createDataFrame(TEXTS, FILES), "unit", "licence", "directory", "how")
    assert n.file_licences(files).count() == len(TEXTS)
    assert n.file_licences(files.limit(0)).count() == 0


def test_files_that_share_a_row_keep_their_own_licence(spark):
    files = [(1, "a/x", MIT), (1, "b/x", APACHE), (1, "c/x", "plain"), (None, "d/x", MIT), (None, "e/x", "plain"), (None, None, MIT), (1, "a/x", MIT)]
    rows = n.file_licences(spark.createDataFrame(files, FILES)).collect()
    found = sorted((str(r["row"]), str(r["path"]), str(r["licence"])) for r in rows)
    assert found == sorted([
        ("1", "a/x", "MIT"), ("1", "a/x", "MIT"), ("1", "b/x", "Apache-2.0"), ("1", "c/x", "None"),
        ("None", "d/x", "MIT"), ("None", "e/x", "None"), ("None", "None", "MIT"),
    ])


def test_licences_are_inherited_in_the_query(spark):
    rows = op7_licenses(spark, SMALL).collect()
    owners = {}
    for r in rows:
        if r["how"] == "own" and re.search(n.LICENCE_FILE, r["path"]):
            owners.setdefault(r["path"].rpartition("/")[0], set()).add(r["licence"])
    inherited = [r for r in rows if r["how"] == "inherited"]
    assert inherited and all(r["licence"] in owners[r["from_directory"]] for r in inherited)
    for r in rows:
        steps = r["path"].split("/")[:-1]
        above = ["/".join(steps[:i]) for i in range(len(steps), 0, -1)]
        near = next((a for a in above if a in owners), None)
        if r["how"] != "own":
            assert (r["how"], r["from_directory"]) == (("inherited", near) if near else (None, None))


def test_no_python_in_the_plans(spark):
    files = spark.createDataFrame(TEXTS, FILES)
    plan = n._cosines(files.select("text").withColumnRenamed("text", "unit").limit(0), {t: 1.0 for t in n.VOCABULARY}, n.template_vectors({t: 1.0 for t in n.VOCABULARY}))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "PythonUDF" not in text and "CartesianProduct" not in text
