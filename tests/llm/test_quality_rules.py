import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from rollcall.llm import quality_rules as q
from tests.llm.helpers import clashing, documents, odd_documents


def measured(text):
    """The measurements by their definition."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_lines": len(lines),
        "n_different_words": len(set(words)),
        "n_letter_words": sum(any(c.isalpha() for c in w) for w in words),
    }


def failing(m):
    rules = [
        m["n_words"] < 50, 100 * m["n_repeat_words"] > 50 * m["n_words"], m["word_chars"] < 2 * m["n_words"],
        m["word_chars"] > 20 * m["n_words"], 10 * m["n_symbols"] > m["n_words"], 10 * m["n_dup_lines"] > 3 * m["n_lines"],
        5 * m["n_letter_words"] < 2 * m["n_words"],
        10 * m["n_different_words"] < m["n_words"] and m["n_words"] >= 50 and m["n_different_words"] < 20,
    ]
    return sum(1 << i for i, failed in enumerate(rules) if failed)


def compare(spark, texts):
    for row in q.verdicts(q.ledger(documents(spark, texts))).collect():
        m = measured(texts[row["doc_id"]])
        assert {n: row[n] for n in q.MEASURES} == m, texts[row["doc_id"]]
        assert row["failed"] == failing(m)
        assert row["base_failed"] == bool(row["failed"] & 3)
        assert row["kept"] == (not row["failed"] & 0b11010011 and bin(row["failed"] & 0b101100).count("1") <= 1)


def test_measurements_of_edge_cases(spark):
    compare(spark, [
        None, "", " ", "a", "a b", "a b c", "a b c a b c", "x x x x", "a b c d", "é\U0001f600 ü\x0b#*\x0c|<>",
        "l\nl\nl\n\n \nm", "a b c d\n" * 40, "the same line of words\nother\nthe same line of words\n", "\n\n", "1 2 3 " * 30,
        " ".join(f"w{i}" for i in range(5000)) + " w1 w2 w3 w4", "\r\na\r\na", "ab " * 400,
        "abc \u2028", "abc \u0085", "abc \u2029", "abc \u0085 \n", "\u2028 abc",
    ])


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet="ab \n#é\t\u0085\u2028", max_size=60), min_size=8, max_size=20))
def test_measurements_of_random_texts(spark, texts):
    compare(spark, texts)


def test_odd_rows_and_clashing_columns(spark):
    odd = clashing(odd_documents(spark), "n_words", "failed", "of_words", "kept")
    rows = q.verdicts(q.ledger(odd)).collect()
    assert len(rows) == 8 and sum(r["doc_id"] is None for r in rows) == 2
    assert q.ledger(odd.limit(0)).count() == 0


def test_ablations_by_patterns(spark):
    texts = ["a b c " * 40, "few", "# " * 60, "word " * 100, " ".join(f"w{i}" for i in range(90)), "1 " * 70]
    entries = q.ledger(documents(spark, texts))
    bits = [r["failed"] for r in entries.collect()]
    table = {(r["policy"], r["rule"]): r for r in q.ablations(entries).collect()}
    assert len(table) == sum(len(p.required) + len(p.counted) for p in q.POLICIES)
    for policy in q.POLICIES:
        def kept(failed, without=None, policy=policy):
            required = {n for n in policy.required if n != without}
            counted = {n for n in policy.counted if n != without}
            failed = {r.name for i, r in enumerate(q.RULES) if failed >> i & 1}
            return not failed & required and len(failed & counted) <= policy.allowed

        for name in policy.required + policy.counted:
            row = table[policy.version, name]
            assert row["kept"] == sum(map(kept, bits))
            assert row["kept_without"] == sum(kept(b, name) for b in bits)
            assert row["alone"] == sum(b == 1 << policy.bits[name] for b in bits)


def test_no_python_in_the_plan(spark):
    plan = q.ledger(documents(spark, ["a"]).limit(1))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
