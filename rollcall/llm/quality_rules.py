"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per text and sets its bit if the text fails it; the measurements
behind the rules are kept. Policies are versioned sets of rules, applied to the bits alone, so that
a new policy or the effect of leaving a rule out needs no second look at the texts.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import BLANKS, bound

_BLANK = f"[{BLANKS}]"
_WORD = f"[^{BLANKS}]"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A name and the condition, over the measurements, under which a text fails."""

    name: str
    fails: str


#: A rule's bit is its place here; new rules go to the end, so that stored ledgers stay readable.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("duplicate_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("no_letters", "5 * n_letter_words < 2 * n_words"),
    Rule("one_word_dominates", "10 * n_different_words < n_words and n_words >= 50 and n_different_words < 20"),
)
BASE_RULES = ("few_words", "repeated_windows")


@dataclass(frozen=True)
class Policy:
    """Rules that reject a text on their own, and how many of the others it may fail."""

    version: str
    required: tuple[str, ...]
    counted: tuple[str, ...] = ()
    allowed: int = 0
    bits: dict[str, int] = field(default_factory=lambda: {r.name: i for i, r in enumerate(RULES)}, compare=False)

    def mask(self, names: tuple[str, ...]) -> int:
        return sum(1 << self.bits[n] for n in names)

    def keeps(self, failed: Column, without: str | None = None) -> Column:
        """Whether failure bits pass, perhaps with one rule left out."""
        out = () if without is None else (without,)
        required = self.mask(tuple(n for n in self.required if n not in out))
        counted = self.mask(tuple(n for n in self.counted if n not in out))
        return (failed.bitwiseAND(F.lit(required)) == 0) & (
            F.bit_count(failed.bitwiseAND(F.lit(counted))) <= self.allowed
        )


POLICIES = (
    Policy("v1", BASE_RULES),
    Policy("v2", (*BASE_RULES, "no_letters", "one_word_dominates"), ("short_words", "long_words", "symbols", "duplicate_lines"), 1),
    # Texts full of symbols are tables and noise: on labelled rows only poor ones fail that rule.
    Policy("v3", (*BASE_RULES, "symbols", "no_letters", "one_word_dominates"), ("short_words", "long_words", "duplicate_lines"), 1),
)
CURRENT = POLICIES[-1]


def _repeated_words(words: Column) -> Column:
    """Words that lie in a three-word window found twice or more."""
    last = F.size(words) - 3
    grams = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.concat_ws(" ", words[i], words[i + 1], words[i + 2])
    )

    def covered(own: Column) -> Column:
        placed = F.array_sort(F.transform(own, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
        return bound(
            bound(
                placed,
                lambda p: F.array_sort(
                    F.transform(
                        F.filter(
                            p,
                            lambda x, i: F.coalesce(x["g"] == F.get(p, i - 1)["g"], F.lit(False))
                            | F.coalesce(x["g"] == F.get(p, i + 1)["g"], F.lit(False)),
                        ),
                        lambda x: x["i"],
                    )
                ),
            ),
            lambda starts: F.aggregate(
                F.transform(starts, lambda s, i: F.least(F.lit(3), F.coalesce(F.get(starts, i + 1) - s, F.lit(3)))),
                F.lit(0).cast("long"),
                lambda a, b: a + b,
            ),
        )

    # Few texts repeat a window; only those are sorted.
    repeats = bound(grams, lambda g: F.when(F.size(F.array_distinct(g)) < F.size(g), covered(g)))
    return F.when(last >= 0, F.coalesce(repeats, F.lit(0)))


def measurements(text: Column) -> dict[str, Column]:
    """Column expressions by name; a null text counts as empty."""
    text = F.coalesce(text, F.lit(""))
    trimmed = F.regexp_replace(text, rf"^{_BLANK}+|{_BLANK}+\z", "")
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{_BLANK}+"))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(_WORD))
    size = lambda c: F.size(c).cast("long")
    of_words = bound(
        words,
        lambda w: F.struct(
            size(w).alias("n_words"),
            F.coalesce(_repeated_words(w), F.lit(0)).cast("long").alias("n_repeat_words"),
            size(F.array_distinct(w)).alias("n_different_words"),
            size(F.filter(w, lambda x: x.rlike(r"\p{L}"))).alias("n_letter_words"),
        ),
    )
    of_lines = bound(
        lines, lambda x: F.struct(size(x).alias("n_lines"), (size(x) - size(F.array_distinct(x))).alias("n_dup_lines"))
    )
    return {
        "of_words": of_words,
        "of_lines": of_lines,
        "word_chars": F.length(F.regexp_replace(text, f"{_BLANK}+", "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
    }


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_different_words", "n_letter_words")


def ledger(documents: DataFrame) -> DataFrame:
    """doc_id, the measurements and failed, a long with the bits of the rules a text fails.

    Null, empty and blank texts have zero for everything. Repeated rows and null ids stay rows;
    other columns are left out.
    """
    measured = documents.select("doc_id", *(c.alias(n) for n, c in measurements(F.col("text")).items()))
    flat = measured.select("doc_id", "of_words.*", "of_lines.*", "word_chars", "n_symbols")
    failed = F.lit(0).cast("long")
    for place, rule in enumerate(RULES):
        failed = failed + F.when(F.expr(rule.fails), F.lit(1 << place)).otherwise(0)
    return flat.select("doc_id", *MEASURES, failed.cast("long").alias("failed"))


def verdicts(entries: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """A ledger with base_failed, kept and the policy's version."""
    base = F.lit(policy.mask(BASE_RULES)).cast("long")
    return entries.withColumns(
        {
            "base_failed": F.col("failed").bitwiseAND(base) != 0,
            "kept": policy.keeps(F.col("failed")) & (F.col("failed").bitwiseAND(base) == 0),
            "policy": F.lit(policy.version),
        }
    )


def ablations(entries: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """For each policy and rule: texts kept, kept without that rule, and failing that rule only.

    The ledger is folded to its different bit patterns first, of which there are few.
    """
    patterns = entries.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    rows = []
    for policy in policies:
        for name in policy.required + policy.counted:
            bit = 1 << policy.bits[name]
            rows.append(
                F.struct(
                    F.lit(policy.version).alias("policy"),
                    F.lit(name).alias("rule"),
                    policy.keeps(F.col("failed")).cast("int").alias("kept"),
                    policy.keeps(F.col("failed"), name).cast("int").alias("kept_without"),
                    (F.col("failed") == bit).cast("int").alias("alone"),
                )
            )
    each = patterns.select("n", F.explode(F.array(*rows)).alias("r")).select("n", "r.*")
    sums = [F.sum(F.col("n") * F.col(c)).alias(c) for c in ("kept", "kept_without", "alone")]
    return each.groupBy("policy", "rule").agg(*sums)
