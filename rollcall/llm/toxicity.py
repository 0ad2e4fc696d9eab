"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The lexicon is learned too: words and beginnings of words that are much more frequent in toxic
texts of the fitting sample. For a text of that sample the lexicon's counts leave the text itself
out, so that features mean the same on texts seen and unseen. Trees and calibration are Spark ML;
the calibration uses texts that the trees have not seen.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import free_name, landed, small_batches

#: Bound of the sample that lexicon, trees and calibration are fitted on: rows of each label.
FIT_TOXIC, FIT_CLEAN = 4_000, 8_000
#: Entries of the lexicon, which every task receives.
LEXICON = 5_000
#: Toxic texts with an entry, and its log-odds, at least.
SUPPORT, STRONG = 4, 2.0
#: Letters of the beginnings of words.
BEGINNINGS = range(4, 9)
#: Words between a lexicon word and a second person that still count as close.
CLOSE = 5
REJECTED = 0.7
SEED = 7

# Second-person pronouns of the languages covered.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen deiner ihr euch euer tu te toi ton ta tes vous votre vos "
    "tú ti tuyo tuya tus usted ustedes vosotros vuestro".split()
)
_WORD = re.compile(r"[^\W\d_]+")
_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
# Characters that stand for letters.
_STAND_INS = str.maketrans("013457@$!*", "oieastasi ", "")
_DISGUISED = re.compile(r"[^\W\d_]+[0134578@$!*]+[^\W\d_]+")
_STAND_IN = np.zeros(256, dtype=bool)
_STAND_IN[list(b"0134578@$!*")] = True

NAMES = (
    "hit_density", "hits", "different_hits", "best_weight", "best_five", "weight_sum", "second_person", "close_hits",
    "capital_words", "capitals", "exclamations", "questions", "punctuation", "disguised", "disguised_hits", "repeats", "length",
)


def grams(text: str | None) -> set[str]:
    """Different words (with =) and beginnings of words of a text."""
    found = set()
    for word in {w.lower() for w in _WORD.findall(text or "")}:
        found.add("=" + word)
        found.update(word[:n] for n in BEGINNINGS if n <= len(word))
    return found


class Lexicon:
    """Counts of toxic and clean texts of the sample with each entry."""

    def __init__(self, toxic: int, clean: int, counts: dict[str, tuple[int, int]]) -> None:
        self.toxic, self.clean, self.counts = toxic, clean, counts
        self.starts = {g[1:5] if g[0] == "=" else g[:4] for g in counts}

    def weight(self, gram: str, label: int | None) -> float:
        """Log-odds of an entry, without one text of the label."""
        count = self.counts.get(gram)
        if count is None:
            return 0.0
        with_, without = count
        toxic, clean = self.toxic, self.clean
        if label is not None:
            # A disguised word is looked up though the text was not counted for it.
            with_, without = max(0, with_ - label), max(0, without - (1 - label))
            toxic, clean = toxic - label, clean - (1 - label)
        if with_ < SUPPORT - 1:
            return 0.0
        return math.log((with_ + 0.5) / (toxic + 1)) - math.log((without + 0.5) / (clean + 1))

    def word(self, word: str, label: int | None) -> float:
        if word[:4] not in self.starts:
            return 0.0
        best = self.weight("=" + word, label)
        for n in BEGINNINGS:
            if n > len(word):
                break
            best = max(best, self.weight(word[:n], label))
        return best


def features(text: str | None, lexicon: Lexicon, label: int | None = None) -> list[float]:
    """The dense features of a whole text; ``label`` only for texts the lexicon was learned from."""
    text = text or ""
    words = _WORD.findall(text)
    counts = Counter(words)
    lower: Counter = Counter()
    capitals = 0
    for word, n in counts.items():
        lower[word.lower()] += n
        if len(word) > 1 and word.isupper():
            capitals += n
    weights = {w: x for w in lower if (x := lexicon.word(w, label)) >= STRONG}
    hits = sum(lower[w] for w in weights)
    second = sum(lower[w] for w in SECOND_PERSON if w in lower)
    close = 0
    if hits and second:
        low = [w.lower() for w in words]
        at = np.array([i for i, w in enumerate(low) if w in SECOND_PERSON])
        own = np.array([i for i, w in enumerate(low) if w in weights])
        near = np.searchsorted(at, own)
        left = own - at[np.maximum(near - 1, 0)]
        right = at[np.minimum(near, len(at) - 1)] - own
        close = int(((abs(left) <= CLOSE) | (abs(right) <= CLOSE)).sum())
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    letters = _LETTERS[raw]
    disguised = disguised_hits = repeats = 0
    if len(raw) > 2:
        disguised = int((letters[:-2] & _STAND_IN[raw[1:-1]] & letters[2:]).sum())
        repeats = int((letters[2:] & (raw[2:] == raw[1:-1]) & (raw[1:-1] == raw[:-2])).sum())
    if disguised:
        plain = (w.translate(_STAND_INS).lower() for w in _DISGUISED.findall(text))
        disguised_hits = sum(lexicon.word(w, label) >= STRONG for w in plain)
    n, chars = max(1, len(words)), max(1, len(raw))
    best = sorted(weights.values(), reverse=True)[:5]
    signs = {c: int((raw == ord(c)).sum()) for c in "!?.,;:"}
    return [
        (hits + disguised_hits) / n,
        math.log1p(hits + disguised_hits),
        math.log1p(len(weights)),
        best[0] if best else 0.0,
        sum(best) / 5,
        sum(x * lower[w] for w, x in weights.items()) / math.sqrt(n),
        second / n,
        close / n,
        capitals / n,
        int(((raw >= 65) & (raw <= 90)).sum()) / chars,
        signs["!"] / n,
        signs["?"] / n,
        sum(signs.values()) / n,
        disguised / n,
        disguised_hits / n,
        repeats / n,
        math.log1p(len(words)),
    ]


def _with_features(df: DataFrame, lexicon: Lexicon, labelled: bool) -> DataFrame:
    """doc_id, features (and toxic, weight, part) of df's rows."""
    names = ["doc_id", *(["toxic", "weight", "part"] if labelled else [])]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 500) for b in batches for at in range(0, b.num_rows, 500)):
            texts = batch.column("text").to_pylist()
            labels = batch.column("toxic").to_pylist() if labelled else [None] * len(texts)
            rows = [features(t, lexicon, y) for t, y in zip(texts, labels, strict=True)]
            columns = [batch.column(n) for n in names] + [pa.array(rows, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "features"])

    small_batches(df.sparkSession)
    schema = "doc_id long" + (", toxic int, weight double, part long" if labelled else "") + ", features array<double>"
    return df.select(*names, "text").mapInArrow(add, schema)


def _write_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text, label in zip(batch.column("text"), batch.column("toxic").to_pylist(), strict=True):
            own = list(grams(text.as_py()))
            for at in range(0, len(own), 10_000):
                part = own[at : at + 10_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([label] * len(part), pa.int32())], names=["gram", "toxic"])


def training_labels(labels: DataFrame) -> DataFrame:
    """doc_id, toxic (1 if any row says so), weight and part of the bounded sample.

    Only rows whose crc32(doc_id) modulo 3 is not 1; rows without id or label are left out.
    """
    known = (
        labels.filter("doc_id is not null and toxic is not null")
        .filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
        .groupBy("doc_id")
        .agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
        .withColumn("draw", F.xxhash64("doc_id", F.lit(SEED)))
    )
    known = landed(known, "labels")
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = []
    for label, most in ((1, FIT_TOXIC), (0, FIT_CLEAN)):
        one = known.filter(F.col("toxic") == label).orderBy("draw", "doc_id").limit(most)
        parts.append(one.withColumn("weight", F.lit(max(1.0, sizes.get(label, 0) / most))))
    drawn = parts[0].unionByName(parts[1])
    # A quarter of each label calibrates.
    place = F.row_number().over(Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id", F.lit(SEED + 1)), "doc_id"))
    return drawn.select("doc_id", "toxic", "weight", (place % 4).cast("long").alias("part"))


class ToxicityModel:
    """Scores texts; ``trees`` is None if the labels are all alike, then ``prior`` is the score."""

    def __init__(self, lexicon: Lexicon, trees=None, calibration=None, prior: float = 0.0) -> None:
        self.lexicon, self.trees, self.calibration, self.prior = lexicon, trees, calibration, prior

    def _rated(self, rows: DataFrame) -> DataFrame:
        rated = self.trees.transform(rows.withColumn("vector", array_to_vector("features")))
        return rated.withColumn("margin", vector_to_array("rawPrediction")[1])

    def scores(self, documents: DataFrame) -> DataFrame:
        """doc_id and score (0 to 1) of every row; null and empty texts are scored like any other."""
        if self.trees is None:
            return documents.select(F.col("doc_id").cast("long"), F.lit(self.prior).alias("score"))
        narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        rated = self.calibration.transform(self._rated(_with_features(narrow, self.lexicon, False)))
        return rated.select("doc_id", F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("score"))


def fit(documents: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Learns from the labelled documents; the sample is bounded, see ``FIT_TOXIC``."""
    drawn = landed(training_labels(labels), "sample")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null")
    rows = landed(texts.join(F.broadcast(drawn), "doc_id"), "sample")  # at most FIT_TOXIC + FIT_CLEAN ids
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return ToxicityModel(Lexicon(toxic, clean, {}), prior=float(bool(toxic)))
    counted = rows.mapInArrow(_write_grams, "gram string, toxic int").groupBy("gram").agg(
        F.sum("toxic").alias("with_"), F.sum(1 - F.col("toxic")).alias("without")
    )
    odds = F.log((F.col("with_") + 0.5) / (toxic + 1)) - F.log((F.col("without") + 0.5) / (clean + 1))
    strong = counted.withColumn("odds", odds).filter((F.col("with_") >= SUPPORT) & (F.col("odds") >= STRONG))
    best = strong.orderBy(F.desc(F.col("with_") * F.col("odds")), "gram").limit(LEXICON).collect()
    lexicon = Lexicon(toxic, clean, {r["gram"]: (r["with_"], r["without"]) for r in best})
    sample = landed(_with_features(rows, lexicon, True), "features")
    held = sample.filter("part = 0")
    if held.agg(F.countDistinct("toxic").alias("n")).first()["n"] < 2:
        held = sample
    train = sample.filter("part <> 0") if held is not sample else sample
    train = train.withColumn("vector", array_to_vector("features")).coalesce(4)
    trees = GBTClassifier(featuresCol="vector", labelCol="toxic", maxIter=25, maxDepth=3, stepSize=0.2, seed=SEED).fit(train)
    model = ToxicityModel(lexicon, trees)
    isotonic = IsotonicRegression(featuresCol="margin", labelCol="toxic", weightCol="weight", predictionCol="score")
    model.calibration = isotonic.fit(model._rated(held).select("margin", F.col("toxic").cast("double"), "weight"))
    return model


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    Nothing but the text enters a score. Repeated rows and null ids stay rows; a null id is not
    held out. Without labels of both kinds every score is 1.0 if all are toxic, else 0.0.
    """
    scored = fit(documents, labels).scores(documents)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= REJECTED).cast("int").alias("predicted"))


def without_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose texts score below ``REJECTED``, with all their columns as they came.

    The decision belongs to the text, so rows of equal texts share it.
    """
    spot = free_name(documents, "text_key")
    model = fit(documents, labels)
    keyed = documents.select(F.xxhash64("text").alias("doc_id"), "text")
    rejected = landed(model.scores(keyed).filter(F.col("score") >= REJECTED).select(F.col("doc_id").alias(spot)).distinct(), "rejected")
    return documents.withColumn(spot, F.xxhash64("text")).join(rejected, spot, "left_anti").select(*documents.columns)
