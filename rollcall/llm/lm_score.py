"""Documents scored by masked pseudo-likelihood.

A network looks at the words on both sides of a position and predicts the word there; the sum of
the log-probabilities of all of a document's words, each predicted from its neighbours, is its
score. Words are counted over the whole corpus. Those frequent enough are the vocabulary; all others
are one of the classes. A word's probability is that of its class, by the network, times its share
of the class, by the counts. The counts of the words outside the vocabulary stay a table, which
grows with the corpus and is joined to the words of each text, but for the most frequent of them: a
bounded number goes to the tasks with the vocabulary.

The network is trained in numpy where the texts lie, on every position of every document in
every round. After a round the weights of all tasks are averaged by Spark, in
proportion to what each has seen; only averages reach the driver. All sizes but the counts are fixed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import landed, texts

#: A word of the vocabulary is at least one in so many words of the corpus, so there are no more.
VOCABULARY = 65_536
#: Most words whose counts are sent to the tasks that score; the others are joined.
SENT = 262_144
#: Words with a class of their own.
FREQUENT = 64
CLASSES = 128
#: Words seen on each side.
WINDOW = 3
EMBEDDING, HIDDEN = 16, 32
ROUNDS = 2
BATCH, RATE = 512, 0.01
#: Positions scored at once.
BLOCK = 1024
#: Texts whose positions are taken at once.
SLICE = 200
#: Bytes of text whose words are found at once.
PORTION = 1 << 24
#: Words counted at once, at least, if a task has them.
COUNTED = 4_000_000
SEED = 11
SHAPES = {
    "embed": (CLASSES + 1, EMBEDDING),
    "mix": (2 * WINDOW, EMBEDDING, HIDDEN),
    "bias": (HIDDEN,),
    "out": (HIDDEN, CLASSES),
    "prior": (CLASSES,),
}
UNKNOWN = CLASSES - 1
#: Classes and CLASSES itself fit.
CODE = np.uint8


def words_of(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def split(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts as ``words_of`` finds them, without a Python string for each, and how many a text has."""
    lists = pc.utf8_split_whitespace(pa.array([t.lower() if t else "" for t in column.to_pylist()], pa.string()))
    words = lists.flatten()
    filled = pc.binary_length(words).to_numpy() > 0  # beside blanks at a text's ends stands an empty word
    before = np.r_[0, np.cumsum(filled)]
    return words.filter(pa.array(filled)), np.diff(before[np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy())]])


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, whose last column is text, in runs of whole slices: of about PORTION bytes, or one slice each."""
    for batch in batches:
        starts = np.arange(0, batch.num_rows, SLICE)
        if len(starts):
            sizes = np.add.reduceat(pc.fill_null(pc.binary_length(batch.columns[-1]), 0).to_numpy().astype(np.int64), starts)
            _, first = np.unique(np.cumsum(sizes) // PORTION, return_index=True)
            for start, end in zip(starts[first], [*starts[first[1:]], batch.num_rows], strict=True):
                yield batch.slice(start, end - start)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def counted() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(pa.chunked_array(held, pa.string()).value_counts().flatten(), names=["word", "n"])

    held = []
    for batch in _portions(batches):
        held.append(split(batch.column(0))[0])
        if sum(map(len, held)) >= COUNTED:
            yield counted()
            held = []
    yield counted()


def word_counts(documents: DataFrame) -> DataFrame:
    """(word, n) over all texts, in lower case, split as ``words_of`` does."""
    found = texts(documents).select("text").mapInArrow(_count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Class and log share of each word; all others are one class, number 0, with the share of an average one."""

    def __init__(self, words: list[tuple[str, int]], kinds: int, total: int) -> None:
        classes = np.array(
            [i if i < FREQUENT else FREQUENT + zlib.crc32(w[-2:].encode()) % (UNKNOWN - FREQUENT) for i, (w, _) in enumerate(words)],
            dtype=np.int64,
        )
        counts = np.array([n for _, n in words], dtype=np.float64)
        sums = np.bincount(classes, counts, CLASSES)
        sums[UNKNOWN] = max(1, total - int(counts.sum()))
        self.known = {w: i + 1 for i, (w, _) in enumerate(words)}
        self.classes = np.r_[UNKNOWN, classes].astype(np.int64)
        self.shares = np.r_[-np.log(max(1, kinds - len(words))), np.log(counts) - np.log(sums[classes])]
        self.sums = sums

    def numbers(self, words: list[str]) -> np.ndarray:
        """Word numbers; 0 is unknown."""
        return np.fromiter(map(self.known.get, words, repeat(0)), np.int64, len(words))

    def read(self, text: str | None) -> np.ndarray:
        return self.numbers(words_of(text))


def frequent(counts: DataFrame) -> tuple[Vocabulary, pa.Table]:
    """The vocabulary by the ``counts``, and (word, n) of the most frequent words outside it.

    Those are all words whose count has so many binary digits, at most SENT words with the vocabulary's.
    """
    digits = F.length(F.bin("n"))
    sizes = counts.groupBy(digits.alias("digits")).agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("total")).collect()
    sizes.sort(key=lambda r: -r["digits"])
    total = sum(r["total"] for r in sizes)
    sums = np.cumsum([r["kinds"] for r in sizes])
    least = min((r["digits"] for r, n in zip(sizes, sums, strict=True) if n <= SENT), default=64)
    found = counts.filter((F.col("n") * VOCABULARY >= total) | (digits >= least)).toArrow()
    own = found["n"].to_numpy() * VOCABULARY >= total
    rows = found.filter(pa.array(own)).to_pylist()
    words = sorted(((r["word"], r["n"]) for r in rows), key=lambda x: (-x[1], x[0]))
    return Vocabulary(words, sum(r["kinds"] for r in sizes), total), found.filter(pa.array(~own))


def vocabulary(documents: DataFrame, counts: DataFrame | None = None) -> Vocabulary:
    """The vocabulary by the ``counts`` of the documents' words, which are taken if not given."""
    return frequent(landed(word_counts(documents), "words") if counts is None else counts)[0]


def _looked_up(words: pa.Array, among: pa.Array) -> np.ndarray:
    """Places of the words among others, from 1; 0 is not found."""
    return pc.fill_null(pc.index_in(words, value_set=among), -1).to_numpy() + 1


Weights = dict[str, np.ndarray]


def first_weights(sums: np.ndarray) -> Weights:
    """Small random weights; the output starts at the classes' frequencies."""
    rng = np.random.default_rng(SEED)
    weights = {n: rng.normal(0, 0.2 if n == "embed" else 0.1, s) for n, s in SHAPES.items()}
    weights["bias"][:] = 0
    weights["prior"] = np.log((sums + 1) / (sums + 1).sum())
    return {n: w.astype(np.float32) for n, w in weights.items()}


def flat(weights: Weights) -> np.ndarray:
    return np.concatenate([weights[n].ravel() for n in SHAPES])


def shaped(values: np.ndarray) -> Weights:
    sizes = [int(np.prod(s)) for s in SHAPES.values()]
    parts = np.split(values.astype(np.float32), np.cumsum(sizes)[:-1])
    return {n: p.reshape(s) for (n, s), p in zip(SHAPES.items(), parts, strict=True)}


_SIDES = np.array([*range(-WINDOW, 0), *range(1, WINDOW + 1)])


#: Products of matrices take less time in pieces of so many rows.
PIECE = 128


def _cut(x: np.ndarray) -> np.ndarray:
    """The matrix in pieces of PIECE rows, if it is made of such, else in one."""
    return x.reshape(-1, len(x) if len(x) % PIECE else PIECE, x.shape[1])


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (_cut(a) @ np.ascontiguousarray(b)).reshape(len(a), -1)


def _over_rows(a: np.ndarray, b: np.ndarray, out: np.ndarray) -> None:
    """a.T @ b"""
    (_cut(a).transpose(0, 2, 1) @ _cut(b)).sum(axis=0, out=out)


#: exp() and the sum of CLASSES such are safe in single precision up to here.
SAFE = 80


def _logits(hidden: np.ndarray, out: np.ndarray, prior: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers by row and class, and by class, that add up to the logits, each row but for a constant.

    They are fit for exp(). The second need not be added to the large matrix: exp() of it is a factor of each class.
    """
    x = _times(hidden, out)
    prior = prior - prior.max()
    # No hidden value is beyond 1.
    if (np.ones(len(out), out.dtype) @ np.abs(out)).max() - prior.min() < SAFE:
        return x, prior
    x += prior
    x -= x.max(axis=1, keepdims=True)
    return x, np.zeros_like(prior)


def class_log_probabilities(weights: Weights, around: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Log-probability of the class wanted at each position, from the classes around it."""
    mix = weights["mix"].reshape(-1, HIDDEN)
    out = np.empty(len(wanted), dtype=np.float64)
    for at in range(0, len(wanted), BLOCK):
        own, aim = around[at : at + BLOCK], wanted[at : at + BLOCK]
        hidden = _times(weights["embed"].take(own, axis=0).reshape(len(aim), -1), mix)
        hidden += weights["bias"]
        x, prior = _logits(np.tanh(hidden, out=hidden), weights["out"], weights["prior"])
        own_class = x[np.arange(len(aim)), aim] + prior[aim]
        out[at : at + len(aim)] = own_class - np.log(np.exp(x, out=x) @ np.exp(prior))
    return out


class Trainer:
    """Adam on cross-entropy; weights and gradients are views of one vector each, which a step changes at once."""

    def __init__(self, weights: Weights) -> None:
        self.all = flat(weights)
        self.gradient, self.first, self.second = (np.zeros_like(self.all) for _ in range(3))
        self.weights, self.slopes = self._views(self.all), self._views(self.gradient)
        self.steps = self.seen = 0

    @staticmethod
    def _views(values: np.ndarray) -> Weights:
        sizes = [int(np.prod(s)) for s in SHAPES.values()]
        return {n: v.reshape(s) for (n, s), v in zip(SHAPES.items(), np.split(values, np.cumsum(sizes)[:-1]), strict=True)}

    def gradients(self, around: np.ndarray, wanted: np.ndarray) -> Weights:
        """Views of the trainer's gradient, which the next call overwrites."""
        w, g, n = self.weights, self.slopes, len(wanted)
        inputs = w["embed"].take(around, axis=0).reshape(n, -1)
        mix = w["mix"].reshape(-1, HIDDEN)
        hidden = _times(inputs, mix)
        hidden += w["bias"]
        np.tanh(hidden, out=hidden)
        # The error is kept less two factors, of its rows and of the classes, which smaller matrices take.
        error, prior = _logits(hidden, w["out"], w["prior"])
        np.exp(error, out=error)
        factors = np.exp(prior)
        sums = error @ factors
        error.reshape(-1)[np.arange(0, error.size, CLASSES) + wanted] -= sums / factors[wanted]
        scale = 1 / (sums * n)
        back = _times(error, (w["out"] * factors).T)
        back *= scale[:, None]
        _over_rows(hidden * scale[:, None], error, g["out"])
        g["out"] *= factors
        np.matmul(scale, error, out=g["prior"])
        g["prior"] *= factors
        hidden *= hidden
        back *= np.subtract(1, hidden, out=hidden)
        _over_rows(inputs, back, g["mix"].reshape(-1, HIDDEN))
        np.matmul(np.ones(n, back.dtype), back, out=g["bias"])
        to_inputs = _times(back, mix.T).reshape(-1, EMBEDDING)
        # Sums by class: of each class's run in the order of classes; short numbers are sorted by digits.
        order = np.argsort(around.astype(CODE, copy=False), axis=None, kind="stable")
        counts = np.bincount(around.ravel(), minlength=CLASSES + 1)
        classes = np.flatnonzero(counts)
        g["embed"][:] = 0
        runs = to_inputs.take(order, axis=0)
        # Adding two numbers at once, as the parts of a complex one, takes less time.
        pairs = runs.view(np.result_type(runs, np.complex64))
        g["embed"][classes] = np.add.reduceat(pairs, (np.cumsum(counts) - counts)[classes]).view(runs.dtype)
        return g

    def step(self, around: np.ndarray, wanted: np.ndarray) -> None:
        self.steps += 1
        self.seen += len(wanted)
        rate = RATE / (1 + self.steps / 500)
        self.gradients(around, wanted)
        g = self.gradient
        change = g - self.first
        change *= 0.1
        self.first += change
        np.multiply(g, g, out=change)
        change -= self.second
        change *= 0.001
        self.second += change
        np.divide(self.second, 1 - 0.999**self.steps, out=change)
        np.sqrt(change, out=change)
        change += 1e-8
        np.divide(self.first, change, out=change)
        change *= rate / (1 - 0.9**self.steps)
        self.all -= change


def _positions(classes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Classes around each position, CLASSES beyond a document's ends, and the class there."""
    edge = np.full(WINDOW, CLASSES, dtype=CODE)
    row = np.concatenate([x.astype(CODE, copy=False) for c in classes for x in (edge, c)] + [edge])
    at = np.flatnonzero(row < CLASSES)
    around = np.empty((len(at), 2 * WINDOW), CODE)
    for i, side in enumerate(_SIDES):
        around[:, i] = row[at + side]
    return around, row[at]


def _train(words: Vocabulary, weights: Weights):
    vocabulary = pa.array(words.known, pa.string())
    codes = words.classes.astype(CODE)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(weights)
        for batch in _portions(batches):
            found, sizes = split(batch.column(0))
            own = np.split(codes[_looked_up(found, vocabulary)], np.cumsum(sizes)[:-1])
            for at in range(0, batch.num_rows, SLICE):
                around, wanted = _positions(own[at : at + SLICE])
                for start in range(0, len(wanted), BATCH):
                    trainer.step(around[start : start + BATCH], wanted[start : start + BATCH])
        if trainer.seen:
            values = trainer.all.astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(values))), pa.array(values), pa.array(np.full(len(values), trainer.seen))],
                names=["place", "value", "seen"],
            )

    return train


def train(documents: DataFrame, words: Vocabulary) -> Weights:
    """Weights after ROUNDS rounds over all documents."""
    weights = first_weights(words.sums)
    for _ in range(ROUNDS):
        found = texts(documents).select("text").mapInArrow(_train(words, weights), "place long, value double, seen long")
        # Sums of whole numbers do not depend on the order in which tasks end.
        scaled = (F.round(F.col("value") * 1e6).cast("decimal(20,0)") * F.col("seen")).cast("decimal(38,0)")
        sums = found.groupBy("place").agg(F.sum(scaled).cast("double").alias("sum"), F.sum("seen").alias("seen"))
        means = sums.select("place", (F.col("sum") / F.col("seen") / 1e6).alias("mean")).collect()
        if not means:
            break
        values = np.empty(len(means))
        values[[r["place"] for r in means]] = [r["mean"] for r in means]
        weights = shaped(values)
    return weights


RARE = "rare array<struct<word: string, times: long>>"


def _listed(words: pa.Array, texts: np.ndarray, n_texts: int) -> pa.Array:
    """The words of each text and their counts as a list of structs; ``texts`` are the words' texts, ascending."""
    coded = words.dictionary_encode()
    kinds = max(1, len(coded.dictionary))
    keys, times = np.unique(texts * kinds + coded.indices.to_numpy(), return_counts=True)
    ends = np.searchsorted(keys, np.arange(n_texts + 1) * kinds).astype(np.int32)
    pairs = pa.StructArray.from_arrays([coded.dictionary.take(pa.array(keys % kinds)), pa.array(times)], ["word", "times"])
    return pa.ListArray.from_arrays(pa.array(ends), pairs)


def _score(words: Vocabulary, weights: Weights, others: pa.Table | None = None):
    """Scores batches of (doc_id, text). Words outside the vocabulary that ``others`` (word, n) has get their shares here."""
    known, classes, shares = pa.array(words.known, pa.string()), words.classes.astype(CODE), words.shares
    if others is not None:
        known = pa.concat_arrays([known, *others["word"].cast(pa.string()).chunks])
        classes = np.r_[classes, np.full(len(others), UNKNOWN, CODE)]
        shares = np.r_[shares, np.log(others["n"].to_numpy()) - np.log(words.sums[UNKNOWN])]
    shares = np.r_[0.0, shares[1:]]  # those of all other words come from their table

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches):
            found, sizes = [], []
            for at in range(0, batch.num_rows, SLICE):
                own = [words_of(t) for t in batch.column(1).slice(at, SLICE).to_pylist()]
                found.append(pa.array(chain.from_iterable(own), pa.string()))
                sizes += map(len, own)
            found, sizes = pa.concat_arrays(found), np.array(sizes, dtype=np.int64)
            numbers = _looked_up(found, known)
            ends = np.r_[0, np.cumsum(sizes)]
            for at in range(0, batch.num_rows, SLICE):
                part, own = batch.column(0).slice(at, SLICE), sizes[at : at + SLICE]
                here = slice(ends[at], ends[at + len(part)])
                every = numbers[here]
                logs = class_log_probabilities(weights, *_positions(np.split(classes[every], np.cumsum(own)[:-1])))
                logs += shares[every]
                rare = np.flatnonzero(every == 0)
                sums = np.r_[0.0, np.cumsum(logs)][ends[at : at + len(part) + 1] - here.start]
                listed = _listed(found[here].take(pa.array(rare)), np.repeat(np.arange(len(part)), own)[rare], len(part))
                yield pa.RecordBatch.from_arrays([part, pa.array(own), pa.array(np.diff(sums)), listed], names=["doc_id", "n_words", "known", "rare"])

    return score


def rare_shares(scored: DataFrame, counts: DataFrame, words: Vocabulary) -> DataFrame:
    """(row, others): the log shares of all words listed as rare in a row, by their counts.

    Such a word is less than one in VOCABULARY words, so no key of the join is hot. Words found once
    need not be joined: the logarithm of their count is 0.
    """
    rare = scored.select("row", F.explode("rare").alias("r")).select("row", "r.*")
    rare = rare.join(counts.filter("n > 1"), "word", "left")
    share = F.round(F.col("times") * (F.coalesce(F.log("n"), F.lit(0.0)) - F.lit(float(np.log(words.sums[UNKNOWN])))), 9)
    # Sums of whole numbers do not depend on the order in which tasks end.
    return rare.groupBy("row").agg(F.sum(share.cast("decimal(28,9)")).cast("double").alias("others"))


def pseudo_likelihood(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, log_probability (of all words, natural) and per_word of every document.

    Counts and weights come from ``documents`` themselves. Null, empty and blank texts have no
    words, log_probability 0 and per_word null. Repeated rows and null ids stay rows.
    """
    counts = landed(word_counts(documents), "words")
    words, others = frequent(counts)
    weights = train(documents, words)
    rows = texts(documents).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = rows.mapInArrow(_score(words, weights, others), f"doc_id long, n_words long, known double, {RARE}")
    found = landed(found.withColumn("row", F.monotonically_increasing_id()), "scores")
    both = found.drop("rare").join(rare_shares(found, counts, words), "row", "left")
    scored = both.select("doc_id", "n_words", (F.col("known") + F.coalesce("others", F.lit(0.0))).alias("log_probability"))
    return scored.withColumn("per_word", F.when(F.col("n_words") > 0, F.col("log_probability") / F.col("n_words")))
