"""Ranked search of whole documents with MaxScore, whose bounds know pairs of terms.

Documents are read once into a forward index of the terms that items ask for, stored as narrow rows.
Two passes over it store what the bounds need: for every term its documents and its highest impact,
and for pairs of terms of one item the list where both occur, folded to its length and its highest
joint impact. A search then takes blocks of documents. An item's terms are taken in units, matched
pairs or single terms. A document holds a unit's first term, its second or both, so it gains at most
the highest of both impacts and the joint one, which is tighter than the sum of the two. Units whose
bounds add up to less than the score that is needed are only looked up for documents that other
units bring up, and only while a document's score and the bounds left can still reach it.

Scores that are needed start from a search of a small part of the documents, where the fiftieth best
is no better than that of all, and rise as a task goes on. Nothing is lost by either bound: documents
that can tie with the last place are always scored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import landed

BEST = 50
#: Term occurrences of items that are searched for at once; more items are searched in blocks.
ITEM_TERMS = 200_000
#: Rows and postings of a block of documents, and texts that are indexed at once.
BLOCK_ROWS, BLOCK_POSTINGS, SLICE = 20_000, 2_000_000, 500
#: Documents whose search sets the first scores that are needed.
SEED_DOCUMENTS = 20_000
#: Of an item's terms by impact, how far apart two may be to have their pair list stored.
REACH = 3

# Separators become blanks and A-Z lower case; bytes of other letters stay.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and all characters beyond ASCII, with A-Z in lower case."""
    return text.encode().translate(_TABLE).split() if text else []


@dataclass(frozen=True)
class Corpus:
    """Documents with a term and all their terms."""

    documents: int
    terms: int

    def weight(self, documents: int) -> int:
        """Of a term that so many documents hold."""
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * documents + 1)))

    def lengths(self, n: np.ndarray) -> np.ndarray:
        """What stands for a document's length, from the number of its terms."""
        if not n.size or 50 * int(n.max()) * self.documents < 1 << 63:
            return 50 + 50 * n * self.documents // self.terms
        return np.array([50 + 50 * int(x) * self.documents // self.terms for x in n], dtype=np.int64)


def saturation(tf: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 20 * lengths)


@dataclass
class Queries:
    """Items of a block of items: number, distinct terms by their place in the vocabulary, units."""

    numbers: list[int]
    terms: list[np.ndarray]
    #: Per item (first, second or -1, highest joint impact).
    units: list[list[tuple[int, int, int]]]


# ---------------------------------------------------------------- index


def _index(vocabulary):
    """(doc_id, text) to doc_id, the number of its terms, and the vocabulary's terms with their counts."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = vocabulary.value
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                n, own, counts = [], [], []
                for text in part.column(1):
                    words = terms(text.as_py())
                    held = Counter(words)
                    known = [t for t in held if t in place]
                    n.append(len(words))
                    own.append([place[t] for t in known])
                    counts.append([held[t] for t in known])
                lists = [pa.array(x, pa.list_(k)) for x, k in ((own, pa.int32()), (counts, pa.int64()))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), *lists], names=["doc_id", "n", "terms", "counts"]
                )

    return index


class Block:
    """Postings of some documents by term: rows in order and impacts."""

    def __init__(self, batches: list[pa.RecordBatch], corpus: Corpus, weights: np.ndarray) -> None:
        table = pa.Table.from_batches(batches).combine_chunks()
        ids = table.column("doc_id").combine_chunks()
        self.no_id = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy()
        own, counts = (table.column(c).combine_chunks() for c in ("terms", "counts"))
        row = np.repeat(np.arange(len(self.ids)), own.value_lengths().to_numpy())
        term = own.flatten().to_numpy()
        gained = saturation(counts.flatten().to_numpy(), corpus.lengths(table.column("n").to_numpy())[row])
        order = np.argsort(term, kind="stable")
        self.rows, self.impacts = row[order], (weights[term] * gained)[order]
        self.starts = np.searchsorted(term[order], np.arange(len(weights) + 1))
        self.most = np.zeros(len(weights), np.int64)
        np.maximum.at(self.most, term, weights[term] * gained)

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        own = slice(self.starts[term], self.starts[term + 1])
        return self.rows[own], self.impacts[own]

    def at(self, term: int, rows: np.ndarray) -> np.ndarray:
        """Impacts of a term on rows in order, 0 where it does not occur."""
        held, impacts = self.postings(term)
        if not len(held):
            return np.zeros(len(rows), np.int64)
        place = np.minimum(np.searchsorted(held, rows), len(held) - 1)
        return np.where(held[place] == rows, impacts[place], 0)

    def both(self, a: int, b: int) -> tuple[int, int]:
        """Length and highest joint impact of the list where both terms occur."""
        if self.starts[a + 1] - self.starts[a] > self.starts[b + 1] - self.starts[b]:
            a, b = b, a
        rows, impacts = self.postings(a)
        held, _ = self.postings(b)
        if not len(rows) or not len(held):
            return 0, 0
        place = np.minimum(np.searchsorted(held, rows), len(held) - 1)
        shared = held[place] == rows
        joint = impacts[shared] + self.postings(b)[1][place[shared]]
        return len(joint), int(joint.max(initial=0))


def _blocks(batches: Iterator[pa.RecordBatch], corpus: Corpus, weights: np.ndarray) -> Iterator[Block]:
    held, rows, postings = [], 0, 0
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            held.append(part)
            rows += part.num_rows
            postings += len(part.column("terms").flatten())
            if rows >= BLOCK_ROWS or postings >= BLOCK_POSTINGS:
                yield Block(held, corpus, weights)
                held, rows, postings = [], 0, 0
    if held:
        yield Block(held, corpus, weights)


def term_statistics(index: DataFrame, corpus: Corpus, size: int) -> DataFrame:
    """(term, documents, most): documents that hold each term, and its highest saturation in one."""

    def statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, most = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            own, counts = batch.column("terms"), batch.column("counts")
            row = np.repeat(np.arange(batch.num_rows), own.value_lengths().to_numpy())
            term = own.flatten().to_numpy()
            held += np.bincount(term, minlength=size)
            gained = saturation(counts.flatten().to_numpy(), corpus.lengths(batch.column("n").to_numpy())[row])
            np.maximum.at(most, term, gained)
        found = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (found, held[found], most[found])], names=["term", "documents", "most"])

    each = index.mapInArrow(statistics, "term long, documents long, most long")
    return each.groupBy("term").agg(F.sum("documents").alias("documents"), F.max("most").alias("most"))


def pair_lists(index: DataFrame, corpus: Corpus, weights: np.ndarray, pairs: list[tuple[int, int]]) -> DataFrame:
    """(a, b, documents, most) of pairs that occur together: documents that hold both terms, and the
    highest sum of both impacts in one."""
    shared = index.sparkSession.sparkContext.broadcast((weights, pairs))

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_weights, own_pairs = shared.value
        found = np.zeros((len(own_pairs), 2), np.int64)
        for block in _blocks(batches, corpus, own_weights):
            for i, (a, b) in enumerate(own_pairs):
                n, most = block.both(a, b)
                if n:
                    found[i] = found[i, 0] + n, max(found[i, 1], most)
        at = np.flatnonzero(found[:, 0])
        a, b = (np.array([own_pairs[i][side] for i in at], np.int64) for side in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (a, b, found[at, 0], found[at, 1])], names=["a", "b", "documents", "most"])

    each = index.mapInArrow(lists, "a long, b long, documents long, most long")
    return each.groupBy("a", "b").agg(F.sum("documents").alias("documents"), F.max("most").alias("most"))


# ---------------------------------------------------------------- bounds


def near_pairs(own: np.ndarray, most: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of an item's terms that lie within REACH of each other by their highest impact."""
    order = [int(t) for t in own[np.argsort(-most[own], kind="stable")] if most[t]]
    return [tuple(sorted((a, b))) for i, a in enumerate(order) for b in order[i + 1 : i + 1 + REACH]]


def unit_bound(a: int, b: int, joint: int) -> int:
    """Most that a document gains from two terms with the highest impacts a and b, jointly ``joint``."""
    return max(a, b, min(a + b, joint))


def matched_units(own: np.ndarray, most: np.ndarray, joint: dict[tuple[int, int], int]) -> list[tuple[int, int, int]]:
    """An item's terms as pairs, those first that tighten the bound most, and single terms."""
    saved = []
    for pair in set(near_pairs(own, most)):
        a, b = (int(most[t]) for t in pair)
        saved.append((unit_bound(a, b, joint.get(pair, 0)) - a - b, pair))
    units, used = [], set()
    for gain, (a, b) in sorted(saved):
        if gain < 0 and a not in used and b not in used:
            used |= {a, b}
            units.append((a, b, joint.get((a, b), 0)))
    return units + [(int(t), -1, 0) for t in own if int(t) not in used and most[t]]


class Best:
    """The best rows of one item so far: highest score, then smallest doc_id, null ids last."""

    def __init__(self, needed: int, size: int) -> None:
        self.needed, self.size = needed, size
        self.scores, self.no_id, self.ids = np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)

    def add(self, scores: np.ndarray, no_id: np.ndarray, ids: np.ndarray) -> None:
        scores, no_id, ids = (np.r_[x, y] for x, y in ((self.scores, scores), (self.no_id, no_id), (self.ids, ids)))
        order = np.lexsort((ids, no_id, -scores))[: self.size]
        self.scores, self.no_id, self.ids = scores[order], no_id[order], ids[order]
        if len(order) == self.size:
            self.needed = max(self.needed, int(self.scores[-1]))


def search_block(block: Block, units: list[tuple[int, int, int]], best: Best) -> int:
    """Adds the block's documents that may be among the best; returns how many were scored in full."""
    bounded = []
    for a, b, joint in units:
        high = int(block.most[a]) if b < 0 else unit_bound(int(block.most[a]), int(block.most[b]), joint)
        if high:
            bounded.append((high, (a,) if b < 0 else (a, b)))
    bounded.sort()
    left, optional = 0, 0
    while optional < len(bounded) and left + bounded[optional][0] < best.needed:
        left += bounded[optional][0]
        optional += 1
    if optional == len(bounded):
        return 0
    gained = np.zeros(len(block.ids), np.int64)
    for _, own in bounded[optional:]:
        for term in own:
            rows, impacts = block.postings(term)
            gained[rows] += impacts
    rows = np.flatnonzero(gained)
    scores = gained[rows]
    for high, own in [(0, ()), *reversed(bounded[:optional])]:
        for term in own:
            scores = scores + block.at(term, rows)
        left -= high
        may = scores + left >= best.needed
        rows, scores = rows[may], scores[may]
    best.add(scores, block.no_id[rows], block.ids[rows])
    return len(rows)


def _search(queries, weights_, corpus: Corpus, needed: np.ndarray, size: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Queries = queries.value
        best = [Best(int(n), size) for n in needed]
        for block in _blocks(batches, corpus, weights_.value):
            for units, one in zip(own.units, best, strict=True):
                search_block(block, units, one)
        for number, one in zip(own.numbers, best, strict=True):
            if len(one.ids):
                columns = [pa.array(np.full(len(one.ids), number)), pa.array(one.ids, mask=one.no_id), pa.array(one.scores)]
                yield pa.RecordBatch.from_arrays(columns, names=["query", "doc_id", "score"])

    return search


_FOUND = "query long, doc_id long, score long"


def _ranked(found: DataFrame, size: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)


# ---------------------------------------------------------------- search


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for query, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = sorted(set(terms(text)))
            yield pa.RecordBatch.from_arrays([pa.array([query] * len(own), pa.int64()), pa.array(own, pa.binary())], names=["query", "term"])


def _search_items(documents: DataFrame, asked: pa.Table, size: int) -> DataFrame:
    """(query, doc_id, score, rank) for the items of one block, whose (query, term) are given."""
    context = documents.sparkSession.sparkContext
    names = sorted(set(asked.column("term").to_pylist()))
    place = {t: i for i, t in enumerate(names)}
    index = landed(
        documents.mapInArrow(_index(context.broadcast(place)), "doc_id long, n long, terms array<int>, counts array<long>"), "index"
    )
    totals = index.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("terms")).first()
    corpus = Corpus(totals["documents"], totals["terms"] or 0)
    held = index.filter(F.size("terms") > 0)
    # At most a row per term of the block's items.
    weights, most = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
    for term, n, top in term_statistics(held, corpus, len(names)).toLocalIterator():
        weights[term] = corpus.weight(n)
        most[term] = weights[term] * top
    own: dict[int, list[int]] = {}
    for query, term in zip(asked.column("query").to_pylist(), asked.column("term").to_pylist(), strict=True):
        own.setdefault(query, []).append(place[term])
    lists = [np.array(t) for t in own.values()]
    pairs = sorted({p for t in lists for p in near_pairs(t, most)})
    # At most REACH rows per term of the block's items.
    joint = {(a, b): top for a, b, _, top in pair_lists(held, corpus, weights, pairs).toLocalIterator()}
    queries = Queries(list(own), lists, [matched_units(t, most, joint) for t in lists])
    shared = context.broadcast(queries), context.broadcast(weights), corpus
    needed = np.ones(len(lists), np.int64)
    parts = corpus.documents // SEED_DOCUMENTS
    if parts > 1:
        some = held.filter(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) == 0)
        last = _ranked(some.mapInArrow(_search(*shared, needed, size), _FOUND), size).filter(F.col("rank") == size)
        seeds = {row["query"]: row["score"] for row in last.select("query", "score").toLocalIterator()}
        needed = np.array([seeds.get(q, 1) for q in queries.numbers], np.int64)
    return _ranked(held.mapInArrow(_search(*shared, needed, size), _FOUND), size)


def search(documents: DataFrame, items: DataFrame, size: int = BEST) -> DataFrame:
    """item_id, rank, doc_id and score: every item's ``size`` best documents with a score above 0.

    Terms are runs of ASCII letters, digits and characters beyond ASCII, with A-Z in lower case. A
    term counts ``floor(1000 ln((2 N + 2) / (2 df + 1)))`` times its saturation, which falls with the
    document's length; see ``Corpus`` and ``saturation``. Equal scores rank by ascending doc_id,
    null ids last. Repeated rows are documents, or items, of their own; null and empty texts have no
    terms, and such items, like items without any hit, give no rows. Other columns are left out; no
    documents or no items give no rows.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    asked = items.select(F.col("item_id"), "text").withColumn("query", F.monotonically_increasing_id())
    asked = landed(asked, "items")
    own = landed(asked.select("query", "text").mapInArrow(_item_terms, "query long, term binary"), "item-terms")
    blocks = max(1, -(-own.count() // ITEM_TERMS))
    found = None
    for block in range(blocks):
        part = own.filter(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block).toArrow()
        if part.num_rows:
            one = _search_items(rows, part, size)
            found = one if found is None else found.unionByName(one)
    if found is None:
        found = asked.select("query", F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"), F.lit(0).alias("rank")).limit(0)
    return found.join(asked.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")
