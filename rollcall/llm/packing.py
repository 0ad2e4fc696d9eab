"""Best-fit decreasing packing of token sequences.

Texts are tokenized where they lie; only narrow rows, one per piece, move. Pieces are dealt by a
row number to groups of bounded size. In a group the longest piece comes first and goes to the
open sequence with the least space that holds it, found in a segment tree over the remaining
capacities. Sequences that stay open wider than ``slack`` are dissolved and their pieces packed
again in fewer, mixed groups, until one group is left or the rest no longer shrinks. Thus every
group is bounded, and a handful of sequences is left unfilled, however large the table is.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import landed, texts

LENGTH = 2048
#: The id behind every document.
END = 0
#: Pieces of one packing group.
GROUP = 20_000
#: Words of a generation whose ids a worker remembers, of two, and characters of texts encoded at once.
REMEMBERED, SLICE = 300_000, 2_000_000
#: Plain words that go to the tokenizer as one text.
TOGETHER = 10_000
#: The tokenizer's pieces of plain words: of letters that stay one letter each in lower case, of digits and ASCII signs.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zÀ-ÖØ-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]+")
PLAIN = re.compile(r"[!-@\[-~À-ÖØ-öø-ÿ]+")
ENDING = "</w>"
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"

_encoders: dict[str, WordEncoder] = {}


class Remembered(dict):
    """Ids of words in two generations: what is not asked for any more is forgotten, the rest stays."""

    def __init__(self) -> None:
        self.older: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        found = self[word] = self.older[word]
        return found

    def has(self, word: bytes) -> bool:
        return word in self or word in self.older

    def turn(self, most: int) -> None:
        """Starts a new generation when this one is full."""
        if len(self) > most:
            self.older = dict(self)
            self.clear()


def _lower(raw: bytes) -> bytes:
    """ASCII in lower case, unless a combining mark (U+0300 to U+037F begin with these bytes) is in the text."""
    return raw if b"\xcc" in raw or b"\xcd" in raw else raw.lower()


class WordEncoder:
    """Ids of texts by a tokenizer that drops white space, with the ids of words remembered.

    The tokenizer must split its input at white space, at least, before it merges; then a text's ids
    are those of its blank-separated words, one after the other. Texts without combining marks are
    lowered first, as far as they are ASCII; in others the tokenizer composes letters and marks before
    it lowers them, so their words stay as they are. A full stop or comma after an ASCII
    letter or digit is always a piece of its own and is encoded apart. New words of all texts that are
    encoded together go to the tokenizer in one call; plain ones as few texts, whose ids are cut by the
    number of pieces of each word, as the last id of a piece is one that ends with ``ENDING``.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = Remembered()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ending = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ending[[i for token, i in vocabulary.items() if token.endswith(ENDING)]] = True

    def _plain_ids(self, words: list[str]) -> Iterator[bytes]:
        """Ids of plain words."""
        parts = [words[at : at + TOGETHER] for at in range(0, len(words), TOGETHER)]
        for part, ids in zip(parts, self._ids([" ".join(part) for part in parts]), strict=True):
            ends = 4 * np.flatnonzero(self.ending[np.frombuffer(ids, dtype="<u4")]) + 4
            pieces = np.cumsum([1 if w.isalpha() else len(PIECES.findall(w)) for w in part])
            cuts = ends[pieces - 1].tolist()
            if pieces[-1] != len(ends) or cuts[-1] != len(ids):
                raise ValueError("the tokenizer splits words otherwise")
            yield from (ids[start:end] for start, end in zip([0, *cuts[:-1]], cuts, strict=True))

    def _ids(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _learn(self, words: set[bytes]) -> None:
        known, older = self.known, self.known.older
        new = [w for w in words if w not in known and w not in older]
        if not new:
            return
        ended = [w for w in new if w[-1] in b".," and w[-2:-1].isalnum()]
        cores = {b".", b",", *new}.difference(ended).union([w[:-1] for w in ended])
        fresh = [c for c in cores if c not in known and c not in older]
        fresh = [c.decode() for c in fresh]
        plain = [c for c in fresh if PLAIN.fullmatch(c)]
        others = list(set(fresh).difference(plain))
        known.update(zip([c.encode() for c in plain], self._plain_ids(plain), strict=True))
        known.update(zip([c.encode() for c in others], self._ids(others), strict=True))
        for word in ended:
            known[word] = known[word[:-1]] + known[word[-1:]]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        raw = [_lower(text.encode()) if text else b"" for text in texts]
        whole = [b"<" in r and any(s in r.lower() for s in self.special) for r in raw]
        words = [[] if w else r.split() for r, w in zip(raw, whole, strict=True)]
        self.known.turn(REMEMBERED)
        self._learn(set().union(*words))
        get = self.known.__getitem__
        return [self._ids([t])[0] if w else b"".join(map(get, own)) for t, w, own in zip(texts, whole, words, strict=True)]

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]


def _encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list, list]]:
    """(ids, texts) of a batch, about ``SLICE`` characters each."""
    ids, texts_, size = [], [], 0
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        text = text.as_py()
        ids.append(doc_id)
        texts_.append(text)
        size += 100 + len(text or "")
        if size >= SLICE:
            yield ids, texts_
            ids, texts_, size = [], [], 0
    if ids:
        yield ids, texts_


def _cut(path: str, length: int, keep_ids: bool):
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int32())] * keep_ids
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(kinds)]
    end = np.array([END], dtype="<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            for doc_ids, texts_ in _slices(batch):
                out: list[tuple] = []
                for doc_id, ids in zip(doc_ids, encoder.encode_all(texts_), strict=True):
                    ids += end
                    for piece, start in enumerate(range(0, len(ids) // 4, length)):
                        own = ids[4 * start : 4 * (start + length)]
                        row = (doc_id, piece, start, len(own) // 4, zlib.crc32(own))
                        out.append((*row, np.frombuffer(own, dtype="<u4").astype("i4")) if keep_ids else row)
                columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return pieces


def token_pieces(documents: DataFrame, tokenizer: str, length: int = LENGTH, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every document's pieces.

    A document is its ids and one end id, cut only if longer than ``length``. Null and empty texts
    are the end id alone. Repeated rows and null ids are documents of their own.
    """
    schema = PIECE + (", ids array<int>" if keep_ids else "")
    return texts(documents).select(F.col("doc_id").cast("long"), "text").mapInArrow(_cut(tokenizer, length, keep_ids), schema)


class OpenBins:
    """Open sequences by remaining capacity, counted in a segment tree."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, bin_: int, space: int) -> None:
        self.bins[space].append(bin_)
        self._count(space, 1)

    def _count(self, space: int, by: int) -> None:
        at = space + self.size
        while at:
            self.tree[at] += by
            at >>= 1

    def tightest(self, length: int) -> tuple[int, int] | None:
        """Takes out the open sequence with the least space of at least ``length``: (bin, space)."""
        at = length + self.size
        if not self.tree[at]:
            while at > 1 and (at & 1 or not self.tree[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.tree[2 * at] else 2 * at + 1
        space = at - self.size
        self._count(space, -1)
        return self.bins[space].pop(), space


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each length, and the space left in each bin."""
    bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    left: list[int] = []
    open_ = OpenBins(capacity)
    for at in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[at])
        found = open_.tightest(length)
        if found is None:
            found = (len(left), capacity)
            left.append(capacity)
        bin_, space = found
        bins[at], offsets[at] = bin_, capacity - space
        left[bin_] = space - length
        if space > length:
            open_.put(bin_, space - length)
    return bins, offsets, np.array(left, dtype=np.int64)


def _pack_group(first: int, capacity: int):
    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("row", "ascending")])
        bins, offsets, left = best_fit_decreasing(group.column("length").to_numpy(), capacity)
        number = first + (group.column("shard")[0].as_py() << 24)
        group = group.drop_columns(["shard"])
        for name, values in (("sequence_id", bins + number), ("offset", offsets), ("space", left[bins])):
            group = group.append_column(name, pa.array(values, pa.int64()))
        return group

    return pack


def pack_pieces(pieces: DataFrame, capacity: int = LENGTH, slack: int = LENGTH // 512, group: int = GROUP) -> DataFrame:
    """``pieces`` with sequence_id and offset; every length must be 1 to ``capacity``.

    ``pieces`` should be cheap to read twice. An empty table gives no rows.
    """
    names = pieces.columns
    rest = landed(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields)
    done, n, turn = [], rest.count(), 0
    while True:
        shards = max(1, -(-n // group))
        shard = F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(shards))
        packed = landed(
            rest.withColumn("shard", shard).groupBy("shard").applyInArrow(
                _pack_group(turn << 56, capacity), fields + ", sequence_id long, offset long, space long"
            ),
            "packed",
        )
        loose = packed.filter(F.col("space") > slack)
        again = loose.count() if shards > 1 else 0
        if not again or again > n * 3 // 4:
            done.append(packed)
            break
        done.append(packed.filter(F.col("space") <= slack))
        rest, n, turn = loose.drop("sequence_id", "offset", "space"), again, turn + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(*names, "sequence_id", "offset")


def pack_documents(documents: DataFrame, tokenizer: str, length: int = LENGTH, keep_ids: bool = False) -> DataFrame:
    """Every piece of every document with its place: sequence_id and offset, gapless from 0."""
    return pack_pieces(token_pieces(documents, tokenizer, length, keep_ids), length, length // 512)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids of each sequence, from pieces that kept their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
