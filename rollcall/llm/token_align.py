"""Alignment of two tokenizers by the bytes their tokens cover, and corpus-wide links of their ids.

Texts are tokenized where they lie, in slices. In a slice everything is an Arrow column: token ids
are flattened from lists, each with its parent text; byte lengths are looked up and summed within
each text; a hash join on (text, end) finds the places where tokens of both tokenizers end, which
cut both sequences into groups. Pairs of ids in a group are links. ``Table.group_by`` folds them per
text and then per block of texts, so Spark sums a row per block and pair of ids, joins the sums back
to the blocks, and every block scores its texts.

An executor holds a slice and the links of a block per task in Python. In the JVM a block is many
short rows, a pair of ids or a text each; no row, buffer or batch there grows with the block.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import landed, small_batches

#: Bytes of texts in a slice and in a block; a longer text is a slice and a block of its own.
SLICE_BYTES, BLOCK_BYTES = 1 << 18, 6 << 20
#: Bytes of an Arrow batch that goes back to Spark, and of a row group in which Spark stores such rows.
BATCH_BYTES, ROW_GROUP_BYTES = 1 << 20, 8 << 20
#: Links per token up to which they are listed before they are folded.
FEW_LINKS = 4
#: Fixed value: how the byte-level vocabulary cuts a text before it merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACE = "▁"
BLANK_RUN = 10_000
_BLANK_RUN = re.compile(rf"(?<!\s)\s{{{BLANK_RUN}}}")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable bytes of Latin-1 stand for themselves, the others follow from U+0100 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteTokens:
    """A byte-level BPE tokenizer file, with the bytes of each id.

    Where ids follow the order of merges and the pattern is the usual one, texts are encoded by the
    same vocabulary as ranks, which gives the same ids several times faster.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters, vocabulary = byte_letters(), spec["model"]["vocab"]
        special = {t["content"] for t in spec.get("added_tokens", ())}
        ranks = {bytes(letters[c] for c in t): i for t, i in vocabulary.items() if t not in special}
        self.bytes = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, i in ranks.items():
            self.bytes[i] = token
        merges = [m if isinstance(m, str) else " ".join(m) for m in spec["model"].get("merges", ())]
        merged = [vocabulary.get(m.replace(" ", "", 1), -1) for m in merges]
        usual = spec.get("normalizer") is None and (spec.get("pre_tokenizer") or {}).get("use_regex")
        if usual and merged == sorted(set(merged)) and all(bytes([b]) in ranks for b in range(256)):
            import tiktoken

            encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.by_ranks = encoding.encode_ordinary
        else:
            self.by_ranks = None
        self.path, self.tokenizer = path, None

    def encode(self, text: str) -> list[int]:
        # Very long runs of blanks overflow the stack of the faster encoder's pattern.
        if self.by_ranks and not (len(text) > BLANK_RUN and _BLANK_RUN.search(text)):
            return self.by_ranks(text)
        if self.tokenizer is None:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(self.path)
            self.tokenizer.encode_special_tokens = True
        return self.tokenizer.encode(text, add_special_tokens=False).ids


class PieceTokens:
    """A SentencePiece model, with the bytes of each id."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [self._bytes(model, i) for i in range(model.get_piece_size())]
        self.encode = model.encode

    @staticmethod
    def _bytes(model, i: int) -> bytes:
        if model.is_control(i) or model.is_unknown(i):
            return b""
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(SPACE, " ").encode()


class Side:
    """One tokenizer's ids as Arrow columns to look up."""

    def __init__(self, tokens: ByteTokens | PieceTokens) -> None:
        self.tokens = tokens
        self.lengths = pa.array([len(b) for b in tokens.bytes], pa.int64())
        self.names = pa.array(map(str, range(len(tokens.bytes))), pa.string())

    def ids(self, text: str, wanted: bytes) -> list[int] | None:
        """Ids of a text, or None if their bytes are not the wanted ones."""
        found = self.tokens.encode(text)
        return found if b"".join(map(self.tokens.bytes.__getitem__, found)) == wanted else None


_sides: dict[tuple[str, str], tuple[Side, Side]] = {}


def _load(path_a: str, path_b: str) -> tuple[Side, Side]:
    if (path_a, path_b) not in _sides:
        _sides[path_a, path_b] = Side(ByteTokens(path_a)), Side(PieceTokens(path_b))
    return _sides[path_a, path_b]


class Aligned:
    """Groups and links of a slice of texts.

    ``n_a``, ``n_b``, ``n_groups`` and ``n_links`` have a value per text, zeros where a text has no
    tokens. ``links`` is a table of (row, key, times): a key is ``a << 32 | b``.
    """

    def __init__(self, texts: list[str | None], side_a: Side, side_b: Side) -> None:
        ids_a, ids_b = [], []
        for text in texts:
            one = two = None
            if text:
                wanted = b" " + text.encode()
                one = side_a.ids(" " + text, wanted)
                two = side_b.ids(text, wanted) if one is not None else None
            ids_a.append(one if two is not None else [])
            ids_b.append(two if two is not None else [])
        self.rows = len(texts)
        self.a, self.a_row, a_end, a_total = self._ends(ids_a, side_a)
        self.b, self.b_row, b_end, b_total = self._ends(ids_b, side_b)
        keys = ["row", "end"]
        left, right = (pa.table({"row": r, "end": e, "total": t}) for r, e, t in ((self.a_row, a_end, a_total), (self.b_row, b_end, b_total)))
        both = left.join(right.select(keys), keys=keys, join_type="inner")
        total = both.column("total").to_numpy()
        order = np.argsort(total)
        total, self.row = total[order], both.column("row").to_numpy()[order]
        # Both sides cover the same bytes, so one running total orders the tokens of either.
        self.a_group, self.b_group = (np.searchsorted(total, t.to_numpy()) for t in (a_total, b_total))
        self.a_size, self.b_size = (np.bincount(g, minlength=len(total)) for g in (self.a_group, self.b_group))
        self.names = side_a.names, side_b.names
        self.n_a, self.n_b = (np.bincount(r.to_numpy(), minlength=self.rows) for r in (self.a_row, self.b_row))
        self.n_groups = np.bincount(self.row, minlength=self.rows)
        before = np.r_[0, np.cumsum(self.a_size * self.b_size)]
        last = np.cumsum(self.n_groups)
        self.n_links = before[last] - before[last - self.n_groups]
        self.links = self._folded(self._listed() if before[-1] <= FEW_LINKS * (len(self.a) + len(self.b)) else self._joined())

    @staticmethod
    def _ends(ids: list[list[int]], side: Side) -> tuple[np.ndarray, pa.Array, pa.Array, pa.Array]:
        """Ids, their text, where each token ends within it, and the running total of bytes."""
        lists = pa.array(ids, pa.list_(pa.int32()))
        flat, row = lists.flatten(), pc.list_parent_indices(lists).cast(pa.int64())
        total = pc.cumulative_sum(side.lengths.take(flat))
        last = np.cumsum([len(i) for i in ids])
        before = np.r_[0, total.to_numpy()][np.r_[0, last[:-1]]] if ids else np.empty(0, np.int64)
        end = pc.subtract(total, pa.array(before, pa.int64()).take(row))
        return flat.to_numpy().astype(np.int64), row, end, total

    def _listed(self) -> pa.Table:
        """Every link once."""
        times = self.b_size[self.a_group]
        first = (np.cumsum(self.b_size) - self.b_size)[self.a_group]
        at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times - first, times)
        key = np.repeat(self.a << 32, times) | self.b[at]
        return pa.table({"row": np.repeat(self.a_row.to_numpy(), times), "key": key, "times": np.ones(len(key), np.int64)})

    def _joined(self) -> pa.Table:
        """Links folded by group and ids first, for groups of very many tokens."""
        a, b = (
            pa.table({"group": g, "id": i}).group_by(["group", "id"]).aggregate([([], "count_all")])
            for g, i in ((self.a_group, self.a), (self.b_group, self.b))
        )
        met = a.join(b, "group", join_type="inner", right_suffix="_b")
        id_a, id_b, n_a, n_b = (met.column(c).to_numpy() for c in ("id", "id_b", "count_all", "count_all_b"))
        return pa.table({"row": self.row[met.column("group").to_numpy()], "key": id_a << 32 | id_b, "times": n_a * n_b})

    @staticmethod
    def _folded(links: pa.Table) -> pa.Table:
        folded = links.group_by(["row", "key"]).aggregate([("times", "sum")])
        return pa.table({"row": folded.column("row"), "key": folded.column("key"), "times": folded.column("times_sum")})

    def texts(self) -> list[str]:
        """The groups of each text: ids of a joined by commas, a bar, ids of b; groups joined by semicolons."""

        def joined(ids: np.ndarray, sizes: np.ndarray, names: pa.Array) -> pa.Array:
            offsets = pa.array(np.r_[0, np.cumsum(sizes)], pa.int64())
            return pc.binary_join(pa.LargeListArray.from_arrays(offsets, names.take(pa.array(ids))), ",")

        a, b = joined(self.a, self.a_size, self.names[0]), joined(self.b, self.b_size, self.names[1])
        groups = pc.binary_join_element_wise(a, b, "|").cast(pa.string())
        offsets = pa.array(np.r_[0, np.cumsum(self.n_groups)], pa.int64())
        return pc.binary_join(pa.LargeListArray.from_arrays(offsets, groups), ";").to_pylist()


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """(ids, texts) of consecutive rows, about ``SLICE_BYTES`` each."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = text.as_py()
            ids.append(doc_id)
            texts.append(text)
            size += 64 + len(text or "")
            if size >= SLICE_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
#: Of a block: a row for each of its pairs of ids, then a row for each of its texts; the other's columns are null.
#: ``links`` are a text's pairs as places in the block's sorted keys, ``times`` how often it has them, as plain bytes.
_PAIR = ("key long", "holders long")
_TEXT = ("doc_id long", "sha string", *(f"{c} long" for c in _COUNTS), "links binary", "times binary")
_BLOCK = ", ".join(("block long", *_PAIR, *_TEXT))
_KINDS = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of the values up to each end."""
    offsets = (np.r_[0, ends] * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _rows(number: int, length: int, values: dict) -> Iterator[pa.RecordBatch]:
    """Rows of a block with these columns, in batches of about ``BATCH_BYTES``."""
    columns = {"block": pa.repeat(pa.scalar(number, pa.int64()), length)}
    for name, kind in map(str.split, (*_PAIR, *_TEXT)):
        columns[name] = pa.array(values[name], _KINDS[kind]) if name in values else pa.nulls(length, _KINDS[kind])
    batch = pa.RecordBatch.from_pydict(columns)
    step = max(1, length * BATCH_BYTES // max(1, batch.nbytes))
    for first in range(0, length, step):
        yield batch.slice(first, step)


def _blocks(path_a: str, path_b: str):
    def block_of(number: int, ids: list, sha: list, counts: list, links: list) -> Iterator[pa.RecordBatch]:
        table = pa.concat_tables(links).combine_chunks()
        held = table.group_by("key").aggregate([([], "count_all")]).sort_by("key")
        keys = held.column("key").to_numpy()
        yield from _rows(number, len(keys), {"key": keys, "holders": held.column("count_all").to_numpy()})
        del held
        row, key, times = (table.column(c).to_numpy() for c in ("row", "key", "times"))
        order = np.argsort(row, kind="stable")
        ends = np.cumsum(np.bincount(row, minlength=len(ids)))
        values = {"doc_id": ids, "sha": sha, **{c: np.concatenate([x[c] for x in counts]) for c in _COUNTS}}
        values["links"] = _packed(np.searchsorted(keys, key).astype(np.uint32)[order], ends)
        values["times"] = _packed(times[order], ends)
        yield from _rows(number, len(ids), values)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = _load(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        ids, sha, counts, links, size = [], [], [], [], 0
        for own, texts in _slices(batches):
            found = Aligned(texts, *sides)
            sha += [hashlib.sha256(t.encode()).hexdigest() if n else "" for t, n in zip(found.texts(), found.n_a, strict=True)]
            links.append(found.links.set_column(0, "row", pc.add(found.links.column("row"), len(ids))))
            counts.append({c: getattr(found, c) for c in _COUNTS})
            ids += own
            size += sum(map(len, filter(None, texts)))
            del found
            if size >= BLOCK_BYTES:
                yield from block_of(number, ids, sha, counts, links)
                ids, sha, counts, links, size, number = [], [], [], [], 0, number + 1
        if ids:
            yield from block_of(number, ids, sha, counts, links)

    return blocks


def aligned_blocks(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Blocks of texts, stored: their different links with the number of texts that hold each, and per
    text what is counted in it and its links as places in that list."""
    small_batches(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return landed(rows.mapInArrow(_blocks(path_a, path_b), _BLOCK), "blocks", **{"parquet.block.size": ROW_GROUP_BYTES})


def _block_links(blocks: DataFrame) -> DataFrame:
    return blocks.filter(F.col("key").isNotNull()).select("block", "key", "holders")


def link_counts(blocks: DataFrame) -> DataFrame:
    """(key, a, b, documents, best) of every pair of linked ids.

    ``documents`` is the number of texts in which the pair is linked; ``best`` says that no other id
    of b is linked to a in more of them. There are at most as many different a as ids.
    """
    counts = _block_links(blocks).groupBy("key").agg(F.sum("holders").alias("documents"))
    counts = landed(
        counts.select(
            "key", F.shiftright("key", 32).cast("int").alias("a"), F.col("key").bitwiseAND(0xFFFFFFFF).cast("int").alias("b"), "documents"
        ),
        "links",
    )
    most = counts.groupBy("a").agg(F.max("documents").alias("most"))
    return counts.join(F.broadcast(most), "a").select("key", "a", "b", "documents", (F.col("documents") == F.col("most")).alias("best"))


_SCORED = "doc_id long, " + ", ".join(f"{c} long" for c in (*_COUNTS, "n_best", "count_sum")) + ", groups_sha256 string"


def _score(known: pa.Table, rows: pa.Table) -> pa.Table:
    """Texts of a block with its links' counts; ``known`` has every link of the block."""
    order = np.argsort(known.column("key").to_numpy())
    documents, best = (known.column(c).to_numpy()[order] for c in ("documents", "best"))
    links, times = (np.frombuffer(b"".join(rows.column(c).to_pylist()), kind) for c, kind in (("links", np.uint32), ("times", np.int64)))
    ends = np.cumsum(pc.binary_length(rows.column("times")).to_numpy(), dtype=np.int64) // times.itemsize
    starts = np.r_[0, ends[:-1]]
    sums = [np.r_[0, np.cumsum(times * v[links])] for v in (best, documents)]
    columns = [*(rows.column(c) for c in ("doc_id", *_COUNTS)), *(pa.array(s[ends] - s[starts]) for s in sums), rows.column("sha")]
    return pa.table(columns, names=["doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256"])


def alignment_scores(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row.

    a is a byte-level tokenizer that reads a space and the text, b a SentencePiece model that adds
    the space itself; neither adds special tokens, and their names in a text are plain text. Texts
    that are null or empty, or that either tokenizer does not give back byte by byte, have no
    tokens: zeros and an empty digest. ``n_best`` counts links whose pair is the best of its id of a,
    ties included; ``count_sum`` adds up the documents of every link's pair. Repeated rows are
    documents of their own; null ids stay; other columns are left out; an empty table gives no rows.
    A text needs memory in proportion to its length.
    """
    blocks = aligned_blocks(documents, path_a, path_b)
    counts = link_counts(blocks).select("key", "documents", F.col("best").cast("long").alias("best"))
    known = _block_links(blocks).select("block", "key").join(counts, "key")
    rows = blocks.filter(F.col("key").isNull()).drop("key", "holders").withColumnRenamed("block", "own")
    # A block has a bounded number of texts and links, so Python gets it whole.
    return known.groupBy("block").cogroup(rows.groupBy("own")).applyInArrow(_score, _SCORED)


def aligned_texts(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id and groups of every row: ``a1,a2|b1;a3|b2,b3``, empty for a text without tokens."""

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _slices(batches):
            found = Aligned(texts, *_load(path_a, path_b)).texts()
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.string())], names=["doc_id", "groups"])

    small_batches(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(groups, "doc_id long, groups string")
