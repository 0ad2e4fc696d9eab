"""Removal of lines that many documents share, with two Bloom filters.

Texts are read once for the digests of their line keys, which are stored: 16 bytes a line. Every
task enters its digests in two filters, one of digests seen and one of digests seen again; merging
tasks, a digest is also seen again if both had seen it. A line found in several documents is always
in the second filter, so only digests that this filter holds are shuffled, counted exactly, and
joined back to the documents that lose them. A third filter, of these documents, keeps all other
texts out of the last join.

Filters grow with the number of lines up to ``MOST_BITS``. A fuller filter lets more digests be
shuffled and counted; results never depend on it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from rollcall.llm.common import landed, small_batches

#: Code points from which on a key counts, and documents in which it has to occur.
KEY_LENGTH, DOCUMENTS = 20, 3
#: What is stripped around a line.
BLANK = " \t\n\r\x0b\x0c"
#: Bytes of a digest; its first eight are what the filters see.
DIGEST = 16
BITS_PER_ENTRY, LEAST_BITS, MOST_BITS, PROBES = 16, 1 << 16, 1 << 28, 3
#: Bytes of the pieces in which filters are merged.
SEGMENT = 1 << 15
#: Rows of texts handled at once, and hashes entered in a filter or looked up at once.
SLICE, HASHES = 500, 1 << 16


def line_key(line: str, least: int = KEY_LENGTH) -> bytes | None:
    """A line without blanks around it and with A-Z in lower case, or None if it is too short."""
    core = line.strip(BLANK)
    return core.encode().lower() if len(core) >= least else None


def key_digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=DIGEST).digest()


class BloomPair:
    """Entries seen once or more, and entries seen twice or more, with no false negatives."""

    def __init__(self, bits: int) -> None:
        self.bits = bits
        self.once, self.twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        for start in range(0, len(hashes), HASHES):
            values, counts = np.unique(hashes[start : start + HASHES], return_counts=True)
            again = holds(self.once, values) | (counts > 1)
            _enter(self.twice, values[again])
            _enter(self.once, values)

    def segments(self) -> Iterator[pa.RecordBatch]:
        """(segment, once, twice) of the pieces in which something is set."""
        for at in range(0, len(self.once), SEGMENT):
            once = self.once[at : at + SEGMENT]
            if once.any():
                rows = [[at // SEGMENT], [once.tobytes()], [self.twice[at : at + SEGMENT].tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, _KINDS, strict=True)], names=_NAMES)


_KINDS, _NAMES = (pa.int64(), pa.binary(), pa.binary()), ["segment", "once", "twice"]


def _places(bits: int, hashes: np.ndarray) -> np.ndarray:
    low, step = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32) | np.uint64(1)
    return (low[:, None] + step[:, None] * np.arange(PROBES, dtype=np.uint64)) & np.uint64(bits - 1)


def _enter(filter_: np.ndarray, hashes: np.ndarray) -> None:
    at = _places(len(filter_) * 8, hashes).ravel()
    np.bitwise_or.at(filter_, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))


def holds(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether a filter may hold each hash."""
    found = np.empty(len(hashes), bool)
    for start in range(0, len(hashes), HASHES):
        at = _places(len(filter_) * 8, hashes[start : start + HASHES])
        found[start : start + HASHES] = (filter_[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).all(axis=1)
    return found


def filter_bits(entries: int, most: int = MOST_BITS) -> int:
    """A power of two with ``BITS_PER_ENTRY`` bits an entry, within the bounds."""
    return min(most, max(LEAST_BITS, 1 << (BITS_PER_ENTRY * max(1, entries) - 1).bit_length()))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of equal segments, which follow one another, as one."""
    at, once, twice = None, None, None

    def out() -> pa.RecordBatch:
        rows = [[at], [once.tobytes()], [twice.tobytes()]]
        return pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, _KINDS, strict=True)], names=_NAMES)

    for batch in batches:
        for row in batch.to_pylist():
            one, two = (np.frombuffer(row[name], np.uint8) for name in ("once", "twice"))
            if row["segment"] == at:
                twice |= two | once & one
                once |= one
            else:
                if at is not None:
                    yield out()
                at, once, twice = row["segment"], one.copy(), two.copy()
    if at is not None:
        yield out()


def _few_tasks(rows: DataFrame) -> int:
    """Tasks for narrow rows: some for each core, whatever the number of files or shuffle partitions."""
    return 4 * rows.sparkSession.sparkContext.defaultParallelism


def bloom_filter(rows: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], bits: int, kind: str) -> np.ndarray:
    """The filter ``kind`` (once or twice) of the hashes in ``rows``, of at most ``MOST_BITS`` bits.

    Few tasks fill filters, so that what is merged does not grow with the number of files. All its
    pieces come to the driver in one job, not in one for each partition.
    """

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = BloomPair(bits)
        for batch in batches:
            pair.add(hashes(batch))
        yield from pair.segments()

    schema = "segment long, once binary, twice binary"
    filled = rows.coalesce(_few_tasks(rows)).mapInArrow(fill, schema)
    merged = filled.repartition("segment").sortWithinPartitions("segment").mapInArrow(_merge, schema)
    found = np.zeros(bits // 8, np.uint8)
    for row in merged.select("segment", kind).collect():
        found[row[0] * SEGMENT : (row[0] + 1) * SEGMENT] = np.frombuffer(row[1], np.uint8)
    return found


def _digests(least: int):
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(doc_id, spot, text) to (doc_id, spot, digests): the different keys of a text."""
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                found = []
                for text in part.column(2).to_pylist():
                    keys = {line_key(line, least) for line in text.split("\n")} if text else set()
                    found.append(b"".join(key_digest(k) for k in keys if k is not None))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(found, pa.binary())], names=["doc_id", "spot", "digests"]
                )

    return digests


def _digest_hashes(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("digests").to_pylist()), "<u8")[::2]


def _spot_hashes(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("spot").to_numpy().view(np.uint64)


def _suspects(filter_):
    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(doc_id, spot, digests) to one row per digest that the filter may hold."""
        for batch in batches:
            rows = np.repeat(np.arange(batch.num_rows), [len(d) // DIGEST for d in batch.column("digests").to_pylist()])
            keep = np.flatnonzero(holds(filter_.value, _digest_hashes(batch)))
            digests = np.frombuffer(b"".join(batch.column("digests").to_pylist()), f"V{DIGEST}")[keep]
            doc_id, spot = (batch.column(i).take(pa.array(rows[keep])) for i in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [doc_id, spot, pa.array([bytes(d) for d in digests], pa.binary())], names=["doc_id", "spot", "key"]
            )

    return suspects


def _without(least: int):
    def without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(doc_id, text, keys) to the text without the lines whose digest is among the keys."""
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                lines_, dropped, kept = [], [], []
                for text, keys in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    lines, gone = (text or "").split("\n"), set(keys or ())
                    stay = [x for x in lines if not gone or (k := line_key(x, least)) is None or key_digest(k) not in gone]
                    lines_.append(len(lines))
                    dropped.append(len(lines) - len(stay))
                    kept.append("\n".join(stay))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lines_, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())],
                    names=["doc_id", "n_lines", "n_dropped", "text"],
                )

    return without


def _same_row(a: str, b: str) -> Column:
    return (F.col(f"{a}.spot") == F.col(f"{b}.spot")) & F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id"))


def repeated_lines(keys: DataFrame, bits: int, documents: int = DOCUMENTS) -> tuple[DataFrame, DataFrame]:
    """(suspects, confirmed) of stored (doc_id, spot, digests).

    Suspects are (doc_id, spot, key) of the digests seen twice; confirmed are (key, keep) of those
    that occur in at least ``documents`` documents, with the largest doc_id that holds them.
    """
    context = keys.sparkSession.sparkContext
    seen_twice = context.broadcast(bloom_filter(keys, _digest_hashes, bits, "twice"))
    suspects = landed(keys.mapInArrow(_suspects(seen_twice), "doc_id long, spot long, key binary"), "suspects")
    # Distinct ids are counted after a shuffle by key and id, so that no key is held by one task.
    holders = F.count_distinct("doc_id") + F.max(F.col("doc_id").isNull().cast("long"))
    counted = suspects.groupBy("key").agg(holders.alias("holders"), F.max("doc_id").alias("keep"))
    return suspects, counted.filter(F.col("holders") >= documents).select("key", "keep")


def deduplicated_lines(
    documents: DataFrame, least: int = KEY_LENGTH, copies: int = DOCUMENTS, most_bits: int = MOST_BITS
) -> DataFrame:
    """doc_id, n_lines, n_dropped and text of every row, without lines that other documents keep.

    A line's key is the line without blanks around it and with A-Z in lower case. Keys of at least
    ``least`` code points that at least ``copies`` documents hold lose all their lines, except in the
    document with the largest doc_id among them, which keeps all of its own. Documents are told
    apart by doc_id: repeated rows are one document and keep or lose a line together, and null ids
    are one document that comes before all others. Null and empty texts are one empty line and
    become an empty text. Other columns are left out; an empty table gives no rows.
    """
    small_batches(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn(
        "spot", F.xxhash64("doc_id", "text")
    )
    digests = rows.filter(F.length("text") >= least).select("doc_id", "spot", "text")
    keys = landed(digests.mapInArrow(_digests(least), "doc_id long, spot long, digests binary"), "keys")
    entries = keys.agg(F.sum(F.octet_length("digests")).alias("n")).first()["n"] or 0
    suspects, confirmed = repeated_lines(keys, filter_bits(entries // DIGEST, most_bits), copies)
    # A text's keys are as many as its lines at most; hot keys are split by the join's skew handling.
    lost = suspects.join(confirmed, "key").filter(~F.col("doc_id").eqNullSafe(F.col("keep")))
    lost = lost.groupBy("doc_id", "spot").agg(F.collect_set("key").alias("keys"))
    lost = landed(lost.coalesce(_few_tasks(lost)), "lost")
    spots = bloom_filter(lost, _spot_hashes, filter_bits(lost.count(), most_bits), "once")
    losing = rows.sparkSession.sparkContext.broadcast(spots)

    @F.pandas_udf(BooleanType())
    def may_lose(spot):
        return type(spot)(holds(losing.value, spot.to_numpy().view(np.uint64)))

    marked = rows.withColumn("losing", may_lose("spot"))
    whole = marked.filter(~F.col("losing")).select(
        "doc_id",
        F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long").alias("n_lines"),
        F.lit(0).cast("long").alias("n_dropped"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    met = marked.filter("losing").alias("a").join(lost.alias("b"), _same_row("a", "b"), "left")
    cut = met.select("a.doc_id", "a.text", "b.keys").mapInArrow(
        _without(least), "doc_id long, n_lines long, n_dropped long, text string"
    )
    return whole.unionByName(cut)


def line_digests(documents: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256, the SHA-256 of what is left of each text."""
    kept = F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    return deduplicated_lines(documents).select("doc_id", "n_lines", "n_dropped", kept)
