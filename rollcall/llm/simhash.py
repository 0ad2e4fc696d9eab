"""SimHash near-duplicates by fuzzy hashing with the binary Golay code.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits, each padded to a word of 23
bits. The perfect Golay code [23, 12, 7] decodes any word to one codeword, named by 12 bits.
The keys of a segment are the codewords that the word and all words one bit away decode to: one or
six of them. Two segments at most two bits apart share a key, because a word halfway between them
is next to both. If two fingerprints differ in at most five bits, at most one segment has three or
more of them, so the other two share a key each. Hence a key is the codewords of two segments,
and all fingerprints within five bits meet in a group. Groups are compared exactly.

Equal fingerprints are folded first. A group yields links that connect it: larger groups are
searched breadth first, so that only what is not yet connected is compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructType

from rollcall.llm.common import free_name, landed, shuffles_freed, texts
from rollcall.llm.components import components
from rollcall.storage import materialize

#: Bits and first bit of each segment.
SEGMENTS = ((22, 0), (21, 22), (21, 43))
#: Fingerprints further apart than this can miss each other.
MOST_BITS = 5
#: Hashes unpacked at once, which bounds memory for very long texts.
BLOCK = 1 << 15
#: Groups up to this size are compared by shifting columns, larger ones by breadth-first search.
SHIFTS = 64
#: Bins of a sketch, a power of two.
SKETCH_BITS = 9
SKETCH = 1 << SKETCH_BITS
#: Sketches that estimate less than the similarity by this are clear misses: eight standard errors.
MARGIN = 0.15
#: Sketches with fewer bins in use tell too little.
FILLED = 64
#: Texts of a group that are compared in one task, and the bytes of their sketches and shingles.
CHUNK, CHUNK_BYTES = 50_000, 64 << 20
#: Rows of whole groups that are linked at once; larger ones count once per ROW bytes.
LINKED, ROW = 10_000, 4_096
#: MinHashes of a text's five-word shingles: so many bands of so many. A pair at a similarity of 0.8
#: shares none with a probability of (1 - 0.8 ** BAND) ** BANDS, which is 5e-7.
BANDS, BAND = 48, 6
#: Bands whose keys connect texts at once. The first ones leave little for the others to connect.
BATCHES = (4, 12, 32)
#: Shingles whose MinHashes are computed at once.
MIXED = 256
GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1


def _remainders(words: np.ndarray) -> np.ndarray:
    """Words of 23 bits modulo the generator polynomial."""
    words = words.copy()
    for bit in range(22, 10, -1):
        words ^= np.where(words >> bit & 1, GENERATOR << (bit - 11), 0)
    return words


def _correction() -> np.ndarray:
    """For every remainder, the only error of at most three bits that leaves it."""
    errors = [sum(1 << b for b in bits) for k in range(4) for bits in combinations(range(23), k)]
    table = np.zeros(2048, dtype=np.int64)
    table[_remainders(np.array(errors, dtype=np.int64))] = errors
    return table


_ERRORS = _correction()
_LOW = _remainders(np.arange(1 << 12, dtype=np.int64))
_HIGH = _remainders(np.arange(1 << 11, dtype=np.int64) << 12)


def decode(words: np.ndarray) -> np.ndarray:
    """The 12-bit index of the codeword within three bits of each 23-bit word."""
    words = words.astype(np.int64)
    return (words ^ _ERRORS[_LOW[words & 0xFFF] ^ _HIGH[words >> 12]]) >> 11


def segment_keys(words: np.ndarray, bits: int) -> np.ndarray:
    """Codeword indices next to each word, six columns, -1 where there are fewer."""
    flips = np.array([0, *(1 << b for b in range(bits))], dtype=np.int64)
    near = np.sort(decode(words.astype(np.int64)[:, None] ^ flips), axis=1)
    new = np.ones(near.shape, dtype=bool)
    new[:, 1:] = near[:, 1:] != near[:, :-1]
    keys = np.full((len(words), 6), -1, dtype=np.int64)
    row, _ = np.nonzero(new)
    keys[row, (np.cumsum(new, axis=1) - 1)[new]] = near[new]
    return keys


def fingerprint_keys(values: np.ndarray, number: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of fingerprints as unsigned longs; ``number`` tells several kinds apart."""
    codes = [segment_keys((values >> np.uint64(at)) & np.uint64((1 << n) - 1), n) for n, at in SEGMENTS]
    rows, keys = [], []
    for pair, (a, b) in enumerate(combinations(codes, 2)):
        both = (a[:, :, None] << 12 | b[:, None, :]).reshape(len(values), 36)
        valid = ((a >= 0)[:, :, None] & (b >= 0)[:, None, :]).reshape(len(values), 36)
        row, column = np.nonzero(valid)
        rows.append(row)
        keys.append(both[row, column] | (3 * number + pair) << 24)
    return np.concatenate(rows), np.concatenate(keys)


def majority(hashes: Iterator[np.ndarray], width: int) -> np.ndarray:
    """Bits set in over half of the hashes; a block is an array (n, width / 64) of unsigned longs."""
    total, counts = 0, np.zeros(width, dtype=np.int64)
    for block in hashes:
        total += len(block)
        bits = np.unpackbits(block.view(np.uint8).reshape(len(block), -1), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return np.packbits((2 * counts > total).astype(np.uint8), bitorder="little").view(np.uint64)


def shingle_fingerprint(text: str | None, size: int = 3) -> int:
    """SimHash of a text's word shingles by XXH64, seed 42; no words: 0; fewer words: one shingle."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words]).tolist()
    ends = (ends - 1).tolist()
    size = min(size, len(words))
    spans = list(zip(starts[: len(words) - size + 1], ends[size - 1 :], strict=True))
    hash64 = xxhash.xxh64_intdigest

    def blocks():
        for at in range(0, len(spans), BLOCK):
            block = [hash64(joined[a:b], 42) for a, b in spans[at : at + BLOCK]]
            yield np.array(block, dtype=np.uint64)[:, None]

    return int(majority(blocks(), 64)[0])


def word_fingerprints(words: list[bytes], kinds: int = 4) -> list[int]:
    """``kinds`` (even) independent SimHashes of a text's different words; no words: zeros."""
    words = list(set(words))
    if not words:
        return [0] * kinds
    hash128 = xxhash.xxh3_128_digest

    def blocks():
        for at in range(0, len(words), BLOCK):
            part = words[at : at + BLOCK]
            digests = b"".join(hash128(w, seed) for w in part for seed in range(kinds // 2))
            yield np.frombuffer(digests, dtype=np.uint64).reshape(len(part), kinds)

    return majority(blocks(), 64 * kinds).tolist()


def shingle_hashes(words: list[bytes], size: int = 5) -> np.ndarray:
    """Hashes of a text's different word shingles in order; fewer words: one shingle; no words: none."""
    shingles = zip(*(words[i:] for i in range(min(size, len(words)))), strict=False)
    return np.unique(np.fromiter((xxhash.xxh3_64_intdigest(b" ".join(s)) for s in shingles), dtype=np.uint64))


_MIX = np.random.default_rng(17).integers(0, 1 << 31, (2, BANDS * BAND), dtype=np.uint32) << np.uint32(1) | np.uint32(1)
_JOIN = np.random.default_rng(18).integers(0, 1 << 63, BANDS * BAND, dtype=np.uint64) << np.uint64(1) | np.uint64(1)


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A key per band of MinHashes; two sets share a MinHash with the probability of their similarity."""
    least = np.full(BANDS * BAND, np.iinfo(np.uint32).max, dtype=np.uint32)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), MIXED):
        np.minimum(least, (short[at : at + MIXED, None] * _MIX[0] + _MIX[1]).min(axis=0), out=least)
    return (least * _JOIN).reshape(BANDS, BAND).sum(axis=1, dtype=np.uint64)


def shingle_sketch(words: list[bytes], size: int = 5) -> bytes:
    """As ``hash_sketch`` of the word shingles."""
    return hash_sketch(shingle_hashes(words, size))


def hash_sketch(hashes: np.ndarray) -> bytes:
    """MinHash by one permutation: a byte, never 0, of the smallest hash in each of SKETCH bins."""
    sketch = np.zeros(SKETCH, dtype=np.uint8)
    bins = hashes >> np.uint64(64 - SKETCH_BITS)
    least = hashes[np.diff(bins, prepend=bins[:1] + np.uint64(1)) != 0]
    sketch[least >> np.uint64(64 - SKETCH_BITS)] = least % np.uint64(255) + np.uint64(1)
    return sketch.tobytes()


SIGNATURE = (
    StructType()
    .add("prints", ArrayType(LongType()))
    .add("bands", ArrayType(LongType()))
    .add("sketch", BinaryType())
    .add("node", LongType())
)


def _signed(values: list) -> np.ndarray:
    return np.array(values, dtype=np.uint64).view(np.int64)


@F.pandas_udf(LongType())
def _shingle_column(text: pd.Series) -> pd.Series:
    return pd.Series(_signed([shingle_fingerprint(t) for t in text]), dtype="int64")


@F.pandas_udf(BinaryType())
def _shingles(text: pd.Series) -> pd.Series:
    return pd.Series([shingle_hashes(t.encode().lower().split() if t else []).tobytes() for t in text], dtype="object")


@F.pandas_udf(SIGNATURE)
def _signature(text: pd.Series) -> pd.DataFrame:
    prints, bands, sketches, nodes = [], [], [], []
    for one in text:
        words = one.encode().lower().split() if one else []
        prints.append(_signed(word_fingerprints(words)))
        hashes = shingle_hashes(words)
        bands.append(band_keys(hashes).view(np.int64))
        sketches.append(hash_sketch(hashes))
        nodes.append(xxhash.xxh3_64_intdigest(b" ".join(words)))
    prints, bands, sketches = (pd.Series(x, dtype="object") for x in (prints, bands, sketches))
    return pd.DataFrame({"prints": prints, "bands": bands, "sketch": sketches, "node": _signed(nodes)})


def _write_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, prints) to one row per key: key, fingerprint, node."""
    for batch in batches:
        nodes = batch.column("node").to_numpy()
        prints = batch.column("prints")
        kinds = len(prints.flatten()) // max(1, len(nodes))
        table = prints.flatten().to_numpy().astype(np.int64).reshape(len(nodes), kinds)
        for at in range(0, len(nodes), 1000):
            for kind in range(kinds):
                values = table[at : at + 1000, kind]
                row, keys = fingerprint_keys(values.view(np.uint64), kind)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(values[row]), pa.array(nodes[at : at + 1000][row])],
                    names=["key", "print", "node"],
                )


def within_bits(radius: int):
    """Tells which fingerprints lie within ``radius`` bits of each other."""
    return lambda a, b: np.bitwise_count(a ^ b)[:, 0] <= radius


def alike(least: float):
    """Tells which sketches estimate a similarity of ``least`` or more."""

    def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        filled = ((a | b) != 0).sum(axis=1)
        return ((a == b) & (a != 0)).sum(axis=1) >= least * filled

    return near


def similar(least: float):
    """Tells which sets of shingles have a similarity of ``least`` or more, by the sets themselves.

    Sketches only tell clear misses.
    """
    rough = alike(least - MARGIN)

    def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        one, two = a["sketch"], b["sketch"]
        hit = rough(one, two) | (((one | two) != 0).sum(axis=1) < FILLED)
        for i in np.flatnonzero(hit):
            hit[i] = similarity_of(a["shingles"][i], b["shingles"][i if len(b) > 1 else 0]) >= least
        return hit

    return near


def similarity_of(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of hashes in order; two empty ones are alike."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if both else float(not len(a) + len(b))


def group_stars(values: np.ndarray, near) -> np.ndarray:
    """For each row the index of the first one that it reaches by steps that are ``near``."""
    first = np.arange(len(values))
    rest = first.copy()
    while rest.size:
        root, rest = rest[0], rest[1:]
        open_ = [root]
        while open_ and rest.size:
            at = open_.pop()
            hit = near(values[rest], values[at : at + 1])
            if hit.any():
                first[rest[hit]] = root
                open_.extend(rest[hit])
                rest = rest[~hit]
    return first


def _first_reached(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n rows the first row it reaches by the pairs (a, b)."""
    first = np.arange(n)
    while True:
        low = np.minimum(first[a], first[b])
        new = first.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == first).all():
            return first
        first = new


def group_links(key: np.ndarray, values: np.ndarray, nodes: np.ndarray, near) -> np.ndarray:
    """Links (n, 2) of whole groups of equal keys that lie one after the other.

    What is connected in a group is linked to its first row. With groups in the order of nodes
    that is the smallest node, mostly the same in many groups, so that links repeat and fold.
    """
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[starts, len(key)])
    small = np.repeat(sizes <= SHIFTS, sizes)
    at, pairs, links = np.flatnonzero(small), [], [np.empty((0, 2), dtype=np.int64)]
    for shift in range(1, SHIFTS):
        at = at[at + shift < len(key)]
        at = at[key[at] == key[at + shift]]
        if not at.size:
            break
        hit = at[near(values[at], values[at + shift])]
        pairs.append(np.stack([hit, hit + shift]))
    if pairs:
        first = _first_reached(len(key), *np.concatenate(pairs, axis=1))
        moved = np.flatnonzero(first != np.arange(len(key)))
        links.append(np.stack([nodes[first[moved]], nodes[moved]], axis=1))
    for start, size in zip(starts[sizes > SHIFTS], sizes[sizes > SHIFTS], strict=True):
        first = group_stars(values[start : start + size], near)
        moved = np.flatnonzero(first != np.arange(size))
        links.append(np.stack([nodes[start + first[moved]], nodes[start + moved]], axis=1))
    links = np.sort(np.concatenate(links), axis=1)
    return np.unique(links[links[:, 0] != links[:, 1]], axis=0)


def _link_groups(near, unpack):
    """Reads (key, value, node) in the order of key; a group may span batches."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        waiting = 0

        def linked(upto: int | None) -> pa.RecordBatch | None:
            key, values, nodes = (np.concatenate(x) for x in zip(*held, strict=True))
            cut = len(key) if upto is None else int(np.searchsorted(key, upto))
            held[:] = [(key[cut:], values[cut:], nodes[cut:])]
            if not cut:
                return None
            pairs = group_links(key[:cut], values[:cut], nodes[:cut], near)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, i].copy()) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            if batch.num_rows:
                key = batch.column(0).to_numpy()
                held.append((key, unpack(batch.column(1)), batch.column(2).to_numpy()))
                waiting += max(len(key), batch.nbytes // ROW)
                if waiting >= LINKED and held[0][0][:1] != key[-1]:
                    waiting = 0
                    if out := linked(key[-1]):
                        yield out
        if held and (out := linked(None)):
            yield out

    return links


def _longs(column: pa.Array) -> np.ndarray:
    return column.to_numpy().view(np.uint64)[:, None]


_SETS = np.dtype([("sketch", np.uint8, SKETCH), ("shingles", object)])


def _sets(column: pa.Array) -> np.ndarray:
    """Sketches and shingles of structs (sketch, shingles)."""
    out = np.empty(len(column), dtype=_SETS)
    sketch, shingles = column.flatten()
    out["sketch"] = np.frombuffer(b"".join(sketch.to_pylist()), dtype=np.uint8).reshape(-1, SKETCH)
    for i, one in enumerate(shingles.to_pylist()):
        out["shingles"][i] = np.frombuffer(one, dtype=np.uint64)
    return out


def fingerprint_links(prints: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) that connect all nodes whose fingerprints of one kind are within ``radius``.

    ``prints`` has node (long) and prints (array of longs, as many in each row, no nulls), every
    node once. The links connect what all pairs would connect; pairs may be missing among them.
    """
    if radius > MOST_BITS:
        raise ValueError(f"at most {MOST_BITS} bits")
    keys = prints.select("node", "prints").mapInArrow(_write_keys, "key long, print long, node long")
    grouped = keys.repartition("key").sortWithinPartitions("key", "node")
    return grouped.mapInArrow(_link_groups(within_bits(radius), _longs), "a long, b long").distinct()


def band_links(nodes: DataFrame) -> DataFrame:
    """Links (a, b) that connect all nodes (node, bands) that share a key of a band."""
    keys = nodes.select("node", F.explode("bands").alias("key"))
    groups = keys.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("last")).filter("a < last")
    return keys.join(groups.select("key", "a"), "key").filter("a < node").select("a", F.col("node").alias("b")).distinct()


def _contracted(placed: DataFrame, links: DataFrame) -> DataFrame:
    """``placed`` (node, root) after its roots are joined by ``links``."""
    found = components(links).select(F.col("node").alias("root"), F.col("root").alias("joined"))
    return landed(placed.join(found, "root", "left").select("node", F.coalesce("joined", "root").alias("root")), "placed")


def _write_kind_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, print, root) to one row per key: key, print, node."""
    for batch in batches:
        kinds, values, roots = (batch.column(i).to_numpy() for i in range(3))
        for kind in np.unique(kinds):
            rows = np.flatnonzero(kinds == kind)
            for at in range(0, len(rows), 1000):
                some = rows[at : at + 1000]
                row, keys = fingerprint_keys(values[some].view(np.uint64), int(kind))
                columns = (keys, values[some][row], roots[some][row])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "print", "node"])


def candidate_groups(nodes: DataFrame) -> DataFrame:
    """(node, root) of the nodes (node, prints, bands) that candidates connect with others.

    Candidates share a band, or their fingerprints of one kind are within ``MOST_BITS``. Keys are
    taken in batches, equal fingerprints with the first. After each, nodes are replaced by the
    root of their component, so a large group of near copies is nearly one node from the first
    batch on, and its many other keys give no more links. At the end a fingerprint has one root.
    """
    placed, at = nodes.select("node", F.col("node").alias("root")), 0
    for size in BATCHES:
        keys = F.slice("bands", at + 1, size)
        if not at:
            keys = F.concat(keys, F.transform("prints", lambda value, kind: F.xxhash64(kind, value)))
        rows = nodes.select("node", keys.alias("bands")).join(placed, "node").select(F.col("root").alias("node"), "bands")
        placed = _contracted(placed, band_links(rows))
        at += size
    kinds = nodes.select("node", F.posexplode("prints").alias("kind", "print")).join(placed, "node")
    prints = kinds.groupBy("kind", "print").agg(F.min("root").alias("root"))
    keyed = prints.mapInArrow(_write_kind_keys, "key long, print long, node long").repartition("key").sortWithinPartitions("key", "node")
    links = keyed.mapInArrow(_link_groups(within_bits(MOST_BITS), _longs), "a long, b long").distinct()
    moved = _contracted(placed, links).filter("node <> root")
    return moved.unionByName(moved.select(F.col("root").alias("node"), "root").distinct())


def simhash_components(documents: DataFrame, radius: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    Documents link if their fingerprints of 3-word shingles differ in at most ``radius`` bits;
    component_id is the smallest doc_id reachable. Null, empty and blank texts have fingerprint
    zero. Null ids take part and are no component's smallest id unless all are null. Repeated rows
    and ids stay separate rows. Extra columns are ignored; an empty table gives no rows.
    """
    rows = materialize(texts(documents).select("doc_id", _shingle_column("text").alias("print")))
    nodes = rows.groupBy("print").agg(F.min("doc_id").alias("least"))
    links = fingerprint_links(nodes.select(F.col("print").alias("node"), F.array("print").alias("prints")), radius)
    roots = components(links)
    lowest = _component_minimum(nodes, roots, "print")
    # Stored, so that the last join has an exchange on both sides and Spark can split hot prints.
    placed = materialize(
        nodes.join(lowest, "print", "left").select("print", F.coalesce("component_least", "least").alias("component_id"))
    )
    fingerprint = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    return rows.join(placed, "print").select("doc_id", fingerprint, "component_id")


def _component_minimum(nodes: DataFrame, roots: DataFrame, node: str) -> DataFrame:
    """(node, component_least) of the nodes that have a link."""
    known = nodes.join(roots.withColumnRenamed("node", node), node)
    least = known.groupBy("root").agg(F.min("least").alias("component_least"))
    return roots.withColumnRenamed("node", node).join(least, "root").select(node, "component_least")


def near_copies_removed(documents: DataFrame, similarity: float = 0.8) -> DataFrame:
    """The documents without near copies: of each group the row with the smallest doc_id stays.

    Candidates are texts that share a band of MinHashes of their five-word shingles, which finds
    pairs by their similarity alone, whatever the edit, and texts of which one of four SimHashes of
    their different words differs in at most five bits. In the
    groups that candidates connect, texts are linked if the similarity of their whole sets of
    shingles is ``similarity`` or more. Sketches, with a standard error of 0.018 at most, only leave
    out pairs that are ``MARGIN`` below it. Groups are closed under links.

    Case is ignored, as is the space between words. Texts with fewer than five words are one
    shingle; null, empty and blank texts are copies of each other. Of rows that tie on doc_id the
    one with the smallest hash of its text stays, of equal rows one. A null id stays only if no
    row of its group has one. All columns are returned as they came.
    """
    repeated = not documents.groupBy("doc_id").count().filter("count > 1").isEmpty()
    with shuffles_freed(documents.sparkSession):
        nodes, roots = _near_groups(documents, similarity, repeated)
    placed = nodes.select("node", "best").join(roots, "node", "left").select(F.coalesce("root", "node").alias("root"), "best")
    stay = placed.groupBy("root").agg(F.min("best").alias("best")).select("best.doc_id", "best.text_hash")
    return _rows_of(documents, stay, repeated)


def _near_groups(documents: DataFrame, similarity: float, repeated: bool) -> tuple[DataFrame, DataFrame]:
    """Stored (node, best) of the different texts, and (node, root) of those that have near copies."""
    signed = texts(documents).select(_order().alias("order"), _signature("text").alias("s"))
    texts_ = signed.select("order", "s.*").groupBy("node").agg(
        F.first("prints").alias("prints"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"), F.min("order").alias("best")
    )
    # Short ids, fixed by storing them, stand for texts in what is shuffled most.
    nodes = landed(texts_.drop("node").withColumn("node", F.monotonically_increasing_id()), "signatures")
    near = candidate_groups(nodes)
    members = nodes.select("node", "sketch", "best.doc_id", "best.text_hash").join(near, "node")
    # Stored, so that sets are made once.
    groups = _grid(landed(_with_shingles(texts(documents), members, repeated), "shingles"))
    linked = _link_groups(similar(similarity), _sets)
    links = groups.repartition("key").sortWithinPartitions("key", "node").mapInArrow(linked, "a long, b long")
    return nodes, components(links)


def _with_shingles(documents: DataFrame, members: DataFrame, repeated: bool) -> DataFrame:
    """(node, root, value) of ``members``: sketch and shingles, made of the text of a row of the node."""
    own = documents.select(F.col("doc_id").alias("own_id"), F.xxhash64("text").alias("own_hash"), "text")
    same = F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_hash") == F.col("text_hash"))
    found = own.join(members, same)
    found = found.dropDuplicates(["node"]) if repeated else found
    return found.select("node", "root", F.struct("sketch", _shingles("text").alias("shingles")).alias("value"))


def _grid(members: DataFrame) -> DataFrame:
    """(key, value, node): groups over CHUNK nodes or CHUNK_BYTES as all pairs of chunks, others as one chunk."""
    size = F.sum(F.length("value.shingles") + SKETCH) / CHUNK_BYTES
    chunks = members.groupBy("root").agg(F.ceil(F.greatest(F.count(F.lit(1)) / CHUNK, size)).alias("chunks"))
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks"))
    others = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1),
        lambda other: F.xxhash64("root", F.least(chunk, other), F.greatest(chunk, other)),
    )
    return members.join(chunks, "root").select(F.explode(others).alias("key"), "value", "node")


def _order() -> Column:
    """The first row by this order stays."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("text_hash"))


def _rows_of(documents: DataFrame, stay: DataFrame, repeated: bool) -> DataFrame:
    """The rows of ``stay`` (doc_id, text_hash), each once."""
    spot = free_name(documents, "text_hash")
    keys = stay.select(F.col("doc_id").alias(spot + "_id"), F.col("text_hash").alias(spot + "_of"))
    same = F.col("doc_id").eqNullSafe(F.col(spot + "_id")) & (F.col(spot) == F.col(spot + "_of"))
    kept = documents.withColumn(spot, F.xxhash64("text")).join(keys, same, "left_semi")
    return (kept.dropDuplicates(["doc_id", spot]) if repeated else kept).select(*documents.columns)
