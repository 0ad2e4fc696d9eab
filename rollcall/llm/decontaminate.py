"""Short test items inside long documents, by size-partitioned MinHash containment search.

An item counts as contained if at least 80 % of its different five-word shingles are in the text.
Items are partitioned by size, in powers of two. An item's sketch is its smallest shingle hashes
(a bottom-k MinHash); k follows from the upper size of its partition: it is one more than the
number of shingles that a contained item of that size may lack. So a text that contains an item
has a shingle of the item's sketch, whatever the text's own length, and no contained item is
missed. (Sketches of the texts themselves can't do this: an item of 20 shingles in a text of
10,000 has a resemblance of 0.002.) Texts meet the sketches only in partitions of items that they
are long enough to contain. Candidates are then verified by their shingles, as strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import bound, free_name, landed

#: Words of a shingle; items with fewer are not searched.
SHINGLE = 5
#: Share of an item's shingles that must be found, in percent.
CONTAINED = 80
#: Rows (16 bytes each) up to which sketches and candidate keys are broadcast; joined otherwise.
BROADCAST_ROWS = 2_000_000


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; null and blank texts have none."""
    spaced = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def _windows(own: Column, of) -> Column:
    """``of`` each position at which a shingle starts."""
    last = F.size(own) - SHINGLE
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), of))


def shingles(text: Column) -> Column:
    """All shingles of a text as strings, null if there is none."""
    return bound(words(text), lambda w: _windows(w, lambda i: F.concat_ws(" ", F.slice(w, i + 1, SHINGLE))))


def _hash(parts: list[Column]) -> Column:
    return F.xxhash64(*parts)


def shingle_hashes(text: Column) -> Column:
    """All shingles of a text as hashes of their words, null if there is none."""
    return bound(words(text), lambda w: _windows(w, lambda i: _hash([w[i + k] for k in range(SHINGLE)])))


def _needed(n: Column) -> Column:
    return F.floor((n * CONTAINED + 99) / 100)


def item_sketches(items: DataFrame) -> DataFrame:
    """item, item_id, shingles, needed, sketch of every item with at least one shingle."""
    known = items.select(
        F.xxhash64("item_id", "text").alias("item"),
        "item_id",
        F.array_distinct(shingles(F.col("text"))).alias("shingles"),
        F.array_sort(F.array_distinct(shingle_hashes(F.col("text")))).alias("hashes"),
    ).filter("shingles is not null")
    size = F.size("shingles")
    upper = F.pow(F.lit(2.0), F.ceil(F.log2(size))).cast("long")
    return known.select(
        "item",
        "item_id",
        "shingles",
        _needed(size).alias("needed"),
        upper.alias("partition"),
        F.slice("hashes", 1, (upper - _needed(upper) + 1).cast("int")).alias("sketch"),
    )


def _small(df: DataFrame, rows: int) -> DataFrame:
    """``df``, which has ``rows`` rows, to be broadcast if they are few."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _candidates(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(key, item): texts, by their hash, that have a hash of an item's sketch and the size for it."""
    entries = landed(items.select(F.explode("sketch").alias("hash"), "item", "needed"), "sketches")
    row = entries.agg(F.count(F.lit(1)).alias("n"), F.max("hash").alias("last")).first()
    hashes = documents.select(F.xxhash64("text").alias("key"), shingle_hashes(F.col("text")).alias("own"))
    last = F.lit(row["last"] if row["n"] else 0).cast("long")
    # Sketches hold small hashes only; the rest of a text's are dropped before they become rows.
    low = hashes.select("key", F.size("own").alias("size"), F.explode(F.filter("own", lambda h: h <= last)).alias("hash"))
    met = low.join(_small(entries, row["n"]), "hash").filter("size >= needed")
    return met.select("key", "item").distinct()


def contained_items(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The columns of ``documents`` and of the items each contains, as ``_contained``: an array of
    (item_id, n_shingles, n_found); only rows that contain an item."""
    names = {n: free_name(documents, n) for n in ("_key", "_items", "_contained")}
    known = landed(item_sketches(items), "items")
    found = landed(_candidates(documents, known), "candidates")
    keys = found.select("key").distinct()
    lists = (
        found.join(known.select("item", "item_id", "shingles", "needed"), "item")
        .groupBy("key")
        .agg(F.collect_list(F.struct("item_id", "shingles", "needed")).alias(names["_items"]))
        .withColumnRenamed("key", names["_key"])
    )
    keyed = documents.withColumn(names["_key"], F.xxhash64("text"))
    # First only the candidates by their keys, so that other texts are not shuffled.
    few = keyed.join(_small(keys.withColumnRenamed("key", names["_key"]), keys.count()), names["_key"], "left_semi")
    met = few.join(lists, names["_key"])
    own = bound(
        shingles(F.col("text")),
        lambda s: F.transform(
            F.col(names["_items"]),
            lambda i: F.struct(
                i["item_id"].alias("item_id"),
                F.size(i["shingles"]).cast("long").alias("n_shingles"),
                # The set is built from the item; the text is read through it.
                F.size(F.array_intersect(s, i["shingles"])).cast("long").alias("n_found"),
                i["needed"].alias("needed"),
            ),
        ),
    )
    verified = F.filter(own, lambda i: i["n_found"] >= i["needed"])
    checked = met.withColumn(names["_contained"], verified).filter(F.size(names["_contained"]) > 0)
    return checked.select(*documents.columns, F.col(names["_contained"]).alias(free_name(documents, "_contained")))


def contaminated(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_found, containment) of every item in every document.

    Words are runs of letters and digits in lower case. Items of fewer than five words and null
    texts match nothing. Repeated documents and items give repeated rows; null ids stay.
    """
    held = contained_items(documents.select("doc_id", "text"), items)
    one = held.select("doc_id", F.explode("_contained").alias("i"))
    return one.select(
        "doc_id",
        "i.item_id",
        "i.n_shingles",
        "i.n_found",
        (F.col("i.n_found") / F.col("i.n_shingles")).alias("containment"),
    )


def decontaminated(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that contain no item, with all their columns as they came."""
    spot = free_name(documents, "text_key")
    same = [F.xxhash64("text").alias(spot), F.coalesce(F.length("text"), F.lit(-1)).alias(spot + "_length")]
    bad = landed(contained_items(documents.select("text"), items).select(*same).distinct(), "contaminated")
    rows = bad.count()
    marked = documents.withColumns({spot: F.xxhash64("text"), spot + "_length": F.coalesce(F.length("text"), F.lit(-1))})
    return marked.join(_small(bad, rows), [spot, spot + "_length"], "left_anti").select(*documents.columns)
