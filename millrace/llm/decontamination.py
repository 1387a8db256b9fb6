"""Test items inside documents: size-partitioned MinHash search for containment, then an exact check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DOC, ITEM = ("doc_id", "doc_mark"), ("item_id", "item_mark")
WORD_BREAK = r"[^\p{L}\p{N}]+"
#: Items are searched by a broadcast of their signatures up to this size, by a shuffle beyond it.
BROADCAST_BYTES = 32 << 20


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), WORD_BREAK), lambda w: w != "")


def _shingles(words: str, k: int, make: str) -> Column:
    """All runs of k words; ``make`` turns ``{words}`` at ``i`` (from 0) into a value."""
    return F.expr(
        f"IF(size({words}) < {k}, slice(transform({words}, (w, i) -> {make}), 1, 0), "
        f"transform(slice({words}, 1, size({words}) - {k - 1}), (w, i) -> {make}))"
    )


def hashed(words: str, k: int) -> Column:
    return _shingles(words, k, f"xxhash64({', '.join(f'get({words}, i + {j})' for j in range(k))})")


def spelled(words: str, k: int) -> Column:
    return _shingles(words, k, f"concat_ws(' ', {', '.join(f'get({words}, i + {j})' for j in range(k))})")


def _keyed(rows: DataFrame, id_col: str, text_col: str, prefix: str) -> DataFrame:
    """<prefix>_id, <prefix>_mark, text; rows without an id are told apart by a 128-bit hash of their text."""
    text = F.coalesce(rows[text_col], F.lit(""))
    return rows.select(
        F.coalesce(rows[id_col].cast("long"), F.lit(0)).alias(f"{prefix}_id"), _mark(rows[id_col].cast("long"), text).alias(f"{prefix}_mark"),
        text.alias("text"),
    )


def _mark(number: Column, text: Column) -> Column:
    return F.when(number.isNull(), F.md5(text.cast("binary"))).otherwise(F.lit(""))


def item_signatures(items: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """MinHash signatures: item_id, item_mark, size (words of a shingle), n (distinct shingles), hash.

    Items are put in partitions by size, n in [2^p, 2^(p+1)). A document that holds c of an
    item's n shingles holds each of the item's minima with chance c / n. The signature has the m
    smallest permuted hashes, with m = n - ceil(n * percent / 100) + 1, for the largest n of
    the partition: then at least one of them lies in every document that holds enough of the item,
    so the search finds all of them. Items of under k words are one shingle of their own length.
    """
    split = _keyed(items, id_col, text_col, "item").select(*ITEM, words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    size = F.least(F.size("words"), F.lit(k))
    by_size = [
        split.where(size == s).select(*ITEM, F.lit(s).alias("size"), F.array_distinct(hashed("words", s)).alias("hashes"))
        for s in range(1, k + 1)
    ]
    sets = by_size[0]
    for part in by_size[1:]:
        sets = sets.unionByName(part)
    sets = sets.withColumn("n", F.size("hashes"))
    top = F.pow(F.lit(2), F.floor(F.log2("n")) + 1) - 1
    minima = (top - F.ceil(top * percent / 100) + 1).cast("int")
    permuted = F.array_sort(F.transform("hashes", lambda h: F.struct(F.xxhash64(h, F.lit(7)).alias("rank"), h.alias("hash"))))
    return sets.select(
        *ITEM, "size", "n", F.explode(F.slice(permuted, 1, F.least(minima, F.col("n")))).alias("m")
    ).select(*ITEM, "size", "n", F.col("m.hash").alias("hash"))


def contained_items(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", k: int = 5, percent: int = 80,
) -> DataFrame:
    """Pairs doc_id, item_id, n_shingles, n_shared, containment: at least ``percent`` of an item's
    distinct k-word shingles stand in the document.

    Words are lower-case runs of letters and digits; null texts have none. Items without words match
    nothing. Rows without an id, in either table, are searched like all others: their id is null in the
    pairs, and each different text gives a pair of its own. Items (documents) that repeat an id
    count as one pair each, with their largest overlap. Other columns are not read.
    """
    return _pairs(docs, items, id_col, text_col, item_id_col, item_text_col, k, percent).select(
        F.when(F.col("doc_mark") == "", F.col("doc_id")).alias("doc_id"),
        F.when(F.col("item_mark") == "", F.col("item_id")).alias("item_id"), "n_shingles", "n_shared", "containment",
    )


def _pairs(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", k: int = 5, percent: int = 80,
) -> DataFrame:
    """``contained_items`` by the keys of ``_keyed``."""
    signatures = item_signatures(items, item_id_col, item_text_col, k, percent)
    rows = _keyed(docs, id_col, text_col, "doc")
    lengths = signatures.agg(F.collect_set("size").alias("sizes"), F.count(F.lit(1)).alias("rows")).first()
    words = rows.select(*DOC, words_of(F.col("text")).alias("words"))
    probe = signatures.select("size", "hash", *ITEM)
    if lengths["rows"] * 64 <= BROADCAST_BYTES:
        probe = F.broadcast(probe)
    sizes = sorted(lengths["sizes"]) or [k]

    def sized(s: int) -> Column:
        return F.transform(hashed("words", s), lambda h: F.struct(F.lit(s).alias("size"), h.alias("hash")))

    found = words.select(*DOC, F.explode(F.flatten(F.array(*map(sized, sizes)))).alias("s")).select(
        *DOC, "s.size", "s.hash"
    ) if len(sizes) > 1 else words.select(
        *DOC, F.lit(sizes[0]).alias("size"), F.explode(hashed("words", sizes[0])).alias("hash")
    )
    pairs = found.join(probe, ["size", "hash"]).select(*DOC, *ITEM).distinct()

    def checked(s: int) -> DataFrame:
        mine = _keyed(items, item_id_col, item_text_col, "item").select(*ITEM, words_of(F.col("text")).alias("iw"))
        mine = mine.where(F.least(F.size("iw"), F.lit(k)) == s).select(
            *ITEM, F.array_distinct(spelled("iw", s)).alias("wanted")
        )
        there = pairs.join(rows, list(DOC)).select(*ITEM, *DOC, words_of(F.col("text")).alias("words"))
        return there.join(mine, list(ITEM)).select(
            *DOC, *ITEM, F.size("wanted").cast("long").alias("n_shingles"),
            F.size(F.array_intersect("wanted", spelled("words", s))).cast("long").alias("n_shared"),
        )

    both = checked(sizes[0])
    for s in sizes[1:]:
        both = both.unionByName(checked(s))
    good = both.where(F.col("n_shared") * 100 >= F.col("n_shingles") * percent)
    best = good.groupBy(*DOC, *ITEM).agg(F.max(F.struct("n_shared", "n_shingles")).alias("m"))
    return best.select(
        *DOC, *ITEM, "m.n_shingles", "m.n_shared", (F.col("m.n_shared") / F.col("m.n_shingles")).alias("containment")
    )


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that hold no item, all columns; rows without an id are judged by their text, others by their id."""
    leaks = _pairs(docs, items, id_col, text_col, **options).select(*[F.col(c).alias(f"leaking_{c}") for c in DOC]).distinct()
    number = docs[id_col].cast("long")
    return docs.join(
        leaks, (F.coalesce(number, F.lit(0)) == leaks["leaking_doc_id"])
        & (_mark(number, F.coalesce(docs[text_col], F.lit(""))) == leaks["leaking_doc_mark"]), "left_anti",
    )
