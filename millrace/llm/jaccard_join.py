"""N-gram Jaccard join: prefix lists spread by Spark, T-occurrence search with DivideSkip in blocks."""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from millrace.llm import rolling
from millrace.llm.common import text_bytes, written
from millrace.llm.components import components
from millrace.llm.rolling import bucket_of, mixed, packed, parts, runs, sliced, unpacked, words_of

HELD_TOKENS = 3_000_000
HASH_BUCKET_BYTES, TEXT_BUCKET_BYTES = 20 << 20, 5 << 20
#: Documents of one search block: bounds its memory, not its result.
BLOCK = 256
#: Sets of one part of an inverted list when all pairs are wanted; tasks that a list's entries are dealt to.
LIST_PART, LIST_LANES = 1000, 16
STAR_ROUNDS = 2
NO_ID = np.int64(np.iinfo(np.int64).max)


def least_overlap(n: int, percent: int) -> int:
    """Shingles that a set of n shares with any set it links to, at the least."""
    return (percent * n + 99) // 100


def _group_of(ids: np.ndarray, groups: int) -> np.ndarray:
    return bucket_of(mixed(ids.astype(np.int64).view(np.uint64)), groups)


def _by_group(
    ids: np.ndarray, groups: int, *columns: np.ndarray, by: np.ndarray | None = None
) -> Iterator[tuple[int, bytes]]:
    """(group, packed ids and columns) of rows dealt to groups of documents, by the id or ``by``."""
    group = _group_of(ids if by is None else by, groups)
    order = np.lexsort((ids, group))
    group, ids = group[order], ids[order]
    columns = tuple(c[order] for c in columns)
    for g, a, z in parts(group):
        low = int(ids[a])  # the smallest: sorted within the group
        yield g, low.to_bytes(8, "little", signed=True) + packed(
            (ids[a:z] - low).view(np.uint64), *(c[a:z] for c in columns)
        )


def _opened(blob: bytes, columns: int) -> list[np.ndarray]:
    found = unpacked(blob[8:], columns + 1)
    found[0] = found[0].view(np.int64) + np.int64(int.from_bytes(blob[:8], "little", signed=True))
    return found


def _sorted_rows(found: Iterator[tuple[int, int, bytes]], apart: bool = False) -> Iterator[pa.RecordBatch]:
    """Rows key, piece, kind, body; ``apart`` gives bodies of a negative key, which are not compared, pieces of their own."""

    def batch() -> pa.RecordBatch:
        pieces = [crc32(b) >> 1 if apart and k < 0 else 0 for k, b in zip(keys, blobs)]
        return pa.RecordBatch.from_arrays([
            pa.array(keys, pa.int32()), pa.array(pieces, pa.int32()), pa.array(kinds, pa.int32()), pa.array(blobs, pa.binary()),
        ], ROWS.names)

    keys, kinds, blobs, size = [], [], [], 0
    for key, kind, blob in found:
        keys.append(key)
        kinds.append(kind)
        blobs.append(blob)
        size += len(blob)
        if size > 4 << 20:
            yield batch()
            keys, kinds, blobs, size = [], [], [], 0
    if keys:
        yield batch()


ROW = "key int, piece int, kind int, body binary"
ROWS = pa.schema([("key", pa.int32()), ("piece", pa.int32()), ("kind", pa.int32()), ("body", pa.binary())])


def _table(found: list[tuple[int, int, bytes]], apart: bool = False) -> pa.Table:
    return pa.Table.from_batches(list(_sorted_rows(iter(found), apart)), ROWS)


def _dealt_again(
    sent: DataFrame, opened: dict[int, Callable[[bytes], tuple]], dealt: dict[int, Callable[..., Iterator[tuple[int, int, bytes]]]]
) -> DataFrame:
    """Bodies sent to at most ``rolling.FAN`` ranges of keys, dealt to the keys themselves, in bounded holds.

    For each kind: how a body is opened to columns, and how the columns held go on. Other kinds pass.
    """

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {kind: [] for kind in opened}
        count = dict.fromkeys(opened, 0)
        for batch in batches:
            for key, kind, body in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                if kind not in opened:
                    yield from _sorted_rows(iter([(key, kind, body.as_py())]), True)
                    continue
                held[kind].append(tuple(opened[kind](body.as_py())))
                count[kind] += len(held[kind][-1][0])
                if count[kind] >= HELD_TOKENS:
                    yield from _sorted_rows(dealt[kind](*map(np.concatenate, zip(*held[kind]))))
                    held[kind], count[kind] = [], 0
        for kind, columns in held.items():
            if columns:
                yield from _sorted_rows(dealt[kind](*map(np.concatenate, zip(*columns))))

    return sent.repartition("key").mapInArrow(again, ROW)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of texts, sorted by text and hash, and the texts they belong to."""
    words = words_of(data, offsets, lower=True)
    hashes, text, _ = words.windows(k)
    count = np.diff(words.first)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        hashes = np.concatenate([hashes, words.whole()[short]])
        text = np.concatenate([text, short])
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return hashes[new], text[new]


def set_marks(hashes: np.ndarray, text: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and a 128-bit mark (two sums) of each text's set."""
    edges = sliced(text, texts)
    sums = []
    for turn in (np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)):
        running = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(mixed(hashes ^ turn), out=running[1:])
        sums.append(mixed(running[edges[1:]] - running[edges[:-1]]))
    return np.diff(edges), sums[0].view(np.int64), sums[1].view(np.int64)


def profiles(rows: DataFrame, k: int, buckets: int, groups: int) -> DataFrame:
    """doc_id, n_shingles, mark1, mark2, n_alone: how many of the shingles no other document has.

    Only packed hashes are shuffled. A map task sends a hash once: with its document, or, if it has
    it in several, as shared. Beyond ``rolling.FAN`` buckets or groups all is dealt in two turns.
    """
    some_buckets, some_groups = min(buckets, rolling.FAN), min(groups, rolling.FAN)
    apart = groups > some_groups

    def flush(hashes, ids, single, buckets):
        order = np.lexsort((ids, hashes))
        hashes, ids, single = hashes[order], ids[order], single[order]
        new = np.r_[True, hashes[1:] != hashes[:-1]]
        starts = np.flatnonzero(new)
        last = np.r_[starts[1:], len(hashes)] - 1
        single = np.logical_and.reduceat(single, starts) & (ids[starts] == ids[last])
        hashes, ids = hashes[starts], ids[starts]
        for b, a, z in parts(bucket_of(hashes, buckets)):
            low = int(ids[a:z].min())
            owner = np.where(single[a:z], (ids[a:z] - low).view(np.uint64) + np.uint64(1), np.uint64(0))
            yield b, 0, low.to_bytes(8, "little", signed=True) + packed(hashes[a:z], owner)

    def owned(body):
        hashes, owner = unpacked(body[8:], 2)
        low = np.int64(int.from_bytes(body[:8], "little", signed=True))
        return hashes, np.where(owner > 0, owner.view(np.int64) - 1 + low, 0), owner > 0

    def held_on(held):
        hashes, ids = map(np.concatenate, zip(*held))
        return _sorted_rows(flush(hashes, ids, np.ones(len(ids), bool), some_buckets))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            ids = np.array(batch.column(0).fill_null(int(NO_ID)), np.int64)
            for first, last, data, offsets in runs(batch):
                hashes, text = shingle_sets(data, offsets, k)
                own = ids[first:last]
                size, one, two = set_marks(hashes, text, len(own))
                # Nothing is asked about rows without an id, so they need not meet in one group.
                by = np.where(own == NO_ID, one, own)
                yield from _sorted_rows(((-1 - g, 1, body) for g, body in _by_group(own, some_groups, size, one.view(np.uint64), two.view(np.uint64), by=by)), apart)
                held.append((hashes, own[text]))
                count += len(hashes)
                if count >= HELD_TOKENS:
                    yield from held_on(held)
                    held, count = [], 0
        if count:
            yield from held_on(held)

    def compared(table: pa.Table) -> pa.Table:
        key = table.column("key")[0].as_py()
        bodies = [b.as_py() for b in table.column("body")]
        if key < 0:
            found = [(-1 - key, 1, b) for b in bodies]
        else:
            hashes, ids, single = map(np.concatenate, zip(*map(owned, bodies)))
            order = np.argsort(hashes, kind="stable")
            hashes, ids, single = hashes[order], ids[order], single[order]
            starts = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
            ends = np.r_[starts[1:], len(hashes)] - 1
            # One document may lie in several tasks' parts only if its id is repeated.
            # Rows without an id are not asked about, and their marks lie in other groups.
            alone = single[starts] & (ends == starts) & (ids[starts] != NO_ID)
            owner, count = np.unique(ids[starts[alone]], return_counts=True)
            found = [(g, 0, body) for g, body in _by_group(owner, some_groups, count)]
        return _table(found)

    def gathered(table: pa.Table) -> pa.Table:
        marks, counts = [], []
        for kind, body in zip(table.column("kind").to_pylist(), table.column("body")):
            (marks if kind else counts).append(_opened(body.as_py(), 3 if kind else 1))
        ids, size, one, two = map(np.concatenate, zip(*marks))
        alone = np.zeros(len(ids), np.int64)
        known, first, times = np.unique(ids, return_index=True, return_counts=True)
        for owner, count in counts:
            np.add.at(alone, first[np.searchsorted(known, owner)], count.view(np.int64))
        repeated = np.isin(ids, known[times > 1])
        alone[repeated] = 0  # an id of several rows: nothing is known of each row alone
        return pa.table({
            "doc_id": pa.array(ids, pa.int64(), mask=ids == NO_ID), "n_shingles": pa.array(size.view(np.int64)),
            "mark1": pa.array(one.view(np.int64)), "mark2": pa.array(two.view(np.int64)), "n_alone": pa.array(alone),
        })

    def marked(ids, size, one, two):
        by = np.where(ids == NO_ID, one.view(np.int64), ids)
        return ((g, 1, body) for g, body in _by_group(ids, groups, size, one, two, by=by))

    sent = rows.mapInArrow(hashed, ROW)
    if buckets > some_buckets:
        sent = _dealt_again(sent, {0: owned}, {0: lambda *columns: flush(*columns, buckets)})
    replies = sent.groupBy("key", "piece").applyInArrow(compared, ROW)
    if apart:
        replies = _dealt_again(
            replies, {0: lambda b: _opened(b, 1), 1: lambda b: _opened(b, 3)},
            {0: lambda ids, count: ((g, 0, body) for g, body in _by_group(ids, groups, count)), 1: marked},
        )
    return replies.groupBy("key").applyInArrow(
        gathered, "doc_id long, n_shingles long, mark1 long, mark2 long, n_alone long"
    )


MARKS = ["mark1", "mark2", "n_shingles"]


def _marked(rows: DataFrame, k: int) -> DataFrame:
    """doc_id, mark1, mark2, n_shingles, tokens (sorted 64-bit hashes) of rows (doc_id, text)."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in runs(batch):
                hashes, text = shingle_sets(data, offsets, k)
                size, one, two = set_marks(hashes, text, last - first)
                edges = sliced(text, last - first)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, last - first), pa.array(one), pa.array(two), pa.array(size.astype(np.int64)),
                    pa.array([hashes[edges[i]:edges[i + 1]].tobytes() for i in range(last - first)], pa.binary()),
                ], ["doc_id", *MARKS, "tokens"])

    return rows.mapInArrow(made, "doc_id long, mark1 long, mark2 long, n_shingles long, tokens binary")


def sets_of(rows: DataFrame, wanted: DataFrame, k: int, groups: int) -> DataFrame:
    """grp, rep, tokens (sorted 64-bit hashes) of the wanted classes (rep, first_id, marks), one row each.

    A class is read from the rows of its smallest id that have its marks: an id may have several texts.
    """
    there = rows.join(wanted.select(F.col("first_id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    once = _marked(there, k).dropDuplicates(["doc_id", *MARKS])
    named = once.join(wanted.withColumnRenamed("first_id", "doc_id"), ["doc_id", *MARKS])

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = _group_of(np.array(batch.column(0), np.int64), groups).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(group), *batch.columns], ["grp", "rep", "tokens"])

    return named.select("rep", "tokens").mapInArrow(dealt, "grp int, rep long, tokens binary")


def prefixes(sets: DataFrame, percent: int, buckets: int, groups: int) -> DataFrame:
    """rep, n, odd, token, place: of each set the n - least_overlap + 1 rarest shingles that another set has too.

    Two sets that link share one of these: with one order for all, by number of sets and hash.
    ``place`` is the token's place in its set by that order.
    ``odd`` is small for a set whose shingles many others have, the middle of its family.
    """
    some_buckets, some_groups = min(buckets, rolling.FAN), min(groups, rolling.FAN)

    def flush(tokens, reps, at, buckets=some_buckets):
        order = np.argsort(tokens, kind="stable")
        tokens, reps, at = tokens[order], reps[order], at[order]
        for b, a, z in parts(bucket_of(tokens, buckets)):
            low = int(reps[a:z].min())
            yield b, 0, low.to_bytes(8, "little", signed=True) + packed(tokens[a:z], (reps[a:z] - low).view(np.uint64), at[a:z])

    def listed(blob):
        tokens, rep, at = unpacked(blob[8:], 3)
        return tokens, rep.view(np.int64) + np.int64(int.from_bytes(blob[:8], "little", signed=True)), at

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            for rep, body in zip(batch.column(1).to_pylist(), batch.column(2)):
                tokens = np.frombuffer(body.as_py(), np.uint64)
                held.append((tokens, np.full(len(tokens), rep, np.int64), np.arange(len(tokens), dtype=np.uint32)))
                count += len(tokens)
                if count >= HELD_TOKENS:
                    yield from _sorted_rows(flush(*map(np.concatenate, zip(*held))))
                    held, count = [], 0
        if count:
            yield from _sorted_rows(flush(*map(np.concatenate, zip(*held))))

    def counted(table: pa.Table) -> pa.Table:
        tokens, reps, at = map(np.concatenate, zip(*[listed(body.as_py()) for body in table.column("body")]))
        order = np.argsort(tokens, kind="stable")
        tokens, reps, at = tokens[order], reps[order], at[order]
        starts = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]])
        sizes = np.diff(np.r_[starts, len(tokens)])
        held = np.repeat(sizes, sizes)
        many = held > 1
        return _table([(g, 1, body) for g, body in _by_group(reps[many], some_groups, at[many], held[many])])

    def chosen(key: tuple, own: pa.Table, replies: pa.Table) -> pa.Table:
        answers = [_opened(b.as_py(), 2) for b in replies.column("body")]
        out: dict[str, list] = {"rep": [], "n": [], "odd": [], "alone": [], "tokens": []}
        if answers:
            reps, at, held = map(np.concatenate, zip(*answers))
            order = np.argsort(reps, kind="stable")
            reps, at, held = reps[order], at[order].view(np.int64), held[order].view(np.int64)
            for rep, body in zip(own.column("rep").to_pylist(), own.column("tokens")):
                tokens = np.frombuffer(body.as_py(), np.uint64)
                a, z = np.searchsorted(reps, rep, "left"), np.searchsorted(reps, rep, "right")
                count = np.ones(len(tokens), np.int64)
                count[at[a:z]] = held[a:z]
                size = len(tokens) - least_overlap(len(tokens), percent) + 1
                rare = np.lexsort((tokens, count))[:size]
                alone = int((count[rare] == 1).sum())
                rare = rare[alone:]
                if len(rare):
                    out["alone"].append(alone)
                    out["rep"].append(rep)
                    out["n"].append(len(tokens))
                    out["odd"].append(-int(1000 * np.log2(count).mean()))
                    out["tokens"].append(tokens[rare].view(np.int64).tolist())
        return pa.table(out, schema=pa.schema([
            ("rep", pa.int64()), ("n", pa.int64()), ("odd", pa.int64()), ("alone", pa.int64()), ("tokens", pa.list_(pa.int64()))
        ]))

    sent = sets.mapInArrow(hashed, ROW)
    if buckets > some_buckets:
        sent = _dealt_again(sent, {0: listed}, {0: lambda *columns: flush(*columns, buckets)})
    replies = sent.groupBy("key").applyInArrow(counted, ROW)
    if groups > some_groups:
        replies = _dealt_again(replies, {1: lambda b: _opened(b, 2)}, {
            1: lambda reps, at, held: ((g, 1, body) for g, body in _by_group(reps, groups, at, held))
        })
    replies = replies.select(F.col("key").alias("grp"), "body")
    rare = sets.groupBy("grp").cogroup(replies.groupBy("grp")).applyInArrow(
        chosen, "rep long, n long, odd long, alone long, tokens array<long>"
    )
    return rare.select("rep", "n", "odd", "alone", F.posexplode("tokens").alias("at", "token")).select(
        "rep", "n", "odd", "token", (F.col("alone") + F.col("at")).alias("place")
    )


class BlockIndex:
    """Inverted lists over the sets of one block, searched by DivideSkip."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.sets, self.percent = sets, percent
        tokens = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(tokens, kind="stable")
        self.tokens, starts = np.unique(tokens[order], return_index=True)
        self.lists = np.split(owner[order], starts[1:])

    def linked(self, x: int, open_: list[bool]) -> list[int]:
        """Open sets y with 100 * |x n y| >= percent * |x u y|.

        The overlap needed is T at least. The T - 1 longest lists are set aside; whatever overlaps
        in T shingles is in at least one of the short lists, which a heap merges; the long lists
        are then probed by binary search for what the merge brought, until no overlap can be reached.
        """
        mine = self.sets[x]
        lists = sorted((self.lists[i] for i in np.searchsorted(self.tokens, mine)), key=len)
        need = least_overlap(len(mine), self.percent)
        cut = len(lists) - (need - 1)
        short, long_ = [s.tolist() for s in lists[:cut]], [s.tolist() for s in lists[cut:]]
        counts: dict[int, int] = {}
        for y in heapq.merge(*short):
            if open_[y]:
                counts[y] = counts.get(y, 0) + 1
        found = []
        for y, count in counts.items():
            both = len(mine) + len(self.sets[y])
            wanted = -(-self.percent * both // (100 + self.percent))
            left = len(long_)
            for members in long_:
                if count + left < wanted:
                    break
                at = bisect_left(members, y)
                count += at < len(members) and members[at] == y
                left -= 1
            if count * 100 >= self.percent * (both - count):
                found.append(y)
        return found

    def links_of(self, x: int) -> list[tuple[int, int]]:
        return [(x, y) for y in self.linked(x, [y != x for y in range(len(self.sets))])]

    def forest(self) -> list[tuple[int, int]]:
        """Links that join every component of the block: a search looks only for sets not yet reached."""
        open_ = [True] * len(self.sets)
        links, closed = [], 0
        for start in range(len(self.sets)):
            if not open_[start]:
                continue
            open_[start] = False
            closed += 1
            queue = [start]
            while queue and closed < len(self.sets):
                x = queue.pop()
                for y in self.linked(x, open_):
                    open_[y] = False
                    closed += 1
                    links.append((x, y))
                    queue.append(y)
        return links


def verified(pairs: DataFrame, sets: DataFrame, percent: int, within: bool) -> DataFrame:
    """Links a, b among the sets named by candidate pairs (hub, rep), searched in blocks of a hub.

    ``within`` also joins the sets of a block to each other, else only to the hub.
    """
    sizes = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = pairs.join(sizes, "hub").select("hub", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("block"), "rep")
    hubs = sizes.select("hub", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("hub").alias("rep"))
    members = dealt.unionByName(hubs).join(sets.select("rep", "tokens"), "rep")

    def search(table: pa.Table) -> pa.Table:
        reps = table.column("rep").to_pylist()
        index = BlockIndex([np.frombuffer(b.as_py(), np.uint64) for b in table.column("tokens")], percent)
        hub = reps.index(table.column("hub")[0].as_py())
        links = index.forest() if within else index.links_of(hub)
        return pa.table({
            "a": pa.array([reps[x] for x, _ in links], pa.int64()), "b": pa.array([reps[y] for _, y in links], pa.int64())
        })

    return members.groupBy("hub", "block").applyInArrow(search, "a long, b long")


def _possible(percent: int) -> Column:
    """Whether two sets whose first common shingle is at these places can overlap enough.

    Sets that link overlap in T shingles, none of which comes before their first common one; for
    that shingle the condition holds, so pairs it refuses for all their common shingles don't link.
    """
    need = F.ceil(F.lit(percent) * (F.col("n") + F.col("other_n")) / F.lit(100 + percent))
    return (F.col("n") - F.col("place") >= need) & (F.col("other_n") - F.col("other_place") >= need)


def _with_lists(entries: DataFrame, merged: dict[str, tuple[Column, str]]) -> DataFrame:
    """Entries with facts of their token's list, each the ``min``, ``max`` or ``sum`` of a column.

    Entries and facts meet by token and lane, so a long list spreads over tasks; a lane has its row of
    facts only for tokens that have entries in it.
    """
    laned = entries.withColumn("lane", F.pmod(F.xxhash64("rep"), F.lit(LIST_LANES)))
    some = laned.groupBy("token", "lane").agg(*[getattr(F, how)(value).alias(name) for name, (value, how) in merged.items()])
    facts = some.groupBy("token").agg(*[getattr(F, how)(name).alias(name) for name, (_, how) in merged.items()])
    return laned.join(some.select("token", "lane").join(facts, "token"), ["token", "lane"]).drop("lane")


def star_pairs(entries: DataFrame, turn: int, percent: int) -> DataFrame:
    """Of each token's list, the pairs (hub, rep) of one set of it and those of another component.

    The hub is the least odd one at first, then any by a hash.
    """
    order = F.xxhash64("rep", F.lit(turn)) if turn else F.col("odd")
    hub = F.struct(order.alias("rank"), F.col("rep").alias("hub"), F.col("n").alias("other_n"),
                   F.col("place").alias("other_place"), F.col("label").alias("other"))
    lists = _with_lists(entries, {"h": (hub, "min"), "low": (F.col("label"), "min"), "high": (F.col("label"), "max")})
    return lists.where("low != high").select("*", "h.*").where(F.col("label") != F.col("other")).where(
        _possible(percent)
    ).select("hub", "rep").distinct()


def _list_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """All pairs of entries of one list, from lists (with their ``entries`` counted) split into parts.

    Each part of a list meets each other part by itself, so a long list spreads over tasks.
    """
    dealt = lists.withColumn("parts", F.ceil(F.col("entries") / LIST_PART).cast("int")).withColumn(
        "part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
    )
    others = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    left = dealt.select("token", F.col("part").alias("i"), others.alias("j"), "rep", "n", "place", "label")
    right = dealt.select("token", others.alias("i"), F.col("part").alias("j"), F.col("rep").alias("hub"),
                         F.col("n").alias("other_n"), F.col("place").alias("other_place"), F.col("label").alias("other"))
    return left.join(right, ["token", "i", "j"]).where("rep < hub and label != other").where(_possible(percent)).select(
        "hub", "rep"
    ).distinct()


def open_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """All pairs that share a prefix token and are still in different components."""
    label = F.col("label")
    lists = _with_lists(entries, {"low": (label, "min"), "high": (label, "max"), "entries": (F.lit(1), "sum")})
    return _list_pairs(lists.where("low != high"), percent)


def all_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """All pairs (hub, rep) of different sets that share a prefix token."""
    alone = entries.withColumn("label", F.col("rep"))
    return _list_pairs(_with_lists(alone, {"entries": (F.lit(1), "sum")}), percent)


def jaccard_links(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, percent: int = 90,
) -> tuple[DataFrame, DataFrame]:
    """Every link between different sets, and the rows that have each set.

    Links: a < b, the class numbers of two sets that link (see ``jaccard_components``), each pair once.
    Members: one row per input row: doc_id, n_shingles, class_id, n_links (other sets that the row's
    set links to). Rows with one class_id have equal sets. Rows without an id or words have class_id
    null and no links. Numbers hold within one call. Every linked pair is a row, so the cost grows
    with the square of a family whose members all link.
    """
    known, classes, sets, entries = _lists(docs, id_col, text_col, k, percent)
    pairs = written(all_pairs(entries, percent), "shingle-pairs")
    links = written(verified(pairs, sets, percent, within=False).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).distinct(), "shingle-links")
    ends = links.select(F.col("a").alias("rep")).unionByName(links.select(F.col("b").alias("rep")))
    counts = ends.groupBy("rep").agg(F.count(F.lit(1)).alias("n_links"))
    named = classes.select(*MARKS, "rep").join(counts, "rep", "left")
    has_id = F.col("doc_id").isNotNull()
    members = known.join(named, MARKS, "left").select(
        "doc_id", "n_shingles", F.when(has_id, F.col("rep")).alias("class_id"),
        F.coalesce(F.when(has_id, F.col("n_links")), F.lit(0)).alias("n_links"),
    )
    return links, members


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, percent: int = 90,
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest doc_id reachable by links).

    A-Z are lower-cased; a word is a run of characters other than ASCII blanks; a set has the
    distinct k-word shingles, of fewer words the whole sequence. Sets link when 100 * |x n y| >=
    percent * |x u y|. The steps, each exact:

    1. Equal sets collapse to one class with a number of its own. A document with over 100 - percent % shingles that
       no other has can link to none and leaves (packed hashes, one shuffle).
    2. Of the others, shingles are ordered by the number of sets that have them, and the rarest
       n - T + 1 of each set go to inverted lists.
    3. Each list's sets are searched against one of them, twice, with DivideSkip in blocks, and
       joined; then all pairs of one list that are still in different components are.

    Null text has no words; a set without words links to nothing and is its own component. Rows
    without an id have component null and link to nothing. Rows that repeat an id are sets of
    their own, each with the component of its own set. Other columns are not read.
    """
    return _components(docs, id_col, text_col, k, percent).select("doc_id", "n_shingles", "component_id")


def _lists(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> tuple[DataFrame, ...]:
    """Profiles of all rows, classes of equal sets, the sets that may link, and their prefix lists."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    size = text_bytes(rows)
    buckets, groups = max(96, size // HASH_BUCKET_BYTES), max(96, size // TEXT_BUCKET_BYTES)
    known = written(profiles(rows, k, buckets, groups), "shingle-profiles")
    # The number is fixed by being written; an id can't stand for a class, as it may have several texts.
    classes = written(known.where("n_shingles > 0 and doc_id is not null").groupBy(*MARKS).agg(
        F.min("doc_id").alias("first_id"), F.min("n_alone").alias("n_alone")
    ).withColumn("rep", F.monotonically_increasing_id()), "shingle-classes")
    able = classes.where((F.col("n_shingles") - F.col("n_alone")) * 100 >= F.col("n_shingles") * percent)
    sets = written(sets_of(rows, able.select("rep", "first_id", *MARKS), k, groups), "shingle-sets")
    entries = written(prefixes(sets, percent, buckets, groups), "shingle-lists")
    return known, classes, sets, entries


def _components(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """``jaccard_components`` with the marks of each row's set."""
    known, classes, sets, entries = _lists(docs, id_col, text_col, k, percent)
    labels = entries.select("rep").distinct().withColumn("label", F.col("rep"))
    links = None
    for turn in range(STAR_ROUNDS + 1):
        marked = entries.join(labels, "rep") if turn else entries.withColumn("label", F.col("rep"))
        pairs = star_pairs(marked, turn, percent) if turn < STAR_ROUNDS else open_pairs(marked, percent)
        pairs = written(pairs, "shingle-pairs")
        found = written(verified(pairs, sets, percent, turn < STAR_ROUNDS), "shingle-links")
        links = found if links is None else links.unionByName(found)
        named = components(links).withColumnRenamed("node", "rep").withColumnRenamed("label", "low")
        labels = entries.select("rep").distinct().join(named, "rep", "left").select(
            "rep", F.coalesce("low", "rep").alias("label")
        )
    named = written(classes.join(labels, "rep", "left").select(
        *MARKS, "first_id", F.coalesce("label", "rep").alias("label")
    ), "shingle-labels")
    least = named.groupBy("label").agg(F.min("first_id").alias("component"))
    named = named.join(least, "label").select(*MARKS, "component")
    return known.join(named, MARKS, "left").select(
        "doc_id", *MARKS, F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    )


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, percent: int = 90,
) -> DataFrame:
    """The rows whose id is the smallest of its component, all columns; rows without an id stay.

    Where an id has texts of which some go and some stay, its rows are told apart by the marks of their sets.
    """
    judged = _components(docs, id_col, text_col, k, percent).where("doc_id is not null").select(
        F.col("doc_id").alias("__id"), *[F.col(m).alias(f"__{m}") for m in MARKS],
        (F.col("component_id") != F.col("doc_id")).alias("__gone"),
    )
    judged = written(judged, "judged-sets")
    gone = judged.where("__gone").select("__id").distinct()
    left = docs.join(gone, docs[id_col] == F.col("__id"), "left_anti")
    both = written(judged.groupBy("__id").agg(F.min("__gone").alias("all"), F.max("__gone").alias("any")).where(
        "any and not all"
    ).select("__id"), "divided-ids")
    if both.isEmpty():
        return left
    some = docs.join(both, docs[id_col] == F.col("__id"), "left_semi")
    place = docs.columns.index(text_col)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).fill_null("")
            alone = pa.RecordBatch.from_arrays([texts], ["text"])
            for first, last, data, offsets in runs(alone, 0):
                hashes, text = shingle_sets(data, offsets, k)
                size, one, two = set_marks(hashes, text, last - first)
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(first, last - first).columns, pa.array(one), pa.array(two), pa.array(size.astype(np.int64))],
                    [*batch.schema.names, *keys],
                )

    keys = [f"__{m}" for m in MARKS]
    schema = StructType([*some.schema.fields, *[StructField(c, LongType()) for c in keys]])
    stay = judged.where("not __gone").select("__id", *keys).distinct()
    some = some.mapInArrow(marked, schema).withColumn("__id", F.col(id_col).cast("long")).join(stay, ["__id", *keys], "left_semi")
    return left.unionByName(some.select(*docs.columns))
