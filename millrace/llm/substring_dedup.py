"""Repeated passages: Rabin-Karp hashes of all token windows, counted in Spark, merged to intervals."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import rolling
from millrace.llm.common import narrowed, text_bytes
from millrace.llm.rolling import bucket_of, packed, parts, runs, sliced, unpacked, words_of

#: A map task sends its windows on when it holds so many.
HELD_WINDOWS = 4_000_000
#: Bytes of text per bucket of hashes and per group of documents: both fit in a worker's memory.
HASH_BUCKET_BYTES, TEXT_BUCKET_BYTES = 20 << 20, 5 << 20
NO_ID = np.int64(np.iinfo(np.int64).max)
ROWS = pa.schema([("key", pa.int32()), ("piece", pa.int32()), ("body", pa.binary())])


def _sent(hashes, ids, group, buckets: int, groups: int) -> Iterator[tuple[int, bytes]]:
    """Rows of one held set of windows: per bucket the smallest id's windows, per group what is lost already.

    Of windows with one hash only those of the smallest id go on to be compared with other tasks;
    the others start later in this task's own documents, so they are lost whatever is elsewhere.
    """
    hashes, ids, group = _distinct(hashes, ids, group)
    new = np.r_[True, hashes[1:] != hashes[:-1]] if len(hashes) else np.zeros(0, bool)
    least = ids[np.flatnonzero(new)][np.cumsum(new) - 1] if len(hashes) else ids
    lost = ids > least
    yield from _losses(hashes[lost], ids[lost], group[lost], groups)
    hashes, ids, group = hashes[~lost], ids[~lost], group[~lost]
    for b, a, z in parts(bucket_of(hashes, buckets)):
        yield b, _closed(hashes[a:z], ids[a:z], group[a:z])


def _closed(hashes: np.ndarray, ids: np.ndarray, group: np.ndarray) -> bytes:
    low = int(ids.min())
    return low.to_bytes(8, "little", signed=True) + packed(hashes, (ids - low).view(np.uint64), group)


def _opened(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    hashes, offset, group = unpacked(body[8:], 3)
    return hashes, offset.view(np.int64) + np.int64(int.from_bytes(body[:8], "little", signed=True)), group.astype(np.uint32)


def _distinct(hashes: np.ndarray, ids: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each (hash, id, group) once, in that order."""
    order = np.lexsort((group, ids, hashes))
    hashes, ids, group = hashes[order], ids[order], group[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (ids[1:] != ids[:-1]) | (group[1:] != group[:-1])
    return hashes[new], ids[new], group[new]


def _losses(hashes: np.ndarray, ids: np.ndarray, group: np.ndarray, groups: int) -> Iterator[tuple[int, bytes]]:
    """Rows (-1 - key, windows that go) by group of documents modulo ``groups``; sorted by hash and id."""
    key = group.astype(np.int64) % groups
    order = np.argsort(key, kind="stable")
    hashes, ids, group = hashes[order], ids[order], group[order]
    for g, a, z in parts(key[order]):
        yield -1 - g, _closed(hashes[a:z], ids[a:z], group[a:z])


def _rows(found: Iterator[tuple[int, bytes]], apart: bool) -> Iterator[pa.RecordBatch]:
    """Rows key, piece, body; losses of a range of groups, which are not compared, are kept ``apart`` by piece."""

    def batch() -> pa.RecordBatch:
        pieces = [crc32(b) >> 1 if apart and k < 0 else 0 for k, b in zip(keys, blobs)]
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int32()), pa.array(pieces, pa.int32()), pa.array(blobs, pa.binary())], ["key", "piece", "body"]
        )

    keys, blobs, size = [], [], 0
    for k, blob in found:
        keys.append(k)
        blobs.append(blob)
        size += len(blob)
        if size > 4 << 20:
            yield batch()
            keys, blobs, size = [], [], 0
    if keys:
        yield batch()


ROW = "key int, piece int, body binary"


def _dealt_again(sent: DataFrame, buckets: int, groups: int, losses: bool) -> DataFrame:
    """Rows of a range of keys dealt to the buckets (or, of losses, groups) themselves, in bounded holds.

    A task that held windows for millions of buckets would send each with a blob of its own. So it
    sends to ``FAN`` ranges, and the tasks of these deal what they got to their part of the buckets.
    """
    wanted = -1 if losses else 1

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            columns = tuple(map(np.concatenate, zip(*held)))
            yield from _rows(_losses(*_distinct(*columns), groups) if losses else _sent(*columns, buckets, groups), True)

        for batch in batches:
            for key, body in zip(batch.column(0).to_pylist(), batch.column(2)):
                if (key < 0) != (wanted < 0):
                    yield from _rows(iter([(key, body.as_py())]), True)
                    continue
                held.append(_opened(body.as_py()))
                count += len(held[-1][0])
                if count >= HELD_WINDOWS:
                    yield from flush()
                    held, count = [], 0
        if count:
            yield from flush()

    return sent.repartition("key").mapInArrow(dealt, ROW)


def repeated_windows(rows: DataFrame, k: int, buckets: int, groups: int) -> DataFrame:
    """Windows whose words also start in a document with a smaller id: group, body (packed hashes, ids, groups)."""
    some_buckets, some_groups = min(buckets, rolling.FAN), min(groups, rolling.FAN)
    apart = groups > some_groups

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            ids = np.array(batch.column(0).fill_null(int(NO_ID)), np.int64)
            group = np.array(batch.column(2), np.uint32)
            for first, last, data, offsets in runs(batch):
                hashes, text, _ = words_of(data, offsets, lower=False).windows(k)
                held.append((hashes, ids[first:last][text], group[first:last][text]))
                count += len(hashes)
                if count >= HELD_WINDOWS:
                    yield from _rows(_sent(*map(np.concatenate, zip(*held)), some_buckets, some_groups), apart)
                    held, count = [], 0
        if count:
            yield from _rows(_sent(*map(np.concatenate, zip(*held)), some_buckets, some_groups), apart)

    def compared(table: pa.Table) -> pa.Table:
        key = table.column("key")[0].as_py()
        bodies = [b.as_py() for b in table.column("body")]
        if key < 0:  # lost in its own task: nothing to compare
            found = [(key, b) for b in bodies]
        else:
            hashes, ids, group = _distinct(*map(np.concatenate, zip(*map(_opened, bodies))))
            starts = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
            least = np.repeat(np.minimum.reduceat(ids, starts), np.diff(np.r_[starts, len(ids)]))
            lost = ids > least
            found = list(_losses(hashes[lost], ids[lost], group[lost], some_groups))
        none = [pa.RecordBatch.from_pylist([], ROWS)]
        return pa.Table.from_batches(list(_rows(iter(found), apart)) or none, ROWS)

    sent = rows.mapInArrow(hashed, ROW)
    if buckets > some_buckets:
        sent = _dealt_again(sent, buckets, some_groups, losses=False)
    lost = sent.groupBy("key", "piece").applyInArrow(compared, ROW)
    if groups > some_groups:
        lost = _dealt_again(lost, buckets, groups, losses=True)
    return lost.select((-1 - F.col("key")).alias("group"), "body")


def intervals(places: np.ndarray, k: int) -> list[tuple[int, int]]:
    """Maximal word intervals covered by windows of k words that start at the sorted places."""
    if not len(places):
        return []
    breaks = np.flatnonzero(np.diff(places) > k)
    starts = places[np.r_[0, breaks + 1]]
    ends = places[np.r_[breaks, len(places) - 1]] + k
    return list(zip(starts.tolist(), ends.tolist()))


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 13,
) -> DataFrame:
    """One row per input row: doc_id, n_words, removed (word intervals), kept (words joined by a space).

    A word is a run of characters other than ASCII blanks. Every window of k words is hashed to 64
    bits; a window goes if an equal one starts in a document with a smaller id. Removed windows of a
    document merge to maximal intervals. The windows are those of the input. Each map task sends a
    hash once, with its smallest id, so a passage in a third of all documents reaches one
    bucket as often as there are tasks. Equality is that of 64-bit hashes: two of n
    windows that differ meet by chance about n^2 / 2^65 times.

    Null text has no words. Rows without an id count as later than all others; neither they nor
    rows that share an id take anything from each other, whatever their texts. Losses are told
    apart by id and hash and looked up in each text's own windows. Rows are dealt to groups by id
    and text, so only equal rows must meet. Buckets and groups grow with the input; a task deals to
    ``rolling.FAN`` of them at the most and beyond that in two turns. Other columns are not read.
    """
    rows = narrowed(docs, id_col, text_col)
    size = text_bytes(rows)
    buckets = max(96, size // HASH_BUCKET_BYTES)
    groups = max(96, size // TEXT_BUCKET_BYTES)
    rows = rows.withColumn("group", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int"))
    lost = repeated_windows(rows, k, buckets, groups)

    def cut(key: tuple, texts: pa.Table, gone: pa.Table) -> pa.Table:
        opened = [_opened(body.as_py())[:2] for body in gone.column("body")]
        lost, ids = map(np.concatenate, zip(*opened)) if opened else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        order = np.lexsort((lost, ids))
        lost, ids = lost[order], ids[order]
        out: dict[str, list] = {"doc_id": [], "n_words": [], "removed": [], "kept": []}
        for batch in texts.select(["doc_id", "text"]).to_batches():
            for first, last, data, offsets in runs(batch):
                hashes, text, _ = words_of(data, offsets, lower=False).windows(k)
                edges = sliced(text, last - first)
                for i in range(first, last):
                    number = batch.column(0)[i].as_py()
                    wanted = NO_ID if number is None else np.int64(number)
                    a, z = np.searchsorted(ids, wanted, "left"), np.searchsorted(ids, wanted, "right")
                    own = hashes[edges[i - first]:edges[i - first + 1]]
                    words = batch.column(1)[i].as_py().encode().split()
                    found = intervals(np.flatnonzero(np.isin(own, lost[a:z])), k) if z > a else []
                    keep = np.ones(len(words), bool)
                    for start, end in found:
                        keep[start:end] = False
                    out["doc_id"].append(number)
                    out["n_words"].append(len(words))
                    out["removed"].append([{"start": s, "end": e} for s, e in found])
                    out["kept"].append((b" ".join(compress(words, keep)) if found else b" ".join(words)).decode())
        return pa.table(out, schema=CUT)

    return rows.select("group", "doc_id", "text").groupBy("group").cogroup(lost.groupBy("group")).applyInArrow(
        cut, "doc_id long, n_words long, removed array<struct<start:long,end:long>>, kept string"
    )


CUT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()),
    ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.string()),
])


def digests(cuts: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of ``remove_repeats``."""
    return cuts.select(
        "doc_id", "n_words",
        F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
