"""Sampling documents by importance for a target distribution of hashed word n-grams."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.byte_spans import Spans, pieces, utf8_buffer
from millrace.llm.common import written

BUCKETS, WORDS_A_FEATURE = 10_000, 3
MATRIX_BYTES, LEAST_ROWS = 1 << 22, 8
_WORD_BITS = 21


def _is_word() -> np.ndarray:
    """Digits, letters A-Z and a-z, and all bytes of characters beyond ASCII."""
    found = np.zeros(256, bool)
    for first, last in (("0", "9"), ("A", "Z"), ("a", "z")):
        found[ord(first):ord(last) + 1] = True
    found[0x80:] = True
    return found


def _normal() -> np.ndarray:
    """A-Z in lower case, every byte outside words a space."""
    found = np.where(IS_WORD, np.arange(256), ord(" ")).astype(np.uint8)
    found[ord("A"):ord("Z") + 1] += 32
    return found


def _crc_steps() -> np.ndarray:
    """What a byte does to a CRC-32 (reflected polynomial 0xEDB88320)."""
    found = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        found = (found >> 1) ^ np.where(found & 1, np.uint32(0xEDB88320), np.uint32(0))
    return found


IS_WORD = _is_word()
NORMAL = _normal()
CRC_STEP = _crc_steps()


def crc_of_spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of spans of ``data``.

    Spans of equal length form a matrix of bytes, and the CRCs of all its rows advance column by
    column; the results go back to the places of their spans. A matrix holds ``MATRIX_BYTES`` at
    most. Where under ``LEAST_ROWS`` spans share a length, zlib gives the same value row by row.
    """
    found = np.empty(len(starts), np.uint32)
    order = np.argsort(lengths, kind="stable")
    bounds = np.flatnonzero(np.diff(lengths[order], prepend=-1, append=-1))
    for first, upto in zip(bounds[:-1], bounds[1:]):
        length = int(lengths[order[first]])
        if upto - first < LEAST_ROWS:
            for i in order[first:upto]:
                found[i] = zlib.crc32(data[starts[i]:starts[i] + length])
            continue
        windows = np.lib.stride_tricks.sliding_window_view(data, length)
        rows = max(LEAST_ROWS, MATRIX_BYTES // length)
        for begin in range(first, upto, rows):
            mine = order[begin:min(begin + rows, upto)]
            matrix = np.asfortranarray(windows[starts[mine]])
            crc = np.full(len(mine), 0xFFFFFFFF, np.uint32)
            for column in matrix.T:
                crc = CRC_STEP[(crc ^ column) & 0xFF] ^ (crc >> 8)
            found[mine] = ~crc
    return found


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per piece of the texts: the buckets of its different features, and for every occurrence which one and whose.

    Features are told apart by the numbers of their words, which come from comparing bytes. A long
    text is cut into pieces; the last two words before a cut are put in front of the next piece, so
    that no feature across a cut is missed, and only features that end behind them count there.
    """
    carried, owner_carried = b"", -1
    for begin, end in pieces(data, offsets, IS_WORD):
        first = int(np.searchsorted(offsets, begin, "right")) - 1
        goes_on = begin > offsets[first] and first == owner_carried
        lead = carried if goes_on else b""
        shift = begin - len(lead)
        raw = np.concatenate([np.frombuffer(lead, np.uint8), data[begin:end]])
        inside = IS_WORD[raw]
        before = np.concatenate([[False], inside[:-1]])
        upto = int(np.searchsorted(offsets, end, "left"))
        inner = offsets[first + 1:upto] - shift
        inner = inner[inner < len(raw)]
        before[inner] = False
        starts = np.flatnonzero(inside & ~before)
        closes = inside & ~np.concatenate([inside[1:], [False]])
        cut = inner[inner > 0] - 1
        closes[cut[inside[cut]]] = True
        lengths = np.flatnonzero(closes) + 1 - starts
        owners = first + np.searchsorted(inner, starts, "right")
        tail = owners == upto - 1
        owner_carried = upto - 1
        keep = starts[tail][-(WORDS_A_FEATURE - 1):]
        carried = raw[keep[0]:].tobytes() if len(keep) else b""
        known = int(np.searchsorted(starts, len(lead)))
        yield from _of_piece(NORMAL[raw], starts, lengths, owners, known)


def _of_piece(normal, starts, lengths, owners, known):
    """Words one after the other with a space behind each, so that every run of words is one span."""
    if len(starts) <= known:
        return
    behind = np.cumsum(lengths + 1)
    packed = np.full(int(behind[-1]) + 8, ord(" "), np.uint8)
    at = behind - lengths - 1
    place = np.arange(int(lengths.sum())) + np.repeat(np.arange(len(starts)), lengths)
    packed[place] = normal[place - np.repeat(at, lengths) + np.repeat(starts, lengths)]
    numbers = Spans(packed).insert(at, lengths, np.zeros(len(at), np.int64)) + 1
    codes, begins, sizes, whose = [], [], [], []
    for n in range(1, WORDS_A_FEATURE + 1):
        last = np.arange(max(n - 1, known), len(starts))
        one = last - (n - 1)
        one, last = (x[owners[one] == owners[last]] for x in (one, last))
        code = np.zeros(len(one), np.int64)
        for j in range(n):
            code = (code << _WORD_BITS) | numbers[one + j]
        codes.append(code)
        begins.append(at[one])
        sizes.append(at[last] + lengths[last] - at[one])
        whose.append(owners[one])
    codes, begins, sizes, whose = map(np.concatenate, (codes, begins, sizes, whose))
    order = np.argsort(codes)
    new = np.diff(codes[order], prepend=-1) != 0
    which = np.empty(len(codes), np.int64)
    which[order] = np.cumsum(new) - 1
    picked = order[new]
    yield crc_of_spans(packed, begins[picked], sizes[picked]).astype(np.int64) % BUCKETS, which, whose


def bucket_counts(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """(bucket, n): occurrences of features over all texts, whole; at most ``BUCKETS`` rows leave a task."""
    rows = texts.select(F.coalesce(texts[text_col], F.lit("")).alias("text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for buckets, which, _ in features(*utf8_buffer(batch.column(0))):
                each = np.bincount(which, minlength=len(buckets))
                total += np.bincount(buckets, each, BUCKETS).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    return rows.mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, text_col: str = "text", target_col: str = "text") -> list[int]:
    """The gain of each bucket, in thousandths: how much likelier it is in ``target``, one added to every count.

    At most ``BUCKETS`` rows of counts come to the driver, however many texts there are.
    """
    s, t = (dict(map(tuple, bucket_counts(d, c).collect())) for d, c in ((docs, text_col), (target, target_col)))
    s_all, t_all = float(sum(s.values()) + BUCKETS), float(sum(t.values()) + BUCKETS)
    return [
        math.floor(1000 * math.log((t.get(b, 0) + 1) * s_all / ((s.get(b, 0) + 1) * t_all))) for b in range(BUCKETS)
    ]


def weigh(docs: DataFrame, gains: list[int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_features, weight (the sum of the gains of its features)."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    shared = rows.sparkSession.sparkContext.broadcast(np.array(gains, np.int64))

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_buffer(batch.column(1))
            n_features, weight = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for buckets, which, whose in features(data, offsets):
                first, upto = int(whose.min()), int(whose.max()) + 1
                n_features[first:upto] += np.bincount(whose - first, minlength=upto - first)
                each = np.bincount(whose - first, shared.value[buckets][which], upto - first)
                weight[first:upto] += each.astype(np.int64)
            # n words make n + (n - 1) + (n - 2) features, fewer for one word
            words = np.where(n_features > 1, (n_features + WORDS_A_FEATURE) // WORDS_A_FEATURE, n_features)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words), pa.array(n_features), pa.array(weight)],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    return rows.mapInArrow(weighed, "doc_id long, n_words long, n_features long, weight long")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42,
    id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_features, weight, score, rank (null where not drawn).

    Words are runs of digits, letters and characters beyond ASCII, A-Z in lower case; features are
    all runs of one to three words, put into ``BUCKETS`` by the CRC-32 of their bytes. A document's
    weight sums the gains of its features' buckets in ``target`` against ``docs``; its score adds
    Gumbel noise from a hash of the id, so the ``percent`` of the highest scores are a draw without
    replacement by importance. Only documents of ``least_words`` take part.

    Ranks are global without a global sort in one task: rows are split by ranges of score and
    id, and what stands in earlier ranges is added. Ties go to the smaller id; rows that
    repeat an id tie in an arbitrary, fixed order; a missing id counts as empty text in the
    hash and ranks behind its ties. Null text has no words and an empty ``docs`` gives no rows;
    an empty ``target`` counts as zero everywhere. Other columns are not read.
    """
    weighed = weigh(docs, bucket_gains(docs, target, text_col, target_col), id_col, text_col)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0))))
    scored = written(
        weighed.withColumn("score", F.col("weight") + noise).withColumn(
            "tie", F.xxhash64(F.monotonically_increasing_id())
        ), "importance-scores",
    )
    taking_part = F.col("n_words") >= least_words
    drawn = percent * scored.where(taking_part).count() // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "tie"]
    sorted_rows = written(
        scored.where(taking_part).repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id()), "importance-order",
    )
    part, within = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = dict(map(tuple, sorted_rows.groupBy(part.alias("part")).count().collect()))
    before, so_far = [], 0
    for i in range(max(sizes, default=-1) + 1):
        before.append(so_far)
        so_far += sizes.get(i, 0)
    ahead = F.get(F.array(*map(F.lit, before)), part.cast("int")) if before else F.lit(0)
    rank = (ahead + within + 1).cast("long")
    out = ["doc_id", "n_features", "weight", "score"]
    ranked = sorted_rows.select(*out, F.when(rank <= drawn, rank).alias("rank"))
    rest = scored.where(~taking_part).select(*out, F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(rest)
