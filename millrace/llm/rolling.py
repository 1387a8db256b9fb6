"""Word and window hashes over whole batches of texts, and packed columns for shuffles (numpy)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard

#: Multipliers (odd), their inverses modulo 2^64, and the seed of the byte table.
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
SEED = 20240229
MASK = (1 << 64) - 1
#: Texts are hashed in runs of about so many bytes.
RUN_BYTES = 2 << 20
#: A task deals what it holds to so many buckets at the most; beyond, rows are dealt a second time.
FAN = 4096

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_VALUES = np.random.default_rng(SEED).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER_VALUES = _VALUES.copy()
_LOWER_VALUES[65:91] = _VALUES[97:123]


def _powers(base: int, n: int, kept: dict[int, np.ndarray] = {}) -> np.ndarray:  # noqa: B006
    """base^0 .. base^(n-1) modulo 2^64."""
    have = kept.get(base)
    if have is None or len(have) < n:
        size = max(1 << 12, 1 << (n - 1).bit_length())
        have = np.empty(size, np.uint64)
        have[0] = 1
        done = 1
        while done < size:
            step = min(done, size - done)
            have[done:done + step] = have[:step] * np.uint64(pow(base, done, 1 << 64))
            done += step
        if size <= 1 << 23:
            kept[base] = have
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the argument."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _ranges(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rabin-Karp hash of each range, by differences of one running sum."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(base, len(values)), out=sums[1:])
    inverse = pow(base, -1, 1 << 64)
    return mixed((sums[ends] - sums[starts]) * _powers(inverse, len(values) + 1)[starts])


@dataclass
class Words:
    """Words of consecutive texts: hash of each, and where each text's words begin (one more entry)."""

    hashes: np.ndarray
    first: np.ndarray

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, text and place of every run of k words inside one text."""
        n = np.maximum(np.diff(self.first) - (k - 1), 0)
        text = np.repeat(np.arange(len(n)), n)
        begins = np.cumsum(n) - n
        at = np.arange(len(text)) - begins[text]
        start = self.first[text] + at
        return _ranges(self.hashes, WORD_BASE, start, start + k), text, at

    def whole(self) -> np.ndarray:
        """One hash of each text's whole word sequence, with its length."""
        count = np.diff(self.first)
        return mixed(_ranges(self.hashes, WORD_BASE, self.first[:-1], self.first[1:]) + count.astype(np.uint64))


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool) -> Words:
    """Words (runs of anything but ASCII blanks) of the UTF-8 texts that ``offsets`` cut from ``data``."""
    inside = ~_BLANK[data]
    opens, closes = inside.copy(), inside.copy()
    if len(data) > 1:
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    opens[cuts] = inside[cuts]
    closes[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    table = _LOWER_VALUES if lower else _VALUES
    first = np.searchsorted(starts, offsets)
    return Words(_ranges(table[data], BYTE_BASE, starts, ends) if len(data) else np.zeros(0, np.uint64), first)


def runs(batch: pa.RecordBatch, column: int = 1) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last row, bytes and offsets of runs of whole texts of a batch."""
    texts = batch.column(column)
    if pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.string())
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + RUN_BYTES, "right")) - 1)
        yield at, end, data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at]
        at = end


def packed(*columns: np.ndarray) -> bytes:
    """Integer columns of one length, byte plane by byte plane, compressed; the first is sorted and kept as steps."""
    planes = [len(columns[0]).to_bytes(8, "little")]
    for i, column in enumerate(columns):
        wide = column.astype(np.uint64)
        if i == 0 and len(wide):
            wide = np.diff(wide, prepend=np.uint64(0))
        planes.append(np.ascontiguousarray(wide.view(np.uint8).reshape(-1, 8).T).tobytes())
    return zstandard.compress(b"".join(planes), 1)


def unpacked(blob: bytes, columns: int) -> list[np.ndarray]:
    data = zstandard.decompress(blob)
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(data, np.uint8, offset=8).reshape(columns, 8, n)
    found = [np.ascontiguousarray(p.T).reshape(-1).view(np.uint64) for p in planes]
    if n:
        found[0] = np.cumsum(found[0], dtype=np.uint64)
    return found


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by the leading bits, so that sorted hashes have sorted buckets."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def parts(keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Each value of sorted keys, and where its rows begin and end; the work follows the rows, not the range of keys."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    yield from zip(keys[starts].tolist(), starts.tolist(), np.r_[starts[1:], len(keys)].tolist())


def sliced(keys: np.ndarray, groups: int) -> np.ndarray:
    """Where each of ``groups`` begins in sorted group numbers (one more entry)."""
    return np.searchsorted(keys, np.arange(groups + 1))
