"""Words as spans of bytes: table-driven passes over UTF-8 and a hash table of spans that compares bytes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20
SHORT = 64
_PAD = 8
_TAKEN = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2 ** 64 - 1], np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def utf8_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, ``_PAD`` zeros behind them, and where each text begins (one more: the end)."""
    whole = texts.cast(pa.large_string())
    if len(whole) == 0:
        return np.zeros(_PAD, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset:whole.offset + len(whole) + 1]
    raw = np.frombuffer(whole.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return np.concatenate([raw, np.zeros(_PAD, np.uint8)]), offsets - offsets[0]


def pieces(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, size: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of about ``size`` bytes that end with a text, or inside a long one right behind a gap byte.

    ``is_word`` tells the bytes of words by value. A word longer than ``size`` stays whole.
    """
    begin, end = 0, int(offsets[-1])
    while begin < end:
        stop = min(begin + size, end)
        if stop < end:
            text_end = int(offsets[np.searchsorted(offsets, stop, "right") - 1])
            if text_end > begin:
                stop = text_end
            else:
                stop = _behind_gap(data, is_word, begin, stop, int(offsets[np.searchsorted(offsets, begin, "right")]))
        yield begin, stop
        begin = stop


def _behind_gap(data: np.ndarray, is_word: np.ndarray, begin: int, stop: int, end: int) -> int:
    gaps = np.flatnonzero(~is_word[data[begin:stop]])
    if len(gaps):
        return begin + int(gaps[-1]) + 1
    while stop < end:
        upto = min(stop + PIECE_BYTES, end)
        gaps = np.flatnonzero(~is_word[data[stop:upto]])
        if len(gaps):
            return stop + int(gaps[0]) + 1
        stop = upto
    return end


class Spans:
    """A hash table of spans of one buffer, open addressing with linear probing, told apart by owner and bytes.

    A slot taken by an equal hash counts as found only after owner, length and bytes were compared.
    Spans up to ``SHORT`` bytes are hashed and compared eight bytes at a time for all spans together.
    """

    def __init__(self, data: np.ndarray):
        self._data = data
        self._eights = np.ndarray((len(data) - _PAD + 1,), "<u8", data, strides=(1,))
        self.clear()

    def clear(self) -> None:
        self.count = 0
        self._slots = np.full(1 << 10, -1, np.int32)
        self._kept = {n: np.empty(0, t) for n, t in (("start", "i8"), ("length", "i8"), ("owner", "i8"), ("hash", "u8"))}

    def owners(self, first: int = 0) -> np.ndarray:
        """Owner of each span kept since the span ``first``."""
        return self._kept["owner"][first:self.count]

    def insert(self, starts: np.ndarray, lengths: np.ndarray, owners: np.ndarray) -> np.ndarray:
        """The number of each span: numbers count the different (owner, bytes) in order of discovery."""
        hashes = self._hashes(starts, lengths, owners)
        self._make_room(len(starts))
        mask = len(self._slots) - 1
        slot = (hashes >> np.uint64(20)).astype(np.int64) & mask
        numbers, left = np.empty(len(starts), np.int64), np.arange(len(starts))
        while len(left):
            at = slot[left]
            self._claim(left, at, starts, lengths, owners, hashes)
            there = self._slots[at]
            same = self._same(left, there, starts, lengths, owners, hashes)
            numbers[left[same]] = there[same]
            left = left[~same]
            slot[left] = (slot[left] + 1) & mask
        return numbers

    def _claim(self, left, at, starts, lengths, owners, hashes) -> None:
        """Free slots go to one span each; of several that meet at a slot the last one written stays."""
        free = self._slots[at] < 0
        wanting, places = left[free], at[free]
        tried = np.arange(len(wanting), dtype=np.int32)
        self._slots[places] = tried
        won = self._slots[places] == tried
        new, places = wanting[won], places[won]
        upto = self.count + len(new)
        self._slots[places] = np.arange(self.count, upto, dtype=np.int32)
        for name, values in (("start", starts), ("length", lengths), ("owner", owners), ("hash", hashes)):
            self._kept[name][self.count:upto] = values[new]
        self.count = upto

    def _same(self, left, there, starts, lengths, owners, hashes) -> np.ndarray:
        kept = self._kept
        same = (kept["hash"][there] == hashes[left]) & (kept["length"][there] == lengths[left])
        same &= kept["owner"][there] == owners[left]
        mine, theirs, size = starts[left], kept["start"][there], lengths[left]
        check = np.flatnonzero(same & (size <= SHORT) & (mine != theirs))
        for done in range(0, SHORT, 8):
            check = check[size[check] > done]
            if not len(check):
                break
            taken = _TAKEN[np.minimum(size[check] - done, 8)]
            equal = (self._eights[mine[check] + done] & taken) == (self._eights[theirs[check] + done] & taken)
            same[check[~equal]] = False
            check = check[equal]
        for i in np.flatnonzero(same & (size > SHORT)):
            a, b, n = mine[i], theirs[i], size[i]
            same[i] = a == b or self._data[a:a + n].tobytes() == self._data[b:b + n].tobytes()
        return same

    def _hashes(self, starts, lengths, owners) -> np.ndarray:
        found = (owners.astype(np.uint64) + np.uint64(1)) * _MIX ^ lengths.astype(np.uint64)
        rest = np.flatnonzero(lengths <= SHORT)
        for done in range(0, SHORT, 8):
            rest = rest[lengths[rest] > done]
            if not len(rest):
                break
            some = self._eights[starts[rest] + done] & _TAKEN[np.minimum(lengths[rest] - done, 8)]
            mixed = (found[rest] ^ some) * _MIX
            found[rest] = mixed ^ (mixed >> np.uint64(29))
        for i in np.flatnonzero(lengths > SHORT):
            digest = hashlib.blake2b(self._data[starts[i]:starts[i] + lengths[i]], digest_size=8).digest()
            found[i] ^= np.uint64(int.from_bytes(digest, "little"))
        return found

    def _make_room(self, more: int) -> None:
        need = self.count + more
        if need > len(self._kept["start"]):
            for name, values in self._kept.items():
                self._kept[name] = np.concatenate([values[:self.count], np.empty(need, values.dtype)])
        if 2 * need > len(self._slots):
            self._slots = np.full(1 << (2 * need - 1).bit_length(), -1, np.int32)
            mask = len(self._slots) - 1
            slot, left = (self._kept["hash"][:self.count] >> np.uint64(20)).astype(np.int64) & mask, np.arange(self.count)
            while len(left):
                free = self._slots[slot[left]] < 0
                self._slots[slot[left[free]]] = left[free]
                left = left[self._slots[slot[left]] != left]
                slot[left] = (slot[left] + 1) & mask
