"""SentencePiece merge-type (BPE) encoding by backtracking, and decoding."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from millrace.llm.common import narrowed

SPACE = "▁"
#: Encodings of words kept by a Python worker; the store is emptied when it is full.
KEPT_WORDS = 300_000
KEPT_CHARS = 48
#: A worker hands its rows on in batches of about so many bytes.
OUT_BYTES = 4 << 20
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6


class Vocabulary:
    """What encoding needs of a model file: pieces, scores and the kinds of ids."""

    def __init__(self, path: str):
        model = model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        trained, form = model.trainer_spec, model.normalizer_spec
        if trained.model_type != 2 or form.precompiled_charsmap or form.remove_extra_whitespaces:
            raise ValueError("only BPE models without a normalizer are supported")
        if trained.treat_whitespace_as_suffix or not (trained.byte_fallback and form.escape_whitespaces):
            raise ValueError("only models with byte fallback and escaped leading spaces are supported")
        if any(p.type not in (NORMAL, UNKNOWN, CONTROL, BYTE) for p in model.pieces):
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.dummy_prefix = form.add_dummy_prefix
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.byte_ids = [0] * 256
        self.surface = []
        for i, p in enumerate(model.pieces):
            if p.type == BYTE:
                value = int(p.piece[3:5], 16)
                self.byte_ids[value] = i
                self.surface.append(bytes([value]))
            elif p.type == CONTROL:
                self.surface.append(b"")
            elif p.type == UNKNOWN:
                self.surface.append(" ⁇ ".encode())
            else:
                self.surface.append(p.piece.replace(SPACE, " ").encode())
        self.begin, self.end = trained.bos_id, trained.eos_id
        # If no piece has a space after another character, no merge crosses a word's start.
        self.splits_at_spaces = not any(SPACE in piece.lstrip(SPACE) for piece in self.ids)


class Encoder:
    """Backtracking encoder.

    A sequence of pieces is the result of merging if and only if each piece merges to itself and no
    merge crosses a border of two neighbours, that is, merging the two together gives the two.
    So the encoder walks forward with the longest piece at each place, takes the next shorter one
    where the neighbour does not fit, and steps back where none fits. The pieces before a place
    are the only ones its prefix can have, so a place that failed once fails always: a bitfield
    keeps these, and the walk is linear but for the few steps back.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.matcher = ahocorasick.Automaton()
        for piece in vocabulary.ids:
            self.matcher.add_word(piece, (len(piece) - 1, piece))
        self.matcher.make_automaton()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.sound: dict[str, bool] = {}
        known = "".join(re.escape(p) for p in vocabulary.ids if len(p) == 1)
        self.runs = re.compile(f"([{known}]+)")
        self.chunks = re.compile(" *[^ ]+| +") if vocabulary.splits_at_spaces else re.compile("(?s).+")

    def merged(self, text: str) -> list[str]:
        """Plain merging: the best-scored neighbouring pair first, the leftmost of equals."""
        parts, scores = list(text), self.v.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def whole(self, piece: str) -> bool:
        """Whether merging the piece's characters gives the piece."""
        answer = self.sound.get(piece)
        if answer is None:
            answer = self.sound[piece] = self.merged(piece) == [piece]
        return answer

    def fit(self, left: str, right: str) -> bool:
        answer = self.pairs.get((left, right))
        if answer is None:
            if len(self.pairs) > KEPT_WORDS:
                self.pairs.clear()
            answer = self.pairs[left, right] = self.merged(left + right) == [left, right]
        return answer

    def shorter(self, piece: str) -> str | None:
        ids = self.v.ids
        for k in range(len(piece) - 1, 0, -1):
            if piece[:k] in ids:
                return piece[:k]
        return None

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text all of whose characters are pieces."""
        size, known = len(text), self.pairs.get
        longest: list[str] = [""] * size
        for last, (back, piece) in self.matcher.iter(text):  # by rising end: of one start the longest comes last
            longest[last - back] = piece
        failed = bytearray(size // 8 + 1)
        found: list[str] = []
        at, piece, left = 0, longest[0], ""
        while at < size:
            end = at + len(piece)
            if not failed[end >> 3] >> (end & 7) & 1:
                if not left:
                    fits = self.whole(piece)
                else:  # two pieces that stay apart are each whole
                    fits = known((left, piece))
                    if fits is None:
                        fits = self.fit(left, piece)
                if fits:
                    found.append(piece)
                    at, left = end, piece
                    if at < size:
                        piece = longest[at]
                    continue
            less = self.shorter(piece)
            if less is not None:
                piece = less
                continue
            if not found:
                raise ValueError(f"no encoding of {text[:40]!r}")
            failed[at >> 3] |= 1 << (at & 7)
            piece = found.pop()
            at -= len(piece)
            left = found[-1] if found else ""
        return found

    def chunk_ids(self, chunk: str) -> list[int]:
        out: list[int] = []
        for i, run in enumerate(self.runs.split(chunk.replace(" ", SPACE))):
            if i % 2:
                out += map(self.v.ids.__getitem__, self.pieces(run))
            else:  # characters that are no piece never merge
                out += map(self.v.byte_ids.__getitem__, run.encode())
        return out


class KeptWords(dict):
    """Word -> its ids as little-endian bytes, encoded when first asked for; holds a bounded number."""

    def __init__(self, encoder: Encoder, lead: str):
        super().__init__()
        self.encoder, self.lead = encoder, lead

    def __missing__(self, word: str) -> bytes:
        packed = array("I", self.encoder.chunk_ids(self.lead + word)).tobytes()
        if len(word) <= KEPT_CHARS:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = packed
        return packed


class Codec:
    """Encodes texts to packed ids and decodes ids, with begin and end ids."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.encoder = Encoder(vocabulary)
        self.words = KeptWords(self.encoder, " ")
        self.spans = KeptWords(self.encoder, "")
        self.first = np.array([vocabulary.begin], "<u4").tobytes()
        self.last = np.array([vocabulary.end], "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        return self.first + self.body(text.replace(SPACE, " ")) + self.last

    def body(self, text: str) -> bytes:
        if not text:
            return b""
        if self.v.dummy_prefix and self.v.splits_at_spaces:
            words = text.split(" ")
            if "" not in words:
                return b"".join(map(self.words.__getitem__, words))
        lead = " " if self.v.dummy_prefix else ""
        return b"".join(map(self.spans.__getitem__, self.encoder.chunks.findall(lead + text)))

    def decode(self, ids: bytes) -> str:
        """The text of packed ids; control ids have no text, the dummy space in front goes."""
        found = b"".join(map(self.v.surface.__getitem__, array("I", ids)))
        if self.v.dummy_prefix and found.startswith(b" "):
            found = found[1:]
        return found.decode("utf-8", "replace")


def tokenize(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, ids (little-endian unsigned 32-bit integers), decoded.

    The ids, with begin and end ids, are those of merging the whole text; null text is empty text
    and gives the begin and end ids alone. A space sign U+2581 in a text is a space, as in the
    model, and decodes as one. ``model_path`` is read on the driver only; the vocabulary travels with
    the task. Words of a text share a bounded store of encodings, which changes no result. Other
    columns are not read; repeated rows and ids are encoded each for itself.
    """
    rows = narrowed(docs, id_col, text_col)
    shared = rows.sparkSession.sparkContext.broadcast(Vocabulary(model_path))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in batches:
            ids, packed, texts, size = [], [], [], 0
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                one = codec.encode(text.as_py())
                ids.append(doc_id.as_py())
                packed.append(one)
                texts.append(codec.decode(one))
                size += 2 * len(one)
                if size >= OUT_BYTES:
                    yield _batch(ids, packed, texts)
                    ids, packed, texts, size = [], [], [], 0
            if ids:
                yield _batch(ids, packed, texts)

    return rows.mapInArrow(encoded, "doc_id long, ids binary, decoded string")


_CODECS: dict[int, Codec] = {}


def _codec(shared) -> Codec:
    """One codec for all tasks of a Python worker."""
    key = id(shared.value)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(shared.value)
    return _CODECS[key]


def _batch(ids: list, packed: list[bytes], texts: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(packed, pa.binary()), pa.array(texts, pa.string())],
        ["doc_id", "ids", "decoded"],
    )
