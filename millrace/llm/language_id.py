"""Language identification by compression with per-language zstandard dictionaries."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import smallest_hashes, written

LETTER = re.compile(r"[^\W\d_]")
NO_LETTERS = re.compile(r"[\W\d_]+")
SEGMENT = 4096
LEVEL = 3


def train(
    docs: DataFrame, chosen: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    texts_per_language: int = 64, max_chars: int = 20_000, dictionary_bytes: int = 100_000,
) -> dict[str, bytes]:
    """Dictionary content per language, from a bounded sample of labelled rows.

    Of the rows that ``chosen`` allows, with a language and 1 to ``max_chars`` characters, each
    language gives the ``texts_per_language`` ones with the smallest hash of the id, whole; their
    bytes up to ``dictionary_bytes`` are the dictionary. Ties of hash go to the smaller text.
    """
    rows = docs.where(chosen).select(
        docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"), docs[lang_col].alias("lang")
    ).where("lang is not null and text is not null and text != '' and doc_id is not null").where(
        F.length("text") <= max_chars
    )
    usable = written(rows.select("lang", "doc_id"), "language-ids")
    wanted = [r["doc_id"] for r in smallest_hashes(usable, "lang", "doc_id", texts_per_language).collect()]
    content: dict[str, bytearray] = {}
    sample = rows.where(F.col("doc_id").isin(wanted)) if wanted else rows.limit(0)
    for r in sorted(sample.collect(), key=lambda r: (r["lang"], r["doc_id"], r["text"])):
        content.setdefault(r["lang"], bytearray()).extend(plain(r["text"]).encode() + b" ")
    return {lang: bytes(body[-dictionary_bytes:]) for lang, body in content.items()}


def plain(text: str) -> str:
    """Lower-case letters, anything else a space: case, digits and marks say little of a language."""
    return NO_LETTERS.sub(" ", text.lower())


class Sizes:
    """Compressed size of a text under each language's dictionary."""

    def __init__(self, content: dict[str, bytes]):
        self.languages = sorted(content)
        self.compressors = []
        for lang in self.languages:
            words = zstandard.ZstdCompressionDict(content[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(
                dict_data=words, write_checksum=False, write_content_size=False, write_dict_id=False
            ))

    def of(self, text: str) -> list[int]:
        """Summed over segments of the whole text, so that a long text is not its own dictionary."""
        data = plain(text).encode()
        parts = [data[i:i + SEGMENT] for i in range(0, len(data), SEGMENT)] or [b""]
        return [sum(len(c.compress(p)) for p in parts) for c in self.compressors]


def identify(
    docs: DataFrame, content: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text",
    margin: float = 0.01,
) -> DataFrame:
    """One row per input row: doc_id, lang (smallest compressed size), score, narrow.

    ``score`` grows from 0 to 1 with the share that the best size is below the second; it is 1 if
    there is one language. ``narrow`` says that the share is under ``margin``: such an answer is to
    be rejected. A null text, one without a letter, and all texts if ``content`` is empty, get
    ``und``, score 0 and ``narrow``. Equal sizes go to the language that sorts first. Other columns
    are not read.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    shared = rows.sparkSession.sparkContext.broadcast(content)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(shared.value)
        for batch in batches:
            langs, scores, narrow = [], [], []
            for value in batch.column(1):
                text = value.as_py()
                if not sizes.languages or not text or not LETTER.search(text):
                    best, share = "und", 0.0
                else:
                    ranked = sorted(zip(sizes.of(text), sizes.languages))
                    best = ranked[0][1]
                    share = 1.0 if len(ranked) == 1 else 1 - ranked[0][0] / ranked[1][0]
                langs.append(best)
                scores.append(min(1.0, share * 4))
                narrow.append(share < margin)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(narrow, pa.bool_())],
                ["doc_id", "lang", "score", "narrow"],
            )

    return rows.mapInArrow(scored, "doc_id long, lang string, score double, narrow boolean")
