"""How filters of documents interact: what each removes, in every order in which they can be applied."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.byte_spans import Spans, pieces, utf8_buffer
from millrace.llm.common import BLANKS, written

FILTERS = "ABCDE"
#: Fixed values of the filters.
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, SYMBOLS = 100, 80, 10, "#$%&*|"

# Classes of bytes, states of the transducer, and what a step puts out.
GAP, PLAIN, CAPITAL, SYMBOL, FOLLOWING = range(5)
OUTSIDE, INSIDE = 0, 1
OPENS, CLOSES, IS_CAPITAL, IS_SYMBOL, IS_FOLLOWING = 1, 2, 4, 8, 16


def _class_of_bytes() -> np.ndarray:
    found = np.full(256, PLAIN, np.uint8)
    found[[ord(c) for c in BLANKS]] = GAP
    found[ord("A"):ord("Z") + 1] = CAPITAL
    found[[ord(c) for c in SYMBOLS]] = SYMBOL
    found[0x80:0xC0] = FOLLOWING
    return found


def _outputs() -> np.ndarray:
    """Output of a step at 5 * state before + class of byte."""
    found = np.zeros((2, 5), np.uint8)
    for kind, mark in ((CAPITAL, IS_CAPITAL), (SYMBOL, IS_SYMBOL), (FOLLOWING, IS_FOLLOWING)):
        found[:, kind] |= mark
    found[OUTSIDE, 1:] |= OPENS
    found[INSIDE, GAP] |= CLOSES
    return found.ravel()


CLASS_OF_BYTE = _class_of_bytes()
#: The state after a byte follows from its class alone, so the states of a whole piece are one look-up.
NEXT_STATE = np.array([OUTSIDE] + 4 * [INSIDE], np.uint8)
OUTPUT = _outputs()
IS_WORD = CLASS_OF_BYTE != GAP


class Counts:
    """Counts of each text of a buffer, from one pass over its bytes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self._data, self._offsets = data, offsets
        n = len(offsets) - 1
        self.words, self.distinct, self.capitals, self.points, self.symbols = (np.zeros(n, np.int64) for _ in range(5))
        spans = Spans(data)
        for begin, end in pieces(data, offsets, IS_WORD):
            if begin in offsets[np.searchsorted(offsets, begin):][:1]:
                spans.clear()
            self._add(begin, end, spans)

    def _add(self, begin: int, end: int, spans: Spans) -> None:
        kinds = CLASS_OF_BYTE[self._data[begin:end]]
        state = NEXT_STATE[kinds]
        before = np.empty_like(state)
        before[0], before[1:] = OUTSIDE, state[:-1]
        first = int(np.searchsorted(self._offsets, begin, "right")) - 1
        upto = int(np.searchsorted(self._offsets, end, "left"))
        bounds = np.clip(self._offsets[first:upto + 1] - begin, 0, end - begin)
        inner = np.unique(bounds[(bounds > 0) & (bounds < end - begin)])
        cut = inner[state[inner - 1] == INSIDE]  # words that a text's end closes
        before[inner] = OUTSIDE
        out = OUTPUT.take(5 * before + kinds)
        for total, mark in ((self.capitals, IS_CAPITAL), (self.symbols, IS_SYMBOL)):
            total[first:upto] += np.diff(np.searchsorted(np.flatnonzero(out & mark), bounds))
        following = np.diff(np.searchsorted(np.flatnonzero(out & IS_FOLLOWING), bounds))
        self.points[first:upto] += np.diff(bounds) - following
        starts, ends = np.flatnonzero(out & OPENS), np.flatnonzero(out & CLOSES)
        last = [end - begin] if state[-1] == INSIDE else []
        ends = np.sort(np.concatenate([ends, cut, np.array(last, np.int64)]))
        self.words[first:upto] += np.diff(np.searchsorted(starts, bounds))
        known = spans.count
        owners = first + np.searchsorted(bounds, starts, "right") - 1
        spans.insert(starts + begin, ends - starts, owners)
        self.distinct[first:upto] += np.bincount(spans.owners(known) - first, minlength=upto - first)


MEASURES = ("doc_id long, part string, body binary, n_words long, n_distinct long, n_capitals long, n_points long, "
            "n_symbols long")


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row per input row: doc_id, part, body (SHA-256 of the text), n_words, n_distinct, n_capitals, n_points, n_symbols.

    One pass of a byte transducer over the UTF-8 of each text counts words (maximal runs without
    ASCII blanks), A-Z, code points and ``SYMBOLS``, and puts each word's span into a hash
    table that compares bytes, for the count of distinct words. Texts are read in pieces cut behind a
    gap, so memory does not follow the longest text beyond the text itself and its distinct words.
    Null text counts as empty, null part as the empty string. Other columns are not read; repeated
    rows are measured each for itself; an empty table gives no rows.
    """
    rows = docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[part_col].cast("string"), F.lit("")).alias("part"),
        F.coalesce(docs[text_col], F.lit("")).alias("text"),
    )

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split(" ")[0] for c in MEASURES.split(", ")]
        for batch in batches:
            data, offsets = utf8_buffer(batch.column(2))
            found = Counts(data, offsets)
            body = [hashlib.sha256(data[a:b]).digest() for a, b in zip(offsets[:-1], offsets[1:])]
            counts = (found.words, found.distinct, found.capitals, found.points, found.symbols)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(body, pa.binary()), *map(pa.array, counts)], names
            )

    return rows.mapInArrow(measured, MEASURES)


def with_text_failures(measured: DataFrame) -> DataFrame:
    """``measured`` with ``fails``, the letters of the filters that the text itself fails, in order.

    A: under ``LEAST_WORDS`` words; B: distinct words under ``DISTINCT_PERCENT`` of the words; C: A-Z
    over ``CAPITAL_PERCENT`` of the code points; D: holds one of ``SYMBOLS``.
    """
    conditions = {
        "A": F.col("n_words") < LEAST_WORDS,
        "B": 100 * F.col("n_distinct") < DISTINCT_PERCENT * F.col("n_words"),
        "C": 100 * F.col("n_capitals") > CAPITAL_PERCENT * F.col("n_points"),
        "D": F.col("n_symbols") > 0,
    }
    return measured.withColumn("fails", F.concat(*[F.when(c, x).otherwise("") for x, c in conditions.items()]))


def failure_counts(failing: DataFrame) -> DataFrame:
    """(part, fails, n, n_good, n_toxic) of rows doc_id, part, body, fails, good, toxic, with filter E added.

    E: a smaller id has the same text; texts count as the same by their SHA-256. Of each text and
    part only the sums and the rows of the smallest id leave a map task, so copies that are a third of
    all rows never meet; then the smallest id of a text over all parts tells which rows do not fail.
    A row without an id never fails E and fails nobody; rows that repeat an id do not fail each other.
    """
    sums = lambda name: F.sum(name).alias(name)
    alone = failing.where(F.col("doc_id").isNull()).groupBy("part", "fails").agg(
        F.count(F.lit(1)).alias("n"), sums("good").alias("n_good"), sums("toxic").alias("n_toxic")
    )
    by_id = failing.where(F.col("doc_id").isNotNull()).groupBy("body", "part", "doc_id").agg(
        F.min("fails").alias("fails"), F.count(F.lit(1)).alias("n"), F.sum("good").alias("n_good"), F.sum("toxic").alias("n_toxic")
    )
    by_part = by_id.groupBy("body", "part").agg(
        F.min("fails").alias("fails"), sums("n"), sums("n_good"), sums("n_toxic"),
        F.min(F.struct("doc_id", "n", "n_good", "n_toxic")).alias("lead"),
    )
    firsts = by_part.groupBy("body").agg(F.min("lead.doc_id").alias("first"), F.count(F.lit(1)).alias("parts"))
    elsewhere = firsts.where(F.col("parts") > 1).select(F.col("body").alias("of_body"), "first")
    joined = by_part.join(elsewhere, F.col("body") == F.col("of_body"), "left")
    leads = F.coalesce(F.col("lead")["doc_id"] == F.col("first"), F.lit(True))
    kept = {c: F.when(leads, F.col("lead")[c]).otherwise(F.lit(0)) for c in ("n", "n_good", "n_toxic")}
    sides = F.explode(F.array(
        F.struct(F.col("fails").alias("fails"), *[x.alias(c) for c, x in kept.items()]),
        F.struct(F.concat("fails", F.lit("E")).alias("fails"), *[(F.col(c) - x).alias(c) for c, x in kept.items()]),
    ))
    told_apart = joined.select("part", sides.alias("side")).select("part", "side.*").where("n > 0")
    return told_apart.unionByName(alone).groupBy("part", "fails").agg(sums("n"), sums("n_good"), sums("n_toxic"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step: see ``interactions``; ``labels`` has doc_id, quality, toxic.

    A document counts as good (toxic) if any row of ``labels`` with its id has quality (toxic) 1.
    Documents without labels, and without an id, are neither. Measures are written once, since
    copies are found on them; documents are then counted by part and set of failed filters, at
    most 32 rows a part, and only these counts meet the orders.
    """
    failing = with_text_failures(written(measure(docs, id_col, text_col, part_col), "filter-measures"))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("of_id")).agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("long")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("long")), F.lit(0)).alias("toxic"),
    ).where("good + toxic > 0")
    marked = failing.select("doc_id", "part", "body", "fails").join(marks, F.col("doc_id") == F.col("of_id"), "left")
    zeros = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("good", "toxic")}
    return interactions(failure_counts(marked.withColumns(zeros)))


def interactions(counts: DataFrame) -> DataFrame:
    """Of ``counts`` (part, fails, n, n_good, n_toxic): one row per part, filter_order and step, zeros included.

    kept: documents left after the step; removed: gone at it; redundant: failing its filter but gone
    before; unique_fails: failing its filter alone; good_lost, toxic_lost: good and toxic ones of
    removed; shapley: its filter's removed over all orders. Of the n! orders a failed
    filter comes first among k failed ones in n! / k, which gives shapley without adding up orders.
    """
    orders = ["".join(p) for p in permutations(FILTERS)]
    order = F.explode(F.split(F.lit(",".join(orders)), ",")).alias("filter_order")
    stepped = counts.select("*", order).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step")
    )
    letter = F.expr("substring(filter_order, step, 1)")
    fails_it = F.contains("fails", letter)
    gone = F.expr("translate(fails, substring(filter_order, 1, step - 1), '') <> fails")
    total = lambda condition, what: F.sum(F.when(condition, what).otherwise(F.lit(0))).cast("long")
    share = F.expr(f"n * {len(orders)} div length(fails)")
    return stepped.groupBy("part", "filter_order", "step").agg(
        total(~fails_it & ~gone, F.col("n")).alias("kept"),
        total(fails_it & ~gone, F.col("n")).alias("removed"),
        total(fails_it & gone, F.col("n")).alias("redundant"),
        total(F.col("fails") == letter, F.col("n")).alias("unique_fails"),
        total(fails_it & ~gone, F.col("n_good")).alias("good_lost"),
        total(fails_it & ~gone, F.col("n_toxic")).alias("toxic_lost"),
        total(fails_it, share).alias("shapley"),
    )
