"""Line duplicates against levelled sorted runs of line hashes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import BLANKS, ascii_lower, narrowed, written

KEY = ["high", "low"]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


class LineRuns:
    """Hashes of all lines seen so far, as sorted runs on levels.

    A batch adds its new hashes as one run of level 0; when a level has ``fanout`` runs, they are
    merged into one run of the next level, so after n batches there are about
    fanout * log(n) runs to look through. Runs are disjoint, because a batch adds only what
    no run holds.
    """

    def __init__(self, spark: SparkSession, fanout: int = 2):
        self.spark, self.fanout, self.levels = spark, fanout, []

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def mark(self, keys: DataFrame) -> DataFrame:
        """``keys`` (high, low, ...) with ``seen``: whether a run holds the hash."""
        marked = keys.withColumn("seen", F.lit(False))
        for run in self.runs():
            held = run.select(*KEY, F.lit(True).alias("held"))
            marked = marked.join(held, KEY, "left").withColumn(
                "seen", F.col("seen") | F.coalesce("held", F.lit(False))
            ).drop("held")
        return marked

    def add(self, keys: DataFrame) -> None:
        self._put(0, keys)

    def _put(self, level: int, keys: DataFrame) -> None:
        width = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        run = written(keys.select(*KEY).repartition(width, *KEY).sortWithinPartitions(*KEY), "line-run")
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._put(level + 1, reduce(DataFrame.unionByName, full))


def dropped_lines(batch: DataFrame, runs: LineRuns, min_chars: int = 10) -> DataFrame:
    """Lines of the batch (doc_id, text) to drop: doc_id, text_hash, at; adds its keys to the runs.

    A line goes if an earlier batch held its key, or a smaller doc_id of this batch does.
    """
    spread = batch.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(lines_of(F.col("text"))).alias("at", "line")
    ).withColumn("key", line_key(F.col("line"))).where(F.length("key") >= min_chars)
    digest = F.md5("key")
    lines = written(spread.select(
        "doc_id", "text_hash", "at",
        F.conv(F.substring(digest, 1, 16), 16, -10).cast("long").alias("high"),
        F.conv(F.substring(digest, 17, 16), 16, -10).cast("long").alias("low"),
    ), "line-keys")
    firsts = lines.groupBy(*KEY).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    marked = written(runs.mark(firsts), "line-marks")
    runs.add(marked.where(~F.col("seen")))
    spent = marked.where(F.col("seen") | (F.col("first") < F.col("last"))).select(*KEY, "first", "seen")
    return lines.join(spent, KEY).where(F.col("seen") | (F.col("doc_id") > F.col("first"))).select(
        "doc_id", "text_hash", "at"
    )


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = 3,
    min_chars: int = 10, fanout: int = 2,
) -> DataFrame:
    """One row per input row: doc_id, n_lines, n_dropped, kept (the text without repeated lines).

    Documents come in ``batches`` of rising doc_id; each is looked up in the runs of the earlier
    ones and adds its own. A line whose trimmed, A-Z-lower-cased key has at least ``min_chars``
    code points stays only in the smallest doc_id that holds it, there as often as it stands.

    Null text is one empty line. Rows without an id lose no line and take none away. Rows that
    repeat an id are one document for the comparison. Other columns are not read.
    """
    rows = narrowed(docs, id_col, text_col)
    spark = rows.sparkSession
    named = rows.where(F.col("doc_id").isNotNull())
    marks = [k / batches for k in range(1, batches)]
    bounds = sorted(set(named.approxQuantile("doc_id", marks, 0.01))) if marks else []
    edges = [None, *(int(b) for b in bounds), None]
    runs, dropped = LineRuns(spark, fanout), []
    for low, high in zip(edges, edges[1:]):
        batch = named
        batch = batch.where(F.col("doc_id") > low) if low is not None else batch
        batch = batch.where(F.col("doc_id") <= high) if high is not None else batch
        dropped.append(dropped_lines(batch, runs, min_chars))
    places = (
        reduce(DataFrame.unionByName, dropped).groupBy("doc_id", "text_hash")
        .agg(F.array_sort(F.collect_set("at")).alias("gone"))
    )
    split = rows.withColumn("text_hash", F.xxhash64("text")).join(places, ["doc_id", "text_hash"], "left").select(
        "doc_id", lines_of(F.col("text")).alias("lines"), F.coalesce("gone", F.array().cast("array<int>")).alias("gone")
    )
    # The kept lines are the stretches between dropped ones.
    kept = F.expr("""flatten(zip_with(
        concat(array(0), transform(gone, g -> g + 1)), concat(gone, array(size(lines))),
        (a, b) -> slice(lines, a + 1, b - a)))""")
    return split.select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_dropped"),
        F.array_join(F.when(F.size("gone") == 0, F.col("lines")).otherwise(kept), "\n").alias("kept"),
    )
