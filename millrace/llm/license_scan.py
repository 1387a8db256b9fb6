"""Licence scans by diagonal voting over rolling word k-grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import ascii_lower

WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
K = 2
#: Phrases that name a licence, and their labels.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
#: Openings of licence texts and notices, and their labels.
NOTICES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit-text"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("released under the mit license", "mit-notice"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd-text"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
     "gpl-text"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     "isc-text"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl-text"),
]


def words_of(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), WORD_BREAK), lambda w: w != "")


def grams(words: str) -> Column:
    """Hashes of all runs of K words, by their place."""
    return F.expr(
        f"transform(slice({words}, 1, greatest(size({words}) - {K - 1}, 0)), "
        f"(w, i) -> xxhash64(w, {', '.join(f'get({words}, i + {j})' for j in range(1, K))}))"
    )


def templates(spark, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    rows = [(i, text.split(), label, exact) for i, (text, label, exact) in enumerate(
        [(t, x, True) for t, x in phrases] + [(t, x, False) for t, x in notices]
    )]
    return spark.createDataFrame(rows, "template int, t_words array<string>, label string, exact boolean")


def diagonals(docs: DataFrame, known: DataFrame, slack: int = 2) -> DataFrame:
    """Candidate spans: key, template, start, end, votes.

    Each k-gram a document shares with a template votes for the diagonal (place in the document
    minus place in the template). Votes of neighbouring diagonals, at most ``slack`` apart (a
    word too many or too few), are merged. Phrases need one diagonal exactly.
    """
    places = known.select("template", "exact", F.posexplode(grams("t_words")).alias("t_at", "gram"))
    there = docs.select("key", F.posexplode(grams("words")).alias("at", "gram"))
    votes = there.join(F.broadcast(places), "gram").groupBy(
        "key", "template", "exact", (F.col("at") - F.col("t_at")).alias("diagonal")
    ).agg(F.count(F.lit(1)).alias("votes"), F.min("at").alias("first"), F.max("at").alias("last"))
    order = Window.partitionBy("key", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(order)
    opens = F.when(F.col("exact") | gap.isNull() | (gap > slack), 1).otherwise(0)
    grouped = votes.withColumn("opens", opens).withColumn("band", F.sum("opens").over(order))
    return grouped.groupBy("key", "template", "band").agg(
        F.sum("votes").alias("votes"), F.min("first").alias("start"), F.max("last").alias("last"),
        F.min("diagonal").alias("diagonal"),
    ).select("key", "template", "diagonal", "start", (F.col("last") + K).alias("end"), "votes")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = 0.8,
         phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    A phrase is found wherever its words stand in a row: all its k-grams vote for one diagonal and
    the span's words equal it. A notice is found if at least ``share`` of its k-grams vote for one band
    of diagonals and at least ``share`` of its words stand in the span. ``score`` is the largest
    share of a notice's words found, 1 for a phrase, 0 if there is no label. A word is a run of
    digits, letters and characters beyond ASCII; A-Z are lower-cased. Null text has no words.
    Rows are told apart by id and text, so rows that repeat both get equal results each. Other
    columns are not read.
    """
    known = templates(docs.sparkSession, phrases, notices)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    keyed = rows.select("*", F.struct("doc_id", F.md5("text").alias("text_hash")).alias("key"))
    split = keyed.select("key", words_of(F.col("text")).alias("words"))
    size = F.size("t_words") - (K - 1)
    spans = diagonals(split, known).join(F.broadcast(known), "template").where(
        F.when(F.col("exact"), F.col("votes") >= size).otherwise(F.col("votes") >= F.ceil(size * F.lit(share)))
    )
    near = spans.groupBy("key").agg(F.collect_set(F.struct(
        "exact", "label", "t_words", "diagonal", "start", "end"
    )).alias("spans"))
    texts = keyed.select(F.col("key").alias("text_key"), "text")
    checked = near.join(texts, F.col("key").eqNullSafe(F.col("text_key"))).dropDuplicates(["key"]).withColumn(
        "words", words_of(F.col("text"))
    ).select("key", F.expr("""transform(spans, s -> named_struct('exact', s.exact, 'label', s.label, 'at', s.diagonal,
        'found', IF(s.exact,
            IF(slice(words, greatest(s.diagonal, 0) + 1, size(s.t_words)) = s.t_words AND s.diagonal >= 0, 1.0D, 0.0D),
            size(array_intersect(slice(words, s.start + 1, s.end - s.start), s.t_words))
                / CAST(size(array_distinct(s.t_words)) AS DOUBLE))))""").alias("spans"))
    good = checked.withColumn("spans", F.filter("spans", lambda s: s["found"] >= F.lit(share))).withColumn(
        "base", F.filter("spans", lambda s: s["exact"])
    ).select(
        F.col("key.doc_id").alias("doc_id"), F.col("key.text_hash").alias("text_hash"),
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.at").cast("long").alias("first_word"), F.array_max("base.at").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base.label")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct("spans.label")), ",").alias("labels"),
        F.coalesce(F.array_max("spans.found"), F.lit(0.0)).alias("score"),
    )
    counts = keyed.select("doc_id", "key.text_hash", F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    mine, theirs = counts.alias("c"), good.alias("g")
    same = F.col("c.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("c.text_hash") == F.col("g.text_hash"))
    return mine.join(theirs, same, "left").select(
        "c.doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
