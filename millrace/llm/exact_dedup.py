"""Exact duplicates: 128-bit content hash, byte comparison inside each hash, one keeper per text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ascii_lower, narrowed


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
    ascii_case: bool = False,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are grouped by a 128-bit hash together with the text itself, so unequal texts of one hash
    stay apart: the hash is only what spreads the groups. Copies collapse in the map tasks, so a
    text held by a third of all rows sends one row per task. ``keep`` names the id that stays,
    ``smallest`` or ``largest``; ``ascii_case`` ignores the case of A-Z.

    Null text counts as empty. Rows that repeat an id and its text all stay or all go, and count in
    ``group_size``. A row without an id stays only if no row of its text has one. Other columns
    are not read; an empty table gives no rows.
    """
    pick = {"smallest": F.min, "largest": F.max}[keep]
    rows = narrowed(docs, id_col, text_col)
    body = ascii_lower(F.col("text")) if ascii_case else F.col("text")
    keyed = rows.select("doc_id", body.alias("body"), F.md5(body).alias("hash"))
    groups = (
        keyed.groupBy("hash", "body")
        .agg(pick("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("hash", F.sha2("body", 256).alias("text_sha256"), "keep_id", "group_size")
    )
    members = keyed.select("doc_id", "hash", F.sha2("body", 256).alias("text_sha256"))
    return members.join(groups, ["hash", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                   ascii_case: bool = False) -> DataFrame:
    """The rows that stay, all columns; of rows that repeat a kept id and text all stay."""
    groups = exact_groups(docs, id_col, text_col, keep, ascii_case)
    gone = groups.where(~F.col("kept")).select(
        F.col("doc_id").alias("__gone_id"), F.col("text_sha256").alias("__gone_text")
    ).distinct()
    text = F.coalesce(docs[text_col], F.lit(""))
    body = ascii_lower(text) if ascii_case else text
    match = docs[id_col].cast("long").eqNullSafe(F.col("__gone_id")) & (F.sha2(body, 256) == F.col("__gone_text"))
    return docs.join(gone, match, "left_anti")
