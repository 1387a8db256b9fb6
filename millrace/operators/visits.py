"""Entry pages and daily unique visits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.times import date_text
from millrace.operators.latest import first_per_key


def is_entry(last_page_id: str = "page.last_page_id") -> Column:
    """No previous page: null or the empty text (a blank one is a page)."""
    page = F.col(last_page_id)
    return page.isNull() | (page == "")


def unique_visits(
    pages: DataFrame,
    key: str = "common.mid",
    ts: str = "ts",
    tiebreak: Sequence[str] = ("seq",),
) -> DataFrame:
    """Each visitor's first entry page per day."""
    entries = pages.where(is_entry()).withColumn("visit_date", date_text(F.col(ts)))
    order = [F.col(c).asc() for c in (ts, *tiebreak)]
    return first_per_key(entries, [F.col(key), "visit_date"], order).drop("visit_date")
