"""Application logs: parsing, new-visitor repair, three-way split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from millrace.functions.records import as_typed, numbers_as_text, parse_typed
from millrace.schemas import ODS_LOG

_CORRUPT = "_corrupt"


def parse(
    lines: DataFrame, value: str = "value", schema: StructType = ODS_LOG
) -> DataFrame:
    """Log texts to records, with ``is_dirty`` set on texts that are none.

    Dirty: not one JSON object, without ``common.mid``, or ``ts`` no number.  A field of
    another type elsewhere is null and does not make its record dirty.  The text
    and the other columns of ``lines`` are kept.  Pass a wider ``schema`` to carry
    more fields.  The text is parsed as a field followed by a mark, so that anything
    after the object shows instead of being passed over.
    """
    loose = numbers_as_text(schema)
    wrapper = StructType().add("_record", loose).add("_end", StringType())
    wrapper = wrapper.add(_CORRUPT, StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    text = F.concat(F.lit('{"_record":'), F.col(value), F.lit(',"_end":"."}'))
    parsed = parse_typed(lines.withColumns({"_text": text, "_again": text}), wrapper, "_text", options)
    # Only a text that does not fit the layout is read once more, field by field.
    misfit = F.col(_CORRUPT).isNotNull()
    opened = F.when(misfit, F.try_parse_json("_again"))
    field = lambda path, kind: F.try_variant_get(F.col("_open"), path, kind.simpleString())
    refitted = F.struct(
        F.struct(*[field(f"$._record['{f.name}']", f.dataType).alias(f.name) for f in loose.fields]).alias("_record"),
        field("$._end", StringType()).alias("_end"),
        F.when(F.col("_open").isNull(), F.col(_CORRUPT)).alias(_CORRUPT),
    )
    fitted = F.struct("_record", "_end", _CORRUPT)
    parsed = parsed.withColumn("_open", opened).select(
        *lines.columns, F.inline(F.array(F.when(misfit, refitted).otherwise(fitted)))
    )
    record = F.col("_record")
    is_dirty = (
        F.col(_CORRUPT).isNotNull()
        | F.col("_end").isNull()
        | record["common"]["mid"].isNull()
        | (record["ts"].isNotNull() & record["ts"].try_cast("bigint").isNull())
    )
    fields = [as_typed(record[f.name], f.dataType).alias(f.name) for f in schema.fields]
    return parsed.select(*lines.columns, *fields, is_dirty.alias("is_dirty"))


def good(parsed: DataFrame, value: str = "value", keep_text: bool = False) -> DataFrame:
    """Well-formed records, without the source text unless it is to be kept."""
    return parsed.where(~F.col("is_dirty")).drop("is_dirty", *([] if keep_text else [value]))


def dirty(parsed: DataFrame, value: str = "value") -> DataFrame:
    """Malformed source texts."""
    return parsed.where("is_dirty").select(value)


def repair_is_new(
    records: DataFrame,
    ts: str = "ts",
    tiebreak: Sequence[str] = ("seq",),
    claims_from: DataFrame | None = None,
) -> DataFrame:
    """Keep ``is_new = '1'`` on each visitor's first claim, set later claims to ``'0'``.

    ``ts`` then ``tiebreak`` must tell a visitor's records apart.  The first claim
    is a map-side combined minimum; it meets the records again on the full
    (visitor, ts, tiebreak) key, so a hot visitor is never gathered in one task.
    ``claims_from`` holds all records where ``records`` are only some of them.
    """
    order = [ts, *tiebreak]
    claims = F.col("common.is_new") == "1"
    firsts = (
        (records if claims_from is None else claims_from).where(claims)
        .groupBy(F.col("common.mid").alias("_mid"))
        .agg(F.min(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])).alias("_f"))
        .select("_mid", "_f.*")
    )
    same = claims & (F.col("common.mid") == F.col("_mid"))
    for i, c in enumerate(order):
        same = same & F.col(c).eqNullSafe(F.col(f"_o{i}"))
    kept = F.when(claims & F.col("_mid").isNull(), F.lit("0")).otherwise(F.col("common.is_new"))
    return records.join(firsts, same, "left").select(
        *[c for c in records.columns if c != "common"],
        F.col("common").withField("is_new", kept).alias("common"),
    ).select(*records.columns)


def is_start() -> Column:
    return F.col("start").isNotNull() & (F.col("start") != "")


def start_logs(records: DataFrame) -> DataFrame:
    return records.where(is_start())


def page_logs(records: DataFrame) -> DataFrame:
    return records.where(~is_start())


def _display(item: Column, page_id: Column) -> Column:
    """A display item with its page's id."""
    others = F.map_filter(item, lambda k, _: k != "page_id")
    owner = F.when(page_id.isNotNull(), F.create_map(F.lit("page_id"), page_id.cast("variant")))
    return F.coalesce(F.map_concat(others, owner), others)


def display_logs(records: DataFrame, with_common: bool = False) -> DataFrame:
    """One row per display of a page log: the item's fields plus ``page_id``.

    Only the item survives by default; ``with_common`` adds ``common`` and ``ts``.
    """
    items = page_logs(records).select(
        F.col("page.page_id").alias("_page"), "common", "ts", F.explode("displays").alias("_item")
    )
    display = _display(F.col("_item"), F.col("_page")).alias("display")
    return items.select(display, *(["common", "ts"] if with_common else []))


# Topics of the split.
START_TOPIC = "dwd_start_log"
PAGE_TOPIC = "dwd_page_log"
DISPLAY_TOPIC = "dwd_display_log"


def _whole(text: Column, is_new: Column) -> Column:
    """The record of a source text with only ``common.is_new`` replaced, where it has one."""
    fields = "map<string,variant>"
    top = F.try_parse_json(text).cast(fields)
    common = F.transform_values(
        top["common"].cast(fields),
        lambda k, v: F.when((k == "is_new") & is_new.isNotNull(), is_new.cast("variant")).otherwise(v),
    )
    return F.to_json(F.transform_values(
        top, lambda k, v: F.when(k == "common", F.to_variant_object(common)).otherwise(v)
    ))


def split_lines(
    records: DataFrame, fields: Sequence[str] = tuple(ODS_LOG.names), text: str | None = None
) -> DataFrame:
    """The three-way split in one pass: ``topic, value`` rows of all three sides.

    ``text`` names the source text: start and page logs are then the whole source record with only
    ``common.is_new`` replaced.  Without it, or where a record names a field twice, they have
    ``fields`` alone.
    """
    none = F.lit(None).cast("map<string,variant>")
    entry = lambda topic, item: F.struct(F.lit(topic).alias("topic"), item.alias("item"))
    shown = F.transform(
        F.coalesce("displays", F.array().cast("array<map<string,variant>>")),
        lambda item: entry(DISPLAY_TOPIC, item),
    )
    targets = F.when(is_start(), F.array(entry(START_TOPIC, none))).otherwise(
        F.concat(F.array(entry(PAGE_TOPIC, none)), shown)
    )
    source = F.lit(None).cast("string") if text is None else F.col(text)
    rows = records.select(*fields, source.alias("_text"), F.explode(targets).alias("_to")).select(
        *fields, "_text", "_to.*"
    )
    display = F.to_json(_display(F.col("item"), F.col("page.page_id")))
    # An object under `start` is written as one again, a plain text as text.
    start = F.coalesce(F.try_parse_json("start"), F.col("start").cast("variant")).alias("start")
    whole = F.to_json(F.struct(*[start if c == "start" else c for c in fields]))
    if text is not None:
        whole = F.coalesce(_whole(F.col("_text"), F.col("common.is_new")), whole)
    return rows.select(
        "topic", F.when(F.col("topic") == DISPLAY_TOPIC, display).otherwise(whole).alias("value")
    )
