"""Behaviour log: parsing, quarantine, new-visitor flag repair, three-way split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickwell.functions import records
from clickwell.functions.clock import day_text
from clickwell.schemas import LOG_CORE, LOG_OPEN


def parse_log(lines: DataFrame, strict: bool = False) -> DataFrame:
    """`value` text to typed columns; the text itself is kept for lossless output. The open
    parts, start and exposures, are parsed only where they are read.

    Bad text gives null columns (or fails the job when `strict`); see `log_valid` and
    `log_rejects`.
    """
    parsed = records.with_once(lines, "_r", records.parse_json("value", LOG_CORE, strict))
    parsed = parsed.withColumn("_o", records.parse_json("value", LOG_OPEN, strict))
    return parsed.withColumns({
        "mid": F.col("_r.common.mid"),
        "is_new": F.col("_r.common.is_new"),
        "page_id": F.col("_r.page.page_id"),
        "last_page_id": F.col("_r.page.last_page_id"),
        "ts": F.col("_r.ts").try_cast("bigint"),
        "start": F.col("_o.start"),
        "display": F.col("_o.display"),
    }).drop("_r", "_o")


def log_valid(parsed: DataFrame) -> DataFrame:
    """Records every later step can use: they have a visitor and a time."""
    return parsed.where(F.col("mid").isNotNull() & F.col("ts").isNotNull())


def is_record() -> Column:
    """Whether `value` is a JSON object at all."""
    return records.open_record("value").isNotNull()


def log_rejects(parsed: DataFrame) -> DataFrame:
    """The complement of `log_valid`, with the reason: not a JSON object, or incomplete."""
    rejected = parsed.where(F.col("mid").isNull() | F.col("ts").isNull())
    return rejected.select(
        "value",
        *[name for name in rejected.columns if name in ("seq", "offset")],
        F.when(is_record(), "incomplete").otherwise("malformed").alias("reason"),
    )


def log_dates(log: DataFrame) -> DataFrame:
    """Add the calendar day in both text forms."""
    return log.withColumns({
        "day_compact": day_text("ts", "yyyyMMdd"),
        "day_dashed": day_text("ts", "yyyy-MM-dd"),
    })


def first_claims(log: DataFrame) -> DataFrame:
    """First day each visitor claimed to be new. Combined map-side, so one busy visitor
    reaches the shuffle as one row per task."""
    claims = log.where(F.col("is_new") == "1")
    firsts = claims.groupBy("mid").agg(F.min("ts").alias("ts"))
    return firsts.select("mid", day_text("ts", "yyyyMMdd").alias("first_day"))


def _text_with_flag(flag: str):
    """The record text with another `is_new`; everything else in it stays."""
    record = records.open_record("value")
    common = records.put(records.object_of(record["common"]), is_new=records.variant_of(F.lit(flag)))
    return F.to_json(records.put(record, common=F.to_variant_object(common)))


def repair_flags(log: DataFrame, firsts: DataFrame) -> DataFrame:
    """Turn `is_new` from '1' to '0' on days after the visitor's first day, in the column and,
    where the log carries it, in the record text `value`.

    Only records that claim '1' are joined; the rest passes by without a shuffle. Text is
    rewritten for repaired records only and passes verbatim otherwise.
    """
    is_claim = F.col("is_new").eqNullSafe("1")
    claims = log.where(is_claim).join(firsts, "mid", "left")
    returning = day_text("ts", "yyyyMMdd") > F.col("first_day")
    repaired = {"is_new": F.when(returning, "0").otherwise(F.col("is_new"))}
    if "value" in log.columns:
        repaired["value"] = F.when(returning, _text_with_flag("0")).otherwise(F.col("value"))
    return claims.withColumns(repaired).select(*log.columns).unionByName(log.where(~is_claim))


def visitor_flag_repair(log: DataFrame) -> DataFrame:
    """Flag repair over a whole log, by event time."""
    return repair_flags(log, first_claims(log))


def is_start():
    """Start record: a non-empty `start` object."""
    return F.coalesce(F.size("start"), F.lit(0)) > 0


def start_records(log: DataFrame) -> DataFrame:
    return log.where(is_start())


def page_records(log: DataFrame) -> DataFrame:
    """Everything that is not a start record, with or without exposures."""
    return log.where(~is_start())


def display_records(log: DataFrame) -> DataFrame:
    """One row per exposure of a page record. `page_id` is the exposure's own page when it
    names one, else the enclosing page; `item` is the exposure with `page_id` put in."""
    shown = page_records(log).select("*", F.posexplode("display").alias("pos", "item"))
    own_page = F.try_variant_get(F.col("item")["page"], "$.page_id", "string")
    shown = shown.withColumn("page_id", F.coalesce(own_page, F.col("page_id")))
    item = records.put(F.col("item"), page_id=records.variant_of(F.col("page_id")))
    return shown.withColumn("item", item).drop("display", "start")
