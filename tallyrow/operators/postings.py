"""Red flags of job postings. Everything up to the key dedupe is one narrow projection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallyrow.functions import text as tx, vocabulary as v
from tallyrow.functions.text import named
from tallyrow.sources.tables import conform


def _text(df: DataFrame, name: str) -> Column:
    return F.coalesce(named(name).cast("string"), F.lit("")) if name in df.columns else F.lit("")


def _any(df: DataFrame, name: str) -> Column:
    return named(name) if name in df.columns else F.lit(None)


def combined_text(df: DataFrame) -> Column:
    return F.concat_ws(" ", _text(df, "description"), _text(df, "requirements"), _text(df, "benefits"))


# A phone number after a word boundary: "+1 555..." does not match, "a+1555..." does.
# With fixed_phone the boundary before the plus sign is dropped.
def _contact(fixed_phone: bool) -> str:
    return v.OFF_PLATFORM if not fixed_phone else v.OFF_PLATFORM + r"|\+\d{1,3}[\s-]?\d{6,}\b"


_BODY, _FOLDED = "__body", "__folded"


def _with_body(df: DataFrame) -> DataFrame:
    """The combined text and its case-folded form, made once for all searches."""
    return df.withColumn(_BODY, combined_text(df)).withColumn(_FOLDED, tx.folded(F.col(_BODY)))


def _flag_columns(df: DataFrame, fixed_phone: bool) -> dict[str, Column]:
    search = lambda pattern, anchors: tx.matches(F.col(_BODY), pattern, F.col(_FOLDED), anchors)
    words = tx.word_count(_text(df, "description"))
    return {
        "flag_no_salary": _any(df, "salary_range").isNull(),
        "flag_no_company_logo": F.coalesce(_any(df, "has_company_logo").cast("double"), F.lit(0.0)) == 0,
        "flag_no_company_profile": tx.strip(_text(df, "company_profile")) == "",
        "flag_urgency_language": search(v.URGENCY, v.URGENCY_ANCHORS),
        "flag_requests_personal_info": search(v.PERSONAL_INFO, v.PERSONAL_INFO_ANCHORS),
        "flag_off_platform_contact": search(_contact(fixed_phone), v.OFF_PLATFORM_ANCHORS),
        "flag_vague_title_language": tx.matches(_text(df, "title"), v.VAGUE_TITLE),
        "description_word_count": words,
    }


def with_flags(df: DataFrame, fixed_phone: bool = False) -> DataFrame:
    """Adds flags, word count and signal count; also works on a stream.

    Write the result before filtering on it: a filter on a flag would be pushed below
    this projection and repeat the searches it is made of.
    """
    flagged = _with_body(df).withColumns(_flag_columns(df, fixed_phone))
    short = F.col("description_word_count") < v.SHORT_DESCRIPTION_WORDS
    return (
        flagged.withColumn("flag_short_description", short)
        .withColumn("fraud_signal_count", signal_count())
        .drop(_BODY, _FOLDED)
    )


def signal_count() -> Column:
    return reduce(lambda a, b: a + b, [F.col(f).cast("int") for f in v.FLAGS])


def posting_columns(df: DataFrame) -> list[tuple[str, str]]:
    label = [("fraudulent", "boolean")] if "fraudulent" in df.columns else []
    return v.POSTING_COLUMNS + label


def clean(df: DataFrame) -> DataFrame:
    """The declared columns of a flagged table, typed; absent ones become NULL."""
    return conform(df, posting_columns(df))


def keep_first(df: DataFrame, key: str, order_by: str) -> DataFrame:
    """One row per key, the earliest by ``order_by``.

    The rank-1 filter runs inside every map task before the exchange, so a key
    with very many rows sends one row per task.
    """
    first = F.row_number().over(W.partitionBy(named(key)).orderBy(named(order_by)))
    return df.withColumn("__place", first).filter("__place = 1").drop("__place")


def flag_rates_by_label(df: DataFrame, flags: list[str] | None = None, digits: int = 3) -> DataFrame:
    """Share of rows with each flag, per label."""
    flags = flags or v.FLAGS
    rates = [F.round(F.avg(F.col(f).cast("int").cast("double")), digits).alias(f.removeprefix("flag_") + "_rate") for f in flags]
    return df.groupBy("fraudulent").agg(*rates)


def fraud_rate(df: DataFrame) -> DataFrame:
    label = F.col("fraudulent").cast("int").cast("double")
    return df.agg(F.count("fraudulent").alias("labelled"), F.round(F.avg(label), 6).alias("fraud_rate"))


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """(place, stage, rows) of the stages of a job."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(i).alias("place"), F.lit(name).alias("stage"), "rows")
        for i, (name, df) in enumerate(stages.items(), 1)
    ]
    return reduce(DataFrame.unionByName, parts)


def by_signal(df: DataFrame, at_least: int) -> DataFrame:
    return df.filter(F.col("fraud_signal_count") >= at_least)


def by_industry(df: DataFrame, industry: str) -> DataFrame:
    return df.filter(F.col("industry") == industry)
