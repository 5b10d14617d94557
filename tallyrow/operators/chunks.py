"""Grouping long records into one retrievable chunk per (verb, tense)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyrow.functions import vocabulary as v
from tallyrow.functions.text import named

# Forms gathered at once; the pieces of a (verb, tense) are then joined in order.
FORMS_PER_PIECE = 10_000


def custom_rank(c: Column, order: list[str] | None = None) -> Column:
    """Position in a fixed list from 0; values not in it come last."""
    listed = F.array(*[F.lit(x) for x in (order or v.PRONOUN_ORDER)])
    return F.coalesce(F.nullif(F.array_position(listed, c), F.lit(0)) - 1, F.lit(v.UNKNOWN_PRONOUN_RANK)).cast("int")


def chunk_id(verb: Column, tense: Column) -> Column:
    return F.concat(F.lower(verb), F.lit("_"), F.replace(tense, F.lit(" "), F.lit("_")))


def _title(verb: Column, meaning: Column, tense: Column) -> Column:
    return F.concat(F.lit("Verb: "), verb, F.lit(" ("), meaning, F.lit(")\nTense: "), tense)


def _listed() -> Column:
    entry = F.struct("rank", "pos", F.concat("pronoun", F.lit(": "), "form").alias("line"))
    return F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["line"])


def build_chunks(records: DataFrame, pos: str = "pos", forms_per_piece: int = FORMS_PER_PIECE) -> DataFrame:
    """(id, text, metadata): one row per (verb, tense), whatever its size.

    Forms are sorted and joined in pieces along the sort order (pronoun rank, then ranges
    of the position), so a frequent key is spread over many tasks; the pieces' texts are
    then joined in order. ``pos`` is an integer, unique within a group.
    """
    rows = records.select(
        "verb", "tense", "meaning", "pronoun", "form", "page",
        named(pos).cast("bigint").alias("pos"), custom_rank(F.col("pronoun")).alias("rank"),
    )
    span = F.floor(F.col("pos") / forms_per_piece)
    pieces = (
        rows.groupBy("verb", "tense", "rank", span.alias("span"))
        .agg(F.min(F.struct("pos", "meaning", "page")).alias("f"), F.count(F.lit(1)).alias("n"), _listed().alias("lines"))
        .select("verb", "tense", "f", "n", F.struct("rank", "span", F.concat_ws("\n", "lines").alias("body")).alias("piece"))
    )
    bodies = F.transform(F.array_sort(F.collect_list("piece")), lambda p: p["body"])
    whole = pieces.groupBy("verb", "tense").agg(
        F.min("f").alias("f"), F.sum("n").alias("num_forms"), F.concat_ws("\n", bodies).alias("body")
    )
    title = _title(F.col("verb"), F.col("f.meaning"), F.col("tense"))
    return whole.select(
        chunk_id(F.col("verb"), F.col("tense")).alias("id"),
        F.concat_ws("\n", title, "body").alias("text"),
        F.struct(
            "verb", F.lower("verb").alias("verb_lower"), F.col("f.meaning").alias("meaning"), "tense",
            F.col("f.page").cast("bigint").alias("page"), F.col("num_forms").cast("bigint").alias("num_forms"),
        ).alias("metadata"),
    )


def chunk_statistics(chunks: DataFrame) -> DataFrame:
    return chunks.agg(
        F.count(F.lit(1)).alias("chunks"),
        F.count_distinct("metadata.verb").alias("verbs"),
        F.count_distinct("metadata.tense").alias("tenses"),
    )
