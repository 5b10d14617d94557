"""One-pass column counters and value histograms shared by all checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from tallyrow.functions import text as tx, vocabulary as v
from tallyrow.functions.text import named
from tallyrow.operators.sizing import pin

# HyperLogLog++ at this error has 512 registers. A column of at most 60 distinct
# values fills at most 60 of them, where the sketch uses linear counting, so its
# estimate is at most 512*ln(512/452) = 64. A larger estimate proves that the
# column has more values; a smaller one is settled by an exact histogram.
_SKETCH_ERROR = 0.05
FEW_VALUES_ESTIMATE = 100

COLUMN_GROUP = 40


def is_text(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.StringType, T.VarcharType, T.CharType))


def is_numeric(field: T.StructField) -> bool:
    """Booleans are neither text nor numbers here."""
    return isinstance(field.dataType, T.NumericType)


def audited(df: DataFrame, order_by: str | None = None) -> list[T.StructField]:
    return [f for f in df.schema if f.name != order_by]


def shown(field: T.StructField) -> Column:
    """A cell as text, as examples print it; NaN counts as missing."""
    c = named(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        c = F.when(~F.isnan(c), c)
    return c if is_text(field) else c.cast("string")


def _cell(field: T.StructField) -> Column:
    c = named(field.name)
    number = F.lit(None).cast("double")
    text = F.lit(None).cast("string")
    if is_text(field):
        text = c
    elif is_numeric(field):
        number = c.cast("double")
        number = F.when(~F.isnan(number), number)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = number
    fingerprint = F.when(c.isNotNull(), F.xxhash64(c))
    return F.struct(text.alias("text"), number.alias("number"), fingerprint.alias("mark"))


def cells(df: DataFrame, fields: list[T.StructField]) -> DataFrame:
    """(column, text, number, mark): one row per cell, without a shuffle."""
    wide = df.select(*[_cell(f).alias(f.name) for f in fields])
    long = wide.unpivot([], [named(f.name) for f in fields], "column", "cell")
    return long.select("column", "cell.*")


COUNTER_SCHEMA = (
    "column string, seq int, is_text boolean, is_number boolean, n bigint, present bigint, "
    "placeholders bigint, whitespace bigint, filled bigint, loose_numbers bigint, plain_numbers bigint, "
    "digits bigint, dates bigint, negatives bigint, one_mark boolean"
)


# the kinds that read a text column's class, and so whether its values are numbers or dates
_BY_CLASS = {"numeric_formatting", "non_numeric_in_numeric", "invalid_dates", "category_variants"}
# those that look into a text at all
_BY_TEXT = _BY_CLASS | {"placeholder_missing", "whitespace"}


def column_counters(df: DataFrame, order_by: str | None = None, kinds: list[str] | None = None) -> DataFrame:
    """One row of counts per column, from one scan.

    With ``kinds``, only what findings of these kinds need is counted; the other counters are 0.

    All aggregate buffers are longs, so the aggregate stays in generated code and
    the map side collapses each task's cells to one row per column before anything
    is exchanged.
    """
    fields = audited(df, order_by)
    if not fields:
        return df.sparkSession.createDataFrame([], COUNTER_SCHEMA)
    # wide tables in groups of columns, each read on its own: together they read every
    # column once, and the generated code of a group stays within the compiler's limits
    groups = [fields[i : i + COLUMN_GROUP] for i in range(0, len(fields), COLUMN_GROUP)]
    wanted = set(v.KINDS if kinds is None else kinds)
    counted = reduce(DataFrame.unionByName, [_group_counters(df, g, bool(wanted & _BY_TEXT), bool(wanted & _BY_CLASS)) for g in groups])
    names = F.array(*[F.lit(f.name) for f in fields])
    texts = [f.name for f in fields if is_text(f)]
    numbers = [f.name for f in fields if is_numeric(f)]
    column = F.col("column")
    return counted.select(
        "column",
        F.array_position(names, column).cast("int").alias("seq"),
        (column.isin(texts) if texts else F.lit(False)).alias("is_text"),
        (column.isin(numbers) if numbers else F.lit(False)).alias("is_number"),
        *[c for c in counted.columns if c not in ("column", "one_mark")],
        F.coalesce("one_mark", F.lit(True)).alias("one_mark"),
    )


def _group_counters(df: DataFrame, fields: list[T.StructField], by_text: bool, by_class: bool) -> DataFrame:
    text, s = F.col("text"), F.col("s")
    filled, no = F.col("filled"), F.lit(False)
    judged = (
        cells(df, fields)
        .withColumn("s", tx.strip(text) if by_text else F.lit(None).cast("string"))
        .withColumn("placeholder", tx.placeholder_of(s) if by_text else no)
        .withColumn("filled", text.isNotNull() & ~F.col("placeholder") if by_text else no)
        .withColumn("plain", F.when(filled, tx.plain_number_of(s)).isNotNull() if by_class else no)
        .select(
            "column",
            "mark",
            "number",
            "placeholder",
            "filled",
            "plain",
            (filled & (text != s) if by_text else no).alias("padded"),
            (F.col("plain") | F.when(filled & ~F.col("plain"), tx.loose_number_of(s)).isNotNull() if by_class else no).alias("loose"),
            (filled & tx.has_digit(text) if by_class else no).alias("digit"),
            (F.when(filled, tx.any_date_of(s)).isNotNull() if by_class else no).alias("date"),
        )
    )
    return judged.groupBy("column").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("mark").alias("present"),
        F.count_if("placeholder").alias("placeholders"),
        F.count_if("padded").alias("whitespace"),
        F.count_if("filled").alias("filled"),
        F.count_if("loose").alias("loose_numbers"),
        F.count_if("plain").alias("plain_numbers"),
        F.count_if("digit").alias("digits"),
        F.count_if("date").alias("dates"),
        F.count_if(F.col("number") < 0).alias("negatives"),
        (F.min("mark") == F.max("mark")).alias("one_mark"),
    )


def pinned_counters(df: DataFrame, order_by: str | None = None, kinds: list[str] | None = None) -> DataFrame:
    """The counters as a local table: one row per column, so bounded by the schema."""
    return pin(column_counters(df, order_by, kinds))


def few_valued(df: DataFrame, columns: list[str]) -> list[str]:
    """Those of the columns that may have at most MAX_CATEGORIES distinct values."""
    if not columns:
        return []
    estimates = [F.approx_count_distinct(named(c), _SKETCH_ERROR).alias(f"d{i}") for i, c in enumerate(columns)]
    row = df.agg(*estimates).first()
    return [c for i, c in enumerate(columns) if row[f"d{i}"] <= FEW_VALUES_ESTIMATE]


def wide_columns(df: DataFrame, columns: list[str], order_by: str | None = None) -> list[str]:
    """Those of the text columns with more than MAX_CATEGORIES distinct filled values."""
    few = few_valued(df, columns)
    filled = value_histogram(df, few, order_by).filter(~tx.is_placeholder(F.col("value")))
    over = filled.groupBy("column").count().filter(F.col("count") > v.MAX_CATEGORIES).collect()
    return [c for c in columns if c not in few or c in {r["column"] for r in over}]


def text_class(counters: DataFrame) -> DataFrame:
    """Adds ``class``: which branch of the text checks a column takes."""
    filled = F.col("filled")
    return counters.withColumn(
        "class",
        F.when(~F.col("is_text"), F.when(F.col("is_number"), "number").otherwise("other"))
        .when(filled == 0, "empty")
        .when(F.col("loose_numbers") / filled >= v.NUMERIC_TEXT_SHARE, "numeric_text")
        .when(
            (F.col("digits") / filled > v.DIGIT_SHARE) & (F.col("dates") / filled >= v.DATE_SHARE),
            "date",
        )
        .when(F.lower("column").contains("date"), "named_date")
        .otherwise("category"),
    )


def value_histogram(df: DataFrame, columns: list[str], order_by: str | None = None) -> DataFrame:
    """(column, value, n, first_pos) for the named columns, values as text."""
    fields = [f for f in df.schema if f.name in columns]
    position = named(order_by).cast("bigint") if order_by else F.lit(None).cast("bigint")
    if not fields:
        return df.sparkSession.createDataFrame([], "column string, value string, n bigint, first_pos bigint")
    wide = df.select(position.alias("__pos"), *[shown(f).alias(f.name) for f in fields])
    long = wide.unpivot("__pos", [named(f.name) for f in fields], "column", "value")
    return (
        long.filter("value is not null")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.min("__pos").alias("first_pos"))
    )


def column_profile(
    df: DataFrame,
    order_by: str | None = None,
    max_values: int = v.MAX_PROFILE_VALUES,
    approximate: bool = False,
) -> DataFrame:
    """(column, kind, low, high, distinct_values, value, n).

    Numeric columns: one row with their range. Other columns: every value with its
    count while there are at most ``max_values``, else the five most frequent.
    ``approximate`` replaces only the distinct count of wide columns by a sketch.
    """
    fields = audited(df, order_by)
    spark = df.sparkSession
    schema = "column string, kind string, low double, high double, distinct_values bigint, value string, n bigint"
    parts = []
    numbers = [f for f in fields if is_numeric(f)]
    if numbers:
        as_double = [
            F.when(~F.isnan(named(f.name).cast("double")), named(f.name).cast("double")).alias(f.name) for f in numbers
        ]
        ranges = (
            df.select(*as_double)
            .unpivot([], [named(f.name) for f in numbers], "column", "x")
            .groupBy("column")
            .agg(F.min("x").alias("low"), F.max("x").alias("high"))
        )
        parts.append(
            ranges.select(
                "column", F.lit("numeric").alias("kind"), "low", "high",
                F.lit(None).cast("bigint").alias("distinct_values"),
                F.lit(None).cast("string").alias("value"), F.lit(None).cast("bigint").alias("n"),
            )
        )
    others = [f.name for f in fields if not is_numeric(f)]
    if others:
        histogram = value_histogram(df, others, order_by)
        if approximate:
            widths = df.agg(*[F.approx_count_distinct(named(c)).alias(c) for c in others]).unpivot(
                [], [named(c) for c in others], "column", "distinct_values"
            )
        else:
            widths = histogram.groupBy("column").agg(F.count(F.lit(1)).alias("distinct_values"))
        # the rank filter below is a per-task top-k, so no task holds a column's values
        common = W.partitionBy("column").orderBy(F.desc("n"), "value")
        top = (
            histogram.withColumn("place", F.row_number().over(common))
            .filter(F.col("place") <= max(max_values, 5))
            .join(F.broadcast(widths), "column")
        )
        parts.append(
            top.filter((F.col("distinct_values") <= max_values) | (F.col("place") <= 5)).select(
                "column", F.lit("text").alias("kind"),
                F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"),
                "distinct_values", "value", "n",
            )
        )
    if not parts:
        return spark.createDataFrame([], schema)
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p)
    return result
