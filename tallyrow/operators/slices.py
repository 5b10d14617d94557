"""Small rectangles of a table, addressed by row ordinal and column position."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from tallyrow.functions import text as tx, vocabulary as v
from tallyrow.functions.text import named
from tallyrow.operators.ordinals import ordinals
from tallyrow.operators.sizing import pin_if_small

# rows that a single task may take in to find the last of them
DIRECT_ROWS = 10_000


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("max_row")).withColumn("max_column", F.lit(len(df.columns)))


def block(
    df: DataFrame, order_by: str, rows: tuple[int, int], columns: tuple[int, int] | None = None, direct_rows: int = DIRECT_ROWS
) -> DataFrame:
    """Rows first..last (from 1, in key order) of columns first..last, with ``ordinal``.
    ``order_by`` must be unique.

    Near the table's start a top-n per task finds the rows. Deeper rows are found by key alone:
    keys are dealt by range and counted, so a row's ordinal is its range's count before and its
    place inside, and only the rows asked for are fetched. No task holds all rows before them.
    """
    first, last = rows
    lo, hi = columns or (1, len(df.columns))
    kept = df.columns[lo - 1 : hi]
    if last > direct_rows:
        ranked = ordinals(df.select(named(order_by).alias("__key")), "__key", "__before")
        wanted = ranked.filter(F.col("__before").between(first - 1, last - 1)).withColumn("ordinal", F.col("__before") + 1)
        found = df.join(pin_if_small(wanted), named(order_by).eqNullSafe(F.col("__key")))
        return found.select("ordinal", *[named(c) for c in kept])
    top = df.orderBy(named(order_by)).limit(last)
    numbered = top.withColumn("ordinal", F.row_number().over(W.orderBy(named(order_by))).cast("bigint"))
    return numbered.filter(F.col("ordinal").between(first, last)).select("ordinal", *[named(c) for c in kept])


def cell(df: DataFrame, order_by: str, row: int, column: int) -> DataFrame:
    return block(df, order_by, (row, row), (column, column)).drop("ordinal")


def header(df: DataFrame) -> DataFrame:
    """(position, name) of the columns."""
    return df.sparkSession.createDataFrame(list(enumerate(df.columns, 1)), "position int, name string")


def head(df: DataFrame, order_by: str, n: int = 5) -> DataFrame:
    return df.orderBy(named(order_by)).limit(n)


def fixed_width(df: DataFrame, columns: list[str], widths: list[int] | None = None) -> DataFrame:
    """Rows without a NULL among ``columns``, with a padded ``line``."""
    widths = widths or v.LINE_WIDTHS
    complete = df.dropna(how="any", subset=columns)
    padded = [tx.pad(named(c).cast("string"), w) for c, w in zip(columns, widths)]
    return complete.withColumn("line", F.concat(*padded))
