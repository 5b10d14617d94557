"""Key checks: duplicate primary keys and dangling references."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyrow.functions.text import named


def pk_violations(df: DataFrame, key: str) -> DataFrame:
    """(key, rows) for NULL keys and keys that occur more than once."""
    counted = df.groupBy(named(key).alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    return counted.filter((F.col("rows") > 1) | F.col("key").isNull())


def fk_violations(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """(key, rows) of child keys without a parent; NULL refers to nothing.

    The child is counted per key first, so a frequent key crosses the join once.
    """
    counted = (
        child.filter(named(key).isNotNull()).groupBy(named(key).alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    )
    return counted.join(parent.select(named(parent_key).alias("key")), "key", "left_anti")


def require_unique(df: DataFrame, key: str) -> None:
    worst = pk_violations(df, key).orderBy(F.desc("rows")).first()
    if worst:
        raise ValueError(f"key {key!r} is not unique: {worst['key']!r} occurs {worst['rows']} times")
