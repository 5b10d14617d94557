"""Helpers that the operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyrow.session import scratch_root

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def cut(df: DataFrame) -> DataFrame:
    """A checkpoint in the shared folder: lineage ends there, and later passes read it."""
    context = df.sparkSession.sparkContext
    root = scratch_root(df.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return df.checkpoint(eager=True)


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not use."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name = "_" + name
    return name


def small_side(df: DataFrame, max_rows: int) -> DataFrame:
    """A broadcast hint while the table has at most ``max_rows`` rows; a larger one is
    joined by shuffle. The result of the join is the same."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def prefix_digits(rows: int, per_bucket: int = 2048) -> int:
    """Hex digits that cut ``rows`` hashed rows into buckets of about ``per_bucket``."""
    digits = 1
    while digits < 6 and rows > per_bucket * 16**digits:
        digits += 1
    return digits


def running_before(df: DataFrame, within: list[str], key: str, weight: Column, digits: int, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``weight`` over the rows of the same ``within`` whose hex
    ``key`` is smaller.

    No group is ordered in one place: rows are ordered inside buckets of the key's first
    ``digits`` digits, and only the buckets' totals are added up along the group. ``key``
    must be unique within the group.
    """
    bucket, total, offset = (fresh(df, s) for s in ("bucket", "bucket_total", "bucket_offset"))
    cut_up = df.withColumn(bucket, F.substring(key, 1, digits)).withColumn(total, weight)
    along = Window.partitionBy(*within).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut_up.groupBy(*within, bucket)
        .agg(F.sum(total).alias(total))
        .select(*[F.col(c).alias(f"{offset}_{i}") for i, c in enumerate([*within, bucket])],
                F.coalesce(F.sum(total).over(along), F.lit(0)).alias(offset))
    )
    same = [F.col(c).eqNullSafe(F.col(f"{offset}_{i}")) for i, c in enumerate([*within, bucket])]
    on = same[0]
    for condition in same[1:]:
        on = on & condition
    inside = Window.partitionBy(*within, bucket).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return (
        cut_up.join(offsets, on, "left")
        .withColumn(name, F.coalesce(F.sum(total).over(inside), F.lit(0)) + F.col(offset))
        .drop(bucket, total, offset, *[f"{offset}_{i}" for i in range(len(within) + 1)])
    )
