"""Dense positions of sorted rows without a sort in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallyrow.operators.sizing import staged

#: The row number inside its task, in an id from ``monotonically_increasing_id``.
_IN_TASK = (1 << 33) - 1


def ordinals(df: DataFrame, key: str, name: str) -> DataFrame:
    """Adds ``name``: 0, 1, ... in ascending order of ``key``, null first.

    Rows are dealt to tasks by range, counted in each, and a task's first position is the sum
    of the counts before it, so only one number a task meets the others. Rows with equal keys
    lie in one range; their order among themselves is not fixed.
    """
    ranged = df.repartitionByRange(F.col(key).asc_nulls_first()).sortWithinPartitions(F.col(key).asc_nulls_first())
    own = F.monotonically_increasing_id()
    written = staged(ranged.withColumn("_task", F.shiftright(own, 33)).withColumn("_own", own.bitwiseAND(F.lit(_IN_TASK))), "ordinals")
    # one row for each task of the exchange above
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = written.groupBy("_task").agg(F.count(F.lit(1)).alias("_n")).select("_task", before.alias("_before"))
    return written.join(F.broadcast(counts), "_task").withColumn(name, F.col("_before") + F.col("_own")).drop("_task", "_own", "_before")
