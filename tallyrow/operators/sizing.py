"""Size checks before a table travels whole, and stages written between passes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyrow.functions.text import named
from tallyrow.session import scratch_path

SMALL_TABLE = 100_000
# bytes of a table that is sent whole, its texts and 64 for the rest of each row
LIGHT_BYTES = 64 << 20


def pin_if_small(df: DataFrame, max_rows: int = SMALL_TABLE) -> DataFrame:
    """A broadcast local copy while the table has at most ``max_rows`` rows.

    A larger table is returned as it is and joined by shuffle, where adaptive
    execution splits skewed partitions.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def broadcast_if_light(df: DataFrame, *texts: str, max_bytes: int = LIGHT_BYTES) -> DataFrame:
    """Marked for broadcast while rows and the columns ``texts`` come to at most ``max_bytes``."""
    sizes = [F.coalesce(F.octet_length(named(c)), F.lit(0)) for c in texts]
    held = df.agg(F.sum(sum(sizes, F.lit(64)).cast("bigint")).alias("n")).first()["n"]
    return F.broadcast(df) if (held or 0) <= max_bytes else df


def pin(df: DataFrame) -> DataFrame:
    """A local copy of a table whose size is set by a schema or a plan, not by data:
    counters, issues, fixes. Never for rows of an audited table."""
    return df.sparkSession.createDataFrame(df.toArrow(), df.schema)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: later passes do not recompute it,
    and a lost executor costs only the rows being read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
