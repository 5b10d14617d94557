"""Exact dedup with a heavy-hitter split.

A Misra-Gries style frequent-items sketch names the digests that may be frequent. A second
pass counts exactly those and finds their winners; these few rows are broadcast, and rows of
frequent texts are resolved where they are read. All other digests go through an ordinary
shuffle, where by the sketch's guarantee no group is large.

Texts are equal when their SHA-256 after lower-casing A-Z is equal; a null text counts as
empty. Of equal texts the row with the largest id stays, null ids last; among repeated rows
with that id exactly one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallyrow.llm.common import ascii_lower, cut

#: Counters of the sketch; no more digests than this are ever broadcast.
COUNTERS = 512


def frequent_digests(rows: DataFrame, digest: str, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` digests, among them each with a share above about 4 / counters."""
    sketch = F.expr(f"approx_top_k({digest}, {counters // 4}, {counters})").alias("top")
    return rows.agg(sketch).select(F.explode("top").alias("t")).select(F.col("t.item").alias("heavy"))


def resolve(docs: DataFrame, counters: int = COUNTERS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    normal = ascii_lower(F.coalesce(F.col(text), F.lit("")))
    rows = cut(docs.select(F.col(doc_id).alias("id"), F.sha2(normal, 256).alias("digest"), F.monotonically_increasing_id().alias("rid")))
    best = F.max(F.struct(F.col("id"), (-F.col("rid")).alias("first")))
    candidates = F.broadcast(frequent_digests(rows, "digest", counters))
    winners = (
        rows.join(candidates, F.col("digest") == F.col("heavy"))
        .groupBy("heavy")
        .agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
    )
    winners = F.broadcast(cut(winners))
    split = rows.join(winners, F.col("digest") == F.col("heavy"), "left")
    of_frequent = split.filter(F.col("heavy").isNotNull()).select("id", "digest", "rid", "best", "group_size")
    same = Window.partitionBy("digest")
    others = split.filter(F.col("heavy").isNull()).select("id", "digest", "rid", best.over(same).alias("best"), F.count(F.lit(1)).over(same).alias("group_size"))
    return of_frequent.unionByName(others).select(
        F.col("id").alias(doc_id), F.col("best.id").alias("keep_id"), "group_size",
        (F.col("rid") == -F.col("best.first")).alias("kept"), F.col("digest").alias("text_sha256"),
    )


ORACLE = """
WITH n AS (SELECT doc_id, row_number() OVER () AS rid, sha256(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST, rid) = 1 AS kept, text_sha256
FROM n
"""
