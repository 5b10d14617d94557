"""Sharding by jump consistent hashing.

A key's shard follows from the key and the number of shards alone: a pseudo-random sequence
seeded by the key names the shard counts at which the key moves, always into the newest
shard, so one more shard takes about 1 / (shards + 1) of the rows and no row moves between
old shards. No ring table is kept.

Slots number the rows of a shard from 0 in the order of a hash of id and text. Rows that
agree in id and text are interchangeable and take neighbouring slots. A null id is a key of
its own; a null text counts as empty.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tallyrow.llm.common import cut, prefix_digits, running_before

SHARDS = 16
_STEP = np.uint64(2862933555777941757)


def stable_key(key: Column) -> Column:
    """The first 60 bits of the MD5 of the key's text; the same in every engine."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Jump consistent hash of 64-bit keys, all keys at once."""
    state = keys.astype(np.uint64)
    shard = np.full(len(state), -1, np.int64)
    target = np.zeros(len(state), np.int64)
    open_ = np.arange(len(state))
    while len(open_):
        shard[open_] = target[open_]
        state[open_] = state[open_] * _STEP + np.uint64(1)
        draw = ((state[open_] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        target[open_] = ((shard[open_] + 1) * (float(1 << 31) / draw)).astype(np.int64)
        open_ = open_[target[open_] < shards]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """The shard, 0 to ``shards`` - 1, of a stable 64-bit key."""
    if shards < 1:
        raise ValueError("there must be at least one shard")

    @F.pandas_udf("int")
    def column(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))

    return column(key)


def assign(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    content = F.coalesce(F.col(text), F.lit(""))
    name = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), content)
    rows = docs.select(
        F.col(doc_id).alias("id"), (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"), F.md5(name.cast("binary")).alias("h"),
    ).groupBy("id", "size", "text_crc32", "h").agg(F.count(F.lit(1)).alias("copies"))
    keyed = rows.withColumn("key", stable_key(F.col("id")))
    placed = cut(keyed.withColumn("shard", shard_of(F.col("key"), shards)).withColumn("grown_shard", shard_of(F.col("key"), shards + 1)))
    # a null id and an id whose text is empty may share a hash, so the id's kind is part of the order
    ordered = placed.withColumn("order_key", F.concat("h", F.when(F.col("id").isNull(), "0").otherwise("1")))
    laid = running_before(ordered, ["shard"], "order_key", F.col("copies"), prefix_digits(placed.count()), "before")
    return laid.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).select(
        F.col("id").alias(doc_id), "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("before") + F.col("copy")).cast("long").alias("slot"), "grown_shard",
    )


def with_shard(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", name: str = "shard") -> DataFrame:
    """The documents with their shard; decided row by row, without a shuffle. ``name`` must be
    free in any case of letters; ``common.fresh`` finds such a name."""
    if name.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"there is already a column {name!r}")
    return docs.withColumn(name, shard_of(stable_key(F.col(doc_id)), shards))
