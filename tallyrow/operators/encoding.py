"""Texts to unit vectors: a built-in hashing encoder or any batch encoder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F, types as T

from tallyrow.functions import vocabulary as v
from tallyrow.functions.text import named

BATCH = 16


def encode_hashed(df: DataFrame, key: str, text: str = "text", dimensions: int = 256, prefix: str = v.PASSAGE_PREFIX) -> DataFrame:
    """(key, embedding): hashed term counts of the prefixed text, unit length. JVM only."""
    prefixed = df.select(named(key), F.concat(F.lit(prefix), F.coalesce(named(text), F.lit(""))).alias("__text"))
    tokens = RegexTokenizer(inputCol="__text", outputCol="__tokens", pattern=v.TERM, gaps=False)
    hashed = HashingTF(inputCol="__tokens", outputCol="__tf", numFeatures=dimensions)
    unit = Normalizer(p=2.0, inputCol="__tf", outputCol="__unit")
    encoded = unit.transform(hashed.transform(tokens.transform(prefixed)))
    return encoded.select(named(key), vector_to_array("__unit", "float32").alias("embedding"))


def encode_batches(
    df: DataFrame,
    key: str,
    encoder: Callable[[list[str]], np.ndarray],
    text: str = "text",
    prefix: str = v.PASSAGE_PREFIX,
    batch: int = BATCH,
) -> DataFrame:
    """(key, embedding) from a user-supplied encoder, called on batches of texts.

    The encoder is shipped to the tasks; load heavy models lazily inside it.
    """
    schema = T.StructType(
        [df.schema[key], T.StructField("embedding", T.ArrayType(T.FloatType()))]
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [prefix + (t or "") for t in frame[text]]
            parts = [np.asarray(encoder(texts[i : i + batch]), dtype=np.float64) for i in range(0, len(texts), batch)]
            if not parts:
                continue
            vectors = np.concatenate(parts)
            norms = np.linalg.norm(vectors, axis=1, keepdims=True)
            vectors = vectors / np.where(norms == 0, 1.0, norms)
            yield pd.DataFrame({key: frame[key], "embedding": list(vectors.astype(np.float32))})

    return df.select(named(key), named(text)).mapInPandas(run, schema)
