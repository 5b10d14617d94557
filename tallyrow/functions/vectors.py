"""Vector arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def l2_normalize(a: Column) -> Column:
    norm = F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.when(norm > 0, F.transform(a, lambda x: x.cast("double") / norm)).otherwise(
        F.transform(a, lambda x: x.cast("double"))
    )
