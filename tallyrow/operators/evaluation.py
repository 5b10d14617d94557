"""Splits, class weights and classification metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallyrow.functions import vocabulary as v
from tallyrow.functions.text import named
from tallyrow.operators.sizing import pin_if_small

_HEX_DIGITS = 4


def stratified_split(
    df: DataFrame, key: str, label: str | None, test_share: float = v.TEST_SHARE, seed: str = ""
) -> DataFrame:
    """Adds ``is_test``: per class the first ceil(share*n) rows by md5 of the key.

    Exact, yet no class is ever sorted in one place: rows are counted per class and
    hash prefix, the one prefix in which a class reaches its quota is ranked, and the
    resulting limit per class is applied as a filter. ``key`` must be unique.
    ``label=None`` splits without classes.
    """
    cls = named(label) if label else F.lit(1)
    digest = F.md5(F.concat(F.lit(seed), named(key).cast("string")))
    hashed = df.select(cls.alias("cls"), digest.alias("digest")).withColumn(
        "prefix", F.substring("digest", 1, _HEX_DIGITS)
    )
    counted = hashed.groupBy("cls", "prefix").agg(F.count(F.lit(1)).alias("c"))
    # at most 16**4 prefixes per class
    so_far = W.partitionBy("cls").orderBy("prefix").rowsBetween(W.unboundedPreceding, W.currentRow)
    quota = F.ceil(F.round(F.sum("c").over(W.partitionBy("cls")) * test_share, 9))
    reached = counted.select("cls", "prefix", "c", F.sum("c").over(so_far).alias("upto"), quota.alias("quota"))
    turning = reached.filter((F.col("upto") >= F.col("quota")) & (F.col("upto") - F.col("c") < F.col("quota")))
    turning = pin_if_small(
        turning.select("cls", "prefix", (F.col("quota") - F.col("upto") + F.col("c")).alias("wanted"))
    )
    place = F.row_number().over(W.partitionBy("cls").orderBy("digest"))
    edge = (
        hashed.join(turning.toDF("__tc", "__tp", "wanted"), F.col("cls").eqNullSafe(F.col("__tc")) & (F.col("prefix") == F.col("__tp")))
        .withColumn("place", place)
        .filter("place = wanted")
        .select(F.col("cls").alias("__cls"), F.col("digest").alias("__edge"))
    )
    marked = df.withColumns({"__c": cls, "__digest": digest})
    joined = marked.join(pin_if_small(edge), F.col("__c").eqNullSafe(F.col("__cls")), "left")
    is_test = F.coalesce(F.col("__digest") <= F.col("__edge"), F.lit(False))
    return joined.withColumn("is_test", is_test).drop("__c", "__digest", "__cls", "__edge")


def require_labels(df: DataFrame, label: str) -> None:
    if label not in df.columns or df.agg(F.count(named(label))).first()[0] == 0:
        raise ValueError(f"no {label!r} labels found: cannot train")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight) with weight = rows / (classes * rows of the class)."""
    counts = df.groupBy(named(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"))
    return counts.join(F.broadcast(total)).select(
        "label", "n", (F.col("rows") / (F.col("classes") * F.col("n"))).alias("weight")
    )


def with_class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    weights = class_weights(df, label).select(F.col("label").alias("__label"), F.col("weight").alias(name))
    return df.join(pin_if_small(weights), named(label) == F.col("__label")).drop("__label")


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def classification_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """(class, precision, recall, f1, support) per class, then the averages.

    One pass counts (truth, predicted) pairs; all else happens on those few rows.
    """
    pairs = df.groupBy(named(truth).cast("string").alias("t"), named(predicted).cast("string").alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    sides = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("t").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("claimed"),
                         F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0).alias("hits")),
                F.struct(F.col("p").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("claimed"),
                         F.lit(0).cast("bigint").alias("hits")),
            )
        ).alias("s")
    ).select("s.*")
    sums = sides.groupBy("class").agg(F.sum("support").alias("support"), F.sum("claimed").alias("claimed"), F.sum("hits").alias("hits"))
    precision, recall = _ratio(F.col("hits"), F.col("claimed")), _ratio(F.col("hits"), F.col("support"))
    per_class = sums.select(
        "class", precision.alias("precision"), recall.alias("recall"),
        _ratio(2 * precision * recall, precision + recall).alias("f1"), "support", "hits",
    )
    n = F.sum("support")
    weighted = lambda c: _ratio(F.sum(F.col(c) * F.col("support")), n)
    averages = per_class.agg(
        F.array(
            F.struct(F.lit("accuracy").alias("class"), _ratio(F.sum("hits"), n).alias("precision"),
                     _ratio(F.sum("hits"), n).alias("recall"), _ratio(F.sum("hits"), n).alias("f1"), n.alias("support")),
            F.struct(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                     F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), n.alias("support")),
            F.struct(F.lit("weighted avg").alias("class"), weighted("precision").alias("precision"),
                     weighted("recall").alias("recall"), weighted("f1").alias("f1"), n.alias("support")),
        ).alias("a")
    ).select(F.explode("a").alias("a")).select("a.*")
    return per_class.drop("hits").unionByName(averages)


def confusion_matrix(df: DataFrame, truth: str, predicted: str, labels: list) -> DataFrame:
    """One row per true label and one column per predicted label, in the given order."""
    spark = df.sparkSession
    text = [str(x) for x in labels]
    counted = df.groupBy(named(truth).cast("string").alias("truth")).agg(
        *[F.count_if(named(predicted).cast("string") == x).alias(f"predicted_{x}") for x in text]
    )
    wanted = spark.createDataFrame(list(enumerate(text)), "place int, truth string")
    return (
        F.broadcast(wanted)
        .join(counted, "truth", "left")
        .select("truth", *[F.coalesce(F.col(f"predicted_{x}"), F.lit(0)).cast("bigint").alias(f"predicted_{x}") for x in text])
    )


def accuracy(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    hit = named(truth).eqNullSafe(named(predicted)).cast("int")
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(hit).alias("correct"), F.avg(hit.cast("double")).alias("accuracy"))
