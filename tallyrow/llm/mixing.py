"""Mixing sources to target weights along a time-varying curriculum.

Each source's share of the training budget is its weight's share, capped at ``max_epochs``
times its own size; the excess is shared again by weight. A schedule gives the rate at which a
source is drawn over training time 0 to 1; its integral, scaled to the source's target, is the
cumulative demand for the source's words. The documents of a source lie one after another in
the order of a hash of their id and text, as often as the target needs; inverting the demand
at the middle of each use gives its training position, and the mix is sorted by position.

Rows that agree in source, id and text are copies of one document; a null text has size 0, a
null source is a source of its own, and sources without words have target 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyrow.llm.common import cut, fresh, prefix_digits, running_before, small_side

#: Fixed by the contract: weights of the sources in the order of their names, repeating.
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: Rates at equally spaced times, one schedule a weight: steady, rising, falling.
SCHEDULES = ((1.0, 1.0), (0.5, 1.5), (1.5, 0.5))
#: More sources than this are joined by shuffle.
BROADCAST_SOURCES = 100_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def doc_key(doc_id: Column, text: Column) -> Column:
    """The hash that orders the documents of a source."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))).cast("binary"))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Adds ``place`` (the source's place in the weights' cycle) and ``target`` to a table
    (source, source_size) that has one row per source.

    With the sources in the order of cap / weight, the common level is the first at which the
    remaining sources, sharing what the capped ones leave, stay below their caps.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ranked = sizes.withColumn("place", place % len(weights))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("place") + 1)
    ranked = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    order = Window.orderBy((F.col("cap") / F.col("weight")), F.col("source").asc_nulls_last())
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    ranked = ranked.withColumn("level", level).withColumn("rank", F.row_number().over(order))
    stays = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct("rank", "level"))
    ranked = ranked.withColumn("common", F.min(stays).over(everything)["level"])
    target = F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(F.least(F.col("cap"), F.col("weight") * F.col("common")))
    return ranked.select("source", "source_size", "place", target.alias("target"))


def position(share: Column, place: Column, schedules: Sequence[Sequence[float]] = SCHEDULES) -> Column:
    """The time at which a source has given ``share`` of its words: its schedule's integral,
    a quadratic between two times, inverted."""
    out = F.lit(None).cast("double")
    for p in range(len(schedules) - 1, -1, -1):
        rates = [float(r) for r in schedules[p]]
        step = 1.0 / (len(rates) - 1)
        areas = [(a + b) / 2 * step for a, b in zip(rates, rates[1:])]
        whole, done, inner = sum(areas), sum(areas), F.lit(1.0)
        for k in range(len(areas) - 1, -1, -1):
            done -= areas[k]
            left = share * whole - done
            a, slope = rates[k], (rates[k + 1] - rates[k]) / step
            root = F.sqrt(F.greatest(F.lit(a * a) + F.lit(2 * slope) * left, F.lit(0.0)))
            here = F.lit(k * step) + F.when(left <= 0, 0.0).otherwise(2.0 * left / (a + root))
            inner = here if k == len(areas) - 1 else F.when(share * whole < done + areas[k], here).otherwise(inner)
        out = F.when(place == p, inner).otherwise(out)
    return out


def plan(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    max_epochs: float = MAX_EPOCHS,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row per distinct (source, id, text): source, id, h, size, copies, source_size,
    place, target, and ``before``, the words of the source that lie before it."""
    groups = cut(
        docs.select(F.col(source).alias("source"), F.col(doc_id).alias("id"), doc_key(F.col(doc_id), F.col(text)).alias("h"), n_words(F.col(text)).alias("size"))
        .groupBy("source", "id", "h", "size")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    sizes = groups.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    goals = cut(targets(sizes, weights, max_epochs)).withColumnRenamed("source", "goal_source")
    laid = running_before(groups, ["source"], "h", F.col("size") * F.col("copies"), prefix_digits(groups.count()), "before")
    side = small_side(goals, BROADCAST_SOURCES)
    return laid.join(side, F.col("source").eqNullSafe(F.col("goal_source"))).drop("goal_source")


def taken_words(cut_last: bool = True) -> tuple[Column, Column]:
    """(full passes, words of the last pass) of a row of ``plan`` with column ``start``, the
    words of its source before it. The last pass ends inside a document if ``cut_last``,
    else with the document whose middle it reaches."""
    budget = F.floor(F.col("target") + 0.5)
    passes = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    room = budget - passes * F.col("source_size") - F.col("start")
    if cut_last:
        return passes, F.greatest(F.lit(0), F.least(room, F.col("size"))).cast("long")
    return passes, F.when(2 * room >= F.col("size"), F.when(room > 0, F.col("size")).otherwise(0)).otherwise(0).cast("long")


def shares(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    max_epochs: float = MAX_EPOCHS,
    schedules: Sequence[Sequence[float]] = SCHEDULES,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row per document in the order of its first use: doc_id, size, source_size, target,
    taken (words the mix takes of it), first_position (null when it is not used). The last
    pass over a source ends at its target exactly, inside one document."""
    rows = plan(docs, weights, max_epochs, doc_id, text, source).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    rows = rows.withColumn("start", F.col("before") + F.col("copy") * F.col("size"))
    passes, last = taken_words()
    used = F.when(passes > 0, F.col("size")).otherwise(last)
    middle = (F.col("start") + used / 2.0) / F.col("target")
    return (
        rows.select(
            F.col("id").alias(doc_id), "size", "source_size", "target", (passes * F.col("size") + last).alias("taken"),
            F.when(used > 0, position(middle, F.col("place"), schedules)).alias("first_position"),
        )
        .repartitionByRange(F.col("first_position").asc_nulls_last(), F.col(doc_id))
        .sortWithinPartitions(F.col("first_position").asc_nulls_last(), doc_id)
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    max_epochs: float = MAX_EPOCHS,
    schedules: Sequence[Sequence[float]] = SCHEDULES,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    with_position: bool = False,
) -> DataFrame:
    """The training data: every use of a document as a row, sorted by training position.

    Only whole documents are used; the last pass over a source ends with the document whose
    middle it reaches, and copies of one row are used alike. Documents without words are left
    out. All columns are kept.
    """
    rows = plan(docs, weights, max_epochs, doc_id, text, source).withColumn("start", F.col("before"))
    rows = rows.withColumn("size", F.col("size") * F.col("copies"))
    passes, last = taken_words(cut_last=False)
    rows = rows.withColumn("uses", passes + F.when(last > 0, 1).otherwise(0)).filter("uses > 0 and size > 0")
    use, at = fresh(docs, "use"), fresh(docs, "position")
    side = rows.select(*[F.col(c).alias(f"plan_{c}") for c in ("source", "id", "h", "uses", "start", "size", "source_size", "target", "place")])
    clash = {c: fresh(docs, c) for c in side.columns}
    side = side.select(*[F.col(c).alias(name) for c, name in clash.items()])
    p = {c.removeprefix("plan_"): F.col(name) for c, name in clash.items()}
    same = (doc_key(F.col(doc_id), F.col(text)) == p["h"]) & F.col(doc_id).eqNullSafe(p["id"]) & F.col(source).eqNullSafe(p["source"])
    used = docs.join(side, same).withColumn(use, F.explode(F.sequence(F.lit(0).cast("long"), p["uses"] - 1)))
    middle = F.least(F.lit(1.0), (F.col(use) * p["source_size"] + p["start"] + p["size"] / 2.0) / p["target"])
    ordered = used.withColumn(at, position(middle, p["place"], schedules))
    ordered = ordered.select(*docs.columns, at).repartitionByRange(F.col(at), F.col(doc_id)).sortWithinPartitions(at, doc_id)
    return ordered if with_position else ordered.select(*docs.columns)


ORACLE = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                  md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS place FROM s),
w AS (SELECT *, CASE place WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, source_size * 3.0::DOUBLE AS cap FROM r),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
            row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS rank FROM w),
c AS (SELECT arg_min(level, rank) AS common FROM l WHERE level <= cap / weight),
t AS (SELECT source, source_size, place, CASE WHEN source_size = 0 THEN 0.0::DOUBLE ELSE least(cap, weight * common) END AS target FROM l, c),
o AS (SELECT doc_id, size, source_size, target, place, CAST(floor(target + 0.5) AS BIGINT) AS budget,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS passes FROM o),
x AS (SELECT *, greatest(0, least(budget - passes * source_size - start, size)) AS last FROM q),
y AS (SELECT *, CASE WHEN passes > 0 THEN size ELSE last END AS used FROM x),
z AS (SELECT *, (start + used / 2.0::DOUBLE) / target AS u FROM y)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(passes * size + last AS BIGINT) AS taken,
       CASE WHEN used > 0 THEN CASE place WHEN 0 THEN 2 * u / (1.0 + sqrt(1.0))
            WHEN 1 THEN 2 * u / (0.5 + sqrt(0.25 + 2.0 * u)) ELSE 2 * u / (1.5 + sqrt(greatest(2.25 - 2.0 * u, 0))) END END AS first_position
FROM z
"""
