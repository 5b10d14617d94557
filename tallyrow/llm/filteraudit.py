"""Filter interaction audit by path counting on the subset lattice.

A document's failures are one bit a filter. Documents are summed by part and failure pattern,
of which there are at most 2^k; nothing later touches a document. The states of the lattice are
the sets of filters applied so far, its edges apply one more. Forward counts say how many orders
reach a state, backward counts how many ways lead from it to the full set, so an edge lies on
forward * backward of the k! orders. An edge's removals are sums over the patterns; weighted by
its orders and added up over a filter's edges they give the filter's Shapley total, and a step
of an order reads the edge between its prefix and the next.

One filter may ask for copies: it fails a text that a smaller id has too. Texts meet by their
256-bit digest, after rows that agree in all that matters were counted in the map tasks, so a
text that a third of all rows share is a few rows for each task.

Null texts are empty, null parts the empty string. A null id is larger than every other and no
smaller than another null. Rows repeated with one id are all first if that id is the smallest.
Several label rows of an id count as one that has each mark any of them has; no label row, no
mark. Texts are looked at whole. Only the columns named are read, so others may clash. An empty
table has no parts and gives no rows.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyrow.llm.common import cut

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The filter that fails copies.
COPIES = "E"
#: Orders are written out, k! of them.
MAX_FILTERS = 7


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions of a text: too few words, few different words, many capitals, signs."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    capitals = F.length(text) - F.length(F.translate(text, _CAPITALS, ""))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * capitals > 10 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def patterns(docs: DataFrame, labels: DataFrame, filters: dict[str, Column], copies: str | None = COPIES, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and failure pattern. Bit i of ``mask``
    is the i-th of the filters and ``copies`` in the order of their names. ``filters`` are
    conditions on the column ``text``, with null texts made empty."""
    names = sorted([*filters, *([copies] if copies else [])])
    if len(names) > MAX_FILTERS:
        raise ValueError(f"at most {MAX_FILTERS} filters")
    content = F.coalesce(F.col(text), F.lit("")).alias("text")
    mask = sum((F.when(filters[name], 1 << names.index(name)).otherwise(0) for name in filters), F.lit(0))
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), content)
    rows = rows.select("id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest"))
    marks = labels.groupBy(F.col(doc_id).alias("id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).cast("int").alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).cast("int").alias("toxic"),
    )
    counted = rows.groupBy("id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n")).join(marks, "id", "left").fillna(0, ["good", "toxic"])
    group = ["part", "mask", "good", "toxic"]
    # of each digest's rows with one part and marks: how many, and how many of the smallest id
    age = F.struct(F.col("id").isNull().alias("none"), "id")
    texts = cut(counted.groupBy("digest", *group).agg(F.sum("n").alias("n"), F.min(F.struct(age.alias("age"), "n")).alias("first")))
    oldest = texts.groupBy("digest").agg(F.min("first.age").alias("oldest"))
    stay = F.when(F.col("first.age") == F.col("oldest"), F.col("first.n")).otherwise(F.lit(0))
    if copies:
        bit = 1 << names.index(copies)
        split = F.array(F.struct(F.col("mask"), stay.alias("n")), F.struct((F.col("mask") + bit).alias("mask"), (F.col("n") - stay).alias("n")))
        texts = texts.join(oldest, "digest").select("part", "good", "toxic", F.inline(split))
    total = lambda c: F.sum(c).cast("long")
    return texts.groupBy("part", "mask").agg(total("n").alias("n"), total(F.col("n") * F.col("good")).alias("good"), total(F.col("n") * F.col("toxic")).alias("toxic"))


def path_counts(k: int) -> tuple[list[int], list[int]]:
    """Orders that reach each subset of k filters, and that lead from it to the whole set."""
    full = (1 << k) - 1
    forward, backward = [0] * (full + 1), [0] * (full + 1)
    forward[0] = backward[full] = 1
    for state in range(1, full + 1):
        forward[state] = sum(forward[state ^ (1 << i)] for i in range(k) if state >> i & 1)
    for state in range(full - 1, -1, -1):
        backward[state] = sum(backward[state | 1 << i] for i in range(k) if not state >> i & 1)
    return forward, backward


def _lattice(spark: SparkSession, k: int) -> DataFrame:
    """(before, bit, paths): the edges, with the number of orders through each."""
    forward, backward = path_counts(k)
    rows = [(s, 1 << i, forward[s] * backward[s | 1 << i]) for s in range(1 << k) for i in range(k) if not s >> i & 1]
    return spark.createDataFrame(rows, "before int, bit int, paths long")


def edges(found: DataFrame, k: int) -> DataFrame:
    """One row for each part and edge (before, bit): kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, paths, and the filter's shapley total over all orders."""
    before, bit, mask = F.col("before"), F.col("bit"), F.col("mask")
    spread = (
        found.withColumn("before", F.explode(F.sequence(F.lit(0), F.lit((1 << k) - 1))))
        .withColumn("bit", F.explode(F.array(*[F.lit(1 << i) for i in range(k)])))
        .filter(before.bitwiseAND(bit) == 0)
    )
    alive, fails = mask.bitwiseAND(before) == 0, mask.bitwiseAND(bit) != 0
    total = lambda when, what="n": F.sum(F.when(when, F.col(what)).otherwise(F.lit(0))).cast("long")
    sums = spread.groupBy("part", "before", "bit").agg(
        total(alive & ~fails).alias("kept"), total(alive & fails).alias("removed"), total(~alive & fails).alias("redundant"),
        total(mask == bit).alias("unique_fails"), total(alive & fails, "good").alias("good_lost"), total(alive & fails, "toxic").alias("toxic_lost"),
    )
    weighted = sums.join(F.broadcast(_lattice(found.sparkSession, k)), ["before", "bit"])
    value = weighted.groupBy("part", "bit").agg(F.sum(F.col("removed") * F.col("paths")).alias("shapley"))
    return weighted.join(value, ["part", "bit"])


def steps(found: DataFrame, names: str) -> DataFrame:
    """One row for each part, order of the filters and step, read from the lattice's edges."""
    bits = {name: 1 << i for i, name in enumerate(names)}
    rows = [("".join(o), s + 1, sum(bits[x] for x in o[:s]), bits[o[s]]) for o in permutations(names) for s in range(len(names))]
    orders = found.sparkSession.createDataFrame(rows, "filter_order string, step int, before int, bit int")
    return edges(found, len(names)).join(F.broadcast(orders), ["before", "bit"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """The four text filters and the copies filter, in all orders, for each part."""
    found = patterns(docs, labels, text_filters(F.col("text")), COPIES, doc_id, text, part)
    return steps(found, "ABCD" + COPIES)


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS low FROM d),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT w.part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(ws) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN (w.doc_id IS NULL AND low IS NOT NULL) OR w.doc_id > low THEN 'E' ELSE '' END AS fails
  FROM w LEFT JOIN marks ON w.doc_id = marks.doc_id),
p AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
s AS (SELECT filter_order, step, substr(filter_order, 1, step - 1) AS before, substr(filter_order, step, 1) AS own FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
r AS (
  SELECT part, filter_order, step, own, n, good, toxic, fails,
    length(translate(fails, before, '')) = length(fails) AS alive, contains(fails, own) AS fail FROM p, s),
g AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN alive AND NOT fail THEN n ELSE 0 END) AS kept, sum(CASE WHEN alive AND fail THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN NOT alive AND fail THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN alive AND fail THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN alive AND fail THEN toxic ELSE 0 END) AS toxic_lost
  FROM r GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM g
"""
