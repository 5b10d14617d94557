"""Benchmark decontamination: a broadcast hash set of benchmark n-grams, looked up by every
window of every training document and verified word by word.

Rows that agree in id and text are one document in the aggregation and get equal results;
each still has its own row in the report. A null text has no words. Benchmark rows without
words are ignored; windows of an item whose id is null count as hits, but the item is not
listed. Extra columns are kept by ``decontaminate`` and ignored by ``report``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyrow.llm.common import ascii_lower, cut, fresh

#: Fixed by the contract: what lies between words, after lower-casing A-Z.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: The hash set is broadcast up to this many bytes of grams and item ids; a larger one is
#: joined by shuffle, with the same result.
BROADCAST_BYTES = 64 << 20


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _gram_hash(array: Column, start: Column, length: int) -> Column:
    return F.xxhash64(*[F.get(array, start + k) for k in range(length)])


def gram_table(benchmark: DataFrame, window: int = WINDOW, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """One row per distinct window: hash, length, words joined by a space, item ids."""
    items = benchmark.select(F.col(item_id).alias("item"), words(F.col(text)).alias("w"))
    n = F.size("w")
    starts = items.filter(n > 0).select(
        "item", "w", F.least(n, F.lit(window)).alias("len"),
        F.explode(F.sequence(F.lit(0), F.greatest(n - window, F.lit(0)))).alias("start"),
    )
    h = F.coalesce(*[F.when(F.col("len") == k, _gram_hash(F.col("w"), F.col("start"), k)) for k in range(1, window + 1)])
    return (
        starts.select("item", "len", h.alias("h"), F.concat_ws(" ", F.slice("w", F.col("start") + 1, F.col("len"))).alias("gram"))
        .groupBy("h", "len", "gram")
        .agg(F.collect_set("item").alias("items"))
    )


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per distinct (id, text digest): n_words, copies, the hit windows as sorted
    (pos, len) and the sets of items they occur in."""
    grams = cut(gram_table(benchmark, window))
    lengths = sorted(r[0] for r in grams.select("len").distinct().collect()) or [window]
    size = grams.agg(F.sum(F.length("gram") + 8 * F.size("items") + 32)).first()[0] or 0
    side = grams.select("h", F.col("len").alias("g_len"), "gram", "items")
    side = F.broadcast(side) if size <= BROADCAST_BYTES else side

    tokens = docs.select(F.col(doc_id).alias("id"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("digest"), words(F.col(text)).alias("w"))
    at = tokens.select("id", "digest", "w", F.size("w").alias("n"), F.posexplode_outer("w").alias("pos", "word")).drop("word")
    keyed = [F.struct(F.lit(k).alias("len"), F.when(F.col("pos") + k <= F.col("n"), _gram_hash(F.col("w"), F.col("pos"), k)).alias("h")) for k in lengths]
    scanned = at.withColumn("win", keyed[0] if len(keyed) == 1 else F.explode(F.array(*keyed)))
    scanned = scanned.select("id", "digest", "w", "n", "pos", F.col("win.len").alias("len"), F.col("win.h").alias("wh"))
    same = (F.col("wh") == F.col("h")) & (F.col("len") == F.col("g_len")) & (F.concat_ws(" ", F.slice("w", F.col("pos") + 1, F.col("len"))) == F.col("gram"))
    first = (F.col("len") == lengths[0]) & (F.coalesce("pos", F.lit(0)) == 0)
    found = scanned.join(side, same, "left").filter(F.col("gram").isNotNull() | first)
    return found.groupBy("id", "digest", F.col("n").alias("n_words")).agg(
        F.sum(first.cast("long")).alias("copies"),
        F.array_sort(F.collect_set(F.when(F.col("gram").isNotNull(), F.struct("pos", "len")))).alias("windows"),
        F.collect_set("items").alias("item_sets"),
    )


def _covered(windows: Column) -> Column:
    """Words inside any of the sorted windows."""
    def step(acc, w):
        end = (w["pos"] + w["len"]).cast("long")
        return F.struct(F.greatest(acc["upto"], end).alias("upto"), (acc["total"] + F.greatest(F.lit(0).cast("long"), end - F.greatest(acc["upto"], w["pos"].cast("long")))).alias("total"))

    start = F.struct(F.lit(0).cast("long").alias("upto"), F.lit(0).cast("long").alias("total"))
    return F.aggregate(windows, start, step, lambda acc: acc["total"])


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    found = hits(docs, benchmark, window, doc_id, text)
    items = F.sort_array(F.array_distinct(F.flatten("item_sets")).cast("array<string>"))
    rows = found.select(
        F.col("id").alias(doc_id), F.col("n_words").cast("long").alias("n_words"), _covered(F.col("windows")).alias("n_hit"), items.alias("i"), "copies",
    ).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return rows.select(
        doc_id, "n_words", "n_hit", F.size("i").cast("long").alias("n_items"),
        F.sha2(F.array_join("i", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without those that hold a hit (``documents``), or with every hit word
    and what follows it up to the next word cut out of the text (``spans``)."""
    if mode not in ("documents", "spans"):
        raise ValueError(f"unknown mode {mode!r}")
    found = hits(docs, benchmark, window, doc_id, text).filter(F.size("windows") > 0)
    key, digest, windows = (fresh(docs, s) for s in ("hit_id", "hit_digest", "hit_windows"))
    side = found.select(F.col("id").alias(key), F.col("digest").alias(digest), F.col("windows").alias(windows))
    same = F.col(doc_id).eqNullSafe(F.col(key)) & (F.sha2(F.coalesce(F.col(text), F.lit("")), 256) == F.col(digest))
    if mode == "documents":
        return docs.join(side.select(key, digest), same, "left_anti")
    letters = SEPARATORS.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60")
    raw = F.array_remove(F.split(text, letters), "")
    gaps = F.split(text, letters.replace("[", "[^", 1))
    hit = F.flatten(F.transform(windows, lambda w: F.sequence(w["pos"], w["pos"] + w["len"] - 1)))
    kept = F.array_except(F.sequence(F.lit(0), F.size(raw) - 1), hit)
    rebuilt = F.concat(F.get(gaps, F.lit(0)), F.array_join(F.transform(kept, lambda i: F.concat(F.get(raw, i), F.get(gaps, i + 1))), ""))
    joined = docs.join(side, same, "left")
    return joined.withColumn(text, F.when(F.col(windows).isNull(), F.col(text)).otherwise(rebuilt)).select(*docs.columns)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
       regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item_id, least(len(w), 10) AS l, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0),
bg AS (SELECT DISTINCT item_id, l, array_to_string(w[i:i + l - 1], ' ') AS g FROM bw),
ls AS (SELECT DISTINCT l FROM bg),
dw AS (SELECT rid, l, w, unnest(range(1, len(w) - l + 2)) AS i FROM d, ls WHERE len(w) >= l),
h AS (SELECT rid, i, dw.l AS l, item_id FROM dw JOIN bg ON bg.l = dw.l AND bg.g = array_to_string(dw.w[i:i + dw.l - 1], ' ')),
p AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(i, i + l)) AS q FROM h) GROUP BY rid),
t AS (SELECT rid, count(DISTINCT item_id) AS n_items,
             string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s FROM h GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (rid) LEFT JOIN t USING (rid)
"""
