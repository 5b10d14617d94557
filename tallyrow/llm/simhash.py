"""SimHash near-dedup with vantage-point trees.

Two fingerprints within ``max_bits`` of each other are within half of that in one of their
halves. So there is a tree for each half: built from a bounded sample, it cuts the space into
leaves, each node having a vantage point and a median distance, and a fingerprint goes inside
or outside. Every distinct fingerprint lives in one leaf of each tree and is also sent, as a
query, to each later leaf whose region the ball around it may cross by the triangle
inequality; branches that it cannot cross are pruned. With the smaller ball of a half, far
fewer leaves are crossed than with whole fingerprints. Inside a leaf all pairs are compared
exactly, over all 64 bits. Leaves that hold more than
their share are cut into blocks, so a task holds a bounded number of homes and queries. A
task returns a spanning forest of the links it found, never the pairs themselves; components
are then merged by star contraction.

The sample only shapes the trees; the result is exact whatever they look like.

A text without words (null and empty ones too) has fingerprint zero and is linked like any
other. Equal fingerprints are one node. Null ids are ignored when the smallest id of a group
is sought; a group of null ids only has a null component id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tallyrow.llm.common import cut, fresh
from tallyrow.session import scratch_path

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: The bits that each tree looks at.
PARTS = (0xFFFFFFFF, 0xFFFFFFFF00000000)
#: Fingerprints the trees are built from, at most about.
SAMPLE = 16_384
#: Homes and queries that one task compares.
HOMES, QUERIES = 4_096, 262_144

_BLOCK = 1 << 16
_LANES = np.uint64(0x0101010101010101)
_SHIFTS = np.arange(8, dtype=np.uint64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """A bit is set when it is set in over half of the shingles' XXH64 values."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    width = min(shingle, len(words))
    hashes = map(xxhash.xxh64_intdigest, map(b" ".join, zip(*(words[i:] for i in range(width)))), repeat(SEED))
    ones, n = np.zeros(64, np.int64), 0
    while len(block := np.fromiter(islice(hashes, _BLOCK), np.uint64)):
        n += len(block)
        rows = -(-len(block) // 255)
        lanes = np.zeros((rows * 255, 8), np.uint64)
        lanes[: len(block)] = (block[:, None] >> _SHIFTS) & _LANES
        # eight one-byte counters in each word: 255 rows cannot overflow them
        counts = lanes.reshape(rows, 255, 8).sum(axis=1).view(np.uint8).reshape(rows, 8, 8)
        ones += counts.sum(axis=0, dtype=np.int64).T.reshape(64)
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def simhash(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a signed 64-bit integer."""

    @F.pandas_udf("long")
    def column(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).astype(np.int64))

    return column(text)


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def build_tree(points: np.ndarray, leaf: int, reach: int, seed: int = 7):
    """Nodes (vantage, radius, inside, outside); a leaf is its number. Of some candidates the
    vantage point is taken whose border the fewest balls of radius ``reach`` cross."""
    rng, numbers = np.random.default_rng(seed), iter(range(len(points) + 1))

    def grow(own: np.ndarray):
        if len(own) > leaf:
            best = None
            for v in own[rng.choice(len(own), min(8, len(own)), replace=False)]:
                d = _distance(own, v).astype(np.int64)
                radius = int(np.median(d))
                if d.max() > radius:
                    crossing = int(((d > radius - reach) & (d <= radius + reach)).sum())
                    if best is None or crossing < best[0]:
                        best = crossing, v, radius, d
            if best:
                _, v, radius, d = best
                return v, radius, grow(own[d <= radius]), grow(own[d > radius])
        return next(numbers)

    return grow(points)


def route(tree, points: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the point, leaf, is it the point's home) for each leaf its ball may reach."""
    found: list[tuple[np.ndarray, int, np.ndarray]] = []

    def go(node, at: np.ndarray, home: np.ndarray) -> None:
        if not len(at):
            return
        if isinstance(node, int):
            found.append((at, node, home))
            return
        vantage, radius, inside, outside = node
        d = _distance(points[at], vantage).astype(np.int64)
        near, far = d - reach <= radius, d + reach > radius
        go(inside, at[near], (home & (d <= radius))[near])
        go(outside, at[far], (home & (d > radius))[far])

    go(tree, np.arange(len(points)), np.ones(len(points), bool))
    return (
        np.concatenate([f[0] for f in found] or [np.zeros(0, np.int64)]),
        np.concatenate([np.full(len(f[0]), f[1]) for f in found] or [np.zeros(0, np.int64)]),
        np.concatenate([f[2] for f in found] or [np.zeros(0, bool)]),
    )


def spanning(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For edges a-b over 0..n-1: the nodes that are not the smallest of their component,
    and the smallest."""
    label = np.arange(n)
    while True:
        la, lb = label[a], label[b]
        if (la == lb).all():
            break
        least = np.minimum(la, lb)
        np.minimum.at(label, la, least)
        np.minimum.at(label, lb, least)
        while (label != label[label]).any():
            label = label[label]
    rest = np.flatnonzero(label != np.arange(n))
    return rest, label[rest]


def _links(homes: np.ndarray, queries: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of all links between a home and a query."""
    nodes, where = np.unique(np.concatenate([homes, queries]), return_inverse=True)
    h, q = where[: len(homes)], where[len(homes) :]
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    step, held = max(1, (1 << 18) // max(1, len(homes))), []
    for start in range(0, len(queries), step):
        close = _distance(queries[start : start + step, None], homes[None, :]) <= max_bits
        i, j = np.nonzero(close)
        i, j = q[start + i], h[j]
        keep = i != j
        held.append((i[keep], j[keep]))
        if sum(len(x) for x, _ in held) > 1 << 19:
            a, b = spanning(np.concatenate([a, *(x for x, _ in held)]), np.concatenate([b, *(y for _, y in held)]), len(nodes))
            held = []
    a, b = spanning(np.concatenate([a, *(x for x, _ in held)]), np.concatenate([b, *(y for _, y in held)]), len(nodes))
    return nodes[a], nodes[b]


def links(prints: DataFrame, max_bits: int = MAX_BITS, homes: int = HOMES, queries: int = QUERIES, sample: int = SAMPLE) -> DataFrame:
    """Edges (u, v) between distinct fingerprints (column ``fp``) that connect exactly those
    within ``max_bits`` of each other, directly or through others."""
    n = prints.count()
    share = min(1.0, sample / max(n, 1))
    picked = prints.filter(F.pmod(F.xxhash64("fp"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("fp")
    points = np.sort(np.array([r[0] for r in picked.collect()], np.int64)).view(np.uint64)
    reach = max_bits // len(PARTS)
    share_of_leaf = max(8, int(homes * len(points) / max(n, 1)))
    trees = [(np.uint64(mask), build_tree(points & np.uint64(mask), share_of_leaf, reach)) for mask in PARTS]

    def leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = batch["fp"].to_numpy()
            for part, (mask, tree) in enumerate(trees):
                at, leaf, home = route(tree, fps.view(np.uint64) & mask, reach)
                own = np.zeros(len(fps), np.int64)
                own[at[home]] = leaf[home]
                later = leaf >= own[at]  # a pair across two leaves is found in the later one
                yield pd.DataFrame({"leaf": leaf[later] * len(PARTS) + part, "home": home[later], "fp": fps[at[later]]})

    routed = prints.select("fp").mapInPandas(leaves, "leaf long, home boolean, fp long")
    sizes = routed.groupBy("leaf").agg(F.sum(F.col("home").cast("long")).alias("h"), F.count(F.lit(1)).alias("q")).collect()
    blocks = {r["leaf"]: (-(-r["h"] // (2 * homes)) or 1, -(-r["q"] // queries)) for r in sizes}  # one entry a leaf of the trees
    blocked = {k: v for k, v in blocks.items() if v != (1, 1)}

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each home goes to its row of blocks, each query to its column."""
        for batch in batches:
            split = batch["leaf"].isin(blocked.keys())
            plain = batch[~split]
            own = plain[plain["home"]]
            parts = [plain.assign(i=0, j=0, home=False), own.assign(i=0, j=0)]
            for leaf, rows in batch[split].groupby("leaf"):
                a, b = blocked[leaf]
                mixed = rows["fp"].to_numpy().view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                i, j = (mixed >> np.uint64(33)) % np.uint64(a), (mixed >> np.uint64(13)) % np.uint64(b)
                parts += [rows.assign(i=k, j=j.astype(np.int64), home=False) for k in range(a)]
                own, mine = rows[rows["home"]], i[rows["home"].to_numpy()].astype(np.int64)
                parts += [own.assign(i=mine, j=k) for k in range(b)]
            yield pd.concat(parts)[["leaf", "i", "j", "home", "fp"]]

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        fps, home = group["fp"].to_numpy().view(np.uint64), group["home"].to_numpy()
        u, v = _links(fps[home], fps[~home], max_bits)
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    dealt = routed.mapInPandas(deal, "leaf long, i long, j long, home boolean, fp long")
    return dealt.groupBy("leaf", "i", "j").applyInPandas(compare, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v): the root is the component's smallest
    node. Large and small stars alternate until nothing changes."""

    def least(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))

    def state(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    now = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct())
    seen = state(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(least(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        low = least(large)
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        now = cut(small.filter("u != v").distinct())
        if (after := state(now)) == seen:
            break
        seen = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def group_roots(rows: DataFrame, max_bits: int = MAX_BITS, **sizes: int) -> DataFrame:
    """(fp, root) for every distinct ``fp`` of the rows."""
    prints = cut(rows.select("fp").distinct())
    roots = components(links(prints, max_bits, **sizes))
    return prints.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, doc_id: str = "doc_id", text: str = "text", **sizes: int) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex), component_id (smallest id reachable)."""
    rows = cut(docs.select(F.col(doc_id).alias("id"), simhash(F.col(text), shingle).alias("fp")))
    roots = cut(group_roots(rows, max_bits, **sizes))
    smallest = rows.groupBy("fp").agg(F.min("id").alias("low")).join(roots, "fp")
    component = smallest.join(smallest.groupBy("root").agg(F.min("low").alias("component_id")), "root").select("fp", "component_id")
    return rows.join(component, "fp").select(
        F.col("id").alias(doc_id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, doc_id: str = "doc_id", text: str = "text", **sizes: int) -> DataFrame:
    """The documents that stay: of each component the row with the smallest id, null ids
    last; among repeated rows one. All columns are kept."""
    fp, rid = fresh(docs, "fp"), fresh(docs, "rid")
    path = scratch_path(docs.sparkSession, "simhash")
    docs.withColumn(fp, simhash(F.col(text), shingle)).withColumn(rid, F.monotonically_increasing_id()).write.parquet(path)
    held = docs.sparkSession.read.parquet(path)
    rows = held.select(F.col(fp).alias("fp"), F.col(rid).alias("rid"), F.col(doc_id).alias("id"))
    roots = group_roots(rows, max_bits, **sizes)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("rid"))).alias("first")
    best = rows.groupBy("fp").agg(first).join(roots, "fp").groupBy("root").agg(F.min("first").alias("first"))
    stay = best.select(F.col("first.rid").alias("stays"))
    return held.join(stay, F.col(rid) == F.col("stays"), "left_semi").select(*docs.columns)
