"""Merkle manifest of a dataset: a leaf for every row, a tree for every group, a tree of groups.

Leaves take their places without a sort. Bit maps say which ids a group has: a word holds 64
neighbouring ids, only words with a bit exist, and directories of popcounts lie above them, a
node for 1,024 nodes below, as many levels as the range of ids needs. A leaf's place is the
number of rows in earlier siblings of each level (running sums among at most 1,024 siblings)
and the popcount of the lower bits of its own word. Words in which an id repeats also carry
the counts of their ids.

Trees are reduced by keyed slot arrays: nodes are dealt by (tree, place / 16^3), put into the
slots of their place and hashed three levels up, so each shuffle passes a 4,096th of the nodes
on and no task holds more than 4,096 nodes of a tree at once, whatever a group's size. On the
way back every block gets the siblings above it once, and each leaf its proof in the block.

Null groups are a group of their own, first in order. Null ids come first in their group. Rows of
one id are ordered by their leaf; those with equal leaves are alike, and take the places in any
order. A row with a null id is never tampered with. Texts are hashed whole. Only the columns
named are read, so others may clash. An empty table has no root and gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyrow.llm.common import ascii_lower, small_side
from tallyrow.operators.ordinals import ordinals
from tallyrow.operators.sizing import staged

FAN = 16
#: Levels that one shuffle reduces.
LEVELS = 3
BLOCK = FAN**LEVELS
#: Bits of a word, and of a directory node's number of children.
WORD, NODE = 6, 10
#: Groups up to which a row for each is broadcast.
GROUPS = 100_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf(*fields: Column) -> Column:
    """SHA-256 over the fields: ``-`` for null, else the value's bytes, ``:``, the value."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def bitmaps(rows: DataFrame) -> DataFrame:
    """(tree, word, bits, n, copies): the bit maps of the ids in each tree, in words of 64
    neighbours. ``copies`` counts the ids of a word that holds more rows than bits."""
    place = F.col("id").bitwiseAND(63).cast("int")
    return (
        rows.filter("id IS NOT NULL")
        .groupBy("tree", F.shiftright("id", WORD).alias("word"), place.alias("bit"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("tree", "word")
        .agg(
            F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"), F.sum("n").alias("n"),
            F.collect_list(F.when(F.col("n") > 1, F.struct("bit", (F.col("n") - 1).alias("more")))).alias("copies"),
        )
    )


def directory(words: DataFrame) -> DataFrame:
    """``words`` with ``base``: the rows of the same tree in earlier words. Counts are added up
    among the children of one node, level by level, never along a whole tree."""
    low, high = words.agg(F.min("word"), F.max("word")).first()
    if low is None:
        return words.withColumn("base", F.lit(0).cast("long"))
    words = words.withColumn("node", F.col("word") - F.lit(low))
    levels, nodes, span = [], words.select("tree", "node", "n"), high - low
    while span:
        span >>= NODE
        levels.append(nodes)
        nodes = nodes.groupBy("tree", F.shiftright("node", NODE).alias("node")).agg(F.sum("n").alias("n"))
    base = nodes.select("tree", F.col("node").alias("above"), F.lit(0).cast("long").alias("start"))
    among = Window.partitionBy("tree", "above").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    for nodes in reversed(levels):
        inner = nodes.withColumn("above", F.shiftright("node", NODE)).withColumn("inside", F.coalesce(F.sum("n").over(among), F.lit(0)))
        base = inner.join(base, ["tree", "above"]).select("tree", F.col("node").alias("above"), (F.col("start") + F.col("inside")).alias("start"))
    return words.join(base.select("tree", F.col("above").alias("node"), F.col("start").alias("base")), ["tree", "node"]).drop("node")


def places(rows: DataFrame) -> DataFrame:
    """Adds ``place`` (0, 1, ... in ascending id order) to written rows (tree, id, leaf, rid);
    ``rid`` tells rows apart and its high bits the task that wrote them."""
    words = staged(directory(staged(bitmaps(rows), "bitmaps")), "directory")
    nulls = rows.filter("id IS NULL").groupBy("tree").agg(F.count(F.lit(1)).alias("nulls"))
    below = F.expr("bit_count(bits & ~shiftleft(-1L, cast(id & 63 as int)))")
    more = F.expr("aggregate(filter(copies, c -> c.bit < (id & 63)), 0L, (a, c) -> a + c.more)")
    repeats = F.expr("exists(copies, c -> c.bit = (id & 63))")
    known = rows.filter("id IS NOT NULL").withColumn("word", F.shiftright("id", WORD)).join(words, ["tree", "word"])
    ranked = known.select(*rows.columns, (F.col("base") + below + more).alias("place"), repeats.alias("repeats"))
    every = ranked.unionByName(rows.filter("id IS NULL").select("*", F.lit(0).cast("long").alias("place"), F.lit(True).alias("repeats")))
    shifted = every.join(small_side(nulls, GROUPS), "tree", "left")
    place = F.col("place") + F.when(F.col("id").isNull(), F.lit(0)).otherwise(F.coalesce("nulls", F.lit(0)))
    placed = shifted.select(*rows.columns, place.alias("place"), "repeats")
    if not words.filter(F.size("copies") > 0).limit(1).count() and not nulls.limit(1).count():
        return placed.drop("repeats")
    return placed.filter("NOT repeats").drop("repeats").unionByName(_ties(placed.filter("repeats").drop("repeats")))


def _ties(rows: DataFrame) -> DataFrame:
    """Spreads rows of one (tree, place) over the places from there on, by leaf. Equal leaves
    are numbered inside the tasks that wrote them, after the tasks before."""
    rows = staged(rows.withColumn("task", F.shiftright("rid", 33)), "ties")
    key = ["tree", "place", "leaf"]
    counts = rows.groupBy(*key, "task").agg(F.count(F.lit(1)).alias("n"))
    leaves = counts.groupBy(*key).agg(F.sum("n").alias("all"))
    earlier = lambda by, over, n: F.coalesce(F.sum(n).over(Window.partitionBy(*by).orderBy(over).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    leaves = leaves.select(*key, earlier(["tree", "place"], "leaf", "all").alias("smaller"))
    offsets = counts.select(*key, "task", earlier(key, "task", "n").alias("before")).join(leaves, key)
    own = F.row_number().over(Window.partitionBy(*key, "task").orderBy("rid")) - 1
    return rows.withColumn("own", own).join(offsets, [*key, "task"]).withColumn("place", F.col("place") + F.col("smaller") + F.col("before") + F.col("own")).drop("task", "own", "smaller", "before")


def _hash(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def _heights(count: int) -> int:
    """Levels of a tree of ``count`` leaves."""
    levels = 0
    while count > 1:
        count, levels = -(-count // FAN), levels + 1
    return levels


def _climb(digests: list[str], levels: int) -> list[list[list[str]]]:
    """The slot arrays of each level, lowest first, and the top nodes as a last one."""
    up = []
    for _ in range(levels):
        runs = [digests[i : i + FAN] for i in range(0, len(digests), FAN)]
        up.append(runs)
        digests = [_hash(*run) for run in runs]
    return [*up, [digests]]


def _block() -> Column:
    return F.shiftright("slot", BLOCK.bit_length() - 1).alias("block")


def _in_block(group: pd.DataFrame) -> pd.DataFrame:
    return group.sort_values("slot", kind="stable")


def reduce_once(nodes: DataFrame) -> DataFrame:
    """Nodes (tree, slot, digest, height) of trees with some height left, up to LEVELS levels
    higher. Heights are at least 1."""

    def top(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group, height = _in_block(group), int(group["height"].iloc[0])
        levels = min(LEVELS, height)
        return pd.DataFrame({"tree": [key[0]], "slot": [key[1]], "digest": _climb(group["digest"].tolist(), levels)[-1][0], "height": [height - levels]})

    return nodes.groupBy("tree", _block()).applyInPandas(top, "tree long, slot long, digest string, height int")


def _pairs(up: list[list[list[str]]], at: int) -> list[str]:
    """What stands before and after a node in its run, level by level."""
    out = []
    for runs in up[:-1]:
        run, i = runs[at // FAN], at % FAN
        out += ["".join(run[:i]), "".join(run[i + 1 :])]
        at //= FAN
    return out


def paths_below(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """(tree, slot, path) of the nodes (tree, slot, digest, height), with the paths
    (tree, slot, path) of their blocks."""

    def down(key: tuple, group: pd.DataFrame, over: pd.DataFrame) -> pd.DataFrame:
        if not len(group):  # the path of a tree that ends below this stage
            return pd.DataFrame({"tree": [], "slot": [], "path": pd.Series([], dtype=object)})
        group = _in_block(group)
        up, rest = _climb(group["digest"].tolist(), min(LEVELS, int(group["height"].iloc[0]))), list(over["path"].iloc[0])
        return pd.DataFrame({"tree": group["tree"], "slot": group["slot"], "path": [_pairs(up, i) + rest for i in range(len(group))]})

    return _with_blocks(nodes, above).applyInPandas(down, "tree long, slot long, path array<string>")


def _with_blocks(nodes: DataFrame, above: DataFrame):
    return nodes.groupBy("tree", _block()).cogroup(above.groupBy("tree", F.col("slot").alias("block")))


def grow(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """All stages of the nodes (tree, slot, digest, height), lowest first, and the tops of the
    finished trees: (tree, digest)."""
    stages, tops, now = [], [], nodes
    while True:
        tops.append(now.filter("height = 0").select("tree", "digest"))
        now = now.filter("height > 0")
        if not now.limit(1).count():
            break
        stages.append(now)
        now = staged(reduce_once(now), "nodes")
    done = tops[0]
    for t in tops[1:]:
        done = done.unionByName(t)
    return stages, done


def manifest(rows: DataFrame, group: str, id_: str, digest: str, changed: str) -> DataFrame:
    """One row for each of ``rows``: its id, leaf, the root of its group's tree (subroot), the
    dataset's root, proof_sha256 over all siblings from the leaf up, folded_root of the leaf
    in ``changed``, and whether that is the root."""
    read = rows.select(F.col(group).cast("string").alias("source"), F.col(id_).cast("long").alias("id"), F.col(digest).alias("leaf"), F.col(changed).alias("changed"))
    written = staged(read.withColumn("rid", F.monotonically_increasing_id()), "leaves")
    # levels of a tree: the digits of its last place, base 16
    counted = written.groupBy("source").agg(F.count(F.lit(1)).alias("n")).withColumn("height", F.when(F.col("n") > 1, F.length(F.hex(F.col("n") - 1))).otherwise(0))
    sizes = staged(ordinals(counted, "source", "tree"), "sizes")
    small = small_side(sizes, GROUPS)
    keyed = written.join(small, written["source"].eqNullSafe(small["source"])).select("tree", "id", "leaf", "changed", "rid", "height")
    leaves = staged(places(keyed).withColumnRenamed("place", "slot"), "places")
    stages, subroots = grow(leaves.select("tree", "slot", F.col("leaf").alias("digest"), "height"))
    subroots = staged(subroots, "subroots")
    trees = sizes.count()
    over = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("slot"), "digest", F.lit(_heights(trees)).alias("height"))
    upper, top = grow(over)
    root = (top.first() or [None, None])[1]
    # back: the paths of the groups' trees, then stage by stage to the blocks of leaves
    path = over.sparkSession.createDataFrame([(0, 0, [])], "tree long, slot long, path array<string>")
    for stage in reversed(upper):
        path = staged(paths_below(stage, path), "paths")
    if not upper:
        path = over.select("tree", "slot", F.array().cast("array<string>").alias("path"))
    path = path.select(F.col("slot").alias("tree"), F.lit(0).cast("long").alias("slot"), "path")
    trunk = subroots.join(path, "tree").select("tree", "slot", "path", F.col("digest").alias("subroot"))
    trunk = staged(trunk, "trunks")
    below = trunk.select("tree", "slot", "path")
    single = sizes.filter("height = 0").select("tree")
    paths = below.join(single, "tree", "left_anti")
    for stage in reversed(stages[1:]):
        reached = staged(paths_below(stage, paths), "paths")
        # trees that start lower keep their top's path
        paths = reached.unionByName(paths.join(stage.select("tree").distinct(), "tree", "left_anti"))
    schema = "id long, leaf string, rid long, tree long, proof_sha256 string, folded_root string"

    def prove(key: tuple, group: pd.DataFrame, over: pd.DataFrame) -> pd.DataFrame:
        group = _in_block(group)
        up, rest = _climb(group["leaf"].tolist(), min(LEVELS, int(group["height"].iloc[0]))), list(over["path"].iloc[0])
        proofs, folded = [], []
        for at, own in enumerate(group["changed"]):
            pairs = _pairs(up, at) + rest
            proofs.append(_hash(*pairs))
            for before, after in zip(pairs[::2], pairs[1::2]):
                own = _hash(before, own, after)
            folded.append(own)
        return group[["id", "leaf", "rid", "tree"]].assign(proof_sha256=proofs, folded_root=folded)

    every = paths.unionByName(below.join(single, "tree"))
    nodes = leaves.select("tree", "slot", "id", "leaf", "changed", "height", "rid")
    proved = _with_blocks(nodes, every).applyInPandas(prove, schema)
    sub = small_side(trunk.select("tree", "subroot"), GROUPS)
    return proved.join(sub, "tree").select(
        F.col("id").alias(id_), "leaf", "subroot", F.lit(root).alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == F.lit(root)).alias("verified")
    )


def tamper_check(docs: DataFrame) -> DataFrame:
    """The manifest of documents, with every leaf folded up again: where 5 divides the CRC-32
    of the id, from a text whose A-Z are in lower case."""
    fields = [F.col(c) for c in FIELDS]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    other = F.when(hit, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    rows = docs.select("doc_id", "source", leaf(*fields).alias("leaf"), F.when(hit, leaf(*fields[:-1], other)).otherwise(F.lit(None)).alias("changed"))
    rows = rows.withColumn("changed", F.coalesce("changed", "leaf"))
    return manifest(rows, "source", "doc_id", "leaf", "changed")


def _oracle(levels: int = 6) -> str:
    """The same rows by whole windows, for groups of up to 16^levels rows."""
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR) END"
    leaf_of = lambda text: "sha256(" + " || ".join([*map(field, FIELDS[:-1]), field(text)]) + ")"
    crc = (
        "xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: ord(substr(CAST(doc_id AS VARCHAR), i, 1))::BIGINT)), "
        "lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))))"
    )
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    out = [
        f"a AS (SELECT *, {leaf_of('text')} AS leaf, CASE WHEN doc_id IS NOT NULL AND {crc} % 5 = 0 THEN {leaf_of(low)} ELSE {leaf_of('text')} END AS changed FROM documents)",
        "b AS (SELECT doc_id, source, leaf, changed, row_number() OVER () AS rid, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, leaf AS d FROM a)",
        "t0 AS (SELECT rid, doc_id, source, leaf, changed, p, d, '' AS path, changed AS fold FROM b)",
    ]

    def climb(key: str, levels: int, first: str) -> str:
        """Each row keeps its node's place and digest, its proof and its fold, level by level."""
        name = first
        for _ in range(levels):
            new = f"{name}_"
            same = f"n.{key} IS NOT DISTINCT FROM t.{key}"
            out.extend([
                f"{name}n AS (SELECT DISTINCT {key}, p, d FROM {name})",
                f"{name}s AS (SELECT {key}, p // 16 AS q, list(d ORDER BY p) AS run, count(*) OVER (PARTITION BY {key}) AS runs FROM {name}n GROUP BY {key}, p // 16)",
                f"{new} AS (SELECT t.* EXCLUDE (p, d, path, fold, q, one, up, before, after), CASE WHEN one THEN p ELSE q END AS p, CASE WHEN one THEN d ELSE up END AS d, "
                f"CASE WHEN one THEN path ELSE path || before || after END AS path, CASE WHEN one THEN fold ELSE sha256(before || fold || after) END AS fold FROM ("
                f"SELECT t.*, n.q, runs = 1 AND len(run) = 1 AS one, sha256(array_to_string(run, '')) AS up, "
                f"array_to_string(run[1:(t.p % 16)], '') AS before, array_to_string(run[(t.p % 16) + 2:], '') AS after "
                f"FROM {name} t JOIN {name}s n ON {same} AND n.q = t.p // 16) t)",
            ])
            name = new
        return name

    name = climb("source", levels, "t0")
    out += [
        "s AS (SELECT source, any_value(d) AS d FROM " + name + " GROUP BY source)",
        "g AS (SELECT source, d, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS p FROM s)",
        f"u0 AS (SELECT t.rid, t.doc_id, t.leaf, t.path, t.fold, t.d AS subroot, 0 AS whole, g.p, g.d FROM {name} t JOIN g ON t.source IS NOT DISTINCT FROM g.source)",
    ]
    name = climb("whole", 3, "u0")
    return "WITH " + ",\n".join(out) + (
        f"\nSELECT doc_id, leaf, subroot, d AS root, sha256(path) AS proof_sha256, fold AS folded_root, fold = d AS verified FROM {name}"
    )


ORACLE = _oracle()
