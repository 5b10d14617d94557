"""N-gram Jaccard join by rare-first prefix filtering.

A document's set is its distinct 5-word shingles, each named by a 64-bit hash (two of a
thousand agree by chance once in 10^13 sets). Equal sets are one node, named by a 128-bit digest.

1. *Frequencies.* Blocks of documents sort their shingles and send each distinct one, with its
   count, to the bucket of its first bits, packed; buckets add the counts up and send back those
   that occur twice or more. A shingle costs a bucket one entry a block, however common it is.
2. *Prefixes.* A set's shingles are ordered by frequency, then value. Of two sets that share 80 %,
   each holds a common shingle among its first n - ceil(0.8 n) + 1. A shingle that occurs once
   is in no other set, so a set with so many of those has no links; most sets end here.
3. *Homes.* Sets meet first where their rarest shared shingle is, with all shingles. Pairs pass
   the length, the positional and the suffix filter and are then counted exactly. A pair that is
   already connected is not compared.
4. *Meetings.* Where another prefix shingle holds sets of several components that have not met,
   the same filters tell which sets still have a possible partner. Each of these goes, with all
   its shingles, to its fullest such places, and so on until no set is left; sets that met are
   never compared again.

The suffix filter bounds the difference of two sets from below: shingles fall into 512 cells,
and each cell where one set holds an odd and the other an even number holds a difference.
Groups that would be too large for a task are cut into blocks, and pairs of blocks compared.
Only connecting links leave a task, never the pairs of a group. Components come from star contraction.

Null, empty and blank texts have empty sets, linked with nothing. Fewer words than 5 are one
shingle. Texts are read whole. Repeated rows are one node. Null ids are ignored when the
smallest id is sought; a component of null ids has a null id. Columns other than the id and
the text are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tallyrow.llm.common import cut, small_side
from tallyrow.llm.simhash import components
from tallyrow.operators.sizing import staged

SHINGLE = 5
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Shingles of a block, of a bucket (about), and those on each side of a compared group.
BLOCK, BUCKET, GROUP = 1 << 20, 1 << 21, 1 << 21
#: Sets on each side of a group in which only sketches are compared, and rows of such groups
#: that are handled together.
SKETCHED, BUNDLE = 2_048, 4_096
#: Places that a set goes to in a round; in the last round it goes to all.
PLACES, ROUNDS = 2, 6
#: Groups up to which all pairs are laid out at once.
SMALL = 64
#: Names (8 or 16 bytes) up to which a list of them is broadcast.
NAMES = 500_000
#: Words whose hashes a task keeps.
WORDS = 200_000
#: Cells of the suffix filter, in 64-bit words.
CELLS = 8
SHARED = (1 << 16) - 1

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Odd factors without a pattern, one for each place in a shingle.
_FACTORS = _mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


class Shingler:
    """Sorted distinct shingles of texts; keeps the hashes of words it met."""

    def __init__(self, width: int = SHINGLE):
        self.width, self.words = width, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        known = self.words
        if len(known) > WORDS:
            known.clear()
        try:
            values = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh64_intdigest(w)
            values = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(words))
        total = np.full(len(words) - width + 1, width, np.uint64)
        for i in range(width):
            total += values[i : len(values) - width + 1 + i] * _FACTORS[i]
        return np.unique(_mix(total))


def prefix_length(n, percent: int = PERCENT):
    """How many first shingles of a set of ``n`` must hold one of any linked set's first."""
    return n - (n * percent + 99) // 100 + 1


def _overlap(n, m, percent: int = PERCENT):
    """Smallest intersection of linked sets of ``n`` and ``m``."""
    return -(-percent * (n + m) // (100 + percent))


def _pack(values: np.ndarray, width: int) -> bytes:
    """``width`` low bytes of each value, plane by plane, compressed."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return pa.compress(np.ascontiguousarray(planes), codec="zstd", asbytes=True)


def _unpack(raw: bytes, n: int, width: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(raw, n * width, codec="zstd", asbytes=True), np.uint8).reshape(width, n)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").reshape(n)


def _sorted_pack(values: np.ndarray) -> bytes:
    """Ascending values, by their differences."""
    return _pack(np.diff(values, prepend=np.uint64(0)), 8)


def _sorted_unpack(raw: bytes, n: int) -> np.ndarray:
    return np.cumsum(_unpack(raw, n, 8), dtype=np.uint64)


_ROW = "bucket long, block long, kind int, size int, toks binary, locs binary, counts binary"
_ROW_ARROW = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("kind", pa.int32()), ("size", pa.int32()), ("toks", pa.binary()), ("locs", pa.binary()), ("counts", pa.binary())])
#: Kinds of rows: shingles for a bucket and back, shingles that several documents of the
#: block hold, the documents themselves.
_SENT, _HOME, _DOCS = 0, 1, 2
_KINDS = 3


def _send(batches: Iterator[pa.RecordBatch], bits: int, block: int) -> Iterator[pa.RecordBatch]:
    shingles, task, number = Shingler(), TaskContext.get().partitionId(), 0
    ids, sets, digests, first, held = [], [], [], {}, 0

    def rows() -> Iterator[pa.RecordBatch]:
        name = (task << 32) + number
        own = -1 - name * _KINDS  # rows for the block itself have a bucket of their own

        def row(bucket, kind, size, toks, locs, counts):
            return pa.RecordBatch.from_pylist([dict(bucket=bucket, block=name, kind=kind, size=size, toks=toks, locs=locs, counts=counts)], _ROW_ARROW)

        known = pa.array(ids, pa.int64())
        flat = np.array([-1 if i is None else i for i in ids], "<i8")
        gone = np.packbits(np.array([i is None for i in ids], bool)).tobytes()
        sizes = np.array([len(s) if isinstance(s, np.ndarray) else s for s in sets], "<i8")
        yield row(own - _DOCS, _DOCS, len(known), flat.tobytes() + sizes.tobytes(), gone, b"".join(digests))
        real = [(i, s) for i, s in enumerate(sets) if isinstance(s, np.ndarray) and len(s)]
        if not real:
            return
        toks = np.concatenate([s for _, s in real])
        locs = np.repeat(np.array([i for i, _ in real], np.uint64), [len(s) for _, s in real])
        order = np.argsort(toks, kind="stable")
        toks, locs = toks[order], locs[order]
        new = np.ones(len(toks), bool)
        new[1:] = toks[1:] != toks[:-1]
        start = np.flatnonzero(new)
        counts = np.diff(np.append(start, len(toks)))
        several = np.repeat(counts > 1, counts)
        if several.any():
            yield row(own - _HOME, _HOME, int(several.sum()), _sorted_pack(toks[several]), _pack(locs[several], 2), None)
        distinct, where = toks[start], np.where(counts > 1, SHARED, locs[start]).astype(np.uint64)
        bounds = np.searchsorted(distinct, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
        for bucket, (a, b) in enumerate(zip(bounds, [*bounds[1:], len(distinct)])):
            if a < b:
                yield row(bucket, _SENT, int(b - a), _sorted_pack(distinct[a:b]), _pack(where[a:b], 2), _pack(counts[a:b].astype(np.uint64), 2))

    for batch in batches:
        for own, text in zip(batch["id"].to_pylist(), batch["text"]):
            found = shingles(text.as_py())
            digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
            # of equal sets in a block, the first stands for all
            keep = first.setdefault(digest, len(ids)) == len(ids)
            ids.append(own)
            sets.append(found if keep else len(found))
            digests.append(digest)
            held += len(found) if keep else 0
            if held >= block or len(ids) >= SHARED:
                yield from rows()
                ids, sets, digests, first, held, number = [], [], [], {}, 0, number + 1
    if ids:
        yield from rows()


def _frequent(table: pa.Table) -> pa.Table:
    """One bucket: the shingles that occur more than once, back to their blocks."""
    if table["kind"][0].as_py() != _SENT:
        return table
    sizes = table["size"].to_pylist()
    toks = np.concatenate([_sorted_unpack(t.as_py(), n) for t, n in zip(table["toks"], sizes)])
    counts = np.concatenate([_unpack(t.as_py(), n, 2) for t, n in zip(table["counts"], sizes)])
    order = np.argsort(toks, kind="stable")
    new = np.ones(len(toks), bool)
    new[1:] = toks[order][1:] != toks[order][:-1]
    run = np.cumsum(new) - 1
    total = np.bincount(run, counts[order]).astype(np.uint64)
    times = np.empty(len(toks), np.uint64)
    times[order] = total[run]
    out, at = [], 0
    for n, block, locs in zip(sizes, table["block"].to_pylist(), table["locs"]):
        often = times[at : at + n] > 1
        if often.any():
            own = np.minimum(times[at : at + n][often], np.uint64(0xFFFFFFFF))
            out.append(dict(
                bucket=0, block=block, kind=_SENT, size=int(often.sum()), toks=_sorted_pack(toks[at : at + n][often]),
                locs=_pack(_unpack(locs.as_py(), n, 2)[often], 2), counts=_pack(own, 4),
            ))
        at += n
    return pa.Table.from_pylist(out, _ROW_ARROW)


_MEMBER = "id long, node binary, n int, m int, toks binary, prefix binary"
_MEMBER_ARROW = pa.schema([("id", pa.int64()), ("node", pa.binary()), ("n", pa.int32()), ("m", pa.int32()), ("toks", pa.binary()), ("prefix", pa.binary())])


def _assemble(table: pa.Table) -> pa.Table:
    """One block: its documents, those that may have links with their shared shingles (sorted)
    and the shared ones of their prefixes (in rare-first order)."""
    toks, locs, times, home = [], [], [], None
    for row in table.to_pylist():
        n = row["size"]
        if row["kind"] == _DOCS:
            docs = n
            numbers = np.frombuffer(row["toks"], "<i8")
            ids, sizes = numbers[:docs], numbers[docs:]
            gone = np.unpackbits(np.frombuffer(row["locs"], np.uint8), count=docs).astype(bool)
            digests = [row["counts"][16 * i : 16 * i + 16] for i in range(docs)]
        elif row["kind"] == _HOME:
            home = _sorted_unpack(row["toks"], n), _unpack(row["locs"], n, 2)
        else:
            toks.append(_sorted_unpack(row["toks"], n))
            locs.append(_unpack(row["locs"], n, 2))
            times.append(_unpack(row["counts"], n, 4))
    empty = np.zeros(0, np.uint64)
    toks, locs, times = (np.concatenate(x) if x else empty for x in (toks, locs, times))
    if home is not None:
        several = locs == SHARED
        names, often = toks[several], times[several]
        order = np.argsort(names)
        toks, locs = np.concatenate([toks[~several], home[0]]), np.concatenate([locs[~several], home[1]])
        times = np.concatenate([times[~several], often[order][np.searchsorted(names[order], home[0])]])
    order = np.lexsort((toks, times, locs))
    toks, locs = toks[order], locs[order].astype(np.int64)
    shared = np.bincount(locs, minlength=docs)
    stops = np.cumsum(shared)
    lengths = prefix_length(sizes)
    held = [None] * docs
    prefixes = [None] * docs
    # once-only shingles come first in a set's order
    for i in np.flatnonzero((shared > 0) & (sizes - shared < lengths)):
        own = toks[stops[i] - shared[i] : stops[i]]
        held[i] = np.sort(own).tobytes()
        prefixes[i] = own[: lengths[i] - (sizes[i] - shared[i])].tobytes()
    return pa.Table.from_arrays(
        [pa.array(ids, pa.int64(), mask=gone), pa.array(digests, pa.binary()), pa.array(sizes, pa.int32()), pa.array(shared, pa.int32()), pa.array(held, pa.binary()), pa.array(prefixes, pa.binary())],
        schema=_MEMBER_ARROW,
    )


def members(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK, bucket: int = BUCKET) -> DataFrame:
    """(id, node, n, m, toks, prefix) of every document; ``toks`` and ``prefix`` are null where
    no link is possible, and in later copies of a set in a block."""
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    about = (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / 6
    bits = min(20, max(3, math.ceil(math.log2(max(about / bucket, 1)))))
    sent = rows.mapInArrow(lambda batches: _send(batches, bits, block), _ROW)
    back = sent.groupBy("bucket").applyInArrow(_frequent, _ROW)
    return staged(back.groupBy("block").applyInArrow(_assemble, _MEMBER), "members")


def _sketch(toks: np.ndarray) -> np.ndarray:
    """A bit a cell: is the number of shingles in it odd."""
    cells = np.bincount((toks & np.uint64(64 * CELLS - 1)).astype(np.int64), minlength=64 * CELLS)
    return np.packbits((cells & 1).astype(np.uint8)).view(np.uint64)


class Forest:
    """Labels of connected sets."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, i: int, others: np.ndarray) -> np.ndarray:
        """Connects i with the others; those that were not yet."""
        old = np.unique(self.label[others])
        old = old[old != self.label[i]]
        if len(old):
            self.label[np.isin(self.label, old)] = self.label[i]
        return old


def _apart(i, j, n: np.ndarray, m: np.ndarray, left: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """Which of the pairs (i, j) the length, the positional and the suffix filter let pass;
    ``left`` is how many shingles of a set come no earlier than the common one."""
    a, b = n[i], n[j]
    need = _overlap(a, b)
    close = (100 * np.minimum(a, b) >= PERCENT * np.maximum(a, b)) & (np.minimum(left[i], left[j]) >= need)
    at = np.flatnonzero(close)
    if len(at):
        i, j = (x[at] if np.ndim(x) else x for x in (i, j))
        once = n - m
        least = np.bitwise_count(sketch[j] ^ sketch[i]).sum(axis=1, dtype=np.int64) + once[i] + once[j]
        close[at] = least <= n[i] + n[j] - 2 * _overlap(n[i], n[j])
    return close


def _ordered(table: pa.Table):
    """Distinct nodes of the rows, and where each is first."""
    nodes = np.array([x.as_py() for x in table["node"]], object)
    at = np.unique(np.array([x.hex() for x in nodes]), return_index=True)[1]
    return nodes[at], at


def _two(table: pa.Table) -> bool:
    """Whether a group holds two blocks, to be compared with each other only."""
    return table["i"][0].as_py() != table["j"][0].as_py()


def _compare_home(table: pa.Table) -> pa.Table:
    """One place, or two blocks of one: connecting links among its sets, counted exactly. Sets
    that were connected before (``root``) are not compared."""
    nodes, at = _ordered(table)
    toks = [np.frombuffer(table["toks"][int(i)].as_py(), "<u8") for i in at]
    n, side = (table[c].to_numpy()[at].astype(np.int64) for c in ("n", "side"))
    m = np.array([len(t) for t in toks], np.int64)
    sketch = np.array([_sketch(t) for t in toks])
    two, forest, u, v = _two(table), Forest(len(nodes)), [], []
    if "root" in table.column_names:
        forest.label = _numbers(table["root"])[at]
    for i in range(len(nodes) - 1):
        rest = np.arange(i + 1, len(nodes))
        rest = rest[forest.label[rest] != forest.label[i]]
        if two:
            rest = rest[side[rest] != side[i]]
        # no common shingle is known to be the first, so all may be common
        for j in rest[_apart(i, rest, n, m, m, sketch)].tolist():
            if forest.label[i] != forest.label[j]:
                common = len(np.intersect1d(toks[i], toks[j], assume_unique=True))
                if 100 * common >= PERCENT * (n[i] + n[j] - common):
                    forest.join(i, np.array([j]))
                    u.append(nodes[i])
                    v.append(nodes[j])
    return pa.table([pa.array(u, pa.binary()), pa.array(v, pa.binary())], ["u", "v"])


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    """A number for each distinct value."""
    return column.combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)


def _dealt(rows: DataFrame, key: str, weight: str, most: int) -> DataFrame:
    """``rows`` with (i, j, side): the pair of blocks that a row goes to, one in most groups; a
    row of a too large group goes to as many as the group has blocks."""
    sizes = rows.groupBy(key).agg(F.ceil(F.sum(weight) / F.lit(most)).cast("int").alias("parts")).filter("parts > 1")
    split = rows.join(small_side(cut(sizes), 100_000), key, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(F.least(o, F.col("side")).alias("i"), F.greatest(o, F.col("side")).alias("j")))
    return split.withColumn("side", own).withColumn("pair", F.explode(pairs)).select(*rows.columns, "pair.i", "pair.j", "side")


def home_links(found: DataFrame, group: int = GROUP) -> DataFrame:
    """Connecting links (u, v) among sets with the same rarest shared shingle."""
    first = F.substring("prefix", 1, 8).alias("home")
    rows = found.filter("toks IS NOT NULL").select(first, "node", "n", "m", "toks")
    return _dealt(rows, "home", "m", group).groupBy("home", "i", "j").applyInArrow(_compare_home, "u binary, v binary")


def _prefix_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prefixes = [np.frombuffer(x.as_py(), "<i8") for x in batch["prefix"]]
        sizes = np.array([len(x) for x in prefixes], np.int64)
        if not sizes.sum():
            continue
        at = pa.array(np.repeat(np.arange(len(sizes)), sizes))
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        m = batch["m"].take(at)
        left = m.to_numpy() - place
        home = np.repeat([x[0] if len(x) else 0 for x in prefixes], sizes)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(prefixes)), batch["node"].take(at), batch["n"].take(at), m, pa.array(left, pa.int32()), pa.array(home, pa.int64())], ["tok", "node", "n", "m", "left", "home"]
        )


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = [_sketch(np.frombuffer(x.as_py(), "<u8")).tobytes() for x in batch["toks"]]
        yield pa.RecordBatch.from_arrays([batch["node"], pa.array(own, pa.binary())], ["of", "sketch"])


_PREFIX = "tok long, node binary, n int, m int, left int, home long"


def _met(i, j, met: np.ndarray) -> np.ndarray:
    """Which of the pairs (i, j) share a place they went to in the same round."""
    a, b = met[i], met[j]
    if a.ndim == 1:
        a = np.broadcast_to(a, b.shape)
    found = (a[:, 0] == b[:, 0]) & (a[:, 0] != 0)
    for start in range(1, met.shape[1], PLACES):
        x, y = a[:, start : start + PLACES], b[:, start : start + PLACES]
        found |= ((x[:, :, None] == y[:, None, :]) & (x[:, :, None] != 0)).any(axis=(1, 2))
    return found


def _still_open(table: pa.Table) -> pa.Table:
    """Of the rows of several groups those of sets with a possible partner in their group that
    is in another component and that they have not met."""
    group = _numbers(pa.chunked_array([pa.array([f"{t} {i} {j}" for t, i, j in zip(*(table[c].to_pylist() for c in ("tok", "i", "j")))])]))
    roots, nodes = _numbers(table["root"]), _numbers(table["node"])
    size = np.bincount(group)[group]
    # the rows of a group's largest component last
    per = np.unique(np.stack([group, roots], 1), axis=0, return_inverse=True, return_counts=True)
    order = np.lexsort((nodes, per[1].reshape(-1), per[2][per[1].reshape(-1)], group))
    table = table.take(pa.array(order))
    group, roots, nodes, size = group[order], roots[order], nodes[order], size[order]
    n, m, left, side = (table[c].to_numpy().astype(np.int64) for c in ("n", "m", "left", "side"))
    two = table["i"].to_numpy() != table["j"].to_numpy()
    sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint64).reshape(-1, CELLS)
    met = np.array(table["met"].to_pylist(), np.int64)
    found = np.zeros(len(group), bool)

    def check(i, j: np.ndarray) -> None:
        ok = (roots[i] != roots[j]) & ~(two[j] & (side[i] == side[j]))
        i, j = (x[ok] if np.ndim(x) else x for x in (i, j))
        if not len(j):
            return
        ok = ~_met(i, j, met)
        i, j = (x[ok] if np.ndim(x) else x for x in (i, j))
        ok = _apart(i, j, n, m, left, sketch)
        found[j[ok]] = True
        if np.ndim(i):
            found[i[ok]] = True
        elif ok.any():
            found[i] = True

    small = np.flatnonzero(size <= SMALL)
    for d in range(1, min(SMALL, len(small))):
        i, j = small[:-d], small[d:]
        same = group[i] == group[j]
        if not same.any():
            break
        check(i[same], j[same])
    for g in np.unique(group[size > SMALL]):
        rows = np.flatnonzero(group == g)
        last = roots[rows[-1]]
        for k in range(len(rows)):
            if roots[rows[k]] == last:
                break  # among themselves they are connected
            check(int(rows[k]), rows[k + 1 :])
    return table.filter(pa.array(found))


_OPEN = _PREFIX + ", sketch binary, root binary, met array<bigint>"


def open_rows(rows: DataFrame, most: int) -> DataFrame:
    """The rows of sets that may have a link where they are, to a set they have not met."""
    mixed = cut(rows.groupBy("tok").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high").select("tok"))
    dealt = _dealt(rows.join(small_side(mixed, NAMES), "tok", "left_semi").withColumn("one", F.lit(1)), "tok", "one", most).drop("one")
    bundles = max(1, rows.count() // BUNDLE)
    bundled = dealt.withColumn("bundle", F.pmod(F.xxhash64("tok", "i", "j"), F.lit(bundles)))
    columns = [f.split(" ")[0] for f in _OPEN.split(", ")]
    kept = bundled.groupBy("bundle").applyInArrow(lambda t: _still_open(t).select(columns), _OPEN)
    return staged(kept.dropDuplicates(["tok", "node"]), "open")


def meeting_links(found: DataFrame, near: DataFrame, most: int = SKETCHED, group: int = GROUP, last: int = ROUNDS) -> DataFrame:
    """``near`` and the further links (u, v) that connect all linked sets."""
    sets = found.filter("toks IS NOT NULL")
    spread = sets.select("node", "n", "m", "prefix").mapInArrow(_prefix_rows, _PREFIX)
    links, roots = near, components(near)
    labelled = staged(_labelled(spread, roots), "prefixes")
    mixed = cut(labelled.groupBy("tok").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high").select("tok"))
    several = staged(labelled.join(small_side(mixed, NAMES), "tok"), "mixed")
    sketches = _of(sets, several.select("node")).select("node", "toks").mapInArrow(_sketches, "of binary, sketch binary")
    rows = staged(several.join(sketches, F.col("node") == F.col("of")).drop("of").withColumn("met", F.array("home")), "sketched")
    for number in range(1, last + 1):
        rows = open_rows(rows, most)
        if not rows.limit(1).count():
            break
        sizes = rows.groupBy("tok").agg(F.count(F.lit(1)).alias("size"))
        place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("size"), "tok"))
        ranked = rows.select("tok", "node", "root").join(sizes, "tok").withColumn("place", place)
        chosen = staged(ranked if number == last else ranked.filter(F.col("place") <= PLACES), "chosen")
        full = chosen.select("tok", "node", "root").join(_of(sets, chosen.select("node")), "node").withColumn("m", F.length("toks") / 8)
        new = cut(_dealt(full, "tok", "m", group).groupBy("tok", "i", "j").applyInArrow(_compare_home, "u binary, v binary"))
        links = links.unionByName(new)
        if number == last:
            break
        roots = components(links)
        went = chosen.groupBy("node").agg(*[F.coalesce(F.max(F.when(F.col("place") == k, F.col("tok"))), F.lit(0)).alias(f"p{k}") for k in range(1, PLACES + 1)])
        went = went.select(F.col("node").alias("of"), F.array(*[f"p{k}" for k in range(1, PLACES + 1)]).alias("new"))
        again = rows.drop("root").join(went, F.col("node") == F.col("of")).withColumn("met", F.concat("met", "new")).drop("of", "new")
        rows = staged(_labelled(again, roots), "rows")
    return links


def _labelled(rows: DataFrame, roots: DataFrame) -> DataFrame:
    label = roots.select(F.col("node").alias("of"), "root")
    return rows.join(label, F.col("node") == F.col("of"), "left").withColumn("root", F.coalesce("root", "node")).drop("of")


def _of(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row (node, n, toks) for each of the nodes."""
    wanted = small_side(cut(nodes.distinct()), NAMES)
    return rows.join(wanted, "node", "left_semi").groupBy("node").agg(F.first("n").alias("n"), F.first("toks").alias("toks"))


def linked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", group: int = GROUP, sketched: int = SKETCHED, rounds: int = ROUNDS, **sizes: int) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable)."""
    found = members(docs, doc_id, text, **sizes)
    near = cut(home_links(found, group))
    roots = components(meeting_links(found, near, sketched, group, rounds))
    nodes = found.filter("n > 0").groupBy("node").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("rows"))
    named = cut(nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    component = named.join(named.groupBy("root").agg(F.min("low").alias("component_id")), "root").select("node", "component_id", "rows")
    rows = found.select("id", "node", "n")
    # sets that more than a thousandth of the rows hold, at most a thousand, meet their rows in the tasks
    hot = F.broadcast(component.filter(F.col("rows") > F.lit(rows.count() / 1000)).select("node", F.col("component_id").alias("common")))
    split = rows.join(hot, "node", "left")
    known = F.col("common").isNotNull() | (F.col("n") == 0)
    own = split.filter(known).select("id", "n", F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("common")).alias("component_id"))
    rest = split.filter(~known).select("id", "n", "node").join(component.select("node", "component_id"), "node").select("id", "n", "component_id")
    return own.unionByName(rest).select(F.col("id").alias(doc_id), F.col("n").cast("long").alias("n_shingles"), "component_id")
