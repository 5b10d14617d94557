"""Language-model scoring with a weighted backoff automaton of up to three words.

The model is an n-gram model with absolute discounting. Words are counted exactly, whatever
their number; an n-gram of 2 or 3 words enters when it occurs at least ``min_count`` times in
the training tokens, so the model grows with the text. A caller who sets ``gram_share`` lets
n-grams enter from that share of all tokens instead.

Contexts that have arcs are states. An arc leads from a context by a word to the longest state
that ends the words read, and costs the word's log probability; a state's failure arc leads to
the context without its first word and costs the backoff weight, the mass its own arcs leave over
that of the same words below. A text is read once from left to right: at each word failure arcs
are taken until an arc is found, and what is taken is added up. Long texts are read in pieces,
each begun two words early, which is all a state remembers.

Nobody holds the model. Texts lie in blocks of about ``block`` tokens, written once in buckets by
block. Round by round (words, pairs, triples) a block sends its distinct n-grams, packed and with
their counts, to where their context is settled, and gets back which of them enter, and for each
of its contexts the three sums that its backoff weight is made of, less what its own n-grams add
to them. Pairs are asked only of words that occur often enough, triples only of pairs that
entered. Then the block has the part of the automaton that its texts can reach, and reads them. A
frequent context is settled in several places, by its next word, and its sums are added up in the
block. Counts and sums of the ``OFTEN`` most frequent words go to every task instead. Hashes and
exchanged rows are removed as soon as the next table is written.

Words are named by 64-bit hashes of their own: two of a billion words agree with a chance of 3 %.

A null text is empty and consists of the end token only. A null id counts as an empty id text.
Repeated rows are texts of their own. A text of any length is read whole; one longer than a block
is a block. A word unseen in training gets the probability of the unknown class, the mass that
discounting took from the known words. Without training tokens every token is unknown, with
probability one. An empty table gives no rows. Columns other than id and text are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import count as counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tallyrow.llm.ngramjoin import _mix, _pack, _unpack
from tallyrow.session import scratch_path

#: No word holds a line end, so it names the end of a text.
END = "\n"
#: An n-gram of 2 or 3 words enters the model when it occurs so often.
MIN_COUNT = 2
DISCOUNT = 0.5
#: Tokens of a block, and of a text's piece that is read at once.
BLOCK, PIECE = 800_000, 256
#: A context is settled in one place for each so many of its occurrences.
SPLIT = 4_000_000
#: Blocks' worth of tokens that one place settles.
SETTLED = 4
#: Blocks of a bucket of their table, at most so many buckets.
TOGETHER, BUCKETS = 2, 100_000
_ID = 32
#: With this setting the files of a query's exchanges are removed when the query ends, not when
#: the driver happens to collect its garbage.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: At most so many frequent words have their counts and sums sent to every task, not with each n-gram.
OFTEN = 1 << 16


def held_out(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words and the end."""
    return [*(text or "").encode().lower().split(), END.encode()]


# --- blocks ------------------------------------------------------------------

_BLOCK = "block long, ids array<long>, train array<boolean>, sizes array<int>, n_tokens int, tokens binary, n_words int, words binary, counts binary, kind string"
_TEXTS, _HASHES = "texts", "hashes"


def _by_count(counts: np.ndarray) -> np.ndarray:
    return np.argsort(-counts.astype(np.int64), kind="stable")


def _blocks(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    task, number = TaskContext.get().partitionId(), 0

    def row() -> pa.RecordBatch:
        # a word's number in the block is the place of its hash
        words, place = np.unique(np.fromiter(map(xxhash.xxh64_intdigest, local), np.uint64, len(local)), return_inverse=True)
        flat = place[np.concatenate(lines)]
        own = np.repeat(np.array(train, bool), [len(x) for x in lines])
        counts = np.bincount(flat[own], minlength=len(words)).astype(np.uint64)
        # frequent words get low numbers, which pack well; the counts tell the order
        rank = np.empty(len(words), np.int64)
        rank[_by_count(counts)] = np.arange(len(words))
        # hashes are asked for once and lie in a row of their own
        columns = [
            pa.array(2 * [(task << 32) + number]), pa.array([ids, None], pa.list_(pa.int64())), pa.array([train, None], pa.list_(pa.bool_())),
            pa.array([[len(x) for x in lines], None], pa.list_(pa.int32())), pa.array([len(flat), None], pa.int32()),
            pa.array([_pack(rank[flat].astype(np.uint64), 4), None], pa.binary()), pa.array(2 * [len(words)], pa.int32()), pa.array([None, _delta(words)], pa.binary()),
            pa.array(2 * [_pack(counts, 4)], pa.binary()), pa.array([_TEXTS, _HASHES]),
        ]
        return pa.RecordBatch.from_arrays(columns, [c.split(" ")[0] for c in _BLOCK.split(", ")])

    fresh = lambda: ([], [], [], defaultdict(counter().__next__))
    ids, train, lines, local = fresh()
    held = 0
    for batch in batches:
        for own, learn, text in zip(batch["id"].to_pylist(), batch["train"].to_pylist(), batch["text"]):
            line = tokens(text.as_py())
            ids.append(own)
            train.append(bool(learn))
            lines.append(np.fromiter(map(local.__getitem__, line), np.int32, len(line)))
            held += len(line)
            if held >= block:
                yield row()
                (ids, train, lines, local), held, number = fresh(), 0, number + 1
    if ids:
        yield row()


def _in_buckets(df: DataFrame, path: str, parts: int, *by: str) -> DataFrame:
    """A written table with the rows of a block in a known place: groups by block of later
    rounds read it without an exchange. Exchanges that led to it end with the write."""
    spark = df.sparkSession
    table = path.rsplit("/", 1)[1].replace("-", "_")
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        df.write.partitionBy(*by).bucketBy(parts, "block").option("path", path).format("parquet").saveAsTable(table)
    finally:
        spark.conf.set(RELEASE, before) if before is not None else spark.conf.unset(RELEASE)
    return spark.table(table)


# --- rounds ------------------------------------------------------------------

_ASK = "bucket int, block long, level int, n int, contexts binary, words binary, counts binary, lower binary, k int, asked binary"
_REPLY = "block long, level int, bucket int, n int, entered binary, counts binary, names binary, k int, linked binary, sums binary"
#: Levels of the rows that tell of the sums of a bucket's frequent words, of the counts by number in one
#: bucket, of a bucket's frequent words, of all its words, and of a block's words.
_SUMS, _TYPICAL, _OFTEN, _FACTS, _WORDS = -3, -2, -1, 0, 1


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(n, kinds[t]) for n, t in (c.split() for c in ddl.split(", "))])


def _delta(values: np.ndarray) -> bytes:
    return _pack(np.diff(values.astype(np.uint64), prepend=np.uint64(0)), 8)


def _undelta(raw: bytes, n: int) -> np.ndarray:
    return np.cumsum(_unpack(raw, n, 8), dtype=np.uint64).astype(np.int64)


def _by_number(ids: np.ndarray) -> np.ndarray:
    """Order in which the counts of one bucket's words descend: by number, those without an id last."""
    return np.argsort(np.where(ids > 0, ids, 1 << 62), kind="stable")


def _steps(values: np.ndarray, group: np.ndarray) -> bytes:
    """Values that ascend inside each run of ``group``, by their differences there."""
    same = np.zeros(len(values), bool)
    same[1:] = group[1:] == group[:-1]
    return _pack(np.where(same, values - np.roll(values, 1), values).astype(np.uint64), 4)


def _from_steps(raw: bytes, group: np.ndarray) -> np.ndarray:
    steps = _unpack(raw, len(group), 4).astype(np.int64)
    total, new = np.cumsum(steps), np.ones(len(group), bool)
    new[1:] = group[1:] != group[:-1]
    return total - (total - steps)[new][np.cumsum(new) - 1] if len(group) else steps


def _place(contexts: np.ndarray, part: np.ndarray, buckets: int, level: int) -> np.ndarray:
    """A pair is settled as a context where it was named, so that its name is a short step
    from the one before; further parts, and words, by hash."""
    mixed = _mix(contexts.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + part.astype(np.uint64))
    dealt = (mixed % np.uint64(buckets)).astype(np.int64)
    return np.where(part == 0, contexts >> _ID, dealt) if level > 2 else dealt


@dataclass
class Setting:
    """What the driver knows of the model."""

    #: training tokens, and distinct ones
    tokens: int
    types: int
    #: discount of words
    discount: float
    #: occurrences from which n-grams enter
    enough: int
    buckets: int
    split: int
    #: ids of the most frequent words, ascending, and their counts
    frequent: np.ndarray
    times: np.ndarray
    #: counts by number in one bucket, whose words are as frequent as those of any other: each
    #: count (descending), and the first number that has it
    typical: np.ndarray
    since: np.ndarray
    #: of each frequent word, as a context, the three sums; known after the pairs are settled
    sums: np.ndarray | None = None

    def known(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words are frequent, and their counts; of others, about their counts."""
        about = np.zeros(len(words), np.int64)
        if len(self.typical):
            about = self.typical[np.maximum(np.searchsorted(self.since, words // self.buckets, "right") - 1, 0)]
        if not len(self.frequent):
            return np.zeros(len(words), bool), about
        times = np.zeros(self.frequent[-1] + 2, np.int64)  # by id, the last one of no frequent word
        times[self.frequent] = self.times
        times = times[np.minimum(words, len(times) - 1)]
        return times > 0, np.where(times > 0, times, about)

    def unknown(self) -> float:
        return self.discount * self.types / self.tokens if self.tokens else 1.0


def _signed(values: np.ndarray) -> np.ndarray:
    """Numbers near zero as small ones that are not negative."""
    return np.where(values < 0, -2 * values - 1, 2 * values)


def _unsigned(values: np.ndarray) -> np.ndarray:
    return np.where(values & 1, -(values + 1 >> 1), values >> 1)


def _pack_sums(sums: np.ndarray, enough: int) -> bytes:
    """Arcs, their occurrences and those of their words, each by what it is above its least."""
    arcs, total, lower = sums
    return _pack(np.concatenate([arcs - 1, total - enough * arcs, lower - total]).astype(np.uint64), 6)


def _unpack_sums(raw: bytes, n: int, enough: int) -> np.ndarray:
    arcs, total, lower = _unpack(raw, 3 * n, 6).astype(np.int64).reshape(3, n)
    arcs = arcs + 1
    total = total + enough * arcs
    return np.stack([arcs, total, lower + total])


class Grams:
    """The n-grams of a block that one round asks for: distinct (context, word), with the
    tokens that stand there, and the distinct contexts that something follows."""

    def __init__(self, level: int, setting: Setting, names: np.ndarray, occurs: np.ndarray, at: np.ndarray, contexts: np.ndarray, follow: np.ndarray, lower: np.ndarray, train: np.ndarray):
        """``names`` of contexts, ascending, and how often each occurs; of the tokens ``at`` that open
        one: its place in ``names``, the following word (-1: none that can enter), how often the
        n-gram without its first word occurs, and whether the text is learned from."""
        used = np.zeros(len(names), bool)
        used[contexts] = True
        #: of each context its place in ``names``
        self.used, self.setting, self.level = np.flatnonzero(used), setting, level
        self.contexts = names[used]
        parts = 1 + occurs[used] // setting.split
        asked = follow >= 0
        self.at = at[asked]
        keys, which = np.unique((np.cumsum(used) - 1)[contexts[asked]] << _ID | follow[asked], return_inverse=True)
        #: places of tokens and of n-grams in a block need 32 bits
        self.which = which.astype(np.int32)
        del which
        self.context, self.word = keys >> _ID, keys & ((1 << _ID) - 1)
        self.lower = np.zeros(len(keys), np.int64)
        self.lower[self.which] = lower[asked]
        self.counts = np.bincount(self.which, train[asked], minlength=len(keys)).astype(np.int64)
        place = _place(self.contexts[self.context], self.word % parts[self.context], setting.buckets, level)
        #: n-grams by bucket; contexts by each bucket that settles some of them
        self.order = np.argsort(place, kind="stable")
        self.bounds = np.searchsorted(place[self.order], np.arange(setting.buckets + 1))
        every = np.repeat(np.arange(len(parts)), parts)
        part = np.arange(len(every)) - np.repeat(np.cumsum(parts) - parts, parts)
        width = len(parts) + 1
        both = np.sort(_place(self.contexts[every], part, setting.buckets, level) * width + every)
        both = both[np.diff(both, prepend=-1) > 0]
        # a bucket need not be told of a context that it gets n-grams of
        told = (place * width + self.context)[self.order]
        told = told[np.diff(told, prepend=-1) > 0]
        extra = both[np.append(told, -1)[np.searchsorted(told, both)] != both]
        buckets = np.arange(setting.buckets + 1) * width
        self.told, self.told_bounds = told % width, np.searchsorted(told, buckets)
        self.extra, self.extra_bounds = extra % width, np.searchsorted(extra, buckets)

    def _asked(self, bucket: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of one bucket: the n-grams, the contexts that come with them, and other contexts."""
        cut = lambda values, bounds: values[bounds[bucket] : bounds[bucket + 1]]
        return cut(self.order, self.bounds), cut(self.told, self.told_bounds), cut(self.extra, self.extra_bounds)

    def ask(self, block: int, level: int) -> list[dict]:
        out, lower = [], self.lower
        if level == 2:  # the count of a frequent word is known, that of another is near the typical one
            often, about = self.setting.known(self.word)
            lower = np.where(often, 0, _signed(lower - about))
        for bucket in range(len(self.bounds) - 1):
            mine, _, extra = self._asked(bucket)
            if len(mine) or len(extra):
                contexts = self.contexts[self.context[mine]]
                out.append(dict(
                    bucket=bucket, block=block, level=level, n=len(mine), contexts=_delta(contexts), words=_steps(self.word[mine], contexts),
                    counts=_pack(self.counts[mine].astype(np.uint64), 4), lower=_pack(lower[mine].astype(np.uint64), 6), k=len(extra), asked=_delta(self.contexts[extra]),
                ))
        return out

    def hear(self, replies: list[dict]) -> None:
        """``total`` of each n-gram (0: it does not enter), ``name`` of each that enters, and of each
        context its arcs, their occurrences, and those of their words in the shorter context."""
        self.total, self.name = np.zeros(len(self.word), np.int64), np.full(len(self.word), -1)
        beyond = np.zeros((len(self.contexts), 3), np.int64)
        for r in replies:
            mine, told, extra = self._asked(r["bucket"])
            entered = np.unpackbits(np.frombuffer(r["entered"], np.uint8), count=r["n"]).astype(bool)
            self.total[mine[entered]] = _unpack(r["counts"], int(entered.sum()), 6).astype(np.int64)
            if r["names"]:
                self.name[mine[entered]] = r["bucket"] << _ID | _undelta(r["names"], int(entered.sum()))
            linked = np.unpackbits(np.frombuffer(r["linked"], np.uint8), count=r["k"]).astype(bool)
            beyond[np.concatenate([told, extra])[linked]] += _unpack_sums(r["sums"], int(linked.sum()), self.setting.enough).T
        add = lambda x: np.bincount(self.context, x, len(self.contexts)).astype(np.int64)
        self.sums = beyond + np.stack([add(self.total > 0), add(self.total), add(np.where(self.total > 0, self.lower, 0))], axis=1)
        if self.level == 2 and len(self.setting.frequent):
            at = np.minimum(np.searchsorted(self.setting.frequent, self.contexts), len(self.setting.frequent) - 1)
            often = self.setting.frequent[at] == self.contexts
            self.sums[often] = self.setting.sums[at[often]]


def _settle(table: pa.Table, setting: Setting, pairs: bool) -> pa.Table:
    """One bucket: which n-grams enter, pairs with their numbers here, and for each context asked
    for the sums of those arcs that its block did not ask for; of the others the block has them.
    Sums of frequent words are told once and not to each block."""
    enough = setting.enough
    rows = table.to_pylist()
    sizes = [r["n"] for r in rows]
    sent = [_undelta(r["contexts"], r["n"]) for r in rows]
    contexts, words = np.concatenate(sent), np.concatenate([_from_steps(r["words"], c) for r, c in zip(rows, sent)])
    counts, lower = (np.concatenate([_unpack(r[c], r["n"], w).astype(np.int64) for r in rows]) for c, w in (("counts", 4), ("lower", 6)))
    if pairs:
        lower = setting.known(words)[1] + _unsigned(lower)
    # by one number a gram; names of pairs are too long for that, their ranks are not
    order = np.argsort((contexts if pairs else np.unique(contexts, return_inverse=True)[1]) << _ID | words)
    c, w = contexts[order], words[order]
    new = np.ones(len(c), bool)
    new[1:] = (c[1:] != c[:-1]) | (w[1:] != w[:-1])
    run = np.cumsum(new) - 1
    total = np.bincount(run, counts[order], minlength=int(new.sum())).astype(np.int64)
    enters = total >= enough
    own, starts = np.unique(c[new], return_index=True)
    add = lambda x: np.add.reduceat(np.where(enters, x, 0), starts) if len(starts) else np.zeros(0, np.int64)
    sums = np.stack([add(np.ones(len(total), np.int64)), add(total), add(lower[order][new])])
    times, numbers = np.empty(len(c), np.int64), np.empty(len(c), np.int64)
    times[order], numbers[order] = np.where(enters, total, 0)[run], (np.cumsum(enters) - 1)[run]
    out, at = [], 0
    if pairs:
        many = setting.known(own)[0] & (sums[0] > 0)
        out.append(dict(
            block=-1, level=_SUMS, bucket=rows[0]["bucket"], n=0, entered=b"", counts=b"", names=_delta(own[many]), k=int(many.sum()), linked=b"", sums=_pack_sums(sums[:, many], enough),
        ))
    for r, n, told in zip(rows, sizes, sent):
        mine, number, below, at = times[at : at + n], numbers[at : at + n], lower[at : at + n], at + n
        begin = np.flatnonzero(np.diff(told, prepend=-1))
        told = told[begin]
        asked = np.concatenate([told, _undelta(r["asked"], r["k"])])
        found = np.searchsorted(own, asked)
        there = np.minimum(found, max(len(own) - 1, 0))
        got = np.where(own[there] == asked, sums[:, there], 0) if len(own) else np.zeros((3, len(asked)), np.int64)
        if n:
            got[:, : len(told)] -= np.add.reduceat(np.stack([mine > 0, mine, np.where(mine > 0, below, 0)]), begin, axis=1)
        if pairs:
            got[:, setting.known(asked)[0]] = 0
        out.append(dict(
            block=r["block"], level=r["level"], bucket=r["bucket"], n=n, entered=np.packbits(mine > 0).tobytes(),
            counts=_pack(mine[mine > 0].astype(np.uint64), 6), names=_delta(number[mine > 0]) if pairs else b"",
            k=len(asked), linked=np.packbits(got[0] > 0).tobytes(), sums=_pack_sums(got[:, got[0] > 0], enough),
        ))
    return pa.Table.from_pylist(out, _arrow(_REPLY))


def _settled(asked: DataFrame, setting: Setting, pairs: bool) -> DataFrame:
    return asked.groupBy("bucket").applyInArrow(lambda t: _settle(t, setting, pairs), _REPLY)


class Reader:
    """A block between the rounds: its tokens, and what it has heard in the rounds before ``level``."""

    def __init__(self, row: dict, replies: list[dict], setting: Setting, level: int):
        self.row, self.setting = row, setting
        heard = defaultdict(list)
        for r in replies:
            heard[r["level"]].append(r)
        words = sorted(heard[_WORDS], key=lambda r: r["bucket"])  # buckets and numbers have one order
        known = [_unpack(w["sums"], w["n"], 4).astype(np.int64) for w in words]
        self.count = np.concatenate([np.empty(0, np.int64), *known])
        for w, ids, own in zip(words, known, np.split(self.count, np.cumsum([len(x) for x in known])[:-1])):
            own[_by_number(ids)] = np.cumsum(_unsigned(_unpack(w["counts"], w["n"], 6).astype(np.int64)))
        self.id = np.where(self.count >= setting.enough, np.concatenate(known) - 1, -1)  # -1: in no n-gram that enters
        order = _by_count(_unpack(row["counts"], row["n_words"], 4))
        self.local = order.astype(np.int32)[_unpack(row["tokens"], row["n_tokens"], 4)]
        self.sizes = np.array(row["sizes"], np.int64)
        last = np.zeros(len(self.local), bool)
        last[np.cumsum(self.sizes) - 1] = True
        self.train = np.repeat(np.array(row["train"], bool), self.sizes)
        self.next = np.where(last, -1, np.roll(self.local, -1))  # the following token
        self.levels = {}
        # contexts of one word by id, of two words by the name of their pair
        own = np.flatnonzero(self.id >= 0)
        own = own[np.argsort(self.id[own])]
        place = np.full(len(self.id), -1, np.int32)
        place[own] = np.arange(len(own))
        at = np.flatnonzero(~last & (self.id[self.local] >= 0)).astype(np.int32)
        self.add(2, self.id[own], self.count[own], at, place[self.local[at]], self.id[self.next[at]], self.count[self.next[at]], heard[2] if level > 2 else None)
        if level > 2:
            two = self.levels[2]
            pair = np.full(len(self.local), -1, np.int32)
            pair[two.at] = two.which
            # a pair that entered is a context unless it ends its text
            self.pairs = np.flatnonzero(two.total > 0)
            self.pairs = self.pairs[np.argsort(two.name[self.pairs])]
            place = np.full(len(two.word) + 1, -1, np.int32)  # the last one: no pair
            place[self.pairs] = np.arange(len(self.pairs))
            at = np.flatnonzero(~np.roll(last, -1) & (place[pair] >= 0)).astype(np.int32)
            shorter = np.append(two.total, 0)[pair[at + 1]]
            beyond = np.where(shorter > 0, self.id[self.next[at + 1]], -1)  # the token after the next
            self.add(3, two.name[self.pairs], two.total[self.pairs], at, place[pair[at]], beyond, shorter, heard[3] if level > 3 else None)

    def add(self, level: int, names: np.ndarray, occurs: np.ndarray, at: np.ndarray, contexts: np.ndarray, follow: np.ndarray, lower: np.ndarray, replies: list[dict] | None) -> None:
        grams = Grams(level, self.setting, names, occurs, at, contexts, follow, lower, self.train[at])
        if replies is not None:
            grams.hear(replies)
        self.levels[level] = grams

    # --- the automaton

    def automaton(self):
        """Words: what each costs from no context and the state it leads to. For states of one
        and two words: weight and target of the failure arc. For the arcs from states of one and
        of two words, in the order of the n-grams: cost (NaN: no arc) and target."""
        s, two, three = self.setting, self.levels[2], self.levels[3]
        with np.errstate(divide="ignore", invalid="ignore"):
            word_cost = np.where(self.count > 0, np.log10((self.count - s.discount) / max(s.tokens, 1)), math.log10(s.unknown()))
        by_id = np.full(int(self.id.max(initial=0)) + 2, -1)
        by_id[self.id[self.id >= 0]] = np.flatnonzero(self.id >= 0)
        held = lambda own, all_, t: (own - DISCOUNT * t) / np.maximum(all_, 1)
        # states of one word: 1 + place among the contexts; those of two words follow
        state1 = np.where(two.sums[:, 0] > 0, 1 + np.arange(len(two.contexts)), 0)
        state2 = np.where(three.sums[:, 0] > 0, 1 + len(two.contexts) + np.arange(len(three.contexts)), 0)
        local1 = by_id[two.contexts]
        arcs, c1, low1 = two.sums.T
        weight1 = np.log10(np.maximum(1e-300, 1 - held(c1, self.count[local1], arcs)) / np.maximum(1e-12, 1 - (low1 - s.discount * arcs) / max(s.tokens, 1)))
        of_word = np.zeros(len(self.count), np.int64)  # state of a word
        of_word[local1] = state1
        pair = self.pairs[three.used]  # of each state of two words
        tail = two.word[pair]
        key2 = two.contexts[two.context] << _ID | two.word  # sorted: contexts and words are
        arcs, c2, low2 = three.sums.T
        times = two.total[pair]
        weight2 = np.log10(np.maximum(1e-300, 1 - held(c2, times, arcs)) / np.maximum(1e-12, 1 - held(low2, self.count[by_id[tail]], arcs)))
        weights, fail = np.zeros(1 + len(state1) + len(state2)), np.zeros(1 + len(state1) + len(state2), np.int64)
        weights[1 : 1 + len(state1)], weights[1 + len(state1) :] = weight1, weight2
        fail[1 + len(state1) :] = of_word[by_id[tail]]

        of_pair = np.zeros(len(key2) + 1, np.int64)  # state of a pair
        of_pair[pair] = state2

        def place_of(pairs: np.ndarray) -> np.ndarray:
            place = np.searchsorted(key2, pairs)
            return np.where(np.append(key2, -1)[place] == pairs, place, len(key2))  # the last place is no state

        def arcs_of(grams: Grams, times: np.ndarray, place_of) -> tuple[np.ndarray, np.ndarray]:
            own = np.flatnonzero(grams.total > 0)
            longer = of_pair[place_of(own)]  # state of the pair that an arc's words end in
            cost, goes = np.full(len(grams.total) + 1, np.nan), np.zeros(len(grams.total) + 1, np.int64)
            cost[own] = np.log10((grams.total[own] - DISCOUNT) / times[grams.context[own]])
            goes[own] = np.where(longer > 0, longer, of_word[by_id[grams.word[own]]])
            return cost, goes

        out1 = arcs_of(two, self.count[local1], lambda own: own)
        out2 = arcs_of(three, times, lambda own: place_of(tail[three.context[own]] << _ID | three.word[own]))
        return word_cost, of_word, weights, fail, 1 + len(state1), out1, out2

    def read(self) -> np.ndarray:
        """Cost of every token, read from left to right, many pieces of texts side by side."""
        word_cost, of_word, weights, fail, two_from, (cost1, goes1), (cost2, goes2) = self.automaton()
        # the n-gram that each token ends, by its place among the arcs; the last place is no arc
        arc1, arc2 = (np.full(len(self.local) + 2, len(c) - 1, np.int32) for c in (cost1, cost2))
        arc1[self.levels[2].at + 1], arc2[self.levels[3].at + 2] = self.levels[2].which, self.levels[3].which
        starts = np.cumsum(self.sizes) - self.sizes
        pieces = -(-self.sizes // PIECE)
        begin = np.repeat(starts, pieces) + PIECE * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        stop = np.minimum(begin + PIECE, np.repeat(starts + self.sizes, pieces))
        at = np.maximum(begin - 2, np.repeat(starts, pieces))
        order = np.argsort(at - stop, kind="stable")  # longest first
        at, begin, stop = at[order], begin[order], stop[order]
        state, out = np.zeros(len(at), np.int64), np.zeros(len(self.local))
        while True:
            going = int(np.searchsorted(-(stop - at), 0))  # those with tokens left
            if not going:
                break
            at, begin, stop, state = at[:going], begin[:going], stop[:going], state[:going]
            word = self.local[at]
            spent, here, goal = np.zeros(going), state.copy(), np.zeros(going, np.int64)
            open_ = np.arange(going)
            while len(open_):
                own = open_[here[open_] > 0]
                long_ = here[own] >= two_from
                arc = np.where(long_, arc2[at[own]], arc1[at[own]])
                cost = np.where(long_, cost2[np.where(long_, arc, 0)], cost1[np.where(long_, 0, arc)])
                goes = np.where(long_, goes2[np.where(long_, arc, 0)], goes1[np.where(long_, 0, arc)])
                hit = ~np.isnan(cost)
                spent[own[hit]] += cost[hit]
                goal[own[hit]] = goes[hit]
                own = own[~hit]
                done = open_[here[open_] == 0]
                spent[done] += word_cost[word[done]]
                goal[done] = of_word[word[done]]
                spent[own] += weights[here[own]]  # the failure arc
                here[own] = fail[here[own]]
                open_ = own
            counted = at >= begin
            out[at[counted]] = spent[counted]
            state, at = goal, at + 1
        return out


def _ask_words(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """The words of each block, cut into ranges of their hashes."""
    limits = np.array([(i << 64) // buckets for i in range(buckets)], np.uint64)
    for batch in batches:
        for row in batch.to_pylist():
            words, counts = np.cumsum(_unpack(row["words"], row["n_words"], 8), dtype=np.uint64), _unpack(row["counts"], row["n_words"], 4)
            bounds = [*np.searchsorted(words, limits), len(words)]
            out = [
                dict(bucket=i, block=row["block"], level=_WORDS, n=int(b - a), contexts=_delta(words[a:b]), words=b"", counts=_pack(counts[a:b], 4), lower=b"", k=0, asked=b"")
                for i, (a, b) in enumerate(zip(bounds, bounds[1:])) if a < b
            ]
            yield pa.RecordBatch.from_pylist(out, _arrow(_ASK))


def _settle_words(table: pa.Table, buckets: int, often: int, least: int) -> pa.Table:
    """One range of words: how often each occurs in all blocks, and the id of those that occur
    ``least`` times; and the ``often`` most frequent ones."""
    rows = table.to_pylist()
    words, counts = (np.concatenate(x) for x in zip(*((_undelta(r["contexts"], r["n"]), _unpack(r["counts"], r["n"], 4)) for r in rows)))
    _, where = np.unique(words, return_inverse=True)
    total = np.bincount(where, counts).astype(np.int64)
    # low numbers for frequent words pack well
    number = np.empty(len(total), np.int64)
    number[_by_count(total)] = np.arange(len(total))
    own = np.where(total >= least, 1 + number * buckets + rows[0]["bucket"], 0)  # 0: none
    reply = lambda block, level, n, counts, sums: dict(block=block, level=level, bucket=rows[0]["bucket"], n=n, entered=b"", counts=_pack(counts.astype(np.uint64), 6), names=b"", k=0, linked=b"", sums=sums)
    facts = np.array([total.sum(), (total > 0).sum(), (total == 1).sum(), (total == 2).sum()])
    many = np.flatnonzero((total >= least) & (number < often))
    out, at = [reply(-1, _FACTS, 4, facts, b""), reply(-1, _OFTEN, len(many), total[many], _pack(own[many].astype(np.uint64) - np.uint64(1), 4))], 0
    if not rows[0]["bucket"]:
        runs, since = np.unique(-np.sort(-total), return_index=True)
        out.append(reply(-1, _TYPICAL, len(runs), runs, _pack(since.astype(np.uint64), 4)))
    for r in rows:
        mine, at = where[at : at + r["n"]], at + r["n"]
        steps = np.diff(total[mine][_by_number(own[mine])], prepend=0)
        out.append(reply(r["block"], _WORDS, r["n"], _signed(steps), _pack(own[mine].astype(np.uint64), 4)))
    return pa.Table.from_pylist(out, _arrow(_REPLY))


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([_unpack(x, 4, 6) for x in batch["counts"].to_pylist()], np.int64).reshape(-1, 4)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in found.T], ["tokens", "types", "once", "twice"])


def _round(blocks: DataFrame, replies: DataFrame, step, schema: str) -> DataFrame:
    """``step(block row, its replies)`` for every block."""

    def run(own: pa.Table, heard: pa.Table) -> pa.Table:
        parts = [step(row, heard.to_pylist()) for row in own.to_pylist()]
        return pa.concat_tables(parts) if parts else pa.Table.from_pylist([], _arrow(schema))

    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, schema)


_SCORES = "id long, n_tokens long, n_known long, base double, score double"


def _model(docs: DataFrame, training: Column, doc_id: str, text: str, block: int, min_count: int, gram_share: float | None, split: int) -> tuple[DataFrame, DataFrame, Setting]:
    """Blocks, the replies of all rounds, and the setting."""
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(training, F.lit(False)).alias("train"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    about = (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // (6 * block)
    parts = max(8, min(BUCKETS, about // TOGETHER))
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "blocks")
    written = _in_buckets(rows.mapInArrow(lambda batches: _blocks(batches, block), _BLOCK), path, parts, "kind")
    blocks, hashes = written.filter(F.col("kind") == _TEXTS).drop("words", "kind"), written.filter(F.col("kind") == _HASHES)
    size = blocks.agg(F.sum("n_tokens")).first()[0] or 0
    buckets = max(1, min(1 << 20, size // (SETTLED * block)))
    asked = hashes.select("block", "n_words", "words", "counts").mapInArrow(lambda batches: _ask_words(batches, buckets), _ASK)
    often = OFTEN // buckets
    least = 1 if gram_share else min_count  # a rarer word is in no n-gram that enters
    told = asked.groupBy("bucket").applyInArrow(lambda t: _settle_words(t, buckets, often, least), _REPLY)
    # replies are dealt to their blocks once and written there, not dealt again in each round
    told = _in_buckets(told.repartition(parts, "block"), scratch_path(spark, "words"), parts)
    # nothing for the hashes: they have been asked for
    spark.createDataFrame([], hashes.drop("kind").schema).write.mode("overwrite").parquet(f"{path}/kind={_HASHES}")
    facts = told.filter(F.col("level") == _FACTS).mapInArrow(_facts, "tokens long, types long, once long, twice long")
    n, types, once, twice = (x or 0 for x in facts.agg(*[F.sum(c) for c in facts.columns]).first())
    enough = max(1, math.ceil(gram_share * n - 1e-9)) if gram_share else min_count
    frequent, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for r in told.filter(F.col("level") == _OFTEN).select("n", "counts", "sums").collect():  # at most OFTEN words
        frequent = np.append(frequent, _unpack(r["sums"], r["n"], 4).astype(np.int64))
        times = np.append(times, _unpack(r["counts"], r["n"], 6).astype(np.int64))
    order = np.argsort(frequent)
    typical, since = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for r in told.filter(F.col("level") == _TYPICAL).select("n", "counts", "sums").collect():  # one row
        typical, since = (_unpack(x, r["n"], w).astype(np.int64)[::-1] for x, w in ((r["counts"], 6), (r["sums"], 4)))
    setting = Setting(n, types, once / (once + 2 * twice) if once and twice else DISCOUNT, enough, buckets, split, frequent[order], times[order], typical, since)
    replies = told.filter(F.col("level") == _WORDS)
    for level in (2, 3):

        def ask(row: dict, heard: list[dict], level: int = level) -> pa.Table:
            return pa.Table.from_pylist(Reader(row, heard, setting, level).levels[level].ask(row["block"], level), _arrow(_ASK))

        asked = _round(blocks, replies, ask, _ASK)
        settled = _settled(asked, setting, level == 2).repartition(parts, "block")
        if level == 2:
            settled = _in_buckets(settled, scratch_path(spark, "replies"), parts)
            sums = np.zeros((len(setting.frequent), 3), np.int64)
            for r in settled.filter(F.col("level") == _SUMS).select("names", "k", "sums").collect():  # at most OFTEN words
                sums[np.searchsorted(setting.frequent, _undelta(r["names"], r["k"]))] += _unpack_sums(r["sums"], r["k"], enough).T
            setting = replace(setting, sums=sums)
        # the last ones are read once, so they are not written
        replies = replies.unionByName(settled.filter(F.col("level") == level))
    return blocks, replies, setting


def entered(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK, min_count: int = MIN_COUNT) -> DataFrame:
    """(level, arcs): how many n-grams of 2 and of 3 words enter, each counted in every block
    that holds it, all documents being learned from."""
    _, replies, _ = _model(docs, F.lit(True), doc_id, text, block, min_count, None, SPLIT)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arcs = [int(np.unpackbits(np.frombuffer(e, np.uint8)).sum()) for e in batch["entered"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["level"], pa.array(arcs, pa.int64())], ["level", "arcs"])

    rows = replies.filter(F.col("level") > _WORDS).select("level", "entered")
    return rows.mapInArrow(count, "level int, arcs long").groupBy("level").agg(F.sum("arcs").alias("arcs"))


def score(
    docs: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK, min_count: int = MIN_COUNT, gram_share: float | None = None, split: int = SPLIT
) -> DataFrame:
    """One row per document: doc_id, n_tokens, n_known, train_tokens, base_score, score; the
    rows where ``training`` holds are learned from."""
    blocks, replies, setting = _model(docs, training, doc_id, text, block, min_count, gram_share, split)
    space = math.log10(setting.tokens + setting.types + 1)

    def read(row: dict, heard: list[dict]) -> pa.Table:
        reader = Reader(row, heard, setting, 4)
        line = np.repeat(np.arange(len(reader.sizes)), reader.sizes)
        own = reader.count[reader.local]
        add = lambda x: np.bincount(line, x, len(reader.sizes))
        base = add(np.log10(own + 1.0)) - space * reader.sizes
        columns = [
            pa.array(row["ids"], pa.int64()), pa.array(reader.sizes),
            pa.array(add(own > 0).astype(np.int64)), pa.array(base), pa.array(add(reader.read())),
        ]
        return pa.Table.from_arrays(columns, [c.split(" ")[0] for c in _SCORES.split(", ")])

    scored = _round(blocks, replies, read, _SCORES)
    return scored.select(
        F.col("id").alias(doc_id), "n_tokens", "n_known", F.lit(setting.tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score"
    )


def held_out_scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """All documents, scored by a model of those outside the held-out fold."""
    scored = score(docs, ~held_out(F.col(doc_id)), doc_id=doc_id, text=text, **settings)
    return scored.select(doc_id, held_out(F.col(doc_id)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
