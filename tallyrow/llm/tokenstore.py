"""Token ids in binary shards with a minimal perfect hash index.

The files are Parquet tables of shards, so any store that Spark reaches holds them. One row is
one shard of consecutive documents in ascending id order:

    part, number   order of the shards
    n_docs, n_ids  documents and ids in the shard
    first, last    smallest and largest document id
    width          bytes of an id: 2 while the vocabulary has at most 65,536 ids, else 4
    payload        the ids of all its documents, raw little-endian
    doc_ids        int64 a document, in payload order;  no_id: the number of leading null ids
    levels, sizes  the hash: one bit map a level, packed one after the other, and its bits
    ranks          uint32 for each 512 bits of them: the set bits before
    prints         uint32 a slot: the key's fingerprint
    starts, counts uint64 a slot: where the document's ids begin in the payload, and how many

A key is (document id, number of the row among equal ids in the shard). It takes the first
level at whose bit map its hash meets a set bit; the number of set bits before, a stored rank and
the bits of one block, is its slot. The slot's fingerprint tells a key of the shard from any
other. Each access touches one block a level, on average under two, and one slot, whatever the
shard's size.

A null or empty text has only the end id. Null ids come first. Repeated rows are stored as
often as they come.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyrow.llm.common import small_side
from tallyrow.session import scratch_path

END_ID = 1
#: A shard is closed at this many ids or documents; a longer document has a shard of its own.
SHARD_IDS, SHARD_DOCS = 1 << 20, 1 << 15
#: Bytes of text that are encoded at once.
BLOCK_BYTES = 4 << 20
#: Bytes of words and ids that a task keeps, and what an entry takes beside its own bytes.
CACHE_BYTES, ENTRY_BYTES = 64 << 20, 220
SHARD_SCHEMA = (
    "part long, number long, n_docs long, n_ids long, first long, last long, width int, payload binary, doc_ids binary, "
    "no_id long, levels binary, sizes binary, ranks binary, prints binary, starts binary, counts binary"
)

SHARD_ARROW = pa.schema([(n, {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[t]) for n, t in (c.split() for c in SHARD_SCHEMA.split(", "))])

_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)")


def _size(words: dict[str, bytes]) -> int:
    """Bytes of kept words."""
    return sum(map(len, words)) + sum(map(len, words.values())) + ENTRY_BYTES * len(words)


class WordEncoder:
    """Ids of texts under a tokenizer that drops white space and never joins what lies on its
    two sides. Ids are kept by word, so a word is encoded once and then taken by number. Words of plain letters and
    closing signs go to the vocabulary's merges in bulk: every piece ends in an id that
    carries the word end, which shows where the pieces part. All others are encoded as they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.full = Tokenizer.from_file(path)
        self.pieces = Tokenizer(self.full.model)
        self.pieces.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.full.get_vocab()
        self.width = 2 if max(vocabulary.values()) < 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        suffix = getattr(self.full.model, "end_of_word_suffix", None)
        self.bulk = bool(suffix)
        if self.bulk:
            self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        """Drops the words that were kept."""
        self.words: dict[str, bytes] = {}
        self.held = 0

    def _encode_pieces(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of lower-case letter or sign runs."""
        lines = [" ".join(pieces[i : i + 64]) for i in range(0, len(pieces), 64)]
        ids = np.concatenate([np.array(e.ids, self.dtype) for e in self.pieces.encode_batch_fast(lines, add_special_tokens=False)])
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(pieces):
            raise ValueError("the tokenizer's pieces do not end in word ends")
        raw, bounds = ids.tobytes(), [0, *(stops * self.width).tolist()]
        return {p: raw[a:b] for p, a, b in zip(pieces, bounds, bounds[1:])}

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        letters_only, plain, other, found = {}, {}, [], {}
        for word in words:
            if self.bulk and word.isascii() and word.isalpha():
                letters_only[word] = word.lower()
                continue
            match = _PLAIN.fullmatch(word) if self.bulk else None
            if match:
                plain[word] = match[1].lower(), match[2]
            else:
                other.append(word)
        if plain or letters_only:
            pieces = set(letters_only.values())
            for pair in plain.values():
                pieces.update(pair)
            pieces.discard("")
            ids = self._encode_pieces(list(pieces)) if pieces else {}
            ids[""] = b""
            found = {word: ids[letters] for word, letters in letters_only.items()}
            for word, (letters, signs) in plain.items():
                found[word] = ids[letters] + ids[signs]
        if other:
            for word, e in zip(other, self.full.encode_batch_fast(other, add_special_tokens=False)):
                found[word] = np.array(e.ids, self.dtype).tobytes()
        return found

    def _encode_block(self, texts: pa.Array) -> list[bytes]:
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.words.get, distinct))
        new = self._learn([w for w, i in zip(distinct, ids) if i is None])
        size = _size(new)
        if self.held + size > CACHE_BYTES:
            # words met again stay, so that the frequent ones are not encoded in each block
            again = {w: i for w, i in zip(distinct, ids) if i is not None}
            self.forget()
            if _size(again) + size <= CACHE_BYTES:
                self.words, self.held = again, _size(again)
        ids = [new[w] if i is None else i for w, i in zip(distinct, ids)]
        if size <= CACHE_BYTES:
            self.words.update(new)
            self.held += size
        ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))]) // self.width
        known = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), self.dtype)))
        taken = known.take(words.indices)
        raw = taken.flatten().to_numpy(zero_copy_only=False).astype(self.dtype, copy=False).tobytes()
        bounds = (taken.offsets.to_numpy()[split.offsets.to_numpy()].astype(np.int64) * self.width).tolist()
        return [raw[a:b] for a, b in zip(bounds, bounds[1:])]

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text, as raw bytes; a null text has none. Texts go in blocks of
        at most ``BLOCK_BYTES``, or of one text."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        total = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)])
        at = 0
        while at < len(texts):
            stop = max(at + 1, int(np.searchsorted(total, total[at] + BLOCK_BYTES, side="right")) - 1)
            # a copy of the slice alone: its offsets start at 0
            yield from self._encode_block(pa.concat_arrays([texts.slice(at, stop - at)]))
            at = stop


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One a worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _mix(keys: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit bijection for each salt."""
    x = keys ^ np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_PRINT_SALT = 10_001


def keys_of(doc_ids: np.ndarray, copies: np.ndarray, nulls: np.ndarray) -> np.ndarray:
    """Keys of (id, copy); those of null ids lie in a sequence of their own."""
    keys = _mix(doc_ids.view(np.uint64), 20_000)
    return np.where(nulls, _mix(copies.astype(np.uint64), 20_001), np.where(copies == 0, keys, _mix(keys + copies.astype(np.uint64), 20_002)))


#: Bits of a block.
_BITS = 512


def build_hash(keys: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Levels of a minimal perfect hash of distinct keys, packed, their bits, and the set bits
    before each block."""
    maps, sizes, left = [], [], keys
    while len(left):
        size = 2 * len(left)
        place = (_mix(left, len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(place, minlength=size) == 1
        maps.append(alone)
        sizes.append(size)
        left = left[~alone[place]]
        if len(sizes) > 200:
            raise ValueError("two documents have one key")
    bits = np.concatenate(maps or [np.zeros(0, bool)])
    levels = np.packbits(np.pad(bits, (0, -len(bits) % _BITS)))
    ones = np.bitwise_count(levels.reshape(-1, _BITS // 8)).sum(axis=1, dtype=np.int64)
    return levels.tobytes(), np.array(sizes, "<u8"), (np.cumsum(ones) - ones).astype("<u4")


def slots(keys: np.ndarray, levels: bytes, sizes: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Slots of the keys; -1 for a key that meets no level. Other keys than those the hash was
    built from may get any slot. Of each level a key reads the one block it falls into."""
    blocks = np.frombuffer(levels, np.uint8).reshape(-1, _BITS // 8)
    found, open_, first = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
    for level, size in enumerate(sizes.tolist()):
        if not len(open_):
            break
        place = (_mix(keys[open_], level) % np.uint64(size)).astype(np.int64)
        block, bit = (first + place) // _BITS, (first + place) % _BITS
        own = blocks[block]
        hit = own[np.arange(len(own)), bit >> 3] >> (7 - (bit & 7)).astype(np.uint8) & 1 == 1
        at, own, bit = block[hit], own[hit], bit[hit]
        # set bits in the block before the key's: whole bytes, and the high bits of its own
        earlier = np.where(np.arange(_BITS // 8) < (bit >> 3)[:, None], own, 0)
        part = own[np.arange(len(own)), bit >> 3] >> (8 - (bit & 7)).astype(np.uint8)
        found[open_[hit]] = ranks[at].astype(np.int64) + np.bitwise_count(earlier).sum(axis=1, dtype=np.int64) + np.bitwise_count(part)
        open_ = open_[~hit]
        first += size
    return found


def prints_of(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, _PRINT_SALT) >> np.uint64(32)).astype("<u4")


def _copies(ids: np.ndarray, nulls: np.ndarray) -> np.ndarray:
    """Number of a row among the rows of its id; ids are sorted."""
    n = len(ids)
    new = np.ones(n, bool)
    new[1:] = (ids[1:] != ids[:-1]) | (nulls[1:] != nulls[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    return np.arange(n) - first


def pack(part: int, number: int, ids: list, payloads: list[bytes], width: int) -> dict:
    """The row of one shard."""
    nulls = np.array([i is None for i in ids])
    doc_ids = np.array([0 if i is None else i for i in ids], np.int64)
    counts = np.array([len(p) // width for p in payloads], np.uint64)
    starts = np.cumsum(counts, dtype=np.uint64) - counts
    keys = keys_of(doc_ids, _copies(doc_ids, nulls), nulls)
    levels, sizes, ranks = build_hash(keys)
    order = np.argsort(slots(keys, levels, sizes, ranks))
    known = doc_ids[~nulls]
    return {
        "part": part, "number": number, "n_docs": len(ids), "n_ids": int(counts.sum()),
        "first": int(known[0]) if len(known) else None, "last": int(known[-1]) if len(known) else None,
        "width": width, "payload": b"".join(payloads), "doc_ids": doc_ids.astype("<i8").tobytes(), "no_id": int(nulls.sum()),
        "levels": levels, "sizes": sizes.tobytes(), "ranks": ranks.tobytes(), "prints": prints_of(keys)[order].tobytes(),
        "starts": starts[order].astype("<u8").tobytes(), "counts": counts[order].astype("<u8").tobytes(),
    }


def locate(shard, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(found, start, count) of the keys in a shard, by its index alone."""
    slot = slots(keys, shard.levels, np.frombuffer(shard.sizes, "<u8"), np.frombuffer(shard.ranks, "<u4"))
    found = slot >= 0
    at = np.where(found, slot, 0)
    found &= np.frombuffer(shard.prints, "<u4")[at] == prints_of(keys)
    return found, np.frombuffer(shard.starts, "<u8")[at].astype(np.int64), np.frombuffer(shard.counts, "<u8")[at].astype(np.int64)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode every text, add the end id and write the shards in ascending id order.

    Texts are dealt by id range before they are encoded, so ids are never shuffled; rows of
    one id may lie in several ranges.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        end = np.array([end_id], enc.dtype).tobytes()
        ids, payloads, held, number = [], [], 0, 0

        def shard() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([pack(part, number, ids, payloads, enc.width)], SHARD_ARROW)

        try:
            for batch in batches:
                for own, data in zip(batch["id"].to_pylist(), enc.encode(batch["text"])):
                    data += end
                    if ids and (held + len(data) // enc.width > SHARD_IDS or len(ids) >= SHARD_DOCS):
                        yield shard()
                        ids, payloads, held, number = [], [], 0, number + 1
                    ids.append(own)
                    payloads.append(data)
                    held += len(data) // enc.width
            if ids:
                yield shard()
        finally:
            enc.forget()  # the worker outlives the task

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    dealt = rows.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(*order, "salt").sortWithinPartitions(*order)
    dealt.select("id", "text").mapInArrow(encode, SHARD_SCHEMA).write.parquet(path)


def bases(shards: DataFrame) -> DataFrame:
    """(part, number, base): ids before each shard; shards are added up inside their part,
    parts by their totals."""
    sizes = shards.select("part", "number", "n_ids")
    totals = sizes.groupBy("part").agg(F.sum("n_ids").alias("t"))
    before = totals.select("part", F.coalesce(F.sum("t").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("b"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1))
    return sizes.withColumn("inside", F.coalesce(inside, F.lit(0))).join(before, "part").select("part", "number", (F.col("b") + F.col("inside")).alias("base"))


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """One row per stored document, found through the index: doc_id, start (ids of all
    documents before it), n_tokens, ids_crc32 (of its ids as little-endian uint32)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):  # one shard at a time
                shard = SimpleNamespace(**batch.slice(i, 1).to_pylist()[0])
                doc_ids = np.frombuffer(shard.doc_ids, "<i8")
                nulls = np.arange(len(doc_ids)) < shard.no_id
                found, start, count = locate(shard, keys_of(doc_ids, _copies(doc_ids, nulls), nulls))
                if not found.all():
                    raise ValueError(f"shard {shard.part}-{shard.number}: its index misses {int((~found).sum())} documents")
                ids = np.frombuffer(shard.payload, f"<u{shard.width}")
                crc = [zlib.crc32(ids[a : a + n].astype("<u4")) for a, n in zip(start.tolist(), count.tolist())]
                same = lambda x: pa.array(np.full(len(doc_ids), x))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, mask=nulls), same(shard.part), same(shard.number), pa.array(start), pa.array(count), pa.array(crc, pa.int64())],
                    ["id", "part", "number", "own", "n_tokens", "ids_crc32"],
                )

    shards = spark.read.parquet(path)
    columns = shards.drop("first", "last", "n_docs", "n_ids")
    found = columns.mapInArrow(scan, "id long, part long, number long, own long, n_tokens long, ids_crc32 long")
    return found.join(small_side(bases(shards), 100_000), ["part", "number"]).select(
        F.col("id").alias("doc_id"), (F.col("base") + F.col("own")).alias("start"), "n_tokens", "ids_crc32"
    )


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """(doc_id, copy, ids) of the stored rows of a list of ids given by the caller. Only
    shards whose range holds one of them are read, and in each only the slots of the keys."""
    wanted = np.array(sorted(set(doc_ids)), np.int64)

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch.itertuples():
                open_, copy = wanted[(wanted >= shard.first) & (wanted <= shard.last)], 0
                ids = np.frombuffer(shard.payload, f"<u{shard.width}")
                while len(open_):
                    n = np.full(len(open_), copy)
                    found, start, count = locate(shard, keys_of(open_, n, np.zeros(len(open_), bool)))
                    open_ = open_[found]
                    own = [ids[a : a + c].tolist() for a, c in zip(start[found].tolist(), count[found].tolist())]
                    yield pd.DataFrame({"doc_id": open_, "copy": copy, "ids": pd.Series(own, dtype=object)})
                    copy += 1

    listed = F.array(*[F.lit(int(i)) for i in wanted]).cast("array<bigint>")
    hit = F.exists(listed, lambda i: (i >= F.col("first")) & (i <= F.col("last")))
    rows = spark.read.parquet(path).filter(F.col("first").isNotNull()).filter(hit)
    return rows.mapInPandas(fetch, "doc_id long, copy long, ids array<long>")


def stored(docs: DataFrame, tokenizer: str, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the documents' shards to a new folder of the shared storage and read them back."""
    path = scratch_path(docs.sparkSession, "tokens")
    write(docs, path, tokenizer, end_id, doc_id, text)
    return read_back(docs.sparkSession, path)
