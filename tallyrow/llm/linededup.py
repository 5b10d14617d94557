"""Line dedup by winnowing over line hashes.

A run of lines that holds ``min_words`` words or more and occurs again later loses its later
occurrences. Lines compare after lower-casing A-Z and collapsing white space; blank lines
belong to no run and stay.

From each line on, the shortest run of lines with ``min_words`` words is a window; so is the
shortest one up to each line. The smallest line hash of a window is its fingerprint, so any
two equal runs long enough share fingerprints for certain, and neighbouring windows mostly
share theirs. A fingerprint that occurs once in the corpus settles all its windows: only
those of repeated fingerprints are joined by position, which is done by the digest of the
window that lies around it. The first occurrence stays, in the order of id (null last), text
digest and line; what equals it later is marked. Windows that grow to the right and windows
that grow to the left together cover every line of a repeated run, which extends each match
both ways as far as it goes. An occurrence that overlaps the first one in its own document is
not a later one.

Rows that agree in id and text are one document and get equal results. A null text has no
lines and stays null. All columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tallyrow.llm.common import fresh
from tallyrow.operators.sizing import staged

MIN_WORDS = 50


def sequence(text: str | None) -> tuple[list[int], list[bytes], np.ndarray]:
    """Numbers of the lines that are not blank, the lines as compared, and their words."""
    at, lines, words = [], [], []
    for i, raw in enumerate((text or "").encode().split(b"\n")):
        if parts := raw.lower().split():
            at.append(i)
            lines.append(b" ".join(parts))
            words.append(len(parts))
    return at, lines, np.array(words, np.int64)


def windows(words: np.ndarray, min_words: int) -> np.ndarray:
    """Distinct (start, end) of the shortest runs with enough words, by start and by end."""
    total = np.concatenate([[0], np.cumsum(words)])
    start = np.arange(len(words))
    end = np.searchsorted(total, total[:-1] + min_words) - 1  # first end with enough words
    right = np.stack([start, end], 1)[end < len(words)]
    begin = np.searchsorted(total, total[1:] - min_words, side="right") - 1
    left = np.stack([begin, start], 1)[begin >= 0]
    return np.unique(np.concatenate([right, left]), axis=0)


def fingerprints(text: str | None, min_words: int = MIN_WORDS) -> dict[int, tuple[set[int], list[tuple[int, int, bytes]]]]:
    """By fingerprint, the smallest line hash of a window: the lines it was selected at (the
    last smallest of each window) and its windows as (start, end, digest)."""
    _, lines, words = sequence(text)
    hashes = [(xxhash.xxh64_intdigest(line), i) for i, line in enumerate(lines)]
    out: dict[int, tuple[set[int], list[tuple[int, int, bytes]]]] = {}
    for start, end in windows(words, min_words).tolist():
        digest = xxhash.xxh3_128_digest(b"\n".join(lines[start : end + 1]))
        h, at = min(hashes[start : end + 1], key=lambda x: (x[0], -x[1]))
        selected, found = out.setdefault(h, (set(), []))
        selected.add(at)
        found.append((start, end, digest))
    return out


def _key(docs: DataFrame, doc_id: str, text: str) -> list[Column]:
    return [F.col(doc_id).alias("id"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("digest")]


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, digest, runs): of each document that repeats something, the windows to delete,
    as (start, end) over its lines that are not blank."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for own, digest, words in zip(batch["id"], batch["digest"], batch["text"]):
                for h, (selected, found) in fingerprints(words, min_words).items():
                    s, e, d = zip(*found)
                    rows.append((own, digest, h - (1 << 63), len(selected), s, e, d))
            out = pd.DataFrame(rows, columns=["id", "digest", "h", "n", "s", "e", "d"])
            out["id"] = out["id"].astype("Int64")
            yield out

    schema = "id long, digest string, h long, n int, s array<int>, e array<int>, d array<binary>"
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), _key(docs, doc_id, text)[1], F.col(text).alias("text"))
    found = staged(rows.mapInPandas(scan, schema), "winnowed")
    repeated = found.groupBy("h").agg(F.sum("n").alias("places")).filter("places > 1").select("h")
    each = found.join(repeated, "h", "left_semi").select("id", "digest", F.explode(F.arrays_zip("s", "e", "d")).alias("w"))
    place = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("digest").alias("digest"), F.col("w.s").alias("s"), F.col("w.e").alias("e"))
    each = each.select("id", "digest", F.col("w.s").alias("s"), F.col("w.e").alias("e"), F.col("w.d").alias("d"), place.alias("place"))
    first = each.groupBy("d").agg(F.min("place").alias("first"), F.max("place").alias("last")).filter("first < last").select("d", "first")
    same_doc = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("digest") == F.col("first.digest"))
    later = each.join(first, "d").filter(~same_doc | (F.col("s") > F.col("first.e")))
    return later.groupBy("id", "digest").agg(F.collect_set(F.struct("s", "e")).alias("runs"))


def _delete(text: str | None, runs) -> tuple[str | None, int, int, int]:
    """(text without the runs' lines, lines, deleted lines, deleted words)."""
    if text is None:
        return None, 0, 0, 0
    lines = text.split("\n")
    if runs is None or not len(runs):
        return text, len(lines), 0, 0
    at, _, words = sequence(text)
    gone = np.zeros(len(at) + 1, np.int64)
    for r in runs:
        gone[r["s"]] += 1
        gone[r["e"] + 1] -= 1
    gone = np.cumsum(gone)[:-1] > 0
    drop = set(np.array(at)[gone].tolist())
    return "\n".join(line for i, line in enumerate(lines) if i not in drop), len(lines), len(drop), int(words[gone].sum())


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text", counts: bool = False) -> DataFrame:
    """The documents without later repeated runs; with ``counts`` also n_lines, n_deleted and
    n_words_deleted."""
    runs = repeated_runs(docs, min_words, doc_id, text)
    key, digest, own = (fresh(docs, s) for s in ("run_id", "run_digest", "runs"))
    side = runs.select(F.col("id").alias(key), F.col("digest").alias(digest), F.col("runs").alias(own))
    same = F.col(doc_id).eqNullSafe(F.col(key)) & (_key(docs, doc_id, text)[1] == F.col(digest))

    @F.pandas_udf("struct<text: string, n_lines: long, n_deleted: long, n_words_deleted: long>")
    def delete(texts: pd.Series, deleted: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_delete(t, r) for t, r in zip(texts, deleted)], columns=["text", "n_lines", "n_deleted", "n_words_deleted"])

    done = fresh(docs, "done")
    joined = docs.join(side, same, "left").withColumn(done, delete(F.col(text), F.col(own)))
    kept = [F.col(f"{done}.text").alias(c) if c == text else F.col(c) for c in docs.columns]
    return joined.select(*kept, *([F.col(f"{done}.{c}") for c in ("n_lines", "n_deleted", "n_words_deleted")] if counts else []))


def report(docs: DataFrame, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_lines, n_deleted, n_words_deleted, text_sha256 (of the
    text that stays; null stays null)."""
    done = dedup_lines(docs.select(doc_id, text), min_words, doc_id, text, counts=True)
    return done.select(doc_id, "n_lines", "n_deleted", "n_words_deleted", F.sha2(F.col(text), 256).alias("text_sha256"))
