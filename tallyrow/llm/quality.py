"""Quality classifier from weak labels.

For each aspect (junk, toxic, stems) several overlapping heuristics vote on every document: bad, good
or no opinion. Expectation-maximisation over the counts of the vote patterns, of which there
are at most 3 to the number of heuristics, estimates how often each heuristic is right on
either class and gives every pattern a posterior. The posteriors of a bounded sample of
documents train a linear scorer over hashed words and signals, and the scorer judges every
document by its whole text.

Word lists know few languages. Where ``labels`` are given, the aspect ``stems`` has heuristics
that look for word stems which a bounded sample of labelled documents shows almost only in
toxic ones; they vote like the others, and EM decides what they are worth. Without labels the
aspect is left out.

A document is rejected when its probability of being bad reaches ``threshold`` in any aspect.
Documents with a vote pattern that EM finds bad are sampled at a higher rate, so that rare bad
documents are learnt as well, and weighted back; each class counts for at least ``CLASS_SHARE``
of the loss, whatever its share of the documents.
A null or empty text gets no votes; the scorer sees no words and judges by its intercept. The
scorer's sample is one of different texts: copies count once, null texts not at all.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tallyrow.llm.common import cut
from tallyrow.operators.sizing import staged

BAD, GOOD, NONE = 1, 0, -1
#: Documents the scorer is trained on, at most about; ``BAD_ROWS`` for each aspect come on top.
TRAIN_ROWS = 10_000
#: Further documents of an aspect's bad vote patterns, at most about.
BAD_ROWS = 1_000
#: The least share of the loss that the bad documents of an aspect stand for, if there are any.
CLASS_SHARE = 0.01
#: Of the scorer: L1 penalty and rounds of its solver.
PENALTY, ROUNDS = 2e-4, 200
#: Labelled documents that word stems are learnt from, at most about.
LABEL_ROWS = 40_000
#: Lengths of stems in bytes, by heuristic; a stem must be in this share of the toxic
#: documents, and may be in this many others for each toxic one.
STEMS = ((5, 6), (7, 8), (9, 10))
STEM_SHARE, STEM_IMPURITY = 0.005, 0.03
FEATURES = 1 << 16
THRESHOLD = 0.5

#: Abusive words by kind; the kinds overlap.
INSULTS = {
    "mind": "clown dumb fool idiot imbecile moron stupid",
    "worth": "garbage loser pathetic scum trash worthless",
    "name": "clown fool idiot imbecile loser moron scum",
    "scorn": "disgusting dumb filthy pathetic stupid worthless",
}
_KINDS = {kind: frozenset(w.encode() for w in words.split()) for kind, words in INSULTS.items()}
_ABUSE = frozenset().union(*_KINDS.values())
_STEMS = tuple(sorted(_ABUSE))
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))
_SIGNS = b"*#$%&^~|<>{}[]\\=+_@"
_EDGES = b".,;:!?\"'()" + _SIGNS


@dataclass
class Seen:
    """What the heuristics look at."""

    raw: bytes
    words: list[bytes]
    bare: set[bytes]


def look(text: str | None) -> Seen:
    raw = (text or "").encode()
    words = raw.lower().split()
    return Seen(raw, words, {w.strip(_EDGES) for w in set(words)})


def _vote(value: float, good: float, bad: float) -> int:
    return BAD if value >= bad else GOOD if value <= good else NONE


def _share(raw: bytes, chars: bytes) -> float:
    return (len(raw) - len(raw.translate(None, chars))) / max(1, len(raw))


def caps(d: Seen) -> int:
    upper, letters = _share(d.raw, _UPPER), _share(d.raw, _LETTERS)
    return _vote(upper / letters, 0.2, 0.5) if letters and len(d.words) >= 3 else NONE


def shouting(d: Seen) -> int:
    return _vote(d.raw.count(b"!!") / len(d.words), 0.05, 0.3) if d.words else NONE


def signs(d: Seen) -> int:
    return _vote(_share(d.raw, _SIGNS), 0.01, 0.04) if d.words else NONE


def marked(d: Seen) -> int:
    return _vote(sum(1 for w in d.words if w[-1] in _SIGNS) / len(d.words), 0.05, 0.2) if d.words else NONE


def fragments(d: Seen) -> int:
    return _vote(sum(1 for w in d.words if not w.strip(_EDGES)) / len(d.words), 0.05, 0.2) if d.words else NONE


def stutter(d: Seen) -> int:
    return _vote(sum(map(eq, d.words, d.words[1:])) / len(d.words), 0.08, 0.3) if len(d.words) >= 10 else NONE


def variety(d: Seen) -> int:
    return _vote(1 - len(d.bare) / len(d.words), 0.75, 0.9) if 20 <= len(d.words) <= 5000 else NONE


def word_length(d: Seen) -> int:
    return _vote(abs(len(d.raw) / len(d.words) - 7), 5, 12) if len(d.words) >= 10 else NONE


def _insult(kind: str) -> Callable[[Seen], int]:
    return lambda d: (BAD if d.bare & _KINDS[kind] else GOOD) if d.words else NONE


def abusive_word(d: Seen) -> int:
    return (BAD if d.bare & _ABUSE else GOOD) if d.words else NONE


def abusive_stem(d: Seen) -> int:
    return (BAD if any(w.startswith(_STEMS) for w in d.bare) else GOOD) if d.words else NONE


#: Heuristics by aspect.
LABELLERS: dict[str, list[Callable[[Seen], int]]] = {
    "junk": [caps, shouting, signs, marked, fragments, stutter, variety, word_length],
    "toxic": [abusive_word, abusive_stem, *(_insult(kind) for kind in INSULTS)],
}
ASPECTS = [*LABELLERS, "stems"]


Stems = dict[tuple[int, ...], frozenset[bytes]]


def _stem_vote(d: Seen, lengths: tuple[int, ...], stems: frozenset[bytes]) -> int:
    if not d.words:
        return NONE
    return GOOD if all(stems.isdisjoint([w[:k] for w in d.bare]) for k in lengths) else BAD


def votes(d: Seen, stems: Stems) -> dict[str, tuple[int, ...]]:
    """Votes by aspect."""
    cast = {a: tuple(f(d) for f in fs) for a, fs in LABELLERS.items()}
    return cast | {"stems": tuple(_stem_vote(d, *s) for s in stems.items())}


def _code(pattern: tuple[int, ...]) -> str:
    return "".join("abg"[v + 1] for v in pattern)  # a: none, b: good, g: bad


def _decode(code: str) -> tuple[int, ...]:
    return tuple("abg".index(c) - 1 for c in code)


@dataclass
class Labelled:
    """What EM found for one aspect."""

    prior: float
    hit: list[float]  # P(bad vote | bad) of each heuristic
    false: list[float]  # P(bad vote | good)
    posterior: dict[str, float]  # of each vote pattern


def estimate(patterns: dict[str, int], rounds: int = 200) -> Labelled:
    """EM for two classes and independent heuristics, from the counts of vote patterns."""
    if not any(patterns):  # no documents, or no heuristics
        return Labelled(0.0, [], [], dict.fromkeys(patterns, 0.0))
    codes = sorted(patterns)
    v = np.array([_decode(c) for c in codes])
    n = np.array([patterns[c] for c in codes], float)
    bad, cast = v == BAD, v != NONE
    p = np.array([0.01, 0.5, 0.9])[np.minimum(bad.sum(axis=1), 2)]
    for _ in range(rounds):
        prior = float(np.clip((n * p).sum() / n.sum(), 1e-6, 1 - 1e-6))
        rate = [((n * q) @ bad + s) / ((n * q) @ cast + 1.0) for q, s in ((p, 0.5), (1 - p, 0.001))]
        hit, false = (np.clip(r, 1e-6, 1 - 1e-6) for r in rate)
        gain = np.where(bad, np.log(hit / false), np.where(cast, np.log((1 - hit) / (1 - false)), 0.0)).sum(axis=1)
        new = 1 / (1 + np.exp(-np.clip(gain + math.log(prior / (1 - prior)), -50, 50)))
        if np.abs(new - p).max() < 1e-9:
            break
        p = new
    return Labelled(prior, hit.tolist(), false.tolist(), dict(zip(codes, p.tolist())))


def _bucket(feature: bytes) -> int:
    return zlib.crc32(feature) % FEATURES


_BUCKETS: dict[bytes, int] = {}


def features(d: Seen, cast: dict[str, tuple[int, ...]]) -> np.ndarray:
    """Distinct hashed features: bare words, and which heuristics saw something bad."""
    if len(_BUCKETS) > 500_000:
        _BUCKETS.clear()
    own = set()
    for w in d.bare:
        b = _BUCKETS.get(w)
        if b is None:
            b = _BUCKETS[w] = _bucket(w)
        own.add(b)
    own.update(_bucket(b"\n%b %d" % (a.encode(), i)) for a, vs in cast.items() for i, x in enumerate(vs) if x == BAD)
    return np.fromiter(own, np.int64, len(own))


def learn_stems(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label_rows: int = LABEL_ROWS) -> Stems:
    """Stems of words that occur in enough toxic documents and hardly in others,
    from at most about ``label_rows`` labelled documents with different texts."""
    marked = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").alias("labelled")).agg(F.max("toxic").alias("toxic"))
    share = min(1.0, label_rows / max(marked.count(), 1))
    own = docs.select(F.col(doc_id).alias("labelled"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("h"))
    own = own.filter(F.pmod("h", F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    sample = cut(own.join(marked, "labelled").dropDuplicates(["h", "toxic"]).select("text", "toxic"))

    def stems_of(d: Seen) -> set[bytes]:
        return {w[:k] for w in d.bare for group in STEMS for k in group if len(w) >= k}

    def in_toxic(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"stem": [s for t in batch["text"] for s in stems_of(look(t))]})

    bad = sample.filter("toxic = 1")
    need = max(4, int(STEM_SHARE * bad.count()))
    seen = bad.select("text").mapInPandas(in_toxic, "stem binary").groupBy("stem").agg(F.count(F.lit(1)).alias("n"))
    # bounded by the sample's words
    often = {bytes(r["stem"]): r["n"] for r in seen.filter(F.col("n") >= need).collect()}
    wanted = frozenset(often)

    def in_others(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [s for t in batch["text"] for s in stems_of(look(t)) & wanted]
            yield pd.DataFrame({"stem": rows})

    clean = sample.filter("toxic = 0").select("text").mapInPandas(in_others, "stem binary").groupBy("stem").count().collect()
    others = {bytes(r["stem"]): r["count"] for r in clean}
    pure = [s for s, n in often.items() if others.get(s, 0) <= STEM_IMPURITY * n]
    return {group: frozenset(s for s in pure if len(s) in group) for group in STEMS}


def cast_votes(docs: DataFrame, stems: Stems, text: str = "text") -> DataFrame:
    """(h, junk, toxic, stems, n): the hash of each different text, its vote patterns, its rows."""

    @F.pandas_udf("struct<junk: string, toxic: string, stems: string>")
    def patterns(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([{a: _code(v) for a, v in votes(look(t), stems).items()} for t in texts], columns=ASPECTS)

    h = F.when(F.col(text).isNotNull(), F.xxhash64(F.col(text))).alias("h")
    cast = docs.select(h, patterns(F.col(text)).alias("p")).groupBy("h", *[F.col(f"p.{a}").alias(a) for a in ASPECTS])
    return staged(cast.agg(F.count(F.lit(1)).alias("n")), "votes")


def label(cast: DataFrame) -> tuple[dict[str, Labelled], list[tuple]]:
    """The weak-label models, from the votes on all documents; and (pattern of each aspect,
    different texts) of all patterns."""
    # votes only, so at most 3 ** 17 rows whatever the input; a few hundred as a rule
    counts = cast.groupBy(*ASPECTS).agg(F.sum("n").alias("n"), F.count("h").alias("texts")).collect()
    found = {}
    for aspect in ASPECTS:
        sums: dict[str, int] = {}
        for r in counts:
            sums[r[aspect]] = sums.get(r[aspect], 0) + r["n"]
        found[aspect] = estimate(sums)
    return found, [(*[r[a] for a in ASPECTS], r["texts"]) for r in counts]


def sampling_rates(found: dict[str, Labelled], patterns: list[tuple], train_rows: int, bad_rows: int = BAD_ROWS) -> list[tuple]:
    """(pattern of each aspect, rate): the same rate for all texts, and a higher one for those
    that an aspect holds for bad while they are few."""
    share = min(1.0, train_rows / max(sum(p[-1] for p in patterns), 1))
    is_bad = [[found[a].posterior[p[k]] >= 0.5 for p in patterns] for k, a in enumerate(ASPECTS)]
    of_bad = [min(1.0, bad_rows / max(sum(p[-1] for p, b in zip(patterns, bad) if b), 1)) for bad in is_bad]
    return [(*p[:-1], max([share, *[r for r, bad in zip(of_bad, is_bad) if bad[i]]])) for i, p in enumerate(patterns)]


@dataclass
class Scorer:
    weights: np.ndarray  # aspects x features
    intercepts: np.ndarray
    stems: Stems

    def probabilities(self, text: str | None) -> np.ndarray:
        d = look(text)
        margin = self.weights[:, features(d, votes(d, self.stems))].sum(axis=1) + self.intercepts
        return 1 / (1 + np.exp(-np.clip(margin, -50, 50)))


def fit_linear(rows: np.ndarray, at: np.ndarray, p: np.ndarray, penalty: float = PENALTY, rounds: int = ROUNDS, counted: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression with an L1 penalty on soft labels ``p``,
    by accelerated proximal gradient with restarts. ``rows`` and ``at`` are the example and the
    feature of each set feature, ``counted`` is how many documents each example stands for."""
    n = len(p)
    share = np.ones(n) if counted is None else counted.astype(float)
    bad = p >= 0.5
    rare = share[bad].sum() < CLASS_SHARE * share.sum()
    if bad.any() and rare:
        share[bad] *= CLASS_SHARE / (1 - CLASS_SHARE) * share[~bad].sum() / share[bad].sum()
    share /= max(share.sum(), 1e-300)
    prior = min(max(float(share @ p), 1e-6), 1 - 1e-6)
    weights, b = np.zeros(FEATURES), math.log(prior / (1 - prior))
    if p.max(initial=0.0) < 0.5:  # nothing to learn
        return weights, b
    used, at = np.unique(at, return_inverse=True)
    m = len(used)
    w, v, c, t = np.zeros(m), np.zeros(m), b, 1.0
    # a step for each feature: the Gram matrix is bounded by its row sums
    length = np.bincount(rows, minlength=n) + 1.0
    step, step_b = 4 / np.bincount(at, (share * length)[rows], m), 4 / (share @ length)
    for _ in range(rounds):
        margin = np.bincount(rows, v[at], n) + c
        off = (1 / (1 + np.exp(-np.clip(margin, -50, 50))) - p) * share
        new = v - step * np.bincount(at, off[rows], m)
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        new_b, new_t = c - step_b * off.sum(), (1 + math.sqrt(1 + 4 * t * t)) / 2
        if ((v - new) / step) @ (new - w) + (c - new_b) / step_b * (new_b - b) > 0:  # the momentum points uphill
            new_t = t = 1.0
        moved = max(float(np.abs(new - w).max(initial=0.0)), abs(new_b - b))
        v, c = new + (t - 1) / new_t * (new - w), new_b + (t - 1) / new_t * (new_b - b)
        w, b, t = new, new_b, new_t
        if moved < 1e-5:
            break
    weights[used] = w
    return weights, float(b)


def train(docs: DataFrame, labels: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text", train_rows: int = TRAIN_ROWS) -> Scorer:
    """Weak labels of all documents; the scorer on those of a bounded sample of different texts
    by text hash, whose features (numbers of hashed words) come to the driver."""
    stems = learn_stems(docs, labels, doc_id, text) if labels is not None else {}
    cast = cast_votes(docs, stems, text)
    found, patterns = label(cast)
    rates = docs.sparkSession.createDataFrame(sampling_rates(found, patterns, train_rows), ", ".join(f"{a} string" for a in ASPECTS) + ", rate double")
    drawn = F.pmod("h", F.lit(1 << 40)) < F.col("rate") * (1 << 40)
    chosen = cast.filter("h IS NOT NULL").join(F.broadcast(rates), ASPECTS).filter(drawn).select("h", "rate").dropDuplicates(["h"])
    texts = docs.filter(F.col(text).isNotNull()).select(F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("h"))
    # at most about train_rows and bad_rows for each aspect
    sample = texts.join(F.broadcast(chosen), "h").select("text", "rate")

    def examples(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = set()
        for batch in batches:
            rows = []
            for t, rate in zip(batch["text"], batch["rate"]):
                h = xxhash.xxh64_intdigest(t.encode()) >> 1
                if h in seen:
                    continue
                seen.add(h)
                d = look(t)
                cast = votes(d, stems)
                at = np.sort(features(d, cast))
                rows.append((h, rate, at.astype("<i4").tobytes(), *[_code(cast[a]) for a in ASPECTS]))
            yield pd.DataFrame(rows, columns=["h", "rate", "at", *ASPECTS])

    schema = "h long, rate double, at binary, " + ", ".join(f"{a} string" for a in ASPECTS)
    got = sorted(sample.mapInPandas(examples, schema).dropDuplicates(["h"]).collect())
    each = [np.frombuffer(r["at"], "<i4") for r in got]
    at = np.concatenate(each or [np.zeros(0, np.int32)]).astype(np.int64)
    rows = np.repeat(np.arange(len(each)), [len(x) for x in each]).astype(np.int64)
    counted = 1 / np.array([r["rate"] for r in got], float)
    weights, intercepts = np.zeros((len(ASPECTS), FEATURES)), np.zeros(len(ASPECTS))
    for k, aspect in enumerate(ASPECTS):
        p = np.array([found[aspect].posterior.get(r[aspect], found[aspect].prior) for r in got], float)
        weights[k], intercepts[k] = fit_linear(rows, at, p, counted=counted)
    return Scorer(weights, intercepts, stems)


def judge(scorer: Scorer, docs: DataFrame, text: Column) -> Column:
    """struct(junk, toxic, stems): probabilities of being bad."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    @F.pandas_udf("struct<junk: double, toxic: double, stems: double>")
    def column(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.probabilities(t) for t in texts], columns=ASPECTS)

    return column(text)


def classify(docs: DataFrame, labels: DataFrame | None = None, threshold: float = THRESHOLD, train_rows: int = TRAIN_ROWS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, p_junk, p_toxic (the larger of both toxic aspects), kept."""
    p = judge(train(docs, labels, doc_id, text, train_rows), docs, F.col(text))
    judged = docs.select(F.col(doc_id), p.alias("p"))
    return judged.select(
        doc_id, F.col("p.junk").alias("p_junk"), F.greatest("p.toxic", "p.stems").alias("p_toxic"), (F.greatest(*[f"p.{a}" for a in ASPECTS]) < threshold).alias("kept")
    )


def keep_good(docs: DataFrame, labels: DataFrame | None = None, threshold: float = THRESHOLD, train_rows: int = TRAIN_ROWS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    p = judge(train(docs, labels, doc_id, text, train_rows), docs, F.col(text))
    return docs.filter(F.greatest(*[p[a] for a in ASPECTS]) < threshold)
