"""The n-gram Jaccard join against brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest

from tallyrow.llm import ngramjoin, queries


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_force(rows):
    """Sorted (id, size of its set, smallest id reachable) of (id, text) rows."""
    sets = [shingle_set(t) for _, t in rows]
    holders = defaultdict(set)
    for s in set(sets):
        for x in s:
            holders[x].add(s)
    root = {}

    def reach(start):
        todo, seen = [start], {start}
        while todo:
            s = todo.pop()
            common = defaultdict(int)
            for x in s:
                for o in holders[x]:
                    common[o] += 1
            for o, k in common.items():
                if o not in seen and 100 * k >= 80 * (len(s) + len(o) - k):
                    seen.add(o)
                    todo.append(o)
        return seen

    smallest = defaultdict(list)
    for s in set(sets):
        if s and s not in root:
            for o in reach(s):
                root[o] = s
    for (i, _), s in zip(rows, sets):
        if s and i is not None:
            smallest[root[s]].append(i)
    return sorted(((i, len(s), (min(smallest[root[s]], default=None) if s else i)) for (i, _), s in zip(rows, sets)), key=repr)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**9)}"
    return " ".join(words)


def corpus(seed=3):
    rng = random.Random(seed)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = []
    for length, copies, most in ((40, 40, 2), (120, 60, 4), (300, 12, 9), (1500, 6, 60), (9, 15, 1)):
        base = [f"w{rng.randrange(300)}" for _ in range(length)]
        texts += [edited(rng, base, rng.randint(0, most)) for _ in range(copies)]
        # steps away from the base, each linked with the one before only
        step = base
        for _ in range(8):
            step = edited(rng, step, max(1, most // 2)).split()
            texts.append(" ".join(step))
    texts += [f"{passage} " + " ".join(f"u{rng.randrange(10**9)}" for _ in range(n)) for n in range(0, 60, 2)]
    texts += ["Same text of Seven words  here today"] * 50 + ["same TEXT of seven\twords here today\n"] * 3 + ["one two", "ONE two", "three", "", " \n", None, None]
    texts += [f"copy {n} " + passage * 1 for n in range(25)]
    rng.shuffle(texts)
    return [(i * 3 - 50, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("sizes", [{}, {"block": 300, "bucket": 500, "group": 700, "sketched": 4, "rounds": 2}])
def test_brute_force(spark, sizes):
    rows = corpus() + [(None, "one two"), (None, None), (None, "nobody else says this"), (1, "nobody ELSE says that"), (1, "three"), (7, "three")]
    rows.append((10**12, "long words all the way " * 40_000))
    docs = spark.createDataFrame([(*r, 1, "x", b"y") for r in rows], "doc_id long, text string, n int, node string, toks binary")
    got = ngramjoin.linked(docs.repartition(5), **sizes)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_force(rows)


def test_whole_table(spark, sf, documents):
    got = sorted((tuple(r) for r in queries.QUERIES["op13_ngram_jaccard_join"](spark, sf).collect()), key=repr)
    assert got == brute_force([tuple(r) for r in documents.select("doc_id", "text").collect()])


def test_empty(spark):
    assert ngramjoin.linked(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_filters_lose_no_link():
    """Random pairs at and around the limit: each filter lets every linked pair pass."""
    rng = np.random.default_rng(5)
    for _ in range(3000):
        n = int(rng.integers(1, 200))
        common = int(rng.integers(0, n + 1))
        other = int(rng.integers(0, max(1, n // 3)))
        pool = rng.integers(1, 2**63, n + other, dtype=np.uint64)
        a, b = pool[:n], np.concatenate([pool[:common], pool[n:]])
        if not len(b):
            continue
        linked = 100 * common >= 80 * (n + len(b) - common)
        assert linked == (common >= ngramjoin._overlap(n, len(b)))
        if linked:
            sizes = np.array([n, len(b)])
            sketch = np.array([ngramjoin._sketch(a), ngramjoin._sketch(b)])
            assert ngramjoin._apart(0, np.array([1]), sizes, sizes, sizes, sketch).all() and ngramjoin._apart(np.array([0]), np.array([1]), sizes, sizes, sizes, sketch).all()
            order = np.argsort(rng.permutation(len(pool)))
            first = [np.sort(order[x])[: ngramjoin.prefix_length(len(x))] for x in (np.arange(n), np.r_[np.arange(common), np.arange(n, n + other)])]
            assert len(np.intersect1d(*first)) > 0


def test_packing():
    rng = np.random.default_rng(2)
    for n in (0, 1, 1000):
        values = np.sort(rng.integers(0, 2**64 - 1, n, dtype=np.uint64))
        assert (ngramjoin._sorted_unpack(ngramjoin._sorted_pack(values), n) == values).all()
        assert (ngramjoin._unpack(ngramjoin._pack(values & np.uint64(0xFFFF), 2), n, 2) == (values & np.uint64(0xFFFF))).all()
