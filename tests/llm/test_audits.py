"""Filter audit and Merkle manifest against brute force, and on awkward rows."""

import math
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256
from itertools import permutations

import pytest

from tallyrow.llm import filteraudit, merkle

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# filter audit


def failing(rows):
    """(part, letters it fails) of (id, lang, text) rows."""
    ids = defaultdict(set)
    for i, _, text in rows:
        ids[text or ""].add(i)
    for i, lang, text in rows:
        text = text or ""
        words = SPACED.findall(text)
        known = [x for x in ids[text] if x is not None]
        copy = bool(known) if i is None else min(known) < i
        tests = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search(r"[#$%&*|]", text)), "E": copy}
        yield i, lang or "", {k for k, v in tests.items() if v}


def audited(rows, marks):
    out, found = [], list(failing(rows))
    for part in {p for _, p, _ in found}:
        own = [(i, f) for i, p, f in found if p == part]
        steps, value = [], Counter()
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, letter in enumerate(order, 1):
                gone, kept = [x for x in left if letter in x[1]], [x for x in left if letter not in x[1]]
                redundant = sum(letter in f for _, f in own) - len(gone)
                lost = [sum(i in marks[k] for i, _ in gone) for k in ("good", "toxic")]
                steps.append((part, order, step, len(kept), len(gone), redundant, sum(f == {letter} for _, f in own), *lost))
                value[letter] += len(gone)
                left = kept
        out += [(*s, value[s[1][s[2] - 1]]) for s in steps]
    return sorted(out, key=repr)


AUDITED = [
    (1, "en", "Short $"), (2, "en", "Short $"), (2, "en", "Short $"), (3, None, "SHOUT"), (4, "", "one two " * 60), (None, "en", "Short $"), (None, "fr", "alone"),
    (5, "de", None), (6, "de", ""), (7, "en", " ".join(f"w{i}" for i in range(120))), (8, "en", " ".join(f"W{i} | %" for i in range(3000))), (-9, "fr", "one two " * 60),
]


def test_audit_brute_force(spark):
    docs = spark.createDataFrame([(*r, 1, 1, "x") for r in AUDITED], "doc_id long, lang string, text string, mask int, n long, digest string")
    labels = spark.createDataFrame([(2, 1, 1), (2, 0, None), (4, 1, 0), (None, 1, 1), (8, None, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    marks = {"good": {2, 4}, "toxic": {2, 8}}
    got = filteraudit.audit(docs, labels)
    assert as_rows(got) == audited(AUDITED, marks)
    assert filteraudit.audit(docs.limit(0), labels.limit(0)).count() == 0


def test_path_counts():
    forward, backward = filteraudit.path_counts(5)
    for state in range(32):
        size = state.bit_count()
        assert (forward[state], backward[state]) == (math.factorial(size), math.factorial(5 - size))
        if 0 < size < 5:  # orders through the states of one size are all orders
            assert sum(forward[s] * backward[s] for s in range(32) if s.bit_count() == size) == 120
    with pytest.raises(ValueError):
        filteraudit.patterns(None, None, dict.fromkeys("abcdefgh"))


# Merkle manifest


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(leaves):
    """Top of the leaves, and for each what stands before and after it, level by level."""
    paths, at, nodes = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = nodes[i // 16 * 16 : i // 16 * 16 + 16]
            paths[k].append(("".join(run[: i % 16]), "".join(run[i % 16 + 1 :])))
        nodes, at = [digest(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)], [i // 16 for i in at]
    return nodes[0], paths


def manifested(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    tops, paths, out = [], {}, []
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        top, paths[name] = tree([leaf(r) for r in groups[name]])
        tops.append(top)
    root, upper = tree(tops)
    for name, top, above in zip(names, tops, upper):
        for r, path in zip(groups[name], paths[name]):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None
            fold, pairs = leaf((*r[:4], r[4].translate(LOWER)) if hit else r), path + above
            for before, after in pairs:
                fold = digest(before, fold, after)
            out.append((r[0], leaf(r), top, root, digest(*[x for p in pairs for x in p]), fold, fold == root))
    return sorted(out, key=repr)


def manifest_of(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, leaf string, place long")
    return merkle.tamper_check(docs)


def test_manifest_brute_force(spark):
    rows = [(i * 7 - 300, f"s{i % 3}" if i % 19 else None, "en", i, f"Text {i} É") for i in range(500)]
    rows += [(i << 40, "far", None, None, None) for i in range(-20, 20)] + [(5, "one", "x", 1, "Alone")] + [(i, f"ü{i}", "d", 2, "UP" * 5) for i in range(40)]
    # repeated rows, other rows of one id, null ids
    rows += [(3, "a", "en", 4, "Same")] * 40 + [(3, "a", "en", 4, f"Other {i}") for i in range(20)] + [(None, "a", None, i, "None") for i in range(30)]
    rows += [(None, None, None, None, None)] * 2 + [(i, "a", "en", 0, "") for i in range(70)] + [(9, "", "en", 1, "LONG " * 50_000)]
    assert as_rows(manifest_of(spark, rows)) == manifested(rows)


def test_manifest_of_little(spark):
    assert as_rows(manifest_of(spark, [(1, "a", "en", 1, "Alone")])) == manifested([(1, "a", "en", 1, "Alone")])
    empty = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string")
    assert merkle.tamper_check(empty).count() == 0


def test_places_count_earlier_ids(spark):
    """Deep directories, ids far apart and below zero."""
    ids = [-(1 << 62), -1, 0, 1, 63, 64, 1 << 20, (1 << 62) + 5, *range(1000, 1300)]
    rows = spark.createDataFrame([(0, i, str(i), n) for n, i in enumerate(ids)], "tree long, id long, leaf string, rid long")
    got = {r.id: r.place for r in merkle.places(rows).collect()}
    assert got == {i: n for n, i in enumerate(sorted(ids))}


def test_heights():
    assert [merkle._heights(n) for n in (1, 2, 16, 17, 256, 257, 4096, 4097)] == [0, 1, 1, 2, 2, 3, 3, 4]


def test_several_stages(spark):
    """A group of more than one block: its top needs two reductions."""
    rows = [(i, "big" if i % 10 else "s", "en", i, f"T{i}") for i in range(5200)]
    assert as_rows(manifest_of(spark, rows)) == manifested(rows)
