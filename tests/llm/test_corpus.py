"""The corpus operators against brute force, and on awkward rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from oracle import compare, connect, rows_of
from pyspark.sql import functions as F

from tallyrow.llm import backoff, common, decontaminate, exactdedup, linededup, mixing, quality, queries, sharding, simhash, tokenstore, urltree

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_against_sql(spark, sf, name):
    assert compare(spark, connect(sf), sf, queries.QUERIES[name], queries.ORACLES[name]) is None


def test_every_operator_has_a_query():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, len(queries.QUERIES) + 1)]


def as_list(df):
    return [tuple(r) for r in df.select("doc_id", "text", "source").collect()]


# 1


def hit_words(text, grams):
    words = WORD.findall((text or "").translate(LOWER))
    hit, items = set(), set()
    for length in {len(g) for g in grams}:
        for i in range(len(words) - length + 1):
            if found := grams.get(tuple(words[i : i + length])):
                hit |= set(range(i, i + length))
                items |= found
    return len(words), hit, items


def gram_dict(items, window=10):
    grams = defaultdict(set)
    for item, text in items:
        w = WORD.findall((text or "").translate(LOWER))
        for i in range(max(1, len(w) - window + 1) if w else 0):
            grams[tuple(w[i : i + window])].add(item)
    return grams


def test_decontamination_brute_force(spark, messy):
    items = [(1, "one TWO three"), (2, "alpha beta gamma " * 5), (3, None), (4, "..."), (10, "É"), (2, "x"), (None, "f")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    grams = gram_dict(items)
    got = sorted((tuple(r) for r in decontaminate.report(messy, bench).collect()), key=repr)
    expected = []
    for doc_id, text, _ in as_list(messy):
        n, hit, found = hit_words(text, grams)
        names = ",".join(sorted(str(i) for i in found if i is not None))
        expected.append((doc_id, n, len(hit), len([i for i in found if i is not None]), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    assert got == sorted(expected, key=repr)


def test_decontamination_output(spark, messy, frame):
    bench = spark.createDataFrame([(1, "two three")], "item_id long, text string")
    kept = decontaminate.decontaminate(messy, bench)
    assert kept.columns == messy.columns
    assert kept.count() == messy.count() - 4
    spans = decontaminate.decontaminate(frame([(1, "Say: one, TWO three; four!"), (2, "four")]), bench, mode="spans")
    assert sorted(as_list(spans)) == [(1, "Say: one, four!", "a"), (2, "four", "a")]
    with pytest.raises(ValueError):
        decontaminate.decontaminate(messy, bench, mode="lines")


def test_decontamination_beyond_the_broadcast(spark, documents, sf, monkeypatch):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    usual = sorted(tuple(r) for r in decontaminate.report(documents, bench).collect())
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    assert sorted(tuple(r) for r in decontaminate.report(documents, bench).collect()) == usual


# 2


def jump_one(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def check_shards(docs, rows):
    key = lambda i: int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:15], 16)
    texts = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in as_list(docs)]
    assert Counter(texts) == Counter((r.doc_id, r.size, r.text_crc32) for r in rows)
    slots = defaultdict(list)
    for r in rows:
        assert r.law == "key" and r.shard == jump_one(key(r.doc_id), 16) and r.grown_shard == jump_one(key(r.doc_id), 17)
        assert r.grown_shard in (r.shard, 16)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding(messy, documents, frame):
    check_shards(messy, sharding.assign(messy).collect())
    check_shards(documents, sharding.assign(documents).collect())
    hot = frame([(5, "same")] * 300 + [(i, str(i)) for i in range(50)])
    check_shards(hot, sharding.assign(hot).collect())
    assert sharding.with_shard(messy).columns == [*messy.columns, "shard"]
    with pytest.raises(ValueError):
        sharding.with_shard(sharding.with_shard(messy))


@pytest.mark.parametrize("name", ["shard", "Shard"])
def test_shard_stage_keeps_a_column_of_that_name(spark, messy, name):
    import corpus_pipeline

    own = messy.withColumn(name, F.lit("mine"))
    rows = corpus_pipeline.shard(spark, own, "")
    assert rows.columns == [*own.columns, "_shard"]
    assert {(r[name], 0 <= r["_shard"] < 16) for r in rows.collect()} == {("mine", True)}


def test_running_total_is_the_same_for_all_bucket_sizes(frame):
    rows = frame([(i, f"t{i * 7919 % 101}", "ab"[i % 2]) for i in range(100)]).withColumn("key", F.md5("text"))
    expected = {}
    for source in "ab":
        total = 0
        for key, doc_id in sorted((r.key, r.doc_id) for r in rows.collect() if r.source == source):
            expected[doc_id] = total
            total += doc_id
    for digits in (1, 2, 3):
        got = common.running_before(rows, ["source"], "key", F.col("doc_id"), digits, "before").collect()
        assert {r.doc_id: r.before for r in got} == expected


# 3


def test_url_parts(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.É.org:80", "x://h?q", "x://H/p/q?z#f", "x://h#f/p", "a://b://c/d"]
    host, path = urltree.host_and_path(F.col("url"))
    df = spark.createDataFrame([(u,) for u in urls], "url string").select(host, path)
    assert [tuple(r) for r in df.collect()] == [
        ("", ""), ("", ""), ("", ""), ("", ""), ("a.É.org:80", ""), ("h", ""), ("h", "/p/q"), ("h", ""), ("b:", "//c/d")
    ]


def test_url_rules(spark):
    cases = {
        ("org", "/"): ("org/", "allow"), ("a.org", ""): (None, None), ("example.org", "/es/1"): ("example.org/es/", "block"),
        ("m.example.org", "/en/17"): ("example.org/en/1", "block"), ("myexample.org", "/en/17"): ("org/", "allow"),
        ("x.com", "/fr/2"): ("com/fr/", "allow"), ("x.com", "/de/"): ("com/de/", "block"), ("x.net", "/de/"): (None, None),
    }
    rule, verdict = urltree.rule_of(F.col("h"), F.col("p"), urltree.RULES)
    df = spark.createDataFrame(list(cases), "h string, p string").select("h", "p", rule, verdict)
    assert {(r[0], r[1]): (r[2], r[3]) for r in df.collect()} == cases


def test_url_tree_blocks_what_is_labelled_bad(spark):
    urls = [(i, f"http://h.net/{'spam' if i % 3 == 0 else 'news' if i % 3 == 1 else 'blog'}/x/{i}") for i in range(90)]
    urls += [(900, None), (900, None), (901, "http://h.net"), (902, "http://other.net/" + "/".join("abcdefghijkl")), (903, "http://other.net/" + "x/" * 3000)]
    pages = spark.createDataFrame(urls, "page_id long, url string").withColumn("host", F.lit("z"))
    labels = spark.createDataFrame([(i, int(i % 3 != 0), None) for i in range(60)] + [(None, 0, 1), (0, 0, 0)], "doc_id long, quality int, toxic int")
    rows = urltree.judge(pages, labels).collect()
    assert len(rows) == len(urls)
    by = {r.page_id: r for r in rows}
    assert {by[i].template for i in range(0, 90, 3)} == {"/spam/~/~"}
    assert all((by[i].verdict == "block") == (i % 3 == 0) for i in range(90))
    assert by[900].host == by[900].path == "" and by[902].template == "/~" * 12 and by[903].template == "/~" * 3000
    kept = urltree.allowed(pages, labels)
    assert kept.columns == pages.columns and kept.count() == len(urls) - 30
    assert urltree.judge(pages.limit(0), labels.limit(0)).count() == 0


def test_url_tree_small_bad_section(spark, tmp_path):
    """A section of 3 % of a host's pages, all bad, is blocked, and nothing else; two bad sections
    are one branch; ten segments, very long urls and the SQL agree."""
    import duckdb

    urls = [(i, f"http://h.net/{'casino' if i % 100 < 2 else 'poker' if i % 100 == 2 else f's{i % 60}'}/a{i % 3}/{i}") for i in range(4000)]
    urls += [(5000 + i, f"http://deep.net/a/b/c/d/e/f/g/h/{'bad' if i % 4 == 0 else 'good'}/{5000 + i}") for i in range(120)]
    urls += [(9001, "http://long.net/" + "y" * 100_000), (9002, "http://h.net//"), (9003, "")]
    marks = [(i, int(i % 100 > 2), 0) for i in range(4000)] + [(5000 + i, int(i % 4 != 0), 0) for i in range(120)]
    con = duckdb.connect()
    for name, rows, schema in (("pages", urls, "page_id long, url string"), ("labels", marks, "doc_id long, quality int, toxic int")):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / name))
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path / name}/*.parquet'")
    judged = urltree.judge(spark.read.parquet(str(tmp_path / "pages")), spark.read.parquet(str(tmp_path / "labels")))
    got = judged.collect()
    rows = {r.page_id: r for r in got}
    assert all((rows[i].verdict == "block") == (i % 100 <= 2) for i in range(4000))
    assert {rows[i].template.split("/")[1] for i in range(4000) if i % 100 <= 2} == {"~casino"}
    assert all((rows[5000 + i].verdict == "block") == (i % 4 == 0) for i in range(120)) and rows[5000].template == "/~" * 8 + "/bad/~"
    assert rows[9001].template == "/~"
    theirs = con.execute(urltree.ORACLE)
    assert rows_of(judged.columns, got) == rows_of([d[0] for d in theirs.description], theirs.fetchall())


# 4


def deleted_by_force(docs, min_words):
    """Lines inside a run with enough words that equals an earlier run."""
    seqs = {}
    for doc_id, text, _ in docs:
        seqs[doc_id] = [(i, " ".join(x.translate(LOWER).split())) for i, x in enumerate((text or "").split("\n")) if x.split()]
    out = {}
    for b in sorted(seqs):
        gone = set()
        for a in sorted(seqs):
            if a >= b:
                continue
            for i in range(len(seqs[a])):
                for j in range(len(seqs[b])):
                    k = 0
                    while i + k < len(seqs[a]) and j + k < len(seqs[b]) and seqs[a][i + k][1] == seqs[b][j + k][1]:
                        k += 1
                    if sum(len(x.split()) for _, x in seqs[b][j : j + k]) >= min_words:
                        gone |= {n for n, _ in seqs[b][j : j + k]}
        out[b] = gone
    return out


def test_line_dedup_brute_force(frame):
    rng = np.random.default_rng(3)
    pool = [" ".join(f"w{x}" for x in rng.integers(0, 50, n)) for n in rng.integers(1, 9, 40)]
    texts = []
    for i in range(40):
        lines = [str(x) for x in rng.choice(pool[:6], 3)] + [f"own {i} {k}" for k in range(4)]
        start = int(rng.integers(0, 30))
        cut = pool[start : start + int(rng.integers(1, 9))]
        at = int(rng.integers(0, len(lines)))
        texts.append((i, "\n".join([*lines[:at], *cut, "", *lines[at:]]), "a"))
    docs = frame(texts)
    expected = deleted_by_force(texts, 12)
    rows = {r.doc_id: r for r in linededup.dedup_lines(docs, 12, counts=True).collect()}
    for doc_id, text, _ in texts:
        left = [x for n, x in enumerate(text.split("\n")) if n not in expected[doc_id]]
        assert rows[doc_id].text == "\n".join(left)
        assert rows[doc_id].n_deleted == len(expected[doc_id])
    assert sum(map(len, expected.values())) > 30


def test_line_dedup_awkward(messy, frame):
    done = linededup.dedup_lines(messy)
    assert done.columns == messy.columns and done.count() == messy.count()
    texts = {(r.doc_id, r.text) for r in done.filter("doc_id in (1, 5, 6)").collect()}
    assert (1, None) in texts and (1, "") in texts
    first = next(t for i, t in texts if i == 5)
    assert first.count("\n") == 17  # 17 lines of 3 words are the first window, and the empty line after the last line end
    assert (6, "") in texts
    passage = "word " * 51
    got = linededup.report(frame([(1, f"a\n{passage}\nb"), (2, f"{passage.upper()}\nc"), (3, "c")])).collect()
    assert {r.doc_id: r.n_deleted for r in got} == {1: 0, 2: 1, 3: 0}


# 5


def targets_by_force(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = float(sum(sizes.values())), [s for s in names if sizes[s]], {s: 0.0 for s in names}
    while open_:
        total = sum(weight[s] for s in open_)
        above = [s for s in open_ if left * weight[s] / total > most * sizes[s]]
        if not above:
            out |= {s: left * weight[s] / total for s in open_}
            break
        for s in above:
            out[s] = most * sizes[s]
        left -= sum(out[s] for s in above)
        open_ = [s for s in open_ if s not in above]
    return out


def check_mix(docs, rows):
    size = lambda t: len(SPACED.findall(t or ""))
    texts = as_list(docs)
    sizes = defaultdict(int)
    for _, t, s in texts:
        sizes[s] += size(t)
    goal = targets_by_force(sizes)
    assert Counter((i, size(t), sizes[s], round(goal[s], 6)) for i, t, s in texts) == Counter((r.doc_id, r.size, r.source_size, round(r.target, 6)) for r in rows)
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    taken = Counter()
    for r in rows:
        taken[r.target, r.source_size] += r.taken
    for (target, source_size), n in taken.items():
        same = sum(1 for s in goal if math.isclose(goal[s], target) and sizes[s] == source_size)
        assert abs(n - same * target) <= same


def test_mixing(messy, documents, frame):
    check_mix(messy, mixing.shares(messy).collect())
    check_mix(documents, mixing.shares(documents).collect())
    hot = frame([(5, "same old words", "big")] * 200 + [(i, "z " * i, f"s{i % 7}") for i in range(60)])
    check_mix(hot, mixing.shares(hot).collect())
    again = sorted(map(str, mixing.shares(hot.repartition(5)).collect()))
    assert again == sorted(map(str, mixing.shares(hot).collect()))


def test_schedule_is_inverted(spark):
    rates = ((1.0, 3.0, 0.0, 2.0), (0.5, 1.5))
    df = spark.range(0, 101).withColumn("u", F.col("id") / 100)
    for place in (0, 1):
        xs = [r[0] for r in df.orderBy("id").select(mixing.position(F.col("u"), F.lit(place), rates)).collect()]
        knots = np.linspace(0, 1, len(rates[place]))
        grid = np.linspace(0, 1, 20001)
        speed = np.interp(grid, knots, rates[place])
        area = np.concatenate([[0], np.cumsum((speed[1:] + speed[:-1]) / 2)])
        assert np.allclose(np.interp(xs, grid, area / area[-1]), np.arange(101) / 100, atol=1e-3)


def test_mixed_rows_follow_the_curriculum(documents, messy):
    rows = mixing.mix(documents, with_position=True).collect()
    at = [r.position for r in rows]
    assert at == sorted(at) and min(at) >= 0 and max(at) <= 1
    uses = Counter(r.doc_id for r in rows)
    assert max(uses.values()) <= 3
    assert mixing.mix(messy).columns == messy.columns
    goal = {r.source: r.target for r in mixing.plan(documents).select("source", "target").distinct().collect()}
    words, longest = Counter(), Counter()
    for r in rows:
        n = len(SPACED.findall(r.text))
        words[r.source] += n
        longest[r.source] = max(longest[r.source], n)
    assert all(abs(words[s] - goal[s]) <= max(longest[s], 20_000) for s in goal)


# 6


def slow_print(text):
    words = SPACED.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, bits=3):
    """Smallest id of each row's component, from {row: (id, print)}."""
    values = sorted({p for _, p in prints})
    parent = {p: p for p in values}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= bits:
                parent[root(a)] = root(b)
    low = {}
    for doc_id, p in prints:
        if doc_id is not None:
            low[root(p)] = min(doc_id, low.get(root(p), doc_id))
    return [(doc_id, f"{p:016x}", low.get(root(p))) for doc_id, p in prints]


def test_simhash(messy, documents):
    for docs in (messy, documents):
        expected = slow_components([(i, slow_print(t)) for i, t, _ in as_list(docs)])
        got = [tuple(r) for r in simhash.near_duplicates(docs).collect()]
        assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_vantage_point_tree_finds_every_link(spark):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    near = [c ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, k, replace=False))) for c in centres for k in (1, 2, 3)]
    dense = [centres[0] ^ np.uint64(x) for x in range(256)]
    values = np.unique(np.concatenate([centres, np.array(near, np.uint64), np.array(dense, np.uint64)]))
    prints = spark.createDataFrame([(int(x),) for x in values.view(np.int64)], "fp long")
    expected = {p: r for p, (_, _, r) in zip(values, slow_components([(int(p), int(p)) for p in values]))}
    for sizes in ({}, {"homes": 32, "queries": 64}, {"homes": 8, "queries": 16, "sample": 200}):
        rows = simhash.group_roots(prints, 3, **sizes).collect()
        groups = defaultdict(set)
        for r in rows:
            groups[r.root].add(expected[np.uint64(r.fp % (1 << 64))])
        assert len(rows) == len(values) and all(len(g) == 1 for g in groups.values())
        assert len(groups) == len(set(expected.values()))


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 200), (200, 100), (7, 7)], "u long, v long")
    rows = {r.node: r.root for r in simhash.components(edges).collect()}
    assert rows == {i: 0 for i in range(1, 61)} | {200: 100}


def test_one_of_each_group_stays(messy, documents):
    for docs in (messy, documents):
        groups = simhash.near_duplicates(docs).select("component_id").distinct().count()
        kept = simhash.keep_one(docs)
        assert kept.columns == docs.columns and kept.count() == groups
    assert sorted(r.doc_id for r in simhash.keep_one(messy).collect()) == [-8, 1, 3, 4, 5, 7, 9]


# 7


def test_exact_dedup(messy, frame):
    for docs in (messy, frame([(i % 40, "Hot text") for i in range(2000)] + [(i, f"t{i % 30}") for i in range(100)])):
        by = defaultdict(list)
        for i, t, _ in as_list(docs):
            by[(t or "").translate(LOWER)].append(i)
        rows = exactdedup.resolve(docs, counters=16).collect()
        expected = Counter()
        for t, ids in by.items():
            best = max((i for i in ids if i is not None), default=None)
            for i in ids:
                expected[i, best, len(ids), hashlib.sha256(t.encode()).hexdigest()] += 1
        assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == expected
        kept = [r for r in rows if r.kept]
        assert all(r.doc_id == r.keep_id for r in kept)
        assert Counter(r.text_sha256 for r in kept) == Counter(hashlib.sha256(t.encode()).hexdigest() for t in by)


# 8


def test_em_finds_the_accuracies():
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.2
    hit, false = np.array([0.9, 0.7, 0.8, 0.4]), np.array([0.02, 0.05, 0.1, 0.01])
    fired = rng.random((20_000, 4)) < np.where(truth[:, None], hit, false)
    silent = rng.random((20_000, 4)) < 0.1
    patterns = Counter(quality._code(tuple(np.where(s, quality.NONE, f).tolist())) for f, s in zip(fired.astype(int), silent))
    found = quality.estimate(dict(patterns))
    assert abs(found.prior - 0.2) < 0.03
    assert np.allclose(found.hit, hit, atol=0.05) and np.allclose(found.false, false, atol=0.03)


def test_quality_on_labelled_rows(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.classify(docs, labels).join(labels, "doc_id").collect()
    clean = [r for r in rows if r.quality == 1 and r.toxic == 0]
    junk = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in clean) >= 0.99 * len(clean)
    assert sum(not r.kept for r in junk) >= 0.95 * len(junk)
    assert sum(not r.kept for r in rows if r.toxic == 1) >= 0.6 * sum(r.toxic == 1 for r in rows)


def test_quality_awkward(messy):
    kept = quality.keep_good(messy)
    assert kept.columns == messy.columns and kept.count() <= messy.count()
    assert quality.classify(messy).count() == messy.count()


def test_scorer_learns_from_different_texts(spark, frame, monkeypatch):
    """A third of the rows without text and a third with one text that the sample takes."""
    own = frame([(i, f"the report number {i} is about {i * 7919 % 101} things" + " \U0001f600!! ## $$" * (i % 10 == 0), "a") for i in range(1000)])
    hot = own.orderBy(F.pmod(F.xxhash64("text"), F.lit(1 << 20))).first().text
    docs = own.union(frame([(i, None, "a") for i in range(1000)] + [(i, hot, "a") for i in range(1000)])).repartition(4)
    sizes, fit = [], quality.fit_linear
    monkeypatch.setattr(quality, "fit_linear", lambda rows, at, p, *a, **b: sizes.append(len(p)) or fit(rows, at, p, *a, **b))
    assert quality.classify(docs, train_rows=200).count() == 3000
    assert 100 <= min(sizes) and max(sizes) <= 400


def test_rare_bad_documents_are_rejected(frame):
    """One in five hundred, far fewer than the uniform sample would show."""
    words = "senate report budget river music garden window letter market engine".split()
    rng = np.random.default_rng(6)
    say = lambda: " ".join(rng.choice(words, 12))
    docs = frame([(i, f"{say()} {i} " + ("you stupid worthless moron idiot " if i % 500 == 7 else "") + say(), "a") for i in range(20_000)])
    rows = quality.classify(docs, train_rows=400).collect()
    bad = [r for r in rows if r.doc_id % 500 == 7]
    assert len(bad) == 40 and not any(r.kept for r in bad)
    assert sum(not r.kept for r in rows) <= len(bad) + 20


# 9


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    return path, Tokenizer.from_file(path)


def test_words_encode_as_the_whole_text(messy, documents, monkeypatch):
    path, full = tokenizer()
    enc = tokenstore.WordEncoder(path)
    texts = [t for _, t, _ in as_list(messy)] + [t for _, t, _ in as_list(documents)]
    texts += ["a\x1cb \x85c\u2028d", "ΟΔΟΣ ΟΔΟΣ. İstanbul ẞ e\u0301 A\u030a", "<|startoftext|>x <|endoftext|>", "don't'll 'S x'", "1,234.5% (a)b", "`~!@#$%^&*()_+-=[]{}|;:\",./<>?"]
    for block in (tokenstore.BLOCK_BYTES, 1000):
        monkeypatch.setattr(tokenstore, "BLOCK_BYTES", block)
        for t, ids in zip(texts, enc.encode(pa.array(texts))):
            assert np.frombuffer(ids, enc.dtype).tolist() == full.encode(t or "", add_special_tokens=False).ids, t
    assert list(enc.encode(pa.array([], pa.string()))) == []


def check_store(spark, docs, path):
    name, full = tokenizer()
    tokenstore.write(docs, path, name)
    expected, at = Counter(), 0
    ordered = sorted(as_list(docs), key=lambda r: (r[0] is not None, r[0] or 0))
    lengths = Counter()
    ids_of = {}
    for i, t, _ in ordered:
        ids = [*full.encode(t or "", add_special_tokens=False).ids, 1]
        expected[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        lengths[i] += len(ids)
        ids_of.setdefault(i, []).append(ids)
    rows = tokenstore.read_back(spark, path).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == expected
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert order == [i for i, _, _ in ordered]
    wanted = [i for i in ids_of if i is not None][:40]
    got = defaultdict(list)
    for r in tokenstore.lookup(spark, path, [*wanted, 987654321]).collect():
        got[r.doc_id].append(list(r.ids))
    assert {i: sorted(x) for i, x in got.items()} == {i: sorted(ids_of[i]) for i in wanted}


def test_token_store(spark, messy, documents, tmp_path, monkeypatch):
    check_store(spark, messy, str(tmp_path / "messy"))
    check_store(spark, documents, str(tmp_path / "documents"))
    assert tokenstore.stored(messy.limit(0), tokenizer()[0]).count() == 0


def test_minimal_perfect_hash():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 1000, 30_000):
        keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        built = tokenstore.build_hash(keys)
        assert sorted(tokenstore.slots(keys, *built).tolist()) == list(range(len(keys)))
        assert len(built[0]) <= 0.8 * len(keys) + 64  # bytes a key
    with pytest.raises(ValueError):
        tokenstore.build_hash(np.array([5, 5], np.uint64))


# 10


def is_held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def toks(text):
    return [*SPACED.findall((text or "").translate(LOWER)), "\n"]


def slow_scores(docs, gram_share):
    """Base and model scores by the recursive definition of backoff."""
    train = [toks(t) for i, t, _ in docs if not is_held(i)]
    grams = {n: Counter(tuple(line[k : k + n]) for line in train for k in range(len(line) - n + 1)) for n in (1, 2, 3)}
    total, types = sum(grams[1].values()), len(grams[1])
    once, twice = (sum(c == k for c in grams[1].values()) for k in (1, 2))
    d1 = once / (once + 2 * twice) if once and twice else 0.5
    kept = {n: {g: c for g, c in grams[n].items() if c >= gram_share * total} for n in (2, 3)}
    by = defaultdict(dict)
    for n in (2, 3):
        for g, c in kept[n].items():
            by[g[:-1]][g[-1]] = c

    def prob(h, w):
        if not h:
            return (grams[1][(w,)] - d1) / total if (w,) in grams[1] else (d1 * types / total if total else 1.0)
        if h not in by:
            return prob(h[1:], w)
        n = grams[len(h)][h]
        if w in by[h]:
            return (by[h][w] - 0.5) / n
        return (1 - sum((c - 0.5) / n for c in by[h].values())) / max(1e-12, 1 - sum(prob(h[1:], x) for x in by[h])) * prob(h[1:], w)

    out = []
    for i, t, _ in docs:
        line = toks(t)
        base = sum(math.log10((grams[1][(w,)] + 1) / (total + types + 1)) for w in line)
        score = sum(math.log10(prob(tuple(line[max(0, k - 2) : k]), w)) for k, w in enumerate(line))
        out.append((i, is_held(i), len(line), sum((w,) in grams[1] for w in line), total, round(base, 6), round(score, 6)))
    return out, prob, grams[1]


@pytest.mark.parametrize("share", [1e-9, 2e-3])
def test_backoff_scores(messy, documents, frame, share):
    rng = np.random.default_rng(4)
    small = frame([(i, " ".join(f"w{x}" for x in rng.zipf(1.5, 30) % 40), "a") for i in range(60)] + [(i, t, s) for i, t, s in as_list(messy)][:12])
    expected, prob, words = slow_scores(as_list(small), share)
    for split in (backoff.SPLIT, 7):
        got = backoff.held_out_scores(small, split=split, gram_share=share, block=150).collect()
        assert sorted(((*tuple(r)[:5], round(r.base_score, 6), round(r.score, 6)) for r in got), key=repr) == sorted(expected, key=repr)
    for h in [(), ("w1",), ("w1", "w2"), ("nowhere", "w1")]:
        assert math.isclose(sum(prob(h, w) for (w,) in words) + prob(h, "never seen"), 1, abs_tol=1e-9)


@pytest.mark.parametrize("split, block", [(backoff.SPLIT, backoff.BLOCK), (50, 500)])
def test_ngrams_enter_by_count_at_any_size(messy, frame, split, block):
    """Twice seen is enough, however many other tokens there are; in one block, and in many
    with frequent contexts settled in several places."""
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{x}" for x in rng.zipf(1.5, 30) % 40) + (" rare pair here" if i % 30 == 0 else ""), "a") for i in range(120)]
    rows += [(1000 + i, " ".join(f"only{i}x{k}" for k in range(400)), "a") for i in range(20)] + [(i, t, s) for i, t, s in as_list(messy)][:12]
    small = frame(rows)
    total = sum(len(toks(t)) for i, t, _ in as_list(small) if not is_held(i))
    expected, _, words = slow_scores(as_list(small), backoff.MIN_COUNT / total)
    assert words[("rare",)] >= 2
    got = backoff.held_out_scores(small, split=split, block=block).collect()
    assert sorted(((*tuple(r)[:5], round(r.base_score, 6), round(r.score, 6)) for r in got), key=repr) == sorted(expected, key=repr)


def test_kept_ngrams_grow_with_the_text(spark):
    """Counted on the given tables: ten times the text holds more n-grams, not fewer."""
    kept = []
    for size in ("sf0.001", "sf0.01"):
        docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet").select("text")
        kept.append(backoff.entered(docs.withColumn("doc_id", F.lit(1))).agg(F.sum("arcs")).first()[0])
    assert kept[1] > 3 * kept[0]


def test_counts_of_frequent_words_are_not_sent_with_pairs(frame, monkeypatch):
    """The same scores, whichever words are frequent; a pair with a frequent word costs no count."""
    rng = np.random.default_rng(6)
    small = frame([(i, " ".join(f"w{x}" for x in rng.zipf(1.5, 30) % 40), "a") for i in range(60)])
    expected, _, _ = slow_scores(as_list(small), backoff.MIN_COUNT / 1e9)
    expected, _, _ = slow_scores(as_list(small), backoff.MIN_COUNT / expected[0][4])
    for often in (1, 30, 1 << 16):
        monkeypatch.setattr(backoff, "OFTEN", often)
        setting = backoff._model(small, F.lit(True), "doc_id", "text", 150, 2, None, 50)[2]
        assert len(setting.frequent) == len(setting.times) <= often and (often == 1 or len(setting.frequent))
        got = backoff.held_out_scores(small, block=150).collect()
        assert sorted(((*tuple(r)[:5], round(r.base_score, 6), round(r.score, 6)) for r in got), key=repr) == sorted(expected, key=repr)
    sums = np.array([[1, 3, 1 << 20], [2, 900, 1 << 22], [2, 1 << 33, 1 << 40]])
    assert (backoff._unpack_sums(backoff._pack_sums(sums, 2), 3, 2) == sums).all()


def test_replies_are_dealt_to_their_blocks_once(messy):
    """Blocks, words and pairs lie in buckets by block, so the last round exchanges its own replies only."""
    blocks, replies, _ = backoff._model(messy, F.lit(True), "doc_id", "text", 150, 2, None, backoff.SPLIT)
    plan = backoff._round(blocks, replies, lambda row, heard: None, "block long")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Bucketed: true") >= 3
    assert plan.count("hashpartitioning(block") == 1 and "REPARTITION_BY_NUM" in plan


def test_sums_that_a_block_has_are_not_sent(frame, monkeypatch):
    """One block has all arcs of its contexts, so nothing is added to them; with many blocks, and
    no frequent words, some of a context's arcs lie elsewhere. The scores are the same."""
    monkeypatch.setattr(backoff, "OFTEN", 1)
    rng = np.random.default_rng(7)
    small = frame([(i, " ".join(f"w{x}" for x in rng.zipf(1.5, 30) % 40), "a") for i in range(60)])
    expected, _, _ = slow_scores(as_list(small), backoff.MIN_COUNT / 1e9)
    expected, _, _ = slow_scores(as_list(small), backoff.MIN_COUNT / expected[0][4])
    for block in (backoff.BLOCK, 150):
        replies = backoff._model(small.repartition(1), F.lit(True), "doc_id", "text", block, 2, None, 50)[1]
        added = {n: any(any(r.linked) for r in replies.filter(F.col("level") == n).collect()) for n in (2, 3)}
        assert added == {n: block == 150 for n in (2, 3)}
        got = backoff.held_out_scores(small, block=block, split=50).collect()
        assert sorted(((*tuple(r)[:5], round(r.base_score, 6), round(r.score, 6)) for r in got), key=repr) == sorted(expected, key=repr)


def test_hashes_of_words_do_not_stay(spark, messy):
    before = spark.conf.get(backoff.RELEASE, None)
    blocks, replies, setting = backoff._model(messy, F.lit(True), "doc_id", "text", 150, 2, None, backoff.SPLIT)
    folder = blocks.inputFiles()[0].rsplit("/kind=", 1)[0]
    assert "words" not in blocks.columns and blocks.count()
    assert spark.read.parquet(f"{folder}/kind={backoff._HASHES}").count() == 0
    assert spark.conf.get(backoff.RELEASE, None) == before
    assert len(setting.frequent) == len(setting.sums) and setting.sums.any()
    values = np.array([0, -1, 1, -(1 << 40), 1 << 40])
    assert (backoff._unsigned(backoff._signed(values)) == values).all() and (backoff._signed(values) >= 0).all()


def test_model_beats_the_base_on_held_out_text(documents):
    rows = [r for r in backoff.held_out_scores(documents).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


# all


def test_empty_tables(spark, frame, sf):
    none = frame([])
    bench = spark.createDataFrame([], "item_id long, text string")
    for df in (
        decontaminate.report(none, bench), sharding.assign(none), linededup.report(none), mixing.shares(none), mixing.mix(none),
        simhash.near_duplicates(none), simhash.keep_one(none), exactdedup.resolve(none), quality.classify(none), backoff.held_out_scores(none),
    ):
        assert df.count() == 0
    assert decontaminate.decontaminate(frame([(1, "a")]), bench).count() == 1


def test_pipeline(spark, sf):
    import corpus_pipeline

    assert len(corpus_pipeline.STAGES) == 5
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, sf)
        assert docs.columns == before.columns
        docs = common.cut(docs)
        sizes.append(docs.count())
    rows = corpus_pipeline.run(spark, sf).collect()
    assert len(rows) == sizes[-1]
    grams = gram_dict([tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()])
    assert not any(hit_words(r.text, grams)[1] for r in rows)
    good = {r.doc_id for r in labels.filter("quality = 1 AND toxic = 0").collect()}
    bad = {r.doc_id for r in labels.filter("quality = 0").collect()}
    assert len({r.doc_id for r in rows} & good) > 0.5 * len(good) and len({r.doc_id for r in rows} & bad) <= 0.1 * len(bad)
    assert all(0 <= r.shard < 16 for r in rows)
