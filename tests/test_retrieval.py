"""Pages, chunks, encoders, search and answers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrow.functions import vectors, vocabulary as v
from tallyrow.operators import chunks, encoding, pages, retrieval
from tallyrow.sources import tables

PAGE = """• Aller To go
Présent Passé composé Imparfait Plus-que-parfait
Je vais Je suis allé J'allais J'étais allé
Il/elle va Il/elle est allé Il/elle allait Il/elle était allé

Nous  Nous sommes allés
Futur simple Futur antérieur
Tu iras Tu seras allé Tu iras encore
Que je sois Que tu sois Qu'il/elle soit Sois ! (Tu) Soyons ! (Nous)
"""


def test_page_records(spark, get):
    df = spark.createDataFrame([(1, PAGE), (2, "Contents\nJe vais"), (3, "")], "page int, text string")
    got = get(pages.conjugation_records(df), "tense", "pronoun", "form")
    want = [
        ("présent", "Je", "vais"), ("passé composé", "Je", "suis allé"), ("imparfait", "J'", "allais"), ("plus-que-parfait", "J'", "étais allé"),
        ("présent", "Il/elle", "va"), ("passé composé", "Il/elle", "est allé"), ("imparfait", "Il/elle", "allait"), ("plus-que-parfait", "Il/elle", "était allé"),
        ("passé composé", "Nous", "sommes allés"),  # the empty form used up the first tense
        ("futur simple", "Tu", "iras"), ("futur antérieur", "Tu", "seras allé"),  # a third pair has no tense
        ("subjonctif présent", "Que je", "sois"), ("subjonctif présent", "Que tu", "sois"), ("subjonctif présent", "Qu'il/elle", "soit"),
        ("impératif présent", "Tu", "Sois"), ("impératif présent", "Nous", "Soyons"),
    ]
    assert got == sorted(want, key=repr)
    assert get(pages.page_headings(df)) == [(1, "Aller", "go")]
    summary = get(pages.parse_summary(pages.conjugation_records(df)))
    assert (1, "Aller", 16) in summary and (None, "1", 16) in summary


def test_three_ways_of_collecting_records_agree(spark, get):
    df = spark.createDataFrame([(1, PAGE)], "page int, text string")
    lines = pages.conjugation_lines(df)
    parts = pages.grid_records(lines).unionByName(pages.subjunctive_records(lines)).unionByName(pages.imperative_records(lines))
    assert get(parts) == get(pages.conjugation_records(df))


@pytest.mark.parametrize("heading, verb", [("• Se laver To wash", None), ("• Laver (se) To wash", "Laver (se)"), ("• S'asseoir To sit", "S'asseoir"), ("•Être  To be", "Être")])
def test_headings(spark, heading, verb):
    df = spark.createDataFrame([(1, "x\n" + heading + "\ny")], "page int, text string")
    got = [r["verb"] for r in pages.page_headings(df).collect()]
    assert got == ([verb] if verb else [])


def test_carry_forward(spark, get):
    df = spark.createDataFrame([(1, ["a", "H1", "b", "c", "H2", "H3", "d"]), (2, []), (3, ["x"])], "k int, lines array<string>")
    got = pages.carry_forward(df, "k", F.col("lines"), lambda line, i: line.startswith("H"))
    assert get(got, "k", "pos", "header", "line") == sorted(
        [(1, 0, None, "a"), (1, 2, "H1", "b"), (1, 3, "H1", "c"), (1, 6, "H3", "d"), (3, 0, None, "x")], key=repr
    )


RECORDS = [
    ("Être", "to be", "présent", "Vous", "êtes", 3, 0), ("Être", "to be", "présent", "Je", "suis", 3, 1),
    ("Être", "to be", "présent", "On", "est", 3, 2), ("Être", "other", "présent", "Je", "suis!", 4, 3),
    ("Avoir", "to have", "passé composé", "J'", "ai eu", 9, 0),
]
SCHEMA = "verb string, meaning string, tense string, pronoun string, form string, page int, pos bigint"


def test_chunks(spark, tmp_path):
    built = chunks.build_chunks(spark.createDataFrame(RECORDS, SCHEMA))
    got = {r["id"]: r for r in built.collect()}
    assert got["être_présent"]["text"] == "Verb: Être (to be)\nTense: présent\nJe: suis\nJe: suis!\nVous: êtes\nOn: est"
    assert got["être_présent"]["metadata"].asDict() == {
        "verb": "Être", "verb_lower": "être", "meaning": "to be", "tense": "présent", "page": 3, "num_forms": 4,
    }
    assert "avoir_passé_composé" in got
    assert tuple(chunks.chunk_statistics(built).first()) == (2, 2, 2)
    tables.write_chunks(built, str(tmp_path / "chunks"))
    back = tables.read_chunks(spark, str(tmp_path / "chunks"))
    assert sorted(map(repr, back.collect())) == sorted(map(repr, built.collect()))


def test_grid_with_unbreakable_spaces(spark):
    """White space is Unicode white space, inside forms and between pairs."""
    text = "• Être To be\nPrésent Passé composé Imparfait Plus-que-parfait\nJe suis\u00a0allé\u00a0vite Tu\u00a0es venu"
    pages_ = spark.createDataFrame([(1, text), (2, text.replace("\u00a0", " "))], "page bigint, text string")
    got = {}
    for r in pages.grid_records(pages.conjugation_lines(pages_)).collect():
        got.setdefault(r["page"], []).append((r["tense"], r["pronoun"], r["form"].replace("\u00a0", " ")))
    assert sorted(got[1]) == sorted(got[2]) and got[1]


def test_a_large_group_is_one_chunk(spark):
    """A third of all rows in one group: gathered in pieces, it is still one row with one id."""
    rows = RECORDS + [("Hot", "to run", "présent", v.PRONOUN_ORDER[i % 13] if i % 5 else "On", f"f{i}", 1, 7 * i) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    whole = sorted(map(repr, chunks.build_chunks(df).collect()))
    for pieces in (1, 40, 1_000):
        assert sorted(map(repr, chunks.build_chunks(df, forms_per_piece=pieces).collect())) == whole
    hot = chunks.build_chunks(df, forms_per_piece=40).filter("id = 'hot_présent'").collect()
    assert len(hot) == 1 and hot[0]["metadata"]["num_forms"] == 300 and hot[0]["text"].count("\n") == 301
    assert tuple(chunks.chunk_statistics(chunks.build_chunks(df, forms_per_piece=40)).first()) == (3, 3, 2)


def test_encoders(spark):
    df = spark.createDataFrame([(i, f"text number w{i % 3}") for i in range(50)] + [(99, None)], "id bigint, text string")
    hashed = {r["id"]: np.array(r["embedding"]) for r in encoding.encode_hashed(df, "id", dimensions=64).collect()}
    assert len(hashed) == 51 and all(abs(np.linalg.norm(x) - 1) < 1e-6 for x in hashed.values())
    assert np.allclose(hashed[0], hashed[3]) and not np.allclose(hashed[0], hashed[1])

    def encoder(texts):
        assert len(texts) <= 16 and all(t.startswith("query: ") for t in texts)
        return np.array([[len(t), 1.0] for t in texts])

    got = {r["id"]: r["embedding"] for r in encoding.encode_batches(df, "id", encoder, prefix=v.QUERY_PREFIX).collect()}
    assert len(got) == 51 and all(abs(np.linalg.norm(x) - 1) < 1e-6 for x in got.values())


def test_l2_normalize(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "a array<float>")
    assert [r[0] for r in df.select(vectors.l2_normalize(F.col("a"))).collect()] == [[0.6, 0.8], [0.0, 0.0]]


def vector_tables(spark, n=400, dim=16, copies=True):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(n, dim))
    if copies:
        x[n // 3 : 2 * n // 3] = x[0]  # a third of all vectors are one and the same
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x = x.astype(np.float32)
    rows = [(i, [float(y) for y in x[i]], f"v{i % 3}", f"t{i % 4}") for i in range(n)]
    c = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, verb_lower string, tense string").repartition(5)
    filters = [(None, None), ("v1", None), (None, "t2"), ("v2", "t3"), ("none", None)]
    q = [(i, rows[i][1], *filters[i % 5]) for i in range(0, 50)]
    return spark.createDataFrame(q, "query_id bigint, embedding array<float>, verb string, tense string"), c, x.astype(np.float64), rows, q


@pytest.mark.parametrize("block", [8_192, 7])
def test_topk_equals_brute_force(spark, block):
    q, c, x, rows, asked = vector_tables(spark)
    got = {}
    for r in retrieval.knn_topk(q, c, 5, exclude_self=True, block=block).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    for qid, _, verb, tense in asked:
        s = np.round(x @ x[qid], 9)
        ok = [i for i, r in enumerate(rows) if i != qid and verb in (None, r[2]) and tense in (None, r[3])]
        want = sorted(ok, key=lambda i: (-s[i], i))[:5]
        assert got.get(qid, []) == want


def test_products_in_single_precision_lose_no_neighbour(monkeypatch):
    """Neighbours that differ less than single precision tells apart, NaN, large and tiny vectors."""
    monkeypatch.setattr(retrieval, "TILE", (5, 7))
    monkeypatch.setattr(retrieval, "FIRST", 4)
    rng = np.random.default_rng(5)
    held = rng.normal(size=(60, 8))
    held[20:50] = held[0] * (1 + 1e-8 * rng.normal(size=(30, 1)))
    held[55], held[56, 2] = np.nan, np.inf
    asked = np.concatenate([held[:20], np.full((1, 8), np.nan)])
    for scale in (1.0, 1e3, 1e-9, 1e12):
        x, y = held * scale, asked
        scores = np.round(np.nan_to_num(y @ x.T, nan=-np.inf, posinf=-np.inf, neginf=-np.inf), 9)
        q, i, s = retrieval._nearest_rows(np.arange(21), y, np.arange(60), x, 3, True)
        for n in range(21):
            ok = [m for m in range(60) if m != n and np.isfinite(scores[n, m])]
            want = sorted((-scores[n, m] for m in ok))[:3]
            assert np.allclose(-s[q == n], want, rtol=1e-12, atol=2e-9) and n not in i[q == n]


def test_questions_are_encoded_once(spark):
    """Counting a cell's questions encodes none of them."""
    seen = spark.sparkContext.accumulator(0)

    def encoder(texts):
        seen.add(len(texts))
        return np.ones((len(texts), 4))

    c = spark.createDataFrame([(i, "x", "Go", "go", "présent", 1) for i in range(30)], "vec_id bigint, text string, verb string, verb_lower string, tense string, page int")
    q = spark.createDataFrame([(i, "go now") for i in range(50)], "question_id bigint, question string")
    _, hits = retrieval.retrieve(q, c, lambda df, key, text, prefix: encoding.encode_batches(df, key, encoder, text, prefix), 3)
    assert hits.count() == 150 and seen.value == 80


def test_topk_with_few_vectors(spark):
    q, c, *_ = vector_tables(spark, 60)
    assert retrieval.knn_topk(q.filter("query_id = 0"), c.limit(3), 5, filtered=False).count() == 3
    assert retrieval.knn_topk(q.filter("query_id < 0"), c, 5).count() == 0


def test_approximate_search_finds_most(spark):
    q, c, *_ = vector_tables(spark, 400, copies=False)
    exact = retrieval.knn_topk(q, c, 3, filtered=False).select("query_id", "vec_id")
    near = retrieval.knn_approx(q, c, 3, lists=16, probes=10).select("query_id", "vec_id")
    pairs = retrieval.scored_pairs(q, c, lists=16, probes=10).first()
    assert pairs["approximate"] < 0.8 * pairs["exact"] and pairs["exact"] == q.count() * c.count()
    every = retrieval.knn_approx(q, c, 3, lists=16, probes=16).select("query_id", "vec_id")
    assert sorted(every.collect()) == sorted(exact.collect())
    assert exact.intersect(near).count() >= 0.8 * exact.count()
    scores = near.join(retrieval.knn_topk(q, c, 400, filtered=False), ["query_id", "vec_id"])
    assert scores.count() == near.count()  # every candidate is a real pair


def test_metadata_filter_counts(spark):
    q, c, _, rows, asked = vector_tables(spark, 60)
    got = {r["query_id"]: r["matches"] for r in retrieval.metadata_filter(q, c, "query_id").collect()}
    for qid, _, verb, tense in asked:
        assert got[qid] == sum(verb in (None, r[2]) and tense in (None, r[3]) for r in rows)


@pytest.mark.parametrize(
    "question, verb",
    [
        ("Conjugate ALLER now", "aller"), ("conjugate raller", None), ("être, please", "être"), ("ÊTRE?", "être"), ("l'être", "être"),
        ("s'en aller today", "s'en aller"), ("avoir et aller", "aller"), ("s'asseoir!", "s'asseoir"), ("a.b (x) c", None), ("", None),
        ("aller_x", None), ("laver (se) it", None),
    ],
)
def test_entities_are_whole_words_longest_first(spark, question, verb):
    names = ["aller", "avoir", "être", "s'en aller", "s'asseoir", "a.c"]
    got = retrieval.detect_entity(
        spark.createDataFrame([(1, question)], "question_id int, question string"), spark.createDataFrame([(n,) for n in names], "entity string")
    ).collect()
    assert [r["entity"] for r in got] == ([verb] if verb else [])


def test_every_keyword(spark):
    rows = [(i, f"Show the {k.upper()} forms", t) for i, (k, t) in enumerate(v.TENSE_KEYWORDS)]
    rows += [(50, "a representation", "présent"), (51, "pasta", "passé composé"), (52, "future simple", None), (53, "conditional past", "conditionnel passé")]
    df = spark.createDataFrame(rows, "id int, q string, want string")
    assert [tuple(r) for r in df.select("id", "want", retrieval.detect_tense(F.col("q")).alias("got")).filter("not (want <=> got)").collect()] == []


def test_routes_and_answers(spark):
    chunk_rows = [
        (1, "Verb: Aller (to go)\nTense: présent\nJe: vais\nTu: vas", "Aller", "aller", "présent", 4),
        (2, "Verb: Aller (to go)\nTense: imparfait\nJ': allais", "Aller", "aller", "imparfait", 4),
        (3, "Verb: Être (to be)\nTense: présent\nJe: suis", "Être", "être", "présent", 5),
    ]
    c = spark.createDataFrame(chunk_rows, "vec_id bigint, text string, verb string, verb_lower string, tense string, page int")
    qs = [(1, "Conjugate aller in the present"), (2, "Explain aller"), (3, "bonjour"), (4, "être imparfait")]
    q = spark.createDataFrame(qs, "question_id bigint, question string")
    encode = lambda df, key, text, prefix: encoding.encode_hashed(df, key, text, 64, prefix)
    asked, hits = retrieval.retrieve(q, c, encode, 3)
    got = {r["question_id"]: r for r in retrieval.answer_questions(asked, hits).collect()}
    assert got[1]["route"] == "lookup" and got[1]["answer"] == "(présent)\nJe: vais\nTu: vas" and got[1]["sources"] == "Aller (présent), p.4"
    assert got[2]["route"] == "explain" and got[2]["answer"] is None and got[2]["context"].count("\n\n---\n\n") == 1
    assert got[3]["route"] == "explain" and got[3]["context"].count("\n\n---\n\n") == 2
    assert got[4]["route"] == "explain" and got[4]["sources"] == ""  # nothing passes both filters


def test_accuracy_counts_empty_results_as_wrong(spark):
    expected = spark.createDataFrame([(1, "aller", "présent"), (2, "être", "présent"), (3, "voir", "présent")], "id int, expected_verb string, expected_tense string")
    top = spark.createDataFrame([(1, "aller", "présent"), (2, "être", "imparfait")], "id int, verb_lower string, tense string")
    j = retrieval.judged(expected, top, "id")
    assert tuple(retrieval.retrieval_accuracy(j).first()) == (3, 1, 33.333333)
    assert sorted(r["id"] for r in retrieval.retrieval_failures(j).collect()) == [2, 3]


def test_search_by_codes(spark):
    """Recall against all products, self excluded, small tables and blocks, odd dimensions."""
    rng = np.random.default_rng(3)
    for n, d, block in ((3000, 32, 700), (40, 7, 8192)):
        x = rng.normal(size=(n, d))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id bigint, embedding array<double>")
        asked = df.filter("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
        got = retrieval.knn_quantised(asked, df, 5, depth=60, exclude_self=True, block=block).collect()
        hits = {}
        for r in got:
            hits.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
            assert abs(r["score"] - x[r["query_id"]] @ x[r["vec_id"]]) < 1e-8
        found = 0
        for i in range(0, n, 50):
            scores = x @ x[i]
            scores[i] = -np.inf
            assert sorted(h for h, _ in hits[i]) == [1, 2, 3, 4, 5]
            found += len(set(np.argsort(-scores)[:5]) & {v for _, v in hits[i]})
        assert found >= 0.9 * 5 * len(range(0, n, 50))
