"""Posting flags, splits, metrics, TF-IDF and the linear models."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrow.functions import text as tx, vocabulary as v
from tallyrow.operators import evaluation, models, postings, tfidf
from tallyrow.sources import fixtures as fx


def flags(spark, **cells):
    df = spark.createDataFrame([(1, *cells.values())], "job_id bigint, " + ", ".join(f"{k} string" for k in cells))
    return postings.with_flags(df).first()


def test_absent_columns_have_defaults(spark):
    r = flags(spark, title="x")
    assert r["flag_no_salary"] and r["flag_no_company_logo"] and r["flag_no_company_profile"] and r["flag_short_description"]
    assert r["fraud_signal_count"] == 4 and r["description_word_count"] == 0
    assert not flags(spark, description="x")["flag_vague_title_language"]  # no title column


@pytest.mark.parametrize(
    "text, flag",
    [
        ("URGENT!", "flag_urgency_language"), ("Immediately Start", "flag_urgency_language"), ("immediate start", "flag_urgency_language"),
        ("don't wait", "flag_urgency_language"), ("START TODAY.", "flag_urgency_language"),
        ("your SSN", "flag_requests_personal_info"), ("ſocial ſecurity", "flag_requests_personal_info"),
        ("x@GMAIL.com", "flag_off_platform_contact"), ("a+15551234567", "flag_off_platform_contact"), ("a+1-5551234567", "flag_off_platform_contact"),
    ],
)
def test_phrases_hit(spark, text, flag):
    r = flags(spark, description=text)
    assert [f for f in v.FLAGS[3:6] if r[f]] == [flag]


@pytest.mark.parametrize("text", ["urgently", "insurgent", "gmailxcom", "ring +1 5551234567", "bank accounts", "telegrams"])
def test_phrases_need_word_ends(spark, text):
    r = flags(spark, description=text)
    assert not any(r[f] for f in v.FLAGS[3:6])


def test_phone_option(spark):
    df = spark.createDataFrame([(1, "ring +1 5551234567")], "job_id bigint, description string")
    assert postings.with_flags(df, fixed_phone=True).first()["flag_off_platform_contact"]


def test_anchors_cover_every_alternative(spark):
    """Each phrase of a pattern, in any case, passes the substring test before the regex."""
    phrases = {
        "flag_urgency_language": ["urgent", "immediate start", "immediately start", "act now", "apply immediately", "limited spots", "hiring fast", "don't wait", "start today"],
        "flag_requests_personal_info": ["ssn", "social security", "bank account", "routing number", "credit card", "passport number", "date of birth", "wire transfer"],
        "flag_off_platform_contact": ["gmail.com", "yahoo.com", "hotmail.com", "whatsapp", "telegram", "text me at", "call me at"],
    }
    rows = [(i, flag, p if i % 2 else p.upper()) for i, (flag, p) in enumerate((f, p) for f, ps in phrases.items() for p in ps)]
    df = postings.with_flags(spark.createDataFrame(rows, "job_id bigint, flag string, description string"))
    assert all(r[r["flag"]] for r in df.collect())


def test_word_count(spark):
    df = spark.createDataFrame([(" a  b c\n",), ("",), ("  ",), ("x",)], "t string")
    assert [r[0] for r in df.select(tx.word_count(F.col("t"))).collect()] == [3, 0, 0, 1]
    thirty = flags(spark, description=" ".join(["w"] * 30))
    assert not thirty["flag_short_description"] and flags(spark, description=" ".join(["w"] * 29))["flag_short_description"]


def test_keep_first_with_a_hot_key(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("job_id"), (3000 - F.col("id")).alias("pos"))
    kept = postings.keep_first(df, "job_id", "pos")
    assert kept.count() == 2001 and kept.filter("job_id = 0").first()["pos"] == 3


def test_flags_on_a_stream(spark, tmp_path):
    from tallyrow.streaming import dedupe

    df = spark.createDataFrame([(1, "act now"), (2, "calm")], "job_id bigint, description string")
    df.write.parquet(str(tmp_path / "in"))
    stream = dedupe.file_stream(spark, str(tmp_path / "in"), df.schema)
    out = dedupe.run_to_table(postings.with_flags(stream).select("job_id", "flag_urgency_language"), "flags")
    assert sorted(map(tuple, out.collect())) == [(1, True), (2, False)]


def test_dedupe_stream(spark, tmp_path):
    from tallyrow.streaming import dedupe

    df = spark.sql("select id % 7 as key, timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,id) as ts from range(100)")
    df.write.parquet(str(tmp_path / "in"))
    stream = dedupe.file_stream(spark, str(tmp_path / "in"), df.schema)
    out = dedupe.run_to_table(dedupe.dedupe_stream(stream, "key", "ts", "1 hour").select("key"), "keys")
    assert out.count() == 7


def test_unordered_files_lose_nothing_or_are_counted(spark, tmp_path):
    """Four files out of time order, without repeated keys."""
    from tallyrow.session import scratch_path
    from tallyrow.streaming import dedupe

    df = spark.range(230).selectExpr("id AS key", "timestamp_seconds(1700000000 + ((id * 37) % 230) * 600) AS ts")
    df.repartition(4, "key").write.parquet(str(tmp_path / "in"))
    for files in (1, 1000):
        stream = dedupe.file_stream(spark, str(tmp_path / "in"), df.schema, max_files=files)
        assert dedupe.run_to_table(dedupe.dedupe_stream(stream, "key", "ts", None).select("key"), "keys").count() == 230
        target = scratch_path(spark, "late")
        late = dedupe.run_available(dedupe.dedupe_stream(stream, "key", "ts", "1 hour").select("key"), target + "/data", target + "/checkpoint")
        kept = spark.read.parquet(target + "/data").count()
        assert kept + late == 230 and (late > 0) == (files == 1)


def test_late_rows_come_back(spark, tmp_path):
    """Three steps: what is late by the watermark of the steps before comes out as rows, the
    first of each key is kept, keys are forgotten when their span is over, reruns agree."""
    from tallyrow.streaming import dedupe

    steps = [
        [(1, 0), (1, 5), (2, 100), (None, 50), (3, None)],  # watermark of step 2: 100 - 30 = 70
        [(2, 101), (4, 69), (5, 70), (5, 69), (6, 400)],  # of step 3: 370
        [(1, 380), (6, 401), (7, 10), (7, 390), (7, 391)],
    ]
    kept = {(1, 0), (2, 100), (None, 50), (5, 70), (6, 400), (1, 380), (7, 390)}
    late = {(3, None), (4, 69), (5, 69), (7, 10)}
    runs = []
    for run in "ab":
        base = str(tmp_path / run)
        with dedupe.keyed_state(spark):
            for rows in steps:
                made = spark.createDataFrame(rows, "k bigint, t bigint").selectExpr("k AS `the key`", "timestamp_seconds(1700000000 + t * 60)::timestamp_ntz AS _at")
                made.repartition(3).write.mode("append").parquet(base + "/in")
                told = dedupe.dedupe_with_late(dedupe.file_stream(spark, base + "/in", made.schema), "the key", "_at", "30 minutes")
                query = told.writeStream.format("parquet").option("checkpointLocation", base + "/cp").trigger(availableNow=True).start(base + "/out")
                query.awaitTermination()
        state = query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]
        out = spark.read.parquet(base + "/out").selectExpr("`the key` AS k", "(unix_seconds(_at::timestamp) - 1700000000) / 60 AS t", "late").collect()
        runs.append({(r["k"], None if r["t"] is None else int(r["t"]), r["late"]) for r in out})
        assert len(out) == len(runs[-1]) and state <= 2 * 3  # keys 1, 6 and 7, each with its timer
    assert runs[0] == runs[1] == {(*r, False) for r in kept} | {(*r, True) for r in late}


def test_late_state_is_held_in_groups_of_keys(spark, tmp_path):
    """Many keys share a state entry and a timer, missing cells do not make whole numbers
    inexact, and a group keeps those of its keys whose span is not over."""
    from tallyrow.streaming import dedupe

    big, keys, base = (1 << 60) + 1, 3000, str(tmp_path / "groups")
    made = spark.range(keys).selectExpr("CASE WHEN id > 0 THEN id END AS k", f"CASE WHEN id % 3 > 0 THEN {big} + id END AS n", "timestamp_seconds(1700000000 + id * 60) AS at")
    steps = [made, made.selectExpr("k", "n", "at + INTERVAL 1 MINUTE AS at").unionByName(made.limit(0))]
    with dedupe.keyed_state(spark):
        for step in steps:
            step.repartition(3).write.mode("append").parquet(base + "/in")
            told = dedupe.dedupe_with_late(dedupe.file_stream(spark, base + "/in", made.schema), "k", "at", "1000 minutes")
            query = told.writeStream.format("parquet").option("checkpointLocation", base + "/cp").trigger(availableNow=True).start(base + "/out")
            query.awaitTermination()
    state = query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]
    assert 0 < state <= 2 * dedupe.KEY_GROUPS
    out = spark.read.parquet(base + "/out")
    mark = keys - 1 - 1000  # minutes; the watermark of the second step
    assert out.filter("NOT late").count() == keys  # a second event is a copy or late
    assert out.filter("late").count() == mark - 1
    assert out.filter(f"n IS NOT NULL AND n <> {big} + k").count() == 0 and out.filter("n IS NOT NULL").count() > keys / 2


def test_split_is_exact_and_stable(spark):
    df = spark.range(1003).select("id", F.when(F.col("id") % 10 == 0, "rare").otherwise("hot").alias("label"))
    a = evaluation.stratified_split(df, "id", "label").persist()
    counts = {(r["label"], r["is_test"]): r["count"] for r in a.groupBy("label", "is_test").count().collect()}
    assert counts == {("rare", True): 21, ("rare", False): 80, ("hot", True): 181, ("hot", False): 721}
    again = evaluation.stratified_split(df.repartition(5), "id", "label")
    assert a.filter("is_test").select("id").exceptAll(again.filter("is_test").select("id")).count() == 0
    other = evaluation.stratified_split(df, "id", "label", seed="2").filter("is_test").select("id")
    assert a.filter("is_test").select("id").exceptAll(other).count() > 0


def test_split_of_one_class_and_of_none(spark):
    df = spark.range(10).withColumn("label", F.lit(1))
    assert evaluation.stratified_split(df, "id", "label").filter("is_test").count() == 2
    assert evaluation.stratified_split(df, "id", None).filter("is_test").count() == 2


def test_labels_are_required(spark):
    with pytest.raises(ValueError):
        evaluation.require_labels(spark.range(3), "label")
    with pytest.raises(ValueError):
        evaluation.require_labels(spark.range(3).withColumn("label", F.lit(None).cast("int")), "label")


def test_report_divides_by_zero_to_zero(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "a"), ("c", "b")], "t string, p string")
    report = {r["class"]: r for r in evaluation.classification_report(df, "t", "p").collect()}
    assert (report["a"]["precision"], report["a"]["recall"], report["a"]["support"]) == (1.0, 0.5, 2)
    assert (report["b"]["precision"], report["b"]["recall"], report["b"]["f1"], report["b"]["support"]) == (0.0, 0.0, 0.0, 0)
    assert report["c"]["f1"] == 0.0 and math.isclose(report["accuracy"]["f1"], 1 / 3)
    assert math.isclose(report["macro avg"]["precision"], 1 / 3) and math.isclose(report["weighted avg"]["precision"], 2 / 3)


def test_confusion_matrix_keeps_order_and_zeros(spark):
    df = spark.createDataFrame([("FAKE", "FAKE"), ("FAKE", "REAL")], "t string, p string")
    got = {r["truth"]: (r["predicted_FAKE"], r["predicted_REAL"]) for r in evaluation.confusion_matrix(df, "t", "p", ["FAKE", "REAL"]).collect()}
    assert got == {"FAKE": (1, 1), "REAL": (0, 0)}


def brute_tfidf(docs, stop, max_share):
    import re
    from collections import Counter

    counts = {d: Counter(t for t in re.findall(r"\b\w\w+\b", x.lower()) if t not in stop) for d, x in docs}
    df = Counter(t for c in counts.values() for t in c)
    n, out = len(docs), {}
    for d, c in counts.items():
        raw = {t: k * (math.log((1 + n) / (1 + df[t])) + 1) for t, k in c.items() if df[t] <= max_share * n}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        out.update({(d, t): w / norm for t, w in raw.items()})
    return out


@pytest.mark.parametrize("broadcast_terms", [10_000, 0])
def test_tfidf_equals_brute_force(spark, broadcast_terms):
    """Both joins of the idf table; "common" is in every document and cut, "hot" in half."""
    rng = random.Random(3)
    docs = [(i, "common the " + ("hot " if i % 2 else "") + " ".join(f"wört{rng.randint(0, 30)}" for _ in range(20))) for i in range(60)]
    df = spark.createDataFrame(docs, "id bigint, text string")
    got = {(r["id"], r["term"]): r["weight"] for r in tfidf.tfidf(df, "id", broadcast_terms=broadcast_terms).collect()}
    want = brute_tfidf(docs, set(tfidf.STOP_WORDS), 0.7)
    assert got.keys() == want.keys() and not any(t in ("common", "the") for _, t in got)
    assert all(math.isclose(got[k], want[k], abs_tol=1e-9) for k in want)


def test_tfidf_learned_on_training_rows(spark):
    train = spark.createDataFrame([(1, "alpha beta"), (2, "beta gamma")], "id bigint, text string")
    both = train.union(spark.createDataFrame([(3, "alpha delta")], "id bigint, text string"))
    got = {(r["id"], r["term"]) for r in tfidf.tfidf(both, "id", fit_on=train, max_share=1.0).collect()}
    assert (3, "alpha") in got and (3, "delta") not in got  # delta was not seen in training


def training_rows(spark, n=600):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 2, (n, 8)).astype(float)
    words = rng.integers(5, 60, n).astype(float)
    z = 2.5 * x[:, 6] - 1.5 * x[:, 0] + 0.02 * words - 1.5
    y = (rng.random(n) < 1 / (1 + np.exp(-z))).astype(int)
    rows = [(i, *map(float, x[i]), float(words[i]), int(y[i])) for i in range(n)]
    schema = "job_id bigint, " + ", ".join(f"{c} double" for c in v.FEATURES) + ", label int"
    return spark.createDataFrame(rows, schema), np.column_stack([x, words]), y


def test_logistic_solution_has_no_gradient(spark):
    """At the solution the gradient of C*sum(w_i*loss_i) + |b|^2/2 vanishes for C=1."""
    df, x, y = training_rows(spark)
    model = models.fit_logistic(df)
    w = len(y) / (2 * np.bincount(y))[y]
    b, b0 = model.coefficients.toArray(), model.intercept
    p = 1 / (1 + np.exp(-(x @ b + b0)))
    gradient = x.T @ (w * (p - y)) + b
    assert np.abs(gradient).max() < 0.2 and abs(np.sum(w * (p - y))) < 0.2
    assert np.abs(x.T @ (w * (0.5 - y))).max() > 100
    top = models.coefficients(model, df).orderBy("place").collect()
    assert top[0]["feature"] == "flag_vague_title_language" and top[0]["coefficient"] > 1.5
    assert [abs(r["coefficient"]) for r in top] == sorted((abs(r["coefficient"]) for r in top), reverse=True)


def test_prediction_table(spark):
    df, _, _ = training_rows(spark, 200)
    p = models.predict(models.fit_logistic(df), df)
    assert p.dtypes == [
        ("job_id", "bigint"), ("predicted_prob", "double"), ("predicted_label", "boolean"),
        ("model_version", "string"), ("predicted_at", "timestamp_ntz"),
    ]
    assert p.filter("predicted_label <> (predicted_prob > 0.5)").count() == 0


@pytest.mark.parametrize("part_rows", [1000, 30])
def test_text_classifier_learns(spark, part_rows):
    """In one part, and as the mean of several."""
    rng = random.Random(1)
    word = {"REAL": ["senate", "report", "budget"], "FAKE": ["aliens", "miracle", "shocking"]}
    rows = [(i, " ".join(rng.choice(word[l] + ["today", "people"]) for _ in range(12)), l) for i in range(200) for l in (["REAL", "FAKE"][i % 2],)]
    df = spark.createDataFrame([*rows, (500, "", "FAKE"), (501, None, "REAL")], "id bigint, text string, label string")
    model = models.fit_text_classifier(df.filter("id < 160"), "id", "text", "label", "REAL", part_rows=part_rows)
    scored = models.classify_text(model, df.filter("id >= 160"), "id", "text", ("FAKE", "REAL"))
    assert scored.columns == [*df.columns, "predicted"] and scored.count() == 42
    assert evaluation.accuracy(scored.filter("id < 500"), "label", "predicted").first()["accuracy"] > 0.9
    assert len({r["predicted"] for r in scored.filter("id >= 500").collect()}) == 1  # no known term: the bias decides
    with pytest.raises(ValueError):
        models.fit_text_classifier(df.withColumn("label", F.lit(None).cast("string")), "id", "text", "label", "REAL")


def test_one_part_is_the_plain_learner(spark):
    """Weights equal those of the passive-aggressive rule, document by document."""
    rng = random.Random(7)
    rows = [(i, " ".join(f"t{rng.randrange(12)}x" for _ in range(6)), rng.choice("ab")) for i in range(40)]
    df = spark.createDataFrame(rows, "id bigint, text string, label string")
    model = models.fit_text_classifier(df, "id", "text", "label", "a", rounds=1, passes=3)
    names = {r["index"]: r["term"] for r in model.dictionary.collect()}
    got = {names.get(r["index"]): r["weight"] for r in model.weights.collect()}
    vectors = {}
    for r in tfidf.tfidf(df, "id").collect():
        vectors.setdefault(r["id"], {})[r["term"]] = r["weight"]
    order = [r["id"] for r in df.orderBy(F.xxhash64(F.col("id").cast("string"))).collect()]
    w, label = {}, {i: 1.0 if l == "a" else -1.0 for i, _, l in rows}
    for _ in range(3):
        for i in order:
            x = {**vectors[i], None: 1.0}
            loss = 1 - label[i] * sum(w.get(t, 0.0) * z for t, z in x.items())
            if loss > 0:
                step = min(1.0, loss / sum(z * z for z in x.values())) * label[i]
                for t, z in x.items():
                    w[t] = w.get(t, 0.0) + step * z
    assert got.keys() >= w.keys() and all(math.isclose(got[t], w[t], abs_tol=1e-9) for t in w)


def test_every_term_has_a_coefficient(spark):
    """Dense indices in term order, however ranges are cut; no two terms share one."""
    rows = [(i, f"everywhere term{i} other{i % 7} Ünï{i % 3}", "ab"[i % 2]) for i in range(60)]
    df = spark.createDataFrame(rows, "id bigint, text string, label string")
    model = models.fit_text_classifier(df.repartition(5), "id", "text", "label", "a")
    terms = [r["term"] for r in model.dictionary.orderBy("index").collect()]
    assert terms == sorted(terms, key=str.encode) and "everywhere" not in terms and len(terms) == 70
    assert [r["index"] for r in model.weights.orderBy("index").collect()] == list(range(-1, 70))


def test_vectors_equal_the_weight_table(spark):
    """Two rows of one key are one document; a term looked up by join weighs the same."""
    df = spark.createDataFrame([(1, "alpha beta"), (1, "beta"), (2, "beta gamma"), (3, "delta"), (4, "delta alpha"), (5, None)], "id bigint, text string")
    counts = {(r["id"], r["term"]): r["tf"] for r in tfidf.term_counts(df, "id").collect()}
    bags = {(r["id"], t["term"]): t["tf"] for r in tfidf.bags(df, "id").collect() for t in r["bag"]}
    assert bags == counts and bags[1, "beta"] == 2
    known = tfidf.dictionary(tfidf.bags(df, "id").select(F.inline("bag")), 5).persist()
    whole, joined = (tfidf.weighed(tfidf.bags(df, "id"), "id", known, 5, "index", n).select("id", F.inline("vector")).collect() for n in (10, 0))
    assert sorted(map(tuple, whole)) == sorted(map(tuple, joined)) and len(whole) == 7


def test_fixture_counts(spark):
    p = postings.with_flags(fx.job_postings(spark, "/root/testdata/sf0.01"))
    contact = p.filter("flag_off_platform_contact").groupBy(F.col("job_id") % 19).count().collect()
    assert {(r[0], r[1]) for r in contact if r[0] in (0, 2)} == {(0, 53), (2, 53)}


def test_bags_are_counted_once_and_dealt_by_key(spark):
    """A bag is read as it was written, equal keys and rows without a term included, and weights
    exchange the bags only once."""
    df = spark.createDataFrame([(1, "aa bb aa"), (1, "bb the"), (2, "the"), (3, None), (4, "aa")], "id int, text string")
    held = tfidf.bags(df, "id", stop_words=["the"])
    assert {f.rsplit("/", 2)[1].split("-")[0] for f in held.inputFiles()} == {"bags"}
    got = {r["id"]: sorted(map(tuple, r["bag"])) for r in held.collect()}
    assert got == {1: [("aa", 2), ("bb", 2)], 2: [], 3: [], 4: [("aa", 1)]}
    weights = tfidf.tfidf(df, "id", stop_words=["the"])
    plan = weights._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert {(r["id"], r["term"]) for r in weights.collect()} == {(1, "aa"), (1, "bb"), (4, "aa")}


def test_a_part_is_learned_in_its_arrow_columns():
    """The plain rule on the same documents, with less than 12 bytes of new arrays an entry."""
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(4)
    lists = [np.append(np.sort(rng.choice(3000, 400, replace=False)), models.BIAS) for _ in range(300)]
    values, y = [rng.random(401) / 20 for _ in lists], np.where(rng.random(300) < 0.5, 1.0, -1.0)
    place = rng.permutation(300)
    docs = pa.table({"place": place, "y": y, "index": pa.array(lists, pa.list_(pa.int64())), "value": pa.array(values, pa.list_(pa.float64()))})
    given = pa.table({"index": np.arange(10, 20), "weight": np.full(10, 0.25)})
    tracemalloc.start()
    got = models._learner(1.0, 2)(docs, given)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12 * 300 * 401
    w = np.zeros(3001)
    w[10:20] = 0.25
    for _ in range(2):
        for n in np.argsort(place):
            loss = 1.0 - y[n] * (w[lists[n]] @ values[n])
            if loss > 0:
                w[lists[n]] += min(1.0, loss / (values[n] @ values[n])) * y[n] * values[n]
    index, weight = got.column("index").to_numpy(), got.column("weight").to_numpy()
    assert index[0] == models.BIAS and set(index) == set(np.concatenate(lists))
    assert np.allclose(weight, w[index])


def test_the_classifiers_facts_make_each_bag_once(spark, sf):
    """Two fits, the margins and two predictions read the bags of two sets of news."""
    from pathlib import Path

    from tallyrow.catalog import queries
    from tallyrow.session import scratch_root

    root = Path(scratch_root(spark))
    before = set(root.iterdir()) if root.exists() else set()
    queries()["linear_text_classifier_facts"](spark, sf).collect()
    made = [p.name.split("-")[0] for p in set(root.iterdir()) - before]
    assert made.count("bags") == 2 and made.count("news") == 1
