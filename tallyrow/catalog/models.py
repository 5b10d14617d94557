"""Queries: feature matrix, splits, models, metrics and TF-IDF."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyrow.catalog import sql
from tallyrow.catalog.registry import query
from tallyrow.operators import evaluation, models, postings, tfidf
from tallyrow.operators.sizing import staged
from tallyrow.sources import fixtures as fx


def features(spark: SparkSession, sf: str) -> DataFrame:
    return models.feature_matrix(postings.with_flags(fx.job_postings(spark, sf)))


@query("feature_matrix", f"WITH {sql.FEATURES} SELECT * FROM features")
def feature_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return features(spark, sf)


_SPLIT = """
ranked AS (SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic ORDER BY md5(CAST(doc_id AS VARCHAR))) AS place,
  count(*) OVER (PARTITION BY toxic) AS n FROM labels),
split AS (SELECT doc_id, toxic, place <= ceil(round(n * 0.2, 9)) AS is_test FROM ranked)"""


@query("stratified_split", f"WITH {_SPLIT} SELECT * FROM split")
def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.stratified_split(fx.read(spark, sf, "labels").select("doc_id", "toxic"), "doc_id", "toxic")


@query(
    "unstratified_split",
    """SELECT o_orderkey, row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR))) <= ceil(round(count(*) OVER () * 0.2, 9)) AS is_test FROM orders""",
)
def unstratified_split(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.stratified_split(fx.read(spark, sf, "orders").select("o_orderkey"), "o_orderkey", None)


@query(
    "class_weights",
    """SELECT toxic AS label, count(*) AS n, round((SELECT count(*) FROM labels) / (2.0 * count(*)), 9) AS weight FROM labels GROUP BY toxic""",
)
def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.class_weights(fx.read(spark, sf, "labels"), "toxic").withColumn("weight", F.round("weight", 9))


def _split_features(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(train, test), the flags being computed once for all that follows."""
    kept = staged(features(spark, sf), "features")
    split = evaluation.stratified_split(kept, "job_id", "label")
    return split.filter("not is_test"), split.filter("is_test")


@query("lr_fit")
def lr_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Precision, recall and F1 of the balanced logistic regression on the test rows."""
    train, test = _split_features(spark, sf)
    scored = models.predict(models.fit_logistic(train), test).join(test.select("job_id", "label"), "job_id")
    return evaluation.classification_report(
        scored.select("label", F.col("predicted_label").cast("int").alias("predicted")), "label", "predicted"
    )


@query("lr_fit_optimum", "SELECT 10 AS parameters, true AS vanishing")
def lr_fit_optimum(spark: SparkSession, sf: str) -> DataFrame:
    """The objective's gradient is zero at the fitted model."""
    train, _ = _split_features(spark, sf)
    gradient = models.objective_gradient(models.fit_logistic(train), train)
    return gradient.agg(F.count(F.lit(1)).cast("int").alias("parameters"), (F.max(F.abs("gradient")) < 1e-5).alias("vanishing"))


@query("lr_coefficients_ranked", "SELECT unnest(range(1, 10))::INTEGER AS place, true AS ranked")
def lr_coefficients_ranked(spark: SparkSession, sf: str) -> DataFrame:
    """Every feature once, the largest absolute value first."""
    train, _ = _split_features(spark, sf)
    found = models.coefficients(models.fit_logistic(train), train)
    smaller = found.select((F.col("place") + 1).alias("place"), F.abs("coefficient").alias("above"))
    ranked = F.coalesce(F.abs("coefficient") <= F.col("above"), F.lit(True))
    return found.join(smaller, "place", "left").select("place", ranked.alias("ranked"))


@query(
    "model_predictions_table",
    f"WITH {_SPLIT} SELECT doc_id AS job_id, true AS probability, true AS label_agrees, 'lr-1' AS model_version FROM split WHERE is_test",
)
def model_predictions_table(spark: SparkSession, sf: str) -> DataFrame:
    """One prediction per test row, with a probability and the label that follows from it."""
    train, test = _split_features(spark, sf)
    p = models.predict(models.fit_logistic(train), test)
    return p.select(
        "job_id", F.col("predicted_prob").between(0, 1).alias("probability"),
        ((F.col("predicted_prob") > 0.5) == F.col("predicted_label")).alias("label_agrees"), "model_version",
    )


@query("lr_coefficients")
def lr_coefficients(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = _split_features(spark, sf)
    return models.coefficients(models.fit_logistic(train), train)


@query("model_predictions")
def model_predictions(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _split_features(spark, sf)
    return models.predict(models.fit_logistic(train), test)


_REPORT = """
c AS (SELECT t.label, count(*) FILTER (truth = label AND pred = label) AS hits, count(*) FILTER (pred = label) AS claimed,
  count(*) FILTER (truth = label) AS support FROM predictions, (VALUES (0), (1)) t(label) GROUP BY t.label),
m AS (SELECT label, coalesce(hits / nullif(claimed, 0), 0) AS p, coalesce(hits / nullif(support, 0), 0) AS r, support, hits FROM c),
f AS (SELECT *, coalesce(2*p*r / nullif(p+r, 0), 0) AS f1 FROM m)"""


@query(
    "classification_report",
    f"""WITH {sql.PREDICTIONS}, {_REPORT}, report AS (
    SELECT CAST(label AS VARCHAR) AS class, p AS precision, r AS recall, f1, support FROM f
    UNION ALL SELECT 'accuracy', sum(hits)/sum(support), sum(hits)/sum(support), sum(hits)/sum(support), sum(support) FROM f
    UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f1), sum(support) FROM f
    UNION ALL SELECT 'weighted avg', sum(p*support)/sum(support), sum(r*support)/sum(support), sum(f1*support)/sum(support), sum(support) FROM f)
    SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM report""",
)
def classification_report(spark: SparkSession, sf: str) -> DataFrame:
    report = evaluation.classification_report(fx.predictions(spark, sf), "truth", "pred")
    return report.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query(
    "confusion_matrix",
    f"""WITH {sql.PREDICTIONS} SELECT CAST(truth AS VARCHAR) AS truth, count(*) FILTER (pred = 0) AS predicted_0, count(*) FILTER (pred = 1) AS predicted_1
    FROM predictions GROUP BY truth""",
)
def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.confusion_matrix(fx.predictions(spark, sf), "truth", "pred", [0, 1])


@query(
    "accuracy",
    f"""WITH {sql.PREDICTIONS} SELECT count(*) AS n, CAST(sum((truth = pred)::INT) AS BIGINT) AS correct, round(avg((truth = pred)::INT), 6) AS accuracy FROM predictions""",
)
def accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.accuracy(fx.predictions(spark, sf), "truth", "pred").withColumn("accuracy", F.round("accuracy", 6))


_TERMS = """
occurrences AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{M}\\p{N}\\p{Pc}]{2,}')) AS term FROM documents)"""


@query("tokenize", f"WITH {_TERMS} SELECT doc_id, term, count(*) AS tf FROM occurrences GROUP BY doc_id, term")
def tokenize(spark: SparkSession, sf: str) -> DataFrame:
    return tfidf.term_counts(fx.read(spark, sf, "documents"), "doc_id")


_MAX_SHARE = 0.1  # no term of these tables is in 70% of the documents
_COUNTED = _TERMS + f""",
tf AS (SELECT doc_id, term, count(*) AS tf FROM occurrences WHERE term NOT IN {sql.in_list(tfidf.STOP_WORDS)} GROUP BY doc_id, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
total AS (SELECT count(*) AS n FROM documents)"""


@query(
    "tfidf_vocabulary",
    f"""WITH {_COUNTED} SELECT term, df, round(ln((1.0+n)/(1.0+df))+1, 6) AS idf FROM df, total WHERE df <= {_MAX_SHARE} * n""",
)
def tfidf_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    docs = fx.read(spark, sf, "documents")
    counts = tfidf.term_counts(docs, "doc_id", stop_words=tfidf.STOP_WORDS)
    return tfidf.vocabulary(counts, docs.count(), _MAX_SHARE).withColumn("idf", F.round("idf", 6))


@query(
    "tfidf_weights",
    f"""WITH {_COUNTED}, raw AS (SELECT doc_id, term, tf * (ln((1.0+n)/(1.0+df))+1) AS w FROM tf JOIN df USING (term), total WHERE df <= 0.7 * n)
    SELECT doc_id, term, round(w / sqrt(sum(w*w) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw""",
)
def tfidf_weights(spark: SparkSession, sf: str) -> DataFrame:
    weights = tfidf.tfidf(fx.read(spark, sf, "documents"), "doc_id")
    return weights.withColumn("weight", F.round("weight", 6))


def _news_split(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(training news, held-out news), written once for all that reads them."""
    news = staged(evaluation.stratified_split(fx.news(spark, sf), "doc_id", "label"), "news")
    return news.filter("not is_test").drop("is_test"), news.filter("is_test").drop("is_test")


_NEWS = """
news AS (SELECT doc_id, text, quality, row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR)))
  <= ceil(round(count(*) OVER (PARTITION BY quality) * 0.2, 9)) AS is_test FROM labels JOIN documents USING (doc_id)),
words AS (SELECT doc_id, is_test, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{M}\\p{N}\\p{Pc}]{2,}')) AS term FROM news),
bag AS (SELECT doc_id, is_test, term, count(*) AS tf FROM words WHERE term NOT IN """ + sql.in_list(tfidf.STOP_WORDS) + """ GROUP BY ALL),
held AS (SELECT count(*) AS n FROM news WHERE NOT is_test),
dictionary AS (SELECT term, df, ln((1.0+n)/(1.0+df))+1 AS idf, row_number() OVER (ORDER BY term) - 1 AS index
  FROM (SELECT term, count(*) AS df FROM bag WHERE NOT is_test GROUP BY term), held WHERE df <= 0.7 * n)"""


@query("term_dictionary", f"WITH {_NEWS} SELECT term, df, round(idf, 6) AS idf, index FROM dictionary")
def term_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """The training terms with dense indices: one coefficient for each."""
    train, _ = _news_split(spark, sf)
    held = tfidf.bags(train, "doc_id", stop_words=tfidf.STOP_WORDS)
    return tfidf.dictionary(held.select(F.inline("bag")), train.count()).withColumn("idf", F.round("idf", 6))


@query(
    "text_vectors",
    f"""WITH {_NEWS}, raw AS (SELECT doc_id, index, tf * idf AS w FROM bag JOIN dictionary USING (term) WHERE is_test)
    SELECT doc_id, index, round(w / sqrt(sum(w*w) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw""",
)
def text_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """The held-out news as vectors over the training dictionary."""
    train, test = _news_split(spark, sf)
    n = train.count()
    known = staged(tfidf.dictionary(tfidf.bags(train, "doc_id", stop_words=tfidf.STOP_WORDS).select(F.inline("bag")), n), "dictionary")
    vectors = models.text_vectors(test, "doc_id", "text", known, n).select("doc_id", F.inline("vector"))
    return vectors.withColumn("weight", F.round("weight", 6))


@query("linear_text_classifier")
def linear_text_classifier(spark: SparkSession, sf: str) -> DataFrame:
    """Confusion matrix of the TF-IDF classifier on the held-out news."""
    train, test = _news_split(spark, sf)
    model = models.fit_text_classifier(train, "doc_id", "text", "label", "REAL")
    predicted = models.classify_text(model, test, "doc_id", "text", ("FAKE", "REAL"))
    return evaluation.confusion_matrix(predicted, "label", "predicted", ["FAKE", "REAL"])


@query(
    "linear_text_classifier_totals",
    """SELECT CASE quality WHEN 1 THEN 'REAL' ELSE 'FAKE' END AS truth, CAST(ceil(round(count(*) * 0.2, 9)) AS BIGINT) AS rows
    FROM labels JOIN documents USING (doc_id) GROUP BY 1""",
)
def linear_text_classifier_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Every held-out row of a class is predicted once."""
    matrix = linear_text_classifier(spark, sf)
    return matrix.select("truth", (F.col("predicted_FAKE") + F.col("predicted_REAL")).alias("rows"))


@query(
    "linear_text_classifier_facts",
    f"""WITH {_NEWS}, classes AS (SELECT count(*) AS rows FROM news WHERE is_test GROUP BY quality)
    SELECT (SELECT count(*) FROM dictionary) AS coefficients, (SELECT sum(rows)::BIGINT FROM classes) AS predicted,
    true AS loss_below_zero_model, true AS fits_training, true AS same_on_rerun, true AS no_worse_than_majority""",
)
def linear_text_classifier_facts(spark: SparkSession, sf: str) -> DataFrame:
    """What must hold of the fitted model: one coefficient a term (fewer if terms shared one),
    less hinge loss on the training rows than weights of zero and 95 % of them right, equal
    predictions when it is fitted again, and no fewer held-out rows right than by naming the
    larger class."""
    train, test = _news_split(spark, sf)
    learned, asked = (models.text_bags(part, "doc_id", "text") for part in (train, test))
    first, again = (models.fit_text_classifier(train, "doc_id", "text", "label", "REAL", held=learned) for _ in range(2))
    side = F.when(F.col("label") == "REAL", 1.0).otherwise(-1.0)
    margin = side * F.col("margin")
    trained = models.text_margins(first, train, "doc_id", "text", learned).join(train, "doc_id").agg(
        (F.avg(F.greatest(F.lit(0.0), 1 - margin)) < 1).alias("loss_below_zero_model"), (F.avg((margin > 0).cast("int")) > 0.95).alias("fits_training")
    )
    judged = models.classify_text(first, test, "doc_id", "text", ("FAKE", "REAL"), asked)
    other = models.classify_text(again, test, "doc_id", "text", ("FAKE", "REAL"), asked).select("doc_id", F.col("predicted").alias("other"))
    right = F.count_if(F.col("label") == F.col("predicted"))
    majority = F.greatest(F.count_if(F.col("label") == "REAL"), F.count_if(F.col("label") == "FAKE"))
    facts = judged.join(other, "doc_id").agg(
        F.count(F.lit(1)).alias("predicted"), (F.count_if(F.col("predicted") != F.col("other")) == 0).alias("same_on_rerun"), (right >= majority).alias("no_worse_than_majority")
    )
    size = first.weights.filter(F.col("index") != models.BIAS).agg(F.count_distinct("index").alias("coefficients"))
    return size.crossJoin(facts).crossJoin(trained)  # one row each
