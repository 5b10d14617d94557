"""Class-balanced logistic regression and an online text classifier."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from tallyrow.functions import vocabulary as v
from tallyrow.functions.text import named
from tallyrow.operators import tfidf
from tallyrow.operators.evaluation import require_labels, with_class_weights
from tallyrow.operators.sizing import staged

# index of the constant feature
BIAS = -1
# documents of a part, one part being learned from in one task
PART_ROWS = 8_192
# entries whose places are looked up at once
FOUND = 1 << 16
# rounds, and passes over a part's documents in each
ROUNDS, PASSES = 5, 4


def feature_matrix(df: DataFrame, key: str = "job_id", label: str = "fraudulent") -> DataFrame:
    """(key, nine feature columns as double, label as int) of the labelled rows."""
    features = [named(c).cast("int").cast("double").alias(c) for c in v.FEATURES]
    return df.filter(named(label).isNotNull()).select(named(key), *features, named(label).cast("int").alias("label"))


def fit_logistic(train: DataFrame, c: float = 1.0, max_iter: int = 1000) -> LogisticRegressionModel:
    """L2 logistic regression with balanced class weights.

    Balanced weights sum to the row count, so a penalty of 1/(C*n) gives the usual
    objective C * sum(loss) + |w|^2 / 2. ``train`` must be cached by the caller if
    it is costly: the solver reads it once per iteration.
    """
    require_labels(train, "label")
    weighted = with_class_weights(train, "label")
    assembled = VectorAssembler(inputCols=v.FEATURES, outputCol="features").transform(weighted)
    rows = train.count()
    solver = LogisticRegression(
        featuresCol="features", labelCol="label", weightCol="weight",
        standardization=False, regParam=1.0 / (c * rows), elasticNetParam=0.0, maxIter=max_iter, tol=1e-8,
    )
    return solver.fit(assembled)


def objective_gradient(model: LogisticRegressionModel, train: DataFrame, c: float = 1.0) -> DataFrame:
    """(parameter, gradient) of the penalised objective at the fitted model; at the optimum
    all are zero."""
    weighted = with_class_weights(train, "label")
    margin = F.lit(float(model.intercept))
    for name, x in zip(v.FEATURES, model.coefficients):
        margin = margin + named(name) * float(x)
    off = F.col("weight") * (1 / (1 + F.exp(-margin)) - F.col("label"))
    rows = train.count()
    penalty = {name: float(x) / (c * rows) for name, x in zip(v.FEATURES, model.coefficients)}
    sums = weighted.agg(
        *[(F.sum(off * named(n)) / F.sum("weight") + F.lit(penalty[n])).alias(n) for n in v.FEATURES],
        (F.sum(off) / F.sum("weight")).alias("intercept"),
    )
    return sums.unpivot([], sums.columns, "parameter", "gradient")


def coefficients(model: LogisticRegressionModel, df: DataFrame) -> DataFrame:
    """(place, feature, coefficient), largest absolute value first."""
    pairs = sorted(zip(v.FEATURES, (float(x) for x in model.coefficients)), key=lambda p: -abs(p[1]))
    rows = [(i, name, x) for i, (name, x) in enumerate(pairs, 1)]
    return df.sparkSession.createDataFrame(rows, "place int, feature string, coefficient double")


def predict(model: LogisticRegressionModel, rows: DataFrame, key: str = "job_id", version: str = "lr-1") -> DataFrame:
    """The declared prediction table: key, probability, label, version, time."""
    assembled = VectorAssembler(inputCols=v.FEATURES, outputCol="features").transform(rows)
    scored = model.transform(assembled)
    return scored.select(
        named(key),
        vector_to_array("probability")[1].alias("predicted_prob"),
        (F.col("prediction") == 1.0).alias("predicted_label"),
        F.lit(version).alias("model_version"),
        F.current_timestamp().cast("timestamp_ntz").alias("predicted_at"),
    )


@dataclass
class TextModel:
    """A linear text classifier as tables: a coefficient for every term of the dictionary."""

    #: (term, df, idf, index)
    dictionary: DataFrame
    #: (index, weight) of every term, and of BIAS
    weights: DataFrame
    #: documents the dictionary was learned from
    n_docs: int


def text_bags(df: DataFrame, key: str, text: str) -> DataFrame:
    """The bags of a classifier's texts; its functions take them as ``held``, where several of
    them read the same texts."""
    return tfidf.bags(df, key, text, tfidf.STOP_WORDS)


def text_vectors(df: DataFrame, key: str, text: str, dictionary: DataFrame, n_docs: int, held: DataFrame | None = None) -> DataFrame:
    """(key, vector): the TF-IDF vector as an array of (index, weight), of the rows with at
    least one term of the dictionary."""
    return tfidf.weighed(text_bags(df, key, text) if held is None else held, key, dictionary, n_docs, "index")


def fit_text_classifier(
    train: DataFrame, key: str, text: str, label: str, positive: str, c: float = 1.0, rounds: int = ROUNDS, passes: int = PASSES, part_rows: int = PART_ROWS,
    held: DataFrame | None = None,
) -> TextModel:
    """Passive-aggressive learner (hinge loss, step at most ``c``) on TF-IDF vectors.

    Documents are dealt into parts of about ``part_rows``. In each round a part gets the weights
    of its own terms, goes ``passes`` times over its documents in a fixed order, and a term's new
    weight is the mean over the parts that hold it. With one part this is the plain learner.
    The weights are a table, so the vocabulary may have any size. Rows without a known term are
    not learned from.
    """
    require_labels(train, label)
    n_docs = train.count()
    held = text_bags(train, key, text) if held is None else held
    terms = staged(tfidf.dictionary(held.select(F.inline("bag")), n_docs), "dictionary")
    vectors = tfidf.weighed(held, key, terms, n_docs, "index")
    side = F.when(named(label) == positive, 1.0).otherwise(-1.0)
    place = F.xxhash64(named(key).cast("string"))
    parts = max(1, -(-n_docs // part_rows))
    # in term order, so that sums are the same on each run
    labelled = vectors.withColumn("vector", F.sort_array("vector")).join(train.select(named(key), side.alias("y")), key).select(
        F.pmod(place, F.lit(parts)).cast("int").alias("part"), place.alias("place"), "y",
        F.concat(F.col("vector.index"), F.array(F.lit(BIAS).cast("bigint"))).alias("index"), F.concat(F.col("vector.weight"), F.array(F.lit(1.0))).alias("value"),
    )
    rows = staged(labelled, "vectors")
    holds = staged(rows.select("part", F.explode("index").alias("index")).distinct(), "holds")
    names = terms.select("index").unionByName(train.sparkSession.createDataFrame([(BIAS,)], "index bigint"))
    weights = names.withColumn("weight", F.lit(0.0))
    learn = _learner(c, passes)
    for _ in range(rounds):
        given = holds.join(weights, "index").groupBy("part")
        learned = rows.groupBy("part").cogroup(given).applyInArrow(learn, "index bigint, weight double")
        mean = learned.groupBy("index").agg(F.avg("weight").alias("weight"))
        weights = staged(names.join(mean, "index", "left").select("index", F.coalesce("weight", F.lit(0.0)).alias("weight")), "weights")
    return TextModel(terms, weights, n_docs)


def _learner(c: float, passes: int):
    def learn(docs: pa.Table, given: pa.Table) -> pa.Table:
        # the columns stay as they came, in their batches; an entry gets four bytes for its place
        batches = [b for b in docs.to_batches() if b.num_rows]
        own = pc.unique(pa.chunked_array([b.column("index").flatten() for b in batches])).to_numpy().copy()
        own.sort()
        w = np.zeros(len(own))
        w[np.searchsorted(own, given.column("index").to_numpy())] = given.column("weight").to_numpy()
        lines = []
        for batch in batches:
            entries, values = (batch.column(name).flatten().to_numpy() for name in ("index", "value"))
            where = np.empty(len(entries), np.int32)
            for a in range(0, len(entries), FOUND):
                where[a : a + FOUND] = np.searchsorted(own, entries[a : a + FOUND])
            stops = np.cumsum(batch.column("index").value_lengths().to_numpy())
            lines += [(y, where[a:b], values[a:b]) for y, a, b in zip(batch.column("y").to_numpy(), np.r_[0, stops[:-1]], stops)]
        lines = [lines[i] for i in np.argsort(docs.column("place").to_numpy(), kind="stable")]
        for _ in range(passes):
            missed = 0
            for y, at, x in lines:
                loss = 1.0 - y * (w[at] @ x)
                if loss > 0:
                    missed += 1
                    w[at] += min(c, loss / (x @ x)) * y * x
            if not missed:
                break
        return pa.table({"index": own, "weight": w})

    return learn


def text_margins(model: TextModel, df: DataFrame, key: str, text: str, held: DataFrame | None = None) -> DataFrame:
    """(key, margin) of every row; one without a known term has the bias as margin."""
    entries = text_vectors(df, key, text, model.dictionary, model.n_docs, held).select(named(key), F.inline("vector").alias("index", "value"))
    bias = model.weights.filter(F.col("index") == BIAS).first()["weight"]
    # terms without weight add nothing, and the others are at most those of the training rows
    used = model.weights.filter((F.col("weight") != 0) & (F.col("index") != BIAS))
    used = F.broadcast(used) if used.count() <= tfidf.BROADCAST_TERMS else used
    sums = entries.join(used, "index").groupBy(named(key)).agg(F.sum(F.col("value") * F.col("weight")).alias("margin"))
    return df.select(named(key)).join(sums, key, "left").select(named(key), (F.coalesce("margin", F.lit(0.0)) + F.lit(bias)).alias("margin"))


def classify_text(model: TextModel, df: DataFrame, key: str, text: str, labels: tuple[str, str], held: DataFrame | None = None) -> DataFrame:
    """``df`` with ``predicted``; labels are (negative, positive). ``key`` must be unique."""
    predicted = F.when(F.col("margin") > 0, labels[1]).otherwise(labels[0])
    margins = text_margins(model, df, key, text, held).select(named(key).alias("__key"), predicted.alias("predicted"))
    return df.join(margins, named(key) == F.col("__key")).drop("__key")
