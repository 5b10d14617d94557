"""Inputs derived from the star-schema tables by rule on a key.

The plain tables hold no defects, so dirty orders, postings, pages and questions
are made from them; every fixture grows with its source table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyrow.functions import vocabulary as v
from tallyrow.sources.tables import spread

COPY_OFFSET = 1 << 40

# tables whose rows are costly to work on
_SPREAD = {"orders", "documents", "conversations"}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in _SPREAD else df


def _every(key: str, m: int, r: int = 0) -> Column:
    return F.col(key) % m == r


MESSY_COLUMNS = [
    "order_id", "customer_name", "city", "order_date", "quantity", "amount", "email", "currency",
]


def messy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with injected defects; row_pos gives the row order."""
    orders = read(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "k")
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    base = orders.join(customers, orders.o_custkey == customers.c_custkey)
    k = F.col("k")
    city = F.element_at(
        F.array(*[F.lit(c) for c in ("Lisbon", "Geneva", "Turin", "Basel", "Krakow")]),
        (k % 5 + 1).cast("int"),
    )
    rows = base.select(
        k.alias("order_id"),
        F.when(_every("k", 41), F.concat("c_name", F.lit("  "))).otherwise(F.col("c_name")).alias("customer_name"),
        F.when(_every("k", 25), "lisboa")
        .when(_every("k", 40, 1), "Lisbon ")
        .when(_every("k", 50, 2), "GENEVA")
        .otherwise(city)
        .alias("city"),
        F.when(_every("k", 67), "not recorded")
        .when(_every("k", 83), "31/02/2024")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("order_date"),
        F.when(_every("k", 167), 900).when(_every("k", 251), -3).otherwise(k % 9 + 1).cast("bigint").alias("quantity"),
        F.when(_every("k", 29), "N/A")
        .when(_every("k", 50), "€2,750")
        .otherwise(F.col("o_totalprice").cast("decimal(12,2)").cast("string"))
        .alias("amount"),
        F.when(_every("k", 17), F.lit(None))
        .when(_every("k", 33), "N/A")
        .otherwise(F.concat(F.lit("user"), k.cast("string"), F.lit("@example.com")))
        .alias("email"),
        F.lit("CHF").alias("currency"),
    )
    # every copied row follows all original rows
    copies = F.when(_every("order_id", 33, 5), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("*", F.explode(copies).alias("copy")).select(
        *MESSY_COLUMNS, (F.col("order_id") + F.col("copy") * F.lit(COPY_OFFSET)).alias("row_pos")
    )


def job_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings made of documents and labels; location and others are absent."""
    docs = read(spark, sf_dir, "documents")
    labels = read(spark, sf_dir, "labels").select("doc_id", "toxic")
    d = docs.join(labels, "doc_id", "left")
    return d.select(
        F.col("doc_id").alias("job_id"),
        F.when(_every("doc_id", 11), "Work From Home clerk")
        .when(_every("doc_id", 11, 1), "Earn $500 weekly")
        .when(_every("doc_id", 11, 2), F.lit(None))
        .otherwise("Analyst")
        .alias("title"),
        F.col("source").alias("industry"),
        F.col("lang").alias("function"),
        F.when(~_every("doc_id", 9), F.col("text")).alias("description"),
        F.when(_every("doc_id", 13), "Send your bank account number")
        .when(_every("doc_id", 13, 1), "Act now, hiring fast")
        .otherwise("")
        .alias("requirements"),
        F.when(_every("doc_id", 19), "mail me at x@gmail.com")
        .when(_every("doc_id", 19, 1), "ring +1 5551234567")
        .when(_every("doc_id", 19, 2), "ring a+15551234567")
        .otherwise("")
        .alias("benefits"),
        F.when(_every("doc_id", 3), "  ").when(_every("doc_id", 7), F.lit(None)).otherwise("Profile").alias("company_profile"),
        F.when(~_every("doc_id", 2), "10-20").alias("salary_range"),
        F.when(_every("doc_id", 5), 0).when(_every("doc_id", 5, 1), F.lit(None)).otherwise(1).cast("int").alias("has_company_logo"),
        F.col("toxic").cast("int").alias("fraudulent"),
    )


def repeated_postings(postings: DataFrame) -> DataFrame:
    """Every tenth posting once more, later in row order and under another title."""
    copies = F.when(_every("job_id", 10), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        postings.select("*", F.explode(copies).alias("copy"))
        .withColumn("title", F.when(F.col("copy") == 1, "Reposted").otherwise(F.col("title")))
        .withColumn("row_pos", F.col("job_id") + F.col("copy") * F.lit(COPY_OFFSET))
        .drop("copy")
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with a rule in place of a model: wrong on every 7th."""
    labels = read(spark, sf_dir, "labels")
    truth = F.col("toxic").cast("int")
    return labels.select(
        F.col("doc_id").alias("id"),
        truth.alias("truth"),
        F.when(_every("doc_id", 7), 1 - truth).otherwise(truth).cast("int").alias("pred"),
        (F.col("doc_id") % 100 / 100.0).alias("prob"),
    )


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id").select(
        "doc_id", "text", F.when(F.col("quality") == 1, "REAL").otherwise("FAKE").alias("label")
    )


def verb_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations in the shape of conjugation records."""
    pronouns = F.array(*[F.lit(p) for p in v.PRONOUN_ORDER], F.lit("On"))
    c = read(spark, sf_dir, "conversations")
    return c.select(
        F.concat(F.lit("Verb"), F.col("conv_id").cast("string")).alias("verb"),
        F.concat(F.lit("to do "), F.col("conv_id").cast("string")).alias("meaning"),
        F.concat(F.col("role"), F.lit(" tense")).alias("tense"),
        F.element_at(pronouns, ((F.col("conv_id") + F.lit(13) - F.col("turn") % 14) % 14 + 1).cast("int")).alias("pronoun"),
        F.col("text").alias("form"),
        F.col("conv_id").alias("page"),
        F.col("turn").alias("pos"),
    )


def pages_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the shape of a conjugation page; every fourth has no heading.

    The lines of the document itself follow the grid, so whole texts are parsed.
    """
    docs = read(spark, sf_dir, "documents")
    k = F.col("doc_id").cast("string")
    grid = F.concat(
        F.lit("Présent Passé composé Imparfait Plus-que-parfait\n"),
        F.lit("Je vais Je suis allé J'allais J'étais allé\n"),
        F.lit("Tu vas Tu es allé Tu  Tu étais allé\n"),
        F.lit("\n"),
        F.lit("Que je sois Que nous soyons Sois ! (Tu) Soyons ! (Nous)\n"),
        F.lit("Futur simple Futur antérieur\n"),
        F.lit("Nous irons Nous serons allés\n"),
    )
    heading = F.when(
        ~_every("doc_id", 4), F.concat(F.lit("• Verbe"), k, F.lit(" To go "), k, F.lit("\n"))
    ).otherwise(F.lit("Contents\n"))
    return docs.select(F.col("doc_id").alias("page"), F.concat(heading, grid, F.col("text")).alias("text"))


def chunk_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "embeddings")
    verb = F.concat(F.lit("verb_"), F.col("label").cast("string"))
    tense_names = sorted({t for _, t in v.TENSE_KEYWORDS})
    tense = F.element_at(
        F.array(*[F.lit(t) for t in tense_names]), (F.col("vec_id") % len(tense_names) + 1).cast("int")
    )
    return e.select(
        "vec_id",
        "embedding",
        verb.alias("verb"),
        verb.alias("verb_lower"),
        tense.alias("tense"),
        (F.col("vec_id") % 7 + 1).alias("page"),
        F.concat(
            F.lit("Verb: "), verb, F.lit(" (to "), F.col("vec_id").cast("string"), F.lit(")\nTense: "), tense,
            F.lit("\nJe: form"), F.col("vec_id").cast("string"), F.lit("\nTu: form"), F.col("vec_id").cast("string"),
        ).alias("text"),
    )


def query_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fiftieth vector as a query; some without verb or tense filter."""
    c = chunk_vectors(spark, sf_dir)
    return c.filter(_every("vec_id", 50)).select(
        F.col("vec_id").alias("query_id"),
        "embedding",
        F.when(~_every("vec_id", 100), F.col("verb_lower")).alias("verb"),
        F.when(~_every("vec_id", 150), F.col("tense")).alias("tense"),
    )


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One question per order: a verb, a keyword and an opening chosen by rule."""
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("question_id"))
    k = F.col("question_id")
    openings = ["Conjugate", "Why is", "Show me", "EXPLAIN", "what's the difference of", "présent"]
    words = [keyword for keyword, _ in v.TENSE_KEYWORDS] + ["future simple", "represented", "tomorrow"]
    pick = lambda items, i: F.element_at(F.array(*[F.lit(x) for x in items]), i.cast("int"))
    verb = F.when(_every("question_id", 7), F.lit("parler")).otherwise(
        F.concat(F.lit("Verb_"), (k % 12).cast("string"))
    )
    return o.select(
        "question_id",
        F.concat(
            pick(openings, k % len(openings) + 1), F.lit(" "), verb, F.lit(" in the "),
            pick(words, F.floor(k / 5) % len(words) + 1),
            F.when(_every("question_id", 11), F.concat(F.lit(" or verb_"), (k % 5).cast("string"))).otherwise(F.lit("")),
            F.lit("?"),
        ).alias("question"),
    )
