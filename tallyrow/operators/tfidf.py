"""Terms, vocabulary and TF-IDF weights as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from tallyrow.functions import vocabulary as v
from tallyrow.functions.text import named
from tallyrow.operators.ordinals import ordinals
from tallyrow.operators.sizing import staged

# fixed values: the English list of pyspark.ml's StopWordsRemover, so that plans and
# oracle SQL can name it without a session
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her "
    "hers herself it its itself they them their theirs themselves what which who whom this that these "
    "those am is are was were be been being have has had having do does did doing a an the and but if or "
    "because as until while of at by for with about against between into through during before after "
    "above below to from up down in out on off over under again further then once here there when where "
    "why how all any both each few more most other some such no nor not only own same so than too very s "
    "t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd "
    "they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't "
    "weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't "
    "couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's "
    "would "
).split()

# largest vocabulary whose idf table is sent whole to every executor
BROADCAST_TERMS = 2_000_000
# a term in more than one of this many documents is joined on its own
HOT_TERM_SHARE = 1_000


def terms(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, term): every occurrence. Lower-cased runs of two or more word characters."""
    found = F.regexp_extract_all(F.lower(named(text)), F.lit(v.TERM), F.lit(0))
    return df.select(named(key), F.explode(found).alias("term"))


def term_counts(df: DataFrame, key: str, text: str = "text", stop_words: list[str] | None = None) -> DataFrame:
    """(key, term, tf). Occurrences are counted in the tasks that read the texts; what is
    exchanged is one row for each term of a document."""
    found = terms(df, key, text)
    if stop_words:
        found = found.filter(~F.col("term").isin(stop_words))
    return found.groupBy(named(key), "term").agg(F.count(F.lit(1)).alias("tf"))


def bags(df: DataFrame, key: str, text: str = "text", stop_words: list[str] | None = None) -> DataFrame:
    """(key, bag): the terms of each key as one array of (term, tf), counted and written once.
    Texts are dealt by key, so that no term is exchanged; only rows that share a key meet."""
    found = F.regexp_extract_all(F.lower(named(text)), F.lit(v.TERM), F.lit(0))
    # rows without a term keep their key
    dealt = df.select(named(key), named(text)).repartition(named(key)).select(named(key), F.explode_outer(found).alias("term"))
    if stop_words:
        dealt = dealt.withColumn("term", F.when(~F.col("term").isin(stop_words), F.col("term")))
    counts = dealt.groupBy(named(key), "term").agg(F.count("term").alias("tf"))
    entry = F.when(F.col("term").isNotNull(), F.struct("term", "tf"))
    return staged(counts.groupBy(named(key)).agg(F.collect_list(entry).alias("bag")), "bags")


def vocabulary(counts: DataFrame, n_docs: int, max_share: float = v.MAX_DOCUMENT_SHARE) -> DataFrame:
    """(term, df, idf) of the terms in at most max_share of the documents; ``counts`` has a row
    for each term of a document."""
    used = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0
    return used.filter(F.col("df") <= max_share * n_docs).withColumn("idf", idf)


def dictionary(counts: DataFrame, n_docs: int, max_share: float = v.MAX_DOCUMENT_SHARE) -> DataFrame:
    """(term, df, idf, index): the vocabulary with dense indices from 0 in term order, of any
    size: terms are counted in ranges, and ranges by their totals."""
    return ordinals(vocabulary(counts, n_docs, max_share), "term", "index")


def _raw(held: DataFrame, key: str, known: DataFrame, n_docs: int, name: str, broadcast_terms: int) -> DataFrame:
    """(key, ``name``, raw): tf * idf of the known terms of every bag.

    A vocabulary that can be sent whole meets bags that were dealt by key, so what follows by
    key exchanges nothing more. A larger one is joined by term, except for the few terms found
    in a large share of the documents: these would make skewed partitions and are joined by
    broadcast instead.
    """
    known_terms = known.select("term", "idf", "df", F.col(name).alias("__name"))
    if known.count() <= broadcast_terms:
        dealt = held.repartition(named(key)).select(named(key), F.inline("bag"))
        found = dealt.join(F.broadcast(known_terms.drop("df")), "term")
    else:
        counts = held.select(named(key), F.inline("bag"))
        # the sum of df is the number of (document, term) pairs, so there are at most
        # HOT_TERM_SHARE * (terms per document) hot terms, whatever the corpus size
        hot_from = max(n_docs // HOT_TERM_SHARE, 1)
        hot, cold = known_terms.filter(F.col("df") > hot_from).drop("df"), known_terms.filter(F.col("df") <= hot_from).drop("df")
        found = counts.join(F.broadcast(hot), "term").unionByName(
            counts.join(F.broadcast(hot.select("term")), "term", "left_anti").join(cold, "term")
        )
    return found.select(named(key), F.col("__name").alias(name), (F.col("tf") * F.col("idf")).alias("raw"))


def weighed(held: DataFrame, key: str, known: DataFrame, n_docs: int, name: str = "term", broadcast_terms: int = BROADCAST_TERMS) -> DataFrame:
    """(key, vector): the bag of each key with at least one known term as an array of
    (``name``, weight), tf * idf scaled to unit length. ``known`` has term, df, idf and ``name``.
    """
    found = _raw(held, key, known, n_docs, name, broadcast_terms)
    raw = F.struct(F.col(name), F.col("raw"))
    listed = found.groupBy(named(key)).agg(F.sqrt(F.sum(F.pow("raw", F.lit(2)))).alias("norm"), F.collect_list(raw).alias("raw"))
    vector = F.transform("raw", lambda x: F.struct(x[name].alias(name), (x["raw"] / F.col("norm")).alias("weight")))
    return listed.select(named(key), vector.alias("vector"))


def tfidf(
    df: DataFrame,
    key: str,
    text: str = "text",
    max_share: float = v.MAX_DOCUMENT_SHARE,
    stop_words: list[str] | None = None,
    fit_on: DataFrame | None = None,
    broadcast_terms: int = BROADCAST_TERMS,
) -> DataFrame:
    """(key, term, weight): tf * idf, scaled to unit length per document.

    ``fit_on`` limits the rows idf is learned from (default: all of ``df``).
    """
    words = STOP_WORDS if stop_words is None else stop_words
    n_docs = (df if fit_on is None else fit_on).count()
    held = bags(df, key, text, words)
    learned = held if fit_on is None else bags(fit_on, key, text, words)
    known = staged(vocabulary(learned.select(F.inline("bag")), n_docs, max_share), "vocabulary")
    norm = F.sqrt(F.sum(F.pow("raw", F.lit(2))).over(W.partitionBy(named(key))))
    return _raw(held, key, known, n_docs, "term", broadcast_terms).select(named(key), "term", (F.col("raw") / norm).alias("weight"))
