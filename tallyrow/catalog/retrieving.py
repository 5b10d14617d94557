"""Queries: page parsing, chunks, vector search, question answering and its accuracy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyrow.catalog import sql
from tallyrow.catalog.registry import query
from tallyrow.functions import vectors, vocabulary as v
from tallyrow.operators import chunks, encoding, keys, pages, retrieval
from tallyrow.session import scratch_path
from tallyrow.sources import fixtures as fx, tables

# --- pages -------------------------------------------------------------------

_LINES = f"""
numbered AS (SELECT doc_id, line, i FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)),
lines AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS pos, line FROM numbered WHERE {sql.strip('line')} <> '')"""


@query("page_lines", f"WITH {_LINES} SELECT * FROM lines")
def page_lines(spark: SparkSession, sf: str) -> DataFrame:
    return pages.page_lines(fx.read(spark, sf, "documents"), "doc_id")


@query(
    "section_carry_forward",
    f"""WITH {_LINES}, carried AS (SELECT *, last_value(CASE WHEN pos%5=0 THEN line END IGNORE NULLS)
      OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS header FROM lines)
    SELECT doc_id, pos, header, line FROM carried WHERE pos%5 <> 0""",
)
def section_carry_forward(spark: SparkSession, sf: str) -> DataFrame:
    """Every fifth line of a document is taken as the header of the next four."""
    docs = fx.read(spark, sf, "documents").select("doc_id", pages.lines_of(F.col("text")).alias("lines"))
    return pages.carry_forward(docs, "doc_id", F.col("lines"), lambda line, i: i % 5 == 0)


_GRID = (
    "Présent Passé composé Imparfait Plus-que-parfait\nJe vais Je suis allé J'allais J'étais allé\n"
    "Tu vas Tu es allé Tu  Tu étais allé\n\nQue je sois Que nous soyons Sois ! (Tu) Soyons ! (Nous)\n"
    "Futur simple Futur antérieur\nNous irons Nous serons allés\n"
)
PAGES = f"""
pages_text AS (SELECT doc_id AS page, CASE WHEN doc_id%4<>0 THEN '• Verbe' || doc_id || ' To go ' || doc_id || chr(10) ELSE 'Contents' || chr(10) END
  || replace({sql.lit(_GRID.replace(chr(10), '~'))}, '~', chr(10)) || text AS text FROM documents),
headed AS (SELECT page, text, regexp_extract(text, {sql.lit(v.VERB_HEADING.replace('[^' + chr(92) + 'n]', '[^' + chr(10) + ']'))}, ['verb', 'meaning']) AS h FROM pages_text WHERE page%4<>0),
page_rows AS (SELECT page, h.verb AS verb, trim(h.meaning) AS meaning, line, i FROM
  (SELECT page, h, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM headed)
  WHERE {sql.strip('line')} <> ''),
under AS (SELECT *, CAST(row_number() OVER (PARTITION BY page ORDER BY i) - 1 AS INTEGER) AS pos,
  last_value(CASE WHEN line IN {sql.in_list(v.TENSE_HEADERS)} THEN line END IGNORE NULLS)
    OVER (PARTITION BY page ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS header,
  {' OR '.join(f'starts_with(line, {sql.lit(s)})' for s in v.SUBJUNCTIVE_OPENINGS)} AS subj FROM page_rows),
tenses AS (SELECT * FROM (VALUES {', '.join(f'({sql.lit(h)}, {i}, {sql.lit(t)})' for h, ts in v.TENSE_HEADERS.items() for i, t in enumerate(ts))}) t(header, slot, tense)),
matched AS (SELECT page, verb, meaning, pos, header, unnest(regexp_extract_all(line, {sql.lit(v.GRID_FORM)}, 1)) AS pronoun,
  unnest(regexp_extract_all(line, {sql.lit(v.GRID_FORM)}, 2)) AS raw, unnest(range(len(regexp_extract_all(line, {sql.lit(v.GRID_FORM)})))) AS slot
  FROM under WHERE header IS NOT NULL AND NOT subj AND line <> header),
grid AS (SELECT verb, meaning, tense, pronoun, {sql.strip('raw')} AS form, page, pos, CAST(m.slot AS INTEGER) AS slot
  FROM matched m JOIN tenses t ON t.header = m.header AND t.slot = m.slot WHERE {sql.strip('raw')} <> ''),
subjunctive AS (SELECT verb, meaning, {sql.lit(v.SUBJUNCTIVE_TENSE)} AS tense, unnest(regexp_extract_all(line, {sql.lit(v.SUBJUNCTIVE_FORM)}, 1)) AS pronoun,
  unnest(regexp_extract_all(line, {sql.lit(v.SUBJUNCTIVE_FORM)}, 2)) AS form, page, pos FROM under WHERE subj),
imperative AS (SELECT verb, meaning, {sql.lit(v.IMPERATIVE_TENSE)} AS tense, unnest(regexp_extract_all(line, {sql.lit(v.IMPERATIVE_FORM)}, 2)) AS pronoun,
  unnest(regexp_extract_all(line, {sql.lit(v.IMPERATIVE_FORM)}, 1)) AS form, page, pos FROM under WHERE subj),
records AS (SELECT verb, page FROM grid UNION ALL SELECT verb, page FROM subjunctive UNION ALL SELECT verb, page FROM imperative)"""


@query("page_headings", f"WITH {PAGES} SELECT page, h.verb AS verb, trim(h.meaning) AS meaning FROM headed")
def page_headings(spark: SparkSession, sf: str) -> DataFrame:
    return pages.page_headings(fx.pages_text(spark, sf))


@query("grid_records", f"WITH {PAGES} SELECT * FROM grid")
def grid_records(spark: SparkSession, sf: str) -> DataFrame:
    return pages.grid_records(pages.conjugation_lines(fx.pages_text(spark, sf)))


@query("subjunctive_records", f"WITH {PAGES} SELECT * FROM subjunctive")
def subjunctive_records(spark: SparkSession, sf: str) -> DataFrame:
    return pages.subjunctive_records(pages.conjugation_lines(fx.pages_text(spark, sf))).drop("slot")


@query("imperative_records", f"WITH {PAGES} SELECT * FROM imperative")
def imperative_records(spark: SparkSession, sf: str) -> DataFrame:
    return pages.imperative_records(pages.conjugation_lines(fx.pages_text(spark, sf))).drop("slot")


@query(
    "parse_summary",
    f"""WITH {PAGES} SELECT page, verb, count(*) AS forms FROM records GROUP BY page, verb
    UNION ALL SELECT NULL, CAST(count(DISTINCT verb) AS VARCHAR), count(*) FROM records""",
)
def parse_summary(spark: SparkSession, sf: str) -> DataFrame:
    return pages.parse_summary(pages.conjugation_records(fx.pages_text(spark, sf)))


# --- chunks ------------------------------------------------------------------

_PRONOUNS = "[" + ", ".join(sql.lit(p) for p in [*v.PRONOUN_ORDER, "On"]) + "]"
RECORDS = f"""
verb_records AS (SELECT 'Verb' || conv_id AS verb, 'to do ' || conv_id AS meaning, role || ' tense' AS tense,
  {_PRONOUNS}[(conv_id + 13 - turn%14)%14 + 1] AS pronoun, text AS form, conv_id AS page, turn AS pos FROM conversations),
ranked AS (SELECT *, coalesce(nullif(array_position({_PRONOUNS}[1:13], pronoun), 0) - 1, 99) AS rank FROM verb_records),
built AS (SELECT lower(verb) || '_' || replace(tense, ' ', '_') AS id, 'Verb: ' || verb || ' (' || min_by(meaning, pos) || ')' || chr(10) || 'Tense: ' || tense
    || chr(10) || string_agg(pronoun || ': ' || form, chr(10) ORDER BY rank, pos) AS text,
  verb, lower(verb) AS verb_lower, min_by(meaning, pos) AS meaning, tense, min_by(page, pos) AS page, count(*) AS num_forms
  FROM ranked GROUP BY verb, tense)"""


@query("chunk_build", f"WITH {RECORDS} SELECT * FROM built")
def chunk_build(spark: SparkSession, sf: str) -> DataFrame:
    return chunks.build_chunks(fx.verb_records(spark, sf)).select("id", "text", "metadata.*")


@query("custom_order", f"WITH {RECORDS} SELECT page, pos, pronoun, CAST(rank AS INTEGER) AS rank FROM ranked")
def custom_order(spark: SparkSession, sf: str) -> DataFrame:
    records = fx.verb_records(spark, sf)
    return records.select("page", "pos", "pronoun", chunks.custom_rank(F.col("pronoun")).alias("rank"))


@query("chunk_ids", f"WITH {RECORDS} SELECT page, pos, lower(verb) || '_' || replace(tense, ' ', '_') AS id FROM verb_records")
def chunk_ids(spark: SparkSession, sf: str) -> DataFrame:
    return fx.verb_records(spark, sf).select("page", "pos", chunks.chunk_id(F.col("verb"), F.col("tense")).alias("id"))


@query("chunk_stats", f"WITH {RECORDS} SELECT count(*) AS chunks, count(DISTINCT verb) AS verbs, count(DISTINCT tense) AS tenses FROM built")
def chunk_stats(spark: SparkSession, sf: str) -> DataFrame:
    return chunks.chunk_statistics(chunks.build_chunks(fx.verb_records(spark, sf)))


# --- vectors -----------------------------------------------------------------


@query(
    "vector_table_build",
    f"WITH {sql.VECTORS} SELECT verb_lower, count(*) AS vectors, min(vec_id) AS first_id, max(vec_id) AS last_id FROM cv GROUP BY verb_lower",
)
def vector_table_build(spark: SparkSession, sf: str) -> DataFrame:
    """Ids checked, table replaced, read back and counted."""
    path = scratch_path(spark, "vectors")
    rows = fx.chunk_vectors(spark, sf)
    keys.require_unique(rows.select("vec_id"), "vec_id")
    tables.write_table(rows, path)
    return spark.read.parquet(path).groupBy("verb_lower").agg(
        F.count(F.lit(1)).alias("vectors"), F.min("vec_id").alias("first_id"), F.max("vec_id").alias("last_id")
    )


@query(
    "l2_normalize",
    """WITH scaled AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: x * (vec_id + 2)) AS e FROM embeddings),
    unit AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM scaled)
    SELECT vec_id, unnest(range(len(e))) AS i, round(unnest(e) / norm, 6) AS x FROM unit""",
)
def l2_normalize(spark: SparkSession, sf: str) -> DataFrame:
    scaled = F.transform("embedding", lambda x: x.cast("double") * (F.col("vec_id") + 2))
    unit = fx.read(spark, sf, "embeddings").select("vec_id", vectors.l2_normalize(scaled).alias("e"))
    long = unit.select("vec_id", F.posexplode("e").alias("i", "x"))
    return long.select("vec_id", F.col("i").cast("bigint").alias("i"), F.round("x", 6).alias("x"))


@query("encode_batch")
def encode_batch(spark: SparkSession, sf: str) -> DataFrame:
    return encoding.encode_hashed(fx.read(spark, sf, "documents"), "doc_id")


@query("encode_batch_shape", "SELECT doc_id, 256 AS dimensions, true AS unit FROM documents")
def encode_batch_shape(spark: SparkSession, sf: str) -> DataFrame:
    """Every document has a vector of the declared length and of unit norm."""
    encoded = encoding.encode_hashed(fx.read(spark, sf, "documents"), "doc_id", dimensions=256)
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    return encoded.select("doc_id", F.size("embedding").alias("dimensions"), (F.abs(norm - 1) < 1e-6).alias("unit"))


@query("known_entities", "SELECT DISTINCT 'verb_' || label AS entity FROM embeddings")
def known_entities(spark: SparkSession, sf: str) -> DataFrame:
    return retrieval.known_entities(fx.chunk_vectors(spark, sf))


@query(
    "metadata_filter",
    f"""WITH {sql.VECTORS} SELECT query_id, count(c.vec_id) AS matches FROM qv q LEFT JOIN cv c
    ON (q.verb IS NULL OR q.verb = c.verb_lower) AND (q.tense IS NULL OR q.tense = c.tense) GROUP BY query_id""",
)
def metadata_filter(spark: SparkSession, sf: str) -> DataFrame:
    return retrieval.metadata_filter(fx.query_vectors(spark, sf), fx.chunk_vectors(spark, sf))


def _rounded(hits: DataFrame) -> DataFrame:
    return hits.withColumn("score", F.round("score", 6))


_TOP = "SELECT query_id, rank::INTEGER AS rank, vec_id, round(score, 6) AS score FROM top"


@query("knn_topk", f"WITH {sql.topk(5, False)} {_TOP}")
def knn_topk(spark: SparkSession, sf: str) -> DataFrame:
    q, c = fx.query_vectors(spark, sf), fx.chunk_vectors(spark, sf)
    return _rounded(retrieval.knn_topk(q, c, 5, filtered=False, exclude_self=True))


@query("knn_topk_filtered", f"WITH {sql.topk(3, True)} {_TOP}")
def knn_topk_filtered(spark: SparkSession, sf: str) -> DataFrame:
    q, c = fx.query_vectors(spark, sf), fx.chunk_vectors(spark, sf)
    return _rounded(retrieval.knn_topk(q, c, 3, exclude_self=True))


@query("knn_approx")
def knn_approx(spark: SparkSession, sf: str) -> DataFrame:
    q, c = fx.query_vectors(spark, sf), fx.chunk_vectors(spark, sf)
    return _rounded(retrieval.knn_approx(q, c, 5, exclude_self=True))


@query(
    "knn_approx_quality",
    f"""WITH {sql.topk(5, False)} SELECT count(*) AS exact_rows, (SELECT count(*) FROM qv) * (SELECT count(*) FROM cv) AS exact_pairs,
    true AS enough_found, true AS fewer_pairs FROM top""",
)
def knn_approx_quality(spark: SparkSession, sf: str) -> DataFrame:
    """The approximate search against the exact one: recall of 0.9 with fewer scored pairs."""
    q, c = fx.query_vectors(spark, sf), fx.chunk_vectors(spark, sf)
    exact = retrieval.knn_topk(q, c, 5, filtered=False, exclude_self=True).select("query_id", "vec_id")
    near = retrieval.knn_approx(q, c, 5, exclude_self=True).select("query_id", "vec_id", F.lit(1).alias("found"))
    recall = exact.join(near, ["query_id", "vec_id"], "left").agg(F.count(F.lit(1)).alias("n"), F.count("found").alias("hits"))
    return recall.join(retrieval.scored_pairs(q, c)).select(
        F.col("n").alias("exact_rows"), F.col("exact").alias("exact_pairs"),
        (F.col("hits") >= 0.9 * F.col("n")).alias("enough_found"), (F.col("approximate") < F.col("exact")).alias("fewer_pairs"),
    )


@query("knn_quantised")
def knn_quantised(spark: SparkSession, sf: str) -> DataFrame:
    q, c = fx.query_vectors(spark, sf), fx.chunk_vectors(spark, sf)
    return _rounded(retrieval.knn_quantised(q, c, 5, exclude_self=True))


@query(
    "knn_quantised_quality",
    f"""WITH {sql.topk(5, False)} SELECT count(*) AS exact_rows, true AS scores_are_exact, true AS enough_found FROM top""",
)
def knn_quantised_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Search by codes against the exact one: recall of 0.9 and true scores, with full products
    for a hundred vectors a query."""
    q, c = fx.query_vectors(spark, sf), fx.chunk_vectors(spark, sf)
    exact = retrieval.knn_topk(q, c, 5, filtered=False, exclude_self=True).select("query_id", "vec_id", F.col("score").alias("true"))
    near = retrieval.knn_quantised(q, c, 5, depth=100, exclude_self=True).select("query_id", "vec_id", "score")
    return exact.join(near, ["query_id", "vec_id"], "left").agg(
        F.count(F.lit(1)).alias("exact_rows"), F.coalesce(F.max(F.abs(F.col("score") - F.col("true"))) < 1e-6, F.lit(False)).alias("scores_are_exact"),
        (F.count("score") >= 0.9 * F.count(F.lit(1))).alias("enough_found"),
    )


# --- questions ---------------------------------------------------------------


@query("detect_entity", f"WITH {sql.QUESTIONS} SELECT question_id, verb AS entity FROM asked WHERE verb IS NOT NULL")
def detect_entity(spark: SparkSession, sf: str) -> DataFrame:
    entities = retrieval.known_entities(fx.chunk_vectors(spark, sf))
    return retrieval.detect_entity(fx.questions(spark, sf), entities)


@query("detect_keyword", f"WITH {sql.QUESTIONS} SELECT question_id, tense FROM asked")
def detect_keyword(spark: SparkSession, sf: str) -> DataFrame:
    return fx.questions(spark, sf).select("question_id", retrieval.detect_tense(F.col("question")).alias("tense"))


# a question's vector is that of a chunk chosen by rule, so that the search can be stated
# in SQL: the three nearest of the chunks that its filters admit
_HITS = sql.QUESTIONS + "," + sql.VECTORS + """,
asked_vectors AS (SELECT a.*, c.e FROM asked a JOIN cv c ON c.vec_id = a.question_id % (SELECT count(*) FROM cv)),
near AS (SELECT a.question_id, c.vec_id, c.verb_lower AS verb, c.tense, c.page, round(list_dot_product(a.e, c.e), 9) AS score
  FROM asked_vectors a JOIN cv c ON (a.verb IS NULL OR a.verb = c.verb_lower) AND (a.tense IS NULL OR a.tense = c.tense)),
hits AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, vec_id) AS rank FROM near
  QUALIFY row_number() OVER (PARTITION BY question_id ORDER BY score DESC, vec_id) <= 3)"""


def _hits(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(questions with filters, the chunks retrieved for them)."""
    vectors_ = fx.chunk_vectors(spark, sf)

    def encode(df: DataFrame, key: str, text: str, prefix: str) -> DataFrame:
        n = F.broadcast(vectors_.agg(F.count(F.lit(1)).alias("n")))
        keyed = df.drop(text).join(n).withColumn("nth", F.col(key) % F.col("n")).drop("n")
        return keyed.join(vectors_.select(F.col("vec_id").alias("nth"), "embedding"), "nth").drop("nth")

    return retrieval.retrieve(fx.questions(spark, sf), vectors_.drop("embedding"), encode, 3)


@query(
    "question_route",
    f"""WITH {_HITS}, found AS (SELECT question_id, count(*) AS n FROM hits GROUP BY question_id)
    SELECT question_id, CASE WHEN verb IS NOT NULL AND coalesce(n, 0) > 0
      AND NOT ({' OR '.join(f'contains(lower(question), {sql.lit(t)})' for t in v.EXPLANATION_TRIGGERS)}) THEN 'lookup' ELSE 'explain' END AS route
    FROM asked LEFT JOIN found USING (question_id)""",
)
def question_route(spark: SparkSession, sf: str) -> DataFrame:
    asked, hits = _hits(spark, sf)
    return retrieval.question_route(asked, hits.groupBy("question_id").agg(F.count(F.lit(1)).alias("hits")))


_FORMS = "'Je: form' || vec_id || chr(10) || 'Tu: form' || vec_id"


@query(
    "direct_answer",
    f"WITH {_HITS} SELECT question_id, '(' || tense || ')' || chr(10) || {_FORMS} AS answer FROM hits WHERE rank = 1",
)
def direct_answer(spark: SparkSession, sf: str) -> DataFrame:
    _, hits = _hits(spark, sf)
    return hits.filter("rank = 1").select("question_id", retrieval.direct_answer(F.col("text"), F.col("tense")).alias("answer"))


@query(
    "answer_sources",
    f"""WITH {_HITS} SELECT question_id, string_agg(verb || ' (' || tense || '), p.' || page, '; ' ORDER BY rank) AS sources FROM hits GROUP BY question_id""",
)
def answer_sources(spark: SparkSession, sf: str) -> DataFrame:
    return retrieval.answer_sources(_hits(spark, sf)[1])


@query(
    "context_assembly",
    f"""WITH {_HITS} SELECT question_id, string_agg('Verb: ' || verb || ' (to ' || vec_id || ')' || chr(10) || 'Tense: ' || tense || chr(10) || {_FORMS},
      chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS context FROM hits GROUP BY question_id""",
)
def context_assembly(spark: SparkSession, sf: str) -> DataFrame:
    return retrieval.context(_hits(spark, sf)[1])


@query(
    "answer_questions",
    f"""WITH {_HITS}, per AS (SELECT question_id, count(*) AS n,
      max('(' || tense || ')' || chr(10) || {_FORMS}) FILTER (rank = 1) AS answer,
      max(verb || ' (' || tense || '), p.' || page) FILTER (rank = 1) AS line,
      string_agg(verb || ' (' || tense || '), p.' || page, '; ' ORDER BY rank) AS lines,
      string_agg('Verb: ' || verb || ' (to ' || vec_id || ')' || chr(10) || 'Tense: ' || tense || chr(10) || {_FORMS},
        chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS documents FROM hits GROUP BY question_id),
    routed AS (SELECT question_id, verb IS NOT NULL AND coalesce(n, 0) > 0
      AND NOT ({' OR '.join(f'contains(lower(question), {sql.lit(t)})' for t in v.EXPLANATION_TRIGGERS)}) AS found, answer, line, lines, documents
      FROM asked LEFT JOIN per USING (question_id))
    SELECT question_id, CASE WHEN found THEN 'lookup' ELSE 'explain' END AS route, CASE WHEN found THEN answer END AS answer,
      CASE WHEN found THEN line ELSE coalesce(lines, '') END AS sources, CASE WHEN NOT found THEN coalesce(documents, '') END AS context
    FROM routed""",
)
def answer_questions(spark: SparkSession, sf: str) -> DataFrame:
    """Every question encoded, filtered, matched, routed and answered."""
    return retrieval.answer_questions(*_hits(spark, sf))


# --- accuracy ----------------------------------------------------------------

_JUDGED = sql.topk(1, True) + """,
judged AS (SELECT q.vec_id AS query_id, q.verb_lower AS expected_verb, q.tense AS expected_tense,
  coalesce(t.verb_lower, '') AS actual_verb, coalesce(t.tense, '') AS actual_tense,
  coalesce(q.verb_lower = t.verb_lower AND q.tense = t.tense, false) AS correct
  FROM cv q LEFT JOIN top t ON t.query_id = q.vec_id WHERE q.vec_id%50=0)"""


def judgements(spark: SparkSession, sf: str) -> DataFrame:
    """Each query should find a chunk of its own verb and tense; its filters may lack one."""
    cv, qv = fx.chunk_vectors(spark, sf), fx.query_vectors(spark, sf)
    expected = cv.filter("vec_id % 50 = 0").select(
        F.col("vec_id").alias("query_id"), F.col("verb_lower").alias("expected_verb"), F.col("tense").alias("expected_tense")
    )
    best = retrieval.knn_topk(qv, cv, 1, exclude_self=True).join(cv.select("vec_id", "verb_lower", "tense"), "vec_id")
    return retrieval.judged(expected, best, "query_id")


@query(
    "retrieval_accuracy",
    f"WITH {_JUDGED} SELECT count(*) AS questions, CAST(sum(correct::INT) AS BIGINT) AS correct, round(avg(correct::INT) * 100, 6) AS accuracy FROM judged",
)
def retrieval_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return retrieval.retrieval_accuracy(judgements(spark, sf))


@query("retrieval_failures", f"WITH {_JUDGED} SELECT * EXCLUDE (correct) FROM judged WHERE NOT correct")
def retrieval_failures(spark: SparkSession, sf: str) -> DataFrame:
    return retrieval.retrieval_failures(judgements(spark, sf))
