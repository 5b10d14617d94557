"""Queries: what is written by a sink and read by a source comes back as it was."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyrow.catalog import sql
from tallyrow.catalog.plans import PLAN, pairs_text, proposed
from tallyrow.catalog.posting import flagged
from tallyrow.catalog.registry import query
from tallyrow.catalog.retrieving import RECORDS
from tallyrow.operators import chunks, evaluation, fixes, postings
from tallyrow.operators.retrieval import detect_tense
from tallyrow.operators.sizing import staged
from tallyrow.session import scratch_path
from tallyrow.sources import fixtures as fx, tables

def _quoted(name: str) -> str:
    return f'"{name}"'


RAW = ["title", "industry", "function", "description", "requirements", "benefits", "company_profile", "salary_range"]


@query(
    "raw_postings_csv",
    f"""WITH {sql.POSTINGS} SELECT job_id, {', '.join(f"nullif({_quoted(c)}, '') AS {_quoted(c)}" for c in RAW)}, CAST(has_company_logo AS BIGINT) AS has_company_logo,
    CAST(fraudulent AS BIGINT) AS fraudulent FROM raw_postings""",
)
def raw_postings_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Free text with line ends and quotes; an empty cell is read as missing."""
    path = scratch_path(spark, "raw") + ".csv"
    tables.write_table(fx.job_postings(spark, sf), path, "csv")
    return tables.load_table(spark, path).select("job_id", *RAW, F.col("has_company_logo").cast("bigint"), F.col("fraudulent").cast("bigint"))


@query("clean_postings_csv", f"WITH {sql.FLAGGED} SELECT * FROM clean_postings")
def clean_postings_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The hand-off between two stages, read under the schema it was written with."""
    path = scratch_path(spark, "clean") + ".csv"
    clean = postings.clean(flagged(spark, sf))
    tables.write_table(clean, path, "csv")
    return tables.load_table(spark, path, schema=clean.schema)


@query(
    "cleaned_copy",
    f"""WITH {sql.MESSY} SELECT order_id, {sql.strip('city')} AS city, false AS from_source, true AS source_refused FROM messy
    UNION ALL SELECT order_id, city, true, true FROM messy""",
)
def cleaned_copy(spark: SparkSession, sf: str) -> DataFrame:
    """The copy holds the fix, the source what it held, and no copy is written over a source."""
    source = scratch_path(spark, "orders") + ".csv"
    tables.write_table(fx.messy_orders(spark, sf).select("order_id", "city"), source, "csv")
    raw = tables.load_table(spark, source)
    fixed = fixes.apply_fix(raw, {"action": "strip_whitespace", "column": "city"})
    target = tables.write_copy(fixed, source, source.replace(".csv", "_clean.csv"))
    try:
        tables.write_copy(fixed, source, source)
        refused = False
    except ValueError:
        refused = True
    parts = [tables.load_table(spark, p).withColumn("from_source", F.lit(own)) for p, own in ((target, False), (source, True))]
    return parts[0].unionByName(parts[1]).withColumn("source_refused", F.lit(refused))


@query(
    "processed_tables",
    f"WITH {sql.FLAGGED}, f AS (SELECT unnest(['csv', 'json', 'parquet']) AS format) SELECT format, job_id, title, fraud_signal_count FROM clean_postings, f",
)
def processed_tables(spark: SparkSession, sf: str) -> DataFrame:
    """One table in each format, read by its suffix."""
    clean, parts = staged(postings.clean(flagged(spark, sf)).select("job_id", "title", "fraud_signal_count"), "clean"), []
    for fmt, suffix in (("csv", "csv"), ("json", "jsonl"), ("parquet", "parquet")):
        path = f"{scratch_path(spark, 'processed')}.{suffix}"
        tables.write_table(clean, path, fmt)
        back = tables.load_table(spark, path, schema=clean.schema)
        parts.append(back.select(F.lit(fmt).alias("format"), "job_id", "title", "fraud_signal_count"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("chunks_json", f"WITH {RECORDS} SELECT * FROM built")
def chunks_json(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "chunks")
    tables.write_chunks(chunks.build_chunks(fx.verb_records(spark, sf)), path)
    return tables.read_chunks(spark, path).select("id", "text", "metadata.*")


@query(
    "plan_document",
    f"""WITH {PLAN}, kept AS (SELECT * FROM plan WHERE action <> 'no_action')
    SELECT CAST(row_number() OVER (ORDER BY n) AS INTEGER) AS n, array_to_string(issue_ids, ',') AS issue_ids, action, "column",
    coalesce(array_to_string(list_transform(replacements, lambda r: r.from_value || '=>' || r.to_value), '; '), '') AS replacements FROM kept""",
)
def plan_document(spark: SparkSession, sf: str) -> DataFrame:
    """The approved fixes come back from the document numbered by position, without the rejected ones."""
    _, _, plan = proposed(spark, sf)
    path = scratch_path(spark, "plan")
    tables.write_plan(plan.filter("action <> 'no_action'"), plan.filter("action = 'no_action'"), "orders", path)
    return tables.read_plan(spark, path).select("n", F.concat_ws(",", "issue_ids").alias("issue_ids"), "action", "column", pairs_text().alias("replacements"))


@query("evaluation_csv", f"WITH {sql.QUESTIONS} SELECT question, 'verb_' || (question_id % 10) AS expected_verb, tense AS expected_tense FROM asked")
def evaluation_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "questions") + ".csv"
    asked = fx.questions(spark, sf)
    verb = F.concat(F.lit("verb_"), (F.col("question_id") % 10).cast("string"))
    rows = asked.select("question", verb.alias("expected_verb"), detect_tense(F.col("question")).alias("expected_tense"))
    tables.write_table(rows, path, "csv")
    return tables.read_questions(spark, path)


@query("news_csv", "SELECT doc_id, text, CASE quality WHEN 1 THEN 'REAL' ELSE 'FAKE' END AS label FROM documents JOIN labels USING (doc_id)")
def news_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "news") + ".csv"
    tables.write_table(fx.news(spark, sf), path, "csv")
    return tables.load_table(spark, path)


@query(
    "label_guard",
    f"WITH {sql.POSTINGS} SELECT fraudulent IS NOT NULL AS labelled, count(*) AS rows, fraudulent IS NULL AS stopped FROM raw_postings GROUP BY ALL",
)
def label_guard(spark: SparkSession, sf: str) -> DataFrame:
    """Training stops on rows without any label, and only there."""
    raw, out = fx.job_postings(spark, sf), []
    for labelled in (True, False):
        rows = raw.filter(F.col("fraudulent").isNotNull() == labelled)
        try:
            evaluation.require_labels(rows, "fraudulent")
            stopped = False
        except ValueError:
            stopped = True
        out.append(rows.groupBy(F.lit(labelled).alias("labelled")).agg(F.count(F.lit(1)).alias("rows"), F.lit(stopped).alias("stopped")))
    return out[0].unionByName(out[1])
