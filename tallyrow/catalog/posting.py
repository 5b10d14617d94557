"""Queries: posting flags, the relational table behind them and key checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyrow.catalog import sql
from tallyrow.catalog.registry import query
from tallyrow.functions import vocabulary as v
from tallyrow.operators import keys, postings
from tallyrow.operators.sizing import staged
from tallyrow.session import scratch_path
from tallyrow.sources import fixtures as fx, tables
from tallyrow.streaming import dedupe


def flagged(spark: SparkSession, sf: str) -> DataFrame:
    return postings.with_flags(fx.job_postings(spark, sf))


def _register_column(name: str) -> None:
    @query(name, f"WITH {sql.FLAGGED} SELECT job_id, {name} FROM flagged_postings")
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return flagged(spark, sf).select("job_id", name)


for _name in [*v.FLAGS, "description_word_count"]:
    _register_column(_name)


@query("fraud_signal_count", f"WITH {sql.FLAGGED} SELECT job_id, fraud_signal_count FROM flagged_postings")
def fraud_signal_count(spark: SparkSession, sf: str) -> DataFrame:
    return flagged(spark, sf).select("job_id", "fraud_signal_count")


@query("postings_clean", f"WITH {sql.FLAGGED} SELECT * FROM clean_postings")
def postings_clean(spark: SparkSession, sf: str) -> DataFrame:
    return postings.clean(flagged(spark, sf))


@query("conform_schema", f"WITH {sql.POSTINGS} SELECT job_id, title, NULL::VARCHAR AS location, fraudulent::BOOLEAN AS fraudulent, CAST(job_id AS VARCHAR) AS industry_id FROM (SELECT *, job_id AS industry_id FROM raw_postings)")
def conform_schema(spark: SparkSession, sf: str) -> DataFrame:
    raw = fx.job_postings(spark, sf).withColumn("industry_id", F.col("job_id"))
    declared = [("job_id", "bigint"), ("title", "string"), ("location", "string"), ("fraudulent", "boolean"), ("industry_id", "string")]
    return tables.conform(raw, declared)


@query(
    "postings_dedup",
    f"""WITH {sql.FLAGGED}, repeated AS (
      SELECT job_id, title, industry, job_id AS row_pos FROM raw_postings
      UNION ALL SELECT job_id, 'Reposted', industry, job_id + 1099511627776 FROM raw_postings WHERE job_id%10=0)
    SELECT job_id, title, industry FROM repeated QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY row_pos) = 1""",
)
def postings_dedup(spark: SparkSession, sf: str) -> DataFrame:
    repeated = fx.repeated_postings(fx.job_postings(spark, sf)).select("job_id", "title", "industry", "row_pos")
    return postings.keep_first(repeated, "job_id", "row_pos").drop("row_pos")


@query("fraud_rate", f"WITH {sql.FLAGGED} SELECT count(fraudulent) AS labelled, round(avg(fraudulent::INT), 6) AS fraud_rate FROM clean_postings")
def fraud_rate(spark: SparkSession, sf: str) -> DataFrame:
    return postings.fraud_rate(fx.job_postings(spark, sf).select("job_id", F.col("fraudulent").cast("boolean").alias("fraudulent")))


@query(
    "flag_rates_by_label",
    f"""WITH {sql.FLAGGED} SELECT fraudulent, {', '.join(f"round(avg({f}::INT), 3) AS {f.removeprefix('flag_')}_rate" for f in v.FLAGS)}
    FROM clean_postings GROUP BY fraudulent""",
)
def flag_rates_by_label(spark: SparkSession, sf: str) -> DataFrame:
    return postings.flag_rates_by_label(postings.clean(flagged(spark, sf)))


@query(
    "stage_counts",
    f"""WITH {sql.POSTINGS} SELECT 1 AS place, 'raw' AS stage, count(*) + count(*) FILTER (job_id%10=0) AS rows FROM raw_postings
    UNION ALL SELECT 2, 'one per key', count(*) FROM raw_postings
    UNION ALL SELECT 3, 'labelled', count(fraudulent) FROM raw_postings""",
)
def stage_counts(spark: SparkSession, sf: str) -> DataFrame:
    raw = fx.repeated_postings(fx.job_postings(spark, sf)).select("job_id", "row_pos", "fraudulent")
    first = postings.keep_first(raw, "job_id", "row_pos")
    return postings.stage_counts({"raw": raw, "one per key": first, "labelled": first.filter("fraudulent is not null")})


@query("load_relational", f"WITH {sql.FLAGGED} SELECT * FROM clean_postings")
def load_relational(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "job_postings")
    name = "job_postings_" + path.rsplit("-", 1)[1]
    tables.load_relational(postings.clean(flagged(spark, sf)), name, path)
    return spark.table(name)


@query(
    "pk_violations",
    f"""WITH {sql.POSTINGS} SELECT job_id AS key, 2::BIGINT AS rows FROM raw_postings WHERE job_id%10=0""",
)
def pk_violations(spark: SparkSession, sf: str) -> DataFrame:
    return keys.pk_violations(fx.repeated_postings(fx.job_postings(spark, sf)), "job_id")


@query(
    "fk_violations",
    """SELECT l_orderkey AS key, count(*) AS rows FROM lineitem
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderkey%97<>0) GROUP BY l_orderkey""",
)
def fk_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Line items against orders from which every 97th was removed."""
    parents = fx.read(spark, sf, "orders").filter(F.col("o_orderkey") % 97 != 0)
    return keys.fk_violations(fx.read(spark, sf, "lineitem"), "l_orderkey", parents, "o_orderkey")


@query("postings_by_signal", f"WITH {sql.FLAGGED} SELECT job_id, title, fraud_signal_count FROM clean_postings WHERE fraud_signal_count >= 4")
def postings_by_signal(spark: SparkSession, sf: str) -> DataFrame:
    """A look-up in the stored table: the filter reaches its files, not the searches."""
    table = staged(postings.clean(flagged(spark, sf)), "postings")
    return postings.by_signal(table, 4).select("job_id", "title", "fraud_signal_count")


@query("postings_by_industry", f"WITH {sql.FLAGGED} SELECT job_id, title, industry FROM clean_postings WHERE industry = 'src1'")
def postings_by_industry(spark: SparkSession, sf: str) -> DataFrame:
    """Written with a folder per industry; the filter then reads one folder."""
    path = scratch_path(spark, "by_industry")
    tables.write_partitioned(fx.job_postings(spark, sf).select("job_id", "title", "industry"), path, "industry")
    return postings.by_industry(spark.read.parquet(path), "src1")


@query(
    "stream_dedupe",
    "SELECT event_id, user_id, event_type, value FROM events",
)
def stream_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """Events in several files out of time order, read file by file as a stream, every
    fifth sent twice, deduplicated by key."""
    events, path = fx.read(spark, sf, "events"), scratch_path(spark, "event_files")
    events.repartition(4, "event_id").write.parquet(path)
    stream = dedupe.file_stream(spark, path, events.schema, max_files=1)
    copies = F.when(F.col("event_id") % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    twice = stream.withColumn("copy", F.explode(copies)).drop("copy")
    once = dedupe.dedupe_stream(twice, "event_id", "ts", None)
    return dedupe.run_to_table(once.select("event_id", "user_id", "event_type", "value"), "events")


@query(
    "stream_dedupe_late",
    """WITH sent AS (SELECT event_id, ts, user_id, event_type, value, event_id % 3 AS step FROM events
      UNION ALL SELECT event_id, ts, user_id, event_type, value, (event_id + 1) % 3 FROM events WHERE event_id % 5 = 0),
    marks AS (SELECT step, max(max(epoch_ms(ts))) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 10 * 86400000 AS mark FROM sent GROUP BY step),
    judged AS (SELECT sent.*, coalesce(epoch_ms(ts) < mark, false) AS late FROM sent JOIN marks USING (step))
    SELECT event_id, user_id, event_type, value, late FROM judged WHERE late
    UNION ALL SELECT DISTINCT event_id, user_id, event_type, value, late FROM judged WHERE NOT late""",
)
def stream_dedupe_late(spark: SparkSession, sf: str) -> DataFrame:
    """Events that arrive in three steps out of time order, every fifth once more in another
    step: the first of each key within ten days, and all that came too late, as rows."""
    events, path = fx.read(spark, sf, "events"), scratch_path(spark, "late_events")
    sent = events.withColumn("step", F.col("event_id") % 3)
    sent = sent.unionByName(events.filter("event_id % 5 = 0").withColumn("step", (F.col("event_id") + 1) % 3))
    with dedupe.keyed_state(spark):
        for step in range(3):
            sent.filter(F.col("step") == step).drop("step").write.mode("append").parquet(path + "/in")
            told = dedupe.dedupe_with_late(dedupe.file_stream(spark, path + "/in", events.schema), "event_id", "ts", "10 days")
            dedupe.run_available(told, path + "/data", path + "/checkpoint")
    return spark.read.schema(told.schema).parquet(path + "/data").select("event_id", "user_id", "event_type", "value", "late")
