"""Queries: sources, slices and the data-quality scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyrow.catalog import sql
from tallyrow.catalog.registry import query
from tallyrow.functions import vocabulary as v
from tallyrow.operators import checks, profile, slices
from tallyrow.operators.sizing import staged
from tallyrow.session import scratch_path
from tallyrow.sources import fixtures as fx, tables

POS = "row_pos"


def messy_table(spark: SparkSession, sf: str) -> DataFrame:
    """The dirty orders as a written table: a scan reads it several times, a few
    columns at a time, and should not repeat the join behind it."""
    return staged(fx.messy_orders(spark, sf), "messy")


def flat(issues: DataFrame) -> DataFrame:
    return issues.withColumn("examples", F.concat_ws(" | ", "examples"))


@query("messy_orders", f"WITH {sql.MESSY} SELECT * FROM messy")
def messy_orders(spark: SparkSession, sf: str) -> DataFrame:
    return fx.messy_orders(spark, sf)


@query(
    "load_table",
    f"""WITH {sql.MESSY} SELECT order_id, customer_name, city, order_date, quantity, amount, email, currency FROM messy""",
)
def load_table(spark: SparkSession, sf: str) -> DataFrame:
    """Dirty orders written as CSV under padded headers, then loaded."""
    path = scratch_path(spark, "messy") + ".csv"
    messy = fx.messy_orders(spark, sf).drop(POS)
    padded = messy.toDF(*[f" {c} " for c in messy.columns])
    tables.write_table(padded, path, "csv")
    return tables.load_table(spark, path)


@query("table_shape", "SELECT count(*) AS max_row, 6 AS max_column FROM part")
def table_shape(spark: SparkSession, sf: str) -> DataFrame:
    return slices.shape(fx.read(spark, sf, "part"))


@query(
    "table_block",
    """SELECT row_number() OVER (ORDER BY p_partkey) AS ordinal, p_partkey, p_name, p_brand, p_type, p_size, p_retailprice
       FROM part ORDER BY p_partkey LIMIT 11""",
)
def table_block(spark: SparkSession, sf: str) -> DataFrame:
    return slices.block(fx.read(spark, sf, "part"), "p_partkey", (1, 11), (1, 6))


@query(
    "table_deep_block",
    "SELECT ordinal, o_custkey, o_totalprice FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS ordinal FROM orders) WHERE ordinal BETWEEN 1000 AND 1010",
)
def table_deep_block(spark: SparkSession, sf: str) -> DataFrame:
    """Rows found by counts of key ranges, as far into the table as they may be."""
    orders = fx.read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return slices.block(orders, "o_orderkey", (1000, 1010), (2, 3), direct_rows=0)


@query("table_column_range", "SELECT * FROM (SELECT row_number() OVER (ORDER BY p_partkey) AS ordinal, p_name FROM part) WHERE ordinal BETWEEN 2 AND 11")
def table_column_range(spark: SparkSession, sf: str) -> DataFrame:
    return slices.block(fx.read(spark, sf, "part"), "p_partkey", (2, 11), (2, 2))


@query("table_cell", "SELECT p_partkey FROM part ORDER BY p_partkey LIMIT 1")
def table_cell(spark: SparkSession, sf: str) -> DataFrame:
    return slices.cell(fx.read(spark, sf, "part"), "p_partkey", 1, 1)


@query("head_rows", "SELECT doc_id, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT 5")
def head_rows(spark: SparkSession, sf: str) -> DataFrame:
    return slices.head(fx.read(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars"), "doc_id")


def _padded(column: str, width: int) -> str:
    return f"CASE WHEN length({column}) < {width} THEN rpad({column}, {width}, ' ') ELSE {column} END"


_LINE_COLUMNS = ["order_id", "customer_name", "city", "order_date", "amount", "email"]


@query(
    "fixed_width_rows",
    f"""WITH {sql.MESSY} SELECT row_pos, {' || '.join(_padded(f'CAST({c} AS VARCHAR)', w) for c, w in zip(_LINE_COLUMNS, v.LINE_WIDTHS))} AS line
    FROM messy WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _LINE_COLUMNS)}""",
)
def fixed_width_rows(spark: SparkSession, sf: str) -> DataFrame:
    return slices.fixed_width(fx.messy_orders(spark, sf), _LINE_COLUMNS).select(POS, "line")


_ISSUE_KINDS = {
    "dq_duplicate_rows": ["duplicate_rows"],
    "dq_constant_column": ["constant_column"],
    "dq_missing": ["missing"],
    "dq_outliers": ["outliers"],
    "dq_negative_values": ["negative_values"],
    "dq_placeholders": ["placeholder_missing"],
    "dq_whitespace": ["whitespace"],
    "dq_numeric_formatting": ["numeric_formatting"],
    "dq_invalid_dates": ["invalid_dates"],
    "dq_category_variants": ["category_variants"],
}


def _register_kind(name: str, kinds: list[str]) -> None:
    oracle = f"""WITH {sql.MESSY_SCAN} SELECT kind, "column", severity, detail, affected, examples
        FROM issues WHERE kind IN {sql.in_list(kinds)}"""

    @query(name, oracle)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        found = checks.scan(messy_table(spark, sf), POS, kinds)
        return flat(found).drop("id")


for _name, _kinds in _ISSUE_KINDS.items():
    _register_kind(_name, _kinds)


# amounts as text with some words among them, and dates few enough to count only by name
_MIXED = """
mixed AS (
  SELECT o_orderkey AS row_pos, CASE WHEN o_orderkey%7=0 THEN 'ask' || (o_orderkey%3) WHEN o_orderkey%11=0 THEN '$ ' || o_custkey
      ELSE CAST(o_custkey AS VARCHAR) END AS price_text,
    CASE WHEN o_orderkey%2=0 THEN 'week ' || (o_orderkey%50) ELSE strftime(o_orderdate, '%m/%d/%Y') END AS ship_date,
    o_totalprice AS total
  FROM orders)"""


def mixed_orders(spark: SparkSession, sf: str) -> DataFrame:
    o = fx.read(spark, sf, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias(POS),
        F.when(k % 7 == 0, F.concat(F.lit("ask"), (k % 3).cast("string")))
        .when(k % 11 == 0, F.concat(F.lit("$ "), F.col("o_custkey").cast("string")))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("price_text"),
        F.when(k % 2 == 0, F.concat(F.lit("week "), (k % 50).cast("string")))
        .otherwise(F.date_format("o_orderdate", "MM/dd/yyyy"))
        .alias("ship_date"),
        F.col("o_totalprice").alias("total"),
    )


_MIXED_SCAN = _MIXED + "," + sql.scan("mixed", ["price_text", "ship_date", "total"], ["total"])


@query(
    "dq_non_numeric",
    f"""WITH {_MIXED_SCAN} SELECT kind, "column", severity, detail, affected, examples FROM issues
    WHERE kind IN ('non_numeric_in_numeric', 'numeric_formatting')""",
)
def dq_non_numeric(spark: SparkSession, sf: str) -> DataFrame:
    kinds = ["non_numeric_in_numeric", "numeric_formatting"]
    return flat(checks.scan(mixed_orders(spark, sf), POS, kinds)).drop("id")


@query(
    "dq_invalid_dates_named",
    f"""WITH {_MIXED_SCAN} SELECT kind, "column", severity, detail, affected, examples FROM issues
    WHERE kind = 'invalid_dates'""",
)
def dq_invalid_dates_named(spark: SparkSession, sf: str) -> DataFrame:
    return flat(checks.scan(mixed_orders(spark, sf), POS, ["invalid_dates"])).drop("id")


_EVENTS = "SELECT event_id AS row_pos, user_id, event_type, value, props FROM events"


@query(
    "dq_scan_events",
    f"""WITH ev AS ({_EVENTS}), {sql.scan('ev', ['user_id', 'event_type', 'value', 'props'], ['user_id', 'value'])}
    SELECT id, kind, "column", severity, affected FROM issues""",
)
def dq_scan_events(spark: SparkSession, sf: str) -> DataFrame:
    ev = fx.read(spark, sf, "events").select(F.col("event_id").alias(POS), "user_id", "event_type", "value", "props")
    return checks.scan(ev, POS).select("id", "kind", "column", "severity", "affected")


@query(
    "dq_numeric_text_share",
    f"""WITH {sql.MESSY_SCAN} SELECT col AS "column", class, round(nl / nf, 6) AS numeric_share FROM classed WHERE is_text AND nf > 0""",
)
def dq_numeric_text_share(spark: SparkSession, sf: str) -> DataFrame:
    messy = fx.messy_orders(spark, sf)
    c = profile.text_class(profile.pinned_counters(messy, POS))
    categories = [r["column"] for r in c.filter("class = 'category'").collect()]
    over = profile.wide_columns(messy, categories, POS)
    wide = F.when((F.col("class") == "category") & F.col("column").isin(over), "wide").otherwise(F.col("class"))
    return c.filter("is_text and filled > 0").select(
        "column", wide.alias("class"), F.round(F.col("loose_numbers") / F.col("filled"), 6).alias("numeric_share")
    )


@query(
    "dq_issue_ranking",
    f"""WITH {sql.MESSY_SCAN} SELECT id, kind, "column", severity, affected FROM issues""",
)
def dq_issue_ranking(spark: SparkSession, sf: str) -> DataFrame:
    return checks.scan(messy_table(spark, sf), POS).select("id", "kind", "column", "severity", "affected")


@query("dq_examples", f"""WITH {sql.MESSY_SCAN} SELECT id, kind, "column", examples FROM issues""")
def dq_examples(spark: SparkSession, sf: str) -> DataFrame:
    return flat(checks.scan(messy_table(spark, sf), POS)).select("id", "kind", "column", "examples")


@query("dq_scan", f"WITH {sql.MESSY_SCAN} SELECT * FROM issues")
def dq_scan(spark: SparkSession, sf: str) -> DataFrame:
    return flat(checks.scan(messy_table(spark, sf), POS))


@query(
    "dq_report_lines",
    f"""WITH {sql.MESSY_SCAN}
    SELECT 0 AS line_no, 'Scanned ' || regexp_replace(CAST((SELECT count(*) FROM messy) AS VARCHAR), '([0-9])([0-9]{{3}})$', '\\1,\\2')
      || ' rows x 8 columns: ' || count(*) || ' issues found' AS line FROM issues
    UNION ALL
    SELECT CAST(substr(id, 2) AS BIGINT), '[' || id || '] ' || rpad(upper(severity), 6, ' ') || ' ' || rpad(kind, 24, ' ') || ' '
      || coalesce("column", '(whole table)') || ' | ' || detail
      || CASE WHEN examples <> '' THEN ' | examples: ' || replace(examples, ' | ', '; ') ELSE '' END
    FROM issues""",
)
def dq_report_lines(spark: SparkSession, sf: str) -> DataFrame:
    messy = messy_table(spark, sf)
    return checks.report_lines(checks.scan(messy, POS), messy.count(), len(messy.columns) - 1)


@query(
    "column_profile",
    f"""WITH {sql.MESSY}, values_ AS (
      {' UNION ALL '.join(f"SELECT '{c}' AS col, {c} AS value, count(*) AS n FROM messy WHERE {c} IS NOT NULL GROUP BY {c}" for c in sql.MESSY_TEXT)}),
    placed AS (SELECT *, row_number() OVER (PARTITION BY col ORDER BY n DESC, value) AS place, count(*) OVER (PARTITION BY col) AS d FROM values_)
    SELECT col AS "column", 'text' AS kind, NULL::DOUBLE AS low, NULL::DOUBLE AS high, d AS distinct_values, value, n
    FROM placed WHERE d <= 40 OR place <= 5
    UNION ALL SELECT 'order_id', 'numeric', min(order_id), max(order_id), NULL, NULL, NULL FROM messy
    UNION ALL SELECT 'quantity', 'numeric', min(quantity), max(quantity), NULL, NULL, NULL FROM messy""",
)
def column_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.column_profile(messy_table(spark, sf), POS)


@query(
    "column_profile_customer",
    """SELECT 'c_acctbal' AS "column", 'numeric' AS kind, min(c_acctbal) AS low, max(c_acctbal) AS high,
       NULL::BIGINT AS distinct_values, NULL AS value, NULL::BIGINT AS n FROM customer
       UNION ALL SELECT 'c_mktsegment', 'text', NULL, NULL, (SELECT count(DISTINCT c_mktsegment) FROM customer), c_mktsegment, count(*)
       FROM customer GROUP BY c_mktsegment""",
)
def column_profile_customer(spark: SparkSession, sf: str) -> DataFrame:
    return profile.column_profile(fx.read(spark, sf, "customer").select("c_acctbal", "c_mktsegment"))
