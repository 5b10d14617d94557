"""Queries: the fix actions one by one, and the whole clean-up of the dirty orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyrow.catalog import sql
from tallyrow.catalog.quality import POS, messy_table
from tallyrow.catalog.registry import query
from tallyrow.functions import vocabulary as v
from tallyrow.operators import checks, fixes
from tallyrow.operators.sizing import staged
from tallyrow.session import scratch_path
from tallyrow.sources import fixtures as fx, tables


def _fixed(spark: SparkSession, sf: str, column: str, action: str, **arguments) -> DataFrame:
    """(row_pos, column) after one fix, tables being pruned to these two columns."""
    narrow = fx.messy_orders(spark, sf).select(POS, column)
    return fixes.apply_fix(narrow, {"action": action, "column": column, **arguments})


@query("fix_strip", f"WITH {sql.MESSY} SELECT row_pos, {sql.strip('city')} AS city FROM messy")
def fix_strip(spark: SparkSession, sf: str) -> DataFrame:
    return _fixed(spark, sf, "city", "strip_whitespace")


@query("fix_placeholders", f"WITH {sql.MESSY} SELECT row_pos, CASE WHEN NOT {sql.placeholder('email')} THEN email END AS email FROM messy")
def fix_placeholders(spark: SparkSession, sf: str) -> DataFrame:
    return _fixed(spark, sf, "email", "placeholders_to_null")


_CITY_PAIRS = [("GENEVA", "geneva"), ("lisboa", "Lisbon"), ("Lisbon", "Lisbon City"), (" GENEVA", "Geneva")]


@query(
    "fix_standardize",
    f"""WITH {sql.MESSY} SELECT row_pos, CASE {sql.strip('city')} WHEN 'GENEVA' THEN 'Geneva' WHEN 'lisboa' THEN 'Lisbon'
    WHEN 'Lisbon' THEN 'Lisbon City' ELSE city END AS city FROM messy""",
)
def fix_standardize(spark: SparkSession, sf: str) -> DataFrame:
    pairs = [{"from_value": a, "to_value": b} for a, b in _CITY_PAIRS]
    return _fixed(spark, sf, "city", "standardize_values", replacements=pairs)


@query("fix_convert_numeric", f"WITH {sql.MESSY} SELECT row_pos, {sql.loose_number('amount')} AS amount FROM messy")
def fix_convert_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return _fixed(spark, sf, "amount", "convert_numeric")


@query("fix_parse_dates", f"WITH {sql.MESSY} SELECT row_pos, strftime({sql.any_date('order_date')}, '%Y-%m-%d') AS order_date FROM messy")
def fix_parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    return _fixed(spark, sf, "order_date", "parse_dates").withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd"))


# one order in SPELLINGS each; the last one is no date
SPELLINGS = [
    "yyyy-MM-dd", "yyyy-M-d H:mm", "yyyy-MM-dd'T'HH:mm:ss", "yyyy/M/d", "yyyy.MM.dd", "yyyyMMdd", "M/d/yyyy", "MM-dd-yyyy", "MM/dd/yyyy HH:mm:ss",
    "M/d/yy", "MMM d yyyy", "MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy", "d MMMM yyyy", "dd-MMM-yyyy", "yyyy-MM-dd HH:mm:ss.SSS", "yyyy-MM-dd'T'HH:mm:ss'Z'",
    "M/d/yyyy h:mm a", "yyyy-MM-dd hh:mm:ss a", "EEEE, MMMM d, yyyy", "EEE MMM d yyyy", "d'th' MMMM yyyy", "MMMM d'th', yyyy", "yyyyMMdd'T'HHmmss",
    "d'th of' MMMM yyyy", "yyyy-MMM-dd", "d-MMM-yy", "MM/dd/yy h:mma", "yyyy-MM-dd HH:mm:ss'+00:00'", "yyyy MMM d",
]


def _spelled(spark: SparkSession, sf: str) -> DataFrame:
    orders = fx.read(spark, sf, "orders")
    text = F.lit("31/02/2024")
    for i, fmt in enumerate(SPELLINGS):
        text = F.when(F.col("o_orderkey") % (len(SPELLINGS) + 1) == i, F.date_format("o_orderdate", fmt)).otherwise(text)
    return orders.select("o_orderkey", text.alias("spelled"))


@query(
    "fix_parse_date_spellings",
    f"SELECT o_orderkey, CASE WHEN o_orderkey % {len(SPELLINGS) + 1} < {len(SPELLINGS)} THEN strftime(o_orderdate, '%Y-%m-%d') END AS parsed FROM orders",
)
def fix_parse_date_spellings(spark: SparkSession, sf: str) -> DataFrame:
    """Order dates written in every spelling come back as they were."""
    done = fixes.apply_fix(_spelled(spark, sf), {"action": "parse_dates", "column": "spelled"})
    return done.select("o_orderkey", F.date_format("spelled", "yyyy-MM-dd").alias("parsed"))


MONTH_SPELLINGS = ["MMM yyyy", "MMMM yyyy", "yyyy-MM", "yyyy/M", "M/yyyy"]


@query("fix_parse_month_spellings", "SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS parsed FROM orders")
def fix_parse_month_spellings(spark: SparkSession, sf: str) -> DataFrame:
    """A month without a day is its first day."""
    text = F.lit(None)
    for i, fmt in enumerate(MONTH_SPELLINGS):
        text = F.when(F.col("o_orderkey") % len(MONTH_SPELLINGS) == i, F.date_format("o_orderdate", fmt)).otherwise(text)
    months = fx.read(spark, sf, "orders").select("o_orderkey", text.alias("month"))
    done = fixes.apply_fix(months, {"action": "parse_dates", "column": "month"})
    return done.select("o_orderkey", F.date_format("month", "yyyy-MM-dd").alias("parsed"))


@query(
    "dq_invalid_date_spellings",
    f"SELECT 'invalid_dates' AS kind, count(*) AS affected FROM orders WHERE o_orderkey % {len(SPELLINGS) + 1} = {len(SPELLINGS)}",
)
def dq_invalid_date_spellings(spark: SparkSession, sf: str) -> DataFrame:
    """The scan finds the column of all spellings to hold dates, and only the impossible one wrong."""
    spelled = staged(_spelled(spark, sf), "spelled").withColumnRenamed("spelled", "order_date")
    found = checks.scan(spelled.withColumnRenamed("o_orderkey", "pos"), "pos", ["invalid_dates"])
    return found.select("kind", "affected")


@query("fix_nullify_negative", "SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal FROM customer")
def fix_nullify_negative(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.read(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return fixes.apply_fix(df, {"action": "nullify_values", "column": "c_acctbal", "rule": "negative"})


_EVENT_LIMITS = """limits AS (SELECT q1 - 3*(q3-q1) AS lo, q3 + 3*(q3-q1) AS hi FROM
  (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events))"""


@query("fix_nullify_outlier", f"WITH {_EVENT_LIMITS} SELECT event_id, CASE WHEN value BETWEEN lo AND hi THEN value END AS value FROM events, limits")
def fix_nullify_outlier(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.read(spark, sf, "events").select("event_id", "value")
    return fixes.apply_fix(df, {"action": "nullify_values", "column": "value", "rule": "outlier"})


def _gappy(spark: SparkSession, sf: str) -> DataFrame:
    """Events with a third of the values and types missing."""
    e = fx.read(spark, sf, "events")
    gap = F.col("event_id") % 3 == 0
    return e.select("event_id", F.when(~gap, F.col("value")).alias("value"), F.when(~gap, F.col("event_type")).alias("event_type"))


_GAPPY = "gappy AS (SELECT event_id, CASE WHEN event_id%3<>0 THEN value END AS value, CASE WHEN event_id%3<>0 THEN event_type END AS event_type FROM events)"


@query("fix_fill_median", f"WITH {_GAPPY} SELECT event_id, round(coalesce(value, (SELECT median(value) FROM gappy)), 6) AS value FROM gappy")
def fix_fill_median(spark: SparkSession, sf: str) -> DataFrame:
    df = _gappy(spark, sf).select("event_id", "value")
    return fixes.apply_fix(df, {"action": "fill_missing", "column": "value", "fill": "median"}).withColumn("value", F.round("value", 6))


@query(
    "fix_fill_mode",
    f"""WITH {_GAPPY} SELECT event_id, coalesce(event_type, (SELECT event_type FROM gappy WHERE event_type IS NOT NULL
    GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1)) AS event_type FROM gappy""",
)
def fix_fill_mode(spark: SparkSession, sf: str) -> DataFrame:
    df = _gappy(spark, sf).select("event_id", "event_type")
    return fixes.apply_fix(df, {"action": "fill_missing", "column": "event_type", "fill": "mode"})


@query("fix_fill_constant", f"WITH {_GAPPY} SELECT event_id, coalesce(value, 7.5) AS value, coalesce(event_type, 'none given') AS event_type FROM gappy")
def fix_fill_constant(spark: SparkSession, sf: str) -> DataFrame:
    df = fixes.apply_fix(_gappy(spark, sf), {"action": "fill_missing", "column": "value", "fill": "constant", "constant": "7.5"})
    return fixes.apply_fix(df, {"action": "fill_missing", "column": "event_type", "fill": "constant", "constant": "none given"})


_KEPT = ", ".join(sql.MESSY_ORDER)


@query("fix_drop_duplicates", f"WITH {sql.MESSY} SELECT {_KEPT}, min(row_pos) AS row_pos FROM messy GROUP BY {_KEPT}")
def fix_drop_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return fixes.drop_duplicate_rows(fx.messy_orders(spark, sf), POS)


@query("fix_drop_column", f"WITH {sql.MESSY} SELECT * EXCLUDE (currency) FROM messy")
def fix_drop_column(spark: SparkSession, sf: str) -> DataFrame:
    return fixes.drop_column(fx.messy_orders(spark, sf), "currency")


# The approved plan of the clean-up, in no particular order; n is its position.
CLEANUP = [
    {"action": "drop_column", "column": "currency"},
    {"action": "drop_duplicate_rows", "column": None},
    {"action": "convert_numeric", "column": "amount"},
    {"action": "placeholders_to_null", "column": "email"},
    {"action": "parse_dates", "column": "order_date"},
    {"action": "placeholders_to_null", "column": "order_date"},
    {"action": "strip_whitespace", "column": "city"},
    {"action": "strip_whitespace", "column": "customer_name"},
    {"action": "standardize_values", "column": "city", "replacements": [{"from_value": "GENEVA", "to_value": "Geneva"}, {"from_value": "lisboa", "to_value": "Lisbon"}]},
    {"action": "nullify_values", "column": "quantity", "rule": "outlier"},
    {"action": "nullify_values", "column": "quantity", "rule": "negative"},
    {"action": "no_action", "column": "email"},
    {"action": "strip_whitespace", "column": "no_such"},
    {"action": "fill_missing", "column": "amount", "fill": "constant", "constant": "much"},
    {"action": "nullify_values", "column": "city", "rule": "negative"},
]

CLEANED = sql.MESSY + f""",
s1 AS (SELECT row_pos, order_id, {sql.strip('customer_name')} AS customer_name, {sql.strip('city')} AS c1, order_date, quantity, amount, email, city, customer_name AS name0 FROM messy),
s2 AS (SELECT *, CASE WHEN NOT {sql.placeholder('email')} THEN email END AS email2, CASE WHEN NOT {sql.placeholder('order_date')} THEN order_date END AS date2,
  CASE c1 WHEN 'GENEVA' THEN 'Geneva' WHEN 'lisboa' THEN 'Lisbon' ELSE c1 END AS city2, {sql.loose_number('amount')} AS amount2 FROM s1),
s3 AS (SELECT *, {sql.any_date('date2')} AS date3 FROM s2),
lim AS (SELECT quantile_cont(quantity, 0.25) AS q1, quantile_cont(quantity, 0.75) AS q3 FROM messy),
s4 AS (SELECT *, CASE WHEN quantity BETWEEN q1 - 3*(q3-q1) AND q3 + 3*(q3-q1) THEN quantity END AS quantity3 FROM s3, lim),
s5 AS (SELECT *, CASE WHEN quantity3 >= 0 THEN quantity3 END AS quantity4 FROM s4),
cleaned AS (
  SELECT min(row_pos) AS row_pos, order_id, customer_name, city2 AS city, strftime(date3, '%Y-%m-%d') AS order_date, quantity4 AS quantity, amount2 AS amount, email2 AS email
  FROM s5 GROUP BY ALL)"""


def cleaned(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(dirty orders, cleaned and tidied copy, log)."""
    messy = messy_table(spark, sf)
    done, log = fixes.apply_plan(messy, CLEANUP, POS)
    return messy, fixes.tidy(staged(done, "cleaned")), log


@query("fix_apply_plan", f"WITH {CLEANED} SELECT * FROM cleaned")
def fix_apply_plan(spark: SparkSession, sf: str) -> DataFrame:
    _, done, _ = cleaned(spark, sf)
    return done.withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd"))


_LOG = CLEANED + f""",
counted AS (SELECT
  count(*) FILTER (city IS DISTINCT FROM c1) AS strip_city, count(*) FILTER (name0 IS DISTINCT FROM customer_name) AS strip_name,
  count(*) FILTER (email IS DISTINCT FROM email2) AS ph_email, count(*) FILTER (order_date IS DISTINCT FROM date2) AS ph_date,
  count(*) FILTER (c1 IS DISTINCT FROM city2) AS std_city, count(*) FILTER (amount IS NOT NULL OR amount2 IS NOT NULL) AS num,
  count(*) FILTER (amount IS NOT NULL AND amount2 IS NULL) AS lost_num,
  count(*) FILTER (date2 IS NOT NULL OR date3 IS NOT NULL) AS dates, count(*) FILTER (date2 IS NOT NULL AND date3 IS NULL) AS lost_dates,
  count(*) FILTER (quantity IS DISTINCT FROM quantity3) AS outl, count(*) FILTER (quantity3 IS DISTINCT FROM quantity4) AS neg,
  count(*) AS before, (SELECT count(*) FROM cleaned) AS after FROM s5),
log AS (SELECT unnest([
  {{n: 1, action: 'drop_column', c: 'currency', changed: 1, unit: 'column removed', note: ''}},
  {{n: 2, action: 'drop_duplicate_rows', c: NULL, changed: before - after, unit: 'rows removed', note: ''}},
  {{n: 3, action: 'convert_numeric', c: 'amount', changed: num, unit: 'values converted to numbers', note: lost_num || ' values could not be read as numbers and became empty'}},
  {{n: 4, action: 'placeholders_to_null', c: 'email', changed: ph_email, unit: 'placeholders set to empty', note: ''}},
  {{n: 5, action: 'parse_dates', c: 'order_date', changed: dates, unit: 'values converted to dates', note: lost_dates || ' values were not valid dates and became empty'}},
  {{n: 6, action: 'placeholders_to_null', c: 'order_date', changed: ph_date, unit: 'placeholders set to empty', note: ''}},
  {{n: 7, action: 'strip_whitespace', c: 'city', changed: strip_city, unit: 'values trimmed', note: ''}},
  {{n: 8, action: 'strip_whitespace', c: 'customer_name', changed: strip_name, unit: 'values trimmed', note: ''}},
  {{n: 9, action: 'standardize_values', c: 'city', changed: std_city, unit: 'values renamed', note: ''}},
  {{n: 10, action: 'nullify_values', c: 'quantity', changed: outl, unit: 'values set to empty', note: ''}},
  {{n: 11, action: 'nullify_values', c: 'quantity', changed: neg, unit: 'values set to empty', note: ''}},
  {{n: 12, action: 'no_action', c: 'email', changed: 0, unit: 'values changed', note: 'left as is'}},
  {{n: 13, action: 'strip_whitespace', c: 'no_such', changed: 0, unit: 'values trimmed', note: 'SKIPPED: column ''no_such'' not found (already dropped?)'}},
  {{n: 14, action: 'fill_missing', c: 'amount', changed: 0, unit: 'empty cells filled', note: '''much'' is not a number; skipped'}},
  {{n: 15, action: 'nullify_values', c: 'city', changed: 0, unit: 'values set to empty', note: 'column is not numeric (convert it first); skipped'}}
  ], recursive := true) FROM counted)"""


@query("fix_apply_log", f"""WITH {_LOG} SELECT n, action, c AS "column", changed, unit, note FROM log""")
def fix_apply_log(spark: SparkSession, sf: str) -> DataFrame:
    return cleaned(spark, sf)[2]


@query("fix_change_counts", f"WITH {_LOG} SELECT action, CAST(sum(changed) AS BIGINT) AS changed FROM log GROUP BY action")
def fix_change_counts(spark: SparkSession, sf: str) -> DataFrame:
    return cleaned(spark, sf)[2].groupBy("action").agg(F.sum("changed").alias("changed"))


@query(
    "fix_tidy",
    """SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS l_quantity, l_discount FROM lineitem""",
)
def fix_tidy(spark: SparkSession, sf: str) -> DataFrame:
    return fixes.tidy(fx.read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount"))


CLEAN_COLUMNS = ["order_id", "customer_name", "city", "order_date", "quantity", "amount", "email"]
_BOTH = sql.MESSY_SCAN + "," + CLEANED.removeprefix(sql.MESSY + ",") + "," + sql.scan(
    "cleaned", CLEAN_COLUMNS, ["order_id", "quantity", "amount"], prefix="z_"
)
_COMPARED = f"""
pairs_ AS (SELECT coalesce(b.kind, a.kind) AS kind, coalesce(b."column", a."column") AS col, b.affected AS before, a.affected AS after,
  CASE WHEN b.kind IS NULL THEN 'new' WHEN a.kind IS NULL THEN 'resolved' WHEN a.affected < b.affected THEN 'reduced' ELSE 'still open' END AS outcome
  FROM issues b FULL JOIN z_issues a ON a.kind = b.kind AND a."column" IS NOT DISTINCT FROM b."column"),
compared AS (SELECT *, CASE outcome
  WHEN 'new' THEN '  [!]  new        ' || kind || ' on ' || coalesce(col, 'whole table') || ': ' || after
  WHEN 'resolved' THEN '  [ok] resolved   ' || kind || ' on ' || coalesce(col, 'whole table') || ' (' || before || ')'
  WHEN 'reduced' THEN '  [~]  reduced    ' || kind || ' on ' || coalesce(col, 'whole table') || ': ' || before || ' -> ' || after
  ELSE '  [!]  still open ' || kind || ' on ' || coalesce(col, 'whole table') || ': ' || before || ' -> ' || after END AS line FROM pairs_)"""


def rescanned(spark: SparkSession, sf: str) -> tuple:
    """The whole clean-up: scan, fix, write a copy, read it back, scan again."""
    messy, done, log = cleaned(spark, sf)
    before = checks.scan(messy, POS)
    path = scratch_path(spark, "clean") + ".csv"
    dated = done.withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd"))
    # one CSV file is one task, so there are to be enough of them; the scan's passes read the file once
    tables.write_copy(tables.spread(dated), f"{sf}/orders.parquet", path)
    saved = staged(tables.load_table(spark, path), "saved")
    return messy, saved, log, before, checks.scan(saved, POS)


@query("dq_compare", f"""WITH {_BOTH}, {_COMPARED} SELECT kind, col AS "column", before, after, outcome, line FROM compared""")
def dq_compare(spark: SparkSession, sf: str) -> DataFrame:
    _, _, _, before, after = rescanned(spark, sf)
    return fixes.compare(before, after)


def _grouped(x: str) -> str:
    return f"regexp_replace(CAST({x} AS VARCHAR), '([0-9])([0-9]{{3}})$', '\\1,\\2')"


_PLACES = "[" + ", ".join(sql.lit(a) for a in v.ACTIONS) + "]"


@query(
    "cleaning_report",
    f"""WITH {_BOTH}, {_COMPARED}, {_LOG.removeprefix(CLEANED + ',')}
    SELECT 1 AS section, 0 AS place, 'Rows: ' || {_grouped('before')} || ' -> ' || {_grouped('after')} || '    Columns: 8 -> 7' AS line FROM counted
    UNION ALL SELECT 2, array_position({_PLACES}, action) * 1000 + n, '  Fix ' || lpad(CAST(n AS VARCHAR), 2, ' ') || '  ' || rpad(action, 20, ' ') || ' '
      || CASE WHEN length(coalesce(c, '(table)')) < 14 THEN rpad(coalesce(c, '(table)'), 14, ' ') ELSE coalesce(c, '(table)') END || ' '
      || CASE WHEN changed = 0 THEN 'no change' ELSE {_grouped('changed')} || ' ' || unit END || CASE WHEN note <> '' THEN '  | ' || note ELSE '' END FROM log
    UNION ALL SELECT 3, 0, 'BEFORE -> AFTER   (' || (SELECT count(*) FROM issues) || ' issues before, ' || (SELECT count(*) FROM z_issues) || ' after; re-scanned from the saved file)'
    UNION ALL SELECT 4, 0, line FROM compared""",
)
def cleaning_report(spark: SparkSession, sf: str) -> DataFrame:
    messy, saved, log, before, after = rescanned(spark, sf)
    rows = (messy.count(), saved.count())
    return fixes.cleaning_report(log, before, after, rows, (len(messy.columns) - 1, len(saved.columns) - 1))
