"""Queries: fix plans proposed from the scan, checked, reviewed and approved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyrow.catalog import sql
from tallyrow.catalog.quality import POS, messy_table
from tallyrow.catalog.registry import query
from tallyrow.functions import vocabulary as v
from tallyrow.operators import checks, profile
from tallyrow.plans import fixplan as fp
from tallyrow.sources.tables import FIX_SCHEMA


def proposed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(dirty orders, issues, plan proposed from them)."""
    messy = messy_table(spark, sf)
    issues = checks.scan(messy, POS)
    known = profile.text_class(profile.pinned_counters(messy, POS)).collect()
    return messy, issues, fp.propose_fixes(issues, checks.category_histogram(messy, known, POS))


def pairs_text() -> Column:
    pair = lambda r: F.concat(r["from_value"], F.lit("=>"), r["to_value"])
    return F.coalesce(F.concat_ws("; ", F.transform("replacements", pair)), F.lit(""))


# A plan with every kind of mistake: the proposed one without its first fix, plus these.
_MISTAKES = [
    (101, ["I98", "I02"], "strip_whitespace", "city", None, None, None, None, "unknown id", "safe"),
    (102, ["I03"], "fill_missing", None, None, None, "median", None, "no column", "safe"),
    (103, ["I03"], "drop_column", "no_such", None, None, None, None, "bad column", "safe"),
    (104, ["I03"], "standardize_values", "city", [], None, None, None, "no pairs", "safe"),
    (105, ["I03"], "standardize_values", "city", [("Atlantis", "Geneva"), ("GENEVA", "Geneva")], None, None, None, "absent value", "safe"),
    (106, ["I03"], "nullify_values", "quantity", None, None, None, None, "no rule", "safe"),
    (107, ["I03"], "fill_missing", "email", None, None, None, None, "no fill", "safe"),
    (108, ["I03"], "fill_missing", "email", None, None, "constant", None, "no constant", "safe"),
    (109, [], "no_action", "currency", None, None, None, None, "left to a person", "safe"),
]


def faulty(spark: SparkSession, plan: DataFrame) -> DataFrame:
    return plan.filter("n > 1").unionByName(spark.createDataFrame(_MISTAKES, FIX_SCHEMA))


def _sql_value(x) -> str:
    if x is None:
        return "NULL"
    if isinstance(x, list):
        return "[" + ", ".join(
            f"{{from_value: {sql.lit(i[0])}, to_value: {sql.lit(i[1])}}}" if isinstance(i, tuple) else sql.lit(i) for i in x
        ) + "]"
    return sql.lit(x) if isinstance(x, str) else str(x)


_PAIR_TYPE = "STRUCT(from_value VARCHAR, to_value VARCHAR)[]"
_ACTION = "CASE kind " + " ".join(f"WHEN {sql.lit(k)} THEN {sql.lit(a)}" for k, a in v.KIND_TO_ACTION.items()) + " END"
PLAN = sql.MESSY_SCAN + f""",
targets AS (
  SELECT col, s, first_value(s) OVER (PARTITION BY col, key ORDER BY c DESC, s) AS target FROM spelled
  QUALIFY count(*) OVER (PARTITION BY col, key) > 1),
pairs AS (
  SELECT col, list({{from_value: s, to_value: target}} ORDER BY s) AS replacements FROM targets WHERE s <> target GROUP BY col),
plan AS (
  SELECT CAST(row_number() OVER (ORDER BY id) AS INTEGER) AS n, [id] AS issue_ids, {_ACTION} AS action, "column",
    CASE WHEN kind = 'category_variants' THEN replacements END AS replacements,
    CASE kind WHEN 'outliers' THEN 'outlier' WHEN 'negative_values' THEN 'negative' END AS rule,
    NULL::VARCHAR AS fill, NULL::VARCHAR AS "constant", detail AS rationale, 'safe' AS risk
  FROM issues LEFT JOIN pairs ON "column" = col)"""
FAULTY = PLAN + f""",
mistakes AS (
  SELECT * FROM (VALUES {', '.join('(' + ', '.join(_sql_value(x) + (f'::{_PAIR_TYPE}' if i == 4 else '::VARCHAR[]' if i == 1 else '') for i, x in enumerate(m)) + ')' for m in _MISTAKES)})
    t(n, issue_ids, action, "column", replacements, rule, fill, "constant", rationale, risk)),
faulty AS (
  SELECT n, issue_ids, action, "column", replacements, rule, fill, "constant", rationale, risk FROM plan WHERE n > 1
  UNION ALL SELECT n, issue_ids, action, "column", replacements, rule, fill, "constant", rationale, risk FROM mistakes),
unnamed AS (SELECT *, "column" IS NULL OR "column" = '' AS u FROM faulty),
bad_columns AS (
  SELECT n, action, "column", CASE WHEN u THEN 'needs a column' ELSE 'column does not exist' END AS problem FROM unnamed
  WHERE (u AND action <> 'drop_duplicate_rows') OR (NOT u AND "column" NOT IN {sql.in_list(sql.MESSY_ORDER)})),
good AS (SELECT * FROM faulty WHERE n NOT IN (SELECT n FROM bad_columns))"""


@query(
    "plan_propose",
    f"""WITH {PLAN} SELECT n, array_to_string(issue_ids, ',') AS issue_ids, action, "column",
    coalesce(array_to_string(list_transform(replacements, lambda r: r.from_value || '=>' || r.to_value), '; '), '') AS replacements,
    rule, rationale FROM plan""",
)
def plan_propose(spark: SparkSession, sf: str) -> DataFrame:
    _, _, plan = proposed(spark, sf)
    return plan.select(
        "n", F.concat_ws(",", "issue_ids").alias("issue_ids"), "action", "column", pairs_text().alias("replacements"), "rule", "rationale"
    )


@query(
    "plan_unknown_ids",
    f"""WITH {FAULTY} SELECT n, action, "column", id FROM (SELECT n, action, "column", unnest(issue_ids) AS id FROM faulty)
    WHERE id NOT IN (SELECT id FROM issues)""",
)
def plan_unknown_ids(spark: SparkSession, sf: str) -> DataFrame:
    _, issues, plan = proposed(spark, sf)
    return fp.unknown_ids(faulty(spark, plan), issues).select("n", "action", "column", "id")


@query("plan_bad_columns", f"WITH {FAULTY} SELECT * FROM bad_columns")
def plan_bad_columns(spark: SparkSession, sf: str) -> DataFrame:
    messy, _, plan = proposed(spark, sf)
    return fp.bad_columns(faulty(spark, plan), messy.drop(POS).columns)


@query(
    "plan_missing_values",
    f"""WITH {FAULTY}, wanted AS (SELECT n, "column", unnest(replacements).from_value AS from_value FROM good WHERE action = 'standardize_values')
    SELECT * FROM wanted w WHERE NOT EXISTS (SELECT 1 FROM cells c WHERE c.col = w."column" AND c.shown = w.from_value)""",
)
def plan_missing_values(spark: SparkSession, sf: str) -> DataFrame:
    messy, _, plan = proposed(spark, sf)
    return fp.missing_values(faulty(spark, plan), messy.drop(POS))


_ARGUMENTS = """
arguments AS (
  SELECT n, action, "column", CASE
    WHEN action = 'standardize_values' AND coalesce(len(replacements), 0) = 0 THEN 'needs a non-empty replacements list'
    WHEN action = 'nullify_values' AND rule IS NULL THEN 'needs rule = negative or outlier'
    WHEN action = 'fill_missing' AND fill IS NULL THEN 'needs fill = median, mode or constant'
    WHEN action = 'fill_missing' AND fill = 'constant' AND "constant" IS NULL THEN 'fill is constant but no constant was given'
    END AS problem FROM good)"""


@query("plan_arg_errors", f"WITH {FAULTY}, {_ARGUMENTS} SELECT * FROM arguments WHERE problem IS NOT NULL")
def plan_arg_errors(spark: SparkSession, sf: str) -> DataFrame:
    messy, _, plan = proposed(spark, sf)
    return fp.argument_errors(faulty(spark, plan), messy.drop(POS).columns)


@query(
    "plan_uncovered",
    f"""WITH {FAULTY} SELECT id, kind, "column" FROM issues WHERE id NOT IN (SELECT unnest(issue_ids) FROM faulty)""",
)
def plan_uncovered(spark: SparkSession, sf: str) -> DataFrame:
    _, issues, plan = proposed(spark, sf)
    return fp.uncovered(faulty(spark, plan), issues)


@query(
    "plan_errors",
    f"""WITH {FAULTY}, {_ARGUMENTS},
    tagged AS (SELECT *, 'Fix ' || n || ' (' || action || ' on ' || coalesce("column", 'table') || ')' AS tag FROM faulty)
    SELECT n, any_value(tag) || ': refers to issue ids that do not exist: ' || string_agg(id, ', ' ORDER BY id) AS error
      FROM (SELECT n, tag, unnest(issue_ids) AS id FROM tagged) WHERE id NOT IN (SELECT id FROM issues) GROUP BY n
    UNION ALL SELECT n, tag || ': ' || problem FROM bad_columns JOIN tagged USING (n)
    UNION ALL SELECT n, tag || ': ' || problem FROM arguments JOIN tagged USING (n) WHERE problem IS NOT NULL
    UNION ALL SELECT n, any_value(tag) || ': these from_values never appear: ' || string_agg(f, ', ' ORDER BY f)
      FROM (SELECT n, t.tag, t."column" AS c, unnest(t.replacements).from_value AS f FROM tagged t JOIN good USING (n) WHERE t.action = 'standardize_values') w
      WHERE NOT EXISTS (SELECT 1 FROM cells x WHERE x.col = w.c AND x.shown = w.f) GROUP BY n
    UNION ALL SELECT NULL, 'No fix covers these issues: ' || string_agg(id, ', ' ORDER BY id) FROM issues
      WHERE id NOT IN (SELECT unnest(issue_ids) FROM faulty) HAVING count(*) > 0""",
)
def plan_errors(spark: SparkSession, sf: str) -> DataFrame:
    messy, issues, plan = proposed(spark, sf)
    return fp.plan_errors(faulty(spark, plan), issues, messy.drop(POS))


_SAFE = f"CASE WHEN action NOT IN {sql.in_list(v.SAFE_ACTIONS)} THEN 'needs_review' ELSE risk END"


@query("plan_enforce_risk", f"""WITH {PLAN} SELECT n, action, "column", {_SAFE} AS risk FROM plan""")
def plan_enforce_risk(spark: SparkSession, sf: str) -> DataFrame:
    _, _, plan = proposed(spark, sf)
    return fp.enforce_risk(plan).select("n", "action", "column", "risk")


@query(
    "plan_review_rows",
    f"""WITH {PLAN} SELECT n, action, p."column", rationale, detail AS problem,
    coalesce(array_to_string(list_transform(replacements, lambda r: '''' || r.from_value || ''' -> ''' || r.to_value || ''''), '; '), '') AS replacements,
    CASE WHEN {_SAFE} = 'safe' THEN 'safe' ELSE 'pending' END AS queue
    FROM plan p JOIN issues i ON i.id = p.issue_ids[1]""",
)
def plan_review_rows(spark: SparkSession, sf: str) -> DataFrame:
    _, issues, plan = proposed(spark, sf)
    return fp.review_rows(fp.enforce_risk(plan), issues)


def _answers(plan: DataFrame) -> DataFrame:
    """What a reviewer typed for the fixes that need a decision, by rule on n."""
    pending = fp.enforce_risk(plan).filter("risk <> 'safe'")
    answer = F.when(F.col("n") >= 9, "Q").when(F.col("n") % 3 == 0, "n").when(F.col("n") == 8, " a ").otherwise("y")
    return pending.select("n", answer.alias("answer"))


DECISIONS = PLAN + f""",
answers AS (
  SELECT n, CASE WHEN n >= 9 THEN 'q' WHEN n % 3 = 0 THEN 'n' WHEN n = 8 THEN 'a' ELSE 'y' END AS answer
  FROM plan WHERE {_SAFE} <> 'safe'),
decisions AS (
  SELECT n, coalesce(first_value(CASE WHEN answer IN ('a','q') THEN answer END IGNORE NULLS)
    OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) = 'a', answer = 'y') AS approved FROM answers)"""


@query("plan_bulk_decision", f"WITH {DECISIONS} SELECT * FROM decisions")
def plan_bulk_decision(spark: SparkSession, sf: str) -> DataFrame:
    _, _, plan = proposed(spark, sf)
    return fp.bulk_decisions(_answers(plan))


@query(
    "plan_approval_split",
    f"""WITH {DECISIONS} SELECT n, action, "column", CASE WHEN {_SAFE} = 'safe' OR coalesce(approved, false) THEN 'approved' ELSE 'rejected' END AS verdict
    FROM plan LEFT JOIN decisions USING (n)""",
)
def plan_approval_split(spark: SparkSession, sf: str) -> DataFrame:
    _, _, plan = proposed(spark, sf)
    split = fp.approval_split(fp.enforce_risk(plan), fp.bulk_decisions(_answers(plan)))
    return split.select("n", "action", "column", "verdict")
