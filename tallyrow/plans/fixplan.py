"""Fix plans as tables: proposing, checking, reviewing and approving them.

A plan row is (n, issue_ids, action, column, replacements, rule, fill, constant,
rationale, risk). Plans and issue lists have a few rows per column of the audited
table; only the checks against the data read that table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallyrow.functions import vocabulary as v
from tallyrow.functions.text import named, quoted
from tallyrow.operators.profile import shown
from tallyrow.operators.sizing import pin

PAIRS = "array<struct<from_value:string,to_value:string>>"


def _lookup(pairs: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for p in pairs.items() for x in p]), key)


def spelling_pairs(histogram: DataFrame) -> DataFrame:
    """(column, replacements): each variant to the most frequent spelling of its group."""
    by_use = W.partitionBy("column", "key").orderBy(F.desc("n"), F.asc("spelling"))
    # at most sixty spellings per column reach this point
    ranked = histogram.select(
        "column", "key", "spelling", F.row_number().over(by_use).alias("place"),
        F.first("spelling").over(by_use).alias("target"),
    ).filter("place > 1")
    pair = F.struct(F.col("spelling").alias("from_value"), F.col("target").alias("to_value"))
    return ranked.groupBy("column").agg(F.array_sort(F.collect_list(pair)).alias("replacements"))


def propose_fixes(issues: DataFrame, histogram: DataFrame) -> DataFrame:
    """One fix per issue by rule; the plan's author may as well be a person or a model."""
    pairs = spelling_pairs(histogram).withColumn("kind", F.lit("category_variants"))
    number = F.row_number().over(W.orderBy("id"))  # a handful of issues per column
    return pin(
        issues.withColumn("n", number)
        .join(pairs, ["kind", "column"], "left")
        .select(
            F.col("n").cast("int").alias("n"),
            F.array("id").alias("issue_ids"),
            _lookup(v.KIND_TO_ACTION, F.col("kind")).alias("action"),
            "column",
            F.col("replacements").cast(PAIRS).alias("replacements"),
            _lookup(v.KIND_TO_RULE, F.col("kind")).alias("rule"),
            F.lit(None).cast("string").alias("fill"),
            F.lit(None).cast("string").alias("constant"),
            F.col("detail").alias("rationale"),
            F.lit("safe").alias("risk"),
        )
    )


# --- checks: each returns the offending rows --------------------------------


def fix_tag(n: Column, action: Column, column: Column) -> Column:
    return F.concat(
        F.lit("Fix "), n.cast("string"), F.lit(" ("), action, F.lit(" on "),
        F.coalesce(F.nullif(column, F.lit("")), F.lit("table")), F.lit(")"),
    )


def named_ids(plan: DataFrame) -> DataFrame:
    return plan.select("n", "action", "column", F.explode("issue_ids").alias("id"))


def unknown_ids(plan: DataFrame, issues: DataFrame) -> DataFrame:
    return named_ids(plan).join(issues.select("id"), "id", "left_anti")


def bad_columns(plan: DataFrame, columns: list[str]) -> DataFrame:
    """(n, action, column, problem): a column is missing where one is needed, or unknown."""
    unnamed = F.col("column").isNull() | (F.col("column") == "")
    problem = (
        F.when((F.col("action") != "drop_duplicate_rows") & unnamed, "needs a column")
        .when(~unnamed & ~F.col("column").isin(columns), "column does not exist")
    )
    return plan.select("n", "action", "column", problem.alias("problem")).filter("problem is not null")


def _on_good_columns(plan: DataFrame, columns: list[str]) -> DataFrame:
    return plan.join(bad_columns(plan, columns).select("n"), "n", "left_anti")


def missing_values(plan: DataFrame, df: DataFrame) -> DataFrame:
    """(n, column, from_value): replacements whose from-value is not in the data.

    Only cells equal to one of the plan's values survive the scan; the plan side
    is the small side of both joins.
    """
    wanted = _on_good_columns(plan, df.columns).filter("action = 'standardize_values'").select(
        "n", "column", F.explode("replacements").alias("r")
    ).select("n", "column", "r.from_value")
    fields = [f for f in df.schema if f.name in {r["column"] for r in wanted.select("column").distinct().collect()}]
    if not fields:
        return wanted
    cells = df.select(*[shown(f).alias(f.name) for f in fields]).unpivot(
        [], [named(f.name) for f in fields], "column", "from_value"
    )
    # partial distinct: a task sends each wanted value at most once
    present = cells.join(F.broadcast(wanted.select("column", "from_value").distinct()), ["column", "from_value"], "left_semi").distinct()
    return wanted.join(present, ["column", "from_value"], "left_anti").select("n", "column", "from_value")


def argument_errors(plan: DataFrame, columns: list[str]) -> DataFrame:
    """(n, action, column, problem) of fixes whose own arguments are incomplete."""
    action = F.col("action")
    unfilled = F.col("fill").isNull() | (F.col("fill") == "")
    problem = (
        F.when(
            (action == "standardize_values") & (F.coalesce(F.size("replacements"), F.lit(0)) <= 0),
            "needs a non-empty replacements list",
        )
        .when(
            (action == "nullify_values") & (F.col("rule").isNull() | (F.col("rule") == "")),
            "needs rule = negative or outlier",
        )
        .when((action == "fill_missing") & unfilled, "needs fill = median, mode or constant")
        .when(
            (action == "fill_missing") & (F.col("fill") == "constant") & F.col("constant").isNull(),
            "fill is constant but no constant was given",
        )
    )
    return (
        _on_good_columns(plan, columns)
        .select("n", "action", "column", problem.alias("problem"))
        .filter("problem is not null")
    )


def uncovered(plan: DataFrame, issues: DataFrame) -> DataFrame:
    """Issues no fix refers to."""
    return issues.join(named_ids(plan).select("id"), "id", "left_anti").select("id", "kind", "column")


def plan_errors(plan: DataFrame, issues: DataFrame, df: DataFrame) -> DataFrame:
    """(n, error): every problem of a plan, n being NULL for the plan as a whole."""
    columns = df.columns
    tag = fix_tag(F.col("n"), F.col("action"), F.col("column"))
    listed = lambda c: F.concat_ws(", ", F.array_sort(F.collect_list(c)))
    unknown = unknown_ids(plan, issues).groupBy("n", "action", "column").agg(listed("id").alias("ids"))
    absent = (
        missing_values(plan, df).groupBy("n", "column").agg(listed("from_value").alias("values"))
        .withColumn("action", F.lit("standardize_values"))
    )
    parts = [
        unknown.select("n", F.concat(tag, F.lit(": refers to issue ids that do not exist: "), "ids").alias("error")),
        bad_columns(plan, columns).select("n", F.concat(tag, F.lit(": "), "problem").alias("error")),
        absent.select("n", F.concat(tag, F.lit(": these from_values never appear: "), "values").alias("error")),
        argument_errors(plan, columns).select("n", F.concat(tag, F.lit(": "), "problem").alias("error")),
        uncovered(plan, issues).agg(listed("id").alias("ids")).filter("ids <> ''").select(
            F.lit(None).cast("int").alias("n"), F.concat(F.lit("No fix covers these issues: "), "ids").alias("error")
        ),
    ]
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p)
    return result


# --- review and approval -----------------------------------------------------


def enforce_risk(plan: DataFrame) -> DataFrame:
    """Code, not the plan's author, decides what counts as safe."""
    risk = F.when(~F.col("action").isin(v.SAFE_ACTIONS), "needs_review").otherwise(F.col("risk"))
    return plan.withColumn("risk", risk)


def review_rows(plan: DataFrame, issues: DataFrame) -> DataFrame:
    """(n, action, column, rationale, problem, replacements, queue) for a reviewer."""
    ids = plan.select("n", F.posexplode("issue_ids").alias("place", "id"))
    told = F.array_sort(F.collect_list(F.struct("place", "detail")))
    problems = (
        ids.join(issues.select("id", "detail"), "id")
        .groupBy("n")
        .agg(F.concat_ws(" | ", F.transform(told, lambda x: x["detail"])).alias("problem"))
    )
    arrow = lambda r: F.concat(quoted(r["from_value"]), F.lit(" -> "), quoted(r["to_value"]))
    pairs = F.coalesce(F.concat_ws("; ", F.transform("replacements", arrow)), F.lit(""))
    return plan.join(problems, "n", "left").select(
        "n", "action", "column", "rationale",
        F.coalesce("problem", F.lit("")).alias("problem"),
        pairs.alias("replacements"),
        F.when(F.col("risk") == "safe", "safe").otherwise("pending").alias("queue"),
    )


def bulk_decisions(answers: DataFrame) -> DataFrame:
    """(n, approved) from answers y/n/a/q: the first a or q decides all later fixes.

    A person gave these answers one by one, so the table is short.
    """
    so_far = W.orderBy("n").rowsBetween(W.unboundedPreceding, W.currentRow)
    answer = F.lower(F.trim("answer"))
    mode = F.first(F.when(answer.isin("a", "q"), answer), ignorenulls=True).over(so_far)
    return answers.select("n", F.coalesce(mode == "a", answer == "y").alias("approved"))


def approval_split(plan: DataFrame, decisions: DataFrame) -> DataFrame:
    """The plan with ``verdict``: safe fixes and those decided on are approved."""
    decided = F.coalesce("approved", F.lit(False))
    return (
        plan.join(decisions.select("n", "approved"), "n", "left")
        .withColumn("verdict", F.when((F.col("risk") == "safe") | decided, "approved").otherwise("rejected"))
        .drop("approved")
    )
