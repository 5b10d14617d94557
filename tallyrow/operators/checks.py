"""The data-quality scan: eleven kinds of defects, ranked and described."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from tallyrow.functions import text as tx, vocabulary as v
from tallyrow.functions.text import named
from tallyrow.operators.profile import (
    audited,
    few_valued,
    is_text,
    pinned_counters,
    shown,
    text_class,
    value_histogram,
)
from tallyrow.operators.quantiles import exact_quantiles
from tallyrow.operators.sizing import pin

EXAMPLES = 5
# findings whose bad values are collected in one pass; more would outgrow generated code
EXAMPLE_GROUP = 24

_FINDING = "kind string, column string, seq int, n bigint, affected bigint"


def severity(kind: Column, affected: Column, n: Column) -> Column:
    share = affected / n
    level = F.when(F.lit(False), "")
    for name, fixed in v.FIXED_SEVERITY.items():
        level = level.when(kind == name, fixed)
    for name, (high, medium) in v.SEVERITY_SHARES.items():
        level = level.when(
            kind == name, F.when(share >= high, "high").when(share >= medium, "medium").otherwise("low")
        )
    return level


def duplicate_rows(df: DataFrame, order_by: str | None = None) -> DataFrame:
    """Rows equal to an earlier row, NULLs being equal.

    Rows are compared by a 256-bit digest of their canonical JSON, so a wide row
    costs 32 bytes in the exchange and copies collapse on the map side.
    """
    fields = audited(df, order_by)
    copies = (
        df.select(row_digest(fields).alias("digest"))
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("c"))
        .agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("affected"))
    )
    return copies.filter("affected > 0").select(
        F.lit("duplicate_rows").alias("kind"), F.lit(None).cast("string").alias("column"),
        F.lit(0).alias("seq"), "n", "affected",
    )


def row_digest(fields: list[T.StructField]) -> Column:
    def plain(f: T.StructField) -> Column:
        c = named(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return F.when(~F.isnan(c), F.when(c == 0, F.lit(0.0)).otherwise(c))  # -0.0 is 0.0, NaN is missing
        return c

    # whole microseconds; the default format stops at milliseconds
    options = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    packed = F.to_json(F.struct(*[plain(f).alias(f"c{i}") for i, f in enumerate(fields)]), options)
    return F.unhex(F.sha2(packed, 256))


def counter_findings(counters: DataFrame) -> DataFrame:
    """Every finding that follows from the column counters alone."""
    c = text_class(counters)
    filled, dates = F.col("filled"), F.col("dates")
    numeric = F.col("class") == "numeric_text"
    dated = F.col("class").isin("date", "named_date")
    hinted = tx.contains_any(F.lower("column"), v.NON_NEGATIVE_HINTS)
    # negatives are only looked at behind the same gate as the quartiles
    affected = {
        "constant_column": F.when((F.col("n") > 1) & F.col("one_mark"), F.col("n")),
        "missing": F.col("n") - F.col("present"),
        "negative_values": F.when(
            F.col("is_number") & (F.col("present") > v.MIN_VALUES_FOR_QUARTILES) & hinted, F.col("negatives")
        ),
        "placeholder_missing": F.col("placeholders"),
        "whitespace": F.col("whitespace"),
        "numeric_formatting": F.when(numeric, F.col("loose_numbers") - F.col("plain_numbers")),
        "non_numeric_in_numeric": F.when(numeric, filled - F.col("loose_numbers")),
        "invalid_dates": F.when(dated, filled - dates),
    }
    found = F.filter(
        F.array(*[F.struct(F.lit(k).alias("kind"), a.alias("affected")) for k, a in affected.items()]),
        lambda x: x["affected"] > 0,
    )
    return c.select("column", "seq", "n", F.explode(found).alias("f")).select(
        "f.kind", "column", "seq", "n", "f.affected"
    )


def fences(df: DataFrame, counters: list) -> dict[str, tuple[float, float]]:
    """Outlier limits per numeric column: two numbers each, found by exact quartiles."""
    counts = {
        r["column"]: r["present"]
        for r in counters
        if r["is_number"] and r["present"] > v.MIN_VALUES_FOR_QUARTILES
    }
    limits = {}
    for name, (q1, q3) in exact_quantiles(df, list(counts), [0.25, 0.75], counts).items():
        if q3 - q1 > 0:
            limits[name] = (q1 - v.FENCE * (q3 - q1), q3 + v.FENCE * (q3 - q1))
    return limits


def outside(c: Column, limits: tuple[float, float]) -> Column:
    x = c.cast("double")
    return ~F.isnan(x) & ((x < limits[0]) | (x > limits[1]))


def outlier_findings(df: DataFrame, counters: DataFrame, limits: dict) -> DataFrame:
    if not limits:
        return df.sparkSession.createDataFrame([], _FINDING)
    counted = df.agg(*[F.count_if(outside(named(c), lim)).alias(c) for c, lim in limits.items()])
    long = counted.unpivot([], [named(c) for c in limits], "column", "affected").filter("affected > 0")
    return long.join(F.broadcast(counters.select("column", "seq", "n")), "column").select(
        F.lit("outliers").alias("kind"), "column", "seq", "n", "affected"
    )


def category_histogram(df: DataFrame, counters: list, order_by: str | None = None) -> DataFrame:
    """(column, key, spelling, n, first_pos) of columns with few distinct values.

    The sketch rules wide columns out before their values are counted; whether a
    column really has at most MAX_CATEGORIES values is settled exactly here.
    """
    narrow = few_valued(df, [r["column"] for r in counters if r["class"] == "category"])
    h = value_histogram(df, narrow, order_by).filter(~tx.is_placeholder(F.col("value")))
    few = h.withColumn("width", F.count(F.lit(1)).over(W.partitionBy("column"))).filter(
        F.col("width") <= v.MAX_CATEGORIES
    )
    return (
        few.withColumn("spelling", tx.strip(F.col("value")))
        .groupBy("column", tx.category_key(F.col("spelling")).alias("key"), "spelling")
        .agg(F.sum("n").alias("n"), F.min("first_pos").alias("first_pos"))
    )


def variant_groups(histogram: DataFrame, drop_empty_key: bool = False) -> DataFrame:
    """(column, key, rows, first_pos, spellings): keys written in several ways."""
    if drop_empty_key:
        histogram = histogram.filter("key <> ''")
    ordered = F.array_sort(F.collect_list(F.struct("first_pos", "spelling")))
    return (
        histogram.groupBy("column", "key")
        .agg(F.sum("n").alias("rows"), F.min("first_pos").alias("first_pos"), ordered.alias("spellings"))
        .filter(F.size("spellings") > 1)
        .withColumn("spellings", F.transform("spellings", lambda x: x["spelling"]))
    )


def category_findings(groups: DataFrame, counters: DataFrame) -> DataFrame:
    found = groups.groupBy("column").agg(
        F.sum("rows").alias("affected"),
        F.count(F.lit(1)).alias("variant_groups"),
    )
    return found.join(F.broadcast(counters.select("column", "seq", "n")), "column").select(
        F.lit("category_variants").alias("kind"), "column", "seq", "n", "affected"
    )


def _conditions(kind: str, c: Column, s: Column, placeholder: Column, limits: tuple | None) -> Column:
    """Whether a cell is a bad value of this kind; s is the stripped cell."""
    real = c.isNotNull() & ~placeholder
    return {
        "outliers": lambda: outside(c, limits),
        "negative_values": lambda: c.cast("double") < 0,
        "placeholder_missing": lambda: placeholder,
        "whitespace": lambda: real & (c != s),
        "numeric_formatting": lambda: real & tx.plain_number_of(s).isNull() & tx.loose_number_of(s).isNotNull(),
        "non_numeric_in_numeric": lambda: real & tx.plain_number_of(s).isNull() & tx.loose_number_of(s).isNull(),
        "invalid_dates": lambda: real & tx.any_date_of(s).isNull(),
    }[kind]()


def value_examples(
    df: DataFrame, flagged: list[tuple[str, str]], limits: dict, order_by: str | None = None
) -> DataFrame:
    """(kind, column, examples): the first five distinct bad values of each finding.

    In order of appearance, outliers by size; without ``order_by`` by frequency.
    Only bad cells are exchanged, and the rank filter is a top-k per task.
    """
    schema = "kind string, column string, examples array<string>"
    if not flagged:
        return df.sparkSession.createDataFrame([], schema)
    by_column = sorted(flagged, key=lambda pair: pair[1])
    groups = [by_column[i : i + EXAMPLE_GROUP] for i in range(0, len(by_column), EXAMPLE_GROUP)]
    return reduce(DataFrame.unionByName, [_group_examples(df, g, limits, order_by) for g in groups])


def _group_examples(df: DataFrame, flagged: list[tuple[str, str]], limits: dict, order_by: str | None) -> DataFrame:
    fields = {f.name: f for f in df.schema}
    position = named(order_by).cast("bigint") if order_by else F.lit(None).cast("bigint")
    columns = sorted({column for _, column in flagged})
    texts = [c for c in columns if is_text(fields[c])]
    narrow = df.select(position.alias("__pos"), *[named(c) for c in columns])
    # every text column is stripped and tested for placeholders once
    narrow = narrow.withColumns({f"__s_{c}": tx.strip(named(c)) for c in texts})
    narrow = narrow.withColumns({f"__p_{c}": tx.placeholder_of(named(f"__s_{c}")) for c in texts})
    marks = []
    for kind, column in flagged:
        c = named(column)
        s, placeholder = (named(f"__s_{column}"), named(f"__p_{column}")) if column in texts else (c, F.lit(False))
        size = c.cast("double") if kind == "outliers" else F.lit(None).cast("double")
        marks.append(
            F.when(
                _conditions(kind, c, s, placeholder, limits.get(column)),
                F.struct(
                    F.lit(kind).alias("kind"), F.lit(column).alias("column"),
                    shown(fields[column]).alias("value"), size.alias("size"),
                ),
            )
        )
    bad = narrow.select(F.col("__pos").alias("pos"), F.explode(F.array_compact(F.array(*marks))).alias("m"))
    values = bad.groupBy("m.kind", "m.column", "m.value").agg(
        F.min("m.size").alias("size"), F.min("pos").alias("pos"), F.count(F.lit(1)).alias("n")
    )
    order = [F.asc_nulls_last("size"), F.asc_nulls_last("pos"), F.desc("n"), F.asc("value")]
    first = values.withColumn(
        "place", F.row_number().over(W.partitionBy("kind", "column").orderBy(*order))
    ).filter(F.col("place") <= EXAMPLES)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda x: x["value"])
    return first.groupBy("kind", "column").agg(listed.alias("examples"))


def variant_examples(groups: DataFrame) -> DataFrame:
    line = F.concat_ws(" / ", F.transform("spellings", tx.quoted))
    place = F.row_number().over(W.partitionBy("column").orderBy(F.asc_nulls_last("first_pos"), "key"))
    top = groups.select("column", line.alias("line"), place.alias("place")).filter(F.col("place") <= EXAMPLES)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("place", "line"))), lambda x: x["line"])
    return top.groupBy("column").agg(listed.alias("examples")).select(
        F.lit("category_variants").alias("kind"), "column", "examples"
    )


def _detail() -> Column:
    kind, affected, n, first = F.col("kind"), F.col("affected"), F.col("n"), F.col("first_example")
    count = affected.cast("string")
    say = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    # fixed values: message formats
    return (
        F.when(kind == "duplicate_rows", say(count, " rows are exact copies of an earlier row"))
        .when(kind == "constant_column", say("Only one distinct value (", F.coalesce("single", F.lit("none")), "); carries no information"))
        .when(kind == "missing", say(count, " empty values (", tx.percent(affected, n), ")"))
        .when(kind == "outliers", say(count, " values far outside the normal range (", tx.significant4(F.col("low")), " to ", tx.significant4(F.col("high")), ")"))
        .when(kind == "negative_values", say(count, " negative values in a column that should not go below zero"))
        .when(kind == "placeholder_missing", say(count, " placeholder values that mean 'missing' (e.g. ", tx.quoted(first), ")"))
        .when(kind == "whitespace", say(count, " values have leading/trailing spaces"))
        .when(kind == "numeric_formatting", say(count, " numbers carry symbols or separators (e.g. ", tx.quoted(first), "), so the column is stored as text"))
        .when(kind == "non_numeric_in_numeric", say(count, " values in a mostly-numeric column cannot be read as numbers"))
        .when(kind == "invalid_dates", say(count, " values cannot be parsed as dates"))
        .when(kind == "category_variants", say(F.col("groups").cast("string"), " categories are spelled several ways"))
    )


def scan(df: DataFrame, order_by: str | None = None, kinds: list[str] | None = None) -> DataFrame:
    """All issues: (id, kind, column, severity, detail, affected, examples).

    Passes over the data: one for the counters, one for quartiles (numeric columns
    only), one for the examples (flagged columns only), one for row copies, and one
    for the values of low-cardinality text columns. The driver sees counters and
    limits, a few numbers per column.
    """
    kinds = kinds or v.KINDS
    spark = df.sparkSession
    counters = text_class(pinned_counters(df, order_by, kinds))
    known = counters.collect()
    found = counter_findings(counters.drop("class")).filter(F.col("kind").isin(kinds))
    flagged = [(r["kind"], r["column"]) for r in found.collect()]
    limits = fences(df, known) if "outliers" in kinds else {}
    if limits:
        pinned = pin(outlier_findings(df, counters, limits))
        flagged += [(r["kind"], r["column"]) for r in pinned.collect()]
        found = found.unionByName(pinned)
    constants = [c for k, c in flagged if k == "constant_column"]
    singles, untrue = _single_values(df, constants)
    if untrue:
        found = found.filter(~((F.col("kind") == "constant_column") & F.col("column").isin(untrue)))
    by_value = [
        (k, c) for k, c in flagged if k not in ("constant_column", "missing")
    ]
    examples = value_examples(df, by_value, limits, order_by)
    groups_per_column = spark.createDataFrame([], "column string, groups bigint")
    if "category_variants" in kinds and any(r["class"] == "category" for r in known):
        groups = variant_groups(category_histogram(df, known, order_by))
        # at most MAX_CATEGORIES spellings per column, and used three times below
        groups = pin(groups)
        found = found.unionByName(category_findings(groups, counters))
        examples = examples.unionByName(variant_examples(groups))
        groups_per_column = groups.groupBy("column").agg(F.count(F.lit(1)).alias("groups"))
    if "duplicate_rows" in kinds:
        found = found.unionByName(duplicate_rows(df, order_by))
    notes = spark.createDataFrame(
        [(c, None, lo, hi) for c, (lo, hi) in limits.items()] + [(c, s, None, None) for c, s in singles.items()],
        "column string, single string, low double, high double",
    ).groupBy("column").agg(F.first("single", True).alias("single"), F.first("low", True).alias("low"), F.first("high", True).alias("high"))
    told = (
        found.join(examples, ["kind", "column"], "left")
        .join(notes, "column", "left")
        .join(groups_per_column, "column", "left")
        .withColumn("first_example", F.try_element_at("examples", F.lit(1)))
        .withColumn("detail", _detail())
        .withColumn("severity", severity(F.col("kind"), F.col("affected"), F.col("n")))
        .withColumn(
            "examples",
            F.when(F.col("kind") == "whitespace", F.transform("examples", tx.quoted)).otherwise(
                F.coalesce("examples", F.array().cast("array<string>"))
            ),
        )
    )
    return pin(rank_issues(told))


def _single_values(df: DataFrame, columns: list[str]) -> tuple[dict, list]:
    """The one value of each constant column; columns whose marks merely collided."""
    if not columns:
        return {}, []
    fields = [f for f in df.schema if f.name in columns]
    ends = [F.min(shown(f)).alias(f"lo{i}") for i, f in enumerate(fields)]
    ends += [F.max(shown(f)).alias(f"hi{i}") for i, f in enumerate(fields)]
    row = df.agg(*ends).first()
    singles, untrue = {}, []
    for i, f in enumerate(fields):
        if row[f"lo{i}"] == row[f"hi{i}"]:
            singles[f.name] = row[f"lo{i}"]
        else:
            untrue.append(f.name)
    return singles, untrue


def detection_order(kind: Column) -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in v.KINDS]), kind)


def rank_issues(issues: DataFrame) -> DataFrame:
    """Ids by severity, then size, then order of detection. A handful per column."""
    rank = F.when(F.lit(False), 0)
    for name, place in v.SEVERITY_RANK.items():
        rank = rank.when(F.col("severity") == name, place)
    order = W.orderBy(rank, F.desc("affected"), "seq", detection_order(F.col("kind")))
    return issues.withColumn("place", F.row_number().over(order)).select(
        F.format_string("I%02d", F.col("place")).alias("id"),
        "kind", "column", "severity", "detail", "affected", "examples",
    )


def report_lines(issues: DataFrame, rows: int, columns: int) -> DataFrame:
    """(line_no, line): a header, then one line per issue with its detail and examples."""
    place = F.regexp_extract("id", r"(\d+)", 1).cast("bigint")
    head = issues.agg(F.count(F.lit(1)).alias("k")).select(
        F.lit(0).cast("bigint").alias("line_no"),
        F.concat(
            F.lit(f"Scanned {rows:,} rows x {columns} columns: "), F.col("k").cast("string"), F.lit(" issues found")
        ).alias("line"),
    )
    shown_examples = F.concat(F.lit(" | examples: "), F.concat_ws("; ", "examples"))
    body = issues.select(
        place.alias("line_no"),
        F.concat(
            F.lit("["), F.col("id"), F.lit("] "), tx.pad(F.upper("severity"), 6), F.lit(" "), tx.pad(F.col("kind"), 24),
            F.lit(" "), F.coalesce("column", F.lit("(whole table)")), F.lit(" | "), F.col("detail"),
            F.when(F.size("examples") > 0, shown_examples).otherwise(F.lit("")),
        ).alias("line"),
    )
    return head.unionByName(body)
