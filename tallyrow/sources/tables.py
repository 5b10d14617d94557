"""Table sources and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyrow.functions.text import named, strip

_INTEGER = r"^[+-]?[0-9]+$"
_NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
_BOOLEANS = ["True", "False", "TRUE", "FALSE", "true", "false"]


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores, when the source splits into fewer tasks than there are cores.

    A single small file is one task however many cores wait; a large table has
    enough splits and is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def strip_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def nan_to_null(df: DataFrame) -> DataFrame:
    """One notion of missing: NaN becomes NULL."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floats:
        return df
    return df.select(
        *[
            F.when(~F.isnan(named(c)), named(c)).alias(c) if c in floats else named(c)
            for c in df.columns
        ]
    )


def load_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Read CSV, JSON or Parquet by suffix; anything unknown is read as CSV.

    Only empty cells become NULL: "N/A", "null" and the like stay visible text.
    ``multi_line`` allows line ends inside quoted cells; then one file is one
    task, so large inputs should come as many files, or with ``multi_line`` off.
    A given ``schema`` saves the pass that infers column types.
    """
    low = path.rstrip("/").lower()
    if low.endswith(".parquet"):
        df = spark.read.parquet(path)
    elif low.endswith((".json", ".jsonl")):
        reader = spark.read.option("multiLine", multi_line and not low.endswith(".jsonl"))
        df = (reader.schema(schema) if schema else reader).json(path)
    else:
        reader = spark.read.options(header=True, multiLine=multi_line, escape='"', nullValue="")
        if schema:
            df = reader.schema(schema).csv(path)
        else:
            df = infer_text_types(reader.csv(path))
    return nan_to_null(strip_headers(df))


def infer_text_types(df: DataFrame) -> DataFrame:
    """bigint, decimal, double or boolean where every non-null text reads as such.

    Whole numbers are never rounded: they become bigint where all fit, else decimal(38,0)
    where all fit, else they stay text. One pass with constant-size state per column; dates
    stay text.
    """
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not texts:
        return df
    checks: list[Column] = []
    for i, name in enumerate(texts):
        c = named(name)
        checks += [
            F.count(c).alias(f"n{i}"),
            F.count_if(strip(c).rlike(_INTEGER)).alias(f"i{i}"),
            F.count_if(strip(c).rlike(_INTEGER) & strip(c).try_cast("bigint").isNotNull()).alias(f"l{i}"),
            F.count_if(strip(c).rlike(_INTEGER) & strip(c).try_cast("decimal(38,0)").isNotNull()).alias(f"x{i}"),
            F.count_if(strip(c).rlike(_NUMBER)).alias(f"d{i}"),
            F.count_if(c.isin(_BOOLEANS)).alias(f"b{i}"),
        ]
    seen = df.agg(*checks).first()
    target = {}
    for i, name in enumerate(texts):
        n = seen[f"n{i}"]
        if n and seen[f"i{i}"] == n:
            if seen[f"l{i}"] == n:
                target[name] = "bigint"
            elif seen[f"x{i}"] == n:
                target[name] = "decimal(38,0)"
        elif n and seen[f"d{i}"] == n:
            target[name] = "double"
        elif n and seen[f"b{i}"] == n:
            target[name] = "boolean"
    return df.select(
        *[
            strip(named(c)).cast(target[c]).alias(c) if c in target else named(c)
            for c in df.columns
        ]
    )


def write_copy(df: DataFrame, source: str, target: str, fmt: str = "csv") -> str:
    """Write a cleaned copy; the source itself is never overwritten."""
    clean = [p.rstrip("/").removeprefix("file:") for p in (source, target)]
    if clean[0] == clean[1] or clean[0].startswith(clean[1] + "/") or clean[1].startswith(clean[0] + "/"):
        raise ValueError("the cleaned copy must not replace its source")
    write_table(df, target, fmt)
    return target


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.options(
            header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
    writer.save(path)


def load_relational(df: DataFrame, table: str, path: str | None = None) -> int:
    """Replace-load a catalog table; returns its row count."""
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table).count()


def conform(df: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    """Exactly these columns with these types; absent ones become NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (named(name) if name in have else F.lit(None)).cast(kind).alias(name)
            for name, kind in columns
        ]
    )


def write_chunks(chunks: DataFrame, path: str) -> None:
    chunks.write.mode("overwrite").json(path)


CHUNK_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField(
            "metadata",
            T.StructType(
                [
                    T.StructField("verb", T.StringType()),
                    T.StructField("verb_lower", T.StringType()),
                    T.StructField("meaning", T.StringType()),
                    T.StructField("tense", T.StringType()),
                    T.StructField("page", T.LongType()),
                    T.StructField("num_forms", T.LongType()),
                ]
            ),
        ),
    ]
)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHUNK_SCHEMA).json(path)


FIX_SCHEMA = T.StructType(
    [
        T.StructField("n", T.IntegerType()),
        T.StructField("issue_ids", T.ArrayType(T.StringType())),
        T.StructField("action", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField(
            "replacements",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("from_value", T.StringType()),
                        T.StructField("to_value", T.StringType()),
                    ]
                )
            ),
        ),
        T.StructField("rule", T.StringType()),
        T.StructField("fill", T.StringType()),
        T.StructField("constant", T.StringType()),
        T.StructField("rationale", T.StringType()),
        T.StructField("risk", T.StringType()),
    ]
)

_FIX_BODY = T.ArrayType(T.StructType([f for f in FIX_SCHEMA if f.name != "n"]))
PLAN_DOCUMENT = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("approved", _FIX_BODY),
        T.StructField("rejected", _FIX_BODY),
    ]
)


def read_plan(spark: SparkSession, path: str) -> DataFrame:
    """Approved fixes of a plan document, numbered from 1 by position."""
    doc = spark.read.schema(PLAN_DOCUMENT).json(path, multiLine=True)
    return doc.select(F.posexplode("approved").alias("n", "fix")).select(
        (F.col("n") + 1).cast("int").alias("n"), "fix.*"
    )


def write_plan(approved: DataFrame, rejected: DataFrame, source: str, path: str) -> None:
    """One plan document. A plan is as long as its author made it: tens of rows."""

    def fixes(plan: DataFrame, name: str) -> DataFrame:
        body = [f.name for f in FIX_SCHEMA if f.name != "n"]
        listed = F.array_sort(F.collect_list(F.struct("n", F.struct(*body).alias("fix"))))
        return plan.agg(F.transform(listed, lambda x: x["fix"]).alias(name))

    document = fixes(approved, "approved").join(fixes(rejected, "rejected"))
    document.select(F.lit(source).alias("source"), "approved", "rejected").coalesce(
        1
    ).write.mode("overwrite").json(path)


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    schema = "question string, expected_verb string, expected_tense string"
    return spark.read.schema(schema).csv(path, header=True, escape='"')


def write_partitioned(df: DataFrame, path: str, *columns: str) -> None:
    """Folder per value, so a filter on these columns reads only its folders."""
    df.write.mode("overwrite").partitionBy(*columns).parquet(path)
