"""Loading, writing, keys and slices."""

import pytest
from pyspark.sql import functions as F

from tallyrow import session
from tallyrow.operators import keys, slices
from tallyrow.sources import tables


def test_csv_with_line_ends_empties_and_padded_headers(spark, tmp_path):
    (tmp_path / "raw.csv").write_text(
        ' id , text,price,flag,when\n1,"two\nlines, ""quoted""",1.5,True,2024-01-01\n2,,2,False,2024-01-02\n3,N/A,,True,x\n4,"",4,True,null\n'
    )
    df = tables.load_table(spark, str(tmp_path / "raw.csv"))
    assert df.dtypes == [("id", "bigint"), ("text", "string"), ("price", "double"), ("flag", "boolean"), ("when", "string")]
    got = {r["id"]: r for r in df.collect()}
    assert got[1]["text"] == 'two\nlines, "quoted"'
    assert got[2]["text"] is None and got[4]["text"] is None and got[3]["text"] == "N/A"
    assert got[3]["price"] is None and got[4]["when"] == "null"


def test_dates_stay_text_and_long_integers_stay_exact(spark, tmp_path):
    (tmp_path / "t.csv").write_text("d,n\n2024-01-01,900719925474099301\n2024-01-02,2\n")
    df = tables.load_table(spark, str(tmp_path / "t.csv"))
    assert df.dtypes == [("d", "string"), ("n", "bigint")]
    assert df.agg(F.max("n")).first()[0] == 900719925474099301


def test_whole_numbers_are_never_rounded(spark, tmp_path):
    rows = [("9223372036854775807", "9223372036854775808", "1" * 38, "1" * 39), ("9223372036854775806", "-5", "2", "3")]
    (tmp_path / "n.csv").write_text("a,b,c,d\n" + "\n".join(",".join(r) for r in rows) + "\n")
    df = tables.load_table(spark, str(tmp_path / "n.csv"))
    assert [t for _, t in df.dtypes] == ["bigint", "decimal(38,0)", "decimal(38,0)", "string"]
    assert sorted(tuple(map(str, r)) for r in df.collect()) == sorted(rows)


def test_news_table(spark, tmp_path):
    (tmp_path / "news.csv").write_text(',title,text,label\n1,"A, b","line one\nline two",FAKE\n2,C,"quoted ""word""",REAL\n')
    df = tables.load_table(spark, str(tmp_path / "news.csv"))
    got = sorted(tuple(r) for r in df.select("text", "label").collect())
    assert got == [("line one\nline two", "FAKE"), ('quoted "word"', "REAL")]


def test_json_and_parquet(spark, tmp_path):
    (tmp_path / "t.json").write_text('[{"a": 1, "b": "x"},\n {"a": null, "b": "N/A"}]')
    assert sorted(map(tuple, tables.load_table(spark, str(tmp_path / "t.json")).collect()), key=repr) == [(1, "x"), (None, "N/A")]
    spark.createDataFrame([(float("nan"),), (1.0,)], "` x ` double").write.parquet(str(tmp_path / "t.parquet"))
    df = tables.load_table(spark, str(tmp_path / "t.parquet"))
    assert df.columns == ["x"] and df.filter("x is null").count() == 1


def test_written_text_survives(spark, tmp_path):
    df = spark.createDataFrame([(1, "  a "), (2, 'q"\n,'), (3, None)], "id bigint, t string")
    tables.write_table(df, str(tmp_path / "out.csv"), "csv")
    assert sorted(map(tuple, tables.load_table(spark, str(tmp_path / "out.csv")).collect())) == sorted(map(tuple, df.collect()))


def test_the_source_is_never_overwritten(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a bigint")
    for target in ("/data/x.csv", "/data/x.csv/", "file:/data/x.csv", "/data/x.csv/part", "/data"):
        with pytest.raises(ValueError):
            tables.write_copy(df, "/data/x.csv", target)
    assert tables.write_copy(df, "/data/x.csv", str(tmp_path / "x_clean.csv")).endswith("x_clean.csv")


def test_questions_csv(spark, tmp_path):
    (tmp_path / "e.csv").write_text("question,expected_verb,expected_tense\nWhat's être?,être,présent\n")
    assert tuple(tables.read_questions(spark, str(tmp_path / "e.csv")).first()) == ("What's être?", "être", "présent")


def test_conform_adds_types_and_nulls(spark):
    df = tables.conform(spark.createDataFrame([(1, "2")], "a int, b string"), [("b", "bigint"), ("z", "string")])
    assert df.dtypes == [("b", "bigint"), ("z", "string")] and tuple(df.first()) == (2, None)


def test_keys(spark, get):
    child = spark.createDataFrame([(1,)] * 50 + [(2,), (None,)], "k bigint")
    parent = spark.createDataFrame([(2,), (3,)], "id bigint")
    assert get(keys.fk_violations(child, "k", parent, "id")) == [(1, 50)]
    assert get(keys.pk_violations(child, "k")) == [(1, 50), (None, 1)]
    keys.require_unique(parent, "id")
    with pytest.raises(ValueError):
        keys.require_unique(child, "k")


def test_load_relational_replaces(spark, tmp_path):
    path = str(tmp_path / "table")
    assert tables.load_relational(spark.range(5).toDF("a"), "replaced_table", path) == 5
    assert tables.load_relational(spark.range(3).toDF("a"), "replaced_table", path) == 3
    spark.sql("DROP TABLE replaced_table")


def test_partitioned_write_prunes(spark, tmp_path):
    tables.write_partitioned(spark.range(10).select("id", (F.col("id") % 2).alias("g")), str(tmp_path / "p"), "g")
    df = spark.read.parquet(str(tmp_path / "p")).filter("g = 1")
    assert df.count() == 5 and len(list((tmp_path / "p").glob("g=*"))) == 2


def test_slices(spark, get):
    df = spark.createDataFrame([(i, f"n{i}", None if i == 3 else "x") for i in range(20, 0, -1)], "k bigint, a string, b string")
    assert tuple(slices.shape(df).first()) == (20, 3)
    assert get(slices.block(df, "k", (2, 3), (2, 2))) == [(2, "n2"), (3, "n3")]
    assert slices.cell(df, "k", 1, 1).first()[0] == 1
    assert [r["name"] for r in slices.header(df).orderBy("position").collect()] == ["k", "a", "b"]
    lines = {r["k"]: r["line"] for r in slices.fixed_width(df, ["a", "b"], [4, 1]).collect()}
    assert len(lines) == 19 and lines[1] == "n1  x" and 3 not in lines
    assert slices.fixed_width(df, ["a"], [1]).filter("k = 20").first()["line"] == "n20"  # padded, never cut


def test_scratch_folder(spark):
    a, b = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert a != b and a.startswith(session.scratch_root(spark))


def test_spread_leaves_wide_sources_alone(spark):
    wide = spark.range(100).repartition(16)
    assert tables.spread(wide) is wide
    assert tables.spread(spark.range(100).coalesce(1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
