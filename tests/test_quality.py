"""Edge cases of the scan, of profiles and of exact quantiles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrow.operators import checks, profile, quantiles


def found(df, order_by="pos", kinds=None):
    return {(r["kind"], r["column"]): r for r in checks.scan(df, order_by, kinds).collect()}


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, x) for i, x in enumerate(values)], f"pos bigint, c {kind}")


def test_empty_table_has_no_issues(spark):
    assert found(spark.createDataFrame([], "pos bigint, a string, b double")) == {}


def test_one_row_is_not_constant(spark):
    assert found(column(spark, ["x"])) == {}


def test_all_null_column_is_constant_and_missing(spark):
    issues = found(column(spark, [None] * 4))
    assert issues[("constant_column", "c")]["detail"] == "Only one distinct value (none); carries no information"
    assert issues[("missing", "c")]["affected"] == 4
    assert issues[("missing", "c")]["severity"] == "high"
    assert issues[("duplicate_rows", None)]["affected"] == 3


def test_nan_is_missing(spark):
    issues = found(column(spark, [1.0, float("nan"), 2.0, None], "double"))
    assert issues[("missing", "c")]["affected"] == 2


def test_negative_zero_equals_zero(spark):
    assert found(column(spark, [0.0, -0.0], "double"))[("duplicate_rows", None)]["affected"] == 1


def test_every_placeholder_and_blank_cells(spark):
    values = ["", " N/A ", "na", "NULL", "none", "NaN", "-", "--", "Unknown", "?", "not recorded", "   ", "real"]
    issues = found(column(spark, values), kinds=["placeholder_missing", "whitespace"])
    assert issues[("placeholder_missing", "c")]["affected"] == 12
    assert ("whitespace", "c") not in issues  # blank cells are placeholders, not padded text


def test_unicode_spaces_are_stripped(spark):
    issues = found(column(spark, [" x", "y ", "z\x1f", "w"]), kinds=["whitespace"])
    assert issues[("whitespace", "c")]["affected"] == 3


@pytest.mark.parametrize("n, expected", [(20, False), (21, True)])
def test_outliers_need_more_than_twenty_values(spark, n, expected):
    values = [float(i % 10) for i in range(n - 1)] + [1000.0]
    assert (("outliers", "c") in found(column(spark, values, "double"))) is expected


def test_no_outliers_without_spread(spark):
    assert ("outliers", "c") not in found(column(spark, [5.0] * 30 + [99.0], "double"))


def test_outlier_examples_are_the_smallest(spark):
    values = [float(i % 10) for i in range(100)] + [900.0, 700.0, 800.0, -500.0, 600.0, 1000.0]
    assert found(column(spark, values, "double"))[("outliers", "c")]["examples"] == ["-500.0", "600.0", "700.0", "800.0", "900.0"]


def test_booleans_are_not_numbers(spark):
    df = column(spark, [True] * 30 + [False], "boolean")
    assert ("outliers", "c") not in found(df)


def test_negatives_need_a_telling_name(spark):
    df = spark.createDataFrame([(i, -1.0 - i, -1.0 - i) for i in range(30)], "pos bigint, unit_price double, shift double")
    issues = found(df)
    assert issues[("negative_values", "unit_price")]["affected"] == 30
    assert ("negative_values", "shift") not in issues


@pytest.mark.parametrize("numbers, expected", [(6, "non_numeric_in_numeric"), (5, None)])
def test_sixty_percent_numbers_make_a_numeric_column(spark, numbers, expected):
    values = [f"{i}.5" for i in range(numbers)] + ["x"] * (10 - numbers)
    kinds = {k for k, _ in found(column(spark, values)) if k != "duplicate_rows"}
    assert kinds == ({expected} if expected else set())


def test_number_decoration(spark):
    values = ["1", "2.5", "₹1,999", "$ 3", "7%", "1e3", "1f", "inf"]
    issues = found(column(spark, values))
    assert issues[("numeric_formatting", "c")]["examples"] == ["₹1,999", "$ 3", "7%"]
    assert issues[("non_numeric_in_numeric", "c")]["examples"] == ["1f", "inf"]


def test_dates_by_content_and_by_name(spark):
    seven = [f"2024-01-{i:02d}" for i in range(1, 8)] + ["31/02/2024", "2024-13-01", "99/99/9999"]
    assert found(column(spark, seven))[("invalid_dates", "c")]["affected"] == 3
    six = seven[:6] + ["2024-02-30"] * 4  # under seventy percent: not a date column
    assert ("invalid_dates", "c") not in found(column(spark, six))
    named = column(spark, six).withColumnRenamed("c", "Date of call")
    assert found(named)[("invalid_dates", "Date of call")]["affected"] == 4


def test_category_limit_of_sixty(spark):
    for n, expected in ((60, True), (61, False)):
        values = [f"v{i}" for i in range(n - 1)] + ["V0"]
        assert (("category_variants", "c") in found(column(spark, values))) is expected


def test_variants_in_order_of_appearance(spark):
    issue = found(column(spark, ["b-1", "A x", "B1", "a X", "b1", "c"]))[("category_variants", "c")]
    assert issue["examples"] == ["'b-1' / 'B1' / 'b1'", "'A x' / 'a X'"]
    assert issue["affected"] == 5


def test_non_latin_values_share_the_empty_key(spark):
    df = column(spark, ["東京", "大阪", "x"])
    assert found(df)[("category_variants", "c")]["affected"] == 2
    known = profile.text_class(profile.pinned_counters(df, "pos")).collect()
    h = checks.category_histogram(df, known, "pos")
    assert checks.variant_groups(h, drop_empty_key=True).count() == 0


def test_column_names_with_dots_and_case(spark):
    df = spark.createDataFrame([(1, "a ", None), (2, "b", "x")], "pos bigint, `a.b c` string, `q` string")
    issues = found(df)
    assert issues[("whitespace", "a.b c")]["affected"] == 1 and issues[("missing", "q")]["affected"] == 1


def test_without_an_order_examples_go_by_frequency(spark):
    df = spark.createDataFrame([("?",), ("?",), ("-",), ("x",)], "c string")
    assert found(df, None)[("placeholder_missing", "c")]["examples"] == ["?", "-"]


def test_hot_value_and_ranking(spark):
    """One value holds a third of all rows; ties are ranked by column order."""
    df = spark.range(3000).select(
        F.col("id").alias("pos"),
        F.when(F.col("id") % 3 == 0, "N/A").otherwise(F.col("id").cast("string")).alias("a"),
        F.when(F.col("id") % 3 == 0, "N/A").otherwise(F.col("id").cast("string")).alias("b"),
    )
    ids = [(r["id"], r["column"]) for r in checks.scan(df, "pos", ["placeholder_missing"]).collect()]
    assert sorted(ids) == [("I01", "a"), ("I02", "b")]


def test_profile_limit_of_forty(spark, get):
    few = profile.column_profile(column(spark, [f"v{i}" for i in range(40)]), "pos")
    many = profile.column_profile(column(spark, [f"v{i:02d}" for i in range(41)] + ["v07"]), "pos")
    assert few.count() == 40
    assert get(many, "value", "n", "distinct_values")[0] == ("v00", 1, 41) and many.count() == 5
    assert ("v07", 2, 41) in get(many, "value", "n", "distinct_values")


def test_profile_approximate(spark):
    df = column(spark, [f"v{i}" for i in range(500)])
    d = profile.column_profile(df, "pos", approximate=True).first()["distinct_values"]
    assert 400 < d < 600


def test_sketch_never_hides_a_narrow_column(spark):
    """Sixty distinct values always pass the sketch."""
    wide = {f"c{j}": [f"{j}-{i}" for i in range(60)] for j in range(40)}
    df = spark.createDataFrame(list(zip(*wide.values())), list(wide))
    assert profile.few_valued(df, df.columns) == df.columns


@pytest.mark.parametrize("bracket_rows", [1_000_000, 50, 1])
def test_exact_quantiles_equal_numpy(spark, bracket_rows):
    rng = np.random.default_rng(1)
    a = rng.normal(0, 100, 3000)
    b = np.where(np.arange(3000) % 3 == 0, 7.0, np.round(rng.exponential(10, 3000), 1))  # hot value
    rows = [(float(x), float(y), None if i % 5 else float(i), None) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(4)
    probabilities = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = quantiles.exact_quantiles(df, ["a", "b", "c", "d"], probabilities, bracket_rows=bracket_rows)
    c = np.arange(0, 3000, 5, dtype=float)
    for name, values in (("a", a), ("b", b), ("c", c)):
        assert np.allclose(got[name], np.quantile(values, probabilities), rtol=0, atol=1e-9)
    assert got["d"] is None


def test_report_lines(spark):
    issues = checks.scan(column(spark, ["N/A", "x"]), "pos", ["placeholder_missing"])
    lines = [r["line"] for r in checks.report_lines(issues, 1234, 1).orderBy("line_no").collect()]
    assert lines[0] == "Scanned 1,234 rows x 1 columns: 1 issues found"
    assert lines[1].startswith("[I01] HIGH   placeholder_missing      c | 1 placeholder values")


def test_wide_table(spark):
    """More columns than one group of counters or examples holds."""
    names = [f"c{i}" for i in range(100)]
    rows = [(p, *[("N/A" if (p + i) % 10 == 0 else f" v{p}") for i in range(100)]) for p in range(30)]
    df = spark.createDataFrame(rows, "pos bigint, " + ", ".join(f"{n} string" for n in names))
    issues = checks.scan(df, "pos", ["placeholder_missing", "whitespace"]).collect()
    assert len(issues) == 200 and {r["affected"] for r in issues if r["kind"] == "placeholder_missing"} == {3}
    assert all(len(r["examples"]) == (1 if r["kind"] == "placeholder_missing" else 5) for r in issues)
    assert len({r["id"] for r in issues}) == 200
