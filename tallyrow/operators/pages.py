"""Page text to conjugation records, one page at a time and without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyrow.functions import vocabulary as v
from tallyrow.functions.text import named, strip


def lines_of(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: strip(line) != "")


def page_lines(pages: DataFrame, key: str = "page", text: str = "text") -> DataFrame:
    """(key, pos, line): non-blank lines, numbered from 0."""
    return pages.select(named(key), F.posexplode(lines_of(named(text))).alias("pos", "line"))


def page_headings(pages: DataFrame, key: str = "page", text: str = "text") -> DataFrame:
    """(key, verb, meaning) of the pages that carry a heading."""
    return with_heading(pages, text).select(named(key), "verb", "meaning")


def with_heading(pages: DataFrame, text: str = "text") -> DataFrame:
    pattern = "(?U)" + v.VERB_HEADING
    verb = strip(F.regexp_extract(named(text), pattern, 1))
    meaning = strip(F.regexp_extract(named(text), pattern, 2))
    return pages.filter(named(text).contains("•")).withColumns({"verb": verb, "meaning": meaning}).filter("verb <> ''")


def sections(lines: Column, is_header) -> Column:
    """array<struct(header, first, body)>: the lines after each header up to the next.

    ``is_header`` maps (line, index) to a condition. The header travels with its body, so
    no window over the lines of a page is needed.
    """
    indexed = F.transform(lines, lambda line, i: F.struct(line.alias("line"), i.alias("i")))
    heads = F.transform(F.filter(indexed, lambda x: is_header(x["line"], x["i"])), lambda x: x["i"])
    starts = F.concat(F.array(F.lit(-1)), heads)
    ends = F.concat(heads, F.array(F.size(lines)))

    def section(edge):
        start, end = edge["starts"], edge["ends"]
        return F.struct(
            F.when(start >= 0, F.get(lines, start)).alias("header"),
            (start + 1).alias("first"),
            F.slice(lines, start + 2, end - start - 1).alias("body"),
        )

    return F.transform(F.arrays_zip(starts.alias("starts"), ends.alias("ends")), section)


def carry_forward(df: DataFrame, key: str, lines: Column, is_header) -> DataFrame:
    """(key, pos, header, line): every line that is no header, with the last header before it."""
    split = df.select(named(key), F.explode(sections(lines, is_header)).alias("s"))
    return split.select(named(key), "s.header", "s.first", F.posexplode("s.body").alias("offset", "line")).select(
        named(key), (F.col("first") + F.col("offset")).alias("pos"), "header", "line"
    )


def conjugation_lines(pages: DataFrame) -> DataFrame:
    """(page, verb, meaning, pos, header, line) of the pages with a heading."""
    known = list(v.TENSE_HEADERS)
    headed = with_heading(pages).withColumn("__lines", lines_of(F.col("text")))
    split = headed.select(
        "page", "verb", "meaning",
        F.explode(sections(F.col("__lines"), lambda line, i: line.isin(known))).alias("s"),
    )
    return split.select(
        "page", "verb", "meaning", "s.header", "s.first", F.posexplode("s.body").alias("offset", "line")
    ).select("page", "verb", "meaning", (F.col("first") + F.col("offset")).alias("pos"), "header", "line")


def _opens_subjunctive() -> Column:
    opens = F.lit(False)
    for start in v.SUBJUNCTIVE_OPENINGS:
        opens = opens | F.col("line").startswith(start)
    return opens


def _grid(line: Column, header: Column) -> Column:
    """Pairs of a line under a tense header: the i-th pair belongs to the i-th tense, and
    an empty form still uses up its tense."""
    tenses = F.create_map(
        *[x for h, names in v.TENSE_HEADERS.items() for x in (F.lit(h), F.array(*[F.lit(t) for t in names]))]
    )
    pattern = F.lit("(?U)" + v.GRID_FORM)
    zipped = F.arrays_zip(
        F.regexp_extract_all(line, pattern, F.lit(1)).alias("pronoun"),
        F.regexp_extract_all(line, pattern, F.lit(2)).alias("form"),
        tenses[header].alias("tense"),
    )
    entry = lambda m, i: F.struct(m["tense"], m["pronoun"], strip(m["form"]).alias("form"), i.alias("slot"))
    known = lambda m: m["tense"].isNotNull() & m["pronoun"].isNotNull() & (m["form"] != "")
    return F.filter(F.transform(zipped, entry), known)


def _paired(line: Column, pattern: str, pronoun_group: int, tense: str, first_slot: int) -> Column:
    found = F.lit("(?U)" + pattern)
    zipped = F.arrays_zip(
        F.regexp_extract_all(line, found, F.lit(pronoun_group)).alias("pronoun"),
        F.regexp_extract_all(line, found, F.lit(3 - pronoun_group)).alias("form"),
    )
    entry = lambda m, i: F.struct(
        F.lit(tense).alias("tense"), m["pronoun"], m["form"], (i + first_slot).alias("slot")
    )
    return F.transform(zipped, entry)


def _records(lines: DataFrame, entries: Column) -> DataFrame:
    return lines.select("verb", "meaning", "page", "pos", F.explode(entries).alias("r")).select(
        "verb", "meaning", "r.tense", "r.pronoun", "r.form", "page", "pos", "r.slot"
    )


def _subjunctive(line: Column) -> Column:
    return _paired(line, v.SUBJUNCTIVE_FORM, 1, v.SUBJUNCTIVE_TENSE, 0)


def _imperative(line: Column) -> Column:
    return _paired(line, v.IMPERATIVE_FORM, 2, v.IMPERATIVE_TENSE, 1000)


def grid_records(lines: DataFrame) -> DataFrame:
    grid = lines.filter(F.col("header").isNotNull() & ~_opens_subjunctive())
    return _records(grid, _grid(F.col("line"), F.col("header")))


def subjunctive_records(lines: DataFrame) -> DataFrame:
    return _records(lines.filter(_opens_subjunctive()), _subjunctive(F.col("line")))


def imperative_records(lines: DataFrame) -> DataFrame:
    """Imperatives stand on the lines that open with a subjunctive pronoun."""
    return _records(lines.filter(_opens_subjunctive()), _imperative(F.col("line")))


def conjugation_records(pages: DataFrame) -> DataFrame:
    """All records of all pages in one pass; ``pos`` and ``slot`` give their order."""
    line, header = F.col("line"), F.col("header")
    entries = F.when(_opens_subjunctive(), F.concat(_subjunctive(line), _imperative(line))).when(
        header.isNotNull(), _grid(line, header)
    )
    return _records(conjugation_lines(pages), entries)


def parse_summary(records: DataFrame) -> DataFrame:
    """(page, verb, forms) per page plus a last row with totals: page NULL, verb count as text."""
    per_page = records.groupBy("page", "verb").agg(F.count(F.lit(1)).alias("forms"))
    total = per_page.agg(
        F.lit(None).cast("bigint").alias("page"),
        F.count_distinct("verb").cast("string").alias("verb"),
        F.coalesce(F.sum("forms"), F.lit(0)).alias("forms"),
    )
    return per_page.select(F.col("page").cast("bigint").alias("page"), "verb", "forms").unionByName(total)
