"""Column expressions on text. All of them stay inside generated JVM code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from tallyrow.functions import vocabulary as v

# every white-space character of the Basic Multilingual Plane
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())

_LIKE_ASCII = "ſıİ"
_LONGEST_PLACEHOLDER_BYTES = 3 * max(len(p) for p in v.PLACEHOLDERS)
_NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
_NUMBER_CHARACTERS = rf"(?U)^[0-9eE+\-.{v.NUMBER_DECORATION}\s]*+$"


def named(name: str) -> Column:
    """The column of exactly this name, dots and back-ticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def strip(c: Column) -> Column:
    """Unicode strip without a regex; a value without edge space is passed through."""
    space = F.lit(WHITESPACE)
    edges = F.contains(space, F.substring(c, 1, 1)) | F.contains(space, F.substring(c, -1, 1))
    return F.when(edges, F.btrim(c, space)).otherwise(c)


# The functions ending in _of expect a stripped value, so that a caller who needs
# several of them strips once.


def placeholder_of(s: Column) -> Column:
    # the byte-length test keeps long texts from being lower-cased in full
    return (F.octet_length(s) <= _LONGEST_PLACEHOLDER_BYTES) & F.lower(s).isin(v.PLACEHOLDERS)


def plain_number_of(s: Column) -> Column:
    """double where the value is a plain decimal number, else null."""
    return F.when(s.rlike(_NUMBER), s.try_cast("double"))


def loose_number_of(s: Column) -> Column:
    """As plain_number_of, after dropping separators, currency signs and spaces."""
    bare = F.translate(s, v.NUMBER_DECORATION + WHITESPACE, "")
    return F.when(s.rlike(_NUMBER_CHARACTERS), plain_number_of(bare))


def is_placeholder(c: Column) -> Column:
    return placeholder_of(strip(c))


def plain_number(c: Column) -> Column:
    return plain_number_of(strip(c))


def loose_number(c: Column) -> Column:
    return loose_number_of(strip(c))


def has_digit(c: Column) -> Column:
    return c.rlike(r"(?U)\d")


def iso_date_of(s: Column) -> Column:
    return F.when(s.rlike(f"^{v.ISO_DATE[0]}$"), F.try_to_timestamp(s, F.lit(v.ISO_DATE[1]))).cast("timestamp_ntz")


def any_date_of(s: Column) -> Column:
    """A date in any spelling of the grammar, with a time or without; month before day. The
    text is brought to one form by one pattern, cut into fields and made a timestamp once. A
    time with an offset becomes the session's time. The commonest spelling, a whole ISO date
    of ten characters, is the cast's own, which gives the same values without the pattern."""
    iso = (F.octet_length(s) == 10) & s.rlike(r"^\d{4}-\d{2}-\d{2}$")
    return F.when(iso, s.try_cast("date").cast("timestamp_ntz")).otherwise(_spelled_date_of(s))


def _spelled_date_of(s: Column) -> Column:
    form = F.regexp_replace(s, v.DATE_PATTERN, v.DATE_FIELDS)
    # a lambda's variable is computed once, however often it is used
    made = F.transform(F.array(F.split(form, r"\|")), _timestamp)[0]
    return F.when((F.octet_length(s) <= v.LONGEST_DATE) & s.rlike(v.DATE_START), made)


def _timestamp(fields: Column) -> Column:
    """From year, month (number or name), day, hour, minute, second, fraction, half, offset."""
    text = lambda i: F.get(fields, F.lit(i))
    # a failing try_cast builds an exception each time, so an empty field or a name is never cast
    number = lambda i: F.when(text(i).rlike(r"^\d{1,4}$"), text(i).try_cast("int"))
    short = number(0)
    year = F.when(F.length(text(0)) > 2, short).when(short >= v.PIVOT_YEAR, short + 1900).otherwise(short + 2000)
    name = F.array_position(F.array(*[F.lit(m) for m in v.MONTHS]), F.lower(F.substring(text(1), 1, 3))).cast("int")
    month = F.coalesce(number(1), name)
    hour, late = F.coalesce(number(3), F.lit(0)), F.lower(text(7)) == "p"
    clock = F.when(text(7) == "", hour).when(hour <= 12, hour % 12 + F.when(late, 12).otherwise(0))
    second = F.concat(F.when(text(5) == "", "0").otherwise(text(5)), F.lit("."), text(6), F.lit("0")).try_cast("decimal(16,6)")
    day = F.when(text(2) == "", 1).otherwise(number(2))
    parts = [year, month, day, clock, F.coalesce(number(4), F.lit(0)), second]
    zone = F.when(text(8).rlike("^[+-]"), F.regexp_replace(text(8), r"^([+-]\d{2}):?", "$1:")).otherwise(F.lit("UTC"))
    made = F.when(text(8) == "", F.try_make_timestamp_ntz(*parts)).otherwise(F.try_make_timestamp(*parts, zone).cast("timestamp_ntz"))
    return F.when((F.size(fields) == 10) & (text(9) == "="), made)


def iso_date(c: Column) -> Column:
    return iso_date_of(strip(c))


def any_date(c: Column) -> Column:
    return any_date_of(strip(c))


def category_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def word_count(c: Column) -> Column:
    words = F.split(strip(c), rf"[{WHITESPACE}]+")
    return F.when(strip(c) == "", 0).otherwise(F.size(words)).cast("int")


def folded(c: Column) -> Column:
    """Lower case, with the letters that a case-blind search also takes for s and i."""
    plain = F.when(contains_any(c, list(_LIKE_ASCII)), F.translate(c, _LIKE_ASCII, "sii")).otherwise(c)
    return F.lower(plain)


def matches(c: Column, pattern: str, fold: Column | None = None, anchors: list[str] | None = None) -> Column:
    """Unicode, case-blind search.

    Every match contains one of ``anchors`` in the folded text, so a plain substring
    test, many times faster than the regex, settles most long texts.
    """
    found = c.rlike("(?iuU)" + pattern)
    return contains_any(fold, anchors) & found if anchors else found


def contains_any(c: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(w) for w in words])


def quoted(c: Column) -> Column:
    """The value as a quoted literal, quotes and line ends made visible."""
    s = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for raw, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        s = F.replace(s, F.lit(raw), F.lit(shown))
    double = c.contains("'") & ~c.contains('"')
    single = F.concat(F.lit("'"), F.replace(s, F.lit("'"), F.lit("\\'")), F.lit("'"))
    return F.when(double, F.concat(F.lit('"'), s, F.lit('"'))).otherwise(single)


def percent(part: Column, whole: Column) -> Column:
    """One decimal, half-even on the exact value."""
    return F.concat(F.format_number(part * 100.0 / whole, 1), F.lit("%"))


def significant4(c: Column) -> Column:
    """Four significant digits, thousands grouped, no trailing zeros."""
    raw = F.format_string("%.3e", c.cast("double"))
    exponent = F.split(raw, "e")[1].cast("int")
    mantissa = F.split(raw, "e")[0]
    fixed = F.regexp_replace(raw.try_cast("decimal(30,12)").cast("string"), r"\.?0+$", "")
    fixed = F.regexp_replace(fixed, r"^(-?\d)(\d{3})(\.|$)", "$1,$2$3")
    science = F.concat(
        F.regexp_replace(mantissa, r"\.?0+$", ""),
        F.lit("e"),
        F.when(exponent < 0, "-").otherwise("+"),
        F.lpad(F.abs(exponent).cast("string"), 2, "0"),
    )
    return F.when(c == 0, "0").when(exponent.between(-4, 3), fixed).otherwise(science)


def pad(c: Column, width: int) -> Column:
    """Pad on the right, never truncate."""
    return F.when(F.length(c) < width, F.rpad(c, width, " ")).otherwise(c)


def first_rule(c: Column, rules: list[tuple[str, str]]) -> Column:
    """Value of the first rule whose keyword occurs in the lower-cased text."""
    low = F.lower(c)
    chain = F.when(low.contains(rules[0][0]), rules[0][1])
    for keyword, value in rules[1:]:
        chain = chain.when(low.contains(keyword), value)
    return chain.otherwise(F.lit(None).cast("string"))
