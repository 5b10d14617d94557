"""Word lists, patterns, formats and lookup tables.

These decide results, so they are stated once, plainly, and nowhere else.
"""

from __future__ import annotations

import re

# --- fixed values: data-quality checks -------------------------------------

PLACEHOLDERS = ["", "n/a", "na", "null", "none", "nan", "-", "--", "unknown", "?", "not recorded"]

NON_NEGATIVE_HINTS = ["qty", "quantity", "price", "amount", "count", "age", "units", "total"]

# characters ignored when a text value is read as a number (plus white space)
NUMBER_DECORATION = ",$€£₹¥%"

# the one form that is not a guess
ISO_DATE = (r"\d{4}-\d{1,2}-\d{1,2}", "yyyy-M-d")
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
_MONTH = (
    r"(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|"
    r"sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)\.?"
)
_WEEKDAY = r"(?:mon|tues?|wed(?:nes)?|thu(?:rs?)?|fri|sat(?:ur)?|sun)(?:day)?\.?,?\s+"
_DAY, _ORDINAL, _YEAR, _NUMBERED = r"(\d{1,2})", r"(?:st|nd|rd|th)?", r"(\d{4}|\d{2})(?![\d:])", r"(0?[1-9]|1[0-2])"
_END = r"(?=$|[T ,])"
# what a date may look like at all
DATE_START = rf"(?i)^(?:\d{{8}}|\d{{1,4}}[-/.]\d|\d{{1,4}}{_ORDINAL}[-. ]*(?:of )?[ ]*[a-z]{{3}}|{_WEEKDAY}|{_MONTH}[-,. \d])"
LONGEST_DATE = 60
# spellings in the order they are tried, month before day: (pattern, what it becomes, =year|month|day|)
DATE_GRAMMAR = [
    (rf"(?i)^{_WEEKDAY}", ""),
    (rf"^(\d{{4}})([-/.])(\d{{1,2}})\2(\d{{1,2}}){_END}", "=$1|$3|$4|"),
    (rf"^(\d{{4}})(\d{{2}})(\d{{2}}){_END}", "=$1|$2|$3|"),
    (rf"^{_NUMBERED}([-/.])(\d{{1,2}})\2{_YEAR}", "=$4|$1|$3|"),
    (rf"^(\d{{1,2}})([-/.]){_NUMBERED}\2{_YEAR}", "=$4|$3|$1|"),
    (rf"^(\d{{4}})[-/]{_NUMBERED}$", "=$1|$2|1|"),
    (rf"^{_NUMBERED}[-/](\d{{4}})$", "=$2|$1|1|"),
    (rf"(?i)^{_DAY}{_ORDINAL}(?:\s+of)?[\s.-]*{_MONTH},?[\s-]*{_YEAR}", "=$3|$2|$1|"),
    (rf"(?i)^{_MONTH}[\s-]*{_DAY}{_ORDINAL}(?:,\s*|[\s-]+){_YEAR}", "=$3|$1|$2|"),
    (rf"(?i)^(\d{{4}})[\s-]+{_MONTH}[\s-]+{_DAY}{_END}", "=$1|$2|$3|"),
    (rf"(?i)^{_MONTH},?[\s-]+(\d{{4}})$", "=$2|$1|1|"),
]
# a time may follow a whole date, with half of the day and an offset or without; the last
# pattern gives year|month|day|hour|minute|second|fraction|half|offset|
_CLOCK_END = r"\s*(?:([ap])\.?m\.?)?\s*(Z|UTC|GMT|[+-]\d{2}:?\d{2})?$"
TIME_GRAMMAR = [
    (r"(?i)^(=.*\|)[T ]\s*(\d{2})(\d{2})(\d{2})?$", "$1 $2:$3:0$4"),
    (r"(?i)^(=.*\|),?\s+(\d{1,2})\s*([ap])\.?m\.?$", "$1 $2:00$3m"),
    (r"(?i)^=([^|]*)\|([^|]*)\|([^|]*)\|(?:(?:T|,?\s+)(\d{1,2}):(\d{1,2})(?::(\d{1,3})(?:\.(\d{1,6})\d*)?)?" + _CLOCK_END[:-1] + r")?$", "$1|$2|$3|$4|$5|$6|$7|$8|$9|"),
]


def _one_pass() -> tuple[str, str]:
    """Both grammars as one pattern and what it becomes, year|month|day|hour|minute|second|fraction|half|offset|=;
    fields that a spelling lacks are empty. A weekday and the first date that fits are never given back."""
    fields: dict[str, list[int]] = {name: [] for name in "ymdhisfaz"}
    used = 0

    def placed(pattern: str, names: str) -> str:
        """The pattern without its start, groups counted on; names holds the field of each group, - for none."""
        nonlocal used
        blind = pattern.startswith("(?i)")
        body = re.sub(r"\\([1-9])", lambda m: f"\\{int(m[1]) + used}", pattern.removeprefix("(?i)").removeprefix("^"))
        for i, name in enumerate(names, 1):
            if name != "-":
                fields[name].append(used + i)
        used += len(names)
        return f"(?{'i' if blind else ''}:{body})"

    weekday, *dates = DATE_GRAMMAR
    begin = placed(weekday[0], "")
    whole = []
    for pattern, becomes in dates:
        names = ["-"] * re.compile(pattern).groups
        for name, part in zip("ymd", becomes.strip("=|").split("|")):
            if part.startswith("$"):  # else the first day of a month
                names[int(part[1:]) - 1] = name
        whole.append(placed(pattern, "".join(names)))
    after = [(r"(?i)^(=.*\|)", "his"), (r"(?i)^(=.*\|)", "ha"), (r"(?i)^=([^|]*)\|([^|]*)\|([^|]*)\|", "hisfaz")]
    times = [placed("(?i)" + p.removeprefix(start), names) for (p, _), (start, names) in zip(TIME_GRAMMAR, after)]
    pattern = f"^{begin}?+(?>{'|'.join(whole)})(?:{'|'.join(times)})"
    return pattern, "".join("".join(f"${i}" for i in groups) + "|" for groups in fields.values()) + "="


DATE_PATTERN, DATE_FIELDS = _one_pass()
# two-digit years from here on belong to the 20th century
PIVOT_YEAR = 69

MAX_CATEGORIES = 60
MAX_PROFILE_VALUES = 40
MIN_VALUES_FOR_QUARTILES = 20
NUMERIC_TEXT_SHARE = 0.6
DIGIT_SHARE = 0.8
DATE_SHARE = 0.7
FENCE = 3.0

# notes of the apply log
NOTES = {
    "not_text": "not a text column; nothing to do",
    "numeric": "already numeric",
    "not_numeric": "column is not numeric (convert it first); skipped",
    "no_median": "median needs a numeric column; skipped",
    "no_mode": "no most-common value; skipped",
    "no_number": "{!r} is not a number; skipped",
    "no_value": "{!r} is no {}; skipped",
    "no_fill": "no fill method given; skipped",
    "left": "left as is",
    "skipped": "SKIPPED: {}",
    "absent": "column '{}' not found",
    "dropped": "column '{}' not found (already dropped?)",
    "other_type": "column '{}' holds {} values, which are no {}",
    "unknown": "unknown action '{}'",
}
# notes that tell a count, in the order they are joined
COUNT_NOTES = {
    "lost_numbers": "{} values could not be read as numbers and became empty",
    "guessed_dates": "WARNING: {} dates were not in YYYY-MM-DD form and were read as month/day/year; check they are right",
    "lost_dates": "{} values were not valid dates and became empty",
}

# kind -> (share for high, share for medium); kinds not named have a fixed severity
SEVERITY_SHARES = {
    "duplicate_rows": (0.1, 0.01),
    "missing": (0.2, 0.03),
    "outliers": (0.05, 0.005),
    "placeholder_missing": (0.2, 0.03),
    "invalid_dates": (0.05, 0.005),
}
FIXED_SEVERITY = {
    "constant_column": "low",
    "negative_values": "medium",
    "whitespace": "low",
    "numeric_formatting": "medium",
    "non_numeric_in_numeric": "high",
    "category_variants": "medium",
}
KINDS = [
    "duplicate_rows",
    "constant_column",
    "missing",
    "outliers",
    "negative_values",
    "placeholder_missing",
    "whitespace",
    "numeric_formatting",
    "non_numeric_in_numeric",
    "invalid_dates",
    "category_variants",
]
SEVERITY_RANK = {"high": 0, "medium": 1, "low": 2}

# --- fixed values: fix plans -----------------------------------------------

# run order of the actions
ACTIONS = [
    "strip_whitespace",
    "placeholders_to_null",
    "standardize_values",
    "convert_numeric",
    "parse_dates",
    "nullify_values",
    "fill_missing",
    "drop_duplicate_rows",
    "drop_column",
    "no_action",
]
SAFE_ACTIONS = ["drop_duplicate_rows", "strip_whitespace", "placeholders_to_null", "convert_numeric"]
ACTION_UNITS = {
    "strip_whitespace": "values trimmed",
    "placeholders_to_null": "placeholders set to empty",
    "standardize_values": "values renamed",
    "convert_numeric": "values converted to numbers",
    "parse_dates": "values converted to dates",
    "nullify_values": "values set to empty",
    "fill_missing": "empty cells filled",
    "drop_duplicate_rows": "rows removed",
    "drop_column": "column removed",
}
KIND_TO_ACTION = {
    "duplicate_rows": "drop_duplicate_rows",
    "whitespace": "strip_whitespace",
    "placeholder_missing": "placeholders_to_null",
    "numeric_formatting": "convert_numeric",
    "non_numeric_in_numeric": "convert_numeric",
    "invalid_dates": "parse_dates",
    "category_variants": "standardize_values",
    "outliers": "nullify_values",
    "negative_values": "nullify_values",
    "constant_column": "drop_column",
    "missing": "no_action",
}
KIND_TO_RULE = {"outliers": "outlier", "negative_values": "negative"}

# --- fixed values: posting red flags ---------------------------------------

URGENCY = (
    r"\b(urgent|immediate(ly)? start|act now|apply immediately|limited spots|"
    r"hiring fast|don't wait|start today)\b"
)
PERSONAL_INFO = (
    r"\b(ssn|social security|bank account|routing number|credit card|"
    r"passport number|date of birth|wire transfer)\b"
)
OFF_PLATFORM = (
    r"\b(gmail\.com|yahoo\.com|hotmail\.com|whatsapp|telegram|text me at|"
    r"call me at|\+\d{1,3}[\s-]?\d{6,})\b"
)
VAGUE_TITLE = (
    r"\b(work from home|earn \$?\d+|no experience needed|easy money|"
    r"be your own boss)\b"
)
# substrings of which every match of a pattern holds at least one
URGENCY_ANCHORS = [
    "urgent", "immediate", "act now", "limited spots", "hiring fast", "don't wait", "start today",
]
PERSONAL_INFO_ANCHORS = [
    "ssn", "social security", "bank account", "routing number", "credit card", "passport number",
    "date of birth", "wire transfer",
]
OFF_PLATFORM_ANCHORS = [
    "gmail.com", "yahoo.com", "hotmail.com", "whatsapp", "telegram", "text me at", "call me at", "+",
]
SHORT_DESCRIPTION_WORDS = 30

FLAGS = [
    "flag_no_salary",
    "flag_no_company_logo",
    "flag_no_company_profile",
    "flag_urgency_language",
    "flag_requests_personal_info",
    "flag_off_platform_contact",
    "flag_vague_title_language",
    "flag_short_description",
]
FEATURES = FLAGS + ["description_word_count"]
POSTING_COLUMNS = [
    ("job_id", "bigint"),
    ("title", "string"),
    ("location", "string"),
    ("department", "string"),
    ("employment_type", "string"),
    ("required_experience", "string"),
    ("required_education", "string"),
    ("industry", "string"),
    ("function", "string"),
    ("description_word_count", "int"),
    ("fraud_signal_count", "int"),
] + [(flag, "boolean") for flag in FLAGS]

# --- fixed values: conjugation pages and questions -------------------------

GRID_FORM = r"(Ils/elles|Il/elle|Nous|Vous|Tu|Je|J')\s*([^A-Zé]*(?:[a-zéèêàûîôç]+\s*)*)"
SUBJUNCTIVE_FORM = r"(Que je|Que tu|Qu'il/elle|Que nous|Que vous|Qu'ils/elles)\s+(\w+)"
IMPERATIVE_FORM = r"(\w+)\s*!\s*\((Tu|Nous|Vous)\)"
SUBJUNCTIVE_OPENINGS = ["Que je", "Que tu", "Qu'il", "Que nous", "Que vous", "Qu'ils"]
VERB_HEADING = r"•\s*(\S+(?:\s*\(?s[e']?\)?)?)\s+To\s+([^\n]+)"
SUBJUNCTIVE_TENSE = "subjonctif présent"
IMPERATIVE_TENSE = "impératif présent"
TENSE_HEADERS = {
    "Présent Passé composé Imparfait Plus-que-parfait":
        ["présent", "passé composé", "imparfait", "plus-que-parfait"],
    "Futur simple Futur antérieur":
        ["futur simple", "futur antérieur"],
    "Conditionnel présent Conditionnel passé":
        ["conditionnel présent", "conditionnel passé"],
}
PRONOUN_ORDER = [
    "Je", "J'", "Tu", "Il/elle", "Nous", "Vous", "Ils/elles",
    "Que je", "Que tu", "Qu'il/elle", "Que nous", "Que vous", "Qu'ils/elles",
]
UNKNOWN_PRONOUN_RANK = 99

# keyword -> tense, in order of priority
TENSE_KEYWORDS = [
    ("plus-que-parfait", "plus-que-parfait"),
    ("pluperfect", "plus-que-parfait"),
    ("passé composé", "passé composé"),
    ("passe compose", "passé composé"),
    ("compound past", "passé composé"),
    ("futur antérieur", "futur antérieur"),
    ("future perfect", "futur antérieur"),
    ("futur simple", "futur simple"),
    ("simple future", "futur simple"),
    ("conditionnel passé", "conditionnel passé"),
    ("conditional perfect", "conditionnel passé"),
    ("conditional past", "conditionnel passé"),
    ("conditionnel présent", "conditionnel présent"),
    ("conditional", "conditionnel présent"),
    ("subjonctif", "subjonctif présent"),
    ("subjunctive", "subjonctif présent"),
    ("impératif", "impératif présent"),
    ("imperative", "impératif présent"),
    ("imparfait", "imparfait"),
    ("imperfect", "imparfait"),
    ("présent", "présent"),
    ("present", "présent"),
    ("past", "passé composé"),
]
EXPLANATION_TRIGGERS = ["why", "explain", "difference", "when do i use", "when should i use", "how does"]
PASSAGE_PREFIX = "passage: "
QUERY_PREFIX = "query: "
CONTEXT_SEPARATOR = "\n\n---\n\n"

# --- fixed values: text classifier and fixed-width lines --------------------

TERM = r"(?U)\b\w\w+\b"
MAX_DOCUMENT_SHARE = 0.7
TEST_SHARE = 0.2
LINE_WIDTHS = [8, 35, 10, 10, 15, 15]
