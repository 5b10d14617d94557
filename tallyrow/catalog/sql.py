"""Shared common table expressions of the oracle SQL (DuckDB dialect)."""

from __future__ import annotations

from tallyrow.functions import vocabulary as v
from tallyrow.functions.text import WHITESPACE


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(lit(x) for x in values) + ")"


SPACES = lit(WHITESPACE)
NUMBER = r"'^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$'"


def strip(x: str) -> str:
    return f"trim({x}, {SPACES})"


def placeholder(x: str) -> str:
    return f"lower({strip(x)}) IN {in_list(v.PLACEHOLDERS)}"


def plain_number(x: str) -> str:
    return f"CASE WHEN regexp_matches({strip(x)}, {NUMBER}) THEN try_cast({strip(x)} AS DOUBLE) END"


def loose_number(x: str) -> str:
    return plain_number(f"translate({x}, {lit(v.NUMBER_DECORATION + WHITESPACE)}, '')")


def iso_date(x: str) -> str:
    return f"try_strptime({strip(x)}, '%Y-%m-%d')"


def any_date(x: str) -> str:
    formats = [
        "%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M", "%Y/%m/%d", "%Y.%m.%d", "%m/%d/%Y", "%d/%m/%Y",
        "%m-%d-%Y", "%d-%m-%Y", "%b %d %Y", "%b %d, %Y", "%B %d, %Y", "%d %b %Y", "%d %B %Y",
    ]
    return "coalesce(" + ", ".join(f"try_strptime({strip(x)}, '{f}')" for f in formats) + ")"


MESSY = """
base AS (
  SELECT o.o_orderkey AS k, c.c_name, o.o_totalprice, o.o_orderdate
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
dirty AS (
  SELECT k AS order_id,
    CASE WHEN k%41=0 THEN c_name || '  ' ELSE c_name END AS customer_name,
    CASE WHEN k%25=0 THEN 'lisboa' WHEN k%40=1 THEN 'Lisbon ' WHEN k%50=2 THEN 'GENEVA'
         ELSE ['Lisbon','Geneva','Turin','Basel','Krakow'][k%5+1] END AS city,
    CASE WHEN k%67=0 THEN 'not recorded' WHEN k%83=0 THEN '31/02/2024'
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
    CAST(CASE WHEN k%167=0 THEN 900 WHEN k%251=0 THEN -3 ELSE k%9+1 END AS BIGINT) AS quantity,
    CASE WHEN k%29=0 THEN 'N/A' WHEN k%50=0 THEN '€2,750'
         ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS amount,
    CASE WHEN k%17=0 THEN NULL WHEN k%33=0 THEN 'N/A' ELSE 'user' || k || '@example.com' END AS email,
    'CHF' AS currency
  FROM base),
messy AS (
  SELECT *, order_id AS row_pos FROM dirty
  UNION ALL SELECT *, order_id + 1099511627776 AS row_pos FROM dirty WHERE order_id%33=5)"""

MESSY_TEXT = ["customer_name", "city", "order_date", "amount", "email", "currency"]
MESSY_NUMBERS = ["order_id", "quantity"]
MESSY_ORDER = ["order_id", "customer_name", "city", "order_date", "quantity", "amount", "email", "currency"]


def severity(share: str, high: float, medium: float) -> str:
    return f"CASE WHEN {share} >= {high} THEN 'high' WHEN {share} >= {medium} THEN 'medium' ELSE 'low' END"


def quoted(x: str) -> str:
    return (
        f"CASE WHEN contains({x}, '''') AND NOT contains({x}, '\"') THEN '\"' || {x} || '\"' "
        f"ELSE '''' || replace({x}, '''', '\\''') || '''' END"
    )


def significant4(x: str) -> str:
    plain = f"regexp_replace(printf('%.4g', {x}), '^(-?[0-9])([0-9]{{3}})(\\.|$)', '\\1,\\2\\3')"
    return f"CASE WHEN abs({x}) < 10000 THEN {plain} ELSE printf('%.4g', {x}) END"


def scan(table: str, columns: list[str], numbers: list[str], prefix: str = "", dates: list[str] = ()) -> str:
    """CTEs ending in <prefix>issues: the whole scan of a table that has row_pos."""
    p = prefix
    texts = [c for c in columns if c not in numbers and c not in dates]

    def cell(i: int, c: str) -> str:
        text = c if c in texts else "NULL"
        number = f"CAST({c} AS DOUBLE)" if c in numbers else "NULL"
        return (
            f"SELECT {lit(c)} AS col, {i} AS seq, CAST({text} AS VARCHAR) AS t, CAST({number} AS DOUBLE) AS x, "
            f"CAST({c} AS VARCHAR) AS shown, row_pos, {str(c in texts).lower()} AS is_text FROM {table}"
        )

    cells = " UNION ALL ".join(cell(i, c) for i, c in enumerate(columns, 1))
    hints = " OR ".join(f"contains(lower(col), {lit(h)})" for h in v.NON_NEGATIVE_HINTS)
    value_kinds = (
        "('placeholder_missing', ph), ('whitespace', filled AND t <> s), "
        "('numeric_formatting', class='numeric_text' AND filled AND loose AND NOT plain), "
        "('non_numeric_in_numeric', class='numeric_text' AND filled AND NOT loose), "
        "('invalid_dates', class IN ('date','named_date') AND filled AND NOT dated), "
        "('outliers', x < lo OR x > hi), ('negative_values', hinted AND nn > 20 AND x < 0)"
    )
    return f"""
{p}cells AS ({cells}),
{p}judged AS (
  SELECT *, coalesce({placeholder('t')}, false) AS ph, t IS NOT NULL AND NOT {placeholder('t')} AS filled,
    {strip('t')} AS s, ({loose_number('t')}) IS NOT NULL AS loose, ({plain_number('t')}) IS NOT NULL AS plain,
    coalesce(regexp_matches(t, '\\p{{Nd}}'), false) AS digit, {any_date('t')} IS NOT NULL AS dated
  FROM {p}cells),
{p}stats AS (
  SELECT col, any_value(seq) AS seq, any_value(is_text) AS is_text, count(*) AS n, count(shown) AS nn,
    count(DISTINCT shown) AS nd, min(shown) AS single, count(*) FILTER (filled) AS nf,
    count(*) FILTER (filled AND loose) AS nl, count(*) FILTER (filled AND digit) AS ng,
    count(*) FILTER (filled AND dated AND NOT plain) AS nt, count(DISTINCT t) FILTER (filled) AS nfd,
    quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3, ({hints}) AS hinted
  FROM {p}judged GROUP BY col),
{p}classed AS (
  SELECT *, CASE WHEN nn > 20 AND q3 > q1 THEN q1 - 3*(q3-q1) END AS lo,
    CASE WHEN nn > 20 AND q3 > q1 THEN q3 + 3*(q3-q1) END AS hi,
    CASE WHEN NOT is_text THEN 'other' WHEN nf = 0 THEN 'empty' WHEN nl/nf >= 0.6 THEN 'numeric_text'
         WHEN ng/nf > 0.8 AND nt/nf >= 0.7 THEN 'date' WHEN contains(lower(col), 'date') THEN 'named_date'
         WHEN nfd <= 60 THEN 'category' ELSE 'wide' END AS class
  FROM {p}stats),
{p}flagged AS (
  SELECT j.col, seq, n, kind, shown, x, row_pos FROM (
    SELECT j.*, c.n, unnest([{', '.join('{kind: ' + k.strip('()').split(', ', 1)[0] + ', hit: coalesce(' + k.strip('()').split(', ', 1)[1] + ', false)}' for k in _split(value_kinds))}], recursive := true)
    FROM {p}judged j JOIN {p}classed c USING (col)) j WHERE hit),
{p}bad AS (
  SELECT kind, col, any_value(seq) AS seq, any_value(n) AS n, shown, count(*) AS c, min(row_pos) AS pos, min(x) AS x
  FROM {p}flagged GROUP BY kind, col, shown),
{p}placed AS (
  SELECT *, row_number() OVER (PARTITION BY kind, col ORDER BY CASE WHEN kind='outliers' THEN x END NULLS LAST, pos, shown) AS place FROM {p}bad),
{p}found AS (
  SELECT kind, col, any_value(seq) AS seq, any_value(n) AS n, sum(c) AS affected,
    string_agg(CASE WHEN kind='whitespace' THEN {quoted('shown')} ELSE shown END, ' | ' ORDER BY place) FILTER (place <= 5) AS examples,
    min(shown) FILTER (place = 1) AS first
  FROM {p}placed GROUP BY kind, col),
{p}spelled AS (
  SELECT j.col, regexp_replace(lower(s), '[^a-z0-9]', '', 'g') AS key, s, count(*) AS c, min(row_pos) AS pos
  FROM {p}judged j JOIN {p}classed k USING (col) WHERE filled AND class = 'category' GROUP BY ALL),
{p}variants AS (
  SELECT col, key, sum(c) AS c, min(pos) AS pos, string_agg({quoted('s')}, ' / ' ORDER BY pos, s) AS line
  FROM {p}spelled GROUP BY col, key HAVING count(*) > 1),
{p}all_found AS (
  SELECT kind, col, seq, n, affected, examples, first, NULL AS groups FROM {p}found
  UNION ALL SELECT 'constant_column', col, seq, n, n, '', NULL, NULL FROM {p}classed WHERE n > 1 AND nd <= 1
  UNION ALL SELECT 'missing', col, seq, n, n-nn, '', NULL, NULL FROM {p}classed WHERE n > nn
  UNION ALL SELECT 'category_variants', col, any_value(seq), any_value(n), sum(c),
      string_agg(line, ' | ' ORDER BY pos, key) FILTER (place <= 5), NULL, count(*)
    FROM (SELECT a.*, b.seq, b.n, row_number() OVER (PARTITION BY col ORDER BY pos, key) AS place
          FROM {p}variants a JOIN {p}classed b USING (col)) GROUP BY col
  UNION ALL SELECT * FROM (SELECT 'duplicate_rows', NULL, 0, sum(c), sum(c-1) AS d, '', NULL, NULL
    FROM (SELECT count(*) AS c FROM {table} GROUP BY {', '.join(columns)})) WHERE d > 0),
{p}told AS (
  SELECT f.kind, f.col, f.seq, f.n, CAST(f.affected AS BIGINT) AS affected, f.examples,
    CASE f.kind WHEN 'duplicate_rows' THEN {severity('f.affected/f.n', 0.1, 0.01)}
      WHEN 'missing' THEN {severity('f.affected/f.n', 0.2, 0.03)}
      WHEN 'placeholder_missing' THEN {severity('f.affected/f.n', 0.2, 0.03)}
      WHEN 'outliers' THEN {severity('f.affected/f.n', 0.05, 0.005)}
      WHEN 'invalid_dates' THEN {severity('f.affected/f.n', 0.05, 0.005)}
      WHEN 'constant_column' THEN 'low' WHEN 'whitespace' THEN 'low'
      WHEN 'non_numeric_in_numeric' THEN 'high' ELSE 'medium' END AS severity,
    CASE f.kind
      WHEN 'duplicate_rows' THEN f.affected || ' rows are exact copies of an earlier row'
      WHEN 'constant_column' THEN 'Only one distinct value (' || coalesce(single, 'none') || '); carries no information'
      WHEN 'missing' THEN f.affected || ' empty values (' || printf('%.1f', f.affected*100.0/f.n) || '%)'
      WHEN 'outliers' THEN f.affected || ' values far outside the normal range (' || {significant4('lo')} || ' to ' || {significant4('hi')} || ')'
      WHEN 'negative_values' THEN f.affected || ' negative values in a column that should not go below zero'
      WHEN 'placeholder_missing' THEN f.affected || ' placeholder values that mean ''missing'' (e.g. ' || {quoted('f.first')} || ')'
      WHEN 'whitespace' THEN f.affected || ' values have leading/trailing spaces'
      WHEN 'numeric_formatting' THEN f.affected || ' numbers carry symbols or separators (e.g. ' || {quoted('f.first')} || '), so the column is stored as text'
      WHEN 'non_numeric_in_numeric' THEN f.affected || ' values in a mostly-numeric column cannot be read as numbers'
      WHEN 'invalid_dates' THEN f.affected || ' values cannot be parsed as dates'
      WHEN 'category_variants' THEN f.groups || ' categories are spelled several ways' END AS detail
  FROM {p}all_found f LEFT JOIN {p}classed c ON f.col = c.col),
{p}issues AS (
  SELECT printf('I%02d', row_number() OVER (ORDER BY array_position(['high','medium','low'], severity), affected DESC, seq,
      array_position([{', '.join(lit(k) for k in v.KINDS)}], kind))) AS id,
    kind, col AS "column", severity, detail, affected, examples FROM {p}told)"""


def _split(kinds: str) -> list[str]:
    return [k if k.startswith("(") else "(" + k for k in kinds.replace("), (", ")\x00(").split("\x00")]


MESSY_SCAN = MESSY + "," + scan("messy", MESSY_ORDER, MESSY_NUMBERS)

POSTINGS = """
raw_postings AS (
  SELECT d.doc_id AS job_id,
    CASE d.doc_id%11 WHEN 0 THEN 'Work From Home clerk' WHEN 1 THEN 'Earn $500 weekly' WHEN 2 THEN NULL ELSE 'Analyst' END AS title,
    d.source AS industry, d.lang AS "function",
    CASE WHEN d.doc_id%9=0 THEN NULL ELSE d.text END AS description,
    CASE d.doc_id%13 WHEN 0 THEN 'Send your bank account number' WHEN 1 THEN 'Act now, hiring fast' ELSE '' END AS requirements,
    CASE d.doc_id%19 WHEN 0 THEN 'mail me at x@gmail.com' WHEN 1 THEN 'ring +1 5551234567' WHEN 2 THEN 'ring a+15551234567' ELSE '' END AS benefits,
    CASE WHEN d.doc_id%3=0 THEN '  ' WHEN d.doc_id%7=0 THEN NULL ELSE 'Profile' END AS company_profile,
    CASE WHEN d.doc_id%2=0 THEN NULL ELSE '10-20' END AS salary_range,
    CASE d.doc_id%5 WHEN 0 THEN 0 WHEN 1 THEN NULL ELSE 1 END AS has_company_logo,
    l.toxic AS fraudulent
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def _search(x: str, pattern: str) -> str:
    # the oracle engine's \\b, \\s and \\d are ASCII; the fixture texts need no more
    return f"regexp_matches({x}, {lit('(?i)' + pattern)})"


FLAGGED = POSTINGS + f""",
described AS (
  SELECT *, coalesce(description, '') || ' ' || requirements || ' ' || benefits AS body,
    CAST(len(list_filter(string_split_regex(coalesce(description, ''), '[\\s\\p{{Z}}]+'), lambda w: w <> '')) AS INTEGER) AS words
  FROM raw_postings),
flags AS (
  SELECT *, salary_range IS NULL AS flag_no_salary, coalesce(has_company_logo, 0) = 0 AS flag_no_company_logo,
    {strip("coalesce(company_profile, '')")} = '' AS flag_no_company_profile,
    {_search('body', v.URGENCY)} AS flag_urgency_language,
    {_search('body', v.PERSONAL_INFO)} AS flag_requests_personal_info,
    {_search('body', v.OFF_PLATFORM)} AS flag_off_platform_contact,
    {_search("coalesce(title, '')", v.VAGUE_TITLE)} AS flag_vague_title_language,
    words AS description_word_count, words < {v.SHORT_DESCRIPTION_WORDS} AS flag_short_description
  FROM described),
flagged_postings AS (
  SELECT *, CAST({' + '.join(f'{f}::INT' for f in v.FLAGS)} AS INTEGER) AS fraud_signal_count FROM flags),
clean_postings AS (
  SELECT job_id, title, NULL::VARCHAR AS location, NULL::VARCHAR AS department, NULL::VARCHAR AS employment_type,
    NULL::VARCHAR AS required_experience, NULL::VARCHAR AS required_education, industry, "function",
    description_word_count, fraud_signal_count, {', '.join(v.FLAGS)}, fraudulent::BOOLEAN AS fraudulent
  FROM flagged_postings)"""

FEATURES = FLAGGED + f""",
features AS (
  SELECT job_id, {', '.join(f'{f}::DOUBLE AS {f}' for f in v.FEATURES)}, fraudulent AS label
  FROM flagged_postings WHERE fraudulent IS NOT NULL)"""

PREDICTIONS = """
predictions AS (
  SELECT doc_id AS id, toxic AS truth, CASE WHEN doc_id%7=0 THEN 1-toxic ELSE toxic END AS pred,
    (doc_id%100)/100.0 AS prob FROM labels)"""

TENSES = sorted({t for _, t in v.TENSE_KEYWORDS})
VECTORS = f"""
cv AS (
  SELECT vec_id, embedding::DOUBLE[] AS e, 'verb_' || label AS verb_lower,
    [{', '.join(lit(t) for t in TENSES)}][vec_id%{len(TENSES)}+1] AS tense, vec_id%7+1 AS page FROM embeddings),
qv AS (
  SELECT vec_id AS query_id, e, CASE WHEN vec_id%100=0 THEN NULL ELSE verb_lower END AS verb,
    CASE WHEN vec_id%150=0 THEN NULL ELSE tense END AS tense FROM cv WHERE vec_id%50=0)"""


def topk(k: int, filtered: bool) -> str:
    where = "AND (q.verb IS NULL OR q.verb = c.verb_lower) AND (q.tense IS NULL OR q.tense = c.tense)" if filtered else ""
    return VECTORS + f""",
scored AS (
  SELECT q.query_id, c.vec_id, round(list_dot_product(q.e, c.e), 9) AS score, c.verb_lower, c.tense, c.page
  FROM qv q JOIN cv c ON q.query_id <> c.vec_id {where}),
top AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= {k})"""


_OPENINGS = ["Conjugate", "Why is", "Show me", "EXPLAIN", "what's the difference of", "présent"]
_WORDS = [k for k, _ in v.TENSE_KEYWORDS] + ["future simple", "represented", "tomorrow"]
QUESTIONS = f"""
questions AS (
  SELECT o_orderkey AS question_id,
    [{', '.join(lit(x) for x in _OPENINGS)}][o_orderkey%{len(_OPENINGS)}+1] || ' ' ||
    CASE WHEN o_orderkey%7=0 THEN 'parler' ELSE 'Verb_' || (o_orderkey%12) END || ' in the ' ||
    [{', '.join(lit(x) for x in _WORDS)}][(o_orderkey//5)%{len(_WORDS)}+1] ||
    CASE WHEN o_orderkey%11=0 THEN ' or verb_' || (o_orderkey%5) ELSE '' END || '?' AS question
  FROM orders),
entities AS (SELECT DISTINCT 'verb_' || label AS entity FROM embeddings),
entity_hits AS (
  SELECT question_id, entity FROM questions, entities
  WHERE list_contains(regexp_extract_all(lower(question), '[\\p{{L}}\\p{{M}}\\p{{N}}_]+'), entity)
  QUALIFY row_number() OVER (PARTITION BY question_id ORDER BY length(entity) DESC, entity) = 1),
asked AS (
  SELECT q.question_id, q.question, h.entity AS verb,
    CASE {' '.join(f'WHEN contains(lower(question), {lit(k)}) THEN {lit(t)}' for k, t in v.TENSE_KEYWORDS)} END AS tense
  FROM questions q LEFT JOIN entity_hits h USING (question_id))"""
