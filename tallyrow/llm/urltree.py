"""URL filter: a path-template tree per host, judged by smoothed labelled purity.

The tree grows level by level. At each node a segment is variable and becomes ``*`` unless enough
pages have it and it either has its share of the node's pages or differs clearly from the node in
its share of bad pages (a z-test on labelled pages). Branches that do not differ from the node
are statistically alike and are merged into one branch ``~``, so that their subtrees are learnt
together; those that differ are compared with each other in the order of their shares, and
neighbours that do not differ are merged into one branch, ``~`` and its first name. A template is
the path of such names; its purity is its share of good pages, smoothed towards its host's, which
is smoothed towards that of all pages. Pages of templates whose purity is below ``min_purity``
are blocked.

Explicit rules go first: a rule (host, path) fits its host and all subdomains, if the page's
path starts with the rule's; the longest rule wins.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; path:
from there up to ``?``, ``#`` or the end. A null url, or one without ``://``, has an empty host
and path and is judged by the purity of such pages. Paths may have any number of segments and
urls any length: the tree ends where no node has the pages for a branch of its own, and what lies
beyond is ``~``. Pages without labels count for the shape of the tree only. Repeated rows are pages of
their own. An empty table gives no rows. Only the id, the url and the labels are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyrow.llm.common import ascii_lower, cut, fresh, small_side

#: Fixed by the contract.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: A segment stays as it is with so many pages and such a share of its node's pages, or with so
#: many labelled pages and so many standard errors from its node.
MIN_PAGES, MIN_SHARE, CLEAR = 5, 0.05, 4.0
#: Branches closer to their node, or to each other, than this many standard errors are merged.
ALIKE = 2.0
#: Branches of a node are compared with each other in this many steps of their share of bad pages.
STEPS = 1000
SMOOTHING, MIN_PURITY = 10.0, 0.5
#: Tree tables of up to so many rows are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 200_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, name in sorted(rules, key=lambda r: len(r[1])):
        own, prefix = name.split("/", 1)
        fits = ((host == own) | F.endswith(host, F.lit(f".{own}"))) & F.startswith(path, F.lit(f"/{prefix}"))
        rule, verdict = F.when(fits, F.lit(name)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def document_of(path: Column) -> Column:
    """The document a page shows: the last number in its path."""
    return F.regexp_extract(path, r"([0-9]+)[^0-9]*$", 1).try_cast("bigint")


def bad_labels(labels: DataFrame) -> DataFrame:
    """(labelled, bad): one row per labelled document; low quality or toxic is bad."""
    bad = (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    return labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("labelled")).agg(F.max(bad.cast("int")).alias("bad"))


def _purity(bad: str, seen: str, prior: Column) -> Column:
    return (F.col(seen) - F.col(bad) + F.lit(SMOOTHING) * prior) / (F.col(seen) + F.lit(SMOOTHING))


def _off(bad: str, seen: str, rate: Column) -> Column:
    """Standard errors between a branch's bad pages and those its node's rate gives."""
    return F.abs(F.col(bad) - F.col(seen) * rate) / F.sqrt(F.greatest(F.col(seen), F.lit(1)) * rate * (1 - rate))


def _merged(branches: DataFrame) -> DataFrame:
    """(host, node, name, literal, branch) of the branches of all nodes: alike with the node, or
    with each other. A node's branches meet in at most STEPS rows, however many they are."""
    step = F.floor(F.lit(STEPS) * (F.col("bad") + F.lit(SMOOTHING) * F.col("rate")) / (F.col("seen") + F.lit(SMOOTHING)))
    judged = branches.withColumn("off", _off("bad", "seen", F.col("rate"))).withColumn("step", step)
    apart = judged.filter(F.col("off") >= ALIKE).groupBy("host", "node", "step").agg(
        F.sum("seen").alias("n"), F.sum("bad").alias("b"), F.count(F.lit(1)).alias("names"), F.min("name").alias("first")
    )
    order = Window.partitionBy("host", "node").orderBy("step")
    n, b = F.lag("n").over(order), F.lag("b").over(order)
    both = (b + F.col("b")) / (n + F.col("n"))
    error = F.sqrt(both * (1 - both) * (1 / n + 1 / F.col("n")))
    new = F.coalesce(F.abs(b / n - F.col("b") / F.col("n")) >= ALIKE * error, F.lit(False)) & (error > 0)
    grouped = apart.withColumn("new", F.when(new, 1).otherwise(0)).withColumn("group", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = Window.partitionBy("host", "node", "group")
    shared = grouped.select(
        "host", "node", "step", F.when(F.sum("names").over(whole) > 1, F.concat(F.lit("~"), F.min("first").over(whole))).alias("shared"), F.lit(True).alias("apart")
    )
    named = judged.withColumn("apart", F.col("off") >= ALIKE).join(small_side(shared, BROADCAST_ROWS), ["host", "node", "step", "apart"], "left")
    return named.select("host", "node", "name", "literal", F.when(F.col("apart"), F.coalesce("shared", "name")).otherwise(F.lit("~")).alias("branch"))


def templates(rows: DataFrame) -> DataFrame:
    """Adds ``node``, the template, to rows (host, path, seen, bad)."""
    parts = F.filter(F.split("path", "/"), lambda s: s != "")
    rows = cut(rows.withColumn("parts", parts).withColumn("node", F.lit("")))
    depth = rows.agg(F.max(F.size("parts"))).first()[0] or 0
    for level in range(1, depth + 1):
        seg = F.get("parts", F.lit(level - 1))
        here = rows.filter(F.size("parts") >= level).withColumn("seg", seg)
        sums = [F.sum(c).alias(c) for c in ("pages", "seen", "bad")]
        children = here.withColumn("pages", F.lit(1)).groupBy("host", "node", "seg").agg(*sums)
        parents = cut(children.groupBy("host", "node").agg(*[F.sum(c).alias(f"all_{c}") for c in ("pages", "seen", "bad")]))
        if (parents.agg(F.max("all_pages")).first()[0] or 0) < MIN_PAGES:
            # no branch of its own from here on: each pooled branch is its node
            beyond = F.greatest(F.size("parts") - (level - 1), F.lit(0))
            return rows.withColumn("node", F.concat("node", F.repeat(F.lit("/~"), beyond)))
        rate = (F.col("all_bad") + 0.5) / (F.col("all_seen") + 1.0)
        children = children.join(small_side(parents, BROADCAST_ROWS), ["host", "node"]).withColumn("rate", rate)
        clear = (F.col("seen") >= MIN_PAGES) & (_off("bad", "seen", F.col("rate")) >= CLEAR)
        stays = (F.col("pages") >= MIN_PAGES) & ((F.col("pages") >= MIN_SHARE * F.col("all_pages")) | clear)
        branches = (
            children.withColumn("name", F.when(stays, F.col("seg")).otherwise(F.lit("*")))
            .withColumn("literal", stays)
            .groupBy("host", "node", "name", "literal")
            .agg(*sums, F.first("rate").alias("rate"))
        )
        named = cut(_merged(cut(branches)))
        own = small_side(named.filter("literal").select("host", "node", F.col("name").alias("seg"), F.col("branch").alias("own")), BROADCAST_ROWS)
        other = small_side(named.filter("NOT literal").select("host", "node", F.col("branch").alias("other")), BROADCAST_ROWS)
        found = rows.withColumn("seg", seg).join(own, ["host", "node", "seg"], "left").join(other, ["host", "node"], "left")
        step = F.concat("node", F.lit("/"), F.coalesce("own", "other"))
        rows = cut(found.withColumn("node", F.when(F.size("parts") >= level, step).otherwise(F.col("node"))).drop("seg", "own", "other"))
    return rows


def judge(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    min_purity: float = MIN_PURITY,
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """One row per page: page_id, host, path, rule (or null), verdict, template, purity."""
    host, path = host_and_path(F.col(url))
    located = pages.select(F.col(page_id).alias("id"), host.alias("host"), path.alias("path")).withColumn("doc", document_of(F.col("path")))
    rows = located.join(bad_labels(labels), F.col("doc") == F.col("labelled"), "left")
    rows = rows.select("id", "host", "path", F.col("bad").isNotNull().cast("long").alias("seen"), F.coalesce("bad", F.lit(0)).cast("long").alias("bad"))
    rows = templates(rows)
    sums = [F.sum("seen").alias("seen"), F.sum("bad").alias("bad")]
    leaves = cut(rows.groupBy("host", "node").agg(*sums))
    total = leaves.agg(*sums).first()
    seen, bad = total["seen"] or 0, total["bad"] or 0
    overall = F.lit((seen - bad + 1.0) / (seen + 1.0))
    hosts = leaves.groupBy("host").agg(*sums).select("host", _purity("bad", "seen", overall).alias("host_purity"))
    judged = leaves.join(hosts, "host").select("host", "node", _purity("bad", "seen", F.col("host_purity")).alias("purity"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("purity") < min_purity, F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(small_side(judged, BROADCAST_ROWS), ["host", "node"]).select(
        F.col("id").alias(page_id), "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), F.col("node").alias("template"), "purity"
    )


def allowed(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str]] = RULES, min_purity: float = MIN_PURITY, url: str = "url") -> DataFrame:
    """The pages that are not blocked, with all their columns; pages of one url share its verdict."""
    host, path = host_and_path(F.col(url))
    judged = judge(pages.withColumn(fresh(pages, "row"), F.lit(0)), labels, rules, min_purity, fresh(pages, "row"), url)
    h, p = fresh(pages, "blocked_host"), fresh(pages, "blocked_path")
    blocked = judged.filter("verdict = 'block'").select(F.col("host").alias(h), F.col("path").alias(p)).distinct()
    return pages.join(blocked, (host == F.col(h)) & (path == F.col(p)), "left_anti")


def _oracle(depth: int = 16) -> str:
    """The same rows for paths of up to ``depth`` segments."""
    lower = ("'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'")
    ctes = [
        "u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN url[strpos(url, '://') + 3:] ELSE '' END AS rest FROM pages)",
        f"p AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), {lower[0]}, {lower[1]}) AS host, "
        "regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM u)",
        "lab AS (SELECT doc_id, max(CASE WHEN coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1 THEN 1 ELSE 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY 1)",
        "t0 AS (SELECT page_id, host, path, CASE WHEN bad IS NULL THEN 0 ELSE 1 END AS seen, coalesce(bad, 0) AS bad, "
        "list_filter(string_split(path, '/'), lambda x: x <> '') AS parts, '' AS node "
        "FROM p LEFT JOIN lab ON try_cast(regexp_extract(path, '([0-9]+)[^0-9]*$', 1) AS BIGINT) = lab.doc_id)",
    ]
    off = "abs(bad - seen * rate) / sqrt(greatest(seen, 1) * rate * (1 - rate))"
    for k in range(1, depth + 1):
        ctes += [
            f"c{k} AS (SELECT host, node, parts[{k}] AS seg, count(*)::DOUBLE AS pages, sum(seen)::DOUBLE AS seen, sum(bad)::DOUBLE AS bad FROM t{k - 1} WHERE len(parts) >= {k} GROUP BY 1, 2, 3)",
            f"a{k} AS (SELECT *, sum(pages) OVER w AS all_pages, (sum(bad) OVER w + 0.5::DOUBLE) / (sum(seen) OVER w + 1.0::DOUBLE) AS rate FROM c{k} WINDOW w AS (PARTITION BY host, node))",
            f"l{k} AS (SELECT *, pages >= {MIN_PAGES} AND (pages >= {MIN_SHARE}::DOUBLE * all_pages OR (seen >= {MIN_PAGES} AND {off} >= {CLEAR}::DOUBLE)) AS literal FROM a{k})",
            f"b{k} AS (SELECT host, node, CASE WHEN literal THEN seg ELSE '*' END AS name, literal, sum(seen) AS seen, sum(bad) AS bad, any_value(rate) AS rate FROM l{k} GROUP BY 1, 2, 3, 4)",
            f"o{k} AS (SELECT *, {off} >= {ALIKE}::DOUBLE AS apart, floor({STEPS}::DOUBLE * (bad + {SMOOTHING}::DOUBLE * rate) / (seen + {SMOOTHING}::DOUBLE)) AS step FROM b{k})",
            f"s{k} AS (SELECT host, node, step, sum(seen) AS n, sum(bad) AS b, count(*) AS names, min(name) AS first FROM o{k} WHERE apart GROUP BY 1, 2, 3)",
            f"v{k} AS (SELECT *, lag(n) OVER w AS n0, lag(b) OVER w AS b0 FROM s{k} WINDOW w AS (PARTITION BY host, node ORDER BY step))",
            f"e{k} AS (SELECT *, sqrt((b + b0) / (n + n0) * (1 - (b + b0) / (n + n0)) * (1 / n + 1 / n0)) AS error FROM v{k})",
            f"w{k} AS (SELECT *, sum(CASE WHEN error > 0 AND abs(b / n - b0 / n0) >= {ALIKE}::DOUBLE * error THEN 1 ELSE 0 END) OVER (PARTITION BY host, node ORDER BY step) AS grp FROM e{k})",
            f"q{k} AS (SELECT host, node, step, CASE WHEN sum(names) OVER w > 1 THEN '~' || min(first) OVER w END AS shared FROM w{k} WINDOW w AS (PARTITION BY host, node, grp))",
            f"n{k} AS (SELECT o.host, o.node, o.name, o.literal, CASE WHEN apart THEN coalesce(shared, name) ELSE '~' END AS branch FROM o{k} o "
            f"LEFT JOIN q{k} q ON o.apart AND q.host = o.host AND q.node = o.node AND q.step = o.step)",
            f"t{k} AS (SELECT t.page_id, t.host, t.path, t.seen, t.bad, t.parts, CASE WHEN len(t.parts) >= {k} THEN t.node || '/' || coalesce(x.branch, y.branch) "
            f"ELSE t.node END AS node FROM t{k - 1} t LEFT JOIN n{k} x ON x.literal AND x.host = t.host AND x.node = t.node AND x.name = t.parts[{k}] "
            f"LEFT JOIN n{k} y ON NOT y.literal AND y.host = t.host AND y.node = t.node)",
        ]
    last = f"t{depth}"
    arms = " ".join(
        f"WHEN (host = '{name.split('/', 1)[0]}' OR ends_with(host, '.{name.split('/', 1)[0]}')) AND starts_with(path, '/{name.split('/', 1)[1]}') THEN '{{{i}}}'"
        for i, (_, name) in sorted(enumerate(RULES), key=lambda r: -len(r[1][1]))
    )
    rule, verdict = (f"CASE {arms} END".format(*[r[n] for r in RULES]) for n in (1, 0))
    ctes += [
        f"leaf AS (SELECT host, node, sum(seen) AS seen, sum(bad) AS bad FROM {last} GROUP BY 1, 2)",
        "every AS (SELECT (sum(seen) - sum(bad) + 1.0::DOUBLE) / (sum(seen) + 1.0::DOUBLE) AS g FROM leaf)",
        f"hp AS (SELECT host, (sum(seen) - sum(bad) + {SMOOTHING}::DOUBLE * any_value(g)) / (sum(seen) + {SMOOTHING}::DOUBLE) AS hp FROM leaf, every GROUP BY 1)",
        f"j AS (SELECT host, node, (seen - bad + {SMOOTHING}::DOUBLE * hp) / (seen + {SMOOTHING}::DOUBLE) AS purity FROM leaf JOIN hp USING (host))",
    ]
    return (
        "WITH " + ",\n".join(ctes) + f"\nSELECT page_id, host, path, {rule} AS rule, coalesce({verdict}, CASE WHEN purity < {MIN_PURITY}::DOUBLE THEN 'block' ELSE 'allow' END) "
        f"AS verdict, node AS template, purity FROM {last} JOIN j USING (host, node)"
    )


ORACLE = _oracle()
