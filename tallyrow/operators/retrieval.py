"""Entity and keyword detection, filtered top-k search, answers and accuracy."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallyrow.functions import text as tx, vocabulary as v
from tallyrow.functions.text import named
from tallyrow.operators.sizing import broadcast_if_light, pin_if_small, staged

# queries, or chunks, of a cell that one group holds, and how many times as many it may
BLOCK_ROWS, WIDER = 8_192, 8
# queries and chunks of one matrix product, and chunks of a query's first product
TILE, FIRST = (1_024, 2_048), 256
# scores per matrix product: 16 MB of doubles
BLOCK_SCORES = 1 << 21


# --- what a question asks for ------------------------------------------------


def known_entities(chunks: DataFrame, column: str = "verb_lower") -> DataFrame:
    return chunks.select(named(column).alias("entity")).distinct()


def detect_entity(questions: DataFrame, entities: DataFrame, key: str = "question_id", text: str = "question") -> DataFrame:
    """(key, entity): the longest entity that occurs as a whole word, ties alphabetical.

    A whole-word match contains the entity's first run of word characters as a full
    token of the question, so candidates come from an equi-join on that token and only
    they are tested; an entity that is itself one token needs no test. Questions without a
    match are left out.
    """
    tokens = lambda c: F.regexp_extract_all(c, F.lit(r"(?U)\w+"), F.lit(0))
    asked = questions.select(named(key), F.lower(named(text)).alias("q"))
    asked = asked.select(named(key), "q", F.explode(F.array_distinct(tokens(F.col("q")))).alias("token"))
    names = entities.select("entity", F.try_element_at(tokens(F.col("entity")), F.lit(1)).alias("token"))
    candidates = asked.join(pin_if_small(names.filter("token is not null")), "token")
    whole = F.concat(F.lit(r"(?U)\b\Q"), "entity", F.lit(r"\E\b"))
    found = candidates.filter((F.col("entity") == F.col("token")) | F.rlike("q", whole))
    best = W.partitionBy(named(key)).orderBy(F.desc(F.length("entity")), "entity")
    return found.withColumn("place", F.row_number().over(best)).filter("place = 1").select(named(key), "entity")


def detect_tense(c: Column, rules: list[tuple[str, str]] | None = None) -> Column:
    """Tense of the first keyword that occurs anywhere in the question."""
    return tx.first_rule(c, rules or v.TENSE_KEYWORDS)


def with_filters(questions: DataFrame, entities: DataFrame, key: str = "question_id", text: str = "question") -> DataFrame:
    """Adds the verb and tense a question names; NULL where it names none."""
    verbs = detect_entity(questions, entities, key, text).withColumnRenamed("entity", "verb")
    return questions.join(verbs, key, "left").withColumn("tense", detect_tense(named(text)))


def is_explanatory(c: Column) -> Column:
    return tx.contains_any(F.lower(c), v.EXPLANATION_TRIGGERS)


# --- nearest chunks ----------------------------------------------------------


def metadata_filter(filters: DataFrame, chunks: DataFrame, key: str = "query_id", chunk_key: str = "vec_id") -> DataFrame:
    """(key, matches): how many chunks each query's filter admits.

    Chunks are counted per (verb, tense) first; the four kinds of filter then are
    equi-joins against that small table or its totals.
    """
    cube = chunks.groupBy("verb_lower", "tense").agg(F.count(F.lit(1)).alias("n"))
    totals = (
        cube.rollup("verb_lower", "tense").agg(F.sum("n").alias("n"), F.grouping_id().alias("g"))
        .unionByName(cube.groupBy("tense").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("verb_lower"), "tense", "n", F.lit(2).cast("bigint").alias("g")))
        .select(F.col("verb_lower").alias("__v"), F.col("tense").alias("__t"), F.col("n").alias("matches"), F.col("g").cast("int").alias("__g"))
    )
    kind = F.when(F.col("verb").isNull(), 2).otherwise(0) + F.when(F.col("tense").isNull(), 1).otherwise(0)
    asked = filters.select(named(key), "verb", "tense", kind.alias("kind"))
    on = (
        (F.col("kind") == F.col("__g"))
        & F.col("verb").eqNullSafe(F.col("__v"))
        & F.col("tense").eqNullSafe(F.col("__t"))
    )
    return asked.join(pin_if_small(totals), on, "left").select(named(key), F.coalesce("matches", F.lit(0)).alias("matches"))


_TOP = "query_id bigint, vec_id bigint, score double"


def _cell(kind: Column, verb: Column, tense: Column) -> Column:
    """The filter as one key; queries and chunks that agree in it belong together."""
    return F.to_json(F.struct(kind.alias("k"), verb.alias("v"), tense.alias("t")))


def knn_topk(
    queries: DataFrame,
    chunks: DataFrame,
    k: int = 5,
    filtered: bool = True,
    exclude_self: bool = False,
    block: int = BLOCK_ROWS,
    filters_of: DataFrame | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest chunks of each query, exactly.

    Vectors are unit length, so nearest means largest dot product; ties go to the
    smaller id. ``queries`` has (query_id, embedding, verb, tense), NULL meaning no
    filter; ``chunks`` has (vec_id, embedding, verb_lower, tense).

    A query's filter names its cell: a verb and a tense, one of them, or everything. A
    chunk lies in the cells that some query asks for, so a query meets only chunks that
    pass its filter. See ``score_cells`` for the rest. ``filters_of`` has the verb and tense
    of the same queries without their vectors, where these are costly to make for a count.
    """
    none = F.lit(None).cast("string")
    filters = filtered and {"verb", "tense"} <= set(queries.columns)
    verb, tense = (F.col("verb"), F.col("tense")) if filters else (none, none)
    kind = F.when(verb.isNull(), 0).otherwise(2) + F.when(tense.isNull(), 0).otherwise(1)
    cell = _cell(kind, verb, tense).alias("cell")
    q = queries.select("query_id", "embedding", cell)
    v, t = F.col("verb_lower"), F.col("tense")
    cells = [_cell(F.lit(0), none, none)]
    if filters:
        cells += [F.when(v.isNotNull(), _cell(F.lit(2), v, none)), F.when(t.isNotNull(), _cell(F.lit(1), none, t)),
                  F.when(v.isNotNull() & t.isNotNull(), _cell(F.lit(3), v, t))]
    c = chunks.select("vec_id", "embedding", F.explode(F.array_compact(F.array(*cells))).alias("cell"))
    return _best(score_cells(q, c, k, exclude_self, block, None if filters_of is None else filters_of.select(cell)), k)


def _best(scored: DataFrame, k: int) -> DataFrame:
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _first_k(owner: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int):
    """The k best of every owner: by score, then by id."""
    order = np.lexsort((ids, -score, owner))
    owner, ids, score = owner[order], ids[order], score[order]
    starts = np.searchsorted(owner, owner, side="left")
    kept = np.arange(len(owner)) - starts < k
    return owner[kept], ids[kept], score[kept]


def _finite(ids: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows without NaN or infinity; others have no score."""
    kept = np.isfinite(matrix).all(axis=1)
    return (ids, matrix) if kept.all() else (ids[kept], matrix[kept])


def _nearest_rows(ids: np.ndarray, asked: np.ndarray, vec_ids: np.ndarray, held: np.ndarray, k: int, exclude_self: bool):
    """(query id, vector id, score) of the k best of each query, by exact scores.

    Products in single precision, with a bound of their error, only rule out what cannot be
    among the k; what is left is scored in double precision and rounded, so that equal
    vectors tie whatever block they are in.
    """
    (ids, asked), (vec_ids, held) = _finite(ids, asked), _finite(vec_ids, held)
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    if not len(ids) or not len(vec_ids):
        return out[0]
    largest = np.sqrt(np.einsum("ij,ij->i", asked, asked).max() * np.einsum("ij,ij->i", held, held).max())
    rough = np.float32 if 1e-18 < largest < 1e18 else np.float64
    # the sum's error, that of both roundings to single precision, and that of rounded scores
    slack = 2 * (asked.shape[1] + 8) * np.finfo(rough).eps * largest + 2e-9
    turned = np.ascontiguousarray(held.T, rough)
    for top in range(0, len(ids), TILE[0]):
        own, rows = ids[top : top + TILE[0]], asked[top : top + TILE[0]]
        near = rows.astype(rough)
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))  # row, vector id, score
        bar = np.full((len(own), 1), -np.inf, rough)
        start = 0
        while start < len(vec_ids):
            stop = min(start + (TILE[1] if start else max(FIRST, 2 * k)), len(vec_ids))
            there = vec_ids[start:stop]
            scores = near @ turned[:, start:stop]
            if exclude_self:
                scores[own[:, None] == there[None, :]] = -np.inf
            if not start and len(there) > k:
                bar = np.partition(scores, -k, axis=1)[:, -k][:, None] - rough(slack)
            i, j = np.divmod(np.flatnonzero(scores >= bar), len(there))
            exact = np.round(np.einsum("ij,ij->i", rows[i], held[start + j]), 9)
            kept = np.isfinite(exact)
            if exclude_self:
                kept &= own[i] != there[j]
            best = _first_k(
                np.concatenate([best[0], i[kept]]), np.concatenate([best[1], there[j[kept]]]), np.concatenate([best[2], exact[kept]]), k
            )
            # the k-th score so far of each query that has k
            last = np.flatnonzero(best[0][k - 1 :] == best[0][: max(len(best[0]) - k + 1, 0)]) + k - 1
            bar[best[0][last], 0] = best[2][last] - slack
            start = stop
        out.append((own[best[0]], best[1], best[2]))
    return tuple(np.concatenate(x) for x in zip(*out))


def score_cells(
    queries: DataFrame, chunks: DataFrame, k: int, exclude_self: bool = False, block: int = BLOCK_ROWS, cells_of: DataFrame | None = None
) -> DataFrame:
    """(query_id, vec_id, score): for each query (query_id, embedding, cell) the k best
    chunks (vec_id, embedding, cell) of its cell, from each block of the cell.

    Everything stays in the cluster: the queries and the chunks of a cell are cut into
    blocks, and every pair of blocks is one group, scored by matrix products. A frequent cell
    is therefore many groups, no group is larger than two blocks, and k rows per query leave a
    group, never the pairs. ``cells_of`` has the cells of the queries, if that is cheaper to count.
    """

    def score(asked: pa.Table, held: pa.Table) -> pa.Table:
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        if asked.num_rows and held.num_rows:
            sides = [(t.column(key).to_numpy(), _matrix(t.column("embedding").combine_chunks()).astype(np.float64)) for t, key in ((asked, "query_id"), (held, "vec_id"))]
            best = _nearest_rows(*sides[0], *sides[1], k, exclude_self)
        return pa.table([pa.array(x) for x in best], names=["query_id", "vec_id", "score"])

    return _block_pairs(queries, chunks, "embedding", block, WIDER, cells_of).applyInArrow(score, _TOP)


def _block_pairs(queries: DataFrame, chunks: DataFrame, held: str, block: int, wider: int = 1, cells_of: DataFrame | None = None):
    """Groups of a block of queries and a block of chunks (vec_id, ``held``) of one cell.

    Blocks have about ``block`` rows, or as many as the other side of the cell has, up to
    ``wider`` times as many: so a side that fits is sent once for each of its own rows' worth
    of the other, and a larger one ``wider`` times less often.
    """
    count = lambda df, name: df.groupBy("cell").agg(F.count(F.lit(1)).alias(name))
    n = count(queries if cells_of is None else cells_of, "q").join(count(chunks, "c"), "cell")
    wide = lambda other: F.greatest(F.lit(block), F.least(F.col(other), F.lit(block * wider)))
    cells = pin_if_small(n.select("cell", F.ceil(F.col("q") / wide("c")).alias("q_blocks"), F.ceil(F.col("c") / wide("q")).alias("c_blocks")))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    own = lambda key, n: F.pmod(F.xxhash64(key), F.col(n))
    q = queries.join(cells, "cell").select("cell", own("query_id", "q_blocks").alias("qb"), every("c_blocks").alias("cb"), "query_id", "embedding")
    c = chunks.join(cells, "cell").select("cell", own("vec_id", "c_blocks").alias("cb"), every("q_blocks").alias("qb"), "vec_id", held)
    groups = ["cell", "qb", "cb"]
    return q.groupBy(*groups).cogroup(c.groupBy(*groups))


def _centres(chunks: DataFrame, lists: int, sample: int, seed: int) -> np.ndarray:
    """Centres of at most ``lists`` groups, fitted on about ``sample`` vectors by id hash."""
    share = min(1.0, sample / max(chunks.count(), 1))
    picked = chunks.filter(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    rows = picked.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    n = rows.count()
    if n <= lists:
        return np.array([r[0].toArray() for r in rows.collect()])
    fit = KMeans(k=lists, distanceMeasure="cosine", maxIter=10, seed=seed, initMode="random").fit(rows)
    return np.array(fit.clusterCenters())


def _listed(df: DataFrame, key: str, centres: np.ndarray, n: int) -> DataFrame:
    """(key, embedding, cell): a row for each of the ``n`` nearest centres."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            near = np.argsort(-(_matrix(batch.column("embedding")) @ centres.T), axis=1, kind="stable")[:, :n]
            taken = batch.take(pa.array(np.repeat(np.arange(batch.num_rows), near.shape[1])))
            cell = pa.array([str(c) for c in near.ravel()])
            yield pa.RecordBatch.from_arrays([*taken.columns, cell], names=[key, "embedding", "cell"])

    return df.select(F.col(key).cast("bigint"), F.col("embedding").cast("array<float>")).mapInArrow(
        place, f"{key} bigint, embedding array<float>, cell string"
    )


def inverted_lists(
    queries: DataFrame, chunks: DataFrame, lists: int = 64, probes: int = 36, sample: int = 16_384, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Chunks with the list of their nearest centre, queries with a row per list to search.

    Only the centres are fitted on a sample; every vector is put into its list.
    """
    centres = _centres(chunks, lists, sample, seed)
    return _listed(queries, "query_id", centres, probes), _listed(chunks, "vec_id", centres, 1)


def knn_approx(
    queries: DataFrame, chunks: DataFrame, k: int = 5, lists: int = 64, probes: int = 36, exclude_self: bool = False
) -> DataFrame:
    """As knn_topk without filters, over only the vectors in the ``probes`` lists nearest to
    the query. Other vectors are never scored, and none twice; a frequent list is cut into
    blocks like any cell. More probes find more; as many as lists make the search exact."""
    q, c = inverted_lists(queries, chunks, lists, probes)
    return _best(score_cells(q, c, k, exclude_self), k)


def scored_pairs(queries: DataFrame, chunks: DataFrame, lists: int = 64, probes: int = 36) -> DataFrame:
    """(approximate, exact): how many pairs of query and vector either search scores."""
    q, c = inverted_lists(queries, chunks, lists, probes)
    count = lambda df, name: df.groupBy("cell").agg(F.count(F.lit(1)).alias(name))
    near = count(q, "q").join(count(c, "c"), "cell").agg(F.sum(F.col("q") * F.col("c")).alias("approximate"))
    every = queries.agg(F.count(F.lit(1)).alias("q")).join(chunks.agg(F.count(F.lit(1)).alias("c"))).select((F.col("q") * F.col("c")).alias("exact"))
    return near.join(every)


# --- product quantisation ----------------------------------------------------

# values of a code of half a byte, and passes of the codebooks' fit
CODES, FIT_PASSES = 16, 12


def codebooks(chunks: DataFrame, sample: int = 4_096, seed: int = 42) -> np.ndarray:
    """(pairs of dimensions, CODES, 2): the centres that stand for each pair of dimensions,
    fitted on about ``sample`` vectors by id hash. An odd last dimension is paired with zero."""
    share = min(1.0, sample / max(chunks.count(), 1))
    picked = chunks.filter(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    rows = _in_pairs(_matrix(picked.select(F.col("embedding").cast("array<float>")).toArrow().column(0).combine_chunks()))
    rng, books = np.random.default_rng(seed), []
    for part in rows.transpose(1, 0, 2):
        centres = part[rng.choice(len(part), CODES, replace=len(part) < CODES)].astype(np.float64)
        for _ in range(FIT_PASSES):
            near = _nearest(part, centres)
            counts = np.bincount(near, minlength=CODES)[:, None]
            sums = np.stack([np.bincount(near, part[:, i], CODES) for i in range(2)], 1)
            centres = np.where(counts > 0, sums / np.maximum(counts, 1), centres)
        books.append(centres)
    return np.array(books)


def _in_pairs(matrix: np.ndarray) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, matrix.shape[1] % 2))).reshape(len(matrix), -1, 2)


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(1) - 2 * points @ centres.T, axis=1)


def encode_vectors(chunks: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, code): half a byte for each pair of dimensions of every vector."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = _in_pairs(_matrix(batch.column("embedding")))
            codes = np.stack([_nearest(parts[:, m], book) for m, book in enumerate(books)], 1).astype(np.uint8)
            codes = np.pad(codes, ((0, 0), (0, codes.shape[1] % 2)))
            packed = codes[:, ::2] * CODES + codes[:, 1::2]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([row.tobytes() for row in packed], pa.binary())], names=["vec_id", "code"])

    rows = chunks.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<float>"))
    return rows.mapInArrow(encode, "vec_id bigint, code binary")


def knn_quantised(
    queries: DataFrame, chunks: DataFrame, k: int = 5, depth: int = 100, exclude_self: bool = False, block: int = BLOCK_ROWS, books: np.ndarray | None = None
) -> DataFrame:
    """As knn_topk without filters: every vector is scored by its code, through a table of each
    query's products with the codebooks, and only the ``depth`` best of a query are scored by
    their vectors. Codes, a sixteenth of the vectors' size, are all that is exchanged for the
    search; vectors are read once more for the ``depth`` candidates. A greater depth finds more."""
    held = codebooks(chunks) if books is None else books
    whole = F.lit("all").alias("cell")
    q = queries.select("query_id", F.col("embedding").cast("array<float>").alias("embedding"), whole)

    def score(asked: pa.Table, coded: pa.Table) -> pa.Table:
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        if asked.num_rows and coded.num_rows:
            ids, vec_ids = asked.column("query_id").to_numpy(), coded.column("vec_id").to_numpy()
            codes = np.frombuffer(b"".join(coded.column("code").to_pylist()), np.uint8).reshape(len(vec_ids), -1)
            parts = _in_pairs(_matrix(asked.column("embedding").combine_chunks()))
            table = np.einsum("qmd,mcd->qmc", parts, held)
            table = np.pad(table, ((0, 0), (0, table.shape[1] % 2), (0, 0)))
            # one entry for each byte of a code, which holds two codes
            bytes_ = (table[:, ::2, :, None] + table[:, 1::2, None, :]).reshape(len(ids), -1, CODES * CODES).astype(np.float32)
            step = max(BLOCK_SCORES // len(ids), 64)
            for start in range(0, len(vec_ids), step):
                there = vec_ids[start : start + step]
                scores = np.zeros((len(ids), len(there)), np.float32)
                for m in range(codes.shape[1]):
                    scores += bytes_[:, m][:, codes[start : start + step, m]]
                if exclude_self:
                    scores[ids[:, None] == there[None, :]] = -np.inf
                top = min(depth, len(there))
                j = np.argpartition(-scores, top - 1, axis=1)[:, :top]
                i = np.repeat(np.arange(len(ids)), top)
                found = scores[i, j.ravel()]
                real = np.isfinite(found)
                best = _first_k(
                    np.concatenate([best[0], ids[i][real]]), np.concatenate([best[1], there[j.ravel()][real]]), np.concatenate([best[2], found[real].astype(np.float64)]), depth
                )
        return pa.table([pa.array(x) for x in best], names=["query_id", "vec_id", "score"])

    coded = encode_vectors(chunks, held).withColumn("cell", whole)
    rough = _best(_block_pairs(q, coded, "code", block).applyInArrow(score, _TOP), depth).select("query_id", "vec_id")
    vectors = chunks.select("vec_id", F.col("embedding").cast("array<double>").alias("there"))
    near = rough.join(vectors, "vec_id").join(queries.select("query_id", F.col("embedding").cast("array<double>").alias("here")), "query_id")
    product = F.aggregate(F.zip_with("here", "there", lambda a, b: a * b), F.lit(0.0), lambda x, y: x + y)
    return _best(near.select("query_id", "vec_id", F.round(product, 9).alias("score")), k)


# --- answers -----------------------------------------------------------------


def retrieve(
    questions: DataFrame,
    chunks: DataFrame,
    encode: Callable[[DataFrame, str, str, str], DataFrame],
    k: int = 5,
    key: str = "question_id",
) -> tuple[DataFrame, DataFrame]:
    """(questions with their filters, long result).

    The long result has one row per question and rank with the chunk's text and
    metadata. ``encode(df, key, text column, prefix)`` gives (key, embedding), or all columns
    of ``df`` and embedding, which saves a join of the vectors;
    ``chunks`` has (vec_id, text, verb, verb_lower, tense, page).
    """
    # read for its cells, for the search and by the answers
    asked = staged(with_filters(questions, known_entities(chunks), key), "asked")
    q = encode(asked, key, "question", v.QUERY_PREFIX)
    q = q if {"verb", "tense"} <= set(q.columns) else asked.join(q, key)
    q = q.select(named(key).alias("query_id"), "embedding", "verb", "tense")
    encoded = encode(chunks.select("vec_id", "text"), "vec_id", "text", v.PASSAGE_PREFIX).select("vec_id", "embedding")
    c = chunks.select("vec_id", "verb_lower", "tense").join(encoded, "vec_id")
    hits = knn_topk(q, staged(c, "vectors"), k, filters_of=asked)
    shown = chunks.select("vec_id", "text", "verb", "tense", "page")
    found = hits.join(broadcast_if_light(shown, "text", "verb", "tense"), "vec_id")
    return asked, found.withColumnRenamed("query_id", key)


def answer_questions(asked: DataFrame, hits: DataFrame, key: str = "question_id") -> DataFrame:
    """(key, route, answer, sources, context): the verbatim answer of a lookup, or the
    context from which an explanation is to be written."""
    place = F.struct("rank", direct_answer(F.col("text"), F.col("tense")).alias("x"))
    source = F.struct("rank", source_line(F.col("verb"), F.col("tense"), F.col("page")).alias("x"))
    document = F.struct("rank", F.col("text").alias("x"))
    # at most k rows per question
    listed = lambda s: F.transform(F.array_sort(F.collect_list(s)), lambda e: e["x"])
    per = hits.groupBy(named(key)).agg(
        F.count(F.lit(1)).alias("hits"), listed(place).alias("answers"),
        listed(source).alias("lines"), listed(document).alias("documents"),
    )
    lookup = F.col("verb").isNotNull() & ~is_explanatory(F.col("question")) & (F.coalesce("hits", F.lit(0)) > 0)
    return asked.join(per, key, "left").select(
        named(key),
        F.when(lookup, "lookup").otherwise("explain").alias("route"),
        F.when(lookup, F.get("answers", F.lit(0))).alias("answer"),
        F.when(lookup, F.get("lines", F.lit(0))).otherwise(F.concat_ws("; ", "lines")).alias("sources"),
        F.when(~lookup, F.concat_ws(v.CONTEXT_SEPARATOR, "documents")).alias("context"),
    )


def question_route(questions: DataFrame, hits_per_question: DataFrame, key: str = "question_id", text: str = "question") -> DataFrame:
    """(key, route): lookup when a verb is known, something was found and the question
    asks for no explanation; else explain."""
    found = F.coalesce("hits", F.lit(0)) > 0
    lookup = F.col("verb").isNotNull() & ~is_explanatory(named(text)) & found
    return questions.join(hits_per_question, key, "left").select(
        named(key), F.when(lookup, "lookup").otherwise("explain").alias("route")
    )


def direct_answer(text: Column, tense: Column) -> Column:
    """The chunk's form lines verbatim, under the tense in brackets."""
    kept = F.filter(F.split(text, "\n"), lambda x: ~(x.startswith("Verb:") | x.startswith("Tense:")))
    return F.concat(F.lit("("), tense, F.lit(")\n"), F.concat_ws("\n", kept))


def source_line(verb: Column, tense: Column, page: Column) -> Column:
    return F.concat(verb, F.lit(" ("), tense, F.lit("), p."), page.cast("string"))


def by_rank(hits: DataFrame, key: str, value: Column, separator: str, name: str) -> DataFrame:
    """(key, name): the values of the at most k hits of a question, joined in rank order."""
    listed = F.array_sort(F.collect_list(F.struct(F.col("rank"), value.alias("x"))))
    return hits.groupBy(named(key)).agg(F.concat_ws(separator, F.transform(listed, lambda s: s["x"])).alias(name))


def answer_sources(hits: DataFrame, key: str = "question_id") -> DataFrame:
    return by_rank(hits, key, source_line(F.col("verb"), F.col("tense"), F.col("page")), "; ", "sources")


def context(hits: DataFrame, key: str = "question_id") -> DataFrame:
    return by_rank(hits, key, F.col("text"), v.CONTEXT_SEPARATOR, "context")


# --- evaluation --------------------------------------------------------------


def judged(expected: DataFrame, top1: DataFrame, key: str) -> DataFrame:
    """Expected against actual (verb, tense) of the best hit; no hit is a miss."""
    got = top1.select(named(key), F.col("verb_lower").alias("actual_verb"), F.col("tense").alias("actual_tense"))
    right = (F.col("expected_verb") == F.col("actual_verb")) & (F.col("expected_tense") == F.col("actual_tense"))
    return expected.join(got, key, "left").select(
        named(key), "expected_verb", "expected_tense",
        F.coalesce("actual_verb", F.lit("")).alias("actual_verb"),
        F.coalesce("actual_tense", F.lit("")).alias("actual_tense"),
        F.coalesce(right, F.lit(False)).alias("correct"),
    )


def retrieval_accuracy(judgements: DataFrame) -> DataFrame:
    hit = F.col("correct").cast("int")
    return judgements.agg(
        F.count(F.lit(1)).alias("questions"), F.sum(hit).alias("correct"),
        F.round(F.avg(hit.cast("double")) * 100, 6).alias("accuracy"),
    )


def retrieval_failures(judgements: DataFrame) -> DataFrame:
    return judgements.filter(~F.col("correct")).drop("correct")
