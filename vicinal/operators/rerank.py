"""Re-ranking of hits: maximal marginal relevance and late interaction."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from vicinal.functions.scores import score_array
from vicinal.operators.blocks import METRIC_OF_SPACE, as_bytes, as_matrix, combined, pair_distance, to_words
from vicinal.operators.scan import Scan, key_hash, merge_top_k, run_scan
from vicinal.operators.tokens import rows_and_cuts, token_scores
from vicinal.plans import bloom
from vicinal.plans.limits import LIMITS, Limits, cut
from vicinal.spec import SpecError, check_k

EXPLAIN = T.StructType([
    T.StructField("original_score", T.DoubleType()),
    T.StructField("max_similarity_to_selected", T.DoubleType()),
    T.StructField("mmr_score", T.DoubleType()),
    T.StructField("mmr_formula", T.StringType()),
])


# Fixed value: the text form of a step's arithmetic.
FORMULA = "(1 - {0:.4f}) * {1:.4f} - {0:.4f} * {2:.4f} = {3:.4f}"


def resolve_vector_path(tables: list, path: str, spaces: list | None = None) -> T.DataType:
    """Check that a dotted path leads to vectors of one type (and one space) in every table."""
    kinds = []
    for table in tables:
        kind: T.DataType = table.schema
        for step in path.split("."):
            fields = {f.name: f.dataType for f in kind.fields} if isinstance(kind, T.StructType) else {}
            if step not in fields:
                raise SpecError(f"no vector column at path {path!r}")
            kind = fields[step]
        if not isinstance(kind, (T.ArrayType, T.BinaryType)):
            raise SpecError(f"the column at {path!r} does not hold vectors")
        kinds.append(kind.elementType if isinstance(kind, T.ArrayType) else kind)
    if len({k.simpleString() for k in kinds}) > 1:
        raise SpecError("the vector type must be the same in every table")
    if spaces and len(set(spaces)) > 1:
        raise SpecError("the space must be the same in every table")
    return kinds[0]


SMALL = 4_000_000      # products held at once where similarities are computed one by one


def _similarities(vectors: np.ndarray, space: str) -> np.ndarray:
    """The score of every two vectors of a group."""
    n, metric = len(vectors), METRIC_OF_SPACE[space]
    if n * n * vectors.shape[1] <= SMALL or metric not in ("l2", "ip", "cos"):
        step = max(1, SMALL // (n * vectors.shape[1]))
        rows = []
        for at in range(0, n, step):
            part = vectors[at:at + step]
            left, right = np.repeat(part, n, axis=0), np.tile(vectors, (len(part), 1))
            rows.append(score_array(pair_distance(metric, left, right), space).reshape(len(part), n))
        return np.concatenate(rows)
    x = vectors.astype(np.float64)
    if metric == "l2":
        x = x - x.mean(axis=0)
    gram = x @ x.T
    size = np.diag(gram)
    if metric == "l2":
        raw = np.maximum(size[:, None] + size[None] - 2 * gram, 0.0)
    elif metric == "ip":
        raw = -gram
    else:
        norms = np.sqrt(size[:, None] * size[None])
        raw = 1.0 - np.where(norms > 0, gram / np.where(norms > 0, norms, 1.0), 0.0)
    return score_array(raw.ravel(), space).reshape(n, n)


def _select(vectors: np.ndarray, scores: np.ndarray, size: int, diversity: float, space: str):
    """Greedy selection; candidates come best first, and the first maximum wins."""
    n = len(scores)
    alike = _similarities(vectors, space)
    nearest = np.zeros(n)
    open_ = np.ones(n, bool)
    picked, trail = [], []
    for _ in range(min(size, n)):
        value = np.where(open_, (1 - diversity) * scores - diversity * nearest, -np.inf)
        best = int(np.argmax(value))
        picked.append(best)
        trail.append((nearest[best], value[best]))
        open_[best] = False
        nearest = np.maximum(nearest, alike[best])
    return picked, trail


def mmr(hits: DataFrame, size: int = 10, diversity: float = 0.5, candidates: int | None = None, *, space: str = "l2",
        vector_path: str = "vec", query_id: str = "query_id", id: str = "id", score: str = "score", rank: str = "rank",
        keep_vector: bool = False, explain: bool = False, source: DataFrame | None = None, join_on=()) -> DataFrame:
    """Pick ``size`` hits per query that are relevant and unlike each other.

    Every step takes the largest ``(1 - diversity) * score - diversity * (highest similarity to a picked hit)``.
    Only the best ``candidates`` hits of a query (3 x size unless given) enter its group, so groups are small.
    The result has the columns of ``hits`` with ``mmr_rank`` added and, unless asked for, the vector dropped.

    With ``source``, the table that was searched, ``hits`` needs no vectors: a search carries ids only, and the vectors of the candidates
    alone are fetched by ``id`` (and ``join_on``, e.g. the list number), past a Bloom filter inside the scan.
    """
    if not 0.0 <= diversity <= 1.0:
        raise SpecError("diversity must lie in 0..1")
    if size <= 0:
        raise SpecError("size must be positive")
    candidates = 3 * size if candidates is None else candidates
    if candidates < size:
        raise SpecError("candidates must not be smaller than size")
    kind = resolve_vector_path([hits if source is None else source], vector_path)
    if rank not in hits.columns:
        w = Window.partitionBy(query_id).orderBy(F.col(score).desc(), F.col(id))
        hits = hits.withColumn(rank, F.row_number().over(w))
    if source is not None:
        hits = _with_vectors(hits.where(F.col(rank) <= candidates), source, [id, *join_on], vector_path.split(".")[0])
    pool = hits.where(F.col(rank) <= candidates).withColumn("_vec", F.col(vector_path))
    plain = [f for f in hits.schema.fields]
    schema = T.StructType([*plain, T.StructField("mmr_rank", T.IntegerType()),
                           *([T.StructField("explain", EXPLAIN)] if explain else [])])
    arrow = to_arrow_schema(schema)
    names = [f.name for f in plain]
    packed = isinstance(kind, T.BinaryType)

    def task(group: pa.Table) -> pa.Table:
        group = group.sort_by([(rank, "ascending")]).combine_chunks()
        vectors = as_bytes(group.column("_vec")) if packed else as_matrix(group.column("_vec"))
        if packed:
            vectors = to_words(vectors)
        scores = group.column(score).to_numpy().astype(np.float64)
        picked, trail = _select(vectors, scores, size, diversity, space)
        out = group.select(names).take(pa.array(picked))
        columns = [combined(out.column(n)) for n in names] + [pa.array(range(1, len(picked) + 1), pa.int32())]
        if explain:
            rows = [{"original_score": scores[p], "max_similarity_to_selected": sim, "mmr_score": value,
                     "mmr_formula": FORMULA.format(diversity, scores[p], sim, value)}
                    for p, (sim, value) in zip(picked, trail)]
            columns.append(pa.array(rows, arrow.field("explain").type))
        return pa.table([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    out = pool.groupBy(query_id).applyInArrow(task, schema)
    return out if keep_vector else without_path(out, vector_path)


def _with_vectors(hits: DataFrame, source: DataFrame, keys: list, column: str) -> DataFrame:
    """``hits`` with a column of the rows they name."""
    hits = cut(hits.drop(column))
    wanted = bloom.build(hits.select(key_hash(keys).alias("h")))
    rows = source.select(*keys, column).where(F.col(keys[0]).isNotNull()).where(wanted.column(key_hash(keys)))
    return hits.join(rows, keys).select(*hits.columns, column)


def without_path(df: DataFrame, path: str) -> DataFrame:
    """The table without a column or a field inside structs; a struct of which nothing is left goes as well."""
    steps = path.split(".")
    if steps[0] not in df.columns:
        return df
    while len(steps) > 1 and len(df.select(".".join(steps[:-1])).schema[0].dataType.fields) == 1:
        steps.pop()
    root, *inner = steps
    return df.withColumn(root, F.col(root).dropFields(".".join(inner))) if inner else df.drop(root)


LATE_SPACES = ("l2", "innerproduct", "cosinesimil")


def _check_late(space: str) -> str:
    if space not in LATE_SPACES:
        raise SpecError(f"space {space!r} does not support late interaction")
    return METRIC_OF_SPACE[space]


def late_interaction(query_vectors, vecs, space: str = "l2") -> Column:
    """Sum over the query's vectors of the best score among the row's vectors.

    ``query_vectors`` is a list of vectors, or a column holding one such list per row.
    """
    metric = _check_late(space)
    if isinstance(query_vectors, (list, np.ndarray)):
        fixed = [np.asarray(v, np.float64) for v in query_vectors]
        if not fixed or any(v.size == 0 for v in fixed):
            raise SpecError("query vectors must not be empty")
        fixed = np.stack(fixed)

        @F.arrow_udf("double")
        def against_fixed(column: pa.Array) -> pa.Array:
            return pa.array(_against_one(fixed, column, metric, space))

        return against_fixed(F.col(vecs) if isinstance(vecs, str) else vecs)

    @F.arrow_udf("double")
    def pairwise(left: pa.Array, right: pa.Array) -> pa.Array:
        return pa.array(_row_by_row(left, right, metric, space))

    return pairwise(*(F.col(c) if isinstance(c, str) else c for c in (query_vectors, vecs)))


def register_late_interaction(spark) -> None:
    """``late_interaction_<space>(query vectors, vectors)`` in SQL text."""
    def named(space: str):
        @F.arrow_udf("double")
        def score(left: pa.Array, right: pa.Array) -> pa.Array:
            return pa.array(_row_by_row(left, right, METRIC_OF_SPACE[space], space))

        return score

    for space in LATE_SPACES:
        spark.udf.register(f"late_interaction_{space}", named(space))


TOKENS = 20_000       # document tokens of a block
PAIRS = 400_000       # token pairs of a block, where every row has query tokens of its own


def _documents(column):
    """(token matrix, first token of each row, number of tokens of each row); null and empty vectors are no tokens."""
    lengths = np.nan_to_num(np.asarray(combined(column).value_lengths().to_numpy(zero_copy_only=False), dtype=float))
    if (lengths == 0).any():
        raise ValueError("document vectors must not be null or empty")
    rows, owner = rows_and_cuts(column)
    n = np.bincount(owner, minlength=len(column)) if len(owner) else np.zeros(len(column), np.int64)
    return rows, np.cumsum(n) - n, n


def _pieces(weight: np.ndarray, most: int):
    """Runs of rows whose weights add up to about ``most``."""
    ends, at = np.cumsum(weight), 0
    while at < len(weight):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield at, stop
        at = stop


def _against_one(fixed: np.ndarray, column, metric: str, space: str) -> np.ndarray:
    """Scores of documents against one list of query vectors: a block of tokens by a matrix product, its best per document by a segmented
    maximum. A document all of whose vectors are null or empty scores 0."""
    rows, first, n = _documents(column)
    out = np.zeros(len(n))
    for at, stop in _pieces(n, TOKENS):
        there = np.flatnonzero(n[at:stop]) + at
        if len(there):
            begin, end = first[there[0]], first[there[-1]] + n[there[-1]]
            scores = token_scores(fixed, rows[begin:end], metric, space)
            out[there] = np.maximum.reduceat(scores, first[there] - begin, axis=1).sum(axis=0)
    return out


def _row_by_row(left, right, metric: str, space: str) -> np.ndarray:
    """Scores of documents each against query vectors of its own row: all token pairs of a block of rows at once, reduced by query token and
    then by row."""
    asked, owner = rows_and_cuts(left)
    m = np.bincount(owner, minlength=len(left)) if len(owner) else np.zeros(len(left), np.int64)
    if (m == 0).any():
        raise ValueError("query vectors must not be empty")
    rows, first, n = _documents(right)
    begin, out = np.cumsum(m) - m, np.zeros(len(n))
    for at, stop in _pieces(m * n, PAIRS):
        there = np.flatnonzero(n[at:stop]) + at
        if not len(there):
            continue
        doc = np.repeat(there, m[there])                                    # of every query token
        token = np.arange(len(doc)) - np.repeat(np.cumsum(m[there]) - m[there], m[there]) + begin[doc]
        size = n[doc]
        starts = np.cumsum(size) - size
        theirs = np.arange(size.sum()) - np.repeat(starts, size) + np.repeat(first[doc], size)
        a, b = asked[np.repeat(token, size)].astype(np.float64), rows[theirs].astype(np.float64)
        best = np.maximum.reduceat(score_array(pair_distance(metric, a, b), space), starts)
        out[there] = np.add.reduceat(best, np.cumsum(m[there]) - m[there])
    return out


def late_interaction_join(q: DataFrame, d: DataFrame, k: int, space: str = "l2", *, query_id: str = "query_id",
                          query_vecs: str = "query_vecs", id: str = "id", vecs: str = "vecs", keep=(),
                          limits: Limits = LIMITS) -> DataFrame:
    """Top-k rows of ``d`` by late interaction for every query row: ``(query_id, id, rank, score)``."""
    check_k(k)
    _check_late(space)
    scan = Scan("maxsim", space, query_id, query_vecs, id, vecs, tuple(dict.fromkeys([id, *keep])), (id,), k=k)
    usable = d.where(F.exists(vecs, lambda v: F.coalesce(F.size(v), F.lit(0)) > 0))
    hits = merge_top_k(run_scan(scan, q, usable, limits=limits), k, query_id, [id])
    return hits.withColumn("score", -F.col("distance")).select(query_id, id, "rank", "score", *[n for n in keep if n != id])
