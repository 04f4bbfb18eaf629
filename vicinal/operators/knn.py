"""Nearest-neighbour joins: a table of query vectors against a table of vectors."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vicinal.functions.scores import to_score
from vicinal.operators.blocks import METRIC_OF_SPACE, as_bytes, as_matrix, combined, pair_distance
from vicinal.operators.scan import (Scan, block_lists, key_hash, match_scan, merge_top_k, packed_hits, query_block, run_scan, scan_pairs, top_k,
                                    with_counts, with_score)
from vicinal.plans import bloom
from vicinal.plans.limits import LIMITS, Limits, cut, few_partitions, parallelism
from vicinal.spec import SCORE_FORMULA, SpecError, check_k, check_radius

APPROXIMATE = ("ivf", "binary", "adc", "pq", "sq1", "sq7", "fp16", "flat")


def one_table(c) -> DataFrame:
    """A list of tables (shards) read as one; the partial top-k stays inside each partition."""
    if hasattr(c, "model"):  # an index searched exactly
        return c.df
    return reduce(lambda a, b: a.unionByName(b), c) if isinstance(c, (list, tuple)) else c


def conditions(on) -> tuple:
    """``on`` = list of ``(query column, operator, corpus column)``; a pair of names means equality."""
    out = []
    for item in on or ():
        left, op, right = item if len(item) == 3 else (item[0], "==", item[1])
        if op not in ("==", "!=", "<", "<=", ">", ">="):
            raise SpecError(f"unknown comparison {op!r}")
        out.append((left, op, right))
    return tuple(out)


def hit_schema(q: DataFrame, c: DataFrame, query_id: str, id: str, keep) -> T.StructType:
    kind = {f.name: f.dataType for f in c.schema}
    fields = [T.StructField(query_id, q.schema[query_id].dataType), T.StructField(id, c.schema[id].dataType),
              T.StructField("rank", T.IntegerType()), T.StructField("distance", T.DoubleType()),
              T.StructField("score", T.DoubleType())]
    return T.StructType(fields + [T.StructField(n, kind[n]) for n in keep if n in kind])


def exact_scan(q, c, k, space, *, query_id, query_vec, id, vec, on=None, keep=(), counted: bool = False, limits: Limits = LIMITS) -> DataFrame:
    scan = Scan(METRIC_OF_SPACE[space], space, query_id, query_vec, id, vec, tuple(dict.fromkeys([id, *keep])), (id,),
                k=k, conds=conditions(on), counted=counted)
    return run_scan(scan, q, c, limits=limits)


def knn_join(q: DataFrame, c, k: int, space: str = "l2", *, mode: str = "exact", query_id: str = "query_id",
             query_vec: str = "query_vec", id: str = "id", vec: str = "vec", filter: Column | str | None = None,
             on=None, keep=(), boost: float = 1.0, candidates: int | None = None, rescore=None,
             nprobes: int | None = None, explain: bool = False, metrics: bool = False, ignore_unmapped: bool = False,
             threshold: int | None = None, fallback: bool = True, fill: str | None = None, first_pass: int | None = None,
             limits: Limits = LIMITS) -> DataFrame:
    """The ``k`` rows of ``c`` nearest to each row of ``q``:
    ``(query_id, id, rank, distance, score, *keep)``, ties settled by the smaller id.

    ``filter`` is applied below the ranking, so k filtered rows come back if there are that many; filter the
    result instead to rank first. ``on`` restricts which corpus rows a query may meet. For modes other than
    ``exact``, ``c`` is an index made by ``vicinal.sources.index``. ``candidates`` is the depth each
    part is searched to before the merge. ``mode='auto'`` searches the index, and exactly where that comes up short or
    ``threshold`` rows or fewer pass the filter. ``fill='exact'`` does the former for any index mode. ``first_pass`` limits the
    candidates that oversampling asks of the codes (``spec.MAX_FIRST_PASS`` is customary); by default nothing does.
    """
    check_k(k)
    if mode == "auto":
        from vicinal.plans.choice import auto_join

        return auto_join(q, c, k, space, query_id=query_id, query_vec=query_vec, filter=filter, on=on, keep=keep,
                         boost=boost, candidates=candidates, nprobes=nprobes, rescore=rescore, threshold=threshold,
                         fallback=fallback, explain=explain, metrics=metrics, ignore_unmapped=ignore_unmapped, limits=limits)
    if mode != "exact":
        from vicinal.operators.approx import approx_join

        if threshold is not None:
            raise SpecError("threshold belongs to mode 'auto'")

        return approx_join(q, c, k, mode=mode, space=space, query_id=query_id, query_vec=query_vec, filter=filter,
                           on=on, keep=keep, boost=boost, candidates=candidates, rescore=rescore, nprobes=nprobes,
                           explain=explain, metrics=metrics, ignore_unmapped=ignore_unmapped, fill=fill, first_pass=first_pass, limits=limits)
    for name, value in (("rescore", rescore), ("nprobes", nprobes), ("threshold", threshold), ("fill", fill), ("first_pass", first_pass)):
        if value is not None:
            raise SpecError(f"{name} needs an index mode")
    c = one_table(c)
    if space not in METRIC_OF_SPACE:
        raise SpecError(f"unknown space {space!r}")
    if vec not in c.columns:
        if ignore_unmapped:
            return q.sparkSession.createDataFrame([], hit_schema(q, c, query_id, id, keep))
        raise SpecError(f"column {vec!r} is not in the table")
    if filter is not None:
        c = c.where(filter)
    depth = max(k, candidates or k)
    hits = exact_scan(q, c, depth, space, query_id=query_id, query_vec=query_vec, id=id, vec=vec, on=on, keep=keep, counted=metrics,
                      limits=limits)
    if metrics:
        hits = with_counts(hits, query_id, "exact_count").drop("_seen")
    counts = ["exact_count"] if metrics else []
    hits = with_score(merge_top_k(hits, k, query_id, [id]), space, boost)
    hits = hits.select(query_id, id, "rank", "distance", "score", *[n for n in keep if n != id], *counts)
    rows = rows_of(c, vec)
    if explain:
        reason = "no index was given" if filter is None else "the filter is applied before an exact scan"
        hits = hits.withColumn("explain", explanation("Exact", reason, space, rows, None))
    if metrics:
        hits = hits.withColumns({"filtered_rows": rows, "ann_count": F.lit(0).cast("bigint")})
    return hits


def rows_of(c: DataFrame, vec: str) -> Column:
    """The number of rows with a vector, as a scalar subquery: counted when the result is, by a scan of that column alone."""
    return c.where(F.col(vec).isNotNull()).agg(F.count(F.lit(1))).scalar()


def explanation(kind: str, reason: str, space: str, cardinality: Column | int | None, first_pass: int | None,
                oversample: float | None = None) -> Column:
    """How a hit came about, as one struct column."""
    cardinality = cardinality if isinstance(cardinality, Column) else F.lit(cardinality)
    return F.struct(F.lit(kind).alias("search_type"), F.lit(reason).alias("reason"),
                    F.col("distance").alias("raw"), F.lit(SCORE_FORMULA[space]).alias("formula"),
                    cardinality.cast("bigint").alias("cardinality"),
                    F.lit(first_pass).cast("int").alias("first_pass_k"),
                    F.lit(oversample).cast("double").alias("oversample"))


def distance_to(vector, vec: str, space: str) -> Column:
    """Raw distance of a column to one fixed vector, computed batch-wise."""
    metric = METRIC_OF_SPACE[space]
    if space == "hamming":
        fixed = np.frombuffer(bytes(vector), np.uint8)[None, :]
    else:
        fixed = np.asarray(vector, np.float64)[None, :]
        if space == "cosinesimil" and not fixed.any():
            raise SpecError("zero vector is not supported when space is cosinesimil")

    @F.arrow_udf("double")
    def run(column: pa.Array) -> pa.Array:
        some = column.drop_null()
        if not len(some):
            return pa.nulls(len(column), pa.float64())
        rows = as_bytes(some) if metric == "hamming" else as_matrix(some)
        value = pair_distance(metric, np.broadcast_to(fixed, (len(rows), fixed.shape[1])), rows)
        if len(some) == len(column):
            return pa.array(value)
        out = np.full(len(column), np.nan)
        there = column.is_valid().to_numpy(zero_copy_only=False)
        out[there] = value
        return pa.array(out, mask=~there)

    return run(F.col(vec))


def pairwise_distance(a: str, b: str, space: str) -> Column:
    """Raw distance between two vector columns of the same row, computed batch-wise; null where either is null."""
    metric = METRIC_OF_SPACE[space]

    @F.arrow_udf("double")
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        there = x.is_valid().to_numpy(zero_copy_only=False) & y.is_valid().to_numpy(zero_copy_only=False)
        out = np.full(len(x), np.nan)
        if there.any():
            mask = pa.array(there)
            read = as_bytes if metric == "hamming" else as_matrix
            out[there] = pair_distance(metric, read(x.filter(mask)), read(y.filter(mask)))
        return pa.array(out, mask=~there)

    return run(F.col(a), F.col(b))


def knn(c: DataFrame, vector, k: int, space: str = "l2", *, id: str = "id", vec: str = "vec", filter=None,
        keep=(), boost: float = 1.0) -> DataFrame:
    """One query vector: a scored scan and a bounded sort, ``(id, distance, score, *keep)``."""
    check_k(k)
    if filter is not None:
        c = c.where(filter)
    scored = c.where(F.col(vec).isNotNull()).select(id, *keep, distance_to(vector, vec, space).alias("distance"))
    if 4 * parallelism(c.sparkSession) * k > 1_000_000:
        # The final sort takes k rows of every task; thin them out in parallel first.
        scored = top_k(few_partitions(scored).withColumn("_salt", F.spark_partition_id() % 64), k, "_salt", [id]).drop("_salt", "rank")
    hits = scored.orderBy("distance", id).limit(k)
    return with_score(hits, space, boost).select(id, "distance", "score", *keep)


def score_all(c: DataFrame, vector, space: str = "l2", *, vec: str = "vec", filter=None, score: str = "score") -> DataFrame:
    """Score every row that passes ``filter``; a row without a vector scores 0.

    ``space='hammingbit'`` takes long codes (an int query) or base64 codes (a str query).
    """
    from vicinal.functions.vectors import hamming_base64, hamming_long

    if filter is not None:
        c = c.where(filter)
    if space == "hammingbit":
        raw = hamming_long(F.col(vec), F.lit(vector).cast("bigint")) if isinstance(vector, int) else \
            hamming_base64(F.col(vec), F.lit(vector))
        value = to_score(raw, "hamming")
    else:
        raw = distance_to(vector, vec, space)
        kind = c.schema[vec].dataType
        if space == "cosinesimil" and isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.ByteType):
            value = 2.0 - raw  # byte vectors score 1 + cos, not its half
        else:
            value = to_score(raw, space)
    return c.withColumn(score, F.coalesce(value, F.lit(0.0)))


def radius_join(q: DataFrame, c, *, max_distance=None, min_score=None, space: str = "l2", max_results: int | None = None,
                query_id: str = "query_id", query_vec: str = "query_vec", id: str = "id", vec: str = "vec",
                filter=None, on=None, keep=(), boost: float = 1.0, rank: bool = False,
                limits: Limits = LIMITS) -> DataFrame:
    """Every row of ``c`` within a distance of, or scoring at least ``min_score`` against, each query row.

    The limit is a number or the name of a query column. ``max_results`` keeps only the best so many per query
    (``spec.RESULT_WINDOW`` is the usual window); by default the result is whole.
    """
    check_radius(space, max_distance, min_score)
    c = one_table(c)
    if filter is not None:
        c = c.where(filter)
    scan = Scan(METRIC_OF_SPACE[space], space, query_id, query_vec, id, vec, tuple(dict.fromkeys([id, *keep])), (id,),
                k=max_results, conds=conditions(on), max_distance=max_distance, min_score=min_score)
    hits = run_scan(scan, q, c, limits=limits)
    columns = [query_id, id, "distance", "score", *[n for n in keep if n != id]]
    if max_results is not None:
        hits = merge_top_k(hits, max_results, query_id, [id])
        columns.insert(2, "rank")
    return with_score(hits, space, boost).select(*columns)


def combine_knn(parts: list, k: int | None = None, *, how: str = "sum", query_id: str = "query_id", id: str = "id") -> DataFrame:
    """Hits of several searches as one result: the scores of an id are added (or the best is taken)."""
    if how not in ("sum", "max"):
        raise SpecError("how must be 'sum' or 'max'")
    merged = one_table([p.select(query_id, id, "score") for p in parts])
    merged = merged.groupBy(query_id, id).agg((F.sum if how == "sum" else F.max)("score").alias("score"))
    w = Window.partitionBy(query_id).orderBy(F.col("score").desc(), F.col(id))
    ranked = merged.withColumn("rank", F.row_number().over(w))
    if k is not None:
        ranked = ranked.where(F.col("rank") <= k)
    return ranked.select(query_id, id, "rank", "score")


def page(hits: DataFrame, from_: int, size: int, rank: str = "rank") -> DataFrame:
    """Ranks ``from_ + 1`` to ``from_ + size`` of every query."""
    if from_ < 0 or size < 0:
        raise SpecError("from_ and size must not be negative")
    return hits.where((F.col(rank) > from_) & (F.col(rank) <= from_ + size))


def rescore(hits: DataFrame, q: DataFrame, c: DataFrame, k: int, space: str = "l2", *, query_id: str = "query_id",
            query_vec: str = "query_vec", id: str = "id", vec: str = "vec", join_on=(), keep=(), boost: float = 1.0,
            per_query: int | None = None, limits: Limits = LIMITS) -> DataFrame:
    """Re-rank a candidate list by exact distance on the full vectors.

    The vectors are not shuffled where the candidates are few enough to travel: pairs (``limits.state_rows`` at most) go to the scan of
    the vectors, whose tasks compare what they hold and keep k rows per query. ``join_on`` names further columns of both tables, e.g. the
    list number, so that other lists are never read. Beyond that number a Bloom filter of the candidates, tested inside the scan,
    decides which vectors are worth a shuffle.
    """
    check_k(k)
    keys = [id, *join_on]
    keep = tuple(n for n in keep if n not in keys)
    scan = Scan(METRIC_OF_SPACE[space], space, query_id, query_vec, id, vec, (id, *keep), (id,), k=k)
    q = q.where(F.col(query_vec).isNotNull())
    c = c.where(F.col(vec).isNotNull())
    block, _ = query_block(scan, q, limits)
    wanted = hits.select(query_id, *keys).where(F.col(id).isNotNull())
    if block is not None:
        few = block.num_rows * per_query if per_query is not None else None
        if few is None or few > limits.state_rows:
            wanted = cut(wanted.distinct())
            few = wanted.count()
        if few <= limits.state_rows:
            pairs = wanted.select(query_id, key_hash(keys).alias("_h"), *keys).toArrow()
            return _compared(scan, block.combine_chunks(), q, c, pairs, join_on, k, boost, keep)
    else:
        wanted = cut(wanted.distinct())
    candidates = bloom.build(wanted.select(key_hash(keys).alias("h")))
    pairs = c.select(*keys, vec, *keep).where(candidates.column(key_hash(keys))).join(wanted, keys)
    if block is not None:
        found = scan_pairs(scan, block, q, pairs)
    else:
        queries = q.select(query_id, F.col(query_vec).alias("_query_vec"))
        pairs = pairs.join(queries, query_id).withColumn("distance", pairwise_distance("_query_vec", vec, space))
        found = pairs.select(query_id, id, *keep, "distance")
    found = merge_top_k(found, k, query_id, [id])
    return with_score(found, space, boost).select(query_id, id, "rank", "distance", "score", *keep)


def _compared(scan: Scan, block: pa.Table, q: DataFrame, c: DataFrame, pairs: pa.Table, join_on, k: int, boost: float, keep) -> DataFrame:
    """The best k of given pairs (query id, hash and values of the row's keys); a pair given twice counts once."""
    pairs = pairs.group_by(pairs.column_names).aggregate([])
    who = pc.index_in(pairs.column(0), value_set=combined(block.column(scan.query_id)))
    known = pc.is_valid(who)
    pairs, who = pairs.filter(known), combined(who.filter(known)).to_numpy()
    for name in join_on:
        values = pc.unique(pairs.column(name)).to_pylist()
        if len(values) <= 1000:
            c = c.where(F.col(name).isin(values)) if values else c.where(F.lit(False))
    found = match_scan(scan, block, q, c, who, pairs.drop_columns([scan.query_id]).combine_chunks())
    found = merge_top_k(found, k, scan.query_id, [scan.id])
    return with_score(found, scan.space, boost).select(scan.query_id, scan.id, "rank", "distance", "score", *keep)


def second_pass(first: Scan, q: DataFrame, df: DataFrame, k: int, space: str, *, probes, vec: str, join_on, keep, boost: float,
                limits: Limits) -> DataFrame | None:
    """Both passes of a search whose queries fit one block: the candidates of the first come back merged and packed, and the second
    compares them where their vectors lie. None where they do not fit."""
    q = q.where(F.col(first.query_vec).isNotNull())
    coded = df.where(F.col(first.vec).isNotNull())
    block, dim = query_block(first, q, limits)
    if block is None or dim is None:
        return None
    block = block.combine_chunks()
    keys = [first.id, *join_on]
    keep = tuple(n for n in keep if n not in keys)
    # A candidate carries the hash of its keys, by which the second scan finds it.
    marked = replace(first, columns=tuple(dict.fromkeys([*keys, *first.columns, "_h"])))
    scan, coded, lists = block_lists(marked, block, q, coded.withColumn("_h", key_hash(keys)), probes)
    got = packed_hits(scan, block, coded, lists, limits)
    pairs = pa.table({first.query_id: block.column(first.query_id).take(got.column("_q")), **{n: got.column(n) for n in ("_h", *keys)}})
    rows = df.where(F.col(vec).isNotNull())
    exact = Scan(METRIC_OF_SPACE[space], space, first.query_id, first.query_vec, first.id, vec, (first.id, *keep), (first.id,), k=k)
    return _compared(exact, block, q, rows, pairs, join_on, k, boost, keep)
