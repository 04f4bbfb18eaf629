"""Approximate search over an index: coarse lists, compact codes, and an exact second pass."""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vicinal.functions.scores import score_to_threshold, to_score
from vicinal.operators.blocks import METRIC_OF_SPACE, as_bytes, list_array
from vicinal.operators.encoders import ADC_METRIC, centroid_rows, coarse_metric, nearest_centroid, nearest_centroids
from vicinal.operators.knn import conditions, explanation, hit_schema, knn_join, pairwise_distance, rescore, rows_of, second_pass
from vicinal.operators.scan import Scan, merge_top_k, query_block, run_scan, with_counts, with_score
from vicinal.plans.limits import LIMITS, Limits, cut
from vicinal.spec import IVF_LIMIT, SpecError, check_k, check_radius, first_pass_k, resolve_rescore


@dataclass
class Index:
    """Searchable table: ``id``, ``vec``, attributes, and per its model ``code`` and ``list_id``."""

    df: DataFrame
    model: "object"

    def where(self, condition) -> "Index":
        return Index(self.df.where(condition), self.model)


@dataclass
class Probes:
    """Which lists a query visits: the ``nprobes`` with the nearest centroids."""

    centroids: np.ndarray
    nprobes: int
    metric: str
    column: str = "_probe"
    list_column: str = "list_id"

    def block(self, column):
        """(query row, list) of every visit."""
        lists = nearest_centroids(centroid_rows(column, self.metric), self.centroids, self.nprobes, self.metric)
        return np.repeat(np.arange(len(lists)), lists.shape[1]), lists.reshape(-1)

    def prune(self, c: DataFrame, lists: list) -> DataFrame:
        """Read the visited lists only; the list number is the table's partition column."""
        if len(lists) == len(self.centroids):
            return c
        return c.where(F.col(self.list_column).isin(lists))

    def explode(self, q: DataFrame, vec: str) -> DataFrame:
        find = self.block

        @F.arrow_udf("array<int>")
        def visit(values: pa.Array) -> pa.Array:
            n = len(values)
            return list_array(find(values)[1].reshape(n, -1).astype(np.int32), pa.int32())

        return q.withColumn(self.column, F.explode(visit(F.col(vec))))


def assign_lists(c: DataFrame, centroids: np.ndarray, space: str = "l2", *, vec: str = "vec", column: str = "list_id") -> DataFrame:
    """Add the number of each row's nearest centroid; a row without a vector gets none. In the Hamming space vectors and centroids are
    packed bits."""
    metric = coarse_metric(space)
    held = c.sparkSession.sparkContext.broadcast(centroids)

    @F.arrow_udf("int")
    def near(values: pa.Array) -> pa.Array:
        there = values.is_valid().to_numpy(zero_copy_only=False)
        out = np.zeros(len(values), np.int32)
        if there.any():
            out[there] = nearest_centroid(centroid_rows(values.drop_null(), metric), held.value, metric)
        return pa.array(out, mask=~there)

    return c.withColumn(column, near(F.col(vec)))


def code_scan(index: Index, mode: str, space: str, query_id: str, query_vec: str, id: str, columns, order, k, *, group=None,
              conds=(), max_distance=None, bound: bool = False) -> Scan:
    """Scan over the code column of an index; raw vectors are not read. ``bound`` compares by a lower bound of the
    distance instead of its estimate."""
    encoder = index.model.encoder
    if encoder is None:
        raise SpecError("the index holds no codes")
    wanted = {"adc": "binary", "flat": "sq1"}.get(mode, mode)
    if mode != "ivf" and encoder.name != wanted:
        raise SpecError(f"mode {mode!r} does not match the index's {encoder.name!r} codes")
    if mode == "adc":
        if space not in ADC_METRIC:
            raise SpecError(f"space {space!r} is not supported with asymmetric distance")
        metric, prepare = ADC_METRIC[space], encoder.adc_query
    else:
        metric, prepare = encoder.metric(space), encoder.bound_query if bound else encoder.query
    rebuild = encoder.bound_rows if bound else encoder.decode_rows

    def decode(column):
        codes = as_bytes(column)
        return codes if metric == "hamming" else rebuild(codes, space)

    return Scan(metric, space, query_id, query_vec, id, index.model.code_column, tuple(columns), tuple(order), k=k,
                group=group, conds=conds, decode=decode, encode_query=lambda rows: prepare(rows, space),
                max_distance=max_distance)


def probing(index: Index, mode: str, space: str, nprobes: int | None) -> Probes | None:
    """Which lists a search in this mode visits; none for a mode that scans all codes."""
    model = index.model
    if mode != "ivf":
        return None
    if model.centroids is None:
        raise SpecError("the index holds no coarse lists")
    if (space == "hamming") != (model.space == "hamming"):
        raise SpecError(f"lists of the {model.space!r} space cannot be searched in {space!r}")
    nprobes = nprobes or model.spec.params.get("nprobes", 1)
    if not 0 < nprobes < IVF_LIMIT:
        raise SpecError(f"nprobes must lie in 1..{IVF_LIMIT - 1}")
    return Probes(model.centroids, nprobes, coarse_metric(space), list_column=model.list_column)


def index_scan(index: Index, mode: str, space: str, query_id: str, query_vec: str, id: str, columns, order, k, *, probes: Probes | None,
               group=None, conds=()) -> Scan:
    """Scan over an index: its codes, or its vectors where it has none; restricted to the visited lists where there are ``probes``."""
    if index.model.encoder is not None:
        scan = code_scan(index, mode, space, query_id, query_vec, id, columns, order, k, group=group, conds=conds)
    else:
        scan = Scan(METRIC_OF_SPACE[space], space, query_id, query_vec, id, index.model.vec, tuple(columns), tuple(order), k=k, group=group, conds=conds)
    return scan if probes is None else replace(scan, list_column=probes.list_column)


def approx_join(q: DataFrame, index: Index, k: int, *, mode: str, space: str = "l2", query_id: str = "query_id",
                query_vec: str = "query_vec", filter: Column | str | None = None, on=None, keep=(), boost: float = 1.0,
                candidates: int | None = None, rescore=None, nprobes: int | None = None, explain: bool = False,
                metrics: bool = False, ignore_unmapped: bool = False, fill: str | None = None, first_pass: int | None = None,
                limits: Limits = LIMITS) -> DataFrame:
    check_k(k)
    model = index.model
    if model.vec not in index.df.columns:
        if ignore_unmapped:
            return q.sparkSession.createDataFrame([], hit_schema(q, index.df, query_id, model.id, keep))
        raise SpecError(f"column {model.vec!r} is not in the table")
    if fill is not None:
        return _filled_join(q, index, k, fill, mode=mode, space=space, query_id=query_id, query_vec=query_vec, filter=filter, on=on, keep=keep,
                            boost=boost, candidates=candidates, rescore=rescore, nprobes=nprobes, explain=explain, metrics=metrics, first_pass=first_pass, limits=limits)
    df = index.df if filter is None else index.df.where(filter)
    id, vec = model.id, model.vec
    by_codes = model.encoder is not None
    user = resolve_rescore(model.spec, rescore) if rescore is not None else model.default_rescore(mode)
    first = k if user is None else first_pass_k(k, user.oversample, most=first_pass)
    if not by_codes:
        user, first = None, k
    first = max(first, candidates or 0)
    probes = probing(index, mode, space, nprobes)
    extra = [model.list_column] if probes else []
    columns = tuple(dict.fromkeys([id, *extra, *([] if user else keep)]))
    scan = index_scan(Index(df, model), mode, space, query_id, query_vec, id, columns, (id,), first, probes=probes, conds=conditions(on))
    scan = replace(scan, counted=metrics)

    def candidates_of(most: int) -> DataFrame:
        found = run_scan(scan, q, df, probes=probes, limits=limits)
        found = with_counts(found, query_id, "ann_count").drop("_seen") if metrics else found
        return merge_top_k(found, most, query_id, [id])

    counts = []
    if user is None:
        hits = candidates_of(k)
        counts = ["ann_count"] if metrics else []
        shown = "hamming" if by_codes and scan.metric == "hamming" else space
        if shown == "l2":
            hits = hits.withColumn("distance", F.greatest("distance", F.lit(0.0)))
        hits = with_score(hits, shown, boost).select(query_id, id, "rank", "distance", "score", *[n for n in keep if n != id], *counts)
    else:
        hits = None if metrics else second_pass(scan, q, df, k, space, probes=probes, vec=vec, join_on=extra, keep=keep, boost=boost, limits=limits)
        if hits is None and _plain(df, keep) and query_block(scan, q.where(F.col(query_vec).isNotNull()), limits)[0] is None:
            hits = _both_passes(scan, q, df, k, space, first, probes=probes, vec=vec, extra=extra, keep=keep, boost=boost, metrics=metrics, limits=limits)
        elif hits is None:
            found = candidates_of(first).drop("rank", "distance")
            found = cut(found) if metrics else found
            hits = _rescore(found.drop("ann_count"), q, df, k, space, query_id=query_id, query_vec=query_vec, id=id, vec=vec, join_on=extra,
                            keep=keep, boost=boost, per_query=first, limits=limits)
            if metrics:
                hits = hits.join(found.groupBy(query_id).agg(F.max("ann_count").alias("ann_count"), F.count(F.lit(1)).alias("exact_count")), query_id)
        hits = hits.drop(*extra) if not set(extra) & set(keep) else hits
    rows = rows_of(df, vec)
    if metrics:
        # Rows that passed the filter, rows that the lists or codes compared with this query, and how many of them were compared exactly.
        hits = hits.withColumns({"filtered_rows": rows, **({"exact_count": F.lit(0).cast("bigint")} if user is None else {})})
    if explain:
        kind = "Approximate-NN" if user is None else "Disk-based"
        reason = f"{mode} search" + (f" with {probes.nprobes} lists per query" if probes else "")
        hits = hits.withColumn("explain", explanation(kind, reason, space, rows, first if user else None,
                                                      user.oversample if user else None))
    return hits


_rescore = rescore


def _plain(df: DataFrame, names) -> bool:
    """Whether columns hold numbers, dates or the like, which a candidate can carry along."""
    return all(isinstance(df.schema[n].dataType, (T.NumericType, T.BooleanType, T.DatetimeType)) for n in names)


def _both_passes(scan: Scan, q: DataFrame, df: DataFrame, k: int, space: str, first: int, *, probes, vec: str, extra, keep, boost: float, metrics: bool,
                 limits: Limits) -> DataFrame:
    """Both passes of a search with more queries than a block. A task compares codes, and its candidates on the vectors beside them, so
    candidates travel with both distances and no vector is joined: the best ``first`` by code, of these the best ``k`` by distance."""
    query_id, id = scan.query_id, scan.id
    keep = [n for n in keep if n not in (id, *extra)]
    both = replace(scan, space=space, columns=tuple(dict.fromkeys([*scan.columns, *keep])), full=vec)
    found = run_scan(both, q, df.where(F.col(vec).isNotNull()), probes=probes, limits=limits)
    found = with_counts(found, query_id, "ann_count").drop("_seen") if metrics else found
    found = merge_top_k(found, first, query_id, [id]).drop("rank")
    if metrics:
        found = found.withColumn("exact_count", F.count(F.lit(1)).over(Window.partitionBy(query_id)))
    hits = merge_top_k(found.where(F.col(id).isNotNull()).withColumn("distance", F.col("_exact")), k, query_id, [id])
    return with_score(hits, space, boost).select(query_id, id, "rank", "distance", "score", *extra, *keep, *(["ann_count", "exact_count"] if metrics else []))


def _filled_join(q, index: Index, k: int, fill: str, *, filter, query_id, query_vec, on, space, keep, boost, explain, metrics, limits, **how) -> DataFrame:
    """An index search whose queries with fewer than k hits are answered again exactly, if k rows pass the filter."""
    from vicinal.plans.choice import filled

    if fill != "exact":
        raise SpecError("fill must be 'exact'")
    model = index.model
    names = dict(query_id=query_id, query_vec=query_vec, on=on, keep=keep, boost=boost, explain=explain, metrics=metrics, limits=limits)
    found = cut(approx_join(q, index, k, space=space, filter=filter, **names, **how))
    df = index.df if filter is None else index.df.where(filter)
    want = min(k, df.where(F.col(model.vec).isNotNull()).count())
    kept, again = filled(found, q, want, query_id, lambda short: knn_join(short, df, k, space, id=model.id, vec=model.vec, **names))
    return kept if again is None else kept.unionByName(again)


def radius_approx(q: DataFrame, index: Index, *, max_distance=None, min_score=None, space: str = "l2",
                  max_results: int | None = None, query_id: str = "query_id", query_vec: str = "query_vec", filter=None, on=None, keep=(),
                  boost: float = 1.0, limits: Limits = LIMITS) -> DataFrame:
    """Radius search on 1-bit scalar codes: candidates by a lower bound of their distance, then an exact check.

    The bound follows from the codes alone and never exceeds the distance, so no match is lost and the result equals
    ``radius_join`` while only the candidates' vectors are compared. The limit is a number or the name of a query column, ``on`` and
    ``keep`` are those of ``radius_join``. ``max_results`` cuts the checked matches.
    """
    model = index.model
    check_radius(space, max_distance, min_score, encoder=model.encoder.name if model.encoder else None,
                 method=model.spec.method, compression=model.spec.compression)
    df = index.df if filter is None else index.df.where(filter)
    given = max_distance if max_distance is not None else min_score
    own = F.col(given).cast("double") if isinstance(given, str) else F.lit(float(given))
    raw = own if max_distance is not None else score_to_threshold(own, space)
    q = q.withColumn("_asked", own).withColumn("_raw", raw).withColumn("_reach", F.col("_raw") + 1e-9 * (1 + F.abs("_raw")))
    mode = "flat" if model.spec.method == "flat" else "sq1"
    keep = tuple(n for n in keep if n != model.id)
    scan = code_scan(Index(df, model), mode, space, query_id, query_vec, model.id, (model.id,), (model.id,), None,
                     conds=conditions(on), max_distance="_reach", bound=True)
    if _single(q, query_id) and _single(df, model.id):
        # Each task checks its candidates on the vectors beside their codes, so neither candidates nor vectors are shuffled.
        there = df.where(F.col(model.vec).isNotNull() & F.col(model.id).isNotNull())
        scan = replace(scan, columns=(model.id, *keep), full=model.vec, exact_limit=("_asked", max_distance is not None))
        kept = run_scan(scan, q.where(F.col(query_id).isNotNull()), there, limits=limits).withColumn("distance", F.col("_exact"))
    else:
        kept = _checked(scan, q, df, query_id, query_vec, model, space, keep, max_distance is not None, limits)
    kept = kept.select(query_id, model.id, "distance", *keep)
    columns = [query_id, model.id, "distance", "score", *keep]
    if max_results is not None:
        kept = merge_top_k(kept, max_results, query_id, [model.id])
        columns.insert(2, "rank")
    return with_score(kept, space, boost).select(*columns)


def _single(df: DataFrame, key: str) -> bool:
    """Whether no key stands for two rows."""
    return not df.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").limit(1).count()


def _checked(scan: Scan, q: DataFrame, df: DataFrame, query_id: str, query_vec: str, model, space: str, keep, by_distance: bool, limits: Limits) -> DataFrame:
    """Candidates of a radius search joined with every row of their ids, where ids repeat, and checked."""
    found = run_scan(scan, q, df, limits=limits).select(query_id, model.id)
    pairs = found.join(df.select(model.id, model.vec, *keep), model.id)
    queries = q.select(query_id, F.col(query_vec).alias("_query_vec"), "_asked")
    pairs = pairs.join(queries, query_id).withColumn("distance", pairwise_distance("_query_vec", model.vec, space))
    return pairs.where(F.col("distance") <= F.col("_asked")) if by_distance else pairs.where(to_score("distance", space) >= F.col("_asked"))
