"""Many vectors per parent row: the best child stands for its parent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vicinal.operators.blocks import METRIC_OF_SPACE
from vicinal.operators.knn import conditions, pairwise_distance
from vicinal.operators.scan import Scan, best_rows, key_hash, run_scan, top_k, with_score
from vicinal.plans import bloom
from vicinal.plans.limits import LIMITS, Limits, cut
from vicinal.spec import SpecError, check_k, check_radius, first_pass_k, resolve_rescore


def explode_children(df: DataFrame, id: str, children: str, *, parent: str = "parent_id", pos: str = "child_pos",
                     keep=()) -> DataFrame:
    """One row per child with the parent's id and the child's position; a parent without children keeps one row."""
    kind = df.schema[children].dataType.elementType
    rows = df.select(F.col(id).alias(parent), *keep, F.posexplode_outer(children).alias(pos, "_child"))
    names = [f.name for f in getattr(kind, "fields", [])]
    if not names:
        return rows.withColumnRenamed("_child", "vec")
    return rows.select(parent, *keep, pos, *[F.col(f"_child.{n}").alias(n) for n in names])


def _filtered(children: DataFrame, parent: str, child_filter, parent_filter: DataFrame | None) -> DataFrame:
    if child_filter is not None:
        children = children.where(child_filter)
    if parent_filter is not None:
        children = children.join(parent_filter.select(parent), parent, "left_semi")
    return children


def siblings(winners: DataFrame, q: DataFrame, children: DataFrame, space: str, *, query_id: str, query_vec: str, parent: str,
             pos: str, vec: str, keep=(), conds=(), limits: Limits = LIMITS) -> DataFrame:
    """Every child of the winning parents that meets ``conds`` with the query, with its own distance: an equi-join on
    the parent. The winners are written first; as many as ``limits.join_rows`` are broadcast, of more a Bloom filter inside the scan
    tells which children are worth a shuffle."""
    wanted = cut(winners.select(query_id, parent, *([] if "rank" not in winners.columns else ["rank"])))
    few = wanted.count() <= limits.join_rows
    tests = [(F.col(left).alias(f"_q{n}"), F.col(right).alias(f"_c{n}")) for n, (left, _, right) in enumerate(conds)]
    rows = children.where(F.col(vec).isNotNull()).select(parent, pos, vec, *keep, *[c for _, c in tests])
    if not few:
        named = bloom.build(wanted.select(key_hash([parent]).alias("h")))
        rows = rows.where(F.col(parent).isNotNull()).where(named.column(key_hash([parent])))
    queries = q.select(query_id, F.col(query_vec).alias("_query_vec"), *[a for a, _ in tests])
    # Of many winners, each takes its query's vector along to the children once; the pairs with all children are not shuffled again.
    pairs = rows.join(F.broadcast(wanted), parent).join(queries, query_id) if few else rows.join(wanted.join(queries, query_id), parent)
    for n, (_, op, _) in enumerate(conds):
        pairs = pairs.where(F.expr(f"_q{n} {op} _c{n}"))
    return pairs.withColumn("distance", pairwise_distance("_query_vec", vec, space)).drop(
        "_query_vec", vec, *[f"_{side}{n}" for n in range(len(conds)) for side in "qc"])


def nested_knn(q: DataFrame, children, k: int, space: str = "l2", *, expand: bool = False, child_filter=None,
               parent_filter: DataFrame | None = None, mode: str = "exact", rescore=None, nprobes: int | None = None, query_id: str = "query_id",
               query_vec: str = "query_vec", parent: str = "parent_id", pos: str = "child_pos", vec: str = "vec",
               keep=(), boost: float = 1.0, on=None, limits: Limits = LIMITS) -> DataFrame:
    """Top-k parents by their best child: ``(query_id, parent, child_pos, rank, distance, score)``.

    ``expand=True`` returns every (filtered) child of those parents with its own score instead.
    ``child_filter`` is a predicate on the child; ``parent_filter`` a table of allowed parents.
    With a code-based ``mode``, ``children`` is an index; the first pass ranks parents by codes and the second
    re-scores all filtered siblings of the candidates on their full vectors. With ``mode='ivf'`` a parent stands for its best child
    in the ``nprobes`` lists that a query visits. A parent's children may lie in any number of partitions, lists and cells: each
    gives its best parents, and the best child over all of them counts.
    """
    check_k(k)
    index, conds = None, conditions(on)
    if mode != "exact":
        index, children = children, children.df
    if parent not in children.columns:
        raise SpecError("expanding or grouping by parent needs a nested column")
    children = _filtered(children, parent, child_filter, parent_filter)
    names = dict(query_id=query_id, query_vec=query_vec, parent=parent, pos=pos, vec=vec)
    if mode == "exact":
        scan = Scan(METRIC_OF_SPACE[space], space, query_id, query_vec, parent, vec, (parent, pos), (parent, pos), k=k,
                    group=parent, conds=conds)
        hits = best_rows(run_scan(scan, q, children, limits=limits), query_id, parent, [pos])
    else:
        from vicinal.operators.approx import index_scan, probing

        probes = probing(index, mode, space, nprobes)
        user = resolve_rescore(index.model.spec, rescore) if rescore is not None else index.model.default_rescore(mode)
        coded = index.model.encoder is not None
        second = coded and rescore is not False and (user is not None or mode != "ivf")
        first = first_pass_k(k, user.oversample if user else 1.0) if second else k
        scan = index_scan(index, mode, space, query_id, query_vec, parent, (parent, pos), (parent, pos), first, probes=probes, group=parent, conds=conds)
        hits = best_rows(run_scan(scan, q, children, probes=probes, limits=limits), query_id, parent, [pos])
        if second:
            hits = top_k(hits, first, query_id, [parent])
            again = siblings(hits.drop("rank"), q, children, space, conds=conds, limits=limits, **names)
            hits = best_rows(again, query_id, parent, [pos])
    best = top_k(hits, k, query_id, [parent])
    shown = "hamming" if mode == "binary" and rescore is False else space
    if not expand:
        return with_score(best, shown, boost).select(query_id, parent, pos, "rank", "distance", "score")
    rows = siblings(best, q, children, space, keep=keep, conds=conds, limits=limits, **names)
    return with_score(rows, space, boost).select(query_id, parent, pos, "rank", "distance", "score", *keep)


def nested_radius(q: DataFrame, children: DataFrame, *, max_distance=None, min_score=None, space: str = "l2",
                  max_results: int | None = None, child_filter=None, parent_filter: DataFrame | None = None,
                  query_id: str = "query_id", query_vec: str = "query_vec", parent: str = "parent_id",
                  pos: str = "child_pos", vec: str = "vec", keep=(), boost: float = 1.0, on=None, limits: Limits = LIMITS) -> DataFrame:
    """Parents with a child inside the radius, each with its best child and that child's columns ``keep``; ``on`` restricts which children
    a query may meet. The radius is a number or the name of a query column."""
    check_radius(space, max_distance, min_score)
    children = _filtered(children, parent, child_filter, parent_filter)
    keep = tuple(n for n in keep if n not in (parent, pos))
    scan = Scan(METRIC_OF_SPACE[space], space, query_id, query_vec, parent, vec, (parent, pos, *keep), (parent, pos),
                k=max_results, group=parent, conds=conditions(on), max_distance=max_distance, min_score=min_score)
    best = run_scan(scan, q, children, limits=limits)
    if max_results is not None:
        best = top_k(best_rows(best, query_id, parent, [pos, *keep]), max_results, query_id, [parent])
    columns = [query_id, parent, pos, *(["rank"] if max_results else []), "distance", "score", *keep]
    return with_score(best, space, boost).select(*columns)
