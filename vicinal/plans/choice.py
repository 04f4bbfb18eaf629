"""Exact or index search of one request, and exact answers where an index search came up short."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vicinal.operators.knn import explanation, knn_join
from vicinal.plans.limits import LIMITS, Limits, cut
from vicinal.spec import SpecError


def choose(rows: int, k: int, *, filtered: bool, threshold: int | None, built: bool) -> tuple[str, str]:
    """``(exact | approximate | empty, reason)`` for a table with ``rows`` rows after the filter. Which search answers depends
    on the table's size only where the caller sets a ``threshold``; without one an index is searched wherever it can answer in full."""
    if not built:
        return "exact", "the table has neither lists nor codes"
    if filtered and not rows:
        return "empty", "the filter leaves nothing"
    if filtered and rows <= k:
        return "exact", f"the filter leaves {rows} rows, all of which are hits of k = {k}"
    if threshold is not None and threshold >= 0 and rows <= threshold:
        return "exact", f"{rows} rows are within the threshold of {threshold} set for exact search"
    return "approximate", "the index is searched"


def filled(found: DataFrame, q: DataFrame, want: int, query_id: str, exact) -> tuple[DataFrame, DataFrame | None]:
    """``found`` (materialized) of the queries with ``want`` hits, and the exact answers of the others if there are any."""
    full = found.groupBy(query_id).count().where(F.col("count") >= want).select(query_id)
    short = cut(q.join(full, query_id, "left_anti"))
    if not short.limit(1).count():
        return found, None
    return found.join(full, query_id, "left_semi"), exact(short)


def auto_join(q: DataFrame, index, k: int, space: str, *, query_id: str, query_vec: str, filter=None, on=None, keep=(), boost=1.0,
              candidates=None, nprobes=None, rescore=None, threshold=None, fallback: bool = True, explain: bool = False,
              metrics: bool = False, ignore_unmapped: bool = False, limits: Limits = LIMITS) -> DataFrame:
    """``knn_join`` over an index with the rules above. Queries for which the index found fewer than k although k rows
    pass the filter are answered again exactly, unless ``fallback`` is off."""
    if not hasattr(index, "model"):
        raise SpecError("mode 'auto' needs an index")
    model = index.model
    df = index.df if filter is None else index.df.where(filter)
    rows = df.where(F.col(model.vec).isNotNull()).count()
    built = model.encoder is not None or model.centroids is not None
    path, reason = choose(rows, k, filtered=filter is not None, threshold=threshold, built=built)
    names = dict(query_id=query_id, query_vec=query_vec, on=on, keep=keep, boost=boost, candidates=candidates, metrics=metrics,
                 ignore_unmapped=ignore_unmapped, limits=limits)

    def exact(queries: DataFrame) -> DataFrame:
        return knn_join(queries, df, k, space, id=model.id, vec=model.vec, **names)

    def finish(hits: DataFrame, kind: str, why: str) -> DataFrame:
        return hits.withColumn("explain", explanation(kind, why, space, rows, None)) if explain else hits

    if path != "approximate":
        return finish(exact(q), "Exact", reason)
    mode = "ivf" if model.centroids is not None else model.encoder.name
    found = cut(knn_join(q, index, k, space, mode=mode, filter=filter, nprobes=nprobes, rescore=rescore, **names))
    want = min(k, rows)
    if fallback and want:
        kept, again = filled(found, q, want, query_id, exact)
        if again is not None:
            why = f"the index gave fewer than {want} rows to this query"
            return finish(kept, "Approximate-NN", reason).unionByName(finish(again, "Exact", why))
    return finish(found, "Approximate-NN", reason)
