"""Ground truth, recall and per-query counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vicinal.operators.knn import knn_join
from vicinal.operators.training import vector_stats  # noqa: F401  (part of the evaluation surface)


def ground_truth(q: DataFrame, c, k: int, space: str = "l2", *, query_id: str = "query_id", id: str = "id", **names) -> DataFrame:
    """The exact top-k ids of each query, as a set: ``(query_id, ids)``."""
    hits = knn_join(q, c, k, space, query_id=query_id, id=id, **names)
    return hits.groupBy(query_id).agg(F.sort_array(F.collect_set(id)).alias("ids"))


def recall_per_query(hits: DataFrame, truth: DataFrame, k: int, *, query_id: str = "query_id", id: str = "id") -> DataFrame:
    if "ids" in truth.columns:
        truth = truth.select(query_id, F.explode("ids").alias(id))
    found = hits.select(query_id, id, F.lit(1).alias("_hit"))
    return (truth.select(query_id, id).join(found, [query_id, id], "left")
            .groupBy(query_id).agg((F.count("_hit") / F.lit(k)).alias("recall")))


def recall_at_k(hits: DataFrame, truth: DataFrame, k: int, *, query_id: str = "query_id", id: str = "id") -> DataFrame:
    """One row: the share of the true neighbours found, averaged over the queries."""
    return recall_per_query(hits, truth, k, query_id=query_id, id=id).agg(F.avg("recall").alias("recall"))


def search_metrics(q: DataFrame, c: DataFrame, hits: DataFrame, *, on=None, filter=None, exact: bool = True, parent: str | None = None,
                   query_id: str = "query_id", vec: str = "vec") -> DataFrame:
    """Per query: rows that passed the filter, rows compared by the index and by the exact path, hits returned,
    and for nested tables the parents behind the rows."""
    if filter is not None:
        c = c.where(filter)
    c = c.where(F.col(vec).isNotNull())
    columns = [F.count("*").alias("filtered_rows")]
    if parent is not None:
        columns.append(F.count_distinct(parent).alias("nested_docs"))
    if on is None:
        row = c.agg(*columns).first()
        counts = q.select(query_id, F.lit(row.filtered_rows).alias("filtered_rows"),
                          *([F.lit(row.nested_docs).alias("nested_docs")] if parent else []))
    else:
        # Counted per distinct filter value first, so a frequent value costs one row.
        left, right = on
        per_value = c.groupBy(F.col(right).alias(left)).agg(*columns)
        counts = q.select(query_id, left).join(per_value, left, "left").fillna(0).drop(left)
    returned = hits.groupBy(query_id).agg(F.count("*").alias("returned"))
    out = counts.join(returned, query_id, "left").fillna(0, ["returned"])
    zero = F.lit(0).cast("bigint")
    return out.withColumns({"ann_count": zero if exact else F.col("returned"),
                            "exact_count": F.col("filtered_rows") if exact else zero})
