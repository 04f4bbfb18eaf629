"""Live tables: streaming loads, changes and queries. Ranking needs batch operators, so each micro-batch runs as one."""

from __future__ import annotations

import json
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from vicinal.operators.approx import Index
from vicinal.operators.knn import knn_join
from vicinal.sources.index import apply_changes, latest, open_index
from vicinal.sources.vectors import validate_vectors
from vicinal.spec import SpecError


def _start(stream: DataFrame, each: Callable, checkpoint: str, trigger: dict | None, mode: str = "append") -> StreamingQuery:
    return (stream.writeStream.foreachBatch(each).outputMode(mode).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def _writer(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the query when its checkpoint was made. A checkpoint that is deleted and started again counts its batches
    from 0 once more, but as another writer."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def stream_into_index(stream: DataFrame, path: str, checkpoint: str, *, bad_rows: str | None = None, writer: str | None = None,
                      order: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Index arriving rows: check, encode with the index's model, write; a row whose id is stored replaces it. Of rows of a batch with one
    id one is stored, that with the largest ``order`` where a column is named. Batch n of a ``writer`` (by default the id that the
    checkpoint keeps) is one change, so a batch that is run again is stored once. Bad rows stop the stream or go to ``bad_rows``."""

    def each(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        model = open_index(spark, path).model
        if bad_rows is None:
            good = validate_vectors(batch, model.spec, vec=model.vec)
        else:
            good, bad = validate_vectors(batch, model.spec, vec=model.vec, on_error="quarantine")
            bad.write.mode("overwrite").parquet(f"{bad_rows}/batch={n}")
        apply_changes(spark, path, latest(good, model.id, order), writer=writer or _writer(spark, checkpoint), batch=n)

    return _start(stream, each, checkpoint, trigger)


def _newest_only(stream: DataFrame, id: str, op: str, order: str) -> DataFrame:
    """Of each id the newest row of a batch, where no newer one came before: Spark keeps the largest ``order`` of each id as keyed state, so
    a batch costs what it brings, however long the stream has run."""
    names = stream.columns
    schema = T.StructType(list(stream.schema.fields))

    def pick(key, frames, state):
        held = state.get[0] if state.exists else None
        best, row = None, None
        for frame in frames:
            for i, (what, at) in enumerate(zip(frame[op], frame[order])):
                if what not in ("upsert", "delete"):
                    raise SpecError(f"unknown change {what!r}")
                missing = at is None or at != at
                mark = float("-inf") if missing else float(at.value if hasattr(at, "value") else at)
                if best is None or (mark, what) > best:
                    best, row = (mark, what), frame.iloc[i:i + 1]
        if row is not None and (held is None or best[0] >= held):
            state.update((best[0],))
            yield row[names]

    return stream.groupBy(id).applyInPandasWithState(pick, schema, "at double", "update", GroupStateTimeout.NoTimeout)


def stream_changes(stream: DataFrame, path: str, checkpoint: str, *, op: str = "op", order: str = "ts", writer: str | None = None,
                   trigger: dict | None = None) -> StreamingQuery:
    """Apply a stream of ``upsert``/``delete`` rows. Of an id the row with the largest ``order`` (a number or time; none is the oldest)
    counts, in a batch and across the batches of the stream: a row older than what was applied before is dropped, of equally old ones
    an upsert counts. Any other ``op`` stops the stream. What was applied before is state of the checkpoint."""
    id = open_index(stream.sparkSession, path).model.id
    newest = _newest_only(stream, id, op, order)

    def each(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            upserts = batch.where(F.col(op) == "upsert").drop(op, order)
            deletes = batch.where(F.col(op) == "delete").select(id)
            apply_changes(spark, path, upserts, deletes, writer=writer or _writer(spark, checkpoint), batch=n)
        finally:
            batch.unpersist()

    return _start(newest, each, checkpoint, trigger, mode="update")


def stream_knn(queries: DataFrame, table: DataFrame | Index, k: int, space: str, out_path: str, checkpoint: str, *,
               trigger: dict | None = None, **options) -> StreamingQuery:
    """Answer arriving queries from a stored table; the hits of batch n go to ``out_path/batch=n``."""

    def each(batch: DataFrame, n: int) -> None:
        knn_join(batch, table, k, space, **options).write.mode("overwrite").parquet(f"{out_path}/batch={n}")

    return _start(queries, each, checkpoint, trigger)
