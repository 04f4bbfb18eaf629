"""Index tables: vectors with their codes, laid out by coarse list.

Layout under one folder::

    data/change=X/list_id=M/*.parquet   rows that change X wrote
    gone/change=X/*.parquet             ids that X deleted or replaced: rows of earlier changes with these ids are dead
    commits/*.parquet                   one row a finished change: its name, number, and the writer's batch
    meta/*.parquet                      the model

A change writes into folders of a name of its own and counts once its row in ``commits`` is there, which is written last: readers see
all of a change or nothing, and writers never meet in a folder. What a lost job leaves behind belongs to no commit
and is never read. A stream names its writer and batch, so a batch that is run again after its commit does nothing.
Compaction writes a fresh folder.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vicinal.operators.approx import Index
from vicinal.sources.models import MODEL_SCHEMA, Model, _append, _describe, fit_model, model_of
from vicinal.spec import SpecError

ROWS_PER_FILE = 1_000_000
COMMIT_SCHEMA = "change string, number bigint, writer string, batch bigint"


def _maybe(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _layout(df: DataFrame, id: str, list_column: str) -> DataFrame:
    """Rows of a list side by side, ordered by id. Rebalancing lets Spark merge small lists into one task and split a
    list that holds much of the table over several, from the sizes it measures while shuffling."""
    return df.hint("rebalance", list_column).sortWithinPartitions(list_column, id)


def _write(df: DataFrame, model: Model, path: str, change: str, *, encode: bool, rows_per_file: int = ROWS_PER_FILE) -> None:
    df = model.encode(df) if encode else df
    target = f"{path}/data/change={change}"
    if encode and model.centroids is not None:
        df = df.withColumn(model.list_column, F.coalesce(model.list_column, F.lit(-1)))
        rows = _layout(df, model.id, model.list_column)
        writer = rows.write.partitionBy(model.list_column)
    else:
        writer = df.write
    writer.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(target)


def commits(spark: SparkSession, path: str) -> DataFrame:
    """``(change, number, writer, batch)`` of the finished changes; a larger number is a later change."""
    found = _maybe(spark, f"{path}/commits")
    return spark.createDataFrame([], COMMIT_SCHEMA) if found is None else found.select("change", "number", "writer", "batch")


def _commit(spark: SparkSession, path: str, change: str, writer: str | None = None, batch: int | None = None) -> None:
    last = commits(spark, path).agg(F.max("number")).first()[0]
    number = max(time.time_ns(), (last or 0) + 1)
    spark.createDataFrame([(change, number, writer, batch)], COMMIT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/commits")


def write_index(df: DataFrame, model: Model, path: str, *, plain: bool = False, rows_per_file: int = ROWS_PER_FILE) -> Index:
    """Encode a table by its model and write it to a folder that holds no index yet. ``plain`` writes the rows without lists and
    codes; searches over them are exact."""
    spark = df.sparkSession
    if commits(spark, path).limit(1).count():
        raise SpecError(f"{path!r} holds an index already; apply changes to it, or write to another folder")
    change = uuid.uuid4().hex
    _write(df, model, path, change, encode=not plain, rows_per_file=rows_per_file)
    about = _describe(model.model_id or "index", model.spec, f"id={model.id};vec={model.vec}")
    _append(spark, f"{path}/meta", state="plain" if plain else "created", blob=model.to_blob(), **about)
    _commit(spark, path, change)
    return open_index(spark, path)


def open_index(spark: SparkSession, path: str) -> Index:
    """The live rows of an index and its model; ``model`` keeps no codes or lists if the index was not built."""
    meta = spark.read.schema(MODEL_SCHEMA).parquet(f"{path}/meta").orderBy(F.col("entry").desc()).first()
    names = dict(item.split("=", 1) for item in meta.description.split(";"))
    model = model_of(meta, **names)
    if meta.state == "plain":
        model.encoder = model.centroids = None
    return Index(_live(spark, path, model), model)


def _live(spark: SparkSession, path: str, model: Model) -> DataFrame:
    done = commits(spark, path).select("change", "number")
    first = done.limit(2).collect()
    if len(first) == 1:
        return spark.read.parquet(f"{path}/data/change={first[0].change}")
    data = spark.read.parquet(f"{path}/data").join(done, "change")
    gone = _maybe(spark, f"{path}/gone")
    if gone is not None:
        # Two writers at once may take one number; the change's name then decides, the same for every reader.
        when = F.struct("number", "change")
        gone = gone.join(done, "change").groupBy(F.col(model.id).alias("_gone")).agg(F.max(when).alias("_since"))
        data = data.join(gone, (F.col(model.id) == F.col("_gone")) & (when < F.col("_since")), "left_anti")
    return data.drop("change", "number")


def apply_changes(spark: SparkSession, path: str, upserts: DataFrame | None = None, deletes: DataFrame | None = None, *,
                  writer: str | None = None, batch: int | None = None, order: str | None = None) -> Index:
    """Replace the rows of ``upserts`` and remove the ids of ``deletes``; neither appears in later searches.

    An id that ``upserts`` holds twice is an error, unless ``order`` names the column whose largest value decides; an id in both
    tables is upserted.

    ``writer`` and ``batch`` name the change: if it was committed before, nothing happens."""
    index = open_index(spark, path)
    model = index.model
    if writer is not None and commits(spark, path).where((F.col("writer") == writer) & (F.col("batch") == batch)).limit(1).count():
        return index
    change = uuid.uuid4().hex
    built = model.encoder is not None or model.centroids is not None
    ids = [d.select(model.id) for d in (upserts, deletes) if d is not None]
    if not ids:
        return index
    if upserts is not None:
        upserts = _one_each(upserts, model.id, order)
        _write(upserts, model, path, change, encode=built)
    dead = (ids[0] if len(ids) == 1 else ids[0].unionByName(ids[1])).distinct()
    dead.write.mode("overwrite").parquet(f"{path}/gone/change={change}")
    _commit(spark, path, change, writer, batch)
    return open_index(spark, path)


def latest(df: DataFrame, id: str, order: str | None) -> DataFrame:
    """One row an id: the one with the largest ``order``, or, of rows that tie or without one, the one with the largest hash. Partial
    aggregates come first, so an id with very many rows is no task's list."""
    whole = [F.col(f"`{c}`") for c in df.columns]
    key = F.struct(*([F.col(f"`{order}`")] if order else []), F.xxhash64(*whole))
    return df.groupBy(id).agg(F.max_by(F.struct(*whole), key).alias("_row")).select("_row.*")


def _one_each(upserts: DataFrame, id: str, order: str | None) -> DataFrame:
    if order is not None:
        return latest(upserts, id, order)
    twice = upserts.groupBy(id).count().where("count > 1").limit(1).collect()
    if twice:
        raise SpecError(f"id {twice[0][0]!r} appears more than once in one change")
    return upserts


def merge_changes(base: DataFrame, upserts: DataFrame | None, deletes: DataFrame | None, id: str = "id") -> DataFrame:
    """The same change on plain DataFrames."""
    gone = [d.select(id) for d in (upserts, deletes) if d is not None]
    for ids in gone:
        base = base.join(ids, id, "left_anti")
    return base if upserts is None else base.unionByName(upserts)


def compact_index(spark: SparkSession, path: str, out_path: str, *, retrain: bool = True, sample: int | None = None,
                  rows_per_file: int = ROWS_PER_FILE) -> Index:
    """Live rows only, in fresh files under ``out_path``; code thresholds are trained again on all of them, or on ``sample``."""
    if out_path.rstrip("/") == path.rstrip("/"):
        raise SpecError("compaction needs a folder of its own")
    index = open_index(spark, path)
    model = index.model
    built = model.encoder is not None or model.centroids is not None
    rows = index.df.drop(*[c for c in (model.code_column, model.list_column) if c in index.df.columns])
    if retrain and model.encoder is not None and model.encoder.name in ("binary", "sq1", "sq7"):
        fresh = fit_model(rows, model.spec, vec=model.vec, id=model.id, sample=sample, init_lists=model.centroids,
                          iterations=0)
        fresh.centroids, fresh.model_id = model.centroids, model.model_id
        model = fresh
    return write_index(rows, model, out_path, plain=not built, rows_per_file=rows_per_file)


def index_stats(index: Index) -> DataFrame:
    """Per list: rows, bytes of codes and vectors, share of all rows, and size relative to the mean list."""
    model, df = index.model, index.df
    key = F.col(model.list_column) if model.list_column in df.columns else F.lit(0)
    code = F.sum(F.octet_length(model.code_column)) if model.code_column in df.columns else F.lit(0).cast("bigint")
    lists = df.groupBy(key.alias("list_id")).agg(
        F.count("*").alias("row_count"), F.count(model.vec).alias("vector_count"), code.alias("code_bytes"),
        (F.sum(F.size(model.vec)) * 4).alias("vector_bytes"))
    # One row per list (at most the list limit), so one window over all of them is small.
    every = Window.partitionBy(F.lit(0))
    lists = lists.withColumns({"_all": F.sum("row_count").over(every), "_lists": F.count("*").over(every)})
    return lists.select(
        "list_id", "row_count", "vector_count", "code_bytes", "vector_bytes",
        (F.col("row_count") / F.col("_all")).alias("share"),
        (F.col("row_count") * F.col("_lists") / F.col("_all")).alias("skew"))
