"""Trained models and the table they are kept in.

The table is an append-only log of model states; the latest row of an id counts, and a ``deleted`` row removes it.
Nothing is rewritten, so readers and writers do not disturb one another.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, replace

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vicinal.operators import training
from vicinal.operators.encoders import ByteCode, Encoder, Fp16, pack, unpack
from vicinal.plans.limits import vector_length
from vicinal.spec import MAX_DESCRIPTION, Rescore, SpecError, VectorSpec, resolve_rescore, validate_spec

MODEL_SCHEMA = ("model_id string, space string, dimension int, data_type string, state string, timestamp timestamp, "
                "description string, error string, method string, encoder string, mode string, compression string, "
                "params map<string,string>, blob binary, entry bigint")


@dataclass
class Model:
    """Everything needed to encode rows and to search them."""

    spec: VectorSpec
    encoder: Encoder | None = None
    centroids: np.ndarray | None = None
    model_id: str | None = None
    id: str = "id"
    vec: str = "vec"
    code_column: str = "code"
    list_column: str = "list_id"

    @property
    def space(self) -> str:
        return self.spec.resolved_space

    def default_rescore(self, mode: str) -> Rescore | None:
        return resolve_rescore(replace(self.spec, method="flat", compression="32x", params={}) if mode == "flat" else self.spec)

    def encode(self, df: DataFrame) -> DataFrame:
        """Add the code and the list number of each row; both stay null without a vector."""
        from vicinal.operators.approx import assign_lists

        if self.encoder is not None:
            df = df.withColumn(self.code_column, self.encoder.column(self.vec))
        if self.centroids is not None:
            df = assign_lists(df, self.centroids, self.space, vec=self.vec, column=self.list_column)
        return df

    def to_blob(self) -> bytes:
        return pack(self.encoder, centroids=self.centroids)


def _typed(value: str):
    for kind in (int, float):
        try:
            return kind(value)
        except ValueError:
            pass
    return {"True": True, "False": False}.get(value, value)


def _log(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(MODEL_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MODEL_SCHEMA)


def models(spark: SparkSession, path: str) -> DataFrame:
    """Current models, one row each; filter and select as needed."""
    log = _log(spark, path)
    names = [n for n in log.columns if n != "model_id"]
    last = log.groupBy("model_id").agg(F.max_by(F.struct(*names), "entry").alias("m"))
    return last.select("model_id", *[F.col(f"m.{n}").alias(n) for n in names]).where("state <> 'deleted'")


def _append(spark: SparkSession, path: str, **row) -> None:
    row = {"timestamp": None, **row}
    names = [c.split()[0] for c in MODEL_SCHEMA.split(", ")]
    values = [row.get(n) for n in names]
    values[names.index("entry")] = time.time_ns()
    spark.createDataFrame([tuple(values)], MODEL_SCHEMA).withColumn("timestamp", F.current_timestamp()).coalesce(1).write.mode(
        "append").parquet(path)


def _describe(model_id: str, spec: VectorSpec, description: str) -> dict:
    return dict(model_id=model_id, space=spec.resolved_space, dimension=spec.dimension, data_type=spec.data_type,
                description=description, method=spec.method, encoder=spec.encoder, mode=spec.mode,
                compression=spec.compression, params={k: str(v) for k, v in spec.params.items()})


def fit_model(c: DataFrame, spec: VectorSpec, *, vec: str = "vec", id: str = "id", seed: int = 42, iterations: int = 10,
              sample: int | None = None, init_lists: np.ndarray | None = None,
              init_codes: np.ndarray | None = None) -> Model:
    """Fit what the spec asks for: coarse lists, an encoder, or both. Encoders see all rows unless ``sample`` is given."""
    p, space = spec.params, spec.resolved_space
    encoder = None
    if spec.encoder == "binary":
        encoder = training.fit_scalar_quantizer(c, p.get("bits", 1), sample=sample, rotate=p.get("random_rotation", False),
                                                vec=vec, id=id, unit=space == "cosinesimil")
    elif spec.encoder == "pq":
        encoder = training.fit_pq(c, p.get("m", 1), p.get("code_size", 8), space=space, iterations=iterations, seed=seed,
                                  vec=vec, id=id, init=init_codes)
    elif spec.encoder == "sq7":
        encoder = training.fit_sq7(c, p.get("confidence_interval"), vec=vec, id=id, sample=sample)
    elif spec.encoder == "sq1":
        encoder = training.fit_sq1(c, space, vec=vec)
    elif spec.encoder == "fp16":
        encoder = Fp16(p.get("clip", False))
    elif spec.encoder == "byte":
        encoder = ByteCode()
    centroids = None
    if spec.method == "ivf":
        centroids = training.fit_ivf(c, p.get("nlist", 4), space=space, iterations=iterations, seed=seed, vec=vec, id=id,
                                     init=init_lists)
    return Model(spec, encoder, centroids, id=id, vec=vec)


def train_model(c: DataFrame, model_id: str, spec: VectorSpec, path: str, *, description: str = "", vec: str = "vec",
                id: str = "id", max_training_vectors: int | None = None, quantize_bits: int | None = None, seed: int = 42,
                iterations: int = 10, init_lists: np.ndarray | None = None) -> Model:
    """Check the request, record ``training``, fit on the rows that have a vector, record ``created`` or ``failed``.

    ``quantize_bits`` trains on the 0/1 form of the rows' bit codes instead of the rows themselves. ``init_lists`` are the centroids
    that training starts from.
    """
    spark = c.sparkSession
    if models(spark, path).where(F.col("model_id") == model_id).limit(1).count():
        raise SpecError(f"a model with id {model_id!r} already exists")
    validate_spec(spec)
    if spec.method != "ivf" and spec.encoder not in ("pq", "binary", "sq7", "sq1"):
        raise SpecError("the method does not require training")
    if len(description) > MAX_DESCRIPTION or "," in description:
        raise SpecError(f"a description has at most {MAX_DESCRIPTION} characters and no comma")
    rows = c.where(F.col(vec).isNotNull())
    dim = vector_length(rows, vec)
    if dim is not None and spec.data_type == "binary":
        dim *= 8
    if dim is not None and dim != spec.dimension:
        raise SpecError(f"the training vectors have {dim} dimensions, not {spec.dimension}")
    about = _describe(model_id, spec, description)
    _append(spark, path, state="training", **about)
    try:
        if max_training_vectors is not None:
            rows = training.sample_vectors(rows, max_training_vectors, id=id, seed=seed)
        if quantize_bits is not None:
            bits = training.fit_scalar_quantizer(rows, quantize_bits, vec=vec, id=id)
            # Every plane counts: the model works on quantize_bits values a dimension, and so do rows and queries put to it.
            rows = rows.withColumn(vec, bits.decoded(bits.column(vec)))
            spec = replace(spec, dimension=quantize_bits * spec.dimension)
            about = _describe(model_id, spec, description)
        model = fit_model(rows, spec, vec=vec, id=id, seed=seed, iterations=iterations, init_lists=init_lists)
        model.model_id = model_id
    except Exception as e:
        _append(spark, path, state="failed", error=str(e), **about)
        raise
    _append(spark, path, state="created", blob=model.to_blob(), **about)
    return model


def save_model(spark: SparkSession, path: str, model: Model, model_id: str, description: str = "") -> None:
    """Record a model that was fitted elsewhere."""
    _append(spark, path, state="created", blob=model.to_blob(), **_describe(model_id, model.spec, description))


def load_model(spark: SparkSession, path: str, model_id: str, *, id: str = "id", vec: str = "vec") -> Model:
    row = models(spark, path).where(F.col("model_id") == model_id).first()
    if row is None:
        raise SpecError(f"there is no model with id {model_id!r}")
    if row.state != "created":
        raise SpecError(f"model {model_id!r} is in state {row.state!r}")
    return model_of(row, id=id, vec=vec)


def model_of(row, *, id: str = "id", vec: str = "vec") -> Model:
    encoder, arrays = unpack(bytes(row.blob))
    spec = VectorSpec(row.dimension, row.data_type, row.space, row.mode, row.compression, row.method, row.encoder,
                      {k: _typed(v) for k, v in (row.params or {}).items()})
    return Model(spec, encoder, arrays.get("centroids"), row.model_id, id=id, vec=vec)


def drop_model(spark: SparkSession, path: str, model_id: str) -> None:
    if not models(spark, path).where(F.col("model_id") == model_id).limit(1).count():
        raise SpecError(f"there is no model with id {model_id!r}")
    _append(spark, path, model_id=model_id, state="deleted")
