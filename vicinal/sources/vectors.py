"""Reading, checking, decoding and projecting vector columns."""

from __future__ import annotations

import fnmatch

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vicinal.operators.blocks import as_bytes, as_matrix, binary_array, list_array, where_valid
from vicinal.spec import SpecError, VectorSpec, validate_spec

_ELEMENT = {"float": T.FloatType, "byte": T.ByteType}


def read_vectors(spark: SparkSession, path: str, spec: VectorSpec, *, vec: str = "vec", format: str = "parquet",
                 columns=None, **options) -> DataFrame:
    """A table whose ``vec`` column has the declared type; only the named columns are read."""
    validate_spec(spec)
    df = spark.read.format(format).options(**options).load(path)
    if columns is not None:
        df = df.select(*dict.fromkeys([*columns, vec]))
    kind = df.schema[vec].dataType
    if spec.data_type == "binary":
        if not isinstance(kind, T.BinaryType):
            raise SpecError(f"column {vec!r} must be binary")
        return df
    if not isinstance(kind, T.ArrayType):
        raise SpecError(f"column {vec!r} must be an array")
    if isinstance(kind.elementType, _ELEMENT[spec.data_type]):
        return df
    return df.withColumn(vec, F.col(vec).cast(T.ArrayType(_ELEMENT[spec.data_type]())))


def vector_problem(vec: str | Column, spec: VectorSpec, kind: T.DataType | None = None) -> Column:
    """Why a vector is not acceptable, or null if it is (or is missing)."""
    v = F.col(vec) if isinstance(vec, str) else vec
    if spec.data_type == "binary":
        return F.when(v.isNotNull() & (F.octet_length(v) * 8 != spec.dimension), F.lit("wrong dimension"))
    tests = [(F.size(v) != spec.dimension, "wrong dimension"),
             (F.exists(v, lambda x: x.isNull()), "missing value")]
    floating = kind is None or not isinstance(kind, T.ArrayType) or isinstance(kind.elementType, (T.FloatType, T.DoubleType))
    if floating:
        tests += [(F.exists(v, lambda x: F.isnan(x)), "NaN"),
                  (F.exists(v, lambda x: F.abs(x.cast("double")) == F.lit(float("inf"))), "infinity")]
    if spec.data_type == "byte":
        if floating:
            tests.append((F.exists(v, lambda x: x.cast("double") != F.rint(x.cast("double"))), "not a whole number"))
        tests.append((F.exists(v, lambda x: ~x.between(-128, 127)), "outside the byte range"))
    if spec.resolved_space == "cosinesimil":
        tests.append((F.forall(v, lambda x: x == 0), "zero vector"))
    problem = None
    for test, text in tests:
        hit = v.isNotNull() & F.coalesce(test, F.lit(False))
        problem = F.when(hit, F.lit(text)) if problem is None else problem.when(hit, F.lit(text))
    return problem


def validate_vectors(df: DataFrame, spec: VectorSpec, *, vec: str = "vec", on_error: str = "fail"):
    """``'fail'``: the same rows, with an error when the first bad one is met.
    ``'quarantine'``: ``(good, bad)``, the bad rows with a ``problem`` column."""
    validate_spec(spec)
    problem = vector_problem(vec, spec, df.schema[vec].dataType)
    if on_error == "quarantine":
        marked = df.withColumn("problem", problem)
        return marked.where(F.col("problem").isNull()).drop("problem"), marked.where(F.col("problem").isNotNull())
    if on_error != "fail":
        raise SpecError("on_error must be 'fail' or 'quarantine'")
    kind = df.schema[vec].dataType
    stop = F.raise_error(F.concat(F.lit("invalid vector: "), problem)).cast(kind)
    return df.withColumn(vec, F.when(problem.isNull(), F.col(vec)).otherwise(stop))


@F.arrow_udf(T.ArrayType(T.FloatType()))
def _from_bytes(values: pa.Array) -> pa.Array:
    there = values.drop_null()
    if not len(there):
        return pa.nulls(len(values), pa.list_(pa.float32()))
    rows = list_array(np.ascontiguousarray(as_bytes(there)).view("<f4"), pa.float32())
    valid = values.is_valid().to_numpy(zero_copy_only=False)
    return rows if valid.all() else rows.take(pa.array(np.cumsum(valid) - 1, mask=~valid))


def decode_vectors(df: DataFrame, col: str, spec: VectorSpec) -> DataFrame:
    """Vectors from arrays, single numbers (dimension 1), base64 text or raw bytes of little-endian float32."""
    kind = df.schema[col].dataType
    if spec.data_type == "binary":
        return df.withColumn(col, F.unbase64(col)) if isinstance(kind, T.StringType) else df
    target = T.ArrayType(_ELEMENT[spec.data_type]())
    if isinstance(kind, T.ArrayType):
        return df.withColumn(col, F.col(col).cast(target))
    if isinstance(kind, T.NumericType):
        if spec.dimension != 1:
            raise SpecError("a single number is a vector of dimension 1 only")
        return df.withColumn(col, F.when(F.col(col).isNotNull(), F.array(F.col(col))).cast(target))
    if isinstance(kind, (T.StringType, T.BinaryType)):
        if spec.data_type != "float":
            raise SpecError("encoded vectors hold float32 values")
        raw = F.to_binary(F.col(col), F.lit("base64")) if isinstance(kind, T.StringType) else F.col(col)
        size = F.octet_length(raw)

        def wrong(text):
            return F.raise_error(F.lit(text)).cast("binary")

        checked = (F.when(size % 4 != 0, wrong("an encoded vector must be a multiple of 4 bytes long"))
                   .when(size != 4 * spec.dimension, wrong(f"an encoded vector must have {spec.dimension} dimensions"))
                   .otherwise(raw))
        return df.withColumn(col, _from_bytes(checked))
    raise SpecError(f"cannot read vectors from {kind.simpleString()}")


@F.arrow_udf(T.BinaryType())
def _to_bytes(values: pa.Array) -> pa.Array:
    there = values.drop_null()
    if not len(there):
        return pa.nulls(len(values), pa.binary())
    rows = np.ascontiguousarray(as_matrix(there).astype("<f4"))
    codes = binary_array(rows.view(np.uint8))
    valid = values.is_valid().to_numpy(zero_copy_only=False)
    return codes if valid.all() else codes.take(pa.array(np.cumsum(valid) - 1, mask=~valid))


def encode_vectors(df: DataFrame, col: str, format: str = "binary") -> DataFrame:
    """``binary``: base64 of little-endian float32; ``array``: as it is."""
    if format == "array":
        return df
    if format != "binary":
        raise SpecError("format must be 'binary' or 'array'")
    # base64() breaks long text into lines; the encoded form has none.
    return df.withColumn(col, F.translate(F.base64(_to_bytes(F.col(col))), "\r\n", ""))


def packed_bits(vec: str | Column, threshold: float = 0.0) -> Column:
    """Packed binary vector of the signs of ``value - threshold``, most significant bit first."""

    @F.arrow_udf("binary")
    def run(values: pa.Array) -> pa.Array:
        return where_valid(values, pa.binary(), lambda v: binary_array(np.packbits(as_matrix(v) > threshold, axis=1)))

    return run(F.col(vec) if isinstance(vec, str) else vec)


def unpacked_bits(code: str | Column) -> Column:
    """Signed bytes of a packed code as ``array<tinyint>``."""
    @F.arrow_udf("array<tinyint>")
    def run(values: pa.Array) -> pa.Array:
        return where_valid(values, pa.list_(pa.int8()), lambda v: list_array(as_bytes(v).view(np.int8), pa.int8()))

    return run(F.col(code) if isinstance(code, str) else code)


def select_fields(df: DataFrame, includes=None, excludes=None) -> DataFrame:
    """Columns (nested ones by dotted path) whose names match ``includes`` and not ``excludes``; ``*`` is a wildcard.

    A column that is left out is not read from the file.
    """
    def wanted(path: str) -> bool:
        parents = [path[:i] for i, ch in enumerate(path) if ch == "."] + [path]
        keep = not includes or any(fnmatch.fnmatchcase(p, pat) for p in parents for pat in includes)
        return keep and not any(fnmatch.fnmatchcase(p, pat) for p in parents for pat in excludes or ())

    def build(kind: T.StructType, prefix: str):
        out = []
        for f in kind.fields:
            path = prefix + f.name
            if isinstance(f.dataType, T.StructType):
                inner = build(f.dataType, path + ".")
                if inner:
                    out.append(F.struct(*inner).alias(f.name))
            elif wanted(path):
                out.append(F.col(".".join(f"`{p}`" for p in path.split("."))).alias(f.name))
        return out

    return df.select(*build(df.schema, ""))


def forbid_vector_sort(df: DataFrame, *columns: str) -> None:
    """Sorting by a vector has no meaning; callers check their sort keys here."""
    for name in columns:
        if isinstance(df.schema[name].dataType, (T.ArrayType, T.BinaryType)):
            raise SpecError(f"cannot sort by the vector column {name!r}")
