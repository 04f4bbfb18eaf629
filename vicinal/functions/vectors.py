"""Vector functions as Column expressions that can be used anywhere in a query. Those on arrays stay in the JVM; those on packed codes,
for which Spark has no functions, take whole columns at a time.

Distances accumulate in double. Vectors of different lengths are an error; a null vector gives null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vicinal.operators.blocks import as_bytes, as_matrix, to_words
from vicinal.spec import SpecError


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _guard(a: Column, b: Column, value: Column, kind: str = "double", size=F.size) -> Column:
    mismatch = F.raise_error(F.concat(F.lit("vector lengths differ: "), size(a).cast("string"), F.lit(" and "),
                                      size(b).cast("string"))).cast(kind)
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast(kind)).when(size(a) == size(b), value).otherwise(mismatch)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def _d(x: Column) -> Column:
    return x.cast("double")


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row; inside a lambda a plain expression would be computed
    again for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: _d(x) * _d(y)))


def l2_squared(a, b) -> Column:
    a, b = _col(a), _col(b)
    return _guard(a, b, _sum(F.zip_with(a, b, lambda x, y: (_d(x) - _d(y)) * (_d(x) - _d(y)))))


def l1_norm(a, b) -> Column:
    a, b = _col(a), _col(b)
    return _guard(a, b, _sum(F.zip_with(a, b, lambda x, y: F.abs(_d(x) - _d(y)))))


def linf_norm(a, b) -> Column:
    a, b = _col(a), _col(b)
    return _guard(a, b, F.array_max(F.zip_with(a, b, lambda x, y: F.abs(_d(x) - _d(y)))))


def inner_product(a, b) -> Column:
    a, b = _col(a), _col(b)
    return _guard(a, b, _dot(a, b))


def magnitude_squared(a) -> Column:
    a = _col(a)
    return _sum(F.transform(a, lambda x: _d(x) * _d(x)))


def cosine_similarity(a, b, a_norm_sq=None) -> Column:
    """Cosine of the angle; 0 where a norm is zero. ``a_norm_sq`` is the *squared* norm of ``a``,
    passed when it is already known."""
    a, b = _col(a), _col(b)
    na = magnitude_squared(a) if a_norm_sq is None else _d(_col(a_norm_sq) if isinstance(a_norm_sq, (str, Column)) else F.lit(a_norm_sq))
    norms = na * magnitude_squared(b)
    return _guard(a, b, F.when(norms > 0, _dot(a, b) / F.sqrt(norms)).otherwise(F.lit(0.0)))


def is_zero_vector(a) -> Column:
    return F.forall(_col(a), lambda x: x == 0)


def l2_normalize(a) -> Column:
    """Unit-length copy of a float vector; a zero vector stays as it is."""
    a = _col(a)
    return _let(F.sqrt(magnitude_squared(a)), lambda norm: F.when(norm > 0, F.transform(a, lambda x: _d(x) / norm)).otherwise(
        a.cast("array<double>")))


def has_vector(a) -> Column:
    return _col(a).isNotNull()


def hamming_long(a, b) -> Column:
    return F.bit_count(_col(a).bitwiseXOR(_col(b)))


def _by_width(rows: np.ndarray, widths: np.ndarray):
    """The row numbers of each width in turn; columns hold few widths."""
    for width in np.unique(widths[rows]):
        yield rows[widths[rows] == width], int(width)


@F.arrow_udf(T.IntegerType())
def _differing_bits(a: pa.Array, b: pa.Array) -> pa.Array:
    """Differing bits of codes of one length; rows without that count 0, which the callers replace."""
    size_a, size_b = (np.asarray(pc.fill_null(pc.binary_length(x), -1)) for x in (a, b))
    out = np.zeros(len(a), np.int32)
    for rows, width in _by_width(np.flatnonzero((size_a == size_b) & (size_a > 0)), size_a):
        at = pa.array(rows)
        out[rows] = np.bitwise_count(to_words(as_bytes(a.take(at))) ^ to_words(as_bytes(b.take(at)))).sum(axis=1)
    return pa.array(out)


def hamming(a, b) -> Column:
    """Differing bits of two packed codes (binary columns) or of two arrays of signed bytes."""
    a, b = _col(a), _col(b)
    return _guard(a, b, _differing_bits(a, b), "int", F.octet_length)


def hamming_bytes(a, b) -> Column:
    """Differing bits of two ``array<tinyint>`` vectors; bytes are signed, so mask before counting."""
    a, b = _col(a), _col(b)
    bits = F.zip_with(a, b, lambda x, y: F.bit_count(x.cast("int").bitwiseXOR(y.cast("int")).bitwiseAND(F.lit(255))))
    return _guard(a, b, F.aggregate(bits, F.lit(0), lambda acc, v: acc + v), "int")


def hamming_base64(a, b) -> Column:
    """Differing bits of two base64 codes read as unsigned big integers: the shorter is zero-filled on the left."""
    raw_a, raw_b = F.unbase64(_col(a)), F.unbase64(_col(b))
    width = F.greatest(F.octet_length(raw_a), F.octet_length(raw_b))
    zero = F.lit(b"\x00")
    wide_a = F.when(F.octet_length(raw_a) < width, F.lpad(raw_a, width, zero)).otherwise(raw_a)
    wide_b = F.when(F.octet_length(raw_b) < width, F.lpad(raw_b, width, zero)).otherwise(raw_b)
    return F.when(raw_a.isNotNull() & raw_b.isNotNull(), _differing_bits(wide_a, wide_b))


def _asymmetric(each):
    """A sum over the dimensions of a float query and the bits of a code, whole columns at a time."""
    @F.arrow_udf(T.DoubleType())
    def run(q: pa.Array, code: pa.Array) -> pa.Array:
        dims, bits = np.asarray(pc.fill_null(pc.list_value_length(q), -1)), 8 * np.asarray(pc.fill_null(pc.binary_length(code), -1))
        out = np.zeros(len(q))
        for rows, width in _by_width(np.flatnonzero((dims == bits) & (dims > 0)), dims):
            at = pa.array(rows)
            out[rows] = each(as_matrix(q.take(at)).astype(np.float64), np.unpackbits(as_bytes(code.take(at)), axis=1).astype(np.float64)).sum(axis=1)
        return pa.array(out)

    return run


_l2_bits = _asymmetric(lambda x, bit: (bit - x) ** 2)
_ip_bits = _asymmetric(lambda x, bit: bit * x)


def _adc(q: Column, code: Column, value) -> Column:
    wrong = F.raise_error(F.lit("the code must hold one bit per query dimension")).cast("double")
    return (F.when(q.isNull() | code.isNull(), F.lit(None).cast("double"))
            .when(F.size(q) == F.octet_length(code) * 8, value(q, code)).otherwise(wrong))


def l2_squared_adc(q, code) -> Column:
    """Squared distance between a float query and a 1-bit code read as zeros and ones."""
    return _adc(_col(q), _col(code), _l2_bits)


def inner_product_adc(q, code) -> Column:
    return _adc(_col(q), _col(code), _ip_bits)


def score_with_adc(q, code, space: str) -> Column:
    from vicinal.functions.scores import to_score

    if space == "l2":
        return to_score(l2_squared_adc(q, code), "l2")
    if space == "innerproduct":
        return to_score(-inner_product_adc(q, code), "innerproduct")
    if space == "cosinesimil":
        return to_score(1 - inner_product_adc(q, code), "cosinesimil")
    raise SpecError(f"space {space!r} is not supported with asymmetric distance")


def raw_distance(a, b, space: str) -> Column:
    """The distance a space compares by, smaller being closer."""
    if space == "cosinesimil":
        return 1 - cosine_similarity(a, b)
    if space == "innerproduct":
        return -inner_product(a, b)
    return {"l2": l2_squared, "l1": l1_norm, "linf": linf_norm, "hamming": hamming}[space](a, b)


_SQL_FUNCTIONS = {
    "l2_squared": "aggregate(zip_with(a, b, (x, y) -> (x - y) * (x - y)), 0D, (s, v) -> s + v)",
    "l1_norm": "aggregate(zip_with(a, b, (x, y) -> abs(x - y)), 0D, (s, v) -> s + v)",
    "linf_norm": "array_max(zip_with(a, b, (x, y) -> abs(x - y)))",
    "inner_product": "aggregate(zip_with(a, b, (x, y) -> x * y), 0D, (s, v) -> s + v)",
    "cosine_similarity": (
        "coalesce(aggregate(zip_with(a, b, (x, y) -> x * y), 0D, (s, v) -> s + v) / nullif(sqrt("
        "aggregate(a, 0D, (s, v) -> s + v * v) * aggregate(b, 0D, (s, v) -> s + v * v)), 0D), 0D)"),
}


def register_sql_functions(spark: SparkSession) -> None:
    """Make the distances callable from SQL text. They are SQL-bodied, so Catalyst inlines them."""
    for name, body in _SQL_FUNCTIONS.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(a ARRAY<DOUBLE>, b ARRAY<DOUBLE>) RETURNS DOUBLE "
            f"RETURN CASE WHEN a IS NULL OR b IS NULL THEN NULL WHEN size(a) = size(b) THEN {body} "
            f"ELSE CAST(raise_error('vector lengths differ') AS DOUBLE) END")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION magnitude_squared(a ARRAY<DOUBLE>) RETURNS DOUBLE "
              "RETURN aggregate(a, 0D, (s, v) -> s + v * v)")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION hamming_long(a BIGINT, b BIGINT) RETURNS INT "
              "RETURN bit_count(a ^ b)")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION cosine_known_norm(a ARRAY<DOUBLE>, b ARRAY<DOUBLE>, norm_squared DOUBLE) RETURNS DOUBLE "
              "RETURN CASE WHEN a IS NULL OR b IS NULL THEN NULL WHEN size(a) = size(b) THEN coalesce(aggregate(zip_with(a, b, (x, y) -> x * y), 0D, "
              "(s, v) -> s + v) / nullif(sqrt(norm_squared * aggregate(b, 0D, (s, v) -> s + v * v)), 0D), 0D) "
              "ELSE CAST(raise_error('vector lengths differ') AS DOUBLE) END")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION hamming_bytes(a ARRAY<TINYINT>, b ARRAY<TINYINT>) RETURNS INT "
              "RETURN CASE WHEN a IS NULL OR b IS NULL THEN NULL WHEN size(a) = size(b) THEN aggregate(zip_with(a, b, (x, y) -> "
              "bit_count((int(x) ^ int(y)) & 255)), 0, (s, v) -> s + v) ELSE CAST(raise_error('vector lengths differ') AS INT) END")
    # Whole-column functions under internal names, behind the same checks.
    for name, function in (("_differing_bits", _differing_bits), ("_l2_bits", _l2_bits), ("_ip_bits", _ip_bits)):
        spark.udf.register(name, function)
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION hamming(a BINARY, b BINARY) RETURNS INT RETURN CASE WHEN a IS NULL OR b IS NULL THEN NULL "
              "WHEN octet_length(a) = octet_length(b) THEN _differing_bits(a, b) ELSE CAST(raise_error('vector lengths differ') AS INT) END")
    for name, inner in (("l2_squared_adc", "_l2_bits"), ("inner_product_adc", "_ip_bits")):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(q ARRAY<DOUBLE>, code BINARY) RETURNS DOUBLE RETURN CASE WHEN q IS NULL OR code IS NULL "
                  f"THEN NULL WHEN size(q) = octet_length(code) * 8 THEN {inner}(q, code) "
                  "ELSE CAST(raise_error('the code must hold one bit per query dimension') AS DOUBLE) END")
    from vicinal.operators.rerank import register_late_interaction

    register_late_interaction(spark)
