import base64

import numpy as np
import pytest

from vicinal.functions import scores as S
from vicinal.functions import vectors as V
from vicinal.spec import SpecError


def one(spark, expr, **columns):
    df = spark.createDataFrame([tuple(v for v, _ in columns.values())], ", ".join(f"{n} {t}" for n, (_, t) in columns.items()))
    return df.select(expr.alias("x")).first().x


A, B = ([1.0, 1.0, 1.0], "array<float>"), ([4.0, 4.0, 4.0], "array<float>")


@pytest.mark.parametrize("fn,want", [(V.l2_squared, 27.0), (V.l1_norm, 9.0), (V.linf_norm, 3.0), (V.inner_product, 12.0),
                                     (V.cosine_similarity, 1.0)])
def test_distances(spark, fn, want):
    assert one(spark, fn("a", "b"), a=A, b=B) == pytest.approx(want)


@pytest.mark.parametrize("fn", [V.l2_squared, V.l1_norm, V.linf_norm, V.inner_product, V.cosine_similarity])
def test_length_mismatch_is_an_error_and_null_is_null(spark, fn):
    with pytest.raises(Exception, match="lengths differ"):
        one(spark, fn("a", "b"), a=A, b=([1.0, 2.0], "array<float>"))
    assert one(spark, fn("a", "b"), a=A, b=(None, "array<float>")) is None


def test_cosine_of_zero_vector_is_zero_and_the_known_norm_is_squared(spark):
    assert one(spark, V.cosine_similarity("a", "b"), a=([0.0, 0.0, 0.0], "array<float>"), b=B) == 0.0
    assert one(spark, V.cosine_similarity("a", "b", 3.0), a=A, b=B) == pytest.approx(1.0)


def test_signed_bytes_and_packed_codes(spark):
    a, b = [-1, 0, 5], [0, -128, 4]
    want = sum(bin((x ^ y) & 255).count("1") for x, y in zip(a, b))
    assert one(spark, V.hamming_bytes("a", "b"), a=(a, "array<tinyint>"), b=(b, "array<tinyint>")) == want
    pack = lambda v: bytearray(x & 255 for x in v)
    assert one(spark, V.hamming("a", "b"), a=(pack(a), "binary"), b=(pack(b), "binary")) == want
    with pytest.raises(Exception, match="lengths differ"):
        one(spark, V.hamming("a", "b"), a=(pack(a), "binary"), b=(pack(b[:2]), "binary"))


def test_hamming_long_is_64_bit(spark):
    assert one(spark, V.hamming_long("a", "b"), a=(-1, "bigint"), b=(0, "bigint")) == 64


@pytest.mark.parametrize("x,y", [(0, 0), (1, 2 ** 70), (2 ** 64 - 1, 255), (12345678901234567890, 3)])
def test_hamming_base64_reads_big_integers(spark, x, y):
    text = lambda n: base64.b64encode(n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big")).decode()
    assert one(spark, V.hamming_base64("a", "b"), a=(text(x), "string"), b=(text(y), "string")) == bin(x ^ y).count("1")


def test_adc(spark):
    q, code = [0.5, 0.0, 1.0, 0.25, 0.0, 0.0, 0.0, 1.0], bytearray([0b10100001])
    bits = np.unpackbits(np.frombuffer(bytes(code), np.uint8))
    columns = dict(q=(q, "array<double>"), c=(code, "binary"))
    assert one(spark, V.l2_squared_adc("q", "c"), **columns) == pytest.approx(((bits - np.array(q)) ** 2).sum())
    assert one(spark, V.inner_product_adc("q", "c"), **columns) == pytest.approx((bits * q).sum())
    with pytest.raises(SpecError):
        V.score_with_adc("q", "c", "l1")
    with pytest.raises(Exception, match="one bit per query dimension"):
        one(spark, V.l2_squared_adc("q", "c"), q=([1.0], "array<double>"), c=(code, "binary"))


@pytest.mark.parametrize("space,raw,want", [("l2", 3.0, 0.25), ("l1", 1.0, 0.5), ("cosinesimil", 0.5, 0.75), ("cosinesimil", 3.0, 0.0),
                                            ("innerproduct", 1.0, 0.5), ("innerproduct", -2.0, 3.0), ("hamming", 0.0, 1.0)])
def test_scores_agree_in_both_forms(spark, space, raw, want):
    assert one(spark, S.to_score("r", space), r=(raw, "double")) == pytest.approx(want)
    assert S.score_array(np.array([raw]), space)[0] == pytest.approx(want)


@pytest.mark.parametrize("space", ["l2", "cosinesimil", "innerproduct"])
@pytest.mark.parametrize("score", [0.2, 0.5, 0.99, 1.0, 1.8])
def test_threshold_inverts_the_score(spark, space, score):
    if score > 1 and space != "innerproduct":
        return
    raw = S.score_to_threshold(score, space)
    assert S.score_array(np.array([raw]), space)[0] == pytest.approx(score)
    assert one(spark, S.score_to_threshold("s", space), s=(score, "double")) == pytest.approx(raw)


def test_score_zero_has_no_l2_distance():
    with pytest.raises(SpecError):
        S.score_to_threshold(0, "l2")


def test_ip_score_to_cosine_score(spark):
    for cos in (-0.9, 0.0, 0.4):
        s = 1 + cos if cos >= 0 else 1 / (1 - cos)
        assert one(spark, S.ip_score_to_cosine_score("s"), s=(s, "double")) == pytest.approx((1 + cos) / 2)


def test_normalize_and_zero_test(spark):
    assert one(spark, V.l2_normalize("a"), a=([3.0, 4.0], "array<float>")) == pytest.approx([0.6, 0.8])
    assert one(spark, V.is_zero_vector("a"), a=([0.0, 0.0], "array<float>")) is True


def test_sql_names(spark):
    V.register_sql_functions(spark)
    row = spark.sql("SELECT l2_squared(array(1D,1D), array(4D,4D)) a, cosine_similarity(array(0D), array(1D)) b, hamming_long(7, 0) c").first()
    assert (row.a, row.b, row.c) == (18.0, 0.0, 3)


def test_codes_of_many_lengths_and_nulls(spark):
    rng = np.random.default_rng(3)
    rows = [(i, bytes(rng.integers(0, 256, i % 21).astype(np.uint8)), bytes(rng.integers(0, 256, i % 21).astype(np.uint8)), rng.normal(size=8 * (i % 21)).tolist()) for i in range(200)]
    df = spark.createDataFrame(rows + [(900, None, b"a", [0.0] * 8), (901, b"a", None, None)], "id int, a binary, b binary, q array<double>")
    got = df.select("id", V.hamming("a", "b").alias("h"), V.l2_squared_adc("q", "b").alias("l"), V.inner_product_adc("q", "b").alias("i")).collect()
    for r in got:
        if r.id >= 900:
            assert r.h is None and (r.l is None) == (r.id == 901)
            continue
        _, a, b, q = rows[r.id]
        bits = np.unpackbits(np.frombuffer(b, np.uint8))
        assert r.h == sum((x ^ y).bit_count() for x, y in zip(a, b))
        assert r.l == pytest.approx(((bits - np.array(q)) ** 2).sum()) and r.i == pytest.approx((bits * np.array(q)).sum())


def test_sql_names(spark):
    V.register_sql_functions(spark)
    row = spark.sql("""SELECT hamming(x'0f', x'f1') a, hamming_bytes(array(-1Y, 0Y), array(0Y, 1Y)) b, l2_squared_adc(array(0D,1D,0D,0D,0D,0D,0D,0D), x'80') c,
        inner_product_adc(array(3D,1D,0D,0D,0D,0D,0D,0D), x'80') d, cosine_known_norm(array(3D,4D), array(6D,8D), 25D) e, hamming(NULL, x'00') f,
        late_interaction_l2(array(array(1D,0D)), array(array(1D,0D), array(5D,5D))) g, late_interaction_innerproduct(array(array(1D,0D), array(0D,1D)), array(array(2D,3D))) h""").first()
    assert row[:6] == (7, 9, 2.0, 3.0, pytest.approx(1.0), None) and row.g == pytest.approx(1.0) and row.h == pytest.approx(3.0 + 4.0)
    with pytest.raises(Exception, match="vector lengths differ"):
        spark.sql("SELECT hamming(x'0f', x'f1f1')").collect()
