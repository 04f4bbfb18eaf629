import pytest

from vicinal.plans.choice import choose
from vicinal.spec import (SpecError, VectorSpec, check_k, check_radius, estimate_overhead_kb, first_pass_k, resolve_rescore, resolve_spec,
                          validate_spec)


@pytest.mark.parametrize("spec", [
    VectorSpec(0), VectorSpec(16_001), VectorSpec(8, "text"), VectorSpec(9, "binary"), VectorSpec(8, "binary", "l2"),
    VectorSpec(8, "float", "hamming"), VectorSpec(8, mode="fast"), VectorSpec(8, compression="3x"), VectorSpec(8, "byte", mode="on_disk"),
    VectorSpec(8, method="tree"), VectorSpec(8, encoder="zip"), VectorSpec(8, method="flat", params={"m": 1}),
    VectorSpec(8, method="ivf", params={"nlist": 0}), VectorSpec(8, method="ivf", params={"nlist": 20_000}),
    VectorSpec(8, method="ivf", params={"wheels": 4}), VectorSpec(8, method="ivf", params={"nlist": True}),
    VectorSpec(8, encoder="pq", params={"m": 3}), VectorSpec(8, encoder="binary", params={"bits": 3}),
    VectorSpec(8, encoder="sq7", params={"confidence_interval": 0.5}),
    VectorSpec(8, encoder="binary", params={"bits": 2, "enable_adc": True}),
    VectorSpec(8, encoder="binary", params={"bits": 1}, compression="8x"),
])
def test_bad_specs(spec):
    with pytest.raises(SpecError):
        validate_spec(spec)


@pytest.mark.parametrize("compression,encoder,bits", [("1x", "flat", None), ("2x", "fp16", None), ("4x", "sq7", None),
                                                      ("8x", "binary", 4), ("16x", "binary", 2), ("32x", "binary", 1)])
def test_compression_names_the_encoder(compression, encoder, bits):
    spec = resolve_spec(32, compression=compression)
    assert (spec.encoder, spec.params.get("bits")) == (encoder, bits)


def test_defaults_and_conflicts():
    assert resolve_spec(32, mode="on_disk").compression == "32x"
    assert resolve_spec(32).resolved_space == "l2"
    assert VectorSpec(8, "binary").resolved_space == "hamming"
    assert resolve_spec(32, method="flat").encoder == "sq1"
    with pytest.raises(SpecError):
        resolve_spec(32, space="l2", method_space="innerproduct")


@pytest.mark.parametrize("kw,engine,want", [
    (dict(mode="on_disk", compression="4x", encoder="sq7"), "faiss", 1.0),
    (dict(mode="on_disk", compression="8x"), "faiss", 5.0),
    (dict(mode="on_disk", compression="32x"), "lucene", 2.0),
    (dict(mode="on_disk", compression="32x"), "faiss", 5.0),
    (dict(method="flat", compression="32x"), "faiss", 2.0),
    (dict(encoder="sq1"), "faiss", 2.0),
    (dict(compression="8x"), "faiss", None),
])
def test_default_oversampling(kw, engine, want):
    got = resolve_rescore(VectorSpec(64, **kw), engine=engine)
    assert (got.oversample if got else None) == want


def test_oversampling_of_wide_vectors_and_the_users_choice():
    wide = lambda c: resolve_rescore(VectorSpec(1024, mode="on_disk", compression=c)).oversample
    assert [wide(c) for c in ("8x", "16x", "32x", "64x")] == [2.0, 3.0, 3.0, 5.0]
    assert resolve_rescore(VectorSpec(64), False) is None
    assert resolve_rescore(VectorSpec(64), True).oversample == 1.0
    assert resolve_rescore(VectorSpec(64), 7).oversample == 7.0
    with pytest.raises(SpecError):
        resolve_rescore(VectorSpec(64), 101)


def test_first_pass():
    assert first_pass_k(10, 5) == 100 and first_pass_k(100, 2.5) == 250 and first_pass_k(9000, 3) == 27_000 and first_pass_k(9000, 3, most=10_000) == 10_000
    assert [first_pass_k(100, 9, by_dimension=d) for d in (100, 768, 1000)] == [300, 200, 100]


def test_limits_of_k_and_radius():
    for k in (0, 10_001, True, 1.5):
        with pytest.raises(SpecError):
            check_k(k)
    for args in (dict(), dict(max_distance=1, min_score=1), dict(max_distance=-1), dict(min_score=0), dict(min_score=1.5)):
        with pytest.raises(SpecError):
            check_radius("l2", **args)
    check_radius("innerproduct", max_distance=-1)
    check_radius("innerproduct", min_score=1.5)
    for args in (dict(encoder="binary"), dict(compression="8x")):
        with pytest.raises(SpecError):
            check_radius("l2", max_distance=1, **args)
    with pytest.raises(SpecError):
        check_radius("hamming", max_distance=1)
    check_radius("l2", max_distance=1, encoder="sq1", compression="32x")


def test_size_estimate():
    assert estimate_overhead_kb(VectorSpec(128, method="ivf", params={"nlist": 1024})) == 513
    assert estimate_overhead_kb(VectorSpec(128, encoder="pq")) == 129


def test_choice_rules():
    args = dict(filtered=True, threshold=None, built=True)
    assert choose(0, 10, **args)[0] == "empty"
    assert choose(10, 10, **args)[0] == "exact"
    # Without a threshold of the caller's, size decides nothing.
    assert choose(11, 10, **args)[0] == choose(1 << 40, 10, **args)[0] == "approximate"
    assert choose(500, 10, filtered=True, threshold=499, built=True)[0] == "approximate"
    assert choose(500, 10, filtered=True, threshold=500, built=True)[0] == "exact"
    assert choose(500, 10, filtered=False, threshold=None, built=True)[0] == "approximate"
    assert choose(500, 10, filtered=False, threshold=None, built=False)[0] == "exact"
