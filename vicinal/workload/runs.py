"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator or variant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vicinal.functions import scores as S
from vicinal.functions import vectors as V
from vicinal.operators import encoders as E
from vicinal.operators import evaluate as A
from vicinal.operators import training as Q
from vicinal.operators.approx import Index, assign_lists, radius_approx
from vicinal.operators.knn import combine_knn, knn, knn_join, page, radius_join, rescore, score_all
from vicinal.operators.nested import explode_children, nested_knn, nested_radius
from vicinal.operators.rerank import late_interaction, late_interaction_join, mmr, resolve_vector_path
from vicinal.plans.limits import scratch_dir
from vicinal.sources import index as X
from vicinal.sources import models as M
from vicinal.sources import vectors as I
from vicinal.spec import VectorSpec
from vicinal.streaming import tables as T
from vicinal.workload.tables import (DIM, binary_corpus, binary_ivf_model, bit_model, byte_vectors, child_rows, children, corpus, flat, ivf_model,
                                     label_codebook, label_codes, label_means, mean_rows, queries, rounded, signed_bits, table, token_sets, wide_codebook)

REGISTRY = {}
FIXED_QUERY = [0.1 if i % 2 == 0 else -0.05 for i in range(DIM)]
SPEC = VectorSpec(DIM)


def run(name: str):
    def add(fn):
        REGISTRY[name] = fn
        return fn

    return add


def ranked(df: DataFrame) -> DataFrame:
    return rounded(df, "distance", "score")


# --- ingest ---------------------------------------------------------------------------------------------------

@run("i01_vector_scan")
def _(spark, d):
    return flat(I.read_vectors(spark, f"{d}/embeddings.parquet", SPEC, vec="embedding", columns=["vec_id"]), "vec_id", "embedding")


def _dirty(spark, d) -> DataFrame:
    v = F.col("embedding")
    bad = (F.when(F.col("label") == 0, F.transform(v, lambda x, i: F.when(i == 3, F.lit(float("nan")).cast("float")).otherwise(x)))
           .when(F.col("label") == 1, F.slice(v, 1, 63))
           .when(F.col("label") == 2, F.transform(v, lambda x: F.lit(0.0).cast("float")))
           .when(F.col("label") == 3, F.transform(v, lambda x, i: F.when(i == 5, F.lit(float("inf")).cast("float")).otherwise(x)))
           .when(F.col("label") == 4, F.lit(None).cast("array<float>")).otherwise(v))
    return table(spark, d, "embeddings").select("vec_id", "label", bad.alias("vec"))


@run("i02_validate_vectors")
def _(spark, d):
    good, bad = I.validate_vectors(_dirty(spark, d), VectorSpec(DIM, space="cosinesimil"), on_error="quarantine")
    return good.select("vec_id", "label", F.lit("ok").alias("problem")).unionByName(bad.select("vec_id", "label", "problem"))


@run("i02_validate_bytes")
def _(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: F.round(x.cast("double") * 400)).alias("vec"))
    good, bad = I.validate_vectors(e, VectorSpec(DIM, "byte"), on_error="quarantine")
    return good.select("vec_id", F.lit("ok").alias("problem")).unionByName(bad.select("vec_id", "problem"))


@run("i03_decode_arrays")
def _(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    return flat(I.decode_vectors(e, "embedding", SPEC), "vec_id", "embedding")


@run("i03_decode_numbers")
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.round("o_totalprice", 0).alias("vec"))
    return flat(I.decode_vectors(o, "vec", VectorSpec(1)), "o_orderkey", "vec")


@run("i03_decode_base64")
def _(spark, d):
    text = I.encode_vectors(table(spark, d, "embeddings").select("vec_id", "embedding"), "embedding")
    return flat(I.decode_vectors(text, "embedding", SPEC), "vec_id", "embedding")


@run("i04_encode_base64")
def _(spark, d):
    text = I.encode_vectors(table(spark, d, "embeddings").select("vec_id", "embedding"), "embedding")
    return text.select("vec_id", F.length("embedding").alias("n_chars"), F.octet_length(F.unbase64("embedding")).alias("n_bytes"))


@run("i05_normalize")
def _(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", byte_vectors("embedding").alias("b"))
    return flat(e.select("vec_id", V.l2_normalize(F.col("b").cast("array<float>")).alias("vec")), "vec_id", "vec")


@run("i06_select_fields")
def _(spark, d):
    return I.select_fields(table(spark, d, "embeddings"), includes=["*"], excludes=["embed*"])


@run("i07_exists_filter")
def _(spark, d):
    return _dirty(spark, d).where(V.has_vector("vec")).select("vec_id", "label")


@run("i08_explode_children")
def _(spark, d):
    rows = explode_children(children(spark, d), "id", "children")
    return rows.select("parent_id", "child_pos", "label", F.round(F.col("vec")[0].cast("double"), 6).alias("first_value"))


@run("i09_write_index")
def _(spark, d):
    index = X.write_index(corpus(spark, d), ivf_model(spark, d), scratch_dir(spark, "index"))
    return index.df.groupBy("list_id").agg(F.count("*").alias("row_count"), F.sum("id").alias("id_sum"))


@run("i10_small_table_stays_plain")
def _(spark, d):
    index = X.write_index(corpus(spark, d), ivf_model(spark, d), scratch_dir(spark, "plain"), plain=True)
    return ranked(knn_join(queries(spark, d), index, 5, mode="auto"))


def _changes(spark, d):
    c = corpus(spark, d)
    upserts = c.where("label = 1").withColumn("vec", F.transform("vec", lambda x: -x))
    return upserts, c.where("label = 0").select("id")


@run("i11_apply_changes")
def _(spark, d):
    path = scratch_dir(spark, "changes")
    X.write_index(corpus(spark, d), ivf_model(spark, d), path)
    index = X.apply_changes(spark, path, *_changes(spark, d))
    return ranked(knn_join(queries(spark, d), index.df, 5))


@run("i12_compact_index")
def _(spark, d):
    path = scratch_dir(spark, "parts")
    X.write_index(corpus(spark, d), bit_model(spark, d), path)
    X.apply_changes(spark, path, *_changes(spark, d))
    index = X.compact_index(spark, path, scratch_dir(spark, "whole"))
    ones = F.aggregate(I.unpacked_bits("code"), F.lit(0), lambda s, b: s + F.bit_count(b.cast("int").bitwiseAND(F.lit(255))))
    return index.df.select("id", "label", ones.alias("set_bits"))


# --- functions ------------------------------------------------------------------------------------------------

def _pairs(spark, d) -> DataFrame:
    return table(spark, d, "embeddings").select("vec_id", "embedding", F.reverse("embedding").alias("other"))


def _value(name, build):
    @run(name)
    def _(spark, d):
        return _pairs(spark, d).select("vec_id", F.round(build(), 6).alias("value"))


_value("f01_l2_squared", lambda: V.l2_squared("embedding", "other"))
_value("f02_l1_norm", lambda: V.l1_norm("embedding", "other"))
_value("f03_linf_norm", lambda: V.linf_norm("embedding", "other"))
_value("f04_inner_product", lambda: V.inner_product("embedding", "other"))
_value("f05_cosine_similarity", lambda: V.cosine_similarity("embedding", "other"))
_value("f06_cosine_known_norm", lambda: V.cosine_similarity("embedding", "other", V.magnitude_squared("embedding")))
_value("f07_magnitude_squared", lambda: V.magnitude_squared("embedding"))
_value("f17_element_access", lambda: F.element_at("embedding", 7).cast("double"))


@run("f01_l2_squared_bytes")
def _(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", byte_vectors("embedding").alias("a"))
    return e.select("vec_id", V.l2_squared("a", F.reverse("a")).alias("value"))


@run("f01_sql_functions")
def _(spark, d):
    V.register_sql_functions(spark)
    pairs = _pairs(spark, d)
    return pairs.select("vec_id", *[F.round(F.expr(f"{n}(embedding, other)"), 6).alias(n) for n in
                                    ("l2_squared", "l1_norm", "linf_norm", "inner_product", "cosine_similarity")])


@run("f08_hamming_bytes")
def _(spark, d):
    e = _pairs(spark, d).select("vec_id", signed_bits("embedding").alias("a"), signed_bits("other").alias("b"))
    return e.select("vec_id", V.hamming("a", "b").alias("value"),
                    V.hamming_bytes(I.unpacked_bits("a"), I.unpacked_bits("b")).alias("value_signed"))


@run("f09_hamming_long")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", V.hamming_long("o_orderkey", "o_custkey").alias("value"))


@run("f10_hamming_base64")
def _(spark, d):
    e = _pairs(spark, d).select("vec_id", F.base64(signed_bits("embedding")).alias("a"),
                                F.base64(F.substring(signed_bits("other"), 1, 6)).alias("b"))
    return e.select("vec_id", V.hamming_base64("a", "b").alias("value"))


def _codes(spark, d):
    return _pairs(spark, d).select("vec_id", "embedding", signed_bits("other").alias("code"))


@run("f11_l2_squared_adc")
def _(spark, d):
    return _codes(spark, d).select("vec_id", F.round(V.l2_squared_adc("embedding", "code"), 6).alias("value"))


@run("f12_inner_product_adc")
def _(spark, d):
    return _codes(spark, d).select("vec_id", F.round(V.inner_product_adc("embedding", "code"), 6).alias("value"))


@run("f13_score_with_adc")
def _(spark, d):
    c = _codes(spark, d)
    return c.select("vec_id", *[F.round(V.score_with_adc("embedding", "code", s), 6).alias(s)
                                for s in ("l2", "innerproduct", "cosinesimil")])


@run("f14_to_score")
def _(spark, d):
    return _pairs(spark, d).select("vec_id", *[F.round(S.to_score(V.raw_distance("embedding", "other", s), s), 6).alias(s)
                                               for s in ("l2", "l1", "linf", "cosinesimil", "innerproduct")])


@run("f15_thresholds")
def _(spark, d):
    c = table(spark, d, "orders").select("o_orderkey", ((F.col("o_orderkey") % 97 + 1) / 50.0).alias("s"))
    return c.select("o_orderkey", *[F.round(S.score_to_threshold("s", n), 6).alias(n) for n in ("l2", "cosinesimil", "innerproduct")],
                    F.round(S.distance_to_threshold("s", "innerproduct"), 6).alias("ip_distance"))


@run("f16_zero_vector")
def _(spark, d):
    return _dirty(spark, d).where(V.has_vector("vec")).select("vec_id", V.is_zero_vector("vec").alias("is_zero"))


@run("f18_ip_score_to_cosine")
def _(spark, d):
    p = _pairs(spark, d).select("vec_id", S.to_score(-V.inner_product("embedding", "other"), "innerproduct").alias("s"))
    return p.select("vec_id", F.round(S.ip_score_to_cosine_score("s"), 6).alias("value"))


# --- search ---------------------------------------------------------------------------------------------------

def _knn(name, space):
    @run(name)
    def _(spark, d):
        return ranked(knn_join(queries(spark, d), corpus(spark, d), 10, space))


for _s in ("l2", "cosinesimil", "innerproduct", "l1", "linf"):
    _knn(f"s01_knn_join_{_s}", _s)


@run("s02_single_query")
def _(spark, d):
    return ranked(knn(corpus(spark, d), FIXED_QUERY, 25, "l2", keep=["label"]))


@run("s03_scored_scan")
def _(spark, d):
    c = corpus(spark, d).select(F.col("id").alias("vec_id"), "label", F.when(F.col("label") != 4, F.col("vec")).alias("vec"))
    return score_all(c, FIXED_QUERY, "cosinesimil", filter="label <> 6").select("vec_id", "label", F.round("score", 6).alias("score"))


@run("s03_scored_scan_bytes")
def _(spark, d):
    c = table(spark, d, "embeddings").select("vec_id", byte_vectors("embedding").alias("vec"))
    return score_all(c, [1 + i % 3 for i in range(DIM)], "cosinesimil").select("vec_id", F.round("score", 6).alias("score"))


@run("s04_hamming_scan_long")
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("code"))
    return score_all(o, 170, "hammingbit", vec="code").select("o_orderkey", F.round("score", 6).alias("score"))


@run("s04_hamming_scan_base64")
def _(spark, d):
    e = _pairs(spark, d).select("vec_id", F.base64(signed_bits("embedding")).alias("code"))
    return score_all(e, "D/8=", "hammingbit", vec="code").select("vec_id", F.round("score", 6).alias("score"))


@run("s05_radius_distance")
def _(spark, d):
    return ranked(radius_join(queries(spark, d), corpus(spark, d), max_distance=1.4))


@run("s05_radius_inner_product")
def _(spark, d):
    return ranked(radius_join(queries(spark, d), corpus(spark, d), max_distance=-0.25, space="innerproduct"))


@run("s06_radius_score")
def _(spark, d):
    return ranked(radius_join(queries(spark, d), corpus(spark, d), min_score=0.63, space="cosinesimil"))


@run("s06_radius_score_per_query")
def _(spark, d):
    q = queries(spark, d, (F.lit(0.4) + F.col("label") / 100).alias("least"))
    return ranked(radius_join(q, corpus(spark, d), min_score="least"))


@run("s07_radius_capped")
def _(spark, d):
    return ranked(radius_join(queries(spark, d), corpus(spark, d), max_distance=1.7, max_results=4))


@run("s08_prefiltered_knn")
def _(spark, d):
    return ranked(knn_join(queries(spark, d), corpus(spark, d), 5, filter="label = 3", keep=["label"]))


@run("s09_per_query_filter")
def _(spark, d):
    q = queries(spark, d, F.col("label").alias("want"))
    return ranked(knn_join(q, corpus(spark, d), 5, on=[("want", "label")], keep=["label"]))


@run("s09_per_query_filter_ivf")
def _(spark, d):
    q = queries(spark, d, F.col("label").alias("want"))
    return ranked(knn_join(q, _index(spark, d, ivf_model(spark, d)), 5, mode="ivf", nprobes=2, on=[("want", "!=", "label")]))


@run("s09_per_query_filter_codes")
def _(spark, d):
    index = _index(spark, d, bit_model(spark, d))
    return ranked(knn_join(queries(spark, d), index, 10, mode="binary", rescore=False, on=[("query_id", "!=", "id")]))


@run("s17_expand_per_query_filter")
def _(spark, d):
    q = queries(spark, d, F.col("label").alias("want"))
    return ranked(nested_knn(q, child_rows(spark, d), 3, expand=True, on=[("want", "!=", "label")]))


@run("s09_per_query_range")
def _(spark, d):
    q = queries(spark, d, F.col("label").alias("low"))
    return ranked(knn_join(q, corpus(spark, d), 5, "innerproduct", on=[("low", "<=", "label"), ("query_id", "!=", "id")]))


@run("s10_postfiltered_knn")
def _(spark, d):
    return ranked(knn_join(queries(spark, d), corpus(spark, d), 20, keep=["label"]).where("label = 3"))


def _index(spark, d, model) -> Index:
    return Index(model.encode(corpus(spark, d)), model)


@run("s11_ivf_search")
def _(spark, d):
    index = X.write_index(corpus(spark, d), ivf_model(spark, d), scratch_dir(spark, "ivf"))
    return ranked(knn_join(queries(spark, d), index, 10, mode="ivf", nprobes=2))


def _binary_queries(spark, d) -> DataFrame:
    return queries(spark, d).select("query_id", signed_bits("query_vec").alias("query_vec"))


@run("s11_ivf_search_binary")
def _(spark, d):
    index = X.write_index(binary_corpus(spark, d), binary_ivf_model(spark, d), scratch_dir(spark, "binary-ivf"))
    return ranked(knn_join(_binary_queries(spark, d), index, 10, "hamming", mode="ivf", nprobes=2))


@run("s11_ivf_search_cosine")
def _(spark, d):
    return ranked(knn_join(queries(spark, d), _index(spark, d, ivf_model(spark, d, "cosinesimil")), 10, "cosinesimil",
                           mode="ivf", nprobes=3))


@run("s12_binary_scan")
def _(spark, d):
    return ranked(knn_join(queries(spark, d), _index(spark, d, bit_model(spark, d)), 10, mode="binary", rescore=False))


@run("s12_binary_scan_2bit")
def _(spark, d):
    return ranked(knn_join(queries(spark, d), _index(spark, d, bit_model(spark, d, 2)), 10, mode="binary", rescore=False))


@run("s12_binary_scan_4bit")
def _(spark, d):
    return ranked(knn_join(queries(spark, d), _index(spark, d, bit_model(spark, d, 4)), 10, mode="binary", rescore=False))


@run("s12_adc_scan")
def _(spark, d):
    return ranked(knn_join(queries(spark, d), _index(spark, d, bit_model(spark, d)), 10, mode="adc", rescore=False))


@run("s12_adc_scan_inner_product")
def _(spark, d):
    model = bit_model(spark, d, space="innerproduct")
    return ranked(knn_join(queries(spark, d), _index(spark, d, model), 10, "innerproduct", mode="adc", rescore=False))


def _pq_model(spark, d, method="exact", lists=None):
    spec = VectorSpec(DIM, method=method, encoder="pq", params={"m": 8})
    return M.Model(spec, label_codebook(spark, d), lists)


@run("s12_pq_scan")
def _(spark, d):
    return ranked(knn_join(queries(spark, d), _index(spark, d, _pq_model(spark, d)), 10, mode="pq"))


@run("s12_pq_scan_12bit")
def _(spark, d):
    model = M.Model(VectorSpec(DIM, encoder="pq", params={"m": 8, "code_size": 12}), wide_codebook(spark, d))
    return ranked(knn_join(queries(spark, d), _index(spark, d, model), 10, mode="pq"))


@run("s13_two_phase")
def _(spark, d):
    return ranked(knn_join(queries(spark, d), _index(spark, d, bit_model(spark, d)), 10, mode="binary", rescore=12))


@run("s13_two_phase_adc")
def _(spark, d):
    return ranked(knn_join(queries(spark, d), _index(spark, d, bit_model(spark, d)), 10, mode="adc", rescore=True))


@run("s13_two_phase_ivf_pq")
def _(spark, d):
    model = _pq_model(spark, d, "ivf", label_means(spark, d))
    return ranked(knn_join(queries(spark, d), _index(spark, d, model), 10, mode="ivf", nprobes=3, rescore=True))


def _sq1_model(spark, d, space="l2", method="exact"):
    spec = VectorSpec(DIM, space=space, method=method, encoder="sq1", compression="32x")
    return M.Model(spec, Q.fit_sq1(corpus(spark, d), space))


@run("s15_two_phase_radius")
def _(spark, d):
    index = _index(spark, d, _sq1_model(spark, d))
    return ranked(radius_approx(queries(spark, d), index, max_distance=1.4))


@run("s15_two_phase_radius_cosine")
def _(spark, d):
    index = _index(spark, d, _sq1_model(spark, d, "cosinesimil"))
    return ranked(radius_approx(queries(spark, d), index, min_score=0.63, space="cosinesimil"))


@run("s15_two_phase_radius_on")
def _(spark, d):
    q = queries(spark, d, F.col("label").alias("want"), (F.lit(1.2) + F.col("label") / 100).alias("reach"))
    return ranked(radius_approx(q, _index(spark, d, _sq1_model(spark, d, "l2")), max_distance="reach", on=[("want", "!=", "label")], keep=["label"]))


@run("s16_nested_knn")
def _(spark, d):
    return ranked(nested_knn(queries(spark, d), child_rows(spark, d), 5))


@run("s16_nested_knn_ivf")
def _(spark, d):
    model = ivf_model(spark, d)
    index = Index(model.encode(child_rows(spark, d)), model)
    return ranked(nested_knn(queries(spark, d), index, 5, mode="ivf", nprobes=3))


@run("s19_nested_radius_on")
def _(spark, d):
    q = queries(spark, d, F.col("label").alias("want"), (F.lit(1.3) + F.col("label") / 100).alias("reach"))
    return ranked(nested_radius(q, child_rows(spark, d), max_distance="reach", on=[("want", "!=", "label")], keep=["label"]))


@run("s17_expand_nested")
def _(spark, d):
    return ranked(nested_knn(queries(spark, d), child_rows(spark, d), 3, expand=True, child_filter="label <> 2"))


@run("s18_nested_child_filter")
def _(spark, d):
    return ranked(nested_knn(queries(spark, d), child_rows(spark, d), 5, child_filter="label = 3"))


@run("s18_nested_parent_filter")
def _(spark, d):
    parents = children(spark, d).where(F.exists("children", lambda c: c["label"] == 7)).select(F.col("id").alias("parent_id"))
    return ranked(nested_knn(queries(spark, d), child_rows(spark, d), 5, parent_filter=parents))


@run("s19_nested_radius")
def _(spark, d):
    return ranked(nested_radius(queries(spark, d), child_rows(spark, d), max_distance=1.4))


@run("s19_nested_rescore")
def _(spark, d):
    model = bit_model(spark, d)
    index = Index(model.encode(child_rows(spark, d)), model)
    return ranked(nested_knn(queries(spark, d), index, 5, mode="binary", rescore=2))


@run("s20_boost")
def _(spark, d):
    return ranked(knn_join(queries(spark, d), corpus(spark, d), 5, boost=2.5))


@run("s22_several_tables")
def _(spark, d):
    c = corpus(spark, d)
    return ranked(knn_join(queries(spark, d), [c.where("label < 4"), c.where("label between 4 and 6"), c.where("label > 6")], 10))


@run("s23_auto_exact")
def _(spark, d):
    index = _index(spark, d, ivf_model(spark, d))
    hits = knn_join(queries(spark, d), index, 5, mode="auto", filter="label = 3", threshold=1 << 62, explain=True)
    return ranked(hits).select("query_id", "id", "rank", "distance", "score", F.col("explain.search_type").alias("search_type"))


@run("s24_auto_fallback")
def _(spark, d):
    index = _index(spark, d, ivf_model(spark, d))
    hits = knn_join(queries(spark, d), index, 52, mode="auto", nprobes=1, explain=True)
    return ranked(hits).select("query_id", "id", "rank", "distance", "score", F.col("explain.search_type").alias("search_type"))


@run("s24_fill_exact")
def _(spark, d):
    index = _index(spark, d, ivf_model(spark, d))
    return ranked(knn_join(queries(spark, d), index, 52, mode="ivf", nprobes=1, fill="exact")).select("query_id", "id", "rank", "distance", "score")


@run("s25_binary_vectors")
def _(spark, d):
    c = corpus(spark, d).select("id", signed_bits("vec").alias("vec"))
    q = queries(spark, d).select("query_id", signed_bits("query_vec").alias("query_vec"))
    return ranked(knn_join(q, c, 10, "hamming"))


@run("s26_byte_vectors")
def _(spark, d):
    c = corpus(spark, d).select("id", byte_vectors("vec").alias("vec"))
    q = queries(spark, d).select("query_id", byte_vectors("query_vec").alias("query_vec"))
    return ranked(knn_join(q, c, 10, "l2"))


@run("s27_explain")
def _(spark, d):
    hits = knn_join(queries(spark, d), corpus(spark, d), 5, "innerproduct", filter="label < 5", explain=True)
    x = F.col("explain")
    return hits.select("query_id", "id", x.search_type.alias("search_type"), F.round(x.raw, 6).alias("raw"),
                       x.cardinality.alias("cardinality"), x.formula.alias("formula"))


@run("s28_named_score")
def _(spark, d):
    return _pairs(spark, d).select("vec_id", F.round(1 + V.cosine_similarity("embedding", "other"), 6).alias("similarity"))


@run("s29_candidate_depth")
def _(spark, d):
    # The depth counts where codes propose: 130 candidates of each query by 1-bit codes, the best 5 of them by distance.
    return ranked(knn_join(queries(spark, d), _index(spark, d, bit_model(spark, d)), 5, mode="binary", candidates=130, rescore=1))


@run("s30_combined_clauses")
def _(spark, d):
    c = corpus(spark, d)
    q = queries(spark, d)
    back = q.withColumn("query_vec", F.reverse("query_vec"))
    return combine_knn([knn_join(q, c, 10), knn_join(back, c, 10)], 10).withColumn("score", F.round("score", 6))


@run("s31_paging")
def _(spark, d):
    return ranked(page(knn_join(queries(spark, d), corpus(spark, d), 20), 5, 5))


@run("s32_flat_compressed")
def _(spark, d):
    return ranked(knn_join(queries(spark, d), _index(spark, d, _sq1_model(spark, d, method="flat")), 10, mode="flat"))


# --- re-ranking -----------------------------------------------------------------------------------------------

def _hits(spark, d, n, space="l2"):
    return knn_join(queries(spark, d), corpus(spark, d), n, space, keep=["vec", "label"])


@run("r01_mmr")
def _(spark, d):
    picked = mmr(_hits(spark, d, 9), size=3, diversity=0.6, candidates=9)
    return picked.select("query_id", "id", "mmr_rank", F.round("score", 6).alias("score"))


@run("r01_mmr_by_id")
def _(spark, d):
    c = corpus(spark, d)
    picked = mmr(knn_join(queries(spark, d), c, 9), size=3, diversity=0.6, candidates=9, source=c)
    return picked.select("query_id", "id", "mmr_rank", F.round("score", 6).alias("score"))


@run("r02_mmr_explain")
def _(spark, d):
    picked = mmr(_hits(spark, d, 9), size=3, diversity=0.6, candidates=9, explain=True)
    x = F.col("explain")
    return picked.select("query_id", "id", "mmr_rank", F.round(x.original_score, 6).alias("original_score"),
                         F.round(x.max_similarity_to_selected, 6).alias("max_similarity"), F.round(x.mmr_score, 6).alias("mmr_score"))


@run("r03_mmr_vector_path")
def _(spark, d):
    hits = _hits(spark, d, 9).withColumn("doc", F.struct(F.struct("vec").alias("body"))).drop("vec")
    resolve_vector_path([hits, hits], "doc.body.vec", ["l2", "l2"])
    return mmr(hits, size=3, diversity=0.6, vector_path="doc.body.vec").select("query_id", "id", "mmr_rank")


@run("r04_late_interaction")
def _(spark, d):
    q, docs = token_sets(spark, d, "query_id", "query_vecs"), token_sets(spark, d, "id", "vecs")
    return late_interaction_join(q, docs, 5, "l2").withColumn("score", F.round("score", 6))


@run("r04_late_interaction_inner_product")
def _(spark, d):
    q, docs = token_sets(spark, d, "query_id", "query_vecs"), token_sets(spark, d, "id", "vecs")
    return late_interaction_join(q, docs, 5, "innerproduct").withColumn("score", F.round("score", 6))


@run("r04_late_interaction_scored")
def _(spark, d):
    docs = token_sets(spark, d, "id", "vecs")
    score = late_interaction([FIXED_QUERY, FIXED_QUERY[::-1]], "vecs", "cosinesimil")
    return docs.select("id", F.round(score, 6).alias("score"))


@run("r05_rescore_hits")
def _(spark, d):
    q, c = queries(spark, d), corpus(spark, d)
    return ranked(rescore(knn_join(q, c, 30, "linf"), q, c, 5, "l2"))


@run("r06_mmr_projection")
def _(spark, d):
    return mmr(_hits(spark, d, 9), size=3, diversity=0.6).select("query_id", "id", "label", "mmr_rank")


# --- quantization and training --------------------------------------------------------------------------------

def _thresholds(spark, state) -> DataFrame:
    rows = [(p, j, float(t)) for p, plane in enumerate(state.thresholds) for j, t in enumerate(plane)]
    return spark.createDataFrame(rows, "plane int, dim int, threshold double")


def _fit_bits(bits):
    @run(f"q01_fit_{bits}bit")
    def _(spark, d):
        return rounded(_thresholds(spark, Q.fit_scalar_quantizer(corpus(spark, d), bits, sample=None)), "threshold")


for _b in (1, 2, 4):
    _fit_bits(_b)


@run("q01_side_means")
def _(spark, d):
    s = Q.fit_scalar_quantizer(corpus(spark, d), 1, sample=None)
    rows = [(j, float(b), float(a)) for j, (b, a) in enumerate(zip(s.below, s.above))]
    return rounded(spark.createDataFrame(rows, "dim int, below double, above double"), "below", "above")


@run("q02_encode_bits")
def _(spark, d):
    coded = bit_model(spark, d, 2).encode(corpus(spark, d))
    return coded.select("id", F.posexplode(I.unpacked_bits("code")).alias("pos", "b")).select("id", "pos", F.col("b").cast("int").alias("byte"))


@run("q03_sample")
def _(spark, d):
    some = Q.sample_vectors(corpus(spark, d), 200)
    return some.agg(F.count("*").alias("n"), F.count_distinct("id").alias("n_ids"))


@run("q04_rotation_structured")
def _(spark, d):
    # Lengths and inner products of neighbours in id order, under the transform that needs no matrix.
    turned = corpus(spark, d).select("id", E.rotate("vec", E.structured_rotation(DIM)).alias("vec"))
    pair = turned.alias("a").join(turned.alias("b"), F.col("b.id") == F.col("a.id") + 1)
    product = V.inner_product("a.vec", "b.vec")
    return pair.select(F.col("a.id").alias("id"), F.round(V.magnitude_squared("a.vec"), 5).alias("size"),
                       F.when(F.abs(product) < 5e-6, 0.0).otherwise(F.round(product, 5)).alias("product"))


@run("q04_rotation")
def _(spark, d):
    # A rotation keeps norms, so the result can be checked without the matrix.
    turned = corpus(spark, d).select("id", "vec", E.rotate("vec", E.random_rotation(DIM)).alias("turned"))
    return turned.select("id", F.size("turned").alias("dim"), F.round(V.magnitude_squared("turned"), 5).alias("norm_sq"),
                         (V.l2_squared("vec", "turned") > 0.01).alias("moved"))


def _adc(space):
    @run(f"q05_adc_transform_{space}")
    def _(spark, d):
        state = Q.fit_scalar_quantizer(corpus(spark, d), 1, sample=None)
        return flat(corpus(spark, d).select("id", E.adc_column(state, "vec", space).alias("vec")), "id", "vec")


_adc("l2")
_adc("innerproduct")


@run("q06_fp16_clip")
def _(spark, d):
    e = corpus(spark, d).select("id", F.transform("vec", lambda x: x.cast("double") * 500000).alias("vec"))
    return flat(e.select("id", E.clip_fp16("vec").alias("vec")), "id", "vec")


@run("q06_fp16_encode")
def _(spark, d):
    model = M.Model(VectorSpec(DIM, encoder="fp16"), E.Fp16())
    coded = model.encode(corpus(spark, d))
    back = coded.select("id", F.octet_length("code").alias("n_bytes"), V.linf_norm("vec", model.encoder.decoded("code")).alias("e"))
    return back.select("id", "n_bytes", (F.col("e") < 0.0005).alias("close"))


@run("q07_to_byte")
def _(spark, d):
    e = corpus(spark, d).select("id", F.transform("vec", lambda x: F.round(x.cast("double") * 127)).alias("vec"))
    return e.select("id", F.posexplode(E.to_byte("vec")).alias("pos", "b")).select("id", "pos", F.col("b").cast("int").alias("value"))


@run("q08_sq7_full_range")
def _(spark, d):
    state = Q.fit_sq7(corpus(spark, d), 1.0, sample=None)
    coded = corpus(spark, d).select("id", state.column("vec").alias("code"))
    return coded.select("id", F.posexplode(I.unpacked_bits("code")).alias("pos", "b")).select("id", "pos", F.col("b").cast("int").alias("level"))


@run("q08_sq7_search")
def _(spark, d):
    spec = VectorSpec(DIM, encoder="sq7", compression="4x")
    index = _index(spark, d, M.Model(spec, Q.fit_sq7(corpus(spark, d), 1.0, sample=None)))
    return ranked(knn_join(queries(spark, d), index, 10, mode="sq7"))


@run("q09_sq1_search")
def _(spark, d):
    index = _index(spark, d, _sq1_model(spark, d, "cosinesimil"))
    return ranked(knn_join(queries(spark, d), index, 10, "cosinesimil", mode="sq1"))


@run("q09_sq1_estimate")
def _(spark, d):
    index = _index(spark, d, _sq1_model(spark, d, "cosinesimil"))
    return ranked(knn_join(queries(spark, d), index, 10, "cosinesimil", mode="sq1", rescore=False))


def _centroid_rows(spark, table_) -> DataFrame:
    rows = [(s, j, p, float(x)) for s, sub in enumerate(table_) for j, c in enumerate(sub) for p, x in enumerate(c)]
    return rounded(spark.createDataFrame(rows, "sub int, centroid int, pos int, value double"), "value")


@run("q10_pq_train")
def _(spark, d):
    start = label_codebook(spark, d).codebook
    return _centroid_rows(spark, Q.fit_pq(corpus(spark, d), 8, init=start, iterations=1).codebook)


@run("q11_pq_encode")
def _(spark, d):
    coded = corpus(spark, d).select("id", label_codebook(spark, d).column("vec").alias("code"))
    return coded.select("id", F.posexplode(I.unpacked_bits("code")).alias("sub", "b")).select("id", "sub", F.col("b").cast("int").alias("centroid"))


@run("q11_pq_encode_12bit")
def _(spark, d):
    coded = corpus(spark, d).select("id", F.hex(wide_codebook(spark, d).column("vec")).alias("code"))
    sub = F.explode(F.sequence(F.lit(0), F.lit(7))).alias("sub")
    return coded.select("id", sub, "code").select("id", "sub", F.conv(F.substring("code", F.col("sub") * 4 + 1, F.lit(4)), 16, 10).cast("int").alias("centroid"))


@run("q12_ivf_train")
def _(spark, d):
    means = label_means(spark, d)
    return _centroid_rows(spark, Q.fit_ivf(corpus(spark, d), len(means), init=means, iterations=2)[None])


@run("q12_ivf_train_binary")
def _(spark, d):
    codes = Q.fit_ivf(binary_corpus(spark, d), 10, space="hamming", init=label_codes(spark, d), iterations=2)
    return spark.createDataFrame([(i, bytes(c).hex()) for i, c in enumerate(codes)], "centroid int, code string")


@run("q13_assign_lists_binary")
def _(spark, d):
    return assign_lists(binary_corpus(spark, d), label_codes(spark, d), "hamming").select("id", "list_id")


@run("q13_assign_lists")
def _(spark, d):
    return assign_lists(corpus(spark, d), label_means(spark, d)).select("id", "list_id")


# --- models ---------------------------------------------------------------------------------------------------

@run("m01_train_model")
def _(spark, d):
    path = scratch_dir(spark, "models")
    start = label_means(spark, d)
    spec = VectorSpec(DIM, method="ivf", params={"nlist": len(start), "nprobes": 2})
    M.train_model(corpus(spark, d), "coarse", spec, path, iterations=2, init_lists=start)
    return ranked(knn_join(queries(spark, d), _index(spark, d, M.load_model(spark, path, "coarse")), 5, mode="ivf"))


@run("m02_train_on_codes")
def _(spark, d):
    # One round of k-means over the bits of 1-bit codes, from the label means of those bits.
    path = scratch_dir(spark, "models")
    c = corpus(spark, d)
    quantizer = Q.fit_scalar_quantizer(c, 1)
    start = mean_rows(c.select("label", quantizer.decoded(quantizer.column("vec")).alias("vec")), "label", "vec")
    spec = VectorSpec(DIM, method="ivf", params={"nlist": len(start)})
    model = M.train_model(c, "bits", spec, path, quantize_bits=1, iterations=1, init_lists=start)
    return _centroid_rows(spark, model.centroids[None])


@run("m03_model_table")
def _(spark, d):
    path = scratch_dir(spark, "models")
    c = corpus(spark, d)
    for name, nlist in (("a", 2), ("b", 3), ("c", 4)):
        M.train_model(c, name, VectorSpec(DIM, method="ivf", params={"nlist": nlist}), path, iterations=1)
    M.drop_model(spark, path, "b")
    return M.models(spark, path).where("state = 'created'").select("model_id", "state", "dimension", "space", "method")


@run("m05_index_from_model")
def _(spark, d):
    path = scratch_dir(spark, "models")
    model = ivf_model(spark, d)
    M.save_model(spark, path, model, "fixed")
    index = X.write_index(corpus(spark, d), M.load_model(spark, path, "fixed"), scratch_dir(spark, "built"))
    return ranked(knn_join(queries(spark, d), index, 10, mode="ivf", nprobes=1))


# --- aggregation and evaluation -------------------------------------------------------------------------------

@run("a01_aggregate_hits")
def _(spark, d):
    hits = knn_join(queries(spark, d), corpus(spark, d), 10, keep=["label"])
    return hits.groupBy("label").agg(F.count("*").alias("n"), F.count_distinct("query_id").alias("n_queries"),
                                     F.round(F.avg("score"), 6).alias("avg_score"))


@run("a02_vector_metric")
def _(spark, d):
    return corpus(spark, d).groupBy("label").agg(F.round(F.sum(F.element_at("vec", 1).cast("double")), 6).alias("total"),
                                                 F.round(F.max(V.linf_norm("vec", F.reverse("vec"))), 6).alias("widest"))


@run("a03_vector_stats")
def _(spark, d):
    return rounded(A.vector_stats(corpus(spark, d)), "mean", "std", "below", "above")


@run("a04_ground_truth")
def _(spark, d):
    return A.ground_truth(queries(spark, d), corpus(spark, d), 10).select("query_id", F.explode("ids").alias("id"))


@run("a05_recall")
def _(spark, d):
    q = queries(spark, d)
    hits = knn_join(q, _index(spark, d, ivf_model(spark, d)), 10, mode="ivf", nprobes=2)
    return rounded(A.recall_at_k(hits, A.ground_truth(q, corpus(spark, d), 10), 10), "recall")


@run("a06_search_metrics")
def _(spark, d):
    q, c = queries(spark, d, "label"), child_rows(spark, d)
    hits = nested_knn(q, c, 5, on=[("label", "label")])
    return A.search_metrics(q, c, hits, on=("label", "label"), parent="parent_id")


def _counts(hits: DataFrame) -> DataFrame:
    return hits.groupBy("query_id").agg(*[F.max(n).alias(n) for n in ("filtered_rows", "ann_count", "exact_count")], F.count("*").alias("returned"))


@run("a06_measured_exact")
def _(spark, d):
    q = queries(spark, d, F.col("label").alias("low"))
    return _counts(knn_join(q, corpus(spark, d), 5, filter="label <> 4", on=[("low", "<=", "label"), ("query_id", "!=", "id")], metrics=True))


@run("a06_measured_lists")
def _(spark, d):
    q = queries(spark, d, F.col("label").alias("want"))
    index = _index(spark, d, ivf_model(spark, d))
    return _counts(knn_join(q, index, 5, mode="ivf", nprobes=2, filter="label <> 4", on=[("want", "!=", "label")], metrics=True))


@run("a06_measured_two_phase")
def _(spark, d):
    model = _pq_model(spark, d, "ivf", label_means(spark, d))
    return _counts(knn_join(queries(spark, d), _index(spark, d, model), 10, mode="ivf", nprobes=3, rescore=True, metrics=True))


@run("a07_index_stats")
def _(spark, d):
    return rounded(X.index_stats(_index(spark, d, ivf_model(spark, d))), "share", "skew").drop("code_bytes")


# --- streaming ------------------------------------------------------------------------------------------------

def _stream(spark, d) -> DataFrame:
    schema = table(spark, d, "embeddings").schema
    return spark.readStream.schema(schema).parquet(f"{d}/embeddings*.parquet")


@run("t01_stream_into_index")
def _(spark, d):
    path = scratch_dir(spark, "live")
    X.write_index(corpus(spark, d).where("label < 5"), ivf_model(spark, d), path)
    rows = _stream(spark, d).where("label >= 5").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label")
    T.stream_into_index(rows, path, scratch_dir(spark, "ckpt")).awaitTermination()
    return ranked(knn_join(queries(spark, d), X.open_index(spark, path), 10, mode="ivf", nprobes=2))


@run("t02_stream_queries")
def _(spark, d):
    out = scratch_dir(spark, "answers")
    q = _stream(spark, d).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    T.stream_knn(q, corpus(spark, d), 10, "l2", out, scratch_dir(spark, "ckpt")).awaitTermination()
    return ranked(spark.read.parquet(out).drop("batch"))


@run("t03_stream_changes")
def _(spark, d):
    path = scratch_dir(spark, "live")
    X.write_index(corpus(spark, d), ivf_model(spark, d), path)
    op = F.when(F.col("label") == 0, "delete").otherwise("upsert")
    turned = F.transform("embedding", lambda x: -x)
    rows = _stream(spark, d).where("label in (0, 1)").select(F.col("vec_id").alias("id"), turned.alias("vec"), "label", op.alias("op"),
                                                            F.col("vec_id").alias("ts"))
    T.stream_changes(rows, path, scratch_dir(spark, "ckpt")).awaitTermination()
    return ranked(knn_join(queries(spark, d), X.open_index(spark, path).df, 5))
