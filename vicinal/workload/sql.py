"""The registered queries as SQL for an independent engine, over the same whole tables."""

from __future__ import annotations

DIM = 64
ORACLES: dict[str, str] = {}

E = "e AS (SELECT vec_id, embedding::DOUBLE[] AS v, label FROM embeddings)"
LIT = "[" + ", ".join("0.1" if i % 2 == 0 else "-0.05" for i in range(DIM)) + "]::DOUBLE[]"
LIT_BACK = "[" + ", ".join("-0.05" if i % 2 == 0 else "0.1" for i in range(DIM)) + "]::DOUBLE[]"


def r(x: str) -> str:
    """Six decimals without a negative zero."""
    return f"(CASE WHEN abs({x}) < 5e-7 THEN 0.0 ELSE round({x}, 6) END)"


def l2(a, b):
    return f"pow(list_distance({a}, {b}), 2)"


def ip(a, b):
    return f"(-list_inner_product({a}, {b}))"


def cos(a, b):
    return f"(1 - list_cosine_similarity({a}, {b}))"


def l1(a, b):
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda s: abs(s[1] - s[2])))"


def linf(a, b):
    return f"list_max(list_transform(list_zip({a}, {b}), lambda s: abs(s[1] - s[2])))"


def ham(a, b):
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda s: CASE WHEN s[1] <> s[2] THEN 1 ELSE 0 END))::DOUBLE"


def inverse(d):
    return f"(1 / (1 + ({d})))"


def cos_score(d):
    return f"greatest((2 - ({d})) / 2, 0)"


def ip_score(d):
    return f"(CASE WHEN ({d}) >= 0 THEN 1 / (1 + ({d})) ELSE 1 - ({d}) END)"


def top(distance, score, k, *, ctes=(E,), q="e q", c="e c", where="TRUE", extra="", boost="", keep="", after="rk <= {k}",
        qid="q.vec_id", cid="c.vec_id"):
    """Rank all pairs and keep the first k of each query."""
    keep_d = "".join(f", c.{n}" for n in keep.split())
    keep_o = "".join(f", {n}" for n in keep.split())
    return (f"WITH {', '.join(ctes)}, d AS (SELECT {qid} AS query_id, {cid} AS id{keep_d}, {distance} AS distance "
            f"FROM {q}, {c} WHERE {where}), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rk FROM d) "
            f"SELECT query_id, id, CAST(rk AS INTEGER) AS rank, {r('distance')} AS distance, {r(score('distance') + boost)} AS score"
            f"{keep_o}{extra} FROM r WHERE {after.format(k=k)}")


def within(distance, score, test, *, ctes=(E,), where="TRUE"):
    return (f"WITH {', '.join(ctes)}, d AS (SELECT q.vec_id AS query_id, c.vec_id AS id, {distance} AS distance, q.label AS ql "
            f"FROM e q, e c WHERE {where}) SELECT query_id, id, {r('distance')} AS distance, {r(score('distance'))} AS score FROM d WHERE {test}")


def elements(source, id, vec):
    return (f"SELECT {id}, CAST(p AS INTEGER) - 1 AS pos, {r('x')} AS value FROM (SELECT {id}, unnest({vec}) AS x, "
            f"generate_subscripts({vec}, 1) AS p FROM {source})")


QC = ("q.v", "c.v")
ORACLES["i01_vector_scan"] = f"WITH {E} " + elements("e", "vec_id", "v")
ORACLES["i03_decode_arrays"] = ORACLES["i01_vector_scan"].replace("AS pos", "AS pos")
ORACLES["i03_decode_base64"] = ORACLES["i01_vector_scan"]
ORACLES["i01_vector_scan"] = ORACLES["i03_decode_arrays"] = ORACLES["i03_decode_base64"] = (
    f"WITH {E} SELECT vec_id, pos, value FROM ({elements('e', 'vec_id', 'v')})")
ORACLES["i03_decode_numbers"] = "SELECT o_orderkey, 0 AS pos, CAST(CAST(round(o_totalprice, 0) AS FLOAT) AS DOUBLE) AS value FROM orders"
ORACLES["i02_validate_vectors"] = (
    "SELECT vec_id, label, CASE label WHEN 0 THEN 'NaN' WHEN 1 THEN 'wrong dimension' WHEN 2 THEN 'zero vector' "
    "WHEN 3 THEN 'infinity' ELSE 'ok' END AS problem FROM embeddings")
ORACLES["i02_validate_bytes"] = (
    "SELECT vec_id, CASE WHEN list_max(list_transform(embedding, lambda x: abs(round(x::DOUBLE * 400) + 0.5))) > 127.6 "
    "THEN 'outside the byte range' ELSE 'ok' END AS problem FROM embeddings")
ORACLES["i04_encode_base64"] = (
    "SELECT vec_id, CAST(ceil(len(embedding) * 4 / 3.0) * 4 AS INTEGER) AS n_chars, CAST(len(embedding) * 4 AS INTEGER) AS n_bytes FROM embeddings")
ORACLES["i05_normalize"] = (
    "WITH b AS (SELECT vec_id, list_transform(embedding, lambda x: round(x::DOUBLE * 127)) AS w FROM embeddings), "
    "n AS (SELECT vec_id, list_transform(w, lambda x: x / sqrt(list_inner_product(w, w))) AS v FROM b) " + elements("n", "vec_id", "v"))
ORACLES["i06_select_fields"] = "SELECT vec_id, label FROM embeddings"
ORACLES["i07_exists_filter"] = "SELECT vec_id, label FROM embeddings WHERE label <> 4"
ORACLES["i08_explode_children"] = (
    "SELECT vec_id // 5 AS parent_id, CAST(vec_id % 5 AS INTEGER) AS child_pos, label, "
    f"{r('embedding[1]::DOUBLE')} AS first_value FROM embeddings")

# Mean vector of every label, as coarse centroids.
MEANS = ("m AS (SELECT label AS list_id, list(mx ORDER BY p) AS cv FROM (SELECT label, p, avg(x) AS mx FROM (SELECT label, unnest(v) AS x, "
         "generate_subscripts(v, 1) AS p FROM e) GROUP BY label, p) GROUP BY label)")


def near_list(metric, n, source="e", name="a"):
    return (f"{name} AS (SELECT vec_id, list_id, rn FROM (SELECT s.vec_id, m.list_id, row_number() OVER (PARTITION BY s.vec_id "
            f"ORDER BY {metric('s.v', 'm.cv')}, m.list_id) AS rn FROM {source} s, m) WHERE rn <= {n})")


ORACLES["i09_write_index"] = (
    f"WITH {E}, {MEANS}, {near_list(l2, 1)} SELECT list_id, count(*) AS row_count, CAST(sum(vec_id) AS BIGINT) AS id_sum FROM a GROUP BY list_id")
ORACLES["i10_small_table_stays_plain"] = top(l2(*QC), inverse, 5)
CHANGED = ("c AS (SELECT vec_id, CASE WHEN label = 1 THEN list_transform(embedding::DOUBLE[], lambda x: -x) ELSE embedding::DOUBLE[] END AS v, "
           "label FROM embeddings WHERE label <> 0)")
ORACLES["i11_apply_changes"] = top(l2(*QC), inverse, 5, ctes=(E, CHANGED), c="c")
ORACLES["t03_stream_changes"] = ORACLES["i11_apply_changes"]
ORACLES["i12_compact_index"] = (
    f"WITH {CHANGED}, x AS (SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS p FROM c), "
    "t AS (SELECT p, avg(x) AS t FROM x GROUP BY p) SELECT x.vec_id AS id, x.label, CAST(sum(CASE WHEN x.x > t.t THEN 1 ELSE 0 END) AS INTEGER) "
    "AS set_bits FROM x JOIN t ON x.p = t.p GROUP BY x.vec_id, x.label")

P = "p AS (SELECT vec_id, embedding::DOUBLE[] AS a, list_reverse(embedding::DOUBLE[]) AS b FROM embeddings)"


def value(expr):
    return f"WITH {P} SELECT vec_id, {r(expr)} AS value FROM p"


ORACLES["f01_l2_squared"] = value(l2("a", "b"))
ORACLES["f02_l1_norm"] = value(l1("a", "b"))
ORACLES["f03_linf_norm"] = value(linf("a", "b"))
ORACLES["f04_inner_product"] = value("list_inner_product(a, b)")
ORACLES["f05_cosine_similarity"] = value("list_cosine_similarity(a, b)")
ORACLES["f06_cosine_known_norm"] = value("list_cosine_similarity(a, b)")
ORACLES["f07_magnitude_squared"] = value("list_inner_product(a, a)")
ORACLES["f17_element_access"] = value("a[7]")
ORACLES["f01_l2_squared_bytes"] = (
    "WITH p AS (SELECT vec_id, list_transform(embedding, lambda x: round(x::DOUBLE * 127)) AS a FROM embeddings) SELECT vec_id, "
    "list_sum(list_transform(list_zip(a, list_reverse(a)), lambda s: (s[1] - s[2]) * (s[1] - s[2]))) AS value FROM p")
ORACLES["f01_sql_functions"] = (
    f"WITH {P} SELECT vec_id, {r(l2('a', 'b'))} AS l2_squared, {r(l1('a', 'b'))} AS l1_norm, {r(linf('a', 'b'))} AS linf_norm, "
    f"{r('list_inner_product(a, b)')} AS inner_product, {r('list_cosine_similarity(a, b)')} AS cosine_similarity FROM p")
BITS = ("p AS (SELECT vec_id, embedding::DOUBLE[] AS v, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS a, "
        "list_reverse(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END)) AS b FROM embeddings)")
ORACLES["f08_hamming_bytes"] = f"WITH {BITS} SELECT vec_id, CAST({ham('a', 'b')} AS INTEGER) AS value, CAST({ham('a', 'b')} AS INTEGER) AS value_signed FROM p"
ORACLES["f09_hamming_long"] = "SELECT o_orderkey, CAST(bit_count(xor(o_orderkey, o_custkey)) AS INTEGER) AS value FROM orders"
ORACLES["f10_hamming_base64"] = (
    f"WITH {BITS}, w AS (SELECT vec_id, a, list_concat(list_transform(range(16), lambda x: 0), b[1:48]) AS b FROM p) "
    f"SELECT vec_id, CAST({ham('a', 'b')} AS INTEGER) AS value FROM w")
ADC_L2 = "list_sum(list_transform(list_zip(v, b), lambda s: (s[2] - s[1]) * (s[2] - s[1])))"
ADC_IP = "list_sum(list_transform(list_zip(v, b), lambda s: s[2] * s[1]))"
ORACLES["f11_l2_squared_adc"] = f"WITH {BITS} SELECT vec_id, {r(ADC_L2)} AS value FROM p"
ORACLES["f12_inner_product_adc"] = f"WITH {BITS} SELECT vec_id, {r(ADC_IP)} AS value FROM p"
ORACLES["f13_score_with_adc"] = (
    f"WITH {BITS}, s AS (SELECT vec_id, {ADC_L2} AS d, {ADC_IP} AS i FROM p) SELECT vec_id, {r(inverse('d'))} AS l2, "
    f"{r(ip_score('-i'))} AS innerproduct, {r(cos_score('1 - i'))} AS cosinesimil FROM s")
ORACLES["f14_to_score"] = (
    f"WITH {P} SELECT vec_id, {r(inverse(l2('a', 'b')))} AS l2, {r(inverse(l1('a', 'b')))} AS l1, {r(inverse(linf('a', 'b')))} AS linf, "
    f"{r(cos_score(cos('a', 'b')))} AS cosinesimil, {r(ip_score(ip('a', 'b')))} AS innerproduct FROM p")
ORACLES["f15_thresholds"] = (
    f"WITH s AS (SELECT o_orderkey, (o_orderkey % 97 + 1) / 50.0::DOUBLE AS s FROM orders) SELECT o_orderkey, {r('1 / s - 1')} AS l2, "
    f"{r('2 - 2 * s')} AS cosinesimil, {r('(CASE WHEN s > 1 THEN 1 - s ELSE 1 / s - 1 END)')} AS innerproduct, {r('s')} AS ip_distance FROM s")
ORACLES["f16_zero_vector"] = "SELECT vec_id, label = 2 AS is_zero FROM embeddings WHERE label <> 4"
ORACLES["f18_ip_score_to_cosine"] = value("greatest((1 + list_inner_product(a, b)) / 2, 0)")

for _name, _metric, _score in (("l2", l2, inverse), ("cosinesimil", cos, cos_score), ("innerproduct", ip, ip_score),
                               ("l1", l1, inverse), ("linf", linf, inverse)):
    ORACLES[f"s01_knn_join_{_name}"] = top(_metric(*QC), _score, 10)
ORACLES["t02_stream_queries"] = ORACLES["s01_knn_join_l2"]
ORACLES["s22_several_tables"] = ORACLES["s01_knn_join_l2"]
ORACLES["s20_boost"] = top(l2(*QC), inverse, 5, boost=" * 2.5")
ORACLES["s02_single_query"] = (
    f"WITH {E}, d AS (SELECT vec_id AS id, label, {l2('v', LIT)} AS distance FROM e) SELECT id, {r('distance')} AS distance, "
    f"{r(inverse('distance'))} AS score, label FROM d ORDER BY distance, id LIMIT 25")
ORACLES["s03_scored_scan"] = (
    f"WITH {E} SELECT vec_id, label, CASE WHEN label = 4 THEN 0.0 ELSE {r(cos_score(cos('v', LIT)))} END AS score FROM e WHERE label <> 6")
BYTE_Q = "[" + ", ".join(str(1 + i % 3) for i in range(DIM)) + "]::DOUBLE[]"
ORACLES["s03_scored_scan_bytes"] = (
    "WITH b AS (SELECT vec_id, list_transform(embedding, lambda x: round(x::DOUBLE * 127)) AS v FROM embeddings) "
    f"SELECT vec_id, {r(f'1 + list_cosine_similarity(v, {BYTE_Q})')} AS score FROM b")
ORACLES["s04_hamming_scan_long"] = (
    f"SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 0.0 ELSE {r('1 / (1 + bit_count(xor(o_custkey, 170::BIGINT)))::DOUBLE')} END AS score FROM orders")
ORACLES["s04_hamming_scan_base64"] = (
    f"WITH {BITS}, w AS (SELECT vec_id, a, list_concat(list_transform(range(52), lambda x: 0), list_transform(range(12), lambda x: 1)) AS b FROM p) "
    f"SELECT vec_id, {r(inverse(ham('a', 'b')))} AS score FROM w")
ORACLES["s05_radius_distance"] = within(l2(*QC), inverse, "distance <= 1.4")
ORACLES["s15_two_phase_radius"] = ORACLES["s05_radius_distance"]
ORACLES["s05_radius_inner_product"] = within(ip(*QC), ip_score, "distance <= -0.25")
ORACLES["s06_radius_score"] = within(cos(*QC), cos_score, f"{cos_score('distance')} >= 0.63")
ORACLES["s15_two_phase_radius_cosine"] = ORACLES["s06_radius_score"]
ORACLES["s06_radius_score_per_query"] = within(l2(*QC), inverse, f"{inverse('distance')} >= 0.4::DOUBLE + ql / 100.0::DOUBLE")
ORACLES["s07_radius_capped"] = top(l2(*QC), inverse, 4, after="distance <= 1.7 AND rk <= {k}")
ORACLES["s08_prefiltered_knn"] = top(l2(*QC), inverse, 5, where="c.label = 3", keep="label")
ORACLES["s09_per_query_filter"] = top(l2(*QC), inverse, 5, where="c.label = q.label", keep="label")
ORACLES["s09_per_query_range"] = top(ip(*QC), ip_score, 5, where="q.label <= c.label AND q.vec_id <> c.vec_id")
ORACLES["s10_postfiltered_knn"] = top(l2(*QC), inverse, 20, keep="label", after="rk <= {k} AND label = 3")
ORACLES["s31_paging"] = top(l2(*QC), inverse, 20, after="rk > 5 AND rk <= 10")


def ivf(metric, score, k, nprobes, **more):
    return top(metric(*QC), score, k, ctes=(E, MEANS, near_list(metric, 1), near_list(metric, nprobes, name="p"),
                                            "x AS (SELECT e.*, a.list_id FROM e JOIN a ON e.vec_id = a.vec_id)"),
               q="e q JOIN p ON p.vec_id = q.vec_id", c="x c", where="c.list_id = p.list_id", **more)


ORACLES["s11_ivf_search"] = ivf(l2, inverse, 10, 2)
ORACLES["s09_per_query_filter_ivf"] = ivf(l2, inverse, 5, 2).replace("c.list_id = p.list_id", "c.list_id = p.list_id AND c.label <> q.label")
ORACLES["s11_ivf_search_cosine"] = ivf(cos, cos_score, 10, 3)
ORACLES["m05_index_from_model"] = ivf(l2, inverse, 10, 1)
ORACLES["t01_stream_into_index"] = ORACLES["s11_ivf_search"]

# Moments of every dimension, and codes of one or more thresholds.
X = "x AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS p FROM e)"
MOM = "mo AS (SELECT p, avg(x) AS mean, stddev_pop(x) AS sd FROM x GROUP BY p)"
SIDES = ("sd AS (SELECT x.p, avg(CASE WHEN x.x <= mo.mean THEN x.x END) AS below, avg(CASE WHEN x.x > mo.mean THEN x.x END) AS above "
         "FROM x JOIN mo ON x.p = mo.p GROUP BY x.p)")


def codes(bits):
    return (f"b AS (SELECT x.vec_id, list(CASE WHEN x.x > mo.mean + (-1 + 2 * (i + 1) / {bits + 1}.0::DOUBLE) * mo.sd THEN 1 ELSE 0 END ORDER BY i, x.p) AS v "
            f"FROM x JOIN mo ON x.p = mo.p, range({bits}) t(i) GROUP BY x.vec_id)")


for _b, _name in ((1, "s12_binary_scan"), (2, "s12_binary_scan_2bit"), (4, "s12_binary_scan_4bit")):
    ORACLES[_name] = top(ham(*QC), inverse, 10, ctes=(E, X, MOM, codes(_b)), q="b q", c="b c")
    ORACLES[f"q01_fit_{_b}bit"] = (
        f"WITH {E}, {X}, {MOM} SELECT CAST(i AS INTEGER) AS plane, CAST(p AS INTEGER) - 1 AS dim, "
        f"{r(f'(mean + (-1 + 2 * (i + 1) / {_b + 1}.0::DOUBLE) * sd)')} AS threshold FROM mo, range({_b}) t(i)")
ORACLES["s09_per_query_filter_codes"] = top(ham(*QC), inverse, 10, ctes=(E, X, MOM, codes(1)), q="b q", c="b c", where="q.vec_id <> c.vec_id")
ORACLES["q01_side_means"] = f"WITH {E}, {X}, {MOM}, {SIDES} SELECT CAST(p AS INTEGER) - 1 AS dim, {r('below')} AS below, {r('above')} AS above FROM sd"
ORACLES["a03_vector_stats"] = (
    f"WITH {E}, {X}, {MOM}, {SIDES} SELECT CAST(mo.p AS INTEGER) - 1 AS dim, (SELECT count(*) FROM e) AS n, {r('mean')} AS mean, {r('sd')} AS std, "
    f"{r('below')} AS below, {r('above')} AS above FROM mo JOIN sd ON mo.p = sd.p").replace("r AS", "r AS")
ORACLES["q02_encode_bits"] = (
    f"WITH {E}, {X}, {MOM}, {codes(2)}, u AS (SELECT vec_id, v, j FROM b, range(16) t(j)) SELECT vec_id AS id, CAST(j AS INTEGER) AS pos, "
    "CAST(list_sum(list_transform(range(8), lambda i: v[j * 8 + i + 1] * (CASE i WHEN 0 THEN -128 ELSE 1 << CAST(7 - i AS INTEGER) END))) AS INTEGER) AS byte FROM u")


def adc(space):
    moved = "(x.x - sd.below) / (sd.above - sd.below)"
    if space == "l2":
        moved = f"(pow(sd.above - sd.below, 2) * ({moved} - 0.5) + 0.5)"
    return f"aq AS (SELECT x.vec_id, list({moved} ORDER BY x.p) AS v FROM x JOIN sd ON x.p = sd.p GROUP BY x.vec_id)"


ADC_CTES = (E, X, MOM, SIDES, codes(1))
ADC_PAIR_L2 = "list_sum(list_transform(list_zip(q.v, c.v), lambda s: (s[2] - s[1]) * (s[2] - s[1])))"
ADC_PAIR_IP = "(-list_sum(list_transform(list_zip(q.v, c.v), lambda s: s[2] * s[1])))"
ORACLES["s12_adc_scan"] = top(ADC_PAIR_L2, inverse, 10, ctes=(*ADC_CTES, adc("l2")), q="aq q", c="b c")
ORACLES["s12_adc_scan_inner_product"] = top(ADC_PAIR_IP, ip_score, 10, ctes=(*ADC_CTES, adc("ip")), q="aq q", c="b c")
for _s in ("l2", "innerproduct"):
    ORACLES[f"q05_adc_transform_{_s}"] = f"WITH {E}, {X}, {MOM}, {SIDES}, {adc(_s)} " + elements(
        "(SELECT vec_id AS id, v FROM aq)", "id", "v")


def second_pass(first, n, ctes, q, c, where="TRUE", metric=l2, score=inverse, k=10):
    pool = (f"f AS (SELECT query_id, id FROM (SELECT q.vec_id AS query_id, c.vec_id AS id, row_number() OVER (PARTITION BY q.vec_id ORDER BY "
            f"{first}, c.vec_id) AS fr FROM {q}, {c} WHERE {where}) WHERE fr <= {n})")
    return top(metric(*QC), score, k, ctes=(*ctes, pool), q="f JOIN e q ON q.vec_id = f.query_id", c="e c", where="c.vec_id = f.id")


ORACLES["s29_candidate_depth"] = second_pass(ham(*QC), 130, (E, X, MOM, codes(1)), "b q", "b c", k=5)
ORACLES["s13_two_phase"] = second_pass(ham(*QC), 120, (E, X, MOM, codes(1)), "b q", "b c")
ORACLES["s13_two_phase_adc"] = second_pass(ADC_PAIR_L2, 100, (*ADC_CTES, adc("l2")), "aq q", "b c")

# Codebook of 8 sub-vectors whose centroids are the label means cut up.
SUBS = ("cb AS (SELECT list_id, s, cv[s * 8 + 1:s * 8 + 8] AS cv FROM m, range(8) t(s)), "
        "sv AS (SELECT vec_id, s, v[s * 8 + 1:s * 8 + 8] AS v FROM e, range(8) t(s)), "
        "pc AS (SELECT vec_id, s, list_id, cv FROM (SELECT sv.vec_id, sv.s, cb.list_id, cb.cv, row_number() OVER (PARTITION BY sv.vec_id, sv.s "
        f"ORDER BY {l2('sv.v', 'cb.cv')}, cb.list_id) AS rn FROM sv JOIN cb ON sv.s = cb.s) WHERE rn = 1), "
        "pv AS (SELECT vec_id, flatten(list(cv ORDER BY s)) AS v FROM pc GROUP BY vec_id)")
ORACLES["s12_pq_scan"] = top(l2(*QC), inverse, 10, ctes=(E, MEANS, SUBS), c="pv c")
ORACLES["q11_pq_encode"] = f"WITH {E}, {MEANS}, {SUBS} SELECT vec_id AS id, CAST(s AS INTEGER) AS sub, CAST(list_id AS INTEGER) AS centroid FROM pc"
WIDE = (SUBS.replace("cb AS (SELECT list_id, s, cv[s * 8 + 1:s * 8 + 8] AS cv FROM m, range(8) t(s))",
                     "w AS (SELECT a.list_id * 400 + b.list_id * 40 + t AS list_id, list_transform(list_zip(a.cv, b.cv), lambda x: x[1] + (t - 20 + 0.5::DOUBLE) / 8 * x[2]) AS cv "
                     "FROM m a, m b, range(40) r(t)), cb AS MATERIALIZED (SELECT list_id, s, cv[s * 8 + 1:s * 8 + 8] AS cv FROM w, range(8) t(s))")
        .replace("pc AS (", "pc AS MATERIALIZED ("))
ORACLES["s12_pq_scan_12bit"] = top(l2(*QC), inverse, 10, ctes=(E, MEANS, WIDE), c="pv c")
ORACLES["q11_pq_encode_12bit"] = f"WITH {E}, {MEANS}, {WIDE} SELECT vec_id AS id, CAST(s AS INTEGER) AS sub, CAST(list_id AS INTEGER) AS centroid FROM pc"
ORACLES["q04_rotation_structured"] = (
    f"WITH {E} SELECT a.vec_id AS id, round(list_inner_product(a.v, a.v), 5) AS size, CASE WHEN abs(list_inner_product(a.v, b.v)) < 5e-6 THEN 0.0 "
    "ELSE round(list_inner_product(a.v, b.v), 5) END AS product FROM e a JOIN e b ON b.vec_id = a.vec_id + 1")
ORACLES["q10_pq_train"] = (
    f"WITH {E}, {MEANS}, {SUBS}, pu AS (SELECT pc.s, pc.list_id, unnest(sv.v) AS x, generate_subscripts(sv.v, 1) AS p FROM pc JOIN sv "
    "ON pc.vec_id = sv.vec_id AND pc.s = sv.s), pa AS (SELECT s, list_id, p, avg(x) AS x FROM pu GROUP BY s, list_id, p) "
    f"SELECT CAST(s AS INTEGER) AS sub, CAST(list_id AS INTEGER) AS centroid, CAST(p AS INTEGER) - 1 AS pos, {r('x')} AS value FROM pa")
ORACLES["s13_two_phase_ivf_pq"] = second_pass(
    l2(*QC), 100, (E, MEANS, SUBS, near_list(l2, 1), near_list(l2, 3, name="p"),
                   "x AS (SELECT pv.*, a.list_id FROM pv JOIN a ON pv.vec_id = a.vec_id)"),
    "e q JOIN p ON p.vec_id = q.vec_id", "x c", "c.list_id = p.list_id")


def lloyd(step, before):
    """One more iteration of k-means on the coarse centroids ``before``."""
    return (f"as{step} AS (SELECT vec_id, list_id, v FROM (SELECT e.vec_id, e.v, c.list_id, row_number() OVER (PARTITION BY e.vec_id ORDER BY "
            f"{l2('e.v', 'c.cv')}, c.list_id) AS rn FROM e, {before} c) WHERE rn = 1), "
            f"m{step} AS (SELECT list_id, list(mx ORDER BY p) AS cv FROM (SELECT list_id, p, avg(x) AS mx FROM (SELECT list_id, unnest(v) AS x, "
            f"generate_subscripts(v, 1) AS p FROM as{step}) GROUP BY list_id, p) GROUP BY list_id)")


ORACLES["q12_ivf_train"] = (
    f"WITH {E}, {MEANS}, {lloyd(1, 'm')}, {lloyd(2, 'm1')}, u AS (SELECT list_id, unnest(cv) AS x, generate_subscripts(cv, 1) AS p FROM m2) "
    f"SELECT 0 AS sub, CAST(list_id AS INTEGER) AS centroid, CAST(p AS INTEGER) - 1 AS pos, {r('x')} AS value FROM u")
ORACLES["q13_assign_lists"] = f"WITH {E}, {MEANS}, {near_list(l2, 1)} SELECT vec_id AS id, list_id FROM a"
ORACLES["q03_sample"] = "SELECT least(count(*), 200) AS n, least(count(DISTINCT vec_id), 200) AS n_ids FROM embeddings"
ORACLES["q04_rotation"] = (
    f"WITH {E} SELECT vec_id AS id, CAST(len(v) AS INTEGER) AS dim, round(list_inner_product(v, v), 5) AS norm_sq, TRUE AS moved FROM e")
ORACLES["q06_fp16_clip"] = (
    f"WITH {E}, s AS (SELECT vec_id AS id, list_transform(v, lambda x: greatest(-65504.0, least(65504.0, x * 500000))) AS v FROM e) " + elements("s", "id", "v"))
ORACLES["q06_fp16_encode"] = "SELECT vec_id AS id, CAST(2 * len(embedding) AS INTEGER) AS n_bytes, TRUE AS close FROM embeddings"
ORACLES["q07_to_byte"] = (
    "SELECT id, CAST(p AS INTEGER) - 1 AS pos, CAST(x AS INTEGER) AS value FROM (SELECT vec_id AS id, unnest(list_transform(embedding, "
    "lambda x: round(x::DOUBLE * 127))) AS x, generate_subscripts(embedding, 1) AS p FROM embeddings)")
ORACLES["q08_sq7_full_range"] = (
    f"WITH {E}, {X}, lim AS (SELECT min(x) AS lo, max(x) AS hi FROM x) SELECT vec_id AS id, CAST(p AS INTEGER) - 1 AS pos, "
    "CAST(round((x - lo) / (hi - lo) * 127) AS INTEGER) AS level FROM x, lim")
ORACLES["q08_sq7_search"] = top(l2(*QC), inverse, 10, c="y c", ctes=(
    E, X, "lim AS (SELECT min(x) AS lo, max(x) AS hi FROM x)",
    "y AS (SELECT vec_id, list(lo + round((x - lo) / (hi - lo) * 127) * ((hi - lo) / 127) ORDER BY p) AS v FROM x, lim GROUP BY vec_id)"))


def interval(bits, rounds=5):
    """Per-row interval with evenly spaced levels, fitted to the centred vector m by alternating assignment and a
    least-squares line; final CTE fit{bits}."""
    top_ = (1 << bits) - 1
    level = f"list_transform(m, lambda x: greatest(0.0, least({top_}.0, round_even((x - lo) / (CASE WHEN hi > lo THEN (hi - lo) / {top_} ELSE 1 END), 0))))"
    first = "list_avg(m) - list_stddev_pop(m) AS lo, list_avg(m) + list_stddev_pop(m) AS hi" if bits == 1 else "list_min(m) AS lo, list_max(m) AS hi"
    out, name = [f"w{bits}_0 AS (SELECT vec_id, m, {first} FROM mv)"], f"w{bits}_0"
    for i in range(1, rounds + 1):
        out += [f"l{bits}_{i} AS (SELECT vec_id, m, lo, hi, {level} AS lv FROM {name})",
                f"g{bits}_{i} AS (SELECT *, list_avg(lv) AS mid FROM l{bits}_{i})",
                f"s{bits}_{i} AS (SELECT *, list_sum(list_transform(list_zip(lv, m), lambda s: (s[1] - mid) * s[2])) / "
                f"nullif(list_sum(list_transform(lv, lambda x: (x - mid) * (x - mid))), 0) AS slope FROM g{bits}_{i})",
                f"w{bits}_{i} AS (SELECT vec_id, m, CASE WHEN slope > 0 THEN list_avg(m) - slope * mid ELSE lo END AS lo, "
                f"CASE WHEN slope > 0 THEN list_avg(m) - slope * mid + slope * {top_} ELSE hi END AS hi FROM s{bits}_{i})"]
        name = f"w{bits}_{i}"
    out.append(f"fit{bits} AS (SELECT vec_id, m, lo, hi, {level} AS lv FROM {name})")
    return ", ".join(out)


def sq1(unit, extra, query_extra):
    """Centred vectors, their 1-bit codes with float32 corrections, and the 4-bit form of the queries."""
    source = "list_transform(v, lambda x: x / sqrt(list_inner_product(v, v)))" if unit else "v"
    return (f"u AS (SELECT vec_id, {source} AS v FROM e)", "ux AS (SELECT unnest(v) AS x, generate_subscripts(v, 1) AS p FROM u)",
            "mu AS (SELECT list(mx ORDER BY p) AS c FROM (SELECT p, avg(x) AS mx FROM ux GROUP BY p))",
            "mv AS (SELECT vec_id, list_transform(list_zip(v, c), lambda s: s[1] - s[2]) AS m FROM u, mu)", interval(1), interval(4),
            f"dx AS (SELECT f.vec_id, list_transform(lv, lambda x: lo::FLOAT::DOUBLE + x * (hi::FLOAT::DOUBLE - lo::FLOAT::DOUBLE)) AS v, "
            f"({extra})::FLOAT::DOUBLE AS w FROM fit1 f JOIN u ON u.vec_id = f.vec_id, mu)",
            f"qx AS (SELECT f.vec_id, list_transform(lv, lambda x: lo + x * ((hi - lo) / 15)) AS v, {query_extra} AS w FROM fit4 f JOIN u ON u.vec_id = f.vec_id, mu)")


SQ1_COS = sq1(True, "list_inner_product(u.v, c)", "list_inner_product(u.v, c) - list_inner_product(c, c)")
SQ1_COS_RAW = "1 - (list_inner_product(q.v, c.v) + c.w + q.w)"
ORACLES["q09_sq1_estimate"] = top(SQ1_COS_RAW, cos_score, 10, q="qx q", c="dx c", ctes=(E, *SQ1_COS))
ORACLES["q09_sq1_search"] = second_pass(SQ1_COS_RAW, 100, (E, *SQ1_COS), "qx q", "dx c", metric=cos, score=cos_score)
ORACLES["s32_flat_compressed"] = second_pass(
    "q.w + c.w - 2 * list_inner_product(q.v, c.v)", 100,
    (E, *sq1(False, "list_inner_product(m, m)", "list_inner_product(m, m)")), "qx q", "dx c")

# Nested tables: five children per parent.
N = "c AS (SELECT vec_id // 5 AS parent_id, CAST(vec_id % 5 AS INTEGER) AS child_pos, v, label FROM e)"


def nested(k, where="TRUE", tail=""):
    best = (f"d AS (SELECT q.vec_id AS query_id, c.parent_id, c.child_pos, {l2(*QC)} AS distance FROM e q, c WHERE {where}), "
            "b1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id, parent_id ORDER BY distance, child_pos) AS cr FROM d) WHERE cr = 1), "
            f"r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, parent_id) AS rk FROM b1) WHERE rk <= {k})")
    return f"WITH {E}, {N}, {best} " + (tail or (
        f"SELECT query_id, parent_id, child_pos, CAST(rk AS INTEGER) AS rank, {r('distance')} AS distance, {r(inverse('distance'))} AS score FROM r"))


ORACLES["s16_nested_knn"] = nested(5)


def expanded(k, where):
    """All children that pass, of the k nearest parents. Parents are ranked first; only the winners' children are compared again."""
    return (f"WITH {E.replace('e AS (', 'e AS MATERIALIZED (', 1)}, {N.replace('c AS (', 'c AS MATERIALIZED (', 1)}, "
            f"b AS MATERIALIZED (SELECT q.vec_id AS query_id, c.parent_id, min({l2(*QC)}) AS best FROM e q, c WHERE {where} GROUP BY q.vec_id, c.parent_id), "
            "r AS MATERIALIZED (SELECT query_id, parent_id, rk FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY best, parent_id) AS rk FROM b) "
            f"WHERE rk <= {k}), f AS MATERIALIZED (SELECT r.query_id, r.parent_id, c.child_pos, r.rk, {l2(*QC)} AS distance FROM r JOIN c ON c.parent_id = r.parent_id "
            f"JOIN e q ON q.vec_id = r.query_id WHERE {where}) "
            f"SELECT query_id, parent_id, child_pos, CAST(rk AS INTEGER) AS rank, {r('distance')} AS distance, {r(inverse('distance'))} AS score FROM f")


ORACLES["s17_expand_nested"] = expanded(3, "c.label <> 2")
ORACLES["s17_expand_per_query_filter"] = expanded(3, "c.label <> q.label")
NESTED_LISTS = "c AS (SELECT e.vec_id // 5 AS parent_id, CAST(e.vec_id % 5 AS INTEGER) AS child_pos, v, a.list_id FROM e JOIN a ON a.vec_id = e.vec_id)"
ORACLES["s16_nested_knn_ivf"] = (
    f"WITH {E}, {MEANS}, {near_list(l2, 1)}, {near_list(l2, 3, name='p')}, {NESTED_LISTS}, d AS (SELECT q.vec_id AS query_id, c.parent_id, c.child_pos, {l2(*QC)} AS distance "
    "FROM e q JOIN p ON p.vec_id = q.vec_id JOIN c ON c.list_id = p.list_id), "
    "b1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id, parent_id ORDER BY distance, child_pos) AS cr FROM d) WHERE cr = 1), "
    "r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, parent_id) AS rk FROM b1) WHERE rk <= 5) "
    f"SELECT query_id, parent_id, child_pos, CAST(rk AS INTEGER) AS rank, {r('distance')} AS distance, {r(inverse('distance'))} AS score FROM r")
ORACLES["s19_nested_radius_on"] = (
    f"WITH {E}, {N}, d AS (SELECT q.vec_id AS query_id, c.parent_id, c.child_pos, c.label, {l2(*QC)} AS distance FROM e q, c "
    f"WHERE c.label <> q.label AND {l2(*QC)} <= 1.3 + q.label / 100.0), "
    "r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id, parent_id ORDER BY distance, child_pos) AS cr FROM d) WHERE cr = 1) "
    f"SELECT query_id, parent_id, child_pos, label, {r('distance')} AS distance, {r(inverse('distance'))} AS score FROM r")
ORACLES["s15_two_phase_radius_on"] = (
    f"WITH {E}, d AS (SELECT q.vec_id AS query_id, c.vec_id AS id, c.label, {l2(*QC)} AS distance FROM e q, e c WHERE c.label <> q.label "
    f"AND {l2(*QC)} <= 1.2 + q.label / 100.0) SELECT query_id, id, label, {r('distance')} AS distance, {r(inverse('distance'))} AS score FROM d")
ORACLES["s18_nested_child_filter"] = nested(5, "c.label = 3")
ORACLES["s18_nested_parent_filter"] = nested(5, "c.parent_id IN (SELECT parent_id FROM c WHERE label = 7)")
ORACLES["s19_nested_radius"] = nested(1_000_000_000, f"{l2(*QC)} <= 1.4", (
    f"SELECT query_id, parent_id, child_pos, {r('distance')} AS distance, {r(inverse('distance'))} AS score FROM r"))
ORACLES["s19_nested_rescore"] = (
    f"WITH {E}, {N}, {X}, {MOM}, {codes(1)}, h AS (SELECT q.vec_id AS query_id, c.vec_id // 5 AS parent_id, min({ham(*QC)}) AS d FROM b q, b c GROUP BY ALL), "
    "f AS (SELECT query_id, parent_id FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, parent_id) AS rn FROM h) WHERE rn <= 100), "
    f"d AS (SELECT f.query_id, c.parent_id, c.child_pos, {l2(*QC)} AS distance FROM f JOIN e q ON q.vec_id = f.query_id JOIN c ON c.parent_id = f.parent_id), "
    "b1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id, parent_id ORDER BY distance, child_pos) AS cr FROM d) WHERE cr = 1), "
    "r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, parent_id) AS rk FROM b1) WHERE rk <= 5) "
    f"SELECT query_id, parent_id, child_pos, CAST(rk AS INTEGER) AS rank, {r('distance')} AS distance, {r(inverse('distance'))} AS score FROM r")
ORACLES["s23_auto_exact"] = top(l2(*QC), inverse, 5, where="c.label = 3", extra=", 'Exact' AS search_type")
ORACLES["s24_auto_fallback"] = (
    f"WITH {E}, {MEANS}, {near_list(l2, 1)}, d AS (SELECT q.vec_id AS query_id, c.vec_id AS id, {l2(*QC)} AS distance, qa.list_id = ca.list_id AS same "
    "FROM e q JOIN a qa ON qa.vec_id = q.vec_id, e c JOIN a ca ON ca.vec_id = c.vec_id), "
    "n AS (SELECT query_id, count(*) FILTER (WHERE same) >= 52 AS enough FROM d GROUP BY query_id), "
    "r AS (SELECT d.*, enough, row_number() OVER (PARTITION BY d.query_id ORDER BY distance, id) AS rk FROM d JOIN n ON n.query_id = d.query_id "
    f"WHERE same OR NOT enough) SELECT query_id, id, CAST(rk AS INTEGER) AS rank, {r('distance')} AS distance, {r(inverse('distance'))} AS score, "
    "CASE WHEN enough THEN 'Approximate-NN' ELSE 'Exact' END AS search_type FROM r WHERE rk <= 52")
ORACLES["s24_fill_exact"] = ORACLES["s24_auto_fallback"].replace(", CASE WHEN enough THEN 'Approximate-NN' ELSE 'Exact' END AS search_type", "")
SIGN = "g AS (SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS v FROM embeddings)"
ORACLES["s25_binary_vectors"] = top(ham(*QC), inverse, 10, ctes=(SIGN,), q="g q", c="g c")
BYTES = "g AS (SELECT vec_id, list_transform(embedding, lambda x: round(x::DOUBLE * 127)) AS v FROM embeddings)"
# Majority of every label's sign bits, as coarse centroids of binary vectors.
CODES = ("m AS (SELECT label AS list_id, list(b ORDER BY p) AS cv FROM (SELECT label, p, CASE WHEN 2 * sum(x) > count(*) THEN 1 ELSE 0 END AS b FROM "
         "(SELECT e.label, unnest(g.v) AS x, generate_subscripts(g.v, 1) AS p FROM g JOIN embeddings e ON e.vec_id = g.vec_id) GROUP BY label, p) GROUP BY label)")
ORACLES["s11_ivf_search_binary"] = top(
    ham(*QC), inverse, 10, ctes=(SIGN, CODES, near_list(ham, 1, "g"), near_list(ham, 2, "g", "p"), "x AS (SELECT g.*, a.list_id FROM g JOIN a ON g.vec_id = a.vec_id)"),
    q="g q JOIN p ON p.vec_id = q.vec_id", c="x c", where="c.list_id = p.list_id")
ORACLES["q13_assign_lists_binary"] = f"WITH {SIGN}, {CODES}, {near_list(ham, 1, 'g')} SELECT vec_id AS id, list_id FROM a"


def majority(step, before):
    """One more iteration of k-majority on the centroids ``before``; evenly divided bits stay."""
    return (f"as{step} AS (SELECT vec_id, list_id, cv, v FROM (SELECT g.vec_id, g.v, c.list_id, c.cv, row_number() OVER (PARTITION BY g.vec_id ORDER BY "
            f"{ham('g.v', 'c.cv')}, c.list_id) AS rn FROM g, {before} c) WHERE rn = 1), "
            f"mj{step} AS (SELECT list_id, list(b ORDER BY p) AS cv FROM (SELECT list_id, p, CASE WHEN 2 * sum(x) > count(*) THEN 1 WHEN 2 * sum(x) < count(*) THEN 0 "
            f"ELSE any_value(old) END AS b FROM (SELECT list_id, unnest(v) AS x, unnest(cv) AS old, generate_subscripts(v, 1) AS p FROM as{step}) GROUP BY list_id, p) GROUP BY list_id)")


ORACLES["q12_ivf_train_binary"] = (
    f"WITH {SIGN}, {CODES}, {majority(1, 'm')}, {majority(2, 'mj1')} SELECT CAST(list_id AS INTEGER) AS centroid, "
    "string_agg(printf('%02x', list_reduce(list_prepend(0, cv[8 * b + 1:8 * b + 8]), lambda x, y: 2 * x + y)), '' ORDER BY b) AS code "
    "FROM mj2, range(8) t(b) GROUP BY list_id")
ORACLES["s26_byte_vectors"] = top("list_sum(list_transform(list_zip(q.v, c.v), lambda s: (s[1] - s[2]) * (s[1] - s[2])))", inverse, 10,
                                  ctes=(BYTES,), q="g q", c="g c")
ORACLES["s27_explain"] = (
    f"WITH {E}, d AS (SELECT q.vec_id AS query_id, c.vec_id AS id, {ip(*QC)} AS distance FROM e q, e c WHERE c.label < 5), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rk FROM d) "
    f"SELECT query_id, id, 'Exact' AS search_type, {r('distance')} AS raw, (SELECT count(*) FROM e WHERE label < 5) AS cardinality, "
    "'rawScore >= 0 ? 1 / (1 + rawScore) : -rawScore + 1' AS formula FROM r WHERE rk <= 5")
ORACLES["s28_named_score"] = f"WITH {P} SELECT vec_id, {r('1 + list_cosine_similarity(a, b)')} AS similarity FROM p"
ORACLES["s30_combined_clauses"] = (
    f"WITH {E}, h AS (SELECT q.vec_id AS query_id, c.vec_id AS id, {l2(*QC)} AS distance, 1 AS part FROM e q, e c UNION ALL "
    f"SELECT q.vec_id, c.vec_id, {l2('list_reverse(q.v)', 'c.v')}, 2 FROM e q, e c), "
    "t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id, part ORDER BY distance, id) AS rk FROM h) WHERE rk <= 10), "
    f"s AS (SELECT query_id, id, sum({inverse('distance')}) AS score FROM t GROUP BY query_id, id), "
    "o AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rk FROM s) "
    f"SELECT query_id, id, CAST(rk AS INTEGER) AS rank, {r('score')} AS score FROM o WHERE rk <= 10")
# Greedy diversity selection of 3 out of 9, unrolled.
POOL = (f"{E}, d AS (SELECT q.vec_id AS query_id, c.vec_id AS id, c.v, c.label, {l2(*QC)} AS distance FROM e q, e c), "
        f"p AS (SELECT query_id, id, v, label, {inverse('distance')} AS score, rk FROM (SELECT *, row_number() OVER (PARTITION BY query_id "
        "ORDER BY distance, id) AS rk FROM d) WHERE rk <= 9), "
        f"s AS (SELECT a.query_id, a.id AS id, b.id AS other, {inverse(l2('a.v', 'b.v'))} AS sim FROM p a JOIN p b ON a.query_id = b.query_id)")
LAMBDA = 0.6


def pick(step, sim, join, done):
    return (f"c{step} AS (SELECT p.query_id, p.id, p.score, {sim} AS sim, {1 - LAMBDA} * p.score - {LAMBDA} * {sim} AS mmr, p.rk FROM p {join} {done}), "
            f"p{step} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY mmr DESC, rk) AS o FROM c{step}) WHERE o = 1)")


J1 = "JOIN p1 ON p1.query_id = p.query_id JOIN s s1 ON s1.query_id = p.query_id AND s1.id = p.id AND s1.other = p1.id"
J2 = J1 + " JOIN p2 ON p2.query_id = p.query_id JOIN s s2 ON s2.query_id = p.query_id AND s2.id = p.id AND s2.other = p2.id"
PICKS = ", ".join([POOL, pick(1, "0.0", "", ""), pick(2, "greatest(0, s1.sim)", J1, "WHERE p.id <> p1.id"),
                   pick(3, "greatest(0, s1.sim, s2.sim)", J2, "WHERE p.id <> p1.id AND p.id <> p2.id")])
UNION = " UNION ALL ".join(f"SELECT query_id, id, CAST({i} AS INTEGER) AS mmr_rank, score, sim, mmr FROM p{i}" for i in (1, 2, 3))
ORACLES["r01_mmr"] = f"WITH {PICKS}, u AS ({UNION}) SELECT query_id, id, mmr_rank, {r('score')} AS score FROM u"
ORACLES["r01_mmr_by_id"] = ORACLES["r01_mmr"]
ORACLES["r02_mmr_explain"] = (
    f"WITH {PICKS}, u AS ({UNION}) SELECT query_id, id, mmr_rank, {r('score')} AS original_score, {r('sim')} AS max_similarity, {r('mmr')} AS mmr_score FROM u")
ORACLES["r03_mmr_vector_path"] = f"WITH {PICKS}, u AS ({UNION}) SELECT query_id, id, mmr_rank FROM u"
ORACLES["r06_mmr_projection"] = f"WITH {PICKS}, u AS ({UNION}) SELECT u.query_id, u.id, e.label, u.mmr_rank FROM u JOIN e ON e.vec_id = u.id"


def late(metric, score):
    return (f"WITH {E}, t AS (SELECT vec_id // 4 AS g, vec_id, v FROM e), b AS (SELECT q.g AS query_id, q.vec_id AS tok, c.g AS id, "
            f"max({score(metric(*QC))}) AS s FROM t q, t c GROUP BY ALL), x AS (SELECT query_id, id, sum(s) AS score FROM b GROUP BY query_id, id), "
            "r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rk FROM x) "
            f"SELECT query_id, id, CAST(rk AS INTEGER) AS rank, {r('score')} AS score FROM r WHERE rk <= 5")


ORACLES["r04_late_interaction"] = late(l2, inverse)
ORACLES["r04_late_interaction_inner_product"] = late(ip, ip_score)
ORACLES["r04_late_interaction_scored"] = (
    f"WITH {E}, b AS (SELECT vec_id // 4 AS id, max({cos_score(cos('v', LIT))}) AS s1, max({cos_score(cos('v', LIT_BACK))}) AS s2 FROM e GROUP BY vec_id // 4) "
    f"SELECT id, {r('(s1 + s2)')} AS score FROM b")
ORACLES["r05_rescore_hits"] = (
    f"WITH {E}, f AS (SELECT query_id, id FROM (SELECT q.vec_id AS query_id, c.vec_id AS id, row_number() OVER (PARTITION BY q.vec_id ORDER BY "
    f"{linf(*QC)}, c.vec_id) AS fr FROM e q, e c) WHERE fr <= 30), d AS (SELECT f.query_id, f.id, {l2(*QC)} AS distance FROM f JOIN e q ON q.vec_id = f.query_id "
    "JOIN e c ON c.vec_id = f.id), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rk FROM d) "
    f"SELECT query_id, id, CAST(rk AS INTEGER) AS rank, {r('distance')} AS distance, {r(inverse('distance'))} AS score FROM r WHERE rk <= 5")

LATER = "s, m2 m)"
ORACLES["m01_train_model"] = top(
    l2(*QC), inverse, 5, ctes=(E, MEANS, lloyd(1, "m"), lloyd(2, "m1"), near_list(l2, 1).replace("s, m)", LATER), near_list(l2, 2, name="p").replace("s, m)", LATER),
                               "x AS (SELECT e.*, a.list_id FROM e JOIN a ON e.vec_id = a.vec_id)"),
    q="e q JOIN p ON p.vec_id = q.vec_id", c="x c", where="c.list_id = p.list_id")
BIT_MEANS = ("m AS (SELECT label AS list_id, list(mx ORDER BY p) AS cv FROM (SELECT label, p, avg(x) AS mx FROM (SELECT e.label, unnest(b.v) AS x, "
             "generate_subscripts(b.v, 1) AS p FROM b JOIN e ON e.vec_id = b.vec_id) GROUP BY label, p) GROUP BY label)")
ORACLES["m02_train_on_codes"] = (
    f"WITH {E}, {X}, {MOM}, {codes(1)}, {BIT_MEANS}, {lloyd(1, 'm').replace('FROM e, m c', 'FROM b e, m c')}, "
    "u AS (SELECT list_id, unnest(cv) AS x, generate_subscripts(cv, 1) AS p FROM m1) "
    f"SELECT 0 AS sub, CAST(list_id AS INTEGER) AS centroid, CAST(p AS INTEGER) - 1 AS pos, {r('x')} AS value FROM u")
ORACLES["m03_model_table"] = (
    "SELECT t.model_id, 'created' AS state, CAST(d AS INTEGER) AS dimension, 'l2' AS space, 'ivf' AS method FROM (VALUES ('a'), ('c')) t(model_id), "
    "(SELECT max(len(embedding)) AS d FROM embeddings)")

HITS10 = (f"{E}, d AS (SELECT q.vec_id AS query_id, c.vec_id AS id, c.label, {l2(*QC)} AS distance FROM e q, e c), "
          "h AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rk FROM d) WHERE rk <= 10)")
ORACLES["a01_aggregate_hits"] = (
    f"WITH {HITS10} SELECT label, count(*) AS n, count(DISTINCT query_id) AS n_queries, {r('avg(1 / (1 + distance))')} AS avg_score FROM h GROUP BY label")
ORACLES["a02_vector_metric"] = (
    f"WITH {E} SELECT label, {r('sum(v[1])')} AS total, {r('max(' + linf('v', 'list_reverse(v)') + ')')} AS widest FROM e GROUP BY label")
ORACLES["a04_ground_truth"] = f"WITH {HITS10} SELECT query_id, id FROM h"
ORACLES["a05_recall"] = (
    f"WITH {HITS10}, {MEANS}, {near_list(l2, 1)}, {near_list(l2, 2, name='p')}, x AS (SELECT d.*, row_number() OVER (PARTITION BY d.query_id ORDER BY distance, id) AS ar "
    "FROM d JOIN a ON a.vec_id = d.id JOIN p ON p.vec_id = d.query_id AND p.list_id = a.list_id), "
    "n AS (SELECT h.query_id, count(x.id) / 10.0::DOUBLE AS rec FROM h LEFT JOIN x ON x.query_id = h.query_id AND x.id = h.id AND x.ar <= 10 GROUP BY h.query_id) "
    f"SELECT {r('avg(rec)')} AS recall FROM n")
ORACLES["a06_search_metrics"] = (
    "WITH n AS (SELECT label, count(*) AS filtered_rows, count(DISTINCT vec_id // 5) AS nested_docs FROM embeddings GROUP BY label) "
    "SELECT e.vec_id AS query_id, filtered_rows, nested_docs, least(5, nested_docs) AS returned, CAST(0 AS BIGINT) AS ann_count, filtered_rows AS exact_count "
    "FROM embeddings e JOIN n ON n.label = e.label")
FILTERED = "(SELECT count(*) FROM embeddings WHERE label <> 4) AS filtered_rows"
ORACLES["a06_measured_exact"] = (
    f"WITH n AS (SELECT q.vec_id AS query_id, count(*) AS n FROM embeddings q, embeddings c WHERE c.label <> 4 AND q.label <= c.label AND q.vec_id <> c.vec_id GROUP BY q.vec_id) "
    f"SELECT query_id, {FILTERED}, CAST(0 AS BIGINT) AS ann_count, n AS exact_count, least(n, 5) AS returned FROM n")
ORACLES["a06_measured_lists"] = (
    f"WITH {E}, {MEANS}, {near_list(l2, 1)}, {near_list(l2, 2, name='p')}, n AS (SELECT q.vec_id AS query_id, count(*) AS n FROM e q JOIN p ON p.vec_id = q.vec_id "
    "JOIN a ON a.list_id = p.list_id JOIN e c ON c.vec_id = a.vec_id WHERE c.label <> 4 AND q.label <> c.label GROUP BY q.vec_id) "
    f"SELECT query_id, {FILTERED}, n AS ann_count, CAST(0 AS BIGINT) AS exact_count, least(n, 5) AS returned FROM n")
ORACLES["a06_measured_two_phase"] = (
    f"WITH {E}, {MEANS}, {near_list(l2, 1)}, {near_list(l2, 3, name='p')}, n AS (SELECT p.vec_id AS query_id, count(*) AS n FROM p JOIN a ON a.list_id = p.list_id GROUP BY p.vec_id) "
    "SELECT query_id, (SELECT count(*) FROM embeddings) AS filtered_rows, n AS ann_count, least(n, 100) AS exact_count, least(n, 10) AS returned FROM n")
ORACLES["a07_index_stats"] = (
    f"WITH {E}, {MEANS}, {near_list(l2, 1)}, g AS (SELECT list_id, count(*) AS n FROM a GROUP BY list_id), t AS (SELECT sum(n)::DOUBLE AS total, count(*) AS lists FROM g) "
    f"SELECT list_id, n AS row_count, n AS vector_count, n * {DIM} * 4 AS vector_bytes, {r('n / total')} AS share, {r('n * lists / total')} AS skew FROM g, t")
