import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import ids, nearest, query, table, uniform
from vicinal.functions import vectors as V
from vicinal.operators.knn import knn_join
from vicinal.sources import index as X
from vicinal.sources import models as M
from vicinal.sources import vectors as I
from vicinal.spec import SpecError, VectorSpec
from vicinal.streaming import tables as T
from vicinal.workload.tables import rounded

IVF = VectorSpec(8, method="ivf", params={"nlist": 4, "nprobes": 4})


def test_validation(spark):
    rows = {0: [1, 2], 1: [float("nan"), 1], 2: [1, float("inf")], 3: [1, 2, 3], 4: [0, 0], 5: None}
    df = table(spark, rows)
    good, bad = I.validate_vectors(df, VectorSpec(2, space="cosinesimil"), on_error="quarantine")
    assert {r.id: r.problem for r in bad.collect()} == {1: "NaN", 2: "infinity", 3: "wrong dimension", 4: "zero vector"}
    assert {r.id for r in good.collect()} == {0, 5}
    assert {r.id for r in I.validate_vectors(df, VectorSpec(2), on_error="quarantine")[0].collect()} == {0, 4, 5}
    with pytest.raises(Exception, match="invalid vector: NaN"):
        I.validate_vectors(df.where("id = 1"), VectorSpec(2)).collect()
    bytes_ = table(spark, {0: [1, 127], 1: [1.5, 0], 2: [128, 0]})
    assert {r.id: r.problem for r in I.validate_vectors(bytes_, VectorSpec(2, "byte"), on_error="quarantine")[1].collect()} == {
        1: "not a whole number", 2: "outside the byte range"}


def test_encode_and_decode(spark):
    df = table(spark, {0: [1.5, -2.25], 1: None, 2: [0.1, 3e7]})
    text = I.encode_vectors(df, "vec")
    assert text.schema["vec"].dataType.simpleString() == "string"
    assert text.orderBy("id").first().vec == "AADAPwAAEMA="
    assert I.decode_vectors(text, "vec", VectorSpec(2)).exceptAll(df).count() == 0
    long = table(spark, uniform(20, 100, 1))
    assert "\n" not in I.encode_vectors(long, "vec").first().vec
    assert I.decode_vectors(I.encode_vectors(long, "vec"), "vec", VectorSpec(100)).exceptAll(long).count() == 0
    assert I.decode_vectors(text.withColumn("vec", F.unbase64("vec")), "vec", VectorSpec(2)).exceptAll(df).count() == 0
    assert I.encode_vectors(df, "vec", "array") is df
    for value in ("AAA=", "!!!!", "AADAPw=="):
        with pytest.raises(Exception):
            I.decode_vectors(spark.createDataFrame([(value,)], "vec string"), "vec", VectorSpec(2)).collect()
    numbers = spark.createDataFrame([(1.5,), (None,)], "vec double")
    assert [r.vec for r in I.decode_vectors(numbers, "vec", VectorSpec(1)).collect()] == [[1.5], None]
    with pytest.raises(SpecError):
        I.decode_vectors(numbers, "vec", VectorSpec(2))


def test_reading_and_projection(spark, tmp_path):
    path = str(tmp_path / "v")
    df = spark.createDataFrame([(1, [1.0], ("x", [2.0]))], "id int, vec array<double>, doc struct<name:string,vec:array<double>>")
    df.write.parquet(path)
    read = I.read_vectors(spark, path, VectorSpec(1), columns=["id"])
    assert read.schema["vec"].dataType.simpleString() == "array<float>" and read.columns == ["id", "vec"]
    assert "name" not in read._jdf.queryExecution().executedPlan().toString()
    assert I.select_fields(df, excludes=["*vec"]).schema.simpleString() == "struct<id:int,doc:struct<name:string>>"
    assert I.select_fields(df, includes=["doc"]).columns == ["doc"]
    assert I.select_fields(df, includes=["doc.*"], excludes=["doc.vec"]).schema.simpleString() == "struct<doc:struct<name:string>>"
    with pytest.raises(SpecError):
        I.forbid_vector_sort(df, "vec")
    with pytest.raises(SpecError):
        I.read_vectors(spark, path, VectorSpec(8, "binary"))
    assert df.where(V.has_vector("vec")).count() == 1


@pytest.fixture
def corpus(spark):
    return table(spark, uniform(200, 8, 1)).withColumn("label", (F.col("id") % 3).cast("int")).repartition(3)


def test_index_round_trip_and_changes(spark, corpus, tmp_path):
    path, q = str(tmp_path / "index"), query(spark, *uniform(10, 8, 2))
    c = uniform(200, 8, 1)
    index = X.write_index(corpus, M.fit_model(corpus, IVF, iterations=3), path)
    assert ids(knn_join(q, index, 5, mode="ivf")) == nearest("l2", uniform(10, 8, 2), c, 5).tolist()
    pruned = knn_join(q.limit(1), index, 5, mode="ivf", nprobes=1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(list_id" in pruned or "PartitionFilters: [list_id" in pruned
    fresh = table(spark, {0: [9] * 8, 500: [9] * 8}).withColumn("label", F.lit(7))
    index = X.apply_changes(spark, path, fresh, spark.createDataFrame([(3,), (4,)], "id bigint"))
    assert index.df.count() == 199
    hits = knn_join(query(spark, [9] * 8), index, 2, mode="ivf").collect()
    assert sorted(r.id for r in hits) == [0, 500] and all(r.distance == 0 for r in hits)
    before = sorted(map(tuple, index.df.select("id", "vec", "list_id").collect()))
    # Writing the same change again changes nothing.
    named = dict(writer="w", batch=0)
    for _ in range(2):
        again = X.apply_changes(spark, path, fresh, spark.createDataFrame([(3,), (4,)], "id bigint"), **named)
    assert sorted(map(tuple, again.df.select("id", "vec", "list_id").collect())) == before and X.commits(spark, path).count() == 3
    # What a job left behind that was lost before its commit is not read.
    X._write(fresh, again.model, path, "lost", encode=True)
    fresh.select("id").withColumn("at", F.lit(None).cast("double")).write.parquet(f"{path}/gone/change=lost")
    assert sorted(map(tuple, X.open_index(spark, path).df.select("id", "vec", "list_id").collect())) == before
    with pytest.raises(SpecError):
        X.write_index(corpus, again.model, path)
    # A deleted id may come back.
    back = X.apply_changes(spark, path, table(spark, {3: [8] * 8}).withColumn("label", F.lit(1)))
    assert back.df.where("id = 3").count() == 1 and back.df.count() == 200
    whole = X.compact_index(spark, path, str(tmp_path / "whole"))
    columns = sorted(back.df.columns)
    assert whole.df.select(columns).exceptAll(back.df.select(columns)).count() == 0 and whole.df.count() == 200
    with pytest.raises(SpecError):
        X.compact_index(spark, path, path)


def test_merge_changes_on_frames(spark, corpus):
    up = table(spark, {0: [9] * 8}).withColumn("label", F.lit(7))
    got = X.merge_changes(corpus, up, spark.createDataFrame([(3,)], "id bigint"))
    assert got.count() == 199 and got.where("label = 7").count() == 1


def test_a_hot_list_is_spread_over_files(spark, tmp_path):
    c = uniform(300, 8, 1)
    c[:200] = c[0]
    path = str(tmp_path / "hot")
    df = table(spark, c)
    index = X.write_index(df, M.fit_model(df, IVF, iterations=3), path, rows_per_file=40)
    files = index.df.select("list_id", F.input_file_name().alias("f")).groupBy("list_id").agg(
        F.count("*").alias("n"), F.count_distinct("f").alias("files")).toPandas()
    hot = files.loc[files.n.idxmax()]
    assert hot.n >= 200 and hot.files >= 4
    stats = X.index_stats(index).toPandas()
    assert stats.row_count.sum() == 300 and stats.share.sum() == pytest.approx(1.0)


def test_plain_tables(spark, corpus, tmp_path):
    model = M.fit_model(corpus, IVF, iterations=1)
    for n, plain in enumerate((True, False)):
        index = X.write_index(corpus, model, str(tmp_path / f"t{n}"), plain=plain)
        assert (index.model.centroids is None) == plain == ("list_id" not in index.df.columns)


def test_auto_mode(spark, corpus, tmp_path):
    q = query(spark, *uniform(10, 8, 2))
    index = X.write_index(corpus, M.fit_model(corpus, VectorSpec(8, method="ivf", params={"nlist": 20, "nprobes": 1}), iterations=3), str(tmp_path / "i"))
    auto = dict(mode="auto", explain=True, metrics=True)
    exact = knn_join(q, index, 5, filter="label = 1", threshold=67, **auto)
    assert {r.explain.search_type for r in exact.collect()} == {"Exact"} and exact.first().exact_count == 67
    assert ids(exact) == ids(knn_join(q, corpus, 5, filter="label = 1"))
    assert knn_join(q, index, 5, filter="label = 9", **auto).count() == 0
    few = knn_join(q, index, 100, filter="label = 1", **auto)
    assert few.count() == 670 and "all of which are hits" in few.first().explain.reason
    ann = knn_join(q, index, 2, filter="label = 1", threshold=10, **auto)
    assert "Approximate-NN" in {r.explain.search_type for r in ann.collect()} and ann.count() == 20
    # Lists hold about ten rows, so most queries fall back.
    full = knn_join(q, index, 60, **auto)
    assert full.count() == 600
    asked = q.withColumn("want", (F.col("query_id") % 3).cast("int"))
    for how in (dict(mode="auto"), dict(mode="auto", threshold=1000), dict(mode="ivf", fill="exact")):
        got = knn_join(asked, index, 60, on=[("want", "label")], keep=["label"], **how)
        assert got.count() == 600 and got.where("label <> query_id % 3").count() == 0
    filled = knn_join(q, index, 60, mode="ivf", fill="exact")
    assert ids(filled) == ids(full.drop("explain"))
    with pytest.raises(SpecError):
        knn_join(q, corpus, 5, fill="exact")
    short = knn_join(q, index, 60, fallback=False, **auto)
    assert short.count() < 600


def test_model_life_cycle(spark, corpus, tmp_path):
    path = str(tmp_path / "models")
    assert M.models(spark, path).count() == 0
    model = M.train_model(corpus, "a", IVF, path, description="first", iterations=2)
    row = M.models(spark, path).first()
    assert (row.model_id, row.state, row.dimension, row.space, row.method, row.description) == ("a", "created", 8, "l2", "ivf", "first")
    loaded = M.load_model(spark, path, "a")
    assert np.array_equal(loaded.centroids, model.centroids) and loaded.spec.params == IVF.params
    for bad in (dict(model_id="a", spec=IVF), dict(model_id="b", spec=VectorSpec(8)), dict(model_id="b", spec=VectorSpec(9, method="ivf")),
                dict(model_id="b", spec=IVF, description="a,b"), dict(model_id="b", spec=IVF, description="x" * 1001)):
        with pytest.raises(SpecError):
            M.train_model(corpus, path=path, **bad)
    with pytest.raises(SpecError):
        M.train_model(corpus, "c", VectorSpec(8, encoder="pq", params={"m": 2}), path)
    failed = M.models(spark, path).where("model_id = 'c'").first()
    assert failed.state == "failed" and "256 distinct" in failed.error
    with pytest.raises(SpecError):
        M.load_model(spark, path, "c")
    M.drop_model(spark, path, "a")
    assert M.models(spark, path).where("model_id = 'a'").count() == 0
    with pytest.raises(SpecError):
        M.drop_model(spark, path, "a")
    bits = M.train_model(corpus, "d", IVF, path, quantize_bits=1, max_training_vectors=100, iterations=2)
    assert bits.centroids.min() >= 0 and bits.centroids.max() <= 1
    wide = M.train_model(corpus, "e", IVF, path, quantize_bits=2, iterations=1)
    assert wide.centroids.shape[1] == 16 == M.load_model(spark, path, "e").spec.dimension


@pytest.mark.parametrize("spec", [VectorSpec(8, encoder="binary", params={"bits": 2, "random_rotation": True}), VectorSpec(8, encoder="sq1"),
                                  VectorSpec(8, encoder="sq7"), VectorSpec(8, encoder="fp16"), VectorSpec(8, method="ivf", encoder="pq", params={"m": 2, "code_size": 3})])
def test_stored_models_encode_alike(spark, corpus, tmp_path, spec):
    model = M.fit_model(corpus, spec, iterations=2)
    M.save_model(spark, str(tmp_path / "m"), model, "x")
    again = M.load_model(spark, str(tmp_path / "m"), "x")
    assert again.encode(corpus).exceptAll(model.encode(corpus)).count() == 0


def test_streams(spark, corpus, tmp_path):
    at = lambda name: str(tmp_path / name)
    X.write_index(corpus.where("id < 100"), M.fit_model(corpus, IVF, iterations=2), at("index"))
    for n, cond in enumerate(("id between 100 and 149", "id >= 150")):
        corpus.where(cond).coalesce(1).write.mode("append").parquet(at("in"))
    bad = table(spark, {900: [float("nan")] * 8}).withColumn("label", F.lit(0))
    bad.coalesce(1).write.mode("append").parquet(at("in"))
    stream = spark.readStream.schema(corpus.schema).option("maxFilesPerTrigger", 1).parquet(at("in"))
    T.stream_into_index(stream, at("index"), at("c1"), bad_rows=at("bad")).awaitTermination()
    index = X.open_index(spark, at("index"))
    assert index.df.count() == 200 and spark.read.parquet(at("bad")).first().problem == "NaN"
    # Nothing new: a restart adds nothing.
    T.stream_into_index(stream, at("index"), at("c1"), bad_rows=at("bad")).awaitTermination()
    assert X.open_index(spark, at("index")).df.count() == 200
    change = "id bigint, vec array<float>, label int, op string, ts int"
    spark.createDataFrame([(1, [5.0] * 8, 0, "upsert", 1), (1, [6.0] * 8, 0, "upsert", 2), (2, None, 0, "delete", 1), (3, None, 0, "delete", 1),
                           (3, [7.0] * 8, 0, "upsert", 2)], change).coalesce(1).write.parquet(at("changes"))
    changes = spark.readStream.schema(change).parquet(at("changes"))
    # A second writer in between, and a batch change, lose nothing.
    X.apply_changes(spark, at("index"), table(spark, {199: [4] * 8}).withColumn("label", F.lit(2)))
    T.stream_changes(changes, at("index"), at("c2")).awaitTermination()
    assert X.open_index(spark, at("index")).df.where("id = 199").first().vec[0] == 4.0
    # Rows that are older than what was applied come too late; an unknown change stops the stream.
    spark.createDataFrame([(1, [1.0] * 8, 0, "upsert", 1), (2, [2.0] * 8, 0, "upsert", 0), (3, None, 0, "delete", 1)], change).coalesce(1).write.mode("append").parquet(at("changes"))
    T.stream_changes(changes, at("index"), at("c2")).awaitTermination()
    spark.createDataFrame([(1, None, 0, "remove", 9)], change).coalesce(1).write.parquet(at("odd"))
    with pytest.raises(Exception, match="unknown change"):
        T.stream_changes(spark.readStream.schema(change).parquet(at("odd")), at("index"), at("c4")).awaitTermination()
    # An id that is stored is replaced by the append stream.
    table(spark, {150: [3] * 8}).withColumn("label", F.lit(1)).select(corpus.columns).coalesce(1).write.mode("append").parquet(at("in"))
    T.stream_into_index(stream, at("index"), at("c1"), bad_rows=at("bad")).awaitTermination()
    assert [r.vec[0] for r in X.open_index(spark, at("index")).df.where("id = 150").collect()] == [3.0]
    index = X.open_index(spark, at("index"))
    assert index.df.count() == 199
    assert {r.id: r.vec[0] for r in index.df.where("id in (1, 2, 3)").collect()} == {1: 6.0, 3: 7.0}
    query(spark, *uniform(6, 8, 3)).coalesce(1).write.parquet(at("q"))
    asks = spark.readStream.schema("query_id bigint, query_vec array<float>").parquet(at("q"))
    T.stream_knn(asks, index, 3, "l2", at("out"), at("c3"), mode="ivf").awaitTermination()
    got = spark.read.parquet(at("out")).drop("batch")
    want = knn_join(spark.read.parquet(at("q")), index, 3, mode="ivf")
    assert got.exceptAll(want).count() == 0 and got.count() == 18


def test_an_id_twice_in_one_change(spark, corpus, tmp_path):
    path = str(tmp_path / "twice")
    X.write_index(corpus, M.fit_model(corpus, IVF, iterations=1), path)
    rows = spark.createDataFrame([(1, [5.0] * 8, 0, 3), (1, [6.0] * 8, 0, 9), (1, [7.0] * 8, 0, 4), (2, [8.0] * 8, 0, 1)], "id bigint, vec array<float>, label int, at int")
    with pytest.raises(SpecError, match="more than once"):
        X.apply_changes(spark, path, rows.drop("at"))
    n = corpus.count()
    assert X.open_index(spark, path).df.count() == n
    index = X.apply_changes(spark, path, rows, order="at")
    assert index.df.count() == n and {r.id: r.vec[0] for r in index.df.where("id in (1, 2)").collect()} == {1: 6.0, 2: 8.0}


def test_streams_that_start_again_and_ids_twice_in_a_batch(spark, corpus, tmp_path):
    import shutil

    at = lambda name: str(tmp_path / name)
    X.write_index(corpus.where("id < 50"), M.fit_model(corpus, IVF, iterations=1), at("index"))
    twice = corpus.where("id = 60").union(corpus.where("id = 60")).union(corpus.where("id = 61").withColumn("label", F.lit(9)))
    twice.coalesce(1).write.parquet(at("a"))
    T.stream_into_index(spark.readStream.schema(corpus.schema).parquet(at("a")), at("index"), at("c")).awaitTermination()
    assert X.open_index(spark, at("index")).df.where("id in (60, 61)").count() == 2
    # The checkpoint is deleted and started again over other rows: its batch 0 is not the batch 0 that was committed.
    shutil.rmtree(at("c"))
    corpus.where("id between 70 and 79").coalesce(1).write.parquet(at("b"))
    T.stream_into_index(spark.readStream.schema(corpus.schema).parquet(at("b")), at("index"), at("c")).awaitTermination()
    assert X.open_index(spark, at("index")).df.where("id between 70 and 79").count() == 10
    assert X.commits(spark, at("index")).where("writer is not null").select("writer").distinct().count() == 2


def test_two_changes_with_one_number(spark, corpus, tmp_path, monkeypatch):
    path = str(tmp_path / "race")
    X.write_index(corpus, M.fit_model(corpus, IVF, iterations=1), path)
    number = X.commits(spark, path).first().number + 5

    def same(spark, path, change, writer=None, batch=None):
        spark.createDataFrame([(change, number, writer, batch)], X.COMMIT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/commits")

    monkeypatch.setattr(X, "_commit", same)
    for value in (3.0, 4.0):
        X.apply_changes(spark, path, table(spark, {7: [value] * 8}).withColumn("label", F.lit(0)))
    assert X.open_index(spark, path).df.where("id = 7").count() == 1 and X.open_index(spark, path).df.count() == corpus.count()


def test_six_decimals_are_those_of_round(spark):
    rng = np.random.default_rng(51)
    near = np.round(rng.uniform(-3, 3, 20_000), 6)
    odd = [0.0, -0.0, -1e-9, 5e-7, -5e-7, 0.0000005, 1.0000005, 2.5e-6, 999.9999995, 1000.0000005, 1e15, -1e300, float("nan"), float("inf"), float("-inf"), None]
    values = [*rng.uniform(-3, 3, 100_000), *rng.uniform(-2000, 2000, 20_000), *(rng.standard_normal(20_000) * 1e-6), *near, *(near + 5e-7), *np.nextafter(near + 5e-7, 0)]
    df = spark.createDataFrame([(None if x is None else float(x),) for x in [*values, *odd]], "x double").withColumn("y", F.col("x"))
    bits = lambda n: F.hex(F.col(n).cast("string").cast("binary"))
    assert rounded(df, "x").withColumn("y", F.round("y", 6)).where(~bits("x").eqNullSafe(bits("y"))).count() == 0
    assert rounded(spark.range(3).withColumn("z", F.lit(1.25).cast("float")), "id", "z").dtypes == [("id", "bigint"), ("z", "float")]
