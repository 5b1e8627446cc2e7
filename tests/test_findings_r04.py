"""Cases of the findings of round 4."""

import random
import time
from datetime import datetime

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from cadenza.functions.features import FEATURES
from cadenza.plans import clustering as job
from cadenza.plans import draws, kmeans
from cadenza.sinks.tables import FREED_SHUFFLES, settings, write_once
from cadenza.suite import clustering as clustering_suite
from cadenza.suite import streams


def songs_frame(spark, n=900, seed=3):
    draw = random.Random(seed)
    rows = [(f"s{i}", *(round(draw.random(), 2) for _ in FEATURES)) for i in range(n)]
    return spark.createDataFrame(rows, "song_id string, " + ", ".join(f"{f} double" for f in FEATURES))


@pytest.fixture(scope="module")
def frame(spark):
    """Seven partitions, as MLlib gets them and as placed rows."""
    vector = array_to_vector(F.array(*FEATURES)).alias("v")
    rows = songs_frame(spark).repartition(7, "song_id").sortWithinPartitions("song_id").select("*", vector).persist()
    rows.count()
    yield rows
    rows.unpersist()


KS = (2, 5, 9)


@pytest.mark.parametrize("per_row", [3, 16])
def test_shared_fits_equal_mllib(spark, frame, tmp_path, monkeypatch, per_row):
    monkeypatch.setattr(kmeans, "POINTS_PER_ROW", per_row)
    monkeypatch.setattr(kmeans, "CHUNK", 50)
    # The place in the layout travels with the rows, so the fits may read them in any order and split.
    songs = write_once(kmeans.placed(frame.drop("v")), f"{tmp_path}/songs").repartition(3)
    points = kmeans.packed(songs.sortWithinPartitions("place"), FEATURES).persist()
    mine = kmeans.fit_all(points, len(FEATURES), KS, 42, 30, 1e-4, 7)
    for k, found, first in zip(KS, mine, kmeans.first_centres(points, len(FEATURES), KS, 42, 7)):
        common = {"k": k, "seed": 42, "featuresCol": "v", "predictionCol": "c"}
        start = KMeans(maxIter=0, **common).fit(frame.select("v"))
        assert np.allclose(first, start.clusterCenters(), rtol=0, atol=1e-12)
        model = KMeans(maxIter=30, tol=1e-4, **common).fit(frame.select("v"))
        assert np.allclose(found.centres, model.clusterCenters(), rtol=0, atol=1e-9)
        assert found.cost == pytest.approx(model.summary.trainingCost, rel=1e-6)
        assert found.sizes.tolist() == model.summary.clusterSizes
        assert found.silhouette == pytest.approx(ClusteringEvaluator(featuresCol="v", predictionCol="c").evaluate(model.transform(frame)), abs=1e-9)
    points.unpersist()


def test_few_distinct_points_give_fewer_centres(spark, tmp_path):
    rows = spark.createDataFrame([(i, float(i % 3), 0.0) for i in range(40)], "id int, x double, y double").repartition(2)
    points = kmeans.packed(write_once(kmeans.placed(rows), f"{tmp_path}/rows"), ["x", "y"]).persist()
    found = kmeans.fit_all(points, 2, [8], 42, 30, 1e-4, 2)[0]
    assert sorted(found.centres[:, 0].tolist()) == [0.0, 1.0, 2.0] and found.cost == 0.0 and found.silhouette == 1.0
    alone = kmeans.packed(write_once(kmeans.placed(rows.filter("x = 1")), f"{tmp_path}/alone"), ["x", "y"])
    with pytest.raises(ValueError, match="two clusters"):
        kmeans.fit_all(alone, 2, [2], 42, 30, 1e-4, 2)


def test_draws_are_those_of_spark(spark):
    state = draws.XorShift(42)
    numbers = [state.next_double() for _ in range(300)]
    assert draws.uniform(draws.XorShift.hashed(42), 0, 300).tolist() == numbers
    assert draws.uniform(draws.XorShift.hashed(42), 123, 40).tolist() == numbers[123:163]
    rows = spark.range(300).repartition(1).select(F.rand(42).alias("r")).collect()
    assert [r["r"] for r in rows] == numbers
    rdd = spark.sparkContext.parallelize(range(1000), 4)._to_java_object_rdd().rdd()
    for seed in (1, 99, -7):
        taken = spark._jvm.org.apache.spark.api.java.JavaRDD(rdd, spark._jvm.scala.reflect.ClassTag.Any()).takeSample(False, 1, seed)
        part, at = draws.taken_sample([250] * 4, seed)
        assert list(taken) == [part * 250 + at]


def shuffles_and_places(spark, rows, layout, path):
    written = write_once(rows, path, layout)
    return {r["song_id"]: r["place"] for r in written.select("song_id", "place").collect()}


def test_one_shuffle_gives_the_layout_of_the_ids(spark, tmp_path):
    names = {f: f.removesuffix("_norm") for f in FEATURES}
    raw = songs_frame(spark, 400).select("song_id", *[F.col(f).alias(names[f]) for f in FEATURES])
    raw = raw.unionByName(raw.filter("energy > 0.5")).select("*", F.lit("Rock").alias("main_genre"), F.array(F.lit("Rock")).alias("genres")).persist()
    before = {name: spark.conf.get(name, None) for name in FREED_SHUFFLES}
    two = shuffles_and_places(spark, job.training_frame(job.normalise_songs(raw), 13), FREED_SHUFFLES, f"{tmp_path}/two")
    laid, layout = job.laid_out(raw, 13)
    assert shuffles_and_places(spark, laid, layout, f"{tmp_path}/one") == two
    assert len(two) == 400 and max(p >> 33 for p in two.values()) <= 12
    with settings(spark, layout):
        plan = laid._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1
    assert {name: spark.conf.get(name, None) for name in FREED_SHUFFLES} == before


def test_a_sweep_keeps_no_copy_of_the_rows_for_each_fit(spark):
    names = {f: f.removesuffix("_norm") for f in FEATURES}
    raw = songs_frame(spark, 300).select("song_id", *[F.col(f).alias(names[f]) for f in FEATURES], F.lit("Rock").alias("main_genre"), F.array(F.lit("Rock")).alias("genres"))
    result = job.run_clustering(raw, job.ClusteringConfig("r4", candidate_ks=(2, 3, 4, 5), parallelism=4))
    stored = spark.sparkContext._jsc.getPersistentRDDs().size()
    result.release()
    assert stored - spark.sparkContext._jsc.getPersistentRDDs().size() <= 1
    assert result.metrics.filter("evaluation_scope = 'candidate'").count() == 4


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ")
    return {b for b in blocks.split(" ") if b.startswith("shuffle_")}


def test_a_written_step_leaves_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    kept = write_once(songs_frame(spark, 200).repartition(5, "song_id").groupBy("song_id").agg(F.max("energy").alias("e")), f"{tmp_path}/kept")
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and kept.count() == 200


def line_items(spark, folder):
    draw = random.Random(1)
    rows = [(i // 7, i % 50, i % 7 + 1, float(i % 50 + 1), 1000.0 + i, i % 11 / 100, i % 9 / 100, "ANR"[i % 3], datetime(1995, i % 12 + 1, i % 28 + 1)) for i in range(700)]
    rows += draw.sample(rows, 60)
    names = "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp"
    spark.createDataFrame(rows, names).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(i, f"TYPE {i % 5}") for i in range(50)], "p_partkey long, p_type string").write.parquet(f"{folder}/part.parquet")


def test_requests_are_compressed_and_no_table_of_songs_is_kept(spark, tmp_path, monkeypatch):
    line_items(spark, tmp_path)
    made = []

    def folder(session, name):
        made.append(name)
        return f"{tmp_path}/scratch/{name}"

    for module in (streams, clustering_suite):
        monkeypatch.setattr(module, "scratch_folder", folder)
    found = streams.stream_classify(spark, str(tmp_path)).collect()
    assert len(found) == 700 and {r["cluster_id"] for r in found if r["song_id"].endswith("-7")} == {-1}
    assert made == ["classify"]
    requests = [p for p in (tmp_path / "scratch/classify/requests").iterdir() if p.name.startswith("part-")]
    assert requests and all(p.name.endswith(".gz") for p in requests)
    means = spark.read.parquet(f"{tmp_path}/scratch/classify/means")
    assert means.count() == 7
