"""Key, reference and NULL checks with injected faults (Z3), topic checks."""

import pytest
from pyspark.sql import functions as F

from cadenza.operators import feeds
from cadenza.operators.audit import audit
from cadenza.session import scratch_folder


def test_injected_faults_are_found(spark):
    parents = spark.createDataFrame([(1,), (2,)], "run_id int")
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (3, "b"), (3, None), (None, "c")], "run_id int, song string")
    found = audit(rows, "t", ["run_id", "song"], ["run_id", "song"], [("run_id", parents, "run_id")])
    assert {(r.check_name, r.n_findings) for r in found.collect()} == {
        ("unique(run_id,song)", 1), ("foreign_key(run_id)", 2), ("not_null(run_id)", 1), ("not_null(song)", 1),
    }


def test_clean_table(spark):
    parents = spark.createDataFrame([(1,)], "run_id int")
    rows = spark.createDataFrame([(1, "a")], "run_id int, song string")
    found = audit(rows, "t", ["song"], ["song"], [("run_id", parents, "run_id")])
    assert {r.n_findings for r in found.collect()} == {0}


def test_topics(spark):
    sent = spark.createDataFrame([("a", 0, i) for i in range(8)] + [("b", 1, 4)], "topic string, partition int, offset int")
    expected = spark.createDataFrame([("a",), ("b",), ("c",)], "topic string")
    counts = {r.topic: (r.n_messages, r.status) for r in feeds.topic_counts(sent, expected).collect()}
    assert counts == {"a": (8, "ok"), "b": (1, "ok"), "c": (0, "empty")}
    peek = feeds.topic_peek(sent, "topic", ["partition", "offset"], 3).collect()
    assert sorted((r.topic, r.offset) for r in peek) == [("a", 0), ("a", 1), ("a", 2), ("b", 4)]


def test_centroid_panel(spark):
    rows = spark.range(30).select((29 - F.col("id")).alias("cluster_id"))
    assert [r.cluster_id for r in feeds.centroid_panel(rows, 20).collect()] == list(range(20))
    assert feeds.centroid_panel(rows).count() == 30


class ClusterSession:
    """A session on a cluster that names no shared folder."""

    class conf:
        @staticmethod
        def get(name, default):
            return default

    class sparkContext:
        master = "spark://host:7077"


def test_a_cluster_must_name_its_shared_folder(spark):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_folder(ClusterSession, "x")
    first, second = (scratch_folder(spark, "x") for _ in range(2))
    assert first != second
