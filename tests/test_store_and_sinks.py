"""S1.6, S9.1, S0.12, S8: stores and files survive reruns and failures, and engines may fail."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quire.operators import escalation, primitives
from quire.sources.files import write_html


def rows(spark, n, mark="a"):
    return spark.range(n).select(F.col("id").alias("prim_id"), F.lit(mark).alias("ch"))


def test_a_version_is_written_once(spark, tmp_path):
    path = f"file://{tmp_path}/s"
    assert primitives.versions(spark, path) == []
    assert primitives.write_store({"chars": rows(spark, 3), "rules": rows(spark, 2)}, path, 1)
    assert not primitives.write_store({"chars": rows(spark, 3), "rules": rows(spark, 2)}, path, 1)
    assert primitives.write_store({"chars": rows(spark, 5, "b")}, path, 2)
    assert [primitives.read_store(spark, path, "chars", v).count() for v in (1, 2)] == [3, 5] and primitives.read_store(spark, path, "rules", 1).count() == 2
    newest = primitives.read_store(spark, path, "chars")
    assert {(r.ch, r.store_version) for r in newest.collect()} == {("b", 2)} and primitives.versions(spark, path) == [1, 2]
    with pytest.raises(KeyError):
        primitives.read_store(spark, path, "rules", 2)


def test_writers_at_the_same_time(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/s"
    assert primitives.write_store({"chars": rows(spark, 3)}, path, 1)
    monkeypatch.setattr(primitives, "versions", lambda *_: [])  # as seen before the other one has committed
    assert not primitives.write_store({"chars": rows(spark, 3)}, path, 1)
    monkeypatch.undo()
    assert primitives.read_store(spark, path, "chars", 1).count() == 3 and primitives.cleaned(spark, path) == 0


def test_a_writer_that_dies_leaves_no_version(spark, tmp_path):
    path = f"file://{tmp_path}/s"
    bad = rows(spark, 4).withColumn("ch", F.when(F.col("prim_id") == 3, F.raise_error(F.lit("killed"))).otherwise("x"))
    with pytest.raises(Exception, match="killed"):
        primitives.write_store({"chars": rows(spark, 4), "rules": bad}, path, 1)
    assert primitives.versions(spark, path) == []
    assert primitives.write_store({"chars": rows(spark, 4), "rules": rows(spark, 4)}, path, 1)
    assert primitives.read_store(spark, path, "chars", 1).count() == 4
    assert primitives.cleaned(spark, path) >= 1 and primitives.read_store(spark, path, "rules", 1).count() == 4


def test_files_of_documents(spark, tmp_path):
    docs = spark.createDataFrame([("a/b", "<p>é</p>"), ("c", None), ("d", "two"), ("d", "one"), (None, "x"), *[(f"n{k}", str(k)) for k in range(40)]], "doc_id string, html string")
    path = tmp_path / "h"
    for _ in range(2):
        write_html(docs, str(path), folders=4)
        files = {f.name: f.read_text() for f in path.glob("*/*.html")}
        assert files == {"a%2Fb.html": "<p>é</p>", "c.html": "", "d.html": "one"} | {f"n{k}.html": str(k) for k in range(40)}
        assert len(list(path.iterdir())) <= 4  # folders of documents, none of a job
    write_html(docs.limit(0), str(tmp_path / "none"))
    assert not list(Path(tmp_path).glob("none/*"))


def test_a_failed_task_leaves_no_file(spark, tmp_path):
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.when(F.col("id") == 17, F.raise_error(F.lit("broken"))).otherwise("x").alias("html"))
    with pytest.raises(Exception, match="broken"):
        write_html(docs, str(tmp_path / "h"), folders=8)
    assert not list((tmp_path / "h").glob("**/*.html"))


def test_nodes_that_fail_do_not_stop_others(spark):
    def call(sources):
        if "slow" in sources:
            time.sleep(3)
        if "bad" in sources:
            raise ValueError("bad")
        return [(s, s != "never", 1.0) for s in sources]

    def second(sources):
        return [(s + "2", s != "never", 0.5) for s in sources if s != "short"]

    nodes = spark.createDataFrame([(1, "good"), (2, "bad"), (3, "slow"), (4, "never"), (None, "fine")], "node_id long, source string").coalesce(1)
    got = escalation.climb(nodes, [("one", escalation.Engine(lambda: call, timeout=0.5)), ("two", second)])
    rows_ = {(r.node_id, r.rung): (r.payload, r.invariants_ok, r.error) for r in got.collect()}
    assert rows_ == {
        (1, 0): ("good", True, None), (2, 0): (None, False, "ValueError: bad"), (3, 0): (None, False, "timeout"), (4, 0): ("never", False, None), (None, 0): ("fine", True, None),
        (2, 1): ("bad2", True, None), (3, 1): ("slow2", True, None), (4, 1): ("never2", False, None),
    }
    best = escalation.best_of(got, ["node_id"], [F.col("score").desc(), "rung", "payload"])
    assert {r.node_id: r.uncertain for r in escalation.settled(nodes, best).collect()} == {1: False, 2: False, 3: False, 4: True, None: False}
    few = escalation.climb(spark.createDataFrame([(1, "short"), (2, "long")], "node_id long, source string").coalesce(1), [("two", second)])
    assert {r.node_id: r.error for r in few.collect()} == {1: "ValueError: 0 results for 1 sources", 2: None}
    assert escalation.climb(nodes.limit(0), [("two", second)]).count() == 0


def test_engines_start_once_in_a_worker_and_get_batches_by_cost(spark):
    started, sizes = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def start():
        started.add(1)

        def call(sources):
            sizes.add(1)
            return [(s, True, 1.0) for s in sources]

        return call

    nodes = spark.createDataFrame([(k, "x", 4_000.0) for k in range(9)], "node_id long, source string, cost double").coalesce(1)
    assert escalation.climb(nodes, [("one", escalation.Engine(start))]).count() == 9
    assert started.value == 1 and sizes.value == 5
