"""Session and staging helpers."""

import os
import threading
from pathlib import Path

import pytest

import __spark_entry__ as entry
from loamline import staging
from loamline.catalog import queries_storage
from loamline.config import PipelineConfig, range_dim
from loamline.plans.pipeline import run_pipeline
from loamline.rows import local_frame
from loamline.session import shuffle_partitions, sized_shuffles
from loamline.staging import Scope, _own_disk, new_path, share, shared_root, stage
from tests.oracle import compare, connect


def test_shuffle_counts_are_bounded():
    gb = 1024**3
    assert shuffle_partitions(0) == 1
    assert shuffle_partitions(gb) == 16
    assert shuffle_partitions(1024 * gb) == 2_048
    assert shuffle_partitions(100 * 1024 * gb) == 20_000
    sizes = [shuffle_partitions(x * gb) for x in range(1, 4_000, 7)]
    assert sizes == sorted(sizes)


def test_shuffles_are_only_raised_and_restored(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with sized_shuffles(spark, 0) as count:
        assert count == int(before)
    with sized_shuffles(spark, 10 * 1024**3) as count:
        assert count == 160 and spark.conf.get(key) == "160"
    assert spark.conf.get(key) == before
    with pytest.raises(KeyError), sized_shuffles(spark, 10 * 1024**3):
        raise KeyError
    assert spark.conf.get(key) == before


def test_dimensions_are_local_relations(spark):
    plan = range_dim(spark, PipelineConfig())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("LocalRelation")
    assert local_frame(spark, [], "a int, b timestamp").count() == 0


def test_scope_drops_its_tables_only(spark):
    outside = stage(spark.range(3).toDF("x"), "kept")
    with Scope(spark) as scope:
        inside = stage(spark.range(5).toDF("x"), "dropped")
        assert inside.count() == 5
    assert scope.drop() == 1 and scope.drop() == 0
    assert outside.count() == 3
    with pytest.raises(Exception):
        inside.count()


def test_staging_follows_the_cluster_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_root(spark) == configured.rstrip("/")
    else:
        assert "loamline-stage-" in shared_root(spark)


def test_scopes_of_threads_are_their_own(spark):
    seen, ready, go = {}, threading.Barrier(2), threading.Barrier(2)

    def run(name):
        with Scope(spark) as scope:
            ready.wait()
            path = new_path(spark, name)
            go.wait()
            seen[name] = (path, list(scope.paths))

    threads = [threading.Thread(target=run, args=(n,)) for n in ("one", "two")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert all(paths == [path] for path, paths in seen.values())


def test_a_failing_scope_leaves_no_table(spark):
    with pytest.raises(KeyError), Scope(spark):
        left = stage(spark.range(4).toDF("x"), "left")
        raise KeyError
    with pytest.raises(Exception):
        left.count()


def test_machine_local_folders_are_told(spark):
    assert _own_disk(spark, "file:///tmp/x") and not _own_disk(spark, "hdfs://name/x")
    spark.conf.set("spark.loamline.sharedMount", "true")
    try:
        assert not _own_disk(spark, "file:///mnt/x")
    finally:
        spark.conf.unset("spark.loamline.sharedMount")


@pytest.fixture
def cluster(spark, monkeypatch):
    """The session as one of a cluster whose folders are mounted under local paths."""
    monkeypatch.setattr(spark.sparkContext, "master", "spark://driver:7077")
    monkeypatch.setattr(staging, "_proven", set())
    return spark


@pytest.mark.parametrize("name", ["agg_type_moments", "agg_profile", "gen_gap_spans", "prj_outlier_flag"])
def test_queries_stage_in_a_mounted_folder(cluster, name):
    sf_dir = "/root/testdata/sf0.001"
    found, sql = entry.queries()[name], entry.oracle_sql()[name]
    assert compare(cluster, connect(sf_dir), found, sql, sf_dir) is None
    assert staging._proven == {(cluster.sparkContext.applicationId, _cluster_folder(cluster))}


def _cluster_folder(spark):
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")


def test_a_folder_is_tried_once_and_left_clean(cluster, tmp_path):
    assert staging._seen_by_all(cluster, f"file://{tmp_path}")
    assert not [f for f in tmp_path.rglob("*") if f.is_file()]


def test_folders_that_machines_do_not_share_are_refused(cluster, monkeypatch):
    monkeypatch.setattr(staging, "_seen_by_all", lambda spark, folder: False)
    with pytest.raises(ValueError, match="own disk"):
        shared_root(cluster)
    assert not staging._proven


def test_executors_of_a_local_cluster_have_their_own_folders(spark, monkeypatch):
    for master, one in (("local", True), ("local[4]", True), ("local-cluster[3,2,3000]", False), ("yarn", False)):
        monkeypatch.setattr(spark.sparkContext, "master", master)
        assert staging._one_process(spark) is one


# Spelled so that no other test has its shared tables.
SF_DIR = "/root/testdata/./sf0.001"


def _answers(spark, name, result):
    """The difference between a result and its SQL, None if there is none."""
    return compare(spark, connect(SF_DIR), lambda *_: result, entry.oracle_sql()[name], SF_DIR)


def test_a_shared_table_outlives_the_query_that_made_it(spark):
    first = entry.queries()["agg_stored_coverage"](spark, SF_DIR)
    history = entry.queries()["cmp_batch_history"](spark, SF_DIR)
    first.staged.drop()
    assert _answers(spark, "cmp_batch_history", history) is None
    history.staged.drop()


def test_a_landing_folder_outlives_the_query_that_made_it(spark, monkeypatch):
    first = entry.queries()["cmp_batch_output"](spark, SF_DIR)

    def run(*args, **options):
        first.staged.drop()  # as by another thread, after the folder was found
        return run_pipeline(*args, **options)

    monkeypatch.setattr(queries_storage, "run_pipeline", run)
    metrics = entry.queries()["cmp_batch_metrics"](spark, SF_DIR)
    assert _answers(spark, "cmp_batch_metrics", metrics) is None
    metrics.staged.drop()


def _shared_table(spark, made):
    def make():
        path = new_path(spark, "numbers")
        spark.range(10).repartition(2).write.parquet(path)
        made.append(path)
        return path

    return share(spark, "numbers", "here", make)


def test_shared_tables_go_with_their_last_holder(spark):
    made = []
    with Scope(spark) as first:
        _shared_table(spark, made)
    with Scope(spark) as second:
        path = _shared_table(spark, made)
    assert made == [path] and not first.paths and not second.paths
    first.drop()
    assert spark.read.parquet(path).count() == 10
    second.drop()
    assert not os.path.exists(path.removeprefix("file:"))
    with Scope(spark) as third:
        assert _shared_table(spark, made) != path
    third.drop()


def test_shared_tables_that_lost_files_are_made_again(spark):
    made = []
    with Scope(spark) as first:
        path = _shared_table(spark, made)
    next(f for f in Path(path.removeprefix("file:")).glob("part-*")).unlink()
    with Scope(spark) as second:
        again = _shared_table(spark, made)
    first.drop()
    assert again != path and spark.read.parquet(again).count() == 10
    second.drop()
