from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from paperlake import session
from tests.plans import plan_of


class Conf(dict):
    set = dict.__setitem__


def stub(master, **options):
    return SimpleNamespace(conf=Conf(options), sparkContext=SimpleNamespace(master=master))


def test_scratch_is_the_folder_the_cluster_names():
    cluster = stub("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    first, second = (session.scratch_path(cluster, "x") for _ in range(2))
    assert first.startswith("hdfs:///shared/x-") and first != second


def test_only_a_local_session_may_fall_back_to_a_temporary_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_root(stub("yarn"))
    local = stub("local[2]")
    assert session.scratch_root(local) == session.scratch_root(local)


def test_materialize_cuts_the_lineage(spark):
    df = spark.range(5).withColumn("b", F.col("id") * 2)
    stored = session.materialize(df, "m")
    assert sorted(stored.collect()) == sorted(df.collect())
    assert "Range" not in plan_of(stored)


def test_materialized_files_take_a_codec(spark):
    assert all(name.endswith(".zstd.parquet") for name in session.materialize(spark.range(3), "m", "zstd").inputFiles())
