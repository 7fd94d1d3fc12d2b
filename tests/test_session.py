from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from lexharbor import schema
from lexharbor.session import bounded, cut, shared_dir, ship, spread


def test_cut_writes_to_the_shared_folder(spark):
    df = cut(spark.range(10).withColumn("r", F.rand()))
    assert df.collect() == df.collect()
    folder = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    assert folder.startswith(shared_dir(spark).removeprefix("file:").replace("//", "")) or shared_dir(spark).removeprefix("file://") in folder
    assert "LocalCheckpoint" not in df._jdf.queryExecution().toString()


def test_broadcast_only_within_the_bound(spark):
    small, large = spark.range(50), spark.range(1000).withColumnRenamed("id", "k")
    plan = lambda t: large.join(t, large.k == t.id)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(bounded(small, most_rows=50)) and "broadcast" not in plan(bounded(small, most_rows=49))


def test_spread_only_where_there_are_too_few_tasks(spark):
    cores = spark.sparkContext.defaultParallelism
    assert spread(spark.range(100).coalesce(1)).rdd.getNumPartitions() == cores
    many = spark.range(100).repartition(cores + 3)
    assert spread(many) is many


def test_package_is_sent_once(spark):
    ship(spark)
    before = len(spark.sparkContext._python_includes)
    ship(spark)
    assert len(spark.sparkContext._python_includes) == before


def test_types(spark):
    assert schema.CHUNK["content"].nullable is False and schema.CHUNK["char_start"].nullable and schema.EMBEDDING["v"].dataType.simpleString() == "array<float>"
    assert spark.createDataFrame([], schema.HIT).count() == 0


def test_a_cluster_must_name_its_shared_folder():
    def session(master, **conf):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: conf.get("folder", default)), sparkContext=SimpleNamespace(master=master, applicationId="a"))

    assert shared_dir(session("spark://x", folder="hdfs://shared")) == "hdfs://shared" and shared_dir(session("local[2]")).startswith("file://")
    with pytest.raises(RuntimeError):
        shared_dir(session("spark://x"))
