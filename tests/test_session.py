"""Settings, the shared folder, and kept intermediate results."""

import tempfile
from types import SimpleNamespace

import pytest

from pyspark.sql import functions as F

from tableferry import InvalidState
from tableferry.session import apply_settings, cut_lineage, shared_folder


def session(master, **settings):
    conf = SimpleNamespace(get=lambda key, default=None: settings.get(key.replace(".", "_"), default))
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_the_shared_folder():
    named = session("yarn", spark_checkpoint_dir="hdfs:///kept/", spark_sql_warehouse_dir="hdfs:///tables")
    assert shared_folder(named) == "hdfs:///kept"
    # A cluster that names none gets a folder next to its tables if that is shared, never a local one.
    assert shared_folder(session("yarn", spark_sql_warehouse_dir="hdfs:///tables")) == "hdfs:///tables/_tableferry"
    for master in ("yarn", "local-cluster[3,2,1024]"):
        for tables in (None, "/user/hive/warehouse", "file:/tmp/warehouse"):
            with pytest.raises(InvalidState):
                shared_folder(session(master, spark_sql_warehouse_dir=tables))
    for master in ("local", "local[2]", "local[*]", "local[4,2]"):
        assert shared_folder(session(master)).startswith(tempfile.gettempdir())
    assert shared_folder(session("local[2]")) == shared_folder(session("local[*]"))


def test_kept_results_are_not_computed_again(spark):
    counter = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(v):
        counter.add(1)
        return v

    kept = cut_lineage(spark.range(10).select(counted("id").alias("v")))
    computed = counter.value
    assert kept.agg(F.sum("v")).first()[0] == 45 and kept.count() == 10
    assert counter.value == computed


def test_settings_apply_to_a_running_session(spark):
    apply_settings(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
