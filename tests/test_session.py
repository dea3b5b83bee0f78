"""The shared folder, and settings that results depend on."""

from types import SimpleNamespace

import pytest
from pyspark.errors import NumberFormatException
from pyspark.sql import functions as F

from yardstar import session


def fake(master, **conf):
    context = SimpleNamespace(
        master=master,
        applicationId="app",
        getConf=lambda: SimpleNamespace(get=lambda key: conf.get(key.replace(".", "_"))),
        setCheckpointDir=lambda folder: None,
    )
    return SimpleNamespace(sparkContext=context)


def test_the_clusters_folder_is_used():
    assert session.shared_dir(fake("spark://host:1", spark_checkpoint_dir="/shared/x/")) == "/shared/x"


def test_a_cluster_without_one_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(fake("spark://host:1"))


def test_a_local_session_gets_one_of_its_own():
    a = session.shared_dir(fake("local[2]"))
    assert a == session.shared_dir(fake("local[2]")) and "yardstar-" in a


def test_settings_are_applied(spark):
    for key, value in session.RUNTIME_CONF.items():
        assert spark.conf.get(key) == value


def test_bad_year_text_raises(spark):
    df = spark.createDataFrame([("20x9",)], "ano string").select(F.col("ano").cast("int"))
    with pytest.raises(NumberFormatException):
        df.collect()


def test_money_overflow_raises(spark):
    df = spark.sql("SELECT CAST(CAST(99999999.99 AS DECIMAL(10,2)) * 2 AS DECIMAL(10,2)) AS v")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        df.collect()
