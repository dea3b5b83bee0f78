"""Plans and results when no table is small enough to broadcast, and under skew."""

import contextlib
import io
import tempfile

import pytest
from compare import connect, difference
from conftest import SF
from pyspark.sql import functions as F

import __spark_entry__ as entry
from yardstar.functions.lookups import lookup
from yardstar.operators.keys import assign_keys
from yardstar.operators.snapshot import every_yard

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture
def conf(spark):
    """Set session values for one test."""
    old = {}

    def put(**values):
        for k, v in values.items():
            k = k.replace("__", ".")
            old.setdefault(k, spark.conf.get(k, None))
            spark.conf.set(k, v)

    yield put
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


NO_BROADCAST = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
}


@pytest.mark.parametrize(
    "name",
    [
        "fact_rental",
        "fact_reservation",
        "yard_snapshot",
        "dim_vehicle",
        "report_a_latest",
        "report_c_next_week",
        "report_d_group_by_city",
        "markov_matrix",
        "own_or_foreign",
        "audit_orphans",
        "src_open_reservations",
    ],
)
def test_without_broadcasts(spark, conf, name):
    conf(**NO_BROADCAST)
    df = QUERIES[name](spark, SF)
    assert difference(df, connect(SF), ORACLES[name]) is None
    text = plan(df)
    assert "BroadcastHashJoin" not in text
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


def hot(spark, n=200_000):
    """Rentals of which every second one belongs to client 7 and the rest to 5000 others."""
    return spark.range(n).select(
        F.col("id").alias("rental"),
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 5000).cast("bigint").alias("client"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )


@pytest.mark.parametrize("lowest", [False, True])
def test_a_hot_key_is_split_and_complete(spark, conf, lowest):
    conf(
        **NO_BROADCAST,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
    )
    left = hot(spark).repartition(8)
    right = spark.range(5000).select("id", (F.col("id") * 10).alias("v"))
    df = lookup(left, right, {"client": "id"}, {"v": "sk"}, lowest=lowest, hot=lowest).select("rental", "client", "sk", F.length("payload"))
    rows = df.collect()
    assert len(rows) == 200_000 and all(r["sk"] == r["client"] * 10 for r in rows)
    assert "skew=true" in plan(df)


def test_null_keys_are_scattered(spark, conf):
    conf(**NO_BROADCAST, spark__sql__adaptive__enabled="false")
    left = spark.range(80_000).select(
        F.col("id"), F.when(F.col("id") % 4 == 0, F.col("id")).cast("bigint").alias("k")
    )
    right = spark.range(80_000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    for spread, biggest in (((), 60_000), (("id",), 30_000)):
        df = lookup(left, right, {"k": "k"}, {"v": "v"}, spread_nulls_by=spread)
        sizes = [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 80_000
        assert (max(sizes) >= biggest) if not spread else (max(sizes) < biggest)


def test_one_source_with_every_vehicle_is_spread_over_the_yards(spark, conf):
    conf(**NO_BROADCAST, spark__sql__adaptive__enabled="false")
    vehicles = spark.range(1000).select(F.lit("G1").alias("fonte_grupo"), F.col("id").alias("sk_veiculo"))
    yards = spark.range(30).select(F.lit("G1").alias("fonte_grupo"), F.col("id").alias("sk_patio"))
    df = every_yard(vehicles.repartition(2), yards.repartition(2))
    sizes = [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 30_000 and len(sizes) > 1 and max(sizes) < 20_000
    assert df.distinct().count() == 30_000


def test_keys_of_one_large_source_use_many_partitions(spark):
    keys = spark.range(50_000).select(F.lit("G1").alias("fonte_grupo"), (F.col("id") * 3).alias("id"))
    folder = tempfile.mkdtemp(prefix="yardstar-keys-")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = assign_keys(keys, ["fonte_grupo", "id"], folder)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    placed = spark.read.parquet(folder).groupBy(F.shiftright("__at", 33)).count().collect()
    assert len(placed) == 4 and max(r[1] for r in placed) < 25_000
    wrong = got.where(F.col("sk") != F.col("id") / 3 + 1)
    assert got.count() == 50_000 and wrong.count() == 0
