import pytest
from pyspark.sql import functions as F

from slackline import session
from slackline.functions import joins
from tests.conftest import values


@pytest.fixture
def fact(spark):
    # Key 0 holds a third of all rows.
    return spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).cast("int").alias("k"), "id"
    )


@pytest.fixture
def dim(spark):
    return spark.range(45).select(F.col("id").cast("int").alias("k"), (F.col("id") * 10).alias("v"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_all_ways_give_the_same_rows(fact, dim, conf, how):
    expected = values(fact.join(dim, "k", how))
    small = joins.lookup_join(fact, dim, ["k"], how, F.col("id"))
    assert "BroadcastHashJoin" in plan(small)
    assert values(small) == expected
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    shuffled = joins.lookup_join(fact, dim, ["k"], how, F.col("id"))
    assert "BroadcastExchange" not in plan(shuffled)
    assert values(shuffled) == expected
    conf("spark.sql.adaptive.enabled", "false")
    salted = joins.lookup_join(fact, dim, ["k"], how, F.col("id"))
    assert "_salt" in plan(salted) and "BroadcastExchange" not in plan(salted)
    assert salted.columns == shuffled.columns
    assert values(salted) == expected


def test_salt_spreads_a_hot_key(spark, fact, dim, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.shuffle.partitions", "16")
    parts = (
        joins.lookup_join(fact, dim, ["k"], "inner", F.col("id"), salts=16)
        .where("k = 0")
        .groupBy(F.spark_partition_id())
        .count()
        .collect()
    )
    assert len(parts) > 4


def test_unknown_join_type(fact, dim):
    with pytest.raises(ValueError, match="unsupported"):
        joins.lookup_join(fact, dim, ["k"], "full")


def test_salts_follow_the_size(fact):
    few = joins.salts_for(fact, part_bytes=joins.estimated_bytes(fact))
    many = joins.salts_for(fact, part_bytes=max(1, joins.estimated_bytes(fact) // 50))
    assert few == 2 and many >= 50


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, context, named=None):
        self.sparkContext, self.conf = context, {"spark.checkpoint.dir": named} if named else {}



def test_shared_folder_is_the_one_the_cluster_names():
    assert session.shared_folder(Session(Context("spark://x", "hdfs://a"))) == "hdfs://a"
    assert session.shared_folder(Session(Context("spark://x"), "hdfs://b")) == "hdfs://b"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Session(Context("spark://x")))
    assert "slackline-" in session.shared_folder(Session(Context("local[2]")))


def test_stored_keeps_rows_and_types(spark, fact):
    kept = session.stored(fact)
    assert kept.schema == fact.schema or kept.dtypes == fact.dtypes
    assert values(kept) == values(fact)
