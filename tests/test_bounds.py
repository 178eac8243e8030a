"""Position bounds over records with nulls, and doubles that are not numbers."""

import math

from pyspark.sql import functions as F

from tideway.functions.codec import decoded, encoded
from tideway.sources import positions as P
from tideway.sources.topics import TopicDataset


def test_bounds_do_not_depend_on_the_map(spark):
    df = spark.createDataFrame([("t", 0, 5), ("t", 0, 1), ("t", 0, None), ("t", None, 5), ("u", 1, 7)], "topic string, partition int, offset bigint")
    small = {("t", 0): 3}
    large = small | {("x", i): 0 for i in range(400)}
    want = sorted(P.seek(df, small).collect(), key=repr)
    assert len(want) == 4 and sorted(P.seek(df, large).collect(), key=repr) == want
    assert P.read_slice(df, small, {("t", 0): 9}).collect() == P.read_slice(df, large, {("t", 0): 9}).collect() != []


def test_read_until(spark, tmp_path):
    topics = TopicDataset(spark, str(tmp_path / "topics"), key_type="bigint", value_type="bigint")
    df = spark.range(10).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.timestamp_seconds("id").alias("timestamp"), F.col("id").alias("key"), F.col("id").alias("value"))
    topics.produce(df)
    assert topics.read("t", end={("t", 0): 3}).count() == 3 and topics.read("t").count() == 10


def test_codec_nan(spark):
    df = spark.createDataFrame([(1.5,), (float("nan"),), (None,), (float("inf"),)], "x double").repartition(1)
    got = df.select("x", decoded(encoded(F.col("x"), "double"), "double").alias("y")).collect()
    assert all(r["x"] == r["y"] or (r["x"] is not None and math.isnan(r["x"]) and r["y"] is not None and math.isnan(r["y"])) for r in got)


def test_records_of_a_partition_do_not_meet_in_a_task(spark, tmp_path):
    topics = TopicDataset(spark, str(tmp_path / "topics"), key_type="bigint", value_type="bigint")
    df = spark.range(10).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.timestamp_seconds("id").alias("timestamp"), F.col("id").alias("key"), F.col("id").alias("value"))
    topics.produce(df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if positions were dealt by partition
    try:
        for read in (topics.records(), topics.records("read_uncommitted"), P.seek(topics.records(), topics.end_offsets()), topics.read("t", start={("t", 0): 4})):
            plan = read._jdf.queryExecution().sparkPlan().toString()
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert topics.read("t", start={("t", 0): 4}).count() == 6
