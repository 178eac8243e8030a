"""Topic upkeep as Spark jobs: prune, compact, change the number of partitions, report progress."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideway.functions import scans as S
from tideway.sources import positions as P
from tideway.sources.topics import default_partition


def delete_records_before(df: DataFrame, cuts) -> DataFrame:
    """Records that stay when each named partition loses everything below its cut offset."""
    return P.seek(df, cuts)


def lowest_offsets(df: DataFrame) -> DataFrame:
    return P.beginning_offsets(df)


def compact_topic(df: DataFrame) -> DataFrame:
    """The last record of each key per partition, at its old offset. Null keys cannot be compacted."""
    checked = df.withColumn("key", F.when(F.col("key").isNull(), F.raise_error(F.lit(
        "a compacted topic cannot hold records without a key"))).otherwise(F.col("key")))
    rest = [c for c in df.columns if c not in ("topic", "partition", "key", "offset")]
    last = checked.groupBy("topic", "partition", "key").agg(
        F.max("offset").alias("offset"), F.max_by(F.struct(*rest), "offset").alias("_r"))
    return last.select("topic", "partition", "key", "offset", "_r.*").select(*df.columns)


def repartition_topic(df: DataFrame, n: int, *, move: bool = False, from_offsets=None) -> DataFrame:
    """Raise the number of partitions to `n`.

    `move=False`: records stay where they are; the new rule holds for records from `from_offsets` on (none given: for
    none that exist). Those are numbered on, in (time, old partition, old offset) order, behind what stays in their partition and
    not below the positions from which the rule holds. `move=True`: every record goes to its new partition and gets a new offset there, in
    (time, old partition, old offset) order.
    """
    place = default_partition(df, n)
    if not move:
        if from_offsets is None:
            return df
        bounds = P.positions(df.sparkSession, from_offsets).withColumnRenamed("offset", "_from")
        joined = df.join(bounds, ["topic", "partition"], "left")
        joined = joined.withColumn("_fresh", F.coalesce(F.col("offset") >= F.col("_from"), F.lit(False)))
        stay = joined.filter("NOT _fresh").select(*df.columns)
        ends = P.end_offsets(stay).withColumnRenamed("offset", "_end")
        go = joined.filter("_fresh").withColumn("_to", place).withColumnsRenamed({"partition": "_p", "offset": "_o", "_to": "partition"})
        cuts = bounds.groupBy("topic").agg(F.max("_from").alias("_cut"))
        numbered = S.scan(go.drop("_from"), ["topic", "partition"], ["timestamp", "_p", "_o"], {"_n": S.number()})
        numbered = numbered.join(ends, ["topic", "partition"], "left").join(cuts, "topic")
        return stay.unionByName(numbered.withColumn("offset", F.greatest("_end", "_cut") + F.col("_n") - 1).select(*df.columns))
    moved = df.withColumn("_to", place).withColumnsRenamed({"partition": "_p", "offset": "_o", "_to": "partition"})
    numbered = S.scan(moved, ["topic", "partition"], ["timestamp", "_p", "_o"], {"_n": S.number()})
    return numbered.withColumn("offset", F.col("_n") - 1).select(*df.columns)


def stream_metrics(spark: SparkSession, query) -> DataFrame:
    """Progress of a streaming query as rows (query, batch, group, name, value)."""
    rows = []
    for p in query.recentProgress:
        name, batch = p["name"] or p["id"], p["batchId"]
        put = lambda group, metric, value: rows.append((name, batch, group, metric, float(value)))
        for metric in ("numInputRows", "inputRowsPerSecond", "processedRowsPerSecond"):
            if p.get(metric) is not None:
                put("query", metric, p[metric])
        for metric, value in (p.get("durationMs") or {}).items():
            put("duration-ms", metric, value)
        for i, operator in enumerate(p.get("stateOperators") or []):
            for metric in ("numRowsTotal", "numRowsUpdated", "numRowsDroppedByWatermark", "memoryUsedBytes"):
                if operator.get(metric) is not None:
                    put(f"state-{i}", metric, operator[metric])
        for i, source in enumerate(p.get("sources") or []):
            put(f"source-{i}", "numInputRows", source["numInputRows"])
    return spark.createDataFrame(rows, "query string, batch bigint, group string, name string, value double")
