"""Queries over topics: positions, slices, sinks, transactions, encodings."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from tideway.functions import codec
from tideway.plans.registry import query
from tideway.plans.stream_queries import CENTS, value_cents
from tideway.session import fresh_path
from tideway.sources import positions as P
from tideway.sources.adapters import events, raw
from tideway.sources.topics import TopicDataset
from tideway.streaming import run

EV = """ev AS (SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset", ts, user_id AS key, value FROM events)"""


def dataset(spark, value_type: str = "bigint") -> TopicDataset:
    return TopicDataset(spark, fresh_path(spark, "topics"), "bigint", value_type, partitions=4)


@query(f"""WITH {EV} SELECT topic, partition, min("offset") AS beginning_offset, max("offset") + 1 AS end_offset,
CAST(count(*) AS BIGINT) AS records FROM ev GROUP BY 1, 2""")
def q_partitions(spark, sf):
    return P.partitions_of(events(spark, sf).df)


@query(f"""WITH {EV} SELECT topic, partition, min("offset") AS first, max("offset") + 1 AS last FROM ev GROUP BY 1, 2""")
def q_begin_end_offsets(spark, sf):
    df = events(spark, sf).df
    first = P.rewind(df).withColumnRenamed("offset", "first")
    return first.join(P.fast_forward(df).withColumnRenamed("offset", "last"), ["topic", "partition"])


@query(f"""
WITH {EV}, asked AS (SELECT DISTINCT topic, partition,
  CASE WHEN topic = 'error' THEN TIMESTAMP '2030-01-01' ELSE TIMESTAMP '2024-01-15' END AS t FROM ev)
SELECT asked.topic, asked.partition, (epoch_us(t) // 1000) AS asked, min("offset") AS "offset",
       (epoch_us(min_by(ts, "offset")) // 1000) AS event_time
FROM asked LEFT JOIN ev ON asked.topic = ev.topic AND asked.partition = ev.partition AND ts >= t GROUP BY 1, 2, 3
""")
def q_offsets_for_ts(spark, sf):
    df = events(spark, sf).df
    asked = df.select("topic", "partition").distinct().withColumn(
        "timestamp", F.when(F.col("topic") == "error", F.lit("2030-01-01")).otherwise("2024-01-15").cast("timestamp"))
    found = P.offsets_for_timestamps(df, asked)
    return found.select("topic", "partition", F.unix_millis("asked").alias("asked"), "offset",
                        F.unix_millis("timestamp").alias("event_time"))


@query(f"""
WITH ev AS (SELECT CASE WHEN event_type = 'error' THEN 'e' ELSE 'a' END AS topic, CAST(user_id % 4 AS INTEGER) AS partition, ts, event_id,
              row_number() OVER (PARTITION BY event_type = 'error', user_id % 4 ORDER BY ts, event_id) - 1 AS "offset" FROM events),
asked AS (SELECT DISTINCT topic, partition, t FROM ev, (VALUES (TIMESTAMP '2024-01-10 12:00:00'), (TIMESTAMP '2024-01-25'), (TIMESTAMP '2030-01-01'), (TIMESTAMP '2020-01-01')) AS x(t))
SELECT asked.topic, asked.partition, (epoch_us(t) // 1000) AS asked, min("offset") AS "offset", (epoch_us(min_by(ts, "offset")) // 1000) AS event_time
FROM asked LEFT JOIN ev ON asked.topic = ev.topic AND asked.partition = ev.partition AND ts >= t GROUP BY 1, 2, 3
""")
def q_offsets_for_ts_zones(spark, sf):
    """The same of a topic dataset with a part per four days: only parts that hold the time asked for are read."""
    topics = dataset(spark)
    s = events(spark, sf).map_values(value_cents).df
    s = s.withColumns({"topic": F.when(F.col("topic") == "error", "e").otherwise("a"), "_day": F.date_trunc("day", "timestamp")})
    first = s.agg(F.min("_day")).first()[0]
    step = F.floor(F.date_diff("_day", F.lit(first)) / 4)
    last = s.agg(F.max(step)).first()[0]
    for i in range(last + 1):
        topics.produce(s.filter(step == i).drop("_day"), order_by=["timestamp", "offset"])
    times = [F.lit(t).cast("timestamp") for t in ("2024-01-10 12:00:00", "2024-01-25", "2030-01-01", "2020-01-01")]
    asked = topics.end_offsets().select("topic", "partition", F.explode(F.array(*times)).alias("timestamp"))
    found = topics.offsets_for_timestamps(asked)
    return found.select("topic", "partition", F.unix_millis("asked").alias("asked"), "offset", F.unix_millis("timestamp").alias("event_time"))


@query(f"""WITH {EV} SELECT topic, partition, "offset", key FROM ev
WHERE (topic = 'click' AND partition = 1 AND "offset" >= 100 AND "offset" < 5000)
   OR (topic = 'view' AND partition = 0 AND "offset" >= 2000 AND "offset" < 9000)""")
def q_read_slice(spark, sf):
    df = P.read_slice(events(spark, sf).df, {("click", 1): 100, ("view", 0): 2000}, {("click", 1): 5000, ("view", 0): 9000})
    return df.select("topic", "partition", "offset", "key")


@query(f"""WITH {EV} SELECT topic, partition, "offset" FROM ev
WHERE NOT (topic = 'click' AND partition = 1 AND "offset" < 5000)""")
def q_seek(spark, sf):
    return P.seek(events(spark, sf).df, {("click", 1): 5000}).select("topic", "partition", "offset")


@query(f"""WITH {EV} SELECT topic, partition, "offset" FROM ev WHERE (topic, partition) IN (('click', 1), ('error', 0), ('error', 2))""")
def q_assign(spark, sf):
    return P.assign(events(spark, sf).df, [("click", 1), ("error", 0), ("error", 2)]).select("topic", "partition", "offset")


@query("""SELECT event_type AS topic, event_id AS "offset" FROM events WHERE regexp_full_match(event_type, '[cp].*')""")
def q_subscribe_pattern(spark, sf):
    return P.subscribe(events(spark, sf).df, re.compile("[cp].*")).select("topic", "offset")


@query("SELECT event_type AS topic, CAST(count(DISTINCT user_id % 4) AS BIGINT) AS partitions FROM events GROUP BY 1")
def q_topic_list(spark, sf):
    return P.list_topics(events(spark, sf).df)


@query(f"""WITH {EV} SELECT topic, partition, "offset", key FROM ev""")
def q_read_batch_by_partition(spark, sf):
    """Every worker gets consecutive offsets in order; a worker that sees disorder would raise."""
    df = events(spark, sf).df.select("topic", "partition", "offset", "key")

    def worker(batches):
        last = ("", -1, -1)
        for batch in batches:
            here = list(zip(*[batch.column(c).to_pylist() for c in ("topic", "partition", "offset")]))
            if here != sorted(here) or (here and here[0] <= last):
                raise ValueError("records out of order")
            last = here[-1] if here else last
            yield batch

    return P.read_batch_by_partition(df, worker, df.schema)


@query(f"""
WITH {EV}, done AS (SELECT topic, partition, max("offset") + 1 AS "offset" FROM ev WHERE ts < TIMESTAMP '2024-01-10' AND topic <> 'error'
                    GROUP BY 1, 2)
SELECT ev.topic, ev.partition, coalesce(max(done."offset"), min(ev."offset")) AS "offset", max(ev."offset") + 1 AS end_offset,
       max(ev."offset") + 1 - coalesce(max(done."offset"), min(ev."offset")) AS lag
FROM ev LEFT JOIN done USING (topic, partition) GROUP BY 1, 2
""")
def q_consumer_lag(spark, sf):
    """A group has committed what it read before a date, in all topics but one."""
    df = events(spark, sf).df
    topics = dataset(spark)
    early = df.filter((F.col("timestamp") < F.lit("2024-01-10").cast("timestamp")) & (F.col("topic") != "error"))
    committed = topics.commit_offsets("group-a", P.end_offsets(early))
    return P.lag(df, committed)


# -- sinks and transactions -----------------------------------------------------------------------------


def routed(record):
    return F.when(record["value"] >= 5000, F.concat(F.lit("big-"), F.col("topic"))).otherwise("small")


@query(f"""
SELECT CASE WHEN {CENTS} >= 5000 THEN 'big-' || event_type ELSE 'small' END AS topic, CAST(user_id % 4 AS INTEGER) AS partition,
       CAST(count(*) AS BIGINT) AS records, CAST(sum({CENTS}) AS BIGINT) AS total, CAST(0 AS BIGINT) AS first,
       CAST(count(*) AS BIGINT) AS last
FROM events GROUP BY 1, 2
""")
def q_sink_select(spark, sf):
    """Topic picked per record, written, and read back."""
    topics = dataset(spark)
    events(spark, sf).map_values(value_cents).sink_topic(topics, routed)
    return topics.read().groupBy("topic", "partition").agg(
        F.count("*").alias("records"), F.sum("value").alias("total"), F.min("offset").alias("first"),
        (F.max("offset") + 1).alias("last"))


@query(f"""
SELECT event_id AS key, CAST(user_id % 3 AS INTEGER) AS partition, row_number() OVER (PARTITION BY user_id % 3 ORDER BY ts, event_id) - 1 AS "offset",
       {CENTS} AS value FROM events
""")
def q_produce_offsets(spark, sf):
    """Partition chooser and consecutive offsets in time order."""
    topics = dataset(spark)
    s = events(spark, sf).map_values(lambda k, v: F.struct(k.alias("user"), value_cents(k, v).alias("cents")))
    s = s.map_keys(lambda k, v: F.col("offset"))
    chosen = s.df.withColumn("topic", F.lit("all"))
    topics = TopicDataset(spark, topics.path, "bigint", "struct<user:bigint,cents:bigint>", partitions=3)
    topics.produce(chosen, order_by=["timestamp", "offset"],
                   select_partition=lambda topic, n, k, v: v["user"] % n)
    return topics.read("all").select("key", "partition", "offset", F.col("value.cents").alias("value"))


@query(f"""
SELECT 'out-' || event_type AS topic, CAST(user_id % 4 AS INTEGER) AS partition, CAST(count(*) AS BIGINT) AS records, CAST(sum({CENTS}) AS BIGINT) AS total,
       CAST(count(*) AS BIGINT) AS end_offset FROM events GROUP BY 1, 2
""")
def q_through_topic(spark, sf):
    """All events written, read back and gone on from, per topic and partition."""
    out = None
    topics = dataset(spark)
    kinds = [r[0] for r in raw(spark, sf, "events").select("event_type").distinct().orderBy("event_type").collect()]
    for kind in kinds:
        s = events(spark, sf).filter_kv(lambda k, v: v["event_type"] == kind).map_values(value_cents)
        df = s.through_topic(topics, f"out-{kind}").df.groupBy("topic", "partition").agg(
            F.count("*").alias("records"), F.sum("value").alias("total"), (F.max("offset") + 1).alias("end_offset"))
        # before the next write: scans of one folder at different times count as equal
        df = run.kept(df, "through")
        out = df if out is None else out.unionByName(df)
    return out


@query(f"""
SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS partition, CAST(count(*) AS BIGINT) AS records, CAST(sum({CENTS}) AS BIGINT) AS total,
       CAST(count(*) AS BIGINT) AS end_offset FROM events GROUP BY 1, 2
""")
def q_transaction(spark, sf):
    """All events in four transactions of two sends each, every one replayed (no effect), with aborted ones in between (invisible)."""
    topics = dataset(spark)
    s = events(spark, sf).map_values(value_cents).df
    for i in range(4):
        some = s.filter(F.col("offset") % 4 == i)
        for _ in range(2):
            with topics.transaction(f"batch-{i}") as txn:
                txn.produce(some.filter("topic IN ('click', 'error')"))
                txn.produce(some.filter("topic NOT IN ('click', 'error')"))
        lost = topics.transaction(f"lost-{i}")
        lost.produce(some)
        lost.abort()
    return topics.read().groupBy("topic", "partition").agg(
        F.count("*").alias("records"), F.sum("value").alias("total"), (F.max("offset") + 1).alias("end_offset"))


@query(f"""WITH {EV} SELECT topic, partition, max("offset") + 1 AS "offset" FROM ev GROUP BY 1, 2""")
def q_transaction_offsets(spark, sf):
    """Positions of all topics become visible with the transactions that carry them, never with a lost one."""
    topics = dataset(spark)
    s = events(spark, sf).map_values(value_cents).df
    half = F.lit("2024-01-15").cast("timestamp")
    for name, some in (("early", s.filter(F.col("timestamp") < half)), ("all", s)):
        with topics.transaction(name) as txn:
            txn.produce(some)
            txn.offsets("group-a", P.end_offsets(some))
        lost = topics.transaction(f"lost-{name}")
        lost.offsets("group-a", {(r["topic"], r["partition"]): 10**9 for r in topics.end_offsets().collect()})
        lost.abort()
    return topics.consumer_group_offsets("group-a")


@query(f"""WITH {EV} SELECT topic, partition, max("offset") + 1 AS "offset" FROM ev WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1, 2""")
def q_committed_offset(spark, sf):
    """The committed position of each partition, asked one by one."""
    topics = dataset(spark)
    df = events(spark, sf).df
    early = df.filter(F.col("timestamp") < F.lit("2024-01-15").cast("timestamp"))
    topics.commit_offsets("group-a", P.end_offsets(early))
    # one row per partition
    places = [(r["topic"], r["partition"]) for r in P.end_offsets(early).select("topic", "partition").collect()]
    rows = [(t, p, topics.committed_offset("group-a", t, p)) for t, p in places]
    return spark.createDataFrame(rows, P.POSITIONS)


@query("""SELECT event_type AS topic, event_id AS "offset" FROM events WHERE event_type IN ('click', 'error')""")
def q_add_source(spark, sf):
    """A source by a list of topics."""
    return P.add_source(events(spark, sf).df, ["click", "error", "none"]).select("topic", "offset")


@query(f"""WITH {EV} SELECT topic, partition, max("offset") + 1 AS "offset" FROM ev GROUP BY 1, 2""")
def q_offset_reset_latest(spark, sf):
    """A new reader that starts behind what is there."""
    return P.offset_reset(events(spark, sf).df, "latest")


@query(f"""
SELECT user_id AS key, {CENTS} AS value FROM events WHERE ts >= TIMESTAMP '2024-01-15'
""")
def q_read_after_commit(spark, sf):
    """A reader commits after the first half and gets exactly the rest."""
    topics = dataset(spark)
    s = events(spark, sf).map_values(value_cents).df.withColumn("topic", F.lit("in")).withColumn("partition", F.lit(0))
    half = F.lit("2024-01-15").cast("timestamp")
    topics.produce(s.filter(F.col("timestamp") < half))
    topics.commit_offsets("group-a", topics.read("in"))
    topics.produce(s.filter(F.col("timestamp") >= half))
    return topics.read_uncommitted_by("group-a", "in").select("key", "value")


# -- encodings ------------------------------------------------------------------------------------------


@query("""
SELECT event_id AS l, CAST(user_id AS INTEGER) - 70 AS i, event_type AS s, value > 50 AS b, value AS d, event_type AS k FROM events
""")
def q_codec_roundtrip(spark, sf):
    df = raw(spark, sf, "events").select(
        F.col("event_id").alias("l"), (F.col("user_id").cast("int") - 70).alias("i"), F.col("event_type").alias("s"),
        (F.col("value") > 50).alias("b"), F.col("value").alias("d"), F.col("event_type").alias("k"))
    formats = {"l": "long", "i": "integer", "s": "string", "b": "boolean", "d": "double", "k": "keyword"}
    binary = df.select(*[codec.encoded(F.col(c), f).alias(c) for c, f in formats.items()])
    return binary.select(*[codec.decoded(F.col(c), f).alias(c) for c, f in formats.items()])


@query("""
SELECT event_id AS id, printf('%016X', event_id) AS l, printf('%08X', user_id) AS i, hex(event_type) AS s,
       CASE WHEN value > 50 THEN '01' ELSE '00' END AS b FROM events
""")
def q_codec_bytes(spark, sf):
    """The bytes themselves: big-endian, UTF-8."""
    df = raw(spark, sf, "events")
    enc = lambda c, f: F.hex(codec.encoded(c, f))
    return df.select(
        F.col("event_id").alias("id"), enc(F.col("event_id"), "long").alias("l"),
        enc(F.col("user_id").cast("int"), "integer").alias("i"), enc(F.col("event_type"), "string").alias("s"),
        enc(F.col("value") > 50, "boolean").alias("b"))


@query("""SELECT event_id AS "offset", CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def q_decode_with(spark, sf):
    """A codec of the user's own: JSON to a struct."""
    df = events(spark, sf).map_values(lambda k, v: v["props"]).df
    df = codec.decode_with(df, lambda data, topic, headers: F.from_json(data, "k bigint"))
    return df.select("offset", "value.k")
