"""The streaming forms: the same pipelines on `readStream`, run over what is there, compared with the batch SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tideway.functions import folds
from tideway.operators import upkeep
from tideway.operators.table import Table
from tideway.plans import stream_queries as SQ
from tideway.plans import table_queries as TQ
from tideway.plans.registry import ORACLES, query
from tideway.plans.stream_queries import value_cents
from tideway.session import fresh_path
from tideway.sources.adapters import CLOSING_KEY, cents, events_in_batches, events_stream, nations, orders_stream, streamed
from tideway.sources import positions as P
from tideway.sources.topics import TopicDataset
from tideway.streaming import run, stateful

MONTH = "40 days"  # the test tables hold 30 days of events; nothing is late


def finished(df):
    """Emitted rows without the micro-batch number and the records that only moved time on."""
    return df.filter(F.col("key") != CLOSING_KEY).drop("batch")


def sides(spark, sf):
    s = events_stream(spark, sf)
    return SQ.purchases_with_id(s, "click"), SQ.purchases_with_id(s, "purchase")


def closed_pairs(stream):
    return finished(run.run_to_files(SQ.pairs(stream)))


@query(ORACLES["q_filter_kv"])
def q_stream_filter(spark, sf):
    df = events_stream(spark, sf, closing=False).filter_kv(lambda k, v: v["value"] >= 42).df
    return run.run_to_files(df.select("key", "offset", F.col("value.value").alias("value"))).drop("batch")


@query(ORACLES["q_fmap_kv"])
def q_stream_fmap(spark, sf):
    """Flat map and count on a stream, kept in a store."""
    from tideway.operators.stream import Stream
    from tideway.record import as_records

    docs = Stream(as_records(streamed(spark, sf, "documents"), topic="documents", key=F.col("doc_id"),
                             value=F.struct("text")))
    tokens = docs.fmap_kv(lambda k, v: F.transform(
        F.split(v["text"], " "), lambda t: F.struct(t.alias("key"), F.length(t).alias("value"))))
    fold = folds.together(n=folds.count(), chars=folds.total(lambda k, v: v))
    store = run.run_to_store(tokens.group_by_key().reduce_values(fold).snapshot(), f"tokens-{uuid.uuid4().hex}")
    return store.snapshot().select("key", "value.n", "value.chars")


@query(SQ.BRANCH_SQL)
def q_stream_branch(spark, sf):
    """One pass over the input, one sink per branch."""
    path = fresh_path(spark, "branches")
    sink = lambda i: lambda batch, batch_id: batch.select("offset", "key").write.mode("overwrite").parquet(
        f"{path}/branch={i}/batch={batch_id}")
    df = events_stream(spark, sf, closing=False).df
    run.branch_sinks(df, SQ.BRANCHES, [sink(0), sink(1), sink(2)], f"{path}-checkpoint").awaitTermination()
    return spark.read.schema('`offset` bigint, key bigint, branch int').parquet(path).select("offset", "key", "branch")


@query(ORACLES["q_window_tumbling_sum"])
def q_stream_tumbling(spark, sf):
    """Every update of a window goes to a store; the last one counts."""
    grouped = events_stream(spark, sf, closing=False).group_by_key()
    windows = grouped.window("1 day", retention=MONTH).reduce_windows(folds.total(value_cents)).df
    return run.run_to_store(windows, f"daily-{uuid.uuid4().hex}").snapshot()


@query(ORACLES["q_window_hopping_count"])
def q_stream_hopping(spark, sf):
    """Each window once, when the watermark has passed it."""
    grouped = events_stream(spark, sf).group_by_key()
    windows = grouped.window("2 days", "hopping", "1 day", retention=MONTH).reduce_windows(folds.count()).df
    return finished(run.run_to_files(windows))


def sum_fold():
    return folds.RowFold(lambda: 0, lambda agg, k, v: agg + v, "bigint", merge=lambda a, b: a + b)


@query(ORACLES["q_window_sliding_sum"])
def q_stream_sliding(spark, sf):
    df = events_stream(spark, sf).map_values(value_cents).df
    return finished(run.run_to_files(stateful.sliding_windows(df, sum_fold(), "12 hours", retention=MONTH)))


@query(ORACLES["q_window_sliding_sum"])
def q_stream_sliding_fold(spark, sf):
    """The fold of the batch query, by the same call, over records that arrive out of order in several micro-batches."""
    s = events_in_batches(spark, sf, [F.xxhash64("event_id")])
    windows = s.group_by_key().window("12 hours", "sliding", retention=MONTH).reduce_windows(folds.total(value_cents))
    return finished(run.run_to_files(windows.df))


@query(ORACLES["q_window_sliding_minmax"])
def q_stream_sliding_minmax(spark, sf):
    """Few keys with very many records each."""
    grouped = events_stream(spark, sf).map_values(lambda k, v: F.when(k != CLOSING_KEY, v)).group_by(lambda k, v: F.when(k == CLOSING_KEY, "closing").otherwise(F.col("topic")))
    closing = events_stream(spark, sf).filter_kv(lambda k, v: k == CLOSING_KEY).map_keys(lambda k, v: F.lit("closing"))
    fold = folds.together(n=folds.count(), low=folds.minimum(value_cents), high=folds.maximum(value_cents))
    both = type(grouped)(grouped.df.unionByName(closing.df))
    out = run.run_to_files(both.window("1 hour", "sliding", retention=MONTH).reduce_windows(fold).df).filter("key <> 'closing'")
    return out.select("key", "window_from", "window_to", "value.*")


@query(SQ.FOLD_SQL)
def q_stream_fold_ordered(spark, sf):
    """An ordered fold by Columns over records that arrive shuffled, in several micro-batches."""
    s = events_in_batches(spark, sf, [F.xxhash64("event_id")])
    store = s.group_by_key().reduce_values(SQ.polynomial_fold()).to_store(f"folded-{uuid.uuid4().hex}", retention=MONTH)
    return store.snapshot().filter(F.col("key") != CLOSING_KEY)


@query(ORACLES["q_session_reduce"])
def q_stream_session(spark, sf):
    sessions = events_stream(spark, sf).group_by_key().window_by_session("6 hours", retention=MONTH)
    out = run.run_to_files(sessions.reduce_sessions(SQ.session_fold()).df)
    return finished(out).select("key", "window_from", "window_to", "value.*")


@query(ORACLES["q_session_reduce"])
def q_stream_session_updates(spark, sf):
    """Sessions with every update and merge, kept in a store."""
    fold = folds.RowFold(
        lambda: {"n": 0, "total": 0}, lambda agg, k, v: {"n": agg["n"] + 1, "total": agg["total"] + v},
        "struct<n:bigint,total:bigint>", merge=lambda a, b: {"n": a["n"] + b["n"], "total": a["total"] + b["total"]})
    df = events_stream(spark, sf, closing=False).map_values(value_cents).df
    updates = stateful.updating_sessions(df, fold, "6 hours", retention=MONTH)
    store = run.run_to_store(updates, f"sessions-{uuid.uuid4().hex}")
    return store.snapshot().select("key", "window_from", "window_to", "value.*")


@query(ORACLES["q_join_stream"])
def q_stream_join(spark, sf):
    l, r = sides(spark, sf)
    return closed_pairs(l.join_stream(r, SQ.pair, "1 hour", retention=MONTH))


@query(ORACLES["q_left_join_stream"])
def q_stream_left_join(spark, sf):
    l, r = sides(spark, sf)
    return closed_pairs(l.left_join_stream(r, SQ.pair, "1 hour", retention=MONTH))


@query(ORACLES["q_outer_join_stream"])
def q_stream_outer_join(spark, sf):
    l, r = sides(spark, sf)
    return closed_pairs(l.outer_join_stream(r, SQ.pair, "1 hour", retention=MONTH))


@query(ORACLES["q_left_join_stream_eager"])
def q_stream_left_join_eager(spark, sf):
    l, r = sides(spark, sf)
    return closed_pairs(l.left_join_stream(r, SQ.pair, "1 hour", emit="eager", retention=MONTH))


@query(ORACLES["q_outer_join_stream_eager"])
def q_stream_outer_join_eager(spark, sf):
    l, r = sides(spark, sf)
    return closed_pairs(l.outer_join_stream(r, SQ.pair, "1 hour", emit="eager", retention=MONTH))


def live_last_error(spark, sf) -> Table:
    errors = events_stream(spark, sf).filter_kv(lambda k, v: v["event_type"] == "error").map_values(
        lambda k, v: F.when(v["value"] >= 20, F.struct(F.col("offset").alias("id"), cents(v["value"]).alias("cents"))))
    return Table(errors.df, order=["offset"])


@query(ORACLES["q_join_table_asof"])
def q_stream_join_table(spark, sf):
    joined = SQ.purchases_with_id(events_stream(spark, sf), "purchase").join_table(live_last_error(spark, sf), SQ.with_error)
    return finished(run.run_to_files(joined.df.select("key", "value.*")))


@query(ORACLES["q_left_join_table_asof"])
def q_stream_left_join_table(spark, sf):
    stream = SQ.purchases_with_id(events_stream(spark, sf), "purchase")
    return finished(run.run_to_files(
        stream.left_join_table(live_last_error(spark, sf), SQ.with_error).df.select("key", "value.*")))


@query(ORACLES["q_join_global_table"])
def q_stream_join_global(spark, sf):
    from tideway.operators.stream import Stream
    from tideway.record import as_records

    live = Stream(as_records(
        streamed(spark, sf, "customer"), topic="customer", key=F.col("c_custkey"),
        value=F.struct("c_name", "c_nationkey")))
    joined = live.join_global_table(nations(spark, sf), lambda k, v: v["c_nationkey"], SQ.with_nation)
    return run.run_to_files(joined.df.select("key", "value.*")).drop("batch")


def live_last_of(spark, sf, event_type: str) -> Table:
    s = events_stream(spark, sf, closing=False).filter_kv(lambda k, v: v["event_type"] == event_type)
    return Table(s.map_values(lambda k, v: F.when(v["value"] >= 10, cents(v["value"]))).df)


@query(ORACLES["q_join_tables_changelog"])
def q_stream_join_tables(spark, sf):
    from tideway.operators.joins import table_table_changes

    left, right = live_last_of(spark, sf, "click"), live_last_of(spark, sf, "purchase")
    df = table_table_changes(left.changelog(), right.changelog(), TQ.difference, "inner")
    return run.run_to_files(df, "update").select("key", "offset", "value")


@query(TQ.REGROUP_SQL)
def q_stream_regroup(spark, sf):
    """The batch query's calls on a stream: the last value of a customer is taken back when the customer orders again."""
    table = orders_stream(spark, sf).map_and_group_by(TQ.by_status).reduce_values(TQ.status_fold())
    store = run.run_to_store(table.snapshot(), f"status-{uuid.uuid4().hex}", "append")
    return store.snapshot().select("key", "value.*")


@query(TQ.REGROUP_SQL)
def q_stream_regroup_rows(spark, sf):
    """The same with Python functions."""
    table = orders_stream(spark, sf).map_and_group_by(TQ.by_status).reduce_values(
        lambda agg, k, v: {"n": agg["n"] + 1, "total": agg["total"] + v},
        lambda agg, k, v: {"n": agg["n"] - 1, "total": agg["total"] - v},
        lambda: {"n": 0, "total": 0}, "struct<n:bigint,total:bigint>")
    store = run.run_to_store(table.snapshot(), f"status-{uuid.uuid4().hex}", "append")
    return store.snapshot().select("key", "value.*")


@query(TQ.REGROUP_SQL)
def q_stream_regroup_parts(spark, sf):
    """Signed contributions are appended as customers reorder; totals are their sums."""
    table = orders_stream(spark, sf)
    changes = stateful.regrouped_changes(table.changelog(), TQ.by_status, TQ.status_fold(), table.order)
    return stateful.regrouped_totals(run.run_to_files(changes), TQ.status_fold()).select("key", "value.*")


@query(TQ.RUNNING_SQL)
def q_stream_process(spark, sf):
    """The processor of `q_process_running_sum`, with durable state."""
    out = events_stream(spark, sf, closing=False).map_values(value_cents).process(TQ.RunningSum)
    return run.run_to_files(out.df.select("key", "offset", "value"), "update").drop("batch")


@query(TQ.TICKS_SQL)
def q_stream_process_schedule(spark, sf):
    """Timers by event time and by wall clock in one processor, whose state lasts over the micro-batches."""
    s = events_in_batches(spark, sf, [F.col("ts"), F.col("event_id")]).map_values(value_cents).process(TQ.TickingByBoth)
    out = run.run_until_idle(s.df.select("key", F.unix_millis("timestamp").alias("event_time"), "value"), "update")
    return finished(out.filter("key IS NOT NULL"))


@query(TQ.SORTED_SQL)
def q_stream_process_children(spark, sf):
    """A processor's children as topics, one transaction per micro-batch."""
    topics = TQ.topics_of(spark, TQ.Sorting.value_type)
    out = events_stream(spark, sf, closing=False).map_values(value_cents).process(TQ.Sorting, time_mode="None")
    out.sink_children(topics, {"clicks": "a", "others": "b"}, checkpoint=f"{topics.path}-checkpoint", mode="update").awaitTermination()
    return TQ.sorted_out(topics)


class Names:
    """Fills a global store: a nation's name under its key."""

    key_type, value_type = "int", "string"

    def on_record(self, ctx, state, record):
        ctx.forward(record["key"], record["value"])


@query(ORACLES["q_join_global_table"])
def q_stream_global_store(spark, sf):
    """A topic kept as a store by a processor, and a stream that looks into the store anew in every micro-batch."""
    from tideway.operators.stream import Stream
    from tideway.operators.table import Table
    from tideway.record import as_records

    topics = TopicDataset(spark, fresh_path(spark, "topics"), "int", "string")
    topics.produce(nations(spark, sf).map_values(lambda k, v: v["n_name"]).changelog().withColumn("key", F.col("key").cast("int")))
    query, store = topics.start_global_store("nation", Names, f"nations-{uuid.uuid4().hex}", f"{topics.path}-store")
    query.awaitTermination()
    live = as_records(streamed(spark, sf, "customer"), topic="customer", key=F.col("c_custkey"), value=F.struct("c_name", "c_nationkey"))
    path = f"{topics.path}-joined"
    with_name = lambda v, n: F.struct(v["c_name"].alias("c_name"), n.alias("n_name"))
    join = lambda batch, known: Stream(batch).join_global_table(Table(None, snapshot=known), lambda k, v: v["c_nationkey"], with_name).df
    sink = lambda df, i: df.select("key", "value.*").write.mode("overwrite").parquet(f"{path}/batch={i}")
    run.join_global_store(live, store, join, sink, f"{path}-checkpoint").awaitTermination()
    return spark.read.schema("key bigint, c_name string, n_name string").parquet(path).select("key", "c_name", "n_name")


@query(f"SELECT event_type AS topic, user_id AS key, CAST(sum({SQ.CENTS}) AS BIGINT) AS value, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1, 2")
def q_stream_committed(spark, sf):
    """Published records come once, aborted ones never, over several transactions and two runs of the query."""
    topics = TopicDataset(spark, fresh_path(spark, "topics"), "bigint", "bigint", partitions=4)
    s = SQ.events(spark, sf).map_values(value_cents).df
    path = f"{topics.path}-out"
    sink = lambda df, i: df.select("topic", "key", "value").write.mode("overwrite").parquet(f"{path}/batch={i}")
    for i in range(2):
        half = s.filter(F.col("offset") % 2 == i)
        lost = topics.transaction()
        lost.produce(half)
        lost.abort()
        topics.produce(half)
        topics.stream_committed(sink, f"{path}-checkpoint").awaitTermination()
    rows = spark.read.schema("topic string, key bigint, value bigint").parquet(path)
    return rows.groupBy("topic", "key").agg(F.sum("value").alias("value"), F.count("*").alias("n"))


@query(f"SELECT user_id AS key, CAST(sum({SQ.CENTS}) AS BIGINT) AS value FROM events GROUP BY 1")
def q_do_kv(spark, sf):
    """Side effects per record: the function writes what it sees, the records go on unchanged."""
    seen = spark.sparkContext.accumulator(0)
    s = SQ.events(spark, sf).map_values(value_cents)
    sums = s.do_kv(lambda k, v: seen.add(1)).group_by_key().reduce_values(folds.total(lambda k, v: v)).snapshot()
    rows = run.kept(sums, "sums")
    if seen.value < s.df.count():  # a lost task may repeat calls, none is left out
        raise AssertionError("records that the function has not seen")
    return rows


@query("SELECT event_type AS topic, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1")
def q_sink_do_process(spark, sf):
    """Terminal operators: what the function and the processor do per record is all that is left of them."""
    counts = {name: spark.sparkContext.accumulator(0) for name in ("click", "other")}

    class Counting:
        key_type, value_type = "bigint", "bigint"

        def on_record(self, ctx, state, record):
            counts["click" if record["topic"] == "click" else "other"].add(1)

    rows = []
    kinds = [r[0] for r in SQ.events(spark, sf).df.select("topic").distinct().collect()]
    for kind in kinds:
        s = SQ.events(spark, sf).map_values(value_cents).filter_kv(lambda k, v: F.col("topic") == kind)
        before = sum(c.value for c in counts.values())
        s.sink_process(Counting) if kind == "click" else s.sink_do(lambda k, v: counts["other"].add(1))
        rows.append((kind, sum(c.value for c in counts.values()) - before))
    return spark.createDataFrame(rows, "topic string, n bigint")


@query("SELECT 'query' AS \"group\", CAST(count(*) AS DOUBLE) AS value FROM events")
def q_stream_metrics(spark, sf):
    """Rows that a query has read, by its progress."""
    df = events_stream(spark, sf, closing=False).df.select("key", "offset")
    path = fresh_path(spark, "out")
    query = run.start_to_files(df, path, f"{path}-checkpoint")
    query.awaitTermination()
    metrics = upkeep.stream_metrics(spark, query).filter("group = 'query' AND name = 'numInputRows'")
    return metrics.groupBy("group").agg(F.sum("value").alias("value"))


@query(ORACLES["q_process_values"])
def q_stream_process_values(spark, sf):
    out = events_stream(spark, sf, closing=False).map_values(value_cents).process_values(TQ.Previous)
    return run.run_to_files(out.df.select("key", "offset", "value"), "update").drop("batch")


@query(f"""SELECT event_type AS topic, CAST(count(*) AS BIGINT) AS records, CAST(sum({SQ.CENTS}) AS BIGINT) AS total,
CAST(count(*) AS BIGINT) AS places FROM events GROUP BY 1""")
def q_stream_sink_topic(spark, sf):
    """A stream into a topic dataset, one transaction per micro-batch, and a committed read of it."""
    topics = TopicDataset(spark, fresh_path(spark, "topics"), "bigint", "bigint", partitions=4)
    s = events_stream(spark, sf, closing=False).map_values(value_cents)
    s.sink_topic(topics, lambda r: r["topic"], checkpoint=f"{topics.path}-checkpoint").awaitTermination()
    return topics.read().groupBy("topic").agg(
        F.count("*").alias("records"), F.sum("value").alias("total"),
        F.count_distinct("partition", "offset").alias("places"))


@query(ORACLES["q_extract_timestamp"])
def q_stream_extract_timestamp(spark, sf):
    """Event time = time of the record before in the same partition, on a stream."""
    df = P.extract_timestamp(events_stream(spark, sf, closing=False).df, lambda prev, rec: F.coalesce(prev, rec["timestamp"]))
    return run.run_to_files(df.select("offset", F.unix_millis("timestamp").alias("event_time"))).drop("batch")
