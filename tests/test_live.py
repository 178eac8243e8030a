"""Streams over several micro-batches, restarts, timers, late data, transactions."""

import pytest
from pyspark.sql import functions as F

from helpers import at, got, records
from tideway.functions import codec, folds
from tideway.operators import stores, upkeep
from tideway.operators.processors import Context
from tideway.operators.stream import Stream
from tideway.operators.table import Table
from tideway.session import fresh_path
from tideway.sources import positions as P
from tideway.sources.topics import TopicDataset, connector
from tideway.streaming import run, stateful


def file_stream(spark, batches, **types):
    """Each list of rows is one file and one micro-batch, in order. Returns (stream, folder, append)."""
    path = fresh_path(spark, "in")
    count = [0]

    def append(rows):
        df = records(spark, rows, **types)
        df = df.withColumn("offset", F.col("offset") + 1000 * count[0])
        df.coalesce(1).write.mode("append").parquet(path)
        count[0] += 1

    for rows in batches:
        append(rows)
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path), path, append


END = [("zz", 1_000_000, 0)]


def test_windows_over_batches_equal_batch(spark):
    batches = [[("a", 1, 1), ("b", 2, 2)], [("a", 3, 4), ("a", 11, 8)], [("b", 12, 16)]]
    df, path, _ = file_stream(spark, batches)
    window = lambda d: Stream(d).group_by_key().window((10, "seconds"), retention="1 hour").reduce_windows(
        folds.total(lambda k, v: v)).df
    live = run.run_to_store(window(df), fresh_path(spark, "w").rsplit("/", 1)[1]).snapshot()
    columns = ("key", "window_from", "window_to", "value")
    assert got(live, *columns) == got(window(spark.read.parquet(path)), *columns)


def test_late_record_is_dropped_on_a_stream(spark):
    """Lateness is judged by the watermark one micro-batch back, so the late record comes two batches after 195 s."""
    batches = [[("a", 100, 1)], [("a", 195, 2)], [("a", 196, 0)], [("a", 96, 4), ("a", 170, 8)], END]
    df, _, _ = file_stream(spark, batches)
    windows = Stream(df).group_by_key().window((10, "seconds"), retention=(30, "seconds"))
    out = run.run_to_files(windows.reduce_windows(folds.total(lambda k, v: v)).df)
    assert got(out.filter("key <> 'zz'"), "window_from", "value") == [(100000, 1), (170000, 8), (190000, 2)]


def test_sessions_are_bridged_by_a_late_record(spark):
    fold = folds.RowFold(lambda: 0, lambda agg, k, v: agg + v, "bigint", merge=lambda a, b: a + b)
    df, _, _ = file_stream(spark, [[("a", 10, 1), ("a", 12, 1), ("a", 20, 1)], [("a", 16, 1)]])
    updates = stateful.updating_sessions(df, fold, (5, "seconds"))
    store = run.run_to_store(updates, fresh_path(spark, "s").rsplit("/", 1)[1])
    first = store.history().filter("seq = 0 AND value IS NOT NULL")
    assert got(first, "window_from", "window_to", "value") == [(10000, 12000, 2), (20000, 20000, 1)]
    assert got(store.snapshot(), "window_from", "window_to", "value") == [(10000, 20000, 4)]


def test_as_of_join_waits_for_event_time(spark):
    """An update that arrives in a later batch, but is older than the record, is still seen by it."""
    stream, _, _ = file_stream(spark, [[("a", 15, 1)], [("a", 25, 2)], END])
    table, _, _ = file_stream(spark, [[("a", 20, 100)], [("a", 10, 50)], END])
    out = run.run_to_files(stateful.as_of_join(
        stream, table, lambda s, t: F.struct(s.alias("s"), t.alias("t")), "left", retention=(1, "hours")))
    assert got(out.filter("key = 'a'"), "value.s", "value.t") == [(1, 50), (2, 100)]


def test_eager_left_join(spark):
    left, _, _ = file_stream(spark, [[("a", 1, 1), ("b", 2, 2)], END])
    right, _, _ = file_stream(spark, [[("q", 0, 0)], [("a", 3, 10), ("c", 3, 30)]])
    out = run.run_to_files(stateful.eager_left_join(
        left, right, lambda a, b: F.struct(a.alias("a"), b.alias("b")), (2, "seconds")))
    assert got(out.filter("key <> 'zz'"), "key", "value.a", "value.b") == [("a", 1, 10), ("a", 1, None), ("b", 2, None)]


def summing():
    class Summing:
        """Running sum; every ten seconds of event time the sum so far goes to the child `tick`."""

        key_type, value_type = "string", "bigint"
        stores = {"s": ("string", "bigint")}

        def init(self, ctx):
            ctx.schedule((10, "seconds"), "stream-time",
                         lambda now: ctx.forward(None, ctx.store("s").get("sum"), child="tick"))

        def on_record(self, ctx, state, record):
            total = (ctx.store("s").get("sum") or 0) + record["value"]
            ctx.store("s").put("sum", total)
            ctx.forward(record["key"], total, child="sum")

    return Summing


def test_processor_on_stream_equals_batch(spark):
    batches = [[("a", 1, 1), ("b", 2, 2)], [("a", 3, 4)], [("a", 25, 8), ("b", 30, 16)]]
    df, path, _ = file_stream(spark, batches)
    out = run.run_to_files(Stream(df).process(summing()).df, "update")
    batch = Stream(spark.read.parquet(path)).process(summing()).df
    only = lambda d: got(d.filter("child = 'sum'"), "key", "offset", "value")
    assert only(out) == only(batch)
    assert only(batch) == [("a", 0, 1), ("a", 1000, 5), ("a", 2000, 13), ("b", 1, 2), ("b", 2001, 18)]
    # in a batch, time passes 11 and 12 s when the records at 25 and 30 s arrive
    assert got(batch.filter("child = 'tick'"), "value") == [(2,), (5,)]


def test_processor_timers_fire_on_streams(spark):
    """The timer for 11 s fires once the watermark is past it, after the records of that micro-batch."""
    df, _, _ = file_stream(spark, [[("a", 1, 1)], [("a", 3, 4)], [("a", 25, 8)], [("a", 100_000, 0)], [("a", 100_001, 0)]])
    rows = df.withColumn("_by", F.col("key"))
    out = run.run_to_files(stateful.process_stream(rows, summing(), retention=(1, "seconds")), "update")
    assert got(out.filter("child = 'tick'"), "value")[0] == (13,)


def test_schedule_and_cancel():
    ctx, ticks = Context({}), []
    cancel = ctx.schedule((10, "seconds"), "stream-time", ticks.append)
    for now in (0, 5_000, 10_000, 45_000, 49_000, 50_000):
        ctx.advance(now)
    assert ticks == [10_000, 45_000, 50_000]  # skipped ticks are not made up for
    cancel()
    ctx.advance(90_000)
    assert len(ticks) == 3
    with pytest.raises(ValueError):
        ctx.schedule(10, "lunar-time", ticks.append)


def test_processor_rules(spark):
    class Forwards:
        value_type = "bigint"

        def on_record(self, ctx, state, record):
            ctx.forward("k", 1)

    df = Stream(records(spark, [("a", 1, 1)])).process_values(Forwards).df
    with pytest.raises(Exception, match="forwarding is not allowed"):
        df.collect()

    class NoRecord:
        key_type, value_type = "string", "bigint"

    with pytest.raises(ValueError):
        Stream(records(spark, [("a", 1, 1)])).process(NoRecord)


def test_restart_publishes_nothing_twice(spark):
    df, path, append = file_stream(spark, [[("a", 1, 1)], [("b", 2, 2)]])
    topics = TopicDataset(spark, fresh_path(spark, "topics"), "string", "bigint", partitions=2)
    checkpoint = fresh_path(spark, "checkpoint")
    start = lambda: topics.stream_sink(df, checkpoint, name="q").awaitTermination()
    start()
    assert topics.read().count() == 2
    append([("a", 3, 4), ("c", 3, 8)])
    start()
    start()
    assert got(topics.read(), "key", "value") == [("a", 1), ("a", 4), ("b", 2), ("c", 8)]
    # a micro-batch that is run again after its transaction was published
    with topics.transaction("q-0") as txn:
        txn.produce(records(spark, [("a", 1, 1)]))
    assert topics.read().count() == 4
    places = topics.read().groupBy("topic", "partition", "offset").count()
    assert places.filter("count > 1").count() == 0


def test_failed_transaction_is_invisible(spark):
    topics = TopicDataset(spark, fresh_path(spark, "topics"), "string", "bigint")
    with pytest.raises(RuntimeError):
        with topics.transaction() as txn:
            txn.produce(records(spark, [("a", 1, 1)]))
            raise RuntimeError("lost")
    assert topics.read().count() == 0
    assert topics.read(isolation="read_uncommitted").count() == 0
    open_txn = topics.transaction()
    open_txn.produce(records(spark, [("b", 1, 1)]))
    assert topics.read().count() == 0
    assert topics.read(isolation="read_uncommitted").count() == 1
    open_txn.commit()
    assert got(topics.read(), "key", "offset") == [("b", 0)]
    assert got(topics.end_offsets(), "offset") == [(1,)]


def test_two_sends_in_one_transaction_number_on(spark):
    topics = TopicDataset(spark, fresh_path(spark, "topics"), "string", "bigint")
    with topics.transaction() as txn:
        txn.produce(records(spark, [("a", 1, 1), ("b", 2, 2)]))
        txn.produce(records(spark, [("c", 1, 3)]))
    topics.produce(records(spark, [("d", 0, 4)]))
    assert got(topics.read(), "offset", "key") == [(0, "a"), (1, "b"), (2, "c"), (3, "d")]


def test_upkeep(spark):
    topics = TopicDataset(spark, fresh_path(spark, "topics"), "string", "bigint")
    topics.produce(records(spark, [("a", 1, 1), ("b", 2, 2), ("a", 3, 3), ("c", 4, 4)]))
    topics.rewrite(upkeep.compact_topic(topics.read()))
    assert got(topics.read(), "offset", "key", "value") == [(1, "b", 2), (2, "a", 3), (3, "c", 4)]
    topics.rewrite(upkeep.delete_records_before(topics.read(), {("t", 0): 2}))
    assert got(topics.read(), "offset") == [(2,), (3,)]
    assert got(upkeep.lowest_offsets(topics.read()), "offset") == [(2,)]
    topics.produce(records(spark, [("d", 9, 9)]))
    assert got(topics.read(), "offset") == [(2,), (3,), (4,)]
    kept = upkeep.repartition_topic(topics.read(), 4, from_offsets={("t", 0): 4})
    assert got(kept.filter("offset < 4"), "partition") == [(0,), (0,)]
    with pytest.raises(Exception, match="without a key"):
        upkeep.compact_topic(records(spark, [(None, 1, 1)])).collect()


def test_read_stream_of_a_topic_and_metrics(spark):
    topics = TopicDataset(spark, fresh_path(spark, "topics"), "string", "bigint")
    topics.produce(records(spark, [("a", 1, 1), ("b", 2, 2)]))
    df = topics.read_stream("t", max_files=1).groupBy("key").agg(F.sum("value").alias("value"))
    path = fresh_path(spark, "out")
    query = run.start_to_files(df, path, f"{path}-checkpoint", "update")
    query.awaitTermination()
    assert got(spark.read.parquet(path), "key", "value") == [("a", 1), ("b", 2)]
    metrics = upkeep.stream_metrics(spark, query)
    assert metrics.filter("group = 'query' AND name = 'numInputRows'").agg(F.sum("value")).first()[0] == 2


def test_two_streams_into_one_topic(spark):
    topics = TopicDataset(spark, fresh_path(spark, "topics"), "string", "bigint")
    for rows in ([("a", 1, 1), ("b", 2, 2)], [("c", 1, 3)]):
        topics.stream_sink(file_stream(spark, [rows])[0], fresh_path(spark, "checkpoint")).awaitTermination()
    assert got(topics.read(), "key", "offset") == [("a", 0), ("b", 1), ("c", 2)]


def test_offsets_go_on_after_pruning_and_aborts(spark):
    topics = TopicDataset(spark, fresh_path(spark, "topics"), "string", "bigint")
    topics.produce(records(spark, [("a", 1, 1), ("b", 2, 2)]))
    topics.commit_offsets("g", topics.read())
    topics.rewrite(upkeep.delete_records_before(topics.read(), {("t", 0): 2}))
    assert topics.read().count() == 0
    assert got(topics.beginning_offsets(), "offset") == got(topics.end_offsets(), "offset") == [(2,)]
    lost = topics.transaction()
    lost.produce(records(spark, [("x", 1, 1)]))
    lost.abort()
    topics.produce(records(spark, [("c", 3, 3)]))
    assert got(topics.read_uncommitted_by("g"), "key", "offset") == [("c", 2)]
    # the committed record has the offset of the aborted one and is not taken for its repetition
    again = run.run_to_files(topics.read_stream("t", max_files=1, deduplicate="1 hour").select("key", "offset"))
    assert got(again.filter("offset = 2"), "key") == [("c",), ("x",)]


def test_committed_stream(spark):
    """Aborted, unpublished and rewritten records do not come; published ones come once."""
    topics = TopicDataset(spark, fresh_path(spark, "topics"), "string", "bigint")
    path, checkpoint = fresh_path(spark, "out"), fresh_path(spark, "checkpoint")
    sink = lambda batch, i: batch.write.mode("overwrite").parquet(f"{path}/batch={i}")
    start = lambda: topics.stream_committed(sink, checkpoint, "t").awaitTermination()
    send = lambda txn, *keys: txn.produce(records(spark, [(k, 1, 1) for k in keys]))
    lost, open_ = topics.transaction(), topics.transaction()
    send(lost, "x")
    lost.abort()
    send(open_, "later")
    topics.produce(records(spark, [("a", 1, 1), ("a", 2, 2)]))
    topics.rewrite(upkeep.compact_topic(topics.read()))
    start()
    assert got(spark.read.parquet(path), "key", "value") == [("a", 2)]
    open_.commit()
    topics.produce(records(spark, [("b", 1, 1)]))
    topics.rewrite(upkeep.compact_topic(topics.read()))
    start()
    start()
    assert got(spark.read.parquet(path), "key") == [("a",), ("b",), ("later",)]


def test_table_joins_keep_records_of_one_place(spark):
    """Flat-mapped records share topic, partition, offset and time."""
    split = lambda k, v: F.transform(F.sequence(F.lit(1), F.lit(3)), lambda i: F.struct(k.alias("key"), (v + i).alias("value")))
    left = [[("a", 2, 10), ("a", 2, 20)], [("a", 6, 30)], END]
    stream = lambda: Stream(file_stream(spark, left)[0]).fmap_kv(split)
    table = Table(file_stream(spark, [[("a", 1, 7)], [("a", 4, 8)], END])[0])
    joined = stream().left_join_table(table, lambda v, t: F.struct(v.alias("v"), t.alias("t")))
    rows = run.run_to_files(joined.df.select("key", "value.*")).filter("key = 'a'")
    assert got(rows, "v", "t") == sorted([(10 + i, 7) for i in (1, 2, 3)] + [(20 + i, 7) for i in (1, 2, 3)] + [(30 + i, 8) for i in (1, 2, 3)], key=repr)
    right = file_stream(spark, [[("b", 2, 1)], [("a", 3, 1)], END])[0]
    eager = stateful.eager_left_join(stream().df, right, lambda l, r: F.struct(l.alias("l"), r.alias("r")), "2 seconds")
    pairs = run.run_to_files(eager.select("key", "value.*")).filter("key = 'a' and r is not null")
    assert got(pairs, "l") == [(10 + i,) for i in (1, 2, 3)] + [(20 + i,) for i in (1, 2, 3)]


def test_topic_selection_errors(spark):
    df = records(spark, [("a", 1, 1)])
    with pytest.raises(ValueError):
        P.add_source(df, "t")
    with pytest.raises(ValueError):
        P.subscribe(df, [])
    assert P.add_source(df, ["t"]).count() == 1
    assert P.assign(df, []).count() == 0


def test_do_kv_and_sink_do(spark):
    seen = spark.sparkContext.accumulator(0)
    stream = Stream(records(spark, [("a", 1, 1), ("b", 2, 2)]))
    assert stream.do_kv(lambda k, v: seen.add(int(v))).df.count() == 2
    seen.value = 0
    stream.sink_do(lambda k, v: seen.add(v))
    assert seen.value == 3
    stream.sink_process(summing())


def test_global_store_and_through_topic(spark):
    topics = TopicDataset(spark, fresh_path(spark, "topics"), "string", "bigint")
    topics.produce(records(spark, [("a", 1, 1), ("a", 2, 2), ("b", 3, 5)]))
    table = topics.global_store("t", summing())
    assert got(table.filter_kv(lambda k, v: v > 0).snapshot().filter("key IS NOT NULL"), "key", "value") == [("a", 3), ("b", 5)]
    out = topics.stream("t").map_values(lambda k, v: v * 10).through_topic(topics, "next")
    assert got(out.df, "key", "value") == [("a", 10), ("a", 20), ("b", 50)]
    assert got(P.list_topics(topics.read()), "topic", "partitions") == [("next", 1), ("t", 1)]


def test_latest_and_start_positions(spark):
    topics = TopicDataset(spark, fresh_path(spark, "topics"), "string", "bigint")
    topics.produce(records(spark, [("a", 1, 1), ("b", 2, 2)]))
    live = topics.read_stream("t", policy="latest").select("key")
    later = topics.read_stream("t", start={("t", 0): 1}).select("key")
    topics.produce(records(spark, [("c", 3, 3)]))
    assert got(run.run_to_files(live), "key") == [("c",)]
    assert got(run.run_to_files(later), "key") == [("b",), ("c",)]


def test_state_of_a_running_count(spark):
    df, _, _ = file_stream(spark, [[("a", 1, 1), ("b", 2, 2)], [("a", 3, 4)]])
    path = fresh_path(spark, "out")
    counts = Stream(df).group_by_key().reduce_values(folds.count()).snapshot()
    run.start_to_files(counts, path, f"{path}-checkpoint", "update").awaitTermination()
    state = stores.streaming_state(spark, f"{path}-checkpoint")
    assert sorted((r["key"]["key"], r["value"][0]) for r in state.collect()) == [("a", 2), ("b", 1)]


def test_json_lines_and_python_codec(spark):
    path = fresh_path(spark, "json")
    rows = records(spark, [("a", 1, None), ("b", 2, 2**62 + 1)])
    rows.write.json(path)
    df = connector(spark, "json", schema=rows.schema, path=path)
    assert got(df, "key", "value") == [("a", None), ("b", 2**62 + 1)]
    headed = df.withColumn("headers", F.array().cast("array<struct<key:string,value:binary>>"))
    assert got(Stream(headed).do_kv(lambda k, v: None).df, "key", "value") == [("a", None), ("b", 2**62 + 1)]
    text = codec.encode_with(headed, lambda data, topic, headers: f"{topic}:{data}".encode(), "binary")
    assert got(codec.decode_with(text, lambda data, topic, headers: int(data.split(b":")[1]), "bigint"), "value") == [
        (2**62 + 1,), (None,)]


def test_ordered_folds_on_streams(spark):
    """Per key, per window, per sliding window and per session, over three micro-batches."""
    fold = folds.RowFold(lambda: "", lambda agg, k, v: f"{agg}{v},", "string", merge=lambda a, b: a + b)
    batches = [[("a", 2, 1), ("a", 1, 2)], [("a", 5, 3), ("b", 5, 4)], [("a", 12, 5)], END]
    grouped = lambda: Stream(file_stream(spark, batches)[0]).group_by_key()
    only = lambda df: df.filter("key <> 'zz'")
    latest = run.latest(run.run_to_files(grouped().reduce_values(fold).snapshot(), "update"), ["key"])
    assert got(only(latest), "key", "value") == [("a", "2,1,3,5,"), ("b", "4,")]
    windows = run.run_to_files(grouped().window((10, "seconds")).reduce_windows(fold).df, "update")
    assert got(only(run.latest(windows, ["key", "window_from"])), "key", "window_from", "value") == [
        ("a", 0, "2,1,3,"), ("a", 10000, "5,"), ("b", 0, "4,")]
    sliding = run.run_to_files(grouped().window((4, "seconds"), "sliding").reduce_windows(fold).df)
    assert got(only(sliding), "key", "window_to", "value") == [
        ("a", 1000, "2,"), ("a", 12000, "5,"), ("a", 2000, "2,1,"), ("a", 5000, "2,1,3,"), ("b", 5000, "4,")]
    sessions = run.run_to_store(
        grouped().window_by_session((5, "seconds")).reduce_sessions(fold).df, fresh_path(spark, "s").rsplit("/", 1)[1])
    assert got(only(sessions.snapshot()), "key", "window_from", "value") == [
        ("a", 1000, "2,1,3,"), ("a", 12000, "5,"), ("b", 5000, "4,")]


def test_sliding_windows_of_one_key_spread_over_time_buckets(spark):
    """No group holds more than a stretch of a hot key, and windows that reach into the bucket before are whole, over late and early records."""
    span = 2000
    times = [(i * 37) % 400 + 1 for i in range(400)]
    batches = [[("a", t, t) for t in times[i::3]] for i in range(3)] + [[("b", 150, 7)], END]
    df, path, _ = file_stream(spark, batches)
    rows = spark.read.parquet(path).filter("key = 'a'").withColumn("_ms", F.unix_millis("timestamp"))
    spread, width = stateful._sliding_buckets(rows, span)
    sizes = [r["count"] for r in spread.groupBy("key", "_b").count().collect()]
    assert len(sizes) == 400_000 // width + 1 and max(sizes) <= (width + span) // 1000
    fold = folds.together(n=folds.count(), total=folds.total(lambda k, v: v), low=folds.minimum(lambda k, v: v))
    out = run.run_to_files(Stream(df).group_by_key().window(span, "sliding", retention="1 hour").reduce_windows(fold).df)
    near = lambda t: [x for x in range(1, 401) if t - 2 <= x <= t]
    wanted = sorted(("a", t * 1000, len(near(t)), sum(near(t)), min(near(t))) for t in range(1, 401))
    found = out.filter("key = 'a'").select("key", "window_to", "value.*").collect()
    assert sorted(tuple(r) for r in found) == wanted
    assert out.filter("key = 'b'").count() == 1


def test_previous_times_by_stretches(spark, monkeypatch):
    """Over several micro-batches and stretches of offsets, out of order within a batch; records of a partition pass its task one at a time."""
    monkeypatch.setattr(stateful, "OFFSETS", 3)
    batches = [[("a", 5 * i % 17, i) for i in range(11)], [("b", 40 - i, i) for i in range(7)], [("c", None, 0), ("c", 3, 1)]]
    df, path, _ = file_stream(spark, batches)
    kept = spark.read.parquet(path).orderBy("offset").select("offset", F.unix_millis("timestamp").alias("ms")).collect()
    out = run.run_to_files(stateful.with_previous_time(df).select("offset", F.unix_millis("_previous.timestamp").alias("before")))
    assert got(out, "offset", "before") == sorted(
        ((r["offset"], None if i == 0 else kept[i - 1]["ms"]) for i, r in enumerate(kept)), key=repr)

    def endless():
        while True:
            yield {"_record": 1, "_before": at(1), "_last": None, "offset": 5, "timestamp": at(2)}

    assert next(stateful._PreviousTime().handleInputRows(("t", 0, False, 1), endless(), None))["_previous"] == {"timestamp": at(1)}
