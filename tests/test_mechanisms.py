"""State mechanisms on streams over several micro-batches against plain versions, stores, zones and joins."""

import glob
import math
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from helpers import at, got, records
from test_live import END, file_stream
from tideway.functions import folds
from tideway.operators import upkeep
from tideway.operators.processors import clocks, taken_up
from tideway.operators.stores import Store, query_store
from tideway.operators.stream import Stream, add_processor, add_sink
from tideway.operators.table import Table
from tideway.session import fresh_path
from tideway.sources.topics import TopicDataset
from tideway.streaming import run, stateful

NAME = lambda spark: fresh_path(spark, "s").rsplit("/", 1)[1]


def updates(seed, batches=5, n=40, keys="abcdef"):
    """Batches of updates (key, seconds, value), unique times, in shuffled order; some values are deletes."""
    rng = random.Random(seed)
    times = rng.sample(range(1, 10_000), batches * n)
    rows = [(rng.choice(keys), t, rng.choice([None, *range(1, 40)])) for t in times]
    return [rows[i * n:(i + 1) * n] for i in range(batches)]


def grouped_by_tens(table):
    return table.map_and_group_by(lambda k, v: (F.when(v < 35, F.floor(v / 10)), v))


def latest_by_tens(batches):
    last, seen = {}, set()
    for k, t, v in sorted((r for b in batches for r in b), key=lambda r: r[1]):
        last[k] = v
        if v is not None and v < 35:
            seen.add(v // 10)
    live = [v for v in last.values() if v is not None and v < 35]
    return sorted((g, sum(1 for v in live if v // 10 == g), sum(v for v in live if v // 10 == g)) for g in seen)


@pytest.mark.parametrize("seed", [1, 2])
def test_regrouped_table_on_a_stream(spark, seed):
    """Totals are those of the latest values in the table's order, though updates arrive in another; a group seen stays with 0 unless its only
    members came too late to count at all."""
    batches = updates(seed)
    table = Table(file_stream(spark, batches)[0], order=["timestamp"])
    fold = folds.together(n=folds.count(), total=folds.total(lambda k, v: v))
    out = grouped_by_tens(table).reduce_values(fold).snapshot()
    rows = run.run_to_store(out, NAME(spark), "append").snapshot()
    live = [r for r in got(rows, "key", "value.n", "value.total") if r[1]]
    assert live == [r for r in latest_by_tens(batches) if r[1]]
    add, sub = (lambda agg, k, v: agg + v), (lambda agg, k, v: agg - v)
    table = Table(file_stream(spark, batches)[0], order=["timestamp"])
    out = grouped_by_tens(table).reduce_values(add, sub, lambda: 0, "bigint").snapshot()
    rows = run.run_to_store(out, NAME(spark), "append").snapshot()
    assert [r for r in got(rows, "key", "value") if r[1]] == [(g, t) for g, n, t in latest_by_tens(batches) if t]


def most_state(query):
    return max(p["stateOperators"][-1]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"])


def test_regrouped_keys_share_state(spark, monkeypatch):
    """Two hundred keys are two slots; over ten micro-batches, parts of changes are put together, and keys that leave stay away."""
    monkeypatch.setattr(stateful, "SLOTS", 2, raising=False)
    keys = [f"k{i}" for i in range(200)]
    batches = [[(k, 1, i % 30 + 1) for i, k in enumerate(keys)], *[[(keys[j], 2 + j, None if j % 2 else 39)] for j in range(12)]]
    want = [r for r in latest_by_tens(batches) if r[1]]
    for python in (False, True):
        table = grouped_by_tens(Table(file_stream(spark, batches)[0], order=["timestamp"]))
        out = table.reduce_values(lambda agg, k, v: agg + v, lambda agg, k, v: agg - v, lambda: 0, "bigint") if python else table.reduce_values(
            folds.together(n=folds.count(), total=folds.total(lambda k, v: v)))
        query, store = run.start_to_store(out.snapshot(), NAME(spark), f"{fresh_path(spark, 'c')}", "append")
        query.awaitTermination()
        rows = got(store.snapshot(), "key", "value" if python else "value.total")
        assert [r for r in rows if r[1]] == [(g, t) for g, n, t in want if t]
        assert most_state(query) < 40


def test_updating_sessions_share_state(spark, monkeypatch):
    """Forty keys in two slots: sessions grow, are bridged, and are forgotten by one timer of their slot."""
    monkeypatch.setattr(stateful, "SLOTS", 2, raising=False)
    keys = [f"k{i}" for i in range(40)]
    batches = [[(k, t, 1) for k in keys for t in (110, 100)], [(k, 105, 1) for k in keys], [("zz", 100_000, 1)], [("k1", 100_001, 1)]]
    fold = folds.RowFold(lambda: 0, lambda agg, k, v: agg + v, "bigint", merge=lambda a, b: a + b)
    out = stateful.updating_sessions(file_stream(spark, batches)[0], fold, "6 seconds", "1 minute")
    query, store = run.start_to_store(out, NAME(spark), fresh_path(spark, "c"), "update")
    query.awaitTermination()
    want = [(k, 100_000, 110_000, 3) for k in keys] + [("k1", 100_001_000, 100_001_000, 1), ("zz", 100_000_000, 100_000_000, 1)]
    assert got(store.snapshot(), "key", "window_from", "window_to", "value") == sorted(want)
    assert most_state(query) < 20


def test_regrouping_is_summed_before_the_shuffle(spark, monkeypatch):
    monkeypatch.setattr(stateful, "SUMS_HELD", 10)
    rows = spark.range(1000).select((F.col("id") % 7).alias("key"), F.col("id").alias("a"), F.col("id").cast("decimal(38,2)").alias("b")).coalesce(1)
    sums = stateful._summed_before_the_shuffle(rows, ["a", "b"])
    assert sums.count() < 500
    total = sums.groupBy("key").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    assert got(total, "key", "a") == sorted((k, sum(range(k, 1000, 7))) for k in range(7))
    assert total.where("a <> b").count() == 0


def test_a_minimum_cannot_be_regrouped(spark):
    table = Table(file_stream(spark, updates(1, 1))[0], order=["timestamp"])
    with pytest.raises(ValueError, match="cannot take a replaced value back out"):
        grouped_by_tens(table).reduce_values(folds.minimum(lambda k, v: v))


def test_merged_pieces_of_groups(spark):
    """The Python form with `merge` equals the one without, also for a group that is most of the table."""
    batches = updates(5, batches=1, n=300, keys=[f"k{i}" for i in range(60)])
    table = Table(records(spark, batches[0]), order=["timestamp"])
    add, sub = (lambda agg, k, v: agg + v), (lambda agg, k, v: agg - v)
    plain = grouped_by_tens(table).reduce_values(add, sub, lambda: 0, "bigint").snapshot()
    merged = grouped_by_tens(table).reduce_values(add, sub, lambda: 0, "bigint", merge=lambda a, b: a + b).snapshot()
    assert got(plain, "key", "value") == got(merged, "key", "value") == [(g, t) for g, _, t in latest_by_tens(batches)]


# -- eager joins ------------------------------------------------------------------------------------


def brute_eager(batches, reach, how):
    """Micro-batches of (side, key, seconds, value), each taken in order of time, left first."""
    seen, out = [], []
    for batch in batches:
        for side, k, t, v in sorted(batch, key=lambda r: (r[2], r[0])):
            partners = [x for x in seen if x[0] != side and x[1] == k and abs(x[2] - t) <= reach]
            if not partners and (how == "outer" or how == "left" and side == 0):
                out.append((k, v, None) if side == 0 else (k, None, v))
            out += [(k, v, x[3]) if side == 0 else (k, x[3], v) for x in partners]
            seen.append((side, k, t, v))
    return sorted(out, key=repr)


@pytest.mark.parametrize("how", ["outer", "left", "inner"])
def test_eager_joins(spark, how):
    rng = random.Random(7)
    sides = [[[(rng.choice("ab"), rng.randint(1000, 1060), 100 * s + 1000 * b + i) for i in range(25)] for b in range(3)] for s in (0, 1)]
    left, right = (Stream(file_stream(spark, side + [END])[0]) for side in sides)
    join = {"outer": left.outer_join_stream, "left": left.left_join_stream, "inner": left.join_stream}[how]
    pair = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    out = run.run_to_files(join(right, pair, (3, "seconds"), emit="eager", retention="1 hour").df)
    batches = [[(s, *r) for s in (0, 1) for r in sides[s][b]] for b in range(3)]
    assert got(out.filter("key <> 'zz'"), "key", "value.a", "value.b") == brute_eager(batches, 3, how)


def test_eager_state_goes(spark):
    left, right = (file_stream(spark, [[("a", 10, 1)], [("b", 100_000, 2)], [("b", 200_000, 3)], [("a", 11, 9)]])[0] for _ in range(2))
    joined = stateful.eager_join(left, right, lambda a, b: F.struct(a.alias("a"), b.alias("b")), (2, "seconds"), "outer", (5, "seconds"))
    path = fresh_path(spark, "out")
    query = run.start_to_files(joined, path, f"{path}-checkpoint")
    query.awaitTermination()
    kept = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    assert kept < 12  # the lists of the first buckets are gone


def test_eager_keys_share_state(spark, monkeypatch):
    """Forty keys in one time bucket are two groups; keys that are no number or a negative zero meet as Spark groups them."""
    monkeypatch.setattr(stateful, "SHARDS", 2, raising=False)
    keys = [float(i) for i in range(40)] + [math.nan]
    left = file_stream(spark, [[(k, 1000, i) for i, k in enumerate(keys)], [(3.0, 1001, 77)]], key="double")[0]
    right = file_stream(spark, [[(k if k else -0.0, 1001, 100 + i) for i, k in enumerate(keys)], [(3.0, 1002, 88)]], key="double")[0]
    joined = stateful.eager_join(left, right, lambda a, b: F.struct(a.alias("a"), b.alias("b")), (2, "seconds"), "outer", "1 hour")
    path = fresh_path(spark, "out")
    query = run.start_to_files(joined.select("value.*"), path, f"{path}-checkpoint")
    query.awaitTermination()
    # in the first micro-batch left records come first, each by itself
    want = [(i, None) for i in range(41)] + [(i, 100 + i) for i in range(41)] + [(3, 88), (77, 103), (77, 88)]
    assert got(spark.read.schema("a bigint, b bigint").parquet(path), "a", "b") == sorted(want, key=repr)
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] < 20


# -- sliding windows --------------------------------------------------------------------------------


@pytest.mark.parametrize("by_columns", [True, False])
def test_sliding_keys_share_state(spark, monkeypatch, by_columns):
    """Forty keys hold two groups per time bucket; a late key of a shard whose earlier moments are answered is whole, too."""
    monkeypatch.setattr(stateful, "SHARDS", 2)
    keys = [float(i) for i in range(40)] + [math.nan]
    batches = [[(k, 1000 + t, 1) for k in keys for t in (0, 2, 1)], [(-0.0, 1001, 5), (99.0, 1004, 7)], [(77.0, 2000, 1)], [(77.0, 2001, 1)]]
    df, _, _ = file_stream(spark, batches, key="double")
    fold = folds.total(lambda k, v: v) if by_columns else folds.RowFold(
        lambda: 0, lambda agg, k, v: agg + v, "bigint", merge=lambda a, b: a + b)
    path = fresh_path(spark, "out")
    out = stateful.sliding_windows(df.repartition(1), fold, "1 second", "20 seconds")
    query = run.start_to_files(out, path, f"{path}-checkpoint")
    query.awaitTermination()
    rows = spark.read.schema(out.schema).parquet(path).filter("key <> 77")
    want = [(k, 1000 + t, n) for k in keys if k for t, n in ((0, 1), (1, 2), (2, 2))] + [(0.0, 1000, 1), (0.0, 1001, 7), (0.0, 1002, 7), (99.0, 1004, 7)]
    found = [(abs(k), to // 1000, v) for k, to, v in rows.select("key", "window_to", "value").collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, want))
    most = max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"])
    assert most < 20


def test_two_stacks():
    rng = random.Random(3)
    merges = [0]

    def merge(a, b):
        merges[0] += 1
        return a + b

    stacks, points, t = stateful.TwoStacks(merge), [], 0
    for i in range(3000):
        t += rng.randint(0, 3)
        points.append((t, f"{i},"))
        stacks.push(t, f"{i},")
        stacks.evict(t - 50)
        assert stacks.value() == "".join(v for at, v in points if t - 50 <= at)
    assert merges[0] < 3 * 3000


def test_sliding_takes_linear_time():
    """10^5 points, all of them in one window."""
    stacks, merges = None, [0]

    def merge(a, b):
        merges[0] += 1
        return a + b

    stacks = stateful.TwoStacks(merge)
    for t in range(100_000):
        stacks.push(t, 1)
        stacks.evict(t - 60_000)
        assert stacks.value() == min(t, 60_000) + 1
    assert merges[0] < 300_000


@pytest.mark.parametrize("fold", [
    folds.together(n=folds.count(), low=folds.minimum(lambda k, v: v), high=folds.maximum(lambda k, v: v), mean=folds.mean(lambda k, v: v)),
    folds.together(s=folds.minimum(lambda k, v: v.cast("string")), d=folds.total(lambda k, v: v.cast("decimal(10,2)"))),
])
def test_one_fold_slides_on_batches_and_streams(spark, fold):
    rng = random.Random(9)
    rows = [(rng.choice("ab"), rng.randint(1, 300), rng.choice([None, *range(50)])) for _ in range(240)]
    rng.shuffle(rows)
    df, path, _ = file_stream(spark, [rows[i::4] for i in range(4)] + [END])
    slide = lambda d: Stream(d).group_by_key().window((20, "seconds"), "sliding", retention="1 hour").reduce_windows(fold).df
    live = run.run_to_files(slide(df)).filter("key <> 'zz'")
    assert got(live, "key", "window_from", "window_to", "value") == got(slide(spark.read.parquet(path)).filter("key <> 'zz'"), "key", "window_from", "window_to", "value")


def test_numbers_that_are_none_are_largest():
    assert stateful._smaller(math.nan, 1.0) == stateful._smaller(1.0, math.nan) == 1.0
    assert math.isnan(stateful._larger(math.nan, 1.0)) and math.isnan(stateful._larger(1.0, math.nan))


# -- ordered folds by Columns ------------------------------------------------------------------------


def chain():
    """Joins values in order, as text."""
    return folds.OrderedFold(seed=F.lit(""), step=lambda agg, k, v: F.concat(agg, v.cast("string"), F.lit(",")),
                             merge=lambda a, b: F.concat(a, b), finish=lambda agg: F.concat(F.lit("<"), agg), block=4)


def test_ordered_fold_of_a_shuffled_stream(spark):
    rng = random.Random(11)
    rows = [(rng.choice("abc"), t, rng.choice([None, *range(90)])) for t in rng.sample(range(1, 2000), 150)]
    df, path, append = file_stream(spark, [rows[i::5] for i in range(4)])
    checkpoint, name = fresh_path(spark, "checkpoint"), NAME(spark)
    live = Stream(df).group_by_key().reduce_values(chain())
    with pytest.raises(ValueError, match="kept in a store"):
        live.snapshot()
    store = live.to_store(name, checkpoint, retention="1 hour")
    append(rows[4::5])
    append(END)
    append(END)
    store = live.to_store(name, checkpoint, retention="1 hour")  # a restart goes on
    whole = Stream(spark.read.parquet(path)).group_by_key().reduce_values(chain()).snapshot()
    assert got(store.snapshot().filter("key <> 'zz'"), "key", "value") == got(whole.filter("key <> 'zz'"), "key", "value")


def test_replayed_batches_of_a_live_fold(spark):
    """A part is made from the parts before it, so writing it again changes nothing."""
    store = Store(spark, NAME(spark), spark.createDataFrame([], "key string, value bigint").schema)
    frame = lambda *rows: spark.createDataFrame(rows, "key string, value bigint")
    store.upsert(frame(("a", 1)), 0)
    store.upsert(frame(("a", 2)), 1)
    store.upsert(frame(("a", 3), ("b", 3)), 2)
    assert got(store.before(1), "key", "value") == [("a", 1)] and got(store.before(7), "key", "value") == [("a", 3), ("b", 3)]
    store.upsert(frame(("a", 9)), 1)
    assert got(store.snapshot(), "key", "value") == [("a", 3), ("b", 3)] and got(store.part(1), "value") == [(9,)]


def test_ordered_fold_of_maps(spark):
    rows = records(spark, [("a", t, t) for t in range(1, 30)]).withColumn("value", F.create_map(F.lit("v"), F.col("value")))
    fold = folds.OrderedFold(seed=F.lit(0).cast("bigint"), step=lambda agg, k, v: (agg * 3 + v["v"]) % 1009, merge=lambda a, b: a, block=64)
    wanted = 0
    for t in range(1, 30):
        wanted = (wanted * 3 + t) % 1009
    assert got(Stream(rows).group_by_key().reduce_values(fold).snapshot(), "key", "value") == [("a", wanted)]


# -- processors ---------------------------------------------------------------------------------------


def counting():
    class Counting:
        """Counts in what `init` returned; the timer's callback sees the same object."""

        key_type, value_type = "string", "bigint"

        def init(self, ctx):
            state = {"n": 0}
            ctx.schedule((10, "seconds"), "stream-time", lambda now: ctx.forward("tick", state["n"], child="tick"))
            return state

        def on_record(self, ctx, state, record):
            state["n"] += 1
            ctx.forward(record["key"], state["n"], child="count")

    return Counting


def test_state_of_init_lasts(spark, small_chunks):
    """One micro-batch per record on the stream; rounds of a hot key on the batch."""
    rows = [("a", t, 0) for t in range(1, 61)]
    df, path, _ = file_stream(spark, [rows[i:i + 15] for i in range(0, 60, 15)])
    live = run.run_to_files(Stream(df).process(counting(), time_mode="None").df, "update")
    batch = Stream(spark.read.parquet(path)).process(counting()).df
    of = lambda df, child: sorted(r["value"] for r in df.filter(F.col("child") == child).collect())
    for child, wanted in (("count", list(range(1, 61))), ("tick", [10, 20, 30, 40, 50])):
        assert of(batch, child) == of(live, child) == wanted


def test_state_of_init_lasts_in_event_time(spark):
    df, _, _ = file_stream(spark, [[("a", 1, 1)], [("a", 3, 4)], [("a", 25, 8)], [("a", 100_000, 0)], [("a", 100_001, 0)]])
    out = run.run_to_files(Stream(df).process(counting(), retention=(1, "seconds")).df, "update")
    assert got(out.filter("child = 'count'"), "value") == [(1,), (2,), (3,), (4,), (5,)]
    assert got(out.filter("child = 'tick'"), "value")[0] == (4,)  # after the records of the micro-batch that the watermark reaches


def test_records_without_key_have_state_by_partition(spark):
    rows = [records(spark, [(None, t, 1) for t in range(1, 4)], topic=topic, partition=p) for topic, p in (("x", 0), ("x", 1), ("y", 0))]
    rows = rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(records(spark, [("a", 1, 1), ("a", 2, 1)]))
    path = fresh_path(spark, "in")
    rows.write.parquet(path)
    wanted = sorted([(t, p, n) for t, p in (("x", 0), ("x", 1), ("y", 0)) for n in (1, 2, 3)] + [("t", 0, 1), ("t", 0, 2)])
    live = spark.readStream.schema(rows.schema).parquet(path)
    for df, run_ in ((rows, lambda d: d), (live, lambda d: run.run_to_files(d, "update"))):
        out = run_(Stream(df).process(counting(), time_mode="None").df if df.isStreaming else Stream(df).process(counting()).df)
        assert got(out.filter("child = 'count'"), "topic", "partition", "value") == wanted


def test_taken_up():
    fresh = {"a": 0}
    assert taken_up(fresh, {"b": 1}) is fresh and fresh == {"b": 1}
    assert taken_up([1], [2, 3]) == [2, 3] and taken_up({1}, {2}) == {2} and taken_up(None, 5) == 5


def waking():
    class Waking:
        """Forwards by wall clock and, beside it, by event time."""

        key_type, value_type = "string", "bigint"

        def init(self, ctx):
            state = {"n": 0}
            ctx.schedule((300, "milliseconds"), "wall-clock-time", lambda now: ctx.forward("wall", state["n"], child="wall"))
            ctx.schedule((10, "seconds"), "stream-time", lambda now: ctx.forward("event", state["n"], child="event"))
            return state

        def on_record(self, ctx, state, record):
            state["n"] += 1

    return Waking


def test_wall_clock_timers(spark):
    """A key without further records is woken by the clock again and again."""
    assert clocks(waking()) == {"wall-clock-time", "stream-time"} and clocks(counting()) == {"stream-time"}
    df, _, append = file_stream(spark, [[("a", 1, 1), ("a", 15, 2)]])
    path = fresh_path(spark, "out")
    out = Stream(df).process(waking()).df
    write = lambda batch, i: batch.write.mode("overwrite").parquet(f"{path}/batch={i}")
    query = out.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{path}-c").trigger(processingTime="200 milliseconds").start()
    try:
        rows, until = [], time.time() + 60
        while sum(r["child"] == "wall" for r in rows) < 3 and time.time() < until:
            time.sleep(1)
            if os.path.isdir(path.removeprefix("file:")):
                rows = spark.read.schema(out.schema).parquet(path).collect()
    finally:
        query.stop()
    assert sum(r["child"] == "wall" for r in rows) >= 3 and all(r["value"] == 2 for r in rows if r["child"] == "wall")
    assert [r["value"] for r in rows if r["child"] == "event"] == [1]


def test_wall_clock_timers_are_not_ignored(spark):
    class Late:
        key_type, value_type = "string", "bigint"

        def on_record(self, ctx, state, record):
            ctx.schedule((1, "seconds"), "wall-clock-time", lambda now: None)

    df, _, _ = file_stream(spark, [[("a", 1, 1)]])
    with pytest.raises(Exception, match="need processing time"):
        run.run_to_files(Stream(df).process(Late).df, "update")
    with pytest.raises(ValueError, match="unknown time mode"):
        Stream(df).process(Late, time_mode="LunarTime")


def children():
    class Children:
        key_type, value_type = "string", "bigint"

        def on_record(self, ctx, state, record):
            for child in {1: ["x"], 2: ["y"], 3: [None]}.get(record["value"], ["z"]):
                ctx.forward(record["key"], record["value"], child=child)

    return Children


def test_children_as_topics(spark):
    topics = TopicDataset(spark, fresh_path(spark, "topics"), "string", "bigint", partitions=2)
    Stream(records(spark, [("a", 1, 1), ("b", 2, 2), ("c", 3, 3)])).process(children()).sink_children(topics, {"x": "tx", "y": "ty"})
    assert got(topics.read(), "topic", "value") == [("tx", 1), ("tx", 3), ("ty", 2), ("ty", 3)]
    assert topics.manifest().filter("state = 'committed'").count() == 1
    with pytest.raises(Exception, match="no topic for the child z"):
        Stream(records(spark, [("a", 1, 4)])).process(children()).sink_children(topics, {"x": "tx", "y": "ty"})
    assert topics.read().count() == 4


def test_several_parents(spark):
    topics = TopicDataset(spark, fresh_path(spark, "topics"), "string", "bigint")
    parents = [Stream(records(spark, rows, topic=name)) for name, rows in (("l", [("a", 1, 1), ("a", 4, 3)]), ("r", [("a", 2, 3), ("b", 1, 1)]))]
    add_sink(parents, topics, "all")
    assert got(topics.read(), "topic", "key", "value") == [("all", "a", 1), ("all", "a", 3), ("all", "a", 3), ("all", "b", 1)]
    counts = add_processor(parents, counting()).df.filter("child = 'count'")
    assert got(counts, "topic", "key", "value") == [("l", "a", 1), ("l", "a", 3), ("r", "a", 2), ("r", "b", 1)]


def test_global_store_versions(spark):
    """Each micro-batch sees the store as it is then; a replay sees what the batch saw."""
    store = Store.write(NAME(spark), spark.createDataFrame([("a", 1)], "key string, value bigint"))
    df, _, append = file_stream(spark, [[("x", 1, 0)]])
    seen, checkpoint = [], fresh_path(spark, "checkpoint")
    start = lambda: run.join_global_store(df, store, lambda batch, known: batch.crossJoin(F.broadcast(known.select(F.col("value").alias("v")))),
                                          lambda out, i: seen.append((i, out.first()["v"])), checkpoint).awaitTermination()
    start()
    store.kv_put(spark.createDataFrame([("a", 2)], "key string, value bigint"))
    append([("y", 2, 0)])
    start()
    assert seen == [(0, 1), (1, 2)] and got(store.snapshot(0), "value") == [(1,)]
    store.kv_put(spark.createDataFrame([("a", 3)], "key string, value bigint"))
    noted = spark.read.parquet(f"{checkpoint}-versions/batch=1").first()[0]
    assert got(store.snapshot(noted), "value") == [(2,)] and got(store.snapshot(), "value") == [(3,)]


# -- stores -------------------------------------------------------------------------------------------


def test_writers_of_a_store_share_one_sequence(spark):
    frame = lambda *rows: spark.createDataFrame(rows, "key bigint, value bigint")
    store = Store.write(NAME(spark), frame((1, 1), (2, 2)))
    store.kv_put(frame((1, 11), (9, 90)))
    store.upsert(frame((1, 12)), 0, "q")  # a stream's update after a put by hand wins
    assert got(store.snapshot(), "key", "value") == [(1, 12), (2, 2), (9, 90)]
    store.upsert(frame((1, 13)), 0, "other")
    store.upsert(frame((1, 14)), 0, "q")  # a replay takes its own place again
    assert got(store.snapshot(), "key", "value") == [(1, 13), (2, 2), (9, 90)] and store.version() == 3
    assert got(store.snapshot(1), "key", "value") == [(1, 11), (2, 2), (9, 90)]
    store = Store.write(store.name, frame((1, 77)))
    assert got(store.snapshot(), "key", "value") == [(1, 77)]
    store.kv_put(frame((1, 78)))
    again = query_store(spark, store.name, store.schema)
    assert got(again.snapshot(), "key", "value") == [(1, 78)] and again.kv_count() == 1


def test_an_unknown_store_is_empty(spark):
    store = query_store(spark, NAME(spark), "key bigint, value bigint")
    assert store.kv_count() == 0 and store.version() == -1 and store.history().count() == 0
    assert store.kv_offer(spark.createDataFrame([(1, 1)], "key bigint, value bigint")).count() == 0
    assert store.kv_count() == 1


# -- positions and upkeep -------------------------------------------------------------------------------


def test_zones_skip_parts(spark):
    """Files of parts that can't hold the answer are not opened: they could even be damaged."""
    topics = TopicDataset(spark, fresh_path(spark, "topics"), "string", "bigint")
    for part in range(5):
        topics.produce(records(spark, [("a", 100 * part + i, i) for i in (10, 30, 20, 90)]))
    asked = spark.createDataFrame([("t", 0, at(225)), ("t", 0, at(5)), ("t", 0, at(9999)), ("none", 0, at(1))], "topic string, partition int, timestamp timestamp")
    whole = got(topics.offsets_for_timestamps(asked), "topic", "asked", "offset", "timestamp")
    assert [r[2] for r in whole] == [None, 0, 10, None]
    kept = topics.zones().filter("first = 8").first()["part"]
    for f in glob.glob(f"{topics.path.removeprefix('file:')}/data/part=*/**/*.parquet", recursive=True):
        if f"part={kept}/" not in f:
            os.remove(os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc"))
            with open(f, "wb") as out:
                out.write(b"damaged")
    assert got(topics.offsets_for_timestamps(asked), "topic", "asked", "offset", "timestamp") == whole


def test_repartitioning_in_place_numbers_on(spark):
    df = records(spark, [(f"k{i}", i, i) for i in range(40)])
    moved = upkeep.repartition_topic(df, 4, from_offsets={("t", 0): 20})
    assert moved.count() == moved.select("partition", "offset").distinct().count() == 40
    assert got(moved.filter("value < 20"), "partition", "offset") == sorted(((0, i) for i in range(20)), key=repr)
    there = moved.filter("value >= 20").groupBy("partition").agg(F.count("*").alias("n"), F.min("offset").alias("first"), F.max("offset").alias("last")).collect()
    assert len(there) > 1 and all(r["first"] == 20 and r["last"] == 20 + r["n"] - 1 for r in there)


# -- joins ------------------------------------------------------------------------------------------------


def test_outer_join_reads_each_side_once(spark):
    rng = random.Random(5)
    rows = [[(rng.choice(["a", "b", None]), rng.randint(1, 400), rng.choice([None, *range(1000)])) for _ in range(150)] for _ in range(2)]
    paths = [fresh_path(spark, "side") for _ in rows]
    for path, side in zip(paths, rows):
        records(spark, side).write.parquet(path)
    left, right = (Stream(spark.read.parquet(p)) for p in paths)
    joined = left.outer_join_stream(right, lambda l, r: F.struct(l.alias("l"), r.alias("r")), (4, "seconds")).df
    assert joined._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2
    usable = [[r for r in side if r[0] is not None and r[2] is not None] for side in rows]
    near = lambda a, b: a[0] == b[0] and abs(a[1] - b[1]) <= 4
    wanted = [(a[0], a[2], b[2]) for a in usable[0] for b in usable[1] if near(a, b)]
    wanted += [(a[0], a[2], None) for a in usable[0] if not any(near(a, b) for b in usable[1])]
    wanted += [(b[0], None, b[2]) for b in usable[1] if not any(near(a, b) for a in usable[0])]
    assert got(joined, "key", "value.l", "value.r") == sorted(wanted, key=repr)


def test_changelog_follows_the_order_of_its_tables(spark):
    """Times go back while offsets go on: the last change is the snapshot."""
    left = Table(records(spark, [("a", 50, 1), ("a", 10, 2), ("b", 5, 3)], topic="l"), order=["offset"])
    right = Table(records(spark, [("a", 60, 10), ("a", 20, 20), ("b", 9, None)], topic="r"), order=["offset"])
    joined = left.outer_join_tables(right, lambda l, r: F.struct(l.alias("l"), r.alias("r")))
    assert got(joined.snapshot(), "key", "value.l", "value.r") == [("a", 2, 20), ("b", 3, None)]
    assert got(joined.changelog(), "key", "topic", "offset", "value.l", "value.r") == [
        ("a", "l", 0, 1, None), ("a", "l", 1, 2, None), ("a", "r", 0, 2, 10), ("a", "r", 1, 2, 20), ("b", "l", 2, 3, None), ("b", "r", 2, 3, None)]


class CountedState:
    """State of one key that counts the calls made to it."""

    def __init__(self):
        self.calls, self.rows, self.map, self.row = 0, [], {}, None

    def _called(self):
        self.calls += 1

    def appendValue(self, row):
        self._called()
        self.rows.append(row)

    def put(self, rows):
        self._called()
        self.rows = list(rows)

    def clear(self):
        self._called()
        self.rows, self.row = [], None

    def get(self):
        self._called()
        return self.row if self.row is not None or not self.rows else iter(self.rows)

    def update(self, row):
        self._called()
        self.row = row

    def containsKey(self, k):
        self._called()
        return k in self.map

    def getValue(self, k):
        self._called()
        return self.map.get(k)

    def updateValue(self, k, v):
        self._called()
        self.map[k] = v

    def removeKey(self, k):
        self._called()
        del self.map[k]

    def iterator(self):
        self._called()
        return iter(self.map.items())

    def keys(self):
        self._called()
        return iter(self.map)


def test_a_processors_store_asks_state_once_for_all_records_of_a_call():
    from pyspark.sql import types as T

    state = CountedState()
    store = stateful._MapStore(state, T.StringType(), T.LongType())
    for i in range(1000):
        store.put("n", (store.get("n") or 0) + 1)
    store.put("gone", 1)
    assert store.remove("gone") == 1 and store.get("gone") is None and store.count() == 1
    assert list(store.range()) == [("n", 1000)]
    store.forget()
    assert state.map == {("n",): (1000,)} and state.calls < 20
    state.map[("n",)] = (7,)  # another key's state
    assert store.get("n") == 7
    store.put("n", 2.0)  # not as the state gives it back
    assert state.map[("n",)] == (2.0,)


def test_records_of_a_key_are_held_with_one_call_to_state(spark):
    from pyspark.sql import Row

    class Handle:
        def __init__(self):
            self.states, self.timers = {}, []

        def getListState(self, name, schema):
            return self.states.setdefault(name, CountedState())

        def getValueState(self, name, schema):
            state = self.states.setdefault(name, CountedState())
            state.get = lambda: state.row
            return state

        def registerTimer(self, ms):
            self.timers.append(ms)

    class Until:
        def __init__(self, ms):
            self.getCurrentWatermarkInMs = self.getExpiryTimeInMs = lambda: ms

    handle = Handle()
    ordered = stateful._Reorder(10)
    ordered.init(handle)
    rows = [Row(_ms=ms, _record={"at": {"t": ms}, "value": {"value": ms}}) for ms in (*range(999, -1, -2), *range(0, 1000, 2))]
    list(ordered.handleInputRows(("a",), iter(rows), None))
    first = list(ordered.handleExpiredTimer(("a",), Until(505), Until(505)))
    rest = list(ordered.handleExpiredTimer(("a",), Until(2000), Until(2000)))
    assert [r["_value"]["value"] for r in first] == list(range(500))
    assert [(r["_n"], r["_value"]["value"]) for r in first + rest] == [(ms + 1, ms) for ms in range(1000)]
    assert sum(s.calls for s in handle.states.values()) < 20

    handle = Handle()
    joined = stateful._AsOf()
    joined.init(handle)
    updates = [Row(_us=us, _side=0, _place="p", _record=None, _update={"value": us}) for us in range(0, 1_000_000, 10_000)]
    records = [Row(_us=us, _side=1, _place=None, _record={"value": us}, _update=None) for us in range(5_000, 1_000_000, 10_000)]
    list(joined.handleInputRows(("a",), iter(records[::2] + updates), None))
    list(joined.handleInputRows(("a",), iter(records[1::2]), None))
    first = list(joined.handleExpiredTimer(("a",), Until(500), Until(500)))
    found = first + list(joined.handleExpiredTimer(("a",), Until(2000), Until(2000)))
    assert len(first) == 50 and [(r["_record"]["value"], r["_seen"]["value"]) for r in found] == [(us, us - 5_000) for us in range(5_000, 1_000_000, 10_000)]
    assert sum(s.calls for s in handle.states.values()) < 30


def test_keys_of_a_task_are_processed_in_one_pass(spark):
    """No call per key; keys that span batches, are null, no number or a negative zero are grouped as Spark groups them."""
    from tideway.operators.processors import process_values

    class Before:
        value_type = "bigint"

        def init(self, ctx):
            return {"last": None}

        def on_record(self, ctx, state, record):
            before, state["last"] = state["last"], record["value"]
            return before

    rows = [(k, t, v) for v, (t, k) in enumerate((t, k) for t in range(20) for k in (0.0 if t % 2 else -0.0, math.nan, None, 7.5))]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        out = process_values(records(spark, rows, key="double"), Before)
        found = sorted((r["offset"], r["value"]) for r in out.collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == [(i, i - 4 if i >= 4 else None) for i in range(80)]
    assert "FlatMapGroupsInArrow" not in out._jdf.queryExecution().toString()


def test_keys_of_a_slot_share_the_calls_to_state_and_a_timer(spark):
    import pickle

    from pyspark.sql import types as T

    class Handle:
        def __init__(self):
            self.states, self.timers = {}, []

        def getListState(self, name, schema):
            state = self.states.setdefault(name, CountedState())
            state.get = lambda: iter(state.rows)
            return state

        def getValueState(self, name, schema):
            state = self.states.setdefault(name, CountedState())
            state.get = lambda: state.row
            return state

        def registerTimer(self, ms):
            self.timers.append(ms)

    class Now:
        def __init__(self, ms):
            self.getCurrentWatermarkInMs = self.getExpiryTimeInMs = lambda: ms

    class Ticking:
        key_type, value_type = "string", "bigint"
        stores = {"n": ("string", "bigint")}

        def init(self, ctx):
            ctx.schedule((10, "seconds"), "stream-time", lambda now: ctx.forward("tick", ctx.store("n").get("n")))

        def on_record(self, ctx, state, record):
            ctx.store("n").put("n", (ctx.store("n").get("n") or 0) + record["value"])

    fields = T.StructType.fromDDL("topic string, partition int, offset bigint, timestamp timestamp, key string, value bigint")
    out = stateful.output_schema(spark.createDataFrame([], fields), Ticking)
    made, handle = stateful._UserProcessor(Ticking, fields, out, False, "EventTime"), Handle()
    made.init(handle)
    packed = lambda rows: [{"_pack": pickle.dumps([list(c) for c in zip(*rows)])}]
    rows = [(f"k{i}", "", 1000 * (1000 + i), "t", 0, i, None, f"k{i}", i) for i in range(500)]
    assert list(made.handleInputRows((0,), packed(rows), Now(0))) == []
    assert handle.timers == [11_000] and sum(s.calls for s in handle.states.values()) < 10
    sent = [x for pack in made.handleExpiredTimer((0,), Now(11_100), Now(11_000)) for x in zip(*pickle.loads(pack["_out"]))]
    assert sorted(x[5] for x in sent) == list(range(100)) and handle.timers == [11_000, 11_100]
    assert list(made.handleInputRows((0,), packed([("k0", "", 11_050_000, "t", 0, 0, None, "k0", 7)]), Now(11_100))) == []
    sent = [x for pack in made.handleExpiredTimer((0,), Now(21_001), Now(21_000)) for x in zip(*pickle.loads(pack["_out"]))]
    assert sum(s.calls for s in handle.states.values()) < 40
    assert min(x[5] for x in sent) == 0  # the record that timers had passed was not taken


def test_records_without_time_and_nested_values_on_streams(spark):
    class Nested:
        key_type, value_type = "string", "struct<a:bigint,m:map<string,bigint>>"
        stores = {"seen": ("bigint", "struct<a:bigint>")}

        def on_record(self, ctx, state, record):
            store = ctx.store("seen")
            store.put(store.count(), {"a": record["value"]["a"]})
            ctx.forward(record["key"], (sum(v["a"] for _, v in store.range()), {"n": record["value"]["m"]["n"] + store.count()}))

    path = fresh_path(spark, "in")
    df = records(spark, [("a", None, 1), ("a", 1, 2), ("b", None, 4)]).withColumn("value", F.struct(F.col("value").alias("a"), F.create_map(F.lit("n"), F.col("value")).alias("m")))
    df.write.parquet(path)
    live = spark.readStream.schema(df.schema).parquet(path)
    for mode in ("None", "EventTime"):
        out = run.run_to_files(Stream(live).process(Nested, time_mode=mode).df, "update")
        assert sorted((r["key"], r["value"]["a"], r["value"]["m"]["n"]) for r in out.collect()) == [("a", 1, 2), ("a", 3, 4), ("b", 4, 5)]


def test_a_sink_runs_the_query_once_per_micro_batch(spark):
    seen = spark.sparkContext.accumulator(0)
    df, _, _ = file_stream(spark, [[("a", 1, 1), ("b", 2, 2)], [("c", 3, 3)]])
    topics = TopicDataset(spark, fresh_path(spark, "topics"), "string", "bigint", partitions=2)
    Stream(df).do_kv(lambda k, v: seen.add(1)).sink_topic(topics, "out", checkpoint=f"{topics.path}-c").awaitTermination()
    assert got(topics.read(), "key", "value") == [("a", 1), ("b", 2), ("c", 3)] and seen.value == 3


def test_a_step_of_several_files_is_one_micro_batch(spark, monkeypatch):
    from tideway.sources import adapters

    monkeypatch.setattr(adapters, "FILE_ROWS", 100)
    sf = "/root/testdata/sf0.001"
    out = run.run_to_files(adapters.events_in_batches(spark, sf, [F.col("ts"), F.col("event_id")]).df.select("key", "offset"))
    events = adapters.raw(spark, sf, "events")
    n = dict(out.groupBy("batch").count().collect())
    assert n.pop(3) == 1 and sorted(n) == [0, 1, 2] and sum(n.values()) == events.count() == out.select("offset").distinct().count() - 1
    assert min(n.values()) > 200
