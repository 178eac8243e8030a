"""Worked examples: small inputs with answers known by hand."""

import pytest
from pyspark.sql import functions as F

from helpers import at, got, records
from tideway.functions import codec, folds
from tideway.operators.stream import Stream
from tideway.operators.table import Table
from tideway.sources import positions as P
from tideway.sources.topics import TopicDataset
from tideway.session import fresh_path


def numbers(spark):
    return records(spark, [(i, 0, i) for i in range(25)], key="bigint")


def odd_even():
    class OddEven:  # local, so that it travels to the workers by value
        key_type, value_type = "string", "bigint"
        stores = {"sums": ("string", "bigint")}

        def on_record(self, ctx, state, record):
            category = "even" if record["key"] % 2 == 0 else "odd"
            store = ctx.store("sums")
            store.put(category, (store.get(category) or 0) + record["value"])
            ctx.forward(category, store.get(category))

    return OddEven


def parity(k, v):
    return F.when(k % 2 == 0, "even").otherwise("odd")


def test_running_sum_processor(spark):
    df = Stream(numbers(spark)).process(odd_even(), by=parity).df
    rows = {(r["offset"], r["key"], r["value"]) for r in df.collect()}
    expected = {(i, "even", (i // 2) * (i // 2 + 1)) if i % 2 == 0 else (i, "odd", (i // 2 + 1) ** 2) for i in range(25)}
    assert rows == expected


def test_tumbling_sum_of_categories(spark):
    df = Stream(numbers(spark)).group_by(parity).window("2 seconds").reduce_windows(folds.total(lambda k, v: v)).df
    assert got(df, "key", "window_from", "window_to", "value") == [("even", 0, 2000, 156), ("odd", 0, 2000, 144)]


@pytest.mark.parametrize("times, expected", [
    ([10, 12, 20], [(10000, 12000, 2), (20000, 20000, 1)]),
    ([10, 12, 20, 16], [(10000, 20000, 4)]),
    ([0, 5], [(0, 5000, 2)]),
    ([0, 6], [(0, 0, 1), (6000, 6000, 1)]),
])
def test_sessions(spark, times, expected):
    stream = Stream(records(spark, [("a", t, 1) for t in times]))
    df = stream.group_by_key().window_by_session((5, "seconds")).reduce_sessions(folds.count()).df
    assert got(df, "window_from", "window_to", "value") == expected


@pytest.mark.parametrize("t, kind, advance, expected", [
    (7, "hopping", 3, [(3000, 8000), (6000, 11000)]),
    (0, "hopping", 3, [(0, 5000)]),
    (5, "tumbling", None, [(5000, 10000)]),
])
def test_windows_of_a_record(spark, t, kind, advance, expected):
    grouped = Stream(records(spark, [("a", t, 1)])).group_by_key()
    window = grouped.window("5 seconds", kind, (advance, "seconds") if advance else None)
    assert got(window.reduce_windows(folds.count()).df, "window_from", "window_to") == expected


def test_window_arguments(spark):
    grouped = Stream(records(spark, [("a", 0, 1)])).group_by_key()
    with pytest.raises(ValueError):
        grouped.window("5 seconds", "hopping", "6 seconds")
    with pytest.raises(ValueError):
        grouped.window("5 seconds", "rolling")


def test_sliding(spark):
    grouped = Stream(records(spark, [("a", t, 1) for t in (0, 5, 6)])).group_by_key()
    df = grouped.window("5 seconds", "sliding").reduce_windows(folds.total(lambda k, v: v)).df
    assert got(df, "window_to", "value") == [(0, 1), (5000, 2), (6000, 2)]


def test_branch(spark):
    stream = Stream(records(spark, [("a", 0, "red"), ("b", 0, "black"), ("c", 0, "blue")], value="string"))
    red, black = (lambda k, v: v == "red"), (lambda k, v: v == "black")
    assert [s.df.count() for s in stream.branch([red, black, lambda k, v: F.lit(True)])] == [1, 1, 1]
    assert [s.df.count() for s in stream.branch([red, black])] == [1, 1]
    assert [s.df.count() for s in stream.branch([lambda k, v: F.lit(None).cast("boolean"), red])] == [0, 1]


def test_regroup_keeps_groups_everybody_left(spark):
    rows = [("u1", 1, {"c": "BE", "i": 10}), ("u2", 2, {"c": "BE", "i": 20}), ("u1", 3, {"c": "FR", "i": 15}), ("u2", 4, None)]
    table = Table(records(spark, rows, value="struct<c:string,i:bigint>"), order=["offset"])
    grouped = table.map_and_group_by(lambda k, v: (v["c"], v["i"]))
    fold = folds.total(lambda k, v: v)
    assert got(grouped.reduce_values(fold).snapshot(), "key", "value") == [("BE", 0), ("FR", 15)]
    changes = grouped.reduce_values(fold).changelog()
    last = changes.groupBy("key").agg(F.max_by("value", F.struct("offset", "sign")).alias("value"))
    assert got(last, "key", "value") == [("BE", 0), ("FR", 15)]
    rows = grouped.reduce_rows(lambda a, k, v: a + v, lambda a, k, v: a - v, lambda: 0, "bigint")
    assert got(rows.snapshot(), "key", "value") == [("BE", 0), ("FR", 15)]


LEFT, RIGHT = [("a", 1, 1), ("b", 2, 2)], [("a", 3, 10), ("c", 3, 30)]


@pytest.mark.parametrize("how, emit, expected", [
    ("join_stream", "final", [("a", 1, 10)]),
    ("left_join_stream", "final", [("a", 1, 10), ("b", 2, None)]),
    ("outer_join_stream", "final", [("a", 1, 10), ("b", 2, None), ("c", None, 30)]),
    ("left_join_stream", "eager", [("a", 1, 10), ("a", 1, None), ("b", 2, None)]),
])
def test_stream_joins(spark, how, emit, expected):
    l, r = Stream(records(spark, LEFT)), Stream(records(spark, RIGHT))
    joined = getattr(l, how)(r, lambda a, b: F.struct(a.alias("l"), b.alias("r")), "2 seconds", emit=emit)
    assert got(joined.df, "key", "value.l", "value.r") == expected


def test_stream_joins_ignore_nulls(spark):
    l = Stream(records(spark, [(None, 1, 1), ("a", 1, None)]))
    r = Stream(records(spark, [(None, 1, 1), ("a", 1, 5)]))
    assert l.left_join_stream(r, lambda a, b: a, "2 seconds").df.count() == 0


def asof_input(spark):
    table = records(spark, [("a", 5, "t1"), ("a", 10, None), ("a", 20, "t3")], value="string")
    stream = records(spark, [("a", 5, "s1"), ("a", 15, "s2"), ("a", 25, "s3"), ("b", 1, "s4")], value="string")
    return Stream(stream), Table(table, order=["offset"])


def test_as_of(spark):
    stream, table = asof_input(spark)
    pair = lambda s, t: F.struct(s.alias("s"), t.alias("t"))
    assert got(stream.join_table(table, pair).df, "value.s", "value.t") == [("s1", "t1"), ("s3", "t3")]
    assert got(stream.left_join_table(table, pair).df, "value.s", "value.t") == [
        ("s1", "t1"), ("s2", None), ("s3", "t3"), ("s4", None)]


def test_global_table(spark):
    users = Stream(records(spark, [("u1", 0, "BE"), ("u2", 0, "FR"), ("u3", 0, "XX")], value="string"))
    songs = Table(records(spark, [("BE", 0, ["x", "y"]), ("FR", 0, ["z"])], value="array<string>"), order=["offset"])
    joined = users.join_global_table(songs, lambda k, v: v, lambda v, top: F.get(top, F.lit(0)))
    assert got(joined.df, "key", "value") == [("u1", "x"), ("u2", "z")]


def test_table_joins(spark):
    l = Table(records(spark, [("a", 0, 1), ("b", 0, 2), ("c", 0, None)]), order=["offset"])
    r = Table(records(spark, [("b", 0, 20), ("d", 0, 40)]), order=["offset"])
    pair = lambda a, b: F.struct(a.alias("l"), b.alias("r"))
    show = lambda t: got(t.snapshot(), "key", "value.l", "value.r")
    assert show(l.join_tables(r, pair)) == [("b", 2, 20)]
    assert show(l.left_join_tables(r, pair)) == [("a", 1, None), ("b", 2, 20)]
    assert show(l.outer_join_tables(r, pair)) == [("a", 1, None), ("b", 2, 20), ("d", None, 40)]


def test_flat_maps(spark):
    stream = Stream(records(spark, [("k", 0, ["x", "x", "y"]), ("n", 0, None), ("e", 0, [])], value="array<string>"))
    counted = stream.fmap_kv(lambda k, v: F.transform(
        F.array_distinct(v), lambda t: F.struct(t, F.size(F.filter(v, lambda u: u == t)).cast("bigint").alias("n"))))
    assert got(counted.df, "key", "value") == [("x", 2), ("y", 1)]
    as_map = stream.fmap_kv(lambda k, v: F.when(F.size(v) > 0, F.create_map(F.lit("first"), F.get(v, F.lit(0)))))
    assert got(as_map.df, "key", "value") == [("first", "x")]
    nulls = Stream(records(spark, [("k", 0, ["x", None, "y"]), ("e", 0, [])], value="array<string>"))
    assert got(nulls.fmap_values(lambda k, v: F.array_compact(v)).df, "key", "value") == [("k", "x"), ("k", "y")]


def test_table_filter(spark):
    table = Table(records(spark, [("a", 0, 17), ("b", 0, 18), ("c", 0, None), ("d", 0, 30), ("d", 1, 3)]), order=["offset"])
    assert got(table.filter_kv(lambda k, v: v >= 18).snapshot(), "key", "value") == [("b", 18)]


def test_offsets(spark):
    df = records(spark, [("k", i / 10, i) for i in range(10)])
    assert got(P.beginning_offsets(df), "offset") == [(0,)]
    assert got(P.end_offsets(df), "offset") == [(10,)]
    asked = spark.createDataFrame([("t", 0, at(0.25)), ("t", 0, at(9.999))], "topic string, partition int, timestamp timestamp")
    found = P.offsets_for_timestamps(df, asked)
    assert got(found, "offset", F.unix_millis("timestamp")) == [(3, 300), (None, None)]


def test_codec(spark):
    df = spark.createDataFrame(
        [(False, -1, -1, "a/b", 1.5), (True, 2**63 - 1, 2**31 - 1, "é", float("-inf")), (None, None, None, None, None)],
        "b boolean, l bigint, i int, s string, d double")
    formats = {"b": "boolean", "l": "long", "i": "integer", "s": "keyword", "d": "double"}
    out = df.select(*[codec.decoded(codec.encoded(F.col(c), f), f).alias(c) for c, f in formats.items()])
    assert out.schema == df.schema
    assert got(out, *df.columns) == got(df, *df.columns)
    with pytest.raises(ValueError):
        codec.decoded(F.col("b"), "float")


def test_produce_commit_read_again(spark):
    topics = TopicDataset(spark, fresh_path(spark, "topics"), "bigint", "bigint")
    rows = records(spark, [(i, 0, 100 * i) for i in range(25)], key="bigint", topic="my-topic")
    sent = topics.produce(rows)
    assert sorted(r[0] for r in got(sent, "offset")) == list(range(25))
    assert topics.committed_offset("g", "my-topic", 0) is None
    topics.commit_offsets("g", topics.read("my-topic"))
    assert topics.committed_offset("g", "my-topic", 0) == 25
    assert topics.read_uncommitted_by("g").count() == 0
    again = {r["key"]: (r["offset"], r["value"]) for r in topics.read().collect()}
    assert again == {i: (i, 100 * i) for i in range(25)}
