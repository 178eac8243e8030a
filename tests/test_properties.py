"""Random small inputs against plain Python, with and without hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import at, got, records
from tideway.functions import folds
from tideway.functions import layout as L
from tideway.functions import scans as S
from tideway.operators.stream import Stream
from tideway.operators.table import Table


@pytest.fixture(params=["plain", "hot"])
def plan(request, spark):
    """Both plans: one window per key, and keys cut into chunks of about 20 records."""
    if request.param == "hot":
        spark.conf.set("spark.tideway.chunkRows", "20")
    yield request.param
    spark.conf.unset("spark.tideway.chunkRows")


def skewed(seed, n=300):
    """A third of the records belong to one key, some share their time."""
    r = random.Random(seed)
    rows = [("hot" if r.random() < 0.34 else f"k{r.randrange(12)}", r.randrange(200), r.randrange(1, 100)) for _ in range(n)]
    return sorted(rows, key=lambda row: row[1])


def test_hot_key_is_found_and_cut(spark, plan):
    df = records(spark, skewed(1)).withColumn("x", F.lit(1))
    layout = L.measure(df, ["key"], ["timestamp", "offset"])
    if plan == "plain":
        assert layout is None
        return
    assigned = layout.assign(df)
    sizes = {r["_chunk"]: r["count"] for r in assigned.filter("key = 'hot'").groupBy("_chunk").count().collect()}
    assert len(sizes) >= 4 and max(sizes.values()) <= 40
    # chunks follow the order
    bounds = assigned.filter("key = 'hot'").groupBy("_chunk").agg(
        F.min("offset").alias("a"), F.max("offset").alias("b")).orderBy("_chunk").collect()
    assert all(x["b"] < y["a"] for x, y in zip(bounds, bounds[1:]))
    assert assigned.count() == df.count()


def test_one_time_for_all_records_of_a_hot_key(spark, plan):
    df = records(spark, [("hot", 5, i) for i in range(100)])
    out = S.scan(df, ["key"], ["timestamp", "offset"], {"n": S.number(), "p": S.previous(F.col("value").alias("v"))})
    rows = sorted((r["offset"], r["n"], r["p"]["v"] if r["p"] else None) for r in out.collect())
    assert rows == [(i, i + 1, i - 1 if i else None) for i in range(100)]


def test_as_of_equals_loop(spark, plan):
    updates, lookups = skewed(2), skewed(3)
    updates = [(k, t, v if v > 20 else None) for k, t, v in updates]
    table = Table(records(spark, updates), order=["offset"])
    out = Stream(records(spark, lookups)).left_join_table(table, lambda s, t: F.struct(s.alias("s"), t.alias("t"))).df
    expected = []
    for i, (k, t, v) in enumerate(lookups):
        known = [(ut, j, uv) for j, (uk, ut, uv) in enumerate(updates) if uk == k and ut <= t]
        expected.append((i, v, max(known)[2] if known else None))
    assert got(out, "offset", "value.s", "value.t") == sorted(expected, key=repr)


@pytest.mark.parametrize("how", ["join_stream", "left_join_stream", "outer_join_stream"])
@pytest.mark.parametrize("emit", ["final", "eager"])
def test_interval_join_equals_loop(spark, how, emit):
    left, right = skewed(4, 120), skewed(5, 120)
    reach = 7
    l, r = Stream(records(spark, left)), Stream(records(spark, right))
    joined = getattr(l, how)(r, lambda a, b: F.struct(a.alias("a"), b.alias("b")), (reach, "seconds"), emit=emit)
    near = lambda x, y: x[0] == y[0] and abs(x[1] - y[1]) <= reach
    expected = [(x[0], x[2], y[2]) for x in left for y in right if near(x, y)]
    if how != "join_stream":
        early = lambda x, y: near(x, y) and (emit == "final" or y[1] < x[1])
        expected += [(x[0], x[2], None) for x in left if not any(early(x, y) for y in right)]
    if how == "outer_join_stream":
        early = lambda x, y: near(x, y) and (emit == "final" or x[1] <= y[1])
        expected += [(y[0], None, y[2]) for y in right if not any(early(x, y) for x in left)]
    assert got(joined.df, "key", "value.a", "value.b") == sorted(expected, key=repr)


def test_interval_join_is_symmetric(spark):
    l, r = Stream(records(spark, skewed(6, 80))), Stream(records(spark, skewed(7, 80)))
    ab = l.join_stream(r, lambda a, b: F.struct(a.alias("x"), b.alias("y")), "5 seconds").df
    ba = r.join_stream(l, lambda a, b: F.struct(b.alias("x"), a.alias("y")), "5 seconds").df
    assert got(ab, "key", "value.x", "value.y") == got(ba, "key", "value.x", "value.y")


def sessions_of(rows, gap):
    out = []
    for key in {k for k, _, _ in rows}:
        times = sorted((t, v) for k, t, v in rows if k == key)
        start = last = times[0][0]
        values = []
        for t, v in times:
            if t - last > gap:
                out.append((key, start * 1000, last * 1000, len(values), sum(values)))
                start, values = t, []
            last = t
            values.append(v)
        out.append((key, start * 1000, last * 1000, len(values), sum(values)))
    return sorted(out, key=repr)


def both():
    return folds.together(n=folds.count(), total=folds.total(lambda k, v: v))


def test_sessions_equal_loop(spark, plan):
    rows = skewed(8)
    df = Stream(records(spark, rows)).group_by_key().window_by_session((3, "seconds")).reduce_sessions(both()).df
    assert got(df, "key", "window_from", "window_to", "value.n", "value.total") == sessions_of(rows, 3)


def test_session_merge_law(spark):
    """fold(xs ++ ys) = merge(fold xs, fold ys) for the ordered fold of a session."""
    fold = folds.OrderedFold(
        seed=F.struct(F.lit(0).cast("bigint").alias("n"), F.lit("").alias("s")),
        step=lambda agg, k, v: F.struct((agg["n"] + 1).alias("n"), F.concat(agg["s"], v.cast("string")).alias("s")),
        merge=lambda a, b: F.struct((a["n"] + b["n"]).alias("n"), F.concat(a["s"], b["s"]).alias("s")), block=3)
    rows = skewed(9, 100)
    df = Stream(records(spark, rows)).group_by_key().window_by_session((4, "seconds")).reduce_sessions(fold).df
    expected = []
    for key, start, end, n, _ in sessions_of(rows, 4):
        text = "".join(str(v) for k, t, v in rows if k == key and start <= t * 1000 <= end)
        expected.append((key, start, end, n, text))
    assert got(df, "key", "window_from", "window_to", "value.n", "value.s") == sorted(expected, key=repr)


def test_sliding_equals_loop(spark, plan):
    rows = skewed(10)
    fold = folds.together(n=folds.count(), low=folds.minimum(lambda k, v: v), mean=folds.mean(lambda k, v: v))
    df = Stream(records(spark, rows)).group_by_key().window((6, "seconds"), "sliding").reduce_windows(fold).df
    expected = []
    for k, t in {(k, t) for k, t, _ in rows}:
        vs = [v for k2, t2, v in rows if k2 == k and t - 6 <= t2 <= t]
        expected.append((k, (t - 6) * 1000, t * 1000, len(vs), min(vs), sum(vs) / len(vs)))
    assert got(df, "key", "window_from", "window_to", "value.n", "value.low", "value.mean") == sorted(expected, key=repr)


def test_hopping_panes_equal_direct(spark):
    rows = skewed(11)
    grouped = Stream(records(spark, rows)).group_by_key()
    paned = grouped.window((40, "seconds"), "hopping", (4, "seconds")).reduce_windows(folds.total(lambda k, v: v)).df
    direct = grouped.window((40, "seconds"), "hopping", (4, "seconds")).reduce_windows(lambda k, v: F.sum(v)).df
    columns = ("key", "window_from", "window_to", "value")
    assert got(paned, *columns) == got(direct, *columns)
    expected = {}
    for k, t, v in rows:
        for start in range(t - t % 4, t - 40, -4):
            if start >= 0:
                expected[k, start * 1000, (start + 40) * 1000] = expected.get((k, start * 1000, (start + 40) * 1000), 0) + v
    assert got(paned, *columns) == sorted([(*w, v) for w, v in expected.items()], key=repr)


def test_python_fold_with_and_without_merge(spark, plan):
    rows = skewed(12)
    step = lambda agg, k, v: agg + f"{v},"
    expected = {}
    for k, t, v in rows:
        expected[k] = expected.get(k, "") + f"{v},"
    for merge in (None, lambda a, b: a + b):
        fold = folds.RowFold(lambda: "", step, "string", merge=merge)
        df = Stream(records(spark, rows)).group_by_key().reduce_values(fold).snapshot()
        assert got(df, "key", "value") == sorted(expected.items(), key=repr)


def test_tree_fold(spark, plan):
    rows = skewed(13)
    fold = folds.OrderedFold(F.lit(""), lambda agg, k, v: F.concat(agg, v.cast("string"), F.lit(",")),
                             lambda a, b: F.concat(a, b), block=4)
    expected = {}
    for k, t, v in rows:
        expected[k] = expected.get(k, "") + f"{v},"
    df = Stream(records(spark, rows)).group_by_key().reduce_values(fold).snapshot()
    assert got(df, "key", "value") == sorted(expected.items(), key=repr)


def test_signed_changes_add_up_to_the_snapshot(spark, plan):
    rows = [(k, t, v if v % 7 else None) for k, t, v in skewed(14)]
    table = Table(records(spark, rows), order=["offset"])
    grouped = table.map_and_group_by(lambda k, v: (v % 5, v)).reduce_values(both())
    last = grouped.changelog().groupBy("key").agg(F.max_by("value", F.struct("offset", "sign")).alias("value"))
    assert got(last, "key", "value.n", "value.total") == got(grouped.snapshot(), "key", "value.n", "value.total")


def test_outer_is_left_plus_right_only(spark):
    l = Table(records(spark, skewed(15, 30)), order=["offset"])
    r = Table(records(spark, skewed(16, 30)), order=["offset"])
    pair = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    outer = got(l.outer_join_tables(r, pair).snapshot(), "key", "value.a", "value.b")
    left = got(l.left_join_tables(r, pair).snapshot(), "key", "value.a", "value.b")
    known = {k for k, _, _ in left}
    right_only = [(k, None, v) for k, v in got(r.snapshot(), "key", "value") if k not in known]
    assert outer == sorted(left + right_only, key=repr)


def test_table_join_changelog_ends_in_the_snapshot(spark, plan):
    l = Table(records(spark, [(k, t, v if v > 10 else None) for k, t, v in skewed(17, 150)], topic="l"), order=["offset"])
    r = Table(records(spark, [(k, t, v if v > 10 else None) for k, t, v in skewed(18, 150)], topic="r"), order=["offset"])
    for how in ("join_tables", "left_join_tables", "outer_join_tables"):
        joined = getattr(l, how)(r, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        changes = joined.changelog().withColumn("_at", F.struct("timestamp", "topic", "offset"))
        last = changes.groupBy("key").agg(F.max_by(F.struct("value"), "_at").alias("v")).select("key", "v.value")
        last = last.filter("value IS NOT NULL")
        assert got(last, "key", "value.a", "value.b") == got(joined.snapshot(), "key", "value.a", "value.b")


def test_branches_partition_the_input(spark):
    stream = Stream(records(spark, skewed(19, 60)))
    parts = stream.branch([lambda k, v: v > 70, lambda k, v: v > 30, lambda k, v: v % 2 == 0])
    offsets = [got(p.df, "offset") for p in parts]
    assert sum(map(len, offsets)) == len({o for part in offsets for o in part})
    matched = stream.filter_kv(lambda k, v: (v > 30) | (v % 2 == 0))
    assert sorted((o for part in offsets for o in part), key=repr) == got(matched.df, "offset")


def test_null_keys_and_values(spark):
    df = records(spark, [(None, 0, 1), ("a", 0, None), ("a", 1, 2)])
    stream = Stream(df)
    assert got(stream.group_by_key().reduce_values(folds.count()).snapshot(), "key", "value") == [("a", 1)]
    assert stream.group_by(lambda k, v: F.lit(None).cast("string")).df.count() == 0
    table = Table(df, order=["offset"])
    assert got(table.map_and_group_by(lambda k, v: (F.when(v > 5, k), v)).reduce_values(folds.count()).snapshot(), "key") == []
    assert stream.filter_kv(lambda k, v: v > 0).df.count() == 2


def test_late_records(spark, plan):
    # clock after each record: 100, 100, 100, 100; with retention 10 what is older than 90 is late
    rows = [("a", 100, 1), ("a", 90, 2), ("a", 89, 4), ("b", 95, 8)] + [("c", 100, 0)] * 40
    grouped = Stream(records(spark, rows)).group_by_key()
    kept = grouped.window((5, "seconds"), retention=(10, "seconds"), apply_retention=True)
    total = kept.reduce_windows(folds.total(lambda k, v: v)).df
    assert got(total.filter("key <> 'c'"), "window_from", "value") == [(100000, 1), (90000, 2), (95000, 8)]
    everything = grouped.window((5, "seconds")).reduce_windows(folds.total(lambda k, v: v)).df
    assert everything.agg(F.sum("value")).first()[0] == 15
