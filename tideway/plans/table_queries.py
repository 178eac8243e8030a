"""Queries over tables: latest values, joins, retraction, stores, processors."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tideway.functions import folds
from tideway.operators import stores, upkeep
from tideway.operators.processors import process_values
from tideway.operators.stores import Store
from tideway.plans.registry import query
from tideway.plans.stream_queries import (
    CENTS, SESSION_SQL, TUMBLING_SQL, q_session_reduce, q_window_tumbling_sum, value_cents,
)
from tideway.sources.adapters import cents, customer_table, events, orders

ORDER_CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"
LATEST = f"""
latest AS (SELECT o_custkey AS key, o_orderkey, o_orderstatus AS status, {ORDER_CENTS} AS cents, o_orderdate FROM orders
           QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
"""


def order_cents(k, v):
    return cents(v["o_totalprice"])


def slim_orders(spark, sf):
    """Values narrowed before the latest one is looked for, so that no other column is read or shuffled."""
    return orders(spark, sf).map_values(lambda k, v: F.struct(
        v["o_orderkey"].alias("o_orderkey"), v["o_orderstatus"].alias("status"), order_cents(k, v).alias("cents")))


@query(f"WITH {LATEST} SELECT key, o_orderkey, status, cents FROM latest")
def q_table_latest(spark, sf):
    return slim_orders(spark, sf).snapshot().select("key", "value.*")


@query(f"WITH {LATEST} SELECT key, o_orderkey, status, cents FROM latest WHERE status = 'F'")
def q_table_filter(spark, sf):
    """Filtered after the latest value is known: an update that stops matching removes the key."""
    filtered = slim_orders(spark, sf).filter_kv(lambda k, v: v["status"] == "F")
    return filtered.snapshot().select("key", "value.*")


@query(f"WITH {LATEST} SELECT key, cents AS value FROM latest")
def q_table_map_values(spark, sf):
    return orders(spark, sf).map_values(order_cents).snapshot().select("key", "value")


@query(f"""
SELECT o_orderstatus AS key, o_orderkey AS "offset", CASE WHEN o_totalprice >= 100000 THEN {ORDER_CENTS} END AS value FROM orders
""")
def q_to_stream(spark, sf):
    """The updates of a filtered table, deletes included, under a new key."""
    table = orders(spark, sf)
    status = F.col("status")
    df = table.changelog().withColumn("status", F.col("value.o_orderstatus"))
    kept = type(table)(df, order=table.order).filter_kv(lambda k, v: v["o_totalprice"] >= 100000).map_values(order_cents)
    return kept.to_stream(lambda k, v: status).df.select("key", "offset", "value")


def balance_and_order(c, o):
    return F.struct(c["c_name"].alias("c_name"), o["o_orderkey"].alias("o_orderkey"))


def rich(spark, sf):
    return customer_table(spark, sf).filter_kv(lambda k, v: v["c_acctbal"] > 0)


def tables_sql(kind: str) -> str:
    return f"""
WITH {LATEST} SELECT coalesce(c.c_custkey, latest.key) AS key, c_name, o_orderkey
FROM (SELECT * FROM customer WHERE c_acctbal > 0) c {kind} JOIN latest ON c.c_custkey = latest.key
"""


@query(tables_sql("INNER"))
def q_join_tables(spark, sf):
    return rich(spark, sf).join_tables(orders(spark, sf), balance_and_order).snapshot().select("key", "value.*")


@query(tables_sql("LEFT"))
def q_left_join_tables(spark, sf):
    return rich(spark, sf).left_join_tables(orders(spark, sf), balance_and_order).snapshot().select("key", "value.*")


@query(tables_sql("FULL"))
def q_outer_join_tables(spark, sf):
    return rich(spark, sf).outer_join_tables(orders(spark, sf), balance_and_order).snapshot().select("key", "value.*")


def last_of(spark, sf, event_type: str):
    from tideway.operators.table import Table

    s = events(spark, sf).filter_kv(lambda k, v: v["event_type"] == event_type)
    return Table(s.map_values(lambda k, v: F.when(v["value"] >= 10, cents(v["value"]))).df)


def changes_sql(present: str) -> str:
    """Last click and last purchase per user after each of their updates; values below 10 are deletes."""
    return f"""
SELECT key, "offset", CASE WHEN {present} THEN coalesce(l, 0) - coalesce(r, 0) END AS value FROM (
  SELECT user_id AS key, event_id AS "offset", event_type,
         CASE WHEN last_value(CASE WHEN event_type = 'click' THEN value END IGNORE NULLS) OVER w >= 10
              THEN last_value(CASE WHEN event_type = 'click' THEN {CENTS} END IGNORE NULLS) OVER w END AS l,
         CASE WHEN last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER w >= 10
              THEN last_value(CASE WHEN event_type = 'purchase' THEN {CENTS} END IGNORE NULLS) OVER w END AS r
  FROM events WHERE event_type IN ('click', 'purchase')
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
"""


def difference(l, r):
    return F.coalesce(l, F.lit(0)) - F.coalesce(r, F.lit(0))


@query(changes_sql("l IS NOT NULL AND r IS NOT NULL"))
def q_join_tables_changelog(spark, sf):
    """What the joined table says after every update of either side, deletes included."""
    joined = last_of(spark, sf, "click").join_tables(last_of(spark, sf, "purchase"), difference)
    return joined.changelog().select("key", "offset", "value")


@query(changes_sql("l IS NOT NULL OR r IS NOT NULL"))
def q_outer_join_tables_changelog(spark, sf):
    joined = last_of(spark, sf, "click").outer_join_tables(last_of(spark, sf, "purchase"), difference)
    return joined.changelog().select("key", "offset", "value")


@query(changes_sql("l IS NOT NULL"))
def q_left_join_tables_changelog(spark, sf):
    joined = last_of(spark, sf, "click").left_join_tables(last_of(spark, sf, "purchase"), difference)
    return joined.changelog().select("key", "offset", "value")


REGROUP_SQL = f"""
WITH {LATEST} SELECT o_orderstatus AS key, coalesce(n, 0) AS n, coalesce(total, 0) AS total
FROM (SELECT DISTINCT o_orderstatus FROM orders) LEFT JOIN
     (SELECT status, CAST(count(*) AS BIGINT) AS n, CAST(sum(cents) AS BIGINT) AS total FROM latest GROUP BY status)
     ON status = o_orderstatus
"""


def by_status(k, v):
    return v["o_orderstatus"], order_cents(k, v)


def status_fold():
    return folds.together(n=folds.count(), total=folds.total(lambda k, v: v))


@query(REGROUP_SQL)
def q_table_regroup(spark, sf):
    """Latest order per customer, grouped by status; groups everybody left stay with 0."""
    return orders(spark, sf).map_and_group_by(by_status).reduce_values(status_fold()).snapshot().select("key", "value.*")


@query(f"""
SELECT status AS key, o_orderkey AS "offset", sign, CAST(sum(sign) OVER w AS BIGINT) AS n,
       CAST(sum(sign * cents) OVER w AS BIGINT) AS total FROM (
  SELECT o_orderkey, o_orderdate, 1 AS sign, o_orderstatus AS status, {ORDER_CENTS} AS cents FROM orders
  UNION ALL
  SELECT o_orderkey, o_orderdate, -1, lag(o_orderstatus) OVER c, lag({ORDER_CENTS}) OVER c FROM orders
  WINDOW c AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
WHERE status IS NOT NULL
WINDOW w AS (PARTITION BY status ORDER BY o_orderdate, o_orderkey, sign ROWS UNBOUNDED PRECEDING)
""")
def q_changelog_regroup(spark, sf):
    """The same aggregate after every change: the old value leaves its group, then the new one joins."""
    changes = orders(spark, sf).map_and_group_by(by_status).reduce_values(status_fold()).changelog()
    return changes.select("key", "offset", "sign", "value.n", "value.total")


@query(REGROUP_SQL)
def q_table_regroup_rows(spark, sf):
    """The same with Python add and sub functions."""
    table = orders(spark, sf).map_and_group_by(by_status).reduce_rows(
        lambda agg, k, v: {"n": agg["n"] + 1, "total": agg["total"] + v},
        lambda agg, k, v: {"n": agg["n"] - 1, "total": agg["total"] - v},
        lambda: {"n": 0, "total": 0}, "struct<n:bigint,total:bigint>")
    return table.snapshot().select("key", "value.*")


@query(REGROUP_SQL)
def q_table_regroup_merge(spark, sf):
    """The same in pieces of each group, which are merged: three groups keep all tasks busy."""
    table = orders(spark, sf).map_and_group_by(by_status).reduce_values(
        lambda agg, k, v: {"n": agg["n"] + 1, "total": agg["total"] + v},
        lambda agg, k, v: {"n": agg["n"] - 1, "total": agg["total"] - v},
        lambda: {"n": 0, "total": 0}, "struct<n:bigint,total:bigint>",
        merge=lambda a, b: {"n": a["n"] + b["n"], "total": a["total"] + b["total"]})
    return table.snapshot().select("key", "value.*")


@query(f"""
WITH l AS (SELECT o_custkey AS key, o_orderkey, {ORDER_CENTS} AS cents FROM orders
           QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)
SELECT c_custkey AS key, CASE WHEN l.key IS NOT NULL OR c_acctbal > 0 THEN CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END + coalesce(cents, 0) END AS value
FROM customer LEFT JOIN l ON l.key = c_custkey WHERE l.key IS NOT NULL OR c_acctbal > 0
""")
def q_outer_join_changelog_last(spark, sf):
    """Orders arrive by key, out of time: what the changelog of the joined table says last is its snapshot."""
    from tideway.operators.table import Table

    left = rich(spark, sf).map_values(lambda k, v: F.lit(1).cast("bigint"))
    right = Table(orders(spark, sf).map_values(order_cents).changelog(), order=["offset"])
    changes = Table(left.changelog().withColumn("timestamp", F.lit("1970-01-01").cast("timestamp")), order=["offset"]).outer_join_tables(
        right, lambda l, r: F.coalesce(l, F.lit(0)) + F.coalesce(r, F.lit(0))).changelog()
    place = F.struct(F.col("topic") == "orders", "offset")
    last = changes.groupBy("key").agg(F.max_by(F.struct("value"), place).alias("last"))
    return last.select("key", F.col("last.value").alias("value")).filter("value IS NOT NULL")


@query("""
SELECT user_id AS key, max(event_id) AS "offset" FROM events GROUP BY 1 ORDER BY 2 DESC LIMIT 50
""")
def q_keep_recent(spark, sf):
    from tideway.operators.table import Table

    table = Table(events(spark, sf).map_values(lambda k, v: F.struct(F.col("offset").alias("offset"))).df, order=["offset"])
    return table.keep_recent(50).select("key", "value.offset")


# -- stores -------------------------------------------------------------------------------------------


def stored(df, label: str) -> Store:
    return Store.write(f"{label}-{uuid.uuid4().hex}", df)


@query("SELECT user_id AS key, CAST(count(*) AS BIGINT) AS value FROM events WHERE user_id BETWEEN 10 AND 30 GROUP BY 1")
def q_kv_range(spark, sf):
    table = events(spark, sf).group_by_key().reduce_values(folds.count())
    return stored(table.snapshot(), "kv").kv_range(10, 30)


@query("SELECT user_id AS key, CAST(count(*) AS BIGINT) AS value FROM events WHERE user_id = 42 GROUP BY 1")
def q_kv_get(spark, sf):
    table = events(spark, sf).group_by_key().reduce_values(folds.count())
    return stored(table.snapshot(), "kv").kv_get(42)


@query("""
SELECT user_id AS key, CASE WHEN user_id % 5 = 1 THEN CAST(-1 AS BIGINT) ELSE CAST(count(*) AS BIGINT) END AS value
FROM events WHERE user_id % 5 <> 0 GROUP BY 1
UNION ALL SELECT DISTINCT -user_id - 1, CAST(-2 AS BIGINT) FROM events
""")
def q_kv_put_offer_remove(spark, sf):
    """Puts replace, offers only add, removes delete; nothing is lost in between."""
    store = stored(events(spark, sf).group_by_key().reduce_values(folds.count()).snapshot(), "kv")
    keys = store.snapshot().select("key")
    one = F.lit(-1).cast("bigint").alias("value")
    store.kv_put(keys.filter("key % 5 = 1").select("key", one))
    store.kv_remove(keys.filter("key % 5 = 0"))
    both = keys.unionByName(keys.select((-F.col("key") - 1).alias("key")))
    present = both.filter("key < 0 OR key % 5 <> 0")
    store.kv_offer(present.select("key", F.lit(-2).cast("bigint").alias("value")))
    return store.snapshot()


@query("""
SELECT user_id AS key, CAST(count(*) AS BIGINT) AS value FROM events WHERE event_type = 'error' GROUP BY 1
UNION ALL SELECT DISTINCT -user_id - 1, CAST(-1 AS BIGINT) FROM events WHERE event_type = 'error'
""")
def q_store_replace(spark, sf):
    """What was written and put before a second write is gone; what is put after it counts."""
    count = lambda s: s.group_by_key().reduce_values(folds.count()).snapshot()
    store = stored(count(events(spark, sf)), "kv")
    store.kv_put(store.snapshot().select("key", F.lit(-5).cast("bigint").alias("value")))
    store = Store.write(store.name, count(events(spark, sf).filter_kv(lambda k, v: v["event_type"] == "error")))
    store.kv_put(store.snapshot().select((-F.col("key") - 1).alias("key"), F.lit(-1).cast("bigint").alias("value")))
    return store.snapshot()


@query("""
SELECT 'count' AS name, CAST(count(DISTINCT user_id) AS BIGINT) AS value FROM events
UNION ALL SELECT 'largest', max(n) FROM (SELECT CAST(count(*) AS BIGINT) AS n FROM events GROUP BY user_id)
""")
def q_query_store(spark, sf):
    """A store found by its name: how many keys it has, and its largest value."""
    made = stored(events(spark, sf).group_by_key().reduce_values(folds.count()).snapshot(), "kv")
    store = stores.query_store(spark, made.name, made.schema)
    count = spark.range(1).select(F.lit("count").alias("name"), F.lit(store.kv_count()).cast("bigint").alias("value"))
    return count.unionByName(store.snapshot().agg(F.max("value").alias("value")).select(F.lit("largest").alias("name"), "value"))


@query(f"""
SELECT o_custkey % 10 AS key, (epoch_us(o_orderdate) // 1000) AS window_from, (epoch_us(o_orderdate) // 1000) + 86400000 AS window_to,
       max({ORDER_CENTS}) AS value FROM orders WHERE o_custkey % 10 <> 3 GROUP BY 1, 2, 3
UNION ALL SELECT DISTINCT o_custkey % 10, CAST(5000 AS BIGINT), CAST(86405000 AS BIGINT), CAST(-1 AS BIGINT) FROM orders
""")
def q_ws_put(spark, sf):
    """Puts into a window store: with windows of their own, at a given time, and deletes."""
    s = orders(spark, sf).map_values(order_cents).to_stream(lambda k, v: k % 10)
    rows = s.df.groupBy("key", F.unix_millis("timestamp").alias("window_from")).agg(F.max("value").alias("value"))
    store = stored(rows.limit(0).select("key", "window_from", F.col("window_from").alias("window_to"), "value"), "ws")
    store.ws_put(rows, length_ms=86_400_000)
    store.ws_put(rows.filter("key = 3").withColumn("value", F.lit(None).cast("bigint")), length_ms=86_400_000)
    store.ws_put(rows.select("key", F.lit(-1).cast("bigint").alias("value")).distinct(), at_ms=5000, length_ms=86_400_000)
    return store.snapshot()


@query(f"SELECT *, window_from AS timestamp FROM ({TUMBLING_SQL}) WHERE key = 8 AND window_from BETWEEN 1704240000000 AND 1705276800000")
def q_ws_multi_get(spark, sf):
    store = stored(q_window_tumbling_sum(spark, sf), "ws")
    return store.ws_multi_get(8, 1704240000000, 1705276800000)


@query(f"""SELECT *, window_from AS timestamp FROM ({TUMBLING_SQL})
WHERE key BETWEEN 10 AND 60 AND window_from BETWEEN 1704240000000 AND 1705276800000""")
def q_ws_multi_range(spark, sf):
    store = stored(q_window_tumbling_sum(spark, sf), "ws")
    return store.ws_multi_range(10, 60, 1704240000000, 1705276800000)


@query(f"SELECT * FROM ({TUMBLING_SQL}) WHERE key = 8 AND window_from = 1704067200000")
def q_ws_get(spark, sf):
    return stored(q_window_tumbling_sum(spark, sf), "ws").ws_get(8, 1704067200000)


SESSION_RANGE = "window_to >= 1704240000000 AND window_from <= 1705276800000"


@query(f"SELECT * FROM ({SESSION_SQL}) WHERE key = 8 AND {SESSION_RANGE}")
def q_ss_multi_get(spark, sf):
    df = q_session_reduce(spark, sf).select("key", "window_from", "window_to", F.struct("n", "total").alias("value"))
    out = stored(df, "ss").ss_multi_get(8, 1704240000000, 1705276800000)
    return out.select("key", "window_from", "window_to", "value.*")


@query(f"SELECT * FROM ({SESSION_SQL}) WHERE key BETWEEN 10 AND 60 AND {SESSION_RANGE}")
def q_ss_multi_range(spark, sf):
    df = q_session_reduce(spark, sf).select("key", "window_from", "window_to", F.struct("n", "total").alias("value"))
    out = stored(df, "ss").ss_multi_range(10, 60, 1704240000000, 1705276800000)
    return out.select("key", "window_from", "window_to", "value.*")


@query(f"""
SELECT o_custkey % 10 AS key, (epoch_us(o_orderdate) // 1000) AS timestamp, {ORDER_CENTS} AS value, o_orderkey AS "offset" FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey % 10, o_orderdate ORDER BY o_orderkey DESC) = 1
""")
def q_ws_put_last_wins(spark, sf):
    """One value per (key, time): the last arrived."""
    s = orders(spark, sf).map_values(order_cents).to_stream(lambda k, v: k % 10)
    return stores.put_values(s.df).select("key", "timestamp", "value", "offset")


@query(f"""
SELECT o_custkey % 10 AS key, (epoch_us(o_orderdate) // 1000) AS timestamp, {ORDER_CENTS} AS value, o_orderkey AS "offset" FROM orders
""")
def q_ws_put_duplicates(spark, sf):
    """All values of a (key, time)."""
    s = orders(spark, sf).map_values(order_cents).to_stream(lambda k, v: k % 10)
    return stores.put_values(s.df, duplicate_keys=True).select("key", "timestamp", "value", "offset")


# -- processors ---------------------------------------------------------------------------------------


class RunningSum:
    """Forwards the running sum of a user, kept in a store."""

    key_type, value_type = "bigint", "bigint"
    stores = {"sums": ("string", "bigint")}

    def on_record(self, ctx, state, record):
        store = ctx.store("sums")
        total = (store.get("total") or 0) + record["value"]
        store.put("total", total)
        ctx.forward(record["key"], total)


class Previous:
    """Replaces each value by the one before it."""

    key_type, value_type = "bigint", "bigint"
    stores = {"last": ("string", "bigint")}

    def on_record(self, ctx, state, record):
        before = ctx.store("last").get("value")
        ctx.store("last").put("value", record["value"])
        return before


RUNNING_SQL = f"""
SELECT user_id AS key, event_id AS "offset", CAST(sum({CENTS}) OVER (PARTITION BY user_id ORDER BY ts, event_id
       ROWS UNBOUNDED PRECEDING) AS BIGINT) AS value FROM events
"""


@query(RUNNING_SQL)
def q_process_running_sum(spark, sf):
    out = events(spark, sf).map_values(value_cents).process(RunningSum)
    return out.df.select("key", "offset", "value")


@query(f"""SELECT user_id AS key, event_id AS "offset", lag({CENTS}) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS value
FROM events""")
def q_process_values(spark, sf):
    out = events(spark, sf).map_values(value_cents).process_values(Previous)
    return out.df.select("key", "offset", "value")


@query(f"""
SELECT o_custkey AS key, o_orderkey AS "offset", lag({ORDER_CENTS}) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS value FROM orders
""")
def q_table_process_values(spark, sf):
    """Each update of a table replaced by the value before it."""
    table = orders(spark, sf).map_values(order_cents).process_values(Previous)
    return table.changelog().select("key", "offset", "value")


@query(f"""
SELECT user_id AS key, CAST(sum({CENTS}) AS BIGINT) AS value FROM events WHERE event_type <> 'error' GROUP BY 1
""")
def q_global_store(spark, sf):
    """A table filled by a processor that is fed every record of its topics."""
    topics = topics_of(spark, "bigint")
    events(spark, sf).filter_kv(lambda k, v: v["event_type"] != "error").map_values(value_cents).sink_topic(topics, "all")
    return topics.global_store("all", RunningSum).snapshot().select("key", "value")


class Ticking:
    """Every six hours of event time, forwards the sum so far; the sum lives in what `init` returns."""

    key_type, value_type = "bigint", "bigint"

    def init(self, ctx):
        state = {"sum": 0, "key": None}
        ctx.schedule("6 hours", "stream-time", lambda now: ctx.forward(state["key"], state["sum"]))
        return state

    def on_record(self, ctx, state, record):
        state["sum"] += record["value"]
        state["key"] = record["key"]


class TickingByBoth(Ticking):
    """The same beside a timer by wall clock."""

    def init(self, ctx):
        ctx.schedule("1 hour", "wall-clock-time", lambda now: ctx.forward(None, -1))
        return super().init(ctx)


TICKS_SQL = f"""
SELECT user_id AS key, (epoch_us(ts) // 1000) AS event_time, CAST(total - c AS BIGINT) AS value FROM (
  SELECT user_id, ts, {CENTS} AS c, sum({CENTS}) OVER w AS total, lag(ts) OVER w AS before, min(ts) OVER (PARTITION BY user_id) AS first
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE ((epoch_us(ts) // 1000) - (epoch_us(first) // 1000)) // 21600000 > ((epoch_us(before) // 1000) - (epoch_us(first) // 1000)) // 21600000
"""


@query(TICKS_SQL)
def q_process_schedule(spark, sf):
    """Timers by event time fire before the record that passes them."""
    out = events(spark, sf).map_values(value_cents).process(Ticking)
    return out.df.select("key", F.unix_millis("timestamp").alias("event_time"), "value")


class Sorting:
    """Sends every record to the child of its kind, with its place, and large ones to both."""

    key_type, value_type = "bigint", "struct<topic:string,offset:bigint,cents:bigint,headers:int>"

    def on_record(self, ctx, state, record):
        value = {"topic": ctx.topic, "offset": ctx.offset, "cents": record["value"], "headers": len(ctx.headers or [])}
        both = record["value"] >= 5000
        ctx.forward(record["key"], value, child=None if both else "clicks" if record["topic"] == "click" else "others")


SORTED_SQL = f"""
SELECT out AS topic, event_type AS was, CAST(count(*) AS BIGINT) AS records, CAST(sum(c) AS BIGINT) AS total, CAST(sum(event_id) AS BIGINT) AS places
FROM (SELECT event_type, event_id, {CENTS} AS c, unnest(CASE WHEN {CENTS} >= 5000 THEN ['a', 'b'] WHEN event_type = 'click' THEN ['a'] ELSE ['b'] END) AS out
      FROM events) GROUP BY 1, 2
"""


def sorted_out(topics):
    return topics.read().groupBy("topic", F.col("value.topic").alias("was")).agg(
        F.count("*").alias("records"), F.sum("value.cents").alias("total"), F.sum("value.offset").alias("places"))


def topics_of(spark, value_type: str):
    from tideway.session import fresh_path
    from tideway.sources.topics import TopicDataset

    return TopicDataset(spark, fresh_path(spark, "topics"), "bigint", value_type, partitions=4)


@query(SORTED_SQL)
def q_process_children(spark, sf):
    """A processor's children as topics, written in one transaction."""
    topics = topics_of(spark, Sorting.value_type)
    events(spark, sf).map_values(value_cents).process(Sorting).sink_children(topics, {"clicks": "a", "others": "b"})
    return sorted_out(topics)


@query(SORTED_SQL)
def q_process_merged_parents(spark, sf):
    """One processor and one sink with several parents each."""
    from tideway.operators.stream import add_processor, add_sink

    s = events(spark, sf).map_values(value_cents)
    parents = s.branch([lambda k, v: F.col("topic") == "click", lambda k, v: F.col("topic") == "error", lambda k, v: F.lit(True)])
    out = add_processor(parents, Sorting)
    topics = topics_of(spark, Sorting.value_type)
    child = lambda c: type(out)(out.df.filter(F.coalesce(F.col("child") == c, F.lit(True))).drop("child"))
    add_sink([child("clicks")], topics, "a")
    other = child("others").branch([lambda k, v: v["topic"] == "error", lambda k, v: F.lit(True)])
    add_sink(other, topics, "b")
    return sorted_out(topics)


# -- upkeep -------------------------------------------------------------------------------------------


@query(f"""
SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS partition, user_id AS key, event_id AS "offset", {CENTS} AS value FROM events
QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id DESC) = 1
""")
def q_compact(spark, sf):
    df = upkeep.compact_topic(events(spark, sf).map_values(value_cents).df)
    return df.select("topic", "partition", "key", "offset", "value")


@query("""
SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset" FROM events
WHERE NOT (event_type = 'click' AND user_id % 4 = 0 AND event_id < 500)
  AND NOT (event_type = 'error' AND user_id % 4 = 3 AND event_id < 900)
""")
def q_delete_before(spark, sf):
    df = upkeep.delete_records_before(events(spark, sf).df, {("click", 0): 500, ("error", 3): 900})
    return df.select("topic", "partition", "offset")


@query("""
SELECT event_type AS topic, CAST(count(*) AS BIGINT) AS records, CAST(count(DISTINCT user_id) AS BIGINT) AS keys,
       CAST(count(DISTINCT user_id) AS BIGINT) AS places
FROM events GROUP BY 1
""")
def q_repartition_topic(spark, sf):
    """Every record moves to the partition its key hashes to; a key is in one partition, offsets have no gap."""
    moved = upkeep.repartition_topic(events(spark, sf).df, 16, move=True)
    per = moved.groupBy("topic", "partition").agg(
        F.count("*").alias("n"), F.max("offset").alias("last"), F.min("offset").alias("first"))
    gaps = per.filter("first <> 0 OR last <> n - 1").groupBy("topic").agg(F.count("*").alias("bad"))
    stats = moved.groupBy("topic").agg(
        F.count("*").alias("records"), F.count_distinct("key").alias("keys"),
        F.count_distinct("key", "partition").alias("places"))
    return stats.join(gaps, "topic", "left").filter("bad IS NULL").select("topic", "records", "keys", "places")


@query("""
SELECT event_type AS topic, CAST(count(*) AS BIGINT) AS records, CAST(count(*) AS BIGINT) AS places, CAST(count(*) FILTER (ts < TIMESTAMP '2024-01-15') AS BIGINT) AS stayed
FROM events GROUP BY 1
""")
def q_repartition_in_place(spark, sf):
    """Records from a position on go by the new rule and are numbered behind what stays: every record has a place of its own, and what stays keeps its."""
    df = events(spark, sf).df
    early = df.filter(F.col("timestamp") < F.lit("2024-01-15").cast("timestamp"))
    cuts = early.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("offset"))
    now = upkeep.repartition_topic(df, 16, from_offsets=cuts).groupBy("topic").agg(
        F.count("*").alias("records"), F.count_distinct("partition", "offset").alias("places"))
    place = ["topic", "partition", "offset", "key"]
    kept = upkeep.repartition_topic(df, 16, from_offsets=cuts).join(early.select(*place), place, "left_semi")
    return now.join(kept.groupBy("topic").agg(F.count("*").alias("stayed")), "topic")
