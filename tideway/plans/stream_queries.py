"""Queries over streams: one record at a time, folds, windows, sessions, joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideway.functions import folds
from tideway.operators.grouped import on_time
from tideway.operators.stream import Stream
from tideway.operators.table import Table
from tideway.plans.registry import query
from tideway.sources import positions as P
from tideway.sources.adapters import (
    cents, customers, documents, events, nations, orders,
)

CENTS = "CAST(round(value * 100) AS BIGINT)"
MODULUS = 1_000_003


def value_cents(k, v):
    return cents(v["value"])


def purchases_with_id(stream: Stream, event_type: str) -> Stream:
    return stream.filter_kv(lambda k, v: v["event_type"] == event_type).map_values(
        lambda k, v: F.struct(F.col("offset").alias("id"), cents(v["value"]).alias("cents")))


# -- one record at a time -----------------------------------------------------------------------


@query('SELECT user_id AS key, event_id AS "offset", value FROM events WHERE value >= 42')
def q_filter_kv(spark, sf):
    df = events(spark, sf).filter_kv(lambda k, v: v["value"] >= 42).df
    return df.select("key", "offset", F.col("value.value").alias("value"))


@query(f'SELECT event_type AS key, {CENTS} AS value, event_id AS "offset" FROM events')
def q_map_kv(spark, sf):
    return events(spark, sf).map_kv(lambda k, v: (v["event_type"], value_cents(k, v))).df.select("key", "value", "offset")


@query('SELECT event_type AS key, value, event_id AS "offset" FROM events')
def q_map_keys(spark, sf):
    df = events(spark, sf).map_keys(lambda k, v: v["event_type"]).df
    return df.select("key", F.col("value.value").alias("value"), "offset")


@query(f'SELECT user_id AS key, {CENTS} AS value, event_id AS "offset" FROM events')
def q_map_values(spark, sf):
    return events(spark, sf).map_values(value_cents).df.select("key", "value", "offset")


@query("""
SELECT token AS key, CAST(count(*) AS BIGINT) AS n, CAST(sum(length(token)) AS BIGINT) AS chars
FROM (SELECT unnest(string_split(text, ' ')) AS token FROM documents) GROUP BY token
""")
def q_fmap_kv(spark, sf):
    """Documents flat-mapped to (token, length), then folded per token."""
    tokens = documents(spark, sf).fmap_kv(lambda k, v: F.transform(
        F.split(v["text"], " "), lambda t: F.struct(t.alias("key"), F.length(t).alias("value"))))
    fold = folds.together(n=folds.count(), chars=folds.total(lambda k, v: v))
    return tokens.group_by_key().reduce_values(fold).snapshot().select("key", "value.n", "value.chars")


@query("""
SELECT doc_id AS key, CAST(count(*) AS BIGINT) AS n, CAST(count(CASE WHEN token = '' THEN 1 END) AS BIGINT) AS empty,
       max(token) AS last_token
FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS token FROM documents) GROUP BY doc_id
""")
def q_fmap_values(spark, sf):
    tokens = documents(spark, sf).fmap_values(lambda k, v: F.split(v["text"], " "))
    fold = folds.together(
        n=folds.count(), empty=folds.total(lambda k, v: F.when(v == "", 1).otherwise(0)),
        last_token=folds.maximum(lambda k, v: v))
    return tokens.group_by_key().reduce_values(fold).snapshot().select(
        "key", "value.n", "value.empty", "value.last_token")


BRANCHES = [
    lambda k, v: v["event_type"] == "purchase",
    lambda k, v: v["event_type"] == "error",
    lambda k, v: v["value"] >= 10,
]
BRANCH_SQL = """
SELECT "offset", key, branch FROM (
  SELECT event_id AS "offset", user_id AS key,
         CASE WHEN event_type = 'purchase' THEN 0 WHEN event_type = 'error' THEN 1 WHEN value >= 10 THEN 2 END AS branch
  FROM events) WHERE branch IS NOT NULL
"""


@query(BRANCH_SQL)
def q_branch(spark, sf):
    """Three streams, first match wins, put together again with their number."""
    streams = events(spark, sf).branch(BRANCHES)
    out = None
    for i, s in enumerate(streams):
        df = s.df.select("offset", "key", F.lit(i).alias("branch"))
        out = df if out is None else out.unionByName(df)
    return out


@query(BRANCH_SQL)
def q_branch_tagged(spark, sf):
    """The same split in one pass over the input."""
    return events(spark, sf).tag_branch(BRANCHES).select("offset", "key", "branch")


@query("""
SELECT event_id AS "offset", user_id AS key, event_type FROM events WHERE event_type IN ('purchase', 'error')
UNION ALL SELECT event_id, user_id, event_type FROM events WHERE event_type = 'error' AND value > 10
""")
def q_merge_stream(spark, sf):
    s = events(spark, sf)
    both = s.filter_kv(lambda k, v: v["event_type"].isin("purchase", "error"))
    again = s.filter_kv(lambda k, v: (v["event_type"] == "error") & (v["value"] > 10))
    return both.merge_stream(again).df.select("offset", "key", F.col("value.event_type").alias("event_type"))


@query("""
SELECT event_id AS "offset", CAST((epoch_us(coalesce(lag(ts) OVER (PARTITION BY event_type, user_id % 4 ORDER BY event_id), ts)) // 1000)
       AS BIGINT) AS event_time FROM events
""")
def q_extract_timestamp(spark, sf):
    """Event time = time of the record before in the same partition."""
    df = P.extract_timestamp(events(spark, sf).df, lambda prev, rec: F.coalesce(prev, rec["timestamp"]))
    return df.select("offset", F.unix_millis("timestamp").alias("event_time"))


# -- folds ----------------------------------------------------------------------------------------


@query(f"SELECT event_type AS key, CAST(sum({CENTS}) AS BIGINT) AS value FROM events GROUP BY 1")
def q_group_by_reduce(spark, sf):
    grouped = events(spark, sf).group_by(lambda k, v: v["event_type"])
    return grouped.reduce_values(folds.total(value_cents)).snapshot()


@query("SELECT user_id AS key, CAST(count(*) AS BIGINT) AS value FROM events GROUP BY 1")
def q_group_by_key_count(spark, sf):
    return events(spark, sf).group_by_key().reduce_values(folds.count()).snapshot()


@query(f"""
SELECT user_id AS key, CAST(count(*) AS BIGINT) AS n, min({CENTS}) AS low, max({CENTS}) AS high,
       CAST(sum({CENTS}) AS DOUBLE) / count(*) AS mean FROM events GROUP BY 1
""")
def q_fold_together(spark, sf):
    fold = folds.together(n=folds.count(), low=folds.minimum(value_cents), high=folds.maximum(value_cents),
                          mean=folds.mean(value_cents))
    return events(spark, sf).group_by_key().reduce_values(fold).snapshot().select("key", "value.*")


@query("SELECT event_type AS key, CAST(count(DISTINCT user_id) AS BIGINT) AS value FROM events GROUP BY 1")
def q_fold_builtin(spark, sf):
    """Any Spark aggregate can be the fold."""
    grouped = events(spark, sf).map_values(lambda k, v: F.struct(k.alias("user"), v.alias("v"))).group_by(
        lambda k, v: v["v"]["event_type"])
    return grouped.reduce_values(lambda k, v: F.count_distinct(v["user"])).snapshot()


FOLD_SQL = f"""
SELECT user_id AS key, CAST(list_reduce(list_prepend(CAST(0 AS BIGINT), list({CENTS} ORDER BY event_id)),
       lambda agg, x: (agg * 31 + x) % {MODULUS}) AS BIGINT) AS value
FROM events GROUP BY 1
"""


def polynomial_fold(block: int = 2048) -> folds.OrderedFold:
    """agg * 31 + cents mod M: as the map x → m·x + a, so that neighbouring stretches can be merged."""
    pair = lambda m, a: F.struct((m % MODULUS).alias("m"), (a % MODULUS).alias("a"))
    return folds.OrderedFold(
        seed=F.struct(F.lit(1).cast("bigint").alias("m"), F.lit(0).cast("bigint").alias("a")),
        step=lambda agg, k, v: pair(agg["m"] * 31, agg["a"] * 31 + value_cents(k, v)),
        merge=lambda a, b: pair(a["m"] * b["m"], a["a"] * b["m"] + b["a"]),
        finish=lambda agg: agg["a"], block=block,
    )


@query(FOLD_SQL)
def q_fold_ordered(spark, sf):
    return events(spark, sf).group_by_key().reduce_values(polynomial_fold()).snapshot()


@query(FOLD_SQL)
def q_fold_rows(spark, sf):
    """The same fold as an arbitrary Python step."""
    fold = folds.RowFold(lambda: 0, lambda agg, k, v: (agg * 31 + v) % MODULUS, "bigint")
    return events(spark, sf).map_values(value_cents).group_by_key().reduce_values(fold).snapshot()


@query(f"""
SELECT event_id AS "offset", user_id AS key, CAST(count(*) OVER w AS BIGINT) AS n, CAST(sum({CENTS}) OVER w AS BIGINT) AS total
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
""")
def q_reduce_changelog(spark, sf):
    """Every intermediate value of a fold, one per record."""
    fold = folds.together(n=folds.count(), total=folds.total(value_cents))
    changes = events(spark, sf).group_by_key().reduce_values(fold).changelog()
    return changes.select("offset", "key", "value.n", "value.total")


# -- windows and sessions -----------------------------------------------------------------------------

TUMBLING_SQL = f"""
SELECT user_id AS key, (epoch_us(ts) // 1000) - (epoch_us(ts) // 1000) % 86400000 AS window_from,
       (epoch_us(ts) // 1000) - (epoch_us(ts) // 1000) % 86400000 + 86400000 AS window_to, CAST(sum({CENTS}) AS BIGINT) AS value
FROM events GROUP BY 1, 2, 3
"""


@query(TUMBLING_SQL)
def q_window_tumbling_sum(spark, sf):
    return events(spark, sf).group_by_key().window("1 day").reduce_windows(folds.total(value_cents)).df


def hopping_sql(length: int, step: int, agg: str) -> str:
    return f"""
SELECT key, window_from, window_from + {length} AS window_to, CAST({agg} AS BIGINT) AS value FROM (
  SELECT user_id AS key, {CENTS} AS c, (epoch_us(ts) // 1000) - (epoch_us(ts) // 1000) % {step} - i * {step} AS window_from, (epoch_us(ts) // 1000) AS t
  FROM events, generate_series(0, {length // step}) AS g(i))
WHERE window_from > t - {length} AND window_from >= 0 GROUP BY key, window_from
"""


@query(hopping_sql(172800000, 86400000, "count(*)"))
def q_window_hopping_count(spark, sf):
    return events(spark, sf).group_by_key().window("2 days", "hopping", "1 day").reduce_windows(folds.count()).df


@query(hopping_sql(43200000, 3600000, "sum(c)"))
def q_window_hopping_panes(spark, sf):
    """Twelve overlapping windows per record: folded once per hour, then merged per window."""
    grouped = events(spark, sf).group_by_key()
    return grouped.window("12 hours", "hopping", "1 hour").reduce_windows(folds.total(value_cents)).df


@query(hopping_sql(18000000, 10800000, "max(c)"))
def q_window_hopping_uneven(spark, sf):
    """Length not a multiple of the step: a record is in one or two windows."""
    grouped = events(spark, sf).group_by_key()
    return grouped.window("5 hours", "hopping", "3 hours").reduce_windows(folds.maximum(value_cents)).df


@query(f"""
SELECT DISTINCT user_id AS key, (epoch_us(ts) // 1000) - 43200000 AS window_from, (epoch_us(ts) // 1000) AS window_to,
       CAST(sum({CENTS}) OVER w AS BIGINT) AS value
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY (epoch_us(ts) // 1000) RANGE BETWEEN 43200000 PRECEDING AND CURRENT ROW)
""")
def q_window_sliding_sum(spark, sf):
    return events(spark, sf).group_by_key().window("12 hours", "sliding").reduce_windows(folds.total(value_cents)).df


@query(f"""
SELECT DISTINCT event_type AS key, (epoch_us(ts) // 1000) - 3600000 AS window_from, (epoch_us(ts) // 1000) AS window_to,
       CAST(count(*) OVER w AS BIGINT) AS n, min({CENTS}) OVER w AS low, max({CENTS}) OVER w AS high
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY (epoch_us(ts) // 1000) RANGE BETWEEN 3600000 PRECEDING AND CURRENT ROW)
""")
def q_window_sliding_minmax(spark, sf):
    grouped = events(spark, sf).group_by(lambda k, v: v["event_type"])
    fold = folds.together(n=folds.count(), low=folds.minimum(value_cents), high=folds.maximum(value_cents))
    return grouped.window("1 hour", "sliding").reduce_windows(fold).df.select("key", "window_from", "window_to", "value.*")


SESSION_SQL = f"""
SELECT key, (epoch_us(min(ts)) // 1000) AS window_from, (epoch_us(max(ts)) // 1000) AS window_to, CAST(count(*) AS BIGINT) AS n,
       CAST(sum(c) AS BIGINT) AS total
FROM (SELECT *, sum(opens) OVER (PARTITION BY key ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM (
  SELECT user_id AS key, ts, {CENTS} AS c,
         CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens
  FROM events)) GROUP BY key, session
"""


def session_fold():
    return folds.together(n=folds.count(), total=folds.total(value_cents))


@query(SESSION_SQL)
def q_session_reduce(spark, sf):
    sessions = events(spark, sf).group_by_key().window_by_session("6 hours").reduce_sessions(session_fold())
    return sessions.df.select("key", "window_from", "window_to", "value.*")


@query(f"""
SELECT key, window_from, window_from + 2592000000 AS window_to, CAST(count(*) AS BIGINT) AS value FROM (
  SELECT o_orderstatus AS key, (epoch_us(o_orderdate) // 1000) - (epoch_us(o_orderdate) // 1000) % 2592000000 AS window_from, o_orderdate,
         max(o_orderdate) OVER (ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS clock FROM orders)
WHERE o_orderdate >= clock - INTERVAL 365 DAY GROUP BY 1, 2
""")
def q_window_retention(spark, sf):
    """Orders arrive far out of time; those later than the retention are dropped before the windows."""
    late = Stream(orders(spark, sf).changelog()).group_by(lambda k, v: v["o_orderstatus"])
    windows = late.window("30 days", retention="365 days", apply_retention=True)
    return windows.reduce_windows(folds.count()).df


# -- stream–stream joins --------------------------------------------------------------------------------

SIDES = f"""
WITH l AS (SELECT user_id AS key, event_id AS id, ts, {CENTS} AS cents FROM events WHERE event_type = 'click'),
     r AS (SELECT user_id AS key, event_id AS id, ts, {CENTS} AS cents FROM events WHERE event_type = 'purchase')
"""
NEAR = "l.key = r.key AND abs(epoch_us(l.ts) - epoch_us(r.ts)) <= 3600000000"
PAIR = """coalesce(l.key, r.key) AS key, l.id AS l_id, r.id AS r_id, l.cents AS l_cents, r.cents AS r_cents,
       (epoch_us(greatest(l.ts, r.ts)) // 1000) AS event_time"""


def clicks_and_purchases(spark, sf):
    s = events(spark, sf)
    return purchases_with_id(s, "click"), purchases_with_id(s, "purchase")


def pair(l, r):
    return F.struct(l["id"].alias("l_id"), r["id"].alias("r_id"), l["cents"].alias("l_cents"), r["cents"].alias("r_cents"))


def pairs(stream: Stream):
    return stream.df.select("key", "value.*", F.unix_millis("timestamp").alias("event_time"))


@query(f"{SIDES} SELECT {PAIR} FROM l JOIN r ON {NEAR}")
def q_join_stream(spark, sf):
    l, r = clicks_and_purchases(spark, sf)
    return pairs(l.join_stream(r, pair, "1 hour"))


@query(f"{SIDES} SELECT {PAIR} FROM l LEFT JOIN r ON {NEAR}")
def q_left_join_stream(spark, sf):
    l, r = clicks_and_purchases(spark, sf)
    return pairs(l.left_join_stream(r, pair, "1 hour"))


@query(f"{SIDES} SELECT {PAIR} FROM l FULL JOIN r ON {NEAR}")
def q_outer_join_stream(spark, sf):
    l, r = clicks_and_purchases(spark, sf)
    return pairs(l.outer_join_stream(r, pair, "1 hour"))


EAGER_LEFT = f"""
SELECT {PAIR} FROM l JOIN r ON {NEAR} UNION ALL
SELECT l.key, l.id, NULL, l.cents, NULL, (epoch_us(l.ts) // 1000) FROM l
WHERE NOT EXISTS (SELECT 1 FROM r WHERE {NEAR} AND r.ts < l.ts)
"""


@query(f"{SIDES} {EAGER_LEFT}")
def q_left_join_stream_eager(spark, sf):
    l, r = clicks_and_purchases(spark, sf)
    return pairs(l.left_join_stream(r, pair, "1 hour", emit="eager"))


@query(f"""{SIDES} {EAGER_LEFT} UNION ALL
SELECT r.key, NULL, r.id, NULL, r.cents, (epoch_us(r.ts) // 1000) FROM r
WHERE NOT EXISTS (SELECT 1 FROM l WHERE {NEAR} AND l.ts <= r.ts)
""")
def q_outer_join_stream_eager(spark, sf):
    l, r = clicks_and_purchases(spark, sf)
    return pairs(l.outer_join_stream(r, pair, "1 hour", emit="eager"))


# -- stream–table and stream–global joins ------------------------------------------------------------------


def last_error(spark, sf) -> Table:
    """A user's last error as a table; small errors are deletes."""
    errors = events(spark, sf).filter_kv(lambda k, v: v["event_type"] == "error").map_values(
        lambda k, v: F.when(v["value"] >= 20, F.struct(F.col("offset").alias("id"), cents(v["value"]).alias("cents"))))
    return Table(errors.df, order=["offset"])


def asof_sql(kind: str) -> str:
    return f"""
SELECT p.user_id AS key, p.event_id AS id, p.c AS cents, CASE WHEN t.c >= 2000 THEN t.event_id END AS error_id,
       CASE WHEN t.c >= 2000 THEN t.c END AS error_cents
FROM (SELECT *, {CENTS} AS c FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT *, {CENTS} AS c FROM events WHERE event_type = 'error') t
  ON p.user_id = t.user_id AND p.ts >= t.ts {"WHERE t.c >= 2000" if kind == "inner" else ""}
"""


def with_error(v, t):
    return F.struct(v["id"].alias("id"), v["cents"].alias("cents"), t["id"].alias("error_id"), t["cents"].alias("error_cents"))


@query(asof_sql("inner"))
def q_join_table_asof(spark, sf):
    joined = purchases_with_id(events(spark, sf), "purchase").join_table(last_error(spark, sf), with_error)
    return joined.df.select("key", "value.*")


@query(asof_sql("left"))
def q_left_join_table_asof(spark, sf):
    joined = purchases_with_id(events(spark, sf), "purchase").left_join_table(last_error(spark, sf), with_error)
    return joined.df.select("key", "value.*")


def with_nation(v, n):
    return F.struct(v["c_name"].alias("c_name"), n["n_name"].alias("n_name"))


@query("SELECT c_custkey AS key, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def q_join_global_table(spark, sf):
    joined = customers(spark, sf).join_global_table(nations(spark, sf), lambda k, v: v["c_nationkey"], with_nation)
    return joined.df.select("key", "value.*")


@query("""
SELECT c_custkey AS key, c_name, n_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey = 1)
ON c_nationkey = n_nationkey
""")
def q_left_join_global_table(spark, sf):
    region = nations(spark, sf).filter_kv(lambda k, v: v["n_regionkey"] == 1)
    joined = customers(spark, sf).left_join_global_table(region, lambda k, v: v["c_nationkey"], with_nation)
    return joined.df.select("key", "value.*")


@query("""
SELECT p_brand AS key, l_orderkey, l_linenumber, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents
FROM lineitem JOIN part ON l_partkey = p_partkey
""")
def q_join_global_large(spark, sf):
    """A global table that grows with the data: Spark shuffles it once it is above the broadcast threshold."""
    from tideway.record import as_records
    from tideway.sources.adapters import raw

    parts = Table(as_records(
        raw(spark, sf, "part"), topic="part", offset=F.col("p_partkey"), key=F.col("p_partkey"),
        value=F.struct("p_brand")), order=["offset"])
    lines = Stream(as_records(
        raw(spark, sf, "lineitem"), topic="lineitem", key=F.col("l_orderkey"), timestamp=F.col("l_shipdate"),
        value=F.struct("l_partkey", "l_linenumber", cents(F.col("l_extendedprice")).alias("cents"))))
    joined = lines.join_global_table(
        parts, lambda k, v: v["l_partkey"],
        lambda v, p: F.struct(p["p_brand"].alias("brand"), v["l_linenumber"].alias("l_linenumber"), v["cents"].alias("cents")))
    return joined.df.select(F.col("value.brand").alias("key"), F.col("key").alias("l_orderkey"),
                            "value.l_linenumber", "value.cents")
