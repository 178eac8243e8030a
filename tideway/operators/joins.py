"""The ten joins. All are equi-joins on the key; see each function for what else must hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideway.functions import scans as S
from tideway.record import HEADERS_TYPE, interval_ms, interval_us, order_columns

BUCKET_SPAN = 4  # length of a time bucket in join intervals; a right record lands in 1 + 2/4 buckets on average


def _usable(df: DataFrame) -> DataFrame:
    """Records that can take part in a join: null keys and null values never do."""
    return df.filter(F.col("key").isNotNull() & F.col("value").isNotNull())


def _side(df: DataFrame, tag: str) -> DataFrame:
    return df.select(
        F.col("key"), F.unix_micros("timestamp").alias(f"{tag}_us"),
        F.struct(*[c for c in df.columns if c not in ("key", "timestamp")]).alias(tag),
    )


def _in_bucket(df: DataFrame, us: str, width: int) -> DataFrame:
    return df.withColumn("_b", F.floor(F.col(us) / width).cast("bigint"))


def _in_reach(df: DataFrame, us: str, width: int, reach: int) -> DataFrame:
    low = F.floor((F.col(us) - reach) / width).cast("bigint")
    high = F.floor((F.col(us) + reach) / width).cast("bigint")
    return df.withColumn("_b", F.explode(F.sequence(low, high)))


def _joined_record(df: DataFrame, f, left_columns: list[str], right_columns: list[str]) -> DataFrame:
    """Rows with structs `l` and `r` (either may be null), `l_us` and `r_us` as records; time is the later of the two."""
    l, r = F.col("l"), F.col("r")
    pick = lambda name, default=None: F.coalesce(
        *([l[name]] if name in left_columns else []), *([r[name]] if name in right_columns else []),
        default if default is not None else F.lit(None),
    )
    positions = lambda side, columns: F.coalesce(
        side["_pos"] if "_pos" in columns else F.array().cast("array<bigint>"), F.array().cast("array<bigint>")
    )
    partner = F.when(
        l.isNotNull() & r.isNotNull(), F.array(r["partition"].cast("bigint"), r["offset"])
    ).otherwise(F.array().cast("array<bigint>"))
    return df.select(
        pick("topic").alias("topic"), pick("partition").alias("partition"), pick("offset").alias("offset"),
        F.timestamp_micros(F.greatest("l_us", "r_us")).alias("timestamp"), pick("timestampType").cast("int").alias("timestampType"),
        F.col("key"), f(l["value"], r["value"]).alias("value"),
        pick("headers", F.array().cast(HEADERS_TYPE)).alias("headers"),
        F.concat(positions(l, left_columns), partner, positions(r, right_columns)).alias("_pos"),
    )


def stream_stream(left: DataFrame, right: DataFrame, f, interval, how: str, emit: str = "final",
                  retention=None) -> DataFrame:
    """Records of both sides with the same key and times at most `interval` apart.

    The equi-key includes a time bucket, so the records of a hot key spread over as many tasks as there are
    buckets; what is left of skew inside one bucket is split by adaptive skew joins, since left joins, anti joins and
    inner joins can all split their left side. `emit="eager"` adds a (v, null) row for every record that had no
    partner *yet* when it arrived; `"final"` gives it only to records that never find one.
    """
    if emit not in ("final", "eager"):
        raise ValueError(f"unknown emit mode: {emit!r}")
    reach = interval_us(interval)
    if left.isStreaming or right.isStreaming:
        return _stream_stream_streaming(left, right, f, interval, how, emit, retention)
    lcols, rcols = left.columns, right.columns
    width = max(reach, 1) * BUCKET_SPAN
    l, r = _side(_usable(left), "l"), _side(_usable(right), "r")
    near = F.abs(F.col("l_us") - F.col("r_us")) <= reach
    same = ["key", "_b"]

    def join(a: DataFrame, b: DataFrame, kind: str, condition: Column) -> DataFrame:
        a, b = a.alias("a"), b.alias("b")
        on = (F.col("a.key") == F.col("b.key")) & (F.col("a._b") == F.col("b._b")) & condition
        out = a.join(b, on, kind)
        return out.select("a.*") if kind == "left_anti" else out.select(
            F.col("a.key").alias("key"), "l_us", "l", "r_us", "r"
        )

    l_here, r_here = _in_bucket(l, "l_us", width), _in_bucket(r, "r_us", width)
    l_reach, r_reach = _in_reach(l, "l_us", width, reach), _in_reach(r, "r_us", width, reach)
    no_r = [F.lit(None).cast("bigint").alias("r_us"), F.lit(None).cast(r.schema["r"].dataType).alias("r")]
    no_l = [F.lit(None).cast("bigint").alias("l_us"), F.lit(None).cast(l.schema["l"].dataType).alias("l")]
    if emit == "final" and how == "outer":
        out = _outer_in_one_pass(l_reach, r_reach, width, near)
    elif emit == "final":
        out = join(l_here, r_reach, "inner" if how == "inner" else "left", near)
    else:
        out = join(l_here, r_reach, "inner", near)
        if how != "inner":
            # at equal times the left record counts as the earlier one
            early = join(l_here, r_reach, "left_anti", near & (F.col("r_us") < F.col("l_us")))
            out = out.unionByName(early.select("key", "l_us", "l", *no_r))
        if how == "outer":
            early = join(r_here, l_reach, "left_anti", near & (F.col("l_us") <= F.col("r_us")))
            out = out.unionByName(early.select("key", *no_l, "r_us", "r"))
    return _joined_record(out, f, lcols, rcols)


def _outer_in_one_pass(l_reach: DataFrame, r_reach: DataFrame, width: int, near: Column) -> DataFrame:
    """Full outer join of records that are at home in one bucket and guests in those within reach, each side read and shuffled once.

    A record meets all its partners in its home bucket. Rows count where their left record is at home or, without one, their right record;
    two guests never make a pair, so neither hides the other.
    """
    home = lambda us: F.col("_b") == F.floor(F.col(us) / width).cast("bigint")
    a = l_reach.withColumn("_lh", home("l_us")).withColumnsRenamed({"key": "_lk", "_b": "_lb"})
    b = r_reach.withColumn("_rh", home("r_us")).withColumnsRenamed({"key": "_rk", "_b": "_rb"})
    met = (F.col("_lk") == F.col("_rk")) & (F.col("_lb") == F.col("_rb")) & near & (F.col("_lh") | F.col("_rh"))
    rows = a.join(b, met, "full").filter(F.coalesce("_lh", "_rh"))
    return rows.select(F.coalesce("_lk", "_rk").alias("key"), "l_us", "l", "r_us", "r")


def _stream_stream_streaming(left, right, f, interval, how, emit, retention) -> DataFrame:
    """The same join on streams: watermarks bound the state, rows without partner appear once none can come."""
    if emit == "eager":
        from tideway.streaming.stateful import DAY, eager_join

        return eager_join(left, right, f, interval, how, max(interval_ms(retention or DAY), interval_ms(interval)))
    keep = f"{max(interval_ms(retention or (1, 'days')), interval_ms(interval))} milliseconds"
    reach = F.expr(f"INTERVAL {interval_ms(interval)} MILLISECONDS")

    def side(df, tag):
        kept = [c for c in df.columns if c not in ("key", "timestamp")]
        return _usable(df).select(
            F.col("key").alias(f"{tag}_key"), F.col("timestamp").alias(f"{tag}_ts"),
            F.unix_micros("timestamp").alias(f"{tag}_us"), F.struct(*kept).alias(tag),
        ).withWatermark(f"{tag}_ts", keep)

    on = (
        (F.col("l_key") == F.col("r_key"))
        & (F.col("r_ts") >= F.col("l_ts") - reach) & (F.col("r_ts") <= F.col("l_ts") + reach)
    )
    kind = {"inner": "inner", "left": "leftOuter", "outer": "fullOuter"}[how]
    out = side(left, "l").join(side(right, "r"), on, kind)
    out = out.withColumn("key", F.coalesce("l_key", "r_key"))
    return _joined_record(out, f, left.columns, right.columns)


def stream_table(stream: DataFrame, table, f, how: str, retention=None) -> DataFrame:
    """Each stream record with the value its key had in the table at the record's time.

    The table never fires. At equal times the table update comes first. Streams and updates are put in one order per
    key and each stream record takes the last update before it; hot keys are cut into chunks by the scan. On a stream, records wait until the
    watermark, `retention` (a day) behind, has passed them.
    """
    changes = table.changelog()
    if stream.isStreaming or changes.isStreaming:
        from tideway.streaming.stateful import DAY, as_of_join

        return as_of_join(stream, changes, f, how, retention or DAY)
    records = _usable(stream)
    order = order_columns(records)
    meta = [c for c in records.columns if c not in ("key", "value")]
    updates = changes.filter(F.col("key").isNotNull())
    tie = [c for c in order if c in updates.columns and c != "timestamp"]
    update = F.struct(F.col("value").alias("value"))
    rows = records.select(
        "key", *meta, F.lit(1).alias("_side"), F.col("value"),
        F.lit(None).cast(updates.select(update).schema[0].dataType).alias("_update"),
    ).unionByName(
        updates.select("key", "timestamp", *tie, F.lit(0).alias("_side"), update.alias("_update")),
        allowMissingColumns=True,
    )
    by = ["timestamp", "_side", *[c for c in order if c != "timestamp"]]
    seen = S.scan(rows, ["key"], by, {
        "_seen": S.last_known(F.col("_side") == 0, F.col("_update.value").alias("value"))
    }).filter("_side = 1")
    found = F.col("_seen.value")
    if how == "inner":
        seen = seen.filter(found.isNotNull())
    return seen.withColumn("value", f(F.col("value"), found)).select(*stream.columns)


def stream_global(stream: DataFrame, table, f_key, f, how: str) -> DataFrame:
    """Each stream record with the global table's current value for `f_key(k, v)`; the record keeps its own key.

    The table side is broadcast when Spark knows its size and it is below
    `spark.sql.autoBroadcastJoinThreshold`; a larger one is shuffled, and a hot lookup key is split by the
    adaptive skew join (the table holds one row per key).
    """
    snapshot = table.snapshot().select(F.col("key").alias("_gk"), F.col("value").alias("_gv"))
    keyed = _usable(stream).withColumn("_lk", f_key(F.col("key"), F.col("value")))
    out = keyed.join(snapshot, F.col("_lk") == F.col("_gk"), "inner" if how == "inner" else "left")
    return out.withColumn("value", f(F.col("value"), F.col("_gv"))).select(*stream.columns)


def table_table(left, right, f, how: str):
    """Tables joined by key; a key is in the result while the sides the join needs have a value for it."""
    from tideway.operators.table import Table

    l = left.snapshot().select("key", F.struct("value").alias("l"))
    r = right.snapshot().select("key", F.struct("value").alias("r"))
    kind = {"inner": "inner", "left": "left", "outer": "full"}[how]
    joined = l.join(r, "key", kind).select("key", f(F.col("l.value"), F.col("r.value")).alias("value"))

    def changes() -> DataFrame:
        return table_table_changes(left.changelog(), right.changelog(), f, how, (left.order, right.order))

    known = left._changes is not None and right._changes is not None
    return Table(changes if known else None, snapshot=joined.filter(F.col("value").isNotNull()))


def _arrival(df: DataFrame, order: list[str]) -> DataFrame:
    """Updates with `_clock`, the time at which they arrived: later than any update that comes before them in the order of their table."""
    if order[:1] == ["timestamp"]:
        return df.withColumn("_clock", F.col("timestamp"))
    return S.scan(df, ["key"], order, {"_clock": S.running(F.max("timestamp"), F.max, lambda a, b: F.greatest(a, b))})


def table_table_changes(left: DataFrame, right: DataFrame, f, how: str, orders: tuple[list[str], list[str]] | None = None) -> DataFrame:
    """One row per update of either side: the joined value after it, or a delete.

    The updates of a side come in the order of its table, those of the two sides by time. `orders` names the columns of both orders; without it they
    are the total order of records.
    """
    if left.isStreaming or right.isStreaming:
        from tideway.streaming.stateful import table_join

        return table_join(left, right, f, how)
    lt, rt = left.schema["value"].dataType, right.schema["value"].dataType
    meta = [c for c in left.columns if c not in ("key", "value") and c in right.columns]
    total = [c for c in order_columns(left) if c in meta]
    l_order, r_order = ([c for c in o if c in meta] for o in orders) if orders else (total, total)
    known = lambda df, order: _arrival(df.filter(F.col("key").isNotNull()), order)
    rows = known(left, l_order).select(
        "key", *meta, "_clock", F.lit(0).alias("_side"), F.col("value").alias("_lv"), F.lit(None).cast(rt).alias("_rv")
    ).unionByName(known(right, r_order).select(
        "key", *meta, "_clock", F.lit(1).alias("_side"), F.lit(None).cast(lt).alias("_lv"), F.col("value").alias("_rv")))
    rest = l_order if l_order == r_order else [*l_order, *[c for c in r_order if c not in l_order]]
    by = ["_clock", "_side", *[c for c in rest if c != "timestamp"]]
    seen = S.scan(rows, ["key"], by, {
        "_l": S.last_known(F.col("_side") == 0, F.col("_lv").alias("v")),
        "_r": S.last_known(F.col("_side") == 1, F.col("_rv").alias("v")),
    })
    return seen.select("key", *meta, joined_or_deleted(F.col("_l.v"), F.col("_r.v"), f, how).alias("value"))


def joined_or_deleted(l: Column, r: Column, f, how: str) -> Column:
    present = {
        "inner": l.isNotNull() & r.isNotNull(),
        "left": l.isNotNull(),
        "outer": l.isNotNull() | r.isNotNull(),
    }[how]
    return F.when(present, f(l, r))
