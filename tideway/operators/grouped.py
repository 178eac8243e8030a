"""Grouped streams, time windows and sessions, and the folds over them."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideway.functions import folds as folds_
from tideway.functions import scans as S
from tideway.functions.folds import Fold
from tideway.functions.layout import measure
from tideway.record import epoch_ms, interval_ms, interval_sql, interval_us, order_columns

DEFAULT_RETENTION = (1, "days")  # fixed value: how long a past window can still be updated
PANE_RATIO = 8                   # hopping windows overlapping more than this are built from panes


class GroupedStream:
    """Records split by key; records with a null key are gone."""

    def __init__(self, df: DataFrame):
        self.df = df.filter(F.col("key").isNotNull())

    def reduce_values(self, fold):
        """Fold the values of each key, in order, into a table."""
        from tideway.operators.table import Table

        df = self.df
        if df.isStreaming:
            if isinstance(fold, folds_.RowFold):
                from tideway.streaming.stateful import fold_stream

                return Table(None, snapshot=fold_stream(df, ["key"], fold))
            if isinstance(fold, folds_.OrderedFold):
                return LiveFold(df, fold)
            return Table(None, snapshot=_stream_fold(df, ["key"], fold))
        changes = None
        if isinstance(fold, Fold):
            changes = lambda: running_fold(df, fold)
        return Table(changes, snapshot=folds_.apply(df, ["key"], fold, order_columns(df)))

    def window(self, interval, kind: str = "tumbling", advance_by=None, retention=DEFAULT_RETENTION,
               apply_retention: bool = False) -> TimeWindowed:
        return TimeWindowed(self.df, interval, kind, advance_by, retention, apply_retention)

    def window_by_session(self, interval, retention=DEFAULT_RETENTION,
                          apply_retention: bool = False) -> SessionWindowed:
        return SessionWindowed(self.df, interval, retention, apply_retention)


def _stream_fold(df: DataFrame, keys: list, fold) -> DataFrame:
    """A fold on a streaming frame; needs an aggregate that Spark keeps as state."""
    k, v = F.col("key"), F.col("value")
    if isinstance(fold, Fold):
        grouped = fold.lifted(df, "key", "timestamp").groupBy(*keys)
        return grouped.agg(*fold.partials()).withColumn("value", fold.finished()).drop(*fold.parts)
    if callable(fold):
        return df.filter(v.isNotNull()).groupBy(*keys).agg(fold(k, v).alias("value"))
    raise TypeError("on a stream, a fold that depends on order has to be a RowFold")


def running_fold(df: DataFrame, fold: Fold) -> DataFrame:
    """Every intermediate result: one row per record with the fold of its key up to that record."""
    meta = [c for c in df.columns if c != "value"]
    scanned = S.scan(fold.lifted(df, *meta), ["key"], order_columns(df), fold.running())
    return scanned.select(*meta, fold.finished().alias("value"))


def on_time(df: DataFrame, retention) -> DataFrame:
    """Drop records older than the newest record that arrived before them minus `retention`.

    Arrival order is the offset within a partition; the clock is per partition.
    """
    ts = F.unix_micros("timestamp")
    order = [c for c in ("offset", "_pos") if c in df.columns]
    clock = S.scan(
        df.withColumn("_us", ts), ["topic", "partition"], order,
        {"_clock": S.running(F.max("_us"), F.max, lambda a, b: F.greatest(a, b))},
    )
    return clock.filter(F.col("_us") >= F.col("_clock") - interval_us(retention)).drop("_us", "_clock")


class LiveFold:
    """An `OrderedFold` of a stream, kept in a store."""

    def __init__(self, df: DataFrame, fold: folds_.OrderedFold):
        self.df, self.fold = df, fold

    def start(self, name: str, checkpoint: str, retention=DEFAULT_RETENTION, available_now: bool = True):
        """Start the query that keeps the store `name`; returns (query, store).

        Records wait until the watermark, `retention` behind, has passed them, so they are folded in order however they arrive. Each micro-batch
        folds what it releases as a tree and merges it with what the store `name`-parts holds of the key. Both stores get one part per
        micro-batch, which a replay writes again from the parts before it.
        """
        from tideway.operators.stores import Store
        from tideway.streaming.stateful import in_order

        fold, spark = self.fold, self.df.sparkSession
        rows = in_order(self.df, order_columns(self.df), retention)
        parts_of = replace(fold, finish=lambda agg: agg)
        parts, values = [], []

        def write(batch: DataFrame, batch_id: int):
            path = f"{checkpoint.rstrip('/')}-released/batch={batch_id}"
            batch.write.mode("overwrite").parquet(path)
            released = spark.read.schema(rows.schema).parquet(path)
            folded = folds_.tree(released, ["key"], parts_of, ["_n"])
            known = parts[0].before(batch_id).select("key", F.struct("value").alias("_known"))
            old, new = F.col("_known.value"), F.col("value")
            merged = folded.join(known, "key", "left").select("key", F.when(F.col("_known").isNull(), new).otherwise(fold.merge(old, new)).alias("value"))
            parts[0].upsert(merged, batch_id)
            values[0].upsert(parts[0].part(batch_id).select("key", fold.finish(F.col("value")).alias("value")), batch_id)

        empty = spark.createDataFrame([], rows.schema)
        typed = lambda f: folds_.tree(empty, ["key"], f, ["_n"]).schema
        parts.append(Store(spark, f"{name}-parts", typed(parts_of)))
        values.append(Store(spark, name, typed(fold)))
        writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer).start(), values[0]

    def to_store(self, name: str, checkpoint: str | None = None, retention=DEFAULT_RETENTION):
        """The store once all that is there now has been folded."""
        from tideway.session import fresh_path

        query, store = self.start(name, checkpoint or fresh_path(self.df.sparkSession, "checkpoint"), retention)
        query.awaitTermination()
        return store

    def snapshot(self) -> DataFrame:
        raise ValueError("an OrderedFold of a stream is kept in a store: start(name, checkpoint) or to_store(name)")


class TimeWindowed:
    """Windows of fixed length per key: tumbling, hopping (epoch-aligned) or sliding (record-aligned)."""

    def __init__(self, df, interval, kind="tumbling", advance_by=None, retention=DEFAULT_RETENTION,
                 apply_retention=False):
        if kind not in ("tumbling", "hopping", "sliding"):
            raise ValueError(f"unknown kind of window: {kind!r}")
        length = interval_ms(interval)
        step = interval_ms(advance_by) if advance_by is not None else length
        if length <= 0 or step <= 0:
            raise ValueError("windows need a positive interval")
        if kind == "hopping" and step > length:
            raise ValueError("windows must not advance by more than their interval")
        if kind != "hopping" and advance_by is not None:
            raise ValueError("only hopping windows take advance_by")
        self.retention = interval_ms(retention)
        if self.retention < length:
            # documented rule: retention cannot be below the interval
            self.retention = length
        if apply_retention and not df.isStreaming:
            df = on_time(df, self.retention)
        self.df, self.kind, self.length, self.step = df, kind, length, step

    def reduce_windows(self, fold) -> WindowTable:
        """Fold per (key, window). Result columns: key, window_from, window_to (epoch ms), value."""
        df = self.df.filter(F.col("value").isNotNull() & F.col("timestamp").isNotNull())
        if self.kind == "sliding":
            if df.isStreaming:
                from tideway.streaming.stateful import sliding_windows

                return WindowTable(sliding_windows(df, fold, self.length, retention=self.retention))
            return WindowTable(self._sliding(df, fold))
        if df.isStreaming:
            return WindowTable(self._streamed(df, fold))
        if isinstance(fold, Fold) and self.length >= PANE_RATIO * self.step and self.length % self.step == 0:
            return WindowTable(self._from_panes(df, fold))
        us = F.unix_micros("timestamp")
        length, step = self.length * 1000, self.step * 1000
        starting = lambda at: (at - F.pmod(at, F.lit(length))) if length == step else F.explode(starts(at, length, step))
        if isinstance(fold, Fold):
            lifted = fold.lifted(df, "key", us.alias("_us"))
            windowed = lifted.withColumn("_w", starting(F.col("_us"))).filter(F.col("_w") >= 0)
            folded = windowed.groupBy("key", "_w").agg(*fold.partials()).select(
                "key", "_w", fold.finished().alias("value"))
        else:
            windowed = df.withColumn("_w", starting(us)).filter(F.col("_w") >= 0)
            folded = folds_.apply(windowed, ["key", "_w"], fold, order_columns(df))
        return WindowTable(self._bounds(folded))

    def _bounds(self, df: DataFrame) -> DataFrame:
        start = F.floor(F.col("_w") / 1000).cast("bigint")
        return df.select("key", start.alias("window_from"), (start + self.length).alias("window_to"), "value")

    def _from_panes(self, df: DataFrame, fold: Fold) -> DataFrame:
        """Fold each record once into its pane, then hand the (much fewer) panes to every window over them."""
        us = F.col("_us")
        length, step = self.length * 1000, self.step * 1000
        panes = (
            fold.lifted(df, "key", F.unix_micros("timestamp").alias("_us"))
            .withColumn("_p", us - F.pmod(us, F.lit(step)))
            .groupBy("key", "_p")
            .agg(*fold.partials())
        )
        windows = (
            panes.withColumn("_w", F.explode(starts(F.col("_p"), length, step)))
            .filter(F.col("_w") >= 0)
            .groupBy("key", "_w")
            .agg(*fold.merged())
            .select("key", "_w", fold.finished().alias("value"))
        )
        return self._bounds(windows)

    def _streamed(self, df: DataFrame, fold) -> DataFrame:
        if isinstance(fold, folds_.RowFold):
            from tideway.streaming.stateful import fold_stream

            rows = df.withWatermark("timestamp", f"{self.retention} milliseconds").withColumn(
                "_w", F.explode(starts(F.unix_micros("timestamp"), self.length * 1000, self.step * 1000)))
            return self._bounds(fold_stream(rows.filter("_w >= 0"), ["key", "_w"], fold, self.length))
        window = F.window("timestamp", f"{self.length} milliseconds", f"{self.step} milliseconds")
        folded = _stream_fold(
            df.withWatermark("timestamp", f"{self.retention} milliseconds"),
            ["key", window.alias("window")], fold,
        )
        return (
            folded.select("key", epoch_ms(F.col("window.start")).alias("window_from"),
                          epoch_ms(F.col("window.end")).alias("window_to"), "value")
            .filter("window_from >= 0")
        )

    def _sliding(self, df: DataFrame, fold: Fold) -> DataFrame:
        """Window [t - I, t] for each record time t (epoch ms) of a key, both ends included.

        Time is cut into buckets of length I, so [t - I, t] is the end of one bucket and the beginning of the next:
        a running fold from the start of t's bucket, merged with a running fold from the end of the bucket before,
        looked up at t - I. Work per record does not depend on how many records share the window.
        """
        if not isinstance(fold, Fold):
            raise TypeError("sliding windows need a mergeable fold from tideway.functions.folds")
        span = self.length
        names = list(fold.parts)
        bucket = F.floor(F.col("_t") / span).cast("bigint").alias("_b")
        lifted = fold.lifted(df, "key", epoch_ms(F.col("timestamp")).alias("_t"))
        # one look at the records serves all three scans
        layout = measure(lifted.select("key", bucket, "_t"), ["key", "_b"], ["_t"]) or False
        points = lifted.groupBy("key", "_t").agg(*fold.partials()).withColumn("_b", bucket)
        merging = lambda prefix: {
            f"{prefix}{n}": S.running(p.merge(F.col(n)), p.merge, p.pair) for n, p in fold.parts.items()
        }
        forward = S.scan(points, ["key", "_b"], ["_t"], merging("_head"), layout=layout)
        both = S.scan(forward, ["key", "_b"], ["_t"], merging("_tail"), reverse=True, layout=layout)
        kind = {n: both.schema[f"_head{n}"].dataType for n in names}
        nothing = lambda prefix: [F.lit(None).cast(kind[n]).alias(f"{prefix}{n}") for n in names]
        tails = both.select("key", "_b", "_t", F.lit(1).alias("_side"),
                            *[F.col(f"_tail{n}") for n in names], *nothing("_head"))
        probes = both.select("key", (F.col("_b") - 1).alias("_b"), (F.col("_t") - span).alias("_t"),
                             F.lit(0).alias("_side"), *nothing("_tail"), *[F.col(f"_head{n}") for n in names])
        looked = S.scan(
            tails.unionByName(probes), ["key", "_b"], ["_t", "_side"],
            {"_seen": S.last_known(F.col("_side") == 1, *[F.col(f"_tail{n}").alias(n) for n in names])},
            reverse=True, layout=layout,
        ).filter("_side = 0")
        merged = looked.select(
            "key", "_t", *fold.pair(lambda n: F.col("_seen")[n], lambda n: F.col(f"_head{n}")),
        )
        return merged.select("key", F.col("_t").alias("window_from"), (F.col("_t") + span).alias("window_to"),
                             fold.finished().alias("value"))


def starts(us: Column, length: int, step: int) -> Column:
    """Starts (µs) of all windows `[s, s + length)`, `s` a multiple of `step`, that hold the time `us`."""
    last = us - F.pmod(us, F.lit(step))
    first = F.floor((us - length) / step).cast("bigint") * step + step
    return F.sequence(first, last, F.lit(step))


class SessionWindowed:
    """Sessions per key: records at most `interval` apart belong together."""

    def __init__(self, df, interval, retention=DEFAULT_RETENTION, apply_retention=False):
        self.gap = interval_ms(interval)
        self.retention = max(interval_ms(retention), self.gap)
        if apply_retention and not df.isStreaming:
            df = on_time(df, self.retention)
        self.df = df

    def reduce_sessions(self, fold, merge=None) -> WindowTable:
        """Fold per (key, session). Result columns: key, window_from, window_to (first and last record), value.

        `merge(a, b)` (or the one of a `RowFold`) joins the aggregates of sessions that a late record bridges. Only
        a stream that emits every update needs it; batch and append output fold whole sessions.
        """
        if merge is not None and isinstance(fold, folds_.RowFold):
            fold = replace(fold, merge=merge)
        df = self.df.filter(F.col("value").isNotNull() & F.col("timestamp").isNotNull())
        if df.isStreaming:
            return WindowTable(self._streamed(df, fold))
        us = F.col("_us")
        at = F.unix_micros("timestamp").alias("_us")
        order = ["_us", *[c for c in order_columns(df) if c != "timestamp"]]
        rest = [c for c in order if c != "_us"]
        if isinstance(fold, Fold):
            rows = fold.lifted(df, "key", at, *rest)
        else:
            rows = df.select("key", at, *rest, "timestamp", "value")
        scanner = S.Scanner(rows, ["key"], order)
        if isinstance(fold, Fold) and scanner.layout:
            return WindowTable(self._bounds(self._across_chunks(scanner.df, fold, order)))
        scanner.add(_prev=S.previous(us.alias("us")))
        opens = F.col("_prev").isNull() | (us - F.col("_prev.us") > self.gap * 1000)
        scanner.add(_open=S.last_known(opens, us.alias("us")))
        tagged = scanner.result().withColumn("_from", F.col("_open.us"))
        keys = ["key", "_from"]
        if isinstance(fold, Fold):
            folded = tagged.groupBy(*keys).agg(*fold.partials(), F.max("_us").alias("_to"))
            folded = folded.withColumn("value", fold.finished())
        elif isinstance(fold, (folds_.OrderedFold, folds_.RowFold)):
            ends = tagged.groupBy(*keys).agg(F.max("_us").alias("_to"))
            folded = folds_.apply(tagged, keys, fold, order).join(ends, keys)
        else:
            folded = tagged.groupBy(*keys).agg(fold(F.col("key"), F.col("value")).alias("value"), F.max("_us").alias("_to"))
        return WindowTable(self._bounds(folded))

    def _bounds(self, df: DataFrame) -> DataFrame:
        ms = lambda c: F.floor(F.col(c) / 1000).cast("bigint")
        return df.select("key", ms("_from").alias("window_from"), ms("_to").alias("window_to"), "value")

    def _across_chunks(self, chunked: DataFrame, fold: Fold, order: list[str]) -> DataFrame:
        """Sessions where hot keys are cut: fold inside each chunk, then join only what touches a cut.

        The first and last session of a chunk may go on in the next one; those, two per chunk at most, are put together
        per key. All others are complete.
        """
        us, gap = F.col("_us"), self.gap * 1000
        w = Window.partitionBy("key", "_chunk").orderBy(*order)
        so_far = w.rowsBetween(Window.unboundedPreceding, 0)
        rows = chunked.withColumns({"_prev": F.lag("_us").over(w), "_next": F.lead("_us").over(w)})
        opens = F.col("_prev").isNull() | (us - F.col("_prev") > gap)
        rows = rows.withColumn("_from", F.last(F.when(opens, us), ignorenulls=True).over(so_far))
        edge = F.col("_hot") & (F.col("_prev").isNull() | F.col("_next").isNull())
        pieces = rows.groupBy("key", "_chunk", "_from").agg(
            *fold.partials(), F.max("_us").alias("_to"), F.max(edge).alias("_edge"))
        # complete sessions are alone in their group, the edges of a key share the group null
        pieces = pieces.withColumn("_own", F.when(~F.col("_edge"), F.struct("_chunk", "_from")))
        w = Window.partitionBy("key", "_own").orderBy("_chunk", "_from")
        before = F.lag("_to").over(w)
        pieces = pieces.withColumn("_before", before)
        opens = F.col("_before").isNull() | (F.col("_from") - F.col("_before") > gap)
        pieces = pieces.withColumn("_start", F.last(F.when(opens, F.col("_from")), ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, 0)))
        merged = pieces.groupBy("key", "_own", "_start").agg(*fold.merged(), F.max("_to").alias("_to"))
        return merged.select("key", F.col("_start").alias("_from"), "_to", fold.finished().alias("value"))

    def _streamed(self, df: DataFrame, fold) -> DataFrame:
        if isinstance(fold, folds_.RowFold):
            # every update and merge at once instead of whole sessions at the end
            from tideway.streaming.stateful import updating_sessions

            return updating_sessions(df, fold, self.gap, retention=self.retention)
        session = F.session_window("timestamp", interval_sql(self.gap))
        folded = _stream_fold(
            df.withWatermark("timestamp", interval_sql(self.retention)),
            ["key", session.alias("session")], fold,
        )
        # Spark ends a session one gap after its last record
        return folded.select(
            "key", epoch_ms(F.col("session.start")).alias("window_from"),
            (epoch_ms(F.col("session.end")) - self.gap).alias("window_to"), "value",
        )


class WindowTable:
    """A table keyed by (key, window). `df` has key, window_from, window_to, value."""

    def __init__(self, df: DataFrame):
        self.df = df

    def snapshot(self) -> DataFrame:
        return self.df

    def materialize(self, name: str):
        from tideway.operators.stores import Store

        return Store.write(name, self.df)
