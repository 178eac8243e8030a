"""Tables: the latest value per key, with deletes, and their grouped form for retractable aggregation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideway.functions import scans as S
from tideway.functions.folds import Fold, RowFold
from tideway.record import order_columns


def latest_per_key(df: DataFrame, keys: list[str], order: list[str], extra: tuple[str, ...] = ()) -> DataFrame:
    """Last arrived row per key, deletes removed. Aggregates before the shuffle, so hot keys are harmless."""
    carried = [c for c in ("value", "timestamp", *extra) if c in df.columns]
    at = F.struct(*order) if len(order) > 1 else F.col(order[0])
    last = F.max_by(F.struct(*carried), at)
    latest = df.groupBy(*keys).agg(last.alias("_last"))
    return latest.select(*keys, *[F.col("_last")[c].alias(c) for c in carried]).filter(F.col("value").isNotNull())


class Table:
    """Two faces of one thing: `changelog()` (every update, null value = delete) and `snapshot()`.

    `order` names the columns that say which update of a key came last: the offset for a table read from a topic,
    since a key lives in one partition; the total record order otherwise.
    """

    def __init__(self, changes: DataFrame | Callable[[], DataFrame] | None, *, order: list[str] | None = None,
                 snapshot: DataFrame | None = None):
        self._changes, self._order, self._snapshot = changes, order, snapshot

    def changelog(self) -> DataFrame:
        if self._changes is None:
            raise ValueError("only the latest values of this table are known, not its updates")
        if callable(self._changes) and not isinstance(self._changes, DataFrame):
            self._changes = self._changes()
        return self._changes

    @property
    def order(self) -> list[str]:
        return self._order or order_columns(self.changelog())

    def snapshot(self) -> DataFrame:
        """Columns key, value (and timestamp where known); one row per key."""
        if self._snapshot is None:
            changes = self.changelog().filter(F.col("key").isNotNull())
            self._snapshot = latest_per_key(changes, ["key"], self.order)
        return self._snapshot

    def _mapped(self, f: Callable[[DataFrame], DataFrame]) -> Table:
        changes = None if self._changes is None else (lambda: f(self.changelog()))
        snapshot = self._snapshot
        if snapshot is not None:
            snapshot = f(snapshot).filter(F.col("value").isNotNull())
        return Table(changes, order=self._order, snapshot=snapshot)

    def filter_kv(self, pred) -> Table:
        """Keys whose latest value meets `pred`. An update that stops meeting it is a delete."""
        return self._mapped(
            lambda df: df.withColumn("value", F.when(pred(F.col("key"), F.col("value")), F.col("value")))
        )

    def map_values(self, f) -> Table:
        """`f(k, v)` for each value; deletes stay deletes."""
        return self._mapped(
            lambda df: df.withColumn(
                "value", F.when(F.col("value").isNotNull(), f(F.col("key"), F.col("value")))
            )
        )

    def process_values(self, processor) -> Table:
        """Each update's value replaced by what a stateful processor returns for it."""
        from tideway.operators.processors import process_values

        return Table(lambda: process_values(self.changelog(), processor), order=self._order)

    def to_stream(self, f=None):
        """The updates as a stream, optionally with a new key `f(k, v)`."""
        from tideway.operators.stream import Stream

        df = self.changelog()
        return Stream(df.withColumn("key", f(F.col("key"), F.col("value"))) if f else df)

    def map_and_group_by(self, f) -> GroupedTable:
        """Re-key for aggregation: `f(k, v)` returns the pair (new key, new value); null new keys are dropped."""
        return GroupedTable(self, f)

    def join_tables(self, other: Table, f) -> Table:
        from tideway.operators import joins

        return joins.table_table(self, other, f, "inner")

    def left_join_tables(self, other: Table, f) -> Table:
        from tideway.operators import joins

        return joins.table_table(self, other, f, "left")

    def outer_join_tables(self, other: Table, f) -> Table:
        from tideway.operators import joins

        return joins.table_table(self, other, f, "outer")

    def keep_recent(self, n: int) -> DataFrame:
        """The `n` keys updated last."""
        order = self.order
        at = F.struct(*order).alias("_at") if len(order) > 1 else F.col(order[0]).alias("_at")
        live = latest_per_key(self.changelog().withColumn("_at", at), ["key"], ["_at"], ("_at",))
        return live.orderBy(F.col("_at").desc()).limit(n).drop("_at")

    def materialize(self, name: str):
        from tideway.operators.stores import Store

        return Store.write(name, self.snapshot().select("key", "value"))


class GroupedTable:
    """A table grouped by another key. Replacing a value takes the old one out of its group."""

    def __init__(self, table: Table, f):
        def pair(k: Column, v: Column) -> Column:
            new_key, new_value = f(k, v)
            return F.struct(new_key.alias("key"), new_value.alias("value"))

        # values become (new key, new value) before anything is compared or shuffled
        self.table, self.order = table.map_values(pair), table.order

    def signed_changes(self) -> DataFrame:
        """Each update as up to two rows: sign −1 for the value it replaces, then sign +1 for the new one."""
        changes = self.table.changelog().filter(F.col("key").isNotNull())
        scanned = S.scan(changes, ["key"], self.order, {"_before": S.previous(F.col("value").alias("value"))})
        old, new = F.col("_before.value"), F.col("value")
        part = lambda sign, v: F.when(v.isNotNull(), F.struct(F.lit(sign).alias("sign"), v.alias("kv")))
        meta = [c for c in changes.columns if c not in ("key", "value")]
        return (
            scanned.select(*meta, F.explode(F.array(part(-1, old), part(1, new))).alias("_e"))
            .filter(F.col("_e.kv.key").isNotNull())
            .select(*meta, F.col("_e.sign").alias("sign"), F.col("_e.kv.key").alias("key"),
                    F.col("_e.kv.value").alias("value"))
        )

    def reduce_values(self, fold: Fold | Callable, sub: Callable | None = None, seed: Callable | None = None,
                      schema: str | None = None, merge: Callable | None = None) -> Table:
        """Aggregate that follows updates: a sum-like `Fold`, or Python `add, sub, seed[, merge]` (see `reduce_rows`). A group all of whose members left keeps its value (sum 0).

        Latest result: totals over the latest values; the groups ever seen come from a duplicate-free list of
        group keys, so the changelog never has to be sorted. `changelog()` of the result has one row per change. On a stream the snapshot
        appends the aggregate of each group that a micro-batch changed (`run.run_to_store(…, mode="append")` keeps the last one).
        """
        if not isinstance(fold, Fold):
            return self.reduce_rows(fold, sub, seed, schema, merge)
        k, v = F.col("key"), F.col("value")
        changes = self.table.changelog().filter(k.isNotNull())
        if changes.isStreaming:
            from tideway.streaming.stateful import regrouped

            return Table(None, snapshot=regrouped(changes, fold, self.order))
        parts = fold.parts
        plus = F.lit(1)
        latest = self.table.snapshot().select("value.key", "value.value")
        contributions = latest.filter(k.isNotNull()).select(
            "key", *[p.contribution(k, v, plus).alias(n) for n, p in parts.items()]
        )
        seen = (
            changes.filter(v.isNotNull()).select("value.key").filter(k.isNotNull()).distinct()
        )
        zero = seen.select("key", *[F.lit(0).cast(contributions.schema[n].dataType).alias(n) for n in parts])
        totals = contributions.unionByName(zero).groupBy("key").agg(*[F.sum(n).alias(n) for n in parts])
        return Table(lambda: self._running(fold), snapshot=totals.select("key", fold.finished().alias("value")))

    def _running(self, fold: Fold) -> DataFrame:
        signed = self.signed_changes()
        order = [*self.order, "sign"]
        k, v = F.col("key"), F.col("value")
        rows = signed.withColumns({n: p.contribution(k, v, F.col("sign")) for n, p in fold.parts.items()})
        scans = {f"_r{n}": S.running(F.sum(n), F.sum, lambda a, b: a + b) for n in fold.parts}
        scanned = S.scan(rows.drop("value"), ["key"], order, scans)
        scanned = scanned.drop(*fold.parts).withColumnsRenamed({f"_r{n}": n for n in fold.parts})
        return scanned.withColumn("value", fold.finished()).drop(*fold.parts)

    def reduce_rows(self, add, sub, seed, schema: str, merge=None, salts: int | None = None) -> Table:
        """Python `add(agg, k, v)` / `sub(agg, k, v)` for folds that are no signed sum.

        Without `merge`, a group is folded in order of the changes. With `merge(a, b)`, for aggregates that do not depend on the order of changes
        of different keys, a group is folded in `salts` pieces (default: the number of shuffle partitions), each with all changes of the keys
        it holds, and the pieces are merged: a group costs one task only `salts` partial results.
        """
        from tideway.functions import folds

        changes = self.table.changelog()
        if changes.isStreaming:
            from tideway.streaming.stateful import regrouped_rows

            return Table(None, snapshot=regrouped_rows(changes, add, sub, seed, schema, self.order))

        def step(agg, k, v):
            return (add if v["sign"] > 0 else sub)(agg, k, v["v"])

        order = [*self.order, "sign"]
        if merge is None:
            rows = self.signed_changes().withColumn("value", F.struct(F.col("sign").alias("sign"), F.col("value").alias("v")))
            return Table(None, snapshot=folds.apply(rows, ["key"], RowFold(seed, step, schema), order))
        n = salts or int(changes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salted = GroupedTable.__new__(GroupedTable)
        salt = F.pmod(F.xxhash64("key"), F.lit(n)).cast("int")
        salted.table, salted.order = Table(changes.withColumn("_salt", salt), order=self.order), self.order
        rows = salted.signed_changes().withColumn("value", F.struct(F.col("sign").alias("sign"), F.col("value").alias("v")))
        partial = folds.apply(rows, ["key", "_salt"], RowFold(seed, step, schema, merge=None), order)
        pieces = RowFold(lambda: None, lambda agg, k, v: v if agg is None else merge(agg, v), schema)
        return Table(None, snapshot=folds.apply(partial, ["key"], pieces, ["_salt"]))
