"""Streaming forms of the operators that Spark has no built-in state for, as `transformWithState` processors.

State is kept per key by Spark's RocksDB provider and follows the checkpoint. Where order in event time matters,
records wait until the watermark has passed them, so that the answer equals the batch one; how far the watermark
trails is the `retention` of the caller. State per key is what lies within that time.
"""

from __future__ import annotations

import pickle
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from datetime import timedelta
from decimal import Decimal
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tideway.functions.folds import Fold, RowFold
from tideway.operators.processors import EPOCH, MILLISECOND, RECORD_FIELDS, _apart, _type, clocks, closed, instance, opened, output_schema
from tideway.record import interval_ms, interval_us

DAY = (1, "days")


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


def _plain(value):
    """Rows as tuples: what was read from state can be written to it again only in this form."""
    if isinstance(value, tuple):
        return tuple(map(_plain, value))
    if isinstance(value, list):
        return list(map(_plain, value))
    return {k: _plain(v) for k, v in value.items()} if isinstance(value, dict) else value


SHARDS = 512  # groups of keys that share their state; the same for all runs of a query


def _sharded(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_shard", F.pmod(F.xxhash64("key"), F.lit(SHARDS)))


def _same(key):
    """A key as a value that can be looked up; equal for keys that Spark groups together."""
    if isinstance(key, dict):
        return tuple((n, _same(v)) for n, v in key.items())
    if isinstance(key, (list, tuple)):
        return tuple(map(_same, key))
    if isinstance(key, bytearray):
        return bytes(key)
    return ("nan",) if key != key else key


class _Held:
    """What a key holds, as pickled parts in list state: one call adds what a micro-batch brings, one reads all of it. A call per record costs more
    than all else that is done with the record."""

    def __init__(self, handle: StatefulProcessorHandle, name: str):
        self.state = handle.getListState(name, _struct(("part", T.BinaryType())))

    def add(self, part) -> None:
        self.state.appendValue((pickle.dumps(part, pickle.HIGHEST_PROTOCOL),))

    def parts(self) -> list:
        return [pickle.loads(x[0]) for x in self.state.get()]

    def replace(self, part) -> None:
        """Hold this alone, or nothing if it is empty."""
        if part:
            self.state.put([(pickle.dumps(part, pickle.HIGHEST_PROTOCOL),)])
        else:
            self.state.clear()


PACKED = 100_000  # records that a task sorts into packs at a time
PACK_ROWS = 10_000  # records of a pack at most
SLOTS = 8192  # groups of keys where state is not cut by time; the same for all runs of a query


def _slotted(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.withColumn("_slot", F.pmod(F.xxhash64(*keys), F.lit(SLOTS)))


def _packs(rows: DataFrame, by: list[str], timed: bool = False) -> DataFrame:
    """The records of a group as packs of pickled column lists, made by the task that reads them: a row costs a state operator in Python some dozen
    microseconds per column, a record in a pack about one. `by` are whole numbers. With `timed`, a pack has the time of its last record, so that Spark
    takes packs with any record on time."""
    names = [c for c in rows.columns if c not in by and not (timed and c == "timestamp")]
    time = [T.StructField("timestamp", T.TimestampType())] if timed else []
    schema = T.StructType([*[T.StructField(c, T.LongType()) for c in by], *time, T.StructField("_pack", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def packs(held):
        table = pa.Table.from_batches(held)
        table = table.take(pc.sort_indices(table.select(by), [(c, "ascending") for c in by]))
        groups = [table[c].to_numpy() for c in by]
        first = np.zeros(table.num_rows, dtype=bool)
        first[::PACK_ROWS] = True
        for g in groups:
            first[1:] |= g[1:] != g[:-1]
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], table.num_rows)
        lists = [table[c].to_pylist() for c in names]
        out = [pa.array(g[starts]) for g in groups]
        if timed:
            least = np.iinfo(np.int64).min
            last = np.maximum.reduceat(table["timestamp"].cast(pa.int64()).fill_null(least).to_numpy(), starts)
            out.append(pa.array(last, mask=last == least).cast(arrow.field("timestamp").type))
        out.append(pa.array([pickle.dumps([x[a:b] for x in lists], pickle.HIGHEST_PROTOCOL) for a, b in zip(starts.tolist(), ends.tolist())], pa.binary()))
        return pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(out, arrow)], schema=arrow)

    def run(batches):
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= PACKED:
                yield packs(held)
                held, n = [], 0
        if held:
            yield packs(held)

    return rows.select(*[F.col(c).cast("bigint").alias(c) if c in by else c for c in rows.columns]).mapInArrow(run, schema)


def _records(packs: Iterator[Row]) -> Iterator[tuple]:
    for pack in packs:
        yield from zip(*pickle.loads(pack["_pack"]))


OUT = _struct(("_out", T.BinaryType()))


def _sent(rows: Iterator[tuple]) -> Iterator[Row]:
    """Output records as packs, which `_opened` turns into rows."""
    rows = iter(rows)
    while chunk := list(islice(rows, PACK_ROWS)):
        yield Row(_out=pickle.dumps([list(c) for c in zip(*chunk)], pickle.HIGHEST_PROTOCOL))


def _opened(packs: DataFrame, schema: T.StructType) -> DataFrame:
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for pack in batch.column(0):
                yield pa.RecordBatch.from_pydict(dict(zip(arrow.names, pickle.loads(pack.as_py()))), schema=arrow)

    return packs.mapInArrow(run, schema)


class _Shelf:
    """What the keys of a slot hold, by `_same` key: parts of changes in list state, put together when there are several. None is what is gone."""

    MOST_PARTS = 8

    def __init__(self, handle: StatefulProcessorHandle, name: str):
        self.held, self.parts = _Held(handle, name), 0

    def read(self) -> dict:
        known: dict = {}
        parts = self.held.parts()
        self.parts = len(parts)
        for part in parts:
            known.update(part)
        return {k: v for k, v in known.items() if v is not None}

    def write(self, known: dict, changed) -> None:
        """After `read`: `known` is all there is now, `changed` the keys of it that are new, other or gone."""
        if self.parts >= self.MOST_PARTS or 2 * len(changed) >= len(known):
            if known or self.parts:
                self.held.replace(known)
        elif changed:
            self.held.add({k: known.get(k) for k in changed})


def _watermarked(df: DataFrame, retention) -> DataFrame:
    return df.withWatermark("timestamp", f"{interval_ms(retention)} milliseconds")


# -- as-of join ----------------------------------------------------------------------------------


class _AsOf(StatefulProcessor):
    """Table updates and stream records by time; records are answered once the watermark is past them. Of the updates of one moment
    the last one counts. Records of one moment are all held: after flat maps, joins and merges several have one place."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.updates, self.waiting = _Held(handle, "updates"), _Held(handle, "waiting")
        self.due = handle.getValueState("due", _struct(("ms", T.LongType())))

    def _wait(self, first: int, due) -> None:
        """One timer per key, for the first record that waits."""
        ms = first // 1000 + 1
        if due is None or ms < due[0]:
            self.due.update((ms,))
            self.handle.registerTimer(ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        updates: dict[int, tuple] = {}
        fresh: list[tuple] = []
        for row in rows:
            us = row["_us"]
            if row["_side"] == 1:
                fresh.append((us, row["_record"]))
            elif us not in updates or updates[us][0] <= row["_place"]:
                updates[us] = row["_place"], row["_update"]
        if updates:
            self.updates.add(updates)
        if fresh:
            self.waiting.add(fresh)
            self._wait(min(us for us, _ in fresh), self.due.get())
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        until = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()) * 1000
        self.due.clear()
        waiting = sorted((x for part in self.waiting.parts() for x in part), key=lambda x: x[0])
        later = bisect_left(waiting, until, key=lambda x: x[0])
        if later:
            self.waiting.replace(waiting[later:])
        if later < len(waiting):
            self._wait(waiting[later][0], None)
        updates: dict[int, tuple] = {}
        for part in self.updates.parts():
            for us, (place, update) in part.items():
                if us not in updates or updates[us][0] <= place:
                    updates[us] = place, update
        known = sorted(updates)
        for us, record in waiting[:later]:
            i = bisect_right(known, us)
            yield Row(key=key[0], _record=record, _seen=updates[known[i - 1]][1] if i else None)
        # of the updates that no record can come before any more, the last one may still answer later records
        gone = max(0, bisect_left(known, until) - 1)
        if gone:
            self.updates.replace({us: updates[us] for us in known[gone:]})


def _place(df: DataFrame):
    """The place of a record as text that sorts by topic, partition, offset and position; unknown parts sort first."""
    number = lambda c: F.lpad(F.coalesce(c.cast("string"), F.lit("")), 19, "0")
    inner = [F.array_join(F.transform("_pos", number), ",")] if "_pos" in df.columns else []
    return F.concat_ws("\u0001", F.coalesce("topic", F.lit("")), number(F.col("partition")), number(F.col("offset")), *inner)


def as_of_join(stream: DataFrame, changes: DataFrame, f, how: str, retention=DAY) -> DataFrame:
    meta = [c for c in stream.columns if c != "key"]
    record = F.struct(*meta).alias("_record")
    update = F.struct(F.col("value").alias("value")).alias("_update")
    left = stream.filter(F.col("key").isNotNull() & F.col("value").isNotNull()).select(
        "key", "timestamp", F.lit(1).alias("_side"), record)
    right = changes.filter(F.col("key").isNotNull()).select(
        "key", "timestamp", F.lit(0).alias("_side"), _place(changes).alias("_place"), update)
    rows = left.unionByName(right, allowMissingColumns=True)
    rows = _watermarked(rows, retention).withColumn("_us", F.unix_micros("timestamp"))
    record_type, update_type = left.schema["_record"].dataType, right.schema["_update"].dataType
    out = _struct(("key", left.schema["key"].dataType), ("_record", record_type), ("_seen", update_type))
    seen = rows.groupBy("key").transformWithState(_AsOf(), out, "Append", "EventTime")
    found = F.col("_seen.value")
    if how == "inner":
        seen = seen.filter(found.isNotNull())
    joined = f(F.col("_record.value"), found)
    return seen.select(*[
        F.col("key") if c == "key" else joined.alias("value") if c == "value" else F.col(f"_record.{c}").alias(c)
        for c in stream.columns
    ])


# -- event time from the record before -------------------------------------------------------------


OFFSETS = 65_536  # offsets of a partition that are sorted together


class _PreviousTime(StatefulProcessor):
    """Each record of a partition with the time of the one before it. Records that are not the first of their stretch of offsets know it already."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", _struct(("timestamp", T.TimestampType())))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if not key[2]:
            for row in rows:
                yield Row(_record=row["_record"], _previous={"timestamp": row["_before"]})
            return
        before = self.last.get()[0] if self.last.exists() else None
        for row in sorted(rows, key=lambda r: (r["offset"] is not None, r["offset"])):
            yield Row(_record=row["_record"], _previous={"timestamp": before})
            before = row["_last"]
        self.last.update((before,))


def _stretches(batches):
    """A task's records with the time before them in their stretch; the first record of one, marked so, with the last time of the stretch."""
    held = list(batches)
    if not sum(b.num_rows for b in held):
        return
    by = ["topic", "partition", "_b"]
    table = pa.Table.from_batches(held)
    del held
    table = table.take(pc.sort_indices(table.select([*by, "offset"]), [(c, "ascending") for c in (*by, "offset")], null_placement="at_start"))
    n = table.num_rows
    first = np.zeros(n, dtype=bool)
    first[0] = True
    for c in by:
        code = pc.dictionary_encode(table[c].combine_chunks(), null_encoding="encode").indices.to_numpy()
        first[1:] |= code[1:] != code[:-1]
    at, starts = np.arange(n), np.flatnonzero(first)
    ends = np.zeros(n, dtype=np.int64)
    ends[starts] = np.append(starts[1:], n) - 1
    times = table["timestamp"].combine_chunks()
    table = (table.append_column("_first", pa.array(first)).append_column("_before", times.take(pa.array(at - 1, mask=first)))
             .append_column("_last", times.take(pa.array(ends, mask=~first))))
    yield from table.to_batches(max_chunksize=10_000)


def with_previous_time(df: DataFrame) -> DataFrame:
    """Streaming records plus `_previous.timestamp`, per (topic, partition) in offset order.

    Stretches of offsets are sorted by tasks of their own; the partition's task sees one record of each at a time in order and lets the others pass.
    """
    rows = df.select("topic", "partition", "offset", "timestamp", F.struct(*df.columns).alias("_record"))
    record = rows.schema["_record"].dataType
    rows = rows.withColumn("_b", F.floor(F.col("offset") / OFFSETS).cast("bigint")).repartition("topic", "partition", "_b")
    time = T.TimestampType()
    schema = T.StructType([*rows.schema.fields, T.StructField("_first", T.BooleanType()), T.StructField("_before", time), T.StructField("_last", time)])
    rows = rows.mapInArrow(_stretches, schema).withColumn("_b", F.when(~F.col("_first"), F.col("_b")))
    out = _struct(("_record", record), ("_previous", _struct(("timestamp", time))))
    seen = rows.groupBy("topic", "partition", "_first", "_b").transformWithState(_PreviousTime(), out, "Append", "None")
    return seen.select("_record.*", "_previous")


# -- table–table join -----------------------------------------------------------------------------


class _TwoSides(StatefulProcessor):
    """The latest value of both sides; every update of either one gives a row."""

    def __init__(self, left: T.StructType, right: T.StructType):
        self.types = left, right

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sides = [handle.getValueState(n, _struct(("row", t))) for n, t in zip("lr", self.types)]

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now = [s.get()[0] if s.exists() else None for s in self.sides]
        for row in sorted(rows, key=lambda r: (r["timestamp"] or EPOCH, r["_side"], r["partition"], r["offset"])):
            side = row["_side"]
            now[side] = row["_r"] if side else row["_l"]
            yield Row(topic=row["topic"], partition=row["partition"], offset=row["offset"],
                      timestamp=row["timestamp"], key=key[0], _l=now[0], _r=now[1])
        for state, value in zip(self.sides, now):
            if value is not None:
                state.update(_plain((value,)))


def table_join(left: DataFrame, right: DataFrame, f, how: str) -> DataFrame:
    """Streaming changelog of a table–table join: one row per update, null value = delete."""
    from tideway.operators.joins import joined_or_deleted

    wrapped = lambda df, side, name: df.select(
        "topic", "partition", "offset", "timestamp", "key", F.lit(side).alias("_side"),
        F.struct(F.col("value").alias("v")).alias(name))
    l, r = wrapped(left, 0, "_l"), wrapped(right, 1, "_r")
    lt, rt = l.schema["_l"].dataType, r.schema["_r"].dataType
    rows = l.unionByName(r, allowMissingColumns=True).filter(F.col("key").isNotNull())
    out = _struct(("topic", T.StringType()), ("partition", T.IntegerType()), ("offset", T.LongType()),
                  ("timestamp", T.TimestampType()), ("key", l.schema["key"].dataType), ("_l", lt), ("_r", rt))
    both = rows.groupBy("key").transformWithState(_TwoSides(lt, rt), out, "Update", "None")
    value = joined_or_deleted(F.col("_l.v"), F.col("_r.v"), f, how)
    return both.withColumn("value", value).drop("_l", "_r")


# -- retraction -----------------------------------------------------------------------------------


def _order(df: DataFrame, order: list[str]):
    """The columns of an order as a struct without timestamps, which state and input hand over in different forms."""
    plain = lambda c: F.unix_micros(c).alias(c) if isinstance(df.schema[c].dataType, T.TimestampType) else F.col(c)
    return F.struct(*[plain(c) for c in order])


def _at(place) -> tuple:
    """The place of an update as something that sorts: nulls first."""
    values = place.values() if isinstance(place, dict) else place
    return tuple((v is not None, v) for v in values)


class _Replaced(StatefulProcessor):
    """Each update of a slot of keys together with the value it replaces. An update that comes after a later one of its key is left out: what it
    added would be taken out again at once."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = _Shelf(handle, "last")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        yield from _sent(self._pairs(_records(rows)))

    def _pairs(self, records: Iterator[tuple]) -> Iterator[tuple]:
        arrived: dict = {}
        for k, us, value, *place in records:
            arrived.setdefault(_same(k), []).append((_at(place), k, us, value))
        last = self.last.read()
        for same, updates in arrived.items():
            at, before = last.get(same, (None, None))
            for place, k, us, value in sorted(updates, key=lambda u: u[0]):
                if at is not None and place < at:
                    continue
                yield k, us, before, value
                at, before = place, value
            last[same] = at, before
        self.last.write(last, arrived)


def signed_changes(changes: DataFrame, order: list[str]) -> DataFrame:
    """Streaming updates whose values are (new key, new value), as rows (key, timestamp, sign, value): the replaced value with sign −1,
    the new one with +1. State is kept by slots of keys."""
    place = _order(changes, order)
    rows = changes.filter(F.col("key").isNotNull()).select("key", F.unix_micros("timestamp").alias("_us"), "value", place.alias("_at"))
    rows = _slotted(rows, "key").select("key", "_us", "value", *[F.col("_at")[c].alias(f"_at_{i}") for i, c in enumerate(order)], "_slot")
    value = rows.schema["value"].dataType
    out = _struct(("key", rows.schema["key"].dataType), ("_us", T.LongType()), ("_old", value), ("_new", value))
    packs = _packs(rows, ["_slot"])
    pairs = _opened(packs.groupBy("_slot").transformWithState(_Replaced(), OUT, "Append", "None"), out)
    part = lambda sign, side: F.when(F.col(side).isNotNull(), F.struct(F.lit(sign).alias("sign"), F.col(side).alias("kv")))
    signed = pairs.select(F.timestamp_micros("_us").alias("timestamp"), F.explode(F.array(part(-1, "_old"), part(1, "_new"))).alias("e"))
    signed = signed.filter(F.col("e.kv.key").isNotNull())
    return signed.select(F.col("e.kv.key").alias("key"), "timestamp", F.col("e.sign").alias("sign"), F.col("e.kv.value").alias("value"))


def _contributions(signed: DataFrame, fold: Fold) -> DataFrame:
    k, v, sign = F.col("key"), F.col("value"), F.col("sign")
    return signed.select("key", "timestamp", *[p.contribution(k, v, sign).alias(n) for n, p in fold.parts.items()])


def regrouped_changes(changes: DataFrame, f, fold: Fold, order: list[str]) -> DataFrame:
    """Signed contributions per new key, to be summed by `regrouped_totals`.

    The contributions of a batch can be appended anywhere; their sums are the aggregate, whatever the order.
    """
    k, v = F.col("key"), F.col("value")
    new_key, new_value = f(k, v)
    pairs = changes.withColumn("value", F.when(v.isNotNull(), F.struct(new_key.alias("key"), new_value.alias("value"))))
    return _contributions(signed_changes(pairs, order), fold)


def regrouped_totals(contributions: DataFrame, fold: Fold) -> DataFrame:
    return contributions.groupBy("key").agg(*[F.sum(n).alias(n) for n in fold.parts]).select(
        "key", fold.finished().alias("value"))


PLAIN_KEYS = (T.StringType, T.BinaryType, T.BooleanType, T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType)
SUMS_HELD = 100_000


def _summed_before_the_shuffle(rows: DataFrame, names: list[str]) -> DataFrame:
    """Sums of `names` per key within each task, so that a group costs one row per task and not one per change."""
    if not isinstance(rows.schema["key"].dataType, PLAIN_KEYS):
        return rows
    schema = to_arrow_schema(rows.schema)

    def summed(tables):
        sums = pa.concat_tables(tables).group_by("key", use_threads=False).aggregate([(n, "sum") for n in names])
        return sums.rename_columns([c.removesuffix("_sum") for c in sums.column_names]).select(schema.names).cast(schema)

    def run(batches):
        held = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_batches([batch]).cast(schema))
            if sum(t.num_rows for t in held) > SUMS_HELD:
                held = [summed(held)]
                if held[0].num_rows > SUMS_HELD // 2:
                    yield from held.pop().to_batches()
        if held:
            yield from summed(held).to_batches()

    return rows.mapInArrow(run, rows.schema)


class _Totals(StatefulProcessor):
    """The sums of a group; every micro-batch that changes it emits them once."""

    def __init__(self, sums: T.StructType):
        self.sums = sums
        zero = lambda t: Decimal(0) if isinstance(t, T.DecimalType) else 0.0 if isinstance(t, T.FractionalType) else 0
        self.zeros = [zero(f.dataType) for f in sums]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("sums", self.sums)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        names = self.sums.names
        now = list(self.state.get()) if self.state.exists() else list(self.zeros)
        for row in rows:
            for i, n in enumerate(names):
                if row[n] is not None:
                    now[i] += row[n]
        self.state.update(tuple(now))
        yield Row(key=key[0], **dict(zip(names, now)))


def regrouped(changes: DataFrame, fold: Fold, order: list[str]) -> DataFrame:
    """A regrouped table on a stream: the aggregate (key, value) of every group that a micro-batch changed.

    Two chained state operators: the first one knows the last value per key and takes it back when it is replaced, the second one keeps
    the sums of each group. In between, changes are summed within their task. Both append; of a group, the row of the last micro-batch counts.
    """
    names = list(fold.parts)
    rows = _contributions(signed_changes(changes, order), fold).select("key", *names)
    wide = rows.groupBy("key").agg(*[F.sum(n).alias(n) for n in names]).schema
    rows = rows.select("key", *[F.col(n).cast(wide[n].dataType).alias(n) for n in names])
    rows = _summed_before_the_shuffle(rows, names)
    out = T.StructType([T.StructField("key", wide["key"].dataType), *[T.StructField(n, wide[n].dataType) for n in names]])
    totals = rows.groupBy("key").transformWithState(_Totals(T.StructType(out.fields[1:])), out, "Append", "None")
    return totals.select("key", fold.finished().alias("value"))


class _SignedFold(StatefulProcessor):
    """The aggregates of a slot of groups under Python `add` and `sub`."""

    def __init__(self, add, sub, seed):
        self.add, self.sub, self.seed = add, sub, seed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.aggs = _Shelf(handle, "aggs")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        aggs, changed = self.aggs.read(), {}
        add, sub = self.add, self.sub
        for k, sign, value in _records(rows):
            same = _same(k)
            if same not in changed:
                changed[same] = aggs[same] if same in aggs else (k, self.seed())
            changed[same] = k, (add if sign > 0 else sub)(changed[same][1], k, value)
        aggs.update(changed)
        self.aggs.write(aggs, changed)
        yield from _sent(changed.values())


def regrouped_rows(changes: DataFrame, add, sub, seed, schema: str, order: list[str]) -> DataFrame:
    """The same with Python functions, which are called in undefined order."""
    rows = _slotted(signed_changes(changes, order).select("key", "sign", "value"), "key")
    out = _struct(("key", rows.schema["key"].dataType), ("value", _type(schema)))
    return _opened(_packs(rows, ["_slot"]).groupBy("_slot").transformWithState(_SignedFold(add, sub, seed), OUT, "Append", "None"), out)


# -- stream–stream join, eager ----------------------------------------------------------------------


class _Eager(StatefulProcessor):
    """The records of both sides that lie in one time bucket of a shard of keys (at home) or within reach of it (guests). On arrival a record is
    paired with what is there of the other side of its key; with nothing there, a home record of a side in `alone` is sent by itself.

    A pair belongs to the bucket of its left record. The state of a bucket goes at once when no record can reach it any more.
    """

    def __init__(self, reach_us: int, width_us: int, alone: tuple[bool, bool]):
        self.reach, self.width, self.alone = reach_us, width_us, alone

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sides = [_Held(handle, n) for n in "lr"]

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        arrived: dict = {}
        for row in rows:
            arrived.setdefault(_same(row["key"]), []).append(row)
        known: tuple[dict, dict] = {}, {}
        for side, state in zip(known, self.sides):
            for part in state.parts():
                for k, items in part.items():
                    if k in arrived:
                        side.setdefault(k, []).extend(items)
        fresh: tuple[dict, dict] = {}, {}
        for k, mine_rows in arrived.items():
            held = [sorted(side.get(k, ()), key=lambda x: x[0]) for side in known]
            times = [[x[0] for x in h] for h in held]
            for row in sorted(mine_rows, key=lambda r: (r["_us"], r["_side"], r["_place"])):
                side, us, home = row["_side"], row["_us"], row["_home"]
                mine = row["_r"] if side else row["_l"]
                there = times[1 - side]
                near = held[1 - side][bisect_left(there, us - self.reach):bisect_right(there, us + self.reach)]
                if home and not near and self.alone[side]:
                    yield Row(key=row["key"], l=None if side else mine, r=mine if side else None)
                for _, other_home, other in near:
                    if other_home if side else home:
                        yield Row(key=row["key"], l=other if side else mine, r=mine if side else other)
                i = bisect_right(times[side], us)
                times[side].insert(i, us)
                held[side].insert(i, (us, home, mine))
                fresh[side].setdefault(k, []).append((us, home, mine))
        for state, items in zip(self.sides, fresh):
            if items:
                state.add(items)
        self.handle.registerTimer(((key[1] + 1) * self.width + self.reach) // 1000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        for side in self.sides:
            side.replace(None)
        return iter(())


def eager_join(left: DataFrame, right: DataFrame, f, interval, how: str, retention=DAY) -> DataFrame:
    """Streaming join that emits pairs as they meet and, for the sides that `how` keeps, (v, null) or (null, v) for records without a
    partner so far. At equal times the left record counts as the earlier one.

    The state is kept by (shard of keys, time bucket): a hot key spreads over its buckets, and rare keys share the calls that a bucket costs.
    """
    from tideway.operators.joins import BUCKET_SPAN, _joined_record

    reach = interval_us(interval)
    width = max(reach, 1) * BUCKET_SPAN
    us, bucket = F.col("_us"), lambda c: F.floor(c / width).cast("bigint")

    def wrapped(df, side, name):
        rows = df.filter(F.col("key").isNotNull() & F.col("value").isNotNull()).select(
            "key", "timestamp", F.unix_micros("timestamp").alias("_us"), F.lit(side).alias("_side"), _place(df).alias("_place"),
            F.struct(*[c for c in df.columns if c != "key"]).alias(name))
        rows = rows.withColumn("_b", F.explode(F.sequence(bucket(us - reach), bucket(us + reach))))
        return rows.withColumn("_home", F.col("_b") == bucket(us))

    l, r = wrapped(left, 0, "_l"), wrapped(right, 1, "_r")
    rows = _watermarked(l.unionByName(r, allowMissingColumns=True), retention)
    lt, rt = l.schema["_l"].dataType, r.schema["_r"].dataType
    out = _struct(("key", l.schema["key"].dataType), ("l", lt), ("r", rt))
    alone = how in ("left", "outer"), how == "outer"
    pairs = _sharded(rows).groupBy("_shard", "_b").transformWithState(_Eager(reach, width, alone), out, "Append", "EventTime")
    pairs = pairs.withColumns({f"{side}_us": F.unix_micros(F.col(side)["timestamp"]) for side in "lr"})
    return _joined_record(pairs, f, left.columns, right.columns)


def eager_left_join(left: DataFrame, right: DataFrame, f, interval, retention=DAY) -> DataFrame:
    return eager_join(left, right, f, interval, "left", retention)


# -- sessions that update, sliding windows ------------------------------------------------------------


class _Sessions(StatefulProcessor):
    """Sessions of a slot of keys as (from, to, aggregate); a record extends, opens or bridges sessions at once."""

    def __init__(self, fold, gap_us: int, keep_ms: int):
        self.fold, self.gap, self.keep = fold, gap_us, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = _Shelf(handle, "open")
        self.due = handle.getValueState("due", _struct(("ms", T.LongType())))

    def _wait(self, ends: Iterator[int], due) -> None:
        """One timer per slot, for the session that ends first."""
        ms = min((to // 1000 + self.keep for to in ends), default=None)
        if ms is not None and (due is None or ms < due[0]):
            self.due.update((ms,))
            self.handle.registerTimer(ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        yield from _sent(self._updates(_records(rows)))

    def _updates(self, records: Iterator[tuple]) -> Iterator[tuple]:
        fold, arrived = self.fold, {}
        for k, us, value in records:
            arrived.setdefault(_same(k), (k, []))[1].append((us, value))
        held = self.open.read()
        ends: list[int] = []
        for same, (k, items) in arrived.items():
            before = held[same][1] if same in held else {}
            sessions, changed = dict(before), {}
            starts = sorted(sessions)
            for us, value in sorted(items, key=lambda x: x[0]):
                start, end, agg = us, us, fold.step(fold.seed(), k, value)
                i = bisect_right(starts, us + self.gap)  # sessions don't overlap: those near are neighbours
                first = i
                while first and sessions[starts[first - 1]][0] + self.gap >= us:
                    first -= 1
                merged = None
                for s in starts[first:i]:
                    to, other = sessions.pop(s)
                    merged = other if merged is None else fold.merge(merged, other)
                    start, end = min(start, s), max(end, to)
                    changed.pop(s, None)
                if merged is not None:
                    agg = fold.merge(merged, agg)
                starts[first:i] = [start]
                sessions[start] = changed[start] = (end, agg)
            for s in before.keys() - sessions.keys():
                yield k, s // 1000, before[s][0] // 1000, None
            for s, (to, agg) in changed.items():
                if s in before and before[s][0] != to:
                    yield k, s // 1000, before[s][0] // 1000, None
                ends.append(to)
                yield k, s // 1000, to // 1000, agg
            held[same] = k, sessions
        self.open.write(held, arrived)
        self._wait(ends, self.due.get())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        due = self.due.get()
        if due is None or due[0] > expiredTimerInfo.getExpiryTimeInMs():
            return iter(())  # a timer that was replaced
        until = (max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()) - self.keep) * 1000
        held, changed = self.open.read(), []
        for same, (k, sessions) in list(held.items()):
            rest = {s: x for s, x in sessions.items() if x[0] // 1000 * 1000 > until}
            if len(rest) < len(sessions):
                changed.append(same)
                if rest:
                    held[same] = k, rest
                else:
                    del held[same]
        self.open.write(held, changed)
        self.due.clear()
        self._wait((to for _, sessions in held.values() for to, _ in sessions.values()), None)
        return iter(())


def updating_sessions(df: DataFrame, fold: RowFold, interval, retention=DAY) -> DataFrame:
    """Sessions on a stream with every update: a session that grew or was merged is deleted under its old bounds
    (null value) and emitted under its new ones. Needs a Python fold with `merge`."""
    if fold.merge is None:
        raise ValueError("sessions need merge(a, b): a late record may bridge two of them")
    rows = df.filter(F.col("key").isNotNull() & F.col("value").isNotNull() & F.col("timestamp").isNotNull())
    rows = _slotted(rows.select("key", F.unix_micros("timestamp").alias("_us"), "value", "timestamp"), "key")
    out = _struct(("key", df.schema["key"].dataType), ("window_from", T.LongType()), ("window_to", T.LongType()),
                  ("value", _type(fold.schema)))
    gap = interval_ms(interval)
    packs = _watermarked(_packs(rows, ["_slot"], timed=True), retention)
    return _opened(packs.groupBy("_slot").transformWithState(_Sessions(fold, gap * 1000, gap + 1), OUT, "Update", "EventTime"), out)


class TwoStacks:
    """The aggregate of a sliding stretch of points in order: each point is merged twice at most, however long the stretch is.

    `front` holds, for the older points, the aggregate from there to the end of the front, newest last to leave at the bottom; `back`
    the newer points, of which `sum` is the aggregate.
    """

    def __init__(self, merge):
        self.merge, self.front, self.back, self.sum = merge, [], [], None

    def push(self, at: int, agg) -> None:
        self.sum = agg if not self.back else self.merge(self.sum, agg)
        self.back.append((at, agg))

    def evict(self, before: int) -> None:
        """Drop points earlier than `before`."""
        while self.front or self.back:
            if not self.front:
                if self.back[0][0] >= before:
                    return
                total = None
                for at, agg in reversed(self.back):
                    total = agg if total is None else self.merge(agg, total)
                    self.front.append((at, total))
                self.back, self.sum = [], None
            if self.front[-1][0] >= before:
                return
            self.front.pop()

    def value(self):
        if not self.front:
            return self.sum
        return self.merge(self.front[-1][1], self.sum) if self.back else self.front[-1][1]


SLIDING_SPAN = 16  # length of a time bucket in windows


class _Sliding(StatefulProcessor):
    """Aggregates of the moments of a shard of keys in one time bucket within the last interval. When the watermark has passed moments, one pass over
    what is held answers them all; a bucket has one timer at a time. Records of the bucket before that its windows reach are held as well."""

    def __init__(self, value: Callable, step: Callable, merge: Callable, span_ms: int, width_ms: int):
        self.value, self.step, self.merge, self.span, self.width = value, step, merge, span_ms, width_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.points = _Held(handle, "points")
        self.done = handle.getValueState("done", _struct(("until", T.LongType()), ("due", T.LongType())))

    def _timer(self, until, due, first: int) -> None:
        if due is None or first + 1 < due:
            due = first + 1
            self.handle.registerTimer(due)
            self.done.update((until, due))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        until, due = self.done.get() or (None, None)
        fresh: dict = {}  # by key: the key itself and its aggregates by moment
        first = None
        for k, ms, *lifted in _records(rows):
            if until is not None and ms < until:
                continue  # later than the watermark: its moment is answered
            first = ms if first is None else min(ms, first)
            _, points = fresh.setdefault(_same(k), (k, {}))
            points[ms] = self.step(points.get(ms), k, self.value(lifted))
        if fresh:
            self.points.add(fresh)
            self._timer(until, due, first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        until = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        state = self.done.get()
        if state is None or (state[0] is not None and until <= state[0]):
            return  # the bucket is closed, or an earlier timer has answered what is due
        yield from _sent(self._answers(key[1] * self.width, until, state[0]))

    def _answers(self, home: int, until: int, before: int | None) -> Iterator[tuple]:
        held: dict = {}
        for part in self.points.parts():
            for same, (k, points) in part.items():
                _, known = held.setdefault(same, (k, {}))
                for ms, agg in points.items():
                    known[ms] = self.merge(known[ms], agg) if ms in known else agg
        if until >= home + self.width:
            self.points.replace(None)  # no later window of the bucket
            self.done.clear()
        else:  # before the pass, in which a merge may change what it is given
            rest = {same: (k, {ms: agg for ms, agg in points.items() if ms >= until - self.span}) for same, (k, points) in held.items()}
            self.points.replace({same: x for same, x in rest.items() if x[1]})
            # with nothing that waits, the end of the bucket
            self._timer(until, None, min((ms for _, points in held.values() for ms in points if ms >= until), default=home + self.width - 1))
        for k, points in held.values():
            window = TwoStacks(self.merge)
            for ms in sorted(points):
                if ms >= until:
                    break
                window.push(ms, points[ms])
                window.evict(ms - self.span)
                if ms >= home and (before is None or ms >= before):
                    yield k, ms - self.span, ms, window.value()


def _sliding_buckets(rows: DataFrame, span_ms: int) -> tuple[DataFrame, int]:
    """Each record in the time buckets whose windows hold it, two at most, so that a hot key spreads over its buckets."""
    width = max(span_ms, 1) * SLIDING_SPAN
    bucket = lambda c: F.floor(c / width).cast("bigint")
    return rows.withColumn("_b", F.explode(F.sequence(bucket(F.col("_ms")), bucket(F.col("_ms") + span_ms)))), width


class _SlidingRows(StatefulProcessor):
    """The same for a Python fold without `merge`: the values of each window are folded anew."""

    def __init__(self, fold, value: T.DataType, span_ms: int):
        self.fold, self.value, self.span = fold, value, span_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getMapState("rows", _struct(("ms", T.LongType())),
                                       _struct(("items", T.ArrayType(self.value)), ("done", T.BooleanType())))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        fresh: dict[int, list] = {}
        for row in rows:
            fresh.setdefault(row["_ms"], []).append(row["value"])
        for ms, values in fresh.items():
            old = list(self.rows.getValue((ms,))[0]) if self.rows.containsKey((ms,)) else []
            self.rows.updateValue((ms,), _plain((old + values, False)))
            self.handle.registerTimer(ms + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        until = expiredTimerInfo.getExpiryTimeInMs()
        held = sorted((k[0], list(v[0]), v[1]) for k, v in self.rows.iterator())
        for ms, items, done in held:
            if ms < until and not done:
                agg = self.fold.seed()
                for t, values, _ in held:
                    if ms - self.span <= t <= ms:
                        for v in values:
                            agg = self.fold.step(agg, key[0], v)
                yield Row(key=key[0], window_from=ms - self.span, window_to=ms, value=agg)
                self.rows.updateValue((ms,), _plain((items, True)))
            elif ms < until - self.span - 1:
                self.rows.removeKey((ms,))


def _smaller(a, b):
    """As Spark orders: NaN is the largest number."""
    return b if a != a else a if b != b else min(a, b)


def _larger(a, b):
    return a if a != a else b if b != b else max(a, b)


COMBINE = {"sum": lambda a, b: a + b, "count": lambda a, b: a + b, "min": _smaller, "max": _larger}


def _slid(rows: DataFrame, value: Callable, step: Callable, merge: Callable, span_ms: int, out: T.StructType, retention) -> DataFrame:
    """Sliding windows over rows (key, _ms, timestamp, what `value` takes …)."""
    rows, width = _sliding_buckets(rows, span_ms)
    packs = _watermarked(_packs(_sharded(rows), ["_shard", "_b"], timed=True), retention)
    return _opened(packs.groupBy("_shard", "_b").transformWithState(_Sliding(value, step, merge, span_ms, width), OUT, "Append", "EventTime"), out)


def _sliding_fold(df: DataFrame, fold: Fold, span_ms: int, retention) -> DataFrame:
    """A `Fold` in sliding windows: Columns give each record's contributions and finish the result, the state merges partial ones."""
    rows = fold.lifted(df, "key", "timestamp").withColumn("_ms", F.unix_millis("timestamp"))
    names, kinds = list(fold.parts), [p.kind for p in fold.parts.values()]
    typed = rows.groupBy("key").agg(*fold.partials()).schema
    agg = T.StructType([T.StructField(n, typed[n].dataType) for n in names])
    rows = rows.select("key", "_ms", "timestamp", *[F.col(f"_in_{n}") if k == "count" else F.col(f"_in_{n}").cast(typed[n].dataType).alias(f"_in_{n}")
                                                    for n, k in zip(names, kinds)])

    def value(lifted):
        return tuple(int(x is not None) if k == "count" else x for x, k in zip(lifted, kinds))

    def merge(a, b):
        return tuple(y if x is None else x if y is None else COMBINE[k](x, y) for x, y, k in zip(a, b, kinds))

    step = lambda held, k, v: v if held is None else merge(held, v)
    out = _struct(("key", typed["key"].dataType), ("window_from", T.LongType()), ("window_to", T.LongType()), ("agg", agg))
    windows = _slid(rows, value, step, merge, span_ms, out, retention)
    return windows.select("key", "window_from", "window_to", "agg.*").select("key", "window_from", "window_to", fold.finished().alias("value"))


def sliding_windows(df: DataFrame, fold: Fold | RowFold, interval, retention=DAY) -> DataFrame:
    """Record-aligned windows [t − I, t] on a stream, emitted when the watermark passes t. Folds that merge (every `Fold`, a `RowFold` with
    `merge`) take time linear in the records."""
    span = interval_ms(interval)
    df = df.filter(F.col("key").isNotNull() & F.col("value").isNotNull())
    if isinstance(fold, Fold):
        return _sliding_fold(df, fold, span, retention)
    rows = df.select("key", F.unix_millis("timestamp").alias("_ms"), "timestamp", "value")
    kind = _type(fold.schema)
    out = lambda name, t: _struct(("key", df.schema["key"].dataType), ("window_from", T.LongType()), ("window_to", T.LongType()), (name, t))
    if fold.merge is None:
        return _watermarked(rows, retention).groupBy("key").transformWithState(
            _SlidingRows(fold, df.schema["value"].dataType, span), out("value", kind), "Append", "EventTime")
    seed, one, many = fold.seed, fold.step, fold.merge
    step = lambda held, k, v: (one(seed() if held is None else held[0], k, v),)
    merge = lambda a, b: (many(a[0], b[0]),)
    agg = _struct(("value", kind))
    windows = _slid(rows, lambda lifted: lifted[0], step, merge, span, out("agg", agg), retention)
    return windows.select("key", "window_from", "window_to", "agg.value")


# -- ordered folds ----------------------------------------------------------------------------------


class _Folding(StatefulProcessor):
    """The aggregate of a key (or of its window); every micro-batch that adds to it emits it once."""

    def __init__(self, fold, agg: T.DataType, keys: list[str], keep_ms: int | None):
        self.fold, self.agg, self.keys, self.keep = fold, agg, keys, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("agg", _struct(("agg", self.agg)))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        agg = self.state.get()[0] if self.state.exists() else self.fold.seed()
        for row in sorted(rows, key=lambda r: (r["timestamp"] or EPOCH, r["topic"], r["partition"], r["offset"])):
            agg = self.fold.step(agg, row["key"], row["value"])
        self.state.update(_plain((agg,)))
        if self.keep is not None:
            self.handle.registerTimer(key[1] // 1000 + self.keep)
        yield Row(**dict(zip(self.keys, key)), value=agg)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.state.clear()
        return iter(())


def fold_stream(df: DataFrame, keys: list[str], fold: RowFold, length_ms: int | None = None) -> DataFrame:
    """Ordered Python fold on a stream. Windows (`keys` = key and window start) are forgotten when the watermark is past
    them; records of one micro-batch are folded in time order."""
    rows = df.filter(F.col("value").isNotNull())
    out = T.StructType([rows.schema[k] for k in keys] + [T.StructField("value", _type(fold.schema))])
    windowed = length_ms is not None
    return rows.groupBy(*keys).transformWithState(
        _Folding(fold, _type(fold.schema), keys, length_ms), out, "Update", "EventTime" if windowed else "None")


class _Reorder(StatefulProcessor):
    """Holds the records of a key; those of the time buckets that the watermark has passed are sent on in order, numbered on. A key has one timer, for
    its first bucket."""

    def __init__(self, width_ms: int):
        self.width = width_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = _Held(handle, "held")
        self.sent = handle.getValueState("sent", _struct(("n", T.LongType()), ("until", T.LongType()), ("due", T.LongType())))

    def _wait(self, n: int, until, due, first) -> None:
        if first is not None and (due is None or (first + 1) * self.width < due):
            due = (first + 1) * self.width
            self.handle.registerTimer(due)
        self.sent.update((n, until, due))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        n, until, due = self.sent.get() or (0, None, None)
        fresh: list[tuple] = []
        for row in rows:
            b = row["_ms"] // self.width
            if until is None or b >= until:  # else later than the watermark
                record = row["_record"]
                fresh.append((b, _at(record["at"]), record["value"]))
        if fresh:
            self.held.add(fresh)
            self._wait(n, until, due, min(x[0] for x in fresh))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        n, _, _ = self.sent.get() or (0, None, None)
        until = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()) // self.width
        waiting = sorted((x for part in self.held.parts() for x in part), key=lambda x: x[:2])
        due = bisect_left(waiting, until, key=lambda x: x[0])
        if due:
            self.held.replace(waiting[due:])
        self._wait(n + due, until, None, waiting[due][0] if due < len(waiting) else None)
        for i, (_, _, value) in enumerate(waiting[:due]):
            yield Row(key=key[0], _n=n + i + 1, _value=value)


def in_order(df: DataFrame, order: list[str], retention=DAY) -> DataFrame:
    """Records of a stream as (key, value, _n), each key's in the order of `order` (which begins with the time) and numbered from 1. Records wait
    until the watermark has passed them; later ones are dropped."""
    # narrow enough that little waits for the rest of its bucket, wide enough that a bucket is more than a record
    width = min(60_000, max(1, interval_ms(retention) // 64))
    known = F.col("key").isNotNull() & F.col("value").isNotNull() & F.col("timestamp").isNotNull()
    record = F.struct(_order(df, order).alias("at"), F.struct("value").alias("value")).alias("_record")
    rows = _watermarked(df.filter(known), retention).select("key", "timestamp", F.unix_millis("timestamp").alias("_ms"), record)
    kind = rows.schema["_record"].dataType
    out = _struct(("key", rows.schema["key"].dataType), ("_n", T.LongType()), ("_value", kind["value"].dataType))
    sent = rows.groupBy("key").transformWithState(_Reorder(width), out, "Append", "EventTime")
    return sent.select("key", F.col("_value.value").alias("value"), "_n")


# -- processors -------------------------------------------------------------------------------------


PLAIN_VALUES = {T.LongType: int, T.DoubleType: float, T.StringType: str, T.BooleanType: bool}


class _MapStore:
    """A processor's store on Spark state, with the methods of the batch one. Plain values that a call of the processor for a key reads are read once,
    and those that it changes are written once, by `flush`; others are read and written each time, as they come back in another form."""

    def __init__(self, state, key: T.DataType | None = None, value: T.DataType | None = None):
        self.state, self.seen, self.changed = state, {}, set()
        self.kinds = PLAIN_VALUES.get(type(key)), PLAIN_VALUES.get(type(value))

    def _plain(self, k, v) -> bool:
        return type(k) is self.kinds[0] and (v is None or type(v) is self.kinds[1])

    def get(self, k):
        if self._plain(k, None) and k in self.seen:
            return self.seen[k]
        held = self.state.getValue((k,)) if self.state.containsKey((k,)) else None
        v = None if held is None else held[0]
        if self.kinds[1] and self._plain(k, v):
            self.seen[k] = v
        return v

    def put(self, k, v):
        if v is None:
            self.remove(k)
        elif self._plain(k, v):
            self.seen[k] = v
            self.changed.add(k)
        else:
            if self._plain(k, None):
                self.seen.pop(k, None)
                self.changed.discard(k)
            self.state.updateValue((k,), _plain((v,)))

    def flush(self) -> None:
        for k in self.changed:
            self.state.updateValue((k,), (self.seen[k],))
        self.changed.clear()

    def forget(self) -> None:
        """After `flush`, before another key."""
        self.flush()
        self.seen.clear()

    def offer(self, k, v):
        old = self.get(k)
        if old is None:
            self.put(k, v)
        return old

    def remove(self, k):
        old = self.get(k)
        if old is not None:
            self.flush()
            self.state.removeKey((k,))
            if self._plain(k, None):
                self.seen.pop(k, None)
        return old

    def range(self, low=None, high=None):
        self.flush()
        for k, v in sorted((k[0], v[0]) for k, v in self.state.iterator()):
            if (low is None or k >= low) and (high is None or k <= high):
                yield k, v

    def count(self):
        self.flush()
        return sum(1 for _ in self.state.keys())


def _as_dicts(value, kind: T.DataType):
    """Structs given as rows or tuples as dicts, and maps as lists of pairs, which Arrow takes."""
    if value is None:
        return None
    if isinstance(kind, T.StructType):
        named = value if isinstance(value, dict) else dict(zip(kind.names, value))
        return {f.name: _as_dicts(named.get(f.name), f.dataType) for f in kind}
    if isinstance(kind, T.ArrayType):
        return [_as_dicts(x, kind.elementType) for x in value]
    if isinstance(kind, T.MapType):
        pairs = value.items() if isinstance(value, dict) else value
        return [(_as_dicts(k, kind.keyType), _as_dicts(v, kind.valueType)) for k, v in pairs]
    return value


def _with_maps(value, kind: T.DataType):
    """Maps as dicts, where Arrow gives lists of pairs."""
    if value is None:
        return None
    if isinstance(kind, T.StructType):
        return {f.name: _with_maps(value[f.name], f.dataType) for f in kind}
    if isinstance(kind, T.ArrayType):
        return [_with_maps(x, kind.elementType) for x in value]
    if isinstance(kind, T.MapType):
        return {_same(k): _with_maps(v, kind.valueType) for k, v in value}
    return value


NESTED = T.StructType, T.ArrayType, T.MapType


class _UserProcessor(StatefulProcessor):
    """Runs a processor on a stream, for the keys of a slot. Stores, timers, stream time and what `init` returned are durable; a key has them as one
    pickled piece, which is opened for the keys that have records or whose timers are due.

    In event time, stream-time timers fire when the watermark passes them, also for keys without further records. In the other modes the stream
    time of a key is that of its records, and a timer fires before the record that passes it, as on a batch; in processing time there are
    wall-clock timers beside them. A slot has one timer, for the key that is due first.
    """

    def __init__(self, processor, fields: T.StructType, out: T.StructType, values_only: bool, mode: str):
        self.processor, self.values_only, self.mode = processor, values_only, mode
        self.names = fields.names
        self.maps = [(i, f.dataType) for i, f in enumerate(fields) if "map<" in f.dataType.simpleString()]
        self.nested = [(i, f.dataType) for i, f in enumerate(out) if isinstance(f.dataType, NESTED)]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.made = instance(self.processor)
        self.keys = _Shelf(handle, "keys")
        if self.mode != "None":
            self.clock = handle.getValueState("clock", _struct(("seen", T.LongType()), ("due", T.LongType())))

    def _kept(self, ctx, user, wall_ms: int | None) -> tuple:
        """When the key is due, and what it holds."""
        first = None
        for timer in ctx._timers:
            by_wall = timer["kind"] == "wall-clock-time"
            if by_wall and self.mode != "ProcessingTime":
                raise ValueError("timers by wall clock need processing time: schedule them in init, name them in `clocks`, or ask for time_mode=\"ProcessingTime\"")
            if not (by_wall or self.mode == "EventTime"):
                continue
            now = wall_ms if by_wall else ctx.now_ms
            if timer["due"] is None and timer["live"] and now is not None:
                timer["due"] = now + timer["every"]
            if timer["live"] and timer["due"] is not None:
                first = timer["due"] if first is None else min(first, timer["due"])
        return first, pickle.dumps(closed(ctx, user), pickle.HIGHEST_PROTOCOL)

    def _wait(self, seen: int | None, due: int | None, held: dict, keys) -> None:
        """One timer for the slot; `due` is the one it has."""
        first = min((held[k][0] for k in keys if held[k][0] is not None), default=None)
        if first is not None and (due is None or first < due):
            due = first
            self.handle.registerTimer(due)
        self.clock.update((seen, due))

    def _out(self, rows: Iterator[tuple]) -> Iterator[Row]:
        if self.nested:
            rows = map(self._arrow, rows)
        return _sent(rows)

    def _arrow(self, row: tuple) -> list:
        row = list(row)
        for i, kind in self.nested:
            row[i] = _as_dicts(row[i], kind)
        return row

    def _emitted(self, ctx) -> Iterator[tuple]:
        for i, (k, v, ts, child) in enumerate(ctx.out):
            yield ctx.topic, ctx.partition, ctx.offset, ts, k, v, child, [i]
        ctx.out.clear()

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        yield from self._out(self._processed(_records(rows), timerValues))

    def _processed(self, records: Iterator[tuple], timerValues) -> Iterator[tuple]:
        event_time = self.mode == "EventTime"
        seen, due = (self.clock.get() or (None, None)) if self.mode != "None" else (None, None)
        arrived: dict = {}
        for by, part, us, *values in records:
            if not (event_time and seen and us is not None and us <= seen * 1000):  # else timers have passed it
                arrived.setdefault(_same((by, part)), []).append((us, values))
        wall = timerValues.getCurrentProcessingTimeInMs() if self.mode == "ProcessingTime" else None
        held = self.keys.read()
        topic, partition, offset, stamp = (self.names.index(c) for c in ("topic", "partition", "offset", "timestamp"))
        told = [(i, c) for i, c in enumerate(self.names) if c in RECORD_FIELDS]
        headers = self.names.index("headers") if "headers" in self.names else None
        value = self.names.index("value")
        for same, items in arrived.items():
            ctx, user = opened(self.made, pickle.loads(held[same][1]) if same in held else None, self.values_only)
            for us, values in sorted(items, key=lambda x: (x[0] or 0, x[1][topic], x[1][partition], x[1][offset])):
                for i, kind in self.maps:
                    values[i] = _with_maps(values[i], kind)
                ctx.topic, ctx.partition, ctx.offset = values[topic], values[partition], values[offset]
                ctx.headers = None if headers is None else values[headers]
                values[stamp] = None if us is None else EPOCH + timedelta(microseconds=us)
                if us is not None:
                    ms = us // 1000
                    if event_time:
                        ctx.now_ms = ms if ctx.now_ms is None else max(ms, ctx.now_ms)
                    else:
                        ctx.advance(ms)
                ctx.timestamp = values[stamp]
                result = self.made.on_record(ctx, user, {c: values[i] for i, c in told})
                if self.values_only:
                    values[value] = result
                    yield values
                else:
                    yield from self._emitted(ctx)
            held[same] = self._kept(ctx, user, wall)
        self.keys.write(held, arrived)
        if self.mode != "None":
            self._wait(timerValues.getCurrentWatermarkInMs() if event_time else None, due, held, arrived)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._out(self._fired(timerValues, expiredTimerInfo.getExpiryTimeInMs()))

    def _fired(self, timerValues, expiry: int) -> Iterator[tuple]:
        _, due = self.clock.get() or (None, None)
        if due is None or due > expiry:
            return  # a timer that was replaced
        event_time = self.mode == "EventTime"
        now = timerValues.getCurrentWatermarkInMs() if event_time else timerValues.getCurrentProcessingTimeInMs()
        kind = "stream-time" if event_time else "wall-clock-time"
        passed = lambda ms: ms is not None and (ms <= expiry or ms < now)
        held, changed = self.keys.read(), []
        for same, (first, kept) in list(held.items()):
            if not passed(first):
                continue
            changed.append(same)
            ctx, user = opened(self.made, pickle.loads(kept), self.values_only)
            for timer in sorted((t for t in ctx._timers if t["kind"] == kind and passed(t["due"])), key=lambda t: t["due"]):
                if not timer["live"]:
                    continue
                due = timer["due"]
                if event_time:
                    ctx.now_ms = due
                ctx.timestamp = EPOCH + due * MILLISECOND
                timer["call"](due)
                if timer["live"]:
                    # ticks that were jumped over are not made up for
                    timer["due"] += timer["every"] * (1 + max(0, now - due) // timer["every"])
                if not self.values_only:
                    yield from self._emitted(ctx)
            held[same] = self._kept(ctx, user, None if event_time else now)
        self.keys.write(held, changed)
        self._wait(now if event_time else None, None, held, held)

    def close(self) -> None:
        if hasattr(self.made, "close"):
            self.made.close()


TIME_MODES = ("EventTime", "ProcessingTime", "None")


def process_stream(df: DataFrame, processor, time_mode: str | None = None, retention=DAY) -> DataFrame:
    """Streaming form of `process`. Without `time_mode`, a processor that schedules by wall clock runs in processing time, others in event time. A query
    in processing time goes on making micro-batches for its timers, so the trigger `availableNow` does not end it (`run.run_until_idle` does)."""
    if time_mode is None:
        time_mode = "ProcessingTime" if "wall-clock-time" in clocks(processor) else "EventTime"
    if time_mode not in TIME_MODES:
        raise ValueError(f"unknown time mode: {time_mode!r}")
    df = df if "_part" in df.columns else _apart(df, "_by")
    columns = [c for c in RECORD_FIELDS if c in df.columns]
    return _processed(df, "_by", columns, processor, output_schema(df, processor), False, time_mode, retention)


def process_values_stream(df: DataFrame, processor, value_type: T.DataType) -> DataFrame:
    out = T.StructType([T.StructField(f.name, value_type if f.name == "value" else f.dataType) for f in df.schema])
    mode = "ProcessingTime" if "wall-clock-time" in clocks(processor) else "None"
    return _processed(_apart(df, "key"), "key", df.columns, processor, out, True, mode)


def _processed(df: DataFrame, by: str, columns: list[str], processor, out: T.StructType, values_only: bool, mode: str, retention=DAY) -> DataFrame:
    """Records (`by`, _part, `columns`) through a processor, by slots of keys. In event time Spark drops a pack if all its records are late; of others,
    those are dropped that timers of the slot may have passed."""
    timed = mode == "EventTime"
    fields = df.select(*columns).schema
    # times are whole numbers on the way: pickled ones cost more than all else; those without are in packs of their own, which are never late
    named = [F.lit(None).cast("int").alias(f"_c{i}") if c == "timestamp" else F.col(c).alias(f"_c{i}") for i, c in enumerate(columns)]
    rows = _slotted(df, by, "_part").select(
        F.col(by).alias("_by"), F.col("_part").alias("_p"), F.unix_micros("timestamp").alias("_us"), *named, "_slot",
        *[x for x in ("timestamp", F.col("timestamp").isNull().cast("bigint").alias("_timeless")) if timed])
    packs = _packs(rows, ["_slot", *(["_timeless"] if timed else [])], timed)
    if timed:
        packs = _watermarked(packs, retention)
    made = _UserProcessor(processor, fields, out, values_only, mode)
    return _opened(packs.groupBy("_slot").transformWithState(made, OUT, "Update", mode), out)
