"""Stateful processors and Python folds on batch frames.

A processor is a class (or any callable that makes a fresh instance) with

    key_type, value_type     DDL types of what it forwards
    stores                   {name: (DDL key type, DDL value type)}
    init(ctx) -> state       optional; what it returns is the state of a key and lasts as long as the key's stores
    on_record(ctx, state, record)
    close()                  optional

State is kept per grouping key. The same class runs on streams, see `tideway.streaming.stateful`. `init` runs again whenever a key is taken up
again (a later round or micro-batch), so that timers have their callbacks; the state it returns then is given the content of the kept one,
so that callbacks which refer to it see that. It has to be a dict, list, set or anything else that can be pickled.

On a batch frame the records of a key are sorted by the shuffle and handed over in Arrow batches, so a key is
never held in memory. Python state has to see the records of one key one after another; a key that holds a large
part of the input is therefore run in rounds: its records are cut into chunks, round i processes chunk i of every
hot key and hands the state on through the shared folder. No task holds more than a chunk.
"""

from __future__ import annotations

import itertools
import pickle
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tideway.functions import layout as L
from tideway.functions.folds import RowFold
from tideway.record import interval_ms, order_columns
from tideway.session import fresh_path

_STATE = "_state"
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
MILLISECOND = timedelta(milliseconds=1)
Columns = dict[str, list]
Body = Callable[[tuple, Iterator[Columns], object, bool], Iterator[Columns]]


def _schema(ddl_or_type) -> T.StructType:
    return ddl_or_type if isinstance(ddl_or_type, T.StructType) else T.StructType.fromDDL(ddl_or_type)


def sequential(df: DataFrame, keys: list[str], order: list[str], body: Body, schema: T.StructType,
               chunk_rows: int | None = None) -> DataFrame:
    """Run `body(key, batches, state, last)` over the records of each key in order.

    Batches are dicts of column lists. `body` is a generator: it yields output batches and returns the new state. `last` tells it whether more records
    of the key may follow in another round. `state` is None at first.
    """
    layout = L.measure(df, keys, order, chunk_rows)
    if layout is None:
        return _round(df, keys, order, body, schema, last=True)
    spark = df.sparkSession
    assigned = layout.assign(df)
    cold = _round(assigned.filter("NOT _hot").drop("_chunk", "_hot"), keys, order, body, schema, last=True)
    base = fresh_path(spark, "rounds")
    hot_path = f"{base}/input"
    (assigned.filter("_hot").drop("_hot").repartition("_chunk", *keys)
     .write.partitionBy("_chunk").parquet(hot_path))
    hot_schema = assigned.drop("_hot").schema
    with_state = T.StructType([*schema.fields, *[_nullable(df.schema[k], f"_k_{k}") for k in keys],
                               T.StructField(_STATE, T.BinaryType())])
    last_chunk = spark.read.schema(hot_schema).parquet(hot_path).agg(F.max("_chunk")).first()[0]
    rounds = last_chunk + 1
    states = None
    outputs = []
    for i in range(rounds):
        rows = spark.read.schema(hot_schema).parquet(hot_path).filter(F.col("_chunk") == i).drop("_chunk")
        rows = rows.withColumn(_STATE, F.lit(None).cast("binary"))
        if states is not None:
            rows = rows.unionByName(states, allowMissingColumns=True)
        out = _round(rows, keys, order, body, with_state, last=i == rounds - 1, carry=True)
        path = f"{base}/round={i}"
        out.write.parquet(path)  # a round that was written is never run again
        written = spark.read.schema(with_state).parquet(path)
        outputs.append(written.filter(F.col(_STATE).isNull()).select(*schema.fieldNames()))
        states = written.filter(F.col(_STATE).isNotNull()).select(
            *[F.col(f"_k_{k}").alias(k) for k in keys], _STATE
        )
    for out in outputs:
        cold = cold.unionByName(out)
    return cold


def _nullable(f: T.StructField, name: str) -> T.StructField:
    return T.StructField(name, f.dataType, True)


def _round(df: DataFrame, keys: list[str], order: list[str], body: Body, schema: T.StructType, *, last: bool,
           carry: bool = False) -> DataFrame:
    arrow = to_arrow_schema(schema)

    def columns_of(outputs: list[dict[str, list]]) -> pa.RecordBatch:
        joined = {f.name: [] for f in arrow}
        for columns in outputs:
            n = len(next(iter(columns.values())))
            for name, values in joined.items():
                values.extend(columns.get(name) or [None] * n)
        return pa.RecordBatch.from_pydict(joined, schema=arrow)

    # Arrow rather than pandas: whole numbers next to nulls stay whole numbers. One pass over the sorted task, as a call per key costs more than what
    # is done for a key with few records.
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        outputs, held = [], 0
        for _, stretches in itertools.groupby(_stretches(batches, keys), key=lambda x: x[0]):
            _, names, first = next(stretches)
            frames = itertools.chain([first], (columns for _, _, columns in stretches))
            state = None
            if carry and first[_STATE][0] is not None:
                state = pickle.loads(first[_STATE][0])
                for values in first.values():
                    del values[0]
            work = body(names, (f for f in frames if f[keys[0]]), state, last)
            while True:
                try:
                    columns = next(work)
                except StopIteration as done:
                    state = done.value
                    break
                outputs.append(columns)
                held += len(next(iter(columns.values())))
                if held >= OUTPUT_ROWS:
                    yield columns_of(outputs)
                    outputs, held = [], 0
            if carry and not last:
                outputs.append({**{f"_k_{k}": [v] for k, v in zip(keys, names)}, _STATE: [pickle.dumps(state)]})
                held += 1
        if outputs:
            yield columns_of(outputs)

    # the state row sorts before all records of its key
    by = [F.col(k) for k in keys] + ([F.col(_STATE).isNull().asc()] if carry else []) + [F.col(c) for c in order]
    return df.repartition(*keys).sortWithinPartitions(*by).mapInArrow(run, schema)


OUTPUT_ROWS = 10_000  # records that are handed back together


def _same(key):
    """A key as a value that can be compared; equal for keys that Spark groups together."""
    if isinstance(key, dict):
        return tuple((n, _same(v)) for n, v in key.items())
    if isinstance(key, (list, tuple)):
        return tuple(map(_same, key))
    return ("nan",) if key != key else key


def _stretches(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple]:
    """Of sorted batches, each stretch of records with equal keys: the keys as `_same` and as they are, and its columns as lists."""
    for batch in batches:
        columns, n = batch.to_pydict(), batch.num_rows
        named = list(zip(*[columns[k] for k in keys]))
        same = [_same(k) for k in named]
        start = 0
        while start < n:
            end = start + 1
            while end < n and same[end] == same[start]:
                end += 1
            yield same[start], named[start], {c: values[start:end] for c, values in columns.items()}
            start = end


# -- folds -------------------------------------------------------------------------------------


def fold_rows(df: DataFrame, keys: list[str], fold: RowFold, order: list[str],
              chunk_rows: int | None = None) -> DataFrame:
    """Python fold per `keys` into `value`. With `merge`, the chunks of a hot key are folded side by side."""
    schema = T.StructType(
        [_nullable(df.schema[k], k) for k in keys] + [T.StructField("value", _type(fold.schema))]
    )
    slim = df.select(*dict.fromkeys([*keys, "key", "value", *order]))
    if fold.merge is None:
        return sequential(slim, keys, order, _fold_body(keys, fold.seed, fold.step), schema, chunk_rows)
    layout = L.measure(slim, keys, order, chunk_rows)
    if layout is None:
        return _round(slim, keys, order, _fold_body(keys, fold.seed, fold.step), schema, last=True)
    chunked = layout.assign(slim).drop("_hot")
    by_chunk = [*keys, "_chunk"]
    partial = _round(chunked, by_chunk, order, _fold_body(by_chunk, fold.seed, fold.step),
                     T.StructType([*schema.fields[:-1], T.StructField("_chunk", T.IntegerType()), schema["value"]]),
                     last=True)
    merge = fold.merge
    seed_or_merge = lambda agg, k, v: v if agg is None else merge(agg, v)
    with_key = partial if "key" in keys else partial.withColumn("key", F.lit(None).cast("int"))
    # at most MAX_CHUNKS partial results per key
    return _round(with_key, keys, ["_chunk"], _fold_body(keys, lambda: None, seed_or_merge), schema, last=True)


def _type(ddl: str) -> T.DataType:
    return T.StructType.fromDDL(f"value {ddl}")["value"].dataType


def _fold_body(keys: list[str], seed, step) -> Body:
    def body(key, frames, state, last):
        agg = seed() if state is None else state[0]
        for columns in frames:
            for k, v in zip(columns["key"], columns["value"]):
                agg = step(agg, k, v)
        if last:
            yield {**{n: [k] for n, k in zip(keys, key)}, "value": [agg]}
        return (agg,)

    return body


# -- processors --------------------------------------------------------------------------------


class KeyValueStore:
    """State of one key, by store key: get, put, offer, remove, range, count. A null value deletes."""

    def __init__(self, data=None):
        self.data = data if data is not None else {}

    def get(self, k):
        return self.data.get(k)

    def put(self, k, v):
        if v is None:
            self.data.pop(k, None)
        else:
            self.data[k] = v

    def offer(self, k, v):
        """Put only if absent; returns what was there."""
        old = self.get(k)
        if old is None:
            self.put(k, v)
        return old

    def remove(self, k):
        return self.data.pop(k, None)

    def range(self, low=None, high=None):
        for k in sorted(self.data):
            if (low is None or k >= low) and (high is None or k <= high):
                yield k, self.data[k]

    def count(self):
        return len(self.data)


class Context:
    """What a processor sees besides the record: stores, `forward`, `schedule`, and where the record came from."""

    def __init__(self, stores: dict[str, KeyValueStore], forbid_forward: bool = False):
        self._stores = stores
        self._forbid = forbid_forward
        self._timers: list[dict] = []
        self.out: list[tuple] = []
        self.now_ms: int | None = None
        self.topic = self.partition = self.offset = self.timestamp = self.headers = None

    def store(self, name: str) -> KeyValueStore:
        return self._stores[name]

    def forward(self, key=None, value=None, timestamp=None, child: str | None = None):
        """Emit a key-value; time defaults to that of the current record or timer."""
        if self._forbid:
            raise RuntimeError("process_values must return the value; forwarding is not allowed")
        self.out.append((key, value, timestamp if timestamp is not None else self.timestamp, child))

    def schedule(self, interval, kind: str, callback) -> Callable[[], None]:
        """Call `callback(epoch_ms)` every `interval` of `stream-time` or `wall-clock-time`; returns a cancel function.

        Ticks that were jumped over are not made up for. A batch has no wall clock: such timers never fire in it.
        """
        if kind not in ("stream-time", "wall-clock-time"):
            raise ValueError(f"unknown kind of time: {kind!r}")
        timer = {"every": interval_ms(interval), "kind": kind, "call": callback, "due": None, "live": True}
        self._timers.append(timer)
        return lambda: timer.update(live=False)

    def advance(self, now_ms: int):
        """Move stream time forward and fire what is due."""
        self.now_ms = now_ms if self.now_ms is None else max(self.now_ms, now_ms)
        for timer in self._timers:
            if not timer["live"] or timer["kind"] != "stream-time":
                continue
            if timer["due"] is None:
                timer["due"] = self.now_ms + timer["every"]
            elif self.now_ms >= timer["due"]:
                timer["due"] += timer["every"] * (1 + (self.now_ms - timer["due"]) // timer["every"])
                self.timestamp = EPOCH + self.now_ms * MILLISECOND
                timer["call"](self.now_ms)


def taken_up(fresh, kept):
    """The kept state, in the object that a new run of `init` made where that can hold it."""
    if type(fresh) is type(kept) and isinstance(kept, (dict, list, set)):
        fresh.clear()
        fresh.extend(kept) if isinstance(kept, list) else fresh.update(kept)
        return fresh
    return kept


def clocks(processor) -> set[str]:
    """Kinds of time that the processor schedules by: what it says in `clocks`, else what its `init` schedules (tried on an empty context)."""
    made = instance(processor)
    if hasattr(made, "clocks"):
        return set(made.clocks)
    ctx = Context({n: KeyValueStore() for n in getattr(made, "stores", {})})
    if hasattr(made, "init"):
        made.init(ctx)
    return {timer["kind"] for timer in ctx._timers}


def instance(processor):
    made = processor() if callable(processor) else processor
    if not callable(getattr(made, "on_record", None)):
        raise ValueError("a processor needs on_record(ctx, state, record)")
    return made


def output_schema(df: DataFrame, processor) -> T.StructType:
    made = instance(processor)
    return T.StructType([
        T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()), T.StructField("timestamp", T.TimestampType()),
        T.StructField("key", _type(made.key_type)), T.StructField("value", _type(made.value_type)),
        T.StructField("child", T.StringType()), T.StructField("_pos", T.ArrayType(T.LongType())),
    ])


RECORD_FIELDS = ("topic", "partition", "offset", "timestamp", "headers", "key", "value")


def opened(made, kept: dict | None, values_only: bool) -> tuple[Context, object]:
    """The context and the state of a key, as `closed` left them."""
    kept = kept or {}
    stores = {n: KeyValueStore(kept.get("stores", {}).get(n)) for n in getattr(made, "stores", {})}
    ctx = Context(stores, forbid_forward=values_only)
    init = getattr(made, "init", None)
    user = init(ctx) if init else None
    if kept:
        ctx.out.clear()
        ctx.now_ms = kept["now"]
    if "user" in kept:
        user = taken_up(user, kept["user"])
    for timer, (due, live) in zip(ctx._timers, kept.get("timers", [])):
        timer["due"], timer["live"] = due, live
    return ctx, user


def closed(ctx: Context, user) -> dict:
    return {
        "stores": {n: s.data for n, s in ctx._stores.items()}, "now": ctx.now_ms,
        "timers": [(t["due"], t["live"]) for t in ctx._timers], **({"user": user} if user is not None else {}),
    }


def _processor_body(processor, names: list[str], values_only: bool) -> Body:
    def body(key, frames, state, last):
        made = instance(processor)
        ctx, user = opened(made, state, values_only)
        for frame in frames:
            columns = [c for c in RECORD_FIELDS if c in frame]
            rows = []
            for values in zip(*[frame[c] for c in columns]):
                record = dict(zip(columns, values))
                ctx.topic, ctx.partition, ctx.offset = (record.get(n) for n in ("topic", "partition", "offset"))
                ctx.headers = record.get("headers")
                at = record.get("timestamp")
                if at is not None:
                    ctx.advance((at - EPOCH) // MILLISECOND)
                ctx.timestamp = at
                result = made.on_record(ctx, user, record)
                if values_only:
                    rows.append(result)
                else:
                    for i, (k, v, ts, child) in enumerate(ctx.out):
                        rows.append((ctx.topic, ctx.partition, ctx.offset, ts, k, v, child, [i]))
                    ctx.out.clear()
            if values_only:
                yield {**frame, "value": rows}
            elif rows:
                yield dict(zip(names, map(list, zip(*rows))))
        if last and hasattr(made, "close"):
            made.close()
        return closed(ctx, user)

    return body


def _apart(df: DataFrame, by: str) -> DataFrame:
    """With `_part`: records without a key to keep state by have it by their topic and partition, not all in one group."""
    place = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("topic", "partition") if c in df.columns]
    return df.withColumn("_part", F.when(F.col(by).isNull(), F.concat_ws("/", *place)).otherwise(""))


def process(df: DataFrame, processor, by=None, **streaming) -> DataFrame:
    """Run a processor; the output records are what it forwards. Columns `child` and `_pos` tell outputs apart. Records whose key (or `by`) is
    null share a state per topic and partition."""
    df = _apart(df.withColumn("_by", by(F.col("key"), F.col("value")) if by else F.col("key")), "_by")
    if df.isStreaming:
        from tideway.streaming.stateful import process_stream

        return process_stream(df, processor, **streaming)
    schema = output_schema(df, processor)
    return sequential(df, ["_by", "_part"], order_columns(df), _processor_body(processor, schema.fieldNames(), False), schema)


def process_values(df: DataFrame, processor) -> DataFrame:
    """Run a processor that returns the new value of each record; everything else about the record stays."""
    value_type = _type(instance(processor).value_type)
    if df.isStreaming:
        from tideway.streaming.stateful import process_values_stream

        return process_values_stream(df, processor, value_type)
    schema = T.StructType([T.StructField(f.name, value_type if f.name == "value" else f.dataType) for f in df.schema])
    parted = _apart(df, "key")
    return sequential(parted, ["key", "_part"], order_columns(df), _processor_body(processor, schema.fieldNames(), True), schema)
