"""State as tables: write a result under a name, then ask it by key, key range, window or session.

A store is a folder of rows (key, [window_from, window_to,] value) in parts `gen=<g>/seq=<n>/by=<writer>`. All writers number their parts in one
sequence; of the newest generation, the row with the highest `seq` counts, and a null value is a delete. Parts are sorted by key,
so that queries, which are filters on the key and window columns, skip most of a file. One writer at a time per store.
"""

from __future__ import annotations

import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideway.session import shared_dir

NOW = lambda: time.time_ns() // 1_000_000


def _nullable(kind: T.DataType) -> T.DataType:
    """The type with nulls allowed everywhere, as files give it back."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType))
    return T.MapType(_nullable(kind.keyType), _nullable(kind.valueType)) if isinstance(kind, T.MapType) else kind


class Store:
    def __init__(self, spark: SparkSession, name: str, schema: T.StructType):
        self.spark, self.name = spark, name
        self.path = f"{shared_dir(spark).rstrip('/')}/stores/{name}"
        self.schema = _nullable(schema)
        self.keys = [f.name for f in schema.fields if f.name != "value"]

    @classmethod
    def write(cls, name: str, df: DataFrame) -> Store:
        """Make `df` the whole content of the store `name`: a new generation, which replaces all parts at the moment it is complete."""
        store = cls(df.sparkSession, name, df.schema)
        store._put(df, 1 + max((g for g, _, _ in store.parts()), default=-1), 0, uuid.uuid4().hex)
        return store

    # -- parts -------------------------------------------------------------------------------

    def parts(self) -> list[tuple[int, int, str]]:
        """(generation, seq, writer) of all complete parts, in order."""
        jvm = self.spark._jvm
        pattern = jvm.org.apache.hadoop.fs.Path(f"{self.path}/gen=*/seq=*/by=*/_SUCCESS")
        found = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
        named = (re.search(r"/gen=(\d+)/seq=(\d+)/by=([^/]*)/_SUCCESS$", f.getPath().toUri().getPath()) for f in found)
        return sorted((int(m[1]), int(m[2]), m[3]) for m in named)

    def _generation(self) -> list[tuple[int, int, str]]:
        parts = self.parts()
        return [p for p in parts if p[0] == parts[-1][0]] if parts else []

    def _put(self, df: DataFrame, generation: int, seq: int, by: str) -> None:
        rows = df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema])
        rows.sortWithinPartitions(*self.keys).write.mode("overwrite").parquet(f"{self.path}/gen={generation}/seq={seq}/by={by}")

    def _append(self, df: DataFrame, by: str | None = None) -> None:
        """Add a part; a writer that comes again replaces its own part, in its place of the sequence."""
        parts = self._generation()
        generation, last = parts[-1][:2] if parts else (0, -1)
        self._put(df, generation, next((n for _, n, who in parts if who == by), last + 1), by or uuid.uuid4().hex)

    def _rows(self, parts: list[tuple[int, int, str]]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("gen", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("by", T.StringType())])
        if not parts:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/gen={g}/seq={n}/by={by}" for g, n, by in parts]
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths)

    def history(self) -> DataFrame:
        """All rows of the newest generation, with seq and by."""
        return self._rows(self._generation()).drop("gen")

    def version(self) -> int:
        """Number of the last part of the newest generation; −1 for an empty store."""
        return self._generation()[-1][1] if self._generation() else -1

    def snapshot(self, version: int | None = None) -> DataFrame:
        """The value per key (and window), now or as of an earlier version. Filters on keys pass through the aggregation into the scan."""
        return self._latest([p for p in self._generation() if version is None or p[1] <= version])

    def _latest(self, parts: list[tuple[int, int, str]]) -> DataFrame:
        latest = self._rows(parts).groupBy(*self.keys).agg(F.max_by(F.struct("value"), "seq").alias("_v"))
        return latest.select(*self.keys, F.col("_v.value").alias("value")).filter(F.col("value").isNotNull())

    # -- parts of streams ----------------------------------------------------------------------

    def upsert(self, df: DataFrame, batch_id: int, query: str = "stream") -> None:
        """For `foreachBatch`: a replayed batch of the same query overwrites its own part."""
        self._append(df, f"{query}-{batch_id}")

    def before(self, batch_id: int, query: str = "stream") -> DataFrame:
        """The snapshot that this micro-batch found, also when it is replayed."""
        parts = self._generation()
        mine = next((n for _, n, by in parts if by == f"{query}-{batch_id}"), None)
        return self._latest([p for p in parts if mine is None or p[1] < mine])

    def part(self, batch_id: int, query: str = "stream") -> DataFrame:
        """What this micro-batch has written."""
        return self._rows([p for p in self._generation() if p[2] == f"{query}-{batch_id}"]).drop("gen", "seq", "by")

    # -- writes ------------------------------------------------------------------------------

    def kv_put(self, rows: DataFrame) -> None:
        """Upsert; a null value deletes."""
        self._append(rows)

    def ws_put(self, rows: DataFrame, at_ms: int | None = None, length_ms: int = 0) -> None:
        """Put values into windows: `rows` has key, value and, if the rows know it, `window_from`; the others go to the window that starts at
        `at_ms` (default: now). `window_to` follows from the length. A null value deletes."""
        at = F.lit(NOW() if at_ms is None else at_ms).cast("bigint")
        rows = rows.withColumn("window_from", F.coalesce(F.col("window_from").cast("bigint"), at) if "window_from" in rows.columns else at)
        if "window_to" in self.keys and "window_to" not in rows.columns:
            rows = rows.withColumn("window_to", F.col("window_from") + length_ms)
        self._append(rows)

    def kv_offer(self, rows: DataFrame) -> DataFrame:
        """Insert keys that are absent; returns the rows that were already there."""
        rows = rows.select(*self.schema.fieldNames())
        there = self.snapshot()  # names the parts that exist now, so it does not see what is added below
        self._append(rows.join(there.select(*self.keys), self.keys, "left_anti"))
        return there.join(rows.select(*self.keys).distinct(), self.keys, "left_semi")

    def kv_remove(self, keys: DataFrame) -> DataFrame:
        """Delete; returns the removed rows."""
        gone = self.snapshot().join(keys.select(*self.keys).distinct(), self.keys, "left_semi")
        self._append(gone.withColumn("value", F.lit(None).cast(self.schema["value"].dataType)))
        return gone

    # -- queries -----------------------------------------------------------------------------

    def kv_get(self, key) -> DataFrame:
        return kv_get(self.snapshot(), key)

    def kv_range(self, low=None, high=None) -> DataFrame:
        return kv_range(self.snapshot(), low, high)

    def kv_count(self) -> int:
        return self.snapshot().count()

    def ws_get(self, key, window_from: int) -> DataFrame:
        return ws_get(self.snapshot(), key, window_from)

    def ws_multi_get(self, key, time_from: int = 0, time_to: int | None = None) -> DataFrame:
        return ws_multi_get(self.snapshot(), key, time_from, time_to)

    def ws_multi_range(self, low=None, high=None, time_from: int = 0, time_to: int | None = None) -> DataFrame:
        return ws_multi_range(self.snapshot(), low, high, time_from, time_to)

    def ss_multi_get(self, key, time_from: int = 0, time_to: int | None = None) -> DataFrame:
        return ss_multi_get(self.snapshot(), key, time_from, time_to)

    def ss_multi_range(self, low, high, time_from: int = 0, time_to: int | None = None) -> DataFrame:
        return ss_multi_range(self.snapshot(), low, high, time_from, time_to)


def query_store(spark: SparkSession, name: str, schema) -> Store:
    """A store by name."""
    return Store(spark, name, T.StructType.fromDDL(schema) if isinstance(schema, str) else schema)


def streaming_state(spark: SparkSession, checkpoint: str, **options) -> DataFrame:
    """The state a streaming query keeps, straight from its checkpoint (Spark's state reader and its options)."""
    return spark.read.format("statestore").options(**options).load(checkpoint)


def kv_get(df: DataFrame, key) -> DataFrame:
    return df.filter(F.col("key") == key)


def kv_range(df: DataFrame, low=None, high=None) -> DataFrame:
    """All rows, or keys from `low` to `high`, both included."""
    if low is not None:
        df = df.filter(F.col("key") >= low)
    return df.filter(F.col("key") <= high) if high is not None else df


def ws_get(df: DataFrame, key, window_from: int) -> DataFrame:
    return df.filter((F.col("key") == key) & (F.col("window_from") == window_from))


def _starting(df: DataFrame, time_from: int, time_to: int | None) -> DataFrame:
    return df.filter(F.col("window_from").between(time_from, NOW() if time_to is None else time_to)).withColumn(
        "timestamp", F.col("window_from"))


def ws_multi_get(df: DataFrame, key, time_from: int = 0, time_to: int | None = None) -> DataFrame:
    """Windows of a key that start in [time_from, time_to]."""
    return _starting(kv_get(df, key), time_from, time_to)


def ws_multi_range(df: DataFrame, low=None, high=None, time_from: int = 0, time_to: int | None = None) -> DataFrame:
    """The same for all keys or a range of keys."""
    return _starting(kv_range(df, low, high), time_from, time_to)


def _overlapping(df: DataFrame, time_from: int, time_to: int | None) -> DataFrame:
    time_to = NOW() if time_to is None else time_to
    return df.filter((F.col("window_to") >= time_from) & (F.col("window_from") <= time_to))


def ss_multi_get(df: DataFrame, key, time_from: int = 0, time_to: int | None = None) -> DataFrame:
    """Sessions of a key that overlap [time_from, time_to]."""
    return _overlapping(kv_get(df, key), time_from, time_to)


def ss_multi_range(df: DataFrame, low, high, time_from: int = 0, time_to: int | None = None) -> DataFrame:
    """The same for a range of keys."""
    return _overlapping(kv_range(df, low, high), time_from, time_to)


def put_values(df: DataFrame, *, duplicate_keys: bool = False) -> DataFrame:
    """Records as window-store content by (key, timestamp): the last arrived value, or all of them."""
    rows = df.select("key", F.unix_millis("timestamp").alias("timestamp"), "value", "offset")
    if duplicate_keys:
        return rows
    last = rows.groupBy("key", "timestamp").agg(F.max_by(F.struct("value", "offset"), "offset").alias("_l"))
    return last.select("key", "timestamp", "_l.value", "_l.offset")
