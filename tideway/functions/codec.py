"""Binary encoding of keys and values: big-endian numbers, UTF-8 text, one-byte booleans. Null stays null."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BinaryType, DataType, DoubleType, StructType

# fixed values: names of the built-in formats
FORMATS = ("boolean", "byte-array", "byte-buffer", "double", "integer", "keyword", "long", "string")


@F.arrow_udf(BinaryType())
def _double_to_bytes(a: pa.Array) -> pa.Array:
    data = a.fill_null(0.0).to_numpy(zero_copy_only=False).astype(">f8").tobytes()
    fixed = pa.Array.from_buffers(pa.binary(8), len(a), [None, pa.py_buffer(data)]).cast(pa.binary())
    return pc.if_else(a.is_null(), pa.scalar(None, pa.binary()), fixed)


@F.arrow_udf(DoubleType())
def _double_from_bytes(a: pa.Array) -> pa.Array:
    data = b"".join(a.fill_null(bytes(8)).to_pylist())
    values = np.frombuffer(data, dtype=">f8").astype("f8")
    return pa.array(values, type=pa.float64(), mask=a.is_null().to_numpy(zero_copy_only=False))


def decoded(c: Column, format: str) -> Column:
    """Binary column to the type of one of the built-in formats."""
    if format in ("byte-array", "byte-buffer"):
        return c
    if format in ("string", "keyword"):
        return c.cast("string")
    if format == "boolean":
        return F.substring(c, 1, 1) != F.lit(b"\x00")
    if format == "long":
        return F.conv(F.hex(c), 16, -10).cast("bigint")
    if format == "integer":
        # sign-extend to eight bytes first
        negative = F.conv(F.substring(F.hex(c), 1, 1), 16, 10).cast("int") >= 8
        return F.conv(F.concat(F.when(negative, "FFFFFFFF").otherwise("00000000"), F.hex(c)), 16, -10).cast("int")
    if format == "double":
        return _double_from_bytes(c)
    raise ValueError(f"unknown format: {format!r}; known: {', '.join(FORMATS)}")


def encoded(c: Column, format: str) -> Column:
    """Column of a built-in format to binary."""
    if format in ("byte-array", "byte-buffer"):
        return c.cast("binary")
    if format in ("string", "keyword"):
        return c.cast("string").cast("binary")
    if format == "boolean":
        return F.when(c, F.lit(b"\x01")).when(~c, F.lit(b"\x00"))
    if format == "long":
        return F.unhex(F.lpad(F.hex(c.cast("bigint")), 16, "0"))
    if format == "integer":
        return F.unhex(F.substring(F.lpad(F.hex(c.cast("int").cast("bigint")), 16, "0"), 9, 8))
    if format == "double":
        return _double_to_bytes(c.cast("double"))
    raise ValueError(f"unknown format: {format!r}; known: {', '.join(FORMATS)}")


def _each(df: DataFrame, f, key, value) -> DataFrame:
    chosen = {"key": key, "value": value}
    return df.withColumns({n: f(F.col(n), how) for n, how in chosen.items() if how is not None})


def decode(df: DataFrame, key: str | None = None, value: str | None = None) -> DataFrame:
    return _each(df, decoded, key, value)


def encode(df: DataFrame, key: str | None = None, value: str | None = None) -> DataFrame:
    return _each(df, encoded, key, value)


def transcode_with(df: DataFrame, f, type: str | DataType | None = None, column: str = "value") -> DataFrame:
    """User codec that sees data, topic and headers.

    `f(data, topic, headers)` gets and returns Columns (`from_json`, `to_json`, …); with `type` given it is a Python
    function called per item inside Arrow batches, and not called for null.
    """
    data, topic, headers = F.col(column), F.col("topic"), F.col("headers")
    if type is None:
        return df.withColumn(column, f(data, topic, headers))

    kind = StructType.fromDDL(f"c {type}")["c"].dataType if isinstance(type, str) else type
    arrow = to_arrow_type(kind)

    def batch(items: pa.Array, topics: pa.Array, heads: pa.Array) -> pa.Array:
        rows = zip(items.to_pylist(), topics.to_pylist(), heads.to_pylist())
        return pa.array([None if d is None else f(d, t, h) for d, t, h in rows], type=arrow)

    return df.withColumn(column, F.arrow_udf(batch, kind)(data, topic, headers))


decode_with = transcode_with
encode_with = transcode_with
