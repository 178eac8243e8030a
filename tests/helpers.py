from datetime import datetime, timedelta

EPOCH = datetime(1970, 1, 1)
RECORD = "topic string, partition int, offset bigint, timestamp timestamp, key {k}, value {v}"


def at(seconds):
    return EPOCH + timedelta(seconds=seconds)


def records(spark, rows, key="string", value="bigint", topic="t", partition=0):
    """Rows (key, seconds, value) as records with offsets in order."""
    return spark.createDataFrame(
        [(topic, partition, i, at(t) if t is not None else None, k, v) for i, (k, t, v) in enumerate(rows)],
        RECORD.format(k=key, v=value))


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
