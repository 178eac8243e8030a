"""Importance resampling: documents drawn so that they look like a target corpus, by hashed runs of words.

Each run of one to `runs` words falls into a bucket, the CRC-32 of its bytes modulo the number of buckets. The gain of a bucket
compares how often target and documents fall into it; a document's weight is the mean gain of its runs, and adding Gumbel noise
and taking the highest scores draws without replacement in proportion to exp(weight).

Buckets are worked out per slice of a task's rows: distinct runs are grouped by equal length into matrices of bytes, one
row of the matrix per byte position, so that one table look-up advances the sums of all runs at once; the results are
scattered back to the places of the runs. Runs longer than `WIDE` bytes are cut into rows of that width, whose sums are put
together by the linear map that appends zero bytes.

Data that leave a task before the shuffle: one count per bucket. The ranking needs no global sort: scores are whole numbers, a
histogram of them (bounded by the range of gains and noise) tells where each score starts, and rows are numbered within a score.

Defined results: null text holds no words; without words the weight is 0. A null id counts as empty text in the draw. Repeated rows are
drawn each on their own; equal scores go by doc_id (nulls first) and number of runs. Columns other than doc_id and text are not looked
at, whatever their names. An empty table gives no rows; an empty target has no runs (T = 0).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideway.llm.common import written

POLYNOMIAL = 0xEDB88320     # fixed value: CRC-32, lowest bit first
WIDE = 512                  # longest run, in bytes, that is one column of a matrix
CELLS = 1 << 22             # bytes in one matrix
SLICE_BYTES = 4 << 20       # text that is looked at at once; a longer document is a slice of its own
SLICE_ROWS = 20_000
COARSE = 1024               # scores that share a step of the histogram's running sum


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


TABLE = _byte_table()


def _plain_bytes() -> bytes:
    """A-Z to a-z; every byte that no word holds to a blank. Bytes from 128 up belong to letters outside ASCII."""
    word = lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128
    return bytes(b + 32 if 65 <= b <= 90 else b if word(b) else 32 for b in range(256))


PLAIN = _plain_bytes()


def _columns(matrix: np.ndarray, register: np.ndarray) -> np.ndarray:
    """Registers after the bytes of each column; `matrix` has a row per byte position."""
    for row in matrix:
        register = TABLE[(register ^ row) & 0xFF] ^ (register >> 8)
    return register


def _mapped(basis: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The linear map with these images of the 32 bits, applied to all of `x`."""
    out = np.zeros_like(x)
    for bit, image in enumerate(basis):
        out ^= np.where((x >> np.uint32(bit)) & 1, image, np.uint32(0)).astype(np.uint32)
    return out


def _wide(rows: np.ndarray) -> np.ndarray:
    """CRC-32 of runs given as (run, row, WIDE) bytes, padded with zeros in front, their first four bytes inverted.

    An all-ones start equals inverting the first four bytes, after which leading zeros change nothing."""
    runs, height, width = rows.shape
    parts = np.empty((runs, height), np.uint32)
    flat, out = rows.reshape(-1, width), parts.reshape(-1)
    step = max(1, CELLS // width)
    for a in range(0, len(flat), step):
        part = flat[a:a + step]
        out[a:a + step] = _columns(np.ascontiguousarray(part.T), np.zeros(len(part), np.uint32))
    basis = _columns(np.zeros((width, 32), np.uint8), np.uint32(1) << np.arange(32, dtype=np.uint32))
    while parts.shape[1] > 1:
        if parts.shape[1] % 2:
            parts = np.concatenate([np.zeros((runs, 1), np.uint32), parts], axis=1)
        parts = _mapped(basis, np.ascontiguousarray(parts[:, ::2])) ^ parts[:, 1::2]
        basis = _mapped(basis, basis)
    return ~parts[:, 0]


def checksums(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of the stretches of `flat` (uint8), those of equal length together."""
    out = np.zeros(len(starts), np.uint32)
    order = np.argsort(lengths, kind="stable")
    ordered = lengths[order]
    edges = np.flatnonzero(np.diff(ordered, prepend=-1))
    tall: dict[int, list[int]] = {}
    for a, b in zip(edges, [*edges[1:], len(order)], strict=True):
        length = int(ordered[a])
        if length > WIDE:
            tall.setdefault(-(-length // WIDE), []).extend(order[a:b].tolist())
            continue
        step = max(1, CELLS // max(1, length))
        for c in range(a, b, step):
            at = order[c:min(b, c + step)]
            matrix = flat[starts[at][None, :] + np.arange(length)[:, None]]
            out[at] = ~_columns(matrix, np.full(len(at), 0xFFFFFFFF, np.uint32))
    for height, at in tall.items():
        step = max(1, CELLS // (height * WIDE))
        for c in range(0, len(at), step):
            some = at[c:c + step]
            rows = np.zeros((len(some), height * WIDE), np.uint8)
            for row, i in zip(rows, some, strict=True):
                row[-lengths[i]:] = flat[starts[i]:starts[i] + lengths[i]]
                row[-lengths[i]:][:4] ^= 0xFF
            out[some] = _wide(rows.reshape(len(some), height, WIDE))
    return out


def _first(codes: np.ndarray, n: int) -> np.ndarray:
    """Where each code occurs first."""
    out = np.empty(n, np.int64)
    out[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    return out


def hashed_runs(texts: list[bytes], runs: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text the number of words and of runs, and the buckets of all runs, text after text."""
    plain = b" ".join(texts).translate(PLAIN)
    words = plain.split()
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int64) if len(texts) else np.zeros(0, np.int64)
    blank = np.frombuffer(plain, np.uint8) == 32
    starts_word = ~blank & np.concatenate([[True], blank[:-1]]) if len(blank) else np.zeros(0, bool)
    owner = np.searchsorted(begins, np.flatnonzero(starts_word), side="right") - 1
    n_words = np.bincount(owner, minlength=len(texts)).astype(np.int64)
    n_runs = sum(np.maximum(n_words - k, 0) for k in range(runs))
    if not words:
        return n_words, n_runs, np.zeros(0, np.int64)
    flat = np.frombuffer(b" ".join(words), np.uint8)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    single, kinds = pd.factorize(np.array(words, dtype=object))
    distinct = len(kinds)
    table = np.full((len(words), runs), -1, np.int64)
    code, at = single.astype(np.int64), np.arange(len(words))
    for k in range(runs):
        if k:
            # a run that would leave its text is none
            at = at[(at + k < len(words))]
            at = at[owner[at + k] == owner[at]]
            code, kinds = pd.factorize(before[at] * distinct + single[at + k])
        if not len(at):
            break
        first = at[_first(code, len(kinds))]
        crc = checksums(flat, starts[first], starts[first + k] + lengths[first + k] - starts[first])
        table[at, k] = (crc % np.uint32(buckets)).astype(np.int64)[code]
        before = np.zeros(len(words), np.int64)
        before[at] = code
    return n_words, n_runs, table[table >= 0]


def _slices(texts: list[bytes]):
    a, held = 0, 0
    for i, text in enumerate(texts):
        if i > a and (held + len(text) > SLICE_BYTES or i - a >= SLICE_ROWS):
            yield a, i
            a, held = i, 0
        held += len(text)
    if a < len(texts):
        yield a, len(texts)


def hashed(docs: DataFrame, id_column: str, runs: int, buckets: int) -> DataFrame:
    """Rows (doc_id, n_words, n_features, buckets); the buckets of a text are packed into one binary value."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"
    slim = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.encode("text", "UTF-8").alias("text"))

    def run(batches):
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            for a, b in _slices(texts):
                n_words, n_runs, codes = hashed_runs(texts[a:b], runs, buckets)
                packed = codes.astype(kind).tobytes()
                ends = np.cumsum(n_runs) * np.dtype(kind).itemsize
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(n_words), pa.array(n_runs),
                     pa.array([packed[x:y] for x, y in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)], pa.binary())],
                    names=["doc_id", "n_words", "n_features", "buckets"])

    return slim.mapInArrow(run, "doc_id long, n_words long, n_features long, buckets binary")


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def bucket_counts(features: DataFrame, buckets: int) -> DataFrame:
    """Rows (bucket, n) over all runs; a task sends at most one row per bucket."""
    kind = _kind(buckets)

    def run(batches):
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch.column("buckets"):
                counts += np.bincount(np.frombuffer(packed.as_buffer(), kind), minlength=buckets)
        there = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int64)), pa.array(counts[there])], names=["bucket", "n"])

    return features.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(here: DataFrame, there: DataFrame, buckets: int) -> DataFrame:
    """Rows (bucket, gain): 1000 times the logarithm of the ratio of smoothed shares, floored; one row per bucket."""
    spark = here.sparkSession
    known = (spark.range(buckets).select(F.col("id").alias("bucket")).join(here.withColumnRenamed("n", "s"), "bucket", "left")
             .join(there.withColumnRenamed("n", "t"), "bucket", "left").na.fill(0))
    total = lambda c: F.sum(c).over(Window.partitionBy()).cast("double") + buckets
    grown = lambda c: F.col(c).cast("double") + 1
    ratio = grown("t") * total("s") / (grown("s") * total("t"))
    return known.select("bucket", F.floor(F.log(ratio) * 1000).alias("gain"))


def weighed(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """Rows (doc_id, n_words, n_features, weight): the floored mean gain of a document's runs."""
    kind = _kind(len(gain))

    def run(batches):
        for batch in batches:
            n = batch.column("n_features").to_numpy()
            sums = np.fromiter((gain[np.frombuffer(packed.as_buffer(), kind)].sum() for packed in batch.column("buckets")), np.int64, len(n))
            weight = np.where(n > 0, sums // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weight.astype(np.int64))],
                                             names=["doc_id", "n_words", "n_features", "weight"])

    return features.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def highest(rows: DataFrame, most: int) -> DataFrame:
    """`rows` (score long, doc_id, n_features, …) with `rank` from 1 for the `most` highest scores, null for the others."""
    counted = rows.groupBy("score").agg(F.count("*").alias("n")).withColumn("step", F.floor(F.col("score") / COARSE))
    down = lambda w, c: w.orderBy(F.col(c).desc()).rowsBetween(Window.unboundedPreceding, -1)
    steps = counted.groupBy("step").agg(F.sum("n").alias("n"))
    steps = steps.select("step", F.coalesce(F.sum("n").over(down(Window, "step")), F.lit(0)).alias("above"))
    within = F.coalesce(F.sum("n").over(down(Window.partitionBy("step"), "score")), F.lit(0))
    # one row per whole score: gains lie between -1000 ln(n) and 1000 ln(n), the noise within 26,000
    begins = counted.join(steps, "step").select("score", (F.col("above") + within).alias("_above"))
    placed = rows.join(F.broadcast(begins), "score")
    number = F.row_number().over(Window.partitionBy("score").orderBy("doc_id", "n_features"))
    drawn = placed.where(F.col("_above") < most).withColumn("rank", F.col("_above") + number)
    drawn = drawn.withColumn("rank", F.when(F.col("rank") <= most, F.col("rank")))
    return drawn.unionByName(placed.where(F.col("_above") >= most).withColumn("rank", F.lit(None).cast("long"))).drop("_above")


def resample(docs: DataFrame, target: DataFrame, *, target_id: str = "item_id", runs: int = 2, buckets: int = 10_000, least_words: int = 20,
             percent: int = 25, seed: int = 7) -> DataFrame:
    """Every document with n_words, n_features, weight, score and its rank among the drawn ones (null: not drawn).

    Of the N documents with at least `least_words` words, floor(percent · N / 100) are drawn. `runs` is the largest number of words in a run.
    """
    features = written(hashed(docs, "doc_id", runs, buckets), "runs")
    wanted = hashed(target, target_id, runs, buckets)
    gain = np.zeros(buckets, np.int64)
    for row in gains(bucket_counts(features, buckets), bucket_counts(wanted, buckets), buckets).collect():  # one row per bucket
        gain[row["bucket"]] = row["gain"]
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    drawn = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.log(-F.log((drawn + 0.5) / 4294967296.0)) * -1000)
    scored = written(weighed(features, gain).withColumn("score", F.col("weight") + noise), "scored")
    able = scored.where(F.col("n_words") >= least_words)
    ranked = highest(able, able.count() * percent // 100)
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select("doc_id", "n_words", "n_features", "weight", "score", "rank")
