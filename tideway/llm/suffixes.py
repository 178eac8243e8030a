"""Exact removal of repeated passages by blockwise suffix comparison with a difference-cover sample.

Every byte under a string of `length` bytes that also starts elsewhere (in any document, the same one included) is removed. Suffixes matter up to `length` bytes
only, so a rank is a class of equal prefixes, named by a 64-bit polynomial fingerprint of the prefix. What decides that two strings are equal is that and a second,
independent fingerprint, a polynomial over the field of 2³¹ - 1 elements: two different strings agree in the second with probability 200 / 2³¹ at most, besides
2⁻⁵⁶ in the first, which makes 4 in a million for one false removal in 100 TB.

1. A difference cover D modulo v has for any two positions i, j a shift d < v with i + d and j + d in D. So two equal strings share,
   at an equal shift, a pair of sampled positions whose following length - v + 1 bytes are equal. The classes of the samples (13.7 % of positions for v = 73) are
   worked out first; a string whose samples are all alone in their classes is not repeated.
2. The other strings, ties of the samples, are dealt into suffix buckets by ranges of their fingerprints. A task sorts one bucket at a time
   and marks what occurs twice, so memory is bounded by a bucket; the number of buckets follows the bytes.

Documents are read once into chunks of about `chunk_bytes`; tasks exchange packed fingerprints (4 bytes for samples, where a collision only costs an extra
candidate, else 7 beside the bucket and 4 of the second fingerprint) and get back one bit each, so hot passages add one entry per chunk. Of equal documents, one takes part.
A longer document is a chunk of its own.

Null text is empty; documents shorter than `length` lose nothing. Repeated rows are documents of their own, so both lose all; null doc_ids stay. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideway.llm.common import sorted_groups, written
from tideway.session import fresh_path

BASE = np.uint64(0x9E3779B97F4A7C15)
LETTERS = np.random.default_rng(1).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
WIDE, NARROW = 7, 4
PRIME, POINT = np.uint64(2**31 - 1), np.uint64(1_190_494_759)  # any point will do that was not chosen with the texts in mind


def difference_cover(length: int) -> tuple[int, np.ndarray]:
    """(v, D), v at most half of `length`: partial sums of a step pattern that covers all differences modulo v."""
    best = (1, np.array([0]))
    r = 0
    while (v := 24 * r * r + 36 * r + 13) * 2 <= length:
        steps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
        best = (v, np.concatenate([[0], np.cumsum(steps)]))
        r += 1
    return best


class Powers:
    """Powers of the base and of its inverse modulo 2⁶⁴, and of the point and its inverse modulo the prime, as many as needed so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)
        self.points = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]

    def of_point(self, n: int) -> list[np.ndarray]:
        for k, x in enumerate((int(POINT), pow(int(POINT), -1, int(PRIME)))):
            while len(self.points[k]) < n:
                known = self.points[k]
                self.points[k] = np.concatenate([known, known * np.uint64(pow(x, len(known), int(PRIME))) % PRIME])
        return [x[:n] for x in self.points]

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            inverse = np.uint64(pow(int(BASE), -1, 2**64))
            for name, x in (("up", BASE), ("down", inverse)):
                a = np.full(n, x, dtype=np.uint64)
                a[0] = 1
                setattr(self, name, np.multiply.accumulate(a))
        return self.up[:n], self.down[:n]


class Chunk:
    """The bytes of some documents, one after another, and fingerprints of their substrings."""

    def __init__(self, data: bytes, sizes: np.ndarray, active: np.ndarray, powers: Powers, length: int):
        self.bytes, self.length = np.frombuffer(data, dtype=np.uint8), length
        self.ends = np.cumsum(sizes)
        self.stop = np.repeat(np.where(active, self.ends, 0), sizes)  # documents that take no part end before they begin
        self.powers = powers
        up, self.down = powers.of(len(self.bytes) + 1)
        self.sums = np.zeros(len(self.bytes) + 1, dtype=np.uint64)
        np.cumsum(LETTERS[self.bytes] * up[:-1], out=self.sums[1:])
        self.v, self.cover = difference_cover(length)
        self.sample_length = length - self.v + 1

    def fingerprints(self, at: np.ndarray, n: int) -> np.ndarray:
        x = (self.sums[at + n] - self.sums[at]) * self.down[at]
        x ^= x >> np.uint64(31)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))

    def checks(self, at: np.ndarray, n: int) -> np.ndarray:
        """The second fingerprints."""
        if not len(at):
            return np.zeros(0, dtype=np.uint32)
        up, down = self.powers.of_point(len(self.bytes) + 1)
        sums = np.zeros(len(self.bytes) + 1, dtype=np.uint64)  # below 2³¹ · 2³³
        np.cumsum((self.bytes + np.uint64(1)) * up[:-1] % PRIME, out=sums[1:])
        return ((sums[at + n] - sums[at]) % PRIME * down[at] % PRIME).astype(np.uint32)

    def samples(self) -> np.ndarray:
        at = (np.arange(0, len(self.bytes), self.v)[:, None] + self.cover[None, :]).ravel()
        at = at[at < len(self.bytes)]
        return at[at + self.sample_length <= self.stop[at]]

    def candidates(self, samples: np.ndarray, repeated: np.ndarray) -> np.ndarray:
        """Starts of strings that have a repeated sample at a shift below v."""
        shared = np.zeros(len(self.bytes) + self.v + 1, dtype=np.int32)
        shared[samples[repeated] + 1] = 1
        np.cumsum(shared, out=shared)
        at = np.arange(len(self.bytes))
        return np.flatnonzero((at + self.length <= self.stop) & (shared[self.v:self.v + len(at)] > shared[:len(at)]))


def _distinct(values: np.ndarray, checks: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None, np.ndarray, np.ndarray]:
    """(distinct values in order, their checks, place of each among them, how often each occurs); values with different checks are different."""
    if checks is None:
        distinct, inverse, counts = np.unique(values, return_inverse=True, return_counts=True)
        return distinct, None, inverse, counts
    order = np.argsort(values)
    if _torn(values[order], checks[order]):
        order = np.lexsort((checks, values))
    v, c = values[order], checks[order]
    fresh = np.ones(len(v), dtype=bool)
    fresh[1:] = (v[1:] != v[:-1]) | (c[1:] != c[:-1])
    inverse = np.empty(len(v), dtype=np.int64)
    inverse[order] = np.cumsum(fresh) - 1
    starts = np.flatnonzero(fresh)
    return v[starts], c[starts], inverse, np.diff(np.append(starts, len(v)))


def _torn(values: np.ndarray, checks: np.ndarray) -> bool:
    """Whether equal neighbours have different checks, so that equal pairs may lie apart."""
    return bool(((values[1:] == values[:-1]) & (checks[1:] != checks[:-1])).any())


def _packed(values: np.ndarray, checks: np.ndarray | None, buckets: int) -> list[tuple[int, bytes]]:
    """The distinct values by bucket, each by its low bytes and its check."""
    distinct, checks, _, _ = _distinct(values, checks)
    cuts = _cuts(distinct, buckets)
    low = distinct.view(np.uint8).reshape(-1, 8)[:, :NARROW if checks is None else WIDE]
    if checks is not None:
        low = np.concatenate([low, checks.view(np.uint8).reshape(-1, 4)], axis=1)
    return [(b, low[s:e].tobytes()) for b, (s, e) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if e > s]


def _cuts(distinct: np.ndarray, buckets: int) -> np.ndarray:
    edges = [b * 2**64 // buckets for b in range(1, buckets)]
    return np.concatenate([[0], np.searchsorted(distinct, np.array(edges, dtype=np.uint64)), [len(distinct)]])


def _told(values: np.ndarray, checks: np.ndarray | None, answers) -> np.ndarray:
    """Which values are repeated, from the bits for the distinct ones of each bucket."""
    if not len(values):
        return np.zeros(0, dtype=bool)
    _, _, inverse, counts = _distinct(values, checks)
    bits = [np.unpackbits(np.frombuffer(a["bits"], dtype=np.uint8), count=a["n"]) for a in sorted(answers, key=lambda a: a["bucket"])]
    return ((counts > 1) | np.concatenate(bits).astype(bool))[inverse]


@contextmanager
def _small_batches(spark, rows: int = 4):
    """Chunks are large: few in an Arrow batch."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, was)


def remove_repeats(docs: DataFrame, *, length: int = 200, chunk_bytes: int = 2_000_000, bucket_bytes: int = 4_000_000) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) for every row of `docs` (doc_id, text); `kept` holds the bytes left."""
    spark = docs.sparkSession

    def gather(batches):
        task, n = TaskContext.get().partitionId() << 40, 0
        ids, texts, size = [], [], 0

        def chunk():
            digests = [hashlib.md5(x).digest() for x in texts]
            return pd.DataFrame({"chunk": [task + n], "data": [b"".join(texts)], "sizes": [[len(x) for x in texts]], "ids": [ids], "digests": [digests]})

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].array, batch["text"], strict=True):
                data = (text or "").encode("utf-8", "surrogatepass")
                if texts and size + len(data) > chunk_bytes:
                    yield chunk()
                    ids, texts, size, n = [], [], 0, n + 1
                ids.append(None if pd.isna(doc_id) else int(doc_id))
                texts.append(data)
                size += len(data)
        if texts:
            yield chunk()

    read = docs.select("doc_id", "text").mapInPandas(gather, "chunk long, data binary, sizes array<int>, ids array<long>, digests array<binary>")
    name = f"chunks_{fresh_path(spark, '').rpartition('-')[2]}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a task's chunks go to files by chunk without an exchange, and later joins on chunk need none for them
    read.write.option("compression", "zstd").option("path", fresh_path(spark, "chunks")).bucketBy(parts, "chunk").saveAsTable(name)
    chunks = spark.table(name)
    size = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    total = chunks.agg(F.sum(size)).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))

    copies = chunks.select("chunk", F.posexplode(F.arrays_zip("digests", "sizes")).alias("k", "d")).where(F.col("d.sizes") >= length)
    copies = copies.select("chunk", "k", F.col("d.digests").alias("digest"))
    twice = copies.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct("chunk", "k")).alias("one")).where("n > 1")
    copies = copies.join(twice, "digest").groupBy("chunk").agg(
        F.collect_list(F.struct("k", ((F.col("chunk") != F.col("one.chunk")) | (F.col("k") != F.col("one.k"))).alias("spare"))).alias("copies"))
    copies = written(copies, "copies")

    def opened(row, powers: Powers) -> Chunk:
        active = np.ones(len(row["sizes"]), dtype=bool)
        for c in row["copies"] if row["copies"] is not None else ():
            active[c["k"]] &= not c["spare"]
        return Chunk(row["data"], np.asarray(row["sizes"], dtype=np.int64), active, powers, length)

    def samples_of(chunk: Chunk):
        at = chunk.samples()
        return at, chunk.fingerprints(at, chunk.sample_length), None

    def strings_of(chunk: Chunk, row):
        at, values, _ = samples_of(chunk)
        at = chunk.candidates(at, _told(values, None, row["samples"] if row["samples"] is not None else ()))
        return at, chunk.fingerprints(at, length), chunk.checks(at, length)

    def repeated(source: DataFrame, values_of, checked: bool) -> DataFrame:
        """(chunk, answers): for each value of a chunk whether it occurs elsewhere."""
        def send(batches):
            powers = Powers()
            for batch in batches:
                for row in batch.to_dict("records"):
                    _, values, checks = values_of(opened(row, powers), row)
                    blobs = _packed(values, checks, buckets)
                    yield pd.DataFrame({"bucket": [b for b, _ in blobs], "chunk": row["chunk"], "blob": [x for _, x in blobs]})

        def compare(batches):
            width, size = (WIDE, WIDE + 4) if checked else (NARROW, NARROW)
            for g in sorted_groups(batches, ["bucket"]):
                blobs = [np.frombuffer(x, dtype=np.uint8).reshape(-1, size) for x in g["blob"]]
                packed = np.concatenate(blobs)
                values = np.zeros((len(packed), 8), dtype=np.uint8)
                values[:, :width] = packed[:, :width]
                values = values.view(np.uint64).ravel()
                order = np.argsort(values)
                same = values[order[1:]] == values[order[:-1]]
                if checked:
                    checks = np.ascontiguousarray(packed[:, width:]).view(np.uint32).ravel()
                    if _torn(values[order], checks[order]):
                        order = np.lexsort((checks, values))
                        same = values[order[1:]] == values[order[:-1]]
                    same &= checks[order[1:]] == checks[order[:-1]]
                again = np.zeros(len(values), dtype=bool)
                again[order[1:]] |= same
                again[order[:-1]] |= same
                cuts = np.cumsum([len(b) for b in blobs])[:-1]
                bits = [np.packbits(x).tobytes() for x in np.split(again, cuts)]
                yield pd.DataFrame({"bucket": g["bucket"], "chunk": g["chunk"], "n": [len(b) for b in blobs], "bits": bits})

        sent = source.mapInPandas(send, "bucket int, chunk long, blob binary")
        told = sent.repartition("bucket").sortWithinPartitions("bucket", "chunk").mapInPandas(compare, "bucket int, chunk long, n int, bits binary")
        return written(told.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "n", "bits")).alias("answers")), "answers")

    def finish(batches):
        powers = Powers()
        for batch in batches:
            for row in batch.to_dict("records"):
                chunk = opened(row, powers)
                at, values, checks = strings_of(chunk, row)
                at = at[_told(values, checks, row["strings"] if row["strings"] is not None else ())]
                edge = np.zeros(len(chunk.bytes) + 1, dtype=np.int32)
                edge[at] += 1
                np.add.at(edge, at + length, -1)
                gone = np.cumsum(edge[:-1]) > 0
                for c in row["copies"] if row["copies"] is not None else ():
                    gone[chunk.ends[c["k"]] - row["sizes"][c["k"]]:chunk.ends[c["k"]]] = True
                out = []
                for doc_id, end, n in zip(row["ids"], chunk.ends, row["sizes"], strict=True):
                    g, b = gone[end - n:end], chunk.bytes[end - n:end]
                    left = b[~g].tobytes()
                    spans = int(g[:1].sum() + (g[1:] & ~g[:-1]).sum())
                    out.append((None if pd.isna(doc_id) else int(doc_id), int(n), int(g.sum()), spans, hashlib.sha256(left).hexdigest(), left))
                yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]).astype({"doc_id": "Int64"})

    with _small_batches(spark):
        first = chunks.join(copies, "chunk", "left")
        second = first.join(repeated(first, lambda c, row: samples_of(c), False).withColumnRenamed("answers", "samples"), "chunk", "left")
        answers = repeated(second, strings_of, True).withColumnRenamed("answers", "strings")
        return written(second.join(answers, "chunk", "left").mapInPandas(
            finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"), "cut")
