"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

Rotations that make the signs of the rotated components balanced and close to them are learned on a bounded sample (principal
axes, then alternating signs and orthogonal fits). The signs of all vectors under all rotations are cut into substrings, each the key of one
table; vectors that agree in a substring and are near in the whole code are candidates, and the original vectors, in double
precision, decide. Substrings have 16 bits, one more for each doubling beyond a million vectors. Tables are added until probes, sampled vectors and
made ones at exactly the threshold, meet in one of them as often as `recall` says, so it holds for any number of components and any distribution.
Every vector is in every table.

Each number of components is an index of its own with its own rotations. Where at most `block_rows` different vectors have it, all of these are compared.

Equal vectors become one class with a count first. A bucket of more than `block_rows` classes is compared block by block in
several tasks; tasks return sums and a spanning forest, never the pairs. A pair that meets in several tables counts in the first.

Vectors that are null, empty, zero, or hold null or non-finite components link with nothing; nor do vectors of different numbers of components with
each other. Ids are taken as unique; rows without id are left out. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideway.llm.common import components, forest, sorted_groups, written
from tideway.llm.topk import finite


@dataclass(frozen=True)
class Index:
    """Signs under `turns` (components × bits of all rotations) make `tables` keys of `width` bits; codes `unlike` bits apart or less are compared."""

    mean: np.ndarray
    turns: np.ndarray
    width: int
    tables: int
    unlike: int

    def keys(self, unit: np.ndarray) -> np.ndarray:
        signs = (unit - self.mean) @ self.turns >= 0
        powers = 1 << np.arange(self.width)
        return np.stack([signs[:, t * self.width:(t + 1) * self.width] @ powers for t in range(self.tables)], axis=1).astype(np.int32)


def _rotations(sample: np.ndarray, bits: int, rounds: int, seed: int):
    """(mean, endless projections of shape components × bits) from unit vectors."""
    rng = np.random.default_rng(seed)
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, :min(bits, sample.shape[1])]
    flat = centred @ axes

    def turns():
        while True:
            turn = np.linalg.qr(rng.standard_normal((axes.shape[1],) * 2))[0]
            for _ in range(rounds):
                signs = np.where(flat @ turn >= 0, 1.0, -1.0)
                left, _, right = np.linalg.svd(signs.T @ flat)
                turn = (left @ right).T
            yield axes @ turn

    return mean, turns()


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int32)


def learn(sample: np.ndarray, *, threshold: float, width: int, recall: float, bits: int = 64, rounds: int = 40, least: int = 12, most: int = 128,
          probes: int = 2000, seed: int = 7) -> Index:
    """An index from unit vectors, with `least` to `most` tables."""
    mean, turns = _rotations(sample, bits, rounds, seed)
    rng = np.random.default_rng(seed + 1)
    x = sample[:probes]
    noise = rng.standard_normal(x.shape)
    noise -= (noise * x).sum(axis=1, keepdims=True) * x
    noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-300)
    y = threshold * x + np.sqrt(max(0.0, 1 - threshold * threshold)) * noise
    made = np.zeros((sample.shape[1], 0))
    for tables in range(least, most + 1):
        while made.shape[1] < tables * width:
            made = np.concatenate([made, next(turns)], axis=1)
        index = Index(mean, made[:, :tables * width], width, tables, 0)
        differ = _differing(index.keys(x), index.keys(y))
        found = (differ == 0).any(axis=1)
        if found.mean() >= recall:
            break
    # random codes differ in half of the bits
    unlike = max(tables * width // 4, int(np.quantile(differ.sum(axis=1)[found], 0.999)) if found.any() else 0)
    return Index(mean, index.turns, width, tables, unlike)


def _unit(vectors) -> np.ndarray:
    v = np.stack([np.asarray(x, dtype=np.float64) for x in vectors])
    v /= np.abs(v).max(axis=1, keepdims=True)  # no overflow in the squares
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def near_duplicates(vectors: DataFrame, *, threshold: float = 0.95, sample: int = 10_000, recall: float = 0.93, block_rows: int = 1024) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of `vectors` (vec_id, embedding).

    `sample` bounds the different vectors from which the rotations of one number of components are learned, hence what the driver holds at a time.
    """
    rows = vectors.where("vec_id is not null").select(
        "vec_id", "embedding", (finite(F.col("embedding")) & F.exists("embedding", lambda x: x != 0)).alias("whole"))
    digest = [F.xxhash64("embedding").alias("h"), F.xxhash64(F.lit(1), "embedding").alias("g")]
    hashed = rows.where("whole").select("vec_id", "embedding", *digest)
    classes = written(hashed.groupBy("h", "g").agg(F.min("vec_id").alias("id"), F.count("*").alias("n"), F.first("embedding").alias("embedding"))
                      .withColumn("size", F.size("embedding")), "vectors")
    indexes = {}
    for size, n in classes.groupBy("size").count().where(F.col("count") > block_rows).collect():
        # equal vectors count once, and about `sample` rows leave their tasks
        drawn = F.pmod("h", F.lit(2**30)) < min(2**30, -(-sample * 2**30 // n))
        learned = classes.where((F.col("size") == size) & drawn).select("embedding").limit(sample).toPandas()["embedding"]
        width = min(30, max(16, int(n).bit_length() - 4))
        indexes[size] = learn(_unit(learned), threshold=threshold, width=width, recall=recall)

    def encode(batches):
        for batch in batches:
            for size, part in batch.groupby("size"):
                index = indexes.get(size)
                keys = np.zeros((len(part), 1), dtype=np.int32) if index is None else index.keys(_unit(part["embedding"]))
                yield pd.DataFrame({"id": part["id"], "size": size, "n": part["n"], "keys": list(keys)})

    coded = written(classes.select("id", "size", "n", "embedding").mapInPandas(encode, "id long, size int, n long, keys array<int>"), "codes")
    entries = coded.select("id", "size", F.posexplode("keys").alias("t", "key"))
    shared = entries.groupBy("size", "t", "key").agg(F.count("*").alias("m")).where("m > 1")
    blocks = F.ceil(F.col("m") / block_rows).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    entries = (entries.join(shared, ["size", "t", "key"]).withColumn("mine", F.pmod(F.xxhash64("id"), blocks).cast("int")).withColumn("other", other)
               .select("size", "t", "key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "id"))
    group = ["size", "t", "key", "i", "j"]

    def apart(g: pd.DataFrame) -> np.ndarray:
        """Pairs to compare: all others of a block, or those of the other block."""
        mine = g["mine"].to_numpy()
        if g["i"].iloc[0] == g["j"].iloc[0]:
            return ~np.eye(len(g), dtype=bool)
        return mine[:, None] != mine[None, :]

    def alive(batches):
        """Rows of a bucket with another one whose whole code is near."""
        for g in sorted_groups(batches, group):
            if len(g) < 2:
                continue
            keys, index = np.stack(g["keys"].to_numpy()), indexes.get(g["size"].iloc[0])
            differ = np.zeros((len(g), len(g)), dtype=np.int32)
            for c in range(keys.shape[1]):
                differ += _differing(keys[:, None, c], keys[None, :, c])
            near = (differ <= (0 if index is None else index.unlike)) & apart(g)
            if (hit := near.any(axis=1)).any():
                yield g[hit]

    found = entries.join(coded.drop("size"), "id").repartition(*group).sortWithinPartitions(*group).mapInPandas(
        alive, "id long, size int, t int, key int, i int, j int, mine int, n long, keys array<int>")
    found = written(found.select("id", "size", "t", "key", "i", "j", "mine", "n", "keys"), "alive")

    def verify(batches):
        for g in sorted_groups(batches, group):
            if len(g) < 2:
                continue
            keys, t = np.stack(g["keys"].to_numpy()), g["t"].iloc[0]
            unit, ids, n = _unit(g["embedding"]), g["id"].to_numpy(), g["n"].to_numpy()
            near = (unit @ unit.T >= threshold) & apart(g)
            fresh = near.copy()
            for c in range(t):
                fresh &= keys[:, None, c] != keys[None, :, c]
            order = np.argsort(ids)
            label = np.empty(len(ids), dtype=np.int64)
            label[order] = ids[order][forest(near[np.ix_(order, order)])]
            if near.any():
                yield pd.DataFrame({"id": ids, "links": fresh @ n, "least": label})

    checked = written(
        found.join(classes.select("id", "embedding"), "id").repartition(*group).sortWithinPartitions(*group)
        .mapInPandas(verify, "id long, links long, least long"), "checked")
    linked = components(checked.select(F.col("id").alias("a"), F.col("least").alias("b")))
    sums = checked.groupBy("id").agg(F.sum("links").alias("links"))
    result = (classes.select("h", "g", "id", "n").join(sums, "id", "left").join(linked, "id", "left")
              .select("h", "g", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id")))
    keyed = hashed.select("vec_id", "h", "g")
    return keyed.join(result, ["h", "g"]).select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept")).union(
        rows.where("whole is null or not whole").select("vec_id", F.lit(0).cast("long"), "vec_id", F.lit(True)))
