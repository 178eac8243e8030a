"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard similarity.

Texts are lower-cased (A to Z) and cut at white space; a document's set holds its distinct shingles of `shingle` words, or the whole sequence if there
are fewer words. One permutation (a 64-bit mixing of the shingle's hash, of which 32 bits are kept) scatters the shingles over a circle of 2³² places; a second one,
circularly shifted by k, gives the k-th signature coordinate. Documents that agree in all rows of a band are candidates: at similarity 0.8 thirty-two
bands of five rows miss 3 in a million. Candidates are confirmed on their full sets.

Documents with equal sets become one class before anything else. Within a band, classes are checked against few leaders first; bands in which some are still apart are
compared block by block in tasks that return a forest of links (see `common.link`). Null, empty and blank texts have no shingles and link with nothing. Repeated doc_ids are rows of
their own but share the smallest id of their group; a null doc_id counts as greater than all others. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideway.llm.common import forest, link, released, sorted_groups, written

BANDS, ROWS = 32, 5
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


def _mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only ASCII is lower-cased and white space
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.array([xxh64_intdigest(w) for w in words], dtype=np.uint64)
    n = min(size, len(words))
    total = np.full(len(words) - n + 1, n, dtype=np.uint64)
    for j in range(n):
        total += _mix64(hashes[j:len(words) - n + 1 + j] * ODD[j % len(ODD)] + np.uint64(j))
    return np.unique(_mix64(total))


def signature(values: np.ndarray, coordinates: int) -> np.ndarray:
    """The smallest place of any shingle under the second permutation, for each of its shifts."""
    places = (_mix64(values ^ ODD[1]) >> np.uint64(32)).astype(np.uint32)
    shifts = np.arange(coordinates, dtype=np.uint32)[:, None]
    out = np.full(coordinates, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(places), 1024):
        x = places[None, at:at + 1024] - shifts
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x7FEB352D)
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x846CA68B)
        x ^= x >> np.uint32(16)
        np.minimum(out, x.min(axis=1), out=out)
    return out


def band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = signature(values, bands * rows).reshape(bands, rows).astype(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64) * ODD[2]
    for r in range(rows):
        key = _mix64(key + parts[:, r] * ODD[3])
    return key.view(np.int64)


def groups(docs: DataFrame, *, shingle: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS, block_sets: int = 128) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, row): one row per row of `docs`; `kept` holds for the row that stands for its group."""

    def sign(batches):
        for batch in batches:
            out = []
            for text in batch["text"]:
                values = shingles(text, shingle)
                if len(values):
                    g, h = int(values.sum()), int(np.bitwise_xor.reduce(_mix64(values + ODD[4])))
                    out.append((len(values), g - 2**64 * (g >> 63), h - 2**64 * (h >> 63), band_keys(values, bands, rows)))
                else:
                    out.append((0, None, None, None))
            sets = pd.DataFrame(out, columns=["n", "g", "h", "keys"]).astype({"g": "Int64", "h": "Int64"})
            yield pd.concat([batch[["doc_id", "t"]].astype({"doc_id": "Int64"}).reset_index(drop=True), sets], axis=1)

    text = docs.select("doc_id", "text", F.xxhash64("text").alias("t"))
    signed = written(
        text.mapInPandas(released(sign), "doc_id long, t long, n long, g long, h long, keys array<long>").withColumn("row", F.monotonically_increasing_id()), "signed")
    of_set = ["n", "g", "h"]
    classes = written(
        signed.where("n > 0").groupBy(*of_set).agg(F.min(F.struct("row", "doc_id", "t", "keys")).alias("one"))
        .select(*of_set, F.col("one.row").alias("id"), F.col("one.doc_id").alias("doc_id"), F.col("one.t").alias("t"), F.col("one.keys").alias("keys")), "sets")

    full_sets: dict[str, DataFrame] = {}

    def verify(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        wanted = classes.select("id", "doc_id", "t").join(wanted, "id").withColumnRenamed("doc_id", "d")

        def full(batches):
            for batch in batches:
                yield pd.DataFrame({"id": batch["id"], "s": [shingles(x, shingle).view(np.int64) for x in batch["text"]]})

        # every id that shares a bucket is in a first pair, so this is all that is ever needed
        sets = full_sets["sets"] = written(
            text.join(wanted, (text["t"] == wanted["t"]) & text["doc_id"].eqNullSafe(wanted["d"])).select("id", "text")
            .dropDuplicates(["id"]).mapInPandas(released(full), "id long, s array<long>"), "full")
        both = pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("x")), "a").join(
            sets.select(F.col("id").alias("b"), F.col("s").alias("y")), "b")
        common = F.size(F.array_intersect("x", "y"))
        sizes = F.size("x") + F.size("y")
        return both.where(F.least(F.size("x"), F.size("y")) * 100 >= percent * F.greatest(F.size("x"), F.size("y"))).where(
            100 * common >= percent * (sizes - common)).select("a", "b")

    block = ["key", "i", "j"]

    def compare(batches):
        """Links within a block, or between two blocks, of a bucket: all intersections at once. Of the links between classes known so far
        a forest is returned, as links of the ids that name the classes; links within a class tell nothing new."""
        for g in sorted_groups(batches, block):
            sizes = g["s"].map(len).to_numpy()
            _, code, counts = np.unique(np.concatenate(g["s"].to_numpy()), return_inverse=True, return_counts=True)
            row, shared = np.repeat(np.arange(len(g)), sizes), counts > 1
            column = np.cumsum(shared) - 1
            common = np.zeros((len(g), len(g)), dtype=np.float32)
            keep = shared[code]
            row, code = row[keep], column[code[keep]]
            order = np.argsort(code, kind="stable")
            row, code = row[order], code[order]
            for at in range(0, int(shared.sum()), 4096):
                a, b = np.searchsorted(code, [at, at + 4096])
                part = np.zeros((len(g), 4096), dtype=np.float32)
                part[row[a:b], code[a:b] - at] = 1
                common += part @ part.T
            near = 100 * common.astype(np.int64) >= percent * (sizes[:, None] + sizes[None, :] - common.astype(np.int64))
            mine = g["mine"].to_numpy()
            if g["i"].iloc[0] != g["j"].iloc[0]:
                near &= mine[:, None] != mine[None, :]
            names, of = np.unique(g["component"].to_numpy(), return_inverse=True)
            a, b = np.nonzero(near & (of[:, None] != of[None, :]))
            if len(a):
                joined = np.zeros((len(names), len(names)), dtype=bool)
                joined[of[a], of[b]] = True
                root = forest(joined)
                moved = np.flatnonzero(root != np.arange(len(names)))
                yield pd.DataFrame({"a": names[moved], "b": names[root[moved]]})

    def settle(rows: DataFrame) -> DataFrame:
        """Buckets in blocks of `block_sets` sets, outside and inside the head's class apart. Every two blocks meet in a task of their own, but
        for two of the head's class, whose sets are linked already: no pair leaves its task unless it is needed."""
        out = F.col("component") != F.col("head")
        blocks = [F.ceil(F.count_if(x) / block_sets).cast("int").alias(n) for x, n in ((out, "b_out"), (~out, "b_head"))]
        here = F.xxhash64("id")
        mine = F.when(out, F.pmod(here, "b_out")).otherwise(F.col("b_out") + F.pmod(here, "b_head")).cast("int")
        last = F.col("b_out") - 1 + F.when(out, F.col("b_head")).otherwise(0)
        dealt = rows.join(rows.groupBy("key").agg(*blocks), "key").select(
            "key", "id", "component", mine.alias("mine"), F.explode(F.sequence(F.lit(0), last)).alias("other"))
        dealt = dealt.select("key", "id", "component", "mine", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
        return (dealt.join(full_sets["sets"], "id").repartition(*block).sortWithinPartitions(*block)
                .mapInPandas(released(compare), "a long, b long"))

    linked = link(classes.select(F.explode("keys").alias("key"), "id"), verify, settle)
    sets = classes.select(*of_set, "id").join(linked, "id", "left").withColumn("component", F.coalesce("component", "id"))
    rows_ = signed.select("doc_id", "row", *of_set)
    whole = rows_.where("n > 0").join(sets.select(*of_set, "component"), of_set)
    heads = whole.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("head"))
    whole = whole.join(heads, "component").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("head.doc_id").alias("component_id"), (F.col("row") == F.col("head.row")).alias("kept"))
    return whole.union(rows_.where("n = 0").select("doc_id", "n", "doc_id", F.lit(True)))
