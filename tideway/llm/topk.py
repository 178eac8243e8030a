"""Exact top-k inner products by three phases with a uniform threshold.

Queries and rows are cut into blocks; a task holds one block of each. Every component range is one list of partial scores.
Phase 1 reads the local lists, takes the k best entries of each and looks up what the other lists say of them; the k-th best of all is a score t that the
answer reaches. Phase 2 ships t with each query. A row of the answer has a partial score of at least t / lists in some list, as the partial scores add up
to t or more. Lists are read one after another, for the rows only that may still be in the answer: what is known of a row, with the product of the lengths of both
vectors' parts in each unread list, reaches t, and a read list had the cutoff t / lists or an unread one may have it. Phase 3 resolves the scores of the few that remain
when less than an eighth do, without reading further lists. Scores are integers, so nothing depends on the order of summation.

Vectors that are null or hold null or non-finite components, and rows without id, take no part. Shorter vectors count as padded with zeros. A query is
one row per id (the smallest vector, if an id is repeated); candidates are all rows with another id, repeated ones as often as they occur. Ties go to the
smaller id. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Neither null nor holding null or non-finite components."""
    return vector.isNotNull() & ~F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))


def _matrix(column: pd.Series) -> np.ndarray:
    width = max((len(v) for v in column), default=0)
    out = np.zeros((len(column), width))
    for i, v in enumerate(column):
        out[i, :len(v)] = v
    return out


def _exact(q: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As doubles where these are exact and fast, otherwise as integers."""
    largest = np.abs(q).max(initial=0) * np.abs(v).max(initial=0) * max(1, q.shape[1])
    return (q, v) if largest < 2**53 else (q.astype(np.int64), v.astype(np.int64))


def _parts(width: int, lists: int) -> list[slice]:
    cuts = np.linspace(0, width, lists + 1).astype(int)
    return [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _lengths(m: np.ndarray, parts: list[slice]) -> np.ndarray:
    return np.stack([np.linalg.norm(m[:, p].astype(np.float64), axis=1) for p in parts], axis=1)


def above(q: np.ndarray, v: np.ndarray, t: np.ndarray, lists: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query, row, score) of all pairs whose score is at least the query's `t`, and how many list entries and whole scores were worked out for them."""
    parts, work = _parts(q.shape[1], lists), 0
    q_lengths, v_lengths = _lengths(q, parts), _lengths(v, parts)
    # bounds are doubles: a little too large rather than too small
    v_lengths = v_lengths * (1 + 1e-9) + 1e-9
    most = q_lengths @ v_lengths.T
    most += (1e-6 + 1e-9 * (most.max(axis=1, initial=0) + np.abs(t)) - t)[:, None]
    rows = np.flatnonzero((most >= 0).any(axis=0))
    if len(rows) < len(v):
        v, v_lengths, most = v[rows], v_lengths[rows], most[:, rows]
    known, alive, listed = np.zeros(most.shape, dtype=q.dtype), most >= 0, np.zeros(most.shape, dtype=bool)
    cutoff = ((t - 1e-9 * np.abs(t)) / lists)[:, None]
    for r, part in enumerate(parts):
        if 8 * np.count_nonzero(alive) < alive.size or not len(v):
            break
        partial = q[:, part] @ v[:, part].T
        work += partial.size
        known += partial
        listed |= partial >= cutoff
        most += partial
        most -= q_lengths[:, r, None] * v_lengths[:, r]
        alive &= most >= 0
        # a list that is still to be read may have the cutoff for a row if its longest part allows it
        hope = (q_lengths[:, r + 1:].max(axis=1, initial=0)[:, None] * v_lengths[:, r + 1:].max(axis=1, initial=0)) >= cutoff if r + 1 < len(parts) else False
        alive &= listed | hope
        if 2 * np.count_nonzero(left := alive.any(axis=0)) < len(left):
            rows, v, v_lengths = rows[left], v[left], v_lengths[left]
            known, alive, listed, most = (x[:, left] for x in (known, alive, listed, most))
    else:
        i, j = np.nonzero(alive)
        score = known[i, j]
        enough = score >= t[i]
        return i[enough], rows[j[enough]], score[enough], work
    i, j = np.nonzero(alive)
    score = np.concatenate([np.zeros(0, dtype=q.dtype), *((q[i[a:a + 65536]] * v[j[a:a + 65536]]).sum(axis=1) for a in range(0, len(i), 65536))])
    enough = score >= t[i]
    return i[enough], rows[j[enough]], score[enough], work + lists * len(i)


def top_k(vectors: DataFrame, is_query: Column, *, k: int = 20, lists: int = 4, scale: int = 64, block_rows: int = 8192,
          block_queries: int = 512, chunk: int = 64,
          rows_at_once: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score) from `vectors` (vec_id, embedding)."""
    rows = vectors.where(F.col("vec_id").isNotNull() & finite(F.col("embedding"))).select(
        "vec_id", is_query.alias("asked"),
        F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")).alias("v"))
    queries = rows.where("asked").groupBy("vec_id").agg(F.min("v").alias("v"))
    sizes = rows.agg(F.count("*"), F.count_if("asked")).first()
    across, down = max(1, -(-sizes[0] // block_rows)), max(1, -(-sizes[1] // block_queries))
    # by a hash of the row and not by its place, which may be another one when a task runs again; of equal rows k can be in an answer
    copies = rows.groupBy("vec_id", "v").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("n"))
    copies = copies.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n"))))
    candidates = copies.withColumn("across", F.pmod(F.xxhash64("vec_id", "v", "copy"), F.lit(across))).select(
        F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("down"), F.col("across").cast("int").alias("across"),
        F.lit(False).alias("asked"), "vec_id", "v", F.lit(None).cast("long").alias("least"))

    def cells(queries: DataFrame, answer, schema: str) -> DataFrame:
        dealt = queries.select(
            F.pmod(F.xxhash64("vec_id"), F.lit(down)).cast("int").alias("down"),
            F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("across"), F.lit(True).alias("asked"), "vec_id", "v", "least")
        # many small groups in a task would each wait for the last; a cell is large enough to be one group
        return candidates.unionByName(dealt).groupBy("down", "across").applyInPandas(answer, schema)

    def answer(cell: pd.DataFrame) -> pd.DataFrame:
        """The local part of a phase: entries (query_id, vec_id, score) that may be in the answer."""
        asked, there = cell[cell["asked"]], cell[~cell["asked"]]
        found = []
        if len(asked) and len(there):
            every = _matrix(pd.concat([asked["v"], there["v"]]))
            q, v = _exact(every[:len(asked)], every[len(asked):])
            q_ids, v_ids = asked["vec_id"].to_numpy(), there["vec_id"].to_numpy()
            least = asked["least"].to_numpy(dtype=float, na_value=np.nan)
            for at in range(0, len(q), chunk):
                some, t = q[at:at + chunk], least[at:at + chunk]
                if np.isnan(t[0]):
                    partial = [some[:, p] @ v[:, p].T for p in _parts(q.shape[1], lists)]
                    entries = []
                    for i in range(len(some)):
                        seen = np.unique(np.concatenate([
                            np.arange(len(v)) if len(v) <= k + 1 else np.argpartition(p[i], -k - 1)[-k - 1:] for p in partial]))
                        entries.append((seen, sum(p[i, seen] for p in partial)))
                else:
                    # parts that a processor's cache holds
                    hits = [(i, j + b, score) for b in range(0, len(v), rows_at_once)
                            for i, j, score, _ in [above(some, v[b:b + rows_at_once], t, lists)]]
                    i, j, score = (np.concatenate(x) for x in zip(*hits, strict=True))
                    order = np.argsort(i, kind="stable")
                    i, j, score = i[order], j[order], score[order]
                    cuts = np.searchsorted(i, np.arange(len(some) + 1))
                    entries = [(j[a:b], score[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                for i, (seen, scores) in enumerate(entries):
                    other = v_ids[seen] != q_ids[at + i]
                    seen, scores = seen[other], scores[other]
                    best = np.lexsort((v_ids[seen], -scores))[:k]
                    found.append(pd.DataFrame({"query_id": q_ids[at + i], "vec_id": v_ids[seen[best]], "score": scores[best].astype(np.int64)}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

    schema = "query_id long, vec_id long, score long"
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def best(entries: DataFrame) -> DataFrame:
        return entries.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)

    first = best(cells(queries.withColumn("least", F.lit(None).cast("long")), answer, schema))
    # with fewer than k entries nothing may be cut off
    least = first.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("least"))
    lowest = F.coalesce("least", F.lit(-(2**62)))
    cut = queries.join(least, F.col("vec_id") == F.col("query_id"), "left").select("vec_id", "v", lowest.alias("least"))
    return best(cells(cut, answer, schema)).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
