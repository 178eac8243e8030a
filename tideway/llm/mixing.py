"""Mixing by iterative proportional fitting: token weights raked to source, language and topic marginals, then sampling.

Documents fall into cells (source, language, topic) with their tokens (blank-separated words). A cell's weight is scaled by the quotient of wanted and present
share of its source, its language and its topic in turn until nothing changes by more than `tolerance`. Expected tokens have the shares of the weighted ones:
probabilities are fitted to them in the same way, with cells at 1 held there. A category can't give more than its tokens. So without a budget the expected
tokens are the largest part of all, at most `MOST`, with which the shares can be had. A budget `keep` is spent in any case; what it makes unreachable is logged, and the rest is spread as the shares
of the others are. A document is taken if a number drawn from its id
and text is below its cell's probability, so a run can be repeated.

Topics are learned: trigram profiles of all documents, less the mean of their language, grouped by spherical k-means; every
document goes to the nearest centre. Sums of profiles are made in Spark in whole numbers, so their order doesn't matter; the first centres are documents drawn by hash. Null source and language are categories of their own, null text is empty (0 tokens); a table without tokens keeps all rows. Extra columns pass
through; columns named like the new ones are replaced. Repeated rows share their fate.
"""

from __future__ import annotations

import logging
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideway.llm.common import released, written

SIDES = ("source", "lang", "topic")
MOST_CELLS = 200_000  # on the driver; results don't depend on it
STALLED = 20  # rounds without progress after which shares count as out of reach
SPENT = 100
MOST = 0.9
SIZE = 256  # numbers of a profile
FIRST = 8  # documents looked at for each first centre, as some are equal


def profile(text: str | None, size: int = SIZE) -> np.ndarray:
    """Square roots of the shares of hashed byte trigrams."""
    b = np.frombuffer((text or "").encode("utf-8", "replace"), dtype=np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(size)
    h = (b[:-2] * np.uint32(961) + b[1:-1] * np.uint32(31) + b[2:]) * np.uint32(2654435761) >> np.uint32(16)
    counts = np.bincount(h % size, minlength=size)
    return np.sqrt(counts / counts.sum())


class Topics:
    """Centres of what sets profiles apart from the mean of their language, so that topics cut across languages."""

    def __init__(self, means: dict[str, np.ndarray], mean: np.ndarray):
        self.means, self.mean, self.centres = means, mean, np.zeros((1, len(mean)))

    def apart(self, profiles: np.ndarray, langs: list[str | None]) -> np.ndarray:
        points = profiles - np.stack([self.means.get(str(x), self.mean) for x in langs])
        return points / np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-12)

    def of(self, profiles: np.ndarray, langs: list[str | None]) -> np.ndarray:
        return (self.apart(profiles, langs) @ self.centres.T).argmax(axis=1).astype(np.int32)


def _points(packed) -> np.ndarray:
    return np.frombuffer(b"".join(packed), dtype=np.float32).reshape(-1, SIZE).astype(np.float64)


UNIT = 2**30
SUMS = "k string, i int, s long"
PACK = 1000  # profiles of a language in a row


def _packs(known: DataFrame) -> DataFrame:
    """Rows (lang, p) with up to `PACK` profiles each, as every round reads all of them."""

    def run(batches):
        for batch in batches:
            langs, packs = batch.column("lang").to_pylist(), batch.column("p").to_pylist()
            by: dict[str | None, list[bytes]] = {}
            for lang, p in zip(langs, packs, strict=True):
                by.setdefault(lang, []).append(p)
            rows = [(lang, b"".join(ps[i:i + PACK])) for lang, ps in by.items() for i in range(0, len(ps), PACK)]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows], pa.string()), pa.array([x for _, x in rows], pa.binary())], names=["lang", "p"])

    return written(known.select("lang", "p").mapInArrow(released(run), "lang string, p binary"), "packs")


def _sums(packs: DataFrame, grouped) -> dict[str, np.ndarray]:
    """Sums of vectors by name; `grouped` turns the profiles of a language into names, the number of each vector's name, and vectors. A task adds up
    its own before the shuffle."""

    def partial(batches):
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, p in zip(batch.column("lang").to_pylist(), batch.column("p"), strict=True):
                names, code, points = grouped(_points([p.as_py()]), lang)
                # whole numbers below 2^53, so that their sums are exact in doubles
                mine = (code[None, :] == np.arange(len(names))[:, None]).astype(np.float64)
                sums = np.concatenate([mine @ np.rint(points * UNIT), mine.sum(axis=1)[:, None]], axis=1).astype(np.int64)
                for name, s in zip(names, sums, strict=True):
                    held[name] = held.get(name, 0) + s
        for name, s in held.items():
            if s[-1]:
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(s), pa.string()), pa.array(np.arange(len(s), dtype=np.int32)), pa.array(s)], names=["k", "i", "s"])

    out: dict[str, dict[int, int]] = {}
    # sums of 2^30 parts in longs: enough for 2^33 vectors
    for r in packs.mapInArrow(partial, SUMS).groupBy("k", "i").agg(F.sum("s").alias("s")).collect():
        out.setdefault(r["k"], {})[r["i"]] = r["s"]
    return {k: np.array([v[i] for i in range(len(v))], dtype=np.float64) for k, v in out.items()}


def _packed(texts) -> list[bytes]:
    return [profile(x).astype(np.float32).tobytes() for x in texts]


def learn_topics(docs: DataFrame, topics: int, sample: int | None = None, rounds: int = 25, seed: int = 11) -> Topics:
    """From all documents with text. The driver gets one mean per language and the centres; the first centres are profiles of documents drawn by hash,
    different ones among at most `sample` (`FIRST` for each centre)."""

    def profiles(batches):
        for batch in batches:
            yield pd.DataFrame({"h": batch["h"], "lang": batch["lang"], "p": _packed(batch["text"])})

    known = docs.where("text is not null").select(F.xxhash64("doc_id", "text").alias("h"), F.col("lang").cast("string").alias("lang"), "text")
    return _learn(written(known.mapInPandas(profiles, "h long, lang string, p binary"), "profiles"), topics, sample, rounds, seed)


def _learn(known: DataFrame, topics: int, sample: int | None = None, rounds: int = 25, seed: int = 11) -> Topics:
    """From profiles (h, lang, p)."""
    packs = _packs(known)
    by_lang = _sums(packs, lambda points, lang: ([str(lang)], np.zeros(len(points), dtype=np.int64), points))
    n = sum(s[-1] for s in by_lang.values()) or 1.0
    all_sums = sum((s[:-1] for s in by_lang.values()), np.zeros(SIZE))
    learned = Topics({k: s[:-1] / s[-1] / UNIT for k, s in by_lang.items()}, all_sums / n / UNIT)
    # a few rows of each task: those that come first by another hash
    first = known.orderBy(F.xxhash64(F.lit(seed), "h"), "h", "p", "lang").limit(sample or FIRST * topics).toPandas().drop_duplicates(["p", "lang"])[:topics]
    if not len(first):
        return learned
    centres = learned.apart(np.stack([np.frombuffer(p, dtype=np.float32).astype(np.float64) for p in first["p"]]), list(first["lang"]))
    for _ in range(rounds):

        def nearest(points: np.ndarray, lang: str | None, learned=learned, centres=centres):
            points = learned.apart(points, [lang])
            return [str(k) for k in range(len(centres))], (points @ centres.T).argmax(axis=1), points

        sums = _sums(packs, nearest)
        new = np.stack([sums[str(k)][:-1] if str(k) in sums else c for k, c in enumerate(centres)])
        new /= np.maximum(np.linalg.norm(new, axis=1, keepdims=True), 1e-12)
        if np.array_equal(new, centres):
            break
        centres = new
    learned.centres = centres
    return learned


class _Cells:
    """Cells (source, lang, topic, tokens) by codes of their categories. A cell's value is the product of a factor of its source, its language and its
    topic. Sums are made of whole units, 2^-50 of all tokens, so that they are the same in whatever order, on the driver or in Spark."""

    wanted: list[np.ndarray]  # shares by side and code
    there: list[np.ndarray]   # tokens by side and code

    def __init__(self):
        self.total = float(self.there[0].sum())
        self.unit = 2.0 ** (np.ceil(np.log2(max(self.total, 1.0))) - 50)
        self.wanted = [w * (t > 0) for w, t in zip(self.wanted, self.there, strict=True)]
        self.wanted = [w / (math.fsum(w) or 1.0) * self.total for w in self.wanted]

    def even(self) -> list[np.ndarray]:
        return [np.ones(len(t)) for t in self.there]

    def parts(self, codes: list[np.ndarray], tokens: np.ndarray, factors: list[np.ndarray], most: float) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of each cell if its value is `most` or more, and units of its value times its tokens if it is less."""
        x = _product(codes, factors)
        full = x >= most
        return np.where(full, tokens, 0), np.where(full, 0.0, np.rint(np.where(full, 0.0, x) * tokens / self.unit))


def _product(codes: list[np.ndarray], factors: list[np.ndarray]) -> np.ndarray:
    return factors[0][codes[0]] * factors[1][codes[1]] * factors[2][codes[2]]


class _Near(_Cells):
    """Cells on the driver."""

    def __init__(self, cells: DataFrame, shares: dict[str, DataFrame]):
        self.spark, self.cells = cells.sparkSession, cells.toPandas()
        self.tokens = self.cells["tokens"].to_numpy(dtype=np.int64)
        coded = [pd.factorize(self.cells[side]) for side in SIDES]
        self.codes, self.names_ = [c for c, _ in coded], [list(n) for _, n in coded]
        self.there = [np.bincount(c, self.tokens, len(n)) for c, n in coded]
        given = [{r[side]: r["share"] for r in shares[side].select(side, "share").collect()} for side in SIDES]
        self.wanted = [np.array([float(g.get(x) or 0.0) for x in names]) for g, names in zip(given, self.names_, strict=True)]
        super().__init__()

    def sums(self, side: int, factors: list[np.ndarray], most: float) -> tuple[np.ndarray, np.ndarray]:
        taken, rest = self.parts(self.codes, self.tokens, factors, most)
        code, n = self.codes[side], len(self.there[side])
        return np.bincount(code, taken, n), np.bincount(code, rest, n) * self.unit

    def largest(self, factors: list[np.ndarray]) -> float:
        return float(_product(self.codes, factors)[self.tokens > 0].max())

    def names(self, side: int, codes: list[int]) -> list[str]:
        return [self.names_[side][k] for k in codes]

    def rows(self, **values: list[np.ndarray]) -> DataFrame:
        """The cells with the given values, which are small enough to be sent to every task."""
        made = {name: _product(self.codes, factors) for name, factors in values.items()}
        rows = self.cells[[*SIDES, "tokens"]].assign(**made)
        return F.broadcast(self.spark.createDataFrame(rows, ", ".join(["source string, lang string, topic string, tokens long", *[f"{n} double" for n in made]])))


class _Far(_Cells):
    """Cells in Spark. The driver holds one factor per category, not the cells and not the names."""

    def __init__(self, cells: DataFrame, shares: dict[str, DataFrame]):
        spark = cells.sparkSession
        self.named, self.there, self.wanted = [], [], []
        for side in SIDES:
            there = cells.groupBy(side).agg(F.sum("tokens").alias("there"))
            there = written(there.join(shares[side].select(side, "share"), side, "left").select(side, "there", F.coalesce("share", F.lit(0.0)).alias("share")), "categories")
            numbered = there.rdd.zipWithIndex().map(lambda r: (*r[0], r[1]))
            named = written(spark.createDataFrame(numbered, f"{side} string, there long, share double, _{side} long"), "categories")
            by_code = named.select("there", "share", F.col(f"_{side}").alias("code")).toArrow().to_pandas().sort_values("code")
            self.named.append(named)
            self.there.append(by_code["there"].to_numpy(dtype=np.float64))
            self.wanted.append(by_code["share"].to_numpy(dtype=np.float64))
            cells = cells.join(named.select(side, f"_{side}"), side)
        self.cells = written(cells.select(*SIDES, "tokens", *[f"_{side}" for side in SIDES]), "cells")
        super().__init__()

    def sums(self, side: int, factors: list[np.ndarray], most: float) -> tuple[np.ndarray, np.ndarray]:
        parts = _Cells.parts
        unit = type("Unit", (), {"unit": self.unit})

        def partial(batches):
            for batch in batches:
                codes = [batch[f"_{x}"].to_numpy() for x in SIDES]
                taken, rest = parts(unit, codes, batch["tokens"].to_numpy(), factors, most)
                code, at = np.unique(codes[side], return_inverse=True)
                yield pd.DataFrame({"code": code, "taken": np.bincount(at, taken, len(code)).astype(np.int64), "rest": np.bincount(at, rest, len(code)).astype(np.int64)})

        rows = self.cells.select("tokens", *[f"_{x}" for x in SIDES]).mapInPandas(partial, "code long, taken long, rest long")
        got = rows.groupBy("code").agg(F.sum("taken").alias("taken"), F.sum("rest").alias("rest")).toArrow().to_pandas().sort_values("code")
        return got["taken"].to_numpy(dtype=np.float64), got["rest"].to_numpy(dtype=np.float64) * self.unit

    def _of(self, factors: list[np.ndarray]):
        @F.pandas_udf("double")
        def of(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
            return pd.Series(_product([x.to_numpy() for x in (a, b, c)], factors))

        return of(*[f"_{x}" for x in SIDES])

    def largest(self, factors: list[np.ndarray]) -> float:
        return self.cells.where("tokens > 0").select(self._of(factors).alias("x")).agg(F.max("x")).first()[0]

    def names(self, side: int, codes: list[int]) -> list[str]:
        name = SIDES[side]
        known = {r[1]: r[0] for r in self.named[side].where(F.col(f"_{name}").isin(codes)).select(name, f"_{name}").collect()}
        return [known[k] for k in codes]

    def rows(self, **values: list[np.ndarray]) -> DataFrame:
        return written(self.cells.select(*SIDES, "tokens", *[self._of(f).alias(n) for n, f in values.items()]), "weights")


def _cells(cells: DataFrame, shares: dict[str, DataFrame]) -> _Near | _Far:
    """Many cells stay in Spark, with the same results to the last bit."""
    return _Near(cells, shares) if cells.count() <= MOST_CELLS else _Far(cells, shares)


def _fit(cells: _Near | _Far, wanted: list[np.ndarray], start: list[np.ndarray], most: float, tolerance: float, rounds: int, stalled: int = 200) -> tuple[list[np.ndarray], float]:
    """Factors that give each category its wanted tokens, where a cell's value counts as `most` (1, or no limit) at most; and how far from it the worst
    category is. Ends early if that hasn't become less by a hundredth in `stalled` rounds."""
    factors, off, seen = list(start), 0.0, []
    for _ in range(rounds):
        off = 0.0
        for side, goal in enumerate(wanted):
            for inner in range(4):
                taken, rest = cells.sums(side, factors, most)
                there = taken + rest
                if not inner:
                    off = max(off, float(np.max(np.abs(there - goal) / np.where(goal > 0, goal, 1.0), where=there > 0, initial=0.0)))
                held = (rest > 0) & (goal > taken)
                by = np.where(held, (goal - taken) / np.where(held, rest, 1.0), np.divide(goal, there, out=np.ones(len(goal)), where=there > 0))
                factors[side] = np.minimum(factors[side] * by, 1e12)
                if most == np.inf or (np.abs(by - 1) <= tolerance / 10).all():
                    break  # no cell is held
        seen.append(off)
        if off <= tolerance or (len(seen) > stalled and off > 0.99 * seen[-1 - stalled]):
            break
    return factors, off


def _within(wanted: np.ndarray, there: np.ndarray) -> np.ndarray:
    """The wanted tokens, with what a category doesn't have spread over the others in proportion."""
    full = np.zeros(len(wanted), dtype=bool)
    while True:
        rest = math.fsum(wanted[~full])
        out = np.where(full, there, wanted * ((math.fsum(wanted) - math.fsum(there[full])) / rest if rest else 0.0))
        if not (over := (out > there) & ~full).any():
            return out
        full |= over


def rake(cells: DataFrame, targets: dict[str, DataFrame], *, tolerance: float = 2e-3, rounds: int = 200) -> DataFrame:
    """Cells (source, lang, topic, tokens) with `weight`, such that weighted tokens have the wanted shares.

    `targets`: for each side (side, share); categories that no cell has are left out and the rest scaled to 1.
    """
    held = _cells(cells, targets)
    return held.rows(weight=_fit(held, held.wanted, held.even(), np.inf, tolerance, rounds)[0])


def weigh(cells: DataFrame, shares: dict[str, DataFrame], keep: float | None = None, *, tolerance: float = 2e-3, rounds: int = 200) -> DataFrame:
    """Cells (source, lang, topic, tokens) with weight, as by `rake`, and probability: expected tokens have the shares of weighted ones if the budget
    `keep` allows it; without one they are the largest part of all with which they can."""
    held = _cells(cells, shares)
    total, even = held.total, held.even()
    if not total:
        return held.rows(weight=even, probability=even)
    scaled = lambda c, factors: [c * factors[0], *factors[1:]]
    all_of = lambda sums: math.fsum(sums[0]) + math.fsum(sums[1])
    weight, _ = _fit(held, held.wanted, even, np.inf, tolerance / 10, rounds)
    # contradicting targets are met as far as the weights do
    wanted = [sum(held.sums(side, weight, np.inf)) for side in range(len(SIDES))]
    most = MOST if keep is None else keep
    low = min(most, 1 / max(held.largest(weight), 1e-12))
    high = min([most, *(float((t[w > 0] / w[w > 0]).min()) for t, w in zip(held.there, wanted, strict=True) if (w > 0).any())])
    best, tried = scaled(low, weight), high
    while high > low * 1.001:
        x, off = _fit(held, [tried * w for w in wanted], scaled(tried, weight), 1.0, tolerance, rounds, STALLED)
        if off <= tolerance:
            best, low = x, tried
        else:
            high = tried
        if low == high:
            break
        tried = (low + high) / 2
    reached = all_of(held.sums(2, best, 1.0)) / total
    if keep is not None and reached < keep * (1 - tolerance):
        best, _ = _fit(held, [_within(keep * w, t) for w, t in zip(wanted, held.there, strict=True)], scaled(keep, weight), 1.0, tolerance, rounds)
        for _ in range(SPENT):  # what is full stays so while the rest grows, and the other way round
            taken, rest = (math.fsum(x) for x in held.sums(2, best, 1.0))
            if abs(taken + rest - keep * total) <= 1e-9 * total or (not rest and taken < keep * total):
                break
            c = (keep * total - taken) / rest if rest and keep * total > taken else keep * total / (taken + rest) if taken + rest else 1.0
            best = scaled(c, best)
        off, spent = [], 0.0
        for side, (w, t) in enumerate(zip(wanted, held.there, strict=True)):
            got = sum(held.sums(side, best, 1.0))
            spent = math.fsum(got)
            missed = [int(k) for k in np.flatnonzero(keep * w > t * (1 + tolerance))]
            few = missed[:20]
            off += [(SIDES[side], name, round(float(w[k] / total), 4), round(float(got[k] / (spent or 1.0)), 4)) for k, name in zip(few, held.names(side, few), strict=True)]
        logging.getLogger(__name__).warning(
            "wanted shares can be had with %.3f of all tokens, not with %.3f; missed, wanted and expected: %s", reached, keep, off[:20])
    # a cell without tokens has no weight of its own: that of its categories
    return _capped(held.rows(weight=weight, probability=best))


def _capped(rows: DataFrame) -> DataFrame:
    return rows.withColumn("probability", F.least(F.lit(1.0), "probability"))


def mix(docs: DataFrame, *, targets: dict[str, dict] | None = None, flatten: float = 0.8, keep: float | None = None, topics: int = 8,
        sample: int | None = None, seed: int = 5) -> DataFrame:
    """All rows of `docs` (doc_id, text, source, lang, …) with tokens, topic, weight, probability and sampled.

    `targets` gives shares by side and category (as text, null as ''); a side without them gets the present shares to the power `flatten`.
    """
    spark = docs.sparkSession
    docs = docs.drop("tokens", "topic", "weight", "probability", "sampled")

    @F.pandas_udf("struct<tokens:long,p:binary>")
    def seen(text: pd.Series) -> pd.DataFrame:
        # bytes: only ASCII white space parts words
        return pd.DataFrame({"tokens": [len((t or "").encode("utf-8", "replace").split()) for t in text], "p": _packed(text)})

    # texts are looked at once; columns of the documents lie in a struct, so that none is taken for one of those made here
    lang = F.col("lang").cast("string")
    known = docs.select(F.struct(*docs.columns).alias("doc"), F.when(F.col("text").isNotNull(), F.xxhash64("doc_id", "text")).alias("h"), lang.alias("lang"), seen("text").alias("of"))
    known = written(known.select("doc", "h", "lang", "of.tokens", "of.p"), "known")
    learned = _learn(known.where("h is not null").select("h", "lang", "p"), topics, sample)

    @F.pandas_udf("int")
    def topic(p: pd.Series, lang: pd.Series) -> pd.Series:
        return pd.Series(learned.of(_points(p), list(lang)))

    known = known.select("doc", "lang", F.col("doc")["source"].cast("string").alias("source"), "tokens", topic("p", "lang").alias("topic"))
    keyed = known.select(F.struct(*[F.col("doc")[c].alias(c) for c in docs.columns], "tokens", "topic").alias("doc"),
                         *[F.coalesce(F.concat(F.lit("="), c), F.lit("")).alias(c) for c in ("source", "lang")], F.col("topic").cast("string").alias("topic"))
    cells = written(keyed.groupBy(*SIDES).agg(F.sum("doc.tokens").alias("tokens")), "cells")
    wanted = {}
    for side in SIDES:
        given = (targets or {}).get(side)
        if given is None:
            wanted[side] = cells.groupBy(side).agg(F.pow(F.sum("tokens"), F.lit(flatten)).alias("share"))
        else:
            mark = "" if side == "topic" else "="
            wanted[side] = spark.createDataFrame([(mark + str(k) if k != "" else "", float(v)) for k, v in given.items()], f"{side} string, share double")
    weighed = weigh(cells, wanted, keep)
    drawn = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc.doc_id", "doc.text"), 11) / F.lit(2.0**53)
    return keyed.join(weighed.drop("tokens"), list(SIDES)).select("doc.*", "weight", "probability", (drawn < F.col("probability")).alias("sampled"))
