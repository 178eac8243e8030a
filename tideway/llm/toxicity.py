"""Toxicity score: a weighted lexicon, matched by Aho-Corasick in folded text, with exception phrases.

The lexicon (whole words and word beginnings) and its weights are learned from labelled documents. Texts are folded first:
compatibility forms, look-alike letters, digits and signs standing for letters, invisible characters. The sum of the weights found,
less those inside an exception phrase, is divided by the logarithm of the length and turned into a probability. Exception phrases are given ones and
learned ones: two words with a lexicon entry in them that clean documents hold at least as often as toxic ones.

Null and empty texts score as texts without a match. Documents without a label, or with a null label, teach nothing; repeated
labels of one document count once (toxic if any says so). Without a toxic and a clean label all documents score 0.
Extra columns pass through; columns named like the new ones are replaced.
"""

from __future__ import annotations

import math
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideway.llm.common import written

# Letters of other scripts that look like Latin ones, and characters used in their place.
LOOK_ALIKES = dict(zip("авеԁіјкмнорԛсѕтуԝхһαβεικνορτυχγ", "abedijkmhopqcstywxhabeiknoptuxy"))
SUBSTITUTES = {"0": "o", "1": "i", "l": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s"}
INVISIBLE = "­​‌‍⁠﻿"
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "idiot proof", "loser bracket", "stupid simple")
PREFIXES = range(3, 9)
THRESHOLD = 0.7


class _Fold(dict):
    """Translation of one character, worked out when it is first seen."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        if c in INVISIBLE:
            out = ""
        else:
            out = ""
            for x in unicodedata.normalize("NFKC", c).lower():
                x = LOOK_ALIKES.get(x, x)
                x = SUBSTITUTES.get(x, x)
                out += x if x.isalnum() or unicodedata.combining(x) else " "
        self[code] = out
        return out


FOLD = _Fold()


def fold(text: str | None) -> str:
    """Words in one canonical spelling, between single or repeated blanks."""
    return (text or "").translate(FOLD)


@dataclass(frozen=True)
class Model:
    """`weights`: " word " or " beginning" → log odds; probability = 1 / (1 + exp(-(slope · x + bias)))."""

    weights: dict[str, float]
    exceptions: tuple[str, ...]
    slope: float
    bias: float


def _automaton(model: Model):
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for pattern, w in model.weights.items():
        automaton.add_word(pattern, (len(pattern), w))
    for phrase in model.exceptions:
        pattern = f" {fold(phrase)} "
        automaton.add_word(pattern, (len(pattern), None))
    if len(automaton):
        automaton.make_automaton()
    return automaton


def _strength(automaton, text: str | None) -> float:
    """Weights found per logarithm of the number of words."""
    if not text or not len(automaton):
        return 0.0
    folded = fold(text)
    found = [(end - n + 1, end, w) for end, (n, w) in automaton.iter(" ".join(("", *folded.split(), "")))]
    if not found:
        return 0.0
    spared = sorted((s, e) for s, e, w in found if w is None)
    starts, reach = [s for s, _ in spared], list(accumulate((e for _, e in spared), max))
    # inside a phrase: one that starts no later reaches as far
    total = sum(w for s, e, w in found if w is not None and not ((k := bisect_right(starts, s)) and reach[k - 1] >= e))
    return total / math.log2(8 + len(folded.split()))


def _around(automaton, text: str) -> set[str]:
    """Pairs of neighbouring words of which one holds an entry."""
    words = fold(text).split()
    if not len(automaton) or len(words) < 2:
        return set()
    ends = list(accumulate(len(w) + 1 for w in words))  # places of the blanks behind the words
    # an entry starts with the blank before its word
    hit = {bisect_right(ends, end - n + 1) for end, (n, _) in automaton.iter(" ".join(("", *words, "")))}
    return {f"{words[i]} {words[i + 1]}" for h in hit for i in (h - 1, h) if 0 <= i < len(words) - 1}


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
            words = set(fold(text).split())
            starts = {f" {w[:n]}" for w in words for n in PREFIXES if len(w) >= n}
            counts[int(toxic)].update(starts)
            counts[int(toxic)].update(f" {w} " for w in words)
        names = list(counts[0].keys() | counts[1].keys())
        if names:
            yield pd.DataFrame({"feature": names, "clean": [counts[0][x] for x in names], "toxic": [counts[1][x] for x in names]})


def _lexicon(rows: list, toxic: int, clean: int, least_odds: float) -> dict[str, float]:
    """The closed features of high odds: of a chain of beginnings with nearly the same documents the longest, and nothing that a
    shorter entry of nearly the same odds covers already."""
    odds = {r["feature"]: math.log((r["toxic"] + 0.5) / (toxic + 1)) - math.log((r["clean"] + 0.5) / (clean + 1)) for r in rows}
    count = {r["feature"]: r["toxic"] for r in rows}
    followed: dict[str, int] = {}
    for f, n in count.items():
        followed[f[:-1]] = max(n, followed.get(f[:-1], 0))
    closed = {f for f, n in count.items() if followed.get(f, 0) < 0.9 * n}
    out: dict[str, float] = {}
    for f in sorted(closed, key=len):
        if odds[f] >= least_odds and not any(out.get(f[:k], 0) >= odds[f] - 1 for k in range(2, len(f))):
            out[f] = odds[f]
    return out


def fit(docs: DataFrame, labels: DataFrame, *, sample: int = 12_000, max_entries: int = 20_000, least_odds: float = 4.0,
        evidence_margin: float = 6.0, least_clean: int = 5, exceptions: tuple[str, ...] = EXCEPTIONS) -> Model:
    """Learn from at most `sample` labelled documents, taken in the order of a hash of their ids; that bound makes the list of ids
    and the (strength, label) pairs small enough for the driver, `max_entries` the lexicon and the learned phrases, which at least `least_clean` clean
    documents hold. Rows whose crc32(doc_id as text) mod 3 is 1 teach nothing."""
    spark = docs.sparkSession
    chosen = (labels.where("doc_id is not null and toxic is not null and crc32(cast(doc_id as string)) % 3 <> 1")
              .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    chosen = spark.createDataFrame(chosen.collect(), chosen.schema)
    taught = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(F.coalesce("text", F.lit("")).alias("text"), "toxic")
    n = {r["toxic"]: r["count"] for r in taught.groupBy("toxic").count().collect()}
    if not n.get(0) or not n.get(1):
        return Model({}, tuple(exceptions), 0.0, -50.0)
    counted = (taught.mapInPandas(_features, "feature string, clean long, toxic long").groupBy("feature")
               .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where("toxic > 0"))
    odds = F.log((F.col("toxic") + 0.5) / (n[1] + 1)) - F.log((F.col("clean") + 0.5) / (n[0] + 1))
    # likelihood ratio against "toxic documents hold it as often as others": chance alone gives thousands of rare words some odds
    share, of = n[1] / (n[0] + n[1]), F.col("toxic") + F.col("clean")
    evidence = 2 * (F.col("toxic") * F.log(F.col("toxic") / (of * share))
                    + F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (of * (1 - share)))).otherwise(0.0))
    counted = written(counted, "features")
    least_evidence = 2 * math.log(max(2, counted.count())) + evidence_margin
    rows = counted.where((odds >= least_odds) & (evidence >= least_evidence)).orderBy(F.desc("toxic"), "feature").limit(max_entries).collect()
    weights = _lexicon(rows, n[1], n[0], least_odds)

    def phrases(batches):
        automaton = _automaton(Model(weights, (), 0.0, 0.0))
        for batch in batches:
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                counts[int(toxic)].update(_around(automaton, text))
            names = list(counts[0].keys() | counts[1].keys())
            if names:
                yield pd.DataFrame({"feature": names, "clean": [counts[0][x] for x in names], "toxic": [counts[1][x] for x in names]})

    learned = [r["feature"] for r in taught.mapInPandas(phrases, "feature string, clean long, toxic long").groupBy("feature")
               .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where((F.col("clean") >= least_clean) & (odds <= 0))
               .orderBy(F.desc("clean"), "feature").limit(max_entries).collect()]
    model = Model(weights, tuple(dict.fromkeys((*exceptions, *learned))), 0.0, 0.0)

    def strengths(batches):
        automaton = _automaton(model)
        for batch in batches:
            yield pd.DataFrame({"x": [_strength(automaton, t) for t in batch["text"]], "y": batch["toxic"].astype("int32")})

    fitted = taught.mapInPandas(strengths, "x double, y int").toPandas()
    slope, bias = _logistic(fitted["x"].to_numpy(), fitted["y"].to_numpy())
    return Model(model.weights, model.exceptions, slope, bias)


def _logistic(x: np.ndarray, y: np.ndarray, prior: float = 1e-3, rounds: int = 100) -> tuple[float, float]:
    """Logistic regression on one value by Newton's method; both classes weigh the same, and a weak prior keeps it finite."""
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    X, beta = np.stack([x, np.ones_like(x)], 1), np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(X @ beta, -50, 50)))
        gradient = X.T @ (weight * (y - p)) - prior * beta
        hessian = (X * (weight * p * (1 - p))[:, None]).T @ X + prior * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """All rows and columns of `docs` with `score` (0 to 1) and `predicted` (1 from `threshold` on)."""
    docs = docs.drop("score", "predicted")
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches):
        automaton = _automaton(model)
        for batch in batches:
            x = np.array([_strength(automaton, t) for t in batch["text"]], dtype=float)
            p = 1 / (1 + np.exp(-np.clip(model.slope * x + model.bias, -50, 50)))
            yield batch.assign(score=p, predicted=(p >= threshold).astype("int32"))

    return docs.mapInPandas(run, schema)
