"""Folds: how the values of a key (or of a key's window) become one value.

Three kinds, in the order to prefer them:

* `Fold` — sums, counts, minima, maxima, means and structs of them. Partial results are made before the
  shuffle and merged after it, so a hot key costs no more than any other. Also usable for running
  results, sliding windows and retraction.
* a plain `lambda k, v: <aggregate Column>` — any Spark aggregate, e.g. `F.approx_count_distinct(v)`.
* `OrderedFold` — order matters, written with Columns, with a `merge` law. Runs as a tree over blocks of
  bounded size, entirely inside the JVM.
* `RowFold` — an arbitrary Python step per record; see `tideway.operators.processors.fold_rows`.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideway.functions import scans as S

KV = Callable[[Column, Column], Column]


@dataclass(frozen=True)
class Part:
    """One mergeable piece of a fold: `lift` gives a record's contribution, `kind` how two combine."""

    kind: str  # sum, count, min or max
    lift: KV

    def update(self, lifted: Column) -> Column:
        return {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}[self.kind](lifted)

    def merge(self, partial: Column) -> Column:
        return {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}[self.kind](partial)

    def pair(self, a: Column, b: Column) -> Column:
        if self.kind in ("min", "max"):
            return (F.least if self.kind == "min" else F.greatest)(a, b)
        return a + b

    def contribution(self, k: Column, v: Column, sign: Column) -> Column:
        """Signed contribution of one record, for folds that can take records back out."""
        if self.kind == "sum":
            return self.lift(k, v) * sign
        if self.kind == "count":
            return F.when(self.lift(k, v).isNotNull(), sign).otherwise(0).cast("bigint")
        raise ValueError(f"a {self.kind} cannot take a replaced value back out")


@dataclass(frozen=True)
class Fold:
    parts: Mapping[str, Part]
    finish: Callable[[Mapping[str, Column]], Column]

    def lifted(self, df: DataFrame, *keep) -> DataFrame:
        """Only the `keep` columns and each record's contributions: what is not folded is not even read."""
        k, v = F.col("key"), F.col("value")
        return df.filter(v.isNotNull()).select(*keep, *[p.lift(k, v).alias(f"_in_{n}") for n, p in self.parts.items()])

    def partials(self) -> list[Column]:
        """Aggregates over a lifted frame."""
        return [p.update(F.col(f"_in_{n}")).alias(n) for n, p in self.parts.items()]

    def merged(self) -> list[Column]:
        return [p.merge(F.col(n)).alias(n) for n, p in self.parts.items()]

    def pair(self, a: Callable[[str], Column], b: Callable[[str], Column]) -> list[Column]:
        """Merge two sets of partial columns; either side may be null."""
        return [
            F.when(a(n).isNull(), b(n)).when(b(n).isNull(), a(n)).otherwise(p.pair(a(n), b(n))).alias(n)
            for n, p in self.parts.items()
        ]

    def finished(self) -> Column:
        return self.finish({n: F.col(n) for n in self.parts})

    def running(self) -> dict[str, S.Scan]:
        """Running results over a lifted frame."""
        return {n: S.running(p.update(F.col(f"_in_{n}")), p.merge, p.pair) for n, p in self.parts.items()}


def _single(kind: str, lift: KV) -> Fold:
    return Fold({"_f": Part(kind, lift)}, lambda c: c["_f"])


def count() -> Fold:
    return _single("count", lambda k, v: F.lit(1))


def total(lift: KV) -> Fold:
    return _single("sum", lift)


def minimum(lift: KV) -> Fold:
    return _single("min", lift)


def maximum(lift: KV) -> Fold:
    return _single("max", lift)


def mean(lift: KV) -> Fold:
    return Fold({"_sum": Part("sum", lift), "_n": Part("count", lift)}, lambda c: c["_sum"] / c["_n"])


def together(**folds: Fold) -> Fold:
    """Several folds in one pass; the value is a struct with one field per fold."""
    parts = {f"{name}{p}": part for name, f in folds.items() for p, part in f.parts.items()}

    def finish(c):
        return F.struct(*[
            f.finish({p: c[f"{name}{p}"] for p in f.parts}).alias(name) for name, f in folds.items()
        ])

    return Fold(parts, finish)


@dataclass(frozen=True)
class OrderedFold:
    """`seed`, then `step(agg, k, v)` per record in order.

    `merge(a, b)` must satisfy merge(fold(xs), fold(ys)) = fold(xs ++ ys). It lets one key be folded in blocks
    of `block` records by different tasks.
    """

    seed: Column
    step: Callable[[Column, Column, Column], Column]
    merge: Callable[[Column, Column], Column]
    finish: Callable[[Column], Column] = field(default=lambda agg: agg)
    block: int = 2048


@dataclass(frozen=True)
class RowFold:
    """`seed()`, then the Python function `step(agg, k, v)` per record in order; `schema` is the DDL type of agg.

    With `merge(a, b)` a hot key is folded in parallel chunks; without it, in rounds that hand the state on.
    """

    seed: Callable[[], object]
    step: Callable[[object, object, object], object]
    schema: str
    merge: Callable[[object, object], object] | None = None


def apply(df: DataFrame, keys: list[str], fold, order: list[str]) -> DataFrame:
    """Fold `df` (columns `key`, `value`, …) per `keys` into the column `value`. Null values are skipped."""
    k, v = F.col("key"), F.col("value")
    if isinstance(fold, Fold):
        lifted = fold.lifted(df, *keys)
        return lifted.groupBy(*keys).agg(*fold.partials()).select(*keys, fold.finished().alias("value"))
    df = df.filter(v.isNotNull())
    if isinstance(fold, OrderedFold):
        return tree(df, keys, fold, order)
    if isinstance(fold, RowFold):
        from tideway.operators.processors import fold_rows

        return fold_rows(df, keys, fold, order)
    return df.groupBy(*keys).agg(fold(k, v).alias("value"))


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and _holds_map(kind.elementType)


def tree(df: DataFrame, keys: list[str], fold: OrderedFold, order: list[str]) -> DataFrame:
    """Ordered fold as a tree: number the records of a key, fold blocks of `fold.block`, then fold blocks of blocks.

    No array ever holds more than `fold.block` items, and each level shrinks the data by that factor. The
    number of levels follows from the largest key, which is one pre-aggregated count.
    """
    longest = df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    numbered = S.scan(df, keys, order, {"_n": S.number()})
    block = F.lit(fold.block)
    start = fold.seed

    def in_place(items: Column, kind: T.DataType) -> Column:
        """Items by `at`, which is unique among them; types that hold maps can't be compared as a whole."""
        if not _holds_map(kind):
            return F.sort_array(items)
        return F.array_sort(items, lambda a, b: F.when(a["at"] < b["at"], -1).when(a["at"] > b["at"], 1).otherwise(0))

    levels = (
        numbered.select(
            *keys,
            F.floor((F.col("_n") - 1) / block).alias("_g"),
            F.struct(F.col("_n").alias("at"), F.col("key").alias("k"), F.col("value").alias("v")).alias("_item"),
        )
        .groupBy(*keys, "_g")
        .agg(F.collect_list("_item").alias("_items"))
        .withColumn("_items", in_place(F.col("_items"), df.select("key", "value").schema))
        .select(
            *keys, "_g",
            F.aggregate("_items", start, lambda agg, x: fold.step(agg, x["k"], x["v"])).alias("_agg"),
        )
    )
    blocks = -(-longest // fold.block)
    while blocks > 1:
        levels = (
            levels.withColumn("_item", F.struct(F.col("_g").alias("at"), F.col("_agg").alias("v")))
            .withColumn("_g", F.floor(F.col("_g") / block))
            .groupBy(*keys, "_g")
            .agg(F.collect_list("_item").alias("_items"))
            .withColumn("_items", in_place(F.col("_items"), levels.schema["_agg"].dataType))
            .select(
                *keys, "_g",
                F.aggregate(
                    F.slice("_items", 2, fold.block), F.get("_items", F.lit(0))["v"],
                    lambda agg, x: fold.merge(agg, x["v"]),
                ).alias("_agg"),
            )
        )
        blocks = -(-blocks // fold.block)
    return levels.select(*keys, fold.finish(F.col("_agg")).alias("value"))
