"""Ordered scans per key that survive hot keys.

A scan computes, for each record, something about the records before it in its key: the previous
one, the last one that meets a condition, a running total, its number. Ordinary keys use one window
over (key, order). Keys that `layout.measure` found hot are cut into chunks; each chunk is windowed on
its own, a one-row summary per chunk is scanned over the (few) chunks of the key, and the result is
carried into the next chunk. Both ways give the same answer.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tideway.functions import layout as L


@dataclass(frozen=True)
class Scan:
    local: Callable[[WindowSpec], Column]            # value inside a chunk
    summary: Callable[[Column, bool], Column]        # aggregate over a chunk, given the order struct
    carry: Callable[[Column, WindowSpec], Column]    # summaries of all chunks before this one
    combine: Callable[[Column, Column], Column]      # (carried, local) -> value


def _so_far(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, 0)


def _before(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, -1)


def previous(*columns: Column) -> Scan:
    """Struct of `columns` in the record before this one; null for the first record of a key."""
    it = F.struct(*columns)
    return Scan(
        local=lambda w: F.lag(it).over(w),
        summary=lambda order, reverse: (F.min_by if reverse else F.max_by)(it, order),
        carry=lambda s, w: F.lag(s).over(w),
        combine=lambda carried, local: F.coalesce(local, carried),
    )


def last_known(condition: Column, *columns: Column) -> Scan:
    """Struct of `columns` in the last record so far (this one included) where `condition` holds."""
    it = F.when(condition, F.struct(*columns))
    return Scan(
        local=lambda w: F.last(it, ignorenulls=True).over(_so_far(w)),
        summary=lambda order, reverse: (F.min_by if reverse else F.max_by)(it, F.when(condition, order)),
        carry=lambda s, w: F.last(s, ignorenulls=True).over(_before(w)),
        combine=lambda carried, local: F.coalesce(local, carried),
    )


def running(
    update: Column,
    merge: Callable[[Column], Column],
    pair: Callable[[Column, Column], Column],
) -> Scan:
    """Running aggregate, this record included. `update` is an aggregate over records, `merge` one over
    partial results, `pair` the same for two partial results (both non-null)."""
    return Scan(
        local=lambda w: update.over(_so_far(w)),
        summary=lambda order, reverse: update,
        carry=lambda s, w: merge(s).over(_before(w)),
        combine=lambda a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(pair(a, b)),
    )


def number() -> Scan:
    """1, 2, 3, … in order."""
    return running(F.count(F.lit(1)), F.sum, lambda a, b: a + b)


class Scanner:
    """Applies scans over the same keys and order one after another; later ones may use earlier ones.

    `layout=None` measures; pass one to reuse it, or `False` when no key can be hot.
    """

    def __init__(self, df: DataFrame, keys: list[str], order: list[str], *, reverse: bool = False,
                 layout: L.Layout | None | bool = None, chunk_rows: int | None = None):
        self.keys, self.order, self.reverse = keys, order, reverse
        self.names = list(df.columns)
        self.layout = L.measure(df, keys, order, chunk_rows) if layout is None else (layout or None)
        self.df = self.layout.assign(df) if self.layout else df

    def add(self, **scans: Scan) -> Scanner:
        chunk = ["_chunk"] if self.layout else []
        w = Window.partitionBy(*self.keys, *chunk).orderBy(*L.in_chunk_order(self.order, self.reverse))
        if not self.layout:
            self.df = self.df.withColumns({n: s.local(w) for n, s in scans.items()})
        else:
            order = F.struct(*[F.col(c) for c in self.order])
            across = Window.partitionBy(*self.keys).orderBy(*L.in_chunk_order(["_chunk"], self.reverse))
            # one row per chunk of a hot key: as bounded as the layout itself
            carried = (
                self.df.filter("_hot")
                .groupBy(*self.keys, "_chunk")
                .agg(*[s.summary(order, self.reverse).alias(n) for n, s in scans.items()])
                .select(*self.keys, "_chunk",
                        *[s.carry(F.col(n), across).alias(f"_c_{n}") for n, s in scans.items()])
            )
            kept = self.df.columns
            self.df = (
                self.df.withColumns({f"_l_{n}": s.local(w) for n, s in scans.items()})
                .join(F.broadcast(carried), [*self.keys, "_chunk"], "left")
                .select(*kept, *[s.combine(F.col(f"_c_{n}"), F.col(f"_l_{n}")).alias(n)
                                 for n, s in scans.items()])
            )
        self.names += list(scans)
        return self

    def result(self) -> DataFrame:
        return self.df.select(*self.names)


def scan(df: DataFrame, keys: list[str], order: list[str], scans: dict[str, Scan], *,
         reverse: bool = False, layout: L.Layout | None | bool = None,
         chunk_rows: int | None = None) -> DataFrame:
    """`df` plus one column per scan."""
    return Scanner(df, keys, order, reverse=reverse, layout=layout, chunk_rows=chunk_rows).add(**scans).result()
