"""Running aggregates, ranks and quantiles of groups, without a task that sees a whole large group.

Rows are first aggregated to cells, one for each distinct value of a group, with map-side combine. Where the cells of all groups
together are few (LARGEST), each group is cumulated as it is. Else a group is cut into RANGES by the quantiles of a KLL sketch,
which is a partial aggregate; running aggregates are worked out within ranges and over one row a range, and put together. The
cuts being approximate changes sizes, never results: sums of weights are decimals, which don't depend on their order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import shared

#: Most cells that one task cumulates.
LARGEST = 1 << 20
RANGES = 64
#: Size parameter of the sketch.
SKETCH = 400
#: Weights count to so many decimals.
EXACT = "decimal(38,12)"

#: How two runs' aggregates become one, and what an empty run has.
_KINDS = {"sum": (F.sum, lambda a, b: a + b, 0), "product": (F.product, lambda a, b: a * b, 1.0)}


def joined(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """a joined to b on keys, null being equal to null; b's keys go."""
    if not keys:
        return a.crossJoin(b)  # b is one row
    right = b.select(*(F.col(k).alias(f"_same_{k}") for k in keys), *(c for c in b.columns if c not in keys))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_same_{k}"))
    return a.join(right, on, how).drop(*(f"_same_{k}" for k in keys))


def _place(x: Column, cuts: Column, lo: int, hi: int) -> Column:
    """How many of the sorted cuts lo..hi-1 are below x, by bisection."""
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(x > F.get(cuts, F.lit(mid)), _place(x, cuts, mid + 1, hi)).otherwise(_place(x, cuts, lo, mid))


def ranged(df: DataFrame, keys: list[str], by: str) -> DataFrame:
    """df with _range, which rises with the numeric column `by` within keys: RANGES parts of about as many rows, by the cuts of a sketch."""
    x = F.col(by).cast("double")
    sketch = df.groupBy(*keys).agg(F.kll_sketch_agg_double(x, F.lit(SKETCH)).alias("_s")).where(F.kll_sketch_get_n_double("_s") > 0)
    cuts = sketch.select(*keys, F.kll_sketch_get_quantile_double("_s", F.array(*(F.lit(i / RANGES) for i in range(1, RANGES)))).alias("_cuts"))
    few = shared.maybe_broadcast(shared.settled(cuts))
    return joined(df, few, keys, "left").withColumn("_range", F.coalesce(_place(x, F.col("_cuts"), 0, RANGES - 1), F.lit(0))).drop("_cuts")


class Ordered:
    """Rows in the order of a numeric column within keys, for running aggregates. df is settled; rows of equal order follow each other in any order."""

    def __init__(self, df: DataFrame, keys: list[str], by: str):
        self.rows, self.keys, self.by = shared.settled(df), keys, by
        self.split = self.rows.count() > LARGEST
        if self.split:
            self.rows = ranged(self.rows, keys, by)

    def running(self, name: str, kind: str, column: Column) -> Ordered:
        """Adds name, the aggregate of the column over the rows up to this one, and name_all, over the group; products also name_before, over the rows before this one (of sums it is the difference)."""
        fn, both, empty = _KINDS[kind]
        rows = self.rows.withColumn("_x", column)
        here = Window.partitionBy(*self.keys, *(["_range"] if self.split else [])).orderBy(self.by)
        start = Window.unboundedPreceding
        own = {name: fn("_x").over(here.rowsBetween(start, 0))}
        if kind == "product":
            own[f"{name}_before"] = F.coalesce(fn("_x").over(here.rowsBetween(start, -1)), F.lit(empty))
        if not self.split:
            self.rows = rows.withColumns({**own, f"{name}_all": fn("_x").over(Window.partitionBy(*self.keys))}).drop("_x")
            return self
        by_range = Window.partitionBy(*self.keys).orderBy("_range")
        sums = rows.groupBy(*self.keys, "_range").agg(fn("_x").alias("_t"))
        sums = sums.withColumns({"_o": F.coalesce(fn("_t").over(by_range.rowsBetween(start, -1)), F.lit(empty)), f"{name}_all": fn("_t").over(Window.partitionBy(*self.keys))}).drop("_t")
        rows = joined(rows.withColumns(own), sums, [*self.keys, "_range"])
        self.rows = rows.withColumns({c: both(F.col("_o"), F.col(c)) for c in own}).drop("_x", "_o")
        return self


def at_ranks(df: DataFrame, keys: list[str], value: str, weight: str | None, ranks: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """(keys, names): the least value whose cumulative weight (rows, without a weight) reaches rank(the group's total). Null values and weights don't count; groups without others are left out."""
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"), (F.col(weight) if weight else F.lit(1)).alias("_w"))
    cells = rows.groupBy(*keys, "_v").agg(F.coalesce(F.sum("_w"), F.lit(0)).cast(EXACT if weight else "long").alias("_w"))
    ordered = Ordered(cells, keys, "_v").running("_cum", "sum", F.col("_w"))
    cum, total = (F.col(c).cast("double") if weight else F.col(c) for c in ("_cum", "_cum_all"))
    return ordered.rows.groupBy(*keys).agg(*(F.min(F.when(cum >= f(total), F.col("_v"))).alias(name) for name, f in ranks.items()))


def nearest(q: float) -> Callable[[Column], Column]:
    """The element at index round(q (n - 1)) of the sorted values."""
    return lambda n: F.floor(q * (n - 1) + 0.5) + 1


def described(df: DataFrame, keys: list[str], value: str, ratios: dict[str, tuple[Column, Column]], median: str, high: tuple[str, float] | None = None, n: str = "n", n_values: bool = False) -> DataFrame:
    """(keys, n, ratios, median, high quantile) in one pass: counts of rows (or of values), sums of one column over sums of another, the median and a nearest quantile of the value. Null values are in no quantile."""
    sums = {f"_{part}{i}": c for i, pair in enumerate(ratios.values()) for part, c in zip("ab", pair)}
    cells = df.groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_n"), *(F.sum(c).alias(name) for name, c in sums.items()))
    valued = F.when(F.col("_v").isNotNull(), F.col("_n")).otherwise(F.lit(0).cast("long"))
    rows = Ordered(cells, keys, "_v").running("_cum", "sum", valued).rows
    at = lambda rank: F.min(F.when(F.col("_cum") >= rank(F.col("_cum_all")), F.col("_v")))
    out = [F.sum(valued if n_values else F.col("_n")).alias(n), *((F.sum(f"_a{i}") / F.sum(f"_b{i}")).alias(name) for i, name in enumerate(ratios))]
    out.append(((at(lambda m: F.floor((m - 1) / 2) + 1) + at(lambda m: F.floor(m / 2) + 1)) / 2).alias(median))
    if high:
        out.append(at(nearest(high[1])).alias(high[0]))
    return rows.groupBy(*keys).agg(*out)


def mean(c: Column) -> tuple[Column, Column]:
    """A mean as the ratio that `described` takes."""
    return c.cast("double"), F.when(c.isNotNull(), F.lit(1.0))


def numbered(df: DataFrame, keys: list[str], by: str, out: str) -> DataFrame:
    """df with the row number, from 1 on, within keys by a unique numeric column."""
    rows = Ordered(df, keys, by).running(out, "sum", F.lit(1).cast("long")).rows
    return rows.select(*df.columns, out)
