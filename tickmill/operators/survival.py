"""Weighted survival statistics: Kaplan-Meier quantiles, monotone fits, widening windows, and the budget table made of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import shared
from ..config import Config
from ..functions import scores
from . import ranks

#: Categories that budgets are fitted for, in order (fixed values).
CATEGORIES = ("forced", "recapture", "tactical", "defensive", "only-move", "endgame", "many-good-moves", "quiet")
TRAINABLE = CATEGORIES[2:]


def weighted_quantile(df: DataFrame, keys: list[str], value: str, weight: str, qs: dict[str, float]) -> DataFrame:
    """For each key, the least value whose cumulative weight reaches q of the total, 0 < q <= 1. Cumulative weights are decimals, so no order of the rows changes the result."""
    return ranks.at_ranks(df, keys, value, weight, {name: (lambda total, q=q: q * total) for name, q in qs.items()})


def weighted_ecdf(df: DataFrame, keys: list[str], value: str, weight: str, grid: list[float]) -> DataFrame:
    """For each key and grid point, the weight share of values at or below it; one pass, without a join."""
    shares = F.array(*(F.struct(F.lit(float(g)).alias("at"), (F.coalesce(F.sum(F.when(F.col(value) <= g, F.col(weight))), F.lit(0.0)) / F.sum(F.when(F.col(value).isNotNull(), F.col(weight)))).alias("share")) for g in grid))
    return df.groupBy(*keys).agg(shares.alias("_x")).select(*keys, F.inline("_x"))


def km_cells(df: DataFrame, keys: list[str], time: str, found: str, weight: str) -> DataFrame:
    """Events and totals at each distinct time, partially aggregated: all that a Kaplan-Meier curve needs."""
    return df.groupBy(*keys, F.col(time).alias("t")).agg(F.sum(F.when(F.col(found), F.col(weight)).otherwise(0.0)).alias("e"), F.sum(weight).alias("total"))


#: A curve that falls short of a share by no more than this has reached it: products of factors in floats are that far off.
TOLERANCE = 1e-12


def km_quantiles(cells: DataFrame, keys: list[str], qs: dict[str, float]) -> DataFrame:
    """Times by which a share q has found it; null if the curve never gets there, to within TOLERANCE. Events at a time precede censorings, and spread linearly over half a unit on either side, not below 0.

    Weights at risk are decimals. The curve is the product of the factors in time order; a group of very many times is cut
    into ranges, whose products are multiplied in order, so that no task scans it whole.
    """
    exact = cells.withColumns({c: F.col(c).cast(ranks.EXACT) for c in ("e", "total")})
    curve = ranks.Ordered(exact, keys, "t").running("_t", "sum", F.col("total"))
    at_risk = (F.col("_t_all") - F.col("_t") + F.col("total")).cast("double")
    curve = curve.running("_left", "product", F.when(F.col("e") > 0, 1.0 - F.col("e").cast("double") / at_risk).otherwise(1.0))
    after, before = 1.0 - F.col("_left"), 1.0 - F.col("_left_before")
    lo, hi = F.greatest(F.col("t") - 0.5, F.lit(0.0)), F.col("t") + 0.5

    def at(q: float):
        there = (F.col("e") > 0) & (after >= q - TOLERANCE)
        return F.min_by(F.when(there, F.least(hi, lo + (hi - lo) * (q - before) / (after - before))), F.when(there, F.col("t")))

    return curve.rows.groupBy(*keys).agg(*(at(q).alias(name) for name, q in qs.items()))


def _pooled(values, weights):
    """Blocks (mean, weight, count) of adjacent values pooled until they rise: pool adjacent violators, left to right."""
    blocks = []
    for v, w in zip(values, weights):
        n = 1
        while blocks and blocks[-1][0] > v:
            m, u, k = blocks.pop()
            v, w, n = (m * u + v * w) / (u + w), u + w, k + n
        blocks.append((v, w, n))
    return blocks


def _pooled_task(order: str, value: str, weight: str, sign: float, out: str, mean: str | None = None):
    """Fits of one group's rows, in order; rows without a value or weight have none. With `mean`, the block's number, mean and weight."""
    import numpy as np
    import pyarrow as pa

    def run(table: pa.Table) -> pa.Table:
        o, v, w = (table.column(c).to_numpy(zero_copy_only=False).astype("float64") for c in (order, value, weight))
        use = np.flatnonzero(~np.isnan(v) & ~np.isnan(w))
        use = use[np.lexsort((w[use], v[use], o[use]))]
        blocks = _pooled((sign * v[use]).tolist(), w[use].tolist())
        sizes = [b[2] for b in blocks]
        columns = {out: np.repeat([b[0] for b in blocks], sizes) * sign}
        if mean:
            columns = {"_block": np.repeat(np.arange(len(blocks), dtype="float64"), sizes), "_mean": columns[out] * sign, "_weight": np.repeat([b[1] for b in blocks], sizes)}
        for name, got in columns.items():
            x = np.full(len(v), np.nan)
            x[use] = got
            table = table.append_column(name, pa.array(x, mask=np.isnan(x)))
        return table

    return run


def isotonics(df: DataFrame, keys: list[str], order: str, weight: str, fits: dict[str, tuple[str, bool]]) -> DataFrame:
    """df with a column for each of fits {out: (value, increasing)}: the weighted monotone least-squares fit of the value along the numeric column `order` within keys.

    Adjacent violators are pooled in one pass. Pooled stacks can be pooled again, so a table of many points is cut into ranges
    of a group, each pooled by itself; a group's stacks, in order, are pooled to the group's blocks, and each
    range's rows get the fit of the block that theirs became part of.
    """
    rows = shared.settled(df)
    split = rows.count() > ranks.LARGEST
    for out, (value, increasing) in fits.items():
        sign = 1.0 if increasing else -1.0
        if not split:
            schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
            rows = rows.groupBy(*keys).applyInArrow(_pooled_task(order, value, weight, sign, out), f"{schema}, {out} double")
            continue
        parts = ranks.ranged(rows, keys, order)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
        stacks = shared.settled(parts.groupBy(*keys, "_range").applyInArrow(_pooled_task(order, value, weight, sign, out, "_mean"), f"{schema}, _block double, _mean double, _weight double"))
        blocks = stacks.where("_block is not null").groupBy(*keys, "_range", "_block").agg(F.first("_mean").alias("_mean"), F.first("_weight").alias("_weight"))
        blocks = blocks.withColumn("_at", F.col("_range") * float(1 << 40) + F.col("_block"))
        kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in blocks.schema)
        fitted = blocks.groupBy(*keys).applyInArrow(_pooled_task("_at", "_mean", "_weight", 1.0, "_fit"), f"{kind}, _fit double")
        rows = ranks.joined(stacks, fitted.select(*keys, "_range", "_block", (F.col("_fit") * sign).alias(out)), [*keys, "_range", "_block"], "left").drop("_range", "_block", "_mean", "_weight")
    return rows


def isotonic(df: DataFrame, keys: list[str], order: str, value: str, weight: str, increasing: bool, out: str) -> DataFrame:
    """One fit of `isotonics`."""
    return isotonics(df, keys, order, weight, {out: (value, increasing)})


def widened(cells: DataFrame, keys: list[str], grid: DataFrame, at: str, n: str, finds: str, enough: int, step: int, widest: int) -> DataFrame:
    """(keys, rating, half_width, n_obs, n_success): of the half-widths step, 2 step, ... the least window with enough finds, else the widest.

    cells: (keys, at, n, finds), aggregated. grid: (keys, rating), small. Each cell is matched
    with the windows that hold it by an equi-join on keys with the range as residual.
    """
    last = -(-widest // step) * step
    windows = grid.withColumn("half_width", F.explode(F.sequence(F.lit(step), F.lit(last), F.lit(step))))
    c = cells.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col(at).alias("_at"), F.col(n).alias("_n"), F.col(finds).alias("_finds"))
    cond = [F.col(k) == F.col(f"_{k}") for k in keys] + [F.col("_at").between(F.col("rating") - F.col("half_width"), F.col("rating") + F.col("half_width"))]
    on = cond[0]
    for x in cond[1:]:
        on = on & x
    sums = windows.join(c, on, "left").groupBy(*keys, "rating", "half_width").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_obs"), F.coalesce(F.sum("_finds"), F.lit(0)).alias("n_success"))
    ok = F.col("n_success") >= enough
    rank = F.row_number().over(Window.partitionBy(*keys, "rating").orderBy(F.when(ok, 0).otherwise(1), F.when(ok, F.col("half_width")).otherwise(-F.col("half_width"))))
    return sums.withColumn("_r", rank).where("_r = 1").drop("_r")


# --- the budget table ---


def training_rows(obs: DataFrame, cfg: Config | None = None) -> DataFrame:
    cfg = cfg or Config()
    keep = F.col("loss_win_pct").isNotNull() & F.col("tc_class").isin(*cfg.time_controls.supported) & F.col("category").isin(*TRAINABLE) & F.col("position_state").isin(*cfg.position_states)
    if cfg.budget.exclude_low_clock:
        keep &= ~F.col("low_clock")
    return obs.where(keep).select("tc_class", "category", "mover_elo", "time_spent_s", "y", "sampling_weight")


def fit_budgets(obs: DataFrame, cfg: Config | None = None) -> DataFrame:
    """One row for each class, category and grid rating: raw window statistics, monotone fits, no class below a faster one, clipped."""
    cfg = cfg or Config()
    b, spark = cfg.budget, obs.sparkSession
    keys = ["tc_class", "category"]
    rows = training_rows(obs, cfg).groupBy(*keys, "mover_elo", "time_spent_s", "y").agg(F.sum("sampling_weight").alias("w"), F.count("*").alias("n"))
    lo, hi, step = b.grid
    grid = spark.range(1).select(F.explode(F.array(*(F.lit(c) for c in cfg.time_controls.supported))).alias("tc_class")).crossJoin(spark.range(1).select(F.explode(F.array(*(F.lit(c) for c in TRAINABLE))).alias("category"))).withColumn("rating", F.explode(F.sequence(F.lit(lo), F.lit(hi), F.lit(step))))
    by_elo = rows.groupBy(*keys, "mover_elo").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("y"), F.col("n")).otherwise(0)).alias("finds"))
    window = shared.settled(widened(by_elo, keys, grid, "mover_elo", "n", "finds", b.min_successes, b.window_step, b.max_half_width))
    r = rows.select(*(F.col(k).alias(f"_{k}") for k in keys), "mover_elo", "time_spent_s", "y", "w")
    inside = window.where("n_success > 0").join(r, (F.col("tc_class") == F.col("_tc_class")) & (F.col("category") == F.col("_category")) & F.col("mover_elo").between(F.col("rating") - F.col("half_width"), F.col("rating") + F.col("half_width")))
    cell = [*keys, "rating"]
    km = km_quantiles(km_cells(inside, cell, "time_spent_s", "y", "w"), cell, {"q": b.quantile, "s": b.strict_quantile})
    rate = inside.groupBy(*cell).agg((F.sum(F.when(F.col("y"), F.col("w")).otherwise(0.0)) / F.sum("w")).alias("raw_p_inf"))
    top = scores.mapped(F.col("tc_class"), {c: float(x) for c, _, x in b.clip_s})
    bottom = scores.mapped(F.col("tc_class"), {c: float(x) for c, x, _ in b.clip_s})
    some = F.col("n_success") > 0
    table = window.join(km, cell, "left").join(rate, cell, "left").withColumns(
        {"raw_budget_s": F.when(some, F.coalesce("q", top)), "raw_budget_strict_s": F.when(some, F.coalesce("s", top)), "unreached": some & (F.col("q").isNull() | F.col("s").isNull())}
    ).drop("q", "s")
    fits = table.where(some).select(*cell, "n_success", F.ln("raw_budget_s").alias("lb"), F.ln("raw_budget_strict_s").alias("ls"), "raw_p_inf")
    fits = isotonics(fits, keys, "rating", "n_success", {"fb": ("lb", False), "fs": ("ls", False), "p_inf": ("raw_p_inf", True)})
    table = table.join(fits.select(*cell, F.exp("fb").alias("budget_s"), F.exp("fs").alias("budget_strict_s"), "p_inf"), cell, "left")
    return across_classes(table, cfg, bottom, top)


#: Budgets that differ by no more are equal: fits are means of logarithms.
SAME = 1e-9


def across_classes(table: DataFrame, cfg: Config, bottom, top) -> DataFrame:
    """A slower class gets at least a faster one's budget; then budgets are clipped. Flags mark changes of more than SAME."""
    speed = scores.ordinal(F.col("tc_class"), cfg.time_controls.supported)
    upto = Window.partitionBy("category", "rating").orderBy(speed).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("category", "rating").orderBy(speed).rowsBetween(Window.unboundedPreceding, -1)
    raised = lambda c: F.coalesce(F.col(c) < F.max(c).over(before) - SAME, F.lit(False))
    table = table.withColumns({"raised_to_faster": raised("budget_s") | raised("budget_strict_s"), "_b": F.max("budget_s").over(upto), "_s": F.max("budget_strict_s").over(upto), "sparse": F.col("n_success") < cfg.budget.min_successes})
    return table.withColumns({"clipped_low": F.col("_b") < bottom - SAME, "clipped_high": F.col("_b") > top + SAME, "budget_s": scores.clip(F.col("_b"), bottom, top), "budget_strict_s": scores.clip(F.col("_s"), bottom, top)}).drop("_b", "_s")


def violations(table: DataFrame, cfg: Config | None = None) -> DataFrame:
    """(tc_class, category, problem) for every rule that the budget table breaks."""
    cfg = cfg or Config()
    eps = SAME
    along = Window.partitionBy("tc_class", "category").orderBy("rating")
    speed = Window.partitionBy("category", "rating").orderBy(scores.ordinal(F.col("tc_class"), cfg.time_controls.supported))
    missing = F.col("budget_s").isNull() | F.col("budget_strict_s").isNull() | F.col("p_inf").isNull()
    rules = {
        "missing values": missing,
        "budget increases with rating": F.col("budget_s") > F.lag("budget_s").over(along) + eps,
        "solve rate decreases with rating": F.col("p_inf") < F.lag("p_inf").over(along) - eps,
        "strict budget above the regular one": F.col("budget_strict_s") > F.col("budget_s") + eps,
        "budget below a faster class": F.col("budget_s") < F.lag("budget_s").over(speed) - eps,
    }
    marked = table.withColumns({f"_r{i}": F.coalesce(c, F.lit(False)) for i, c in enumerate(rules.values())})
    found = F.array_compact(F.array(*(F.when(F.col(f"_r{i}"), F.lit(n)) for i, n in enumerate(rules))))
    return marked.select("tc_class", "category", F.explode(found).alias("problem")).distinct()


def budget_report(train: DataFrame, table: DataFrame, cfg: Config | None = None) -> dict:
    """Counts that describe a fit; aggregates only reach the driver."""
    cfg = cfg or Config()
    shift = F.abs(F.ln("budget_s") - F.ln("raw_budget_s"))
    got = table.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("raw_budget_s").isNotNull() & (F.col("half_width") > cfg.budget.window_step)).alias("windows_widened"),
        *(F.count_if(c).alias(c) for c in ("sparse", "unreached", "raised_to_faster", "clipped_low", "clipped_high")),
        F.bround(F.median(shift), 4).alias("adjustment_median_abs_log"),
        F.bround(F.max(shift), 4).alias("adjustment_max_abs_log"),
    ).first()
    by_class = {r[0]: r[1] for r in train.groupBy("tc_class").count().collect()}
    return got.asDict() | {"training_rows": sum(by_class.values()), "training_rows_by_class": by_class, "violations": sorted(f"{r[0]}/{r[1]}: {r[2]}" for r in violations(table, cfg).collect())}
