"""Numbers: bands and buckets, clipping, engine scores, hashed uniforms, nearest quantiles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Acceptability


def band(x: Column, width: int) -> Column:
    """The lower end of the band of x; floors for negative values too."""
    return (F.floor(x / width) * width).cast("int")


def bucket_floor(x: Column, lowest: int, edges) -> Column:
    """The lower bound of the bucket [lowest, e1), [e1, e2), ... that x is in; null for null."""
    out = F
    for e in sorted(edges, reverse=True):
        out = out.when(x >= e, F.lit(e))
    return out.when(x.isNotNull(), F.lit(lowest))


def cut(x: Column, edges, labels) -> Column:
    """Left-closed intervals by rising edges, one label more than edges."""
    out = F.when(x < edges[0], labels[0])
    for e, label in zip(edges[1:], labels[1:]):
        out = out.when(x < e, label)
    return out.when(x >= edges[-1], labels[-1])


def clip(x: Column, lo, hi) -> Column:
    """x within [lo, hi]; null stays null."""
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.when(x.isNotNull(), F.least(F.greatest(x, as_col(lo)), as_col(hi)))


def win_pct(cp: Column, cfg: Acceptability | None = None) -> Column:
    """Expected score in per cent of a centipawn value, by a logistic curve."""
    cfg = cfg or Acceptability()
    c = clip(cp.cast("double"), -float(cfg.cp_ceiling), float(cfg.cp_ceiling))
    return 50 + 50 * (2 / (1 + F.exp(-cfg.win_pct_k * c)) - 1)


def score_to_cp(cp: Column, mate: Column, cfg: Acceptability | None = None) -> Column:
    """Centipawns clipped to the ceiling; mates are at it, mate in 0 or less against the mover."""
    top = (cfg or Acceptability()).cp_ceiling
    return F.when(mate > 0, F.lit(top)).when(mate <= 0, F.lit(-top)).otherwise(clip(cp, -top, top))


def eval_win_pct(cp: Column, mate: Column, cfg: Acceptability | None = None) -> Column:
    """Of a database evaluation: nothing at all counts as 0 centipawns."""
    return win_pct(score_to_cp(F.coalesce(cp, F.lit(0)), mate, cfg), cfg)


def for_mover(x: Column, white_to_move: Column) -> Column:
    return F.when(white_to_move, x).otherwise(-x)


def acceptable(best: Column, played: Column, cfg: Acceptability | None = None) -> Column:
    return (best - played) <= (cfg or Acceptability()).tau_win_pct


def uniform(salt: str, *keys: Column) -> Column:
    """In [0, 1), from 52 bits of an MD5 over the salt and the keys: the same on any engine and partitioning."""
    digest = F.md5(F.concat_ws("|", F.lit(salt), *(k.cast("string") for k in keys)))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / float(1 << 52)


def weighted_rate(x: Column, w: Column) -> Column:
    """Aggregate: sum of x w over sum of w."""
    return F.sum(x * w) / F.sum(w)


def ordinal(x: Column, order) -> Column:
    """Position in a declared order, for sorting; null if it isn't there."""
    return F.nullif(F.array_position(F.array(*(F.lit(v) for v in order)), x), F.lit(0))


def mapped(x: Column, values: dict) -> Column:
    """A value by key; an unknown key raises."""
    table = F.create_map(*(F.lit(v) for kv in values.items() for v in kv))
    return F.when(x.isNull() | F.array_contains(F.array(*(F.lit(k) for k in values)), x), table[x]).otherwise(F.raise_error(F.concat(F.lit("no value for "), x.cast("string"))))


def tenths(x: Column, whole: Column) -> Column:
    """The share of x in whole, clipped to [0, 1], floored to tenths; all of it counts as 0.9."""
    return F.least(F.floor(clip(x / whole, 0.0, 1.0) * 10), F.lit(9)) / 10
