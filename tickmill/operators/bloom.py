"""A semi-join for keys too many to broadcast: a blocked Bloom filter drops most rows before the exact join shuffles.

A key sets eight bits of one block of 256, two in each of its four longs. Blocks are built by a grouped bit_or, which combines
map-side, and are broadcast as rows; a row is tested by one hash join on its block and four masks, within generated code. A
filter has no false negatives, so the join after it loses nothing; the number of blocks is bounded, so with very many
keys it lets more rows through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import shared

#: Bits of the filter for each key, and the most blocks: 48 MiB as broadcast rows.
BITS_PER_KEY, MOST_BLOCKS = 12, 1 << 20
_WORDS = ("w0", "w1", "w2", "w3")


def _bit(h: Column, at: int) -> Column:
    """One bit of a long, placed by six bits of the hash."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, at).bitwiseAND(F.lit(63)).cast("int"))


def _place(key: Column, blocks: int) -> dict[str, Column]:
    """A key's block and its bits in the four longs."""
    h = F.xxhash64(key, F.lit("bits"))
    return {"block": F.pmod(F.xxhash64(key, F.lit("block")), F.lit(blocks)), **{w: _bit(h, 12 * i).bitwiseOR(_bit(h, 12 * i + 6)) for i, w in enumerate(_WORDS)}}


def made(keys: DataFrame, key: str, n: int) -> DataFrame:
    """(block, w0 .. w3): the filter of about n distinct keys; only blocks that have a bit are rows."""
    blocks = max(1, min(MOST_BLOCKS, -(-n * BITS_PER_KEY // 256)))
    return keys.select(*(c.alias(name) for name, c in _place(F.col(key), blocks).items())).groupBy("block").agg(*(F.bit_or(w).alias(w) for w in _WORDS))


def passing(rows: DataFrame, key: str, keys: DataFrame, other: str, n: int) -> DataFrame:
    """rows whose key may be among keys.other: all that are, and a small share of the rest. Null keys don't pass."""
    blocks = max(1, min(MOST_BLOCKS, -(-n * BITS_PER_KEY // 256)))
    table = F.broadcast(shared.settled(made(keys.where(F.col(other).isNotNull()), other, n)).withColumnsRenamed({w: f"_{w}" for w in ("block", *_WORDS)}))
    place = _place(F.col(key), blocks)
    on = place["block"] == F.col("_block")
    for w in _WORDS:
        on = on & (place[w].bitwiseAND(F.col(f"_{w}")) == place[w])
    return rows.join(table, on, "left_semi")


def semi_join(rows: DataFrame, key: str, keys: DataFrame, other: str, broadcast_bytes: int | None = None) -> DataFrame:
    """rows whose key is among keys.other. Keys that are small, measured, are broadcast; else rows pass the filter first, and only those that do are shuffled. keys is read more than once: settle what is dear."""
    distinct = keys.select(F.col(other).alias("_k")).where(F.col("_k").isNotNull()).distinct()
    most = shared.BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    wide = F.octet_length("_k").cast("long") if dict(distinct.dtypes)["_k"] in ("string", "binary") else F.lit(8).cast("long")
    n, size = distinct.agg(F.count("*"), F.coalesce(F.sum(wide + 40), F.lit(0))).first()
    if size <= most:
        return rows.join(F.broadcast(distinct), F.col(key) == F.col("_k"), "left_semi")
    return passing(rows, key, distinct, "_k", n).join(distinct, F.col(key) == F.col("_k"), "left_semi")
