"""Equi join with hot keys: a recursive grace hash join whose tasks probe with DuckDB.

Rows of both sides meet in cells. A cell is a key, or, for a key that has more rows than a task's share, one block
of one side's rows, dealt by row id, against the replicated other side. Cells are hashed over the session's
shuffle partitions. A task holds rows up to BUDGET bytes; beyond that it spills radix buckets of the cells' hashes to
scratch files of its own (as Spark's sorts do; no other task reads them, and they go with the task), and takes one
bucket after the other, with further bits where a bucket is still too large. What no radix can split, a cell of one key, is
probed block by block. Bitmaps over each side's rows keep which of them matched.

`join` returns the rows of the join. `partners` returns, for each row of either side, how many rows it joins with and the
sum of a measure over them: its result grows with the inputs, where the join's own rows grow with the product of a key's
rows. Only sums of the other side being asked for, a hot key's replicated side is merged into one weighted row first.

Equal rows are merged into one with a count before anything is dealt, so copies are never a hot group, and a row's id,
the hash of its contents, is the same when a lost task runs again. Null keys match nothing and are answered beside the cells.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Bytes of rows that a task holds before it spills.
BUDGET = 64 << 20
#: Bits of a cell's hash that one level of radix buckets takes.
BITS = 4
#: A key is hot beyond this many rows of a side, or beyond half a partition's share if that is more.
LEAST_BLOCK = 1000
#: Most rows of a batch of joined rows.
ROWS_OUT = 1 << 14


# --- inside a task ---


class _Rows:
    """Batches of one bucket, in memory or in a scratch file; can be read again and again."""

    def __init__(self, path: str):
        self.path, self.held, self.sink, self.bytes, self.cell = path, [], None, 0, None
        self.mixed = False

    def add(self, batch: pa.RecordBatch) -> None:
        cells = batch.column("cell").to_numpy()
        self.cell = cells[0] if self.cell is None else self.cell
        self.mixed = self.mixed or bool((cells != self.cell).any())
        self.bytes += batch.nbytes
        self.held.append(batch)

    def spill(self) -> None:
        for batch in self.held:
            self.sink = self.sink or pa.ipc.new_file(self.path, batch.schema)
            self.sink.write_batch(batch)
        self.held = []

    def close(self) -> None:
        if self.sink:
            self.spill()
            self.sink.close()
            self.sink = True

    def batches(self):
        yield from self.held
        if self.sink:
            with pa.OSFile(self.path) as f:
                reader = pa.ipc.open_file(f)
                for i in range(reader.num_record_batches):
                    yield reader.get_batch(i)

    def drop(self) -> None:
        self.held = []
        if self.sink:
            os.unlink(self.path)
            self.sink = None


def _split(rows, folder: str, level: int, budget: int) -> list[_Rows]:
    """Radix buckets of the batches by the level's bits of the cells' hashes; together they hold at most the budget in memory."""
    made = [_Rows(f"{folder}/{level}-{i}-{os.urandom(4).hex()}") for i in range(1 << BITS)]
    held = 0
    for batch in rows:
        radix = (common.mix(batch.column("cell").to_numpy().view(np.uint64), level // 16) >> np.uint64(level % 16 * BITS)) & np.uint64((1 << BITS) - 1)
        order = np.argsort(radix, kind="stable")
        edges = np.searchsorted(radix[order], np.arange((1 << BITS) + 1))
        for i, bucket in enumerate(made):
            if edges[i + 1] > edges[i]:
                bucket.add(batch.take(pa.array(order[edges[i] : edges[i + 1]])))
        held += batch.nbytes
        if held > budget:
            for bucket in made:
                bucket.spill()
            held = 0
    for bucket in made:
        bucket.close()
    return made


def _bounded(batches, budget: int):
    """Tables of consecutive batches, of at most the budget each (or one batch)."""
    held, size = [], 0
    for b in batches:
        if held and size + b.nbytes > budget:
            yield pa.Table.from_batches(held)
            held, size = [], 0
        held.append(b)
        size += b.nbytes
    if held:
        yield pa.Table.from_batches(held)


def _sides(batches, left: bool, piece: int = 1 << 16):
    for b in batches:
        keep = b.filter(pa.array(b.column("left").to_numpy(zero_copy_only=False) == left))
        for i in range(0, keep.num_rows, piece):
            yield keep.slice(i, piece)


def _solve(rows: _Rows, folder: str, level: int, budget: int, visit):
    """All answers of a bucket: probed at once if it fits, else split further, or block by block if it is one cell."""
    if rows.bytes <= budget:
        yield from visit(lambda left: _bounded(_sides(rows.batches(), left), 1 << 62))
    elif rows.mixed:
        for bucket in _split(rows.batches(), folder, level, budget):
            if bucket.bytes:
                yield from _solve(bucket, folder, level + 1, budget, visit)
            bucket.drop()
    else:
        yield from visit(lambda left: _bounded(_sides(rows.batches(), left), budget // 4))


def _grace(batches, budget: int, visit):
    """The answers of a task's rows; nothing is spilled if they fit."""
    with tempfile.TemporaryDirectory() as folder:
        whole = _Rows(f"{folder}/all")
        batches = (b for b in batches if b.num_rows)
        for b in batches:
            whole.add(b)
            if whole.bytes > budget:
                break
        if whole.bytes <= budget:
            if whole.bytes:
                yield from _solve(whole, folder, 0, budget, visit)
            return

        def everything():
            while whole.held:
                yield whole.held.pop()
            yield from batches

        for bucket in _split(everything(), folder, 0, budget):
            if bucket.bytes:
                yield from _solve(bucket, folder, 1, budget, visit)
            bucket.drop()


def _connection():
    import duckdb

    return duckdb.connect(config={"threads": "1", "memory_limit": "400MB", "preserve_insertion_order": "false"})


def _indexed(t: pa.Table) -> pa.Table:
    return t.append_column("i", pa.array(np.arange(t.num_rows)))


def _sums(con, mine: pa.Table, other: pa.Table, keys: list[str], n: np.ndarray, s: np.ndarray, matched: np.ndarray) -> None:
    """Adds the other block's rows and measures to mine."""
    names = ", ".join(["cell", *keys])
    con.register("mine", mine.select(["i", "cell", *keys]))
    con.register("other", other.select(["cell", *keys, "n", "s"]))
    got = con.execute(
        f"SELECT i, o.n, o.s FROM mine JOIN (SELECT {names}, cast(sum(n) AS BIGINT) AS n, cast(sum(s) AS BIGINT) AS s FROM other GROUP BY {names}) o USING ({names})"
    ).fetchnumpy()
    con.unregister("mine")
    con.unregister("other")
    i = np.asarray(got["i"])
    n[i] += np.asarray(got["n"])
    s[i] += np.asarray(got["s"])
    matched[i] = True


def _partner_task(keys: list[str], ids: list[str], budget: int):
    names = ["left", *keys, *ids, "copies", "partners", "partner_sum"]

    def answers(t: pa.Table, n, s, matched):
        t = t.append_column("partners", pa.array(np.where(matched, n, 0))).append_column("partner_sum", pa.array(np.where(matched, s, 0)))
        t = t.filter(t.column("wanted")).rename_columns({"n": "copies"}).select(names)
        yield from t.combine_chunks().to_batches(max_chunksize=1 << 16)

    def run(batches):
        con = _connection()

        def visit(blocks):
            # the right side's answers so far, one entry a row, stay while the left blocks pass
            kept = [(np.zeros(t.num_rows, np.int64), np.zeros(t.num_rows, np.int64), np.zeros(t.num_rows, bool)) for t in blocks(False)]
            for a in blocks(True):
                a = _indexed(a)
                mine = (np.zeros(a.num_rows, np.int64), np.zeros(a.num_rows, np.int64), np.zeros(a.num_rows, bool))
                for b, found in zip(blocks(False), kept):
                    b = _indexed(b)
                    _sums(con, a, b, keys, *mine)
                    _sums(con, b, a, keys, *found)
                yield from answers(a, *mine)
            for b, found in zip(blocks(False), kept):
                yield from answers(_indexed(b), *found)

        yield from _grace(batches, budget, visit)

    return run


def _pair_task(keys: list[str], how: str, condition: str | None, budget: int):
    on = " AND ".join([f"a.{c} = b.{c}" for c in ("cell", *keys)] + ([f"({condition})"] if condition else []))

    def rows(a: pa.Table | None, b: pa.Table | None, i, j):
        """Joined rows of the tables' rows i and j, each as often as its copies say; a missing side is null."""
        copies = (a.column("n").to_numpy()[i] if a is not None else 1) * (b.column("n").to_numpy()[j] if b is not None else 1)
        ends = np.cumsum(copies)
        for first in range(0, int(ends[-1]) if len(ends) else 0, ROWS_OUT):  # a pair of many copies may take several batches
            which = np.searchsorted(ends, np.arange(first, min(first + ROWS_OUT, int(ends[-1]))), "right")
            pick = lambda t, name, ix: t.column(name).take(pa.array(ix[which])).combine_chunks()
            left = pick(a, "l", i) if a is not None else None
            right = pick(b, "r", j) if b is not None else None
            left = pa.nulls(len(which), b.schema.field("l").type) if left is None else left
            right = pa.nulls(len(which), a.schema.field("r").type) if right is None else right
            flat = [x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in (left, right)]
            yield pa.RecordBatch.from_arrays(flat, ["l", "r"])

    def run(batches):
        con = _connection()

        def visit(blocks):
            kept = [np.zeros(t.num_rows, bool) for t in blocks(False)]
            for a in blocks(True):
                a = _indexed(a)
                mine = np.zeros(a.num_rows, bool)
                for b, found in zip(blocks(False), kept):
                    b = _indexed(b)
                    con.register("a", a.select(["i", "cell", *keys, "wanted", "l"]))
                    con.register("b", b.select(["i", "cell", *keys, "r"]))
                    reader = con.execute(f"SELECT a.i AS i, b.i AS j, a.wanted AS w FROM a JOIN b ON {on}").to_arrow_reader(ROWS_OUT)
                    for got in reader:
                        i, j, w = (np.asarray(got.column(x)) for x in ("i", "j", "w"))
                        mine[i] = True
                        found[j] = True
                        if w.any():
                            yield from rows(a, b, i[w], j[w])
                    con.unregister("a")
                    con.unregister("b")
                if how in ("left", "full"):
                    alone = np.flatnonzero(~mine & a.column("wanted").to_numpy())
                    yield from rows(a, None, alone, None)
            if how in ("right", "full"):
                for b, found in zip(blocks(False), kept):
                    alone = np.flatnonzero(~found & b.column("wanted").to_numpy())
                    yield from rows(None, b, None, alone)

        yield from _grace(batches, budget, visit)

    return run


# --- dealing rows to cells ---


def _named(on: list[str]) -> list[str]:
    return [f"k{i}" for i in range(len(on))]


def _checked(left: DataFrame, right: DataFrame, on: list[str]) -> None:
    for df in (left, right):
        for c in on:
            if df.schema[c].dataType.typeName() in ("float", "double"):
                raise ValueError(f"{c} is a floating-point key")


def _hot(left: DataFrame, right: DataFrame, keys: list[str], parts: int) -> DataFrame:
    """(keys, nl, sl, nr, sr, bl, br): rows, sums and blocks of the keys that have more rows on a side than a block; at most four for each partition."""
    counted = [df.where(F.col("known")).groupBy(*keys).agg(F.count("*").alias(f"n{x}"), F.sum("s").alias(f"s{x}")) for df, x in ((left, "l"), (right, "r"))]
    both = counted[0].join(counted[1], keys, "full_outer").na.fill(0, ["nl", "sl", "nr", "sr"])
    both = common.settled(both)
    total = both.agg(F.sum(F.col("nl") + F.col("nr"))).first()[0] or 0
    block = max(LEAST_BLOCK, -(-total // (2 * parts)))
    blocks = {f"b{x}": F.greatest(F.lit(1), F.ceil(F.col(f"n{x}") / block)).cast("int") for x in "lr"}
    return both.where((F.col("nl") > block) | (F.col("nr") > block)).withColumns(blocks)


def _cell(keys: list[str], side: str, block: Column) -> Column:
    return F.xxhash64(*keys, F.lit(side), block)


def partners(left: DataFrame, right: DataFrame, on: list[str], ids: tuple[str, str], measures: tuple[str, str]) -> DataFrame:
    """left (true: a row of left), on, id, copies, partners, partner_sum: for every distinct (on, id, measure) of either side its number of rows, and the number and the sum of the measure of the rows of the other side with equal keys.

    A null key has no partners. Measures are integers, null counts as 0; sums must fit a long. ids may repeat. Empty tables give no rows.
    """
    _checked(left, right, on)
    spark, keys = left.sparkSession, _named(on)
    parts = common.partitions(spark)
    known = F.lit(True)
    for c in on:
        known = known & F.col(c).isNotNull()
    plain = [df.select(*(F.col(c).alias(k) for c, k in zip(on, keys)), F.col(i).alias("id"), F.coalesce(F.col(m).cast("long"), F.lit(0)).alias("s"), known.alias("known")) for df, i, m in zip((left, right), ids, measures)]
    hot = _hot(*plain, keys, parts)
    few = common.maybe_broadcast(hot)
    dealt, alone = [], []
    for df, x, o in zip(plain, "lr", "rl"):
        merged = df.groupBy(*keys, "id", "s", "known").agg(F.count("*").alias("n"))
        side = F.lit(x == "l").alias("left")
        block = F.pmod(F.xxhash64("id", "s"), F.col(f"b{x}")).cast("int")
        here = merged.where("known").join(few.select(*keys, f"b{x}"), keys, "left")
        cell = F.when(F.col(f"b{x}").isNull(), F.xxhash64(*keys)).otherwise(_cell(keys, x, block))
        dealt.append(here.select(cell.alias("cell"), side, F.lit(True).alias("wanted"), *keys, "id", "n", (F.col("n") * F.col("s")).alias("s")))
        # the other side of a hot key, as one weighted row, for each of its blocks
        packed = hot.where(f"n{o} > 0").select(*keys, F.explode(F.sequence(F.lit(0), F.col(f"b{x}") - 1)).alias("block"), F.col(f"n{o}").alias("n"), F.col(f"s{o}").alias("s"))
        dealt.append(packed.select(_cell(keys, x, F.col("block")).alias("cell"), F.lit(x != "l").alias("left"), F.lit(False).alias("wanted"), *keys, F.lit(None).cast(df.schema["id"].dataType).alias("id"), "n", "s"))
        alone.append(merged.where("not known").select(side, *keys, "id", F.col("n").alias("copies"), F.lit(0).cast("long").alias("partners"), F.lit(0).cast("long").alias("partner_sum")))
    rows = dealt[0]
    for d in dealt[1:]:
        rows = rows.unionByName(d)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(["left boolean", *(f"{c} {kinds[c]}" for c in (*keys, "id")), "copies long, partners long, partner_sum long"])
    got = rows.repartition(parts, "cell").mapInArrow(_partner_task(keys, ["id"], BUDGET), schema)
    return got.unionByName(alone[0]).unionByName(alone[1]).select("left", *(F.col(k).alias(c) for c, k in zip(on, keys)), "id", "copies", "partners", "partner_sum")


def join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", condition: str | None = None) -> DataFrame:
    """(l, r): every row of the inner, left, right or full outer join, as structs of the sides' columns, null where a side is missing.

    condition: DuckDB SQL over l and r that pairs must fulfil besides equal keys. Null keys match nothing, repeated rows join as
    often as they occur, columns of both sides may have the same names, empty tables are allowed. Columns must be groupable. A
    hot key's left rows are dealt in blocks, each against all its right rows; for the right rows' own bitmap (right and full joins) it
    is the other way round. Rows of a hot key thus travel as often as the join's own rows call for, and never meet in one task.
    """
    _checked(left, right, on)
    spark, keys = left.sparkSession, _named(on)
    parts = common.partitions(spark)
    known = F.lit(True)
    for c in on:
        known = known & F.col(c).isNotNull()
    plain = [df.select(*(F.col(c).alias(k) for c, k in zip(on, keys)), F.struct(*(F.col(c) for c in df.columns)).alias("row"), F.lit(0).cast("long").alias("s"), known.alias("known")).groupBy(*keys, "row", "s", "known").agg(F.count("*").alias("n")) for df in (left, right)]
    few = common.maybe_broadcast(_hot(*plain, keys, parts))
    kinds = [df.schema["row"].dataType for df in plain]
    shape = lambda df, x: (F.col("row").alias("l") if x == "l" else F.lit(None).cast(kinds[0]).alias("l"), F.col("row").alias("r") if x == "r" else F.lit(None).cast(kinds[1]).alias("r"))
    dealt, alone = [], []
    for df, x, o in zip(plain, "lr", "rl"):
        here = df.where("known").join(few.select(*keys, "bl", "br"), keys, "left")
        block = F.pmod(F.xxhash64("row"), F.col(f"b{x}")).cast("int")
        own = F.struct(F.when(F.col(f"b{x}").isNull(), F.xxhash64(*keys)).otherwise(_cell(keys, x, block)).alias("cell"), F.lit(True).alias("wanted"))
        # as the replicated side: into every block of the other one, where that side's blocks are needed
        copies = F.transform(F.sequence(F.lit(0), F.col(f"b{o}") - 1), lambda b: F.struct(_cell(keys, o, b).alias("cell"), F.lit(False).alias("wanted")))
        cells = F.array(own) if o == "r" and how not in ("right", "full") else F.when(F.col(f"b{o}").isNull(), F.array(own)).otherwise(F.concat(F.array(own), copies))
        if x == "r" and how not in ("right", "full"):  # no bitmap of its own is asked for
            cells = F.when(F.col("bl").isNull(), F.array(own)).otherwise(copies)
        dealt.append(here.select(F.explode(cells).alias("c"), *keys, "row", "n").select("c.cell", F.lit(x == "l").alias("left"), "c.wanted", *keys, "n", *shape(df, x)))
        if how == "full" or how == {"l": "left", "r": "right"}[x]:
            alone.append(df.where("not known").select(*shape(df, x), "n"))
    task = _pair_task(keys, how, condition, BUDGET)
    schema = f"l {kinds[0].simpleString()}, r {kinds[1].simpleString()}"
    out = dealt[0].unionByName(dealt[1]).repartition(parts, "cell").mapInArrow(task, schema)

    def repeated(batches):
        for b in batches:
            n = b.column("n").to_numpy()
            for i in range(b.num_rows):
                for done in range(0, int(n[i]), ROWS_OUT):
                    yield b.select(["l", "r"]).take(pa.array(np.full(min(ROWS_OUT, int(n[i]) - done), i)))

    for df in alone:
        out = out.unionByName(df.mapInArrow(repeated, schema))
    return out


# --- the registered query ---


def _dealt_client(df: DataFrame, key: str) -> tuple[DataFrame, Column]:
    h = F.crc32(F.col(key).cast("string"))
    return F.when(h % 10 < 3, F.floor(h / 10) % 7).otherwise(F.col("client_id")).cast("long")


def _measured(df: DataFrame, key: str, amount: str) -> DataFrame:
    """id, client_id as the query joins it, and the crc32 of `id:cents`."""
    cents = F.coalesce(F.floor(100 * F.col(amount) + 0.5).cast("long").cast("string"), F.lit(""))
    return df.select(F.col(key).alias("id"), _dealt_client(df, key).alias("client_id"), F.crc32(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":"), cents)).alias("crc"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """clicks and sales joined on client_id, as one row for each distinct id of either table.

    The copies of an id are added up; should they differ in client_id, each counts by its own and the least is shown. Null ids are an id of their own.
    """
    clicks, sales = _measured(common.table(spark, sf_dir, "clicks"), "click_id", "value"), _measured(common.table(spark, sf_dir, "sales"), "sale_id", "total")
    got = partners(clicks, sales, ["client_id"], ("id", "id"), ("crc", "crc"))
    n, p = F.col("copies"), F.col("partners")
    outer = n * F.greatest(p, F.lit(1))
    rows = got.select(F.when(F.col("left"), "click").otherwise("sale").alias("side"), "id", "client_id", n, (n * p).alias("inner_rows"), F.when(F.col("left"), outer).otherwise(n * p).alias("left_rows"), outer.alias("full_rows"), (n * F.col("partner_sum")).alias("partner_crc"))
    sums = ("copies", "inner_rows", "left_rows", "full_rows", "partner_crc")
    return rows.groupBy("side", "id").agg(F.min("client_id").alias("client_id"), *(F.sum(c).alias(c) for c in sums))
