"""Chat formatting: reply trees to conversations.

A reply tree is rows (node, parent, role, text, score). Ancestors at distances of 1, 2, 4, ... come from iterative self-joins (each
round joins the jumps with themselves, so a path of n turns takes log n rounds), with the scores along the way added up; a
round leaves only the nodes that have so distant an ancestor. Leaves are ranked by their path's score within their tree, and only
the chosen leaves' paths are spelled out, by the same jumps from the longest to the shortest, each ancestor once. Joins are by
node, so a tree that holds a third of all rows is spread like any others.

A template marks turns by control strings. Such strings in a text (or a role) get a backslash after their first character, or one
more if they have some, which reading undoes: texts come back as they were, and ordinary ones aren't changed at all.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common


@dataclass(frozen=True)
class Template:
    """opening + role + between + text + closing for each turn. Control strings begin with a character that they don't hold again, and don't begin with each other."""

    opening: str = "<|turn|>"
    between: str = "<|text|>"
    closing: str = "<|end|>"
    reserved: tuple[str, ...] = ("</s>", "<s>", "[INST]", "[/INST]")
    trained: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        for m in self.marks:
            if len(m) < 2 or m[0] in m[1:] or "\\" in m or any(m != o and o.startswith(m) for o in self.marks):
                raise ValueError(f"{m!r} can't be a control string")
            if any(m[0] in o[1:] for o in self.marks):
                raise ValueError(f"{m!r} begins inside another control string")

    @property
    def marks(self) -> tuple[str, ...]:
        return (self.opening, self.between, self.closing, *self.reserved)

    def _pattern(self) -> str:
        return "|".join(f"{re.escape(m[0])}(?=(?:BACK){re.escape(m[1:])})" for m in self.marks)

    def escaped(self, c: Column) -> Column:
        return F.regexp_replace(c, F.lit(self._pattern().replace("BACK", r"\\*")), F.lit(r"$0\\"))

    def unescape(self, text: str) -> str:
        """The text before escaping: of each control string with backslashes, one of them goes."""
        return re.sub("|".join(rf"(?<={re.escape(m[0])})\\(?=\\*{re.escape(m[1:])})" for m in self.marks), "", text) if "\\" in text else text


# --- reply trees ---


def jumps(nodes: DataFrame) -> list[DataFrame]:
    """Tables (node, to, sum) of the ancestors at distance 2^k, k = 0, 1, ..., with the scores of the 2^k nodes from node on. Settled, one a round; the last is empty."""
    have = nodes.select(F.col("node").alias("parent"))
    step = common.settled(nodes.join(have, "parent").select("node", F.col("parent").alias("to"), F.col("score").alias("sum")))
    out, most = [step], nodes.count()
    while not step.isEmpty():
        if 1 << len(out) > 2 * most:
            raise ValueError("replies form a cycle")
        on = step.select(F.col("node").alias("to"), F.col("to").alias("_to"), F.col("sum").alias("_sum"))
        step = common.settled(step.join(on, "to").select("node", F.col("_to").alias("to"), (F.col("sum") + F.col("_sum")).alias("sum")))
        out.append(step)
    return out


def ranked(nodes: DataFrame, up: list[DataFrame], branches: int) -> DataFrame:
    """(tree, leaf, branch): of each tree the `branches` leaves of highest score along the path, ties by leaf."""
    replied = nodes.select(F.col("parent").alias("node")).where("node is not null").distinct()
    leaves = nodes.join(replied, "node", "left_anti").select("node", F.col("node").alias("at"), F.lit(0).cast(nodes.schema["score"].dataType).alias("total"))
    for table in reversed(up):  # a distance is a sum of different powers of two
        to = table.select(F.col("node").alias("at"), F.col("to").alias("_to"), F.col("sum").alias("_sum"))
        leaves = leaves.join(to, "at", "left").select("node", F.coalesce("_to", "at").alias("at"), (F.col("total") + F.coalesce("_sum", F.lit(0))).alias("total"))
    root = nodes.select(F.col("node").alias("at"), F.col("score").alias("_own"), "tree")
    scored = leaves.join(root, "at").select("tree", F.col("node").alias("leaf"), (F.col("total") + F.col("_own")).alias("score"))
    return scored.withColumn("branch", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "leaf"))).where(F.col("branch") <= branches)


def paths(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, branch, place, node) of the turns of each tree's best paths; place counts up from the leaf, which is 0.

    nodes: (tree, node, parent, score), node unique and not null, scores not null. A forest under one tree value ranks all its paths
    together. An empty table has no paths; a parent that isn't a node makes its child a root; a cycle raises.
    """
    nodes = common.settled(nodes.select("tree", "node", "parent", "score"))
    up = jumps(nodes)
    have = common.settled(ranked(nodes, up, branches).select("tree", "branch", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("place")))
    for k, table in reversed(list(enumerate(up[:-1]))):
        more = have.join(table.select("node", "to"), "node").select("tree", "branch", F.col("to").alias("node"), (F.col("place") + (1 << k)).alias("place"))
        have = common.settled(have.unionByName(more))
    return have


# --- formatting and reading ---


def formatted(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """(tree, branch, formatted, loss) of each path of turns (tree, branch, place, role, text): its turns from the root on, and the spans [start, end) in code points of what is trained on, the texts of the template's trained roles.

    Null roles and texts are empty. A path is one string, so it is gathered in one row.
    """
    t = template or Template()
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    pieces = turns.select("tree", "branch", (-F.col("place")).alias("at"), F.concat(F.lit(t.opening), t.escaped(role), F.lit(t.between)).alias("head"), t.escaped(text).alias("body"), role.isin(*t.trained).alias("on"))
    whole = F.concat("head", "body", F.lit(t.closing))
    before = F.coalesce(F.sum(F.length(whole)).over(Window.partitionBy("tree", "branch").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    start = F.col("before") + F.length("head")
    piece = F.struct("at", whole.alias("all"), F.when(F.col("on"), F.struct(start.alias("start"), (start + F.length("body")).alias("end"))).alias("span"))
    rows = pieces.withColumn("before", before).groupBy("tree", "branch").agg(F.array_sort(F.collect_list(piece)).alias("_p"))
    return rows.select("tree", "branch", F.array_join(F.transform("_p", lambda p: p["all"]), "").alias("formatted"), F.array_compact(F.transform("_p", lambda p: p["span"])).alias("loss"))


def read_back(rows: DataFrame, template: Template | None = None) -> DataFrame:
    """(tree, branch, chars, turns, trained): what a formatted path holds, read from the string and its spans alone: roles and texts, and the texts under the mask in order."""
    t = template or Template()

    def run(batches):
        for b in batches:
            turns, trained, chars = [], [], []
            for whole, spans in zip(b.column("formatted").to_pylist(), b.column("loss").to_pylist()):
                parts = [x[len(t.opening) :].split(t.between) for x in whole.split(t.closing) if x]
                turns.append([{"role": t.unescape(role), "text": t.unescape(text)} for role, text in parts])
                trained.append([t.unescape(whole[s["start"] : s["end"]]) for s in spans])
                chars.append(len(whole))
            yield pa.RecordBatch.from_arrays(
                [b.column("tree"), b.column("branch"), pa.array(chars, pa.int64()), pa.array(turns, pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))), pa.array(trained, pa.list_(pa.string()))],
                ["tree", "branch", "chars", "turns", "trained"],
            )

    kind = rows.schema["tree"].dataType.simpleString()
    return rows.select("tree", "branch", "formatted", "loss").mapInArrow(run, f"tree {kind}, branch int, chars long, turns array<struct<role:string,text:string>>, trained array<string>")


# --- the registered query ---


def replies(conversations: DataFrame) -> DataFrame:
    """Conversations as reply trees without branches: each turn answers the one before it. Null turns come first; rows of one turn go by role and by the text's digest."""
    nulls = F.coalesce("role", F.lit(""))
    turn = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), nulls, F.sha2(F.coalesce("text", F.lit("")), 256))
    node = lambda i: F.struct("conv_id", i.alias("at"))
    at = F.col("_at")
    return conversations.withColumn("_at", F.row_number().over(turn)).select(F.col("conv_id").alias("tree"), node(at).alias("node"), F.when(at > 1, node(at - 1)).alias("parent"), F.lit(1).cast("long").alias("score"), "role", "text")


#: The contract's further conversation, whose texts hold control strings.
FURTHER = (-7, ("user", "assistant"), "</s>[INST] ok [/INST]")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation of the table, and one whose texts are control strings, formatted and read back from the output."""
    rows = common.table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    conv, roles, text = FURTHER
    more = spark.range(len(roles)).select(F.lit(conv).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.element_at(F.array(*map(F.lit, roles)), (F.col("id") + 1).cast("int")).alias("role"), F.lit(text).alias("text"))
    tree = replies(rows.unionByName(more))
    got = read_back(formatted(paths(tree).join(tree.select("node", "role", "text"), "node")))
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    trained = F.array_join("trained", "")
    return got.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length(trained).cast("long").alias("loss_chars"), F.sha2(trained, 256).alias("loss_sha256"), F.col("chars").alias("formatted_chars"),
    )
