"""Repair of conversation structure: the cheapest edits that make the turns follow `(s?(ua)+)?`, s, u and a being initials of roles.

Rows are marked with their first fault (blank, duplicate, truncated) and each conversation becomes a signature, one letter
a row: the role's initial, upper-case if the row is truncated, or x for a row that has to go. Conversations are sorted by
signature over the whole table; a task inserts its run of them into a prefix trie, computes the layer of the dynamic
programme once for each node, and answers at terminal nodes. In sorted order only the trie's latest path is ever needed again, so
only that is kept. A signature that a third of all conversations have is dealt over tasks by conv_id.

A layer holds, for each state of the grammar, the least cost of the rows so far, the rank of its least audit, and where
it came from. Audits of one layer end in a letter that used up the last row, so none is a prefix of another one, and
ranks decide ties without any string. Insertions wait until a row needs them (after deletions, as D precedes I) or until the end.

A conversation's texts are hashed as a stream in turn order, so neither they nor its rows are held together; only its letters
are, since the audit is one value.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
#: What is white in a blank text (fixed by the contract).
WHITE = " \t\n\x0b\x0c\r"
#: States: nothing yet, after a system turn, after a user's, after an assistant's (where a conversation may end).
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: state -> (role that may be inserted there or given to a row, state after it)
TURN = {EMPTY: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
_FAR = 1 << 40


def _after(state: int, initial: str) -> int | None:
    """The state after a row of this initial; None if it may not stand there."""
    if initial == "s":
        return SYSTEM if state == EMPTY else None
    return TURN[state][1] if TURN[state][0][0] == initial else None


def _moves(state: int, letter: str):
    """(cost, letters, next state) of every way to use up a row of this letter."""
    yield DELETE, "D", state
    if letter == "x":
        return
    cut = CUT if letter.isupper() else 0
    for inserted, cost, at in (("", 0, state), ("I", INSERT, TURN[state][1])):
        if (kept := _after(at, letter.lower())) is not None:
            yield cost + KEEP + cut, inserted + "K", kept
        yield cost + REROLE + cut, inserted + "R", TURN[at][1]


class Layers:
    """Layers of the dynamic programme; equal steps are worked out once, since costs count from the layer's least."""

    START = ((0, _FAR, _FAR, _FAR), (0, 0, 0, 0))

    def __init__(self):
        self._steps: dict = {}

    def step(self, layer, letter: str):
        """(layer, (previous state, letters) of each state, cost of the layer's least) after one more row."""
        if (found := self._steps.get((layer, letter))) is None:
            found = self._steps[layer, letter] = self._work(layer, letter)
        return found

    @staticmethod
    def _work(layer, letter):
        costs, ranks = layer
        best: dict[int, tuple] = {}
        for state in range(4):
            if costs[state] < _FAR:
                for cost, letters, to in _moves(state, letter):
                    way = (costs[state] + cost, ranks[state], letters, state)
                    if to not in best or way < best[to]:
                        best[to] = way
        order = {to: i for i, to in enumerate(sorted(best, key=lambda to: best[to][1:3]))}
        base = min(way[0] for way in best.values())
        made = tuple(best[s][0] - base if s in best else _FAR for s in range(4)), tuple(order.get(s, 0) for s in range(4))
        return made, tuple((best[s][3], best[s][2]) if s in best else None for s in range(4)), base


class Trie:
    """The latest path of a prefix trie into which signatures are inserted in order; each node has its layer."""

    def __init__(self):
        self.layers, self.path, self.nodes = Layers(), "", 0
        self.stack = [(Layers.START, None, 0)]

    def answer(self, signature: str) -> tuple[str, int]:
        """(audit, cost) at the signature's terminal node; only nodes that the last path lacks are made."""
        same = _common(self.path, signature)
        del self.stack[same + 1 :]
        for letter in signature[same:]:
            layer, ways, base = self.layers.step(self.stack[-1][0], letter)
            self.stack.append((layer, ways, self.stack[-1][2] + base))
            self.nodes += 1
        self.path = signature
        (costs, _), _, base = self.stack[-1]
        ends = {EMPTY: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
        least = min(costs[s] + INSERT * len(end) for s, end in ends.items())
        return min(self._audit(s) + end for s, end in ends.items() if costs[s] + INSERT * len(end) == least), base + least

    def _audit(self, state: int) -> str:
        out = []
        for _, ways, _ in reversed(self.stack[1:]):
            state, letters = ways[state]
            out.append(letters)
        return "".join(reversed(out))


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x, y = (np.frombuffer(v[:n].encode(), np.uint8) for v in (a, b))
    return int(np.flatnonzero(x != y)[0])


# --- rows, faults, signatures ---


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copy, gone: the rows after the contract's damage; dropped ones stay, as gone. Nulls of role and text, and in the string that is hashed, are one space."""
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    name = F.concat(*(F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(":") for c in ("conv_id", ":", "turn")))
    code = F.crc32(name) % 20
    return conversations.select(
        "conv_id", "turn", F.when(code == 4, "user").otherwise(role).alias("role"), F.when(code == 1, "").when(code == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(code == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"), (code == 0).alias("gone"),
    )


#: Rows of a conversation in order; what the turn leaves open goes by role and by the text's digest.
ORDER = ("turn", "role", "digest", "copy")


def _digested(rows: DataFrame) -> DataFrame:
    return rows.withColumn("digest", F.unhex(F.sha2("text", 256)))


def signatures(rows: DataFrame) -> DataFrame:
    """conv_id, signature, gaps, blank, duplicate, truncated, illegal of every conversation of rows (conv_id, turn, role, text, copy, gone).

    Rows that are gone only name their conversation. A null conv_id is a conversation too. Texts don't travel, only their digests. One shuffle, by conversation.
    """
    trimmed = F.rtrim(F.col("text"), F.lit(WHITE))
    slim = _digested(rows).select(
        "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "role", "digest", "copy", "gone", (trimmed == "").alias("blank"), (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("cut")
    )
    again = F.row_number().over(Window.partitionBy("conv_id", "gone", "role", "digest").orderBy(F.col("turn").asc_nulls_first(), "copy")) > 1
    kept = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    fault = F.when(F.col("gone"), "g").when(F.col("blank"), "b").when(F.col("again"), "d").when(F.col("cut"), F.upper(kept)).otherwise(kept)
    marked = slim.repartition(common.partitions(rows.sparkSession), "conv_id").withColumn("again", again).withColumn("fault", fault)
    ordered = marked.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "digest", "copy").select("conv_id", "turn", "initial", "fault")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return ordered.mapInArrow(_signed, f"conv_id {kinds['conv_id']}, signature string, gaps long, blank long, duplicate long, truncated long, illegal long")


_LEGAL = ("su", "ua", "au")


def _signed(batches):
    """One row for each conversation of rows sorted by conversation and turn; one may go on in the next batch."""
    names = ("conv_id", "signature", "gaps", "blank", "duplicate", "truncated", "illegal")
    now, state = None, None  # the open conversation: its id in a tuple; letters, counts, turns, last initial

    def closed(key, s):
        letters = b"".join(s["letters"]).decode()
        gaps = s["max"] - s["min"] + 1 - s["turns"] if s["turns"] else 0
        return (key[0], letters, gaps, s["blank"], s["duplicate"], s["truncated"], s["illegal"])

    kinds = None
    for batch in batches:
        if not batch.num_rows:
            continue
        kinds = kinds or batch.schema.field("conv_id").type
        ids, turns = batch.column("conv_id").to_pylist(), batch.column("turn").to_pylist()
        initials, faults = batch.column("initial").to_pylist(), np.array(batch.column("fault").to_pylist(), "U1")
        edges = [0, *(i for i in range(1, len(ids)) if ids[i] != ids[i - 1]), len(ids)]
        out = []
        for a, b in zip(edges, edges[1:]):
            if now != (ids[a],):
                if now is not None:
                    out.append(closed(now, state))
                now, state = (ids[a],), dict(letters=[], blank=0, duplicate=0, truncated=0, illegal=0, min=None, max=None, turns=0, last=None)
            here = faults[a:b]
            stay = np.flatnonzero(here != "g")
            if not len(stay):
                continue
            f = here[stay]
            state["letters"].append("".join(np.where((f == "b") | (f == "d"), "x", f)).encode())
            state["blank"] += int((f == "b").sum())
            state["duplicate"] += int((f == "d").sum())
            state["truncated"] += int(np.isin(f, list("SUAO")).sum())
            for i in stay:
                if state["last"] is not None:
                    state["illegal"] += state["last"] + initials[a + i] not in _LEGAL
                state["last"] = initials[a + i]
                if (t := turns[a + i]) is not None:
                    state["turns"] += t != state["max"]
                    state["min"], state["max"] = t if state["min"] is None else state["min"], t
        if out:
            yield _made(out, names, kinds)
    if now is not None:
        yield _made([closed(now, state)], names, kinds)


def _made(rows, names, kind) -> pa.RecordBatch:
    columns = list(zip(*rows))
    kinds = [kind, pa.string(), *[pa.int64()] * (len(names) - 2)]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], list(names))


def audited(signed: DataFrame) -> DataFrame:
    """signed with audit and cost: the least costly edits' letters, of equally costly ones the least in ASCII."""
    spark = signed.sparkSession
    dealt = signed.repartitionByRange(common.partitions(spark), "signature", "conv_id").sortWithinPartitions("signature", "conv_id")

    def run(batches):
        trie, last, found = Trie(), None, ("", 0)
        for batch in batches:
            audits, costs = [], []
            for signature in batch.column("signature").to_pylist():
                if signature != last:
                    last, found = signature, trie.answer(signature)
                audits.append(found[0])
                costs.append(found[1])
            columns = {n: batch.column(n) for n in batch.schema.names if n != "signature"} | {"audit": pa.array(audits, pa.string()), "cost": pa.array(costs, pa.int64())}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in signed.schema if f.name != "signature")
    return dealt.mapInArrow(run, f"{schema}, audit string, cost long")


def edits(audit: str):
    """(letter, role) of each edit: the role that an insertion has or that a row gets; None for rows that keep theirs or go. Needs no rows but for K, which the caller reports by send(initial)."""
    state = EMPTY
    for letter in audit:
        role = TURN[state][0] if letter in "RI" else None
        initial = yield letter, role
        if letter in "RI":
            state = TURN[state][1]
        elif letter == "K":
            state = _after(state, initial)


def repaired(rows: DataFrame, answers: DataFrame) -> DataFrame:
    """answers with repaired_sha256: the digest of the repaired conversation's `role:text` lines. Texts travel once, by conversation, and are hashed as they come."""
    more = [c for c in answers.columns if c != "conv_id"]
    texts = _digested(rows).where("not gone").select("conv_id", F.lit(1).alias("kind"), *ORDER, "text", *(F.lit(None).cast(answers.schema[c].dataType).alias(c) for c in more))
    blank = {f.name: f.dataType for f in texts.schema}
    heads = answers.select("conv_id", F.lit(0).alias("kind"), *(F.lit(None).cast(blank[c]).alias(c) for c in (*ORDER, "text")), *more)
    dealt = heads.unionByName(texts).repartition(common.partitions(rows.sparkSession), "conv_id").sortWithinPartitions("conv_id", "kind", F.col("turn").asc_nulls_first(), "role", "digest", "copy")
    kinds = {f.name: f.dataType.simpleString() for f in answers.schema}

    def run(batches):
        now, made = None, None  # the open conversation's answers, and its digest as a coroutine
        for batch in batches:
            out = {c: [] for c in (*answers_columns, "repaired_sha256")}
            kind, role, text = (batch.column(c).to_pylist() for c in ("kind", "role", "text"))
            heads = {c: batch.column(c) for c in answers_columns}
            for i, k in enumerate(kind):
                if k == 0:
                    if now is not None:
                        _close(out, now, made)
                    now = {c: heads[c][i].as_py() for c in answers_columns}
                    made = _Digest(now["audit"])
                else:
                    made.row(role[i], text[i])
            if out["audit"]:
                yield _typed(out, heads)
        if now is not None:
            out = {c: [] for c in (*answers_columns, "repaired_sha256")}
            _close(out, now, made)
            yield _typed(out, heads)

    answers_columns = ["conv_id", *more]
    schema = ", ".join(f"{c} {kinds[c]}" for c in answers_columns)
    return dealt.select(*answers_columns, "kind", "role", "text").mapInArrow(run, f"{schema}, repaired_sha256 string")


def _close(out: dict, now: dict, made: _Digest) -> None:
    for c, v in now.items():
        out[c].append(v)
    out["repaired_sha256"].append(made.end())


def _typed(out: dict, like: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, like[c].type if c in like else pa.string()) for c, v in out.items()], list(out))


class _Digest:
    """SHA-256 of a repaired conversation, fed with its rows in order."""

    def __init__(self, audit: str):
        self.edits, self.hash, self.first = edits(audit), hashlib.sha256(), True
        self.next = next(self.edits, None)

    def _line(self, role: str, text: str) -> None:
        self.hash.update((("" if self.first else "\n") + f"{role}:{text}").encode())
        self.first = False

    def _on(self, initial: str | None = None) -> None:
        try:
            self.next = self.edits.send(initial)
        except StopIteration:
            self.next = None

    def _insert(self) -> None:
        while self.next and self.next[0] == "I":
            self._line(self.next[1], "")
            self._on()

    def row(self, role: str, text: str) -> None:
        self._insert()
        letter, given = self.next
        if letter != "D":
            self._line(given or role, text)
        self._on(role[:1])

    def end(self) -> str:
        self._insert()
        return self.hash.hexdigest()


def repair(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, audit, cost, repaired_sha256 of every conversation of rows (conv_id, turn, role, text, copy, gone).

    Roles and texts aren't null. A conversation without rows has zeros, an empty audit and the digest of nothing; an empty table has no rows. Other columns are
    ignored. Repeated rows are duplicates of each other; rows of one turn are ordered by role and by the text's digest.
    """
    rows = rows.select("conv_id", "turn", "role", "text", "copy", "gone")
    return repaired(rows, audited(common.settled(signatures(rows))))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = repair(damaged(common.table(spark, sf_dir, "conversations")))
    return got.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
