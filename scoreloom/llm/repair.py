"""Repair of the structure of conversations: faults of their turns, and the cheapest edits that give a legal order of roles.

Rows are ordered over the whole table, so a conversation of any size lies in blocks of bounded size. In a block, a
program over the states of the role pattern keeps the cheapest audit, the first by ASCII of equally cheap ones, from
each state it may begin in to each it may end in. Audits share their prefixes: they are nodes of a tree, with ancestors
at powers of two and a rolling hash. A tie is settled at the longest common prefix, found by the ancestors; equal hashes
are verified by the letters. Blocks of a conversation are then put together by these tables, in order.

Equally cheap audits of the same rows are never one the prefix of the other: the longer one would have insertions more,
and so cost more. So the first of them stays the first whatever follows, which makes both steps exact.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States of the pattern (s?(ua)+)?: at its begin, after s, after u, after a.
STATES = BEGIN, SYSTEM, USER, ASSISTANT = range(4)
#: The state that a kept role's initial leads to, and the states it may follow.
FOLLOWS = {"s": (SYSTEM, (BEGIN,)), "u": (USER, (BEGIN, SYSTEM, ASSISTANT)), "a": (ASSISTANT, (USER,))}
NEXT = {BEGIN: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
#: What a legal end still needs in each state.
ENDING = {BEGIN: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}

CLEAN, CUT_OFF, GONE = range(3)
BLOCK = 1_024
MODULUS = (1 << 61) - 1
BASE = random.Random(42).randrange(1 << 32, MODULUS)


class Audits:
    """Audits as nodes: a node is its parent's audit and one letter more. Node 0 is the empty audit."""

    def __init__(self):
        self.letter, self.depth, self.hash = [""], [0], [0]
        self.up: list[list[int]] = [[]]  # ancestors 1, 2, 4, ... letters before

    def add(self, node: int, letter: str) -> int:
        ups, k = [node], 0
        while len(self.up[ups[k]]) > k:
            ups.append(self.up[ups[k]][k])
            k += 1
        self.letter.append(letter)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * BASE + ord(letter)) % MODULUS)
        self.up.append(ups)
        return len(self.up) - 1

    def prefix(self, node: int, depth: int) -> int:
        """The node of the first `depth` letters."""
        left, k = self.depth[node] - depth, 0
        while left:
            if left & 1:
                node = self.up[node][k]
            left, k = left >> 1, k + 1
        return node

    def same(self, a: int, b: int) -> bool:
        """Whether nodes of one depth have the same letters; equal hashes are verified up to a common node."""
        if self.hash[a] != self.hash[b]:
            return False
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def before(self, a: int, b: int) -> bool:
        """Whether audit a is less than audit b."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.prefix(a, depth), self.prefix(b, depth)
        if self.same(x, y):
            return self.depth[a] < self.depth[b]
        for k in reversed(range(len(self.up[x]))):
            if k < len(self.up[x]) and not self.same(self.up[x][k], self.up[y][k]):
                x, y = self.up[x][k], self.up[y][k]
        return self.letter[x] < self.letter[y]

    def text(self, node: int) -> str:
        letters = []
        while node:
            letters.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(letters))


class Edits:
    """The cheapest audit to each state, from one state on, over rows that are given in order."""

    def __init__(self, begin: int):
        self.audits = Audits()
        self.best: list[tuple[int, int] | None] = [(0, 0) if s == begin else None for s in STATES]

    def _offer(self, to: list, state: int, cost: int, node: int, letter: str) -> bool:
        old = to[state]
        if old is not None and cost > old[0]:
            return False
        new = self.audits.add(node, letter)
        if old is None or cost < old[0] or self.audits.before(new, old[1]):
            to[state] = (cost, new)
            return True
        return False

    def row(self, initial: str, fault: int) -> None:
        self._insert()
        to: list[tuple[int, int] | None] = [None] * len(STATES)
        extra = TRUNCATED if fault == CUT_OFF else 0
        for state, old in enumerate(self.best):
            if old is None:
                continue
            cost, node = old
            self._offer(to, state, cost + DELETE, node, "D")
            if fault == GONE:
                continue
            kept, after = FOLLOWS.get(initial, (None, ()))
            if state in after:
                self._offer(to, kept, cost + KEEP + extra, node, "K")
            self._offer(to, NEXT[state], cost + REROLE + extra, node, "R")
        self.best = to

    def _insert(self) -> None:
        """Up to two rows inserted here; a third would lead back to a state that was there before."""
        open_ = list(STATES)
        for _ in range(2):
            old, changed = list(self.best), []
            for state in open_:
                if old[state] is not None and self._offer(self.best, NEXT[state], old[state][0] + INSERT, old[state][1], "I"):
                    changed.append(NEXT[state])
            open_ = changed


def table(rows: list[tuple[str, int]], begins: tuple[int, ...]) -> tuple[list[int], list[str]]:
    """(costs, audits) from state p to state q at place 4 * p + q; cost -1 where there is none."""
    costs, audits = [-1] * 16, [""] * 16
    for p in begins:
        edits = Edits(p)
        for initial, fault in rows:
            edits.row(initial, fault)
        for q, best in enumerate(edits.best):
            if best is not None:
                costs[4 * p + q], audits[4 * p + q] = best[0], edits.audits.text(best[1])
    return costs, audits


def common(x: str, y: str) -> int:
    """Length of the longest common prefix."""
    low, high = 0, min(len(x), len(y))
    while low < high:
        middle = (low + high + 1) // 2
        if x[low:middle] == y[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Chain:
    """Tables of a conversation's blocks put together, in order.

    For each two states `tails` has what is left of their audits after their common prefix, cut to a letter where they
    differ. So a tie takes time in proportion to a block. Four audits of each block are held: four letters for an edit.
    """

    def __init__(self):
        self.costs: list[int | None] = [0, None, None, None]
        self.tails: dict[tuple[int, int], tuple[str, str]] = {}
        self.taken: list[tuple[list[int], list[str]]] = []

    def _differ(self, p: int, x: str, q: int, y: str) -> tuple[str, str]:
        """Tails of the audit of p followed by x, and that of q followed by y."""
        if p != q:
            a, b = self.tails[p, q]
            if a and b:
                return a, b
            x, y = a + x, b + y
        n = common(x, y)
        x, y = x[n:], y[n:]
        return (x[0], y[0]) if x and y else (x, y)

    def add(self, costs: list[int], audits: list[str]) -> None:
        new: list[int | None] = [None] * 4
        froms, texts = [0] * 4, [""] * 4
        for q in STATES:
            for p in STATES:
                if self.costs[p] is None or costs[4 * p + q] < 0:
                    continue
                cost, audit = self.costs[p] + costs[4 * p + q], audits[4 * p + q]
                if new[q] is not None and cost == new[q]:
                    x, y = self._differ(p, audit, froms[q], texts[q])
                    better = x < y
                else:
                    better = new[q] is None or cost < new[q]
                if better:
                    new[q], froms[q], texts[q] = cost, p, audit
        live = [q for q in STATES if new[q] is not None]
        self.tails = {(p, q): self._differ(froms[p], texts[p], froms[q], texts[q]) for p in live for q in live if p != q}
        self.costs = new
        self.taken.append((froms, texts))

    def end(self) -> tuple[int, str]:
        """(cost, audit) of the whole conversation."""
        costs, audits = [-1] * 16, [""] * 16
        for p, ending in ENDING.items():
            costs[4 * p], audits[4 * p] = INSERT * len(ending), ending
        self.add(costs, audits)
        state, parts = 0, []
        for froms, texts in reversed(self.taken):
            parts.append(texts[state])
            state = froms[state]
        return self.costs[0], "".join(reversed(parts))


class Rendered:
    """The hash of the repaired rows, from rows in order and the audit."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.any, self.sum = audit, 0, BEGIN, False, hashlib.sha256()

    def _write(self, role: str, text: str) -> None:
        self.sum.update(("\n" * self.any + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.any = True

    def _turn(self, text: str) -> None:
        self.state = NEXT[self.state]
        self._write(ROLES[self.state], text)

    def _inserted(self) -> None:
        while self.audit.startswith("I", self.at):
            self._turn("")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.state = FOLLOWS[role[0]][0]
            self._write(role, text)
        elif letter == "R":
            self._turn(text)

    def digest(self) -> str:
        self._inserted()
        return self.sum.hexdigest()


COUNTED = ("blank", "duplicate", "truncated", "illegal")
PART = {
    "conv_id": "long", "part": "int", "block": "long", "costs": "array<long>", "audits": "array<string>",
    "first": "string", "last": "string", "low": "long", "high": "long", "turns": "long", **dict.fromkeys(COUNTED, "long"),
}
RESULT = {"conv_id": "long", "gaps": "long", **dict.fromkeys(COUNTED, "long"), "cost": "long", "audit": "string", "repaired_sha256": "string"}
_ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
OUT_ROWS = 512


def _ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{c} {t}" for c, t in columns.items())


def _batch(rows: list[dict], columns: dict[str, str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, pa.schema([(c, _ARROW[t]) for c, t in columns.items()]))


def _batched(rows: Iterator[dict], columns: dict[str, str]) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == OUT_ROWS:
            yield _batch(held, columns)
            held = []
    if held:
        yield _batch(held, columns)


def _tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, OUT_ROWS):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, OUT_ROWS).columns), strict=True)


class _Block:
    """Rows of one conversation that follow each other, and what is counted in them."""

    def __init__(self, begins: tuple[int, ...]):
        self.begins, self.rows = begins, []
        self.first = self.last = self.low = self.high = None
        self.turns = 0
        self.counts = dict.fromkeys(COUNTED, 0)

    def add(self, turn: int | None, initial: str, fault: str | None) -> None:
        if self.last is None:
            self.first = initial
        else:
            self.counts["illegal"] += self.last + initial not in LEGAL
        self.last = initial
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        if fault:
            self.counts[fault] += 1
        self.rows.append((initial, {None: CLEAN, "truncated": CUT_OFF}.get(fault, GONE)))

    def record(self, conv_id: int | None, part: int, block: int) -> dict:
        costs, audits = table(self.rows, self.begins)
        about = {c: getattr(self, c) for c in ("first", "last", "low", "high", "turns")}
        return {"conv_id": conv_id, "part": part, "block": block, "costs": costs, "audits": audits, **about, **self.counts}


def _blocks(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks of rows (conv_id, turn, initial, blank, truncated, seen, n) in order.

    The first conversation of a task may have begun in the task before, so its block has audits from every state.
    """

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        part, block, at, conv = TaskContext.get().partitionId(), None, 0, None
        for conv_id, turn, initial, blank, truncated, seen, n in _tuples(batches):
            if block is None or conv_id != conv:
                if block is not None:
                    yield block.record(conv, part, at)
                begins = STATES if block is None else (BEGIN,)
                conv, at, block = conv_id, 0, _Block(tuple(begins))
            for copy in range(n):
                if len(block.rows) == most:
                    yield block.record(conv, part, at)
                    at, block = at + 1, _Block(tuple(STATES))
                fault = "blank" if blank else "duplicate" if seen or copy else "truncated" if truncated else None
                block.add(turn, initial, fault)
        if block is not None:
            yield block.record(conv, part, at)

    return lambda batches: _batched(records(batches), PART)


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each conversation first its blocks, then its rows (n, role, text), both in order."""

    def rows() -> Iterator[dict]:
        conv, chain, rendered, out, last, high = None, None, None, {}, None, None
        low = turns = None

        def closed() -> dict:
            nonlocal rendered
            gaps = 0 if low is None else min(high - low + 1 - turns, (1 << 63) - 1)
            started()
            return {**out, "conv_id": conv, "gaps": gaps, "repaired_sha256": rendered.digest()}

        def started() -> None:
            nonlocal rendered
            if rendered is None:
                out["cost"], out["audit"] = chain.end()
                rendered = Rendered(out["audit"])

        for conv_id, is_row, block, n, role, text in _tuples(batches):
            if chain is None or conv_id != conv:
                if chain is not None:
                    yield closed()
                conv, chain, rendered, out = conv_id, Chain(), None, dict.fromkeys(COUNTED, 0)
                last, low, high, turns = None, None, None, 0
            if not is_row:
                chain.add(block["costs"], block["audits"])
                for c in COUNTED:
                    out[c] += block[c]
                if block["first"] is not None:
                    out["illegal"] += last is not None and last + block["first"] not in LEGAL
                    last = block["last"]
                if block["low"] is not None:
                    turns += block["turns"] - (high == block["low"])
                    low, high = block["low"] if low is None else low, block["high"]
            else:
                started()
                for _ in range(n):
                    rendered.row(role, text)
        if chain is not None:
            yield closed()

    yield from _batched(rows(), RESULT)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n) with n copies of each row: faults by crc32 of `conv_id:turn`, nulls as one space."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("n"),
    )


def undamaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n) of rows as they are, nulls as one space."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return conversations.select(
        *(F.col(c).cast("long").alias(c) for c in ("conv_id", "turn")), role.alias("role"), text.alias("text"), F.lit(1).alias("n")
    )


def identity() -> Column:
    """Names rows of equal role and text, and orders rows of one turn."""
    return F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))


def audited(rows: DataFrame, most: int = BLOCK) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) for every conv_id.

    `rows`: (conv_id, turn, role, text, n), of which n copies stand one after another; conversations whose rows have n
    of 0 only have zeros, an empty audit and the hash of nothing. Rows follow each other by turn, null turns first,
    rows of one turn by the md5 of role and text; equal rows are duplicates of the first. A null conv_id is one
    conversation. A role without a first letter (empty) or with another than s, u, a can't be kept. An empty table
    gives no rows. Texts of any length are only hashed, never held together.

    The audits need no texts: rows without them are ordered over all tasks, whatever conversation they are of, and equal
    rows are counted before that. Then each conversation's texts are read once, in order, one at a time, as the hash of
    all of them needs it; a task holds the audit and one text.
    """
    there = F.col("n") > 0
    text = F.col("text")
    slim = rows.select(
        "conv_id",
        F.when(there, F.col("turn")).alias("turn"),
        F.when(there, identity()).alias("key"),
        F.when(there, F.substring("role", 1, 1)).alias("initial"),
        F.when(there, ~text.rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        F.when(there, ~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"),
        "n",
    )
    counted = stored(slim.groupBy("conv_id", "turn", "key", "initial", "blank", "truncated").agg(F.sum("n").alias("n")), "turns")
    turn = F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn").alias("turn"))
    repeated = counted.filter(there).groupBy("conv_id", "key").agg(F.min(turn).alias("least"), F.count("*").alias("held"))
    repeated = repeated.filter("held > 1").select(F.col("conv_id").alias("c"), F.col("key").alias("k"), "least")
    seen = F.coalesce(turn > F.col("least"), F.lit(False))
    marked = counted.join(repeated, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k")), "left").withColumn("seen", seen)
    ordered = marked.repartitionByRange("conv_id", "turn", "key").sortWithinPartitions("conv_id", "turn", "key")
    ordered = ordered.select("conv_id", "turn", "initial", "blank", "truncated", "seen", "n")
    blocks = stored(ordered.mapInArrow(_blocks(most), _ddl(PART)), "blocks")
    about = [c for c in PART if c not in ("conv_id", "part", "block")]
    heads = blocks.select(
        "conv_id", F.lit(False).alias("is_row"), "part", F.col("block").alias("place"), F.lit(None).cast("long").alias("turn"),
        F.lit(None).cast("binary").alias("key"), F.struct(*about).alias("block"), F.lit(0).alias("n"),
        F.lit("").alias("role"), F.lit("").alias("text"),
    )
    bodies = rows.filter(there).select(
        "conv_id", F.lit(True).alias("is_row"), F.lit(0).alias("part"), F.lit(0).cast("long").alias("place"), "turn",
        identity().alias("key"), F.lit(None).cast(heads.schema["block"].dataType).alias("block"), "n", "role", "text",
    )
    dealt = heads.union(bodies).repartition("conv_id").sortWithinPartitions("conv_id", "is_row", "part", "place", "turn", "key")
    return dealt.select("conv_id", "is_row", "block", "n", "role", "text").mapInArrow(_finished, _ddl(RESULT))
