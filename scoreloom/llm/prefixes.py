"""The trie of conversations that share their first turns, from double arrays of sorted shards.

Conversations are paths of turns, cut into segments of LAYER turns: a segment hangs below the hash of all turns before
it. Equal segments are counted first. Distinct ones are sorted over the whole table, and each task takes them in shards
of at most SHARD with one hash. A shard numbers its turns densely, packs the nodes into BASE and CHECK (child t of node s
for turn c: t = BASE[s] + c, CHECK[t] = s), and walks all its paths through them, adding up at each node.

Other shards can share only nodes on a shard's first and last path. These come out as parts, which are merged over all
shards. Below a segment's end lies the next layer; what is summed there is carried up along one conversation for each
such place, all layers in one window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.llm.common import WORD, broadcast_up_to, stored

GROUP = 20
LAYER, SHARD = 64, 4_096
#: Bytes of a turn's name; ids whose decimals are joined at a time; shared nodes that are broadcast at most.
NAME, IDS, UPPER = 16, 4_096, 50_000
NOWHERE = np.iinfo(np.int64).max

PLACED = "conv_id long, key binary, words long, part int, at long"
CHAINED = "conv_id long, layer long, prefix binary, keys binary, words array<long>, last boolean, end binary"
NODES = (
    "shared boolean, id binary, parent_id binary, line array<binary>, level int, depth long, conv_id long, "
    "parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, words long, ends long, goes_on boolean"
)
_ARROW = {
    "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(), "string": pa.string(),
    "array<long>": pa.list_(pa.int64()), "array<binary>": pa.list_(pa.binary()),
}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(c, _ARROW[kind]) for c, kind in (part.rsplit(" ", 1) for part in ddl.split(", "))])


def named(prefix: bytes, keys: bytes) -> bytes:
    """The name of the node below `prefix` by these turns."""
    return hashlib.md5(prefix + keys).digest() if keys else prefix


class DoubleArray:
    """BASE and CHECK of a trie given as parent and symbol of each node; nodes of one parent follow each other.

    Node 0 is the root, in slot 0. Parents of several nodes are placed first, those of most nodes before others, each at
    the first place where all its children fit; single children then fill the lowest free slots. A base may be negative.
    """

    def __init__(self, parent: np.ndarray, symbol: np.ndarray):
        n = len(parent) + 1
        self.base = np.zeros(n, np.int64)  # of nodes, until their slots are known
        self.slot = np.zeros(n, np.int64)
        self.used = np.zeros(2 * n + 64, bool)
        self.used[0] = True
        first = np.flatnonzero(np.append(True, parent[1:] != parent[:-1])) if len(parent) else np.empty(0, np.int64)
        sizes = np.diff(np.append(first, len(parent)))
        low = 1
        for k in np.argsort(-sizes, kind="stable"):
            if sizes[k] == 1:
                break
            nodes = slice(first[k], first[k] + sizes[k])
            at = self._fit(symbol[nodes] - symbol[first[k]], low)
            self._put(parent[first[k]], symbol[nodes], at - symbol[first[k]], np.arange(nodes.start, nodes.stop) + 1)
            while self.used[low]:
                low += 1
        alone = first[sizes == 1]
        self._room(len(self.used) + len(alone))
        at = np.flatnonzero(~self.used)[: len(alone)]
        self.used[at] = True
        self.slot[alone + 1] = at
        self.base[parent[alone]] = at - symbol[alone]
        size = int(self.slot.max()) + 1
        base, check = np.zeros(size, np.int64), np.full(size, -1, np.int64)
        base[self.slot] = self.base
        check[self.slot[1:]] = self.slot[parent]
        self.base, self.check = base, check

    def _room(self, size: int) -> None:
        if size > len(self.used):
            self.used = np.append(self.used, np.zeros(size, bool))

    def _fit(self, offsets: np.ndarray, low: int) -> int:
        at = low
        while True:
            self._room(at + 64 + int(offsets[-1]) + 1)
            free = at + np.flatnonzero(~self.used[at : at + 64])
            fits = ~self.used[free[:, None] + offsets].any(1)
            if fits.any():
                return int(free[fits.argmax()])
            at += 64

    def _put(self, parent: int, symbols: np.ndarray, base: int, nodes: np.ndarray) -> None:
        self.used[base + symbols] = True
        self.slot[nodes] = base + symbols
        self.base[parent] = base

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The children of nodes by symbols; -1 where there is none."""
        to = self.base[states] + symbols
        inside = (to > 0) & (to < len(self.check))
        return np.where(inside & (self.check[np.where(inside, to, 0)] == states), to, -1)


class Path(NamedTuple):
    """A distinct segment: its turns, conversations with it and those that end there, and what lies below its end."""

    keys: bytes
    words: list[int]
    n: int
    ends: int
    least: int | None
    children: int
    leaves: int
    saved: int


def shard(layer: int, prefix: bytes, paths: list[Path], left: bool, right: bool, layers: int = LAYER) -> dict[str, list]:
    """The nodes of sorted paths; `left`, `right`: whether the shard before or after may have paths below this prefix."""
    lengths = np.array([len(p.keys) // NAME for p in paths])
    width = int(lengths.max())
    turns = np.frombuffer(b"".join(p.keys for p in paths), f"S{NAME}")
    symbols = np.zeros((len(paths), width), np.int64)
    inside = np.arange(width) < lengths[:, None]
    symbols[inside] = np.unique(turns, return_inverse=True)[1] + 1
    words = np.zeros((len(paths), width), np.int64)
    words[inside] = [w for p in paths for w in p.words]

    at, parents, labels, said, levels = np.zeros(len(paths), np.int64), [], [], [], [0, 1]
    example = [0]  # a path through each node
    for level in range(width):
        rows = np.flatnonzero(lengths > level)
        above, label = at[rows], symbols[rows, level]
        new = np.append(True, (above[1:] != above[:-1]) | (label[1:] != label[:-1]))
        parents.append(above[new])
        labels.append(label[new])
        said.append(words[rows[new], level])
        example += rows[new].tolist()
        at[rows] = levels[-1] - 1 + np.cumsum(new)
        levels.append(levels[-1] + int(new.sum()))
    parent, symbol, said = (np.concatenate([np.empty(0, np.int64), *x]).astype(np.int64) for x in (parents, labels, said))
    trie = DoubleArray(parent, symbol)

    size = len(trie.check)
    count, ends, children, leaves, saved = (np.zeros(size, np.int64) for _ in range(5))
    least = np.full(size, NOWHERE, np.int64)
    goes_on, border = np.zeros(size, bool), np.zeros(size, bool)
    n = np.array([p.n for p in paths])
    low = np.array([NOWHERE if p.least is None else p.least for p in paths], np.int64)
    state = np.zeros(len(paths), np.int64)
    for level in range(width + 1):
        rows = np.flatnonzero(lengths >= level)
        if level:
            state[rows] = trie.step(state[rows], symbols[rows, level - 1])
        np.add.at(count, state[rows], n[rows])
        np.minimum.at(least, state[rows], low[rows])
        border[state[rows[:1]]] |= left and not rows[:1].any()
        border[state[rows[-1:]]] |= right and (rows[-1:] == len(paths) - 1).all()
    border[0] = True
    np.add.at(ends, state, [p.ends for p in paths])
    goes_on[state] = [p.n > p.ends for p in paths]
    for into, values in ((children, "children"), (leaves, "leaves"), (saved, "saved")):
        into[state] = [getattr(p, values) for p in paths]

    spoken = np.zeros(size, np.int64)
    spoken[trie.slot[1:]] = said
    for level in range(width, 0, -1):
        own = trie.slot[levels[level] : levels[level + 1]]
        own = own[~border[own]]
        leaves[own] += (children[own] == 0) & ~goes_on[own]
        saved[own] += (count[own] - 1) * spoken[own]
        up = trie.check[own]
        np.add.at(children, up, 1)
        np.add.at(leaves, up, leaves[own])
        np.add.at(saved, up, saved[own])

    level_of = np.repeat(np.arange(width + 1), np.diff(levels))
    slots, upper = trie.slot, np.append(0, trie.slot[parent])

    def name(node: int, level: int) -> bytes:
        return named(prefix, paths[example[node]].keys[: NAME * level])

    shared = border[slots]
    told = shared | (ends[slots] > 0) | goes_on[slots]
    below = border[upper]
    ids = [name(i, int(e)) if t else None for i, (e, t) in enumerate(zip(level_of, told, strict=True))]
    optional = lambda values: [None if v == NOWHERE else v for v in values.tolist()]
    return {
        "shared": shared.tolist(),
        "id": ids,
        "parent_id": [name(i, e - 1) if e and b else None for i, (e, b) in enumerate(zip(level_of.tolist(), below, strict=True))],
        "line": [[name(i, d) for d in range(e + 1)] if s else None for i, (e, s) in enumerate(zip(level_of.tolist(), shared, strict=True))],
        "level": level_of.tolist(),
        "depth": (layer * layers + level_of).tolist(),
        "conv_id": optional(least[slots]),
        "parent_conv_id": [None if b else v for v, b in zip(optional(least[upper]), below, strict=True)],
        "n_convs": count[slots].tolist(),
        "n_children": children[slots].tolist(),
        "n_leaves": leaves[slots].tolist(),
        "saved_tokens": saved[slots].tolist(),
        "words": spoken[slots].tolist(),
        "ends": ends[slots].tolist(),
        "goes_on": goes_on[slots].tolist(),
    }


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the task and the number within it of each row of a conversation; rows come in order."""
    part, conv, at = TaskContext.get().partitionId(), object(), 0
    for batch in batches:
        ids = batch["conv_id"].to_pylist()
        places = []
        for i in ids:
            at = at + 1 if i == conv else 1
            conv = i
            places.append(at)
        columns = [batch["conv_id"], batch["key"], batch["words"], pa.array([part] * len(ids), pa.int32()), pa.array(places, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, schema=_schema(PLACED))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv_id, turns) of all rebuilt conversations, (conv_id, depth, key, words) of their turns).

    Rows are ordered over all tasks, so that no conversation lies in one; equal rows are dealt by a salt, as any order
    of them is the same. Only the first conversation of a task can have begun before it, so offsets are few.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.select(
        *(F.col(c).cast("long").alias(c) for c in ("conv_id", "turn")),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("key"),
        F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("long").alias("words"),
        F.pmod(F.monotonically_increasing_id(), F.lit(1024)).alias("salt"),
    )
    ordered = rows.repartitionByRange("conv_id", "turn", "key", "salt").sortWithinPartitions("conv_id", "turn", "key")
    placed = stored(ordered.mapInArrow(_numbered, PLACED), "turns")
    pieces = stored(placed.groupBy("conv_id", "part").agg(F.count("*").alias("held")), "pieces")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), F.sum("held").over(before).alias("before"))
    offsets = stored(offsets.filter("before > 0"), "offsets")
    turns = placed.join(F.broadcast(offsets), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")), "left")
    turns = turns.select("conv_id", (F.col("at") + F.coalesce("before", F.lit(0))).alias("at"), "key", "words")

    first = F.pmod(F.crc32(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).cast("binary")), F.lit(4))
    whose = F.col("conv_id") - F.col("conv_id") % GROUP
    lengths = pieces.groupBy("conv_id").agg(F.sum("held").alias("held"))
    own = lengths.select("conv_id", "held", first.alias("first"), whose.alias("base"))
    bases = lengths.filter(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("base"), F.col("held").alias("base_held"))
    taken = F.least("first", F.coalesce("base_held", F.lit(0)))
    convs = own.join(bases, "base", "left").withColumn("taken", taken)
    convs = stored(convs.withColumn("turns", F.col("taken") + F.greatest(F.lit(0), F.col("held") - F.col("first"))), "conversations")

    about = convs.select(F.col("conv_id").alias("c"), "first", "taken")
    kept = turns.join(about, F.col("conv_id").eqNullSafe(F.col("c"))).filter("at > first")
    kept = kept.select("conv_id", (F.col("at") - F.col("first") + F.col("taken")).alias("depth"), "key", "words")
    heads = turns.filter((F.col("conv_id") % GROUP == 0) & (F.col("at") < 4)).withColumnRenamed("conv_id", "base")
    heads = heads.join(convs.select("conv_id", "base", "first"), "base").filter("at <= first")
    return convs.select("conv_id", "turns"), kept.union(heads.select("conv_id", F.col("at").alias("depth"), "key", "words"))


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to segments in order the name of all turns before them, their own end, and whether they are the last."""
    schema = _schema(CHAINED)
    waiting, conv, prefix = None, None, b""
    for batch in batches:
        rows = []
        for conv_id, layer, keys, words in zip(*(batch[c].to_pylist() for c in ("conv_id", "layer", "keys", "words")), strict=True):
            same = waiting is not None and conv_id == conv
            if waiting is not None:
                rows.append(waiting | {"last": not same})
            prefix, conv = waiting["end"] if same else b"", conv_id
            waiting = {"conv_id": conv_id, "layer": layer, "prefix": prefix, "keys": keys, "words": words, "end": named(prefix, keys)}
        yield pa.RecordBatch.from_pylist(rows, schema)
    if waiting is not None:
        yield pa.RecordBatch.from_pylist([waiting | {"last": True}], schema)


def segments(convs: DataFrame, turns: DataFrame, layers: int = LAYER) -> DataFrame:
    """(conv_id, layer, prefix, keys, words, last, end) of all conversations; one without turns has one empty segment."""
    layer = F.floor((F.col("depth") - 1) / layers).alias("layer")
    row = F.struct("depth", F.hex("key").alias("key"), "words")
    cut = turns.groupBy("conv_id", layer).agg(F.sort_array(F.collect_list(row)).alias("rows"))
    keys = F.unhex(F.array_join(F.transform("rows", lambda r: r["key"]), ""))
    cut = cut.select("conv_id", "layer", keys.alias("keys"), F.transform("rows", lambda r: r["words"]).alias("words"))
    none = convs.filter("turns = 0").select(
        "conv_id", F.lit(0).cast("long").alias("layer"), F.lit(b"").alias("keys"), F.array().cast("array<long>").alias("words")
    )
    ordered = cut.union(none).repartition("conv_id").sortWithinPartitions("conv_id", "layer")
    return stored(ordered.mapInArrow(_chained, CHAINED), "segments")


def _shards(most: int, layers: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = _schema(NODES)

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, left = None, [], True  # a task's first and last group may go on in other tasks
        for batch in batches:
            for layer, prefix, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                other = group is not None and group != (layer, prefix)
                if held and (other or len(held) == most):
                    yield pa.RecordBatch.from_pydict(shard(*group, held, left, not other, layers), schema)
                    held, left = [], not other
                group = (layer, prefix)
                held.append(Path(*rest))
        if held:
            yield pa.RecordBatch.from_pydict(shard(*group, held, left, True, layers), schema)

    return nodes


def _tries(paths: DataFrame, most: int, layers: int) -> tuple[DataFrame, DataFrame]:
    """(nodes of one shard, whole; shared nodes merged) of distinct segments.

    A shared node's subtree is what its shards have inside, and the shared nodes below it, each counted once.
    """
    ordered = paths.repartitionByRange("layer", "prefix", "keys").sortWithinPartitions("layer", "prefix", "keys")
    columns = ("layer", "prefix", "keys", "words", "n", "ends", "least", "children", "leaves", "saved")
    nodes = stored(ordered.select(*columns).mapInArrow(_shards(most, layers), NODES), "trie")
    parts = nodes.filter("shared").withColumn("top", F.col("level") == 0)
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens", "ends")]
    alike = [F.first(c).alias(c) for c in ("parent_id", "line", "level", "depth", "words")]
    merged = parts.groupBy("id", "top").agg(*sums, *alike, F.min("conv_id").alias("conv_id"), F.max("goes_on").alias("goes_on"))
    merged = stored(merged, "shared")
    kids = merged.filter(~F.col("top")).groupBy(F.col("parent_id").alias("id"), (F.col("level") == 1).alias("top"))
    merged = merged.join(kids.agg(F.count("*").alias("kids")), ["id", "top"], "left")
    merged = merged.withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0))).drop("kids")
    inner = F.col("top") & (F.col("depth") > 0)  # the end of a segment counts itself
    leaf = (~inner & (F.col("n_children") == 0) & ~F.col("goes_on")).cast("long")
    saved = F.when(F.col("top"), 0).otherwise((F.col("n_convs") - 1) * F.col("words"))
    own = merged.select((F.col("n_leaves") + leaf).alias("l"), (F.col("saved_tokens") + saved).alias("s"), F.posexplode("line").alias("at", "id"))
    whole = own.groupBy("id", (F.col("at") == 0).alias("top")).agg(F.sum("l").alias("n_leaves"), F.sum("s").alias("saved_tokens"))
    return nodes.filter("not shared"), stored(merged.drop("n_leaves", "saved_tokens").join(whole, ["id", "top"]), "merged")


def _below(deep: DataFrame, paths: DataFrame, most: int, layers: int) -> DataFrame:
    """(end, children, leaves, saved): what lies below each name that segments of later layers have before them.

    Each layer's own sums are given to the smallest conversation there, and added up along that from its end.
    """
    tops = _tries(paths, most, layers)[1].filter("top").select(F.col("id").alias("prefix"), "n_children", "n_leaves", "saved_tokens")
    one = deep.groupBy("prefix").agg(F.min("conv_id").alias("one"))
    tops = stored(tops.join(one, "prefix"), "tops")
    ones = tops.select("one").distinct()
    rows = deep.join(ones, F.col("conv_id").eqNullSafe(F.col("one")), "left_semi").join(tops, "prefix")
    mine = F.col("conv_id").eqNullSafe(F.col("one"))
    along = Window.partitionBy("conv_id").orderBy(F.col("layer").desc()).rowsBetween(Window.unboundedPreceding, 0)
    added = [F.sum(F.when(mine, F.col(c)).otherwise(0)).over(along).alias(c) for c in ("n_leaves", "saved_tokens")]
    totals = rows.select("prefix", F.col("n_children").alias("children"), *added).groupBy("prefix")
    totals = totals.agg(F.first("children").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    return stored(totals.withColumnRenamed("prefix", "end"), "below")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _schema("id binary, ends_sha256 string")
    end, total, empty = None, None, True
    for batch in batches:
        rows = []
        for at, text in zip(batch["end"].to_pylist(), batch["text"].to_pylist(), strict=True):
            if at != end or total is None:
                if total is not None:
                    rows.append((end, total.hexdigest()))
                end, total, empty = at, hashlib.sha256(), True
            if text:
                total.update(("" if empty else ",").encode() + text.encode())
                empty = False
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([end], pa.binary()), pa.array([total.hexdigest()])], schema=schema)


def ended(cut: DataFrame) -> DataFrame:
    """(id, ends_sha256) of nodes at which conversations end, from ids in order, some thousands in a row."""
    bucket = F.expr(f"conv_id div {IDS}")
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",")
    lists = cut.filter("last").groupBy("end", bucket.alias("bucket")).agg(ids.alias("text"))
    ordered = lists.repartition("end").sortWithinPartitions("end", "bucket")
    return ordered.select("end", "text").mapInArrow(_digests, "id binary, ends_sha256 string")


RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def nodes(conversations: DataFrame, most: int = SHARD, layers: int = LAYER) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node.

    Turns follow each other by turn, null turns first, those of one turn by the md5 of role and text; equal rows are
    turns of their own. Null roles and texts are empty. Rows with a null conv_id are one conversation that takes no
    turns from others; its id counts in no minimum and is left out of hashed ids, so a node of it alone has null ids. A
    conversation without turns is a member of the root only. Texts of any length are only hashed and their words
    counted; conversations of any length are cut. An empty table gives no rows. Other columns are left out.
    """
    cut = segments(*rebuilt(conversations), layers)
    paths = cut.groupBy("layer", "prefix", "keys", "end").agg(
        F.count("*").alias("n"), F.sum(F.col("last").cast("long")).alias("ends"), F.min("conv_id").alias("least"), F.first("words").alias("words")
    )
    zero = {c: F.lit(0).cast("long") for c in ("children", "leaves", "saved")}
    paths = stored(paths, "paths")
    deep = cut.filter("layer > 0")
    if deep.isEmpty():
        paths = paths.withColumns(zero)
    else:
        later = _below(deep, paths.filter("layer > 0").withColumns(zero), most, layers)
        goes_on = paths.filter("n > ends").join(later, "end")
        paths = goes_on.unionByName(paths.filter("n = ends").withColumns(zero))
    alone, shared = _tries(paths, most, layers)
    upper = shared.filter("not top or depth = 0")
    known = upper.select("id", "conv_id").union(alone.filter("goes_on").select("id", "conv_id"))
    known = stored(known.select(F.col("id").alias("parent_id"), F.col("conv_id").alias("above")), "known")
    columns = [*RESULT[:-1], "id", "ends"]
    open_ = alone.filter("parent_id is not null").unionByName(
        upper.withColumn("parent_conv_id", F.lit(None).cast("long")), allowMissingColumns=True
    )
    found = open_.drop("parent_conv_id").join(broadcast_up_to(known, UPPER), "parent_id", "left").withColumnRenamed("above", "parent_conv_id")
    every = stored(alone.filter("parent_id is null").select(*columns).union(found.select(*columns)), "nodes")
    nothing = F.lit(hashlib.sha256().hexdigest())
    with_ends = every.filter("ends > 0").join(ended(cut), "id").select(*RESULT)
    return with_ends.union(every.filter("ends = 0").withColumn("ends_sha256", nothing).select(*RESULT))
